"""Secrets in texts: fixed patterns, and a character convolutional network for what they miss.

Candidates are all runs of twelve or more characters of the secrets' alphabet that hold a digit or
change case often. Runs that a pattern covers are the labelled findings: the network learns, from all
different runs of each label in all documents, to tell them from other runs by their characters and
context. The windows are dealt to shards by a hash; in each round every shard goes on from the same
weights in a task of its own, and the new weights are averaged. Scores are calibrated on held-out runs,
one in four, and the threshold is the highest up to an even chance that keeps the asked recall there. Every candidate of every
text outside the patterns' findings is then scored: a long one in overlapping windows and by its parts,
and the highest score counts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import kth_smallest, map_rows
from orderlens.session import materialize

RECALL = 0.95
"""Share of held-out findings that the threshold must keep."""

LEAST_RUNS = 10
"""Different findings, and other runs, in the whole table without which no network can be learned."""

EVEN = 0.5
"""Calibrated probability that the threshold does not exceed."""

HELD = 4
"""One in so many of each label's runs calibrates."""

SHARD_WINDOWS = 4096
"""Windows that one task learns from at a time; there are as many shards as that takes."""

EPOCHS, ROUNDS = 30, 10
"""Passes over each shard, and after how many equal parts of them the shards' weights are averaged."""

KINDS = ("assign", "access", "hex", "cnn")
_ORDER = {kind: i for i, kind in enumerate(KINDS)}

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_KEYWORDS = ("password", "passwd", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
_CASE_CHANGE = re.compile(r"[a-z][A-Z]|[A-Z]{2}[a-z]")

Span = tuple[str, int, int]


def base_spans(text: str, runs: list[re.Match] | None = None) -> list[Span]:
    """The patterns' matches as (kind, start, end), sorted by start, then kind."""
    runs = list(_RUN.finditer(text)) if runs is None else runs
    found: list[Span] = []
    lowered = text.lower()
    if any(word in lowered for word in _KEYWORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    # An access key or a hex run lies within one run of the alphabet that holds both.
    for run in runs:
        if run.end() - run.start() >= 16:
            found += [("hex", *m.span()) for m in _HEX.finditer(text, *run.span())]
            found += [("access", *m.span()) for m in _ACCESS.finditer(text, *run.span())]
    return sorted(found, key=lambda s: (s[1], _ORDER[s[0]]))


def _overlapping(stretches: Iterable[tuple[int, int]], spans: list[Span]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Of each stretch, in order and apart from each other, its ends and what spans cover of it.

    ``spans`` are sorted by start. Both are walked once, so long lists take time in proportion.
    """
    covered: list[list[int]] = []
    for _, start, end in spans:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    at = 0
    for start, end in stretches:
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        inside, i = [], at
        while i < len(covered) and covered[i][0] < end:
            inside.append((max(covered[i][0], start), min(covered[i][1], end)))
            i += 1
        yield start, end, inside


def _may_be_secret(word: str) -> bool:
    return len(word) >= 12 and (any(c.isdigit() for c in word) or len(_CASE_CHANGE.findall(word)) >= 3)


def candidates(runs: list[re.Match]) -> Iterator[tuple[int, int]]:
    """Runs that may be a secret, without the marks at their ends."""
    for run in runs:
        word = run[0].strip(".=-")
        if _may_be_secret(word):
            start = run.start() + len(run[0]) - len(run[0].lstrip(".=-"))
            yield start, start + len(word)


CONTEXT, HEAD, TAIL = 16, 32, 16
WINDOW = 2 * CONTEXT + HEAD + TAIL
STEP = 24
"""Pieces longer than head and tail are read in windows that begin so many characters apart."""

_PART = re.compile(r"[^/.=]{12,}")
_CLASSES = ["", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r"]
_CLASSES += ["\"'`", "=:", "+/_", ".-", "@"]
CHANNELS = len(_CLASSES) + 2
"""Classes of characters, of which 0 is padding; then any other character, and being in the candidate."""

_CLASS_OF = {c: i for i, members in enumerate(_CLASSES) for c in members}


def _codes(text: str, start: int, end: int) -> list[int]:
    """Classes of the characters before, at the head, at the tail and after; as long as the window."""
    other = len(_CLASSES)
    size = end - start
    before = text[max(0, start - CONTEXT) : start]
    head = text[start : min(end, start + HEAD)]
    tail = text[max(start + HEAD, end - TAIL) : end] if size > HEAD else ""
    after = text[end : end + CONTEXT]
    codes = [0] * (CONTEXT - len(before))
    for part, width in ((before, len(before)), (head, HEAD), (tail, TAIL), (after, CONTEXT)):
        codes += [_CLASS_OF.get(c, other) for c in part] + [0] * (width - len(part))
    return codes


def _pieces(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """What is read of a candidate: all of it, and its parts between / . and = that may be a secret.

    A piece longer than a window's head and tail is read in overlapping windows, each with its
    context, so that no character is left out. A candidate's score is the highest of its pieces'.
    """
    pieces = [(start, end)]
    for part in _PART.finditer(text, start, end):
        if part.span() != (start, end) and _may_be_secret(part[0]):
            pieces.append(part.span())
    size = HEAD + TAIL
    for a, b in pieces:
        if b - a > size:
            yield from ((at, at + size) for at in range(a, b - size, STEP))
            a = b - size
        yield a, b


def _inputs(codes: np.ndarray) -> np.ndarray:
    """One-hot channels of an array (rows, window) of classes, and the flag of the candidate's places."""
    x = np.zeros((*codes.shape, CHANNELS), np.float32)
    rows, places = np.indices(codes.shape)
    x[rows, places, codes] = 1
    x[:, :, 0] = 0
    x[:, CONTEXT : CONTEXT + HEAD + TAIL, -1] = codes[:, CONTEXT : CONTEXT + HEAD + TAIL] > 0
    return x


WIDTH, FILTERS = 5, 16


@dataclass
class Network:
    """One convolution, its largest and its mean activation of each filter, and a linear score."""

    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 1.0
    held: tuple[int, int] = (0, 0)
    """Findings and other runs that were held out."""
    recall: float = 0.0
    precision: float = 0.0
    """Of the held-out rows at the threshold; precision at the held-out mix of the labels."""

    def _forward(self, codes: np.ndarray) -> tuple:
        x = _inputs(codes)
        views = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)
        views = views.transpose(0, 1, 3, 2).reshape(len(x), WINDOW - WIDTH + 1, WIDTH * CHANNELS)
        active = np.maximum(views @ self.kernel + self.bias, 0)
        pooled = np.concatenate([active.max(axis=1), active.mean(axis=1), np.ones((len(x), 1))], axis=1)
        return views, active, pooled, pooled @ self.out

    def score(self, codes: np.ndarray) -> np.ndarray:
        """Calibrated probability of each row."""
        return self.calibrated(self.logits(codes))

    def logits(self, codes: np.ndarray) -> np.ndarray:
        parts = [self._forward(codes[at : at + 256])[3] for at in range(0, len(codes), 256)]
        return np.concatenate([*parts, np.zeros(0)])

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * logits + self.scale[1], -30, 30)))

    def gradients(self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
        views, active, pooled, logits = self._forward(codes)
        error = weights * (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) / len(labels)
        to_pooled = error[:, None] * self.out[None, :-1]
        to_active = np.repeat(to_pooled[:, None, FILTERS:] / active.shape[1], active.shape[1], axis=1)
        rows, filters = np.indices((len(labels), FILTERS))
        to_active[rows, active.argmax(axis=1), filters] += to_pooled[:, :FILTERS]
        to_active *= active > 0
        kernel = np.tensordot(views, to_active, axes=([0, 1], [0, 1]))
        return [kernel, to_active.sum(axis=(0, 1)), pooled.T @ error]


def _untrained(rng: np.random.Generator) -> Network:
    return Network(
        rng.normal(0, 0.3, (WIDTH * CHANNELS, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.3, 2 * FILTERS + 1)
    )


def _balance(labels: np.ndarray, positive: int, negative: int) -> np.ndarray:
    """Weights by which either label counts for half of all rows."""
    n = positive + negative
    return np.where(labels > 0, n / (2 * positive), n / (2 * negative))


def _descend(
    net: Network, x: np.ndarray, y: np.ndarray, weights: np.ndarray, epochs: int, rng: np.random.Generator
) -> None:
    """Change the weights of ``net`` by passes over the rows in a pseudo-random order."""
    params = [net.kernel, net.bias, net.out]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 64):
            rows = order[at : at + 64]
            step += 1
            for p, g, (m, v) in zip(params, net.gradients(x[rows], y[rows], weights[rows]), moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


def _scale(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and offset that make logits calibrated; ``counts`` is how often each row stands."""
    counts = np.ones(len(logits)) if counts is None else counts
    a, b = 1.0, 0.0
    for _ in range(200):
        wrong = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30))) - labels
        slope, square = np.average(wrong * logits, weights=counts), np.average(logits**2, weights=counts)
        a, b = a - 0.05 * slope / (1 + square), b - 0.2 * np.average(wrong, weights=counts)
    return float(a), float(b)


def train(
    codes: np.ndarray, labels: np.ndarray, held: np.ndarray, recall: float = RECALL, run: np.ndarray | None = None
) -> Network | None:
    """A network of labelled windows in memory, calibrated on the rows in ``held``; ``learn`` is for tables.

    ``run`` numbers the candidate of each row, where candidates have several; a held-out candidate
    counts once, by its highest score, as candidates are scored when texts are scanned.

    The threshold is the highest calibrated probability that keeps ``recall`` of the held-out findings,
    however low it is, and at most an even chance: where the labels are far apart, the least of few
    findings says little about others. None where one of the labels is missing among those to calibrate on or to learn from.
    """
    if not all((labels[rows] == label).any() for rows in (held, ~held) for label in (True, False)):
        return None
    rng = np.random.default_rng(0)
    net = _untrained(rng)
    y = labels[~held].astype(float)
    _descend(net, codes[~held], y, _balance(y, y.sum(), len(y) - y.sum()), EPOCHS, rng)
    _, own = np.unique(np.arange(len(codes))[held] if run is None else run[held], return_inverse=True)
    logits, y = np.full(own.max() + 1, -np.inf), np.zeros(own.max() + 1)
    np.maximum.at(logits, own, net.logits(codes[held]))
    y[own] = labels[held]
    net.scale = _scale(logits, y)
    scores = net.calibrated(logits)
    positive = np.sort(scores[y > 0])
    net.threshold = min(float(positive[int((1 - recall) * len(positive))]), EVEN)
    found = scores >= net.threshold
    net.held = len(positive), len(y) - len(positive)
    net.recall, net.precision = float(found[y > 0].mean()), float(y[found].mean())
    return net


def _labelled(text: str) -> Iterator[tuple[bool, int, bytes]]:
    """Per candidate: whether a pattern's finding overlaps it, a hash of its characters, and its windows.

    Of a finding only the windows that patterns fill, or cover by 24 characters or more, are learned
    from; nobody knows what the others hold.
    """
    runs = list(_RUN.finditer(text))
    spans = base_spans(text, runs)
    for start, end, inside in _overlapping(candidates(runs), spans):
        key = int.from_bytes(hashlib.blake2b(text[start:end].encode(), digest_size=8).digest(), "big", signed=True)
        pieces = list(_pieces(text, start, end))
        if inside:
            covered = np.zeros(end - start + 1, np.int64)
            for a, b in inside:
                covered[a - start + 1 : b - start + 1] = 1
            covered = covered.cumsum()
            pieces = [
                (s, e) for s, e in pieces if covered[e - start] - covered[s - start] >= min(STEP, e - s)
            ] or pieces[:1]
        yield bool(inside), key, b"".join(bytes(_codes(text, s, e)) for s, e in pieces)


def labelled_runs(docs: DataFrame) -> DataFrame:
    """All different candidates of all documents: secret, key (a hash of the characters) and windows.

    Copies count once, with the least of their windows, so neither the order nor the partitioning of the
    rows matters. The result is stored.
    """
    found = map_rows(
        docs.where(F.col("text").isNotNull()).select("text"), _labelled, "secret boolean, key long, windows binary"
    )
    return materialize(found.groupBy("secret", "key").agg(F.min("windows").alias("windows")))


def sampled(docs: DataFrame, size: int) -> list[tuple[bool, int, bytes]]:
    """Of each label the ``size`` candidates of the smallest hashes, to look at; ``learn`` reads all."""
    found, out = labelled_runs(docs), []
    for secret in (True, False):
        rows = found.where(F.col("secret") == secret).orderBy("key").limit(size).collect()
        out += [(r["secret"], r["key"], bytes(r["windows"])) for r in rows]
    return out


def _codes_of(windows: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).astype(np.int64).reshape(-1, WINDOW)


def _each_window(runs: DataFrame, *columns: str) -> DataFrame:
    """One row per window of each run."""
    at = F.explode(F.sequence(F.lit(0), (F.length("windows") / WINDOW).cast("int") - 1)).alias("at")
    window = F.substring("windows", F.col("at") * WINDOW + 1, F.lit(WINDOW)).alias("window")
    return runs.select(*columns, "windows", at).select(*columns, "at", window)


def _in_shards(runs: DataFrame, shards: int) -> DataFrame:
    """Windows in ``shards`` rows by a hash, as the lists ``labels`` and ``windows`` in a fixed order; stored."""
    shard = F.pmod(F.xxhash64("key", "at", "secret"), F.lit(shards)).alias("shard")
    dealt = _each_window(runs, "secret", "key").select(shard, F.struct("key", "at", "secret", "window").alias("row"))
    rows = dealt.repartition(shards, "shard").groupBy("shard").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return materialize(rows.select("shard", F.col("rows.secret").alias("labels"), F.col("rows.window").alias("windows")))


def _round(net: Network, shards: DataFrame, counts: dict[bool, int], number: int, epochs: int) -> Network:
    """The mean of the networks that the shards make of ``net``, by their windows. They are few thousand
    numbers a shard, and are added in the order of the shards, so that the sum is always the same."""

    def each(shard: int, labels: list[bool], windows: list[bytes]) -> Iterator[tuple]:
        own = replace(net, kernel=net.kernel.copy(), bias=net.bias.copy(), out=net.out.copy())
        y = np.array(labels, float)
        weights = _balance(y, counts[True], counts[False])
        _descend(own, _codes_of(windows), y, weights, epochs, np.random.default_rng([number, shard]))
        yield shard, len(y), np.concatenate([own.kernel.ravel(), own.bias, own.out]).tobytes()

    total = np.zeros(net.kernel.size + net.bias.size + net.out.size)
    for r in map_rows(shards, each, "shard long, rows long, weights binary").orderBy("shard").collect():
        total += np.frombuffer(r["weights"]) * (r["rows"] / (counts[True] + counts[False]))
    kernel, bias, out = np.split(total, np.cumsum([net.kernel.size, net.bias.size]))
    return replace(net, kernel=kernel.reshape(net.kernel.shape), bias=bias, out=out)


def _calibrate(net: Network, held: DataFrame, counts: dict[bool, int], recall: float) -> None:
    """Scale and threshold of ``net`` from all held-out runs, each by its highest score."""

    def each(secret: bool, key: int, windows: bytes) -> Iterator[tuple]:
        yield secret, key, float(net.logits(_codes_of([windows])).max())

    scored = materialize(map_rows(held.select("secret", "key", "windows"), each, "secret boolean, key long, logit double"))
    near = F.round("logit", 2).alias("logit")
    rows = scored.groupBy(near, "secret").agg(F.count("*").alias("n")).orderBy("logit", "secret").collect()
    logits, labels, n = (np.array([r[name] for r in rows], float) for name in ("logit", "secret", "n"))
    net.scale = _scale(logits, labels, n)
    # The calibrated probability rises with the logit, or falls with all of them.
    sign = 1.0 if net.scale[0] >= 0 else -1.0
    findings = scored.where("secret").select((sign * F.col("logit")).alias("value"))
    least = sign * kth_smallest(findings, "value", int((1 - recall) * counts[True]))
    net.threshold = min(float(net.calibrated(np.array([least]))[0]), EVEN)
    clipped = F.greatest(F.least(net.scale[0] * F.col("logit") + net.scale[1], F.lit(30.0)), F.lit(-30.0))
    found = scored.where(1 / (1 + F.exp(-clipped)) >= net.threshold * (1 - 1e-9))
    found = found.agg(F.count_if("secret"), F.count_if(~F.col("secret"))).first()
    net.held = counts[True], counts[False]
    net.recall, net.precision = found[0] / counts[True], found[0] / (found[0] + found[1])


def learn(docs: DataFrame, recall: float = RECALL) -> Network | None:
    """A network learned from and calibrated on all different candidates of all documents.

    A candidate that a pattern's finding overlaps is labelled a secret. Of each label's runs the quarter of
    the smallest hashes calibrates. None where the table holds fewer than ten different findings or other
    runs.
    """
    runs = labelled_runs(docs)
    counts = {r["secret"]: r["count"] for r in runs.groupBy("secret").count().collect()}
    if min(counts.get(True, 0), counts.get(False, 0)) < LEAST_RUNS:
        return None
    held = {label: -(-n // HELD) for label, n in counts.items()}
    last = {label: kth_smallest(runs.where(F.col("secret") == label), "key", n - 1) for label, n in held.items()}
    is_held = F.col("key") <= F.when(F.col("secret"), last[True]).otherwise(last[False])
    learned = runs.where(~is_held)
    windows = learned.groupBy("secret").agg(F.sum(F.length("windows") / WINDOW).cast("long").alias("n")).collect()
    windows = {r["secret"]: r["n"] for r in windows}
    shards = -(-sum(windows.values()) // SHARD_WINDOWS)
    dealt, rounds = _in_shards(learned, shards), ROUNDS if shards > 1 else 1
    net = _untrained(np.random.default_rng(0))
    for number in range(rounds):
        net = _round(net, dealt, windows, number, EPOCHS // rounds)
    _calibrate(net, runs.where(is_held), held, recall)
    return net


def find(text: str | None, net: Network | None) -> list[Span]:
    """All spans of a text: the patterns', and candidates apart from them that the network finds."""
    if not text:
        return []
    runs = list(_RUN.finditer(text))
    spans = base_spans(text, runs)
    if net is None:
        return spans
    open_ = [(a, b) for a, b, inside in _overlapping(candidates(runs), spans) if not inside]
    pieces = ((i, *piece) for i, (a, b) in enumerate(open_) for piece in _pieces(text, a, b))
    best = np.zeros(len(open_))
    while part := list(islice(pieces, 256)):
        scores = net.score(np.array([_codes(text, a, b) for _, a, b in part], np.int64))
        np.maximum.at(best, [i for i, _, _ in part], scores)
    spans += [("cnn", a, b) for (a, b), score in zip(open_, best) if score >= net.threshold]
    return sorted(spans, key=lambda s: (s[1], _ORDER[s[0]]))


def join_spans(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame, net: Network | None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256 and spans.

    A null or empty text has no spans. Repeated rows and null ids stay; further columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def each(doc_id: int | None, text: str | None) -> Iterator[tuple]:
        spans = find(text, shared.value)
        base = [span for span in spans if span[0] != "cnn"]
        counts = [sum(kind == span[0] for span in base) for kind in KINDS[:3]]
        yield doc_id, *counts, hashlib.sha256(join_spans(base).encode()).hexdigest(), join_spans(spans)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_rows(docs.select("doc_id", "text"), each, schema)


def redact(text: str, spans: list[Span], mark: str = "[REDACTED]") -> str:
    """The text with each stretch that spans cover replaced by the mark."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced, and ``n_chars`` counted again; null texts stay."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def clean(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            new = [t and redact(t, find(t, shared.value)) for t in texts]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    out = docs.mapInArrow(clean, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
