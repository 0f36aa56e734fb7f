"""Repeated 200-byte strings, found with run-length compressed Burrows-Wheeler transforms.

Which strings can repeat is narrowed first. Every window of 200 bytes picks the 64-byte gram of the
least hash in it (the first of several) as its anchor, so equal windows have equal anchors, and about
one place in seventy is one. The windows of an anchor's place make a stretch of at most 336 bytes.
Anchors that occur once anywhere are done. Stretches that are equal as a whole are repeats as a whole,
which a count of their digests tells. What is left are the edges of repeated passages: different
stretches with the same anchor.

These meet by anchor, in groups gathered into blocks of bounded size. A block is indexed: its suffixes
are sorted, the transform is cut into runs of equal letters, and at both ends of each run the place and
its common prefix with the neighbour beyond the run are sampled. Within a run that prefix grows by one
with each step to the left, so streaming over the text from sample to sample gives every place's
longest match anywhere else, and those of 200 or more are marked.

An anchor with very many different stretches would not fit a block; its windows are counted one by one.

Texts move twice, to the stretches that are cut from them and to the marks that are cut out; they are
compressed in the tasks that read them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import arrow_schema, map_rows, text_key
from orderlens.operators.hot_join import join_hot
from orderlens.session import materialize

LENGTH = 200
GRAM = 64
REACH = LENGTH - GRAM + 1
BLOCK = 2_000_000
"""Bytes of stretches indexed at a time, and one anchor's more."""

CROWDED = 2000
"""Different stretches of one anchor from which its windows are counted instead of indexed."""

_CHUNK = 1 << 18
_PLACE = np.uint64((1 << 20) - 1)
_SPAN = 8
"""Bits of a span that hold its number of windows, at most ``REACH``; the others hold the first."""


def _tables(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of the bytes, and powers of an odd base and of its inverse, all modulo 2^64."""
    rng = np.random.default_rng(seed)
    base = int(rng.integers(1 << 62, 1 << 63)) | 1
    size = _CHUNK + LENGTH
    powers = [np.ones(size, np.uint64), np.ones(size, np.uint64)]
    for out, factor in zip(powers, (base, pow(base, -1, 1 << 64))):
        np.multiply.accumulate(np.full(size - 1, factor, np.uint64), out=out[1:])
    return rng.integers(0, 1 << 64, 256, dtype=np.uint64), *powers


_FIRST, _SECOND = _tables(1), _tables(2)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class _Hash:
    """Hashes of substrings of one chunk, each in a subtraction and a product."""

    def __init__(self, data: np.ndarray, tables: tuple):
        values, powers, self.inverse = tables
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * powers[: len(data)], out=self.prefix[1:])

    def every(self, size: int) -> np.ndarray:
        n = len(self.prefix) - size
        return _mix((self.prefix[size:] - self.prefix[:-size]) * self.inverse[:n])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mix((self.prefix[ends] - self.prefix[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def anchors(text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, digest of the stretch, first window, windows) of each place, in arrays of one chunk each."""
    for at in range(0, len(text) - LENGTH + 1, _CHUNK):
        data = np.frombuffer(text, np.uint8, min(_CHUNK + LENGTH - 1, len(text) - at), at)
        windows = len(data) - LENGTH + 1
        first = _Hash(data, _FIRST)
        grams = first.every(GRAM)
        ranked = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        rows = -(-len(ranked) // REACH)
        padded = np.full(rows * REACH, ~np.uint64(0))
        padded[: len(ranked)] = ranked
        padded = padded.reshape(rows, REACH)
        after = np.minimum.accumulate(padded, axis=1).ravel()
        before = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        chosen = np.minimum(before[:windows], after[REACH - 1 : REACH - 1 + windows]) & _PLACE
        starts = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        counts = np.diff(np.append(starts, windows))
        digests = _Hash(data, _SECOND).of(starts, starts + counts - 1 + LENGTH)
        yield grams[chosen[starts].astype(np.int64)].view(np.int64), digests.view(np.int64), starts + at, counts


def _places(docs: DataFrame) -> DataFrame:
    """One row for each place of an anchor: anchor, digest, text key, and first window and windows as one."""
    schema = "anchor long, digest long, k1 long, k2 long, span long"
    fields = arrow_schema(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            size = 0
            for row, text in enumerate(batch.column(2).to_pylist()):
                for part in anchors((text or "").encode()):
                    found.append((*part, np.full(len(part[0]), row)))
                    size += len(part[0])
                if size >= 100_000:
                    yield assemble(batch, found)
                    found, size = [], 0
            if found:
                yield assemble(batch, found)

    def assemble(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        anchor, digest, start, n, row = (np.concatenate(c) for c in zip(*found))
        keys = [batch.column(i).take(pa.array(row)) for i in range(2)]
        columns = [pa.array(anchor), pa.array(digest), *keys, pa.array(start << _SPAN | n)]
        return pa.record_batch(columns, schema=fields)

    return docs.select(*text_key(), "text").mapInArrow(run, schema)


class Index:
    """Run-length index of a block of stretches, each followed by an end of its own."""

    def __init__(self, stretches: list[bytes]):
        self.text = np.frombuffer(b"".join(stretches), np.uint8)
        lengths = np.fromiter(map(len, stretches), np.int64, len(stretches))
        self.ends = np.repeat(np.cumsum(lengths), lengths)
        self.of = np.repeat(np.arange(len(stretches)), lengths)
        self.starts = np.cumsum(lengths) - lengths
        self._sort()
        self._runs()

    def _sort(self) -> None:
        """Suffix array by doubling. ``ranks`` keeps each level, equal where that many letters are equal."""
        n, many = len(self.text), len(self.starts)
        left = self.ends - np.arange(n)
        depth = 7
        padded = np.concatenate([self.text.astype(np.int64) + 1, np.zeros(depth, np.int64)])
        key = np.zeros(n, np.int64)
        for i in range(depth):
            key = key * 257 + np.where(left > i, padded[i : i + n], 0)
        order = np.argsort(key)
        rank = _ranks(order, key[order])
        self.levels: list[tuple[int, np.ndarray]] = []
        while True:
            self.levels.append((depth, np.where(left >= depth, rank, -1 - np.arange(n)).astype(np.int32)))
            ordered = rank[order]
            same = ordered[1:] == ordered[:-1]
            if not same.any():
                break
            # Only places that share their rank move, within the slots they hold.
            slots = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
            open_ = order[slots]
            beyond = open_ + depth
            more = beyond < self.ends[open_]
            second = np.where(more, rank[np.minimum(beyond, n - 1)] + many, self.of[open_])
            by = rank[open_] * (n + many + 1) + second
            sorted_ = np.argsort(by)
            order[slots] = open_[sorted_]
            by = by[sorted_]
            fresh = np.concatenate([[True], by[1:] != by[:-1]])
            new = rank.copy()
            new[order[slots]] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
            rank = new
            depth *= 2
        self.order = order

    def _runs(self) -> None:
        """Cut the transform into runs; sample place and common prefix at the first and last of each."""
        order = self.order
        letter = np.where(order == self.starts[self.of[order]], -1 - self.of[order], self.text[order - 1].astype(int))
        change = letter[1:] != letter[:-1]
        below = np.flatnonzero(change)
        common = self._common(order[below], order[below + 1])
        first, last = order[below + 1], order[below]
        self.heads = np.append(first, order[:1]), np.append(common, 0)
        self.tails = np.append(last, order[-1:]), np.append(common, 0)

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of pairs of suffixes."""
        a, b = a.copy(), b.copy()
        out = np.zeros(len(a), np.int64)
        n = len(self.text)
        for depth, rank in reversed(self.levels):
            inside = (a + out < self.ends[a]) & (b + out < self.ends[b])
            at, bt = np.minimum(a + out, n - 1), np.minimum(b + out, n - 1)
            out += depth * (inside & (rank[at] == rank[bt]))
        for _ in range(self.levels[0][0]):
            inside = (a + out < self.ends[a]) & (b + out < self.ends[b])
            at, bt = np.minimum(a + out, n - 1), np.minimum(b + out, n - 1)
            same = inside & (self.text[at] == self.text[bt])
            if not same.any():
                break
            out += same
        return out

    def matches(self) -> np.ndarray:
        """Matching statistics: of each place the length of its longest match that starts anywhere else."""
        places = np.arange(len(self.text))
        longest = np.zeros(len(places), np.int64)
        for at, common in (self.heads, self.tails):
            reach = np.zeros(len(places), np.int64)
            reach[at] = at + common
            longest = np.maximum(longest, np.maximum.accumulate(np.maximum(reach, places)) - places)
        return longest


def _ranks(order: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each place the first slot of its key."""
    fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    return rank


CUT = "anchor long, stretch binary, k1 long, k2 long, start long, open boolean, different long"
MARKS = "k1 long, k2 long, start long, n int"


def _index_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of stretches that come sorted by anchor; a block ends where an anchor does."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if size >= BLOCK and held[-1][0] != row[0]:
                yield _marks(held)
                held, size = [], 0
            held.append(row)
            size += len(row[1])
    if held:
        yield _marks(held)


def _marks(rows: list[tuple]) -> pa.RecordBatch:
    """Of each open stretch the runs of windows that start elsewhere too."""
    index = Index([row[1] for row in rows])
    open_ = np.array([row[5] for row in rows])
    hit = (index.matches() >= LENGTH) & open_[index.of]
    edge = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
    # A stretch's last window ends with it, so no run goes on into the next stretch.
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    of = index.of[starts]
    k1, k2, first = (np.array([row[i] for row in rows], np.int64) for i in (2, 3, 4))
    columns = [k1[of], k2[of], first[of] + starts - index.starts[of], (ends - starts).astype(np.int32)]
    return pa.record_batch([pa.array(c) for c in columns], names=["k1", "k2", "start", "n"])


def _pack(k1: int, k2: int, doc_id: int | None, text: str | None) -> Iterator[tuple]:
    yield k1, k2, doc_id, zstandard.ZstdCompressor(level=3).compress((text or "").encode())


def _cut(k1: int, k2: int, packed: bytes, stretches: list[dict]) -> Iterator[tuple]:
    data = zstandard.ZstdDecompressor().decompress(packed)
    for s in stretches:
        start, n = s["span"] >> _SPAN, s["span"] & (1 << _SPAN) - 1
        yield s["anchor"], data[start : start + n - 1 + LENGTH], k1, k2, start, s["open"], s["different"]


def _windows(anchor: int, stretch: bytes, k1: int, k2: int, start: int, open_: bool) -> Iterator[tuple]:
    data = np.frombuffer(stretch, np.uint8)
    pairs = zip(*(_Hash(data, tables).every(LENGTH).view(np.int64).tolist() for tables in (_FIRST, _SECOND)))
    for i, (w1, w2) in enumerate(pairs):
        yield w1, w2, k1, k2, start + i, open_


def _measure(data: bytes, marks: list[dict] | None) -> tuple[bytes, int, int]:
    """What is kept of a text, the bytes removed, and the number of removed runs."""
    if not marks:
        return data, 0, 0
    depth = np.zeros(len(data) + 1, np.int64)
    starts = np.array([m["start"] for m in marks])
    ends = starts + np.array([m["n"] for m in marks]) - 1 + LENGTH
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    gone = np.cumsum(depth[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def _result(doc_id: int | None, packed: bytes, marks: list[dict] | None) -> Iterator[tuple]:
    kept, removed, runs = _measure(zstandard.ZstdDecompressor().decompress(packed), marks)
    yield doc_id, len(kept) + removed, removed, runs, hashlib.sha256(kept).hexdigest()


def _join_spread(few: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Join of stored rows with one row a key, which is written first; rows of a frequent key are split."""
    return join_hot(materialize(few), rows, key)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and kept_sha256.

    Each byte is removed that lies in a 200-byte string of its text which also starts at another place
    of any text, its own included. A null text is empty. Texts are whole UTF-8 byte strings; matches
    never cross texts. Repeated rows are each other's repeats; null ids and ties change nothing. Rows
    are known by 128 bits of their text, so equal texts get equal results. Further columns are not read.
    """
    places = materialize(_places(docs))
    repeated = places.groupBy("anchor").count().where("count > 1").select("anchor")
    places = materialize(_join_spread(repeated, places, "anchor"))
    one = F.min(F.struct("k1", "k2", "span")).alias("one")
    stretches = places.groupBy("anchor", "digest").agg(F.count("*").alias("copies"), one)
    stretches = materialize(stretches.select("anchor", "digest", "copies", "one.*"))

    start, n = F.shiftright("span", _SPAN).alias("start"), F.col("span").bitwiseAND(F.lit((1 << _SPAN) - 1)).cast("int").alias("n")
    # One key of both, for the join; the columns themselves decide.
    both = F.xxhash64("anchor", "digest").alias("both")
    whole = stretches.where("copies > 1").select(both, F.struct("anchor", "digest").alias("is"))
    marks = _join_spread(whole, places.select(both, "anchor", "digest", "k1", "k2", "span"), "both")
    marks = marks.where((F.col("anchor") == F.col("is.anchor")) & (F.col("digest") == F.col("is.digest")))
    marks = marks.select("k1", "k2", "span").distinct()
    marks = marks.select("k1", "k2", start, n)

    different = stretches.groupBy("anchor").agg(F.count("*").alias("different")).where("different > 1")
    listed = (
        _join_spread(different, stretches, "anchor")
        .select("k1", "k2", F.struct("anchor", "span", (F.col("copies") == 1).alias("open")).alias("stretch"), "different")
        .groupBy("k1", "k2")
        .agg(F.collect_list(F.struct("stretch.*", "different")).alias("stretches"))
    )
    # Of equal texts the first is cut.
    firsts = docs.select(*text_key(), "doc_id").groupBy("k1", "k2").agg(F.min("doc_id").alias("first"))
    texts = map_rows(docs.select(*text_key(), "doc_id", "text"), _pack, "k1 long, k2 long, doc_id long, packed binary")
    rows = texts.join(listed.join(firsts, ["k1", "k2"]), ["k1", "k2"]).where(F.col("doc_id").eqNullSafe(F.col("first")))
    cut = materialize(map_rows(rows.select("k1", "k2", "packed", "stretches"), _cut, CUT))

    groups = cut.where(F.col("different") < crowded).drop("different")
    groups = groups.repartition("anchor").sortWithinPartitions("anchor")
    marks = marks.union(groups.mapInArrow(_index_blocks, MARKS))
    busy = cut.where(F.col("different") >= crowded).drop("different")
    if not busy.isEmpty():
        windows = materialize(map_rows(busy, _windows, "w1 long, w2 long, k1 long, k2 long, start long, open boolean"))
        twice = windows.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
        found = windows.where("open").join(twice, ["w1", "w2"], "left_semi")
        marks = marks.union(found.select("k1", "k2", "start", F.lit(1).alias("n")))
    of_text = marks.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n")).alias("marks"))
    rows = texts.join(of_text, ["k1", "k2"], "left").select("doc_id", "packed", "marks")
    return map_rows(rows, _result, RESULT)
