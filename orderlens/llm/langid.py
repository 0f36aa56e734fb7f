"""Language identification in two steps: the family first, then the languages within it.

A text becomes the L2-normed square roots of its counts of hashed letter n-grams. A linear support
vector machine for each family against the rest picks the family; within it, one linear machine for
each pair of languages votes. Learning reads all labelled rows that are not held out: they are dealt to
shards, each of which makes machines of its own in a task, and a machine of the model is the mean of
those of the shards. Predicting reads whole texts of all rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import arrow_schema, map_rows, to_batch
from orderlens.session import materialize

SHARD_ROWS = 2048
"""Expected rows of a shard; there are as many shards as all labelled rows take."""

LEAST_ROWS = 50
"""Rows of a language that each shard expects: a language with fewer for each has them in several shards."""

DIMENSIONS = 1 << 13
ORDERS = (1, 2, 3)
EPOCHS = 12
UNDETERMINED = "und"
LEAST_SCORE = 0.5
"""Score under which ``determined`` rejects a document: less than an even chance of the language."""

# Families of common languages. A language not named here is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "fy", "lb", "yi"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"],
    "slavic": ["ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"],
    "indo-aryan": ["hi", "ur", "bn", "mr", "gu", "pa", "ne", "si"],
    "semitic": ["ar", "he", "mt", "am"],
    "turkic": ["tr", "az", "kk", "uz", "ky", "tk", "tt"],
    "uralic": ["fi", "et", "hu"],
    "baltic": ["lt", "lv"],
    "austronesian": ["id", "ms", "tl", "jv"],
    "dravidian": ["ta", "te", "kn", "ml"],
}
_FAMILY_OF = {language: family for family, languages in FAMILIES.items() for language in languages}


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language.split("-")[0].lower(), language)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and L2-normed values of a text's n-gram features; empty where there is no letter."""
    index, counts = _gram_counts(text)
    values = np.sqrt(counts)
    return index, values / np.linalg.norm(values) if len(index) else values


def _gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and counts of a text's hashed n-grams; empty where there is no letter.

    Whatever is no letter counts as one space, so digits, marks and markup carry no information.
    """
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    if points.max() < len(_LETTER):
        letter = _LETTER[points]
    else:
        letter = np.fromiter(map(str.isalpha, text.lower()), bool, len(points))
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # a letter, or the first of what stands between letters
    codes = np.where(letter, points, 32)[keep].astype(np.uint64)
    codes = np.concatenate([np.array([32], np.uint64), codes])
    counts = np.zeros(DIMENSIONS, np.int64)
    hashed = np.zeros(len(codes), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        hashed = hashed[: len(codes) - order + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[order - 1 :]
        if order in ORDERS:
            slot = (hashed * np.uint64(0xD6E8FEB86659FD93) + np.uint64(order)) >> np.uint64(40)
            counts += np.bincount((slot % np.uint64(DIMENSIONS)).astype(np.int64), minlength=DIMENSIONS)
    index = np.flatnonzero(counts)
    return index, counts[index]


_LETTER = np.array([chr(i).isalpha() for i in range(0x2000)])


def _svm(x: np.ndarray, y: np.ndarray, strength: float = 1e-4) -> np.ndarray:
    """Weights, the bias last, of a linear machine with hinge loss; ``y`` is +1 or -1.

    Pegasos steps in a fixed pseudo-random order, averaged over the second half.
    """
    n, d = x.shape
    weights, mean = np.zeros(d), np.zeros(d)
    order = np.random.default_rng(0)
    share = np.where(y > 0, n / (2 * max((y > 0).sum(), 1)), n / (2 * max((y < 0).sum(), 1)))
    steps, batch, averaged = 0, 64, 0
    total = EPOCHS * -(-n // batch)
    for _ in range(EPOCHS):
        shuffled = order.permutation(n)
        for at in range(0, n, batch):
            steps += 1
            rows = shuffled[at : at + batch]
            wrong = rows[y[rows] * (x[rows] @ weights) < 1]
            rate = 1 / (strength * (steps + 1000))
            weights *= 1 - rate * strength
            weights += rate / len(rows) * ((share[wrong] * y[wrong]) @ x[wrong])
            if 2 * steps > total:
                mean += weights
                averaged += 1
    return mean / max(averaged, 1)


@dataclass
class Model:
    families: list[str]
    by_family: np.ndarray
    """One row of weights a family."""
    pairs: dict[str, list[tuple[str, str, np.ndarray]]]
    """Of each family: languages and weights of the machine between them, positive for the first."""
    languages: dict[str, list[str]]

    def predict(self, text: str | None) -> tuple[str, float]:
        index, values = grams(text)
        if not len(index) or not self.families:
            return UNDETERMINED, 0.0
        margins = self.by_family[:, index] @ values + self.by_family[:, -1]
        best = int(margins.argmax())
        family = self.families[best]
        likely = np.exp(2 * (margins - margins[best]))
        score = 1 / likely.sum()
        languages = self.languages[family]
        if len(languages) == 1:
            return languages[0], float(score)
        votes, surety = Counter(), Counter()
        for a, b, weights in self.pairs[family]:
            chance = 1 / (1 + np.exp(-4 * np.clip(weights[index] @ values + weights[-1], -10, 10)))
            votes[a if chance >= 0.5 else b] += 1
            surety[a] += chance
            surety[b] += 1 - chance
        winner = min(languages, key=lambda name: (-votes[name], -surety[name], name))
        return winner, float(np.clip(score * surety[winner] / (len(languages) - 1), 0, 1))


Row = tuple[str, np.ndarray, np.ndarray]


def _families(languages: Collection[str]) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for name in sorted(languages):
        found.setdefault(family_of(name), []).append(name)
    return found


def _machines(rows: list[Row]) -> Iterator[tuple[str, str, int, np.ndarray]]:
    """Machines of rows (language, feature indices, feature values): (family, "", rows, weights) of a family
    against the rest, and (language, other, rows, weights) of each pair; ``rows`` are those of the rarer side."""
    rows = sorted((r for r in rows if len(r[1])), key=lambda r: (r[0], len(r[1]), r[1].sum(), r[2].sum()))
    x = np.zeros((len(rows), DIMENSIONS + 1), np.float32)
    x[:, -1] = 1
    for row, (_, index, values) in zip(x, rows):
        row[index] = values
    names = np.array([r[0] for r in rows], object)
    of = np.array([family_of(name) for name in names], object)
    languages = _families(set(names))
    if len(languages) > 1:
        for family in sorted(languages):
            own = of == family
            yield family, "", min(own.sum(), (~own).sum()), _svm(x, np.where(own, 1.0, -1.0))
    for members in languages.values():
        for a, b in combinations(members, 2):
            both = (names == a) | (names == b)
            rarer = min((names == a).sum(), (names == b).sum())
            yield a, b, rarer, _svm(x[both], np.where(names[both] == a, 1.0, -1.0))


def _model(names: Collection[str], machines: dict[tuple[str, str], np.ndarray]) -> Model:
    languages = _families(names)
    families, none = sorted(languages), np.zeros(DIMENSIONS + 1)
    by_family = [machines.get((family, ""), none) for family in families]
    pairs = {
        family: [(a, b, machines.get((a, b), none)) for a, b in combinations(members, 2)]
        for family, members in languages.items()
    }
    return Model(families, np.array(by_family).reshape(-1, DIMENSIONS + 1), pairs, languages)


def fit(rows: list[Row]) -> Model:
    """A model of rows (language, feature indices, feature values) in memory; ``learn`` is for tables."""
    return _model({r[0] for r in rows if len(r[1])}, {(a, b): w for a, b, _, w in _machines(rows)})


def held_out(doc_id: str = "doc_id"):
    """Whether CRC-32 of the id as text leaves 2 of 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _features(lang: str, shards: list[int], text: str | None) -> Iterator[tuple]:
    """The features of a row for each of its shards, as steps between indices and as counts."""
    index, counts = _gram_counts(text)
    if len(index):
        steps, counts = np.diff(index, prepend=0).astype("<u2").tobytes(), counts.astype("<u4").tobytes()
        yield from ((shard, lang, steps, counts) for shard in shards)


def _row(lang: str, steps: bytes, counts: bytes) -> Row:
    values = np.sqrt(np.frombuffer(counts, "<u4"))
    return lang, np.frombuffer(steps, "<u2").astype(np.int64).cumsum(), values / np.linalg.norm(values)


def _shards(labelled: DataFrame, counts: dict[str, int]) -> tuple[int, Column]:
    """How many shards the rows are dealt to, and the shards of a row: one, or several where its language
    has too few rows for all."""
    n = -(-sum(counts.values()) // SHARD_ROWS)
    deals = {lang: min(n, max(1, rows // LEAST_ROWS)) for lang, rows in counts.items()}
    deal = F.create_map(*[F.lit(v) for pair in deals.items() for v in pair])[F.col("lang")]
    first = F.pmod(F.xxhash64("doc_id", F.lit("shard")), deal).cast("int")
    return n, F.sequence(first, F.lit(n - 1), deal)


def _sums(machines: DataFrame, key: Column) -> DataFrame:
    """Machines of each key added up in a fixed order, as sums are not the same in every order."""
    schema = "shard long, a string, b string, rows long, weights binary"
    fields = arrow_schema(machines.sparkSession, schema)

    def each(table: pa.Table) -> pa.Table:
        found: dict[tuple[str, str], list] = {}
        for r in sorted(table.to_pylist(), key=lambda r: (r["a"], r["b"], r["shard"])):
            total = found.setdefault((r["a"], r["b"]), [0, np.zeros(DIMENSIONS + 1)])
            total[0] += r["rows"]
            total[1] += np.frombuffer(r["weights"])
        shard = table["key"][0].as_py()
        rows = [(shard, a, b, n, total.tobytes()) for (a, b), (n, total) in found.items()]
        return pa.Table.from_batches([to_batch(rows, fields)])

    return machines.withColumn("key", key).groupBy("key").applyInArrow(each, schema)


def learn(docs: DataFrame) -> Model:
    """A model of all labelled rows that are not held out.

    Rows are dealt to shards by a hash of their ids. A machine of the model is the mean of the shards'
    machines, each by the rows of its rarer side. What reaches the driver is sums over about the square
    root of the shards.
    """
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out() & F.col("doc_id").isNotNull())
    counts = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().collect()}
    if not counts:
        return fit([])
    n, shards = _shards(labelled, counts)
    schema = "shard int, lang string, steps binary, counts binary"
    features = map_rows(labelled.select("lang", shards, "text"), _features, schema)
    made = "shard long, a string, b string, rows long, weights binary"
    fields = arrow_schema(docs.sparkSession, made)

    def each(table: pa.Table) -> pa.Table:
        found = zip(*(table[name].to_pylist() for name in ("lang", "steps", "counts")))
        rows = [_row(*r) for r in sorted(found)]
        shard = table["shard"][0].as_py()
        # A language that stands alone has no machine, but a place in the model.
        out = [(shard, lang, lang, 0, np.zeros(DIMENSIONS + 1).tobytes()) for lang in sorted({r[0] for r in rows})]
        out += [(shard, a, b, int(rarer), (rarer * w).tobytes()) for a, b, rarer, w in _machines(rows)]
        return pa.Table.from_batches([to_batch(out, fields)])

    machines = materialize(features.repartition(n, "shard").groupBy("shard").applyInArrow(each, made))
    summed = _sums(machines, F.pmod(F.col("shard"), F.lit(max(1, round(n**0.5)))))
    total: dict[tuple[str, str], list] = {}
    for r in summed.orderBy("shard", "a", "b").collect():
        sums = total.setdefault((r["a"], r["b"]), [0, np.zeros(DIMENSIONS + 1)])
        sums[0] += r["rows"]
        sums[1] += np.frombuffer(r["weights"])
    names = {a for a, b in total if a == b}
    return _model(names, {pair: w / rows for pair, (rows, w) in total.items() if rows})


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred and score.

    Only the text is read for a prediction. A null text, one without a letter, and any text where
    nothing was learned is ``und`` with score 0. Equal texts get equal predictions; repeated rows and
    null ids stay; further columns are not read.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def each(doc_id: int | None, held: bool, text: str | None) -> Iterator[tuple]:
        yield doc_id, held, *broadcast.value.predict(text)

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return map_rows(rows, each, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, learn(docs))


def determined(
    docs: DataFrame, least_score: float = LEAST_SCORE, wanted: Collection[str] | None = None
) -> DataFrame:
    """The rows of ``docs``, all columns, in a language that a model learned from ``docs`` tells apart.

    A document is rejected where its prediction is ``und``, its score is under ``least_score``, or its
    language is none of ``wanted`` (None: any learned language). The score is low where the machines do not
    tell the languages apart, as in a mixture; text in a language that was never learned is not always
    told from those that were. Where nothing can be learned, the rows whose
    text has a letter stay. Only the text decides, so equal texts stay or go together.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(learn(docs))

    def known(text: str | None) -> bool:
        model = broadcast.value
        if not model.families:
            return len(grams(text)[0]) > 0
        language, score = model.predict(text)
        return language != UNDETERMINED and score >= least_score and (wanted is None or language in wanted)

    def keep(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([known(text) for text in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
