"""Documents drawn towards a target distribution, by the importance of their words.

A ``tokenizers`` pre-tokeniser that was never trained, a split by one regular expression, gives the
words of the text in lower case with their offsets. Runs of words, cut by pairs of offsets, fall into
buckets by their CRC; how often a bucket is met in the target and in the documents gives its gain, and
the mean gain of a document's runs its weight. Gumbel noise from the document's id makes the highest
scores a draw without replacement in proportion to the weights' exponentials.

A document's buckets are stored once and read three times: for the counts, the weights and the ranks.
Only counts per bucket reach the driver.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import arrow_schema
from orderlens.llm.places import numbered
from orderlens.session import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
"""What is no part of a word before A to Z are lower-cased."""
PIECE = 1 << 18
"""A longer text is split piece by piece, each of this many characters and the rest of its last word."""
KNOWN = 500_000
"""Runs whose bucket a task remembers."""
SCALE = 1000


@dataclass(frozen=True)
class Features:
    """Runs of ``least`` to ``most`` words, in so many buckets."""

    least: int = 1
    most: int = 1
    buckets: int = 10_000

    def __post_init__(self):
        if not 1 <= self.least <= self.most or self.buckets < 1:
            raise ValueError("runs need 1 <= least <= most, and there must be a bucket")


class Splitter:
    """Words of a text with their offsets, by an untrained split."""

    def __init__(self):
        from tokenizers import Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True).pre_tokenize_str

    def pieces(self, text: str) -> Iterator[str]:
        """The text in lower case (A to Z only), cut between words."""
        start = 0
        while start < len(text):
            cut = _BETWEEN.search(text, start + PIECE)
            end = cut.start() if cut else len(text)
            # Lower-casing bytes changes the letters A to Z and nothing else.
            yield text[start:end].encode().lower().decode()
            start = end

    def runs(self, text: str, shape: Features) -> Iterator[tuple[int, list[str]]]:
        """Of each piece the number of its words, and the runs that end in it."""
        carried: list[str] = []
        for piece in self.pieces(text):
            offsets = [pair for _, pair in self.split(piece)]
            words = carried + [piece[start:end] for start, end in offsets]
            new = len(carried)
            found = []
            for length in range(shape.least, shape.most + 1):
                begin = max(0, new - length + 1)
                if length == 1:
                    found += words[begin:]
                else:
                    found += [" ".join(words[i : i + length]) for i in range(begin, len(words) - length + 1)]
            yield len(offsets), found
            carried = words[len(words) - shape.most + 1 :] if shape.most > 1 else []


class Buckets(dict):
    """Bucket of each run of words, remembered up to a bound."""

    def __init__(self, count: int):
        super().__init__()
        self.count = count

    def __missing__(self, run: str) -> int:
        bucket = zlib.crc32(run.encode()) % self.count
        if len(self) >= KNOWN:
            self.clear()
        self[run] = bucket
        return bucket


_BUCKETS = "doc_id long, n_words long, buckets array<int>"


def buckets_of(texts: DataFrame, shape: Features) -> DataFrame:
    """``texts`` holds an id and a text; a row of doc_id, n_words and the buckets of all runs for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, known = Splitter(), Buckets(shape.buckets)
        for batch in batches:
            counts, lengths, found = [], [0], []
            for text in batch.column(1):
                words = length = 0
                for n, runs in splitter.runs(text.as_py() or "", shape):
                    words += n
                    length += len(runs)
                    found.append(np.array([known[r] for r in runs], np.int32))
                counts.append(words)
                lengths.append(length)
            values = np.concatenate(found) if found else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(lengths).astype(np.int32)), pa.array(values))
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), lists], names=names)

    names = arrow_schema(texts.sparkSession, _BUCKETS).names
    return texts.mapInArrow(run, _BUCKETS)


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and where each row's begin and the last one's end."""
    column = batch.column(batch.schema.get_field_index(name))
    ends = column.offsets.to_numpy()
    return column.values.to_numpy()[ends[0] : ends[-1]], ends - ends[0]


def histogram(bucketed: DataFrame, shape: Features) -> np.ndarray:
    """How often each bucket is met: every task sends at most one row per bucket."""
    schema = "bucket int, met long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(shape.buckets, np.int64)
        for batch in batches:
            met += np.bincount(_lists(batch, "buckets")[0], minlength=shape.buckets)
        seen = np.flatnonzero(met)
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(met[seen])], names=["bucket", "met"])

    counted = bucketed.select("buckets").mapInArrow(run, schema).groupBy("bucket").agg(F.sum("met").alias("met"))
    result = np.zeros(shape.buckets, np.int64)
    for row in counted.collect():
        result[row["bucket"]] = row["met"]
    return result


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Of each bucket the log of its smoothed share in the target over that in the source, in
    thousandths, rounded down."""
    size = len(source)
    in_target, in_source = float(target.sum() + size), float(source.sum() + size)
    return np.array(
        [
            math.floor(SCALE * math.log((t + 1.0) * in_source / ((s + 1.0) * in_target)))
            for t, s in zip(target.tolist(), source.tolist())
        ],
        np.int64,
    )


def weights(bucketed: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight, the mean gain rounded down (0 without a run)."""
    schema = "doc_id long, n_words long, n_features long, weight long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, ends = _lists(batch, "buckets")
            summed = np.concatenate([[0], np.cumsum(gain[values])])
            total, n = summed[ends[1:]] - summed[ends[:-1]], np.diff(ends).astype(np.int64)
            mean = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.record_batch([*batch.columns[:2], pa.array(n), pa.array(mean)], names=fields)

    fields = arrow_schema(bucketed.sparkSession, schema).names
    return bucketed.select("doc_id", "n_words", "buckets").mapInArrow(run, schema)


def noise(seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of seed and id (null: no digits)."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    uniform = (F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-float(SCALE) * F.log(-F.log(uniform)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    shape: Features = Features(),
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score and rank (null if it was not drawn).

    Of the N documents with at least ``least_words`` words, floor(percent * N / 100) are drawn: the
    highest scores, of equal ones the smaller doc_id (null last, then the smaller weight). A null or
    empty text has no word, the weight 0, and is never drawn. Repeated rows count and are drawn each for
    itself. An empty target leaves every gain to the documents' counts alone; empty documents give an
    empty result. Other columns, whatever their names, are not looked at.
    """
    if not 0 <= percent <= 100:
        raise ValueError("percent is from 0 to 100")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    bucketed = materialize(buckets_of(texts, shape))
    wanted = buckets_of(target.select(F.lit(0).cast("long").alias("doc_id"), F.col(text).alias("text")), shape)
    gain = gains(histogram(wanted, shape), histogram(bucketed, shape))

    def scored(rows: DataFrame) -> DataFrame:
        weighed = weights(rows, gain)
        return weighed.withColumn("score", F.col("weight") + noise(seed))

    enough = F.col("n_words") >= least_words
    candidates = scored(bucketed.where(enough)).withColumn("row", F.monotonically_increasing_id())
    ranked = numbered(candidates, F.desc("score"), F.asc_nulls_last("doc_id"), "weight", "row")
    drawn = ranked.count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    rank = F.when(F.col("number") < drawn, F.col("number") + 1)
    short = scored(bucketed.where(~enough)).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank.alias("rank")).union(short)
