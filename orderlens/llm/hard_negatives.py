"""Hard negatives: rows of another label that an anchor scores nearly as high as a row of its own.

Vectors are turned into integers and rotated; of a rotated vector x one bit per dimension is kept, the
unit code c of its signs, with the alignment <x, c> and the norm. For an anchor q, whose rotated
components are rounded to a few bits, popcounts of bit planes give <q, c> up to a known rounding error.
What x and q have beside c meets only in their residuals, so by Cauchy and Schwarz

    <q, x> = <x, c> <q, c> + r,   |r| <= sqrt(|q|^2 - <q, c>^2) * sqrt(|x|^2 - <x, c>^2).

The interval is certain, not likely: a candidate is dropped only if it cannot be among the first, and
each one whose interval survives is scored as an integer. So the answer does not depend on the codes.

Anchors meet rows in blocks of bounded size: rows are dealt to blocks by their number, anchors too, and
each pair of blocks is one group of a cogroup. For the positives only blocks of one label meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.llm.common import arrow_schema
from orderlens.session import materialize

ROW_BLOCK = 16_384
ANCHOR_BLOCK = 8_192
BLOCK_VALUES = 1 << 21
"""Components that a block holds at most: blocks of long vectors hold fewer rows."""
PLANES = 6
"""Bits of an anchor's rotated component."""
PAIRS = 1 << 18
"""Pairs that a task bounds or scores at a time."""
SLACK = 1e-9
"""Part of both norms' product by which an interval is widened for rounding of doubles."""
EXACT = 2.0**31
"""Integer vectors up to this norm are multiplied as longs; their products stay below 2^62."""

_CODED = "vec_id long, label int, anchor boolean, vector array<double>, code array<long>, aligned double, norm double"


def _rotation(dimensions: int, made: dict[int, np.ndarray]) -> np.ndarray:
    """The same random rotation everywhere."""
    if dimensions not in made:
        normal = np.random.default_rng(dimensions).standard_normal((dimensions, dimensions))
        made[dimensions] = np.linalg.qr(normal)[0]
    return made[dimensions]


def _words(bits: np.ndarray) -> np.ndarray:
    """Bits along the last axis as 64-bit words."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    spare = -packed.shape[-1] % 8
    packed = np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, spare)])
    return np.ascontiguousarray(packed).view(np.uint64)


def _by_length(lists: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of equally long lists: length, their places, and the matrix of their values."""
    ends = lists.offsets.to_numpy()
    values, lengths = lists.values.to_numpy(zero_copy_only=False), np.diff(ends)
    for length in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == length)
        yield length, places, values[ends[places][:, None] + np.arange(length)]


def code(rows: DataFrame) -> DataFrame:
    """``rows`` holds vec_id, label, anchor and an embedding of finite doubles; adds what the search needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, places, found in _by_length(batch.column(3)):
                vectors = np.floor(256.0 * found)
                rotated = vectors @ _rotation(length, made).T
                words = _words(rotated >= 0).view(np.int64)
                some = batch.take(pa.array(places))
                columns = [
                    *some.columns[:3],
                    _lists(vectors),
                    _lists(words),
                    pa.array(np.abs(rotated).sum(axis=1) / math.sqrt(max(length, 1))),
                    pa.array(np.sqrt((vectors * vectors).sum(axis=1))),
                ]
                yield pa.record_batch([c.cast(f.type) for c, f in zip(columns, fields)], schema=fields)

    fields = arrow_schema(rows.sparkSession, _CODED)
    return rows.select("vec_id", "label", "anchor", "embedding").mapInArrow(run, _CODED)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(matrix.ravel()))


class Side:
    """Rows of one block that have vectors of one length."""

    def __init__(self, table: pa.Table, places: np.ndarray, vectors: np.ndarray):
        some = table.take(pa.array(places))
        self.number = some["number"].to_numpy()
        ids = some["vec_id"]
        self.id = ids.fill_null(0).to_numpy()
        self.unnamed = ids.is_null().to_numpy()
        self.label = some["label"].to_numpy()
        self.aligned, self.norm = some["aligned"].to_numpy(), some["norm"].to_numpy()
        codes = some["code"].combine_chunks()
        self.code = codes.flatten().to_numpy().view(np.uint64).reshape(len(places), -1)
        self.vectors = vectors
        self.small = self.norm <= EXACT
        self.whole = np.where(self.small[:, None], vectors, 0).astype(np.int64)
        self.table = some


def _sides(table: pa.Table) -> dict[int, Side]:
    lists = table["vector"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    return {length: Side(table, places, found) for length, places, found in _by_length(lists)}


class Query:
    """Anchors as bit planes of their rotated components."""

    def __init__(self, anchors: Side, length: int):
        self.length, self.norm = length, anchors.norm
        rotated = anchors.vectors @ _rotation(length, {}).T
        low, high = (rotated.min(axis=1), rotated.max(axis=1)) if length else (self.norm, self.norm)
        step = (high - low) / (2**PLANES - 1)
        with np.errstate(invalid="ignore", divide="ignore"):
            levels = np.nan_to_num(np.rint((rotated - low[:, None]) / step[:, None]), posinf=0, neginf=0)
        self.low, self.step = low, step
        self.error = np.abs(rotated - low[:, None] - step[:, None] * levels).sum(axis=1)
        levels = levels.astype(np.int64)
        self.total = levels.sum(axis=1)
        self.planes = [_words((levels >> plane) & 1) for plane in range(PLANES)]

    def bounds(self, some: slice, rows: Side) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible product of some anchors with every row."""
        ones = np.bitwise_count(rows.code).sum(axis=1, dtype=np.int64)
        met = np.zeros((len(self.norm[some]), len(rows.norm)), np.int64)
        for plane, words in enumerate(self.planes):
            for word in range(rows.code.shape[1]):
                both = np.bitwise_count(words[some][:, word, None] & rows.code[None, :, word])
                met += both.astype(np.int64) << plane
        root = math.sqrt(max(self.length, 1))
        norm = self.norm[some][:, None]
        with np.errstate(invalid="ignore", over="ignore"):
            signed = self.low[some][:, None] * (2 * ones - self.length) + self.step[some][:, None] * (
                2 * met - self.total[some][:, None]
            )
            along, error = signed / root, self.error[some][:, None] / root
            least = np.maximum(np.abs(along) - error, 0)
            beside = np.sqrt(np.maximum(norm**2 - least**2, 0)) * np.sqrt(
                np.maximum(rows.norm**2 - rows.aligned**2, 0)
            )
            reach = rows.aligned * error + beside + SLACK * norm * rows.norm
            middle = rows.aligned * along
            return middle - reach, middle + reach


def _scores(anchors: Side, a: np.ndarray, rows: Side, r: np.ndarray) -> np.ndarray:
    """Integer products of pairs; those that might pass a long are multiplied as Python integers."""
    result = np.empty(len(a), np.int64)
    part = max(1, PAIRS // max(1, anchors.vectors.shape[1]))
    for start in range(0, len(a), part):
        cut = slice(start, start + part)
        result[cut] = np.einsum("ij,ij->i", anchors.whole[a[cut]], rows.whole[r[cut]])
    for i in np.flatnonzero(~(anchors.small[a] & rows.small[r])).tolist():
        score = sum(int(x) * int(y) for x, y in zip(anchors.vectors[a[i]], rows.vectors[r[i]]))
        if abs(score) >= 1 << 63:
            raise OverflowError("a score does not fit a long")
        result[i] = score
    return result


def _first(anchors: np.ndarray, rows: Side, r: np.ndarray, scores: np.ndarray, count: int) -> np.ndarray:
    """Places of each anchor's first pairs: higher scores, then smaller ids, unnamed ones last."""
    order = np.lexsort((rows.number[r], rows.id[r], rows.unnamed[r], -scores, anchors))
    of = anchors[order]
    begins = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)
    place = np.arange(len(of)) - np.repeat(begins, np.diff(np.r_[begins, len(of)]))
    return order[place < count]


def _floor(low: np.ndarray, allowed: np.ndarray, count: int) -> np.ndarray:
    """Per anchor a score that ``count`` allowed rows certainly reach, minus infinity if there are fewer."""
    certain = np.where(allowed & ~np.isnan(low), low, -np.inf)
    if certain.shape[1] < count:
        return np.full((len(certain), 1), -np.inf)
    return np.partition(certain, certain.shape[1] - count, axis=1)[:, -count][:, None]


def _steps(query: Query, rows: Side) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    step = max(1, PAIRS // max(1, len(rows.norm)))
    for start in range(0, len(query.norm), step):
        some = slice(start, start + step)
        yield some, *query.bounds(some, rows)


_POSITIVES = "anchor_number long, anchor_id long, other_number long, other_id long, score long"


def _positives_of(count: int, names: list[str]):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        others = _sides(right)
        for length, anchors in _sides(left).items():
            if (rows := others.get(length)) is None:
                continue
            query = Query(anchors, length)
            for some, low, high in _steps(query, rows):
                other = anchors.number[some][:, None] != rows.number[None, :]
                floor = _floor(low, other, count)
                a, r = np.nonzero(other & ~(high < floor))
                a += some.start
                scores = _scores(anchors, a, rows, r)
                best = _first(a, rows, r, scores, count)
                a, r, scores = a[best], r[best], scores[best]
                out.append(_found(anchors, a, rows, r, scores))
        return _table(out, names)

    return run


_NEGATIVES = "anchor_number long, anchor_id long, other_number long, other_id long, score long, positive_score long"


def _negatives_of(count: int, low_percent: int, names: list[str]):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        others = _sides(right)
        for length, anchors in _sides(left).items():
            if (rows := others.get(length)) is None:
                continue
            query = Query(anchors, length)
            wanted = anchors.table["positive_scores"].to_pylist()
            most = max(map(len, wanted))
            # Past the end of a shorter list the last score again; what it finds twice is sent once.
            tops = np.array([(s + [s[-1]] * most)[:most] for s in wanted], np.int64)
            # The least score n with low_percent * p <= 100 * n, in integers.
            floors = np.array([[-(-low_percent * p // 100) for p in s] for s in tops.tolist()], np.int64)
            for some, low, high in _steps(query, rows):
                different = anchors.label[some][:, None] != rows.label[None, :]
                kept = np.zeros(different.shape, bool)
                for top, least in zip(tops[some].T.astype(float), floors[some].T.astype(float)):
                    certain = _floor(low, different & (high <= top[:, None]), count)
                    kept |= different & ~(low > top[:, None]) & ~(high < np.maximum(certain, least[:, None]))
                a, r = np.nonzero(kept)
                a += some.start
                scores = _scores(anchors, a, rows, r)
                for j in range(most):
                    new = tops[a, j] != tops[a, j - 1] if j else np.ones(len(a), bool)
                    within = np.flatnonzero(new & (scores <= tops[a, j]) & (scores >= floors[a, j]))
                    best = within[_first(a[within], rows, r[within], scores[within], count)]
                    found = _found(anchors, a[best], rows, r[best], scores[best])
                    out.append([*found, pa.array(tops[a[best], j])])
        return _table(out, names)

    return run


def _found(anchors: Side, a: np.ndarray, rows: Side, r: np.ndarray, scores: np.ndarray) -> list[pa.Array]:
    anchor_ids = pa.array(anchors.id[a], mask=anchors.unnamed[a])
    ids = pa.array(rows.id[r], mask=rows.unnamed[r])
    return [pa.array(anchors.number[a]), anchor_ids, pa.array(rows.number[r]), ids, pa.array(scores)]


def _table(parts: list[list[pa.Array]], names: list[str]) -> pa.Table:
    if not parts:
        return pa.table([pa.array([], pa.int64())] * len(names), names=names)
    return pa.table([pa.concat_arrays(column) for column in zip(*parts)], names=names)


def _block(count: Column, size: int, salt: str) -> Column:
    """A row's block: its number's hash, over as many blocks as hold ``size`` rows each on average."""
    return F.pmod(F.xxhash64(F.lit(salt), "number"), F.ceil(count / F.lit(size)))


def _all_blocks(count: Column, size: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(count / F.lit(size)) - 1))


def _again(frame: DataFrame) -> DataFrame:
    """The same rows under columns of their own, so that a frame can meet itself."""
    return frame.select(*[F.col(c).alias(c) for c in frame.columns])


def _leading(found: DataFrame, count: int, *by: str) -> DataFrame:
    """The first rows of each anchor over all blocks."""
    order = W.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other_number")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)


def mine(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low_percent: int = 80,
    row_block: int = ROW_BLOCK,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``rows`` holds vec_id, label and embedding; rows where ``anchor`` is true are anchors. Components
    become floor(256 * x); a score is an integer product. An anchor's positives are the first rows of
    its label other than itself, its negatives for a positive the first rows of another label with
    low_percent * positive_score <= 100 * negative_score <= 100 * positive_score.

    Rows with a null label, a null vector, or any null or non-finite component take no part. A null
    vec_id comes after all others in a tie. Rows that repeat a vec_id are rows of their own: each may
    be the other's positive, and repeated anchors give their results once each. Vectors of different
    lengths have no product and never meet; those without components score 0. A score that does not fit
    a long fails the query. An empty table, or one without anchors, gives no rows. Further columns,
    whatever their names, are not looked at.
    """
    spark = rows.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("int").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    coded = materialize(code(usable).withColumn("number", F.monotonically_increasing_id()))
    totals = coded.agg(F.count("*"), F.count_if("anchor"), F.max(F.size("vector"))).first()
    longest = max(1, totals[2] or 0)
    row_block, anchor_block = (max(1, min(size, BLOCK_VALUES // longest)) for size in (row_block, anchor_block))
    # Written, so that a label with very many rows can be split in the join.
    sizes = materialize(
        coded.groupBy("label")
        .agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors"))
        .where("anchors > 0")
    )
    sized = coded.join(sizes, "label")
    row_count, anchor_count = F.col("rows"), F.col("anchors")

    own = sized.where("anchor").withColumns(
        {"g": _all_blocks(row_count, row_block), "a": _block(anchor_count, anchor_block, "anchor")}
    )
    fellows = _again(sized).withColumns(
        {"g": _block(row_count, row_block, "row"), "a": _all_blocks(anchor_count, anchor_block)}
    )
    kinds = arrow_schema(spark, _POSITIVES).names
    found = (
        own.groupBy("label", "g", "a")
        .cogroup(fellows.groupBy("label", "g", "a"))
        .applyInArrow(_positives_of(positives, kinds), _POSITIVES)
    )
    best = materialize(_leading(found, positives, "anchor_number"))

    # A positive below zero has no negative: 80 % of it is more than all of it.
    scores = best.where("score >= 0").groupBy("anchor_number")
    scores = scores.agg(F.sort_array(F.collect_set("score"), asc=False).alias("positive_scores"))
    asking = coded.where("anchor").join(scores.withColumnRenamed("anchor_number", "number"), "number")
    row_count, anchor_count = (F.lit(max(1, n)) for n in totals[:2])
    asking = asking.withColumns(
        {"g": _all_blocks(row_count, row_block), "a": _block(anchor_count, anchor_block, "anchor")}
    )
    others = _again(coded).withColumns(
        {"g": _block(row_count, row_block, "row"), "a": _all_blocks(anchor_count, anchor_block)}
    )
    kinds = arrow_schema(spark, _NEGATIVES).names
    found = (
        asking.groupBy("g", "a")
        .cogroup(others.groupBy("g", "a"))
        .applyInArrow(_negatives_of(negatives, low_percent, kinds), _NEGATIVES)
    )
    hard = _leading(found, negatives, "anchor_number", "positive_score").select(
        "anchor_number",
        "positive_score",
        F.col("other_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
        F.col("place").alias("rank"),
    )
    of = best.select(
        "anchor_number", "anchor_id", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return of.join(hard, ["anchor_number", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
