"""SimHash near-duplicates, found by multi-index hashing.

A fingerprint has 64 bits. Two that differ in at most three bits differ in at most one bit of their
upper or of their lower half, so each half is a table key, each fingerprint looks up the Hamming ball
of radius one around its own halves, and every match is verified on all 64 bits. Of two keys that
differ in one bit exactly one lacks that bit, so the ball is enumerated upwards only (the key, and
the key with one clear bit set): each pair is met from one side, at half the look-ups.

A key that many different fingerprints share (a dense group of near copies) would make all of its
pairs candidates. Its look-ups carry a second key: the rest of the distance, at most three, again
leaves at most one bit in one of the quarters of the other half, so the same ball is enumerated there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import map_rows
from orderlens.llm.components import connected
from orderlens.session import materialize

SHINGLE = 3
MAX_BITS = 3
SEED = 42
CROWDED = 128
"""Table entries of one key from which look-ups carry a second key. Both ways give the same pairs."""

_LANES = np.uint64(0x0101010101010101)
_ROUND = 255


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint: a bit is set if over half of the shingles' hashes have it.

    Fewer words than a shingle hash as one sequence. No word, or a null text, gives zero.
    """
    # On bytes, lower() and split() know exactly A-Z and the six white-space bytes.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    return _majority(np.array(hashes, np.uint64))


def _majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, counted in eight byte-wide lanes of a word at a time."""
    rounds = np.arange(0, len(hashes), _ROUND)
    counts = np.empty((8, 8), np.int64)
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, rounds)
        counts[:, bit] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    majority = counts.ravel() * 2 > len(hashes)
    return int(np.packbits(majority, bitorder="little").view(np.uint64)[0])


class _Fingerprints:
    def __init__(self, shingle: int = SHINGLE):
        self.shingle = shingle

    def __call__(self, doc_id: int | None, text: str | None) -> Iterator[tuple]:
        value = fingerprint(text, self.shingle)
        yield doc_id, value - (1 << 64) if value >> 63 else value


def _keyed(shingle: int):
    prints = _Fingerprints(shingle)

    def each(doc_id: int | None, text: str | None, k1: int, k2: int) -> Iterator[tuple]:
        for _, fp in prints(doc_id, text):
            yield doc_id is None, doc_id, k1, k2, fp

    return each


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and the fingerprint ``fp`` as a signed long."""
    return map_rows(docs.select("doc_id", "text"), _Fingerprints(shingle).__call__, "doc_id long, fp long")


def _ball(value, bits: int):
    """The value, and the value with one clear bit of its lowest ``bits`` set."""
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(bits - 1)),
        lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), b),
    )
    clear = F.filter(flips, lambda flip: value.bitwiseAND(flip) == 0)
    return F.concat(F.array(value), F.transform(clear, lambda flip: value.bitwiseOR(flip)))


def _halves(distinct: DataFrame) -> DataFrame:
    """Two rows a fingerprint: its half as ``own``, the half's number, and the other half."""
    upper = F.shiftrightunsigned("fp", 32)
    lower = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    sides = F.array(
        F.struct(F.lit(0).alias("side"), upper.alias("own"), lower.alias("other")),
        F.struct(F.lit(1).alias("side"), lower.alias("own"), upper.alias("other")),
    )
    return distinct.select("fp", F.inline(sides))


def _key(side, half):
    """One long for a half and its number."""
    return half.bitwiseOR(F.shiftleft(side.cast("long"), 32))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, crowded: int = CROWDED) -> DataFrame:
    """Pairs ``a``, ``b`` of the different fingerprints in ``fp`` that differ in at most ``max_bits`` bits.

    A pair may come twice, once from each half.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves looked up at radius one find at most three differing bits")
    halves = _halves(distinct)
    entries = halves.select(_key(F.col("side"), F.col("own")).alias("key"), F.col("fp").alias("b"), "other")
    probes = halves.select(
        F.col("fp").alias("a"),
        "other",
        F.explode(F.transform(_ball(F.col("own"), 32), lambda h: _key(F.col("side"), h))).alias("key"),
    )
    busy = materialize(entries.groupBy("key").count().where(F.col("count") >= crowded).select("key"))
    pair = ["a", "b"]
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    found = (F.col("a") != F.col("b")) & near
    if busy.isEmpty():
        return probes.drop("other").join(entries.drop("other"), "key").where(found).select(pair)
    plain = probes.join(busy, "key", "left_anti").drop("other").join(entries.drop("other"), "key")
    second = probes.join(busy, "key", "left_semi").select("a", "key", _quarters(F.col("other"), ball=True))
    shelf = entries.join(busy, "key", "left_semi").select("b", "key", _quarters(F.col("other"), ball=False))
    both = second.join(shelf, ["key", "quarter"])
    return plain.where(found).select(pair).union(both.where(found).select(pair).distinct())


def _quarters(half, ball: bool):
    """The quarters of a half, each with its number; or what its ball of radius one holds.

    The other half's difference may lie on either side here, so the ball is enumerated both ways.
    """
    sides = []
    for number, quarter in ((0, F.shiftrightunsigned(half, 16)), (1, half.bitwiseAND(F.lit(0xFFFF)))):
        tagged = quarter.bitwiseOR(F.lit(number << 16).cast("long"))
        flips = [tagged] + [tagged.bitwiseXOR(F.lit(1 << b).cast("long")) for b in range(16) if ball]
        sides += flips
    return F.explode(F.array(*sides)).alias("quarter")


def _grouped(stored: DataFrame, first, max_bits: int) -> DataFrame:
    """Per fingerprint ``fp``, ``first`` over its rows, and ``root``, which names its component."""
    distinct = materialize(stored.groupBy("fp").agg(first.alias("first")))
    roots = connected(links(distinct.select("fp"), max_bits), "a", "b")
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``.

    Equal fingerprints are one node whatever the number of their documents; nodes within ``max_bits``
    bits are linked; ``component_id`` is the smallest doc_id reachable, the document's own included.
    Null and empty texts have the fingerprint zero and link like any other. A null doc_id takes part
    and is never the smallest; where a component has no other, its id is null. Repeated rows stay.
    """
    stored = materialize(fingerprints(docs, shingle))
    grouped = _grouped(stored, F.min("doc_id"), max_bits)
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(grouped.join(smallest, "root").select("fp", "component_id"))
    return stored.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def distinct(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs``, all columns, with one row of each group of near-duplicates: that of the smallest doc_id.

    Rows are told by id and text. Of several texts under one id the one of the smallest hash counts; a
    row without an id is kept where its group has no other. Equal rows count once.
    """
    content = F.coalesce(F.col("doc_id"), F.lit(0)), F.col("doc_id").isNull(), F.coalesce(F.col("text"), F.lit(""))
    # Names that no column of the rows has, in any case of letters.
    taken = max(map(len, docs.columns))
    first, second = (f"key {n} " + "_" * taken for n in (1, 2))
    keyed = {first: F.xxhash64(*content), second: F.xxhash64(F.lit("second"), *content)}
    own = docs.select("doc_id", "text", *(key.alias(name) for name, key in keyed.items()))
    stored = materialize(map_rows(own, _keyed(shingle), "none boolean, id long, k1 long, k2 long, fp long"))
    grouped = _grouped(stored, F.min(F.struct("none", "id", "k1", "k2")), max_bits)
    kept = grouped.groupBy("root").agg(F.min("first").alias("first"))
    kept = materialize(kept.select(*(F.col(f"first.k{i}").alias(name) for i, name in enumerate(keyed, 1))))
    rows = docs.withColumns(keyed).join(kept, list(keyed), "left_semi").dropDuplicates(list(keyed))
    return rows.select(docs.columns)
