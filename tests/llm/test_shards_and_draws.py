"""Sharding, hard negatives and resampling against plain versions, with nulls, ties, repeats and long texts."""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import hard_negatives, resampling, sharding
from orderlens.llm.places import numbered
from orderlens.llm.queries import ORACLE, QUERIES
from registry.compare import connect, difference

SAMPLE = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, shard int, number long, k1 string, size string"


def docs(spark, rows):
    """Documents with columns named like those an operator adds."""
    return spark.createDataFrame([(*row, 3, 4, "x", "y") for row in rows], DOCS)


@pytest.mark.parametrize("name", ["op11_sharding", "op12_hard_negative_mining", "op13_importance_resampling"])
def test_query_equals_its_sql(spark, name):
    assert name in ORACLE
    problem, rows = difference_of(spark, name)
    assert not problem
    assert rows > 0


def difference_of(spark, name):
    connection = connect(SAMPLE)
    frame = QUERIES[name](spark, SAMPLE)
    from registry import compare

    before, compare.ORACLE = compare.ORACLE, ORACLE
    try:
        return difference(connection, name, frame)
    finally:
        compare.ORACLE = before


def test_numbers_follow_the_order_whatever_the_partitions(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3]), i) for i in range(500)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "a int, b long").repartition(7)
    got = numbered(frame, F.asc_nulls_last("a"), F.desc("b")).collect()
    assert sorted(r.number for r in got) == list(range(500))
    placed = [(r.a, r.b) for r in sorted(got, key=lambda r: r.number)]
    assert placed == sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, -r[1]))
    assert numbered(frame.limit(0), "a", "b").count() == 0


# Sharding


def plain_shards(sizes, shards):
    """Each group in order to the lightest shard."""
    heap, dealt = [(0, s) for s in range(shards)], []
    for size in sizes:
        load, shard = heapq.heappop(heap)
        dealt.append(shard)
        heapq.heappush(heap, (load + size, shard))
    return dealt


def test_turns_deal_as_single_groups_would():
    rng = random.Random(4)
    for trial in range(60):
        shards = rng.choice([1, 2, 5, 24])
        big = [rng.randint(500, 20_000) for _ in range(rng.randint(0, 4))]
        small = [rng.choice([8, 9, 12, 40, 41, 300]) for _ in range(rng.randint(0, 700))]
        sizes = sorted(big + small, reverse=True)
        loads, dealt = sharding.Loads(shards), []
        for size, groups in sorted(Counter(sizes).items(), reverse=True):
            steps = list(loads.put(size, groups))
            assert len(steps) <= shards
            for taken, turn in steps:
                dealt += [turn[i % len(turn)] for i in range(taken)]
        assert dealt == plain_shards(sizes, shards), trial
        assert sorted(loads.heap) == sorted(
            (sum(s for s, d in zip(sizes, dealt) if d == shard), shard) for shard in range(shards)
        )


def test_very_many_equal_groups_take_few_steps():
    loads = sharding.Loads(24)
    list(loads.put(10**13, 1))
    steps = list(loads.put(8, 10**12))
    assert len(steps) <= 24 and sum(taken for taken, _ in steps) == 10**12
    others = [load for load, _ in loads.heap if load != 10**13]
    assert len(others) == 23 and max(others) - min(others) <= 8


def plain_assignment(rows, shards):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    order = sorted(
        groups.items(),
        key=lambda g: (-len(g[1]) * (len(g[0].encode()) + 8), min((i for i in g[1] if i is not None), default=10**9)),
    )
    dealt = plain_shards([len(ids) * (len(text.encode()) + 8) for text, ids in order], shards)
    return {text: shard for (text, _), shard in zip(order, dealt)}


@pytest.mark.parametrize("case", ["mixed", "one_hot_group", "ties", "few"])
def test_shards_equal_the_plain_schedule(spark, case):
    rng = random.Random(5)
    rows = {
        "mixed": [(i, "é" * rng.randint(0, 60)) for i in range(300)] + [(900, None), (901, "")],
        "one_hot_group": [(i, "same" if i % 3 == 0 else f"own {i}") for i in range(300)],
        "ties": [(i, f"{i:05d}") for i in range(200)],
        "few": [(1, "a"), (2, "x" * 300_000)],
    }[case]
    rng.shuffle(rows)
    got = sharding.assign(docs(spark, rows), 5).collect()
    shard_of = plain_assignment(rows, 5)
    text_of = dict(rows)
    assert sorted(r.doc_id for r in got) == sorted(text_of)
    slots = defaultdict(list)
    for r in got:
        text = text_of[r.doc_id] or ""
        assert r.size == len(text.encode()) + 8
        assert r.text_crc32 == zlib.crc32(text.encode())
        assert r.shard == shard_of[text]
        slots[r.shard].append((r.slot, r.doc_id))
    for placed in slots.values():
        assert [slot for slot, _ in sorted(placed)] == list(range(len(placed)))
        assert [i for _, i in sorted(placed)] == sorted(i for _, i in placed)


def test_repeated_rows_and_missing_ids_keep_every_row(spark):
    rows = [(1, "a b")] * 4 + [(None, "a b"), (None, "c"), (None, None), (1, "c"), (2, None)]
    got = sharding.assign(docs(spark, rows), 3).collect()
    assert len(got) == len(rows)
    assert len({(r.shard, r.slot) for r in got}) == len(rows)
    assert len({r.shard for r in got if r.text_crc32 == zlib.crc32(b"a b")}) == 1
    assert {r.size for r in got if r.text_crc32 == 0} == {8}
    assert sharding.assign(docs(spark, []), 3).count() == 0
    with pytest.raises(ValueError, match="at least one shard"):
        sharding.assign(docs(spark, rows), 0)


def test_shards_are_near_equal_in_bytes(spark):
    rng = random.Random(6)
    rows = [(i, "w" * int(20 * rng.paretovariate(1.3))) for i in range(2_000)]
    got = sharding.assign(docs(spark, rows), 24).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    loads = [r.n for r in got]
    assert len(loads) == 24
    assert max(loads) <= 4 / 3 * max(sum(loads) / 24, max(len(t) + 8 for _, t in rows)) + 1


# Hard negatives

VECTORS = "vec_id long, embedding array<double>, label int, number long, score string"


def plain_negatives(rows, is_anchor, k=5, low=80):
    good = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (anchor, label, q) in enumerate(good):
        if not is_anchor(anchor):
            continue
        scored = [
            (-sum(a * b for a, b in zip(q, v)), i is None, i or 0, n, other == label)
            for n, (i, other, v) in enumerate(good)
            if n != at and len(v) == len(q)
        ]
        scored.sort()
        name = lambda s: None if s[1] else s[2]
        for p in [s for s in scored if s[4]][:k]:
            hard = [s for s in scored if not s[4] and low * -p[0] <= 100 * -s[0] <= 100 * -p[0]]
            out += [(anchor, name(p), r, name(s), -p[0], -s[0]) for r, s in enumerate(hard[:k], 1)]
    return out


def mined(spark, rows, every=4, **options):
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], VECTORS)
    return [tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % every == 0, **options).collect()]


def key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize("shape", ["close", "noise", "grid", "one_label", "wide"])
def test_hard_negatives_equal_brute_force(spark, shape):
    rng = np.random.default_rng(7)
    n, d = 160, {"wide": 100}.get(shape, 12)
    base = rng.standard_normal((4, d))
    vectors = {
        "close": base[rng.integers(0, 4, n)] + 0.15 * rng.standard_normal((n, d)),
        "noise": rng.standard_normal((n, d)),
        "grid": rng.integers(0, 2, (n, d)) / 4.0,
        "one_label": rng.standard_normal((n, d)),
        "wide": base[rng.integers(0, 4, n)] + 0.4 * rng.standard_normal((n, d)),
    }[shape]
    labels = rng.integers(0, 1 if shape == "one_label" else 3, n)
    rows = [(i, v.tolist(), int(label)) for i, (v, label) in enumerate(zip(vectors, labels))]
    for blocks in ({}, {"row_block": 23, "anchor_block": 7}):
        assert sorted(mined(spark, rows, **blocks)) == sorted(plain_negatives(rows, lambda i: i % 4 == 0))


def test_odd_vectors_take_their_defined_part(spark):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(8)
    rows = [(i, [rng.uniform(0.1, 1) for _ in range(3)], i % 2) for i in range(30)]
    rows += [(40, None, 0), (44, [1.0, None, 1.0], 0), (48, [nan, 1.0, 1.0], 1), (52, [inf, 1.0, 1.0], 1)]
    rows += [(56, [1.0, 1.0, 1.0], None), (60, [], 0), (61, [], 0), (62, [], 1), (64, [1.0], 0), (65, [1.0], 1)]
    rows += [(None, [0.5, 0.5, 0.5], 0), (68, [0.0, 0.0, 0.0], 1), (69, [0.0, 0.0, 0.0], 1), (70, [1e12, 0.0, 1e12], 0)]
    # A row that comes twice is two rows; these stand last, so their order among equals does not matter.
    rows += [(4, rows[4][1], 0)]
    got = mined(spark, rows)
    expected = plain_negatives(rows, lambda i: i is not None and i % 4 == 0)
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert not {40, 44, 48, 52, 56} & {i for r in got for i in (r[0], r[1], r[3])}
    assert any(r[0] == 60 and r[3] == 62 and r[4] == 0 for r in got)


def test_no_anchors_no_rows_and_scores_beyond_a_long(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []
    with pytest.raises(Exception, match="does not fit a long"):
        mined(spark, [(0, [1e20], 0), (1, [1e20], 0), (2, [1.0], 1)])


def test_intervals_hold_every_product():
    rng = np.random.default_rng(9)
    import pyarrow as pa

    for d in (1, 5, 64, 130):
        q, x = (np.floor(256 * rng.standard_normal((40, d)) * rng.uniform(0, 3, (40, 1))) for _ in range(2))
        made = {}

        def side(vectors):
            rotated = vectors @ hard_negatives._rotation(d, made).T
            words = hard_negatives._words(rotated >= 0).view(np.int64)
            table = pa.table({
                "vec_id": pa.array(range(40)), "number": pa.array(range(40)), "label": pa.array([0] * 40),
                "aligned": np.abs(rotated).sum(axis=1) / math.sqrt(d), "norm": np.sqrt((vectors**2).sum(axis=1)),
                "code": hard_negatives._lists(words),
            })
            return hard_negatives.Side(table, np.arange(40), vectors)

        low, high = hard_negatives.Query(side(q), d).bounds(slice(0, 40), side(x))
        product = q @ x.T
        assert (low <= product + 1e-6).all() and (product <= high + 1e-6).all()
        # The signs say something: the middle is nearer than the norms alone would have it.
        if d > 1:
            assert np.mean(high - low) < 1.7 * np.mean(np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1)))


# Resampling


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_draw(rows, target, least=1, most=1, buckets=10_000, least_words=20, percent=10):
    def features(text):
        w = plain_words(text)
        return [
            zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets
            for n in range(least, most + 1)
            for i in range(len(w) - n + 1)
        ]

    found = [(i, len(plain_words(text)), features(text)) for i, text in rows]
    s, t = Counter(b for *_, f in found for b in f), Counter(b for text in target for b in features(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    scored = []
    for i, n, f in found:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    enough = sorted((r for r in scored if r[4] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2]))
    drawn = enough[: len(enough) * percent // 100]
    return [(*r[:4], k) for k, r in enumerate(drawn, 1)] + [
        (*r[:4], None) for r in enough[len(drawn) :] + [r for r in scored if r[4] < least_words]
    ]


def drawn(spark, rows, target, **options):
    benchmark = spark.createDataFrame([(i, text, 1) for i, text in enumerate(target)], "item_id long, text string, n_words int")
    return [tuple(r) for r in resampling.resample(docs(spark, rows), benchmark, **options).collect()]


@pytest.mark.parametrize("runs", [(1, 1), (1, 2), (2, 3)])
def test_draws_equal_the_plain_version(spark, runs, monkeypatch):
    rng = random.Random(10)
    vocabulary = ["Alpha", "beta", "g4mma", "żółć", "ÀB", "naïve", "x", "数据", "omega9"]
    marks = [" ", "  ", ", ", "\n", "-", "_", "\x00", "  "]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice(marks) for _ in range(n))
    rows = [(i, text(rng.randint(0, 60))) for i in range(120)] + [(500, None), (501, ""), (502, "--- !!"), (503, text(40_000))]
    rows += [(7, rows[7][1]), (None, text(30)), (None, text(30))]
    target = [text(50) for _ in range(6)] + [None, ""]
    shape = resampling.Features(*runs, 500)
    options = {"least_words": 15, "percent": 30}
    expected = plain_draw(rows, target, *runs, 500, **options)
    got = drawn(spark, rows, target, shape=shape, **options)
    assert sorted(got, key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("piece", [1, 5, 40, 1 << 18])
def test_pieces_of_a_long_text_give_its_words(piece, monkeypatch):
    monkeypatch.setattr(resampling, "PIECE", piece)
    rng = random.Random(11)
    splitter = resampling.Splitter()
    for n in (0, 1, 30, 400):
        text = "".join(rng.choice(["Ab", "é", "Z", " ", ". ", "\x00", "9", "ſ", "İ"]) for _ in range(n))
        for shape in (resampling.Features(1, 1), resampling.Features(1, 3), resampling.Features(2, 2)):
            pieces = list(splitter.runs(text, shape))
            words = plain_words(text)
            assert sum(new for new, _ in pieces) == len(words)
            expected = [
                " ".join(words[i : i + k]) for k in range(shape.least, shape.most + 1) for i in range(len(words) - k + 1)
            ]
            assert Counter(r for _, found in pieces for r in found) == Counter(expected)


def test_empty_tables_and_wrong_shapes(spark):
    assert drawn(spark, [], ["a b"]) == []
    rows = [(i, "word " * 25) for i in range(30)]
    got = drawn(spark, rows, [])
    assert sorted(got, key=key) == sorted(plain_draw(rows, []), key=key)
    assert sum(r[4] is not None for r in got) == 3
    for least, most, buckets in ((0, 1, 10), (3, 2, 10), (1, 1, 0)):
        with pytest.raises(ValueError, match="runs need"):
            resampling.Features(least, most, buckets)
    with pytest.raises(ValueError, match="percent"):
        drawn(spark, rows, [], percent=101)
