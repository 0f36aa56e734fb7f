"""Prefix sums, ABC classes and group statistics against brute force, with ties and hot groups."""

from __future__ import annotations

import random
import statistics
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.operators import group_stats
from orderlens.operators.abc import abc_class, bucket_cumulative, class_floors, value_buckets
from orderlens.operators.group_stats import group_median, group_mode
from orderlens.operators.prefix_sum import default_widths, prefix_sum
from orderlens.operators.keys import Keyed, key_totals, nested_surplus
from orderlens.session import discard, materialize, materialize_together, scratch_dir

_MONEY = "value decimal(18,2)"


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("widths", [(), (10_000,), (100,), (1, 7), (1_000, 100)])
def test_prefix_sum_equals_the_running_window(spark, widths):
    rng = random.Random(len(widths))
    values = sorted({Decimal(rng.randint(-50_000, 9_000_000)) / 100 for _ in range(3_000)}, reverse=True)
    rows = spark.createDataFrame([(v, v * 3) for v in values], f"{_MONEY}, amount decimal(38,2)")
    got = {r.value: (r.sum_before, r.sum_total) for r in prefix_sum(rows, "value", "amount", widths=widths).collect()}
    before, total = Decimal(0), sum(values) * 3
    assert len(got) == len(values)
    for v in values:
        assert got[v] == (before, total)
        before += v * 3


def test_prefix_sum_within_partitions_and_over_integers(spark):
    rng = random.Random(4)
    rows = {(k, v) for k in ("a", "b", None) for v in rng.sample(range(-200, 5_000), 400 if k == "a" else 5)}
    frame = spark.createDataFrame([(k, v, v % 11) for k, v in rows], "k string, v long, n long")
    got = prefix_sum(frame, "v", "n", ["k"], widths=(64, 8)).collect()
    for r in got:
        assert r.sum_before == sum(v % 11 for k, v in rows if k == r.k and v > r.v)
        assert r.sum_total == sum(v % 11 for k, v in rows if k == r.k)
    assert len(got) == len(rows)


def test_prefix_sum_of_one_value_and_of_nothing(spark):
    one = spark.createDataFrame([(Decimal("5.00"), Decimal("20.00"))], f"{_MONEY}, amount decimal(38,2)")
    assert [(r.sum_before, r.sum_total) for r in prefix_sum(one, "value", "amount").collect()] == [(0, 20)]
    assert prefix_sum(one.limit(0), "value", "amount").count() == 0
    unordered = one.union(spark.createDataFrame([(None, Decimal("7.00"))], one.schema))
    assert [r.sum_total for r in prefix_sum(unordered, "value", "amount").collect()] == [20]
    with pytest.raises(TypeError, match="integer or a decimal"):
        prefix_sum(one.withColumn("value", F.col("value").cast("double")), "value", "amount")


def test_only_range_totals_meet_in_one_partition(spark):
    rows = spark.range(0, 1000, 1, 4).select((F.col("id") / 100).cast("decimal(18,2)").alias("value"))
    buckets = value_buckets(rows, "value")
    plan = _plan(bucket_cumulative(buckets, "value"))
    assert plan.count("SinglePartition") == 1
    single = plan.split("SinglePartition")[1].split("\n")[1]
    assert "__range_1" in single


@pytest.mark.parametrize(("scale", "spread"), [(2, 10**12), (6, 10**8), (0, 10**15)])
def test_no_level_of_a_prefix_sum_holds_many_rows(spark, scale, spread):
    """Whatever the scale and spread: units of a range, ranges of a range, and ranges at the top."""
    rng = random.Random(scale)
    kind = f"decimal(38,{scale})"
    values = [rng.randint(0, spread * 10**scale) for _ in range(2_000)]
    values += [values[0] + i for i in range(500)]
    numbers = sorted({Decimal(v).scaleb(-scale) for v in values})
    rows = spark.createDataFrame([(v, Decimal(1)) for v in numbers], f"value {kind}, amount decimal(38,2)")
    widths = default_widths(rows.schema["value"].dataType)
    assert widths[0] * 10**scale == 1_000_000
    assert spread * 10**scale / 1_000_000 / widths[1] / widths[2] <= 1_000_000
    got = {r.value: r.sum_before for r in prefix_sum(rows, "value", "amount").collect()}
    assert got == {v: len(numbers) - 1 - i for i, v in enumerate(numbers)}


def _classes(values):
    """Class of each distinct value by the rule itself."""
    total, before, classes = sum(values), 0, {}
    for value, n in sorted(Counter(values).items(), reverse=True):
        share = float(before) / float(total) if total else None
        if value <= 0:
            classes[value] = "NO_VALUE"
        elif share < 0.80:
            classes[value] = "A_HIGH_VALUE"
        elif share < 0.95:
            classes[value] = "B_MEDIUM_VALUE"
        else:
            classes[value] = "C_LOW_VALUE"
        before += value * n
    return classes


@pytest.mark.parametrize("case", ["spread", "third_tied", "all_equal", "all_zero", "one", "pareto"])
def test_abc_classes_follow_the_rule(spark, case):
    rng = random.Random(11)
    cents = {
        "spread": [rng.randint(0, 200_000) for _ in range(900)],
        "third_tied": [990] * 300 + [rng.randint(0, 5_000) for _ in range(600)],
        "all_equal": [500] * 50,
        "all_zero": [0] * 9,
        "one": [1],
        "pareto": [int(100 * rng.paretovariate(1.1)) for _ in range(900)] + [0, 0],
    }[case]
    values = [Decimal(c) / 100 for c in cents]
    rows = spark.createDataFrame([(v,) for v in values], _MONEY)
    expected = _classes(values)
    got = rows.select("value", abc_class(rows, "value").alias("class")).collect()
    assert len(got) == len(values)
    assert {(r.value, r["class"]) for r in got} == set(expected.items())


def test_abc_cuts_are_parameters(spark):
    rows = spark.createDataFrame([(Decimal(v),) for v in (50, 30, 20)], _MONEY)
    got = rows.select("value", abc_class(rows, "value", (0.5,), ("top", "rest")).alias("c")).collect()
    assert {int(r.value): r.c for r in got} == {50: "top", 30: "rest", 20: "rest"}
    assert class_floors(rows, "value", (0.5, 0.8)).first() == (Decimal("50.00"), Decimal("30.00"))
    with pytest.raises(ValueError, match="one label per cut"):
        abc_class(rows, "value", (0.5,), ("a",))


def test_labelling_joins_nobody_to_a_bucket(spark):
    """The people are scanned once and labelled in place: no exchange of them, whatever the ties."""
    rows = materialize(spark.range(0, 100, 1, 4).select(F.lit(1).cast("decimal(18,2)").alias("value")))
    labelled = rows.select("value", abc_class(rows, "value").alias("c"))
    main = _plan(labelled).split("Subquery")[0]
    assert "Exchange" not in main
    assert {r.c for r in labelled.collect()} == {"A_HIGH_VALUE"}


def test_medians_are_exact_in_small_and_hot_groups(spark):
    rng = random.Random(5)
    groups = {0: [rng.gauss(-23, 0.05) for _ in range(30_001)], 1: [1.0], 2: [1.0, 2.0], 3: [2.5] * 400 + [9.0] * 399}
    groups |= {k: [rng.uniform(-90, 90) for _ in range(rng.randint(1, 40))] for k in range(4, 60)}
    groups[60] = [float(rng.randint(0, 3)) for _ in range(20_000)]
    rows = [(k, v, -v / 3) for k, vs in groups.items() for v in vs] + [(61, None, 1.0), (61, None, None)]
    frame = spark.createDataFrame(rows, "k int, a double, b double")
    got = {r.k: r for r in group_median(frame, "k", ["a", "b"], count="n").collect()}
    assert len(got) == 62
    for k, vs in groups.items():
        assert got[k].n == len(vs)
        assert got[k].a == pytest.approx(statistics.median(vs), abs=1e-12)
        assert got[k].b == pytest.approx(statistics.median([-v / 3 for v in vs]), abs=1e-12)
    assert (got[61].n, got[61].a, got[61].b) == (2, None, 1.0)


def test_medians_of_unknown_keys_and_endless_values(spark):
    """As Spark's own median has them, which gathers each group in one place."""
    inf, nan = float("inf"), float("nan")
    groups = {
        None: [1.0, 3.0], "up": [inf, inf], "down": [-inf, 5.0], "over": [2.0, inf], "both": [-inf, inf], "none": [None, None],
        "strange": [1.0, 2.0, nan], "last": [1.0, nan],
    }
    frame = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    got = {r.k: (r.n, repr(r.v)) for r in group_median(frame, "k", ["v"], count="n").collect()}
    own = frame.groupBy("k").agg(F.count("*").alias("n"), F.median("v").alias("v")).collect()
    assert got == {r.k: (r.n, repr(r.v)) for r in own}


@pytest.mark.parametrize("options", [{}, {"accuracy": 1, "margin": 1e-9}], ids=["sketched", "missed"])
def test_medians_of_every_mix_of_strange_values(spark, options):
    rng = random.Random(15)
    pool = [float("nan"), float("inf"), float("-inf"), None, 0.0, 1.5, -2.0, 7.25]
    rows = [
        (group or None, rng.choice(pool), rng.choice([1.0, 2.0, float("nan")]))
        for group in range(150)
        for _ in range(rng.randint(1, 9))
    ]
    frame = spark.createDataFrame(rows, "k int, a double, b double")
    got = {r.k: (r.n, repr(r.a), repr(r.b)) for r in group_median(frame, "k", ["a", "b"], count="n", **options).collect()}
    own = frame.groupBy("k").agg(F.count("*").alias("n"), F.median("a").alias("a"), F.median("b").alias("b")).collect()
    assert got == {r.k: (r.n, repr(r.a), repr(r.b)) for r in own}


def test_a_missed_middle_is_found_in_a_second_bracket(spark, monkeypatch):
    """A sketch too coarse for its margin misses below and above; the other end of its bracket stays."""
    rng = random.Random(16)
    frame = spark.createDataFrame([(i % 5, rng.gauss(0, 1), rng.expovariate(1)) for i in range(20_000)], "k int, a double, b double")
    second, used = group_stats._second_brackets, []
    monkeypatch.setattr(group_stats, "_second_brackets", lambda *args: (used.append(args), second(*args))[1])
    exact = sorted(frame.groupBy("k").agg(F.median("a").alias("a"), F.median("b").alias("b")).collect())
    plain = sorted((r.k, r.a, r.b) for r in group_median(frame, "k", ["a", "b"]).collect())
    assert plain == [tuple(r) for r in exact] and not used
    coarse = sorted((r.k, r.a, r.b) for r in group_median(frame, "k", ["a", "b"], accuracy=4, margin=1e-4).collect())
    assert coarse == plain and used
    counted, missed, columns = used[0]
    moved = second(counted, missed, columns).collect()
    assert any(b is not None and (b.low > b.least or b.high < b.most) for r in moved for b in (r.b_0, r.b_1))


def test_modes_take_the_smallest_of_ties(spark):
    rng = random.Random(6)
    rows = [(k, rng.choice("abcd"), rng.choice(["x", "y", None])) for k in range(5) for _ in range(40)]
    rows += [(9, "b", None), (9, "a", None), (9, "b", None), (9, "a", None)]
    got = {r.k: (r.p, r.q) for r in group_mode(spark.createDataFrame(rows, "k int, p string, q string"), "k", ["p", "q"]).collect()}
    seen = defaultdict(lambda: (Counter(), Counter()))
    for k, p, q in rows:
        seen[k][0][p] += 1
        seen[k][1].update([q] if q is not None else [])
    for k, tallies in seen.items():
        best = tuple(min(t, key=lambda v: (-t[v], v)) if t else None for t in tallies)
        assert got[k] == best


def test_key_totals_count_surplus_rows_and_orphans_of_all_kinds(spark):
    rng = random.Random(17)
    maybe = lambda values: None if rng.random() < 0.1 else rng.choice(values)
    parents = [(maybe(range(20)),) for _ in range(30)]
    children = [(str(i) if (i := maybe(range(25))) is not None else None, maybe(range(3)), rng.choice("xy")) for _ in range(200)]
    children += [("7", 1, "x")] * 100
    goods = [(c,) for c in "xxz"]
    parent = spark.createDataFrame(parents, "id long")
    child = spark.createDataFrame(children, "parent string, line int, good string")
    good = spark.createDataFrame(goods, "good string")
    totals = key_totals([
        Keyed("parent", parent, ["id"]), Keyed("parent", child, ["parent"], refers=True),
        Keyed("line", child, ["parent", "line"]),
        Keyed("good", good, ["good"]), Keyed("good", child, ["good"], refers=True),
        Keyed("nothing", good.limit(0), ["good"]),
    ])
    got = {r.kind: (r.surplus, r.orphans) for r in totals.collect()}
    known = {str(i) for (i,) in parents if i is not None}
    lines = {(a, b) for a, b, _ in children if a is not None and b is not None}
    assert got == {
        "parent": (len(parents) - len(known), sum(a is None or a not in known for a, _, _ in children)),
        "line": (len(children) - len(lines), 0),
        "good": (1, sum(c == "y" for *_, c in children)),
    }


def test_all_key_checks_are_one_exchange_of_keys(spark):
    rows = spark.range(0, 100, 1, 4).select("id", (F.col("id") % 7).cast("int").alias("k"))
    sides = [Keyed("a", rows, ["id"]), Keyed("a", rows, ["k"], refers=True), Keyed("b", rows, ["id", "k"])]
    plan = _plan(key_totals(sides))
    assert "Join" not in plan and "Expand" not in plan
    # One by key and kind; the other by kind, of one row per kind and task.
    assert plan.count("Exchange hashpartitioning(kind") == plan.count("Exchange") == 2


def test_keys_carry_only_the_parts_that_some_kind_uses(spark):
    rows = spark.range(0, 10).select("id", F.col("id").cast("string").alias("name"))
    sides = [Keyed("a", rows, ["id"]), Keyed("b", rows, ["id", "name"])]
    plan = _plan(key_totals(sides))
    assert "number_0" in plan and "text_1" in plan
    assert "text_0" not in plan and "number_1" not in plan
    assert {r.kind: (r.surplus, r.orphans) for r in key_totals(sides).collect()} == {"a": (0, 0), "b": (0, 0)}


def test_surplus_of_nested_keys_is_rolled_up(spark):
    rng = random.Random(18)
    pick = lambda n: rng.choice([None, *range(n)])
    frame = spark.createDataFrame([(pick(9), pick(4), pick(3)) for _ in range(400)], "a int, b int, c int")
    keys = [["a"], ["a", "b"], ["a", "b", "c"]]
    own = frame.agg(*[(F.count("*") - F.countDistinct(*key)).alias(str(i)) for i, key in enumerate(keys)]).first()
    rolled = nested_surplus(frame, ["a", "b", "c"], ["x", "y", "z"])
    assert tuple(rolled.first()) == tuple(own)
    assert "Expand" not in _plan(rolled) and "Expand" not in _plan(nested_surplus(frame, ["a"], ["x"]))
    assert tuple(nested_surplus(frame.limit(0), ["a", "b"], ["x", "y"]).first()) == (0, 0)
    with pytest.raises(ValueError, match="one name"):
        nested_surplus(frame, ["a", "b"], ["x"])


def test_steps_stored_together_keep_their_names(spark):
    stored = materialize_together(low=spark.range(3), high=spark.range(10, 14))
    assert [r.id for r in stored["high"].orderBy("id").collect()] == [10, 11, 12, 13]
    assert stored["low"].count() == 3
    with pytest.raises(Exception, match="stop here"):
        materialize_together(low=spark.range(3), bad=spark.range(3).select(F.raise_error(F.lit("stop here"))))


def test_materialize_uses_the_shared_folder(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert named in scratch_dir(spark)
    frame = materialize(spark.range(0, 5, 1, 2).withColumn("d", F.lit("1.50").cast("decimal(38,2)")))
    assert frame.count() == 5
    assert frame.schema["d"].dataType.simpleString() == "decimal(38,2)"


class _Session:
    """As much of a session as naming a scratch folder needs."""

    def __init__(self, master):
        self.sparkContext = self
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder

    def getConf(self):
        return {}


def test_a_cluster_without_a_shared_folder_is_refused():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_dir(_Session(master))
    assert "orderlens-" in scratch_dir(_Session("local[2]"))


def test_stored_steps_can_be_discarded(spark):
    frame = materialize(spark.range(3))
    path = frame.inputFiles()[0]
    assert discard(spark) > 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()
    assert discard(spark) == 0
