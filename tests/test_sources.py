"""Landing manifest and the commit log."""

from __future__ import annotations

import hashlib
import random
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.contracts import RAW_BY_TABLE
from orderlens.plans import pipeline
from orderlens.plans.pipeline import ingest, record_landing
from orderlens.session import release
from orderlens.sources import commits
from orderlens.sources.commits import ConcurrentRun
from orderlens.sources.landing import landing_manifest, read_raw, snapshot_manifest
from orderlens.sources.records import read_records
from orderlens.sources.warehouse import Warehouse


def test_the_manifest_names_every_file_with_its_digest(spark, story_dir):
    files = landing_manifest(spark, story_dir, "*.csv")
    expected = {
        p.name: (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in Path(story_dir).glob("*.csv")
    }
    assert {f.file: (f.bytes, f.sha256) for f in files.collect()} == expected
    whole = snapshot_manifest(files, "orders", "https://example.org/snapshot").first()
    assert (whole.files, whole.bytes) == (9, sum(size for size, _ in expected.values()))


def test_a_landing_table_may_be_a_directory_of_parts(spark, tmp_path):
    folder = tmp_path / "olist_sellers_dataset.csv"
    folder.mkdir()
    for n in range(3):
        (folder / f"part-{n}.csv").write_text(
            f"seller_id,seller_zip_code_prefix,seller_city,seller_state\ns_{n},100{n},x,sp\n", encoding="utf-8"
        )
    sellers = read_raw(spark, str(tmp_path), RAW_BY_TABLE["raw_sellers"])
    assert sorted(s.seller_id for s in sellers.collect()) == ["s_0", "s_1", "s_2"]


def test_a_part_with_another_header_fails(spark, tmp_path):
    folder = tmp_path / "olist_sellers_dataset.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text("seller_id,seller_city,seller_zip_code_prefix,seller_state\ns,x,1,sp\n", encoding="utf-8")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, str(tmp_path), RAW_BY_TABLE["raw_sellers"]).collect()


def test_readers_follow_the_last_commit(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert warehouse.current("build") is None
    assert warehouse.ingest_state() is None
    with pytest.raises(FileNotFoundError, match="build"):
        warehouse.tables("build")
    stored, rows = warehouse.write("build", "one", "t", spark.range(3))
    assert (stored.count(), rows) == (3, 3)
    assert warehouse.current("build") is None
    warehouse.commit("build", "one", {"t": rows}, as_of=date(2018, 1, 1))
    _, rows = warehouse.write("build", "two", "t", spark.range(5))
    assert warehouse.tables("build")["t"].count() == 3
    warehouse.commit("build", "two", {"t": rows}, parent_id="p")
    run = warehouse.current("build")
    assert (run.run_id, run.parent_id, run.row_count, run.tables) == ("two", "p", 5, ["t"])
    assert warehouse.tables("build")["t"].count() == 5


def test_the_landing_record_is_stored_and_committed(spark, story_dir, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    files = record_landing(warehouse, story_dir, "orders", "https://example.org/snapshot")
    assert files.count() == 9
    run = warehouse.current("landing")
    assert (run.tables, run.row_count) == (["files", "snapshot"], 10)
    stored = spark.read.json(warehouse.path("landing", run.run_id, "snapshot")).first()
    assert (stored.dataset, stored["files"], stored.source) == ("orders", 9, "https://example.org/snapshot")


def test_of_two_runs_from_the_same_state_one_is_refused(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert warehouse.version("build") == 0
    assert warehouse.commit("build", "first", {"t": 1}, based_on=0) == 1
    with pytest.raises(ConcurrentRun, match="version 1 was committed since version 0"):
        warehouse.commit("build", "late", {"t": 1}, based_on=0)
    assert warehouse.current("build")["run_id"] == "first"
    # Another kind does not matter, nor does a run that says nothing of what it began from.
    assert warehouse.commit("ingest", "other", {"t": 1}, based_on=0) == 2
    assert warehouse.commit("build", "second", {"t": 1}, based_on=1) == 3
    assert warehouse.commit("build", "third", {"t": 1}) == 4


def test_many_writers_at_once_make_one_order(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))

    def run(n: int) -> int:
        try:
            return warehouse.commit("build", f"r{n}", {"t": 1}, based_on=0)
        except ConcurrentRun:
            return 0

    with ThreadPoolExecutor(5) as pool:
        assert sorted(pool.map(run, range(5))) == [0, 0, 0, 0, 1]
        free = list(pool.map(lambda n: warehouse.commit("export", f"e{n}", {"t": 1}), range(5)))
    assert sorted(free) == [2, 3, 4, 5, 6]
    assert sorted(r.version for r in warehouse.log().collect()) == [1, 2, 3, 4, 5, 6]
    assert not list(Path(tmp_path, "_commits").glob(".*"))


def test_a_clock_that_goes_back_changes_no_order(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    for year, run_id in ((2030, "early"), (2001, "late")):
        monkeypatch.setattr(commits, "now", lambda year=year: datetime(year, 1, 1, tzinfo=timezone.utc))
        warehouse.commit("build", run_id, {"t": 1})
    assert warehouse.current("build")["run_id"] == "late"
    assert [r.committed_at.year for r in warehouse.log().orderBy("version").collect()] == [2030, 2001]


def test_a_number_that_was_never_finished_is_reported(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.commit("build", "one", {"t": 1})
    Path(tmp_path, "_commits", f"{2:020d}.json").write_text("", encoding="utf-8")
    monkeypatch.setattr(commits, "_WAITS", 1)
    with pytest.raises(RuntimeError, match="commit 2 was begun and never finished"):
        warehouse.commit("build", "two", {"t": 1})
    assert warehouse.current("build")["run_id"] == "one"


def test_bucketed_tables_are_joined_without_moving_rows(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), buckets=3)
    tables = {"heads": spark.range(40).toDF("order_id"), "lines": spark.range(200).selectExpr("id % 50 as order_id", "id as n")}
    for name, frame in tables.items():
        stored, rows = warehouse.write("build", "one", name, frame, "order_id", 3)
        assert rows == stored.count() == frame.count()
    plain, _ = warehouse.write("build", "one", "plain", tables["lines"])
    warehouse.commit("build", "one", {"heads": 40, "lines": 200, "plain": 200}, bucketed=dict.fromkeys(tables, "order_id"), buckets=3)

    def joined(lines: str):
        read = Warehouse(spark, str(tmp_path)).tables("build")
        frame = read["heads"].hint("merge").join(read[lines], "order_id")
        return frame.count(), "Exchange" in frame._jdf.queryExecution().executedPlan().toString()

    assert joined("lines") == (160, False)
    assert joined("plain") == (160, True)
    # Another session's catalog does not know the tables; the files say the same.
    for name in tables:
        spark.sql(f"DROP TABLE {warehouse.catalog_name('build', 'one', name)}")
    assert joined("lines") == (160, False)


_THREE = T.StructType([T.StructField(name, T.StringType()) for name in "abc"])


def _with_breaks(rng: random.Random, end: str) -> str:
    parts = ["x", "é", " ", '"', ",", end, "long text", ""] + (["\n", "\r\n"] if end != "\r" else [])

    def field() -> str:
        value = "".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) or "k"
        enclosed = any(c in value for c in '",\n\r') or rng.random() < 0.2
        return '"' + value.replace('"', '""') + '"' if enclosed else value

    lines = [",".join(field() for _ in range(3)) for _ in range(rng.randint(0, 150))]
    return "a,b,c" + end + "".join(line + end + (end if rng.random() < 0.1 else "") for line in lines)


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"], ids=["feed", "both", "return"])
@pytest.mark.parametrize("trial", range(4))
def test_records_with_breaks_are_read_by_many_tasks(spark, tmp_path, end, trial):
    """As Spark's reader has them, which reads such a file in one task."""
    rng = random.Random(trial)
    text = _with_breaks(rng, end)
    Path(tmp_path, "one.csv").write_bytes((text.rstrip(end) if trial % 2 else text).encode())
    own = spark.read.csv(
        str(tmp_path), schema=_THREE, header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST", enforceSchema=False
    )
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        read = read_records(spark, str(tmp_path), _THREE, "\r" if end == "\r" else "\n")
        assert sorted(map(str, read.collect())) == sorted(map(str, own.collect()))
        if len(text) > 1_000:
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 2
    finally:
        for key in settings:
            spark.conf.unset(key)


@pytest.mark.parametrize(
    ("text", "message"),
    [
        ("a,c,b\n1,2,3\n", "the header is not a,b,c"),
        ("a,b,c\n1,2\n", "MALFORMED|Malformed"),
        ('a,b,c\n1,x"y,3\n4,z"w,6\n', "Malformed quotes"),
        ('a,b,c\n1,"never ends,3\n4,5,6\n', "Malformed quotes"),
    ],
    ids=["header", "width", "stray", "open"],
)
def test_records_that_break_the_rules_fail_the_read(spark, tmp_path, text, message):
    Path(tmp_path, "one.csv").write_text(text, encoding="utf-8")
    with pytest.raises(Exception, match=message):
        read_records(spark, str(tmp_path), _THREE).collect()


def test_parts_and_empty_files_have_their_own_headers(spark, tmp_path):
    for n, text in enumerate(["a,b,c\n1,2,3\n", "\n\na,b,c\n\n4,,6", "a,b,c\n", ""]):
        Path(tmp_path, f"part-{n}.csv").write_text(text, encoding="utf-8")
    rows = sorted(map(tuple, read_records(spark, str(tmp_path), _THREE).collect()))
    assert rows == [("1", "2", "3"), ("4", None, "6")]


def test_lines_of_records_move_once(spark, tmp_path):
    """To be numbered in their range: all lines meet the ranges, and those of longer records their beginnings.
    None moves again to learn which is the first of its file."""
    Path(tmp_path, "one.csv").write_text('a,b,c\n1,"x\ny",3\n4,5,6\n', encoding="utf-8")
    plan = read_records(spark, str(tmp_path), _THREE)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.split("\n") if "HashJoin" in line or "SortMergeJoin" in line]
    assert len(joins) == 4
    by_range = [line for line in joins if "range#" in line]
    assert len(by_range) == 3


def _shuffles(spark) -> int:
    return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def test_shuffle_files_of_finished_queries_are_let_go(spark, tmp_path):
    """All but those of the newest query, which Spark may still hold."""
    release(spark)
    time.sleep(1)
    before = _shuffles(spark)
    for n in range(12):
        spark.range(1_000).groupBy((F.col("id") % 10).alias("k")).count().write.parquet(str(tmp_path / str(n)))
    release(spark)
    for _ in range(20):
        if _shuffles(spark) <= before + 2:
            break
        time.sleep(0.5)
    assert _shuffles(spark) <= before + 2


def test_a_run_lets_go_after_each_step(spark, tmp_path, story_dir, monkeypatch):
    steps = []
    monkeypatch.setattr(pipeline, "release", steps.append)
    ingest(Warehouse(spark, str(tmp_path)), story_dir)
    assert steps == [spark]
