"""Keeping an intermediate result across executor loss."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_stored: dict[str, list[str]] = defaultdict(list)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where none is named, a private folder serves a session that is one process; on a cluster its
    executors would each write to a disk of their own, so that is refused.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="orderlens-"))
    return context.getCheckpointDir()


def materialize(frame: DataFrame) -> DataFrame:
    """Write a result that several consumers read, and read it back.

    As Parquet in the shared folder it outlives executors, each consumer scans only its columns,
    and later joins are planned from the real size. ``discard`` deletes it.
    """
    spark = frame.sparkSession
    path = f"{scratch_dir(spark)}/materialized-{uuid.uuid4()}"
    _stored[spark.sparkContext.applicationId].append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def materialize_together(**frames: DataFrame) -> dict[str, DataFrame]:
    """``materialize`` several frames that do not read each other, as jobs that run side by side.

    A small step leaves most of a cluster idle while it plans and ends; its neighbours use that time.
    """
    spark = next(iter(frames.values())).sparkSession
    with ThreadPoolExecutor(len(frames)) as pool:
        return dict(zip(frames, pool.map(inheritable_thread_target(spark)(materialize), frames.values())))


def release(spark: SparkSession) -> None:
    """Have the shuffle files of finished queries deleted.

    Spark deletes them once the driver's collector finds that no plan refers to them. The driver does little
    and collects seldom, so a run of many steps would keep the files of all of them on the executors' disks.
    """
    gc.collect()
    spark._jvm.System.gc()


def discard(spark: SparkSession) -> int:
    """Delete what ``materialize`` has stored in this session, once no frame over it is needed; how many."""
    paths = _stored.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)
