"""Shards of near equal bytes by longest-processing-time scheduling.

Documents of equal text form a group that must stay together. The groups, largest first, go one after
another to the shard that holds the fewest bytes, found through a heap; of equal loads to the smallest
shard. The schedule needs only how many groups there are of each size, largest size first, and that is
all that one task reads: there are at most sqrt(2 * all bytes) different sizes. Groups of one size
go round the lightest shards in turn, so a size is scheduled in at most as many steps as there are
shards, however many groups it has. No document and no list of groups passes through one task.

The result is the one that handing out the groups singly would give. The largest load exceeds the
best possible by at most a third; a group larger than a fair share fills a shard by itself, and the
others are balanced without it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import ROWS_PER_BATCH, arrow_schema, text_key, to_batch
from orderlens.llm.places import numbered
from orderlens.session import materialize

ROW_OVERHEAD = 8
"""Bytes a document takes beside its text."""

_TURNS = "group_size long, starts array<long>, turns array<array<int>>"


class Loads:
    """The shards in a heap of (bytes, shard)."""

    def __init__(self, shards: int):
        self.heap = [(0, shard) for shard in range(shards)]

    def put(self, size: int, groups: int) -> Iterator[tuple[int, list[int]]]:
        """Hand out equal groups; yields (groups, shards): so many groups go to these shards in turn.

        The shards below the lightest load plus one group take one group each before any takes a second,
        and so round after round until they reach the lightest of the others.
        """
        while groups:
            least, first = self.heap[0]
            turn = []
            while self.heap and self.heap[0] < (least + size, first):
                turn.append(heapq.heappop(self.heap))
            rounds = groups
            if self.heap:
                next_load, next_shard = self.heap[0]
                rounds, rest = divmod(next_load - least, size)
                rounds -= rest == 0 and next_shard < first
            taken = min(groups, rounds * len(turn))
            whole, over = divmod(taken, len(turn))
            for place, (load, shard) in enumerate(turn):
                heapq.heappush(self.heap, (load + (whole + (place < over)) * size, shard))
            yield taken, [shard for _, shard in turn[:taken]]
            groups -= taken


def schedule(sizes: DataFrame, shards: int) -> DataFrame:
    """For each size the turns of its groups: from which number on they go round which shards.

    ``sizes`` holds group_size, groups and first, the number of the first group of the size.
    """
    fields = arrow_schema(sizes.sparkSession, _TURNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads, out = Loads(shards), []
        for batch in batches:
            for size, groups, first in zip(*(column.to_pylist() for column in batch.columns)):
                starts, turns = [], []
                for taken, turn in loads.put(size, groups):
                    starts.append(first)
                    turns.append(turn)
                    first += taken
                out.append((size, starts, turns))
                if len(out) >= ROWS_PER_BATCH:
                    yield to_batch(out, fields)
                    out = []
        yield to_batch(out, fields)

    ordered = sizes.select("group_size", "groups", "first").repartition(1).sortWithinPartitions(F.desc("group_size"))
    return ordered.mapInArrow(run, _TURNS)


def _shard() -> Column:
    step = F.size(F.filter("starts", lambda start: start <= F.col("number")))
    turn = F.element_at("turns", step)
    place = (F.col("number") - F.element_at("starts", step)) % F.size(turn)
    return F.element_at(turn, (place + 1).cast("int"))


def assign(docs: DataFrame, shards: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard and slot, its place in the shard from 0.

    A null text counts as an empty one, of ROW_OVERHEAD bytes, and is one group with the empty texts.
    Groups of equal size go in order of their smallest doc_id, null last. Slots follow doc_id, null
    last; rows that repeat a doc_id follow their texts' keys, and equal rows may swap. An empty table
    has no rows; fewer groups than shards leave shards empty. Other columns are not looked at.
    """
    if shards < 1:
        raise ValueError("there must be at least one shard")
    content = F.coalesce(F.col(text), F.lit(""))
    digests = materialize(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(content) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
            F.crc32(content.cast("binary")).alias("text_crc32"),
            *text_key(text),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    groups = digests.groupBy("k1", "k2").agg(F.sum("size").alias("group_size"), F.min("doc_id").alias("first_doc"))
    ordered = numbered(groups, F.desc("group_size"), F.asc_nulls_last("first_doc"), "k1", "k2")
    sizes = ordered.groupBy("group_size").agg(F.count("*").alias("groups"), F.min("number").alias("first"))
    turns = materialize(schedule(sizes, shards))
    # Written, so that the join below is between plain scans and a large group's rows can be split.
    placed = materialize(ordered.join(turns, "group_size").select("k1", "k2", _shard().alias("shard")))
    sharded = digests.join(placed, ["k1", "k2"])
    rows = numbered(sharded, "shard", F.asc_nulls_last("doc_id"), "k1", "k2", "row")
    starts = rows.groupBy("shard").agg(F.min("number").alias("start"))
    slot = F.col("number") - F.col("start")
    return rows.join(F.broadcast(starts), "shard").select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"))
