"""A set of queries against all rows, both in blocks, block meeting block in tasks.

One side is held: a block of queries stays in a task's memory with what is known of their
results so far. The other passes: its blocks are dealt to groups, and all blocks of a group
go by a held block one after the other. A row is moved once per block of queries, a query
once per group, and a task has one held and one passing block in memory.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import one_row

GROUP = 16  # passing blocks that go by a held block in one task


def packed(**arrays: np.ndarray) -> bytes:
    return pickle.dumps(arrays, protocol=5)


def unpacked(blob: bytes) -> dict[str, np.ndarray]:
    return pickle.loads(blob)


def in_blocks(
    rows: DataFrame,
    size: int | Callable[[int], int],
    make: Callable[[pa.Table], tuple[bytes, float, dict]],
    extra: str = "",
    breaks_at: str | None = None,
) -> DataFrame:
    """(block, rank, blob and what `extra` declares) of at most `size` consecutive rows.

    `make` gives a block's blob, its place among those passing, and its further columns.
    With `breaks_at`, a block ends where that column changes, and `size` is a function of
    its value. Store the result: the numbers of blocks depend on the order of tasks.
    """
    names = [part.split()[0] for part in extra.split(",")] if extra else []
    schema = "rank double, blob binary" + (f", {extra}" if extra else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            blob, rank, more = make(pa.Table.from_batches(parts))
            columns = [pa.array([rank], pa.float64()), pa.array([blob], pa.binary())]
            columns += [pa.array([more[n]]) for n in names]
            return pa.RecordBatch.from_arrays(columns, ["rank", "blob", *names])

        waiting, n, last = [], 0, None
        most = size if breaks_at is None else 0
        for batch in batches:
            starts = [0, len(batch)]
            if breaks_at is not None and len(batch):
                kind = batch.column(breaks_at).to_numpy(zero_copy_only=False)
                changes = (np.flatnonzero(kind[1:] != kind[:-1]) + 1).tolist()
                starts = [0, *changes, len(batch)]
            for first, end in zip(starts, starts[1:]):
                if breaks_at is not None:
                    if waiting and kind[first] != last:
                        yield block(waiting)
                        waiting, n = [], 0
                    last = kind[first]
                    most = size(int(last))
                while first < end:
                    taken = min(end - first, most - n)
                    waiting.append(batch.slice(first, taken))
                    first, n = first + taken, n + taken
                    if n == most:
                        yield block(waiting)
                        waiting, n = [], 0
        if waiting:
            yield block(waiting)

    made = rows.mapInArrow(cut, schema)
    return made.select(F.monotonically_increasing_id().alias("block"), "*")


def grouped(blocks: DataFrame, group: int = GROUP) -> DataFrame:
    """Deal stored blocks to groups of about `group` of them, by hash, as `group`."""
    groups = max(1, -(-one_row(blocks.agg(F.count("*").alias("n")))["n"] // group))
    return blocks.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))


def meet(
    held: DataFrame,
    passing: DataFrame,
    start: Callable[[dict], object],
    go_by: Callable[[object, dict], None],
    finish: Callable[[object], pa.RecordBatch | None],
    schema: str,
) -> DataFrame:
    """What `finish` gives for every held block and group, after all of the group went by.

    held is (part, blob), passing (part, group, rank, blob): a row for each block that has
    to go by that part, in order of rank. `start` makes a state of a held blob, `go_by`
    changes it. Both frames are read more than once, so store what is under them.
    """
    spark = held.sparkSession
    meetings = passing.select("part", "group").distinct()
    columns = ("part", "group", "passes", "rank", "blob")
    holding = held.join(meetings, "part").select(
        "part",
        "group",
        F.lit(False).alias("passes"),
        F.lit(0.0).alias("rank"),
        "blob",
    )
    both = holding.unionByName(passing.withColumn("passes", F.lit(True)).select(*columns))
    # A number of its own, since blocks are few and heavy: merging partitions by their
    # size would leave cores idle.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = both.repartition(partitions, "part", "group").sortWithinPartitions(
        "part", "group", "passes", "rank"
    )

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, meeting = None, None
        for batch in batches:
            named = zip(batch.column("part").to_pylist(), batch.column("group").to_pylist())
            for now, passes, blob in zip(named, batch.column("passes"), batch.column("blob")):
                if now != meeting:
                    if state is not None and (found := finish(state)) is not None:
                        yield found
                    state, meeting = None, now
                if not passes.as_py():
                    state = start(unpacked(blob.as_py()))
                elif state is not None:
                    go_by(state, unpacked(blob.as_py()))
        if state is not None and (found := finish(state)) is not None:
            yield found

    return ordered.mapInArrow(visit, schema)
