"""Finding the blocks that are too large for one task.

Ordering a block's lines with a window puts the whole block into one task.  That is the cheapest plan
for ordinary blocks and a bad one for a block with a large share of the log, so large blocks are looked
for first, with a fixed number of counters.  Oversized ("hot") blocks then take another route; see
``operators.blocks``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lines of one block that a single task may order.
TASK_LINES = 1_000_000
# A block above 1/MAX_HOT of the log is always hot, so at most MAX_HOT blocks can be: the id list, and
# with it every broadcast made from it, is bounded whatever the input.
MAX_HOT = 50_000
# Slices of hot lines that may be as short as the limit.  Where there are more, a slice has SLICE_LINES lines
# at least, as every slice costs a task and a file whatever it holds.
SHORT_SLICES = 64
SLICE_LINES = 100_000
# Counters of a profile; with few blocks above the limit, nearly all of them stay far below it.
BUCKETS = 1 << 20


@dataclass(frozen=True)
class BlockProfile:
    """The size of a log and its oversized blocks."""

    lines: int
    limit: int
    hot_lines: int = 0
    hot: tuple[str, ...] = field(default=(), repr=False)

    def hot_ids(self, like: DataFrame) -> DataFrame:
        """The hot block ids, at most ``MAX_HOT`` rows, ready to broadcast."""
        rows = like.sparkSession.createDataFrame([(b,) for b in self.hot], "BlockId string")
        return F.broadcast(rows)

    def ordinary(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.hot_ids(rows), "BlockId", "left_anti") if self.hot else rows

    def oversized(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.hot_ids(rows), "BlockId", "left_semi")

    def only_hot(self, reduce: Callable[[DataFrame], DataFrame], rows: DataFrame) -> DataFrame:
        """``reduce`` over the rows of hot blocks, ready to broadcast.

        ``reduce`` must leave a fixed number of rows per block, which bounds the result.
        """
        return F.broadcast(reduce(self.oversized(rows)))

    @property
    def slices(self) -> int:
        """Range partitions for the hot lines, by their number: a low ``limit`` makes more blocks hot, not
        more slices than ``SHORT_SLICES`` of less than ``SLICE_LINES`` lines.  Never above 2*MAX_HOT."""
        long = self.hot_lines // max(self.limit, SLICE_LINES)
        return min(self.hot_lines // self.limit, max(SHORT_SLICES, long)) + 1


@dataclass(frozen=True)
class StoredLines:
    """Parsed lines as ``layout.store`` keeps them; block operators take them in place of parsed lines.

    ``ordinary`` is bucketed by block id, so a block's lines are read by one task and what groups, orders
    or joins by block needs no shuffle.  Lines of the profile's oversized blocks are in ``hot``, a plain
    table, since a bucket is one task.  No block is in both.
    """

    ordinary: DataFrame
    hot: DataFrame
    profile: BlockProfile

    @property
    def columns(self) -> list[str]:
        return self.ordinary.columns

    def select(self, *columns: str) -> StoredLines:
        return StoredLines(self.ordinary.select(*columns), self.hot.select(*columns), self.profile)


def parts_of(rows: DataFrame | StoredLines) -> list[DataFrame]:
    """Tables that together have all lines, and each of whose blocks is in one of them."""
    if isinstance(rows, StoredLines):
        return [rows.ordinary, rows.hot] if rows.profile.hot else [rows.ordinary]
    return [rows]


def _bucket() -> Column:
    return F.pmod(F.xxhash64("BlockId"), F.lit(BUCKETS)).cast("int")


def profile_blocks(parsed: DataFrame, task_lines: int = TASK_LINES) -> BlockProfile:
    """Find the blocks too large for one task, without a count for every block.

    Lines are counted by a hash of their block in ``BUCKETS`` counters.  A block above the limit makes its
    counter exceed it, so only the blocks of such counters, of which there are ``MAX_HOT`` at most, are
    counted one by one; mostly there are none, and one pass over one column is all.
    """
    counters = parsed.groupBy(_bucket().alias("bucket")).agg(F.count("*").alias("n"))
    large = F.collect_list(F.when(F.col("n") > task_lines, F.struct("bucket", "n"))).alias("large")
    total, large = counters.agg(F.coalesce(F.sum("n"), F.lit(0)), large).first()
    limit = max(task_lines, -(-total // MAX_HOT))
    suspects = [(r["bucket"],) for r in large if r["n"] > limit]
    if not suspects:
        return BlockProfile(total, limit)
    wanted = F.broadcast(parsed.sparkSession.createDataFrame(suspects, "bucket int"))
    rows = parsed.select("BlockId", _bucket().alias("bucket")).join(wanted, "bucket", "left_semi")
    hot = rows.groupBy("BlockId").agg(F.count("*").alias("n")).filter(F.col("n") > limit).collect()
    return BlockProfile(
        total, limit, sum(r["n"] for r in hot), tuple(sorted(r["BlockId"] for r in hot))
    )
