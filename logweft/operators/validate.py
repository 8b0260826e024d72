"""Control-total checks of parsed lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def event_counts(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("EventId").agg(F.count("*").alias("count"))


def event_count_check(parsed: DataFrame, expected: DataFrame) -> DataFrame:
    """Each expected event with its expected and actual count; other events are ignored."""
    actual = event_counts(parsed).withColumnRenamed("count", "actual")
    return (
        expected.join(actual, "EventId", "left")
        .withColumn("actual", F.coalesce("actual", F.lit(0)))
        .withColumn("matches", F.col("actual") == F.col("expected"))
    )


def event_count_violations(parsed: DataFrame, expected: DataFrame) -> DataFrame:
    return event_count_check(parsed, expected).filter(~F.col("matches"))


def missing_blocks(parsed: DataFrame) -> DataFrame:
    """One row: how many lines there are and how many name no block."""
    blank = F.col("BlockId").isNull() | (F.col("BlockId") == "")
    return parsed.agg(F.count("*").alias("lines"), F.count_if(blank).alias("missing"))


# Events that can be counted while lines are written; longer lists are counted after.
OBSERVED = 500


@dataclass(frozen=True)
class WatchedCounts:
    """Control totals taken by the job that writes the lines."""

    expected: dict[str, int]
    seen: Observation

    def rows(self) -> list[tuple[str, int, int]]:
        """(EventId, expected, actual) of each expected event, once the job has run."""
        found = self.seen.get
        return [(event, n, found[f"event{i}"] or 0) for i, (event, n) in enumerate(self.expected.items())]

    @property
    def missing(self) -> int:
        """How many lines name no block."""
        return self.seen.get["missing"] or 0

    def check(self) -> None:
        """``check_parsed`` by these counts."""
        wrong = sorted(r for r in self.rows() if r[1] != r[2])
        if wrong:
            raise ValueError(f"Event Mismatch: {dict(zip(('EventId', 'expected', 'actual'), wrong[0]))}")
        if self.missing:
            raise ValueError(f"Blocks Missing: {self.missing} lines")


def watched(parsed: DataFrame, expected: DataFrame) -> tuple[DataFrame, WatchedCounts | None]:
    """``parsed`` with its control totals counted by the action that reads it, which costs no job of its own.

    ``expected`` has a row for each event type and comes to the driver.  With more than ``OBSERVED`` of
    them there are no counts, and ``check_parsed`` is left to do.
    """
    events = {r["EventId"]: r["expected"] for r in expected.limit(OBSERVED + 1).collect()}
    if len(events) > OBSERVED:
        return parsed, None
    blank = F.col("BlockId").isNull() | (F.col("BlockId") == "")
    counts = [F.count_if(F.col("EventId") == event).alias(f"event{i}") for i, event in enumerate(events)]
    seen = Observation()
    return parsed.observe(seen, F.count_if(blank).alias("missing"), *counts), WatchedCounts(events, seen)


def check_parsed(parsed: DataFrame, expected: DataFrame) -> None:
    """Strict mode: raise ValueError on the first violation.  Reads the lines once.

    What is collected is a row for each violated event and, at most, one for lines without a block.
    """
    blank = F.col("BlockId").isNull() | (F.col("BlockId") == "")
    actual = parsed.groupBy("EventId").agg(F.count("*").alias("actual"), F.count_if(blank).alias("missing"))
    both = expected.join(actual, "EventId", "full").select(
        "EventId", "expected", F.coalesce("actual", F.lit(0)).alias("actual"), F.coalesce("missing", F.lit(0)).alias("missing")
    )
    wrong = F.col("expected").isNotNull() & (F.col("actual") != F.col("expected"))
    first = F.min(F.when(wrong, F.struct("EventId", "expected", "actual")))
    found = both.agg(first.alias("wrong"), F.coalesce(F.sum("missing"), F.lit(0)).alias("missing")).head()
    if found["wrong"]:
        raise ValueError(f"Event Mismatch: {found['wrong'].asDict()}")
    if found["missing"]:
        raise ValueError(f"Blocks Missing: {found['missing']} lines")
