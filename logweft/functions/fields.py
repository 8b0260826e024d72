"""Fields of a log line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The line format.  Group 1 is the field; no match gives "".
FIELD_PATTERNS = {
    "date_time": r"^(\d{6} \d{6})",
    "pid": r"^(?:\d{6} \d{6}) (\d+)",
    "level": r"^(?:\d{6} \d{6}) (?:\d+) (\w+)",
    "component": r"^(?:\d{6} \d{6}) (?:\d+) (?:\w+) ([^:]+)",
    "BlockId": r"(blk_-?\d+)",
}
# How a log time is spelled, and as a date and time; two-digit years are 2000 to 2099.
TIME_PATTERN = r"^(\d\d)(\d\d)(\d\d) (\d\d)(\d\d)(\d\d)$"
TIME_SPELLED = "20$1-$2-$3 $4:$5:$6"


def field(name: str, line: Column | str = "value") -> Column:
    return F.regexp_extract(line, FIELD_PATTERNS[name], 1).alias(name)


def parse_fields(lines: DataFrame) -> DataFrame:
    """Add the five text fields to each line; unused ones are pruned from the plan."""
    return lines.select("*", *[field(name) for name in FIELD_PATTERNS])


def parse_time(date_time: Column | str = "date_time") -> Column:
    """Log time, which carries no zone (``timestamp_ntz``), NULL if it is no valid time."""
    return F.regexp_replace(date_time, TIME_PATTERN, TIME_SPELLED).try_cast("timestamp_ntz")


def parse_timestamp(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("timestamp", parse_time())


def drop_missing_blocks(parsed: DataFrame) -> DataFrame:
    """Keep the lines that name a block."""
    return parsed.filter("BlockId <> ''")
