"""Log lines, labels, templates and truth sequences rendered from the test tables.

The test tables hold no logs.  Lines come from ``events`` and labels from ``labels`` by the rules of
FIXTURES.md, as lazy DataFrames over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweft import functions as fn

# The message of each event type, its event id and its template, in match order.
EVENT_TYPES = {
    "view": ("Fetch started for ", "E1", "Fetch started[*]"),
    "click": ("Fetch finished for ", "E2", "Fetch[*]"),
    "signup": ("BLOCK* allocate ", "E3", "[*]BLOCK* allocate[*]"),
    "purchase": ("Verify ok for ", "E4", "Verify ok[*]"),
    "error": ("Exception while serving ", "E5", "Exception while[*]"),
}
BLOCK = "concat('blk_', if({0} % 2 = 1, '-', ''), {0})"
# A third of the lines is in one block, an eighth in four more; the rest are short blocks.
LINE_BLOCK = """CASE WHEN event_id % 3 = 0 THEN {0} WHEN event_id % 5 = 0 THEN {0} + 1 + event_id % 4
    ELSE event_id div 3 END"""
HOT = 1


def _per_type(place: int) -> str:
    """SQL for one of the three values of a row's event type."""
    cases = " ".join(f"WHEN '{kind}' THEN '{values[place]}'" for kind, values in EVENT_TYPES.items())
    return f"CASE event_type {cases} END"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = BLOCK.format(f"({LINE_BLOCK.format(HOT)})")
    value = f"""
        CASE WHEN event_id % 101 = 0 THEN concat('malformed ', {block})
          ELSE concat(date_format(ts, 'yyMMdd HHmmss'), ' ', get_json_object(props, '$.k'), ' ',
            CASE WHEN event_id % 53 = 0 THEN 'DEBUG' WHEN event_id % 59 = 0 THEN 'FATAL'
              WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'purchase' THEN 'WARN' ELSE 'INFO' END,
            ' svc.Node', (user_id + event_id) % 7, ': ', {_per_type(0)},
            if(event_id % 97 = 0, 'none', {block})) END AS value"""
    time = r"regexp_replace(cast(ts AS string), '^..(..)-(..)-(..) (..):(..):(..).*$', '$1$2$3 $4$5$6')"
    place = ["'events' AS file", "0L AS split_start", "event_id AS line_no"]
    return _events(spark, sf_dir).selectExpr(value, *place)


def label_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label rows as text; some texts are unknown and some blocks have a second, other label."""
    bad = "(toxic = 1 OR quality = 0)"
    one = f"CASE WHEN doc_id % 13 = 6 THEN 'Doubtful' WHEN {bad} THEN 'Anomaly' ELSE 'Normal' END"
    other = f"if({bad}, 'Normal', 'Anomaly')"
    first, second = f"struct({one}, 2 * doc_id)", f"struct({other}, 2 * doc_id + 1)"
    rows = f"inline(if(doc_id % 11 = 4, array({first}, {second}), array({first}))) AS (Label, label_order)"
    return spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr(f"{BLOCK.format('doc_id')} AS BlockId", rows)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.encode_labels(label_texts(spark, sf_dir)).drop("LabelText")


def markers(spark: SparkSession) -> list[tuple[str, list[str]]]:
    """The five templates of the log, as metadata for classification."""
    rows = [(i, e, t) for i, (_, e, t) in enumerate(EVENT_TYPES.values(), 1)]
    return fn.collect_markers(
        spark.createDataFrame(rows, "priority int, EventId string, EventTemplate string")
    )


def mined_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A template for each component and event type in the log, in order of first appearance."""
    return (
        _events(spark, sf_dir)
        .groupBy(F.expr("(user_id + event_id) % 7").alias("node"), "event_type")
        .agg(F.min("event_id").alias("priority"))
        .selectExpr(
            "priority",
            "concat(event_type, '-', node) AS EventId",
            f"concat('svc.Node', node, ': ', {_per_type(0)}, '[*]') AS EventTemplate",
        )
    )


def pid_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of templates: one for each process, component and event type in the log, in that order too."""
    return (
        _events(spark, sf_dir)
        .groupBy(F.expr("get_json_object(props, '$.k')").alias("pid"), F.expr("(user_id + event_id) % 7").alias("node"), "event_type")
        .agg(F.min("event_id").alias("priority"))
        .selectExpr(
            "priority",
            "concat_ws('-', event_type, node, pid) AS EventId",
            f"concat('[*] ', pid, ' [*] svc.Node', node, ': ', {_per_type(0)}, '[*]') AS EventTemplate",
        )
    )


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event sequences of three lines each.  Half of the unknown lines are said to be of an event E9."""
    unknown = "if(event_id % 202 = 0, 'E9', 'Unknown')"
    event = F.expr(f"if(event_id % 101 = 0, {unknown}, {_per_type(1)})")
    return (
        _events(spark, sf_dir)
        .groupBy(F.expr("event_id div 3").alias("block"))
        .agg(F.collect_list(event).alias("events"))
    )


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fn.classify(log_lines(spark, sf_dir), markers(spark))
    return fn.parse_timestamp(fn.parse_fields(lines))


def in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.drop_missing_blocks(parsed(spark, sf_dir))
