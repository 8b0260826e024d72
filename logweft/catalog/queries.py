"""The named queries.  Times and arrays leave as text, measures rounded, to compare across engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweft import functions as fn
from logweft import operators as ops
from logweft import sources
from logweft.catalog import fixture as fx
from logweft.plans import blocks, findings, lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
COMPONENT = "svc.Node3"
# Short records and a low limit, so that segments and the route of hot blocks are part of the check.
SEGMENT, TASK_LINES = 64, 100


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _time(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


# Scans


@query
def log_scan(spark, sf):
    path = sources.new_folder(spark, "log")
    fx.log_lines(spark, sf).select("value").write.text(path)
    return sources.read_log(spark, path).select("value")


def _scanned(spark, templates: DataFrame) -> DataFrame:
    """Templates written as CSV in their order and read back."""
    path = sources.new_folder(spark, "templates")
    templates.orderBy("priority").drop("priority").write.csv(path, header=True)
    return sources.read_templates(spark, path)


@query
def template_scan(spark, sf):
    scanned = _scanned(spark, fx.mined_templates(spark, sf))
    rank = F.row_number().over(Window.orderBy("priority")).cast("bigint")  # a row for each template
    return scanned.select("EventId", "EventTemplate", rank.alias("priority"))


@query
def label_scan(spark, sf):
    path = sources.new_folder(spark, "labels")
    fx.label_texts(spark, sf).drop("label_order").write.csv(path, header=True)
    return sources.read_labels(spark, path).select("BlockId", "Label")


@query
def truth_event_counts(spark, sf):
    return sources.truth_event_counts(fx.truth(spark, sf))


@query
def line_numbers(spark, sf):
    path = sources.new_folder(spark, "log")
    fx.log_lines(spark, sf).repartitionByRange(5, "line_no").sortWithinPartitions("line_no").select("value").write.text(path)
    return sources.number_lines(sources.settle(sources.read_log(spark, path))).select("line_number", "value")


# Fields, events, labels


@query
def parse_fields(spark, sf):
    return fn.parse_fields(fx.log_lines(spark, sf)).select("line_no", *fn.FIELD_PATTERNS)


@query
def parse_timestamp(spark, sf):
    parsed = fn.parse_timestamp(fn.parse_fields(fx.log_lines(spark, sf)))
    return parsed.select("line_no", "date_time", _time("timestamp"))


@query
def template_markers(spark, sf):
    marked = fn.with_markers(fx.mined_templates(spark, sf))
    return marked.select("EventId", fn.array_to_string("markers").alias("markers"))


@query
def classify_events(spark, sf):
    return fn.classify(fx.log_lines(spark, sf), fx.markers(spark)).select("line_no", "EventId")


@query
def classify_events_join(spark, sf):
    event = fn.event_by_chain(fx.markers(spark), width=2).alias("EventId")
    return fx.log_lines(spark, sf).select("line_no", event)


@query
def classify_events_indexed(spark, sf):
    markers = fn.collect_markers(_scanned(spark, fx.pid_templates(spark, sf)))
    return fn.classify_by_index(fx.log_lines(spark, sf), markers).select("line_no", "EventId")


@query
def encode_labels(spark, sf):
    return fn.encode_labels(fx.label_texts(spark, sf).drop("label_order"))


@query
def drop_missing_blocks(spark, sf):
    kept = fn.drop_missing_blocks(fn.parse_fields(fx.log_lines(spark, sf)))
    return kept.select("line_no", "BlockId")


# Checks


@query
def event_counts(spark, sf):
    return ops.event_counts(fx.parsed(spark, sf))


@query
def validate_event_counts(spark, sf):
    expected = sources.truth_event_counts(fx.truth(spark, sf))
    return ops.event_count_check(fx.parsed(spark, sf), expected)


@query
def validate_missing_blocks(spark, sf):
    return ops.missing_blocks(fx.parsed(spark, sf))


@query
def validate_on_write(spark, sf):
    """Control totals taken by the job that writes the parsed lines."""
    rows, counts = ops.watched(fx.parsed(spark, sf), sources.truth_event_counts(fx.truth(spark, sf)))
    sources.settle(rows, "lines")
    found = [*counts.rows(), ("lines without a block", 0, counts.missing)]
    table = spark.createDataFrame(found, "EventId string, expected bigint, actual bigint")
    return table.withColumn("matches", F.col("actual") == F.col("expected"))


# Blocks


@query
def sequence_events(spark, sf):
    kept = fx.in_blocks(spark, sf)
    return ops.sequence_events(kept.select(*ops.order_columns(kept), "EventId")).select(
        "BlockId", "line_no", "EventId", "seq_num", _time("timestamp"), _time("prev_timestamp")
    )


@query
def event_intervals(spark, sf):
    kept = fx.in_blocks(spark, sf)
    timed = ops.event_intervals(kept.select(*ops.order_columns(kept)))
    return timed.select("BlockId", "seq_num", "interval_seconds")


def _as_text(records: DataFrame) -> DataFrame:
    arrays = ("events", "levels", "components", "pids")
    texts = {name: fn.array_to_string(name) for name in arrays}
    texts["intervals"] = fn.array_to_string(F.col("intervals").cast("array<string>"))
    return records.withColumns(texts)


@query
def block_records(spark, sf):
    return _as_text(ops.block_records(fx.in_blocks(spark, sf), fx.labels(spark, sf)))


@query
def block_records_default0(spark, sf):
    return _as_text(ops.block_records_default0(fx.in_blocks(spark, sf), fx.labels(spark, sf)))


def _hot(spark, sf) -> tuple[DataFrame, ops.BlockProfile]:
    """Lines, written so that they are parsed once, and a profile by which the larger blocks of the test log
    take the route of hot blocks: the profile, both routes and the bounds of slices read from there."""
    kept = sources.settle(fx.in_blocks(spark, sf).drop("value"), "lines")
    return kept, ops.profile_blocks(kept, task_lines=TASK_LINES)


@query
def event_intervals_hot(spark, sf):
    kept, profile = _hot(spark, sf)
    timed = ops.event_intervals(kept.select(*ops.order_columns(kept)), profile)
    return timed.select("BlockId", "line_no", "seq_num", "interval_seconds")


@query
def block_records_segments(spark, sf):
    kept, profile = _hot(spark, sf)
    return _as_text(ops.block_records(kept, fx.labels(spark, sf), profile, SEGMENT))


@query
def anomaly_sequences_segments(spark, sf):
    kept, profile = _hot(spark, sf)
    return blocks.anomaly_sequences(kept, fx.labels(spark, sf), profile, SEGMENT)


@query
def block_latency(spark, sf):
    return ops.block_latency(fx.in_blocks(spark, sf))


@query
def array_to_string(spark, sf):
    fn.register_functions(spark)
    return fx.truth(spark, sf).select(
        "block", F.expr("array_to_string(array_sort(events))").alias("events")
    )


# Layouts


@query
def layout_shuffle_width(spark, sf):
    rows = fx.in_blocks(spark, sf)
    result = None
    for width in ops.SHUFFLE_WIDTHS:
        one = ops.latency_at_width(rows, width).withColumn("width", F.lit(width))
        result = one if result is None else result.unionByName(one)
    return result


def _layout(name: str) -> Query:
    def build(spark, sf):
        return ops.block_latency(ops.LAYOUTS[name](fx.in_blocks(spark, sf)))

    build.__name__ = f"layout_{name}"
    return query(build)


for _name in ops.LAYOUTS:
    _layout(_name)


def _stored(spark, sf) -> tuple[ops.StoredLines, DataFrame]:
    """Lines and labels written by block; the larger blocks of the test log count as oversized."""
    kept, profile = _hot(spark, sf)
    buckets = spark.sparkContext.defaultParallelism
    return ops.store(kept, buckets, profile), ops.bucketed(fx.labels(spark, sf), buckets, "BlockId", "label_order")


@query
def stored_block_latency(spark, sf):
    return ops.block_latency(_stored(spark, sf)[0])


@query
def stored_block_records(spark, sf):
    stored, labels = _stored(spark, sf)
    return _as_text(ops.block_records(stored, labels))


@query
def stored_component_latency(spark, sf):
    stored, labels = _stored(spark, sf)
    return _rounded(blocks.component_latency(stored, labels), "avg_latency")


# Analyses of lines


@query
def error_frequencies(spark, sf):
    return lines.error_frequencies(fx.parsed(spark, sf))


@query
def error_frequencies_top10(spark, sf):
    return lines.error_frequencies(fx.parsed(spark, sf), limit=10)


@query
def top_error_components(spark, sf):
    return findings.top_error_components(lines.error_frequencies(fx.parsed(spark, sf)))


@query
def hourly_activity(spark, sf):
    return lines.hourly_activity(fx.parsed(spark, sf))


@query
def peak_hours(spark, sf):
    return lines.peak_hours(lines.hourly_activity(fx.parsed(spark, sf)))


@query
def level_distribution(spark, sf):
    return _rounded(lines.level_distribution(fx.parsed(spark, sf)), "percentage")


def _top_levels(spark, sf) -> DataFrame:
    counts = sources.settle(lines.level_counts(fx.parsed(spark, sf)))
    return lines.level_distribution_top(counts)


@query
def level_distribution_top10(spark, sf):
    return _rounded(_top_levels(spark, sf), "percentage")


@query
def top_components(spark, sf):
    return lines.top_components(fx.parsed(spark, sf))


@query
def distinct_components(spark, sf):
    return lines.distinct_components(fx.parsed(spark, sf))


def _pivot(spark, sf) -> DataFrame:
    return findings.level_pivot(_top_levels(spark, sf))


@query
def level_pivot(spark, sf):
    wide = _pivot(spark, sf)
    return _rounded(wide, *(c for c in wide.columns if c != "component"))


@query
def level_unpivot(spark, sf):
    return _rounded(findings.level_unpivot(_pivot(spark, sf)), "percentage")


@query
def level_stack(spark, sf):
    stack = findings.level_stack(findings.level_unpivot(_pivot(spark, sf)))
    return _rounded(stack, "percentage", "base")


@query
def level_maps(spark, sf):
    maps = findings.level_maps(_top_levels(spark, sf))
    text = F.array_join(F.transform(F.map_entries("levels"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("decimal(18,6)"))), ",")
    return maps.select("component", text.alias("levels"))


@query
def level_map_stack(spark, sf):
    stack = findings.level_map_stack(findings.level_maps(_top_levels(spark, sf)))
    return _rounded(stack, "percentage", "base")


@query
def lines_one_pass(spark, sf):
    """Five analyses of lines from one scan, one under the other."""
    counts = sources.settle(lines.grouped_counts(fx.parsed(spark, sf)), "grouped")
    levels = lines.of_grouping(counts, lines.BY_LEVEL).drop("severe")
    tables = {
        "errors": lines.error_frequencies(levels),
        "hours": lines.of_grouping(counts, lines.BY_HOUR).withColumn("component", F.col("hour").cast("string")),
        "levels": levels,
        "busiest": lines.top_components(lines.of_grouping(counts, lines.BY_COMPONENT)),
        "severe": lines.top_severe(counts),
    }
    result = None
    for name, rows in tables.items():
        level = "level" if "level" in rows.columns else F.lit(None).cast("string").alias("level")
        one = rows.select(F.lit(name).alias("analysis"), F.col("component").alias("subject"), level, "count")
        result = one if result is None else result.unionByName(one)
    return result


# Analyses of blocks


@query
def label_summary(spark, sf):
    summary = blocks.label_summary(fx.in_blocks(spark, sf), fx.labels(spark, sf))
    return _rounded(summary, "normal_pct", "anomaly_pct")


@query
def anomaly_sequences(spark, sf):
    return blocks.anomaly_sequences(fx.in_blocks(spark, sf), fx.labels(spark, sf))


@query
def anomaly_sequences_top5(spark, sf):
    return blocks.top_sequences(fx.in_blocks(spark, sf), fx.labels(spark, sf))


@query
def component_by_label(spark, sf):
    rows = blocks.component_by_label(fx.in_blocks(spark, sf), fx.labels(spark, sf))
    return _rounded(rows, "percentage")


def _ratios(spark, sf) -> DataFrame:
    return blocks.component_anomaly_ratio(fx.in_blocks(spark, sf), fx.labels(spark, sf))


@query
def component_anomaly_ratio(spark, sf):
    return _rounded(_ratios(spark, sf), "anomaly_ratio")


@query
def component_anomaly_ratio_top10(spark, sf):
    return _rounded(findings.top_anomaly_ratio(_ratios(spark, sf)), "anomaly_ratio")


@query
def latency_stats(spark, sf):
    stats = blocks.latency_stats(fx.in_blocks(spark, sf), fx.labels(spark, sf))
    return _rounded(stats, "avg_latency", "median_latency", "p95_latency")


def _component_latency(spark, sf) -> DataFrame:
    return blocks.component_latency(fx.in_blocks(spark, sf), fx.labels(spark, sf))


@query
def component_latency(spark, sf):
    return _rounded(_component_latency(spark, sf), "avg_latency")


@query
def component_latency_top10(spark, sf):
    return _rounded(findings.slowest_components(_component_latency(spark, sf), 10), "avg_latency")


@query
def component_latency_top15(spark, sf):
    return _rounded(findings.slowest_components(_component_latency(spark, sf), 15), "avg_latency")


@query
def latency_top5_other(spark, sf):
    rows = findings.latency_top_and_other(sources.settle(_component_latency(spark, sf)))
    return _rounded(rows, "avg_latency", "share")


@query
def blocks_with_component(spark, sf):
    return blocks.blocks_with_component(fx.in_blocks(spark, sf), COMPONENT)


@query
def component_latency_bits(spark, sf):
    kept = fx.in_blocks(spark, sf)
    names = sources.settle(lines.distinct_components(kept), "components")
    return _rounded(blocks.component_latency_by_bits(kept, names, fx.labels(spark, sf)), "avg_latency")


@query
def key_findings(spark, sf):
    grouped = sources.settle(lines.grouped_counts(fx.parsed(spark, sf), blocks=True), "grouped")
    return _rounded(findings.of_grouped(grouped, fx.labels(spark, sf)), "value")
