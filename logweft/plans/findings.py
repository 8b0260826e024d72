"""Tables derived from the analyses: rankings, pivots, shares and single findings.

Their inputs are aggregated to one row per component, level or hour.  Functions that use an input
more than once say so; pass those a settled table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweft.plans import blocks, lines
from logweft.plans.lines import top_components

OTHER = "Other Components"


def top_error_components(errors: DataFrame, k: int = 10) -> DataFrame:
    """Components by their sum of errors and warnings."""
    return top_components(errors, k)


def top_anomaly_ratio(ratios: DataFrame, k: int = 10) -> DataFrame:
    return ratios.orderBy(F.desc("anomaly_ratio"), "component").limit(k)


def slowest_components(latencies: DataFrame, k: int = 10) -> DataFrame:
    return latencies.orderBy(F.desc("avg_latency"), "component").limit(k)


def level_pivot(shares: DataFrame, levels: list[str] | None = None) -> DataFrame:
    """Component by level table of percentages, most INFO first; a level without lines is 0.

    Without ``levels`` the columns are the levels that occur.  The blank level becomes ``BLANK``.
    """
    named = shares.withColumn("level", F.when(F.col("level") == "", "BLANK").otherwise(F.col("level")))
    wide = named.groupBy("component").pivot("level", levels).agg(F.sum("percentage")).fillna(0)
    order = [F.desc("INFO")] if "INFO" in wide.columns else []
    return wide.orderBy(*order, "component")


def level_unpivot(wide: DataFrame) -> DataFrame:
    """Back to one row per component and level."""
    levels = [c for c in wide.columns if c != "component"]
    return wide.unpivot("component", levels, "level", "percentage")


def level_stack(long: DataFrame) -> DataFrame:
    """Where each level's bar starts when a component's bars are stacked in level order."""
    below = (
        Window.partitionBy("component").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    )
    return long.withColumn("base", F.coalesce(F.sum("percentage").over(below), F.lit(0.0)))


def level_maps(shares: DataFrame) -> DataFrame:
    """(component, levels): a map from level to percentage, for any number of levels.

    Unlike ``level_pivot`` its schema does not depend on the data: no job runs while it is planned, and
    there is no limit of columns.  A level without lines is not in the map; the blank level is ``BLANK``.
    """
    named = F.when(F.col("level") == "", "BLANK").otherwise(F.col("level"))
    entries = F.array_sort(F.collect_list(F.struct(named.alias("level"), "percentage")))
    return shares.groupBy("component").agg(F.map_from_entries(entries).alias("levels"))


def level_map_stack(maps: DataFrame) -> DataFrame:
    """(component, level, percentage, base): ``level_stack`` from maps, one row for each entry, no shuffle."""
    entries = F.map_entries("levels")
    upto = F.expr("aggregate(slice(shares, 1, at), 0D, (total, share) -> total + share)")
    rows = maps.select("component", F.map_values("levels").alias("shares"), F.posexplode(entries).alias("at", "entry"))
    return rows.select("component", "entry.key", F.col("entry.value").alias("percentage"), upto.alias("base")).withColumnRenamed("key", "level")


def latency_top_and_other(latencies: DataFrame, k: int = 5) -> DataFrame:
    """The slowest ``k`` components and one row that sums the averages of all others.

    ``share`` is each row's percentage of the sum of averages; it compares averages, not time spent.
    ``latencies`` is used twice.
    """
    top = slowest_components(latencies, k)
    rest = latencies.join(F.broadcast(top.select("component")), "component", "left_anti")  # k rows
    other = rest.agg(
        F.lit(OTHER).alias("component"), F.coalesce(F.sum("avg_latency"), F.lit(0.0)).alias("avg_latency")
    )
    rows = top.unionByName(other)
    total = F.sum("avg_latency").over(Window.partitionBy(F.lit(0)))  # k + 1 rows
    return rows.withColumn("share", F.try_divide("avg_latency", total) * 100)


def _finding(name: str, rows: DataFrame, subject: str, measure: Column) -> DataFrame:
    best = rows.orderBy(measure.desc(), F.asc_nulls_last(subject)).limit(1)
    return best.select(
        F.lit(name).alias("finding"),
        F.col(subject).cast("string").alias("subject"),
        measure.cast("double").alias("value"),
    )


def key_findings(
    errors: DataFrame, hourly: DataFrame, ratios: DataFrame, top_levels: DataFrame, latencies: DataFrame
) -> DataFrame:
    """The leading subject of each analysis, one row per finding.

    The error finding falls back to warnings if none of the top components logged an error.
    All inputs are best taken from one settled ``lines.grouped_counts`` with its blocks, which reads the log
    once; ``top_levels`` is used twice.
    """
    share = F.sum(F.when(F.col("level") == F.col("wanted"), F.col("percentage")).otherwise(0.0))
    has_errors = F.bool_or(F.col("level") == "ERROR").over(Window.partitionBy(F.lit(0)))
    severe = F.when(has_errors, "ERROR").otherwise("WARN")  # over the levels of the top components

    def by_component(wanted: Column) -> DataFrame:
        marked = top_levels.withColumn("wanted", wanted)
        return marked.groupBy("component").agg(share.alias("share"))

    findings = [
        _finding("most_issues", top_components(errors, 1), "component", F.col("count")),
        _finding("peak_hour", hourly, "hour", F.col("count")),
        _finding("highest_anomaly_ratio", ratios, "component", F.col("anomaly_ratio")),
        _finding("most_info", by_component(F.lit("INFO")), "component", F.col("share")),
        _finding("most_severe", by_component(severe), "component", F.col("share")),
        _finding("slowest", latencies, "component", F.col("avg_latency")),
    ]
    result = findings[0]
    for finding in findings[1:]:
        result = result.unionByName(finding)
    return result


def of_grouped(grouped: DataFrame, labels: DataFrame) -> DataFrame:
    """``key_findings`` from a settled ``lines.grouped_counts`` with its blocks."""
    levels = lines.of_grouping(grouped, lines.BY_LEVEL).drop("severe")
    pairs = lines.of_grouping(grouped, lines.BY_BLOCK)
    return key_findings(
        lines.error_frequencies(levels),
        lines.of_grouping(grouped, lines.BY_HOUR),
        blocks.component_anomaly_ratio(pairs, labels),
        lines.level_distribution_top(levels),
        blocks.component_latency(pairs, labels),
    )
