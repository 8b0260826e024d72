"""Derived tables on small inputs."""

import pytest

from logweft.plans import findings, lines


def shares(spark, rows):
    df = spark.createDataFrame(rows, "component string, level string, count bigint")
    return lines.level_distribution_top(df, k=2)


def test_pivot_finds_levels_and_orders_by_info(spark):
    rows = [("a", "INFO", 1), ("a", "DEBUG", 3), ("b", "INFO", 4), ("b", "", 4), ("c", "INFO", 1)]
    wide = findings.level_pivot(shares(spark, rows))
    assert wide.columns == ["component", "BLANK", "DEBUG", "INFO"]
    assert [tuple(r) for r in wide.collect()] == [("b", 50.0, 0.0, 50.0), ("a", 0.0, 75.0, 25.0)]
    stack = findings.level_stack(findings.level_unpivot(wide)).orderBy("component", "level")
    assert [r["base"] for r in stack.collect()] == [0, 0, 75, 0, 50, 50]


def test_top_and_other(spark):
    rows = [(f"c{i}", float(i)) for i in range(8)]
    latencies = spark.createDataFrame(rows, "component string, avg_latency double")
    found = {r["component"]: r for r in findings.latency_top_and_other(latencies).collect()}
    assert set(found) == {"c3", "c4", "c5", "c6", "c7", findings.OTHER}
    assert found[findings.OTHER]["avg_latency"] == 3
    assert found["c7"]["share"] == pytest.approx(25)
    few = findings.latency_top_and_other(latencies.filter("avg_latency > 6")).collect()
    assert {r["component"]: r["avg_latency"] for r in few} == {"c7": 7, findings.OTHER: 0}


@pytest.mark.parametrize("severe, winner", [("ERROR", "a"), ("WARN", "b")])
def test_severe_finding_falls_back(spark, severe, winner):
    level_rows = [("a", severe, 1), ("a", "INFO", 1), ("b", "WARN", 3), ("b", "INFO", 1)]
    if severe == "WARN":
        level_rows[2] = ("b", "WARN", 30)
    counts = spark.createDataFrame(level_rows, "component string, level string, count bigint")
    hourly = spark.createDataFrame([(1, 5), (2, 5), (None, 1)], "hour int, count bigint")
    ratios = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "component string, anomaly_ratio double")
    slow = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "component string, avg_latency double")
    found = findings.key_findings(
        lines.error_frequencies(counts), hourly, ratios, lines.level_distribution_top(counts), slow
    )
    subjects = {r["finding"]: r["subject"] for r in found.collect()}
    assert subjects == {
        "most_issues": "b",
        "peak_hour": "1",
        "highest_anomaly_ratio": "a",
        "most_info": "a",
        "most_severe": winner,
        "slowest": "b",
    }


def test_counted_lines_give_the_same_tables(spark):
    import brute

    texts = ["240101 010000 1 WARN a: x", "240101 020000 1 WARN a: y", "240101 020001 1 INFO b: y", "z"]
    parsed = brute.parsed(spark, texts)
    counted = lines.activity_counts(parsed)
    for table in (lines.error_frequencies, lines.hourly_activity, lines.level_distribution, lines.top_components):
        assert table(parsed).collect() == table(counted).collect()


def test_maps_hold_what_the_pivot_shows(spark):
    rows = [("a", "INFO", 1), ("a", "DEBUG", 3), ("b", "INFO", 4), ("b", "", 4)]
    maps = findings.level_maps(shares(spark, rows))
    assert {r["component"]: r["levels"] for r in maps.collect()} == {"a": {"INFO": 25, "DEBUG": 75}, "b": {"BLANK": 50, "INFO": 50}}
    stack = findings.level_map_stack(maps).orderBy("component", "level")
    assert [tuple(r) for r in stack.collect()] == [("a", "DEBUG", 75, 0), ("a", "INFO", 25, 75), ("b", "BLANK", 50, 0), ("b", "INFO", 50, 50)]
    many = spark.range(20_000).selectExpr("'a' AS component", "concat('L', id) AS level", "1D AS percentage")
    assert len(findings.level_maps(many).head()["levels"]) == 20_000  # more than a pivot may have columns


def test_one_pass_agrees_with_single_queries(spark):
    import brute
    from logweft import sources
    from logweft.plans import blocks

    texts = ["240101 010000 1 WARN a: x blk_1", "240101 020000 1 ERROR a: y blk_1", "240101 020001 1 INFO b: blk_2", "z", "y blk_2"]
    parsed = brute.parsed(spark, texts)
    kept = parsed.filter("BlockId <> ''")
    labels = brute.labels(spark, [("blk_1", 1), ("blk_2", 0)])
    grouped = sources.settle(lines.grouped_counts(parsed, blocks=True))
    levels = lines.of_grouping(grouped, lines.BY_LEVEL).drop("severe")
    assert lines.error_frequencies(levels).collect() == lines.error_frequencies(parsed).collect()
    assert lines.level_distribution(levels).collect() == lines.level_distribution(parsed).collect()
    hours = lines.of_grouping(grouped, lines.BY_HOUR).select("hour", "count").orderBy("hour")
    assert hours.collect() == lines.hourly_activity(parsed).collect()
    busiest = lines.top_components(lines.of_grouping(grouped, lines.BY_COMPONENT))
    assert busiest.collect() == lines.top_components(parsed).collect()
    assert lines.top_severe(grouped).collect() == findings.top_error_components(lines.error_frequencies(parsed)).collect()
    pairs = lines.of_grouping(grouped, lines.BY_BLOCK)
    assert blocks.component_latency(pairs, labels).collect() == blocks.component_latency(kept, labels).collect()
    for table in (blocks.component_anomaly_ratio, blocks.component_by_label):
        assert sorted(table(pairs, labels).collect()) == sorted(table(kept, labels).collect())
    empty = lines.grouped_counts(parsed.limit(0), blocks=True)
    assert findings.of_grouped(sources.settle(empty), labels).count() == 0
