"""Block assembly and block analyses against plain Python, on ordinary and on hot blocks."""

import random
import statistics
from collections import Counter
from datetime import datetime

import brute
import pytest

from logweft import functions as fn
from logweft import operators as ops
from logweft.catalog import queries
from logweft.operators import labels as label_ops
from logweft.operators import skew
from logweft.plans import blocks

LABELS = [("blk_-7", 1), ("blk_1", 1), ("blk_2", 0), ("blk_3", 1), ("blk_3", 1), ("blk_4", None)]
LABELS += [("blk_5", 0), ("blk_5", 1), ("blk_absent", 1)]


@pytest.fixture(scope="module")
def lines():
    return brute.synthetic(random.Random(1), 3000)


@pytest.fixture(scope="module")
def kept(spark, lines):
    return fn.drop_missing_blocks(brute.parsed(spark, lines)).persist()


@pytest.fixture(scope="module")
def labels(spark):
    return brute.labels(spark, LABELS)


def profile(kept, limit):
    """A profile that calls every block above ``limit`` lines hot."""
    found = ops.profile_blocks(kept, task_lines=limit)
    assert bool(found.hot) == (limit < 1000)
    return found


@pytest.mark.parametrize("limit, segment", [(10**6, 100_000), (10**6, 64), (150, 100_000), (40, 64)])
def test_records(kept, labels, lines, limit, segment):
    found = ops.block_records_default0(kept, labels, profile(kept, limit), segment)
    expected = brute.records(lines)
    assert brute.joined_records(found) == expected
    sizes = [len(r["events"]) for r in found.select("events").collect()]
    assert max(sizes) <= segment and sum(sizes) == sum(len(r["events"]) for r in expected.values())


@pytest.mark.parametrize("limit", [10**6, 150])
def test_labels_of_records(kept, labels, lines, limit):
    rows = ops.block_records(kept, labels, profile(kept, limit)).select("BlockId", "Label").collect()
    expected = Counter()
    known = dict.fromkeys(brute.records(lines))
    for block in known:
        own = [label for b, label in LABELS if b == block]
        expected.update((block, label) for label in own or [None])
    assert Counter(map(tuple, rows)) == expected
    rows = ops.block_records_default0(kept, labels, profile(kept, limit)).select("BlockId", "Label")
    first = {}
    for block, label in LABELS:
        first.setdefault(block, label or 0)
    assert dict(map(tuple, rows.collect())) == {b: first.get(b, 0) for b in known}


def test_repeated_labels_beyond_one_batch(spark, monkeypatch):
    monkeypatch.setattr(label_ops, "FAN_OUT", 3)
    rows = spark.createDataFrame([("a", 7), ("b", 1), ("c", 3)], "id string, n bigint")
    found = label_ops.repeat_rows(rows, rows["n"]).collect()
    assert Counter(r["id"] for r in found) == {"a": 7, "b": 1, "c": 3}


@pytest.mark.parametrize("limit", [10**6, 40])
def test_places(kept, limit):
    rows = ops.event_intervals(kept, profile(kept, limit)).collect()
    assert len(rows) == brute.count(kept)
    by_block = {}
    for r in rows:
        by_block.setdefault(r["BlockId"], []).append(r)
    for own in by_block.values():
        own.sort(key=lambda r: r["seq_num"])
        assert [r["seq_num"] for r in own] == list(range(1, len(own) + 1))
        assert [r["prev_timestamp"] for r in own] == [None] + [r["timestamp"] for r in own[:-1]]
        keys = [(r["timestamp"] or datetime.min, r["line_no"]) for r in own]
        assert keys == sorted(keys)


@pytest.mark.parametrize("limit, segment", [(10**6, 100_000), (10**6, 64), (150, 100_000), (40, 64)])
def test_sequences(kept, labels, lines, limit, segment):
    rows = blocks.anomaly_sequences(kept, labels, profile(kept, limit), segment).collect()
    whole = {}
    for r in sorted(rows, key=lambda r: r["part"]):
        text, _ = whole.get(r["sequence_id"], ("", 0))
        whole[r["sequence_id"]] = (f"{text},{r['event_sequence']}".lstrip(","), r["count"])
    assert Counter(dict(whole.values())) == brute.sequences(lines, LABELS)


def test_a_long_block_changes_no_other(spark):
    short = [f"240101 00000{s} 1 INFO c: Fetch blk_{b}" for s in range(3) for b in (1, 2)]
    long = short + [f"240101 0000{s:02d} 1 INFO c: Fetch blk_9" for s in range(40)]
    labels = brute.labels(spark, [(f"blk_{b}", 1) for b in (1, 2, 9)])
    seen = []
    for lines, limit in ((short, 10), (long, 10), (long, 1000)):
        kept = brute.parsed(spark, lines)
        found = ops.profile_blocks(kept, limit)
        records = ops.block_records(kept, labels, found, 7).filter("BlockId <> 'blk_9'").collect()
        sequences = blocks.anomaly_sequences(kept, labels, found, 7).filter("count = 2").collect()
        seen.append((sorted(records), sequences))
    assert len(seen[0][0]) == 2 and len(seen[0][1]) == 1
    assert seen[0] == seen[1] == seen[2]


def test_times_have_no_zone(spark):
    lines = [f"240310 {t} 1 INFO c: Fetch blk_1" for t in ("015959", "023000", "033000")]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        kept = brute.parsed(spark, lines)
        record = ops.block_records(kept, brute.labels(spark, [("blk_2", 0)])).head()
        assert (record["intervals"], record["latency"]) == ([0, 1801, 3600], 5401)
        assert [r[0] for r in kept.selectExpr("hour(timestamp) AS h").orderBy("h").collect()] == [1, 2, 3]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_equal_long_sequences_count_together(spark):
    lines = [f"240101 0000{s:02d} 1 INFO c: Fetch {'started' if s % 3 else ''} blk_{b}"
             for s in range(12) for b in (1, 2, 3)]
    lines.append("240101 000059 1 INFO c: Fetch blk_3")
    kept = brute.parsed(spark, lines)
    labels = brute.labels(spark, [("blk_1", 1), ("blk_2", 1), ("blk_3", 1)])
    for limit in (100, 12, 3):
        found = blocks.anomaly_sequences(kept, labels, ops.profile_blocks(kept, limit), 5)
        counts = sorted((r["count"], r["part"]) for r in found.collect())
        assert counts == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2)]
        top = blocks.top_sequences(kept, labels, 1, ops.profile_blocks(kept, limit), 5)
        assert sorted((r["count"], r["part"]) for r in top.collect()) == [(2, 0), (2, 1), (2, 2)]


def test_latency(kept, lines):
    found = {r["BlockId"]: r["latency"] for r in ops.block_latency(kept).collect()}
    assert found == {b: r["latency"] for b, r in brute.records(lines).items()}
    for width in (1, 16):
        assert {r[0]: r[1] for r in ops.latency_at_width(kept, width).collect()} == found
    for layout in ops.LAYOUTS.values():
        assert {r[0]: r[1] for r in ops.block_latency(layout(kept)).collect()} == found


@pytest.mark.parametrize("bits", [0, 3, 16])
def test_ranked(spark, bits, monkeypatch):
    monkeypatch.setattr(blocks, "BIN_BITS", bits)
    rows = [(0, 3), (5, 1), (9, 4), (70_000, 2), (200_000, 1)]
    values = [v for v, n in rows for _ in range(n)]
    found = blocks._ranked(spark.createDataFrame(rows, "latency bigint, n bigint"), list(range(len(values))))
    assert list(found.head()) == values


def weighted(lines):
    """(latency, components, label) per record, repeated labels repeated."""
    for block, record in brute.records(lines).items():
        for label in [label for b, label in LABELS if b == block] or [None]:
            yield record["latency"], record["components"], label


def test_latency_stats(kept, labels, lines):
    values = sorted(v for v, _, _ in weighted(lines))
    row = blocks.latency_stats(kept, labels).head()

    def quantile(p):
        at = p * (len(values) - 1)
        low = int(at)
        return values[low] + (at - low) * (values[min(low + 1, len(values) - 1)] - values[low])

    assert (row["min_latency"], row["max_latency"]) == (values[0], values[-1])
    assert row["avg_latency"] == pytest.approx(statistics.mean(values))
    assert row["median_latency"] == pytest.approx(quantile(0.5))
    assert row["p95_latency"] == pytest.approx(quantile(0.95))


def test_component_tables(kept, labels, lines):
    found = {r[0]: r[1] for r in blocks.component_latency(kept, labels).collect()}
    per, types = {}, Counter()
    for latency, components, label in weighted(lines):
        for c in set(components):
            per.setdefault(c, []).append(latency)
        if label is not None:
            types.update(("anomaly" if label else "normal", c) for c in components)
    assert found == pytest.approx({c: statistics.mean(v) for c, v in per.items()})
    rows = blocks.component_by_label(kept, labels).collect()
    assert {(r["type"], r["component"]): r["count"] for r in rows} == types
    for kind in ("anomaly", "normal"):
        assert sum(r["percentage"] for r in rows if r["type"] == kind) == pytest.approx(100)
    for r in blocks.component_anomaly_ratio(kept, labels).collect():
        anomaly, normal = types["anomaly", r["component"]], types["normal", r["component"]]
        assert r["anomaly_ratio"] == pytest.approx(anomaly / (anomaly + normal))
    summary = blocks.label_summary(kept, labels).head()
    counts = Counter(label for _, _, label in weighted(lines))
    assert (summary["normal"], summary["anomaly"]) == (counts[0], counts[1])


@pytest.mark.parametrize("bits, words", [(63, 16), (1, 16), (2, 1)])
def test_bits_of_components(spark, kept, labels, bits, words, monkeypatch):
    monkeypatch.setattr(blocks, "WORD_BITS", bits)
    monkeypatch.setattr(blocks, "WORDS", words)
    names = kept.select("component").distinct().persist()
    for some in (labels, None):
        want = blocks.component_latency(kept, some).collect()
        got = blocks.component_latency_by_bits(kept, names, some).collect()
        assert [r[0] for r in got] == [r[0] for r in want]
        assert [r[1] for r in got] == pytest.approx([r[1] for r in want])
    assert blocks.component_latency_by_bits(kept.limit(0), names.limit(0), labels).collect() == []


def test_more_components_than_a_word_has_bits(spark):
    lines = [f"240101 0000{i % 60:02d} 1 INFO c{i % 200}: Fetch blk_{i % 7}" for i in range(2000)]
    kept = brute.parsed(spark, lines)
    got = blocks.component_latency_by_bits(kept, kept.select("component").distinct()).collect()
    assert got == blocks.component_latency(kept).collect() and len(got) == 200


def test_sequences_are_counted_by_id(kept, labels):
    found = blocks.anomaly_sequences(kept, labels, profile(kept, 10**6))
    moved = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange " in line]
    assert moved and not any("event_sequence" in line.split("Exchange")[1].split("ENSURE")[0] for line in moved)
    rows = found.collect()
    assert rows == sorted(rows, key=lambda r: (-r["count"], r["sequence_id"], r["part"]))
    top = blocks.top_sequences(kept, labels, 3, profile(kept, 10**6)).collect()
    assert top == rows[:3]


def test_hot_blocks_without_a_profile(kept, labels, lines, monkeypatch):
    from logweft.operators import blocks as block_ops

    monkeypatch.setattr(block_ops, "profile_blocks", lambda rows: skew.profile_blocks(rows, 150))
    assert brute.joined_records(ops.block_records_default0(kept, labels)) == brute.records(lines)
    sequences = blocks.anomaly_sequences(kept, labels).collect()
    assert sequences == blocks.anomaly_sequences(kept, labels, profile(kept, 10**6)).collect()


@pytest.mark.parametrize("limit", [10**6, 150])
def test_stored_lines_need_no_shuffle_by_block(spark, kept, labels, lines, limit):
    stored = ops.store(kept, 3, profile(kept, limit))
    kept_labels = ops.bucketed(labels, 3, "BlockId")
    hot = set(stored.profile.hot)
    assert {r[0] for r in stored.hot.select("BlockId").distinct().collect()} == hot
    assert not hot & {r[0] for r in stored.ordinary.select("BlockId").distinct().collect()}
    found = {r["BlockId"]: r["latency"] for r in ops.block_latency(stored).collect()}
    assert found == {b: r["latency"] for b, r in brute.records(lines).items()}
    records = ops.block_records_default0(stored, kept_labels)
    assert brute.joined_records(records) == brute.records(lines)
    assert sorted(map(str, ops.block_records(stored, kept_labels).collect())) == sorted(
        map(str, ops.block_records(kept, labels, profile(kept, 10**6)).collect())
    )
    assert blocks.component_latency(stored, kept_labels).collect() == blocks.component_latency(kept, labels).collect()
    sequences = blocks.anomaly_sequences(stored, kept_labels).collect()
    assert sequences == blocks.anomaly_sequences(kept, labels, profile(kept, 10**6)).collect()
    if not hot:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            for rows in (ops.block_latency(stored, kept_labels), ops.block_records(stored, kept_labels), blocks.component_latency(stored, kept_labels)):
                plan = rows._jdf.queryExecution().executedPlan().toString()
                assert "hashpartitioning(BlockId" not in plan and "FileScan parquet" in plan
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_anomalous_block(spark, kept):
    normal = brute.labels(spark, [("blk_1", 0)])
    rows = blocks.component_anomaly_ratio(kept, normal).collect()
    assert rows and all(r["anomaly"] == 0 and r["anomaly_ratio"] == 0 for r in rows)
    assert blocks.anomaly_sequences(kept, normal).collect() == []
    none = brute.labels(spark, [("blk_absent", 1)])
    row = blocks.label_summary(kept, none).head()
    assert (row["total"], row["anomaly_pct"]) == (0, None)


def test_all_times_missing(spark):
    kept = brute.parsed(spark, ["x blk_1", "y blk_1", "z blk_1"])
    none = brute.labels(spark, [("blk_2", 0)])
    record = ops.block_records(kept, none).head()
    assert (record["intervals"], record["latency"], record["Label"]) == ([0, 0, 0], 0, None)
    assert blocks.latency_stats(kept).head()["max_latency"] == 0


def test_empty_log(spark):
    kept = brute.parsed(spark, ["x"]).filter("BlockId <> ''")
    none = brute.labels(spark, [("blk_2", 0)])
    assert ops.block_records(kept, none).collect() == []


def test_profile_bounds_its_lists(spark, kept, monkeypatch):
    monkeypatch.setattr(skew, "MAX_HOT", 20)
    found = ops.profile_blocks(kept, task_lines=1)
    assert found.limit == -(-found.lines // 20)
    assert found.hot == ("blk_-7",) and found.slices <= 21


def test_slices_grow_with_lines_and_not_with_a_low_limit():
    for lines in (10**4, 10**5, 10**6, 10**7, 10**8, 10**9):
        short, long = (skew.BlockProfile(2 * lines, limit, lines, ("a",)).slices for limit in (100, 10**6))
        assert long == lines // 10**6 + 1 and short <= max(65, lines // skew.SLICE_LINES + 1)
        assert lines / short <= max(lines / 65, skew.SLICE_LINES)
    assert skew.BlockProfile(900, 100, 450, ("a",)).slices == 5


@pytest.mark.parametrize("name", ["event_intervals_hot", "block_records_segments", "anomaly_sequences_segments", "stored_block_records"])
def test_queries_of_hot_blocks_parse_once(spark, tmp_path, name):
    rows = [(i, datetime(2024, 1, 1, 0, i // 60, i % 60), i, "view", 1.0, '{"k": 1}') for i in range(600)]
    schema = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(1, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = queries.QUERIES[name](spark, str(tmp_path))
    assert found.count() and not any("events.parquet" in path for path in found.inputFiles())


@pytest.mark.parametrize("buckets", [1, 3, 1 << 20])
def test_profile_finds_every_large_block_and_no_other(kept, lines, buckets, monkeypatch):
    monkeypatch.setattr(skew, "BUCKETS", buckets)
    sizes = {b: len(r["events"]) for b, r in brute.records(lines).items()}
    for limit in (1, 40, 150, 10**6):
        found = ops.profile_blocks(kept, limit)
        assert set(found.hot) == {b for b, n in sizes.items() if n > limit}
        assert (found.lines, found.hot_lines) == (sum(sizes.values()), sum(n for n in sizes.values() if n > limit))


def test_order_without_a_profile(kept, lines):
    rows = ops.sequence_events(kept.drop("value"))
    assert rows.columns == [*(c for c in kept.columns if c != "value"), "seq_num", "prev_timestamp"]
    mine = {(r["BlockId"], r["line_no"]): r["seq_num"] for r in rows.collect()}
    theirs = ops.sequence_events(kept, profile(kept, 10**6)).collect()
    assert mine == {(r["BlockId"], r["line_no"]): r["seq_num"] for r in theirs}
