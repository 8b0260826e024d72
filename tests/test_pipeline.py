"""The pipeline from files, and the shape of its plans."""

import os
import random

import brute
import pytest

from logweft import functions as fn
from logweft import operators as ops
from logweft import sources
from logweft.plans import LogAnalyzer, LogPipeline, blocks, lines

TEMPLATES = "EventId,EventTemplate\nE1,Fetch started[*]\nE2,Fetch[*]\nE3,[*]BLOCK* allocate[*]\n"


@pytest.fixture(scope="module")
def texts():
    return brute.synthetic(random.Random(2), 4000)


@pytest.fixture(scope="module")
def data_dir(spark, texts, tmp_path_factory):
    folder = tmp_path_factory.mktemp("data")
    log = folder / "HDFS.log"
    os.makedirs(log)
    # Three files, so that line order has to hold across files and splits.
    for i in range(3):
        part = texts[i * 1500 : (i + 1) * 1500]
        (log / f"part-{i}.txt").write_text("\n".join(part) + "\n")
    (folder / "HDFS.log_templates.csv").write_text(TEMPLATES)
    rows = [f"{b},{label}" for b, label in (("blk_-7", "Anomaly"), ("blk_1", "Normal"), ("blk_2", "odd"))]
    (folder / "anomaly_label.csv").write_text("BlockId,Label\n" + "\n".join(rows) + "\n")
    events = [(sum((r["events"] for r in brute.records(texts).values()), []),)]
    spark.createDataFrame(events, "events array<string>").write.parquet(str(folder / "truth"))
    return str(folder)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_to_records(spark, data_dir, texts, small_splits):
    pipe = LogPipeline(spark, data_dir).pipeline()
    assert pipe.logs.rdd.getNumPartitions() > 3
    assert brute.joined_records(pipe.blocks) == brute.records(texts)
    labels = {r["BlockId"]: r["Label"] for r in pipe.blocks.select("BlockId", "Label").collect()}
    assert (labels["blk_-7"], labels["blk_1"], labels["blk_2"], labels["blk_3"]) == (1, 0, None, None)
    pipe.group(layout=lambda df: df.repartition(5), default_normal=True)
    assert brute.joined_records(pipe.blocks) == brute.records(texts)
    assert {r["Label"] for r in pipe.blocks.filter("BlockId <> 'blk_-7'").collect()} == {0}


def test_hot_route_from_files(spark, data_dir, texts, small_splits):
    pipe = LogPipeline(spark, data_dir).load().parse()
    kept = fn.drop_missing_blocks(pipe.parsed)
    found = ops.block_records(kept, pipe.labels, ops.profile_blocks(kept, 100))
    assert brute.joined_records(found) == brute.records(texts)


def test_line_numbers(spark, data_dir, texts, small_splits, monkeypatch):
    from logweft.sources import files

    logs = sources.read_log(spark, f"{data_dir}/HDFS.log")
    assert logs.rdd.getNumPartitions() > 3
    for splits in (files.SPLITS, 1):
        monkeypatch.setattr(files, "SPLITS", splits)
        rows = sources.number_lines(logs).orderBy("line_number").collect()
        assert [r["line_number"] for r in rows] == list(range(len(texts)))
        assert [r["value"] for r in rows] == texts
    some = sources.number_lines(logs.filter("line_no % 3 = 1")).orderBy("line_number").collect()
    assert [(r["file"], r["split_start"], r["line_no"]) for r in some] == sorted((r["file"], r["split_start"], r["line_no"]) for r in some)


def test_saved_lines_are_sorted_by_number(spark, data_dir, texts, tmp_path, small_splits):
    pipe = LogPipeline(spark, data_dir).load().parse(save_to=str(tmp_path / "parsed")).group()
    assert brute.joined_records(pipe.blocks) == brute.records(texts)
    text = plan(ops.sequence_events(pipe.in_order.select("BlockId", "timestamp", "line_number"), pipe.profile))
    moved = [line for line in text.splitlines() if "Sort [BlockId" in line]
    assert moved and all("line_number" in line and "file" not in line for line in moved)


def test_strict_check(spark, data_dir):
    pipe = LogPipeline(spark, data_dir, truth="truth").load()
    with pytest.raises(ValueError):  # the log has lines without a block
        pipe.parse()
    assert pipe.parse(strict=False).parsed is not None


def test_strict_check_while_writing(spark, data_dir, tmp_path, monkeypatch):
    from logweft.operators import validate

    pipe = LogPipeline(spark, data_dir, truth="truth").load()
    seen = []
    monkeypatch.setattr(ops, "check_parsed", lambda *args: seen.append(args))
    with pytest.raises(ValueError, match="Event Mismatch"):  # events of lines without a block are not in the truth
        pipe.parse(save_to=str(tmp_path / "one"))
    assert not seen  # no job of its own
    monkeypatch.setattr(validate, "OBSERVED", 1)
    pipe.parse(save_to=str(tmp_path / "two"))
    assert len(seen) == 1


def test_watched_counts(spark):
    rows = ["Fetch started blk_1", "Fetch blk_1", "Fetch blk_2", "Fetch"]
    expected = spark.createDataFrame([("E1", 1), ("E2", 3), ("E3", 0)], "EventId string, expected bigint")
    parsed, counts = ops.watched(brute.parsed(spark, rows), expected)
    parsed.write.format("noop").mode("overwrite").save()
    assert counts.rows() == [("E1", 1, 1), ("E2", 3, 3), ("E3", 0, 0)] and counts.missing == 1
    with pytest.raises(ValueError, match="Blocks Missing: 1 lines"):
        counts.check()
    parsed, counts = ops.watched(brute.parsed(spark, rows[:1]), expected)
    parsed.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError, match="'E2', 'expected': 3, 'actual': 0"):
        counts.check()


def test_findings_read_the_log_once(spark, data_dir):
    pipe = LogPipeline(spark, data_dir).load().parse()
    text = plan(lines.grouped_counts(pipe.parsed, blocks=True))
    assert text.count("FileScan text") == 1 and exchanges(text) == 1
    text = plan(LogAnalyzer(pipe).key_findings())
    assert "FileScan text" not in text


def test_analyses(spark, data_dir, texts, tmp_path):
    pipe = LogPipeline(spark, data_dir).load().parse(save_to=str(tmp_path / "parsed"))
    results = LogAnalyzer(pipe).run_all_analyses()
    assert set(results) == {
        "error_frequencies",
        "peak_activity_times",
        "failure_patterns",
        "log_level_distribution",
        "performance_metrics",
    }
    sequences = results["failure_patterns"]["anomaly_events"].collect()
    assert {r["event_sequence"]: r["count"] for r in sequences} == brute.sequences(texts, [("blk_-7", 1)])
    assert sum(r["count"] for r in results["peak_activity_times"].collect()) == len(texts)
    assert LogAnalyzer(pipe).key_findings().count() == 6


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return sum("Exchange " in line and "Reused" not in line for line in text.splitlines())


def test_ordering_takes_one_shuffle_and_one_window(spark, data_dir):
    pipe = LogPipeline(spark, data_dir).load().parse()
    kept = fn.drop_missing_blocks(pipe.parsed)
    text = plan(ops.event_intervals(kept, pipe.profile))
    assert (exchanges(text), text.count("Window [")) == (1, 1)
    # Assembly adds no shuffle of lines: the other exchanges are those of the label table.
    text = plan(ops.block_records(kept, pipe.labels, pipe.profile))
    assert text.count("Exchange hashpartitioning(BlockId") == 2 and "Python" not in text


def test_latency_shrinks_before_its_shuffle(spark, data_dir):
    pipe = LogPipeline(spark, data_dir).load().parse()
    text = plan(ops.block_latency(pipe.parsed))
    assert exchanges(text) == 1 and "partial_min(timestamp" in text and "collect_list" not in text


def test_saved_lines_are_read_by_column_and_filtered_in_the_scan(spark, data_dir, tmp_path):
    pipe = LogPipeline(spark, data_dir).load().parse(save_to=str(tmp_path / "parsed"))
    df = lines.error_frequencies(pipe.parsed)
    text = plan(df)
    assert "ReadSchema: struct<level:string,component:string>" in text
    assert "PushedFilters: [In(level, [ERROR,WARN])]" in text
    text = plan(ops.block_latency(fn.drop_missing_blocks(pipe.parsed)))
    assert "ReadSchema: struct<BlockId:string,timestamp:timestamp_ntz>" in text


def test_component_latency_reads_the_log_once(spark, data_dir):
    pipe = LogPipeline(spark, data_dir).load().parse()
    df = blocks.component_latency(pipe.parsed)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("FileScan text") == 1


def test_scratch_folder_follows_the_session(spark):
    first, second = sources.new_folder(spark, "x"), sources.new_folder(spark, "x")
    assert first != second
