"""Fields, times, templates and labels on single lines."""

import random

import brute
import pytest

from logweft import functions as fn
from logweft import operators as ops
from logweft import sources

FIELDS = ["date_time", "pid", "level", "component", "BlockId"]


def fields(spark, line):
    return list(fn.parse_fields(brute.log(spark, [line])).select(*FIELDS).head())


@pytest.mark.parametrize(
    "line, expected",
    [
        ("991231 235959 1 WARN c: blk_-1 and blk_2", ["991231 235959", "1", "WARN", "c", "blk_-1"]),
        ("garbage blk_-5", ["", "", "", "", "blk_-5"]),
        ("081109 203615 148 INFO a.B$C: m blk_3", ["081109 203615", "148", "INFO", "a.B$C", "blk_3"]),
        ("081109 203615 148 INFO", ["081109 203615", "148", "INFO", "", ""]),
        ("081109 203615 x", ["081109 203615", "", "", "", ""]),
        ("٠٨١١٠٩ 203615 1 INFO c: blk_٣", ["", "", "", "", ""]),
        ("", ["", "", "", "", ""]),
    ],
)
def test_fields(spark, line, expected):
    assert fields(spark, line) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("991231 235959", "2099-12-31 23:59:59"),
        ("700101 000000", "2070-01-01 00:00:00"),
        ("240229 120000", "2024-02-29 12:00:00"),
        ("230229 120000", None),
        ("991332 235959", None),
        ("991231 246060", None),
        ("", None),
    ],
)
def test_times(spark, text, expected):
    time = spark.createDataFrame([(text,)], "date_time string").select(fn.parse_time()).head()[0]
    assert (time and str(time)) == expected


def test_fields_of_random_lines(spark):
    rng = random.Random(3)
    pieces = ["240105 010203", "24010 1", " ", " ", ":", "INFO", "a.b", "blk_", "-", "7", "٣", "é", "$", "\t"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(14))) for _ in range(3000)]
    rows = brute.parsed(spark, texts).orderBy("line_no").collect()
    for text, row in zip(texts, rows):
        expected = brute.parse(text)
        assert {k: row[k] for k in expected if k != "time"} == {
            k: v for k, v in expected.items() if k != "time"
        }, text
        assert row["timestamp"] == expected["time"], text


def test_bad_time_keeps_the_other_fields(spark):
    row = fn.parse_timestamp(fn.parse_fields(brute.log(spark, ["991332 235959 1 WARN c: x"]))).head()
    assert row["timestamp"] is None and row["level"] == "WARN"


def templates(spark, *rows):
    numbered = [(i, e, t) for i, (e, t) in enumerate(rows)]
    return spark.createDataFrame(numbered, "priority int, EventId string, EventTemplate string")


def test_markers(spark):
    rows = [("A", "[*]BLOCK* ask [*] to replicate a.b:c"), ("B", "[*]")]
    assert fn.collect_markers(templates(spark, *rows)) == [
        ("A", ["BLOCK*", "ask", "to", "replicate", "a.b:c"]),
        ("B", []),
    ]


def test_repeated_event_has_first_place_and_last_words(spark):
    rows = [("A", "one"), ("B", "two"), ("A", "three")]
    assert fn.collect_markers(templates(spark, *rows)) == [("A", ["three"]), ("B", ["two"])]


def by_chains(lines, markers):
    return lines.withColumn("EventId", fn.event_by_chain(markers, width=1)) if markers else fn.classify(lines, markers)


@pytest.mark.parametrize("classify", [fn.classify, fn.classify_by_index, by_chains])
def test_first_match_wins(spark, classify):
    markers = [("A", ["Fetch", "started"]), ("B", ["Fetch"]), ("C", []), ("D", ["never"])]
    lines = ["started a Fetch", "xFetchx", "fetch", "", "never"]
    result = classify(brute.log(spark, lines), markers).orderBy("line_no").collect()
    assert [r["EventId"] for r in result] == ["A", "B", "C", "C", "C"]


@pytest.mark.parametrize("classify", [fn.classify, fn.classify_by_index, by_chains])
def test_no_match_is_unknown(spark, classify):
    assert classify(brute.log(spark, ["x"]), [("A", ["y"])]).head()["EventId"] == "Unknown"
    assert classify(brute.log(spark, ["x"]), []).head()["EventId"] == "Unknown"


def test_index_agrees_with_chains(spark):
    rng = random.Random(9)
    words = ["ab", "b", "abc", "ca", "BLOCK*", "é", "c:", "x.y", "a"]
    markers = [(f"E{i}", rng.choices(words, k=rng.randrange(1, 4))) for i in range(150)]
    texts = [None, *("".join(rng.choices([*"abc.:x *é", "BLOCK*", "x.y"], k=rng.randrange(9))) for _ in range(2000))]
    rows = spark.createDataFrame(list(enumerate(texts)), "line_no int, value string")
    for some in (markers, [*markers[:20], ("all", []), *markers[20:]]):
        one = rows.select("line_no", fn.event_by_chain(some).alias("EventId"))
        other = fn.classify(rows, some).select("line_no", "EventId")
        assert sorted(one.collect()) == sorted(other.collect())
    assert len(fn.classify(rows, markers)._jdf.queryExecution().toString()) < 3000


def test_thousands_of_templates(spark):
    markers = [(f"E{i}", [f"word{i}x", "msg"]) for i in range(2000)]
    lines = brute.log(spark, ["msg word1999x", "word3x msg", "msg word3"])
    assert [r["EventId"] for r in fn.classify(lines, markers).orderBy("line_no").collect()] == [
        "E1999",
        "E3",
        "Unknown",
    ]


def test_rows_without_id_or_template_are_no_templates(spark):
    rows = [(None, "a"), (" ", "b"), ("C", None), ("D", "d[*]")]
    assert fn.collect_markers(templates(spark, *rows)) == [("D", ["d"])]


def test_labels(spark):
    df = spark.createDataFrame([("Normal",), ("Anomaly",), ("odd",)], "Label string")
    assert [r[0] for r in fn.encode_labels(df).collect()] == [0, 1, None]


def test_array_to_string(spark):
    fn.register_functions(spark)
    row = spark.sql(
        "SELECT array_to_string(array('a','','b')) x, array_to_string(CAST(NULL AS ARRAY<STRING>)) y"
    ).head()
    assert (row["x"], row["y"]) == ("a,,b", None)


def test_checks(spark):
    parsed = brute.parsed(spark, ["Fetch started blk_1", "Fetch blk_1", "Fetch blk_2"])
    good = spark.createDataFrame([("E1", 1), ("E2", 2)], "EventId string, expected bigint")
    ops.check_parsed(parsed, good)
    short = spark.createDataFrame([("E3", 1)], "EventId string, expected bigint")
    row = ops.event_count_violations(parsed, short).head()
    assert (row["EventId"], row["expected"], row["actual"]) == ("E3", 1, 0)
    with pytest.raises(ValueError, match="Event Mismatch"):
        ops.check_parsed(parsed, short)
    with pytest.raises(ValueError, match="Blocks Missing"):
        ops.check_parsed(brute.parsed(spark, ["Fetch started", "Fetch", "Fetch"]), good)


def test_truth_counts(spark):
    truth = spark.createDataFrame([(["E1", "E2"],), (["E1"],), ([],)], "events array<string>")
    counts = {r["EventId"]: r["expected"] for r in sources.truth_event_counts(truth).collect()}
    assert counts == {"E1": 2, "E2": 1}
