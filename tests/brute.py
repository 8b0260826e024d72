"""Plain-Python answers for small logs, written from the definitions."""

import re
from collections import Counter, defaultdict
from datetime import datetime

from pyspark.sql import functions as F

from logweft import functions as fn

MARKERS = [("E1", ["Fetch", "started"]), ("E2", ["Fetch"]), ("E3", ["BLOCK*", "allocate"])]
PREFIX = re.compile(r"(\d{6} \d{6})(?: (\d+)(?: (\w+)(?: ([^:]+))?)?)?", re.ASCII)


def parse(line):
    m = PREFIX.match(line)
    date_time, pid, level, component = (g or "" for g in m.groups()) if m else [""] * 4
    block = re.search(r"blk_-?\d+", line, re.ASCII)
    event = next((e for e, words in MARKERS if all(w in line for w in words)), "Unknown")
    time = None
    if date_time:
        try:
            time = datetime.strptime("20" + date_time, "%Y%m%d %H%M%S")
        except ValueError:
            pass
    return {
        "BlockId": block.group() if block else "",
        "pid": pid,
        "level": level,
        "component": component,
        "EventId": event,
        "time": time,
    }


def records(lines):
    """BlockId -> record, lines without a block left out."""
    blocks = defaultdict(list)
    for number, line in enumerate(lines):
        row = parse(line)
        if row["BlockId"]:
            blocks[row["BlockId"]].append((row["time"] or datetime.min, number, row))
    result = {}
    for block, rows in blocks.items():
        rows = [r for _, _, r in sorted(rows, key=lambda r: r[:2])]
        gaps = [0] + [
            int((b["time"] - a["time"]).total_seconds()) if a["time"] and b["time"] else 0
            for a, b in zip(rows, rows[1:])
        ]
        result[block] = {
            "events": [r["EventId"] for r in rows],
            "intervals": gaps,
            "latency": sum(gaps),
            "levels": [r["level"] for r in rows],
            "components": [r["component"] for r in rows],
            "pids": [r["pid"] for r in rows],
        }
    return result


def sequences(lines, labels):
    """Event sequence -> number of anomalous records, with ``labels`` as (block, label) rows."""
    known = records(lines)
    return Counter(",".join(known[b]["events"]) for b, label in labels if label == 1 and b in known)


def log(spark, lines):
    rows = [("memory", 0, i, line) for i, line in enumerate(lines)]
    schema = "file string, split_start bigint, line_no bigint, value string"
    return spark.createDataFrame(rows, schema).repartition(3)


def parsed(spark, lines):
    return fn.parse_timestamp(fn.parse_fields(fn.classify(log(spark, lines), MARKERS)))


def labels(spark, rows):
    numbered = [(b, label, i) for i, (b, label) in enumerate(rows)]
    return spark.createDataFrame(numbered, "BlockId string, Label int, label_order bigint")


def joined_records(df):
    """Records as a dict, the segments of a block put back together."""
    result = {}
    for row in df.orderBy("BlockId", "segment").collect():
        known = result.setdefault(row["BlockId"], defaultdict(list))
        for name in ("events", "intervals", "levels", "components", "pids"):
            known[name] += row[name]
        known["latency"] = row["latency"] + (known["latency"] or 0)
    return {block: dict(record) for block, record in result.items()}


def synthetic(rng, n, hot_share=0.4, blocks=40):
    """Log lines with one hot block, ties, missing times and lines without a block."""
    texts = ["Fetch started for", "Fetch finished for", "BLOCK* allocate", "Other message"]
    lines = []
    for i in range(n):
        block = "blk_-7" if rng.random() < hot_share else f"blk_{rng.randrange(blocks)}"
        if rng.random() < 0.03:
            block = "nothing"
        if rng.random() < 0.05:
            lines.append(f"broken {block}")
            continue
        second = i // 50 + rng.randrange(3)
        stamp = f"240105 {second // 3600:02d}{second // 60 % 60:02d}{second % 60:02d}"
        level = rng.choice(["INFO", "INFO", "WARN", "ERROR"])
        lines.append(
            f"{stamp} {rng.randrange(90)} {level} svc.N{rng.randrange(5)}: {rng.choice(texts)} {block}"
        )
    return lines


def count(df):
    return df.agg(F.count("*")).head()[0]
