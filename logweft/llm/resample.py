"""Importance resampling towards a target by hashed word features.

An untrained Regex Split of the tokenizers library gives the words of an ASCII-lowered text with their
offsets.  Windows over pairs of offsets are the features: runs of one word and of two.  A feature counts
in the bucket of its CRC.  The histograms of all documents and of all target texts give each bucket a
gain, and a document's weight is the mean gain of its features.  Noise that depends on the id alone is
added, and the highest scores are drawn, which samples without replacement in proportion to the weights.

Texts are read once: what is written is two bytes a feature.  A task counts its own histogram before
anything is shuffled.  Ranks come from a range sort over many tasks and the sizes of its slices.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweft.llm import tables
from logweft.sources.scratch import settle

BUCKETS = 10_000
#: Words of the longest run.
RUN = 2
#: Words a document needs to be drawn, and the percentage that is.
LEAST_WORDS, DRAWN = 20, 25
#: Fixed value: what a word is made of, once A to Z are lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Characters of a text that are split at a time, up to the end of a word.
PIECE = 1 << 18


@lru_cache(maxsize=1)
def _splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def words(text: str) -> Iterator[list[bytes]]:
    """The words of ``text``, in lists of those of a piece."""
    data = text.encode("utf-8", "surrogatepass")
    low = data.lower().decode("utf-8", "replace")  # of bytes, this lowers A to Z alone
    start, gap, split = 0, regex.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"), _splitter()
    while start < len(low):
        seam = gap.search(low, start + PIECE) if len(low) - start > PIECE else None
        stop = seam.start() if seam else len(low)
        found = split.pre_tokenize_str(low[start:stop])
        yield [word.encode() for word, _ in found]
        start = stop


def features(text: str, buckets: int = BUCKETS, run: int = RUN) -> tuple[int, np.ndarray]:
    """The number of words of ``text``, and the bucket of each run of 1 to ``run`` of them."""
    count, parts, held = 0, [], []
    for some in words(text):
        count += len(some)
        own = held + some  # the last words of the piece before open runs that end in this one
        line = b" ".join(own)
        stops = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
        starts = np.r_[0, stops + 1][:-1].tolist()
        stops = stops.tolist()
        for k in range(run):
            windows = zip(starts[max(0, len(held) - k) :], stops[max(0, len(held) - k) + k :], strict=False)
            codes = [crc32(line[a:b]) for a, b in windows]
            parts.append(np.array(codes, np.uint32) % np.uint32(buckets))
        held = own[max(0, len(own) - run + 1) :] if run > 1 else []
    return count, np.concatenate(parts or [np.zeros(0, np.uint32)]).astype("<u2")


def bucketed(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, features binary) of ``docs`` (id, text); a feature is its bucket in two bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.slices(batches):
            found = [features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([f.tobytes() for _, f in found], pa.binary())],
                ["doc_id", "n_words", "features"],
            )

    rows = tables.texts(docs, id_column)
    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, features binary")


def histogram(rows: DataFrame) -> DataFrame:
    """(bucket, n) of ``bucketed`` rows; a task sends a row for each bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in tables.slices(batches):
            joined = b"".join(batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(joined, "<u2"), minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counted = rows.select("features").mapInArrow(run, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(own: DataFrame, target: DataFrame) -> list[int]:
    """For each bucket, a thousand times the log ratio of its smoothed shares in target and own features.

    ``own`` and ``target`` are ``bucketed`` rows.  What the driver gets is ``BUCKETS`` rows for each.
    """
    counts = []
    for rows in (own, target):
        found = dict(map(tuple, histogram(rows).collect()))
        counts.append([float(found.get(k, 0)) for k in range(BUCKETS)])
    s_all, t_all = map(sum, counts)
    return [math.floor(1000 * math.log((t + 1) * (s_all + BUCKETS) / ((s + 1) * (t_all + BUCKETS)))) for s, t in zip(*counts, strict=True)]


def weighed(rows: DataFrame, gain: list[int]) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of each row's features, 0 without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(gain, np.int64)
        for batch in tables.slices(batches):
            counts, means = [], []
            for packed in batch.column("features").to_pylist():
                found = np.frombuffer(packed, "<u2")
                counts.append(len(found))
                means.append(int(table[found].sum()) // len(found) if len(found) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(counts, pa.int64()), pa.array(means, pa.int64())],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank``, 1 for the highest score, ties by id, null ids last.

    Rows are range-sorted; a row's rank is its place in its slice and the sizes of the slices before it.
    Rows alike in both are told apart by where they were read, so equal rows do not meet in one task.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("place")]
    spread = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*order)
    # The id counts from 0 in each partition, in sorted order, with the partition above bit 33.
    sliced = spread.sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()).drop("place")
    sliced = settle(sliced.withColumns({"slice": F.shiftright("at", 33), "row": F.expr("at & 8589934591L")}).drop("at"), "slices")
    sizes = sliced.groupBy("slice").agg(F.count("*").alias("size"))  # a row for each task of the sort
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("slice", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return sliced.join(F.broadcast(offsets), "slice").withColumn("rank", F.col("offset") + F.col("row") + 1).drop("slice", "row", "offset")


def resampled(docs: DataFrame, target: DataFrame, seed: int = 7, least: int = LEAST_WORDS, drawn: int = DRAWN) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each row of ``docs`` (doc_id, text).

    ``target`` has (item_id, text).  Of the rows with at least ``least`` words the ``drawn`` percent of the
    highest scores have a rank, from 1; ties go to the smaller id, null ids last.  Null texts are empty,
    and texts without words weigh 0.  Noise depends on ``seed`` and the id alone: rows that share an id
    share it, repeated rows come back repeated, and a null id hashes as empty text.  Without documents the
    result is empty; without target texts the gains are those of an even target.  A long text is split
    in pieces.
    """
    own = settle(bucketed(docs), "buckets")
    gain = gains(own, bucketed(target, "item_id"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = settle(weighed(own, gain).withColumn("score", F.col("weight") + noise), "scored")
    able = scored.filter(F.col("n_words") >= least)
    draw = drawn * able.count() // 100
    rank = F.when(F.col("rank") <= draw, F.col("rank"))
    both = ranked(able).withColumn("rank", rank).unionByName(scored.filter(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("bigint")))
    return both.select("doc_id", "n_features", "weight", "score", "rank")


def op12_resample(spark, sf_dir):
    return resampled(tables.read(spark, sf_dir, "documents"), tables.read(spark, sf_dir, "benchmark"))
