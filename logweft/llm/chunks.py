"""Substring dedup by content-defined chunking.

A gear hash rolls over a text's UTF-8 bytes: each step doubles it and adds the byte's random value, so in
16 bits it depends on the last 16 bytes alone.  Where it is small, a chunk ends.  An insertion moves
boundaries only near itself, so a passage has the same chunks wherever it stands.  Chunks are equal if
their 96-bit digests are; all but the first occurrence of a digest are repeats, and neighbouring
repeats of a document are a run.

Chunks are anchors only: the ends of a run are chunk edges, not those of the repeated passage.  So the
bytes on both sides of a run are compared with those beside its source, byte by byte, and the span
that grows from this is reported if it is long enough.

Counts come first, so only chunks that occur twice are looked at further, and a chunk in very many
documents is a number per task before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweft.llm import tables
from logweft.sources.scratch import settle

#: Mean bytes between boundaries, and least and most bytes of a chunk.
MEAN, LEAST, MOST = 24, 16, 512
#: Bytes from which repeats are reported, as one span: 99 of 100 passages of 51 words are longer.
SPAN = 240
#: Bytes on each side of a run that are compared with those beside its source.  An edge that is longer, which
#: about one in fifty is, is cut there.
REACH = 96
#: Bytes of a text hashed at a time.
PIECE = 1 << 22
GEAR = np.random.default_rng(20).integers(0, 1 << 16, 256).astype(np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """16-bit gear hash after each byte, by doubling steps over all positions at once."""
    rolled, width = GEAR[data], 1
    while width < 16:
        rolled[width:] += rolled[:-width] << np.uint16(width)
        width *= 2
    return rolled


def ends(data: np.ndarray) -> list[int]:
    """Where the chunks of ``data`` end."""
    small = (1 << 16) // MEAN
    cuts: list[int] = []
    start = 0
    for piece in range(0, len(data), PIECE):
        back = min(piece, 15)
        rolled = gear(data[piece - back : piece + PIECE])[back:]
        for cut in (np.flatnonzero(rolled < small) + (piece + 1)).tolist():
            while cut - start > MOST:
                start += MOST
                cuts.append(start)
            if cut - start >= LEAST:
                start = cut
                cuts.append(cut)
    while len(data) - start > MOST:
        start += MOST
        cuts.append(start)
    if start < len(data):
        cuts.append(len(data))
    return cuts


def marked(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text): a row is known by its id and its text."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def chunked(docs: DataFrame) -> DataFrame:
    """(d1, d2, doc_id, text_hash, start, size) of the chunks of ``marked`` documents, in bytes of UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for some in tables.slices(batches):
            digests, starts, sizes, many = [], [], [], []
            for text in some.column("text"):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                stops = ends(np.frombuffer(data, np.uint8))
                begins = [0, *stops[:-1]] if stops else []
                digests += [digest(data[a:b]) for a, b in zip(begins, stops, strict=True)]
                starts += begins
                sizes += [b - a for a, b in zip(begins, stops, strict=True)]
                many.append(len(stops))
            both = np.frombuffer(b"".join(digests), np.dtype([("d1", "<i8"), ("d2", "<i4"), ("", "<i4")]))
            owner = pa.array(np.repeat(np.arange(len(many)), many))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(both["d1"].copy()), pa.array(both["d2"].copy()), some.column("doc_id").take(owner), some.column("text_hash").take(owner),
                    pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()),
                ],
                ["d1", "d2", "doc_id", "text_hash", "start", "size"],
            )

    return docs.mapInArrow(run, "d1 bigint, d2 int, doc_id bigint, text_hash bigint, start int, size int")


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, stop, head, tail): runs of repeated chunks of ``marked`` documents.

    ``head`` is the place, a struct (doc_id, text_hash, at), where the source of the first chunk begins, and
    ``tail`` where that of the last one ends.
    """
    chunks = settle(chunked(docs), "chunks")
    digest = ["d1", "d2"]
    # Two thirds of the digest are enough to leave out what is there once.
    shared = settle(chunks.groupBy("d1").agg(F.count("*").alias("n")).filter("n > 1").select("d1"), "shared")
    # One form at every size, so that what is shuffled grows as the texts do; Spark broadcasts what is small.
    common = settle(chunks.join(shared, "d1"), "common")
    first = common.groupBy(*digest).agg(F.min(F.struct("doc_id", "text_hash", "start")).alias("first"))
    # Rows alike in id and text are one document.
    itself = "doc_id <=> first.doc_id AND text_hash = first.text_hash AND start = first.start"
    copies = common.join(first, digest).filter(f"NOT ({itself})").select("doc_id", "text_hash", "start", "size", "first")
    # Dealt by document, once for what follows.
    copies = copies.repartition("doc_id", "text_hash").distinct()
    in_doc = Window.partitionBy("doc_id", "text_hash").orderBy("start")
    opens = F.coalesce(F.lag(F.col("start") + F.col("size")).over(in_doc) != F.col("start"), F.lit(True))
    numbered = copies.withColumn("opens", opens.cast("int")).withColumn("run", F.sum("opens").over(in_doc))

    def place(at: str) -> Column:
        return F.struct("first.doc_id", "first.text_hash", F.expr(at).cast("int").alias("at"))

    return numbered.groupBy("doc_id", "text_hash", "run").agg(
        F.min("start").alias("start"),
        F.max(F.col("start") + F.col("size")).alias("stop"),
        F.min_by(place("first.start"), "start").alias("head"),
        F.max_by(place("first.start + size"), "start").alias("tail"),
    )


def _beside(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (doc_id, text_hash, start, stop, head, tail, before, after) of two kinds, from one pass over texts.

    For each of the runs ``found``, itself with the bytes before its start and after its stop; for each
    place that is a run's head or tail, its bytes on that side, with the place as start and a null stop.
    A document's runs, and its places, are no more than its chunks.
    """
    key = ["doc_id", "text_hash"]
    own = found.groupBy(*key).agg(F.collect_list(F.struct("start", "stop", "head", "tail")).alias("runs"))
    places = found.select("head.*", F.lit(True).alias("is_head")).unionByName(found.select("tail.*", F.lit(False).alias("is_head"))).distinct()
    sources = places.groupBy(*key).agg(F.collect_list(F.struct("at", "is_head")).alias("places"))
    both = own.select(*[F.col(k).alias(f"own_{k}") for k in key], "runs").join(
        sources, F.col("own_doc_id").eqNullSafe(F.col("doc_id")) & F.col("own_text_hash").eqNullSafe(F.col("text_hash")), "full"
    )
    there = F.col("runs").isNotNull()
    wanted = both.select(*[F.when(there, F.col(f"own_{k}")).otherwise(F.col(k)).alias(f"_{k}") for k in key], "runs", "places")
    joined = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash")))
    names = ["doc_id", "text_hash", "start", "stop", "head", "tail", "before", "after"]
    place = pa.struct([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("at", pa.int32())])
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), place, place, pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in tables.slices(batches, 64):
            rows: list[tuple] = []
            for row in some.to_pylist():
                data = row["text"].encode("utf-8", "surrogatepass")
                ids = row["doc_id"], row["text_hash"]
                for r in row["runs"] or ():
                    before, after = data[max(0, r["start"] - REACH) : r["start"]], data[r["stop"] : r["stop"] + REACH]
                    rows.append((*ids, r["start"], r["stop"], r["head"], r["tail"], before, after))
                for p in row["places"] or ():
                    at = p["at"]
                    before, after = (data[max(0, at - REACH) : at], None) if p["is_head"] else (None, data[at : at + REACH])
                    rows.append((*ids, at, None, None, None, before, after))
            for k in range(0, len(rows), 4096):
                columns = zip(*rows[k : k + 4096], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    needed = joined.select(*key, "text", "runs", "places")
    struct = "struct<doc_id: bigint, text_hash: bigint, at: int>"
    return needed.mapInArrow(run, f"doc_id bigint, text_hash bigint, start int, stop int, head {struct}, tail {struct}, before binary, after binary")


def alike(one: bytes, other: bytes) -> int:
    """How many first bytes of two strings are equal."""
    size = min(len(one), len(other))
    if one[:size] == other[:size]:
        return size
    differ = np.frombuffer(one, np.uint8, size) != np.frombuffer(other, np.uint8, size)
    return int(differ.argmax())


def repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, start, size, source_doc_id, source_start): spans of ``docs`` (doc_id, text) seen before.

    Positions are bytes of UTF-8.  A document is a row's id and text: rows that share an id, or have none,
    and differ in their texts are compared like any others; in repeated rows with one text a span is
    reported once and is no repeat of itself.  The first occurrence of a chunk, by id, nulls first, text
    hash and start, is no repeat.  Spans of fewer than ``span`` bytes are left out.  The source is that
    of the span's first chunk.  Empty texts and tables have no spans; a text of any length is hashed in
    pieces.
    """
    own = marked(docs)
    # Shorter runs cannot reach the wanted span.
    found = settle(runs(own).drop("run").filter(F.col("stop") - F.col("start") + 2 * REACH >= span), "runs")
    beside = settle(_beside(own, found), "beside")
    # Rows alike in id and text have said the same.
    grown = beside.filter("stop IS NOT NULL").dropDuplicates(["doc_id", "text_hash", "start"])
    for end, side in (("head", "before"), ("tail", "after")):
        sources = beside.filter(f"stop IS NULL AND {side} IS NOT NULL").select(*[F.col(c).alias(f"{end}_{c}") for c in ("doc_id", "text_hash", "start", side)])
        sources = sources.dropDuplicates([f"{end}_{c}" for c in ("doc_id", "text_hash", "start")])
        same = F.col(f"{end}.doc_id").eqNullSafe(F.col(f"{end}_doc_id")) & (F.col(f"{end}.text_hash") == F.col(f"{end}_text_hash")) & (F.col(f"{end}.at") == F.col(f"{end}_start"))
        grown = grown.join(sources, same)

    @F.pandas_udf("struct<left: int, right: int>")
    def reached(before: pd.Series, head_before: pd.Series, after: pd.Series, tail_after: pd.Series) -> pd.DataFrame:
        left = [alike(a[::-1], b[::-1]) for a, b in zip(before, head_before, strict=True)]
        right = [alike(a, b) for a, b in zip(after, tail_after, strict=True)]
        return pd.DataFrame({"left": np.array(left, np.int32), "right": np.array(right, np.int32)})

    grown = grown.withColumn("more", reached("before", "head_before", "after", "tail_after"))
    return grown.selectExpr(
        "doc_id", "CAST(start - more.left AS bigint) AS start", "CAST(stop - start + more.left + more.right AS bigint) AS size",
        "head.doc_id AS source_doc_id", "CAST(head.at - more.left AS bigint) AS source_start",
    ).filter(F.col("size") >= span)


def op6_chunk_dedup(spark, sf_dir):
    return repeats(tables.texts(tables.read(spark, sf_dir, "documents")))
