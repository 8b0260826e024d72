"""Approximate nearest neighbours by cross-polytope hashing.

A table of the index turns the unit vectors by a pseudo-rotation, three rounds of random signs and a fast
Hadamard transform, and assigns each to the nearest signed axis.  Every vector is in every table.  A query
looks into the ``PROBES`` axes it is nearest to in each table, and what it meets there is ranked by exact
cosine in double precision.  One hash of d dimensions has 2 d cells; from ``CELL_ROWS`` rows a cell on,
tables use a second hash, and queries look into ``PROBES_TWO`` cells, so that recall stays what it was.
There is no third one: cells of two hashes grow with the input and are cut into parts.

Equal vectors are one row of the index with their least ids, as many as a query can return, so copies of
one vector make no bucket large.  Cells with more than ``PART`` rows are split by a salt that queries are
repeated over, and their queries by another that rows are repeated over.  Queries that meet fewer than k rows are answered by comparing with all rows, in blocks of
queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweft.llm import tables
from logweft.sources.scratch import settle

K = 5
EVERY = 50
TABLES = 12
PROBES = 8
#: Cells looked into where tables have two hashes; 64 of them meet too few of a query's neighbours.
PROBES_TWO = 512
CELL_ROWS = 50_000
PART = 20_000
#: Queries of a cell that meet a part of its rows in one task.
QUERY_PART = 50_000
#: Queries compared with all rows at a time.
BLOCK = 1024
SEED = 7


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the length is a power of two."""
    x, width = x.copy(), 1
    while width < x.shape[1]:
        y = x.reshape(len(x), -1, 2, width)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), -1)
        width *= 2
    return x


def turned(x: np.ndarray, table: int, part: int) -> np.ndarray:
    """Pseudo-rotation of the rows of ``x``, padded to a power of two, for one hash of one table."""
    size = 1 << max(0, x.shape[1] - 1).bit_length()
    signs = np.random.default_rng([SEED, table, part]).choice([-1.0, 1.0], (3, size))
    x = np.pad(x, ((0, 0), (0, size - x.shape[1])))
    for row in signs:
        x = hadamard(x * row) / math.sqrt(size)
    return x


def _axes(y: np.ndarray) -> np.ndarray:
    """Number of each coordinate's nearer signed axis."""
    return 2 * np.arange(y.shape[1]) + (y > 0)


def cells(x: np.ndarray, table: int, hashes: int) -> np.ndarray:
    cell = np.zeros(len(x), np.int64)
    for part in range(hashes):
        y = turned(x, table, part)
        best = np.abs(y).argmax(axis=1)
        cell = cell * 2 * y.shape[1] + _axes(y)[np.arange(len(x)), best]
    return cell


def probed(x: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """The ``probes`` cells each row is nearest to."""
    cell, cost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    for part in range(hashes):
        y = turned(x, table, part)
        near = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :probes]
        size = np.take_along_axis(np.abs(y), near, 1)
        axis = np.take_along_axis(_axes(y), near, 1)
        cell = (cell[:, :, None] * 2 * y.shape[1] + axis[:, None, :]).reshape(len(x), -1)
        cost = (cost[:, :, None] + (size[:, :1] - size)[:, None, :]).reshape(len(x), -1)
        keep = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        cell, cost = np.take_along_axis(cell, keep, 1), np.take_along_axis(cost, keep, 1)
    return cell


def cosines(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return (queries @ rows.T) / np.sqrt((queries**2).sum(1)[:, None] * (rows**2).sum(1)[None, :])


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that have a direction: floats as they are, other numbers as doubles."""
    kept = rows.schema["embedding"].dataType.simpleString() in ("array<float>", "array<double>")
    v = F.col("embedding") if kept else F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).filter(
        F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(some, F.lit(False))
    )


def _dealt(rows: DataFrame, hashes: int, queries: bool, probes: int) -> DataFrame:
    """(dim, tab, cell, id, v) for every table: one cell each, or the probed ones of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A query is many rows, and all pairs of its nearest axes for a moment.
        for batch in tables.slices(batches, max(1, (1 << 15) // probes)) if queries else batches:
            frame = batch.to_pandas()
            for dim, part in frame.groupby("dim"):
                x = np.stack(part.v.to_numpy()).astype(float)
                for table in range(TABLES):
                    where = probed(x, table, hashes, probes) if queries else cells(x, table, hashes)[:, None]
                    pick = np.repeat(np.arange(len(part)), where.shape[1])
                    out = pd.DataFrame({"dim": dim, "tab": table, "cell": where.ravel(), "id": part.id.to_numpy()[pick], "v": part.v.to_numpy()[pick]})
                    yield pa.RecordBatch.from_pandas(out, schema=schema, preserve_index=False)

    kind = rows.schema["v"].dataType.elementType.simpleString()
    number = pa.float32() if kind == "float" else pa.float64()
    schema = pa.schema([("dim", pa.int32()), ("tab", pa.int32()), ("cell", pa.int64()), ("id", pa.int64()), ("v", pa.list_(number))])
    return rows.select("id", "v", F.size("v").alias("dim")).mapInArrow(run, f"dim int, tab int, cell bigint, id bigint, v array<{kind}>")


def _ranked(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of each query, ties by id."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if len(queries) and len(rows):
        x, ids = np.stack(rows.v.to_numpy()).astype(float), rows.id.to_numpy()
        for start in range(0, len(queries), 256):
            part = queries.iloc[start : start + 256]
            score = cosines(np.stack(part.v.to_numpy()).astype(float), x)
            last = -np.partition(-score, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
            q, r = np.nonzero(score >= last[:, None])
            order = np.lexsort((ids[r], -score[q, r], q))
            q, r = q[order], r[order]
            near = np.arange(len(q)) - np.searchsorted(q, q) < k
            q, r = q[near], r[near]
            found.append((part.id.to_numpy()[q], ids[r], score[q, r]))
    return pd.DataFrame({name: np.concatenate(c) for name, c in zip(["query", "id", "score"], zip(*found, strict=True), strict=True)})


FOUND = "query bigint, id bigint, score double"


def exact(queries: DataFrame, rows: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """``query``'s k nearest among all rows (id, v), for queries (id, v): blocks of queries against each task's rows."""
    result, wanted = None, queries.count()
    for start in range(0, wanted, block):
        some = queries.orderBy("id").offset(start).limit(block).toPandas()
        shared = rows.sparkSession.sparkContext.broadcast(some)

        def run(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for dim, part in frame.groupby(frame.v.map(len)):
                    own = shared.value[shared.value.v.map(len) == dim]
                    yield _ranked(own, part, k)

        one = rows.select("id", "v").mapInPandas(run, FOUND)
        result = one if result is None else result.unionByName(one)
    return result if result is not None else queries.sparkSession.createDataFrame([], FOUND)


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows of each row with vec_id divisible by ``every``.

    Of ``vectors`` (vec_id, embedding); nearest first, ties by vec_id, which should be unique: rows with
    the query's own id are not its neighbours.  Vectors that are null, zero, or hold nulls or non-finite
    numbers take no part, nor do null ids.  Only vectors of one length are compared.  A query with fewer
    than k others has those.  Empty tables give an empty result.
    """
    rows = settle(usable(vectors).filter("vec_id IS NOT NULL"), "vectors")
    # Distinct vectors, named by their least id, with the ids that can be among a query's k nearest.
    order = Window.partitionBy("v").orderBy("vec_id")
    first = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    members = settle(first.withColumn("id", F.min("vec_id").over(Window.partitionBy("v"))), "members")
    index = settle(members.filter("place = 1").select("id", "v"), "index")
    queries = settle(rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query"), "v"), "queries")
    asked = settle(queries.groupBy("v").agg(F.min("query").alias("id")), "asked")
    total, widest = index.agg(F.count("*"), F.max(F.size("v"))).first()
    if not total:
        return queries.selectExpr("query AS query_id", "0 AS rank", "query AS vec_id", "0D AS score")
    span = 2 << max(0, widest - 1).bit_length()
    hashes = 1 if total <= CELL_ROWS * span else 2
    dealt = _dealt(index, hashes, False, probes)
    sought = _dealt(asked, hashes, True, probes if hashes == 1 else max(PROBES_TWO, probes**2))
    keys = ["dim", "tab", "cell"]
    both = dealt.select(*keys, F.lit(0).alias("asks")).unionByName(sought.select(*keys, F.lit(1).alias("asks")))
    counts = both.groupBy(*keys).agg(F.ceil(F.count_if(F.col("asks") == 0) / PART).cast("int").alias("parts"), F.ceil(F.sum("asks") / QUERY_PART).cast("int").alias("blocks"))
    # Cells that have both rows and queries; no others can meet.
    parts = tables.bounded(settle(counts.filter("parts > 0 AND blocks > 0"), "cells"))

    def salted(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Each row once for each part of the ``other`` side, with a part of its ``own`` side by hash."""
        rows = rows.join(parts, keys).withColumn(f"{own}_salt", F.pmod(F.xxhash64("id"), F.col(own)).cast("int"))
        return rows.withColumn(f"{other}_salt", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("parts", "blocks")

    left, right = salted(sought, "blocks", "parts"), salted(dealt, "parts", "blocks")

    def meet(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        return _ranked(one, other, k + 1)

    deal = [*keys, "parts_salt", "blocks_salt"]
    met = left.groupBy(*deal).cogroup(right.groupBy(*deal)).applyInPandas(meet, FOUND)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    # A class has k + 1 ids at most and the query is one row of its own class, so k + 1 classes are enough.
    top = met.groupBy("query", "id").agg(F.max("score").alias("score")).withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1)
    top = settle(top.select("query", "id", "score"), "met")

    def expanded(found: DataFrame) -> DataFrame:
        """Neighbours by row: classes to their ids, queries of one vector to each of theirs."""
        own = queries.join(asked.withColumnRenamed("id", "asked"), "v").select("query", "asked")
        ids = members.select("id", "vec_id")
        rows = own.join(found.withColumnRenamed("query", "asked"), "asked").join(ids, "id").filter("query <> vec_id")
        place = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        return rows.select("query", "vec_id", "score", F.row_number().over(place).alias("rank")).filter(F.col("rank") <= k)

    result = settle(expanded(top), "nearest")
    few = result.groupBy("query").agg(F.count("*").alias("n")).filter(F.col("n") >= k)
    short = settle(queries.join(few, "query", "left_anti").join(asked.withColumnRenamed("id", "asked"), "v").select("asked", "v", "query"), "short")
    if short.limit(1).count():
        again = exact(short.groupBy("v").agg(F.min("asked").alias("id")), index, k + 1)
        again = again.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).drop("r")
        more = expanded(again).join(short.select("query"), "query", "left_semi")
        result = result.join(short.select("query"), "query", "left_anti").unionByName(more)
    return result.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


def op8_cross_polytope(spark, sf_dir):
    return nearest(tables.read(spark, sf_dir, "embeddings"))
