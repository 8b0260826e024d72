"""SimHash near-duplicates: 64-bit fingerprints linked within a Hamming distance by a trie self-join.

Fingerprints are reduced to distinct values first, so copies cost nothing further.  Two fingerprints
within ``distance`` bits agree on at least one of ``distance + 1`` bit blocks; each fingerprint enters
that many tries, one per block, rotated so that the block is on top, and only node pairs below the same
block value are walked.  A walk descends both nodes bit by bit, adds up the bits in which they differ
and drops a pair as soon as the budget is exceeded.  A block value with more fingerprints than
``GROUP`` is cut further by the bits below it: a pair of subtries whose heads differ by no more than the
budget is a group of its own, so the walks of one hot block run in many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.llm import tables
from logweft.llm.components import components
from logweft.sources.scratch import settle

#: Shingles hashed at a time, which bounds the memory of a very long text.
SHINGLES = 1 << 16
#: Fingerprints of one block value above which its subtries become groups of their own.
GROUP = 1 << 14
#: Most bits by which a block value is cut further.
MAX_CUT = 10
#: Rows a task gathers, up to the end of a group, before it walks.
ROWS = 1 << 18
#: Node pairs a walk expands at a time.
FRONTIER = 1 << 20


def fingerprint(text: str, shingle: int = 3) -> int:
    """64-bit SimHash of word shingles, as a signed integer; a text without words has 0."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    total = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, total, SHINGLES):
        part = words[start : min(start + SHINGLES, total) + width - 1]
        runs = zip(*(part[k:] for k in range(width)), strict=False)
        hashes = np.fromiter((digest(s, 42) for s in map(b" ".join, runs)), np.uint64)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    value = np.packbits(ones * 2 > total).view(">u8")[0]
    return int(value.astype(np.uint64).view(np.int64))


def fingerprint_of(text: Column | str, shingle: int = 3) -> Column:
    """``fingerprint`` as a column."""

    @F.pandas_udf("bigint")
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t or "", shingle) for t in column], dtype="int64")

    return run(text)


def rotate(values: np.ndarray, by: int) -> np.ndarray:
    return values if by % 64 == 0 else (values << np.uint64(by)) | (values >> np.uint64(64 - by))


def walk(left: np.ndarray, right: np.ndarray | None, depth: int, budget: int) -> Iterator[np.ndarray]:
    """Index pairs of sorted 64-bit values with at most ``budget`` differing bits.

    The roots are the runs of values with equal top ``depth`` bits in ``left``, paired with
    themselves, or, where ``right`` is given, the whole of both.  Ranges of a sorted array are the
    nodes of its trie.
    """
    own = right is None
    other = left if own else right
    if own:
        top = left >> np.uint64(64 - depth)
        heads = np.flatnonzero(np.r_[np.ones(min(1, len(top)), bool), top[1:] != top[:-1]])
        ends = np.r_[heads[1:], len(left)]
        some = ends - heads > 1
        lo, hi = heads[some], ends[some]
        stack = [(depth, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    else:
        one = np.zeros(1, np.int64)
        used = int(np.bitwise_count((left[0] ^ other[0]) >> np.uint64(64 - depth))) if depth else 0
        stack = [(depth, one, one + len(left), one, one + len(other), np.full(1, used, np.int8))]
    while stack:
        at, a0, a1, b0, b1, used = stack.pop()
        if not len(a0):
            continue
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            stack += [(at, *(x[s] for x in (a0, a1, b0, b1, used))) for s in (np.s_[half:], np.s_[:half])]
            continue
        # Small node pairs are settled by their leaves.
        leaf = ((a1 - a0) * (b1 - b0) <= 8) | (at == 64)
        if leaf.any():
            p0, q0 = a0[leaf], b0[leaf]
            np_, nq = (a1 - a0)[leaf], (b1 - b0)[leaf]
            many = np_ * nq
            pair = np.repeat(np.arange(len(p0)), many)
            k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            i, j = p0[pair] + k // nq[pair], q0[pair] + k % nq[pair]
            near = np.bitwise_count(left[i] ^ other[j]) <= budget
            if own:
                near &= i < j
            if near.any():
                yield np.stack([i[near], j[near]])
            rest = ~leaf
            a0, a1, b0, b1, used = (x[rest] for x in (a0, a1, b0, b1, used))
            if not len(a0):
                continue
        shift = np.uint64(63 - at)

        def cut(values, lo, hi):
            """Where the next bit turns from 0 to 1 within each range."""
            one = ((values[lo] >> shift) | np.uint64(1)) << shift
            return np.clip(np.searchsorted(values, one), lo, hi)

        am, bm = cut(left, a0, a1), cut(other, b0, b1)
        same = (a0 == b0) if own else np.zeros(len(a0), bool)
        parts = []
        for x, (p0, p1) in enumerate(((a0, am), (am, a1))):
            for y, (q0, q1) in enumerate(((b0, bm), (bm, b1))):
                cost = used + np.int8(x != y)
                keep = (p1 > p0) & (q1 > q0) & (cost <= budget)
                if own:
                    keep &= ~(same & (x > y))  # a node with itself: each pair of children once
                    keep &= ~(same & (x == y) & (p1 - p0 < 2))
                parts.append([v[keep] for v in (p0, p1, q0, q1, cost)])
        stack.append((at + 1, *(np.concatenate(v) for v in zip(*parts, strict=True))))


def _spanning(size: int, pairs: Iterator[np.ndarray]) -> np.ndarray:
    """For nodes 0..size-1, the least node of each one's component."""
    label = np.arange(size)
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            # Labels are roots here, so hanging the larger one on the smaller loses no one's members.
            np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while not np.array_equal(up := label[label], label):
                label = up
    return label


def _links(batch: pa.Table, distance: int) -> pa.Table:
    """Spanning links of the groups in ``batch`` (block, turn, head, other, depth, value)."""
    rows = batch.to_pandas().drop_duplicates()
    us, vs = [], []

    def join(values: np.ndarray, pairs: Iterator[np.ndarray], turn: int) -> None:
        root = _spanning(len(values), pairs)
        moved = np.flatnonzero(root != np.arange(len(values)))
        back = rotate(values, -turn % 64)
        us.append(back[moved].view(np.int64))
        vs.append(back[root[moved]].view(np.int64))

    for (turn, depth), part in rows.groupby(["turn", "depth"]):
        values = np.sort(part.value.to_numpy(np.int64)[(part["head"] == part["other"]).to_numpy()].view(np.uint64))
        join(values, walk(values, None, depth, distance), turn)
        for (_, head, other), group in part[part["head"] != part["other"]].groupby(["block", "head", "other"]):
            value, mine = group["value"].to_numpy(np.int64).view(np.uint64), group["mine"].to_numpy()
            a, b = np.sort(value[mine == head]), np.sort(value[mine == other])
            if len(a) and len(b):
                offset = np.array([[0], [len(a)]])
                join(np.r_[a, b], (pair + offset for pair in walk(a, b, depth, distance)), turn)
    one = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
    return pa.table({"u": one(us), "v": one(vs)})


def fingerprint_links(values: DataFrame, distance: int = 2) -> DataFrame:
    """(u, v): links that join exactly the fingerprints within ``distance`` bits, by way of others too.

    ``values`` has one distinct fingerprint per row.  Links inside a group are its spanning trees, so a
    dense cluster gives no more links than it has fingerprints per block.
    """
    spans = [64 * k // (distance + 1) for k in range(distance + 2)]
    turns = [(start, end - start) for start, end in zip(spans, spans[1:], strict=False)]
    turned = None
    for start, width in turns:
        # Block to the top: Python's walk sees the rotated value.
        up = f"(shiftleft(value, {start}) | shiftrightunsigned(value, {64 - start}))" if start else "value"
        one = values.selectExpr(
            f"{up} AS value", f"{start} AS turn", f"shiftrightunsigned({up}, {64 - width}) AS block", f"{width} AS width"
        )
        turned = one if turned is None else turned.unionByName(one)
    sizes = turned.groupBy("turn", "block").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = sizes.withColumn("cut", F.least(F.lit(MAX_CUT), F.ceil(F.greatest(F.lit(0.0), F.log2(F.col("n") / GROUP)))).cast("int"))
    rows = turned.join(sizes, ["turn", "block"]).withColumn(
        "mine", F.expr("if(cut = 0, 0L, shiftrightunsigned(shiftleft(value, width), 64 - cut))")
    )
    # Heads of the subtries a fingerprint can have links to: up to ``distance`` of the cut bits differ.
    masks = [
        [sum(1 << b for b in bits) for k in range(min(distance, cut) + 1) for bits in combinations(range(cut), k)]
        for cut in range(MAX_CUT + 1)
    ]
    table = "array(" + ",".join("array(" + ",".join(f"{m}L" for m in row) + ")" for row in masks) + ")"
    rows = rows.withColumn("mask", F.explode(F.expr(f"element_at({table}, cut + 1)")))
    rows = rows.selectExpr(
        "turn", "block", "least(mine, mine ^ mask) AS head", "greatest(mine, mine ^ mask) AS other",
        "mine", "width + cut AS depth", "value",
    )
    keys = ["turn", "block", "head", "other"]
    grouped = rows.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = [table[k][-1].as_py() for k in keys]
            ends = np.ones(table.num_rows, bool)
            for k, v in zip(keys, last, strict=True):
                ends &= table[k].to_numpy() == v
            stop = int(np.flatnonzero(~ends)[-1]) + 1 if not ends.all() else 0
            if stop:
                yield from _links(table.slice(0, stop), distance).to_batches()
            held, count = table.slice(stop).to_batches(), table.num_rows - stop
        if held:
            yield from _links(pa.Table.from_batches(held), distance).to_batches()

    return grouped.mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, value, component_id, text_hash) for each row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that links reach; rows with equal fingerprints are linked,
    empty texts too.  A null id never is the smallest; a component of null ids alone has null.
    Repeated rows come back repeated.  An empty table gives an empty result.
    """
    return _components(docs, shingle, distance).drop("root")


def _components(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """``near_duplicates`` with the component's least fingerprint, ``root``."""
    marked = docs.select("doc_id", fingerprint_of("text", shingle).alias("value"), F.xxhash64("text").alias("text_hash"))
    marked = settle(marked, "fingerprints")
    classes = settle(marked.groupBy("value").agg(F.min("doc_id").alias("low")), "classes")
    roots = components(fingerprint_links(classes.select("value"), distance))
    linked = classes.join(roots.withColumnRenamed("node", "value"), "value", "left").select(
        "value", "low", F.coalesce("root", "value").alias("root")
    )
    least = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    named = linked.join(least, "root").select("value", "root", "component_id")
    return marked.join(named, "value").select("doc_id", "value", "component_id", "text_hash", "root")


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row of ``docs``, with all its columns, for each component: that of the smallest doc_id.

    Null ids come last; of rows with the same id that of the smaller text hash stays, of equal rows any.
    """
    found = _components(tables.texts(docs), shingle, distance)
    last = F.col("doc_id").isNull()
    winners = found.groupBy("root").agg(F.min(F.struct(last, "doc_id", "text_hash")).alias("w"))
    won, hashed = tables.free(docs, "_llm_id"), tables.free(docs, "_llm_hash")
    winners = settle(winners.select("root", F.col("w.doc_id").alias(won), F.col("w.text_hash").alias(hashed)), "winners")
    mine = (F.col("doc_id").cast("bigint").eqNullSafe(F.col(won))) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(hashed))
    kept = docs.join(tables.bounded(winners.select(won, hashed)), mine, "left_semi")
    # Equal rows share id and text; then the row itself has to be told apart.
    wins = found.join(winners, "root").filter(f"doc_id <=> {won} AND text_hash = {hashed}")
    repeated = wins.groupBy("root").count().filter("count > 1").limit(1).count()
    return _once(kept) if repeated else kept


def _once(rows: DataFrame) -> DataFrame:
    key = tables.free(rows, "_llm_hash")
    marked = rows.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    return marked.dropDuplicates(["doc_id", key]).drop(key)


def op7_simhash(spark, sf_dir):
    found = near_duplicates(tables.texts(tables.read(spark, sf_dir, "documents")))
    return found.select("doc_id", F.lower(F.lpad(F.hex("value"), 16, "0")).alias("fingerprint"), "component_id")
