"""LM scoring by context-tree weighting over bytes.

A byte is eight binary decisions; a decision has a context tree over the ``DEPTH`` bytes before it.  Each
node of the tree holds how often the decision went either way in training and estimates it by
Krichevsky and Trofimov; context-tree weighting mixes the estimates of all depths, half of a node's
weight for its own estimate and half for the product of its children's.  The weights come bottom-up, one
aggregation per depth; the mixture's prediction comes top-down as an affine map of the deepest
estimate, one join per depth.  The result is a code length for every sequence of ``DEPTH`` + 1 bytes.

Words, which only the baseline needs, are entries of the same tables under a negative code, 63 bits of
their hash: among a billion words the chance of any collision is about one in twenty.

All tables are distributed.  Texts are read in blocks of ``BLOCK_ROWS`` rows of a file, and of ``BLOCK_BYTES``
at most where these hold more, but for a longer text, which is a block.  A block's distinct sequences and words are counted first; their values come back to the block by joins, and the block's
texts are scored against this dictionary of their own.  So nothing that grows with the corpus is
broadcast, and the large shuffles carry distinct entries of blocks, not positions.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.llm import tables
from logweft.sources.scratch import settle

FOLDS, HELD_OUT = 7, 2
DEPTH = 5
#: A byte that no UTF-8 text has: before a text and, as a symbol to be predicted, after it.
EDGE = 0xFF
#: Stands for the end token among words, which have no white space.
END = b" "
BLOCK_ROWS = 1 << 13
BLOCK_BYTES = 1 << 26
#: Bytes whose sequences are counted or looked up at a time.
PIECE = 1 << 22


def sequences(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Codes of ``DEPTH`` + 1 bytes ending at each byte of each text and at its end, piece by piece."""
    pad = bytes([EDGE]) * DEPTH
    held, size = [], 0

    def codes() -> np.ndarray:
        data = np.frombuffer(b"".join(held), np.uint8).astype(np.int64)
        out = np.zeros(len(data) - DEPTH, np.int64)
        for k in range(DEPTH + 1):
            out = (out << 8) | data[k : len(data) - DEPTH + k]
        keep = np.ones(len(out), bool)
        starts = np.cumsum([len(h) for h in held])[:-1]
        for k in range(DEPTH):  # those that would end in the padding of the next text
            keep[starts + k - DEPTH] = False
        return out[keep]

    for text in texts:
        for at in range(0, max(1, len(text)), PIECE):
            head = pad if not at else text[at - DEPTH : at]
            tail = bytes([EDGE]) if at + PIECE >= len(text) else b""
            held.append(head + text[at : at + PIECE] + tail)
            size += len(held[-1])
            if size >= PIECE:
                yield codes()
                held, size = [], 0
    if held:
        yield codes()


def _folded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def word_codes(words: list[bytes]) -> np.ndarray:
    """A negative code for each word."""
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return -1 - (hashed >> np.uint64(1)).astype(np.int64)


def counted(held: list[bool], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of the words and sequences of some texts, and how often training texts have them."""
    words: Counter = Counter()
    known: set[bytes] = {END}
    values, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for kind in (False, True):
        mine = [_folded(t) for h, t in zip(held, texts, strict=True) if h == kind]
        for text in mine:
            (known if kind else words).update(text.split())
        if not kind:
            words[END] += len(mine)
        for codes in sequences(mine):
            value, many = np.unique(codes, return_counts=True)
            values.append(value)
            times.append(many * (not kind))
    value, many = np.concatenate(values), np.concatenate(times)
    order = np.argsort(value, kind="stable")
    value, many = value[order], many[order]
    first = np.flatnonzero(np.r_[np.ones(min(1, len(value)), bool), value[1:] != value[:-1]])
    code, n = value[first], np.add.reduceat(many, first) if len(first) else many
    more = list(known - words.keys())
    spelled = word_codes([*words, *more])
    return np.concatenate([code, spelled]), np.concatenate([n, np.fromiter(words.values(), np.int64, len(words)), np.zeros(len(more), np.int64)])


class Lookup:
    """Values by code: an open table with the codes' products by a constant as places."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(codes) * 3).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits)
        at, left = self._place(codes), np.arange(len(codes))
        while len(left):
            free = self.keys[at] == -1
            self.keys[at[free]] = codes[left[free]]
            done = self.keys[at] == codes[left]
            self.values[at[done]] = values[left[done]]
            at, left = (at[~done] + 1) & (len(self.keys) - 1), left[~done]

    def _place(self, codes: np.ndarray) -> np.ndarray:
        mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def total(self, codes: np.ndarray) -> float:
        """Sum of the values of ``codes``, all of which are there."""
        at, out = self._place(codes), 0.0
        while True:
            hit = self.keys[at] == codes
            if hit.all():
                return out + float(self.values[at].sum())
            out += float(self.values[at[hit]].sum())
            at, codes = (at[~hit] + 1) & (len(self.keys) - 1), codes[~hit]


def blocked(docs: DataFrame) -> DataFrame:
    """(block, doc_id, text, held) of a table read from files, which fixes the blocks, or written to some.

    Where the rows of a block hold too many bytes, texts are dealt by size: of texts of up to twice as many bytes,
    half as many rows of the file make a block.  There is at most one such block to each ``BLOCK_BYTES`` of text.
    """
    try:
        placed = docs.select("*", "_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        placed = settle(docs, "docs").select("*", "_metadata.file_path", "_metadata.row_index")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    rows = F.xxhash64("file_path", F.expr(f"row_index div {BLOCK_ROWS}"))
    heavy = placed.groupBy(rows.alias("rows")).agg(F.sum(size).alias("bytes")).filter(F.col("bytes") > BLOCK_BYTES)
    heavy = tables.bounded(settle(heavy.select("rows", F.lit(True).alias("heavy")), "heavy"))
    halved = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(size, F.lit(1)) * (BLOCK_ROWS / BLOCK_BYTES)))).cast("int")
    placed = placed.withColumns({"rows": rows, "halved": halved}).join(heavy, "rows", "left")
    by_size = F.xxhash64("file_path", "halved", F.expr(f"row_index div greatest(1, shiftright({BLOCK_ROWS}, halved))"))
    return placed.select(
        F.when(F.col("heavy"), by_size).otherwise(F.col("rows")).alias("block"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        (tables.fold("doc_id", FOLDS) == HELD_OUT).alias("held"),
    )


def block_counts(docs: DataFrame) -> DataFrame:
    """(block, code, n): the entries of a block, or of each part of it that comes in one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, held, text = (batch.column(c).to_pylist() for c in ("block", "held", "text"))
            for name in dict.fromkeys(block):
                mine = [k for k, b in enumerate(block) if b == name]
                code, n = counted([held[k] for k in mine], [text[k] for k in mine])
                for at in range(0, len(code), 1 << 17):
                    some = slice(at, at + (1 << 17))
                    named = pa.array(np.full(len(code[some]), name))
                    yield pa.RecordBatch.from_arrays([named, pa.array(code[some]), pa.array(n[some])], ["block", "code", "n"])

    return docs.select("block", "text", "held").mapInArrow(run, "block bigint, code bigint, n bigint")


def _log_kt(zeros: str, ones: str) -> Column:
    """Natural log of the Krichevsky-Trofimov probability of that many zeros and ones.

    By Stirling's series for the gamma function at n + 1/2 and n + 1, exact to about 1e-12 from 8 on; below
    that the recurrence is carried up.
    """

    def lgamma(x: Column) -> Column:
        big = x + 8
        lift = F.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7))
        series = 1 / (12 * big) - 1 / (360 * big * big * big) + 1 / (1260 * big * big * big * big * big)
        return (big - 0.5) * F.log(big) - big + 0.5 * math.log(2 * math.pi) + series - lift

    a, b = F.col(zeros).cast("double"), F.col(ones).cast("double")
    return lgamma(a + 0.5) + lgamma(b + 0.5) - math.log(math.pi) - lgamma(a + b + 1)


def code_lengths(counts: DataFrame) -> DataFrame:
    """(code, log10_p) of the distinct sequences of ``counts`` (code, n), n being training counts, also 0."""
    bits = "explode(transform(sequence(0, 7), i -> struct(cast(shiftleft(1, i) | shiftright(code & 255, 8 - i) as int) AS node, cast(shiftright(code, 7 - i) & 1 as int) AS bit)))"
    grams = counts.select("code", "n", F.expr("shiftright(code, 8) AS context"))
    # Dealt by context, so that the eight decisions of a code stay where it is.
    decided = grams.repartition("context").select("n", "context", F.expr(bits).alias("d")).select("n", "context", "d.*")
    leaf = decided.groupBy("context", "node").agg(
        F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("zeros"), F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("ones")
    )
    own = _log_kt("zeros", "ones")
    levels = {DEPTH: settle(leaf.withColumn("weighted", own), "level")}
    for depth in range(DEPTH - 1, -1, -1):
        # Codes are big-endian, the nearest byte last: a shorter context is the low bytes.
        mask = (1 << (8 * depth)) - 1
        up = levels[depth + 1].groupBy(F.col("context").bitwiseAND(F.lit(mask).cast("bigint")).alias("context"), "node").agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below")
        )
        up = up.withColumn("own", own)
        more = F.greatest("own", "below") + F.log1p(F.exp(-F.abs(F.col("own") - F.col("below")))) - math.log(2)
        beta = F.exp(F.least(F.lit(600.0), F.greatest(F.lit(-600.0), F.col("own") - F.col("below"))))
        levels[depth] = settle(up.select("context", "node", "zeros", "ones", more.alias("weighted"), beta.alias("beta")), "level")
    ones = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    # p(root) = add + scale * p(depth): from the root down.
    above = None
    for depth in range(DEPTH + 1):
        level = levels[depth].withColumn("kt", ones)
        if above is None:
            level = level.withColumns({"add": F.lit(0.0), "scale": F.lit(1.0)})
        else:
            mask = (1 << (8 * (depth - 1))) - 1
            keyed = level.withColumn("shorter", F.col("context").bitwiseAND(F.lit(mask).cast("bigint")))
            level = keyed.join(above, ["shorter", "node"])
        if depth == DEPTH:
            break
        above = level.select(
            F.col("context").alias("shorter"),
            "node",
            (F.col("add") + F.col("scale") * F.col("beta") * F.col("kt") / (F.col("beta") + 1)).alias("add"),
            (F.col("scale") / (F.col("beta") + 1)).alias("scale"),
        )
        if depth < 2:
            above = F.broadcast(above)  # 255 decisions in at most 256 contexts
    one = F.col("add") + F.col("scale") * F.col("kt")
    tree = level.groupBy("context").agg(F.map_from_entries(F.collect_list(F.struct("node", one.alias("one")))).alias("tree"))  # 255 decisions at most
    asked = grams.select("code", "context").join(tree, "context").select("context", "code", "tree", F.expr(bits).alias("d"))
    p = F.element_at("tree", F.col("d.node"))
    p = F.when(F.col("d.bit") == 1, p).otherwise(1 - p)
    # Kept in single precision: half of the bytes that go back to every block.
    log10_p = F.sum(F.log10(p)).cast("float").cast("double")
    return asked.groupBy("context", "code").agg(log10_p.alias("log10_p")).select("code", "log10_p")


def lm_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of (doc_id, text).

    ``score`` is the log10 probability of the folded text's bytes and its end; code length per byte is
    -score * log2(10) / bytes.  ``base_score`` is that of its words and end under smoothed word counts.  An
    empty or null text has the end alone.  Rows with null ids are training rows; repeated rows count
    again and come back again.  Without training rows estimates are even; an empty table gives none.  Texts
    may be of any length; a task holds one of them, or a block, and its distinct sequences.
    """
    placed = blocked(docs.select("doc_id", "text"))
    entries = settle(block_counts(placed), "entries")
    grams = entries.filter("code >= 0").groupBy("code").agg(F.sum("n").alias("n"))
    lengths = code_lengths(settle(grams, "grams"))
    words = settle(entries.filter("code < 0").groupBy("code").agg(F.sum("n").alias("c")), "words")
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    values = settle(lengths.withColumnRenamed("log10_p", "value").unionByName(words.select("code", F.col("c").cast("double").alias("value"))), "values")
    known = entries.select("block", "code").join(values, "code").select("block", "code", "value")
    smooth = math.log10(total + distinct + 1)

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        code, value = known["code"].to_numpy(), known["value"].to_numpy()
        table = Lookup(code[code >= 0], value[code >= 0])
        order = np.argsort(code[code < 0])
        named, times = code[code < 0][order], value[code < 0][order]
        count: dict[bytes, int] = {}
        log: dict[bytes, float] = {}
        columns = [[] for _ in range(5)]
        for text in texts["text"].to_pylist():
            data = _folded(text)
            tokens = [*data.split(), END]
            if fresh := [w for w in set(tokens) if w not in count]:
                c = times[np.searchsorted(named, word_codes(fresh))]
                count.update(zip(fresh, c.tolist(), strict=True))
                log.update(zip(fresh, np.log10(c + 1).tolist(), strict=True))
            base = math.fsum(map(log.__getitem__, tokens)) - len(tokens) * smooth
            seen = len(tokens) - list(map(count.__getitem__, tokens)).count(0)
            found = (len(tokens), seen, total, base, math.fsum(table.total(c) for c in sequences([data])))
            for column, one in zip(columns, found, strict=True):
                column.append(one)
        kinds = [pa.int64()] * 3 + [pa.float64()] * 2
        names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
        arrays = [texts["doc_id"], texts["held"], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
        return pa.table(dict(zip(["doc_id", "held_out", *names], arrays, strict=True)))

    kinds = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return placed.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(score, kinds)


def op3_context_tree(spark, sf_dir):
    return lm_scores(tables.read(spark, sf_dir, "documents"))
