"""Benchmark decontamination by q-gram lemma filtering.

Texts are compared in lower case with white space runs as one space.  A benchmark item is cut into
overlapping windows; a document leaks an item if it holds a region within ``ERRORS`` of a window's length
in edits.  A window of w characters with at most k edits keeps at least w - q + 1 - k q of its q-grams,
all on diagonals no further than k apart.  So shared q-grams are counted in overlapping bands of
diagonals, bands that reach that count are kept, and alignment within the band decides.

The benchmark is a stated set of queries: it is read in blocks of bounded size, each broadcast in turn,
against all documents.  Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from logweft.llm import tables
from logweft.sources.scratch import settle

Q = 12
WINDOW = 80
STRIDE = 20
ERRORS = 0.05
#: Benchmark characters of one block, which bounds what is broadcast at a time (about 100 bytes each).
BLOCK = 500_000
_BASE = 0x9E3779B97F4A7C15


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def qgrams(codes: np.ndarray) -> np.ndarray:
    """Hash of the ``Q`` code points from each position on."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    width, hashed, base = 1, codes.astype(np.uint64), _BASE
    powers = {1: (hashed, base)}
    while 2 * width <= Q:
        hashed = hashed[:-width] * np.uint64(base) + hashed[width:]
        width, base = 2 * width, base * base % (1 << 64)
        powers[width] = (hashed, base)
    done, out = 0, None
    for size in sorted(powers, reverse=True):
        if done + size <= Q:
            part, power = powers[size]
            part = part[done : len(codes) - Q + 1 + done]
            out = part if out is None else out * np.uint64(power) + part
            done += size
    return out ^ (out >> np.uint64(29))


def edits(window: str, region: str, most: int) -> tuple[int, int] | None:
    """Least edits of ``window`` against any part of ``region`` and where that part ends, if few enough.

    The band around the region's diagonals has as many columns as the region is longer than the window.
    """
    at = region.find(window)
    if at >= 0:
        return 0, at + len(window)
    slack = len(region) - len(window) + most
    if slack < 0:
        return None
    r = np.concatenate([_codes(region), np.zeros(len(window) + slack + 2, np.uint32)])
    offsets = np.arange(-most, slack + 1)
    # row[i] holds, per diagonal, the cost of the first i characters ending at that diagonal.
    row = np.where(offsets >= 0, 0, most + 1)
    for i, c in enumerate(_codes(window)):
        ends = offsets + i
        other = np.where(ends >= 0, r[np.maximum(ends, 0)] != c, True)
        new = row + other
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        new = np.where(ends + 1 >= 0, new, most + 1)
        new = np.minimum.accumulate(new - offsets) + offsets  # characters of the region left over
        row = new
    ends = offsets + len(window)
    row = np.where((ends >= 0) & (ends <= len(region)), row, most + 1)
    best = int(row.argmin())
    return (int(row[best]), int(ends[best])) if row[best] <= most else None


class Index:
    """Windows of a block of benchmark items and where their q-grams are."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.windows: list[tuple[int, str, int, int]] = []  # item, text, edits allowed, q-grams needed
        self.ids = [item for item, _ in items]
        hashes, owners, places = [], [], []
        for n, (_, text) in enumerate(items):
            starts = list(range(0, max(1, len(text) - WINDOW + 1), STRIDE))
            if len(text) > WINDOW and starts[-1] != len(text) - WINDOW:
                starts.append(len(text) - WINDOW)
            for start in starts:
                window = text[start : start + WINDOW]
                if len(window) < Q:
                    continue
                most = int(ERRORS * len(window))
                while most and len(window) - Q + 1 - most * Q < 1:
                    most -= 1
                grams = qgrams(_codes(window))
                hashes.append(grams)
                owners.append(np.full(len(grams), len(self.windows)))
                places.append(np.arange(len(grams)))
                self.windows.append((n, window, most, len(window) - Q + 1 - most * Q))
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        hashes = join(hashes, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner, self.place = hashes[order], join(owners, np.int32)[order], join(places, np.int32)[order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.hashes >> np.uint64(44)).astype(np.int64)] = True
        self.most = np.array([w[2] for w in self.windows], np.int64)
        self.need = np.array([w[3] for w in self.windows], np.int64)

    def regions(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Windows and band starts (diagonals) with as many shared q-grams as the lemma asks for."""
        grams = qgrams(_codes(text))
        at = np.flatnonzero(self.seen[(grams >> np.uint64(44)).astype(np.int64)])
        lo = np.searchsorted(self.hashes, grams[at], "left")
        many = np.searchsorted(self.hashes, grams[at], "right") - lo
        at, lo, many = at[many > 0], lo[many > 0], many[many > 0]
        total = int(many.sum())
        if not total:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        entry = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(total)
        owner, place = self.owner[entry].astype(np.int64), self.place[entry].astype(np.int64)
        diagonal = np.repeat(at, many) - place
        # Bands of 2 (k + 1) diagonals, each overlapping the next by half.
        step = self.most[owner] + 1
        band = np.floor_divide(diagonal, step)
        shift = np.int64(len(text) + WINDOW + 2)
        rows = np.concatenate([(owner * 2 * shift + shift + b) * WINDOW + place for b in (band, band - 1)])
        groups, counts = np.unique(np.unique(rows) // WINDOW, return_counts=True)  # q-grams of a window count once
        owner, band = np.divmod(groups, 2 * shift)
        good = counts >= self.need[owner]
        owner, band = owner[good], band[good] - shift
        return owner, band * (self.most[owner] + 1)

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, start, end, edits) of each item the normal ``text`` leaks, spans of all its windows."""
        owner, diagonal = self.regions(text)
        found: dict[int, list[int]] = {}
        settled = set()
        for w, d in zip(owner.tolist(), diagonal.tolist(), strict=True):
            item, window, most, _ = self.windows[w]
            start = max(0, d - most)
            end = min(len(text), d + 2 * (most + 1) + len(window) + most)
            hit = (w, start) not in settled and edits(window, text[start:end], most)
            settled.add((w, start))
            if hit:
                span = found.setdefault(item, [len(text), 0, most])
                span[0] = min(span[0], max(0, start + hit[1] - len(window)))
                span[1] = max(span[1], start + hit[1])
                span[2] = min(span[2], hit[0])
        return [(item, *span) for item, span in sorted(found.items())]


def blocks(benchmark: DataFrame, block: int = BLOCK) -> Iterator[list[tuple[int | None, str]]]:
    """The items of ``benchmark`` (item_id, text) in normal form, in lists of about ``block`` characters."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    held, size = [], 0
    for row in rows.toLocalIterator():
        held.append((row["item_id"], normal(row["text"])))
        size += len(held[-1][1])
        if size >= block:
            yield held
            held, size = [], 0
    if held:
        yield held


LEAK = "array<struct<item_id bigint, start int, end int, edits int>>"


def _marked(docs: DataFrame, items: list[tuple[int | None, str]], name: str) -> DataFrame:
    """All columns of ``docs`` with their leaks as column ``name``; narrow, one row each."""
    shared = docs.sparkSession.sparkContext.broadcast(Index(items))
    kind = StructType([*docs.schema.fields, StructField(name, _parse_datatype_string(LEAK))])
    entry = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in tables.slices(batches):
            found = []
            for text in batch.column("text").to_pylist():
                found.append([{"item_id": index.ids[n], "start": a, "end": b, "edits": e} for n, a, b, e in index.find(normal(text))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, entry)], [*batch.schema.names, name])

    return docs.mapInArrow(run, kind)


def leaks(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, start, end, edits): the benchmark items each row of ``docs`` (doc_id, text) leaks.

    ``start`` and ``end`` count characters of the normal form.  Items of fewer than ``Q`` characters are too
    short to be told from chance and are skipped, empty and null ones among them.  Repeated rows and
    items give repeated results; without leaks, documents or items the result is empty.
    """
    result = None
    for items in blocks(benchmark, block):
        rows = _marked(docs.select("doc_id", "text"), items, "leaks").select("doc_id", F.explode("leaks").alias("leak"))
        one = rows.select("doc_id", "leak.*")
        result = one if result is None else result.unionByName(one)
    if result is None:
        result = docs.limit(0).selectExpr("doc_id", "0L AS item_id", "0 AS start", "0 AS end", "0 AS edits")
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns."""
    columns, name = docs.columns, tables.free(docs, "_llm_leaks")
    for n, items in enumerate(blocks(benchmark, block)):
        docs = settle(docs, "docs") if n and n % 16 == 0 else docs
        docs = _marked(docs, items, name).filter(F.size(name) == 0).select(*columns)
    return docs


def op1_decontamination(spark, sf_dir):
    docs = tables.texts(tables.read(spark, sf_dir, "documents"))
    return leaks(docs, tables.read(spark, sf_dir, "benchmark"))
