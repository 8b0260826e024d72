"""Fuzzy line dedup by MinHash, with DataFrame operations only.

A line is known by 128 bits of hash, so equal lines are one wherever lines meet; of the texts only those of
distinct lines, and then of lines that share a band, move.
The signature of a line is taken over its character shingles, cut out of its UTF-32 form.  A shingle's hash falls
into one of ``BANDS`` bins; of each bin the least hash under two orders is kept (an order is the hash
combined with a constant by exclusive or, under which each member of a random set is the least with equal
chance).  The values of two neighbouring bins are a band, four in all.  Lines with a band in common meet the
least of them, and pairs of at least the wanted Jaccard similarity over their whole shingle sets are
links; where the least does not reach all of a band, its lines that are not joined yet are compared, in large
bands in pairs of blocks, so every similar pair with a band in common is joined.  Distributed union-find then
gives the components, and the first line of each is kept.

Two lines are first compared by their sketches, bits that their shingles' hashes set: each bit that one has
and the other has not is a shingle of one alone, so too many of them rule a pair out.  What they do not rule
out is decided by the shingle sets themselves.

A line of fewer characters than a shingle has itself as only shingle.  Lines of white space alone are
never duplicates.

``signed``, ``signatures``, ``similar``, ``joined`` and ``_block_links`` are numpy forms of the same steps.  No
query runs them; tests compare the DataFrame forms with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.llm import tables
from logweft.llm.components import components
from logweft.llm.simhash import _spanning
from logweft.sources.scratch import settle

SHINGLE = 8
SIMILARITY = 0.8
BANDS = 12
#: Lines of a bucket that are all compared with each other as pairs of rows; larger ones go in blocks.
SMALL = 16
#: Lines, and characters, of a block on average.
BLOCK, BLOCK_CHARS = 512, 1 << 20
#: Shingles counted in common at a time.
COLUMNS = 4096
#: Shingles of one row while shingles are folded.
AT_ONCE = 4
#: Words of 64 bits, a power of two, in the sketch of a line; with twice as many a join's condition is not compiled.
WORDS = 16
#: Lines of a band's main root that its other lines are compared with before they meet all.
PIVOTS = 16
#: Constants that give a hash further orders.
ORDERS = (0x1B873593CC9E2D51, 0x52DCE729DA3ED5A3)
_SECOND = 0x5BD1E995
#: Fixed value: an odd factor that spreads bits.
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(2**64 - 1)


def split(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, line, h1, h2) of each line with more than white space; h1, h2 identify its text."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return rows.filter(F.col("line").rlike(r"\S")).select(
        "doc_id", "text_hash", "line_no", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(_SECOND), "line").alias("h2")
    )


def _folded(lines: DataFrame, *columns: Column) -> DataFrame:
    """(h1, h2, ``columns``): aggregates over the shingles of each distinct line of ``lines`` (h1, h2, line).

    ``columns`` see ``last``, the place of the last shingle from 0, and ``AT_ONCE`` hashes of shingles of a row,
    ``g0``, ``g1`` and so on; at the end of a line some come twice.  Shingles exist only within the stage that
    cuts them, as ``lines`` is dealt by h1 and h2 before.
    """
    rows = lines.select("h1", "h2", F.encode("line", "UTF-32").alias("wide"))
    rows = rows.select("h1", "h2", "wide", F.expr(f"cast(greatest(0, octet_length(wide) div 4 - {SHINGLE}) AS int)").alias("last"))
    rows = rows.select("h1", "h2", "wide", "last", F.expr(f"explode(sequence(0, last, {AT_ONCE}))").alias("i"))
    cut = [F.expr(f"xxhash64(substring(wide, 4 * least(i + {k}, last) + 1, {4 * SHINGLE}))").alias(f"g{k}") for k in range(AT_ONCE)]
    return rows.select("h1", "h2", "last", *cut).groupBy("h1", "h2").agg(*columns)


def banded(lines: DataFrame) -> DataFrame:
    """(h1, h2, bands): the bands of each distinct line of ``lines`` (h1, h2, line), without those of two empty bins."""
    none, hashes = F.lit(2**63 - 1), [F.col(f"g{k}") for k in range(AT_ONCE)]
    bins = [F.shiftrightunsigned(h, 40) * BANDS for h in hashes]
    bins = [F.shiftright(b, 24) for b in bins]

    def least(bin_: int, order: int) -> Column:
        return F.min(F.least(*(F.when(b == bin_, h.bitwiseXOR(F.lit(order))).otherwise(none) for b, h in zip(bins, hashes, strict=True))))

    distinct = lines.groupBy("h1", "h2").agg(F.first("line").alias("line"))
    rows = _folded(distinct, *(least(k, order).alias(f"m{k}_{j}") for k in range(BANDS) for j, order in enumerate(ORDERS)))
    keys = []
    for k in range(BANDS):
        values = [F.col(f"m{b}_{j}") for b in (k, (k + 1) % BANDS) for j in range(len(ORDERS))]
        keys.append(F.when(F.least(*values) < none, F.xxhash64(F.lit(k), *values)))
    return rows.select("h1", "h2", F.array_compact(F.array(*keys)).alias("bands"))


def _sketched(lines: DataFrame, words: int) -> DataFrame:
    """(h1, h2, n, s0, s1, ...): places of shingles and sketch of each of the distinct ``lines`` (h1, h2, line)."""
    each = []
    for word in range(words):
        bits = [f"IF((g{k} & {words - 1}) = {word}, shiftleft(1L, cast(shiftrightunsigned(g{k}, 58) AS int)), 0L)" for k in range(AT_ONCE)]
        each.append(F.expr(f"bit_or({' | '.join(bits)})").alias(f"s{word}"))
    return _folded(lines.repartition("h1", "h2"), (F.max("last") + 1).alias("n"), *each)


def _near(one: str, other: str, words: int, similarity: float) -> Column:
    """Whether the sketches of two lines, columns that begin with ``one`` and ``other``, let them be similar.

    Sets of that similarity differ in at most (1 - similarity) / (1 + similarity) of the sum of their sizes.
    """
    apart = F.expr(" + ".join(f"bit_count({one}s{k} ^ {other}s{k})" for k in range(words)))
    return apart <= (F.col(f"{one}n") + F.col(f"{other}n")) * ((1 - similarity) / (1 + similarity) + 1e-9)


def _sets(line: str) -> Column:
    """The hashed shingles of the line whose UTF-32 form is column ``line``, each once.

    The form is a variable of a function here, as a column of bytes is copied wherever it is read.
    """
    last = f"cast(greatest(0, octet_length(w) div 4 - {SHINGLE}) AS int)"
    cut = f"transform(sequence(0, {last}), i -> xxhash64(substring(w, 4 * i + 1, {4 * SHINGLE})))"
    return F.expr(f"transform(array({line}), w -> array_distinct({cut}))[0]")


def _alike(pairs: DataFrame, near: Column | None, similarity: float, *kept: str) -> DataFrame:
    """(``kept``, alike): whether the shingle sets of a_line and b_line are similar; not, where not ``near``."""
    wide = [F.encode(f"{n}_line", "UTF-32").alias(f"{n}_wide") for n in "ab"]
    rows = pairs.select(*kept, *(wide if near is None else (F.when(near, w).alias(f"{n}_wide") for n, w in zip("ab", wide, strict=True))))
    rows = rows.select(*kept, *(F.when(F.col(f"{n}_wide").isNotNull(), _sets(f"{n}_wide")).alias(f"{n}_set") for n in "ab"))
    rows = rows.select(*kept, F.size("a_set").alias("a_n"), F.size("b_set").alias("b_n"), F.size(F.array_intersect("a_set", "b_set")).alias("both"))
    return rows.select(*kept, F.coalesce(F.expr(f"both >= {similarity!r}D * (a_n + b_n - both) AND a_n >= 0"), F.lit(False)).alias("alike"))


def _hashed(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Place of its line and hash of each shingle of ``lines``, in order."""
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    padded = "".join(line if len(line) >= SHINGLE else line.ljust(SHINGLE, "\0") for line in lines)
    codes = np.frombuffer(padded.encode("utf-32-le"), np.uint32)
    rolled = np.zeros(max(0, len(codes) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        rolled = (rolled + codes[k : k + len(rolled)] + np.uint64(1)) * _FACTOR
    many = np.maximum(1, sizes - SHINGLE + 1)
    starts = np.cumsum(np.maximum(sizes, SHINGLE)) - np.maximum(sizes, SHINGLE)
    owner = np.repeat(np.arange(len(lines)), many)
    at = np.repeat(starts - (np.cumsum(many) - many), many) + np.arange(len(owner))
    found = rolled[at]
    short = np.flatnonzero(sizes < SHINGLE)  # a line that is its own shingle is none with NULs at its end
    if len(short):
        where = np.cumsum(many)[short] - 1
        found[where] += sizes[short].astype(np.uint64) + np.uint64(1)
    return owner, _mixed(found)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _FACTOR
    values = (values ^ (values >> np.uint64(29))) * _FACTOR
    return values ^ (values >> np.uint64(32))


def _chunks(*columns: list[str], rows: int = 256, size: int = 1 << 16) -> Iterator[slice]:
    """Slices of up to ``rows`` rows that, unless one row has more, have up to ``size`` characters."""
    start = held = 0
    for k, row in enumerate(zip(*columns, strict=True)):
        own = sum(map(len, row))
        if k > start and (held + own > size or k - start == rows):
            yield slice(start, k)
            start, held = k, 0
        held += own
    if columns[0]:
        yield slice(start, len(columns[0]))


def signatures(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of lines and bands they are in: ``BANDS`` for a line, without those of two empty bins."""
    owner, h = _hashed(lines)
    cell = owner * BANDS + (h % np.uint64(BANDS)).astype(np.int64)
    least = np.full((len(ORDERS), len(lines) * BANDS), _EMPTY)
    for row, order in zip(least, ORDERS, strict=True):
        np.minimum.at(row, cell, h ^ np.uint64(order))
    least = least.reshape(len(ORDERS), len(lines), BANDS)
    band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(lines), BANDS))
    some = np.zeros((len(lines), BANDS), bool)
    for shift in (0, 1):
        for values in np.roll(least, -shift, axis=2):
            band = _mixed(band + values * _FACTOR)
            some |= values != _EMPTY
    place, _ = np.nonzero(some)
    return place, band[some].view(np.int64)


def similar(left: list[str], right: list[str], similarity: float) -> np.ndarray:
    """Whether the shingle sets of each of up to 256 pairs have at least that Jaccard similarity.

    A shingle is known by 56 bits of its hash beside the 8 of its pair.
    """

    def sets(lines: list[str]) -> np.ndarray:
        owner, h = _hashed(lines)
        keys = np.sort((owner.astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8)))
        return keys[np.r_[True, keys[1:] != keys[:-1]]]

    def counted(keys: np.ndarray) -> np.ndarray:
        return np.bincount((keys >> np.uint64(56)).astype(np.int64), minlength=len(left))

    one, other = sets(left), sets(right)
    both = np.sort(np.concatenate([one, other]))  # each at most twice
    common = counted(both[1:][both[1:] == both[:-1]])
    return common >= similarity * (counted(one) + counted(other) - common)


def joined(left: list[str], right: list[str] | None, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that join exactly the similar lines of ``left`` with those of ``right``, or with each other.

    Places count through ``left`` and on through ``right``.  Links are spanning trees, not all pairs.
    """
    lines, n = [*left, *(right or [])], len(left)
    owner, h = _hashed(lines)
    names, code = np.unique(h, return_inverse=True)
    both = np.unique(code * np.int64(len(lines)) + owner)
    code, owner = both // len(lines), both % len(lines)
    sizes = np.bincount(owner, minlength=len(lines)).astype(float)
    many = np.bincount(code, minlength=len(names)) > 1  # the others are in one line only
    place = np.cumsum(many) - 1
    owner, code = owner[many[code]], place[code[many[code]]]
    first = np.s_[:n]
    second = first if right is None else np.s_[n:]
    common = np.zeros((n, n if right is None else len(lines) - n), np.float32)
    for start in range(0, int(many.sum()), COLUMNS):
        some = slice(*np.searchsorted(code, [start, start + COLUMNS]))
        has = np.zeros((len(lines), COLUMNS), np.float32)
        has[owner[some], code[some] - start] = 1
        common += has[first] @ has[second].T
    alike = common >= similarity * (sizes[first][:, None] + sizes[second][None, :] - common)
    i, j = np.nonzero(np.triu(alike, 1) if right is None else alike)
    root = _spanning(len(lines), [(i, j if right is None else j + n)])
    moved = np.flatnonzero(root != np.arange(len(lines)))
    return moved, root[moved]


def signed(lines: DataFrame) -> DataFrame:
    """``lines`` (with h1 and line) with the bands of each line, an array, in place of its text.

    Of equal lines in a slice of a batch the first has them and the others NULL.
    """
    names = [c for c in lines.columns if c != "line"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.slices(batches, 4096):
            at = np.sort(np.unique(batch.column("h1").to_numpy(), return_index=True)[1])
            line, found = batch.column("line").take(pa.array(at)).to_pylist(), []
            for some in _chunks(line, rows=4096):
                place, band = signatures(line[some])
                many = np.bincount(place, minlength=some.stop - some.start)
                found.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(many)], pa.int32()), pa.array(band)))
            if found:
                back = np.full(batch.num_rows, -1)
                back[at] = np.arange(len(at))
                own = pa.concat_arrays(found).take(pa.array(back, mask=back < 0))
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), own], [*names, "bands"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema if f.name != "line")
    return lines.mapInArrow(run, schema + ", bands array<bigint>")


def _stars(members: DataFrame, key: str) -> DataFrame:
    """(key, u, v): each line u of a bucket of ``members`` (key, h1) with the least one, v."""
    low = members.groupBy(key).agg(F.min("h1").alias("v"))
    return members.join(low, key).filter("h1 <> v").select(key, F.col("h1").alias("u"), "v")


def _ends(lines: DataFrame, *columns: str) -> list[DataFrame]:
    """``lines`` (h1, h2, ``columns``) for the two ends of a pair: identity a or b, its columns as a_ or b_."""
    return [lines.select(F.struct("h1", "h2").alias(n), *(F.col(c).alias(f"{n}_{c}") for c in columns)) for n in "ab"]


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(u, v, a, b) of the similar ones among pairs (u, v) of h1; a and b are the line identities.

    ``texts`` have their sketches (h1, h2, line, n, s0, s1, ...).  Pairs meet by these; texts move only for
    pairs that they do not rule out.
    """
    one, other = _ends(texts, "n", *(f"s{k}" for k in range(WORDS)))
    met = pairs.join(one.withColumn("u", F.col("a.h1")), "u").join(other.withColumn("v", F.col("b.h1")), "v")
    near = settle(met.filter(_near("a_", "b_", WORDS, similarity)).select("u", "v", "a", "b"), "near")
    left, right = _ends(texts, "line")
    return _alike(near.join(left, "a").join(right, "b"), None, similarity, "u", "v", "a", "b").filter("alike").drop("alike")


def _rooted(members: DataFrame, roots: DataFrame, *keys: str) -> DataFrame:
    """``members`` (``keys``, id) with the root of each line; a line without one in ``roots`` is its own."""
    return members.join(roots.withColumnRenamed("node", "id"), "id", "left").select(*keys, "id", F.coalesce("root", "id").alias("root"))


def _parted(members: DataFrame) -> DataFrame:
    """``members`` (band, id, root) of bands of several roots, with ``main``, the root of most of a band's lines."""
    parts = members.groupBy("band", "root").agg(F.count("*").alias("n")).groupBy("band")
    parts = parts.agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n")).filter("n > most.n")
    return members.join(parts.select("band", F.col("most.root").alias("main")), "band")


def _order(k: int) -> int:
    """A constant that gives 64-bit hashes their order ``k``, by exclusive or; the first bits differ from order to order."""
    return (k * int(_FACTOR) + 2**63) % 2**64 - 2**63


def _leading(members: DataFrame) -> DataFrame:
    """(band, pivots): up to ``PIVOTS`` lines of each band's main root, as h1, the same ones in bands with the same lines."""
    main = members.filter("root = main").select("band", F.col("id.h1").alias("h1"))
    orders = [F.lit(_order(k)) for k in range(PIVOTS)]
    least = main.groupBy("band").agg(*(F.min(F.col("h1").bitwiseXOR(order)).alias(f"m{k}") for k, order in enumerate(orders)))
    return least.select("band", F.array_distinct(F.array(*(F.col(f"m{k}").bitwiseXOR(order) for k, order in enumerate(orders)))).alias("pivots"))


def _apart(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, pivot, n, apart, s0, s1, ...): size of a line's shingle set, shingles that either it or its pivot has, their sketch.

    ``pairs`` are (id, pivot), a pivot being an h1.
    """
    line, other = _ends(texts, "line")
    rows = pairs.join(line.withColumnRenamed("a", "id"), "id").join(other.withColumn("pivot", F.col("b.h1")), "pivot")
    rows = rows.select("id", "pivot", *(F.encode(f"{n}_line", "UTF-32").alias(f"{n}_wide") for n in "ab"))
    rows = rows.select("id", "pivot", *(_sets(f"{n}_wide").alias(f"{n}_set") for n in "ab"))
    apart = F.concat(F.array_except("a_set", "b_set"), F.array_except("b_set", "a_set"))
    rows = rows.select("id", "pivot", F.size("a_set").alias("n"), apart.alias("apart"))
    bit = "(bits, g) -> bits | shiftleft(1L, cast(shiftrightunsigned(g, 58) AS int))"
    each = (F.expr(f"aggregate(filter(apart, g -> (g & {WORDS - 1}) = {k}), 0L, {bit})").alias(f"s{k}") for k in range(WORDS))
    return rows.select("id", "pivot", "n", "apart", *each)


def _similar(one: str, other: str, similarity: float) -> Column:
    """Whether two lines are, by their shingles apart from the same pivot.

    A shingle that both have apart from it is one that both have, or both have not; so the lines differ by
    the others.  These are a variable of a function, or they would be counted wherever they are read.
    """
    differ = f"size({one}apart) + size({other}apart) - 2 * size(array_intersect({one}apart, {other}apart))"
    both = f"({one}n + {other}n - d) div 2"
    return F.expr(f"exists(array({differ}), d -> {both} >= {similarity!r}D * ({one}n + {other}n - {both}))")


def _band_links(members: DataFrame, texts: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """(u, v): roots of the similar lines, of ``texts`` with sketches, of each band of ``members`` (band, h1).

    Lines that are joined already, by ``roots`` (node, root), need not meet.  Most of a band's lines have one
    root, its main one.  The others are compared with some of these lines first, which leaves few outside; each of
    those meets all lines of other roots, a band's lines outside and its lines in all being dealt into
    blocks, and each two blocks meet on their own.  Shingle sets travel as what sets them apart from
    one line of the band, its pivot, with a sketch of that, and are compared where lines meet, so only similar
    pairs come out.
    """
    ids = members.join(texts.select("h1", F.struct("h1", "h2").alias("id")), "h1").select("band", "id")
    parted = settle(_parted(_rooted(ids, roots, "band")), "parted")
    leading = settle(_leading(parted), "leading")
    pivots = leading.select("band", F.col("pivots")[0].alias("pivot"))
    known = parted.join(pivots, "band")
    apart = settle(_apart(known.select("id", "pivot").distinct(), texts), "apart")
    sides = ["root", "n", "apart", *(f"s{k}" for k in range(WORDS))]

    def end(rows: DataFrame, name: str, *where: str) -> DataFrame:
        return rows.select(*where, F.col("id").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in sides))

    def links(met: DataFrame) -> DataFrame:
        return settle(met.select(F.col("a_root").alias("u"), F.col("b_root").alias("v")).distinct(), "met")

    alike = _near("a_", "b_", WORDS, similarity) & _similar("a_", "b_", similarity)
    some = leading.select("band", F.explode("pivots").alias("h1"))
    some = known.withColumn("h1", F.col("id.h1")).join(some, ["band", "h1"]).drop("h1")
    some, whole = some.join(apart, ["id", "pivot"]), known.join(apart, ["id", "pivot"])
    first = links(end(whole.filter("root <> main"), "a", "band").join(end(some, "b", "band"), "band").filter(alike))

    # Of what is left, each line outside meets all lines of other roots.
    again = components(first).withColumnRenamed("node", "old").withColumnRenamed("root", "new")
    left = parted.select("band", "id", F.col("root").alias("old")).join(tables.bounded(again, tables.BROADCAST_ROWS // 4), "old", "left")
    left = settle(_parted(left.select("band", "id", F.coalesce("new", "old").alias("root"))), "left")
    blocks = left.groupBy("band").agg(
        F.ceil(F.sum(F.expr("IF(root <> main, 1, 0)")) / BLOCK).cast("int").alias("outer"), F.ceil(F.count("*") / BLOCK).cast("int").alias("all")
    )
    dealt = left.join(pivots, "band").join(blocks, "band").join(apart, ["id", "pivot"])
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = dealt.filter("root <> main").withColumn("low", block("outer")).withColumn("high", each("all"))
    other = dealt.withColumn("high", block("all")).withColumn("low", each("outer")).withColumn("last", F.col("root") == F.col("main"))
    where = ["band", "low", "high"]
    # Rows may come dealt by band, which would leave a band's pairs of blocks in one task.
    one, other = end(one.repartition(*where), "a", *where), end(other.repartition(*where), "b", *where, "last")
    rest = one.join(other, where).filter(F.expr("a_root <> b_root AND (last OR a < b)")).filter(alike)
    return first.unionByName(links(rest))


def _block_links(members: DataFrame, similarity: float) -> DataFrame:
    """(u, v): identities of lines that join all similar ones of each band of ``members`` (band, h1, h2, line).

    A band's lines are dealt into blocks, and each two blocks are a group of their own.
    """
    sizes = members.groupBy("band").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.length("line")) / BLOCK_CHARS)).cast("int").alias("blocks"))
    dealt = members.join(sizes, "band").withColumn("mine", F.pmod(F.xxhash64("h1", "h2"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("band", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "h1", "h2", "line")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("mine", kind="stable")
        cut = int((rows["mine"] == rows["low"]).sum())
        line, own = rows["line"].tolist(), rows["low"].iloc[0] == rows["high"].iloc[0]
        u, v = joined(line[:cut], None if own else line[cut:], similarity)
        h1, h2 = rows["h1"].to_numpy(), rows["h2"].to_numpy()
        return pd.DataFrame({"a1": h1[u], "a2": h2[u], "b1": h1[v], "b2": h2[v]})

    # Rows come dealt by band, which would satisfy the grouping and leave a band's pairs of blocks in one task.
    dealt = dealt.repartition("band", "low", "high")
    found = dealt.groupBy("band", "low", "high").applyInPandas(run, "a1 bigint, a2 bigint, b1 bigint, b2 bigint")
    ids = [F.struct(F.col(f"{n}1").alias("h1"), F.col(f"{n}2").alias("h2")).alias(end) for n, end in (("a", "u"), ("b", "v"))]
    return found.distinct().select(*ids)


def line_links(lines: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(u, v): identities, structs of h1 and h2, of distinct lines among ``lines`` (h1, h2, line).

    They join the similar ones with a band in common, by way of others too.
    """
    lines = lines.select("h1", "h2", "line")
    known = settle(banded(lines), "signed")
    banded_lines = known.select("h1", F.explode("bands").alias("band"))
    met = banded_lines.groupBy("band").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
    shared = settle(met.filter("low < high").select("band"), "shared")
    members = settle(banded_lines.join(tables.bounded(shared), "band").distinct(), "members")
    wanted = settle(members.select("h1").distinct(), "wanted")
    texts = settle(lines.join(tables.bounded(wanted), "h1").groupBy("h1", "h2").agg(F.first("line").alias("line")), "texts")
    texts = settle(texts.join(_sketched(texts, WORDS), ["h1", "h2"]), "sketched")
    stars = settle(_stars(members, "band"), "stars")
    first = settle(_verified(stars.select("u", "v").distinct(), texts, similarity), "verified")
    links = first.select(F.col("a").alias("u"), F.col("b").alias("v"))
    # Buckets whose least line does not reach all the others.
    failed = stars.join(first.select("u", "v"), ["u", "v"], "left_anti")
    torn = settle(members.join(failed.select("band").distinct(), "band"), "torn")
    if torn.limit(1).count():
        roots = components(links)
        links = roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
        # Small ones give all their pairs of lines that are not joined yet, fewer than ``SMALL`` for each line.
        sizes = settle(torn.groupBy("band").agg(F.count("*").alias("n")), "sizes")
        torn = torn.join(tables.bounded(sizes), "band")
        few = torn.filter(f"n <= {SMALL}").join(texts.select("h1", F.struct("h1", "h2").alias("id")), "h1")
        few = _rooted(few, roots, "band", "h1").select("band", "h1", "root")
        one, other = few.select("band", F.col("h1").alias("v"), F.col("root").alias("to")), few.select("band", F.col("h1").alias("u"), "root")
        more = one.join(other, "band").filter("v < u AND root <> to").select("u", "v")
        new = more.distinct().join(stars.select("u", "v").distinct(), ["u", "v"], "left_anti")
        found = _verified(new, texts, similarity)
        links = links.unionByName(found.select(F.col("a").alias("u"), F.col("b").alias("v")))
        large = torn.filter(f"n > {SMALL}").select("band", "h1")
        if large.limit(1).count():
            links = links.unionByName(_band_links(large, texts, roots, similarity))
    return links


def line_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, line_no, kept_doc_id, kept_line_no) for each line of ``docs`` (doc_id, text) to be dropped.

    ``line_no`` counts from 0.  The kept line of a component is its first by doc_id, nulls first, and
    line number.  Rows with the same doc_id and different texts are documents of their own, in the order
    of their text hashes; in repeated rows with the same text a line is kept in each or dropped in each.
    A table without repeated lines gives an empty result.
    """
    return _copies(docs, similarity).drop("text_hash")


def _copies(docs: DataFrame, similarity: float) -> DataFrame:
    """``line_copies`` with the hash of the row's text, ``text_hash``."""
    lines = split(docs)
    found = settle(lines.select("doc_id", "text_hash", "line_no", F.struct("h1", "h2").alias("id")), "places")
    roots = components(line_links(lines, similarity))
    place = F.struct("doc_id", "line_no", "text_hash")
    first = found.groupBy("id").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    joined = first.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    kept = joined.groupBy("root").agg(F.min("first").alias("kept"), F.sum("n").alias("total"))
    classes = joined.select("id", "root").join(kept.filter("total > 1"), "root").select("id", "kept")
    return (
        found.join(classes, "id")
        .filter("NOT (doc_id <=> kept.doc_id AND line_no = kept.line_no AND text_hash = kept.text_hash)")
        .select("doc_id", "text_hash", "line_no", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.line_no").alias("kept_line_no"))
    )


def without_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with its repeated lines gone; a document with no other text left goes too.

    All columns stay.  Documents in which nothing repeats come back as they are, empty ones included.
    """
    key, text_hash, dropped = (tables.free(docs, name) for name in ("_llm_key", "_llm_hash", "_llm_gone"))
    gone = _copies(tables.texts(docs), similarity)
    gone = gone.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(key), F.col("text_hash").alias(text_hash), "line_no")
    gone = gone.groupBy(key, text_hash).agg(F.collect_set("line_no").alias(dropped))
    marked = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit("")))
    marked = marked.withColumn(text_hash, F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = marked.join(gone, [key, text_hash], "left")
    kept = F.expr(f"array_join(filter(split(text, '\n'), (x, i) -> NOT array_contains({dropped}, i)), '\n')")
    edited = joined.withColumn("text", F.when(F.col(dropped).isNull(), F.col("text")).otherwise(kept))
    left = edited.filter(F.col(dropped).isNull() | F.col("text").rlike(r"\S"))
    return left.select(*docs.columns)


def op10_line_dedup(spark, sf_dir):
    return line_copies(tables.texts(tables.read(spark, sf_dir, "documents")))
