"""Analyses of blocks.

Only the event sequences need a block's lines in order.  The others use forms that need no arrays and
shrink before they shuffle: a block's latency is the span of its times, and a component is in a block
if one of its lines is.  A block repeated in the label table counts once per row there, as it does in
the record table; the repeats enter as a weight, not as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweft.functions.arrays import array_to_string
from logweft.operators import blocks as ops
from logweft.operators.labels import label_counts
from logweft.operators.skew import BlockProfile, StoredLines, parts_of
from logweft.sources.scratch import settle


def label_summary(parsed: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: normal, anomalous and total labelled blocks, with percentages."""
    seen = parsed.select("BlockId").distinct()
    totals = seen.join(label_counts(labels), "BlockId").agg(
        F.coalesce(F.sum("normal"), F.lit(0)).alias("normal"),
        F.coalesce(F.sum("anomaly"), F.lit(0)).alias("anomaly"),
    )
    total = F.col("normal") + F.col("anomaly")
    return totals.select(
        "normal",
        "anomaly",
        total.alias("total"),
        (F.try_divide("normal", total) * 100).alias("normal_pct"),
        (F.try_divide("anomaly", total) * 100).alias("anomaly_pct"),
    )


def _fingerprint(*parts: Column | str) -> list[Column]:
    """Two 60-bit sums over a cryptographic hash: equal bags of parts give equal sums."""
    digest = F.sha2(F.concat_ws("\n", *parts), 256)

    def piece(start: int) -> Column:
        return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)")

    return [piece(1), piece(16)]


def _sequence_parts(
    parsed: DataFrame, labels: DataFrame, profile: BlockProfile | None, segment_lines: int
) -> DataFrame:
    """(BlockId, part, copies, event_sequence, sequence_id) of the anomalous blocks."""
    needed = parsed.select(*ops.order_columns(parsed), "EventId")

    def copies(rows: DataFrame) -> DataFrame:
        counts = label_counts(rows).filter("anomaly > 0")
        return counts.select("BlockId", F.col("anomaly").alias("copies"))

    def finish(ordered: DataFrame, hot: BlockProfile | None) -> DataFrame:
        events = F.sort_array(F.collect_list(F.struct("seq_num", "EventId")))
        parts = (
            ordered.withColumn("part", ops.segment_of(segment_lines))
            .groupBy("BlockId", "part", "copies")
            .agg(events.alias("lines"))
            .withColumn("event_sequence", array_to_string(F.col("lines.EventId")))
            .drop("lines")
        )
        h1, h2 = _fingerprint(F.col("part").cast("string"), F.col("event_sequence"))
        parts = parts.withColumns({"h1": h1, "h2": h2})
        sums = {"n": F.count("*"), "h1": F.sum("h1"), "h2": F.sum("h2")}
        if hot:
            totals = parts.groupBy("BlockId").agg(*[v.alias(k) for k, v in sums.items()])
            parts = parts.drop("h1", "h2").join(F.broadcast(totals), "BlockId")  # hot ids only
        else:
            block = Window.partitionBy("BlockId")
            parts = parts.withColumns({k: v.over(block) for k, v in sums.items()})
        return parts.withColumn("sequence_id", F.concat_ws("-", "n", "h1", "h2"))

    # The label filter comes first, so only anomalous blocks are ordered.
    def prepare(rows: DataFrame, hot: BlockProfile | None) -> DataFrame:
        known = hot.only_hot(copies, labels) if hot else copies(labels)
        return rows.join(known, "BlockId")

    return ops.by_route(needed, profile, finish, prepare)


def _counted(parts: DataFrame) -> DataFrame:
    """A row for each sequence and part.  Only ids are keys; equal ids have equal texts, and one travels."""
    return parts.groupBy("sequence_id", "part").agg(
        F.first("event_sequence").alias("event_sequence"), F.sum("copies").alias("count")
    )


def anomaly_sequences(
    parsed: DataFrame,
    labels: DataFrame,
    profile: BlockProfile | None = None,
    segment_lines: int = ops.SEGMENT_LINES,
) -> DataFrame:
    """(sequence_id, part, event_sequence, count): how often each sequence occurs in anomalous blocks.

    A sequence has a row per part of ``segment_lines`` events, all with its ``sequence_id`` and with the
    count of the whole sequence.  The id depends on the sequence and the part length alone.
    """
    counts = _counted(_sequence_parts(parsed, labels, profile, segment_lines))
    return counts.orderBy(F.desc("count"), "sequence_id", "part")


def top_sequences(
    parsed: DataFrame,
    labels: DataFrame,
    k: int = 5,
    profile: BlockProfile | None = None,
    segment_lines: int = ops.SEGMENT_LINES,
) -> DataFrame:
    """All parts of the ``k`` most frequent sequences; ties go by ``sequence_id``.

    Ids are counted first, and the texts of the winners alone are looked up after that.
    """
    parts = settle(_sequence_parts(parsed, labels, profile, segment_lines), "sequences")
    counts = parts.filter("part = 0").groupBy("sequence_id").agg(F.sum("copies").alias("count"))
    first = counts.orderBy(F.desc("count"), "sequence_id").limit(k).select("sequence_id")
    winners = parts.join(F.broadcast(first), "sequence_id", "left_semi")  # k rows
    return _counted(winners).orderBy(F.desc("count"), "sequence_id", "part")


def component_pairs(parsed: DataFrame) -> DataFrame:
    """(BlockId, component, n, pair_start, pair_end): lines, first and last time of a component in a block.

    The tables of components take this in place of lines, so that one settled copy serves them all.
    """
    return parsed.groupBy("BlockId", "component").agg(
        F.count("*").alias("n"), F.min("timestamp").alias("pair_start"), F.max("timestamp").alias("pair_end")
    )


def _pairs(rows: DataFrame) -> DataFrame:
    return rows if "pair_start" in rows.columns else component_pairs(rows)


def component_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Lines per component in anomalous and in normal blocks, from lines or ``component_pairs``."""
    return (
        _pairs(rows)
        .join(label_counts(labels), "BlockId")
        .groupBy("component")
        .agg(
            F.sum(F.col("n") * F.col("anomaly")).alias("anomaly"),
            F.sum(F.col("n") * F.col("normal")).alias("normal"),
        )
        .filter("anomaly + normal > 0")
    )


def component_by_label(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``component_labels`` with a row per type and component, and the share within each type."""
    counts = component_labels(rows, labels)
    long = counts.unpivot("component", ["anomaly", "normal"], "type", "count").filter("count > 0")
    totals = long.groupBy("type").agg(F.sum("count").alias("total"))  # two rows
    return long.join(F.broadcast(totals), "type").select(
        "type", "component", "count", (F.col("count") / F.col("total") * 100).alias("percentage")
    )


def component_anomaly_ratio(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Per component, the share of its labelled lines that are in anomalous blocks."""
    ratio = F.col("anomaly") / (F.col("anomaly") + F.col("normal"))
    counts = component_labels(rows, labels)
    return counts.withColumn("anomaly_ratio", ratio).orderBy(F.desc("anomaly_ratio"), "component")


#: Bits of a latency that tell the values of one coarse bin apart: two hundred years of seconds are at
#: most 100,000 bins of at most 65,536 values.
BIN_BITS = 16


def _ranked(histogram: DataFrame, ranks: list[int]) -> DataFrame:
    """One row with the value at each rank (from 0) of ``histogram`` (latency, n), as ``r0``, ``r1``, ...

    Coarse bins are counted first; only the bins that hold a rank are then looked into.
    """
    binned = histogram.withColumn("bin", F.shiftright("latency", BIN_BITS))
    sizes = binned.groupBy("bin").agg(F.sum("n").alias("size"))
    upto = F.sum("size").over(Window.orderBy("bin"))
    placed = sizes.select("bin", (upto - F.col("size")).alias("before"), upto.alias("upto"))
    holds = F.lit(False)
    for rank in ranks:
        holds = holds | ((F.col("before") <= rank) & (F.col("upto") > rank))
    wanted = placed.filter(holds).select("bin", "before")  # a bin for each rank at most
    fine = Window.partitionBy("bin").orderBy("latency")
    found = binned.join(F.broadcast(wanted), "bin").select(
        "latency", (F.col("before") + F.sum("n").over(fine)).alias("upto")
    )
    return found.agg(
        *[F.min(F.when(F.col("upto") > r, F.col("latency"))).alias(f"r{i}") for i, r in enumerate(ranks)]
    )


def latency_stats(parsed: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Minimum, maximum, mean, and interpolated exact 50th and 95th percentile of block latency.

    Blocks fold into a histogram of whole-second latencies, written once; the percentiles come from the
    values at the ranks next to them.  A log without blocks gives a row of NULLs.
    """
    latency = ops.block_latency(parsed, labels)
    copies = F.lit(1) if labels is None else F.col("copies")
    histogram = settle(latency.groupBy("latency").agg(F.sum(copies).alias("n")), "histogram")
    mean = F.sum(F.col("latency") * F.col("n")) / F.sum("n")
    total, low, high, mean = histogram.agg(F.sum("n"), F.min("latency"), F.max("latency"), mean).first()
    # Ranks as whole hundredths: no rounding at any count.
    places = [divmod(percent * ((total or 1) - 1), 100) for percent in (50, 95)]
    values = _ranked(histogram, [rank for at, rest in places for rank in (at, at + (rest > 0))])

    def between(i: int) -> Column:
        low, share = F.col(f"r{2 * i}"), places[i][1] / 100
        return low + (F.col(f"r{2 * i + 1}") - low) * share

    return values.select(
        F.lit(low).cast("bigint").alias("min_latency"),
        F.lit(high).cast("bigint").alias("max_latency"),
        F.lit(mean).cast("double").alias("avg_latency"),
        between(0).alias("median_latency"),
        between(1).alias("p95_latency"),
    )


def _average_latency(rows: DataFrame) -> DataFrame:
    """Average latency by component of rows (component, latency, copies), slowest first."""
    weighted = F.sum(F.col("latency") * F.col("copies")) / F.sum("copies")
    return rows.groupBy("component").agg(weighted.alias("avg_latency")).orderBy(F.desc("avg_latency"), "component")


def component_latency(rows: DataFrame | StoredLines, labels: DataFrame | None = None) -> DataFrame:
    """Average latency of the blocks that contain each component, slowest first.

    ``rows`` are lines, stored lines or ``component_pairs``.
    """
    found = None
    for part in parts_of(rows):
        one = _component_blocks(part, labels)
        found = one if found is None else found.unionByName(one)
    return _average_latency(found)


def _component_blocks(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(component, copies, latency, ...) for each block that a component is in."""
    # ``n`` would make the two uses of the pairs differ.
    pairs = _pairs(rows).select("BlockId", "component", "pair_start", "pair_end")
    spans = pairs.groupBy("BlockId").agg(
        F.min("pair_start").alias("block_start"), F.max("pair_end").alias("block_end")
    )
    if labels is None:
        spans = spans.withColumn("copies", F.lit(1))
    else:
        spans = spans.join(ops.label_copies(labels), "BlockId", "left")
    # The block's span covers the pair's.  Reading both keeps the two uses of ``pairs`` equal, so that
    # its shuffle is written once and the log scanned once.
    found = pairs.join(spans, "BlockId").select(
        "component",
        F.coalesce("copies", F.lit(1)).alias("copies"),
        F.greatest("block_end", "pair_end").alias("block_end"),
        F.least("block_start", "pair_start").alias("block_start"),
    )
    return found.withColumn("latency", ops.span_latency())


#: Components that one bigint holds a bit for, and bigints a block may have.
WORD_BITS, WORDS = 63, 16


def component_latency_by_bits(
    parsed: DataFrame, components: DataFrame, labels: DataFrame | None = None
) -> DataFrame:
    """``component_latency`` by way of one row for each block, with a bit for each component in it.

    ``components`` is a settled table of their names (``lines.distinct_components``).  It is numbered, and
    lines are folded to the block's span and its bits before they are shuffled: as many rows as
    blocks travel, where pairs of block and component would be several times as many.  Tables of more
    than ``WORDS * WORD_BITS`` names are left to ``component_latency``.
    """
    number = (F.row_number().over(Window.orderBy("component")) - 1).alias("number")
    size = components.limit(WORDS * WORD_BITS + 1).count()
    if size > WORDS * WORD_BITS:
        return component_latency(parsed, labels)
    names = components.select("component", number)
    words = range(-(-size // WORD_BITS))

    def bits(word: int) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("number") % WORD_BITS)
        own = F.when(F.floor(F.col("number") / WORD_BITS) == word, bit).otherwise(F.lit(0).cast("bigint"))
        return F.bit_or(own).alias(f"word{word}")

    numbered = parsed.select("BlockId", "timestamp", "component").join(F.broadcast(names), "component")
    ends = [F.min("timestamp").alias("block_start"), F.max("timestamp").alias("block_end")]
    blocks = numbered.groupBy("BlockId").agg(*ends, *map(bits, words))
    if labels is not None:
        blocks = blocks.join(ops.label_copies(labels), "BlockId", "left")
    copies = F.lit(1) if labels is None else F.coalesce("copies", F.lit(1))
    each = [
        F.expr(f"filter(sequence({w * WORD_BITS}, {min(size, (w + 1) * WORD_BITS) - 1}), i -> getbit(word{w}, i - {w * WORD_BITS}) = 1)")
        for w in words
    ]
    held = blocks.select(
        ops.span_latency().alias("latency"),
        copies.alias("copies"),
        F.explode(F.concat(*each) if each else F.array().cast("array<int>")).alias("number"),
    )
    # Summed by number, so that names meet one row for each component.
    sums = held.groupBy("number").agg(
        F.sum(F.col("latency") * F.col("copies")).alias("total"), F.sum("copies").alias("weight")
    )
    named = sums.join(F.broadcast(names), "number")
    return named.select("component", (F.col("total") / F.col("weight")).alias("avg_latency")).orderBy(
        F.desc("avg_latency"), "component"
    )


def blocks_with_component(parsed: DataFrame, component: str) -> DataFrame:
    """Latency of the blocks in which a component takes part."""
    blocks = parsed.groupBy("BlockId").agg(
        F.min("timestamp").alias("block_start"),
        F.max("timestamp").alias("block_end"),
        F.bool_or(F.col("component") == component).alias("present"),
    )
    return blocks.filter("present").select("BlockId", ops.span_latency().alias("latency"))
