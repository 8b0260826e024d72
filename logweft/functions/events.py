"""Message templates and the event each line belongs to.

A template becomes a set of marker words; a line belongs to the first template, in file order, whose
markers all occur in it as substrings.  Matching is narrow: no line is shuffled for it.  Few templates are a
chain of compiled conditions; many are an index, which costs about as much for ten thousand as for a hundred.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"
# Templates of one chain of conditions.
CHAIN_TEMPLATES = 100


def with_markers(templates: DataFrame) -> DataFrame:
    """Add ``markers``: the word runs of a template between its ``[*]`` wildcards."""
    text = F.replace("EventTemplate", F.lit("[*]"), F.lit("\n"))
    words = F.regexp_extract_all(text, F.lit(r"[\w.:]+"), F.lit(0))
    # The bare word BLOCK stands for the literal BLOCK* that the messages carry.
    return templates.withColumn(
        "markers", F.transform(words, lambda w: F.when(w == "BLOCK", "BLOCK*").otherwise(w))
    )


def collect_markers(templates: DataFrame) -> list[tuple[str, list[str]]]:
    """(EventId, markers) in match order.  A repeated id keeps its first place and last words.

    Rows without an id or without a template are no templates.
    """
    rows = (
        with_markers(templates.filter("trim(EventId) <> '' AND EventTemplate IS NOT NULL"))
        .groupBy("EventId")
        .agg(F.min("priority").alias("first"), F.max_by("markers", "priority").alias("markers"))
        .collect()
    )
    return [(r["EventId"], r["markers"]) for r in sorted(rows, key=lambda r: r["first"])]


def event_by_chain(
    markers: list[tuple[str, list[str]]], line: Column | str = "value", width: int = CHAIN_TEMPLATES
) -> Column:
    """The event of a line: chains of at most ``width`` compiled conditions, tried until one matches."""
    text = F.col(line) if isinstance(line, str) else line
    chains = []
    for start in range(0, len(markers), width):
        chain = None
        for event_id, words in markers[start : start + width]:
            # A template without words matches every line.
            match = F.lit(True)
            for word in words:
                match = match & text.contains(word)
            chain = F.when(match, event_id) if chain is None else chain.when(match, event_id)
        chains.append(chain)
    return F.coalesce(*chains, F.lit(UNKNOWN))


def event_by_index(markers: list[tuple[str, list[str]]], line: Column | str = "value") -> Column:
    """The event of a line, at a cost that does not grow with the number of templates.

    An automaton over all marker words finds those of a line in one pass.  A template is listed under
    the word that the fewest templates have, so only templates whose rarest word is in the line are
    looked at, in match order, and each is then checked for all its words.  The plan is one call
    whatever the table; the table itself goes along with the tasks.
    """

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        uses = Counter(word for _, words in markers for word in set(words))
        listed: dict[str, list[tuple[int, frozenset[str]]]] = {}
        first = len(markers)  # the first template without words matches every line
        for place, (_, words) in enumerate(markers):
            if words:
                rarest = min(words, key=lambda w: (uses[w], -len(w), w))
                listed.setdefault(rarest, []).append((place, frozenset(words)))
            else:
                first = min(first, place)
        events = [event for event, _ in markers] + [UNKNOWN]
        automaton = ahocorasick.Automaton()
        for word in uses:
            automaton.add_word(word, word)
        automaton.make_automaton()

        def match(text: str | None) -> str:
            found = {word for _, word in automaton.iter(text)} if text and uses else ()
            best = first
            for word in found:
                for place, words in listed.get(word, ()):
                    if place >= best:
                        break
                    if words <= found:
                        best = place
                        break
            return events[best]

        for batch in batches:
            yield pd.Series([match(text) for text in batch], dtype=object)

    return run(line)


def classify_by_index(lines: DataFrame, markers: list[tuple[str, list[str]]]) -> DataFrame:
    """``classify`` for thousands of templates."""
    return lines.withColumn("EventId", event_by_index(markers))


def classify(
    lines: DataFrame, markers: list[tuple[str, list[str]]], width: int = CHAIN_TEMPLATES
) -> DataFrame:
    """Add ``EventId`` to each line: up to ``width`` templates as one chain, more by the index."""
    if len(markers) > width:
        return classify_by_index(lines, markers)
    return lines.withColumn("EventId", event_by_chain(markers, width=width))
