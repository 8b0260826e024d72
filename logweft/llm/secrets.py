"""Secret scan: candidates by shape, false positives removed by a random forest.

A candidate is a run of at least ``SHORTEST`` key characters with a digit in it, or whatever is assigned to
a credential's name, of any length and characters: up to the quote that closes it on its line, or up to
white space.  It is described by its length and alphabet, the transitions between kinds of character, how much of it dictionary words cover,
the path it was found under and the words beside it.  The dictionary is the most frequent words of all
documents.  The forest learns from labelled findings: a value of ``LEAST_NAMED`` characters and more after a
credential's name and an assignment is a true finding; a number, an address, or a value that words explain
is a false one; the rest is not labelled.  Each labelled finding is shown twice, as it stands and with all
that is around it hidden, so that the forest has to tell by the value what the rule tells by the name.
``quality`` measures this on findings it was not fitted on.  Labels are made from all documents, and the
forest is fitted on about ``TRAIN_ROWS`` of them, chosen by a hash of where they stand.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweft.llm import tables
from logweft.sources.scratch import settle

SHORTEST = 16
#: Words of the dictionary.
DICTIONARY = 20_000
#: Labelled findings the forest is fitted on.
TRAIN_ROWS = 100_000
#: Shorter values are labelled by no name: ``auth: on``.
LEAST_NAMED = 6
#: Findings are held out from the forest that ``quality`` measures by a hash of their values.
FOLDS, HELD_OUT = 4, 0
#: Steps in which frequencies double, for the histogram that the dictionary is cut by.
STEPS = 64
TREES, DEPTH, SEED = 30, 6, 11
#: Cells that paths and that neighbouring words are hashed into.
PATHS, NEIGHBOURS = 4, 8
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_\-.]{{{SHORTEST},}}={{0,2}}")
NUMBER = re.compile(r"[\d+\-./_]+={0,2}")
ADDRESS = re.compile(r"(?:[\w\-]+\.)+[A-Za-z]{2,6}|(?:\d{1,3}\.){3}\d{1,3}[\w.\-]*")
#: Not "author" or "secretary".
NAME = r"(?:token|secret(?!ar)|password|passwd|api[_-]?key|access[_-]?key|auth(?!or(?!i))|credential)\w{0,40}[\"']?\s{0,20}(?:=>|:=|=|:)\s{0,20}"
NAMED = re.compile(NAME + r"[\"']?$", re.IGNORECASE)
GIVEN = re.compile(NAME + r"""(?:"([^"\n]+)"|'([^'\n]+)'|["']?([^\s"']+))""", re.IGNORECASE)
ASSIGNED = re.compile(r"[=:]\s*[\"']?$")
WORD = re.compile(r"[^\W\d_]+")
FEATURES = 15 + PATHS + NEIGHBOURS


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> frozenset[str]:
    """The most frequent words of four letters and more in all texts; ``size`` words reach the driver.

    What is assigned to a credential's name does not count, or a secret would be made of words.
    """
    plain = F.lower(F.regexp_replace("text", f"(?i){GIVEN.pattern}", " "))
    words = docs.select(F.explode(F.split(plain, r"[^\p{L}]+")).alias("word")).filter(F.length("word") >= 4)
    counts = settle(words.groupBy("word").agg(F.count("*").alias("n")), "words")
    # What is far too rare goes before anything is sorted: a task would send its own ``size`` words.
    step = F.floor(F.log2("n") * STEPS)
    left, least = size, 0
    for row in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect():
        left, least = left - row["words"], row["step"]
        if left <= 0:
            break
    return frozenset(r["word"] for r in counts.filter(step >= least).orderBy(F.desc("n"), "word").limit(size).collect())


def covered(value: str, words: frozenset[str]) -> float:
    """The share of a value's characters that lie in dictionary words, longest first from the left."""
    text, at, inside = value.lower(), 0, 0
    while at < len(text) - 3:
        step = next((k for k in range(min(14, len(text) - at), 3, -1) if text[at : at + k] in words), 0)
        inside += step
        at += step or 1
    return inside / len(text)


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def features(value: str, before: str, after: str, path: str, words: frozenset[str]) -> list[float]:
    kinds = [_kind(c) for c in value]
    share = Counter(kinds)
    n = len(value)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    moves = Counter(zip(kinds, kinds[1:], strict=False))
    changes = sum(k for (a, b), k in moves.items() if a != b) / max(1, n - 1)
    out = [
        math.log(n), *(share[k] / n for k in range(4)), entropy, changes,
        (moves[0, 1] + moves[1, 0]) / max(1, n - 1), (moves[1, 2] + moves[2, 1]) / max(1, n - 1),
        float(bool(re.fullmatch(r"[0-9a-fA-F]+", value))), covered(value, words),
        float(bool(ASSIGNED.search(before))), float(before[-1:] in "\"'" and before != ""), float(after[:1] in "\"'" and after != ""),
        float(value.count(".")),
    ]
    places = [0.0] * PATHS
    places[crc32(path.encode()) % PATHS] = 1.0
    near = [0.0] * NEIGHBOURS
    for word in WORD.findall(before)[-2:] + WORD.findall(after)[:1]:
        near[crc32(word.lower().encode()) % NEIGHBOURS] += 1.0
    return [*out, *places, *near]


def label(value: str, before: str, words: frozenset[str]) -> int | None:
    """1 for a true finding, 0 for a false one, None where no rule tells."""
    if NAMED.search(before) and covered(value, words) < 0.5:
        return 1 if len(value) >= LEAST_NAMED else None
    if NUMBER.fullmatch(value) or ADDRESS.fullmatch(value) or covered(value, words) >= 0.5:
        return 0
    return None


def candidates(text: str) -> list[tuple[int, int]]:
    """Start and end of each candidate in order; one by its shape that meets one by a name is the latter."""
    named = [hit.span(hit.lastindex) for hit in GIVEN.finditer(text)]
    found, k = list(named), 0
    for hit in CANDIDATE.finditer(text):
        start, end = hit.span()
        while k < len(named) and named[k][1] <= start:
            k += 1
        if (k == len(named) or named[k][0] >= end) and any(c.isdigit() for c in hit.group()):
            found.append((start, end))
    return sorted(found)


def findings(docs: DataFrame, words: frozenset[str]) -> DataFrame:
    """(doc_id, start, size, label, value_hash, features, bare) of each candidate in ``docs`` (doc_id, text, path).

    ``bare`` are the features of a labelled value with all that is around it hidden.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.slices(batches):
            rows = []
            for doc, text, path in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "path")), strict=True):
                for start, end in candidates(text or ""):
                    value, before, after = text[start:end], text[max(0, start - 60) : start], text[end : end + 30]
                    kind = label(value, before, words)
                    bare = None if kind is None else features(value, "", "", "", words)
                    rows.append((doc, start, end - start, kind, crc32(value.encode("utf-8", "surrogatepass")), features(value, before, after, path or "", words), bare))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, schema.types, strict=True)], schema=schema)

    numbers = pa.list_(pa.float64())
    kinds = {"doc_id": pa.int64(), "start": pa.int64(), "size": pa.int32(), "label": pa.int32(), "value_hash": pa.int64(), "features": numbers, "bare": numbers}
    schema = pa.schema(list(kinds.items()))
    names = "doc_id bigint, start bigint, size int, label int, value_hash bigint, features array<double>, bare array<double>"
    return docs.select("doc_id", "text", "path").mapInArrow(run, names)


def _fitted(known: DataFrame):
    """A forest fitted on about ``TRAIN_ROWS`` labelled findings, or None if they are all of one kind."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    total, ones = known.agg(F.count("*"), F.sum("label")).first()
    if not ones or ones == total:
        return None
    place = F.pmod(F.xxhash64("doc_id", "start"), F.lit(1 << 30))
    kept = known.filter(place < min(1.0, TRAIN_ROWS / total) * (1 << 30))
    rows = settle(kept.select("label", F.explode(F.array("features", "bare")).alias("features")), "sample")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    # The copy has no training summary, which holds the session and with it, once any query of the session
    # has been observed, what cannot be sent to tasks.
    return forest.fit(rows.select("label", array_to_vector("features").alias("features"))).copy()


def _told(found: DataFrame, forest, features: str = "features") -> DataFrame:
    """``found`` with the forest's ``probability`` for its column ``features``."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    names = [c for c in found.columns if c not in ("features", "bare")]
    told = forest.transform(found.select(*names, array_to_vector(features).alias("features")))
    return told.select(*names, vector_to_array("probability")[1].alias("probability"))


def secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, start, size, probability, secret) of each candidate in ``docs`` (doc_id, text, path).

    ``start`` counts characters; ``secret`` is 1 from a probability of a half on.  Null texts and paths
    count as empty; repeated rows give repeated findings, and findings alike in all that describes them tie.
    An empty table gives none.  A text of any length is searched from its start to its end.  If labels of one
    kind are missing, the labelled findings decide by themselves and others have a probability of 0.5.
    """
    found = settle(findings(docs, dictionary(docs)), "findings")
    forest = _fitted(found.filter("label IS NOT NULL"))
    if forest is None:
        told = found.withColumn("probability", F.coalesce(F.col("label").cast("double"), F.lit(0.5)))
    else:
        told = _told(found, forest)
    return told.select("doc_id", "start", "size", "probability", (F.col("probability") >= 0.5).cast("int").alias("secret"))


def quality(docs: DataFrame) -> DataFrame | None:
    """(context, precision, recall, findings) of a forest on labelled findings whose values it was not fitted on.

    Once with their names, quotes, neighbours and path (``shown``) and once without (``hidden``), where the rule that
    labels true findings has nothing to go by.  None if the forest has only one kind to learn from.
    """
    found = settle(findings(docs, dictionary(docs)).filter("label IS NOT NULL"), "findings")
    held = F.col("value_hash") % FOLDS == HELD_OUT
    forest = _fitted(found.filter(~held))
    if forest is None:
        return None
    rows = [_told(found.filter(held), forest, c).withColumn("context", F.lit(n)) for c, n in (("features", "shown"), ("bare", "hidden"))]
    said, true = F.col("probability") >= 0.5, F.col("label") == 1
    both = F.count_if(said & true)
    return rows[0].unionByName(rows[1]).groupBy("context").agg(
        (both / F.nullif(F.count_if(said), F.lit(0))).alias("precision"), (both / F.nullif(F.count_if(true), F.lit(0))).alias("recall"), F.count("*").alias("findings")
    )


def op9_secret_forest(spark, sf_dir):
    docs = tables.read(spark, sf_dir, "documents")
    path = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("path")
    return secrets(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), path))
