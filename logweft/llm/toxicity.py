"""Toxicity by a weighted finite-state pattern grammar.

A text is read as symbols: insults, threats, targets, negations, reporting verbs, quotes, clause ends and
other words.  Three transducers read them in turn: one marks insults and threats under negation, one
those in reported or quoted speech, one matches them with a target in the same clause, before or after.  They are
composed into one deterministic transducer, and what a text is scored by are its matched clauses: per
kind of match, the summed weight of the stems in it and the number of matches.

Which stems insult is learned, with their weights, from labelled texts: of all word beginnings, those
that toxic texts have far more often than others, by document counts over all training rows.  A
logistic regression over the match features, fitted by Spark on all training rows, gives the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweft.llm import tables
from logweft.sources.scratch import settle

FOLDS = 5
#: Most stems of the learned lexicon, which bounds the model.
STEMS = 2000
#: Least and most characters of a stem; texts it has to be in, and how clearly it has to tell.
SHORTEST, LONGEST, LEAST_DOCS, LEAST_Z, LEAST_ODDS = 4, 12, 4, 5.0, 1.5
#: Pre-read words a worker remembers.
REMEMBERED = 100_000

# Closed word classes of the grammar, in English, German, French and Spanish.
THREATS = "kill hurt destroy shoot stab beat burn murder töten umbringen schlagen tuer frapper brûler matar golpear quemar".split()
TARGETS = "you your yours yourself he him she her they them people du dich dir dein ihr euch sie tu te toi vous ton votre ils tú usted ustedes tus ellos".split()
NEGATIONS = "not never no none neither nor isn't aren't wasn't don't nicht kein keine nie niemals ne pas jamais aucun nunca jamás ni".split()
REPORTS = "said says saying told wrote writes claimed according quoted called reported sagte sagt schrieb laut dit écrit selon dijo dice escribió según".split()
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;\n]|[\"“”«»]")
ENDS = frozenset(".!?;\n")
QUOTES = frozenset("\"“”«»")

# Symbols.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END = range(8)
# An insult or threat that is negated, and one that is reported, after the first two transducers.
NOT_INSULT, NOT_THREAT, SAID_INSULT, SAID_THREAT = range(8, 12)
# Kinds of match, the outputs of the third; NONE is no match.
NONE, BARE, AIMED, BARE_THREAT, AIMED_THREAT, NEGATED, REPORTED = range(7)
KINDS = 6
#: What the third writes for a target after bare matches of its clause: they are aimed.
TURNED = 7
SCOPE = 3  # words a negation reaches

Table = dict[tuple[int, int], tuple[int, int]]


def negation() -> Table:
    """States count the words a negation still reaches."""
    table: Table = {}
    for left in range(SCOPE + 1):
        for symbol in range(8):
            out = symbol
            if left and symbol in (INSULT, THREAT):
                out = NOT_INSULT if symbol == INSULT else NOT_THREAT
            after = SCOPE if symbol == NEGATION else 0 if symbol == END else max(0, left - 1)
            table[left, symbol] = (after, out)
    return table


def reported() -> Table:
    """State 1: after a reporting verb, to the end of the clause; state 2: within quotes."""
    table: Table = {}
    for state in range(3):
        for symbol in range(10):
            out = symbol
            if state and symbol in (INSULT, THREAT):
                out = SAID_INSULT if symbol == INSULT else SAID_THREAT
            after = state
            if symbol == REPORT:
                after = max(1, state)
            elif symbol == QUOTE:
                after = 0 if state == 2 else 2
            elif symbol == END:
                after = 0
            table[state, symbol] = (after, out)
    return table


def matching() -> Table:
    """State 1: the clause has named a target; state 2: it has not, and has bare matches."""
    outputs = {
        (0, INSULT): BARE, (1, INSULT): AIMED, (0, THREAT): BARE_THREAT, (1, THREAT): AIMED_THREAT,
    }
    table: Table = {}
    for state in range(3):
        for symbol in range(12):
            out = outputs.get((state % 2, symbol), NONE)
            after = state
            if symbol in (NOT_INSULT, NOT_THREAT):
                out = NEGATED
            elif symbol in (SAID_INSULT, SAID_THREAT):
                out = REPORTED
            elif symbol == TARGET:
                out, after = (TURNED if state == 2 else NONE), 1
            elif symbol == END:
                after = 0
            elif out in (BARE, BARE_THREAT):
                after = 2
            table[state, symbol] = (after, out)
    return table


def compose(first: Table, second: Table) -> Table:
    """The transducer that feeds what ``first`` writes to ``second``; states are numbered from (0, 0)."""
    symbols = {symbol for _, symbol in first}
    number, table, todo = {(0, 0): 0}, {}, [(0, 0)]
    while todo:
        a, b = todo.pop()
        for symbol in symbols:
            a2, middle = first[a, symbol]
            b2, out = second[b, middle]
            if (a2, b2) not in number:
                number[a2, b2] = len(number)
                todo.append((a2, b2))
            table[number[a, b], symbol] = (number[a2, b2], out)
    return table


class Grammar:
    """The composed transducer with a lexicon of weighted stems."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.table = compose(compose(negation(), reported()), matching())
        self.fixed = {w: s for words, s in ((THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)) for w in words}
        self.known: dict[str, tuple[int, float]] = {}

    def read(self, word: str) -> tuple[int, float]:
        """Symbol and weight of a lower-case token."""
        if word in ENDS:
            found = (END, 0.0)
        elif word in QUOTES:
            found = (QUOTE, 0.0)
        else:
            stem = next((s for k in range(LONGEST, SHORTEST - 1, -1) if (s := word[:k]) in self.stems and len(s) == k), None)
            found = (INSULT, self.stems[stem]) if stem else (self.fixed.get(word, OTHER), 1.0)
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[word] = found
        return found

    def features(self, text: str) -> list[float]:
        """Per kind of match its weight and its count, then the share of words matched and the largest weight."""
        known, read, table = self.known.get, self.read, self.table
        weights, counts = [0.0] * (KINDS + 1), [0] * (KINDS + 1)
        state, words, most = 0, 0, 0.0
        bare, held = {BARE: AIMED, BARE_THREAT: AIMED_THREAT}, {BARE: (0.0, 0), BARE_THREAT: (0.0, 0)}

        def close(aimed: bool) -> None:
            """Count the bare matches that the clause had so far, which a target after them aims."""
            for kind, (weight, count) in held.items():
                if count:
                    kind_of_match = bare[kind] if aimed else kind
                    weights[kind_of_match] += weight
                    counts[kind_of_match] += count
                    held[kind] = (0.0, 0)

        for token in TOKEN.findall(text.lower()):
            symbol, weight = known(token) or read(token)
            words += 1
            if symbol or state:
                state, out = table[state, symbol]
                if out in held:
                    held[out] = (held[out][0] + weight, held[out][1] + 1)
                    most = max(most, weight)
                elif out == TURNED or symbol == END:
                    close(out == TURNED)
                elif out:
                    weights[out] += weight
                    counts[out] += 1
                    most = max(most, weight)
        close(False)
        total = sum(counts)
        spread = [math.log1p(x) for x in weights[1:] + counts[1:]]
        return [*spread, math.sqrt(total / (words + 1)), most]


FEATURES = 2 * KINDS + 2


def learn_stems(labelled: DataFrame) -> dict[str, float]:
    """Stems and weights from (text, toxic): word beginnings that mark toxic texts.

    Counts are of documents and words over all rows; repeated texts count once.  Of stems that begin with one
    another the clearest stays.  At most ``STEMS`` rows of each task reach the driver.
    """
    once = labelled.groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("l")).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic")
    )
    rate = labelled.agg(F.avg("toxic")).first()[0]
    if not rate or rate == 1:
        return {}
    words = once.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))).alias("word"))
    counted = words.groupBy("word").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    stems = (
        counted.filter(F.length("word") >= SHORTEST)
        .select("bad", "n", F.explode(F.expr(f"transform(sequence({SHORTEST}, least({LONGEST}, length(word))), k -> left(word, k))")).alias("stem"))
        .groupBy("stem")
        .agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
        .filter(F.col("bad") >= LEAST_DOCS)
    )
    z = (F.col("bad") - rate * F.col("n")) / F.sqrt(F.col("n") * rate * (1 - rate))
    odds = F.log((F.col("bad") + 0.5) / (F.col("n") - F.col("bad") + 0.5)) - math.log(rate / (1 - rate))
    best = stems.select("stem", z.alias("z"), odds.alias("odds")).filter((F.col("z") >= LEAST_Z) & (F.col("odds") >= LEAST_ODDS))
    kept = best.groupBy(F.left("stem", F.lit(SHORTEST))).applyInPandas(_clearest, best.schema)
    rows = kept.orderBy(F.desc("z"), F.desc(F.length("stem")), "stem").limit(STEMS).collect()
    return {row["stem"]: min(6.0, row["odds"]) for row in rows}


def _clearest(family: pd.DataFrame) -> pd.DataFrame:
    """The rows of ``family`` but those whose stem begins, or begins with, that of a row with a larger z."""
    family = family.assign(size=family.stem.str.len()).sort_values(["z", "size", "stem"], ascending=[False, False, True])
    chosen: list[str] = []
    for stem in family.stem:
        if not any(stem.startswith(s) or s.startswith(stem) for s in chosen):
            chosen.append(stem)
    return family[family.stem.isin(chosen)].drop(columns="size")


def _featured(docs: DataFrame, stems: dict[str, float], keep: str) -> DataFrame:
    """The columns of ``keep`` (name type, ...) with ``features`` from ``text``."""
    names = [part.split()[0] for part in keep.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(stems)
        for batch in tables.slices(batches):
            found = [grammar.features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(found, pa.list_(pa.float64()))], [*names, "features"])

    return docs.mapInArrow(run, f"{keep}, features array<double>")


class Model:
    """A grammar's stems with the weights of its features."""

    def __init__(self, stems: dict[str, float], weights: list[float], bias: float):
        self.stems, self.weights, self.bias = stems, weights, bias

    @classmethod
    def fit(cls, labelled: DataFrame) -> Model:
        """From (text, toxic 0 or 1).  Without both kinds of rows every score is the share of ones, 0.5 of none."""
        from pyspark.ml.classification import LogisticRegression
        from pyspark.ml.functions import array_to_vector

        kept = settle(labelled.select("text", F.col("toxic").cast("int").alias("toxic")), "labelled")
        stems = learn_stems(kept)
        zero = [0.0] * FEATURES
        count, bad = kept.agg(F.count("*"), F.sum("toxic")).first()
        if not count or not bad or bad == count:
            rate = (bad or 0) / count if count else 0.5
            return cls(stems, zero, math.log((rate + 1e-9) / (1 - rate + 1e-9)))
        rows = settle(_featured(kept, stems, "toxic int"), "features")
        rows = rows.select("toxic", array_to_vector("features").alias("features"))
        fitted = LogisticRegression(labelCol="toxic", regParam=1e-4, maxIter=60).fit(rows)
        return cls(stems, list(fitted.coefficients), float(fitted.intercept))

    def score(self, features: list[float]) -> float:
        x = self.bias + sum(w * f for w, f in zip(self.weights, features, strict=True))
        return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def scored(docs: DataFrame, model: Model, name: str = "_llm_score") -> DataFrame:
    """All columns of ``docs`` with the score of its ``text`` as column ``name``; narrow, one row each.

    A null text scores as an empty one, repeated rows score alike, an empty table gives an empty one, and
    a text of any length is read once from its start to its end.
    """
    kind = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.stems)
        for batch in tables.slices(batches):
            found = [model.score(grammar.features(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, name])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return docs.mapInArrow(run, StructType([*kind.fields, StructField(name, DoubleType())]))


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under ``limit``, with all their columns."""
    name = tables.free(docs, "_llm_score")
    return scored(docs, model, name).filter(F.col(name) < limit).drop(name)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the labelled rows outside fold 0.  A doc labelled more than once has its largest label."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = settle(known.dropna().filter(tables.fold("doc_id", FOLDS) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    return tables.texts(docs).join(tables.bounded(known), "doc_id").select("text", "toxic")


def op2_toxicity(spark, sf_dir):
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", "text")
    model = Model.fit(training_rows(docs, tables.read(spark, sf_dir, "labels")))
    return scored(docs, model).select(
        "doc_id",
        (tables.fold("doc_id", FOLDS) == 0).alias("held_out"),
        F.col("_llm_score").alias("score"),
        F.when(F.col("_llm_score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
