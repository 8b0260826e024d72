"""Fill-in-middle: texts cut into prefix, middle and suffix by one counted regular expression.

A unit is a run of ASCII letters or one other character.  ``regexp_count`` gives the number of units;
two hashes of the id say after how many of them the prefix and the middle end.  The row's own pattern
then takes exactly that many units in each of two possessive groups and the rest in a third, and one
replacement writes them in the order of the wanted form.  Possessive groups never give back what they
took, so a match is one pass over the text however long it is.

Everything is column expressions: no shuffle, and no row needs another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.llm import tables

UNIT = "[A-Za-z]+|[^A-Za-z]"
MARKS = ("<P>", "<S>", "<M>")
#: Of a hundred texts, those that stay plain, and, of the others, those that begin with the suffix.
PLAIN, SUFFIX_FIRST = 10, 20
#: Characters of a text whose units are listed at a time.
PIECE = 1 << 20


def _count() -> str:
    """SQL for the number of units of ``text``, counted piece by piece.

    A cut inside a run of letters makes one unit two, which is taken off again.
    """
    piece = f"substring(text, 1 + {PIECE} * k, {PIECE})"
    torn = f"CAST(substring(text, {PIECE} * k, 2) RLIKE '^[A-Za-z][A-Za-z]$' AND k > 0 AS bigint)"
    return f"""aggregate(sequence(0L, (char_length(text) - 1) div {PIECE}), 0L,
        (n, k) -> n + regexp_count({piece}, '{UNIT}') - {torn})"""


def infilled(docs: DataFrame, seed: int = 1, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, text, n, form, output) of each row of ``docs`` (doc_id, text).

    ``n`` is the number of units; ``form`` is plain, psm (prefix, suffix, middle) or spm (suffix, prefix,
    middle), and ``output`` the text in that form.  Empty texts, and those that hold a mark, are plain.
    What a row gets depends on ``seed``, its id and its text alone, so repeated rows come back alike; a
    null id hashes as empty text.  An empty table gives an empty result.  Of a very long text, the
    units of ``PIECE`` characters are listed at a time.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    hashes = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]
    counted = docs.select("doc_id", "text", F.expr(f"if(text = '', 0L, {_count()})").alias("n"), *hashes)
    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | F.col("text").contains(mark)
    form = F.when((F.col("text") == "") | marked | (F.col("h3") % 100 >= 100 - plain), "plain").when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm")
    cut = counted.selectExpr("*", "least(h1 % (n + 1), h2 % (n + 1)) AS a", "greatest(h1 % (n + 1), h2 % (n + 1)) AS b").withColumn("form", form)
    unit = UNIT.replace("+", "++")
    pattern = f"concat('(?s)^((?:{unit}){{', a, '}}+)((?:{unit}){{', b - a, '}}+)(.*)$')"
    order = "if(form = 'spm', '<S>$3<P>$1<M>$2', '<P>$1<S>$3<M>$2')"
    return cut.selectExpr("doc_id", "text", "n", "form", f"if(form = 'plain', text, regexp_replace(text, {pattern}, {order})) AS output")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text an output was made of.  No part of a text holds a mark, so the first of each is the cut."""
    return F.expr(f"""CASE {form}
        WHEN 'psm' THEN regexp_replace({output}, '(?s)^<P>(.*?)<S>(.*?)<M>(.*)$', '$1$3$2')
        WHEN 'spm' THEN regexp_replace({output}, '(?s)^<S>(.*?)<P>(.*?)<M>(.*)$', '$2$3$1')
        ELSE {output} END""")


def sizes(output: str = "output", form: str = "form") -> list[Column]:
    """``prefix_chars`` and ``middle_chars`` of an output, null if it is plain."""
    prefix = f"CASE {form} WHEN 'psm' THEN locate('<S>', {output}) - 4 WHEN 'spm' THEN locate('<M>', {output}) - locate('<P>', {output}) - 3 END"
    middle = f"if({form} = 'plain', NULL, char_length({output}) - locate('<M>', {output}) - 2)"
    return [F.expr(f"CAST({prefix} AS bigint)").alias("prefix_chars"), F.expr(f"CAST({middle} AS bigint)").alias("middle_chars")]


def op13_infill(spark, sf_dir):
    made = infilled(tables.texts(tables.read(spark, sf_dir, "documents")))
    return made.select(
        "doc_id", "n", "form", *sizes(), F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256")
    )


ORACLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
hashed AS (
  SELECT *, len(u) AS n, ('0x' || substr(d, 1, 8))::BIGINT AS h1, ('0x' || substr(d, 9, 8))::BIGINT AS h2,
    ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4 FROM units),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
      THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
    ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
