"""Reply trees to training conversations.

A message points at the message it answers.  Root-to-leaf paths are found by self-joins that double
their reach: after k joins a message knows its ancestor 2^k steps up and the score of the steps between,
so a thread of n messages takes about log2(n) joins.  Leaves are ranked by the total score of their path,
and only the chosen ones are spelled out into paths.  Only ids and scores are joined; texts join once,
at the end.

Each chosen path is rendered turn by turn as ``<|role|>``, newline, text, ``<|end|>``, newline.  In roles and
texts every backslash is doubled and every control string is broken by a backslash after its first
character, so no control string is left and ``unescape`` gives back exactly what was there.  A
conversation leaves as segments of about ``SEGMENT`` characters, each of whole turns, so a very long
thread never has to fit into one row; most have one segment.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweft.llm import tables
from logweft.sources.scratch import settle

#: Characters after which a conversation goes on in another segment.
SEGMENT = 1 << 20
#: First characters of control strings, with what makes them one.
CONTROL = r"\\|<(?=\||/?s>)|\|(?=>)|\[(?=/?INST\])"
TURN = re.compile(r"<\|(.*?)\|>\n(.*?)<\|end\|>\n", re.DOTALL)
ASSISTANT = "assistant"


def escape(text: Column | str) -> Column:
    return F.regexp_replace(text, f"({CONTROL})", r"$1\\")


def unescape(text: str) -> str:
    """A lone backslash goes, a pair becomes one."""
    return re.sub(r"\\(\\?)", r"\1", text) if "\\" in text else text


def chain(turns: DataFrame) -> DataFrame:
    """Messages (conv_id, node, parent, score, role, text) of a table of turns, each answering the last.

    Order is by turn, then role and text, nulls first; repeated rows are messages of their own.
    """
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("bigint")
    placed = rows.select("conv_id", node.alias("node"), "role", "text")
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return placed.select("conv_id", "node", parent.alias("parent"), F.lit(1.0).alias("score"), "role", "text")


def ranked_leaves(links: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Leaves with their rank within the conversation, and the doubling jumps that reach their ancestors.

    ``links`` is a settled (conv_id, node, parent, score).  A parent that does not exist makes a root.
    Messages on a cycle, or below one, have no root and so no path.
    """
    above = links.select(F.col("conv_id").alias("c"), F.col("node").alias("p")).distinct()
    found = links.join(above, F.expr("conv_id <=> c AND parent = p"), "left")
    state = settle(found.select("conv_id", "node", F.col("p").alias("up"), "score"), "jumps")
    most = links.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    jumps, finished = [], []
    while len(jumps) <= most.bit_length() and state.filter("up IS NOT NULL").limit(1).count():
        climbing = state.filter("up IS NOT NULL")
        jumps.append(climbing.select("conv_id", "node", "up"))
        # Trees in which every message knows its root take no part in further rounds.
        active = climbing.select(F.col("conv_id").alias("c")).distinct()
        in_active = F.expr("conv_id <=> c")
        finished.append(state.join(active, in_active, "left_anti"))
        state = state.join(active, in_active, "left_semi")
        upper = state.select(
            F.col("conv_id").alias("c"), F.col("node").alias("n"), F.col("up").alias("next"), F.col("score").alias("more")
        )
        joined = climbing.join(upper, F.expr("conv_id <=> c AND up = n")).select(
            "conv_id", "node", F.col("next").alias("up"), (F.col("score") + F.col("more")).alias("score")
        )
        state = settle(joined.unionByName(state.filter("up IS NULL")), "jumps")
    for trees in finished:
        state = state.unionByName(trees)
    answered = links.filter("parent IS NOT NULL").select(F.col("conv_id").alias("c"), F.col("parent").alias("p")).distinct()
    leaves = state.filter("up IS NULL").join(answered, F.expr("conv_id <=> c AND node = p"), "left_anti")
    best = Window.partitionBy("conv_id").orderBy(F.desc("score"), "node")
    return leaves.select("conv_id", F.col("node").alias("leaf"), F.row_number().over(best).alias("rank")), jumps


def reply_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv_id, rank, position, role, text): the ``branches`` best root-to-leaf paths of each tree.

    ``messages`` has conv_id, node (unique within its conversation), parent, score, role and text.  Ties
    go to the smaller leaf.  Positions count from the root and increase, without being dense.
    """
    messages = settle(messages, "messages")
    links = messages.select("conv_id", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    leaves, jumps = ranked_leaves(links)
    path = leaves.filter(F.col("rank") <= branches).select(
        "conv_id", "rank", F.col("leaf").alias("node"), F.lit(0).cast("bigint").alias("up")
    )
    for k, jump in enumerate(jumps):
        step = jump.select(F.col("conv_id").alias("c"), F.col("node").alias("n"), F.col("up").alias("to"))
        further = path.join(step, F.expr("conv_id <=> c AND node = n"))
        more = further.select("conv_id", "rank", F.col("to").alias("node"), (F.col("up") + F.lit(1 << k)).alias("up"))
        path = settle(path.unionByName(more), "paths")
    told = messages.select(F.col("conv_id").alias("c"), F.col("node").alias("n"), "role", "text")
    return path.join(told, F.expr("conv_id <=> c AND node = n")).select(
        "conv_id", "rank", (-F.col("up")).alias("position"), "role", "text"
    )


def formatted(paths: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, rank, segment, formatted): each path as one conversation, in order, in segments."""
    turn = F.concat(F.lit("<|"), escape("role"), F.lit("|>\n"), escape("text"), F.lit("<|end|>\n"))
    rows = paths.select("conv_id", "rank", "position", turn.alias("turn"))
    rows = rows.repartition("conv_id", "rank").sortWithinPartitions("conv_id", "rank", "position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, number, size, held = None, 0, 0, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"conv_id": pa.array([key[0]], pa.int64()), "rank": pa.array([key[1]], pa.int32()), "segment": pa.array([number], pa.int64()), "formatted": ["".join(held)]}
            )

        for batch in batches:
            for conv, rank, turn in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "rank", "turn")), strict=True):
                if key != (conv, rank):
                    if held:
                        yield out()
                    key, number, size, held = (conv, rank), 0, 0, []
                elif size >= segment:
                    yield out()
                    number, size, held = number + 1, 0, []
                held.append(turn)
                size += len(turn)
        if held:
            yield out()

    return rows.select("conv_id", "rank", "turn").mapInArrow(run, "conv_id bigint, rank int, segment bigint, formatted string")


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation and rank, what its formatted text says: turns and the assistant's texts.

    Segments have to arrive in order within a partition, as ``formatted`` leaves them.  Digests are
    carried along, so no conversation is held in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def out() -> pa.RecordBatch:
            turns, whole, loss, chars, size = state
            row = {"conv_id": key[0], "rank": key[1], "n_turns": turns, "turns_sha256": whole.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": size}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema(
            [("conv_id", pa.int64()), ("rank", pa.int32()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
        )
        for batch in batches:
            for conv, rank, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "rank", "formatted")), strict=True):
                if key != (conv, rank):
                    if key:
                        yield out()
                    key, state = (conv, rank), [0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                state[4] += len(text)
                for role, body in TURN.findall(text):
                    role, body = unescape(role), unescape(body)
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode())
                    if role == ASSISTANT:
                        state[2].update(body.encode())
                        state[3] += len(body)
        if key:
            yield out()

    kinds = "conv_id bigint, rank int, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return segments.mapInArrow(run, kinds)


def op4_reply_trees(spark, sf_dir):
    turns = tables.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    own = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), said.alias("text"),
    )
    paths = reply_paths(chain(turns.unionByName(own)))
    return read_back(formatted(paths)).drop("rank")


#: The same by string aggregation; the template adds 2 + 3 + 8 characters a turn.
_ESC = r"regexp_replace(regexp_replace({0}, '\\', '\\\\', 'g'), '(<)(\||/?s>)|(\|)(>)|(\[)(/?INST\])', '\1\3\5\\\2\4\6', 'g')"
ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(13 + length({_ESC.format('role')}) + length({_ESC.format('text')})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
