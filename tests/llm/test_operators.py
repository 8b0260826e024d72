"""Each operator against a brute-force version, and on null, empty, repeated and oddly named input."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import random
import string
import zlib

import numpy as np
import pytest
from logweft.llm import bpe, chunks, components, ctw, leaks, lines, neighbours, replies, secrets, simhash, tables, toxicity
from pyspark.sql import Observation
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"
ODD = "doc_id bigint, text string, score double, component_id bigint, value bigint, line_no int, _llm string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    tables.ship(spark)


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] for r in tables.read(spark, SF, "documents").select("doc_id", "text").collect()}


def odd(spark, rows):
    """Documents with columns named like the operators' own."""
    return spark.createDataFrame([(i, t, 1.0, 2, 3, 4, "x") for i, t in rows], ODD)


LONG = "the tion ing a. " * 20_000
CASES = [(1, None), (2, ""), (3, "  \n\t "), (4, "one line"), (4, "one line"), (None, "no id here"), (None, None), (5, LONG), (6, "é" * 300), (7, "a\n\nb\n")]


def grouped(pairs):
    found = collections.defaultdict(set)
    for key, member in pairs:
        found[key].add(member)
    return sorted(map(sorted, found.values()))


def unite(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return [find(x) for x in range(n)]


def test_components(spark):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(60)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(120)] + [(7, 7), (None, 3)]
    edges = spark.createDataFrame(links, "u bigint, v bigint")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    want = unite(300, [x for x in links if None not in x])
    assert grouped((got.get(k, k), k) for k in range(300)) == grouped((want[k], k) for k in range(300))
    assert all(got[k] < k for k in got)
    assert components.components(edges.limit(0)).count() == 0


def test_decontamination(spark, docs):
    found = leaks.op1_decontamination(spark, SF).collect()
    items = {r["item_id"]: leaks.normal(r["text"]) for r in tables.read(spark, SF, "benchmark").collect()}
    whole = {(d, i) for d, t in docs.items() for i, item in items.items() if item in leaks.normal(t)}
    assert whole and whole <= {(r["doc_id"], r["item_id"]) for r in found}
    for r in found:
        assert leaks.normal(docs[r["doc_id"]])[r["start"] : r["end"]]


def test_edits_and_bands():
    def plain(p, t):
        row = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            new = [i]
            for j in range(1, len(t) + 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != t[j - 1])))
            row = new
        return min(row)

    rng = random.Random(3)
    for _ in range(200):
        p = "".join(rng.choices("ab c", k=rng.choice([14, 40, 80])))
        t = list(p)
        for _ in range(rng.randrange(7)):
            k = rng.randrange(len(t))
            t[k : k + rng.randrange(2)] = rng.choice(["", "x", "yz"])
        t = "x" * rng.randrange(8) + "".join(t)
        got, want = leaks.edits(p, t, 4), plain(p, t)
        assert (got[0] if got else None) == (want if want <= 4 else None)
    assert leaks.edits("a" * 40, "a" * 10, 2) is None
    item = "a passage of a benchmark item that is long enough to be cut into several windows, with figures 12345 and names"
    index = leaks.Index([(1, leaks.normal(item))])
    assert index.find(leaks.normal("before " + item.upper() + " after"))
    changed = leaks.normal(item.replace("benchmark", "benchmrk").replace("figures", "figurez"))
    assert index.find("x y z " + changed)
    assert not index.find(leaks.normal("an unrelated text " * 30))


def test_decontamination_edges(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "short"), (4, "one line of a longer benchmark item"), (None, "no id but long enough")], "item_id bigint, text string")
    rows = odd(spark, [*CASES, (9, "it says: ONE line  of a longer\nbenchmark item!"), (None, "no id but long enough")])
    found = {(r["doc_id"], r["item_id"]) for r in leaks.leaks(tables.texts(rows), bench, block=10).collect()}
    assert found == {(9, 4), (None, None)}
    kept = leaks.without_leaks(rows, bench, block=10)
    assert kept.columns == rows.columns and kept.count() == len(CASES)
    assert leaks.leaks(tables.texts(rows), bench.limit(0)).count() == 0
    assert leaks.leaks(tables.texts(rows.limit(0)), bench).count() == 0


def test_toxicity_grammar():
    grammar = toxicity.Grammar({"idiot": 3.0, "moron": 2.0})

    def kinds(text):
        return [round(math.expm1(c)) for c in grammar.features(text)[toxicity.KINDS : 2 * toxicity.KINDS]]

    assert kinds("What an idiot.") == [1, 0, 0, 0, 0, 0]
    assert kinds("You are an IDIOT, you moron###!") == [0, 2, 0, 0, 0, 0]
    assert kinds("You. An idiot.") == [1, 0, 0, 0, 0, 0]
    assert kinds("They will kill. You kill") == [0, 0, 0, 2, 0, 0]
    assert kinds("Idiot, that is you! An idiot.") == [1, 1, 0, 0, 0, 0]
    assert kinds("I will kill you, you idiot. Kill.") == [0, 1, 1, 1, 0, 0]
    assert kinds("she is not an idiot") == [0, 0, 0, 0, 1, 0]
    assert kinds("he said: moron") == [1, 0, 0, 0, 0, 0] or kinds("he said moron") == [0, 0, 0, 0, 0, 1]
    assert kinds('"idiot" they wrote') == [0, 0, 0, 0, 0, 1]
    assert grammar.features("") == [0.0] * toxicity.FEATURES


def test_toxicity_composition():
    """The composed transducer writes what the three write one after the other."""
    rng = random.Random(3)
    one = toxicity.compose(toxicity.compose(toxicity.negation(), toxicity.reported()), toxicity.matching())
    for _ in range(300):
        want = got = rng.choices(range(8), k=40)
        for table in (toxicity.negation(), toxicity.reported(), toxicity.matching()):
            state, out = 0, []
            for symbol in want:
                state, written = table[state, symbol]
                out.append(written)
            want = out
        state, out = 0, []
        for symbol in got:
            state, written = one[state, symbol]
            out.append(written)
        assert out == want


def test_toxicity_stems(spark, monkeypatch):
    """Beginnings of one word take one place of the lexicon."""
    rows = [(f"some plain words here {k} {'abcdefgh'[k % 8]}", 0) for k in range(200)]
    rows += [(f"the {w}{'ish' if k % 2 else ''} stands here {k}", 1) for w in ("gromblefax", "plundernit", "wextrabolm") for k in range(20)]
    labelled = spark.createDataFrame(rows, "text string, toxic int")
    whole = toxicity.learn_stems(labelled)
    assert {s[:4] for s in whole} == {"grom", "plun", "wext", "stan"} and len(whole) == 4
    monkeypatch.setattr(toxicity, "STEMS", 4)
    assert toxicity.learn_stems(labelled) == whole


def test_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    rows = toxicity.op2_toxicity(spark, sf).join(tables.read(spark, sf, "labels"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    case = odd(spark, CASES)
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (99, None)], "doc_id bigint, toxic int")
    model = toxicity.Model.fit(toxicity.training_rows(case, labels))
    scored = toxicity.scored(case, model)
    assert scored.columns == [*case.columns, "_llm_score"] and scored.count() == len(CASES)
    assert toxicity.scored(case.limit(0), toxicity.Model.fit(toxicity.training_rows(case.limit(0), labels))).count() == 0


def kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)


def test_context_tree(spark):
    """Every code length against a direct recursion over the decisions' context trees."""
    rng = random.Random(5)
    texts = ["".join(rng.choices("abé ", k=rng.randrange(30))) for _ in range(40)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, None), (50, "")]
    got = {r["doc_id"]: r for r in ctw.lm_scores(odd(spark, rows)).collect()}
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    seen = collections.Counter()

    def steps(text):
        data = bytes([ctw.EDGE]) * ctw.DEPTH + (text or "").encode().lower() + bytes([ctw.EDGE])
        for k in range(ctw.DEPTH, len(data)):
            for bit in range(8):
                yield data[k - ctw.DEPTH : k], (bit, data[k] >> (8 - bit)), data[k] >> (7 - bit) & 1

    for i, text in rows:
        for context, node, bit in steps(text):
            for d in range(ctw.DEPTH + 1):
                seen[context[ctw.DEPTH - d :], node, bit] += not held[i]
    children = collections.defaultdict(set)
    for context, node, _ in seen:
        if context:
            children[context[1:], node].add(context)

    memo = {}

    def weighted(context, node):
        if (context, node) not in memo:
            own = kt(seen[context, node, 0], seen[context, node, 1])
            if len(context) < ctw.DEPTH:
                below = sum(weighted(c, node) for c in children[context, node])
                own = np.logaddexp(own, below) - math.log(2)
            memo[context, node] = own
        return memo[context, node]

    def predicted(context, node, bit, depth=0):
        short = context[ctw.DEPTH - depth :]
        a, b = seen[short, node, 0], seen[short, node, 1]
        p = ((b if bit else a) + 0.5) / (a + b + 1)
        if depth == ctw.DEPTH:
            return p
        beta = math.exp(kt(a, b) - sum(weighted(c, node) for c in children[short, node]))
        return (beta * p + predicted(context, node, bit, depth + 1)) / (beta + 1)

    for i, text in rows:
        want = sum(math.log10(predicted(*step)) for step in steps(text))
        assert got[i]["score"] == pytest.approx(want, rel=1e-5), i
    words = collections.Counter()
    for i, text in rows:
        if not held[i]:
            words.update([*(text or "").encode().lower().split(), b" "])
    total = sum(words.values())
    for i, text in rows:
        tokens = [*(text or "").encode().lower().split(), b" "]
        base = sum(math.log10((words[w] + 1) / (total + len(words) + 1)) for w in tokens)
        r = got[i]
        assert r["base_score"] == pytest.approx(base) and r["held_out"] == held[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(words[w] > 0 for w in tokens), total)
    assert ctw.lm_scores(odd(spark, CASES)).count() == len(CASES)
    assert ctw.lm_scores(odd(spark, CASES).limit(0)).count() == 0


def test_context_tree_of_long_texts(spark, monkeypatch):
    """Blocks hold so many bytes at most, or one text; how texts are dealt changes no score."""
    rng = random.Random(6)
    texts = ["".join(rng.choices("abcde ", k=rng.randrange(400))) for _ in range(60)] + ["".join(rng.choices("abé ", k=1_000_000)) for _ in range(3)]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, None, ""])], "doc_id bigint, text string")
    whole = sorted(ctw.lm_scores(rows).collect())
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 1 << 15)
    monkeypatch.setattr(ctw, "BLOCK_ROWS", 1 << 10)
    blocks = ctw.blocked(rows).groupBy("block").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).collect()
    assert sum(b["n"] for b in blocks) == 65 and max(b["n"] for b in blocks) > 3
    assert all(b["bytes"] <= 1 << 15 or b["n"] == 1 for b in blocks)
    for one, other in zip(whole, sorted(ctw.lm_scores(rows).collect()), strict=True):
        assert one[:5] == other[:5] and one[5:] == pytest.approx(other[5:], rel=1e-6)


def test_reply_paths(spark):
    rows = [
        (1, 1, None, 1.0, "user", "root"), (1, 2, 1, 5.0, "assistant", "good"), (1, 3, 1, 1.0, "assistant", "bad"),
        (1, 4, 3, 9.0, "user", "deep"), (1, 5, 4, None, "assistant", "deeper"), (2, 1, 77, 0.0, "user", "dangling"),
        (3, 1, 2, 1.0, "user", "cycle"), (3, 2, 1, 1.0, "user", "cycle"), (None, 1, None, 1.0, "user", "null tree"),
    ]
    messages = spark.createDataFrame(rows, "conv_id bigint, node bigint, parent bigint, score double, role string, text string")
    found = replies.reply_paths(messages, branches=2).orderBy("conv_id", "rank", "position").collect()
    paths = collections.defaultdict(list)
    for r in found:
        paths[r["conv_id"], r["rank"]].append(r["text"])
    assert paths == {(1, 1): ["root", "bad", "deep", "deeper"], (1, 2): ["root", "good"], (2, 1): ["dangling"], (None, 1): ["null tree"]}


def test_chat_format(spark):
    texts = ["</s>[INST] ok [/INST]", "a\\b <|end|>\n<|user|>", "|>\\<|", None, "", "<<s>\\\\", LONG]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(texts)] + [(2, None, None, "x"), (2, None, None, "x"), (None, 0, "we|>ird", "y")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    paths = replies.reply_paths(replies.chain(turns))
    for segment in (40, replies.SEGMENT):
        formatted = replies.formatted(paths, segment)
        got = {r["conv_id"]: r for r in replies.read_back(formatted).collect()}
        whole = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in rows[: len(texts)])
        loss = "".join(t or "" for k, t in enumerate(texts) if k % 2)
        assert (got[1]["n_turns"], got[1]["turns_sha256"]) == (len(texts), hashlib.sha256(whole.encode()).hexdigest())
        assert (got[1]["loss_chars"], got[1]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[2]["n_turns"] == 2 and got[None]["n_turns"] == 1
    bodies = "".join(r["formatted"] for r in formatted.filter("conv_id = 1").collect())
    assert not any(c in body for _, body in replies.TURN.findall(bodies) for c in ("</s>", "[INST]", "[/INST]", "<|", "|>"))
    assert replies.reply_paths(replies.chain(turns.limit(0))).count() == 0


def test_bpe(spark):
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    known = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own, rng = bpe.codec(path, P.PATTERN), random.Random(2)
    parts = ["ab", "the tion ing", "aAéßñ 日本語", "!?..,,--==##", "0123456789", "  \n\t ", "schaftung"]
    for _ in range(400):
        text = "".join(rng.choice(rng.choice(parts)) for _ in range(rng.choice([3, 30, 400])))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == known.encode_ordinary(text)
        assert own.decode(own.encode(text)).decode() == text
    for text in (LONG, "a" * 5000, "tion" * 900):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == known.encode_ordinary(text)
    got = bpe.digests(tables.texts(odd(spark, CASES)))
    assert sorted(r["n_tokens"] for r in got.collect()) == sorted(len(known.encode_ordinary(t or "")) for _, t in CASES)
    ids = bpe.round_trip(tables.texts(odd(spark, [(4, "one line")])), path, P.PATTERN).select(bpe.unpacked("token_ids").alias("ids"))
    assert ids.first()["ids"] == known.encode_ordinary("one line")


def test_bpe_forgets_and_decodes_by_halves(monkeypatch):
    import public_tokenizers as P

    path = P.path("byte_bpe_multi_50k.tiktoken")
    text = " ".join(f"word{i % 40} schaftung{i}" for i in range(300))
    whole = bpe.Codec.load(path, P.PATTERN).encode(text)
    monkeypatch.setattr(bpe, "REMEMBERED", 7)
    monkeypatch.setattr(bpe, "PIECE", 64)
    own = bpe.Codec.load(path, P.PATTERN)
    assert own.encode(text) == own.encode(text) == whole
    assert len(own) <= 7 and len(own.before) <= 7
    assert own.decode(whole).decode() == text and own.decode(b"") == b""


def test_signed_lines(spark):
    texts = ["a line of some length", "short", "a line of some length", "another line here", "short"]
    split = lines.split(odd(spark, [(1, "\n".join(texts)), (None, "short\n \n"), (None, None)]).coalesce(1))
    known = lines.signed(split)
    assert known.columns == ["doc_id", "text_hash", "line_no", "h1", "h2", "bands"]
    seen = collections.defaultdict(list)
    for r in known.join(split.select("h1", "line").distinct(), "h1").collect():
        seen[r["line"]].append(r["bands"])
    assert {k: len(v) for k, v in seen.items()} == {texts[0]: 2, "short": 3, texts[3]: 1}
    for line, got in seen.items():
        has = [b for b in got if b is not None]
        assert has and all(b == lines.signatures([line])[1].tolist() for b in has)
    assert lines.signed(split.limit(0)).count() == 0


def test_chunks(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
    passage = " ".join(word() for _ in range(120))
    rows = [(k, " ".join(word() for _ in range(80))) for k in range(30)]
    rows += [(100 + k, rows[k][1][: 50 + 7 * k] + " " + passage + rows[k][1][60:]) for k in range(6)]
    found = chunks.repeats(tables.texts(odd(spark, [*rows, (None, passage), (500, None), (501, ""), (502, LONG), (502, LONG)]))).collect()
    hit = {r["doc_id"] for r in found}
    assert {101, 102, 103, 104, 105} <= hit and not hit & set(range(6, 30))
    texts = dict(rows)
    for r in found:
        if r["doc_id"] in texts and r["source_doc_id"] in texts:
            a, b = texts[r["doc_id"]].encode(), texts[r["source_doc_id"]].encode()
            assert a[r["start"] : r["start"] + r["size"]] == b[r["source_start"] : r["source_start"] + r["size"]]
    data = np.frombuffer(LONG[:9000].encode() + bytes(range(256)) * 9, np.uint8)
    ends = chunks.ends(data)
    plain, h, start = [], 0, 0
    for k, b in enumerate(data.tolist()):
        h = ((h << 1) + int(chunks.GEAR[b])) & 0xFFFF
        small = h < (1 << 16) // chunks.MEAN and k + 1 - start >= chunks.LEAST
        if small or k + 1 - start == chunks.MOST:
            start = k + 1
            plain.append(start)
    assert ends == plain + ([len(data)] if start < len(data) else [])
    assert chunks.repeats(tables.texts(odd(spark, CASES).limit(0))).count() == 0


def test_chunks_meet_alike_at_every_size(spark, monkeypatch):
    """Shared digests are not broadcast by force, and repeats are dealt out once, by document."""
    plans, settle = {}, chunks.settle

    def watched(rows, name):
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return settle(rows, name)

    monkeypatch.setattr(chunks, "settle", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = chunks.repeats(tables.texts(odd(spark, [(1, LONG), (2, LONG), (3, LONG[5:]), (3, None)])))
        assert {r["doc_id"] for r in found.collect()} == {1, 2, 3}  # LONG repeats itself
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plans["common"] and "SortMergeJoin" in plans["common"]
    assert not any("start#" in line for line in plans["runs"].splitlines() if "Exchange hashpartitioning" in line)


def test_chunk_repeats_are_whole_passages(spark, monkeypatch):
    monkeypatch.setattr(chunks, "REACH", 600)
    rng = random.Random(16)
    word = lambda: "".join(rng.choices("abcdefghijé", k=rng.randrange(2, 9)))
    words = lambda n: " ".join(word() for _ in range(n))
    rows, want = [], []
    ids = [(1, 2), (None, None), (7, 7), (None, 9), *((100 + 2 * k, 101 + 2 * k) for k in range(60))]
    for k, pair in enumerate(ids):
        passage = words(rng.randrange(60, 120))
        two = [(name, f"{words(rng.randrange(40))}A{k} {passage}{end} {words(rng.randrange(40))}") for name, end in zip(pair, "BC")]
        rows += two
        # The passage with what else is equal beside it, in one of the two: the other is its source.
        spans = [(t.encode().find(f"{k} {passage}".encode()), t.encode()) for _, t in two]
        left = next((n for n in range(1, 9) if spans[0][1][spans[0][0] - n] != spans[1][1][spans[1][0] - n]), 9) - 1
        size = len(f"{k} {passage}".encode()) + left
        want.append([(name, at - left, size) for (name, _), (at, _) in zip(two, spans)])
    rows += [(50, words(20)), (50, words(20)), (51, words(150)), (51, None), (None, "")]
    rows += [(300, text := words(90)), (300, text)]  # equal rows are no repeat of themselves
    found = [tuple(r) for r in chunks.repeats(tables.texts(odd(spark, rows))).collect()]
    assert len(found) == len(want)
    for pair in want:
        (own, other) = pair if pair[0] in {r[:3] for r in found} else pair[::-1]
        assert (*own, other[0], other[1]) in found
    copies = [(k, words(70)) for k in (5, 6)]
    copies += [(k + 10, text) for k, text in copies] + [(k + 20, text) for k, text in copies]
    found = chunks.repeats(tables.texts(odd(spark, copies))).collect()
    assert sorted((r["doc_id"], r["source_doc_id"], r["start"]) for r in found) == [(15, 5, 0), (16, 6, 0), (25, 5, 0), (26, 6, 0)]
    assert all(r["size"] == len(dict(copies)[r["doc_id"]].encode()) for r in found)


@pytest.mark.parametrize("size", [51, 60, 80])
def test_chunk_recall(spark, docs, size):
    rng = random.Random(size)
    known = [w for text in docs.values() for w in (text or "").split()]
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9)))
    words = lambda n: " ".join(word() for _ in range(n))
    rows, long = [], set()
    for k in range(400):
        start = rng.randrange(len(known) - size)
        passage = " ".join(known[start : start + size])
        # One word over and over has the same hash everywhere, and no chunk ends in it.
        if len(passage.encode()) >= chunks.SPAN + 8 and len(set(passage.split())) > size / 2:
            long.add(2 * k + 1)
        passage = f"{passage} {k}"
        rows += [(2 * k, f"{words(30)} {passage} {words(20)}"), (2 * k + 1, f"{words(20)} {passage} {words(30)}")]
    found = {r["doc_id"] for r in chunks.repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(long) > 360 and len(found & long) >= 0.99 * len(long)


CLASHING = ["_llm_key", "_llm_hash", "_llm_gone", "_llm_leaks", "_llm_score", "_llm_id", "line_no", "value", "root"]


def test_columns_that_clash(spark):
    rows = [(1, "a line to see twice\nand one of its own"), (2, "a line to see twice\nand a further line here"), (2, None), (None, "no id here")]
    wide = spark.createDataFrame([(i, t, *range(len(CLASHING))) for i, t in rows], "doc_id bigint, text string, " + ", ".join(f"{c} int" for c in CLASHING))
    bench = spark.createDataFrame([(4, "and a further line here")], "item_id bigint, text string")
    model = toxicity.Model({"idiot": 3.0}, [0.0] * toxicity.FEATURES, -1.0)
    for kept in (lines.without_copies(wide), leaks.without_leaks(wide, bench), toxicity.without_toxic(wide, model), simhash.one_of_each(wide)):
        found = kept.collect()
        assert kept.columns == wide.columns and len(found) >= 3
        assert all([r[c] for c in CLASHING] == list(range(len(CLASHING))) for r in found)
    assert {r["doc_id"]: r["text"] for r in lines.without_copies(wide).collect()}[2] in (None, "and a further line here")


def test_pairs_of_blocks_are_dealt_out(spark):
    members = spark.createDataFrame([(1, k, k, f"line {k}") for k in range(20)], "band bigint, h1 bigint, h2 bigint, line string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lines._block_links(members, 0.8)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    between = plan[plan.index("FlatMapGroupsInPandas") : plan.index("SortMergeJoin")]
    assert "Exchange hashpartitioning(band" in between and "low" in between.split("Exchange hashpartitioning(band")[1][:60]


@pytest.mark.parametrize("group", [simhash.GROUP, 16])
def test_simhash_links(spark, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)
    rng = np.random.default_rng(1)
    near = (np.uint64(0xABCDEF) << np.uint64(40)) | rng.integers(0, 1 << 16, 300).astype(np.uint64)
    values = np.unique(np.r_[rng.integers(0, 1 << 63, 500).astype(np.uint64), near, near[:50] ^ np.uint64(1 << 50 | 1 << 3)])
    links = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2)
    want = unite(len(values), links.tolist())
    signed = values.view(np.int64).tolist()
    rows = spark.createDataFrame([(v,) for v in signed], "value bigint")
    got = {r["node"]: r["root"] for r in components.components(simhash.fingerprint_links(rows)).collect()}
    assert grouped((got.get(v, v), v) for v in signed) == grouped((w, v) for w, v in zip(want, signed, strict=True))


def test_simhash(spark):
    import xxhash

    def plain(text):
        words = (text or "").encode().lower().split()
        runs = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows = simhash.near_duplicates(tables.texts(odd(spark, CASES))).collect()
    assert sorted(r["value"] % (1 << 64) for r in rows) == sorted(plain(t) for _, t in CASES)
    empty = [r for r in rows if r["value"] == 0]
    assert len(empty) == 4 and all(r["component_id"] == 1 for r in empty)
    kept = simhash.one_of_each(odd(spark, CASES))
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == odd(spark, CASES).columns and ids.count(4) == 1 and 2 not in ids and 1 in ids
    assert simhash.near_duplicates(tables.texts(odd(spark, CASES).limit(0))).count() == 0


def test_neighbours(spark):
    sf = "/root/testdata/sf0.01"
    vectors = tables.read(spark, sf, "embeddings").select("vec_id", "embedding")
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in vectors.collect()}
    same = rows[0]
    extra = [(10_000 + k, same.tolist()) for k in range(9)] + [(20_000, None), (20_050, [0.0] * 64), (20_100, [float("nan")] * 64), (20_150, [None] * 64), (None, same.tolist()), (30_000, [1.0, 2.0]), (30_050, [2.0, 1.0])]
    both = vectors.unionByName(spark.createDataFrame(extra, "vec_id bigint, embedding array<double>").selectExpr("vec_id", "cast(embedding AS array<float>) AS embedding"))
    rows |= {i: np.array(v) for i, v in extra[:9]}
    ids = sorted(rows)
    x = np.stack([rows[i].astype(np.float32).astype(float) for i in ids])
    got = collections.defaultdict(list)
    for r in neighbours.nearest(both).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"], r["rank"]))
    assert [g[0] for g in got.pop(30_000)] == [30_050] and [g[0] for g in got.pop(30_050)] == [30_000]
    asked = [i for i in ids if i % 50 == 0]
    assert sorted(got) == asked
    hits = 0
    for q in asked:
        score = neighbours.cosines(rows[q].astype(np.float32).astype(float)[None], x)[0]
        want = sorted((-round(s, 12), i) for s, i in zip(score, ids, strict=True) if i != q)[:5]
        assert [g[2] for g in got[q]] == [1, 2, 3, 4, 5]
        hits += len({i for _, i in want} & {g[0] for g in got[q]})
    assert hits >= 0.9 * 5 * len(asked)
    assert [g[0] for g in got[0]] == [10_000, 10_001, 10_002, 10_003, 10_004]
    assert neighbours.nearest(both.limit(0)).count() == 0


def test_neighbours_by_two_hashes(spark, monkeypatch):
    """Recall of the form for large tables, against brute force, is that of the form for small ones."""
    vectors = tables.read(spark, "/root/testdata/sf0.1", "embeddings").select("vec_id", "embedding")
    rows = {r["vec_id"]: r["embedding"] for r in vectors.collect()}
    ids = np.array(sorted(rows))
    x = np.array([rows[i] for i in ids], float)
    asked = ids[ids % 50 == 0]
    score = neighbours.cosines(x[ids % 50 == 0], x)
    score[asked[:, None] == ids[None, :]] = -2
    fifth = np.sort(score, axis=1)[:, -5]
    for cell_rows in (neighbours.CELL_ROWS, 1):
        monkeypatch.setattr(neighbours, "CELL_ROWS", cell_rows)
        got = neighbours.nearest(vectors).select("query_id", "score").toPandas()
        least = dict(zip(asked.tolist(), fifth.tolist(), strict=True))
        hits = sum(s >= least[q] - 1e-12 for q, s in zip(got.query_id, got.score, strict=True))
        print("recall", cell_rows, hits / (5 * len(asked)))
        assert len(got) == 5 * len(asked) and hits >= 0.9 * 5 * len(asked)


def test_neighbours_in_parts(spark, monkeypatch):
    """Hot cells cut into parts of rows and of queries give the same rows; copies of a direction tie by id."""
    rng = np.random.default_rng(4)
    base = rng.integers(-4, 5, (40, 16)).astype(float)
    x = [(int(k), (base[k % 40] * 2.0 ** (k // 40 % 3)).tolist()) for k in range(1200)]
    vectors = spark.createDataFrame(x, "vec_id bigint, embedding array<float>")
    whole = sorted(neighbours.nearest(vectors, every=5).collect())
    assert len(whole) == 5 * 240
    doubles = vectors.withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert sorted(neighbours.nearest(doubles, every=5).collect()) == whole
    monkeypatch.setattr(neighbours, "PART", 3)
    monkeypatch.setattr(neighbours, "QUERY_PART", 2)
    assert sorted(neighbours.nearest(vectors, every=5).collect()) == whole


def test_secrets(spark):
    rng = random.Random(8)
    key = lambda: "".join(rng.choices("0123456789abcdef", k=40))
    rows = [(k, f"some words here token = \"{key()}\" and more words") for k in range(40)]
    rows += [(100 + k, f"call {rng.randrange(10**17, 10**18)} or see 10.2.3.{k}.mail{k}.example.com words") for k in range(40)]
    docs = spark.createDataFrame([(i, t, None) for i, t in [*rows, *CASES]], "doc_id bigint, text string, path string")
    seen = Observation()  # a session with an observed query must not change anything
    docs.observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    found = secrets.secrets(docs).collect()
    assert {r["doc_id"] for r in found if r["secret"]} == set(range(40))
    assert secrets.secrets(docs.limit(0)).count() == 0


def test_secret_candidates():
    text = """password = "Tr0ub4dor&3", it\u2019s 'x' api_key: it's-me! author: Jane; secret => 'no digits here'\nauth: "open\nid 0123456789abcdef01 token=47853805923911234"""
    found = [text[a:b] for a, b in secrets.candidates(text)]
    assert found == ["Tr0ub4dor&3", "it", "no digits here", "open", "0123456789abcdef01", "47853805923911234"]
    assert secrets.candidates("") == [] and secrets.candidates("password: ") == []
    words = frozenset({"please", "change"})
    assert secrets.label("Tr0ub4dor&3", 'password = "', words) == 1
    assert secrets.label("on", "auth: ", words) is None
    assert secrets.label("please-change", "password: ", words) == 0


def test_secrets_without_their_names(spark):
    """A forest that sees only the values tells keys and passwords from numbers and addresses, also held-out ones."""
    rng = random.Random(9)
    signs = string.ascii_letters + string.digits + "!&$%#"
    rows = [(k, f'words password = "{"".join(rng.choices(signs, k=rng.randrange(9, 30)))}" words') for k in range(150)]
    rows += [(200 + k, f"call {rng.randrange(10**17, 10**18)} or see 10.2.3.{k}.mail{k}.example.com words") for k in range(150)]
    clash = "doc_id bigint, text string, path string, label int, features string, probability double, h bigint"
    docs = spark.createDataFrame([(i, t, "p", 0, "x", 0.1, 1) for i, t in [*rows, *CASES]], clash)
    got = {r["context"]: r for r in secrets.quality(docs).collect()}
    for context in ("shown", "hidden"):
        assert got[context]["precision"] >= 0.95 and got[context]["recall"] >= 0.95, got
        assert got[context]["findings"] > 50
    assert {r["doc_id"] for r in secrets.secrets(docs).collect() if r["secret"]} == set(range(150))
    assert secrets.quality(docs.limit(0)) is None


def test_secret_dictionary(spark, monkeypatch):
    """The most frequent words, ties by spelling, however the histogram cuts them."""
    rng = random.Random(2)
    texts = [" ".join("word" + "abcdefghij"[min(9, int(rng.expovariate(0.5)))] * rng.randrange(1, 4) for _ in range(40)) for _ in range(20)]
    counts = collections.Counter(w for t in texts for w in t.split())
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    best = sorted(counts, key=lambda w: (-counts[w], w))
    for size in (1, 5, 12, 1000):
        assert secrets.dictionary(docs, size) == frozenset(best[:size])


def brute_lines(rows, similarity=0.8):
    places = collections.defaultdict(list)
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            if line.strip():
                places[line].append((i, k))
    keys = list(places)
    sets = [{x[k : k + lines.SHINGLE] for k in range(max(1, len(x) - lines.SHINGLE + 1))} for x in keys]
    links = [(a, b) for a in range(len(keys)) for b in range(a) if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]
    root = unite(len(keys), links)
    members = collections.defaultdict(list)
    for k, x in enumerate(keys):
        members[root[k]] += places[x]
    return {p: min(m) for m in members.values() for p in m if p != min(m)}


def test_lines(spark):
    rng = random.Random(9)
    line = lambda: " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(rng.randrange(1, 30)))
    base = [line() for _ in range(40)]
    near = [x[:-3] + rng.choice("xyz") for x in base if len(x) > 60]
    rows = [(k, "\n".join(rng.choices(base + near, k=3) + [line()])) for k in range(60)] + [(200, ""), (201, "\n \n")]
    got = {(r["doc_id"], r["line_no"]): (r["kept_doc_id"], r["kept_line_no"]) for r in lines.line_copies(tables.texts(odd(spark, rows))).collect()}
    want = brute_lines(rows)
    assert got == want
    edited = {r["doc_id"]: r["text"] for r in lines.without_copies(odd(spark, rows)).collect()}
    for i, text in rows:
        left = [x for k, x in enumerate(text.split("\n")) if (i, k) not in want]
        gone = any(d == i for d, _ in want)
        assert edited.get(i) == ("\n".join(left) if any(map(str.strip, left)) or not gone else None)
    case = lines.without_copies(odd(spark, CASES))
    assert case.columns == odd(spark, CASES).columns
    assert lines.line_copies(tables.texts(odd(spark, CASES).limit(0))).count() == 0


def test_lines_of_texts_with_one_id(spark):
    """Texts that share an id, or have none, lose their own lines only."""
    texts = ["a line\nb line", "b line\nc line", "b line\nc line"]
    for i in (None, 7):
        left = [r["text"] for r in lines.without_copies(odd(spark, [(i, t) for t in texts])).collect()]
        assert sorted(left) in (["a line", *texts[1:]], [texts[0], "c line", "c line"])
        assert {x for t in left for x in t.split("\n")} == {"a line", "b line", "c line"}
        assert lines.line_copies(tables.texts(odd(spark, [(i, t) for t in texts]))).count() in (1, 2)


def test_lines_in_large_buckets(spark):
    """Lines that share a passage but are not alike, among others that are."""
    rng = random.Random(10)
    text = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
    shared = text(120)
    rows = [(k, shared + text(60)) for k in range(40)] + [(100 + k, rows_text[:-1] + "#") for k, rows_text in enumerate([shared + text(60) for _ in range(3)])]
    rows += [(200 + k, rows[k][1][:-2] + "##") for k in range(20)]
    got = {(r["doc_id"], r["line_no"]): (r["kept_doc_id"], r["kept_line_no"]) for r in lines.line_copies(tables.texts(odd(spark, rows))).collect()}
    assert got == brute_lines(rows)


def template_lines(size, copies, field=28):
    """Lines of one template with a varying field, pairwise just under the threshold, and near copies of some."""
    rng = random.Random(12)
    text = lambda n: "".join(chr(0x4E00 + rng.randrange(4000)) for _ in range(n))
    shared = text(207)
    base = [shared + text(field) for _ in range(size)]
    return base + [x[:-2] + "##" for x in base[:copies]]


@pytest.mark.parametrize("field", [28, 29, 33])
def test_line_blocks(field, monkeypatch):
    """Every near copy is joined, and nothing else: background similarity 0.75 to 0.78."""
    monkeypatch.setattr(lines, "COLUMNS", 512)
    rows = template_lines(300, 60, field)
    sets = [{x[k : k + lines.SHINGLE] for k in range(len(x) - lines.SHINGLE + 1)} for x in rows]
    assert 0.75 < len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.8
    want = grouped((min(k, k - 300 if k >= 300 else k), k) for k in range(360))
    root = list(range(360))
    for u, v in zip(*lines.joined(rows, None, 0.8), strict=True):
        root[u] = int(v)
    assert grouped((root[k], k) for k in range(360)) == want
    across = lines.joined(rows[:300], rows[300:], 0.8)
    assert sorted(zip(*(x.tolist() for x in across), strict=True)) == [(300 + k, k) for k in range(60)]


def test_lines_of_a_template(spark):
    rows = list(enumerate(template_lines(2000, 200)))
    got = {r["doc_id"]: r["kept_doc_id"] for r in lines.line_copies(tables.texts(odd(spark, rows))).collect()}
    assert got == {2000 + k: k for k in range(200)}


def test_lines_without_python(spark, monkeypatch):
    """No stage of line dedup runs Python, large torn buckets included, and the links are those of brute force."""
    plans, settle = {}, lines.settle

    def seen(rows, name="settled"):
        plans[name] = plans.get(name, "") + rows._jdf.queryExecution().executedPlan().toString()
        return settle(rows, name)

    monkeypatch.setattr(lines, "settle", seen)
    monkeypatch.setattr(components, "settle", seen)
    monkeypatch.setattr(lines, "BLOCK", 16)
    rows = list(enumerate([*template_lines(90, 20), "odd é𝄞 line of its own", "abc", "abc\0", "", "odd é𝄞 line of its own"]))
    found = lines.line_copies(tables.texts(odd(spark, rows)))
    plans["result"] = found._jdf.queryExecution().executedPlan().toString()
    assert {(r["doc_id"], r["line_no"]): (r["kept_doc_id"], r["kept_line_no"]) for r in found.collect()} == brute_lines(rows)
    assert {"signed", "verified", "met", "edges"} <= set(plans)
    assert not [n for n, p in plans.items() if any(x in p for x in ("Python", "Pandas", "Arrow"))]


def test_line_pairs_that_come_out(spark, monkeypatch):
    """Of a large torn bucket only links come out, no more than it has lines, however many pairs are near or similar."""
    written, settle = collections.Counter(), lines.settle

    def seen(rows, name="settled"):
        found = settle(rows, name)
        written[name] += found.count()
        return found

    monkeypatch.setattr(lines, "settle", seen)
    rng = random.Random(4)
    text = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
    base, near = text(300), template_lines(80, 10)
    for _ in range(80):
        at = rng.sample(range(0, 300, 20), rng.randrange(1, 6))
        near.append("".join(text(6) + base[k + 6 : k + 20] if k in at else base[k : k + 20] for k in range(0, 300, 20)))
    rows = list(enumerate(near))
    got = {(r["doc_id"], r["line_no"]): (r["kept_doc_id"], r["kept_line_no"]) for r in lines.line_copies(tables.texts(odd(spark, rows))).collect()}
    assert got == brute_lines(rows) and len(got) > 40
    assert 0 < written["met"] <= len(rows)


@pytest.mark.parametrize("words", [16, 64])
def test_line_sketches_against_sets(spark, words):
    """Sketches rule out no similar pair, and pairs are as similar as their shingle sets."""
    rng = random.Random(3)
    left = ["".join(rng.choice("abcd é𝄞\0") for _ in range(rng.randrange(1, 60 if k % 9 else 900))) for k in range(300)] + ["abc", "a"]
    right = [x[:5] + rng.choice(["", "x"]) + x[5:] for x in left[:-2]] + ["abc\0", "a"]
    want = [alike for some in lines._chunks(left, right) for alike in lines.similar(left[some], right[some], 0.8).tolist()]
    hashed = "line", "xxhash64(line) AS h1", "xxhash64(1, line) AS h2"
    texts = spark.createDataFrame([(x,) for x in set(left + right)], "line string").selectExpr(*hashed)
    sketches = texts.join(lines._sketched(texts, words), ["h1", "h2"])
    one, other = lines._ends(sketches, "line", "n", *(f"s{k}" for k in range(words)))
    pairs = spark.createDataFrame(list(zip(range(len(left)), left, right, strict=True)), "k int, a_line string, b_line string")
    both = pairs.join(one, "a_line").join(other, "b_line")
    for near in (None, lines._near("a_", "b_", words, 0.8)):
        got = {r["k"]: r["alike"] for r in lines._alike(both, near, 0.8, "k").collect()}
        assert [got[k] for k in range(len(left))] == want and 0 < sum(want) < len(want)
    far = lines._near("a_", "b_", words, 0.8)
    assert one.crossJoin(other).filter(~far).count() > 0
    bands = {(r["h1"], r["h2"]): r["bands"] for r in lines.banded(texts.unionAll(texts)).collect()}
    assert len(bands) == texts.count() and all(bands.values())


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash_dedup", "decontamination", "byte_bpe"]
    docs = tables.read(spark, SF, "documents")
    for stage in list(stages.values())[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = corpus_pipeline.settle(out)
    kept = {r["doc_id"] for r in docs.collect()}
    assert {r["doc_id"] for r in rows} == kept and len(rows) == len(kept)
    fingerprints = [simhash.fingerprint(r["text"]) for r in docs.collect()]
    apart = np.bitwise_count(np.array(fingerprints)[:, None] ^ np.array(fingerprints)[None, :])
    assert (apart + 64 * np.eye(len(apart)) > 2).all()
    assert not brute_lines([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_reply_trees_sql(spark):
    import check

    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    assert "pipeline" in entry.queries() and "op4_reply_trees" in entry.oracle_sql()
    assert check.compare(spark, check.connect(sf), "op4_reply_trees", sf) == ""


@pytest.mark.parametrize("size", [1, 500, 1 << 16])
def test_line_pairs_against_sets(size):
    rng = random.Random(3)
    left = ["".join(rng.choice("abcd é𝄞\0") for _ in range(rng.randrange(60))) for _ in range(300)] + ["", "abc"]
    right = [x[:5] + rng.choice(["", "x"]) + x[5:] for x in left[:-2]] + ["", "abc\0"]
    sets = [[{x[k : k + lines.SHINGLE] for k in range(max(1, len(x) - lines.SHINGLE + 1))} for x in side] for side in (left, right)]
    want = [len(a & b) >= 0.8 * len(a | b) for a, b in zip(*sets, strict=True)]
    got = [alike for some in lines._chunks(left, right, size=size) for alike in lines.similar(left[some], right[some], 0.8)]
    assert got == want and 0 < sum(want) < len(want)
    place, band = lines.signatures(left)
    twice, same = lines.signatures(left * 2)
    assert band.tolist() * 2 == same.tolist() and set(place) == set(range(len(left)))
    assert list(lines._chunks([])) == []
