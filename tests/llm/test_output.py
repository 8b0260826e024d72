"""Records, resampling and infilling against plain versions, and on odd input."""

from __future__ import annotations

import collections
import hashlib
import io
import math
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from logweft.llm import infill, records, resample, tables
from logweft.sources.scratch import new_folder
from test_operators import CASES, LONG, SF, odd
from tokenizers import Tokenizer

import check

PATH = public_tokenizers.path("word_bpe_49k.json")
ASCII_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    tables.ship(spark)


# Records


def crc32c(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def masked(data: bytes) -> int:
    crc = crc32c(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def test_checksums():
    assert crc32c(b"123456789") == 0xE3069283
    rng = random.Random(1)
    runs = [rng.randbytes(n) for n in (4, 5, 63, 64, 65, 128, 1, 700, 64, 4) if n >= 4]
    got = records.checksums(np.frombuffer(b"".join(runs), np.uint8), np.cumsum(list(map(len, runs))))
    assert got.tolist() == [masked(r) for r in runs]
    frame = records.framed([runs[2]])
    head = struct.pack("<Q", 63)
    assert frame == head + struct.pack("<I", masked(head)) + runs[2] + struct.pack("<I", masked(runs[2]))
    assert records.END == bytes(8) + struct.pack("<II", masked(bytes(8)), masked(b""))


def test_records_as_the_library(spark):
    tokenizer = Tokenizer.from_file(PATH)
    rows = [(r["doc_id"], r["text"] or "") for r in tables.read(spark, SF, "documents").collect()]
    want, start = [], 0
    for name, text in sorted(rows):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        want.append((name, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, records.op11_records(spark, SF).collect())) == want


HARD = [
    "", " ", "  two  spaces ", "a\nb\n\nc", "tab\tand no-break em", "nul \0 in\0side \0\0", "\0", "é x ́y H̱ ẖ",
    "ΣΣ İ", "it's we'll 'S", "<|endoftext|> <|startoftext|>a", "\x1c\x1d\x85z \x0b\x0c", "\U0001f600 \U0001f468‍\U0001f469", "1234 x9y", "   q",
]


def test_encoder_on_hard_words():
    tokenizer, rng = Tokenizer.from_file(PATH), random.Random(2)
    signs = [*"abZ  \n\n.,'\0", "́", "̱", " ", " ", "\x1c", "\t", "ẞ", "\U0001f600"]
    texts = HARD + ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(300)]
    want = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 7], "<u2").tobytes() for t in texts]
    for _ in range(2):  # the second time, all words are remembered
        assert records.encoded(pa.array(texts), PATH, 7) == want
    assert records.encoded(pa.array(["cut off", *texts]).slice(1), PATH, 7) == want


def test_encoder_in_pieces(monkeypatch):
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["word " * 300, "x" * 900, "", " a b" * 100]
    want = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u2").tobytes() for t in texts]
    monkeypatch.setattr(records, "PIECE", 37)
    monkeypatch.setattr(records, "REMEMBERED", 2)
    assert records.encoded(pa.array(texts), PATH, 1) == want
    assert records.encoded(pa.array([], pa.string()), PATH, 1) == []


def test_records_on_odd_input(spark):
    folder = new_folder(spark, "records")
    records.write(odd(spark, CASES), folder, PATH, 1)
    index = records.build_index(spark, folder)
    rows = sorted(index.collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, None, 1, 2, 3, 4, 4, 5, 6, 7]
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1].tolist()
    tokenizer = Tokenizer.from_file(PATH)
    texts = collections.defaultdict(list)
    for name, text in CASES:
        texts[name].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    shards = {f["path"].rsplit("/", 1)[1]: bytes(f["content"]) for f in spark.read.format("binaryFile").load(f"{folder}/records").collect()}
    order = records.shuffled(index, 3).collect()
    assert sorted(order, key=str) == sorted(rows, key=str) and [r["start"] for r in order] != [r["start"] for r in rows]
    for r in order:
        name, ids = records.record_at(io.BytesIO(shards[r["shard"]]), r["offset"], r["size"])
        assert name == r["doc_id"] and ids.tolist() in texts[name]
    for shard, data in shards.items():
        assert [records.unpacked(p)[0] for _, p in records.parsed(data)] == [r["doc_id"] for r in rows if r["shard"] == shard]
        for bad in (data[: -len(records.END)], data[:40] + bytes([data[40] ^ 1]) + data[41:], data[:-1]):
            if len(data) > 60:
                with pytest.raises(ValueError):
                    list(records.parsed(bad))
    empty = new_folder(spark, "records")
    records.write(odd(spark, CASES).limit(0), empty, PATH, 1)
    assert records.build_index(spark, empty).count() == 0


# Resampling


def plain_features(text):
    found = WORD.findall((text or "").translate(ASCII_LOW))
    codes = [zlib.crc32(w.encode()) for w in found] + [zlib.crc32(f"{a} {b}".encode()) for a, b in zip(found, found[1:], strict=False)]
    return len(found), [c % 10_000 for c in codes]


def plain_resampling(docs, bench):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text), ids without ties and nulls."""
    found = [(name, *plain_features(text)) for name, text in docs]
    s, t = collections.Counter(), collections.Counter()
    for _, _, f in found:
        s.update(f)
    for text in bench:
        t.update(plain_features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in range(10_000)]
    rows, able = {}, []
    for name, n, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{name}".encode()).hexdigest()[:8], 16)
        rows[name] = [len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        able += [name] if n >= 20 else []
    able.sort(key=lambda d: (-rows[d][2], d))
    for rank, name in enumerate(able[: 25 * len(able) // 100], 1):
        rows[name][3] = rank
    return sorted((name, *row) for name, row in rows.items())


def test_resampling(spark):
    docs = [(r["doc_id"], r["text"]) for r in tables.read(spark, SF, "documents").collect()]
    bench = [r["text"] for r in tables.read(spark, SF, "benchmark").collect()]
    got = sorted(map(tuple, resample.op12_resample(spark, SF).collect()))
    assert got == plain_resampling(docs, bench)
    assert any(r[4] for r in got) and not all(r[4] for r in got)


def test_features_in_pieces(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices("aB9 .é́\n\x7f_", k=n)) for n in (0, 1, 30, 200, 200)] + ["x" * 500, "Aİ \U0001f600 b"]
    whole = [(n, sorted(f)) for n, f in map(plain_features, texts)]
    for piece in (1, 7, 1 << 18):
        monkeypatch.setattr(resample, "PIECE", piece)
        assert [(n, sorted(f.tolist())) for n, f in map(resample.features, texts)] == whole
    n, one = resample.features("a b a", run=1)
    assert (n, len(one)) == (3, 3) and len(resample.features("a b c d", run=3)[1]) == 9


def test_resampling_on_odd_input(spark):
    bench = spark.createDataFrame([(1, "the tion ing"), (2, None), (None, "")], "item_id bigint, text string")
    words = " ".join(f"w{k}" for k in range(25))
    rows = odd(spark, [*CASES, (8, words), (8, words), (None, words), (9, words)])
    found = resample.resampled(rows, bench, drawn=100).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(d) for d, _ in [*CASES, (8, 0), (8, 0), (None, 0), (9, 0)])
    ranks = {r["rank"]: r for r in found if r["rank"]}
    assert sorted(ranks) == [1, 2, 3, 4, 5]  # the long text and the four of 25 words
    assert [r["score"] for _, r in sorted(ranks.items())] == sorted((r["score"] for r in ranks.values()), reverse=True)
    assert len({(r["score"], r["weight"]) for r in found if r["doc_id"] == 8}) == 1
    assert all(r["weight"] == 0 and r["n_features"] == 0 for r in found if r["doc_id"] in (1, 2, 3))
    assert resample.resampled(rows.limit(0), bench).count() == 0
    assert resample.resampled(rows, bench.limit(0)).count() == len(found)


def test_ranks_over_slices(spark):
    rng = random.Random(6)
    rows = [(rng.choice([None, *range(50)]), rng.randrange(5)) for _ in range(2000)] + [(7, 3)] * 1000
    got = resample.ranked(spark.createDataFrame(rows, "doc_id bigint, score bigint").repartition(7)).collect()
    want = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    assert [(r["doc_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 3001))


# Infilling


def plain_infilling(name, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if name is None else name}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return len(units), "plain", text, None, None
    if h[3] % 100 < 20:
        return len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def infilled(rows):
    made = infill.infilled(tables.texts(rows))
    return made.select("doc_id", "text", "n", "form", "output", *infill.sizes(), infill.restored().alias("restored")).collect()


def test_infilling(spark):
    assert check.compare(spark, check.connect(SF), "op13_infill", SF) == ""


def test_infilling_on_odd_input(spark, monkeypatch):
    rng = random.Random(8)
    signs = [*"abcXYZ   \n<<>PSM$\\1{}", "é", "\U0001f600", "\r", " ", "\0"]
    rows = [(k, "".join(rng.choices(signs, k=rng.randrange(60)))) for k in range(300)] + [(k, t) for k, t in enumerate(["<P>", "a<S>b", "x<M>", "<", "<P", "S>", "$1"], 1000)]
    rows += [*CASES, (2000, "letters" * 30_000), (2001, LONG), *((3000 + k, "ab <c> $d") for k in range(100))]
    for piece in (1 << 20, 3):
        monkeypatch.setattr(infill, "PIECE", piece)
        some = rows if piece > 3 else [r for r in rows if len(r[1] or "") < 1000]
        got = infilled(odd(spark, some))
        assert len(got) == len(some)
        for r in got:
            assert (r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"]) == plain_infilling(r["doc_id"], r["text"])
            assert r["restored"] == r["text"]
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert infilled(odd(spark, CASES).limit(0)) == []
