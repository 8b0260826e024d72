"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A record is framed as TFRecord files frame it: its length in eight bytes, the masked CRC-32C of these, the
payload, and the masked CRC-32C of the payload, all little-endian.  A payload is the document's id in
eight bytes, a byte that is 1 for a null id, a byte with the width of a token id (2 where the vocabulary
has at most 65,536 ids, else 4), and the ids.  Frames are gathered into blocks of about ``BLOCK`` bytes.
An empty record closes each block; readers skip it, and a shard that does not end with one was cut off.

Documents are range-sorted by id, so each task writes the next stretch of the order, and shards, taken
by task and number, hold ascending ids.  Blocks leave through Spark's own text writer, whose line end is
set to that empty record: shards reach any store that Spark writes to, and only those of finished tasks
count.  Reading back hops from length to length and verifies both checksums; that gives the index, which
is a table of its own.  It could be made again from the shards at any time.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweft.llm import tables
from logweft.sources.scratch import new_folder, settle

#: Bytes of a block, and blocks of a shard.
BLOCK, SHARD = 1 << 20, 16
#: Bytes of texts that are encoded at a time.
PIECE = 1 << 23
#: Words whose ids a worker remembers, a bound on its memory.
REMEMBERED = 2_000_000
#: Words that are encoded in a call.
CALL = 1 << 14
#: The reflected Castagnoli polynomial and the constant of the mask.
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8
#: Bytes that the checksums of many runs go through in step.
LINE = 64
HEAD = "<qBB"
HEAD_SIZE = struct.calcsize(HEAD)


def _table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


TABLE = _table()


def _ahead(state: np.ndarray) -> np.ndarray:
    """Checksum states after ``LINE`` zero bytes.  This is linear, so four tables do it for any state."""
    return _AHEAD[0][state & 255] ^ _AHEAD[1][(state >> 8) & 255] ^ _AHEAD[2][(state >> 16) & 255] ^ _AHEAD[3][state >> 24]


def _far_tables() -> list[np.ndarray]:
    tables_ = []
    for k in range(4):
        state = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(LINE):
            state = TABLE[state & 255] ^ (state >> 8)
        tables_.append(state)
    return tables_


_AHEAD = _far_tables()


def checksums(data: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Masked CRC-32C of each run of the bytes ``data``; a run ends at each of ``stops`` and has 4 bytes or more.

    Runs are set flush right in lines of ``LINE`` bytes.  All lines go forward byte by byte together, and
    then the lines of each run are put together.
    """
    starts = np.r_[0, stops[:-1]].astype(np.int64)
    sizes = stops - starts
    lines = -(-sizes // LINE)
    last = np.cumsum(lines)
    shift = last * LINE - stops
    rows = np.zeros(int(last[-1]) * LINE if len(last) else 0, np.uint8)
    rows[np.repeat(shift, sizes) + np.arange(len(data))] = data
    rows[((starts + shift)[:, None] + np.arange(4)).ravel()] ^= 255  # a start from all ones
    state = np.zeros(len(rows) // LINE, np.uint32)
    for column in np.ascontiguousarray(rows.reshape(-1, LINE).T):
        state = TABLE[(state ^ column) & 255] ^ (state >> 8)
    total = state[last - lines]
    for k in range(1, int(lines.max(initial=0))):
        more = np.flatnonzero(lines > k)
        total[more] = _ahead(total[more]) ^ state[(last - lines)[more] + k]
    return masked(~total)


def masked(crc: np.ndarray) -> np.ndarray:
    crc = np.asarray(crc, np.uint32)
    return ((crc >> 15) | (crc << 17)) + np.uint32(MASK)


def framed(payloads: list[bytes]) -> bytes:
    """Frames of ``payloads``, which have 4 bytes or more."""
    sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
    heads = sizes.astype("<u8").tobytes()
    of_heads = checksums(np.frombuffer(heads, np.uint8), np.arange(8, len(heads) + 1, 8)).astype("<u4").tobytes()
    of_bodies = checksums(np.frombuffer(b"".join(payloads), np.uint8), np.cumsum(sizes)).astype("<u4").tobytes()
    parts = []
    for k, payload in enumerate(payloads):
        parts += [heads[8 * k : 8 * k + 8], of_heads[4 * k : 4 * k + 4], payload, of_bodies[4 * k : 4 * k + 4]]
    return b"".join(parts)


#: The frame of an empty record.
END = bytes(8) + checksums(np.zeros(8, np.uint8), np.array([8])).astype("<u4").tobytes() + masked(np.zeros(1)).astype("<u4").tobytes()


class Encoder:
    """A tokenizer file of the tokenizers library whose pre-tokens hold no white space.

    The names of special tokens in a text are read as the library reads them by default.  As no pre-token
    goes beyond a space, a text's ids are those of the words between its spaces and line ends, in order.
    Of a batch, distinct words are looked up among those already seen, which are two Arrow arrays, and
    the others are encoded, many in a call.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.type = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.width = np.dtype(self.type).itemsize
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        #: For each id, whether it ends a pre-token, and whether it is that of a NUL, which no other word has.
        self.closes, self.marks = np.zeros((2, max(vocabulary.values()) + 1), bool)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closes[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        mark = self._ids("\0")
        self.marks[mark[:1]] = len(mark) == 1
        self._forget()

    def _forget(self) -> None:
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.binary())

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type)

    def _cut(self, words: list[str], glue: str, ends: np.ndarray, keep: int) -> list[bytes] | None:
        """Packed ids of ``words``, encoded as one text with ``glue`` between them.

        ``ends`` says for each id whether it ends a word; ``keep`` is 1 if it belongs to the word.  None if
        there are not as many ends as words.
        """
        found: list[bytes] = []
        for at in range(0, len(words), CALL):
            some = words[at : at + CALL]
            joined = glue.join(some) + glue
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.type)
            last = np.flatnonzero(ends[ids])
            if len(last) != len(some):
                return None
            starts = (np.r_[0, last[:-1] + 1] * self.width).tolist()
            packed = ids.tobytes()
            found += [packed[a:b] for a, b in zip(starts, ((last + keep) * self.width).tolist(), strict=True)]
        return found

    def _called(self, words: list[str]) -> list[bytes]:
        """Packed ids of each of ``words``, as the tokenizer gives them."""
        found: dict[int, bytes] = {}
        # A word of letters alone is one pre-token, and the id that ends it says so.
        letters = [k for k, w in enumerate(words) if w.isalpha() and (w.isascii() or max(w) < "\u0100")] if self.closes.any() else []
        ids = self._cut([words[k] for k in letters], " ", self.closes, 1)
        if ids is not None:
            found = dict(zip(letters, ids, strict=True))
        # Others are set apart by a NUL, if that is one id and not in them.
        rest = [k for k, w in enumerate(words) if k not in found and "\0" not in w] if self.marks.any() else []
        ids = self._cut([words[k] for k in rest], " \0 ", self.marks, 0)
        if ids is not None:
            found |= zip(rest, ids, strict=True)
        return [found[k] if k in found else self._ids(w).tobytes() for k, w in enumerate(words)]

    def _learned(self, words: list[str]) -> list[bytes]:
        """Packed ids of each of ``words``.

        Full stops and commas after an ASCII letter or digit are pre-tokens of their own, and words of
        those alone do not differ by their case, so many words are made of others.
        """
        parts = []
        for word in words:
            stem = word.rstrip(".,")
            if len(stem) == len(word) or not (stem and stem[-1].isascii() and stem[-1].isalnum()):
                stem = word
            parts.append((stem.lower() if stem.isascii() and stem.isalnum() else stem, word[len(stem) :]))
        names = list(dict.fromkeys(name for part in parts for name in part))
        ids = dict(zip(names, self._called(names), strict=True))
        return [ids[stem] + ids[tail] for stem, tail in parts]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Packed ids of each of ``texts``."""
        if len(self.words) > REMEMBERED:
            self._forget()
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        place = pc.index_in(coded.dictionary, value_set=self.words)
        new = coded.dictionary.filter(place.is_null())
        at = place.fill_null(-1).to_numpy(zero_copy_only=False).copy()
        at[at < 0] = len(self.words) + np.arange(len(new))
        self.ids = pa.concat_arrays([self.ids, pa.array(self._learned(new.to_pylist()), pa.binary())])
        self.words = pa.concat_arrays([self.words, new])
        own = self.ids.take(pa.array(at)).cast(pa.large_binary())
        ids = own.take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[: len(ids) + 1]
        stops = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        packed = ids.buffers()[2]
        packed = packed.to_pybytes() if packed else b""
        return [packed[a:b] for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)


def _parts(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of runs of rows of up to ``PIECE`` bytes; a longer text comes in parts, cut at spaces."""
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = upto[start - 1] if start else 0
        stop = int(np.searchsorted(upto, before + PIECE, "right"))
        if stop > start:
            yield start, texts.slice(start, stop - start)
            start = stop
            continue
        text, cut = texts[start].as_py(), 0
        while cut >= 0:
            seam = text.find(" ", cut + PIECE)
            yield start, pa.array([text[cut : seam if seam >= 0 else len(text)]], pa.string())
            cut = seam + 1 if seam >= 0 else -1
        start += 1


def encoded(texts: pa.Array, path: str, end_id: int) -> list[bytes]:
    """Packed ids of each of ``texts``, ``end_id`` last."""
    own = encoder(path)
    found: list[list[bytes]] = [[] for _ in range(len(texts))]
    for start, some in _parts(texts):
        for k, ids in enumerate(own.encode(some)):
            found[start + k].append(ids)
    end = np.array([end_id], own.type).tobytes()
    return [b"".join([*ids, end]) for ids in found]


def write(docs: DataFrame, folder: str, path: str, end_id: int) -> None:
    """Write the shards of ``docs`` (doc_id, text) to ``folder``.

    Null texts are empty; an empty text has the end id alone.  Null ids come first; rows that share an id
    come in the order of their texts' hashes, and rows alike in both are spread like any others.  An
    empty table gives no record.  A long text is encoded in parts, cut at spaces.
    """
    tables.ship(docs.sparkSession)
    order = ["doc_id", "text_hash", "place"]
    rows = tables.texts(docs).withColumns({"text_hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = encoder(path).width
        held: list[bytes] = []
        size = 0
        for batch in tables.slices(batches, 4096):
            names = batch.column("doc_id").to_pylist()
            for name, ids in zip(names, encoded(batch.column("text"), path, end_id), strict=True):
                held.append(struct.pack(HEAD, name or 0, name is None, width) + ids)
                size += len(held[-1])
                if size >= BLOCK:
                    yield pa.RecordBatch.from_arrays([pa.array([framed(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([framed(held)], pa.binary())], ["value"])

    blocks = ordered.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    writer = blocks.write.option("lineSep", END.decode("latin-1")).option("encoding", "ISO-8859-1")
    writer.option("maxRecordsPerFile", SHARD).option("compression", "none").text(f"{folder.rstrip('/')}/records")


def parsed(data: bytes, shard: str = "") -> Iterator[tuple[int, bytes]]:
    """(offset, payload) of the records of one shard, empty ones left out; ValueError if anything is amiss."""
    spans, at = [], 0
    view = memoryview(data)

    def verified() -> Iterator[tuple[int, bytes]]:
        payloads = [bytes(view[a + 12 : a + 12 + n]) for a, n in spans]
        want = framed(payloads) if payloads else b""
        got = b"".join(view[a : a + 16 + n] for a, n in spans)
        if got != want:
            raise ValueError(f"checksum of a record of {shard}")
        yield from zip((a for a, _ in spans), payloads, strict=True)

    held, closed = 0, True
    while at < len(data):
        if view[at : at + len(END)] == END:
            at, closed = at + len(END), True
            continue
        size = int.from_bytes(view[at : at + 8], "little")
        if size < HEAD_SIZE or at + 16 + size > len(data):
            raise ValueError(f"length of the record at {at} of {shard}")
        spans.append((at, size))
        at, held, closed = at + 16 + size, held + size, False
        if held >= BLOCK:
            yield from verified()
            spans, held = [], 0
    if not closed:
        raise ValueError(f"{shard} ends without an empty record")
    yield from verified()


def unpacked(payload: bytes) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of a record."""
    name, null, width = struct.unpack_from(HEAD, payload)
    return None if null else name, np.frombuffer(payload, f"<u{width}", offset=HEAD_SIZE)


def record_at(file, offset: int, size: int) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of the record whose frame of ``size`` bytes begins at ``offset`` of an open shard."""
    file.seek(offset)
    frame = file.read(size)
    payload = frame[12:-4]
    if len(frame) != size or framed([payload]) != frame:
        raise ValueError(f"record at {offset}")
    return unpacked(payload)


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, task, number, offset, size, doc_id, start, n_tokens, ids_crc32) of each record in ``folder``.

    ``start`` counts ids from the start of the shard.  Each shard is read whole, of ``SHARD`` blocks, and
    every checksum verified.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.slices(batches, 1):
            shard = batch.column("path")[0].as_py().rsplit("/", 1)[1]
            task, number = map(int, re.match(r"part-(\d+)-.*-c(\d+)", shard).groups())
            rows, start = [], 0
            for offset, payload in parsed(batch.column("content")[0].as_py(), shard):
                name, ids = unpacked(payload)
                rows.append((offset, len(payload) + 16, name, start, len(ids), crc32(ids.astype("<u4").tobytes())))
                start += len(ids)
            own = [pa.array([v] * len(rows), t) for v, t in ((shard, pa.string()), (task, pa.int64()), (number, pa.int64()))]
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 6)]
            yield pa.RecordBatch.from_arrays([*own, *columns], names)

    names = ["shard", "task", "number", "offset", "size", "doc_id", "start", "n_tokens", "ids_crc32"]
    files = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/records").select("path", "content")
    return files.mapInArrow(run, "shard string, " + ", ".join(f"{n} bigint" for n in names[1:]))


def build_index(spark: SparkSession, folder: str) -> DataFrame:
    """Write and return the offset index: ``scan`` with ``start`` counted over all shards.

    What is summed in one task is a row for each shard.
    """
    found = settle(scan(spark, folder), "found")
    before = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)
    shards = found.groupBy("task", "number").agg(F.sum("n_tokens").alias("ids"))
    offsets = shards.select("task", "number", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    rows = found.join(offsets, ["task", "number"]).withColumn("start", F.col("start") + F.col("before"))
    path = f"{folder.rstrip('/')}/index"
    columns = ["doc_id", "shard", "offset", "size", "start", "n_tokens", "ids_crc32"]
    rows.select(columns).write.parquet(path)
    return spark.read.schema(rows.select(columns).schema).parquet(path)


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """The rows of an index in a random order that depends on ``seed`` alone."""
    return index.orderBy(F.xxhash64(F.lit(seed), "start"), "start")


def op11_records(spark, sf_dir):
    import public_tokenizers

    folder = new_folder(spark, "records")
    write(tables.read(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), 1)
    return build_index(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
