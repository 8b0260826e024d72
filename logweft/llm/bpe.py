"""Byte-level BPE by monoid tree reduction.

A pre-token is cut in halves down to short leaves; leaves are merged by rank, and neighbours are joined by
merging a window across the seam again.  The window grows until its first token is the left side's
and its last token the right side's.  Then the tokens outside stand: a token sequence is the encoding of
its bytes exactly if each two adjacent tokens are the encoding of theirs, the pairs outside the window
have not changed, and those inside come from one encoding.  Decoding concatenates up the same tree.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweft.llm import tables

#: Bytes of a leaf, merged at once.
LEAF = 24
#: Characters of a text that are split into pre-tokens at a time.
PIECE = 1 << 18
#: Pre-tokens whose ids a worker remembers, twice over at most, a bound on its memory.
REMEMBERED = 500_000
#: Where a text may be cut without cutting a pre-token: before a single space between other characters.
SEAM = regex.compile(r"(?<=\S)(?= \S)")


class Codec(dict):
    """Encoder and decoder of one rank file, and the packed ids, as little-endian unsigned 32-bit integers,
    of the pre-tokens it has met."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks = ranks
        self.packed = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())
        self.find = regex.compile(pattern).findall
        self.before: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str, pattern: str) -> Codec:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return cls(ranks, pattern)

    def merge(self, piece: bytes) -> list[bytes]:
        """Merge the pair of least rank, leftmost first, until no pair is a token."""
        rank, none = self.ranks.get, len(self.tokens)
        cuts = list(range(len(piece) + 1))
        pairs = [rank(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs and (least := min(pairs)) < none:
            at = pairs.index(least)
            del pairs[at], cuts[at + 1]
            if at:
                pairs[at - 1] = rank(piece[cuts[at - 1] : cuts[at + 1]], none)
            if at < len(pairs):
                pairs[at] = rank(piece[cuts[at] : cuts[at + 2]], none)
        return [piece[i:j] for i, j in pairwise(cuts)]

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            seam = self.merge(b"".join(left[len(left) - i :] + right[:j]))
            still_left = i == len(left) or seam[0] == left[-i]
            still_right = j == len(right) or seam[-1] == right[j - 1]
            if still_left and still_right:
                return left[: len(left) - i] + seam + right[j:]
            i, j = (i if still_left else 2 * i), (j if still_right else 2 * j)

    def reduce(self, piece: bytes) -> list[bytes]:
        if len(piece) <= LEAF:
            return self.merge(piece)
        half = len(piece) // 2
        return self.join(self.reduce(piece[:half]), self.reduce(piece[half:]))

    def __missing__(self, pre_token: str) -> bytes:
        found = self.before.get(pre_token)
        if found is None:
            piece = pre_token.encode()
            found = self.packed.get(piece) or b"".join([self.packed[p] for p in self.reduce(piece)])
        if len(self) >= REMEMBERED:  # what is not asked for again until the next time is forgotten
            self.before = dict(self)
            self.clear()
        self[pre_token] = found
        return found

    def encode(self, text: str) -> bytes:
        """Packed ids of a text."""
        return b"".join([b"".join(map(self.__getitem__, self.find(part))) for part in cut(text)])

    def decode(self, packed: bytes) -> bytes:
        """Bytes of packed ids: those of the halves one after the other, down to leaves of ``PIECE`` ids."""
        n = len(packed) // 4
        if n <= PIECE:
            return self.tokens.take(pa.array(np.frombuffer(packed, "<u4"))).buffers()[2].to_pybytes() if n else b""
        half = 4 * (n // 2)
        return self.decode(packed[:half]) + self.decode(packed[half:])


def cut(text: str) -> Iterator[str]:
    """Parts of about ``PIECE`` characters that the pattern splits as it splits the whole."""
    start = 0
    while len(text) - start > PIECE:
        seam = SEAM.search(text, start + PIECE)
        if seam is None:
            break
        yield text[start : seam.start()]
        start = seam.start()
    yield text[start:] if start else text


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """One per worker process and rank file."""
    return Codec.load(path, pattern)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, token_ids binary, decoded binary) of each row of ``docs`` (doc_id, text).

    ``token_ids`` holds the ids as little-endian unsigned 32-bit integers; ``unpacked`` makes an array of
    them.  ``decoded`` is what decoding those ids gives.  An empty text has no ids.  Rows with null ids,
    repeated rows and empty tables are ordinary input.  Narrow: nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                ids = [own.encode(t) for t in some.column("text").to_pylist()]
                decoded = [own.decode(i) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                    ["doc_id", "token_ids", "decoded"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, token_ids binary, decoded binary")


def unpacked(packed: Column | str) -> Column:
    """Token ids as an array."""

    @F.pandas_udf("array<int>")
    def run(column: pd.Series) -> pd.Series:
        return column.map(lambda b: np.frombuffer(b or b"", "<i4"))

    return run(packed)


def digests(docs: DataFrame) -> DataFrame:
    """Counts and digests of the default tokenizer's round trip over (doc_id, text)."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = round_trip(docs, path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.expr("CAST(octet_length(token_ids) div 4 AS bigint) AS n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_byte_bpe(spark, sf_dir):
    return digests(tables.texts(tables.read(spark, sf_dir, "documents")))
