"""Packing by power-of-two decomposition.

A document's ids (its tokens, then an end id) are cut into pieces of 2048 ids
and, for the rest, the powers of two of its length in binary, longest first.
Pieces of equal length share a bucket, and each piece is a sequence of its
own: no sequence crosses documents and none is padded, since every length is
a power of two. Sequence ids run from 0 over the buckets, shortest first, and
within a bucket over the pieces.

Tokenizing is row-local. Texts are cut at white space (the tokenizer drops it
and no merge crosses it), and the ids of the cut words are remembered in a
table of bounded size; words with characters from U+0250 on, or with an
added-token string, go through the library itself.

Defined cases: a null or empty text is one piece, the end id; an empty table
gives an empty result; texts are whole, however long; repeated rows and null
ids are packed like others; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, rank_in_order, saved, small_batches, table, worker_state
from .token_counts import BEYOND, byte_letters

WIDTH = 2048
END_ID = 1
#: Words that a worker remembers, twice at most; and half as many pre-tokens.
REMEMBERED = 300_000
#: Rows of one bucket of the numbering, on average, at most.
BUCKET_ROWS = 50_000

# The pre-tokenizer's pattern on a lower-cased word below U+0250 (fixed values
# of the tokenizer): letters and numbers written out.
_L = "a-zªµºß-öø-ɏÀ-ÖØ-ÞA-Z"
_N = "0-9²³¹¼-¾"
PRE_TOKEN = re.compile(f"'(?:[stmd]|re|ve|ll)|[{_L}]+|[{_N}]|[^{_N}{_L}]+")
MARKS = frozenset(".,;:!?")
#: White space to Python, but not to the tokenizer's pattern.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


class WordEncoder:
    """Ids of texts as the library gives them for a word-end BPE at ``path``
    (lower case, white space dropped, no special tokens added)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.merge = self.whole.model.tokenize
        self.special = tuple(t["content"] for t in json.load(open(path, encoding="utf-8"))["added_tokens"])
        letters = byte_letters()
        # each character below U+0250 as the byte letters of its UTF-8 form
        self.letters = {c: "".join(letters[b] for b in chr(c).encode("utf-8")) for c in range(0x250)}
        self.words = Memo(self.word, REMEMBERED)
        self.pres = Memo(self.pre, REMEMBERED // 2)

    def by_library(self, text: str) -> bytes:
        return packed(self.whole.encode(text, add_special_tokens=False).ids)

    def pre(self, pre: str) -> bytes:
        return packed([t.id for t in self.merge(pre.translate(self.letters))])

    def word(self, word: str) -> bytes:
        low = word.lower()
        # (a letter's lower case may be beyond what the written-out classes cover)
        if not word.isascii() and (BEYOND.search(word) or BEYOND.search(low)) or "<" in word and any(s in word for s in self.special):
            return self.by_library(word)
        # letters, and letters before one mark, are their own pre-tokens
        if low.isalpha():
            return self.pres[low]
        if low[-1] in MARKS and low[:-1].isalpha():
            return self.pres[low[:-1]] + self.pres[low[-1]]
        return b"".join([self.pres[p] for p in PRE_TOKEN.findall(low)])

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if any(s in text for s in SEPARATORS):
            return self.by_library(text)
        return b"".join(map(self.words.__getitem__, text.split()))


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def piece_lengths(n: int, width: int = WIDTH) -> list[int]:
    """Full widths, then the powers of two of the rest, longest first."""
    rest = n % width
    return [width] * (n // width) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def cut(docs: DataFrame, id_col: str, text: str, path: str, width: int = WIDTH, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document: (id, start, length, ids_crc32, doc_tokens)."""
    if width < 1 or width & (width - 1):
        raise ValueError("the width must be a power of two")
    small_batches(docs.sparkSession)
    end = packed([end_id])
    names = ["start", "length", "ids_crc32", "doc_tokens"]
    schema = docs.select(F.col(id_col).alias("doc_id")).schema
    for name in names:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(f"word encoder {path}", lambda: WordEncoder(path))
        for b in batches:
            row, out = [], ([], [], [], [])
            for i, t in enumerate(b.column(1)):
                raw, at = memoryview(encoder.encode(t.as_py()) + end), 0
                for n in piece_lengths(len(raw) // 4, width):
                    row.append(i)
                    for to, x in zip(out, (at, n, zlib.crc32(raw[4 * at:4 * (at + n)]), len(raw) // 4)):
                        to.append(x)
                    at += n
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in out)],
                ["doc_id", *names])

    return docs.select(id_col, text).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Pieces with their sequence: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    The pieces are written once (a few numbers each), then numbered within
    their length's bucket by ranks from counts, so no bucket passes through one task.
    """
    pieces = saved(cut(docs, id_col, text, path, width), "pieces")
    lengths = pieces.groupBy("length").count().collect()  # at most log2(width) + 1 rows
    n = sum(r["count"] for r in lengths)
    first, at = {}, 0
    for r in sorted(lengths, key=lambda r: r["length"]):
        first[r["length"]] = at
        at += r["count"]
    parts = 64
    while n > BUCKET_ROWS * parts:
        parts *= 4
    rows = pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    order = [F.col(c) for c in ("doc_id", "start", "ids_crc32", "doc_tokens")]
    ranked = rank_in_order(rows, ["length"], "_part", order, "_rank")
    base = F.expr("CASE " + " ".join(f"WHEN length = {k} THEN {v}L" for k, v in first.items()) + " END") if first else F.lit(0)
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                         (base + F.col("_rank")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
