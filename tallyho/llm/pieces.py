"""SentencePiece encoding and decoding with an Aho-Corasick automaton over the pieces.

A text is normalised as its model says, cut before every run of the space mark
(no piece goes on across it; proven when the model is loaded) and each cut
word is encoded in one pass: the automaton meets, at every position, all the
pieces that end there (its output links), and each relaxes that position.

* Unigram models: Viterbi; a position keeps the best score and its piece.
* BPE models: their scores are merge ranks, whose best sum is not what merging
  gives. The relaxation there takes the piece that makes a valid pair with the
  last piece of the position it starts from (merging the two alone leaves them
  as they are); exactly one does, so the pass gives the merges' own result.

Characters without a piece become their bytes' pieces (or the unknown piece).
Words are remembered in tables of bounded size. A model with unused pieces, or
with a piece across a space mark, goes through the library; models with
user-defined pieces are not supported.

Defined cases: a null text is encoded as empty, and so are null ids decoded;
an empty table gives an empty result; texts are whole, however long; repeated
rows are encoded one by one; other columns are ignored.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Memo, small_batches, table, worker_state

SPACE = "▁"
#: Words, and pairs of pieces, that a worker remembers, twice at most.
REMEMBERED = 400_000
_UNKNOWN_COST = 10.0
CUT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Codec:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(lib.get_piece_size())
        self.pieces = [lib.id_to_piece(i) for i in ids]
        self.score = [lib.get_score(i) for i in ids]
        self.unknown = lib.unk_id()
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in ids]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in ids if lib.is_byte(i)}
        self.id_of = {self.pieces[i]: i for i in ids if not special[i]}
        # merge ranks are whole numbers from 0 down; log probabilities are not
        self.bpe = all(self.score[i] == int(self.score[i]) for i in self.id_of.values())
        self.plain = (not any(lib.is_unused(i) for i in ids) and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id_of)
                      and len(set(self.id_of)) == sum(not s for s in special))
        probe = " a b  Ａﬁ "
        self.identity = lib.normalize(probe) == SPACE + probe.replace(" ", SPACE)
        # merge order: characters first, then the merges by rank
        self.order = [0 if len(p) == 1 else 1 - int(s) for p, s in zip(self.pieces, self.score)] if self.bpe else []
        self.halves: dict[int, tuple[int, int]] = {}  # the last merge of a piece
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            # a BPE piece that merging never makes can't occur
            if not self.bpe or self.made(p, i):
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.worst = min((self.score[i] for i in self.id_of.values()), default=0.0) - _UNKNOWN_COST
        self.words = Memo(self.word, REMEMBERED)
        self.spaced = Memo(self.after_space, REMEMBERED)
        self.marks = {m for m in ".,;:!?" if not any(p[i] == m and p[i - 1].isalpha() for p in self.id_of for i in range(1, len(p)))}
        self.valid = Memo(lambda ab: self.pair(*ab), REMEMBERED)
        self.text_of = [(None if s else p.replace(SPACE, " ")) for p, s in zip(self.pieces, special)]
        self.byte_of = {i: b for b, i in self.bytes.items()}

    # encoding

    def made(self, piece: str, i: int) -> bool:
        """Merge a piece's characters, best rank first, leftmost of equals: whether that
        makes the piece, by which last merge."""
        parts, last = list(piece), None
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                j = self.id_of.get(parts[k] + parts[k + 1])
                if j is not None and (best is None or self.score[j] > best):
                    best, at = self.score[j], k
            if best is None:
                return False
            last = parts[at:at + 2]
            parts[at:at + 2] = ["".join(last)]
        self.halves[i] = (self.id_of[last[0]], self.id_of[last[1]]) if last else (i, i)
        return True

    def pair(self, a: int, b: int) -> bool:
        """Whether merging leaves the border between two pieces: undo their merges from
        the last on, and no two parts that meet there may have merged before."""
        order, halves, pieces, id_of = self.order, self.halves, self.pieces, self.id_of
        limit = float("inf")  # merges of a lower order are done before the last one undone
        while True:
            both = id_of.get(pieces[a] + pieces[b])
            if both is not None and order[both] < limit:
                return False
            if order[a] > order[b]:
                limit, a = order[a], halves[a][1]
            elif order[b]:
                limit, b = order[b] + 1, halves[b][0]  # of one order, the left merge goes first
            else:
                return True

    def word(self, word: str) -> list[int]:
        """One pass over the pieces that end at each position; -1: a character without a piece."""
        n = len(word)
        last, start = [-1] * (n + 1), list(range(-1, n))  # the last piece, and where it starts
        if self.bpe:
            valid = self.valid
            for end, (i, size) in self.automaton.iter(word):
                # what stands before a start, or is no piece, has nothing to merge with
                if last[end + 1] < 0:
                    before = last[end + 1 - size]
                    if before < 0 or valid[before, i]:
                        last[end + 1], start[end + 1] = i, end + 1 - size
        else:
            best = [0.0] + [-np.inf] * n
            ends: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
            for end, found in self.automaton.iter(word):
                ends[end + 1].append(found)
            for e in range(1, n + 1):
                if word[e - 1] not in self.id_of:
                    best[e] = best[e - 1] + self.worst
                for i, size in ends[e]:
                    if best[e - size] + self.score[i] > best[e]:
                        best[e], last[e], start[e] = best[e - size] + self.score[i], i, e - size
        out, e = [], n
        while e:
            i, s = last[e], start[e]
            if i >= 0:
                out.append(i)
            elif self.bytes:
                out.extend(self.bytes[b] for b in reversed(word[s:e].encode("utf-8")))
            elif not out or out[-1] != self.unknown:  # neighbours without a piece are one unknown
                out.append(self.unknown)
            e = s
        return out[::-1]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if not self.plain:
            return self.library.encode(text)
        if self.identity and "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
            return list(chain.from_iterable(map(self.spaced.__getitem__, text.split(" "))))
        norm = SPACE + text.replace(" ", SPACE) if self.identity else self.library.normalize(text)
        return list(chain.from_iterable(map(self.words.__getitem__, CUT.findall(norm))))

    def after_space(self, word: str) -> list[int]:
        """Ids of a space and the word after it. Where no piece goes on from a letter to a
        mark (proven when the model is loaded), letters and the mark after them are apart."""
        if word[-1] in self.marks and word[:-1].isalpha():
            return self.spaced[word[:-1]] + self.words[word[-1]]
        return self.word(SPACE + word)

    # decoding

    def decode(self, ids: list[int] | None) -> str:
        """Pieces joined, space marks as spaces without the first, runs of byte pieces as UTF-8."""
        if not ids:
            return ""
        if not self.identity or self.unknown in ids:
            return self.library.decode(ids)
        text_of = self.text_of
        try:
            text = "".join(map(text_of.__getitem__, ids))
        except TypeError:  # bytes or control pieces among them
            parts, run = [], bytearray()
            for i in ids:
                if i in self.byte_of:
                    run.append(self.byte_of[i])
                    continue
                if run:
                    parts.append(run.decode("utf-8", "replace"))
                    run.clear()
                parts.append(text_of[i] or "")
            parts.append(run.decode("utf-8", "replace"))
            text = "".join(parts)
        return text[1:] if text[:1] == " " else text


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


def codec(path: str) -> Codec:
    return worker_state(f"pieces {path}", lambda: Codec(path))


def encode(docs: DataFrame, id_col: str, text: str, path: str) -> DataFrame:
    """(id, ids) for every row."""
    small_batches(docs.sparkSession)
    schema = docs.select(id_col).schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([c.encode(t.as_py()) for t in b.column(1)], pa.list_(pa.int32()))], [id_col, "ids"])

    return docs.select(id_col, text).mapInArrow(run, schema)


def decode(rows: DataFrame, id_col: str, ids: str, path: str) -> DataFrame:
    """(id, text) for every row."""
    small_batches(rows.sparkSession)
    schema = rows.select(id_col).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([c.decode(i.as_py()) for i in b.column(1)], pa.string())], [id_col, "text"])

    return rows.select(id_col, ids).mapInArrow(run, schema)


def round_trip(docs: DataFrame, id_col: str, text: str, path: str) -> DataFrame:
    """(id, n_pieces, ids_crc32, decoded_crc32, same) for every row: encoded and
    decoded in one pass; the checksum of the ids is over little-endian 32-bit numbers."""
    small_batches(docs.sparkSession)
    names = ["n_pieces", "ids_crc32", "decoded_crc32"]
    schema = docs.select(id_col).schema
    for name in names:
        schema = schema.add(name, "long")
    schema = schema.add("same", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            out = ([], [], [], [])
            for t in b.column(1):
                t = t.as_py() or ""
                ids = c.encode(t)
                back = c.decode(ids)
                for to, x in zip(out, (len(ids), zlib.crc32(packed(ids)), zlib.crc32(back.encode("utf-8")), back == t)):
                    to.append(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.bool_())], [id_col, *names, "same"])

    return docs.select(id_col, F.col(text)).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path("piece_bpe_32k.model"))
