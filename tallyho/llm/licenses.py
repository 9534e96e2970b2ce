"""License scans: fuzzy search for short notices.

A text becomes its words (lower-cased A-Z, everything that is not a word is
one space). A notice of ``errors`` allowed edits is split into ``errors + 1``
pieces of near-equal length: by the pigeonhole principle every occurrence with
at most that many edits holds at least one piece unchanged. One Aho-Corasick
automaton over the pieces of all notices runs along the text; each piece found
says where its notice may lie, give or take ``errors`` characters, and only
there the ``regex`` library's bounded-error matching runs, which verifies the
edits and gives the span. A match starts and ends at word borders. Candidate
windows of a notice that overlap are joined first, so a text that repeats a
piece is verified once a stretch, not once a piece.

An unedited occurrence holds every piece, the first included, so exact places
are counted where the first piece stands and the rest follows.

Scanning is row-local: no shuffle, no join, whatever passage is common.
``scan`` returns every span (label, notice, word and character range in the
normalised text, edits); ``query`` derives its digest from them.

Defined cases: a null or empty text has no words and no spans; an empty table
gives an empty result; texts are whole, however long; repeated rows are scanned
one by one, null ids too; other columns are ignored. No notices: no spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import small_batches, table, worker_state

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@dataclass(frozen=True)
class Notice:
    label: str
    text: str      # words, one space between them
    errors: int    # inserted, deleted or replaced characters allowed
    base: bool = False  # its exact places are counted

    def pieces(self) -> list[tuple[int, str]]:
        """(offset, piece): errors + 1 pieces that make up the notice."""
        n, k = len(self.text), self.errors + 1
        cuts = [i * n // k for i in range(k + 1)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:])]


#: The phrases of the query (fixed values of its contract). About one edit in
#: seven characters; "cc by" is too short for any.
PHRASES = (
    Notice("gpl", "gnu general public license", 3, True),
    Notice("apache", "apache license", 2, True),
    Notice("cc-by", "cc by", 0, True),
    Notice("mit", "mit license", 1, True),
)

#: Other short notices that the method labels.
NOTICES = (
    Notice("agpl", "gnu affero general public license", 3),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("mpl", "mozilla public license", 3),
    Notice("epl", "eclipse public license", 3),
    Notice("bsd", "bsd license", 1),
    Notice("bsd", "redistribution and use in source and binary forms", 6),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 8),
    Notice("apache", "licensed under the apache license version 2 0", 5),
    Notice("isc", "isc license", 1),
    Notice("artistic", "artistic license", 2),
    Notice("unlicense", "free and unencumbered software released into the public domain", 6),
    Notice("cc", "creative commons attribution", 4),
    Notice("cc-by-nc", "cc by nc", 0),
    Notice("cc-by-sa", "cc by sa", 0),
    Notice("cc-by-nd", "cc by nd", 0),
    Notice("proprietary", "all rights reserved", 3),
)


def words_of(text: str | None) -> list[str]:
    """The words of a text, A-Z lower-cased (no other letter)."""
    return WORD.findall(text.encode().lower().decode()) if text else []


class Scanner:
    """Finds notices in normalised texts: ``' ' + words joined by spaces + ' '``."""

    def __init__(self, notices: tuple[Notice, ...]):
        import ahocorasick
        import regex

        self.notices = notices
        found: dict[str, list[tuple[int, int]]] = {}
        for i, n in enumerate(notices):
            for at, piece in n.pieces():
                found.setdefault(piece, []).append((i, at))
        self.seeds = ahocorasick.Automaton()
        for piece, where in found.items():
            self.seeds.add_word(piece, (len(piece), tuple(where)))
        if found:
            self.seeds.make_automaton()
        self.verify = [regex.compile(rf"(?e)(?<= )(?:{regex.escape(n.text)}){{e<={n.errors}}}(?= )") for n in notices]
        self.any = bool(found)

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Notice → the stretches (start, end) where it may lie, joined and ascending."""
        near: dict[int, list[tuple[int, int]]] = {}
        for last, (length, where) in self.seeds.iter(text):
            for i, at in where:
                n = self.notices[i]
                start = last + 1 - length - at
                near.setdefault(i, []).append((start - n.errors, start + len(n.text) + n.errors))
        out: dict[int, list[list[int]]] = {}
        for i, spans in near.items():
            joined: list[list[int]] = []
            for a, b in sorted(spans):
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], b)
                else:
                    joined.append([max(a, 0), b])
            out[i] = joined
        return out

    def spans(self, words: list[str]) -> list[tuple]:
        """(label, notice, base, start, end, first word, edits) of every match, by start."""
        if not words or not self.any:
            return []
        text = f" {' '.join(words)} "
        found = []
        for i, stretches in self.windows(text).items():
            n = self.notices[i]
            for a, b in stretches:
                a, b = max(a - 1, 0), min(b + 1, len(text))  # with the spaces around
                exact, at = [], text.find(f" {n.text} ", a, b)
                while at >= 0:  # all exact places, overlapping ones too
                    exact.append((at + 1, at + 1 + len(n.text)))
                    at = text.find(f" {n.text} ", at + 1, b)
                found += [(s, e, i, 0) for s, e in exact]
                if n.errors:  # edited ones lie between them
                    for (_, x), (y, _) in zip([(0, a), *exact], [*exact, (b, 0)]):
                        found += [(m.start(), m.end(), i, sum(m.fuzzy_counts)) for m in self.verify[i].finditer(text, x, y)]
        found.sort()
        out, before, at = [], 0, 0
        for s, e, i, edits in found:  # words before a span, counted along the text once
            before, at, n = before + text.count(" ", at, s), s, self.notices[i]
            out.append((n.label, n.text, n.base, s - 1, e - 1, before - 1, edits))
        return out


SPANS = T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("notice", T.StringType()), T.StructField("base", T.BooleanType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("word", T.LongType()),
    T.StructField("edits", T.IntegerType())]))


def scan(docs: DataFrame, id_col: str, text: str, notices: tuple[Notice, ...]) -> DataFrame:
    """(id, n_words, spans) for every row. ``start`` and ``end`` are characters of the
    text's words joined by one space, ``word`` is the word that a match starts in."""
    small_batches(docs.sparkSession)
    schema = docs.select(id_col).schema.add("n_words", "long").add("spans", SPANS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = worker_state(f"license scanner {notices}", lambda: Scanner(notices))
        for b in batches:
            words, spans = [], []
            for t in b.column(1):
                w = words_of(t.as_py())
                words.append(len(w))
                spans.append(scanner.spans(w))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(spans, to_arrow_type(SPANS))],
                                             [id_col, "n_words", "spans"])

    return docs.select(id_col, text).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """The digest: base places are the unedited spans of the phrases; the score is the
    share of its allowed edits (and one) that the best match leaves unused."""
    allowed = ", ".join(f"'{n.text}', {n.errors + 1}" for n in PHRASES + NOTICES)
    found = scan(table(spark, sf_dir, "documents"), "doc_id", "text", PHRASES + NOTICES)
    d = found.selectExpr("doc_id", "n_words", "spans", "filter(spans, s -> s.base AND s.edits = 0) AS b", f"map({allowed}) AS most")
    label = "array_join(array_sort(array_distinct(transform({}, s -> s.label))), ',')"
    return d.selectExpr(
        "doc_id", "n_words", "CAST(size(b) AS BIGINT) AS n_base", "array_min(transform(b, s -> s.word)) AS first_word",
        "array_max(transform(b, s -> s.word)) AS last_word", f"{label.format('b')} AS base_labels",
        f"{label.format('spans')} AS labels",
        "coalesce(array_max(transform(spans, s -> 1 - s.edits / most[s.notice])), 0D) AS score",
        "CAST(size(spans) AS BIGINT) AS n_spans")
