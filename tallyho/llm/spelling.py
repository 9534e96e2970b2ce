"""Spelling variant grouping by a variable-length gram index.

Words that differ by exactly one inserted, deleted or replaced character are
near. Candidates come from grams of variable length: the dictionary holds all
2-grams of the (padded) words, and a gram one longer wherever a gram is
frequent, up to ``QMAX``. A word is decomposed greedily: at every place the
longest dictionary gram, unless it lies within an earlier one. An edit can only
change the grams around it, and which ones follows from the dictionary: those
that hold the place, those left of it that a longer gram reaching over the
place could swallow (some suffix of the text before it is frequent), and those
right of it likewise. The most grams that any single edit can affect is the
word's bound: near words share all but that many grams, at the same place give
or take one. So each word is listed under its bound + 1 rarest grams only, and
near words meet in a list of the same gram, place and length (list merging by
the prefix of a common order); the distance itself then decides.

A word where a single edit may affect all grams has no such bound. If only one
of two near words is like that, the other's bound holds. Pairs of two such
words meet by halves (one edit leaves a half as it is).

Only the frequent grams go to the driver and the tasks: at most ``QMAX - QMIN``
times 1 / ``SHARE`` of them, whatever the vocabulary. Words, lists and pairs
are joined and aggregated by Spark; forms are followed to their roots by
pointer doubling (each form is ``RATIO`` times as frequent, so chains are short).

Defined cases: a null text has no words, a null id reads as empty; an empty
table gives an empty result; repeated rows count again; texts are whole,
however long; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches, table

#: Shortest and longest grams.
QMIN, QMAX = 2, 4
#: A gram is frequent (and made longer) beyond this share of all gram places.
SHARE = 1 / 20_000
#: Words that count: characters and occurrences at least.
LEAST_CHARS, LEAST_COUNT = 6, 5
#: A form is at least so many times as frequent as the word.
RATIO = 5
#: Every so many occurrences (by checksum) one loses a character in the query.
DAMAGE = 199
#: Words that a task counts before it hands them on.
HELD = 200_000
RUN = re.compile("[a-zÀ-ÿ]+")


class Grams:
    """The gram dictionary, given its frequent grams (closed under prefixes)."""

    def __init__(self, frequent: frozenset[str]):
        self.frequent = frequent
        self.tails = frozenset(g[k:] for g in frequent for k in range(1, len(g) + 1)) | {""}

    def decompose(self, s: str) -> list[tuple[int, str]]:
        """(place, gram) of a padded word."""
        out, end, n = [], 0, len(s)
        for p in range(n - QMIN + 1):
            q = p + QMIN
            while q < n and q - p < QMAX and s[p:q] in self.frequent:
                q += 1
            if q > end:
                out.append((p, s[p:q]))
                end = q
        return out

    def affected(self, s: str, grams: list[tuple[int, str]]) -> int:
        """The most grams of ``s`` that one edit within its padding may affect."""
        n, most = len(s), 0
        ends = [(p, p + len(g)) for p, g in grams]
        for i in range(1, n):
            # the text before place i: from where on a longer gram may reach over it
            left = next((j for j in range(max(0, i - QMAX + 1), i - QMIN + 1) if s[j:i] in self.frequent), n)
            # inserted before i, then (if i is not the padding) replaced or deleted at i
            for right in (i, i + 1) if i < n - 1 else (i,):
                reach = next((x for x in range(min(n, right + QMAX - 1), right, -1) if s[right:x - 1] in self.tails), right)
                count = sum(1 for p, e in ends if (p >= left if e <= i else p < right or e <= reach))
                most = max(most, count)
        return most

    def lists(self, word: str, counts: dict[str, int]) -> tuple[list[tuple[int, str]], bool]:
        """((place, gram) of the word's rarest grams, enough of them to meet every near word;
        whether an edit may affect them all)."""
        s = f"^{word}$"
        grams = self.decompose(s)
        different = sorted({g for _, g in grams}, key=lambda g: (counts.get(g, 0), g))
        most = self.affected(s, grams)
        taken = set(different[:most + 1])
        return [x for x in grams if x[1] in taken], most >= len(different)


def entries(word: str, grams: Grams, counts: dict[str, int]) -> Iterator[tuple[str, int, int, bool]]:
    """(text, place, length, probe): the lists that a word is in and, as the shorter or
    equally long one of two, those that it asks."""
    n = len(word)
    found, weak = grams.lists(word, counts)
    for place, gram in found:
        yield gram, place, n, False
        yield gram, place, n, True
        yield gram, place, n + 1, True  # the other word is longer, by a character after the gram
        yield gram, place + 1, n + 1, True  # or before it
    if weak:
        half, shorter = n // 2, (n - 1) // 2
        for probe in (False, True):
            yield f"=<{word[:half]}", 0, n, probe
            yield f"=>{word[half:]}", 0, n, probe
        yield f"+<{word[:shorter]}", 0, n, False
        yield f"+>{word[shorter + 1:]}", 0, n, False
        yield f"+<{word[:half]}", 0, n + 1, True
        yield f"+>{word[half:]}", 0, n + 1, True


def count_words(docs: DataFrame, id_col: str, text: str, damage: int = 0) -> DataFrame:
    """(word, n): runs of letters of at least ``LEAST_CHARS`` characters, A-Z lower-cased, and
    how often they occur. With ``damage``, a run whose checksum with the id it divides first
    loses a character."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                t = t.as_py()
                if not t:
                    continue
                i = i.as_py()
                start = zlib.crc32(f"{'' if i is None else i}:".encode())
                for w, n in Counter(RUN.findall(t.encode().lower().decode())).items():
                    if len(w) < LEAST_CHARS:
                        continue
                    if damage:
                        h = zlib.crc32(w.encode(), start)
                        if h % damage == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1:]
                            if len(w) < LEAST_CHARS:
                                continue
                    held[w] += n
            if len(held) > HELD:
                yield out()
        yield out()

    found = docs.select(id_col, text).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """Grams of ``QMIN`` to ``QMAX`` characters beyond ``SHARE`` of the gram places, with the number
    of their places: at most 1 / ``SHARE`` of each length."""
    places = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    pieces = (f"flatten(transform(sequence({QMIN}, {QMAX}), q -> transform(sequence(1, length(word) + 3 - q), "
              "i -> substr(concat('^', word, '$'), i, q))))")
    counts = words.select(F.explode(F.expr(pieces)).alias("gram")).groupBy("gram").count()
    return {r["gram"]: r["count"] for r in counts.where(F.col("count") > SHARE * places).collect()}


def gram_lists(words: DataFrame) -> DataFrame:
    """(word, n, list, probe): the lists that words are in, and those that they ask."""
    counts = frequent_grams(words)
    frequent = frozenset(g for g in counts if len(g) < QMAX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(frequent)
        for b in batches:
            rows = [(w, n, *e) for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for e in entries(w, grams, counts)]
            cols = list(zip(*rows)) or [()] * 6
            types = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["word", "n", "text", "place", "length", "probe"])

    d = words.select("word", "n").mapInArrow(run, "word string, n long, text string, place int, length int, probe boolean")
    return d.selectExpr("word", "n", "xxhash64(text, place, length) AS list", "probe")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of words one edit apart, once each (``b`` the longer or, of
    equal length, the greater one)."""
    lists = saved(gram_lists(words), "spelling-lists")
    asking = lists.where("probe").selectExpr("word AS a", "n AS n_a", "list")
    listed = lists.where("NOT probe").selectExpr("word AS b", "n AS n_b", "list")
    met = asking.join(listed, "list").where("(length(a) < length(b) OR a < b) AND levenshtein(a, b, 1) = 1")
    return met.groupBy("a", "b").agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"))


def group_variants(words: DataFrame) -> DataFrame:
    """Words (word, n) → (word, form, root, n, n_near, form_n)."""
    words = saved(words, "spelling-words")
    both = near_pairs(words).selectExpr("inline(array(struct(a AS word, b AS other, n_b AS m), struct(b AS word, a AS other, n_a AS m)))")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.expr("min(struct(-m AS m, other))").alias("_best"))
    found = words.join(best, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0) AS n_near", f"CASE WHEN -_best.m >= {RATIO} * n THEN _best.other END AS form",
        f"CASE WHEN -_best.m >= {RATIO} * n THEN -_best.m END AS form_n")
    found = saved(found, "spelling-forms")
    up = found.where("form IS NOT NULL").selectExpr("word", "form AS root")
    # a chain of forms grows RATIO times in n at every step
    most, least = found.agg(F.max("n"), F.min("n")).first()
    steps, n = 1, (least or 1) * RATIO
    while n * RATIO <= (most or 0):
        steps, n = steps + 1, n * RATIO
    for _ in range((steps - 1).bit_length()):
        further = up.selectExpr("word AS root", "root AS _further")
        up = saved(up.join(further, "root", "left").selectExpr("word", "coalesce(_further, root) AS root"), "spelling-roots")
    return found.join(up, "word", "left").selectExpr("word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n")


# Checksums bit by bit; near words by what is left without one character.
ORACLE = r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents),
d AS (SELECT id, w, count(*) AS n FROM runs WHERE length(w) >= 6 GROUP BY id, w),
h AS (SELECT w, n, xor(list_reduce([4294967295] || flatten([CASE WHEN ord(x) < 128 THEN [ord(x)] ELSE [192 + (ord(x) >> 6), 128 + (ord(x) & 63)] END
                                                    for x in string_split(id || ':' || w, '')]),
               lambda c, b: list_reduce([xor(c, b)] || range(8), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) AS h FROM d),
v AS (SELECT CASE WHEN h % 199 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM v WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
          UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(m := -m, other := other)) AS x FROM pairs GROUP BY word),
f AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -x.m >= 5 * n THEN x.other END AS form,
             CASE WHEN -x.m >= 5 * n THEN -x.m END AS form_n FROM words LEFT JOIN best ON best.word = words.word),
up AS (SELECT word, word AS root FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL)
SELECT f.word, form, r.root, n, n_near, form_n FROM f
JOIN (SELECT up.word, up.root FROM up JOIN f ON f.word = up.root WHERE f.form IS NULL) r ON r.word = f.word
"""


def query(spark, sf_dir: str) -> DataFrame:
    words = count_words(table(spark, sf_dir, "documents"), "doc_id", "text", DAMAGE)
    return group_variants(words.where(F.col("n") >= LEAST_COUNT))
