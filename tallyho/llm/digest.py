"""Document fingerprints: improbable-feature digests of byte windows.

Every window of 64 bytes of a text has the Shannon entropy of its bytes. Its
precedence is the rarity of that entropy among all windows of all documents
(a histogram counted over the whole table; windows of repeated bytes are never
picked). Every run of 64 neighbouring windows votes for its rarest window, the
leftmost of equals, and windows with 16 votes or more are the features (in a
short text, those with the most votes). Each sets 5 bits of a 2048-bit Bloom
filter; after 160 features a new filter is chained. A text with no feature is one feature, the whole text.

The likeness of two fingerprints takes, for every filter of the shorter chain,
the best match in the longer one: the bits in common above what chance gives
for their counts, normalised by the most there can be, and averages them.

Neighbours in the order of ids are met by a range partitioning on the id: each
text moves once, and a task streams its range. The first document of every
range is also sent to the range before it, so no task needs another's rows.

Defined cases: a null text is empty; empty texts all have the fingerprint of
no bytes; the order is by id (null first), equal ids by the text's checksums;
with one document the next one is itself; an empty table gives an empty
result; texts are whole, however long; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table

WINDOW = 64
VOTES = 16
BITS = 2048
HASHES = 5
PER_FILTER = 160
#: Steps of entropy (from 0 to log2 of the window) that the rarity is counted for.
STEPS = 1024
#: Documents of one range, on average, about; ranges grow beyond the most there may be.
RANGE_ROWS = 1000
MOST_RANGES = 4096
_BLOCK = 1 << 15


def _terms() -> np.ndarray:
    """n log2 n in units of 1/65536, so that sliding sums stay exact."""
    n = np.arange(WINDOW + 2, dtype=np.float64)
    n[0] = 1
    return np.round(np.arange(WINDOW + 2) * np.log2(n) * 65536).astype(np.int32)


TERMS = _terms()
GROWTH = np.diff(TERMS)  # what one more equal byte adds


def entropy_steps(x: np.ndarray) -> np.ndarray:
    """Entropy, in ``STEPS`` steps, of every whole window of the bytes ``x``.

    The sum of n log n over a window's byte counts changes, as the window
    moves, by the byte that leaves and the byte that comes; how often each
    occurs in its window is counted by comparing ``x`` with itself shifted."""
    n = len(x) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int16)
    total = np.empty(n, np.int32)
    total[0] = TERMS[np.bincount(x[:WINDOW], minlength=256)].sum()
    for at in range(0, n - 1, _BLOCK):
        stop = min(n - 1, at + _BLOCK)
        part = x[at:stop + WINDOW]
        size = stop - at
        leaving = np.zeros(size, np.uint8)  # other bytes equal to x[i] in window i
        coming = np.zeros(size, np.uint8)   # other bytes equal to x[i + WINDOW] in window i + 1
        same = np.empty(size + WINDOW, bool)
        one = same.view(np.uint8)
        for k in range(1, WINDOW):
            np.equal(part[:-k], part[k:], out=same[:size + WINDOW - k])
            np.add(leaving, one[:size], out=leaving)
            np.add(coming, one[WINDOW - k:WINDOW - k + size], out=coming)
        np.subtract(GROWTH[coming], GROWTH[leaving], out=total[at + 1:stop + 1])
    np.cumsum(total, out=total)
    steps = (np.float32(TERMS[WINDOW]) - total) * np.float32(STEPS / TERMS[WINDOW])
    return np.minimum(steps, STEPS - 1).astype(np.int16)


def each_steps(texts: list[bytes]) -> Iterator[np.ndarray]:
    """``entropy_steps`` of every text; short ones are worked on together."""
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= 8 * _BLOCK):
            size += len(texts[stop])
            stop += 1
        steps, at = entropy_steps(np.frombuffer(b"".join(texts[start:stop]), np.uint8)), 0
        for t in texts[start:stop]:
            yield steps[at:at + max(0, len(t) - WINDOW + 1)]  # without the windows that cross into the next text
            at += len(t)
        start = stop


def precedence(counts: np.ndarray) -> np.ndarray:
    """Rank of every entropy step, 0 the rarest; steps under one bit of entropy
    come last (runs of padding or one repeated byte say nothing about a text)."""
    low = int(STEPS / np.log2(WINDOW))
    order = np.lexsort((np.arange(STEPS), counts, np.arange(STEPS) < low))
    rank = np.empty(STEPS, np.int64)
    rank[order] = np.arange(STEPS)
    return rank


def features(steps: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Starts of the windows with enough votes."""
    n = len(steps)
    if n == 0:
        return np.empty(0, np.int64)
    kind, shift = (np.uint32, 22) if n < 1 << 22 else (np.int64, 40)
    key = (rank.astype(kind) << kind(shift))[steps] + np.arange(n, dtype=kind)
    if n <= WINDOW:
        return np.array([key.argmin()])
    low, width = key, 1
    while width < WINDOW:  # minima of ever wider runs; the rank first, then the place
        step = min(width, WINDOW - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    votes = np.bincount(low & kind((1 << shift) - 1))
    return np.flatnonzero(votes >= min(VOTES, votes.max()))


def hashes(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every picked window."""
    words = np.lib.stride_tricks.sliding_window_view(x, WINDOW)[starts].view("<u8")
    h = np.full(len(starts), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(words.shape[1]):
        h = (h ^ words[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def digests(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    return [digest(t, steps, rank) for t, steps in zip(texts, each_steps(texts))]


def digest(data: bytes, steps: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The chained filters (one row each) of a text's bytes."""
    starts = features(steps, rank)
    if len(starts):
        h = hashes(np.frombuffer(data, np.uint8), starts)
        h = h[np.sort(np.unique(h, return_index=True)[1])]  # each feature once, in order
    else:
        h = np.array([int.from_bytes(hashlib.sha1(data).digest()[:8], "little")], np.uint64)
    filters = np.zeros((-(-len(h) // PER_FILTER), BITS), bool)
    row = np.arange(len(h)) // PER_FILTER
    for k in range(HASHES):
        filters[row, ((h >> np.uint64(11 * k)) % np.uint64(BITS)).astype(np.int64)] = True
    return np.packbits(filters, axis=1)


def encode(filters: np.ndarray) -> str:
    return base64.b64encode(filters.tobytes()).decode("ascii")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: the mean over the shorter chain of the best normalised overlap."""
    if len(a) > len(b):
        a, b = b, a
    na, nb = (np.bitwise_count(f).sum(axis=1, dtype=np.int64) for f in (a, b))
    best = np.zeros(len(a))
    wide = b.view("<u8")
    for i, f in enumerate(a.view("<u8")):
        common = np.bitwise_count(wide & f).sum(axis=1, dtype=np.int64)
        most = np.minimum(na[i], nb)
        chance = na[i] * nb / BITS
        best[i] = (np.maximum(common - chance, 0) / np.maximum(most - chance, 1e-9)).max()
    return float(np.clip(best.mean(), 0.0, 1.0))


def entropy_counts(docs: DataFrame, text: str) -> np.ndarray:
    """How many windows of the whole table have each step of entropy."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(STEPS, np.int64)
        for b in batches:
            for steps in each_steps([t.as_py().encode("utf-8") for t in b.column(0) if t.is_valid]):
                total += np.bincount(steps, minlength=STEPS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["step", "n"])

    rows = docs.select(text).mapInArrow(run, "step int, n long").groupBy("step").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(STEPS, np.int64)
    for r in rows:  # at most STEPS rows
        counts[r["step"]] = r["n"]
    return counts


def in_ranges(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc_id, text, _range, _tail): documents by range of id, each range followed by
    the first document of the next range (``_tail`` 1; after the last the first).

    What comes to the driver is one bound and one first id a range."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = rows.select("doc_id")
    parts = max(1, min(MOST_RANGES, -(-ids.count() // RANGE_ROWS)))
    cuts = []
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        cuts = sorted(set(ids.select(F.percentile_approx("doc_id", at, 100 * parts)).first()[0] or []))
    bounds = F.from_json(F.lit(json.dumps(cuts)), "array<bigint>")
    place = F.coalesce(F.size(F.filter(bounds, lambda c: c <= F.col("doc_id"))), F.lit(0)) if cuts else F.lit(0)
    place = F.when(F.col("doc_id").isNull(), 0).otherwise(place)
    heads = ids.groupBy(place.alias("_range")).agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("k"), "doc_id")).alias("h"))
    heads = sorted((r["_range"], r["h"]["doc_id"]) for r in heads.select("_range", "h").collect())  # a row a range
    before = [(r, d, heads[i - 1][0]) for i, (r, d) in enumerate(heads)]  # the first range's goes to the last
    first = docs.sparkSession.createDataFrame(before, "_range int, _first bigint, _to int")
    rows = rows.withColumn("_range", place).join(F.broadcast(first), "_range")  # MOST_RANGES rows at most
    goes = F.array(F.struct(F.col("_range"), F.lit(0).alias("_tail")))
    tail = F.array(F.struct(F.col("_to").alias("_range"), F.lit(1).alias("_tail")))
    goes = F.when(F.col("doc_id").eqNullSafe(F.col("_first")), F.concat(goes, tail)).otherwise(goes)
    return rows.select("doc_id", "text", F.explode(goes).alias("_p")).select("doc_id", "text", "_p._range", "_p._tail")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text is the document's first half (rounded up) and as many
    characters of the next document as were cut off."""
    small_batches(docs.sparkSession)
    rank = precedence(entropy_counts(docs, text))
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    names = [c.split()[0] for c in schema.split(", ")]

    def edit(text: str, after: str) -> bytes:
        cut = len(text) // 2
        return (text[:len(text) - cut] + after[:cut]).encode("utf-8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (id, text, filters) of the row before, until its next one is met
        for b in batches:
            rows = list(zip(*(c.to_pylist() for c in b.columns)))
            own = digests([t.encode("utf-8") for _, t, _, _ in rows], rank)
            pairs = []
            for (doc, t, _, tail), mine in zip(rows, own):
                if last is not None:
                    pairs.append((*last, t, mine))
                last = None if tail else (doc, t, mine)
            edited = [edit(t, after) for _, t, _, after, _ in pairs]
            theirs = digests(edited, rank)
            if pairs:
                yield pa.RecordBatch.from_arrays([
                    pa.array([p[0] for p in pairs], pa.int64()), pa.array([len(p[1]) for p in pairs], pa.int64()),
                    pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
                    pa.array([encode(p[2]) for p in pairs], pa.string()), pa.array([encode(f) for f in theirs], pa.string()),
                    pa.array([likeness(p[2], f) for p, f in zip(pairs, theirs)], pa.float64()),
                    pa.array([likeness(p[2], p[4]) for p in pairs], pa.float64())], names)

    rows = in_ranges(docs, id_col, text)
    return (rows.withColumn("_h", F.xxhash64("text")).repartition("_range")
            .sortWithinPartitions("_range", "_tail", "doc_id", "_h").select("doc_id", "text", "_range", "_tail")
            .mapInArrow(run, schema))


def query(spark, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
