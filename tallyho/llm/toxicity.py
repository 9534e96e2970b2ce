"""Toxicity by maximum-scoring segments of token log-odds.

Training counts, over labelled documents, in how many toxic and clean ones
each word and each word beginning (4 to 6 letters) occurs. Their log-odds with
an informative Dirichlet prior (the pooled frequencies, as strong as a share
``PRIOR`` of the documents) score a token when they are ``LEAST`` and their
z-score ``Z`` or more; a word takes the longest of its features that does, so
unseen forms score by their stem. Other tokens cost ``NEUTRAL``. A linear scan (Ruzzo and Tompa) finds every maximal
scoring segment of a text, that is every toxic passage.

Segments are calibrated as in local alignment: lambda solves
sum p(s) exp(lambda s) = 1 over the clean tokens' scores, K is fitted to the
best segments of clean texts, and a segment's log significance in a text of m
tokens is lambda S - ln(K m). A text adds up its best segment's value and
every other one above 0; a logistic curve fitted on the training documents
(with the classes' true shares as prior) turns that into the score.

The model is fitted on a bounded sample: at most about ``SAMPLE`` documents of
either label, picked by a hash of the id, never held-out ones; it keeps at
most ``FEATURES`` features. Scoring covers all rows, row by row.

Defined cases: null and empty texts have no token and get the score of a text
with no toxic passage; rows with a null label or id are never trained on, and
a document labelled twice is toxic if either row says so; with no toxic (or
no clean) training row every score is the toxic share (0 without labels); an
empty table gives an empty result; repeated rows count as rows; other columns
are ignored (labels, language, source and id are never inputs of a score).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Memo, held_out, saved, small_batches, table

#: Training documents of either label, at most about.
SAMPLE = 8000
#: Features kept, those of most toxic documents first.
FEATURES = 50_000
#: Strength of the prior as a share of the training documents.
PRIOR = 0.1
Z = 3.0
#: Least log-odds of a feature: with many documents even small differences, such as
#: longer texts on one side, have large z-scores.
LEAST = 1.5
NEUTRAL = 0.1
STEMS = (4, 5, 6)
#: Tokens whose score a worker remembers, twice at most.
REMEMBERED = 150_000
WORD = re.compile(r"[^\W\d_]+")
_CAP = 40.0
#: Log significance of a text without a toxic passage.
NO_PASSAGE = -10.0
PASSAGES = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
                                     T.StructField("score", T.DoubleType())]))
_SEGMENTS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))


def word_features(word: str) -> list[str]:
    """Longest first: the word itself, then its beginnings."""
    return [f"={word}", *(f"^{word[:n]}" for n in sorted(STEMS, reverse=True) if len(word) >= n)]


def token_score(token: str, odds: dict[str, float]) -> float:
    """Score of a white-space token: its best word's."""
    best = -NEUTRAL
    for w in WORD.findall(token.lower()):
        best = max(best, next((s for f in word_features(w) if (s := odds.get(f)) is not None), best))
    return best


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), in linear time.

    Each kept segment links to the nearest earlier one that starts from a lower
    running sum, so the search for it never walks over a segment twice."""
    hits = np.flatnonzero(scores > 0)
    if not len(hits):
        return []
    after = np.cumsum(scores, dtype=np.float64)
    kept: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, link
    for i in hits.tolist():
        first, low, high = i, float(after[i] - scores[i]), float(after[i])
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= high:
                kept.append((first, i, low, high, j))
                break
            first, low, link = kept[j][0], kept[j][2], kept[j][4]
            del kept[j:]
            j = link
    return [(a, b, high - low) for a, b, low, high, _ in kept]


class Model:
    def __init__(self, odds: dict[str, float], lam: float = 1.0, log_k: float = 0.0, slope: float = 0.0, at: float = 0.0):
        self.odds, self.lam, self.log_k, self.slope, self.at = odds, lam, log_k, slope, at
        self.scores = Memo(lambda token: token_score(token, odds), REMEMBERED)

    def passages(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of tokens, and every maximal segment over them."""
        tokens = (text or "").split()
        scores = self.scores
        return len(tokens), maximal_segments(np.fromiter(map(scores.__getitem__, tokens), np.float64, len(tokens)))

    def significance(self, m: int, segments: list[tuple[int, int, float]]) -> float:
        if not segments:
            return NO_PASSAGE  # however short the text is
        base = self.log_k + np.log(max(m, 1))
        values = sorted((self.lam * s - base for _, _, s in segments), reverse=True)
        return float(np.clip(values[0] + sum(v for v in values[1:] if v > 0), -_CAP, _CAP))

    def probability(self, x: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * x + self.at, -500, 500))))


def log_odds(counts: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """(f, t, odds) of the features (f, t, c) of ``LEAST`` log-odds and a
    z-score of ``Z`` or more."""
    strength = PRIOR * (n_toxic + n_clean)
    a = f"{PRIOR}D * (t + c)"  # the pooled frequency times the strength (doubles: decimals would lose digits)
    odds = (f"ln((t + {a}) / ({n_toxic + strength}D - t - {a})) - ln((c + {a}) / ({n_clean + strength}D - c - {a}))")
    rows = counts.where(f"t >= 3 AND t <= {n_toxic} AND c <= {n_clean}").selectExpr("f", "t", "c", f"{odds} AS odds")
    return rows.where(f"odds >= {LEAST}D AND odds / sqrt(1 / (t + {a}) + 1 / (c + {a})) >= {Z}D").select("f", "t", "odds")


def karlin_lambda(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum p(s) exp(lambda s) = 1; 1 if no score is positive."""
    if not len(values) or values.max() <= 0 or (values * shares).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    f = lambda x: float((shares * np.exp(np.minimum(x * values, 600))).sum()) - 1
    while f(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def logistic(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and offset by Newton steps, weighted so that the toxic share is ``prior``."""
    w = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    a = np.stack([x, np.ones(len(x))], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (w * (y - p)) - 0.5 * beta * [1, 0]
        hess = (a * (w * p * (1 - p))[:, None]).T @ a + np.diag([0.5, 1e-6])
        step = np.linalg.solve(hess, grad)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text: str, most: int = SAMPLE):
    """((toxic, text) rows written once, the toxic share of all labelled training rows)."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("_id")).agg((F.max("toxic") > 0).cast("int").alias("_toxic")))
    sizes = {r["_toxic"]: r["count"] for r in known.groupBy("_toxic").count().collect()}  # two rows
    share = F.when(F.col("_toxic") == 1, min(1.0, most / sizes.get(1, 1))).otherwise(min(1.0, most / sizes.get(0, 1)))
    drawn = F.pmod(F.xxhash64(F.lit("toxicity sample"), "_id"), F.lit(1 << 20)) / float(1 << 20)
    picked = known.where(drawn < share)  # about 2 x most ids: bounded, so it may be broadcast
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(picked), "_id")
    return saved(rows.select("_toxic", "_text"), "toxicity-sample"), sizes.get(1, 0) / max(1, sum(sizes.values()))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> Model:
    small_batches(docs.sparkSession)
    sample, prior = training_sample(docs, labels, id_col, text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()
        for b in batches:
            for label, t in zip(b.column(0).to_pylist(), b.column(1)):
                words = set(WORD.findall((t.as_py() or "").lower()))
                (toxic if label else clean).update({f for w in words for f in word_features(w)})
            if len(toxic) + len(clean) > 400_000:
                yield counted(toxic, clean)
                toxic, clean = Counter(), Counter()
        yield counted(toxic, clean)

    def counted(toxic: Counter, clean: Counter) -> pa.RecordBatch:
        names = [*toxic, *(f for f in clean if f not in toxic)]
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([toxic[f] for f in names], pa.int64()),
             pa.array([clean[f] for f in names], pa.int64())], ["f", "t", "c"])

    totals = sample.agg(F.coalesce(F.sum("_toxic"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("n")).first()
    n_toxic, n_clean = totals["t"], totals["n"] - totals["t"]
    if not n_toxic or not n_clean:
        share = min(max(prior, 0.0), 1.0)
        return Model({}, at=-500.0 if share <= 0 else 500.0 if share >= 1 else float(np.log(share / (1 - share))))
    counts = sample.mapInArrow(count, "f string, t long, c long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    odds = {r["f"]: r["odds"] for r in log_odds(counts, n_toxic, n_clean).orderBy(F.desc("t"), "f").limit(FEATURES).collect()}
    plain = Model(odds)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, hits = [], []
            for t in b.column(1):
                found.append(plain.passages(t.as_py()))
                hits.append(sorted(Counter(round(plain.scores[w], 2) for w in (t.as_py() or "").split() if plain.scores[w] > 0).items()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([m for m, _ in found], pa.int64()),
                 pa.array([[s for _, _, s in segs] for _, segs in found], pa.list_(pa.float64())),
                 pa.array(hits, pa.map_(pa.float64(), pa.int64()))], ["toxic", "m", "s", "hits"])

    # of clean texts also how often each positive score occurs: only the sums come back
    found = saved(sample.mapInArrow(scan, "toxic int, m long, s array<double>, hits map<double,bigint>"), "toxicity-scan")
    hits = (found.where("toxic = 0").select(F.explode("hits").alias("s", "n")).groupBy("s").agg(F.sum("n").alias("n"))
            .orderBy("s").collect())  # scores of two decimals
    tokens = max(1, found.where("toxic = 0").agg(F.sum("m")).first()[0] or 0)
    values = np.array([r["s"] for r in hits] + [-NEUTRAL])
    shares = np.array([r["n"] / tokens for r in hits] + [0.0])
    shares[-1] = 1 - shares.sum()
    lam = karlin_lambda(values, shares)
    rows = found.select("toxic", "m", "s").collect()  # numbers of the sample's rows
    log_k = float(np.mean([lam * max(r["s"], default=0.0) - np.log(max(r["m"], 1)) for r in rows if not r["toxic"]]) - np.euler_gamma)
    model = Model(odds, lam, log_k)
    x = np.array([model.significance(r["m"], [(0, 0, s) for s in r["s"]]) for r in rows])
    model.slope, model.at = logistic(x, np.array([r["toxic"] for r in rows], float), prior)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all but the added names) and score, predicted,
    passages: (first token, last token, score) of every maximal segment."""
    small_batches(docs.sparkSession)
    added = ["score", "predicted", "passages"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = docs.select(F.struct(*keep).alias("_row"), F.col(text).alias("_text"))  # no name can clash
    schema = rows.select("_row").schema.add("score", "double").add("predicted", "integer").add("passages", PASSAGES)
    shared = docs.sparkSession.sparkContext.broadcast((model.odds, model.lam, model.log_k, model.slope, model.at))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for b in batches:
            found = [m.passages(t.as_py()) for t in b.column(b.num_columns - 1)]
            p = [m.probability(m.significance(n, segs)) for n, segs in found]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(p, pa.float64()), pa.array([int(x >= 0.5) for x in p], pa.int32()),
                 pa.array([[dict(zip(("first", "last", "score"), x)) for x in segs] for _, segs in found], _SEGMENTS)],
                ["_row", *added])

    return rows.mapInArrow(run, schema).select("_row.*", *added)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return (score(docs, model, keep=["doc_id"])
            .select("doc_id", held_out().alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages")))
