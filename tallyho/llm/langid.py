"""Language identification with error-correcting output codes.

Each language has a codeword of +1/-1 bits. One binary classifier a bit (ridge
regression on hashed character 2- and 3-gram frequencies, whole text) predicts
that bit; loss-weighted decoding adds the squared hinge loss of each bit's
margin against a codeword, weighted by how well the bit separates its two
sides in training, and takes the language of least loss. A small lead over
the second marks the prediction as ambiguous.

The model is fitted on a bounded sample of labelled documents: at most about
``SAMPLE`` documents, spread evenly over the languages, picked by a hash of
the id, so the sample does not depend on the table's order. Everything else
covers all rows, row by row.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
rows with a null language are never trained on; without any training row all
rows are ``und``; with one language it is predicted with score 1; an empty
table gives an empty result; repeated rows count as rows; other columns are
ignored (the language, source and id are never inputs of a prediction).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, small_batches, table

#: Labelled documents in the training sample, over all languages.
SAMPLE = 2000
#: Hashed n-gram features.
WIDTH = 4096
RIDGE = 1e-3
#: Leads (difference of the two least mean losses) under this are ambiguous.
AMBIGUOUS = 0.02
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
_SNIPPET = 60


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed 2- and 3-grams of the lower-cased text."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + c[2:] * np.uint32(0x27D4EB2F)
    counts = np.bincount(two >> np.uint32(20), minlength=WIDTH) + np.bincount(three >> np.uint32(20), minlength=WIDTH)
    x = np.sqrt(counts, dtype=np.float32)
    return x / np.linalg.norm(x)


def codewords(n: int) -> np.ndarray:
    """n rows of +1/-1 bits: the exhaustive code up to 6 languages (every split of
    them once), beyond a fixed random code of distinct splits, 15 log2(n) bits long."""
    if n <= 1:
        return np.ones((n, 0), np.float32)
    if n <= 6:
        cols = [(1, *rest) for rest in product((1, -1), repeat=n - 1)][1:]
        return np.array(cols, np.float32).T
    rng = np.random.default_rng(7)
    bits = int(np.ceil(15 * np.log2(n)))
    seen: dict[tuple, None] = {}
    while len(seen) < bits:
        col = rng.permutation(np.where(np.arange(n) < n // 2, 1, -1))
        seen.setdefault(tuple(col * col[0]))
    return np.array(list(seen), np.float32).T


class Model:
    """langs, their codewords, a weight vector and a bias a bit, a weight a bit."""

    def __init__(self, langs: list[str], code: np.ndarray, w: np.ndarray, bias: np.ndarray, trust: np.ndarray):
        self.langs, self.code, self.w, self.bias, self.trust = langs, code, w, bias, trust

    def decode(self, x: np.ndarray) -> list[tuple[str, float, bool]]:
        if len(self.langs) < 2:
            return [(self.langs[0], 1.0, False) if self.langs else (UNKNOWN, 0.0, True)] * len(x)
        margins = x @ self.w + self.bias
        loss = (np.maximum(0, 1 - margins[:, None, :] * self.code[None]) ** 2 * self.trust).mean(axis=2)
        best = loss.argmin(axis=1)
        rows = np.arange(len(x))
        share = np.exp(-8 * (loss - loss[rows, best][:, None]))
        two = np.partition(loss, 1, axis=1)[:, :2]
        lead = two[:, 1] - two[:, 0]
        score = share[rows, best] / share.sum(axis=1)
        return [(self.langs[b], float(s), bool(d < AMBIGUOUS)) for b, s, d in zip(best, score, lead)]


def ridge(x: np.ndarray, y: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Dual weights of ridge regression with a bias, (xx' + 1 + ridge) a = y, by
    conjugate gradients: no matrix but ``x`` is held."""
    apply = lambda v: x @ (x.T @ v) + v.sum(axis=0) + np.float32(RIDGE * len(x)) * v
    a, r = np.zeros_like(y), y.copy()
    p, rr = r.copy(), (r * r).sum(axis=0)
    start = rr.copy()
    for _ in range(rounds):
        ap = apply(p)
        step = rr / np.maximum((p * ap).sum(axis=0), 1e-30)
        a += step * p
        r -= step * ap
        now = (r * r).sum(axis=0)
        if (now <= 1e-8 * start).all():
            break
        p = r + now / np.maximum(rr, 1e-30) * p
        rr = now
    return a


def fit(rows: list[tuple[str, str]]) -> Model:
    """``rows``: (language, text) of the sample. Each text also trains by a short
    snippet, so that short texts are met in training. Texts without a letter teach
    nothing: a language that has no others is not learned."""
    rows = [(lang, text) for lang, text in rows if LETTER.search(text)]
    langs = sorted({lang for lang, _ in rows})
    code = codewords(len(langs))
    if len(langs) < 2:
        return Model(langs, code, np.zeros((WIDTH, 0), np.float32), np.zeros(0), np.zeros(0))
    at = {lang: i for i, lang in enumerate(langs)}
    x, y = np.empty((2 * len(rows), WIDTH), np.float32), []
    for lang, text in sorted(rows):
        start = crc32(text.encode("utf-8", "surrogatepass")) % max(1, len(text) - _SNIPPET)
        for t in (text, text[start:start + _SNIPPET]):
            if LETTER.search(t):
                x[len(y)] = features(t)
                y.append(at[lang])
    x, y = x[:len(y)], code[np.array(y, int)]
    n = np.maximum((y[:, :, None] == np.array([1, -1])).sum(axis=0), 1)  # texts on either side of each bit
    alpha = ridge(x, y)
    w, bias = x.T @ alpha, alpha.sum(axis=0)
    margin = np.clip((x @ w + bias) * y, -1, 1).mean(axis=0)
    trust = np.maximum(margin, 0.05) * np.minimum(1, n.min(axis=1) / 10)
    return Model(langs, code, w, bias, (trust / trust.mean()).astype(np.float32))


def training_sample(docs: DataFrame, id_col: str, text: str, lang: str, most: int = SAMPLE) -> DataFrame:
    """(lang, text) of about ``most`` labelled, not held-out documents, evenly over
    the languages: a row is in if the hash of its id is under its language's share."""
    known = docs.where(F.col(lang).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    sizes = {r[lang]: r["count"] for r in known.groupBy(lang).count().collect()}  # a row a language
    if not sizes:
        return known.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    each = max(1, most // len(sizes))
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col(lang) == name, each / n).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.lit("language sample"), id_col), F.lit(1 << 20)) / float(1 << 20)
    return known.where((drawn < share) & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", most: int = SAMPLE) -> Model:
    return fit([(r["lang"], r["text"]) for r in training_sample(docs, id_col, text, lang, most).collect()])


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all but the added names) and lang_pred, score, ambiguous."""
    small_batches(docs.sparkSession)
    added = ["lang_pred", "score", "ambiguous"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = docs.select(F.struct(*keep).alias("_row"), F.col(text).alias("_text"))  # no name can clash
    schema = rows.select("_row").schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.code, model.w, model.bias, model.trust))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for b in batches:
            for part in range(0, b.num_rows, 256):  # at most 256 rows of features at a time
                piece = b.slice(part, 256)
                out = [(UNKNOWN, 0.0, True)] * piece.num_rows
                at, x = [], []
                for i, t in enumerate(piece.column(piece.num_columns - 1)):
                    t = t.as_py()
                    if t is not None and LETTER.search(t):
                        at.append(i)
                        x.append(features(t))
                if x:
                    for i, r in zip(at, m.decode(np.array(x))):
                        out[i] = r
                lang, score, vague = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(vague, pa.bool_())],
                    ["_row", *added])

    return rows.mapInArrow(run, schema).select("_row.*", *added)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = predict(docs, train(docs), keep=["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
