"""N-gram Jaccard join by a token-group matrix.

A document is the set of its word n-grams (64-bit hashes); documents with
equal sets are one node. The join links nodes whose Jaccard similarity is at
least a threshold, in these steps:

1. Signatures find who may be similar. Sets of a size class are hashed into
   ``SPREAD`` times as many buckets as two linked sets can differ in tokens, at
   their own size class and the next; the sums of a node's filled buckets are its
   signatures. Linked sets differ in at most as many buckets as in tokens, so
   they share all filled ones but that many, and each may leave out the others
   but one: a node leaves out those that occur in most nodes (such as the buckets
   of a common passage). A set with too few filled buckets (rare) lists its
   tokens too: of two linked sets one shares a bucket, or they share a token.
   Beyond ``MOST`` buckets the first ``MOST`` are taken: an equal filled bucket has
   a chance over 0.43 at the threshold itself, so linked sets share no more than
   ``LEFT_OUT`` of them with a chance under 1e-12. ``most=None`` takes all.
2. Groups: a node joins the group of the least node that it shares a signature
   with, in chunks of about ``GROUP`` nodes and ``TOKENS`` tokens, each with that
   node as its leader. Links inside a group make first components.
3. The token-group matrix stores each group's token union. A node asks the
   groups that hold one of its signatures in another component (of two groups the
   smaller one's nodes ask): its overlap with the group's union bounds its
   similarity to all of the group's sets, and only where that reaches the
   threshold are they opened and compared.
4. Links end as connected components.

A group's union goes to its queries, in parts of about ``TOKENS`` tokens, not to
every pair; no pair of documents is listed outside such a part. Copies that are
linked already share a component and ask nothing of each other.

Defined cases: null texts and texts without a word have the empty set, link
with nothing and are their own component; a null id links like others but
names no component (null where it would be alone); rows with equal ids are
separate documents; an empty table gives an empty result; texts are whole,
however long; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import Memo, connected_components, free, saved, small_batches, table, worker_state

#: Buckets for each one that linked sets may differ in.
SPREAD = 1.25
#: Buckets of a size class that become signatures, by default, and of those the ones that
#: may be left out.
MOST = 64
LEFT_OUT = 2
#: Nodes of a group, about.
GROUP = 256
#: Tokens of a group and of the queries that it is compared with at a time, about (a set
#: beyond this is alone).
TOKENS = 1 << 20
#: Words whose hash a worker remembers, twice at most.
REMEMBERED = 200_000

LONGS = T.ArrayType(T.LongType())
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


def word_hashes() -> Memo:
    import xxhash

    return Memo(xxhash.xxh3_64_intdigest, REMEMBERED)


def shingles(text: str | None, n: int, words: Memo) -> np.ndarray:
    """The distinct hashed n-grams, sorted: words are runs without ASCII white space,
    A-Z lower-cased; fewer than n words are one shingle."""
    parts = (text or "").encode("utf-8").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    size = min(n, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for i in range(size):
        h = mix(h * _A + w[i:len(w) - size + 1 + i])
    return np.unique(h)


def size_classes(percent: int) -> tuple[list[int], list[int]]:
    """(least size, buckets) of every class. A class holds the sizes up to the largest
    that may link with its least, so partners are of the same or the next class; its
    buckets are one more than the tokens that sets up to this class may differ in."""
    lows, buckets, low = [], [], 1
    while low < 1 << 40:
        high = low * 100 // percent
        lows.append(low)
        buckets.append((100 - percent) * 2 * high // (100 + percent) + 1)
        low = high + 1
    return lows, buckets


def signatures(s: np.ndarray, classes: tuple[list[int], list[int]], most: int | None = MOST) -> list[tuple[np.ndarray, int]]:
    """(signatures, how many of them may be left out) at the set's size class and the next."""
    lows, buckets = classes
    level = bisect_right(lows, len(s)) - 1
    out = []
    for lv in (level, level + 1):
        needed = buckets[lv]
        if needed == 1:  # linked sets are equal sets: one node
            out.append((np.empty(0, np.uint64), 0))
            continue
        k = int(np.ceil(needed * SPREAD))
        taken = k if most is None else min(k, most)
        seed = mix(np.array([lv], np.uint64))
        place = (mix(s + seed) % np.uint64(k)).astype(np.int64)
        part = place < taken
        order = np.argsort(place[part], kind="stable")
        at, first = np.unique(place[part][order], return_index=True)
        sums = np.add.reduceat(mix(s[part][order] ^ _C), first) if len(at) else np.empty(0, np.uint64)
        sig = mix(mix(sums + seed) + at.astype(np.uint64))
        if taken < k:
            out.append((sig, LEFT_OUT))
        elif len(at) >= needed:
            out.append((sig, len(at) - needed))
        else:
            out.append((np.concatenate([sig, mix(mix(s ^ seed))]), 0))
    return out


def node_of(s: np.ndarray) -> int:
    total = mix(s).sum(dtype=np.uint64, keepdims=True) + _A * np.array([len(s)], np.uint64)
    return int(mix(total).view(np.int64)[0])


def sketches(docs: DataFrame, id_col: str, text: str, n: int, percent: int, most: int | None = MOST) -> DataFrame:
    """(doc_id, key, n, node, sigs, own, spare) for every row; of equal sets in a task only
    the first carries signatures. The first ``own`` are of the set's own size class, the others
    of the next; ``spare`` says how many of either may be left out. ``key`` is a hash of the text."""
    small_batches(docs.sparkSession)
    ints = T.ArrayType(T.IntegerType())
    schema = docs.select(F.col(id_col).alias("doc_id")).schema.add("key", "long").add("n", "long").add("node", "long") \
        .add("sigs", LONGS).add("own", "integer").add("spare", ints)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, classes = worker_state("shingle words", word_hashes), size_classes(percent)
        seen: set[int] = set()
        for b in batches:
            size, node, sigs, own, spare = [], [], [], [], []
            for t in b.column(2):
                s = shingles(t.as_py(), n, words)
                size.append(len(s))
                node.append(node_of(s) if len(s) else None)
                found = signatures(s, classes, most) if len(s) and node[-1] not in seen else []
                sigs.append(np.concatenate([x for x, _ in found]).view(np.int64) if found else [])
                own.append(len(found[0][0]) if found else 0)
                spare.append([x for _, x in found])
                if len(seen) < REMEMBERED:  # what a task remembers is bounded: others list theirs again
                    seen.add(node[-1])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(size, pa.int64()), pa.array(node, pa.int64()),
                 pa.array(sigs, pa.list_(pa.int64())), pa.array(own, pa.int32()), pa.array(spare, pa.list_(pa.int32()))],
                ["doc_id", "key", "n", "node", "sigs", "own", "spare"])

    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("key"), F.col(text)).mapInArrow(run, schema)


def sets_of(docs: DataFrame, id_col: str, text: str, wanted: DataFrame, n: int) -> DataFrame:
    """(node, tokens, ...) for the documents that ``wanted`` (doc_id, key, node, ...) names."""
    rest = [c for c in wanted.columns if c not in ("doc_id", "key")]
    found = (docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_key"), F.col(text).alias("_text"))
             .join(wanted, (F.col("_key") == F.col("key")) & F.col("_id").eqNullSafe(F.col("doc_id"))))
    found = found.select(*rest, "_text")
    schema = found.select(*rest).schema.add("tokens", LONGS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_state("shingle words", word_hashes)
        for b in batches:
            tokens = [shingles(t.as_py(), n, words).view(np.int64) for t in b.column(len(rest))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(tokens, pa.list_(pa.int64()))], [*rest, "tokens"])

    return found.mapInArrow(run, schema)


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of every set of ``a`` with every set of ``b``."""
    out = np.zeros((len(a), len(b)), np.int64)
    ta, tb = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(ta, tb)
    if not len(shared):
        return out

    def where(sets, tokens):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(shared, tokens)
        at[at == len(shared)] = 0
        hit = shared[at] == tokens
        return row[hit], at[hit]

    (ra, ca), (rb, cb) = where(a, ta), where(b, tb)
    for low in range(0, len(shared), 8192):  # a bounded block of tokens at a time
        width = min(8192, len(shared) - low)
        ma, mb = np.zeros((len(a), width), np.float32), np.zeros((len(b), width), np.float32)
        for m, r, c in ((ma, ra, ca), (mb, rb, cb)):
            own = (c >= low) & (c < low + width)
            m[r[own], c[own] - low] = 1
        out += np.rint(ma @ mb.T).astype(np.int64)
    return out


def linked(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    common = overlaps(a, b)
    union = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b]) - common
    return 100 * common >= percent * union


def _roots(node: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    parent = list(range(len(node)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in pairs.tolist():
        i, j = root(i), root(j)
        parent[max(i, j)] = min(i, j)
    return node[[root(i) for i in range(len(node))]]


def within(percent: int):
    """Links inside a group, as (grp, node, root)."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("node").sort_values("node")
        node, sets = group["node"].to_numpy(), list(group["tokens"])
        return pd.DataFrame({"grp": group["grp"].to_numpy(), "node": node,
                             "root": _roots(node, np.argwhere(linked(sets, sets, percent)))})

    return run


def qualify(percent: int):
    """Queries of a group whose overlap with its union may reach the threshold."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        union = part.loc[~part["query"], "tokens"].iloc[0]
        queries = part[part["query"]]
        keep = [100 * int(np.isin(t, union, assume_unique=True).sum()) >= percent * len(t) for t in queries["tokens"]]
        return queries.loc[keep, ["grp", "part", "node"]]

    return run


def between(percent: int):
    """Links of a part's queries with the opened group's sets, as (node, root)."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        q, o = part[part["query"]], part[~part["query"]]
        i, j = np.nonzero(linked(list(q["tokens"]), list(o["tokens"]), percent))
        node = np.concatenate([q["node"].to_numpy(), o["node"].to_numpy()])
        return pd.DataFrame({"node": node, "root": _roots(node, np.stack([i, j + len(q)], axis=1))})

    return run


def union_of(group: pd.DataFrame) -> pd.DataFrame:
    tokens = np.unique(np.concatenate(list(group["tokens"])))
    return pd.DataFrame({"grp": [int(group["grp"].iloc[0])], "tokens": [tokens]})


def components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80,
               most: int | None = MOST) -> DataFrame:
    """(doc_id, key, n_shingles, node, component_id) for every row; ``percent`` is
    the least Jaccard similarity in hundredths; ``most=None`` lists all signatures."""
    if n < 1 or not 50 < percent <= 100:
        raise ValueError("n must be 1 or more, percent over 50 and at most 100")
    rows = saved(sketches(docs, id_col, text, n, percent, most), "sketches")

    # signatures that two nodes share; of a node's, the ones in most nodes are left out
    least, greatest = F.min("node").alias("lo"), F.max("node").alias("hi")
    sigs = rows.selectExpr("node", "own", "spare", "posexplode(sigs) AS (i, sig)").selectExpr(
        "sig", "node", "i >= own AS next", "spare[IF(i < own, 0, 1)] AS spare")
    # (sets that both list it for the next size class are of one class, and share one of that)
    some = F.bool_and("next").alias("none")
    shared = saved(sigs.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), least, greatest, some)
                   .where("lo < hi AND NOT none").select("sig", "n"), "shared")
    common = Window.partitionBy("node", "next").orderBy(F.desc("n"), "sig")
    kept = sigs.join(shared, "sig").distinct().withColumn("nth", F.row_number().over(common)).where("nth > spare")
    kept = saved(kept.select("sig", "node", "next"), "kept")
    bounds = kept.groupBy("sig").agg(least, greatest, some).where("lo < hi AND NOT none").select("sig", "lo")
    posts = saved(kept.join(bounds, "sig"), "posts")

    # groups: the least shared node leads, in chunks
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "key")).alias("f"), F.min("n").alias("n"))
    led = posts.groupBy("node").agg(F.min("lo").alias("lead")).join(nodes, "node")
    size = led.groupBy("lead").agg(F.expr(f"greatest(ceil(count(1) / {GROUP}), ceil(sum(n) / {TOKENS}))").alias("parts"))
    led = led.join(size, "lead").select("f.doc_id", "f.key", "node", "n", "lead", F.xxhash64("lead", F.pmod(F.xxhash64("node"), "parts")).alias("grp"))
    sets = saved(sets_of(docs, id_col, text, led, n), "sets")
    member = sets.select("node", "n", "lead", "grp")
    leaders = sets.select("node", "tokens").join(member.select(F.col("lead").alias("node"), "grp").distinct(), "node")
    inside = saved(sets.select("grp", "node", "tokens").union(leaders.select("grp", "node", "tokens"))
                   .groupBy("grp").applyInPandas(within(percent), "grp long, node long, root long"), "inside")
    first = connected_components(inside.where("node <> root").selectExpr("node AS a", "root AS b"))
    member = member.join(first, "node", "left").withColumn("comp", F.coalesce("component", "node"))
    large = member.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    member = saved(member.join(large, "grp").select("node", "n", "grp", "size", "comp"), "groups")

    # who asks which group: a signature in common, another component, and the smaller group asks
    held = posts.select("sig", "node", "next").join(member, "node")
    mixed = held.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("sig")
    held = saved(held.join(mixed, "sig"), "held")
    at = held.groupBy("sig", F.col("grp").alias("other"), F.col("size").alias("other_size")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), some)
    asks = held.join(at, (held["sig"] == at["sig"]) & F.expr(
        "(size < other_size OR size = other_size AND grp < other) AND NOT (lo = comp AND hi = comp) AND NOT (next AND none)"))
    asks = asks.select("node", "n", F.col("other").alias("grp")).distinct()
    parts = asks.groupBy("grp").agg(F.ceil(F.sum("n") / TOKENS).alias("parts"))
    asks = saved(asks.join(parts, "grp").select("grp", F.pmod(F.xxhash64("node"), "parts").alias("part"), "node"), "asks")

    # the token-group matrix of the groups that are asked; sides go to (group, part of its queries)
    both = lambda q, o: (q.selectExpr("grp", "part", "node", "tokens", "true AS query")
                         .union(o.selectExpr("grp", "part", "node", "tokens", "false AS query")).groupBy("grp", "part"))
    asked_parts = asks.select("grp", "part").distinct()
    unions = (sets.select("grp", "tokens").join(asks.select("grp").distinct(), "grp", "left_semi")
              .groupBy("grp").applyInPandas(union_of, "grp long, tokens array<bigint>"))
    # ids are 64-bit: no nulls beside them, which pandas would turn into floating-point numbers
    bound = both(asks.join(sets.select("node", "tokens"), "node"), asked_parts.join(unions, "grp").withColumn("node", F.lit(0).cast("long")))
    open_for = saved(bound.applyInPandas(qualify(percent), "grp long, part long, node long"), "qualified")
    opened = open_for.select("grp", "part").distinct().join(sets.select("grp", "node", "tokens"), "grp")
    across = both(open_for.join(sets.select("node", "tokens"), "node"), opened).applyInPandas(between(percent), "node long, root long")
    across = saved(across.where("node <> root"), "across")

    edges = inside.select("node", "root").union(across).where("node <> root").selectExpr("node AS a", "root AS b")
    parts = connected_components(edges)
    free(shared, kept, posts, sets, inside, member, held, asks, open_for, across)
    least = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    least = least.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = least.groupBy("component").agg(F.min("least").alias("component_id"))
    named = least.join(names, "component").select("node", "component", "component_id")
    out = rows.select("doc_id", "key", "n", "node").join(named, "node", "left")
    return out.select("doc_id", "key", F.col("n").alias("n_shingles"), "component",
                      F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    found = components(table(spark, sf_dir, "documents"), n=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM w),
t AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM t a JOIN t b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y WHERE 100 * c >= 90 * (len(a.s) + len(b.s) - c)),
r(x, y) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
m AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id FROM s JOIN m ON m.x = s.doc_id
"""


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without all but one document of each component: the one of least id
    stays (of equal ids that of least text hash, of equal rows one). Documents
    with the empty set all stay."""
    found = saved(components(docs, id_col, text, n, percent), "components")
    best = (found.where("component IS NOT NULL").groupBy("component")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "key")).alias("f")).select("f.doc_id", "f.key"))
    alone = found.where("component IS NULL").select("doc_id", "key").distinct()
    stay = best.withColumn("once", F.lit(True)).union(alone.withColumn("once", F.lit(False)))
    # the rows travel as one struct, so that none of their names can clash
    marked = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"))
    kept = marked.join(stay, (F.col("text_key") == F.col("key")) & F.col("id").eqNullSafe(F.col("doc_id")))
    order = Window.partitionBy("text_key", "id").orderBy(F.lit(0))
    kept = kept.withColumn("nth", F.row_number().over(order)).where("NOT once OR nth = 1")
    return kept.select("row.*")
