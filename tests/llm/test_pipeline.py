import corpus_pipeline as P
from llm.helpers import awkward, docs_of, prose

from tallyho.llm.common import saved

LABELS = "doc_id long, quality int, toxic int"


def write(spark, path, docs, labels):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def test_stages_apply_their_decisions(spark, tmp_path):
    rows, labels = [], []
    for i in range(300):
        words, toxic = prose(i, 60 + i % 40).split(), int(i % 6 == 0)
        if toxic:
            words[i % 50] = words[i % 50 + 5] = "scum"
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, toxic))
    rows.append((900, rows[1][1] + " end", "en", "s"))          # a near copy
    rows.append((901, rows[2][1], "en", "s"))                   # an exact copy
    rows.append((902, "12 34 56", "en", "s"))                   # no letter
    docs = write(spark, str(tmp_path), docs_of(spark, rows), labels)
    left = {}
    for name, stage in P.STAGES[:-1]:
        columns = docs.columns
        docs = saved(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == columns
        left[name] = {r.doc_id for r in docs.collect()}
    toxic = {i for i in range(0, 300, 6)}
    assert left["toxicity"] == {r[0] for r in rows} - toxic
    assert left["toxicity"] - left["language_id"] == {902}
    assert left["language_id"] - left["ngram_jaccard_join"] == {900, 901}
    whole = P.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in whole} == left["ngram_jaccard_join"]


def test_awkward_and_empty_tables(spark, tmp_path):
    for name, rows, labels in (("a", awkward(), [(1, 1, 1), (None, None, None), (9, 1, 0)]), ("e", [], [])):
        path = str(tmp_path / name)
        docs = write(spark, path, docs_of(spark, rows), labels)
        for step, stage in P.STAGES:
            docs = saved(stage(spark, docs, path), step)
        assert (docs.count() > 0) == bool(rows)


def test_stage_names():
    assert [n for n, _ in P.STAGES] == ["toxicity", "language_id", "ngram_jaccard_join", "packing"]
    assert P.ORACLE_SQL is None
