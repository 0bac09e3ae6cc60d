"""The stages of the corpus pipeline, each on what the one before kept."""

import corpus_pipeline
import pytest
from conftest import SF
from ledgerline.llm import line_quality, pii, quality_crf
from test_near_copies import brute


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append(docs)
    return out


def ids(df):
    return {r[0] for r in df.select("doc_id").collect()}


def test_each_stage_does_its_part(spark, stages):
    docs, good, ruled, single, clean, packed = stages
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert ids(good) == {r["doc_id"] for r in quality_crf.scored(docs, labels).where("predicted = 1").collect()}
    assert ids(ruled) == {r["doc_id"] for r in line_quality.judged(good).where("kept").collect()}
    assert ids(single) == set(brute([(r["doc_id"], r["text"]) for r in ruled.collect()]).values())
    assert ids(clean) == ids(single)
    assert all(not pii.base_spans(r["text"]) for r in clean.collect())
    assert ids(packed) == ids(clean)
    for df in stages[:-1]:
        assert df.columns == docs.columns
    assert 0 < packed.count() and len(ids(good)) < docs.count()


def test_awkward_rows_pass_all_stages(spark):
    """Null ids and texts, repeated rows, a very long text and columns whose names the stages use themselves."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300")
    good = corpus_pipeline.quality_rules(spark, corpus_pipeline.quality_classifier(spark, docs, SF), SF).orderBy("doc_id").limit(3).collect()
    long = "\n".join(f"Sentence number {i} has words of its own, {i * 7} and {i * 13}." for i in range(20_000))
    rows = [(None, good[0]["text"], "en", "host", 5), (None, "", "en", "host", 0), (None, None, None, None, None), (None, good[1]["text"] + " end.", "en", None, 5)]
    rows += [(10**6, good[2]["text"] + " more.", "en", "host", 5)] * 3 + [(10**6 + 1, long, "en", "host", len(long)), (10**6 + 2, None, "en", "host", 0), (10**6 + 3, "short", None, "host", 5)]
    extra = spark.createDataFrame(rows, docs.schema)
    names = ("fp", "key", "component_id", "n_words", "shard", "row", "bin_id", "kept", "score", "cluster", "value", "root", "mark", "lines")
    given = docs.unionByName(extra).selectExpr("*", *[f"'clash' {n}" for n in names]).repartition(5)
    for name, stage in corpus_pipeline.STAGES:
        before, given = given, stage(spark, given, SF).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert given.columns == before.columns and given.where("kept = 'clash' and lines = 'clash'").count() == given.count() > 0
        if name == "quality_rules":  # judged by their own texts, also where ids are null
            left = [(r["doc_id"], r["text"]) for r in given.where("doc_id is null or doc_id >= 1000000").collect()]
            assert {i for i, t in left if not t or t == "short"} == set()
            assert left.count((None, rows[0][1])) == 1 and left.count((None, rows[3][1])) == 1
    packed = given.collect()
    assert sum(r["n_words"] for r in packed if r["doc_id"] == 10**6 + 1) in (0, len(long.split()))
    assert any(r["doc_id"] is None for r in packed)


def test_empty_input(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
