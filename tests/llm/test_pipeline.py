"""The pipeline, stage by stage, against plain Python."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shelfwise.llm.tokens import default_vocabulary
from tests.llm.test_minhash import by_brute_force, classes_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, docs, SF_DIR).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_clean_documents_stay(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    clean = {r.doc_id for r in labels.filter("quality = 1 AND toxic = 0").collect()}
    poor = {r.doc_id for r in labels.filter("quality = 0").collect()}
    kept = set(texts(stages[1]))
    assert len(clean & kept) >= 0.95 * len(clean) and len(poor & kept) <= 0.3 * len(poor)
    assert all(t == texts(stages[0])[i] for i, t in texts(stages[1]).items())


def test_exact_copies_go(stages):
    groups = defaultdict(list)
    for i, t in texts(stages[1]).items():
        groups[t].append(i)
    assert set(texts(stages[2])) == {max(g) for g in groups.values()}


def test_one_of_each_class_stays(stages):
    rows = list(texts(stages[2]).items())
    groups = classes_of([i for i, _ in rows], by_brute_force(rows))
    assert set(texts(stages[3])) == {min(g) for g in groups}


def test_mix(stages):
    before, after = stages[3], stages[4]
    words = F.size(F.expr(r"regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+', 0)"))
    size = {r.source: r.n for r in before.groupBy("source").agg(F.sum(words).alias("n")).collect()}
    got = {r.source: r.n for r in after.groupBy("source").agg(F.sum(words).alias("n")).collect()}
    assert abs(sum(got.values()) - 1.5 * sum(size.values())) < 0.02 * sum(size.values())
    assert all(got[s] <= 2 * size[s] for s in got)
    assert after.filter("n_chars <> length(text)").isEmpty()


def test_packing(stages):
    exact = Tokenizer.from_file(default_vocabulary()[0])
    pieces = stages[5].collect()
    tokens = sum(len(exact.encode(r.text, add_special_tokens=False).ids) + 1 for r in stages[4].collect())
    assert sum(r.length for r in pieces) == tokens
    assert all(len(r.ids) == 4 * r.length for r in pieces)


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns == stages[5].columns
    tokens = lambda df: sorted(map(tuple, df.groupBy("doc_id").agg(F.sum("length"), F.max("doc_tokens")).collect()))
    assert tokens(rows) == tokens(stages[5])


def test_any_extra_columns_pass_all_stages(spark, stages, tmp_path):
    """Names in any case, with dots and backticks, and like those the operators use themselves."""
    names = ["Expected_Grade", "TAIL_probability", "a.b", "we`ird", "Keep_ID", "digest", "near_key", "row", "class", "ticket", "size", "words", "mixed", "others", "c0"]
    extra = stages[0].select("*", *(F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in names))
    docs = extra.unionByName(
        spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0), (-2, "good words " * 60_000, "en", "s", 0)], stages[0].schema), allowMissingColumns=True
    )
    for k, (_, function) in enumerate(corpus_pipeline.STAGES[:-1]):
        function(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == extra.columns
    quoted = lambda n: F.col("`" + n.replace("`", "``") + "`")
    wrong = [docs.filter((quoted(n) != F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string"))) & (F.col("doc_id") >= 0)) for n in names]
    assert all(df.isEmpty() for df in wrong)
    before = {r.doc_id for r in stages[4].select("doc_id").collect()}
    assert {r.doc_id for r in docs.select("doc_id").collect()} >= {i for i in before if i is not None and i >= 0}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert pieces.columns == stages[5].columns and pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
