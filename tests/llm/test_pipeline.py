import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tideline.llm import leaks, mixing, near, queries, stages, toxicity


@pytest.fixture(scope="module")
def steps(spark, small, tmp_path_factory):
    """The rows that go into and come out of every stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs, seen = spark.read.parquet(f"{small}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(folder / str(k))
        stage(spark, docs, small).write.parquet(path)
        seen.append((name, docs, spark.read.parquet(path)))
        docs = spark.read.parquet(path)
    return seen


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "jaccard_join", "decontamination", "mixing", "token_output"]


def test_all_but_the_last_return_documents(steps):
    for name, before, after in steps[:-1]:
        assert after.columns == before.columns, name
        if name != "mixing":
            assert after.exceptAll(before).count() == 0, name


def test_decisions_take_effect(spark, small, steps):
    _, docs, kept = steps[0]
    model = toxicity.fit(docs, spark.read.parquet(f"{small}/labels.parquet"))
    assert kept.count() == sum(model.score(r["text"]) < 0.5 for r in docs.collect()) < docs.count()
    _, docs, kept = steps[1]
    assert near.near_copies(kept).agg(F.sum("links")).first()[0] == 0
    assert kept.count() == near.near_copies(docs).select("kept").distinct().count() < docs.count()
    _, docs, kept = steps[2]
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    assert leaks.find_leaks(kept, items).count() == 0
    assert docs.count() - kept.count() == leaks.find_leaks(docs, items).select("doc_id").distinct().count()
    _, docs, taken = steps[3]
    sized = docs.withColumn("_size", mixing.word_count(F.col("text")))
    assert taken.count() == mixing.copies(sized).agg(F.sum("_copies")).first()[0]
    _, docs, out = steps[4]
    assert out.select("slot").distinct().count() == out.count()
    assert out.select("doc_id").distinct().count() == docs.where("text <> ''").select("doc_id").distinct().count()


def test_run_gives_the_rows_of_the_last_stage(spark, small, steps):
    rows = corpus_pipeline.run(spark, small)
    assert rows.columns == steps[-1][2].columns
    assert rows.count() == steps[-1][2].count()
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_documents_pass_through(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("doc_id < 0")
    for _, stage in stages.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.count() == 0


def test_every_operator_has_one_query():
    numbers = {int(n.split("_")[0][2:]) for n in queries.QUERIES}
    assert numbers == set(range(1, 14))
