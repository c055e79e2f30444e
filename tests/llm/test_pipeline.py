"""Each stage of the pipeline judged on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from caselog.llm import decontamination, quality_classifier, simhash
from caselog.sources.storage import save
from tests.llm import brute

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Input of each stage and the last result, as saved tables."""
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(save(stage(spark, docs[-1], SF), "stage"))
    return docs


def test_columns(stages):
    assert all(d.columns == stages[0].columns for d in stages[:-1])


def test_rejected_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = quality_classifier.classify(stages[0], labels).where("predicted = 1").select("doc_id")
    assert stages[1].select("doc_id").exceptAll(good).isEmpty() and good.exceptAll(stages[1].select("doc_id")).isEmpty()
    kept = labels.join(stages[1], "doc_id", "left_semi")
    assert kept.where("quality = 1").count() >= 0.98 * labels.where("quality = 1").count()


def test_one_of_each_group_stays(stages):
    rows = [tuple(r) for r in stages[1].select("doc_id", "text").collect()]
    least = brute.components([(d, brute.simhash(x)) for d, x in rows])
    assert sorted(r[0] for r in stages[2].select("doc_id").collect()) == sorted(least[f] for f in set(_representatives(least)))


def _representatives(least):
    first = {}
    for f, d in least.items():
        first.setdefault(d, f)
    return first.values()


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [tuple(r) for r in stages[2].select("doc_id", "text").collect()]
    clean = sorted(r[0] for r in brute.contaminated(rows, items) if not r[-1])
    assert sorted(r[0] for r in stages[3].select("doc_id").collect()) == clean


def test_secrets_are_replaced(stages):
    before = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    for r in stages[4].collect():
        if not brute.secrets(before[r["doc_id"]]):
            assert "[SECRET]" in r["text"] or r["text"] == before[r["doc_id"]]
        else:
            assert "[SECRET]" in r["text"] and not brute.secrets(r["text"])
    assert stages[4].count() == stages[3].count()


def test_all_that_is_left_is_packed(stages):
    packed = stages[5]
    assert packed.select("doc_id").distinct().count() == stages[4].count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()


def test_registered_and_without_copied_operators():
    assert queries()["pipeline"] is corpus_pipeline.run
    assert [f for _, f in corpus_pipeline.STAGES][1] is corpus_pipeline.near_duplicates
    assert simhash and decontamination
