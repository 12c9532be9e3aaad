"""The pipeline's stages on a small corpus, each held to what it says of its own input."""

from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tallyworks.llm import jaccard, linededup, pii, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10_000, None, None, None, None), (10_001, "", "en", "x", 0), (None, "no id here", "en", "x", 10)], docs.schema)
    docs.unionByName(odd).withColumn("score", F.lit(1)).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    names, held = docs.columns, docs
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = held
        out = stage(spark, before, corpus)
        held = spark.createDataFrame(out.collect(), out.schema)
        if at < 4:
            assert held.columns == names, name
        ids, was = {r[0] for r in held.select("doc_id").collect()}, {r[0] for r in before.select("doc_id").collect()}
        texts = {r["doc_id"]: r["text"] for r in before.select("doc_id", "text").collect()}
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{corpus}/labels.parquet"))
            scores = before.select("doc_id", toxicity.scorer(before, model)(F.col("text"))["score"].alias("s")).collect()
            assert ids == {r["doc_id"] for r in scores if r["s"] < toxicity.THRESHOLD}
        elif name == "near_duplicates":
            found = jaccard.near_duplicates(before).collect()
            assert ids == {r["doc_id"] for r in found if r["doc_id"] is None or r["doc_id"] == r["component_id"]}
        elif name == "line_dedup":
            assert ids == was
            assert {r["doc_id"]: r["text"] for r in held.collect()} == {r["doc_id"]: r["text"] for r in linededup.without_repeats(before).collect()}
        elif name == "personal_data":
            assert ids == was
            assert all(r["text"] == (t and pii.redacted(t, pii.spans_of([t])[0][1])) for r in held.collect() for t in [texts[r["doc_id"]]])
        else:
            assert ids == was


def test_near_duplicates_go_by_row(spark):
    """One row of each group stays, whatever its id; a unique text under a copy's id stays too."""
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words, "and", "more"])
    rows = [
        (1, " ".join(words)), (2, near), (2, "a text of its own under the id of a near copy"),
        (None, " ".join(words)), (None, "no id but a copy of another row"), (None, "no id but a copy of another row"),
        (7, "the same row twice under one id"), (7, "the same row twice under one id"), (7, "THE same  row twice under one id"),
        (8, ""), (8, ""), (None, None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [((r["doc_id"], r["text"]), r["text"] and r["text"].lower().split()) for r in jaccard.first_of_each(df).collect()]
    assert len(got) == 7 and jaccard.first_of_each(df).columns == ["doc_id", "text"]
    plain = sorted([(i, t) for (i, t), _ in got if i != 7], key=repr)
    want = [(1, rows[0][1]), rows[2], rows[4], (8, ""), (8, ""), (None, None)]
    assert plain == sorted(want, key=repr) and [i for (i, _), _ in got].count(7) == 1


def test_run(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus)
    assert set(rows.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 2048
