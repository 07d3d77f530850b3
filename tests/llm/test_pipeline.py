import corpus_pipeline
from lodestone.llm import jaccard, packing, quality
from tests.helpers import rows


def test_stages_work_on_what_the_one_before_kept(spark, data, scratch):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    kept = {}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(name)
        stage(spark, now, data).write.parquet(path)
        now = spark.read.parquet(path)
        kept[name] = now
        if name != "packing":
            assert now.columns == docs.columns
    good = quality.quality_scores(docs, labels).filter("predicted = 1").select("doc_id")
    assert rows(kept["quality"], "doc_id") == rows(good)
    classes = jaccard.jaccard_join(kept["quality"])
    assert rows(kept["near_duplicates"], "doc_id") == rows(
        classes.select("class_id").distinct().withColumnRenamed("class_id", "doc_id"))
    assert kept["personal_data"].filter(r"text RLIKE '@mail\\d\\.example\\.com'").count() == 0
    assert kept["personal_data"].count() == kept["near_duplicates"].count()
    ids = {r[0] for r in kept["personal_data"].select("doc_id").collect()}
    assert {r[0] for r in kept["mixing"].select("doc_id").collect()} <= ids
    tokens = kept["mixing"].select("text").collect()
    total = sum(len(packing.token_ids(r[0])) + 1 for r in tokens)
    assert kept["packing"].agg({"length": "sum"}).first()[0] == total
    assert corpus_pipeline.run(spark, data).count() > 0
