import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestone.operators import metrics, models, text
from lodestone.operators.text import TopicModel, lexical_richness, term_weights
from lodestone.plans.registry import Tables
from tests.helpers import rows


def test_split_is_stable_under_repartitioning(spark):
    df = spark.range(5000)
    left = rows(models.stable_split(df, "id"))
    assert left == rows(models.stable_split(df.repartition(7), "id"))
    share = sum(r[1] for r in left) / len(left)
    assert share == pytest.approx(0.8, abs=0.02)


def test_metrics(spark):
    df = spark.createDataFrame([(3.0, 2.0), (5.0, 5.0), (7.0, 9.0)], "y double, p double")
    got = metrics.regression_metrics(df, "y", "p").first()
    assert (got["n"], got["mae"], got["rmse"], got["r2"]) == (3, 1.0, 1.291, 0.375)
    labels = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")],
                                   "l string, p string")
    report = {r["class"]: r for r in metrics.class_report(labels, "l", "p").collect()}
    assert (report["a"]["precision"], report["a"]["recall"], report["a"]["support"]) == (0.5, 0.5, 2)
    assert report["c"]["f1"] == 0.0 and report["accuracy"]["f1"] == 0.5
    assert report["macro avg"]["recall"] == 0.5


def test_tfidf_is_the_smooth_unit_form(spark):
    import math
    df = spark.createDataFrame([("x", "apple apple pear"), ("y", "pear plum")], "g string, t string")
    got = {(r["g"], r["term"]): r["score"] for r in term_weights(df, "g", "t", stop=[]).collect()}
    rare, common = math.log(3 / 2) + 1, 1.0
    # x: apple 2, pear 1, "apple apple" 1, "apple pear" 1
    length = math.sqrt((2 * rare) ** 2 + common ** 2 + 2 * rare ** 2)
    assert got[("x", "apple")] == round(2 * rare / length, 4)
    assert got[("x", "pear")] == round(common / length, 4)
    assert ("y", "pear plum") in got
    rich = dict(rows(lexical_richness(df, "g", "t", stop=[])))
    assert rich["y"] == pytest.approx((common + rare) / math.hypot(common, rare))


def _slow_weights(data, vocab, top):
    counts = {}
    for g, t in data:
        ws = re.findall(r"\w{2,}", t or "") if g is not None else []
        for term in ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]:
            counts.setdefault(term, Counter())[g] += 1
    kept = sorted(counts, key=lambda x: (-sum(counts[x].values()), x))[:vocab]
    groups = {g for g, _ in data if g is not None}
    out = []
    for g in groups:
        w = {x: counts[x][g] * (math.log((1 + len(groups)) / (1 + len(counts[x]))) + 1)
             for x in kept if counts[x][g]}
        length = math.sqrt(sum(v * v for v in w.values()))
        best = sorted((-round(v / length, 4), x) for x, v in w.items())[:top]
        out += [(g, x, -v) for v, x in best]
    return sorted(out)


@pytest.mark.parametrize("vocab", (1, 4, 9, 40, 10_000))
def test_weights_of_pairs_with_rare_words(spark, monkeypatch, vocab):
    """Pairs that cannot be in the vocabulary are not counted; ties at its end change nothing."""
    rng = random.Random(vocab)
    names = [f"w{i:02}" for i in range(30)]
    data = [(rng.choice("abc"), " ".join(names[min(29, int(rng.paretovariate(0.8)))] for _ in range(8)))
            for _ in range(12)]
    data += [("a", " ".join(f"once{i:03}" for i in range(200))), ("b", "zz yy zz yy"), (None, "w01 w02"),
             ("c", None), ("a", "")]
    made = []
    real = text.group_terms

    def counted(*args):
        out = real(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(text, "group_terms", counted)
    df = spark.createDataFrame(data, "g string, t string").repartition(3)
    got = rows(text.term_weights(df, "g", "t", vocab, 10, stop=[]), "g", "term", "score")
    assert sorted(got) == [(g, x, pytest.approx(v, abs=2e-4)) for g, x, v in _slow_weights(data, vocab, 10)]
    assert vocab > 9 or sum(made) < 400  # the 200 words met once alone make 199 pairs


def test_pipeline_tfidf_matches_the_table_form(spark):
    from pyspark.ml.functions import vector_to_array
    df = spark.createDataFrame([(1, "apple apple pear"), (2, "pear plum"), (3, "")],
                               "id int, t string")
    model = models.fit_tfidf(df, "t", 100, "v", stop=[])
    total = F.aggregate(vector_to_array("v"), F.lit(0.0), lambda a, x: a + x)
    sums = dict(rows(model.transform(df).select("id", total)))
    rich = dict(rows(lexical_richness(df, "id", "t", stop=[])))
    assert sums == pytest.approx(rich)


def test_clusters_and_difficulty(spark):
    data = [(i, float(i % 3) * 10 + (i % 5) * 0.01, i % 3) for i in range(90)]
    df = spark.createDataFrame(data, "id int, v double, w int")
    out = models.difficulty(df, ["v", "w"])
    by_level = rows(out.groupBy("level").agg(F.round(F.avg("w"), 2), F.count("id")))
    assert by_level == [("1 - Basic", 0.0, 30), ("2 - Intermediate", 1.0, 30),
                        ("3 - Advanced", 2.0, 30)]


def test_weights_are_balanced(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "l string")
    assert dict(rows(models.balanced_weights(df, "l"))) == {"a": 4 / 6, "b": 2.0}


def test_classifier_beats_the_majority(spark, data):
    docs = Tables(spark, data).documents
    held = models.classify_forest(docs, "doc_id", "lang", "text", ["n_chars"], vocab=200, trees=5)
    got = held.agg(F.avg((F.col("lang") == F.col("prediction")).cast("double"))).first()[0]
    assert got > 0.8


def test_too_few_rows(spark):
    df = spark.createDataFrame([(1, "a", "t")], "id int, l string, t string")
    with pytest.raises(ValueError):
        models.classify_svm(df, "id", "l", "t")


def test_regressions_beat_the_mean(spark, data):
    part = Tables(spark, data).part.withColumn("key_half", F.col("p_partkey") / 2)
    bake = models.RegressionBakeOff(part, "p_partkey", "p_retailprice", ["key_half"], ["p_type"],
                                    "p_name", trees=5)
    best = bake.best()
    scores = {r["model"]: r["r2"] for r in bake.scores.collect()}
    assert scores[best] > 0.9
    assert bake.importances("forest", 1).first()["feature"] == "key_half"


def test_topics(spark, data):
    docs = Tables(spark, data).documents
    model = TopicModel(docs, "text", 3, vocab=200, rounds=2)
    assert model.terms(4).count() == 12
    assert model.assign(docs).filter(~F.col("topic").isin(0, 1, 2)).count() == 0


def test_svm_works_in_an_observed_session(spark):
    """An observation leaves something in the session that cannot be sent to tasks."""
    from pyspark.sql import Observation
    seen = Observation()
    df = spark.range(200).selectExpr("id", "if(id % 2 = 0, 'even', 'odd') AS label",
                                     "if(id % 2 = 0, 'two four', 'one three') AS text")
    df.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    held = models.classify_svm(df, "id", "label", "text", rounds=5).collect()
    assert held and all(r["label"] == r["prediction"] for r in held)


def test_learners_get_dealt_rows(spark, monkeypatch):
    """Rows of one partition and of one class reach the learner in many partitions."""
    seen = []
    original = models.RandomForestClassifier.fit

    def fit(self, df, *args):
        sizes = df.groupBy(F.spark_partition_id()).count().collect()
        seen.append((len(sizes), max(r["count"] for r in sizes) / df.count()))
        return original(self, df, *args)

    monkeypatch.setattr(models.RandomForestClassifier, "fit", fit)
    df = spark.range(2000).coalesce(1).selectExpr("id", "if(id % 20 = 0, 'a', 'b') AS label",
                                                  "if(id % 20 = 0, 'one two', 'three') AS text")
    models.classify_forest(df, "id", "label", "text", ["id"], trees=2)
    parts, largest = seen[0]
    assert parts > 1 and largest < 0.5


def test_topic_share_reads_the_texts_twice(spark):
    """Once for the vocabulary and once for the counts, which serve for the topics of the rows too."""
    from lodestone.plans import jobs
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(x):
        read.add(1)
        return x

    df = spark.range(200).selectExpr("id", "if(id % 4 = 0, null, 'Junior') AS job_level",
                                     "if(id % 2 = 0, 'alpha beta', 'gamma delta') AS text")
    df = df.select("job_level", noted("text").alias("description_clean"))
    got = {r[0]: sum(r[1:]) for r in jobs.topic_share(df, n=2).collect()}
    assert got == {"Junior": pytest.approx(1, abs=1e-3), "Unknown": pytest.approx(1, abs=1e-3)}
    assert read.value <= 2 * 200
    model = TopicModel(df, "description_clean", 2, rounds=2, keep=["job_level"])
    assert rows(model.assigned()) == rows(model.assign(df).select("job_level", "topic"))


def test_svm_reads_the_texts_twice_and_predicts_without_python(spark):
    """Once for the vocabulary and once for the counts; the fits and the prediction read the counts."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(x):
        read.add(1)
        return x

    df = spark.range(300).selectExpr("id", "elt(id % 3 + 1, 'a', 'b', 'c') AS label",
                                     "elt(id % 3 + 1, 'one two', 'three', 'four two') AS text")
    df = df.withColumn("text", noted("text"))
    held = models.classify_svm(df, "id", "label", "text", rounds=5)
    assert "EvalPython" not in held._jdf.queryExecution().executedPlan().toString()
    got = held.collect()
    assert len(got) > 30 and all(r["label"] == r["prediction"] for r in got)
    assert read.value <= 2 * 300


def test_elbow_folds_equal_rows(spark, monkeypatch):
    """The sweep passes over the different vectors; their weights keep the sum over all rows."""
    seen = []
    original = models.KMeans.fit

    def fit(self, df, *args):
        seen.append(df.count())
        return original(self, df, *args)

    monkeypatch.setattr(models.KMeans, "fit", fit)
    df = spark.range(900).selectExpr("if(id % 3 = 0, 1000, 0) + id % 2 AS x")
    shaped = models.VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    found = {r["k"]: r["inertia"] for r in models.elbow(shaped, [2, 4]).collect()}
    assert seen == [4, 4]
    assert found[2] == pytest.approx(900 * 0.25) and found[4] == pytest.approx(0)


def test_difficulty_learns_from_stored_numbers(spark, data):
    """The fits do not run through the joins that made the numbers."""
    from lodestone.plans import jobs
    from lodestone.plans.queries_jobs import adverts
    graded = jobs.job_difficulty(adverts(Tables(spark, data)))
    assert "documents.parquet" not in graded._jdf.queryExecution().optimizedPlan().toString()
    assert not any("documents" in name for name in graded.inputFiles())
    assert graded.count() == Tables(spark, data).part.count()


def test_one_against_rest_makes_the_library_s_machines(spark):
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.linalg import Vectors
    from lodestone.operators.svm import one_against_rest
    rows = []
    for i in range(240):
        at = sorted({i % 3 * 4 + i % 5, 12 + i * i % 7, 12 + i % 4})
        x = Vectors.sparse(20, at, [1.0 + i % 6] * len(at)) if i % 50 else Vectors.sparse(20, [], [])
        rows.append((i, Vectors.dense(x.toArray()) if i % 4 == 1 else x, float(i % 3), 0.5 + i % 3))
    df = spark.createDataFrame(rows, ["k", "x", "y", "w"])
    for k, mine in enumerate(one_against_rest(df, "k", "x", "y", "w", 3, 8, 0.01)):
        own = LinearSVC(maxIter=8, regParam=0.01, standardization=False, featuresCol="x", labelCol="l", weightCol="w")
        its = own.fit(df.withColumn("l", (F.col("y") == k).cast("double")))
        assert mine.coefficients.toArray() == pytest.approx(its.coefficients.toArray(), abs=1e-9)
        assert mine.intercept == pytest.approx(its.intercept, abs=1e-9)


def test_machines_of_all_classes_share_their_passes(spark):
    """The number of jobs does not grow with the number of classes."""
    df = spark.range(400).selectExpr("id", "concat('l', id % 16) AS label", "concat('word', id % 16) AS text")
    spark.sparkContext.setJobGroup("machines", "")
    try:
        held = models.classify_svm(df, "id", "label", "text", rounds=4)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("machines"))
    assert 0 < jobs < 100
    assert all(r["label"] == r["prediction"] for r in held.collect())
