"""Queries: metrics, splits, topic models, clusters, classifiers and regressions."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lodestone.operators import aggregate as agg
from lodestone.operators import metrics, models
from lodestone.operators.text import TopicModel
from lodestone.plans.registry import Tables, query


@query("regression_metrics", """
WITH g AS (SELECT l_extendedprice AS y, l_extendedprice - l_quantity * 1500 AS gap FROM lineitem)
SELECT count(*) AS n, round(avg(abs(gap)), 4) AS mae, round(sqrt(avg(gap * gap)), 4) AS rmse,
  round(1 - avg(gap * gap) / var_pop(y), 4) AS r2 FROM g""")
def regression_metrics(t: Tables):
    """A price guessed from the quantity."""
    rows = t.lineitem.withColumn("guess", F.col("l_quantity") * 1500)
    return metrics.regression_metrics(rows, "l_extendedprice", "guess")


GUESS = """p AS (SELECT quality AS l, CASE WHEN n_chars > 600 THEN 1 ELSE 0 END AS g
                 FROM documents JOIN labels USING (doc_id))"""


def _guessed(t: Tables):
    """Quality guessed from the length of the text."""
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    return rows.withColumn("guess", F.when(F.col("n_chars") > 600, 1).otherwise(0))


@query("class_report", f"""
WITH {GUESS},
c AS (SELECT c, count(*) FILTER (l = c) AS support, count(*) FILTER (g = c) AS predicted,
             count(*) FILTER (l = c AND g = c) AS hits
      FROM p, (SELECT unnest([0, 1]) AS c) GROUP BY c),
r AS (SELECT c::VARCHAR AS class, support, hits, coalesce(hits / nullif(predicted, 0), 0) AS p,
             coalesce(hits / nullif(support, 0), 0) AS r FROM c),
f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM r)
SELECT class, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1, support FROM f
UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 4), round(sum(hits) / sum(support), 4),
  round(sum(hits) / sum(support), 4), sum(support)::BIGINT FROM f
UNION ALL SELECT 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4),
  sum(support)::BIGINT FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 4),
  round(sum(r * support) / sum(support), 4), round(sum(f * support) / sum(support), 4),
  sum(support)::BIGINT FROM f""")
def class_report(t: Tables):
    return metrics.class_report(_guessed(t), "quality", "guess")


@query("confusion_matrix", f"""
WITH {GUESS}
SELECT l AS quality, count(*) FILTER (g = 0) AS "0", count(*) FILTER (g = 1) AS "1",
  count(*) AS total FROM p GROUP BY l""")
def confusion_matrix(t: Tables):
    return metrics.confusion_matrix(_guessed(t), "quality", "guess", [0, 1])


@query("balanced_weights", """
SELECT doc_id, lang, round((SELECT count(*) FROM documents) / (
  (SELECT count(DISTINCT lang) FROM documents) * count(*) OVER (PARTITION BY lang)), 6) AS weight
FROM documents""")
def balanced_weights(t: Tables):
    rows = models.balanced_weights(t.documents.select("doc_id", "lang"), "lang")
    return rows.withColumn("weight", F.round("weight", 6))


@query("stable_split", """
SELECT doc_id, ('0x' || substr(md5(doc_id || ':42'), 1, 8))::BIGINT % 10000 < 8000 AS is_train
FROM documents""")
def stable_split(t: Tables):
    return models.stable_split(t.documents.select("doc_id"), "doc_id")


@query("topics")
def topics(t: Tables):
    return TopicModel(t.documents, "text").terms(10)


def _part_features(t: Tables):
    return models.scaled_features(t.part, ["p_retailprice", "p_size"], ["p_type", "p_brand"])[0]


@query("kmeans")
def kmeans(t: Tables):
    """Cluster profiles and the silhouette of the clustering."""
    rows, _ = models.kmeans(_part_features(t), 4)
    return agg.class_means(rows, "cluster", ["p_retailprice", "p_size"]).withColumn(
        "silhouette", F.lit(round(models.silhouette(rows), 4)))


@query("kmeans_elbow")
def kmeans_elbow(t: Tables):
    return models.elbow(_part_features(t))


@query("kmeans_centres")
def kmeans_centres(t: Tables):
    _, model = models.kmeans(_part_features(t), 4)
    return models.scaled_centres(model, ["price", "size", "type", "brand"], t.spark)


@query("pca")
def pca(t: Tables):
    rows, variance = models.pca_2d(_part_features(t))
    return rows.select("p_partkey", F.round("pc1", 6).alias("pc1"),
                       F.round("pc2", 6).alias("pc2")).withColumns(
        {"share1": F.lit(round(variance[0], 6)), "share2": F.lit(round(variance[1], 6))})


@query("classify_model")
def classify_model(t: Tables):
    """Language of a text by random forest."""
    held = models.classify_forest(t.documents, "doc_id", "lang", "text", ["n_chars"], trees=20)
    return metrics.class_report(held, "lang", "prediction")


@query("classify_svm")
def classify_svm(t: Tables):
    """Language of a text by linear SVM."""
    held = models.classify_svm(t.documents, "doc_id", "lang", "text", rounds=20)
    return metrics.class_report(held, "lang", "prediction")


def _regression(t: Tables) -> models.RegressionBakeOff:
    return models.RegressionBakeOff(
        t.part.withColumn("half", F.col("p_partkey") / 2), "p_partkey", "p_retailprice",
        ["p_size", "half"], ["p_type", "p_brand"], "p_name", trees=20)


@query("regress_model")
def regress_model(t: Tables):
    return _regression(t).scores


@query("feature_importances")
def feature_importances(t: Tables):
    return _regression(t).importances("forest", 20)


# Fitted models whose result is known in closed form -----------------------------------------


PAIR = """
z AS (SELECT p_partkey, (p_retailprice - avg(p_retailprice) OVER ()) / stddev_samp(p_retailprice) OVER ()
    AS z1, (p_size - avg(p_size) OVER ()) / stddev_samp(p_size) OVER () AS z2 FROM part),
r AS (SELECT corr(p_retailprice, p_size) AS r FROM part)"""


@query("features_scaled", """
WITH c AS (SELECT *, dense_rank() OVER (ORDER BY p_type) - 1 AS code FROM part)
SELECT p_partkey, round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_samp(p_retailprice) OVER (),
  6) AS price, round((code - avg(code) OVER ()) / stddev_samp(code) OVER (), 6) AS type FROM c""")
def features_scaled(t: Tables):
    rows, _ = models.scaled_features(t.part, ["p_retailprice"], ["p_type"])
    x = vector_to_array("features")
    return rows.select("p_partkey", F.round(x[0], 6).alias("price"), F.round(x[1], 6).alias("type"))


@query("pca_pair", f"""
WITH {PAIR}
SELECT p_partkey, round(abs(z1 + sign(r) * z2) / sqrt(2), 4) AS pc1,
  round(abs(z1 - sign(r) * z2) / sqrt(2), 4) AS pc2, round((1 + abs(r)) / 2, 6) AS share1 FROM z, r""")
def pca_pair(t: Tables):
    """Two standardised columns: their components are the sum and the difference."""
    rows, share = models.pca_2d(models.scaled_features(t.part, ["p_retailprice", "p_size"])[0])
    return rows.select("p_partkey", F.round(F.abs("pc1"), 4).alias("pc1"),
                       F.round(F.abs("pc2"), 4).alias("pc2"), F.lit(round(share[0], 6)).alias("share1"))


APART = """
a AS (SELECT l_returnflag = 'R' AS far, l_quantity + CASE WHEN l_returnflag = 'R' THEN 1000 ELSE 0 END AS v,
    l_discount FROM lineitem)"""


def _apart(t: Tables):
    """Lines in two groups far apart: whatever the beginning, two clusters are these groups."""
    far = F.when(F.col("l_returnflag") == "R", 1000).otherwise(0)
    return t.lineitem.select((F.col("l_quantity") + far).alias("v"), "l_discount")


@query("kmeans_groups", f"""
WITH {APART} SELECT count(*) AS n, round(avg(v), 4) AS avg_v, round(avg(l_discount), 4) AS avg_l_discount
FROM a GROUP BY far""")
def kmeans_groups(t: Tables):
    rows, _ = models.kmeans(models.scaled_features(_apart(t), ["v"])[0], 2)
    return agg.class_means(rows, "cluster", ["v", "l_discount"]).drop("cluster")


@query("kmeans_pair_centres", f"""
WITH {APART}, g AS (SELECT avg(v) AS v, avg(l_discount) AS d FROM a GROUP BY far)
SELECT (v = (SELECT max(v) FROM g))::INTEGER::DOUBLE AS v,
  (d = (SELECT max(d) FROM g))::INTEGER::DOUBLE AS d FROM g""")
def kmeans_pair_centres(t: Tables):
    rows = _apart(t)
    features = VectorAssembler(inputCols=["v", "l_discount"], outputCol="features").transform(rows)
    _, model = models.kmeans(features, 2)
    return models.scaled_centres(model, ["v", "d"], t.spark).drop("cluster")


@query("elbow_pair", f"""
WITH {APART}, z AS (SELECT far, (v - avg(v) OVER ()) / stddev_samp(v) OVER () AS z FROM a)
SELECT 2 AS k, round(sum(s), 3) AS inertia FROM (SELECT var_pop(z) * count(*) AS s FROM z GROUP BY far)""")
def elbow_pair(t: Tables):
    found = models.elbow(models.scaled_features(_apart(t), ["v"])[0], [2])
    return found.withColumn("inertia", F.round("inertia", 3))


@query("difficulty_pair", f"""
WITH {APART} SELECT CASE WHEN far THEN 'hard' ELSE 'easy' END AS level, count(*) AS n FROM a GROUP BY far""")
def difficulty_pair(t: Tables):
    rows = models.difficulty(_apart(t), ["v"], ("easy", "hard"))
    return rows.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


def _held(label: str) -> str:
    return f"""SELECT {label} AS label, {label} AS prediction, count(*) AS n FROM part
WHERE ('0x' || substr(md5(p_partkey || ':42'), 1, 8))::BIGINT % 10000 >= 8000 GROUP BY ALL"""


def _tally(held):
    return held.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("forest_separable", _held("CASE WHEN p_size % 7 > 3 THEN 'high' ELSE 'low' END"))
def forest_separable(t: Tables):
    """A label that one number decides: every held-out row is told right."""
    rest = F.col("p_size") % 7
    rows = t.part.withColumns({"rest": rest, "label": F.when(rest > 3, "high").otherwise("low")})
    return _tally(models.classify_forest(rows, "p_partkey", "label", "p_type", ["rest"], trees=20))


@query("svm_separable", _held("p_type"))
def svm_separable(t: Tables):
    """A label that one word of the text decides."""
    rows = t.part.select("p_partkey", F.col("p_type").alias("label"),
                         F.concat_ws(" ", "p_type", F.lit("part")).alias("text"))
    return _tally(models.classify_svm(rows, "p_partkey", "label", "text"))


def _linear(t: Tables) -> models.RegressionBakeOff:
    rows = t.part.withColumn("y", 3.0 * F.col("p_size") + 10)
    return models.RegressionBakeOff(rows, "p_partkey", "y", ["p_size"], ["p_type"], "p_name", trees=5)


@query("regress_linear", """
SELECT 'linear' AS model, count(*) AS n, 0.0::DOUBLE AS mae, 1.0::DOUBLE AS r2 FROM part
WHERE ('0x' || substr(md5(p_partkey || ':42'), 1, 8))::BIGINT % 10000 >= 8000""")
def regress_linear(t: Tables):
    """A target on a line: the linear model meets every held-out row."""
    return _linear(t).scores.filter("model = 'linear'").select(
        "model", "n", (F.floor(F.col("mae") * 10) / 10).alias("mae"), F.round("r2", 3).alias("r2"))


@query("importance_single", "SELECT 'p_size' AS feature FROM (SELECT count(*) FROM part)")
def importance_single(t: Tables):
    return _linear(t).importances("forest", 1).select("feature")


@query("target_means", """
WITH o AS (SELECT *, ('0x' || substr(md5(o_orderkey || ':42'), 1, 8))::BIGINT % 5 AS f FROM orders),
g AS (SELECT avg(o_totalprice) AS m FROM orders),
s AS (SELECT o_custkey, f, sum(o_totalprice) AS s, count(*) AS n FROM o GROUP BY ALL),
w AS (SELECT o_custkey, f, sum(s) OVER c - s AS s, sum(n) OVER c - n AS n FROM s
  WINDOW c AS (PARTITION BY o_custkey))
SELECT o_orderkey, round((s + 10 * m) / (n + 10), 4) AS target_mean
FROM o JOIN w USING (o_custkey, f), g""")
def target_means(t: Tables):
    """Customers as numbers: what they spend in the other folds."""
    rows = models.target_means(t.orders, "o_orderkey", "o_custkey", "o_totalprice")
    return rows.select("o_orderkey", F.round("target_mean", 4).alias("target_mean"))
