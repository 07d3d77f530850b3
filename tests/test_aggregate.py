import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import aggregate as agg
from lodestone.operators import joins, quantiles, tokens, window
from tests.helpers import rows


def test_cube_keeps_real_nulls_apart_from_totals(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), (None, 2)], "d string, v int")
    got = rows(agg.cube_totals(df, ["d"], {"s": F.col("v")}, {"m": F.col("v")}),
               "d", "n", "s", "m")
    assert set(got) == {("ALL", 3, 3.0, 1.5), ("x", 2, 1.0, 1.0), (None, 1, 2.0, 2.0)}


def test_rank_leaves_gaps_after_the_cut(spark):
    df = spark.createDataFrame([("a", 20), ("b", 18), ("c", 18), ("d", 17)], "g string, n int")
    assert rows(window.ranked_top_k(df, "n", "g", 4), "g", "rank") == [
        ("a", 1), ("b", 2), ("c", 2), ("d", 4)]


def test_top_n_ties_do_not_depend_on_the_partitioning(spark):
    df = spark.createDataFrame([(i % 3, 1.0, i) for i in range(60)], "g int, v double, id int")

    def best(frame):
        return rows(window.top_n_per_group(frame, ["g"], [F.desc("v"), F.asc("id")], 2), "id")

    assert best(df) == best(df.repartition(7)) == [(i,) for i in range(6)]


def test_constant_group_and_value_on_the_fence(spark):
    df = spark.createDataFrame([("k", 5.0)] * 9 + [("k", 6.0)]
                               + [("f", float(v)) for v in (1, 2, 3, 4, 7)],
                               "g string, v double")
    assert rows(joins.upper_outliers(df, "g", "v"), "g", "v") == [("k", 6.0)]


@pytest.mark.parametrize("interpolate", [False, True])
def test_exact_quantiles_of_a_hot_group(spark, interpolate):
    """One group far beyond the sketch's exact range, one small, one null, heavy ties."""
    rng = np.random.default_rng(1)
    hot = np.round(rng.gamma(2.0, 50.0, 60_000), 2)
    tied = np.repeat([1.0, 2.0, 3.0], [20_000, 1, 9_000])
    small = np.array([3.0, 1.0, 2.0, 10.0])
    pdf = [("hot", hot), ("tied", tied), (None, small)]
    parts = [spark.createDataFrame([(k, float(v)) for v in vs], "k string, v double")
             for k, vs in pdf]
    df = parts[0].unionByName(parts[1]).unionByName(parts[2]).repartition(8)
    ps = [0.01, 0.5, 0.75, 1.0]
    got = {(r["k"], r["p"]): (r["n"], r["quantile"]) for r in quantiles.exact_quantiles(
        df, ["k"], "v", ps, interpolate).collect()}
    method = "linear" if interpolate else "inverted_cdf"
    for k, vs in pdf:
        for p in ps:
            n, q = got[(k, p)]
            assert n == len(vs) and q == pytest.approx(np.quantile(vs, p, method=method), abs=1e-9)
    whole = quantiles.exact_quantiles(df, [], "v", [0.5], interpolate).first()["quantile"]
    assert whole == pytest.approx(np.quantile(np.concatenate([v for _, v in pdf]), 0.5,
                                              method=method))


def test_histogram_of_one_value_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (None,)], "v double")
    got = agg.equal_width_histogram(df, "v", 5).collect()
    assert [r["n"] for r in got] == [1, 0, 0, 0, 1]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r["n"] for r in agg.equal_width_histogram(flat, "v", 2).collect()] == [2, 0]


def test_too_many_pivot_values_are_refused(spark):
    df = spark.range(20).withColumn("k", F.lit(1))
    with pytest.raises(ValueError):
        agg.discover_values(df, "id", limit=10)


def test_token_share_counts_rows_without_tokens(spark):
    df = spark.createDataFrame([("a,b",), ("a",), (None,), ("",)], "s string")
    assert rows(tokens.top_tokens(df, "s", 1), "token", "n", "share_pct") == [("a", 2, 50.0)]


def test_rarity_value(spark):
    df = spark.createDataFrame([(i, "x" if i < 5 else "y") for i in range(2060)],
                               "id int, s string")
    got = tokens.token_rarity(df, "id", "s", k=1).first()
    assert (got["token"], got["doc_freq"], got["idf"]) == ("x", 5, 6.021)


def test_lag_runs_on_rounded_averages(spark):
    df = spark.createDataFrame([(1.0, 10.04), (2.0, 20.06), (2.0, 20.06)], "y double, v double")
    got = agg.bucket_delta(df, "y", "v", [1], ["low", "high"]).collect()
    assert [r["delta"] for r in got] == [None, 10.1]
    assert [r["avg_value"] for r in got] == [10.0, 20.1]


def test_tags_count_once_per_row_and_match_vietnamese(spark):
    from lodestone.functions.text import nfc
    import unicodedata
    word = "Tiếng  Nhật"
    df = spark.createDataFrame([(word + " " + word,), (unicodedata.normalize("NFD", word),), (None,)],
                               "s string")
    got = tokens.tag_counts(df.withColumn("s", nfc("s")), "s", {"ja": r"(tiếng\s*nhật)"})
    assert rows(got) == [("ja", 2, 66.7)]


def test_dictionary_terms(spark):
    from lodestone.functions.wordlists import KNOWN_SKILLS
    df = spark.createDataFrame([("Senior c++ and C# dev, javascript, machine learning",),
                                ("javac ajava",), (None,)], "s string")
    got = [r[0] for r in df.select(tokens.dictionary_terms("s", KNOWN_SKILLS)).collect()]
    assert got == [["c#", "c++", "javascript", "machine learning"], [], []]
    assert df.select(tokens.dictionary_terms("s", ["machine learning", "learning"])).first()[0] == [
        "machine learning", "learning"]


def test_group_median_is_exact_in_large_groups(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("k"),
        (F.pmod(F.xxhash64("id"), F.lit(10**9)) + 1).cast("double").alias("v"))
    got = {r["k"]: r["median_value"] for r in agg.group_profile(
        rows, ["k"], "v", median=True).collect()}
    values = {}
    for k, v in rows.collect():
        values.setdefault(k, []).append(v)
    assert got == {k: sorted(v)[(len(v) - 1) // 2] for k, v in values.items()}


def test_every_row_gets_a_rank(spark):
    rows = spark.range(1500).select("id", (F.col("id") % 700).cast("double").alias("m"))
    rows = rows.unionByName(spark.createDataFrame([(1500, None)], "id long, m double"))
    got = window.ranked_all(rows, "m").collect()
    values = [r["m"] for r in got if r["m"] is not None]
    assert len(got) == 1501
    for r in got:
        above = len(values) if r["m"] is None else sum(v > r["m"] for v in values)
        assert r["rank"] == above + 1
