from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import basket, graph, similarity, tokens
from tests.helpers import rows


def brute_pairs(baskets):
    return Counter(p for items in baskets.values() for p in combinations(sorted(items), 2))


def test_row_pairs_ignore_repeats(spark):
    df = spark.createDataFrame([("b,a,a",)], "s string")
    assert rows(tokens.row_pairs(df, "s")) == [("a", "b", 1)]


@pytest.mark.parametrize("block, min_count", [(1000, 1), (7, 1), (7, 3)])
def test_pairs_of_an_oversized_basket(spark, block, min_count):
    """One basket holds most rows and is cut into blocks; repeats count once."""
    rng = np.random.default_rng(2)
    baskets = {0: {f"i{k:03d}" for k in range(60)}}
    baskets |= {b: {f"i{k:03d}" for k in rng.choice(60, 4)} for b in range(1, 40)}
    data = [(b, i) for b, items in baskets.items() for i in items] * 2
    df = spark.createDataFrame(data, "b int, i string").repartition(5)
    want = {p: n for p, n in brute_pairs(baskets).items() if n >= min_count}
    got = {(r["a"], r["b"]): r["n"] for r in basket.basket_pairs(
        df, "b", "i", min_count, block).collect()}
    assert got == want


def test_rules_with_two_item_consequents(spark):
    baskets = [["a", "b", "c"], ["a", "b", "c"], ["a", "b"], ["a", "c"], ["d"]]
    df = spark.createDataFrame([(n, i) for n, b in enumerate(baskets) for i in b],
                               "b int, i string")
    sets = basket.frequent_itemsets(df, "b", "i", 0.4)
    found = {tuple(r["items"]): r["freq"] for r in sets.collect()}
    assert found == {("a",): 4, ("b",): 3, ("c",): 3, ("a", "b"): 3, ("a", "c"): 3,
                     ("b", "c"): 2, ("a", "b", "c"): 2}
    rules = {(tuple(r["antecedent"]), tuple(r["consequent"])): r
             for r in basket.association_rules(sets, 0.3, 1.0, None).collect()}
    rule = rules[(("a",), ("b", "c"))]
    assert rule["support"] == pytest.approx(0.4)
    assert rule["confidence"] == pytest.approx(0.5)
    assert rule["lift"] == pytest.approx(0.5 / 0.4)
    assert (("d",), ("a",)) not in rules


def test_no_frequent_items(spark):
    df = spark.createDataFrame([(n, f"x{n}") for n in range(30)], "b int, i string")
    sets = basket.frequent_itemsets(df, "b", "i", 0.5)
    assert sets.count() == 0 and basket.association_rules(sets).count() == 0


def test_star_degrees(spark):
    edges = spark.createDataFrame([("c", x, 1) for x in "xyz"], "a string, b string, n int")
    got = dict(rows(graph.degree_centrality(edges), "node", "centrality"))
    assert got == {"c": 1.0, "x": 0.3333, "y": 0.3333, "z": 0.3333}
    assert rows(graph.graph_size(edges), "nodes", "edges") == [(4, 3)]


@pytest.mark.parametrize("idle", [False, True])
def test_pagerank_against_power_iteration(spark, monkeypatch, idle):
    rng = np.random.default_rng(3)
    n = 12
    weights = np.triu(rng.integers(0, 4, (n, n)), 1)
    weights[0, 1:] = 5                       # a hub
    edges = [(i, j, int(weights[i, j])) for i in range(n) for j in range(i + 1, n)
             if weights[i, j] > 0]
    if idle:
        edges.append((0, n, 0))              # a node with no weight at all
        n += 1
    m = np.zeros((n, n))
    for i, j, w in edges:
        m[i, j] = m[j, i] = w
    out = m.sum(axis=1)
    p = np.divide(m, out[:, None], out=np.zeros_like(m), where=out[:, None] > 0)
    score = np.full(n, 1 / n)
    for _ in range(60):
        score = 0.15 / n + 0.85 * (score @ p + score[out == 0].sum() / n)
    df = spark.createDataFrame(edges, "a int, b int, n int")
    monkeypatch.setattr(graph, "HUB_EDGES", 3 if idle else 100_000)
    got = dict(rows(graph.pagerank(df, max_rounds=60, tolerance=1e-9)))
    assert [got[i] for i in range(n)] == pytest.approx(score, abs=1e-6)


@pytest.mark.parametrize("block", [13, 4096])
def test_similarity_by_blocks(spark, monkeypatch, block):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(60, 8)).round(3)
    vectors[7] = vectors[3]                  # a tie
    data = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [(60, None), (61, [1.0, None] * 4)]  # take no part, as query and as item
    df = spark.createDataFrame(data + odd, "id int, v array<double>").repartition(4)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scores = unit @ unit.T
    want = sorted((q, int(i)) for q in range(60)
                  for i in sorted(range(60), key=lambda i: (-round(scores[q, i], 9), i))[:3])
    original = similarity._blocked
    monkeypatch.setattr(similarity, "_blocked", lambda *args: original(*args, block=block))
    got = rows(similarity.similar_top_k(df, df, "id", "id", "v", 3), "query", "item")
    assert sorted(got) == want


def test_k_larger_than_the_table(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id int, v array<double>")
    assert similarity.similar_top_k(df, df, "id", "id", "v", 10).count() == 4


def test_subgraph(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 2)], "a string, b string, n int")
    nodes = spark.createDataFrame([("a",), ("b",)], "node string")
    assert rows(graph.induced_subgraph(edges, nodes), "a", "b", "n") == [("a", "b", 1)]
    assert rows(graph.heavy_edges(edges), "n") == [(2,)]
    assert rows(graph.heavy_edges(edges, 1).agg(F.count("n"))) == [(2,)]


def test_square_lift_matrix(spark):
    rules = spark.createDataFrame([(["a"], ["b"], 1.5), (["b"], ["a"], 2.0), (["a"], ["b", "c"], 1.2)],
                                  "antecedent array<string>, consequent array<string>, lift double")
    got = basket.lift_matrix(rules)
    assert got.columns == ["antecedent", "a", "b", "c"]
    assert rows(got) == [("a", 0.0, 1.2, 1.2), ("b", 2.0, 0.0, 0.0), ("c", 0.0, 0.0, 0.0)]


def test_equal_baskets_are_mined_together(spark, monkeypatch):
    """Equal baskets lie in one partition, so that no task's trees hold all the different ones."""
    seen = []
    original = basket.FPGrowth.fit

    def fit(self, df, *args):
        seen.append((df.select("items", F.spark_partition_id()).distinct().count(),
                     df.distinct().count(), df.groupBy(F.spark_partition_id()).count().count()))
        return original(self, df, *args)

    monkeypatch.setattr(basket.FPGrowth, "fit", fit)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).selectExpr("id DIV 2 AS o", "concat('i', (id * 7 + id DIV 16) % 12) AS i")
        found = {tuple(r["items"]): r["freq"] for r in
                 basket.frequent_itemsets(df, "o", "i", 0.01).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    held, different, parts = seen[0]
    assert held == different and parts > 1
    sets = {}
    for r in df.groupBy("o").agg(F.sort_array(F.collect_set("i")).alias("s")).collect():
        for part in {(x,) for x in r["s"]} | {tuple(r["s"])}:
            sets[part] = sets.get(part, 0) + 1
    assert found == {k: v for k, v in sets.items() if v >= 20}


def test_item_sets_read_their_input_once(spark):
    """Nulls count for nothing and repeats once; every input row is read a single time."""
    data = [(b, i) for b in range(20) for i in ("a", "b", None)] * 2 + [(None, "a"), (20, None), (21, "c")]
    read = spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    df = spark.createDataFrame(spark.sparkContext.parallelize(data, 3).map(counted), "b long, i string")
    sets = {(*r["items"],): (r["freq"], r["n_baskets"])
            for r in basket.frequent_itemsets(df, "b", "i", 0.4).collect()}
    assert sets == {("a",): (20, 21), ("b",): (20, 21), ("a", "b"): (20, 21)}
    assert read.value == len(data)


def test_lift_cells_read_their_rules_once(spark):
    """Also rules that come twice, without a lift, with an empty side or a null item."""
    data = [(["a"], ["b"], 2.0), (["a"], ["b"], 2.0), (["a"], ["b", "c"], 3.0), (["c"], ["a"], None),
            ([], ["d"], 4.0), (["e"], None, 5.0), ([None], ["a"], 6.0)]
    read = spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    rules = spark.createDataFrame(spark.sparkContext.parallelize(data, 2).map(counted),
                                  "antecedent array<string>, consequent array<string>, lift double")
    got = [tuple(r) for r in basket.lift_cells(rules).collect()]
    cells = {("a", "b"): 2.0, ("a", "c"): 3.0}
    want = [(x, y, cells.get((x, y), 0.0)) for x in (None, "a", "b", "c") for y in "abc"]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert read.value == len(data)
