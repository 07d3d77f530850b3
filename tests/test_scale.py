"""Operators that read, move or compare only what they need."""

import glob
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import balls, basket, paging, similarity, tokens
from lodestone.operators import tables as tb
from lodestone.sources import readers, writers
from lodestone.sources.csv_records import csv_records
from lodestone.sources.keyed import KeyedTable
from lodestone.sources.versioned import VersionedTable
from lodestone.streaming.ingest import ingest_new, start_keyed_ingest, stream_files
from tests.helpers import rows


def keyed(spark, scratch, n=200, buckets=8):
    table = KeyedTable(spark, scratch(), "id", buckets)
    table.create(tb.stamped(spark.range(n).select("id", F.lit("old").alias("v"))))
    return table


def files(table):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{table.root}/*/*.parquet")}


def change(spark, *ids, v="new"):
    return spark.createDataFrame([(i, v) for i in ids], "id long, v string")


def test_changes_touch_only_the_partitions_of_their_keys(spark, scratch):
    table = keyed(spark, scratch)
    before = files(table)
    touched = table.upsert(change(spark, 3, 1000))
    assert 1 <= len(touched) <= 2
    after = files(table)
    kept = {f for f in before if int(f.split("=")[1].split("/")[0]) not in touched}
    assert kept and all(after[f] == before[f] for f in kept)
    assert not any(f in after for f in set(before) - kept)
    assert rows(table.read().filter("v = 'new'"), "id") == [(1000,), (3,)]
    assert table.read().count() == 201
    plan = table.read(touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_id_of_8" in plan.replace("PartitionFilters: [isnotnull(_id_of_8", "PartitionFilters: [_id_of_8")


def test_emptied_partitions_go(spark, scratch):
    table = keyed(spark, scratch, n=20, buckets=70)
    touched = table.hard_delete(spark.range(0, 20, 2).select("id"))
    assert len(touched) > 1 and rows(table.read(), "id") == sorted([(i,) for i in range(1, 20, 2)], key=repr)
    assert rows(table.read(touched), "id") == sorted(
        [(i,) for i in range(1, 20, 2) if i in {r.id for r in table.read(touched).collect()}], key=repr)
    table.hard_delete(spark.range(0, 20, 2).select("id"))
    assert table.read().count() == 10


def test_keyed_ingest_reads_only_touched_partitions(spark, scratch):
    table = keyed(spark, scratch)
    before = files(table)
    batch = change(spark, 5, 7, 500, 500)
    ingest_new(batch, table, "id")
    ingest_new(batch, table, "id")
    after = files(table)
    assert all(after[f] == before[f] for f in before)  # nothing is rewritten
    assert rows(table.read().filter("id = 500 OR v = 'new'"), "id", "v") == [(500, "new")]
    with pytest.raises(ValueError):
        ingest_new(batch, table, "v")
    with pytest.raises(ValueError):
        KeyedTable(spark, table.root, "id", 16)
    many = table.compact(files=1)
    assert many and table.read().count() == 201 and table.compact(files=1) == []


def test_keyed_soft_delete_and_audit(spark, scratch):
    table, audit = keyed(spark, scratch), VersionedTable(spark, scratch())
    for _ in range(2):
        table.soft_delete(change(spark, 1, 2), "gone", audit)
    assert rows(table.read().filter("is_deleted = 1"), "id") == [(1,), (2,)]
    assert rows(audit.read(), "id", "deleted_reason") == [(1, "gone"), (2, "gone")]


def test_keyed_stream_restarts_without_repeats(spark, scratch):
    inbox, checkpoint = scratch(), scratch()
    table, rejected = keyed(spark, scratch, n=3), VersionedTable(spark, scratch())
    for ids in ((1, 7, 7), (7, 8, None), (8, 9)):
        spark.createDataFrame([(i, "s") for i in ids], "id long, v string").withColumns(
            {"is_deleted": F.lit(0), "created_at": F.current_timestamp(),
             "updated_at": F.current_timestamp()}).write.mode("append").parquet(inbox)
        stream = stream_files(spark, inbox, table.read().schema)
        start_keyed_ingest(stream, table, checkpoint, rejected=rejected).awaitTermination()
    assert rows(table.read(), "id", "v") == [(0, "old"), (1, "old"), (2, "old"), (7, "s"), (8, "s"), (9, "s")]
    assert rejected.read().count() == 1
    assert glob.glob(f"{checkpoint}/state/**/*.zip", recursive=True)  # RocksDB snapshots


@pytest.mark.parametrize("size", (700, 5000))
def test_csv_is_split_inside_quotes(spark, scratch, size):
    rng = random.Random(size)
    parts = ['"', '""', "\n", ",", "a", "é", "x y", "\r\n", "\n\n"]
    data = [(i, "".join(rng.choice(parts) for _ in range(rng.choice((0, 1, 4, 30)))), i * 2)
            for i in range(300)]
    data.append((300, "long\n" * 400, 1))
    path = scratch()
    df = spark.createDataFrame(data, "id long, v string, w int").coalesce(1)
    writers.export(df, path, "csv")
    want = rows(spark.read.csv(path, header=True, multiLine=True, escape='"'))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        assert csv_records(spark, path).rdd.getNumPartitions() > 1
        got = readers.read_csv_typed(spark, path, {"id": "string", "v": "string", "w": "string"})
        assert rows(got) == want and len(want) == 301
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_csv_of_several_files_and_columns(spark, scratch):
    path = scratch()
    os.makedirs(path)
    for name, text in {"a.csv": 'x,y\n1,"p\nq"\n\n2,\n', "b.csv": 'x,y\r\n3,"r\r\ns"\r\n4,t',
                       "c.csv": "x,y\n", "d.csv": ""}.items():
        with open(f"{path}/{name}", "w", newline="") as f:
            f.write(text)
    got = readers.read_csv_typed(spark, path, {"x": "int", "y": "string"})
    assert rows(got) == [(1, "p\nq"), (2, None), (3, "r\ns"), (4, "t")]


def test_deep_pages(spark, monkeypatch):
    monkeypatch.setattr(paging, "FEW", 50)
    rng = random.Random(2)
    names = ["", "a", "http://example.com/long/prefix/" + "x" * 10, "http://example.com/long/prefix/y", "é", None]
    data = [(i, rng.choice((7.0, 7.0, 7.0, None, float("nan"), rng.random() * 100)), rng.choice(names))
            for i in range(3000)]
    df = spark.createDataFrame(data, "id long, v double, s string").repartition(3).cache()
    for sort, up in (("v", True), ("v", False), ("s", False)):
        order = F.col(sort).asc_nulls_last() if up else F.col(sort).desc_nulls_last()
        want = [tuple(r) for r in df.orderBy(order, "id").collect()]
        for page in (75, 150, 151):
            got = [tuple(r)[:3] for r in paging.deep_page(df, sort, "id", up, page, 20).collect()]
            assert repr(got) == repr(want[(page - 1) * 20:page * 20]), (sort, up, page)
    assert paging.deep_page(df.limit(0), "v", "id").count() == 0


def test_deep_pages_sort_few_rows(spark, monkeypatch):
    sorted_rows = []
    real = paging._page

    def spy(rows_, keys, order, offset, size, count):
        if not keys or count <= paging.FEW:
            sorted_rows.append(count)
        return real(rows_, keys, order, offset, size, count)

    monkeypatch.setattr(paging, "_page", spy)
    monkeypatch.setattr(paging, "FEW", 2000)
    df = spark.range(400_000).withColumn("v", F.col("id") % 1000)
    got = paging.deep_page(df, "v", "id", page=10_000, size=20)
    assert [r["id"] for r in got.collect()] == [
        (199_980 + i) % 400 * 1000 + (199_980 + i) // 400 for i in range(20)]
    assert sum(sorted_rows) <= 2000


def test_top_pairs_by_bounds(spark, monkeypatch):
    rng = random.Random(1)
    data = ["t" + " t".join(str(int(rng.paretovariate(0.7)) % 300) for _ in range(12)) for _ in range(400)]
    data += [" ".join(f"only{i}" for i in range(5000)), "", None]
    df = spark.createDataFrame([(t,) for t in data], "x string").repartition(3)
    made = []
    real = basket.basket_pairs

    def counted(*args):
        out = real(*args)
        made.append(out.agg(F.sum("n")).first()[0])
        return out

    monkeypatch.setattr(basket, "basket_pairs", counted)
    got = [tuple(r) for r in tokens.pair_cooccurrence(df, "x", 20, sep=" ").collect()]
    seen = {}
    for t in data[:400]:
        ws = sorted(set(t.split(" ")))
        for i, a in enumerate(ws):
            for b in ws[i + 1:]:
                seen[f"{a} + {b}"] = seen.get(f"{a} + {b}", 0) + 1
    assert got == sorted(seen.items(), key=lambda p: (-p[1], p[0]))[:20]
    assert sum(made) < 60_000  # the row of 5,000 tokens alone has 12 million pairs
    flat = spark.createDataFrame([("a b c",), ("d e",)], "x string")
    assert [tuple(r) for r in tokens.pair_cooccurrence(flat, "x", 3, sep=" ").collect()] == [
        ("a + b", 1), ("a + c", 1), ("b + c", 1)]


def test_balls_skip_and_agree(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 8)) * 4
    data = [(i, [float(x) for x in centres[i % 12] + 0.2 * rng.normal(size=8)]) for i in range(1500)]
    data += [(2000, [0.0] * 8), (2001, None), (2002, [1.0]), (2003, data[0][1]), (2004, [None] * 8)]
    items = spark.createDataFrame(data, "id long, v array<double>").repartition(3)
    asked = [(i, data[i][1]) for i in range(0, 60, 3)] + [(100, [0.0] * 8), (101, None)]
    queries = spark.createDataFrame(asked, "q long, v array<double>")
    index = balls.BallIndex(items, "id", "v", 40, width=8)
    got = rows(index.top_k(queries, "q", "v", 7), "query", "item", "score", "rank")
    full = similarity.similar_top_k(queries, items.filter("size(v) = 8"), "q", "id", "v", 7)
    assert got == rows(full, "query", "item", "score", "rank")
    assert 0 < index.examined < 0.45 * index.pairs
    few = balls.BallIndex(items.limit(0), "id", "v", 4)
    assert few.top_k(queries, "q", "v").count() == 0
