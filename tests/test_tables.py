import pytest
from pyspark.sql import functions as F

from lodestone.operators import tables as tb
from lodestone.sources import catalog, readers, report, writers
from lodestone.sources.snapshots import SnapshotStore
from lodestone.sources.versioned import VersionedTable
from lodestone.streaming.ingest import ingest_new, start_ingest, stream_files
from tests.helpers import rows


def stored(spark, data):
    return tb.stamped(spark.createDataFrame(data, "id long, v string, w int"))


def keys(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def test_deleting_twice_audits_once_and_undo_keeps_the_audit(spark):
    table = stored(spark, [(1, "a", 1), (2, "b", 2)])
    gone, audit = tb.soft_delete(table, keys(spark, 1, 1, 9), "id", "spam")
    again, second = tb.soft_delete(gone, keys(spark, 1), "id", "spam")
    assert rows(audit, "id", "deleted_reason") == [(1, "spam")] and second.count() == 0
    back = tb.undelete(again, keys(spark, 1), "id")
    assert rows(back, "id", "is_deleted") == [(1, 0), (2, 0)]


def test_upsert_keeps_deleted_rows_and_old_values(spark):
    table, _ = tb.soft_delete(stored(spark, [(1, "a", 1), (2, "b", 2)]), keys(spark, 2), "id", "x")
    changes = spark.createDataFrame([(1, None, 10), (2, "new", 20), (3, "c", None)],
                                    "id long, v string, w int")
    out = tb.upsert(table, changes, "id", F.current_timestamp())
    assert rows(out, "id", "v", "w", "is_deleted") == [
        (1, "a", 10, 0), (2, "b", 2, 1), (3, "c", None, 0)]
    assert rows(tb.upsert(table, changes, "id", insert=False), "id") == [(1,), (2,)]
    assert rows(tb.upsert(out, changes, "id"), "id", "v", "w") == rows(out, "id", "v", "w")


def test_set_field_casts_and_skips_deleted(spark):
    table, _ = tb.soft_delete(stored(spark, [(1, "a", 1), (2, "b", 2)]), keys(spark, 2), "id", "x")
    out = tb.set_field(table, keys(spark, 1, 2), "id", "w", "7")
    assert rows(out, "id", "w") == [(1, 7), (2, 2)]
    assert tb.matching_active(table, keys(spark, 1, 2), "id").count() == 1


def test_insert_counts_only_active_rows_as_seen(spark):
    table, _ = tb.soft_delete(stored(spark, [(1, "a", 1), (2, "b", 2)]), keys(spark, 2), "id", "x")
    source = spark.createDataFrame([(1, "z"), (2, "z"), (3, "p"), (3, "q")], "id long, v string")
    out = tb.insert_if_absent(table, source, "id", [F.asc("v")])
    assert rows(out, "id", "v", "w") == [(1, "a", 1), (2, "b", 2), (2, "z", None), (3, "p", None)]


def test_versions_survive_a_failed_write(spark, scratch):
    table = VersionedTable(spark, scratch())
    table.replace(stored(spark, [(1, "a", 1)]))
    broken = table.read().withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        table.replace(broken)
    assert table.versions() == [1] and rows(table.read(), "id") == [(1,)]
    table.replace(table.read().withColumn("w", F.col("w") + 1))
    assert rows(table.read(), "w") == [(2,)] and rows(table.read(1), "w") == [(1,)]


def test_restore_modes(spark, scratch):
    table = VersionedTable(spark, scratch())
    table.replace(stored(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 3)]))
    store = SnapshotStore(table, scratch())
    first = store.create("first")
    rest = tb.hard_delete(table.read(), keys(spark, 1), "id")
    table.replace(tb.soft_delete(rest, keys(spark, 2), "id", "x")[0])
    store.restore(first, "merge")
    assert rows(table.read(), "id", "is_deleted") == [(1, 0), (2, 1), (3, 0)]
    store.restore(first, "replace")
    assert rows(table.read(), "id", "is_deleted") == [(1, 0), (2, 0), (3, 0)]
    store.restore(first, "append")
    assert table.read().count() == 6
    assert store.preview(first, 2).count() == 2
    store.retire(first)
    with pytest.raises(ValueError):
        store.rows(first)


def test_retention_keeps_the_newest_and_their_files(spark, scratch):
    table = VersionedTable(spark, scratch())
    table.replace(stored(spark, [(1, "a", 1)]))
    store = SnapshotStore(table, scratch(), keep=2)
    ids = [store.create() for _ in range(4)]
    assert [r["backup_id"] for r in store.list().collect()] == ids[:1:-1]
    paths = store.meta.read().select("backup_path").collect()
    assert all(spark.read.parquet(p[0]).count() == 1 for p in paths)


def test_ingest_twice_adds_nothing(spark, scratch):
    batch = spark.createDataFrame([("u1", 1), ("u1", 2), ("u2", 3)], "url string, v int")
    table = VersionedTable(spark, scratch())
    ingest_new(batch, table, "url")
    ingest_new(batch, table, "url")
    assert rows(table.read(), "url") == [("u1",), ("u2",)]


def test_stream_and_batch_ingest_agree(spark, scratch):
    inbox, checkpoint = scratch(), scratch()
    first = spark.createDataFrame([("u1", 1), ("u2", 2)], "url string, v int")
    second = spark.createDataFrame([("u2", 2), ("u3", 3)], "url string, v int")
    streamed, batched = VersionedTable(spark, scratch()), VersionedTable(spark, scratch())
    for batch in (first, second):
        batch.write.mode("append").parquet(inbox)
        stream = stream_files(spark, inbox, first.schema, max_files=1)
        start_ingest(stream, streamed, "url", checkpoint).awaitTermination()
        ingest_new(batch, batched, "url")
    assert rows(streamed.read()) == rows(batched.read()) == [("u1", 1), ("u2", 2), ("u3", 3)]


def test_csv_round_trip_keeps_quotes_and_line_breaks(spark, scratch):
    table = stored(spark, [(1, 'say "hi",\nthere', 1), (2, "Đà Nẵng", None)])
    path = scratch()
    writers.export(table, path, "csv")
    back = readers.read_csv_typed(spark, path, {"id": "bigint", "v": "string", "w": "int"})
    assert rows(back) == rows(table, "id", "v", "w")
    with pytest.raises(ValueError):
        writers.export(table, path, "xml")


def test_drop_needs_confirmation(spark):
    with pytest.raises(ValueError):
        catalog.drop_database(spark, "nothing")


def test_jobs_schema_has_22_columns(spark):
    from pyspark.sql.types import StructType
    assert len(StructType.fromDDL(catalog.JOBS)) == 22
    assert len(StructType.fromDDL(catalog.JOBS_DELETED)) == 21
    assert len(StructType.fromDDL(catalog.SNAPSHOT_META)) == 8


def test_report_lines(spark):
    df = spark.createDataFrame([("abc", 5, 18.0), ("a long name", None, 57.0)],
                               "g string, n int, p double")
    got = [r[0] for r in report.text_report(
        df, [report.Field("g", 5), report.Field("n", 3, right=True, fmt="%d", missing="-")],
        tail=report.bar("p")).collect()]
    assert got == ["abc   |   5 | " + "█" * 9, "a lon |   - | " + "█" * 28]


def test_rows_without_a_key_never_enter(spark, scratch):
    batch = spark.createDataFrame([(None, 1), (None, 2), ("u", 3)], "url string, v int")
    table, rejected = VersionedTable(spark, scratch()), VersionedTable(spark, scratch())
    ingest_new(batch, table, "url", rejected)
    ingest_new(batch, table, "url", rejected)
    assert rows(table.read()) == [("u", 3)]
    assert rejected.read().count() == 4


def test_several_changes_of_one_key(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    changes = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "id long, v string, t int")
    latest = tb.upsert(target, changes, "id", order=[F.desc("t")])
    assert rows(latest, "id", "v") == [(1, "y"), (2, "b")]
    with pytest.raises(Exception, match="several changes"):
        tb.upsert(target, changes.drop("t"), "id").collect()


def test_an_interrupted_append_is_not_seen(spark, scratch):
    table = VersionedTable(spark, scratch())
    table.replace(keys(spark, 1))
    table.append(keys(spark, 2))
    keys(spark, 3).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{table.root}/v1.2")
    assert rows(table.read()) == [(1,), (2,)]
    table.append(keys(spark, 4))
    table.replace(table.read().filter("id > 1"))
    assert rows(table.read()) == [(2,), (4,)] and rows(table.read(1)) == [(1,), (2,), (4,)]


def test_several_outputs_of_one_input(spark, scratch):
    root = scratch()
    writers.write_outputs(keys(spark, 1, 2, 3), {
        "all": lambda df: df, "odd": lambda df: df.filter("id % 2 = 1")}, root)
    assert rows(spark.read.parquet(f"{root}/all")) == [(1,), (2,), (3,)]
    assert rows(spark.read.parquet(f"{root}/odd")) == [(1,), (3,)]
