"""Queries: sources, sinks, reports, table maintenance, snapshots, ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestone.operators import aggregate as agg
from lodestone.operators import tables as tb
from lodestone.plans.queries_aggregate import BRACKET_SQL, PRICE_EDGES, PRICE_LABELS
from lodestone.plans.registry import Tables, query
from lodestone.session import scratch_path
from lodestone.sources import catalog, readers, report, writers
from lodestone.sources.keyed import KeyedTable
from lodestone.sources.snapshots import SnapshotStore, retire_old
from lodestone.sources.versioned import VersionedTable
from lodestone.streaming.ingest import ingest_new, start_ingest, start_keyed_ingest, stream_files

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
CUSTOMER_TYPES = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int",
                  "c_acctbal": "double", "c_mktsegment": "string"}
STORED = f"{CUSTOMER}, is_deleted int, created_at timestamp, updated_at timestamp"


def _loaded():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def _changed():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def _stored(t: Tables):
    """The customer table with audit columns."""
    return tb.stamped(t.customer, _loaded())


def _idle(t: Tables):
    """Customers without a finished urgent order."""
    urgent = t.orders.filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    return t.customer.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(
        "c_custkey")


IDLE = """idle AS (SELECT c_custkey FROM customer ANTI JOIN (SELECT * FROM orders
  WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') o ON c_custkey = o.o_custkey)"""


# Sources and sinks ------------------------------------------------------------------------


@query("scan_csv", "SELECT * FROM customer")
def scan_csv(t: Tables):
    path = scratch_path(t.spark, "csv")
    writers.export(t.customer, path, "csv")
    return readers.read_csv(t.spark, path, CUSTOMER)


@query("scan_csv_typed", """
SELECT c_custkey, c_name || chr(10) || '"quoted", ' || c_mktsegment AS c_name, c_nationkey, c_acctbal,
  NULL::INTEGER AS c_mktsegment FROM customer""")
def scan_csv_typed(t: Tables):
    path = scratch_path(t.spark, "csv-typed")
    note = F.concat("c_name", F.lit('\n"quoted", '), "c_mktsegment")
    writers.export(t.customer.withColumn("c_name", note), path, "csv")
    return readers.read_csv_typed(t.spark, path, {**CUSTOMER_TYPES, "c_mktsegment": "int"})


@query("scan_json", "SELECT * FROM customer")
def scan_json(t: Tables):
    path = scratch_path(t.spark, "json")
    writers.export(t.customer, path, "json")
    return readers.read_json(t.spark, path, CUSTOMER)


@query("scan_parquet", "SELECT * FROM customer")
def scan_parquet(t: Tables):
    return readers.read_parquet(t.spark, t.path("customer"))


@query("scan_by_param", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def scan_by_param(t: Tables):
    path = scratch_path(t.spark, "orc")
    writers.write_sink(t.customer, "orc", path=path)
    return readers.read_by_kind(t.spark, "parquet", t.path("customer")).unionByName(
        readers.read_by_kind(t.spark, "orc", path))


@query("sink_parquet", "SELECT * FROM orders")
def sink_parquet(t: Tables):
    path = scratch_path(t.spark, "parquet")
    writers.write_parquet(t.orders, path, partition_by=["o_orderstatus"])
    return readers.read_parquet(t.spark, path)


@query("sink_format", "SELECT * FROM orders")
def sink_format(t: Tables):
    path = scratch_path(t.spark, "sink")
    writers.write_sink(t.orders, "orc", path=path)
    return readers.read_source(t.spark, "orc", path=path)


@query("export", """
SELECT * FROM customer WHERE c_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')""")
def export(t: Tables):
    table, _ = tb.soft_delete(_stored(t), t.orders.filter(
        "o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("c_custkey")), "c_custkey", "done", _changed())
    path = scratch_path(t.spark, "export")
    writers.export(table.drop("created_at", "updated_at"), path, "parquet")
    return readers.read_parquet(t.spark, path)


def _fresh_database(t: Tables, tables: dict[str, str]) -> str:
    name = f"lodestone_{uuid.uuid4().hex}"
    catalog.create_tables(t.spark, name, tables, scratch_path(t.spark, "db"))
    return name


@query("scan_table", "SELECT * FROM customer")
def scan_table(t: Tables):
    name = f"{_fresh_database(t, {'customer': CUSTOMER})}.customer"
    writers.append_table(t.customer, name)
    return readers.read_table(t.spark, name)


@query("table_append", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def table_append(t: Tables):
    name = f"{_fresh_database(t, {'customer': CUSTOMER})}.customer"
    writers.append_table(t.customer, name)
    writers.append_table(t.customer, name)
    return readers.read_table(t.spark, name)


@query("table_replace", "SELECT * FROM customer WHERE c_acctbal > 0")
def table_replace(t: Tables):
    name = f"{_fresh_database(t, {'customer': CUSTOMER})}.customer"
    writers.append_table(t.customer, name)
    writers.replace_table(t.customer.filter("c_acctbal > 0"), name)
    return readers.read_table(t.spark, name)


@query("create_drop_table", """
SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'customer_deleted', 0""")
def create_drop_table(t: Tables):
    gone = f"{CUSTOMER}, deleted_at timestamp, deleted_reason string"
    database = _fresh_database(t, {"customer": CUSTOMER, "customer_deleted": gone})
    writers.append_table(t.customer, f"{database}.customer")
    counts = catalog.table_counts({n: t.spark.table(f"{database}.{n}")
                                   for n in ("customer", "customer_deleted")})
    path = scratch_path(t.spark, "counts")
    writers.write_parquet(counts, path)
    catalog.drop_database(t.spark, database, confirm=True)
    return readers.read_parquet(t.spark, path)


NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
         "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@query("table_counts", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in NAMES))
def table_counts(t: Tables):
    return catalog.table_counts({n: getattr(t, n) for n in NAMES})


@query("text_report", f"""
WITH c AS (SELECT bracket_no, count(*) AS n FROM ({BRACKET_SQL}) GROUP BY bracket_no),
s AS (SELECT *, round(n * 100.0::DOUBLE / sum(n) OVER (), 1) AS pct FROM c)
SELECT rpad(list_extract({PRICE_LABELS!r}, bracket_no), 15, ' ') || ' | '
  || lpad(n::VARCHAR, 7, ' ') || ' | ' || lpad(printf('%.1f', pct), 5, ' ') || ' | '
  || repeat('█', floor(pct / 2)::INTEGER) AS line FROM s""")
def text_report(t: Tables):
    counts = agg.bracket_counts(t.orders, "o_totalprice", PRICE_EDGES, PRICE_LABELS)
    fields = [report.Field("bracket", 15), report.Field("n", 7, right=True, fmt="%d"),
              report.Field("share_pct", 5, right=True, fmt="%.1f")]
    lines = report.text_report(counts, fields, tail=report.bar("share_pct"))
    path = scratch_path(t.spark, "report")
    report.write_report(lines, path)
    return t.spark.read.text(path).withColumnRenamed("value", "line")


# Maintenance ------------------------------------------------------------------------------


@query("hash_id", """
SELECT count(*) AS n, count(DISTINCT (c_name, c_mktsegment, c_acctbal)) AS ids FROM customer""")
def hash_id(t: Tables):
    rows = tb.hash_id(t.customer, ["c_name", "c_mktsegment", "c_acctbal"])
    return rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"))


SOURCE = """source AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer UNION ALL
  SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal FROM supplier)"""


def _source(t: Tables):
    """Customers and, under other keys, suppliers."""
    sellers = t.supplier.select((F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"),
                                F.col("s_name").alias("c_name"),
                                F.col("s_nationkey").alias("c_nationkey"),
                                F.col("s_acctbal").alias("c_acctbal"))
    return t.customer.drop("c_mktsegment").unionByName(sellers)


@query("insert_if_absent", f"""
WITH {SOURCE}, target AS (SELECT * FROM customer WHERE c_acctbal > 0)
SELECT * FROM target UNION ALL
SELECT *, NULL FROM source WHERE c_custkey NOT IN (SELECT c_custkey FROM target)""")
def insert_if_absent(t: Tables):
    return tb.insert_if_absent(t.customer.filter("c_acctbal > 0"), _source(t), "c_custkey")


UPSERT = """
WITH ch AS (SELECT o_custkey AS k, round(max(o_totalprice), 2) AS bal, NULL::VARCHAR AS seg
            FROM orders GROUP BY o_custkey
            UNION ALL SELECT s_suppkey + 1000000000, s_acctbal, 'SUPPLIER' FROM supplier)
SELECT coalesce(c_custkey, k) AS c_custkey, c_name, c_nationkey,
  CASE WHEN coalesce(c_acctbal, 0) < 0 THEN c_acctbal ELSE coalesce(bal, c_acctbal) END AS c_acctbal,
  CASE WHEN coalesce(c_acctbal, 0) < 0 THEN c_mktsegment ELSE coalesce(seg, c_mktsegment) END
    AS c_mktsegment,
  CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS is_deleted
FROM customer FULL JOIN ch ON c_custkey = k"""


@query("upsert", UPSERT)
def upsert(t: Tables):
    """Customers in debt count as deleted and stay untouched."""
    return tb.upsert(_flagged_customers(t), _changes(t), "c_custkey")


def _flagged_customers(t: Tables):
    return t.customer.withColumn("is_deleted", (F.col("c_acctbal") < 0).cast("int"))


def _changes(t: Tables):
    """The largest order of every customer as its balance; sellers under new keys."""
    spent = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.round(F.max("o_totalprice"), 2).alias("c_acctbal"))
    sellers = t.supplier.select((F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"),
                                F.col("s_acctbal").alias("c_acctbal"),
                                F.lit("SUPPLIER").alias("c_mktsegment"))
    return spent.unionByName(sellers, allowMissingColumns=True)


@query("upsert_keyed", UPSERT)
def upsert_keyed(t: Tables):
    """The same changes in two rounds on a stored table that is dealt by its key."""
    table = KeyedTable(t.spark, scratch_path(t.spark, "keyed"), "c_custkey", 16)
    table.create(_flagged_customers(t))
    changes = _changes(t)
    sold = F.col("c_mktsegment").isNotNull()
    table.upsert(changes.filter(sold))
    table.upsert(changes.filter(~sold))
    return table.read()


@query("delete_keyed", f"""
WITH {IDLE} SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 1 ELSE 0 END AS is_deleted
FROM customer WHERE c_custkey NOT IN (SELECT * FROM idle)
UNION ALL SELECT c_custkey, 2 FROM customer
WHERE c_nationkey = 3 AND c_custkey NOT IN (SELECT * FROM idle)""")
def delete_keyed(t: Tables):
    """Hard and soft deletes on a table dealt by its key; the audit rows count as 2."""
    table = KeyedTable(t.spark, scratch_path(t.spark, "keyed"), "c_custkey", 16)
    audit = VersionedTable(t.spark, scratch_path(t.spark, "audit"))
    table.create(_stored(t))
    table.hard_delete(_idle(t))
    for _ in range(2):
        table.soft_delete(t.customer.filter("c_nationkey = 3"), "moved", audit, _changed())
    return table.read().select("c_custkey", "is_deleted").unionByName(
        audit.read().select("c_custkey", F.lit(2).alias("is_deleted")))


@query("set_field", f"""
WITH {IDLE}
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT * FROM idle) THEN 99 ELSE c_nationkey END
  AS c_nationkey, c_custkey IN (SELECT * FROM idle) AS changed FROM customer""")
def set_field(t: Tables):
    out = tb.set_field(_stored(t), _idle(t), "c_custkey", "c_nationkey", "99",
                       _changed())
    return out.select("c_custkey", "c_nationkey",
                      (F.col("updated_at") > F.col("created_at")).alias("changed"))


@query("soft_delete", f"""
WITH {IDLE}
SELECT 'table' AS part, c_custkey, CASE WHEN c_custkey IN (SELECT * FROM idle) THEN 1 ELSE 0 END
  AS is_deleted, NULL AS deleted_reason FROM customer
UNION ALL SELECT 'audit', c_custkey, NULL, 'idle' FROM idle""")
def soft_delete(t: Tables):
    table, audit = tb.soft_delete(_stored(t), _idle(t), "c_custkey", "idle",
                                  _changed())
    again, second = tb.soft_delete(table, _idle(t), "c_custkey", "twice",
                                   _changed())
    rows = again.select(F.lit("table").alias("part"), "c_custkey", "is_deleted")
    audits = audit.unionByName(second).select(F.lit("audit").alias("part"), "c_custkey",
                                              "deleted_reason")
    return rows.unionByName(audits, allowMissingColumns=True)


@query("undelete", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 AND c_mktsegment <> 'BUILDING' THEN 1 ELSE 0 END
  AS is_deleted FROM customer""")
def undelete(t: Tables):
    target = _stored(t).withColumn("is_deleted", (F.col("c_acctbal") < 0).cast("int"))
    keys = t.customer.filter("c_mktsegment = 'BUILDING'")
    return tb.undelete(target, keys, "c_custkey").select("c_custkey", "is_deleted")


@query("hard_delete", f"""
WITH {IDLE} SELECT * FROM customer WHERE c_custkey NOT IN (SELECT * FROM idle)""")
def hard_delete(t: Tables):
    return tb.hard_delete(t.customer, _idle(t), "c_custkey")


@query("recent_deleted", """
SELECT o_orderkey, o_custkey, o_orderdate AS deleted_at, 'closed' AS deleted_reason FROM orders
WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey LIMIT 100""")
def recent_deleted(t: Tables):
    audit = t.orders.filter("o_orderstatus = 'F'").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").alias("deleted_at"),
        F.lit("closed").alias("deleted_reason"))
    return tb.recent_deleted(audit, "o_orderkey", 100)


def _customer_table(t: Tables) -> VersionedTable:
    table = VersionedTable(t.spark, scratch_path(t.spark, "table"))
    table.replace(_stored(t))
    return table


@query("snapshot_restore", f"""
WITH {IDLE} SELECT c_custkey, c_name, c_acctbal,
  CASE WHEN c_mktsegment = 'BUILDING' AND c_custkey NOT IN (SELECT * FROM idle) THEN 1 ELSE 0 END
    AS is_deleted FROM customer""")
def snapshot_restore(t: Tables):
    """Snapshot, hard-delete some rows, soft-delete others, merge the snapshot back: the first
    return, the second count as known and stay deleted."""
    table = _customer_table(t)
    store = SnapshotStore(table, scratch_path(t.spark, "snapshots"))
    snapshot = store.create("before")
    table.replace(tb.hard_delete(table.read(), _idle(t), "c_custkey"))
    closed = t.customer.filter("c_mktsegment = 'BUILDING'")
    flagged, _ = tb.soft_delete(table.read(), closed, "c_custkey", "closed")
    table.replace(flagged)
    store.restore(snapshot, "merge", key="c_custkey")
    return table.read().select("c_custkey", "c_name", "c_acctbal", "is_deleted")


@query("snapshot_replace", """
SELECT 1::INTEGER AS version, 'first' AS name, count(*) AS record_count, 0 AS lost FROM customer
UNION ALL
SELECT 2, 'AUTO', count(*) FILTER (c_acctbal > 0), count(*) FILTER (c_acctbal <= 0) FROM customer""")
def snapshot_replace(t: Tables):
    """Replace after a loss: the store lists the first and the automatic snapshot; ``lost`` is
    what each lacks of the restored table."""
    table = _customer_table(t)
    store = SnapshotStore(table, scratch_path(t.spark, "snapshots"))
    first = store.create("first")
    table.replace(table.read().filter("c_acctbal > 0"))
    store.restore(first, "replace")
    rows = table.read().agg(F.count(F.lit(1))).scalar()
    return store.list().select(
        F.col("table_version").alias("version"),
        F.when(F.col("backup_name").startswith("AUTO"), F.lit("AUTO"))
        .otherwise(F.col("backup_name")).alias("name"), "record_count",
        (rows - F.col("record_count")).cast("int").alias("lost"))


@query("snapshot_retire", """
SELECT 'second' AS backup_name, count(*) FILTER (c_acctbal > 0) AS record_count, 2::INTEGER AS version
FROM customer""")
def snapshot_retire(t: Tables):
    """Two snapshots, the first one retired."""
    table = _customer_table(t)
    store = SnapshotStore(table, scratch_path(t.spark, "snapshots"))
    first = store.create("first")
    table.replace(table.read().filter("c_acctbal > 0"))
    store.create("second")
    store.retire(first)
    return store.list().select("backup_name", "record_count", F.col("table_version").alias("version"))


@query("retention", """
SELECT o_orderkey AS table_version, CASE WHEN row_number() OVER (
    ORDER BY (o_orderstatus = 'F') DESC, o_orderdate DESC, o_orderkey DESC) <= 10
    OR o_orderstatus <> 'F' THEN CASE WHEN o_orderstatus = 'F' THEN 'ACTIVE' ELSE 'DELETED' END
    ELSE 'DELETED' END AS status FROM orders""")
def retention(t: Tables):
    """Orders as snapshot metadata: the ten newest finished ones stay active."""
    meta = t.orders.select(
        F.col("o_orderkey").cast("string").alias("backup_id"),
        F.col("o_orderkey").alias("table_version"), F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") == "F", F.lit("ACTIVE")).otherwise(F.lit("DELETED"))
        .alias("status"))
    return retire_old(meta, 10).select("table_version", "status")


@query("ingest_new", f"WITH {SOURCE} SELECT * FROM source")
def ingest(t: Tables):
    """Three batches that overlap, the last one a repeat: every key arrives once."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "ingest"))
    ingest_new(t.customer.drop("c_mktsegment"), table, "c_custkey")
    ingest_new(_source(t).unionByName(_source(t)), table, "c_custkey")
    ingest_new(_source(t), table, "c_custkey")
    return table.read()


@query("ingest_stream", "SELECT * FROM orders")
def ingest_stream(t: Tables):
    """The order file twice as a file stream, then a restart from the same checkpoint."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "stream"))
    checkpoint = scratch_path(t.spark, "stream-checkpoint")
    inbox = scratch_path(t.spark, "inbox")
    writers.write_parquet(t.orders, inbox, mode="append")
    for _ in range(2):
        stream = stream_files(t.spark, inbox, t.orders.schema)
        start_ingest(stream, table, "o_orderkey", checkpoint).awaitTermination()
        writers.write_parquet(t.orders, inbox, mode="append")
    return table.read()


@query("ingest_keyed", f"WITH {SOURCE} SELECT * FROM source")
def ingest_keyed(t: Tables):
    """The three batches of ``ingest_new`` into a table dealt by its key."""
    table = KeyedTable(t.spark, scratch_path(t.spark, "ingest-keyed"), "c_custkey", 16)
    ingest_new(t.customer.drop("c_mktsegment"), table, "c_custkey")
    ingest_new(_source(t).unionByName(_source(t)), table, "c_custkey")
    ingest_new(_source(t), table, "c_custkey")
    return table.read()


@query("ingest_keyed_stream", """
SELECT * FROM orders UNION ALL
SELECT NULL, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def ingest_keyed_stream(t: Tables):
    """Orders twice as a file stream with a state for each key, some of them loaded before; rows
    without a key are kept apart."""
    table = KeyedTable(t.spark, scratch_path(t.spark, "keyed-stream"), "o_orderkey", 16)
    rejected = VersionedTable(t.spark, scratch_path(t.spark, "keyless"))
    checkpoint = scratch_path(t.spark, "stream-checkpoint")
    inbox = scratch_path(t.spark, "inbox")
    table.create(t.orders.filter("o_orderstatus = 'P'"))
    urgent = t.orders.filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    writers.write_parquet(t.orders.unionByName(urgent.withColumn(
        "o_orderkey", F.lit(None).cast("long"))), inbox, mode="append")
    for _ in range(2):
        stream = stream_files(t.spark, inbox, t.orders.schema)
        start_keyed_ingest(stream, table, checkpoint, rejected=rejected).awaitTermination()
        writers.write_parquet(t.orders, inbox, mode="append")
    return table.read().unionByName(rejected.read())
