"""Queries: filters, joins, aggregates, windows and quantiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions.columns import combine_text, first_match, flag_label, scaled, whitelist
from lodestone.operators import aggregate as agg
from lodestone.operators import clean, joins, paging, tokens, window
from lodestone.operators.quantiles import exact_quantiles
from lodestone.plans.registry import Tables, query

PRICE_EDGES = [50_000.0, 100_000.0, 200_000.0, 300_000.0, 400_000.0]
PRICE_LABELS = ["1. < 50K", "2. 50-100K", "3. 100-200K", "4. 200-300K", "5. 300-400K",
                "6. > 400K"]
SIZE_EDGES = [1, 2, 4, 6, 9]
SIZE_LABELS = ["00-01", "02", "03-04", "05-06", "07-09", "10+"]

WORD_RULES = [(["ring", "gear"], "Moving"), (["bolt", "rod", "plate"], "Fixed"),
              (["widget", "gizmo"], "Device")]


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts(t: Tables):
    return agg.value_counts(t.events, "event_type")


@query("summary", """
SELECT count(c_custkey) AS total, count(DISTINCT c_mktsegment) AS distinct_c_mktsegment,
       count(DISTINCT c_nationkey) AS distinct_c_nationkey, round(avg(c_acctbal), 4) AS avg_c_acctbal,
       min(c_acctbal) AS min_c_acctbal, max(c_acctbal) AS max_c_acctbal
FROM customer""")
def summary(t: Tables):
    return agg.summary(t.customer, "c_custkey", ["c_mktsegment", "c_nationkey"], ["c_acctbal"],
                       ["c_acctbal"])


@query("composite_group", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n,
       round(min(o_totalprice) FILTER (o_totalprice > 0), 2) AS min_value,
       round(avg(o_totalprice) FILTER (o_totalprice > 0), 2) AS avg_value,
       round(max(o_totalprice) FILTER (o_totalprice > 0), 2) AS max_value
FROM orders GROUP BY ALL ORDER BY n DESC, o_orderstatus, o_orderpriority LIMIT 15""")
def composite_group(t: Tables):
    profile = agg.group_profile(t.orders, ["o_orderstatus", "o_orderpriority"], "o_totalprice")
    return window.top_k(profile, [F.desc("n"), F.asc("o_orderstatus"), F.asc("o_orderpriority")],
                        15)


@query("group_profile", """
WITH g AS (
  SELECT p_brand, count(*) AS n,
         round(min(l_extendedprice) FILTER (l_extendedprice > 0), 2) AS min_value,
         round(avg(l_extendedprice) FILTER (l_extendedprice > 0), 2) AS avg_value,
         round(max(l_extendedprice) FILTER (l_extendedprice > 0), 2) AS max_value,
         string_agg(DISTINCT p_type, ' | ' ORDER BY p_type) AS types
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand),
s AS (SELECT *, round(n * 100.0::DOUBLE / sum(n) OVER (), 4) AS share_pct FROM g),
k AS (SELECT * FROM s ORDER BY n DESC, p_brand LIMIT 20)
SELECT *, rank() OVER (ORDER BY n DESC)::INTEGER AS rank FROM k""")
def group_profile(t: Tables):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    profile = agg.group_profile(rows, ["p_brand"], "l_extendedprice",
                                extra={"types": agg.joined_set("p_type")})
    return window.ranked_top_k(agg.with_share(profile, "n", digits=4), "n", "p_brand", 20)


@query("group_median", """
SELECT o_orderpriority, p, count(o_totalprice) AS n, quantile_disc(o_totalprice, p) AS quantile
FROM (SELECT *, 0.25::DOUBLE AS p FROM orders) GROUP BY ALL
UNION ALL
SELECT o_orderpriority, p, count(o_totalprice), quantile_disc(o_totalprice, 0.5)
FROM (SELECT *, 0.5::DOUBLE AS p FROM orders) GROUP BY ALL
UNION ALL
SELECT o_orderpriority, p, count(o_totalprice), quantile_disc(o_totalprice, 0.75)
FROM (SELECT *, 0.75::DOUBLE AS p FROM orders) GROUP BY ALL""".replace(
    "quantile_disc(o_totalprice, p)", "quantile_disc(o_totalprice, 0.25)"))
def group_median(t: Tables):
    return exact_quantiles(t.orders, ["o_orderpriority"], "o_totalprice", [0.25, 0.5, 0.75])


@query("group_vs_market", """
WITH words AS (SELECT p_brand, unnest(string_split(p_name, ' ')) AS token FROM part),
wc AS (SELECT p_brand, token, count(*) AS c FROM words GROUP BY ALL),
common AS (SELECT p_brand, token AS top_token FROM wc
           QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY c DESC, token) = 1),
m AS (SELECT count(*) AS mn, avg(p_retailprice) FILTER (p_retailprice > 0) AS mavg FROM part),
g AS (SELECT p_brand, count(*) AS n, avg(p_retailprice) FILTER (p_retailprice > 0) AS a,
             round(max(p_retailprice) FILTER (p_retailprice > 0), 2) AS max_value,
             round(avg(p_size), 2) AS avg_experience,
             round(avg((p_type = 'PROMO')::INT::DOUBLE) * 100, 2) AS flag_pct,
             string_agg(DISTINCT p_type, ' | ' ORDER BY p_type) AS levels
      FROM part GROUP BY p_brand)
SELECT p_brand, n, round(n * 100.0::DOUBLE / mn, 2) AS share_pct, round(a, 2) AS avg_value,
       round((a - mavg) * 100.0::DOUBLE / mavg, 2) + 0 AS vs_market_pct, max_value, avg_experience,
       flag_pct, top_token, levels
FROM g JOIN common USING (p_brand) CROSS JOIN m""")
def group_vs_market(t: Tables):
    rows = t.part.withColumn("is_promo", F.col("p_type") == "PROMO").withColumn(
        "is_promo", F.col("is_promo").cast("int"))
    words = tokens.explode_tokens(t.part.select("p_brand", "p_name"), "p_name", " ", lower=False)
    return agg.group_vs_market(rows, "p_brand", "p_retailprice", "p_size", "is_promo", words,
                               "token", "p_type")


@query("pivot_named", """
WITH c AS (
  SELECT o_orderpriority,
    coalesce(round(avg(o_totalprice) FILTER (o_orderstatus = 'F') / 1000, 1), 0) AS "F",
    coalesce(round(avg(o_totalprice) FILTER (o_orderstatus = 'O') / 1000, 1), 0) AS "O",
    coalesce(round(avg(o_totalprice) FILTER (o_orderstatus = 'P') / 1000, 1), 0) AS "P"
  FROM orders GROUP BY o_orderpriority)
SELECT *, round(("F" + "O" + "P") / 3, 4) AS row_mean FROM c WHERE "F" > 0
ORDER BY row_mean DESC, o_orderpriority LIMIT 30""")
def pivot_named(t: Tables):
    return agg.pivot_average(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"],
                             "o_totalprice", "F", 30, unit=1000.0)


@query("pivot_discovered", """
SELECT c_nationkey,
  count(*) FILTER (c_mktsegment = 'AUTOMOBILE') AS "AUTOMOBILE",
  count(*) FILTER (c_mktsegment = 'BUILDING') AS "BUILDING",
  count(*) FILTER (c_mktsegment = 'FURNITURE') AS "FURNITURE",
  count(*) FILTER (c_mktsegment = 'HOUSEHOLD') AS "HOUSEHOLD",
  count(*) FILTER (c_mktsegment = 'MACHINERY') AS "MACHINERY",
  count(*) AS total
FROM customer GROUP BY c_nationkey""")
def pivot_discovered(t: Tables):
    return agg.pivot_counts(t.customer, "c_nationkey", "c_mktsegment")


@query("conditional_counts", """
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS n_done,
  count(*) FILTER (o_orderstatus <> 'F') AS n_open,
  round(avg(o_totalprice) FILTER (o_orderstatus = 'F' AND o_totalprice > 0), 2) AS avg_done,
  round(avg(o_totalprice) FILTER (o_orderstatus <> 'F' AND o_totalprice > 0), 2) AS avg_open
FROM orders GROUP BY o_orderpriority""")
def conditional_counts(t: Tables):
    return agg.conditional_counts(t.orders, "o_orderpriority", F.col("o_orderstatus") == "F",
                                  "o_totalprice", "done", "open")


@query("crosstab_norm", """
SELECT o_orderpriority, round(count(*) FILTER (o_orderstatus = 'F') / count(*), 4) AS "F",
  round(count(*) FILTER (o_orderstatus = 'O') / count(*), 4) AS "O",
  round(count(*) FILTER (o_orderstatus = 'P') / count(*), 4) AS "P"
FROM orders GROUP BY o_orderpriority""")
def crosstab_norm(t: Tables):
    return agg.crosstab_share(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("cube_totals", """
SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'ALL' ELSE l_returnflag END AS l_returnflag,
  CASE WHEN grouping(l_linestatus) = 1 THEN 'ALL' ELSE l_linestatus END AS l_linestatus,
  CASE WHEN grouping(y) = 1 THEN 'ALL' ELSE y::VARCHAR END AS ship_year,
  count(*) AS n, round(avg(l_extendedprice), 1) AS avg_price,
  sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS sum_price
FROM (SELECT *, year(l_shipdate) AS y FROM lineitem) GROUP BY CUBE (l_returnflag, l_linestatus, y)""")
def cube_totals(t: Tables):
    rows = t.lineitem.withColumn("ship_year", F.year("l_shipdate"))
    return agg.cube_totals(rows, ["l_returnflag", "l_linestatus", "ship_year"],
                           {"sum_price": F.col("l_extendedprice").cast("decimal(18,2)")},
                           {"avg_price": F.col("l_extendedprice")})


@query("cube_distinct", """
SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'ALL' ELSE l_returnflag END AS l_returnflag,
  CASE WHEN grouping(l_linestatus) = 1 THEN 'ALL' ELSE l_linestatus END AS l_linestatus,
  CASE WHEN grouping(y) = 1 THEN 'ALL' ELSE y::VARCHAR END AS ship_year,
  count(*) AS n, count(DISTINCT l_orderkey) AS n_distinct
FROM (SELECT *, year(l_shipdate) AS y FROM lineitem) GROUP BY CUBE (l_returnflag, l_linestatus, y)""")
def cube_distinct(t: Tables):
    rows = t.lineitem.withColumn("ship_year", F.year("l_shipdate"))
    return agg.cube_distinct(rows, ["l_returnflag", "l_linestatus", "ship_year"], "l_orderkey")


BRACKET_SQL = """
  SELECT CASE WHEN o_totalprice < 50000 THEN 1 WHEN o_totalprice < 100000 THEN 2
              WHEN o_totalprice < 200000 THEN 3 WHEN o_totalprice < 300000 THEN 4
              WHEN o_totalprice < 400000 THEN 5 ELSE 6 END AS bracket_no
  FROM orders WHERE o_totalprice IS NOT NULL"""
LABEL_SQL = """list_extract(['1. < 50K', '2. 50-100K', '3. 100-200K', '4. 200-300K',
  '5. 300-400K', '6. > 400K'], bracket_no)"""


@query("brackets", f"""
SELECT bracket_no, count(*) AS n, {LABEL_SQL} AS bracket,
       round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 4) AS share_pct
FROM ({BRACKET_SQL}) GROUP BY bracket_no""")
def brackets(t: Tables):
    return agg.bracket_counts(t.orders, "o_totalprice", PRICE_EDGES, PRICE_LABELS, digits=4)


@query("histogram", """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 30 AS w
           FROM events),
b AS (SELECT least(floor((value - lo) / w)::BIGINT + 1, 30) AS bin, count(*) AS n
      FROM events, s GROUP BY 1)
SELECT i AS bin, round(lo + (i - 1) * w, 4) AS low, round(lo + i * w, 4) AS high,
       coalesce(n, 0) AS n
FROM s, range(1, 31) r(i) LEFT JOIN b ON b.bin = i""")
def histogram(t: Tables):
    bins = agg.equal_width_histogram(t.events, "value", 30)
    return bins.withColumns({"low": F.round("low", 4), "high": F.round("high", 4)})


@query("bucket_delta", """
WITH b AS (SELECT *, CASE WHEN p_size <= 1 THEN 1 WHEN p_size <= 2 THEN 2 WHEN p_size <= 4 THEN 3
                  WHEN p_size <= 6 THEN 4 WHEN p_size <= 9 THEN 5 ELSE 6 END AS bucket_no FROM part),
g AS (SELECT bucket_no, count(*) AS n, round(min(p_retailprice), 2) AS min_value,
        round(avg(p_retailprice), 2) AS avg_value, round(max(p_retailprice), 2) AS max_value,
        round(quantile_disc(p_retailprice, 0.5), 2) AS median_value
      FROM b GROUP BY bucket_no)
SELECT *, list_extract(['00-01', '02', '03-04', '05-06', '07-09', '10+'], bucket_no) AS bucket,
       round(avg_value - lag(avg_value) OVER (ORDER BY bucket_no), 2) AS delta
FROM g""")
def bucket_delta(t: Tables):
    return agg.bucket_delta(t.part, "p_size", "p_retailprice", SIZE_EDGES, SIZE_LABELS, digits=2)


@query("top_n_per_group", """
SELECT o_orderpriority, o_orderkey, o_totalprice,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey)::INTEGER AS rank
FROM orders QUALIFY rank <= 3""")
def top_n_per_group(t: Tables):
    return window.top_n_per_group(
        t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice"), ["o_orderpriority"],
        [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, rank="rank")


@query("top_n_stats", """
SELECT o_custkey, count(*) AS n, max(o_totalprice) AS max_score,
       round(avg(o_totalprice), 4) AS mean_score
FROM (SELECT * FROM orders QUALIFY row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3)
GROUP BY o_custkey""")
def top_n_stats(t: Tables):
    return agg.top_n_stats(t.orders, "o_custkey", "o_totalprice", "o_orderkey", 3)


@query("outliers_iqr", """
WITH q AS (SELECT event_type, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
           FROM events GROUP BY event_type)
SELECT event_type, event_id, value, q1, q3, round(q3 + (q3 - q1) * 1.5, 4) AS fence
FROM events JOIN q USING (event_type) WHERE value > q3 + (q3 - q1) * 1.5""")
def outliers_iqr(t: Tables):
    rows = joins.upper_outliers(t.events.select("event_type", "event_id", "value"),
                                "event_type", "value")
    return rows.withColumn("fence", F.round("fence", 4))


@query("faceted_filter", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE (contains(c_name, '#00000001') OR contains(c_name, '5'))
  AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')
  AND (c_acctbal IS NULL OR c_acctbal >= 500) AND (c_acctbal IS NULL OR c_acctbal <= 9000)
  AND c_nationkey >= 3 AND c_nationkey <= 20
  AND contains(lower(c_name), 'customer') AND contains(c_name, 'Cust')""")
def faceted_filter(t: Tables):
    facets = clean.Facets(
        contains_any={"c_name": ["#00000001", "5"]},
        one_of={"c_mktsegment": ["BUILDING", "MACHINERY", "FURNITURE"]},
        range_or_null={"c_acctbal": (500, 9000)}, range_strict={"c_nationkey": (3, 20)},
        all_tokens={"c_name": ["Customer"]})
    found = clean.search_text(t.customer, " Cust ", ["c_name", "c_mktsegment"])
    return clean.faceted_filter(found, facets)


@query("page_slice", """
SELECT *, (SELECT count(*) FROM customer) AS total_rows FROM customer
ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 20 OFFSET 40""")
def page_slice(t: Tables):
    return clean.paginate(t.customer, "c_acctbal", "c_custkey", ascending=False, page=3, size=20)


@query("page_deep", """
SELECT l_orderkey * 10 + l_linenumber AS line, l_quantity, flag,
  (SELECT count(*) FROM lineitem) AS total_rows
FROM (SELECT *, l_returnflag AS flag FROM lineitem)
ORDER BY l_quantity DESC NULLS LAST, line LIMIT 25
OFFSET (SELECT (count(*) * 3 // 5 // 25) * 25 FROM lineitem)""")
def page_deep(t: Tables):
    """A page behind three fifths of all lines, sorted by a column of few values."""
    lines = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"),
                              "l_quantity", F.col("l_returnflag").alias("flag"))
    page = lines.count() * 3 // 5 // 25 + 1
    return paging.deep_page(lines, "l_quantity", "line", ascending=False, page=page, size=25)


@query("classify", """
SELECT p_partkey,
  CASE WHEN contains(p_name, 'ring') OR contains(p_name, 'gear') THEN 'Moving'
       WHEN contains(p_name, 'bolt') OR contains(p_name, 'rod') OR contains(p_name, 'plate')
         THEN 'Fixed'
       WHEN contains(p_name, 'widget') OR contains(p_name, 'gizmo') THEN 'Device'
       ELSE 'Other' END AS kind,
  CASE WHEN p_type IN ('SMALL', 'LARGE') THEN p_type ELSE 'Other' END AS size_class,
  CASE WHEN p_size = 1 THEN 'unit' ELSE 'bulk' END AS pack
FROM part""")
def classify(t: Tables):
    return t.part.select(
        "p_partkey", first_match("p_name", WORD_RULES, "Other", lower=True).alias("kind"),
        whitelist("p_type", ["SMALL", "LARGE"], "Other").alias("size_class"),
        flag_label("p_size", "unit", "bulk").alias("pack"))


@query("clean_cast", """
SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k,
  coalesce(try_cast(props AS INTEGER), 0) AS bad
FROM events WHERE value > 0 AND try_cast(json_extract_string(props, '$.k') AS INTEGER) >= 0
  AND event_type <> ''""")
def clean_cast(t: Tables):
    rows = t.events.select("event_id", "event_type", "value",
                           F.get_json_object("props", "$.k").alias("k"),
                           F.col("props").alias("bad"))
    rows = clean.fill_constants(clean.typed(rows, {"k": "int", "bad": "int"}), {"bad": 0})
    rows = clean.keep_valid(rows, not_null=["k"], not_empty=["event_type"], positive=["value"],
                            non_negative=["k"])
    return rows.select("event_id", "k", "bad")


@query("median_fill", """
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal FROM customer)
SELECT c_custkey, round(coalesce(bal, (SELECT median(bal) FROM c)), 4) AS bal FROM c""")
def median_fill(t: Tables):
    rows = t.customer.select("c_custkey",
                             F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"))
    return clean.fill_median(rows, ["bal"]).withColumn("bal", F.round("bal", 4))


@query("stats_join", """
SELECT o_orderkey, o_orderpriority, o_totalprice, round(avg(o_totalprice) OVER w, 2) AS group_avg,
  max(o_totalprice) OVER w AS group_max
FROM orders WINDOW w AS (PARTITION BY o_orderpriority)""")
def stats_join(t: Tables):
    return joins.join_group_stats(
        t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), ["o_orderpriority"],
        [F.round(F.avg("o_totalprice"), 2).alias("group_avg"),
         F.max("o_totalprice").alias("group_max")])


@query("anti_join", """
SELECT c_custkey, c_name FROM customer ANTI JOIN (
  SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') o
ON c_custkey = o.o_custkey""")
def anti_join(t: Tables):
    urgent = t.orders.filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    return joins.without_match(t.customer.select("c_custkey", "c_name"), urgent, "c_custkey",
                               "o_custkey")


@query("attach_total", """
SELECT o_orderstatus, count(*) AS n, (SELECT count(*) FROM orders) AS total_rows,
  round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders), 4) AS share_pct
FROM orders GROUP BY o_orderstatus""")
def attach_total(t: Tables):
    total = t.orders.agg(F.count(F.lit(1)))
    counts = agg.with_total(agg.value_counts(t.orders, "o_orderstatus"), total, "total_rows")
    return agg.with_share(counts, "n", total, digits=4)


@query("having", """
SELECT o_custkey, count(*) AS n, round(min(o_totalprice), 6) AS min_value,
  round(avg(o_totalprice), 6) AS avg_value, round(max(o_totalprice), 6) AS max_value
FROM orders GROUP BY o_custkey HAVING count(*) >= 12""")
def having(t: Tables):
    return agg.group_profile(t.orders, ["o_custkey"], "o_totalprice", digits=6, min_rows=12)


@query("class_means", """
SELECT quality, count(*) AS n, round(avg(n_chars), 4) AS avg_n_chars,
  round(avg(toxic), 4) AS avg_toxic
FROM documents JOIN labels USING (doc_id) GROUP BY quality""")
def class_means(t: Tables):
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    return agg.class_means(rows, "quality", ["n_chars", "toxic"])


@query("top_k", """
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50""")
def top_k(t: Tables):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    best = window.top_k(rows, [F.desc_nulls_last("o_totalprice"), F.asc("o_orderkey")], 50)
    return window.sorted_nulls_last(best, "o_totalprice", "o_orderkey", ascending=False)


@query("keep_newest", """
SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) <= 10 AS kept
FROM orders""")
def keep_newest(t: Tables):
    return window.flag_newest(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"),
                              ["o_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")],
                              "o_orderkey", 10)


@query("dedupe", """
SELECT c_mktsegment AS segment, c_nationkey AS nation, c_custkey AS key, NULL::DOUBLE AS balance
FROM customer QUALIFY row_number() OVER (
  PARTITION BY c_mktsegment, c_nationkey ORDER BY c_custkey) = 1
UNION ALL
SELECT 'SUPPLIER', s_nationkey, s_suppkey, s_acctbal FROM supplier QUALIFY row_number() OVER (
  PARTITION BY s_nationkey ORDER BY s_suppkey) = 1""")
def dedupe(t: Tables):
    buyers = t.customer.select(F.col("c_mktsegment").alias("segment"),
                               F.col("c_nationkey").alias("nation"),
                               F.col("c_custkey").alias("key"))
    sellers = t.supplier.select(F.lit("SUPPLIER").alias("segment"),
                                F.col("s_nationkey").alias("nation"),
                                F.col("s_suppkey").alias("key"),
                                F.col("s_acctbal").alias("balance"))
    rows = window.dedupe_rows(window.union_all(buyers, sellers, buyers))
    return window.dedupe_on(rows, ["segment", "nation"], [F.asc("key")])


@query("scaled", """
SELECT o_orderkey, round(o_totalprice / 1e6, 3) AS price_m FROM orders""")
def scaled_values(t: Tables):
    return t.orders.select("o_orderkey", scaled("o_totalprice", 1e6, 3).alias("price_m"))


@query("combine_text", """
SELECT p_partkey, p_name || ' ' || p_brand || ' ' || coalesce(
    CASE WHEN p_type <> 'PROMO' THEN p_type END, '') AS text FROM part""")
def combined(t: Tables):
    shown = F.when(F.col("p_type") != "PROMO", F.col("p_type"))
    return t.part.select("p_partkey", combine_text("p_name", "p_brand", shown).alias("text"))


@query("display", """
SELECT c_custkey AS "Key", c_name AS "Name", c_acctbal > 0 AS "In credit" FROM customer""")
def display(t: Tables):
    rows = t.customer.withColumn("credit", (F.col("c_acctbal") > 0).cast("int"))
    return clean.display_columns(rows, {"c_custkey": "Key", "c_name": "Name",
                                        "credit": "In credit"}, flags=["credit"])


@query("value_label", """
WITH a AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL
    WHEN c_mktsegment = 'BUILDING' THEN 'no-amount-shown'
    WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal::DECIMAL(18,2)::VARCHAR || ' VND USD'
    ELSE c_acctbal::DECIMAL(18,2)::VARCHAR || ' USD' END AS amount FROM customer)
SELECT c_custkey, CASE WHEN amount IS NULL OR contains(amount, 'no-amount') THEN 'On request'
    WHEN contains(amount, 'VND') THEN trim(replace(amount, ' USD', '')) ELSE amount END AS amount
FROM a""")
def value_label(t: Tables):
    money = F.col("c_acctbal").cast("decimal(18,2)").cast("string")
    rows = t.customer.select("c_custkey", F.when(F.col("c_acctbal") < 0, F.lit(None))
                             .when(F.col("c_mktsegment") == "BUILDING", F.lit("no-amount-shown"))
                             .when(F.col("c_mktsegment") == "MACHINERY",
                                   F.concat(money, F.lit(" VND USD")))
                             .otherwise(F.concat(money, F.lit(" USD"))).alias("amount"))
    return rows.withColumn("amount", clean.value_label("amount", "no-amount", "On request", "USD",
                                                       ["đ", "vnd"]))


@query("point_lookup", """
SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS is_deleted
FROM customer WHERE c_custkey = 7 AND c_acctbal >= 0""")
def point_lookup(t: Tables):
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment",
                             F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("is_deleted"))
    return clean.active_row(rows, "c_custkey", 7)
