"""Queries: tokens, texts, baskets, graphs, similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions.text import english_stop_words, words
from lodestone.functions.wordlists import BENEFIT_PATTERNS, SOFT_SKILL_PATTERNS
from lodestone.operators import aggregate as agg
from lodestone.operators import balls, basket, graph, similarity, text, tokens
from lodestone.plans.registry import Tables, query
from lodestone.session import cut_lineage

PART_TOKENS = """
SELECT p.*, token FROM (SELECT *, unnest(string_split(p_name, ' ')) AS raw FROM part) p,
  LATERAL (SELECT trim(lower(raw)) AS token) WHERE token <> ''"""


@query("explode_tokens", f"SELECT p_partkey, token FROM ({PART_TOKENS})")
def explode_tokens(t: Tables):
    return tokens.explode_tokens(t.part.select("p_partkey", "p_name"), "p_name", " ").drop("p_name")


@query("token_top_k", f"""
SELECT token, count(*) AS n,
  round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM part), 2) AS share_pct
FROM ({PART_TOKENS}) GROUP BY token ORDER BY n DESC, token LIMIT 20""")
def token_top_k(t: Tables):
    return tokens.top_tokens(t.part, "p_name", 20, sep=" ")


@query("token_value_profile", f"""
SELECT token, count(*) AS n, round(min(p_retailprice), 2) AS min_value,
  round(avg(p_retailprice), 2) AS avg_value, round(max(p_retailprice), 2) AS max_value,
  round(quantile_disc(p_retailprice, 0.5), 2) AS median_value
FROM ({PART_TOKENS}) WHERE p_retailprice > 0 GROUP BY token HAVING count(*) >= 10
ORDER BY avg_value DESC, token LIMIT 15""")
def token_value_profile(t: Tables):
    return tokens.token_value_profile(t.part, "p_name", "p_retailprice", sep=" ")


@query("token_subset", f"""
SELECT token, count(*) AS n, round(count(*) * 100.0::DOUBLE / (
    SELECT count(*) FROM part WHERE p_size > 25), 4) AS share_pct
FROM ({PART_TOKENS}) WHERE p_size > 25 GROUP BY token ORDER BY n DESC, token LIMIT 10""")
def token_subset(t: Tables):
    return tokens.top_tokens(t.part.filter("p_size > 25"), "p_name", 10, sep=" ", digits=4)


@query("token_rarity", """
WITH w AS (SELECT DISTINCT doc_id, trim(lower(raw)) AS token
           FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS raw FROM documents))
SELECT token, count(*) AS doc_freq,
  round(ln((SELECT count(DISTINCT doc_id) FROM documents)::DOUBLE / count(*)), 4) AS idf
FROM w WHERE token <> '' GROUP BY token HAVING count(*) >= 5 ORDER BY idf DESC, token LIMIT 50""")
def token_rarity(t: Tables):
    return tokens.token_rarity(t.documents, "doc_id", "text", sep=" ")


@query("pair_cooccurrence", """
WITH w AS (SELECT DISTINCT p_partkey, unnest(string_split(lower(p_name), ' ')) AS token FROM part)
SELECT x.token || ' + ' || y.token AS pair, count(*) AS n
FROM w x JOIN w y ON x.p_partkey = y.p_partkey AND x.token < y.token
GROUP BY 1 ORDER BY n DESC, pair LIMIT 50""")
def pair_cooccurrence(t: Tables):
    return tokens.pair_cooccurrence(t.part, "p_name", 50, sep=" ")


def order_brands(t: Tables):
    """(order, brand) rows."""
    lines = t.lineitem.select("l_orderkey", "l_partkey")
    parts = t.part.select("p_partkey", "p_brand")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "p_brand")


BASKETS = """
b AS (SELECT DISTINCT l_orderkey AS o, p_brand AS i
      FROM lineitem JOIN part ON l_partkey = p_partkey)"""
EDGES = f"""{BASKETS},
p AS (SELECT x.i AS a, y.i AS b, count(*) AS n FROM b x JOIN b y ON x.o = y.o AND x.i < y.i
      GROUP BY ALL),
e AS (SELECT * FROM p WHERE n > (SELECT avg(n) FROM p)),
d AS (SELECT a AS src, b AS dst, n AS w FROM e UNION ALL SELECT b, a, n FROM e)"""


def brand_edges(t: Tables):
    """Built once and kept: degrees and sizes read the edges several times."""
    pairs = basket.basket_pairs(order_brands(t), "l_orderkey", "p_brand")
    return graph.heavy_edges(cut_lineage(pairs))


@query("basket_pairs", f"WITH {EDGES} SELECT * FROM p")
def basket_pairs(t: Tables):
    return basket.basket_pairs(order_brands(t), "l_orderkey", "p_brand")


@query("edges", f"WITH {EDGES} SELECT * FROM e")
def edges(t: Tables):
    return brand_edges(t)


@query("degree", f"""
WITH {EDGES}
SELECT src AS node, count(*) AS degree,
  round(count(*) / ((SELECT count(DISTINCT src) FROM d) - 1), 4) AS centrality
FROM d GROUP BY src ORDER BY degree DESC, node LIMIT 20""")
def degree(t: Tables):
    return graph.degree_centrality(brand_edges(t), 20)


@query("graph_size", f"""
WITH {EDGES}
SELECT (SELECT count(DISTINCT src) FROM d) AS nodes, (SELECT count(*) FROM e) AS edges""")
def graph_size(t: Tables):
    return graph.graph_size(brand_edges(t))


@query("subgraph", f"""
WITH {EDGES},
k AS (SELECT src AS node FROM d GROUP BY src ORDER BY count(*) DESC, src LIMIT 15)
SELECT e.* FROM e WHERE a IN (SELECT node FROM k) AND b IN (SELECT node FROM k)""")
def subgraph(t: Tables):
    kept = brand_edges(t)
    return graph.induced_subgraph(kept, graph.degree_centrality(kept, 15).select("node"))


PAGERANK_ROUNDS = 20


def pagerank_sql(edges: str, digits: int) -> str:
    rounds = ["""
r0 AS MATERIALIZED (SELECT src AS node, 1.0::DOUBLE / count(*) OVER () AS s
                    FROM (SELECT DISTINCT src FROM d))"""]
    for i in range(1, PAGERANK_ROUNDS + 1):
        rounds.append(f"""
r{i} AS MATERIALIZED (
  SELECT z.node, 0.15::DOUBLE / (SELECT count(*) FROM r0) + 0.85::DOUBLE * y.s AS s
  FROM r0 z JOIN (SELECT d.dst, sum(r.s * d.w / o.t) AS s FROM d JOIN r{i - 1} r ON r.node = d.src
                  JOIN o ON o.src = d.src GROUP BY d.dst) y ON y.dst = z.node)""")
    return f"""
{edges.replace("d AS (", "d AS MATERIALIZED (")},
o AS MATERIALIZED (SELECT src, sum(w) AS t FROM d GROUP BY src),{",".join(rounds)}
SELECT node, round(s, {digits}) AS score FROM r{PAGERANK_ROUNDS} ORDER BY s DESC, node LIMIT 20"""


@query("pagerank", pagerank_sql(f"WITH {EDGES}", 6))
def pagerank(t: Tables):
    scores = graph.pagerank(brand_edges(t), max_rounds=PAGERANK_ROUNDS, tolerance=None)
    return graph.top_nodes(scores, 20, digits=6)


# Sets of up to three brands: at 1 % support no set of four occurs.
ITEMSETS = f"""{BASKETS},
n AS (SELECT count(DISTINCT o) AS n FROM b),
least_count AS (SELECT ceil(0.01 * n) AS m FROM n),
s1 AS (SELECT i, count(*) AS f FROM b GROUP BY i HAVING count(*) >= (FROM least_count)),
s2 AS (SELECT x.i AS i, y.i AS j, count(*) AS f FROM b x JOIN b y ON x.o = y.o AND x.i < y.i
       GROUP BY ALL HAVING count(*) >= (FROM least_count)),
s3 AS (SELECT x.i AS i, y.i AS j, z.i AS k, count(*) AS f FROM b x
       JOIN b y ON x.o = y.o AND x.i < y.i JOIN b z ON y.o = z.o AND y.i < z.i
       GROUP BY ALL HAVING count(*) >= (FROM least_count)),
sets AS (SELECT [i] AS items, f FROM s1 UNION ALL SELECT [i, j], f FROM s2
         UNION ALL SELECT [i, j, k], f FROM s3)"""
RULES = f"""{ITEMSETS},
r AS (SELECT a.items AS ant, c.items AS con, w.f / n AS support, w.f / a.f AS confidence,
             w.f * n / (a.f * c.f) AS lift
      FROM sets w JOIN sets a ON len(a.items) < len(w.items) AND list_has_all(w.items, a.items)
      JOIN sets c ON c.items = list_filter(w.items, lambda x: NOT list_contains(a.items, x))
      CROSS JOIN n),
k AS (SELECT * FROM r WHERE confidence >= 0.1 AND lift > 1 ORDER BY lift DESC, ant, con LIMIT 20)"""


def brand_itemsets(t: Tables):
    return basket.frequent_itemsets(order_brands(t), "l_orderkey", "p_brand", 0.01)


def brand_rules(t: Tables):
    return basket.association_rules(brand_itemsets(t), min_confidence=0.1, k=20)


@query("frequent_itemsets", f"""
WITH {ITEMSETS}
SELECT array_to_string(items, ' + ') AS items, len(items)::INTEGER AS size, f AS freq,
  round(f / n, 6) AS support FROM sets, n""")
def frequent_itemsets(t: Tables):
    return brand_itemsets(t).select(F.array_join("items", " + ").alias("items"),
                                    F.size("items").alias("size"), "freq",
                                    F.round("support", 6).alias("support"))


@query("rules", f"""
WITH {RULES}
SELECT array_to_string(ant, ', ') AS antecedent, array_to_string(con, ', ') AS consequent,
  round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM k""")
def rules(t: Tables):
    return brand_rules(t).select(
        F.array_join("antecedent", ", ").alias("antecedent"),
        F.array_join("consequent", ", ").alias("consequent"),
        *[F.round(c, 6).alias(c) for c in ("support", "confidence", "lift")])


@query("lift_matrix", f"""
WITH {RULES},
x AS (SELECT unnest(ant) AS a, con, lift FROM k),
p AS (SELECT a, unnest(con) AS c, lift FROM x),
m AS (SELECT a AS item FROM p UNION SELECT c FROM p)
SELECT x.item AS antecedent, y.item AS consequent, round(coalesce(min(p.lift), 0), 6) AS lift
FROM m x CROSS JOIN m y LEFT JOIN p ON p.a = x.item AND p.c = y.item GROUP BY ALL""")
def lift_matrix(t: Tables):
    return basket.lift_cells(brand_rules(t)).withColumn("lift", F.round("lift", 6))


LABEL_MEANS = """
c AS (SELECT label, i, avg(x::DOUBLE) AS m FROM (
        SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i
        FROM embeddings) GROUP BY ALL),
q AS (SELECT label, list(m ORDER BY i) AS v FROM c GROUP BY label),
best AS (SELECT q.label AS query, vec_id AS item,
           round(list_cosine_similarity(v, embedding::DOUBLE[]), 4) AS score,
           row_number() OVER (PARTITION BY q.label ORDER BY list_cosine_similarity(
             v, embedding::DOUBLE[]) DESC, vec_id)::INTEGER AS rank
         FROM q CROSS JOIN embeddings QUALIFY rank <= 5)"""


def label_means(t: Tables):
    """Mean vector of every label: ``query``, ``embedding``."""
    cells = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy(F.col("label").alias("query")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))),
                    lambda c: c["m"]).alias("embedding"))


@query("similar_top_k", f"WITH {LABEL_MEANS} SELECT * FROM best")
def similar_top_k(t: Tables):
    """Mean vector of every label against all vectors."""
    return similarity.similar_top_k(label_means(t), t.embeddings, "query", "vec_id", "embedding",
                                    5)


@query("similar_balls", f"WITH {LABEL_MEANS} SELECT * FROM best")
def similar_balls(t: Tables):
    """The same result by an index that skips most of the vectors."""
    return balls.ball_top_k(label_means(t), t.embeddings, "query", "vec_id", "embedding", 5, balls=32)


PATTERNS = {**BENEFIT_PATTERNS, **SOFT_SKILL_PATTERNS, "digits": "[0-9]{4}",
            "address": r"[a-z0-9.]+@[a-z0-9.]+", "the": "(^| )the ", "und": "(^| )und "}


@query("tag_counts", "\nUNION ALL ".join(
    f"SELECT '{name}' AS tag, count(*) FILTER (regexp_matches(lower(text), '{p}')) AS n, "
    f"round(count(*) FILTER (regexp_matches(lower(text), '{p}')) * 100.0::DOUBLE / count(*), 4) "
    "AS pct FROM documents" for name, p in PATTERNS.items()))
def tag_counts(t: Tables):
    return tokens.tag_counts(t.documents, "text", PATTERNS, digits=4)


TERMS = ["copyright", "license", "the", "und", "les", "para", "this file", "file", "email", "c++",
         "de la", "la", "c#", "java"]


@query("dictionary_terms", f"""
WITH terms AS (SELECT unnest({TERMS!r}) AS term)
SELECT doc_id, term FROM documents, terms
WHERE regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{M}}\\p{{N}}_+#])' || regexp_escape(term)
                     || '($|[^\\p{{L}}\\p{{M}}\\p{{N}}_+#])')""")
def dictionary_terms(t: Tables):
    return t.documents.select("doc_id", F.explode(tokens.dictionary_terms("text", TERMS))
                              .alias("term"))


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


STOP = english_stop_words
_WORD_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
_LONG_SQL = r"regexp_extract_all(lower(text), '[a-zA-ZÀ-ỹ][a-zA-ZÀ-ỹ_]{2,}')"


def _stop_sql(source: str, stop: list[str]) -> str:
    return f"list_filter({source}, lambda x: NOT list_contains({_sql_list(stop)}, x))"


FEW_STOP_WORDS = ["the", "and", "of", "to", "in", "le", "la", "les", "de", "und", "der", "die",
                  "el", "los"]


@query("group_terms", f"""
SELECT lang, term, count(*) AS tf
FROM (SELECT lang, unnest({_stop_sql(_WORD_SQL, FEW_STOP_WORDS)}) AS term FROM documents)
GROUP BY ALL""")
def group_terms(t: Tables):
    return text.group_terms(t.documents, "lang", words("text"), FEW_STOP_WORDS)


@query("count_vectors", f"""
WITH tok AS (SELECT doc_id, unnest({_WORD_SQL}) AS term FROM documents),
cnt AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
voc AS (SELECT term FROM cnt GROUP BY term HAVING count(*) >= 5),
v AS (SELECT doc_id, count(*) AS terms, sum(tf)::DOUBLE AS total, max(tf)::DOUBLE AS most
      FROM cnt SEMI JOIN voc USING (term) GROUP BY doc_id)
SELECT doc_id, coalesce(terms, 0) AS terms, coalesce(total, 0) AS total, coalesce(most, 0) AS most
FROM documents LEFT JOIN v USING (doc_id)""")
def count_vectors(t: Tables):
    """Number, sum and maximum of the entries of every text's count vector."""
    vectors = text.count_vectors(t.documents, "doc_id", "text")
    entries = F.from_json(F.to_json(F.struct(F.col("counts").alias("c"))),
                          "c struct<values: array<double>>")["c"]["values"]
    return vectors.select("doc_id", F.size(entries).cast("long").alias("terms"), F.aggregate(
        entries, F.lit(0.0), lambda a, x: a + x).alias("total"),
        F.coalesce(F.array_max(entries), F.lit(0.0)).alias("most"))


@query("term_top_k", f"""
SELECT term, count(*) AS n
FROM (SELECT unnest({_stop_sql(_LONG_SQL, FEW_STOP_WORDS)}) AS term FROM documents)
GROUP BY term ORDER BY n DESC, term LIMIT 100""")
def term_top_k(t: Tables):
    return text.top_terms(t.documents, "text", 100, stop=FEW_STOP_WORDS)


def weights_sql(rows: str, stop: list[str]) -> str:
    """Weights of words and word pairs by language in ``rows``, a query for (lang, text)."""
    return f"""
src AS ({rows}),
tok AS (SELECT lang, {_stop_sql(_WORD_SQL, stop)} AS w FROM src WHERE lang IS NOT NULL),
gram AS (SELECT lang, unnest(w) AS term FROM tok UNION ALL
         SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
         FROM tok),
cnt AS (SELECT lang, term, count(*) AS tf FROM gram GROUP BY ALL),
voc AS (SELECT term, count(*) AS df FROM cnt GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 1500),
wt AS (SELECT lang, term, tf * (ln((1 + (SELECT count(DISTINCT lang) FROM src))::DOUBLE
                                   / (1 + df)) + 1) AS w FROM cnt JOIN voc USING (term)),
sc AS (SELECT lang, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY lang)), 4) AS score
       FROM wt)"""


WEIGHTS = weights_sql("SELECT lang, text FROM documents", FEW_STOP_WORDS)


@query("term_weights", f"""
WITH {WEIGHTS}
SELECT lang, term, score,
  row_number() OVER (PARTITION BY lang ORDER BY score DESC, term)::INTEGER AS rank
FROM sc QUALIFY rank <= 15""")
def term_weights(t: Tables):
    return text.term_weights(t.documents, "lang", "text", 1500, 15, stop=FEW_STOP_WORDS)


@query("term_matrix", f"""
WITH {WEIGHTS},
f AS (SELECT * FROM sc QUALIFY row_number() OVER (
        PARTITION BY lang ORDER BY score DESC, term) <= 40),
b AS (SELECT DISTINCT term FROM f QUALIFY row_number() OVER (
        PARTITION BY lang ORDER BY score DESC, term) <= 8)
SELECT term, coalesce(max(score) FILTER (lang = 'de'), 0) AS de,
  coalesce(max(score) FILTER (lang = 'en'), 0) AS en,
  coalesce(max(score) FILTER (lang = 'es'), 0) AS es,
  coalesce(max(score) FILTER (lang = 'fr'), 0) AS fr
FROM f WHERE term IN (SELECT term FROM b) GROUP BY term""")
def term_matrix(t: Tables):
    kept = text.term_weights(t.documents, "lang", "text", 1500, 40, stop=FEW_STOP_WORDS)
    return agg.term_matrix(kept, "lang", "term", "score", ["de", "en", "es", "fr"], 8)


@query("richness", f"""
WITH tok AS (SELECT doc_id, unnest({_stop_sql(_WORD_SQL, FEW_STOP_WORDS)}) AS term FROM documents),
cnt AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
voc AS (SELECT term, count(*) AS df FROM cnt GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 3000),
wt AS (SELECT doc_id, tf * (ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + df)) + 1) AS w
       FROM cnt JOIN voc USING (term)),
s AS (SELECT doc_id, sum(w) / sqrt(sum(w * w)) AS r FROM wt GROUP BY doc_id)
SELECT doc_id, round(coalesce(r, 0), 4) AS richness FROM documents LEFT JOIN s USING (doc_id)""")
def richness(t: Tables):
    out = text.lexical_richness(t.documents, "doc_id", "text", stop=FEW_STOP_WORDS)
    return out.withColumn("richness", F.round("richness", 4))
