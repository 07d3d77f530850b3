"""The numbered operators and the pipeline as queries on the standard tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


@query("op7_mixing")
def op7_mixing(spark: SparkSession, root: str) -> DataFrame:
    from lodestone.llm.mixing import Mixture

    mixture = Mixture(table(spark, root, "documents"))
    return mixture.taken().selectExpr("doc_id", "_size AS size", "source_size", "target", "taken")


@query("op9_packing")
def op9_packing(spark: SparkSession, root: str) -> DataFrame:
    from lodestone.llm.packing import packed_documents

    return packed_documents(table(spark, root, "documents"))


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, root: str) -> DataFrame:
    from lodestone.llm.token_counts import token_counts

    return token_counts(table(spark, root, "documents"))


WORDS = r"'[^\x20\x09-\x0D]+'"


@query("op6_line_rules", f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, {WORDS}) AS ws FROM d),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) v(k)
  GROUP BY doc_id),
ln AS (SELECT doc_id, source, t, l, len(regexp_extract_all(l, {WORDS})) AS n,
    trim(regexp_replace(regexp_replace(lower(l), '[\\x20\\x09-\\x0D]+', ' ', 'g'),
      '[0-9]+', '0', 'g'), ' ') AS z
  FROM (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS l FROM d)),
lw AS (SELECT * FROM ln WHERE n > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lw GROUP BY doc_id),
host AS (SELECT source, count(*) AS docs FROM d GROUP BY source),
often AS (SELECT s.source, s.z FROM (
    SELECT source, z, count(DISTINCT doc_id) AS n FROM lw GROUP BY source, z) s
  JOIN host h ON s.source IS NOT DISTINCT FROM h.source
  WHERE s.n > greatest(3.0, h.docs * 0.02)),
gone AS (SELECT lw.doc_id, sum(lw.n) AS n FROM lw
  JOIN often o ON lw.source IS NOT DISTINCT FROM o.source AND lw.z = o.z GROUP BY lw.doc_id),
base AS (SELECT w.doc_id, len(w.ws)::BIGINT AS n_words,
    length(regexp_replace(w.t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(w.t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    (len(w.ws) - coalesce(gone.n, 0))::BIGINT AS n_left
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_left >= n_words * 0.5 AS kept, n_left
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
""")
def op6_line_rules(spark: SparkSession, root: str) -> DataFrame:
    from lodestone.llm.line_rules import quality_rules

    return quality_rules(table(spark, root, "documents"))


@query("op5_language")
def op5_language(spark: SparkSession, root: str) -> DataFrame:
    from lodestone.llm.language import languages_of

    return languages_of(table(spark, root, "documents"))


@query("op8_quality")
def op8_quality(spark: SparkSession, root: str) -> DataFrame:
    from lodestone.llm.quality import quality_scores

    return quality_scores(table(spark, root, "documents"), table(spark, root, "labels"))


@query("op10_jaccard_join")
def op10_jaccard_join(spark: SparkSession, root: str) -> DataFrame:
    from lodestone.llm.jaccard import jaccard_join

    return jaccard_join(table(spark, root, "documents"))


@query("op3_top_k", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, vec_id, score,
    row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""")
def op3_top_k(spark: SparkSession, root: str) -> DataFrame:
    from lodestone.llm.topk import top_k

    return top_k(table(spark, root, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op2_suffixes")
def op2_suffixes(spark: SparkSession, root: str) -> DataFrame:
    from lodestone.llm.suffixes import deduplicated_bytes

    return deduplicated_bytes(table(spark, root, "documents"))


@query("op1_surrogates")
def op1_surrogates(spark: SparkSession, root: str) -> DataFrame:
    from lodestone.llm.surrogates import with_surrogates

    docs = table(spark, root, "documents")
    return with_surrogates(docs, count="n_entities").select("doc_id", "text", "n_entities")


@query("op11_collocations", r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, id, generate_subscripts(ps, 1) AS p, unnest(ps) AS t
  FROM (SELECT lang, id, string_split_regex(t, '[.,;:!?\x0A-\x0D]') AS ps FROM d)),
words AS (SELECT lang, id, p, generate_subscripts(ws, 1) AS i, unnest(ws) AS w
  FROM (SELECT lang, id, p, regexp_extract_all(t, '[^\x20\x09]+') AS ws FROM pieces)),
lead3 AS (SELECT lang, w, lead(w, 1) OVER piece AS w2, lead(w, 2) OVER piece AS w3
  FROM words WINDOW piece AS (PARTITION BY id, p ORDER BY i)),
grams AS (SELECT lang, 1 AS k, w AS phrase FROM lead3
  UNION ALL SELECT lang, 2, w || ' ' || w2 FROM lead3 WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3 FROM lead3 WHERE w3 IS NOT NULL),
f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE n >= 10),
cuts AS (SELECT lang, phrase, k, n AS a, c, array_to_string(ws[1:c], ' ') AS lp,
    array_to_string(ws[c + 1:k], ' ') AS rp
  FROM often, (VALUES (1), (2)) v(c) WHERE c < k),
scores AS (SELECT cuts.*, l.n AS l, r.n AS r,
    ((1000000::HUGEINT * a * a) // (l.n::HUGEINT * r.n))::BIGINT AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = lp AND l.k = c
  JOIN f r ON r.lang = cuts.lang AND r.phrase = rp AND r.k = cuts.k - c),
worst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS o
  FROM scores) WHERE o = 1),
longer AS (SELECT lang, phrase, max(n) AS n FROM (
    SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, n FROM often WHERE k = 3
    UNION ALL SELECT lang, array_to_string(ws[2:3], ' '), n FROM often WHERE k = 3) GROUP BY ALL),
ranked AS (SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase)
    AS rank
  FROM worst w LEFT JOIN longer o ON o.lang = w.lang AND o.phrase = w.phrase
  WHERE o.n IS NULL OR 100 * o.n < 50 * a)
SELECT lang, rank, phrase, a, l, r, total.n, score FROM ranked JOIN total USING (lang)
WHERE rank <= 2000
""")
def op11_collocations(spark: SparkSession, root: str) -> DataFrame:
    from lodestone.llm.collocations import collocations

    return collocations(table(spark, root, "documents"))


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]
#: The number in the last part of a path names the document that the page shows.
PAGE_DOCUMENT = "/([0-9]{1,18})(?:[.][a-z]+)?/?(?:[?#].*)?$"


@query("op12_url_reputation", f"""
WITH p AS (SELECT page_id, url,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
u AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
known AS (SELECT u.host, CASE WHEN quality = 0 OR toxic = 1 THEN 1
      WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END AS bad
  FROM u JOIN labels ON labels.doc_id = try_cast(regexp_extract(url, '{PAGE_DOCUMENT}', 1) AS BIGINT)),
named AS (SELECT DISTINCT host, regexp_replace(split_part(host, '@', -1), ':[0-9]*$', '') AS name
  FROM u),
h AS (SELECT host, name, coalesce(n, 0)::DOUBLE AS n, coalesce(x, 0)::DOUBLE AS x,
    CASE WHEN regexp_full_match(name, '[0-9.]*') OR starts_with(name, '[') THEN ''
      ELSE split_part(name, '.', -1) END AS suffix
  FROM named LEFT JOIN (SELECT host, count(bad) AS n, sum(bad) AS x FROM known GROUP BY host) k
    USING (host)),
hosts AS (SELECT *, CASE WHEN suffix = '' THEN name
    ELSE array_to_string(string_split(name, '.')[-2:], '.') END AS domain FROM h),
s AS (SELECT suffix, sum(n) AS n, sum(x) AS x,
    (SELECT (coalesce(sum(x), 0) + 0.5) / (coalesce(sum(n), 0) + 1) FROM hosts) AS m
  FROM hosts GROUP BY suffix),
sk AS (SELECT greatest(1 / coalesce(CASE WHEN sum(n * m * (1 - m) * (n - 1)) > 0 THEN greatest(
    sum((x - n * m) ** 2 - n * m * (1 - m)) / sum(n * m * (1 - m) * (n - 1)), 1 / 1001) END, 1 / 1001) - 1,
    0.5) AS k FROM s),
sm AS (SELECT suffix, (k * m + x) / (k + n) AS m FROM s, sk),
d AS (SELECT hosts.suffix, domain, sum(n) AS n, sum(x) AS x, first(m) AS m
  FROM hosts JOIN sm USING (suffix) GROUP BY hosts.suffix, domain),
dk AS (SELECT greatest(1 / coalesce(CASE WHEN sum(n * m * (1 - m) * (n - 1)) > 0 THEN greatest(
    sum((x - n * m) ** 2 - n * m * (1 - m)) / sum(n * m * (1 - m) * (n - 1)), 1 / 1001) END, 1 / 1001) - 1,
    0.5) AS k FROM d),
dm AS (SELECT suffix, domain, (k * m + x) / (k + n) AS m FROM d, dk),
hm AS (SELECT hosts.host, n, x, m FROM hosts JOIN dm USING (suffix, domain)),
hk AS (SELECT greatest(1 / coalesce(CASE WHEN sum(n * m * (1 - m) * (n - 1)) > 0 THEN greatest(
    sum((x - n * m) ** 2 - n * m * (1 - m)) / sum(n * m * (1 - m) * (n - 1)), 1 / 1001) END, 1 / 1001) - 1,
    0.5) AS k FROM hm),
post AS (SELECT host, n, x, (k * m + x) / (k + n) AS mean, k + n AS total FROM hm, hk),
low AS (SELECT host, n, x, mean, mean - 1.645 * sqrt(mean * (1 - mean) / (total + 1)) AS low FROM post),
rules AS (SELECT * FROM (VALUES {", ".join(
    f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in URL_RULES)})
  t(verdict, rule, rhost, rpath)),
fit AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT u.page_id, u.host, u.path, fit.rule,
  coalesce(fit.verdict, CASE WHEN low.low > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  low.n::BIGINT AS n_labelled, low.x::BIGINT AS n_bad, round(mean * 1000000)::BIGINT AS mean_ppm,
  round(low.low * 1000000)::BIGINT AS low_ppm
FROM u JOIN low USING (host) LEFT JOIN fit USING (page_id)
""")
def op12_url_reputation(spark: SparkSession, root: str) -> DataFrame:
    from lodestone.llm.hosts import filtered_urls

    pages, labels = table(spark, root, "pages"), table(spark, root, "labels")
    shown = F.expr(f"try_cast(regexp_extract(url, '{PAGE_DOCUMENT}', 1) AS long)")
    bad = (F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1)
           .when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0))
    labelled = (pages.select("url", shown.alias("_doc"))
                .join(labels.select(F.col("doc_id").alias("_doc"), bad.alias("bad")), "_doc"))
    return filtered_urls(pages, labelled, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "n_labelled", "n_bad",
        F.round(F.col("bad_mean") * 1_000_000).cast("long").alias("mean_ppm"),
        F.round(F.col("bad_low") * 1_000_000).cast("long").alias("low_ppm"))


@query("op13_whitening")
def op13_whitening(spark: SparkSession, root: str) -> DataFrame:
    from lodestone.llm.whitening import whitened

    return whitened(table(spark, root, "embeddings"))


@query("pipeline")
def pipeline(spark: SparkSession, root: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, root)
