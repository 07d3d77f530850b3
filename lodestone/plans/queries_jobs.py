"""Queries: the market analyses on an advert table derived from parts and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions.wordlists import BENEFIT_PATTERNS, LEVELS, SOFT_SKILL_PATTERNS
from lodestone.operators.aggregate import class_means
from lodestone.operators.metrics import class_report
from lodestone.plans import jobs as recipes
from lodestone.plans.queries_tokens import (FEW_STOP_WORDS, LABEL_MEANS, PAGERANK_ROUNDS, label_means,
                                            pagerank_sql, weights_sql)
from lodestone.plans.registry import Tables, query

ROLE_WORDS = {"anvil": "data engineer", "bolt": "backend dev", "gear": "android dev",
              "gizmo": "devops", "plate": "tester", "ring": "manager", "rod": "AI researcher",
              "widget": "frontend dev"}
ROLES_SQL = "CASE " + " ".join(f"WHEN contains(p_name, '{w}') THEN '{r}'"
                               for w, r in ROLE_WORDS.items()) + " END"
# The same statement for both engines; the tables are filled in by name or by frame.
ADVERT_SQL = f"""
SELECT p_partkey AS id,
  CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'board_a'
       WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'board_b' ELSE 'board_c' END AS source,
  concat(p_name, ' ', {ROLES_SQL}) AS title_clean,
  CASE WHEN p_brand = 'Brand#1' THEN '' ELSE p_brand END AS company,
  CAST(CASE WHEN p_size = 50 THEN NULL WHEN p_size = 49 THEN 0
            WHEN p_name = 'new ring' THEN p_size * 6000000 + p_retailprice * 1000
            ELSE p_size * 1500000 + p_retailprice * 1000 END AS DOUBLE) AS salary_final_vnd,
  CASE WHEN length(p_brand) = 7 THEN 'Hồ Chí Minh' WHEN p_brand >= 'Brand#20' THEN 'Hà Nội'
       WHEN p_brand >= 'Brand#15' THEN 'Đà Nẵng, Hà Nội' WHEN p_brand = 'Brand#14' THEN 'Đà Nẵng'
       WHEN p_brand = 'Brand#13' THEN NULL ELSE 'Cần Thơ' END AS location_clean,
  CASE WHEN p_size > 45 THEN 1 WHEN p_size > 5 THEN 0 END AS is_remote,
  CASE p_type WHEN 'ECONOMY' THEN 'Fresher' WHEN 'SMALL' THEN 'Junior' WHEN 'MEDIUM' THEN 'Senior'
    WHEN 'LARGE' THEN 'Manager' WHEN 'STANDARD' THEN 'Undefined' END AS job_level,
  CASE WHEN p_size <= 48 THEN CAST(p_size AS DOUBLE) / 5 END AS yoe_extracted,
  CASE WHEN p_size > 1 THEN concat(replace(p_name, ' ', ', '), ',, ', p_type, ' ,') END
    AS skills_clean,
  CASE WHEN p_size > 30 THEN 4 WHEN p_size > 10 THEN 3 ELSE 2 END AS skill_count,
  text AS description_clean
FROM {{part}} LEFT JOIN {{documents}} ON doc_id = p_partkey"""


def adverts(t: Tables):
    """One advert per part; the document of the same number is its description."""
    return t.spark.sql(ADVERT_SQL, part=t.part, documents=t.documents)


JOBS = f"""jobs AS MATERIALIZED ({ADVERT_SQL.format(part="part", documents="documents")}),
skills AS (SELECT * FROM (SELECT *, trim(lower(unnest(string_split(skills_clean, ',')))) AS skill
           FROM jobs WHERE skills_clean IS NOT NULL) WHERE skill <> '')"""


def _job(name: str, sql: str | None = None):
    return query(f"job_{name}", None if sql is None else f"WITH {JOBS}\n{sql}")


PAY = """round(min(salary_final_vnd) FILTER (salary_final_vnd > 0) / 1e6, 1) AS "min_salary_M",
  round(avg(salary_final_vnd) FILTER (salary_final_vnd > 0) / 1e6, 1) AS "avg_salary_M",
  round(max(salary_final_vnd) FILTER (salary_final_vnd > 0) / 1e6, 1) AS "max_salary_M" """
MEDIAN = """round(quantile_disc(salary_final_vnd, 0.5) FILTER (salary_final_vnd > 0) / 1e6, 1)
  AS "median_salary_M" """


@_job("location", "SELECT location_clean, count(*) AS job_count FROM jobs GROUP BY 1")
def location(t: Tables):
    return recipes.location_counts(adverts(t))


@_job("top_skills", """
SELECT skill, count(*) AS job_count,
  round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM jobs), 2) AS pct_jobs
FROM skills GROUP BY skill ORDER BY job_count DESC, skill LIMIT 20""")
def top_skills(t: Tables):
    return recipes.top_skills(adverts(t))


@_job("salary_by_level", f"""
SELECT rank() OVER (ORDER BY "avg_salary_M" DESC)::INTEGER AS rank, * FROM (
  SELECT job_level, count(*) AS job_count, {PAY}, {MEDIAN}, round(avg(yoe_extracted), 1) AS avg_yoe
  FROM jobs WHERE job_level <> '' GROUP BY job_level)""")
def salary_by_level(t: Tables):
    return recipes.salary_by_level(adverts(t))


@_job("salary_by_skill", """
SELECT skill, count(*) AS job_count, round(avg(salary_final_vnd) / 1e6, 2) AS "avg_salary_M",
  round(min(salary_final_vnd) / 1e6, 2) AS "min_salary_M",
  round(quantile_disc(salary_final_vnd, 0.5) / 1e6, 2) AS "median_salary_M",
  round(max(salary_final_vnd) / 1e6, 2) AS "max_salary_M"
FROM skills WHERE salary_final_vnd > 0 GROUP BY skill HAVING count(*) >= 10
ORDER BY "avg_salary_M" DESC, skill LIMIT 15""")
def salary_by_skill(t: Tables):
    return recipes.salary_by_skill(adverts(t))


@_job("experience_salary", f"""
, b AS (SELECT *, CASE WHEN yoe_extracted <= 1 THEN 1 WHEN yoe_extracted <= 2 THEN 2
    WHEN yoe_extracted <= 4 THEN 3 WHEN yoe_extracted <= 6 THEN 4 WHEN yoe_extracted <= 9 THEN 5
    ELSE 6 END AS o FROM jobs WHERE salary_final_vnd > 0 AND yoe_extracted >= 0),
g AS (SELECT o, count(*) AS job_count, {PAY}, {MEDIAN} FROM b GROUP BY o)
SELECT list_extract(['00-01yr (Fresher)', '02yr    (Junior)', '03-04yr (Mid-level)',
    '05-06yr (Senior)', '07-09yr (Lead)', '10+yr   (Expert/Mgr)'], o) AS yoe_bucket,
  * EXCLUDE (o), round("avg_salary_M" - lag("avg_salary_M") OVER (ORDER BY o), 1)
    AS "salary_increase_M" FROM g""")
def experience_salary(t: Tables):
    return recipes.experience_salary(adverts(t))


@_job("company_hiring", f"""
, g AS (SELECT company, count(*) AS job_count, {PAY},
    string_agg(DISTINCT job_level, ' | ' ORDER BY job_level) AS levels_hired
  FROM jobs WHERE company <> '' GROUP BY company),
s AS (SELECT *, round(job_count * 100.0::DOUBLE / sum(job_count) OVER (), 2) AS market_share_pct
      FROM g),
k AS (SELECT * FROM s ORDER BY job_count DESC, company LIMIT 20)
SELECT rank() OVER (ORDER BY job_count DESC)::INTEGER AS rank, * FROM k""")
def company_hiring(t: Tables):
    return recipes.company_hiring(adverts(t))


OVERVIEW = """count(*) AS job_count,
  round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 1) AS pct_total,
  round(avg(salary_final_vnd) FILTER (salary_final_vnd > 0) / 1e6, 1) AS "avg_salary_M",
  round(quantile_disc(salary_final_vnd, 0.5) FILTER (salary_final_vnd > 0) / 1e6, 1)
    AS "median_salary_M",
  round(avg(skill_count), 1) AS avg_skills, round(avg(yoe_extracted), 1) AS avg_yoe"""
REMOTE = "CASE WHEN is_remote = 1 THEN 'Remote' ELSE 'On-site' END"


@_job("remote_overview", f"SELECT {REMOTE} AS work_type, {OVERVIEW} FROM jobs GROUP BY 1")
def remote_overview(t: Tables):
    return recipes.remote_overview(adverts(t))


@_job("remote_by_level", """
SELECT job_level, count(*) FILTER (is_remote = 1) AS remote_count,
  count(*) FILTER (is_remote IS DISTINCT FROM 1) AS onsite_count,
  round(avg(salary_final_vnd) FILTER (is_remote = 1 AND salary_final_vnd > 0) / 1e6, 1)
    AS "remote_avg_M",
  round(avg(salary_final_vnd) FILTER (is_remote IS DISTINCT FROM 1 AND salary_final_vnd > 0)
    / 1e6, 1) AS "onsite_avg_M"
FROM jobs WHERE job_level <> '' GROUP BY job_level""")
def remote_by_level(t: Tables):
    return recipes.remote_by_level(adverts(t))


@_job("remote_skills", """
SELECT skill, count(*) AS count FROM skills WHERE is_remote = 1 GROUP BY skill
ORDER BY count DESC, skill LIMIT 10""")
def remote_skills(t: Tables):
    return recipes.remote_skills(adverts(t))


@_job("level_overview", f"SELECT job_level, {OVERVIEW} FROM jobs WHERE job_level <> '' GROUP BY 1")
def level_overview(t: Tables):
    return recipes.level_overview(adverts(t))


@_job("level_by_source", """
SELECT source, count(*) FILTER (job_level = 'Fresher') AS "Fresher",
  count(*) FILTER (job_level = 'Junior') AS "Junior",
  count(*) FILTER (job_level = 'Manager') AS "Manager",
  count(*) FILTER (job_level = 'Senior') AS "Senior",
  count(*) FILTER (job_level = 'Undefined') AS "Undefined", count(*) AS total_jobs
FROM jobs WHERE job_level <> '' GROUP BY source""")
def level_by_source(t: Tables):
    return recipes.level_by_source(adverts(t))


@_job("source_level", """
SELECT source, job_level, count(*) AS job_count,
  round(avg(salary_final_vnd) FILTER (salary_final_vnd > 0) / 1e6, 1) AS "avg_salary_M",
  round(avg(yoe_extracted), 1) AS avg_yoe
FROM jobs WHERE job_level <> '' GROUP BY ALL ORDER BY job_count DESC, source, job_level LIMIT 15""")
def source_level(t: Tables):
    return recipes.source_level(adverts(t))


@_job("skill_pairs", """
, d AS (SELECT DISTINCT id, skill FROM skills)
SELECT x.skill || ' + ' || y.skill AS skill_pair, count(*) AS co_occurrence_count
FROM d x JOIN d y ON x.id = y.id AND x.skill < y.skill GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 50""")
def skill_pairs(t: Tables):
    return recipes.skill_pairs(adverts(t))


@_job("top_paying", """
SELECT coalesce(job_level, 'Unknown') AS job_level, company, title_clean, salary_final_vnd,
  row_number() OVER (PARTITION BY coalesce(job_level, 'Unknown')
                     ORDER BY salary_final_vnd DESC, id)::INTEGER AS rank,
  round(salary_final_vnd / 1e6, 1) AS "salary_M"
FROM jobs WHERE salary_final_vnd IS NOT NULL QUALIFY rank <= 3""")
def top_paying(t: Tables):
    return recipes.top_paying(adverts(t))


@_job("skill_by_city", """
, l AS (SELECT *, CASE WHEN contains(location_clean, 'Hồ Chí Minh') THEN 'HCM'
    WHEN contains(location_clean, 'Hà Nội') THEN 'HN'
    WHEN contains(location_clean, 'Đà Nẵng') THEN 'DN' END AS loc FROM skills
    WHERE salary_final_vnd IS NOT NULL),
c AS (SELECT skill,
    coalesce(round(avg(salary_final_vnd) FILTER (loc = 'HCM') / 1e6, 1), 0) AS "HCM",
    coalesce(round(avg(salary_final_vnd) FILTER (loc = 'HN') / 1e6, 1), 0) AS "HN",
    coalesce(round(avg(salary_final_vnd) FILTER (loc = 'DN') / 1e6, 1), 0) AS "DN"
  FROM l WHERE loc IS NOT NULL GROUP BY skill)
SELECT * FROM c WHERE "HCM" > 0 ORDER BY round(("HCM" + "HN" + "DN") / 3, 4) DESC, skill LIMIT 30""")
def skill_by_city(t: Tables):
    return recipes.skill_by_city(adverts(t))


@_job("salary_brackets", """
, b AS (SELECT CASE WHEN salary_final_vnd < 15e6 THEN 1 WHEN salary_final_vnd < 30e6 THEN 2
    WHEN salary_final_vnd < 50e6 THEN 3 WHEN salary_final_vnd < 80e6 THEN 4 ELSE 5 END AS o
  FROM jobs WHERE salary_final_vnd IS NOT NULL)
SELECT list_extract(['1. < 15 Triệu', '2. 15-30 Triệu', '3. 30-50 Triệu', '4. 50-80 Triệu',
    '5. > 80 Triệu'], o) AS salary_bucket, count(*) AS job_count,
  round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 1) AS share_pct FROM b GROUP BY o""")
def salary_brackets(t: Tables):
    return recipes.salary_brackets(adverts(t))


@_job("skill_rarity", """
SELECT skill, count(DISTINCT id) AS doc_freq, round(ln((
  SELECT count(*) FROM jobs WHERE skills_clean IS NOT NULL)::DOUBLE / count(DISTINCT id)), 4)
  AS idf_score
FROM skills GROUP BY skill HAVING doc_freq >= 5 ORDER BY idf_score DESC, skill LIMIT 50""")
def skill_rarity(t: Tables):
    return recipes.skill_rarity(adverts(t))


@_job("salary_outliers", """
, r AS (SELECT * FROM jobs WHERE salary_final_vnd IS NOT NULL AND job_level IS NOT NULL),
q AS (SELECT job_level, quantile_disc(salary_final_vnd, 0.25) AS q1,
             quantile_disc(salary_final_vnd, 0.75) AS q3 FROM r GROUP BY job_level)
SELECT company, title_clean, job_level, round(salary_final_vnd / 1e6, 1) AS "Salary_M",
  round((q3 + (q3 - q1) * 1.5) / 1e6, 1) AS "Limit_M"
FROM r JOIN q USING (job_level) WHERE salary_final_vnd > q3 + (q3 - q1) * 1.5""")
def salary_outliers(t: Tables):
    return recipes.salary_outliers(adverts(t))


@_job("salary_cube", f"""
, c AS (SELECT CASE WHEN contains(location_clean, 'Hồ Chí Minh') THEN 'HCM'
    WHEN contains(location_clean, 'Hà Nội') THEN 'HN' ELSE 'Other' END AS loc,
    CASE WHEN job_level IN ('Fresher', 'Junior', 'Senior', 'Manager') THEN job_level
         ELSE 'Other' END AS level, {REMOTE} AS remote_status, salary_final_vnd
  FROM jobs WHERE salary_final_vnd IS NOT NULL)
SELECT coalesce(loc, 'ALL') AS loc, coalesce(level, 'ALL') AS level,
  coalesce(remote_status, 'ALL') AS remote_status, count(*) AS job_count,
  round(avg(salary_final_vnd) / 1e6, 1) AS "avg_salary_M"
FROM c GROUP BY CUBE (loc, level, remote_status)""")
def salary_cube(t: Tables):
    return recipes.salary_cube(adverts(t))


@_job("company_market", """
, r AS (SELECT * FROM jobs WHERE company <> ''),
wc AS (SELECT company, skill, count(*) AS c FROM skills WHERE company <> '' GROUP BY ALL),
common AS (SELECT company, skill AS top_token FROM wc QUALIFY row_number() OVER (
             PARTITION BY company ORDER BY c DESC, skill) = 1),
m AS (SELECT count(*) AS mn, avg(salary_final_vnd) FILTER (salary_final_vnd > 0) AS mavg FROM r),
g AS (SELECT company, count(*) AS n, avg(salary_final_vnd) FILTER (salary_final_vnd > 0) AS a,
        round(max(salary_final_vnd) FILTER (salary_final_vnd > 0), 2) AS max_value,
        round(avg(yoe_extracted), 2) AS avg_experience, round(avg(is_remote) * 100, 2) AS flag_pct,
        string_agg(DISTINCT job_level, ' | ' ORDER BY job_level) AS levels
      FROM r GROUP BY company)
SELECT company, n, round(n * 100.0::DOUBLE / mn, 2) AS share_pct, round(a, 2) AS avg_value,
  round((a - mavg) * 100.0::DOUBLE / mavg, 2) AS vs_market_pct, max_value, avg_experience,
  flag_pct, top_token, levels
FROM g LEFT JOIN common USING (company) CROSS JOIN m""")
def company_market(t: Tables):
    return recipes.company_market(adverts(t))


@_job("market_summary", """
SELECT count(id) AS total, count(DISTINCT company) AS distinct_company,
  count(DISTINCT location_clean) AS distinct_location_clean,
  round(avg(salary_final_vnd), 4) AS avg_salary_final_vnd,
  round(avg(yoe_extracted), 4) AS avg_yoe_extracted,
  min(salary_final_vnd) AS min_salary_final_vnd, max(salary_final_vnd) AS max_salary_final_vnd
FROM jobs""")
def market_summary(t: Tables):
    return recipes.market_summary(adverts(t))


@_job("pay_histogram", """
, s AS (SELECT min(salary_final_vnd) AS lo, max(salary_final_vnd) AS hi, (hi - lo) / 30 AS w
        FROM jobs),
b AS (SELECT least(floor((salary_final_vnd - lo) / w)::BIGINT + 1, 30) AS bin, count(*) AS n
      FROM jobs, s WHERE salary_final_vnd IS NOT NULL GROUP BY 1)
SELECT i AS bin, lo + (i - 1) * w AS low, lo + i * w AS high, coalesce(n, 0) AS n
FROM s, range(1, 31) r(i) LEFT JOIN b ON b.bin = i""")
def pay_histogram(t: Tables):
    return recipes.pay_histogram(adverts(t))


TAGS = {**BENEFIT_PATTERNS, **SOFT_SKILL_PATTERNS}


@_job("benefit_tags", "\nUNION ALL ".join(
    f"SELECT '{name}' AS tag, count(*) FILTER (regexp_matches(lower(description_clean), '{p}')) AS n,"
    f" round(count(*) FILTER (regexp_matches(lower(description_clean), '{p}')) * 100.0::DOUBLE"
    " / count(*), 1) AS pct FROM jobs" for name, p in TAGS.items()))
def benefit_tags(t: Tables):
    return recipes.benefit_tags(adverts(t))


@_job("skill_network", """
, d AS (SELECT DISTINCT id, trim(skill) AS skill FROM (
          SELECT id, unnest(string_split(skills_clean, ',')) AS skill FROM jobs
          WHERE skills_clean IS NOT NULL) WHERE trim(skill) <> '')
SELECT x.skill AS a, y.skill AS b, count(*) AS n FROM d x JOIN d y
ON x.id = y.id AND x.skill < y.skill GROUP BY ALL HAVING count(*) >= 15""")
def skill_network(t: Tables):
    return recipes.skill_network(adverts(t))


SKILL_EDGES = """
, t AS (SELECT DISTINCT id, trim(skill) AS skill FROM (
          SELECT id, unnest(string_split(skills_clean, ',')) AS skill FROM jobs
          WHERE skills_clean IS NOT NULL) WHERE trim(skill) <> ''),
e AS (SELECT x.skill AS a, y.skill AS b, count(*) AS n FROM t x JOIN t y
      ON x.id = y.id AND x.skill < y.skill GROUP BY ALL HAVING count(*) >= 15),
d AS (SELECT a AS src, b AS dst, n AS w FROM e UNION ALL SELECT b, a, n FROM e)"""


@_job("skill_ranks", pagerank_sql(SKILL_EDGES, 4))
def skill_ranks(t: Tables):
    return recipes.skill_ranks(adverts(t), max_rounds=PAGERANK_ROUNDS, tolerance=None)


@_job("skill_rules", """
, d AS (SELECT DISTINCT id, trim(skill) AS skill FROM (
          SELECT id, unnest(string_split(skills_clean, ',')) AS skill FROM jobs
          WHERE skills_clean IS NOT NULL) WHERE trim(skill) <> ''),
n AS (SELECT count(DISTINCT id) AS n FROM d),
s1 AS (SELECT skill, count(*) AS f FROM d GROUP BY skill HAVING count(*) >= ceil(0.02 * (FROM n))),
s2 AS (SELECT x.skill AS i, y.skill AS j, count(*) AS f FROM d x JOIN d y ON x.id = y.id
       AND x.skill <> y.skill GROUP BY ALL HAVING count(*) >= ceil(0.02 * (FROM n)))
SELECT s2.i AS antecedent, s2.j AS consequent, round(s2.f / n, 6) AS support,
  round(s2.f / a.f, 6) AS confidence, round(s2.f * n / (a.f * c.f), 6) AS lift
FROM s2 JOIN s1 a ON a.skill = s2.i JOIN s1 c ON c.skill = s2.j CROSS JOIN n
WHERE s2.f / a.f >= 0.1 AND s2.f * n / (a.f * c.f) > 1
ORDER BY s2.f * n / (a.f * c.f) DESC, s2.i, s2.j LIMIT 20""")
def skill_rules(t: Tables):
    """At 2 % support: no set of three reaches it, so the SQL with pairs only is complete."""
    out = recipes.skill_rules(adverts(t), support=0.02, confidence=0.1)
    return out.select(F.array_join("antecedent", ", ").alias("antecedent"),
                      F.array_join("consequent", ", ").alias("consequent"),
                      *[F.round(c, 6).alias(c) for c in ("support", "confidence", "lift")])


ADVERT_MEANS = LABEL_MEANS.replace(
    "CROSS JOIN embeddings", "CROSS JOIN (FROM embeddings WHERE vec_id IN (SELECT id FROM jobs))")


@_job("recommend", f"""
, {ADVERT_MEANS}
SELECT query, rank, title_clean AS title, company, coalesce(skills_clean, 'No skills listed') AS skills,
  CASE WHEN salary_final_vnd IS NULL OR salary_final_vnd = 0 THEN 'Thương lượng'
       ELSE salary_final_vnd::BIGINT || ' VND' END AS salary,
  'https://ads.example.org/' || id AS url, score AS similarity_score
FROM best JOIN jobs ON id = item""")
def recommend(t: Tables):
    pay = F.col("salary_final_vnd").cast("bigint").cast("string")
    rows = adverts(t).withColumns({
        "salary": F.when(F.col("salary_final_vnd") == 0, F.lit("")).otherwise(
            F.concat(pay, F.lit(" VND USD"))),
        "url": F.concat(F.lit("https://ads.example.org/"), F.col("id").cast("string"))})
    vectors = t.embeddings.select(F.col("vec_id").alias("id"), "embedding")
    return recipes.recommend(rows, vectors, label_means(t))


MAIN_LEVELS = ", ".join(f"'{x}'" for x in LEVELS)


@_job("level_terms", f"""
, {weights_sql(f"SELECT job_level AS lang, coalesce(description_clean, '') AS text FROM jobs "
               f"WHERE job_level IN ({MAIN_LEVELS})", FEW_STOP_WORDS)}
SELECT lang AS job_level, term, score,
  row_number() OVER (PARTITION BY lang ORDER BY score DESC, term)::INTEGER AS rank
FROM sc QUALIFY rank <= 15""")
def level_terms(t: Tables):
    return recipes.level_terms(adverts(t), stop=FEW_STOP_WORDS)


@_job("segments")
def segments(t: Tables):
    rows, _ = recipes.job_segments(adverts(t))
    return class_means(rows, "cluster", ["salary_final_vnd", "yoe_extracted", "skill_count"])


@_job("difficulty")
def difficulty(t: Tables):
    return class_means(recipes.job_difficulty(adverts(t)), "level",
                       ["richness", "skill_count", "yoe_extracted"])


@_job("level_predictions")
def level_predictions(t: Tables):
    return class_report(recipes.level_predictions(adverts(t), trees=20), "job_level",
                        "prediction")


@_job("role_predictions")
def role_predictions(t: Tables):
    return class_report(recipes.role_predictions(adverts(t)), "role", "prediction")


@_job("salary_models")
def salary_models(t: Tables):
    return recipes.salary_models(adverts(t), trees=20).scores


@_job("topic_share")
def topic_share(t: Tables):
    return recipes.topic_share(adverts(t))
