"""The market analyses as recipes over an advert table.

Every function takes a frame with the advert columns (see
:data:`lodestone.sources.catalog.JOB_COLUMNS`) and returns its result; the defaults are the
analyses' own parameters. Money is reported in millions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.columns import (combine_text, first_match, flag_label, scaled,
                                         whitelist)
from lodestone.functions.wordlists import (BENEFIT_PATTERNS, CITY_RULES, LEVELS, NO_PAY_TEXT,
                                           ROLE_RULES, SALARY_EDGES, SALARY_LABELS,
                                           SOFT_SKILL_PATTERNS, YEAR_EDGES, YEAR_LABELS)
from lodestone.operators import aggregate as agg
from lodestone.operators import basket, graph, joins, models, similarity, text, tokens, window
from lodestone.operators.clean import (fill_constants, fill_median, keep_valid, typed,
                                       value_label)
from lodestone.operators.text import TopicModel
from lodestone.session import cut_lineage

M = 1e6
TYPES = {"salary_final_vnd": "double", "yoe_extracted": "double", "skill_count": "int",
         "is_remote": "int"}
PROFILE = {"n": "job_count", "min_value": "min_salary_M", "avg_value": "avg_salary_M",
           "median_value": "median_salary_M", "max_value": "max_salary_M"}


def _pick(df: DataFrame, names: Mapping[str, str], *columns: str) -> DataFrame:
    """Rename, then select by new name."""
    return df.withColumnsRenamed(dict(names)).select(*columns)


def _cast(jobs: DataFrame) -> DataFrame:
    return typed(jobs, {c: t for c, t in TYPES.items() if c in jobs.columns})


def _skilled(jobs: DataFrame) -> DataFrame:
    return keep_valid(jobs, not_null=["skills_clean"], not_empty=["skills_clean"])


# Reports ----------------------------------------------------------------------------------


def location_counts(jobs: DataFrame) -> DataFrame:
    """Adverts per location; a missing location is a group of its own."""
    return agg.value_counts(jobs, "location_clean", name="job_count")


def top_skills(jobs: DataFrame, k: int = 20) -> DataFrame:
    """Commonest skills and their share of all adverts."""
    out = tokens.top_tokens(jobs, "skills_clean", k)
    return _pick(out, {"token": "skill", "n": "job_count", "share_pct": "pct_jobs"},
                 "skill", "job_count", "pct_jobs")


def salary_by_level(jobs: DataFrame) -> DataFrame:
    """Pay and experience per level, ranked by the rounded average."""
    rows = _cast(keep_valid(jobs, not_null=["job_level"], not_empty=["job_level"]))
    profile = agg.group_profile(rows, ["job_level"], "salary_final_vnd", M, 1, median=True,
                                extra={"avg_yoe": F.round(F.avg("yoe_extracted"), 1)})
    ranked = window.ranked_all(cut_lineage(profile), "avg_value")
    return _pick(ranked, PROFILE, "rank", "job_level", "job_count", "min_salary_M",
                 "avg_salary_M", "median_salary_M", "max_salary_M", "avg_yoe")


def salary_by_skill(jobs: DataFrame, min_rows: int = 10, k: int = 15) -> DataFrame:
    """Best paid skills with at least ``min_rows`` adverts."""
    out = tokens.token_value_profile(_cast(_skilled(jobs)), "skills_clean", "salary_final_vnd",
                                     min_rows, k, unit=M)
    return _pick(out, {**PROFILE, "token": "skill"}, "skill", "job_count", "avg_salary_M",
                 "min_salary_M", "median_salary_M", "max_salary_M")


def experience_salary(jobs: DataFrame) -> DataFrame:
    """Pay per experience bucket and its step from the bucket below."""
    rows = keep_valid(_cast(jobs), positive=["salary_final_vnd"], non_negative=["yoe_extracted"])
    steps = agg.bucket_delta(rows, "yoe_extracted", "salary_final_vnd", YEAR_EDGES, YEAR_LABELS,
                             M, 1)
    return _pick(steps, {**PROFILE, "bucket": "yoe_bucket", "delta": "salary_increase_M"},
                 "yoe_bucket", "job_count", "min_salary_M", "avg_salary_M", "median_salary_M",
                 "max_salary_M", "salary_increase_M")


def company_hiring(jobs: DataFrame, k: int = 20) -> DataFrame:
    """Largest employers with market share, pay and levels hired; ties share a rank."""
    rows = _cast(keep_valid(jobs, not_null=["company"], not_empty=["company"]))
    profile = agg.group_profile(rows, ["company"], "salary_final_vnd", M, 1,
                                extra={"levels_hired": agg.joined_set("job_level")})
    ranked = window.ranked_top_k(agg.with_share(profile, "n"), "n", "company", k)
    return _pick(ranked, {**PROFILE, "share_pct": "market_share_pct"}, "rank", "company",
                 "job_count", "market_share_pct", "avg_salary_M", "min_salary_M",
                 "max_salary_M", "levels_hired")


def _work_type(jobs: DataFrame) -> DataFrame:
    return _cast(jobs).withColumn("work_type", flag_label("is_remote", "Remote", "On-site"))


def _overview(rows: DataFrame, key: str) -> DataFrame:
    """Count, share, pay, skills and experience per key."""
    means = {"avg_skills": F.round(F.avg("skill_count"), 1),
             "avg_yoe": F.round(F.avg("yoe_extracted"), 1)}
    profile = agg.group_profile(rows, [key], "salary_final_vnd", M, 1, median=True, extra=means)
    out = agg.with_share(profile, "n", name="pct_total", digits=1)
    return _pick(out, PROFILE, key, "job_count", "pct_total", "avg_salary_M", "median_salary_M",
                 "avg_skills", "avg_yoe").orderBy(F.desc("job_count"), F.asc(key))


def remote_overview(jobs: DataFrame) -> DataFrame:
    return _overview(_work_type(jobs), "work_type")


def remote_by_level(jobs: DataFrame) -> DataFrame:
    rows = keep_valid(_work_type(jobs), not_null=["job_level"], not_empty=["job_level"])
    out = agg.conditional_counts(rows, "job_level", F.col("work_type") == "Remote",
                                 "salary_final_vnd", "remote", "onsite", M, 1)
    return (_pick(out, {"n_remote": "remote_count", "n_onsite": "onsite_count",
                        "avg_remote": "remote_avg_M", "avg_onsite": "onsite_avg_M"},
                  "job_level", "remote_count", "onsite_count", "remote_avg_M", "onsite_avg_M")
            .orderBy(F.desc(F.col("remote_count") + F.col("onsite_count")), F.asc("job_level")))


def remote_skills(jobs: DataFrame, k: int = 10) -> DataFrame:
    remote = _work_type(jobs).filter(F.col("work_type") == "Remote")
    return _pick(tokens.top_tokens(remote, "skills_clean", k), {"token": "skill", "n": "count"},
                 "skill", "count")


def _placed(jobs: DataFrame) -> DataFrame:
    return _cast(keep_valid(jobs, not_null=["job_level", "source"],
                            not_empty=["job_level", "source"]))


def level_overview(jobs: DataFrame) -> DataFrame:
    return _overview(_placed(jobs), "job_level")


def level_by_source(jobs: DataFrame, levels: Sequence[str] | None = None) -> DataFrame:
    return agg.pivot_counts(_placed(jobs), "source", "job_level", levels, total="total_jobs")


def source_level(jobs: DataFrame, k: int = 15) -> DataFrame:
    profile = agg.group_profile(_placed(jobs), ["source", "job_level"], "salary_final_vnd", M, 1,
                                extra={"avg_yoe": F.round(F.avg("yoe_extracted"), 1)})
    best = window.top_k(profile, [F.desc("n"), F.asc("source"), F.asc("job_level")], k)
    return _pick(best, PROFILE, "source", "job_level", "job_count", "avg_salary_M", "avg_yoe")


def skill_pairs(jobs: DataFrame, k: int = 50) -> DataFrame:
    out = tokens.pair_cooccurrence(jobs, "skills_clean", k)
    return _pick(out, {"pair": "skill_pair", "n": "co_occurrence_count"}, "skill_pair",
                 "co_occurrence_count")


def top_paying(jobs: DataFrame, n: int = 3, tie: str = "id") -> DataFrame:
    """Best paid adverts of each level."""
    rows = fill_constants(_cast(jobs), {"job_level": "Unknown"})
    rows = keep_valid(rows, not_null=["salary_final_vnd"])
    best = window.top_n_per_group(rows, ["job_level"],
                                  [F.desc("salary_final_vnd"), F.asc(tie)], n, rank="rank")
    return best.select("job_level", "company", "title_clean", "salary_final_vnd", "rank",
                       scaled("salary_final_vnd").alias("salary_M")).orderBy("job_level", "rank")


def skill_by_city(jobs: DataFrame, k: int = 30) -> DataFrame:
    """Average pay per skill in the three cities."""
    rows = _cast(jobs).withColumn("loc", first_match("location_clean", CITY_RULES, "Other",
                                                     how="like"))
    rows = keep_valid(rows.filter(F.col("loc") != "Other"),
                      not_null=["skills_clean", "salary_final_vnd"])
    exploded = tokens.explode_tokens(rows.select("loc", "salary_final_vnd", "skills_clean"),
                                     "skills_clean", name="skill")
    cities = [code for _, code in CITY_RULES]
    return agg.pivot_average(exploded, "skill", "loc", cities, "salary_final_vnd", "HCM", k,
                             M).drop("row_mean")


def salary_brackets(jobs: DataFrame) -> DataFrame:
    rows = keep_valid(_cast(jobs), not_null=["salary_final_vnd"])
    out = agg.bracket_counts(rows, "salary_final_vnd", SALARY_EDGES, SALARY_LABELS)
    return _pick(out, {"bracket": "salary_bucket", "n": "job_count"}, "salary_bucket",
                 "job_count", "share_pct")


def skill_rarity(jobs: DataFrame, doc: str = "id", min_docs: int = 5, k: int = 50) -> DataFrame:
    out = tokens.token_rarity(jobs, doc, "skills_clean", min_docs, k)
    return _pick(out, {"token": "skill", "idf": "idf_score"}, "skill", "doc_freq", "idf_score")


def salary_outliers(jobs: DataFrame) -> DataFrame:
    """Adverts paid far above their level."""
    rows = keep_valid(_cast(jobs), not_null=["salary_final_vnd", "job_level"]).select(
        "company", "title_clean", "job_level", "salary_final_vnd")
    out = joins.upper_outliers(rows, "job_level", "salary_final_vnd")
    return out.orderBy(F.desc("salary_final_vnd"), F.asc("company"), F.asc("title_clean")).select(
        "company", "title_clean", "job_level", scaled("salary_final_vnd").alias("Salary_M"),
        scaled("fence").alias("Limit_M"))


def salary_cube(jobs: DataFrame) -> DataFrame:
    """Count and average pay over city, level and work type with all subtotals."""
    rows = keep_valid(_cast(jobs), not_null=["salary_final_vnd"])
    rows = rows.select(
        first_match("location_clean", CITY_RULES[:2], "Other", how="like").alias("loc"),
        whitelist("job_level", LEVELS, "Other").alias("level"),
        flag_label("is_remote", "Remote", "On-site").alias("remote_status"), "salary_final_vnd")
    return agg.cube_totals(rows, ["loc", "level", "remote_status"],
                           averages={"avg_salary_M": F.col("salary_final_vnd") / M},
                           count="job_count")


def company_market(jobs: DataFrame) -> DataFrame:
    """Each employer against the market average."""
    rows = _cast(keep_valid(jobs, not_null=["company"], not_empty=["company"]))
    words = tokens.explode_tokens(rows.select("company", "skills_clean"), "skills_clean")
    return agg.group_vs_market(rows, "company", "salary_final_vnd", "yoe_extracted", "is_remote",
                               words, "token", "job_level")


def market_summary(jobs: DataFrame) -> DataFrame:
    """One row of totals over the active adverts."""
    return agg.summary(jobs, "id", ["company", "location_clean"],
                       ["salary_final_vnd", "yoe_extracted"], ["salary_final_vnd"])


def pay_histogram(jobs: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width pay histogram of all adverts with a known amount."""
    return agg.equal_width_histogram(_cast(jobs), "salary_final_vnd", bins)


# Mining -----------------------------------------------------------------------------------


def benefit_tags(jobs: DataFrame) -> DataFrame:
    """Adverts that mention each benefit or soft skill; each advert counts once per tag."""
    return tokens.tag_counts(jobs, "description_clean",
                             {**BENEFIT_PATTERNS, **SOFT_SKILL_PATTERNS}, compose=True)


def level_terms(jobs: DataFrame, top: int = 15,
                stop: Sequence[str] | None = None) -> DataFrame:
    """Characteristic words and word pairs of the main levels."""
    rows = jobs.filter(F.col("job_level").isin(*LEVELS))
    return text.term_weights(rows, "job_level", "description_clean", 1500, top, stop)


def skill_baskets(jobs: DataFrame, key: str = "id") -> DataFrame:
    """(advert, skill) rows, letter case kept."""
    return tokens.explode_tokens(jobs.select(key, "skills_clean"), "skills_clean", lower=False,
                                 name="skill")


def skill_rules(jobs: DataFrame, support: float = 0.05, confidence: float = 0.3,
                k: int = 20) -> DataFrame:
    sets = basket.frequent_itemsets(skill_baskets(jobs), "id", "skill", support)
    return basket.association_rules(sets, confidence, 1.0, k)


def skill_network(jobs: DataFrame, min_weight: int = 15) -> DataFrame:
    """Edges between skills named together in at least ``min_weight`` adverts."""
    return basket.basket_pairs(skill_baskets(jobs), "id", "skill", min_count=min_weight)


def skill_ranks(jobs: DataFrame, min_weight: int = 15, k: int = 20, max_rounds: int = 100,
                tolerance: float | None = 1e-6) -> DataFrame:
    """Skills by PageRank in their network; ``tolerance`` None runs exactly ``max_rounds``."""
    scores = graph.pagerank(skill_network(jobs, min_weight), max_rounds=max_rounds,
                            tolerance=tolerance)
    return graph.top_nodes(scores, k)


def job_segments(jobs: DataFrame, k: int = 4, seed: int = 42):
    """Adverts with their segment, and the fitted model."""
    rows = fill_median(_cast(jobs), ["salary_final_vnd"])
    rows = fill_constants(rows, {"yoe_extracted": 0.0, "skill_count": 0, "is_remote": 0,
                                 "job_level": "Unknown"})
    scaled_rows, _ = models.scaled_features(
        rows, ["salary_final_vnd", "yoe_extracted", "skill_count", "is_remote"], ["job_level"])
    return models.kmeans(scaled_rows, k, seed=seed)


def job_difficulty(jobs: DataFrame, key: str = "id") -> DataFrame:
    """Adverts graded by lexical richness, number of skills and experience."""
    rows = fill_constants(_cast(jobs), {"yoe_extracted": 0.0, "skill_count": 0})
    rich = text.lexical_richness(rows, key, "description_clean")
    # The fits pass over the rows many times: they read the numbers, not the joins behind them.
    rows = cut_lineage(rows.select(key, "skill_count", "yoe_extracted").join(rich, key))
    return models.difficulty(rows, ["richness", "skill_count", "yoe_extracted"])


def level_predictions(jobs: DataFrame, key: str = "id", trees: int = 100) -> DataFrame:
    rows = keep_valid(_cast(jobs), not_null=["job_level"]).filter("job_level != 'Undefined'")
    rows = fill_constants(rows, {"yoe_extracted": 0.0, "skill_count": 0})
    rows = rows.withColumn("_words", combine_text("title_clean", "skills_clean"))
    return models.classify_forest(rows, key, "job_level", "_words",
                                  ["yoe_extracted", "skill_count"], trees=trees)


def role_predictions(jobs: DataFrame, key: str = "id") -> DataFrame:
    rows = jobs.withColumn("role", first_match("title_clean", ROLE_RULES, "Others", lower=True))
    rows = fill_constants(rows.filter("role != 'Others'"), {"description_clean": ""})
    return models.classify_svm(rows, key, "role", "description_clean")


def salary_models(jobs: DataFrame, key: str = "id", trees: int = 100) -> models.RegressionBakeOff:
    rows = fill_constants(_cast(jobs), {
        "job_level": "Unknown", "location_clean": "Unknown", "yoe_extracted": 0.0,
        "skill_count": 0, "is_remote": 0, "skills_clean": ""})
    return models.RegressionBakeOff(
        rows, key, "salary_final_vnd", ["yoe_extracted", "skill_count", "is_remote"],
        ["job_level", "location_clean"], "skills_clean", trees=trees)


def topics(jobs: DataFrame, n: int = 5) -> TopicModel:
    return TopicModel(jobs, "description_clean", n)


def topic_share(jobs: DataFrame, model: TopicModel | None = None, n: int = 5) -> DataFrame:
    """Share of each dominant topic per level. Without a ``model`` one is fitted on the adverts, and
    its word counts serve for the topics too."""
    if model is None:
        rows = TopicModel(jobs, "description_clean", n, keep=["job_level"]).assigned()
    else:
        rows = model.assign(jobs)
    rows = fill_constants(rows, {"job_level": "Unknown"})
    return agg.crosstab_share(rows, "job_level", "topic", range(n))


def recommend(jobs: DataFrame, vectors: DataFrame, profiles: DataFrame, k: int = 5,
              key: str = "id", vector: str = "embedding") -> DataFrame:
    """The ``k`` adverts closest to every profile vector, ready for display.

    ``vectors`` holds (key, vector) rows of the adverts, ``profiles`` (query, vector) rows.
    """
    # Only vectors of adverts at hand take places.
    vectors = vectors.join(jobs.select(key), key, "left_semi")
    best = similarity.similar_top_k(profiles, vectors, "query", key, vector, k)
    shown = jobs.select(
        F.col(key).alias("item"), F.coalesce("title_clean", F.lit("Unknown")).alias("title"),
        F.coalesce("company", F.lit("Unknown Company")).alias("company"),
        F.coalesce("skills_clean", F.lit("No skills listed")).alias("skills"),
        value_label("salary", NO_PAY_TEXT, "Thương lượng", "USD",
                    ["đ", "vnd"]).alias("salary"),
        F.coalesce("url", F.lit("#")).alias("url"))
    return best.join(shown, "item").select(
        "query", "rank", "title", "company", "skills", "salary", "url",
        F.col("score").alias("similarity_score"))
