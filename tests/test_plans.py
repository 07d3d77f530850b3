"""Physical plans: no cross joins, no Python where built-ins do, limits and filters pushed."""

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
SET_BASED = [
    "value_counts", "group_profile", "group_median", "group_vs_market", "pivot_named", "cube_totals",
    "histogram", "bucket_delta", "outliers_iqr", "median_fill", "attach_total", "page_slice",
    "token_top_k", "token_value_profile", "token_rarity", "pair_cooccurrence", "basket_pairs",
    "edges", "degree", "graph_size", "tag_counts", "dictionary_terms", "term_weights", "richness",
    "insert_if_absent", "upsert", "set_field", "soft_delete", "hard_delete", "retention",
    "class_report", "balanced_weights", "job_company_market", "job_skill_by_city"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SET_BASED)
def test_no_cross_join_and_no_python(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "EvalPython" not in text and "InPandas" not in text


@pytest.mark.parametrize("name", ["top_n_per_group", "top_n_stats", "job_top_paying", "dedupe"])
def test_groups_are_limited_before_the_shuffle(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    below = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below


@pytest.mark.parametrize("name", ["top_k", "token_top_k", "page_slice", "recent_deleted"])
def test_top_k_is_a_heap(spark, data, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, data))


@pytest.mark.parametrize("name, pushed, columns", [
    ("point_lookup", "EqualTo(c_custkey,7)", None),
    ("recent_deleted", "EqualTo(o_orderstatus,F)", None),
    ("value_counts", None, "ReadSchema: struct<event_type:string>"),
    ("basket_pairs", None, "struct<l_orderkey:bigint,l_partkey:bigint>"),
    ("token_value_profile", "GreaterThan(p_retailprice,0.0)", "p_name:string")])
def test_scans_are_pruned(spark, data, name, pushed, columns):
    text = plan(QUERIES[name](spark, data))
    assert pushed is None or pushed in text
    assert columns is None or columns in text


def test_counts_are_summed_before_the_shuffle(spark, data):
    text = plan(QUERIES["pair_cooccurrence"](spark, data))
    assert "partial_count" in text


@pytest.mark.parametrize("name", ["term_weights", "richness", "token_rarity", "tag_counts",
                                  "page_posting", "page_links"])
def test_raw_text_is_not_dealt_out_again(spark, data, name):
    assert "RoundRobinPartitioning" not in plan(QUERIES[name](spark, data))
