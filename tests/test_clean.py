import pytest
from pyspark.sql import functions as F

from lodestone.functions import columns as c
from lodestone.functions.wordlists import SALARY_EDGES, YEAR_EDGES
from lodestone.operators import clean
from tests.helpers import rows


def test_tokens_are_trimmed_lowered_and_kept_when_repeated(spark):
    from lodestone.operators.tokens import explode_tokens
    df = spark.createDataFrame([(1, "Java, Python,,SQL ,"), (2, ""), (3, None), (4, "java,Java")],
                               "id int, s string")
    assert rows(explode_tokens(df, "s"), "id", "token") == [
        (1, "java"), (1, "python"), (1, "sql"), (4, "java"), (4, "java")]
    assert rows(explode_tokens(df, "s", distinct=True), "id", "token")[-1] == (4, "java")


def test_separator_is_taken_literally(spark):
    df = spark.createDataFrame([("a|b.c",)], "s string")
    assert df.select(c.token_array("s", "|")).first()[0] == ["a", "b.c"]
    assert df.select(c.token_array("s", ".")).first()[0] == ["a|b", "c"]


@pytest.mark.parametrize("edges, closed, values, expected", [
    (SALARY_EDGES, False, [14999999.99, 15e6, 30e6, 50e6, 80e6], [1, 2, 3, 4, 5]),
    (YEAR_EDGES, True, [0.0, 1.0, 1.5, 2.0, 4.0, 4.5, 9.0, 9.1], [1, 1, 2, 2, 3, 4, 5, 6])])
def test_bucket_edges(spark, edges, closed, values, expected):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(99, None)],
                               "i int, v double")
    got = df.orderBy("i").select(c.bucket_index("v", edges, closed)).collect()
    assert [r[0] for r in got] == [*expected, None]


def test_first_matching_rule_wins_and_matches_substrings(spark):
    df = spark.createDataFrame([("E-mail Backend",), ("Backend",), (None,)], "s string")
    rules = [(["data", "ai"], "Data"), (["backend"], "Web")]
    got = [r[0] for r in df.select(c.first_match("s", rules, "Other", lower=True)).collect()]
    assert got == ["Data", "Web", "Other"]


def test_facets(spark):
    df = spark.createDataFrame(
        [(1, "HN, HCM", None, 3.0), (2, "HCM", 10.0, None), (3, "DN", 10.0, 2.0),
         (4, "HN", 99.0, 2.0), (5, "Hue", 10.0, 2.0)], "id int, loc string, pay double, yoe double")
    both = clean.Facets(contains_any={"loc": ["HN", "DN"]})
    assert rows(clean.faceted_filter(df, both), "id") == [(1,), (3,), (4,)]
    pay = clean.Facets(range_or_null={"pay": (5, 50)})
    assert rows(clean.faceted_filter(df, pay), "id") == [(1,), (2,), (3,), (5,)]
    years = clean.Facets(range_strict={"yoe": (2.5, None)})
    assert rows(clean.faceted_filter(df, years), "id") == [(1,)]
    assert clean.faceted_filter(df, clean.Facets(one_of={"loc": []})).count() == 5


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    assert [r[0] for r in clean.typed(df, {"v": "double"}).collect()] == [1.5, None, None]


def test_median_fill_takes_the_mean_of_the_middle(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (100.0,), (None,)], "v double")
    assert (3.0,) in rows(clean.fill_median(df, ["v"]))


def test_page_has_total_and_nulls_last(spark):
    df = spark.createDataFrame([(i, float(i) if i % 3 else None) for i in range(10)],
                               "id int, v double")
    page = clean.paginate(df, "v", "id", ascending=True, page=2, size=4).collect()
    assert [r["id"] for r in page] == [7, 8, 0, 3]
    assert {r["total_rows"] for r in page} == {10}


def test_content_id_has_no_null_hole(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    ids = [r[0] for r in df.select(c.content_id("x", "y")).collect()]
    assert ids[0] == ids[1] != ids[2]


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert df.select(F.round(c.cosine("a", "b"), 6)).first()[0] == 0.707107
