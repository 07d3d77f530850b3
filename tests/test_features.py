"""Places and pay of pages, tags with clues, distinct counts in cubes, means of wide categories."""

import itertools
import unicodedata

import pytest
from pyspark.sql import functions as F

from lodestone.functions import salary
from lodestone.functions.text import clues
from lodestone.functions.wordlists import BENEFIT_PATTERNS, SOFT_SKILL_PATTERNS
from lodestone.operators import aggregate as agg
from lodestone.operators import extract, models, tokens
from tests.helpers import rows


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize("place, want", [
    ('{"address": {"addressLocality": " Quận 1 ", "addressRegion": "Hồ Chí Minh"}}', "Quận 1, Hồ Chí Minh"),
    ('[{"address": {"addressLocality": "Remote", "addressRegion": "Hà Nội"}}, {"name": "b"}]', "Hà Nội"),
    ('{"address": {"addressLocality": "remote"}}', "remote"),
    ('{"address": {}, "name": "Tower &amp; Co"}', "Tower & Co"),
    ('{"address": "x"}', "Unknown"), ("[]", "Unknown"), ("null", "Unknown")])
def test_posting_place(spark, place, want):
    page = f'<script type="application/ld+json">{{"@type": "JobPosting", "jobLocation": {place}}}</script>'
    assert one(spark, page, lambda x: extract.posting_place(extract.posting(x))) == want


def test_first_city(spark):
    for lines, want in ((["x", "Đà Nẵng, Hà Nội", "Hồ Chí Minh"], "HN"), (["hà nội"], ""), ([], "")):
        assert one(spark, "|".join(lines), lambda x: extract.first_city(F.split(x, "[|]"))) == want


@pytest.mark.parametrize("lines, want", [
    (["Tuyển 5 người", "15 - 20 Triệu", "Thương lượng"], "15 - 20 Triệu"),
    (["Lương: THƯƠNG LƯỢNG", "1"], "Thương lượng"), (["trả USD", "x" * 90 + " 5"], "trả USD"),
    (["trả USD", "từ 10"], "từ 10"), (["không có"], None), (["Fresher 10 triệu", "intern 5"], None)])
def test_pay_block(spark, lines, want):
    assert one(spark, "|".join(lines), lambda x: salary.pay_block(F.split(x, "[|]"))) == want


def test_clues_never_lose_a_match(spark):
    assert clues("(a|bc)d") == ["d"] or clues("(a|bc)d") == ["a", "bc"]
    assert clues("[0-9]+") == [] and clues("x*") == [] and clues("(a|[bc])") == []
    assert clues("ab?c") in (["a"], ["c"]) and clues("(ab)+") == ["ab"] and clues("(ab)?") == []
    patterns = {**BENEFIT_PATTERNS, **SOFT_SKILL_PATTERNS, "m": "[a-z]+@[a-z]+", "t": "(^| )the "}
    texts = ["Tháng 13 bonus", "13th  month", "HYBRID", "work\tfrom home", "mail a@b", "the end", " the x",
             "tiếng anh", "Thưởng", "none", "", None, "team  work", "làm việc nhóm", "in the "]
    texts += [unicodedata.normalize("NFD", t) for t in texts if t]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = {r["tag"]: r["n"] for r in tokens.tag_counts(df, "x", patterns, compose=True).collect()}
    low = [unicodedata.normalize("NFC", t or "").lower() for t in texts]
    plain = spark.createDataFrame([(t,) for t in low], "x string")
    want = plain.select([F.count_if(F.col("x").rlike("(?U)" + p)).alias(n) for n, p in patterns.items()]).first()
    assert got == want.asDict() and sum(got.values()) > 15


def test_tokens_keep_their_case_rules(spark):
    df = spark.createDataFrame([(" A, b ,,a",), (None,), ("XxA",)], "x string")
    assert rows(tokens.explode_tokens(df, "x", ","), "token") == [("a",), ("a",), ("b",), ("xxa",)]
    assert rows(tokens.explode_tokens(df, "x", "x"), "token") == [("a",), ("a, b ,,a",), ("x",)]
    assert rows(tokens.explode_tokens(df, "x", ",", lower=False), "token") == [("A",), ("XxA",), ("a",), ("b",)]


def test_distinct_counts_of_every_subset(spark):
    data = [(i % 3 if i % 7 else None, "ab"[i % 2], (i * i) % 97 if i % 5 else None) for i in range(900)]
    df = spark.createDataFrame(data, "p int, q string, v int").repartition(4)
    got = {(r["p"], r["q"]): (r["n"], r["n_distinct"]) for r in agg.cube_distinct(df, ["p", "q"], "v").collect()}
    want = {}
    for p, q in itertools.product((0, 1, 2, None, "ALL"), ("a", "b", "ALL")):
        hit = [v for a, b, v in data if p in ("ALL", a) and q in ("ALL", b)]
        want[p if p in (None, "ALL") else str(p), q] = (len(hit), len({v for v in hit if v is not None}))
    assert got == want
    assert agg.cube_distinct(df.filter("v IS NULL"), ["q"], "v").agg(F.max("n_distinct")).first()[0] == 0


def test_target_means_do_not_leak(spark):
    df = spark.range(2000).select("id", F.concat(F.lit("c"), F.col("id") % 5).alias("c"),
                                  (F.col("id") % 5).cast("double").alias("y"))
    df = df.unionByName(spark.createDataFrame([(5000, "alone", 1e6), (5001, None, 2.0)], df.schema))
    out = models.target_means(df, "id", "c", "y", weight=1.0)
    assert out.columns == ["id", "c", "y", "target_mean"] and out.count() == 2002
    overall = df.agg(F.avg("y")).first()[0]
    found = {r["id"]: r["target_mean"] for r in out.collect()}
    assert found[5000] == pytest.approx(overall) and found[5001] == pytest.approx(overall)
    assert all(abs(found[i] - i % 5) < abs(overall - i % 5) for i in range(20))


def test_count_vectors_keep_every_word(spark):
    """More words than any preset size of a vocabulary; repeated keys and empty rows stay rows."""
    from lodestone.operators.text import count_vectors
    n = (1 << 18) + 50
    df = spark.range(n).selectExpr("id % 64 AS k", "concat('w', id, ' w', id, ' all') AS t")
    df = df.groupBy("k").agg(F.concat_ws(" ", F.collect_list("t")).alias("t"))
    df = df.unionByName(spark.createDataFrame([(0, None), (0, "all")], "k long, t string"))
    got = count_vectors(df, "k", "t", min_df=1).collect()
    assert len(got) == 66
    assert {r["counts"].size for r in got} == {n + 1}
    assert sum(r["counts"].values.sum() for r in got) == 3 * n + 1
    assert sum(len(r["counts"].indices) for r in got) == n + 65
    common = [r["counts"][0] for r in got]
    assert sum(common) == n + 1
    assert {r["counts"].size for r in count_vectors(df, "k", "t", vocab=10).collect()} == {1}


def test_unescape_is_the_library_s(spark):
    """Names with and without semicolon, prefixes, numbers of all kinds, broken references."""
    import html
    import random
    from html.entities import html5
    from lodestone.functions.text import unescape
    pick = random.Random(7)
    bits = ["&", "#", "x", "X", ";", " ", "a", "é", "\U0001f600", "\n", "\x01", "amp", "notit", "&lt", "&#0;",
            "&#x80;", "&#55296;", "&#1114112;", "&#99999999999999999999;", "&#xfdd0;", "&#x1F600", "&#39", "41", ""]
    texts = ["".join(pick.choices(bits, k=pick.randint(0, 12))) for _ in range(3000)]
    texts += [f"a&{name}b&{name}" for name in html5] + [f"&#{n};" for n in (*range(300), 0xFFFE, 0x10FFFF, 0xD7FF)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([*texts, None])], "i int, t string")
    got = dict(df.select("i", unescape("t")).collect())
    assert [got[i] for i in range(len(texts))] == [html.unescape(x) for x in texts]
    assert got[len(texts)] is None
    assert "Python" not in df.select(unescape("t"))._jdf.queryExecution().executedPlan().toString()


def test_count_vectors_store_and_shuffle_less_than_their_texts(spark, tmp_path):
    """Tokens are neither stored nor shuffled: only packed counts and each chunk's different words are."""
    import os
    from lodestone.operators.text import count_vectors
    from lodestone.session import shared_dir
    df = spark.range(4000).selectExpr("if(id % 9 = 0, null, id % 50) AS k", "array_join(transform(sequence(1, 200), "
                                      "x -> concat('word', cast(pow(hash(id, x) % 60, 2) AS int))), ' ') AS t")
    path = str(tmp_path / "texts")
    df.coalesce(2).write.parquet(path)
    df = spark.read.parquet(path)

    def stored():
        return {os.path.join(d, f): os.path.getsize(os.path.join(d, f))
                for d, _, files in os.walk(shared_dir(spark).removeprefix("file:")) for f in files}

    before = stored()
    out = count_vectors(df, "k", "t")
    grown = sum(size for name, size in stored().items() if name not in before)
    text = df.selectExpr("sum(length(t))").first()[0]
    assert grown < text / 2
    assert out.columns == ["k", "counts"] and out.count() == 4000
    assert out.filter("k IS NULL").count() == df.filter("k IS NULL").count()
    assert sum(r["counts"].values.sum() for r in out.collect()) == 800_000
