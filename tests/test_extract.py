import json

import pytest
from pyspark.sql import functions as F

from lodestone.functions import salary as pay
from lodestone.functions.text import clean_markup, page_lines, page_text
from lodestone.operators import extract
from tests.helpers import rows


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_salary_spelling(spark):
    cases = {"$1,000 - $2,000": "1000-2000 USD", "USD 1000-2000": "1000-2000 USD",
             "Thỏa thuận": "Negotiable", "You'll love it": "You'll love it", "": "Unknown",
             "10 - 20 Triệu": "10-20 Triệu", "1.500 to 2.500 usd": "1500-2500 USD",
             "Sign in to view salary": "Hidden", "Very competitive!": "Competitive",
             "1000–2000 $": "1000-2000 USD", "  ": "Unknown"}
    assert column(spark, cases, pay.normal_salary) == list(cases.values())


def test_salary_in_lines(spark):
    cases = [(["call 0912345678", "1000 USD"], "1000 USD"), (["$900 – $1,200 net"], "900-1200 USD"),
             (["no pay here", "it's attractive", "500 usd"], "Attractive"),
             (["from $2,000"], "2000 USD"), (["10 - 15 triệu / month"], "10-15 triệu"),
             (["usd only"], None), ([], None)]
    got = column(spark, [c[0] for c in cases], pay.salary_in_lines, "array<string>")
    assert got == [c[1] for c in cases]


def test_amounts(spark):
    df = spark.createDataFrame([("1000-2000 USD",), ("20 triệu",), ("Negotiable",)], "s string")
    got = [tuple(r[0]) for r in df.select(pay.salary_amounts("s")).collect()]
    assert got == [(25.4e6, 50.8e6, 38.1e6, "range_mid"), (20e6, 20e6, 20e6, "single"),
                   (None, None, None, "missing")]


def ld(*scripts):
    tags = "".join(f'<script type="application/ld+json">{s}</script>' for s in scripts)
    return f"<html><head>{tags}</head><body><h1>Head</h1></body></html>"


def test_first_posting(spark):
    post = {"@type": "JobPosting", "title": "T"}
    pages = [ld(json.dumps([{"@type": "Thing"}, post])), ld(json.dumps({"@graph": [post]})),
             ld(json.dumps({**post, "@type": ["Thing", "JobPosting"]})),
             ld("{broken", json.dumps(post)), ld(json.dumps({"@type": "Thing"})), "<p>x</p>", None]
    got = column(spark, pages, lambda c: extract.field(extract.posting(c), "$.title"))
    assert got == ["T", "T", "T", "T", None, None, None]


@pytest.mark.parametrize("base, text", [
    ({"currency": "USD", "value": {"minValue": 1000, "maxValue": 2000}}, "1000-2000 USD"),
    ({"currency": "USD", "value": {"minValue": 1000, "maxValue": 1000}}, "1000 USD"),
    ({"value": {"value": "1,500", "unitText": "USD"}}, "1500 USD"),
    ({"currency": "VND", "value": 20000000}, "20000000 VND"),
    ({"minValue": "10", "maxValue": "20", "currency": "triệu"}, "10-20 triệu"),
    ("USD 700", "700 USD"), (1500.0, "1500"), ("Negotiable", "Negotiable"), ({}, None), (None, None)])
def test_structured_salary(spark, base, text):
    got = column(spark, [json.dumps({"b": base})], lambda c: extract.structured_salary(
        F.try_variant_get(F.parse_json(c), "$.b", "variant")))
    assert got == [text]


def test_salary_sources_in_order(spark):
    layer = """<div id="jd-main" data-jobs-save-data-layer-value='{"salary_range":"1 - 2 USD"}'>"""
    box = '<span class="salary x text-success-color">3 - 4 USD</span>'
    data = ld(json.dumps({"@type": "JobPosting", "baseSalary": "5 USD"}))
    line = "<p>Pay 6 USD</p>"
    pages = [layer + box + data + line, box + data + line, data + line, line, "<p>none</p>"]
    got = column(spark, pages, lambda c: extract.salary(c, extract.posting(c), page_lines(c)))
    assert got == ["1-2 USD", "3-4 USD", "5 USD", "6 USD", "Unknown"]


def place(spark, value, text=""):
    return column(spark, [json.dumps({"jobLocation": value})], lambda c: extract.location(
        F.parse_json(c), F.lit(text)))[0]


def test_location(spark):
    def at(**address):
        return {"address": address}
    assert place(spark, at(addressRegion="Hồ Chí Minh", streetAddress="Tầng 4, Tòa nhà X")) == "HCM"
    assert place(spark, [at(addressLocality="ha noi"), at(addressRegion="Cần Thơ")]) == "HN,Cần Thơ"
    assert place(spark, at(streetAddress="Tầng 4, Tòa nhà X"), "remote in đà nẵng") == "Remote,DN"
    assert place(spark, None, "nothing") == ""


def test_skills(spark):
    def of(post, text="", **kw):
        return column(spark, [json.dumps(post)], lambda c: extract.skills(
            F.parse_json(c), F.lit(text), **kw), "string")[0]
    assert of({"skills": "Java, C++; x, Apply/SQL!"}) == ["Java", "C++", "SQL"]
    assert of({"skills": ["R&amp;D", {"name": "Go lang"}]}) == ["RD", "Go lang"]
    assert of({}, "c++ and C# dev, javascript") == ["C#", "C++", "Javascript"]
    assert of({"skills": ["Java"]}, "java, python", merge=True) == ["Java", "python"]
    assert len(of({"skills": [f"skill{i}" for i in range(20)]})) == 20


def test_description(spark):
    raw = ("&lt;p&gt;We are the best firm&lt;/p&gt;<h2>Requirements</h2><p>You know Spark well.</p>"
           "<p>Send us an email today</p><p>short</p><p>12 Main street, some town</p>"
           "<p>Good pay and team.</p><p>FanPage of the firm</p><p>After the end of it all</p>")
    assert column(spark, [raw, None], extract.description) == [
        "Requirements\nYou know Spark well.\nGood pay and team.", ""]
    long = "<p>" + "word " * 20_000 + "</p>"
    whole, cut = column(spark, [long], extract.description)[0], column(
        spark, [long], lambda c: extract.description(c, 16_000))[0]
    assert len(whole) == 20_000 * 5 - 1 and len(cut) == 16_000


def test_experience_and_level(spark):
    none = F.lit(None).cast("variant")
    text = ["3 - 5 years, then 2 years", "at least 2 years", "no mention"]
    assert column(spark, text, lambda c: extract.experience(none, c)) == [
        "3 - 5 year", "at least 2 year", "Unknown"]
    titles = ["Lead Architect", "Fresher QA", "Clerk"]
    assert column(spark, titles, lambda c: extract.level(c, F.lit("a junior role"))) == [
        "Senior", "Fresher", "Junior"]


def test_dead_pages(spark):
    oops = "<p>Oops! The job you&#39;re looking for doesn&#39;t exist</p>"
    pages = [oops, "<h1>T</h1>" + oops, oops + ld('{"@type":"JobPosting"}'), "<p>fine</p>"]
    got = column(spark, pages, lambda c: extract.is_dead(
        c, extract.posting(c), F.lower(page_text(c))))
    assert got == [True, False, False, False]


def test_company_fallbacks(spark):
    link = '<a href="/nha-tuyen-dung/x">{}</a>'
    pages = [link.format("Xem thêm") + link.format("Real Firm"),
             '<div class="a company-name b">By <b>Class</b></div>', "<h2>By heading</h2>", "<p/>"]
    none = F.lit(None).cast("variant")
    assert column(spark, pages, lambda c: extract.company(c, none)) == [
        "Real Firm", "By Class", "By heading", ""]


def test_markup(spark):
    pages = ['<p title="a > b">x &amp; y</p><script>var t="</p>";</script><!-- <p>no</p> -->z',
             "cut <a href='x", "a<br>b  c\n\nd", None]
    assert column(spark, pages, page_text) == ["x & y z", "cut", "a b c d", None]
    assert column(spark, ["&lt;b&gt;x&lt;/b&gt; &amp;amp;", None], clean_markup) == ["x &amp;", ""]
    quotes = "<p " + 'a="b" ' * 5_000 + ">end"
    assert column(spark, [quotes], page_text) == ["end"]


@pytest.mark.parametrize("base, href, link", [
    ("https://a.b/c/d?x=1#f", "/e", "https://a.b/e"), ("https://a.b/c/d", "e?y#z", "https://a.b/c/e?y"),
    ("https://a.b", "e", "https://a.b/e"), ("https://a.b/c", "//x.y/z", "https://x.y/z"),
    ("https://a.b/c?x", "?p=2", "https://a.b/c?p=2"), ("https://a.b/c", "mailto:q@r", None),
    ("https://a.b/c", "HTTP://x.y", "HTTP://x.y"), ("https://a.b/c?x", "#top", "https://a.b/c?x")])
def test_absolute_url(spark, base, href, link):
    df = spark.createDataFrame([(base, href)], "b string, h string")
    assert df.select(extract.absolute_url("b", "h")).first()[0] == link


def test_posting_url(spark):
    urls = ["https://s.x/it-jobs/dev-123", "https://s.x/it-jobs/dev-123?a=b", "https://s.x/it-jobs/dev",
            "https://o.x/it-jobs/dev-1", "https://s.x/about-1"]
    assert column(spark, urls, lambda c: extract.is_posting_url(c, "https://s.x", "/it-jobs/")) == [
        True, True, False, False, False]


def test_shared_parts_are_computed_once(spark):
    df = spark.createDataFrame([("u", "<h1>x</h1>")], "url string, html string")
    plan = extract.posting_records(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") < 20
    assert rows(extract.posting_records(df), "url", "title") == [("u", "x")]


def test_all_skills_are_kept(spark):
    names = [f"skill{chr(97 + i)}" for i in range(14)]
    page = ('<script type="application/ld+json">{"@type":"JobPosting","title":"t","skills":"'
            + ", ".join(names) + '"}</script>')
    got = extract.posting_records(spark.createDataFrame([("u", page)], "url string, html string"),
                                  crawl_time=F.lit("2024-01-01")).first()
    assert got["skills"].split(", ") == names and got["crawl_time"] == "2024-01-01"


def test_advert_pages_are_made_by_many_tasks(spark, tmp_path, data):
    """A file of one row group is dealt before its pages are made, and stays dealt in salary_amounts."""
    from lodestone.plans import queries_pages as pages
    from lodestone.plans.registry import QUERIES, Tables
    spark.read.parquet(f"{data}/part.parquet").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    t = Tables(spark, str(tmp_path))
    sizes = [r["count"] for r in pages.advert_pages(t).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < sum(sizes) / 2
    plan = QUERIES["salary_amounts"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression"):]
    assert "regexp" not in below and "Filter" not in below


def test_fields_of_a_posting_are_read_once(spark):
    """No field is read again to test whether it is there, and no text parsed for each of its uses."""
    df = spark.createDataFrame([("u", "<h1>x</h1>")], "url string, html string")
    plan = extract.posting_records(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 2 and plan.count("variant_get") < 100


def test_odd_pages(spark):
    """Pages without text, with amounts of odd kinds and with nodes that hold nothing."""
    node = f'<div id="{extract.SALARY_NODE_ID}"'
    bases = [None, "", "{x", "Thỏa thuận", [1, 2], {}, {"value": "7.00"}, {"value": {"maxValue": "9 000"}},
             {"value": {"minValue": 5}, "currency": ""}, {"value": {"price": 3, "unitText": "MONTH"}},
             {"minValue": 1, "maxValue": 2, "value": {"currency": "EUR"}}]
    pages = [ld(json.dumps({"@type": "JobPosting", "baseSalary": b})) for b in bases]
    pages += [node + "></div>", f"{node} {extract.SALARY_NODE_ATTRIBUTE}='{{'>", ld("", "{broken"), "", None,
              "a < b", "<p>$</p>$1000"]
    df = spark.createDataFrame([(str(n), p) for n, p in enumerate(pages)], "url string, html string")
    got = {int(u): s for u, s in rows(extract.posting_records(df), "url", "salary")}
    want = ["Unknown", "Unknown", "Unknown", "Negotiable", "Unknown", "Unknown", "7", "9000", "5", "3 MONTH",
            "1-2 EUR", "Unknown", "Unknown", "Unknown", "Unknown", None, "Unknown", "1000 USD"]
    assert got == {n: w for n, w in enumerate(want) if w is not None}
