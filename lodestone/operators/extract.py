"""Records from stored web pages, as column expressions over a table of (url, html) rows.

Structured postings are read from JSON-LD scripts as VARIANT values; every field falls back to
the visible page. All of it is done by column functions; no page goes to Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.columns import ColumnLike, as_col, first_match, let
from lodestone.functions.salary import bare_number, normal_salary, salary_in_lines
from lodestone.functions.text import (clean_markup, one_line, page_lines, page_text, strip_tags,
                                      unescape)
from lodestone.functions.wordlists import (ADDRESS_WORDS, CITY_CODES, CITY_NAMES, COMPANY_CLASSES,
                                           COMPANY_LINK, COMPANY_NOISE, DEAD_PAGE_TEXT,
                                           DESCRIPTION_ENDS, DESCRIPTION_NOISE,
                                           DESCRIPTION_STARTS, DESCRIPTION_STOPS, EXPERIENCE_RANGE,
                                           EXPERIENCE_YEARS, KNOWN_SKILLS,
                                           LEVEL_RULES, LINK_ATTRIBUTES, SALARY_BOX_CLASSES,
                                           SALARY_NODE_ATTRIBUTE, SALARY_NODE_FIELD,
                                           SALARY_NODE_ID, SKILL_NOISE, TAG_NOISE)
from lodestone.operators.tokens import dictionary_terms

_LD_JSON = (r"""(?is)<script\b[^>]*type\s*=\s*["']?application/ld\+json["']?[^>]*>"""
            r"""(.*?)</script\s*>""")
_SEP = "\u0001"


def non_empty(c: Column) -> Column:
    return let(c, lambda x: F.when(x != "", x))


def field(v: Column, path: str) -> Column:
    """Text at a path of a variant, null when absent or empty."""
    return non_empty(F.try_variant_get(v, path, "string"))


def elements(v: Column) -> Column:
    """A variant as an array: its items if it is a list, else itself."""
    return let(v, lambda x: F.coalesce(F.try_variant_get(x, "$", "array<variant>"),
                                       F.when(x.isNotNull(), F.array(x))))


def tag_body(html: ColumnLike, tag: str) -> Column:
    """Inner markup of the first such element, '' if there is none."""
    return F.regexp_extract(as_col(html), rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)


def class_body(html: ColumnLike, *parts: str) -> Column:
    """Inner markup of the first element whose class holds all ``parts``, '' if there is none."""
    ahead = "".join(rf"(?=[^>]*\bclass\s*=\s*[\"'][^\"']*(?-i:{p}))" for p in parts)
    body = F.regexp_extract(as_col(html), rf"(?is)<(\w+)\b{ahead}[^>]*>(.*?)</\1\s*>", 2)
    return _if_has(html, parts, body, F.lit(""))


def _if_has(html: ColumnLike, words: Sequence[str], found: Column, missing: Column) -> Column:
    """``found`` only where the page holds all ``words``: a substring test is far cheaper than
    a pattern that would fail."""
    test = reduce(lambda a, b: a & b, (as_col(html).contains(w) for w in words))
    return F.when(test, found).otherwise(missing)


# Postings ---------------------------------------------------------------------------------


def posting(html: ColumnLike) -> Column:
    """The first JobPosting of the page's JSON-LD scripts as a variant, or null.

    A script may hold one object, a list, or an ``@graph`` list; ``@type`` may be a list.
    Scripts that do not parse are skipped.
    """
    scripts = F.regexp_extract_all(as_col(html), F.lit(_LD_JSON), F.lit(1))

    def items(v: Column) -> Column:
        graph = F.try_variant_get(v, '$["@graph"]', "array<variant>")
        return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), graph, F.array(v))

    def is_posting(v: Column) -> Column:
        kind = F.try_variant_get(v, '$["@type"]', "string")
        kinds = F.try_variant_get(v, '$["@type"]', "array<string>")
        return ((kind == "JobPosting")
                | F.coalesce(F.array_contains(kinds, "JobPosting"), F.lit(False)))

    parsed = F.transform(scripts, lambda x: F.try_parse_json(F.trim(x)))
    found = F.filter(F.flatten(F.transform(parsed, items)), is_posting)
    return F.get(found, F.lit(0))


def title(html: ColumnLike, post: Column) -> Column:
    """Posting title, else first heading, else page title."""
    return F.coalesce(non_empty(clean_markup(field(post, "$.title"))),
                      non_empty(page_text(tag_body(html, "h1"))),
                      non_empty(page_text(tag_body(html, "title"))), F.lit(""))


def company(html: ColumnLike, post: Column, noise: Sequence[str] = ()) -> Column:
    """Hiring organisation, else the first plausible employer link, else an element whose class
    names the employer, else the first h2. ``noise`` adds phrases no employer name contains."""
    links = F.regexp_extract_all(as_col(html), F.lit(
        rf"""(?is)<a\b[^>]*\bhref\s*=\s*["'][^"']*(?-i:{COMPANY_LINK})[^"']*["'][^>]*>(.*?)"""
        r"</a\s*>"), F.lit(1))
    links = _if_has(html, [COMPANY_LINK], links, F.array().cast("array<string>"))
    texts = F.split(unescape(F.array_join(F.transform(links, lambda x: strip_tags(x)), _SEP)), _SEP)
    banned = [*COMPANY_NOISE, *noise]

    def clean(low: Column) -> Column:
        out = F.lit(True)
        for phrase in banned:
            out = out & ~low.contains(phrase)
        return out

    def plausible(x: Column) -> Column:
        size = F.length(x)
        return (size > 3) & (size < 120) & let(F.lower(x), clean)

    link = F.get(F.filter(F.transform(texts, one_line), plausible), F.lit(0))
    by_class = [non_empty(page_text(class_body(html, c))) for c in COMPANY_CLASSES]
    return F.coalesce(non_empty(clean_markup(field(post, "$.hiringOrganization.name"))), link,
                      *by_class, non_empty(page_text(tag_body(html, "h2"))), F.lit(""))


def structured_salary(base: Column) -> Column:
    """ "min-max CUR" from a baseSalary value: nested or flat, range, single amount or text."""
    return let(base, _structured_salary)


def _structured_salary(base: Column) -> Column:
    names = ["currency", "currencyCode", "unitText", "unitCode"]
    currency = F.coalesce(*[field(base, f"$.{n}") for n in names],
                          *[field(base, f"$.value.{n}") for n in names])

    def scalar(path: str) -> Column:
        return let(F.try_variant_get(base, path, "string"), lambda text: F.when(
            ~text.startswith("{") & ~text.startswith("["), non_empty(bare_number(text))))

    def amount(low: Column, high: Column) -> Column:
        both = low.isNotNull() & high.isNotNull() & (low != high)
        text = F.when(both, F.concat(low, F.lit("-"), high)).otherwise(F.coalesce(low, high))
        return F.when(text.isNotNull(), F.concat_ws(" ", text, currency))

    def span(low: str, high: str) -> Column:
        ends = F.struct(scalar(low).alias("low"), scalar(high).alias("high"))
        return let(ends, lambda x: amount(x["low"], x["high"]))

    def single(*paths: str) -> Column:
        return let(F.coalesce(*[scalar(p) for p in paths]), lambda x: amount(x, x))

    found = F.coalesce(
        span("$.value.minValue", "$.value.maxValue"),
        single(*[f"$.value.{n}" for n in ("value", "amount", "price")]),
        span("$.minValue", "$.maxValue"),
        single("$.value"),
        scalar("$"))
    return _known(found)


def _known(c: Column) -> Column:
    """Normal form of an amount, null when there is none."""
    return let(normal_salary(c), lambda x: F.when(x != "Unknown", x))


def salary(html: ColumnLike, post: Column, lines: Column) -> Column:
    """Amount from, in this order, the page's data attribute, its highlighted box, the
    structured posting, the visible ``lines``; "Unknown" without any."""
    h = as_col(html)
    node = F.regexp_extract(
        h, rf"""(?is)<[^>]*\bid\s*=\s*["'](?-i:{SALARY_NODE_ID})["'][^>]*>""", 0)

    def layer_of(node: Column) -> Column:
        quoted = F.regexp_extract(node, rf"""(?is){SALARY_NODE_ATTRIBUTE}\s*=\s*"([^"]*)\"""", 1)
        single = F.regexp_extract(node, rf"(?is){SALARY_NODE_ATTRIBUTE}\s*=\s*'([^']*)'", 1)
        data = F.try_parse_json(unescape(F.coalesce(non_empty(quoted), single)))
        return field(data, f"$.{SALARY_NODE_FIELD}")

    # Parsing an empty text fails, and a failure costs far more than the test for the node.
    layer = _if_has(h, [SALARY_NODE_ID], let(node, layer_of), F.lit(None).cast("string"))
    box = non_empty(page_text(class_body(h, *SALARY_BOX_CLASSES)))

    base = F.try_variant_get(post, "$.baseSalary", "variant")
    return F.coalesce(_known(layer), _known(box), structured_salary(base),
                      salary_in_lines(lines), F.lit("Unknown"))


def location(post: Column, low_text: Column) -> Column:
    """Comma-joined city codes or short place names of the posting; street addresses are left
    out. Without any, city names and remote / hybrid in the lower-cased page text decide."""
    places = elements(F.try_variant_get(post, "$.jobLocation", "variant"))
    fields = ("addressRegion", "addressLocality", "streetAddress")
    raw = F.flatten(F.transform(places, lambda p: F.array(
        *[F.coalesce(F.try_variant_get(p, f"$.address.{f}", "string"), F.lit(""))
          for f in fields])))
    texts = F.split(unescape(F.array_join(raw, _SEP)), _SEP)

    def street(low: Column) -> Column:
        return (low.contains("not available") | low.rlike(r"\d")
                | low.rlike(rf"(?U)\b({ADDRESS_WORDS})\b"))

    def usable(x: Column) -> Column:
        return (x != "") & ~let(F.lower(x), street)

    rules = [([name], code) for name, code in CITY_CODES.items()]

    def code(x: Column) -> Column:
        short = F.when(F.length(x) <= 30, x)
        return F.coalesce(first_match(x, rules, None, lower=True), short)

    named = F.array_compact(F.transform(F.filter(F.transform(texts, one_line), usable), code))
    marks = [("remote", "Remote"), ("hybrid", "Hybrid"), *CITY_CODES.items()]
    seen = F.array_compact(F.array(
        *[F.when(low_text.contains(n), F.lit(c)) for n, c in marks]))
    chosen = let(named, lambda x: F.when(F.size(x) > 0, x).otherwise(seen))
    return F.array_join(F.array_distinct(chosen), ",")


def posting_place(post: Column) -> Column:
    """Locality and region of the posting's first place, as it writes them; else the place's name;
    "Unknown" without either. "Remote" counts as a place only if there is no other."""
    place = F.get(elements(F.try_variant_get(post, "$.jobLocation", "variant")), F.lit(0))
    locality, region = [non_empty(F.trim(F.try_variant_get(place, f"$.address.{f}", "string")))
                        for f in ("addressLocality", "addressRegion")]

    def there(x: Column) -> Column:
        return F.when(F.lower(x) != "remote", x)

    both = non_empty(F.concat_ws(", ", there(locality), there(region)))
    return F.coalesce(both, region, locality, non_empty(clean_markup(field(place, "$.name"))),
                      F.lit("Unknown"))


def first_city(lines: Column) -> Column:
    """Code of the first city that the page's text names, '' without any."""
    codes = F.filter(F.transform(lines, lambda x: first_match(x, CITY_NAMES, None)),
                     lambda x: x.isNotNull())
    return F.coalesce(F.get(codes, F.lit(0)), F.lit(""))


def skills(post: Column, text: Column, limit: int | None = None, merge: bool = False) -> Column:
    """Array of skills: the posting's own list, else dictionary terms found in ``text``.

    ``merge`` adds the dictionary terms to the posting's list. Punctuation other than + and # is
    dropped, as are one-letter and site words.
    """
    value = F.coalesce(F.try_variant_get(post, "$.skills", "variant"),
                       F.try_variant_get(post, "$.skillsRequired", "variant"))
    listed = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda v: F.coalesce(
        field(v, "$.name"), field(v, '$["@id"]'), field(v, "$.value"),
        F.try_variant_get(v, "$", "string"), F.lit("")))
    joined = F.coalesce(F.array_join(listed, _SEP),
                        F.regexp_replace(F.try_variant_get(value, "$", "string"), r"[,;/\n]", _SEP),
                        F.lit(""))
    own = F.split(strip_tags(unescape(joined)), _SEP)

    def clean(x: Column) -> Column:
        return one_line(F.regexp_replace(x, r"(?U)[^\w+#\s]", ""))

    def wanted(x: Column) -> Column:
        return (F.length(x) > 1) & ~F.lower(x).isin(*SKILL_NOISE)

    own = F.filter(F.transform(own, clean), wanted)
    found = dictionary_terms(text, KNOWN_SKILLS, capitalise=not merge)

    def choose(own: Column) -> Column:
        if merge:
            known = F.transform(own, lambda x: F.lower(x))
            return F.concat(own, F.filter(found, lambda x: ~F.array_contains(known, x)))
        return F.when(F.size(own) > 0, own).otherwise(F.filter(found, wanted))

    out = let(own, choose)
    return out if limit is None else F.slice(out, 1, limit)


def tag_skills(html: ColumnLike) -> Column:
    """Short digit-free texts of links and badges, in page order, known site words left out."""
    bodies = F.regexp_extract_all(as_col(html), F.lit(r"(?is)<(a|span)\b[^>]*>(.*?)</\1\s*>"),
                                  F.lit(2))
    plain = F.transform(bodies, lambda x: strip_tags(x))
    texts = F.split(unescape(F.array_join(plain, _SEP)), _SEP)

    def wanted(x: Column) -> Column:
        keep = (F.length(x) > 2) & (F.length(x) < 25) & ~x.rlike(r"\d")
        for phrase in TAG_NOISE:
            keep = keep & ~F.lower(x).contains(phrase)
        return keep

    return F.array_distinct(F.filter(F.transform(texts, one_line), wanted))


def description(raw: Column, max_chars: int | None = None) -> Column:
    """The working part of a description: cut at the earliest stop marker, started at the first
    known section, cut again at a known ending; noise, address and very short lines dropped.

    The text is processed whole; ``max_chars`` shortens the result on request.
    """
    def spot(text: Column, marks: Sequence[str], pick) -> Column:
        """Where the earliest (``least``) or first listed (``coalesce``) mark found begins."""
        return let(F.lower(text), lambda low: pick(
            *[F.nullif(F.instr(low, m.lower()), F.lit(0)) for m in marks]))

    def before(text: Column, spot: Column) -> Column:
        return let(spot, lambda at: F.when(at.isNull(), text)
                   .otherwise(F.substring(text, F.lit(1), at - 1)))

    text = F.regexp_replace(strip_tags(unescape(F.coalesce(raw, F.lit(""))), "\n"),
                            r"\r\n|\r", "\n")
    text = let(text, lambda x: before(x, spot(x, DESCRIPTION_STOPS, F.least)))
    text = let(text, lambda x: F.substring(
        x, F.coalesce(spot(x, DESCRIPTION_STARTS, F.coalesce), F.lit(1)), F.length(x)))
    text = let(text, lambda x: before(x, spot(x, DESCRIPTION_ENDS, F.coalesce)))

    def working(low: Column) -> Column:
        keep = ~low.rlike(rf"(?U)\b({ADDRESS_WORDS})\b")
        for phrase in DESCRIPTION_NOISE:
            keep = ~low.contains(phrase) & keep
        return keep

    def wanted(line: Column) -> Column:
        return (F.length(line) >= 10) & let(F.lower(line), working)

    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), wanted)
    out = F.array_join(lines, "\n")
    return out if max_chars is None else F.substring(out, 1, max_chars)


def lead_paragraphs(html: ColumnLike, min_chars: int = 50, count: int | None = None) -> Column:
    """The paragraphs longer than ``min_chars``, the first ``count`` of them on request."""
    bodies = F.regexp_extract_all(as_col(html), F.lit(r"(?is)<p\b[^>]*>(.*?)</p\s*>"), F.lit(1))
    plain = F.transform(bodies, lambda x: strip_tags(x))
    texts = F.split(unescape(F.array_join(plain, _SEP)), _SEP)
    long = F.filter(F.transform(texts, one_line), lambda x: F.length(x) > min_chars)
    return F.array_join(long if count is None else F.slice(long, 1, count), " ")


def experience(post: Column, low_text: Column) -> Column:
    """Experience asked for: the posting's text, else a range of years, else a number of years
    in the lower-cased page text, else "Unknown"."""
    stated = non_empty(clean_markup(field(post, "$.experienceRequirements")))
    span = F.regexp_extract(low_text, EXPERIENCE_RANGE, 0)
    one = F.regexp_extract(low_text, EXPERIENCE_YEARS, 0)
    return F.coalesce(stated, non_empty(one_line(span)), non_empty(one_line(one)),
                      F.lit("Unknown"))


def level(title_text: Column, low_text: Column) -> Column:
    """Seniority by keyword in the title, else in the lower-cased page text, else "Unknown"."""
    return F.coalesce(first_match(title_text, LEVEL_RULES, None, lower=True),
                      first_match(low_text, LEVEL_RULES, "Unknown"))


def is_dead(html: ColumnLike, post: Column, low_text: Column) -> Column:
    """The page says the posting is gone, and there is neither a posting nor a heading."""
    gone = low_text.contains(DEAD_PAGE_TEXT)
    return gone & post.isNull() & (page_text(tag_body(html, "h1")) == "")


def posting_records(pages: DataFrame, url: str = "url", html: str = "html",
                    merge_skills: bool = False, crawl_time: Column | None = None) -> DataFrame:
    """One record per page that is not dead. The shared parts (posting, visible lines, their
    lower-cased text) are computed first and once, then the fields built on them.

    A page without a structured description is described by its long paragraphs. ``crawl_time``
    adds the time of the visit, from a column of ``pages`` or as a literal.
    """
    post, low = F.col("_post"), F.col("_low")
    visit = [] if crawl_time is None else [crawl_time.alias("crawl_time")]
    shared = pinned(pages.select(url, html, *visit), _post=posting(html), _lines=page_lines(html))
    shared = shared.withColumn("_low", F.lower(F.array_join("_lines", " ")))
    live = pinned(shared, _dead=is_dead(html, post, low)).filter(~F.col("_dead"))
    rows = pinned(live, title=title(html, post), company=company(html, post),
                  salary=salary(html, post, F.col("_lines")), location=location(post, low),
                  description=F.coalesce(non_empty(description(field(post, "$.description"))),
                                         lead_paragraphs(html)))
    return rows.select(
        F.col(url).alias("url"), "title", "company", "salary", "location",
        flat_text("description").alias("description"),
        F.array_join(skills(post, F.concat_ws(" ", "title", "description"),
                            merge=merge_skills), ", ").alias("skills"),
        experience(post, low).alias("experience"),
        level(F.col("title"), low).alias("job_level"), *(["crawl_time"] if visit else []))


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    The optimizer copies an expression that holds a Python function into each of its uses. A
    generator over a one-element array stands between: its output is a plain column.
    """
    one = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select("*", F.explode(one).alias("_pin")).select("*", "_pin.*").drop("_pin")


def flat_text(c: ColumnLike) -> Column:
    """Line breaks as " | ", all other white space single."""
    return one_line(F.replace(F.coalesce(as_col(c), F.lit("")), F.lit("\n"), F.lit(" | ")))


# Links ------------------------------------------------------------------------------------


def absolute_url(base: ColumnLike, href: ColumnLike) -> Column:
    """``href`` resolved against the page address, fragment dropped; null for other schemes."""
    h = F.regexp_replace(F.trim(as_col(href)), "#.*$", "")
    b = F.regexp_replace(as_col(base), "#.*$", "")
    site = F.regexp_extract(b, r"^(https?://[^/?]*)", 1)
    no_query = F.regexp_replace(b, r"\?.*$", "")
    folder = F.when(no_query.rlike(r"^https?://[^/]*$"), F.concat(no_query, F.lit("/"))
                    ).otherwise(F.regexp_replace(no_query, "[^/]*$", ""))
    return (F.when(h.rlike(r"(?i)^https?://"), h)
            .when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), F.lit(None).cast("string"))
            .when(h == "", b)
            .when(h.startswith("//"), F.concat(F.regexp_extract(b, "^(https?:)", 1), h))
            .when(h.startswith("/"), F.concat(site, h))
            .when(h.startswith("?"), F.concat(no_query, h))
            .otherwise(F.concat(folder, h)))


def page_links(pages: DataFrame, url: str = "url", html: str = "html",
               path_part: str | None = None, skip_slugs: Sequence[str] = (),
               attributes: Sequence[str] = ("href",)) -> DataFrame:
    """Distinct (page address, absolute link) rows, optionally only links whose path holds
    ``path_part`` and whose last part does not start with one of ``skip_slugs``."""
    names = "|".join(attributes)
    tag = "a" if list(attributes) == ["href"] else r"\w+"
    hrefs = F.regexp_extract_all(F.col(html), F.lit(
        rf"""(?is)<{tag}\b[^>]*?\s(?:{names})\s*=\s*["']([^"']*)["']"""), F.lit(1))
    rows = (pages
            .select(F.col(url).alias("page_url"), F.explode(F.array_distinct(hrefs)).alias("_h"))
            .select("page_url", absolute_url("page_url", unescape("_h")).alias("link"))
            .filter(F.col("link").isNotNull()))
    path = F.regexp_extract("link", r"^https?://[^/?]*([^?]*)", 1)
    if path_part is not None:
        rows = rows.filter(F.lower(path).contains(path_part))
    slug = F.regexp_extract(F.regexp_replace(path, "/+$", ""), "([^/]*)$", 1)
    for prefix in skip_slugs:
        rows = rows.filter(~slug.startswith(prefix))
    return rows.distinct()


def listing_links(pages: DataFrame, path_part: str, **kwargs) -> DataFrame:
    """Posting links of listing pages, from anchors and from link-bearing attributes."""
    return page_links(pages, path_part=path_part, skip_slugs=("tag-", "skill-"),
                      attributes=LINK_ATTRIBUTES, **kwargs).select("link").distinct()


def is_posting_url(url: ColumnLike, site: str, path_part: str) -> Column:
    """An address of this site, below ``path_part``, that ends in a number."""
    u = as_col(url)
    return u.startswith(site) & u.contains(path_part) & u.rlike(r"-\d+(?:\?|$)")


def response_urls(df: DataFrame, body: str, items: str = "data", field_name: str = "jobUrl",
                  name: str = "url") -> DataFrame:
    """One row per item of a JSON listing response that has an address."""
    shape = f"struct<`{items}`: array<struct<`{field_name}`: string>>>"
    parsed = F.from_json(F.col(body), shape)
    return (df.select(F.explode(parsed[items]).alias("_i"))
            .select(F.col("_i")[field_name].alias(name)).filter(F.col(name).isNotNull()))
