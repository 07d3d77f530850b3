"""Text columns: tokens, n-grams, markup removal, normal forms."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Sequence
from html.entities import html5

import pandas as pd
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lodestone.functions.columns import ColumnLike, as_col, let
from lodestone.functions.wordlists import VIETNAMESE_STOP_WORDS

# Runs of two or more letters, digits or underscores, in any script.
WORD = r"[\p{L}\p{N}_]{2,}"
# A letter, then at least two letters or underscores, Latin script with Vietnamese marks.
LONG_WORD = r"[a-zA-ZÀ-ỹ][a-zA-ZÀ-ỹ_]{2,}"

# Pieces of markup. Each also matches up to the end of a page that was cut off inside it.
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
_UNSEEN = r"(?is)<(script|style|template)\b[^>]*>.*?(?:</\1\s*>|\z)"
# A tag, with > allowed inside quoted attribute values; the plain form takes what is left.
_TAG = (r"""<[/!?a-zA-Z][^<>"']*+(?:"[^"]*+"[^<>"']*+|'[^']*+'[^<>"']*+)*+>""")
_PLAIN_TAG = r"<[/!?a-zA-Z][^>]*(?:>|\z)"


# A character reference, as html.unescape finds them; names that need no semicolon may end anywhere.
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_NAMES = {f"&{name}": value for name, value in html5.items() if name.endswith(";")}
_OPEN_NAMES = {name: value for name, value in html5.items() if not name.endswith(";")}
_OPEN_NAME = "^&(" + "|".join(sorted(_OPEN_NAMES, key=len, reverse=True)) + ")"
# Numbers that do not stand for the character of that number: controls and noncharacters.
_SPECIAL_NUMBERS = {n: html.unescape(f"&#{n};") for n in (
    *range(0xA0), *range(0xFDD0, 0xFDF0), *(p << 16 | x for p in range(17) for x in (0xFFFE, 0xFFFF)))}


def english_stop_words() -> list[str]:
    """Spark's own English list."""
    return StopWordsRemover.loadDefaultStopWords("english")


def bilingual_stop_words() -> list[str]:
    return english_stop_words() + VIETNAMESE_STOP_WORDS


def words(c: ColumnLike, pattern: str = WORD, stop: Sequence[str] = ()) -> Column:
    """Lower-cased tokens of a text, stop words removed; null gives an empty array."""
    text = F.lower(F.coalesce(as_col(c), F.lit("")))
    out = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.filter(out, lambda x: ~x.isin(*stop)) if stop else out


def neighbours(tokens: Column, pair: Callable[[Column, Column], Column]) -> Column:
    """``pair`` of every token and the next one."""
    return F.zip_with(F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))),
                      F.slice(tokens, 2, F.size(tokens)), pair)


def one_line(c: ColumnLike) -> Column:
    """Collapse all white space to single spaces and trim."""
    return F.trim(F.regexp_replace(as_col(c), r"(?U)\s+", " "))


def strip_tags(c: ColumnLike, gap: str = " ") -> Column:
    """Drop comments, scripts, styles and tags; every removed piece leaves ``gap``.

    All of these begin with <: a text without one does not meet the patterns.
    """
    def stripped(text: Column) -> Column:
        out = F.regexp_replace(text, _COMMENT, gap)
        out = F.regexp_replace(out, _UNSEEN, gap)
        out = F.regexp_replace(out, _TAG, gap)
        return F.regexp_replace(out, _PLAIN_TAG, gap)

    return let(c, lambda x: F.when(x.contains("<"), stripped(x)).otherwise(x))


def unescape(c: ColumnLike) -> Column:
    """Resolve character references such as &amp; (all names of HTML 5), as ``html.unescape`` does.

    The text stays in the JVM: it is split at its references, and only these are looked up.
    """
    def resolved(text: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
        values = F.concat(F.transform(found, _referred), F.array(F.lit("")))
        return F.array_join(F.zip_with(F.split(text, _REFERENCE, -1), values,
                                       lambda piece, value: F.concat(piece, value)), "")

    return let(c, lambda x: F.when(x.contains("&"), resolved(x)).otherwise(x))


def _referred(ref: Column) -> Column:
    """What one character reference stands for; itself if it is none."""
    def character(n: Column) -> Column:
        plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        broken = n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
        return F.coalesce(F.try_element_at(_literal_map(_SPECIAL_NUMBERS), n.cast("string")),
                          F.when(broken, F.lit("\ufffd")).otherwise(plain))

    def number(digits: Column, longest: int, base: int) -> Column:
        value = F.coalesce(F.conv(digits, base, 10).try_cast("bigint"), F.lit(0).cast("bigint"))
        return let(F.when(F.length(digits) > longest, F.lit(0x110000).cast("bigint")).otherwise(value),
                   character)

    def prefixed(name: Column) -> Column:
        return F.when(name != "", F.concat(
            F.try_element_at(_literal_map(_OPEN_NAMES), name),
            F.substring(ref, F.length(name) + 2, F.length(ref)))).otherwise(ref)

    named = F.coalesce(F.try_element_at(_literal_map(_NAMES), ref),
                       let(F.regexp_extract(ref, _OPEN_NAME, 1), prefixed))
    numbered = (F.when(ref.rlike("^&#[xX]"), number(F.regexp_extract(ref, "^&#[xX]0*([0-9a-fA-F]*)", 1), 6, 16))
                .otherwise(number(F.regexp_extract(ref, "^&#0*([0-9]*)", 1), 7, 10)))
    out = F.when(ref.startswith("&#"), numbered)
    for common in ("&nbsp;", "&amp;", "&lt;", "&gt;", "&quot;"):
        out = out.when(ref == common, F.lit(html.unescape(common)))
    return out.otherwise(named)


def _literal_map(values: dict) -> Column:
    """The values by the text of their keys: one literal, not one for each entry."""
    pairs = "\x01".join(f"{key}\x02{value}" for key, value in values.items())
    return F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))


@F.pandas_udf(StringType())
def nfc(c: pd.Series) -> pd.Series:
    """Unicode composed form, so that equal letters compare equal."""
    return c.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")


def composed(c: ColumnLike) -> Column:
    """:func:`nfc` of the texts that hold a combining mark; the others do not leave the JVM's rows."""
    text = as_col(c)
    return F.coalesce(nfc(F.when(text.rlike("[\\u0300-\\u036f]"), text)), text)


def clues(pattern: str) -> list[str]:
    """Strings of which a match of the pattern must hold one; none if there is no such list.

    Read from the pattern's parse tree: runs of plain characters that stand in it by themselves, in a
    part that occurs at least once, or one for each of a part's alternatives.
    """
    def of(tree) -> list[str]:
        found: list[list[str]] = []
        run = ""
        for op, arg in [*tree, (None, None)]:
            if op is re._constants.LITERAL:
                run += chr(arg)
                continue
            if run:
                found.append([run])
            run, inner = "", []
            if op is re._constants.SUBPATTERN:
                inner = of(arg[-1])
            elif op is re._constants.MAX_REPEAT and arg[0] > 0:
                inner = of(arg[-1])
            elif op is re._constants.BRANCH:
                inner = [of(branch) for branch in arg[1]]
                inner = [x for part in inner for x in part] if all(inner) else []
            if inner:
                found.append(inner)
        return max(found, key=lambda x: min(map(len, x)), default=[])

    try:
        return of(re._parser.parse(pattern))
    except re.error:
        return []


def visible_text(c: ColumnLike) -> Column:
    """The visible text of an HTML page, one piece per line."""
    return unescape(strip_tags(c, "\n"))


def text_lines(c: ColumnLike) -> Column:
    """The non-empty lines of a text, each on one line."""
    pieces = F.split(as_col(c), r"[\r\n]+")
    return F.filter(F.transform(pieces, one_line), lambda x: x != "")


def page_text(c: ColumnLike) -> Column:
    """The visible text of an HTML page on one line."""
    return one_line(visible_text(c))


def page_lines(c: ColumnLike) -> Column:
    """The visible text pieces of an HTML page as an array."""
    return text_lines(visible_text(c))


def clean_markup(c: ColumnLike) -> Column:
    """A text field that may hold escaped or plain markup, as one clean line; null gives ''."""
    return one_line(strip_tags(unescape(F.coalesce(as_col(c).cast("string"), F.lit("")))))
