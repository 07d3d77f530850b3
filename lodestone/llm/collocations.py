"""Phrase collocations by top-order marginalisation.

Each word starts one window of ``max_words`` lead columns (the word and the ones after it in its
piece, nulls where the piece ends). Only these longest windows are counted. The counts of all shorter
phrases are sums of them: an occurrence of a phrase is the beginning of exactly one window, so a
ROLLUP over the lead columns adds the windows up to each prefix, and no n-gram is exploded twice.

Windows are counted within batches of bounded size in the tasks, travel as one string each, in
sorted order, and are dealt by ranges of that order, so a phrase in a third of all texts is a few
rows for each task, and a prefix of many windows is split. There equal windows are added up. Most
of them are rare: the last word of a window below ``min_count``, and the second last one where the
whole prefix lies inside one range and is below it as well, is put to null before the ROLLUP. That
moves no count of a phrase of ``min_count`` occurrences or more, since such windows stay in the sum of
all their other prefixes, and leaves little to shuffle.

A phrase of ``min_count`` occurrences consists of parts that occur as often, so everything after the
ROLLUP reads the frequent phrases only. Counts are sums over all texts, and the scores are computed
in decimals of 38 digits (exact while 1000000 * a * a stays below 1e38).

Defined cases: a null or empty text, and one of separators only, has no words; a null language is
``und``; repeated rows, and rows without an id, count as often as they stand there; very long texts
are counted in slices, windows across their borders included; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.session import cut_lineage

SPACES = " \t"
BREAKS = ".,;:!?\n\v\f\r"
SLICE = 1 << 22  # bytes whose windows are counted at once

_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES.encode())] = 1
_KIND[list(BREAKS.encode())] = 2


def counted_windows(data: bytes, width: int, last: bool = True) -> tuple[pa.Table, int]:
    """Windows of ``width`` words with their counts (``w1 ... n``) in sorted order, and where the
    text goes on.

    If ``data`` is not the last slice of its text, its last ``width - 1`` words start no window
    yet; the position of the first of them is returned (0 if there is no other word).
    """
    raw = np.frombuffer(data.lower(), np.uint8)
    kind = _KIND[raw]
    inside = kind == 0
    step = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    starting = len(start) if last else max(0, len(start) - width + 1)
    offsets = np.concatenate(([0], np.cumsum(end - start))).astype(np.int32)
    words = pa.StringArray.from_buffers(
        len(start), pa.py_buffer(offsets), pa.py_buffer(raw[inside])).dictionary_encode()
    order = pc.sort_indices(words.dictionary).to_numpy()
    rank = np.zeros(len(order) + 1, np.int64)  # the last one, 0, is that of no word
    rank[order] = np.arange(1, len(order) + 1)
    ids = rank[words.indices.to_numpy()]
    piece = np.cumsum(kind == 2)[start]
    base = len(order) + 1
    key, parts = np.zeros(starting, np.int64), []
    for k in range(width):
        lead = np.zeros(starting, np.int64)
        there = max(0, min(starting, len(start) - k))
        lead[:there] = np.where(piece[k:k + there] == piece[:there], ids[k:k + there], 0)
        if int(key.max(initial=0)) >= 2**62 // base:
            values, key = np.unique(key, return_inverse=True)
            parts.append(values)
        key = key * base + lead
        parts.append(None)
    key, n = np.unique(key, return_counts=True)
    names = [f"w{k + 1}" for k in range(width)]
    columns: list[pa.Array] = []
    sorted_words = words.dictionary.take(pa.array(order))
    for step_ in reversed(parts):
        if step_ is None:
            key, lead = np.divmod(key, base)
            columns.insert(0, sorted_words.take(pa.array(lead - 1, mask=lead == 0)))
        else:
            key = step_[key]
    rest = int(start[starting]) if 0 < starting < len(start) else 0
    return pa.table([*columns, pa.array(n)], [*names, "n"]), rest


def windows_of(data: bytes, width: int, size: int = SLICE) -> Iterator[pa.Table]:
    """Counted windows of one text, in slices of about ``size`` bytes that end between words."""
    whole = np.frombuffer(data, np.uint8)
    at, length = 0, size
    while len(whole) - at > length:
        gap = np.flatnonzero(_KIND[whole[at:at + length]])
        table, rest = (counted_windows(data[at:at + int(gap[-1]) + 1], width, last=False)
                       if len(gap) else (None, 0))
        if rest:
            yield table
            at, length = at + rest, size
        else:
            length *= 2
    yield counted_windows(data[at:], width)[0]


# Bytes below the blank would break the order of windows by their words; 0x7f marks their stand-ins.
_ESCAPES = {chr(c): "\x7f" + chr(c + 64) for c in range(32)} | {"\x7f": "\x7f\x7f"}
_ODD = "[\x00-\x1f\x7f]"


def _translated(strings: pa.Array, pattern: str, new: Callable[[re.Match], str]) -> pa.Array:
    if not pc.any(pc.match_substring_regex(strings, pattern)).as_py():
        return strings
    return pa.array([s if s is None else re.sub(pattern, new, s) for s in strings.to_pylist()],
                    pa.string())


def _escaped(strings: pa.Array) -> pa.Array:
    return _translated(strings, _ODD, lambda m: _ESCAPES[m[0]])


def _plain(strings: pa.Array) -> pa.Array:
    return _translated(strings, "\x7f.", lambda m: "\x7f" if m[0][1] == "\x7f" else chr(ord(m[0][1]) - 64))


def window_counts(docs: DataFrame, width: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """``_lang, _window, _n``: the longest windows of all texts, counted by batch, each as one string."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0

        def out(lang: str, table: pa.Table) -> Iterator[pa.RecordBatch]:
            for part in table.to_batches(65_536):
                words = [_escaped(c) for c in part.columns[:width]]
                window = pc.binary_join_element_wise(*words, " ", null_handling="skip")
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(part)), window, part["n"]],
                                                 ["_lang", "_window", "_n"])

        def flush() -> Iterator[pa.RecordBatch]:
            for key, texts in held.items():
                yield from out(key, counted_windows(b"\n".join(texts), width)[0])

        for batch in batches:
            for value, key in zip(batch["_text"], batch["_lang"].to_pylist()):
                if not value.is_valid:
                    continue
                raw = value.as_buffer().to_pybytes()
                if len(raw) > SLICE:
                    for table in windows_of(raw, width):
                        yield from out(key, table)
                    continue
                held.setdefault(key, []).append(raw)
                size += len(raw)
                if size > SLICE:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("_lang"),
                       F.col(text).alias("_text")).mapInArrow(
                           count, "_lang string, _window string, _n long")


class RareEnds:
    """Adds up the sorted windows of one range and takes the ends of rare ones off.

    Feed tables ``_window, _lang, _n`` in the order of the windows; each gives a table of the same form
    whose windows are prefixes. What is open at a table's end (its last window and the rest of its
    last prefix) is carried to the next one. The first and the last prefix of a range may go on in
    others and keep their words.
    """

    def __init__(self, width: int, min_count: int):
        self.width, self.min_count = width, min_count
        self.held: pa.Table | None = None      # rows of the last window
        self.open: pa.Table | None = None      # _prefix, _lang, _n, _often of the last prefix
        self.first: str | None = None          # the first prefix

    def feed(self, rows: pa.Table, last: bool = False) -> pa.Table:
        rows = rows.select(["_window", "_lang", "_n"])
        if self.held is not None:
            rows = pa.concat_tables([self.held, rows])
        self.held = None
        if not last and len(rows):
            going_on = pc.equal(rows["_window"], rows["_window"][-1])
            self.held, rows = _summed(rows.filter(going_on)), rows.filter(pc.invert(going_on))
        # The last prefix by order; grouping does not keep the order.
        words = pc.add(pc.count_substring(rows["_window"], " "), 1)
        ending = rows["_window"].filter(pc.greater_equal(words, self.width - 1))
        now = _shortened(ending[-1].as_py(), self.width - 1) if len(ending) else (
            self.open["_prefix"][0].as_py() if self.open is not None else None)
        if self.first is None and len(ending):
            self.first = _shortened(ending[0].as_py(), self.width - 1)

        merged = _summed(rows)
        words = pc.add(pc.count_substring(merged["_window"], " "), 1)
        inside = pc.greater_equal(words, self.width - 1)
        often = pc.and_(pc.equal(words, self.width), pc.greater_equal(merged["_n"], self.min_count))
        kept = merged.filter(pc.or_(often, pc.invert(inside)))
        inner, words, often = merged.filter(inside), words.filter(inside), often.filter(inside)
        prefix = pc.if_else(pc.equal(words, self.width), pc.replace_substring_regex(
            inner["_window"], " [^ ]*$", ""), inner["_window"])
        rest = pa.table([prefix, inner["_lang"], pc.if_else(often, 0, inner["_n"]),
                         pc.cast(often, pa.int64())], ["_prefix", "_lang", "_n", "_often"])
        if self.open is not None:
            rest = pa.concat_tables([self.open, rest])
        rest = rest.group_by(["_prefix", "_lang"], use_threads=False).aggregate(
            [("_n", "sum"), ("_often", "max")]).rename_columns(["_prefix", "_lang", "_n", "_often"])
        edge = pc.equal(rest["_prefix"], self.first or "")
        final = pc.equal(rest["_prefix"], now or "")
        self.open = None
        if last:
            edge = pc.or_(edge, final)
        elif now is not None:
            self.open, rest = rest.filter(final), rest.filter(pc.invert(final))
            edge = edge.filter(pc.invert(final))
        rare = pc.and_(pc.equal(rest["_often"], 0), pc.less(rest["_n"], self.min_count))
        cut = pc.replace_substring_regex(rest["_prefix"], " [^ ]*$", "")
        ends = pc.if_else(pc.and_(rare, pc.invert(edge)), cut, rest["_prefix"])
        found = pa.table([ends, rest["_lang"], rest["_n"]], ["_window", "_lang", "_n"])
        return _summed(pa.concat_tables([kept, found.filter(pc.greater(rest["_n"], 0))]))


def _summed(rows: pa.Table) -> pa.Table:
    return (rows.group_by(["_window", "_lang"], use_threads=False).aggregate([("_n", "sum")])
            .rename_columns(["_window", "_lang", "_n"]).combine_chunks())


def _shortened(window: str, words: int) -> str:
    return " ".join(window.split(" ")[:words])


def phrase_counts(docs: DataFrame, max_words: int, min_count: int, text: str = "text",
                  lang: str = "lang") -> DataFrame:
    """``_lang, _words, _phrase, _f``: phrases of 1 to ``max_words`` words that occur ``min_count``
    times or more, and for each language a row of 0 words that holds the number of all words."""
    names = [f"w{k + 1}" for k in range(max_words)]
    schema = "_lang string, " + ", ".join(f"{c} string" for c in names) + ", _n long"

    def without_rare_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = RareEnds(max_words, min_count)

        def lead(table: pa.Table) -> Iterator[pa.RecordBatch]:
            for part in table.to_batches():
                words = pc.split_pattern(part["_window"], " ")
                columns = [_plain(pc.list_element(pc.list_slice(
                    words, k, k + 1, return_fixed_size_list=True), 0)) for k in range(max_words)]
                yield pa.RecordBatch.from_arrays([part["_lang"], *columns, part["_n"]],
                                                 ["_lang", *names, "_n"])

        empty = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            empty = table.slice(0, 0)
            yield from lead(state.feed(table))
        if empty is not None:
            yield from lead(state.feed(empty, last=True))

    windows = (window_counts(docs, max_words, text, lang).repartitionByRange("_window", "_lang")
               .sortWithinPartitions("_window", "_lang"))
    keys = ["_lang", *names]
    sums = (windows.mapInArrow(without_rare_ends, schema).rollup(*keys)
            .agg(F.sum("_n").alias("_f"), F.grouping_id().alias("_level"))
            .filter(F.col("_lang").isNotNull()))
    # The ROLLUP leaves out 0, 1, ... of the last words: its level is 0, 1, 3, 7, ...
    words = sum(F.col(c).isNotNull().cast("int") for c in names)
    left = max_words - F.bit_count("_level")
    return (sums.filter((words == left) & ((left == 0) | (F.col("_f") >= min_count)))
            .select("_lang", words.alias("_words"), F.concat_ws(" ", *names).alias("_phrase"), "_f"))


def scored(phrases: DataFrame) -> DataFrame:
    """``_lang, _phrase, _words, a, l, r, score`` of each phrase of two words or more, by its worst
    cut: score floor(1000000 * a * a / (l * r)), ties to the smallest first part."""
    words = F.split("_phrase", " ")
    cuts = (phrases.filter("_words >= 2")
            .withColumn("_cut", F.explode(F.sequence(F.lit(1), F.col("_words") - 1)))
            .withColumn("_left", F.concat_ws(" ", F.slice(words, 1, F.col("_cut"))))
            .withColumn("_right", F.concat_ws(" ", F.slice(words, F.col("_cut") + 1, F.col("_words")))))
    parts = phrases.filter("_words >= 1")
    first = parts.select("_lang", F.col("_phrase").alias("_left"), F.col("_f").alias("l"))
    rest = parts.select("_lang", F.col("_phrase").alias("_right"), F.col("_f").alias("r"))
    score = F.expr("(1000000 * cast(_f as decimal(19,0)) * cast(_f as decimal(19,0))) "
                   "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    worst = F.min(F.struct(score.alias("score"), "_cut", "l", "r")).alias("_worst")
    return (cuts.join(first, ["_lang", "_left"]).join(rest, ["_lang", "_right"])
            .groupBy("_lang", "_phrase").agg(worst, F.first("_f").alias("a"),
                                             F.first("_words").alias("_words"))
            .select("_lang", "_phrase", "_words", "a", "_worst.l", "_worst.r", "_worst.score"))


def uncovered(candidates: DataFrame, phrases: DataFrame, percent: int) -> DataFrame:
    """Candidates that no longer phrase of ``phrases`` holds in ``percent`` of their occurrences."""
    words = F.split("_phrase", " ")
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("_words") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.col("_words") - size + 1),
                                 lambda at: F.concat_ws(" ", F.slice(words, at, size)))))
    covers = (phrases.filter("_words >= 3")
              .select("_lang", F.explode(inner).alias("_phrase"), "_f")
              .groupBy("_lang", "_phrase").agg(F.max("_f").alias("_longer")))
    return (candidates.join(covers, ["_lang", "_phrase"], "left")
            .filter(F.col("_longer").isNull() | (100 * F.col("_longer") < percent * F.col("a"))))


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, percent: int = 50,
                 top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    ``a`` is the phrase's number of occurrences, ``l`` and ``r`` those of its two parts at the cut
    that scores lowest, ``n`` the number of all words of the language. A phrase is dropped if a
    longer one (itself of ``min_count`` occurrences) holds ``percent`` of its occurrences.
    """
    phrases = cut_lineage(phrase_counts(docs, max_words, min_count, text, lang))
    best = Window.partitionBy("_lang").orderBy(F.desc("score"), F.desc("a"), "_phrase")
    ranked = (uncovered(scored(phrases), phrases, percent)
              .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top))
    totals = phrases.filter("_words = 0").select("_lang", F.col("_f").alias("n"))
    return ranked.join(totals, "_lang").select(
        F.col("_lang").alias("lang"), F.col("rank").cast("long").alias("rank"),
        F.col("_phrase").alias("phrase"), "a", "l", "r", "n", "score")
