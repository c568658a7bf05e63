"""Text: NFKC, lines with offsets, conservative clean-up of printed pages, tokens."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space but the line feed, spelt out, as Java's \s is ASCII.
BLANK = "[\\t\\x0B\\f\\r \\x1c-\\x1f\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"

# What a browser adds to a printed page, placeholders of identifiers.
BROWSER_TITLE = "(?i)360\\s*(?:视图|view)\\s*v?2\\.1\\s*Beta"
URL_LINE = "^(?i:https?://|file:///|\\(?/(?:BasicInfo|MedicalRecord|Inspection|Examination)/)"
PAGE_NUMBER = "^(?:第\\s*\\d+\\s*页\\s*(?:[共/]\\s*\\d+\\s*页?)?|\\d+\\s*/\\s*\\d+)\\s*$"
MISSING = ["", "-", "--", "—", "无", "暂无", "未知", "未提供", "不详", "nan", "none", "null", "na", "n/a", "unknown"]
PLACEHOLDERS = ["0", "000000", "00000000", "999999", "99999999"]


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Unicode NFKC; there is no built-in function for it."""
    return text.map(lambda x: None if x is None else x if x.isascii() else unicodedata.normalize("NFKC", x))


def let(value: Column, body) -> Column:
    """body(value), with value computed once a row."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    """Without white space at its ends, of any kind."""
    return F.regexp_replace(text, f"^(?:{BLANK}|\n)+|(?:{BLANK}|\n)+$", "")


def normalize_identifier(value: Column) -> Column:
    """NFKC, trimmed, numbers without a trailing '.0'; missing-value tokens and placeholders become the empty string,
    leading zeros stay."""
    cleaned = F.regexp_replace(strip(nfkc(F.coalesce(value.cast("string"), F.lit("")))), "^(\\d+)\\.0$", "$1")
    return F.when(F.lower(cleaned).isin(MISSING) | cleaned.isin(PLACEHOLDERS), "").otherwise(cleaned)


def one_line_end(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def squeezed(text: Column) -> Column:
    """Text in NFKC without zero-width characters, runs of blanks as one, lines trimmed."""
    t = F.regexp_replace(F.regexp_replace(text, "[\u200B\u200C\u200D\uFEFF]", ""), f"{BLANK}+", " ")
    return F.regexp_replace(t, " ?\n ?", "\n")


def normalize_text(text: Column) -> Column:
    """NFKC, one kind of line end, no zero-width characters, single blanks, at most one empty line, trimmed."""
    return strip(F.regexp_replace(squeezed(nfkc(one_line_end(text))), "\n{3,}", "\n\n"))


def line_structs(text: Column) -> Column:
    """[(line from 1, char_start, char_end, line_text)] of a text, by a fold over its lines: code points, end exclusive."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

    def starts(parts: Column) -> Column:
        return F.aggregate(parts, start, lambda a, x: F.struct((a.at + F.length(x) + 1).alias("at"), F.concat(a.starts, F.array(a.at)).alias("starts")), lambda a: a.starts)

    def numbered(parts: Column) -> Column:
        return F.zip_with(parts, starts(parts), lambda x, s: F.struct(s.alias("char_start"), (s + F.length(x)).alias("char_end"), x.alias("line_text")))

    return F.transform(let(F.split(text, "\n"), numbered), lambda x, i: F.struct((i + 1).alias("line"), x.char_start.alias("char_start"), x.char_end.alias("char_end"), x.line_text.alias("line_text")))


def lines(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, line from 1, char_start, char_end, line_text), found inside the row: nothing is shuffled, repeated keys stay apart."""
    each = docs.select(key, F.explode(line_structs(F.col(text))).alias("x"))
    return each.select(key, *(F.col(f"x.{c}").cast("long").alias(c) for c in ("line", "char_start")), F.col("x.line_text").alias("line_text"), F.col("x.char_end").cast("long").alias("char_end"))


def squeeze(parts: Column, blank) -> Column:
    """parts without the blanks at either end and all but the first of a run of them."""
    kept = F.filter(parts, lambda x, i: ~blank(x) | (i > 0) & ~blank(F.get(parts, i - 1)))
    return let(kept, lambda k: F.when((F.size(k) > 0) & blank(F.element_at(k, -1)), F.slice(k, 1, F.size(k) - 1)).otherwise(k))


def squeeze_blank_lines(docs: DataFrame, key: str, text: str, drop) -> DataFrame:
    """(key, line, line_text, normal_line): lines without those that drop(line_text) marks; of blank runs the first stays,
    none at either end. All inside the row."""
    kept = F.filter(line_structs(F.col(text)), lambda x: ~drop(x.line_text))
    out = docs.select(key, F.posexplode(let(kept, lambda k: squeeze(k, lambda x: x.line_text == ""))).alias("at", "x"))
    return out.select(key, F.col("x.line").cast("long").alias("line"), F.col("x.line_text").alias("line_text"), (F.col("at") + 1).cast("long").alias("normal_line"))


def removal_reason(line: Column, index: Column, count: Column) -> Column:
    """Why a line of a printed page is no content, or null; index from 0. Titles and page numbers go at the margins alone."""
    margin = (index < 4) | (index >= count - 5)
    icons = (line != "") & (F.regexp_replace(line, "[\\p{Co} ]", "") == "")
    return (
        F.when(margin & line.rlike(BROWSER_TITLE), "browser_title_at_page_margin")
        .when(line.rlike(URL_LINE), "browser_or_navigation_url")
        .when(margin & line.rlike(PAGE_NUMBER), "page_number_at_page_margin")
        .when(icons, "standalone_private_use_browser_icon")
    )


def normalize_pages(pages: DataFrame, text: str = "text") -> DataFrame:
    """pages with normalized_text, normalized_character_count, normalized_line_map (raw line numbers of the kept lines) and
    removed_lines (raw_line, text, reason). One row a page, nothing is shuffled; the raw text stays."""
    raw = F.split(one_line_end(F.coalesce(F.col(text), F.lit(""))), "\n")
    clean = F.split(squeezed(nfkc(one_line_end(F.coalesce(F.col(text), F.lit(""))))), "\n")
    rows = pages.withColumns({"_raw": raw, "_clean": F.transform(clean, strip)})

    def judged(x: Column, i: Column) -> Column:
        return F.struct((i + 1).alias("raw_line"), x.alias("line"), F.get("_raw", i).alias("text"), removal_reason(x, i, F.size("_clean")).alias("reason"))

    rows = rows.withColumn("_lines", F.transform("_clean", judged))
    rows = rows.withColumn("_kept", let(F.filter("_lines", lambda x: x.reason.isNull()), lambda k: squeeze(k, lambda x: x.line == "")))
    joined = F.array_join(F.transform("_kept", lambda x: x.line), "\n")
    gone = F.transform(F.filter("_lines", lambda x: x.reason.isNotNull()), lambda x: F.struct(x.raw_line.alias("raw_line"), x.text.alias("text"), x.reason.alias("reason")))
    out = rows.withColumns({"normalized_text": joined, "normalized_line_map": F.transform("_kept", lambda x: x.raw_line), "removed_lines": gone})
    return out.withColumn("normalized_character_count", F.length("normalized_text")).drop("_raw", "_clean", "_lines", "_kept")


def excerpt(text: Column, start: Column, end: Column, radius: int) -> Column:
    """The text from radius characters before start to as many after end; offsets from 0, end exclusive."""
    low = F.greatest(start - radius, F.lit(0))
    return F.substring(text, low + 1, end + radius - low)


def page(text: Column, number: int, size: int = 10_000) -> Column:
    """A text's page, from 1, of so many characters."""
    return F.substring(text, (number - 1) * size + 1, size)


def title_type(title: Column, rules: list[tuple[str, str]], longest: int, default: str = "unknown") -> Column:
    """The type of the first rule (type, pattern) that a short title matches."""
    out = None
    for kind, pattern in rules:
        hit = (F.length(title) <= longest) & title.rlike(pattern)
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return F.lit(default) if out is None else out.otherwise(default)


def numbered(rows: DataFrame, keys: list[str], order: list[Column], alias: str = "k") -> DataFrame:
    return rows.withColumn(alias, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
