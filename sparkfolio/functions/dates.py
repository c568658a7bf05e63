"""Dates in text, date precision and comparisons of partly known dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A full-year date with '-', '/', '.' or the CJK units between its parts.
DATE_PATTERN = "(\\d{4})[-/.年](\\d{1,2})[-/.月](\\d{1,2})"


#: The same with a time of day; a two-digit day may run into a two-digit hour, as in 2024-01-0213:30.
STAMP_PATTERN = (
    "(?<!\\d)((?:19|20)\\d{2})\\s*[-/年.]\\s*(\\d{1,2})\\s*[-/月.]\\s*(\\d{1,2})日?"
    "(?:(?:[ T]+|(?<=\\d{2})(?=\\d{2}:))(\\d{1,2}):(\\d{2})(?::(\\d{2}))?)?(?!\\d)"
)
MONTH_PATTERN = "(?<!\\d)((?:19|20)\\d{2})\\s*[-/年.]\\s*(\\d{1,2})月?(?!\\s*[-/月.]?\\s*\\d)"


def iso_date(year: Column, month: Column, day: Column) -> Column:
    """YYYY-MM-DD, or null where there is no such day."""
    text = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "yyyy-MM-dd")


def places(text: Column, pattern: str) -> Column:
    """[(mention, start, end)] of all matches of a pattern that matches no empty text: the matches and what lies between them
    give the offsets."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def total(parts: Column) -> Column:
        return F.aggregate(parts, F.lit(0), lambda a, x: a + F.length(x))

    def placed(both: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            start = total(F.slice(both.gaps, 1, i + 1)) + total(F.slice(both.found, 1, i))
            return F.struct(m.alias("mention"), start.alias("start"), (start + F.length(m)).alias("end"))

        return F.transform(both.found, one)

    return F.transform(F.array(F.struct(found.alias("found"), between.alias("gaps"))), placed)[0]


def stamps(text: Column) -> Column:
    """[(date, timestamp, precision, start, end)] of the full-year dates of a text; what is no day or no time is left out.
    timestamp is empty for a day alone, and has seconds only where the text has."""

    def parsed(x: Column) -> Column:
        part = [F.regexp_extract(x.mention, STAMP_PATTERN, i) for i in range(1, 7)]
        two = [F.lpad(p, 2, "0") for p in part]
        day = F.concat_ws("-", part[0], two[1], two[2])
        hour, second = part[3] != "", part[5] != ""
        time = F.concat_ws(":", two[3], two[4], F.when(second, two[5]).otherwise("00"))
        stamp = F.try_to_timestamp(F.concat(day, F.lit(" "), F.when(hour, time).otherwise("00:00:00")), F.lit("yyyy-MM-dd HH:mm:ss"))
        iso = F.when(~hour, "").otherwise(F.concat(day, F.lit("T"), F.when(second, time).otherwise(F.concat_ws(":", two[3], two[4]))))
        precision = F.when(second, "second").when(hour, "minute").otherwise("day")
        return F.struct(F.when(stamp.isNotNull(), day).alias("date"), iso.alias("timestamp"), precision.alias("precision"), x.start.alias("start"), x.end.alias("end"))

    return F.filter(F.transform(places(text, STAMP_PATTERN), parsed), lambda d: d.date.isNotNull())


def date_mentions(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, ordinal from 1, mention, date, timestamp, precision, char_start, char_end) of every valid date in a text, in order."""
    found = docs.select(key, F.col(text).alias("_t"), F.posexplode(stamps(F.col(text))).alias("at", "x"))
    mention = F.substring("_t", F.col("x.start") + 1, F.col("x.end") - F.col("x.start"))
    return found.select(key, (F.col("at") + 1).cast("long").alias("ordinal"), mention.alias("mention"), "x.date", "x.timestamp", "x.precision", F.col("x.start").alias("char_start"), F.col("x.end").alias("char_end"))


def valid_for_precision(date: Column, precision: Column) -> Column:
    shape = F.when(precision == "day", "^\\d{4}-\\d{2}-\\d{2}$").when(precision == "month", "^\\d{4}-\\d{2}$").when(precision == "year", "^\\d{4}$")
    return F.when(precision == "unknown", date == "").otherwise(F.regexp_like(date, shape) & F.try_to_date(F.rpad(date, 10, "-01-01"), "yyyy-MM-dd").isNotNull())


def at_or_after(a: Column, b: Column, tie: Column) -> Column:
    """Whether a is not before b: days compare by day, a month with a day by month only if they differ, equal ones by tie; unknown: false."""
    n = F.least(F.length(a), F.length(b))
    x, y = F.substring(a, F.lit(1), n), F.substring(b, F.lit(1), n)
    return F.when((a == "") | (b == ""), False).when(x != y, x > y).when(F.length(a) != F.length(b), False).otherwise(tie)
