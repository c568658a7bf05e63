"""Quality rules of documents, and verdicts on hosts by an empirical beta prior.

Each text gets counts and base rules. Failures are summed by host; a beta prior fitted to the hosts' rates by the
method of moments shrinks each rate, (failed + a) / (documents + a + b), and a host above max_rate is rejected with
all its documents. Only DataFrame functions run.

Nulls: a null text has no words (and so fails), a null host is a host of its own. Empty tables give no rows. Repeated
rows and ids count as often as they stand. Very long texts are handled in one pass and a sort of their word windows.
Extra columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Up to so many hosts their verdicts are broadcast; more are joined by a shuffle.
BROADCAST_HOSTS = 100_000


def let(value: Column, body) -> Column:
    """body(value), with value computed once a row."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more: sort (hash, place), compare neighbours' words, add up what they cover."""

    def same(a: Column, b: Column) -> Column:
        equal = (F.get(words, a) == F.get(words, b)) & (F.get(words, a + 1) == F.get(words, b + 1))
        return equal & (F.get(words, a + 2) == F.get(words, b + 2))

    def covered(windows: Column) -> Column:
        def twin(x: Column, k: Column) -> Column:
            near = [F.get(windows, k - 1), F.get(windows, k + 1)]
            return F.coalesce(near[0].h == x.h, F.lit(False)) & F.coalesce(same(near[0].p, x.p), F.lit(False)) | F.coalesce(near[1].h == x.h, F.lit(False)) & F.coalesce(same(near[1].p, x.p), F.lit(False))

        places = F.sort_array(F.transform(F.filter(windows, twin), lambda x: x.p))
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(places, start, lambda a, p: F.struct((a.n + F.least(F.lit(3), p - a.last)).alias("n"), p.alias("last")), lambda a: a.n)

    def hashed(p: Column) -> Column:
        return F.xxhash64(F.get(words, p), F.get(words, p + 1), F.get(words, p + 2))

    n = F.size(words)
    places = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))

    def count(hashes: Column) -> Column:
        windows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(windows, covered))

    return let(F.transform(places, hashed), count)


def text_counts(text: Column) -> dict[str, Column]:
    t = F.coalesce(text, F.lit(""))
    squeezed = _without(t, SPACES)
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(_without(x, SPACES)) > 0)
    words = F.filter(F.split(t, "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    both = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words")))
    return {
        "both": both,
        "word_chars": F.length(squeezed).cast("long"),
        "n_symbols": (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long"),
        "n_dup_lines": let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
    }


def base_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, counts, base_failed) of every document."""
    counted = docs.select("doc_id", F.col(host).alias("host"), *(c.alias(n) for n, c in text_counts(F.col("text")).items()))
    flat = counted.select("doc_id", "host", "both.n_words", "word_chars", "n_symbols", "n_dup_lines", "both.n_repeat_words")
    return flat.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def host_verdicts(rated: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """(host, n_docs, n_failed, rate, host_rejected); the prior is one row, put in as a scalar."""
    hosts = rated.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    raw = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(F.struct(F.avg(raw).alias("m"), F.var_pop(raw).alias("v")).alias("p")).scalar()
    mean, var = prior.getField("m"), prior.getField("v")
    strength = F.when(var > 0, F.greatest(F.lit(1.0), mean * (1 - mean) / var - 1)).otherwise(F.lit(1000.0))
    rate = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    return hosts.withColumn("rate", rate).withColumn("host_rejected", F.col("rate") > max_rate)


def apply_rules(docs: DataFrame, host: str = "source", max_rate: float = 0.5) -> DataFrame:
    """(doc_id, host, counts, base_failed, host_rejected, kept) of every document."""
    rated = common.materialize(base_rules(docs, host))
    verdicts = common.materialize(host_verdicts(rated, max_rate)).select(F.col("host").alias("its_host"), "host_rejected")
    if verdicts.count() <= BROADCAST_HOSTS:
        verdicts = F.broadcast(verdicts)
    joined = rated.join(verdicts, rated.host.eqNullSafe(verdicts.its_host)).drop("its_host")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def query(spark, sf_dir: str) -> DataFrame:
    ruled = apply_rules(common.read(spark, sf_dir, "documents"))
    return ruled.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_rejected")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
win AS (SELECT r, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g FROM w, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS p)),
rep AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM rep) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
base AS (
  SELECT d.r, doc_id, source, CAST(len(w.w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN cov USING (r)),
rated AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
hosts AS (SELECT source, count(*) AS n, sum(CAST(base_failed AS BIGINT)) AS f FROM rated GROUP BY source),
prior AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v FROM hosts),
strength AS (SELECT m, CASE WHEN v > 0 THEN greatest(1.0, m * (1 - m) / v - 1) ELSE 1000.0 END AS s FROM prior),
verdict AS (SELECT source, (f + m * s) / (n + s) > 0.5 AS host_rejected FROM hosts, strength)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT host_rejected AS kept, host_rejected
FROM rated JOIN verdict ON rated.source IS NOT DISTINCT FROM verdict.source
"""
