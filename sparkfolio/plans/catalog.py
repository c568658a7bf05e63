"""The queries over the given tables, one for each operator, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfolio.functions import dates, ids, intervals, text
from sparkfolio.operators import casework, evidence, explorer, gold, identity, quality, review, rules, timeline, validate
from sparkfolio.operators.rules import Rule

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


@query("SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE user_id IS NOT NULL AND ts < TIMESTAMP '2024-01-15'")
def q01_timeline_before_cutoff(spark, d) -> DataFrame:
    sections = table(spark, d, "events").select("event_id", "user_id", "event_type", _day("ts").alias("day"))
    return timeline.before_cutoff(timeline.reliable(sections, "user_id", "day"), "day", "2024-01-15")


@query("""SELECT c_custkey, CAST(count(o_orderkey) AS BIGINT) AS n_documents, CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS n_f,
  CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS n_o, CAST(count(*) FILTER (o_orderstatus = 'P') AS BIGINT) AS n_p,
  min(strftime(o_orderdate, '%Y-%m-%d')) AS earliest, max(strftime(o_orderdate, '%Y-%m-%d')) AS latest,
  CASE WHEN count(o_orderkey) = 0 THEN 'no_documents' WHEN count(*) FILTER (o_orderstatus = 'F') = count(o_orderkey) THEN 'complete'
       WHEN count(*) FILTER (o_orderstatus = 'F') > 0 THEN 'partial' ELSE 'pending' END AS parse_status
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def q02_patient_manifest(spark, d) -> DataFrame:
    orders = table(spark, d, "orders").withColumn("day", _day("o_orderdate"))
    return quality.manifest(table(spark, d, "customer"), orders, "c_custkey", "o_custkey", "o_orderstatus", "day", ["F", "O", "P"], "F")


@query("""SELECT doc_id, sha256(text) AS content_key, doc_id = first_value(doc_id) OVER w AS is_canonical,
  CASE WHEN doc_id <> first_value(doc_id) OVER w THEN first_value(doc_id) OVER w END AS duplicate_of
  FROM documents WINDOW w AS (PARTITION BY sha256(text) ORDER BY CASE WHEN lang = 'en' THEN 0 ELSE 1 END, source, doc_id)""")
def q03_canonical_documents(spark, d) -> DataFrame:
    rank = [F.when(F.col("lang") == "en", 0).otherwise(1), F.col("source")]
    return identity.canonical(table(spark, d, "documents"), F.sha2("text", 256), "doc_id", rank).select("doc_id", "content_key", "is_canonical", "duplicate_of")


@query("""SELECT doc_id, content_key, n, leader FROM (SELECT doc_id, sha256(text) AS content_key, count(*) OVER w AS n, min(doc_id) OVER w AS leader FROM documents WHERE text IS NOT NULL WINDOW w AS (PARTITION BY sha256(text))) WHERE n > 1""")
def q04_duplicate_groups(spark, d) -> DataFrame:
    return identity.duplicate_members(table(spark, d, "documents"), F.sha2("text", 256), "doc_id")


@query("""SELECT sha256(text) AS content_key, count(DISTINCT source) AS n_owners, string_agg(DISTINCT source, '|' ORDER BY source) AS owners
  FROM documents GROUP BY sha256(text) HAVING count(DISTINCT source) > 1""")
def q05_identity_conflict(spark, d) -> DataFrame:
    return identity.identity_conflicts(table(spark, d, "documents"), F.sha2("text", 256), "source")


@query("""SELECT c_custkey, CASE WHEN n = 1 THEN name ELSE name || '_duplicate_' || CAST(n AS VARCHAR) END AS patient_id FROM (
  SELECT c_custkey, name, row_number() OVER (PARTITION BY name ORDER BY c_custkey) AS n
  FROM (SELECT c_custkey, c_mktsegment || '/' || CAST(c_nationkey AS VARCHAR) AS name FROM customer))""")
def q06_duplicate_suffix(spark, d) -> DataFrame:
    name = F.concat("c_mktsegment", F.lit("/"), F.col("c_nationkey").cast("string"))
    return identity.duplicate_suffix(table(spark, d, "customer"), name, "c_custkey", "patient_id").select("c_custkey", "patient_id")


@query("""SELECT unnest(['documents', 'finished', 'open', 'subjects', 'large']) AS metric, unnest([count(*)::DOUBLE,
  (count(*) FILTER (o_orderstatus = 'F'))::DOUBLE, (count(*) FILTER (o_orderstatus = 'O'))::DOUBLE, count(DISTINCT o_custkey)::DOUBLE,
  (count(*) FILTER (o_totalprice > 100000))::DOUBLE]) AS value FROM orders""")
def q07_qc_summary(spark, d) -> DataFrame:
    status = F.col("o_orderstatus")
    metrics = {"documents": F.count(F.lit(1)), "finished": F.count_if(status == "F"), "open": F.count_if(status == "O"), "subjects": F.count_distinct("o_custkey"), "large": F.count_if(F.col("o_totalprice") > 100000)}
    return quality.summary(metrics, table(spark, d, "orders"))


@query("""SELECT flag, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN value < 10 THEN 'low' END, CASE WHEN event_type = 'error' THEN 'error' END,
  CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 THEN 'even' END], lambda x: x IS NOT NULL)) AS flag FROM events) GROUP BY flag""")
def q08_flag_counts(spark, d) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    flags = review.reasons([("low", F.col("value") < 10), ("error", F.col("event_type") == "error"), ("even", k % 2 == 0)])
    return quality.flag_counts(table(spark, d, "events"), flags)


@query("""SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_subjects, count(*) FILTER (ts >= TIMESTAMP '2024-01-10') AS n_dated FROM events GROUP BY event_type""")
def q09_section_counts_overview(spark, d) -> DataFrame:
    return explorer.overview(table(spark, d, "events"), "event_type", "user_id", _day("ts") >= "2024-01-10")


@query("SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS n FROM orders GROUP BY 1")
def q10_timeline_years(spark, d) -> DataFrame:
    return timeline.years(table(spark, d, "orders"), _day("o_orderdate"))


@query("""SELECT o_custkey AS c_custkey, string_agg(s || ':' || CAST(n AS VARCHAR), ',' ORDER BY s) AS type_counts, CAST(sum(n) AS BIGINT) AS n_documents
  FROM (SELECT o_custkey, o_orderpriority AS s, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_custkey""")
def q11_patient_rows(spark, d) -> DataFrame:
    per = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array_sort(F.collect_list(F.concat("s", F.lit(":"), F.col("n").cast("string"))))
    return per.groupBy("c_custkey").agg(F.concat_ws(",", pairs).alias("type_counts"), F.sum("n").alias("n_documents"))


@query("""SELECT c_custkey, c_name, c_acctbal FROM customer WHERE lower(c_name) LIKE '%00%' AND c_mktsegment = 'BUILDING'
  ORDER BY c_acctbal DESC, c_custkey LIMIT 50 OFFSET 5""")
def q12_list_patients(spark, d) -> DataFrame:
    page = explorer.listing(table(spark, d, "customer"), {"c_name": "00"}, {"c_mktsegment": "BUILDING", "c_nationkey": None}, [F.desc("c_acctbal"), F.asc("c_custkey")], 5, 50)
    return page.select("c_custkey", "c_name", "c_acctbal")


@query("""SELECT doc_id, CASE WHEN quality = 1 THEN 'yes' WHEN quality = 0 THEN 'no' ELSE 'yes' END AS judgment,
  CASE WHEN quality IS NULL THEN 'default' ELSE 'label' END AS decided_by FROM documents LEFT JOIN labels USING (doc_id)""")
def q13_cohort_resolution(spark, d) -> DataFrame:
    both = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    said = F.when(F.col("quality") == 1, "yes").when(F.col("quality") == 0, "no")
    return both.select("doc_id", F.coalesce(said, F.lit("yes")).alias("judgment"), F.when(F.col("quality").isNull(), "default").otherwise("label").alias("decided_by"))


@query("""SELECT 'order_without_customer' AS code, CAST(o_orderkey AS VARCHAR) AS artifact_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT 'line_without_order', CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
  UNION ALL SELECT 'line_without_part', CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)
  UNION ALL SELECT 'repeated_line', CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q14_orphan_checks(spark, d) -> DataFrame:
    line, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    name = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return validate.report([
        ("order_without_customer", validate.orphans(orders, table(spark, d, "customer"), "o_custkey", "c_custkey", F.col("o_orderkey"))),
        ("line_without_order", validate.orphans(line, orders.where("o_orderstatus <> 'P'"), "l_orderkey", "o_orderkey", name)),
        ("line_without_part", validate.orphans(line, table(spark, d, "part").where("p_size <= 45"), "l_partkey", "p_partkey", name)),
        ("repeated_line", validate.repeated(line, "l_orderkey", "l_linenumber")),
    ])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def q15_fk_semi(spark, d) -> DataFrame:
    wanted = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(wanted, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("""WITH x AS (SELECT o_orderkey, count(l_orderkey) AS n, min(l_linenumber) AS lo, max(l_linenumber) AS hi FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey)
  SELECT 'no_lines' AS code, count(*) FILTER (n = 0) AS n_errors, count(*) FILTER (n = 0) = 0 AS passed FROM x
  UNION ALL SELECT 'gaps_in_lines', count(*) FILTER (n > 0 AND hi - lo + 1 <> n), count(*) FILTER (n > 0 AND hi - lo + 1 <> n) = 0 FROM x""")
def q16_recount_validator(spark, d) -> DataFrame:
    per = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi"))
    x = table(spark, d, "orders").select("o_orderkey").join(per, "o_orderkey", "left")
    return validate.counts([("no_lines", validate.offenders(x, F.col("n").isNull(), F.col("o_orderkey"))), ("gaps_in_lines", validate.offenders(x, F.col("hi") - F.col("lo") + 1 != F.col("n"), F.col("o_orderkey")))])


_LINES = """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line_text, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents)"""


@query(_LINES + """ SELECT doc_id, CAST(line AS BIGINT) AS line, CAST(s AS BIGINT) AS char_start, CAST(s + length(line_text) AS BIGINT) AS char_end, line_text FROM (
  SELECT *, coalesce(sum(length(line_text) + 1) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM l)""")
def q17_line_numbers(spark, d) -> DataFrame:
    return text.lines(table(spark, d, "documents"), "doc_id")


@query(_LINES + """, k AS (SELECT *, lag(line_text) OVER (PARTITION BY doc_id ORDER BY line) AS before, max(CASE WHEN line_text <> '' THEN line END) OVER (PARTITION BY doc_id) AS last_text
    FROM l WHERE NOT regexp_matches(line_text, '(?i)all rights reserved|^page [0-9]+$'))
  SELECT doc_id, CAST(line AS BIGINT) AS line, line_text, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS normal_line
  FROM k WHERE line_text <> '' OR (before IS NOT NULL AND before <> '' AND line < last_text)""")
def q18_normalized_lines(spark, d) -> DataFrame:
    return text.squeeze_blank_lines(table(spark, d, "documents"), "doc_id", "text", lambda x: x.rlike("(?i)all rights reserved|^page [0-9]+$"))


@query("""WITH u AS (SELECT conv_id, turn FROM conversations), s AS (SELECT conv_id, turn AS a, turn + CASE WHEN role = 'user' THEN 1 ELSE 0 END AS b FROM conversations WHERE turn % 3 <> 2),
  h AS (SELECT conv_id, t AS turn, count(*) AS n FROM (SELECT conv_id, unnest(range(a, b + 1)) AS t FROM s) GROUP BY ALL)
  SELECT conv_id, count(*) AS n_units, count(*) FILTER (coalesce(n, 0) = 0) AS uncovered, count(*) FILTER (coalesce(n, 0) > 1) AS overlapping FROM u LEFT JOIN h USING (conv_id, turn) GROUP BY conv_id""")
def q19_coverage_ledger(spark, d) -> DataFrame:
    turns = table(spark, d, "conversations")
    spans = turns.where("turn % 3 <> 2").select("conv_id", F.col("turn").alias("a"), (F.col("turn") + F.when(F.col("role") == "user", 1).otherwise(0)).alias("b"))
    return intervals.coverage(spans, turns.select("conv_id", "turn"), ["conv_id"], "a", "b", "turn")


@query("""WITH o AS (SELECT o_orderkey, o_orderdate AS t, strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders),
  m AS (SELECT o_orderkey, 1 AS ordinal, strftime(t, '%Y/%-m/%-d') AS mention, dt AS date, '' AS timestamp, 'day' AS precision, 5 AS start FROM o
    UNION ALL SELECT o_orderkey, 2, dt || ' 08:05', dt, dt || 'T08:05', 'minute', 5 + length(strftime(t, '%Y/%-m/%-d')) + 27 FROM o)
  SELECT o_orderkey, CAST(ordinal AS BIGINT) AS ordinal, mention, date, timestamp, precision, CAST(start AS INTEGER) AS char_start, CAST(start + length(mention) AS INTEGER) AS char_end FROM m""")
def q20_date_mentions(spark, d) -> DataFrame:
    day = F.col("o_orderdate")
    written = F.concat(F.lit("seen "), F.date_format(day, "yyyy/M/d"), F.lit(", never 2024-02-31; signed "), F.date_format(day, "yyyy-MM-dd"), F.lit(" 08:05."))
    return dates.date_mentions(table(spark, d, "orders").select("o_orderkey", written.alias("text")), "o_orderkey")


@query("""WITH c AS (SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS p, strftime(l_shipdate, '%Y-%m-%d') AS day FROM lineitem),
  t AS (SELECT c.* FROM c JOIN (SELECT l_orderkey, min(p) AS p FROM c GROUP BY 1) b USING (l_orderkey, p))
  SELECT l_orderkey, CASE WHEN count(DISTINCT day) = 1 THEN min(day) ELSE '' END AS date, CASE WHEN count(DISTINCT day) = 1 THEN 'known' ELSE 'conflicting_dates' END AS date_status,
  count(*) AS n_candidates FROM t GROUP BY l_orderkey""")
def q21_section_dates(spark, d) -> DataFrame:
    flag = F.col("l_returnflag")
    c = table(spark, d, "lineitem").select("l_orderkey", F.when(flag == "R", 0).when(flag == "A", 1).otherwise(2).alias("p"), _day("l_shipdate").alias("day"))
    return timeline.section_date(c, ["l_orderkey"], "p", "day")


@query("SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS next_start FROM conversations WHERE role = 'user'")
def q22_section_ranges(spark, d) -> DataFrame:
    return timeline.section_ranges(table(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn"), "conv_id", "turn")


@query("""SELECT doc_id, CASE WHEN length(t) <= 60 AND regexp_matches(t, '(?i)rights|licen[cs]e') THEN 'administrative' WHEN length(t) <= 60 AND regexp_matches(t, '[0-9]') THEN 'laboratory'
  WHEN length(t) <= 60 AND regexp_matches(t, '^(The|Der|Le|El) ') THEN 'progress' ELSE 'unknown' END AS section_type FROM (SELECT doc_id, string_split(text, chr(10))[1] AS t FROM documents)""")
def q23_title_classify(spark, d) -> DataFrame:
    rules = [("administrative", "(?i)rights|licen[cs]e"), ("laboratory", "[0-9]"), ("progress", "^(The|Der|Le|El) ")]
    return table(spark, d, "documents").select("doc_id", text.title_type(F.split("text", "\n")[0], rules, 60).alias("section_type"))


@query("""WITH t AS (SELECT doc_id, length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS n, length(text) - length(replace(text, chr(65533), '')) AS b, regexp_matches(text, '[㐀-䶿一-鿿]') AS cjk FROM documents),
  f AS (SELECT *, b >= 3 AND b >= 0.02 * greatest(n, 1) AS bad FROM t)
  SELECT doc_id, CASE WHEN n = 0 THEN 'text_layer_unusable' WHEN bad OR n < 40 THEN 'partial' ELSE 'ok' END AS status,
    array_to_string(list_filter([CASE WHEN n = 0 THEN 'empty_text' END, CASE WHEN n = 0 THEN 'text_layer_missing' END, CASE WHEN n BETWEEN 1 AND 39 THEN 'suspiciously_tiny_text' END,
      CASE WHEN n > 0 AND NOT cjk THEN 'no_cjk_text' END, CASE WHEN bad THEN 'possible_encoding_issue' END], lambda x: x IS NOT NULL), '|') AS flags FROM f""")
def q24_quality_classify(spark, d) -> DataFrame:
    q = quality.page_quality(F.col("text"), paints=F.lit(1))
    return table(spark, d, "documents").select("doc_id", q.alias("q")).select("doc_id", "q.status", F.concat_ws("|", "q.flags").alias("flags"))


_RULES = [Rule("rights", "legal", "All rights reserved", "decisive"), Rule("symbols", "noise", "[#$%&*]{3,}"), Rule("capital", "shout", "[A-Z]{6,}", "context")]


def _spans_sql(rule: Rule) -> str:
    return f"""SELECT doc_id, '{rule.rule_id}' AS rule_id, '{rule.category}' AS category, '{rule.strength}' AS strength, m[i] AS span_text,
      CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS INTEGER) AS char_start
      FROM (SELECT doc_id, m, g, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{rule.pattern}') AS m, string_split_regex(text, '{rule.pattern}') AS g FROM documents))"""


@query("SELECT *, char_start + CAST(length(span_text) AS INTEGER) AS char_end FROM (" + " UNION ALL ".join(map(_spans_sql, _RULES)) + ")")
def q25_span_extract(spark, d) -> DataFrame:
    return rules.spans(table(spark, d, "documents"), "doc_id", _RULES)


@query("""SELECT l_orderkey, l_linenumber, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS o FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS k FROM lineitem) WHERE k <= 2) WHERE o <= 5""")
def q26_rule_topk(spark, d) -> DataFrame:
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_extendedprice")
    return evidence.nested_top_k(line, ["l_suppkey", "l_returnflag"], ["l_suppkey"], order, 2, 5).select("l_orderkey", "l_linenumber", "l_suppkey")


@query("""SELECT l_partkey, l_returnflag, l_orderkey, l_linenumber, n_merged FROM (SELECT l_partkey, l_returnflag, l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_partkey, l_returnflag) AS n_merged,
  row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END, l_orderkey, l_linenumber) AS k FROM lineitem) WHERE k = 1""")
def q27_evidence_dedupe(spark, d) -> DataFrame:
    rank = [F.when(F.col("l_linestatus") == "F", 0).otherwise(1), F.col("l_orderkey"), F.col("l_linenumber")]
    return evidence.best(table(spark, d, "lineitem"), ["l_partkey", "l_returnflag"], rank, ["l_orderkey", "l_linenumber"])


@query("""WITH r AS (SELECT l_suppkey, l_orderkey * 10 AS a, l_orderkey * 10 + CAST(l_quantity AS BIGINT) AS b FROM lineitem),
  m AS (SELECT *, max(b) OVER (PARTITION BY l_suppkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r),
  i AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM m)
  SELECT l_suppkey, CAST(island AS BIGINT) AS island, min(a) AS a, max(b) AS b, count(*) AS n_members FROM i GROUP BY ALL""")
def q28_interval_merge(spark, d) -> DataFrame:
    a = F.col("l_orderkey") * 10
    rows = table(spark, d, "lineitem").select("l_suppkey", a.alias("a"), (a + F.col("l_quantity").cast("long")).alias("b"))
    return intervals.merge(rows, ["l_suppkey"], "a", "b")


@query("""WITH e AS (SELECT user_id, event_type = 'purchase' AS formal, CAST(ts AS DATE) AS day FROM events WHERE event_type IN ('purchase', 'signup')),
  f AS (SELECT user_id, day AS anchor_day, count(*) AS n_formal FROM e WHERE formal GROUP BY ALL), o AS (SELECT user_id, day, count(*) AS n FROM e WHERE NOT formal GROUP BY ALL),
  p AS (SELECT o.user_id, o.day, o.n, arg_min(f.anchor_day, abs(f.anchor_day - o.day) * 100000 + (f.anchor_day - DATE '2000-01-01')) AS near FROM o LEFT JOIN f USING (user_id) GROUP BY ALL),
  a AS (SELECT user_id, CASE WHEN near IS NULL OR abs(near - day) > 2 THEN day ELSE near END AS anchor_day, sum(n) AS n_attached FROM p GROUP BY ALL)
  SELECT user_id, strftime(anchor_day, '%Y-%m-%d') AS anchor_day, coalesce(n_formal, 0) AS n_formal, CAST(coalesce(n_attached, 0) AS BIGINT) AS n_attached, coalesce(n_formal, 0) = 0 AS historical
  FROM f FULL JOIN a USING (user_id, anchor_day)""")
def q29_surgery_events(spark, d) -> DataFrame:
    rows = table(spark, d, "events").where("event_type in ('purchase', 'signup')").select("user_id", "event_type", F.to_date("ts").alias("day"))
    return evidence.events(rows, "user_id", "event_type", "day", "purchase", 2).withColumn("anchor_day", F.date_format("anchor_day", "yyyy-MM-dd"))


_LADDER = [("purchase", "surgery"), ("view", "conservative"), ("signup", "intended_surgery"), ("error", "cancelled")]


@query("""SELECT user_id, count(*) FILTER (event_type = 'purchase') AS n_purchase, count(*) FILTER (event_type = 'view') AS n_view, count(*) FILTER (event_type = 'signup') AS n_signup,
  count(*) FILTER (event_type = 'error') AS n_error, CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 'surgery' WHEN count(*) FILTER (event_type = 'view') > 0 THEN 'conservative'
  WHEN count(*) FILTER (event_type = 'signup') > 0 THEN 'intended_surgery' WHEN count(*) FILTER (event_type = 'error') > 0 THEN 'cancelled' ELSE 'unknown' END AS management,
  CASE WHEN count(*) FILTER (event_type = 'purchase') = 0 THEN 'none' WHEN count(*) FILTER (event_type = 'error') > 0 THEN 'minimum' ELSE 'exact' END AS event_count_status FROM events WHERE value > 60 GROUP BY user_id""")
def q30_patient_summary(spark, d) -> DataFrame:
    out = evidence.precedence(table(spark, d, "events").where("value > 60"), "user_id", "event_type", _LADDER, "unknown", "management")
    return out.withColumn("event_count_status", F.when(F.col("n_purchase") == 0, "none").when(F.col("n_error") > 0, "minimum").otherwise("exact"))


@query("""WITH e AS (SELECT user_id, event_type, CASE WHEN value < 20 THEN strftime(ts, '%Y-%m') ELSE strftime(ts, '%Y-%m-%d') END AS day, event_id FROM events WHERE event_type IN ('view', 'signup')),
  p AS (SELECT v.event_id, v.user_id, bool_and(CASE WHEN substr(v.day, 1, 7) <> substr(s.day, 1, 7) THEN v.day > s.day WHEN length(v.day) = 10 AND length(s.day) = 10 AND v.day <> s.day THEN v.day > s.day
      WHEN length(v.day) <> length(s.day) THEN FALSE ELSE v.event_id >= s.event_id END) AS ok
    FROM e v LEFT JOIN e s ON s.user_id = v.user_id AND s.event_type = 'signup' WHERE v.event_type = 'view' GROUP BY ALL)
  SELECT u.user_id, coalesce(bool_or(coalesce(ok, TRUE)) FILTER (p.user_id IS NOT NULL), FALSE) AS holds FROM (SELECT DISTINCT user_id FROM e) u LEFT JOIN p USING (user_id) GROUP BY u.user_id""")
def q31_chronology(spark, d) -> DataFrame:
    day = F.when(F.col("value") < 20, F.date_format("ts", "yyyy-MM")).otherwise(_day("ts"))
    rows = table(spark, d, "events").where("event_type in ('view', 'signup')").select("user_id", "event_type", day.alias("day"), "event_id")
    return evidence.after_all(rows, "user_id", "event_type", "day", "event_id", "view", "signup")


@query("""WITH l AS (SELECT l_orderkey AS doc, l_linenumber // 3 AS sect, CAST(l_shipdate AS DATE) AS day, l_returnflag = 'N' AS sub FROM lineitem)
  SELECT doc, sect, day, count(*) AS n_rows, CAST(max((SELECT count(*) FROM l b WHERE b.doc = a.doc AND (b.sect = a.sect OR (b.day = a.day AND b.sub)))) AS BIGINT) AS n_peers FROM l a GROUP BY ALL""")
def q32_context_peers(spark, d) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.floor(F.col("l_linenumber") / 3).alias("sect"), F.to_date("l_shipdate").alias("day"), "l_returnflag")
    return evidence.peers(rows, "doc", "sect", "day", F.col("l_returnflag") == "N")


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS n_origins FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1")
def q33_origin_conflict(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").where("l_returnflag <> 'N'").groupBy("l_partkey").agg(F.count_distinct("l_suppkey").alias("n_origins")).where("n_origins > 1")


_RELEVANCE = """SELECT doc_id, CASE WHEN pos AND clin THEN 'yes' WHEN pos THEN 'uncertain' WHEN clin AND n_chars >= 1000 THEN 'no' ELSE 'uncertain' END AS judgment,
  array_to_string(list_filter([CASE WHEN pos THEN 'positive' END, CASE WHEN NOT clin THEN 'other_context' END, CASE WHEN n_chars < 1000 THEN 'little_text' END, CASE WHEN toxic = 1 THEN 'flagged' END], lambda x: x IS NOT NULL), '|') AS reasons
  FROM (SELECT doc_id, n_chars, coalesce(quality = 1, FALSE) AS pos, lang = 'en' AS clin, toxic FROM documents LEFT JOIN labels USING (doc_id))"""


def _relevance(spark, d) -> DataFrame:
    both = table(spark, d, "documents").select("doc_id", "lang", "n_chars").join(table(spark, d, "labels"), "doc_id", "left")
    pos, clinical, chars = F.coalesce(F.col("quality") == 1, F.lit(False)), F.col("lang") == "en", F.col("n_chars")
    why = review.reasons([("positive", pos), ("other_context", ~clinical), ("little_text", chars < 1000), ("flagged", F.col("toxic") == 1)])
    return review.judge(both, pos, clinical, chars, 1000).select("doc_id", "judgment", F.concat_ws("|", why).alias("reasons"))


@query(_RELEVANCE)
def q34_relevance_judgment(spark, d) -> DataFrame:
    return _relevance(spark, d)


@query(f"""SELECT doc_id, judgment, CASE WHEN reasons LIKE '%flagged%' THEN 'required' WHEN judgment = 'no' THEN 'high' ELSE 'medium' END AS priority FROM ({_RELEVANCE}) WHERE judgment <> 'yes'""")
def q35_exception_queue(spark, d) -> DataFrame:
    priority = F.when(F.col("reasons").contains("flagged"), "required").when(F.col("judgment") == "no", "high").otherwise("medium")
    queue = _relevance(spark, d).where("judgment <> 'yes'").select("doc_id", "judgment", priority.alias("priority"))
    return queue.orderBy(F.when(F.col("priority") == "required", 0).when(F.col("priority") == "high", 1).otherwise(2), "doc_id")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def q36_followup_latest(spark, d) -> DataFrame:
    latest = F.max(F.struct("ts", "event_id", "event_type")).alias("x")
    return table(spark, d, "events").groupBy("user_id").agg(latest).select("user_id", "x.event_id", "x.event_type")


@query("""WITH l AS (SELECT user_id, max(ts) FILTER (event_type = 'purchase') AS p, max(ts) FILTER (event_type = 'signup') AS s, max(ts) FILTER (event_type = 'error') AS e FROM events GROUP BY user_id)
  SELECT user_id, CASE WHEN p IS NOT NULL AND (e IS NULL OR p >= e) THEN 'completed' WHEN e IS NOT NULL AND (s IS NULL OR e >= s) THEN 'cancelled' WHEN s IS NOT NULL THEN 'pending' ELSE 'none' END AS decision_path FROM l""")
def q37_followup_path(spark, d) -> DataFrame:
    last = {k: F.max(F.when(F.col("event_type") == k, F.col("ts"))).alias(k) for k in ("purchase", "signup", "error")}
    p, s, e = F.col("purchase"), F.col("signup"), F.col("error")
    path = F.when(p.isNotNull() & (e.isNull() | (p >= e)), "completed").when(e.isNotNull() & (s.isNull() | (e >= s)), "cancelled").when(s.isNotNull(), "pending").otherwise("none")
    return table(spark, d, "events").groupBy("user_id").agg(*last.values()).select("user_id", path.alias("decision_path"))


@query("""WITH e AS (SELECT event_id, user_id, event_type, epoch_us(ts) // 1000000 AS s FROM events) SELECT a.event_id, a.user_id, CAST(min(abs(a.s - b.s)) AS BIGINT) AS gap FROM e a JOIN e b ON a.user_id = b.user_id
  AND b.event_type = 'signup' AND abs(a.s - b.s) <= 7200 WHERE a.event_type = 'purchase' GROUP BY ALL""")
def q38_proximity(spark, d) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", "user_id", "event_type", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"))
    return evidence.near(rows, ["user_id"], "s", F.col("event_type") == "signup", F.col("event_type") == "purchase", 7200).select("event_id", "user_id", "gap")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT' OR o_totalprice > 200000")
def q39_llm_selection(spark, d) -> DataFrame:
    flagged = (F.col("o_orderpriority") == "1-URGENT") | (F.col("o_totalprice") > 200000)
    return review.select(table(spark, d, "orders"), "review_required", "o_orderstatus", flagged, F.lit(False)).select("o_orderkey", "o_orderstatus")


@query("""WITH RECURSIVE x AS (SELECT conv_id, length(text) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
  f AS (SELECT conv_id, k, CASE WHEN n <= 600 THEN 1 ELSE 0 END AS taken, CASE WHEN n <= 600 THEN n ELSE 0 END AS chars FROM x WHERE k = 1
    UNION ALL SELECT x.conv_id, x.k, taken + CASE WHEN chars + n <= 600 THEN 1 ELSE 0 END, chars + CASE WHEN chars + n <= 600 THEN n ELSE 0 END FROM f JOIN x ON x.conv_id = f.conv_id AND x.k = f.k + 1)
  SELECT conv_id, CAST(max(taken) AS INTEGER) AS n_taken, CAST(max(chars) AS INTEGER) AS chars FROM f GROUP BY conv_id""")
def q40_passage_budget(spark, d) -> DataFrame:
    return review.budget(table(spark, d, "conversations"), ["conv_id"], "turn", "text", 600)


@query("""SELECT doc_id, CASE WHEN n_chars >= 300 THEN 1 ELSE 0 END AS ours, quality, CASE WHEN quality IS NULL THEN 'no_response' WHEN quality = CASE WHEN n_chars >= 300 THEN 1 ELSE 0 END THEN 'agree' ELSE 'disagree' END AS agreement
  FROM documents LEFT JOIN labels USING (doc_id)""")
def q41_hybrid(spark, d) -> DataFrame:
    ours = table(spark, d, "documents").select("doc_id", F.when(F.col("n_chars") >= 300, 1).otherwise(0).alias("ours"))
    return review.reconcile(ours, table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "ours", "quality")


@query("""SELECT user_id, CAST(score AS BIGINT) AS score, CASE WHEN score = 0 THEN 'insufficient_documentation' WHEN p > 0 AND e = 0 THEN 'rules_sufficient' ELSE 'needs_llm' END AS route FROM (
  SELECT user_id, count(*) FILTER (event_type = 'purchase') AS p, count(*) FILTER (event_type = 'error') AS e, 3 * count(*) FILTER (event_type = 'purchase') + count(*) FILTER (event_type = 'signup') AS score FROM events WHERE value > 80 GROUP BY user_id)""")
def q42_routing(spark, d) -> DataFrame:
    kind = F.col("event_type")
    per = table(spark, d, "events").where("value > 80").groupBy("user_id").agg(F.count_if(kind == "purchase").alias("p"), F.count_if(kind == "error").alias("e"), F.count_if(kind == "signup").alias("s"))
    per = per.withColumn("score", 3 * F.col("p") + F.col("s"))
    return per.select("user_id", "score", F.when(F.col("score") == 0, "insufficient_documentation").when((F.col("p") > 0) & (F.col("e") == 0), "rules_sufficient").otherwise("needs_llm").alias("route"))


@query("""WITH b AS (SELECT lang, source, n_chars >= 300 AS said, quality = 1 AS truth FROM documents JOIN labels USING (doc_id)),
  g AS (SELECT 'all' AS kind, 'all' AS value, * FROM b UNION ALL SELECT 'lang', lang, * FROM b UNION ALL SELECT 'source', source, * FROM b),
  c AS (SELECT kind, value, count(*) FILTER (said AND truth) AS tp, count(*) FILTER (said AND NOT truth) AS fp, count(*) FILTER (NOT said AND truth) AS fn FROM g GROUP BY ALL)
  SELECT kind, value, tp, fp, fn, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM c""")
def q43_gold_metrics(spark, d) -> DataFrame:
    both = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, d, "labels"), "doc_id")
    return gold.scores(both, F.col("n_chars") >= 300, F.col("quality") == 1, ["lang", "source"])


@query("SELECT p_partkey, levenshtein(p_brand, p_type) AS distance FROM part")
def q44_edit_distance(spark, d) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.levenshtein("p_brand", "p_type").cast("long").alias("distance"))


_TOKENS = "SELECT {0}, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: x <> '')) AS token FROM {1}"


@query(f"""WITH a AS (SELECT conv_id, token, count(*) AS n FROM ({_TOKENS.format('conv_id', "conversations WHERE role = 'assistant'")}) GROUP BY ALL),
  b AS (SELECT conv_id, token, count(*) AS n FROM ({_TOKENS.format('conv_id', "conversations WHERE role = 'user'")}) GROUP BY ALL)
  SELECT conv_id, CAST(sum(least(b.n, coalesce(a.n, 0))) AS BIGINT) AS hits, CAST(sum(b.n) AS BIGINT) AS wanted FROM b LEFT JOIN a USING (conv_id, token) GROUP BY conv_id""")
def q45_multiset_recall(spark, d) -> DataFrame:
    turns = table(spark, d, "conversations")
    tokens = turns.select("conv_id", "role", F.explode(F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda x: x != "")).alias("token"))
    return gold.multiset_recall(turns, "conv_id", tokens.where("role = 'assistant'"), tokens.where("role = 'user'"), "token")


@query("""SELECT doc_id, array_to_string(list_filter(['lang:' || lang, CASE WHEN n_chars < 300 THEN 'short' END, CASE WHEN n_chars > 5000 THEN 'long' END, CASE WHEN contains(text, 'rights reserved') THEN 'legal' END], lambda x: x IS NOT NULL), '|') AS tags FROM documents""")
def q46_stratified_sample_candidates(spark, d) -> DataFrame:
    tags = F.array_compact(F.array(F.concat(F.lit("lang:"), "lang"), F.when(F.col("n_chars") < 300, "short"), F.when(F.col("n_chars") > 5000, "long"), F.when(F.col("text").contains("rights reserved"), "legal")))
    return table(spark, d, "documents").select("doc_id", F.concat_ws("|", tags).alias("tags"))


@query("""SELECT doc_id, 'resolved' AS change FROM (SELECT doc_id FROM labels WHERE quality = 0 EXCEPT ALL SELECT doc_id FROM labels WHERE toxic = 1)
  UNION ALL SELECT doc_id, 'new' FROM (SELECT doc_id FROM labels WHERE toxic = 1 EXCEPT ALL SELECT doc_id FROM labels WHERE quality = 0)""")
def q47_new_resolved_failures(spark, d) -> DataFrame:
    labels = table(spark, d, "labels")
    return gold.compare(labels.where("quality = 0").select("doc_id"), labels.where("toxic = 1").select("doc_id"))


@query("SELECT c_custkey, 'p_' || substr(sha256(CAST(c_custkey AS VARCHAR) || chr(31) || c_name), 1, 16) AS patient_id FROM customer")
def q48_stable_ids(spark, d) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", ids.stable_id("p_", 16, "c_custkey", "c_name").alias("patient_id"))


@query("""SELECT doc_id, CAST(instr(lower(text), 'the') - 1 AS BIGINT) AS place, CAST((length(text) - length(replace(lower(text), 'the', ''))) // 3 AS BIGINT) AS n_hits FROM documents WHERE contains(lower(text), 'the') ORDER BY doc_id LIMIT 100 OFFSET 20""")
def q49_search_sections(spark, d) -> DataFrame:
    return explorer.search(table(spark, d, "documents"), "doc_id", "text", "the", 20, 100)


@query("""WITH c AS (SELECT c_custkey, c_mktsegment || '/' || CAST(c_nationkey AS VARCHAR) || '/' || CAST(c_custkey // 4 AS VARCHAR) AS name FROM customer),
  r AS (SELECT o_orderkey, 'name' AS method, name AS value FROM orders JOIN c ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey, 'number', CAST(o_custkey + k AS VARCHAR) FROM orders, (VALUES (0), (1)) t(k) WHERE o_orderpriority < '4' AND (k = 0 OR o_totalprice > 100000)),
  i AS (SELECT 'name' AS method, name AS value, c_custkey AS candidate FROM c UNION ALL SELECT 'number', CAST(c_custkey AS VARCHAR), c_custkey FROM c),
  e AS (SELECT DISTINCT o_orderkey, method, candidate FROM r JOIN i USING (method, value)), n AS (SELECT o_orderkey, count(DISTINCT method) AS m FROM e GROUP BY 1),
  g AS (SELECT o_orderkey, count(*) AS k, min(candidate) AS one FROM (SELECT o_orderkey, candidate, count(*) AS x FROM e GROUP BY ALL) JOIN n USING (o_orderkey) WHERE x = m GROUP BY 1)
  SELECT o.o_orderkey, CAST(coalesce(m, 0) AS BIGINT) AS n_methods, CAST(coalesce(k, 0) AS BIGINT) AS n_candidates, CASE WHEN m IS NULL THEN 'unmatched' WHEN k = 1 THEN 'matched' ELSE 'ambiguous' END AS match_status,
    CASE WHEN k = 1 THEN one END AS matched FROM orders o LEFT JOIN n USING (o_orderkey) LEFT JOIN g USING (o_orderkey)""")
def q50_match_resolution(spark, d) -> DataFrame:
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    named = customer.select("c_custkey", F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string"), F.floor(F.col("c_custkey") / 4).cast("string")).alias("name"))
    by_name = orders.where("o_orderstatus <> 'P'").join(named, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.lit("name").alias("method"), F.col("name").alias("value"))
    numbers = F.when(F.col("o_totalprice") > 100000, F.array(F.col("o_custkey"), F.col("o_custkey") + 1)).otherwise(F.array("o_custkey"))
    by_number = orders.where("o_orderpriority < '4'").select("o_orderkey", F.lit("number").alias("method"), F.explode(numbers.cast("array<string>")).alias("value"))
    index = named.select(F.lit("name").alias("method"), F.col("name").alias("value"), F.col("c_custkey").alias("candidate")).unionByName(named.select(F.lit("number").alias("method"), F.col("c_custkey").cast("string").alias("value"), F.col("c_custkey").alias("candidate")))
    found = by_name.unionByName(by_number).join(index, ["method", "value"]).select("o_orderkey", "method", "candidate").distinct()
    return identity.resolve_matches(found, orders, "o_orderkey")


@query("""SELECT l_returnflag, quantile_cont(l_quantity, 0.5) AS median_quantity, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS weighted_discount, count(*) AS n FROM lineitem GROUP BY l_returnflag""")
def q51_benchmark_median(spark, d) -> DataFrame:
    weighted = F.round(F.sum(F.col("l_discount") * F.col("l_quantity")) / F.sum("l_quantity"), 6)
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.percentile("l_quantity", F.lit(0.5)).alias("median_quantity"), weighted.alias("weighted_discount"), F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, substr(text, 501, 500) AS body, length(text) > 1000 AS more FROM documents WHERE length(text) > 500")
def q52_section_page(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").where(F.length("text") > 500)
    return docs.select("doc_id", text.page(F.col("text"), 2, 500).alias("body"), (F.length("text") > 1000).alias("more"))


@query("""SELECT doc_id, len(m) AS n_tokens, coalesce(list_sum(list_transform(m, lambda x: length(x))), 0) AS n_chars FROM (SELECT doc_id, regexp_extract_all(text, '[0-9]+(?:[./:-][0-9]+)*') AS m FROM documents)""")
def q53_numeric_tokens(spark, d) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(gold.NUMBER), F.lit(0))
    total = F.aggregate("m", F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    return table(spark, d, "documents").select("doc_id", found.alias("m")).select("doc_id", F.size("m").cast("long").alias("n_tokens"), total.alias("n_chars"))


@query("""WITH s AS (SELECT conv_id, turn * 100 AS a, turn * 100 + length(text) AS b FROM conversations), m AS (SELECT *, max(b) OVER (PARTITION BY conv_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM s),
  i AS (SELECT *, sum(CASE WHEN r IS NULL OR a > r THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM m) SELECT conv_id, min(a) AS a, max(b) AS b FROM i GROUP BY conv_id, k""")
def q54_passage_merge(spark, d) -> DataFrame:
    a = (F.col("turn") * 100).cast("int")
    per = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct(a.alias("a"), (a + F.length("text")).alias("b"))).alias("s"))
    return per.select("conv_id", F.explode(casework.merged(F.col("s"))).alias("x")).select("conv_id", F.col("x.a").cast("long").alias("a"), F.col("x.b").cast("long").alias("b"))
