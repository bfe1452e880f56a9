"""Relational building blocks (P1-P17, F1-F4, F7-F11, F18-F20, F24-F25, F35,
G3, G4, G7, G8, G15, G17, G37, J5, J8, J11, J12, J14, L1, L4, L5, W5, W6,
U1, U2, U4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnstile.functions import scalars as S
from turnstile.functions import text as X
from turnstile.operators import aggregates as A
from turnstile.operators import sets as U
from turnstile.operators.joins import lookup, maybe_broadcast
from turnstile.operators.ordered import global_row_number
from turnstile.plans.registry import register
from turnstile.plans.sqlbind import VISITS, with_ctes
from turnstile.sources.tables import documents, table, visits, waits


def _t(spark, sf_dir, name):
    return table(spark, sf_dir, name)


# ------------------------------------------------------------------ projections / filters

@register("project_rename", """SELECT l_orderkey, l_quantity AS qty, l_discount AS disc,
  'Park A' AS park_type FROM lineitem""")
def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 (rename map with an absent key), P2, P3 (tolerant drop), P13."""
    li = _t(spark, sf_dir, "lineitem")
    r = li.withColumnsRenamed({"l_quantity": "qty", "l_discount": "disc", "not_a_column": "x"})
    r = r.select("l_orderkey", "qty", "disc", "l_linenumber").drop("l_linenumber", "also_absent")
    return r.withColumn("park_type", F.lit("Park A"))


@register("filter_predicates", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_quantity <> 0 AND l_discount <> 0 AND l_returnflag IN ('A', 'R')
  AND l_shipdate >= TIMESTAMP '1996-01-01'""")
def filter_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 + P12: conjunctive comparison and membership filters (pushed to
    the parquet scan)."""
    li = _t(spark, sf_dir, "lineitem")
    return li.where((F.col("l_quantity") != 0) & (F.col("l_discount") != 0)
                    & F.col("l_returnflag").isin("A", "R")
                    & (F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))) \
        .select("l_orderkey", "l_linenumber", "l_quantity")


@register("regex_filter", r"""SELECT p_partkey, p_brand FROM part
WHERE regexp_full_match(p_brand, 'Brand#1\d') AND regexp_matches(p_name, '^(red|blue) ')""")
def regex_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: anchored regular expressions."""
    p = _t(spark, sf_dir, "part")
    return p.where(F.col("p_brand").rlike(r"^Brand#1\d$") & F.col("p_name").rlike(r"^(red|blue) ")) \
        .select("p_partkey", "p_brand")


@register("split_by_flag", """SELECT count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
  count(*) FILTER (WHERE coalesce(l_returnflag <> 'R', true)) AS n_kept,
  round(avg(l_extendedprice) FILTER (WHERE l_returnflag = 'R'), 6) AS avg_price_returned,
  round(avg(l_extendedprice) FILTER (WHERE coalesce(l_returnflag <> 'R', true)), 6) AS avg_price_kept
FROM lineitem""")
def split_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves of a boolean split in one conditional aggregate."""
    li = _t(spark, sf_dir, "lineitem")
    flag = F.coalesce(F.col("l_returnflag") == "R", F.lit(False))
    return li.agg(F.count(F.when(flag, 1)).alias("n_returned"), F.count(F.when(~flag, 1)).alias("n_kept"),
                  F.round(F.avg(F.when(flag, F.col("l_extendedprice"))), 6).alias("avg_price_returned"),
                  F.round(F.avg(F.when(~flag, F.col("l_extendedprice"))), 6).alias("avg_price_kept"))


@register("head_n", """SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rnk
FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10""")
def head_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First n rows in an explicit order (TakeOrderedAndProject)."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    top = o.orderBy("o_orderdate", "o_orderkey").limit(10)
    return top.withColumn("rnk", F.row_number().over(Window.orderBy("o_orderdate", "o_orderkey")).cast("long"))


# ------------------------------------------------------------------ scalar functions

@register("string_functions", r"""SELECT c_custkey,
  lower(regexp_replace(c_name, '^\s+|\s+$', '', 'g')) AS name_lower,
  c_name || ' ' || c_mktsegment AS label,
  split_part(c_name, '#', 2) AS name_num,
  (c_mktsegment = 'BUILDING') AS is_building,
  coalesce(regexp_replace(c_name, '^\s+|\s+$', '', 'g') IN ('', 'NIL', 'Nil', 'NA'), true) AS is_noise
FROM customer""")
def string_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, F2, F4, F9."""
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", F.lower(S.strip_all("c_name")).alias("name_lower"),
                    F.concat("c_name", F.lit(" "), "c_mktsegment").alias("label"),
                    F.split("c_name", "#").getItem(1).alias("name_num"),
                    (F.col("c_mktsegment") == "BUILDING").alias("is_building"),
                    S.noise_text("c_name").alias("is_noise"))


_PRIORITY_MAP = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unknown"}


@register("value_rewrite", """SELECT o_orderkey,
  CASE WHEN o_orderpriority IN ('5-LOW') THEN 'Unknown'
       ELSE coalesce(CASE o_orderpriority """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _PRIORITY_MAP.items())
          + """ END, o_orderpriority) END AS priority,
  replace(o_orderpriority, '-', ' ') AS priority_text
FROM orders""")
def value_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 (literal replace) + F8 (invalid answer to default, then name map)."""
    o = _t(spark, sf_dir, "orders")
    p = F.col("o_orderpriority")
    std = F.when(p.isin("5-LOW"), "Unknown").otherwise(S.map_values(p, _PRIORITY_MAP, keep_unmapped=True))
    return o.select("o_orderkey", std.alias("priority"),
                    F.replace(p, F.lit("-"), F.lit(" ")).alias("priority_text"))


@register("math_functions", """SELECT l_orderkey, l_linenumber, round_even(l_quantity / 4, 0) AS q_bround,
  CAST(floor(l_extendedprice / 100) AS BIGINT) AS price_floor, CAST(ceil(l_extendedprice / 100) AS BIGINT) AS price_ceil,
  round(abs(l_discount - 0.05), 6) AS disc_dev, round(sqrt(l_quantity), 6) AS qty_sqrt
FROM lineitem""")
def math_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """half-even round, floor, ceil, abs, sqrt."""
    li = _t(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.bround(F.col("l_quantity") / 4, 0).alias("q_bround"),
                     F.floor(F.col("l_extendedprice") / 100).cast("long").alias("price_floor"),
                     F.ceil(F.col("l_extendedprice") / 100).cast("long").alias("price_ceil"),
                     F.round(F.abs(F.col("l_discount") - 0.05), 6).alias("disc_dev"),
                     F.round(F.sqrt("l_quantity"), 6).alias("qty_sqrt"))


# Minutes of each wait answer; any other answer is 37.5.
WAIT_MIDPOINTS = {
    "Less than 15 minutes": 10.0,
    "15 to 30 minutes": 22.5,
    "31 to 45 minutes": 37.5,
    "46 to 60 minutes": 52.5,
    "61 to 90 minutes": 75.0,
    "More than 90 minutes": 100.0,
}


@register("ordinal_map", with_ctes("""b AS (SELECT event_id, wait, CASE WHEN wait IS NULL THEN NULL
    WHEN wait < 15 THEN 'Less than 15 minutes' WHEN wait < 31 THEN '15 to 30 minutes'
    WHEN wait < 46 THEN '31 to 45 minutes' WHEN wait < 61 THEN '46 to 60 minutes'
    WHEN wait <= 90 THEN '61 to 90 minutes' ELSE 'More than 90 minutes' END AS bucket FROM visits)
SELECT event_id, bucket, CAST(CASE WHEN wait < 15 THEN 10 WHEN wait < 31 THEN 22.5 WHEN wait < 46 THEN 37.5
    WHEN wait < 61 THEN 52.5 WHEN wait <= 90 THEN 75 WHEN wait > 90 THEN 100 ELSE 37.5 END AS DOUBLE) AS midpoint FROM b""", VISITS))
def ordinal_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """answer label -> minutes with a default."""
    w = F.col("wait")
    bucket = (F.when(w < 15, "Less than 15 minutes").when(w < 31, "15 to 30 minutes")
              .when(w < 46, "31 to 45 minutes").when(w < 61, "46 to 60 minutes")
              .when(w <= 90, "61 to 90 minutes").when(w > 90, "More than 90 minutes"))
    v = visits(spark, sf_dir).select("event_id", bucket.alias("bucket"))
    return v.withColumn("midpoint", S.map_values("bucket", WAIT_MIDPOINTS, default=37.5))


_NEG_WORDS = [w for w, v in X.LEXICON.items() if v < 0]
_POS_WORDS = [w for w, v in X.LEXICON.items() if v > 0]


def _list_sql(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


@register("array_functions", r"""WITH t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda x: length(x) > 0) AS toks
  FROM documents)
SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens,
  CAST(len(list_filter(toks, lambda x: list_contains(""" + _list_sql(_NEG_WORDS) + r""", x))) AS BIGINT) AS n_negative,
  CAST(len(list_filter(toks, lambda x: list_contains(""" + _list_sql(_POS_WORDS) + r""", x))) AS BIGINT) AS n_positive,
  CASE WHEN len(list_filter(toks, lambda x: list_contains(""" + _list_sql(_NEG_WORDS) + r""", x)))
          > len(list_filter(toks, lambda x: list_contains(""" + _list_sql(_POS_WORDS) + r""", x))) THEN 'Negative'
       WHEN len(list_filter(toks, lambda x: list_contains(""" + _list_sql(_POS_WORDS) + r""", x)))
          > len(list_filter(toks, lambda x: list_contains(""" + _list_sql(_NEG_WORDS) + r""", x))) THEN 'Positive'
       ELSE 'Mixed' END AS doc_type
FROM t""")
def array_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F25 + F24: array length and membership counts of each document's
    token array (arrays built per row, never collected), and the three-way
    label from the two counters."""
    d = documents(spark, sf_dir, "doc_id", "text").select("doc_id", X.tokens("text").alias("toks"))
    neg = F.array(*[F.lit(w) for w in _NEG_WORDS])
    pos = F.array(*[F.lit(w) for w in _POS_WORDS])
    c = d.select("doc_id", F.size("toks").cast("long").alias("n_tokens"),
                 F.size(F.filter("toks", lambda x: F.array_contains(neg, x))).cast("long").alias("n_negative"),
                 F.size(F.filter("toks", lambda x: F.array_contains(pos, x))).cast("long").alias("n_positive"))
    return c.withColumn("doc_type", F.when(F.col("n_negative") > F.col("n_positive"), "Negative")
                        .when(F.col("n_positive") > F.col("n_negative"), "Positive").otherwise("Mixed"))


@register("binary_label", """SELECT CASE WHEN l_linestatus = 'F' THEN 'Severe' ELSE 'Moderate' END AS label,
  count(*) AS n FROM lineitem GROUP BY 1""")
def binary_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """two-way label from a class code."""
    li = _t(spark, sf_dir, "lineitem")
    lab = F.when(F.col("l_linestatus") == "F", "Severe").otherwise("Moderate")
    return li.groupBy(lab.alias("label")).agg(F.count(F.lit(1)).alias("n"))


@register("dirty_dates", """WITH raw AS (
  SELECT o_orderkey, CASE o_orderkey % 4
    WHEN 0 THEN strftime(o_orderdate, '%Y-') || CAST(month(o_orderdate) AS VARCHAR)
    WHEN 1 THEN strftime(o_orderdate, '%b %d, %Y')
    WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
    ELSE 'n/a' END AS raw_date FROM orders)
SELECT o_orderkey, raw_date, coalesce(
  CASE WHEN regexp_full_match(raw_date, '\\d{4}-\\d{1,2}') THEN CAST(try_strptime(raw_date || '-01', '%Y-%m-%d') AS DATE) END,
  CAST(try_strptime(raw_date, '%b %d, %Y') AS DATE),
  CAST(try_strptime(raw_date, '%Y-%m-%d') AS DATE)) AS parsed_date
FROM raw""")
def dirty_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10 + F11 + F19: mixed date text (``yyyy-M``, ``MMM dd, yyyy``, ISO,
    junk) parsed without raising; junk becomes NULL."""
    o = _t(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 4
    raw = (F.when(k == 0, F.concat(F.date_format("o_orderdate", "yyyy-"), F.month("o_orderdate").cast("string")))
           .when(k == 1, F.date_format("o_orderdate", "MMM dd, yyyy"))
           .when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("n/a"))
    r = o.select("o_orderkey", raw.alias("raw_date"))
    return r.withColumn("parsed_date", S.parse_year_month_or_date("raw_date", ["MMM dd, yyyy", "yyyy-MM-dd"]))


# ------------------------------------------------------------------ missing values / duplicates

_DOC_LABELS_SQL = """dl AS (SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def _doc_labels(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return d.join(_t(spark, sf_dir, "labels"), "doc_id", "left")


@register("null_profile", with_ctes("""SELECT count(*) - count(doc_id) AS doc_id, count(*) - count(lang) AS lang,
  count(*) - count(source) AS source, count(*) - count(quality) AS quality, count(*) - count(toxic) AS toxic
FROM dl""", _DOC_LABELS_SQL))
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL count of every column in one aggregate."""
    d = _doc_labels(spark, sf_dir)
    return d.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in d.columns])


@register("drop_or_fill_missing", with_ctes("""SELECT doc_id, coalesce(quality, -1) AS quality,
  coalesce(toxic, -1) AS toxic, quality IS NOT NULL AND toxic IS NOT NULL AS kept_by_dropna FROM dl""",
                                            _DOC_LABELS_SQL))
def drop_or_fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 + P5: the fill policy applied, and the rows the drop policy keeps."""
    d = _doc_labels(spark, sf_dir)
    kept = F.col("quality").isNotNull() & F.col("toxic").isNotNull()
    return d.withColumn("kept_by_dropna", kept).na.fill(-1, subset=["quality", "toxic"]).select(
        "doc_id", "quality", "toxic", "kept_by_dropna")


@register("dedupe_rows", """SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT lang, text FROM documents))
  AS n_distinct, count(*) - (SELECT count(*) FROM (SELECT DISTINCT lang, text FROM documents)) AS n_duplicates
FROM documents""")
def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate count over whole rows (lang, full text).  Rows are keyed
    by (lang, length, SHA-256 of the text) so the shuffle moves fixed-size
    keys instead of whole documents."""
    d = _t(spark, sf_dir, "documents").select("lang", "text")
    n_rows = A.scalar_row(d, F.count(F.lit(1)).alias("n"))["n"]
    keys = d.select("lang", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("h"))
    k = keys.dropDuplicates().agg(F.count(F.lit(1)).alias("n_distinct"))
    return k.select(F.lit(n_rows).cast("long").alias("n_rows"), "n_distinct",
                    (F.lit(n_rows) - F.col("n_distinct")).cast("long").alias("n_duplicates"))


@register("distinct_rows", """SELECT DISTINCT lang, md5(text) AS text_md5 FROM documents""")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: distinct rows of the projection (only the hashes are shuffled)."""
    d = _t(spark, sf_dir, "documents")
    return d.select("lang", F.md5("text").alias("text_md5")).distinct()


# ------------------------------------------------------------------ group aggregates

@register("group_count", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3."""
    return A.drop_null_keys(_t(spark, sf_dir, "orders"), ["o_orderpriority"]) \
        .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@register("group_sum", """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 6) AS sum_qty,
  round(sum(l_extendedprice), 2) AS sum_price FROM lineitem GROUP BY 1, 2""")
def group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4."""
    li = A.drop_null_keys(_t(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 6).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_price"))


@register("distinct_count", """SELECT o_orderstatus, count(DISTINCT o_custkey) AS n_customers
FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1""")
def distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G15 (exact; ``approx_count_distinct`` is the large-scale option)."""
    o = A.drop_null_keys(_t(spark, sf_dir, "orders"), ["o_orderstatus"])
    return o.groupBy("o_orderstatus").agg(F.count_distinct("o_custkey").alias("n_customers"))


@register("group_quantile", with_ctes("""SELECT ride, round(quantile_cont(wait, 0.25), 6) AS q25,
  round(quantile_cont(wait, 0.3), 6) AS q30 FROM visits WHERE ride IS NOT NULL GROUP BY ride""", VISITS))
def group_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact linear quantiles per group."""
    v = A.drop_null_keys(visits(spark, sf_dir), ["ride"])
    q = A.group_quantiles(v, ["ride"], "wait", [0.25, 0.3], ["q25", "q30"])
    return q.select("ride", F.round("q25", 6).alias("q25"), F.round("q30", 6).alias("q30"))


@register("daily_quantiles", """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS total
  FROM orders GROUP BY 1)
SELECT round(quantile_cont(total, 0.25), 4) AS p25, round(quantile_cont(total, 0.75), 4) AS p75, count(*) AS n_days
FROM d""")
def daily_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of a daily total."""
    o = _t(spark, sf_dir, "orders")
    d = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("total"))
    return d.agg(F.round(F.percentile("total", 0.25), 4).alias("p25"),
                 F.round(F.percentile("total", 0.75), 4).alias("p75"), F.count(F.lit(1)).alias("n_days"))


@register("pivot_unique_check", with_ctes("""w AS (SELECT date_trunc('hour', ts) AS slot, ride, count(*) AS n
  FROM visits GROUP BY 1, 2)
SELECT count(*) AS n_cells, count(*) FILTER (WHERE n > 1) AS n_duplicate_cells,
  CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS n_rows_in_duplicates FROM w""", VISITS))
def pivot_unique_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pivot without aggregate needs unique (index, column) keys; this
    reports the cells that would collide (``waits`` resolves them with max)."""
    v = visits(spark, sf_dir)
    w = v.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("slot"), "ride").agg(F.count(F.lit(1)).alias("n"))
    dup = F.col("n") > 1
    return w.agg(F.count(F.lit(1)).alias("n_cells"), F.count(F.when(dup, 1)).alias("n_duplicate_cells"),
                 F.coalesce(F.sum(F.when(dup, F.col("n"))), F.lit(0)).cast("long").alias("n_rows_in_duplicates"))


@register("accuracy", """WITH lexw(word) AS (SELECT * FROM (VALUES """ + ", ".join(
    f"('{w}')" for w, s in X.LEXICON.items() if s < 0) + r""") t(word)),
toks AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS tok FROM documents),
hits AS (SELECT DISTINCT doc_id FROM toks JOIN lexw ON toks.tok = lexw.word),
pred AS (SELECT l.doc_id, l.toxic, CASE WHEN h.doc_id IS NOT NULL THEN 1 ELSE 0 END AS pred
  FROM labels l LEFT JOIN hits h USING (doc_id))
SELECT count(*) AS n, round(avg(CASE WHEN pred = toxic THEN 1 ELSE 0 END), 6) AS accuracy FROM pred""")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule classifier (any negative lexicon word -> toxic) scored
    against the labels."""
    neg = {w: s for w, s in X.LEXICON.items() if s < 0}
    d = documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", (F.size(X.matched_scores("text", neg)) > 0).cast("int").alias("pred"))
    j = _t(spark, sf_dir, "labels").join(d, "doc_id", "left")
    hit = F.coalesce(F.col("pred"), F.lit(0)) == F.col("toxic")
    return j.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(hit.cast("int")), 6).alias("accuracy"))


# ------------------------------------------------------------------ joins

@register("lookup_join", """SELECT c.c_custkey, coalesce(n.n_name, 'UNKNOWN') AS nation,
  coalesce(CASE c.c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'AUTOMOBILE' THEN 2 WHEN 'MACHINERY' THEN 3
    WHEN 'HOUSEHOLD' THEN 4 END, -1) AS segment_code
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table map (broadcast left join after a size check, default) and
    a literal map (``create_map``, default)."""
    c = _t(spark, sf_dir, "customer")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(maybe_broadcast(n, known_small=True), c.c_nationkey == n.n_nationkey, "left")  # 25 nations
    j = lookup(j, "c_mktsegment", {"BUILDING": 1, "AUTOMOBILE": 2, "MACHINERY": 3, "HOUSEHOLD": 4},
               "segment_code", default=-1)
    return j.select("c_custkey", F.coalesce("n_name", F.lit("UNKNOWN")).alias("nation"), "segment_code")


@register("aggregate_join", """WITH a AS (SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY 1),
b AS (SELECT o.o_orderstatus, avg(l.l_quantity) AS avg_qty FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY 1)
SELECT o_orderstatus, n_orders, round(avg_qty, 6) AS avg_qty FROM a JOIN b USING (o_orderstatus)""")
def aggregate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two aggregates on the same key joined."""
    o = _t(spark, sf_dir, "orders")
    li = _t(spark, sf_dir, "lineitem")
    a = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))
    b = (li.join(o.select("o_orderkey", "o_orderstatus"), li.l_orderkey == o.o_orderkey)
         .groupBy("o_orderstatus").agg(F.round(F.avg("l_quantity"), 6).alias("avg_qty")))
    return a.join(b, "o_orderstatus")


@register("ordered_pairs", with_ctes("""w AS (SELECT DISTINCT date_trunc('hour', ts) AS slot, ride FROM visits
  WHERE ride IS NOT NULL),
rides AS (SELECT DISTINCT ride FROM w),
grid AS (SELECT a.ride AS from_ride, b.ride AS to_ride FROM rides a, rides b WHERE a.ride <> b.ride),
c AS (SELECT a.ride AS from_ride, b.ride AS to_ride, count(*) AS n_slots FROM w a JOIN w b
  ON a.slot = b.slot AND a.ride <> b.ride GROUP BY 1, 2)
SELECT g.from_ride, g.to_ride, coalesce(c.n_slots, 0) AS n_slots FROM grid g LEFT JOIN c USING (from_ride, to_ride)""",
                                     VISITS))
def ordered_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered ride pairs (from != to) with the number of slots where
    both operated, as the matrix product P^T P of the slot x ride presence
    matrix (one pivoted row per slot, no per-slot pair rows)."""
    w = waits(spark, sf_dir).where(F.col("ride").isNotNull()).select("slot", "ride")
    rides = sorted(r[0] for r in w.select("ride").distinct().collect())  # ride dimension
    pres = w.groupBy("slot").pivot("ride", rides).agg(F.max(F.lit(1))).na.fill(0, subset=rides)
    j = w.join(pres, "slot")
    sums = j.groupBy(F.col("ride").alias("from_ride")).agg(
        *[F.sum(F.col(f"`{r}`")).alias(f"n_{i}") for i, r in enumerate(rides)])
    stack = ", ".join(f"'{r}', n_{i}" for i, r in enumerate(rides))
    long = sums.selectExpr("from_ride", f"stack({len(rides)}, {stack}) as (to_ride, n_slots)")
    return long.where(F.col("from_ride") != F.col("to_ride")).select(
        "from_ride", "to_ride", F.col("n_slots").cast("long").alias("n_slots"))


@register("unordered_pairs", with_ctes("""v AS (SELECT event_id, ride, wait FROM visits
  WHERE ride IS NOT NULL AND wait IS NOT NULL)
SELECT a.ride, count(*) AS n_pairs, round(avg(a.wait * b.wait), 6) AS mean_pair_product
FROM v a JOIN v b ON a.ride = b.ride AND a.event_id < b.event_id GROUP BY a.ride""", VISITS))
def unordered_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics over all unordered pairs within a group, exact and
    linear (the oracle forms the pairs; Spark never does)."""
    v = A.drop_null_keys(visits(spark, sf_dir), ["ride"])
    s = U.pair_product_stats(v, ["ride"], "wait")
    return s.select("ride", "n_pairs", F.round("mean_pair_product", 6).alias("mean_pair_product"))


@register("scalar_cross_join", """SELECT o_orderkey, round(o_totalprice / avg(o_totalprice) OVER (), 6) AS price_ratio
FROM orders""")
def scalar_cross_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row against a global scalar (one-row finaliser -> literal)."""
    o = _t(spark, sf_dir, "orders")
    m = A.scalar_row(o, F.avg("o_totalprice").alias("m"))["m"]
    return o.select("o_orderkey", F.round(F.col("o_totalprice") / F.lit(m), 6).alias("price_ratio"))


# ------------------------------------------------------------------ sorts / ranks / windows

@register("sorted_rows", """SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice,
  row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_extendedprice DESC, l_linenumber) AS rn FROM lineitem""")
def sorted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: mixed-direction multi-key sort of the whole table with its exact
    position (range-partitioned sort + partition offsets, no single-task
    window)."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    return global_row_number(li, [F.col("l_shipdate").asc(), F.col("l_orderkey").asc(),
                                  F.col("l_extendedprice").desc(), F.col("l_linenumber").asc()])


@register("sorted_frequencies", """SELECT o_orderpriority, n, row_number() OVER (ORDER BY o_orderpriority) AS rnk
FROM (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1)""")
def sorted_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: frequency table sorted by its key (window over the aggregate)."""
    o = A.drop_null_keys(_t(spark, sf_dir, "orders"), ["o_orderpriority"])
    f = o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return f.withColumn("rnk", F.row_number().over(Window.orderBy("o_orderpriority")).cast("long"))


_CORR_TARGETS = ["l_quantity", "l_discount", "l_tax"]


@register("sorted_correlations", "SELECT col, corr, row_number() OVER (ORDER BY corr DESC, col) AS rnk FROM (\n"
          + "\nUNION ALL\n".join(
              f"SELECT '{c}' AS col, round(covar_pop({c}, l_extendedprice) / nullif(stddev_pop(CASE WHEN "
              f"l_extendedprice IS NOT NULL THEN {c} END) * stddev_pop(CASE WHEN {c} IS NOT NULL THEN "
              f"l_extendedprice END), 0), 6) AS corr FROM lineitem" for c in _CORR_TARGETS) + ")")
def sorted_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation vector against the price, unpivoted and ranked."""
    li = _t(spark, sf_dir, "lineitem")
    wide = li.agg(*[F.round(S.safe_corr(c, "l_extendedprice"), 6).alias(c) for c in _CORR_TARGETS])
    long = wide.unpivot([], _CORR_TARGETS, "col", "corr")
    return long.withColumn("rnk", F.row_number().over(Window.orderBy(F.desc("corr"), "col")).cast("long"))


@register("top_k_per_group", """SELECT o_orderstatus, o_orderkey, o_totalprice, rnk FROM (
  SELECT o_orderstatus, o_orderkey, o_totalprice,
    row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS rnk FROM orders
  WHERE o_orderstatus IS NOT NULL) WHERE rnk <= 3""")
def top_k_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 orders by price per status; each status holds about a third
    of all rows, so the ranking is salted in two levels."""
    o = A.drop_null_keys(_t(spark, sf_dir, "orders"), ["o_orderstatus"]) \
        .select("o_orderstatus", "o_orderkey", "o_totalprice")
    return U.top_k_per_group(o, ["o_orderstatus"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3,
                             salt_col="o_orderkey")


@register("group_total", """SELECT l_orderkey, l_linenumber,
  round(l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey), 6) AS qty_share FROM lineitem""")
def group_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the order total per line."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    g = U.group_total(li, ["l_orderkey"], "l_quantity", "order_qty")
    return g.select("l_orderkey", "l_linenumber",
                    F.round(F.try_divide(F.col("l_quantity"), F.col("order_qty")), 6).alias("qty_share"))


# ------------------------------------------------------------------ unions

@register("union_all", """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'""")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return U.union_all(o.where(F.col("o_orderstatus") == "F"), o.where(F.col("o_orderstatus") == "O"))


@register("outer_union", """SELECT c_custkey AS party_key, c_name AS name, c_mktsegment AS segment, c_acctbal AS acctbal,
  CAST(NULL AS INTEGER) AS supplier_nation FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal, s_nationkey FROM supplier""")
def outer_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union with outer columns (missing ones are NULL)."""
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
                                             F.col("c_mktsegment").alias("segment"),
                                             F.col("c_acctbal").alias("acctbal"))
    s = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
                                             F.col("s_acctbal").alias("acctbal"),
                                             F.col("s_nationkey").alias("supplier_nation"))
    return U.union_all(c, s, allow_missing=True)


@register("add_missing_columns", """SELECT c_custkey AS party_key, 'customer' AS park_type, c_acctbal AS acctbal,
  CAST(NULL AS VARCHAR) AS extra FROM customer
UNION ALL SELECT s_suppkey, 'supplier', NULL, s_name FROM supplier""")
def add_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent columns added as typed NULLs before a plain union."""
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("party_key"),
                                             F.lit("customer").alias("park_type"),
                                             F.col("c_acctbal").alias("acctbal"))
    s = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("party_key"),
                                             F.lit("supplier").alias("park_type"),
                                             F.col("s_name").alias("extra"))
    c = c.withColumn("extra", F.lit(None).cast("string"))
    s = s.withColumn("acctbal", F.lit(None).cast("double"))
    return U.union_all(c, s)


@register("surrogate_id", """SELECT 'customer' AS src, c_custkey AS src_key, row_number() OVER (ORDER BY c_custkey) AS sid
FROM customer
UNION ALL SELECT 'document', doc_id, (SELECT count(*) FROM customer) + row_number() OVER (ORDER BY doc_id) FROM documents""")
def surrogate_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the second table continue after the first table's."""
    c = _t(spark, sf_dir, "customer").select(F.lit("customer").alias("src"), F.col("c_custkey").alias("src_key"))
    d = _t(spark, sf_dir, "documents").select(F.lit("document").alias("src"), F.col("doc_id").alias("src_key"))
    n_c = c.count()
    return U.union_all(U.surrogate_ids(c, ["src_key"], 0), U.surrogate_ids(d, ["src_key"], n_c))
