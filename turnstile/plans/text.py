"""Text and complaint queries (F5, F6, F15, F33-F35, G16, G18, G27, J4, L2,
P11, T1-T4, U3).

Review text = ``documents``; each document is one order's review, so its
date, branch and rating come from ``orders`` joined on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.functions import scalars as S
from turnstile.functions import text as X
from turnstile.operators.textops import STOP_WORDS, WORD_PATTERN, tfidf_contrast
from turnstile.plans.registry import register
from turnstile.plans.sqlbind import REVIEWS, with_ctes
from turnstile.sources.tables import documents, reviews, table

MARKED_BRANCH = "O"   # branches containing this code get the first focus set

# Emoji and other symbols by name (T4); an input table of the mapper.
CHAR_NAMES = {
    "😀": ":grinning_face:", "😃": ":grinning_face_with_big_eyes:", "😄": ":grinning_face_with_smiling_eyes:",
    "😊": ":smiling_face_with_smiling_eyes:", "😍": ":smiling_face_with_heart-eyes:", "😂": ":face_with_tears_of_joy:",
    "😢": ":crying_face:", "😭": ":loudly_crying_face:", "😡": ":enraged_face:", "😠": ":angry_face:",
    "😱": ":face_screaming_in_fear:", "😴": ":sleeping_face:", "👍": ":thumbs_up:", "👎": ":thumbs_down:",
    "👏": ":clapping_hands:", "🙏": ":folded_hands:", "🎉": ":party_popper:", "🎢": ":roller_coaster:",
    "🎡": ":ferris_wheel:", "🎠": ":carousel_horse:", "🌧": ":cloud_with_rain:", "☀": ":sun:", "🔥": ":fire:",
    "💯": ":hundred_points:", "❤": ":red_heart:", "💔": ":broken_heart:", "⭐": ":star:", "✨": ":sparkles:",
    "é": ":e_acute:", "è": ":e_grave:", "ç": ":c_cedilla:", "ü": ":u_umlaut:", "ä": ":a_umlaut:",
}

# Symbols of several characters.  A hand may carry one of five tones; joined symbols are one.
SKIN_TONES = {"\U0001f3fb": "light", "\U0001f3fc": "medium-light", "\U0001f3fd": "medium", "\U0001f3fe": "medium-dark", "\U0001f3ff": "dark"}
HANDS = ["👍", "👎", "👏", "🙏"]
JOINED_NAMES = {
    "❤\ufe0f": ":red_heart:", "☀\ufe0f": ":sun:", "🌧\ufe0f": ":cloud_with_rain:", "❤\ufe0f\u200d🔥": ":heart_on_fire:",
    "👨\u200d👩\u200d👧": ":family_man_woman_girl:", "👨\u200d👩\u200d👦": ":family_man_woman_boy:",
}
SYMBOL_NAMES = {**CHAR_NAMES, **JOINED_NAMES,
                **{hand + tone: f"{CHAR_NAMES[hand][:-1]}_{word}_skin_tone:" for hand in HANDS for tone, word in SKIN_TONES.items()}}

SEASON_ORDER = ["Feb - Apr", "Summer Holidays", "Aug - Oct", "Winter Holidays", "Feb - Apr (2)"]


def text_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, "doc_id", "text", "lang")
    r = reviews(spark, sf_dir)
    return d.join(r, d.doc_id == r.review_id).drop("review_id")


TEXT_REVIEWS_SQL = REVIEWS + """,
text_reviews AS (SELECT d.doc_id, d.text, d.lang, r.written_date, r.branch, r.rating, r.polarity
  FROM documents d JOIN reviews r ON d.doc_id = r.review_id)"""


# ------------------------------------------------------------------ SQL helpers

def _count_sql(text: str, word: str) -> str:
    w = word.replace("'", "''")
    return f"CAST(floor((length({text}) - length(replace({text}, '{w}', ''))) / {len(word)}) AS BIGINT)"


def _count_any_sql(text: str, words) -> str:
    return "(" + " + ".join(_count_sql(text, w) for w in words) + ")"


_KW = X.SEGMENT_KEYWORDS
_SCORES_SQL = ", ".join(f"{_count_any_sql('lower(text)', ws)} AS {k}" for k, ws in _KW.items())
_SEGMENT_SQL = """CASE WHEN youth > family AND express_pass > budget THEN 0
  WHEN NOT (youth > family) AND NOT (express_pass > budget) THEN 1
  WHEN youth > family THEN 2 ELSE 3 END"""
_RAIN_SQL = "coalesce(regexp_matches(text, '(?i)(?:" + "|".join(X.RAIN_WORDS) + ")'), false)"


def _lexicon_values(lex) -> str:
    return "(VALUES " + ", ".join(f"('{k}', CAST({v!r} AS DOUBLE))" for k, v in lex.items()) + ")"


_TOKENS_SQL = r"unnest(regexp_split_to_array(lower(text), '[^\p{L}]+'))"

LEXICON_SQL = f"""lex(word, score) AS (SELECT * FROM {_lexicon_values(X.LEXICON)} t(word, score)),
toks AS (SELECT doc_id, {_TOKENS_SQL} AS tok FROM documents),
lexpol AS (SELECT d.doc_id, coalesce(m.pol, 0.0) AS polarity FROM documents d LEFT JOIN (
  SELECT doc_id, avg(score) AS pol FROM toks JOIN lex ON toks.tok = lex.word GROUP BY doc_id) m
  USING (doc_id))"""


def _segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    # score every document where it lies, then join only the small feature
    # rows to their orders (whole texts never cross the shuffle)
    d = documents(spark, sf_dir, "doc_id", "text")
    seg = X.with_keyword_segment(d, "text", keep_text=True)
    seg = seg.select("doc_id", "segment", "text", S.keyword_flag("text", X.RAIN_WORDS).alias("mentions_rain"))
    feat = X.with_polarity(seg, "text")
    r = reviews(spark, sf_dir).select("review_id", "written_date", "branch", "rating")
    j = feat.join(r, feat.doc_id == r.review_id)
    return j.select("doc_id", "written_date", "branch", "rating", "segment", "mentions_rain", "polarity")


SEGMENTED_SQL = TEXT_REVIEWS_SQL + ", " + LEXICON_SQL + f""",
scored AS (SELECT doc_id, written_date, branch, rating, text, {_SCORES_SQL} FROM text_reviews),
segmented AS (SELECT s.doc_id, s.written_date, s.branch, s.rating, {_SEGMENT_SQL} AS segment,
  {_RAIN_SQL} AS mentions_rain, l.polarity
  FROM scored s JOIN lexpol l USING (doc_id))"""


# ------------------------------------------------------------------ segments

@register("keyword_segment", with_ctes(f"""s AS (SELECT doc_id, {_SCORES_SQL} FROM documents)
SELECT doc_id, youth, family, express_pass, budget, {_SEGMENT_SQL} AS segment FROM s"""))
def keyword_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 + F6 on whole documents."""
    return X.with_keyword_segment(documents(spark, sf_dir, "doc_id", "text"), "text")


@register("rain_flag", f"SELECT doc_id, {_RAIN_SQL} AS mentions_rain FROM documents")
def rain_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Substring semantics of the reference keyword list."""
    d = documents(spark, sf_dir, "doc_id", "text")
    return d.select("doc_id", S.keyword_flag("text", X.RAIN_WORDS).alias("mentions_rain"))


@register("segment_rain_diff", with_ctes("""SELECT segment,
  round(avg(polarity) FILTER (WHERE mentions_rain), 6) AS rain_mean,
  round(avg(polarity) FILTER (WHERE NOT mentions_rain), 6) AS dry_mean,
  round(avg(polarity) FILTER (WHERE mentions_rain) - avg(polarity) FILTER (WHERE NOT mentions_rain), 6)
    AS rain_minus_dry
FROM segmented GROUP BY segment""", SEGMENTED_SQL))
def segment_rain_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G27 + J4 as one conditional aggregate (no self-join of two group tables)."""
    s = _segmented(spark, sf_dir)
    rain = F.avg(F.when(F.col("mentions_rain"), F.col("polarity")))
    dry = F.avg(F.when(~F.col("mentions_rain"), F.col("polarity")))
    return s.groupBy("segment").agg(F.round(rain, 6).alias("rain_mean"), F.round(dry, 6).alias("dry_mean"),
                                    F.round(rain - dry, 6).alias("rain_minus_dry"))


def _season_sql(month: str) -> str:
    parts = " ".join(f"WHEN {month} IN ({', '.join(map(str, ms))}) THEN '{lab}'"
                     for lab, ms in S.REVIEW_SEASONS)
    return f"CASE {parts} END"


@register("season_segment", with_ctes(f"""SELECT {_season_sql('month(written_date)')} AS season, segment,
  count(*) AS n FROM segmented WHERE written_date IS NOT NULL GROUP BY 1, 2""", SEGMENTED_SQL))
def season_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F15 + G3: reviews per (season, segment); NULL months are dropped."""
    s = _segmented(spark, sf_dir).where(F.col("written_date").isNotNull())
    return s.groupBy(S.season_of_month(F.month("written_date")).alias("season"), "segment") \
        .agg(F.count(F.lit(1)).alias("n"))


@register("month_pivot", with_ctes("SELECT branch, " + ", ".join(
    f"round(avg(polarity) FILTER (WHERE month(written_date) = {m}), 6) AS m_{m}" for m in range(1, 13))
    + " FROM segmented WHERE branch IS NOT NULL GROUP BY branch", SEGMENTED_SQL))
def month_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean polarity by branch x month with the explicit month list."""
    s = _segmented(spark, sf_dir).where(F.col("branch").isNotNull()) \
        .withColumn("month", F.month("written_date"))
    p = s.groupBy("branch").pivot("month", list(range(1, 13))).agg(F.round(F.avg("polarity"), 6))
    return p.select("branch", *[F.col(str(m)).alias(f"m_{m}") for m in range(1, 13)])


@register("unpivot_sentiment", with_ctes("""w AS (SELECT segment,
  round(avg(polarity) FILTER (WHERE mentions_rain), 6) AS rain,
  round(avg(polarity) FILTER (WHERE NOT mentions_rain), 6) AS dry FROM segmented GROUP BY segment)
SELECT segment, 'rain' AS weather, rain AS mean_polarity FROM w
UNION ALL SELECT segment, 'dry', dry FROM w""", SEGMENTED_SQL))
def unpivot_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide (segment, rain, dry) melted to long form."""
    s = _segmented(spark, sf_dir)
    w = s.groupBy("segment").agg(
        F.round(F.avg(F.when(F.col("mentions_rain"), F.col("polarity"))), 6).alias("rain"),
        F.round(F.avg(F.when(~F.col("mentions_rain"), F.col("polarity"))), 6).alias("dry"))
    return w.unpivot("segment", ["rain", "dry"], "weather", "mean_polarity")


_SEASON_LIST_SQL = "[" + ", ".join(f"'{s}'" for s in SEASON_ORDER) + "]"


@register("season_cycle_volume", with_ctes(f"""v AS (
  SELECT {_season_sql('month(written_date)')} AS season, count(*) AS n FROM reviews
  WHERE written_date IS NOT NULL GROUP BY 1),
u AS (SELECT season, n FROM v UNION ALL SELECT 'Feb - Apr (2)', n FROM v WHERE season = 'Feb - Apr')
SELECT season, CAST(sum(n) AS BIGINT) AS n, CAST(list_position({_SEASON_LIST_SQL}, season) AS BIGINT) AS season_rank
FROM u GROUP BY season""", REVIEWS))
def season_cycle_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U3 + L2: the Feb - Apr slice is appended again as "Feb - Apr (2)" so a
    cyclic axis closes; then a group sum and the custom category rank."""
    r = reviews(spark, sf_dir).where(F.col("written_date").isNotNull())
    v = r.groupBy(S.season_of_month(F.month("written_date")).alias("season")) \
        .agg(F.count(F.lit(1)).alias("n"))
    u = v.unionByName(v.where(F.col("season") == "Feb - Apr").withColumn("season", F.lit("Feb - Apr (2)")))
    g = u.groupBy("season").agg(F.sum("n").cast("long").alias("n"))
    return g.withColumn("season_rank", S.category_rank("season", SEASON_ORDER))


# ------------------------------------------------------------------ lexicon scorers

@register("lexicon_sentiment", with_ctes("SELECT doc_id, round(polarity, 6) AS polarity FROM lexpol",
                                         LEXICON_SQL))
def lexicon_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean lexicon score of the matched tokens of each whole document."""
    p = X.with_polarity(documents(spark, sf_dir, "doc_id", "text"), "text")
    return p.select("doc_id", F.round("polarity", 6).alias("polarity"))


def _in_sql(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


_BOOST_SQL = " + ".join(f"{share} * CASE WHEN p{k} IN {_in_sql(X.BOOSTERS_UP)} THEN 0.293 WHEN p{k} IN {_in_sql(X.BOOSTERS_DOWN)} "
                        f"THEN -0.293 ELSE 0 END" for k, share in ((1, "1.0"), (2, "0.95"), (3, "0.9")))
_TURN_SQL = " * ".join(f"CASE WHEN p{k} IN {_in_sql(X.NEGATIONS)} THEN -0.74 ELSE 1 END" for k in (1, 2, 3))


@register("vader_compound", with_ctes(f"""val(word, v) AS (SELECT * FROM {_lexicon_values(X.VALENCE)} t(word, v)),
seq AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), lambda x: length(x) > 0) AS w FROM documents),
one AS (SELECT doc_id, unnest(w) AS tok, generate_subscripts(w, 1) AS i FROM seq),
near AS (SELECT doc_id, tok, lag(tok, 1) OVER o AS p1, lag(tok, 2) OVER o AS p2, lag(tok, 3) OVER o AS p3
  FROM one WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
scored AS (SELECT doc_id, coalesce((v + sign(v) * ({_BOOST_SQL})) * {_TURN_SQL}, 0)::DOUBLE AS s FROM near LEFT JOIN val ON tok = word),
m AS (SELECT doc_id, sum(s) AS s, sum(CASE WHEN s > 0 THEN s + 1 ELSE 0 END) AS pos,
  sum(CASE WHEN s < 0 THEN 1 - s ELSE 0 END) AS neg, sum(CASE WHEN s = 0 THEN 1 ELSE 0 END) AS neu FROM scored GROUP BY doc_id)
SELECT d.doc_id, round(coalesce(m.s / sqrt(m.s * m.s + 15), 0), 6) AS compound,
  round(coalesce(m.pos / nullif(m.pos + m.neg + m.neu, 0), 0), 6) AS pos,
  round(coalesce(m.neg / nullif(m.pos + m.neg + m.neu, 0), 0), 6) AS neg
FROM documents d LEFT JOIN m USING (doc_id)"""))
def vader_compound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2."""
    v = X.with_valence(documents(spark, sf_dir, "doc_id", "text"), "text")
    return v.select("doc_id", *[F.round(k, 6).alias(k) for k in ("compound", "pos", "neg")])


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)


@register("tfidf_contrast", f"""WITH docs AS (
  SELECT d.doc_id, d.text, l.toxic AS label FROM documents d JOIN labels l USING (doc_id)),
toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD_PATTERN}')) AS term FROM docs),
tc AS (SELECT t.doc_id, t.term, count(*) AS tf, any_value(d.label) AS label FROM toks t JOIN docs d USING (doc_id)
  WHERE t.term NOT IN ({_STOP_SQL}) GROUP BY t.doc_id, t.term),
nn AS (SELECT count(*) FILTER (WHERE label = 1) AS n1, count(*) FILTER (WHERE label = 0) AS n0 FROM docs),
vocab AS (SELECT term, sum(tf) AS freq, count(*) AS df FROM tc WHERE label = 1 GROUP BY term
  ORDER BY freq DESC, term LIMIT 1000),
vi AS (SELECT term, ln((1.0 + n1) / (1.0 + df)) + 1.0 AS idf FROM vocab, nn),
w AS (SELECT tc.doc_id, tc.term, tc.label, tc.tf * vi.idf AS x FROM tc JOIN vi USING (term)),
wn AS (SELECT *, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS xn FROM w),
means AS (SELECT term, sum(xn) FILTER (WHERE label = 1) AS s1, sum(xn) FILTER (WHERE label = 0) AS s0
  FROM wn GROUP BY term),
sc AS (SELECT v.term, coalesce(m.s1, 0) / greatest(nn.n1, 1) - coalesce(m.s0, 0) / greatest(nn.n0, 1) AS contrast
  FROM vocab v LEFT JOIN means m USING (term) CROSS JOIN nn)
SELECT term, round(contrast, 6) AS contrast, rnk FROM (
  SELECT term, contrast, row_number() OVER (ORDER BY contrast DESC, term) AS rnk FROM sc) WHERE rnk <= 100""")
def tfidf_contrast_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinguishing terms of toxic (negative) vs other labelled documents."""
    d = documents(spark, sf_dir, "doc_id", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return tfidf_contrast(d, lab, "doc_id", "text", "label")


def _replace_sql(expr: str) -> str:
    for k, v in sorted(SYMBOL_NAMES.items(), key=lambda x: -len(x[0])):
        expr = f"replace({expr}, '{k}', '{v}')"
    return expr


@register("emoji_map", f"""SELECT doc_id, length({_replace_sql('text')}) AS n_chars_mapped,
  md5({_replace_sql('text')}) AS text_md5 FROM documents""")
def emoji_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: mapped symbols, of one or several characters, replaced by their names across whole documents."""
    d = documents(spark, sf_dir, "doc_id", "text")
    m = X.replace_sequences("text", SYMBOL_NAMES)
    return d.select("doc_id", F.length(m).cast("long").alias("n_chars_mapped"), F.md5(m).alias("text_md5"))


# ------------------------------------------------------------------ complaints

_P_NEG = "(1.0 - polarity) / 2.0"


def _severity_sql() -> str:
    r, p = "coalesce(CAST(rating AS DOUBLE), 5.0)", f"coalesce({_P_NEG}, 0.0)"
    return f"""CASE WHEN NOT ({r} BETWEEN 1 AND 5 AND {p} BETWEEN 0 AND 1) THEN 0
  WHEN {r} > 4 THEN 0 WHEN {r} <= 2 AND {p} > 0.8 THEN 3 WHEN {r} <= 3 AND {p} > 0.6 THEN 2
  WHEN {r} <= 4 THEN 1 ELSE 0 END"""


SEVERITY_SQL = REVIEWS + f""",
sev AS (SELECT review_id, branch, rating, round({_P_NEG}, 6) AS p_negative, {_P_NEG} AS p_raw,
  {_severity_sql()} AS severity FROM reviews)"""


def _severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reviews(spark, sf_dir).withColumn("p_raw", (F.lit(1.0) - F.col("polarity")) / 2.0)
    return r.select("review_id", "branch", "rating", F.round("p_raw", 6).alias("p_negative"), "p_raw",
                    S.complaint_severity("rating", "p_raw").alias("severity"))


@register("severity_class", with_ctes("SELECT review_id, branch, rating, p_negative, severity FROM sev",
                                      SEVERITY_SQL))
def severity_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F33 (p_negative = probability of the negative class from polarity)."""
    return _severity(spark, sf_dir).drop("p_raw")


@register("severity_by_branch", with_ctes("""SELECT branch, round(avg(severity), 6) AS mean_severity,
  count(*) FILTER (WHERE severity = 0) AS n0, count(*) FILTER (WHERE severity = 1) AS n1,
  count(*) FILTER (WHERE severity = 2) AS n2, count(*) FILTER (WHERE severity = 3) AS n3
FROM sev WHERE branch IS NOT NULL GROUP BY branch""", SEVERITY_SQL))
def severity_by_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 + G5 over the severity classes, one pass."""
    s = _severity(spark, sf_dir).where(F.col("branch").isNotNull())
    return s.groupBy("branch").agg(F.round(F.avg("severity"), 6).alias("mean_severity"),
                                   *[F.count(F.when(F.col("severity") == k, 1)).alias(f"n{k}")
                                     for k in range(4)])


def _action_sql() -> str:
    base = "CASE severity " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in S.SEVERITY_ACTIONS.items()) + " END"
    focus = (f"CASE WHEN contains(branch, '{MARKED_BRANCH}') AND p_raw > 0.8 THEN '{S.FOCUS_MARKED_HIGH}' "
             f"WHEN contains(branch, '{MARKED_BRANCH}') THEN '{S.FOCUS_MARKED_LOW}' "
             f"WHEN p_raw > 0.8 THEN '{S.FOCUS_OTHER_HIGH}' ELSE '{S.FOCUS_OTHER_LOW}' END")
    return f"CASE WHEN severity = 0 THEN '{S.NO_ACTION}' ELSE {base} || ', ' || {focus} END"


@register("recommended_action", with_ctes(f"""SELECT review_id, severity, {_action_sql()} AS action,
  CASE WHEN severity = 1 THEN 'Severe' ELSE 'Moderate' END AS severity_label FROM sev""", SEVERITY_SQL))
def recommended_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F34 + F35."""
    s = _severity(spark, sf_dir)
    return s.select("review_id", "severity",
                    S.recommended_action("severity", "branch", "p_raw", MARKED_BRANCH).alias("action"),
                    S.severity_label("severity").alias("severity_label"))
