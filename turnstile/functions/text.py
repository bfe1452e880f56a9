"""Text expressions (T1, T2, T4, F6) as higher-order column functions.

Scoring a document never explodes it: tokens are produced with ``split`` and
looked up in a literal map inside one projection, so whole documents of any
length are scored in place without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnstile.functions.scalars import col, count_any

# Tokens are maximal runs of letters (any script), lower-cased.
TOKEN_SPLIT = r"[^\p{L}]+"

# Keyword lists of the review segmentation.
SEGMENT_KEYWORDS = {
    "youth": ["friends", "bros", "squad", "group", "hangout", "party", "social", "fun",
              "young", "teen", "college", "students"],
    "family": ["family", "kids", "children", "parents", "mom", "dad", "toddler", "baby",
               "grandparents"],
    "express_pass": ["express pass", "fast lane", "skip queue", "VIP", "no wait", "priority",
                     "worth the money", "premium"],
    "budget": ["expensive", "cost", "too pricey", "overpriced", "save money", "cheap", "budget"],
}

# Weather keywords of the rain flag.
RAIN_WORDS = ["rain", "wet", "storm", "downpour", "drizzle", "thunder", "shower"]

# Our polarity lexicon (an input of the lexicon scorer, T1).
LEXICON = {
    "trash": -0.8, "worthless": -0.9, "idiot": -0.8, "scum": -0.9, "moron": -0.8,
    "pathetic": -0.9, "clown": -0.4, "disgusting": -1.0, "stupid": -0.8, "loser": -0.6,
    "good": 0.7, "great": 0.8, "best": 1.0, "love": 0.5, "fun": 0.3, "happy": 0.8,
    "nice": 0.6, "excellent": 1.0, "amazing": 0.6, "wonderful": 1.0,
}

# Valence lexicon of the compound scorer (T2), VADER-like scale.
VALENCE = {
    "trash": -1.9, "worthless": -1.9, "idiot": -2.3, "scum": -2.6, "moron": -2.2,
    "pathetic": -2.0, "clown": -0.9, "disgusting": -2.4, "stupid": -2.4, "loser": -2.4,
    "good": 1.9, "great": 3.1, "best": 3.2, "love": 3.2, "fun": 2.3, "happy": 2.7,
    "nice": 1.8, "excellent": 2.7, "amazing": 2.8, "wonderful": 2.7,
}
VADER_ALPHA = 15.0

# Words that turn a valence around within three words before it, and their factor.
NEGATIONS = ["not", "never", "none", "neither", "nor", "nothing", "nowhere", "without", "cannot",
             "rarely", "seldom", "despite"]
NEGATION_FACTOR = -0.74
# Words that raise or lower a valence, their step, and its share one, two and three words away.
BOOSTERS_UP = ["absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly", "deeply", "enormously",
               "entirely", "especially", "exceptionally", "extremely", "fully", "greatly", "highly", "hugely",
               "incredibly", "intensely", "more", "most", "particularly", "purely", "quite", "really", "remarkably",
               "so", "substantially", "thoroughly", "totally", "tremendously", "unbelievably", "unusually", "utterly", "very"]
BOOSTERS_DOWN = ["almost", "barely", "hardly", "kinda", "less", "little", "marginally", "occasionally", "partly", "scarcely",
                 "slightly", "somewhat", "sorta"]
BOOSTER_STEP = 0.293
BOOSTER_REACH = [1.0, 0.95, 0.9]


def tokens(text) -> Column:
    """Lower-cased letter runs; empty strings removed."""
    return F.filter(F.split(F.lower(col(text)), TOKEN_SPLIT), lambda t: F.length(t) > 0)


def _literal_map(m: Mapping[str, float]) -> Column:
    pairs = []
    for k, v in m.items():
        pairs += [F.lit(k), F.lit(float(v))]
    return F.create_map(*pairs)


def matched_scores(text, lexicon: Mapping[str, float]) -> Column:
    """Array of lexicon scores of the tokens that are in the lexicon."""
    m = _literal_map(lexicon)
    return F.filter(F.transform(tokens(text), lambda t: m[t]), lambda s: s.isNotNull())


def polarity_of(scores) -> Column:
    """T1 from an array of matched scores: their mean, 0 when empty."""
    s = col(scores)
    total = F.aggregate(s, F.lit(0.0), lambda acc, x: acc + x)
    return F.coalesce(F.try_divide(total, F.size(s).cast("double")), F.lit(0.0))


def lexicon_polarity(text, lexicon: Mapping[str, float] = LEXICON) -> Column:
    """Mean score of matched tokens; 0 when nothing matches (or NULL text).
    (Single expression; ``with_polarity`` builds the token array only once.)"""
    return polarity_of(matched_scores(text, lexicon))


def with_polarity(df, text: str, out: str = "polarity", lexicon: Mapping[str, float] = LEXICON):
    """T1 as two projections: the matched-score array is built once per row."""
    keep = [c for c in df.columns if c != text]
    return (df.select(*keep, matched_scores(text, lexicon).alias("_scores"))
            .select(*keep, polarity_of("_scores").alias(out)))


def word_valences(words, valence: Mapping[str, float] = VALENCE) -> Column:
    """Valence of each word of an array in its context, 0 for neutral ones: boosters among the three words
    before it step it away from (or towards) zero, negations there turn it."""
    w = col(words)
    base = _literal_map(valence)
    step = _literal_map({**dict.fromkeys(BOOSTERS_UP, BOOSTER_STEP), **dict.fromkeys(BOOSTERS_DOWN, -BOOSTER_STEP)})

    def in_context(word: Column, i: Column) -> Column:
        v = base[word]
        for k, share in enumerate(BOOSTER_REACH, 1):
            v = v + F.signum(base[word]) * F.coalesce(step[F.get(w, i - k)], F.lit(0.0)) * share
        for k in (1, 2, 3):
            v = v * F.when(F.get(w, i - k).isin(*NEGATIONS), NEGATION_FACTOR).otherwise(1.0)
        return F.coalesce(v, F.lit(0.0))

    return F.transform(w, in_context)


def with_valence(df, text: str, valence: Mapping[str, float] = VALENCE):
    """T2 in four projections: compound = s / sqrt(s^2 + alpha) of the summed valences; pos and neg are
    shares of positive + |negative| + neutral words, a scored word weighing its valence and one more."""
    keep = [c for c in df.columns if c != text]
    w = df.select(*keep, tokens(text).alias("_w"))
    v = w.select(*keep, word_valences("_w", valence).alias("_v"))

    def total(of):
        return F.aggregate("_v", F.lit(0.0), lambda acc, x: acc + of(x))
    sums = v.select(*keep, total(lambda x: x).alias("_s"), total(lambda x: F.when(x > 0, x + 1).otherwise(0.0)).alias("_pos"),
                    total(lambda x: F.when(x < 0, 1 - x).otherwise(0.0)).alias("_neg"),
                    total(lambda x: F.when(x == 0, 1.0).otherwise(0.0)).alias("_neu"))
    s, every = F.col("_s"), F.col("_pos") + F.col("_neg") + F.col("_neu")
    return sums.select(*keep, F.coalesce(F.try_divide(s, F.sqrt(s * s + F.lit(VADER_ALPHA))), F.lit(0.0)).alias("compound"),
                       F.coalesce(F.try_divide("_pos", every), F.lit(0.0)).alias("pos"),
                       F.coalesce(F.try_divide("_neg", every), F.lit(0.0)).alias("neg"))


def keyword_scores(text, keywords: Mapping[str, Sequence[str]] = SEGMENT_KEYWORDS) -> dict[str, Column]:
    """F5 per category over the lower-cased text (so upper-case keywords such
    as "VIP" never match, as in the reference)."""
    low = F.lower(col(text))
    return {k: count_any(low, ws) for k, ws in keywords.items()}


def segment_of(youth_c, family_c, express_c, budget_c) -> Column:
    """F6 from the four keyword counts."""
    youth = col(youth_c) > col(family_c)
    express = col(express_c) > col(budget_c)
    return (F.when(youth & express, 0).when(~youth & ~express, 1)
            .when(youth & ~express, 2).otherwise(3))


def keyword_segment(text, keywords: Mapping[str, Sequence[str]] = SEGMENT_KEYWORDS) -> Column:
    """0 social youth, 1 value families, 2 budget youth, 3 premium
    spenders.  Ties go to family / budget."""
    s = keyword_scores(text, keywords)
    return segment_of(s["youth"], s["family"], s["express_pass"], s["budget"])


def with_keyword_segment(df, text: str, keep_text: bool = False,
                         keywords: Mapping[str, Sequence[str]] = SEGMENT_KEYWORDS):
    """F5 + F6 in two projections: lower-case once, count once, then classify."""
    keep = [c for c in df.columns if c != text]
    low = df.select(*keep, *( [F.col(text)] if keep_text else []), F.lower(F.col(text)).alias("_low"))
    cols = keep + ([text] if keep_text else [])
    counts = low.select(*cols, *[count_any(F.col("_low"), ws).alias(k) for k, ws in keywords.items()])
    return counts.select("*", segment_of("youth", "family", "express_pass", "budget").alias("segment"))


def replace_sequences(text, names: Mapping[str, str]) -> Column:
    """T4: each mapped sequence of characters (a symbol, or several that stand for one) becomes its name, left to
    right, the longest first: two scans of the text for one alternation, whatever the table holds.  Null stays null."""
    text = col(text)
    if not names:
        return text
    longest_first = sorted(names, key=lambda k: (-len(k), k))
    # most places of a text fail on the first character already
    first = "".join(sorted({k[0] for k in longest_first}))
    pattern = F.lit(rf"(?=[\Q{first}\E])(?:" + "|".join(rf"\Q{k}\E" for k in longest_first) + ")")
    said = F.create_map(*[F.lit(x) for k in longest_first for x in (k, names[k])])
    found = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda x: said[x])
    # bound once by a transform: the inner one names it for every piece
    return F.get(F.transform(F.array(found), lambda said_here: F.array_join(F.transform(
        F.split(text, pattern, -1), lambda x, i: F.concat(x, F.coalesce(F.get(said_here, i), F.lit("")))), "")), F.lit(0))

