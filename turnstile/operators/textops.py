"""Table-level text operators: TF-IDF contrast of two classes.

Documents are tokenised in place (``split`` / ``regexp_extract_all``) and
exploded once to (doc, term) counts - a word-count shuffle that partial
aggregation keeps proportional to distinct (doc, term) pairs.  The vocabulary
(<= ``max_features`` rows) is the only broadcast side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.operators.joins import maybe_broadcast
from turnstile.session import snapshot

# Word tokens of two or more letters / digits / underscores (Unicode aware).
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"

# A short English stop-word list (function words of the corpus).
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "with",
              "be", "as", "by", "this", "are", "at", "an", "from", "or", "he", "she", "they",
              "we", "you", "his", "her", "its", "their", "not", "but", "have", "has", "had",
              "were", "been", "which", "who", "will", "would", "can", "could", "there", "than"]


def term_counts(docs: DataFrame, doc_id: str, text: str,
                stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """(doc_id, term, tf) with lower-cased word tokens minus stop words."""
    toks = docs.select(doc_id, F.explode(
        F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD_PATTERN), 0)).alias("term"))
    toks = toks.where(~F.col("term").isin(*stop_words))
    return toks.groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("tf"))


def tfidf_contrast(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str,
                   max_features: int = 1000, top: int = 100) -> DataFrame:
    """Vocabulary and idf fitted on the ``label == 1`` documents;
    ``idf = ln((1 + n) / (1 + df)) + 1``; L2-normalised tf-idf per document;
    mean over all documents of each class; top terms of mean(1) - mean(0).

    Texts are counted beside their scan; only (doc, term, count) rows meet the labels."""
    lab = labels.select(doc_id, label)
    # feeds the vocabulary, the weights and the class means
    tc = snapshot(term_counts(docs, doc_id, text).join(lab, doc_id), "term-counts")
    n = {r[label]: r["n"] for r in docs.select(doc_id).join(lab, doc_id).groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_neg, n_pos = n.get(1, 0), n.get(0, 0)
    vocab = (tc.where(F.col(label) == 1).groupBy("term").agg(F.sum("tf").alias("freq"), F.count(F.lit(1)).alias("df"))
             .orderBy(F.desc("freq"), "term").limit(max_features))
    vocab = vocab.withColumn("idf", F.log((1.0 + n_neg) / (1.0 + F.col("df"))) + 1.0)
    # the vocabulary has at most max_features rows
    w = tc.join(maybe_broadcast(vocab.select("term", "idf"), known_small=True), "term") \
        .withColumn("x", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy(doc_id)))
    w = w.withColumn("xn", F.col("x") / norm)
    means = w.groupBy("term").agg(
        F.sum(F.when(F.col(label) == 1, F.col("xn"))).alias("s1"),
        F.sum(F.when(F.col(label) == 0, F.col("xn"))).alias("s0"))
    contrast = (F.coalesce(F.col("s1"), F.lit(0.0)) / F.lit(float(max(n_neg, 1)))
                - F.coalesce(F.col("s0"), F.lit(0.0)) / F.lit(float(max(n_pos, 1))))
    scored = vocab.select("term").join(means, "term", "left").withColumn("contrast", contrast)
    return (scored.orderBy(F.desc("contrast"), "term").limit(top)
            .withColumn("rnk", F.row_number().over(Window.orderBy(F.desc("contrast"), "term")).cast("long"))
            .select("term", F.round("contrast", 6).alias("contrast"), "rnk"))
