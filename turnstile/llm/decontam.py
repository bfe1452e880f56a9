"""Benchmark decontamination by spaced seeds.

Every position of a benchmark item is hashed under fixed masks that skip some of the following
words; documents are hashed at all positions under the same masks and meet the items on equal
hashes.  Around each hit the aligned words are compared: an overlap counts where some run of
``window`` words of the item (or the whole item if shorter) is at least ``similarity`` equal to the
document's words beside them, so single substituted words do not hide a passage.  The masks are complete for that test: any
aligned run of 8 to 13 words with at most a fifth of them substituted holds one of the masks.
Built-in functions only.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 1: the word counts, 0: any word
MASKS = ("11111", "110111", "11001011")
SPAN = max(map(len, MASKS))


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def seed_hashes(words: Column, at: Column) -> Column:
    """array of the masks' hashes of ``words`` from the 0-based position ``at``; null where words run out."""
    out = []
    for n, mask in enumerate(MASKS):
        kept = [F.get(words, at + i) for i, bit in enumerate(mask) if bit == "1"]
        out.append(F.when(kept[-1].isNotNull(), F.xxhash64(F.lit(n), *kept)))
    return F.array(*out)


def benchmark_seeds(items: DataFrame) -> DataFrame:
    """``item, w`` -> ``item, at, h``."""
    at = items.select("item", "w", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("at"))
    return at.select("item", "at", F.explode(seed_hashes(F.col("w"), F.col("at"))).alias("h")).where("h IS NOT NULL")


def _item_blocks(items: DataFrame, block_words: int) -> list[DataFrame]:
    """The items in blocks of about ``block_words`` words, each small enough to be broadcast."""
    total = items.agg(F.sum(F.size("w"))).first()[0] or 0
    n = max(1, math.ceil(total / block_words))
    return [items.where(F.pmod(F.xxhash64("item", F.array_join("w", " ")), F.lit(n)) == i) if n > 1 else items
            for i in range(n)]


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = 13,
                       similarity: float = 0.8, chunk: int = 64, block_words: int = 500_000) -> DataFrame:
    """``id, text_hash, item, equal_words``: the documents that hold a passage of an item, with the most
    equal words of one aligned run.

    The benchmark is broadcast in blocks of at most about ``block_words`` words (measured first; a larger
    benchmark takes more passes over the documents), documents are never shuffled or collected.  Null
    texts hold nothing; items of fewer than 8 words are no evidence and match nothing; items with the
    same id are kept apart by their text and reported under the id; null ids stay.  Empty tables: no rows."""
    items = (benchmark.select(F.col(item_col).alias("item_id"), tokens(F.col(item_text_col)).alias("w"))
             .where(F.size("w") >= 8).distinct()
             .withColumn("item", F.struct("item_id", F.xxhash64(F.array_join("w", " ")).alias("hash"))))
    margin = window - 1
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), tokens(F.col(text_col)).alias("w"))
    # pieces of the document with the words that any verified run around them can reach
    # (outer: an inner explode would be preceded by a filter that cuts the words a second time)
    d = d.select("id", "text_hash", "w", F.explode_outer(F.when(F.size("w") >= 8, F.sequence(
        F.lit(0), F.size("w") - 1, F.lit(chunk)))).alias("base")).where("base IS NOT NULL")
    d = d.select("id", "text_hash", "base", F.least(F.lit(margin), F.col("base")).alias("lead"), F.slice(
        "w", F.greatest(F.col("base") - margin, F.lit(0)) + 1, chunk + 2 * margin + SPAN).alias("s"))
    d = d.select("id", "text_hash", "s", F.explode(F.sequence(
        F.col("lead"), F.least(F.col("lead") + chunk, F.size("s")) - 1)).alias("at"))
    seeds = d.select("id", "text_hash", "s", "at", F.explode(seed_hashes(F.col("s"), F.col("at"))).alias("h")).where("h IS NOT NULL")

    def against(block: DataFrame) -> DataFrame:
        index = benchmark_seeds(block.select("item", "w")).select("h", "item", F.col("at").alias("item_at"))
        hits = seeds.join(F.broadcast(index), "h")
        hits = hits.join(F.broadcast(block.select("item", F.col("w").alias("v"))), "item")
        # the aligned words within a run's reach of the hit, then the best run
        first = F.greatest(-F.col("item_at"), F.lit(-margin))
        last = F.least(F.size("v") - F.col("item_at"), F.lit(margin + SPAN))
        length = F.least(F.lit(window), F.size("v"))
        hits = hits.select("id", "text_hash", F.col("item.item_id").alias("item"), "s", "v", "at", "item_at",
                           first.alias("first"), last.alias("last"), length.alias("n"))
        same = F.transform(F.sequence(F.col("first"), F.col("last") - 1), lambda i: F.when(
            F.get("s", F.col("at") + i) == F.get("v", F.col("item_at") + i), 1).otherwise(0))
        hits = hits.withColumn("same", same)
        runs = F.transform(F.sequence(F.lit(1), F.size("same") - F.col("n") + 1), lambda i: F.aggregate(
            F.slice("same", i, F.col("n")), F.lit(0), lambda a, x: a + x))
        hits = hits.select("id", "text_hash", "item", "n", F.array_max(runs).alias("equal"))
        return hits.where(F.col("equal") >= F.ceil(F.col("n") * similarity)).select("id", "text_hash", "item", "equal")

    found = reduce(DataFrame.unionByName, [against(b) for b in _item_blocks(items, block_words)])
    return found.groupBy("id", "text_hash", "item").agg(F.max("equal").cast("long").alias("equal_words"))


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per contaminated document: ``id, text_hash, n_items, first_item, equal_words`` (most of one run)."""
    return contaminated_pairs(docs, benchmark, id_col, **options).groupBy("id", "text_hash").agg(
        F.count("*").alias("n_items"), F.min("item").alias("first_item"), F.max("equal_words").alias("equal_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated rows, all columns kept."""
    bad = contaminated_documents(docs, benchmark, id_col, text_col=text_col, **options)
    bad = bad.select(F.col("id").alias("__bad_id"), F.col("text_hash").alias("__bad_hash"))
    return docs.join(bad, docs[id_col].eqNullSafe(bad["__bad_id"])
                     & (F.xxhash64(docs[text_col]) == bad["__bad_hash"]), "left_anti")
