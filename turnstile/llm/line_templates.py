"""Line dedup with a log-template tree.

Every line walks a tree of fixed depth: its token count, then its first ``depth`` tokens, where tokens
with a digit already count as a variable field.  In the leaf the other fields are generalised: a
field is fixed where its token is dominant in the leaf (at least ``min_docs`` distinct lines and a
tenth of them), variable elsewhere.  A line belongs to its literal template, and to the
generalised one if most of its fields are fixed.  Templates that occur in ``min_docs`` or more
documents are recurring; their lines go everywhere but at the first occurrence.  With ``long_tokens``,
lines of so many tokens are evidence enough in ``long_min_docs`` documents: for them that number
takes the place of ``min_docs`` everywhere.

Tokens leave their document as 32-bit hashes, and only from leaves that enough lines share: a
bitmap of fixed size (leaf hash modulo its bits) says which; false positives cost work, never results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import hash_bitmap, stored

_DIGIT = re.compile(r"[0-9]")
FIELD = "<*>"


def line_tokens(line: str) -> list[str]:
    words = line.split()
    return [FIELD if _DIGIT.search(w) else w for w in words] if _DIGIT.search(line) else words


def leaf_hash(tokens: list[str], depth: int, long_tokens: int | None = None) -> int:
    """63 bits of hash; the sign says whether the leaf's lines are long."""
    import xxhash

    h = xxhash.xxh64_intdigest(f"{len(tokens)}\n{' '.join(tokens[:depth])}".encode("utf-8", "replace")) & (1 << 63) - 1
    return h - (1 << 63) if long_tokens is not None and len(tokens) >= long_tokens else h


def _needed(min_docs: int, long_min_docs: int):
    return F.when(F.col("leaf") < 0, long_min_docs).otherwise(min_docs)


def _leaves(depth: int, min_tokens: int, long_tokens: int | None):
    @F.pandas_udf("array<bigint>")
    def leaves(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            out = []
            for text in part:
                found = set()
                for line in (text or "").split("\n"):
                    tokens = line_tokens(line)
                    if len(tokens) >= min_tokens:
                        found.add(leaf_hash(tokens, depth, long_tokens))
                out.append(list(found))
            yield pd.Series(out)

    return leaves


def shared_leaf_bits(docs: DataFrame, text_col: str, depth: int, min_tokens: int, min_docs: int, bits: int,
                     long_tokens: int | None = None, long_min_docs: int = 2):
    """Bitmap (``bits`` long whatever the input) of the leaves found in ``min_docs`` (long ones: ``long_min_docs``) documents."""
    leaf = docs.select(F.explode(_leaves(depth, min_tokens, long_tokens)(F.col(text_col))).alias("leaf"))
    return hash_bitmap(leaf.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= _needed(min_docs, long_min_docs)), "leaf", bits)


def _candidate_lines(bitmap, depth: int, min_tokens: int, long_tokens: int | None):
    bits = len(bitmap) * 64

    def lines(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        import xxhash

        for part in parts:
            out: list[tuple] = []
            for i, h, text in zip(part["id"], part["text_hash"], part["text"]):
                for no, line in enumerate((text or "").split("\n")):
                    tokens = line_tokens(line)
                    if len(tokens) < min_tokens:
                        continue
                    leaf = leaf_hash(tokens, depth, long_tokens)
                    b = leaf % bits
                    if not int(bitmap[b >> 6]) >> (b & 63) & 1:
                        continue
                    each = [w.encode("utf-8", "replace") for w in tokens]
                    whole = int.from_bytes(xxhash.xxh64_digest(b" ".join(each)), "big", signed=True)
                    out.append((i, h, no, leaf, whole, [zlib.crc32(w) - (1 << 31) for w in each]))
                if len(out) >= 20_000:
                    yield pd.DataFrame(out, columns=["id", "text_hash", "line", "leaf", "whole", "tokens"])
                    out = []
            yield pd.DataFrame(out, columns=["id", "text_hash", "line", "leaf", "whole", "tokens"])

    return lines


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 5, depth: int = 4,
                    min_tokens: int = 3, min_fixed: float = 0.7, min_general_tokens: int = 9,
                    bitmap_bits: int = 1 << 26, long_tokens: int | None = None, long_min_docs: int = 2) -> DataFrame:
    """``id, text_hash, lines``: per document the 0-based numbers of the lines to drop (see the module).

    A document is an id with a text: repeated rows of both count once.  Lines under ``min_tokens``
    tokens have no template; lines under ``min_general_tokens`` only a literal one (numbers
    generalised).  The first occurrence is the smallest id (null ids last), then text hash, then line.
    Null or empty texts have no lines; an empty table gives no rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    bitmap = shared_leaf_bits(docs, text_col, depth, min_tokens, min_docs, bitmap_bits, long_tokens, long_min_docs)
    needed = _needed(min_docs, long_min_docs)
    lines = stored(rows.mapInPandas(
        _candidate_lines(bitmap, depth, min_tokens, long_tokens),
        f"id {id_type}, text_hash bigint, line int, leaf bigint, whole bigint, tokens array<int>"), "template-lines")

    # dominant tokens of each leaf, over its distinct lines
    distinct = (lines.where(F.size("tokens") >= min_general_tokens).groupBy("leaf", "whole")
                .agg(F.first("tokens").alias("tokens")))
    distinct = stored(distinct, "template-distinct")
    size = distinct.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= needed)
    token = (distinct.join(size, "leaf", "left_semi").select("leaf", F.posexplode("tokens").alias("at", "token"))
             .groupBy("leaf", "at", "token").agg(F.count("*").alias("k")).where(F.col("k") >= needed))
    fixed = (token.join(size, "leaf").where(10 * F.col("k") >= F.col("n"))
             .groupBy("leaf").agg(F.collect_list(F.struct("at", "token")).alias("fixed")))  # ten tokens a field at most
    general = distinct.join(fixed, "leaf").select("leaf", "whole", F.transform("tokens", lambda t, i: F.when(
        F.array_contains("fixed", F.struct(i.alias("at"), t.alias("token"))), t)).alias("fields"))
    general = general.where(F.size(F.filter("fields", lambda t: t.isNotNull())) >= F.ceil(F.size("fields") * min_fixed))
    general = general.select("whole", "leaf", F.xxhash64("leaf", "fields").alias("template"))

    place = lines.select("id", "text_hash", "line", "leaf", "whole")
    named = (place.select("id", "text_hash", "line", needed.alias("needed"), F.xxhash64("leaf", "whole").alias("template"))
             .unionByName(place.join(general, ["leaf", "whole"]).select(
                 "id", "text_hash", "line", needed.alias("needed"), "template")))
    named = stored(named, "template-names")
    each = named.groupBy("template", "id", "text_hash").agg(F.min("line").alias("line"), F.first("needed").alias("needed"))
    often = each.groupBy("template").agg(F.count("*").alias("n"), F.first("needed").alias("needed"), F.min(F.struct(
        F.col("id").isNull().alias("no"), "id", "text_hash", "line")).alias("first")).where(F.col("n") >= F.col("needed"))
    often = stored(often, "template-often")  # a table of its own: the join may split a template's lines
    drop = named.join(often.select("template", "first"), "template").where(
        ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.text_hash"))
          & (F.col("line") == F.col("first.line"))))
    return drop.groupBy("id", "text_hash").agg(F.collect_set("line").alias("lines"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_into: str | None = None,
                         **options) -> DataFrame:
    """``docs`` with the recurring lines cut from ``text_col`` (other columns kept; ``count_into``: names an
    added column with the number of lines dropped)."""
    drop = recurring_lines(docs, id_col, text_col, **options).select(
        F.col("id").alias("__drop_id"), F.col("text_hash").alias("__drop_hash"), F.col("lines").alias("__drop"))
    both = docs.withColumn("__text_hash", F.xxhash64(text_col)).join(
        drop, F.col(id_col).eqNullSafe(F.col("__drop_id")) & (F.col("__text_hash") == F.col("__drop_hash")), "left")
    left = F.array_join(F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains("__drop", i)), "\n")
    out = both.withColumn(text_col, F.when(F.col("__drop").isNull(), F.col(text_col)).otherwise(left))
    if count_into:
        out = out.withColumn(count_into, F.coalesce(F.size("__drop"), F.lit(0)).cast("long"))
    return out.drop("__text_hash", "__drop_id", "__drop_hash", "__drop")
