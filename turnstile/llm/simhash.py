"""SimHash near-duplicates by pivot distance tables.

Fingerprint: 64 majority bits over the XXH64 (seed 42) of the text's word shingles.
Search: every distinct fingerprint gets a row of Hamming distances to fixed reference
fingerprints (pivots).  The pivots are a base, a chain that departs from the base bit by bit
inside each of ``blocks`` bit ranges, and some random ones.  Two fingerprints within r bits
leave at least ``blocks - r`` ranges untouched, so all their distance steps along those ranges'
chains are equal: rows meet on these equal coordinates only (no bucket pairs across the corpus),
pairs whose coordinates differ by more than r anywhere are discarded (triangle inequality),
and survivors are verified on the fingerprints.  Buckets above ``bucket_cap`` rows emit no
pairs: their members meet on the points one flip away (within two bits = a shared point),
which is linear in the bucket and loses no link.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import connected_components, stored

BITS = 64
FINGERPRINT = "bigint"


def text_fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of one text (None or no words: 0)."""
    import numpy as np
    import xxhash

    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    total = np.zeros(BITS, dtype=np.int64)
    for a in range(0, n, 1 << 15):
        part = [xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle]), 42) for i in range(a, min(n, a + (1 << 15)))]
        octets = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    @F.pandas_udf(FINGERPRINT)
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series([text_fingerprint(x, shingle) for x in t], dtype="int64")

    return simhash(text)


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _ranges(blocks: int) -> list[range]:
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    return [range(a, b) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def pivot_fingerprints(blocks: int, extra: int = 16, seed: int = 64) -> tuple[int, list[list[int]], list[int]]:
    """(base, chain of each bit range, random ones): all reference fingerprints."""
    rng = random.Random(seed)
    base = rng.getrandbits(BITS)
    chains = []
    for bits in _ranges(blocks):
        p, chain = base, []
        for i in bits:
            p ^= 1 << i
            chain.append(p)
        chains.append(chain)
    return base, chains, [rng.getrandbits(BITS) for _ in range(extra)]


def pivot_table(fps: DataFrame, blocks: int, extra: int = 16) -> DataFrame:
    """``fp`` -> ``fp, d`` with the Hamming distances to base, chains and random pivots in order."""
    base, chains, rest = pivot_fingerprints(blocks, extra)
    every = [base, *(p for c in chains for p in c), *rest]
    return fps.select("fp", F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(p)))).cast("tinyint")
                                      for p in every]).alias("d"))


def similar_fingerprints(fps: DataFrame, max_bits: int = 2, blocks: int = 3, bucket_cap: int = 64) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints ``fp`` within ``max_bits`` (0 to 2): all pairs
    of ordinary buckets, and for crowded buckets links that give the same components as all their
    pairs.  ``blocks > max_bits``; more blocks make finer buckets for larger corpora and never
    change the components."""
    if not 0 <= max_bits <= 2 or blocks <= max_bits:
        raise ValueError("max_bits is 0, 1 or 2, and blocks is larger")
    ranges = _ranges(blocks)
    chosen = list(combinations(range(blocks), blocks - max_bits))

    def steps(b: int) -> list[Column]:
        at = 1 + ranges[b].start
        return [F.col("d")[i] - F.col("d")[i - 1 if i > at else 0] for i in range(at, at + len(ranges[b]))]

    keys = [F.xxhash64(F.lit(n), *[s for b in c for s in steps(b)]) for n, c in enumerate(chosen)]
    keyed = pivot_table(fps, blocks).select("fp", "d", F.posexplode(F.array(*keys)).alias("way", "key"))
    crowd = keyed.groupBy("way", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(keyed.join(crowd, ["way", "key"]), "pivot-buckets")

    left = met.where(F.col("n") <= bucket_cap).select("way", "key", "fp", "d")
    right = left.select("way", "key", F.col("fp").alias("fq"), F.col("d").alias("e"))
    apart = F.array_max(F.zip_with("d", "e", lambda x, y: F.abs(x.cast("int") - y.cast("int"))))
    near = (left.join(right, ["way", "key"]).where("fp < fq").where(apart <= max_bits)
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("fq"))) <= max_bits)
            .select(F.col("fp").alias("u"), F.col("fq").alias("v")))

    # crowded: the ranges outside the key may differ; meet on the fingerprint or one flip away
    flips = F.array(*[F.array(F.lit(0).cast("bigint"), *[F.lit(_signed(1 << i)).cast("bigint") for b in range(blocks)
                                                         if b not in c for i in ranges[b]]) for c in chosen])
    crowded = met.where(F.col("n") > bucket_cap).select("way", "key", "fp")
    points = (crowded.withColumn("flip", F.explode(F.element_at(flips, F.col("way") + 1)))
              .select("way", "key", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point")))
    if max_bits == 2:  # a shared point links all its members
        lead = points.groupBy("way", "key", "point").agg(F.min("fp").alias("v"))
    else:  # only a member that is the point itself is one bit away
        lead = crowded.select("way", "key", F.col("fp").alias("point"), F.col("fp").alias("v"))
    stars = points.join(lead, ["way", "key", "point"]).where("fp <> v").select(F.col("fp").alias("u"), "v")
    return near.unionByName(stars.distinct())


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_bits: int = 2, blocks: int = 3, bucket_cap: int = 64) -> DataFrame:
    """Per row of ``docs``: ``id, text_hash, fp, component_id`` (smallest id reachable over links of
    ``max_bits`` or fewer differing bits, equal fingerprints included).

    Null or wordless text: fingerprint 0, linked like any other.  Fewer words than ``shingle``:
    one shingle of all words.  Null ids keep their row and never are the smallest id (a component
    of null ids only has a null component id).  Repeated rows are all returned.  Empty table:
    empty result.  Other columns are ignored, whatever their names."""
    text = F.col(text_col)
    rows = stored(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"),
                              fingerprint_column(text, shingle).alias("fp")), "simhash")
    fps = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = connected_components(similar_fingerprints(fps.select("fp"), max_bits, blocks, bucket_cap))
    rooted = (fps.join(roots, fps.fp == roots.node, "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(of, "fp").select("id", "text_hash", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each SimHash component: the smallest id (null ids last, then the
    text's hash), all columns kept."""
    groups = simhash_groups(docs, id_col, text_col, **options)
    best = (groups.groupBy("fp", "component_id").agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "text_hash")).alias("k"))
            .groupBy("component_id").agg(F.min("k").alias("k")))
    # components of null ids only share the null component id: tell them apart by fingerprint
    lone = (groups.where("component_id IS NULL").groupBy("fp")
            .agg(F.min(F.struct(F.lit(True).alias("no"), "id", "text_hash")).alias("k")).select("k"))
    keep = best.where("component_id IS NOT NULL").select("k").unionByName(lone)
    keep = keep.select(F.col("k.id").alias("__keep_id"), F.col("k.text_hash").alias("__keep_hash"))
    held = docs.withColumn("__text_hash", F.xxhash64(F.col(text_col)))
    return (held.join(keep, held[id_col].eqNullSafe(keep["__keep_id"]) & (held["__text_hash"] == keep["__keep_hash"]), "left_semi")
            .dropDuplicates([id_col, "__text_hash"]).drop("__text_hash"))
