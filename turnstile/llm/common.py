"""Helpers shared by the operators: shared-folder tables and connected components."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.session import scratch_dir

WORD_SEPARATORS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the lineage,
    survives lost executors, and keeps column pruning for later readers."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_stored(df: DataFrame) -> None:
    """Remove the files behind a ``stored`` table that nothing reads any more."""
    spark = df.sparkSession
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _star_step(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over undirected edges ``(u, v)``, ``u > v``.

    large: every neighbour above a node links to the node's smallest neighbour (or itself);
    small: a node and its smaller neighbours link to the smallest of them."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = both.join(low, "u")
    if large:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(low.select("u", F.col("m").alias("v"))))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` (long, undirected) -> ``(node, root)``: the smallest node reachable.

    Alternating large-star / small-star steps: the work per step is linear in the edges, a node
    with very many links is summed by partial aggregates, and the number of steps grows with the
    logarithm of the component size.  Each round is written to the shared checkpoint folder; it
    runs until the edges are stars (no round limit).  No edges: an empty result."""
    cur = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct(), "cc")
    state = None
    while True:
        new = stored(_star_step(_star_step(cur, large=True), large=False), "cc")
        now = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        delete_stored(cur)
        cur = new
        if now == state or not now[0]:
            break
        state = now
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))


def free_shuffles(spark: SparkSession) -> None:
    """Let the driver notice that finished plans are garbage, so that executors drop their shuffle files
    before the next phase writes its own."""
    gc.collect()
    spark._jvm.System.gc()


def hash_bitmap(hashes: DataFrame, column: str, bits: int):
    """numpy uint64 words of a bitmap with the bit ``hash mod bits`` set for every row.

    ``bits`` (a power of two, at least 32768) is a parameter, so what comes to the driver and goes to the tasks
    has the same size for any input: a filter that lets some hashes pass in vain, but loses none."""
    import numpy as np

    value = F.pmod(F.col(column), F.lit(bits).cast("bigint")) + 1
    # to the bucket's place first: partial bitmaps of every task would move 4 KB a bucket each
    parts = (hashes.select(F.bitmap_bucket_number(value).alias("k"), F.bitmap_bit_position(value).alias("p"))
             .repartition("k").groupBy("k").agg(F.bitmap_construct_agg("p").alias("b")).collect())  # bits / 32768 rows
    words = np.zeros(bits // 64, dtype=np.uint64)
    for r in parts:
        words[(r["k"] - 1) * 512:r["k"] * 512] = np.frombuffer(bytes(r["b"]), dtype="<u8")
    return words


def in_bitmap(words, hashes):
    """Which of the uint64 ``hashes`` have their bit set."""
    import numpy as np

    b = hashes & np.uint64(64 * len(words) - 1)
    return (words[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63)) & np.uint64(1)).astype(bool)
