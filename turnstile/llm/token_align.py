"""Alignment of two tokenizers over the same text, and how often their ids meet.

Both token sequences of a text cover the same bytes.  Per Arrow batch two ``merge_asof`` joins, keyed by
document, give each token start the other side's token that covers it; the union of both directions is
every overlap.  Where overlapping tokens end together a group closes; a group links all its A tokens with
all its B tokens.  A text's links leave Python as distinct id pairs with their number of occurrences,
packed in one integer each, some ``slice_pairs`` at a time.

Documents per id pair are counted by one aggregate over the written pairs.  Few pairs make up most links,
and a pair may stand in every document: pairs above a count, at most ``hot_pairs`` of them, are broadcast;
the rows of all others meet their counts in a shuffle join.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from turnstile.llm.common import stored

TOKENIZER_DIR = "/opt/tokenizers"
BYTE_BPE = f"{TOKENIZER_DIR}/byte_bpe_50k.json"
PIECE_BPE = f"{TOKENIZER_DIR}/piece_bpe_32k.model"
SIDE_B = 1 << 15  # a pair is a * SIDE_B + b
BATCH_CHARS = 1 << 18  # characters tokenised at once: token objects take some hundred bytes each


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable Latin-1 stands for itself, the other
    bytes are the characters from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


#: fixed value: the split of a text before byte-level merges
BYTE_LEVEL_SPLIT = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_ranks(path: str) -> dict[bytes, int] | None:
    """Bytes -> id of a byte-level vocabulary file whose merges are in the order of their ids, so that ids are ranks;
    none for any other file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split, of = spec["model"], spec.get("pre_tokenizer") or {}, byte_alphabet()
    plain = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
             and not spec.get("normalizer") and not model.get("ignore_merges") and not model.get("dropout"))
    if not plain or model.get("type", "BPE") != "BPE":
        return None
    parts = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    ids = [model["vocab"].get(left + right, -1) for left, right in parts]
    base = len(of)
    if ids != list(range(base, base + len(ids))) or any(model["vocab"].get(c, base) >= base for c in of):
        return None
    return {bytes(of[c] for c in token): i for token, i in model["vocab"].items() if i < base + len(ids)}


class Tokenizers:
    """Both tokenizers with the bytes of every id; loaded once per task from the given paths.

    A vocabulary of which ids are ranks is merged by ``tiktoken``, which gives the same ids sooner; texts that it
    refuses, and other vocabularies, go to ``tokenizers``."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel work: no threads, no arenas of theirs
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        of = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        ranks, self.ranked = byte_ranks(a_path), None
        if ranks:
            import tiktoken

            self.ranked = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.spelled = spelled_ids(max(len(self.a_bytes), len(self.b_bytes)))
        if len(self.b_bytes) > SIDE_B or len(self.a_bytes) * SIDE_B > 1 << 31:
            raise ValueError("an id pair has to fit 31 bits")

    def encode_a(self, text: str) -> list[int]:
        if self.ranked is not None:
            try:
                return self.ranked.encode_ordinary(text)
            except Exception:  # noqa: BLE001 - the split can run out of its stack on very long runs of white space
                pass
        return self.a.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none where the text is empty or a side does not spell space + text."""
        a = [self.encode_a(" " + t) for t in texts]
        b = self.b.encode(texts, num_threads=1)
        for i, t in enumerate(texts):
            want = (" " + t).encode()
            if not t or b"".join(map(self.a_bytes.__getitem__, a[i])) != want or b"".join(
                    map(self.b_bytes.__getitem__, b[i])) != want:
                a[i] = b[i] = []
        return a, b


def token_frame(ids: list[list[int]], sizes) -> pd.DataFrame:
    """``doc, id, start, end, i`` of all tokens of a batch; every document has a byte range of its own."""
    import numpy as np

    n = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    flat = np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(n.sum()))
    end = np.cumsum(sizes[flat])
    return pd.DataFrame({"doc": np.repeat(np.arange(len(ids)), n), "id": flat, "start": end - sizes[flat], "end": end,
                         "i": np.arange(len(flat))})


def overlap_frame(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Every overlap once, in order: positions ``i`` (of a) and ``j`` (of b), and ``close`` where both end."""
    import numpy as np

    left, right = a[["doc", "start", "i"]], b[["doc", "start", "i"]].rename(columns={"i": "j"})
    ways = (pd.merge_asof(left, right, on="start", by="doc"), pd.merge_asof(right, left, on="start", by="doc"))
    width = max(len(b), 1)
    met = np.sort(np.concatenate([w["i"].to_numpy(np.int64) * width + w["j"].to_numpy(np.int64) for w in ways]), kind="stable")
    met = met[np.append(True, met[1:] != met[:-1])[:len(met)]]
    i, j = met // width, met % width
    return pd.DataFrame({"i": i, "j": j, "close": a["end"].to_numpy()[i] == b["end"].to_numpy()[j]})


def group_tokens(a: pd.DataFrame, b: pd.DataFrame) -> tuple:
    """Group number of every A and of every B token, from 0 over the whole batch."""
    import numpy as np

    met = overlap_frame(a, b)
    close = met["close"].to_numpy()
    group = np.cumsum(close) - close
    of_a, of_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
    of_a[met["i"].to_numpy()] = group
    of_b[met["j"].to_numpy()] = group
    return of_a, of_b


def _id_runs(group, ids) -> tuple:
    """Distinct ids per group with their number, ordered by group: (group, id, count)."""
    import numpy as np

    key, n = np.unique(group * (1 << 17) + ids, return_counts=True)
    return key >> 17, key & ((1 << 17) - 1), n


def _summed(key, n) -> tuple:
    """Distinct keys in order and the sum of ``n`` of each."""
    import numpy as np

    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    return key[first], np.add.reduceat(n[order], first) if len(first) else n


def pair_slices(doc_of_group, of_a, a_ids, of_b, b_ids, slice_pairs: int) -> Iterator[tuple]:
    """(doc, pair, occurrences), distinct within the batch, in slices of bounded size.

    Inside a group equal ids are one entry, so a group of repeats stays small.  What still exceeds a
    slice is cut by A id: a pair never stands in two slices."""
    import numpy as np

    ga, ia, na = _id_runs(of_a, a_ids)
    gb, ib, nb = _id_runs(of_b, b_ids)
    first = np.searchsorted(gb, ga, side="left")
    width = np.searchsorted(gb, ga, side="right") - first
    # all entries of one (doc, a id) go together
    order = np.lexsort((ia, doc_of_group[ga]))
    ga, ia, na, first, width = ga[order], ia[order], na[order], first[order], width[order]
    doc = doc_of_group[ga]
    new = np.ones(len(ga), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (ia[1:] != ia[:-1])
    starts = np.flatnonzero(new)
    stops = np.append(starts[1:], len(ga))
    total = np.concatenate([[0], np.cumsum(width)])
    at = 0
    while at < len(starts):  # as many whole (doc, a id) runs as fit, one at least
        lo = starts[at]
        nxt = max(at + 1, int(np.searchsorted(total[stops], total[lo] + slice_pairs, side="right")))
        hi = starts[nxt] if nxt < len(starts) else len(ga)
        at = nxt
        parts = []
        while lo < hi:  # one run may itself exceed a slice: its B ids are summed piece by piece (at most the vocabulary)
            cut = max(lo + 1, min(hi, int(np.searchsorted(total, total[lo] + slice_pairs, side="right")) - 1))
            w = width[lo:cut]
            row = np.repeat(np.arange(lo, cut), w)
            col = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(w) - w, w)
            parts.append(_summed((doc[row] << 31) + ia[row] * SIDE_B + ib[col], na[row] * nb[col]))
            lo = cut
        key, total_of = parts[0] if len(parts) == 1 else _summed(*map(np.concatenate, zip(*parts)))
        yield key >> 31, key & ((1 << 31) - 1), total_of


def spelled_ids(n: int):
    """Decimal ids with what follows them: row 0 nothing, then a comma, a bar and a semicolon."""
    import numpy as np

    return np.array([[f"{i}{end}" for i in range(n)] for end in ("", ",", "|", ";")], dtype=object)


def groups_texts(docs: int, a: pd.DataFrame, b: pd.DataFrame, of_a, of_b, spelled) -> list[str]:
    """Per document its groups as ``a1,a2|b1;a3|b2,b3``: both sides in one sequence, each id with its separator."""
    import numpy as np

    part = np.concatenate([2 * of_a, 2 * of_b + 1])  # group and side
    order = np.argsort(part, kind="stable")
    part, doc = part[order], np.concatenate([a["doc"], b["doc"]])[order]
    end = np.ones(len(part), dtype=np.int64)
    last = np.flatnonzero(np.append(part[1:] != part[:-1], True)) if len(part) else part
    end[last] = 2 + part[last] % 2
    bounds = np.searchsorted(doc, np.arange(docs + 1))
    end[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = 0
    words = spelled[end, np.concatenate([a["id"], b["id"]])[order]].tolist()
    return ["".join(words[s:e]) for s, e in zip(bounds, bounds[1:])]


TOTALS = ("n_a", "n_b", "n_groups", "n_links")


def _batch_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("id", id_type), ("row", pa.int64()), ("head", pa.bool_()), *[(c, pa.int64()) for c in TOTALS],
                      ("groups_sha256", pa.string()), ("groups", pa.string()),
                      ("pairs", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])


def align_batch(ids: pa.Array, rows: pa.Array, texts: list[str], tools: Tokenizers, sizes: tuple,
                keep_groups: bool, slice_pairs: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``align_tokens`` for some texts: the first one of a text is its head with the totals,
    more rows carry more of its pairs."""
    import numpy as np

    n = len(texts)
    a, b = (token_frame(x, size) for x, size in zip(tools.encode(texts), sizes))
    of_a, of_b = group_tokens(a, b)
    size_a, size_b = np.bincount(of_a), np.bincount(of_b)
    doc_of_group = np.zeros(len(size_a), dtype=np.int64)
    doc_of_group[of_a] = a["doc"].to_numpy()
    links = np.zeros(n, dtype=np.int64)
    np.add.at(links, doc_of_group, size_a * size_b)
    totals = [np.bincount(a["doc"], minlength=n), np.bincount(b["doc"], minlength=n), np.bincount(doc_of_group, minlength=n), links]
    said = groups_texts(n, a, b, of_a, of_b, tools.spelled)
    digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said]
    schema = _batch_schema(ids.type)

    def part(docs, head, offsets, pairs, counts) -> pa.RecordBatch:
        take = pa.array(docs)
        texts_of = lambda x: pa.array([x[d] if h else None for d, h in zip(docs, head)], pa.string())
        offsets = pa.array(offsets, pa.int32())
        return pa.RecordBatch.from_arrays([
            ids.take(take), rows.take(take), pa.array(head), *[pa.array(np.where(head, x[docs], 0), pa.int64()) for x in totals],
            texts_of(digests), texts_of(said if keep_groups else [None] * n),
            pa.ListArray.from_arrays(offsets, pa.array(pairs, pa.int32())),
            pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))], schema=schema)

    seen = np.zeros(n, dtype=bool)
    for doc, pair, count in pair_slices(doc_of_group, of_a, a["id"].to_numpy(), of_b, b["id"].to_numpy(), slice_pairs):
        here, at = np.unique(doc, return_index=True)
        head = ~seen[here]
        seen[here] = True
        yield part(here, head, np.append(at, len(doc)), pair, count)
    rest = np.flatnonzero(~seen)
    if len(rest):
        yield part(rest, np.ones(len(rest), dtype=bool), np.zeros(len(rest) + 1, dtype=np.int64), [], [])


def align_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str = BYTE_BPE,
                 b_path: str = PIECE_BPE, keep_groups: bool = False, slice_pairs: int = 1 << 20) -> DataFrame:
    """``id, row, head, n_a, n_b, n_groups, n_links, groups_sha256, groups, pairs, counts``: one head row
    per row of ``docs``, and more rows of the same ``row`` number where a text has very many distinct pairs.
    ``pairs`` are the distinct linked id pairs (``a * 32768 + b``), ``counts`` their occurrences; ``groups`` is the
    text of the groups (null unless ``keep_groups``).  Written to the shared folder, so it is computed once.

    No tokens (zeros, empty strings and arrays): null or empty text, and texts of which the joined bytes of a
    side differ from space + text.  Special tokens' strings are plain text.  Null ids and repeated rows keep
    their rows.  Empty table: empty result.  Other columns are ignored, whatever their names.  A text is
    tokenised whole by one task.  The tokenizer files must be at the same path on every executor."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row"),
                         F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        tools = None
        for batch in batches:
            if tools is None:
                tools = Tokenizers(a_path, b_path)
                sizes = tuple(np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (tools.a_bytes, tools.b_bytes))
            sizes_of = pc.utf8_length(batch.column(2)).to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(sizes_of)])
            lo = 0
            while lo < len(batch):  # texts of a bounded total at a time, one at least
                hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + BATCH_CHARS, side="right")) - 1)
                texts = batch.column(2).slice(lo, hi - lo).to_pylist()
                yield from align_batch(batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), texts,
                                       tools, sizes, keep_groups, slice_pairs)
                lo = hi

    out = source.mapInArrow(run, StructType([
        source.schema["id"], *[StructField(c, LongType()) for c in ("row",)], StructField("head", BooleanType()),
        *[StructField(c, LongType()) for c in TOTALS], StructField("groups_sha256", StringType()), StructField("groups", StringType()),
        StructField("pairs", ArrayType(IntegerType())), StructField("counts", ArrayType(LongType()))]))
    return stored(out, "token-align")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: the number of texts that hold an id pair linked, and whether no pair of its A id is
    held by more (ties are all best)."""
    n = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    a_id = F.shiftright("pair", 15).alias("a")
    most = n.groupBy(a_id).agg(F.max("n").alias("most"))  # one row per id of the A vocabulary
    return n.withColumn("a", a_id).join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_scores(aligned: DataFrame, hot_pairs: int = 1 << 18) -> DataFrame:
    """``row, n_best, count_sum`` of every row with a link: the links whose pair is best of its A id, and the sum
    of the pair counts over the links.  ``hot_pairs`` bounds what is broadcast and never changes the result."""
    counts = stored(pair_counts(aligned), "pair-scores")
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count("*").alias("pairs")).collect()  # 63 rows at most
    power, room = 63, hot_pairs
    by_power = {r["power"]: r["pairs"] for r in sizes}
    while power and by_power.get(power - 1, 0) <= room:
        power -= 1
        room -= by_power.get(power, 0)
    is_hot = F.col("n") >= F.lit(1 << power).cast("bigint") if power < 63 else F.lit(False)
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select(
        "row", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("k"))

    def summed(met: DataFrame) -> DataFrame:
        return met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("n_best"),
                                      F.sum(F.col("k") * F.col("n")).alias("count_sum"))

    hot = F.broadcast(counts.where(is_hot))  # at most hot_pairs rows of 13 bytes
    parts = [summed(links.join(hot, "pair"))]
    if power:  # the rest: each pair is held by fewer texts than the hot ones
        cold = links.join(hot.select("pair"), "pair", "left_anti")
        parts.append(summed(cold.join(counts.where(~is_hot).hint("merge"), "pair")))
        return parts[0].unionByName(parts[1]).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return parts[0]


def aligned_documents(docs: DataFrame, hot_pairs: int = 1 << 18, **options) -> DataFrame:
    """The head rows of ``align_tokens`` (same options and edge cases) with ``n_best`` and ``count_sum``, 0 without links."""
    aligned = align_tokens(docs, **options)
    heads = aligned.where("head").drop("pairs", "counts", "head")
    return heads.join(link_scores(aligned, hot_pairs), "row", "left").fillna(0, ["n_best", "count_sum"])
