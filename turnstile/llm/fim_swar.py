"""Fill-in-the-middle: texts cut at random units, the parts put in prefix-suffix-middle or
suffix-prefix-middle order.

A unit is a run of ASCII letters or any other single character.  Units are counted and found without
tokenising: the UTF-8 bytes of a whole Arrow batch are viewed as little-endian 64-bit words, and
arithmetic on all eight bytes of a word at once marks those that end a unit.  ``bitwise_count`` per
word and its running sum give the rank of any byte; the k-th unit of a text is found by a search for
its word in the running sum and a multiplication that counts the marks inside the word.
The drawing, the cutting and the output are JVM expressions; only positions come from Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = ("<P>", "<S>", "<M>")
LANES = 0x0101010101010101  # one in every byte of a word
TOPS = 0x8080808080808080  # the top bit of every byte
BLOCK_WORDS = 1 << 19


def text_bytes(texts: pa.Array) -> tuple:
    """(uint64 words padded with zeros, first byte of each text and the end) of an Arrow string array, nulls empty."""
    import numpy as np

    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype="<i8" if wide else "<i4")[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    size = int(at[-1] - at[0])
    words = np.zeros(size // 8 + 2, dtype="<u8")
    if size:
        words.view(np.uint8)[:size] = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]]
    return words, at - at[0]


def _letters(w):
    """Top bit of every byte that is an ASCII letter: range tests by additions that never leave a byte."""
    import numpy as np

    low = (w | np.uint64(0x20 * LANES)) & np.uint64(0x7F * LANES)
    return (low + np.uint64((0x80 - 0x61) * LANES)) & ~(low + np.uint64((0x80 - 0x7B) * LANES)) & ~w & np.uint64(TOPS)


def unit_marks(words, ends) -> tuple:
    """(unit marks, character marks): the top bit of each byte that ends a unit, or a character.
    ``ends`` are the last bytes of the texts, which end both whatever follows."""
    import numpy as np

    units, chars = np.empty_like(words), np.empty_like(words)
    tops = np.uint64(TOPS)
    for a in range(0, len(words), BLOCK_WORDS):
        w = words[a:a + BLOCK_WORDS]
        after = np.zeros_like(w)
        after[:-1] = w[1:]
        if a + len(w) < len(words):
            after[-1] = words[a + len(w)]
        after = w >> np.uint64(8) | after << np.uint64(56)  # each byte's successor
        chars[a:a + len(w)] = ~(after & ~(after << np.uint64(1))) & tops  # not followed by a 10xxxxxx byte
        units[a:a + len(w)] = chars[a:a + len(w)] & ~(_letters(w) & _letters(after))
    np.bitwise_or.at(units, ends >> 3, np.uint64(0x80) << (ends.astype(np.uint64) & np.uint64(7)) * np.uint64(8))
    return units, chars


class Marked:
    """Rank and select over the marked bytes of words."""

    def __init__(self, marks):
        import numpy as np

        self.marks = marks
        self.below = np.zeros(len(marks) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.below[1:])

    def rank(self, at):
        """Marked bytes before byte ``at``."""
        import numpy as np

        inside = (np.uint64(1) << (at.astype(np.uint64) & np.uint64(7)) * np.uint64(8)) - np.uint64(1)
        return self.below[at >> 3] + np.bitwise_count(self.marks[at >> 3] & inside)

    def select(self, k):
        """The byte of the ``k``-th mark (from 0)."""
        import numpy as np

        word = np.searchsorted(self.below, k, side="right") - 1
        want = (k - self.below[word] + 1).astype(np.uint64)
        upto = (self.marks[word] >> np.uint64(7)) * np.uint64(LANES)  # marks in bytes 0..i, in byte i
        enough = ((upto | np.uint64(TOPS)) - want * np.uint64(LANES)) & np.uint64(TOPS)
        return 8 * word + 8 - np.bitwise_count(enough)


CUTS = "struct<n: bigint, first: bigint, second: bigint>"


def unit_cuts(texts: pa.Array, draw1, draw2) -> tuple:
    """Per text: number of units n, and the characters before the smaller and the larger of
    ``draw % (n + 1)`` units."""
    import numpy as np

    words, at = text_bytes(texts)
    start, stop = at[:-1], at[1:]
    units, chars = unit_marks(words, (stop - 1)[stop > start])
    unit, char = Marked(units), Marked(chars)
    base = unit.rank(start)
    n = unit.rank(stop) - base
    one, two = draw1 % (n + 1), draw2 % (n + 1)
    out = [n]
    for k in (np.minimum(one, two), np.maximum(one, two)):
        cut = np.array(start)
        some = k > 0
        cut[some] = unit.select(base[some] + k[some] - 1) + 1
        out.append(char.rank(cut) - char.rank(start))
    return tuple(out)


def _cuts_column(text: Column, draw1: Column, draw2: Column) -> Column:
    @F.arrow_udf(CUTS)
    def cuts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for t, a, b in batches:
            n, first, second = unit_cuts(t, a.to_numpy(zero_copy_only=False), b.to_numpy(zero_copy_only=False))
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64())],
                                             names=["n", "first", "second"])

    return cuts(text, draw1, draw2)


def draws(id_col: Column, seed: str = "1:") -> list[Column]:
    """Four unsigned 32-bit draws of a row: the first hex groups of the SHA-256 of seed and decimal id."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", into: str = "fim",
                   plain_percent: int = 10, spm_percent: int = 20, marks: tuple[str, str, str] = MARKS,
                   seed: str = "1:") -> DataFrame:
    """``docs`` with a struct column ``into``: ``n`` (units), ``form`` (plain, psm or spm),
    ``prefix_chars, middle_chars`` (characters, null if plain) and ``output``.

    Null text counts as empty; an empty text, one that holds a mark, and ``plain_percent`` of the rest
    stay plain: the output is the text.  A null id draws like an empty one.  Rows of one id and text are
    all returned, with equal results.  Empty table: empty result.  Whole texts of any length are read, a
    batch at a time; other columns, whatever their names, stay.  ``marks`` may not overlap themselves or
    each other: each starts with a character that occurs nowhere else in any of them."""
    if len({m[0] for m in marks}) != 1 or len(set(marks)) != 3 or any(marks[0][0] in m[1:] for m in marks):
        raise ValueError("marks are three different strings that start with one character and hold it once")
    # the row's own columns travel in one struct, so that no name can clash
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(every, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), F.array(*draws(F.col(f"`{id_col}`"), seed)).alias("h"))
    cut = rows.withColumn("cut", _cuts_column(F.col("text"), F.col("h")[0], F.col("h")[1]))
    text, h, first, second = F.col("text"), F.col("h"), F.col("cut.first").cast("int"), F.col("cut.second").cast("int")
    held = text == ""
    for m in marks:
        held = held | F.contains(text, F.lit(m))
    form = F.when(held | (h[2] % 100 >= 100 - plain_percent), "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    parts = cut.select("row", "text", "cut", form.alias("form"), F.array(
        F.substring(text, F.lit(1), first), F.substring(text, first + 1, second - first),
        F.substring(text, second + 1, F.length(text))).alias("part"))
    (p, s, m), part = map(F.lit, marks), F.col("part")
    lead = F.when(F.col("form") == "psm", F.concat(p, part[0], s, part[2])).otherwise(F.concat(s, part[2], p, part[0]))
    parts = parts.withColumn("output", F.when(F.col("form") == "plain", text).otherwise(F.concat(lead, m, part[1])))
    moved = F.col("form") != "plain"
    return parts.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != into], F.struct(
        F.col("cut.n").alias("n"), F.col("form"), F.when(moved, F.col("cut.first")).alias("prefix_chars"),
        F.when(moved, F.col("cut.second") - F.col("cut.first")).alias("middle_chars"), F.col("output")).alias(into))


def restore_text(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text from output and form alone: the first occurrence of each mark is the mark itself."""
    p, s, m = marks
    second = F.when(form == "psm", F.lit(s)).otherwise(F.lit(p))
    one = F.call_function("substring_index", output, second, F.lit(1))  # the first mark and what follows it
    tail = F.substring(output, F.length(one) + F.length(second) + 1, F.length(output))
    two = F.substring_index(tail, m, 1)
    middle = F.substring(tail, F.length(two) + len(m) + 1, F.length(output))
    one = F.substring(one, F.when(form == "psm", len(p)).otherwise(len(s)) + 1, F.length(output))
    return (F.when(form == "plain", output).when(form == "psm", F.concat(one, middle, two))
            .otherwise(F.concat(two, middle, one)))
