"""Fill-in-the-middle: cuts by words of eight bytes against a tokeniser, and exact round trips."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnstile.llm import fim_swar
from turnstile.llm.fim_swar import fill_in_middle, restore_text, unit_cuts


def units(text):
    return re.findall(r"[A-Za-z]+|[^A-Za-z]", text, flags=re.S)


def plain_cuts(texts, one, two):
    out = []
    for t, a, b in zip(texts, one, two):
        u = units(t or "")
        a, b = sorted((a % (len(u) + 1), b % (len(u) + 1)))
        out.append((len(u), len("".join(u[:a])), len("".join(u[:b]))))
    return out


def cuts(array, one, two):
    return [tuple(map(int, r)) for r in zip(*unit_cuts(array, np.array(one), np.array(two)))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet=st.one_of(
    st.sampled_from("abzAZ@[`{ \n019éÿĀ日￿\U0001f600"), st.characters(exclude_categories=["Cs"])))),
    st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1)), max_size=8), st.booleans(), st.integers(1, 5))
def test_cuts_equal_the_tokeniser(rows, large, block):
    texts, one, two = [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]
    array = pa.array(["skipped é", *texts], pa.large_string() if large else pa.string())[1:]  # an array with an offset
    before, fim_swar.BLOCK_WORDS = fim_swar.BLOCK_WORDS, block
    try:
        assert cuts(array, one, two) == plain_cuts(texts, one, two)
    finally:
        fim_swar.BLOCK_WORDS = before


def test_every_rank_of_long_texts():
    rng = random.Random(3)
    text = "".join(rng.choice(["word", "Ab", " ", ",", "é", "日", "\U0001f600", "\n"]) for _ in range(5000))
    n = len(units(text))
    texts, one = [text] * (n + 1) + ["x"], [*range(n + 1), 1]
    assert cuts(pa.array(texts), one, one) == plain_cuts(texts, one, one)


def by_hand(doc_id, text, plain=10, spm=20):
    text = text or ""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i:8 * i + 8], 16) for i in range(4)]
    u = units(text)
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return len(u), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(u), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(u), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


EDGES = [(None, "null id"), (1, None), (2, ""), (3, " "), (4, "a <P> b"), (5, "<M>"), (6, "< P><S <M"), (7, "<<S<<P<M<"), (8, "word"),
         (8, "word"), (8, "same id"), (9, "naïve \U0001f600\U0001f600 日本"), (10, "x" * 100000), (11, "ab, " * 50000), (-5, "minus")]


@pytest.mark.parametrize("plain,spm", [(10, 20), (0, 100), (0, 0), (100, 50)])
def test_edges_and_round_trip(spark, plain, spm):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string").selectExpr("*", "1 AS h", "2 AS cut", "3 AS row", "4 AS form", "5 AS output")
    out = fill_in_middle(docs, plain_percent=plain, spm_percent=spm)
    assert out.columns == [*docs.columns, "fim"]
    out = out.withColumn("back", restore_text(F.col("fim.output"), F.col("fim.form"))).collect()
    assert len(out) == len(EDGES)
    for r in out:
        assert tuple(r.fim) == by_hand(r.doc_id, r.text, plain, spm), (r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert fill_in_middle(docs.limit(0)).count() == 0


def test_text_ids_other_names_and_marks(spark):
    docs = spark.createDataFrame([("k", "some text. more"), ("l", "x")], "`a.b` string, body string")
    out = fill_in_middle(docs, "a.b", "body", into="cut", plain_percent=0, marks=("[P]", "[SUF]", "[M]"))
    back = restore_text(F.col("cut.output"), F.col("cut.form"), ("[P]", "[SUF]", "[M]"))
    assert out.where(back != F.col("body")).count() == 0
    with pytest.raises(ValueError):
        fill_in_middle(docs, "a.b", "body", marks=("<P>", "<P>", "<M>"))
