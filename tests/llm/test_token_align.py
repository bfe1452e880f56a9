"""Alignment against a plain Python version, one document at a time."""

import base64
import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from turnstile.llm import token_align
from turnstile.llm.queries import QUERIES
from turnstile.llm.token_align import align_tokens, aligned_documents

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:  # the same vocabulary, bytes spelled out
        spelled = {int(i): base64.b64decode(t) for t, i in map(bytes.split, f)}
    return a, spelled, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def align(text, tools):
    """[(A ids, B ids)] per group."""
    a_tool, spelled, b_tool = tools
    if not text:
        return []
    want = (" " + text).encode()
    a, b = a_tool.encode(" " + text, add_special_tokens=False).ids, b_tool.encode(text)
    piece = lambda i: (bytes([int(b_tool.id_to_piece(i)[3:5], 16)]) if b_tool.is_byte(i)
                       else b_tool.id_to_piece(i).replace("▁", " ").encode())
    if b"".join(spelled[i] for i in a) != want or b"".join(map(piece, b)) != want:
        return []
    ends = []
    for ids, size in ((a, lambda i: len(spelled[i])), (b, lambda i: len(piece(i)))):
        at, side = 0, {}
        for i in ids:
            at += size(i)
            side[at] = i
        ends.append(side)
    out, left = [], [[], []]
    for at in range(1, len(want) + 1):
        for k in (0, 1):
            if at in ends[k]:
                left[k].append(ends[k][at])
        if at in ends[0] and at in ends[1]:
            out.append(tuple(left))
            left = [[], []]
    assert left == [[], []]
    return out


def expect(rows, tools):
    groups = [align(t, tools) for _, t in rows]
    links = [Counter((x, y) for g, h in of for x in g for y in h) for of in groups]
    held = Counter(p for c in links for p in c)
    best = {}
    for (x, _), n in held.items():
        best[x] = max(n, best.get(x, 0))
    out = []
    for (d, _), of, c in zip(rows, groups, links):
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in of)
        out.append((d, sum(len(g) for g, _ in of), sum(len(h) for _, h in of), len(of), sum(c.values()),
                    sum(k for p, k in c.items() if held[p] == best[p[0]]), sum(k * held[p] for p, k in c.items()),
                    hashlib.sha256(said.encode()).hexdigest() if said else ""))
    return out


def got(df):
    return [(r.id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()]


def test_query_against_plain_python(spark, tools):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op12_token_alignment"](spark, SF)
    assert sorted(got(rows.withColumnRenamed("doc_id", "id"))) == sorted(expect(docs, tools))


HARD = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, "\U0001f600\U0001f468‍\U0001f469 naïve 日本語テキスト"),
    (6, "tab\tand\n\nlines   and      spaces\r\n"), (7, "<|endoftext|><s></s><unk><0x41>"), (8, "a▁b"),
    (9, "\x00\x01\x7f control"), (10, "é combining"), (10, "repeated id"), (10, "repeated id"), (None, "null id"),
    (11, " " * 300 + "x" * 300), (12, "日" * 400), (13, "the the the the"), (14, "กำ้ thai กำ"),
]


@pytest.mark.parametrize("hot,slices", [(1 << 18, 1 << 20), (0, 7), (20, 1)])
def test_hard_texts_whatever_the_split(spark, tools, hot, slices):
    docs = spark.createDataFrame(HARD, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS pair", "3 AS id", "4 AS n")
    rows = aligned_documents(docs, hot_pairs=hot, slice_pairs=slices)
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(got(rows), key=key) == sorted(expect(HARD, tools), key=key)


def test_groups_text_and_batches(spark, tools, monkeypatch):
    monkeypatch.setattr(token_align, "BATCH_CHARS", 40)
    rows = [(i, f"word{i} naïve " * (i + 1)) for i in range(12)]
    out = align_tokens(spark.createDataFrame(rows, "doc_id long, text string"), keep_groups=True)
    for r in out.where("head").collect():
        of = align(rows[r.id][1], tools)
        assert r.groups == ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in of)
        links = Counter((x << 15 | y) for g, h in of for x in g for y in h)
        assert dict(zip(r.pairs, r.counts)) == links


def test_empty_table_and_text_ids(spark):
    docs = spark.createDataFrame([("x", "some text")], "doc_id string, text string")
    assert aligned_documents(docs).first().id == "x"
    assert aligned_documents(docs.limit(0)).count() == 0
    assert aligned_documents(docs.selectExpr("doc_id", "CAST(NULL AS string) AS text")).first().count_sum == 0


def test_very_long_text(spark, tools):
    rows = [(1, "lorem ipsum dolor, " * 40000), (2, "lorem ipsum")]
    assert sorted(got(aligned_documents(spark.createDataFrame(rows, "doc_id long, text string")))) == sorted(expect(rows, tools))


def test_ranked_ids_equal_the_tokenizer():
    """The sooner path gives the vocabulary file's own ids, on texts of any script and on very long runs."""
    import random

    both = token_align.Tokenizers(token_align.BYTE_BPE, token_align.PIECE_BPE)
    assert both.ranked is not None
    rng = random.Random(5)
    pools = ["abcdefgh   \n\t'", "\u00e4\u00f6\u4e2d\u6587\u0e01\u0e33 \u200d\U0001f469\u2028\u00a0", "0123.,;!?<|endoftext|> 's't're",
             "".join(map(chr, range(1, 0x250))), "\u0301\u0300e\u00b2\u2167\u3000 \x85\x1c"]
    texts = ["".join(rng.choice(pools[k % 5] if k % 2 else "".join(pools)) for _ in range(rng.randrange(1, 400))) for k in range(600)]
    texts += ["a" * 60_000, " " * 300_000, "\n \t" * 40_000, "<|endoftext|>" * 50, "x" + " " * 50_000 + "y", "it's 'll '" * 3]
    want = [e.ids for e in both.a.encode_batch(texts, add_special_tokens=False)]
    assert [both.encode_a(t) for t in texts] == want


def test_other_vocabularies_keep_their_tokenizer():
    assert token_align.byte_ranks(public_tokenizers.path("word_bpe_49k.json")) is None
