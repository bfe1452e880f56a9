import random
import re

import numpy as np
from pyspark.sql import functions as F

from turnstile.llm.html_tree import extract_main_text, labelled_pages, trained_model
from turnstile.llm.pii_crf import KINDS, Tagger, all_spans, base_spans, find_personal_data, labelled_texts, luhn, tag_texts, trained_tagger, valid
from turnstile.llm.quality_fm import FactorisationMachine, text_features, with_quality
from turnstile.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


# --- quality ---
def test_held_out_accuracy(spark):
    rows = QUERIES["op2_quality_fm"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert all(r.predicted for r in rows if r.quality == 1) or sum(not r.predicted for r in rows if r.quality) <= 0.02 * len(rows)


def test_pairwise_identity():
    fm = FactorisationMachine()
    fm.w += 0.1
    ids, x = text_features("one two two three\nfour!", 24.0)
    pairs = sum(float(fm.v[a] @ fm.v[b]) * xa * xb for k, (a, xa) in enumerate(zip(ids, x)) for b, xb in list(zip(ids, x))[:k])
    assert abs(fm.logit(ids, x) - (fm.bias + float(fm.w[ids] @ x) + pairs)) < 1e-4


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, None), (None, "", 3), (2, "a b", -5), (2, "a b", -5), (3, "w" * 100_000, 7), (4, "x " * 30_000, 1)],
                                 "doc_id bigint, text string, n_chars bigint").withColumn("__label", F.lit(1)).withColumn("quality", F.lit(0))
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (4, 1), (77, 0)], "doc_id bigint, quality int")
    got = with_quality(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in with_quality(docs, labels.limit(0)).collect()}
    assert len(empty) == 1 and abs(empty.pop() - 0.75) < 1e-6
    assert with_quality(docs.limit(0), labels).count() == 0
    assert with_quality(docs.drop("n_chars"), labels).count() == 6


# --- personal data ---
def plain(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern in (("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if (14 <= len(d) <= 19 and luhn(d)) if kind == "card" else 10 <= len(d) <= 15:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_plain_patterns():
    r = random.Random(1)
    for _ in range(20_000):
        t = "".join(r.choices("a1@.-+ ()%9é\n", weights=[3, 6, 2, 4, 2, 1, 2, 1, 1, .2, 4, .3, .2], k=r.randint(0, 60)))
        assert sorted(plain(t)) == sorted(base_spans(t)), t


def test_long_runs_are_linear():
    for t in ("1" * 200_000, "a" * 300_000, "a@" * 100_000, "+1 " * 100_000, "1.1." * 50_000, "." * 200_000):
        base_spans(t)


def test_decode_is_viterbi():
    tagger = Tagger(4)
    rng = np.random.default_rng(2)
    tagger.p["trans"], tagger.p["start"] = rng.normal(0, 1, (5, 5)).astype("f"), rng.normal(0, 1, 5).astype("f")
    e = rng.normal(0, 1, (5, 40, 5)).astype("f")
    best = tagger.decode(e)
    for b in range(40):
        def value(path):
            return tagger.p["start"][path[0]] + sum(e[t, b, k] for t, k in enumerate(path)) + sum(
                tagger.p["trans"][i, j] for i, j in zip(path, path[1:]))
        top = max(value(p) for p in np.ndindex(*[5] * 5))
        assert abs(value(best[:, b]) - top) < 1e-4


def test_gradient_trains_and_generalises():
    x, y = labelled_texts(300, 256, seed=99)
    model = trained_tagger()
    path = model.decode(model.scores(np.ascontiguousarray(x.T))).T
    assert (path == y).mean() > 0.97
    for k in range(1, 5):
        assert ((path == k) & (y == k)).sum() > 0.8 * (y == k).sum()


def test_scores_are_those_of_the_training_step():
    from turnstile.llm import pii_crf as P
    codes = np.ascontiguousarray(labelled_texts(20, 60, seed=4)[0].T)
    codes[40:, :9] = 0  # padding
    p = Tagger().p
    states, _ = P._lstm(codes, p["wx_f"], p["wh_f"])
    got = P._lstm_scores(codes, p["wx_f"], p["wh_f"], p["out"][:8])
    assert np.abs(got - (states @ p["out"][:8]).transpose(0, 2, 1)).max() < 1e-5


def test_only_labelled_windows_are_followed_back():
    tagger = Tagger(4)
    rng = np.random.default_rng(6)
    tagger.p["trans"] = rng.normal(0, 1, (5, 5)).astype("f")
    e = rng.normal(0, 1, (30, 60, 5)).astype("f")
    e[:, ::2, 0] += 20  # label 0 alone; the others have some labels
    e[::3, 1::4, 0] += 20

    class Kept(np.ndarray):
        def take(self, at, axis=None, **more):
            widths.append(len(at))
            return np.asarray(self).take(at, axis=axis, **more)

    full = np.empty((30, 60), int)
    score = [e[0].T]
    trans, widths = tagger.p["trans"], []
    for t in range(1, 30):
        score.append((score[-1][:, None] + trans[:, :, None]).max(axis=0) + e[t].T)
    full[-1] = score[-1].argmax(axis=0)
    for t in range(28, -1, -1):
        full[t] = (score[t] + trans[:, full[t + 1]]).argmax(axis=0)
    tagger.p["trans"] = trans.view(Kept)
    assert (tagger.decode(e) == full).all() and not full[:, ::2].any()
    assert widths and set(widths) == {int(full.any(axis=0).sum())}


def test_addresses_are_sought_among_digits_only(monkeypatch):
    from turnstile.llm import pii_crf as P
    base = base_spans("at 10.0.0.1.2.3.4.5.6 and 1.2.3 or 300.1.1.1, 007.1.2.3")
    assert base == [("ip", 3, 11), ("ip", 12, 19), ("ip", 46, 55)]
    monkeypatch.setattr(P, "_IP", None)
    assert base_spans("write to jo@mail.com. no digits") == [("email", 9, 20)]


def test_windows_agree_on_long_texts():
    text = "lorem ipsum dolor. " * 40 + "write to jo dot smith at mail dot com now or call +1 (555) 555-1234. " + "sit amet " * 60
    found = []
    for pad in (0, 37, 111, 170):
        t = "x" * pad + " " + text
        labels = next(tag_texts(trained_tagger(), [t]))
        base, added = all_spans(t, labels)
        found.append((len(base), [t[a:b] for _, a, b in base]))
    assert all(f == found[0] for f in found) and found[0][0] == 1


def test_added_spans_pass_their_check():
    assert valid("email", "jo at mail dot com") and not valid("email", "hello there")
    assert valid("ip", "10[.]0[.]0[.]1") and not valid("ip", "1.2.3.999")
    assert not valid("card", "1234567890123456") and valid("phone", "(555) 555-1234")


def test_pii_edges(spark):
    rows = [(1, None), (None, ""), (2, "a@b.co"), (2, "a@b.co"), (3, "9" * 100_000), (4, "mail x@y.org " + "w " * 50_000 + "+1 (555) 555-1234")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("pii", F.lit(1)).withColumn("base", F.lit(2))
    got = [(r.doc_id, sorted((s.kind, s.start, s.end) for s in r.pii.base)) for r in find_personal_data(df).collect()]
    assert sorted(got, key=repr) == sorted([(i, sorted(plain(t or ""))) for i, t in rows], key=repr)
    assert find_personal_data(df.limit(0)).count() == 0
    assert set(KINDS) == {"email", "ip", "card", "phone"}


# --- html ---
def test_unseen_labelled_pages():
    model = trained_model()
    pages = labelled_pages(200, seed=77)
    assert sum(model.text(html) == main for html, main, *_ in pages) >= 0.9 * len(pages)


def test_marginals_equal_enumeration():
    model = trained_model()
    for html, _, nodes, _ in labelled_pages(40, seed=5):
        from turnstile.llm.html_tree import node_features
        if len(nodes) > 12:
            nodes = nodes[:12]
        feats = node_features(nodes)
        content, _ = model.beliefs(nodes, feats)
        total, ones = 0.0, np.zeros(len(nodes))
        for labels in np.ndindex(*[2] * len(nodes)):
            s = sum(model.theta[f] for y, fs in zip(labels, feats) if y for f in fs)
            s += sum(model.edge[model.kind(n)][labels[n.parent]][labels[k]] for k, n in enumerate(nodes) if k)
            p = np.exp(s - 40)
            total += p
            ones += p * np.array(labels)
        assert np.allclose(ones / total, content, atol=1e-6)


def test_html_edges(spark):
    deep = "<div>" * 3000 + "<p>deep words are here.</p>"
    rows = [(1, None), (None, ""), (2, "no markup"), (3, "<p>"), (4, deep), (5, "<script>var a = '<p>x</p>'"), (6, "<!-- open"), (7, "</div></p>&amp;&nosuch;"),
            (8, "<article><h1>T &amp; U</h1><p>One\n two<br>three.</p><p>" + "word " * 50_000 + "</p></article>"), (8, "<article><p>x y.</p></article>")]
    df = spark.createDataFrame(rows, "page_id bigint, html string").withColumn("text", F.lit(9)).withColumn("url", F.lit(None))
    got = extract_main_text(df).collect()
    assert len(got) == len(rows) and all(r.text is not None for r in got)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r.text)
    model = trained_model()
    assert model.text("<html><head><title>T<body><article><h1>A title</h1><p>Some words, here.</p></article>") == "A title Some words, here."
    assert model.text("<article><p>One, two.</p><select><option>a<option>b<p>Three, four.</p></article>") == "One, two. Three, four."
    assert by[1] == [""] and by[None] == [""] and by[5] == [""] and by[6] == [""]
    assert any(t.startswith("T & U One two three. word word") for t in by[8])
    assert extract_main_text(df.limit(0)).count() == 0


def test_html_has_no_caps():
    from turnstile.llm.html_tree import page_tree

    names = " ".join(f"word{'abcdefghijklmnopqrstuvwxyz'[k % 26]}{k}" for k in range(40))
    node = next(n for n in page_tree(f'<body><div class="{names}" id="comments">x</div>') if n.tag == "div")
    assert "comments" in node.names and len(node.names) == 1 + 2 * 40
    # an open paragraph is found under any number of open blocks, a stray end tag closes nothing
    deep = "<body><section>" + "<x-y>" * 200 + "</article></p>text"
    assert [n.tag for n in page_tree(deep)].count("x-y") == 200
    nodes = page_tree("<body><p>" + "<x-y>" * 200 + "<p>second")
    assert [n.parent for n in nodes if n.tag == "p"] == [nodes.index(next(n for n in nodes if n.tag == "body"))] * 2
    text = lambda html: ["".join(n.text) for n in page_tree(html) if n.text]
    assert text("<body><p>The sum is <math><mi>x</mi><annotation>t</annotation></math> here</p>") == ["The sum is x here"]
    assert text("<div>a</div>" * 100 + "<head><title>T</title></head><p>b</p>")[-1] == "b"


def test_broken_deep_pages_cost_linear_time():
    import time

    from turnstile.llm.html_tree import page_tree

    def seconds(n):
        t = time.process_time()
        page_tree("<body><td>" + "<x-y>" * n + "</em></article></q><p>a" * n)
        return time.process_time() - t

    seconds(1000)
    assert seconds(40_000) < 60 * max(seconds(4_000), 0.01)
