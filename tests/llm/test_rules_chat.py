import random

from pyspark.sql import functions as F

from turnstile.llm.chat import END, START, format_conversations, loss_text
from turnstile.llm.rule_ledger import POLICIES, RULES, ablations, apply_policy, rule_bit, rule_ledger

from .brute import SPLIT


def repeat_words(words):
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)})


def test_measures_equal_brute_force(spark):
    r = random.Random(1)
    texts = [None, "", " \t\n", "a b c d e a b c d e", "x\x0bé y z", "A\nA\n\n \nB\nA", "#" * 9, "w " * 30_000, "q" * 50_000]
    texts += ["".join(r.choices(["a ", "b ", "c\n", "DD ", "é# ", "\t"], k=r.randint(0, 60))) for _ in range(150)]
    df = spark.createDataFrame([(i if i % 7 else None, t) for i, t in enumerate(texts)], "doc_id bigint, text string").withColumn(
        "w", F.lit(1)).withColumn("id", F.lit(2)).withColumn("fail_bits", F.lit("x")).withColumn("n_words", F.lit(3))
    got = [tuple(x[1:6]) for x in rule_ledger(df).select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()]
    want = []
    for t in texts:
        t = t or ""
        w = SPLIT.findall(t)
        lines = [x for x in t.split("\n") if SPLIT.search(x)]
        want.append((len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeat_words(w)))
    assert sorted(got) == sorted(want)
    assert rule_ledger(df.limit(0)).count() == 0
    kept = apply_policy(rule_ledger(df), "v2").where("kept AND n_words > 3")  # a filter copies no measuring
    assert len(kept._jdf.queryExecution().optimizedPlan().toString()) < 60_000
    assert kept.count() == sum(r.kept and r.n_words > 3 for r in apply_policy(rule_ledger(df), "v2").collect())


def test_policies_and_ablations(spark):
    bits = [0, 1, 2, 4, 5, 7, 64, 0, 128]
    led = spark.createDataFrame([(i, b) for i, b in enumerate(bits)], "id bigint, fail_bits bigint")
    for policy, rules in POLICIES.items():
        mask = sum(map(rule_bit, rules))
        assert [r.kept for r in apply_policy(led, policy).orderBy("id").collect()] == [b & mask == 0 for b in bits]
        got = {r.rule: (r.rejected, r.only, r.kept_without) for r in ablations(led, policy).collect()}
        for rule in rules:
            x = rule_bit(rule)
            assert got[rule] == (sum(b & x != 0 for b in bits), sum(b & mask == x for b in bits), sum(b & (mask ^ x) == 0 for b in bits))
        assert got[None][0] == sum(b & mask != 0 for b in bits)
    assert len(RULES) < 63


def test_chat_round_trip(spark):
    r = random.Random(3)
    bits = [START, END, "<|esc|>", "<|", "|>", "~", "~t", "~p", "~n", "\n", "a", "é", "\\", "assistant", " ", "<", "|"]
    rows = [(c, t, r.choice(["user", "assistant", "system", "a\nb", "x<|esc|>", "~n", "", None]), r.choice(
        [None, "", "".join(r.choices(bits, k=r.randint(0, 12)))])) for c in range(60) for t in range(r.randint(1, 6))]
    rows += [(0, 0, "user", "same"), (0, 0, "user", "same"), (None, None, "assistant", "x" * 100_000), (None, 1, "user", START)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("turns", F.lit(1)).withColumn(
        "rendered", F.lit("z")).withColumn("formatted", F.lit(None))
    out = format_conversations(df).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans"), F.col("turns")))
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    got = {x.conv_id: x for x in out.collect()}
    assert got.keys() == want.keys()
    for c, turns in want.items():
        turns = [(a, b) for _, a, b in sorted(turns)]
        assert [(x.role, x.text) for x in got[c].turns] == turns
        assert got[c].loss == "".join(b for a, b in turns if a == "assistant")
        assert got[c].formatted.count(START) == len(turns)
    assert format_conversations(df.limit(0)).count() == 0
