"""Symbols of one or several characters become names in one pass."""

from turnstile.functions import text as X
from turnstile.plans.text import SYMBOL_NAMES


def said(spark, names, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    rows = df.select("id", X.replace_sequences("text", names).alias("out")).collect()
    return [r.out for r in sorted(rows, key=lambda r: r.id)]


def test_sequences_take_the_longest(spark):
    got = said(spark, SYMBOL_NAMES, "ok \U0001f44d\U0001f3fd!", "\U0001f44d", "\u2764\ufe0f\u200d\U0001f525\u2764\ufe0f\u2764",
               "a\U0001f468\u200d\U0001f469\u200d\U0001f467b\U0001f44d\U0001f44d", "", None, "plain", "\u00e9")
    assert got == ["ok :thumbs_up_medium_skin_tone:!", ":thumbs_up:", ":heart_on_fire::red_heart::red_heart:",
                   "a:family_man_woman_girl:b:thumbs_up::thumbs_up:", "", None, "plain", ":e_acute:"]


def test_any_table(spark):
    names = {"a": "[x]", "ab": "[y]", "(.*)": "[z]", "x": "a"}
    assert said(spark, names, "abaxab(.*)", "aab") == ["[y][x]a[y][z]", "[x][y]"]  # names are not read again
    assert said(spark, {}, "ab") == ["ab"]
