"""Chat formatting with a grammar round trip.

A turn is written ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``.  The parser is deterministic: turns
start at ``<|im_start|>``, the role ends at the first line break, the text ends at the turn's last
``<|im_end|>`` line.  Every turn is written plainly first, reparsed, and compared with its source;
where role or text do not come back the turn is written escaped (role marked by ``<|esc|>``), and
reparsed again.  Escaping is reversible: ``~`` becomes ``~t``, ``<|`` becomes ``~p``, and in roles
a line break becomes ``~n``, so no control string is left inside.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, ESCAPED = "<|im_start|>", "<|im_end|>", "<|esc|>"


def _replace(c: Column, *pairs: tuple[str, str]) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape(c: Column) -> Column:
    return _replace(c, ("~", "~t"), ("<|", "~p"), ("\n", "~n"))


def unescape(c: Column) -> Column:
    return _replace(c, ("~n", "\n"), ("~p", "<|"), ("~t", "~"))


def escape_text(c: Column) -> Column:
    return _replace(c, ("~", "~t"), ("<|", "~p"))


def unescape_text(c: Column) -> Column:
    return _replace(c, ("~p", "<|"), ("~t", "~"))


def write_turn(role: Column, text: Column, escaped: bool) -> Column:
    if escaped:
        return F.concat(F.lit(START), escape(role), F.lit(ESCAPED + "\n"), escape_text(text), F.lit(END + "\n"))
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse_turns(rendered: Column) -> Column:
    """array<struct<role, text, raw, escaped>> of a formatted string (raw: the text as written)."""
    chunks = F.split(rendered, r"<\|im_start\|>")
    body = F.slice(chunks, 2, F.greatest(F.size(chunks) - 1, F.lit(0)))

    def one(x: Column) -> Column:
        head = F.substring_index(x, "\n", 1)
        rest = F.substr(x, F.length(head) + 2)
        raw = F.substr(rest, F.lit(1), F.length(rest) - len(END) - 1)
        esc = F.endswith(head, F.lit(ESCAPED))
        named = F.substr(head, F.lit(1), F.length(head) - len(ESCAPED))
        return F.struct(F.when(esc, unescape(named)).otherwise(head).alias("role"),
                        F.when(esc, unescape_text(raw)).otherwise(raw).alias("text"),
                        raw.alias("raw"), esc.alias("escaped"))

    return F.transform(body, one)


def format_turns(turns: DataFrame, role_col: str = "role", text_col: str = "text", into: str = "rendered") -> DataFrame:
    """``turns`` with the column ``into``: each row's turn in the template, escaped where the plain
    form would not parse back to the same role and text.  Null role or text: empty."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    # a plain turn can only read differently if a control string is inside, or the role has a line break
    plain = write_turn(role, text, False)
    suspect = F.contains(F.concat(role, text), F.lit("<|")) | F.contains(role, F.lit("\n"))
    back = parse_turns(plain)
    same = ~suspect | ((F.size(back) == 1) & (back[0]["role"] == role) & (back[0]["text"] == text)
                       & ~F.contains(text, F.lit(END)))
    return turns.withColumn(into, F.when(same, plain).otherwise(write_turn(role, text, True)))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conv_id, formatted, turns, loss_spans``: one row per conversation; ``turns`` are read back from
    ``formatted`` by the parser, ``loss_spans`` are the code point ranges (start, end exclusive)
    of the texts whose role is in ``loss_roles``.

    Turns go by number (nulls first; ties by role, then text, repeated rows all kept); null ids form
    one conversation; an empty table gives no rows.  Only the four named columns are read.  The
    result is one string per conversation, so a conversation has to fit a row."""
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    one = format_turns(t).select("conv_id", F.struct("turn", "role", "text", "rendered").alias("s"))
    c = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("s")).alias("s"))
    c = c.select("conv_id", F.array_join(F.col("s")["rendered"], "").alias("formatted"))
    c = c.withColumn("turns", parse_turns(F.col("formatted")))
    size = lambda x: F.length(x["raw"])

    def step(a: Column, x: Column) -> Column:
        # the header's written role: escaped roles are longer than the role itself
        head = F.length(F.when(x["escaped"], F.concat(escape(x["role"]), F.lit(ESCAPED))).otherwise(x["role"]))
        begin = a["at"] + len(START) + head + 1
        return F.struct((begin + size(x) + len(END) + 1).alias("at"), F.when(
            x["role"].isin(*loss_roles), F.concat(a["spans"], F.array(F.struct(
                begin.alias("start"), (begin + size(x)).alias("end"))))).otherwise(a["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    spans = F.aggregate("turns", F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda a: a["spans"])
    return c.withColumn("loss_spans", spans)


def loss_text(formatted: Column, spans: Column, turns: Column, loss_roles: tuple[str, ...] = ("assistant",)) -> Column:
    """All text under the loss mask, cut from ``formatted`` by its spans and unescaped, without separators."""
    flags = F.transform(F.filter(turns, lambda x: x["role"].isin(*loss_roles)), lambda x: x["escaped"])
    cut = F.zip_with(spans, flags, lambda s, e: F.when(
        e, unescape_text(F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))
    ).otherwise(F.substr(formatted, s["start"] + 1, s["end"] - s["start"])))
    return F.array_join(cut, "")
