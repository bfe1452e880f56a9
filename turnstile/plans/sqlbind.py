"""The role bindings of ``sources.tables`` written as DuckDB CTEs.

Oracle queries start with ``WITH`` + the CTEs they need; the Spark side reads
the same roles through ``turnstile.sources.tables``.
"""

REVIEWS = """reviews AS (
  SELECT o_orderkey AS review_id, CAST(o_orderdate AS DATE) AS written_date,
         o_orderstatus AS branch, 1 + o_orderkey % 5 AS rating,
         (o_totalprice % 200 - 100) / 100 AS polarity
  FROM orders)"""

VISITS = """visits AS (
  SELECT event_id, user_id AS visitor, ts, event_type AS ride, value AS wait
  FROM events)"""

WAITS = VISITS + """,
waits AS (
  SELECT date_trunc('hour', ts) AS slot, ride, max(wait) AS wait
  FROM visits GROUP BY 1, 2)"""

ATTENDANCE = """attendance AS (
  SELECT CAST(ts AS DATE) AS day, event_type AS facility,
         count(DISTINCT user_id) AS attendance
  FROM events GROUP BY 1, 2)"""

SURVEY = """survey AS (
  SELECT c.c_custkey AS respondent, c.c_mktsegment AS segment, c.c_acctbal AS score,
         c.c_nationkey AS nationkey, d.n_name AS nation, d.r_name AS region
  FROM customer c LEFT JOIN (
    SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
  ) d ON c.c_nationkey = d.n_nationkey)"""


def values_cte(name: str, columns: list[str], rows: list[tuple], types: list[str]) -> str:
    """A literal table as ``name(cols) AS (SELECT CAST(...) ... FROM (VALUES ...))``."""
    def lit(v, t):
        if v is None:
            return f"CAST(NULL AS {t})"
        if t == "DATE":
            return f"DATE '{v}'"
        if t == "VARCHAR":
            return "'" + str(v).replace("'", "''") + "'"
        return f"CAST({v!r} AS {t})"
    body = ",\n    ".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types, strict=True)) + ")"
                          for r in rows)
    cols = ", ".join(columns)
    return f"{name} AS (SELECT * FROM (VALUES\n    {body}) AS t({cols}))"


def with_ctes(body: str, *ctes: str) -> str:
    """``WITH`` + CTEs + body; a body that starts with more CTEs is joined
    with a comma."""
    is_select = body.lstrip().upper().startswith("SELECT")
    if not ctes:
        return body if is_select else "WITH " + body
    return "WITH " + ", ".join(ctes) + ("\n" if is_select else ",\n") + body
