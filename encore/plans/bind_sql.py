"""The driver-table binding of ``encore.sources.bind`` written as SQL CTEs (DuckDB dialect).

Used only by the oracle queries; kept rule-for-rule identical to the Spark binding.
"""

from __future__ import annotations

from ..spec import SEASON_SHIFT, HistorySpec


def season_expr(ts: str, spec: HistorySpec | None = None) -> str:
    if spec is None or spec.period_months == 12:
        y = f"(year({ts}) + {spec.first_start - 1995 if spec else SEASON_SHIFT})"
    else:
        y = f"(((year({ts}) - 1995) * 12 + month({ts}) - 1) // {spec.period_months} + {spec.first_start})"
    return f"(CAST({y} AS VARCHAR) || '-' || CAST({y} + 1 AS VARCHAR))"


def ctes(spec: HistorySpec) -> dict[str, str]:
    so = season_expr("o.o_orderdate", spec)
    named = [f"p_type = '{c}'" if spec.composer_by == "p_type" else f"p_partkey % {len(spec.composers)} = {i}" for i, c in enumerate(spec.composers)]
    comps = ",\n    ".join(
        f"CAST(sum(CASE WHEN {w} THEN 1 ELSE 0 END) AS VARCHAR) AS {c}" for w, c in zip(named, spec.composers))
    att_inner = ", ".join(
        f"max(CASE WHEN {season_expr('o_orderdate', spec)} = '{s}' THEN 1 ELSE 0 END) AS \"{s}\""
        for s in spec.ticket_seasons)
    att_outer = ", ".join(f"CAST(coalesce(a.\"{s}\", 0) AS VARCHAR) AS \"{s}\"" for s in spec.ticket_seasons)
    zipn = "CAST(c.c_nationkey * 400 + 1000 AS VARCHAR)"
    return {
        "accounts": f"""accounts AS (
  SELECT c.c_custkey AS account_id,
    CASE WHEN c.c_custkey % 5 = 0 THEN {zipn}
         WHEN c.c_custkey % 5 = 1 THEN lpad({zipn}, 5, '0')
         WHEN c.c_custkey % 5 = 2 THEN lpad({zipn}, 5, '0') || '-1234'
         WHEN c.c_custkey % 5 = 3 THEN 'K1A 0A9' ELSE '' END AS billing_zip_code,
    CASE WHEN c.c_custkey % 7 = 0 THEN ''
         ELSE ' ' || upper(substr(n.n_name, 1, 1)) || lower(substr(n.n_name, 2)) || '  ' END AS billing_city,
    c.c_mktsegment AS relationship,
    CASE WHEN c.c_custkey % 3 = 0 THEN CAST(CAST(floor(greatest(c.c_acctbal, 0.0) / 3) AS BIGINT) AS VARCHAR)
         ELSE '0' END AS amount_donated_2013,
    CAST(CAST(floor(greatest(c.c_acctbal, 0.0)) AS BIGINT) AS VARCHAR) AS amount_donated_lifetime,
    CASE WHEN c.c_custkey % 11 = 10 THEN 'n/a' ELSE CAST(c.c_custkey % 5 AS VARCHAR) END AS no_donations_lifetime,
    CASE WHEN c.c_custkey % 4 = 0 THEN '' ELSE CAST(1985 + c.c_custkey % 16 AS VARCHAR) || '-03-15' END AS first_donated
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
        "subscriptions": f"""subscriptions AS (
  SELECT o.o_custkey AS account_id, {so} AS season,
    CASE WHEN min(substr(o.o_orderpriority, 1, 1)) = '5' THEN '' ELSE min(substr(o.o_orderpriority, 1, 1)) END AS price_level,
    CAST(CAST(floor(sum(o.o_totalprice) / 100000) AS BIGINT) AS VARCHAR) AS no_seats,
    CAST(count(*) AS VARCHAR) AS total,
    min(o.o_orderstatus) AS package,
    min(CASE WHEN o.o_orderkey % 3 <> 0 THEN n.n_name ELSE 'other' END) AS location,
    max(o.o_orderpriority) AS section,
    CASE WHEN count(*) > 1 THEN 'yes' ELSE 'no' END AS multiple_subs
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
       LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY o.o_custkey, {so})""",
        "tickets": f"""tickets AS (
  SELECT o.o_custkey AS account_id, {so} AS season, CAST(l.l_linenumber AS VARCHAR) AS "set",
    CASE WHEN l.l_returnflag = 'A' THEN '2' WHEN l.l_returnflag = 'N' THEN '' ELSE '3x' END AS price_level,
    CASE WHEN l.l_quantity > 45 THEN '' ELSE CAST(CAST(trunc(l.l_quantity) AS BIGINT) AS VARCHAR) END AS no_seats
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
        "programme": f"""programme AS (
  SELECT season, "set",
    {comps}
  FROM (SELECT {so} AS season, CAST(l.l_linenumber AS VARCHAR) AS "set", p.p_type, p.p_partkey
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
             JOIN part p ON l.l_partkey = p.p_partkey
        WHERE year(o.o_orderdate) >= 1996) x
  GROUP BY season, "set")""",
        "attended": f"""attended AS (
  SELECT c.c_custkey AS account_id, {att_outer}
  FROM customer c LEFT JOIN (SELECT o_custkey, {att_inner} FROM orders GROUP BY o_custkey) a
       ON c.c_custkey = a.o_custkey)""",
        "directory": """directory AS (
  SELECT CAST(n.n_nationkey * 400 + 1000 AS VARCHAR) AS Zipcode, n.n_name AS City,
    CASE WHEN n.n_nationkey < 5 THEN 'CA' ELSE r.r_name END AS State,
    CAST(37.0 AS DOUBLE) + n.n_nationkey * CAST(0.1 AS DOUBLE) AS Lat,
    CAST(-122.0 AS DOUBLE) - n.n_nationkey * CAST(0.2 AS DOUBLE) AS Long
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)""",
        "train_labels": f"""train_labels AS (
  SELECT c.c_custkey AS account_id, CAST(coalesce(t.n, 0) AS DOUBLE) AS total
  FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders o
                             WHERE {so} = '{spec.target_season}' GROUP BY o_custkey) t
       ON c.c_custkey = t.o_custkey)""",
        "to_score": """to_score AS (SELECT c_custkey AS account_id FROM customer)""",
    }
