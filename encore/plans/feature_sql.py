"""SQL (DuckDB) mirror of the feature families, generated from the same spec.

This is the oracle side of the correctness check: the families are written
independently as plain conditional aggregates, window functions and joins.
"""

from __future__ import annotations

import math

from .. import constants as K
from ..operators.geo import GeoConfig
from ..spec import HistorySpec, suffix
from .bind_sql import ctes

DEG = repr(math.pi / 180.0)


def norm(x: str) -> str:
    return f"lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'))"


def num(x: str) -> str:
    return f"TRY_CAST({x} AS DOUBLE)"


def blank_to(x: str, d: str) -> str:
    return f"(CASE WHEN length({x}) = 0 THEN '{d}' ELSE {x} END)"


def nullif_blank(x: str) -> str:
    return f"(CASE WHEN {x} = '' THEN NULL ELSE {x} END)"


def poisoned(x: str) -> str:
    return f"(CASE WHEN count({x}) < count(*) THEN NULL ELSE CAST(sum({x}) AS DOUBLE) END)"


def with_ctes(spec: HistorySpec, names: list[str], extra: list[str], body: str) -> str:
    b = ctes(spec)
    parts = [b[n] for n in names] + extra
    return "WITH " + ",\n".join(parts) + "\n" + body


# ------------------------------------------------------------------ families

def acc_cte(spec: HistorySpec) -> str:
    y = f"substr(first_donated, 1, 4)"
    return f"""acc0 AS (
  SELECT account_id,
    {num('amount_donated_2013')} AS amount_donated_2013,
    {num('amount_donated_lifetime')} AS amount_donated_lifetime,
    {num('no_donations_lifetime')} AS no_donations_lifetime,
    CAST({spec.reference_year} AS DOUBLE) - {num(f"(CASE WHEN {y} = '' THEN '{spec.reference_year}' ELSE {y} END)")} AS years_donating,
    CASE WHEN coalesce(regexp_matches(billing_zip_code, '[A-Za-z]'), false) THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS is_us,
    {norm('billing_city')} AS billing_city,
    {norm('relationship')} AS relationship,
    CAST(row_number() OVER (ORDER BY account_id) AS DOUBLE) AS account_num
  FROM accounts),
acc_f AS (
  SELECT *,
    CAST(amount_donated_2013 > 0 AS DOUBLE) AS add_donated_2013,
    CAST(amount_donated_2013 > 0 AS DOUBLE) * no_donations_lifetime AS add_no_donations_lifetime_if_donated_2013,
    CASE WHEN no_donations_lifetime = 0 THEN 0.0 ELSE amount_donated_lifetime / no_donations_lifetime END AS add_avg_donation,
    CAST(amount_donated_2013 > 0 AS DOUBLE) *
      (CASE WHEN no_donations_lifetime = 0 THEN 0.0 ELSE amount_donated_lifetime / no_donations_lifetime END)
      AS add_avg_donation_if_donated_2013
  FROM acc0)"""


def prog_cte(spec: HistorySpec, how: str = "sum") -> str:
    seasons = ", ".join(f"'{s}'" for s in list(spec.history_seasons) + [spec.target_season])
    cols = ", ".join(f"{how}({num(c)}) AS {c}" for c in spec.composers)
    return f"""prog AS (SELECT season, {cols} FROM programme WHERE season IN ({seasons}) GROUP BY season)"""


def subs_t_cte(spec: HistorySpec) -> str:
    nums = ", ".join(f"{num(v)} AS {v}" for v in spec.subs_numeric)
    facs = ", ".join(f"{norm(v)} AS {v}" for v in spec.subs_factors)
    return f"""subs_t AS (SELECT account_id, season, {nums}, {facs} FROM subscriptions)"""


def subs_cte(spec: HistorySpec, weighted: bool = True) -> str:
    cells = []
    for v in spec.subs_numeric:
        for s in spec.history_seasons:
            cells.append(f"max(CASE WHEN s.season = '{s}' THEN s.{v} END) AS {v}_{suffix(s)}")
    for v in spec.subs_factors:
        for s in spec.history_seasons:
            cells.append(f"max(CASE WHEN s.season = '{s}' THEN s.{v} END) AS {v}_{suffix(s)}")
    for c in spec.preference_composers:
        x = f"p.{c} * s.total" if weighted else f"p.{c}"
        cells.append(f"{poisoned(x)} AS conc_{c}")
    body = ",\n    ".join(cells)
    return f"""subs_f AS (
  SELECT s.account_id,
    {body}
  FROM (SELECT * FROM subs_t WHERE season <> '{spec.target_season}') s LEFT JOIN prog p ON s.season = p.season
  GROUP BY s.account_id)"""


def tick_r_cte() -> str:
    pl = blank_to("price_level", "1")
    return f"""tick_r AS (
  SELECT account_id, season, {blank_to('"set"', '0')} AS "set",
    {num(f"(CASE WHEN length({pl}) > 1 THEN '1' ELSE {pl} END)")} AS price_level,
    {num(blank_to('no_seats', '1'))} AS no_seats
  FROM tickets),
tick_dup AS (SELECT coalesce(max(c), 0) > 1 AS dup FROM (SELECT count(*) AS c FROM tick_r GROUP BY account_id, season, "set") d)"""


def tick_cte(spec: HistorySpec) -> str:
    cells = []
    for s in spec.ticket_seasons:
        cells.append(f"CAST(count(CASE WHEN season = '{s}' THEN 1 END) AS DOUBLE) AS add_tickets_total_{suffix(s)}")
    for s in spec.ticket_seasons:
        x = f"CASE WHEN season = '{s}' THEN no_seats END"
        cells.append(f"CASE WHEN count({x}) < count(CASE WHEN season = '{s}' THEN 1 END) THEN NULL "
                     f"ELSE coalesce(sum({x}), 0.0) END AS add_tickets_seats_{suffix(s)}")
    for v in spec.ticket_values:
        for s in spec.ticket_seasons:
            for t in spec.ticket_sets:
                c = f"season = '{s}' AND \"set\" = '{t}'"
                cells.append(f"CASE WHEN (SELECT dup FROM tick_dup) THEN CAST(count(CASE WHEN {c} THEN 1 END) AS DOUBLE) "
                             f"ELSE max(CASE WHEN {c} THEN {v} END) END AS add_{v}_{suffix(s)}_{t}")
    body = ",\n    ".join(cells)
    return f"""tick_f AS (
  SELECT account_id,
    {body}
  FROM tick_r GROUP BY account_id)"""


def att_long_cte(spec: HistorySpec) -> str:
    u = "\n  UNION ALL ".join(f"SELECT account_id, '{s}' AS season, \"{s}\" AS attended FROM attended"
                             for s in spec.ticket_seasons)
    return f"""att_long AS (
  {u})"""


def missed_cte(spec: HistorySpec) -> str:
    cols = ",\n    ".join(f"{poisoned('p.' + c)} AS conc_missed_{c}" for c in spec.missed_composers)
    return f"""missed_f AS (
  SELECT m.account_id,
    {cols}
  FROM (SELECT account_id, season FROM att_long WHERE {num('attended')} = 0) m LEFT JOIN prog p ON m.season = p.season
  GROUP BY m.account_id)"""


def geo_ctes(cfg: GeoConfig = GeoConfig()) -> str:
    z1 = "(CASE WHEN length(billing_zip_code) = 4 THEN lpad(billing_zip_code, 5, '0') ELSE billing_zip_code END)"
    z2 = f"(CASE WHEN length({z1}) = 10 THEN split_part({z1}, '-', 1) ELSE {z1} END)"
    dist = []
    for name, lat, lon in K.VENUES:
        la0, lo0 = lat * (math.pi / 180.0), lon * (math.pi / 180.0)
        x0, y0, z0 = math.cos(la0) * math.cos(lo0), math.cos(la0) * math.sin(lo0), math.sin(la0)
        la, lo = f"(Lat * {DEG})", f"(Long * {DEG})"
        dot = f"(cos({la}) * cos({lo}) * {x0!r} + cos({la}) * sin({lo}) * {y0!r} + sin({la}) * {z0!r})"
        dist.append(f"{K.EARTH_RADIUS_MILES!r} * acos(CASE WHEN {dot} > 1 THEN 1.0 WHEN {dot} < -1 THEN -1.0 ELSE {dot} END) AS {name}")
    g = cfg.grid_deg
    return f"""g1 AS (
  SELECT account_id, {nullif_blank(z2)} AS billing_zip_code, {nullif_blank('billing_city')} AS billing_city FROM accounts),
g2 AS (SELECT *, CAST(billing_zip_code IS NULL AND billing_city IS NULL AS DOUBLE) AS missing FROM g1),
dir AS (SELECT CASE WHEN length(Zipcode) < 5 THEN lpad(Zipcode, 5, '0') ELSE Zipcode END AS Zipcode,
               City, State, CAST(Lat AS DOUBLE) AS Lat, CAST(Long AS DOUBLE) AS Long FROM directory),
g3 AS (SELECT g2.*, d.City, d.State, d.Lat, d.Long FROM g2 LEFT JOIN dir d ON g2.billing_zip_code = d.Zipcode),
home AS (SELECT DISTINCT lower(trim(City)) AS hc FROM g3 WHERE State = '{K.HOME_STATE}' AND lower(trim(City)) IS NOT NULL),
g4 AS (SELECT g3.account_id, g3.billing_zip_code, g3.billing_city, g3.missing, g3.City,
              CASE WHEN g3.billing_zip_code IS NULL AND home.hc IS NOT NULL THEN '{K.HOME_STATE}' ELSE g3.State END AS State,
              g3.Lat, g3.Long
       FROM g3 LEFT JOIN home ON lower(trim(g3.billing_city)) = home.hc),
g5 AS (SELECT *, {", ".join(dist)} FROM g4),
cells AS (SELECT floor(Lat / {g}) AS cy, floor(Long / {g}) AS cx, count(*) AS accounts
          FROM g5 WHERE Lat IS NOT NULL AND Long IS NOT NULL GROUP BY 1, 2),
hot AS (SELECT cy, cx, 'Yes' AS hotspot FROM cells WHERE accounts >= {cfg.hot_min_accounts}),
geo_all AS (SELECT g5.*, coalesce({nullif_blank('hot.hotspot')}, '{K.HOTSPOT_DEFAULT}') AS hotspot
            FROM g5 LEFT JOIN hot ON floor(g5.Lat / {g}) = hot.cy AND floor(g5.Long / {g}) = hot.cx),
geo_f AS (SELECT account_id, Lat, Long, dSF, dPeninsula, dBerkley, missing, State, City, hotspot FROM geo_all)"""


def feature_names(spec: HistorySpec) -> tuple[list[str], list[str]]:
    """(numeric columns, factor columns) of the joined table before derived columns."""
    acc = ["amount_donated_2013", "amount_donated_lifetime", "no_donations_lifetime", "years_donating", "is_us",
           "account_num", "add_donated_2013", "add_no_donations_lifetime_if_donated_2013", "add_avg_donation",
           "add_avg_donation_if_donated_2013"]
    subs_num = [f"{v}_{suffix(s)}" for v in spec.subs_numeric for s in spec.history_seasons]
    subs_fac = [f"{v}_{suffix(s)}" for v in spec.subs_factors for s in spec.history_seasons]
    conc = [f"conc_{c}" for c in spec.preference_composers]
    tick = ([f"add_tickets_total_{suffix(s)}" for s in spec.ticket_seasons]
            + [f"add_tickets_seats_{suffix(s)}" for s in spec.ticket_seasons]
            + [f"add_{v}_{suffix(s)}_{t}" for v in spec.ticket_values for s in spec.ticket_seasons
               for t in spec.ticket_sets])
    missed = [f"conc_missed_{c}" for c in spec.missed_composers]
    geo_num = ["Lat", "Long", "dSF", "dPeninsula", "dBerkley", "missing"]
    numeric = acc + subs_num + conc + tick + missed + geo_num
    factors = ["billing_city", "relationship"] + subs_fac + ["State", "City", "hotspot"]
    return numeric, factors


def derived_sql(spec: HistorySpec) -> list[tuple[str, str]]:
    t = lambda s: f"total_{suffix(s)}"
    out = []
    last4 = spec.last(4)
    for s in reversed(last4):
        out.append((f"was_{suffix(s)}_subscription_outside_city",
                    f"coalesce(CAST(billing_city = location_{suffix(s)} AS DOUBLE) * CAST({t(s)} > 0 AS DOUBLE), 0.0)"))
    for s in last4:
        out.append((f"adjusted_total_{suffix(s)}", f"{t(s)} + add_tickets_total_{suffix(s)}"))
    def mean(cols):
        return "(" + " + ".join(cols) + f") / {float(len(cols))!r}"
    def var(cols):
        m = mean(cols)
        return "(" + " + ".join(f"({c} - {m}) * ({c} - {m})" for c in cols) + f") / {float(len(cols) - 1)!r}"
    def const(cols):
        return "TRUE" if len(cols) == 1 else f"(least({', '.join(cols)}) = greatest({', '.join(cols)}))"
    for n in spec.windows:
        cols = [t(s) for s in spec.last(n)]
        out.append((f"avg_{n}_years", mean(cols)))
        out.append((f"var_{n}_years", var(cols)))
    for n in spec.windows:
        cols = [t(s) for s in spec.last(n)]
        out.append((f"avg_{n}_years_if_no_var", f"{mean(cols)} * CAST({const(cols)} AS DOUBLE)"))
    allt = [t(s) for s in spec.history_seasons]
    tick = [f"add_tickets_total_{suffix(s)}" for s in spec.ticket_seasons]
    out.append(("ever_bought_subs", f"CAST(({' + '.join(allt)}) > 0 AS DOUBLE)"))
    out.append(("num_bought_subs", " + ".join(f"CAST({c} > 0 AS DOUBLE)" for c in allt)))
    out.append(("ever_bought_ticket", f"CAST(({' + '.join(tick)}) > 0 AS DOUBLE)"))
    out.append(("num_bought_ticket", " + ".join(f"CAST({c} > 0 AS DOUBLE)" for c in tick)))
    return out


def feature_ctes(spec: HistorySpec, cfg: GeoConfig = GeoConfig()) -> list[str]:
    """CTEs ending in ``features`` (one row per account, all columns)."""
    numeric, factors = feature_names(spec)
    wide_cols = (["a.account_id"] + [f"coalesce({c}, 0.0) AS {c}" for c in numeric] + list(factors))
    # qualify ambiguous column origins through the joins
    joined = f"""wide AS (
  SELECT {", ".join(wide_cols)}
  FROM acc_f a LEFT JOIN subs_f USING (account_id) LEFT JOIN tick_f USING (account_id)
       LEFT JOIN missed_f USING (account_id) LEFT JOIN geo_f USING (account_id))"""
    der = ",\n    ".join(f"{e} AS {n}" for n, e in derived_sql(spec))
    derived = f"""wide2 AS (SELECT *,
    {der}
  FROM wide)"""
    final_cols = (["account_id"] + numeric + [f"coalesce({c}, '{K.NA_LEVEL}') AS {c}" for c in factors]
                  + [n for n, _ in derived_sql(spec)])
    final = f"""features AS (SELECT {", ".join(final_cols)} FROM wide2)"""
    return [acc_cte(spec), prog_cte(spec), subs_t_cte(spec), subs_cte(spec), tick_r_cte(), tick_cte(spec),
            att_long_cte(spec), missed_cte(spec), geo_ctes(cfg), joined, derived, final]


FEATURE_INPUTS = ["accounts", "subscriptions", "tickets", "programme", "attended", "directory"]


def feature_sql(spec: HistorySpec, select: str = "SELECT * FROM features", extra: list[str] | None = None) -> str:
    return with_ctes(spec, FEATURE_INPUTS + ["train_labels", "to_score"], feature_ctes(spec) + (extra or []), select)


def all_feature_columns(spec: HistorySpec) -> list[str]:
    numeric, factors = feature_names(spec)
    return ["account_id"] + numeric + factors + [n for n, _ in derived_sql(spec)]
