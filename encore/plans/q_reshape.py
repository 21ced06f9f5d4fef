"""Registered queries: melts, casts, pivots, programme and preference aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aggregate as A
from ..operators.repair import repair_tickets, type_subscriptions
from ..operators.reshape import cast_wide, melt, pivot_agg
from ..sources.bind import read_bundle
from ..spec import binding_spec, suffix
from .common import rounded
from .feature_sql import (att_long_cte, missed_cte, norm, num, prog_cte, subs_cte, subs_t_cte, tick_cte,
                          tick_r_cte, with_ctes)
from .registry import query

SPEC = binding_spec()
HIST = list(SPEC.history_seasons)


def _subs_sql(select: str, extra: list[str] | None = None) -> str:
    return with_ctes(SPEC, ["subscriptions", "programme"],
                     [prog_cte(SPEC), subs_t_cte(SPEC), subs_cte(SPEC)] + (extra or []), select)


def _num_cells() -> list[str]:
    return [f"{v}_{suffix(s)}" for v in SPEC.subs_numeric for s in HIST]


def _fac_cells() -> list[str]:
    return [f"{v}_{suffix(s)}" for v in SPEC.subs_factors for s in HIST]


@query("subscription_season_cells", covers=("C22", "R2", "R3", "F1", "C9", "P1"),
       sql=lambda: _subs_sql("SELECT account_id, " + ", ".join(_num_cells()) + " FROM subs_f"))
def subscription_season_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric subscription history: melt (several ids) then cast to variable_season cells."""
    b = read_bundle(spark, sf_dir)
    subs = type_subscriptions(b.subscriptions).where(F.col("season") != SPEC.target_season)
    long = melt(subs, ["account_id", "season"], list(SPEC.subs_numeric), cast="double")
    cells = [(f"{v}_{suffix(s)}", {"variable": v, "season": s}, "value") for v in SPEC.subs_numeric for s in HIST]
    return cast_wide(long, "account_id", cells, keys_for_check=["account_id", "variable", "season"])


@query("subscription_factor_cells", covers=("R5", "C1", "C8"),
       sql=lambda: _subs_sql("SELECT account_id, " + ", ".join(f"coalesce({c}, '__NA__') AS {c}" for c in _fac_cells())
                             + " FROM subs_f"))
def subscription_factor_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categorical subscription history (normalised text) cast wide; gaps as an NA level."""
    b = read_bundle(spark, sf_dir)
    subs = type_subscriptions(b.subscriptions).where(F.col("season") != SPEC.target_season)
    long = melt(subs, ["account_id", "season"], list(SPEC.subs_factors), cast="string")
    cells = [(f"{v}_{suffix(s)}", {"variable": v, "season": s}, "value") for v in SPEC.subs_factors for s in HIST]
    wide = cast_wide(long, "account_id", cells, keys_for_check=["account_id", "variable", "season"])
    return wide.select("account_id", *[T.na_level(c).alias(c) for c, _, _ in cells])


def _tick_sql(select: str) -> str:
    return with_ctes(SPEC, ["tickets"], [tick_r_cte(), tick_cte(SPEC)], select)


@query("ticket_season_pivots", covers=("A1", "A2", "C2", "C3", "C9"),
       sql=lambda: _tick_sql("SELECT account_id, " + ", ".join(
           [f"add_tickets_total_{suffix(s)}" for s in SPEC.ticket_seasons]
           + [f"add_tickets_seats_{suffix(s)}" for s in SPEC.ticket_seasons]) + " FROM tick_f"))
def ticket_season_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets per account and season (count) and seats (sum); absent seasons -> 0."""
    t = repair_tickets(read_bundle(spark, sf_dir).tickets)
    seasons = list(SPEC.ticket_seasons)
    n = pivot_agg(t, "account_id", "season", seasons, "count",
                  names=[f"add_tickets_total_{suffix(s)}" for s in seasons])
    s = pivot_agg(t, "account_id", "season", seasons, "sum", "no_seats",
                  names=[f"add_tickets_seats_{suffix(s)}" for s in seasons])
    return n.join(s, "account_id", "inner")


def _tick_cells() -> list[str]:
    return [f"add_{v}_{suffix(s)}_{t}" for v in SPEC.ticket_values for s in SPEC.ticket_seasons
            for t in SPEC.ticket_sets]


@query("ticket_set_cells", covers=("R2", "R4", "A3", "Q2", "P11"),
       sql=lambda: _tick_sql("SELECT account_id, " + ", ".join(_tick_cells()) + " FROM tick_f"))
def ticket_set_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets melted by (account, season, set) and cast to add_variable_season_set cells.

    (account, season, set) repeats in this data, so every cell is a count."""
    t = repair_tickets(read_bundle(spark, sf_dir).tickets)
    long = melt(t, ["account_id", "season", "set"], list(SPEC.ticket_values), cast="double")
    long = long.withColumn("prefix", F.lit("add"))
    cells = [(f"add_{v}_{suffix(s)}_{st}", {"prefix": "add", "variable": v, "season": s, "set": st}, "value")
             for v in SPEC.ticket_values for s in SPEC.ticket_seasons for st in SPEC.ticket_sets]
    return cast_wide(long, "account_id", cells)


def _prog_sql(how: str) -> str:
    return with_ctes(SPEC, ["programme"], [prog_cte(SPEC, how)],
                     "SELECT season, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SPEC.composers)
                     + " FROM prog")


@query("programme_composition", covers=("A4", "C9"), sql=lambda: _prog_sql("sum"))
def programme_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season x composer: concert counts summed over the season's sets."""
    return A.programme_by_season(read_bundle(spark, sf_dir).programme, SPEC, "sum")


@query("programme_composition_max", covers=("A5",), sql=lambda: _prog_sql("max"))
def programme_composition_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unweighted variant: the largest set count per season and composer."""
    return A.programme_by_season(read_bundle(spark, sf_dir).programme, SPEC, "max")


def _pref_sql(weighted: bool) -> str:
    cols = ", ".join(f"round(conc_{c}, 6) AS conc_{c}" for c in SPEC.preference_composers)
    return with_ctes(SPEC, ["subscriptions", "programme"],
                     [prog_cte(SPEC), subs_t_cte(SPEC),
                      subs_cte(SPEC, weighted).replace("subs_f AS", "pref AS")],
                     f"SELECT account_id, {cols} FROM pref")


@query("composer_preferences", covers=("P4", "A6", "J2", "Q3", "P6"), sql=lambda: _pref_sql(True))
def composer_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per account: sum over seasons of programme count x subscriptions (null when a season has no programme)."""
    b = read_bundle(spark, sf_dir)
    prog = A.programme_by_season(b.programme, SPEC)
    return rounded(A.composer_preferences(type_subscriptions(b.subscriptions), prog, SPEC))


@query("composer_preferences_unweighted", covers=("A7",), sql=lambda: _pref_sql(False))
def composer_preferences_unweighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same without the subscription weight."""
    b = read_bundle(spark, sf_dir)
    prog = A.programme_by_season(b.programme, SPEC)
    return rounded(A.composer_preferences(type_subscriptions(b.subscriptions), prog, SPEC, weight_by_total=False))


@query("missed_composer_preferences", covers=("A8", "F2", "R7", "J2"),
       sql=lambda: with_ctes(SPEC, ["programme", "attended"], [prog_cte(SPEC), att_long_cte(SPEC), missed_cte(SPEC)],
                             "SELECT * FROM missed_f"))
def missed_composer_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per account: programme counts summed over the seasons it did not attend."""
    b = read_bundle(spark, sf_dir)
    return A.missed_preferences(b.attended, A.programme_by_season(b.programme, SPEC), SPEC)


@query("attendance_long", covers=("R1", "R7"),
       sql=lambda: with_ctes(SPEC, ["attended"], [att_long_cte(SPEC)], "SELECT * FROM att_long"))
def attendance_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide attendance melted to (account_id, season, attended)."""
    return A.attendance_long(read_bundle(spark, sf_dir).attended, SPEC)


@query("zero_total_flags", covers=("A9", "C9"),
       sql=lambda: with_ctes(SPEC, ["subscriptions"], [subs_t_cte(SPEC)],
                             "SELECT account_id, season, CAST(total = 0 AS DOUBLE) AS zero_total FROM subs_t"))
def zero_total_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 where an (account, season) row has zero subscriptions."""
    return A.zero_total_flag(type_subscriptions(read_bundle(spark, sf_dir).subscriptions))


@query("relationship_frequency", covers=("A10", "C1"),
       sql=lambda: with_ctes(SPEC, ["accounts"], [],
                             f"SELECT {norm('relationship')} AS relationship, count(*) AS n FROM accounts GROUP BY 1"))
def relationship_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """table(relationship) on normalised text."""
    a = read_bundle(spark, sf_dir).accounts.select(T.normalize("relationship").alias("relationship"))
    return A.frequency(a, "relationship")


ALL_SEASONS = HIST + [SPEC.target_season]


def _wide_history_ctes() -> list[str]:
    """Season-first casts in SQL: a repeated cell key turns every cell of that table into its row count."""
    def most(table: str, keys: str) -> str:
        return f"(SELECT max(n) > 1 AS d FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys}) x)"

    sc = ", ".join(f"CASE WHEN (SELECT d FROM sdup) THEN CAST(CAST(count(CASE WHEN season = '{s}' THEN 1 END) AS DOUBLE) "
                   f"AS VARCHAR) ELSE max(CASE WHEN season = '{s}' THEN total END) END AS \"{s}_total\""
                   for s in ALL_SEASONS)
    tc = []
    for s in SPEC.ticket_seasons:
        for t in SPEC.ticket_sets:
            here = f"season = '{s}' AND \"set\" = '{t}'"
            tc += [f"CASE WHEN (SELECT d FROM tdup) THEN CAST(count(CASE WHEN {here} THEN 1 END) AS DOUBLE) "
                   f"ELSE max(CASE WHEN {here} THEN {num(v)} END) END AS \"{s}_{t}_{v}\"" for v in SPEC.ticket_values]
    return [f"sdup AS {most('subscriptions', 'account_id, season')}",
            "tdup AS " + most("tickets", 'account_id, season, "set"'),
            f"sw AS (SELECT account_id, {sc} FROM subscriptions GROUP BY account_id)",
            f"tw AS (SELECT account_id, {', '.join(tc)} FROM tickets GROUP BY account_id)",
            "wide AS (SELECT * FROM (SELECT account_id, relationship FROM accounts) a "
            "FULL OUTER JOIN sw USING (account_id) FULL OUTER JOIN tw USING (account_id))"]


def _wide_history_sql(select: str = "SELECT * FROM wide", more: list[str] | None = None) -> str:
    return with_ctes(SPEC, ["accounts", "subscriptions", "tickets", *(more or [])], _wide_history_ctes(), select)


def wide_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts, subscriptions and tickets, the last two cast season first; repeated cell keys make counts."""
    b = read_bundle(spark, sf_dir)
    s = cast_wide(b.subscriptions, "account_id",
                  [(f"{s}_total", {"season": s}, "total") for s in ALL_SEASONS], keys_for_check=["account_id", "season"])
    t = b.tickets.select("account_id", "season", "set", *[F.col(v).try_cast("double").alias(v) for v in SPEC.ticket_values])
    tw = cast_wide(t, "account_id", [(f"{s}_{st}_{v}", {"season": s, "set": st}, v) for s in SPEC.ticket_seasons
                                     for st in SPEC.ticket_sets for v in SPEC.ticket_values],
                   keys_for_check=["account_id", "season", "set"])
    a = b.accounts.select("account_id", "relationship")
    return a.join(s, "account_id", "full").join(tw, "account_id", "full")


@query("history_wide_full_outer", covers=("R6", "J8", "R2", "A20"), sql=_wide_history_sql)
def history_wide_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seasons cast season-first (season_variable, season_set_variable) and full-outer joined to accounts."""
    return wide_history(spark, sf_dir)


@query("history_entry", covers=("J9", "C7"),
       sql=lambda: _wide_history_sql(f"SELECT account_id, coalesce(TRY_CAST(\"{SPEC.last_season}_total\" AS DOUBLE), 1.0) "
                                     "AS total FROM to_score JOIN wide USING (account_id)", ["to_score"]))
def history_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts to score inner-joined with the wide history: last season's total, 1 where it is missing."""
    ids = read_bundle(spark, sf_dir).to_score
    total = F.coalesce(F.col(f"`{SPEC.last_season}_total`").try_cast("double"), F.lit(1.0))
    return ids.join(wide_history(spark, sf_dir), "account_id").select("account_id", total.alias("total"))


def _buy_sql() -> str:
    sets = ", ".join(f"'{t}'" for t in SPEC.ticket_sets[:6])
    return with_ctes(SPEC, ["accounts", "subscriptions", "tickets", "to_score"],
                     ["ids AS (SELECT account_id FROM accounts UNION SELECT account_id FROM subscriptions "
                      "UNION SELECT account_id FROM tickets)",
                      "holders AS (SELECT DISTINCT account_id FROM tickets "
                      f"WHERE season = '{SPEC.last_season}' AND \"set\" IN ({sets}))"],
                     "SELECT s.account_id, CASE WHEN i.account_id IS NULL THEN NULL WHEN h.account_id IS NULL THEN 0.0::DOUBLE "
                     "ELSE 1.0::DOUBLE END AS total FROM to_score s LEFT JOIN ids i ON s.account_id = i.account_id "
                     "LEFT JOIN holders h ON s.account_id = h.account_id")


@query("bought_ticket_baseline", covers=("M12", "A16", "J10"), sql=_buy_sql)
def bought_ticket_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 when the account bought a ticket in any of the first six sets last season, else 0.

    A ticket counts when its row exists, whatever its seats and price level say."""
    from ..functions.rowwise import row_any
    b = read_bundle(spark, sf_dir)
    sets = SPEC.ticket_sets[:6]
    rows = cast_wide(b.tickets, "account_id", [(f"set_{t}", {"season": SPEC.last_season, "set": t}, "season") for t in sets],
                     on_duplicate="count", duplicates=True)
    buy = row_any([F.coalesce(F.col(f"set_{t}").try_cast("double"), F.lit(0.0)) > 0 for t in sets]).cast("double")
    known = b.accounts.select("account_id").join(b.subscriptions.select("account_id").distinct(), "account_id", "full")
    wide = known.join(rows, "account_id", "full").select("account_id", buy.alias("total"))
    return b.to_score.join(wide, "account_id", "left")
