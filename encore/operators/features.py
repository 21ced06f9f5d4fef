"""The wide per-account feature table (``preparePredictors``).

Plan shape (one shuffle per input family, then key joins):

* accounts  -> parsed donations, postcode flag, dense account number, geography
               (per row; reference tables joined by broadcast)
* subscriptions (+ programme by season, broadcast)  -> ONE ``groupBy(account_id)``:
               numeric and categorical season cells and composer preferences
* tickets   -> ONE ``groupBy(account_id)``: per-season counts and seat sums and
               the (variable, season, set) cells
* attendance -> missed seasons x programme -> ``groupBy(account_id)``

Each family leaves its aggregation hash-partitioned on ``account_id``, so the
left joins onto the account table reuse that partitioning. Derived columns
(row-wise means/variances, flags, adjusted totals) are one final ``select``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import numeric as N
from ..functions import rowwise as RW
from ..functions import text as T
from ..sources.bind import Bundle
from ..spec import HistorySpec, suffix
from . import aggregate as A
from .geo import GeoConfig, geo_accounts
from .index import with_dense_index
from .repair import repair_tickets, type_subscriptions
from .reshape import cast_cells

GEO_NUMERIC = ("Lat", "Long", "dSF", "dPeninsula", "dBerkley", "missing")
GEO_FACTORS = ("State", "City", "hotspot")


@dataclass(frozen=True)
class FeatureConfig:
    on_duplicate: str = "count"       # cast rule when a cell key repeats (see reshape.cast_wide)
    duplicate_check: str = "subquery"  # how an unknown duplicate status is found (reshape.cast_cells)
    weight_preferences: bool = True    # composer preference weighted by subscriptions
    geo: GeoConfig = GeoConfig()
    index_buckets: int | None = None   # buckets of the dense account numbering


# --------------------------------------------------------------------------- names

def subs_numeric_names(spec: HistorySpec) -> list[str]:
    return [f"{v}_{suffix(s)}" for v in spec.subs_numeric for s in spec.history_seasons]


def subs_factor_names(spec: HistorySpec) -> list[str]:
    return [f"{v}_{suffix(s)}" for v in spec.subs_factors for s in spec.history_seasons]


def ticket_cell_names(spec: HistorySpec) -> list[str]:
    return [f"add_{v}_{suffix(s)}_{t}" for v in spec.ticket_values for s in spec.ticket_seasons
            for t in spec.ticket_sets]


def total(spec: HistorySpec, season: str) -> str:
    return f"total_{suffix(season)}"


# --------------------------------------------------------------------------- families

def account_family(accounts: DataFrame, spec: HistorySpec, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Parsed account columns, donation features, postcode flag and the account number."""
    a = accounts.select(
        "account_id",
        N.to_number("amount_donated_2013").alias("amount_donated_2013"),
        N.to_number("amount_donated_lifetime").alias("amount_donated_lifetime"),
        N.to_number("no_donations_lifetime").alias("no_donations_lifetime"),
        (F.lit(float(spec.reference_year)) - N.year_of("first_donated", spec.reference_year)).alias("years_donating"),
        T.is_domestic("billing_zip_code").alias("is_us"),
        T.normalize("billing_city").alias("billing_city"),
        T.normalize("relationship").alias("relationship"),
    )
    a = with_dense_index(a, "account_id", "account_num", cfg.index_buckets)
    donated = N.flag(F.col("amount_donated_2013") > 0)
    avg = N.guarded_ratio("amount_donated_lifetime", "no_donations_lifetime")
    return a.select(
        "*",
        donated.alias("add_donated_2013"),
        (donated * F.col("no_donations_lifetime")).alias("add_no_donations_lifetime_if_donated_2013"),
        avg.alias("add_avg_donation"),
        (donated * avg).alias("add_avg_donation_if_donated_2013"),
    )


def subscription_family(b: Bundle, cfg: FeatureConfig = FeatureConfig(),
                        duplicates: bool | None = None, prog: DataFrame | None = None) -> DataFrame:
    """Season cells (numeric and categorical) and composer preferences in one aggregation."""
    spec = b.spec
    subs = type_subscriptions(b.subscriptions, spec.subs_numeric, spec.subs_factors)
    hist = subs.where(F.col("season") != spec.target_season)
    prog = prog if prog is not None else A.programme_by_season(b.programme, spec)
    # categorical values are cast to text once, so a count rule keeps a numeric cell type only for numerics
    cells = [(f"{v}_{suffix(s)}", {"season": s}, v) for v in (*spec.subs_numeric, *spec.subs_factors) for s in spec.history_seasons]
    # a season's rows share its programme; one row without a total makes the season's sum null
    w = (lambda c: F.col(c) * F.col("__total")) if cfg.weight_preferences else (lambda c: F.col(c) * F.col("__rows"))
    prefs = [RW.poisoned_sum(w(c)).alias("conc_" + c) for c in spec.preference_composers]
    out = cast_cells(hist, "account_id", cells, prefs, cfg.on_duplicate, duplicates, cfg.duplicate_check, ["account_id", "season"],
                     by_cell=[RW.poisoned_sum("total").alias("__total")], widened=lambda d: d.join(F.broadcast(prog), "season", "left"))
    facs = {f"{v}_{suffix(s)}" for v in spec.subs_factors for s in spec.history_seasons}
    return out.selectExpr(*[f"CAST(`{c}` AS STRING) AS `{c}`" if c in facs else f"`{c}`" for c in out.columns])


def totals_family(b: Bundle, cfg: FeatureConfig = FeatureConfig(), duplicates: bool | None = None) -> DataFrame:
    """The season totals of :func:`subscription_family` alone, under the same duplicate rule."""
    spec = b.spec
    subs = type_subscriptions(b.subscriptions, ("total",), ()).where(F.col("season") != spec.target_season)
    cells = [(total(spec, s), {"season": s}, "total") for s in spec.history_seasons]
    return cast_cells(subs, "account_id", cells, (), cfg.on_duplicate, duplicates, cfg.duplicate_check, ["account_id", "season"], by_cell=())


def ticket_family(b: Bundle, cfg: FeatureConfig = FeatureConfig(), duplicates: bool | None = None) -> DataFrame:
    """Per-season ticket counts and seat sums, and the (variable, season, set) cells."""
    spec = b.spec
    t = repair_tickets(b.tickets)
    def within(season: str, column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("season") == season, F.col(column))), F.lit(0))

    extra = [within(s, "__rows").cast("double").alias(f"add_tickets_total_{suffix(s)}") for s in spec.ticket_seasons]
    # sum without na.rm: a null seat count makes the season's sum null; absent season -> 0
    extra += [F.when(within(s, "__filled") == within(s, "__rows"), within(s, "__seats").cast("double"))
              .alias(f"add_tickets_seats_{suffix(s)}") for s in spec.ticket_seasons]
    cells = [(f"add_{v}_{suffix(s)}_{st}", {"season": s, "set": st}, v)
             for v in spec.ticket_values for s in spec.ticket_seasons for st in spec.ticket_sets]
    return cast_cells(t, "account_id", cells, extra, cfg.on_duplicate, duplicates, cfg.duplicate_check,
                      ["account_id", "season", "set"], by_cell=[F.sum("no_seats").alias("__seats"), F.count("no_seats").alias("__filled")])


def missed_family(b: Bundle, prog: DataFrame | None = None) -> DataFrame:
    prog = prog if prog is not None else A.programme_by_season(b.programme, b.spec)
    return A.missed_preferences(b.attended, prog, b.spec)


def geo_family(b: Bundle, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    g = geo_accounts(b.accounts, b.directory, cfg.geo)
    return g.select("account_id", *GEO_NUMERIC, *GEO_FACTORS)


# --------------------------------------------------------------------------- assembly

def derived_columns(spec: HistorySpec) -> list:
    """Adjusted totals, same-city flags, window means/variances, ever/number-bought flags."""
    last4 = spec.last(4)
    out = []
    for s in reversed(last4):
        same = ((F.col("billing_city") == F.col(f"location_{suffix(s)}")).cast("double")
                * (F.col(total(spec, s)) > 0).cast("double"))
        out.append(F.coalesce(same, F.lit(0.0)).alias(f"was_{suffix(s)}_subscription_outside_city"))
    for s in last4:
        out.append((F.col(total(spec, s)) + F.col(f"add_tickets_total_{suffix(s)}"))
                   .alias(f"adjusted_total_{suffix(s)}"))
    for n in spec.windows:
        cols = [total(spec, s) for s in spec.last(n)]
        out.append(RW.row_mean(cols).alias(f"avg_{n}_years"))
        out.append(RW.row_var(cols).alias(f"var_{n}_years"))
    for n in spec.windows:
        cols = [total(spec, s) for s in spec.last(n)]
        out.append((RW.row_mean(cols) * RW.row_constant(cols).cast("double")).alias(f"avg_{n}_years_if_no_var"))
    all_totals = [total(spec, s) for s in spec.history_seasons]
    tick = [f"add_tickets_total_{suffix(s)}" for s in spec.ticket_seasons]
    out.append(N.flag(RW.row_sum(all_totals) > 0).alias("ever_bought_subs"))
    out.append(RW.count_positive(all_totals).alias("num_bought_subs"))
    out.append(N.flag(RW.row_sum(tick) > 0).alias("ever_bought_ticket"))
    out.append(RW.count_positive(tick).alias("num_bought_ticket"))
    return out


def factor_columns(spec: HistorySpec) -> list[str]:
    return subs_factor_names(spec) + ["billing_city", "relationship"] + list(GEO_FACTORS)


def build_features(b: Bundle, cfg: FeatureConfig = FeatureConfig(), filter_regex: str = "",
                   subs_duplicates: bool | None = None, ticket_duplicates: bool | None = None) -> DataFrame:
    """One typed row per account; numeric gaps -> 0, categorical gaps -> an NA level."""
    spec = b.spec
    acc = account_family(b.accounts, spec, cfg)
    geo = geo_family(b, cfg)
    prog = A.programme_by_season(b.programme, spec)   # built once, broadcast to two families
    subs = subscription_family(b, cfg, subs_duplicates, prog)
    tick = ticket_family(b, cfg, ticket_duplicates)
    missed = missed_family(b, prog)
    wide = (acc.join(subs, "account_id", "left")
            .join(tick, "account_id", "left")
            .join(missed, "account_id", "left")
            .join(geo, "account_id", "left"))
    factors = set(factor_columns(spec))
    # numeric gaps -> 0 first; derived columns see categorical gaps as missing (never equal);
    # only then do categorical gaps become their own level.
    typed = wide.selectExpr(*[f"`{c}`" if c == "account_id" or c in factors else f"coalesce(`{c}`, 0D) AS `{c}`" for c in wide.columns])
    derived = typed.select("*", *derived_columns(spec))
    out = derived.selectExpr(*[f"{T.NA_LEVEL_SQL.format(c=c)} AS `{c}`" if c in factors else f"`{c}`" for c in derived.columns])
    return drop_matching(out, filter_regex)


def build_history(b: Bundle, cfg: FeatureConfig = FeatureConfig(), subs_duplicates: bool | None = None) -> DataFrame:
    """The columns of :func:`build_features` that the prediction adjustments read, and the window means and variances of the totals,
    without the other families: (account_id, totals, State, dSF, avg_n_years, var_n_years)."""
    spec = b.spec
    geo = geo_family(b, cfg).select("account_id", "State", "dSF")
    wide = b.accounts.select("account_id").join(totals_family(b, cfg, subs_duplicates), "account_id", "left").join(geo, "account_id", "left")
    typed = wide.selectExpr(*[f"`{c}`" if c == "account_id" else f"{T.NA_LEVEL_SQL.format(c=c)} AS `{c}`" if c == "State"
                              else f"coalesce(`{c}`, 0D) AS `{c}`" for c in wide.columns])
    windows = [(n, [total(spec, s) for s in spec.last(n)]) for n in spec.windows]
    return typed.select("*", *[RW.row_mean(c).alias(f"avg_{n}_years") for n, c in windows], *[RW.row_var(c).alias(f"var_{n}_years") for n, c in windows])


# --------------------------------------------------------------------------- regex selection

PROTECTED = ("account_id", "total", "label", "fold")


def matching_columns(columns: Sequence[str], regex: str) -> list[str]:
    r = re.compile(regex)
    return [c for c in columns if r.search(c)]


def drop_matching(df: DataFrame, regex: str, protect: Sequence[str] = PROTECTED) -> DataFrame:
    """Drop columns whose name matches ``regex`` (empty regex or no match: nothing dropped)."""
    if not regex:
        return df
    gone = [c for c in matching_columns(df.columns, regex) if c not in protect]
    return df.drop(*gone) if gone else df


def keep_matching(df: DataFrame, regex: str, keep: Sequence[str] = ("account_id",)) -> DataFrame:
    cols = [c for c in df.columns if c in keep or re.search(regex, c)]
    return df.select(*cols)
