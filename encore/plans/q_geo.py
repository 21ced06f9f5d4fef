"""Registered queries: postcode repair, directory enrichment, in-state fallback,
venue distances, density grid and hotspots, map export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from ..operators import aggregate as A
from ..operators import geo as G
from ..operators import polygons as P
from ..operators.features import build_features
from ..operators.repair import profile_lengths
from ..operators.split import prepare_training
from ..sources.bind import read_bundle
from ..spec import binding_spec, suffix
from .common import rounded
from .feature_sql import feature_ctes, geo_ctes, with_ctes, FEATURE_INPUTS
from .registry import query

SPEC = binding_spec()
CFG = G.GeoConfig()


def _geo_sql(select: str, extra: list[str] | None = None) -> str:
    return with_ctes(SPEC, ["accounts", "directory"], [geo_ctes(CFG)] + (extra or []), select)


Z1 = "(CASE WHEN length(billing_zip_code) = 4 THEN lpad(billing_zip_code, 5, '0') ELSE billing_zip_code END)"
Z2 = f"(CASE WHEN length({Z1}) = 10 THEN split_part({Z1}, '-', 1) ELSE {Z1} END)"


@query("postcode_repair", covers=("P2", "C4", "C12", "C13", "C14", "C16", "C17"),
       sql=lambda: with_ctes(SPEC, ["accounts"], [],
                             "SELECT account_id, billing_zip_code AS raw_zip, "
                             f"CASE WHEN {Z2} = '' THEN NULL ELSE {Z2} END AS billing_zip_code, "
                             "CASE WHEN billing_city = '' THEN NULL ELSE billing_city END AS billing_city, "
                             f"CAST((CASE WHEN {Z2} = '' THEN NULL ELSE {Z2} END) IS NULL AND "
                             "(CASE WHEN billing_city = '' THEN NULL ELSE billing_city END) IS NULL AS DOUBLE) AS missing, "
                             "CASE WHEN coalesce(regexp_matches(billing_zip_code, '[A-Za-z]'), false) THEN CAST(0 AS DOUBLE) "
                             "ELSE CAST(1 AS DOUBLE) END AS is_us, "
                             "CASE WHEN coalesce(regexp_matches(billing_zip_code, '[A-Za-z]'), false) THEN 'foreign' "
                             "ELSE '' END AS zip_bin FROM accounts"))
def postcode_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postcodes padded / trimmed, blanks to null, both-missing flag, foreign flag and bin."""
    a = read_bundle(spark, sf_dir).accounts
    rep = G.repair_postcodes(a)
    flags = a.select("account_id", F.col("billing_zip_code").alias("raw_zip"),
                     T.is_domestic("billing_zip_code").alias("is_us"),
                     T.foreign_bin("billing_zip_code").alias("zip_bin"))
    return flags.join(rep, "account_id")


@query("postcode_length_profile", covers=("C21", "A10"),
       sql=lambda: with_ctes(SPEC, ["accounts"], [],
                             "SELECT 'raw' AS stage, CAST(length(billing_zip_code) AS INTEGER) AS len, count(*) AS n FROM accounts GROUP BY 2 "
                             f"UNION ALL SELECT 'repaired' AS stage, CAST(length({Z2}) AS INTEGER) AS len, count(*) AS n "
                             "FROM accounts GROUP BY 2"))
def postcode_length_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """table(str_length(zip)) before and after padding / trimming."""
    a = read_bundle(spark, sf_dir).accounts
    raw = profile_lengths(a, "billing_zip_code").select(F.lit("raw").alias("stage"), "len", "n")
    fixed = a.select(T.trim_plus4(T.pad_if_length("billing_zip_code", 4)).alias("z"))
    rep = profile_lengths(fixed, "z").select(F.lit("repaired").alias("stage"), "len", "n")
    return raw.unionByName(rep)


@query("zip_frequency", covers=("A11", "A10", "F5"),
       sql=lambda: _geo_sql("SELECT billing_zip_code AS zip, count(*) AS n FROM g2 GROUP BY 1"))
def zip_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(zip, count) of repaired postcodes; missing postcodes form their own group."""
    rep = G.repair_postcodes(read_bundle(spark, sf_dir).accounts)
    return A.frequency(rep.select(F.col("billing_zip_code").alias("zip")), "zip")


@query("directory_enrichment", covers=("D8", "J5", "C15"),
       sql=lambda: _geo_sql("SELECT account_id, billing_zip_code, City, State, round(Lat, 6) AS Lat, "
                            "round(Long, 6) AS Long FROM g3"))
def directory_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts left-joined to the (padded) place directory on postcode."""
    b = read_bundle(spark, sf_dir)
    e = G.enrich_with_directory(G.repair_postcodes(b.accounts), b.directory, CFG)
    return rounded(e.select("account_id", "billing_zip_code", "City", "State", "Lat", "Long"))


@query("home_state_cities", covers=("A12", "F6"),
       sql=lambda: _geo_sql("SELECT hc AS city FROM home"))
def home_state_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct cities of accounts placed in the home state by their postcode."""
    b = read_bundle(spark, sf_dir)
    e = G.enrich_with_directory(G.repair_postcodes(b.accounts), b.directory, CFG)
    return G.home_state_cities(e).select(F.col("_home_city").alias("city"))


@query("home_state_fallback", covers=("J11", "F5", "F6"),
       sql=lambda: _geo_sql("SELECT g4.account_id, g4.State, CAST(g4.State IS DISTINCT FROM g3.State AS DOUBLE) AS by_city "
                            "FROM g4 JOIN g3 ON g4.account_id = g3.account_id"))
def home_state_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts without postcode get the home state when their city is a known home-state city."""
    b = read_bundle(spark, sf_dir)
    e = G.enrich_with_directory(G.repair_postcodes(b.accounts), b.directory, CFG)
    f = G.home_state_fallback(e, CFG)
    return (f.select("account_id", "State").join(e.select("account_id", F.col("State").alias("s0")), "account_id")
            .select("account_id", "State", (~F.col("State").eqNullSafe(F.col("s0"))).cast("double").alias("by_city")))


@query("venue_distances", covers=("P13", "D7", "J12", "S11", "C19"),
       sql=lambda: _geo_sql("SELECT account_id, round(dBerkley, 6) AS dBerkley, round(dSF, 6) AS dSF, "
                            "round(dPeninsula, 6) AS dPeninsula FROM g5"))
def venue_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Great-circle miles from each account to the three venues (null without coordinates)."""
    b = read_bundle(spark, sf_dir)
    g = G.home_state_fallback(G.enrich_with_directory(G.repair_postcodes(b.accounts), b.directory, CFG), CFG)
    return rounded(G.venue_distances(g).select("account_id", "dBerkley", "dSF", "dPeninsula"))


@query("density_grid", covers=("D9",),
       sql=lambda: _geo_sql("SELECT CAST(cy AS BIGINT) AS cell_y, CAST(cx AS BIGINT) AS cell_x, accounts FROM cells"))
def density_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts per grid cell of the map."""
    b = read_bundle(spark, sf_dir)
    g = G.enrich_with_directory(G.repair_postcodes(b.accounts), b.directory, CFG)
    return G.density_grid(g, CFG)


@query("hotspot_tags", covers=("D10", "C5", "J6"),
       sql=lambda: _geo_sql("SELECT account_id, hotspot FROM geo_all"))
def hotspot_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts in dense cells tagged 'Yes'; missing or blank tags default to 'No'."""
    b = read_bundle(spark, sf_dir)
    return G.geo_accounts(b.accounts, b.directory, CFG).select("account_id", "hotspot")


@query("geo_accounts", covers=("D8", "D7", "J11", "C17"),
       sql=lambda: _geo_sql("SELECT account_id, billing_zip_code, billing_city, missing, City, State, round(Lat, 6) AS Lat, "
                            "round(Long, 6) AS Long, round(dBerkley, 6) AS dBerkley, round(dSF, 6) AS dSF, "
                            "round(dPeninsula, 6) AS dPeninsula, hotspot FROM geo_all"))
def geo_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole geography table per account."""
    b = read_bundle(spark, sf_dir)
    g = G.geo_accounts(b.accounts, b.directory, CFG)
    return rounded(g.select("account_id", "billing_zip_code", "billing_city", "missing", "City", "State", "Lat",
                            "Long", "dBerkley", "dSF", "dPeninsula", "hotspot"))


T1, T2 = (f"total_{suffix(s)}" for s in SPEC.last(2))


def _map_sql() -> str:
    return with_ctes(SPEC, FEATURE_INPUTS + ["train_labels"], feature_ctes(SPEC) + [
        f"train AS (SELECT l.account_id, l.total, coalesce(f.{T1}, 0.0) AS {T1}, "
        f"coalesce(f.{T2}, 0.0) AS {T2} FROM train_labels l LEFT JOIN features f "
        "ON l.account_id = f.account_id)"],
        "SELECT t.account_id AS accountID, g.billing_zip_code AS billingZipCode, round(g.Lat, 6) AS Lat, "
        f"round(g.Long, 6) AS Long, g.hotspot, t.total, t.{T1}, t.{T2} "
        "FROM geo_all g RIGHT JOIN train t ON g.account_id = t.account_id")


@query("map_points_export", covers=("J7", "J14", "S12", "P5"), sql=_map_sql)
def map_points_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geography right-joined to every modelling row, renamed for the map layer."""
    b = read_bundle(spark, sf_dir)
    g = G.geo_accounts(b.accounts, b.directory, CFG)
    feats = build_features(b).select("account_id", T1, T2)
    train = prepare_training(b.labels, feats)
    j = g.join(train, "account_id", "right")
    return rounded(j.select(train.account_id.alias("accountID"), F.col("billing_zip_code").alias("billingZipCode"),
                            "Lat", "Long", "hotspot", "total", T1, T2))


@query("normalized_sources", covers=("C1", "A10"),
       sql=lambda: "SELECT lower(regexp_replace('  ' || upper(substr(source, 1, 1)) || lower(substr(source, 2)) || ' ', "
                   "'^\\s+|\\s+$', '', 'g')) AS source, count(*) AS n FROM documents GROUP BY 1")
def normalized_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document sources wrapped in spaces and mixed case, normalised back and counted."""
    from ..sources.tables import table
    d = table(spark, sf_dir, "documents").select("source")
    wrapped = F.concat(F.lit("  "), F.upper(F.substring("source", 1, 1)), F.lower(F.substring("source", 2, 1 << 20)),
                       F.lit(" "))
    return A.frequency(d.select(T.normalize(wrapped).alias("source")), "source")


@query("account_state_lookup", covers=("J15", "J1"),
       sql=lambda: _geo_sql("SELECT a.account_id, a.relationship, g.State FROM accounts a LEFT JOIN geo_all g "
                            "ON a.account_id = g.account_id"))
def account_state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-account state pulled onto the account table by key."""
    b = read_bundle(spark, sf_dir)
    g = G.geo_accounts(b.accounts, b.directory, CFG).select("account_id", "State")
    return b.accounts.select("account_id", "relationship").join(g, "account_id", "left")


def _state_rings(directory: DataFrame) -> DataFrame:
    """Supplied polygons: for each state the box around its places with a hole in its middle, one row a ring."""
    box = directory.groupBy("State").agg(F.min("Lat").alias("y0"), F.max("Lat").alias("y9"), F.min("Long").alias("x0"), F.max("Long").alias("x9"))
    y0, y9, x0, x9 = F.col("y0") - 0.05, F.col("y9") + 0.05, F.col("x0") - 0.05, F.col("x9") + 0.05

    def ring(a: Column, b: Column, c: Column, d: Column) -> Column:
        return F.array(*[F.struct(y.alias("y"), x.alias("x")) for y, x in ((a, c), (a, d), (b, d), (b, c))])

    hole = ring(y0 + (y9 - y0) * 0.4, y0 + (y9 - y0) * 0.6, x0 + (x9 - x0) * 0.4, x0 + (x9 - x0) * 0.6)
    return box.select(F.col("State").alias("polygon_id"), F.explode(F.array(ring(y0, y9, x0, x9), hole)).alias("points"))


def _polygon_sql() -> str:
    return _geo_sql("""SELECT g.account_id, min(b.State) AS polygon, coalesce(max(CASE WHEN b.State IS NOT NULL THEN 'Yes' END), 'No') AS hotspot,
  count(DISTINCT a.billing_city) AS layer_rows FROM geo_all g LEFT JOIN (
  SELECT State, min(Lat) - 0.05 AS y0, max(Lat) + 0.05 AS y9, min(Long) - 0.05 AS x0, max(Long) + 0.05 AS x9 FROM
    (SELECT State, CAST(Lat AS DOUBLE) AS Lat, CAST(Long AS DOUBLE) AS Long FROM directory) GROUP BY State) b
  ON g.Lat >= b.y0 AND g.Lat < b.y9 AND g.Long >= b.x0 AND g.Long < b.x9
  AND NOT (g.Lat >= b.y0 + (b.y9 - b.y0) * 0.4 AND g.Lat < b.y0 + (b.y9 - b.y0) * 0.6 AND g.Long >= b.x0 + (b.x9 - b.x0) * 0.4 AND g.Long < b.x0 + (b.x9 - b.x0) * 0.6)
  LEFT JOIN accounts a ON a.account_id = g.account_id GROUP BY g.account_id""")


@query("polygon_hotspots", covers=("D10", "J6", "J14"), sql=_polygon_sql)
def polygon_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts tagged by supplied polygons with holes; the tagged points joined to the point layer by key, a missing tag as 'No'."""
    b = read_bundle(spark, sf_dir)
    points = G.geo_accounts(b.accounts, b.directory, CFG).select("account_id", "billing_city", "Lat", "Long")
    rings = _state_rings(b.directory.withColumns({c: F.col(c).cast("double") for c in ("Lat", "Long")}))
    tagged = P.polygon_tags(points, rings).select("account_id", F.col("polygon_id").alias("polygon"),
                                                  F.when(F.col("polygon_id").isNotNull(), "Yes").alias("hotspot"))
    joined = P.layer_join(points, tagged)
    layer = b.accounts.select("account_id", F.col("billing_city").isNotNull().cast("long").alias("layer_rows"))
    return (joined.join(layer, "account_id", "left").select("account_id", F.col("layer_polygon").alias("polygon"),
                                                            T.missing_to("layer_hotspot", K.HOTSPOT_DEFAULT).alias("hotspot"), "layer_rows"))


def _heat_sql(body: str) -> str:
    return _geo_sql(body, [
        "hc AS (SELECT floor(Lat / 0.25) AS y, floor(Long / 0.25) AS x, count(*) AS n FROM geo_all WHERE Lat IS NOT NULL AND Long IS NOT NULL GROUP BY ALL)",
        "hd AS (SELECT unnest(range(-4, 5)) AS d)",
        "hk AS (SELECT a.d AS dy, b.d AS dx, pow(1 - (a.d * a.d + b.d * b.d) * 0.0625, 2) AS w FROM hd a, hd b WHERE (a.d * a.d + b.d * b.d) * 0.0625 < 1)",
        "h AS (SELECT y + dy AS cy, x + dx AS cx, sum(n * w) AS heat FROM hc, hk GROUP BY ALL)"])


@query("heat_surface", covers=("D9",), sql=lambda: _heat_sql("SELECT CAST(cy AS BIGINT) AS cell_y, CAST(cx AS BIGINT) AS cell_x, round(heat, 6) AS heat FROM h"))
def heat_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map's heat: account counts by cell spread by a quartic kernel of one degree."""
    b = read_bundle(spark, sf_dir)
    return rounded(P.heat_surface(G.enrich_with_directory(G.repair_postcodes(b.accounts), b.directory, CFG)))


@query("heat_hotspots", covers=("D10", "D9"), sql=lambda: _heat_sql(
    "SELECT g.account_id, CASE WHEN h.heat >= 0.5 * (SELECT max(heat) FROM h) THEN 'Yes' ELSE 'No' END AS hotspot FROM geo_all g "
    "LEFT JOIN h ON floor(g.Lat / 0.25) = h.cy AND floor(g.Long / 0.25) = h.cx"))
def heat_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts whose cell has at least half of the largest heat."""
    b = read_bundle(spark, sf_dir)
    g = G.enrich_with_directory(G.repair_postcodes(b.accounts), b.directory, CFG)
    return P.heat_tags(g.select("account_id", "Lat", "Long")).select("account_id", T.missing_to("hotspot", K.HOTSPOT_DEFAULT).alias("hotspot"))
