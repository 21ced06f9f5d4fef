"""Geographic enrichment of accounts.

Postcode repair -> place-directory join -> in-state fallback by city ->
distances to the venues -> density grid -> hotspot tag. Joins against
reference tables (directory, city list) carry no hint: Spark broadcasts a side whose size in bytes is below
its threshold, and joins by shuffle above it. Hot cells are bounded by the globe's grid.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from ..functions.geo import great_circle_miles


@dataclass(frozen=True)
class GeoConfig:
    grid_deg: float = 0.25           # density grid cell size (degrees)
    hot_min_accounts: int = 40       # a cell with at least this many accounts is a hotspot
    max_broadcast_cells: int = 2_000_000  # of 32 bytes at most: 64 MB


def repair_postcodes(accounts: DataFrame) -> DataFrame:
    """4-digit codes padded, ZIP+4 trimmed, blanks -> null, both-missing flag."""
    z = T.trim_plus4(T.pad_if_length("billing_zip_code", 4))
    return accounts.select(
        "account_id",
        T.blank_to_null(z).alias("billing_zip_code"),
        T.blank_to_null("billing_city").alias("billing_city"),
    ).withColumn("missing", T.both_missing("billing_zip_code", "billing_city"))


def prepare_directory(directory: DataFrame) -> DataFrame:
    """Directory postcodes shorter than five characters are left-padded."""
    return directory.select(T.pad_if_shorter("Zipcode").alias("Zipcode"), "City", "State",
                            F.col("Lat").cast("double").alias("Lat"),
                            F.col("Long").cast("double").alias("Long"))


def enrich_with_directory(geo: DataFrame, directory: DataFrame, cfg: GeoConfig = GeoConfig()) -> DataFrame:
    d = prepare_directory(directory)
    return geo.join(d, geo.billing_zip_code == d.Zipcode, "left").drop("Zipcode")


def _city_key(c: Column) -> Column:
    return F.lower(F.trim(c))


def home_state_cities(enriched: DataFrame) -> DataFrame:
    """Distinct (lower-cased, trimmed) cities of accounts whose directory state is the home state."""
    return (enriched.where(F.col("State") == K.HOME_STATE)
            .select(_city_key(F.col("City")).alias("_home_city"))
            .where(F.col("_home_city").isNotNull()).distinct())


def home_state_fallback(enriched: DataFrame, cfg: GeoConfig = GeoConfig()) -> DataFrame:
    """Accounts without a postcode whose billing city is a known home-state city get the home state."""
    # The city list is an aggregate (a shuffle stage): AQE measures its real size at run
    # time and switches to a broadcast join only when it is under the threshold.
    cities = home_state_cities(enriched)
    j = enriched.join(cities, _city_key(F.col("billing_city")) == F.col("_home_city"), "left")
    state = F.when(F.col("billing_zip_code").isNull() & F.col("_home_city").isNotNull(),
                   F.lit(K.HOME_STATE)).otherwise(F.col("State"))
    return j.withColumn("State", state).drop("_home_city")


def venue_distances(df: DataFrame, venues=K.VENUES) -> DataFrame:
    """One distance column per venue (a fixed short list: expressions, not a cross join)."""
    return df.withColumns({name: great_circle_miles(F.col("Lat"), F.col("Long"), lat, lon)
                           for name, lat, lon in venues})


def _cell(cfg: GeoConfig) -> list[Column]:
    return [F.floor(F.col("Lat") / cfg.grid_deg).alias("cell_y"),
            F.floor(F.col("Long") / cfg.grid_deg).alias("cell_x")]


def density_grid(points: DataFrame, cfg: GeoConfig = GeoConfig()) -> DataFrame:
    """Accounts per grid cell (points without coordinates are left out)."""
    return (points.where(F.col("Lat").isNotNull() & F.col("Long").isNotNull())
            .groupBy(*_cell(cfg)).agg(F.count(F.lit(1)).alias("accounts")))


def tag_hotspots(points: DataFrame, cfg: GeoConfig = GeoConfig()) -> DataFrame:
    """hotspot = 'Yes' for accounts in a dense cell, else null (defaulted later).

    The hot-cell table has at most one row per grid cell of the globe
    ((180/g) x (360/g) rows), a fixed bound independent of the data size.
    """
    hot = (density_grid(points, cfg).where(F.col("accounts") >= cfg.hot_min_accounts)
           .select("cell_y", "cell_x", F.lit("Yes").alias("hotspot")))
    cells_bound = int((180 / cfg.grid_deg + 1) * (360 / cfg.grid_deg + 1))
    hot = F.broadcast(hot) if cells_bound <= cfg.max_broadcast_cells else hot
    p = points.select("*", *_cell(cfg))
    return p.join(hot, ["cell_y", "cell_x"], "left").drop("cell_y", "cell_x")


def geo_accounts(accounts: DataFrame, directory: DataFrame, cfg: GeoConfig = GeoConfig()) -> DataFrame:
    """The full geography table per account (the reference's geo.account file, as a plan)."""
    g = repair_postcodes(accounts)
    g = enrich_with_directory(g, directory, cfg)
    g = home_state_fallback(g, cfg)
    g = venue_distances(g)
    g = tag_hotspots(g, cfg)
    return g.withColumn("hotspot", T.missing_to("hotspot", K.HOTSPOT_DEFAULT))
