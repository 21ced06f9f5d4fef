"""Binding of the driver tables onto the library's inputs.

The reference reads eight CSV extracts (accounts, subscriptions, tickets,
programme, attendance, geography, labels, rows to score). The driver tables are
a TPC-H-like star schema, so this module derives rows *in the schema the jobs
expect* from them. It does none of the jobs' work: every value is left as the
raw text the jobs repair, parse, reshape and aggregate themselves.

Rules (also written out as SQL in ``encore.plans.oracle_sql``):

* accounts      customer x nation; account_id = c_custkey; postcode text in five
                forms by ``c_custkey % 5`` (4-digit, 5-digit, ZIP+4, foreign, blank);
                billing city = nation name wrapped in spaces, mixed case, blank
                when ``c_custkey % 7 = 0``; relationship = market segment;
                donation fields as text (some unparsable).
* subscriptions orders per (customer, order year); order year y is the season
                '(y+13)-(y+14)', so history is 2008-2009 ... 2013-2014 and the target
                2014-2015 (the reference's own season names).
* tickets       lineitem x orders; set = line number; seats = quantity.
* programme     lineitem x part x orders per (season, set); composer = part type;
                only order years from 1996 on (seasons from 2009-2010), so a subscription
                in the first history season has no programme.
* attended      customer x ticket seasons: '1' if any order that year else '0'.
* directory     nation x region: zipcode, City, State, Lat, Long.
* labels        orders in the target season per customer (0 when none).
* to_score      every customer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import HistorySpec, binding_spec
from .tables import table


@dataclass
class Bundle:
    """The raw input bundle (all lazily scanned)."""

    accounts: DataFrame
    subscriptions: DataFrame
    tickets: DataFrame
    programme: DataFrame
    attended: DataFrame
    directory: DataFrame
    labels: DataFrame
    to_score: DataFrame
    spec: HistorySpec


def _season(ts: Column, spec: HistorySpec) -> Column:
    """Season of an order: every ``period_months`` months from January 1995 on make one."""
    if spec.period_months == 12:
        y = F.year(ts) + (spec.first_start - 1995)
    else:
        y = F.floor(((F.year(ts) - 1995) * 12 + F.month(ts) - 1) / spec.period_months).cast("int") + spec.first_start
    return F.concat(y.cast("string"), F.lit("-"), (y + 1).cast("string"))


def _mixed_case(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 20)))


def _zip_of_nation(nk: Column) -> Column:
    return nk * 400 + 1000


def bind_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
    k = F.col("c_custkey")
    z = _zip_of_nation(F.col("c_nationkey")).cast("string")
    zip5 = F.lpad(z, 5, "0")
    postcode = (F.when(k % 5 == 0, z)
                .when(k % 5 == 1, zip5)
                .when(k % 5 == 2, F.concat(zip5, F.lit("-1234")))
                .when(k % 5 == 3, F.lit("K1A 0A9"))
                .otherwise(F.lit("")))
    city = F.when(k % 7 == 0, F.lit("")).otherwise(
        F.concat(F.lit(" "), _mixed_case(F.col("n_name")), F.lit("  ")))
    bal = F.greatest(F.col("c_acctbal"), F.lit(0.0))
    donated_2013 = F.when(k % 3 == 0, F.floor(bal / 3).cast("bigint").cast("string")).otherwise(F.lit("0"))
    donations = F.when(k % 11 == 10, F.lit("n/a")).otherwise((k % 5).cast("string"))
    first = F.when(k % 4 == 0, F.lit("")).otherwise(
        F.concat((F.lit(1985) + k % 16).cast("string"), F.lit("-03-15")))
    return j.select(
        k.alias("account_id"),
        postcode.alias("billing_zip_code"),
        city.alias("billing_city"),
        F.col("c_mktsegment").alias("relationship"),
        donated_2013.alias("amount_donated_2013"),
        F.floor(bal).cast("bigint").cast("string").alias("amount_donated_lifetime"),
        donations.alias("no_donations_lifetime"),
        first.alias("first_donated"),
    )


def bind_subscriptions(spark: SparkSession, sf_dir: str, spec: HistorySpec) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").select("c_custkey", "n_name")
    j = o.join(cn, o.o_custkey == cn.c_custkey, "left")
    loc = F.when(F.col("o_orderkey") % 3 != 0, F.col("n_name")).otherwise(F.lit("other"))
    g = j.groupBy(F.col("o_custkey").alias("account_id"), _season(F.col("o_orderdate"), spec).alias("season")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(F.substring("o_orderpriority", 1, 1)).alias("_pl"),
        F.floor(F.sum("o_totalprice") / 100000).cast("bigint").alias("_seats"),
        F.min("o_orderstatus").alias("package"),
        F.min(loc).alias("location"),
        F.max("o_orderpriority").alias("section"),
    )
    return g.select(
        "account_id", "season",
        F.when(F.col("_pl") == "5", F.lit("")).otherwise(F.col("_pl")).alias("price_level"),
        F.col("_seats").cast("string").alias("no_seats"),
        F.col("_n").cast("string").alias("total"),
        "package", "location", "section",
        F.when(F.col("_n") > 1, F.lit("yes")).otherwise(F.lit("no")).alias("multiple_subs"),
    )


def bind_tickets(spark: SparkSession, sf_dir: str, spec: HistorySpec) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    price = (F.when(F.col("l_returnflag") == "A", F.lit("2"))
             .when(F.col("l_returnflag") == "N", F.lit(""))
             .otherwise(F.lit("3x")))
    seats = F.when(F.col("l_quantity") > 45, F.lit("")).otherwise(
        F.col("l_quantity").cast("bigint").cast("string"))
    return j.select(
        F.col("o_custkey").alias("account_id"),
        _season(F.col("o_orderdate"), spec).alias("season"),
        F.col("l_linenumber").cast("string").alias("set"),
        price.alias("price_level"),
        seats.alias("no_seats"),
    )


def bind_programme(spark: SparkSession, sf_dir: str, spec: HistorySpec) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    names = F.array(*[F.lit(c) for c in spec.composers])
    by = F.col("p_type") if spec.composer_by == "p_type" else names[(F.col("p_partkey") % len(spec.composers)).cast("int")]
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
         .where(F.year("o_orderdate") >= 1996)
         .join(p, li.l_partkey == p.p_partkey, "inner"))
    wide = (j.groupBy(_season(F.col("o_orderdate"), spec).alias("season"),
                      F.col("l_linenumber").cast("string").alias("set"), by.alias("composer"))
            .agg(F.count(F.lit(1)).alias("n")).groupBy("season", "set").pivot("composer", list(spec.composers)).agg(F.sum("n")))
    return wide.select("season", "set",
                       *[F.coalesce(F.col(c), F.lit(0)).cast("string").alias(c) for c in spec.composers])


def bind_attended(spark: SparkSession, sf_dir: str, spec: HistorySpec) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    s = _season(F.col("o_orderdate"), spec)
    per = o.groupBy("o_custkey").agg(
        *[F.max(F.when(s == season, 1).otherwise(0)).alias(season) for season in spec.ticket_seasons])
    j = c.join(per, c.c_custkey == per.o_custkey, "left")
    return j.select(F.col("c_custkey").alias("account_id"),
                    *[F.coalesce(F.col(f"`{x}`"), F.lit(0)).cast("string").alias(x) for x in spec.ticket_seasons])


def bind_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
    nk = F.col("n_nationkey")
    return j.select(
        _zip_of_nation(nk).cast("string").alias("Zipcode"),
        F.col("n_name").alias("City"),
        F.when(nk < 5, F.lit("CA")).otherwise(F.col("r_name")).alias("State"),
        (F.lit(37.0) + nk * 0.1).alias("Lat"),
        (F.lit(-122.0) - nk * 0.2).alias("Long"),
    )


def bind_labels(spark: SparkSession, sf_dir: str, spec: HistorySpec) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    t = (o.where(_season(F.col("o_orderdate"), spec) == spec.target_season)
         .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")))
    j = c.join(t, c.c_custkey == t.o_custkey, "left")
    return j.select(F.col("c_custkey").alias("account_id"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("total"))


def bind_to_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("account_id"))


def read_bundle(spark: SparkSession, sf_dir: str, spec: HistorySpec | None = None) -> Bundle:
    """``readData``: the lazily bound input bundle."""
    spec = spec or binding_spec()
    return Bundle(
        accounts=bind_accounts(spark, sf_dir),
        subscriptions=bind_subscriptions(spark, sf_dir, spec),
        tickets=bind_tickets(spark, sf_dir, spec),
        programme=bind_programme(spark, sf_dir, spec),
        attended=bind_attended(spark, sf_dir, spec),
        directory=bind_directory(spark, sf_dir),
        labels=bind_labels(spark, sf_dir, spec),
        to_score=bind_to_score(spark, sf_dir),
        spec=spec,
    )
