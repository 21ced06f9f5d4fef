"""Properties: hot keys, repartition invariance, plan pruning, geography rules on hand-made frames."""

import re

import pandas as pd
from pyspark.sql import functions as F

from encore.operators import geo as G
from encore.operators.features import build_features
from encore.operators.reshape import cast_cells
from encore.sources.bind import read_bundle

from .conftest import SF_SMALL


def test_hot_key_cast_matches_pandas(spark):
    # account 0 holds a third of all rows; (account, season, set) repeats -> count rule
    rows = [(0, f"s{i % 3}", str(i % 4), float(i % 5)) for i in range(3000)]
    rows += [(1 + i % 997, f"s{i % 3}", str(i % 4), float(i % 7)) for i in range(6000)]
    df = spark.createDataFrame(rows, "account_id long, season string, set string, v double").repartition(7)
    cells = [(f"c_{s}_{t}", (F.col("season") == s) & (F.col("set") == t), "v") for s in ("s0", "s1", "s2")
             for t in ("0", "1", "2", "3")]
    extra = [F.sum("v").alias("total_v")]
    got = cast_cells(df, "account_id", cells, extra, keys_for_check=["account_id", "season", "set"]).toPandas()
    pdf = pd.DataFrame(rows, columns=["account_id", "season", "set", "v"])
    want = pdf.groupby(["account_id", "season", "set"]).size().unstack(["season", "set"], fill_value=0)
    got = got.set_index("account_id").sort_index()
    for s in ("s0", "s1", "s2"):
        for t in ("0", "1", "2", "3"):
            w = want[(s, t)] if (s, t) in want.columns else 0
            assert (got[f"c_{s}_{t}"].values == pd.Series(w, index=want.index).sort_index().values).all()
    assert got.loc[0, "total_v"] == pdf[pdf.account_id == 0].v.sum()


def test_feature_table_is_repartition_invariant(spark):
    b = read_bundle(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = build_features(b).orderBy("account_id").collect()
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        c = build_features(b).orderBy("account_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(a) == len(c) and all(x == y for x, y in zip(a, c))


def test_feature_plan_prunes_scans(spark):
    f = build_features(read_bundle(spark, SF_SMALL))
    plan = f._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas, "no parquet scans found"
    for unused in ("l_extendedprice", "l_discount", "l_tax", "l_shipdate", "c_name", "p_name", "p_retailprice"):
        assert all(unused not in s for s in schemas), unused


def test_home_state_fallback_rules(spark):
    acc = spark.createDataFrame(
        [(1, "1234", " Springfield "), (2, "", "springfield"), (3, "", "Elsewhere"), (4, "99999", ""), (5, "", "")],
        "account_id long, billing_zip_code string, billing_city string")
    directory = spark.createDataFrame(
        [("1234", "SPRINGFIELD", "CA", 37.0, -122.0), ("99999", "FAR", "NV", 39.0, -119.0)],
        "Zipcode string, City string, State string, Lat double, Long double")
    g = G.geo_accounts(acc, directory, G.GeoConfig(hot_min_accounts=1)).orderBy("account_id").collect()
    state = {r["account_id"]: r["State"] for r in g}
    assert state == {1: "CA", 2: "CA", 3: None, 4: "NV", 5: None}
    missing = {r["account_id"]: r["missing"] for r in g}
    assert missing == {1: 0.0, 2: 0.0, 3: 0.0, 4: 0.0, 5: 1.0}
    hot = {r["account_id"]: r["hotspot"] for r in g}
    assert hot[1] == "Yes" and hot[2] == "No"
    d = {r["account_id"]: r["dSF"] for r in g}
    assert d[2] is None and 20 < d[1] < 60
