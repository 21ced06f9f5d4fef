"""Shared helpers: reading, scratch tables on the shared folder, prefix sums.

Intermediate tables are written as Parquet below the folder that
``spark.checkpoint.dir`` names, which all executors share; a lost executor then costs
only the tasks it was running. Where the setting is absent (tests) a temporary folder
of this machine is taken, and only for a ``local[...]`` master.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Scratch tables by application: (owner, path).
_made: dict[str, list[tuple[str, str]]] = {}
_owner: ContextVar[str] = ContextVar("owner", default="")
_local: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables; a clear error on a cluster without one."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="llm-scratch-"))
    return f"file://{_local[0]}"


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to a new shared table and read it back: computed once, lineage cut. Spark deletes
    the shuffle files of jobs that nothing refers to any more when the driver collects its garbage, so
    that is asked for here. With ``keep``, :func:`drop_scratch` leaves the table alone in any case."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not keep:
        _made.setdefault(spark.sparkContext.applicationId, []).append((_owner.get(), path))
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def discard(df: DataFrame) -> None:
    """Delete a table of :func:`stored` that no later step reads."""
    app, path = df.sparkSession.sparkContext.applicationId, df.scratch_path
    _made[app] = [x for x in _made.get(app, []) if x[1] != path]
    _delete(df.sparkSession, [path])


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def owned(owner: str) -> Iterator[None]:
    """Scratch tables written inside belong to ``owner``, for :func:`drop_scratch`."""
    before = _owner.set(owner)
    try:
        yield
    finally:
        _owner.reset(before)


def drop_scratch(spark: SparkSession, owner: str = "") -> None:
    """Delete the scratch tables of ``owner`` written so far by this application, and no others. Call it once the
    results that read them have been written."""
    app = spark.sparkContext.applicationId
    gone = [p for o, p in _made.get(app, []) if o == owner]
    _made[app] = [x for x in _made.get(app, []) if x[0] != owner]
    _delete(spark, gone)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text", *more: str) -> DataFrame:
    """(doc_id, text, more...) only, so that further columns of any name cannot clash.
    Null text becomes empty; rows without a key are left out, as no result can name them."""
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
                       *[F.col(f"`{c}`") for c in more]).where("doc_id is not null")


def versions(base: DataFrame, name: str) -> DataFrame | None:
    """(doc_id, sha, version): the distinct texts of the doc_ids that ``base`` (doc_id, text) has in several rows,
    numbered from 0 in the order of their SHA-256. None where no doc_id repeats, which costs one count of ids."""
    again = stored(base.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), f"{name}-again")
    if again.isEmpty():
        discard(again)
        return None
    shas = base.join(again, "doc_id", "left_semi").select("doc_id", F.sha2("text", 256).alias("sha")).distinct()
    numbered = prefix_sum(shas.withColumn("one", F.lit(1).cast("long")), ["doc_id"], ["sha"], "one", "version", f"{name}-shas")
    return stored(numbered.select("doc_id", "sha", "version"), f"{name}-versions")


def with_version(rows: DataFrame, numbers: DataFrame | None) -> DataFrame:
    """``rows`` (doc_id, text, ...) with ``version``: 0 unless :func:`versions` numbered the text otherwise."""
    if numbers is None:
        return rows.withColumn("version", F.lit(0).cast("long"))
    found = rows.withColumn("sha", F.sha2("text", 256)).join(numbers, ["doc_id", "sha"], "left")
    return found.select(*rows.columns, F.coalesce("version", F.lit(0).cast("long")).alias("version"))


def each_once(base: DataFrame, numbers: DataFrame | None) -> DataFrame:
    """``base`` (doc_id, text) with ``version``, one row for each doc_id and text."""
    if numbers is None:
        return with_version(base, None)
    ids = numbers.select("doc_id").distinct()
    some = with_version(base.join(ids, "doc_id", "left_semi"), numbers).dropDuplicates(["doc_id", "version"])
    return with_version(base.join(ids, "doc_id", "left_anti"), None).unionByName(some)


def carried(docs: DataFrame, rest: list[str]) -> DataFrame:
    """``docs`` with the columns ``rest`` also as one struct, ``rest``."""
    return docs.withColumn("rest", F.struct(*[F.col(f"`{c}`") for c in rest])) if rest else docs


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """``df`` with further columns, each worked out once for a row. A plain projection may be merged
    into the next, and an array would then be built anew for each element of a lambda over it."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def prefix_sum(df: DataFrame, group: list[str], order: list[str], value: str, out: str,
               name: str) -> DataFrame:
    """Exclusive running sum of ``value`` within ``group`` by ``order``, for groups of any size.

    Rows are range-partitioned by (group, order) and stored with their partition's number;
    each partition sums its own rows, and only one total for each (group, partition) is
    summed across partitions. A group that holds most rows is spread over many partitions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(df.repartitionByRange(parts, *group, *order)
                    .withColumn("__part", F.spark_partition_id()), name)
    local = Window.partitionBy("__part", *group).orderBy(*order)
    rows = ranged.withColumn("__in", F.sum(value).over(local.rowsBetween(Window.unboundedPreceding, 0))
                             - F.col(value))
    totals = ranged.groupBy("__part", *group).agg(F.sum(value).alias("__total"))
    across = Window.partitionBy(*group).orderBy("__part") if group else Window.orderBy("__part")
    base = totals.withColumn(
        "__base", F.coalesce(F.sum("__total").over(across.rowsBetween(Window.unboundedPreceding, -1)),
                             F.lit(0))).drop("__total")
    on = F.lit(True)
    left, right = rows.alias("r"), base.alias("b")
    for c in ["__part", *group]:
        on = on & F.col(f"r.{c}").eqNullSafe(F.col(f"b.{c}"))
    keep = [F.col(f"r.{c}") for c in df.columns]
    return left.join(right, on).select(*keep, (F.col("__in") + F.col("__base")).alias(out))
