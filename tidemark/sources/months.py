"""A lake by region and month, whose months are replaced as a whole while others read it.

    <root>/rows/run=<run>/region=<region>/deal_ym=<month>/     the rows that a run has written
    <root>/live/v=<n>/                                         version n: which run's rows hold for each (region, deal_ym)

A run writes its rows beside those that hold, and then a version that names them. A version counts once it is complete, so readers
see a run's months all or not at all, also those that it has emptied, and a run that fails leaves no trace in what is read. Two
runs that write the same version are told apart: the second one fails. A reader joins the rows with a version on the
partition columns alone, so that only live partitions are scanned.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .files import complete, remove

LIVE = "run string, region string, deal_ym string"
MONTH = ["region", "deal_ym"]


def live_months(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """run, region and deal_ym of a version, by default the last one; without any version no rows."""
    version = max(complete(spark, f"{root}/live", "v"), default=None) if version is None else version
    return spark.createDataFrame([], LIVE) if version is None else spark.read.schema(LIVE).parquet(f"{root}/live/v={version}")


def read_months(spark: SparkSession, root: str, schema: str, version: int | None = None) -> DataFrame:
    """The rows that hold (``schema`` names all columns but the run)."""
    live = live_months(spark, root, version)
    if not complete(spark, f"{root}/live", "v"):
        return spark.createDataFrame([], schema)
    runs = [r["run"] for r in live.select("run").distinct().collect()]  # few
    if not runs:
        return spark.createDataFrame([], schema)
    # Months by a pattern are listed in one job; below a folder, Spark begins a job for each region.
    rows = spark.read.schema(f"{schema}, run string").option("basePath", f"{root}/rows").parquet(*[f"{root}/rows/run={r}/region=*/deal_ym=*" for r in runs])
    live = live.where("run > ''")  # true of all; partitions are pruned at run time only by a side that has a condition
    return rows.join(live, ["run", *MONTH], "left_semi").select(*[c for c in rows.columns if c != "run"])


def _by_month(rows: DataFrame) -> DataFrame:
    """``rows`` in stretches of like many rows, in the order of the months: a month has a file, and one more for each stretch that
    begins in it, not one for each task that had rows of it. Each task of a stretch has its own months to write; a month with very
    many rows has several."""
    within = [F.col(c) for c, kind in rows.dtypes if c not in MONTH and "map<" not in kind and "variant" not in kind]
    return rows.repartitionByRange(4 * rows.sparkSession.sparkContext.defaultParallelism, *MONTH, *([F.xxhash64(*within)] if within else []))


def replace_months(fetched: DataFrame, refetched: DataFrame, root: str) -> int:
    """Replaces the months of ``refetched`` (region, deal_ym) and all that ``fetched`` has rows of, and returns the new version. A
    month fetched empty loses its rows: that is why months are given apart from rows. A row without region or month is an error.
    ``fetched`` may be read from the same lake."""
    spark, run = fetched.sparkSession, uuid.uuid4().hex
    version = max(complete(spark, f"{root}/live", "v"), default=-1) + 1
    known = lambda c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"a row without {c}"))).otherwise(F.col(c).cast("string"))
    written = Observation()
    rows = _by_month(fetched.withColumns({c: known(c) for c in MONTH})).observe(written, F.collect_set(F.struct(*MONTH)).alias("months"))
    rows.write.partitionBy(*MONTH).parquet(f"{root}/rows/run={run}")
    new = spark.createDataFrame([tuple(m) for m in written.get["months"]], "region string, deal_ym string")  # a name for each folder
    gone = refetched.select(*[F.col(c).cast("string").alias(c) for c in MONTH]).union(new).distinct()
    live = live_months(spark, root).join(gone, MONTH, "left_anti").unionByName(new.withColumn("run", F.lit(run)))
    live.write.parquet(f"{root}/live/v={version}")
    return version


def forget(spark: SparkSession, root: str, versions: int = 2) -> None:
    """Removes all but the last ``versions`` versions, and the rows of runs that none of these names. Not to be called while a run
    writes. Runs are few: a folder each."""
    have = sorted(complete(spark, f"{root}/live", "v"))
    kept = have[-versions:]
    if not kept:
        return
    named = spark.read.schema(LIVE).parquet(*[f"{root}/live/v={v}" for v in kept]).select("run").distinct()
    runs = complete(spark, f"{root}/rows", "run", str)
    old = spark.createDataFrame([(r,) for r in runs], "run string").join(named, "run", "left_anti").collect()
    remove(spark, [f"{root}/live/v={v}" for v in have[:-versions]] + [f"{root}/rows/run={r['run']}" for r in old])
