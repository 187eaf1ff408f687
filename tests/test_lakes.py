"""Lakes that are written while they are read, and the ledger over a stream: replays, failures, empty runs, bytes a batch."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ledger
from tidemark.sources import files, months
from tidemark.streaming import ledger as stream

SCHEMA = "deal_id long, price double, region string, deal_ym string"


@pytest.fixture
def root(spark, tmp_path):
    return f"file://{tmp_path}"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_months_are_replaced_whole(spark, root):
    old = spark.createDataFrame([(1, 1.0, "a", "202401"), (2, 2.0, "a", "202402"), (3, 3.0, "b", "202401")], SCHEMA)
    assert months.read_months(spark, root, SCHEMA).count() == 0
    assert months.replace_months(old, old.limit(0), root) == 0
    asked = spark.createDataFrame([("a", "202401"), ("a", "202402"), ("c", "202401")], "region string, deal_ym string")
    new = months.read_months(spark, root, SCHEMA).where("deal_ym = '202401' AND region = 'a'").withColumn("price", F.lit(9.0))
    for version in (1, 2):  # the second time it reads what the first has written
        assert months.replace_months(new, asked, root) == version
        assert rows(months.read_months(spark, root, SCHEMA)) == [(1, 9.0, "a", "202401"), (3, 3.0, "b", "202401")]
    assert rows(months.read_months(spark, root, SCHEMA, version=0)) == rows(old)
    plan = months.read_months(spark, root, SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    months.forget(spark, root)
    assert rows(months.read_months(spark, root, SCHEMA)) == [(1, 9.0, "a", "202401"), (3, 3.0, "b", "202401")]
    assert sorted(files.complete(spark, f"{root}/live", "v")) == [1, 2] and len(files.complete(spark, f"{root}/rows", "run", str)) == 3


def test_a_failed_run_leaves_the_months(spark, root):
    old = spark.createDataFrame([(1, 1.0, "a", "202401"), (2, 2.0, "b", "202401")], SCHEMA)
    months.replace_months(old, old, root)
    broken = old.withColumn("price", F.when(F.col("region") == "b", F.raise_error(F.lit("broken")).cast("double")).otherwise(0.0))
    for bad in (broken, old.withColumn("region", F.lit(None).cast("string"))):
        with pytest.raises(Exception, match="broken|without region"):
            months.replace_months(bad, old, root)
        assert rows(months.read_months(spark, root, SCHEMA)) == rows(old)
    # A run that has written its rows, but no version.
    old.withColumn("price", F.lit(7.0)).write.partitionBy("region", "deal_ym").parquet(f"{root}/rows/run=lost")
    assert rows(months.read_months(spark, root, SCHEMA)) == rows(old)


def test_map_region_lake(spark, root):
    lake = spark.createDataFrame([(1, 1.0, "202401", "a"), (2, 2.0, "202401", "a"), (3, 3.0, "202401", "b")], "deal_id long, price double, deal_ym string, region string")
    files.write_regions(lake, f"{root}/raw")
    files.write_regions(lake.withColumn("price", F.lit(-1.0)).union(lake.withColumn("region", F.lit("kept"))), f"{root}/out")
    n = files.map_region_lake(spark, f"{root}/raw", f"{root}/out", lake.schema, lambda df: df.where("price < 3"))
    assert n == {"regions": 2, "rows_in": 3, "rows_out": 2}
    out = files.read_region_lake(spark, f"{root}/out", lake.schema)
    assert rows(out.select("region", "price")) == [("a", 1.0), ("a", 2.0), ("kept", 1.0), ("kept", 2.0), ("kept", 3.0)]


def test_row_counts_read_no_column(spark, root):
    spark.range(10).write.parquet(f"{root}/x")
    spark.range(7).withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(f"{root}/y")
    spark.range(0).write.parquet(f"{root}/z")
    assert rows(files.lake_row_counts(spark, root, ["x", "y", "z", "w"])) == [("w", 0), ("x", 10), ("y", 7), ("z", 0)]
    assert rows(files.lake_row_counts(spark, f"{root}/nowhere", ["x"])) == [("x", 0)]
    plan = files.lake_row_counts(spark, root, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


OBS = "feed string, region string, deal_key string, is_cancelled boolean, has_rgst boolean, run_date date"


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


def run(spark, root, batch):
    spark.createDataFrame(batch, OBS).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream.keep_ledger(spark.readStream.schema(OBS).parquet(f"{root}/in"), f"{root}/ledger", f"{root}/state").awaitTermination()


def test_stream_writes_what_changed(spark, root, tmp_path):
    day = lambda n: dt.date(2024, 1, n)
    settings = {k: spark.conf.get(k, None) for k in stream.STATE}
    first = [("l", str(i % 3), f"k{i}", False, False, day(1)) for i in range(3000)]
    second = [("l", "0", "k0", True, False, day(2)), ("l", "0", "new", False, True, day(2)), ("m", "0", "k0", False, False, day(2))]
    third = [("l", "0", "k0", True, True, day(3)), ("l", "1", "k1", False, False, dt.date(2023, 12, 31))]  # and a late report
    seen = []
    for batch in (first, second, second, third):
        run(spark, root, batch)
        seen += batch
        assert rows(stream.read_ledger(spark, f"{root}/ledger")) == rows(ledger.ledger_of(spark.createDataFrame(seen, OBS)))
    bytes_of = [size(tmp_path / f"ledger/changes/epoch={n}") for n in range(4)]
    assert max(bytes_of[1:]) < bytes_of[0] / 3 and spark.read.parquet(f"{root}/ledger/changes/epoch=3").count() == 2
    audit = [tuple(r) for r in stream.read_audit(spark, f"{root}/ledger").orderBy("epoch", "feed").select("epoch", "feed", "n_window", "n_new", "n_cancelled_new", "n_rgst_new").collect()]
    assert audit == [(0, "l", 3000, 3000, 0, 0), (1, "l", 2, 1, 1, 1), (1, "m", 1, 1, 0, 0), (2, "l", 2, 0, 0, 0), (2, "m", 1, 0, 0, 0), (3, "l", 2, 0, 0, 1)]
    assert {k: spark.conf.get(k, None) for k in stream.STATE} == settings
    # An empty run is no batch; compaction changes no record and drops what two snapshots have.
    stream.keep_ledger(spark.readStream.schema(OBS).parquet(f"{root}/in"), f"{root}/ledger", f"{root}/state").awaitTermination()
    want = rows(stream.read_ledger(spark, f"{root}/ledger"))
    assert files.complete(spark, f"{root}/ledger/snapshots", "v") == [0] and stream.compact(spark, f"{root}/ledger") == 3
    assert rows(stream.read_ledger(spark, f"{root}/ledger")) == want == rows(spark.read.schema(ledger.LEDGER).parquet(f"{root}/ledger/snapshots/v=3"))
    assert sorted(files.complete(spark, f"{root}/ledger/changes", "epoch")) == [1, 2, 3]
    # A batch that was cut off is written again, whole.
    run(spark, root, [("l", "2", "k2", True, False, day(9))])
    assert stream.compact(spark, f"{root}/ledger") == 4 and sorted(files.complete(spark, f"{root}/ledger/changes", "epoch")) == [4]
    assert sorted(files.complete(spark, f"{root}/ledger/snapshots", "v")) == [3, 4]


def test_months_have_few_files_and_one_listing(spark, root, tmp_path):
    """Each task used to write a file to every month that it had rows of, and each region was listed by a job of its own."""
    months_of = F.concat(F.lit("20240"), (F.col("id") % 5 + 1).cast("string"))
    old = spark.range(20_000, numPartitions=40).select(F.col("id").alias("deal_id"), F.lit(1.0).alias("price"), (F.col("id") % 3).cast("string").alias("region"), months_of.alias("deal_ym"))
    months.replace_months(old, old.limit(0), root)
    written = [n for _, _, names in os.walk(tmp_path / "rows") for n in names if n.endswith(".parquet")]
    assert len(written) <= 15 + 4 * spark.sparkContext.defaultParallelism  # 600 before
    held = months.read_months(spark, root, SCHEMA)
    assert rows(held) == rows(old.select(*held.columns))
    # Months of many rows, rows of one month and a lake that loses all its months.
    one = old.withColumns({"region": F.lit("a=b/*"), "deal_ym": F.lit("202401")})
    months.replace_months(one, old, root)
    held = months.read_months(spark, root, SCHEMA)
    assert rows(held) == rows(one.select(*held.columns)) and len(held.inputFiles()) > 1
    months.replace_months(one.limit(0), one, root)
    assert months.read_months(spark, root, SCHEMA).count() == 0
