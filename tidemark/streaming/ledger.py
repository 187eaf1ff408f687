"""The first-seen ledger over a stream of observations: keyed state, changed deals only, and compaction.

    <path>/changes/epoch=<n>/     what batch n changed: the whole record of each deal that it touched, and what became true in it
    <path>/audit/epoch=<n>/       a row for each feed of batch n
    <path>/snapshots/v=<n>/       all records after batch n

The state of a deal is minima and maxima and lives in the state store, without a watermark, as a first sight must never expire. A
batch writes the deals that it touched and nothing else, so its bytes grow with the batch and not with the ledger. When as many
records have been written since the last snapshot as that has, they are folded into a new one: each record is written again about
twice in all. Records only ever gain facts, so a reader that sees some of a batch's files sees less, but nothing wrong; a batch
repeated after a failure writes the same folder again, and a snapshot counts once it is complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ledger import KEYS, LEDGER, STAMPS, merged
from tidemark.sources.files import complete, remove

CHANGES = f"{LEDGER}, is_new boolean, is_cancelled_new boolean, is_rgst_new boolean"
AUDIT = "feed string, run_date date, n_window long, n_new long, n_cancelled_new long, n_rgst_new long"
#: Fixed for a query from its first batch on: large state is kept outside the heap, and a batch checkpoints what it changed.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def ledger_changes(observations: DataFrame) -> DataFrame:
    """The records of a stream's deals, and whether the batch that emits a record made it, or its cancellation or registration,
    known: every fact has the time of the batch that brought it."""
    run, now = F.col("run_date"), F.col("_now")
    gone, filled = F.col("is_cancelled"), F.col("has_rgst")
    state = observations.withColumn("_now", F.current_timestamp()).groupBy(*KEYS).agg(
        F.min(run).alias(STAMPS[0]), F.max(run).alias(STAMPS[1]), F.min(F.when(gone, run)).alias(STAMPS[2]), F.min(F.when(filled, run)).alias(STAMPS[3]),
        F.max(now).alias("_last"), F.min(now).alias("_new"), F.min(F.when(gone, now)).alias("_gone"), F.min(F.when(filled, now)).alias("_filled"),
    )
    here = lambda c, name: F.coalesce(F.col(c) == F.col("_last"), F.lit(False)).alias(name)
    return state.select(*KEYS, *STAMPS, here("_new", "is_new"), here("_gone", "is_cancelled_new"), here("_filled", "is_rgst_new"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All records: the last complete snapshot, and what batches have changed since."""
    last = max(complete(spark, f"{path}/snapshots", "v"), default=None)
    parts = [spark.read.schema(LEDGER).parquet(f"{path}/snapshots/v={last}")] if last is not None else []
    later = [n for n in complete(spark, f"{path}/changes", "epoch") if last is None or n > last]
    if later:
        parts.append(spark.read.schema(LEDGER).parquet(*[f"{path}/changes/epoch={n}" for n in later]))
    if not parts:
        return spark.createDataFrame([], LEDGER)
    return merged(parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]) if later else parts[0]


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The batches' audit rows, with their ``epoch``."""
    return spark.read.schema(f"{AUDIT}, epoch long").parquet(f"{path}/audit")


def compact(spark: SparkSession, path: str) -> int | None:
    """Folds all complete batches into a new snapshot and returns its number. The snapshot before it and the changes since then
    stay for those who are reading them; what is older goes."""
    epochs, snapshots = complete(spark, f"{path}/changes", "epoch"), complete(spark, f"{path}/snapshots", "v")
    if not epochs or max(epochs) in snapshots:
        return max(snapshots, default=None)
    read_ledger(spark, path).write.mode("overwrite").parquet(f"{path}/snapshots/v={max(epochs)}")
    before = max(snapshots, default=None)
    if before is not None:
        remove(spark, [f"{path}/snapshots/v={n}" for n in snapshots if n < before] + [f"{path}/changes/epoch={n}" for n in epochs if n <= before])
    return max(epochs)


def _due(spark: SparkSession, path: str) -> bool:
    """Whether the changes since the last snapshot have as many records as the snapshot; counts come from the files' footers."""
    last = max(complete(spark, f"{path}/snapshots", "v"), default=None)
    later = [f"{path}/changes/epoch={n}" for n in complete(spark, f"{path}/changes", "epoch") if last is None or n > last]
    if last is None or not later:
        return last is None and bool(later)
    return spark.read.schema(LEDGER).parquet(*later).count() >= spark.read.schema(LEDGER).parquet(f"{path}/snapshots/v={last}").count()


def keep_ledger(observations: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Folds what a stream has now into the ledger at ``path``; started again with the same checkpoint it goes on from there.

    A batch is a run: its audit row has the deals in it, those never seen before, and those cancelled or registered for the first
    time, under the latest run_date in it. An empty run is no batch and leaves everything as it is.
    """

    def fold(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/changes/epoch={epoch}")
        changed = spark.read.schema(CHANGES).parquet(f"{path}/changes/epoch={epoch}")
        counts = [F.count_if(F.col(c)).alias(n) for c, n in (("is_new", "n_new"), ("is_cancelled_new", "n_cancelled_new"), ("is_rgst_new", "n_rgst_new"))]
        changed.groupBy("feed").agg(F.max("last_seen_date").alias("run_date"), F.count(F.lit(1)).alias("n_window"), *counts).write.mode("overwrite").parquet(f"{path}/audit/epoch={epoch}")
        if _due(spark, path):
            compact(spark, path)

    spark = observations.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE}
    try:  # a query takes the settings that hold as it starts
        for k, v in STATE.items():
            spark.conf.set(k, v)
        return ledger_changes(observations).writeStream.outputMode("update").foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
