"""What the operators of this subpackage share: the tables, the shared folder and Arrow batches."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local session, all in one process,
    takes one below its warehouse; on a cluster it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tidemark"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read again, so that lost executors cost no recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch sent to a Python worker, where the session has Spark's default (64 MB).
BATCH_BYTES = 4 << 20


def arrow_map(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of bounded bytes, so that long texts cost tasks little memory."""
    name, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if conf.get(name) in ("67108864b", "64MB", "67108864"):
        conf.set(name, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it none of the columns of ``df`` (whatever their case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (a stored table) with a broadcast hint if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def whole_text(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def digest(text):
    """16 bytes that name a text."""
    return F.unhex(F.md5(text.cast("binary")))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column of texts as one array, and where each text starts (one more entry at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data = pc.fill_null(column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).cast(pa.large_binary()), b"")
    if len(data) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, body = data.buffers()
    offsets = np.frombuffer(at, np.int64)[data.offset : data.offset + len(data) + 1]
    raw = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches, rows: int = 512, limit: int = 1 << 20, column: str = "text"):
    """Cuts batches so that each part holds few bytes of text; a single longer text is a part of its own."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + limit, side="right"))
            stop = min(max(stop, start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def labelled(docs: DataFrame, labels: DataFrame, label: str, bound: int, chosen=None) -> DataFrame:
    """At most ``bound`` labelled documents: doc_id, text and ``label`` (0 or 1), picked by a hash of doc_id.

    Rows whose label is null are left out; of repeated label rows for one doc_id the largest label holds. The bound on
    the rows of ``labels`` makes the broadcast side bounded as well.
    """
    few = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if chosen is not None:
        few = few.where(chosen)
    few = few.groupBy("doc_id").agg(F.max(label).cast("int").alias(label)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    return docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(few), "doc_id")
