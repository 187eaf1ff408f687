"""Lakes of Parquet files by region, snapshots, tables, reference files and landed payloads."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.names import code_level


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, under spark.checkpoint.dir. Where that is unset, a local session, all in
    one process, takes one below its warehouse; on a cluster there is no such folder, and it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tidemark"
    return f"{folder.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to a work folder and read again: lost executors cost no recomputation, and what reads them twice
    computes them once."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def complete(spark: SparkSession, path: str, key: str, kind: type = int) -> list:
    """The values of the folders ``<path>/<key>=<value>`` whose writing has ended."""
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return []
    found = [f.getPath() for f in fs.listStatus(p) if f.getPath().getName().startswith(f"{key}=")]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return [kind(f.getName().partition("=")[2]) for f in found if fs.exists(done(f, "_SUCCESS"))]


def remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        fs, p = _folder(spark, path)
        fs.delete(p, True)


def read_region_lake(spark: SparkSession, root: str, schema: StructType | str, columns: list[str] | None = None) -> DataFrame:
    """All regions of ``<root>/region=<code>/``; the region comes from the path, as a string by the given schema."""
    df = spark.read.schema(schema).option("basePath", root).parquet(root)
    return df.select(*columns) if columns else df


def write_regions(df: DataFrame, root: str) -> None:
    """Replaces the partitions of the regions in ``df`` and no others; a failed write leaves the old ones."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("region").parquet(root)


def write_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def map_region_lake(spark: SparkSession, source: str, target: str, schema: StructType | str, transform: Callable[[DataFrame], DataFrame], columns: list[str] | None = None) -> dict[str, int]:
    """Reads all regions of ``source`` (or some columns of them), transforms them in one job and replaces these regions in
    ``target``. Returns regions, rows_in and rows_out, which the write itself has counted: no other pass is made. A region whose
    rows all go is removed from ``target``, as no rows of it could replace the old ones."""
    read, written = Observation(), Observation()
    some = lambda: (F.count(F.lit(1)).alias("n"), F.collect_set("region").alias("regions"))  # noqa: E731  a name each, as many as partitions
    rows = read_region_lake(spark, source, schema, columns).observe(read, *some())
    write_regions(transform(rows).observe(written, *some()), target)
    remove(spark, [f"{target}/region={r}" for r in set(read.get["regions"]) - set(written.get["regions"])])
    return {"regions": len(read.get["regions"]), "rows_in": read.get["n"], "rows_out": written.get["n"]}


def lake_row_counts(spark: SparkSession, root: str, sources: list[str]) -> DataFrame:
    """Rows of each wanted source, a folder below ``root`` with Parquet files at any depth; a missing or empty one counts 0. One
    scan of all sources that reads no column: rows come from the files' footers, sources from their paths."""
    wanted = spark.createDataFrame([(s,) for s in sources], "source string")
    if not exists(spark, root):
        return wanted.withColumn("n_rows", F.lit(0).cast("long"))
    length = len(_folder(spark, root)[1].toUri().getPath().rstrip("/"))
    path = F.parse_url(F.col("_metadata.file_path"), F.lit("PATH"))
    rows = spark.read.schema(StructType([])).option("recursiveFileLookup", True).parquet(root)
    counts = rows.select(F.split_part(F.substring(path, length + 2, 10_000), F.lit("/"), F.lit(1)).alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(counts, "source", "left").select("source", F.coalesce("n", F.lit(0).cast("long")).alias("n_rows"))


def reload_nonempty(spark: SparkSession, root: str, tables: dict[str, str], paths: dict[str, str] | None = None) -> dict[str, int]:
    """(Re)loads the table of each source (source -> table) that has rows, and returns the rows loaded; a source without rows leaves
    its table alone. ``paths`` names folders of external tables."""
    have = {r["source"] for r in lake_row_counts(spark, root, list(tables)).where("n_rows > 0").collect()}  # a row a source
    return {s: load_table(spark.read.option("recursiveFileLookup", True).parquet(f"{root}/{s}"), t, path=(paths or {}).get(s)) for s, t in tables.items() if s in have}


def load_table(df: DataFrame, table: str, truncate: bool = True, path: str | None = None) -> int:
    """(Re)loads a catalog table, an external one if a ``path`` is given; returns its rows."""
    writer = df.write.mode("overwrite" if truncate else "append")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table).count()


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The stored table, or an empty one with the schema where nothing is stored yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A text table with a header and given types: codes stay strings."""
    return spark.read.csv(path, schema=schema, sep=sep, header=True, enforceSchema=True)


def read_district_reference(spark: SparkSession, path: str) -> DataFrame:
    """The district file: code, name, status, split by tabs; rows with a 10-digit code, and what the code tells."""
    raw = read_csv(spark, path, "code string, name string, status string", sep="\t").where(F.col("code").rlike("^[0-9]{10}$"))
    code = F.col("code")
    return raw.select("code", F.trim("name").alias("name"), "status", (F.trim("status") == "존재").alias("is_active"), F.substring(code, 1, 2).alias("sido_code"), F.substring(code, 1, 5).alias("sigungu_code"), F.substring(code, 6, 5).alias("emd_code"), code_level(code).alias("level"))


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    """payload_id (the file) and body of landed responses, a file each. Bytes that are not UTF-8 are read as EUC-KR, and those that are
    neither as UTF-8 with replacement marks. Files are read and decoded by tasks; a response must fit in one. A file of no bytes is no response and is not seen."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return raw.select(F.col("path").alias("payload_id"), F.pandas_udf(_decoded, "string")("content").alias("body"))


def _decoded(contents: pd.Series) -> pd.Series:
    def text(raw: bytes) -> str:
        for charset in ("utf-8", "euc-kr"):
            try:
                return raw.decode(charset)
            except UnicodeDecodeError:
                continue
        return raw.decode("utf-8", errors="replace")

    return contents.map(text)


def _envelopes(bodies: DataFrame, item_schema: str, code: str) -> DataFrame:
    schema = f"header struct<{code}: string, resultMsg: string>, body struct<items: struct<item: array<struct<{item_schema}>>>>"
    parsed = bodies.select("payload_id", F.from_xml("body", schema).alias("x"))
    return parsed.select("payload_id", F.col(f"x.header.{code}").alias("code"), F.col("x.header.resultMsg").alias("message"), F.col("x.body.items.item").alias("items"))


def xml_rows(bodies: DataFrame, item_schema: str, code: str = "resultCode", good: tuple[str, ...] = ("000", "00")) -> DataFrame:
    """Items of XML responses (payload_id, body), a row an item, also of a single one; error responses and empty bodies give none."""
    read = _envelopes(bodies, item_schema, code).where(F.col("code").isin(*good))
    return read.select("payload_id", F.explode("items").alias("i")).select("payload_id", "i.*")


def xml_rejects(bodies: DataFrame, code: str = "resultCode", good: tuple[str, ...] = ("000", "00")) -> DataFrame:
    """payload_id, code and message of responses that are errors, or that have no header (code null): empty and broken ones."""
    read = _envelopes(bodies, "id: string", code)
    return read.where(F.col("code").isNull() | ~F.col("code").isin(*good)).select("payload_id", "code", "message")


def json_rows(payloads: DataFrame, item_schema: str, path: str, code: str, good: str) -> DataFrame:
    """Items of landed JSON responses (payload_id, body) whose status, the JSON path ``code``, is ``good``."""
    items = F.from_json(F.get_json_object("body", path), f"array<struct<{item_schema}>>")
    return payloads.where(F.get_json_object("body", code) == good).select("payload_id", F.explode(items).alias("i")).select("payload_id", "i.*")
