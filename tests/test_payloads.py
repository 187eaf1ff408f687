"""Every row of files in two encodings is decoded."""

import __spark_entry__ as entry


def test_every_item_is_decoded(spark, sf_dir):
    got = entry.QUERIES["payload_decode"](spark, sf_dir)
    ids = [r["c_custkey"] for r in spark.read.parquet(f"{sf_dir}/customer.parquet").collect()]
    assert sorted(map(tuple, got.collect())) == sorted((i, f"아파트{i}") for i in ids)
