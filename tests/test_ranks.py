"""Ranks of values that are not the same when they are computed again."""

import random

from pyspark.sql import functions as F

from tidemark.operators import evaluate


def test_values_are_computed_once(spark):
    value = F.udf(lambda i: random.random(), "double").asNondeterministic()
    rows = spark.range(200).select(value("id").alias("a"), F.col("id").cast("double").alias("b"))
    assert evaluate.spearman(rows, "a", "b").first()["n"] == 200
