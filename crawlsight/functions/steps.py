"""Counting rows out: n rows from one, without an array of n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AT_ONCE = 1024


def counted_out(rows: DataFrame, n: Column, name: str) -> DataFrame:
    """Each row ``n`` times, ``name`` counting from 0; rows with ``n`` below 1 or NULL go.

    In two steps, so that a row which becomes a million is no array of a million.
    """
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / AT_ONCE))
    inside = F.sequence(F.col("_block") * AT_ONCE, F.least((F.col("_block") + 1) * AT_ONCE, F.col("_n")) - 1)
    wanted = rows.withColumn("_n", n.cast("long")).where("_n > 0")
    return wanted.withColumn("_block", F.explode(blocks)).withColumn(name, F.explode(inside)).drop("_n", "_block")
