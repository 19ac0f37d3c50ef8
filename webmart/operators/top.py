"""The greatest rows of each group, for any number of rows and groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webmart.sinks.tables import ScratchStore

#: Bins for each doubling of a value, and the bins of what has no place among numbers.
_FINE = 256
_UNKNOWN, _NO_NUMBER = -(1 << 20), 1 << 20


def value_bin(value: Column) -> Column:
    """A whole number that never falls while the value rises: 256 for each doubling of one plus its size.

    NULL comes before all numbers and NaN after, as in a descending order with NULL last.
    """
    size = F.least(F.abs(value), F.lit(1.7e308))
    place = F.floor(F.log2(size + 1) * _FINE).cast("int")
    signed = F.when(value < 0, -place).otherwise(place)
    return F.when(value.isNull(), _UNKNOWN).when(F.isnan(value), _NO_NUMBER).otherwise(signed)


def cut_offs(binned: DataFrame, keys: Sequence[str], count: int) -> DataFrame:
    """The keys and the least bin that may hold one of a group's ``count`` greatest rows.

    Counts per group and bin add up before they are shuffled, and there are some thousand bins at most in a group.
    """
    sizes = binned.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_size"))
    above = Window.partitionBy(*keys).orderBy(F.col("_bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    greater = F.coalesce(F.sum("_size").over(above), F.lit(0))
    reached = sizes.withColumn("_greater", greater).where(F.col("_greater") < count)
    return reached.groupBy(*keys).agg(F.min("_bin").alias("_least"))


def top_rows(frame: DataFrame, keys: Sequence[str], value: str, ties: Sequence[Column], count: int) -> DataFrame:
    """The ``count`` rows of each group with the greatest value; equal ones in the order of ``ties``.

    A first pass counts rows per group and bin of values. It gives each group a bin below which no row can be among the
    greatest, so that only the rows from there on are shuffled and ranked: little more than ``count`` a group, unless very
    many rows share the value at the cut. The cut-offs, a row per group, are saved, so Spark knows their size when it joins.
    """
    binned = frame.withColumn("_bin", value_bin(F.col(value).cast("double")))
    least = ScratchStore(frame.sparkSession).save("top", "cut_offs", cut_offs(binned, keys, count))
    own = least.select(*[F.col(key).alias(f"_{key}") for key in keys], "_least")
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    kept = binned.join(own, [*same, F.col("_bin") >= F.col("_least")]).select(*frame.columns)
    order = [F.col(value).desc_nulls_last(), *ties]
    ranked = kept.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_place") <= count).drop("_place")
