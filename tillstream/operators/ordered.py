"""Exact ordered scans (previous row, running sum) per key when one key may be huge.

A window partitioned by a key sorts all rows of that key in one task. Here the rows are
first cut into ranges of (key, order): every range is small however hot a key is, because
a range may end inside a key. Windows then run per (range, key), and what must cross a range
boundary is carried over. At most one key spans any boundary, so the carried rows number at
most two per range and can be broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.session import cut_lineage

BUCKET = "_bucket"
TIE = "_tie"


@dataclass(frozen=True)
class Ranged:
    """Rows with the range they lie in; see ``into_ranges``."""

    df: DataFrame
    key: str
    order: tuple[str, ...]

    def with_previous(self, value: str, out: str) -> Ranged:
        """Add the ``value`` of the preceding row of the same key, null for the first row."""
        within = self._within()
        # The row before the first row of a range is the last row of the range before.
        before = (
            self.df.groupBy(BUCKET)
            .agg(F.max(F.struct(self._place().alias("place"), F.col(value).alias("value"))).alias("last"))
            .withColumn("before", F.lag("last").over(Window.orderBy(BUCKET)))
            .where(F.col("before").isNotNull())
            .select(
                F.col(BUCKET).alias("_b"),
                F.col(f"before.place.{self.key}").alias("_k"),
                F.col("before.value").alias("_v"),
            )
        )
        numbered = self.df.withColumn("_n", F.row_number().over(within)).withColumn(out, F.lag(value).over(within))
        carried = self._join(numbered, before).withColumn(
            out, F.when(F.col("_n") == 1, F.col("_v")).otherwise(F.col(out))
        )
        return replace(self, df=carried.drop("_n", "_b", "_k", "_v"))

    def with_running_sum(self, value: Column, out: str) -> Ranged:
        """Add the sum of ``value`` over the rows of the key up to and including this one."""
        valued = self.df.withColumn("_value", value)
        # Only a key that ends a range can have rows in the next one.
        spanning = (
            valued.groupBy(BUCKET)
            .agg(F.max(self._place()).alias("last"))
            .select(F.col(f"last.{self.key}").alias("_k"))
            .distinct()
        )
        earlier = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        parts = (
            valued.join(F.broadcast(spanning), F.col(self.key).eqNullSafe(F.col("_k")), "left_semi")
            .groupBy(F.col(BUCKET).alias("_b"), F.col(self.key).alias("_k"))
            .agg(F.sum("_value").alias("_part"))
            .withColumn("_carry", F.sum("_part").over(earlier))
            .where(F.col("_carry").isNotNull())
            .select("_b", "_k", "_carry")
        )
        up_to_here = self._within().rowsBetween(Window.unboundedPreceding, 0)
        summed = self._join(valued.withColumn(out, F.sum("_value").over(up_to_here)), parts).withColumn(
            out, F.col(out) + F.coalesce(F.col("_carry"), F.lit(0))
        )
        return replace(self, df=summed.drop("_value", "_b", "_k", "_carry"))

    def rows(self) -> DataFrame:
        """The rows without the marks of their ranges."""
        return self.df.drop(BUCKET, TIE)

    def _place(self) -> Column:
        return F.struct(self.key, *self.order, TIE)

    def _within(self):
        return Window.partitionBy(BUCKET, self.key).orderBy(*self.order, TIE)

    def _join(self, df: DataFrame, carried: DataFrame) -> DataFrame:
        same = (F.col(BUCKET) == F.col("_b")) & F.col(self.key).eqNullSafe(F.col("_k"))
        return df.join(F.broadcast(carried), same, "left")


def into_ranges(df: DataFrame, key: str, order: list[str], ranges: int | None = None) -> Ranged:
    """Cut ``df`` into ranges of (key, order) and fix that placement.

    ``order`` columns sort ascending, nulls first; a helper column can encode any other wish.
    A tie column splits equal rows too, so many copies of one row do no harm.
    The result is written out because the range of a row must not change between its uses.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.withColumn(TIE, F.monotonically_increasing_id())
        .repartitionByRange(ranges, key, *order, TIE)
        .withColumn(BUCKET, F.spark_partition_id())
    )
    return Ranged(cut_lineage(placed), key, tuple(order))
