"""Running sums and neighbours over a whole ordered table, without one task for all rows.

A window without partitions sorts everything in one task.  Here rows are cut by range of
the order, each range is sorted and summed by its own task, and only the ranges' totals
(one row each) meet, on the driver, to become the ranges' offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.plans.iterate import cut


class Ranges:
    """``df`` cut by range of ``order`` (unique, or ties are ranked as they come) and written once."""

    def __init__(self, df: DataFrame, order: list):
        self.order = order
        self.rows = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()))
        self.window = Window.partitionBy("__part").orderBy(*order)

    def _facts(self, *aggregates) -> list:
        """One row of aggregates for each range, in order (as many as there are partitions)."""
        return sorted(self.rows.groupBy("__part").agg(*aggregates).collect(), key=lambda r: r["__part"])

    def sums(self, **columns: str) -> DataFrame:
        """The rows with running sums: ``name=column`` adds the sum of ``column`` up to and with each row;
        the column ``1`` counts rows."""
        value = {n: F.lit(1) if c == "1" else F.col(c) for n, c in columns.items()}
        facts, before, offsets = self._facts(*[F.sum(v).alias(n) for n, v in value.items()]), dict.fromkeys(columns, 0), {}
        for r in facts:
            offsets[r["__part"]] = dict(before)
            before = {n: before[n] + (r[n] or 0) for n in columns}
        out = self.rows
        for n, v in value.items():
            pairs = [F.lit(x) for p, o in offsets.items() for x in (p, o[n])]
            offset = F.element_at(F.create_map(*pairs), F.col("__part")) if pairs else F.lit(0)
            out = out.withColumn(n, F.sum(v).over(self.window.rowsBetween(Window.unboundedPreceding, 0)) + offset)
        return out.drop("__part")

    def running_max(self, column: str, name: str) -> DataFrame:
        """The rows with the largest value of ``column`` up to and with each row as ``name``."""
        before, offsets = None, {}
        for r in self._facts(F.max(column).alias("m")):
            offsets[r["__part"]] = before
            before = r["m"] if before is None else before if r["m"] is None else max(before, r["m"])
        pairs = [F.lit(x) for p, o in offsets.items() if o is not None for x in (p, o)]
        offset = F.get(F.array(F.element_at(F.create_map(*pairs), F.col("__part"))), F.lit(0)) if pairs else F.lit(None)
        own = F.max(column).over(self.window.rowsBetween(Window.unboundedPreceding, 0))
        return self.rows.withColumn(name, F.greatest(own, offset.cast(self.rows.schema[column].dataType))).drop("__part")

    def following(self, column: str, name: str) -> DataFrame:
        """The rows with the ``column`` of the row behind each as ``name`` (null on the last)."""
        first = {r["__part"]: r["v"] for r in self.rows.withColumn("__r", F.row_number().over(self.window)).where("__r = 1")
                 .select("__part", F.col(column).alias("v")).collect()}
        parts = sorted(first)
        pairs = [F.lit(x) for p, q in zip(parts, parts[1:], strict=False) for x in (p, first[q])]
        edge = F.get(F.array(F.element_at(F.create_map(*pairs), F.col("__part"))), F.lit(0)) if pairs else F.lit(None)
        return self.rows.withColumn(name, F.coalesce(F.lead(column).over(self.window), edge)).drop("__part")
