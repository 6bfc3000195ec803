"""Running values within groups that may hold any share of the rows.

A window over a whole group is one task.  Here rows meet in ranges of their place, ``1 << BITS`` places long: what a range
needs of the ranges before it comes from one narrow row for each of them, made by aggregates that combine before their
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A range holds the places that agree but for their last BITS bits.
BITS = 16


def range_of(place: str, bits: int = BITS) -> Column:
    return F.shiftright(place, bits)


def ranked(rows: DataFrame, by: list[str], place: str, name: str, total: str | None = None, bits: int = BITS) -> DataFrame:
    """``rows`` with the number of each by ``place`` (unique, from 1) in its group, and on request the group's size."""
    rows = rows.withColumn("_range", range_of(place, bits))
    group = Window.partitionBy(*by)
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = rows.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    per = per.select(*[F.col(c).alias(f"_of_{c}") for c in [*by, "_range"]], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(group).alias("_total"))
    inside = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(place))
    joined = rows.withColumn("_inside", inside).join(per, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*by, "_range"]])
    out = joined.withColumn(name, F.col("_before") + F.col("_inside"))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_range", "_inside", "_before", "_total", *[f"_of_{c}" for c in [*by, "_range"]])


def last_before(rows: DataFrame, by: list[str], place: str, value: Column, name: str, bits: int = BITS) -> DataFrame:
    """``rows`` with the last value that is not null up to each row, by ``place`` in its group; values ascend with places."""
    rows = rows.withColumn("_range", range_of(place, bits)).withColumn("_value", value)
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = rows.groupBy(*by, "_range").agg(F.max("_value").alias("_last"))
    per = per.select(*[F.col(c).alias(f"_of_{c}") for c in [*by, "_range"]], F.max("_last").over(before).alias("_before"))
    inside = F.max("_value").over(Window.partitionBy(*by, "_range").orderBy(place).rowsBetween(Window.unboundedPreceding, 0))
    joined = rows.withColumn("_inside", inside).join(per, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*by, "_range"]])
    return joined.withColumn(name, F.coalesce("_inside", "_before")).drop("_range", "_value", "_inside", "_before", *[f"_of_{c}" for c in [*by, "_range"]])


def next_after(rows: DataFrame, by: str, place: str, value: Column, name: str, bits: int = BITS) -> DataFrame:
    """``rows`` with the first ``value`` that is not null after each row, by ``place`` in its group; values, structs, ascend with places.

    Rows of a null group get none.  Groups may be few and long: what meets is a range of a group, and one narrow row for each range.
    """
    rows = rows.withColumn("_range", range_of(place, bits)).withColumn("_value", value)
    later = Window.partitionBy(f"_of_{by}").orderBy(F.col("_of__range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    per = rows.groupBy(F.col(by).alias(f"_of_{by}"), F.col("_range").alias("_of__range")).agg(F.min("_value").alias("_first"))
    per = per.select(f"_of_{by}", "_of__range", F.min("_first").over(later).alias("_later"))
    # from the last place on, as Spark goes through a frame that ends behind a row again for each row
    back = Window.partitionBy(by, "_range").orderBy(F.col(place).desc(), F.col("_value").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    # keys that are compared as they are keep the rows where the window has dealt them
    joined = rows.withColumn("_inside", F.last("_value", True).over(back)).join(per, (F.col(by) == F.col(f"_of_{by}")) & (F.col("_range") == F.col("_of__range")), "left")
    return joined.withColumn(name, F.when(F.col(by).isNotNull(), F.coalesce("_inside", "_later"))).drop("_range", "_value", "_inside", "_later", f"_of_{by}", "_of__range")


def earlier(rows: DataFrame, place: str, n: str, name: str, levels: int = 2, bits: int = BITS) -> DataFrame:
    """``rows`` with the sum of ``n`` over all rows of smaller places (unique).

    Ranges are summed up by ranges of ranges, and so on; what is summed in one task at the end is a row for 1 << (levels * bits) places.
    """
    if not levels:
        return rows.withColumn(name, F.coalesce(F.sum(n).over(Window.orderBy(place).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own, of, before = f"_range_{levels}", f"_of_{levels}", f"_before_{levels}"
    rows = rows.withColumn(own, range_of(place, bits))
    per = earlier(rows.groupBy(own).agg(F.sum(n).alias(of)), own, of, before, levels - 1, bits).select(own, before)
    inside = F.sum(n).over(Window.partitionBy(own).orderBy(place).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn(name, F.coalesce(inside, F.lit(0))).join(per, own).withColumn(name, F.col(name) + F.col(before)).drop(own, before)
