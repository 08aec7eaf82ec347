"""Places in an order over a whole table, without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lookout.operators.store import Scratch


def numbered(rows: DataFrame, order: list[str], scratch: Scratch, out: str = "place") -> DataFrame:
    """rows with their place, from 1, in ascending order of the columns `order`, null first; rows that tie in all of them stand in any order.

    One pass: rows are dealt by ranges of the order and written, each with its number in its task; what comes before a task is a sum over one number
    a task.  No window holds more than that, and no row is shuffled twice.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_number", F.monotonically_increasing_id())
    table = scratch.cut(ranged)  # a number is the task's, shifted by 33 bits, and the row's in it
    task = F.shiftright("_number", 33)
    sizes = table.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))
    sizes = sizes.select(F.col("_task").alias("_of"), F.coalesce(F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    placed = table.join(F.broadcast(sizes), task == F.col("_of"))  # a row a task
    return placed.withColumn(out, F.col("_before") + F.col("_number").bitwiseAND((1 << 33) - 1) + 1).drop("_number", "_of", "_before")


def nth_text(rows: DataFrame, column: str, n: int, step: int = 6) -> str | None:
    """The n-th of the texts in ascending order (repeats count; null texts don't), null if there are fewer.

    By counts of the beginnings that are left, `step` characters longer each round: an aggregate with map-side sums over distinct beginnings, and no sort of rows.
    """
    start, left = "", n
    rows = rows.where(F.col(column).isNotNull())
    while True:
        own = rows.where(F.col(column).startswith(start)) if start else rows
        counts = own.groupBy(F.substring(column, 1, len(start) + step).alias("begin")).agg(F.count("*").alias("n"))
        run = F.sum("n").over(Window.orderBy("begin").rowsBetween(Window.unboundedPreceding, 0))  # a row for each next `step` characters
        hit = counts.withColumn("run", run).where(F.col("run") >= left).orderBy("run").limit(1).collect()
        if not hit:
            return None
        begin, found = hit[0]["begin"], hit[0]["n"]
        left -= hit[0]["run"] - found
        if len(begin) < len(start) + step:
            return begin
        start = begin
