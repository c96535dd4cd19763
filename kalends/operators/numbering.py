"""Row numbers over a whole table, without pulling the table through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kalends.functions.scalars import bucket_of
from kalends.operators.joins import BROADCAST_ROWS, NARROW
from kalends.storage import materialise

# monotonically_increasing_id() keeps the row's position within its partition in the lower 33 bits.
_POSITION_BITS = 33


def global_row_number(df: DataFrame, order_by: list[str], name: str) -> DataFrame:
    """Number the rows 1..n in the given order.

    The rows are range-partitioned and sorted on all of ``order_by``, so a value of the
    leading column that holds a large share of the rows is still split by the columns
    after it; give enough columns to make the order total. Each row then keeps its
    partition and its position there, and a prefix sum over the partition sizes (one row
    per partition) turns that into the global number. The sorted rows are written once, so
    that sizes and positions are read off the same split.
    """
    split = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = materialise(split, "numbered").withColumns({
        "_part": F.shiftright("_at", _POSITION_BITS),
        "_position": F.col("_at").bitwiseAND((1 << _POSITION_BITS) - 1),
    })
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    # One row per range partition: bounded by the number of shuffle partitions.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_position") + 1)
        .drop("_at", "_part", "_position", "_before")
    )


def assign_round_robin(
    fact: DataFrame, fact_order: list[str], members: DataFrame, member_key: str, name: str
) -> DataFrame:
    """Deal the rows of ``fact``, in order, to the members in order of their key.

    Row 1 goes to the first member, row 2 to the second, and after the last member the
    first is next. The member's key lands in column ``name``. Slots receive equally many
    rows, so the join on the slot cannot be skewed. Members are numbered the way the rows are, from the counts of
    their partitions, however many there are.
    """
    slots = global_row_number(members.select(F.col(member_key).alias(name)), [name], "_slot")
    count = slots.count()
    numbered = global_row_number(fact, fact_order, "_number")
    return (
        numbered.withColumn("_slot", bucket_of("_number", count))
        .join(F.broadcast(slots) if count <= BROADCAST_ROWS * NARROW else slots, "_slot")
        .drop("_slot", "_number")
    )
