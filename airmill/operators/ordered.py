"""Order-dependent work without a single big task.

Row numbers and running totals over a whole table, or over one hot group, cannot be a plain window: the window would put
all of it in one task. Here the rows are range-partitioned by the full ordering key (Spark samples the key, so a hot
group is simply spread over many ranges), the position inside each range is stored with the rows, and a table with one
row per range supplies the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airmill.session import stored

# Rows per window task after numbering.
BLOCK_ROWS = 250_000
# monotonically_increasing_id() keeps the position inside the partition in its low 33 bits.
_POSITION_BITS = (1 << 33) - 1


def ordered_chunks(df: DataFrame, keys: Sequence[str], chunks: int | None = None) -> DataFrame:
    """Range-partition by ``keys`` and add ``chunk`` (range number) and ``pos`` (0-based position in the range).

    Range bounds come from sampling and would differ between two evaluations of the same plan. The result is a stored
    table, so all consumers see the same ranges.
    """
    n = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS))
    return stored(ranged.select("*", F.spark_partition_id().alias("chunk"), position.alias("pos")))


def number_rows(df: DataFrame, keys: Sequence[str], chunks: int | None = None) -> DataFrame:
    """Add ``rn``, the exact 0-based row number in ``keys`` order, without a global sort in one task.

    The offset table has one row per range (at most ``spark.sql.shuffle.partitions``), so it is safe to broadcast.
    """
    placed = ordered_chunks(df, keys, chunks)
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("chunk").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("chunk", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.join(F.broadcast(offsets), "chunk")
    return numbered.withColumn("rn", F.col("pos") + F.col("_offset")).drop("chunk", "pos", "_offset")


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    totals: Sequence[str],
    groups: Sequence[str] = (),
    chunks: int | None = None,
) -> DataFrame:
    """Add ``<c>_run``, the inclusive running sum of every column in ``totals`` per ``groups`` in ``order``.

    ``order`` must be unique inside a group and ``groups`` must not be null.
    """
    groups = list(groups)
    placed = ordered_chunks(df, [*groups, *order], chunks)
    sizes = placed.groupBy(*groups, "chunk").agg(*[F.sum(c).alias(f"_{c}") for c in totals])
    before = Window.partitionBy(*groups).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    offsets = sizes.select(
        *groups, "chunk", *[F.coalesce(F.sum(f"_{c}").over(before), zero).alias(f"_{c}_before") for c in totals]
    )
    inside = Window.partitionBy(*groups, "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.join(offsets, [*groups, "chunk"])
    runs = {f"{c}_run": F.sum(c).over(inside) + F.col(f"_{c}_before") for c in totals}
    return joined.withColumns(runs).drop("chunk", "pos", *[f"_{c}_before" for c in totals])


def trailing_rows(
    df: DataFrame,
    keys: Sequence[str],
    features: dict[str, "Column | callable"],
    rows: int,
    groups: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
    chunks: int | None = None,
) -> DataFrame:
    """Window features over the last ``rows`` rows, exact for any group size.

    ``features`` maps a name to a function of the window. Rows are numbered in (groups, keys) order and cut into equal
    blocks; the last ``rows - 1`` rows of a block are copied to the next one so that its first windows are complete,
    and the copies are dropped afterwards. Work per task is ``block_rows`` whatever the groups look like.
    """
    groups = list(groups)
    numbered = number_rows(df, [*groups, *keys], chunks)
    block = F.floor(F.col("rn") / F.lit(block_rows))
    at_end = F.col("rn") % block_rows >= block_rows - (rows - 1)
    homes = F.when(at_end, F.array(block, block + 1)).otherwise(F.array(block))
    spread = numbered.withColumn("_block", F.explode(homes))
    w = Window.partitionBy("_block", *groups).orderBy("rn").rowsBetween(-(rows - 1), 0)
    done = spread.withColumns({name: make(w) for name, make in features.items()})
    return done.where(F.col("_block") == block).drop("_block", "rn")
