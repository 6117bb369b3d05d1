"""Which offsets of a record partition are stored: lost ones, and ones stored twice.

Offsets are told apart in blocks, whose sets are built before the shuffle, and taken apart into
ranges of consecutive ones. Windows see ranges only: first within stretches of many
blocks, whose ranges are joined, then the few that are left of a whole partition. So a
partition that holds a third of all records has one row for each stretch in the last step,
and one for each gap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.functions import names

# Offsets of a block, and blocks of a stretch.
BLOCK = 4096
_PART, _OFFSET = names.RECORD_PARTITION, names.RECORD_OFFSET

LOST, REPEATED = "lost", "repeated"


def _div(column: str, by: int) -> Column:
    """Integer division, exact for offsets of any size."""
    return F.expr(f"`{column}` div {by}L")


def stored_ranges(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Ranges of consecutive offsets: ``record_partition``, ``first_offset``, ``last_offset``.

    Rows without a position are left out.
    """
    placed = rows.where(F.col(_PART).isNotNull() & F.col(_OFFSET).isNotNull())
    held = F.array_sort(F.collect_set(F.col(_OFFSET).cast("bigint")))
    blocks = placed.groupBy(_PART, _div(_OFFSET, block).alias("block")).agg(held.alias("held"))
    return _joined(_joined(_ranges(blocks), _div("first_offset", block * block)), F.lit(0))


def _ranges(blocks: DataFrame) -> DataFrame:
    """One row for each run of consecutive offsets of a block's sorted set."""
    held = F.col("held")
    firsts = F.filter(held, lambda x, i: (i == 0) | (F.get(held, i - 1) != x - 1))
    lasts = F.filter(held, lambda x, i: (i == F.size(held) - 1) | (F.get(held, i + 1) != x + 1))
    zipped = F.arrays_zip(firsts.alias("first_offset"), lasts.alias("last_offset"))
    return blocks.select(_PART, F.inline(zipped).alias("first_offset", "last_offset"))


def _joined(ranges: DataFrame, stretch: Column) -> DataFrame:
    """Ranges of one stretch that follow each other without a gap, as one."""
    ranges = ranges.withColumn("stretch", stretch)
    in_order = Window.partitionBy(_PART, "stretch").orderBy("first_offset")
    apart = F.coalesce(F.col("first_offset") != F.lag("last_offset").over(in_order) + 1, F.lit(True))
    numbered = ranges.withColumn("apart", apart).withColumn("island", F.count_if("apart").over(in_order))
    joined = numbered.groupBy(_PART, "stretch", "island").agg(
        F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset")
    )
    return joined.drop("stretch", "island")


def offset_report(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Ranges of offsets that are lost or repeated: ``record_partition``, ``kind``,
    ``first_offset``, ``last_offset``, ``rows``.

    Lost are those between two stored ones that are not stored themselves, with no rows;
    what lies before a partition's first offset may never have been there. Of repeated ones
    ``rows`` counts those beyond the first of each offset. An empty table gives an empty report.
    """
    ranges = stored_ranges(rows, block)
    in_order = Window.partitionBy(_PART).orderBy("first_offset")
    lost = (
        ranges.withColumn("before", F.lag("last_offset").over(in_order))
        .where("before is not null")
        .select(
            _PART, F.lit(LOST).alias("kind"), (F.col("before") + 1).alias("first_offset"),
            (F.col("first_offset") - 1).alias("last_offset"), F.lit(0).cast("bigint").alias("rows"),
        )
    )
    # copies of one offset collapse before the shuffle
    placed = rows.where(F.col(_PART).isNotNull() & F.col(_OFFSET).isNotNull())
    copies = placed.groupBy(_PART, _OFFSET).agg(F.count("*").alias("copies")).where("copies > 1")
    again = stored_ranges(copies, block).withColumn("stretch", _div("first_offset", block))
    extra = copies.groupBy(_PART, _div(_OFFSET, block).alias("block")).agg(
        F.collect_list(F.struct(F.col(_OFFSET).alias("o"), (F.col("copies") - 1).alias("n"))).alias("each")
    )
    spread = again.withColumn(
        "block", F.explode(F.sequence("stretch", _div("last_offset", block)))
    ).drop("stretch")
    inside = F.filter("each", lambda x: x["o"].between(F.col("first_offset"), F.col("last_offset")))
    counted = F.aggregate(inside, F.lit(0).cast("bigint"), lambda total, x: total + x["n"])
    repeated = (
        spread.join(extra, [_PART, "block"])
        .groupBy(_PART, "first_offset", "last_offset")
        .agg(F.sum(counted).alias("rows"))
        .select(_PART, F.lit(REPEATED).alias("kind"), "first_offset", "last_offset", "rows")
    )
    return lost.unionByName(repeated)


def next_offsets(rows: DataFrame) -> DataFrame:
    """For each record partition, the offset behind the last one stored; one narrow aggregation."""
    return rows.where(F.col(_OFFSET).isNotNull()).groupBy(_PART).agg((F.max(_OFFSET) + 1).alias("next_offset"))
