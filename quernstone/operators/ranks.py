"""Ranks and running sums whose groups may be of any size.

A window over a group needs all its rows in one task. Here rows are dealt by ranges
of group and order, ties apart, so that all tasks get about as many rows. Each
computes its own ranks; of each group in each range one small row says how many
rows, different values and sums it holds and which values it begins and ends with.
Prefix sums over these rows, as many as there are ranges and groups, give what each
range has to add, and where a value that goes over a border begins and ends.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.operators.settled import settled

NAMES = ("row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile")


def _plus(a: Column, b: Column) -> Column:
    """The sum of two sums, either of which may be of nothing."""
    return F.coalesce(a + b, a, b)


def same_keys(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right)], F.lit(True))


def dealt(frame: DataFrame, by: Sequence[str], order: Sequence[tuple[str, bool]], parts: int | None = None) -> DataFrame:
    """The rows in ranges of group and order, with `_range` and `_tie`, a number that tells rows apart; equal rows are dealt over several ranges where one can't hold them."""
    parts = parts or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{b}`").asc_nulls_first() for b in by] + [F.col(f"`{c}`").asc_nulls_first() if up else F.col(f"`{c}`").desc_nulls_last() for c, up in order]
    return frame.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys, F.col("_tie").asc()).withColumn("_range", F.spark_partition_id())


def ranked(frame: DataFrame, by: Sequence[str], order: Sequence[tuple[str, bool]], sums: dict[str, str] | None = None, tiles: int = 4, parts: int | None = None) -> DataFrame:
    """The rows with row_number, rank, dense_rank, percent_rank, cume_dist and ntile over groups `by` in `order`, a list of columns and whether they ascend.

    sums: new names of running sums and the columns they are of. `name` is the sum up to
    the row, `name`_peers up to the last row of its value. The sum of no value is null.

    Nulls are a group, and come first ascending and last descending, as in Spark's
    windows. Rows of equal order are numbered, and summed up to, in no stated order;
    all else doesn't depend on it. by=[] ranks all rows.
    """
    sums = sums or {}
    groups, columns = [f"_by{i}" for i in range(len(by))], frame.columns
    plain = frame.select(*[F.col(f"`{c}`") for c in columns], *[F.col(f"`{b}`").alias(g) for b, g in zip(by, groups)], F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, (c, _) in enumerate(order)]).alias("_value"))
    inside = Window.partitionBy("_range", *groups)
    ways = [F.col(f"_value.o{i}").asc_nulls_first() if up else F.col(f"_value.o{i}").desc_nulls_last() for i, (_, up) in enumerate(order)]
    rows = inside.orderBy(*ways, "_tie").rowsBetween(Window.unboundedPreceding, 0)
    values = inside.orderBy(*ways)
    peers = values.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local = dealt(plain, by, order, parts).withColumns({"_row": F.row_number().over(inside.orderBy(*ways, "_tie")).cast("long")} | {f"_s_{s}": F.sum(F.col(f"`{c}`")).over(rows) for s, c in sums.items()})
    local = local.withColumns({"_rank": F.rank().over(values).cast("long"), "_dense": F.dense_rank().over(values).cast("long"), "_upto": F.count(F.lit(1)).over(peers)} | {f"_p_{s}": F.sum(F.col(f"`{c}`")).over(peers) for s, c in sums.items()})
    local = settled(local.drop("_tie"), "ranges")
    # one row for each group in each range
    held = [F.max("_row").alias("n"), F.max("_dense").alias("dense"), F.max("_rank").alias("last_rank"), F.min("_upto").alias("first_n"), F.min_by("_value", "_row").alias("first"), F.max_by("_value", "_row").alias("last")]
    held += [x for s in sums for x in (F.max_by(f"_s_{s}", "_row").alias(f"all_{s}"), F.min_by(f"_p_{s}", "_row").alias(f"first_{s}"))]
    short = local.groupBy("_range", *groups).agg(*held)
    across = Window.partitionBy(*groups).orderBy("_range")
    earlier, later = across.rowsBetween(Window.unboundedPreceding, -1), across.rowsBetween(1, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    short = short.withColumns(
        {
            "before": F.coalesce(F.sum("n").over(earlier), zero),
            "total": F.sum("n").over(Window.partitionBy(*groups)),
            "goes_on": F.coalesce(F.lag("last").over(across).eqNullSafe(F.col("first")) & (F.row_number().over(across) > 1), F.lit(False)),
            "goes_over": F.coalesce(F.lead("first").over(across).eqNullSafe(F.col("last")) & F.lead("n").over(across).isNotNull(), F.lit(False)),
            "one": F.col("first").eqNullSafe(F.col("last")),
        }
        | {f"before_{s}": F.sum(f"all_{s}").over(earlier) for s in sums}
    )
    # where the last value begins and the first one ends, if that is in this range
    begins = F.when(~(F.col("one") & F.col("goes_on")), F.col("before") + F.col("last_rank"))
    ends_here = ~(F.col("one") & F.col("goes_over"))
    fresh = F.col("dense") - F.col("goes_on").cast("long")
    short = short.withColumns({"begins": begins, "fresh": fresh, "first_end": F.when(ends_here, F.col("before") + F.col("first_n"))} | {f"end_{s}": F.when(ends_here, F.struct(_plus(F.col(f"before_{s}"), F.col(f"first_{s}")).alias("s"))) for s in sums})
    carried = {
        "first_rank": F.when(F.col("goes_on"), F.last("begins", ignorenulls=True).over(earlier)).otherwise(F.col("before") + 1),
        "before_dense": F.coalesce(F.sum("fresh").over(earlier), zero) - F.col("goes_on").cast("long"),
        "last_end": F.when(F.col("goes_over"), F.first("first_end", ignorenulls=True).over(later)).otherwise(F.col("before") + F.col("n")),
    } | {f"last_{s}": F.when(F.col("goes_over"), F.first(f"end_{s}", ignorenulls=True).over(later)["s"]).otherwise(_plus(F.col(f"before_{s}"), F.col(f"all_{s}"))) for s in sums}
    short = short.withColumns(carried).select("_range", *groups, "n", "before", "total", *carried, *[f"before_{s}" for s in sums])
    short = settled(short, "borders").withColumnsRenamed({"_range": "_at"} | {g: f"of{g}" for g in groups})
    out = local.join(short, (F.col("_range") == F.col("_at")) & same_keys([F.col(g) for g in groups], [F.col(f"of{g}") for g in groups]))
    row = F.col("before") + F.col("_row")
    rank = F.when(F.col("_dense") == 1, F.col("first_rank")).otherwise(F.col("before") + F.col("_rank"))
    at_end = F.col("_upto") == F.col("n")
    upto = F.when(at_end, F.col("last_end")).otherwise(F.col("before") + F.col("_upto"))
    size, more = F.floor(F.col("total") / tiles), F.col("total") % tiles
    tile = F.when(row <= more * (size + 1), F.floor((row - 1) / (size + 1)) + 1).otherwise(more + F.floor((row - 1 - more * (size + 1)) / F.greatest(size, F.lit(1))) + 1)
    found = (row, rank, F.col("before_dense") + F.col("_dense"), F.when(F.col("total") > 1, (rank - 1) / (F.col("total") - 1)).otherwise(0.0), upto / F.col("total"), tile)
    running = [x for s in sums for x in (_plus(F.col(f"before_{s}"), F.col(f"_s_{s}")).alias(s), F.when(at_end, F.col(f"last_{s}")).otherwise(_plus(F.col(f"before_{s}"), F.col(f"_p_{s}"))).alias(f"{s}_peers"))]
    return out.select(*[F.col(f"`{c}`") for c in columns], *[c.alias(n) for c, n in zip(found, NAMES)], *running)
