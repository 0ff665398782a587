"""Running and whole-group sums over ordered groups of any size.

A window function hands a whole group to one task, and one customer-month may hold a large part of all rows. So the rows
of groups that are larger than a chunk's share of all rows are placed by range of group and order, and stored with the
number of their range, the chunk; all other groups are whole, in chunk 0, and only dealt for the windows. Windows run
per group and chunk. A chunk holds a piece of a large group or several of them; only its first and its last group can go
on in another chunk. The rows of those few groups are stored apart, once. Their sums per chunk form a small table, whose
running sums are added to the rows. So all rows pass the windows once, and what is carried is worked out beside them
from the rows that lie in cut groups. Groups of every size take this one path, and the result does not depend on where
the borders lie.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import add_skipping_null, same
from ..functions.storage import stored

CHUNK = "_chunk"

#: Rows that a task sorts in memory: a few hundred megabytes of rule rows.
CHUNK_ROWS = 200_000


def _same_keys(keys: list[str]) -> Column:
    return reduce(Column.__and__, [same(F.col(k), F.col(f"_r_{k}")) for k in keys])


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys where NULL equals NULL, keeping the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    return left.join(renamed, _same_keys(keys), how).drop(*[f"_r_{k}" for k in keys])


def ascending(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


class Sums(NamedTuple):
    """Running sums in one order, within the rows that agree on some keys."""

    within: list[str]
    order: list[str]
    values: dict[str, Column]


class Groups:
    """Rows placed in chunks, and how to run sums over their groups."""

    def __init__(self, whole: DataFrame, placed: DataFrame, keys: list[str], chunks: int):
        """Rows of whole groups, and stored ones of groups that may be cut."""
        self.keys = keys
        # one shuffle by group and chunk serves the windows of groups and of parts of groups; with a number of tasks of
        # its own, as Spark would join tasks by compressed size until their rows no longer fit in memory
        self.rows = whole.unionByName(placed).repartition(chunks, *keys, CHUNK)
        # compared as the rows are placed: unknown keys last
        group = F.struct(*[c for k in keys for c in (F.col(k).isNull().alias(f"no_{k}"), F.col(k))])
        ends = placed.groupBy(CHUNK).agg(F.min(group).alias("first"), F.max(group).alias("last"))
        seen = ends.select(CHUNK, F.explode(F.array_distinct(F.array("first", "last"))).alias("group"))
        # two rows per chunk at most
        crossing = seen.groupBy("group").count().filter("count > 1").select(*[f"group.{k}" for k in keys])
        #: the rows of groups that lie in several chunks, and the same dealt for windows
        self.cut_rows = stored(join_same(placed, crossing, keys, "left_semi"))
        self.cut = self.cut_rows.repartition(chunks, *keys, CHUNK)

    def _window(self, keys: list[str], order: list[str]):
        return Window.partitionBy(*keys, CHUNK).orderBy(*ascending(order))

    def carried(self, totals: DataFrame, within: list[str], names: list[str], whole: dict[str, Column] | None = None) -> DataFrame:
        """What the earlier chunks of each cut group add up to, from `totals`, which has the named sums of each chunk or of parts of it.

        `whole` adds aggregates of all the group's rows of `totals`.
        """
        whole = whole or {}
        chunks = totals.groupBy(*within, CHUNK).agg(
            *[F.sum(name).alias(f"_c_{name}") for name in names], *[value.alias(name) for name, value in whole.items()])
        # one row per chunk and key: a short window
        group = Window.partitionBy(*within).orderBy(CHUNK)
        earlier = group.rowsBetween(Window.unboundedPreceding, -1)
        every = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        # stored, so that its measured size decides how it is joined
        return stored(chunks.select(
            *within, CHUNK, *[F.sum(f"_c_{name}").over(earlier).alias(f"_c_{name}") for name in names],
            *[value.over(every).alias(f"_t_{name}") for name, value in whole.items()]))

    def running(self, df: DataFrame, sums: Sums, carried: DataFrame, whole: dict[str, Column] | None = None) -> DataFrame:
        """Add for each sum `name` (up to and with the row) and `name_before` (up to the row, NULL on the first).

        `carried` has the sums of the earlier chunks of the cut groups. `whole` adds aggregates of the whole group in
        the same pass; `carried` has them for the cut groups.
        """
        window, whole = self._window(sums.within, sums.order), whole or {}
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = window.rowsBetween(Window.unboundedPreceding, -1)
        every = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        local = df.withColumns({
            **{name: F.sum(value).over(upto) for name, value in sums.values.items()},
            **{f"{name}_before": F.sum(value).over(before) for name, value in sums.values.items()},
            **{name: value.over(every) for name, value in whole.items()},
        })
        joined = join_same(local, carried.withColumn("_cut", F.lit(True)), [*sums.within, CHUNK], "left")
        return joined.withColumns({
            **{end: add_skipping_null(F.col(f"_c_{name}"), F.col(end)).cast(local.schema[end].dataType)
               for name in sums.values for end in (name, f"{name}_before")},
            **{name: F.when(F.col("_cut"), F.col(f"_t_{name}")).otherwise(F.col(name)) for name in whole},
        }).drop("_cut", *[f"_c_{name}" for name in sums.values], *[f"_t_{name}" for name in whole])

    def total(self, df: DataFrame, within: list[str], order: list[str], name: str, value: Column, totals: DataFrame) -> DataFrame:
        """Add an aggregate of the whole group to each of its rows; `totals` has it for the cut groups, under the same name.

        `order` does not change it; in the order of the running sums Spark computes both in one pass.
        """
        whole = self._window(within, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        local = df.withColumn(name, value.over(whole))
        known = totals.select(*within, F.lit(True).alias("_cut"), F.col(name).alias("_t"))
        joined = join_same(local, known, within, "left")
        return joined.withColumn(name, F.when(F.col("_cut"), F.col("_t")).otherwise(F.col(name))).drop("_cut", "_t")

    def among_peers(self, df: DataFrame, within: list[str], key: list[str], values: dict[str, Column]) -> DataFrame:
        """Add aggregates over the rows that share the row's ordering key (they always lie in one chunk)."""
        peers = self._window(within, key).rangeBetween(Window.currentRow, Window.currentRow)
        return df.withColumns({name: value.over(peers) for name, value in values.items()})


def place(df: DataFrame, keys: list[str], order: list[str], chunks: int | None = None) -> Groups:
    """Place the rows of large groups by range of keys and order, and leave the others whole.

    There are as many chunks as the session has shuffle partitions, or more, so that one has CHUNK_ROWS at most on
    average. A group is large if it has more rows than that average; there are fewer of these than chunks. Rows equal in
    `order` are peers and stay together. The placed rows are stored before use, so that a chunk keeps its rows whatever
    is recomputed; the others need no place and are shuffled once, for the windows.
    """
    sizes = stored(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")))
    rows = sizes.agg(F.sum("_rows")).first()[0] or 0
    chunks = chunks or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // CHUNK_ROWS))
    large = stored(sizes.filter(F.col("_rows") * chunks > rows).select(*keys))
    whole = join_same(df, large, keys, "left_anti").withColumn(CHUNK, F.lit(0))
    ranges = join_same(df, large, keys, "left_semi").repartitionByRange(chunks, *ascending([*keys, *order]))
    return Groups(whole, stored(ranges.withColumn(CHUNK, F.spark_partition_id() + 1)), keys, chunks)
