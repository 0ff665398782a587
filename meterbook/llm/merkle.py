"""Merkle manifest of a table, its leaves placed by bitmap ranks.

Every row is a leaf; the leaves of a group (a language, say) make a tree in the order of their ids, and the groups' roots make the tree over all. A leaf's place
is the number of smaller ids in its group. It comes from a bitmap of the group's ids, not from a sort: ids are set in words of 64 bits, first in each
task and then merged by OR; the words that are not zero make pages of up to 64, with the number of ids before each of them; and the pages have a directory
of the ids before each page, summed level by level, so that no window is longer than 2^FANOUT rows, however sparse the ids are. A row meets its page by a hash
key, and its rank is page, word and population count of the lower bits.

Levels are reduced by keyed slot arrays: a task puts 2^SLOTS nodes into an array by the low bits of their places and reduces SLOTS levels at once. Each round takes
what the last one leaves, so 10^12 leaves need four rounds, and no group is larger than an array. On the way every row gets its siblings, so it can be proved alone.

Ids are whole numbers; others raise an error. Null ids are leaves too and come first. Rows of one group that share an id stand in the order of their digests; equal digests
are equal rows, and every one of them is a leaf. Null groups come before all others, the empty name next. Null values are hashed as `-`, empty ones as `0:`. An empty table gives no rows. Of the
table's columns only the named ones are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from .shared import stored

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
WORD, PAGE = 6, 12  # bits of an id within a word and within a page
FANOUT = 14
SLOTS = 10
COPIES = 1 << 16  # of one row that are dealt out together


def leaf(values: Sequence[Column]) -> Column:
    """Digest of a row: every value with its length in bytes, or a dash for null."""
    parts = [F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string"))) for v in values]
    return F.sha2(F.concat(*parts), 256)


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _upto(group: list[str], order: str):
    """Window over the rows of a group before the own one."""
    return Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _before(level: DataFrame, bits: int) -> DataFrame:
    """(tree, at, n) with `before`, the sum of n over smaller `at` of the tree; at has so many bits and a sign."""
    none = F.lit(0).cast("long")
    if bits <= FANOUT:
        return level.withColumn("before", F.coalesce(F.sum("n").over(_upto(["tree"], "at")), none))
    here = level.withColumn("up", F.shiftright("at", FANOUT))
    inside = here.withColumn("inside", F.coalesce(F.sum("n").over(_upto(["tree", "up"], "at")), none))
    above = _before(here.groupBy("tree", F.col("up").alias("at")).agg(F.sum("n").alias("n")), bits - FANOUT)
    above = above.select("tree", F.col("at").alias("up"), F.col("before").alias("outside"))
    return inside.join(above, ["tree", "up"]).select("tree", "at", "n", (F.col("inside") + F.col("outside")).alias("before"))


def bitmap_words(rows: DataFrame) -> DataFrame:
    """(tree, word, bits, n): the ids of each tree as words of 64 bits, and how many rows set them; merged from what every task has."""
    bit = F.expr(f"shiftleft(1L, int(id & {(1 << WORD) - 1}))")
    return rows.filter("id is not null").groupBy("tree", F.shiftright("id", WORD).alias("word")).agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n"))


def rank_index(words: DataFrame, nulls: DataFrame) -> DataFrame:
    """(tree, page, entries, before): words with rows and the rows before them, within the page and up to it. `nulls`: (tree, nulls), rows without an id.

    `more` lists the bits of a word that several rows share, with how many more than one.
    """
    entry = F.struct("word", "bits", "n", "more")
    pages = words.groupBy("tree", F.shiftright("word", PAGE - WORD).alias("page")).agg(F.array_sort(F.collect_list(entry)).alias("list"), F.sum("n").alias("n"))
    pages = stored(pages)
    start = F.lit(0).cast("long")
    counted = F.transform("list", lambda e, i: F.struct(
        e["word"].alias("word"), e["bits"].alias("bits"), e["more"].alias("more"),
        F.aggregate(F.slice("list", 1, i), start, lambda a, x: a + x["n"]).alias("before")))
    directory = _before(pages.select("tree", F.col("page").alias("at"), "n"), 64 - PAGE)
    placed = pages.join(directory.select("tree", F.col("at").alias("page"), "before"), ["tree", "page"]).join(nulls, "tree")
    return placed.select("tree", "page", counted.alias("entries"), (F.col("before") + F.col("nulls")).alias("before"))


def _rank(entry: Column, before: Column, id: Column) -> tuple[Column, Column]:
    """Rows before the first row with the id, and whether several rows have it."""
    bit = id.bitwiseAND(F.lit((1 << WORD) - 1)).cast("int")
    lower = entry["bits"].bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit)))
    more = F.aggregate(F.filter(entry["more"], lambda x: x["bit"] < bit), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    return before + entry["before"] + F.bit_count(lower) + more, F.exists(entry["more"], lambda x: x["bit"] == bit)


def _ordinals(rows: DataFrame, group: list[str], order: str, weight: str) -> DataFrame:
    """rows with `ordinal`, the sum of the weights before the row in its group, for groups of any size: sums within ranges of rows, and of the ranges before."""
    placed = stored(rows.repartitionByRange(*group, order).withColumn("chunk", F.spark_partition_id()))
    none = F.lit(0).cast("long")
    ranges = placed.groupBy(*group, "chunk").agg(F.sum(weight).alias("sum"))
    ranges = ranges.select(*group, "chunk", F.coalesce(F.sum("sum").over(_upto(group, "chunk")), none).alias("earlier"))
    inside = placed.withColumn("inside", F.coalesce(F.sum(weight).over(_upto([*group, "chunk"], order)), none))
    return inside.join(ranges, [*group, "chunk"]).withColumn("ordinal", F.col("earlier") + F.col("inside")).drop("earlier", "inside", "chunk")


def _copies_apart(tied: DataFrame) -> DataFrame:
    """(tree, at, id, leaf, start) with places of their own for rows that share the first place `at`: by digest, equal rows one after the other."""
    distinct = tied.groupBy("tree", "at", "id", "leaf", "start").agg(F.count(F.lit(1)).alias("n"))
    placed = _ordinals(distinct, ["tree", "at"], "leaf", "n")
    blocks = placed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))))
    dealt = blocks.repartition("tree", "at", "leaf", "block")
    last = F.least(F.col("n"), (F.col("block") + 1) * COPIES) - 1
    each = dealt.withColumn("copy", F.explode(F.sequence(F.col("block") * COPIES, last)))
    return each.select("tree", (F.col("at") + F.col("ordinal") + F.col("copy")).alias("at"), "id", "leaf", "start")


def coordinates(rows: DataFrame) -> DataFrame:
    """rows (tree, id, leaf, start) with `at`, the place of the row in its tree."""
    words = stored(bitmap_words(rows))
    nulls = stored(rows.groupBy("tree").agg(F.count_if(F.col("id").isNull()).alias("nulls")))
    shared = words.filter("n > bit_count(bits)").select("tree", "word")
    of_word = F.shiftright("id", WORD)
    if shared.isEmpty():
        words = words.withColumn("more", F.array().cast("array<struct<bit: int, n: bigint>>"))
    else:
        again = rows.withColumn("word", of_word).join(shared, ["tree", "word"], "left_semi").groupBy("tree", "word", "id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        bit = F.col("id").bitwiseAND(F.lit((1 << WORD) - 1)).cast("int").alias("bit")
        more = again.groupBy("tree", "word").agg(F.collect_list(F.struct(bit, (F.col("n") - 1).alias("n"))).alias("more"))
        words = words.join(more, ["tree", "word"], "left").withColumn("more", F.coalesce("more", F.array()))
    index = rank_index(words, nulls)
    met = rows.filter("id is not null").withColumn("page", F.shiftright("id", PAGE)).join(index, ["tree", "page"])
    place, several = _rank(F.filter("entries", lambda e: e["word"] == of_word)[0], F.col("before"), F.col("id"))
    ranked = met.select("tree", place.alias("at"), "id", "leaf", "start", several.alias("several"))
    first = rows.filter("id is null").select("tree", F.lit(0).cast("long").alias("at"), "id", "leaf", "start", F.lit(True).alias("several"))
    if shared.isEmpty() and nulls.filter("nulls > 0").isEmpty():
        return ranked.drop("several")
    ranked = stored(ranked.unionByName(first))
    return ranked.filter("not several").drop("several").unionByName(_copies_apart(ranked.filter("several").drop("several")))


def _round(rows: DataFrame) -> DataFrame:
    """rows (tree, at, node, ...) with `path`, their siblings on the next SLOTS levels (null where there is none), and `top`, the node that these levels lead to."""
    def reduce(table: pa.Table) -> pa.Table:
        at = table.column("at").to_numpy()
        slot, block = at & ((1 << SLOTS) - 1), at[0] >> SLOTS
        level: list = [None] * len(at)
        for s, node in zip(slot.tolist(), table.column("node").to_pylist(), strict=True):
            level[s] = node
        # a tree's only array ends at its last node; one of several arrays is reduced by all its levels
        height = SLOTS if block else (len(level) - 1).bit_length()
        pool, picked = [], []
        for j in range(height):
            other = (slot >> j) ^ 1
            picked.append(np.where(other < len(level), other + len(pool), -1))
            pool += level
            level = [hashlib.sha256("".join(level[i:i + 2]).encode()).hexdigest() for i in range(0, len(level), 2)]
        flat = np.stack(picked, axis=1).ravel() if height else np.zeros(0, np.int64)
        siblings = pa.array(pool, pa.string()).take(pa.array(flat, pa.int64(), mask=flat < 0))
        path = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * height, pa.int32()), siblings)
        return table.append_column("path", path).append_column("top", pa.array(level * len(at), pa.string())).drop_columns(["block"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.withColumn("block", F.shiftright("at", SLOTS)).groupBy("tree", "block").applyInArrow(reduce, f"{schema}, path array<string>, top string")


def reduce_levels(rows: DataFrame, largest: int) -> DataFrame:
    """rows (tree, at, node, ...) with `path`, all their siblings up to the root of the tree, and `top`, that root. largest: nodes of the largest tree."""
    rounds = [stored(_round(rows))]
    while (largest := (largest + (1 << SLOTS) - 1) >> SLOTS) > 1:
        left = rounds[-1].filter(F.col("at").bitwiseAND(F.lit((1 << SLOTS) - 1)) == 0)
        rounds.append(stored(_round(left.select("tree", F.shiftright("at", SLOTS).alias("at"), F.col("top").alias("node")))))
    above = rounds.pop()
    while rounds:
        below = rounds.pop().drop("top").withColumn("block", F.shiftright("at", SLOTS))
        above = above.select("tree", F.col("at").alias("block"), F.col("path").alias("more"), "top")
        above = below.join(above, ["tree", "block"]).withColumn("path", F.concat("path", "more")).drop("block", "more")
    return above


def prove(docs: DataFrame, id: str = "doc_id", group: str = "lang", columns: Sequence[str] = COLUMNS, other: Column | None = None) -> DataFrame:
    """(id, group, leaf, at, path, subroot, group_at, group_path, root): one row per row of docs, with its way up to the root.

    path and group_path are the siblings, from the leaf up, null on a level where the node is alone. `other` may be a digest of something else than the row;
    it is carried along as `start`, so that it can be followed up the same way.
    """
    if not isinstance(docs.schema[id].dataType, IntegralType):
        raise TypeError(f"{id}: a bitmap holds whole numbers, not {docs.schema[id].dataType.simpleString()}")
    own = leaf([F.col(c) for c in columns])
    # a name for every group that sorts as null, empty, others
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = stored(docs.select(tree.alias("tree"), F.col(id).cast("long").alias("id"), own.alias("leaf"), (own if other is None else other).alias("start")))
    sizes = stored(rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n")))
    trees, largest = sizes.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    reduced = stored(reduce_levels(coordinates(rows).withColumn("node", F.col("leaf")), largest).drop("node"))
    subroots = reduced.filter("at = 0").select(F.lit("").alias("all"), F.col("tree").alias("name"), F.col("top").alias("node"), F.lit(1).cast("long").alias("one"))
    listed = _ordinals(subroots, ["all"], "name", "one").select(F.col("all").alias("tree"), F.col("ordinal").alias("at"), "node", "name")
    tops = stored(reduce_levels(listed, trees)).select(
        F.col("name").alias("tree"), F.col("at").alias("group_at"), F.col("path").alias("group_path"), F.col("top").alias("root"))
    name = F.when(F.col("tree") != "", F.substring("tree", 2, (1 << 31) - 1)).cast(docs.schema[group].dataType)
    return reduced.join(tops, "tree").select(
        F.col("id").alias(id), name.alias(group), "leaf", "start", "at", "path", F.col("top").alias("subroot"), "group_at", "group_path", "root")


def fold(start: Column, at: Column, path: Column) -> Column:
    """The root that a digest leads to from a place, along its siblings."""
    steps = F.transform(path, lambda sibling, j: F.struct(
        sibling.alias("sibling"), (F.call_function("shiftright", at, j).bitwiseAND(F.lit(1).cast("long")) == 1).alias("right")))
    return F.aggregate(steps, start, lambda node, s: F.when(s["sibling"].isNull(), digest(node)).when(
        s["right"], digest(s["sibling"], node)).otherwise(digest(node, s["sibling"])))
