"""Mixing sources to target weights by Poisson replication.

A source with target weight w gets the repetition rate w * all characters / its characters. Every document takes a uniform number from a hash of seed and id,
inverts the Poisson distribution with its source's rate at that number, and is repeated that many times, perhaps not at all. So a
document's count depends on nothing but itself and its source's rate: tasks can be lost and repeated. Copies are then ordered by a hash over
all of the data: an exchange at equal borders of the hash and a sort.

Weights are a parameter (source to weight); without them a source's weight is its share of characters to the power TEMPERATURE. Rates are what the weights
ask for; a rate over MOST_RATE is the sum of independent draws of equal rates that are not over it. A null source is a source of its own; null texts have no characters, and every document of a source without
characters is kept exactly once. Rows with a null id share one number. Repeated rows are repeated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .shared import fresh, stored

TEMPERATURE = 0.5
MOST_RATE = 16.0  # of one draw
TERMS = 120  # of the distribution: the tail beyond is below 1e-40 at the largest rate
SEED = 17


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of a hash."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, source: str = "source", text: str = "text", weights: dict[str, float] | None = None) -> DataFrame:
    """(of, chars, rate, draws, below): below[k] is the chance of k copies or fewer in one of the draws."""
    sums = docs.groupBy(F.col(source).alias("of")).agg(F.sum(F.length(F.coalesce(F.col(text), F.lit(""))).cast("long")).alias("chars"))
    sums = stored(sums)
    if weights is None:
        weighed = sums.withColumn("weight", F.pow(F.col("chars").cast("double"), F.lit(TEMPERATURE)))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "given string, weight double")
        weighed = sums.join(given, F.col("of").eqNullSafe(F.col("given")), "left").drop("given").na.fill(0.0, ["weight"])
    total = weighed.agg(F.sum("chars").alias("chars"), F.sum("weight").alias("weight")).first()
    rate = F.when(F.col("chars") == 0, 1.0).otherwise(
        F.col("weight") / F.lit(total["weight"] or 1.0) * F.lit(float(total["chars"] or 0)) / F.col("chars"))
    weighed = weighed.withColumn("rate", rate).withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / MOST_RATE)).cast("int"))
    part = F.col("rate") / F.col("draws")
    start = F.exp(-part)
    step = lambda a, k: F.struct(
        (a["p"] * part / k).alias("p"), (a["c"] + a["p"] * part / k).alias("c"),
        F.array_append(a["all"], a["c"] + a["p"] * part / k).alias("all"))
    below = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), F.struct(start.alias("p"), start.alias("c"), F.array(start).alias("all")), step)
    return stored(weighed.select("of", "chars", "rate", "draws", below["all"].alias("below")))


def replicate(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", weights: dict[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """docs with `copy` (from 1), `rate` and `order_key`, each row as often as its count says, in no order. docs must not have columns of these names."""
    own = fresh(docs, "_mix_")
    by = rates(docs, source, text, weights)
    by = by.withColumnsRenamed({c: own + c for c in by.columns})
    counted = docs.join(by, docs[source].eqNullSafe(by[f"{own}of"]))
    draws, below = F.col(f"{own}draws"), F.col(f"{own}below")
    drawn = lambda u: F.size(F.filter(below, lambda c: c <= u))
    more = F.when(draws > 1, F.aggregate(F.sequence(F.lit(1), draws - 1), F.lit(0), lambda a, k: a + drawn(uniform(seed, docs[id], k))))
    count = F.when(F.col(f"{own}chars") == 0, 1).otherwise(drawn(uniform(seed, docs[id])) + F.coalesce(more, F.lit(0)))
    counted = counted.withColumn(f"{own}count", count).filter(F.col(f"{own}count") > 0)
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(f"{own}count"))))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), F.coalesce(docs[id].cast("string"), F.lit("null")), F.col("copy").cast("string")))
    return copies.withColumnRenamed(f"{own}rate", "rate").withColumn("order_key", key).drop(*[own + c for c in ("of", "chars", "draws", "below", "count")])


def in_order(copies: DataFrame, key: str = "order_key") -> DataFrame:
    """Rows in the global order of the key, a uniform hash: dealt at equal borders of its first 32 bits, so nothing is sampled first."""
    tasks = int(copies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return copies.repartitionById(tasks, F.shiftright(first * F.lit(tasks), 32).cast("int")).sortWithinPartitions(key)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixture in its global order, with the columns of docs only, whatever their names."""
    own, added = fresh(docs, "_mix_"), ("copy", "rate", "order_key")
    hidden = {c: f"{own}own_{c}" for c in docs.columns if c.lower() in added}
    out = replicate(docs.withColumnsRenamed(hidden), **options)
    out = in_order(out).drop(*added)
    return out.withColumnsRenamed({new: old for old, new in hidden.items()}).select(*docs.columns)
