"""Prices for charged matches: running counts and amounts, tier choice, revenue, and the monthly SaaS minimum."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import pricing
from ..functions.storage import stored
from ..sources.schemas import REVENUE, RULE_ROW
from .matching import NON_USAGE_PRODUCTS, hashed
from .ordered import CHUNK, Groups, Sums, ascending, join_same, place

# The month comes first: rated rows leave the windows in the order in which a table of months is written.
GROUP = ["transaction_month", "sequence_customer_id"]
PRODUCT = [*GROUP, "matched_product_name"]

# Order of a customer-month and of one of its products; rows that agree up to the amount are copies of one match.
KEY_ORDER = ["local_created_at", "mm_id", "matched_product_name", "amount"]
GROUP_ORDER = [*KEY_ORDER, "price_structure_json", "client_id"]
PRODUCT_KEY_ORDER = ["local_created_at", "mm_id", "amount"]
PRODUCT_ORDER = [*PRODUCT_KEY_ORDER, "price_structure_json", "client_id"]

# What a contract line says, alike in all its rows; `pricing` is the first of them in typed form.
TEXTS = ["price_structure_json", "property_filters_json", "properties_to_negate"]

#: Bytes of different texts that are sent to all executors.
BROADCAST_BYTES = 16_000_000

TEXT_KEYS = ["_text_1", "_text_2"]

# What the windows sort by and work out prices from; the other columns pass them in one.
USED = [*GROUP_ORDER, *GROUP, "price_minimum_amount", "consumes_saas", "should_be_charged", "pricing"]

RATED_COLUMNS = [
    *RULE_ROW.fieldNames(), "transaction_count", "global_transaction_order", "cumulative_amount",
    "cumulative_amount_before", "pricing_type", "linear_price_per_unit", "linear_is_percentage", "tier_price",
    "tier_fee", "tier_upper_bound", "tier_is_percentage", "eff_tier_price", "eff_tier_fee", "eff_tier_is_percentage",
    "tier_application_basis", "revenue", "cumulative_revenue", "cumulative_revenue_before",
    "cumulative_revenue_global", "cumulative_revenue_global_before", "cumulative_saas_revenue_global",
    "cumulative_saas_revenue_global_before", "price_minimum_revenue", "saas_revenue", "not_saas_revenue",
    "remaining_minimum", "revenue_type", "first_copy", "first_saas_copy",
]


def charged_usage(rules: DataFrame) -> DataFrame:
    """The charged rule rows of usage products. Discounts named `title||product` pass this test on purpose."""
    usage = rules.filter(~F.upper("matched_product_name").isin(NON_USAGE_PRODUCTS) & F.col("should_be_charged"))
    return usage if "pricing" in usage.columns else usage.withColumn("pricing", pricing("price_structure_json"))


def _nothing() -> Column:
    return F.lit(0).cast(REVENUE)


def _uses_minimum() -> Column:
    return F.col("consumes_saas") & F.col("should_be_charged")


def _counts() -> Sums:
    return Sums(PRODUCT, PRODUCT_ORDER, {"transaction_count": F.lit(1), "cumulative_amount": F.col("amount")})


def _order() -> Sums:
    return Sums(GROUP, GROUP_ORDER, {"global_transaction_order": F.lit(1)})


def _product_revenue() -> Sums:
    return Sums(PRODUCT, PRODUCT_ORDER, {"cumulative_revenue": F.col("revenue")})


def _group_revenue() -> Sums:
    return Sums(GROUP, GROUP_ORDER, {
        "global_transaction_order": F.lit(1),
        "cumulative_revenue_global": F.col("revenue"),
        "cumulative_saas_revenue_global": F.when(F.col("kept"), F.when(_uses_minimum(), F.col("revenue")).otherwise(_nothing())),
    })


class Cut:
    """What customer-months that lie in several chunks carry from chunk to chunk, each worked out once from their rows.

    The rows pass the windows of counts and tiers once here; what revenue needs of them is stored, so the last tiers
    and the sums of revenue are plain aggregates.
    """

    def __init__(self, groups: Groups, texts: DataFrame | None = None):
        self.groups, self._texts = groups, texts

    def whole(self, rows: DataFrame) -> DataFrame:
        """The rows with the columns that passed the windows in one, and with their texts."""
        rows = rows.select("*", "_others.*").drop("_others")
        if self._texts is None:
            return rows
        return rows.drop("price_structure_json").join(F.broadcast(self._texts), TEXT_KEYS, "left").drop(*TEXT_KEYS)

    def _sums(self, rows: DataFrame, *specs: Sums, **more: Column) -> DataFrame:
        """Per product and chunk; sums of customer-months are sums of these."""
        values = {name: value for sums in specs for name, value in sums.values.items()}
        return stored(rows.groupBy(*PRODUCT, CHUNK).agg(
            *[F.sum(value).alias(name) for name, value in values.items()], *[value.alias(name) for name, value in more.items()]))

    @cached_property
    def _counted(self) -> DataFrame:
        return self._sums(self.groups.cut_rows, _counts(), _order())

    @cached_property
    def counts(self) -> DataFrame:
        return self.groups.carried(self._counted, PRODUCT, list(_counts().values))

    @cached_property
    def order(self) -> DataFrame:
        return self.groups.carried(self._counted, GROUP, list(_order().values))

    @cached_property
    def _tiers(self) -> DataFrame:
        chosen = choose_tiers(count_transactions(self.groups.cut, self), self.groups)
        return stored(chosen.select(
            *PRODUCT, CHUNK, "transaction_count", "amount", "price_minimum_amount", "kept", "consumes_saas", "should_be_charged", "pricing_type",
            "linear_price_per_unit", "linear_is_percentage", "tier_price", "tier_fee", "tier_is_percentage"))

    @cached_property
    def latest(self) -> DataFrame:
        return stored(self._tiers.groupBy(*PRODUCT).agg(_last_tier().alias("_latest")))

    @cached_property
    def _revenues(self) -> DataFrame:
        priced = join_same(self._tiers, self.latest, PRODUCT, "left")
        priced = _with_effective_tiers(priced).withColumn("revenue", _revenue())
        return self._sums(priced, _product_revenue(), _group_revenue(), price_minimum_revenue=F.max("price_minimum_amount"))

    @cached_property
    def product_revenue(self) -> DataFrame:
        return self.groups.carried(self._revenues, PRODUCT, list(_product_revenue().values))

    @cached_property
    def group_revenue(self) -> DataFrame:
        highest = {"price_minimum_revenue": F.max("price_minimum_revenue")}
        return self.groups.carried(self._revenues, GROUP, list(_group_revenue().values), highest)


def count_transactions(rows: DataFrame, cut: Cut) -> DataFrame:
    """Running count and amount per customer, month and product."""
    counted = cut.groups.running(rows, _counts(), cut.counts)
    return counted.drop("transaction_count_before").withColumns({
        "cumulative_amount": F.col("cumulative_amount").cast("decimal(28,2)"),
        "cumulative_amount_before": F.col("cumulative_amount_before").cast("decimal(28,2)"),
    })


def _tier_rank() -> Column:
    """The lowest (rank, position) among the row's tiers; (9, 0) when it has none.

    A percentage tier is reached by the running amount, a flat one by the running count. Bounded tiers that fit come
    before open ones, percentages before flat prices; between equals the first in the list wins.
    """
    base = F.when(F.col("pricing_type") == "GRADUATED", F.lit(0)).otherwise(F.lit(4))

    def rank(tier: Column, position: Column) -> Column:
        percent, bound = tier["is_percentage"], tier["upper_bound"]
        return F.struct(
            F.when(percent & (F.col("cumulative_amount") <= bound), base + 1)
            .when(percent & bound.isNull(), base + 2)
            .when(~percent & (F.col("transaction_count") <= bound), base + 3)
            .when(~percent & bound.isNull(), base + 4)
            .otherwise(F.lit(9)).alias("rank"),
            position.alias("position"),
        )

    none = F.struct(F.lit(9).alias("rank"), F.lit(0).alias("position"))
    return F.coalesce(F.array_min(F.transform("pricing.tiers", rank)), none)


def choose_tiers(counted: DataFrame, groups: Groups) -> DataFrame:
    """Choose each tiered row's tier without exploding the tiers.

    Adds `kept`: whether the row has a price. Of the copies of one match only the best ranked stays when its pricing
    is tiered; all linear ones do.
    """
    tiered = F.col("pricing_type").isin("VOLUME", "GRADUATED")
    tier = F.get("pricing.tiers", F.col("_choice.tier.position"))
    linear = F.col("pricing_type") == "LINEAR"
    ranked = counted.withColumn("pricing_type", F.upper("pricing.pricing_type")).withColumn(
        "_choice",
        F.when(tiered, F.struct(_tier_rank().alias("tier"), F.col("transaction_count").alias("n"))),
    ).withColumn("_tier", F.when(tiered, tier)).withColumns({
        "linear_price_per_unit": F.when(linear, F.col("pricing.unit_price")),
        "linear_is_percentage": F.when(linear, F.col("pricing.is_percentage")),
        "tier_price": F.col("_tier.price"),
        "tier_fee": F.col("_tier.fee"),
        "tier_upper_bound": F.col("_tier.upper_bound"),
        "tier_is_percentage": F.col("_tier.is_percentage"),
    }).drop("_tier", "pricing")  # price lists pass no window but the first
    ranked = groups.among_peers(ranked, PRODUCT, PRODUCT_KEY_ORDER, {"_best": F.min("_choice")})
    kept = F.coalesce(linear | (tiered & (F.col("_choice") == F.col("_best"))), F.lit(False))
    return ranked.withColumn("kept", kept).drop("_choice", "_best")


def mark_first_copies(chosen: DataFrame, groups: Groups) -> DataFrame:
    """Mark the first kept copy of a match, and the first that uses the minimum, so that matches can be counted later
    without bringing copies together again."""
    copies = {"first_copy": F.col("kept"), "first_saas_copy": F.col("kept") & _uses_minimum()}
    least = {name: F.min(F.when(counts, F.col("transaction_count"))) for name, counts in copies.items()}
    return groups.among_peers(chosen, PRODUCT, PRODUCT_KEY_ORDER, least).withColumns({
        name: F.coalesce(counts & (F.col(name) == F.col("transaction_count")), F.lit(False)) for name, counts in copies.items()
    })


def _last_tier() -> Column:
    priced = (F.col("pricing_type") == "VOLUME") & F.col("kept")
    return F.max_by(F.struct("tier_price", "tier_fee", "tier_is_percentage"), F.when(priced, F.col("transaction_count")))


def _with_effective_tiers(df: DataFrame) -> DataFrame:
    volume = F.col("pricing_type") == "VOLUME"
    return df.withColumns({
        f"eff_{name}": F.when(volume, F.col(f"_latest.{name}")).otherwise(F.col(name))
        for name in ("tier_price", "tier_fee", "tier_is_percentage")
    }).drop("_latest")


def reprice_volume(selected: DataFrame, cut: Cut) -> DataFrame:
    """VOLUME: the tier reached by the product's last transaction of the month prices all of them."""
    latest = cut.groups.total(selected, PRODUCT, PRODUCT_ORDER, "_latest", _last_tier(), cut.latest)
    with_tiers = _with_effective_tiers(latest)
    percent = F.when(F.col("pricing_type") == "LINEAR", F.col("linear_is_percentage")).otherwise(
        F.col("eff_tier_is_percentage")
    )
    return with_tiers.withColumn("tier_application_basis", F.when(percent, "amount").when(~percent, "count"))


def _revenue() -> Column:
    linear = F.col("pricing_type") == "LINEAR"
    percent_of = F.col("amount") * F.lit("0.01").cast("decimal(3,2)")
    fee = F.coalesce("eff_tier_fee", F.lit(0).cast("decimal(18,6)"))
    priced = (
        F.when(linear & F.col("linear_is_percentage"), (F.col("linear_price_per_unit") * percent_of).cast(REVENUE))
        .when(linear & ~F.col("linear_is_percentage"), F.col("linear_price_per_unit").cast(REVENUE))
        .when(~linear & F.col("eff_tier_is_percentage"), ((F.col("eff_tier_price") * percent_of) + fee).cast(REVENUE))
        .when(~linear & ~F.col("eff_tier_is_percentage"), (F.col("eff_tier_price") + fee).cast(REVENUE))
        .otherwise(F.lit(0).cast(REVENUE))
    )
    return F.when(F.col("kept"), priced)  # NULL: the row takes no part in any revenue sum


def accumulate(priced: DataFrame, cut: Cut) -> DataFrame:
    """Running revenue per product, and per customer in time order over all products, with the customer's highest minimum."""
    by_product = cut.groups.running(priced, _product_revenue(), cut.product_revenue)
    highest = {"price_minimum_revenue": F.max("price_minimum_amount")}
    return cut.groups.running(by_product, _group_revenue(), cut.group_revenue, highest).drop("global_transaction_order_before")


def apply_minimum(accumulated: DataFrame) -> DataFrame:
    """Use up the customer's monthly minimum in time order and split revenue at the point where it is met."""
    nothing = _nothing()
    ordered = accumulated.withColumn(
        # an unknown customer or month has no minimum
        "price_minimum_revenue",
        F.when(F.col(GROUP[0]).isNotNull() & F.col(GROUP[1]).isNotNull(), F.col("price_minimum_revenue")),
    )
    minimum = F.coalesce("price_minimum_revenue", nothing)
    before = F.col("cumulative_saas_revenue_global_before")
    upto = F.col("cumulative_saas_revenue_global")
    left = minimum - F.coalesce(before, nothing)
    revenue, charged, consumes = F.col("revenue"), F.col("should_be_charged"), F.col("consumes_saas")
    split = ordered.withColumns({
        "saas_revenue": F.when(~charged | ~consumes, nothing)
            .when(before >= minimum, nothing).when(upto > minimum, left).otherwise(revenue).cast(REVENUE),
        "not_saas_revenue": F.when(~charged, nothing).when(~consumes, revenue)
            .when(upto > minimum, revenue - F.greatest(left, nothing)).otherwise(nothing).cast(REVENUE),
        "remaining_minimum": F.greatest(minimum - F.coalesce(upto, nothing), nothing).cast(REVENUE),
    })
    inside, outside = F.col("saas_revenue"), F.col("not_saas_revenue")
    return split.withColumn(
        "revenue_type",
        F.when(~charged, "excluded").when(~consumes, "non_consuming")
        .when((inside > 0) & (outside == 0), "saas")
        .when((inside == 0) & (outside > 0), "post_minimum")
        .when((inside > 0) & (outside > 0), "mixed"),
    )


def _tiers(cut: Cut) -> DataFrame:
    groups = cut.groups
    chosen = choose_tiers(count_transactions(groups.rows, cut), groups)
    return reprice_volume(mark_first_copies(chosen, groups), cut)


def _packed(rows: DataFrame) -> DataFrame:
    """The rows with all columns that the windows do not use in one: they are copied as a whole, not one by one."""
    return rows.select(*[c for c in rows.columns if c in USED], F.struct(*[c for c in rows.columns if c not in USED]).alias("_others"))


def _placed(rules: DataFrame, chunks: int | None) -> Cut:
    """The charged rows, placed for the windows; `Cut.whole` gives what passed these its columns back.

    The texts of a contract line are the widest part of its rows. As long as all different ones fit in BROADCAST_BYTES, rows
    are placed, shuffled and sorted with a key of 128 bits in their place, and find them again after the windows. For these
    each price structure is the number of its place among all, in their order, which sorts as the text does. Otherwise texts
    stay in the rows.
    """
    # a match's hash comes from columns that stay, and no shuffle can compress it
    usage = charged_usage(rules).drop("hash_match")
    texts = stored(usage.select(*TEXTS).distinct())
    if (texts.agg(F.sum(sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in TEXTS))).first()[0] or 0) > BROADCAST_BYTES:
        return Cut(place(_packed(usage), GROUP, KEY_ORDER, chunks))
    # the hash passes over NULLs, so it is told where they are
    known = [F.col(c).isNotNull() for c in TEXTS]
    keys = {key: F.xxhash64(F.lit(seed), *TEXTS, *known) for seed, key in enumerate(TEXT_KEYS, 1)}
    groups = place(_packed(usage.withColumns(keys).drop(*TEXTS, "pricing")), GROUP, KEY_ORDER, chunks)
    order = F.dense_rank().over(Window.orderBy(*ascending(["price_structure_json"])))  # of few rows
    told = F.broadcast(stored(texts.withColumns(keys).select(*TEXT_KEYS, order.alias("_order"), pricing("price_structure_json").alias("pricing"))
                              .withColumnRenamed("_order", "price_structure_json")))
    groups.rows, groups.cut = (
        rows.join(told, [F.col(f"_others.{key}") == told[key] for key in TEXT_KEYS], "left").drop(*[told[key] for key in TEXT_KEYS])
        for rows in (groups.rows, groups.cut))
    return Cut(groups, texts.withColumns(keys))


def rate_transactions(rules: DataFrame, chunks: int | None = None) -> DataFrame:
    """Rated usage with the minimum applied, one row per charged match.

    Rows of large customer-months are placed in chunks along month, customer and time; customer-months of any size go
    through the same windows per chunk (see `ordered`). `chunks` defaults to the session's shuffle partitions, or more
    for many rows. `hash_match` is made anew from its columns.
    """
    cut = _placed(rules, chunks)
    priced = accumulate(_tiers(cut).withColumn("revenue", _revenue()), cut)
    # rows without a price count in the order and in the minimum, then leave
    return hashed(cut.whole(apply_minimum(priced).filter("kept")), RATED_COLUMNS)


def running_counts(rules: DataFrame, chunks: int | None = None) -> DataFrame:
    """Only the running counts and amounts, per product and (the order) per customer-month."""
    cut = _placed(rules, chunks)
    counted = cut.groups.running(count_transactions(cut.groups.rows, cut), _order(), cut.order)
    return hashed(cut.whole(counted), [
        *RULE_ROW.fieldNames(), "transaction_count", "global_transaction_order", "cumulative_amount",
        "cumulative_amount_before",
    ])


def tier_selection(rules: DataFrame, chunks: int | None = None) -> DataFrame:
    """The rated rows' tiers before revenue: own tier, effective tier and what its bound applies to."""
    cut = _placed(rules, chunks)
    chosen = cut.whole(_tiers(cut).filter("kept").drop("kept", CHUNK))
    return hashed(chosen, [*RULE_ROW.fieldNames(), *[c for c in chosen.columns if c not in RULE_ROW.fieldNames()]])
