"""The feature set: base features per (member, tier), product and behavioural
features per member, and their join.

Members can be very uneven (guest orders all share the NULL member), so no step
gathers the raw rows of a member: orders and lines are first reduced to one row per
(member, day), (member, outlet), (member, sku) and the like, with partial sums on
the map side, and only those compact rows are grouped by member.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.scalars import (
    day,
    days_before,
    ratio,
    recency_bucket,
    sum_when,
    weekday,
)
from ebbtide.params import TIER, ChurnParams
from ebbtide.plans.labels import recent_orders

FEATURE_COLUMNS = [
    "member_id",
    "days_since_last_order",
    "customer_age_days",
    "total_orders",
    "active_months",
    "avg_orders_per_month",
    "total_gmv",
    "avg_order_value",
    "order_value_std",
    "gmv_last_90_days",
    "gmv_previous_90_days",
    "outlet_diversity",
    "primary_outlet",
    "member_tier_when_transact",
    "product_group_diversity",
    "brand_diversity",
    "sku_diversity",
    "avg_quantity_per_item",
    "avg_discount_rate",
    "top_product_groups",
    "avg_days_between_orders",
    "days_between_orders_std",
    "weekend_avg_spend",
    "weekday_avg_spend",
    "spend_growth_rate",
    "aov_vs_annual_spend_ratio",
    "recency_bucket",
]

# Bits of the marks that drop order lines before they are moved.
MARKS = 1 << 26


def most_frequent(value: Column, count: Column) -> Column:
    """Aggregate over (value, count) rows: the value with the highest count, the
    smallest one on ties; NULL values do not compete."""
    best = F.min(F.when(value.isNotNull(), F.struct((-count).alias("n"), value.alias("v"))))
    return best["v"]


def base_features(order_header: DataFrame, params: ChurnParams) -> DataFrame:
    """Recency, frequency, monetary, trend and channel features per (member, tier).

    The grouping sets give, in one pass, the plain aggregates of each (member, tier)
    and one row per distinct order id and month, from which the second, much smaller
    aggregate counts the distinct values.
    """
    on, paid = F.col("order_date"), F.col("grand_total")
    recent = day(params.as_of, params.trend_days)
    earlier = day(params.as_of, 2 * params.trend_days)
    orders = recent_orders(order_header, params).select(
        "member_id",
        TIER,
        "id",
        F.trunc("order_date", "month").alias("month"),
        "outlet_name",
        "order_date",
        "grand_total",
    )
    key = [F.col("member_id"), F.col(TIER)]
    cells = orders.groupingSets(
        [key, [*key, F.col("id")], [*key, F.col("month")]], "member_id", TIER, "id", "month"
    ).agg(
        (1 - F.grouping("id")).alias("by_id"),
        (1 - F.grouping("month")).alias("by_month"),
        F.max(on).alias("last_date"),
        F.min(on).alias("first_date"),
        F.sum(paid).alias("total_gmv"),
        F.avg(paid).alias("avg_order_value"),
        F.stddev_samp(paid).alias("order_value_std"),
        sum_when(on >= recent, paid).alias("gmv_last_90_days"),
        sum_when((on >= earlier) & (on < recent), paid).alias("gmv_previous_90_days"),
    )
    whole = (F.col("by_id") + F.col("by_month")) == 0

    def of_member(name: str) -> Column:
        return F.max(F.when(whole, F.col(name)))

    def distinct(flag: str, name: str) -> Column:
        return F.count(F.when(F.col(flag) == 1, F.col(name)))

    numbers = cells.groupBy("member_id", TIER).agg(
        of_member("last_date").alias("last_date"),
        of_member("first_date").alias("first_date"),
        distinct("by_id", "id").alias("total_orders"),
        distinct("by_month", "month").alias("active_months"),
        *[
            of_member(name).alias(name)
            for name in (
                "total_gmv",
                "avg_order_value",
                "order_value_std",
                "gmv_last_90_days",
                "gmv_previous_90_days",
            )
        ],
    )
    # A text cannot be held by a hash aggregate, so the main outlet is picked from rows
    # of its own: one per (member, tier, outlet), from a scan of four columns.
    best = Window.partitionBy("member_id", TIER).orderBy(F.desc("orders"), "outlet_name")
    outlets = (
        orders.where(F.col("outlet_name").isNotNull())
        .groupBy("member_id", TIER, "outlet_name")
        .agg(F.count("*").alias("orders"))
        .select(
            F.col("member_id").alias("outlet_member"),
            F.col(TIER).alias("outlet_tier"),
            F.col("outlet_name").alias("primary_outlet"),
            F.row_number().over(best).alias("place"),
            F.count("*").over(Window.partitionBy("member_id", TIER)).alias("outlets"),
        )
        .where(F.col("place") == 1)
    )
    grouped = numbers.join(
        outlets,
        F.col("member_id").eqNullSafe(F.col("outlet_member"))
        & F.col(TIER).eqNullSafe(F.col("outlet_tier")),
        "left",
    ).withColumn("outlet_diversity", F.coalesce("outlets", F.lit(0).cast("long")))
    return grouped.select(
        "member_id",
        days_before(params.as_of, "last_date").alias("days_since_last_order"),
        days_before(params.as_of, "first_date").alias("customer_age_days"),
        "total_orders",
        "active_months",
        F.round(
            ratio(F.col("total_orders").cast("double"), F.col("active_months").cast("double")),
            2,
        ).alias("avg_orders_per_month"),
        "total_gmv",
        "avg_order_value",
        "order_value_std",
        "gmv_last_90_days",
        "gmv_previous_90_days",
        "outlet_diversity",
        "primary_outlet",
        TIER,
    )


def member_lines(
    order_header: DataFrame, order_item: DataFrame, params: ChurnParams
) -> DataFrame:
    """Order lines of the history window with their member.

    The semi joins change no row of the result. They go down to the scan of the lines, so lines
    of older orders are gone before ``order_item`` is joined with anything it is made of; most of
    them go by the marks, before any line is moved.
    """
    orders = recent_orders(order_header, params).select("member_id", "order_number")
    numbers = orders.select("order_number")
    recent = marked(order_item, numbers, "order_number").join(
        numbers, "order_number", "left_semi"
    )
    return orders.join(recent, "order_number")


def marked(df: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` whose key may be among ``keys``: all that are, and a few others.

    A key sets one of ``MARKS`` bits, of which the words that have any are broadcast: a million
    short rows at most, whatever the number of keys. With more keys more of the other rows
    pass, so an exact join has to follow.
    """
    place = F.pmod(F.xxhash64(name), F.lit(MARKS))
    word, bit = F.floor(place / 64), (place % 64).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit"))
    words = (
        keys.select(word.alias("_word"), bit.alias("_bit"))
        .groupBy("_word")
        .agg(F.bit_or(mask).alias("_mask"))
    )
    match = (word == F.col("_word")) & (F.getbit(F.col("_mask"), bit) == 1)
    return df.join(F.broadcast(words), match, "left_semi")


def product_group_counts(
    order_header: DataFrame, order_item: DataFrame, params: ChurnParams
) -> DataFrame:
    """Lines per (member, product group): the lossless form of the group list."""
    return (
        member_lines(order_header, order_item, params)
        .groupBy("member_id", "product_group")
        .agg(F.count("*").alias("lines"))
    )


def joined_groups(entries: Column) -> Column:
    """Sorted product groups joined by ``|``, each as often as it occurs.

    ``entries`` is an array of (product_group, lines), one per distinct group. The form
    is the same at every size; a value beyond the longest possible string fails.
    """
    spelled = F.array_join(
        F.transform(
            F.array_sort(entries),
            lambda e: F.concat(
                F.repeat(
                    F.concat(e["product_group"], F.lit("|")), (e["lines"] - 1).cast("int")
                ),
                e["product_group"],
            ),
        ),
        "|",
    )
    return F.when(F.size(entries) > 0, spelled)


def product_features(
    order_header: DataFrame, order_item: DataFrame, params: ChurnParams
) -> DataFrame:
    """Product diversity, quantity and price ratio per member.

    ``avg_discount_rate`` is paid price over list price: 1 means no discount.
    """
    lines = member_lines(order_header, order_item, params)
    counted = ["product_group", "brand_name", "sku"]
    sums = {
        "quantity": F.col("quantity"),
        "paid": F.col("quantity") * F.col("paid_price"),
        "listed": F.col("quantity") * F.col("price"),
    }

    def entry_of(name: str) -> Column:
        """A line as it counts for one of the columns; the sums go with the product group."""
        by_group = name == "product_group"
        return F.struct(
            F.lit(int(by_group)).alias("by_group"),
            *[(F.col(c) if c == name else F.lit(None)).alias(c) for c in counted],
            *[(v if by_group else F.lit(None)).alias(c) for c, v in sums.items()],
        )

    # One row per line and column, as grouping sets make them, but with sums once only.
    cells = (
        lines.select("member_id", F.inline(F.array(*map(entry_of, counted))))
        .groupBy("member_id", "by_group", *counted)
        .agg(
            F.count(F.when(F.col("by_group") == 1, 1)).alias("lines"),
            F.sum("quantity").alias("quantity"),
            F.count("quantity").alias("quantities"),
            F.sum("paid").alias("paid"),
            F.sum("listed").alias("listed"),
        )
    )
    by_group = F.col("by_group") == 1

    def total(name: str) -> Column:
        return F.sum(F.when(by_group, F.col(name)))

    entry = F.when(
        by_group & F.col("product_group").isNotNull(),
        F.struct("product_group", "lines"),
    )
    return cells.groupBy("member_id").agg(
        # The other sets hold NULL in this column, so a plain count is enough.
        F.count("product_group").alias("product_group_diversity"),
        F.count("brand_name").alias("brand_diversity"),
        F.count("sku").alias("sku_diversity"),
        ratio(total("quantity"), total("quantities").cast("double")).alias(
            "avg_quantity_per_item"
        ),
        ratio(total("paid"), total("listed")).alias("avg_discount_rate"),
        # One entry per distinct product group of the member, not per line.
        joined_groups(F.collect_list(entry)).alias("top_product_groups"),
    )


def top_product_groups(
    order_header: DataFrame, order_item: DataFrame, params: ChurnParams, k: int = 3
) -> DataFrame:
    """The k most frequent product groups per member, most frequent first."""
    counts = product_group_counts(order_header, order_item, params).where(
        F.col("product_group").isNotNull()
    )
    order = Window.partitionBy("member_id").orderBy(F.desc("lines"), "product_group")
    ranked = counts.withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= k
    )
    return ranked.groupBy("member_id").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("place", "product_group"))),
                lambda e: e["product_group"],
            ),
            "|",
        ).alias("top_groups")
    )


def visit_days(order_header: DataFrame, params: ChurnParams) -> DataFrame:
    """Orders reduced to one row per (member, day), with the gap to the member's
    previous day. A member has at most one row per calendar day, so the window never
    holds more rows than the history has days."""
    days = (
        recent_orders(order_header, params)
        .groupBy("member_id", "order_date")
        .agg(
            F.count("*").alias("orders"),
            F.sum("grand_total").alias("spent"),
            F.count("grand_total").alias("amounts"),
        )
    )
    return days.withColumn("gap", _gap_to_previous_day())


def _gap_to_previous_day() -> Column:
    by_day = Window.partitionBy("member_id").orderBy("order_date")
    return F.datediff("order_date", F.lag("order_date").over(by_day))


def days_between_orders(order_header: DataFrame, params: ChurnParams) -> DataFrame:
    """Every order row with the days since the member's previous order row.

    Rows are numbered inside their (member, day), by time, id and amount; repeated rows
    get places of their own. The first place of a day carries the gap to the previous
    day, found on one row per day; every later one carries 0. Both parts come from one
    exchange by member and day, so no task holds all orders of a member.
    """
    within_day = Window.partitionBy("member_id", "order_date").orderBy(
        "order_ts", "id", "grand_total"
    )
    placed = (
        recent_orders(order_header, params)
        .select("member_id", "id", "order_ts", "order_date", "grand_total")
        .withColumn("place", F.row_number().over(within_day))
    )
    columns = ["member_id", "id", "order_date", "grand_total"]
    first = placed.where(F.col("place") == 1).select(
        *columns, _gap_to_previous_day().alias("days_between_orders")
    )
    later = placed.where(F.col("place") > 1).select(
        *columns, F.lit(0).alias("days_between_orders")
    )
    return first.unionByName(later)


def behavioral_features(order_header: DataFrame, params: ChurnParams) -> DataFrame:
    """Weekday pattern, weekend and weekday spend, and inter-purchase time per member."""
    dow = weekday("order_date")
    orders = F.col("orders")
    weekend = dow.isin(6, 0)
    midweek = dow.between(1, 5)

    def mean_spend(inside: Column) -> Column:
        return ratio(
            F.sum(F.when(inside, F.col("spent"))),
            F.sum(F.when(inside, F.col("amounts"))).cast("double"),
        )

    totals = (
        visit_days(order_header, params)
        .groupBy("member_id")
        .agg(
            *[F.sum(F.when(dow == d, orders).otherwise(0)).alias(f"dow_{d}") for d in range(7)],
            ratio(
                F.sum(dow * orders).cast("double"), F.sum(orders).cast("double")
            ).alias("avg_day_of_week"),
            mean_spend(weekend).alias("weekend_avg_spend"),
            mean_spend(midweek).alias("weekday_avg_spend"),
            # Gaps: one per order but the first; orders on the same day add a 0.
            (F.sum(orders) - 1).alias("gaps"),
            F.sum(F.col("gap").cast("long")).alias("gap_sum"),
            F.sum(F.col("gap").cast("long") * F.col("gap")).alias("gap_squares"),
        )
    )
    counts = [F.col(f"dow_{d}") for d in range(7)]
    favourite = F.array_position(F.array(*counts), F.greatest(*counts)) - 1
    gaps = F.col("gaps")
    gap_sum = F.coalesce(F.col("gap_sum"), F.lit(0)).cast("double")
    gap_squares = F.coalesce(F.col("gap_squares"), F.lit(0)).cast("double")
    n = gaps.cast("double")
    # All terms are whole numbers of days, so this form loses no precision.
    variance = (n * gap_squares - gap_sum * gap_sum) / (n * (n - 1))
    return totals.select(
        "member_id",
        favourite.cast("int").alias("favorite_day_of_week"),
        "avg_day_of_week",
        "weekend_avg_spend",
        "weekday_avg_spend",
        F.when(gaps >= 1, gap_sum / n).alias("avg_days_between_orders"),
        F.when(gaps >= 2, F.sqrt(variance)).alias("days_between_orders_std"),
    )


def feature_set(
    order_header: DataFrame, order_item: DataFrame, params: ChurnParams
) -> DataFrame:
    """27 columns, one row per (member, tier) seen in the history window."""
    base = base_features(order_header, params)
    # The joins compare with plain equality, which a NULL member never meets: it keeps
    # its base features and gets no others. So its lines and days, possibly a large
    # share of all, are dropped at the scan instead of after their aggregation.
    known = order_header.where(F.col("member_id").isNotNull())
    product = product_features(known, order_item, params)
    behaviour = behavioral_features(known, params).drop(
        "favorite_day_of_week", "avg_day_of_week"
    )
    joined = base.join(product, "member_id", "left").join(behaviour, "member_id", "left")
    last, earlier = F.col("gmv_last_90_days"), F.col("gmv_previous_90_days")
    yearly = ratio(F.col("total_gmv"), F.col("customer_age_days").cast("double")) * 365.0
    return joined.select(
        "*",
        F.when(earlier > 0, (last - earlier) / earlier)
        .otherwise(0.0)
        .alias("spend_growth_rate"),
        ratio(F.col("avg_order_value"), yearly).alias("aov_vs_annual_spend_ratio"),
        recency_bucket(F.col("days_since_last_order")).alias("recency_bucket"),
    ).select(*FEATURE_COLUMNS)


def final_dataset(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Label and features per (member, tier); the NULL member matches itself."""
    if TIER not in features.columns:
        raise ValueError(f"the feature set has no column {TIER}")
    marks = labels.select(F.col("member_id").alias("label_member"), "is_churned")
    columns = [c for c in features.columns if c != "member_id"]
    return marks.join(
        features, marks.label_member.eqNullSafe(features.member_id)
    ).select("member_id", "is_churned", *columns)


def order_value_stats(order_header: DataFrame, params: ChurnParams) -> DataFrame:
    """Mean and sample deviation of the order value per (member, tier); one order has
    no deviation."""
    return (
        recent_orders(order_header, params)
        .groupBy("member_id", TIER)
        .agg(
            F.avg("grand_total").alias("avg_order_value"),
            F.stddev_samp("grand_total").alias("order_value_std"),
        )
    )


def primary_outlet(order_header: DataFrame, params: ChurnParams) -> DataFrame:
    """Most used outlet per (member, tier), the alphabetically first on ties."""
    visits = (
        recent_orders(order_header, params)
        .groupBy("member_id", TIER, "outlet_name")
        .agg(F.count("*").alias("orders"))
    )
    return visits.groupBy("member_id", TIER).agg(
        most_frequent(F.col("outlet_name"), F.col("orders")).alias("primary_outlet"),
        F.count("outlet_name").alias("outlet_diversity"),
    )


def recency(order_header: DataFrame, params: ChurnParams) -> DataFrame:
    """Days since the last order and its bucket per (member, tier)."""
    last = (
        recent_orders(order_header, params)
        .groupBy("member_id", TIER)
        .agg(days_before(params.as_of, F.max("order_date")).alias("days_since_last_order"))
    )
    return last.withColumn("recency_bucket", recency_bucket(F.col("days_since_last_order")))
