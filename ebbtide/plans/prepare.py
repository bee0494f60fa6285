"""Model features: tier and interaction features, imputation, label codes, alignment.

Medians, modes and label codes are fitted once on the training rows of a route and
reused when scoring.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import double_text, quoted, ratio
from ebbtide.operators.correlation import numeric_columns, text_columns
from ebbtide.operators.ordering import forward_filled, with_rank
from ebbtide.operators.quantiles import column_quantiles, grouped_quantiles
from ebbtide.params import GLOBAL_ROUTE, TIER, UNKNOWN
from ebbtide.plans.features import most_frequent
from ebbtide.session import pinned

EXCLUDED = ("member_id", "is_churned")
TINY = 1e-6
ROW_ORDER = ("member_id", TIER)
# Number of the model of a row, and of the fallback model.
NUMBER = "_route"
FALLBACK = -1


def check_input(df: DataFrame, route: str = GLOBAL_ROUTE) -> None:
    """Raise ValueError for an empty frame or a missing key column."""
    needed = ["member_id"] if route == GLOBAL_ROUTE else ["member_id", TIER]
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns for route {route}: {missing}")
    if df.isEmpty():
        raise ValueError(f"no rows for route {route}")


def with_known_tier(df: DataFrame) -> DataFrame:
    return df.withColumn(TIER, F.coalesce(F.col(TIER), F.lit(UNKNOWN)))


def _number(name: str) -> Column:
    return F.col(name).cast("double")


def _present(columns: Sequence[str], *needed: str) -> bool:
    return all(n in columns for n in needed)


def tier_features(columns: Sequence[str], tier: str) -> dict[str, Column]:
    """Extra features of a tier, as far as their inputs are present."""
    n = _number
    made: dict[str, Column] = {}
    if tier == "VVIP":
        if _present(columns, "outlet_diversity", "product_group_diversity", "brand_diversity"):
            made["vvip_engagement_score"] = (
                n("outlet_diversity") * 2
                + n("product_group_diversity") * 3
                + n("brand_diversity") * 1.5
            )
        if _present(columns, "avg_order_value", "avg_days_between_orders"):
            made["vvip_service_expectation"] = ratio(
                n("avg_order_value"), n("avg_days_between_orders") + TINY
            )
        if _present(columns, "avg_discount_rate"):
            made["vvip_premium_behavior"] = ratio(
                F.lit(1.0), n("avg_discount_rate") + 0.01
            )
    elif tier == "GOLD":
        if _present(columns, "active_months", "avg_orders_per_month"):
            made["gold_loyalty_score"] = n("active_months") * n("avg_orders_per_month")
        if _present(columns, "order_value_std", "avg_order_value"):
            made["gold_spending_stability"] = ratio(
                n("avg_order_value"), n("order_value_std") + TINY
            )
    elif tier == "SILVER":
        if _present(columns, "spend_growth_rate", "brand_diversity"):
            made["silver_growth_potential"] = n("spend_growth_rate") * n("brand_diversity")
        if _present(columns, "gmv_last_90_days", "gmv_previous_90_days"):
            made["silver_engagement_trend"] = ratio(
                n("gmv_last_90_days"), n("gmv_previous_90_days") + TINY
            )
    elif tier in ("BLACK", "BRONZE"):
        if _present(columns, "avg_discount_rate"):
            made["price_sensitivity"] = n("avg_discount_rate")
        if _present(columns, "avg_order_value", "avg_discount_rate"):
            made["value_seeking_score"] = n("avg_order_value") * n("avg_discount_rate")
    return made


def interaction_features(columns: Sequence[str]) -> dict[str, Column]:
    n = _number
    made: dict[str, Column] = {}
    if _present(columns, "days_since_last_order", "total_orders", "total_gmv"):
        recency = n("days_since_last_order") + 1
        made["rf_interaction"] = ratio(n("total_orders"), recency)
        made["fm_interaction"] = n("total_orders") * n("total_gmv")
        made["rfm_composite"] = (
            ratio(F.lit(1.0), recency) * n("total_orders") * n("total_gmv")
        )
    if _present(columns, "avg_days_between_orders", "days_between_orders_std"):
        made["purchase_regularity"] = ratio(
            n("avg_days_between_orders"), n("days_between_orders_std") + TINY
        )
    if _present(columns, "outlet_diversity", "total_orders"):
        made["channel_loyalty"] = ratio(n("total_orders"), n("outlet_diversity") + 1)
    return made


def _made_columns(columns: Sequence[str], route: str) -> dict[str, Column]:
    made = {} if route == GLOBAL_ROUTE else tier_features(columns, route)
    return made | interaction_features(columns)


def engineered(df: DataFrame, route: str) -> DataFrame:
    """Tier features (not on the global route), then interactions; NULL inputs give
    NULL features, which are imputed later like any other."""
    made = _made_columns(df.columns, route)
    return df.withColumns(made) if made else df


@dataclass
class Preparation:
    route: str
    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float | None]
    # Code of the most frequent class per text column, taken by NULL.
    mode_codes: dict[str, float]
    # Rows (column, value, code) of all text columns; None without text columns.
    codes: DataFrame | None = None
    # Where several routes were fitted together: their codes in one table, and the number
    # of this route in it.
    number: int = FALLBACK
    shared_codes: DataFrame | None = None

    @property
    def feature_names(self) -> list[str]:
        return [*self.numeric, *[f"{c}_encoded" for c in self.categorical]]


def category_counts(
    df: DataFrame, columns: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """Rows per (column, value) of several text columns, from one pass; per ``within``
    too when given."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
    )
    return (
        df.select(*within, F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy(*within, "column", "value")
        .agg(F.count("*").alias("n"))
    )


def category_modes(counts: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    return counts.groupBy(*within, "column").agg(
        most_frequent(F.col("value"), F.col("n")).alias("mode")
    )


def label_codes(counts: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Alphabetical codes from 0 per column, as a table: a column may have as many
    classes as there are members, so the classes never travel through the driver."""
    ranked = with_rank(
        counts.select(*within, "column", "value"),
        [F.col("value")],
        [*within, "column"],
        "place",
    )
    return ranked.select(
        *within, "column", "value", (F.col("place") - 1).cast("double").alias("code")
    )


def fit_preparation(df: DataFrame, route: str = GLOBAL_ROUTE) -> Preparation:
    """Learn medians, modes and label codes. ``df`` is read a few times: pass a stored
    frame."""
    check_input(df, route)
    made = engineered(df, route)
    numeric = [c for c in numeric_columns(made) if c not in EXCLUDED]
    categorical = [c for c in text_columns(made) if c not in EXCLUDED]
    medians = {
        c: q.values[0] for c, q in column_quantiles(made, numeric, [0.5]).items()
    }
    mode_codes = dict.fromkeys(categorical, 0.0)
    codes = None
    if categorical:
        counts = pinned(category_counts(made, categorical))
        codes = pinned(label_codes(counts))
        modes = category_modes(counts)
        chosen = modes.join(codes, ["column"]).where(F.col("value") == F.col("mode"))
        # One number per text column; the texts themselves stay where they are.
        for row in chosen.select("column", "code").collect():
            mode_codes[row["column"]] = row["code"]
    return Preparation(route, numeric, categorical, medians, mode_codes, codes)


def _with_made(df: DataFrame, routes: Iterable[str]) -> DataFrame:
    """Add ``_made_<feature>`` for the engineered features of all routes. A feature has one
    formula wherever it occurs, so each is there once."""
    made: dict[str, Column] = {}
    for route in routes:
        made |= _made_columns(df.columns, route)
    return df.withColumns({f"_made_{c}": e for c, e in made.items()}) if made else df


def fit_preparations(df: DataFrame, routes: dict[int, str]) -> dict[int, Preparation]:
    """:func:`fit_preparation` of several routes at once, by their numbers.

    ``df`` names the route of a row in column ``_route``. The route ``FALLBACK`` learns from
    all rows, every other one from its own; rows of a number that is not asked for count
    for the fallback only. A row is read once for its own route and once for the fallback,
    and the number of jobs does not depend on the number of routes. ``df`` is read a few
    times: pass a stored frame. A route without rows gets no medians and no codes.
    """
    plain = df.drop(NUMBER)
    check_input(plain, GLOBAL_ROUTE if set(routes) == {FALLBACK} else "")
    shapes = {n: engineered(plain, route) for n, route in routes.items()}
    numeric = {
        n: [c for c in numeric_columns(shape) if c not in EXCLUDED]
        for n, shape in shapes.items()
    }
    categorical = [c for c in text_columns(plain) if c not in EXCLUDED]
    made = {n: _made_columns(plain.columns, route) for n, route in routes.items()}
    sources = {
        n: {c: f"_made_{c}" if c in made[n] else c for c in numeric[n]} for n in routes
    }
    used = sorted({name for by_route in sources.values() for name in by_route.values()})
    wide = _with_made(df, routes.values())
    own = F.array_distinct(F.array(F.col(NUMBER), F.lit(FALLBACK)))
    copies = wide.select(F.explode(own).alias(NUMBER), *used, *categorical).where(
        F.col(NUMBER).isin(list(routes))
    )
    found = grouped_quantiles(copies, NUMBER, used, [0.5])
    medians = {
        n: {
            c: found[n, name].values[0] if (n, name) in found else None
            for c, name in sources[n].items()
        }
        for n in routes
    }
    mode_codes = {n: dict.fromkeys(categorical, 0.0) for n in routes}
    codes = None
    if categorical:
        counts = pinned(category_counts(copies, categorical, [NUMBER]))
        codes = pinned(label_codes(counts, [NUMBER]))
        modes = category_modes(counts, [NUMBER])
        chosen = modes.join(codes, [NUMBER, "column"]).where(F.col("value") == F.col("mode"))
        # One number per route and text column.
        for row in chosen.select(NUMBER, "column", "code").collect():
            mode_codes[row[NUMBER]][row["column"]] = row["code"]
    return {
        n: Preparation(
            route,
            numeric[n],
            list(categorical),
            medians[n],
            mode_codes[n],
            None if codes is None else codes.where(F.col(NUMBER) == n).drop(NUMBER),
            n,
            codes,
        )
        for n, route in routes.items()
    }


def codes_of_routes(preps: dict[int, Preparation]) -> DataFrame | None:
    """The codes of all routes as (_route, column, value, code), by the numbers given."""
    tables = {id(p.shared_codes) for p in preps.values()}
    first = next(iter(preps.values())).shared_codes
    if len(tables) == 1 and first is not None:
        if all(p.number == n for n, p in preps.items()):
            return first
    parts = [
        p.codes.select(F.lit(n).alias(NUMBER), "column", "value", "code")
        for n, p in preps.items()
        if p.codes is not None
    ]
    return reduce(DataFrame.unionByName, parts) if parts else None


def route_vectors(
    df: DataFrame, preps: dict[int, Preparation], keep: Sequence[str] = ()
) -> DataFrame:
    """``keep``, ``_route`` and ``features``: the features of every row, as an array in the
    order of its own route, by one plan for all routes.

    The values are those of :func:`prepared_features` with ``fill=False``: rows went through
    :func:`with_filled_days` before. A row whose route has no preparation here has NULL.
    """
    given = [c for c in df.columns if c != NUMBER and not c.startswith("_filled_")]
    fills = {c for c in df.columns if c.startswith("_filled_")}
    made = {n: _made_columns(given, p.route) for n, p in preps.items()}
    wide = _with_made(
        df.withColumns({f"_keep_{c}": F.col(c) for c in keep}),
        [p.route for p in preps.values()],
    )
    coded = sorted({c for p in preps.values() for c in p.categorical if c in given})
    codes = codes_of_routes(preps) if coded else None
    for place, column in enumerate(coded if codes is not None else []):
        known = codes.where(F.col("column") == column).select(
            F.col(NUMBER).alias("_at"),
            F.md5("value").alias("_hash"),
            F.col("value").alias("_value"),
            F.col("code").alias(f"_code_{place}"),
        )
        # By a hash of the value, and the value itself against collisions.
        match = (
            (F.col(NUMBER) == F.col("_at"))
            & (F.md5(F.col(quoted(column))) == F.col("_hash"))
            & (F.col(quoted(column)) == F.col("_value"))
        )
        wide = wide.join(known, match, "left").drop("_at", "_hash", "_value")

    def number(c: str, n: int, prep: Preparation) -> str:
        if c in made[n]:
            source = f"cast({quoted(f'_made_{c}')} as double)"
        elif c in given:
            source = f"cast({quoted(c)} as double)"
            if f"_filled_{c}" in fills:
                source = f"cast({quoted(f'_filled_{c}')} as double), {source}"
        else:
            return "0.0D"
        median = prep.medians.get(c)
        return f"coalesce({source}, {double_text(0.0 if median is None else median)})"

    def code(c: str, prep: Preparation) -> str:
        if c in given:
            place = f"_code_{coded.index(c)}" if codes is not None else "NULL"
            mode = double_text(prep.mode_codes[c])
            return f"IF({quoted(c)} IS NULL, {mode}, coalesce({place}, 0.0D))"
        spare = f"{c}_encoded"
        return f"cast({quoted(spare)} as double)" if spare in given else "0.0D"

    whens = []
    for n, prep in preps.items():
        parts = [number(c, n, prep) for c in prep.numeric]
        parts += [code(c, prep) for c in prep.categorical]
        values = f"array({', '.join(parts)})" if parts else "cast(array() as array<double>)"
        whens.append(f"WHEN {n} THEN {values}")
    return wide.select(
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
        NUMBER,
        F.expr(f"CASE {NUMBER} {' '.join(whens)} END").alias("features"),
    )


def with_filled_days(df: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Add ``_filled_<c>`` for every ``days_*`` column that has NULLs: its last known
    value in member order, within ``within`` when given.

    Only keys and these columns are ordered, one row per key (of rows that share a key, the
    largest value counts for those without one). Rows without gaps stay where they are,
    the others are joined with their fills. ``df`` is read a few times: pass a stored frame.
    """
    days = [c for c in numeric_columns(df) if c.startswith("days_")]
    if not days:
        return df
    gaps = df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in days]).first()
    days = [c for c in days if gaps[c]]
    if not days:
        return df
    order = [c for c in ROW_ORDER if c in df.columns]
    keys = list(dict.fromkeys([*within, *order]))
    lacking = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in days])
    narrow = df.groupBy(*keys).agg(
        *[F.max(c).alias(f"_last_{c}") for c in days], F.max(lacking).alias("_lacking")
    )
    filled = forward_filled(
        narrow, [F.asc_nulls_last(c) for c in order], [f"_last_{c}" for c in days], within
    )
    # Keys of rows with gaps and their fills, computed once for all readers.
    fills = pinned(
        filled.where(F.col("_lacking")).select(
            *[F.col(k).alias(f"_key_{k}") for k in keys], *[f"_last_{c}" for c in days]
        )
    )
    match = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    )
    whole = df.where(~lacking).select("*", *[F.col(c).alias(f"_filled_{c}") for c in days])
    mended = df.where(lacking).join(fills, match, "left").select(
        *df.columns, *[F.coalesce(c, f"_last_{c}").alias(f"_filled_{c}") for c in days]
    )
    return whole.unionByName(mended)


def with_numbers(df: DataFrame, prep: Preparation) -> DataFrame:
    """Median imputation; a column without any value becomes 0."""

    def filled(c: str) -> str:
        median = prep.medians.get(c)
        spare = double_text(0.0 if median is None else median)
        return f"coalesce(cast({quoted(c)} as double), {spare}) AS {quoted(c)}"

    numeric = set(prep.numeric)
    return df.selectExpr(*[filled(c) if c in numeric else quoted(c) for c in df.columns])


def with_codes(df: DataFrame, prep: Preparation) -> DataFrame:
    """Replace text columns by their codes: NULL takes the mode's code, an unknown value
    the first class.

    The code table is joined by a hash of the value, and by the value itself against
    collisions. NULL takes no part in the join, so rows without a value are no hot key.
    """
    present = set(df.columns)
    for column in prep.categorical:
        if column not in present:
            continue
        codes = prep.codes.where(F.col("column") == column).select(
            F.md5("value").alias("_hash"),
            F.col("value").alias("_value"),
            F.col("code").alias("_code"),
        )
        mode = F.lit(prep.mode_codes[column])
        match = (F.md5(column) == F.col("_hash")) & (F.col(column) == F.col("_value"))
        code = F.when(F.col(column).isNull(), mode).otherwise(F.coalesce("_code", F.lit(0.0)))
        df = (
            df.join(codes, match, "left")
            .withColumn(f"{column}_encoded", code)
            .drop("_hash", "_value", "_code")
        )
    return df.drop(*prep.categorical)


def aligned(
    df: DataFrame, feature_names: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Exactly the model's features in its order: missing ones as 0, others dropped."""
    columns = set(df.columns)
    return df.selectExpr(
        *keep,
        *[
            f"cast({quoted(c)} as double) AS {quoted(c)}"
            if c in columns
            else f"0.0D AS {quoted(c)}"
            for c in feature_names
        ],
    )


def prepared_features(
    df: DataFrame, prep: Preparation, keep: Sequence[str] = (), fill: bool = True
) -> DataFrame:
    """Apply a fitted preparation; columns in ``keep`` are carried along.

    ``fill=False`` is for rows that went through :func:`with_filled_days` before.
    Either way the engineered features see the values before filling.
    """
    if fill:
        df = with_filled_days(df)
    columns = df.columns
    held = [c for c in keep if c in columns]
    # A kept text column is also a feature, so it is carried under another name.
    made = engineered(df, prep.route).withColumns({f"_keep_{c}": F.col(c) for c in held})
    fills = [c for c in columns if c.startswith("_filled_")]
    made = made.withColumns({c.removeprefix("_filled_"): F.col(c) for c in fills})
    made = with_codes(with_numbers(made, prep), prep)
    return aligned(made, prep.feature_names, [f"_keep_{c}" for c in held]).withColumnsRenamed(
        {f"_keep_{c}": c for c in held}
    )


def unseen_categories(df: DataFrame, fitted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) pairs of ``df`` that the fitted codes do not know."""
    seen = category_counts(df, columns).select("column", "value")
    return seen.join(fitted.select("column", "value"), ["column", "value"], "left_anti")



def unseen_by_route(
    df: DataFrame, routes: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """(route, column, value): texts of other tiers' rows that a fit on ``route`` has
    not seen. ``df`` has known tiers and ``routes`` is the fixed list of tier models."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
    )
    held = (
        df.select(F.col(TIER).alias("route"), F.inline(pairs))
        .where(F.col("value").isNotNull())
        .distinct()
    )
    others = held.select(
        F.explode(F.array(*map(F.lit, routes))).alias("asking"), "route", "column", "value"
    ).where(F.col("asking") != F.col("route"))
    asked = others.select(F.col("asking").alias("route"), "column", "value").distinct()
    return asked.join(held, ["route", "column", "value"], "left_anti")
