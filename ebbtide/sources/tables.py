"""Readers for the order tables: Parquet, CSV, JDBC and the sample star schema."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.sources.schemas import ORDER_HEADER, ORDER_ITEM


@dataclass(frozen=True)
class Tables:
    order_header: DataFrame
    order_item: DataFrame

    def as_views(self) -> None:
        self.order_header.createOrReplaceTempView("order_header")
        self.order_item.createOrReplaceTempView("order_item")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to ``schema``; a missing column is an error."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def normalise_header(df: DataFrame) -> DataFrame:
    """Turn the stored ``order_date`` (text, date or timestamp) into typed columns.

    The cast happens once here. A filter on the derived date of a timestamp column
    still reaches the Parquet scan; one on text cannot, so text sources should be
    rewritten with typed columns before repeated use.
    """
    if "order_ts" not in df.columns:
        df = df.withColumn("order_ts", F.col("order_date").cast("timestamp"))
    df = df.withColumn("order_date", F.to_date("order_ts"))
    return conform(df, ORDER_HEADER)


def read_parquet(spark: SparkSession, header_path: str, item_path: str) -> Tables:
    return Tables(
        normalise_header(spark.read.parquet(header_path)),
        conform(spark.read.parquet(item_path), ORDER_ITEM),
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def jdbc_options(table: str, environ: dict[str, str] | None = None) -> dict[str, str]:
    """Connection options for one table, taken from ``ORDERS_DB_*`` variables."""
    env = os.environ if environ is None else environ
    url = env.get("ORDERS_DB_URL")
    if not url:
        raise ValueError("ORDERS_DB_URL is not set")
    options = {"url": url, "dbtable": table, "fetchsize": "10000"}
    for name, key in (("ORDERS_DB_USER", "user"), ("ORDERS_DB_PASSWORD", "password")):
        if env.get(name):
            options[key] = env[name]
    return options


def text_splits(column: str, splits: int) -> list[str]:
    """Conditions that cut a table without a numeric key into ``splits`` parts of about
    equal size (PostgreSQL hash); rows without the key go to the first part."""
    parts = [
        f"mod(abs(hashtext({column})::bigint), {splits}) = {part}" for part in range(splits)
    ]
    parts[0] = f"({parts[0]} OR {column} IS NULL)"
    return parts


def block_splits(blocks: int, splits: int) -> list[str]:
    """Predicates over ranges of table blocks: every part reads its own blocks only.

    ``blocks`` is the table's size now; the last part has no upper end, so rows added
    meanwhile are read too.
    """
    step = max(1, -(-blocks // splits))
    starts = range(0, max(1, blocks), step)
    parts = []
    for start in starts:
        part = f"ctid >= '({start},0)'::tid"
        if start + step < blocks:
            part += f" AND ctid < '({start + step},0)'::tid"
        parts.append(part)
    return parts


def read_jdbc(
    spark: SparkSession,
    table: str,
    split_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    splits: int = 64,
    predicates: list[str] | None = None,
    environ: dict[str, str] | None = None,
) -> DataFrame:
    """Read a table in parallel: by ranges of ``split_column``, or one part per
    predicate (see :func:`block_splits`, and :func:`text_splits` for other databases)."""
    options = jdbc_options(table, environ)
    if predicates is not None:
        url, source = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, source, predicates=predicates, properties=options)
    if split_column is not None:
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(splits),
        }
    return spark.read.format("jdbc").options(**options).load()


def is_readable(df: DataFrame) -> bool:
    """Liveness check: can the source deliver its first row?"""
    try:
        df.take(1)
    except Exception:
        return False
    return True


def sample_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_header derived from the star-schema sample data (see FIXTURES.md)."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    priority = F.col("o_orderpriority")
    tier = (
        F.when(priority == "1-URGENT", "VVIP")
        .when(priority == "2-HIGH", "GOLD")
        .when(priority == "3-MEDIUM", "SILVER")
        .when((priority == "5-LOW") & (F.col("o_orderkey") % 2 == 1), "BRONZE")
        .when(priority == "5-LOW", "BLACK")
    )
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("member_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_ts"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("grand_total"),
        F.concat(F.lit("Outlet "), (F.col("o_orderkey") % 12).cast("string")).alias(
            "outlet_name"
        ),
        tier.alias("member_tier_when_transact"),
        F.col("o_orderkey").cast("string").alias("order_number"),
    )


def sample_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_item derived from the star-schema sample data."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    unit_price = F.col("l_extendedprice") / F.col("l_quantity")
    # Everything is computed before the join: a semi join on the number goes below a join, but
    # not below expressions.
    sold = lines.select(
        F.col("l_orderkey").cast("string").alias("order_number"),
        "l_partkey",
        F.col("l_quantity").alias("quantity"),
        unit_price.alias("price"),
        (unit_price * (1 - F.col("l_discount"))).alias("paid_price"),
    )
    goods = part.select(
        "p_partkey",
        F.col("p_type").alias("product_group"),
        F.col("p_brand").alias("brand_name"),
        F.col("p_partkey").cast("string").alias("sku"),
    )
    return sold.join(goods, sold.l_partkey == goods.p_partkey).select(
        "order_number", "product_group", "brand_name", "sku", "quantity", "price", "paid_price"
    )


def sample_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(sample_header(spark, sf_dir), sample_item(spark, sf_dir))
