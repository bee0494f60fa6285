"""Column contracts of the two input tables and of the prediction files."""

from pyspark.sql import types as T

ORDER_HEADER = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("member_id", T.LongType()),
        T.StructField("order_ts", T.TimestampType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("grand_total", T.DoubleType()),
        T.StructField("outlet_name", T.StringType()),
        T.StructField("member_tier_when_transact", T.StringType()),
        T.StructField("order_number", T.StringType()),
    ]
)

ORDER_ITEM = T.StructType(
    [
        T.StructField("order_number", T.StringType()),
        T.StructField("product_group", T.StringType()),
        T.StructField("brand_name", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("paid_price", T.DoubleType()),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("member_id", T.LongType()),
        T.StructField("member_tier_when_transact", T.StringType()),
        T.StructField("actual_churn", T.IntegerType()),
        T.StructField("predicted_churn", T.IntegerType()),
        T.StructField("churn_probability", T.DoubleType()),
        T.StructField("risk_segment", T.StringType()),
    ]
)
