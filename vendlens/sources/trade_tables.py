"""Adapter: a generic order/lineitem/customer/part schema -> the raw marketplace tables.

The generic tables hold no reviews, deliveries or payments.  They are derived
row by row with integer arithmetic on the keys, so the work grows with the input
tables and any SQL engine can derive the same values.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vendlens.functions.columns import amount, cents
from vendlens.schemas import RawTables

# Fixed values of the fixture: native category -> English name.  One blank, one
# category missing, so that both fallbacks are met.
TRANSLATION = [
    ("ECONOMY", "economy"),
    ("SMALL", "small"),
    ("STANDARD", "standard"),
    ("LARGE", "large"),
    ("MEDIUM", ""),
]


def _minutes(count: Column) -> Column:
    return F.make_dt_interval(mins=count.cast("int"))


def _orders(orders: DataFrame) -> DataFrame:
    k, source = F.col("o_orderkey"), F.col("o_orderstatus")
    purchase = F.col("o_orderdate") + _minutes((k * 37) % 1440)
    delivered = ((source == "F") & (k % 97 != 0)) | ((source != "F") & (k % 89 == 0))
    status = (
        F.when(source == "F", "delivered")
        .when(source == "O", "shipped")
        .when(k % 3 == 0, "canceled")
        .when(k % 3 == 1, "unavailable")
        .otherwise("processing")
    )
    return orders.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        F.when(k % 101 != 0, purchase + _minutes((k * 53) % 2880)).alias("order_approved_at"),
        F.when(source != "P", purchase + _minutes(2880 + (k * 71) % 10080))
        .alias("order_delivered_carrier_date"),
        F.when(delivered, purchase + _minutes(2880 + (k * 131) % 43200))
        .alias("order_delivered_customer_date"),
        F.date_add(F.col("o_orderdate").cast("date"), (k % 21 + 10).cast("int"))
        .cast("timestamp_ntz").alias("order_estimated_delivery_date"),
    )


def _share(whole_cents: Column, rate: Column) -> Column:
    """A percentage of an amount in cents, rounded half up to the cent."""
    return F.floor((whole_cents * rate + 50) / F.lit(100.0))


def _items(lineitem: DataFrame) -> DataFrame:
    price, tax = cents(F.col("l_extendedprice")), cents(F.col("l_tax"))
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        amount(price).alias("price"),
        amount(_share(price, tax)).alias("freight_value"),
    )


def _payments(lineitem: DataFrame) -> DataFrame:
    price, kept = cents(F.col("l_extendedprice")), 100 - cents(F.col("l_discount"))
    flag = F.col("l_returnflag")
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.when(flag == "A", "credit_card").when(flag == "N", "boleto").when(flag == "R", "voucher")
        .alias("payment_type"),
        F.when(flag == "A", 1 + F.col("l_partkey") % 10).otherwise(1).cast("int")
        .alias("payment_installments"),
        amount(_share(price, kept)).alias("payment_value"),
    )


def _reviews(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    created = F.col("o_orderdate") + _minutes((k * 37) % 1440 + 30 * 1440)
    first = F.struct(k.alias("id"), (1 + (k * 7) % 5).alias("score"),
                     F.col("o_orderpriority").alias("title"), (k % 10 != 0).alias("present"))
    second = F.struct((k + 1_000_000_000).alias("id"), (1 + k % 5).alias("score"),
                      F.lit(None).cast("string").alias("title"), (k % 20 == 5).alias("present"))
    return (
        orders.select(k, created.alias("created"), F.explode(F.array(first, second)).alias("r"))
        .where("r.present")
        .select(
            F.col("r.id").alias("review_id"),
            k.alias("order_id"),
            F.col("r.score").cast("int").alias("review_score"),
            F.col("r.title").alias("review_comment_title"),
            F.lit(None).cast("string").alias("review_comment_message"),
            F.col("created").alias("review_creation_date"),
            (F.col("created") + _minutes((k * 17) % 7200)).alias("review_answer_timestamp"),
        )
    )


def _padded_state(nation: DataFrame) -> Column:
    return F.concat(F.lit(" "), F.lower(nation["n_name"]), F.lit(" "))


def _customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    shared = (k % 40).isin(0, 1)
    home = F.when(shared, 0).otherwise(F.col("c_nationkey"))
    return (
        customer.withColumn("home", home)
        .join(nation, F.col("home") == nation["n_nationkey"], "left")
        .select(
            k.alias("customer_id"),
            F.when(k % 20 == 1, k - 1).otherwise(k).alias("customer_unique_id"),
            F.when(shared, 0).otherwise(F.col("c_nationkey") * 100 + k % 7).cast("int")
            .alias("customer_zip_code_prefix"),
            _padded_state(nation).alias("customer_state"),
        )
    )


def _products(part: DataFrame) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    return part.select(
        k.alias("product_id"),
        F.when(k % 50 != 0, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        size.alias("product_description_lenght"),
        (size % 6).alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
        size.cast("double").alias("product_length_cm"),
        (1 + size % 10).cast("double").alias("product_height_cm"),
        (1 + k % 30).cast("double").alias("product_width_cm"),
    )


def _sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(
        nation, F.col("s_nationkey") == nation["n_nationkey"], "left"
    ).select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        _padded_state(nation).alias("seller_state"),
    )


def _translation(spark: SparkSession) -> DataFrame:
    # VALUES gives a local relation, whose exact size the planner knows.
    values = ", ".join(f"('{native}', '{english}')" for native, english in TRANSLATION)
    return spark.sql(
        f"SELECT * FROM VALUES {values} AS "
        "t(product_category_name, product_category_name_english)"
    )


def raw_tables(spark: SparkSession, folder: str) -> RawTables:
    """The raw marketplace tables derived from the Parquet tables of `folder`."""

    @cache
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    return RawTables(
        orders=lambda: _orders(table("orders")),
        items=lambda: _items(table("lineitem")),
        payments=lambda: _payments(table("lineitem")),
        reviews=lambda: _reviews(table("orders")),
        customers=lambda: _customers(table("customer"), table("nation")),
        products=lambda: _products(table("part")),
        sellers=lambda: _sellers(table("supplier"), table("nation")),
        category_translation=lambda: _translation(spark),
    )
