"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendlens.functions.columns import round_n


def dim_customer(customers: DataFrame) -> DataFrame:
    """One row per (customer, state, zip).  A customer who moved has several rows (B1).

    The distinct count first groups by (keys, customer_id), so a customer with
    very many ids is spread over all tasks.
    """
    return (
        customers.groupBy(
            "customer_unique_id",
            F.upper(F.trim("customer_state")).alias("customer_state"),
            F.col("customer_zip_code_prefix").alias("customer_zip_prefix"),
        )
        .agg(
            F.min("customer_id").alias("first_customer_id"),
            F.countDistinct("customer_id").alias("customer_id_count"),
        )
        .select("customer_unique_id", "first_customer_id", "customer_state",
                "customer_zip_prefix", "customer_id_count")
    )


def dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with an English category, else the native one, else 'uncategorised' (B2)."""
    english = F.nullif(F.trim("product_category_name_english"), F.lit(""))
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return products.join(translation, "product_category_name", "left").select(
        "product_id",
        F.coalesce(english, "product_category_name", F.lit("uncategorised")).alias("category"),
        F.col("product_category_name").alias("category_pt"),
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        round_n(volume, 1).alias("product_volume_cm3"),
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    """Sellers with a normalised state code."""
    return sellers.select(
        "seller_id",
        F.upper(F.trim("seller_state")).alias("seller_state"),
        F.col("seller_zip_code_prefix").alias("seller_zip_prefix"),
    )


def dim_date(orders: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last purchase.

    The order table is reduced to two dates; the spine has one row per day,
    however many orders there are.
    """
    bought = F.col("order_purchase_timestamp").cast("date")
    day = F.col("date_day")
    return (
        orders.agg(F.min(bought).alias("first_day"), F.max(bought).alias("last_day"))
        .select(F.explode(
            F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))
        ).alias("date_day"))
        .select(
            day,
            F.trunc(day, "month").alias("date_month"),
            F.trunc(day, "quarter").alias("date_quarter"),
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.date_format(day, "MMM-yy").alias("month_label"),
            F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string"))
            .alias("quarter_label"),
            (F.dayofweek(day) - 1).alias("dow"),
            F.dayofyear(day).alias("doy"),
        )
    )
