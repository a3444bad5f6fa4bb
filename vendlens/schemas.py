"""Schemas of the raw marketplace files.

Wall-clock timestamps are TIMESTAMP_NTZ, so no result depends on the session
time zone.  Ids are strings in the raw files; the operators only need them to
be orderable and hashable, so tables with integer ids work as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

# How the raw files end and what their columns hold ("lenght" is
# how the product file spells it).  Columns not listed are read as strings.
RAW_FILES = {
    "orders": "*orders_dataset.csv",
    "items": "*order_items_dataset.csv",
    "payments": "*order_payments_dataset.csv",
    "reviews": "*order_reviews_dataset.csv",
    "customers": "*customers_dataset.csv",
    "products": "*products_dataset.csv",
    "sellers": "*sellers_dataset.csv",
    "category_translation": "*category_name_translation.csv",
}

RAW_TYPES = {
    "order_purchase_timestamp": "timestamp_ntz",
    "order_approved_at": "timestamp_ntz",
    "order_delivered_carrier_date": "timestamp_ntz",
    "order_delivered_customer_date": "timestamp_ntz",
    "order_estimated_delivery_date": "timestamp_ntz",
    "order_item_id": "int",
    "shipping_limit_date": "timestamp_ntz",
    "price": "double",
    "freight_value": "double",
    "payment_sequential": "int",
    "payment_installments": "int",
    "payment_value": "double",
    "review_score": "int",
    "review_creation_date": "timestamp_ntz",
    "review_answer_timestamp": "timestamp_ntz",
    "customer_zip_code_prefix": "int",
    "seller_zip_code_prefix": "int",
    "product_name_lenght": "int",
    "product_description_lenght": "int",
    "product_photos_qty": "int",
    "product_weight_g": "double",
    "product_length_cm": "double",
    "product_height_cm": "double",
    "product_width_cm": "double",
}

# Free-text columns with line breaks inside quotes.
MULTILINE_FILES = {"reviews"}

# The columns of the order summary.
SUMMARY_COLUMNS = [
    "order_id",
    "customer_unique_id",
    "customer_state",
    "order_status",
    "is_revenue_order",
    "is_cancelled_order",
    "order_date",
    "order_month",
    "days_to_deliver",
    "days_vs_estimate",
    "item_count",
    "seller_count",
    "order_revenue",
    "order_freight",
    "payment_value",
    "avg_review_score",
]



class Tables:
    """A fixed set of named DataFrames, each built when first used.

    A query on one table then neither opens the files of the others nor has them
    analysed.
    """

    NAMES: tuple[str, ...] = ()

    def __init__(self, **sources: DataFrame | Callable[[], DataFrame]):
        if set(sources) != set(self.NAMES):
            raise ValueError(f"tables must be {self.NAMES}, not {tuple(sources)}")
        self._sources = dict(sources)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.NAMES:
            raise AttributeError(name)
        source = self._sources[name]
        if not isinstance(source, DataFrame):
            source = self._sources[name] = source()
        return source

    def named(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.NAMES}

    def with_tables(self, **changes: DataFrame):
        """The same tables with some of them replaced."""
        return type(self)(**{**self._sources, **changes})


class RawTables(Tables):
    """The eight raw inputs."""

    NAMES = (
        "orders", "items", "payments", "reviews",
        "customers", "products", "sellers", "category_translation",
    )


class Star(Tables):
    """The star schema: four dimensions, four facts, one wide order fact.

    `order_rollup` has one row per order, with weights; `fact_order_summary` is made from it and
    the customers.  `grain` is the one it was built with, see `operators.facts`.
    """

    NAMES = (
        "dim_customer", "dim_product", "dim_seller", "dim_date",
        "fact_orders", "fact_order_items", "fact_payments", "fact_reviews",
        "order_rollup",
    )

    def __init__(self, grain: str = "reference", **sources):
        super().__init__(**sources)
        self.grain = grain

    def with_tables(self, **changes: DataFrame) -> Star:
        return Star(self.grain, **{**self._sources, **changes})

    @property
    def fact_order_summary(self) -> DataFrame:
        from vendlens.operators.facts import order_summary

        return order_summary(self.order_rollup, self.dim_customer)

    @property
    def home_states(self) -> DataFrame | None:
        """Address rows per customer and state; None where each order has its one state."""
        from vendlens.operators.facts import home_states

        return home_states(self.dim_customer) if self.grain == "reference" else None
