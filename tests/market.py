"""A hand-built marketplace of a few rows, with every awkward case once."""

from __future__ import annotations

from datetime import datetime

from vendlens.schemas import RawTables


def ts(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


ORDERS = [
    # order, customer id, status, bought, approved, shipped, delivered, promised
    ("o1", "c1", "delivered", "2017-01-05 10:00:59", "2017-01-05 10:01:01",
     "2017-01-07 00:00:00", "2017-01-10 23:59:59", "2017-01-18 00:00:00"),
    ("o2", "c2", "delivered", "2017-02-05 23:59:59", "2017-02-06 00:00:00",
     "2017-02-08 12:00:00", "2017-02-20 08:00:00", "2017-02-19 00:00:00"),
    ("o3", "c3", "shipped", "2017-02-10 09:00:00", None, None, None, "2017-03-01 00:00:00"),
    ("o4", "c4", "canceled", "2017-03-01 09:00:00", None, None, None, "2017-03-09 00:00:00"),
    ("o5", "c5", "delivered", "2017-04-01 00:00:00", "2017-04-01 01:00:00",
     "2017-04-02 00:00:00", "2017-04-01 12:00:00", "2017-04-01 00:00:00"),
    # a revenue order without items, and one whose customer is unknown
    ("o6", "c6", "delivered", "2017-04-03 00:00:00", "2017-04-03 01:00:00",
     "2017-04-04 00:00:00", None, "2017-04-20 00:00:00"),
    ("o7", "nobody", "delivered", "2017-05-01 00:00:00", "2017-05-01 00:30:00",
     "2017-05-02 00:00:00", "2017-12-01 00:00:00", "2017-05-20 00:00:00"),
]

CUSTOMERS = [
    # c1 and c2 are one person who moved; c3 and c6 are one person with one address
    ("c1", "u1", 1000, " sp "),
    ("c2", "u1", 2000, "RJ"),
    ("c3", "u3", 3000, "mg"),
    ("c6", "u3", 3000, "MG"),
    ("c4", "u4", 4000, "sp"),
    ("c5", "u5", 5000, None),
]

ITEMS = [
    ("o1", 1, "p1", "s1", "10.10", 1.00),
    ("o1", 2, "p1", "s1", "20.20", 2.00),
    ("o1", 3, "p2", "s2", "0.30", 0.10),
    ("o2", 1, "p3", "s1", "100.00", 10.0),
    ("o3", 1, "p2", "s1", "50.00", 5.00),
    ("o3", 2, "p2", "s1", "not a number", 5.00),
    ("o4", 1, "p1", "s1", "9.99", 1.00),
    ("o5", 1, None, "s2", "7.00", None),
    ("o7", 1, "p4", "s2", "3.00", 0.50),
    ("ghost", 1, "p1", "s1", "-1.00", 0.00),
]

PAYMENTS = [
    ("o1", 1, "credit_card", 3, 30.60),
    ("o1", 2, "voucher", 1, 3.10),
    ("o2", 1, "credit_card", 1, 110.00),
    ("o3", 1, "boleto", None, 55.00),
    ("o4", 1, "boleto", 1, 10.99),
    ("ghost", 1, "boleto", 1, 1.00),
]

REVIEWS = [
    ("r1", "o1", 5, "2017-01-11 00:00:00", "2017-01-11 00:59:59"),
    ("r2", "o1", 4, "2017-01-12 00:30:00", "2017-01-13 01:10:00"),
    ("r3", "o2", 1, "2017-02-21 00:00:00", "2017-02-22 00:00:00"),
    ("r3", "o3", 2, "2017-02-21 00:00:00", "2017-02-22 00:00:00"),
    ("r5", "o5", None, "2017-04-02 00:00:00", None),
]

PRODUCTS = [
    ("p1", "beleza", 3, 4, 1, 100.0, 10.0, 2.0, 3.0),
    ("p2", "moveis", 3, 4, 1, 100.0, 1.5, 1.5, 1.55),
    ("p3", "vazio", 3, 4, 1, 100.0, None, 2.0, 3.0),
    ("p4", None, 3, 4, 1, 100.0, 1.0, 2.0, 3.0),
]

TRANSLATION = [("beleza", "beauty"), ("vazio", "  ")]


def raw(spark, orders=ORDERS, customers=CUSTOMERS, items=ITEMS, payments=PAYMENTS,
        reviews=REVIEWS) -> RawTables:
    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    return RawTables(
        orders=table(
            [(*o[:3], *[ts(t) for t in o[3:]]) for o in orders],
            """order_id string, customer_id string, order_status string,
            order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,
            order_delivered_carrier_date timestamp_ntz,
            order_delivered_customer_date timestamp_ntz,
            order_estimated_delivery_date timestamp_ntz"""),
        items=table(
            [(*i[:4], ts("2017-01-01"), *i[4:]) for i in items],
            """order_id string, order_item_id int, product_id string, seller_id string,
            shipping_limit_date timestamp_ntz, price string, freight_value double"""),
        payments=table(payments, """order_id string, payment_sequential int,
            payment_type string, payment_installments int, payment_value double"""),
        reviews=table(
            [(r[0], r[1], r[2], "title", "line\nbreak", ts(r[3]), ts(r[4])) for r in reviews],
            """review_id string, order_id string, review_score int,
            review_comment_title string, review_comment_message string,
            review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"""),
        customers=table(customers, """customer_id string, customer_unique_id string,
            customer_zip_code_prefix int, customer_state string"""),
        products=table(PRODUCTS, """product_id string, product_category_name string,
            product_name_lenght int, product_description_lenght int, product_photos_qty int,
            product_weight_g double, product_length_cm double, product_height_cm double,
            product_width_cm double"""),
        sellers=table([("s1", 10, " sp"), ("s2", 20, "rj ")],
                      "seller_id string, seller_zip_code_prefix int, seller_state string"),
        category_translation=table(
            TRANSLATION, "product_category_name string, product_category_name_english string"),
    )


def rows(df, *key):
    """Rows as dictionaries, by the value of the key columns."""
    result = {}
    for row in df.collect():
        k = tuple(row[c] for c in key)
        result[k[0] if len(k) == 1 else k] = row.asDict()
    return result
