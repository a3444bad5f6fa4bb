"""Marts against brute force in plain Python on the hand-built marketplace."""

import random
from collections import defaultdict
from datetime import date

import pytest
from market import CUSTOMERS, ITEMS, ORDERS, REVIEWS, raw, rows

from vendlens.operators import marts as m
from vendlens.operators import rfm
from vendlens.plans.marts import MARTS
from vendlens.plans.warehouse import star_schema


@pytest.fixture(scope="module")
def star(spark):
    return star_schema(raw(spark))


@pytest.fixture(scope="module")
def profile(star):
    return rfm.customer_profile(star.fact_order_summary)


def test_monthly_kpi(star):
    kpi = rows(m.monthly_kpi(star.fact_order_summary), "order_month")
    assert [k.month for k in kpi] == [1, 2, 4, 5]
    january = kpi[date(2017, 1, 1)]
    # o1 counts once as an order but twice in sums, as its customer has two addresses
    assert (january["orders"], january["customers"], january["revenue"], january["aov"]) == (
        1, 1, 61.2, 61.2)
    assert january["items_sold"] == 6
    may = kpi[date(2017, 5, 1)]
    assert may["customers"] == 0 and may["revenue_per_customer"] is None


def test_profile_counts_orders_once(profile):
    p = rows(profile, "customer_unique_id")
    assert p["u1"]["frequency"] == 2 and p["u1"]["monetary_cents"] == 2 * (3060 + 10000)
    assert p["u3"]["frequency"] == 2 and p["u3"]["monetary_cents"] == 5000
    assert p[None]["frequency"] == 1
    assert "u4" not in p


def brute_force_category(orders, items, reviews, category_of):
    sale = [o[0] for o in orders if o[2] in ("delivered", "shipped")]
    out = defaultdict(list)
    for order in sale:
        for i in items:
            if i[0] == order:
                hits = [r for r in reviews if r[1] == order] or [(None, None, None)]
                for r in hits:
                    out[category_of(i[2])].append((order, i[4], r[0], r[2]))
    return out


def price(text):
    try:
        return float(text)
    except ValueError:
        return None


def test_category_mart(spark, star):
    names = {"p1": "beauty", "p2": "moveis", "p3": "vazio", "p4": "uncategorised", None: None}
    expected = brute_force_category(ORDERS, ITEMS, REVIEWS, names.get)
    got = rows(MARTS["mart_category"](star), "category")
    assert set(got) == set(expected)
    for category, lines in expected.items():
        prices = [price(x[1]) for x in lines if price(x[1]) is not None]
        scores = [x[3] for x in lines if x[3] is not None]
        mart = got[category]
        assert mart["orders"] == len({x[0] for x in lines})
        assert mart["items_sold"] == len(lines)
        assert mart["revenue"] == pytest.approx(sum(prices))
        assert mart["reviews"] == len({x[2] for x in lines if x[2]})
        mean = sum(scores) / len(scores) if scores else None
        assert mart["avg_review_score"] == (pytest.approx(mean, abs=0.005) if scores else None)


def test_category_mart_with_a_hot_order(spark):
    """One order holds a third of all items and of all reviews."""
    draw = random.Random(5)
    orders = [(f"o{i}", "c1", "delivered", *ORDERS[0][3:]) for i in range(20)]
    pick = [0] * 10 + list(range(20))
    items = [(f"o{draw.choice(pick)}", 1, draw.choice(["p1", "p2", "p4"]), "s1",
              str(draw.randrange(100)), 1.0) for _ in range(200)]
    reviews = [(f"r{draw.randrange(150)}", f"o{draw.choice(pick)}", draw.randrange(1, 6),
                "2017-01-11 00:00:00", None) for _ in range(200)]
    names = {"p1": "beauty", "p2": "moveis", "p4": "uncategorised"}
    expected = brute_force_category(orders, items, reviews, names.get)
    star = star_schema(raw(spark, orders=orders, items=items, reviews=reviews))
    got = rows(MARTS["mart_category"](star), "category")
    assert set(got) == set(expected)
    for category, lines in expected.items():
        assert got[category]["items_sold"] == len(lines)
        assert got[category]["revenue"] == sum(float(x[1]) for x in lines)
        assert got[category]["reviews"] == len({x[2] for x in lines if x[2]})
        scores = [x[3] for x in lines if x[3] is not None]
        assert got[category]["avg_review_score"] == pytest.approx(
            sum(scores) / len(scores), abs=0.005001)


def test_state_mart(star):
    """Orders repeat per address, item and review."""
    homes = defaultdict(set)
    for _, person, zip_code, state in CUSTOMERS:
        homes[person].add((state.strip().upper() if state else None, zip_code))
    person_of = {c[0]: c[1] for c in CUSTOMERS}
    lines = defaultdict(list)
    for o in ORDERS:
        if o[2] not in ("delivered", "shipped"):
            continue
        person = person_of.get(o[1])
        for state, _ in homes.get(person, {(None, None)}):
            for i in (i for i in ITEMS if i[0] == o[0]):
                for r in [r for r in REVIEWS if r[1] == o[0]] or [(None, None, None)]:
                    lines[state or "UNKNOWN"].append((o[0], person, price(i[4]), r[2]))
    got = rows(MARTS["mart_state"](star), "customer_state")
    assert set(got) == set(lines)
    for state, expected in lines.items():
        assert got[state]["orders"] == len({x[0] for x in expected})
        assert got[state]["customers"] == len({x[1] for x in expected if x[1]})
        assert got[state]["revenue"] == pytest.approx(sum(x[2] for x in expected if x[2]))
        scores = [x[3] for x in expected if x[3] is not None]
        mean = sum(scores) / len(scores) if scores else None
        assert got[state]["avg_review_score"] == (pytest.approx(mean, abs=0.005) if scores else None)
    assert got["MG"]["avg_delivery_days"] is None


def test_delivery_sla(star):
    """0 and 5 and 15 days count; 214 days and no delivery do not."""
    sla = rows(MARTS["mart_delivery_sla"](star), "order_month")
    assert [k.month for k in sla] == [1, 2, 4]
    assert sla[date(2017, 4, 1)]["on_time_pct"] == 100.0
    assert sla[date(2017, 2, 1)]["on_time_orders"] == 0


def test_sla_by_state(star):
    sla = rows(MARTS["mart_sla_by_state"](star), "customer_state")
    # o1 has two reviews and u1 two addresses: two rows of o1 and one of o2 per state
    assert sla["SP"]["delivered_orders"] == sla["RJ"]["delivered_orders"] == 3
    assert sla["SP"]["avg_review_score"] == 3.33 and sla["SP"]["on_time_pct"] == 66.67
    assert sla["UNKNOWN"]["delivered_orders"] == 1 and sla["UNKNOWN"]["avg_review_score"] is None


def test_payment_mix(star):
    pay = rows(MARTS["mart_payment"](star), "payment_type")
    card = pay["credit_card"]
    assert (card["orders"], card["value"], card["avg_installments"]) == (2, 140.6, 2.0)
    assert card["pct_multi_installment"] == 0.5
    assert pay["boleto"]["orders"] == 1 and pay["boleto"]["avg_installments"] is None
    assert pay["boleto"]["pct_multi_installment"] == 0.0
    assert sum(p["pct_value"] for p in pay.values()) == pytest.approx(100, abs=0.02)


def test_repeat(profile):
    repeat = rows(m.repeat_purchase(profile), "order_bucket")
    assert repeat["1 order"]["customers"] == 2 and repeat["2 orders"]["customers"] == 2
    assert repeat["1 order"]["revenue"] == 10.0


@pytest.mark.parametrize("days, label", [
    (None, "no data"), (8, "7+ days early"), (7, "7+ days early"), (6, "3-6 days early"),
    (3, "3-6 days early"), (2, "0-2 days early"), (0, "0-2 days early"), (-1, "1-3 days late"),
    (-3, "1-3 days late"), (-4, "4+ days late"),
])
def test_delivery_buckets(spark, days, label):
    df = spark.createDataFrame([(days,)], "d int")
    assert df.select(m.delivery_bucket(df["d"])).first()[0] == label


def test_review_delay_order_puts_missing_days_last(spark):
    df = spark.createDataFrame(
        [("delivered", d, s) for d, s in [(None, 1.0), (-9, 2.0), (9, 2.5), (1, None), (0, 5.0)]],
        "order_status string, days_vs_estimate int, avg_review_score double")
    got = m.review_by_delay(df).collect()
    assert [r.delivery_bucket for r in got] == [
        "7+ days early", "0-2 days early", "4+ days late", "no data"]
    assert [r.pct_bad_reviews for r in got] == [0.0, 0.0, 100.0, 100.0]


def test_cohorts(star):
    cohort = rows(MARTS["mart_cohort"](star), "cohort_month", "month_offset")
    assert cohort[date(2017, 1, 1), 0]["cohort_size"] == 1
    assert cohort[date(2017, 1, 1), 1]["retention_pct"] == 100.0
    assert cohort[date(2017, 2, 1), 2]["active_customers"] == 1
    # the order of the unknown customer starts no cohort
    assert date(2017, 5, 1) not in {k[0] for k in cohort}


def test_pareto(profile):
    got = m.pareto(profile).orderBy("rk").collect()
    assert [r.customer_unique_id for r in got] == ["u1", "u3", "u5", None]
    assert got[-1].pct_customers == got[-1].pct_revenue == 100.0
    shares = [r.pct_revenue for r in got]
    assert shares == sorted(shares)


def test_null_spend_scores_highest_and_ranks_last(spark):
    profile = spark.createDataFrame(
        [(f"u{i}", date(2017, 1, 1 + i), 1, None if i == 0 else 100 * i) for i in range(5)],
        "customer_unique_id string, last_order_date date, frequency bigint, monetary_cents bigint",
    ).selectExpr("*", "last_order_date AS first_order_date", "frequency AS items_bought")
    scored = rows(rfm.rfm_tiered(profile), "customer_unique_id")
    assert [scored[f"u{i}"]["m_score"] for i in range(5)] == [5, 1, 2, 3, 4]
    assert scored["u4"]["r_score"] == 5 and scored["u4"]["recency_days"] == 0
    assert scored["u0"]["monetary"] is None and scored["u0"]["avg_order_value"] is None
    assert scored["u4"]["rfm_cell"] == "514"
    assert m.pareto(profile).orderBy("rk").collect()[-1].customer_unique_id == "u0"


@pytest.mark.parametrize("frequency, tier", [(1, 1), (2, 2), (3, 3), (4, 3), (5, 4), (6, 4)])
def test_frequency_tiers(spark, frequency, tier):
    df = spark.createDataFrame([(frequency,)], "f bigint")
    assert df.select(rfm.frequency_tier(df["f"])).first()[0] == tier


@pytest.mark.parametrize("r, f, spend, segment", [
    (5, 3, 1, "Champions"), (5, 4, 1, "Champions"), (5, 2, 1, "Loyal Customers"),
    (5, 1, 1, "New / Promising"), (4, 2, 1, "Loyal Customers"), (4, 1, 1, "Need Attention"),
    (3, 2, 1, "Potential Loyalists"), (3, 1, 1, "Need Attention"), (2, 2, 99, "At Risk"),
    (2, 2, 1, "Hibernating / Lost"), (2, 1, 99, "Hibernating / Lost"),
    (1, 4, 99, "Hibernating / Lost"),
])
def test_segments(spark, r, f, spend, segment):
    df = spark.createDataFrame(
        [("x", r, f, float(spend)), ("y", 1, 1, 50.0)],
        "customer_unique_id string, r_score int, f_score int, monetary double")
    assert rows(rfm.customer_segments(df), "customer_unique_id")["x"]["segment"] == segment


def test_segment_rollup_shares(spark):
    df = spark.createDataFrame(
        [("A", 10.0, 1, 5), ("A", 30.0, 3, 6), ("B", None, 1, 7)],
        "segment string, monetary double, frequency bigint, recency_days int")
    got = rows(rfm.segment_rollup(df), "segment")
    assert (got["A"]["pct_customers"], got["A"]["pct_revenue"]) == (66.67, 100.0)
    assert (got["A"]["avg_monetary"], got["A"]["avg_recency_days"]) == (20.0, 6.0)
    assert got["B"]["avg_monetary"] is None


def test_order_grain_totals_agree(spark, small):
    """With one row per order, every mart sees the same revenue."""
    from vendlens.sources.trade_tables import raw_tables

    star = star_schema(raw_tables(spark, small), "order")
    profile = rfm.customer_profile(star.fact_order_summary)
    total = m.monthly_kpi(star.fact_order_summary).selectExpr("sum(revenue)").first()[0]
    last = m.pareto(profile).selectExpr("max(cumulative_revenue)").first()[0]
    repeat = m.repeat_purchase(profile).selectExpr("sum(revenue)").first()[0]
    state = m.state_performance(star.order_rollup).selectExpr("sum(revenue)").first()[0]
    category = MARTS["mart_category"](star).selectExpr("sum(revenue)").first()[0]
    for other in (last, repeat, state, category):
        assert other == pytest.approx(total, rel=1e-12)


def test_many_small_ranges_give_the_same_marts(spark, small):
    from vendlens.session import materialise
    from vendlens.sources.trade_tables import raw_tables

    star = star_schema(raw_tables(spark, small))
    profile = materialise(rfm.customer_profile(star.fact_order_summary), "profile")
    for build in (rfm.rfm_tiered, rfm.rfm_ntile, m.pareto):
        many = build(profile).collect()
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        try:
            one = build(profile).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        assert sorted(one, key=repr) == sorted(many, key=repr)
