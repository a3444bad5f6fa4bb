"""Findings against published results: the inputs below are the published marts' numbers."""

import math
from datetime import date

import pytest

from vendlens.operators import datasets, findings

# Monthly revenue from September 2016 on (November 2016 has no orders).
REVENUE = [
    ("2016-09-01", 207.86), ("2016-10-01", 41415.34), ("2016-12-01", 10.90),
    ("2017-01-01", 114856.38), ("2017-02-01", 238807.34), ("2017-03-01", 364362.46),
    ("2017-04-01", 347323.47), ("2017-05-01", 503271.02), ("2017-06-01", 428337.45),
    ("2017-07-01", 491819.84), ("2017-08-01", 565060.84), ("2017-09-01", 617862.79),
    ("2017-10-01", 659316.35), ("2017-11-01", 1001140.47), ("2017-12-01", 737055.74),
    ("2018-01-01", 940305.92), ("2018-02-01", 840969.68), ("2018-03-01", 975585.36),
    ("2018-04-01", 995245.01), ("2018-05-01", 988884.05), ("2018-06-01", 864886.11),
    ("2018-07-01", 878540.48), ("2018-08-01", 848124.28), ("2018-09-01", 145.00),
]

# State, revenue, share of revenue, delivery days, review score.
STATES = [
    ("SP", 5168899.08, 38.27, 8.7, 4.16), ("RJ", 1818948.87, 13.47, 15.1, 3.83),
    ("MG", 1572441.83, 11.64, 11.9, 4.11), ("RS", 742061.42, 5.49, 15.2, 4.08),
    ("PR", 677378.00, 5.02, 11.9, 4.13), ("SC", 516145.39, 3.82, 14.9, 4.03),
    ("BA", 505743.04, 3.74, 19.2, 3.83), ("DF", 303334.15, 2.25, 12.9, 4.03),
    ("GO", 290827.20, 2.15, 15.3, 4.02), ("ES", 273457.60, 2.02, 15.6, 4.01),
    ("PE", 259512.51, 1.92, 18.2, 3.98), ("CE", 225780.77, 1.67, 20.9, 3.82),
    ("PA", 178179.81, 1.32, 23.7, 3.81), ("MT", 154633.23, 1.15, 17.9, 3.98),
    ("MA", 119822.39, 0.89, 21.5, 3.73), ("MS", 117296.92, 0.87, 15.5, 4.07),
    ("PB", 114836.28, 0.85, 20.5, 4.01), ("PI", 85558.86, 0.63, 19.3, 3.95),
    ("RN", 83361.79, 0.62, 19.3, 4.07), ("AL", 81633.03, 0.60, 24.4, 3.77),
    ("SE", 60152.74, 0.45, 21.3, 3.85), ("TO", 49328.99, 0.37, 17.4, 4.13),
    ("RO", 45801.66, 0.34, 19.6, 4.07), ("AM", 22545.54, 0.17, 26.1, 4.08),
    ("AC", 15982.95, 0.12, 20.7, 4.10), ("AP", 13374.81, 0.10, 28.2, 4.26),
    ("RR", 7739.44, 0.06, 28.2, 3.61),
]


@pytest.fixture(scope="module")
def kpi(spark):
    return spark.createDataFrame(
        [(date.fromisoformat(d), 1, r, 1.0) for d, r in REVENUE],
        "order_month date, orders bigint, revenue double, aov double",
    ).repartition(3)


@pytest.fixture(scope="module")
def states(spark):
    return spark.createDataFrame(
        STATES, """customer_state string, revenue double, pct_revenue double,
        avg_delivery_days double, avg_review_score double""")


def test_trend(kpi):
    t = findings.trend_summary(kpi).first()
    assert (t.window_start, t.window_end, t.months_in_window) == ("2017-01-01", "2018-08-01", 20)
    assert (t.peak_month, t.peak_revenue_brl) == ("2017-11-01", 1001140.47)
    assert (t.window_growth_pct, t.annualised_growth_pct) == (638.4, 253.5)
    assert (t.best_mom_pct, t.best_mom_month) == (107.9, "2017-02-01")
    assert (t.worst_mom_pct, t.worst_mom_month) == (-26.4, "2017-12-01")


def test_window_flags(kpi):
    flags = {r.order_month: (r.partial, r.in_window)
             for r in findings.analysis_window(kpi).collect()}
    assert flags[date(2016, 9, 1)] == flags[date(2018, 9, 1)] == (True, False)
    assert flags[date(2016, 12, 1)] == (False, False)
    assert flags[date(2017, 1, 1)] == (False, True)


def test_growth_starts_inside_the_window(kpi):
    mom = {r.order_month: r.rev_mom_pct for r in findings.month_on_month(kpi).collect()}
    assert mom[date(2017, 1, 1)] is None and mom[date(2018, 9, 1)] is None
    assert mom[date(2017, 2, 1)] == pytest.approx(107.9, abs=0.05)


def test_trend_ties_go_to_the_earliest_month(spark):
    df = spark.createDataFrame(
        [(date(2017, k, 1), r) for k, r in enumerate([1.0, 4.0, 2.0, 4.0, 2.0, 9.0], 1)],
        "order_month date, revenue double")
    t = findings.trend_summary(df, "2016-01-01").first()
    assert t.peak_month == "2017-02-01" and t.worst_mom_month == "2017-03-01"


def test_states(states):
    s = findings.state_summary(states).first()
    assert (s.top_state, s.top3_states_pct_revenue, s.slowest_state_days) == ("SP", 63.38, 28.2)
    assert s.slowest_state == "AP"  # AP and RR tie; the first name wins
    r = findings.delivery_review_test(states).first()
    assert (r.delivery_vs_review_r, r.delivery_vs_review_p) == (-0.41, 0.0336)


def test_categories(spark):
    df = spark.createDataFrame(
        [("health_beauty", 1250598.52, 9.31), ("watches_gifts", 1190114.72, 8.86),
         ("bed_bath_table", 1048116.04, 7.80), ("sports_leisure", 972036.41, 7.24)],
        "category string, revenue double, pct_revenue double").repartition(4)
    c = findings.category_summary(df).first()
    assert tuple(c) == ("health_beauty", 9.31, 25.97, 4)


def test_repeat_and_payment(spark):
    repeat = spark.createDataFrame(
        [("1 order", 96.97), ("2 orders", 2.78)], "order_bucket string, pct_customers double")
    assert tuple(findings.repeat_summary(repeat).first()) == (96.97, 3.03)
    pay = spark.createDataFrame(
        [("credit_card", 78.51, 3.5), ("boleto", 17.91, 1.0)],
        "payment_type string, pct_value double, avg_installments double")
    assert tuple(findings.payment_summary(pay).first()) == (78.51, 3.5)


def cohorts(spark):
    data = [("2017-01-01", 2000, 0, 100.0), ("2017-01-01", 2000, 1, 0.4),
            ("2017-01-01", 2000, 14, 0.3), ("2017-02-01", 3000, 0, 100.0),
            ("2017-02-01", 3000, 1, 0.6), ("2017-03-01", 10, 0, 100.0),
            ("2017-03-01", 10, 1, 50.0), ("2017-04-01", 5000, 0, 100.0)]
    return spark.createDataFrame(
        [(date.fromisoformat(d), n, o, r) for d, n, o, r in data],
        "cohort_month date, cohort_size bigint, month_offset int, retention_pct double")


def test_cohort_summary_and_matrix(spark):
    df = cohorts(spark)
    assert tuple(findings.cohort_summary(df).first()) == (0.5, 0.6, 0.4, 14)
    shown = findings.cohort_matrix(df).collect()
    # 2017-03-01 is 31 days older than the newest cohort, that is 1.02 months
    assert [r.cohort_month.month for r in shown] == [1, 2, 3]
    assert shown[0].m1 == 0.4 and shown[0].m2 is None and "m14" not in shown[0].asDict()
    everything = findings.cohort_matrix(df, 24, mature_only=False).collect()
    assert len(everything) == 4 and everything[0].m14 == 0.3


def test_segment_summary(spark):
    data = [("Champions", 62, 0.07, 34779.13, 0.26), ("At Risk", 356, 0.38, 138591.51, 1.03),
            ("Hibernating / Lost", 37404, 39.62, 5258322.69, 39.11)]
    df = spark.createDataFrame(
        [(*d, 1.0, 1.0, 1.0) for d in data],
        """segment string, customers bigint, pct_customers double, revenue double,
        pct_revenue double, avg_monetary double, avg_frequency double,
        avg_recency_days double""").repartition(3)
    assert tuple(findings.segment_summary(df).first()) == (
        "Hibernating / Lost", 37404, 39.62, 39.11, 356, 138591.51, 0.0)
    assert [r.segment for r in findings.segments_in_order(df).collect()] == [
        "Champions", "At Risk", "Hibernating / Lost"]
    table = findings.segment_table(df).first()[0]
    assert [r.segment for r in table] == ["Champions", "At Risk", "Hibernating / Lost"]
    assert table[0].customers == "62" and table[0].avg_monetary == "1.0"


@pytest.mark.parametrize("n, truncate, expected", [
    # 250 customers: 1 % is 2.5, rounded half to even; 350: 3.5
    (250, False, {1: 2.0, 5: 12.0, 10: 25.0}), (350, False, {1: 4.0, 5: 18.0, 10: 35.0}),
    (350, True, {1: 3.0, 5: 17.0, 10: 35.0}), (3, False, {1: 1.0, 5: 1.0, 10: 1.0}),
])
def test_pareto_marks(spark, n, truncate, expected):
    pareto = spark.range(1, n + 1).selectExpr(
        "CAST(id AS INT) AS rk", "CAST(id AS DOUBLE) AS pct_revenue")
    got = findings.pareto_marks(pareto, (1, 5, 10), truncate).collect()
    assert {r.pct: r.pct_revenue for r in got} == expected


def test_late_review_test(spark):
    """5 late and 6 punctual orders; p by integrating Student's density."""
    late, punctual = [1.0, 2.0, 2.0, 1.0, 3.0], [5.0, 4.0, 4.0, 3.0, 5.0, 5.0]
    data = [(-1, x) for x in late] + [(0, x) for x in punctual] + [(None, 1.0), (3, None)]
    df = spark.createDataFrame(data, "days_vs_estimate int, avg_review_score double")
    got = findings.late_review_test(df).first()
    assert (got.late_orders, got.late_pct_of_delivered) == (5, 45.45)
    assert (got.late_avg_review, got.ontime_avg_review) == (1.8, 4.333)
    a, b = 0.7 / 5, (10 / 3 / 5) / 6
    t, v = (1.8 - 13 / 3) / math.sqrt(a + b), (a + b) ** 2 / (a * a / 4 + b * b / 5)
    assert got.welch_t == round(t, 2)
    scale = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi)
    step = -t / 20_000
    area = sum(scale * (1 + ((i + 0.5) * step) ** 2 / v) ** (-(v + 1) / 2) * step
               for i in range(20_000))
    assert got.welch_p == pytest.approx(1 - 2 * area, rel=1e-3)


def test_late_review_test_without_late_orders(spark):
    df = spark.createDataFrame(
        [(1, 4.0), (2, 5.0)], "days_vs_estimate int, avg_review_score double")
    got = findings.late_review_test(df).first()
    assert (got.late_orders, got.welch_t, got.welch_p) == (0, None, None)


def test_sla_summary(spark):
    sla = spark.createDataFrame(
        [(date(2016, 12, 1), 0.0, 99.0), (date(2017, 1, 1), 90.0, 10.0),
         (date(2017, 2, 1), 95.0, 11.0)],
        "order_month date, on_time_pct double, avg_delivery_days double")
    delay = spark.createDataFrame(
        [("0-2 days early", 11.63), ("4+ days late", 74.58), ("no data", 12.5)],
        "delivery_bucket string, pct_bad_reviews double")
    assert tuple(findings.sla_summary(sla, delay).first()) == (92.5, 11.63, 74.58, 10.5)


def test_top_lists_and_bars(spark, states):
    assert [r.customer_state for r in datasets.top_states(states, 3).collect()] == ["SP", "RJ", "MG"]
    delay = spark.createDataFrame(
        [("4+ days late", 1.0, 2.0), ("no data", 1.0, 2.0), ("7+ days early", 1.0, 2.0)],
        "delivery_bucket string, avg_review_score double, pct_bad_reviews double")
    assert [r.delivery_bucket for r in datasets.delay_bars(delay).collect()] == [
        "7+ days early", "4+ days late"]


def test_window_summary(kpi):
    w = datasets.window_summary(kpi).first()
    assert (w.growth_pct, w.peak_month) == (638.0, "Nov-2017")


def test_customer_search_ignores_case(spark):
    rfm = spark.createDataFrame([("ABc1",), ("xabC",), ("zzz",)], "customer_unique_id string")
    assert [r[0] for r in datasets.find_customers(rfm, "abc").collect()] == ["ABc1", "xabC"]
    assert len(datasets.find_customers(rfm, ".", 2).collect()) == 2


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(1000).selectExpr(
        "id AS rk", "id AS customer_unique_id", "0D AS pct_customers", "0D AS pct_revenue")
    one = {r.rk for r in datasets.pareto_sample(df, 100).collect()}
    other = {r.rk for r in datasets.pareto_sample(df.repartition(13), 100).collect()}
    assert one == other and len(one) == 100
    assert one != {r.rk for r in datasets.pareto_sample(df, 100, seed=8).collect()}
