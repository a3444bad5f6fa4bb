"""Findings derived from the marts.

The marts hold one row per month, state, category, segment or bucket, so windows
over a whole mart are small.  The two exceptions are marked: `pareto_marks` reads
one row per customer and `late_review_test` one per order, and neither uses a
window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from vendlens.functions.columns import as_row, percent, plain_text, ratio, round_n
from vendlens.functions.statistics import pearson_t, student_p, welch_freedom, welch_t
from vendlens.operators.facts import times
from vendlens.operators.marts import DELIVERY_BUCKETS, NO_DELIVERY
from vendlens.operators.rfm import SEGMENT_ORDER

# Names of sections and fields of the findings, here and below.
WINDOW_START = "2017-01-01"
MIN_COHORT = 1000
PARETO_MARKS = (1, 5, 10, 20, 30, 50)
DAYS_PER_MONTH = 30.44
SEGMENT_COLUMNS = [
    "segment", "customers", "pct_customers", "revenue", "pct_revenue",
    "avg_monetary", "avg_frequency", "avg_recency_days",
]


def analysis_window(kpi: DataFrame, window_start: str = WINDOW_START) -> DataFrame:
    """Monthly KPIs with `partial` and `in_window` flags.

    The first and the last month are partial; growth is measured between them.
    """
    month, everything = F.col("order_month"), Window.partitionBy()
    partial = (month == F.min(month).over(everything)) | (month == F.max(month).over(everything))
    return kpi.withColumn("partial", partial).withColumn(
        "in_window", (month >= F.lit(window_start).cast("date")) & ~F.col("partial")
    )


def month_on_month(kpi: DataFrame, window_start: str = WINDOW_START) -> DataFrame:
    """Revenue growth in percent over the month before, inside the window only."""
    flagged = analysis_window(kpi, window_start)
    by_month = Window.partitionBy("in_window").orderBy("order_month")
    before = F.lag("revenue").over(by_month)
    growth = (ratio(F.col("revenue"), before) - 1.0) * 100.0
    return flagged.withColumn("rev_mom_pct", F.when(F.col("in_window"), growth))


def _month_of(extreme: Column) -> Column:
    """The month of an extreme, as text."""
    return extreme.getField("order_month").cast("string")


def trend_summary(kpi: DataFrame, window_start: str = WINDOW_START) -> DataFrame:
    """Growth over the analysis window, peak, best and worst month."""
    month = F.col("order_month")
    # Counting days down makes the earliest month win a tie for the maximum.
    earlier = (-F.unix_date(month)).alias("earlier")

    def highest(c: str) -> Column:
        return F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(c), earlier, month)))

    def lowest(c: str) -> Column:
        return F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(c), month)))

    totals = (
        month_on_month(kpi, window_start)
        .where("in_window")
        .agg(
            F.min(F.struct(month, "revenue")).alias("first"),
            F.max(F.struct(month, "revenue")).alias("last"),
            F.count(F.lit(1)).alias("months"),
            highest("revenue").alias("peak"),
            highest("rev_mom_pct").alias("best"),
            lowest("rev_mom_pct").alias("worst"),
        )
    )
    growth = ratio(F.col("last.revenue"), F.col("first.revenue"))
    years = F.lit(12.0) / F.greatest(F.col("months") - 1, F.lit(1))
    return totals.select(
        F.col("first.order_month").cast("string").alias("window_start"),
        F.col("last.order_month").cast("string").alias("window_end"),
        F.col("months").alias("months_in_window"),
        _month_of(F.col("peak")).alias("peak_month"),
        round_n(F.col("peak.revenue"), 2).alias("peak_revenue_brl"),
        round_n(F.col("first.revenue"), 2).alias("first_month_revenue_brl"),
        round_n(F.col("last.revenue"), 2).alias("last_month_revenue_brl"),
        round_n((growth - 1.0) * 100.0, 1).alias("window_growth_pct"),
        round_n((F.pow(growth, years) - 1.0) * 100.0, 1).alias("annualised_growth_pct"),
        round_n(F.col("best.rev_mom_pct"), 1).alias("best_mom_pct"),
        _month_of(F.col("best")).alias("best_mom_month"),
        round_n(F.col("worst.rev_mom_pct"), 1).alias("worst_mom_pct"),
        _month_of(F.col("worst")).alias("worst_mom_month"),
    )


def cohort_matrix(
    cohort: DataFrame, max_offset: int = 12, mature_only: bool = True
) -> DataFrame:
    """Retention as a matrix, cohort by month offset, columns m0, m1, ....

    `mature_only` keeps cohorts at least a month older than the newest one.
    """
    offsets = range(max_offset + 1)
    matrix = cohort.groupBy("cohort_month").agg(
        F.max("cohort_size").alias("cohort_size"),
        *[
            F.max(F.when(F.col("month_offset") == o, F.col("retention_pct"))).alias(f"m{o}")
            for o in offsets
        ],
    )
    if mature_only:
        # One row per cohort by now.
        newest = F.max("cohort_month").over(Window.partitionBy())
        age = F.datediff(newest, "cohort_month") / F.lit(DAYS_PER_MONTH)
        matrix = matrix.withColumn("age", age).where("age >= 1").drop("age")
    return matrix.orderBy("cohort_month")


def cohort_summary(cohort: DataFrame, min_cohort: int = MIN_COHORT) -> DataFrame:
    """First-month retention of cohorts above a size: median, best, worst (E5)."""
    shown = (F.col("month_offset") == 1) & (F.col("cohort_size") > min_cohort)
    kept = F.when(shown, F.col("retention_pct"))
    return cohort.agg(
        round_n(F.median(kept), 2).alias("median_m1_retention_pct"),
        round_n(F.max(kept), 2).alias("best_m1_retention_pct"),
        round_n(F.min(kept), 2).alias("worst_m1_retention_pct"),
        F.max("month_offset").alias("max_observed_offset"),
    )


def segment_position() -> Column:
    """Position of a segment in the fixed listing order."""
    return F.array_position(F.array(*[F.lit(s) for s in SEGMENT_ORDER]), F.col("segment"))


def segments_in_order(segments: DataFrame) -> DataFrame:
    return segments.select(*SEGMENT_COLUMNS).orderBy(segment_position())


def segment_summary(segments: DataFrame) -> DataFrame:
    """Top segment by revenue and what the at-risk segments hold."""
    by_revenue = F.struct("revenue", -segment_position())

    def top(c: str) -> Column:
        return F.max_by(c, by_revenue)

    def total(name: str, c: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("segment") == name, F.col(c))), F.lit(0))

    return segments.agg(
        top("segment").alias("top_segment"),
        top("customers").alias("top_segment_customers"),
        top("pct_customers").alias("top_segment_pct_customers"),
        top("pct_revenue").alias("top_segment_pct_revenue"),
        total("At Risk", "customers").alias("at_risk_customers"),
        round_n(total("At Risk", "revenue"), 2).alias("at_risk_revenue_brl"),
        round_n(total("Cant Lose Them", "revenue"), 2).alias("cant_lose_revenue_brl"),
    )


def _text(df: DataFrame, column: str) -> Column:
    is_double = isinstance(df.schema[column].dataType, T.DoubleType)
    return plain_text(F.col(column)) if is_double else F.col(column).cast("string")


def segment_table(segments: DataFrame) -> DataFrame:
    """All segments, in listing order, as one row holding an array of text records."""
    record = F.struct(*[_text(segments, c).alias(c) for c in SEGMENT_COLUMNS])
    placed = F.struct(segment_position().alias("position"), record.alias("record"))
    return segments.agg(
        F.transform(F.sort_array(F.collect_list(placed)), lambda s: s["record"])
        .alias("segments_table")
    )


def pareto_marks(
    pareto: DataFrame, marks: tuple[int, ...] = PARETO_MARKS, truncate: bool = False
) -> DataFrame:
    """Revenue share of the top 1, 5, 10 ... percent of customers.

    The customer counts are rounded half to even, or truncated.  The ranks wanted
    are a handful, so the customer-level table is only filtered.
    """
    total = pareto.agg(F.count(F.lit(1)).alias("n")).scalar()
    wanted = pareto.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(m) for m in marks])).alias("pct"), total.alias("n")
    )
    # n * pct / 100, in this order, as rounding at .5 depends on it.
    count = F.col("n") * F.col("pct") / F.lit(100.0)
    count = F.floor(count) if truncate else F.bround(count).cast("bigint")
    at = wanted.select(
        "pct", F.greatest(F.lit(1), F.least(count, F.col("n"))).alias("rk")
    )
    return (
        pareto.select("rk", "pct_revenue")
        .join(F.broadcast(at), "rk")
        .select("pct", round_n(F.col("pct_revenue"), 2).alias("pct_revenue"))
        .orderBy("pct")
    )


def repeat_summary(repeat: DataFrame) -> DataFrame:
    """Share of one-time and of repeat customers."""
    once = F.max(F.when(F.col("order_bucket") == "1 order", F.col("pct_customers")))
    return repeat.agg(once.alias("one_time_customer_pct")).select(
        "one_time_customer_pct",
        round_n(100.0 - F.col("one_time_customer_pct"), 2).alias("repeat_customer_pct"),
    )


def _with_position(mart: DataFrame, label: str) -> DataFrame:
    by_revenue = Window.partitionBy().orderBy(F.desc("revenue"), F.asc_nulls_last(label))
    return mart.withColumn("position", F.row_number().over(by_revenue))


def category_summary(category: DataFrame) -> DataFrame:
    """Top category, the share of the top three, and how many there are."""
    first, head = F.col("position") == 1, F.col("position") <= 3
    return _with_position(category, "category").agg(
        F.max(F.when(first, F.col("category"))).alias("top_category"),
        F.max(F.when(first, F.col("pct_revenue"))).alias("top_category_pct_revenue"),
        round_n(F.sum(F.when(head, F.col("pct_revenue"))), 2).alias("top3_pct_revenue"),
        F.count(F.lit(1)).alias("categories_total"),
    )


def state_summary(state: DataFrame) -> DataFrame:
    """Top state, the share of the top three, and the slowest state."""
    first, head = F.col("position") == 1, F.col("position") <= 3
    slowest = F.min(F.when(
        F.col("avg_delivery_days").isNotNull(),
        F.struct((-F.col("avg_delivery_days")).alias("days"), F.col("customer_state")),
    ))
    return (
        _with_position(state, "customer_state")
        .agg(
            F.max(F.when(first, F.col("customer_state"))).alias("top_state"),
            round_n(F.sum(F.when(head, F.col("pct_revenue"))), 2)
            .alias("top3_states_pct_revenue"),
            slowest.alias("slowest"),
        )
        .select(
            "top_state",
            "top3_states_pct_revenue",
            F.col("slowest.customer_state").alias("slowest_state"),
            (-F.col("slowest.days")).alias("slowest_state_days"),
        )
    )


def delivery_review_correlation(state: DataFrame) -> DataFrame:
    """Pearson r of delivery days and review score over the states, without p.

    NaN where all states have the same days or the same score, as large tables may: the means
    are rounded.  Spark's own `corr` raises there.
    """
    days, score = F.col("avg_delivery_days"), F.col("avg_review_score")
    both = days.isNotNull() & score.isNotNull()
    spread = F.sqrt(F.var_pop(F.when(both, days)) * F.var_pop(F.when(both, score)))
    r = F.coalesce(F.try_divide(F.covar_pop(days, score), spread), F.lit(float("nan")))
    return state.agg(
        F.when(F.count_if(both) > 1, r).alias("r"),
        F.count_if(both).alias("n"),
    )


def delivery_review_test(state: DataFrame) -> DataFrame:
    """Pearson r with its two-sided p-value."""
    r, n = F.col("r"), F.col("n")
    return delivery_review_correlation(state).select(
        round_n(r, 3).alias("delivery_vs_review_r"),
        round_n(student_p(pearson_t(r, n), n.cast("double") - 2.0), 4)
        .alias("delivery_vs_review_p"),
    )


def payment_summary(payment: DataFrame) -> DataFrame:
    """Credit cards: share of value and average instalments."""

    def card(c: str) -> Column:
        return F.max(F.when(F.col("payment_type") == "credit_card", F.col(c)))

    return payment.agg(
        card("pct_value").alias("card_pct_value"),
        card("avg_installments").alias("card_avg_installments"),
    )


def _late_review_moments(summary: DataFrame) -> DataFrame:
    """Count, mean and variance of review scores, late and on time, in one pass.

    A row counts as often as its address rows say.  Scores are taken from the middle of their
    scale, so that the difference of sums loses no digits that matter.
    """
    late, score = F.col("days_vs_estimate") < 0, F.col("avg_review_score")
    middle = F.lit(3.0)

    def moments(which: Column, name: str) -> list[Column]:
        rows, off = F.when(which, times(summary)), score - middle
        n = F.coalesce(F.sum(rows), F.lit(0)).cast("double")
        total, squares = F.sum(off * rows), F.sum(off * off * rows)
        return [
            n.alias(f"{name}_n"),
            (ratio(total, n) + middle).alias(f"{name}_mean"),
            ratio(squares - ratio(total * total, n), n - 1.0).alias(f"{name}_var"),
        ]

    return summary.where(F.col("days_vs_estimate").isNotNull() & score.isNotNull()).agg(
        *moments(late, "late"), *moments(~late, "ontime")
    )


def late_review_test(summary: DataFrame, with_p: bool = True) -> DataFrame:
    """Welch's t-test: do late orders get worse reviews?

    Any order with a delivery and a review counts, whatever its status.
    """
    late_n, late_mean, late_var, n, mean, var = (
        F.col(c) for c in
        ("late_n", "late_mean", "late_var", "ontime_n", "ontime_mean", "ontime_var")
    )
    t = welch_t(late_n, late_mean, late_var, n, mean, var)
    freedom = welch_freedom(late_n, late_var, n, var)
    result = _late_review_moments(summary).select(
        late_n.cast("bigint").alias("late_orders"),
        percent(late_n, late_n + n).alias("late_pct_of_delivered"),
        round_n(late_mean, 3).alias("late_avg_review"),
        round_n(mean, 3).alias("ontime_avg_review"),
        t.alias("t"),
        freedom.alias("freedom"),
    )
    shown = ["late_orders", "late_pct_of_delivered", "late_avg_review", "ontime_avg_review"]
    extra = [round_n(F.col("t"), 2).alias("welch_t")]
    if with_p:
        p = student_p(F.col("t"), F.col("freedom"))
        # Four significant digits.
        shortened = F.when(p.isNotNull(), F.format_string("%.3e", p))
        extra.append(shortened.cast("double").alias("welch_p"))
    return result.select(*shown, *extra)


def sla_summary(
    sla: DataFrame, review_delay: DataFrame, window_start: str = WINDOW_START
) -> DataFrame:
    """Average on-time share and delivery days, and bad-review rates of two buckets."""
    bucket, bad = F.col("delivery_bucket"), F.col("pct_bad_reviews")
    on_time, late = DELIVERY_BUCKETS[2], DELIVERY_BUCKETS[4]
    monthly = sla.where(F.col("order_month") >= F.lit(window_start).cast("date")).agg(
        round_n(F.avg("on_time_pct"), 2).alias("avg_on_time_pct"),
        round_n(F.avg("avg_delivery_days"), 2).alias("avg_delivery_days"),
    )
    rates = review_delay.where(bucket != NO_DELIVERY).agg(
        F.max(F.when(bucket == on_time, bad)).alias("bad_review_rate_ontime_pct"),
        F.max(F.when(bucket == late, bad)).alias("bad_review_rate_late_pct"),
    )
    one_row = sla.sparkSession.range(1)
    return one_row.select(as_row(monthly).alias("m"), as_row(rates).alias("b")).select(
        "m.avg_on_time_pct", "b.*", "m.avg_delivery_days"
    )


def findings_document(
    marts: dict[str, DataFrame],
    summary: DataFrame,
    window_start: str = WINDOW_START,
    min_cohort: int = MIN_COHORT,
) -> DataFrame:
    """All findings as one row with one struct per section.

    `marts` and `summary` should be stored tables: several sections read them.
    """

    def merged(*parts: DataFrame) -> Column:
        """One struct with the fields of several one-row results."""
        columns = [(as_row(p), p.columns) for p in parts]
        return F.struct(*[row.getField(c).alias(c) for row, names in columns for c in names])

    marks = pareto_marks(marts["mart_pareto"]).agg(
        F.map_from_entries(F.sort_array(F.collect_list(
            F.struct(F.col("pct"), F.col("pct_revenue"))
        ))).alias("concentration")
    )
    state, category = marts["mart_state"], marts["mart_category"]
    segments = marts["mart_rfm_segments"]
    sections = {
        "trend": [trend_summary(marts["mart_monthly_kpi"], window_start)],
        "cohort": [cohort_summary(marts["mart_cohort"], min_cohort)],
        "rfm": [segment_summary(segments), segment_table(segments)],
        "pareto": [marks, repeat_summary(marts["mart_repeat"])],
        "category": [category_summary(category)],
        "state": [state_summary(state), delivery_review_test(state)],
        "payment": [payment_summary(marts["mart_payment"])],
        "sla": [
            sla_summary(marts["mart_delivery_sla"], marts["mart_review_delay"], window_start),
            late_review_test(summary),
        ],
    }
    return summary.sparkSession.range(1).select(
        *[merged(*parts).alias(name) for name, parts in sections.items()]
    )
