import math

import pytest
from pyspark.sql import functions as F

from vendlens.functions.statistics import pearson_t, student_p, welch_freedom, welch_t


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


# Closed forms: 1, 2 and 4 degrees of freedom.
def exact(t, v):
    if v == 1:
        return 1 - 2 * math.atan(t) / math.pi
    if v == 2:
        return 1 - t / math.sqrt(2 + t * t)
    x = t / math.sqrt(4 + t * t)
    return 1 - 1.5 * (x - x**3 / 3)


@pytest.mark.parametrize("v", [1, 2, 4])
@pytest.mark.parametrize("t", [0.0, 0.3, 1.0, 2.776445105197799, 10.0])
def test_student_tail_against_closed_forms(spark, t, v):
    p = value(spark, student_p(F.lit(t), F.lit(float(v))))
    assert p == pytest.approx(exact(t, v), rel=1e-6, abs=1e-12)


def test_many_degrees_are_normal(spark):
    p = value(spark, student_p(F.lit(1.959963984540054), F.lit(1e9)))
    assert p == pytest.approx(0.05, rel=1e-6)
    far = value(spark, student_p(F.lit(10.0), F.lit(1e9)))
    assert far == pytest.approx(math.erfc(10 / math.sqrt(2)), rel=1e-4)


def test_published_values(spark):
    # r = -0.41 over 27 pairs; t = -101.04 with thousands of degrees
    r = F.lit(-0.41)
    p = value(spark, student_p(pearson_t(r, F.lit(27.0)), F.lit(25.0)))
    assert p == pytest.approx(0.0336, abs=5e-4)
    assert value(spark, student_p(F.lit(-101.04), F.lit(6900.0))) == 0.0


def test_edges(spark):
    assert value(spark, student_p(F.lit(0.0), F.lit(5.0))) == 1.0
    assert value(spark, student_p(pearson_t(F.lit(1.0), F.lit(5.0)), F.lit(3.0))) == 0.0
    assert value(spark, student_p(F.lit(None).cast("double"), F.lit(5.0))) is None
    assert value(spark, student_p(F.lit(1.0), F.lit(0.0))) is None


def test_welch(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0, 8.0, 10.0]
    m = [F.lit(float(x)) for x in (len(a), 2.5, 5 / 3, len(b), 6.0, 10.0)]
    assert value(spark, welch_t(*m)) == pytest.approx(-3.5 / math.sqrt(5 / 12 + 2))
    freedom = (5 / 12 + 2) ** 2 / ((5 / 12) ** 2 / 3 + 4 / 4)
    assert value(spark, welch_freedom(m[0], m[2], m[3], m[5])) == pytest.approx(freedom)
