"""Significance of a few already aggregated numbers, as column expressions.

The heavy part (counts, means, variances, correlation) is aggregated by Spark.
The tail probability of Student's t is then worked out on the one row left.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 2000
# exp(-40) is below the resolution of a double next to 1.
NEGLIGIBLE = 40.0


def _integral(log_density, start: Column, width: Column) -> Column:
    """Simpson's rule for exp(log_density) over [start, start + width]."""
    step = width / F.lit(float(STEPS))

    def weight(i: Column) -> Column:
        inner = F.when(i % 2 == 1, 4.0).otherwise(2.0)
        return F.when((i == 0) | (i == STEPS), 1.0).otherwise(inner)

    total = F.aggregate(
        F.sequence(F.lit(0), F.lit(STEPS)),
        F.lit(0.0),
        lambda acc, i: acc + weight(i) * F.exp(log_density(start + i * step)),
    )
    return total * step / F.lit(3.0)


def student_p(t: Column, freedom: Column) -> Column:
    """P(|T| >= |t|) for Student's t with `freedom` >= 1 degrees of freedom.

    With t = sqrt(freedom) * tan(angle) the density is proportional to
    cos(angle) ** (freedom - 1) for angles from 0 to a right angle.  The
    probability is the share of the area beyond the angle of |t|, so no gamma
    function is needed.  Angles are scaled by sqrt(freedom), which keeps the bulk of
    the area within a few units for any number of degrees.
    """
    scale = F.sqrt(freedom)
    end = scale * F.lit(math.pi / 2)

    def log_density(u: Column) -> Column:
        return (freedom - 1.0) * F.log(F.greatest(F.cos(u / scale), F.lit(1e-300)))

    start = F.atan(F.abs(t) / scale) * scale
    # The log density is concave: past `start` it falls at least at this rate.
    fall = F.greatest(F.lit(1.0), F.abs(t) * (freedom - 1.0) / freedom)
    tail = _integral(log_density, start, F.least(end - start, F.lit(NEGLIGIBLE) / fall))
    whole = _integral(log_density, F.lit(0.0), F.least(end, F.lit(NEGLIGIBLE)))
    # `least` takes NaN for the largest number.
    share = F.when(F.isnan(t), t).otherwise(F.least(F.lit(1.0), tail / whole))
    return F.when(t.isNotNull() & (freedom >= 1.0), share)


def welch_t(n1: Column, m1: Column, v1: Column, n2: Column, m2: Column, v2: Column) -> Column:
    """Welch's t from counts, means and sample variances."""
    return F.try_divide(m1 - m2, F.sqrt(F.try_divide(v1, n1) + F.try_divide(v2, n2)))


def welch_freedom(n1: Column, v1: Column, n2: Column, v2: Column) -> Column:
    """Welch-Satterthwaite degrees of freedom."""
    a, b = F.try_divide(v1, n1), F.try_divide(v2, n2)
    return F.try_divide(
        F.pow(a + b, F.lit(2.0)),
        F.try_divide(a * a, n1 - 1.0) + F.try_divide(b * b, n2 - 1.0),
    )


def pearson_t(r: Column, n: Column) -> Column:
    """t of a Pearson correlation over n pairs; infinite for a perfect one, NaN for NaN."""
    # NaN compares as the largest number.
    return F.when(F.isnan(r), r).when(F.abs(r) >= 1.0, F.lit(float("inf"))).otherwise(
        r * F.sqrt(F.try_divide(n - 2.0, 1.0 - r * r))
    )
