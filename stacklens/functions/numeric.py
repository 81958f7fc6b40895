"""Small numeric expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_zero(numerator: Column, denominator: Column, digits: int) -> Column:
    """``round(n / d, digits)``, and 0 where the denominator is 0 or missing."""
    return F.coalesce(F.round(F.when(denominator != 0, numerator / denominator), digits), F.lit(0.0))


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(value, F.lit(high)), F.lit(low))


def steady_sum(value: Column) -> Column:
    """Sum of doubles with the order-dependent last bits rounded away."""
    return F.round(F.sum(value), 6)


def steady_round(value: Column, digits: int) -> Column:
    """Round a result of floating-point sums so that its order-dependent last bits cannot flip a digit."""
    return F.round(F.round(value, 9), digits)


def rank_score(value: Column) -> Column:
    """Score as used for ordering: equal scores must tie whatever the summation order."""
    return F.round(value, 9)


def first_max_label(counts: list[Column], labels: list) -> Column:
    """Label of the largest count; the first such label on ties."""
    values = F.array(*counts)
    return F.element_at(F.array(*[F.lit(label) for label in labels]),
                        F.array_position(values, F.array_max(values)).cast("int"))


def log_gamma(a: Column) -> Column:
    """ln Γ(a) for a > 0: Stirling's series at a + 20, brought back by the recurrence."""
    z = a + F.lit(20.0)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    shifted = (z - 0.5) * F.ln(z) - z + F.lit(0.9189385332046727) + series  # ln √(2π)
    back = F.aggregate(F.sequence(F.lit(0), F.lit(19)), F.lit(0.0), lambda s, i: s + F.ln(a + i))
    return shifted - back


def chi2_upper_tail(statistic: Column, dof: Column) -> Column:
    """P(X >= statistic) for a chi-squared variable with ``dof`` >= 1.

    With a = dof / 2 and x = statistic / 2: below a + 1 one minus the power series of the lower
    incomplete gamma function, above it the continued fraction of the upper one. The common
    factor is formed from logarithms, so many degrees of freedom neither overflow nor
    vanish before they should; the steps grow with the root of a, where both need most.
    """
    a = dof / F.lit(2.0)
    x = statistic / F.lit(2.0)
    front = F.exp(a * F.ln(x) - x - log_gamma(a))
    steps = F.sequence(F.lit(1), (F.lit(200) + F.ceil(F.lit(20.0) * F.sqrt(a))).cast("int"))
    series = F.aggregate(
        steps, F.struct((1 / a).alias("term"), (1 / a).alias("total")),
        lambda s, i: F.struct((s["term"] * x / (a + i)).alias("term"), (s["total"] + s["term"] * x / (a + i)).alias("total")),
        lambda s: s["total"])
    tiny = F.lit(1e-300)
    safe = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)

    def step(s: Column, i: Column) -> Column:
        b, factor = x + 2 * i + 1 - a, -i * (i - a)
        d, c = 1 / safe(factor * s["d"] + b), safe(b + factor / s["c"])
        return F.struct(d.alias("d"), c.alias("c"), (s["h"] * d * c).alias("h"))

    first = 1 / safe(x + 1 - a)
    fraction = F.aggregate(steps, F.struct(first.alias("d"), (1 / tiny).alias("c"), first.alias("h")), step, lambda s: s["h"])
    tail = F.when(x < a + 1, 1 - front * series).otherwise(front * fraction)
    return F.when((dof < 1) | (statistic <= 0), F.lit(1.0)).otherwise(F.greatest(F.least(tail, F.lit(1.0)), F.lit(0.0)))
