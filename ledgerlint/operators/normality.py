"""Shapiro-Wilk test (Royston 1995, algorithm AS R94) on a bounded sample."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.config import NORMALITY_ALPHA, NORMALITY_SAMPLE
from ledgerlint.functions.columns import finite
from ledgerlint.operators.baskets import lines_with_basket
from ledgerlint.operators.distribution import VARIABLES
from ledgerlint.sources.staging import stage

# Royston's polynomial coefficients, constant term first.
_LAST_WEIGHT = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
_NEXT_WEIGHT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
_SMALL_GAMMA = (-2.273, 0.459)
_SMALL_MEAN = (0.5440, -0.39978, 0.025054, -0.0006714)
_SMALL_LOG_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
_LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
_LARGE_LOG_SD = (-0.4803, -0.082676, 0.0030302)

OVERSAMPLING = 3


def _poly(coefficients: tuple[float, ...], x: float) -> float:
    return sum(c * x**i for i, c in enumerate(coefficients))


def weights(n: int) -> list[float]:
    """Weight of each order statistic of a sample of ``n >= 3``."""
    if n == 3:
        return [-math.sqrt(0.5), 0.0, math.sqrt(0.5)]
    normal = NormalDist()
    m = [normal.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    square = sum(v * v for v in m)
    u = 1.0 / math.sqrt(n)
    ends = [m[-1] / math.sqrt(square) + _poly(_LAST_WEIGHT, u)]
    if n > 5:
        ends.append(m[-2] / math.sqrt(square) + _poly(_NEXT_WEIGHT, u))
    k = len(ends)
    inner = square - 2 * sum(v * v for v in m[-k:])
    scale = math.sqrt(inner / (1 - 2 * sum(a * a for a in ends)))
    middle = [v / scale for v in m[k:-k]]
    return [-a for a in ends] + middle + ends[::-1]


def p_value(w: float, n: int) -> float:
    """Probability of a smaller W under normality."""
    if w >= 1.0:
        return 1.0
    if n == 3:
        tail = 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return min(max(tail, 0.0), 1.0)
    y = math.log(1.0 - w)
    if n <= 11:
        gamma = _poly(_SMALL_GAMMA, n)
        if y >= gamma:
            return 0.0
        y = -math.log(gamma - y)
        mean, log_sd = _poly(_SMALL_MEAN, n), _poly(_SMALL_LOG_SD, n)
    else:
        x = math.log(n)
        mean, log_sd = _poly(_LARGE_MEAN, x), _poly(_LARGE_LOG_SD, x)
    z = (y - mean) / math.exp(log_sd)
    return 0.5 * math.erfc(z / math.sqrt(2))


def draw_of(seed: int) -> Column:
    """A line's draw: a seeded hash of its key, the same under any partitioning."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("invoice", "stockcode", "quantity")]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def sample_values(
    lines: DataFrame, limit: int = NORMALITY_SAMPLE, seed: int = 42
) -> DataFrame:
    """``(variable, value)``: the ``limit`` finite values of the smallest draws, per variable.

    Lines below a cut that leaves about three times ``limit`` of a variable are
    stored, and the smallest draws win; equal draws go by value. Copies share a
    draw, so a cut may leave too few: it is then widened. ``lines`` is read
    several times: pass a stored table.
    """
    valued = stage(
        lines_with_basket(lines.select("invoice", "stockcode", "quantity", "price")).select(
            draw_of(seed).alias("draw"),
            F.col("quantity").cast("double").alias("Quantity"),
            finite(F.col("price")).alias("Unit Price"),
            finite(F.col("basket_value")).alias("Basket Value"),
        ),
        "drawn",
    ).withColumn("at", F.conv(F.substring("draw", 1, 8), 16, 10).cast("long"))
    sizes = valued.agg(*(F.count(v).alias(v) for v in VARIABLES)).first()
    cuts = {v: min(1.0, OVERSAMPLING * limit / max(sizes[v], 1)) for v in VARIABLES}
    while True:
        near = {v: F.col("at") < int(cuts[v] * 2**32) for v in VARIABLES}
        left = valued.agg(*(F.count(F.when(near[v], F.col(v))).alias(v) for v in VARIABLES)).first()
        short = [v for v in VARIABLES if left[v] < min(limit, sizes[v])]
        if not short:
            break
        cuts.update({v: min(1.0, 4 * cuts[v]) for v in short})
    long = (
        valued.select("draw", *(F.when(near[v], F.col(v)).alias(v) for v in VARIABLES))
        .unpivot(["draw"], list(VARIABLES), "variable", "value")
        .dropna(subset=["value"])
    )
    smallest = Window.partitionBy("variable").orderBy("draw", "value")
    return (
        long.withColumn("n", F.row_number().over(smallest))
        .where(F.col("n") <= limit)
        .select("variable", "value")
    )


def shapiro_wilk(sample: DataFrame) -> DataFrame:
    """W per variable of a bounded sample ``(variable, value)``.

    W is the squared weighted sum of the ordered values over their squared
    deviations: a join with the weights and one aggregate.
    """
    spark = sample.sparkSession
    sample = stage(sample, "sample")
    sizes = {r["variable"]: r["count"] for r in sample.groupBy("variable").count().collect()}
    table = [
        (variable, i, a)
        for variable, n in sizes.items()
        if n >= 3
        for i, a in enumerate(weights(n), 1)
    ]
    coefficients = spark.createDataFrame(table, "variable string, i int, a double")
    rank = F.row_number().over(Window.partitionBy("variable").orderBy("value"))
    return (
        sample.withColumn("i", rank)
        .join(F.broadcast(coefficients), ["variable", "i"])
        .groupBy("variable")
        .agg(
            F.count("value").alias("sample_size"),
            F.pow(F.sum(F.col("a") * F.col("value")), F.lit(2.0)).alias("explained"),
            (F.var_pop("value") * F.count("value")).alias("spread"),
        )
        .select(
            "variable",
            "sample_size",
            # A constant sample has no spread; W is 1 by convention.
            F.coalesce(
                F.least(F.try_divide("explained", "spread"), F.lit(1.0)), F.lit(1.0)
            ).alias("statistic"),
        )
    )


def normality_tests(
    lines: DataFrame, limit: int = NORMALITY_SAMPLE, seed: int = 42
) -> DataFrame:
    """One row per variable; without enough values only a note is given."""
    spark = lines.sparkSession
    sample = stage(sample_values(lines, limit, seed), "sample")
    counts = {r["variable"]: r["count"] for r in sample.groupBy("variable").count().collect()}
    tested = {r["variable"]: r for r in shapiro_wilk(sample).collect()}  # three rows
    rows = []
    for variable in VARIABLES:
        r = tested.get(variable)
        if r is None:
            note = "Insufficient data for test" if counts.get(variable) else "No valid data"
            rows.append((variable, None, None, "N/A", None, note))
            continue
        prob = p_value(r["statistic"], r["sample_size"])
        verdict = "No" if prob < NORMALITY_ALPHA else "Yes"
        rows.append((variable, prob, r["statistic"], verdict, r["sample_size"], ""))
    return spark.createDataFrame(
        rows,
        "variable string, p_value double, statistic double, is_normal string, "
        "sample_size long, notes string",
    )
