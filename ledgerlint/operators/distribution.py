"""Tables behind the distribution charts.

All functions take a *stored* long table ``(variable, value, weight)`` with one
row for each distinct value, weighted by its number of lines. An invoice-level
value is weighted by the lines of its invoices, not joined back to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlint.config import HISTOGRAM_BINS
from ledgerlint.functions.columns import finite
from ledgerlint.functions.rank_sums import sums_of_quantiles
from ledgerlint.operators.baskets import invoice_basket_metric
from ledgerlint.operators.quantiles import distinct_quantiles, value_ranks
from ledgerlint.sources.staging import stage

VARIABLES = ("Quantity", "Unit Price", "Basket Value")


def distribution_values(lines: DataFrame) -> DataFrame:
    """Finite values of the three analysed variables, stored by variable."""
    line_level = lines.select(
        F.col("quantity").cast("double").alias("Quantity"),
        F.col("price").alias("Unit Price"),
        F.lit(1).cast("long").alias("weight"),
    ).unpivot(["weight"], ["Quantity", "Unit Price"], "variable", "value")
    invoice_level = invoice_basket_metric(lines).select(
        F.lit("Basket Value").alias("variable"),
        F.col("basket_value").alias("value"),
        F.col("line_count").alias("weight"),
    )
    values = line_level.unionByName(invoice_level).select(
        finite(F.col("value")).alias("value"), "weight", "variable"
    )
    return _stored(values.dropna())


def _stored(values: DataFrame) -> DataFrame:
    distinct = values.groupBy("variable", "value").agg(F.sum("weight").alias("weight"))
    return stage(distinct.select("value", "weight", "variable"), "values", partition_by=["variable"])


def basket_distribution(baskets: DataFrame, name: str = "Sales Basket") -> DataFrame:
    """Basket values of the rollup in the same long form, stored."""
    values = baskets.select(
        F.col("basket_value").alias("value"),
        F.lit(1).cast("long").alias("weight"),
        F.lit(name).alias("variable"),
    )
    return _stored(values)


def _variables(values: DataFrame) -> list[tuple[str, float, float, int]]:
    """Bounds and size of each variable: one row per variable."""
    rows = (
        values.groupBy("variable")
        .agg(
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.sum("weight").alias("n"),
        )
        .collect()
    )
    return sorted((r["variable"], r["low"], r["high"], r["n"]) for r in rows)


def _by_variable(pairs: dict[str, Column]) -> Column:
    """Pick an expression by the row's variable."""
    out = F.lit(None)
    for name, expression in pairs.items():
        out = F.when(F.col("variable") == name, expression).otherwise(out)
    return out


def histogram(values: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """``(variable, bin, bin_low, bin_high, row_count)``, empty bins included.

    Equal widths between minimum and maximum, last bin closed. A constant
    variable has a single bin.
    """
    spark = values.sparkSession
    bounds = _variables(values)
    index, grid = {}, []
    for name, low, high, _ in bounds:
        width = (high - low) / bins
        if width > 0:
            raw = F.floor((F.col("value") - F.lit(low)) / F.lit(width))
            index[name] = F.least(raw, F.lit(bins - 1)).cast("int")
        else:
            index[name] = F.lit(0)
        for i in range(bins if width > 0 else 1):
            top = high if i == bins - 1 or width <= 0 else low + (i + 1) * width
            grid.append((name, i, low + i * width, top))
    counts = (
        values.withColumn("bin", _by_variable(index))
        .groupBy("variable", "bin")
        .agg(F.sum("weight").alias("row_count"))
    )
    edges = spark.createDataFrame(
        grid, "variable string, bin int, bin_low double, bin_high double"
    )
    return edges.join(counts, ["variable", "bin"], "left").fillna(0, ["row_count"])


def histogram_log10(values: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """The histogram of ``log10`` over positive values."""
    logs = values.where(F.col("value") > 0)
    return histogram(logs.withColumn("value", F.log10("value")), bins)


def boxplot_stats(values: DataFrame, parts: int | None = None) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and the rows beyond them."""
    names = [name for name, _, _, _ in _variables(values)]
    found = distinct_quantiles(values, {n: [0.25, 0.5, 0.75] for n in names}, parts)
    quartiles, fences = found, {}
    for name, (q1, _, q3) in found.items():
        reach = 1.5 * (q3 - q1)
        fences[name] = (q1 - reach, q3 + reach)

    def pick(table: dict, i: int) -> Column:
        return _by_variable({k: F.lit(v[i]) for k, v in table.items()})

    value, low, high = F.col("value"), pick(fences, 0), pick(fences, 1)
    inside = (value >= low) & (value <= high)
    whiskers = values.groupBy("variable").agg(
        F.min(F.when(inside, value)).alias("low"),
        F.max(F.when(inside, value)).alias("high"),
        F.coalesce(F.sum(F.when(~inside, F.col("weight"))), F.lit(0)).alias(
            "outlier_count"
        ),
        F.sum("weight").alias("row_count"),
    )
    q1, median, q3 = (pick(quartiles, i).cast("double") for i in range(3))
    return whiskers.select(
        "variable",
        q1.alias("q1"),
        median.alias("median"),
        q3.alias("q3"),
        # A whisker never ends inside the box.
        F.least("low", q1).alias("whisker_low"),
        F.greatest("high", q3).alias("whisker_high"),
        "outlier_count",
        "row_count",
    )


def qq_points(values: DataFrame) -> DataFrame:
    """Normal Q-Q points with the fitted line, per variable.

    One point for each distinct value, with its ranks and the mean of their
    theoretical quantiles. Slope, intercept and r are fitted to all values, each
    rank with its own quantile; the quantiles of a value's ranks are summed in
    closed form. A variable needs more than three values.
    """
    # One row for each variable.
    sizes = values.groupBy("variable").agg(
        F.sum("weight").alias("n"), F.sum(F.col("value") * F.col("weight")).alias("sx")
    ).where("n > 3").withColumn("mean", F.col("sx") / F.col("n"))
    ranked = value_ranks(values.join(sizes.select("variable"), "variable", "left_semi"))
    runs = ranked.join(sizes, "variable")
    summed = runs.withColumn("sums", sums_of_quantiles("first_rank", "last_rank", "n"))
    points = stage(
        summed.select("variable", "value", "first_rank", "last_rank", "weight", "n", "mean", "sums.t", "sums.tt"),
        "points",
    )
    w, t, off = F.col("weight"), F.col("t"), F.col("value") - F.col("mean")
    moments = points.groupBy("variable").agg(
        F.first("n").alias("n"), F.first("mean").alias("mean"), F.sum(t).alias("st"), F.sum("tt").alias("stt"),
        F.sum(off * t).alias("both"), F.sum(w * off * off).alias("dxx"),
    )
    slope = F.try_divide("both", F.col("stt") - F.col("st") * F.col("st") / F.col("n"))
    line = moments.select(
        "variable",
        slope.alias("slope"),
        (F.col("mean") - slope * F.col("st") / F.col("n")).alias("intercept"),
        F.try_divide("both", F.sqrt((F.col("stt") - F.col("st") * F.col("st") / F.col("n")) * F.col("dxx"))).alias("r"),
    )
    return points.select(
        "variable", F.col("value").alias("sample"), "first_rank", "last_rank", (t / w).alias("theoretical")
    ).join(line, "variable")
