"""Drift, threshold, privacy and return-target operators.

Definitions are this project's own; see the README.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.functions import predicates as p
from ledgerlint.functions.columns import finite, truncate_ntz
from ledgerlint.operators.joins import attach_group_values, complete
from ledgerlint.operators.quantiles import exact_quantiles
from ledgerlint.sources.staging import stage

MIN_SHARE = 1e-6
GRID_STEPS = 100


def psi_buckets(
    values: DataFrame,
    column: str,
    is_expected: Column,
    buckets: int = 10,
    parts: int | None = None,
) -> DataFrame:
    """Shares of both samples per quantile bucket of the expected one.

    ``is_expected`` marks rows of the expected sample; all others are actual.
    Bucket ``i`` ends at edge ``i``, inclusive. Equal edges leave buckets empty.
    ``values`` is read several times.
    """
    data = values.select(
        finite(F.col(column).cast("double")).alias("x"),
        p.holds(is_expected).alias("expected"),
    ).where(F.col("x").isNotNull())
    probs = [i / buckets for i in range(1, buckets)]
    edges = exact_quantiles(data.where("expected"), "x", probs, parts=parts)
    bucket = F.lit(0)
    for edge in edges:
        bucket = bucket + (F.col("x") > F.lit(edge).cast("double")).cast("int")
    counts = data.groupBy(bucket.alias("bucket")).agg(
        F.count_if("expected").alias("expected_count"),
        F.count_if(~F.col("expected")).alias("actual_count"),
    )
    every = values.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").fillna(0)
    whole = Window.partitionBy()  # one row per bucket

    def share(count: str) -> Column:
        part = F.try_divide(F.col(count), F.sum(count).over(whole))
        return F.greatest(part, F.lit(MIN_SHARE))

    shares = full.withColumns(
        {
            "expected_share": share("expected_count"),
            "actual_share": share("actual_count"),
        }
    )
    gap = F.col("actual_share") - F.col("expected_share")
    ratio = F.ln(F.col("actual_share") / F.col("expected_share"))
    return shares.withColumn("contribution", gap * ratio)


def psi(
    values: DataFrame,
    column: str,
    is_expected: Column,
    buckets: int = 10,
    parts: int | None = None,
) -> DataFrame:
    """Population stability index as one row."""
    per_bucket = psi_buckets(values, column, is_expected, buckets, parts)
    return per_bucket.agg(F.sum("contribution").alias("psi"))


def threshold_metrics(
    scored: DataFrame, score: str, target: str, steps: int = GRID_STEPS
) -> DataFrame:
    """Confusion counts and rates for thresholds 0, 1/steps, ..., 1.

    A row is flagged when its score reaches the threshold. Rows are counted
    per grid cell once; the thresholds are then a running sum over the grid.
    """
    x = F.col(score).cast("double")
    guess = F.floor(x * F.lit(float(steps)))
    # The product may round across a grid line; compare with the line itself.
    cell = (
        F.when((guess + 1) / F.lit(float(steps)) <= x, guess + 1)
        .when(guess / F.lit(float(steps)) > x, guess - 1)
        .otherwise(guess)
    )
    cell = F.least(F.greatest(cell, F.lit(-1)), F.lit(steps)).cast("int")
    counts = (
        scored.where(x.isNotNull() & ~F.isnan(x) & F.col(target).isNotNull())
        .groupBy(cell.alias("cell"))
        .agg(
            F.count_if(F.col(target) == 1).alias("positive"),
            F.count_if(F.col(target) != 1).alias("negative"),
        )
    )
    grid = scored.sparkSession.range(-1, steps + 1).select(F.col("id").cast("int").alias("cell"))
    upward = Window.orderBy(F.desc("cell"))  # one row per grid cell
    whole = Window.partitionBy()
    confusion = (
        grid.join(counts, "cell", "left")
        .fillna(0)
        .select(
            "cell",
            F.sum("positive").over(upward).alias("tp"),
            F.sum("negative").over(upward).alias("fp"),
            F.sum("positive").over(whole).alias("positives"),
            F.sum("negative").over(whole).alias("negatives"),
        )
        .where(F.col("cell") >= 0)
    )
    tp, fp = F.col("tp"), F.col("fp")
    total = F.col("positives") + F.col("negatives")
    fn = F.col("positives") - tp
    return confusion.select(
        (F.col("cell") / F.lit(float(steps))).alias("threshold"),
        "tp",
        "fp",
        (F.col("negatives") - fp).alias("tn"),
        fn.alias("fn"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, F.col("positives")).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.try_divide(tp + fp, total).alias("flag_rate"),
    )


def pseudonymise(lines: DataFrame, salt: str, unit: str = "DAY") -> DataFrame:
    """Salted hash of the customer id; dates truncated to ``unit``."""
    return lines.withColumns(
        {
            "customer_id": F.sha2(F.concat(F.lit(salt), "customer_id"), 256),
            "invoicedate": truncate_ntz("invoicedate", unit),
        }
    )


RETURN_KEY = ("customer_id", "stockcode", "invoicedate")


def _is_sold() -> Column:
    return ~p.is_credit() & p.holds(F.col("quantity") > 0) & F.col("invoice").isNotNull()


def returned_since(lines: DataFrame) -> DataFrame:
    """Per customer, stock code and date: quantity ``returned`` by credit lines
    on or after the date, and ``n_sold`` lines of that date.

    No sale is paired with single credits. Credits are summed per date, then
    summed backwards in two steps: over the days of the pair and over the
    times of one day. A hot pair is thereby spread over one group per day.
    """
    pair = ["customer_id", "stockcode"]
    credited = F.when(p.is_credit() & p.is_negative(), -F.col("quantity")).otherwise(0)
    per_time = (
        lines.where(complete(RETURN_KEY))
        .groupBy(*RETURN_KEY)
        .agg(F.sum(credited).alias("credited"), F.count_if(_is_sold()).alias("n_sold"))
        .withColumn("day", F.to_date("invoicedate"))
    )
    per_day = per_time.groupBy(*pair, "day").agg(F.sum("credited").alias("credited"))
    later_days = (
        Window.partitionBy(*pair)
        .orderBy(F.desc("day"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    after = per_day.select(
        *pair,
        "day",
        F.coalesce(F.sum("credited").over(later_days), F.lit(0)).alias("after_day"),
    )
    rest_of_day = Window.partitionBy(*pair, "day").orderBy(F.desc("invoicedate"))
    within = per_time.withColumn("same_day", F.sum("credited").over(rest_of_day))
    total = F.col("same_day") + F.col("after_day")
    return within.join(after, [*pair, "day"]).select(
        *RETURN_KEY, total.alias("returned"), "n_sold"
    )


def _with_returnable_mark(lines: DataFrame) -> DataFrame:
    """Sold and credited lines; ``returnable`` is set when the customer and
    stock code have both, which for most lines they do not."""
    pair = ["customer_id", "stockcode"]
    is_credited = p.is_credit() & p.is_negative()
    involved = lines.where(_is_sold() | is_credited).select(
        "invoice", *RETURN_KEY, "quantity"
    )
    n, n_credited = F.col("n"), F.col("n_credited")
    pairs = (
        involved.where(complete(pair))
        .groupBy(*pair)
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(is_credited).alias("n_credited"))
        .where((n_credited > 0) & (n_credited < n))
        .select(*pair, F.lit(True).alias("returnable"), "n")
    )
    return attach_group_values(involved, stage(pairs, "pairs"), pair, "n")


def full_basket_return(lines: DataFrame) -> DataFrame:
    """``(invoice, full_basket_return)`` for every invoice with sold lines.

    1 when, for every sold line, credit lines of the same customer and stock
    code dated on or after it return at least its quantity. Only lines whose
    customer and stock code have credits are matched by date. Reads ``lines``
    several times: pass a stored table.
    """
    marked = stage(_with_returnable_mark(lines), "marked")
    candidates = marked.where("returnable")
    returned = stage(returned_since(candidates).where(F.col("n_sold") > 0), "returned")
    matched = attach_group_values(
        candidates.where(_is_sold()), returned, RETURN_KEY, "n_sold"
    ).select("invoice", p.holds(F.col("returned") >= F.col("quantity")).alias("matched"))
    unmatched = marked.where(_is_sold() & F.col("returnable").isNull()).select(
        "invoice", F.lit(False).alias("matched")
    )
    whole = F.bool_and("matched").cast("int")
    return (
        matched.unionByName(unmatched)
        .groupBy("invoice")
        .agg(whole.alias("full_basket_return"))
    )
