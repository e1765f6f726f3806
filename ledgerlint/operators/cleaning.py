"""Row-level cleaning steps.

Each step is ``DataFrame -> DataFrame`` and sees only what the step before it
kept. Steps that shuffle combine on the map side, so one hot invoice, pair or
row costs one buffer per task rather than one huge task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlint.config import CleaningConfig
from ledgerlint.functions import predicates as p
from ledgerlint.functions.columns import first_non_nulls, order_key, pct
from ledgerlint.operators.joins import attach_group_values
from ledgerlint.operators.quantiles import column_quantiles
from ledgerlint.sources.staging import stage

PAIR = ("invoice", "stockcode")
COPIES = "n_copies"


def _distinct_with_copies(lines: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    keys = [c for c in lines.columns if c not in exclude]
    kept = [F.min(c).alias(c) for c in lines.columns if c in exclude]
    grouped = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES), *kept)
    return grouped.select(*lines.columns, COPIES)


def drop_exact_duplicates(lines: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row per distinct line. ``exclude`` names columns that do not count."""
    return _distinct_with_copies(lines, exclude).drop(COPIES)


def _collapse(lines: DataFrame, audit: Mapping[str, Column] | None = None) -> DataFrame:
    audit = audit or {}
    columns = [c for c in lines.columns if c not in audit]
    order = order_key(columns, exclude=PAIR)
    carried = [c for c in columns if c not in (*PAIR, "quantity")]
    firsts, results = first_non_nulls(carried, order)
    collapsed = lines.groupBy(*PAIR).agg(
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("quantity"),
        *(agg.alias(name) for name, agg in (firsts | dict(audit)).items()),
    )
    return collapsed.select(*(results.get(c, F.col(c)) for c in columns), *audit)


def collapse_lines(lines: DataFrame) -> DataFrame:
    """One row per (invoice, stockcode): quantity summed, first value of the rest.

    Lines without an invoice or stock code vanish.
    """
    keyed = F.col("invoice").isNotNull() & F.col("stockcode").isNotNull()
    return _collapse(lines.where(keyed))


def drop_technical(lines: DataFrame) -> DataFrame:
    return lines.where(p.keeps_untechnical())


def drop_extreme_price(lines: DataFrame) -> DataFrame:
    """Keeps prices up to the limit; a null price is dropped."""
    return lines.where(p.keeps_acceptable_price())


def drop_zero_price(lines: DataFrame) -> DataFrame:
    return lines.where(p.keeps_priced())


def _suspects_with_verdict(lines: DataFrame) -> DataFrame:
    """Negative lines without the credit prefix; ``repaired`` says whether all
    lines of their invoice are negative.

    Only such lines can change in the repair or be dropped after it, so only
    they are joined; ``lines`` is read for the verdict and for the join.
    """
    negatives = F.count_if(p.is_negative())
    verdicts = (
        lines.where(~p.is_credit() & F.col("invoice").isNotNull())
        .groupBy("invoice")
        .agg(negatives.alias("n"), (negatives == F.count(F.lit(1))).alias("repaired"))
        .where(F.col("n") > 0)
    )
    suspects = lines.where(p.keeps_negative_sales())
    return attach_group_values(suspects, stage(verdicts, "verdicts"), ["invoice"], "n")


def _prefixed() -> Column:
    return F.concat(F.lit("C"), "invoice")


def fix_credit_prefix(lines: DataFrame) -> DataFrame:
    """Prefix ``C`` to invoices whose lines are all negative.

    Reads ``lines`` several times: pass a stored table.
    """
    repaired = F.when(F.col("repaired"), _prefixed()).otherwise(F.col("invoice"))
    touched = _suspects_with_verdict(lines).withColumn("invoice", repaired)
    untouched = lines.where(p.keeps_unsigned())
    return untouched.unionByName(touched.drop("repaired"))


def resolve_negative_sales(lines: DataFrame) -> DataFrame:
    """Prefix repair and removal of negative sales in one step.

    A negative sale line survives exactly when its invoice is repaired. Reads ``lines``
    several times: pass a stored table. The repaired lines, a small part, are stored, so
    that later passes over the result join and shuffle nothing.
    """
    kept = (
        _suspects_with_verdict(lines)
        .where("repaired")
        .withColumn("invoice", _prefixed())
        .drop("repaired")
    )
    return lines.where(p.keeps_unsigned()).unionByName(stage(kept, "repaired"))


def drop_negative_sales(lines: DataFrame) -> DataFrame:
    return lines.where(p.keeps_unsigned())


def drop_missing_customer(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("customer_id").isNotNull())


def impute_missing_customer(lines: DataFrame) -> DataFrame:
    """Surrogate ids by country, marked in ``missing_id``."""
    missing = F.col("customer_id").isNull()
    return lines.withColumns(
        {
            "customer_id": F.coalesce("customer_id", p.surrogate_customer()),
            "missing_id": missing.cast("int"),
        }
    )


def handle_missing_customer(lines: DataFrame, config: CleaningConfig) -> DataFrame:
    step = drop_missing_customer if config.drop_missing_id else impute_missing_customer
    return step(lines)


def add_basket_value(lines: DataFrame) -> DataFrame:
    """Line value of sold quantities; 0 for everything else."""
    return lines.withColumn("basket_value", p.line_basket_value())


def cap_thresholds(
    lines: DataFrame, config: CleaningConfig, parts: int | None = None
) -> dict[str, float | None]:
    """Caps from non-credit lines. Reads ``lines`` once for each cap, and both ranked together."""
    sales = lines.where(~p.is_credit())
    paid = sales.where(F.col("basket_value") > 0)
    caps = column_quantiles(
        {"price_cap": (sales, "price"), "basket_cap": (paid, "basket_value")},
        {"price_cap": [config.price_cap_q], "basket_cap": [config.basket_cap_q]},
        parts=parts,
    )
    return {name: cap for name, (cap,) in caps.items()}


def _above(column: str, cap: float | None) -> Column:
    return p.holds(F.col(column) > F.lit(cap).cast("double"))


def capped_counts(lines: DataFrame, caps: Mapping[str, float | None]) -> DataFrame:
    """The caps and how many lines exceed each, as one row."""
    return lines.agg(
        F.lit(caps["price_cap"]).cast("double").alias("price_cap"),
        F.lit(caps["basket_cap"]).cast("double").alias("basket_cap"),
        F.count_if(_above("price", caps["price_cap"])).alias("price_capped_count"),
        F.count_if(_above("basket_value", caps["basket_cap"])).alias(
            "basket_capped_count"
        ),
    )


def apply_caps(lines: DataFrame, caps: Mapping[str, float | None]) -> DataFrame:
    """Replace larger values by the cap, on credit lines too.

    ``basket_value`` is not recomputed from the capped price.
    """
    return lines.withColumns(
        {
            column: F.when(_above(column, cap), F.lit(cap).cast("double")).otherwise(
                F.col(column)
            )
            for column, cap in (
                ("price", caps["price_cap"]),
                ("basket_value", caps["basket_cap"]),
            )
        }
    )


def add_country_bucket(lines: DataFrame) -> DataFrame:
    return lines.withColumn("country_bucket", p.country_bucket())


def country_bucket_counts(lines: DataFrame) -> DataFrame:
    bucketed = add_country_bucket(lines)
    return bucketed.groupBy("country_bucket").agg(F.count(F.lit(1)).alias("row_count"))


def add_is_cancelled(lines: DataFrame) -> DataFrame:
    return lines.withColumn("is_cancelled", p.is_credit().cast("int"))


def is_cancelled_counts(lines: DataFrame) -> DataFrame:
    cancelled, total = F.count_if(p.is_credit()), F.count(F.lit(1))
    return lines.agg(
        cancelled.alias("cancelled_count"),
        total.alias("total_count"),
        pct(cancelled, total).alias("cancelled_pct"),
    )
