"""One key holds a third of all rows: results stay whole, work stays spread."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlint.config import CleaningConfig
from ledgerlint.operators import anomalies, baskets, cleaning, joins, monitoring
from ledgerlint.operators.waterfall import label_lines
from ledgerlint.plans.cleaning_run import run_cleaning
from ledgerlint.sources.schema import LINE_COLUMNS
from ledgerlint.sources.staging import stage

ROWS = 60_000
CONFIG = CleaningConfig(isolation_contam=0.0)


@pytest.fixture(scope="module")
def skewed(spark):
    """Invoice ``hot`` has a third of the lines, a third of those in one pair."""
    hot = F.col("id") % 3 == 0
    df = spark.range(0, ROWS, 1, 8).select(
        F.when(hot, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("invoice"),
        F.when(hot & (F.col("id") % 9 == 0), F.lit("hotcode"))
        .otherwise((F.col("id") % 5000).cast("string"))
        .alias("stockcode"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("item "), F.col("id") % 10)).alias("description"),
        F.when(F.col("id") % 11 == 0, -1).otherwise(1).cast("long").alias("quantity"),
        F.timestamp_add("MINUTE", F.col("id").cast("int"), F.lit(dt.datetime(2010, 1, 1)).cast("timestamp_ntz")).alias("invoicedate"),
        (F.col("id") % 900 + 1).cast("double").alias("price"),
        F.when(hot, F.lit("c")).otherwise((F.col("id") % 50).cast("string")).alias("customer_id"),
        F.lit("France").alias("country"),
        F.lit("2009-2010").alias("source_year"),
    ).select(*LINE_COLUMNS)
    return stage(df, "skewed")


def test_hot_pair_collapses_in_partial_aggregates(skewed):
    out = cleaning.collapse_lines(skewed)
    hot = out.where("invoice = 'hot' and stockcode = 'hotcode'").first()
    want = skewed.where("invoice = 'hot' and stockcode = 'hotcode'")
    assert hot.quantity == want.agg(F.sum("quantity")).first()[0]
    assert hot.invoicedate == want.agg(F.min("invoicedate")).first()[0]
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in text and "partial_sum" in text
    assert "Window" not in text


def test_no_window_over_an_invoice_or_pair_in_the_run(skewed):
    text = label_lines(skewed, CONFIG)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text
    run = run_cleaning(skewed, CONFIG)
    remaining = run.waterfall.where("step = 'handle_missing_id'").first().rows_remaining
    assert run.cleaned.count() == remaining


def test_prefix_repair_moves_only_negative_lines(skewed):
    out = cleaning.fix_credit_prefix(skewed)
    assert out.count() == ROWS
    negative_singles = skewed.where("quantity < 0 and invoice <> 'hot'").count()
    assert out.where("invoice like 'C%'").count() == negative_singles
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.fixture
def small_hot_groups(monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 100)


def test_hot_invoice_is_joined_without_a_shuffle(skewed, small_hot_groups):
    loose = skewed.limit(40).withColumn("invoice", F.lit(None).cast("string"))
    out = baskets.lines_with_basket(stage(skewed.union(loose), "loose"))
    assert out.count() == ROWS + 40
    assert out.where("invoice is null and basket_value is null").count() == 40
    want = skewed.where("invoice = 'hot'").agg(F.sum("quantity") * F.avg("price")).first()[0]
    hot = out.where("invoice = 'hot'").groupBy("basket_value").count().collect()
    assert [(r["basket_value"], r["count"]) for r in hot] == [(pytest.approx(want), ROWS // 3)]
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [invoice" in text and "LeftAnti" in text


def test_hot_negative_invoice_is_repaired_whole(skewed, small_hot_groups):
    negative = skewed.withColumn(
        "quantity", F.when(F.col("invoice") == "hot", -1).otherwise(F.col("quantity"))
    )
    out = cleaning.resolve_negative_sales(stage(negative, "negative"))
    assert out.where("invoice = 'Chot'").count() == ROWS // 3
    assert out.count() == ROWS


def test_hot_mixed_invoice_loses_its_negative_lines(skewed, small_hot_groups):
    bad = skewed.where("invoice = 'hot' and quantity < 0").count()
    assert cleaning.resolve_negative_sales(skewed).count() == ROWS - bad


def test_full_return_of_a_hot_pair(skewed, small_hot_groups):
    credits = skewed.withColumn(
        "invoice",
        F.when(F.col("quantity") < 0, F.concat(F.lit("C"), "invoice")).otherwise(F.col("invoice")),
    )
    # All lines of the hot pair carry one date: one hot join key.
    same_day = credits.withColumn("invoicedate", F.lit(dt.datetime(2010, 1, 1)).cast("timestamp_ntz"))
    table = monitoring.full_basket_return(stage(same_day, "same_day"))
    assert table.where("invoice = 'hot'").first().full_basket_return == 0
    assert table.count() == skewed.where("quantity > 0").select("invoice").distinct().count()


def test_examples_keep_few_rows_per_task(skewed):
    out = anomalies.anomaly_examples(skewed)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text
    assert out.where("flag = 'negative_quantity_sale'").count() == 5


def test_returns_of_a_hot_pair_are_grouped_by_day(skewed):
    credits = skewed.withColumn(
        "invoice", F.when(F.col("quantity") < 0, F.concat(F.lit("C"), "invoice")).otherwise(F.col("invoice"))
    )
    table = monitoring.returned_since(credits)
    text = table._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    pair = table.where("customer_id = 'c' and stockcode = 'hotcode'")
    first = pair.orderBy("invoicedate").first()
    want = credits.where(
        "customer_id = 'c' and stockcode = 'hotcode' and invoice like 'C%'"
    ).agg(F.sum(-F.col("quantity"))).first()[0]
    assert first.returned == want
