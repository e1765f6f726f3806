from __future__ import annotations

import datetime as dt
import hashlib
import os
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerlint.functions.columns import truncate_ntz
from ledgerlint.sources import manifest, tables
from ledgerlint.sources.schema import LINE_SCHEMA, RAW_SCHEMA, typed_lines
from ledgerlint.sources.staging import discard, stage, staging_dir
from ledgerlint.streaming import row_rules
from ledgerlint.streaming.row_rules import apply_row_rules
from tests.helpers import FIVE, column, five, line, lines

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"


def test_types_and_names(spark):
    raw = spark.createDataFrame(
        [(489434, "85123A", 2, "2010-06-01 07:45:00", float("nan"), 13085.0),
         (489435, "DOT", 1, "rubbish", 2.5, float("nan"))],
        "Invoice long, StockCode string, Quantity int, InvoiceDate string, "
        "Price double, `Customer ID` double",
    )
    a, b = typed_lines(raw).collect()
    assert (a.invoice, a.customer_id, a.price) == ("489434", "13085", None)
    assert a.invoicedate == dt.datetime(2010, 6, 1, 7, 45)
    assert (b.invoicedate, b.customer_id) == (None, None)


def test_csv_years_are_combined_without_dedup(spark, tmp_path):
    row = "C489434,85123A,Mug,-2,2010-06-01 07:45:00,2.55,00123,EIRE\n"
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text(HEADER + row)
    years = {
        label: tables.read_year_csv(spark, str(tmp_path / f"{name}.csv"))
        for label, name in (("2009-2010", "a"), ("2010-2011", "b"))
    }
    out = tables.combine_years(years)
    assert out.count() == 2
    assert [f.dataType for f in out.select(*LINE_SCHEMA.fieldNames()).schema] == [
        f.dataType for f in LINE_SCHEMA
    ]
    first = out.first()
    assert (first.invoice, first.customer_id, first.quantity) == ("C489434", "00123", -2)
    meta = {(r.source_year, r.is_total): r.row_count for r in tables.load_metadata(out).collect()}
    assert meta == {(None, 1): 2, ("2009-2010", 0): 1, ("2010-2011", 0): 1}


def test_combine_aligns_differing_columns(spark):
    out = tables.combine_years({"a": five(spark), "b": five(spark).drop("country")})
    assert out.where("source_year = 'b' and country is null").count() == 5


def test_read_or_build_builds_once(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return five(spark)

    path = str(tmp_path / "combined")
    assert tables.read_or_build(spark, path, build).count() == 5
    assert tables.read_or_build(spark, path, build).count() == 5
    assert built == [1]


def test_read_or_build_replaces_the_rest_of_a_failed_write(spark, tmp_path):
    (tmp_path / "combined" / "_temporary").mkdir(parents=True)
    built = tables.read_or_build(spark, str(tmp_path / "combined"), lambda: five(spark))
    assert built.count() == 5


def test_table_with_original_header(spark, tmp_path):
    raw = five(spark).withColumn("customer_id", F.col("customer_id").cast("double"))
    raw.toDF(*RAW_SCHEMA.fieldNames()).write.parquet(str(tmp_path / "raw"))
    back = tables.read_lines(spark, str(tmp_path / "raw"), RAW_SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, five(spark).collect()))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_written_timestamps_have_milliseconds(spark, tmp_path, fmt):
    stamp = dt.datetime(2010, 3, 28, 1, 30, 5, 123999)
    tables.write_lines(lines(spark, [line(invoicedate=stamp)]), str(tmp_path / "x"), fmt)
    reader = spark.read.schema(LINE_SCHEMA)
    back = reader.parquet(str(tmp_path / "x")) if fmt == "parquet" else reader.csv(
        str(tmp_path / "x"), header=True
    )
    assert column(back, "invoicedate") == [stamp.replace(microsecond=123000)]
    with pytest.raises(ValueError):
        tables.write_lines(back, str(tmp_path / "y"), "xml")


@pytest.mark.parametrize(
    "unit, want",
    [
        ("DAY", dt.datetime(2010, 3, 28)),
        ("MONTH", dt.datetime(2010, 3, 1)),
        ("HOUR", dt.datetime(2010, 3, 28, 1)),
        ("MINUTE", dt.datetime(2010, 3, 28, 1, 30)),
        ("SECOND", dt.datetime(2010, 3, 28, 1, 30, 5)),
    ],
)
def test_truncation_ignores_the_session_zone(spark, unit, want):
    # 01:30 does not exist in London on this day.
    df = lines(spark, [line(invoicedate=dt.datetime(2010, 3, 28, 1, 30, 5, 999))])
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        assert column(df.select(truncate_ntz("invoicedate", unit).alias("t")), "t") == [want]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_manifest(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc" * 1000)
    (tmp_path / "empty.bin").write_bytes(b"")
    good = hashlib.sha256(b"abc" * 1000).hexdigest()
    table = manifest.file_manifest(spark, str(tmp_path / "*.bin"), {"a.bin": good.upper()})
    rows = {r.file_name: r for r in table.collect()}
    assert rows["a.bin"].sha256 == good and rows["a.bin"].matches
    assert rows["empty.bin"].sha256.startswith("e3b0c442")
    assert rows["empty.bin"].matches is None and rows["empty.bin"].n_bytes == 0
    manifest.enforce_manifest(table)
    (tmp_path / "b c+d.bin").write_bytes(b"x")
    odd = manifest.file_manifest(spark, str(tmp_path / "b*.bin")).first()
    assert (odd.file_name, odd.n_bytes) == ("b c+d.bin", 1)
    wrong = manifest.file_manifest(spark, str(tmp_path / "a.bin"), {"a.bin": "0" * 64})
    with pytest.raises(ValueError, match="mismatch"):
        manifest.enforce_manifest(wrong)


def test_manifest_of_many_files_uses_many_tasks(spark, tmp_path):
    for i in range(500):
        (tmp_path / f"{i}.bin").write_bytes(str(i).encode())
    table = manifest.file_manifest(spark, str(tmp_path / "*.bin"), {"7.bin": "0" * 64, "8.bin": "1" * 64})
    assert {r.file_name: r.sha256 for r in table.collect()} == {
        f"{i}.bin": hashlib.sha256(str(i).encode()).hexdigest() for i in range(500)
    }
    hashed = manifest.hash_files(spark, str(tmp_path / "*.bin"))
    assert hashed.select(F.spark_partition_id().alias("task")).distinct().count() >= 8
    with pytest.raises(ValueError, match="7.bin.*8.bin"):
        manifest.enforce_manifest(table)


def test_read_or_build_keeps_a_finished_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    tables.write_lines(five(spark).where("invoice IS NULL"), path)
    assert tables.read_or_build(spark, path, lambda: five(spark)).count() == 0


def test_read_or_build_replaces_files_without_the_mark(spark, tmp_path):
    path = str(tmp_path / "half")
    tables.write_lines(five(spark).limit(1), path)
    (tmp_path / "half" / "_SUCCESS").unlink()
    assert tables.read_or_build(spark, path, lambda: five(spark)).count() == 5


def test_stage_uses_the_shared_folder_and_prunes_columns(spark):
    staged = stage(five(spark), "five")
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is not None:
        assert staging_dir(spark).startswith(base)
    plan = staged.where(F.col("price") > 11).select("invoice")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(price), GreaterThan(price,11.0)]" in text
    assert "ReadSchema: struct<invoice:string,price:double>" in text
    assert sorted(column(plan, "invoice")) == ["489435", "489437", "C489436"]


@pytest.mark.parametrize("folder", ["/mnt/shared", "file:///mnt/shared", "hdfs:///shared/"])
def test_any_shared_folder_serves_on_a_cluster(spark, folder):
    context = SimpleNamespace(applicationId="app", master="local-cluster[3,4,10240]", _jsc=spark.sparkContext._jsc)
    session = SimpleNamespace(sparkContext=context, conf={"spark.checkpoint.dir": folder})
    assert staging_dir(session) == f"{folder.rstrip('/')}/ledgerlint/app"


def test_shuffle_files_go_when_a_staged_table_is_written(spark):
    def files():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        found = manager.getAllFiles().iterator()
        names = set()
        while found.hasNext():
            names.add(found.next().getName())
        return {n for n in names if n.startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(key)
    counted = stage(spark.range(0, 100_000, 1, 4).groupBy((F.col("id") % 9973).alias("k")).count(), "counted")
    for _ in range(50):  # removal is asynchronous
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert counted.agg(F.sum("count")).first()[0] == 100_000
    assert spark.conf.get(key) == setting


def test_discard_removes_one_staged_table(spark):
    first, second = stage(five(spark), "first"), stage(five(spark), "second")
    path = first.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    discard(first, five(spark))
    assert not os.path.exists(path) and second.count() == 5
    discard(first)


def test_row_rules_work_on_a_stream(spark, tmp_path):
    five(spark).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(LINE_SCHEMA).parquet(str(tmp_path / "in"))
    query = (
        apply_row_rules(stream)
        .writeStream.format("memory")
        .queryName("row_rules")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    got = spark.table("row_rules")
    want = apply_row_rules(five(spark))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert column(got.orderBy("invoice"), "is_cancelled") == [0, 1]


def test_a_stream_stopped_in_the_middle_is_taken_up(spark, tmp_path):
    rows = [line(r) for r in FIVE] + [line(invoice=f"7{i:03d}", price=None if i % 9 == 0 else i * 1.0) for i in range(60)]
    whole = lines(spark, rows)
    incoming, sink, mark = (str(tmp_path / x) for x in ("incoming", "sink", "checkpoint"))
    whole.repartition(12, "invoice").write.parquet(incoming)
    # Stopped once a batch is done, with files left.
    arriving = row_rules.arriving_lines(spark, incoming, files_per_batch=1)
    query = row_rules.apply_row_rules(arriving).writeStream.format("parquet").option(
        "checkpointLocation", mark).trigger(processingTime="0 seconds").start(sink)
    while query.lastProgress is None:
        time.sleep(0.05)
    query.stop()
    assert len(os.listdir(f"{mark}/commits")) >= 1
    out = row_rules.run(spark, incoming, sink, mark, files_per_batch=5)
    want = apply_row_rules(whole)
    assert sorted(map(repr, out.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    # Nothing new, nothing twice; then more arrives.
    assert row_rules.run(spark, incoming, sink, mark).count() == want.count()
    lines(spark, [line(invoice="late")]).write.mode("append").parquet(incoming)
    assert row_rules.run(spark, incoming, sink, mark).count() == want.count() + 1


def test_large_scans_are_dealt_by_rows(spark, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 10)
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(30 * cores).toDF("id")
    assert tables.dealt(many, "id").rdd.getNumPartitions() == 3 * cores
    assert sorted(column(tables.dealt(many, "id"), "id")) == list(range(30 * cores))
    few = spark.range(10 * cores, numPartitions=1).toDF("id")
    assert tables.dealt(few, "id") is few
