from __future__ import annotations

import datetime as dt

from ledgerlint.sources.schema import LINE_SCHEMA

DAY = dt.datetime(2010, 6, 1)

# invoice, stockcode, description, quantity, day offset, price, customer, country
FIVE = [
    ("489434", "21232", "Product A", 2, 0, 10.5, "12345", "United Kingdom"),
    ("489435", "21233", "TEST PRODUCT", 1000, 1, 20.0, "12346", "France"),
    ("C489436", "21234", "Product C", -1, 2, 15.0, None, "Germany"),
    ("489437", "21235", "Product D", 3, 3, 10000.5, "12348", "United States"),
    ("489438", "21236", "Product E", 0, 4, 0.0, "12349", "United Kingdom"),
]


def line(row=None, **changes):
    base = dict(
        zip(
            ("invoice", "stockcode", "description", "quantity", "day", "price",
             "customer_id", "country"),
            row or FIVE[0],
        )
    )
    base["source_year"] = "2009-2010"
    base.update(changes)
    if "invoicedate" not in base:
        day = base["day"]
        base["invoicedate"] = None if day is None else DAY + dt.timedelta(days=day)
    return tuple(base[f.name] for f in LINE_SCHEMA.fields)


def lines(spark, rows):
    return spark.createDataFrame(rows, LINE_SCHEMA)


def five(spark, **changes_to_last):
    rows = [line(r) for r in FIVE[:-1]] + [line(FIVE[-1], **changes_to_last)]
    return lines(spark, rows)


def column(df, name):
    return [r[name] for r in df.select(name).collect()]
