"""Schema of the transaction table and the one place where types are set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlint.functions.columns import nan_to_null

LINE_SCHEMA = T.StructType(
    [
        T.StructField("invoice", T.StringType()),
        T.StructField("stockcode", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("invoicedate", T.TimestampNTZType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("source_year", T.StringType()),
    ]
)

LINE_COLUMNS = LINE_SCHEMA.fieldNames()

# Columns of a table under its original header names, customer ids as floats.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.LongType()),
        T.StructField("InvoiceDate", T.TimestampNTZType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("Customer ID", T.DoubleType()),
        T.StructField("Country", T.StringType()),
        T.StructField("source_year", T.StringType()),
    ]
)

# Header names of the yearly files, in file order.
RAW_COLUMNS = tuple(RAW_SCHEMA.fieldNames()[:-1])


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case column names, spaces to underscores."""
    return df.toDF(*(name.lower().replace(" ", "_") for name in df.columns))


def _as_text(field: T.StructField):
    """Text form of an identifier; whole floats lose their ``.0``."""
    column = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        whole = column == F.floor(column)
        return F.when(whole, column.cast("long").cast("string")).otherwise(
            column.cast("string")
        )
    return column.cast("string")


def typed_lines(df: DataFrame) -> DataFrame:
    """Normalised names and the declared type for every known column.

    Unknown columns are carried through. Unparsable dates become null. NaN
    becomes null once, here, so no rule downstream has to think about it.
    """
    df = nan_to_null(normalise_names(df))
    have = {f.name: f for f in df.schema.fields}
    casts = {}
    for want in LINE_SCHEMA.fields:
        field = have.get(want.name)
        if field is None or field.dataType == want.dataType:
            continue
        if isinstance(want.dataType, T.StringType):
            casts[want.name] = _as_text(field)
        else:
            casts[want.name] = F.col(want.name).try_cast(want.dataType)
    return df.withColumns(casts) if casts else df
