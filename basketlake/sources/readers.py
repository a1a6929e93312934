"""Transaction files to the raw layer."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlake.functions.parsers import parse_decimal, parse_int, parse_invoice_date, strip_excel_eq
from basketlake.schemas import CSV_COLUMNS, CSV_TEXT, RAW_COLUMNS
from basketlake.sources import sinks

ENCODING = "ISO-8859-1"
#: The mark some programs put before a text, as Latin-1 shows it.
BOM = "\u00ef\u00bb\u00bf"


def csv_options(reader):
    """With a declared schema, a header that names other columns, or in another order, is an error."""
    return reader.schema(CSV_TEXT).option("enforceSchema", False).option("header", True).option("encoding", ENCODING).option("escape", '"').option("multiLine", True)


def rename_by_position(df: DataFrame) -> DataFrame:
    """Eight columns under any header, taken in file order."""
    return df.toDF(*RAW_COLUMNS)


def rename_by_name(df: DataFrame) -> DataFrame:
    """Columns picked by their header; other columns are dropped."""
    return df.select(*[F.col(c).alias(n) for c, n in zip(CSV_COLUMNS, RAW_COLUMNS)])


def typed(text: DataFrame, excel: bool = False) -> DataFrame:
    """Text columns to raw types; a value that does not parse becomes NULL.

    ``excel=True`` also strips the leading '=' a spreadsheet export leaves and
    reads the customer number as a whole number.
    """
    keep = strip_excel_eq if excel else (lambda c: c)
    c = {n: keep(F.col(n)) for n in RAW_COLUMNS}
    customer = parse_int(c["customer_id"], "bigint").cast("string") if excel else c["customer_id"]
    return text.select(
        c["invoice_no"].alias("invoice_no"),
        c["stock_code"].alias("stock_code"),
        "description",
        parse_int(c["quantity"]).alias("quantity"),
        parse_invoice_date(c["invoice_date"]).alias("invoice_date"),
        parse_decimal(c["unit_price"]).alias("unit_price"),
        customer.alias("customer_id"),
        "country",
    )


def csv_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a folder, of a pattern, or the file itself; names with a leading dot or underscore are none."""
    jvm = spark._jvm.org.apache.hadoop.fs
    target = jvm.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out, todo = [], list(fs.globStatus(target) or [])
    if not todo:
        raise FileNotFoundError(path)
    while todo:
        status = todo.pop()
        name = status.getPath().getName()
        if status.isDirectory():
            todo += [s for s in fs.listStatus(status.getPath()) if s.getPath().getName()[0] not in "._"]
        elif name[0] not in "._" and status.getLen():
            out.append(status.getPath().toString())
    return sorted(out)


def csv_header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The column names in the first line of a file; only that line is read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(file)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.open(target)
    try:
        # Through the file system's codec, so that compressed files work too.
        codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(target)
        text = codec.createInputStream(stream) if codec is not None else stream
        line = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(text, ENCODING)).readLine()
    finally:
        stream.close()
    return tuple(c.strip() for c in next(csv.reader([(line or "").removeprefix(BOM)])))


def read_transactions_csv(spark: SparkSession, path: str, excel: bool = False, multiline: bool = True) -> DataFrame:
    """Latin-1 CSV files with a header line, whose names pick the columns.

    Files are grouped by their own header: columns may stand in any order, and further ones are left out. A file without
    one of the eight columns is an error. Quoted texts may hold line feeds; a file is then one task's work, so a few
    huge files of one-line records are better read with ``multiline=False``, which splits them.
    """
    files = csv_files(spark, path)
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: csv_header(spark, f), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for header, file in zip(headers, files, strict=True):
        if missing := [c for c in CSV_COLUMNS if c not in header]:
            raise ValueError(f"{file}: no column {missing} in its header")
        groups.setdefault(header, []).append(file)
    out = None
    for header, own in sorted(groups.items()):
        # Names of columns that are left out may repeat or be empty.
        names = [c if c in CSV_COLUMNS and header.index(c) == i else f"_other{i}" for i, c in enumerate(header)]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        reader = spark.read.schema(schema).option("header", True).option("encoding", ENCODING).option("escape", '"').option("multiLine", multiline)
        text = rename_by_name(reader.csv(own))
        out = text if out is None else out.unionByName(text)
    if out is None:
        out = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS]))
    return typed(out, excel)


def read_transactions_json(docs: DataFrame, column: str = "payload") -> DataFrame:
    """Column holding a JSON array of row objects to typed rows."""
    item = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in CSV_COLUMNS]))
    rows = docs.select(F.inline(F.from_json(F.col(column), item)))
    return typed(rename_by_name(rows))


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A table that :mod:`basketlake.sources.sinks` wrote, or plain Parquet files."""
    return sinks.read_table(spark, path, schema)
