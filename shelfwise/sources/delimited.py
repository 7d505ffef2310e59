"""Reading the delimited weekly files and turning them into partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schemas

FEED_FILE = r"^(.+?)(\d{6})\.csv$"
SNAPSHOT_FILE = r"^.+?_(\d\d...\d\d)\.csv$"
# heads of files read at a time
HEAD_READERS = 16

# Spanish month names that differ from the English ones.
MONTHS = {"Ene": "Jan", "Abr": "Apr", "Ago": "Aug", "Dic": "Dec"}


def delimited_options(null_marker: str | None = "NA", comment: str | None = "#") -> dict[str, str]:
    options = {"header": "true", "sep": "|", "quote": '"', "encoding": "UTF-8", "mode": "PERMISSIVE"}
    if null_marker is not None:
        options["nullValue"] = null_marker
    if comment is not None:
        options["comment"] = comment
    return options


def _typed(column: Column, kind: T.DataType) -> Column:
    # ids may be written as 123.0
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return F.coalesce(column.try_cast(kind), column.try_cast("double").try_cast(kind))
    return column.try_cast(kind)


def apply_schema(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` from a table of text columns, whatever their headings.

    Columns the file does not have become null; text that does not parse becomes null.
    """
    present = {name.lower(): name for name in raw.columns}
    columns = []
    for field in schema.fields:
        names = (field.name, *schemas.HEADINGS.get(field.name, ()))
        found = next((present[n.lower()] for n in names if n.lower() in present), None)
        value = F.lit(None) if found is None else _typed(F.col(f"`{found}`"), field.dataType)
        columns.append(value.cast(field.dataType).alias(field.name))
    kept = [c for c in raw.columns if c.startswith("_file")]
    return raw.select(*columns, *kept)


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    null_marker: str | None = "NA",
    comment: str | None = "#",
    file_glob: str | None = None,
    with_file_name: bool = False,
) -> DataFrame:
    """Files with a heading line, separated by ``|``. Types come from ``schema``, never inferred.

    Every file is read by its own heading: files that share one are a scan, and the scans are
    a union. Without any file the result is empty and has the columns of ``schema``.
    """
    options = delimited_options(null_marker, comment)
    scans = []
    for files in _by_heading(spark, path, file_glob, comment):
        # a file that changes in the meantime fails instead of mixing up its columns
        raw = spark.read.options(**options, enforceSchema="false").csv(files)
        if with_file_name:
            raw = raw.select("*", F.col("_metadata.file_name").alias("_file"))
        scans.append(apply_schema(raw, schema))
    if not scans:
        extra = [T.StructField("_file", T.StringType())] if with_file_name else []
        return spark.createDataFrame([], T.StructType([*schema.fields, *extra]))
    return reduce(DataFrame.unionByName, scans)


def _by_heading(
    spark: SparkSession, path: str | Sequence[str], file_glob: str | None, comment: str | None
) -> list[list[str]]:
    """The files of a folder, those with the same heading together.

    Files are listed without being opened, and of each only the head is read, through the
    file system that holds it: one line per file, however long the files are.
    """
    reader = spark.read.format("binaryFile")
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    files = sorted(row.path for row in reader.load(path).select("path").collect())
    if not files:
        return []
    with ThreadPoolExecutor(min(len(files), HEAD_READERS)) as pool:
        headings = list(pool.map(lambda file: first_line(spark, file, comment), files))
    grouped: dict[str, list[str]] = {}
    for file, heading in zip(files, headings):
        if heading is not None:
            grouped.setdefault(heading, []).append(file)
    return [grouped[heading] for heading in sorted(grouped)]


def first_line(spark: SparkSession, file: str, comment: str | None = None) -> str | None:
    """First line of a file that is neither empty nor a comment; None if there is none.

    A buffered stream is read up to that line and closed, so a few kilobytes of any file; packed
    files are unpacked as Spark does, by their ending.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    if codec is not None:
        stream = codec.createInputStream(stream)
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        while (line := lines.readLine()) is not None:
            line = line.removeprefix("\ufeff")
            if line and not (comment is not None and line.startswith(comment)):
                return line
        return None
    finally:
        lines.close()


def _weeks_glob(prefix: str, periods: Sequence[int]) -> str:
    return f"{prefix}{{{','.join(str(p) for p in periods)}}}.csv"


def read_sales(spark: SparkSession, root: str, periods: Sequence[int], raw: bool = False) -> DataFrame:
    """Sales of the given weeks. A week without a file gives no rows.

    Only the files of those weeks are opened. ``raw`` keeps the closing stock.
    """
    sales = read_delimited(
        spark, f"{root}/ventas", schemas.SALES, file_glob=_weeks_glob("ventas", periods), with_file_name=True
    )
    year = (F.regexp_extract("_file", FEED_FILE, 2).cast("int") / 100).cast("int")
    sales = sales.withColumn("period", year * 100 + F.pmod("period", F.lit(100))).drop("_file")
    return sales if raw else sales.drop("closing_stock")


def feed_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Every feed file with its source and week. Only names are read, no content."""
    names = (
        spark.read.format("binaryFile")
        .load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("file"))
    )
    return names.filter(F.col("file").rlike(FEED_FILE)).select(
        "file",
        F.regexp_extract("file", FEED_FILE, 1).alias("source"),
        F.regexp_extract("file", FEED_FILE, 2).cast("int").alias("period"),
    )


def feed_sources(inventory: DataFrame, period: int) -> DataFrame:
    return inventory.filter(F.col("period") == period).select("source").distinct()


def feed_periods(inventory: DataFrame, source: str) -> DataFrame:
    return inventory.filter(F.col("source") == source).select("period").distinct()


def read_competitor_prices(
    spark: SparkSession, root: str, periods: Sequence[int], suffix: str = ""
) -> DataFrame:
    """Competitor prices of the given weeks from all feeds.

    Feeds head their columns differently; each file is read by its own heading. ``suffix`` is
    added to store, price and source.
    """
    files = read_delimited(
        spark,
        f"{root}/preciosCompetencia",
        schemas.COMPETITOR_PRICES,
        file_glob=_weeks_glob("*", periods),
        with_file_name=True,
    ).filter(F.col("_file").rlike(FEED_FILE))
    out = files.select(
        F.regexp_extract("_file", FEED_FILE, 2).cast("int").alias("period"),
        "upc",
        "comp_store",
        "comp_price",
        F.regexp_extract("_file", FEED_FILE, 1).alias("comp_source"),
    )
    if suffix:
        out = out.withColumnsRenamed(
            {c: c + suffix for c in ("comp_store", "comp_price", "comp_source")}
        )
    return out


def competitor_store_catalogue(prices: DataFrame, source: str) -> DataFrame:
    """Competitor stores of one feed, over all its weeks."""
    return prices.filter(F.col("comp_source") == source).select("comp_store").distinct()


def snapshot_day(name: Column) -> Column:
    """Day of an inventory file named ``..._ddMMMyy.csv`` with a Spanish month."""
    text = F.regexp_extract(name, SNAPSHOT_FILE, 1)
    for spanish, english in MONTHS.items():
        text = F.replace(text, F.lit(spanish), F.lit(english))
    return F.try_to_timestamp(text, F.lit("ddMMMyy")).cast("date")


def inventory_files(spark: SparkSession, root: str) -> DataFrame:
    names = (
        spark.read.format("binaryFile")
        .load(f"{root}/inventarios")
        .select(F.element_at(F.split("path", "/"), -1).alias("file"))
    )
    dated = names.withColumn("snapshot_date", snapshot_day(F.col("file")))
    return dated.filter(F.col("snapshot_date").isNotNull())


def pick_snapshot(spark: SparkSession, root: str, day: date) -> tuple[date, str] | None:
    """(day, file) of the newest inventory not after ``day``. One row of file names."""
    known = inventory_files(spark, root).filter(F.col("snapshot_date") <= F.lit(day))
    row = known.agg(F.max(F.struct("snapshot_date", "file")).alias("newest")).first()
    return (row.newest.snapshot_date, row.newest.file) if row and row.newest else None


def read_inventory(spark: SparkSession, root: str, file: str, default_day: date | None = None) -> DataFrame:
    """One inventory file; rows without a date get ``default_day``.

    Dates may be plain or written like ``Mon Jan 15 00:00:00 UTC 2018``.
    """
    as_text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == "stock_date" else f.dataType) for f in schemas.INVENTORY]
    )
    raw = read_delimited(spark, f"{root}/inventarios/{file}", as_text)
    parts = F.regexp_extract("stock_date", r"^\w{3} (\w{3}) (\d\d) \d\d:\d\d:\d\d \S+ (\d{4})$", 0)
    long_form = F.regexp_replace(parts, r"^\w{3} (\w{3}) (\d\d) \d\d:\d\d:\d\d \S+ (\d{4})$", "$2 $1 $3")
    day = F.coalesce(
        F.col("stock_date").try_cast("date"), F.try_to_timestamp(long_form, F.lit("dd MMM yyyy")).cast("date")
    )
    return raw.withColumn("stock_date", F.coalesce(day, F.lit(default_day).cast("date")))

