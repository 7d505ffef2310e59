"""The role tables as the delimited files the readers expect, named by source and week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# headings of the three feeds, as each writes its columns
PRICE_HEADINGS = {
    "S0": {"comp_store": "shop", "upc": "barcode", "comp_price": "pr"},
    "S1": {"upc": "UPC", "comp_price": "Precio", "comp_store": "Tienda"},
    "S2": {"upc": "EAN_UPC", "comp_store": "TiendaCompetencia", "comp_price": "PrecioCompetencia"},
}
SALES_HEADINGS = {"sku": "SKU", "period": "Semana", "store": "Tienda", "units": "VentaUni", "amount": "VentaPesos", "cost": "VentaCosto"}
STOCK_HEADINGS = {
    "sku": "SKU", "store": "Tienda", "stock_date": "FechaInven",
    "stock_units": "InvFinUni", "stock_value": "InvFinVta", "stock_cost": "InvFinCto",
}


def write_weekly(df: DataFrame, headings: dict[str, str], folder: str, prefix: str) -> None:
    """One file ``<prefix><week>.csv`` per week of ``df``: written by week, then named as feeds are."""
    spark = df.sparkSession
    parts = f"{folder}.parts-{prefix}"
    (
        df.select(F.col("period").alias("_week"), *(F.col(c).alias(h) for c, h in headings.items()))
        .repartition("_week")
        .write.partitionBy("_week")
        .csv(parts, sep="|", header=True, nullValue="NA")
    )
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(parts).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    for week in files.listStatus(path(parts)):
        name = week.getPath().getName()
        if name.startswith("_week="):
            (part,) = [f.getPath() for f in files.listStatus(week.getPath()) if f.getPath().getName().startswith("part-")]
            files.rename(part, path(f"{folder}/{prefix}{name.removeprefix('_week=')}.csv"))


def write_sales(sales: DataFrame, root: str) -> None:
    write_weekly(sales, SALES_HEADINGS, f"{root}/ventas", "ventas")


def write_prices(prices: DataFrame, root: str) -> None:
    for source, headings in PRICE_HEADINGS.items():
        write_weekly(prices.filter(F.col("comp_source") == source), headings, f"{root}/preciosCompetencia", source)


def write_stock(inventory: DataFrame, root: str, file: str) -> None:
    """One snapshot. Of three articles, one has no dates, one has them written out, one plain."""
    day = F.col("stock_date")
    written = (
        F.when(F.col("sku") % 3 == 0, F.lit(None).cast("string"))
        .when(F.col("sku") % 3 == 1, F.date_format(day, "EEE MMM dd 00:00:00 'CST' yyyy"))
        .otherwise(day.cast("string"))
    )
    inventory.withColumn("stock_date", written).select(
        *(F.col(c).alias(h) for c, h in STOCK_HEADINGS.items())
    ).write.csv(f"{root}/inventarios/{file}", sep="|", header=True, nullValue="NA")
