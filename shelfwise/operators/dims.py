"""Catalogues: one deterministic row per key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.operators.picks import latest_rows, one_per_key

STORE_ATTRIBUTES = ["store_name", "format", "region", "zone", "store_type"]


@dataclass(frozen=True)
class Catalogues:
    stores: DataFrame
    skus: DataFrame
    store_deciles: DataFrame
    national_deciles: DataFrame
    taxes: DataFrame
    matrix: DataFrame
    promo_limits: DataFrame
    margins: DataFrame
    price_groups: DataFrame
    exceptions: DataFrame


def stores(raw: DataFrame, order: list[str] | None = None) -> DataFrame:
    return one_per_key(raw, ["store"], STORE_ATTRIBUTES, order or ())


def skus(raw: DataFrame) -> DataFrame:
    return one_per_key(raw, ["sku"])


def store_deciles(raw: DataFrame) -> DataFrame:
    """Deciles of the latest validity of each article and store, ties kept."""
    return latest_rows(raw, ["sku", "store"], "valid_from").select(
        "sku", "store", F.col("decile").alias("store_decile")
    )


def national_deciles(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Smallest decile per article; a label that does not end in ``D<n>`` is an error."""
    number = F.try_element_at(F.regexp_extract_all("decile", F.lit(r"D(\d+)$"), 1), F.lit(1))
    if strict:
        bad = F.raise_error(F.concat(F.lit("Unexpected decile label: "), F.col("decile")))
        number = F.when(F.col("decile").isNotNull() & number.isNull(), bad).otherwise(number)
    return (
        raw.select("sku", "upc", number.cast("int").alias("_decile"))
        .groupBy("sku", "upc")
        .agg(F.min("_decile").alias("national_decile"))
    )


def taxes(raw: DataFrame) -> DataFrame:
    return one_per_key(raw, ["sku"], ["iva", "ieps"]).fillna(0.0, ["iva", "ieps"])


def competition_matrix(raw: DataFrame) -> DataFrame:
    known = raw.filter(F.col("store").isNotNull() & F.col("comp_store").isNotNull())
    return one_per_key(
        known, ["store", "priority", "dept", "subdept"], ["comp_store", "comp_source", "comp_chain"]
    )


def promo_limits(raw: DataFrame) -> DataFrame:
    return one_per_key(raw, ["dept", "subdept"], ["promo_percent"])


def empty_margins(like: DataFrame) -> DataFrame:
    """No margins yet, typed after the hierarchy columns of ``like``."""
    none = F.lit(None).cast("double").alias("target_margin")
    return like.select("dept", "subdept", "class_id", none).filter(F.lit(False))


def price_groups(raw: DataFrame) -> DataFrame:
    return one_per_key(raw, ["sku"], ["price_group"])


def exceptions(raw: DataFrame) -> DataFrame:
    return one_per_key(raw, ["sku"], ["exception"])


def read_catalogues(spark: SparkSession, root: str, matrix_file: str = "matriz_competencia.csv") -> Catalogues:
    """All catalogues of a data folder."""
    from shelfwise.sources.delimited import read_delimited

    def table(file, schema, **options):
        return read_delimited(spark, f"{root}/{file}", schema, **options)

    return Catalogues(
        stores=stores(table("cat_tiendas.csv", schemas.STORES)),
        skus=skus(table("cat_skus.csv", schemas.SKUS)),
        store_deciles=store_deciles(table("cat_deciles.csv", schemas.STORE_DECILES)),
        national_deciles=national_deciles(table("cat_deciles_nacional.csv", schemas.NATIONAL_DECILES)),
        taxes=taxes(table("cat_impuestos.csv", schemas.TAXES)),
        matrix=competition_matrix(table(matrix_file, schemas.MATRIX)),
        promo_limits=promo_limits(
            table("cat_promos.csv", schemas.PROMO_LIMITS, null_marker=None, comment=None)
        ),
        margins=spark.createDataFrame([], schemas.MARGINS),
        price_groups=price_groups(table("cat_grupos.csv", schemas.PRICE_GROUPS, null_marker="")),
        exceptions=exceptions(table("cat_excepciones.csv", schemas.EXCEPTIONS, null_marker="")),
    )
