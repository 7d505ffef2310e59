"""Small things the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, or ``name`` with underscores before it until no column has it."""
    lowered = {t.lower() for t in taken}
    while name.lower() in lowered:
        name = "_" + name
    return name


def quoted(name: str) -> Column:
    """The column of that name, dots in it or not."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns_of(docs: DataFrame) -> list[Column]:
    """All columns by name, whatever is in their names."""
    return [quoted(c).alias(c) for c in docs.columns]


def whole_text(name: str = "text") -> Column:
    """The text of a row; a missing one is empty."""
    return F.coalesce(quoted(name), F.lit(""))


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under names no other column can clash with."""
    return docs.select(quoted(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
