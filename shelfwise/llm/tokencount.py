"""Documents and their token counts in flat token files that have no index.

A flat file holds token ids as little-endian unsigned 16-bit numbers, document after document,
each closed by the end-of-document id. Files are read in blocks of ``BLOCK_BYTES``; a block is
searched as one numpy array for the id, and gives its separators and the tokens after the
last. What a block began in the middle of is stitched on by a prefix scan over the blocks of a
file: sums over stretches of blocks, then within each stretch, so that no task sees more than
one stretch or one row per stretch.

Tokens after the last separator of a file are a document that was not closed. An empty file
has no documents. A separator right after another closes an empty document. A file with an
odd number of bytes is an error.

``write_flat`` makes such files from documents through Spark's own text writer: a row is a
document's ids, and the line separator is the end-of-document id. A missing text is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.tables import ids_and_texts
from shelfwise.llm.tokens import default_vocabulary, tokenizer
from shelfwise.session import stage, stage_path

END_OF_DOCUMENT = 50256
BLOCK_BYTES = 8 << 20
STRETCH = 1024
ID_BYTES = 2


def _encoded(docs: DataFrame, vocabulary: tuple[str, str]) -> DataFrame:
    """(doc_id, ids) with ids as little-endian 16-bit numbers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(*vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [words.ids(t, special=False).astype("<u2").tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.mapInArrow(encode, "doc_id long, ids binary")


def write_flat(docs: DataFrame, path: str, vocabulary: tuple[str, str] | None = None, end: int = END_OF_DOCUMENT) -> None:
    """Flat token files of the documents (doc_id, text), one per partition, in the order of its rows."""
    separator = int(end).to_bytes(ID_BYTES, "little").decode("latin-1")
    (
        _encoded(docs, vocabulary or default_vocabulary())
        .select(F.col("ids").cast("string").alias("value"))
        .write.option("lineSep", separator)
        .option("encoding", "ISO-8859-1")
        .text(path)
    )


def flat_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files of a folder; only their listing is read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "length")


def _read(uri: str, since: int, count: int) -> bytes:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    system, path = pyarrow.fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as f:
        return f.read_at(count, since)


def _blocks(files: DataFrame, block_bytes: int) -> DataFrame:
    """(file, block, since, bytes) of every block."""
    last = F.ceil(F.col("length") / block_bytes) - 1
    return (
        files.filter("length > 0")
        .withColumn("odd", F.when(F.col("length") % ID_BYTES != 0, F.raise_error(F.concat(F.lit("not whole ids: "), "path"))))
        .filter("odd IS NULL")
        .select(F.col("path").alias("file"), "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
        .select(
            "file",
            "block",
            (F.col("block") * block_bytes).alias("since"),
            F.least(F.lit(block_bytes), F.col("length") - F.col("block") * block_bytes).alias("bytes"),
        )
    )


def _scanned(blocks: DataFrame, end: int) -> DataFrame:
    """(file, block, tokens, ends): tokens of each block, and the places after its separators."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(_read(row["file"], row["since"], row["bytes"]), dtype="<u2")
                ends = np.flatnonzero(ids == end).astype(np.int64) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]]),
                        pa.array([row["block"]]),
                        pa.array([len(ids)], pa.int64()),
                        pa.ListArray.from_arrays(np.array([0, len(ends)], dtype="i4"), pa.array(ends)),
                    ],
                    names=["file", "block", "tokens", "ends"],
                )

    return blocks.mapInArrow(scan, "file string, block long, tokens long, ends array<long>")


def _stitched(scanned: DataFrame) -> DataFrame:
    """What lies before each block of its file: tokens, documents, and the place of the last separator."""
    stretch = F.floor(F.col("block") / STRETCH)
    blocks = scanned.select(
        "file",
        "block",
        stretch.alias("stretch"),
        "tokens",
        F.size("ends").cast("long").alias("documents"),
        F.when(F.size("ends") > 0, F.element_at("ends", -1)).alias("last_end"),
    )
    inside = Window.partitionBy("file", "stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    before = lambda c, w: F.coalesce(F.sum(c).over(w), zero)
    # within a stretch: places counted from its first token
    near = blocks.withColumn("t0", before("tokens", inside)).withColumn("d0", before("documents", inside))
    near = near.withColumn("e0", F.max(F.col("t0") + F.col("last_end")).over(inside))
    sums = near.groupBy("file", "stretch").agg(
        F.sum("tokens").alias("tokens"), F.sum("documents").alias("documents"), F.max(F.col("t0") + F.col("last_end")).alias("last_end")
    )
    along = Window.partitionBy("file").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    far = sums.select(
        "file", "stretch", before("tokens", along).alias("t1"), before("documents", along).alias("d1"), "last_end"
    ).withColumn("e1", F.max(F.col("t1") + F.col("last_end")).over(along)).drop("last_end")
    return near.join(far, ["file", "stretch"], "inner").select(
        "file",
        "block",
        (F.col("t1") + F.col("t0")).alias("tokens_before"),
        (F.col("d1") + F.col("d0")).alias("documents_before"),
        F.coalesce(F.col("t1") + F.col("e0"), F.col("e1"), zero).alias("open_since"),
    )


def token_counts(
    spark: SparkSession, path: str, end: int = END_OF_DOCUMENT, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: file, document (from 0 in its file), start, n_tokens (without the separator), closed."""
    files = flat_files(spark, path)
    scanned = stage(_scanned(_blocks(files, block_bytes).repartition("file", "block"), end), "scanned_blocks")
    before = _stitched(scanned)
    closed = (
        scanned.join(before, ["file", "block"], "inner")
        .select("*", F.posexplode("ends").alias("nth", "place"))
        .select(
            "file",
            (F.col("documents_before") + F.col("nth")).alias("document"),
            F.when(F.col("nth") == 0, F.col("open_since"))
            .otherwise(F.col("tokens_before") + F.expr("element_at(ends, greatest(nth, 1))"))
            .alias("start"),
            (F.col("tokens_before") + F.col("place") - 1).alias("finish"),
            F.lit(True).alias("closed"),
        )
    )
    totals = scanned.groupBy("file").agg(
        F.sum("tokens").alias("finish"), F.sum(F.size("ends").cast("long")).alias("document"), F.max("block").alias("block")
    )
    final = (
        totals.join(before, ["file", "block"], "inner")
        .join(scanned.select("file", "block", "ends"), ["file", "block"], "inner")
        .select(
            "file",
            "document",
            F.when(F.size("ends") > 0, F.col("tokens_before") + F.expr("element_at(ends, greatest(size(ends), 1))"))
            .otherwise(F.col("open_since"))
            .alias("start"),
            "finish",
            F.lit(False).alias("closed"),
        )
        .filter("finish > start")
    )
    return closed.unionByName(final).select("file", "document", "start", (F.col("finish") - F.col("start")).alias("n_tokens"), "closed")


def count_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Flat files of all documents, one for each partition of their table, and what a scan finds in them.

    One row per document: file (the partition's number), document, start, n_tokens, closed.
    """
    spark = docs.sparkSession
    path = stage_path(spark, "flat_tokens")
    write_flat(ids_and_texts(docs, id_col, text_col), path)
    return token_counts(spark, path).withColumn("file", F.regexp_extract("file", r"part-(\d+)", 1).cast("int"))
