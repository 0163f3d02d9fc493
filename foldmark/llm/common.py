"""What several operators share: the columns they take from a table, and spreading of heavy rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldmark.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of a table of documents; other columns, whatever their names, stay out of the operator. Null text: empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def spread_texts(docs: DataFrame) -> DataFrame:
    """``texts`` over at least as many partitions as there are cores, dealt by a hash of the whole row."""
    return spread(texts(docs), "doc_id", "text")


def quoted(name: str) -> str:
    """A column's name as Spark reads it whatever signs it holds, dots and backticks too."""
    return "`" + name.replace("`", "``") + "`"


def keep_texts(docs: DataFrame, keep: Callable[[str], bool]) -> DataFrame:
    """The rows, with all their columns whatever their names, whose text passes (null: as an empty one), in Arrow batches."""
    plain = docs.toDF(*["text" if name == "text" else f"c{i}" for i, name in enumerate(docs.columns)])

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [keep(text or "") for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return spread(plain).mapInArrow(of_batch, plain.schema).toDF(*docs.columns)


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Arrow types of the column types that worker functions return.
ARROW = {
    "int": pa.int32(),
    "long": pa.int64(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
}


def arrow_rows(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    """Rows as a batch of the columns in ``ddl``; integers stay exact beside nulls."""
    fields = [pa.field(name, ARROW[kind]) for name, kind in (c.split() for c in ddl.split(", "))]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=pa.schema(fields))


def bounded_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of batches with about ``limit`` bytes in a text column, and one row at least."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype("i8"))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, "right")))
            yield batch.slice(at, end - at)
            at = end
