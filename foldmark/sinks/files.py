"""Rows as files of their own: a sink for images and model files, through Spark's Python data source API."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from foldmark.functions.png import encode_png
from foldmark.operators.contracts import fail_if
from foldmark.schemas import ID
from foldmark.sources.images import image_path

FORMAT = "named_files"
#: Bytes of pixels, and files, that a worker encodes at a time.
OUT_BYTES = 8 << 20
OUT_ROWS = 1024


@dataclass
class Written(WriterCommitMessage):
    """What a task has put in its place."""

    files: int


class NamedFilesWriter(DataSourceArrowWriter):
    """A file per row of (path, content).

    A file appears whole or not at all: it is written beside its place, under a name of the attempt, and moved. A row that
    is written again, by a retried task, replaces the file with the same content.
    """

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import uuid

        from pyarrow import fs

        files, attempt, folders = 0, uuid.uuid4().hex, set()
        for batch in iterator:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                path = path.as_py()
                store, place = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:/") else f"file://{path}")
                folder, _, name = place.rpartition("/")
                if folder not in folders:
                    store.create_dir(folder, recursive=True)
                    folders.add(folder)
                beside = f"{folder}/.{name}.{attempt}"
                with store.open_output_stream(beside) as out:
                    out.write(content.as_buffer())
                store.move(beside, place)
                files += 1
        return Written(files)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter()


def write_files(df: DataFrame) -> None:
    """Every row (path, content) as a file; the folder is one that executors share, by any address that Arrow's file systems know."""
    df.sparkSession.dataSource.register(NamedFiles)
    df.select("path", "content").write.format(FORMAT).mode("append").save()


def encoded_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, content) of a task's images, by about OUT_BYTES of pixels or OUT_ROWS files."""

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(content, pa.binary())], names=["path", "content"])

    for batch in batches:
        paths, content, size = [], [], 0
        for path, *shape, data in zip(*(batch.column(c) for c in ("path", "height", "width", "n_channels", "data")), strict=True):
            stored = np.frombuffer(data.as_buffer(), np.uint8).reshape([n.as_py() for n in shape])
            paths.append(path.as_py())
            # Stored BGR(A) becomes RGB(A).
            content.append(encode_png(stored if stored.shape[2] == 1 else stored[:, :, [2, 1, 0, 3][: stored.shape[2]]]))
            size += stored.nbytes
            if size >= OUT_BYTES or len(content) >= OUT_ROWS:
                yield packed()
                paths, content, size = [], [], 0
        if content:
            yield packed()


def png_files(images: DataFrame, roots: str | Mapping[str, str], suffix: str = ".png") -> DataFrame:
    """(path, content) of images as PNG files, under one root or the root of the row's dataset; no root is an error."""
    path = image_path(roots, F.col(ID), F.col("dataset"), suffix)
    rows = images.select(fail_if(path.isNull(), "no root for the dataset of image", ID, path).alias("path"), "height", "width", "n_channels", "data")
    return rows.mapInArrow(encoded_batches, "path string, content binary")


def write_images(images: DataFrame, roots: str | Mapping[str, str], suffix: str = ".png") -> None:
    """Pixel arrays as PNG files that ``read_images`` reads back: ``{root}/{image_name}.png``."""
    write_files(png_files(images, roots, suffix))
