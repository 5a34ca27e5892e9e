"""What the operators share: reading tables, batch maps, and cutting long texts."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Bytes of text that a batch function works on at a time, and the longest piece of one text.
PIECE_BYTES = 1 << 20

_CUT = re.compile(r"(?<=\S) (?=\S)")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Batch functions refer to it; where it is not installed on every machine, Spark's
    own file distribution brings it there.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="tallyward-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.realpath(os.path.join(folder, "tallyward.zip"))
    with zipfile.ZipFile(archive, "w") as file:
        for inner, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(inner, name)
                    file.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts_of(column: pa.Array) -> list[str]:
    """The strings of a column, empty where NULL."""
    return [text or "" for text in column.to_pylist()]


def quoted(name: str) -> str:
    """A column's name as one part, whatever is in it."""
    return "`" + name.replace("`", "``") + "`"


def map_batches(
    frame: DataFrame, columns: list[str], work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """Apply `work` to every Arrow batch of the named columns.

    `work` sees them by place: a batch function cannot take names with dots.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    chosen = [F.col(quoted(name)).alias(f"c{at}") for at, name in enumerate(columns)]
    return frame.select(*chosen).mapInArrow(run, schema)


def cut(text: str, size: int = PIECE_BYTES) -> Iterator[str]:
    """Pieces of `text` of about `size` characters that joined give it again.

    A cut is made only before a single space between two characters that are not
    white space; a text without such a place stays whole.
    """
    start = 0
    while len(text) - start > size:
        found = _CUT.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def by_bytes(texts: list[str], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about `limit` characters each."""
    return by_lengths(list(map(len, texts)), limit)


def by_lengths(lengths: list[int], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of these lengths, with about `limit` each."""
    start = held = 0
    for at, length in enumerate(lengths):
        if held and held + length > limit:
            yield start, at
            start, held = at, 0
        held += length + 16
    if start < len(lengths):
        yield start, len(lengths)
