"""Token ids as files: fixed-width bit packing in blocks.

Every id takes the fewest bits that hold any id of the vocabulary, least significant
bit first.  A block holds whole documents and about `BLOCK_IDS` ids; it has the place
of its first id in its shard, and the id, the place and the length of each document.
A document's ids start at bit ``offset * width`` of the block, so that one document
can be unpacked without the others.  Shards are ranges of ascending document id.

Blocks are the rows of Parquet files that Spark's own writer commits, so a lost or
repeated task leaves no broken files, and any file system Spark knows will do.

NULL and empty texts are documents with the end id alone; a NULL document id comes
first, and equal ids follow each other, each with its own place.  A very long text is one
document of a block of its own; an empty table gives no blocks, further columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyward.llm.byte_bpe import encoder
from tallyward.llm.common import texts_of

BLOCK_IDS = 1 << 16
END_ID = 0
SCHEMA = (
    "shard int, block_start long, n_ids long, width int, doc_ids array<long>, "
    "offsets array<long>, lengths array<long>, packed binary"
)


def width_of(vocabulary: int) -> int:
    """The fewest bits that hold every id below `vocabulary`."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """The ids, `width` bits each, least significant bit first."""
    ids = ids.astype("<u4")
    if width in (8, 16, 32):  # the same layout, without going through bits
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(bits[:, :width].ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, width: int, start: int, count: int) -> np.ndarray:
    """`count` ids from the id at `start`."""
    if width in (8, 16, 32):
        size = width // 8
        return np.frombuffer(packed, f"<u{size}", count, start * size).astype("<u4")
    first, last = start * width, (start + count) * width
    some = np.frombuffer(packed, np.uint8)[first // 8 : (last + 7) // 8]
    bits = np.unpackbits(some, bitorder="little")[first % 8 : first % 8 + count * width]
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :width] = bits.reshape(count, width)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def write_tokens(
    docs: DataFrame, target: str, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode `docs` with the tokenizer at `path` and write the blocks to `target`."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        width = width_of(bpe.size)
        shard = TaskContext.get().partitionId()
        end = np.array([END_ID], "<u4").tobytes()
        at, held, doc_ids, parts = 0, 0, [], []

        def block() -> pa.RecordBatch:
            lengths = np.array([len(part) // 4 for part in parts], np.int64)
            ids = np.frombuffer(b"".join(parts), "<u4")
            rows = [[shard], [at], [len(ids)], [width], [doc_ids], [np.cumsum(lengths) - lengths]]
            rows += [[lengths], [pack(ids, width)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(row, kind) for row, kind in zip(rows, kinds, strict=True)], names=names
            )

        names = [field.split()[0] for field in SCHEMA.split(", ")]
        longs = pa.list_(pa.int64())
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), longs, longs, longs, pa.binary()]
        for batch in batches:
            texts = texts_of(batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), bpe.encode(texts), strict=True):
                doc_ids.append(doc_id)
                parts.append(ids + end)
                held += len(ids) // 4 + 1
                if held >= BLOCK_IDS:
                    yield block()
                    at, held, doc_ids, parts = at + held, 0, [], []
        if held:
            yield block()

    # The tie keeps a doc_id with very many rows from landing in one range.
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("id", tie).sortWithinPartitions("id", tie)
    ordered.mapInArrow(run, SCHEMA).write.mode("overwrite").parquet(target)


def read_tokens(spark: SparkSession, target: str) -> DataFrame:
    """The blocks at `target`, with the place of each block's first id among all ids."""
    blocks = spark.read.schema(SCHEMA).parquet(target)
    # One row per shard: no more than the partitions the writer had.
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("held"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("shard_start"))
    return blocks.join(F.broadcast(starts), "shard").withColumn(
        "start", F.col("shard_start") + F.col("block_start")
    )


def token_digests(blocks: DataFrame) -> DataFrame:
    """Per document in the files: doc_id, start, n_tokens and the CRC-32 of its ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, first, doc_ids, offsets, lengths, packed in zip(
                *[column.to_pylist() for column in batch.columns], strict=True
            ):
                ids = unpack(packed, width, 0, sum(lengths))
                sums = [
                    zlib.crc32(ids[offset : offset + length].tobytes())
                    for offset, length in zip(offsets, lengths, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(np.array(offsets, np.int64) + first),
                        pa.array(lengths, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    chosen = blocks.select("width", "start", "doc_ids", "offsets", "lengths", "packed")
    return chosen.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
