"""Quality rules: counts of repetition and symbols, and bands of compression ratios.

The ratio of zstandard's output to its input tells apart running text, text that
repeats itself (low) and noise such as encoded data (high).  It is taken of the
whole document and of chunks of a fixed size, so that a long document cannot hide
a bad part; short texts compress less, so each length has limits of its own.

NULL and empty texts have no words and are rejected, as is every text under
`MIN_WORDS`.  Each row is judged by itself: repeated rows get the same verdict.  Very long
texts are judged whole, chunk by chunk.  Empty tables give no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

from tallyward.llm.common import map_batches, texts_of

MIN_WORDS = 50
#: Most words, of a hundred, that may lie in repeated 3-word windows.
MAX_REPEAT_PERCENT = 50
#: For texts below so many bytes: the least and the largest ratio of the whole text.
BANDS = ((512, 0.25, 0.95), (2048, 0.22, 0.85), (8192, 0.18, 0.75), (float("inf"), 0.15, 0.70))
CHUNK_BYTES = 4096
CHUNK_BAND = (0.12, 0.75)
#: Share of a document's chunks that may lie outside their band.
BAD_CHUNKS = 0.2
LEVEL = 3

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, ratio double, bad_chunks long, chunks long"
)
_SPACES = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"


@lru_cache(maxsize=1)
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    size = len(number)
    if size == n:
        return 0
    if size < 1 << 21:
        windows = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:  # the product of three would not fit: number the pairs first
        pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * size + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    repeated = np.zeros(n - 2, bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= repeated
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    lines = [line for line in lines if line.strip(_SPACES)]
    return len(lines) - len(set(lines))


def compression(data: bytes) -> tuple[float, int, int]:
    """The ratio of the whole text, the chunks outside their band, and all chunks.

    The last chunk ends with the text and overlaps the one before, so all of it is looked at.
    What lies past the last whole chunk is also taken by itself if it is at least a
    quarter of a chunk: in an overlapping chunk, text before it can hide it.
    """
    if not data:
        return 1.0, 0, 0
    compress = _compressor().compress
    ratio = len(compress(data)) / len(data)
    if len(data) <= CHUNK_BYTES:
        return ratio, 0, 1
    whole = len(data) // CHUNK_BYTES * CHUNK_BYTES
    chunks = [data[at : at + CHUNK_BYTES] for at in range(0, whole, CHUNK_BYTES)]
    if whole < len(data):
        chunks.append(data[-CHUNK_BYTES:])
    low, high = CHUNK_BAND

    def outside(chunk: bytes) -> bool:
        return not low <= len(compress(chunk)) / len(chunk) <= high

    bad = sum(map(outside, chunks))
    tail = data[whole:]
    if len(tail) >= CHUNK_BYTES // 4 and not outside(chunks[-1]):
        bad += outside(tail)
    return ratio, bad, len(chunks)


def in_bands(size: int, ratio: float, bad: int, chunks: int) -> bool:
    low, high = next((low, high) for below, low, high in BANDS if size < below)
    return low <= ratio <= high and bad <= BAD_CHUNKS * chunks


def judge(text: str) -> tuple:
    """The columns of `SCHEMA` after the id, for one text."""
    data = text.encode()
    words = data.split()
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    ratio, bad, chunks = compression(data)
    return (
        len(words),
        len(text) - sum(text.count(space) for space in _SPACES),
        sum(text.count(symbol) for symbol in _SYMBOLS),
        duplicate_lines(text),
        repeats,
        failed,
        not failed and in_bands(len(data), ratio, bad, chunks),
        ratio,
        bad,
        chunks,
    )


def _judged(batch: pa.RecordBatch) -> list[tuple]:
    return [judge(text) for text in texts_of(batch.column(batch.num_columns - 1))]


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the measures of `SCHEMA` and the verdict `kept`."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = [field.split()[0] for field in SCHEMA.split(", ")]
        columns = list(zip(*_judged(batch), strict=True))
        return pa.RecordBatch.from_arrays(
            [pc.cast(batch.column(0), pa.int64()), *map(pa.array, columns)], names=names
        )

    return map_batches(docs, [id_col, text_col], work, SCHEMA)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns unchanged, whose text the rules accept."""
    at = docs.columns.index(text_col)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch.column(at))
        return batch.filter(pa.array([judge(text)[6] for text in texts]))

    return map_batches(docs, docs.columns, work, docs.schema)
