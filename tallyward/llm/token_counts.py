"""Token counts: batches go through the tokenizer, only lengths come back.

Texts are cut at white space, where no token can span, so that a text of any length
is counted in pieces.  The pieces a batch has in common are encoded once; what is
new goes to the library in calls of about equal bytes.

NULL and empty texts have no bytes and no tokens.  Each row is counted by itself, so repeated
rows give equal results; an empty table gives no rows, further columns are left out.
"""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tallyward.llm.common import by_bytes, cut, map_batches, texts_of

LIMIT = 2048
#: Bytes that one call of the library gets.
CALL_BYTES = 1 << 18
#: Distinct pieces whose counts a worker remembers.
REMEMBERED = 1_000_000

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Counter:
    """Counts tokens of texts; keeps the counts of pieces between white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, int] = {}

    def learn(self, words: set[bytes]) -> None:
        new = [word for word in words if word not in self.known]
        if not new:
            return
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(words)
        texts = [word.decode() for word in new]
        for start, end in by_bytes(texts, CALL_BYTES):
            encoded = self.tokenizer.encode_batch_fast(texts[start:end], add_special_tokens=False)
            self.known.update(zip(new[start:end], map(len, encoded), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        counts: list[int] = []
        for start, end in by_bytes(texts):
            if end - start == 1:  # perhaps a long text: piece by piece
                counts.append(sum(sum(self._counts([piece])) for piece in cut(texts[start])))
            else:
                counts += self._counts(texts[start:end])
        return counts

    def _counts(self, texts: list[str]) -> list[int]:
        words = [text.encode().split() for text in texts]
        self.learn(set().union(*words))
        lookup = self.known.__getitem__
        return [sum(map(lookup, each)) for each in words]


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter per worker process and file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """One row per document: its UTF-8 bytes, its tokens, and whether they exceed `limit`.

    `path` names a tokenizer file whose pre-tokenizer separates at white space and
    drops it, at the same place on every machine.  Special strings inside texts
    count as the library counts them by default.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch.column(1))
        counts = counter(path).count(texts)
        sizes = pc.fill_null(pc.cast(pc.binary_length(batch.column(1)), pa.int64()), 0)
        return pa.RecordBatch.from_arrays(
            [
                pc.cast(batch.column(0), pa.int64()),
                sizes,
                pa.array(counts, pa.int64()),
                pa.array([count > limit for count in counts]),
            ],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return map_batches(docs, [id_col, text_col], work, SCHEMA)
