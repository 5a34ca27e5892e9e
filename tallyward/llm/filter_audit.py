"""Audit of how document filters interact, over a sparse document-term matrix.

The matrix is kept as compressed rows (CSR): a shard has the counts of some documents' words,
and columns are numbers of one dictionary over all documents.  A shard first numbers its
words itself; only its distinct words, not their occurrences, move to be numbered over all
shards, so a word that all documents share is one row per shard.  A shard leaves its task in
pieces of some documents and the words that are new with them: what a task holds of a shard
is its distinct words and one piece.

Five filters are judged for every document: A and B by the matrix (row sums and numbers of
nonzero cells), C and D by characters, E by the least id among equal texts.  What a document
fails is a set of five bits.  Documents are counted by part, set and labels, and the counts
of a part answer all orders of the filters.

NULL texts are empty, NULL parts the empty string.  A row with a NULL id neither equals a
smaller id's text nor is a smaller id, and has no labels.  Repeated rows count each; they are
no copies of each other, as their ids are equal.  An id with several labels has all of them.
A text is never cut: a very long one is a shard of its own.  Without documents there are
no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice, permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyward.llm.common import by_lengths
from tallyward.session import scratch_path

FILTERS = "ABCDE"
#: The bit of each filter in the set of those that a document fails.
BITS = {name: 1 << at for at, name in enumerate(FILTERS)}
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
#: Bytes of text that a shard has about.
SHARD = 1 << 24

_SYMBOL = re.compile(rb"[#$%&*|]")
_NO_CAPITAL = bytes(set(range(256)) - set(range(65, 91)))
_LATER_BYTE = bytes(range(0x80, 0xC0))

#: Of the documents of a piece or a shard, and where the row of each starts.
_ROWS = [
    ("ids", pa.list_(pa.int64())), ("parts", pa.list_(pa.string())), ("fails", pa.list_(pa.int32())),
    ("digests", pa.list_(pa.binary())), ("starts", pa.list_(pa.int64())),
]
_LOCAL = pa.schema(
    [("shard", pa.int64()), ("piece", pa.int32()), ("known", pa.int32()), ("words", pa.list_(pa.binary())), *_ROWS]
    + [("columns", pa.binary()), ("counts", pa.binary())]
)
_LOCAL_DDL = (
    "shard long, piece int, known int, words array<binary>, ids array<long>, parts array<string>, fails array<int>, "
    "digests array<binary>, starts array<long>, columns binary, counts binary"
)
#: A shard: its documents, where the row of each starts, columns in ascending order, counts.
MATRIX = (
    "shard long, ids array<long>, parts array<string>, fails array<int>, digests array<binary>, "
    "starts array<long>, columns array<long>, counts array<int>"
)
_COUNTED = "id long, part string, digest binary, fails int, n_words long, n_distinct long"


def fails_by_characters(text: bytes) -> int:
    capitals = len(text.translate(None, _NO_CAPITAL))
    shouts = 100 * capitals > MOST_CAPITALS * len(text.translate(None, _LATER_BYTE))
    return BITS["C"] * shouts + BITS["D"] * bool(_SYMBOL.search(text))


def planes(values: np.ndarray) -> bytes:
    """Whole numbers by place of their bytes, which leaves runs of zeros to the compression."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


class Shard:
    """Documents' words as compressed rows, a piece at a time; columns are numbers of the
    shard's own words."""

    def __init__(self, shard: int) -> None:
        self.shard = shard
        self.number: dict[bytes, int] = {}
        self.pieces = 0

    def piece(self, ids: list, parts: list, texts: list[bytes]) -> pa.RecordBatch:
        """The rows of these documents, with the words that the pieces before do not have."""
        number, known = self.number, len(self.number)
        words = [text.split() for text in texts]
        flat = [number.setdefault(word, len(number)) for word in chain.from_iterable(words)]
        row = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        width = max(1, len(number))
        cells, counts = np.unique(row * width + np.array(flat, np.int64), return_counts=True)
        row, columns = np.divmod(cells, width)
        starts = np.append(0, np.cumsum(np.bincount(row, minlength=len(words))))
        # Columns ascend in a row, so all but a row's first are steps from the one before.
        steps = np.diff(columns, prepend=0)
        first = starts[:-1][np.diff(starts) > 0]
        steps[first] = columns[first]
        new = list(islice(reversed(number), len(number) - known))[::-1]
        fails = [fails_by_characters(text) for text in texts]
        digests = [hashlib.sha256(text).digest() for text in texts]
        values = [self.shard, self.pieces, known, new, ids, parts, fails, digests, starts, planes(steps), planes(counts)]
        self.pieces += 1
        return pa.RecordBatch.from_arrays(
            [pa.array([value], field.type) for value, field in zip(values, _LOCAL, strict=True)], schema=_LOCAL
        )


def local_shards(docs: DataFrame, part: Column, id_col: str, text_col: str) -> DataFrame:
    """Shards in pieces, whose columns are numbers of the shard's own words in order of first
    occurrence; `known` of them are in the pieces before, `words` has those that follow."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = Shard(TaskContext.get().partitionId() << 33), 0
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for a, b in by_lengths(lengths):
                if held >= SHARD:
                    shard, held = Shard(shard.shard + 1), 0
                ids, parts, own = (column.slice(a, b - a).to_pylist() for column in (*batch.columns[:2], texts))
                yield shard.piece(ids, parts, [text or b"" for text in own])
                held += sum(lengths[a:b])

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), part.alias("part"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, _LOCAL_DDL)


def number_words(local: DataFrame) -> DataFrame:
    """(of, place, number, word): the number of each shard's words over all shards; the word
    itself is on one row of each number, so that those rows are the dictionary.

    Rows are numbered in the order of words in their task, so a task that runs again gives
    the same numbers, and no word's rows are held together.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, last = TaskContext.get().partitionId() << 40, None
        for batch in batches:
            words = batch.column(2)
            if not len(words):
                continue
            new = np.append(words[0].as_py() != last, pc.not_equal(words.slice(1), words.slice(0, len(words) - 1)))
            new = new.astype(bool)
            numbers = number + np.cumsum(new)
            number, last = int(numbers[-1]), words[-1].as_py()
            kept = pc.if_else(pa.array(new), words, pa.scalar(None, words.type))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(numbers), kept], names=["of", "place", "number", "word"]
            )

    words = local.select(F.col("shard").alias("of"), "known", F.posexplode("words").alias("at", "word"))
    words = words.select("of", (F.col("known") + F.col("at")).alias("place"), "word")
    ordered = words.repartition("word").sortWithinPartitions("word")
    return ordered.mapInArrow(run, "of long, place int, number long, word binary")


class Numbered:
    """The pieces of a shard by the dictionary's numbers."""

    def __init__(self, numbers: pa.Table, shard: pa.Table):
        self.number = np.empty(numbers.num_rows, np.int64)
        self.number[numbers["place"].to_numpy()] = numbers["number"].to_numpy()
        # Numbers ascend with their rank, so that places by rank sort as they do.
        self.rank = np.empty(len(self.number), np.int64)
        self.rank[np.argsort(self.number)] = np.arange(len(self.number))
        self.shard = shard

    def rows(self) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
        """Each piece, where its rows start, columns by the dictionary, ascending in a row, and
        counts."""
        for at in np.argsort(self.shard["piece"].to_numpy()).tolist():
            piece = self.shard.slice(at, 1)
            starts = _flat(piece, "starts").to_numpy()
            steps, counts = (from_planes(piece[name][0].as_py()) for name in ("columns", "counts"))
            total = np.cumsum(steps)
            first = starts[:-1][np.diff(starts) > 0]
            columns = total - np.repeat(total[first] - steps[first], np.diff(np.append(first, len(total))))
            row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            order = np.argsort(row * max(1, len(self.number)) + self.rank[columns])
            yield piece, starts, self.number[columns[order]], counts[order]


def _flat(piece: pa.Table, name: str) -> pa.Array:
    """What a piece has in a list."""
    return pc.list_flatten(piece[name]).combine_chunks()


def _global_shard(numbers: pa.Table, shard: pa.Table) -> pa.Table:
    held, starts = [], np.zeros(1, np.int64)
    for piece, own, columns, counts in Numbered(numbers, shard).rows():
        starts = np.append(starts, starts[-1] + own[1:])
        lists = [_flat(piece, name) for name, _ in _ROWS[:-1]]
        held.append([*lists, pa.array(columns), pa.array(counts.astype(np.int32))])
    *lists, columns, counts = (pa.concat_arrays(column) for column in zip(*held, strict=True))
    names = ["shard", *(name for name, _ in _ROWS), "columns", "counts"]
    whole = [pa.ListArray.from_arrays(pa.array([0, len(each)], pa.int32()), each) for each in (*lists, pa.array(starts), columns, counts)]
    return pa.table([shard["shard"].combine_chunks().slice(0, 1), *whole], names=names)


def _counted_rows(numbers: pa.Table, shard: pa.Table) -> pa.Table:
    names = ["id", "part", "digest", "fails", "n_words", "n_distinct"]
    found = []
    for piece, starts, columns, counts in Numbered(numbers, shard).rows():
        total = np.append(0, np.cumsum(counts))
        # A row's nonzero cells are its distinct columns, which ascend.
        new = np.append(True, columns[1:] != columns[:-1])[: len(columns)]
        new[starts[:-1][np.diff(starts) > 0]] = True
        distinct = np.append(0, np.cumsum(new))
        own = [_flat(piece, name) for name in ("ids", "parts", "digests", "fails")]
        sums = [pa.array(np.diff(each[starts])) for each in (total, distinct)]
        found.append(pa.table([*own, *sums], names=names))
    return pa.concat_tables(found)


def _with_numbers(local: DataFrame, numbers: DataFrame, work: Callable, schema: str) -> DataFrame:
    shards = local.drop("words").groupBy("shard")
    return numbers.select("of", "place", "number").groupBy("of").cogroup(shards).applyInArrow(work, schema)


def write_matrix(
    docs: DataFrame, target: str, part: Column, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The dictionary (word, number) and the matrix (`MATRIX`), written to `target`."""
    spark = docs.sparkSession
    local_shards(docs, part, id_col, text_col).write.parquet(f"{target}/local")
    local = spark.read.parquet(f"{target}/local")
    number_words(local).write.parquet(f"{target}/numbers")
    numbers = spark.read.parquet(f"{target}/numbers")
    _with_numbers(local, numbers, _global_shard, MATRIX).write.parquet(f"{target}/matrix")
    return numbers.filter("word IS NOT NULL").select("word", "number"), spark.read.parquet(f"{target}/matrix")


def row_counts(
    docs: DataFrame, target: str, part: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: id, part, digest, fails, and n_words and n_distinct from its row of the
    matrix, which is not kept."""
    local_shards(docs, part, id_col, text_col).write.parquet(f"{target}/local")
    local = docs.sparkSession.read.parquet(f"{target}/local")
    return _with_numbers(local, number_words(local), _counted_rows, _COUNTED)


def _by_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, part, digest, fails, n, good, toxic): equal rows counted, with the id's labels."""
    counted = rows.groupBy("id", "part", "digest", "fails").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    # Rows without an id meet no label, and would all meet in one task.
    known = counted.filter("id IS NOT NULL").join(marks, "id", "left")
    unknown = counted.filter("id IS NULL")
    no = F.lit(False)
    return known.unionByName(unknown, allowMissingColumns=True).withColumns(
        {"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)}
    )


def _count_sets(marked: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): documents by the set of filters they fail, E included.

    Copies are added up by text, part and labels before a text's least id is looked for, so
    that a text with very many copies is a few rows.
    """
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    no_id = F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0))
    groups = marked.groupBy("digest", "part", "fails", "good", "toxic").agg(
        F.sum("n").alias("n"), first.alias("first"), no_id.alias("no_id")
    )
    least = F.min("first.id").over(Window.partitionBy("digest"))
    unlike = F.col("no_id") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    parts = F.array(
        F.struct(F.col("fails"), unlike.alias("n")),
        F.struct(F.col("fails").bitwiseOR(BITS["E"]).alias("fails"), (F.col("n") - unlike).alias("n")),
    )
    split = groups.withColumn("least", least).select("part", "good", "toxic", F.explode(parts).alias("set"))
    n = F.col("set.n")
    return split.groupBy("part", F.col("set.fails").alias("fails")).agg(
        F.sum(n).alias("n"),
        F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"),
    )


def audit_orders(sets: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from counts by failed set."""
    orders = F.array(*[F.lit("".join(order)) for order in permutations(FILTERS)])
    steps = sets.select("*", F.explode(orders).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))

    def bits(names: Column) -> Column:
        found = F.lit(0)
        for name, bit in BITS.items():
            found = found + F.when(F.contains(names, F.lit(name)), bit).otherwise(0)
        return found

    order, step, fails = F.col("filter_order"), F.col("step"), F.col("fails")
    steps = steps.withColumns(
        {"own": bits(order.substr(step, F.lit(1))), "earlier": bits(order.substr(F.lit(1), step - 1))}
    )
    failed = fails.bitwiseAND(F.col("own")) != 0
    gone = fails.bitwiseAND(F.col("earlier")) != 0
    removed = failed & ~gone

    def total(when: Column, of: str) -> Column:
        return F.sum(F.when(when, F.col(of)).otherwise(0)).alias("total")

    counted = steps.groupBy("part", "filter_order", "step", "own").agg(
        total(~failed & ~gone, "n").alias("kept"),
        total(removed, "n").alias("removed"),
        total(failed & gone, "n").alias("redundant"),
        total(fails == F.col("own"), "n").alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "own")).alias("shapley")
    return counted.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley
    )


def filter_audit(
    docs: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All orders of the five filters over `docs`, one row per part, order and step."""
    spark: SparkSession = docs.sparkSession
    target = scratch_path(spark, "audit")
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    rows = row_counts(docs, target, part, id_col, text_col)
    short = F.when(F.col("n_words") < LEAST_WORDS, BITS["A"]).otherwise(0)
    repeats = F.when(100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"), BITS["B"]).otherwise(0)
    judged = rows.select("id", "part", "digest", (F.col("fails") + short + repeats).alias("fails"))
    judged.write.parquet(f"{target}/judged")
    return audit_orders(_count_sets(_by_labels(spark.read.parquet(f"{target}/judged"), labels)))
