"""Spelling variants of words: k-d trees over letter-count vectors.

A run of letters (A-Z, a-z, U+00C0 to U+00FF) is lower-cased in A-Z; a run whose checksum
with the document's id divides by `SLIP` loses one letter.  Words are the distinct results
of at least `SHORTEST` letters that occur at least `FEWEST` times.  One inserted or deleted
letter changes the letter counts by one, one replaced letter by two: near words lie within
that L1 distance.

Every length has a tree that deals its words to groups of a bounded size; it is fitted on a
sample of at most `SAMPLE` words, and a word looks in every group whose box is within
reach, so the sample decides sizes only and no pair is lost.  In a group a k-d tree over
the distinct vectors finds those within reach, and the edit that two vectors allow is
carried out on the words and looked up, which verifies the order of the letters.

NULL texts have no words; a NULL id counts as the text '' in the checksum.  Repeated rows
count each time.  A very long text is one piece of work and is never cut, a very long word
makes groups of fewer words.  An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from math import log2, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyward.llm.common import map_batches
from tallyward.session import scratch_path

SLIP = 31
SHORTEST, FEWEST = 7, 2
#: How many times as frequent as a word its form is.
RATIO = 10
#: Words of the sample, words of a group, letters of a group.
SAMPLE, GROUP, GROUP_LETTERS = 50_000, 32_000, 1 << 22
#: Distinct vectors of a tree's leaf, queries and candidates handled at a time.
_LEAF, _QUERIES, _TRIALS = 16, 4096, 1 << 20
#: Distinct words after which a task hands its counts on.
_HELD = 200_000

#: Letters are single bytes in Latin-1, and all others become a question mark.
_RUN = re.compile(rb"[A-Za-z\xc0-\xff]{%d,}" % SHORTEST)


def slipped(prefix: int, run: bytes) -> bytes | None:
    """The run without the letter that the checksum names, if it names one."""
    text = run if run.isascii() else run.decode("latin-1").encode()
    checksum = zlib.crc32(text, prefix)
    if checksum % SLIP:
        return None
    at = checksum % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words of at least `SHORTEST` letters, however rare."""

    def rows(counts: Counter[bytes]) -> pa.RecordBatch:
        words = pa.array([word.decode("latin-1") for word in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                runs = _RUN.findall((text or "").encode("latin-1", "replace").lower())
                counts.update(runs)
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for each in set(runs):
                    word = slipped(prefix, each)
                    if word is not None:
                        times = runs.count(each)
                        counts[each] -= times
                        if len(word) >= SHORTEST:
                            counts[word] += times
                if len(counts) > _HELD:
                    yield rows(+counts)
                    counts.clear()
        yield rows(+counts)

    counted = docs.select(id_col, text_col).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Tree:
    """A k-d tree as arrays: boxes of the nodes, children (-1: a leaf), places of the points."""

    def __init__(self, points: np.ndarray, leaf: float, cells: bool = False):
        """Boxes hold the points closely, or with `cells` fill the space between them."""
        self.order = np.arange(len(points))
        least, most = np.iinfo(points.dtype).min // 2, np.iinfo(points.dtype).max // 2
        boxes: list[np.ndarray] = []
        nodes: list[list[int]] = []
        whole = np.array([[least] * points.shape[1], [most] * points.shape[1]], points.dtype)
        todo = [(0, len(points), -1, whole)]
        while todo:
            start, end, slot, cell = todo.pop()
            own = points[self.order[start:end]]
            near = np.stack([own.min(axis=0), own.max(axis=0)]) if len(own) else cell
            if slot >= 0:
                nodes[slot // 2][slot % 2] = len(nodes)
            me = len(nodes)
            nodes.append([-1, -1, start, end])
            boxes.append(cell if cells else near)
            if end - start <= leaf or (near[0] == near[1]).all():
                continue
            at = int(own.astype(np.float32).var(axis=0).argmax())
            values = own[:, at]
            cut = min((int(np.median(values)) + step for step in (-1, 0)), key=lambda c: abs((values <= c).mean() - 0.5))
            cut = int(np.clip(cut, near[0, at], near[1, at] - 1))
            above = values > cut
            self.order[start:end] = self.order[start:end][np.argsort(above, kind="stable")]
            middle = end - int(above.sum())
            low, high = cell.copy(), cell.copy()
            low[1, at], high[0, at] = cut, cut + 1
            todo += [(middle, end, 2 * me + 1, high), (start, middle, 2 * me, low)]
        table = np.array(nodes)
        self.children, self.start, self.end = table[:, :2], table[:, 2], table[:, 3]
        self.low, self.high = (np.array([box[side] for box in boxes]) for side in (0, 1))

    def leaves_within(self, queries: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) where the leaf's box is within `reach` of the query."""
        query, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(query):
            own = queries[query]
            away = np.maximum(self.low[node] - own, 0) + np.maximum(own - self.high[node], 0)
            near = away.sum(axis=1, dtype=np.int64) <= reach
            query, node = query[near], node[near]
            last = self.children[node, 0] < 0
            found.append((query[last], node[last]))
            query, node = np.repeat(query[~last], 2), self.children[node[~last]].ravel()
        return tuple(np.concatenate(part) for part in zip(*found, strict=True)) or (query, node)

    def pairs_within(self, points: np.ndarray, queries: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) at an L1 distance of just `reach`."""
        query, leaf = self.leaves_within(queries, reach)
        query, point = spread(self.start[leaf], self.end[leaf] - self.start[leaf], query)
        point = self.order[point]
        away = np.abs(points[point] - queries[query]).sum(axis=1, dtype=np.int64)
        return query[away == reach], point[away == reach]


def spread(start: np.ndarray, count: np.ndarray, *owners: np.ndarray) -> tuple[np.ndarray, ...]:
    """Owners repeated `count` times, and last the places from `start` on."""
    first = np.cumsum(count) - count
    places = np.repeat(start - first, count) + np.arange(count.sum())
    return *(np.repeat(owner, count) for owner in owners), places


def letter_counts(letters: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """A row of counts by letter of the alphabet for each row of letters."""
    index = np.zeros(256, np.int64)
    index[alphabet] = np.arange(len(alphabet))
    size = len(alphabet)
    places = index[letters] + np.arange(len(letters))[:, None] * size
    counts = np.bincount(places.ravel(), minlength=len(letters) * size).reshape(-1, size)
    return counts.astype(np.int16 if letters.shape[1] < 1 << 13 else np.int64)


def as_letters(words: list[str]) -> np.ndarray:
    """The words, all of one length, as rows of bytes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and the number of each row among them."""
    whole = np.ascontiguousarray(rows)
    keys = whole.view(np.dtype((np.void, whole.itemsize * whole.shape[1]))).ravel()
    _, first, number = np.unique(keys, return_index=True, return_inverse=True)
    return rows[first], number.ravel()


class Words:
    """Words of one length, looked up by a sum of letter times factor of its place."""

    def __init__(self, letters: np.ndarray):
        self.letters = letters
        for seed in range(100):
            self.factors = factors(letters.shape[1], seed)
            sums = letters.astype(np.uint64) @ self.factors
            self.order = np.argsort(sums)
            self.sums = sums[self.order]
            if not (self.sums[1:] == self.sums[:-1]).any():  # words are distinct, so their sums have to be
                break

    def find(self, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the sums are those of words, and of which."""
        at = np.minimum(np.searchsorted(self.sums, sums), len(self.sums) - 1)
        hit = np.flatnonzero(self.sums[at] == sums)
        return hit, self.order[at[hit]]


def factors(length: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, length, np.uint64) * np.uint64(2) + np.uint64(1)


def near_words(points: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) that differ by one replaced letter, or by one letter that only the
    query has if queries are longer by one.  Rows are distinct words as letters."""
    if not len(points) or not len(queries):
        return
    longer = queries.shape[1] - points.shape[1]
    alphabet = np.unique(np.concatenate([points.ravel(), queries.ravel()]))
    size = len(alphabet)
    vectors, _ = distinct_rows(letter_counts(points, alphabet))
    asked, group = distinct_rows(letter_counts(queries, alphabet))
    tree, words = Tree(vectors, _LEAF), Words(points)
    factor = words.factors
    wide = queries.astype(np.uint64)
    if longer:  # sums before a place, and after it with factors of the place before
        zero = np.zeros((len(queries), 1), np.uint64)
        before = np.hstack([zero, np.cumsum(wide[:, :-1] * factor, axis=1)])
        after = np.hstack([np.cumsum((wide[:, 1:] * factor)[:, ::-1], axis=1)[:, ::-1], zero])
    else:
        sums = wide @ factor
    # Every place of every query by its vector and letter.  Of equal neighbours only the
    # first can be left out, as the others give the same word.
    code = np.zeros(256, np.int64)
    code[alphabet] = np.arange(size)
    keys = (group[:, None] * size + code[queries]).ravel()
    if longer:
        same = np.zeros(queries.shape, bool)
        same[:, 1:] = queries[:, 1:] == queries[:, :-1]
        keys = np.where(same.ravel(), len(asked) * size, keys)
    order = np.argsort(keys, kind="stable")
    first = np.searchsorted(keys[order], np.arange(len(asked) * size + 1))

    for at in range(0, len(asked), _QUERIES):
        asker, vector = tree.pairs_within(vectors, asked[at : at + _QUERIES], 1 if longer else 2)
        change = asked[asker + at] - vectors[vector]
        lost, gained = change.argmax(axis=1), change.argmin(axis=1)
        key = (asker + at) * size + lost
        start, count = first[key], first[key + 1] - first[key]
        bound = np.searchsorted(np.cumsum(count), np.arange(_TRIALS, count.sum() + _TRIALS, _TRIALS))
        for a, b in zip(np.append(0, bound), np.append(bound, len(count)), strict=True):
            letter, place = spread(start[a:b], count[a:b], gained[a:b])
            query, column = np.divmod(order[place], queries.shape[1])
            if longer:
                trial = before[query, column] + after[query, column]
            else:
                step = alphabet[letter].astype(np.uint64) - wide[query, column]
                trial = sums[query] + step * factor[column]
            hit, point = words.find(trial)
            query, column = query[hit], column[hit]
            if longer:
                kept = np.arange(points.shape[1]) < column[:, None]
                whole = np.where(kept, queries[query, :-1], queries[query, 1:])
            else:
                whole = queries[query]
                whole[np.arange(len(query)), column] = points[point, column]
            right = (whole == points[point]).all(axis=1)
            yield query[right], point[right]


def fit_cells(words: DataFrame, length: Column) -> dict[int, Tree]:
    """For each length of more words than a group may have, a tree whose leaves are groups."""
    totals = dict(words.groupBy(length.alias("length")).count().toPandas().itertuples(index=False))
    sample = words.orderBy(F.xxhash64("word"), "word").limit(SAMPLE).select("word").toArrow()["word"].to_pylist()
    found = {}
    for size, total in totals.items():
        own = [word for word in sample if len(word) == size]
        most = max(1, min(GROUP, GROUP_LETTERS // size))
        if own and total > most:
            points = letter_counts(as_letters(own), np.arange(256))
            found[int(size)] = Tree(points, len(own) * most / total, cells=True)
    return found


def deal(words: DataFrame, cells: dict[int, Tree]) -> DataFrame:
    """(length, cell, extra, word, n): every word in its own cell and in those it asks;
    extra is 0 for words of the cell's length that ask, 1 for longer ones, NULL for its own."""
    shared = words.sparkSession.sparkContext.broadcast(cells)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(0).to_pylist()
        sizes = np.array([len(word) for word in column])
        parts: list[tuple[np.ndarray, ...]] = []
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            points = letter_counts(as_letters([column[row] for row in rows]), np.arange(256))
            for length, extra, reach in ((size, None, 0), (size, 0, 2), (size - 1, 1, 1)):
                if length < SHORTEST:
                    continue
                tree = shared.value.get(int(length))
                own, leaf = tree.leaves_within(points, reach) if tree else (np.arange(len(rows)), np.zeros(len(rows)))
                role = np.full(len(own), -1 if extra is None else extra)
                parts.append((np.full(len(own), length), leaf, role, rows[own]))
        length, leaf, role, row = (np.concatenate(part).astype(np.int64) for part in zip(*parts, strict=True))
        columns = [pa.array(length), pa.array(leaf), pa.array(role)]
        columns += [batch.column(at).take(pa.array(row)) for at in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, names=["length", "cell", "extra", "word", "n"])

    return map_batches(words, ["word", "n"], work, "length long, cell long, extra long, word string, n long")


def _summed(words: list[str], own: np.ndarray, near: list[str], at: np.ndarray, n: np.ndarray) -> list[pa.Array]:
    """Per word of `own`: near words, and the one of largest n, ties to the smallest."""
    rank = np.empty(len(near), np.int64)
    rank[np.lexsort((np.array(near, object), -n))] = np.arange(len(near))
    order = np.lexsort((rank[at], own))
    own, at = own[order], at[order]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else own
    best = at[first]
    return [
        pa.array([words[row] for row in own[first].tolist()], pa.string()), pa.array(np.diff(np.append(first, len(own)))),
        pa.array([near[row] for row in best.tolist()], pa.string()), pa.array(n[best]),
    ]


def _search(group: pa.Table) -> pa.Table:
    """The near words that the words of a cell and those that ask it are to each other."""
    parts: dict[int, tuple[list[str], np.ndarray]] = {}
    role = group["extra"].to_numpy()
    for extra in (-1, 0, 1):
        some = group.take(pa.array(np.flatnonzero(role == extra)))
        parts[extra] = some["word"].to_pylist(), some["n"].to_numpy()
    own, own_n = parts[-1]
    names = ["word", "n_near", "form", "form_n"]
    results = [[pa.array([], pa.string()), pa.array([], pa.int64())] * 2]
    for extra in (0, 1):
        asking, n = parts[extra]
        if not own or not asking:
            continue
        pairs = list(near_words(as_letters(own), as_letters(asking)))
        query, point = (np.concatenate([pair[side] for pair in pairs]) for side in (0, 1))
        results.append(_summed(asking, query, own, point, own_n))
        if extra:
            results.append(_summed(own, point, asking, query, n))
    return pa.table([pa.concat_arrays(column) for column in zip(*results, strict=True)], names=names)


def near_forms(words: DataFrame) -> DataFrame:
    """(word, n, n_near, near, near_n) of `words` (word, n): how many words are near each, and
    the near one of largest n."""
    length = F.length("word")
    cells = fit_cells(words, length)
    dealt = deal(words, cells)
    found = dealt.groupBy("length", "cell").applyInArrow(_search, "word string, n_near long, form string, form_n long")
    own = words.select(
        "word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("string").alias("form"),
        F.lit(None).cast("long").alias("form_n"),
    )
    rows = own.unionByName(found, allowMissingColumns=True)
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), F.col("form"))))
    summed = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    return summed.select(
        "word", "n", "n_near", F.col("best.form").alias("near"), (-F.col("best.less")).alias("near_n")
    )


def roots(forms: DataFrame, largest: int) -> DataFrame:
    """(word, root) of the words that have a form; `forms` are (word, form).  A form is
    `RATIO` times as frequent as its word, which bounds the steps."""
    links = forms.select("word", F.col("form").alias("root"))
    steps = max(1.0, log10(max(1, largest)) / log10(RATIO))
    for _ in range(int(np.ceil(log2(steps + 1)))):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return links


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: n, n_near, its form and the form's n, and the root of its group."""
    spark = docs.sparkSession
    target = scratch_path(spark, "spelling")
    word_counts(docs, id_col, text_col).filter(F.col("n") >= FEWEST).write.parquet(f"{target}/words")
    near_forms(spark.read.parquet(f"{target}/words")).write.parquet(f"{target}/near")
    near = spark.read.parquet(f"{target}/near")
    has = F.col("near_n") >= RATIO * F.col("n")
    found = near.select(
        "word", "n", "n_near", F.when(has, F.col("near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n")
    )
    largest = near.agg(F.max("n")).first()[0] or 0
    linked = found.join(roots(found.filter("form IS NOT NULL"), largest), "word", "left")
    return linked.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
