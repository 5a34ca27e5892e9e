"""Benchmark decontamination: BM25 over the test items, block-max WAND, verification.

The test items are indexed; every passage of every training document is a query.  A
passage is a window of twice the longest item's words, moved by half its length, so
that any item lies in one passage whole.  An item's score is its BM25 score for the
passage's distinct words as a share of its score for its own words; items that reach
`THRESHOLD` are retrieved, all of them.  WAND passes over items whose words' largest
scores cannot reach the threshold, block maxima pass over runs of postings.  A passage
is searched only if the block maxima of some block of items can reach the threshold;
these bounds are summed for many passages at once.

Retrieved items are verified: the question (all sentences but the last) and the answer
(the last one, or the last third of a single sentence) must both be found in the passage,
by the share of words that lie in common runs of `RUN` words.  In a part of at most twice as
many words an edit leaves no run: it is also aligned with the passage in order, so that an
edit costs one word.

Items are taken in shards of bounded bytes, each broadcast in turn, with word statistics
of all items, so that their number only adds passes.  NULL and empty texts match nothing,
on either side.  Repeated items match each; repeated documents give rows each.  A very long
text is many passages, all of them looked at.  An empty table on either side gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from tallyward.llm.common import by_bytes, map_batches, texts_of

#: Share of an item's own score that a passage has to reach.
THRESHOLD = 0.5
#: Share of the question's and of the answer's words that must be found, in runs.
OVERLAP = 0.5
RUN = 5
#: Parts of at most twice a run are also aligned: share of their words, further words between.
ALIGNED, EDITS = 0.75, 2
K1, B = 1.2, 0.75
#: Postings in a block.
BLOCK = 16
#: Blocks of items whose bounds are taken for many passages at once, and cells for them.
ITEM_BLOCKS, BOUND_CELLS = 64, 4_000_000
#: Bytes of item texts in a shard; what is broadcast is a few times as large.
SHARD_BYTES = 8 << 20

SCHEMA = (
    "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, "
    "passage_start long"
)
_SPACED = bytes(
    byte if chr(byte).isalnum() or byte >= 128 else 32 for byte in range(256)
)
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str) -> list[bytes]:
    """Lower-case words; ASCII marks separate."""
    return text.lower().encode().translate(_SPACED).split()


def parts_of(text: str) -> tuple[list[bytes], list[bytes]]:
    """The words of the question and of the answer."""
    sentences = [words for words in map(words_of, _SENTENCE.split(text)) if words]
    if len(sentences) > 1:
        return [word for sentence in sentences[:-1] for word in sentence], sentences[-1]
    words = sentences[0] if sentences else []
    at = len(words) - max(1, len(words) // 3)
    return words[:at] or words, words[at:]


@dataclass
class Statistics:
    """Of all items: how many, their mean length, and how many hold a word."""

    items: int
    mean: float
    holders: dict[bytes, int]

    def idf(self, word: bytes) -> float:
        n = self.holders.get(word, 0)
        return math.log(1 + (self.items - n + 0.5) / (n + 0.5))


@dataclass
class Index:
    """Postings by word, each with the share of the item's own score it stands for."""

    ids: list[int | None] = field(default_factory=list)
    parts: list[tuple[list[bytes], list[bytes]]] = field(default_factory=list)
    terms: dict[bytes, int] = field(default_factory=dict)
    items: list[list[int]] = field(default_factory=list)
    shares: list[list[float]] = field(default_factory=list)
    block_max: list[list[float]] = field(default_factory=list)
    most: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bounds: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.float32))
    stride: int = 1

    @classmethod
    def of(cls, rows: Iterable[tuple[int | None, str]], statistics: Statistics) -> Index:
        index = cls()
        for item_id, text in rows:
            words = words_of(text)
            if not words:
                continue
            number = len(index.ids)
            index.ids.append(item_id)
            index.parts.append(parts_of(text))
            index.stride = max(index.stride, len(words))
            norm = K1 * (1 - B + B * len(words) / statistics.mean)
            scores = {w: statistics.idf(w) * n * (K1 + 1) / (n + norm) for w, n in Counter(words).items()}
            own = sum(scores.values())
            for word, score in scores.items():
                term = index.terms.setdefault(word, len(index.terms))
                if term == len(index.items):
                    index.items.append([])
                    index.shares.append([])
                index.items[term].append(number)
                index.shares[term].append(score / own)
        index.block_max = [
            [max(shares[at : at + BLOCK]) for at in range(0, len(shares), BLOCK)] for shares in index.shares
        ]
        index.most = np.array([max(shares) for shares in index.shares] + [0.0])
        blocks = max(1, min(ITEM_BLOCKS, len(index.ids), BOUND_CELLS // (len(index.terms) + 1)))
        size = -(-max(1, len(index.ids)) // blocks)
        index.bounds = np.zeros((len(index.terms), blocks), np.float32)
        for term, (items, shares) in enumerate(zip(index.items, index.shares, strict=True)):
            np.maximum.at(index.bounds[term], np.array(items) // size, np.array(shares, np.float32))
        return index

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items that reach the threshold for the given distinct terms."""
        found: list[tuple[int, float]] = []
        items, shares, most = self.items, self.shares, self.most
        reach = threshold - 1e-9
        cursors = [[items[term][0], 0, term] for term in terms]  # item, place, term
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for at, (_, _, term) in enumerate(cursors):
                bound += most[term]
                if bound >= reach:
                    pivot = at
                    break
            if pivot < 0:
                break
            target = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
                pivot += 1
            # The blocks in which the target would lie.
            bound, border = 0.0, math.inf
            for item, place, term in cursors[: pivot + 1]:
                block = place // BLOCK
                last = min((block + 1) * BLOCK, len(items[term])) - 1
                while items[term][last] < target:
                    block += 1
                    if block * BLOCK >= len(items[term]):
                        last = -1
                        break
                    last = min((block + 1) * BLOCK, len(items[term])) - 1
                if last >= 0:
                    bound += self.block_max[term][block]
                    border = min(border, items[term][last])
            if bound < reach:
                # No item up to the nearest block border, nor before the next cursor.
                beyond = cursors[pivot + 1][0] if pivot + 1 < len(cursors) else math.inf
                target = max(target + 1, min(border + 1, beyond))
            elif cursors[0][0] == target:
                score = sum(shares[term][place] for item, place, term in cursors[: pivot + 1])
                if score >= reach:
                    found.append((target, score))
                target += 1
            for cursor in cursors[: pivot + 1]:
                postings, place = items[cursor[2]], cursor[1]
                while place < len(postings) and postings[place] < target:
                    place += 1
                cursor[1] = place
                cursor[0] = postings[place] if place < len(postings) else -1
            cursors = [cursor for cursor in cursors if cursor[0] >= 0]
        return found


def overlap(part: list[bytes], passage: set[tuple[bytes, ...]], run: int) -> float:
    """The share of a part's words in runs of `run` words that the passage has."""
    covered = np.zeros(len(part), bool)
    for at in range(len(part) - run + 1):
        if tuple(part[at : at + run]) in passage:
            covered[at : at + run] = True
    return float(covered.mean()) if len(part) else 0.0


def _runs(words: list[bytes], run: int) -> set[tuple[bytes, ...]]:
    return set(zip(*[words[at:] for at in range(run)], strict=False))


def aligned(part: list[bytes], passage: list[bytes]) -> float:
    """The largest share of a part's words that stand in their order in a stretch of the
    passage that is longer than the part by `EDITS` words at most."""
    size, best = len(part) + EDITS, 0
    firsts = set(part[: EDITS + 1])
    for at in (at for at, word in enumerate(passage) if word in firsts):
        row = [0] * (len(part) + 1)  # longest common subsequence with the part's beginnings
        for word in passage[at : at + size]:
            before = 0
            for place, own in enumerate(part, 1):
                before, row[place] = row[place], before + 1 if own == word else max(row[place], row[place - 1])
        best = max(best, row[-1])
        if best == len(part):
            break
    return best / len(part)


def verify(index: Index, item: int, passage: list[bytes]) -> tuple[float, float]:
    """Overlaps of question and answer with a passage.

    An edit in a short part leaves no run of it; a short part counts as found in order if
    `ALIGNED` of its words are.
    """
    shares = []
    for part in index.parts[item]:
        run = min(RUN, len(part))
        share = overlap(part, _runs(passage, run), run)
        if share < 1 and EDITS < len(part) <= 2 * RUN:
            found = aligned(part, passage)
            share = max(share, found) if found >= ALIGNED else share
        shares.append(share)
    return shares[0], shares[1]


def match(index: Index, texts: list[str]) -> list[dict[int, tuple]]:
    """Per text: verified items with score, overlaps and the best passage's first word."""
    found: list[dict[int, tuple]] = [{} for _ in texts]
    if not index.ids:
        return found
    for start, end in by_bytes(texts):
        _match_range(index, texts[start:end], found[start:end])
    return found


def _promising(index: Index, passage: np.ndarray, term: np.ndarray, passages: int) -> np.ndarray:
    """The passages for which the bounds of some block of items reach the threshold."""
    reach = THRESHOLD - 1e-5  # the bounds are sums of rounded numbers
    high = np.bincount(passage, index.most[term], minlength=passages) >= reach
    keep = high[passage]
    passage, term = passage[keep], term[keep]
    found = []
    starts = np.flatnonzero(np.diff(passage, prepend=-1))
    for at in range(0, len(starts), 512):
        some = starts[at : at + 512]
        end = starts[at + 512] if at + 512 < len(starts) else len(passage)
        sums = np.add.reduceat(index.bounds[term[some[0] : end]], some - some[0], axis=0)
        found.append(passage[some[sums.max(axis=1) >= reach]])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _match_range(index: Index, texts: list[str], found: list[dict[int, tuple]]) -> None:
    stride, size = index.stride, len(index.terms)
    get = index.terms.get
    words = [words_of(text) for text in texts]
    lengths = np.array([len(each) for each in words])
    terms = np.fromiter((get(word, size) for each in words for word in each), np.int64, lengths.sum())
    # Passage k of a text holds its strides k and k + 1; the last stride starts none
    # unless it is the only one.
    strides = -(-lengths // stride)
    firsts = np.cumsum(strides) - strides
    doc = np.repeat(np.arange(len(texts)), lengths)
    place = np.arange(len(terms)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    own = firsts[doc] + place // stride
    known = terms < size
    own, terms, inside = own[known], terms[known], (place >= stride)[known]
    pairs = np.concatenate([own * size + terms, (own[inside] - 1) * size + terms[inside]])
    pairs = np.unique(pairs)
    passage, term = pairs // size, pairs % size
    for number in _promising(index, passage, term, int(strides.sum())):
        low, high = np.searchsorted(passage, [number, number + 1])
        hits = index.search(term[low:high].tolist(), THRESHOLD)
        if not hits:
            continue
        at = int(np.searchsorted(firsts, number, "right")) - 1
        while not strides[at]:
            at -= 1
        begin = (int(number) - int(firsts[at])) * stride
        text_words = words[at][begin : begin + 2 * stride]
        for item, score in hits:
            shares = verify(index, item, text_words)
            if min(shares) >= OVERLAP and (item not in found[at] or score > found[at][item][0]):
                found[at][item] = (score, *shares, begin)


# -- Spark --------------------------------------------------------------------


def _holders(items: DataFrame) -> DataFrame:
    """(word, holders, tokens) over all items; the word is binary."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        held, tokens = Counter(), Counter()
        for text in texts_of(batch.column(0)):
            words = words_of(text)
            held.update(set(words))
            tokens.update(words)
        names = list(held)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array([held[w] for w in names], pa.int64()),
             pa.array([tokens[w] for w in names], pa.int64())],
            names=["word", "holders", "tokens"],
        )

    counted = map_batches(items, ["text"], work, "word binary, holders long, tokens long")
    return counted.groupBy("word").agg(F.sum("holders").alias("holders"), F.sum("tokens").alias("tokens"))


def build_indexes(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES
) -> Iterator[Index]:
    """Index after index over the items, each of at most about `shard_bytes` of text."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.filter(F.length("text") > 0)
    total = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    if not total["n"]:
        return
    holders = _holders(rows)
    tokens = holders.agg(F.sum("tokens")).first()[0] or 0
    shards = -(-total["size"] // shard_bytes)
    for shard in range(shards):
        some = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(shards)) == shard)
        pairs = [(row["id"], row["text"]) for row in some.orderBy("id", "text").toLocalIterator()]
        wanted = {word for _, text in pairs for word in words_of(text)}
        # With one shard all words are wanted; otherwise those of the shard are joined.
        known = holders
        if shards > 1:
            own = items.sparkSession.createDataFrame([(word,) for word in sorted(wanted)], "word binary")
            known = holders.join(own, "word", "left_semi")
        counts = {bytes(row["word"]): row["holders"] for row in known.toLocalIterator()}
        yield Index.of(pairs, Statistics(total["n"], tokens / total["n"] or 1.0, counts))


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per document and item found in it, by its best passage."""
    names = [name.split()[0] for name in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]

    def work(shared: Broadcast):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            index = shared.value
            ids = pc.cast(batch.column(0), pa.int64()).to_pylist()
            rows = [
                (doc_id, index.ids[item], *values)
                for doc_id, hits in zip(ids, match(index, texts_of(batch.column(1))), strict=True)
                for item, values in sorted(hits.items())
            ]
            columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        return run

    spark = docs.sparkSession
    result = spark.createDataFrame([], SCHEMA)
    for at, index in enumerate(build_indexes(items, item_col, item_text, shard_bytes)):
        shared = spark.sparkContext.broadcast(index)
        found = map_batches(docs, [id_col, text_col], work(shared), SCHEMA)
        result = found if at == 0 else result.unionByName(found)
    return result


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns unchanged, in which no item is found."""
    at = docs.columns.index(text_col)
    spark = docs.sparkSession

    def work(shared: Broadcast):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            hits = match(shared.value, texts_of(batch.column(at)))
            return batch.filter(pa.array([not each for each in hits], pa.bool_()))

        return run

    for index in build_indexes(items):
        docs = map_batches(docs, docs.columns, work(spark.sparkContext.broadcast(index)), docs.schema)
    return docs
