"""Language-model scores of texts: base score and self-attention model.

Tokens are words in lower case (A-Z) and one end per text.  Training texts are those
whose id's CRC-32 has a remainder other than `HELD_OUT` by `FOLDS`.  The counts of all
their words are taken in Spark; the base score needs the count of every word.  The most
frequent words go to the executors (`HEAD` of them at most), the others are joined.

The model mixes, per word, the word's share of the training tokens with the probability
of its subword ids: that of their classes under the attention model (``attention_model``),
times each unit's share of its class after the unit before.  Units before are told apart in
`GROUPS` groups, so the shares are a table bounded by the vocabulary.

Training texts are gone through once more for all that the model is made from: the company
units keep, which gives the classes, the counts of all pairs of neighbours, which give the
tables, and the texts' units in pieces of some windows, as the attention's weights are fitted
on every window of every training text, each in one of the rounds.  Pieces are dealt to shards
of like size; a round starts from the same weights in each of its shards, and their weighted
mean is taken in Spark.  Long texts are scored in overlapping windows, every unit once.

NULL and empty texts are the end alone.  A NULL id counts as the text '' in the fold rule.
Repeated rows are scored alike, each with a row of its own.  A very long text is one row of
work, whole.  Without training texts, all counts are zero and the model is the untrained one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import count
from math import isqrt
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from tallyward.llm.attention_model import (
    CLASSES,
    CONTEXT,
    END_CLASS,
    SPAN,
    STRIDE,
    Attention,
    Windows,
    add_company,
    classify,
)
from tallyward.llm.byte_bpe import ByteBpe, encoder
from tallyward.llm.common import by_bytes, map_batches, texts_of
from tallyward.session import scratch_path

FOLDS, HELD_OUT = 7, 2
#: Most frequent words that every executor knows; all others are joined.
HEAD = 100_000
#: Windows that a shard of the fit has about, and rounds, each over shards of its own.
SHARD_WINDOWS, ROUNDS = 1 << 16, 2
#: Units of a text that go to a shard together, besides those before them.
PIECE = 64 * STRIDE
#: Groups of the unit before: the most frequent units, the end, and the others by class.
GROUPS, GATHERED = 256, 32
#: Weight of the word's share of the training tokens against the attention model.
SHARE = 0.25
#: Weight of a class's plain shares against the counted pairs.
PLAIN = 5.0
#: Words besides the head whose units a worker's memory has, words that it counts at a time.
REMEMBERED, COUNTED = 400_000, 200_000
#: Pairs that are sorted at a time.
_PAIRS = 1 << 21
#: The end of a text among the words; no word is empty.
END = b""

SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, head_known long, head_log double, "
    "score double, tail array<struct<word: binary, spelled: double>>"
)


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == HELD_OUT


# -- counts of words and units ------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c): how often the texts have each word; the end, an empty one, included.

    Words are counted where they lie; what moves is a row per word and `COUNTED` words.
    """

    def rows(counts: Counter[bytes]) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "c"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in texts_of(batch.column(0)):
                counts.update(text.encode().lower().split())
                if len(counts) > COUNTED:
                    yield rows(counts)
                    counts.clear()
            counts[END] += batch.num_rows
        yield rows(counts)

    counted = texts.select("text").mapInArrow(run, "word binary, c long")
    return counted.select(F.col("word").cast("string").alias("word"), "c").groupBy("word").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of largest `c`, no more than `most`: all above the least bound that leaves
    so few.  Bounds are powers, so that choosing one takes a bounded table."""
    step = F.floor(F.log("c") / np.log(1.02)).cast("long")
    steps = counts.groupBy(step.alias("step")).count().toPandas().sort_values("step", ascending=False)
    kept = steps["step"][steps["count"].cumsum() <= most]
    return counts.filter(step >= int(kept.min()) if len(kept) else F.lit(False))


def unit_counts(words: DataFrame, path: str) -> np.ndarray:
    """Counts of all units, ids as starts and then ids as others, from (word, c)."""
    size = 2 * encoder(path).size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, counts = encoder(path), np.zeros(size, np.int64)
        for batch in batches:
            if batch.num_rows:
                units, _, lengths = split_words(bpe, batch.column(0).to_pylist())
                np.add.at(counts, units, np.repeat(batch.column(1).to_numpy(), lengths))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["unit", "c"])

    found = words.filter("word != ''").select("word", "c").mapInArrow(run, "unit long, c long")
    rows = found.groupBy("unit").agg(F.sum("c").alias("c")).toPandas()
    counts = np.zeros(size)
    counts[rows["unit"].to_numpy(np.int64)] = rows["c"].to_numpy(float)
    return counts


def split_words(bpe: ByteBpe, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The units of all words, which of them begin a word, and the units of each word."""
    ids = bpe.encode_words(words)
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    units = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
    first = np.zeros(len(units), bool)
    first[np.cumsum(lengths) - lengths] = True
    return units + np.where(first, 0, bpe.size), first, lengths


# -- units of texts, in workers -----------------------------------------------


def ranges(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of some ranges, one after another."""
    return np.repeat(first - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


class Numbers(dict):
    """Words' numbers; a word that is asked for gets the next one and waits for its units, that
    are copied where an older memory has the word."""

    def __init__(self, words: Iterable[bytes] = (), older: dict[bytes, int] | None = None) -> None:
        super().__init__(zip(words, count(), strict=False))
        self.older = older or {}
        self.waiting: list[bytes] = []
        self.places: list[int] = []  # numbers of those that wait
        self.copied: tuple[list[int], list[int]] = [], []  # numbers here and there

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        there = self.older.get(word)
        if there is None:
            self.waiting.append(word)
            self.places.append(number)
        else:
            self.copied[0].append(number)
            self.copied[1].append(there)
        return number


class Spelling:
    """Per worker: the units of the words met; the end's is the last of all.

    Words are remembered in two memories.  When one is full it becomes the older one, whose
    words move to the new one as they are met again, and that before it goes.
    """

    def __init__(self, path: str, base: Iterable[bytes] = ()):
        self.bpe = encoder(path)
        self.known = Numbers()
        self.blob = np.zeros(1 << 16, np.int32)
        self.held = 0  # units in the blob
        self.offset, self.length = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)
        for word in (END, *base):
            self.known[word]
        self.base = list(self.known)
        self.n_base = len(self.base)
        self.older = self.blob, self.offset, self.length
        self.learn()
        self.base_held = self.held

    def clear(self) -> None:
        """The first words alone are known; the others are to be copied when they are met."""
        full = self.known
        full.older = {}
        self.known = Numbers(self.base, full)
        self.older = self.blob, self.offset, self.length
        self.blob, self.held = self.blob[: self.base_held].copy(), self.base_held
        self.offset, self.length = self.offset[: self.n_base].copy(), self.length[: self.n_base].copy()

    def learn(self) -> None:
        """Spell the words that wait.

        Marks after letters are a piece of their own: a word with them has the units of the
        word without, which is remembered too, and theirs."""
        known, size = self.known, self.bpe.size
        waiting, places = self._waiting()
        if waiting[:1] == [""]:
            self._put(places[:1], np.array([2 * size]), np.array([1]))
            waiting, places = waiting[1:], places[1:]
        others = self._learn_letters(waiting, places)
        odd, marked, stems, tails = [], [], [], []
        for at in others:
            stem = self.bpe.stem(waiting[at])
            if stem is waiting[at]:
                odd.append(at)
            else:
                marked.append(at)
                stems.append(known[stem.encode()])
                tails.append(waiting[at][len(stem) :])
        units, _, lengths = split_words(self.bpe, [waiting[at] for at in odd])
        self._put(places[odd], units, lengths)
        self._learn_letters(*self._waiting())
        if known.copied[0]:
            numbers, origins = map(np.array, known.copied)
            known.copied = [], []
            blob, offset, length = self.older
            lengths = length[origins].astype(np.int64)
            self._put(numbers, blob[ranges(offset[origins], lengths)], lengths)
        if marked:
            self._put(places[marked], *self._with_tails(np.array(stems), tails))

    def _waiting(self) -> tuple[list[str], np.ndarray]:
        """The words that wait, and their numbers; no word has a line end."""
        known = self.known
        waiting, places = known.waiting, np.array(known.places, np.int64)
        known.waiting, known.places = [], []
        return b"\n".join(waiting).decode().split("\n") if waiting else [], places

    def _learn_letters(self, words: list[str], places: np.ndarray) -> list[int]:
        """Spell the words of letters; the places of the others."""
        letters, ids, sizes, others = self.bpe.ids_of_letters(words)
        lengths = np.array(sizes, np.int64)
        units = np.array(ids, np.int64) + self.bpe.size
        units[np.cumsum(lengths) - lengths] -= self.bpe.size  # ids that begin a word
        self._put(places[letters], units, lengths)
        return others

    def _with_tails(self, stems: np.ndarray, tails: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The units of words and of the marks after them, and how many these are."""
        number = {tail: at for at, tail in enumerate(dict.fromkeys(tails))}
        ids = [np.frombuffer(self.bpe.tail(tail), "<u4") for tail in number]
        more = np.array(list(map(len, ids)), np.int64)
        which = np.array([number[tail] for tail in tails])
        units, lengths = self.units(stems)
        both = lengths + more[which]
        first = np.cumsum(both) - both
        found = np.empty(both.sum(), np.int64)
        found[ranges(first, lengths)] = units
        found[ranges(first + lengths, more[which])] = np.concatenate(ids)[ranges((np.cumsum(more) - more)[which], more[which])]
        found[ranges(first + lengths, more[which])] += self.bpe.size  # none begins a word
        return found, both

    def _put(self, numbers: np.ndarray, units: np.ndarray, lengths: np.ndarray) -> None:
        for name, size in (("offset", len(self.known)), ("length", len(self.known)), ("blob", self.held + len(units))):
            own = getattr(self, name)
            if size > len(own):
                setattr(self, name, np.concatenate([own, np.zeros(max(size, 2 * len(own)) - len(own), own.dtype)]))
        self.offset[numbers] = self.held + np.cumsum(lengths) - lengths
        self.length[numbers] = lengths
        self.blob[self.held : self.held + len(units)] = units
        self.held += len(units)

    def look_up(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """Numbers of the words of each text, the end last."""
        if len(self.known) > self.n_base + REMEMBERED:
            self.clear()
        number = self.known.__getitem__
        found = [np.fromiter(map(number, [*words, END]), np.int64, len(words) + 1) for words in texts]
        if self.known.waiting or self.known.copied[0]:
            self.learn()
        return found

    def units(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All units of the words, and the units of each word."""
        lengths = self.length[index].astype(np.int64)
        return self.blob[ranges(self.offset[index], lengths)], lengths

    def chunks(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For some texts at a time all their units, each text's end last, and how many a text has."""
        for a, b in by_bytes(texts):
            index = self.look_up([text.encode().lower().split() for text in texts[a:b]])
            sizes = np.array([len(each) for each in index])
            units, lengths = self.units(np.concatenate(index))
            yield units, np.add.reduceat(lengths, np.cumsum(sizes) - sizes)

    def streams(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Each text's units, the end last."""
        for units, sizes in self.chunks(texts):
            yield from np.split(units, np.cumsum(sizes)[:-1])


#: What a worker holds of the words met, for one use at a time.
_HELD: dict[str, Any] = {}


def _held(key: str, owner: object, make: Callable[[], Any]) -> Any:
    """What a worker holds for `owner`; what it held for another goes."""
    if _HELD.get("owner") is not owner or _HELD.get("key") != key:
        _HELD.clear()
        _HELD.update(owner=owner, key=key, value=make())
    return _HELD["value"]


# -- what the model is made from ----------------------------------------------


class Company:
    """Sums of company vectors of the units met, a row each."""

    def __init__(self, size: int) -> None:
        self.row = np.full(size, -1, np.int32)
        self.units = np.zeros(0, np.int64)
        self.sums = np.zeros((64, CLASSES), np.int64)

    def places(self, units: np.ndarray) -> np.ndarray:
        """The rows of distinct units."""
        places = self.row[units]
        new = units[places < 0]
        if len(new):
            held = len(self.units)
            self.row[new] = np.arange(held, held + len(new))
            self.units = np.append(self.units, new)
            if len(self.units) > len(self.sums):
                more = max(len(self.units), 2 * len(self.sums)) - len(self.sums)
                self.sums = np.concatenate([self.sums, np.zeros((more, CLASSES), np.int64)])
            places = self.row[units]
        return places

    def batches(self) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        for at in range(0, len(self.units), 4096):
            some = self.units[at : at + 4096]
            yield some, [row.tobytes() for row in self.sums[at : at + len(some)]]


def add_pairs(held: tuple[np.ndarray, np.ndarray], new: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their counts, with further keys that count one each.

    These are sorted without their places, which is much less work, and then few."""
    if not new:
        return held
    keys, counts = (np.concatenate(both) for both in zip(held, np.unique(np.concatenate(new), return_counts=True), strict=True))
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)


def pieces(stream: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """A text's units in pieces of whole windows: how many units before its own a piece begins
    with, and all its units."""
    for start in range(0, len(stream), PIECE):
        lead = min(start, CONTEXT + 1)
        yield lead, stream[start - lead : start + PIECE]


_GATHERED = "kind string, key long, c long, data binary"


def gather(texts: DataFrame, first: np.ndarray, path: str, shards: int) -> DataFrame:
    """One pass over `texts` (text, place): rows (kind, key, c, data) of three kinds.

    `company`: key is a unit, data its vector.  `pair`: key is the unit before times all
    units plus the unit, c how often.  `piece`: key is a shard, data the units of a piece, the
    first c of which come before its own.  Shard number n is for round n % `ROUNDS`.
    """
    shared = texts.sparkSession.sparkContext.broadcast(first)
    size = len(first) + 1

    def rows(kind: str, keys: np.ndarray, counts: np.ndarray, data: list[bytes] | None = None) -> pa.RecordBatch:
        columns = [pa.array([kind] * len(keys)), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())]
        columns.append(pa.array(data, pa.binary()) if data is not None else pa.nulls(len(keys), pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=["kind", "key", "c", "data"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling, classes, company = _held("gather", path, lambda: Spelling(path)), shared.value, Company(size)
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held, new, waiting = none, [], 0
        for batch in batches:
            chosen: list[tuple[int, int, bytes]] = []
            places, done = batch.column(1).to_pylist(), 0
            for units, sizes in spelling.chunks(texts_of(batch.column(0))):
                units = units.astype(np.int64)
                first = np.cumsum(sizes) - sizes
                before = np.append(size - 1, units[:-1])  # a text begins after an end
                before[first] = size - 1
                new.append(before * size + units)
                waiting += len(units)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                cells, n = np.unique(owner * size + units, return_counts=True)
                cells, n = cells[cells % size < size - 1], n[cells % size < size - 1]  # without the ends
                row, own = np.divmod(cells, size)
                company.places(np.unique(own))
                bounds, short = np.searchsorted(row, np.arange(len(sizes) + 1)), units.astype("<i4")
                for at, (place, a, b) in enumerate(zip(places[done : done + len(sizes)], bounds, bounds[1:], strict=False)):
                    add_company(company.row[own[a:b]], n[a:b], company.sums, classes[own[a:b]])
                    own_units = short[first[at] : first[at] + sizes[at]]
                    for number, (lead, piece) in enumerate(pieces(own_units)):
                        chosen.append(((place + number * 40503) % (shards * ROUNDS), lead, piece.tobytes()))
                done += len(sizes)
                if waiting > _PAIRS:
                    held, new, waiting = add_pairs(held, new), [], 0
                    if len(held[0]) > _PAIRS // 2:
                        yield rows("pair", *held)
                        held = none
            if chosen:
                yield rows("piece", *zip(*chosen, strict=True))
        yield rows("pair", *add_pairs(held, new))
        for units, vectors in company.batches():
            yield rows("company", units, np.ones(len(units), np.int64), vectors)

    return texts.select("text", "place").mapInArrow(run, _GATHERED)


def fit_classes(gathered: DataFrame, counts: np.ndarray) -> np.ndarray:
    """Classes of the units by the company they keep; at most one vector for each unit of the
    vocabulary comes to the driver."""
    schema, size = "unit long, company binary", len(counts)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        company = Company(size)
        for batch in batches:
            units = batch.column(0).to_numpy()
            company.places(np.unique(units))
            vectors = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64).reshape(-1, CLASSES)
            np.add.at(company.sums, company.row[units], vectors)
        for units, vectors in company.batches():
            columns = [pa.array(units), pa.array(vectors, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["unit", "company"])

    rows = gathered.filter("kind = 'company'").select(F.col("key").alias("unit"), F.col("data").alias("company"))
    found = rows.repartition("unit").mapInArrow(add, schema).toArrow()
    company = np.zeros((len(counts), CLASSES), np.float32)
    for unit, vector in zip(found["unit"].to_pylist(), found["company"], strict=True):
        company[unit] = np.frombuffer(vector.as_buffer(), np.int64)
    return classify(counts, company)


class Shares:
    """Logs of a unit's share of its class, given the group of the unit before."""

    def __init__(self, counts: np.ndarray, classes: np.ndarray):
        """`counts` of the units, and all `classes`, that of the end last."""
        self.classes = classes
        order = np.argsort(-counts, kind="stable")[: GROUPS - GATHERED - 1]
        self.group = np.append(GROUPS - GATHERED + classes[:-1] % GATHERED, GROUPS - GATHERED - 1).astype(np.int16)
        self.group[order] = np.arange(len(order))
        plain = (counts + 1.0) / np.bincount(classes[:-1], counts + 1.0, minlength=CLASSES)[classes[:-1]]
        self.plain = np.append(plain, 1.0)
        self.column = np.zeros(len(classes), np.int32)  # of a unit in the table; the first: none
        self.table = np.zeros((GROUPS, 1), np.float32)
        self.rest = np.zeros((GROUPS, CLASSES), np.float32)

    def fill(self, group: np.ndarray, unit: np.ndarray, c: np.ndarray) -> None:
        seen = np.unique(unit)
        self.column[seen] = np.arange(1, len(seen) + 1)
        total = np.zeros((GROUPS, CLASSES))
        np.add.at(total, (group, self.classes[unit]), c)
        self.rest = np.log(PLAIN / (total + PLAIN)).astype(np.float32)
        found = np.zeros((GROUPS, len(seen)))
        found[group, self.column[unit] - 1] = c
        found += PLAIN * self.plain[seen]
        found /= total[:, self.classes[seen]] + PLAIN
        self.table = np.hstack([self.table, np.log(found).astype(np.float32)])
        self.plain = np.log(self.plain).astype(np.float32)

    def logs(self, before: np.ndarray, unit: np.ndarray) -> np.ndarray:
        group, column = self.group[before], self.column[unit]
        share = self.table[group, column]
        none = np.flatnonzero(column == 0)
        share[none] = self.plain[unit[none]] + self.rest[group[none], self.classes[unit[none]]]
        return share


def pair_tables(gathered: DataFrame, shares: Shares) -> np.ndarray:
    """Fill the shares from all pairs of neighbours; counts of the steps between classes.

    What comes to the driver is bounded by the groups and classes times the units.
    """
    spark, size = gathered.sparkSession, len(shares.classes)
    units = pa.table({"unit": np.arange(size), "class": shares.classes.astype(np.int64), "group": shares.group.astype(np.int64)})
    known = F.broadcast(spark.createDataFrame(units))
    pairs = gathered.filter("kind = 'pair'").groupBy("key").agg(F.sum("c").alias("c"))
    pairs = pairs.select((F.col("key") % size).alias("unit"), F.floor(F.col("key") / size).alias("before"), "c")
    before = known.select(F.col("unit").alias("before"), F.col("class").alias("class_before"), F.col("group"))
    joined = pairs.join(before, "before").groupBy("group", "class_before", "unit").agg(F.sum("c").alias("c"))
    rows = joined.toPandas()
    group, origin, unit = (rows[name].to_numpy(np.int64) for name in ("group", "class_before", "unit"))
    c = rows["c"].to_numpy(float)
    steps = np.bincount(origin * CLASSES + shares.classes[unit], c, CLASSES * CLASSES).astype(np.int64)
    # Some groups hold units of several classes.
    keys, place = np.unique(group * size + unit, return_inverse=True)
    shares.fill(keys // size, keys % size, np.bincount(place, c))
    return steps


# -- the attention's weights --------------------------------------------------


def windows_of(leads: list[int], data: list[bytes], classes: np.ndarray) -> tuple[Windows, np.ndarray]:
    """All windows of the pieces of a shard, and the classes that their targets are places in."""
    # An order that does not depend on the table's, mixed as like texts lie together.
    held = sorted(zip(data, leads, strict=True))
    own = classes[np.frombuffer(b"".join(piece for piece, _ in held), "<i4")]
    lengths = np.array([len(piece) // 4 for piece, _ in held], np.int32)
    lead = np.array([lead for _, lead in held], np.int32)
    per = -(-(lengths - lead) // STRIDE)
    piece = np.repeat(np.arange(len(held)), per)
    turn = np.arange(len(piece)) - np.repeat(np.cumsum(per) - per, per)
    mixed = np.random.default_rng(1).permutation(len(piece))
    piece, turn = piece[mixed], turn[mixed]
    begin = (lead[piece] + turn * STRIDE - CONTEXT - 1).astype(np.int32)  # in its piece
    span = np.arange(SPAN + 1, dtype=np.int32)
    inside = (span >= -begin[:, None]) & (span < (lengths[piece] - begin)[:, None])
    around = np.concatenate([np.full(CONTEXT + 1, END_CLASS, np.uint8), own, np.full(SPAN, END_CLASS, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(around, SPAN + 1)
    codes = np.where(inside, rows[(np.cumsum(lengths) - lengths)[piece] + begin + CONTEXT + 1], np.uint8(END_CLASS))
    there = inside[:, 1:]
    places = np.arange(codes.size, dtype=np.int32).reshape(codes.shape)
    target = np.where(there, places[:, 1:], -1)[:, CONTEXT:]
    return Windows(codes[:, :-1], there, target), codes.ravel()


def _descend(net: Broadcast, classes: Broadcast) -> Callable[[pa.Table], pa.Table]:
    """A round over one shard: its windows, and the weights it arrives at times these."""

    def descend(shard: pa.Table) -> pa.Table:
        windows, codes = windows_of(shard["c"].to_pylist(), shard["data"].to_pylist(), classes.value)
        own = Attention()
        own.set_mean(net.value.whole(), 1)
        own.descend(codes, windows, 1)
        n = len(windows.seen)
        return pa.table({"part": shard["part"][:1], "n": [n], "weights": [(n * own.whole()).tobytes()]})

    return descend


def _add_weights(part: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(weights, np.int64) for weights in part["weights"].to_pylist())
    return pa.table({"n": [pc.sum(part["n"]).as_py()], "weights": [total.tobytes()]})


def fit_attention(gathered: DataFrame, steps: np.ndarray, classes: np.ndarray, shards: int) -> Attention:
    """Tables from the steps between classes, then rounds over all gathered pieces, each piece
    in one of them."""
    net = Attention()
    if not steps.any():
        return net
    net.start(steps)
    context = gathered.sparkSession.sparkContext
    shared = context.broadcast(classes)
    # Weights are added up in as many parts as a part has shards.
    part = (F.col("key") % (isqrt(shards) + 1)).alias("part")
    windows = gathered.filter("kind = 'piece'").select("key", part, "c", "data")
    for turn in range(ROUNDS):
        work = _descend(context.broadcast(net), shared)
        found = windows.filter(F.col("key") % ROUNDS == turn).groupBy("key").applyInArrow(work, "part long, n long, weights binary")
        found = found.groupBy("part").applyInArrow(_add_weights, "n long, weights binary").toArrow()
        if found.num_rows:
            weights = sum(np.frombuffer(each, np.int64) for each in found["weights"].to_pylist())
            net.set_mean(weights, pc.sum(found["n"]).as_py())
    return net


# -- scores -------------------------------------------------------------------


class Model:
    """What the executors need: head words and their counts, shares, weights."""

    def __init__(self, path: str, head: dict[bytes, int], tokens: int, shares: Shares, net: Attention):
        self.path, self.head, self.tokens, self.shares, self.net = path, head, tokens, shares, net


class Lexicon(Spelling):
    """Per worker: units of the words met, and counts of head words."""

    def __init__(self, model: Model):
        self.model = model
        super().__init__(model.path, model.head)
        # One more, for all other words.
        self.count = np.array([*(model.head.get(word, 0) for word in self.base), 0], np.int64)


def spell(model: Model, units: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural logs of the words' probabilities; `lengths` are the units of each word, the
    end one of them, `sizes` the words of each text."""
    first = np.cumsum(lengths) - lengths
    text_first = np.cumsum(sizes) - sizes
    own, begin = model.net.log_probabilities(model.shares.classes[units], np.add.reduceat(lengths, text_first))
    before = np.append(len(model.shares.classes) - 1, units[:-1])
    before[first[text_first]] = len(model.shares.classes) - 1  # a text begins after an end
    own = own + model.shares.logs(before, units)
    # A word: its units, given that a word or the end begins here, and that it ends there.
    after = np.append(begin, np.float32(0))[first + lengths].astype(float)
    after[text_first + sizes - 1] = 0.0  # nothing follows an end
    return np.add.reduceat(own, first).astype(float) - begin[first] + after


def score_texts(lexicon: Lexicon, texts: list[str]) -> list[pa.Array]:
    """Per text: tokens, known head tokens, sum of log10(c + 1) over them, their model score,
    and the words outside the head with their logs."""
    words = [text.encode().lower().split() for text in texts]
    index = lexicon.look_up(words)
    every = np.concatenate(index)
    sizes = np.array([len(each) for each in index])
    text_first = np.cumsum(sizes) - sizes
    spelled = spell(lexicon.model, *lexicon.units(every), sizes)
    at = np.minimum(every, lexicon.n_base)
    count = lexicon.count[at]
    known = count > 0
    inner = at < lexicon.n_base  # the end has no count without training texts
    mixed = np.where(inner, mix(np.maximum(spelled, -600.0), count, lexicon.model.tokens), 0.0)
    logs = np.where(known, np.log10(count + 1.0), 0.0)
    n_known = np.add.reduceat(known.astype(np.int64), text_first)
    places = np.flatnonzero(~inner)
    owner = np.searchsorted(text_first, places, "right") - 1
    outside = [words[text][word] for text, word in zip(owner.tolist(), (places - text_first[owner]).tolist(), strict=True)]
    tail = pa.StructArray.from_arrays([pa.array(outside, pa.binary()), pa.array(spelled[places])], names=["word", "spelled"])
    offsets = np.searchsorted(places, np.append(text_first, len(every)))
    return [
        pa.array(sizes), pa.array(n_known), pa.array(np.add.reduceat(logs, text_first)),
        pa.array(np.add.reduceat(mixed, text_first)),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), tail),
    ]


def mix(spelled: np.ndarray, count: np.ndarray, tokens: int) -> np.ndarray:
    """log10 of a word's probability; `spelled` is its natural log under the attention model."""
    return np.log10(SHARE * count / max(1, tokens) + (1 - SHARE) * np.exp(spelled))


def fit(docs: DataFrame, target: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[Model, int, DataFrame]:
    """The model, the number of distinct training tokens, and (word, c) of all of them."""
    spark = docs.sparkSession
    texts = docs.filter(~held_out(F.col(id_col))).select(
        F.coalesce(text_col, F.lit("")).alias("text"), F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 40)).alias("place")
    )
    word_counts(texts).write.parquet(f"{target}/words")
    words = spark.read.parquet(f"{target}/words")
    counts = unit_counts(words, path)
    shards = 1 + int(counts.sum() // (STRIDE * ROUNDS * SHARD_WINDOWS))
    gather(texts, classify(counts), path, shards).write.partitionBy("kind").parquet(f"{target}/gathered", compression="zstd")
    gathered = spark.read.schema(_GATHERED).parquet(f"{target}/gathered")
    classes = np.append(fit_classes(gathered, counts), np.uint8(END_CLASS))
    shares = Shares(counts, classes)
    steps = pair_tables(gathered, shares)
    net = fit_attention(gathered, steps, classes, shards)

    totals = words.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    rows = most_frequent(words.filter("word != ''"), HEAD).toPandas()
    head = {word.encode(): int(c) for word, c in zip(rows["word"], rows["c"], strict=True)}
    ends = words.filter("word = ''").first()
    head[END] = ends["c"] if ends else 0  # whatever its rank: no join brings it
    return Model(path, head, totals["n"] or 0, shares, net), totals["v"], words


def score_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: folds, token counts, the base score and the model's score."""
    spark = docs.sparkSession
    target = scratch_path(spark, "lm")
    model, distinct, counts = fit(docs, target, path, id_col, text_col)
    tokens = model.tokens
    shared = spark.sparkContext.broadcast(model)
    names = ["doc_id", "held_out", "n_tokens", "head_known", "head_log", "score", "tail"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lexicon = _held("scores", shared.value, lambda: Lexicon(shared.value))
        texts = texts_of(batch.column(2))
        parts = [score_texts(lexicon, texts[a:b]) for a, b in by_bytes(texts)]
        columns = [pa.concat_arrays(column) for column in zip(*parts, strict=True)]
        columns = [pc.cast(batch.column(0), pa.int64()), batch.column(1), *columns]
        return pa.RecordBatch.from_arrays(columns, names=names)

    chosen = docs.select(
        F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text")
    )
    scored = map_batches(chosen, ["doc_id", "held_out", "text"], work, SCHEMA)
    scored.withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{target}/scored")
    scored = spark.read.parquet(f"{target}/scored")

    # Words outside the head are rare ones: the join has no hot key.
    tail = scored.select("row", F.explode("tail").alias("each"))
    tail = tail.select("row", F.col("each.word").cast("string").alias("word"), "each.spelled")
    c = F.coalesce("c", F.lit(0))
    mixed = F.exp("spelled") * (1 - SHARE) + c * (SHARE / max(1, tokens))
    # Words too unlikely for exp() and without a count.
    own = F.when(mixed > 0, F.log10(mixed)).otherwise((F.col("spelled") + float(np.log(1 - SHARE))) / float(np.log(10)))
    found = tail.join(counts, "word", "left").groupBy("row").agg(
        F.count_if(c > 0).alias("tail_known"), F.sum(F.log10(c + 1)).alias("tail_log"),
        F.sum(own).alias("tail_score"),
    )
    n_known = F.col("head_known") + F.coalesce("tail_known", F.lit(0))
    logs = F.col("head_log") + F.coalesce("tail_log", F.lit(0.0))
    return scored.join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", n_known.alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(F.lit(float(tokens + distinct + 1)))).alias("base_score"),
        (F.col("score") + F.coalesce("tail_score", F.lit(0.0))).alias("score"),
    )
