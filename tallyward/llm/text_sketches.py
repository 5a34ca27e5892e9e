"""Fingerprints of texts as invertible Bloom lookup sketches of their paragraphs.

A paragraph is a sentence of a line; a piece longer than `LONG` characters is cut after words
that their checksum names, so that an edit changes few pieces, and where it would still be
longer.  The n-th occurrence of
a paragraph is a paragraph of its own.  A sketch has three tables of cells; each paragraph's
digest goes into one cell of each: a count, the exclusive or of digests, and that of their
checksums.  A sketch of half the size is the fold of the larger one.

Two texts' sketches are subtracted cell by cell.  What both have cancels out, and peeling
cells with a single digest recovers the digests that only one has.  If digests remain, both
texts are sketched at twice the size, until all are recovered.  Likeness is the share of the
paragraphs of both that both have, 1 for two texts without paragraphs.

NULL texts are empty: cells of zeros.  White space around paragraphs does not count, nor does
their order.  Equal texts have equal fingerprints.  Rows are ordered by id, NULL first, then
by a hash of the text; repeated rows follow each other.  Very long texts are held whole by
their task, with the text that follows.  An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyward.llm.common import by_bytes, map_batches, quoted

#: Cells of each table are two to the power of this, in a fingerprint and at most.
POWER, MOST_POWER = 3, 26
TABLES = 3
#: Characters of a paragraph that is not cut, and one of how many words ends a piece.
LONG, WORDS = 400, 16
#: Bytes of text that a range of ids has about.
RANGE_BYTES = 16 << 20

_SENTENCE = re.compile(r"\n|(?<=[.!?])\s+")
_CELL = np.dtype([("count", "<i4"), ("digest", "<u8"), ("check", "<u4")])
_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def paragraphs(text: str) -> list[str]:
    found: list[str] = []
    for piece in _SENTENCE.split(text):
        piece = piece.strip()
        if len(piece) <= LONG:
            if piece:
                found.append(piece)
            continue
        words: list[str] = []
        size = 0
        for word in piece.split():
            for at in range(0, len(word), LONG):
                words.append(word[at : at + LONG])
                size += len(words[-1]) + 1
                if size > LONG or zlib.crc32(word.encode()) % WORDS == 0:
                    found.append(" ".join(words))
                    words, size = [], 0
        if words:
            found.append(" ".join(words))
    return found


def _mix(keys: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits (the finishing steps of SplitMix64)."""
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


def _check(digests: np.ndarray) -> np.ndarray:
    return (_mix(digests + np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)


@dataclass
class Digests:
    """The digests of some texts' paragraphs, those of a text together."""

    digest: np.ndarray
    sizes: np.ndarray  # paragraphs of each text

    @classmethod
    def of(cls, texts: list[str]) -> Digests:
        lists = [paragraphs(text) for text in texts]
        sizes = np.array([len(each) for each in lists], np.int64)
        plain = np.fromiter(
            (xxhash.xxh3_64_intdigest(each.encode()) for pieces in lists for each in pieces), np.uint64, sizes.sum()
        )
        owner = np.repeat(np.arange(len(texts)), sizes)
        order = np.lexsort((plain, owner))
        plain = plain[order]
        again = np.append(False, (plain[1:] == plain[:-1]) & (owner[1:] == owner[:-1]))[: len(plain)]
        place = np.arange(len(plain))
        turn = place - np.maximum.accumulate(np.where(again, 0, place)) if len(plain) else place
        return cls(_mix(plain + turn.astype(np.uint64) * _SALTS[0]), sizes)

    def take(self, rows: np.ndarray) -> Digests:
        first = np.cumsum(self.sizes) - self.sizes
        sizes = self.sizes[rows]
        start = np.cumsum(sizes) - sizes
        places = np.repeat(first[rows] - start, sizes) + np.arange(sizes.sum())
        return Digests(self.digest[places], sizes)


class Cells:
    """Sketches of some texts: count, digest and check by text and cell."""

    def __init__(self, size: int, power: int):
        self.power, shape = power, (size, TABLES << power)
        self.count = np.zeros(shape, np.int32)
        self.digest, self.check = np.zeros(shape, np.uint64), np.zeros(shape, np.uint32)

    @classmethod
    def of(cls, digests: Digests, power: int) -> Cells:
        cells = cls(len(digests.sizes), power)
        owner = np.repeat(np.arange(len(digests.sizes)), digests.sizes)
        cells.put(owner, digests.digest, np.ones(len(owner), np.int32))
        return cells

    def put(self, owner: np.ndarray, digest: np.ndarray, times: np.ndarray) -> None:
        for table, salt in enumerate(_SALTS):
            place = (_mix(digest ^ salt) & np.uint64((1 << self.power) - 1)).astype(np.int64)
            place += owner * (TABLES << self.power) + (table << self.power)
            np.add.at(self.count.reshape(-1), place, times)
            np.bitwise_xor.at(self.digest.reshape(-1), place, digest)
            np.bitwise_xor.at(self.check.reshape(-1), place, _check(digest))

    def minus(self, other: Cells) -> Cells:
        left = Cells(0, self.power)
        left.count = self.count - other.count
        left.digest, left.check = self.digest ^ other.digest, self.check ^ other.check
        return left

    def fold(self, power: int) -> Cells:
        """The sketches at a smaller size."""
        small = Cells(0, power)
        shape = (len(self.count), TABLES, -1, 1 << power)
        small.count = self.count.reshape(shape).sum(axis=2, dtype=np.int32).reshape(len(self.count), -1)
        for name in ("digest", "check"):
            folded = np.bitwise_xor.reduce(getattr(self, name).reshape(shape), axis=2)
            setattr(small, name, folded.reshape(len(folded), -1))
        return small

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a difference: text, digest and sign of what was recovered, and which texts were
        recovered in full.  The cells are used up."""
        width = self.count.shape[1]
        found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32))]
        for _ in range(2 * width):
            single = (np.abs(self.count) == 1) & (self.check == _check(self.digest))
            place = np.flatnonzero(single)
            if not len(place):
                break
            owner, digest, sign = place // width, self.digest.ravel()[place], self.count.ravel()[place]
            order = np.lexsort((digest, owner))  # once each, though in up to three cells
            owner, digest, sign = owner[order], digest[order], sign[order]
            new = np.append(True, (owner[1:] != owner[:-1]) | (digest[1:] != digest[:-1]))
            owner, digest, sign = owner[new], digest[new], sign[new]
            found.append((owner, digest, sign))
            self.put(owner, digest, -sign)
        rest = self.count.any(axis=1) | self.digest.any(axis=1) | self.check.any(axis=1)
        owner, digest, sign = (np.concatenate(part) for part in zip(*found, strict=True))
        return owner, digest, sign, ~rest

    def strings(self) -> list[str]:
        whole = np.empty(self.count.shape, _CELL)
        whole["count"], whole["digest"], whole["check"] = self.count, self.digest, self.check
        return [base64.b64encode(row.tobytes()).decode() for row in whole]

    @classmethod
    def parse(cls, strings: list[str]) -> Cells:
        """Fingerprints of one size."""
        rows = [np.frombuffer(base64.b64decode(text), _CELL) for text in strings]
        width = len(rows[0])
        cells = cls(0, (width // TABLES).bit_length() - 1)
        whole = np.concatenate(rows).reshape(len(rows), width)
        cells.count, cells.digest, cells.check = (whole[name] for name in ("count", "digest", "check"))
        return cells


@dataclass
class Difference:
    """Of two lists of texts: by pair, digests that only one has, their sign, and table size."""

    owner: np.ndarray
    digest: np.ndarray
    sign: np.ndarray
    power: np.ndarray
    sizes: np.ndarray  # paragraphs of both

    def likeness(self) -> np.ndarray:
        unlike = np.bincount(self.owner, minlength=len(self.sizes))
        return np.where(self.sizes > 0, 1 - unlike / np.maximum(self.sizes, 1), 1.0)

    def numbers(self, sign: int) -> np.ndarray:
        return np.bincount(self.owner[self.sign == sign], minlength=len(self.sizes))

    def lists(self, sign: int) -> list[np.ndarray]:
        some = np.flatnonzero(self.sign == sign)
        order = some[np.lexsort((self.digest[some], self.owner[some]))]
        return np.split(self.digest[order], np.cumsum(self.numbers(sign))[:-1])


def difference(left: Digests, right: Digests) -> Difference:
    """What only one of each pair has, by sketches of growing size."""
    todo, power = np.arange(len(left.sizes)), POWER
    powers = np.zeros(len(todo), np.int64)
    parts: list[tuple[np.ndarray, ...]] = []
    while len(todo):
        a, b = left.take(todo), right.take(todo)
        owner, digest, sign, done = Cells.of(a, power).minus(Cells.of(b, power)).peel()
        # Digests that were recovered in full also account for the difference in size.
        done &= np.bincount(owner, sign, minlength=len(todo)) == a.sizes - b.sizes
        kept = done[owner]
        parts.append((todo[owner[kept]], digest[kept], sign[kept]))
        powers[todo[done]] = power
        todo, power = todo[~done], power + 1
        if power > MOST_POWER and len(todo):
            raise ValueError("sketches of the largest size do not tell two texts apart")
    none = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32))
    owner, digest, sign = (np.concatenate(part) for part in zip(none, *parts, strict=True))
    return Difference(owner, digest, sign, powers, left.sizes + right.sizes)


def compare_texts(pairs: DataFrame, keep: list[str], left: str, right: str) -> DataFrame:
    """The `keep` columns, both fingerprints, likeness, and the digests that only one has."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [[text or "" for text in column.to_pylist()] for column in batch.columns[-2:]]
        a, b = map(Digests.of, texts)
        found = difference(a, b)
        columns = [pa.array(Cells.of(each, POWER).strings()) for each in (a, b)]
        columns.append(pa.array(found.likeness()))
        longs = pa.list_(pa.int64())
        columns += [pa.array([each.view(np.int64) for each in found.lists(sign)], longs) for sign in (1, -1)]
        return pa.RecordBatch.from_arrays([*batch.columns[:-2], *columns], names=names)

    names = [*keep, "fingerprint", "other_fingerprint", "likeness", "removed", "added"]
    chosen = pairs.select(*map(quoted, keep), F.col(left).alias("_a"), F.col(right).alias("_b"))
    kept = ", ".join(f"{quoted(name)} {kind}" for name, kind in chosen.dtypes[:-2])
    schema = "fingerprint string, other_fingerprint string, likeness double, removed array<long>, added array<long>"
    return map_batches(chosen, chosen.columns, work, f"{kept}, {schema}" if kept else schema)


def compare_fingerprints(left: str, right: str) -> tuple[list[int], list[int]] | None:
    """Digests that only one of two fingerprints has, or None if they are too many for it."""
    a, b = Cells.parse([left]), Cells.parse([right])
    power = min(a.power, b.power)
    owner, digest, sign, done = a.fold(power).minus(b.fold(power)).peel()
    if not done[0]:
        return None
    return sorted(digest[sign > 0].tolist()), sorted(digest[sign < 0].tolist())


def _ranges(rows: DataFrame) -> tuple[np.ndarray, int]:
    """The (id, tie) that each range of rows begins with, one of so many bytes, in order."""
    held = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(held // RANGE_BYTES) + 1
    keys = rows.select("id", "tie").repartitionByRange(parts, "id", "tie")
    least = keys.groupBy(F.spark_partition_id()).agg(F.min(F.struct("id", "tie")).alias("least"))
    firsts = sorted((row["least"]["id"], row["least"]["tie"]) for row in least.collect())
    return np.array(firsts, [("id", "i8"), ("tie", "i8")])


def with_next(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(part, borrowed, id, tie, text): ranges of ascending ids; each has, as borrowed, the
    row that the next range begins with, the last range the first row of all."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.xxhash64(text_col).alias("tie"), F.coalesce(text_col, F.lit("")).alias("text"),
    )
    firsts = _ranges(rows)
    shared = rows.sparkSession.sparkContext.broadcast(firsts)
    names = ["part", "borrowed", "doc_id", "id", "tie", "text"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = np.empty(batch.num_rows, shared.value.dtype)
        keys["id"], keys["tie"] = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        part = np.searchsorted(shared.value, keys, side="right") - 1
        first = np.flatnonzero(shared.value[part] == keys)
        row = np.append(np.arange(batch.num_rows), first)
        parts = np.append(part, (part[first] - 1) % len(shared.value)).astype(np.int32)
        columns = [pa.array(parts), pa.array(np.arange(len(row)) >= batch.num_rows)]
        columns += [column.take(pa.array(row)) for column in batch.columns]
        return pa.RecordBatch.from_arrays(columns, names=names)

    schema = "part int, borrowed boolean, doc_id long, id long, tie long, text string"
    return map_batches(rows, names[2:], work, schema), len(firsts)


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against its `edit` and against the text that follows it by id."""
    names = [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        "n_removed", "n_added", "cells",
    ]

    def result(ids: list[int | None], texts: list[str]) -> Iterator[pa.RecordBatch]:
        """Rows of all texts but the last, which only follows."""
        for a, b in by_bytes(texts[:-1]):
            some = texts[a : b + 1]
            edited = [edit(text, following) for text, following in zip(some, some[1:], strict=False)]
            plain, changed = Digests.of(some), Digests.of(edited)
            own = plain.take(np.arange(b - a))
            to_edited, to_next = difference(own, changed), difference(own, plain.take(np.arange(1, b - a + 1)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[a:b], pa.int64()), pa.array([len(text) for text in some[:-1]], pa.int64()),
                    pa.array([hashlib.sha256(text.encode()).hexdigest() for text in edited]),
                    *(pa.array(Cells.of(each, POWER).strings()) for each in (own, changed)),
                    pa.array(to_edited.likeness()), pa.array(to_next.likeness()),
                    *(pa.array(to_edited.numbers(sign)) for sign in (1, -1)), pa.array(TABLES << to_edited.power),
                ],
                names=names,
            )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[str] = []
        open_part = None
        for batch in batches:
            rows = zip(*(batch.column(at).to_pylist() for at in (0, 1, 2, 5)), strict=True)
            for part, borrowed, doc_id, text in rows:
                if part == open_part:
                    ids.append(doc_id)
                    texts.append(text)
                    if borrowed:  # the first of them closes the part
                        yield from result(ids, texts)
                        open_part = None
                elif not borrowed:
                    open_part, ids, texts = part, [doc_id], [text]
            if open_part is not None:
                yield from result(ids, texts)
                ids, texts = ids[-1:], texts[-1:]

    rows, parts = with_next(docs, id_col, text_col)
    if not parts:
        rows, parts = rows.limit(0), 1
    ordered = rows.repartitionById(parts, "part").sortWithinPartitions("part", "borrowed", "id", "tie")
    return ordered.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_removed long, n_added long, cells long",
    )
