"""A causal self-attention model over classes of subword ids, in numpy.

A unit is a subword id together with whether it begins a word, or the end of a text.
The most frequent units have a class each; the others are gathered in classes by the
company they keep in the training texts (k-means).  Within a class a unit's probability is
its share of the corpus counts, smoothed, given the unit before it in its word (``lm_score``).  The model
predicts first whether a word or the end begins, then the class of the next unit among
those: tables by the unit before, plus one head of attention over a window of units.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

import numpy as np

#: Units scored by a window, and units before them that it also sees.
STRIDE, CONTEXT = 24, 12
SPAN = STRIDE + CONTEXT
WIDTH = 12
#: Classes of single units that begin a word, of others, and shared ones of either sort.
SINGLE_STARTS, SINGLE_REST, SHARED = 32, 36, 24
#: Windows computed at a time.
_WINDOWS = 96

#: A parameter's unit as a whole number.
_PARTS = 1 << 24

#: Classes: single and shared starts, the end, then single and shared others.
STARTS = SINGLE_STARTS + SHARED + 1
END_CLASS = STARTS - 1
REST = SINGLE_REST + SHARED
CLASSES = STARTS + REST


#: Rows of a product at a time: below the size from which BLAS starts threads, which cost
#: more CPU time than they save where every core has a task of its own.
_ROWS = 128


def _times(rows: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """``rows @ matrix``, some rows at a time."""
    whole = len(rows) // _ROWS * _ROWS
    found = np.empty((len(rows), matrix.shape[1]), np.result_type(rows, matrix))
    np.matmul(rows[:whole].reshape(-1, _ROWS, rows.shape[1]), matrix, out=found[:whole].reshape(-1, _ROWS, matrix.shape[1]))
    np.matmul(rows[whole:], matrix, out=found[whole:])
    return found


def classify(counts: np.ndarray, company: Company | None = None) -> np.ndarray:
    """Class of each unit; without their `company`, units without one of their own are in
    the last shared class.

    `counts` has all ids as starts, then all ids as others.  A unit that no text has stays
    in the last shared class.
    """
    size = len(counts) // 2
    classes = np.empty(2 * size, np.uint8)
    for part, (base, single) in enumerate(((0, SINGLE_STARTS), (STARTS, SINGLE_REST))):
        own = counts[part * size : (part + 1) * size]
        order = np.lexsort((np.arange(size), -own)) + part * size
        classes[order] = base + single + SHARED - 1
        classes[order[:single]] = base + np.arange(single)
        if company is not None:
            seen = order[single:][company[order[single:]].any(axis=1)]
            if len(seen) >= SHARED:
                classes[seen] = base + single + _k_means(np.sqrt(company[seen]), SHARED - 1)
    return classes


#: Per unit and class: how much of the class the texts hold that the unit occurs in.
Company = np.ndarray
#: A text's shares of the classes are whole numbers, so that sums do not depend on order.
_WHOLE = 1 << 20


def add_company(places: np.ndarray, n: np.ndarray, sums: Company, classes: np.ndarray) -> None:
    """Add a text to `sums`, whole numbers: its distinct units, that have these rows, occur `n`
    times and have these `classes` without company."""
    if len(places):
        around = np.bincount(classes, n, CLASSES).astype(np.int64) * _WHOLE // int(n.sum())
        sums[places] += n[:, None] * around


def count_steps(stream: np.ndarray) -> np.ndarray:
    """How often each class follows each in a stream that begins after an end."""
    before = np.append(END_CLASS, stream[:-1]).astype(np.int64)
    return np.bincount(before * CLASSES + stream, minlength=CLASSES * CLASSES)


def _k_means(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Groups of rows of like direction; starts from rows far from each other."""
    rows = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    centres = rows[:1]
    near = rows @ centres[0]
    while len(centres) < k:
        centres = np.vstack([centres, rows[near.argmin()]])
        near = np.maximum(near, rows @ centres[-1])
    for _ in range(rounds):
        group = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, group, rows)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.maximum(norm, 1e-9), centres)
    return (rows @ centres.T).argmax(axis=1)


@dataclass
class Windows:
    """Windows over texts: what each position sees, predicts, and whether it counts."""

    seen: np.ndarray  # [n, SPAN] class of the unit before each position
    there: np.ndarray  # [n, SPAN] whether the position lies in the text
    target: np.ndarray  # [n, STRIDE] places in the stream; -1 outside

    def inside(self, some: slice | np.ndarray) -> np.ndarray:
        """The classes that some windows see, places outside the texts as one more."""
        return np.where(self.there[some], self.seen[some], np.uint8(CLASSES))

    @classmethod
    def over(cls, stream: np.ndarray, lengths: np.ndarray) -> Windows:
        """`stream` holds the classes of the texts' units, each text closed by its end."""
        per = -(-lengths // STRIDE)
        doc = np.repeat(np.arange(len(lengths)), per)
        start = np.cumsum(lengths) - lengths
        turn = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
        begin = start[doc] + turn * STRIDE - CONTEXT
        span = np.arange(SPAN)
        there = (span >= (turn == 0)[:, None] * CONTEXT) & (span < (start + lengths)[doc][:, None] - begin[:, None])
        around = np.full(len(stream) + CONTEXT + 1 + SPAN, END_CLASS, np.uint8)
        around[CONTEXT + 1 : CONTEXT + 1 + len(stream)] = stream
        seen = np.lib.stride_tricks.sliding_window_view(around, SPAN)[begin + CONTEXT]
        seen[turn == 0, CONTEXT] = END_CLASS  # a text begins after an end
        place = (begin + CONTEXT)[:, None] + span[:STRIDE]
        return cls(np.where(there, seen, np.uint8(END_CLASS)), there, np.where(there[:, CONTEXT:], place, -1))


class Attention:
    """Parameters and the forward pass; `descend` adds the gradients."""

    def __init__(self, seed: int = 42):
        draw = np.random.default_rng(seed)
        scale = 1 / np.sqrt(WIDTH)

        def matrix(*shape: int) -> np.ndarray:
            return (draw.standard_normal(shape) * scale).astype(np.float32)

        self.query, self.key, self.value = (matrix(CLASSES, WIDTH) for _ in range(3))
        # Of either side, and of the choice between them.
        self.starts, self.rest = np.zeros((CLASSES, STARTS), np.float32), np.zeros((CLASSES, REST), np.float32)
        self.out_starts, self.out_rest = matrix(WIDTH, STARTS) / 10, matrix(WIDTH, REST) / 10
        self.gate, self.out_gate = np.zeros(CLASSES, np.float32), np.zeros(WIDTH, np.float32)
        self.near = np.zeros(SPAN, np.float32)  # attention by distance
        distance = np.arange(CONTEXT, SPAN)[:, None] - np.arange(SPAN)
        self._visible = distance >= 0
        self._distance = np.clip(distance, 0, SPAN - 1)

    parts = (
        "starts", "rest", "gate", "query", "key", "value", "out_starts", "out_rest", "out_gate", "near",
    )

    def _tables(self) -> tuple[tuple[Any, ...], list[tuple[Any, ...]]]:
        """What `_attend` and `_logits` look up; for either side also the first of its classes.

        Places outside the texts have a row of their own: no query, key or value.  A column of
        ones in the values gives the sums of weights, one of the gate in each side's table the
        choice between them.  Logits above 60 are cut, where there can be any.
        """
        rows = np.zeros((3, CLASSES + 1, WIDTH + 1), self.value.dtype)
        rows[0, :-1, :-1], rows[1, :-1, :-1], rows[2, :-1, :-1] = self.query, np.clip(self.key, -9, 9), self.value
        rows[2, :-1, WIDTH] = 1
        bias = np.where(self._visible, self.near[self._distance], np.float32(-np.inf))
        query, key = rows[0, :, :-1].copy(), rows[1, :, :-1].copy()
        sides = []
        for table, out, base in ((self.starts, self.out_starts, 0), (self.rest, self.out_rest, STARTS)):
            # A mix of values lies between them.
            exceeds = table.max() + max(0.0, (self.value @ out).max()) > 60 or np.abs(self.gate).max() + np.abs(self.value @ self.out_gate).max() > 60
            sides.append((np.column_stack([table, self.gate]), np.column_stack([out, self.out_gate]), exceeds, base))
        return (query, key, rows[2], bias, (query @ key.T).max() > 60), sides

    def _attend(self, tables: tuple[Any, ...], seen: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per position its query, the keys, the weights of the places it sees, their sums, the
        values, and the mix of them.  Scores are small, so they need no shift."""
        query, key, value, bias, exceeds = tables
        # All places lie in their tables; with "clip", take() need not look at them first.
        q = query.take(seen[:, CONTEXT:], axis=0, mode="clip")
        k, v = key.take(seen, axis=0, mode="clip"), value.take(seen, axis=0, mode="clip")
        weight = np.matmul(q, k.transpose(0, 2, 1))
        if exceeds:
            np.minimum(weight, 60, out=weight)
        weight += bias
        np.exp(weight, out=weight)
        mixed = np.matmul(weight, v)
        total = np.maximum(mixed[:, :, WIDTH:], np.float32(1e-30))
        return q, k, weight, total, v, mixed[:, :, :WIDTH] / total

    @staticmethod
    def _by_side(seen: np.ndarray, target: np.ndarray, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The places that count, those before starts first and by the units before, these with
        128 more before others, and how many stand before starts."""
        target = target.ravel()
        after = stream.take(target, mode="clip") >= STARTS
        group = np.where(target >= 0, seen[:, CONTEXT:].ravel() + after * np.uint8(128), np.uint8(255))
        n = np.bincount(group, minlength=256)
        order = np.argsort(group, kind="stable")[: len(group) - n[255]]
        return order, group[order], int(n[:128].sum())

    @staticmethod
    def _logits(side: tuple[Any, ...], rows: np.ndarray, last: np.ndarray) -> np.ndarray:
        table, out, exceeds, _ = side
        logits = _times(rows, out)
        logits += table.take(last, axis=0, mode="clip")
        return np.minimum(logits, 60, out=logits) if exceeds else logits

    def log_probabilities(self, stream: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per unit of the stream: log of its class's probability, and of a word's begin or
        the end coming at its place.  Every unit is scored once."""
        windows = Windows.over(stream, lengths)
        own = np.empty(len(stream), np.float32)
        begin = np.empty(len(stream), np.float32)
        tables, sides = self._tables()
        for at in range(0, len(windows.seen), _WINDOWS):
            part = slice(at, at + _WINDOWS)
            seen, target = windows.inside(part), windows.target[part]
            *_, mixed = self._attend(tables, seen)
            keep, last, n = self._by_side(seen, target, stream)
            place, hidden = target.ravel()[keep], mixed.reshape(-1, WIDTH).take(keep, axis=0, mode="clip")
            for side, some in zip(sides, (slice(n), slice(n, None)), strict=True):
                base, where = side[-1], place[some]
                logits = self._logits(side, hidden[some], last[some] & np.uint8(127))
                chosen = logits[np.arange(len(logits)), stream[where] - np.uint8(base)]
                gate = np.clip(logits[:, -1], -30, 30)
                np.exp(logits, out=logits)
                begin[where] = begins = -np.log1p(np.exp(-gate))
                own[where] = chosen - np.log(_times(logits, _ones(logits))[:, 0]) + (begins - gate if base else begins)
        return own, begin

    def start(self, steps: np.ndarray) -> None:
        """Begin the tables from the steps between classes."""
        pairs = steps.reshape(CLASSES, CLASSES).astype(np.float64)
        prior = (pairs.sum(axis=0) + 1) / (pairs.sum() + CLASSES)
        smooth = (pairs + 2 * prior) / (pairs.sum(axis=1, keepdims=True) + 2)
        self.starts, self.rest = (np.log(part).astype(np.float32) for part in np.split(smooth, [STARTS], axis=1))
        chance = smooth[:, :STARTS].sum(axis=1)
        self.gate = np.log(chance / (1 - chance)).astype(np.float32)

    def whole(self) -> np.ndarray:
        """All parameters as whole numbers, so that sums do not depend on order."""
        flat = np.concatenate([getattr(self, name).ravel() for name in self.parts])
        return np.rint(flat.astype(np.float64) * _PARTS).astype(np.int64)

    def set_mean(self, total: np.ndarray, weight: int) -> None:
        """The parameters from a weighted sum of `whole`."""
        flat, at = (total / (weight * _PARTS)).astype(np.float32), 0
        for name in self.parts:
            own = getattr(self, name)
            setattr(self, name, flat[at : at + own.size].reshape(own.shape))
            at += own.size

    def descend(
        self, stream: np.ndarray, windows: Windows, rounds: int, rate: float = 0.01, batch: int = 192
    ) -> None:
        """Adam over some windows, from the parameters as they are."""
        draw = np.random.default_rng(1)
        # All parameters in one row, of which each is a part.
        flat, at = np.concatenate([getattr(self, name).ravel() for name in self.parts]), 0
        slow = np.empty(len(flat), np.float32)
        for name in self.parts:
            own = getattr(self, name)
            slow[at : at + own.size] = 0.1 if name in ("starts", "rest", "gate") else 1.0
            setattr(self, name, flat[at : at + own.size].reshape(own.shape))
            at += own.size
        first, second, step = np.zeros_like(flat), np.zeros_like(flat), 0
        for _ in range(rounds):
            order = draw.permutation(len(windows.seen))
            for at in range(0, len(order), batch):
                step += 1
                grads = self._gradients(stream, windows, order[at : at + batch])
                grad = np.concatenate([grads[name].ravel() for name in self.parts]).astype(np.float32, copy=False)
                first += np.float32(0.1) * (grad - first)
                grad *= grad
                grad -= second
                grad *= np.float32(0.01)
                second += grad
                scale = np.sqrt(second * np.float32(1 / (1 - 0.99**step)))
                scale += np.float32(1e-7)
                np.divide(first, scale, out=scale)
                scale *= slow
                scale *= np.float32(rate / (1 - 0.9**step))
                flat -= scale

    def _gradients(self, stream: np.ndarray, windows: Windows, some: np.ndarray) -> dict[str, np.ndarray]:
        tables, sides = self._tables()
        share = np.float32(1 / max(1, np.count_nonzero(windows.there[some, CONTEXT:])))
        parts = [
            self._gradients_of(tables, sides, stream, windows.inside(some[at : at + _WINDOWS]), windows.target[some[at : at + _WINDOWS]], share)
            for at in range(0, len(some), _WINDOWS)
        ]
        return {name: sum(part[name] for part in parts) for name in self.parts}

    def _gradients_of(
        self, tables: tuple[Any, ...], sides: list[tuple[Any, ...]], stream: np.ndarray, seen: np.ndarray, target: np.ndarray, share: np.float32
    ) -> dict[str, np.ndarray]:
        q, k, weight, total, v, mixed = self._attend(tables, seen)
        # In the order of the units before, whose rows of the tables are added up.
        keep, group, n = self._by_side(seen, target, stream)
        own, wanted = mixed.reshape(-1, WIDTH).take(keep, axis=0, mode="clip"), stream[target.ravel()[keep]]
        found: dict[str, np.ndarray] = {"gate": 0, "out_gate": 0}
        d_own = np.empty_like(own)
        for name, side, some in (("starts", sides[0], slice(n)), ("rest", sides[1], slice(n, None))):
            rows, last, (table, out, _, base) = own[some], group[some] & np.uint8(127), side
            logits = self._logits(side, rows, last)
            np.exp(logits, out=logits)
            gate = logits[:, -1] * share / (1 + logits[:, -1])
            logits *= np.repeat(share / _times(logits, _ones(logits)), logits.shape[1], axis=1)
            logits.ravel()[np.arange(len(rows)) * logits.shape[1] + wanted[some] - base] -= share
            logits[:, -1] = gate if base else gate - share
            d_table, d_out = _sum_runs(last, logits, CLASSES), rows.T @ logits
            found[name], found[f"out_{name}"] = d_table[:, :-1], d_out[:, :-1]
            found["gate"], found["out_gate"] = found["gate"] + d_table[:, -1], found["out_gate"] + d_out[:, -1]
            d_own[some] = _times(logits, np.ascontiguousarray(out.T))
        # A column more: what the sum of the weights takes.
        d_mixed = np.zeros((*mixed.shape[:2], WIDTH + 1), mixed.dtype)
        d_mixed.reshape(-1, WIDTH + 1)[keep, :WIDTH] = d_own
        d_mixed /= total  # instead of the weights, which are three times as many
        np.negative(np.einsum("nqw,nqw->nq", d_mixed[:, :, :WIDTH], mixed), out=d_mixed[:, :, WIDTH])
        d_score = np.matmul(d_mixed, v.transpose(0, 2, 1))
        d_score *= weight
        found["near"] = np.bincount(self._distance.ravel(), d_score.sum(axis=0).ravel(), minlength=SPAN)
        d_query = _sum_runs(group, np.matmul(d_score, k).reshape(-1, WIDTH).take(keep, axis=0, mode="clip"), 256)
        found["query"] = d_query[:CLASSES] + d_query[128 : 128 + CLASSES]
        order = np.argsort(seen, axis=None, kind="stable")
        held = seen.ravel()[order]
        for name, rows in (("key", np.matmul(d_score.transpose(0, 2, 1), q)), ("value", np.matmul(weight.transpose(0, 2, 1), d_mixed))):
            found[name] = _sum_runs(held, rows.reshape(len(held), -1).take(order, axis=0, mode="clip"), CLASSES + 1)[:CLASSES, :WIDTH]
        return found


def _ones(logits: np.ndarray) -> np.ndarray:
    """What sums up the logits' rows without the gate's column."""
    ones = np.ones((logits.shape[1], 1), logits.dtype)
    ones[-1] = 0
    return ones


def _sum_runs(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """The sums of the rows of each of `size` classes, rows of a class being together."""
    found, n = np.zeros((size, rows.shape[1]), rows.dtype), np.bincount(index, minlength=size)
    held = np.flatnonzero(n)
    if len(held):
        found[held] = np.add.reduceat(rows, (np.cumsum(n) - n)[held], axis=0)
    return found
