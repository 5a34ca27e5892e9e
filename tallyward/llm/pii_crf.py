"""Personal data: fixed patterns, and a linear-chain conditional random field.

The patterns (email, ip, card, phone) are found exactly.  The field labels the words of
a line by their shapes and those of their neighbours; it is trained from the small
labelled table in ``pii_tables`` by gradient ascent with forward-backward sums, and
decoded by Viterbi in numpy, for many lines at once.  Its spans are added where they do
not touch a pattern's; it also knows `secret`, for tokens and keys, `account`, for bank
accounts, and `identity`, for social security numbers.

Every kind needs a digit or an at sign, so the field is laid over the lines that have
one; in all other lines every word is O.  A secret of letters alone is not found.

NULL and empty texts have no spans.  Offsets are code points, the end exclusive.  Each
row is treated by itself, so repeated rows give equal results.  Very long texts are read
line by line, whole.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tallyward.llm.common import map_batches, texts_of
from tallyward.llm.pii_tables import KEY_BEGINNINGS, sentences

#: Kinds in the order of spans with equal starts.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "account", "identity")
LABELS = ("O", *KINDS)
Span = tuple[int, int, str]

SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "spans string, n_secret long, n_added long"
)

# -- patterns -----------------------------------------------------------------

_HINT = re.compile(r"[0-9@]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that starts inside a run of digits would have failed at the run's start, too.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(digit), 10)) for digit in digits[-2::-2])
    return (odd + even) % 10 == 0


def _emails(line: str) -> list[tuple[int, int]]:
    """From each at sign back over the local part; nothing is scanned twice."""
    found, after = [], 0
    at = line.find("@")
    while at >= 0:
        start = at
        while start > after and line[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(line, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            after = domain.end()
        else:
            after = at + 1
        at = line.find("@", after)
    return found


def base_spans(line: str) -> list[Span]:
    """The pattern's spans of one line, in order."""
    spans = [(start, end, "email") for start, end in _emails(line)]
    for match in _IP.finditer(line):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in match[0].split(".")):
            spans.append((*match.span(), "ip"))
    for match in _CARD.finditer(line):
        digits = match[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((*match.span(), "card"))
    for match in _PHONE.finditer(line):
        if 10 <= sum(c.isdigit() for c in match[0]) <= 15:
            spans.append((*match.span(), "phone"))
    return ordered(spans)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2]), span[1]))


# -- word shapes --------------------------------------------------------------

_WORDS = re.compile(r"[^ \t-\r]+")
_RUNS = re.compile(r"(.)\1+")
_QUOTES = "\"'`.,;:()[]<>!?|"
#: A run of letters and digits that is long enough for a key.
_KEY = re.compile(r"[0-9A-Za-z_+/=-]{16,}")
#: Changes between capitals, small letters and digits that a key has at least.
_CHANGES = 4
_MIXED = re.compile(r"[0-9A-Za-z]{12,}")
_KINDS_OF = re.compile(r"[0-9]+|[A-Z]+|[a-z]+")


def is_key(run: str) -> bool:
    """Whether a known beginning says so, or letters and digits change as if drawn by lot."""
    if run.startswith(KEY_BEGINNINGS):
        return True
    for mixed in _MIXED.findall(run):
        parts = _KINDS_OF.findall(mixed)
        digits = sum(len(part) for part in parts if part[0] <= "9")
        if len(parts) > _CHANGES and 0 < digits < len(mixed) and len(parts) * 7 > len(mixed):
            return True
    return False


def _shorten(match: re.Match[str]) -> str:
    run = match[0]
    before, mark, after = run.rpartition("=")
    if mark and len(after) >= 16:  # a name and its key
        return f"{before}={'x' if is_key(after) else after}"
    return "x" if is_key(run) else run


def fine(word: str) -> str:
    """Letters as a, A, digits as 9, runs of up to four digits by length, others once.

    Long mixed runs, which hardly share a shape, become x.  Marks around a word do not count.
    """
    word = _KEY.sub(_shorten, word.strip(_QUOTES) or word)
    shape = "".join(
        "9" if c in "0123456789" else "A" if c.isupper() else "a" if c.isalpha() else c for c in word
    )
    return _RUNS.sub(lambda m: m[1] * min(len(m[0]), 5) if m[1] == "9" else m[1], shape)


COARSE = (
    "edge", "word", "mark", "key", "email", "at", "dotted", "plus", "area", "long", "seven", "four",
    "three", "short", "zero", "social", "dashed", "account", "country", "equals", "number", "mixed", "named",
)
_COARSE_PATTERNS = (
    ("email", re.compile(r"[\w.%+-]+@[\w-]+(\.[\w-]+)+")), ("at", re.compile(r".*@.*")),
    ("dotted", re.compile(r"\d{1,3}(\.\d{1,3}){3}")), ("plus", re.compile(r"\+\d[\d().-]*")),
    ("long", re.compile(r"\d{14,19}")), ("four", re.compile(r"\d{4}")), ("zero", re.compile(r"0\d{1,4}([-/]\d{5,9})?")),
    ("seven", re.compile(r"\d{6,9}")), ("three", re.compile(r"\d{3}")),
    ("short", re.compile(r"\d{1,2}")), ("social", re.compile(r"\d{3}-\d{2}-\d{4}")),
    ("dashed", re.compile(r"\d+([-.]\d+)+")), ("account", re.compile(r"[A-Z]{2}\d\d[A-Z0-9]{11,30}")),
    ("country", re.compile(r"[A-Z]{2}\d\d")), ("number", re.compile(r"[\d.,:%/-]+")),
)


def coarse(word: str) -> str:
    if word.startswith("(") and re.match(r"\(\d{2,5}\)", word):
        return "area"
    bare = word.strip(_QUOTES)
    for name, pattern in _COARSE_PATTERNS:
        if pattern.fullmatch(bare):
            return name
    shape = fine(bare)
    if shape == "a" and bare not in ("x", "a") and len(bare) >= 16 and _KEY.fullmatch(bare) and is_key(bare):
        return "key"
    if shape.endswith("=a") and is_key(bare.rpartition("=")[2]) and len(bare) >= 16:
        return "named"
    if any(c in "0123456789@+" for c in word):
        return "mixed"
    if word in ("=", ":=", ":"):
        return "equals"
    return "word" if any(c.isalpha() for c in word) else "mark"


# -- the model ----------------------------------------------------------------


class Crf:
    """Weights: label by fine shape, by coarse shape here, before and after, and by label."""

    def __init__(self, shapes: list[str]):
        self.fine = {shape: at + 1 for at, shape in enumerate(shapes)}  # 0: not seen
        k = len(LABELS)
        self.w = [np.zeros((len(shapes) + 1, k)), *(np.zeros((len(COARSE), k)) for _ in range(3))]
        self.move = np.zeros((k, k))
        self.start = np.zeros(k)
        self._known: dict[str, tuple[int, int]] = {}

    def features(self, word: str) -> tuple[int, int]:
        found = self._known.get(word)
        if found is None:
            if len(self._known) > 200_000:
                self._known.clear()
            found = self._known[word] = (self.fine.get(fine(word), 0), COARSE.index(coarse(word)))
        return found

    def index(self, words: list[str]) -> np.ndarray:
        """Rows: fine, coarse, coarse before, coarse after."""
        pairs = np.array([self.features(word) for word in words], np.int64).reshape(-1, 2)
        shape = pairs[:, 1]
        around = np.concatenate([[0], shape, [0]])
        return np.stack([pairs[:, 0], shape, around[: len(shape)], around[2:]])

    def scores(self, index: np.ndarray) -> np.ndarray:
        return sum(w[index[at]] for at, w in enumerate(self.w))

    def decode(self, lines: list[list[str]]) -> list[np.ndarray]:
        """The best labels of each line; all lines advance together, longest first."""
        order = sorted(range(len(lines)), key=lambda at: -len(lines[at]))
        sizes = np.array([len(lines[at]) for at in order])
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(lines)
        if not len(sizes) or not sizes[0]:
            return found
        emit = [self.scores(self.index(lines[at])) for at in order]
        firsts = np.cumsum(sizes) - sizes
        flat = np.concatenate(emit)
        k = len(LABELS)
        back = np.zeros((len(flat), k), np.int8)
        live = int((sizes > 0).sum())
        best = self.start + flat[firsts[:live]]
        final = np.zeros((len(lines), k))
        final[:live] = best
        for step in range(1, int(sizes[0])):
            live = int((sizes > step).sum())
            rows = firsts[:live] + step
            through = best[:live, :, None] + self.move
            back[rows] = through.argmax(axis=1)
            best = through.max(axis=1) + flat[rows]
            final[:live] = best
        last = final.argmax(axis=1)
        for at, (line, size, first) in enumerate(zip(order, sizes, firsts, strict=True)):
            labels = np.zeros(size, np.int64)
            label = last[at]
            for step in range(size - 1, -1, -1):
                labels[step] = label
                label = back[first + step, label]
            found[line] = labels
        return found


def _gradient(crf: Crf, index: np.ndarray, gold: np.ndarray, total: list[np.ndarray]) -> float:
    """Adds the gradient of one sentence's log likelihood; returns the likelihood."""
    emit = crf.scores(index)
    n, k = emit.shape
    ahead, behind = np.zeros((n, k)), np.zeros((n, k))
    ahead[0] = crf.start + emit[0]
    for at in range(1, n):
        ahead[at] = np.logaddexp.reduce(ahead[at - 1][:, None] + crf.move, axis=0) + emit[at]
    for at in range(n - 2, -1, -1):
        behind[at] = np.logaddexp.reduce(crf.move + emit[at + 1] + behind[at + 1], axis=1)
    z = np.logaddexp.reduce(ahead[-1])
    node = np.exp(ahead + behind - z)
    wanted = np.eye(k)[gold]
    for at in range(4):
        np.add.at(total[at], index[at], wanted - node)
    for at in range(1, n):
        pair = ahead[at - 1][:, None] + crf.move + emit[at] + behind[at] - z
        total[4] -= np.exp(pair)
        total[4][gold[at - 1], gold[at]] += 1
    total[5] += wanted[0] - node[0]
    path = crf.start[gold[0]] + emit[np.arange(n), gold].sum() + crf.move[gold[:-1], gold[1:]].sum()
    return float(path - z)


def train(rows: list[list[tuple[str, str]]], rounds: int = 40, rate: float = 0.5, decay: float = 0.02) -> Crf:
    """Fit by full gradients with per-weight steps (AdaGrad) and an L2 penalty."""
    shapes = sorted({fine(word) for row in rows for word, _ in row})
    crf = Crf(shapes)
    data = [
        (crf.index([word for word, _ in row]), np.array([LABELS.index(label) for _, label in row]))
        for row in rows
    ]
    parts = [*crf.w, crf.move, crf.start]
    squares = [np.full_like(part, 1e-6) for part in parts]
    for _ in range(rounds):
        total = [np.zeros_like(part) for part in parts]
        for index, gold in data:
            _gradient(crf, index, gold, total)
        for part, step, square in zip(parts, total, squares, strict=True):
            step -= decay * part
            square += step * step
            part += rate * step / np.sqrt(square)
    return crf


@lru_cache(maxsize=1)
def model() -> Crf:
    """The field trained from the labelled table; the same in every process."""
    return train(sentences())


# -- spans of texts -----------------------------------------------------------


def _plausible(kind: str, text: str) -> bool:
    """Whether a labelled stretch can be of its kind: the patterns' own conditions."""
    digits = "".join(c for c in text if c in "0123456789")
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(part.isdecimal() and int(part) <= 255 for part in parts)
    if kind == "identity":
        return len(digits) == 9
    if kind == "account":
        return remainder(text) == 1
    return "@" in text if kind == "email" else len(text) >= 16


def remainder(account: str) -> int:
    """Of an account's letters and digits by 97, the country moved to the end: 1 if it is right."""
    plain = "".join(c for c in account if c.isascii() and c.isalnum()).upper()
    number = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
    return int(number) % 97 if 15 <= len(plain) <= 34 else 0


def _added(line: str, words: list[tuple[int, int]], labels: np.ndarray, base: list[Span]) -> list[Span]:
    """The field's spans: runs of one label, without marks at the ends."""
    found: list[Span] = []
    at = 0
    while at < len(words):
        label = labels[at]
        last = at
        while last + 1 < len(words) and labels[last + 1] == label:
            last += 1
        if label:
            start, end = words[at][0], words[last][1]
            while start < end and line[start] in _QUOTES.replace("(", ""):
                start += 1
            while end > start and line[end - 1] in _QUOTES:
                end -= 1
            kind = LABELS[label]
            if kind == "secret" and "=" in line[start:end].rstrip("="):  # a name and its key
                start = line.rindex("=", start, start + len(line[start:end].rstrip("="))) + 1
            if _plausible(kind, line[start:end]) and all(end <= s or start >= e for s, e, _ in base):
                found.append((start, end, kind))
        at = last + 1
    return found


def find_spans(texts: list[str], crf: Crf | None = None) -> list[tuple[list[Span], list[Span]]]:
    """Per text: the patterns' spans, and all spans."""
    crf = crf or model()
    places: list[tuple[int, int]] = []
    lines: list[str] = []
    for at, text in enumerate(texts):
        if not _HINT.search(text):
            continue
        start = 0
        for line in text.split("\n"):
            if _HINT.search(line):
                places.append((at, start))
                lines.append(line)
            start += len(line) + 1
    result: list[tuple[list[Span], list[Span]]] = [([], []) for _ in texts]
    spans = [[match.span() for match in _WORDS.finditer(line)] for line in lines]
    labels = crf.decode([[line[a:b] for a, b in each] for line, each in zip(lines, spans, strict=True)])
    for (at, start), line, words, named in zip(places, lines, spans, labels, strict=True):
        base = base_spans(line)
        every = ordered(base + _added(line, words, named, base)) if named.any() else base
        result[at][0].extend((a + start, b + start, kind) for a, b, kind in base)
        result[at][1].extend((a + start, b + start, kind) for a, b, kind in every)
    return result


def as_text(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _in_pieces(texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    from tallyward.llm.common import by_bytes

    return [found for a, b in by_bytes(texts) for found in find_spans(texts[a:b])]


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the spans and how many there are of each kind."""
    names = [field.split()[0] for field in SCHEMA.split(", ")]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for base, every in _in_pieces(texts_of(batch.column(1))):
            kinds = [kind for *_, kind in base]
            rows.append((
                *(kinds.count(kind) for kind in BASE_KINDS),
                hashlib.sha256(as_text(base).encode()).hexdigest(),
                as_text(every),
                sum(kind == "secret" for *_, kind in every),
                len(every) - len(base),
            ))
        columns = map(pa.array, zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pc.cast(batch.column(0), pa.int64()), *columns], names=names)

    return map_batches(docs, [id_col, text_col], work, SCHEMA)


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlaps become one."""
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def mask_personal_data(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """`docs` with personal data in its texts masked; `size_col`, if there, follows the text.

    Rows without personal data stay as they are, NULL texts too.
    """
    at = docs.columns.index(text_col)
    sized = docs.columns.index(size_col) if size_col in docs.columns else None

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(batch.columns)
        texts = columns[at].to_pylist()
        sizes = columns[sized].to_pylist() if sized is not None else []
        for row, (_, spans) in enumerate(_in_pieces([text or "" for text in texts])):
            if spans:
                texts[row] = mask(texts[row], spans)
                if sizes:
                    sizes[row] = len(texts[row])
        columns[at] = pa.array(texts, columns[at].type)
        if sized is not None:
            columns[sized] = pa.array(sizes, columns[sized].type)
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_batches(docs, docs.columns, work, docs.schema)
