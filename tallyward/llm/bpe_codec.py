"""BPE encoding by backtracking, decoding by an offset table.

A sequence of tokens is what byte-pair merging gives exactly if every two neighbours
are compatible: merging their joined text would stop at the border between them.
The encoder takes the longest token at each place (found by one Aho-Corasick pass over
the word), goes to a shorter one if it does not fit the token before, and back if none
fits; a place from which the end cannot be reached is never entered twice, so the time
is linear.  Compatibility is worked out from the merges once per pair and remembered.

Text is prepared as the tokenizer file says: canonical composition, lower case
(character by character), words by its pattern, UTF-8 bytes, and an end mark that
belongs to the last byte of a word.  Decoding reads token strings at their offsets in
one table and joins them by a space, as the library does for a file without decoder.

NULL and empty texts have no ids and decode to the empty text.  Each row is treated by
itself, so repeated rows give equal results.  Very long texts are encoded whole, word by
word; an empty table gives no rows, further columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tallyward.llm.common import cut, map_batches, texts_of

#: Distinct words whose ids a worker remembers, and compatible or incompatible pairs.
REMEMBERED = 500_000
REMEMBERED_PAIRS = 500_000

#: Stands for the end of a word, beyond all bytes.
_END = "Ā"
#: The pattern of the file, with white space as Unicode defines it.
_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
).findall

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_symbols() -> list[str]:
    """The printable character that byte-level files write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    symbols = {byte: chr(byte) for byte in shown}
    symbols |= {byte: chr(256 + at) for at, byte in enumerate(hidden)}
    return [symbols[byte] for byte in range(256)]


class BpeCodec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        suffix = model["end_of_word_suffix"]
        vocabulary: dict[str, int] = model["vocab"]
        self.special = {each["content"]: each["id"] for each in parts["added_tokens"]}
        self._specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))

        back = {symbol: chr(byte) for byte, symbol in enumerate(byte_symbols())}

        def plain(token: str) -> str:
            """Bytes as Latin-1 characters, the end of a word as one mark."""
            end = _END if token.endswith(suffix) else ""
            return "".join(back[c] for c in token.removesuffix(suffix)) + end

        texts = {token: plain(token) for token in vocabulary if token not in self.special}
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            token = vocabulary[left + right]
            pair = vocabulary[left], vocabulary[right]
            self.rank[pair] = rank
            self.merged[pair] = token
            self.halves.setdefault(token, pair)
            self.born.setdefault(token, rank)
        self.length = {vocabulary[token]: len(text) for token, text in texts.items()}
        by_text = {text: vocabulary[token] for token, text in texts.items()}
        # Tokens that merging never leaves whole cannot be part of a result.
        usable = {text: token for text, token in by_text.items() if self._whole(token)}
        self.shorter: dict[int, int | None] = {}
        self.automaton = ahocorasick.Automaton()
        for text, token in usable.items():
            self.automaton.add_word(text, (len(text), token))
            cuts = (usable.get(text[:n]) for n in range(len(text) - 1, 0, -1))
            self.shorter[token] = next((each for each in cuts if each is not None), None)
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

        # The offset table: token i is the bytes from offsets[i] to offsets[i + 1].
        every = sorted((vocabulary | self.special).items(), key=lambda item: item[1])
        size = every[-1][1] + 1
        strings = [b""] * size
        for token, at in every:
            strings[at] = token.encode()
        self.table = b"".join(strings)
        self.offsets = np.concatenate([[0], np.cumsum([len(each) for each in strings])])
        spans = zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist(), strict=True)
        self._token = [self.table[start:end] for start, end in spans].__getitem__

    # -- encoding ---------------------------------------------------------

    def _first(self, token: int, below: int) -> int:
        """The leftmost part of `token` before merge number `below`."""
        while self.born.get(token, -1) >= below:
            token = self.halves[token][0]
        return token

    def _last(self, token: int, below: int) -> int:
        while self.born.get(token, -1) >= below:
            token = self.halves[token][1]
        return token

    def _whole(self, token: int) -> bool:
        """Whether merging a token's own text gives the token."""
        if token not in self.halves:
            return True
        left, right = self.halves[token]
        return self._stays_apart(left, right, self.born[token]) and all(
            part not in self.halves or self.born[part] < self.born[token] for part in (left, right)
        )

    def _stays_apart(self, left: int, right: int, until: int | None = None) -> bool:
        """Whether no merge before number `until` joins the two across their border.

        The parts that meet at the border are known for every moment: the last part of
        `left` and the first of `right` as far as they have been merged by then.
        """
        a, b = left, right
        grows, limits = {self.born.get(left, -1)}, {self.born.get(right, -1)}
        while a in self.halves:
            a = self.halves[a][1]
            grows.add(self.born.get(a, -1))
        while b in self.halves:
            b = self.halves[b][0]
            limits.add(self.born.get(b, -1))
        moments = sorted(limits | grows)
        for at, moment in enumerate(moments):
            # From just after this moment to the next one the border is (a, b).
            a, b = self._last(left, moment + 1), self._first(right, moment + 1)
            rank = self.rank.get((a, b))
            if rank is None or until is not None and rank >= until:
                continue
            following = moments[at + 1] if at + 1 < len(moments) else None
            if following is None or rank < following:
                return False
            # Equal merges go from left to right: the one across the border comes
            # before one in the right token, but after one in the left token.
            if rank == following and following not in grows:
                return False
        return True

    def compatible(self, left: int, right: int) -> bool:
        pair = left, right
        found = self.fits.get(pair)
        if found is None:
            if len(self.fits) >= REMEMBERED_PAIRS:
                self.fits.clear()
            found = self.fits[pair] = self._stays_apart(left, right)
        return found

    def encode_piece(self, piece: str) -> bytes:
        """The ids of one piece of the pre-tokenizer."""
        text = piece.encode().decode("latin-1") + _END
        size = len(text)
        longest: list[int | None] = [None] * (size + 1)
        length, shorter, compatible = self.length, self.shorter, self.compatible
        for end, (n, token) in self.automaton.iter(text):
            longest[end - n + 1] = token  # ends ascend: the last match is the longest
        open_ = bytearray(b"\1") * (size + 1)
        found: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            while token is not None:
                end = at + length[token]
                if open_[end] and (not found or compatible(found[-1], token)):
                    break
                token = shorter[token]
            if token is not None:
                found.append(token)
                at, token = end, longest[end]
                if at == size:
                    break
                if token is not None:
                    continue
            # Nothing fits here: take back the token before and try a shorter one.
            open_[at] = 0
            token = found.pop()
            at -= length[token]
        return array("I", found).tobytes()

    def _encode_word(self, word: str) -> bytes:
        """The ids of a stretch without white space."""
        if self._specials.search(word):
            parts, at = [], 0
            for match in self._specials.finditer(word):
                parts.append(self._encode_plain(word[at : match.start()]))
                parts.append(array("I", [self.special[match[0]]]).tobytes())
                at = match.end()
            return b"".join([*parts, self._encode_plain(word[at:])])
        return self._encode_plain(word)

    def _encode_plain(self, text: str) -> bytes:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        parts = []
        for piece in _PIECES(text):
            ids = self.pieces.get(piece)
            if ids is None:
                if len(self.pieces) >= REMEMBERED:
                    self.pieces.clear()
                ids = self.pieces[piece] = self.encode_piece(piece)
            parts.append(ids)
        return b"".join(parts)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        parts = []
        for piece in cut(text):
            words = piece.encode().split()
            new = set(words).difference(self.known)
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = set(words)
            for word in new:
                self.known[word] = self._encode_word(word.decode())
            parts.extend(map(self.known.__getitem__, words))
        return b"".join(parts)

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: bytes) -> bytes:
        return b" ".join(map(self._token, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[str, BpeCodec] = {}


def codec(path: str) -> BpeCodec:
    """One codec per worker process and file."""
    if path not in _CODECS:
        _CODECS[path] = BpeCodec(path)
    return _CODECS[path]


def bpe_round_trip(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False
) -> DataFrame:
    """Per document: its number of ids and digests of the ids and of their decoding.

    With `ids`, the ids themselves and the decoded text follow.
    """
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    schema = SCHEMA
    if ids:
        kinds += [pa.list_(pa.int64()), pa.string()]
        schema += ", ids array<long>, decoded string"
    names = [field.split()[0] for field in schema.split(", ")]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = codec(path)
        rows = []
        for text in texts_of(batch.column(1)):
            packed = bpe.encode(text)
            decoded = bpe.decode(packed)
            row = [len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()]
            if ids:
                row += [np.frombuffer(packed, "<u4").astype(np.int64), decoded.decode()]
            rows.append(row)
        columns = [pc.cast(batch.column(0), pa.int64()), *zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays(
            [column if isinstance(column, pa.Array) else pa.array(column, kind)
             for column, kind in zip(columns, kinds, strict=True)],
            names=names,
        )

    return map_batches(docs, [id_col, text_col], work, schema)
