"""Byte-level BPE through the tokenizers library, remembering words.

A single space between two characters that are not white space always begins a new
piece for the pre-tokenizer, so the ids of a text are those of its first word and of
each further word with a space before it.  Each worker encodes a word once; the words of
some texts at a time are told apart by Arrow, so that Python sees each of them once.
"""

from __future__ import annotations

import os
import re
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyward.llm.common import by_bytes, cut

#: Distinct words whose ids a worker remembers.
REMEMBERED = 1_300_000
#: Characters of texts taken at a time.
BATCH_BYTES = 3 << 19
_CALL_BYTES = 1 << 18
#: Below it, the pre-tokenizer and str.isalpha() know the same letters.
_LETTERS = "\u0530"
#: Most marks after a word's letters that are looked up by themselves, and most that are remembered.
_TAIL, _TAILS = 8, 10_000
_WORD = re.compile(r"(?<=\S) (?=\S)")


def _is_odd(word: str) -> bool:
    """Whether a word is empty or has white space at an end."""
    return not word or word.strip() != word


def _has_letters_only(word: str) -> bool:
    """Whether a word is of letters that the pre-tokenizer knows as such."""
    return word.isalpha() and (word.isascii() or max(word) < _LETTERS)


class ByteBpe:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size()
        self.known: dict[str, bytes] = {}
        self.lines: dict[str, bytes] = {}  # words at the start of a line, with its end before them
        # Every character of a byte-level token stands for one byte.
        self._bytes = np.zeros(self.size, np.int64)
        for token, at in self.tokenizer.get_vocab().items():
            self._bytes[at] = len(token)
        # The letter that stands for each byte, where it is another: those for bytes that
        # do not print follow each other from 256.
        unseen = [byte for byte in range(256) if byte < 33 or 127 <= byte <= 160 or byte == 173]
        self._shown = {byte: chr(256 + n) for n, byte in enumerate(unseen)}
        self._table = "".join(self._shown.get(byte, chr(byte)) for byte in range(256))
        self._line_end = self.tokenizer.token_to_id(self._shown[10])
        self._direct = self._takes_words()
        # Marks that are one piece after letters: no added token can begin or end among them.
        added = "".join(token.content for token in self.tokenizer.get_added_tokens_decoder().values())
        self._marks = "".join(set(string.punctuation).difference(added)) if self._direct else ""
        self._tails: dict[str, bytes] = {}

    def _takes_words(self) -> bool:
        """Whether a word of letters is a piece, and no added token can be a part of it."""
        from tokenizers import models, pre_tokenizers

        splitter, added = self.tokenizer.pre_tokenizer, self.tokenizer.get_added_tokens_decoder()
        return (
            isinstance(self.tokenizer.model, models.BPE)
            and isinstance(splitter, pre_tokenizers.ByteLevel)
            and splitter.use_regex and not splitter.add_prefix_space
            and self.tokenizer.normalizer is None and self._line_end is not None
            and not any(token.content.strip().isalpha() for token in added.values())
        )

    def _encode(self, texts: list[str]) -> list[bytes]:
        found: list[bytes] = []
        for start, end in by_bytes(texts, _CALL_BYTES):
            for each in self.tokenizer.encode_batch_fast(texts[start:end], add_special_tokens=False):
                found.append(array("I", each.ids).tobytes())
        return found

    def _by_model(self, words: list[str], mark: str) -> list[bytes]:
        """The ids of words of letters alone, each with a space or a line end before it.

        The pre-tokenizer would leave such a word in one piece, so the library's model
        takes it as it is.
        """
        tokenize, table = self.tokenizer.model.tokenize, self._table
        before, lead = (table[32], []) if mark == " " else ("", [self._line_end])
        ids: list[int] = []
        ends = [0]
        for word in words:
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(table)
            if lead:
                ids += lead
            ids += [token.id for token in tokenize(before + word)]
            ends.append(4 * len(ids))
        data = array("I", ids).tobytes()
        return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def ids_of_letters(self, words: list[str]) -> tuple[list[int], list[int], list[int], list[int]]:
        """Places of the words of letters among `words`, all their ids, each with a space before
        it, and how many each has; and places of the other words, which `encode_words` takes."""
        if not self._direct:
            return [], [], [], list(range(len(words)))
        tokenize, table = self.tokenizer.model.tokenize, self._table
        before = table[32]
        letters, ids, sizes, others = [], [], [], []
        for at, word in enumerate(words):
            if not word.isalpha():
                others.append(at)
                continue
            if not word.isascii():
                if max(word) >= _LETTERS:
                    others.append(at)
                    continue
                word = word.encode().decode("latin-1").translate(table)
            tokens = tokenize(before + word)
            ids += [token.id for token in tokens]
            sizes.append(len(tokens))
            letters.append(at)
        return letters, ids, sizes, others

    def stem(self, word: str) -> str:
        """A word's letters without the marks after them, where these are a piece of their own;
        otherwise the word itself."""
        stem = word.rstrip(self._marks) if self._marks else word
        return stem if len(word) - len(stem) <= _TAIL and _has_letters_only(stem) else word

    def tail(self, marks: str) -> bytes:
        """The ids of marks after letters."""
        return self._tail(marks)

    def _encode_joined(self, words: list[str], mark: str = " ") -> list[bytes]:
        """The ids of words, each with a space or a line end before it, by few calls of
        the library.

        Words without white space at their ends do not affect each other; the ids are
        dealt out by their bytes.
        """
        found: list[bytes] = []
        for start, end in by_bytes(words, 1 << 15):
            some = words[start:end]
            text = mark + mark.join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum([len(word.encode()) + 1 for word in some])
            places = np.cumsum(self._bytes[ids])
            cuts = np.searchsorted(places, ends) + 1
            data = ids.tobytes()
            spans = [0, *(4 * cuts).tolist()]
            found += [data[a:b] for a, b in zip(spans, spans[1:], strict=False)]
        return found

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of words, each with a space before it; none is remembered.

        Marks after letters are a piece of their own, so a word is encoded once with and
        without them.
        """
        odd = [word for word in words if _is_odd(word)]
        if odd:
            own = dict(zip(odd, self._encode([" " + word for word in odd]), strict=True))
            regular = [word for word in words if word not in own]
            own |= zip(regular, self._encode_regular(regular), strict=True)
            return [own[word] for word in words]
        return self._encode_regular(words)

    def _tail(self, marks: str) -> bytes:
        ids = self._tails.get(marks)
        if ids is None:
            if len(self._tails) >= _TAILS:
                self._tails.clear()
            ids = self._tails[marks] = self._encode([marks])[0]
        return ids

    def _encode_regular(self, words: list[str], mark: str = " ") -> list[bytes]:
        known, marks, tail = self.known if mark == " " else self.lines, self._marks, self._tail
        stems = []
        for word in words:
            stem = word.rstrip(marks) if marks else word
            if stem is not word and not (len(word) - len(stem) <= _TAIL and _has_letters_only(stem)):
                stem = word
            stems.append(stem)
        plain = [stem for stem in dict.fromkeys(stems) if stem not in known]
        letters = [word for word in plain if _has_letters_only(word)] if self._direct else []
        ids = dict(zip(letters, self._by_model(letters, mark), strict=True))
        others = [word for word in plain if word not in ids]
        ids |= zip(others, self._encode_joined(others, mark), strict=True)
        return [
            (ids[stem] if stem in ids else known[stem]) + (b"" if stem is word else tail(word[len(stem) :]))
            for word, stem in zip(words, stems, strict=True)
        ]

    def _ids_of(self, words: list[str]) -> list[bytes | None]:
        """The ids of distinct words, each with a space before it.

        A word that is empty or has white space at an end has None: there the space
        does not begin a piece.
        """
        found = list(map(self.known.get, words))
        new = [word for word, ids in zip(words, found, strict=True) if ids is None and not _is_odd(word)]
        if not new:
            return found
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
        fresh, passing = self._encode_new(new)
        self.known.update(fresh)
        fresh |= passing
        return [fresh.get(word) if ids is None else ids for word, ids in zip(words, found, strict=True)]

    def _encode_new(self, words: list[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """The ids of new words, and of those not worth remembering: words across a line end
        hardly come again, their halves do.

        A single line end between two others begins a piece, as a space does, so what
        stands on both sides of it is encoded by itself."""
        plain, halves = [], {}
        for word in words:
            if "\n" in word:
                before, _, after = word.partition("\n")
                if "\n" not in after and not _is_odd(before) and not _is_odd(after):
                    halves[word] = before, after
                    continue
            plain.append(word)
        wanted = {before for before, _ in halves.values()}.difference(self.known, plain)
        plain += wanted
        fresh = dict(zip(plain, self._encode_regular(plain), strict=True))
        passing = {word: fresh.pop(word) for word in words if "\n" in word and word not in halves}
        if halves:
            starts = [*{after for _, after in halves.values()}.difference(self.lines)]
            if len(self.lines) + len(starts) > REMEMBERED // 4:
                self.lines.clear()
                starts = [*{after for _, after in halves.values()}]
            self.lines.update(zip(starts, self._encode_regular(starts, "\n"), strict=True))
            for word, (before, after) in halves.items():
                first = fresh[before] if before in fresh else self.known[before]
                passing[word] = first + self.lines[after]
        return fresh, passing

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        found: list[bytes] = []
        for start, end in by_bytes(texts, BATCH_BYTES):
            if end - start == 1:
                found.append(b"".join(self._batch([piece])[0] for piece in cut(texts[start])))
            else:
                found += self._batch(texts[start:end])
        return found

    def _batch(self, texts: list[str]) -> list[bytes]:
        heads = self._encode([text.partition(" ")[0] for text in texts])
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = lists.values.dictionary_encode()
        offsets = lists.offsets.to_numpy().astype(np.int64)
        codes = np.delete(coded.indices.to_numpy(), offsets[:-1])  # without the heads
        bounds = offsets - np.arange(len(offsets))
        used = np.zeros(len(coded.dictionary), bool)
        used[codes] = True
        codes = (np.cumsum(used) - 1)[codes]
        ids = self._ids_of(coded.dictionary.filter(pa.array(used)).to_numpy(zero_copy_only=False).tolist())
        odd = np.fromiter((each is None for each in ids), bool, len(ids))
        ids = [each or b"" for each in ids]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(lengths) - lengths
        counts = lengths[codes]
        ends = np.append(0, np.cumsum(counts))
        places = np.repeat(first[codes] - ends[:-1], counts) + np.arange(ends[-1])
        data = np.frombuffer(b"".join(ids), "<u4")[places].tobytes()
        spans = (4 * ends[bounds]).tolist()
        irregular = np.diff(np.append(0, np.cumsum(odd[codes]))[bounds]) > 0
        return [
            self._irregular(text) if bad else head + data[a:b]
            for text, bad, head, a, b in zip(texts, irregular.tolist(), heads, spans, spans[1:], strict=False)
        ]

    def _irregular(self, text: str) -> bytes:
        """Split only where a space does begin a piece."""
        first, *middle = _WORD.split(text)
        last = middle.pop() if middle else None
        ends = self._encode([first] if last is None else [first, " " + last])
        distinct = list(dict.fromkeys(middle))
        ids = dict(zip(distinct, self._ids_of(distinct), strict=True))
        return b"".join([ends[0], *map(ids.__getitem__, middle), *ends[1:]])


_ENCODERS: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteBpe(path)
    return _ENCODERS[path]
