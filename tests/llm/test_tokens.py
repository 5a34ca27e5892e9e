"""Tokenising operators against the library, packing against a plain reading."""

import hashlib
import random
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyward.llm import attention_model, bpe_codec, byte_bpe, lm_score, token_counts, token_files
from tallyward.llm.attention_model import CLASSES, CONTEXT, SPAN, STRIDE
from tests.llm.conftest import DOCS

WORD, BYTE = (public_tokenizers.path(name) for name in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids, tokenizer


@pytest.fixture(scope="module")
def odd_texts():
    dice = random.Random(3)
    letters = "abcdeéÄßñΣİ漢か'.-  \n\t ́​09½😀|<>rrrbbb"
    texts = ["".join(dice.choice(letters) for _ in range(dice.randint(0, 50))) for _ in range(800)]
    return texts + ["", "<|endoftext|>a<|startoftext|>", "a <|endoftext|> b", "aaaa" * 500, "ciónrrrrra nrrrrr bbbbatch"]


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_backtracking_equals_the_library(odd_texts):
    encode, tokenizer = library(WORD)
    codec = bpe_codec.codec(WORD)
    for text in odd_texts:
        ids = encode(text)
        packed = codec.encode(text)
        assert ids_of(packed) == ids, text
        assert codec.decode(packed).decode() == tokenizer.decode(ids, skip_special_tokens=False)


def test_byte_bpe_and_counts_equal_the_library(odd_texts):
    encode, _ = library(BYTE)
    assert [ids_of(each) for each in byte_bpe.encoder(BYTE).encode(odd_texts)] == list(map(encode, odd_texts))
    encode, _ = library(WORD)
    assert token_counts.counter(WORD).count(odd_texts) == [len(encode(text)) for text in odd_texts]


def test_memory_is_bounded_and_exact(odd_texts, monkeypatch):
    for module in (byte_bpe, token_counts, bpe_codec):
        monkeypatch.setattr(module, "REMEMBERED", 50)
    encode, _ = library(BYTE)
    assert [ids_of(x) for x in byte_bpe.ByteBpe(BYTE).encode(odd_texts)] == list(map(encode, odd_texts))
    encode, _ = library(WORD)
    assert token_counts.Counter(WORD).count(odd_texts) == [len(encode(text)) for text in odd_texts]


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 32])
def test_packing_round_trip_and_random_access(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 333, dtype=np.int64)
    packed = token_files.pack(ids, width)
    assert len(packed) == -(-333 * width // 8)
    for start, count in ((0, 333), (7, 20), (332, 1), (5, 0)):
        assert token_files.unpack(packed, width, start, count).tolist() == ids[start : start + count].tolist()


def test_a_word_of_letters_is_encoded_once_whatever_marks_follow(monkeypatch):
    taken, by_model = Counter(), byte_bpe.ByteBpe._by_model

    def counted(self, words, mark):
        taken.update((word, mark) for word in words)
        return by_model(self, words, mark)

    monkeypatch.setattr(byte_bpe.ByteBpe, "_by_model", counted)
    bpe, (encode, _) = byte_bpe.ByteBpe(BYTE), library(BYTE)
    for texts in (["a word réel"], ["a word. word, réel!!", "it word'. word's word<|", "a réel\nword.$$$ " + "word!!!!!!!!!! " * 2]):
        assert [ids_of(each) for each in bpe.encode(texts)] == list(map(encode, texts))
    assert taken["word", " "] == taken["réel", " "] == taken["word", "\n"] == 1


def test_token_files(spark, docs, none, tmp_path):
    encode, _ = library(BYTE)
    token_files.write_tokens(docs, str(tmp_path / "a"), BYTE)
    rows = token_files.token_digests(token_files.read_tokens(spark, str(tmp_path / "a"))).collect()
    assert len(rows) == len(DOCS)
    rows.sort(key=lambda row: row["start"])
    at = 0
    for row in rows:
        assert row["start"] == at
        at += row["n_tokens"]
    order = [row["doc_id"] for row in rows]
    assert order == sorted(order, key=lambda each: (each is not None, each))
    wanted = sorted((-1 if i is None else i, zlib.crc32(np.array([*encode(t), 0], "<u4").tobytes())) for i, t, _ in DOCS)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["ids_crc32"]) for r in rows) == wanted
    token_files.write_tokens(none, str(tmp_path / "b"), BYTE)
    assert token_files.token_digests(token_files.read_tokens(spark, str(tmp_path / "b"))).count() == 0


def test_counts_and_round_trip_queries(docs, none):
    encode, tokenizer = library(WORD)
    key = lambda row: (row[0] is not None, row[0] or 0, *row[1:])
    found = sorted(map(tuple, token_counts.token_counts(docs, WORD).collect()), key=key)
    wanted = [(i, len((t or "").encode()), len(encode(t)), len(encode(t)) > 2048) for i, t, _ in DOCS]
    assert found == sorted(wanted, key=key)
    found = sorted(map(tuple, bpe_codec.bpe_round_trip(docs, WORD).collect()), key=key)

    def digests(text):
        ids = encode(text)
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        data = np.array(ids, "<u4").tobytes()
        return len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    assert found == sorted([(i, *digests(t)) for i, t, _ in DOCS], key=key)
    assert token_counts.token_counts(none, WORD).count() == bpe_codec.bpe_round_trip(none, WORD).count() == 0


def test_words_of_letters_match_the_library():
    bpe = byte_bpe.ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))
    letters = [letter for letter in map(chr, range(0x530)) if letter.isalpha()]
    words = [*letters, *(f"a{letter}b." for letter in letters)]
    own = [np.frombuffer(ids, "<u4").tolist() for ids in bpe.encode_words(words)]
    assert own == [bpe.tokenizer.encode(" " + word, add_special_tokens=False).ids for word in words]


def test_words_across_line_ends_are_not_remembered():
    bpe = byte_bpe.ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["one two\nthree four", " lead  two\n\nthree \n", "Über,\nnaïve. 日本 x\ny"]
    own = [np.frombuffer(ids, "<u4").tolist() for ids in bpe.encode(texts)]
    assert own == [bpe.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert not any("\n" in word for word in bpe.known)


@pytest.fixture(scope="module")
def trained(spark, docs, tmp_path_factory):
    """A fit on more than 700 texts, with the head cut to 30 words and many shards."""
    rows = [(n, f"alpha beta w{n}x gamma{n % 7} " + "tail ends " * (n % 3)) for n in range(900)]
    rows.append((1001, "a long one " * 400))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    texts = [text for n, text in rows if zlib.crc32(str(n).encode()) % 7 != 2]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(lm_score, "HEAD", 30)
        patch.setattr(lm_score, "SHARD_WINDOWS", 8)
        model, distinct, words = lm_score.fit(frame, str(tmp_path_factory.mktemp("lm")), BYTE)
    return frame, texts, model, distinct, words


def test_counts_and_shares_come_from_all_training_texts(trained):
    _, texts, model, distinct, words = trained
    counts = Counter(word for text in texts for word in text.split())
    assert {row["word"]: row["c"] for row in words.collect()} == counts | {"": len(texts)}
    assert distinct == len(counts) + 1 and model.head[lm_score.END] == len(texts)
    assert len(model.head) <= 31 and model.tokens == counts.total() + len(texts)
    shares, end = model.shares, len(model.shares.classes) - 1
    single, pair, group = Counter(), Counter(), Counter()
    for stream in lm_score.Spelling(BYTE).streams(texts):
        stream = stream.tolist()
        for before, unit in zip([end, *stream], stream, strict=False):
            single[unit] += 1
            pair[shares.group[before], unit] += 1
            group[shares.group[before], shares.classes[unit]] += 1
    of_class = Counter()
    for unit in range(end):
        of_class[shares.classes[unit]] += single[unit] + 1
    for before in [end, *list(single)[:40], 5]:
        for unit in [*list(single)[:40], 7, 60_000]:
            if unit == end:
                continue
            plain = (single[unit] + 1) / of_class[shares.classes[unit]]
            part = pair[shares.group[before], unit] + lm_score.PLAIN * plain
            whole = group[shares.group[before], shares.classes[unit]] + lm_score.PLAIN
            found = shares.logs(np.array([before]), np.array([unit]))[0]
            assert found == pytest.approx(np.log(part / whole), abs=1e-4)


def test_the_fit_sees_a_fixed_share_of_all_windows(spark, trained, monkeypatch):
    frame, *_ = trained
    texts = frame.select("text", F.xxhash64("text").bitwiseAND((1 << 30) - 1).alias("place"))
    first = np.zeros(2 * byte_bpe.encoder(BYTE).size, np.uint8)
    rows = lm_score.gather(texts, first, BYTE, 5).filter("kind = 'window'").collect()
    assert {row["key"] for row in rows} == set(range(5))
    found = [np.frombuffer(row["data"], "<i4").reshape(-1, SPAN + 1) for row in rows]
    assert sum(map(len, found)) == sum(row["c"] for row in rows)
    streams = dict(zip([row["text"] for row in texts.collect()], lm_score.Spelling(BYTE).streams([row["text"] for row in texts.collect()]), strict=True))
    wanted = Counter()
    for row in texts.collect():
        stream = streams[row["text"]].tolist()
        for turn in range(row["place"] % lm_score.EVERY, -(-len(stream) // STRIDE), lm_score.EVERY):
            begin = turn * STRIDE - CONTEXT - 1
            wanted[tuple(stream[at] if 0 <= at < len(stream) else -1 for at in range(begin, begin + SPAN + 1))] += 1
    assert wanted == Counter(tuple(window.tolist()) for part in found for window in part)


def test_scores_word_by_word(trained):
    """The model's probabilities, place by place without windows in batches."""
    _, _, model, *_ = trained
    shares, net, end = model.shares, model.net, len(model.shares.classes) - 1

    def place(units, at):
        """Probabilities of all classes, and of a begin, at one place of a text."""
        seen = [int(shares.classes[unit]) for unit in [end, *units]]
        first = max(0, at // STRIDE * STRIDE - CONTEXT)
        query = net.query[seen[at]].astype(float)
        weight = np.array(
            [np.exp(query @ np.clip(net.key[seen[j]], -9, 9) + net.near[at - j]) for j in range(first, at + 1)]
        )
        hidden = weight @ net.value[seen[first : at + 1]] / weight.sum()
        begin = 1 / (1 + np.exp(-(hidden @ net.out_gate + net.gate[seen[at]])))
        starts = np.exp(net.starts[seen[at]] + hidden @ net.out_starts)
        rest = np.exp(net.rest[seen[at]] + hidden @ net.out_rest)
        return np.append(begin * starts / starts.sum(), (1 - begin) * rest / rest.sum()), begin

    lexicon = lm_score.Lexicon(model)
    for text in ("alpha beta w3x gamma1 tail ends", "", "new Words, alpha\n\tgamma9 " + "beta " * 40):
        words = [*text.encode().lower().split(), b""]
        index = lexicon.look_up([words[:-1]])[0]
        units, lengths = lexicon.units(index)
        units, at, logs = units.tolist(), 0, []
        for word, length in zip(words, lengths, strict=True):
            chance = 1 / place(units, at)[1]
            for _ in range(length):
                share = 1.0 if units[at] == end else np.exp(shares.logs(np.array([([end, *units])[at]]), np.array([units[at]])))[0]
                chance *= place(units, at)[0][shares.classes[units[at]]] * share
                at += 1
            if word:
                chance *= place(units, at)[1]
            count = model.head.get(word, 0)
            logs.append(np.log10(lm_score.SHARE * count / model.tokens + (1 - lm_score.SHARE) * chance))
        sizes, n_known, _, score, tail = lm_score.score_texts(lexicon, [text])
        outside = [(word, log) for word, log in zip(words, logs, strict=True) if word not in model.head]
        assert sizes.to_pylist() == [len(words)] and n_known.to_pylist() == [len(words) - len(outside)]
        inside = sum(log for word, log in zip(words, logs, strict=True) if word in model.head)
        assert score[0].as_py() == pytest.approx(inside, abs=1e-3)
        found = [(each["word"], each["spelled"] / np.log(10) + np.log10(1 - lm_score.SHARE)) for each in tail[0].as_py()]
        assert [word for word, _ in found] == [word for word, _ in outside]
        assert [log for _, log in found] == pytest.approx([log for _, log in outside], abs=1e-3)


def test_pairs_are_counted_as_they_are_added():
    draw = np.random.default_rng(3)
    held, want = (np.zeros(0, np.int64), np.zeros(0, np.int64)), Counter()
    for sizes in ((5, 0, 900), (), (4_000,)):
        new = [draw.integers(0, 1 << 33, 50)[draw.integers(0, 50, size)] for size in sizes]
        held = lm_score.add_pairs(held, new)
        want.update(key for each in new for key in each.tolist())
        assert dict(zip(*map(np.ndarray.tolist, held), strict=True)) == want
        assert len(held[0]) == len(want)


def test_gradients_against_differences():
    draw = np.random.default_rng(4)
    net = lm_score.Attention()
    lengths = np.array([30, 3, 25])
    stream = draw.integers(0, CLASSES, lengths.sum()).astype(np.uint8)
    windows = lm_score.Windows.over(stream, lengths)
    some = np.arange(len(windows.seen))
    for name in net.parts:
        setattr(net, name, (getattr(net, name) + draw.standard_normal(getattr(net, name).shape) / 5).astype(np.float64))
    found = net._gradients(stream, windows, some)
    for name in net.parts:
        own = getattr(net, name)
        for at in draw.integers(0, own.size, 12):
            losses = []
            for step in (1e-4, -1e-4):
                own.reshape(-1)[at] += step
                losses.append(-net.log_probabilities(stream, lengths)[0].astype(float).mean())
                own.reshape(-1)[at] -= step
            assert found[name].reshape(-1)[at] == pytest.approx((losses[0] - losses[1]) / 2e-4, abs=2e-3), name


def test_windows_see_their_own_text():
    draw = np.random.default_rng(6)
    lengths = np.array([1, 24, 25, 80, 2, 23])
    stream = draw.integers(0, CLASSES, lengths.sum()).astype(np.uint8)  # texts that no end closes, too
    windows = lm_score.Windows.over(stream, lengths)
    row = 0
    for first, length in zip((np.cumsum(lengths) - lengths).tolist(), lengths.tolist(), strict=True):
        for begin in range(-CONTEXT, length - CONTEXT, STRIDE):
            for at in range(SPAN):
                inside = 0 <= begin + at < length
                seen = lm_score.END_CLASS if begin + at <= 0 or not inside else stream[first + begin + at - 1]
                assert windows.there[row, at] == inside and windows.seen[row, at] == seen
                if at >= CONTEXT:
                    assert windows.target[row, at - CONTEXT] == (first + begin + at if inside else -1)
            row += 1
    assert row == len(windows.seen)


def test_gradients_of_large_batches_are_the_sum_of_parts(monkeypatch):
    draw = np.random.default_rng(7)
    net = lm_score.Attention()
    lengths = np.array([700, 1, 330, 24, 50])
    stream = draw.integers(0, CLASSES, lengths.sum()).astype(np.uint8)
    windows = lm_score.Windows.over(stream, lengths)
    net.start(np.bincount(draw.integers(0, CLASSES**2, 9000), minlength=CLASSES**2))
    some, found = draw.permutation(len(windows.seen)), []
    for size in (1000, 7, 1):
        monkeypatch.setattr(attention_model, "_WINDOWS", size)
        found.append(net._gradients(stream, windows, some) | dict(zip("ab", net.log_probabilities(stream, lengths), strict=True)))
    for name in (*net.parts, "a", "b"):
        assert all(np.allclose(found[0][name], other[name], atol=2e-5) for other in found[1:]), name


def test_a_word_met_lately_is_not_spelled_again(monkeypatch):
    """Neither when a memory is full, nor for marks after it."""
    monkeypatch.setattr(lm_score, "REMEMBERED", 40)
    spelling = lm_score.Spelling(BYTE, [b"base,", b"words"])
    asked, encode, plain = [], spelling.bpe.ids_of_letters, spelling.bpe.encode_words
    monkeypatch.setattr(spelling.bpe, "ids_of_letters", lambda words: asked.extend(words) or encode(words))
    monkeypatch.setattr(spelling.bpe, "encode_words", lambda words: asked.extend(words) or plain(words))
    names = [f"w{chr(97 + n // 26)}{chr(97 + n % 26)}" for n in range(200)]
    texts = [f"base, {name}, often and often, words {name} {name}... 7{n} \u65e5{name}!" for n, name in enumerate(names)]
    found = [stream for text in texts for stream in spelling.streams([text])]
    assert sum(word in ("often", "and") for word in asked) == 2 and asked.count("wac") == 1
    assert len(spelling.known) <= spelling.n_base + 50 and len(spelling.known.older) <= spelling.n_base + 50
    size = spelling.bpe.size
    for text, stream in zip(texts, found, strict=True):
        wanted = []
        for word in text.split():
            ids = spelling.bpe.tokenizer.encode(" " + word, add_special_tokens=False).ids
            wanted += [ids[0], *(size + each for each in ids[1:])]
        assert stream.tolist() == [*wanted, 2 * size]


def test_a_worker_holds_little(monkeypatch):
    monkeypatch.setattr(lm_score, "REMEMBERED", 50)
    spelling = lm_score.Spelling(BYTE, [b"base", b"words"])
    texts = [f"base t{n} u{n} v{n} words" for n in range(200)]
    many = [list(stream) for text in texts for stream in spelling.streams([text])]
    assert len(spelling.known) <= spelling.n_base + 50
    assert many == [list(stream) for stream in lm_score.Spelling(BYTE).streams(texts)]


def test_known_words_are_looked_up_once():
    asked = []

    class Counting(dict):
        def get(self, word):
            asked.append(word)
            return super().get(word)

        def __contains__(self, word):
            asked.append(word)
            return super().__contains__(word)

        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    bpe = byte_bpe.ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["one two three, four. " * 50 + "end", "three, two one", "a  b two\n\nthree one"]
    wanted = [array("I", each.ids).tobytes() for each in bpe.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert bpe.encode(texts) == wanted
    bpe.known = Counting(bpe.known)
    assert bpe.encode(texts) == wanted
    asked.clear()
    assert bpe.encode(texts[:2]) == wanted[:2]
    assert len(asked) <= sum(text.count(" ") for text in texts[:2])
