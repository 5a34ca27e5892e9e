"""Spelling groups, text sketches and the filter audit against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import filter_audit, spelling_groups, text_sketches
from tallyward.llm.common import PIECE_BYTES
from tallyward.llm.queries import ORACLE_SQL, QUERIES

#: Names of internal columns, a dot and a map, beside the columns of documents.
ODD = {"meta.lang": "'x'", "word": "1", "id": "'?'", "part": "2", "n": "map('a', 1)"}


def with_odd_columns(frame):
    for name, value in ODD.items():
        frame = frame.withColumn(name, F.expr(value))
    return frame


def spelled(rows):
    """(word, form, root, n, n_near, form_n) by the contract, from (doc_id, text)."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            check = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if check % 31 == 0:
                at = check % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    n = {word: times for word, times in counts.items() if len(word) >= 7 and times >= 2}
    holes, near = defaultdict(list), defaultdict(set)
    for word in n:
        for at in range(len(word)):
            holes[word[:at] + "\0" + word[at + 1 :]].append(word)
            short = word[:at] + word[at + 1 :]
            if short in n:
                near[word].add(short)
                near[short].add(word)
    for words in holes.values():
        for word in words:
            near[word] |= set(words) - {word}
    form = {}
    for word in n:
        best = min(near[word], key=lambda other: (-n[other], other), default=None)
        if best is not None and n[best] >= 10 * n[word]:
            form[word] = best

    def root(word):
        return root(form[word]) if word in form else word

    return {(word, form.get(word), root(word), n[word], len(near[word]), n.get(form.get(word))) for word in n}


def variants():
    """Texts full of near words: edits at both ends, doubled letters, ties, chains of forms."""
    draw = random.Random(3)
    base = ["letters", "spelling", "mississippi", "naïveté", "Ångström", "aaaaaaaa", "×÷×÷×÷×", "ANAGRAMS", "managrams"]
    words = []
    for word in base:
        words += [word] * 220
        edits = [word[:at] + word[at + 1 :] for at in range(len(word))]
        edits += [word[:at] + "e" + word[at:] for at in range(len(word) + 1)]
        edits += [word[:at] + "o" + word[at + 1 :] for at in range(len(word))]
        for each in edits:
            words += [each] * draw.choice([1, 2, 2, 21, 22])
    words += ["q" * 20_000, "q" * 20_001] * 2
    draw.shuffle(words)
    return [(at, " ".join(words[at::40])) for at in range(40)]


@pytest.mark.parametrize("group", [spelling_groups.GROUP, 60])
def test_spelling_groups(spark, table, docs, none, monkeypatch, group):
    monkeypatch.setattr(spelling_groups, "GROUP", group)
    made = spark.createDataFrame([*variants(), (None, "letters letters"), (7, None), (7, "")], "doc_id long, text string")
    for frame in (table("documents"), with_odd_columns(docs), made, made.union(made)):
        found = [tuple(row) for row in spelling_groups.spelling_groups(frame).collect()]
        assert len(found) == len(set(found))
        assert set(found) == spelled([(row["doc_id"], row["text"]) for row in frame.select("doc_id", "text").collect()])
    assert spelling_groups.spelling_groups(none).count() == 0


def test_near_words_against_all_pairs():
    draw = random.Random(5)
    for size, more in ((7, 0), (7, 1), (9, 0), (9, 1)):
        own, asking = (
            sorted({"".join(draw.choices("abé", k=length)) for _ in range(900)}) for length in (size, size + more)
        )
        pairs = [
            (asking[q], own[p])
            for part in spelling_groups.near_words(spelling_groups.as_letters(own), spelling_groups.as_letters(asking))
            for q, p in zip(*part, strict=True)
        ]
        if more:
            right = [(a, a[:at] + a[at + 1 :]) for a in asking for at in range(len(a))]
            right = {(a, b) for a, b in right if b in set(own)}
        else:
            right = {(a, b) for a in asking for b in own if sum(x != y for x, y in zip(a, b, strict=True)) == 1}
        assert len(pairs) == len(set(pairs)) and set(pairs) == right


def test_tree_reaches_every_point():
    draw = np.random.default_rng(1)
    points = np.unique(draw.integers(0, 4, (700, 9)), axis=0)
    away = np.abs(points[:, None] - points).sum(axis=2)
    for cells in (False, True):
        tree = spelling_groups.Tree(points, 8, cells)
        assert sorted(tree.order) == list(range(len(points)))
        for reach in (0, 1, 2):
            found = {(int(q), int(p)) for q, p in zip(*tree.pairs_within(points, points, reach), strict=True)}
            assert found == {(int(q), int(p)) for q, p in np.argwhere(away == reach)}
        query, _ = tree.leaves_within(points, 0)
        assert not cells or len(query) == len(points)  # cells do not overlap


def pieces(text):
    return Counter(text_sketches.paragraphs(text))


def alike(a, b):
    a, b = pieces(a), pieces(b)
    both = a.total() + b.total()
    return 1 - ((a - b).total() + (b - a).total()) / both if both else 1.0


@pytest.mark.parametrize("size", [text_sketches.RANGE_BYTES, 5_000])
def test_compare_edits(table, docs, none, monkeypatch, size):
    monkeypatch.setattr(text_sketches, "RANGE_BYTES", size)
    for frame in (table("documents"), with_odd_columns(docs), docs.filter("doc_id = 2")):
        rows = frame.select("doc_id", "text", F.xxhash64("text").alias("tie")).collect()
        rows.sort(key=lambda row: (row[0] is not None, row[0] or 0, row["tie"]))
        texts = [row["text"] or "" for row in rows]
        want = Counter()
        for row, text, following in zip(rows, texts, [*texts[1:], *texts[:1]], strict=True):
            half = len(text) // 2
            edited = text[: len(text) - half] + following[:half]
            digest = hashlib.sha256(edited.encode()).hexdigest()
            want[row[0], len(text), digest, round(alike(text, edited), 9), round(alike(text, following), 9)] += 1
        found = text_sketches.compare_edits(frame).collect()
        assert want == Counter(
            (r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in found
        )
        plain = {row[0]: text for row, text in zip(rows, texts, strict=True)}
        prints = defaultdict(set)
        for row in found:
            prints[plain[row["doc_id"]]].add(row["fingerprint"])
        assert all(len(each) == 1 for each in prints.values())
    assert text_sketches.compare_edits(none).count() == 0


def test_peeled_digests_are_those_that_only_one_has(spark):
    draw = random.Random(2)
    many = [f"Sentence {n} of {draw.random()}." for n in range(3_000)]
    pairs = [
        (1, " ".join(many), " ".join(many[:2_000] + many[2_500:])),  # a longer one, and repeated sketches
        (2, "\n".join(many[:9]), "\n".join(many[8::-1])),  # order does not count
        (3, "One. One. Two.", "One. Two. Two."),  # occurrences do
        (4, None, ""),
        (5, "", "One."),
        (6, "no stop " * 5_000, "no stop " * 4_000),
    ]
    frame = spark.createDataFrame(pairs, "`pair.id` long, removed string, added string")
    found = text_sketches.compare_texts(frame, ["pair.id"], "removed", "added").collect()
    for (_, a, b), row in zip(pairs, sorted(found), strict=True):
        a, b = a or "", b or ""
        digests = [set(text_sketches.Digests.of([text]).digest.view(np.int64).tolist()) for text in (a, b)]
        assert set(row["removed"]) == digests[0] - digests[1] and set(row["added"]) == digests[1] - digests[0]
        assert row["likeness"] == pytest.approx(alike(a, b))
        direct = text_sketches.compare_fingerprints(row["fingerprint"], row["other_fingerprint"])
        small = len(row["removed"]) + len(row["added"]) < 8
        assert (direct is not None) or not small
        if direct is not None:
            signed = [set(np.array(each, np.uint64).view(np.int64).tolist()) for each in direct]
            assert signed == [set(row["removed"]), set(row["added"])]


def test_long_pieces_are_cut():
    for text in ("word " * 3_000, "x" * 30_000, "no end " * 2_000 + "y" * 9_000, "short. " * 5):
        found = text_sketches.paragraphs(text)
        assert "".join(found).replace(" ", "") == text.replace(" ", "")
        assert max(map(len, found)) <= 2 * text_sketches.LONG
        half = text[: len(text) - len(text) // 2] + "Z" * (len(text) // 2)
        assert 0.3 < alike(text, half) < 0.7


def test_sketches_fold():
    digests = text_sketches.Digests.of([" ".join(f"S{n}." for n in range(40)), "", "a\nb"])
    large, small = text_sketches.Cells.of(digests, 7), text_sketches.Cells.of(digests, 4)
    assert large.fold(4).strings() == small.strings()
    assert text_sketches.Cells.parse(small.strings()).strings() == small.strings()


def audited(rows, labels):
    """The audit by applying the filters one after the other."""
    good = {doc_id for doc_id, quality, _ in labels if quality == 1 and doc_id is not None}
    toxic = {doc_id for doc_id, _, mark in labels if mark == 1 and doc_id is not None}
    rows = [(doc_id, text or "", part or "") for doc_id, text, part in rows]
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text] = min(doc_id, least.get(text, doc_id))

    def fails(doc_id, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        yield len(words) < 100
        yield 100 * len(set(words)) < 80 * len(words)
        yield 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)
        yield bool(re.search(r"[#$%&*|]", text))
        yield doc_id is not None and doc_id > least[text]

    failed = [{name for name, bad in zip("ABCDE", fails(i, text), strict=True) if bad} for i, text, _ in rows]
    found = {}
    for part in {part for *_, part in rows}:
        mine = [(i, sets) for (i, _, own), sets in zip(rows, failed, strict=True) if own == part]
        for order in permutations("ABCDE"):
            left, gone = mine, []
            for step, name in enumerate(order, 1):
                out = [row for row in left if name in row[1]]
                left = [row for row in left if name not in row[1]]
                found[part, "".join(order), step] = [
                    len(left), len(out), sum(name in row[1] for row in gone), sum(row[1] == {name} for row in mine),
                    sum(row[0] in good for row in out), sum(row[0] in toxic for row in out),
                ]
                gone = gone + out
        for name in "ABCDE":
            keys = [key for key in found if key[0] == part and key[1][key[2] - 1] == name]
            total = sum(found[key][1] for key in keys)
            for key in keys:
                found[key].append(total)
    return {(*key, *values) for key, values in found.items()}


def test_filter_audit(spark, table, docs, none):
    labels = table("labels").select("doc_id", "quality", "toxic")
    ties = [(1, 1, 0), (1, 0, 1), (2, None, 1), (None, 1, 1), (8, 1, None)]
    small = spark.createDataFrame(ties, "doc_id long, quality int, toxic int")
    copies = [(n, text, part) for n in range(30) for text, part in (("LOUD $ text", "a"), (None, None), ("", ""), ("LOUD $ text", "b"))]
    made = spark.createDataFrame([*copies, (None, "LOUD $ text", "a"), (None, None, None)], "doc_id long, text string, lang string")
    for frame, marks in (
        (table("documents").select("doc_id", "text", "lang"), labels),
        (with_odd_columns(docs.withColumnRenamed("component_id", "lang")), small),
        (made, small),
    ):
        found = [tuple(row) for row in filter_audit.filter_audit(frame, marks).collect()]
        assert len(found) == len(set(found))
        assert set(found) == audited(
            [tuple(row) for row in frame.select("doc_id", "text", "lang").collect()], [tuple(row) for row in marks.collect()]
        )
    assert filter_audit.filter_audit(none.withColumnRenamed("component_id", "lang"), small).count() == 0


def test_audit_query_equals_its_sql(spark, sf_dir):
    frame = QUERIES["op13_filter_audit"](spark, sf_dir)
    with duckdb.connect() as db:
        for name in ("documents", "labels"):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
        db.execute(f"CREATE VIEW audit AS {ORACLE_SQL['op13_filter_audit']}")
        theirs = db.execute("SELECT * FROM audit")
        kinds = {"VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint"}
        assert frame.dtypes == [(column[0], kinds[str(column[1])]) for column in theirs.description]
        assert sorted(map(tuple, frame.collect())) == sorted(theirs.fetchall())


def test_matrix_has_every_count(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD", 40)
    target = str(tmp_path / "matrix")
    dictionary, matrix = filter_audit.write_matrix(docs, target, F.lit("x"))
    word = {row["number"]: bytes(row["word"]).decode() for row in dictionary.collect()}
    assert len(word) == dictionary.count() == len(set(word.values()))
    found = Counter()
    for shard in matrix.collect():
        for at, doc_id in enumerate(shard["ids"]):
            cells = range(shard["starts"][at], shard["starts"][at + 1])
            columns = [shard["columns"][cell] for cell in cells]
            assert columns == sorted(columns)
            found[doc_id, frozenset((word[shard["columns"][cell]], shard["counts"][cell]) for cell in cells)] += 1
    want = Counter(
        (row["doc_id"], frozenset(Counter(re.findall(r"[^\x20\x09-\x0D]+", row["text"] or "")).items())) for row in docs.collect()
    )
    assert found == want


def test_a_shard_leaves_its_task_in_pieces(spark):
    """A row that holds a whole shard takes its size several times in each process."""
    texts = [" ".join(f"w{n * m % 5_003}" for m in range(4_000)) for n in range(1, 200)]
    rows = [(n, text if n % 7 else None) for n, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    local = filter_audit.local_shards(frame, F.lit("x"), "doc_id", "text").collect()
    size = {n: len(text or "") for n, text in rows}
    assert sum(size.values()) > 3 * PIECE_BYTES
    assert len({row["shard"] for row in local}) == 1 and len(local) > 3
    assert all(sum(size[n] for n in row["ids"]) <= PIECE_BYTES for row in local)
    words = [bytes(word) for row in sorted(local, key=lambda row: row["piece"]) for word in row["words"]]
    assert len(words) == len(set(words)) == 5_003
    assert sorted(n for row in local for n in row["ids"]) == sorted(size)


@pytest.mark.parametrize("name", ["op11_spelling_groups", "op12_text_sketches", "op13_filter_audit"])
def test_queries_cover_their_tables(spark, table, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir)
    assert rows.count() > 0
    if name == "op12_text_sketches":
        assert rows.count() == table("documents").count()
