"""SimHash near-duplicates through a Gray-order hierarchical index.

A document's fingerprint has a bit set where more than half of its shingles' hashes
have it.  Two documents are linked if their fingerprints differ in `radius` bits at
most; a component is everything linked directly or through others.

Distinct fingerprints are spread by the bits of one of ``radius + 1`` blocks: two that
differ in no more than `radius` bits agree in one block at least.  A group that is still
large is spread again by blocks of the bits in which its members differ, until no group is
large.  In a group, fingerprints are
sorted by their rank in the Gray code, so neighbours differ in few bits; runs of them are
leaves, and runs of leaves upper nodes that hold the bits all below them share.  Pairs of
nodes are compared from the top: the differences in shared bits add up on the way down,
and beyond the radius both groups are passed over at once.  Nodes that are known to lie
in one component are passed over as well, so a group gives no more links than it has
members.  Components of the links come from alternating star contraction in Spark.

NULL and empty texts have fingerprint 0 and are linked like others.  Repeated rows and
exact copies share a fingerprint.  NULL ids keep their rows; a component of NULL ids
alone has component_id NULL.  Shingles of very long texts are counted in parts.  Empty tables
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallyward.llm.common import map_batches, quoted, texts_of
from tallyward.session import materialize

SEED = 42
SHINGLE = 3
RADIUS = 3
#: Distinct fingerprints that a group may hold before it is spread again.
GROUP = 50_000
#: Fingerprints in a leaf, and children of an upper node.
LEAF = 32
FAN = 8
#: Pairs of leaves that are compared at a time.
_CHUNK = 2048

LINKS = "a long, b long"


# -- fingerprints -------------------------------------------------------------


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode().lower().split()  # lower() of bytes changes A-Z alone
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    spans = zip(starts[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(view[a:b], SEED) for a, b in spans), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, fp): the fingerprint's 64 bits as a long."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(text, shingle) for text in texts_of(batch.column(1))], np.uint64)
        columns = [pc.cast(batch.column(0), pa.int64()), pa.array(found.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp"])

    return map_batches(docs, [id_col, text_col], work, "doc_id long, fp long")


def as_text(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# -- the index over one group -------------------------------------------------


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Labels:
    """Components of the members of a group, as the least place in each."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            left, right = self.of[a], self.of[b]
            apart = left != right
            if not apart.any():
                return
            a, b, left, right = a[apart], b[apart], left[apart], right[apart]
            np.minimum.at(self.of, np.maximum(left, right), np.minimum(left, right))
            while True:
                jumped = self.of[self.of]
                if (jumped == self.of).all():
                    break
                self.of = jumped


def _grouped(values: np.ndarray, size: int, reduce: np.ufunc) -> np.ndarray:
    return reduce.reduceat(values, np.arange(0, len(values), size))


def link_group(codes: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect exactly what links of all pairs would connect.

    `codes` are distinct; a link leads from a member to the first of its component.
    """
    codes = codes[np.argsort(gray_rank(codes))]
    n = len(codes)
    labels = Labels(n)
    for step in range(1, min(LEAF, n)):  # neighbours in Gray order
        near = np.flatnonzero(np.bitwise_count(codes[:-step] ^ codes[step:]) <= radius)
        if len(near):
            labels.join(near, near + step)
    if n > LEAF:
        _link_nodes(codes, labels, radius)
    others = np.flatnonzero(labels.of != np.arange(n))
    return codes[others], codes[labels.of[others]]


def _link_nodes(codes: np.ndarray, labels: Labels, radius: int) -> None:
    # Each level: bits set in all members, and bits that all members share.
    levels = [(_grouped(codes, LEAF, np.bitwise_and), _grouped(codes, LEAF, np.bitwise_or))]
    while len(levels[-1][0]) > 1:
        both, any_ = levels[-1]
        levels.append((_grouped(both, FAN, np.bitwise_and), _grouped(any_, FAN, np.bitwise_or)))
    nodes = [(both, ~(both ^ any_)) for both, any_ in levels]

    a = b = np.zeros(1, np.int64)
    seen = np.zeros(1, np.uint64)  # bits whose differences are counted already
    differ = np.zeros(1, np.int64)
    for depth in range(len(nodes) - 1, -1, -1):
        pattern, shared = nodes[depth]
        fresh = shared[a] & shared[b] & ~seen
        differ = differ + np.bitwise_count((pattern[a] ^ pattern[b]) & fresh)
        keep = differ <= radius
        a, b, differ, seen = a[keep], b[keep], differ[keep], (seen | fresh)[keep]
        if depth:
            below = len(nodes[depth - 1][0])
            low = np.repeat(np.arange(FAN), FAN)
            high = np.tile(np.arange(FAN), FAN)
            left, right = (a[:, None] * FAN + low).ravel(), (b[:, None] * FAN + high).ravel()
            keep = (left <= right) & (right < below)
            a, b = left[keep], right[keep]
            seen, differ = np.repeat(seen, FAN * FAN)[keep], np.repeat(differ, FAN * FAN)[keep]
    members = np.arange(LEAF)
    order = np.argsort(b - a, kind="stable")  # near leaves first: they join most
    a, b = a[order], b[order]
    while len(a):
        low, high = _grouped(labels.of, LEAF, np.minimum), _grouped(labels.of, LEAF, np.maximum)
        one = (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])
        a, b = a[~one], b[~one]
        left = (a[:_CHUNK, None] * LEAF + members)[:, :, None]
        right = (b[:_CHUNK, None] * LEAF + members)[:, None, :]
        a, b = a[_CHUNK:], b[_CHUNK:]
        inside = (left < len(codes)) & (right < len(codes)) & (left < right)
        last = len(codes) - 1
        near = np.bitwise_count(codes[np.minimum(left, last)] ^ codes[np.minimum(right, last)]) <= radius
        pair, i, j = np.nonzero(near & inside)
        if len(pair):
            labels.join(left[pair, i, 0], right[pair, 0, j])


def _link_sorted(keys: np.ndarray, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """`link_group` for every run of equal keys."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    found = [link_group(codes[s : s + n], radius) for s, n in zip(starts, sizes, strict=True) if n > 2]
    two = starts[sizes == 2]
    two = two[np.bitwise_count(codes[two] ^ codes[two + 1]) <= radius]
    found.append((codes[two + 1], codes[two]))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


# -- groups in Spark ----------------------------------------------------------


def _blocks(free: int, count: int) -> list[int]:
    """Masks that deal the set bits of `free` out to `count` blocks."""
    bits = [bit for bit in range(64) if free >> bit & 1]
    edges = [len(bits) * at // count for at in range(count + 1)]
    return [sum(1 << bit for bit in bits[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


_ALL = (1 << 64) - 1


def _by_masks(rows: DataFrame) -> DataFrame:
    """(fp, mask, bits): a row for each of the masks in `masks`."""
    each = rows.select("fp", F.explode("masks").alias("mask"))
    return each.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"))


def _finer(large: DataFrame, radius: int) -> DataFrame:
    """(mask, bits, masks): how to spread groups of which `every` and `any` are the bits that
    all members have and that some have.

    Bits that all members share never differ, so only the others are dealt to blocks.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        masks = []
        for every, some in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            free = (every ^ some) & _ALL
            masks.append([_signed(~free & _ALL | part) for part in _blocks(free, radius + 1)])
        columns = [batch.column(0), batch.column(1), pa.array(masks, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["mask", "bits", "masks"])

    return map_batches(large, ["mask", "bits", "every", "any"], work, "mask long, bits long, masks array<long>")


def grouped_codes(nodes: DataFrame, radius: int, group: int) -> list[DataFrame]:
    """Parts (fp, mask, bits): two codes within `radius` have a mask and bits in common, and no
    more than `group` codes have the same ones."""
    first = F.array(*[F.lit(_signed(part)) for part in _blocks(_ALL, radius + 1)])
    rows = _by_masks(nodes.select("fp", first.alias("masks")))
    parts: list[DataFrame] = []
    while True:
        # A group's members differ in fewer bits than those of the group it was spread from;
        # if they differ in no more than `radius`, they are few.
        sizes = rows.groupBy("mask", "bits").agg(
            F.count(F.lit(1)).alias("n"), F.bit_and("fp").alias("every"), F.bit_or("fp").alias("any")
        )
        differ = F.bit_count(F.col("every").bitwiseXOR(F.col("any")))
        large = materialize(sizes.filter((F.col("n") > group) & (differ > radius)))
        if large.isEmpty():
            break
        # No more groups are large than there are rows by `group`.
        finer = F.broadcast(_finer(large, radius))
        small = rows.join(F.broadcast(large.select("mask", "bits")), ["mask", "bits"], "left_anti")
        parts.append(small.select("fp", "mask", "bits"))
        rows = _by_masks(rows.join(finer, ["mask", "bits"]).select("fp", "masks"))
    return [*parts, rows]


def links(nodes: DataFrame, radius: int = RADIUS, group: int = GROUP) -> DataFrame:
    """Links between the distinct fingerprints `fp` of `nodes` that connect all within `radius`."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys: np.ndarray = np.zeros((0,), [("mask", "<i8"), ("bits", "<i8")])
        held = np.zeros(0, np.uint64)
        for batch in batches:
            fresh = np.empty(batch.num_rows, held_keys.dtype)
            fresh["mask"], fresh["bits"] = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            keys = np.concatenate([held_keys, fresh])
            codes = np.concatenate([held, batch.column(0).to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            # The last group may go on in the next batch.
            before = np.flatnonzero(keys != keys[-1])
            done = before[-1] + 1 if len(before) else 0
            held_keys, held = keys[done:], codes[done:]
            if done:
                yield _batch(*_link_sorted(keys[:done], codes[:done], radius))
        if len(held):
            yield _batch(*_link_sorted(held_keys, held, radius))

    def _batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
        )

    parts = grouped_codes(nodes, radius, group)
    found = [
        part.repartition("mask", "bits").sortWithinPartitions("mask", "bits").mapInArrow(run, LINKS)
        for part in parts
    ]
    result = found[0]
    for each in found[1:]:
        result = result.unionByName(each)
    return result.distinct()


# -- components ---------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for each node with a link the least node that can be reached.

    Alternates the two star operations until the links no longer change; each round is
    checkpointed to the shared folder.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(edges.filter("a != b").distinct())
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        edges = materialize(small.distinct())
        state, before = _state(edges), state
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    mixed = F.xxhash64("a", "b")
    return tuple(
        edges.agg(
            F.count("*"), F.bit_xor(mixed), F.sum(F.shiftright(mixed, 32))
        ).first()
    )


def cluster(marked: DataFrame, radius: int = RADIUS, group: int = GROUP) -> DataFrame:
    """(fp, root, component_id) for the fingerprints in `marked` (doc_id, fp): a fingerprint of
    the component, and the component's least doc_id."""
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes, radius, group))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE, radius: int = RADIUS, group: int = GROUP,
) -> DataFrame:
    """One row per document: doc_id, its fingerprint and its component's least doc_id."""
    marked = materialize(fingerprints(docs, id_col, text_col, shingle))
    found = marked.join(cluster(marked, radius, group), "fp", "left")
    return found.select("doc_id", as_text(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE, radius: int = RADIUS, group: int = GROUP,
) -> DataFrame:
    """The rows of `docs`, all columns unchanged, one of each component.

    The least doc_id stays (NULL last), of rows that share it the one with the least
    fingerprint and hash of its text; of rows with one id and text, the one whose other
    columns have the least text form.  Columns may have any name and type.
    """
    # Two hashes of the text tell texts of one id apart, without fingerprints taken again.
    hashes = F.xxhash64(F.col(quoted(text_col))), F.xxhash64(F.lit(SEED), F.col(quoted(text_col)))
    keys = [F.col(quoted(id_col)).cast("long").alias("doc_id"), *(each.alias(f"h{n}") for n, each in enumerate(hashes))]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(text, shingle) for text in texts_of(batch.column(3))], np.uint64)
        columns = [*batch.columns[:3], pa.array(found.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "h0", "h1", "fp"])

    # The ids and fingerprints first; the texts move once, and only if they stay.
    texts = docs.select(*keys, F.col(quoted(text_col)).alias("text"))
    marked = materialize(map_batches(texts, texts.columns, work, "doc_id long, h0 long, h1 long, fp long"))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "fp", "h0", "h1")
    chosen = (
        marked.join(cluster(marked, radius, group), "fp")
        .groupBy("root")
        .agg(F.min(rank).alias("first"))
        .select(*(F.col(f"first.{name}").alias(f"of_{name}") for name in ("doc_id", "h0", "h1")))
    )
    columns = [F.col(quoted(name)) for name in docs.columns]
    others = F.struct(*(column for name, column in zip(docs.columns, columns, strict=True) if name != text_col))
    rows = docs.select(*keys, F.struct(*columns).alias("row"), F.to_json(others).alias("form"))
    same = F.col("doc_id").eqNullSafe(F.col("of_doc_id")) & (F.col("h0") == F.col("of_h0")) & (F.col("h1") == F.col("of_h1"))
    kept = rows.join(chosen, same, "left_semi").groupBy("doc_id", "h0", "h1").agg(F.min_by("row", "form").alias("row"))
    return kept.select("row.*")
