"""Jaccard join of documents on word shingles by parity sketches, and the connected components of its links.

Two documents link when 100 * |A & B| >= percent * |A | B| for their sets of distinct shingles. Then at most
d elements differ, and d follows from the sizes. A sketch has one bit per hashed element of the universe; each
element flips its bit, so the Hamming distance of two sketches is at most the number of differing elements.
Sketches of one size band are cut into d + 1 + slack blocks: at least 1 + slack blocks of a linked pair are
equal (pigeonhole), so documents are joined on equal blocks and then verified on their whole sets. A sketch is
sparse and never built: a block is stored as the XOR of one random word per set bit.

Skew. Equal sets become one class first. Blocks that are empty or shared by many classes ("weak") say little
and are skipped for a document that has at most `slack` of them, which loses no link, as one of the equal blocks
is not weak. Only documents mostly made of weak blocks, such as members of large groups of near copies, meet in
the large buckets. No large bucket emits its pairs: its members are compared with one leader, and if several
components are left in it, sketches and sets are compared chunk by chunk inside tasks of bounded memory, which give
only the links that join components.

Defined results: words are runs without ASCII white space, A-Z lower-cased. A document with fewer words than a
shingle has its whole sequence as its one shingle; a null or wordless text has no shingle and no link. Rows that
share a key are one document, linked to whatever one of its texts links to, and have one component. A row without a
key has no component (null) and joins no others.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm.blocks import cuts, find, grouped, mix, runs, span_hashes, tidy, with_columns
from sightline.session import discard, materialize

WORDS, PERCENT = 5, 80  # shingle length and similarity, unless a caller says otherwise
HOT = 32  # members above which a block is weak
SMALL = 16  # members up to which a bucket's remaining pairs are listed
CHUNK, OVERHEAD = 500_000, 256  # weight of a chunk of a family: its shingles, and what a document adds
BROADCAST_ROWS = 2_000_000  # ids (16 MB) up to which candidates are broadcast; beyond that they are shuffled
BITS = np.uint64((1 << 20) - 1)  # bits of a block, less one
_LACK = np.uint64(0x5851F42D4C957F2D)
_TAG = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the text of each."""
    hashes, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    parts = [(i, piece) for i, text in enumerate(texts) for piece in cuts(text)]
    for a, b in grouped([p for _, p in parts]):
        raw = [p.encode("utf-8", "replace").lower() for _, p in parts[a:b]]  # of bytes: A-Z only
        units = np.frombuffer(b"\n".join(raw), np.uint8)
        starts, ends = runs(~_SPACE[units])
        firsts = np.cumsum([0] + [len(x) + 1 for x in raw[:-1]])
        hashes.append(span_hashes(units, starts, ends))
        owner.append(np.array([i for i, _ in parts[a:b]])[np.searchsorted(firsts, starts, "right") - 1])
    return np.concatenate(hashes), np.concatenate(owner)


def shingle_sets(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text, sorted by text and value, and the size of each set."""
    hashes, owner = word_hashes(texts)
    n = np.bincount(owner, minlength=len(texts))
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(texts)), count)
    at = (np.cumsum(n) - n)[doc] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    padded = np.append(hashes, np.zeros(words, np.uint64))
    value = np.zeros(len(doc), np.uint64)
    for j in range(words):
        value = mix(value * np.uint64(0xD1342543DE82EF95) + np.where(n[doc] > j, padded[at + j], _LACK))
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(doc[new], minlength=len(texts))


@functools.cache
def bands(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower sizes of the bands; the most elements in which a pair differs whose smaller set is in the band; slack."""
    lows = [1]
    while lows[-1] < 1 << 40:
        lows.append(max(lows[-1] + 1, lows[-1] * 17 // 10))
    low = np.array(lows, np.int64)
    a = low[1:] - 1
    b = 100 * a // percent
    d = (a + b) * (100 - percent) // (100 + percent)
    return low, d, 1 + d // 8


def signatures(values: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block signatures of all sets, a tag of each (band and slack), and how many each set has.

    A set is signed in the band of its size, and in the band below if a smaller set there can link to it.
    """
    low, differ, slack = bands(percent)
    own = np.searchsorted(low, sizes, "right") - 1
    below = (own > 0) & (percent * sizes <= 100 * (low[np.maximum(own, 0)] - 1))
    docs = np.arange(len(sizes))
    slot_doc = np.concatenate([docs[sizes > 0], docs[below & (sizes > 0)]])
    slot_band = np.concatenate([own[sizes > 0], own[below & (sizes > 0)] - 1])
    keep = differ[slot_band] > 0  # otherwise only equal sets link, and those are one class
    slot_doc, slot_band = slot_doc[keep], slot_band[keep]
    blocks = differ[slot_band] + 1 + slack[slot_band]
    first = np.cumsum(sizes) - sizes
    n = sizes[slot_doc]
    slot = np.repeat(np.arange(len(n)), n)
    h = values[np.repeat(first[slot_doc] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    base = np.cumsum(blocks) - blocks
    key = base[slot] + ((h >> np.uint64(32)) % blocks[slot].astype(np.uint64)).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key, word = key[order], mix((h[order] & BITS) + np.uint64(1))
    sketch = np.zeros(blocks.sum(), np.uint64)
    if len(key):
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sketch[key[at]] = np.bitwise_xor.reduceat(word, at)
    of = np.repeat(np.arange(len(blocks)), blocks)
    number = np.arange(blocks.sum()) - base[of]
    empty = np.bincount(of, weights=sketch == 0, minlength=len(blocks)).astype(np.int64)
    most = slack[slot_band]
    skips = empty <= most  # few empty blocks: they count as weak and need no signature
    room = np.where(skips, most - empty, most)
    sent = (sketch != 0) | ~skips[of]
    place = slot_band[of].astype(np.uint64) * np.uint64(1 << 40) + number.astype(np.uint64)
    sig = mix(sketch ^ mix(place + np.uint64(1)))[sent]
    tag = (slot_band * _TAG + room)[of][sent]
    doc = slot_doc[of][sent]
    by = np.argsort(doc, kind="stable")
    return sig[by].view(np.int64), tag[by].astype(np.int32), np.bincount(doc, minlength=len(sizes))


def _digests(values: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Two halves of every set's digest."""
    ends, totals = np.cumsum(sizes), []
    for salt in (0, 0x94D049BB133111EB):
        total = np.append(np.uint64(0), np.cumsum(mix(values ^ np.uint64(salt))))
        totals.append((total[ends] - total[ends - sizes]).view(np.int64))
    return totals


def signed(docs: DataFrame, text: str, key: str, words: int, percent: int) -> DataFrame:
    """Per row: node (the key), n (set size), two halves of the set's digest, signatures, their tags and a sketch."""

    def apply(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in grouped(texts):
                values, sizes = shingle_sets(texts[a:b], words)
                ends = np.cumsum(sizes)
                one, two = _digests(values, sizes)
                sig, tag, count = signatures(values, sizes, percent)
                offsets = pa.array(np.append(0, np.cumsum(count)).astype(np.int32))
                sketch = [_sketch(values[j - n : j]).tobytes() for j, n in zip(ends, sizes, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(sizes.astype(np.int64)), pa.array(one), pa.array(two), pa.ListArray.from_arrays(offsets, pa.array(sig)), pa.ListArray.from_arrays(offsets, pa.array(tag)), pa.array(sketch)],
                    names=["node", "n", "d1", "d2", "sigs", "tags", "sketch"],
                )

    rows = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("t"))
    return rows.mapInArrow(tidy(apply), "node long, n long, d1 long, d2 long, sigs array<long>, tags array<int>, sketch binary")


def _sets(docs: DataFrame, nodes: DataFrame, text: str, key: str, words: int) -> DataFrame:
    """The shingle sets of the given nodes, as sorted 64-bit values."""
    held = materialize(nodes.select(F.col("node").alias("_node")), "asked")
    held = F.broadcast(held) if held.count() <= BROADCAST_ROWS else held
    rows = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("t")).join(held, F.col("node") == F.col("_node"), "left_semi")

    def make():
        def work(texts):
            out = []
            for a, b in grouped(texts := [t or "" for t in texts]):
                values, sizes = shingle_sets(texts[a:b], words)
                ends = np.cumsum(sizes)
                out += [values[j - n : j].tobytes() for j, n in zip(ends, sizes, strict=True)]
            return [out]

        return work

    return materialize(with_columns(rows, "t", [T.StructField("items", T.BinaryType())], make).select("node", "items"), "sets")


_SIDE = lambda df, key, *names: df.select(F.col("node").alias(key), *[F.col(c).alias(f"{c}_{key}") for c in names])


def _allowed(pairs: DataFrame, light: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sketches allow a link."""

    def allowed(batches):
        for batch in batches:
            sizes = [batch.column(i).to_numpy() for i in (2, 3)]
            most = (sizes[0] + sizes[1]) * (100 - percent) // (100 + percent)
            fits = percent * np.maximum(*sizes) <= 100 * np.minimum(*sizes)
            keep = np.zeros(len(fits), bool)
            for i in np.flatnonzero(fits):
                a, b = (np.frombuffer(batch.column(c)[int(i)].as_buffer(), np.uint64) for c in (4, 5))
                keep[i] = _distance(a, b) <= most[i]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep))

    both = pairs.join(_SIDE(light, "u", "n", "sketch"), "u").join(_SIDE(light, "v", "n", "sketch"), "v")
    return both.select("u", "v", "n_u", "n_v", "sketch_u", "sketch_v").mapInArrow(tidy(allowed), "u long, v long")


def _bucket_pairs(few: DataFrame, light: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of small buckets (sig, node, mark) with different marks whose sketches allow a link.

    Near copies share many blocks, so equal lists of members are taken once. A list's sketches are compared in one
    task, which gives only the pairs that pass; no other pair becomes a row.
    """
    lists = few.groupBy("sig").agg(F.array_sort(F.collect_list("node")).alias("nodes")).select("nodes").distinct()
    lists = materialize(lists.withColumn("list", F.monotonically_increasing_id()), "lists")
    marks = few.select("node", "mark").distinct()
    members = lists.select("list", F.explode("nodes").alias("node")).join(marks, "node").join(light.select("node", "n", "sketch"), "node")
    members = members.groupBy("list").agg(F.collect_list(F.struct("node", "mark", "n", "sketch")).alias("members"))

    def compare(batches):
        for column in (batch.column(0).slice(first, 512) for batch in batches for first in range(0, len(batch), 512)):
            flat, ends = column.flatten(), np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))
            node, mark, n = (flat.field(i).to_numpy() for i in range(3))
            sketches = [np.frombuffer(x.as_buffer(), np.uint64) for x in flat.field(3)]
            out = [(np.zeros(0, np.int64),) * 2]
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                own = slice(a, b)
                for i, near in _near(sketches[own], n[own], mark[own], None, percent):
                    out.append((np.minimum(node[a + i], node[a + near]), np.maximum(node[a + i], node[a + near])))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["u", "v"])

    return members.select("members").mapInArrow(tidy(compare), "u long, v long").distinct()


def _verified(near: DataFrame, sets_of, percent: int) -> DataFrame:
    """Of pairs whose sketches allow a link those whose whole sets link."""

    def linked(batches):
        for batch in batches:
            keep = [_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    near = materialize(near, "allowed")
    sets = sets_of(near.select(F.col("u").alias("node")).union(near.select("v")).distinct())
    return near.join(_SIDE(sets, "u", "items"), "u").join(_SIDE(sets, "v", "items"), "v").select("u", "v", "items_u", "items_v").mapInArrow(tidy(linked), "u long, v long")


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets in which several components are left, with label and bucket size."""
    by_sig = Window.partitionBy("sig")
    state = members.join(labels, "node", "left").select("sig", "node", F.coalesce("label", "node").alias("label"))
    state = state.withColumns({"lo": F.min("label").over(by_sig), "hi": F.max("label").over(by_sig), "m": F.count("*").over(by_sig)})
    return materialize(state.where("lo < hi").drop("lo", "hi"), "unsettled")


def _couples(members: DataFrame, more: DataFrame, percent: int) -> DataFrame:
    """The members (family, node, label, n) and their columns in `more`, sent to every couple of chunks they belong to.

    A family's members are cut by size into chunks of bounded weight; couples whose sizes cannot link are left out.
    """
    if "chunk" not in members.columns:
        order = Window.partitionBy("family").orderBy("n", "node")
        members = members.withColumn("chunk", F.floor(F.sum(F.col("n") + OVERHEAD).over(order) / CHUNK))
    placed = materialize(members, "placed")
    chunks = placed.groupBy("family", "chunk").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    other = chunks.select("family", F.col("chunk").alias("second"), F.col("low").alias("low2"))
    couples = chunks.join(other, "family").where((F.col("chunk") <= F.col("second")) & (F.col("low2") * percent <= F.col("high") * 100))
    couples = materialize(couples.select("family", F.col("chunk").alias("first"), "second"), "couples")
    whole = placed.join(more.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node")).drop("_node")
    left = whole.join(couples.withColumn("chunk", F.col("first")), ["family", "chunk"]).withColumn("side", F.lit(0))
    right = whole.join(couples.where("first < second").withColumn("chunk", F.col("second")), ["family", "chunk"]).withColumn("side", F.lit(1))
    return left.unionByName(right)


def _settled(state: DataFrame, light: DataFrame, sets_of, percent: int) -> DataFrame:
    """Links between the components of large buckets.

    Buckets that share members form a family, whose members are compared chunk by chunk inside tasks: first the sketches,
    which gives the documents that may link to another component at all, then the sets of those. A task gives at most
    one link for each of its documents, as it skips pairs that its links have joined already.
    """
    star = state.select(F.col("node").alias("u"), F.min("node").over(Window.partitionBy("sig")).alias("v")).distinct()
    families = components(star).withColumnRenamed("label", "family")
    known = state.select("node", "label").distinct()
    members = families.join(known, "node").join(light.select("node", "n"), "node")

    def sides(table: pa.Table) -> tuple[pa.Table, int | None]:
        table = table.sort_by([("side", "ascending"), ("n", "ascending"), ("node", "ascending")]).combine_chunks()
        second = int((table.column("side").to_numpy() == 1).sum())
        return table, len(table) - second if second else None

    def arrays(table: pa.Table, name: str) -> list[np.ndarray]:
        column = table.column(name).combine_chunks()
        return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]

    def may_link(table: pa.Table) -> pa.Table:
        table, split = sides(table)
        marked = np.zeros(len(table), bool)
        for i, near in _near(arrays(table, "sketch"), table.column("n").to_numpy(), table.column("label").to_numpy(), split, percent):
            marked[near] = True
            marked[i] |= len(near) > 0
        return pa.table({"node": table.column("node").filter(pa.array(marked))})

    def link(table: pa.Table) -> pa.Table:
        table, split = sides(table)
        nodes = table.column("node").to_numpy()
        edges = _forest(arrays(table, "items"), table.column("label").to_numpy(), split, percent)
        return pa.table({"u": pa.array([int(nodes[i]) for i, _ in edges], pa.int64()), "v": pa.array([int(nodes[j]) for _, j in edges], pa.int64())})

    groups = _couples(members, light.select("node", "sketch"), percent).groupBy("family", "first", "second")
    asked = materialize(groups.applyInArrow(may_link, "node long").distinct(), "may-link")
    rest = members.join(asked, "node", "left_semi")
    return _couples(rest, sets_of(asked), percent).groupBy("family", "first", "second").applyInArrow(link, "u long, v long")


def _sketch(own: np.ndarray, least: int = 256, share: int = 2) -> np.ndarray:
    """The parity sketch of a set as 64-bit words; its size is a power of two, at least `share` bits per element."""
    bits = least
    while bits < share * len(own):
        bits *= 2
    parity = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.uint64)


def _folded(a: np.ndarray, words: int) -> np.ndarray:
    """Sketches (the last axis) at a smaller size: what fewer bits would have given."""
    while a.shape[-1] > words:
        a = a[..., : a.shape[-1] // 2] ^ a[..., a.shape[-1] // 2 :]
    return a


def _distance(a: np.ndarray, b: np.ndarray) -> int:
    """Hamming distance of two sketches at the smaller one's size."""
    words = min(len(a), len(b))
    return int(np.bitwise_count(_folded(a, words) ^ _folded(b, words)).sum(dtype=np.int64))


def _near(sketches: list[np.ndarray], n: np.ndarray, component: np.ndarray, split: int | None, percent: int):
    """Per set the later ones of other components that its sketch may link to: after `split`, or among all.

    Sets that link differ in size by a quarter at most, so their sketches by one doubling.
    """
    width = np.array([len(s) for s in sketches])
    second = np.arange(split or 0, len(n))
    at = {int(w): second[width[second] == w] for w in np.unique(width[second])}
    wide = {w: np.array([sketches[j] for j in js]) for w, js in at.items()}
    narrow = {w: _folded(m, w // 2) for w, m in wide.items() if w > 1}
    for i in range(len(n) if split is None else split):
        found, w = [np.zeros(0, np.int64)], len(sketches[i])
        for v in (w // 2, w, 2 * w):
            if v in at:
                differ = np.bitwise_count((narrow[v] if v > w else wide[v]) ^ _folded(sketches[i], v)).sum(axis=1, dtype=np.int64)
                js = at[v]
                found.append(js[(differ * (100 + percent) <= (n[js] + n[i]) * (100 - percent)) & (component[js] != component[i]) & (js > i)])
        yield i, np.concatenate(found)


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    shared = int((find(large, small) >= 0).sum())
    return shared > 0 and 100 * shared >= percent * (len(a) + len(b) - shared)


def _forest(sets: list[np.ndarray], labels: np.ndarray, split: int | None, percent: int) -> list[tuple[int, int]]:
    """Links that join all components which any link joins: between the sets before and after `split`, or among all."""
    component, out = np.unique(labels, return_inverse=True)[1], []
    for i, near in _near([_sketch(x) for x in sets], np.array([len(x) for x in sets]), component, split, percent):
        for j in near:
            if component[j] != component[i] and _linked(sets[i], sets[j], percent):
                component[component == component[j]] = component[i]
                out.append((i, int(j)))
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of the edges reaches.

    Every node joins the smallest of its neighbours, and the edges are lifted to what their ends joined; those within
    one and repeated ones go, so only the first round sees all edges.
    """
    edges = materialize(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u < v").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("v", "u")).toDF("node", "far")
        near = both.groupBy("node").agg(F.least(F.min("far"), F.first("node")).alias("low"))
        joined = materialize(near, "joined")
        after = joined.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        joined = materialize(joined.join(after, "low").select("node", F.col("lower").alias("low")), "joined")
        if labels is None:
            labels = joined.toDF("node", "label")
        else:
            moved = labels.join(joined.toDF("label", "low"), "label", "left")
            labels = materialize(moved.select("node", F.coalesce("low", "label").alias("label")), "labels")
        lifted = edges.join(joined.toDF("u", "low_u"), "u").join(joined.toDF("v", "low_v"), "v")
        edges = materialize(lifted.select(F.least("low_u", "low_v").alias("u"), F.greatest("low_u", "low_v").alias("v")).where("u < v").distinct(), "edges")
    return edges.toDF("node", "label") if labels is None else labels


def _lifted(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links with the labels of their ends: l_u and l_v; a node without a label is its own."""
    name = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"_{c}"))
    named = links.join(name("u"), "u", "left").join(name("v"), "v", "left")
    return named.select("u", "v", F.coalesce("_u", "u").alias("l_u"), F.coalesce("_v", "v").alias("l_v"))


def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links: components of the labels that those join."""
    over = components(_lifted(links, labels).select(F.col("l_u").alias("u"), F.col("l_v").alias("v")))
    moved = labels.join(over.toDF("label", "low"), "label", "left").select("node", F.coalesce("low", "label").alias("label"))
    return materialize(moved.union(over.join(labels.select("node"), "node", "left_anti")), "labels")


def linked(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of the documents: its key, `n_shingles` and `component_id`, the smallest key reachable by links."""
    whole = materialize(signed(docs, text, key, words, percent), "signed")
    rows = materialize(whole.select("node", "n", "d1", "d2"), "digests")
    classes = whole.where("n > 0 and node is not null").groupBy("n", "d1", "d2")
    nodes = classes.agg(F.min("node").alias("node"), F.first("sigs").alias("sigs"), F.first("tags").alias("tags"))
    pieces = nodes.select("node", F.explode(F.arrays_zip("sigs", "tags")).alias("x")).select("node", F.col("x.sigs").alias("sig"), F.col("x.tags").alias("tag"))
    by_sig = Window.partitionBy("sig")
    counted = pieces.withColumns({"m": F.count("*").over(by_sig).cast("int"), "leader": F.min("node").over(by_sig)})
    shared = materialize(counted.where("m > 1"), "buckets")
    weak = shared.where(F.col("m") > HOT)
    risky = weak.groupBy("node", "tag").agg(F.count("*").alias("h")).where(F.col("h") > F.col("tag") % _TAG).select("node", "tag")
    again = weak.join(risky, ["node", "tag"], "left_semi").select("sig", "node")
    again = again.withColumns({"m": F.count("*").over(by_sig).cast("int"), "leader": F.min("node").over(by_sig)}).where("m > 1")
    buckets = materialize(shared.where(F.col("m") <= HOT).select("sig", "node", "m", "leader").union(again), "members")
    first = materialize(buckets.where("node <> leader").select(F.col("node").alias("u"), F.col("leader").alias("v")).distinct(), "pairs")
    ends = first.select(F.col("u").alias("node")).union(first.select("v")).distinct()
    light = materialize(whole.where("n > 0").select("node", "n", "sketch").join(ends, "node", "left_semi"), "sketches")
    discard(whole, shared)
    sets_of = lambda asked: _sets(docs, asked, text, key, words)

    # each node meets its smallest leader first, and the others only while they lie in another component
    least = materialize(first.groupBy("u").agg(F.min("v").alias("v")), "least")
    labels = components(_verified(_allowed(least, light, percent), sets_of, percent))
    others = first.join(least.toDF("u", "least"), "u").where("v <> least").select("u", "v")
    others = materialize(_lifted(others, labels).where("l_u <> l_v").select("u", "v"), "others")
    labels = extended(labels, _verified(_allowed(others, light, percent), sets_of, percent))
    # a bucket is settled if its leader has met everyone; else several components may be left in it
    apart = _lifted(first, labels).where("l_u <> l_v")
    open_ = buckets.where("m > 2").join(apart.select(F.col("u").alias("node"), F.col("v").alias("leader")), ["node", "leader"], "left_semi").select("sig").distinct()
    state = _unsettled(buckets.where("m > 2").join(open_, "sig", "left_semi").select("sig", "node"), labels)
    few = state.where(F.col("m") <= SMALL).select("sig", "node", F.col("label").alias("mark"))
    labels = extended(labels, _verified(_bucket_pairs(few, light, percent), sets_of, percent))
    many = _unsettled(state.where(F.col("m") > SMALL).select("sig", "node"), labels)
    if not many.isEmpty():
        labels = extended(labels, materialize(_settled(many, light, sets_of, percent), "settled"))

    same = rows.where("n > 0 and node is not null").groupBy("n", "d1", "d2").agg(F.min("node").alias("rep"))
    keyed = rows.where("node is not null").join(same, ["n", "d1", "d2"], "left").select("node", "n", F.coalesce("rep", "node").alias("rep"))
    keyed = materialize(keyed, "classes")
    # rows that share a key are one document, so their classes belong together
    several = keyed.groupBy("node").agg(F.min("rep").alias("v"), F.max("rep").alias("most")).where("v < most").select("node", "v")
    several = materialize(keyed.join(several, "node").where("rep > v").select(F.col("rep").alias("u"), "v").distinct(), "several")
    if not several.isEmpty():
        labels = extended(labels, several)
    joined = keyed.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    alone = rows.where("node is null").select(F.col("node").alias(key), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return joined.select(F.col("node").alias(key), F.col("n").alias("n_shingles"), F.coalesce("label", "rep").alias("component_id")).union(alone)


def _class_sets(docs: DataFrame, classes: DataFrame, asked: DataFrame, text: str, key: str, words: int) -> DataFrame:
    """The shingle sets of the given classes, one of each, from the rows that have a class's key."""
    wanted = materialize(classes.select("node", "key", "n", "d1", "d2").join(asked.distinct(), "node", "left_semi"), "wanted")
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("t")).join(wanted.select("key").distinct(), "key", "left_semi")

    def make():
        def work(texts):
            items, halves = [], [[], [], []]
            for a, b in grouped(texts := [t or "" for t in texts]):
                values, sizes = shingle_sets(texts[a:b], words)
                items += [values[j - n : j].tobytes() for j, n in zip(np.cumsum(sizes), sizes, strict=True)]
                for column, more in zip(halves, (sizes, *_digests(values, sizes)), strict=True):
                    column += more.tolist()
            return [items, *halves]

        return work

    fields = [T.StructField("items", T.BinaryType()), *[T.StructField(c, T.LongType()) for c in ("n", "d1", "d2")]]
    found = with_columns(rows, "t", fields, make).select("key", "items", "n", "d1", "d2")
    return materialize(found.join(wanted, ["key", "n", "d1", "d2"]).dropDuplicates(["node"]).select("node", "items"), "sets")


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of the left shares with each of the right.

    Elements that many sets hold are counted by matrix products of bounded width, the others pair by pair.
    """
    split, across = sum(map(len, left)), len(right)
    number = np.unique(np.concatenate([*left, *right]), return_inverse=True)[1]
    one, two = number[:split], number[split:]
    row, other = (np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (left, right))
    kinds = int(number.max(initial=-1)) + 1
    in_one, in_two = np.bincount(one, minlength=kinds), np.bincount(two, minlength=kinds)
    out = np.zeros((len(left), across), np.int64)
    often = in_one * in_two * 200 > len(left) * across
    place = np.where(often, np.cumsum(often) - 1, -1)
    for first in range(0, int(often.sum()), 4096):
        dense = []
        for n, which, count in ((one, row, len(left)), (two, other, across)):
            at = place[n] - first
            keep = (at >= 0) & (at < 4096)
            matrix = np.zeros((count, 4096), np.float32)
            matrix[which[keep], at[keep]] = 1
            dense.append(matrix)
        out += (dense[0] @ dense[1].T).astype(np.int64)
    by = np.argsort(two, kind="stable")
    starts = np.cumsum(in_two) - in_two
    rare = np.flatnonzero(~often[one] & (in_two[one] > 0))
    total = np.cumsum(in_two[one[rare]])
    for first in range(0, int(total[-1]) if len(total) else 0, 1 << 22):
        part = rare[np.searchsorted(total, first, "right") : np.searchsorted(total, first + (1 << 22), "right")]
        count = in_two[one[part]]
        at = np.repeat(starts[one[part]] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        np.add.at(out.reshape(-1), np.repeat(row[part], count) * across + other[by[at]], 1)
    return out


def _tally(table: pa.Table, percent: int) -> pa.Table:
    """Per document of a couple of chunks the copies of those it links to: in its own chunk, or in the other one."""
    table = table.combine_chunks()
    side, copies, nodes = (table.column(c).to_numpy() for c in ("side", "copies", "node"))
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("items").combine_chunks()]
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = table.column("first")[0].as_py() == table.column("second")[0].as_py()
    b = a if alone else b
    size = np.array([len(x) for x in sets], np.int64)
    links = np.zeros((len(a), len(b)), bool)
    if links.size:
        shared = _shared([sets[i] for i in a], [sets[i] for i in b])
        links = (shared > 0) & (100 * shared >= percent * (size[a][:, None] + size[b] - shared))
    if alone:
        np.fill_diagonal(links, False)
        return pa.table({"node": nodes[a], "k": links @ copies[a]})
    return pa.table({"node": np.append(nodes[a], nodes[b]), "k": np.append(links @ copies[b], copies[a] @ links)})


def _placed(members: DataFrame) -> DataFrame:
    """The members (family, node, n) with the chunk of each, by its size and, within one size, by its hash.

    Only the sums of each size of a family are ordered, so no task holds the members of a family.
    """
    cells = materialize(members.groupBy("family", "n").agg(F.sum(F.col("n") + OVERHEAD).alias("w")), "cells")
    order = Window.partitionBy("family").orderBy("n")
    cells = materialize(cells.withColumn("before", F.sum("w").over(order) - F.col("w")), "cells")
    share = F.pmod(F.xxhash64("node"), F.lit(1 << 20)) / (1 << 20)
    return members.join(cells, ["family", "n"]).withColumn("chunk", F.floor((F.col("before") + share * F.col("w")) / CHUNK)).drop("before", "w")


def link_counts(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of the documents: its key, `n_shingles`, `class_id`, the smallest key of an equal set, and `n_links`.

    `n_links` counts the other rows with a key whose sets link to the row's own: every candidate pair of classes that
    shares a kept block is verified, and a class counts for its rows. Pairs of small buckets are listed; large ones
    form families, within which all sets are compared chunk by chunk in tasks that give sums only. A row without a
    key has no class and no links, one without words is alone.
    """
    whole = materialize(signed(docs, text, key, words, percent), "signed")
    rows = materialize(whole.select("node", "n", "d1", "d2"), "digests")
    same = whole.where("n > 0 and node is not null").groupBy("n", "d1", "d2")
    firsts = [F.first(c).alias(c) for c in ("sigs", "tags", "sketch")]
    # keys may repeat with other texts, so a class has a number of its own
    classes = same.agg(F.min("node").alias("key"), F.count("*").alias("copies"), *firsts).withColumn("node", F.monotonically_increasing_id())
    classes = materialize(classes, "classes")
    discard(whole)
    pieces = classes.select("node", F.explode(F.arrays_zip("sigs", "tags")).alias("x")).select("node", F.col("x.sigs").alias("sig"), F.col("x.tags").alias("tag"))
    sizes = lambda df: df.groupBy("sig").agg(F.count("*").cast("int").alias("m")).where("m > 1")
    shared = materialize(pieces.join(materialize(sizes(pieces), "sizes"), "sig"), "buckets")
    weak = shared.where(F.col("m") > HOT)
    risky = weak.groupBy("node", "tag").agg(F.count("*").alias("h")).where(F.col("h") > F.col("tag") % _TAG).select("node", "tag")
    again = materialize(weak.join(risky, ["node", "tag"], "left_semi").select("sig", "node"), "again")
    members = shared.where(F.col("m") <= HOT).select("sig", "node", "m").union(again.join(sizes(again), "sig").select("sig", "node", "m"))
    members = materialize(members, "members")
    discard(shared, again)

    large = members.where(F.col("m") > SMALL).select("sig", "node")
    star = large.join(large.groupBy("sig").agg(F.min("node").alias("v")), "sig").select(F.col("node").alias("u"), "v").distinct()
    families = components(star).withColumnRenamed("label", "family")
    sets_of = lambda asked: _class_sets(docs, classes, asked, text, key, words)
    mark = F.coalesce("family", -1 - F.col("node")).alias("mark")  # a node without a family may link to any other
    few = materialize(members.where(F.col("m") <= SMALL).select("sig", "node").join(families, "node", "left").select("sig", "node", mark), "few")
    light = materialize(classes.select("node", "n", "sketch").join(few.select("node").distinct(), "node", "left_semi"), "sketches")
    found = materialize(_verified(_bucket_pairs(few, light, percent), sets_of, percent), "found")
    copies = classes.select(F.col("node").alias("v"), F.col("copies").alias("k"))
    counts = found.union(found.select("v", "u")).toDF("u", "v").join(copies, "v").select(F.col("u").alias("node"), "k")
    if not families.isEmpty():
        placed = _placed(families.join(classes.select("node", "n", "copies"), "node"))
        groups = _couples(placed, sets_of(families.select("node")), percent).groupBy("family", "first", "second")
        counts = counts.union(groups.applyInArrow(lambda table: _tally(table, percent), "node long, k long"))
    counts = materialize(counts.groupBy("node").agg(F.sum("k").alias("k")), "counts")
    result = classes.join(counts, "node", "left").select("n", "d1", "d2", F.col("key").alias("class"), (F.col("copies") - 1 + F.coalesce("k", F.lit(0))).alias("links"))
    joined = rows.join(materialize(result, "links"), ["n", "d1", "d2"], "left")
    keyed = lambda column: F.when(F.col("node").isNotNull(), column)
    return joined.select(F.col("node").alias(key), F.col("n").alias("n_shingles"), keyed(F.coalesce("class", "node")).alias("class_id"), keyed(F.coalesce("links", F.lit(0))).alias("n_links"))


def first_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents without near copies: of each component one row with the smallest key stays.

    A row without a key stays if no row with a key has the same set of shingles; of equal ones among such rows one
    stays, and those without words all do.
    """
    found = materialize(linked(docs, text, key, words, percent).where(F.col(key).isNotNull()), "components")
    heads = found.where(F.col(key) == F.col("component_id")).groupBy(F.col(key).alias("_first_key")).agg(F.count("*").alias("_first_rows"))
    heads = materialize(heads, "kept")
    single, repeated = heads.where("_first_rows = 1"), heads.where("_first_rows > 1")
    kept = docs.join(single, F.col(key) == F.col("_first_key"), "left_semi")
    again = docs.join(repeated, F.col(key) == F.col("_first_key"), "left_semi").dropDuplicates([key])
    nameless = docs.where(F.col(key).isNull())
    if nameless.isEmpty():
        return kept.unionByName(again)
    whole = F.struct(*[F.col(c) for c in docs.columns])
    rows = nameless.select(F.col(text).alias("t"), whole.alias("row"))
    halves = ["n", "d1", "d2"]

    def make():
        def work(texts):
            values, sizes = shingle_sets([t or "" for t in texts], words)
            return [sizes, *_digests(values, sizes)]

        return work

    marked = with_columns(rows, "t", [T.StructField(c, T.LongType()) for c in halves], make)
    classes = signed(docs.where(F.col(key).isNotNull()), text, key, words, percent).where("n > 0").select(*halves).distinct()
    new = marked.where("n > 0").join(classes, halves, "left_anti").dropDuplicates(halves).select("row.*")
    return kept.unionByName(again).unionByName(new).unionByName(marked.where("n = 0").select("row.*"))
