"""Near duplicates by MinHash bands, odd sketches and exact confirmation.

A text's set holds its distinct 5-word shingles (ASCII lower-cased; fewer words are one shingle).  Texts whose sets have a
Jaccard similarity of at least ``percent`` in a hundred link, and a component is what links reach.

*Candidates* are texts that agree on one of ``BANDS`` bands of ``ROWS`` MinHash samples each; at the threshold a pair misses all of them
with probability 2e-9.  *Odd sketches* (Mitzenmacher, Pagh, Pham 2014) verify them: each of the samples flips one bit of a bitmap,
so the exclusive-or of two bitmaps is the bitmap of the samples they differ in, and its population count tells how many those
are, most precisely where they are few.  A pair goes on when its count is no higher than one that a pair at the threshold exceeds
with probability 1e-9, and the sizes of its sets allow the similarity.  What passes is *confirmed* on the full sets of hashes.

Texts with equal sets are one node.  A band's bucket may hold a third of all nodes, so no bucket is ever compared whole by one
task, nor are its pairs sent on.  A bucket is cut by hash into blocks, by the number of its nodes and the size of their sets:

1. In each block, every node proposes the ``NEAREST`` nodes by their sketches (small buckets all pairs of a block).  These pairs meet the full
   sets, and confirmed links are contracted to components.
2. Buckets of several blocks, or not small, that still hold more than one component go on.  Every pair of different components has an end outside the bucket's largest
   one; those ends, few where copies are many, meet each block of the bucket.  There sets travel with their nodes: pairs that pass the
   sketches are confirmed where they are, once a pair, and a task sends on only links that span its components.

So every pair of a bucket is either tested or joined already by other links, and no link between components is lost.  Rows
grow with the nodes and, in the second step, with the nodes outside the largest component times the blocks; no row is a pair.

Shingles are compared by 64-bit hashes: within one pair two of some thousand would have to collide for a wrong
decision (probability below 1e-12).  Equal sets are told by 128 bits.

Defined cases: null, empty and blank texts have no shingle and link with nothing; rows with the same id are rows of their own;
a null id is never a component's id, a component without any id has a null one, and its rows are kept; an empty table gives an
empty result; long texts are sketched in blocks of shingles.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.llm.common import components, located, slices, spanning, utf8
from regloom.session import materialise

SHINGLE = 5
PERCENT = 85
ROWS, BANDS = 6, 42
SAMPLES = ROWS * BANDS
SKETCH = 1024  # bits
MISS = 1e-9
BLOCK = 512  # nodes in a block, about
BLOCK_BYTES = 4 << 20  # of sets in a block, about
FIRST = 16
NEAREST = 2
SPREAD = 8  # parts a frequent set's rows are dealt into when they meet their component
PART = 128  # shingles sampled at a time: their products stay in the cache
KNOWN = 1 << 18

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_draw = np.random.Generator(np.random.PCG64(12))
_XOR = _draw.integers(0, 2**32, SAMPLES, np.uint32)
_MULTIPLY = _draw.integers(0, 2**32, SAMPLES, np.uint32) | np.uint32(1)
_STEP = _draw.integers(0, 2**64, SHINGLE, np.uint64) | np.uint64(1)
_SALT = _draw.integers(0, 2**64, SAMPLES, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word to 64-bit hash, remembered; forgets all when full, which changes no hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_set(text: bytes, known: WordHashes) -> np.ndarray:
    """The distinct shingles' hashes, sorted."""
    words = text.lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    k = min(SHINGLE, len(words))
    n = len(words) - k + 1
    found = np.full(n, k, np.uint64)  # a shorter shingle equals no longer one
    for i in range(k):
        found = mixed(found + each[i : n + i] * _STEP[i])
    return np.unique(found)


def samples(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a set.  They have 32 bits; two minima that agree by chance only
    add a candidate."""
    least = np.full(SAMPLES, np.iinfo(np.uint32).max, np.uint32)
    upper = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(upper), PART):
        hashed = upper[at : at + PART, None] ^ _XOR
        hashed *= _MULTIPLY
        np.minimum(least, hashed.min(axis=0), out=least)
    return least.astype(np.uint64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """Bits that an odd number of the samples fall on."""
    at = mixed(least ^ _SALT) % np.uint64(SKETCH)
    odd = (np.bincount(at.astype(np.int64), minlength=SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little")


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key a band, from its samples and its number."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = mixed(key * _MIX + column)
    return key.view(np.int64)


@functools.cache
def most_odd(percent: int) -> int:
    """The count of odd bits that a pair of the given similarity exceeds with probability ``MISS`` at most.

    Of the samples a binomial number differ; each that does flips one bit in either sketch, and a
    count of odd bits grows or shrinks by one with each flip.
    """
    p = 1 - percent / 100
    differing = np.zeros(SAMPLES + 1)
    differing[0] = (1 - p) ** SAMPLES
    for i in range(SAMPLES):
        differing[i + 1] = differing[i] * (SAMPLES - i) / (i + 1) * p / (1 - p) if p < 1 else 0
    odd, above = np.zeros(SKETCH + 1), np.zeros(SKETCH + 1)
    odd[0] = 1
    z = np.arange(SKETCH + 1)
    for i in range(SAMPLES + 1):
        above += differing[i] * odd
        for _ in range(2):
            flipped = np.zeros(SKETCH + 1)
            flipped[1:] += (odd * (SKETCH - z) / SKETCH)[:-1]
            flipped[:-1] += (odd * z / SKETCH)[1:]
            odd = flipped
    tail = np.cumsum(above[::-1])[::-1]  # probability of a count of z or more
    return int(np.flatnonzero(tail > MISS)[-1])


SKETCHED = "doc_id long, f long, r long, n long, d1 long, d2 long, sketch binary, bands array<long>"


def sketch_rows(rows: DataFrame) -> DataFrame:
    """Size, digest, sketch and band keys of each document's set; no sketch and no band for a set without a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            n, d1, d2, sketches, bands = [], [], [], [], []
            for text in utf8(batch["text"]):
                shingles = shingle_set(text, known)
                digest = xxhash.xxh3_128_digest(shingles.tobytes())
                n.append(len(shingles))
                d1.append(int.from_bytes(digest[:8], "little", signed=True))
                d2.append(int.from_bytes(digest[8:], "little", signed=True))
                if not len(shingles):
                    sketches.append(None)
                    bands.append(None)
                    continue
                least = samples(shingles)
                sketches.append(odd_sketch(least).tobytes())
                bands.append(band_keys(least))
            columns = [
                batch["doc_id"], batch["f"], batch["r"], pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                pa.array(sketches, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "f", "r", "n", "d1", "d2", "sketch", "bands"])

    return rows.select(F.col("d.doc_id").cast("long").alias("doc_id"), "f", "r", F.col("d.text").alias("text")).mapInArrow(run, SKETCHED)


def sets_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, shingles)``: the full sets of some nodes, from the texts at their addresses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            found = [shingle_set(text, known).tobytes() for text in utf8(batch["text"])]
            for start, end in slices([len(s) for s in found], 1 << 24):
                yield pa.RecordBatch.from_arrays(
                    [batch["node"].slice(start, end - start), pa.array(found[start:end], pa.binary())], ["node", "shingles"]
                )

    # Sorted on either side at any size, so that the plan is the same for small and large tables.
    texts = rows.select("f", "r", F.col("d.text").alias("text")).join(nodes.select("f", "r", "node").hint("merge"), ["f", "r"])
    return texts.select("node", "text").mapInArrow(run, "node long, shingles binary")


def colliding(nodes: DataFrame) -> DataFrame:
    """``(key, size, blocks, block, node)``: buckets of at least two nodes.  Of buckets with the same nodes, as copies that agree on
    many bands have them, one is kept."""
    banded = nodes.select("node", "n", F.explode("bands").alias("key"))
    marks = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"m{i}") for i in (1, 2)]
    sums = [F.count("*").alias("size"), F.sum("n").alias("all"), *marks]
    buckets = banded.groupBy("key").agg(*sums).where("size > 1")
    once = buckets.groupBy("size", "all", "m1", "m2").agg(F.min("key").alias("key"))
    # Blocks of a power of two in number, so that bands with about the same nodes cut them alike.
    wanted = f"greatest(size / {BLOCK}, all * 8 / {BLOCK_BYTES}, 1)"
    once = once.select("key", "size", F.expr(f"CAST(pow(2, ceil(log2({wanted}))) AS BIGINT)").alias("blocks"))
    block = F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).alias("block")
    return banded.join(once, "key").select("key", "size", "blocks", block, "node")


class Groups:
    """Rows sorted by some columns, one group after the other, whatever batches they come in."""

    def __init__(self, by: list[str]):
        self.by, self.held = by, None

    def _starts(self, table: pa.Table) -> list[int]:
        at = np.stack([table[c].to_numpy() for c in self.by])
        return np.flatnonzero(np.concatenate([[True], (at[:, 1:] != at[:, :-1]).any(axis=0)])).tolist()

    def of(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if self.held is None else pa.concat_tables([self.held, table]).combine_chunks()
            starts = self._starts(held)
            # The last group may go on in the next batch.
            yield from (held.slice(s, e - s) for s, e in zip(starts[:-1], starts[1:], strict=True))
            self.held = held.slice(starts[-1])
        if self.held is not None:
            yield self.held


def sketch_words(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows["sketch"].to_pylist()), "<u8").reshape(-1, SKETCH // 64)


def passing(words: np.ndarray, sizes: np.ndarray, i: int, others: np.ndarray, percent: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of some rows that row ``i`` may link with, and their counts of odd bits."""
    m, n = sizes[i], sizes[others]
    others = others[100 * np.minimum(m, n) >= percent * np.maximum(m, n)]
    odd = np.bitwise_count(words[others] ^ words[i]).sum(axis=1, dtype=np.int64)
    return others[odd <= most], odd[odd <= most]


def nearest(members: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: the pairs that the nodes of each block propose."""
    most, first, wanted = most_odd(percent), FIRST, NEAREST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in Groups(["key", "block"]).of(batches):
            if rows.num_rows < 2:
                continue
            node, sizes, words = rows["node"].to_numpy(), rows["n"].to_numpy(), sketch_words(rows)
            every = rows["size"][0].as_py() <= first
            a, b = [], []
            for i in range(len(node)):
                others = np.arange(i + 1, len(node)) if every else np.flatnonzero(np.arange(len(node)) != i)
                found, odd = passing(words, sizes, i, others, percent, most)
                if not every:
                    found = found[np.lexsort((node[found], odd))[:wanted]]
                a += [i] * len(found)
                b += found.tolist()
            x, y = node[a], node[b]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    dealt = members.repartition("key", "block").sortWithinPartitions("key", "block")
    return dealt.select("key", "block", "size", "node", "n", "sketch").mapInArrow(run, "a long, b long").distinct()


def shared_counts(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many elements a sorted set shares with each of some others."""
    joined = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, joined), len(own) - 1)
    starts = np.cumsum([0, *(len(o) for o in others[:-1])])
    return np.add.reduceat((own[at] == joined).astype(np.int64), starts)


def across(rows: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: confirmed links between different components of a bucket, from groups of (key, block, grp).

    Rows are the nodes of a block and the probes that meet it (``probe``).  A pair is confirmed in one of the buckets it shares.
    """
    most = most_odd(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in Groups(["key", "block", "grp"]).of(batches):
            node, root, sizes = (table[c].to_numpy() for c in ("node", "root", "n"))
            probe, words = np.asarray(table["probe"]), sketch_words(table)
            bands = np.asarray(table["bands"].combine_chunks().flatten()).reshape(-1, BANDS)
            sets = [np.frombuffer(value.as_buffer(), "<u8") for value in table["shingles"]]
            key, block = table["key"][0].as_py(), np.flatnonzero(~probe)
            a, b = [], []
            for i in np.flatnonzero(probe).tolist():
                others = block[root[block] != root[i]]
                others, _ = passing(words, sizes, i, others, percent, most)
                if not len(others):
                    continue
                # The smallest key both share: of buckets with the same nodes the one with the smallest key was kept.
                same = bands[others] == bands[i]
                others = others[np.where(same, bands[i], np.iinfo(np.int64).max).min(axis=1) == key]
                if not len(others):
                    continue
                shared = shared_counts(sets[i], [sets[j] for j in others])
                linked_ = others[100 * shared >= percent * (sizes[i] + sizes[others] - shared)]
                a += [i] * len(linked_)
                b += linked_.tolist()
            if a:
                # One link for each node that a component here has beside its first.
                ids, at = np.unique(np.concatenate([root[a], root[b]]), return_inverse=True)
                x, y = spanning(at[: len(a)], at[len(a) :], len(ids))
                yield pa.RecordBatch.from_arrays([pa.array(ids[x]), pa.array(ids[y])], ["a", "b"])

    by = ["key", "block", "grp"]
    dealt = rows.repartition(*by).sortWithinPartitions(*by)
    return dealt.select(*by, "node", "root", "n", "probe", "sketch", "bands", "shingles").mapInArrow(run, "a long, b long").distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                own, other = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = np.concatenate([own, other])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(mask), batch["b"].filter(mask)], ["a", "b"])

    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def linked(nodes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """``(node, root)`` of every node that links: root is the smallest node its links reach."""
    buckets = materialise(colliding(nodes), "buckets")
    near = nodes.join(buckets.select("node").distinct(), "node").select("node", "f", "r", "n", "sketch", "bands")
    near = materialise(near, "near")
    sets = materialise(sets_of(rows, near), "sets")

    described = buckets.join(near.select("node", "n", "sketch"), "node")
    links = materialise(confirmed(nearest(described, percent), sets, percent), "links")
    roots = components(links, "near-roots")

    # Largest component of each bucket, by counts a component that are aggregated before they are shuffled.
    # Small buckets of long texts are cut into blocks too, and only within one all pairs were proposed.
    rooted = buckets.where((F.col("size") > FIRST) | (F.col("blocks") > 1)).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = materialise(rooted, "rooted")
    counts = rooted.groupBy("key", "root").agg(F.count("*").alias("k"))
    main = counts.groupBy("key").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.sum("k").alias("all"), F.max("k").alias("k"))
    main = main.where(F.col("all") > F.col("k"))
    unsettled = materialise(rooted.join(main.select("key", "main"), "key"), "unsettled")
    if unsettled.isEmpty():
        return roots
    full = unsettled.join(near.select("node", "n", "sketch", "bands"), "node").join(sets, "node")
    kept = ["key", "node", "root", "n", "sketch", "bands", "shingles"]
    # Every block meets every group of probes; those are cut as blocks are.
    numbers = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    group = F.pmod(F.xxhash64("node", F.lit(4)), F.col("blocks")).alias("grp")
    probes = full.where("root <> main").select(*kept, group, F.explode(numbers).alias("block"), F.lit(True).alias("probe"))
    used = unsettled.where("root <> main").select("key", group).distinct()
    every = full.select(*kept, "block", F.lit(False).alias("probe")).join(used, "key")
    more = materialise(across(every.unionByName(probes, allowMissingColumns=False), percent), "links")
    if more.isEmpty():
        return roots
    # What is known already is passed on as one link a node.
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more), "near-roots")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every document."""
    rows = located(docs.select("doc_id", "text"), "near-docs")
    sketched = materialise(sketch_rows(rows), "sketches")
    # Ids first, so the smallest stands for a set; null ids last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "f", "r", "n", "sketch", "bands"))
    sets = sketched.where("n > 0").groupBy("d1", "d2").agg(F.count("*").alias("copies"), first.alias("x"))
    nodes = materialise(sets.select(F.monotonically_increasing_id().alias("node"), "d1", "d2", "copies", "x.*"), "nodes")
    roots = linked(nodes, rows, percent)

    named = nodes.select("node", "d1", "d2", "copies", F.col("doc_id").alias("least")).join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("sets"))
    # Sets of one row that link with nothing need no label.
    labels = named.join(least, "root").where("copies > 1 OR sets > 1").select("d1", "d2", "component_id", F.lit(True).alias("found"))
    spread = labels.select("*", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"))
    dealt = sketched.select("doc_id", "n", "d1", "d2", F.pmod(F.xxhash64("f", "r"), F.lit(SPREAD)).cast("int").alias("part"))
    joined = dealt.join(spread, ["d1", "d2", "part"], "left")
    component = F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
