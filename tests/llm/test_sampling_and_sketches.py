"""Brute-force checks of resampling, odd sketches and the divergence audit, with nulls, repeats, ties, long texts and clashing names."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from regloom.llm import divergence, odd_sketch, resample
from test_edges import LONG, PASSAGE, VOCAB, prose

SCHEMA = "doc_id long, text string, lang string, source string, n long, node long, rank int, d string, f string, words int, _metadata string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts():
    base = prose(120, 3)
    words = base.split()
    near = " ".join(words[:-1] + ["other"])
    return [
        (1, base), (2, base + "  "), (3, base.replace(" ", "\t")), (3, base), (3, base), (None, base), (None, None), (None, "alone here"),
        (4, None), (5, ""), (6, " \n\t"), (7, "One"), (8, "one two"), (8, "ONE two"), (9, "é Ünï code \x1c x_y 7x7 日本"), (10, LONG),
        (11, LONG[:-9] + "ending"), (12, near), (-5, " ".join(words[2:])), (14, prose(100, 9) + " " + PASSAGE), (15, base.upper()),
        (16, "x" * 5000), (17, "a " * 5000), (18, " ".join(words[:60])), (19, "tie tie"), (20, "tie tie"), (21, prose(21, 4)), (22, prose(19, 4)),
    ]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rows = [
        (i, t, [None, "de", "fr"][at % 3], [None, "s1", "s2", "é"][at % 4], 1, 2, 3, "d", "f", 4, "m") for at, (i, t) in enumerate(texts())
    ]
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def target(spark):
    rows = [(1, PASSAGE), (2, None), (2, PASSAGE.upper()), (None, prose(30, 4)), (3, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


def bag(rows):
    return collections.Counter(map(repr, map(tuple, rows)))


# --- resampling ---


def gram_features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def drawn(rows, target, longest, buckets, least_words, percent):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    found = [(i, *gram_features(t, longest)) for i, t in rows]
    s = collections.Counter(bucket(f) for _, _, fs in found for f in fs)
    t = collections.Counter(bucket(f) for _, text in target for f in gram_features(text, longest)[1])
    every, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (every + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in s}
    out = []
    for i, n, fs in found:
        weight = sum(gain[bucket(f)] for f in fs)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([n, i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    order = sorted((o for o in out if o[0] >= least_words), key=lambda o: (-o[4], o[1] is not None, o[1] or 0, o[2]))
    ranks = {id(o): at + 1 for at, o in enumerate(order[: percent * len(order) // 100])}
    return [(*o[1:], ranks.get(id(o))) for o in out]


@pytest.mark.parametrize(("longest", "buckets", "least", "percent"), [(1, 10_000, 20, 10), (3, 97, 2, 50), (2, 10_000, 0, 100)])
def test_resample(docs, target, longest, buckets, least, percent):
    got = resample.resample(docs, target, longest=longest, buckets=buckets, least_words=least, percent=percent).collect()
    rows, items = [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in target.collect()]
    assert bag(got) == bag(drawn(rows, items, longest, buckets, least, percent))


def test_resample_without_rows(docs, target):
    nothing = docs.where("doc_id = 12345")
    assert resample.resample(nothing, target).collect() == []
    got = resample.resample(docs, target.where("item_id = 77")).collect()
    assert bag(got) == bag(drawn([(r.doc_id, r.text) for r in docs.collect()], [], 1, 10_000, 20, 10))


def test_pieces_do_not_cut_words_or_windows(monkeypatch):
    text = ("Wörd 1x, " + prose(500, 8) + " " + "y" * 90 + "_é" * 30).encode()
    known = resample.Buckets(10_000)
    splitter = resample.pre_tokenizers.Split(resample.Regex(resample.WORD), "removed", invert=True)
    whole = resample.featurize(text, splitter, known, 3)
    monkeypatch.setattr(resample, "PIECE", 16)
    cut = resample.featurize(text, splitter, known, 3)
    assert whole[0] == cut[0] and sorted(whole[1]) == sorted(cut[1])
    assert whole[0], collections.Counter(whole[1]) == (gram_features(text.decode(), 3)[0], collections.Counter(known[f] for f in gram_features(text.decode(), 3)[1]))


# --- odd sketches ---


def grams(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(UPPER)) if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near_groups(rows, percent):
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)].append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = min(ids[find(i)], default=None)
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return out


@pytest.mark.parametrize("percent", [85, 100])
def test_near_duplicates(docs, percent):
    got = odd_sketch.near_duplicates(docs, percent).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert bag(got) == bag(near_groups([(r.doc_id, r.text) for r in docs.collect()], percent))
    assert odd_sketch.near_duplicates(docs.where("doc_id = 12345")).collect() == []


@pytest.mark.parametrize(("first", "block"), [(16, 512), (1, 8)])
def test_large_buckets_lose_no_link(spark, monkeypatch, first, block):
    """Chains and groups of near copies around the threshold, in buckets that are cut into many blocks."""
    monkeypatch.setattr(odd_sketch, "FIRST", first)
    monkeypatch.setattr(odd_sketch, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows, at = [], 0
    for seed, changes in ((1, 1), (2, 2), (3, 4), (4, 0)):
        words = np.random.default_rng(seed).choice(VOCAB, 150)
        for _ in range(60):
            own = words.copy()
            own[rng.integers(0, 150, rng.integers(0, changes + 1))] = f"changed{at}"
            rows.append((at * 7 % 1000, " ".join(own)))
            at += 1
        for step in range(30):  # each a little further from the first
            words = words.copy()
            words[step * 4 % 150] = f"step{step}"
            rows.append((1000 + at, " ".join(words)))
            at += 1
    got = odd_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert bag(got) == bag(near_groups(rows, 85))


def test_every_pair_is_tested_if_nothing_is_proposed(spark, monkeypatch):
    """All links come from the second step, also those of pairs that share many buckets with the same nodes."""
    monkeypatch.setattr(odd_sketch, "FIRST", 0)
    monkeypatch.setattr(odd_sketch, "NEAREST", 0)
    rows = []
    for seed in range(40):
        words = np.random.default_rng(seed).choice(VOCAB, 120)
        for copy in range(seed % 4 + 1):
            rows.append((seed * 10 + copy, " ".join(words) + f" end{copy}" * (copy + 1)))
    got = odd_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert bag(got) == bag(near_groups(rows, 85))


def test_small_buckets_of_long_texts_lose_no_link(spark, monkeypatch):
    """Texts so long that two of them fill more than a block."""
    monkeypatch.setattr(odd_sketch, "BLOCK_BYTES", 1 << 10)
    rows = []
    for seed in range(30):
        words = np.random.default_rng(seed).choice(VOCAB, 200)
        rows += [(seed * 10 + copy, " ".join(words) + f" end{copy}" * (copy + 1)) for copy in range(2 + seed % 2)]
    got = odd_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert bag(got) == bag(near_groups(rows, 85))


def test_sketches_estimate_high_similarities():
    rng = np.random.default_rng(7)
    most = odd_sketch.most_odd(85)
    counts = []
    for _ in range(300):
        both = rng.integers(0, 2**64, 850, np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 2**64, 75, np.uint64)]) for _ in range(2))
        counts.append(int(np.bitwise_count(odd_sketch.odd_sketch(odd_sketch.samples(a)) ^ odd_sketch.odd_sketch(odd_sketch.samples(b))).sum()))
    expected = odd_sketch.SKETCH / 2 * (1 - (1 - 2 / odd_sketch.SKETCH) ** (2 * odd_sketch.SAMPLES * 0.15))
    assert abs(np.mean(counts) - expected) < 4 and max(counts) <= most
    far = [odd_sketch.odd_sketch(odd_sketch.samples(rng.integers(0, 2**64, 900, np.uint64))) for _ in range(2)]
    assert np.bitwise_count(far[0] ^ far[1]).sum() > most


# --- divergence ---


def audit(rows, least_docs, smooth, scale, top):
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        held = collections.Counter(t for r in mine for t in set(r[2]))
        kept = {t for t, n in held.items() if n >= least_docs}
        counts = {s: collections.Counter(t for r in mine if r[1] == s for t in r[2] if t in kept) for s in {r[1] for r in mine}}
        whole = sum(counts.values(), collections.Counter())

        def share(c, t):
            return 1 + scale * (c[t] + smooth) // (sum(c.values()) + smooth * len(kept))

        for source, own in counts.items():
            pairs = [(o, sum(abs(share(own, t) - share(c, t)) for t in kept)) for o, c in counts.items() if o != source]
            terms = [(t, share(own, t) - share(whole, t)) for t in kept if own[t] > 0 and share(own, t) > share(whole, t)]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, item, value, at + 1) for at, (item, value) in enumerate(found[:most])]
    return out


@pytest.mark.parametrize(("least", "smooth", "top"), [(2, 5, 50), (1, 1, 3), (30, 5, 50)])
def test_divergence(docs, least, smooth, top):
    got = divergence.divergence(docs, least_docs=least, smooth=smooth, top=top).collect()
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    assert bag(got) == bag(audit(rows, least, smooth, 1_000_000_000, top))


def test_divergence_with_many_levels(spark, monkeypatch):
    """Counts over many blocks, groups without terms, and tasks that send on what they hold early."""
    monkeypatch.setattr(divergence, "HELD", 50)
    rng = np.random.default_rng(11)
    terms = [a + b for a in VOCAB[:30] for b in VOCAB[30:40]]
    rows = [("de", f"s{i % 5}", " ".join(rng.choice(terms, 300, p=(w := 1 / np.arange(1, 301)) / w.sum()))) for i in range(60)]
    rows += [("de", "none", "1 2 3"), ("xx", "one", "a"), ("xx", "two", None)]
    got = divergence.divergence(spark.createDataFrame(rows, "lang string, source string, text string").repartition(5), least_docs=3).collect()
    assert bag(got) == bag(audit(rows, 3, 5, 1_000_000_000, 50))
    assert divergence.divergence(spark.createDataFrame([], "lang string, source string, text string")).collect() == []


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = LONG.encode() + "Ünï_code".encode()
    whole = divergence.terms_of(text)
    monkeypatch.setattr(divergence, "PIECE", 100)
    assert divergence.terms_of(text) == whole
    assert whole == collections.Counter(t.encode() for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.decode().translate(UPPER)))


def test_counts_beyond_64_bits_of_products(spark):
    """The share of a count whose product with the scale passes 2^63."""
    n = 10**11
    row = spark.range(1).select(divergence.share(f"{n}L", f"{3 * n}L", "7L", 5, 1_000_000_000).alias("p")).first()
    assert row.p == 1 + 1_000_000_000 * (n + 5) // (3 * n + 35)
