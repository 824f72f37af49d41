"""Brute-force checks of the corpus operators on documents with nulls, repeats, ties, long texts and clashing names."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from regloom.llm import debruijn, decontaminate, exact_dedup, langid, maxent_lm, packing, pii, quality_cnn, simhash_tiles, warc_fixity
from regloom.llm.common import components
from regloom.llm.queries import tokenizer_path

rng = np.random.default_rng(5)
VOCAB = ["".join(rng.choice(list("abcdeioust"), rng.integers(2, 8))) for _ in range(400)]
SCHEMA = "doc_id long, text string, lang string, digest string, f long, r string, keep string, part int, words string, d string, _metadata string"


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCAB, n).tolist())


PASSAGE = prose(60, 1)
LONG = prose(30_000, 2)


def texts():
    base = prose(80, 3)
    return [
        (1, base), (2, base + "  "), (3, base.replace(" ", "\t")), (3, base), (3, base), (None, base), (None, None),
        (4, None), (5, ""), (6, " \n\t"), (7, "One"), (8, "one two"), (9, "é Ünï code \x1c x y"), (10, LONG),
        (11, LONG[:-9] + "ending"), (12, prose(50, 4) + " " + PASSAGE + " " + prose(40, 5)), (13, PASSAGE + " " + prose(20, 6)),
        (14, prose(9, 7) + " " + PASSAGE), (15, base.upper()), (16, prose(79, 3) + " changed"), (-17, prose(30, 8) + " " + PASSAGE),
        (19, "nt " * 40 + prose(20, 30)), (20, prose(5, 31) + " nt" * 30), (21, (prose(15, 32) + " ") * 3), (22, (prose(15, 32) + " ") * 5),
        (18, "mail a.b@c.de, 1.2.3.4 and 300.1.1.1 or +49 (30) 1234-567 now"),
    ]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rows = [(i, t, "de" if (i or 0) % 2 else "fr", "x", 1, "r", "k", 0, "w", "d", "m") for i, t in texts()]
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id = 12345")


def split(text):
    return (text or "").encode().split()


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_exact_dedup(docs, digest_bytes):
    rows = [(i, t or "", re.sub(r"[\x20\x09-\x0D]", "", t or "")) for i, t in texts()]
    groups = collections.defaultdict(list)
    for i, t, bare in rows:
        groups[bare].append((-len(t), i is None, i or 0, i))
    expected = collections.Counter()
    for i, _t, bare in rows:
        expected[i, min(groups[bare])[3], len(groups[bare]), sha(bare.encode())] += 1
    got = exact_dedup.exact_dedup(docs, digest_bytes).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_drops_rows(docs, spark):
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert left.count() == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in texts()})
    # A frame that is not read from files has no addresses of its own.
    made = spark.createDataFrame([(1, "a"), (1, "a"), (2, " a")], "doc_id long, text string")
    assert [r.doc_id for r in exact_dedup.drop_copies(made).collect()] == [2]


def test_state_goes_on_over_batches(spark, tmp_path):
    """A second run with the same checkpoint adds to the groups of the first."""
    keys = str(tmp_path / "keys")
    sizes = []
    for batch in ([(1, "a b"), (2, "c")], [(3, "ab"), (4, "c ")]):
        part = spark.createDataFrame(batch, "doc_id long, text string")
        rows = exact_dedup.located(part, "test")
        exact_dedup.keyed(rows).drop("bare").write.mode("append").parquet(keys)
        schema = spark.read.parquet(keys).schema
        exact_dedup.run_state(spark, keys, schema, str(tmp_path / "check"), str(tmp_path / "out"))
        state = exact_dedup.read_state(spark, str(tmp_path / "out")).collect()
        sizes.append(sorted((r.keep.doc_id, r.group_size) for r in state))
    assert sizes == [[(1, 1), (2, 1)], [(1, 2), (4, 2)]]


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_groups(docs):
    prints = [(i, simhash(t)) for i, t in texts()]
    label = list(range(len(prints)))
    for _ in prints:
        for a, (_, x) in enumerate(prints):
            for b, (_, y) in enumerate(prints):
                if (x ^ y).bit_count() <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    least = {}
    for at, (i, _) in zip(label, prints, strict=True):
        if i is not None:
            least[at] = min(least.get(at, i), i)
    expected = collections.Counter((i, f"{x:016x}", least.get(at)) for at, (i, x) in zip(label, prints, strict=True))
    assert collections.Counter(tuple(r) for r in simhash_tiles.simhash_groups(docs).collect()) == expected
    left = simhash_tiles.keep_one(docs)
    assert left.columns == docs.columns and left.count() == len(set(label))


def test_links_join_all_within_the_radius(spark, monkeypatch):
    """Random fingerprints with planted neighbours, in tiles so small that they are cut."""
    monkeypatch.setattr(simhash_tiles, "TILE", 4)
    r = np.random.default_rng(3)
    prints = list(r.integers(0, 1 << 64, 300, np.uint64))
    for base in prints[:60]:
        for flips in range(1, 5):
            mask = sum(1 << int(b) for b in r.choice(64, flips, replace=False))
            prints.append(base ^ np.uint64(mask))
    x = np.array(sorted(set(prints)), np.uint64)
    a, b = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3)
    label = np.arange(len(x))
    for _ in range(20):
        np.minimum.at(label, a, label[b])
    frame = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    found = components(simhash_tiles.links(frame), "test").collect()
    root = {v: v for v in x.view(np.int64).tolist()} | {r.node: r.root for r in found}
    ours = collections.defaultdict(set)
    theirs = collections.defaultdict(set)
    for v, at in zip(x.view(np.int64).tolist(), label.tolist(), strict=True):
        ours[root[v]].add(v)
        theirs[at].add(v)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_components(spark):
    """A long chain, a star, a cycle and repeated links."""
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(200, 201), (201, 202), (202, 200), (202, 200), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "test").collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200, 202: 200}


@pytest.mark.parametrize("often", [512, 2])
def test_substring(docs, monkeypatch, often):
    monkeypatch.setattr(debruijn, "SLICE", 3000)
    monkeypatch.setattr(debruijn, "OFTEN", often)
    first = {}
    for i, t in texts():
        w = split(t)
        for p in range(len(w) - 12):
            if i is not None:
                gram = tuple(w[p : p + 13])
                first[gram] = min(first.get(gram, i), i)
    expected = collections.Counter()
    for i, t in texts():
        w, gone = split(t), set()
        for p in range(len(w) - 12):
            if i is not None and first[tuple(w[p : p + 13])] < i:
                gone.update(range(p, p + 13))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        expected[i, len(w), len(gone), sha(kept)] += 1
    for wide in (False, True):
        got = debruijn.attempt(docs, 42, wide).collect()
        assert collections.Counter(tuple(r) for r in got) == expected


def test_substring_notices_colliding_hashes(docs, monkeypatch):
    monkeypatch.setattr(debruijn, "hashed_windows", lambda t, s, own=debruijn.hashed_windows: (lambda o, p, m, h: (o, p, m * np.uint64(0), h & np.uint64(7)))(*own(t, s)))
    assert debruijn.attempt(docs, 42, False) is None


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        odd = [int(d) for d in digits[::-1]]
        return 16 <= len(digits) <= 19 and sum(d if j % 2 == 0 else d * 2 - 9 * (d > 4) for j, d in enumerate(odd)) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


PERSONAL = [
    "x@y.z a.b@c.d_e@f.g @h.i j@k l@m..n o@p.q. %+-@a-.b", "1.2.3.4.5.6.7.8 256.1.1.1 0255.0.0.1 1.2.3 9.9.9.9x 1..2.3.4.5",
    "4111 1111-1111 1111 4111111111111112 4111111111111111 12  34 4111 1111 1111 1111 1", "+49 30 123456 +1 +1(2)3 ++12345678 +1 (824) 555-6522.",
    "é😀 +1 800 555 0100 😀 a@b.cc 10.0.0.255", "7" * 20000, "a" * 20000 + "@" + "b" * 5000, "+" + "1" * 30000, "1." * 8000, " " * 9000 + "+4" + " " * 9000,
    "call (824) 555-6522 or 824-555-6522, mail dan [at] example [dot] com", None, "", "a@b.c" * 2000,
]


def test_pii(spark, docs):
    rows = [(i, t) for i, t in enumerate(PERSONAL)] + [(3, PERSONAL[3]), (None, PERSONAL[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kind", F.lit(1)).withColumn("start", F.lit("s"))
    got = pii.find_pii(frame).collect()
    expected = collections.Counter()
    for i, t in rows:
        spans = base_spans(t)
        expected[(i, *(sum(k == s[0] for s in spans) for k in BASE), sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()))] += 1
    assert collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == expected
    for r in got:
        if r.doc_id is not None:
            assert {f"{k}:{a}:{b}" for k, a, b in base_spans(rows[r.doc_id][1])} <= set(r.spans.split(","))
    assert pii.find_pii(docs).count() == len(texts())


def luhn_digit(digits):
    return str(-sum(int(d) if i % 2 else (int(d) * 2 - 9 if int(d) > 4 else int(d) * 2) for i, d in enumerate(digits[::-1])) % 10)


def test_looser_forms_of_each_kind(spark):
    """Planted in prose beside look-alikes that are no personal data: what is added is right, and little is missed."""
    r = np.random.default_rng(8)

    def digits(n):
        return "".join(map(str, r.integers(0, 10, n)))

    def card(start, n):
        body = start + digits(n - len(start) - 1)
        return body + luhn_digit(body)

    def v4():
        return [str(x) for x in r.integers(11, 120, 4)]

    good = {
        "email": lambda: f"{prose(1, r.integers(99))}{r.choice(['[at]', ' (at) '])}{prose(1, r.integers(99))} [dot] {r.choice(['com', 'org', 'net'])}",
        "spelt_ip": lambda: r.choice(["[.]", "(.)"]).join(v4()),
        "long_ip": lambda: ":".join(f"{x:x}" for x in r.integers(0x2001, 0xFFFF, 8)),
        "marked_card": lambda: (lambda d: ".".join(d[i : i + 4] for i in range(0, 16, 4)))(card("4", 16)),
        "short_card": lambda: (lambda d: f"{d[:4]} {d[4:10]} {d[10:]}")(card("37", 15)),
        "phone": lambda: f"{r.choice(['212', '415', '646'])}-555-{digits(4)}",
    }
    kind_of = {"spelt_ip": "ip", "long_ip": "ip", "marked_card": "card", "short_card": "card"}
    bad = [
        lambda: f"invoice {digits(3)}-{digits(3)}-{digits(4)}x", lambda: "release " + "[.]".join(str(x) for x in r.integers(300, 999, 4)),
        lambda: "order " + "/".join(digits(4) for _ in range(4)), lambda: f"page {digits(2)}:{digits(2)}:{digits(2)}", lambda: "section 3" + "7" + digits(13) + "9z",
    ]
    base = [lambda: f"mail ann{digits(3)}@site{digits(2)}.com", lambda: "server " + ".".join(v4()), lambda: "card " + card("4", 16), lambda: f"phone +1 {digits(3)} {digits(3)} {digits(4)}"]
    cue = {"email": "write", "ip": "server", "card": "visa", "phone": "call"}
    rows, planted = [], set()
    for i in range(400):
        text = prose(8, 1000 + i) + " "
        if i % 4 == 0:
            text += base[i // 4 % 4]() + " " + prose(4, i)
        elif i % 4 < 3:
            family = list(good)[i % len(good)]
            kind = kind_of.get(family, family)
            text += f"{cue[kind]}: "
            span = good[family]()
            planted.add((i, kind, len(text), len(text) + len(span)))
            text += span + " " + prose(4, i)
        else:
            text += bad[i % len(bad)]() + " " + prose(4, i)
        rows.append((i, text))
    docs, spans = pii.classified(spark.createDataFrame(rows, "doc_id long, text string"))
    named = docs.select("f", "r", F.col("d.doc_id").alias("doc_id"))
    got = {(x.doc_id, x.kind, x.start, x.stop) for x in spans.where("NOT base").join(named, ["f", "r"]).collect()}
    assert len(planted) > 150 and {k for _, k, _, _ in planted} == {"email", "ip", "card", "phone"}
    assert len(got & planted) > 0.9 * len(planted), [p for p in planted - got][:5]
    assert len(got & planted) > 0.9 * len(got), [p for p in got - planted][:5]
    for kind in ("email", "ip", "card", "phone"):
        assert {g for g in got if g[1] == kind} & planted


def test_estimate_trusts_the_better_labeler():
    """Three labelers agree with the truth, two vote at random."""
    r = np.random.default_rng(1)
    patterns = collections.Counter()
    for _ in range(4000):
        y = 1 if r.random() < 0.5 else -1
        votes = tuple(y if r.random() < right else -y for right in (0.95, 0.9, 0.9, 0.5, 0.5))
        patterns["email", votes, (1, 1, 1, 1)] += 1
    rows = [(*k, n) for k, n in sorted(patterns.items())]
    post = pii.estimate(rows)
    for (_, votes, _, _), p in zip(rows, post, strict=True):
        assert (p > 0.5) == (sum(votes[:3]) > 0)
    weight = pii.fit(rows, post)
    assert abs(weight["alone", "email", 1]) < abs(weight["shape", "email", 1])


def test_packing(docs):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer_path())
    packed = packing.pack(docs, tokenizer_path(), length=128, group=40, with_ids=True)
    rows = packed.collect()
    ids = {i: [] for i, _ in texts()}
    pieces = collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    expected = collections.Counter()
    for i, t in texts():
        ids[i] = encoder.encode(t or "", add_special_tokens=False).ids + [2]
        for s in range(0, len(ids[i]), 128):
            part = np.array(ids[i][s : s + 128], "<u4")
            expected[i, s, len(part), zlib.crc32(part.tobytes()), len(ids[i])] += 1
    assert pieces == expected
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 128
    assert sum(len(r.ids) for r in packing.sequences(packed).collect()) == sum(r.length for r in rows)


def test_words_are_encoded_as_in_their_text():
    from tokenizers import Tokenizer

    encoder, words = Tokenizer.from_file(tokenizer_path()), packing.WordIds(tokenizer_path(), cached=50)
    for text in ["It's 3rd! ΣΑΣ x <|endoftext|> é ́a don't\x1cstop \x85 12,5€", LONG[:3000], "", " \n"] + [t or "" for _, t in texts()]:
        assert np.frombuffer(words.of(text.encode()), "<u4").tolist() == encoder.encode(text, add_special_tokens=False).ids


def test_letters_that_only_compose_in_lower_case():
    from tokenizers import Tokenizer

    encoder, words = Tokenizer.from_file(tokenizer_path()), packing.WordIds(tokenizer_path())
    marked = ["H\u0331arf", "J\u030cana", "T\u0308one", "W\u030aord", "Y\u030aear"]
    for text in [*marked, "Plain H. " + ", ".join(marked) + ". END, É. x"]:
        assert np.frombuffer(words.of(text.encode()), "<u4").tolist() == encoder.encode(text, add_special_tokens=False).ids


def test_first_fit_decreasing():
    r = np.random.default_rng(2)
    sizes = sorted(r.integers(1, 100, 500).tolist(), reverse=True)
    found, offset = packing.first_fit_decreasing(sizes, 100)
    room: list[int] = []
    for size, at, o in zip(sizes, found, offset, strict=True):
        fits = next((i for i, x in enumerate(room) if x >= size), len(room))
        if fits == len(room):
            room.append(100)
        assert (at, o) == (fits, 100 - room[fits])
        room[fits] -= size


def test_language_model(docs, spark):
    got = maxent_lm.score_documents(spark, docs).collect()
    lower = [(i, re.sub(b"[A-Z]", lambda m: m[0].lower(), (t or "").encode()).split() + [None]) for i, t in texts()]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False for i, _ in lower}
    counts = collections.Counter(w for i, ws in lower if not held[i] for w in ws)
    total = sum(counts.values())
    expected = sorted((str(i), held[i], len(ws), sum(counts[w] > 0 for w in ws), total) for i, ws in lower)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == expected
    base = sorted((str(i), sum(np.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in ws)) for i, ws in lower)
    for (a, x), (b, y) in zip(sorted((str(r.doc_id), r.base_score) for r in got), base, strict=True):
        assert a == b and abs(x - y) < 1e-6 * max(1, abs(y))
    assert all(r.score < 0 for r in got)


def word_hash(word):
    return xxhash.xxh64_intdigest(word, maxent_lm.SEED) or 1


def tiny_model(spark):
    """A model of a few texts, and the tokens it was taught."""
    rows = [(i, prose(90, 50 + i % 5) + (" once" if i % 3 else "")) for i in range(30)] + [(100, ""), (101, "a\x1cb  É é\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts, known, counts, total, _ = maxent_lm.prepared(docs)
    return rows, *maxent_lm.fit(known, counts, total), {r.h & (2**64 - 1): r.c for r in counts.collect()}


def test_language_model_against_brute_force(spark, monkeypatch):
    """Counts by context, feature functions, softmaxes and shares once more in plain Python, over batches of any size."""
    monkeypatch.setattr(maxent_lm, "LEAST_ROWS", 1 << 10)
    rows, shared, weights, known = tiny_model(spark)
    model = shared.value

    def split(text):
        return [word_hash(w) for w in re.sub(b"[A-Z]", lambda m: m[0].lower(), text.encode()).split()] + [0]

    def number(x):
        return int(np.array([x % 2**64], np.uint64)[0])

    def mix(x):
        return int(maxent_lm.mixed(np.array([number(x)], np.uint64))[0])

    def at(h):
        return int(maxent_lm.leaf_of(np.array([h], np.uint64))[0])

    bits = 64 - (model.rows.bit_length() - 1)

    def contexts_of(tokens, i):
        one, two = (tokens[i - 1] if i else 0), (tokens[i - 2] if i > 1 else 0)
        first = mix(one + 1)
        found = [first, mix(first ^ number(two * int(maxent_lm._C3))), mix(two + 0x51ED270B)]
        top = at(tokens[i]) // 32
        with_class = [mix(x ^ number((top + 1) * int(maxent_lm._C4))) >> (bits + 5) for x in found]
        return [[x >> bits for x in found], [x + top * (model.rows // 32) for x in with_class]]

    counted = collections.defaultdict(lambda: [0] * 32)
    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 7 == 2:
            continue
        tokens = split(text)
        for j, h in enumerate(tokens):
            for softmax, where in enumerate(contexts_of(tokens, j)):
                for kind, row in enumerate(where):
                    counted[softmax, kind, row][at(h) % 32 if softmax else at(h) // 32] += 1
    mass = [1] * 1024
    for h, c in known.items():
        mass[at(h)] += c + 1
    top = [sum(mass[32 * k : 32 * k + 32]) for k in range(32)]

    def chance(tokens, j):
        leaf, total = at(tokens[j]), 0.0
        earlier = [at(h) for h in tokens[: j - j % maxent_lm.SPAN]]
        for softmax, where in enumerate(contexts_of(tokens, j)):
            k = leaf // 32
            shares = [m / top[k] for m in mass[32 * k : 32 * k + 32]] if softmax else [t / sum(top) for t in top]
            past = collections.Counter(e % 32 for e in earlier if e // 32 == k) if softmax else collections.Counter(e // 32 for e in earlier)
            logits = [np.log(s) for s in shares]
            for kind in range(4):
                counts = counted[softmax, kind, where[kind]] if kind < 3 else [past[v] for v in range(32)]
                weight, smooth = weights[softmax, kind, int(np.log2(sum(counts) + 1))], float(maxent_lm.SMOOTH[kind])
                logits = [z + weight * np.log((c + smooth * s) / (sum(counts) + smooth) / s) for z, c, s in zip(logits, counts, shares)]
            chances = np.exp(np.array(logits) - max(logits))
            total += np.log10(chances[leaf % 32 if softmax else leaf // 32] / chances.sum())
        return total + np.log10((known.get(tokens[j], 0) + 1) / mass[leaf])

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    fresh = [(1000, "once upon " + prose(40, 52)), (1001, "q")]
    tested = [(i, t) for i, t in rows[:8] + rows[-2:] + fresh]
    for chunk in (1, 3, 256):
        monkeypatch.setattr(maxent_lm, "CHUNK", chunk)
        import pyarrow as pa

        batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in tested], "held_out": [False] * len(tested), "text": [t for _, t in tested]})
        (got,) = maxent_lm.score_batches(shared, weights)([batch])
        for (_, text), n, score in zip(tested, got["n_tokens"].to_pylist(), got["model"].to_pylist(), strict=True):
            tokens = split(text)
            assert n == len(tokens) and abs(score - sum(chance(tokens, j) for j in range(len(tokens)))) < 2e-3 * n
    monkeypatch.undo()
    assert docs.count() == len(rows)


def test_language_model_learns_from_every_document(spark):
    """The weights move for documents of any hash, not only for those of some part of the training documents."""
    rows = [(i, prose(90, 50 + i % 5)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").where("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 7 <> 2")
    for part in range(8):
        some = docs.where(f"pmod(xxhash64(doc_id, text), 8) = {part}")
        assert some.count() > 5
        _, known, counts, total, _ = maxent_lm.prepared(some)
        _, weights = maxent_lm.fit(known, counts, total)
        assert np.abs(weights - maxent_lm.START_WEIGHT).max() > 0.01


def test_slopes_are_those_of_the_loss(spark):
    """Against differences of the loss, each token's own count taken out of its rows; also where the model has scored before."""
    import pyarrow as pa

    rows, shared, weights, _ = tiny_model(spark)
    model = shared.value
    t = maxent_lm.encode(pa.array([text for i, text in rows if zlib.crc32(str(i).encode()) % 7 != 2][:9]))
    before = maxent_lm.token_scores(t, model, weights)
    model.prepare()
    (b,) = maxent_lm.batches_in(t, model)
    leaf, here = b.leaf, np.arange(len(b.leaf))

    def loss(softmax, w):
        value, top = (leaf % 32 if softmax else leaf // 32), leaf // 32
        share = model.shares[1][top] if softmax else np.repeat(model.shares[0], len(leaf), axis=0)
        z = np.log(share).astype(float)
        for kind in range(3):
            rows = b.rows[softmax * 3 + kind]
            counts = np.rint(model.cells[rows] * model.scale[rows][:, None]).astype(float)
            counts[here, value] -= 1
            total, smooth = model.total[rows], float(maxent_lm.SMOOTH[kind])
            level = np.minimum(np.log2(total).astype(int), maxent_lm.LEVELS - 1)
            z += w[kind][level][:, None] * np.log((counts / share + smooth) / (total[:, None] + smooth))
        x, total = b.so_far[softmax]
        z += w[3][np.minimum(np.log2(total + 1).astype(int), maxent_lm.LEVELS - 1)][b.which[softmax]][:, None] * x[b.which[softmax]]
        return -(z[here, value] - np.log(np.exp(z).sum(axis=1))).sum()

    for softmax in (0, 1):
        got = np.stack(list(maxent_lm.slopes(model, softmax, b, weights[softmax], maxent_lm.Room(maxent_lm.NGRAMS + 2))))
        for kind, level in [(0, 0), (0, 3), (1, 2), (2, 4), (3, 0)]:
            up, down = weights[softmax].copy(), weights[softmax].copy()
            up[kind, level] += 1e-4
            down[kind, level] -= 1e-4
            assert abs(got[kind, level] - (loss(softmax, up) - loss(softmax, down)) / 2e-4) < 1e-2
    assert np.array_equal(maxent_lm.token_scores(t, model, weights), before)


def test_tokens_of_slices():
    """Texts in a batch that is cut into slices, with nulls, blanks at either end and characters of several bytes."""
    import pyarrow as pa

    found = [None, " a\x0bÉ\x1c B c  ", "", "\n", LONG, "x" * 3000, "É\u00a0É", "end "] * 3
    for most in (1, 100, 1 << 20):
        got = []
        for a, b in maxent_lm.slices([len((t or "").encode()) for t in found], most):
            t = maxent_lm.encode(pa.array(found, pa.string()).slice(a, b - a))
            ends = np.cumsum(t.n)
            got += [t.hashes[t.index[e - n : e]].tolist() for e, n in zip(ends, t.n)]
        assert got == [[word_hash(re.sub(b"[A-Z]", lambda m: m[0].lower(), w)) for w in (t or "").encode().split()] + [0] for t in found]


def test_language_model_is_a_distribution(spark):
    """Over all known words and an unknown one in each subclass, the probabilities after a context add up to one."""
    _, shared, weights, known = tiny_model(spark)
    model = shared.value
    model.prepare()
    words = sorted(known)
    places = {int(l) for l in maxent_lm.leaf_of(np.array(words, np.uint64))}
    rng = np.random.default_rng(3)
    unknown = {}
    while len(unknown) < 1024:
        h = rng.integers(1, 2**63, dtype=np.uint64)
        if int(h) not in known:
            unknown.setdefault(int(maxent_lm.leaf_of(np.array([h]))[0]), int(h))
    assert len(places) > 100
    total = 0.0
    for h in [*words, *unknown.values()]:
        index = np.array([0, 1, 2, 3])
        t = maxent_lm.Tokens(np.array([words[5], words[9], words[5], h], np.uint64), index, np.array([4]))
        leaf = int(maxent_lm.leaf_of(np.array([h], np.uint64))[0])
        total += 10 ** maxent_lm.token_scores(t, model, weights)[-1] * (known.get(h, 0) + 1) / model.mass[leaf]
    assert abs(total - 1) < 1e-4


def test_fixity(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://x/{i}", f"<p>{i}é</p>" * (i % 5)) for i in range(300)] + [(None, None, None), (7, "http://x/7", "<p>again</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("offset", F.lit("o")).coalesce(2)
    damage = "CASE WHEN page_id % 50 = 6 THEN concat('?', substring(html, 2)) ELSE html END"
    got = warc_fixity.fixity(pages, damage).collect()
    assert len(got) == len(rows)
    assert sorted(r.page_id for r in got if r.status == "damaged") == [6, 56, 106, 156, 206, 256]
    assert all((r.sha256 == r.replica_sha256) == (r.status == "intact") for r in got)


def test_warc_files(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"<p>{i}é\r\n\r\nWARC/1.1</p>" * (i % 5)) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    for name in ("a", "b"):
        warc_fixity.write_warc(pages, str(tmp_path / name))
    own = next((tmp_path / "a").glob("*.txt"))
    (tmp_path / "a" / "one.warc").write_bytes(own.read_bytes())
    own.unlink()
    data = bytearray((tmp_path / "a" / "one.warc").read_bytes())
    records = warc_fixity.read_warc(spark, str(tmp_path / "a") + "/one.warc")
    assert sorted((r.uri, r.block) for r in records.collect()) == sorted((u, h) for _, u, h in rows)
    at = data.index(b"<p>22") + 1
    data[at] ^= 1
    other = tmp_path / "c"
    other.mkdir()
    (other / "one.warc").write_bytes(bytes(data))
    broken = warc_fixity.read_warc(spark, str(other))
    leaves = [x.select("archive", "seq", "offset", "length", "digest") for x in (records, broken)]
    found = warc_fixity.audit(*(warc_fixity.tree(x) for x in leaves)).collect()
    assert [(r.seq, r.status) for r in found] == [(22, "damaged")] and found[0].offset <= at < found[0].offset + found[0].length


def leaves(spark, *replicas):
    """Leaves of archive "a" from records given as (name, length)."""
    made = []
    for records in replicas:
        offsets = np.cumsum([0] + [n for _, n in records]).tolist()
        rows = [("a", i, offsets[i], n, name) for i, (name, n) in enumerate(records)]
        made.append(warc_fixity.tree(spark.createDataFrame(rows, warc_fixity.LEAF)))
    return made


def test_audit_of_lost_added_and_moved_records(spark):
    own = [(f"r{i}", 10 + i % 7) for i in range(100)]
    own[90] = own[91] = ("twin", 12)
    found = lambda other: {(r.seq, r.status, r.replica_digest) for r in warc_fixity.audit(*leaves(spark, own, other)).collect()}
    # One lost before two damaged ones side by side: all that follows the lost one has moved.
    other = own[:5] + own[6:]
    other[39], other[40] = ("x", own[40][1]), ("y", own[41][1])
    moved = {(i, "moved", own[i][0]) for i in range(6, 100) if i not in (40, 41)}
    assert found(other) == moved | {(5, "missing", None), (40, "damaged", "x"), (41, "damaged", "y")}
    # One added; one damaged before it.
    other = own[:60] + [("new", 11)] + own[60:]
    other[3] = ("x", own[3][1])
    assert found(other) == {(i, "moved", own[i][0]) for i in range(60, 100)} | {(60, "extra", "new"), (3, "damaged", "x")}
    # One put elsewhere.
    other = own[:20] + own[21:51] + [own[20]] + own[51:]
    assert {(s, d) for s, k, d in found(other) if k == "moved"} >= {(20, "r20")} and all(k == "moved" and 20 <= s <= 50 for s, k, _ in found(other))
    # Two records run together: those behind them stand where they stood.
    other = own[:30] + [("both", own[30][1] + own[31][1])] + own[32:]
    assert found(other) == {(30, "damaged", "both"), (31, "missing", None)}
    # One of two twins lost.
    assert found(own[:90] + own[91:]) == {(91, "missing", None)} | {(i, "moved", own[i][0]) for i in range(92, 100)}


def test_warc_parse_finds_the_next_record():
    blocks = [f"<p>{i}\r\n\r\nWARC/1.1</p>" * (i % 3) for i in range(12)]
    records = [f"WARC/1.1\r\nWARC-Target-URI: u{i}\r\nContent-Length: {len(b)}\r\n\r\n{b}\r\n\r\n".encode() for i, b in enumerate(blocks)]
    digests = [hashlib.sha256(r).hexdigest() for r in records]
    for wrong in (b"Content-Length: 99999", b"Content-Length: x", b"Content-Length: 1", b"Content-Length: " + b"9" * 5000):
        broken = [re.sub(rb"Content-Length: \d+", wrong, r) if i == 4 else r for i, r in enumerate(records)]
        rows = list(warc_fixity.parse("f", b"".join(broken)))
        assert [r[4] for r in rows if r[5] != "u4"] == digests[:4] + digests[5:] and [r[6] for r in rows] == blocks
    for damaged in (records[4].replace(b"WARC/1.1\r", b"XARC/1.1\r"), records[4].replace(b"\r\n\r\n", b"\r\n\r.", 1)):
        rows = list(warc_fixity.parse("f", b"".join([*records[:4], damaged, *records[5:]])))
        assert [r[4] for r in rows[:4] + rows[5:]] == digests[:4] + digests[5:] and rows[4][3] == len(damaged)
    # A length that reaches to the end of a later record's head.
    at = len(records[4]) + records[5].index(b"\r\n\r\n") - records[4].index(b"\r\n\r\n") - 4
    rows = list(warc_fixity.parse("f", b"".join([*records[:4], re.sub(rb"Length: \d+", b"Length: %d" % at, records[4]), *records[5:]])))
    assert [r[4] for r in rows[5:]] == digests[5:] and len(rows) == 12
    cut = list(warc_fixity.parse("f", b"".join(records)[:-3]))
    assert len(cut) == 12 and sum(r[3] for r in cut) == len(b"".join(records)) - 3


def test_languages(spark):
    words = {"en": "the and of that this with which from have".split(), "de": "der und die das nicht mit sich ein auf".split(), "fr": "le la les et que dans pour une est".split(), "es": "el los las y que en por una es".split(), "ja": "日本 語の 文章 です ます".split()}
    r = np.random.default_rng(8)
    rows = [(i, " ".join(r.choice(words[code], 30).tolist()), code) for i, code in enumerate(list(words) * 60)]
    rows += [(1000, None, "en"), (1001, "123 !?", "en"), (1002, "", None), (None, "the and of", None), (1003, "le " * 100_000, "fr"), (3, "y los las", "es")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("s"))
    got = langid.identify(frame).collect()
    assert len(got) == len(rows)
    lang = {i: code for i, _, code in rows[:300]}
    right = [r.lang_pred == lang[r.doc_id] for r in got if r.doc_id in lang and r.held_out]
    assert right and sum(right) == len(right)
    odd = {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (1000, 1001, 1002)}
    assert odd == {i: ("und", 0.0) for i in (1000, 1001, 1002)}
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_are_taught_by_whole_texts(spark):
    words = {"en": "the and of that this with which from have", "de": "der und die das nicht mit sich ein auf"}
    # What tells the languages apart stands far from the middle.
    rows = [(i, f"{words[code]} {'zq ' * 8000}{words[code]}", code) for i, code in enumerate(["en", "de"] * 30)]
    rows += [(i, words[code], None) for i, code in ((1000, "en"), (1001, "de"))]
    got = {r.doc_id: r.lang_pred for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert (got[1000], got[1001]) == ("en", "de")


def test_trigrams_do_not_depend_on_slices(monkeypatch):
    text = ("Ein Satz, 7x é " + prose(300, 3)).encode()
    data = b" " + bytes(langid.CODES[np.frombuffer(text, np.uint8)]) + b" "
    grams = collections.Counter(data[i : i + 3] for i in range(len(data) - 2) if data[i + 1] != 32)

    def counted():
        return collections.Counter(np.concatenate([*langid.trigrams(text)]).tolist())

    whole = counted()
    assert sum(whole.values()) == sum(grams.values()) and len(whole) > len(grams) * 0.9
    for size in (1, 2, 3, 50):
        monkeypatch.setattr(langid, "SLICE", size)
        assert counted() == whole
    assert [len(x) for x in langid.trigrams(b"")] in ([], [0])


def test_languages_are_drawn_each_on_its_own(spark):
    ids = spark.range(300).where(langid.remainder(F.col("id"), langid.FOLDS) != langid.HELD)
    hot = ids.orderBy(F.xxhash64("id")).head().id
    often = spark.range(0, 5000, 1, 1).select(F.lit(hot).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"))
    few = ids.coalesce(1).select(F.col("id").alias("doc_id"), F.lit("ein text").alias("text"), F.lit("de").alias("lang"))
    drawn = collections.Counter(langid.sample(often.unionByName(few))[1])
    assert drawn == {"en": 2 * langid.SAMPLE, "de": ids.count()}


def test_many_languages_share_the_sample(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 200)
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.concat(F.lit("x"), F.col("id") % 40).alias("lang"))
    x, langs = langid.sample(rows)
    assert len(x) == len(langs) and len(set(langs)) == 40 and 100 < len(langs) < 320


def test_quality(spark, docs):
    rows = [(i, prose(30, i) if i % 2 else prose(30, i).upper().replace(" ", "!! ")) for i in range(200)]
    frame = spark.createDataFrame([*rows, (500, None), (501, ""), (None, "x"), (3, "A!! B!!")], "doc_id long, text string").withColumn("y", F.lit("y"))
    labels = spark.createDataFrame([(i, i % 2, None) for i, _ in rows] + [(None, 1, 1), (9999, 0, 1), (4, None, 1)], "doc_id long, quality int, toxic int")
    got = quality_cnn.quality(frame, labels).collect()
    assert len(got) == 204 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert np.mean([r.predicted == r.doc_id % 2 for r in held if r.doc_id is not None and r.doc_id < 200]) > 0.9
    kept = quality_cnn.keep_good(frame, labels)
    assert kept.columns == frame.columns and kept.count() == sum(r.predicted for r in got)
    assert quality_cnn.quality(docs, labels.where("quality > 5")).where("score <> 0.5").count() == 0


def test_quality_sample_is_bounded_and_repeats(spark):
    """One text an id, also where an id has most rows; ids by their hash, up to the bytes there may be."""
    rows = [(1, f"copy {i}") for i in range(500)] + [(i, "t" * 100) for i in range(2, 200)] + [(7, "t" * 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 200)] + [(3, 0), (None, 1)], "doc_id long, quality int")
    taught = {i for i in range(1, 200) if zlib.crc32(str(i).encode()) % 5}
    found = quality_cnn.sample(docs, labels, "quality")
    assert len(found) == len(taught) + (3 in taught) and found == quality_cnn.sample(docs.repartition(7), labels, "quality")
    few = quality_cnn.sample(docs, labels, "quality", max_bytes=1000)
    assert 1 <= len(few) <= 11 and set(few) <= set(found)
    assert len(quality_cnn.sample(docs, labels, "quality", max_bytes=1)) == 1
    drawn = quality_cnn.sample(docs, labels, "quality", most=20)
    assert 15 < len(drawn) < 70 and set(drawn) <= set(found)


def test_quality_reads_whole_texts(monkeypatch):
    """A text is scored alike in one batch and in small slices, and what stands at its end counts."""
    r = np.random.default_rng(1)
    shape = {"embed": (257, 8), "filters": (64, 32), "bias": (32,), "out": (64,), "shift": (1,)}
    w = {k: (r.standard_normal(s) * 0.2).astype(np.float32) for k, s in shape.items()}
    a, b = LONG[:20_000].encode(), LONG[:20_000].encode() + b" \xff\xfe\xfd" * 200
    one, two = quality_cnn.score_texts([a, b], w)
    monkeypatch.setattr(quality_cnn, "SLICE", 4 * quality_cnn.BLOCK)
    assert one != two and np.allclose(quality_cnn.score_texts([b, a], w), [two, one], atol=1e-6)


def shingles(words, n):
    return collections.Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else collections.Counter()


def similarity(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def test_decontaminate(docs, spark):
    long_item = prose(120, 9)
    w = long_item.split()
    items = [(1, PASSAGE), (2, " ".join(PASSAGE.split()[5:25])), (3, "one two"), (4, None), (5, " "), (None, PASSAGE.upper()), (6, long_item), (6, "One"), (7, prose(40, 77))]
    extra = [(30, " ".join([*prose(20, 20).split(), *w[:60], "changed", *w[61:], *prose(20, 21).split()])), (31, " ".join(w[:100])), (32, " ".join(w[8:]) + " tail" * 30), (33, " ".join(w[:70]))]
    frame = docs.select("doc_id", "text", "words").unionByName(spark.createDataFrame([(i, t, "x") for i, t in extra], "doc_id long, text string, words string"))
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(1))
    best = {}
    for i, t in texts() + extra:
        words = (t or "").lower().split() if i != 9 else (t or "").lower().encode().split()
        for item, text in items:
            own = (text or "").lower().split()
            n = min(5, len(own))
            grams = shingles(own, n)
            # Every window of the item's length, also those cut at the ends of the text.
            for p in range(1 - len(own), len(words)) if own and words else ():
                s = similarity(shingles(words[max(0, p) : p + len(own)], n), grams)
                if s >= 0.8:
                    best[i, item] = max(best.get((i, item), 0), s)
    got = decontaminate.contamination(frame, benchmark).collect()
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in best.items()}
    assert len(got) == len(best)
    left = decontaminate.drop_contaminated(frame, benchmark)
    bad = {i for i, _ in best}
    expected = collections.Counter(i for i, _ in texts() + extra if i not in bad)
    assert collections.Counter(r.doc_id for r in left.collect()) == expected and left.columns == frame.columns


def test_decontaminate_broadcasts_no_windows(spark, monkeypatch):
    """Windows grow with the documents: however small their files, they are never sent to the driver. Large tables of items are not either."""
    words = prose(200, 5).split()
    items = [" ".join(words[i : i + 30]) for i in range(0, 150, 30)]
    items += ["one two", items[0]]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [(i, f"{prose(10, i)} {items[i % 5]} {prose(10, i + 1)}") for i in range(300)] + [(None, items[1]), (301, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def run():
        found = decontaminate.contamination(docs, benchmark)
        plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
        return sorted(found.collect(), key=str), [below for line, below in zip(plan, plan[1:]) if "BroadcastExchange" in line]

    got, sent = run()
    assert len({r.doc_id for r in got}) == 302 and not [x for x in sent if "start#" in x]
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert run() == (got, [])


def test_empty_tables(none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    assert exact_dedup.exact_dedup(none).count() == 0
    assert simhash_tiles.simhash_groups(none).count() == 0
    assert debruijn.substring_dedup(none).count() == 0
    assert pii.find_pii(none).count() == 0
    assert packing.pack(none, tokenizer_path()).count() == 0
    assert maxent_lm.score_documents(spark, none).count() == 0
    assert langid.identify(none).count() == 0
    assert quality_cnn.quality(none, labels).count() == 0
    assert decontaminate.contamination(none, benchmark).count() == 0
    assert decontaminate.contamination(none, benchmark.limit(0)).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_fixity.fixity(pages, "html").count() == 0
