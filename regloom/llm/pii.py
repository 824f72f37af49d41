"""Personal data by weak supervision, in DataFrame operations only.

Regular expressions propose candidate spans: the four base kinds and looser forms of each.  Labelers vote on each
candidate, +1, 0 or -1: its shape (checksums, number ranges), a gazetteer that is given (domains, country codes, issuers), one that is
learned (endings and leading digits that ``KNOWN_IN`` documents hold in trusted candidates), cue words in the
context, and whether it stands alone.  Expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is for each kind; a logistic span classifier is then trained on the patterns with their
posterior probabilities, with features of the span's text (length, marks, form) and the word before it, and scores every
candidate.  Only counts by pattern reach the driver, whose number is bounded by the votes and buckets, not the corpus; the learned gazetteer
stays a table.  Base spans stay; other candidates join them if their shape is right, the classifier accepts them and they overlap none.

Offsets are in code points: a match starts after the pieces and matches before it, a running sum within its document.
Patterns use possessive runs, so that long runs of one character are read once.

Defined cases: null and empty texts have no spans (digests are of the empty string); rows with the same id are rows of
their own, a null id stays null; without any candidate there is nothing to learn; an empty table gives an empty
result; other columns play no part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regloom.llm.common import located
from regloom.session import materialise

# Candidate families as (family, kind, pattern, characters one of which it needs).
FAMILIES = [
    ("email", "email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "0-9"),
    ("card", "card", r"[0-9](?:[\x20-]?[0-9])++", "0-9"),
    ("phone", "phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    ("spelt_email", "email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+[ ]?(?:\[at\]|\(at\))[ ]?[A-Za-z0-9-]{1,63}[ ]?(?:\.|\[dot\]|\(dot\))[ ]?[A-Za-z]{2,24}", "[("),
    ("spelt_ip", "ip", r"(?<![0-9.])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))[0-9]{1,3}+){3}(?![0-9])", "[("),
    ("long_ip", "ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}+:){7}[0-9A-Fa-f]{1,4}+(?![0-9A-Fa-f:])", ":"),
    ("marked_card", "card", r"(?<![0-9])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])", "0-9"),
    ("short_card", "card", r"(?<![0-9])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9])", "0-9"),
    ("local_phone", "phone", r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])", "0-9"),
]
KINDS = ["email", "ip", "card", "phone"]
DOMAINS = "com org net edu gov info io dev app me biz eu de fr es uk us ca au ch at it nl".split()
COUNTRIES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 61 64 65 81 82 86 90 91".split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
CUES = r"(?i)\b(?:e-?mail|mail|contact|reach|write|tel|phone|call|fax|mobile|cell|card|visa|credit|ip|host|server|address|tél|correo|teléfono|telefon|karte|carte|tarjeta)\b"
ANTI = r"(?i)\b(?:version|release|isbn|order|invoice|total|page|chapter|section|article|figure|table)\b"
AROUND = 24  # characters of context on either side
VOTES = ["shape", "place", "known", "cue", "alone"]
BUCKETS = ["size", "marks", "form", "word"]
FORMS, WORDS = 8, 16  # hashed buckets of a span's form and of the word before it
KNOWN_IN = 5  # documents that make an ending or leading digits known
ACCEPT = 0.5
ROUNDS = 40


def spans_of(family: str, kind: str) -> Column:
    """A family's matches as structs, each with the length of the text since the one before and its surroundings."""
    pieces = F.col(f"{family}_pieces")

    def span(x: Column, i: Column) -> Column:
        return F.struct(
            F.lit(family).alias("family"), F.lit(kind).alias("kind"), i.alias("i"), x["match"].alias("match"),
            F.length(x["piece"]).cast("long").alias("skip"), F.right(x["piece"], F.lit(AROUND)).alias("before"),
            F.left(F.get(pieces, i + 1), F.lit(AROUND)).alias("after"),
        )

    return F.transform(F.arrays_zip(F.col(family).alias("match"), pieces.alias("piece")), span)


def candidates(rows: DataFrame) -> DataFrame:
    """f, r, family, kind, start, stop, match, before, after of all candidate spans."""
    text = F.coalesce(F.col("d.text"), F.lit(""))
    texts = rows.select("f", "r", text.alias("text"))
    found = texts
    for family, _, pattern, needs in FAMILIES:
        signs = "[0-9]" if needs == "0-9" else "[" + "".join(f"\\{c}" for c in needs) + "]"
        none = F.array().cast("array<string>")
        found = found.withColumn(family, F.when(F.col("text").rlike(signs), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    listed = []
    for family, kind, pattern, _ in FAMILIES:
        none = F.array().cast("array<string>")
        found = found.withColumn(f"{family}_pieces", F.when(F.size(family) > 0, F.split("text", pattern, -1)).otherwise(none))
        listed.append(spans_of(family, kind))
    # The outer form, as Spark would run all patterns twice to drop rows without a match ahead of the plain one.
    spans = found.select("f", "r", F.explode_outer(F.concat(*listed)).alias("s")).select("f", "r", "s.*").where("match IS NOT NULL")
    spans = materialise(spans, "op5-candidates")
    seen = Window.partitionBy("f", "r", "family").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("skip") + F.length("match")).over(seen)
    return spans.withColumn("stop", stop).withColumn("start", F.col("stop") - F.length("match")).drop("i", "skip")


def luhn(digits: str) -> str:
    """SQL: whether a string of digits passes the check sum."""
    digit = f"int(substring({digits}, length({digits}) - i, 1))"
    twice = f"if(i % 2 = 0, {digit}, {digit} * 2 - if({digit} > 4, 9, 0))"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (total, i) -> total + {twice}) % 10 = 0"


DIGITS = "regexp_replace(match, '[^0-9]', '')"
# The value rule of each base kind; also the shape labeler's rule for the looser forms.
VALID = {
    "email": "true",
    "ip": "if(family = 'long_ip', match RLIKE '[A-Fa-f]', forall(split(match, '[^0-9]+'), p -> p RLIKE '^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$'))",
    "card": f"length({DIGITS}) BETWEEN if(family = 'short_card', 15, 16) AND 19 AND {luhn(DIGITS)}",
    "phone": f"length({DIGITS}) BETWEEN 8 AND 15",
}


# What the learned gazetteer holds: the ending of an address, the first number or digits of the others.
LEAD = f"""CASE kind WHEN 'email' THEN lower(regexp_extract(match, '([A-Za-z]+)$', 1))
    WHEN 'ip' THEN lower(regexp_extract(match, '^([0-9A-Fa-f]+)', 1)) ELSE left({DIGITS}, 3) END"""


def known_leads(marked: DataFrame) -> DataFrame:
    """(kind, lead) of what enough documents hold in candidates whose shape is right and whose context or gazetteer agrees."""
    trusted = marked.where("shape = 1 AND (cue = 1 OR place = 1)").select("kind", "lead", "f", "r")
    documents = trusted.groupBy("kind", "lead").agg(F.approx_count_distinct(F.xxhash64("f", "r"), 0.02).alias("n"))
    return documents.where(F.col("n") >= KNOWN_IN).select("kind", "lead", F.lit(1).alias("known"))


def labelled(spans: DataFrame) -> DataFrame:
    """Candidates with ``base`` (a base span), the labelers' votes and the classifier's buckets."""
    quoted = lambda words: ", ".join(f"'{w}'" for w in words)
    valid = "CASE kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in VALID.items()) + " END"
    place = f"""CASE kind
        WHEN 'email' THEN if(lower(regexp_extract(match, '([A-Za-z]+)$', 1)) IN ({quoted(DOMAINS)}), 1, -1)
        WHEN 'ip' THEN if(match RLIKE '(?i)^(0|10|127|255)[^0-9a-f:]|^192[^0-9]+168[^0-9]|^(fe80|f[cd]..|0+):', -1, 1)
        WHEN 'card' THEN if({DIGITS} RLIKE '{ISSUERS}', 1, -1)
        ELSE if(family = 'local_phone', 0, if(exists(array({quoted(COUNTRIES)}), c -> startswith({DIGITS}, c)), 1, -1)) END"""
    cue = F.when(F.col("before").rlike(ANTI), -1).when(F.col("before").rlike(CUES) | F.coalesce(F.col("after"), F.lit("")).rlike(CUES), 1).otherwise(0)
    alone = F.when(F.col("before").rlike(r"[\p{L}\p{N}]$") | F.coalesce(F.col("after"), F.lit("")).rlike(r"^[\p{L}\p{N}]"), -1).otherwise(1)
    marked = spans.withColumn("valid", F.expr(valid)).withColumn("shape", F.when(F.col("valid"), 1).otherwise(-1))
    marked = marked.withColumn("place", F.expr(place)).withColumn("cue", cue).withColumn("alone", alone)
    marked = marked.withColumn("base", F.col("valid") & (F.col("family") == F.col("kind")))
    size = F.least(F.floor(F.length("match") / 4), F.lit(7)).cast("int")
    marks = F.least(F.length(F.regexp_replace("match", "[A-Za-z0-9]", "")), F.lit(5)).cast("int")
    plain = F.regexp_replace(F.regexp_replace("match", "[0-9]+", "0"), "[A-Za-z]+", "a")
    before = F.lower(F.regexp_extract("before", r"([\p{L}]+)[^\p{L}]*$", 1))
    marked = marked.withColumns({
        "size": size, "marks": marks, "form": F.pmod(F.crc32(plain.cast("binary")), F.lit(FORMS)).cast("int"),
        "word": F.when(before != "", F.pmod(F.crc32(before.cast("binary")), F.lit(WORDS - 1)) + 1).otherwise(0).cast("int"), "lead": F.expr(LEAD),
    })
    marked = materialise(marked.drop("before", "after", "valid", "match"), "op5-labelled")
    marked = marked.join(materialise(known_leads(marked), "op5-known"), ["kind", "lead"], "left")
    return marked.withColumn("known", F.coalesce("known", F.lit(0))).drop("lead")


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def estimate(patterns: list[tuple[str, tuple[int, ...], tuple[int, ...], int]]) -> list[float]:
    """Posterior probability of each pattern (kind, votes, buckets, count): a two-class model per kind in which every
    labeler has its own probabilities of voting +1, 0 or -1, fitted by expectation-maximisation."""
    post = [sigmoid(sum(votes) - 0.5) for _, votes, _, _ in patterns]
    for _ in range(ROUNDS):
        prior: dict[tuple, float] = {}
        rate: dict[tuple, float] = {}
        for (kind, votes, _, n), p in zip(patterns, post, strict=True):
            for y, weight in ((1, n * p), (0, n * (1 - p))):
                prior[kind, y] = prior.get((kind, y), 1.0) + weight
                for at, vote in enumerate(votes):
                    rate[kind, y, at, vote] = rate.get((kind, y, at, vote), 0.0) + weight
        new = []
        for kind, votes, _, _ in patterns:
            odds = math.log(prior[kind, 1]) - math.log(prior[kind, 0])
            for at, vote in enumerate(votes):
                # One vote of agreement each way is assumed besides those seen.
                up, down = ((rate.get((kind, y, at, vote), 0.0) + (2.0 if (vote > 0) == (y == 1) else 1.0)) / (prior[kind, y] + 4.0) for y in (1, 0))
                odds += math.log(up) - math.log(down)
            new.append(sigmoid(odds))
        post = new
    return post


def features(kind: str, votes: tuple[int, ...], buckets: tuple[int, ...]) -> list[tuple]:
    named = list(zip(VOTES, votes, strict=True)) + list(zip(BUCKETS, buckets, strict=True))
    return [("bias", kind, 0)] + [(name, kind, value) for name, value in named]


def fit(patterns: list[tuple[str, tuple[int, ...], tuple[int, ...], int]], post: list[float]) -> dict[tuple, float]:
    """Weights of the logistic span classifier, by gradient descent on the patterns' soft labels."""
    names: dict[tuple, int] = {}
    rows = [[names.setdefault(x, len(names)) for x in features(kind, votes, buckets)] for kind, votes, buckets, _ in patterns]
    total = {kind: sum(p[3] for p in patterns if p[0] == kind) for kind in KINDS}
    share = [n / total[kind] for kind, _, _, n in patterns]
    weight = [0.0] * len(names)
    for step in range(200):
        slope = [0.0] * len(names)
        for own, part, p in zip(rows, share, post, strict=True):
            wrong = (p - sigmoid(sum([weight[x] for x in own]))) * part
            for x in own:
                slope[x] += wrong
        rate = 2.0 / (1 + step / 100)
        weight = [w * 0.999 + rate * g for w, g in zip(weight, slope, strict=True)]
    return {name: weight[at] for name, at in names.items()}


def score(weight: dict[tuple, float]) -> Column:
    """The classifier as an expression over a candidate's columns."""
    parts = ["0D"]
    for name in ["bias", *VOTES, *BUCKETS]:
        own = [(kind, value, w) for (n, kind, value), w in sorted(weight.items()) if n == name]
        cases = " ".join(f"WHEN kind = '{k}'{'' if name == 'bias' else f' AND {name} = {v}'} THEN {w!r}D" for k, v, w in own)
        if cases:
            parts.append(f"CASE {cases} ELSE 0D END")
    return F.expr(f"1 / (1 + exp(-({' + '.join(parts)})))")


def classified(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``located`` documents, and all accepted spans: f, r, kind, start, stop, base, probability."""
    rows = located(docs, "op5-docs")
    marked = labelled(candidates(rows))
    counted = marked.groupBy("kind", *VOTES, *BUCKETS).count().collect()  # by pattern: bounded
    patterns = sorted((x["kind"], tuple(x[v] for v in VOTES), tuple(x[b] for b in BUCKETS), x["count"]) for x in counted)
    weight = fit(patterns, estimate(patterns))
    scored = marked.withColumn("probability", score(weight))
    # Base spans that reach over a candidate's start or begin before its end, from a running maximum and minimum.
    order = Window.partitionBy("f", "r").orderBy("start", "stop", "family")
    before = F.max(F.when(F.col("base"), F.col("stop"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    clear = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("stop")) >= F.col("stop"))
    kept = scored.withColumn("clear", clear).where(F.col("base") | (F.col("clear") & (F.col("shape") == 1) & (F.col("probability") >= ACCEPT)))
    return rows, kept.select("f", "r", "kind", "start", "stop", "base", "probability")


def joined(spans: str) -> Column:
    """kind:start:end of an array of (rank, start, stop), joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["stop"])), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans."""
    rows, spans = classified(docs)
    rank = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind")).cast("int") - 1
    span = F.struct(rank.alias("rank"), "start", "stop")
    per = spans.distinct().groupBy("f", "r").agg(
        F.array_sort(F.collect_list(F.when(F.col("base"), span))).alias("base"), F.array_sort(F.collect_set(span)).alias("all"),
        *(F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS),
    )
    per = per.select("f", "r", *(f"n_{k}" for k in KINDS), joined("base").alias("base"), joined("all").alias("spans"))
    named = rows.select("f", "r", F.col("d.doc_id").cast("long").alias("doc_id"))
    out = named.join(per, ["f", "r"], "left")
    return out.select(
        "doc_id", *(F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )
