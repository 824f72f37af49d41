"""Registered queries of the corpus operators, each over its whole table, and SQL for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regloom.llm import (
    debruijn,
    decontaminate,
    divergence,
    exact_dedup,
    langid,
    maxent_lm,
    odd_sketch,
    packing,
    pii,
    quality_cnn,
    resample,
    simhash_tiles,
    warc_fixity,
)
from regloom.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_tiles.simhash_groups(table(spark, sf_dir, "documents"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.substring_dedup(table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score_documents(spark, table(spark, sf_dir, "documents"))


# The replica that op8 audits: every 97th page has lost its first character to a question mark.
REPLICA = "CASE WHEN page_id % 97 = 5 AND length(html) > 0 THEN concat('?', substring(html, 2)) ELSE html END"


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_fixity.fixity(table(spark, sf_dir, "pages"), REPLICA)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1,
    "op2_exact_dedup": op2,
    "op3_simhash": op3,
    "op4_substring": op4,
    "op5_pii": op5,
    "op6_pack": op6,
    "op7_lm": op7,
    "op8_warc": op8,
    "op9_langid": op9,
    "op10_quality": op10,
    "op11_resample": op11,
    "op12_minhash": op12,
    "op13_divergence": op13,
}

ORACLE = {
    "op2_exact_dedup": r"""
        WITH plain AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
            FROM documents),
        ranked AS (
            SELECT *, first_value(doc_id) OVER g AS keep_id, row_number() OVER g AS place, count(*) OVER (PARTITION BY bare) AS group_size
            FROM plain WINDOW g AS (PARTITION BY bare ORDER BY n DESC, doc_id))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(bare) AS text_sha256 FROM ranked""",
    "op4_substring": r"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM split),
        windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS gram FROM starts),
        first AS (SELECT gram, min(doc_id) AS least FROM windows GROUP BY gram),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
            FROM windows JOIN first USING (gram) WHERE least < doc_id),
        placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
            FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM split LEFT JOIN kept USING (doc_id)""",
    "op8_warc": r"""
        WITH replicas AS (
            SELECT *, CASE WHEN page_id % 97 = 5 AND length(html) > 0 THEN '?' || substr(html, 2) ELSE html END AS other FROM pages),
        records AS (
            SELECT page_id,
                   array_to_string(['WARC/1.1', 'WARC-Type: resource', 'WARC-Record-ID: <urn:page:' || page_id || '>',
                       'WARC-Target-URI: ' || url, 'WARC-Date: 1970-01-01T00:00:00Z', 'Content-Type: text/html',
                       'Content-Length: ' || strlen(html), '', ''], chr(13) || chr(10)) AS head,
                   html || chr(13) || chr(10) || chr(13) || chr(10) AS own,
                   other || chr(13) || chr(10) || chr(13) || chr(10) AS theirs
            FROM replicas)
        SELECT page_id, strlen(head || own) AS length, sha256(head || own) AS sha256,
               CASE WHEN own = theirs THEN 'intact' ELSE 'damaged' END AS status, sha256(head || theirs) AS replica_sha256
        FROM records""",
    "op11_resample": r"""
        WITH RECURSIVE crc(i, j, v) AS (
            SELECT i, 0, i FROM range(256) t(i)
            UNION ALL
            SELECT i, j + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END FROM crc WHERE j < 8),
        lookup AS (SELECT list(v ORDER BY i) AS t FROM crc WHERE j = 8),
        split AS (
            SELECT row_number() OVER () AS row, doc_id, words(text) AS words FROM documents),
        own AS (SELECT row, unnest(words) AS word FROM split),
        theirs AS (SELECT unnest(words(text)) AS word FROM benchmark),
        hex AS (SELECT word, lower(hex(encode(word))) AS h FROM (SELECT word FROM own UNION SELECT word FROM theirs)),
        bytes AS (
            SELECT word, list_transform(range(1, length(h), 2), lambda i:
                (instr('0123456789abcdef', substr(h, i, 1)) - 1) * 16 + instr('0123456789abcdef', substr(h, i + 1, 1)) - 1) AS b FROM hex),
        bucketed AS (
            SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, b::BIGINT[]), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])),
                             4294967295::BIGINT) % 10000 AS bucket
            FROM bytes, lookup),
        source AS (SELECT bucket, count(*) AS s FROM own JOIN bucketed USING (word) GROUP BY bucket),
        target AS (SELECT bucket, count(*) AS t FROM theirs JOIN bucketed USING (word) GROUP BY bucket),
        totals AS (SELECT (SELECT count(*) FROM own)::DOUBLE AS s_all, (SELECT count(*) FROM theirs)::DOUBLE AS t_all),
        gain AS (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
            FROM source LEFT JOIN target USING (bucket), totals),
        weights AS (SELECT row, sum(gain)::BIGINT AS weight FROM own JOIN bucketed USING (word) JOIN gain USING (bucket) GROUP BY row),
        noise AS (
            SELECT row, doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
                   ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
            FROM split LEFT JOIN weights USING (row)),
        scored AS (
            SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM noise),
        ranked AS (
            SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
        FROM scored LEFT JOIN ranked USING (row)""".replace(
        "words(text)",
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')",
    ),
    "op12_minhash": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS words FROM documents),
        grams AS (
            SELECT DISTINCT doc_id, gram FROM (
                SELECT doc_id, array_to_string(words[i:i + 4], ' ') AS gram
                FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM split WHERE len(words) > 0))),
        sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
        edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach(x, y) AS (SELECT x, y FROM edges UNION SELECT reach.x, edges.y FROM reach JOIN edges ON reach.y = edges.x),
        roots AS (SELECT x AS doc_id, min(y) AS least FROM reach GROUP BY x)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id,
               doc_id <= coalesce(least, doc_id) AS kept
        FROM split LEFT JOIN sizes USING (doc_id) LEFT JOIN roots USING (doc_id)""",
    "op13_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        groups AS (SELECT DISTINCT lang, source FROM docs),
        uses AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
        kept AS (SELECT lang, term, count(*) AS n FROM uses GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
        langs AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM kept GROUP BY lang),
        counted AS (SELECT lang, source, term, count(*) AS n FROM uses GROUP BY ALL),
        every AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS in_lang
            FROM groups g JOIN kept k USING (lang) LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        totals AS (SELECT lang, source, sum(n)::BIGINT AS total FROM every GROUP BY ALL),
        shares AS (
            SELECT e.lang, e.source, e.term, e.n,
                   1 + 1000000000::HUGEINT * (e.n + 5) // (t.total + 5 * l.v) AS p, 1 + 1000000000::HUGEINT * (e.in_lang + 5) // (l.total + 5 * l.v) AS q
            FROM every e JOIN totals t ON t.lang = e.lang AND t.source = e.source JOIN langs l ON l.lang = e.lang),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
            GROUP BY ALL),
        parts AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL
            SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q)
        SELECT * FROM (
            SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM parts)
        WHERE part = 'pair' OR rank <= 50""",
}
