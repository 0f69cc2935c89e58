"""Registered queries of the operators, with production parameters, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import let, words_of
from sieveline.llm.contamination import contamination_report
from sieveline.llm.fingerprints import fingerprint_documents
from sieveline.llm.language import identify_language
from sieveline.llm.near import near_duplicates
from sieveline.llm.packing import pack_documents
from sieveline.llm.phrases import collocations
from sieveline.llm.quality import quality_filter
from sieveline.llm.runs import periodic_runs, run_digests
from sieveline.llm.secrets import scan_secrets
from sieveline.llm.sentencepieces import encode_documents, first_byte_id, load_pieces
from sieveline.llm.sharding import shard_documents
from sieveline.llm.substrings import repeated_words
from sieveline.llm.tokens import added_tokens
from sieveline.llm.warc import archive_roundtrip


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words(_table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return encode_documents(_table(spark, sf_dir, "documents"), load_pieces(model), first_byte_id(model))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = quality_filter(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return kept.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = scan_secrets(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        added=added_tokens(public_tokenizers.path("byte_bpe_50k.json")),
    )


def op8_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_roundtrip(_table(spark, sf_dir, "pages"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return report.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def with_periodic_ends(docs: DataFrame) -> DataFrame:
    """``docs`` where, by the digest of their ids, one text in ten ends in words that repeat."""
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def repeated(words):
        n, g = F.size(words).cast("long"), F.floor(digest / 10)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        at = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.array_join(F.transform(at, lambda i: F.get(words, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int"))), " ")

    new = let(words_of(F.col("text")), lambda words: F.when(F.size(words) > 0, repeated(words)))
    return docs.select("doc_id", F.coalesce(F.when(F.pmod(digest, F.lit(10)) == 0, new), "text").alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_periodic_ends(_table(spark, sf_dir, "documents"))))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_near_dedup": op3_near_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_language_id": op5_language_id,
    "op6_secret_scan": op6_secret_scan,
    "op7_packing": op7_packing,
    "op8_warc_roundtrip": op8_warc_roundtrip,
    "op9_fingerprints": op9_fingerprints,
    "op10_sharding": op10_sharding,
    "op11_decontamination": op11_decontamination,
    "op12_collocations": op12_collocations,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {
    "op1_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), t AS (
            SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
        ), p AS (
            SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS l FROM t
        ), g AS (
            SELECT doc_id, i, md5(array_to_string(l, ' ')) AS h FROM p WHERE len(l) = 50
        ), f AS (
            SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first FROM g
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM f WHERE first < doc_id
        ), k AS (
            SELECT t.doc_id, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY t.i) FILTER (gone.i IS NULL) AS kept
            FROM t LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.i = t.i GROUP BY t.doc_id
        )
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k ON k.doc_id = d.doc_id
    """,
    "op8_warc_roundtrip": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
            SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p
        ), f AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest, payload_bytes >= 100) END AS first
            FROM d
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to,
               true AS intact
        FROM f
    """,
    "op11_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), b AS (
            SELECT CAST(item_id AS VARCHAR) AS item_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), g AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
            FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
        ), t AS (
            SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
        ), p AS (
            SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l FROM t
        ), h AS (
            SELECT DISTINCT p.doc_id, p.i, g.k, g.item_id
            FROM p JOIN (SELECT DISTINCT k FROM g) ks ON len(p.l) >= ks.k
                   JOIN g ON g.k = ks.k AND g.gram = array_to_string(p.l[1 : ks.k], ' ')
        ), c AS (
            SELECT doc_id, count(DISTINCT word_at) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS word_at FROM h) GROUP BY doc_id
        ), s AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
            FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id
        )
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(s.n_items, 0) AS n_items,
               sha256(coalesce(s.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN s ON s.doc_id = d.doc_id
    """,
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
        ), cut AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), total AS (
            SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM cut GROUP BY lang
        ), grams AS (
            SELECT lang, w[i : i + k - 1] AS p
            FROM (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS k
                  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut WHERE len(w) > 0))
        ), f AS (
            SELECT lang, p, count(*) AS c FROM grams GROUP BY lang, p HAVING count(*) >= 100
        ), cuts AS (
            SELECT lang, p, c AS a, unnest(range(1, len(p))) AS k FROM f WHERE len(p) > 1
        ), scored AS (
            SELECT cuts.lang, cuts.p, k, a, h.c AS l, t.c AS r, n,
                   CAST((1000::HUGEINT * a * n) // (h.c::HUGEINT * t.c) AS BIGINT) AS score
            FROM cuts JOIN f h ON h.lang = cuts.lang AND h.p = cuts.p[1 : k]
                      JOIN f t ON t.lang = cuts.lang AND t.p = cuts.p[k + 1 : len(cuts.p)]
                      JOIN total ON total.lang = cuts.lang
        ), lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
        ), parts AS (
            SELECT lang, p[i : i + m - 1] AS p, max(c) AS longer
            FROM (SELECT lang, p, c, m, unnest(range(1, len(p) - m + 2)) AS i
                  FROM (SELECT lang, p, c, unnest(range(2, len(p))) AS m FROM f WHERE len(p) > 2))
            GROUP BY ALL
        ), kept AS (
            SELECT x.lang, array_to_string(x.p, ' ') AS phrase, a, l, r, n, score
            FROM lowest x LEFT JOIN parts y ON y.lang = x.lang AND y.p = x.p
            WHERE y.longer IS NULL OR 100 * y.longer < 100 * x.a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
    """,
    "op13_periodic_runs": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   xor(list_reduce([4294967295] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                           lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
                       lambda acc, x: xor(xor(acc, x) >> 1, (xor(acc, x) & 1) * 3988292384)), 4294967295) AS h
            FROM documents
        ), c AS (
            SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS ends, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g FROM d
        ), t0 AS (
            SELECT doc_id, unnest(w) AS word, unnest(range(0, n)) AS i FROM c
        ), t AS (
            SELECT x.doc_id, x.n, x.i, t0.word
            FROM (SELECT doc_id, n, i, CASE WHEN ends AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END AS j
                  FROM (SELECT doc_id, n, ends, a, g, unnest(range(0, n)) AS i FROM c)) x
            JOIN t0 ON t0.doc_id = x.doc_id AND t0.i = x.j
        ), e AS (
            SELECT l.doc_id, l.i, r.i - l.i AS q FROM t l JOIN t r ON r.doc_id = l.doc_id AND r.word = l.word AND r.i > l.i AND 4 * (r.i - l.i) <= l.n
        ), s AS (
            SELECT doc_id, q, min(i) AS start, count(*) + q AS length
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e)
            GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
        ), runs AS (
            SELECT doc_id, start, length, min(q) AS period FROM s GROUP BY doc_id, start, length
        ), best AS (
            SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1
        ), lines AS (
            SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
            FROM runs GROUP BY doc_id
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
        ), kept AS (
            SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.i) FILTER (gone.i IS NULL) AS words
            FROM t LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.i = t.i GROUP BY t.doc_id
        )
        SELECT c.doc_id, coalesce(n_runs, 0) AS n_runs, best.start, best.length, best.period,
               1000 * best.length // best.period AS exponent_milli,
               sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept.words, '')) AS collapsed_sha256
        FROM c LEFT JOIN lines ON lines.doc_id = c.doc_id LEFT JOIN best ON best.doc_id = c.doc_id
               LEFT JOIN kept ON kept.doc_id = c.doc_id
    """,
}
