"""The registered queries of the training-data operators, and the SQL of those that SQL can say."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm import (align, bpe, chat, decontam, langid, mlm, quality, resample, secret, simhash, substring,
                        toxicity, warc)
from plinth.llm.common import table, written


def ranks_path() -> str:
    """The rank file; PLINTH_RANKS overrides the installed one."""
    if path := os.environ.get("PLINTH_RANKS"):
        return path
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary(spark, ranks_path())
    return (bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary, keep_text=False)
            .select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.parse(chat.transcripts_of(table(spark, sf_dir, "conversations")))


def _remainder(of: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(_remainder(4) != 2))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "kept", "quality")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontam.mark(docs, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items",
                         F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(_remainder(3) != 1))
    found = toxicity.score(docs, model)
    return found.select("doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = written(mlm.count_words(docs), "words")
    return mlm.score_words(docs, mlm.fit(docs, counts=counts), counts)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    pair = align.load(os.environ.get("PLINTH_ALIGN_A") or public_tokenizers.path("byte_bpe_50k.json"),
                      os.environ.get("PLINTH_ALIGN_B") or public_tokenizers.path("piece_bpe_32k.model"))
    found = align.aligned_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), pair)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = [r.kind for r in secret.BASE]
    found = secret.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    base = secret.spans_text(secret.of_kinds(F.col("secrets"), kinds))
    return found.select(
        "doc_id", *[F.size(secret.of_kinds(F.col("secrets"), [k])).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), secret.spans_text(F.col("secrets")).alias("spans"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = resample.resample(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_chat": op2_chat,
    "op3_langid": op3_langid,
    "op4_quality": op4_quality,
    "op5_decontaminate": op5_decontaminate,
    "op6_warc": op6_warc,
    "op7_toxicity": op7_toxicity,
    "op8_lm": op8_lm,
    "op9_simhash": op9_simhash,
    "op10_substring": op10_substring,
    "op11_align": op11_align,
    "op12_secrets": op12_secrets,
    "op13_resample": op13_resample,
}


def _scan_sql() -> str:
    """Spans by marking: the pieces between \\x01 and \\x02 are matches, their places the lengths before them.

    Matches that are too short are dropped afterwards, as the rules say; ``group`` is read again from the match.
    """
    def of(k: int, r: secret.Rule) -> str:
        pattern = ("(?i)" if r.any_case else "") + r.pattern.replace("'", "''")
        part = f"regexp_extract(p, '{pattern}', {r.group})" if r.group else "p"
        return f"""
            SELECT doc_id, {k} AS k, '{r.kind}' AS kind, a, a + length(p) AS b
            FROM (SELECT doc_id, p, i, sum(length(p)) OVER (PARTITION BY doc_id ORDER BY i) - length(p) AS a
                  FROM (SELECT doc_id, unnest(parts) AS p, unnest(range(len(parts))) AS i
                        FROM (SELECT doc_id, string_split(
                                  regexp_replace(coalesce(text, ''), '({pattern})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS parts
                              FROM documents)))
            WHERE i % 2 = 1 AND length({part}) >= {r.least}"""
    spans = " UNION ALL ".join(of(k, r) for k, r in enumerate(secret.RULES))
    base = f"list(kind || ':' || a || ':' || b ORDER BY a, k) FILTER (k < {len(secret.BASE)})"
    counts = "".join(f"coalesce(count(*) FILTER (kind = '{r.kind}'), 0) AS n_{r.kind}, " for r in secret.BASE)
    return f"""
        WITH spans AS ({spans})
        SELECT doc_id, {counts}
               sha256(coalesce(array_to_string({base}, ','), '')) AS base_sha256,
               coalesce(array_to_string(list(kind || ':' || a || ':' || b ORDER BY a, k) FILTER (kind IS NOT NULL), ','), '') AS spans
        FROM documents LEFT JOIN spans USING (doc_id) GROUP BY doc_id"""


_RESAMPLE_SQL = f"""
    WITH RECURSIVE
    steps AS (SELECT range AS b, 0 AS i, range::UBIGINT AS c FROM range(256)
              UNION ALL
              SELECT b, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM steps WHERE i < 8),
    crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE i = 8),
    words AS (
        SELECT 'd' AS side, doc_id AS id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        UNION ALL
        SELECT 't', item_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
    runs AS (
        SELECT side, id, unnest(list_concat(list_concat(w,
                   list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])),
                   list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f
        FROM words),
    kinds AS (SELECT f, hex(encode(f)) AS h FROM runs GROUP BY f),
    hashed AS (
        SELECT f, xor(list_reduce(list_concat([4294967295::UBIGINT],
                   list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT)),
                   lambda x, y: xor(x >> 8, t[(xor(x, y) & 255)::BIGINT + 1])), 4294967295::UBIGINT) % {resample.BUCKETS} AS bucket
        FROM kinds, crc),
    counts AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t
               FROM runs JOIN hashed USING (f) GROUP BY bucket),
    totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM counts),
    gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + {resample.BUCKETS})
                                             / ((s + 1)::DOUBLE * (t_all + {resample.BUCKETS}))))::BIGINT AS gain
              FROM counts, totals),
    weights AS (SELECT id, count(*) AS n, sum(gain)::BIGINT AS weight
                FROM runs JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
    scored AS (
        SELECT id AS doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::UBIGINT::DOUBLE + 0.5)
                                                          / 4294967296)))::BIGINT AS score
        FROM words LEFT JOIN weights USING (id) WHERE side = 'd'),
    ranked AS (
        SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n
        FROM scored WHERE n_words >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN r <= 5 * n // 100 THEN r END AS rank
    FROM scored LEFT JOIN ranked USING (doc_id)"""

ORACLE: dict[str, str] = {
    "op12_secrets": _scan_sql(),
    "op13_resample": _RESAMPLE_SQL,
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
             d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
                          sha1(encode(html)) AS payload_digest FROM p),
             f AS (SELECT payload_digest, max(page_id) AS response FROM d
                   WHERE payload_bytes >= 1000 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN response IS NULL OR response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN response <> page_id THEN response END AS refers_to
        FROM d LEFT JOIN f USING (payload_digest)""",
}
