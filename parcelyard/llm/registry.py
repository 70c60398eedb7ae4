"""Registered queries of the operators for training data, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.llm import (
    exact_dedup,
    licences,
    line_dedup,
    lm_scoring,
    mixing,
    ngram_join,
    packing,
    quality_list,
    resampling,
    secrets_scan,
    source_audit,
    suffix_dedup,
    topk,
)
from parcelyard.llm.storage import text_or_empty

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def secret_spans(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    found = secrets_scan.scan_secrets(docs)
    base = F.filter("findings", lambda x: x["path"] == "")
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets_scan.KINDS],
        F.sha2(secrets_scan.joined_spans(base), 256).alias("base_sha256"),
        secrets_scan.joined_spans(F.col("findings")).alias("spans"),
        F.size("findings").alias("n_spans"),
    )


def top_vectors(spark: SparkSession, directory: str) -> DataFrame:
    vectors = table(spark, directory, "embeddings").select("vec_id", "embedding")
    return topk.top_products(vectors, F.col("vec_id") % 50 == 0)


def quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    rules = quality_list.learn(
        quality_list.labelled_rows(docs, table(spark, directory, "labels"))
    )
    judged = quality_list.judged(docs.select("doc_id", "text"), rules)
    return judged.select("doc_id", *quality_list.COUNTS, "base_failed", "kept", "rule")


def fuzzy_lines(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    cut = line_dedup.dedup_lines(docs)
    return cut.select(
        "doc_id", "n_removed_lines", F.sha2(text_or_empty(), 256).alias("kept_sha256")
    )


def ngram_links(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    return ngram_join.similar_documents(docs).select(
        F.col("doc").alias("doc_id"), "class_id", "n_links", "n_copies"
    )


def domain_rates(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    mixed = mixing.mix(docs, table(spark, directory, "labels"))
    return mixed.select(
        F.col("doc").alias("doc_id"), "n_tokens", "posterior", "rate", "n_copies"
    )


def repeated_bytes(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select(
        "doc_id", "text", F.octet_length(text_or_empty()).cast("long").alias("n_bytes")
    )
    cut = suffix_dedup.cut_repeats(docs)
    gone = F.aggregate(
        "removed", F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"]).cast("long")
    )
    return cut.select(
        "doc_id",
        "n_bytes",
        gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def text_scores(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    scored = lm_scoring.score_texts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return scored.withColumnRenamed("doc", "doc_id")


def packed_pieces(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    pieces = packing.cut_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    light = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place_pieces(light)


def licence_families(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    model = licences.train(licences.sample_paragraphs(docs))
    found = licences.scan_licences(docs, model)
    return found.select(
        "doc_id",
        F.size("licences").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct("licences.family")), ",").alias("families"),
        F.array_join("licences.paragraph", ",").alias("paragraphs"),
    )


def source_divergence(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("lang", "source", "text")
    return source_audit.audit_sources(docs)


def exact_copies(spark: SparkSession, directory: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, directory, "documents").select("doc_id", "text"))


def target_resampling(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    drawn = resampling.resample(docs, table(spark, directory, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Query] = {
    "op1_secret_spans": secret_spans,
    "op2_ngram_links": ngram_links,
    "op3_top_vectors": top_vectors,
    "op4_domain_rates": domain_rates,
    "op5_text_scores": text_scores,
    "op6_repeated_bytes": repeated_bytes,
    "op7_packed_pieces": packed_pieces,
    "op8_fuzzy_lines": fuzzy_lines,
    "op9_quality_rules": quality_rules,
    "op10_licence_families": licence_families,
    "op11_source_divergence": source_divergence,
    "op12_exact_copies": exact_copies,
    "op13_target_resampling": target_resampling,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _features(key: str, of: str) -> str:
    """SQL for (key, feature): runs of 1 to 3 words of every text of a table."""
    words = rf"regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    runs = " || ".join(
        f"list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))"
        for n in (1, 2, 3)
    )
    return f"""SELECT k, len(w) AS n_words, unnest({runs}) AS feature
        FROM (SELECT {key} AS k, coalesce({words}, []) AS w FROM {of})"""


def _crc32(text: str) -> str:
    """SQL for the checksum of a string's bytes; a byte's step is linear in its bits."""
    bits = [1 << k for k in range(8)]
    steps = []
    for bit in bits:
        for _ in range(8):
            bit = (bit >> 1) ^ (0xEDB88320 if bit & 1 else 0)
        steps.append(bit)
    step = "xor(c >> 8, {})"
    for bit, add in zip(bits, steps):
        step = step.format(f"xor(CASE WHEN xor(c & 255, b) & {bit} <> 0 THEN {add} ELSE 0 END, {{}})")
    # the list starts with the first state, which reduces the rest
    return f"""xor(4294967295, list_reduce([4294967295] || list_transform(
        range(0, strlen({text})), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)),
        lambda c, b: {step.format(0)}))"""

#: DuckDB SQL, where SQL can state the method.
ORACLE_SQL: dict[str, str] = {
    "op3_top_vectors": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
    SELECT query_id, vec_id, score, CAST(row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op11_source_divergence": rf"""
WITH docs AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all({_LOWER.format("coalesce(text, '')")},
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), kept AS (
    SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM docs)
    GROUP BY lang, term HAVING count(*) >= 10
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), counted AS (
    SELECT lang, source, term, count(*) AS n
    FROM (SELECT lang, source, unnest(w) AS term FROM docs) JOIN kept USING (lang, term) GROUP BY ALL
), dense AS (
    SELECT lang, source, term, CAST(coalesce(n, 0) AS HUGEINT) AS n
    FROM groups JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)
), shares AS (
    SELECT lang, source, term, n, 1 + 1000000000 * (n + 2) //
           (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p
    FROM dense
), whole AS (
    SELECT lang, term, 1 + 1000000000 * (n + 2) //
           (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
    FROM (SELECT lang, term, sum(n) AS n FROM dense GROUP BY lang, term)
), apart AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q)
    FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part
                                 ORDER BY value DESC, encode(item)) AS rank
    FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
""",
    "op12_exact_copies": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM d
""",
    "op13_target_resampling": f"""
WITH s AS (
    {_features("doc_id", "documents")}
), t AS (
    {_features("item_id", "benchmark")}
), known AS (
    SELECT feature, {_crc32("feature")} % 10000 AS bucket
    FROM (SELECT feature FROM s UNION SELECT feature FROM t)
), total AS (
    SELECT (SELECT count(*) FROM s) AS s_all, (SELECT count(*) FROM t) AS t_all
), s_count AS (
    SELECT bucket, count(*) AS s FROM s JOIN known USING (feature) GROUP BY bucket
), t_count AS (
    SELECT bucket, count(*) AS t FROM t JOIN known USING (feature) GROUP BY bucket
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (s_all + 10000.0::DOUBLE)
               / ((coalesce(s, 0) + 1.0::DOUBLE) * (t_all + 10000.0::DOUBLE)))) AS BIGINT) AS gain
    FROM s_count FULL JOIN t_count USING (bucket), total
), summed AS (
    SELECT k AS doc_id, count(*) AS n_features, max(n_words) AS n_words, sum(gain) AS weight
    FROM s JOIN known USING (feature) JOIN gains USING (bucket) GROUP BY k
), noise AS (
    SELECT doc_id, (('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT
                    + 0.5::DOUBLE) / 4294967296 AS u
    FROM documents
), scored AS (
    SELECT n.doc_id, coalesce(n_features, 0) AS n_features, coalesce(n_words, 0) AS n_words,
           CAST(coalesce(weight, 0) AS BIGINT) AS weight,
           CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(u))) AS BIGINT) AS score
    FROM noise n LEFT JOIN summed USING (doc_id)
), drawn AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank
    FROM scored WHERE n_words >= 20
    QUALIFY rank <= 5 * count(*) OVER () // 100
)
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN drawn USING (doc_id)
""",
}
