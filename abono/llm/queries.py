"""Registered queries of the text operators, and their SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abono.llm import (
    crosstoken, decontaminate, jaccard, licenses, pieces, quality, repeats, secrets, spelling, spotsigs, toxicity, urls, warc)
from abono.llm.labelled import remainder
from abono.llm.store import new_folder


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    scored = toxicity.toxicity(docs, labels, allowed=remainder("doc_id", 5) != 0)
    return scored.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_segments", "best_start", "best_end", "log_p")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")
    return decontaminate.leaks_digest(decontaminate.find_leaks(docs, items))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(_read(spark, sf_dir, "pages"))


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.next_digest(spotsigs.compared_to_next(_read(spark, sf_dir, "documents")))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_digest(repeats.remove_repeats(_read(spark, sf_dir, "documents"), keep_first=False))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    scored = quality.quality(docs, labels, allowed=remainder("doc_id", 3) != 1)
    return scored.select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: Model of the registered queries; it must be on the driver.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_read(spark, sf_dir, "documents"), model=MODEL)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_digest(secrets.find_secrets(_read(spark, sf_dir, "documents")))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses_digest(licenses.scan_licenses(_read(spark, sf_dir, "documents")))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write_warc(_read(spark, sf_dir, "pages"), path)
    return warc.pages_digest(spark, path)


#: Models that the query compares; they must be on the driver.
BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"


def op12_crosstoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = crosstoken.Models.read(BYTE_MODEL, MODEL)
    return crosstoken.groups_digest(crosstoken.aligned(_read(spark, sf_dir, "documents"), models))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_read(spark, sf_dir, "documents"), params=spelling.Params(noise=31))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_decontaminate": op2_decontaminate,
    "op3_url_filter": op3_url_filter,
    "op4_spotsigs": op4_spotsigs,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_quality": op6_quality,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_secrets": op8_secrets,
    "op9_ngram_join": op9_ngram_join,
    "op10_licenses": op10_licenses,
    "op11_warc": op11_warc,
    "op12_crosstoken": op12_crosstoken,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {
    "op2_decontaminate": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
              FROM benchmark WHERE item_id IS NOT NULL),
        bi AS (SELECT item, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0),
        bw AS (SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS t, least(len(w), 10) AS m FROM bi),
        sizes AS (SELECT DISTINCT m FROM bw),
        di AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m),
        hits AS (SELECT doc_id, i, m, item FROM (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS t FROM di) x JOIN bw USING (t, m)),
        marked AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM hits) GROUP BY doc_id),
        named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(marked.n, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(named.s, '')) AS items_sha256,
               coalesce(marked.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op5_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        p AS (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 199)) AS i FROM d WHERE len(x) >= 400),
        w AS (SELECT doc_id, i, hash(substr(x, 2 * i + 1, 400)) AS h FROM p),
        r AS (SELECT doc_id, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
        l AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM r),
        s AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM l),
        m AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM s GROUP BY doc_id, g),
        e AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept_from FROM m),
        k AS (SELECT doc_id, count(*) AS n, sum(b - a) AS removed, max(b) AS last,
              string_agg(substr(x, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS kept FROM e JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
               CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
               sha256(unhex(CASE WHEN n IS NULL THEN x ELSE kept || substr(x, 2 * last + 1) END)) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)""",
    "op9_ngram_join": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE
              list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS g FROM d WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)),
        l AS (SELECT a AS u, b AS v FROM e UNION SELECT b, a FROM e),
        r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT l.v, r.c FROM r JOIN l ON l.u = r.doc_id)
        SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, CAST(coalesce(c, d.doc_id) AS BIGINT) AS component_id
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) USING (doc_id)""",
    "op11_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS x FROM pages),
        h AS (SELECT page_id, CAST(strlen(x) AS BIGINT) AS n, sha1(x) AS s FROM p),
        d AS (SELECT page_id, n, translate(array_to_string(list_transform(range(0, 8),
              lambda i: to_base(CAST('0x' || substr(s, 5 * i + 1, 5) AS BIGINT), 32, 4)), ''),
              '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS k FROM h),
        f AS (SELECT k, max(page_id) AS top FROM d GROUP BY k)
        SELECT page_id, n AS payload_bytes, k AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to
        FROM d JOIN f USING (k)""",
}
