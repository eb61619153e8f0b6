"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm import (alignment, bpe, decontaminate, licenses, mixing, neardup, periods, quality, simhash, substrings,
                           token_counts, toxicity, warc)
from vaultline.llm.tables import materialize, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


@query("op6_substring_dedup", rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM t)),
again AS (SELECT doc_id, i FROM win SEMI JOIN
          (SELECT h FROM win GROUP BY h HAVING count(*) > 1) r ON win.h = r.h),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM again)),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM t),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS s FROM words ANTI JOIN gone USING (doc_id, p)
         GROUP BY doc_id),
n_gone AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT t.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_gone.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.s, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id) LEFT JOIN n_gone USING (doc_id)
""")
def op6(spark, sf_dir):
    """Words kept and removed by 35-word window dedup, for every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeated_windows(docs, k=35).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SHINGLES_SQL = rf"""
t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 4], ' ')) AS h
       FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) AS i FROM t)),
n AS (SELECT t.doc_id, count(h) AS n FROM t LEFT JOIN sh USING (doc_id) GROUP BY t.doc_id)"""


@query("op10_near_dedup", rf"""
WITH RECURSIVE {SHINGLES_SQL},
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b USING (h)
          WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
          WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, component_id, n.doc_id = component_id AS kept
FROM n JOIN comp USING (doc_id)
""")
def op10(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


@query("op1_quality")
def op1(spark, sf_dir):
    """Quality scores of all documents."""
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op2_toxicity")
def op2(spark, sf_dir):
    """Toxicity scores of all documents."""
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op3_decontaminate", rf"""
WITH {SHINGLES_SQL},
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM benchmark),
ish AS (SELECT DISTINCT item_id, md5(array_to_string(ws[i:i + 4], ' ')) AS h
        FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) AS i FROM items)),
m AS (SELECT item_id, count(*) AS n_item FROM ish GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM sh JOIN ish USING (h) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item::BIGINT AS n_item, n_shared::BIGINT AS n_shared, n_shared / n_item AS containment
FROM shared JOIN m USING (item_id) WHERE 100 * n_shared >= 75 * n_item
""")
def op3(spark, sf_dir):
    """Documents that hold benchmark items, over all documents and items."""
    return decontaminate.contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op5_mix_sources")
def op5(spark, sf_dir):
    """Words that a weighted mixture of all sources takes from each document."""
    return mixing.document_shares(read(spark, sf_dir, "documents"))


@query("op7_simhash")
def op7(spark, sf_dir):
    """Fingerprints of all documents and their edited texts."""
    return simhash.edited_fingerprints(read(spark, sf_dir, "documents"))


@query("op4_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha256(coalesce(html, '')) AS d FROM pages),
s AS (SELECT *, octet_length(encode(h))::BIGINT AS n, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to, NULL::VARCHAR AS error
FROM s
""")
def op4(spark, sf_dir):
    """All pages written to WARC archives and read back."""
    return warc.round_trip(read(spark, sf_dir, "pages"))


@query("op8_license_scan")
def op8(spark, sf_dir):
    """Licences of all pages, their own or inherited."""
    return licenses.scan(read(spark, sf_dir, "pages"))


@query("op9_token_counts")
def op9(spark, sf_dir):
    """Token totals, quantiles and truncated totals of all documents, for every length as a limit."""
    lengths = token_counts.token_lengths(read(spark, sf_dir, "documents"))
    return token_counts.limits(materialize(token_counts.histogram(lengths), "lengths"))


@query("op11_align_tokenizers")
def op11(spark, sf_dir):
    """Byte-level and piece tokens of all documents, aligned and counted over the corpus."""
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return alignment.align(read(spark, sf_dir, "documents"), keep=digest)


@query("op12_bpe")
def op12(spark, sf_dir):
    """All documents encoded by byte-level BPE and decoded again."""
    encoded = bpe.encode(read(spark, sf_dir, "documents"))
    return bpe.decode(encoded).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


def with_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): ``documents``, a tenth of them repeating a stretch of
    their words to the end, as the contract of the query sets out."""
    h = F.crc32(F.col("doc_id").cast("string"))
    planted = h % 10 == 0
    found = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    d = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(planted, found).alias("ws"))
    d = d.withColumn("n", F.size("ws").cast("bigint"))
    d = d.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    d = d.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    words = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda i: F.get("ws", place(i).cast("int")))
    return d.select("doc_id", F.when(F.col("n") > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13(spark, sf_dir):
    """Periodic runs of words of all documents, a tenth of them made periodic."""
    found = periods.periodic_runs(with_periods(read(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = periods.longest("runs")
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
