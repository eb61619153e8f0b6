"""Exact token counts: a histogram of encoded lengths answers every context limit.

Each document is encoded once; equal lengths are added up before the shuffle,
so what follows works on one row per distinct length. Suffix sums over the
lengths give, for a limit L: the documents and tokens of length L or more, the
tokens that remain when every document is cut at L, and the share of documents
that fit. Sums run inside buckets of lengths with the buckets' own sums added,
so no task holds all lengths.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.tables import column_named

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the pattern that this public vocabulary was made with
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LENGTHS_PER_BUCKET = 1024
# white space as the pattern's \\s takes it; the library's matcher fails on runs of some 100 000 of it
LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{5000,}")

_encodings: dict[str, object] = {}


def encoding(path: str):
    """The encoding of a rank file, loaded once per process."""
    if path not in _encodings:
        import tiktoken
        with open(path, "rb") as fh:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, fh)}
        _encodings[path] = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def encoded(text: str, own) -> list[int]:
    """Token ids of a text under the encoding ``own``.

    Long runs of white space are cut off first, where the pattern cuts too:
    what precedes a run is not changed by it, a run before other characters is
    one piece without its last character, which starts what follows, and a run
    at the end is one piece.
    """
    out, at = [], 0
    for run in LONG_RUN.finditer(text):
        last = run.end() - (run.end() < len(text))
        out += own.encode_ordinary(text[at:run.start()])
        out += own._encode_single_piece(text[run.start():last].encode())
        at = last
    return out + own.encode_ordinary(text[at:]) if at else own.encode_ordinary(text)


def n_tokens(text: str, path: str = RANKS) -> int:
    return len(encoded(text, encoding(path)))


def _lengths(path: str):
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "n_tokens": pa.array(
                [n_tokens(t, path) if t else 0 for t in batch["text"].to_pylist()], pa.int64())})
    return lengths


def token_lengths(docs: DataFrame, ranks: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every row; special tokens' strings are ordinary
    text, null and empty texts have 0 tokens. Other columns are not read."""
    return docs.select(column_named(docs, id_col).cast("bigint").alias("doc_id"),
                       column_named(docs, text_col).cast("string").alias("text")).mapInArrow(
        _lengths(ranks), "doc_id bigint, n_tokens bigint")


def histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, docs): one row per distinct length."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def limits(hist: DataFrame) -> DataFrame:
    """For each length of ``hist`` taken as a context limit: n_tokens, docs,
    docs_over (longer than the limit), tokens_within (of documents that fit),
    truncated_tokens (every document cut at the limit), total_tokens, and
    quantile (share of documents that fit). An empty histogram gives no rows."""
    h = hist.withColumn("bucket", F.floor(F.col("n_tokens") / LENGTHS_PER_BUCKET)).withColumn(
        "tokens", F.col("n_tokens") * F.col("docs"))
    sums = h.groupBy("bucket").agg(F.sum("docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    after = Window.partitionBy(F.lit(0)).orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    zero = F.lit(0)
    sums = sums.select("bucket", F.coalesce(F.sum("b_docs").over(after), zero).alias("a_docs"),
                       F.coalesce(F.sum("b_tokens").over(after), zero).alias("a_tokens"),
                       F.sum("b_docs").over(every).alias("all_docs"), F.sum("b_tokens").over(every).alias("total_tokens"))
    inside = Window.partitionBy("bucket").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    h = h.withColumn("i_docs", F.coalesce(F.sum("docs").over(inside), zero)) \
        .withColumn("i_tokens", F.coalesce(F.sum("tokens").over(inside), zero)).join(sums, "bucket")
    over, over_tokens = F.col("a_docs") + F.col("i_docs"), F.col("a_tokens") + F.col("i_tokens")
    return h.select("n_tokens", "docs", over.alias("docs_over"), (F.col("total_tokens") - over_tokens).alias("tokens_within"),
                    (F.col("total_tokens") - over_tokens + over * F.col("n_tokens")).alias("truncated_tokens"),
                    "total_tokens", ((F.col("all_docs") - over) / F.col("all_docs")).alias("quantile"))


def quantile(answers: DataFrame, q: float) -> int | None:
    """The smallest length that at least the share ``q`` of documents fit into."""
    return answers.filter(F.col("quantile") >= q).agg(F.min("n_tokens")).first()[0]


def truncated_total(answers: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut at ``limit``, any whole number:
    lengths are linear in the limit between two neighbouring lengths."""
    at = answers.filter(F.col("n_tokens") <= limit).agg(
        F.max_by(F.struct("truncated_tokens", "docs_over", "n_tokens"), "n_tokens").alias("a")).first()["a"]
    if at is not None:
        return at["truncated_tokens"] + at["docs_over"] * (limit - at["n_tokens"])
    n = answers.agg(F.max(F.col("docs_over") + F.col("docs"))).first()[0] or 0
    return n * limit
