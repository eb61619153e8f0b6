"""Corpus pipeline over ``documents``: filter, deduplicate, decontaminate, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's input. All stages but the last
return the columns of ``documents``; the last one gives, for every document
that is left, the words that the mixture takes from it.
"""

from __future__ import annotations

from vaultline.llm import decontaminate, mixing, neardup, substrings, toxicity
from vaultline.llm.tables import materialize, read

# the stages learn and hash: SQL cannot express them
ORACLE_SQL = None


def drop_toxic(spark, docs, sf_dir):
    """Rejects documents that the toxicity classifier predicts toxic."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark, docs, sf_dir):
    """Keeps one document of each near-duplicate component."""
    return neardup.keep_one(docs)


def cut_repeated_passages(spark, docs, sf_dir):
    """Takes repeated 35-word windows out of the texts."""
    return substrings.without_repeats(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Rejects documents that hold a benchmark item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    """Words that the weighted mixture takes from each document."""
    return mixing.document_shares(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]


def run(spark, sf_dir):
    """All stages over the documents table; each is materialised for the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
