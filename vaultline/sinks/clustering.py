"""Range clustering of a table's files (SNK4): rows that are near in several
keys share files, so a read by any of the keys skips most files by their
footer statistics.

Each key is cut at quantiles of the staged rows; the bits of the two (or more)
ranks are interleaved into one curve value, and rows are dealt to files by
ranges of that value. The quantiles and the ranges come from a staging copy
that has been written already, so the plan behind the rows runs once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6                       # ranks of a key: 2 ** BITS
ROWS_PER_FILE = 2_000_000


def rank_of(col: str, splits: list) -> Column:
    """Number of ``splits`` (sorted) that are not above the value, by binary
    search in an array of literals; 0 for NULL."""
    if not splits:
        return F.lit(0)
    steps = 1 << len(splits).bit_length()
    every = F.array(*[F.lit(s) for s in splits])
    halves = F.array(*[F.lit(steps >> i) for i in range(1, steps.bit_length())])
    return F.aggregate(halves, F.lit(0), lambda at, step: F.when(
        F.coalesce(F.get(every, at + step - 1) <= F.col(col), F.lit(False)), at + step).otherwise(at))


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the ranks in turn, highest first."""
    out = F.lit(0).cast("long")
    for b in reversed(range(bits)):
        for r in ranks:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(r, b).bitwiseAND(F.lit(1)))
    return out


def clustered(staged: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = (),
              rows_per_file: int = ROWS_PER_FILE, bits: int = BITS) -> DataFrame:
    """``staged`` in files of about ``rows_per_file`` rows: ranges of the
    interleaved keys, inside each value of ``partition_by``. ``staged`` should
    be a written copy, as it is read for its quantiles and its ranges too."""
    at = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = staged.agg(F.count(F.lit(1)).alias("n"), *[
        F.percentile_approx(k, at, 20 << bits).alias(f"q{i}") for i, k in enumerate(keys)]).first()
    files = max(1, -(-cuts["n"] // rows_per_file))
    ranks = [rank_of(k, sorted(set(cuts[f"q{i}"] or []))) for i, k in enumerate(keys)]
    d = staged.withColumn("__z", interleaved(ranks, bits))
    order = [*partition_by, "__z", *keys]
    return d.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("__z")
