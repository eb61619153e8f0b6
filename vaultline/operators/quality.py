"""Data-quality checks the source schema enforces but the warehouse does not
(Q1-Q5). Each check is one pass over its input; results are small frames
(violations or one row per checked column)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def duplicate_keys(df: DataFrame, cols) -> DataFrame:
    """Q1: key values occurring more than once, with their count. The count
    aggregates map-side, so a hot key is collapsed before the shuffle."""
    cols = _as_list(cols)
    return df.groupBy(*cols).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def unique_violations(checks: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Q1 over several (table_name, frame, column) pairs: one row per
    duplicated value as (table_name, column_name, value, n)."""
    out = None
    for table, df, col in checks:
        d = (duplicate_keys(df.select(col), col)
             .select(F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
                     F.col(col).cast("string").alias("value"), "n"))
        out = d if out is None else out.unionByName(d)
    return out


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str,
            child_key: str | None = None, relation: str | None = None) -> DataFrame:
    """Q2: child rows whose non-NULL foreign key has no parent (left anti
    join; AQE broadcasts the parent keys only when they are measured small)."""
    parent_keys = parent.select(F.col(pk).alias("__pk"))
    c = child.filter(F.col(fk).isNotNull())
    out = c.join(parent_keys, c[fk] == parent_keys["__pk"], "left_anti")
    cols = [F.lit(relation or f"{fk}->{pk}").alias("relation")]
    if child_key:
        cols.append(F.col(child_key).cast("long").alias("child_id"))
    cols.append(F.col(fk).cast("long").alias("fk_value"))
    return out.select(*cols)


def orphans_many(child: DataFrame, child_key: str,
                 checks: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """Q2 for several foreign keys of one child table in a single scan of the
    child: each (relation, fk, parent, pk) becomes a flag from a left join to
    the parent's distinct keys (broadcast by AQE when measured small); a
    child row yields one output row per violated key."""
    d = child.select(child_key, *{fk for _, fk, _, _ in checks})
    flags = []
    for i, (relation, fk, parent, pk) in enumerate(checks):
        keys = parent.select(F.col(pk).alias(f"__pk{i}")).distinct() \
            .withColumn(f"__hit{i}", F.lit(True))
        d = d.join(keys, d[fk] == keys[f"__pk{i}"], "left").drop(f"__pk{i}")
        flags.append(F.when(F.col(fk).isNotNull() & F.col(f"__hit{i}").isNull(),
                            F.struct(F.lit(relation).alias("relation"),
                                     F.col(fk).cast("long").alias("fk_value"))))
    out = d.select(F.col(child_key).cast("long").alias("child_id"),
                   F.explode(F.filter(F.array(*flags), lambda x: x.isNotNull())).alias("v"))
    return out.select("v.relation", "child_id", "v.fk_value")


def null_counts(df: DataFrame, table: str, cols: Iterable[str] | None = None,
                not_null: Iterable[str] = ()) -> DataFrame:
    """Q3: NULL count per column in one aggregate pass, unpivoted to
    (table_name, column_name, null_count, violation); ``violation`` is true
    for a column declared NOT NULL that has NULLs."""
    cols = list(cols or df.columns)
    not_null = set(not_null)
    agg = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(c)
                   for c in cols])
    long = agg.unpivot([], cols, "column_name", "null_count")
    return long.select(
        F.lit(table).alias("table_name"), "column_name",
        F.coalesce(F.col("null_count"), F.lit(0).cast("long")).alias("null_count"),
        (F.col("column_name").isin(list(not_null)) & (F.col("null_count") > 0)).alias("violation"))


def domain_violations(df: DataFrame, table: str, domains, allowed: Sequence[str] | None = None
                      ) -> DataFrame:
    """Q4: values outside their enum domain, with counts, for one or more
    columns of a table in a single scan (``domains`` maps column -> allowed
    values; or pass one column name and ``allowed``). NULLs are a NOT NULL
    matter and are counted by ``null_counts``."""
    if isinstance(domains, str):
        domains = {domains: allowed}
    cols = list(domains)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot([], cols, "column_name", "value")
    bad = None
    for c, ok in domains.items():
        cond = (F.col("column_name") == c) & ~F.col("value").isin(list(ok))
        bad = cond if bad is None else bad | cond
    return (long.filter(F.col("value").isNotNull() & bad)
                .groupBy("column_name", "value").agg(F.count("*").alias("n"))
                .select(F.lit(table).alias("table_name"), "column_name", "value", "n"))


def length_violations(df: DataFrame, table: str, spec: dict[str, tuple[str, int]]) -> DataFrame:
    """Q5: fixed/max length and numeric precision checks in one pass.

    ``spec`` maps a column to ``("eq", n)`` (CHAR(n)), ``("max", n)``
    (VARCHAR(n)) or ``("int_digits", n)`` (NUMERIC(p, s) with n = p - s
    integer digits). Output: (table_name, column_name, rule, n_violations),
    one row per rule, zeros included.
    """
    aggs = []
    names = []
    for col, (rule, n) in spec.items():
        c = F.col(col)
        if rule == "eq":
            bad = F.length(c) != n
        elif rule == "max":
            bad = F.length(c) > n
        elif rule == "int_digits":
            bad = F.abs(c.cast("double")) >= F.lit(10.0 ** n)
        else:
            raise ValueError(f"unknown rule {rule!r}")
        name = f"{col}|{rule}:{n}"
        names.append(name)
        aggs.append(F.sum(F.when(bad, 1).otherwise(0)).cast("long").alias(name))
    long = df.agg(*aggs).unpivot([], names, "check", "n_violations")
    parts = F.split(F.col("check"), r"\|")
    return long.select(F.lit(table).alias("table_name"), parts[0].alias("column_name"),
                       parts[1].alias("rule"),
                       F.coalesce(F.col("n_violations"), F.lit(0).cast("long"))
                       .alias("n_violations"))
