"""Column-expression helpers (all JVM-side built-ins, no Python UDFs).

Timestamps in the warehouse are TIMESTAMP_NTZ (wall-clock UTC); the helpers
below do epoch arithmetic with ``timestampadd``/``timestampdiff`` so results
do not depend on the session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal from a string or datetime."""
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def load_ts(ts=None) -> Column:
    """Load-time column: the injected ``ts`` if given, else the current
    wall-clock time (``localtimestamp`` is NTZ in the session zone)."""
    return ntz(ts) if ts is not None else F.localtimestamp()


def with_load_ts(df: DataFrame, name: str = "loaded_at", ts=None) -> DataFrame:
    """SNK8: add a load-time column (``extracted_at``/``ingested_at``/``loaded_at``)."""
    return df.withColumn(name, load_ts(ts))


def epoch_millis(col) -> Column:
    """Milliseconds since the epoch of an NTZ timestamp."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH), c)


def epoch_micros(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), c)


def from_epoch_millis(col) -> Column:
    """NTZ timestamp from epoch milliseconds (time-zone independent)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MILLISECOND", c, F.expr(EPOCH))


def trunc_millis(col) -> Column:
    """Truncate an NTZ timestamp to milliseconds (DateTime64(3) semantics)."""
    return from_epoch_millis(epoch_millis(col))


def month_of(col) -> Column:
    """yyyyMM as an int (monthly partition key)."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.year(c) * 100 + F.month(c)).cast("int")


def flags_to_int(df: DataFrame, cols) -> DataFrame:
    """Booleans to 0/1 ints at the warehouse boundary (NULL stays NULL)."""
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("int"))
    return df


def parse_ts_best_effort(col) -> Column:
    """Best-effort text to NTZ timestamp in UTC. Taken: ISO 8601 with ``T`` or
    space and an optional ``Z`` (or ``z``) or offset (+hh:mm, +hhmm, +hh), which
    is taken off; ``yyyymmdd`` and ``yyyymmddhhmmss``; seconds (9 or 10 digits)
    and milliseconds (13 digits) since the epoch. Anything else (including ''
    and zone names) becomes NULL. Without patterns: one cast per value, to an
    instant where the text names an offset, else to local time."""
    c = F.upper(F.trim(F.col(col) if isinstance(col, str) else col))
    size = F.length(c)
    digits = F.translate(c, "0123456789", "") == ""
    allowed = F.translate(c, "0123456789T :.-+Z", "") == ""
    zoned = (F.substring(c, 5, 1) == "-") & (c.endswith("Z") | (F.locate("+", c, 11) > 0) | (F.locate("-", c, 11) > 0))
    part = lambda a, n: F.substring(c, a, n)                                     # noqa: E731
    day = F.concat_ws("-", part(1, 4), part(5, 2), part(7, 2))
    second = F.concat(day, F.lit(" "), F.concat_ws(":", part(9, 2), part(11, 2), part(13, 2)))
    number = c.try_cast("long")
    plain = F.when(~digits | (size == 4), c).when(size == 8, day).when(size == 14, second)
    return (F.when(~allowed, F.lit(None).cast("timestamp_ntz"))
            .when(zoned, F.timestamp_add("MICROSECOND", F.unix_micros(c.try_cast("timestamp")), F.expr(EPOCH)))
            .when(digits & size.isin(9, 10), from_epoch_millis(number * 1000))
            .when(digits & (size == 13), from_epoch_millis(number))
            .otherwise(plain.try_cast("timestamp_ntz")))


def hash_key(*cols) -> Column:
    """Deterministic surrogate key: md5 of the '|'-joined text of the parts
    (identical in any engine with md5 and integer text)."""
    return F.md5(F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string")
                                   for c in cols]))

