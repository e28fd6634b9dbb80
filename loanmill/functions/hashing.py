"""Row fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fingerprint(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 over the values, each with its length in front.

    Lengths keep neighbouring values and NULLs apart (`hash(NULL, 'a')` would equal `hash('a', NULL)`);
    timestamps go in as microseconds.
    """
    types = dict(df.dtypes)
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    parts = []
    for name in columns:
        value = F.col(name)
        if types[name].startswith("timestamp"):
            value = F.timestamp_diff("MICROSECOND", epoch, value)
        text = value.cast("string")
        parts += [F.coalesce(F.octet_length(text).cast("string"), F.lit("-")), F.coalesce(text, F.lit(""))]
    return F.sha2(F.concat_ws(":", *parts), 256)
