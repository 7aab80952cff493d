"""Joins that stay balanced when one key holds a large part of the rows.

Adaptive execution splits an oversized partition of a sort-merge join by its map outputs, also
when a single key fills it: the rows side of a lookup, the larger side of a
many-to-many join. Inputs are read once and no key has to be counted beforehand.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lookup tables up to this many rows and estimated bytes are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64_000_000

_WIDTHS = {"int": 4, "bigint": 8, "double": 8, "float": 4, "boolean": 1, "date": 4, "timestamp": 8}


def _row_bytes(table: DataFrame) -> int:
    """Bytes of a row of fixed-width columns; texts and the rest are measured by the caller."""
    return sum(_WIDTHS.get(f.dataType.simpleString(), 0) for f in table.schema)


def broadcast_if_small(table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``table`` for broadcast only after measuring that it is small."""
    wide = [f.name for f in table.schema if f.dataType.simpleString() not in _WIDTHS]
    texts = [F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) for c in wide]
    size = sum(texts, F.lit(_row_bytes(table)))
    found = table.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")).first()
    if found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes:
        return F.broadcast(table)
    return table


def lookup_join(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join ``rows`` with a ``table`` that has one row per key; ``rows`` may be skewed."""
    return rows.join(table, list(keys), how)


def fan_out_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner many-to-many join; either side may be skewed."""
    return left.join(right, key)
