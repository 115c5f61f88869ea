"""Assignment of rows to shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def shard_of(key: Sequence[Column], shards: int) -> Column:
    """Shard 1..``shards`` from the md5 of the key's text; NULL for a NULL key.

    md5 rather than a Spark hash: the number can be recomputed by any other
    system that sees the key.
    """
    text = key[0].cast("string")
    for part in key[1:]:
        text = F.concat(text, F.lit("|"), part.cast("string"))
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return head % F.lit(shards) + F.lit(1)
