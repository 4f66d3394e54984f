"""Row ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def new_id(ts: Column, *keys: Column) -> Column:
    """26 characters of base 32 (0-9, A-V): 10 of time, so that ids sort by time, and 16 (80 bits) of a key hash.

    Equal time and keys give equal ids, so a replay does.
    """
    digest = F.sha2(F.concat_ws("\u0001", *[k.cast("string") for k in keys]), 256)

    def base32(number: Column, base: int, width: int) -> Column:
        return F.lpad(F.conv(number, base, 32), width, "0")

    halves = [base32(F.substring(digest, start, 10), 16, 8) for start in (1, 11)]
    return F.concat(base32(F.unix_millis(ts).cast("string"), 10, 10), *halves)
