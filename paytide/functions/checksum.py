"""Checksums of sets of rows that add up.

Every row is hashed whole, twice, and the hashes are summed. The sum does not depend on the order of rows or on how
they lie in files, the sum over two parts is the sum of their sums, and what was moved can be subtracted. A lost row, a
doubled row and a changed value each change it; sums of ids combined by XOR would not notice a row that is there twice.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SALTS = (1, 2)
# Hashes of 19 digits; a sum of a DECIMAL(28) has room for 1e19 of them.
HASH, SUM = "decimal(28,0)", "decimal(38,0)"


def row_hashes(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a whole row. Which values are null is hashed as well: nulls alone leave a hash as it is."""
    absent = sum((F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(columns)), F.lit(0))
    return [F.xxhash64(F.lit(salt), absent, *columns).cast(HASH) for salt in SALTS]


def checksum(columns: list[str], where: Column | None = None) -> Column:
    """Aggregate: the two sums as text, of all rows or of those that fulfil a condition."""
    hashes = row_hashes(columns) if where is None else [F.when(where, h) for h in row_hashes(columns)]
    return F.concat_ws(":", *[F.coalesce(F.sum(h), F.lit(0).cast(SUM)) for h in hashes])


def difference(whole: str, part: str) -> str:
    """The checksum of what is left of a set of rows without a part of it."""
    return ":".join(str(int(a) - int(b)) for a, b in zip(whole.split(":"), part.split(":")))


def total(checksums: list[str]) -> str:
    """The checksum of several sets of rows together."""
    pairs = [[int(x) for x in c.split(":")] for c in checksums]
    return ":".join(str(sum(p[i] for p in pairs)) for i in range(len(SALTS)))
