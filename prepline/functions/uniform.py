"""Random numbers that depend on the row's key and nothing else.

``rand(seed)`` changes with the partitioning; a hash of the key does not, so a
split or an imputed value survives a re-run, a lost executor and a new layout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 8  # hexadecimal digits of the hash that are used: 32 bits


def keyed_uniform(key: str | Column, seed: int | str, salt: str) -> Column:
    """Uniform draw in [0, 1) for a row, fixed by seed, salt and key."""
    key = F.col(key) if isinstance(key, str) else key
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(salt), key.cast("string"))
    head = F.substring(F.md5(text), 1, _DIGITS)
    return F.conv(head, 16, 10).cast("double") / F.lit(float(16**_DIGITS))
