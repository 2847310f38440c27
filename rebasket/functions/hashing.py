"""Row hashes that order rows at random, but the same way on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(seed: int, key: Sequence[str]) -> Column:
    """A 32-digit hex hash of the seed and the key columns.

    Different keys never read alike: separators in a value are escaped, and a
    null is told apart from every text.
    """

    def written(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")), F.lit("\\N"))

    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[written(c) for c in key]))
