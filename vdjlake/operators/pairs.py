"""Heavy and light records of one cell brought together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vdjlake.schema import UNIT_KEY


def repair_pairs(df: DataFrame, columns: Sequence[str], unit: Sequence[str] = UNIT_KEY, index: str = "index_in_unit") -> DataFrame:
    """A row for each heavy and light record with the same ``index`` in a unit: columns suffixed _heavy and _light.

    Records delivered more than once pair with each of their partners. Rows of other chains, or with a null in the
    key, pair with nothing. The key holds the record's index, so no unit is a hot key.
    """
    keys = [*unit, index]
    side = lambda chain: df.filter(F.col("chain") == chain).select(*keys, *(F.col(c).alias(f"{c}_{chain}") for c in columns))
    return side("heavy").join(side("light"), keys)
