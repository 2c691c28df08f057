"""How amino-acid columns are read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def residues(column: Column | str) -> Column:
    """``column`` upper-cased with everything but A-Z dropped; null where nothing is left."""
    return F.nullif(F.regexp_replace(F.upper(column), "[^A-Z]+", ""), F.lit(""))
