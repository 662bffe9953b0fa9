"""Word count.

Tokens follow the single-space rule of ``functions.strings.space_tokens``;
case, tabs and punctuation are kept.  ``groupBy().count()`` plans a partial
aggregate before the exchange (the map-side combine of the reference), so a
very frequent word costs one row per partition in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplekit.functions.strings import space_tokens


def word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """``value string`` lines -> ``word string, n long``."""
    return (lines.select(F.explode(space_tokens(col)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
