"""K1-K3: text sinks in the ``key,value`` line format of the original jobs.

Typed results stay typed; rendering to text happens only here.  The default
save mode ``errorifexists`` refuses to replace an existing result, like the
original jobs; ``mode='overwrite'`` replaces it (the removal step of the
run scripts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def render_lines(df: DataFrame, cols: list[str] | None = None, sep: str = ",") -> DataFrame:
    """``value string`` lines joining the columns with ``sep``; arrays are
    joined with ``sep`` as well."""
    cols = cols or df.columns
    parts = []
    for c in cols:
        dt = df.schema[c].dataType.simpleString()
        if dt.startswith("array"):
            parts.append(F.array_join(F.col(c).cast("array<string>"), sep))
        else:
            parts.append(F.col(c).cast("string"))
    return df.select(F.concat_ws(sep, *parts).alias("value"))


def write_lines(df: DataFrame, path: str, cols: list[str] | None = None, sep: str = ",",
                mode: str = "errorifexists", sort_by: list[str] | None = None) -> None:
    """K1 (``cols`` = key and value) and K2 (``cols`` = the value only).
    ``sort_by`` sorts every output file by those columns, like the
    per-reducer key order of a MapReduce job (no global sort, no extra
    shuffle)."""
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    render_lines(df, cols, sep).write.mode(mode).text(path)
