"""Personal-data column classification: share of non-NULL values of each string column matching a
pattern, in ONE aggregate over all string columns (partial counts merged map-side)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The e-mail pattern of the assertions, anchored for fields and unanchored for text.
EMAIL_FIELD = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
EMAIL_TEXT = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
EMAIL_TAG = "PersonalData.Email"


def classify_columns(df: DataFrame, table_name: str, pattern: str = EMAIL_FIELD, tag: str = EMAIL_TAG,
                     threshold: float = 0.5) -> DataFrame:
    """``(table_name, column_name, non_null, matches, match_share, tag)`` per string column."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"n{i}"), F.count_if(F.col(c).rlike(pattern)).alias(f"m{i}")]
    stacked = ", ".join(f"'{c}', n{i}, m{i}" for i, c in enumerate(cols))
    out = df.agg(*aggs).select(F.expr(f"stack({len(cols)}, {stacked}) as (column_name, non_null, matches)"))
    share = F.when(F.col("non_null") > 0, F.col("matches") / F.col("non_null"))
    return out.select(F.lit(table_name).alias("table_name"), "column_name", "non_null", "matches",
                      share.alias("match_share"),
                      F.when(share >= threshold, F.lit(tag)).alias("tag"))
