"""Result presentation for oracle comparison (tests and registered queries only).

Doubles are quantised to ~1e-6: ``round(x * Q, 6) / Q`` with an irrational
``Q``.  Plain ``round(x, 6)`` puts its rounding boundaries on short decimals,
and this data (2-decimal prices, integer sizes) produces exact 7th-decimal
ties all the time, so two engines summing in a different order would round a
tie in different directions.  Scaling by an irrational constant moves the
boundaries off the decimal grid; both engines perform the same IEEE multiply
and divide, so equal inputs still give equal outputs.  ``+ 0.0`` folds -0.0
into 0.0.  Selected small-scale columns are scaled by 1e6 first so rounding
does not blank them; timestamps are emitted zone-less, as DuckDB returns them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6
# Quantisation constant (1/sqrt(2)); must equal oracle.sql.QUANT.
QUANT = 0.7071067811865476


def present(df: DataFrame, scaled: tuple[str, ...] = ()) -> DataFrame:
    cols = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            if field.name in scaled:
                c = c * F.lit(1e6)
            c = F.round(c * F.lit(QUANT), DIGITS) / F.lit(QUANT) + F.lit(0.0)
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.FloatType):
            c = F.round(c.cast("double") * F.lit(QUANT), DIGITS) / F.lit(QUANT) + F.lit(0.0)
        cols.append(c.alias(field.name))
    return df.select(*cols)
