"""Column casts that keep the silver layer's lenient semantics under ANSI mode.

Spark 4 runs with ANSI on, where a bad string makes ``cast`` raise. Silver needs the lenient
behaviour (bad text becomes NULL), so every cast here is a ``try_cast`` — except string→bigint,
where the lenient cast also truncates decimal text ('1.5' → 1, '-1.9' → -1, '.5' → 0). All of
this stays inside built-in expressions (whole-stage codegen), no UDFs, and the session-wide ANSI
flag is never touched.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Edge characters the lenient integer cast trims, and the text shapes it accepts.
# ``\z`` (not ``$``) anchors at the true end: Java's ``$`` also matches before a trailing line
# terminator such as U+0085, which the cast does not trim.
_EDGE_WS = r"^[\x00-\x20\x7f]+|[\x00-\x20\x7f]+\z"
_DECIMAL_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]*)\z"
_INTEGER_PART = r"^([+-]?[0-9]+)"


def lenient_bigint(c: Column) -> Column:
    """String → bigint like the non-ANSI cast: trims control/space, truncates a decimal part,
    out-of-range or non-numeric text → NULL."""
    t = F.regexp_replace(c, _EDGE_WS, "")
    whole = F.coalesce(F.nullif(F.regexp_extract(t, _INTEGER_PART, 1), F.lit("")), F.lit("0"))
    return F.when(t.rlike(_DECIMAL_TEXT), whole.try_cast("bigint"))


def lenient_cast(c: Column, source: T.DataType, target: str) -> Column:
    """Cast that returns NULL for bad input instead of failing."""
    if target == "bigint" and isinstance(source, T.StringType):
        return lenient_bigint(c)
    return c.try_cast(target)


def cast_columns(df, casts: dict[str, str]):
    """Apply ``casts`` to the columns of ``df`` that exist (absent ones are skipped)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    from strata.functions.columns import col_ref
    present = {name: lenient_cast(col_ref(name), types[name], target).alias(name)
               for name, target in casts.items() if name in types}
    return df.withColumns(present) if present else df
