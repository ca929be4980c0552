"""Column references by exact name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_ref(name: str) -> Column:
    """The column called ``name`` — dots or spaces in a landed header are part of the name, not
    struct access."""
    return F.col("`" + name.replace("`", "``") + "`")
