"""Column-level building blocks (built-in expressions only)."""

from strata.functions.casts import cast_columns, lenient_bigint, lenient_cast
from strata.functions.dates import (date_from_parts, date_parts, date_range, day_slice,
                                    parse_date, partition_predicate, partition_range_predicate)

__all__ = ["cast_columns", "lenient_bigint", "lenient_cast", "date_from_parts", "date_parts",
           "date_range", "day_slice", "parse_date", "partition_predicate",
           "partition_range_predicate"]
