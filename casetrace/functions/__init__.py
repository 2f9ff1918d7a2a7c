"""Column-level functions: all built on ``pyspark.sql.functions``."""

from casetrace.functions.dates import format_date_text, parse_date
from casetrace.functions.numbers import exact_percent, parse_score
from casetrace.functions.predicates import is_deceased

__all__ = ["parse_date", "format_date_text", "parse_score", "exact_percent",
           "is_deceased"]
