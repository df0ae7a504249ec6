"""Column expressions: number parsing, domain rules, keyed hashing."""

from sparkrisk.functions.expressions import (
    as_text, column_type, ident, is_dirty, is_legal, number_or_null, numeric_columns, present, to_number,
)
from sparkrisk.functions.hashing import order_key, uniform

__all__ = [
    "as_text", "column_type", "ident", "is_dirty", "is_legal", "number_or_null",
    "numeric_columns", "order_key", "present", "to_number", "uniform",
]
