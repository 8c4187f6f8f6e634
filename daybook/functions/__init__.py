"""Column expressions and checks used by the operators."""

from daybook.functions.days import parse_day
from daybook.functions.names import require_columns
from daybook.functions.predicates import any_null, none_null, rows_differ

__all__ = ["any_null", "none_null", "parse_day", "require_columns", "rows_differ"]
