"""Column expressions shared by the operators."""

from panelspan.functions.columns import (
    as_number,
    as_period,
    column,
    is_blank,
    quoted,
    text,
    trimmed,
)

__all__ = ["as_number", "as_period", "column", "is_blank", "quoted", "text", "trimmed"]
