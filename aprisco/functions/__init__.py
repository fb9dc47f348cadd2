from aprisco.functions.calendar import date_dimension
from aprisco.functions.columns import (
    ceil_to_date,
    is_valid_row,
    not_excluded_id,
    not_test_name,
    repair_mojibake,
)
from aprisco.functions.sql import register_functions

__all__ = [
    "ceil_to_date",
    "date_dimension",
    "is_valid_row",
    "not_excluded_id",
    "not_test_name",
    "register_functions",
    "repair_mojibake",
]
