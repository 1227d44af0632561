from yearloom.functions.columns import (
    clean_key,
    date_from_parts,
    safe_double,
    two_digits,
    year_from_filename,
)

__all__ = ["clean_key", "date_from_parts", "safe_double", "two_digits", "year_from_filename"]
