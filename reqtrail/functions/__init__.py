from reqtrail.functions.headers import clean_headers, clean_name, rename_positional
from reqtrail.functions.nulls import fill_columns, fill_timestamp, is_missing, text_or_empty, ts_literal
from reqtrail.functions.text import decode, fmt, matches_from_start, strip_ws

__all__ = ["clean_headers", "clean_name", "rename_positional", "fill_columns", "fill_timestamp",
           "is_missing", "text_or_empty", "ts_literal", "decode", "fmt", "matches_from_start", "strip_ws"]
