from .fixtures import (ENROLL_COLUMNS, ENROLL_COMPARE, ENROLL_OUTPUT, LINE_KEYS, LINE_OUTPUT,
                       WIDE_COMPARE, WIDE_MADE, enroll_pair, feed_pair, line_pair, mixed_type_pair,
                       typed_pair, wide_pair)
from .tables import as_dataframe, preview_files, read_table, sample_rows

__all__ = ["ENROLL_COLUMNS", "ENROLL_COMPARE", "ENROLL_OUTPUT", "LINE_KEYS", "LINE_OUTPUT",
           "WIDE_COMPARE", "WIDE_MADE", "as_dataframe", "enroll_pair", "feed_pair", "line_pair",
           "mixed_type_pair", "preview_files", "read_table", "sample_rows", "typed_pair", "wide_pair"]
