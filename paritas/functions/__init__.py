from .values import (JSON_OPTIONS, SENTINEL, all_of, any_of, cell_text, common_type, comparable,
                     differs, exact_type, fingerprint, in_common, lossless_text, number_text,
                     own_text, sentinel_text, struct_array)

__all__ = ["JSON_OPTIONS", "SENTINEL", "all_of", "any_of", "cell_text", "common_type",
           "comparable", "differs", "exact_type", "fingerprint", "in_common", "lossless_text",
           "number_text", "own_text", "sentinel_text", "struct_array"]
