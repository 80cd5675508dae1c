"""wordfold: text-word and integer analytics and object-key inventory queries on Spark DataFrames.

Every operator is a DataFrame -> DataFrame function built from Spark's own
expressions; see README.md for the operator map and the plans they produce.
"""

from wordfold.operators import (
    count_word,
    even_count,
    even_rows,
    int_sum,
    int_sum_wrap32,
    list_children,
    path_exists,
    path_status,
    report,
    sum_pairs,
    tokenize,
    top_words,
    word_count,
    word_pairs,
)
from wordfold.sinks import write_text
from wordfold.sources import (
    int_column,
    ints_from_list,
    keys_from_files,
    keys_from_urls,
    lines_from_column,
    object_inventory,
    read_text_lines,
    s3a_options,
    union_all,
)

__version__ = "0.1.0"

__all__ = [
    "count_word",
    "even_count",
    "even_rows",
    "int_sum",
    "int_sum_wrap32",
    "list_children",
    "path_exists",
    "path_status",
    "report",
    "sum_pairs",
    "tokenize",
    "top_words",
    "word_count",
    "word_pairs",
    "write_text",
    "int_column",
    "ints_from_list",
    "keys_from_files",
    "keys_from_urls",
    "lines_from_column",
    "object_inventory",
    "read_text_lines",
    "s3a_options",
    "union_all",
]
