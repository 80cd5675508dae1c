"""Operators: DataFrame -> DataFrame functions built from Spark expressions."""

from wordfold.operators.ints import count_rows, even_count, even_rows, int_sum, int_sum_wrap32
from wordfold.operators.listing import key_facts, list_children, path_exists, path_key, path_status
from wordfold.operators.words import (
    DEFAULT_K,
    count_word,
    report,
    sum_pairs,
    tokenize,
    top_words,
    word_count,
    word_pairs,
)

__all__ = [
    "count_rows",
    "even_count",
    "even_rows",
    "int_sum",
    "int_sum_wrap32",
    "key_facts",
    "list_children",
    "path_exists",
    "path_key",
    "path_status",
    "DEFAULT_K",
    "count_word",
    "report",
    "sum_pairs",
    "tokenize",
    "top_words",
    "word_count",
    "word_pairs",
]
