"""Column expressions (built-in Spark functions only, no UDFs)."""

from wordfold.functions.ints import is_even, sum_wrap32
from wordfold.functions.text import report_line, split_lines, split_words

__all__ = ["is_even", "sum_wrap32", "report_line", "split_lines", "split_words"]
