"""Sources: text lines, integers, object-key inventories, object-store options."""

from wordfold.sources.ints import int_column, ints_from_list
from wordfold.sources.inventory import keys_from_files, keys_from_urls, object_inventory
from wordfold.sources.object_store import as_spark_conf, s3a_options
from wordfold.sources.text import lines_from_column, read_text_lines, union_all

__all__ = [
    "int_column",
    "ints_from_list",
    "keys_from_files",
    "keys_from_urls",
    "object_inventory",
    "as_spark_conf",
    "s3a_options",
    "lines_from_column",
    "read_text_lines",
    "union_all",
]
