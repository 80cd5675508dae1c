"""Registered queries over the driver's tables, each with an equivalent DuckDB SQL.

Every query reads whole tables (no id subsets, no row caps); the only limit is
the top-k of the ranked report, which is the feature itself.

Inputs used: ``documents.text`` (its languages stand in for separate text
files, English and not), ``part.p_size`` and an int derived from ``lineitem.l_orderkey`` for the
integer jobs, ``pages.url`` (scheme removed) as object keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordfold.operators import (
    count_word,
    even_count,
    even_rows,
    int_sum,
    int_sum_wrap32,
    list_children,
    path_status,
    report,
    sum_pairs,
    tokenize,
    top_words,
    word_count,
    word_pairs,
)
from wordfold.plans.jobs import top_words_of_lines
from wordfold.session import new_output_path
from wordfold.sinks.text import write_text
from wordfold.sources.tables import read_table
from wordfold.sources import (
    int_column,
    keys_from_urls,
    lines_from_column,
    read_text_lines,
    union_all,
)

Query = Callable[[SparkSession, str], DataFrame]


# --- building blocks over the driver tables ---------------------------------

def is_english():
    """Splits the table into two inputs that cover it (a null language is not English)."""
    return F.coalesce(F.col("lang") == "en", F.lit(False))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, lang, line``: every line of every document."""
    return lines_from_column(documents(spark, sf_dir), "text", keep=("doc_id", "lang"))


def doc_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize(doc_lines(spark, sf_dir), line_col="line")


def doc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(doc_words(spark, sf_dir))


def wrap_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``x int`` values that overflow a 32-bit sum: (orderkey mod 1000) * 2,000,000."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(((F.col("l_orderkey") % 1000) * 2000000).cast("int").alias("x"))


def page_inventory(spark: SparkSession, sf_dir: str, dedupe: bool = True) -> DataFrame:
    """Pages as an object inventory. The listing and status operators fold
    repeated keys themselves, so they read it with ``dedupe=False``."""
    return keys_from_urls(read_table(spark, sf_dir, "pages"), dedupe=dedupe)


def page_manifest(inv: DataFrame) -> DataFrame:
    """Keys to ask about: every key, each first component (with and without a
    trailing ``/``), each key + ``.missing``, and the root ``''``.

    One pass: each inventory row is exploded into its five candidate keys and
    the candidates are deduplicated (partial aggregate before the shuffle; the
    output is hash-partitioned on ``key``, the join key of ``path_status``).
    """
    k = F.col("key")
    first = F.substring_index(k, "/", 1)
    candidates = F.array(k, first, F.concat(first, F.lit("/")), F.concat(k, F.lit(".missing")), F.substring(k, 1, 0))
    return inv.select(F.explode(candidates).alias("key")).distinct()


# --- the registered queries --------------------------------------------------


def q_local_ints(spark, sf_dir):
    return int_column(read_table(spark, sf_dir, "part"), "p_size")


def q_int_sum(spark, sf_dir):
    return int_sum(int_column(read_table(spark, sf_dir, "part"), "p_size"))


def q_int_sum_wrap32(spark, sf_dir):
    return int_sum_wrap32(wrap_ints(spark, sf_dir))


def q_even_rows(spark, sf_dir):
    return even_rows(read_table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_size")


def q_even_count(spark, sf_dir):
    return even_count(int_column(read_table(spark, sf_dir, "part"), "p_size"))


def q_text_lines(spark, sf_dir):
    return doc_lines(spark, sf_dir).select("doc_id", "line")


def q_line_union_all(spark, sf_dir):
    """Bag union of two inputs: the English documents' lines and those of all others."""
    docs = documents(spark, sf_dir)
    return union_all(
        lines_from_column(docs.where(is_english()), "text"),
        lines_from_column(docs.where(~is_english()), "text"),
    )


def q_tokenize(spark, sf_dir):
    return doc_words(spark, sf_dir)


def q_word_pairs(spark, sf_dir):
    return word_pairs(doc_words(spark, sf_dir))


def q_word_count(spark, sf_dir):
    return doc_counts(spark, sf_dir)


def q_pair_word_count(spark, sf_dir):
    """The pair form: (word, 1) pairs reduced by a keyed sum; same counts as word_count."""
    return sum_pairs(word_pairs(doc_words(spark, sf_dir)))


def q_count_word(spark, sf_dir):
    return count_word(doc_counts(spark, sf_dir))


def q_top_words(spark, sf_dir):
    return top_words(doc_counts(spark, sf_dir))


def q_top_words_report(spark, sf_dir):
    return report(top_words(doc_counts(spark, sf_dir)))


def q_report_roundtrip(spark, sf_dir):
    """Write the report with the text sink under the shared folder, read it back."""
    path = write_text(q_top_words_report(spark, sf_dir), new_output_path(spark, "top-words-report"))
    return spark.read.text(path)


# (application, table folder) -> the text files written from it, one set per application
_EXPORTS: dict[tuple[str, str], list[str]] = {}


def export_doc_texts(spark: SparkSession, sf_dir: str) -> list[str]:
    """Write the documents' texts as two text-file sets in the shared folder, the English
    ones and all others, once per application and table folder. Returns the two folders.

    Each text becomes its lines followed by one LF, so the files hold, per
    document, the lines of ``text + LF``.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _EXPORTS:
        docs = documents(spark, sf_dir)
        _EXPORTS[key] = [
            write_text(docs.where(part).select("text"), new_output_path(spark, f"documents-{name}"))
            for name, part in (("en", is_english()), ("other", ~is_english()))
        ]
    return _EXPORTS[key]


def text_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference job's input shape: two text-file sources read as lines and united;
    here the English documents and all others, written by Spark."""
    return read_text_lines(spark, export_doc_texts(spark, sf_dir))


def q_file_lines(spark, sf_dir):
    return text_file_lines(spark, sf_dir)


def q_file_top_words_report(spark, sf_dir):
    """The whole job: text files -> union -> words -> counts -> top 100 -> report."""
    return report(top_words_of_lines(text_file_lines(spark, sf_dir)))


def q_key_inventory(spark, sf_dir):
    return page_inventory(spark, sf_dir)


def q_list_children(spark, sf_dir):
    return list_children(page_inventory(spark, sf_dir, dedupe=False), "")


def q_list_children_dir(spark, sf_dir):
    """The listing of one directory below the root: the first host that is not a key itself."""
    inv = page_inventory(spark, sf_dir, dedupe=False)
    hosts = inv.groupBy(F.substring_index("key", "/", 1).alias("host")).agg(
        F.bool_or(F.col("key") == F.substring_index("key", "/", 1)).alias("is_key")
    )
    return list_children(inv, hosts.where("NOT is_key").agg(F.min("host")).first()[0] or "")


def q_list_children_file(spark, sf_dir):
    """The listing of a path that is a file: the first plain key."""
    inv = page_inventory(spark, sf_dir, dedupe=False)
    plain = inv.where("key <> '' AND NOT endswith(key, '/') AND NOT contains(key, '//') AND NOT startswith(key, '/')")
    return list_children(inv, plain.agg(F.min("key")).first()[0] or "")


def q_path_status(spark, sf_dir):
    inv = page_inventory(spark, sf_dir, dedupe=False)
    # The manifest is deduplicated, so no key repeats and there is no hot key to split.
    return path_status(page_manifest(inv), inv, split_hot_keys=False).select("key", "status", "length")


def q_page_status(spark, sf_dir):
    """Status per page row of its own key and of its host: a manifest whose keys
    repeat (one host per many pages). Every host with a hundredth of the rows is
    taken as hot, from all rows, so the hot-key split is in use."""
    pages = read_table(spark, sf_dir, "pages")
    key = F.regexp_replace("url", "^https?://", "")
    manifest = pages.select("page_id", F.explode(F.array(key, F.substring_index(key, "/", 1))).alias("key"))
    return path_status(manifest, keys_from_urls(pages, dedupe=False), hot_share=0.01, hot_sample_fraction=1.0).select("page_id", "key", "status", "length")


QUERIES: dict[str, Query] = {
    "local_ints": q_local_ints,
    "int_sum": q_int_sum,
    "int_sum_wrap32": q_int_sum_wrap32,
    "even_rows": q_even_rows,
    "even_count": q_even_count,
    "text_lines": q_text_lines,
    "line_union_all": q_line_union_all,
    "tokenize": q_tokenize,
    "word_pairs": q_word_pairs,
    "word_count": q_word_count,
    "pair_word_count": q_pair_word_count,
    "count_word": q_count_word,
    "top_words": q_top_words,
    "top_words_report": q_top_words_report,
    "report_roundtrip": q_report_roundtrip,
    "file_lines": q_file_lines,
    "file_top_words_report": q_file_top_words_report,
    "key_inventory": q_key_inventory,
    "list_children": q_list_children,
    "list_children_dir": q_list_children_dir,
    "list_children_file": q_list_children_file,
    "path_status": q_path_status,
    "page_status": q_page_status,
}


# --- DuckDB oracle SQL -------------------------------------------------------
# Written independently of the DataFrame code, in DuckDB's dialect.

_LINES = (
    r"SELECT doc_id, lang, unnest(string_split_regex("
    r"regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n')) AS line "
    r"FROM documents WHERE text <> ''"
)
_WORDS = (
    "SELECT unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN [] "
    "ELSE string_split(rtrim(line, ' '), ' ') END) AS word FROM (" + _LINES + ")"
)
_COUNTS = "SELECT word, count(*) AS n FROM (" + _WORDS + ") GROUP BY word"
_TOP = "SELECT n, word FROM (" + _COUNTS + ") ORDER BY n DESC, word LIMIT 100"
_REPORT = "SELECT concat(CAST(n AS VARCHAR), ' ', word) AS value FROM (" + _TOP + ") ORDER BY n DESC, word"
# Lines of the documents written as text files: each text followed by one LF.
_FILE_LINES = (
    r"SELECT unnest(string_split_regex(regexp_replace(text || chr(10), '(\r\n|\r|\n)\z', ''), "
    r"'\r\n|\r|\n')) AS value FROM documents"
)
_FILE_WORDS = (
    "SELECT unnest(CASE WHEN value = '' THEN [''] WHEN rtrim(value, ' ') = '' THEN [] "
    "ELSE string_split(rtrim(value, ' '), ' ') END) AS word FROM (" + _FILE_LINES + ")"
)
_FILE_REPORT = (
    "SELECT concat(CAST(n AS VARCHAR), ' ', word) AS value FROM (SELECT word, count(*) AS n FROM ("
    + _FILE_WORDS + ") GROUP BY word ORDER BY n DESC, word LIMIT 100)"
)
_INV = (
    "SELECT regexp_replace(url, '^https?://', '') AS key, max(CAST(length(html) AS BIGINT)) AS size "
    "FROM pages GROUP BY 1"
)

# Children of the directory given by {dir}, whose keys start with {prefix}.
_CHILDREN = (
    "WITH inv AS (" + _INV + "), dir AS ({dir}), below AS ("
    "SELECT {prefix} AS prefix, substr(key, length({prefix}) + 1) AS rest, size FROM inv, dir WHERE starts_with(key, {prefix})) "
    "SELECT name, is_dir, CASE WHEN is_dir THEN CAST(0 AS BIGINT) ELSE max(size) END AS length, any_value(prefix) || name AS key FROM ("
    "SELECT prefix, split_part(rest, '/', 1) AS name, instr(rest, '/') > 0 AS is_dir, size FROM below "
    "WHERE NOT (instr(rest, '/') = 0 AND right(rest, 9) = '_$folder$')"
    ") WHERE name <> '' GROUP BY name, is_dir"
)

# Status of every manifest row ({man}), first match wins; {cols} are the output keys.
_STATUS = (
    "WITH inv AS (" + _INV + "), man AS ({man}) "
    "SELECT {cols}, CASE "
    "WHEN m.key <> '' AND x.key IS NOT NULL THEN "
    "  CASE WHEN right(m.key, 1) = '/' AND x.size = 0 THEN 'empty_dir' ELSE 'file' END "
    "WHEN m.key <> '' AND right(m.key, 1) <> '/' AND k.key IS NOT NULL THEN "
    "  CASE WHEN k.size = 0 THEN 'empty_dir' ELSE 'file' END "
    "WHEN EXISTS (SELECT 1 FROM inv i WHERE starts_with(i.key, "
    "  CASE WHEN m.key = '' OR right(m.key, 1) = '/' THEN m.key ELSE m.key || '/' END)) THEN 'dir' "
    "ELSE 'missing' END AS status, "
    "CASE WHEN m.key <> '' AND x.key IS NOT NULL THEN "
    "  CASE WHEN right(m.key, 1) = '/' AND x.size = 0 THEN NULL ELSE x.size END "
    "WHEN m.key <> '' AND right(m.key, 1) <> '/' AND k.key IS NOT NULL AND k.size <> 0 THEN k.size "
    "END AS length "
    "FROM man m LEFT JOIN inv x ON x.key = m.key "
    "LEFT JOIN inv k ON k.key = m.key || '/' AND m.key <> '' AND right(m.key, 1) <> '/'"
)

ORACLE_SQL: dict[str, str] = {
    "local_ints": "SELECT CAST(p_size AS INTEGER) AS x FROM part",
    "int_sum": "SELECT CAST(sum(p_size) AS BIGINT) AS total FROM part",
    "int_sum_wrap32": (
        "SELECT CAST(((sum(x) + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648 AS INTEGER)"
        " AS total FROM (SELECT CAST((l_orderkey % 1000) * 2000000 AS INTEGER) AS x FROM lineitem)"
    ),
    "even_rows": "SELECT p_partkey, p_size FROM part WHERE p_size % 2 = 0",
    "even_count": "SELECT count(*) AS n FROM part WHERE p_size % 2 = 0",
    "text_lines": "SELECT doc_id, line FROM (" + _LINES + ")",
    "line_union_all": (
        "SELECT line FROM (" + _LINES + ") WHERE lang = 'en' UNION ALL "
        "SELECT line FROM (" + _LINES + ") WHERE lang IS DISTINCT FROM 'en'"
    ),
    "tokenize": "SELECT word FROM (" + _WORDS + ")",
    "word_pairs": "SELECT word, 1 AS one FROM (" + _WORDS + ")",
    "word_count": _COUNTS,
    "pair_word_count": "SELECT word, CAST(sum(one) AS BIGINT) AS n FROM (SELECT word, 1 AS one FROM (" + _WORDS + ")) GROUP BY word",
    "count_word": "SELECT n, word FROM (" + _COUNTS + ")",
    "top_words": _TOP,
    "top_words_report": _REPORT,
    "report_roundtrip": _REPORT,
    "file_lines": _FILE_LINES,
    "file_top_words_report": _FILE_REPORT,
    "key_inventory": _INV,
    "list_children": _CHILDREN.format(dir="SELECT '' AS d", prefix="''"),
    "list_children_dir": _CHILDREN.format(
        dir="SELECT min(split_part(key, '/', 1)) AS d FROM inv WHERE split_part(key, '/', 1) NOT IN (SELECT key FROM inv)",
        prefix="d || '/'",
    ),
    "list_children_file": (
        "WITH inv AS (" + _INV + ") SELECT split_part(key, '/', -1) AS name, false AS is_dir, size AS length, key FROM inv "
        "WHERE key = (SELECT min(key) FROM inv WHERE key <> '' AND right(key, 1) <> '/' AND instr(key, '//') = 0 AND left(key, 1) <> '/')"
    ),
    "path_status": _STATUS.format(
        cols="m.key AS key",
        man="SELECT key FROM inv UNION SELECT split_part(key, '/', 1) FROM inv "
        "UNION SELECT split_part(key, '/', 1) || '/' FROM inv UNION SELECT key || '.missing' FROM inv "
        "UNION SELECT '' FROM inv",
    ),
    "page_status": _STATUS.format(
        cols="m.page_id AS page_id, m.key AS key",
        man="SELECT page_id, regexp_replace(url, '^https?://', '') AS key FROM pages UNION ALL "
        "SELECT page_id, split_part(regexp_replace(url, '^https?://', ''), '/', 1) FROM pages",
    ),
}
