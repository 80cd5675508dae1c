"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces.

A paragraph is a line; it is cut into pieces at sentence ends, and every
``PIECE`` code points where a sentence is longer. A section is a run of paragraphs
that ends after an empty line or after a paragraph whose own hash says so (one in
four), so that an edit moves no section border but those next to it. A node's hash is the MD5 of its
children's hashes, a piece's that of its text; the root is the SHA-256 of the sections' hashes.

* Equal texts have equal roots, and different texts different ones.
* ``tree_edits`` goes down where two trees differ: equal roots end it, equal
  sections are passed over, and the paragraphs that only one side has are the edits.
* A fingerprint is the root and the first hex digits of the leaves, in the tree's
  order; ``likeness`` compares two fingerprints by the distinct leaves they share.

All of it is SQL expressions over one row per document. ``with_next`` gives each
document the one after it in descending order of ids without a global window: the
ids are cut into ranges by bounds that are themselves documents, a range is a
window partition, and a range's first document is also sent to the range before,
as its last row. Rows are told apart by id and hash of the text, so a third of
rows without an id is still cut into ranges.

Defined results: a null text is empty, with one paragraph and no pieces; two
fingerprints without pieces are alike (1), one with and one without are not (0);
null ids come last in the order; rows that share an id follow each other by the
hash of their texts, and rows that share both stand together in one range; a single document is
its own next one; an empty table gives no rows; other columns are ignored
(``with_next`` keeps them).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordfold.llm.common import stored, table

PIECE = 96
#: Hex digits of a leaf in a fingerprint.
LEAF = 8
#: A paragraph whose hash begins with a lesser hex digit ends its section.
SECTION_END = "4"

_SPACE = r"[\x20\x09-\x0D]"
_PATTERN = rf"[^.!?]{{1,{PIECE}}}+[.!?]*+{_SPACE}*+|[.!?]++{_SPACE}*+".replace("\\", "\\\\")


def _steps(text: str, p: str) -> list[dict[str, str]]:
    """SQL of a tree's columns, named with ``p`` before them, each step over those before it."""
    sections = f"transform(sequence(0, size({p}ends) - 1), j -> slice({{}}, {p}begin + 1, {p}ends[j] - {p}begin + 1))"
    begin = f"IF(j = 0, 0, {p}ends[greatest(j - 1, 0)] + 1)"
    of = lambda what: sections.replace(f"{p}begin", begin).format(what)
    return [
        {f"{p}lines": f"split({text}, '\\n', -1)"},
        {f"{p}leaves": f"transform({p}lines, l -> transform(regexp_extract_all(l, '{_PATTERN}', 0), x -> md5(x)))"},
        {f"{p}paragraphs": f"transform({p}leaves, h -> md5(concat('p', array_join(h, ''))))"},
        {
            f"{p}ends": f"filter(sequence(0, size({p}paragraphs) - 1), i -> i = size({p}paragraphs) - 1 "
            f"OR {p}lines[i] = '' OR substring({p}paragraphs[i], 1, 1) < '{SECTION_END}')"
        },
        {
            f"{p}sections": f"transform({of(f'{p}paragraphs')}, s -> md5(concat('s', array_join(s, ''))))",
            f"{p}shape": f"array_join(transform({of(f'{p}leaves')}, s -> array_join(transform(s, h -> "
            f"array_join(transform(h, x -> substring(x, 1, {LEAF})), '')), ',')), ';')",
        },
        {f"{p}root": f"sha2(concat('r', array_join({p}sections, '')), 256)"},
    ]


def with_fingerprint(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` and the fingerprint of its (not null) column ``text`` as column ``name``."""
    p, kept = f"_{name}_", [F.col(c) for c in docs.columns if c != name]
    for step in _steps(text, p):
        docs = docs.withColumns({k: F.expr(v) for k, v in step.items()})
    return docs.select(*kept, F.concat(f"{p}root", F.lit(":"), f"{p}shape").alias(name))


def likeness(a: str, b: str) -> Column:
    """The share of distinct leaves that two fingerprints have in common: twice the shared ones by all."""
    leaves = lambda c: f"array_distinct(regexp_extract_all(substring_index({c}, ':', -1), '[0-9a-f]{{{LEAF}}}', 0))"
    both = f"size(array_intersect(x.a, x.b)) * 2.0D / (size(x.a) + size(x.b))"
    one = f"transform(array(struct({leaves(a)} AS a, {leaves(b)} AS b)), x -> IF(size(x.a) + size(x.b) = 0, 1.0D, {both}))"
    return F.expr(f"element_at({one}, 1)")


def document_trees(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, root, sections`` of ``docs`` (``doc_id, text``). A section is its ``hash`` and its
    ``paragraphs``: ``hash, place`` (its number in the text), ``first`` (code point) and ``n_chars``."""
    df = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for step in _steps("text", "")[:5]:
        df = df.withColumns({k: F.expr(v) for k, v in step.items()})
    # where each line begins, filled in parts so that appending stays cheap for very many lines
    none, parts = "CAST(array() AS array<bigint>)", "CAST(array() AS array<array<bigint>>)"
    starts = (
        f"aggregate(lines, named_struct('at', 0L, 'full', {parts}, 'part', {none}), (a, l) -> named_struct('at', a.at + length(l) + 1, "
        f"'full', IF(size(a.part) < 256, a.full, concat(a.full, array(a.part))), "
        f"'part', concat(IF(size(a.part) < 256, a.part, {none}), array(a.at))), a -> concat(flatten(a.full), a.part))"
    )
    begin = "IF(j = 0, 0, ends[greatest(j - 1, 0)] + 1)"
    inside = "struct(paragraphs[i] AS hash, i AS place, starts[i] AS first, length(lines[i]) AS n_chars)"
    sections = f"transform(sections, (h, j) -> struct(h AS hash, transform(sequence({begin}, ends[j]), i -> {inside}) AS paragraphs))"
    df = df.withColumn("starts", F.expr(starts)).withColumn("root", F.expr("sha2(concat('r', array_join(sections, '')), 256)"))
    return df.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), "root", F.expr(sections).alias("sections"))


def tree_edits(old: DataFrame, new: DataFrame) -> DataFrame:
    """``doc_id, change, place, first, n_chars``: the paragraphs that only one version of a document has,
    ``removed`` (places in the old text) or ``added`` (places in the new one). ``old`` and ``new`` are
    ``doc_id, text`` with unique ids; documents that only one of them has are left out."""
    a, b = (document_trees(x).select("doc_id", "root", F.col("sections").alias("s")) for x in (old, new))
    b = b.select(F.col("doc_id").alias("_id"), F.col("root").alias("_root"), F.col("s").alias("_s"))
    differ = a.join(b, a.doc_id.eqNullSafe(F.col("_id"))).where("root <> _root")
    # down to the paragraphs of sections that the other side does not have
    less = lambda x, y: f"flatten(transform(filter({x}, c -> NOT array_contains({y}.hash, c.hash)), c -> c.paragraphs))"
    differ = differ.select("doc_id", F.expr(less("s", "_s")).alias("x"), F.expr(less("_s", "s")).alias("y"))
    only = lambda x, y: f"filter({x}, c -> NOT array_contains({y}.hash, c.hash))"
    tagged = lambda x, y, what: f"transform({only(x, y)}, c -> struct('{what}' AS change, c.place, c.first, c.n_chars))"
    each = differ.select("doc_id", F.explode(F.expr(f"concat({tagged('x', 'y', 'removed')}, {tagged('y', 'x', 'added')})")).alias("e"))
    return each.select("doc_id", "e.change", "e.place", "e.first", "e.n_chars")


def with_next(docs: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``docs`` (``doc_id, text``, not null text) and, for each ``new: old`` of ``columns``, the value of column
    ``old`` of the next document in descending order of ids as ``new``; the first document follows the last."""
    spark = docs.sparkSession
    key = "struct(doc_id IS NOT NULL AS known, doc_id AS id, xxhash64(text) AS h)"
    keys = stored(docs.select(F.expr(key).alias("key")), "merkle-keys")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = keys.repartitionByRange(parts, F.desc("key")).groupBy(F.spark_partition_id()).agg(F.max("key").alias("key"))
    # one row for each range, its first document
    bounds = ranges.agg(F.to_json(F.reverse(F.sort_array(F.collect_list("key"))))).first()[0]
    n = len(json.loads(bounds))
    kind = keys.schema["key"].dataType.simpleString()
    listed = F.from_json(F.lit(bounds), f"array<{kind}>")
    # binary search: the last bound that does not come after the row
    step = "lo + CAST(shiftleft(1, e) AS INT)"
    at = f"aggregate(sequence({max(n - 1, 1).bit_length()}, 0, -1), 0, (lo, e) -> IF({step} < {n} AND _key <= _bounds[least({step}, {n - 1})], {step}, lo))"
    placed = docs.withColumns({"_key": F.expr(key), "_bounds": listed}).withColumn("_at", F.expr(at))
    both = f"IF(_key = _bounds[_at], array(struct(_at AS part, false AS ghost), struct((_at + {n - 1}) % {max(n, 1)} AS part, true AS ghost)), array(struct(_at AS part, false AS ghost)))"
    sent = placed.withColumn("_to", F.explode(F.expr(both))).withColumn("_part", F.col("_to.part")).withColumn("_ghost", F.col("_to.ghost"))
    sent = sent.select(*docs.columns, "_key", "_part", "_ghost")
    w = Window.partitionBy("_part").orderBy("_ghost", F.desc("_key"))
    led = sent.withColumns({new: F.lead(old).over(w) for new, old in columns.items()})
    return led.where("NOT _ghost").drop("_key", "_part", "_ghost")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """``doc_id, text, fingerprint, next_fingerprint, edited``: each text, and the same with its last half replaced by
    the beginning of the next document."""
    slim = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_fingerprint(slim, "text", "fingerprint")
    rows = with_next(rows, {"next_text": "text", "next_fingerprint": "fingerprint"})
    half = "CAST(length(text) DIV 2 AS INT)"
    edited = f"concat(left(text, length(text) - {half}), left(next_text, {half}))"
    return rows.withColumn("edited", F.expr(edited)).drop("next_text")


def q_fingerprints(spark, sf_dir):
    rows = with_fingerprint(edited_pairs(table(spark, sf_dir, "documents")), "edited", "edited_fingerprint")
    return rows.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
