"""Spelling variants by a dictionary of trie-node pairs.

The words are the paths of two tries, one of the words and one of the reversed
words. A node of the first is a prefix, one of the second a suffix, and each has
a number of its own. A word of ``L`` code points is the pair (prefix of ``j``, suffix
after ``j``) for every ``j``; leaving out code point ``i`` gives the pair (prefix of ``i``,
suffix after ``i + 1``). So two integers say exactly which words are near:

* two words with the same skipping pair differ in that code point;
* a word whose skipping pair is another word's own pair has one code point more.
  In a run of equal code points only the first is skipped for this, so that a pair of
  words meets once.

Nothing is verified afterwards and no string is compared. A pair of nodes is
shared by at most one word for each letter that can stand in the gap, and one
without it, so its group is bounded by the alphabet. Out of a group comes one row
per word: how many near words it has there and the commonest.

The nodes are numbered in sorted runs: words are sorted by range, and a word takes
over the nodes of the prefix that it shares with the word before and gets new
numbers for the rest. A run's first word continues the run before; these few
nodes (of one word for each run) are renumbered afterwards. Word numbers follow
the order of the words, so ties are settled by number.

Defined results: a null or empty text has no words; documents without an id have
an empty one; rows that repeat an id are documents of their own; words that are
given twice to ``spelling_variants`` are one word with the sum of their counts, null words are left out and null
counts are 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordfold.llm.common import stored, table, text_bytes

MIN_CHARS = 5
MIN_COUNT = 3
#: A form is at least so many times as common as its variant.
TIMES = 2
LETTERS = "a-zÀ-ÿ"
#: The query's contract: one distinct run of a document in so many loses a letter.
GARBLED = 97
#: Different words that a task counts before it lets them go.
HELD = 200_000
#: Bits for the numbers that a sorted run gives out.
_RUN = 40


def letter_runs(docs: DataFrame, min_chars: int = MIN_CHARS, garbled: int | None = None) -> DataFrame:
    """``word, n``: lower-cased (A-Z) runs of letters in ``docs`` (``doc_id, text``) with at least
    ``min_chars`` code points, counted. With ``garbled``, a run whose CRC-32 (of id, colon and run)
    it divides loses the code point at CRC modulo length."""
    slim = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_bytes())
    pattern = f"[{LETTERS}]{{{min_chars},}}"

    def batch(total: Counter) -> pa.RecordBatch:
        words = pa.array(total.keys(), pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        find, crc32 = re.compile(pattern).findall, zlib.crc32
        for b in batches:
            for doc, text in zip(b.column(0), b.column(1)):
                found = Counter(find(text.as_py().lower().decode("utf-8", "replace")))
                if garbled is not None:
                    start = crc32(f"{doc.as_py()}:".encode())
                    for w in [w for w in found if crc32(w.encode(), start) % garbled == 0]:
                        at = crc32(w.encode(), start) % len(w)
                        n = found.pop(w)
                        if len(w) > min_chars:
                            total[w[:at] + w[at + 1 :]] += n
                total.update(found)
                if len(total) > HELD:
                    yield batch(total)
                    total = Counter()
        if total:
            yield batch(total)

    return slim.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def trie_nodes(words: DataFrame, key: str) -> DataFrame:
    """``words`` with ``at``, a number in the order of ``key``, and ``nodes``, the numbers of the trie nodes of the
    prefixes of 1, 2 ... code points of ``key`` (distinct strings). ``words`` should be a stored table."""
    kept = [c for c in words.columns if c != key]
    kinds = ", ".join(f"{c} {words.schema[c].dataType.simpleString()}" for c in [*kept, key])
    ranged = words.repartitionByRange(key).sortWithinPartitions(key).select(F.spark_partition_id().alias("run"), *kept, key)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own, nodes, row = "", 0, [], 0
        for b in batches:
            if not b.num_rows:
                continue
            base = b.column(0)[0].as_py() << _RUN
            every = []
            for w in b.column(b.num_columns - 1).to_pylist():
                same, most = 0, min(len(w), len(last))
                while same < most and w[same] == last[same]:
                    same += 1
                new = len(w) - same
                nodes = nodes[:same] + list(range(base + own, base + own + new))
                own, last = own + new, w
                every.append(nodes)
            places = pa.array(range(base + row, base + row + len(every)), pa.int64())
            row += len(every)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, places, pa.array(every, pa.list_(pa.int64()))], names=[*b.schema.names, "at", "nodes"]
            )

    numbered = stored(ranged.mapInArrow(number, f"run int, {kinds}, at bigint, nodes array<bigint>"), "variants-trie")
    # the first and the last word of each sorted run: as many rows as tasks
    ends = numbered.groupBy("run").agg(F.min(key).alias("first"), F.max(F.struct(key, "nodes")).alias("last")).collect()
    carried, word, nodes = [], "", []
    for e in sorted(ends, key=lambda r: r.run):
        same = 0
        while same < min(len(word), len(e.first)) and word[same] == e.first[same]:
            same += 1
        carry, base = nodes[:same], e.run << _RUN
        carried.append((e.run, carry))
        word = e.last[0]
        nodes = [carry[x - base] if x - base < same else x for x in e.last[1]]
    carries = words.sparkSession.createDataFrame(carried, "_run int, carry array<bigint>")
    own = "x - shiftleft(CAST(run AS BIGINT), {})".format(_RUN)
    settled = F.expr(f"IF(size(carry) = 0, nodes, transform(nodes, x -> IF({own} < size(carry), carry[CAST({own} AS INT)], x)))")
    joined = numbered.join(F.broadcast(carries), F.col("run") == F.col("_run"))
    return joined.select(*words.columns, "at", settled.alias("nodes"))


def node_pairs(words: DataFrame) -> DataFrame:
    """``p, s, kind, id, n``: the node pairs of all words, by kind: 0 a code point is skipped, 1 the same and it is
    the first of its run of equal ones, 2 nothing is skipped. ``words`` is ``id, word, n, fore, back``."""
    f, r, last = "concat(array(-1L), fore)", "concat(array(-1L), back)", "size(fore)"
    full = words.selectExpr("id", "n", f"{f} AS f", f"{r} AS r", f"{last} AS k", "split(word, '') AS c")
    skips = "transform(slice(sequence(0, k), 1, k), i -> struct(f[i] AS p, r[k - 1 - i] AS s, IF(i = 0 OR c[i] <> c[greatest(i - 1, 0)], 1, 0) AS kind))"
    whole = "transform(sequence(0, k), i -> struct(f[i] AS p, r[k - i] AS s, 2 AS kind))"
    each = full.select("id", "n", F.explode(F.expr(f"concat({skips}, {whole})")).alias("x"))
    return each.select("x.p", "x.s", "x.kind", "id", "n")


def near_words(pairs: DataFrame) -> DataFrame:
    """``id, n_near, best_n, best_id``: how many near words a word has (words with none have no row),
    and the commonest, of equal ones the one with the smallest number."""
    members = F.collect_list(F.struct("kind", "id", "n")).alias("m")  # at most one a letter, and one
    groups = pairs.groupBy("p", "s").agg(members).where("size(m) > 1")
    # two skip the same place, or the first skips what the second does not have
    meet = "(x.kind < 2 AND y.kind < 2 OR x.kind = 1 AND y.kind = 2 OR x.kind = 2 AND y.kind = 1)"
    near = f"filter(m, y -> y.id <> x.id AND {meet})"
    one = f"transform(m, x -> struct(x.id AS id, {near} AS o))"
    each = groups.select(F.explode(F.expr(one)).alias("x")).where("size(x.o) > 0")
    each = each.selectExpr("x.id", "CAST(size(x.o) AS BIGINT) AS k", "array_max(transform(x.o, y -> struct(y.n AS n, -y.id AS id))) AS best")
    found = each.groupBy("id").agg(F.sum("k").alias("n_near"), F.max("best").alias("best"))
    return found.selectExpr("id", "n_near", "best.n AS best_n", "-best.id AS best_id")


def last_forms(forms: DataFrame) -> DataFrame:
    """``id, root`` from ``id, form``: where following the forms ends, by pointer doubling. Counts at least
    double with each form, so a path has at most 63 steps and is followed in 6 rounds."""
    state = forms.select("id", F.col("form").alias("root"))
    while True:
        state = stored(state, "variants-roots")
        on = state.select(F.col("id").alias("_id"), F.col("root").alias("_root"))
        step = state.join(on, F.col("root") == F.col("_id"), "left")
        if step.where("_id IS NOT NULL").isEmpty():
            return state
        state = step.select("id", F.coalesce("_root", "root").alias("root"))


def spelling_variants(words: DataFrame, min_count: int = MIN_COUNT, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the distinct words of ``words`` (``word, n``) that occur
    at least ``min_count`` times. ``form`` is the commonest word at one inserted, deleted or replaced code point, if
    it is at least ``times`` as common; ``root`` is the end of the forms from the word on."""
    if times < 2:
        raise ValueError("forms must be at least twice as common, so that following them ends")
    counts = words.where("word IS NOT NULL").groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"))
    known = stored(counts.where(F.col("n") >= min_count), "variants-words")
    fore = stored(trie_nodes(known, "word").withColumnsRenamed({"at": "id", "nodes": "fore"}), "variants-fore")
    turned = stored(fore.select("id", F.reverse("word").alias("drow")), "variants-turned")
    back = trie_nodes(turned, "drow").select(F.col("id").alias("_id"), F.col("nodes").alias("back"))
    back = stored(back, "variants-back")
    pairs = node_pairs(fore.join(back, F.col("id") == F.col("_id")).drop("_id"))
    near = stored(near_words(pairs), "variants-near").withColumnRenamed("id", "_id")
    dictionary = fore.select("id", "word", "n")
    found = dictionary.join(near, F.col("id") == F.col("_id"), "left")
    has = F.col("best_n") >= times * F.col("n")
    found = found.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(has, F.col("best_id")).alias("form"), F.when(has, F.col("best_n")).alias("form_n"),
    )
    found = stored(found, "variants-forms")
    roots = last_forms(found.where("form IS NOT NULL").select("id", "form"))
    roots = roots.select(F.col("id").alias("_id"), F.col("root").alias("_root"))
    linked = found.join(roots, F.col("id") == F.col("_id"), "left").drop("_id")
    named = lambda n: found.select(F.col("id").alias(f"_{n}_id"), F.col("word").alias(f"_{n}_word"))
    linked = linked.join(named("f"), F.col("form") == F.col("_f_id"), "left")
    linked = linked.join(named("r"), F.col("_root") == F.col("_r_id"), "left")
    return linked.select("word", F.col("_f_word").alias("form"), F.coalesce("_r_word", "word").alias("root"), "n", "n_near", "form_n")


def q_variants(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return spelling_variants(letter_runs(docs, garbled=GARBLED))
