"""Mixing sources to target weights.

Words of each source are packed, document after document, into blocks of
``BLOCK`` words. A source whose target is ``t`` words fills ``t`` words' worth of
block-sized slots. How many of them each output shard gets is a multinomial
draw over the shards, seeded by the source, so every shard is a random mix by
the target weights while each source's total stays at its target. A slot's
number is mapped through the source's pseudorandom permutation of its block
numbers (one permutation per pass over the source), and slots and blocks are
joined by source and block number: ``mix`` gives the words of every slot.

Documents lie in hash order within buckets of a source, about ``BUCKET_WORDS``
words each; a bucket's last block is short. So a source with most of the rows is
packed in many tasks, and the layout is the same in every run. The texts move once,
to their buckets; a slot finds the bucket of its block by the block's number and
meets the texts there. Block numbers of a bucket are one range, so that the
packed words never move again.

Defined results: words are runs of anything but ASCII white space; a null or
empty text has no words and is never taken; null sources are one source, the
last; null ids and repeated rows are documents of their own (equal ones take
equal places by order, so they share their counts' sum in any order, and lie in one
bucket); an empty table gives no rows; other columns are ignored by ``mix_plan`` and kept
by ``mix`` and ``mix_documents``, but for those named like a column that these add.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from wordfold.llm.common import WORD_BREAK, mix64, spread, stored, table, text_bytes

WEIGHTS = (3, 1, 2)
TOTAL_PERCENT = 150
MAX_PASSES = 2
BLOCK = 32
#: Blocks to an output shard, about.
SHARD = 4096
#: Words of a bucket, about: what one task packs at a time.
BUCKET_WORDS = 1 << 18
#: Block numbers in which a slot looks for its bucket.
_CELL = 4096
SEED = 20_011


def _order(seed: int):
    """A document's place in its source, the same in every run."""
    return F.xxhash64(F.col("doc_id"), text_bytes(), F.lit(seed))


def document_sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id, source, size, ord`` of ``docs`` (``doc_id, text, source``)."""
    slim = docs.select("doc_id", "source", text_bytes().alias("_text"), _order(seed).alias("ord"))
    kinds = [slim.schema[c].dataType.simpleString() for c in ("doc_id", "source")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = pa.array([len(x.as_py().split()) for x in b.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), size, b.column(3)], names=["doc_id", "source", "size", "ord"])

    return slim.mapInArrow(run, f"doc_id {kinds[0]}, source {kinds[1]}, size bigint, ord bigint")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target, sid``: weights by the sources' order, targets by filling.

    Shares go by weight; a source at ``MAX_PASSES`` times its size is full and its excess
    goes to the others by weight. Sources fill up in order of size by weight, so the level
    at which the others stand is found with running sums over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source: the only step in a single task
    rank = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]), (F.col("sid") % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumn("sid", (F.row_number().over(rank) - 1).cast("bigint")).withColumn("weight", w)
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "sid")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumns(
        {
            "_full": F.coalesce(F.sum(MAX_PASSES * F.col("source_size")).over(before), F.lit(0)),
            "_open": F.sum("weight").over(after),
            "_total": F.sum("source_size").over(everything),
        }
    ).withColumn("_level", (F.col("_total") * TOTAL_PERCENT / 100 - F.col("_full")) / F.col("_open"))
    # the first source that stays below its limit sets the level for all after it
    below = F.col("_level") * F.col("weight") <= MAX_PASSES * F.col("source_size")
    first = F.first(F.when(below, F.col("_level")), ignorenulls=True).over(everything)
    level = F.coalesce(first, F.lit(float("inf")))
    target = F.least(level * F.col("weight"), (MAX_PASSES * F.col("source_size")).cast("double"))
    return per.select("source", "source_size", target.alias("target"), "sid")


def _permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Pseudorandom permutation of ``range(n)``: a four-round Feistel network over the next
    even power of two, walked until it lands inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), bool)
    with np.errstate(over="ignore"):
        while todo.any():
            left, right = out[todo] >> np.uint64(half), out[todo] & mask
            for r in range(4):
                salt = np.uint64((key * 4 + r + 1) * 0x9E3779B97F4A7C15 % 2**64)
                left, right = right, left ^ (mix64(right ^ salt) & mask)
            out[todo] = (left << np.uint64(half)) | right
            todo = out >= n
    return out.astype(np.int64)


def mix_slots(sources: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """``shard, sid, slot, block``: every slot of the mix and the block that fills it.

    ``sources`` is ``sid, blocks, slots, shards`` of ``source_slots``. Slots of a source are made in runs of 2^16, so a large source is
    spread over many tasks.
    """
    run_size = 1 << 16
    runs = sources.where("slots > 0").select(
        "sid", "blocks", "slots", "shards",
        F.explode(F.sequence(F.lit(0).cast("bigint"), ((F.col("slots") - 1) / run_size).cast("bigint"))).alias("run"),
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for sid, blocks, slots, shards, run in zip(*(c.to_pylist() for c in b.columns)):
                first = run * run_size
                n = min(run_size, slots - first)
                slot = np.arange(first, first + n, dtype=np.int64)
                rng = np.random.Generator(np.random.Philox(key=[seed, sid * 1_000_003 + run]))
                # the run's multinomial draw over the shards (drawn sparsely: a count for each shard hit)
                hit, count = np.unique(rng.integers(0, shards, n), return_counts=True)
                at = np.empty(n, np.int64)
                for p in np.unique(slot // blocks).tolist():
                    mine = slot // blocks == p
                    at[mine] = _permuted(slot[mine] % blocks, blocks, (seed + sid) * 31 + p)
                cols = [np.repeat(hit, count), np.full(n, sid), slot, at]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["shard", "sid", "slot", "block"])

    return spread(runs, "sid", "run").mapInArrow(make, "shard bigint, sid bigint, slot bigint, block bigint")


def source_slots(targets: DataFrame, shard: int = SHARD) -> DataFrame:
    """``targets`` (with ``blocks``, those of the source) plus ``slots`` (its target in blocks) and ``shards`` (of the mix)."""
    # blocks may be short, so a slot is worth source_size / blocks words
    worth = F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0)
    df = targets.withColumn("slots", F.least(F.round(worth).cast("bigint"), MAX_PASSES * F.col("blocks")))
    total = F.sum("slots").over(Window.partitionBy())
    return df.withColumn("shards", F.greatest(F.lit(1), F.ceil(total / shard)).cast("bigint"))


def bucket_blocks(known: DataFrame, block: int = BLOCK) -> DataFrame:
    """``sid, bucket, first, n``: the first block of each bucket and their number. ``known`` is a stored
    table of documents with ``sid, bucket, size``."""
    per = known.groupBy("sid", "bucket").agg(F.ceil(F.sum("size") / block).alias("n")).where("n > 0")
    w = Window.partitionBy("sid").orderBy("bucket")
    return per.select("sid", "bucket", (F.sum("n").over(w) - F.col("n")).alias("first"), "n")


def slots_of_buckets(slots: DataFrame, buckets: DataFrame) -> DataFrame:
    """``slots`` (``shard, sid, slot, block``) with ``bucket`` and ``at``, the block's number in it."""
    cells = buckets.select(
        F.col("sid").alias("_sid"), "bucket", "first", "n",
        F.explode(F.expr(f"sequence(first DIV {_CELL}, (first + n - 1) DIV {_CELL})")).alias("cell"),
    )
    found = slots.join(
        cells.hint("merge"), (F.col("sid") == F.col("_sid")) & (F.expr(f"block DIV {_CELL}") == F.col("cell")) & F.expr("block >= first AND block < first + n")
    )
    return found.select("shard", "sid", "slot", "block", "bucket", (F.col("block") - F.col("first")).alias("at"))


def _word_starts(data: bytes) -> np.ndarray:
    gap = np.ones(len(data) + 1, bool)
    gap[1:] = WORD_BREAK[np.frombuffer(data, np.uint8)]
    return np.flatnonzero(gap[:-1] & ~gap[1:])


class _Bucket:
    """The documents of a bucket in their order, as one text, and where its blocks are cut."""

    def __init__(self, docs: pa.Table, block: int) -> None:
        ids, order = docs.column("_id").to_pylist(), docs.column("_ord").to_pylist()
        texts = docs.column("_text").to_pylist()
        starts = [_word_starts(t).tolist() for t in texts]
        # nulls come first, as in the order of the places
        self.rows = sorted(range(len(ids)), key=lambda i: (order[i], ids[i] is not None, ids[i] if ids[i] is not None else 0, len(starts[i])))
        self.texts, self.sizes = [texts[i] for i in self.rows], [len(starts[i]) for i in self.rows]
        # white space goes with the word before it, and with the first word
        self.cuts = [[0, *starts[i][1:], len(texts[i])] for i in self.rows]
        self.upto = [0, *np.cumsum(self.sizes, dtype=np.int64).tolist()]
        self.block = block

    def pieces(self, at: int) -> Iterator[tuple[int, int, bytes]]:
        """``(place, words, text)`` of the documents in block ``at``."""
        lo, hi = at * self.block, min((at + 1) * self.block, self.upto[-1])
        place = bisect_right(self.upto, lo) - 1
        while lo < hi:
            first = lo - self.upto[place]
            n = min(hi - lo, self.sizes[place] - first)
            if n > 0:
                yield place, n, self.texts[place][self.cuts[place][first] : self.cuts[place][first + n]]
                lo += n
            place += 1


#: What ``mix`` adds to the columns of the documents.
PIECE = ("shard", "slot", "part", "n_words", "taken")
_MINE = ("_sid", "_bucket", "_place")


def _gathered(docs: DataFrame, block: int, shard: int, seed: int, drop: tuple[str, ...]):
    """The documents' table, the slots, and a function that runs a task over each bucket's texts and slots."""
    sizes = stored(document_sizes(docs, seed), "mix-sizes")
    targets = source_targets(sizes).withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.col("source_size") / BUCKET_WORDS)))
    targets = stored(targets, "mix-targets")
    to_source = targets.select(F.col("source").alias("_source"), "sid", "source_size", "target", "buckets")
    known = sizes.join(to_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    known = known.withColumn("bucket", F.pmod("ord", "buckets"))
    inside = Window.partitionBy("sid", "bucket").orderBy("ord", "doc_id", "size")
    known = stored(known.withColumn("place", F.row_number().over(inside).cast("bigint") - 1), "mix-documents")
    buckets = stored(bucket_blocks(known, block), "mix-buckets")
    blocks = buckets.groupBy(F.col("sid").alias("_sid")).agg(F.sum("n").alias("_blocks"))
    sources = targets.join(blocks, F.col("sid") == F.col("_sid"), "left").withColumn("blocks", F.coalesce("_blocks", F.lit(0).cast("bigint")))
    sources = stored(source_slots(sources.drop("_sid", "_blocks"), shard), "mix-sources")
    slots = mix_slots(sources.select("sid", "blocks", "slots", "shards"), block, shard, seed)

    # the caller's row travels as a struct, so that its names meet no others
    kept = [f for f in docs.schema.fields if f.name not in drop]
    packed = docs.select(
        F.struct(*[F.col(f"`{f.name}`") for f in kept if f.name != "text"]).alias("_row"), F.col("doc_id").alias("_id"),
        F.col("source").alias("_own_source"), text_bytes().alias("_text"), F.col("text").isNull().alias("_none"), _order(seed).alias("_ord"),
    )
    texts = packed.join(to_source, F.col("_own_source").eqNullSafe(F.col("_source")))
    texts = texts.select(
        F.col("sid").alias("_sid"), F.pmod("_ord", "buckets").alias("_bucket"), "_row", "_id", "_text", "_none", "_ord", "source_size", "target"
    )

    def over(task, fields: list[StructField], hidden: tuple[str, ...] = ()) -> DataFrame:
        routed = slots_of_buckets(slots, buckets).select("shard", "slot", "at", F.col("sid").alias("_sid"), F.col("bucket").alias("_bucket"))
        key = ("_sid", "_bucket")
        schema = StructType([StructField("_row", texts.schema["_row"].dataType), *fields])
        found = texts.groupBy(*key).cogroup(routed.groupBy(*key)).applyInArrow(task, schema)
        of_row = lambda f: F.col("_row").getField(f.name).alias(f.name)
        return found.select(*[F.col("text") if f.name == "text" else of_row(f) for f in kept], *[f.name for f in fields if f.name not in ("text", *hidden)])

    return known, slots, over


def _mixed(docs: DataFrame, block: int, shard: int, seed: int, places: bool):
    """``(known, slots, mix)``: documents, slots, and the rows of ``mix``, with ``places`` also those of the documents."""
    known, slots, over = _gathered(docs, block, shard, seed, (*PIECE, *(_MINE if places else ())))
    long = [StructField(c, LongType()) for c in ("shard", "slot")]
    fields = [StructField("text", StringType()), *long, StructField("part", IntegerType())]
    fields += [StructField(c, LongType()) for c in ("n_words", "taken", *_MINE)]

    def fill(texts: pa.Table, slots: pa.Table) -> pa.Table:
        bucket = _Bucket(texts, block)
        rows = sorted(zip(*(slots.column(c).to_pylist() for c in ("at", "shard", "slot"))))
        out, taken = [], np.zeros(len(texts), np.int64)
        for at, in_shard, slot in rows:
            for part, (place, n, text) in enumerate(bucket.pieces(at)):
                out.append((bucket.rows[place], text, in_shard, slot, part, n, place))
                taken[place] += n
        which, text, in_shard, slot, part, n, place = zip(*out) if out else ((),) * 7
        whole = lambda v: pa.array(np.full(len(out), v, np.int64))
        sid, own = (texts.column(c)[0].as_py() if len(texts) else 0 for c in ("_sid", "_bucket"))
        columns = [
            texts.column("_row").take(pa.array(which, pa.int64())), pa.array(text, pa.binary()).cast(pa.string()), pa.array(in_shard, pa.int64()),
            pa.array(slot, pa.int64()), pa.array(part, pa.int32()), pa.array(n, pa.int64()), pa.array(taken[np.array(place, np.int64)]),
            whole(sid), whole(own), pa.array(place, pa.int64()),
        ]
        return pa.Table.from_arrays(columns, names=["_row", "text", "shard", "slot", "part", "n_words", "taken", *_MINE])

    return known, slots, over(fill, fields, () if places else _MINE)


def mix(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """The mix: a row for each document in each slot, with the columns of ``docs`` (``doc_id, text, source``
    and any others) and ``shard, slot, part, n_words, taken``.

    ``text`` is what the slot holds of the document, ``n_words`` words with the white space after them;
    ``part`` orders the documents of a slot (a slot is told by ``source`` and ``slot``), and ``taken`` is
    the number of words that the whole mix takes of the document.
    """
    return _mixed(docs, block, shard, seed, False)[2]


def mix_plan(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED):
    """``(documents, slots)``: documents as ``doc_id, source, size, source_size,
    target, sid, taken``, counted in the words of the mix, and the slots as ``shard, sid, slot, block``."""
    known, slots, rows = _mixed(docs.select("doc_id", "text", "source"), block, shard, seed, True)
    used = rows.groupBy(*_MINE).agg(F.sum("n_words").alias("taken"))
    on = (F.col("sid") == F.col("_sid")) & (F.col("bucket") == F.col("_bucket")) & (F.col("place") == F.col("_place"))
    found = known.join(used, on, "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("bigint")))
    return found.select("doc_id", "source", "size", "source_size", "target", "sid", "taken"), slots


def mix_documents(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """``docs`` with all columns plus ``size, source_size, target, taken`` of each row."""
    added = [StructField(c, LongType()) for c in ("size", "source_size")]
    added += [StructField("target", DoubleType()), StructField("taken", LongType())]
    _, _, over = _gathered(docs, block, shard, seed, tuple(f.name for f in added))

    def count(texts: pa.Table, slots: pa.Table) -> pa.Table:
        bucket = _Bucket(texts, block)
        taken = np.zeros(len(texts), np.int64)
        for at in slots.column("at").to_pylist():
            for place, n, _ in bucket.pieces(at):
                taken[bucket.rows[place]] += n
        size = np.zeros(len(texts), np.int64)
        size[bucket.rows] = bucket.sizes
        text = texts.column("_text").cast(pa.string())
        text = pc.if_else(texts.column("_none"), pa.scalar(None, pa.string()), text)
        columns = [texts.column("_row"), text, pa.array(size), texts.column("source_size"), texts.column("target"), pa.array(taken)]
        return pa.Table.from_arrays(columns, names=["_row", "text", *[f.name for f in added]])

    return over(count, [StructField("text", StringType()), *added])


def q_mixing(spark, sf_dir):
    found, _ = mix_plan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")
