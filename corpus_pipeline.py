"""From raw documents to a training mix, as stages that are stored one by one."""

from __future__ import annotations

from wordfold.llm.common import released, stored, table
from wordfold.llm.decontaminate import decontaminate
from wordfold.llm.mixing import mix
from wordfold.llm.pii import redact
from wordfold.llm.quality import quality_filter
from wordfold.llm.simhash import simhash_dedup


def rules(spark, docs, sf_dir):
    """Documents that pass the quality rules."""
    return quality_filter(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each SimHash component: the one with the smallest id."""
    return simhash_dedup(docs)


def benchmark(spark, docs, sf_dir):
    """Documents without a passage of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark, docs, sf_dir):
    """All documents, with personal data replaced by its kind."""
    return redact(docs)


def mixture(spark, docs, sf_dir):
    """The mix: a row for each document in each slot of each output shard, with the document's columns,
    ``text`` being the words that the slot holds of it."""
    return mix(docs)


STAGES = [
    ("quality_rules", rules),
    ("simhash_dedup", near_duplicates),
    ("decontamination", benchmark),
    ("personal_data", personal_data),
    ("mixing", mixture),
]

#: The stages are not all expressible in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the ``documents`` table, each stored and read again. What a stage has read is
    let go when its own rows are stored."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            released(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
