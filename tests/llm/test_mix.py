"""The mix itself: what is emitted, word by word, against the documents."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from wordfold.llm import mixing

DOCS = "doc_id long, text string, source string, shard string, _key string, _row string, _sid string, words string, note string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def rows_of(seed: int, n: int) -> list:
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(r.choices("abcdé\U0001f600", k=r.randint(1, 8))) for _ in range(r.randint(0, 120))]
        text = "".join(w + r.choice([" ", "  ", "\n", "\t\x0b "]) for w in words)
        rows.append((i, r.choice(["", " ", "\n"]) + text, r.choice(["a", "a", "a", "b", "c", None])))
    rows += [(None, "null id one", "a"), (None, "null id two", "a"), (5, None, "b"), (5, "", "b"), (6, " \n ", None)]
    rows += [(7, "same row " * 20, "c")] * 3 + [(n + 1, "long " * 4000, "b")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, "s", "k", "r", "i", "w", f"n{j}") for j, x in enumerate(rows)], DOCS).repartition(3)


@pytest.mark.parametrize("bucket_words", [1 << 18, 500])
def test_emitted_words(spark, monkeypatch, bucket_words):
    monkeypatch.setattr(mixing, "BUCKET_WORDS", bucket_words)
    rows = rows_of(1, 150)
    got = mixing.mix(frame(spark, rows), block=16, shard=20).collect()
    names = got[0].asDict().keys()
    assert {"doc_id", "text", "source", "shard", "_key", "_row", "_sid", "words", "note", "slot", "part", "n_words", "taken"} == set(names)
    assert all(r.n_words == len(WORD.findall(r.text)) > 0 for r in got)
    assert all(isinstance(r.shard, int) and r._key == "k" and r._row == "r" and r.words == "w" for r in got)

    # a slot is a block of consecutive documents, full but at a bucket's end
    slots = defaultdict(list)
    for r in got:
        slots[r.source, r.slot].append(r)
    for parts in slots.values():
        parts.sort(key=lambda r: r.part)
        assert [r.part for r in parts] == list(range(len(parts))) and len({r.shard for r in parts}) == 1
        assert sum(r.n_words for r in parts) <= 16
    full = sum(sum(r.n_words for r in p) == 16 for p in slots.values())
    assert full >= 0.9 * len(slots) - 10

    # each document's pieces are its text, cut at words, each piece taken at most twice
    by_row, counts = defaultdict(Counter), Counter()
    for r in got:
        by_row[r.note][r.text] += 1
        counts[r.note] += r.n_words
    for j, (i, text, source) in enumerate(rows):
        mine = [r for r in got if r.note == f"n{j}"]
        assert all((r.doc_id, r.source) == (i, source) and r.text in (text or "") for r in mine)
        assert counts[f"n{j}"] <= 2 * len(WORD.findall(text or ""))
        assert all(r.taken == counts[f"n{j}"] for r in mine)
        if len(mine) and counts[f"n{j}"] == 2 * len(WORD.findall(text)):
            assert sorted("".join(r.text for r in mine)) == sorted(text * 2)

    # the same counts per document by the plan, by the documents, and from other partitions
    want = Counter((i, s, counts[f"n{j}"]) for j, (i, t, s) in enumerate(rows))
    docs = mixing.mix_documents(frame(spark, rows), block=16, shard=20).collect()
    plan = mixing.mix_plan(frame(spark, rows).repartition(7), block=16, shard=20)[0].collect()
    assert sorted((r.doc_id or -1, r.source or "", r.taken) for r in plan) == sorted((i or -1, s or "", n) for i, s, n in want.elements())
    assert Counter((r.note, r.taken) for r in docs) == Counter((f"n{j}", counts[f"n{j}"]) for j in range(len(rows)))
    assert Counter((r.doc_id, r.text, r.source) for r in docs) == Counter(rows)
    again = mixing.mix(frame(spark, rows).repartition(2), block=16, shard=20).drop("note", "words").collect()
    assert Counter(tuple(r.asDict()[c] for c in ("doc_id", "text", "shard", "slot", "part")) for r in got) == Counter(
        tuple(r.asDict()[c] for c in ("doc_id", "text", "shard", "slot", "part")) for r in again
    )

    # targets: weights 3, 1, 2 in the order of the sources, 3 for the null source, full at twice the size
    size, taken, target = Counter(), Counter(), {}
    for r in plan:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6 * sum(size.values())
    assert all(t <= 2 * size[s] for s, t in target.items())
    assert all(abs(taken[s] - t) <= 0.05 * t + 32 for s, t in target.items())


def test_mix_of_nothing(spark):
    none = frame(spark, [(1, "a", "b")]).limit(0)
    assert mixing.mix(none).count() == 0 and mixing.mix_documents(none).count() == 0
    empty = frame(spark, [(1, None, "b"), (2, "  ", None)])
    assert mixing.mix(empty).count() == 0 and mixing.mix_documents(empty).count() == 2


def test_texts_move_once(spark):
    from wordfold.plans.inspect import plan_text

    plan = plan_text(mixing.mix(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))
    keyed = re.findall(r"Exchange\nInput[^\n]*\[([^\]]*)\]", plan)
    assert sum("_text" in x for x in keyed) == 1
