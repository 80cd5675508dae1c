"""Tables with extra columns that have the names of the operators' own helpers and results."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from wordfold.llm import decontaminate, mixing, negatives, pii, quality, scoring, simhash, substring, suffix, variants

#: Names that operators give to columns of their own, in any module.
HELPERS = """_text _new _sorted _cands _more _row_key _key _raw_email _base_ip _loose_card _all_phone row at page part bits _page clean
kept fp root component_id size source_size target taken sid bucket place ord _ord _id _row _sid _bucket _place _none shard slot n_words
word_chars n_symbols n_dup_lines n_repeat_words base_failed _features _lang _source _max_symbols metric value n block rid
at_ _at _part key _to ghost _ghost _bounds h known score base_score held_out""".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghij", k=r.randint(3, 7))) for _ in range(n))


ITEM = prose(77, 40)
BASE = [
    (1, prose(1, 60), "en", "a"), (2, prose(1, 60), "en", "b"), (None, prose(2, 50) + " mail a@b.cd or +1 523 555 1055", "en", "a"),
    (3, "too short", "en", "a"), (4, prose(3, 30) + " " + ITEM, "fr", "b"), (4, None, None, None), (5, prose(5, 200) + "\nip 1.2.3.4", "fr", None),
]


@pytest.fixture(scope="module")
def plain(spark):
    return spark.createDataFrame(BASE, "doc_id long, text string, lang string, source string").repartition(2)


@pytest.fixture(scope="module")
def odd(spark):
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{h}` string" for h in HELPERS)
    return spark.createDataFrame([(*r, *[f"{h} {r[0]}" for h in HELPERS]) for r in BASE], schema).repartition(2)


def bag(rows, *columns) -> Counter:
    return Counter(tuple(r[c] for c in columns) for r in rows)


def carried(rows, columns) -> None:
    for r in rows:
        assert all(r[h] == f"{h} {r['doc_id']}" for h in columns)


FILTERS = {
    "quality": lambda d, s: quality.quality_filter(d),
    "simhash": lambda d, s: simhash.simhash_dedup(d),
    "decontaminate": lambda d, s: decontaminate.decontaminate(d, s.createDataFrame([(1, ITEM)], "item_id long, text string")),
    "redact": lambda d, s: pii.redact(d, pii.SpanModel(None, {})),
}


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_every_column(spark, plain, odd, name):
    got, want = FILTERS[name](odd, spark), FILTERS[name](plain, spark)
    assert got.columns == odd.columns
    rows = got.collect()
    own = ("doc_id", "text", "lang", "source")
    assert bag(rows, *own) == bag(want.collect(), *own)
    carried(rows, HELPERS)
    if name == "redact":
        assert not any("a@b.cd" in str(v) for r in rows for v in r)


def test_mix_keeps_the_others(plain, odd):
    added = {"shard", "slot", "part", "n_words", "taken"}
    got, want = mixing.mix(odd).collect(), mixing.mix(plain).collect()
    own = ("doc_id", "text", "source", "shard", "slot", "part", "n_words", "taken")
    assert bag(got, *own) == bag(want, *own)
    carried(got, [h for h in HELPERS if h not in added])
    added = {"size", "source_size", "target", "taken"}
    got, want = mixing.mix_documents(odd).collect(), mixing.mix_documents(plain).collect()
    assert bag(got, "doc_id", "text", *sorted(added)) == bag(want, "doc_id", "text", *sorted(added))
    carried(got, [h for h in HELPERS if h not in added])


RESULTS = {
    "quality": lambda d: quality.quality_verdicts(d),
    "suffix": lambda d: suffix.suffix_dedup(d),
    "substring": lambda d: substring.substring_dedup(d),
    "scoring": lambda d: scoring.lm_scores(d),
    "mixing": lambda d: mixing.mix_plan(d)[0].drop("sid"),
    "simhash": lambda d: simhash.simhash_components(d),
    "variants": lambda d: variants.letter_runs(d, garbled=3),
    "pii": lambda d: pii.personal_spans(d, pii.SpanModel(None, {})).select("doc_id", *[f"_all_{k}" for k in pii.KINDS]),
}


@pytest.mark.parametrize("name", RESULTS)
def test_results_do_not_change(plain, odd, name):
    got, want = RESULTS[name](odd), RESULTS[name](plain)
    assert got.columns == want.columns
    assert Counter(map(str, got.collect())) == Counter(map(str, want.collect()))


def test_vectors(spark):
    rows = [(i, i % 3, [float(i % 5), float(i % 7)]) for i in range(60)]
    names = ["rid", "dim", "is_anchor", "rb", "ab", "row", "key", "ids", "scores", "lows", "highs"]
    plain = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    odd = spark.createDataFrame([(*r, *names) for r in rows], "vec_id long, label int, embedding array<float>, " + ", ".join(f"{n} string" for n in names))
    got, want = (negatives.hard_negatives(x, "vec_id % 20 = 0").collect() for x in (odd, plain))
    assert got and Counter(got) == Counter(want)
