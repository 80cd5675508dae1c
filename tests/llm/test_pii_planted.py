"""Personal data in other spellings, and what looks like it, planted in corpus texts."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F
from test_operators import valid
from test_pii_examples import card

from wordfold.llm import pii

SF = "/root/testdata/sf0.01"


def words(r: random.Random, n: int = 1) -> str:
    return "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(3, 9)))


def cut(d: str, sizes: tuple, sep: str) -> str:
    out, at = [], 0
    for n in sizes:
        out.append(d[at : at + n])
        at += n
    return sep.join(out)


def digits(r: random.Random, n: int) -> str:
    return str(r.randint(2, 9)) + "".join(r.choices("0123456789", k=n - 1))


def years(r: random.Random) -> str:
    """Two ranges of years; not those whose 16 digits pass as a card, which the base pattern takes."""
    while True:
        text = f"19{r.randint(10, 99)}-19{r.randint(10, 99)} 20{r.randint(10, 99)}-20{r.randint(10, 99)}"
        if not valid("card", text):
            return text


FORMS = {
    "email at": ("email", lambda r: f"{words(r)} (at) {words(r)} (dot) {r.choice(['org', 'com', 'net'])}"),
    "email brackets": ("email", lambda r: f"{words(r)}.{words(r)}[at]{words(r)}.com"),
    "ip version 6": ("ip", lambda r: ":".join(f"{r.randrange(65536):x}" for _ in range(8))),
    "card dots": ("card", lambda r: cut(card(r, 16), (4, 4, 4, 4), ".")),
    "card of 15": ("card", lambda r: cut(card(r, 15), (4, 6, 5), " ")),
    "card of 14": ("card", lambda r: card(r, 14)),
    "phone dashes": ("phone", lambda r: cut(digits(r, 10), (3, 3, 4), "-")),
    "phone area": ("phone", lambda r: f"({digits(r, 3)}) {digits(r, 3)}-{digits(r, 4)}"),
    "phone 00": ("phone", lambda r: "00" + cut(digits(r, 12), (2, 3, 3, 4), " ")),
    "token": ("secret", lambda r: 'token = "' + "".join(r.choices("0123456789abcdef", k=40)) + '"'),
    "key": ("secret", lambda r: "api-key: " + "".join(r.choices("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=32))),
}
NOT = {
    "time": lambda r: " [at] ".join([words(r), f"{r.randint(1, 12)}.{r.randint(10, 59)}"]),
    "date": lambda r: f"{r.randint(1950, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}",
    "date dots": lambda r: f"{r.randint(1, 28):02}.{r.randint(1, 12):02}.{r.randint(1950, 2030)}",
    "date slashes": lambda r: f"{r.randint(1, 12):02}/{r.randint(1, 28):02}/{r.randint(1950, 2030)}",
    "book": lambda r: cut("978" + digits(r, 10), (3, 4, 4, 2), " "),
    "book dashes": lambda r: cut("978" + digits(r, 10), (3, 1, 4, 4, 1), "-"),
    "years": lambda r: years(r),
    "wrong card": lambda r: (lambda c: cut(c[:-1] + str((int(c[-1]) + r.randint(1, 9)) % 10), (4, 4, 4, 4), "."))(card(r, 16)),
    "octets": lambda r: f"{r.randint(300, 999)}.{r.randint(0, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}",
    "plain key": lambda r: f"token: {words(r)}-{words(r)}-{words(r)}-{words(r)}{words(r)}",
}


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def model(corpus):
    return pii.fit_spans(corpus)


def test_recall_of_each_form_and_nothing_else(spark, corpus, model):
    r = random.Random(12)
    around = [(x.text or "").split() for x in corpus.where("length(text) > 400").orderBy("doc_id").limit(60).collect()]
    rows, want = [], {}
    for name, make in [*((k, f) for k, (_, f) in FORMS.items()), *NOT.items()]:
        for _ in range(30):
            text = r.choice(around)
            at = r.randrange(5, 40)
            # letters around it, so that nothing else is near
            before, after = " ".join(w for w in text[at : at + 6] if w.isalpha()), " ".join(w for w in text[at + 6 : at + 12] if w.isalpha())
            m = make(r)
            rows.append((len(rows), f"{before} und {m} und {after}"))
            want[len(rows) - 1] = (name, len(before) + 5, len(m))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {x[0]: x[1].split(",") if x[1] else [] for x in pii.personal_spans(df, model).select("doc_id", F.expr(pii._listed("_all_"))).collect()}
    hit, false = Counter(), Counter()
    for i, (name, at, n) in want.items():
        if name in FORMS:
            hit[name] += any(s.startswith(FORMS[name][0]) and int(s.split(":")[1]) < at + n and int(s.split(":")[2]) > at for s in got[i])
        else:
            false[name] += bool(got[i])
    assert all(hit[k] >= 27 for k in FORMS), hit
    assert sum(false.values()) <= 6 and all(false[k] <= 3 for k in NOT), false


def test_each_kind_has_its_own_threshold(model):
    assert set(model.thresholds) == {0, 1, 2, 3, 4} and len(set(model.thresholds.values())) == 5


def test_every_kind_has_both_sorts_of_examples(corpus):
    n = {(x.kind_id, x.label, x.held): x.n for x in pii.examples(corpus).groupBy("kind_id", "label", "held").agg(F.sum("n").alias("n")).collect()}
    assert len(n) == 20 and min(n.values()) >= 20


def test_sql_scores_are_those_of_the_fitted_trees(corpus, model):
    rows = pii.examples(corpus).withColumn("sql", F.expr(model.score.replace("x.f_", "f_")))
    names = [f"f_{k}" for k in pii.FEATURES]
    scored = model.trees.transform(VectorAssembler(inputCols=names, outputCol="features").transform(rows)).select("sql", "rawPrediction").collect()
    assert len(scored) > 100
    assert all(abs(r.sql - r.rawPrediction[1]) < 1e-5 for r in scored)


def test_clean_texts_stay(corpus, model):
    got = pii.personal_spans(corpus, model).select("text", F.expr(pii._listed("_all_")).alias("s"))
    plain = got.where("NOT text RLIKE '[0-9@]'")
    assert plain.count() > 300 and plain.where("s <> ''").count() == 0
