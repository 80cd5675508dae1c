"""The operators against brute force, on the small tables and on edge cases."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from wordfold.llm import chat, decontaminate, mixing, pii, quality, scoring, simhash, substring, suffix, warc

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp string"

LOREM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(LOREM) + r.choice(LOREM) for _ in range(n))


def edge_texts() -> list:
    long = prose(9, 3000)
    shared = prose(1, 120)
    return [
        (1, shared + " " + prose(2, 40)),
        (2, prose(3, 40) + "\n" + shared),
        (3, shared),
        (3, shared),
        (4, None),
        (5, ""),
        (6, " \t\n"),
        (None, shared),
        (None, None),
        (7, long),
        (8, long[:9000] + " x " + long[9000:]),
        (9, "é" * 60 + " ü\U0001f600 " + "é" * 60),
        (10, "a" * 300),
        (11, "b" + "a" * 299),
        (-5, prose(1, 70) + " Z " + prose(2, 70)),
        (12, "A " * 300),
    ]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, None if i in (4, 9) else "en", None if i == 7 else f"s{(i or 0) % 3}", 0, "x", "y") for i, t in edge_texts()]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(df) -> list:
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def bag(rows) -> Counter:
    return Counter(tuple(r) for r in rows)


# --- quality ------------------------------------------------------------------


def slow_features(t: str):
    w = WORD.findall(t)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    hit = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)


@pytest.mark.parametrize("name", ["edge", "small"])
def test_quality_features_and_base(request, name):
    df = request.getfixturevalue(name)
    got = quality.quality_verdicts(df).select("doc_id", *quality._FEATURES, "base_failed").collect()
    want = []
    for i, t in texts(df):
        f = slow_features(t)
        want.append((i, *f, f[0] < 20 or 100 * f[4] > 30 * f[0]))
    assert bag(got) == bag(want)


def test_quality_thresholds_reject_outliers_and_follow_the_group(spark):
    rows = [(i, prose(i, 60), "en", "plain", 0, "", "") for i in range(300)]
    rows += [(1000 + i, " ".join(w + " ##" for w in prose(i, 60).split()), "en", "marked", 0, "", "") for i in range(300)]
    rows.append((9999, " ".join(w + "####" for w in prose(5, 60).split()), "en", "plain", 0, "", ""))
    v = {r.doc_id: r.kept for r in quality.quality_verdicts(spark.createDataFrame(rows, DOCS)).collect()}
    assert not v.pop(9999)  # far from its own source
    assert all(v.values())  # a source that always looks like that sets its own thresholds


def test_quality_sketch_quantiles(spark):
    r = random.Random(4)
    values = sorted(int(r.paretovariate(0.7)) for _ in range(5000))
    df = spark.createDataFrame([("m", v) for v in values], "metric string, value long")
    from pyspark.sql import functions as F

    sketch = df.groupBy("metric", F.expr(quality._bucket("value")).alias("bucket")).agg(F.count("*").alias("n"))
    q = quality._quantiles(sketch, []).first()
    for p in (25, 75):
        exact = values[math.ceil(p / 100 * len(values)) - 1]
        assert exact <= q[f"q{p}"] <= exact * (1 + 1 / 32) + 1


def test_quality_filter_keeps_columns(edge, empty):
    kept = quality.quality_filter(edge)
    assert kept.columns == edge.columns and {r.doc_id for r in kept.collect()} >= {1, 2, 3, 7, 8}
    assert quality.quality_filter(empty).count() == 0


# --- suffixes and substrings ----------------------------------------------------


def slow_dedup(rows: list, window: int, split):
    first: dict = {}
    parts = [(i, split(t)) for i, t in rows]
    key = lambda x: math.inf if x is None else x
    for i, p in parts:
        for at in range(len(p) - window + 1):
            k = p[at : at + window]
            first[k] = min(first.get(k, math.inf), key(i))
    out = []
    for i, p in parts:
        gone = [False] * len(p)
        for at in range(len(p) - window + 1):
            if first[p[at : at + window]] < key(i):
                gone[at : at + window] = [True] * window
        out.append((i, p, gone))
    return out


@pytest.mark.parametrize("name", ["edge", "small"])
def test_suffix_dedup(request, name):
    df = request.getfixturevalue(name)
    got = suffix.suffix_dedup(df).drop("kept").collect()
    want = []
    for i, p, gone in slow_dedup(texts(df), 50, lambda t: t.encode()):
        kept = bytes(b for b, g in zip(p, gone) if not g)
        spans = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
        want.append((i, len(p), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    assert bag(got) == bag(want)


@pytest.mark.parametrize("name", ["edge", "small"])
def test_substring_dedup(request, name):
    df = request.getfixturevalue(name)
    got = substring.substring_dedup(df).drop("kept").collect()
    want = []
    for i, p, gone in slow_dedup(texts(df), 50, lambda t: tuple(t.encode().split())):
        kept = b" ".join(w for w, g in zip(p, gone) if not g)
        want.append((i, len(p), sum(gone), hashlib.sha256(kept).hexdigest()))
    assert bag(got) == bag(want)


def test_dedup_of_nothing(empty):
    assert suffix.suffix_dedup(empty).count() == 0 and substring.substring_dedup(empty).count() == 0


def test_repeated_fragments_that_cross(spark):
    # passages cut and joined in many ways, so that the graph branches everywhere
    r = random.Random(5)
    parts = [prose(100 + i, 30).split() for i in range(8)]
    rows = [(i, " ".join(sum((r.choice(parts)[r.randrange(8) :] for _ in range(6)), []))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = substring.substring_dedup(df).drop("kept").collect()
    want = []
    for i, p, gone in slow_dedup(rows, 50, lambda t: tuple(t.encode().split())):
        want.append((i, len(p), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(p, gone) if not g)).hexdigest()))
    assert bag(got) == bag(want)
    got = suffix.suffix_dedup(df).select("doc_id", "n_removed").collect()
    assert bag(got) == bag((i, sum(g)) for i, _, g in slow_dedup(rows, 50, lambda t: t.encode()))


def test_paths_are_compacted(spark):
    edges = spark.createDataFrame([(1, 10, 11, 3), (2, 11, 12, 3), (3, 12, 13, 3), (4, 13, 14, 2), (5, 20, 21, 1), (6, 21, 20, 1)], "e long, a long, b long, n long")
    nodes = spark.createDataFrame([(10, 3), (11, 3), (12, 3), (13, 3), (14, 2), (20, 1), (21, 1)], "k long, n long")
    got = {r.k: r.path for r in substring.compact_paths(edges, nodes).collect()}
    assert {k: v for k, v in got.items() if k < 20} == {10: 10, 11: 10, 12: 10}
    assert got.get(20) is None and got.get(21) is None  # a circle has no first node


# --- chat -----------------------------------------------------------------------


def test_chat_round_trip():
    r = random.Random(7)
    bits = [*chat.CONTROL, "\\", "\\\\", " ", "x", "<s", "[/INST", "s>", "\n", "é"]
    for _ in range(3000):
        turns = []
        for _ in range(r.randint(1, 4)):
            role = r.choice(["user", "assistant", "system", "", None, "".join(r.choices(bits, k=3))])
            turns.append((role, "".join(r.choices(bits, k=r.randint(0, 7)))))
        assert chat.parse("".join(chat.render(*t) for t in turns)) == turns
    with pytest.raises(ValueError):
        chat.parse("<s>[INST] a [INST] b [/INST]")


def test_chat_digests(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(1, 1, "assistant", "b\\"), (1, 0, "user", None), (1, 2, "assistant", said), (None, 0, None, "n"), (None, None, "tool", ""), (2, 0, "user", said), (2, 0, "user", said)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, loss string").repartition(3)
    formatted = chat.chat_format(df)
    got = {r.conv_id: r for r in chat.chat_digests(formatted).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha(f"user\n\nassistant\nb\\\nassistant\n{said}\n") and got[1].n_turns == 3
    assert got[1].loss_chars == len("b\\" + said) and got[1].loss_sha256 == sha("b\\" + said)
    assert got[None].turns_sha256 == sha("tool\n\n\nn\n") and got[None].loss_chars == 0
    assert got[2].n_turns == 2 and got[2].formatted_chars == 2 * len(chat.render("user", said))
    back = bag(chat.chat_turns(formatted).select("conv_id", "turn", "role", "text").collect())
    assert back == bag((c, t, role, x or "") for c, t, role, x in rows)
    assert chat.chat_digests(chat.chat_format(df.limit(0))).count() == 0


# --- scoring --------------------------------------------------------------------


@pytest.mark.parametrize("name", ["edge", "small"])
def test_scores(request, name):
    df = request.getfixturevalue(name)
    got = scoring.lm_scores(df).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = [(i, [*t.encode().lower().split(), None]) for i, t in texts(df)]
    count = Counter(x for i, t in tokens if not held(i) for x in t)
    n, v = sum(count.values()), len(count)
    want = bag((i, held(i), len(t), sum(count[x] > 0 for x in t), n) for i, t in tokens)
    assert bag(r[:5] for r in got) == want
    base = defaultdict(list)
    for i, t in tokens:
        base[i].append(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t))
    for r in got:
        assert any(abs(r.base_score - b) < 1e-6 for b in base[r.doc_id])
        assert r.score < 0 and math.isfinite(r.score)


def test_contexts_improve_held_out_scores(spark):
    rows = []
    r = random.Random(3)
    for i in range(600):  # each word tells the next one most of the time
        w, out = 0, []
        for _ in range(80):
            out.append(f"w{w}")
            w = (w * 7 + 3) % 50 if r.random() < 0.8 else r.randrange(50)
        rows.append((i, " ".join(out)))
    got = scoring.lm_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).where("held_out").collect()
    gain = sum(x.score - x.base_score for x in got) / sum(x.n_tokens for x in got)
    assert gain > 0.8  # about 1.7 to 0.6 digits a word


class SlowTree:
    """The suffix tree by its definition, over lists of symbols."""

    def __init__(self, texts: list, min_count: int, depth: int, divergence: float) -> None:
        self.depth, self.counts = depth, Counter()
        self.texts = [("^", *t) for t in texts]
        for t in self.texts:
            for j in range(len(t)):
                for k in range(1, depth + 2):
                    if j - k + 1 >= 0:
                        self.counts[t[j - k + 1 : j + 1]] += 1
        tokens = {c[0]: n for c, n in self.counts.items() if len(c) == 1 and c != ("^",)}
        self.n, self.v = sum(tokens.values()), len(tokens)
        self.states = {c for c, n in self.counts.items() if len(c) <= depth and n >= min_count and c[-1] is not None}
        gain: Counter = Counter()
        for t in self.texts:
            for j in range(1, len(t)):
                p = self.root(t[j])
                for d in range(1, depth + 1):
                    c = t[max(0, j - d) : j]
                    if j - d >= 0 and c in self.states:
                        w, m = self.counts[c], self.counts[(*c, t[j])]
                        gain[c] += round((math.log((m - 1 + 50 * p) / (w - 1 + 50)) - math.log(p)) * 1e6)
                        p = (m + 50 * p) / (w + 50)
        self.kept = {c for c in self.states if gain[c] / 1e6 >= divergence * self.counts[c]}

    def root(self, x) -> float:
        return (self.counts[x,] * (x != "^") + 1) / (self.n + self.v + 1)

    def probability(self, before: tuple, x) -> float:
        p = self.root(x)
        for d in range(1, self.depth + 1):
            c = before[len(before) - d :]
            if d <= len(before) and c in self.kept:
                p = (self.counts[(*c, x)] + 50 * p) / (self.counts[c] + 50)
        return p


@pytest.mark.parametrize("name,min_count,depth", [("edge", 2, 3), ("small", 30, 3), ("small", 15, 4), ("small", 20, 1)])
def test_suffix_tree(request, name, min_count, depth):
    df = request.getfixturevalue(name)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = [(i, (*t.encode().lower().split(), None)) for i, t in texts(df)]
    tree = SlowTree([t for i, t in tokens if not held(i)], min_count, depth, 0.02)
    if name == "small":
        assert len(tree.kept) > 10 and (depth == 1 or len({len(c) for c in tree.states}) == depth)
    want = defaultdict(list)
    for i, t in tokens:
        whole = ("^", *t)
        want[i].append(sum(math.log10(tree.probability(whole[max(0, j - depth) : j], whole[j])) for j in range(1, len(whole))))
    got = scoring.lm_scores(df, min_count=min_count, depth=depth).collect()
    assert len(got) == len(tokens)
    for r in got:
        assert any(abs(r.score - s) < 1e-6 * max(1, abs(s)) for s in want[r.doc_id]), (r, want[r.doc_id])
    # in every state the known symbols and one unknown sum to one
    known = [c[0] for c in tree.counts if len(c) == 1 and c != ("^",)]
    for c in sorted(tree.kept, key=str)[:20]:
        assert abs(sum(tree.probability(c, x) for x in [*known, "never seen"]) - 1) < 1e-9


def test_states_and_gain_grow_with_the_corpus(spark):
    def learned(sf: str):
        df = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        got = scoring.lm_scores(df).where("held_out").selectExpr("sum(score - base_score) / sum(n_tokens) AS g").first().g
        return got

    assert 0 < learned("sf0.001") < learned("sf0.01") < learned("sf0.1")


# --- archives -------------------------------------------------------------------


def test_warc_round_trip_with_any_ranges(spark):
    rows = [(1, None, None), (2, "http://x/\r\nWARC/1.0", ""), (3, "u", "<p>é</p>"), (None, "u", "<p>é</p>"), (3, "u", "<p>é</p>"), (4, "u", "z" * 300000), (5, None, "z" * 300000), (None, None, "only"), (6, "u", prose(1, 5000))]
    df = spark.createDataFrame([(*r, "q") for r in rows], "page_id long, url string, html string, path string").repartition(3)
    files = warc.write_warc(df)
    first: dict = {}
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(h or "", i)
    want = Counter()
    for i, _, h in rows:
        p = (h or "").encode()
        f = first[h or ""]
        want[(i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if f == i else "revisit", None if f == i else f)] += 1
    for size in (500, 4096, 1 << 22):
        got = warc.read_warc(files, size).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert bag(got.collect()) == want
    assert sum(r.records for r in files.collect()) == len(rows)
    assert warc.read_warc(warc.write_warc(df.limit(0))).count() == 0


def test_warc_least_payload_for_revisits(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = {r.page_id: r.refers_to for r in warc.read_warc(warc.write_warc(df, min_payload=3)).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


# --- mixing ---------------------------------------------------------------------


@pytest.mark.parametrize("name", ["edge", "small"])
def test_mixing(request, name):
    df = request.getfixturevalue(name)
    found, slots = mixing.mix_plan(df)
    got = found.select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    src = {(r.doc_id, r.source) for r in df.collect()}
    size = Counter()
    for r in df.collect():
        size[r.source] += len(WORD.findall(r.text or ""))
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full: set = set()
    while True:
        level = (1.5 * sum(size.values()) - sum(2 * size[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and level * weight[s] > 2 * size[s]}
        if not more:
            break
        full |= more
    taken = Counter()
    for r in got:
        assert (r.doc_id, r.source) in src and r.taken <= 2 * r.size and r.source_size == size[r.source]
        assert abs(r.target - (2 * size[r.source] if r.source in full else level * weight[r.source])) < 1e-6
        taken[r.source] += r.taken
    for r in got:
        assert abs(taken[r.source] - r.target) <= 0.05 * r.target + mixing.BLOCK
    again, _ = mixing.mix_plan(df.repartition(5))
    assert bag(got) == bag(again.select("doc_id", "source", "size", "source_size", "target", "taken").collect())
    # a slot's block is a permutation in each pass over the source
    by = defaultdict(list)
    for s in slots.collect():
        by[s.sid].append((s.slot, s.block))
    for v in by.values():
        n = max(b for _, b in v) + 1
        assert max(Counter(b for _, b in v).values()) <= 2 and len(v) <= 2 * max(n, len({b for _, b in v}))


def test_permutation():
    for n in (1, 2, 3, 17, 1000):
        assert sorted(mixing._permuted(np.arange(n), n, 5).tolist()) == list(range(n))


def test_mixing_of_nothing(empty):
    assert mixing.mix_plan(empty)[0].count() == 0


# --- decontamination --------------------------------------------------------------


def test_decontamination_of_texts_shorter_than_an_item(spark):
    items = [(i, prose(700 + i, 40 + i)) for i in range(6)] + [(20, "one two three four five six"), (21, "a b c d")]
    rows, want = [], Counter()
    for i, x in items:
        w = x.split()
        for cut in range(0, len(w), 3):
            for part in (w[: len(w) - cut], w[cut:], ["junk", *w[: len(w) - cut]]):
                rows.append((len(rows), " ".join(part)))
    for d, t in rows:
        w = t.encode().lower().split()
        for i, x in items:
            iw = x.encode().lower().split()
            k = min(5, len(iw))
            own = Counter(decontaminate._shingles(iw, k))
            windows = [w[a : a + len(iw)] for a in range(len(w) - len(iw) + 1)] if len(w) >= len(iw) else [w] * (len(w) >= k)
            want[d, i] += any(decontaminate.weighted_jaccard(Counter(decontaminate._shingles(v, k)), own) >= 0.8 for v in windows)
    want = +want
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = decontaminate.contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert bag(got.select("doc_id", "item_id").collect()) == want
    shorter = {d for (d, i) in want if len(rows[d][1].split()) < len(dict(items)[i].split())}
    assert len(shorter) > 15


def test_decontamination_finds_every_similar_window(spark):
    items = [(i, prose(500 + i, 15 + 3 * i)) for i in range(12)] + [(90, "only three words"), (91, ""), (92, None)]
    rows = []
    r = random.Random(2)
    for d in range(60):
        words = prose(d, 80).split()
        item = items[d % 12][1].split()
        for _ in range(d % 4):  # up to three changed words
            item[r.randrange(len(item))] = "changed"
        if d % 5:
            words[20:20] = item
        rows.append((d, " ".join(words).title() if d % 2 else " ".join(words)))
    rows += [(70, "these are Only three words here"), (71, None), (None, items[3][1]), (72, "")]
    df = spark.createDataFrame([(*x, "k") for x in rows], "doc_id long, text string, item_id string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = bag(decontaminate.contaminated(df, bench).select("doc_id", "item_id").collect())
    want = Counter()
    for d, t in rows:
        w = (t or "").encode().lower().split()
        for i, x in items:
            iw = (x or "").encode().lower().split()
            k = min(5, len(iw))
            own = Counter(decontaminate._shingles(iw, k)) if iw else None
            if iw and any(decontaminate.weighted_jaccard(Counter(decontaminate._shingles(w[a : a + len(iw)], k)), own) >= 0.8 for a in range(len(w) - len(iw) + 1)):
                want[d, i] += 1
    assert got == want and len(want) > 15
    assert bag(decontaminate.contaminated(df, bench, block_bytes=600).select("doc_id", "item_id").collect()) == want
    clean = decontaminate.decontaminate(df, bench)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in want}
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0


# --- personal data ----------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind: str, m: str) -> bool:
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        s = sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(d)))
        return 16 <= len(d) <= 19 and s % 10 == 0
    return kind != "phone" or 8 <= len(d) <= 15


def slow_spans(t: str) -> list[str]:
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, t) if valid(k, m.group())]


PRIVATE = [
    "a@b.c_d@e.f", "a@b.c.d@e.f x@y", "1.2.3.4.5.6.7.8", "999.1.1.1 01.002.3.4", "4111 1111 1111 1111 4111-1111-1111-1111 1",
    "+1 (5) 5 +12345678", "+1 523 555 1055+44 20 7946 0958", "é@ü ü@a.b", "x" * 5000 + "@", "1" * 30000, "1 " * 9000,
    "a." * 9000 + "@" + "b." * 9000 + "c", "+1" + "0 " * 3000, "bob (at) example (dot) org", "\U0001f600 a@b.c \U0001f600 1.2.3.4", "", None,
    " ".join(f"u{i}@h{i}.org" for i in range(1500)),
]


def test_personal_data(spark, small):
    extra = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(PRIVATE)], "doc_id long, text string")
    df = small.select("doc_id", "text").union(extra)
    model = pii.fit_spans(df)
    from pyspark.sql import functions as F

    spans = pii.personal_spans(df, model).select("text", F.expr(pii._listed("_base_")), F.expr(pii._listed("_all_"))).collect()
    for text, base, every in spans:
        want = slow_spans(text or "")
        assert base == ",".join(want)
        assert set(want) <= set(every.split(",") if every else [])
    again = pii.personal_spans(df, model).select(F.expr(pii._listed("_all_"))).collect()
    assert bag(again) == bag((s[2],) for s in spans)


def test_redaction(spark, empty):
    df = spark.createDataFrame([(1, "\U0001f600 a@b.c, 1.2.3.4 and +1 523 555 1055!", "x"), (2, "clean", "y"), (3, None, "z")], "doc_id long, text string, kept string")
    none = pii.SpanModel(None, {})
    got = {r.doc_id: r.text for r in pii.redact(df, none).collect()}
    assert got == {1: "\U0001f600 [EMAIL], [IP] and [PHONE]!", 2: "clean", 3: None}
    assert pii.redact(empty).count() == 0 and pii.redact(empty).columns == empty.columns


def test_boosted_trees_are_applied_as_fitted(spark):
    model = pii.fit_spans(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert model.score and set(model.thresholds) <= set(range(len(pii.ALL_KINDS)))


# --- fingerprints -----------------------------------------------------------------


def slow_fingerprint(t: str) -> int:
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps: list[int], bits: int = 4) -> list[int]:
    root = list(range(len(fps)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    x = np.array(fps, np.uint64)
    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= bits):
            root[find(int(j))] = find(i)
    return [find(i) for i in range(len(x))]


@pytest.mark.parametrize("name", ["edge", "small"])
def test_simhash_components(request, name):
    df = request.getfixturevalue(name)
    rows = texts(df)
    fps = [slow_fingerprint(t) for _, t in rows]
    comp = slow_components(fps)
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = bag((i, f - 2**64 if f >= 2**63 else f, least.get(c)) for (i, _), f, c in zip(rows, fps, comp))
    assert bag(simhash.simhash_components(df).collect()) == want
    kept = simhash.simhash_dedup(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for (i, _), c in zip(rows, comp) if i == least.get(c)}


def test_every_pair_within_four_bits_shares_a_key():
    r = np.random.default_rng(1)
    code = simhash.Golay()
    fp = r.integers(0, 2**64, 2000, dtype=np.uint64)
    other = fp.copy()
    for i in range(len(fp)):
        for b in r.choice(64, r.integers(0, 5), replace=False):
            other[i] ^= np.uint64(1) << np.uint64(b)
    for keys in (lambda x: simhash.golay_keys(x, code), simhash.byte_keys):
        a, b = (set(zip(*map(np.ndarray.tolist, keys(x)))) for x in (fp, other))
        assert {i for i, _ in a & b} == set(range(len(fp)))


def test_golay_code_is_perfect():
    code = simhash.Golay()
    words = np.arange(1 << 23, dtype=np.int64)
    assert (np.bincount(code.index(words), minlength=4096) == 2048).all()


@pytest.mark.parametrize("hot", [1024, 8])
def test_clusters_and_hot_keys(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    r = random.Random(6)
    fps = set()
    for _ in range(6):
        centre = r.getrandbits(64)
        for _ in range(60):
            x = centre
            for b in r.sample(range(64), r.randint(0, 4)):
                x ^= 1 << b
            fps.add(x)
    chain = r.getrandbits(64)
    for b in range(0, 60, 3):  # a long chain of close fingerprints
        chain ^= 0b111 << b
        fps.add(chain)
    fps = sorted(fps)
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    stars = simhash.star_components(simhash.fingerprint_links(spark.createDataFrame(signed, "fp long")))
    root = {a: a for (a,) in signed} | {x.node: x.root for x in stars.collect()}
    groups = lambda labels: {frozenset(i for i, x in enumerate(labels) if x == y) for y in set(labels)}
    assert groups([root[a] for (a,) in signed]) == groups(slow_components(fps))


def test_nothing_to_link(empty):
    assert simhash.simhash_components(empty).count() == 0
