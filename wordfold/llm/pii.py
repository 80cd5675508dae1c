"""Personal data: base patterns, and further spans chosen by boosted trees.

Everything is DataFrame and SQL expressions over one row per document; nothing
is shuffled but counts of equal examples. Matches of a pattern come from
``regexp_extract_all``, and their places from the lengths of the pieces that
``split`` leaves between them, both in code points.

* Base spans are valid leftmost matches of the four base patterns; they stay.
* Candidates come from high-recall generators (the base patterns and looser
  ones) and may overlap. Secrets (a token, key or password that is assigned) have no base pattern.
* Examples are of two sorts. Found ones: a candidate that overlaps a valid base match of its kind
  is positive; one that overlaps an invalid base match is negative and is
  never redacted. The base pattern of cards matches any two digits, so a card
  candidate is negative by its own digits: not 13 to 19, or a wrong check digit.
  Every base match of an e-mail address is valid, so a candidate is negative if
  its host does not end in letters; a secret, if it has no digit. Planted ones: every valid base match of the corpus is
  rewritten, in its place, by ``PLANTED``: to other spellings of each kind (positive),
  and to what looks like one and is none, such as book numbers, dates, times, ranges
  of years, broken check digits and plain words (negative). Their truth is known from the
  rewriting, not from a feature.
* Equal examples are counted over all documents. A quarter
  of them is held out; at most ``SAMPLE`` of the other distinct ones, with equal parts
  for each kind and label, fit gradient-boosted trees over format and context
  features. Each kind's threshold is the least score at which the precision over
  all held-out examples is ``PRECISION``.
* The other candidates that reach their kind's threshold are added. A candidate's features are
  found once; the trees are applied to them as SQL ``IF`` expressions.

Defined results: a null or empty text has no spans; null ids and repeated rows
are carried; with an empty table, or without examples of both classes, no span
is added; other columns are ignored (``redact`` keeps them).
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordfold.llm.common import packed, stored, table, unpacked

KINDS = ("email", "ip", "card", "phone")
#: Kinds of added spans, in the order in which spans are listed.
ALL_KINDS = (*KINDS, "secret")

_LOCAL = "[A-Za-z0-9._%+-]"
# The base patterns. Possessive repeats match the same (nothing that follows could
# use what they give back) without Java's recursion on long runs. A run of local
# characters or digits that fails from its start fails from its middle too, so
# matches begin at a run's start or where the last match ended (\G).
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++ ?[(\[{{]at[)\]}}] ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[{{]dot[)\]}}]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])[0-9](?:[ ./-]{0,2}[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:00|\+)?\(?[0-9]{2,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,4}\)?){2,4}(?![0-9])",
    "secret": r"(?i)(?<![a-z0-9])(?:token|secret|passw(?:or)?d|(?:api|access)[_-]?key)[\x22\x27]?[ ]{0,2}[:=][ ]{0,2}[\x22\x27]?[a-z0-9+/_-]{16,}+[\x22\x27]?",
}
#: A text without a match of the guard has none of the pattern.
GUARD = {
    "email": "instr(_text, '@') > 0", "ip": r"_text RLIKE '[0-9]\\.[0-9]'", "card": "_text RLIKE '[0-9]'",
    "phone": "instr(_text, '+') > 0",
}
LOOSE_GUARD = {
    "email": r"_text RLIKE '[(\\[{]at[)\\]}]'", "ip": "_text RLIKE ':[0-9A-Fa-f]{1,4}:'", "card": "_text RLIKE '[0-9]'",
    "phone": "_text RLIKE '[0-9]'", "secret": "instr(_text, '=') > 0 OR instr(_text, ':') > 0",
}

SAMPLE = 20_000
PRECISION = 0.99
CONTEXT = 24
TREES, DEPTH = 12, 4

_SPAN = "array<struct<start:bigint,stop:bigint,m:string>>"


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(pieces: str, matches: str) -> str:
    """SQL for the matches as ``start, stop, m`` from ``pieces`` between them. Filled in parts
    of 256, so that appending stays cheap for texts with very many matches."""
    step = (
        "named_struct('pos', a.pos + length(x.{p}) + coalesce(length(x.{m}), 0), "
        "'full', IF(size(a.part) < 256, a.full, concat(a.full, array(a.part))), "
        "'part', concat(IF(size(a.part) < 256, a.part, CAST(array() AS {t})), IF(x.{m} IS NULL, CAST(array() AS {t}), "
        "array(named_struct('start', a.pos + length(x.{p}), 'stop', a.pos + length(x.{p}) + length(x.{m}), 'm', x.{m})))))"
    ).format(p=pieces, m=matches, t=_SPAN)
    zero = f"named_struct('pos', 0L, 'full', CAST(array() AS array<{_SPAN}>), 'part', CAST(array() AS {_SPAN}))"
    return (
        f"aggregate(arrays_zip({pieces}, {matches}), {zero}, (a, x) -> {step}, "
        "a -> concat(flatten(a.full), a.part))"
    )


def _found(df: DataFrame, name: str, pattern: str, guard: str) -> DataFrame:
    """``df`` with the matches of ``pattern`` in ``_text`` as column ``name``."""
    lit = _literal(pattern)
    none = "CAST(array() AS array<string>)"
    df = df.withColumns(
        {
            f"{name}_p": F.expr(f"IF({guard}, split(_text, {lit}, -1), {none})"),
            f"{name}_m": F.expr(f"IF({guard}, regexp_extract_all(_text, {lit}, 0), {none})"),
        }
    )
    return df.withColumn(name, F.expr(_spans(f"{name}_p", f"{name}_m"))).drop(f"{name}_p", f"{name}_m")


_DIGITS = "regexp_replace({m}, '[^0-9]', '')"


def _luhn(m: str) -> str:
    # every second digit from the right is doubled, less 9 if that is over 9
    digit = "CAST(substring(d, -i, 1) AS BIGINT)"
    term = f"CASE WHEN i > length(d) THEN 0L WHEN i % 2 = 1 THEN {digit} ELSE {digit} * 2 % 10 + {digit} DIV 5 END"
    total = f"aggregate(sequence(1, 19), 0L, (s, i) -> s + {term})"
    return f"(element_at(transform(array({_DIGITS.format(m=m)}), d -> {total}), 1) % 10 = 0)"


_PART = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _valid(kind: str, x: str) -> str:
    m = f"{x}.m"
    n = f"length({_DIGITS.format(m=m)})"
    return {
        "email": "true",
        "ip": f"{m} RLIKE '^{_PART}[.]{_PART}[.]{_PART}[.]{_PART}$'",
        "card": f"IF({n} BETWEEN 16 AND 19, {_luhn(m)}, false)",
        "phone": f"{n} BETWEEN 8 AND 15",
    }[kind]


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_text`` and, per kind, ``_raw_<kind>`` (matches of the base pattern)
    and ``_base_<kind>`` (the valid ones)."""
    df = docs.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    for k in KINDS:
        df = _found(df, f"_raw_{k}", BASE[k], GUARD[k])
    return df.withColumns({f"_base_{k}": F.expr(f"filter(_raw_{k}, x -> {_valid(k, 'x')})") for k in KINDS})


def _overlaps(x: str, spans: str) -> str:
    return f"exists({spans}, y -> y.start < {x}.stop AND {x}.start < y.stop)"


#: name -> SQL over a candidate ``x`` (kind, m, before, after)
FEATURES = {
    "kind": "CAST(x.kind AS DOUBLE)",
    "length": "CAST(least(length(x.m), 24) AS DOUBLE)",
    "digits": "CAST(least(length(regexp_replace(x.m, '[^0-9]', '')), 20) AS DOUBLE)",
    "letters": "CAST(least(length(regexp_replace(x.m, '[^A-Za-z]', '')), 4) AS DOUBLE)",
    "groups": "CAST(size(split(x.m, '[^0-9A-Za-z]+')) AS DOUBLE)",
    "dots": "CAST(length(regexp_replace(x.m, '[^.]', '')) AS DOUBLE)",
    "first": "CAST(least(length(regexp_extract(x.m, '^[^0-9A-Za-z]*([0-9]+)[^A-Za-z]*$', 1)), 5) AS DOUBLE)",
    "last": "CAST(least(length(regexp_extract(x.m, '^[^A-Za-z]*?([0-9]+)[^0-9A-Za-z]*$', 1)), 5) AS DOUBLE)",
    "opening": "IF(x.m RLIKE '^(00|[+(])', 1.0D, 0.0D)",
    "book": "IF(x.m RLIKE '^97[89]', 1.0D, 0.0D)",
    "years": "CAST(size(regexp_extract_all(x.m, '(?<![0-9])(19|20)[0-9]{2}(?![0-9])', 0)) AS DOUBLE)",
    "name_end": "IF(x.m RLIKE '[A-Za-z]{2,}$', 1.0D, 0.0D)",
    "luhn": f"IF(x.kind = 2 AND length(regexp_replace(x.m, '[^0-9]', '')) BETWEEN 13 AND 19 AND {_luhn('x.m')}, 1.0D, 0.0D)",
    "octets": f"IF(x.m RLIKE '^{_PART}[.]{_PART}[.]{_PART}[.]{_PART}$', 1.0D, 0.0D)",
    "before": "IF(x.before RLIKE '[0-9A-Za-z]$', 1.0D, 0.0D)",
    "after": "IF(x.after RLIKE '^[0-9A-Za-z]', 1.0D, 0.0D)",
    "cue": "IF(lower(x.before) RLIKE '(mail|phone|tel|call|fax|mobile|card|visa|pay|host|server|address|contact|from)', 1.0D, 0.0D)",
}


def _featured(candidates: str, fields: tuple[str, ...]) -> str:
    """SQL for ``candidates`` with their features, each found once."""
    own = ", ".join(f"x.{c} AS {c}" for c in fields)
    return f"transform({candidates}, x -> struct({own}, {', '.join(f'{v} AS f_{k}' for k, v in FEATURES.items())}))"


def _digits(first: int, n: int) -> str:
    return f"substring(z.d, {first}, {n})"


def _checked(first: int, n: int, add: int = 0, start: str = "''") -> str:
    """``n`` digits of which the last is the check digit, plus ``add``."""
    body = f"concat({start}, {_digits(first, n - 1)})" if start != "''" else _digits(first, n - 1)
    size = f"substring({body}, 1, {n - 1})"
    right = _luhn(f"concat({size}, CAST(c AS STRING))")
    return f"concat({size}, CAST((element_at(filter(sequence(0, 9), c -> {right}), 1) + {add}) % 10 AS STRING))"


def _cut(digits: str, sizes: tuple[int, ...], sep: str) -> str:
    parts, at = [], 1
    for n in sizes:
        parts.append(f"substring({digits}, {at}, {n})")
        at += n
    return f"concat_ws('{sep}', {', '.join(parts)})"


_YEAR = f"concat('20', {_digits(1, 2)})"
_MONTH, _DAY = (f"lpad(CAST({_digits(a, 3)} % {n} + 1 AS STRING), 2, '0')" for a, n in ((3, 12), (6, 28)))
#: ``(kind, label, SQL)``: what a valid match is rewritten to. ``z.d`` are 36 digits and ``z.h`` 40 hex digits of
#: its hash, ``z.w`` and ``z.v`` are words from it.
PLANTED = [
    ("email", 1, "concat(z.w, ' (at) ', z.v, ' (dot) org')"),
    ("email", 1, "concat(z.w, '[at]', z.v, '.com')"),
    ("email", 1, "concat(z.w, '.', z.v, ' {at} mail ', '{dot} ', z.v, '.net')"),
    ("email", 0, f"concat(z.w, ' [at] ', {_digits(1, 1)}, '.', {_digits(2, 2)})"),
    ("email", 0, f"concat(z.w, ' (at) ', {_digits(1, 2)}, ' (dot) ', {_digits(3, 2)})"),
    ("ip", 1, _cut("z.h", (4,) * 8, ":")),
    ("ip", 1, _cut("concat('2001', z.h)", (4, 2, 3, 1, 4, 4, 3, 4), ":")),
    ("ip", 0, _cut("z.d", (2,) * 8, ":")),
    ("ip", 0, f"concat('9', {_digits(1, 2)}, '.', {_digits(3, 3)}, '.7', {_digits(6, 2)}, '.', {_digits(8, 1)})"),
    *[("card", 1 - add, _cut(_checked(1, n, add), sizes, sep)) for add in (0, 1) for n, sizes, sep in (
        (16, (4, 4, 4, 4), "."), (16, (4, 4, 4, 4), "  "), (16, (16,), ""), (15, (4, 6, 5), " "), (14, (14,), ""), (13, (13,), ""), (19, (4, 4, 4, 4, 3), "-"))],
    ("card", 0, _cut(_checked(1, 13, 0, "'978'"), (3, 1, 4, 4, 1), "-")),
    ("card", 0, _checked(1, 13, 0, "'979'")),
    ("card", 0, f"concat({_YEAR}, '-', {_MONTH}, '-', {_DAY}, '/', {_YEAR}, '-', {_MONTH}, '-', {_DAY})"),
    ("phone", 1, _cut("concat('2', z.d)", (3, 3, 4), "-")),
    ("phone", 1, _cut("concat('4', z.d)", (3, 3, 4), ".")),
    ("phone", 1, _cut("concat('5', z.d)", (3, 3, 4), " ")),
    ("phone", 1, f"concat('(', {_digits(1, 3)}, ') ', {_digits(4, 3)}, '-', {_digits(7, 4)})"),
    ("phone", 1, f"concat('00', {_digits(1, 2)}, ' ', {_digits(3, 3)}, ' ', {_digits(6, 3)}, ' ', {_digits(9, 4)})"),
    ("phone", 1, f"concat('+', {_digits(1, 2)}, ' ', {_digits(3, 3)}, ' ', {_digits(6, 4)})"),
    ("phone", 0, f"concat({_YEAR}, '-', {_MONTH}, '-', {_DAY})"),
    ("phone", 0, f"concat({_DAY}, '.', {_MONTH}, '.', {_YEAR})"),
    ("phone", 0, f"concat({_MONTH}, '/', {_DAY}, '/', {_YEAR})"),
    ("phone", 0, f"concat('19', {_digits(1, 2)}, '-19', {_digits(3, 2)}, ' ', {_YEAR}, '-20', {_digits(5, 2)})"),
    ("phone", 0, _cut("concat('978', z.d)", (3, 4, 4, 2), " ")),
    ("phone", 0, _cut("concat('978', z.d)", (3, 2, 4, 4), "-")),
    ("phone", 0, _cut("z.d", (2, 2, 2), ".")),
    ("phone", 0, _cut("z.d", (2, 2, 2, 2), " ")),
    ("secret", 1, "concat('token = \\\"', z.h, '\\\"')"),
    ("secret", 1, "concat('api_key: ', substring(z.h, 1, 32))"),
    ("secret", 1, "concat('password=', z.w, upper(z.v), substring(z.h, 1, 12))"),
    ("secret", 0, "concat('token: ', z.w, '-', z.v, '-', z.w)"),
    ("secret", 0, "concat('secret = ', z.w, '_', z.v, '_', z.w, z.v)"),
]
_WORDY = "translate({}, '0123456789', 'ghijklmnop')"
_HASHED = (
    "struct(concat(lpad(CAST(pmod(xxhash64(x.m, 1), 1000000000000000000) AS STRING), 18, '7'), lpad(CAST(pmod(xxhash64(x.m, 2), 1000000000000000000) AS STRING), 18, '3')) AS d, "
    f"sha1(x.m) AS h, {_WORDY.format('substring(md5(x.m), 1, CAST(pmod(xxhash64(x.m, 3), 9) AS INT) + 2)')} AS w, {_WORDY.format('substring(md5(x.m), 17, CAST(pmod(xxhash64(x.m, 4), 9) AS INT) + 3)')} AS v, x.before AS before, x.after AS after)"
)


def _negative(kind: str) -> str:
    """SQL: candidate ``x``, which overlaps no valid base match of its kind, is a negative example."""
    if kind == "email":  # no base match is invalid; no host ends in anything but letters
        return "NOT x.m RLIKE '[A-Za-z]{2,}$'"
    if kind == "card":
        return f"NOT (length({_DIGITS.format(m='x.m')}) BETWEEN 13 AND 19 AND {_luhn('x.m')})"
    if kind == "secret":
        return "NOT x.m RLIKE '[0-9]'"
    return _overlaps("x", f"_raw_{kind}")


def _in_context(x: str) -> str:
    return (
        f"substring(_text, CAST(greatest({x}.start - {CONTEXT}, 0) + 1 AS INT), CAST(least({x}.start, {CONTEXT}) AS INT)) AS before, "
        f"substring(_text, CAST({x}.stop + 1 AS INT), 1) AS after"
    )


def candidates(df: DataFrame) -> DataFrame:
    """``base_spans`` output with ``_cands``: every generator's spans with features and ``label``
    (1, 0, or null where the base patterns do not decide)."""
    for k in ALL_KINDS:
        df = _found(df, f"_loose_{k}", LOOSE[k], LOOSE_GUARD[k])
    df = df.withColumns({"_raw_secret": F.expr(f"CAST(array() AS {_SPAN})"), "_base_secret": F.expr(f"CAST(array() AS {_SPAN})")})
    parts = [
        f"transform(concat(_raw_{k}, _loose_{k}), x -> struct({i} AS kind, x.start AS start, x.stop AS stop, x.m AS m, {_in_context('x')}, "
        f"CASE WHEN {_overlaps('x', f'_base_{k}')} THEN 1 WHEN {_negative(k)} THEN 0 END AS label))"
        for i, k in enumerate(ALL_KINDS)
    ]
    fields = ("kind", "start", "stop", "m", "before", "after", "label")
    return df.withColumn("_plain", F.expr(f"concat({', '.join(parts)})")).withColumn("_cands", F.expr(_featured("_plain", fields))).drop("_plain")


def planted(df: DataFrame) -> DataFrame:
    """``base_spans`` output as one row for each rewriting of each valid base match: ``x``, with features and ``label``."""
    matches = ", ".join(f"transform(_base_{k}, x -> struct(x.m AS m, {_in_context('x')}))" for k in KINDS)
    seeds = df.select(F.explode(F.expr(f"concat({matches})")).alias("x")).select(F.expr(_HASHED).alias("z"))
    each = ", ".join(
        f"struct({ALL_KINDS.index(k)} AS kind, {sql} AS m, z.before AS before, z.after AS after, {label} AS label)" for k, label, sql in PLANTED
    )
    rows = seeds.select(F.explode(F.expr(f"array({each})")).alias("x"))
    return rows.select(F.expr(f"element_at({_featured('array(x)', ('kind', 'm', 'before', 'after', 'label'))}, 1)").alias("x"))


class SpanModel:
    """SQL for the score of a candidate ``x``, and the threshold of each kind."""

    def __init__(self, score: str | None, thresholds: dict[int, float], trees=None) -> None:
        self.score, self.thresholds, self.trees = score, thresholds, trees

    def accepts(self) -> str:
        if not self.thresholds:
            return "false"
        whens = " ".join(f"WHEN {k} THEN {v!r}D" for k, v in sorted(self.thresholds.items()))
        return f"coalesce({self.score} >= CASE x.kind {whens} END, false)"


def _tree_sql(node, names: list[str]) -> str:
    if node.numDescendants() == 0:
        return f"{node.prediction()!r}D"
    s = node.split()
    left, right = _tree_sql(node.leftChild(), names), _tree_sql(node.rightChild(), names)
    return f"IF(x.f_{names[s.featureIndex()]} <= {s.threshold()!r}D, {left}, {right})"


def examples(docs: DataFrame) -> DataFrame:
    """The found and planted examples of all ``docs``, equal ones counted: ``kind_id, label, held``, the
    features and ``n``. Features are small numbers, so there are few rows for any corpus, and copies
    of a text only raise counts."""
    df = base_spans(docs)
    found = candidates(df).select(F.explode(F.expr("filter(_cands, c -> c.label IS NOT NULL)")).alias("x"))
    columns = [f"f_{k}" for k in FEATURES]

    def rows(x: DataFrame) -> DataFrame:
        return x.select(
            F.expr("x.kind AS kind_id"), F.expr("CAST(x.label AS DOUBLE) AS label"), F.expr("xxhash64(x.kind, x.m, x.before) % 4 = 0 AS held"),
            *[F.expr(f"x.{c} AS {c}") for c in columns],
        )

    every = rows(found).union(rows(planted(df)))
    return every.groupBy(*every.columns).agg(F.count("*").alias("n"))


def fit_spans(docs: DataFrame, sample: int = SAMPLE, precision: float = PRECISION) -> SpanModel:
    """Fit the trees on at most ``sample`` kinds of labelled candidates of ``docs``, and the
    thresholds on all held-out ones."""
    rows = stored(examples(docs), "pii-examples")
    names = list(FEATURES)
    columns = ["label", *[f"f_{k}" for k in names]]
    train, quota = None, sample // (2 * len(ALL_KINDS))
    for kind in range(len(ALL_KINDS)):
        for label in (0.0, 1.0):
            one = rows.where((F.col("kind_id") == kind) & (F.col("label") == label) & ~F.col("held"))
            one = one.select(*columns).orderBy(F.xxhash64(*columns), *columns).limit(quota)
            train = one if train is None else train.union(one)
    train = stored(train, "pii-sample")
    if train.select("label").distinct().count() < 2:
        return SpanModel(None, {})
    assembled = VectorAssembler(inputCols=[f"f_{k}" for k in names], outputCol="features").transform(train)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(assembled.select("features", "label"))
    parts = [f"{w!r}D * {_tree_sql(t._java_obj.rootNode(), names)}" for t, w in zip(model.trees, model.treeWeights)]
    score = f"round({' + '.join(parts)}, 6)"
    scored = rows.withColumn("score", F.expr(score.replace("x.f_", "f_")))
    return SpanModel(score, span_thresholds(scored, precision), model)


def span_thresholds(scored: DataFrame, precision: float = PRECISION) -> dict[int, float]:
    """The least score of each kind at which the precision over all held-out examples of ``scored``
    (``kind_id, label, held, score, n``) is ``precision``. A kind with no held-out example takes all it has."""
    by_score = scored.groupBy("kind_id", "held", "score").agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n"))
    by_score = by_score.withColumn("any_held", F.expr("max(held) OVER (PARTITION BY kind_id)")).where("held OR NOT any_held")
    over = "OVER (PARTITION BY kind_id ORDER BY score DESC)"
    ranked = by_score.select("kind_id", "score", F.expr(f"sum(good) {over} / sum(n) {over} AS p"))
    least = ranked.where(F.col("p") >= precision).groupBy("kind_id").agg(F.min("score").alias("score"))
    return {r.kind_id: r.score for r in least.collect()}  # one row per kind


def personal_spans(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """``docs`` with ``_text``, ``_base_<kind>`` and ``_all_<kind>`` (base and added spans,
    ``start, stop`` in code points, sorted). Columns of ``docs`` with such names, or with those of
    ``base_spans`` and ``candidates``, are replaced."""
    model = model or fit_spans(docs)
    df = candidates(base_spans(docs))
    any_base = " OR ".join(_overlaps("x", f"_base_{k}") for k in KINDS)
    more = f"filter(_cands, x -> x.label IS NULL AND NOT ({any_base}) AND {model.accepts()})"
    df = df.withColumn("_more", F.expr(more))
    every = {
        f"_all_{k}": F.expr(
            f"array_sort(array_union(transform(_base_{k}, x -> named_struct('start', x.start, 'stop', x.stop)), "
            f"transform(filter(_more, x -> x.kind = {i}), x -> named_struct('start', x.start, 'stop', x.stop))))"
        )
        for i, k in enumerate(ALL_KINDS)
    }
    return df.withColumns(every)


def _listed(prefix: str) -> str:
    parts = [f"transform({prefix}{k}, x -> concat('{k}:', x.start, ':', x.stop))" for k in ALL_KINDS]
    return f"array_join(concat({', '.join(parts)}), ',')"


def redact(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """``docs`` with the same columns, each text's spans replaced by ``[<KIND>]``; overlapping
    spans are replaced together, by the kind of the first. Texts without spans stay as they are."""
    model = model or fit_spans(docs)
    df = personal_spans(packed(docs, "text"), model)
    spans = ", ".join(
        f"transform(_all_{k}, x -> named_struct('start', x.start, 'stop', x.stop, 'kind', '[{k.upper()}]'))" for k in ALL_KINDS
    )
    df = df.withColumn("_sorted", F.expr(f"array_sort(concat({spans}))"))
    text = (
        "aggregate(_sorted, named_struct('pos', 0L, 'out', ''), (a, x) -> named_struct("
        "'pos', greatest(a.pos, x.stop), "
        "'out', IF(x.start < a.pos, a.out, concat(a.out, substring(_text, CAST(a.pos + 1 AS INT), CAST(x.start - a.pos AS INT)), x.kind))), "
        "a -> concat(a.out, substring(_text, CAST(a.pos + 1 AS INT))))"
    )
    changed = df.withColumn("_new", F.expr(f"IF(size(_sorted) = 0, text, {text})"))
    return unpacked(changed, docs, text=F.col("_new"))


def q_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    df = personal_spans(docs)
    return df.select(
        "doc_id",
        *[F.expr(f"CAST(size(_base_{k}) AS BIGINT) AS n_{k}") for k in KINDS],
        F.expr(f"sha2({_listed('_base_')}, 256) AS base_sha256"),
        F.expr(f"{_listed('_all_')} AS spans"),
        F.expr(f"CAST({' + '.join(f'size(_all_{k})' for k in ALL_KINDS)} AS BIGINT) AS n_spans"),
    )
