"""DuckDB SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

# One row per word, with its place in the text.
_WORDS = (
    f"SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM (SELECT doc_id, "
    f"regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents)"
)


def _quality() -> str:
    # metric, its value, and its limits from the quantiles of the group (q..) and of all values over 0 (low..)
    metrics = {
        "symbols": ("n_symbols * 1000 // greatest(word_chars, 1)", "greatest(q85 + 3 * (q85 - q50), coalesce(low5, 0))", "0"),
        "dup_lines": ("n_dup_lines * 1000 // greatest(n_words, 1)", "greatest(q99 + 3 * (q99 - q50), coalesce(low95, 0))", "0"),
        "repeats": ("n_repeat_words * 1000 // greatest(n_words, 1)", "greatest(q99 + 3 * (q99 - q50), coalesce(low95, 0))", "0"),
        "word_length": ("word_chars * 100 // greatest(n_words, 1)", "greatest(q95 + 3 * (q95 - q50), 0)", "b5 - 3 * (q50 - b5)"),
    }
    shift = "(length(bin(value)) - 6)"
    bucket = f"CASE WHEN value < 64 THEN value ELSE 32 * {shift} + (value >> {shift}) END"
    top = "CASE WHEN bucket < 64 THEN bucket ELSE ((bucket % 32 + 33) << CAST(bucket // 32 - 1 AS BIGINT)) - 1 END"
    values = " UNION ALL ".join(
        f"SELECT lang, source, '{k}' AS metric, CAST({v} AS BIGINT) AS value FROM feats WHERE NOT base_failed" for k, (v, _, _) in metrics.items()
    )
    bottom = "CASE WHEN bucket < 64 THEN bucket ELSE (bucket % 32 + 32) << CAST(bucket // 32 - 1 AS BIGINT) END"
    # 50 documents spread like the coarser sketch
    prior = "SELECT {keys}metric, bucket, 50 * n / sum(n) OVER (PARTITION BY {keys}metric) AS n FROM {of}"

    def quantiles(of: str, keys: str, percents: tuple[int, ...], name: str) -> str:
        ends = lambda p: ((top, f"{name}{p}"), (bottom, f"b{p}"))
        at = ", ".join(f"min(CASE WHEN 100 * upto >= ({p} - 1e-9) * total THEN {v} END) AS {c}" for p in percents for v, c in ends(p))
        sums = f"sum(n) OVER (PARTITION BY {keys}metric ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {keys}metric) AS total"
        return f"SELECT {keys}metric, {at} FROM (SELECT {keys}metric, bucket, {sums} FROM {of}) GROUP BY {keys}metric"

    limits = ", ".join(
        f"max(CASE WHEN metric = '{k}' THEN {hi} END) AS max_{k}, max(CASE WHEN metric = '{k}' THEN {lo} END) AS min_{k}" for k, (_, hi, lo) in metrics.items()
    )
    ok = "NOT base_failed" + "".join(f" AND coalesce({v} <= max_{k} AND {v} >= min_{k}, true)" for k, (v, _, _) in metrics.items())
    return (
        f"WITH words AS ({_WORDS}), runs AS (SELECT doc_id, p, "
        "CASE WHEN count(*) OVER eight = 8 THEN string_agg(word, ' ') OVER eight END AS run FROM words "
        "WINDOW eight AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)), "
        "twice AS (SELECT doc_id, p, run IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, run) > 1 AS again FROM runs), "
        "inside AS (SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS hit FROM twice), "
        "repeats AS (SELECT doc_id, count(*) FILTER (WHERE hit) AS n_repeat_words FROM inside GROUP BY doc_id), "
        "counts AS (SELECT doc_id, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS word_chars FROM words GROUP BY doc_id), "
        f"lines AS (SELECT doc_id, count(line) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line "
        f"FROM documents) WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id), "
        "feats AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM (SELECT d.doc_id, lang, source, "
        "coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, "
        "CAST(len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols, "
        "coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words "
        "FROM documents d LEFT JOIN counts USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id))), "
        f"sketch AS (SELECT lang, source, metric, {bucket} AS bucket, CAST(count(*) AS DOUBLE) AS n FROM ({values}) GROUP BY ALL), "
        "whole AS (SELECT metric, bucket, sum(n) AS n FROM sketch GROUP BY ALL), "
        f"wp AS ({prior.format(keys='', of='whole')}), by_lang AS (SELECT lang, metric, bucket, sum(n) AS n FROM (SELECT lang, metric, bucket, n FROM sketch "
        "UNION ALL SELECT lang, metric, bucket, wp.n FROM (SELECT DISTINCT lang, metric FROM sketch) JOIN wp USING (metric)) GROUP BY ALL), "
        f"lp AS ({prior.format(keys='lang, ', of='by_lang')}), fine AS (SELECT lang, source, metric, bucket, sum(n) AS n FROM (SELECT lang, source, metric, bucket, n FROM sketch "
        "UNION ALL SELECT g.lang, source, g.metric, bucket, lp.n FROM (SELECT DISTINCT lang, source, metric FROM sketch) g JOIN lp ON g.lang IS NOT DISTINCT FROM lp.lang AND g.metric = lp.metric) GROUP BY ALL), "
        f"q AS ({quantiles('fine', 'lang, source, ', (5, 50, 85, 95, 99), 'q')}), low AS ({quantiles('(SELECT * FROM whole WHERE bucket > 0)', '', (5, 95), 'low')}), "
        f"limits AS (SELECT lang, source, {limits} FROM q LEFT JOIN (SELECT metric, low5, low95 FROM low) USING (metric) GROUP BY lang, source) "
        f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, {ok} AS kept FROM feats f "
        "LEFT JOIN limits m ON f.lang IS NOT DISTINCT FROM m.lang AND f.source IS NOT DISTINCT FROM m.source"
    )


def _covered(tokens: str, each: str) -> str:
    """``doc_id, p, piece, gone`` of every token: whether a 50-token run over it starts in a smaller document."""
    return (
        f"WITH tokens AS ({tokens}), runs AS (SELECT doc_id, p, piece, "
        f"CASE WHEN count(*) OVER w = 50 THEN string_agg(piece, '{each}') OVER w END AS run FROM tokens "
        "WINDOW w AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)), "
        "first AS (SELECT doc_id, p, piece, run IS NOT NULL AND min(doc_id) OVER (PARTITION BY run) < doc_id AS later FROM runs), "
        "marked AS (SELECT doc_id, p, piece, bool_or(later) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM first)"
    )


_SUBSTRING = (
    _covered(_WORDS.replace("AS word", "AS piece"), " ")
    + ", kept AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, "
    "string_agg(piece, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS left_over FROM marked GROUP BY doc_id) "
    "SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(left_over, '')) AS kept_sha256 "
    "FROM documents d LEFT JOIN kept USING (doc_id)"
)

_SUFFIX = (
    _covered(
        "SELECT doc_id, substr(h, 2 * p + 1, 2) AS piece, p FROM (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, "
        "unnest(range(octet_length(encode(coalesce(text, ''))))) AS p FROM documents)",
        "",
    )
    + ", spans AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS begins FROM marked), "
    "kept AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans, "
    "string_agg(piece, '' ORDER BY p) FILTER (WHERE NOT gone) AS left_over FROM spans GROUP BY doc_id) "
    "SELECT d.doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, "
    "sha256(unhex(coalesce(left_over, ''))) AS kept_sha256 FROM documents d LEFT JOIN kept USING (doc_id)"
)

# A text with control strings gets one more backslash before each (with any before it).
_ESCAPED = (
    r"regexp_replace(text, '(\\*(?:<s>|</s>|\[INST\]|\[/INST\]|\[ROLE\]|\[TEXT\]|\[/ROLE\]|\[NOROLE\]))', '\\\1', 'g')"
)
_CHAT = (
    "WITH turns AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL "
    "VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) "
    "SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256, "
    "CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars, "
    "sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256, "
    f"CAST(sum(length({_ESCAPED}) + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 6 ELSE 26 + length(role) END) AS BIGINT) AS formatted_chars "
    "FROM turns GROUP BY conv_id"
)

_BASE32 = (
    "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || "
    "substr(sha1(coalesce(html, '')), CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> (5 * (3 - i % 4))) % 32 + 1 AS INT), 1)), '')"
)
_WARC = (
    f"WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, {_BASE32} AS payload_digest FROM pages), "
    "f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p) "
    "SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, "
    "CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, "
    "CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to FROM f"
)

_NEGATIVES = (
    "WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, "
    "list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE label IS NOT NULL "
    "AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)), "
    "pairs AS (SELECT a.rid, a.vec_id AS anchor_id, c.vec_id AS other, c.label = a.label AS same, "
    "CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score FROM v a JOIN v c ON a.rid <> c.rid WHERE a.vec_id % 50 = 0), "
    "pos AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, other) AS p FROM pairs WHERE same), "
    "found AS (SELECT pos.anchor_id, pos.other AS positive_id, CAST(row_number() OVER (PARTITION BY pos.rid, p ORDER BY n.score DESC, n.other) AS INTEGER) AS rank, "
    "n.other AS negative_id, pos.score AS positive_score, n.score AS negative_score FROM pos JOIN pairs n ON pos.rid = n.rid "
    "AND p <= 5 AND NOT n.same AND 50 * pos.score <= 100 * n.score AND 100 * n.score <= 95 * pos.score) "
    "SELECT * FROM found WHERE rank <= 3"
)

_PIECES = "[^.!?]{1,96}[.!?]*[\\x20\\x09-\\x0D]*|[.!?]+[\\x20\\x09-\\x0D]*"
_IN_SECTION = "[(CASE WHEN j = 1 THEN 1 ELSE ends[j - 1] + 1 END):ends[j]]"
_PRINTS = (
    "a AS (SELECT text, string_split(text, chr(10)) AS lines FROM texts), "
    f"b AS (SELECT *, list_transform(lines, lambda l: list_transform(regexp_extract_all(l, '{_PIECES}'), lambda x: md5(x))) AS leaves FROM a), "
    "c AS (SELECT *, list_transform(leaves, lambda h: md5('p' || coalesce(array_to_string(h, ''), ''))) AS paragraphs FROM b), "
    "e AS (SELECT *, list_filter(range(1, len(paragraphs) + 1), lambda i: i = len(paragraphs) OR lines[i] = '' OR substr(paragraphs[i], 1, 1) < '4') AS ends FROM c), "
    f"f AS (SELECT *, list_transform(range(1, len(ends) + 1), lambda j: md5('s' || array_to_string(paragraphs{_IN_SECTION}, ''))) AS sections, "
    f"list_transform(range(1, len(ends) + 1), lambda j: array_to_string(list_transform(leaves{_IN_SECTION}, lambda h: "
    "coalesce(array_to_string(list_transform(h, lambda x: substr(x, 1, 8)), ''), '')), ',')) AS shapes FROM e), "
    "prints AS (SELECT text, sha256('r' || array_to_string(sections, '')) || ':' || array_to_string(shapes, ';') AS print, "
    "list_distinct(flatten(list_transform(leaves, lambda h: list_transform(h, lambda x: substr(x, 1, 8))))) AS leafs FROM f)"
)
_NEAR = (
    "CASE WHEN len({a}) + len({b}) = 0 THEN 1.0 ELSE CAST(len(list_intersect({a}, {b})) * 2 AS DOUBLE) / (len({a}) + len({b})) END"
)
_FINGERPRINTS = (
    "WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), o AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next "
    "FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), "
    "pairs AS (SELECT *, left(text, length(text) - length(text) // 2) || left(next, length(text) // 2) AS edited FROM o), "
    "texts AS (SELECT text FROM pairs UNION SELECT edited FROM pairs), "
    f"{_PRINTS} SELECT doc_id, length(o.text) AS n_chars, sha256(o.edited) AS edited_sha256, p.print AS fingerprint, q.print AS edited_fingerprint, "
    f"{_NEAR.format(a='p.leafs', b='q.leafs')} AS near_edited, {_NEAR.format(a='p.leafs', b='r.leafs')} AS near_next "
    "FROM pairs o JOIN prints p ON o.text = p.text JOIN prints q ON o.edited = q.text JOIN prints r ON o.next = r.text"
)

# CRC-32 bit by bit over the list b of bytes.
_CRC_IN = "xor(c, CASE WHEN k % 8 = 0 THEN b[k // 8 + 1] ELSE 0 END)"
_CRC = (
    f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], range(8 * len(b))), lambda c, k: "
    f"xor({_CRC_IN} >> 1, 3988292384 * ({_CRC_IN} & 1))), 4294967295)"
)
_VARIANTS = (
    "WITH RECURSIVE runs AS (SELECT doc_id, run, count(*) AS k FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{5,}')) AS run FROM documents) GROUP BY doc_id, run), "
    "bytes AS (SELECT run, k, list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS INT), 2) AS BIGINT)) AS b "
    "FROM (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs)), "
    f"crcs AS (SELECT run, k, {_CRC} AS crc FROM bytes), "
    "words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (SELECT k, CASE WHEN crc % 97 = 0 THEN left(run, crc % length(run)) || substr(run, crc % length(run) + 2) "
    "ELSE run END AS word FROM crcs) WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3), "
    "skips AS (SELECT word, n, left(word, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)), "
    "shorter AS (SELECT DISTINCT s.word, s.n, w.word AS less, w.n AS less_n FROM skips s JOIN words w ON s.a || s.b = w.word), "
    "near AS (SELECT x.word, y.word AS other, y.n FROM skips x JOIN skips y ON x.a = y.a AND x.b = y.b AND x.word <> y.word "
    "UNION ALL SELECT word, less, less_n FROM shorter UNION ALL SELECT less, word, n FROM shorter), "
    "best AS (SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS place FROM near), "
    "forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 2 * w.n THEN other END AS form, CASE WHEN b.n >= 2 * w.n THEN b.n END AS form_n "
    "FROM words w LEFT JOIN best b ON w.word = b.word AND place = 1), "
    "paths AS (SELECT word, word AS root, 0 AS step FROM forms UNION ALL SELECT p.word, f.form, step + 1 FROM paths p JOIN forms f ON p.root = f.word WHERE f.form IS NOT NULL) "
    "SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN (SELECT word, arg_max(root, step) AS root FROM paths GROUP BY word) r ON f.word = r.word"
)

ORACLE_SQL = {
    "op1_quality": _quality(),
    "op2_suffix": _SUFFIX,
    "op3_chat": _CHAT,
    "op5_warc": _WARC,
    "op9_substring": _SUBSTRING,
    "op11_negatives": _NEGATIVES,
    "op12_fingerprints": _FINGERPRINTS,
    "op13_variants": _VARIANTS,
}
