"""DuckDB SQL of the training-data queries, where SQL can express them.

The others tokenize, fit a model, link components or write archives; tests
hold those against brute-force versions.
"""

from __future__ import annotations

from cardwatch.llm.linededup import MIN_WORDS, SHARED_DOCS, SHARED_WORDS
from cardwatch.llm.repetition import LINE_LIMIT, NGRAM_LIMITS
from cardwatch.llm.substrings import WINDOW

_WORD = r"'[^\x20\x09-\x0D]+'"

_REPEATED_WINDOWS = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), {_WORD}) AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - {WINDOW - 1})) AS p FROM docs),
windows AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + {WINDOW - 1}], ' ')) AS w FROM starts),
twice AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p + k AS i FROM windows JOIN twice USING (w), range({WINDOW}) r(k)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS i FROM docs),
kept AS (SELECT words.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY words.i) AS t
    FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - COALESCE(k.n, 0))::BIGINT AS n_removed,
    sha256(COALESCE(k.t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id"""


def _quality() -> str:
    sizes = list(NGRAM_LIMITS)
    keys = ",\n".join(
        f"CASE WHEN i <= n_words - {n - 1} THEN md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i "
        f"ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)) END AS g{n}" for n in sizes)
    marks = ",\n".join(f"(g{n} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g{n}) > 1) AS r{n}" for n in sizes)
    inside = ",\n".join(
        f"max(r{n}::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}" for n in sizes)
    sums = ", ".join(f"sum(c{n} * chars) AS s{n}" for n in sizes)
    shares = ", ".join(f"COALESCE(s{n}, 0)::DOUBLE / greatest(word_chars, 1)::DOUBLE AS dup_{n}gram_share" for n in sizes)
    over = " OR ".join(f"dup_{n}gram_share > {limit}" for n, limit in NGRAM_LIMITS.items())
    return f"""
WITH docs AS (SELECT doc_id, COALESCE(text, '') AS t, regexp_extract_all(COALESCE(text, ''), {_WORD}) AS ws FROM documents),
words AS (SELECT doc_id, len(ws) AS n_words, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS i FROM docs),
keyed AS (SELECT doc_id, i, length(word) AS chars, {keys} FROM words),
marked AS (SELECT doc_id, i, chars, {marks} FROM keyed),
covered AS (SELECT doc_id, chars, {inside} FROM marked),
ngrams AS (SELECT doc_id, sum(chars) AS word_chars, sum(c5) AS n_repeat_words, {sums} FROM covered GROUP BY doc_id),
split AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line,
    unnest(generate_series(1, len(string_split(t, chr(10))))) AS i FROM docs),
lines AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS copy FROM split
    WHERE regexp_matches(line, {_WORD})),
dups AS (SELECT doc_id, count(*) AS n_dup_lines,
    sum(length(array_to_string(regexp_extract_all(line, {_WORD}), ''))) AS dup_chars FROM lines WHERE copy > 1 GROUP BY doc_id),
measures AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, COALESCE(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, COALESCE(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    COALESCE(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    COALESCE(dup_chars, 0)::DOUBLE / greatest(COALESCE(word_chars, 0), 1)::DOUBLE AS dup_line_share,
    {shares.replace("greatest(word_chars", "greatest(COALESCE(word_chars, 0)")}
    FROM docs d LEFT JOIN ngrams n ON d.doc_id = n.doc_id LEFT JOIN dups u ON d.doc_id = u.doc_id),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measures)
SELECT *, NOT base_failed AND NOT (dup_line_share > {LINE_LIMIT} OR {over}) AS kept FROM judged"""


def _lines() -> str:
    windows = "\nUNION ".join(
        f"SELECT doc_id, i, min(j) AS j FROM pairs WHERE words >= {floor} GROUP BY doc_id, i\n"
        f"UNION SELECT doc_id, max(i) AS i, j FROM pairs WHERE words >= {floor} GROUP BY doc_id, j"
        for floor in (MIN_WORDS, SHARED_WORDS)
    )
    return f"""
WITH split AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    unnest(generate_series(1, len(string_split(text, chr(10))))) AS pos FROM documents),
counted AS (SELECT *, len(regexp_extract_all(line, {_WORD})) AS words FROM split),
worded AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i, md5(line) AS k, words,
    sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS total FROM counted WHERE words > 0),
pairs AS (SELECT a.doc_id, a.i, b.i AS j, b.total - a.total + a.words AS words
    FROM worded a JOIN worded b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + {MIN_WORDS - 1}),
windows AS ({windows}),
lists AS (SELECT doc_id, list(k ORDER BY i) AS ks, list(words ORDER BY i) AS ws FROM worded GROUP BY doc_id),
keyed AS (SELECT w.doc_id, w.i, w.j, md5(array_to_string(ks[w.i:w.j], ',')) AS k, list_sum(ws[w.i:w.j]) AS words
    FROM windows w JOIN lists USING (doc_id)),
shared AS (SELECT k, count(DISTINCT doc_id) AS docs FROM keyed GROUP BY k),
later AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS later FROM keyed),
gone AS (SELECT DISTINCT doc_id, i + x AS i FROM later JOIN shared USING (k), range({MIN_WORDS}) r(x)
    WHERE later AND i + x <= j AND (words >= {MIN_WORDS} OR docs >= {SHARED_DOCS})),
away AS (SELECT w.doc_id, w.pos, w.i FROM worded w JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i),
runs AS (SELECT doc_id, count(*) AS n_removed, sum((i <> before + 1)::INT) AS n_runs
    FROM (SELECT doc_id, i, COALESCE(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1) AS before FROM away) x GROUP BY doc_id),
rest AS (SELECT s.doc_id, string_agg(line, chr(10) ORDER BY s.pos) AS t
    FROM split s ANTI JOIN away a ON s.doc_id = a.doc_id AND s.pos = a.pos GROUP BY s.doc_id),
sizes AS (SELECT doc_id, count(*) AS n_lines FROM worded GROUP BY doc_id)
SELECT d.doc_id, COALESCE(n_lines, 0)::BIGINT AS n_lines, COALESCE(n_removed, 0)::BIGINT AS n_removed,
    COALESCE(n_runs, 0)::BIGINT AS n_runs, sha256(COALESCE(t, '')) AS text_sha256
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN runs USING (doc_id) LEFT JOIN rest USING (doc_id)"""


_NEAR = f"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORD}) AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 2, 1))) AS p FROM docs WHERE len(ws) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[p:p + 2], ' ') AS s FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes u ON x = u.doc_id JOIN sizes v ON y = v.doc_id WHERE 100 * c >= 85 * (u.n + v.n - c)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, COALESCE(n, 0)::BIGINT AS n_shingles, least(d.doc_id, COALESCE(y, d.doc_id)) AS component_id,
    d.doc_id = least(d.doc_id, COALESCE(y, d.doc_id)) AS kept
FROM docs d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON d.doc_id = x"""


_EXACT = """
WITH d AS (SELECT doc_id, sha256(regexp_replace(COALESCE(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
    row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)"""

_AUDIT = f"""
WITH RECURSIVE d AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS t,
    regexp_extract_all(COALESCE(text, ''), {_WORD}) AS ws FROM documents),
judged AS (SELECT part, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    COALESCE(doc_id > min(doc_id) OVER (PARTITION BY sha256(t)), false) AS e,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) AS good,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1) AS toxic FROM d),
cells AS (SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
    CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails, count(*) AS n,
    count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM judged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT '' AS o UNION ALL SELECT o || f FROM orders, letters WHERE NOT contains(o, f)),
steps AS (SELECT o AS filter_order, s::INT AS step, o[s:s] AS f, o[1:s - 1] AS earlier FROM orders, range(1, 6) r(s) WHERE length(o) = 5),
counted AS (SELECT part, filter_order, step, f,
    sum(n) FILTER (WHERE NOT contains(fails, f) AND translate(fails, earlier, '') = fails) AS kept,
    sum(n) FILTER (WHERE contains(fails, f) AND translate(fails, earlier, '') = fails) AS removed,
    sum(n) FILTER (WHERE contains(fails, f) AND translate(fails, earlier, '') <> fails) AS redundant,
    sum(n) FILTER (WHERE fails = f) AS unique_fails,
    sum(good) FILTER (WHERE contains(fails, f) AND translate(fails, earlier, '') = fails) AS good_lost,
    sum(toxic) FILTER (WHERE contains(fails, f) AND translate(fails, earlier, '') = fails) AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, COALESCE(kept, 0)::BIGINT AS kept, COALESCE(removed, 0)::BIGINT AS removed,
    COALESCE(redundant, 0)::BIGINT AS redundant, COALESCE(unique_fails, 0)::BIGINT AS unique_fails,
    COALESCE(good_lost, 0)::BIGINT AS good_lost, COALESCE(toxic_lost, 0)::BIGINT AS toxic_lost,
    (sum(COALESCE(removed, 0)) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM counted"""


def _middle() -> str:
    number = lambda k: (
        f"list_sum(list_transform(range(1, 9), lambda i: (instr('0123456789abcdef', h[{8 * k} + i:{8 * k} + i]) - 1) * (16 ** (8 - i))::BIGINT))::BIGINT")
    return f"""
WITH d AS (SELECT doc_id, COALESCE(text, '') AS t, sha256('1:' || COALESCE(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (SELECT doc_id, t, length(t)::BIGINT AS n, {number(0)} % (length(t) + 1) AS x, {number(1)} % (length(t) + 1) AS y,
    {number(2)} % 100 AS p, {number(3)} % 100 AS q FROM d),
cut AS (SELECT doc_id, t, n, least(x, y) AS lo, greatest(x, y) AS hi,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR p >= 90 THEN 'plain'
        WHEN q < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, substr(t, 1, lo) AS a, substr(t, lo + 1, hi - lo) AS m, substr(t, hi + 1) AS z FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN hi - lo END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m
        ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts"""


SQL: dict[str, str] = {
    "op3_near_duplicates": _NEAR,
    "op6_line_dedup": _lines(),
    "op9_quality_rules": _quality(),
    "op10_substring_dedup": _REPEATED_WINDOWS,
    "op11_exact_dedup": _EXACT,
    "op12_filter_audit": _AUDIT,
    "op13_fill_in_middle": _middle(),
}
