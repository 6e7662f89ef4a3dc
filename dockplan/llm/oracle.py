"""DuckDB statements for the queries that SQL can express, over whole tables.

The others need hashes or models that SQL lacks (xxHash, tokenizers, alignments, trained models); tests hold them
against brute force.
"""

from __future__ import annotations

from dockplan.llm.chat import PROBE_ID, PROBE_TEXT
from dockplan.llm.merkle_sql import MERKLE, crc32_sql
from dockplan.llm.quality import RULES, STOP_WORDS
from dockplan.llm.spelling import DAMAGE, FEWEST, LETTERS, RATIO, SHORTEST

SPACE = r"[\x20\x09-\x0D]"


def passes() -> str:
    def one(r) -> str:
        bounds = [f"m >= {r.low}"] if r.low is not None else []
        bounds += [f"m <= {r.high}"] if r.high is not None else []
        return f"(SELECT {' AND '.join(bounds)} FROM (SELECT ({r.metric})::DOUBLE AS m)) AS pass_{r.name}"

    return ",\n       ".join(one(r) for r in RULES)


QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, COALESCE(text, '') AS t FROM documents),
s AS (SELECT *, list_filter(regexp_split_to_array(t, '{SPACE}+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT rid, i, w[i : i + 4] AS five FROM s, unnest(range(1, len(w) - 3)) u(i)),
again AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, five) > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, range(5) r(k) GROUP BY rid),
c AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '{SPACE}', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
             COALESCE(covered.n, 0) AS n_repeat_words, length(t) - length(regexp_replace(t, '\p{{L}}', '', 'g')) AS n_letters,
             length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS n_upper,
             len(list_filter(w, lambda x: list_contains([{", ".join(f"'{x}'" for x in dict.fromkeys(STOP_WORDS))}],
                 translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')))) AS n_stop_words,
             len(l) AS n_lines, len(list_filter(l, lambda x: regexp_matches(x, '^\s*[-*•]'))) AS n_bullet_lines,
             len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS n_ellipsis_lines
      FROM s LEFT JOIN covered USING (rid)),
p AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       {passes()} FROM c)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(f"pass_{r.name}" for r in RULES)} AS kept, {", ".join(f"pass_{r.name}" for r in RULES)}
FROM p
"""

CHAT = rf"""
WITH r AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
           UNION ALL VALUES ({PROBE_ID}, 0, 'user', '{PROBE_TEXT}'), ({PROBE_ID}, 1, 'assistant', '{PROBE_TEXT}')),
a AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
             COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
             sum(length('### : ') + length(' </turn>') + 1 + length(regexp_replace(role, '[\\#<:]', 'xx', 'g'))
                 + length(regexp_replace(text, '[\\#<]', 'xx', 'g'))) AS formatted_chars
      FROM r GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars::BIGINT AS formatted_chars FROM a
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
       list_filter(regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '{SPACE}+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT rid, w[i : i + 4] AS five FROM d, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) u(i)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
common AS (SELECT a.rid AS x, b.rid AS y, count(*) AS shared FROM s a JOIN s b ON a.five = b.five AND a.rid < b.rid GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN n nx ON nx.rid = x JOIN n ny ON ny.rid = y WHERE 100 * shared >= 80 * (nx.n + ny.n - shared)),
step AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(origin, met) AS (SELECT x, y FROM step UNION SELECT origin, y FROM reach JOIN step ON met = x)
SELECT d.doc_id, COALESCE(n.n, 0)::BIGINT AS n_shingles,
       least(d.doc_id, (SELECT min(e.doc_id) FROM reach JOIN d e ON e.rid = reach.met WHERE reach.origin = d.rid)) AS component_id
FROM d LEFT JOIN n USING (rid)
"""

SPELLING = f"""
WITH RECURSIVE t AS (SELECT COALESCE(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(text, '{LETTERS}+')) AS r FROM documents),
runs AS (SELECT d, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
         FROM t WHERE length(r) >= {SHORTEST} GROUP BY ALL),
hashed AS (SELECT run, c, {crc32_sql("d || ':' || run")} AS h FROM runs),
damaged AS (SELECT CASE WHEN h % {DAMAGE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM damaged WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(c) >= {FEWEST}),
-- Words without one letter: two words that share such a rest are one edit apart, if at the same place or one of them is the rest.
gaps AS (SELECT word, n, i, substr(word, 1, i::BIGINT) || substr(word, i::BIGINT + 2) AS rest FROM words, unnest(range(length(word))) u(i)),
near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
         UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word),
best AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM near
         QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
forms AS (SELECT w.word, w.n, COALESCE(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= {RATIO} * w.n THEN near END AS form,
                 CASE WHEN near_n >= {RATIO} * w.n THEN near_n END AS form_n FROM words w LEFT JOIN best USING (word)),
way AS (SELECT word, word AS at FROM forms UNION ALL SELECT way.word, f.form FROM way JOIN forms f ON f.word = way.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, way.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN way ON way.word = f.word
JOIN forms e ON e.word = way.at AND e.form IS NULL
"""

ORACLE = {
    "op6_quality_rules": QUALITY,
    "op7_event_sourced_chat": CHAT,
    "op9_grouped_prefix_join": NEAR_DUPLICATES,
    "op11_spelling_variants": SPELLING,
    "op12_merkle_manifest": MERKLE,
}
