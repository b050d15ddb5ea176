"""DuckDB SQL of those text queries that SQL can express.

The others are tested against brute-force versions: shuffles and models have no
result SQL determines, DuckDB has no XXH64, and the rest is string work on trees.
"""

from __future__ import annotations

from . import quality_rules

# Texts below hold no lone NUL and DuckDB's regular expressions know no \x in classes of text, hence the escapes.
BLANKS = r"[\t\n\x0B\f\r ]+"

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_exact_dedup"] = rf"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{BLANKS}', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)"""

ORACLE_SQL["op2_suffix_dedup"] = """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
w AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 49)) AS s, h FROM d),
k AS (SELECT doc_id, s, substr(h, 2 * s + 1, 100) AS win FROM w),
f AS (SELECT win, min(doc_id) AS first_id, max(doc_id) AS last_id FROM k GROUP BY win HAVING min(doc_id) < max(doc_id)),
r AS (SELECT k.doc_id, k.s, k.s > 50 + max(k.s) OVER (PARTITION BY k.doc_id ORDER BY k.s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap
      FROM k JOIN f USING (win) WHERE k.doc_id > f.first_id),
g AS (SELECT doc_id, s, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM r),
spans AS (SELECT doc_id, run, min(s) AS a, max(s) + 50 AS b FROM g GROUP BY doc_id, run),
cut AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_here FROM spans),
kept AS (SELECT c.doc_id, string_agg(substr(h, 2 * from_here + 1, 2 * (a - from_here)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS t,
                sum(b - a) AS removed, count(*) AS n FROM cut c JOIN d USING (doc_id) GROUP BY c.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(t, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_ESCAPED = r"""replace(replace({0}, '\', '\\'), '<|', '<\|')"""
ORACLE_SQL["op3_chat_formatting"] = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
o AS (SELECT *, row_number() OVER seq AS n, role IS DISTINCT FROM lag(role) OVER seq AS fresh FROM c WINDOW seq AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length({_ESCAPED.format("text")}) + CASE WHEN fresh THEN length('<|im_start|>' || replace({_ESCAPED.format("role")}, chr(10), '<\\n')) + 1 + length('<|im_end|>') + 1
            ELSE length('<|turn|>') END) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id"""

ORACLE_SQL["op8_phrase_dedup"] = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{BLANKS}'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(0, len(w) - 12)) AS s, w FROM d),
k AS (SELECT doc_id, s, array_to_string(w[s + 1:s + 13], ' ') AS win FROM p),
f AS (SELECT win, min(doc_id) AS first_id FROM k GROUP BY win HAVING min(doc_id) < max(doc_id)),
r AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS i FROM k JOIN f USING (win) WHERE doc_id > first_id),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM d),
kept AS (SELECT x.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY x.i) AS t FROM x ANTI JOIN r ON x.doc_id = r.doc_id AND x.i = r.i GROUP BY x.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE_SQL["op13_collocation_mining"] = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_ALPHABET}', '{_ALPHABET.lower()}'), '[.,;:!?

]')) AS piece
           FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[	 ]+'), lambda x: x <> '') AS w FROM p),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
x AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
f AS (SELECT lang, k, w[i:i + k - 1] AS gram, count(*) AS f FROM x, (VALUES (1), (2), (3)) t(k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
around AS (SELECT lang, gram, max(f) AS f FROM (SELECT lang, gram[1:2] AS gram, f FROM f WHERE k = 3 UNION ALL SELECT lang, gram[2:3], f FROM f WHERE k = 3) GROUP BY ALL),
c AS (SELECT f.* FROM f LEFT JOIN around USING (lang, gram) WHERE k > 1 AND (around.f IS NULL OR 100 * around.f < 50 * f.f)),
cuts AS (SELECT c.lang, c.gram, c.f AS a, cut, l.f AS l, r.f AS r, CAST(1000000::HUGEINT * c.f * c.f // (l.f::HUGEINT * r.f) AS BIGINT) AS score
         FROM c, (VALUES (1), (2)) t(cut), f AS l, f AS r
         WHERE cut < c.k AND l.lang = c.lang AND r.lang = c.lang AND l.gram = c.gram[1:cut] AND r.gram = c.gram[cut + 1:c.k]),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) = 1),
named AS (SELECT *, array_to_string(gram, ' ') AS phrase FROM weakest)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM named JOIN total USING (lang) QUALIFY rank <= 2000"""

_RULES, _LOSS = quality_rules.RULES, quality_rules.RISK / len(quality_rules.RULES)
_LADDER = ", ".join(f"({i}, {s}, {c})" for i, r in enumerate(_RULES) for s, c in enumerate(r.steps()))
_VALUES = ", ".join(f"{'-' if r.low else ''}(1000 * {r.count} // greatest(n_words, 1))" for r in _RULES)
ORACLE_SQL["op12_quality_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(lang, 'und') AS lang, coalesce(text, '') AS t,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '{BLANKS}'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT row, unnest(range(0, len(w) - 4)) AS s, w FROM d),
k AS (SELECT row, s, count(*) OVER (PARTITION BY row, w[s + 1:s + 5]) AS n FROM p),
rep AS (SELECT row, count(DISTINCT i) AS n FROM (SELECT row, unnest(range(s, s + 5)) AS i FROM k WHERE n > 1) GROUP BY row),
l AS (SELECT row, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT row, count(*) - count(DISTINCT line) AS n FROM l WHERE regexp_replace(line, '{BLANKS}', '', 'g') <> '' GROUP BY row),
m AS (SELECT row, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '{BLANKS}', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN dup USING (row) LEFT JOIN rep USING (row)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, [{_VALUES}] AS v FROM m),
label AS (SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT doc_id, lang, good, r, max(v[r + 1]) AS v FROM b JOIN label USING (doc_id), range(0, {len(_RULES)}) t(r) WHERE NOT base_failed GROUP BY ALL),
tally AS (SELECT lang, r, step, cutoff, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad, count(*) FILTER (good AND v > cutoff) AS lost,
                 count(*) FILTER (NOT good AND v > cutoff) AS caught FROM held, (VALUES {_LADDER}) c(r2, step, cutoff) WHERE r2 = r GROUP BY ALL),
open AS (SELECT *, (SELECT count(DISTINCT lang) FROM tally WHERE good > 0) * {len(_RULES)} AS tests FROM tally WHERE good > 0 AND lost < good * {_LOSS!r}),
chance AS (SELECT lang, r, step, sum(exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) + i * ln({_LOSS!r}) + (good - i) * ln(1 - {_LOSS!r}))) AS p
           FROM (SELECT *, unnest(range(0, lost + 1)) AS i FROM open) GROUP BY ALL),
chosen AS (SELECT lang, r, cutoff FROM open JOIN chance USING (lang, r, step) WHERE p <= {quality_rules.ERROR!r} / tests AND caught::HUGEINT * good > lost::HUGEINT * bad
           QUALIFY row_number() OVER (PARTITION BY lang, r ORDER BY caught::HUGEINT * good - lost::HUGEINT * bad DESC, step) = 1),
bad AS (SELECT DISTINCT row FROM b JOIN chosen USING (lang) WHERE v[r + 1] > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.row IS NULL AS kept FROM b LEFT JOIN bad USING (row)"""

# DuckDB has no CRC-32: the table of its byte steps, by its rule.
_STEPS = ("SELECT i, list_reduce(list_concat([i::UBIGINT], range(8)::UBIGINT[]), "
          "lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS step FROM range(256) t(i)")
ORACLE_SQL["op11_conversation_trie"] = rf"""
WITH RECURSIVE steps AS ({_STEPS}), table_of AS (SELECT list(step ORDER BY i) AS steps FROM steps),
c AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS t, 0 AS i, 4294967295::UBIGINT AS x FROM c
        UNION ALL SELECT conv_id, t, i + 1, xor(x // 256, steps[1 + xor(x % 256, ascii(t[i + 1])::UBIGINT)::BIGINT]) FROM crc, table_of WHERE i < length(t)),
h AS (SELECT conv_id, CAST(xor(x, 4294967295::UBIGINT) % 4 AS BIGINT) AS h, conv_id - conv_id % 20 AS base FROM crc WHERE i = length(t)),
r AS (SELECT h.conv_id, p AS i, role, text FROM h JOIN c ON c.conv_id = base AND p < h
      UNION ALL SELECT conv_id, h + p, role, text FROM h JOIN c USING (conv_id) WHERE p >= h),
s AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS depth FROM r),
m AS (SELECT conv_id, depth, text, sha256(string_agg(sha256(role || chr(10)) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS k FROM s
      UNION ALL SELECT conv_id, 0, '', '' FROM h),
n AS (SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(text) AS text FROM m GROUP BY depth, k),
named AS (SELECT m.conv_id AS member, m.depth, n.conv_id, n_convs, n.text, m.depth = max(m.depth) OVER (PARTITION BY m.conv_id) AS final FROM m JOIN n USING (depth, k)),
pairs AS (SELECT DISTINCT a.depth, a.conv_id, b.depth AS below, b.conv_id AS below_id FROM named a JOIN named b ON a.member = b.member AND b.depth >= a.depth),
kids AS (SELECT depth, conv_id, count(*) FILTER (below = depth + 1) AS n_children FROM pairs GROUP BY ALL),
own AS (SELECT n.conv_id, n.depth, n_convs, n_children,
               (n_convs - 1) * len(list_filter(regexp_split_to_array(text, '{BLANKS}'), lambda x: x <> '')) AS saved FROM n JOIN kids USING (depth, conv_id)),
under AS (SELECT p.depth, p.conv_id, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
          FROM pairs p JOIN own ON own.depth = below AND own.conv_id = below_id GROUP BY ALL),
ends AS (SELECT depth, conv_id, sha256(string_agg(CAST(member AS VARCHAR), ',' ORDER BY member)) AS ends_sha256 FROM named WHERE final GROUP BY ALL),
above AS (SELECT below AS depth, below_id AS conv_id, conv_id AS parent_conv_id FROM pairs WHERE below = depth + 1)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM own JOIN under USING (depth, conv_id) LEFT JOIN ends USING (depth, conv_id) LEFT JOIN above USING (depth, conv_id)"""
