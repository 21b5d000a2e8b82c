"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SUBSTRINGS = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
win AS (SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM d, unnest(range(1, len(w) - 48)) t(i)),
rep AS (SELECT r, i FROM (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM win) WHERE first < doc_id),
gone AS (SELECT DISTINCT r, i + k AS p FROM rep, range(0, 50) o(k)),
each AS (SELECT r, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) t(p)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS s FROM each ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(g.n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN (SELECT r, count(*) AS n FROM gone GROUP BY r) g USING (r)
"""

BYTES = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT r, i, md5_number(substr(h, 2 * i + 1, 400)) AS s FROM d, unnest(range(0, CAST(len(h) // 2 - 199 AS BIGINT))) t(i)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS c FROM win) WHERE c > 1),
ends AS (SELECT r, i, max(i + 200) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM rep),
runs AS (SELECT r, i, sum(CASE WHEN upto IS NULL OR i > upto THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM ends),
spans AS (SELECT r, run, min(i) AS s, max(i) + 200 AS e FROM runs GROUP BY r, run),
edges AS (SELECT r, s, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS before FROM spans),
per AS (SELECT r, CAST(sum(e - s) AS BIGINT) AS n, count(*) AS k, max(e) AS last FROM spans GROUP BY r),
kept AS (SELECT r, string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS head FROM edges JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n, 0) AS n_removed, coalesce(k, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN per USING (r) LEFT JOIN kept USING (r)
"""

MIX = rf"""
WITH s AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
        FROM s GROUP BY source),
lv AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o1, 0)) / sum(weight) OVER o2 AS level, sum(source_size) OVER () AS total
       FROM src WINDOW o1 AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                       o2 AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
tg AS (SELECT source, source_size, total, least(CAST(3 * source_size AS DOUBLE), max(level) OVER () * weight) AS target FROM lv),
q AS (SELECT row_number() OVER () AS r, s.doc_id, s.source, s.size, s.k, source_size, target, total,
             sum(size) OVER (PARTITION BY s.source ORDER BY k, size, doc_id) AS cum
      FROM s JOIN tg ON s.source IS NOT DISTINCT FROM tg.source),
ev AS (SELECT r, size, total, sum(size) OVER (ORDER BY (cum + e * source_size) / target, source NULLS LAST, k, e ROWS UNBOUNDED PRECEDING) AS upto
       FROM q, range(0, 3) p(e) WHERE size > 0 AND target > 0),
tk AS (SELECT r, sum(greatest(0, least(size, total - (upto - size)))) AS taken FROM ev GROUP BY r)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM q LEFT JOIN tk USING (r)
"""

NEAR = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, md5_number(array_to_string(w[i:i + 4], ' ')) AS g FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_in AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM both_in JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.v FROM reach r JOIN both_ways e ON r.b = e.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) m USING (doc_id)
"""

SNAPSHOTS = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos,
             count(*) OVER (PARTITION BY conv_id) AS n FROM t),
x AS (SELECT conv_id, pos, n,
             string_agg(coalesce('+' || role, '-') || chr(1) || coalesce('+' || text, '-'), chr(2)) OVER w AS pre,
             string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '') OVER w AS chat
      FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING))
SELECT min(conv_id) AS conv_id, any_value(n) AS n_turns, count(*) AS n_copies, any_value(chat) AS chat
FROM x WHERE pos = n AND pre NOT IN (SELECT pre FROM x WHERE pos < n) GROUP BY pre
"""

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: length(translate(s, {SPACES}, '')) > 0) AS ls FROM documents),
tri AS (SELECT r, md5_number(array_to_string(w[i:i + 2], ' ')) AS g, list(i) AS places FROM (SELECT r, w FROM d), unnest(range(1, len(w) - 1)) t(i)
        GROUP BY ALL HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM tri, unnest(places) t(i), range(0, 3) o(k) GROUP BY r),
s AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, length(translate(text, {SPACES}, '')) AS word_chars,
             length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, length(text) - length(translate(text, '!', '')) AS bangs,
             CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
      FROM d LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * bangs > 5 * n_words OR 100 * n_dup_lines > 50 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM b
"""


def _field(x: str) -> str:
    return f"coalesce(strlen({x}) || ':' || {x}, '-')"


MANIFEST = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS key, source, lang, n_chars, text FROM documents),
crc AS (SELECT r, xor(4294967295, list_reduce(
            flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
            lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, 4294967295)) AS crc
        FROM d WHERE doc_id IS NOT NULL),
s AS (SELECT r, doc_id, key, {_field('CAST(doc_id AS VARCHAR)')} || {_field('source')} || {_field('lang')} AS head, n_chars, {_field('text')} AS tail, coalesce(crc % 7 = 0, false) AS hit
      FROM d LEFT JOIN crc USING (r)),
leaf AS (SELECT r, doc_id, key, sha256(head || {_field('CAST(n_chars AS VARCHAR)')} || tail) AS leaf,
                sha256(head || {_field('CAST(n_chars + CAST(hit AS INT) AS VARCHAR)')} || tail) AS new FROM s),
num AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY key) AS m FROM leaf),
up AS (SELECT key, 0 AS lvl, pos, m, leaf AS digest FROM num
       UNION ALL SELECT key, lvl + 1, pos // 2, (m + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM up WHERE m > 1 GROUP BY key, lvl, pos // 2, m),
sub AS (SELECT key, digest AS subroot, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS m FROM up WHERE m = 1),
top AS (SELECT 0 AS lvl, pos, m, subroot AS digest FROM sub
        UNION ALL SELECT lvl + 1, pos // 2, (m + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE m > 1 GROUP BY lvl, pos // 2, m),
fold AS (SELECT r, key, 0 AS lvl, pos, m, new AS cur, '' AS proof FROM num
         UNION ALL SELECT f.r, f.key, f.lvl + 1, f.pos // 2, (f.m + 1) // 2,
                sha256(CASE WHEN f.pos % 2 = 1 THEN u.digest || f.cur ELSE f.cur || coalesce(u.digest, '') END), f.proof || coalesce(u.digest, '')
         FROM fold f LEFT JOIN up u ON u.key = f.key AND u.lvl = f.lvl AND u.pos = xor(f.pos, 1) WHERE f.m > 1),
fold2 AS (SELECT r, key, 0 AS lvl, sub.pos, sub.m, cur, proof, subroot FROM fold JOIN sub USING (key) WHERE fold.m = 1
          UNION ALL SELECT f.r, f.key, f.lvl + 1, f.pos // 2, (f.m + 1) // 2,
                sha256(CASE WHEN f.pos % 2 = 1 THEN u.digest || f.cur ELSE f.cur || coalesce(u.digest, '') END), f.proof || coalesce(u.digest, ''), subroot
          FROM fold2 f LEFT JOIN top u ON u.lvl = f.lvl AND u.pos = xor(f.pos, 1) WHERE f.m > 1)
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = t.digest AS verified
FROM num JOIN (SELECT * FROM fold2 WHERE m = 1) f USING (r), (SELECT digest FROM top WHERE m = 1) t
"""


def _cased(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = "(" + "|".join(map(_cased, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _gram_order(k: int) -> str:
    """Witten-Bell step from p{k} to p{k + 1}: order k over the orders below it, for both classes."""
    key, ctx = f"substr(gram, {4 - k}, {k + 1})", f"substr(gram, {4 - k}, {k})"
    mixed = ", ".join(f"CASE WHEN n_{x} > 0 THEN (coalesce(g_{x}, 0) + d_{x} * p_{x}) / (n_{x} + d_{x}) ELSE p_{x} END AS p_{x}" for x in "ro")
    return f"""g{k} AS (SELECT {key} AS g, {ctx} AS c, sum(r) AS g_r, sum(o) AS g_o FROM counts GROUP BY ALL),
c{k} AS (SELECT c, sum(g_r) AS n_r, sum(g_o) AS n_o, count(*) FILTER (g_r > 0) AS d_r, count(*) FILTER (g_o > 0) AS d_o FROM g{k} GROUP BY c),
p{k + 1} AS (SELECT gram, {mixed} FROM p{k} LEFT JOIN g{k} ON {key} = g{k}.g LEFT JOIN c{k} ON {ctx} = c{k}.c)"""


SECRETS = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
rules(kind, name, p) AS (VALUES (0, 'assign', '{_ASSIGN}'), (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]+'),
                                (3, 'random', '[A-Za-z0-9+/_-]{{16,}}={{0,2}}')),
m AS (SELECT r, kind, name, regexp_extract_all(text, p) AS fs, regexp_split_to_array(text, p) AS gaps FROM d, rules),
each AS (SELECT r, kind, name, fs[i] AS f, sum(length(gaps[i]) + length(fs[i])) OVER (PARTITION BY r, kind ORDER BY i) AS e
         FROM m, unnest(range(1, len(fs) + 1)) t(i)),
value AS (SELECT r, kind, name, e - length(f) AS s, e, CASE WHEN kind = 0 THEN regexp_extract(f, '{_ASSIGN}', 2) ELSE f END AS v FROM each),
spans AS (SELECT * FROM value WHERE CASE kind WHEN 0 THEN length(v) >= 6 WHEN 1 THEN length(v) >= 20 WHEN 2 THEN length(v) >= 24
                                    ELSE regexp_matches(v, '[A-Za-z]') END),
cand AS (SELECT * FROM spans c WHERE kind = 3 AND NOT EXISTS (SELECT 1 FROM spans b WHERE b.r = c.r AND b.kind < 3 AND b.s < c.e AND b.e > c.s)),
digest AS (SELECT sha256(CAST(i AS VARCHAR)) AS x FROM range(0, 4096) t(i)),
b64 AS (SELECT replace(base64(unhex(x)), '=', '') AS b FROM digest),
random AS (SELECT x AS s FROM digest UNION SELECT b FROM b64 UNION SELECT upper(b) FROM b64 UNION SELECT lower(b) FROM b64
           UNION SELECT v FROM spans WHERE kind < 3),
ordinary AS (SELECT DISTINCT s FROM (SELECT unnest(regexp_extract_all(regexp_replace(text, '{_ASSIGN}', ' ', 'g'), '[A-Za-z0-9+/_-]{{8,}}')) AS s FROM d)
             WHERE length(s) < 16),
both_kinds AS (SELECT s, 1 AS r FROM random UNION ALL SELECT s, 0 FROM ordinary),
counts AS (SELECT substr('^^^' || s, i, 4) AS gram, sum(r) AS r, sum(1 - r) AS o FROM both_kinds, unnest(range(1, length(s) + 1)) t(i) GROUP BY ALL),
wanted AS (SELECT v, substr('^^^' || rtrim(v, '='), i, 4) AS gram FROM (SELECT DISTINCT v FROM cand), unnest(range(1, length(rtrim(v, '=')) + 1)) t(i)),
p0 AS (SELECT DISTINCT gram, CAST(1 AS DOUBLE) / 68 AS p_r, CAST(1 AS DOUBLE) / 68 AS p_o FROM wanted),
{", ".join(map(_gram_order, range(4)))},
secret AS (SELECT v FROM wanted JOIN p4 USING (gram) GROUP BY v HAVING sum(ln(p_r) - ln(p_o)) >= ln(1000000)),
found AS (SELECT * FROM spans WHERE kind < 3 UNION ALL SELECT * FROM cand WHERE v IN (SELECT v FROM secret)),
per AS (SELECT r, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h,
               string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
               string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) AS every FROM found GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(every, '') AS spans
FROM d LEFT JOIN per USING (r)
"""

SQL = {"op3_substring_doubling": SUBSTRINGS, "op5_suffix_levels": BYTES, "op7_fair_queue": MIX, "op8_jaccard_join": NEAR,
       "op9_snapshot_collapse": SNAPSHOTS, "op10_rule_cascade": QUALITY,
       "op11_merkle_manifest": MANIFEST, "op12_secret_models": SECRETS}
