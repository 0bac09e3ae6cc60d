"""DuckDB SQL for the operators that SQL can express.

The others have none: token merges (1, 9), XXH64 with a seed and components (3), random fields (5, 6),
greedy bins (7) and page checksums (8) are held against libraries, brute force and round trips in tests.
"""

from .license_index import LOWER, UPPER, key_phrases, places
from .license_texts import PHRASES, TEMPLATES
from .url_templates import bound

WORD = "[^\\x20\\x09-\\x0D]+"

OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(t, '{WORD}')) AS w, generate_subscripts(regexp_extract_all(t, '{WORD}'), 1) AS i FROM d),
g AS (SELECT r, i, w || ' ' || lead(w) OVER x || ' ' || lead(w, 2) OVER x AS g FROM w WINDOW x AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, g FROM g WHERE g IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM g JOIN again USING (r, g) CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
sized AS (SELECT r, count(*) AS n, sum(length(w)) AS c FROM w GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT r, sum(n - 1) AS n FROM (SELECT r, line, count(*) AS n FROM l WHERE regexp_matches(line, '{WORD}') GROUP BY ALL) GROUP BY r),
base AS (SELECT d.r, doc_id, source, t, coalesce(sized.n, 0) AS n_words, coalesce(c, 0) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
 FROM d LEFT JOIN sized USING (r) LEFT JOIN dup USING (r) LEFT JOIN covered USING (r)),
texts AS (SELECT coalesce(source, chr(1)) AS host, t, min(r) AS r FROM d GROUP BY ALL),
lines AS (SELECT host, r, regexp_replace(array_to_string(list_filter(regexp_split_to_array(lower(line), '\\s+'), lambda x: x <> ''), ' '), '[0-9]', '0', 'g') AS line, sum(len(regexp_extract_all(line, '{WORD}'))) AS words
 FROM texts JOIN l USING (r) WHERE regexp_matches(line, '{WORD}') GROUP BY ALL),
hosts AS (SELECT host, greatest(5, ceil(count(*) * 0.01)) AS most FROM texts GROUP BY 1),
often AS (SELECT host, line FROM lines JOIN hosts USING (host) GROUP BY host, line, most HAVING count(*) > most),
gone AS (SELECT host, t, sum(words) AS n FROM lines JOIN often USING (host, line) JOIN texts USING (host, r) GROUP BY ALL)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words,
 n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - coalesce(gone.n, 0) >= 0.3 * n_words AS kept
FROM base LEFT JOIN gone ON gone.host = coalesce(base.source, chr(1)) AND gone.t = base.t
"""

OP4 = (r"""
WITH RECURSIVE u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules AS (SELECT * FROM (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')) r(says, rhost, rpath)),
k AS (SELECT p.*, (SELECT arg_max(rhost || rpath, length(rhost || rpath)) FROM rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS rule FROM p),
v AS (SELECT k.*, says AS ruling, list_filter(string_split(path, '/'), lambda s: s <> '') AS segments FROM k LEFT JOIN rules ON rule = rhost || rpath),
h AS (SELECT *, list_concat(list_transform(segments[1:8], lambda s: CASE WHEN regexp_matches(s, '^(?:[0-9][0-9.,_-]*|[0-9a-fA-F]{8,}|[A-Za-z_-]*[0-9]+[A-Za-z_-]+[0-9]+[0-9A-Za-z_-]*|.{41,})(\.[A-Za-z]{1,5})?$')
 THEN '*' || CASE WHEN regexp_matches(s, '^(?:[0-9][0-9.,_-]*|[0-9a-fA-F]{8,}|[A-Za-z_-]*[0-9]+[A-Za-z_-]+[0-9]+[0-9A-Za-z_-]*)(\.[A-Za-z]{1,5})$') THEN regexp_extract(s, '(\.[A-Za-z]{1,5})$', 1) ELSE '' END ELSE s END), CASE WHEN len(segments) > 8 THEN ['**'] ELSE [] END) AS shaped FROM v),
y AS (SELECT host, shaped, count(*) FILTER (ruling = 'block') AS blocked, count(ruling) AS decided, count(*) AS pages FROM h GROUP BY ALL),
s AS (SELECT host, shaped, unnest(shaped) AS segment, generate_subscripts(shaped, 1) AS i FROM y),
crowded AS (SELECT host, above FROM (SELECT DISTINCT host, list_slice(shaped, 1, i - 1) AS above, segment FROM s WHERE NOT starts_with(segment, '*')) GROUP BY ALL HAVING count(*) > 16),
opened AS (SELECT s.host, s.shaped, list(DISTINCT i) AS o FROM s JOIN crowded c ON c.host = s.host AND c.above = list_slice(s.shaped, 1, i - 1) WHERE NOT starts_with(segment, '*') GROUP BY ALL),
t AS (SELECT y.*, list_transform(y.shaped, lambda x, i: CASE WHEN list_contains(coalesce(o, []), i) THEN '*' ELSE x END) AS template FROM y LEFT JOIN opened ON opened.host = y.host AND opened.shaped = y.shaped),
f AS (SELECT host, template, sum(blocked) AS blocked, sum(decided) AS decided, sum(pages) AS pages FROM t GROUP BY ALL),
e AS (SELECT host, template, blocked, decided, generate_subscripts(template, 1) AS i FROM f),
b AS (SELECT host, list_slice(template, 1, i - 1) AS above, list_slice(template, 1, i) AS branch, sum(blocked) AS blocked, sum(decided) AS decided FROM e GROUP BY ALL),
g AS (SELECT *, sum(blocked) OVER a AS all_blocked, sum(decided) OVER a AS all_decided, count(*) FILTER (decided > 0) OVER a AS voters, coalesce(sum((blocked + 1.0::DOUBLE) / (decided + 2.0::DOUBLE)) FILTER (decided > 0) OVER a, 0) AS votes FROM b WINDOW a AS (PARTITION BY host, above)),
c AS (SELECT host, above, segment, child, sum(pages) AS k, sum(blocked) AS blocked, sum(decided) AS decided FROM (SELECT host, list_slice(template, 1, i - 1) AS above, template[i] AS segment, coalesce(template[i + 1], '') AS child, pages, blocked, decided FROM (SELECT host, template, pages, blocked, decided, generate_subscripts(template, 1) AS i FROM f)) GROUP BY ALL),
n AS (SELECT host, above, segment, sum(k) AS n, sum(blocked) AS blocked, sum(decided) AS decided FROM c GROUP BY ALL),
q AS (SELECT a.host, a.above, a.segment AS a, b.segment AS b, a.n AS na, b.n AS nb, BOUND * (1 / sqrt(a.n) + 1 / sqrt(b.n)) AS most FROM n a JOIN n b ON a.host = b.host AND a.above = b.above AND a.segment < b.segment WHERE BOUND * (1 / sqrt(a.n) + 1 / sqrt(b.n)) <= 1
 AND NOT coalesce(a.decided > 0 AND b.decided > 0 AND abs(a.blocked / nullif(a.decided, 0) - b.blocked / nullif(b.decided, 0)) > BOUND * (1 / sqrt(a.decided) + 1 / sqrt(b.decided)), false)),
shares AS (SELECT q.host, q.above, a, b, most, child, sum(CASE WHEN c.segment = a THEN k ELSE 0 END) / na AS pa, sum(CASE WHEN c.segment = b THEN k ELSE 0 END) / nb AS pb FROM q JOIN c ON c.host = q.host AND c.above = q.above AND c.segment IN (a, b) GROUP BY q.host, q.above, a, b, na, nb, most, child),
pairs AS (SELECT host, above, a, b FROM shares GROUP BY ALL HAVING bool_and(abs(pa - pb) <= most)),
ties AS (SELECT * FROM pairs UNION ALL SELECT host, above, b, a FROM pairs),
reach AS (SELECT host, above, segment AS a, segment AS b FROM n UNION SELECT r.host, r.above, r.a, x.b FROM reach r JOIN ties x ON x.host = r.host AND x.above = r.above AND x.a = r.b),
classes AS (SELECT host, list_append(above, a) AS branch, CASE WHEN count(*) > 1 THEN '+' || min(b) ELSE a END AS label FROM reach GROUP BY host, above, a),
r AS (SELECT g.host, g.branch, voters, votes, label FROM g JOIN classes l ON l.host = g.host AND l.branch = g.branch),
w AS (SELECT e.host, e.template, list(label ORDER BY i) AS labels, list({'votes': votes, 'voters': CAST(voters AS DOUBLE), 'p': 0.0::DOUBLE} ORDER BY i) AS way FROM e JOIN r ON r.host = e.host AND r.branch = list_slice(e.template, 1, i) GROUP BY ALL),
m AS (SELECT f.*, coalesce(labels, []) AS merged, list_reduce(list_prepend({'votes': 0.0::DOUBLE, 'voters': 0.0::DOUBLE, 'p': 0.5::DOUBLE}, coalesce(way, [])), lambda a, x: {'votes': 0.0::DOUBLE, 'voters': 0.0::DOUBLE, 'p': (x.votes + 2 * a.p) / (x.voters + 2)}).p AS told FROM f LEFT JOIN w ON w.host = f.host AND w.template = f.template),
j AS (SELECT host, template, merged, round((sum(blocked) OVER z + 2 * told) / (sum(decided) OVER z + 2), 6) AS purity FROM m WINDOW z AS (PARTITION BY host, merged))
SELECT page_id, h.host, path, rule, coalesce(ruling, CASE WHEN purity >= 0.8 THEN 'block' ELSE 'allow' END) AS verdict, '/' || array_to_string(merged, '/') AS template, purity::DOUBLE AS purity, CASE WHEN purity >= 0.8 THEN 'block' ELSE 'allow' END AS judgement
FROM h JOIN t ON t.host = h.host AND t.shaped = h.shaped JOIN j ON j.host = t.host AND j.template = t.template
""").replace("BOUND", repr(bound(0.05)))


def rows(values: list[tuple]) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in values) + ")"


KEYS = [(k, p) for k, (_, _, phrases) in enumerate(TEMPLATES) for p in phrases]
LABELS = [(k, label, len(phrases)) for k, (label, _, phrases) in enumerate(TEMPLATES)]
ALL = [(p,) for p in key_phrases()]
OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
w AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
phrases AS (SELECT phrase, string_split(phrase, ' ')[1] AS first, len(string_split(phrase, ' ')) AS n FROM {rows(ALL)} x(phrase)),
spots AS (SELECT w.r, i - 1 AS start, phrase FROM w JOIN phrases ON word = first JOIN d ON d.r = w.r WHERE array_to_string(list_slice(words, i, i + n - 1), ' ') = phrase),
base AS (SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list_sort(list_distinct(list(label))) AS base FROM spots JOIN {rows(list(PHRASES))} b(phrase, label) USING (phrase) GROUP BY 1),
places AS (SELECT * FROM {rows(places())} x(word, k, place)),
held AS (SELECT word, count(DISTINCT r) AS held FROM w WHERE word IN (SELECT word FROM places) GROUP BY 1),
index AS (SELECT k, word FROM (SELECT DISTINCT k, word FROM places) LEFT JOIN held USING (word) WHERE coalesce(held, 0) <= 0.2 * ((SELECT count(*) FROM d) + 50) QUALIFY row_number() OVER (PARTITION BY k ORDER BY coalesce(held, 0), word) <= 12),
reach AS (SELECT k, count(*) AS reach FROM index GROUP BY 1),
votes AS (SELECT r, k, i - 1 - place AS shift, count(DISTINCT word) AS votes FROM w JOIN places USING (word) JOIN index USING (k, word) GROUP BY ALL),
verified AS (SELECT r, k FROM (SELECT DISTINCT r, phrase FROM spots) JOIN {rows(KEYS)} y(k, phrase) USING (phrase) JOIN {rows(LABELS)} l(k, label, needed) USING (k) GROUP BY r, k, needed HAVING count(*) = needed),
method AS (SELECT r, list_distinct(list(label)) AS more, max(votes / reach) AS share FROM votes JOIN reach USING (k) JOIN verified USING (r, k) JOIN {rows(LABELS)} l(k, label, needed) USING (k) WHERE votes >= 3 AND votes >= 0.6 * reach GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(base, ','), '') AS base_labels, coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ','), '') AS labels,
 greatest(coalesce(share, 0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0 END)::DOUBLE AS score FROM d LEFT JOIN base USING (r) LEFT JOIN method USING (r)
"""

def edit(before: str, letter: str, cost: str, line: str = "''") -> str:
    """A way through the rest of a conversation, `before`, with one more edit in front."""
    return f"{{'cost': {before}.cost + {cost}, 'audit': {letter} || {before}.audit, 'lines': {line} || {before}.lines}}"


def line(role: str) -> str:
    return f"chr(10) || {role} || ':' || text"


TURNED = [edit(f"v[{state}]", f"CASE initial WHEN '{initial}' THEN 'K' ELSE 'R' END", f"extra + CASE initial WHEN '{initial}' THEN 0 ELSE 3 END", line(f"CASE initial WHEN '{initial}' THEN role ELSE '{role}' END")) for state, initial, role in ((3, "u", "user"), (4, "a", "assistant"))]
GONE = [edit(f"v[{state}]", "'D'", "4") for state in (1, 2, 3, 4)]
CHOICES = [f"[{gone}] || CASE WHEN must_go THEN [] ELSE [{turned}] END" for gone, turned in zip(GONE, (TURNED[0], TURNED[0], TURNED[1], TURNED[0]), strict=True)]
CHOICES[0] += f" || CASE WHEN initial = 's' AND NOT must_go THEN [{edit('v[2]', chr(39) + 'K' + chr(39), 'extra', line('role'))}] ELSE [] END"
ADDED = {state: edit(f"b[{state}]", "'I'", "3", f"chr(10) || '{role}:'") for state, role in ((3, "user"), (4, "assistant"))}
OP11 = rf"""
WITH RECURSIVE remainders AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v FROM range(256) x(i))),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
c AS (SELECT k.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(key, ''), lambda x: ascii(x))), lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 20 AS kind FROM k, remainders),
convs AS (SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
d AS (SELECT g, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
 FROM c JOIN convs ON c.conv_id IS NOT DISTINCT FROM convs.conv_id),
o AS (SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) AS time FROM (SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM d)),
f AS (SELECT *, NOT regexp_matches(text, '{WORD}') AS blank, time > 1 AND regexp_matches(text, '{WORD}') AS duplicate, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AND time = 1 AND regexp_matches(text, '{WORD}') AS truncated,
 i > 1 AND initial || lag(initial) OVER (PARTITION BY g ORDER BY i) NOT IN ('us', 'au', 'ua') AS illegal FROM o),
m AS (SELECT g, count(f.g) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate, count_if(truncated) AS truncated, count_if(illegal) AS illegal FROM convs LEFT JOIN f USING (g) GROUP BY g),
w AS (SELECT g, n AS i, [{{'cost': 0, 'audit': '', 'lines': ''}}, {{'cost': 6, 'audit': 'II', 'lines': chr(10) || 'user:' || chr(10) || 'assistant:'}}, {{'cost': 3, 'audit': 'I', 'lines': chr(10) || 'assistant:'}}, {{'cost': 0, 'audit': '', 'lines': ''}}] AS v FROM m
 UNION ALL SELECT g, i - 1, [list_min([b[1], {edit('u', "'I'", '3', "chr(10) || 'user:'")}]), list_min([b[2], {edit('u', "'I'", '3', "chr(10) || 'user:'")}]), u, list_min([b[4], {ADDED[3]}])]
 FROM (SELECT g, i, b, list_min([b[3], {ADDED[4].replace("'user:'", "'assistant:'")}]) AS u FROM (SELECT w.g, w.i, [{', '.join(f'list_min({x})' for x in CHOICES)}] AS b
 FROM w JOIN (SELECT *, blank OR duplicate AS must_go, CASE WHEN truncated THEN 3 ELSE 0 END AS extra FROM f) f ON f.g = w.g AND f.i = w.i)))
SELECT conv_id, CAST(gaps AS BIGINT) AS gaps, CAST(blank AS BIGINT) AS blank, CAST(duplicate AS BIGINT) AS duplicate, CAST(truncated AS BIGINT) AS truncated, CAST(illegal AS BIGINT) AS illegal, CAST(v[1].cost AS BIGINT) AS cost, v[1].audit AS audit, sha256(substr(v[1].lines, 2)) AS repaired_sha256
FROM w JOIN m USING (g) JOIN convs USING (g) WHERE i = 0
"""

OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
w AS (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM d),
k AS (SELECT r, i, md5(array_to_string(words[i:i + 34], ' ')) AS key FROM w),
again AS (SELECT key FROM k GROUP BY key HAVING count(*) > 1),
starts AS (SELECT r, list(i) AS spots FROM k JOIN again USING (key) GROUP BY r),
p AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
s AS (SELECT DISTINCT r, unnest(spots) AS i, true AS start FROM starts),
c AS (SELECT p.r, p.i, word, max(CASE WHEN start THEN p.i END) OVER (PARTITION BY p.r ORDER BY p.i) AS last FROM p LEFT JOIN s ON s.r = p.r AND s.i = p.i),
t AS (SELECT r, count_if(last IS NOT NULL AND i < last + 35) AS n_removed, string_agg(CASE WHEN last IS NULL OR i >= last + 35 THEN word END, ' ' ORDER BY i) AS kept FROM c GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN t USING (r)
"""

OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
s AS (SELECT count_if(len(terms) > 0) AS documents, CAST(sum(len(terms)) AS BIGINT) AS length FROM d),
q AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
asked AS (SELECT q, term, count(*) AS times FROM (SELECT q, unnest(terms) AS term FROM q) GROUP BY ALL),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
w AS (SELECT q, term, times * CAST(floor(1000 * ln((2 * documents + 2) / (2 * df + 1))) AS BIGINT) AS weight FROM asked JOIN df USING (term), s),
m AS (SELECT r, doc_id, 25 + (75 * len(terms) * documents) // length AS m FROM d, s WHERE len(terms) > 0),
scored AS (SELECT q, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM w JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL),
ranked AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored JOIN m USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN q USING (q) WHERE rank <= 10
"""

ORACLES: dict[str, str] = {"op2_quality_rules": OP2, "op4_url_filters": OP4, "op10_license_scans": OP10, "op11_conversation_repair": OP11, "op12_substring_dedup": OP12, "op13_ranked_search": OP13}
