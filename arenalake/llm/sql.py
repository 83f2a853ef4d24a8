"""Comparison SQL of the numbered queries."""

from __future__ import annotations

from arenalake.llm.chat import BUDGET, CONTROL, END, START
from arenalake.llm.quality import BASE, FENCE, MIN_ROWS

_WORD = r"[^\x20\x09-\x0D]+"

# Rule name, its whole-number metric, its least spread, whether it has a lower fence.
_RULES = [
    ("symbols", "1000 * n_symbols // greatest(word_chars, 1)", 15, False),
    ("capitals", "1000 * n_capitals // greatest(word_chars, 1)", 60, False),
    ("marks", "1000 * n_marks // greatest(n_words, 1)", 60, False),
    ("dup_lines", "1000 * n_dup_lines // greatest(n_lines, 1)", 60, False),
    ("repeats", "1000 * n_repeat_words // greatest(n_words, 1)", 60, False),
    ("word_length", "100 * word_chars // greatest(n_words, 1)", 100, True),
]

_COUNTS = rf"""
raw AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT rid, doc_id, lang, source, t, regexp_extract_all(t, '{_WORD}') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ln
  FROM raw),
win AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3)),
rep AS (
  SELECT rid, count(DISTINCT p) AS n
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1)
  GROUP BY rid),
m AS (
  SELECT split.rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
         CAST(length(regexp_replace(t, '[^!?]', '', 'g')) AS BIGINT) AS n_marks,
         CAST(len(ln) AS BIGINT) AS n_lines,
         CAST(len(ln) - len(list_distinct(ln)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN rep ON rep.rid = split.rid)"""

_VALUES = " UNION ALL ".join(
    f"SELECT rid, lang, source, '{name}' AS rule, {metric} AS v, {spread} AS spread, {str(low).upper()} AS low FROM m"
    for name, metric, spread, low in _RULES
)
_SHIFT = "greatest(length(bin(v)) - 6, 0)"

# A document's fence comes from the smallest sketch (source, language, all) with enough rows.
OP1 = f"""
WITH {_COUNTS},
vals AS ({_VALUES}),
cells AS (SELECT *, (v >> {_SHIFT}) << {_SHIFT} AS b FROM vals),
sk AS (
  SELECT 0 AS level, lang AS k1, source AS k2, rule, b FROM cells
  UNION ALL SELECT 1, lang, NULL, rule, b FROM cells
  UNION ALL SELECT 2, NULL, NULL, rule, b FROM cells),
q AS (
  SELECT level, k1, k2, rule, count(*) AS n, list_sort(list(b)) AS bs FROM sk GROUP BY ALL),
f AS (
  SELECT level, k1, k2, rule, n, bs[(25 * n + 99) // 100] AS q25, bs[(50 * n + 99) // 100] AS q50,
         bs[(75 * n + 99) // 100] AS q75 FROM q),
judged AS (
  SELECT c.rid, c.rule,
         arg_min(v > q50 + {FENCE} * greatest(q75 - q50, spread)
                 OR (low AND v < q50 - {FENCE} * greatest(q50 - q25, spread)),
                 CASE WHEN n >= {MIN_ROWS} THEN level ELSE 3 - level / 10.0 END) AS bad
  FROM cells c JOIN f ON f.rule = c.rule
    AND (level = 2 OR k1 IS NOT DISTINCT FROM lang) AND (level > 0 OR k2 IS NOT DISTINCT FROM source)
  GROUP BY c.rid, c.rule),
verdict AS (
  SELECT rid, bool_or(bad) AS bad,
         coalesce(array_to_string(list(rule ORDER BY CASE rule {" ".join(f"WHEN '{r[0]}' THEN {i}" for i, r in enumerate(_RULES))} END) FILTER (WHERE bad), ','), '') AS broken_rules
  FROM judged GROUP BY rid)
SELECT doc_id, {", ".join(BASE)}, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT bad AS kept, broken_rules
FROM m JOIN verdict USING (rid)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
                               ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
comp AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN comp ON comp.a = w.doc_id
"""

def _escaped(text: str) -> str:
    """Length of a text with its backslashes doubled and one more before the rest of every control string."""
    signs = " + ".join(f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in CONTROL)
    return f"(2 * length({text}) - length(replace({text}, chr(92), '')) + {signs})"


_STRIDE = BUDGET // 4
_OK = "</s>[INST] ok [/INST]"

# Turns are dealt into windows as the operator states it; lengths follow from counting what escaping adds.
OP4 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{_OK}'), (-7, 1, 'assistant', '{_OK}')),
s AS (
  SELECT *, row_number() OVER w AS n, greatest(CAST(ceil(length(text) / 4.0) AS BIGINT), 1) AS size FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
b AS (SELECT *, CAST((sum(size) OVER (PARTITION BY conv_id ORDER BY n) - size) AS BIGINT) // {_STRIDE} AS block FROM s),
c AS (
  SELECT *, coalesce(block <> lag(block) OVER w OR size > {_STRIDE} OR lag(size) OVER w > {_STRIDE}, TRUE) AS fresh FROM b
  WINDOW w AS (PARTITION BY conv_id ORDER BY n)),
d AS (SELECT *, CAST(sum(fresh::INT) OVER (PARTITION BY conv_id ORDER BY n) - 1 AS BIGINT) AS win FROM c),
e AS (
  SELECT *, max(win) OVER (PARTITION BY conv_id) AS last, lead(win) OVER w AS w1, lead(win, 2) OVER w AS w2,
         size + lead(size) OVER w AS two FROM d
  WINDOW w AS (PARTITION BY conv_id ORDER BY n)),
f AS (
  SELECT conv_id, n, role, text, win,
         CASE WHEN n = 1 AND role = 'system' THEN last
              ELSE coalesce((w1 <> win AND size <= {_STRIDE})::INT, 0) + coalesce((w2 <> w1 AND two <= {_STRIDE})::INT, 0)
              END AS again,
         last
  FROM e),
g AS (
  SELECT *, {len(START)} + {_escaped("role")} + length(role) - length(replace(role, chr(10), '')) + 1
            + {_escaped("text")} + {len(END)} + 1 AS chars FROM f)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars * (1 + coalesce(again, 0))) AS BIGINT) AS formatted_chars, max(last) + 1 AS n_windows
FROM g GROUP BY conv_id
"""


def _mix_rounds(rounds: int) -> str:
    """One turned-over document per source and round."""
    parts = []
    for i in range(1, rounds + 1):
        before = f"SELECT source, gap FROM gaps0" if i == 1 else f"SELECT source, CASE WHEN gap > 0 THEN gap - size ELSE gap + size END AS gap FROM pick{i - 1}"
        done = " UNION ALL ".join(f"SELECT source, rank, doc_id, digest, j FROM pick{k}" for k in range(1, i))
        skip = f"AND NOT EXISTS (SELECT 1 FROM ({done}) o WHERE o.rank = c.rank AND o.digest = c.digest AND o.j = c.j AND o.doc_id IS NOT DISTINCT FROM c.doc_id AND o.source IS NOT DISTINCT FROM c.source)" if done else ""
        parts.append(f"""pick{i} AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT c.source, c.rank, c.doc_id, c.digest, c.j, c.size, g.gap,
           row_number() OVER (PARTITION BY c.source ORDER BY abs(c.size - abs(g.gap)), c.rank, c.doc_id NULLS FIRST, c.digest, c.j) AS n
    FROM cut c JOIN ({before}) g ON g.source IS NOT DISTINCT FROM c.source
    WHERE c.chosen = (g.gap < 0) AND abs(c.size - abs(g.gap)) < abs(g.gap) {skip}) WHERE n = 1)""")
    return ",\n".join(parts)


# Sources that stop at their most come first in the order of most per weight; the others share what is left.
OP13 = f"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size
  FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
named AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3 + 1] AS weight,
         2.0::DOUBLE * source_size AS most, (SELECT sum(source_size) * 1.5::DOUBLE FROM src) AS budget
  FROM src),
shared AS (
  SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lam
  FROM named),
lam AS (SELECT max(lam) AS lam FROM shared),
goal AS (
  SELECT source, source_size,
         CASE WHEN source_size = 0 THEN 0.0::DOUBLE WHEN weight * (SELECT lam FROM lam) > most THEN most ELSE weight * (SELECT lam FROM lam) END AS target
  FROM named),
rated AS (
  SELECT s.doc_id, s.source, s.digest, s.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS rate,
         row_number() OVER (PARTITION BY s.doc_id, s.digest, s.source) - 1 AS j
  FROM sized s JOIN goal g ON g.source IS NOT DISTINCT FROM s.source),
drawn AS (
  SELECT *, floor(rate) AS whole, rate - floor(rate) AS p,
         (CAST('0x' || substr(md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), digest, CAST(j AS VARCHAR), '0')), 1, 13) AS BIGINT)
          + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM rated),
ranked AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM drawn),
cut AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id NULLS FIRST, digest, j ROWS UNBOUNDED PRECEDING)
         <= target - sure, FALSE) AS chosen
  FROM (SELECT *, sum(whole * size) OVER (PARTITION BY source) AS sure FROM ranked)
  WHERE rank IS NOT NULL),
gaps0 AS (SELECT source, any_value(target - sure) - coalesce(sum(size) FILTER (WHERE chosen), 0) AS gap FROM cut GROUP BY source),
{_mix_rounds(3)},
flips AS ({" UNION ALL ".join(f"SELECT source, rank, doc_id, digest, j FROM pick{k}" for k in (1, 2, 3))})
SELECT r.doc_id, r.source, r.digest, r.size, r.source_size, r.target, r.rate,
       CAST(r.whole + CASE WHEN coalesce(c.chosen, FALSE) != (f.rank IS NOT NULL) THEN 1 ELSE 0 END AS BIGINT) AS copies,
       CAST(r.size * (r.whole + CASE WHEN coalesce(c.chosen, FALSE) != (f.rank IS NOT NULL) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ranked r
LEFT JOIN cut c ON c.rank = r.rank AND c.digest = r.digest AND c.j = r.j AND c.doc_id IS NOT DISTINCT FROM r.doc_id AND c.source IS NOT DISTINCT FROM r.source
LEFT JOIN flips f ON f.rank = r.rank AND f.digest = r.digest AND f.j = r.j AND f.doc_id IS NOT DISTINCT FROM r.doc_id AND f.source IS NOT DISTINCT FROM r.source
"""


# Unsigned crc32, byte by byte: its table follows from the reversed polynomial.
_CRC_TABLE = """(SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i)
   FROM (SELECT unnest(range(256)) AS i))"""

# Words one edit apart share what is left of them without one letter: the longer word lost it, or both differ there.
OP11 = rf"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS t),
docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+') AS runs FROM documents),
runs AS (
  SELECT rid, doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
  FROM (SELECT rid, doc_id, unnest(runs) AS run FROM docs) GROUP BY ALL),
bytes AS (
  SELECT *, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
         lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END)) AS b
  FROM runs),
sums AS (
  SELECT rid, run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda x, y: xor(x >> 8, t[CAST(xor(x & 255, y) AS INTEGER) + 1])), 4294967295::BIGINT) AS h
  FROM bytes, crc),
slipped AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, c
  FROM sums),
words AS MATERIALIZED (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
less AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
  SELECT DISTINCT a.word AS w, b.word AS v, b.n AS m FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word != b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT w, count(*) AS n_near, min({{'m': -m, 'v': v}}) AS top FROM near GROUP BY w),
formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -top.m >= 2 * n THEN top.v END AS form, CASE WHEN -top.m >= 2 * n THEN -top.m END AS form_n
  FROM words LEFT JOIN best ON w = word),
chain(word, spot) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.spot WHERE formed.form IS NOT NULL),
ends AS (SELECT chain.word, spot AS root FROM chain JOIN formed ON formed.word = chain.spot WHERE formed.form IS NULL)
SELECT word, n, CAST(n_near AS BIGINT) AS n_near, form, CAST(form_n AS BIGINT) AS form_n, root FROM formed JOIN ends USING (word)
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = f"""
WITH q AS (
  SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest(regexp_extract_all({_LOWERED}, '{_TERM}')) AS t FROM benchmark)),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWERED}, '{_TERM}') AS ts FROM documents),
size AS (SELECT rid, doc_id, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
tf AS (
  SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(ts) AS t FROM d)
  WHERE t IN (SELECT t FROM q) GROUP BY rid, t),
w AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), total),
scored AS (
  SELECT item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (t) JOIN w USING (t) JOIN size USING (rid), total
  GROUP BY item_id, rid, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""
