"""DuckDB SQL for the queries that SQL can express, over whole tables."""

QUALITY = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)),
                         lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
windows AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows)
          WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + j) AS n
            FROM twice, (VALUES (0), (1), (2)) AS o(j) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws) AS n_words,
             CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             coalesce(r.n, 0) AS n_repeat_words,
             length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS n_capitals
      FROM w LEFT JOIN repeats r ON w.doc_id = r.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words
            OR word_chars > 15 * n_words OR 100 * n_capitals > 40 * word_chars
            OR 10 * n_dup_lines > n_words) AS kept
FROM f
"""

# Positions: gaps between matches come from marking each match with chr(1) and chr(2).
SECRETS = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner,
                  concat_ws('/', source, lang) AS repository FROM documents),
every AS (
  SELECT doc_id, owner, repository, 'assign' AS kind, 1 AS rank, 6 AS least, string_split(regexp_replace(text,
    '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)',
    chr(1) || '\0' || chr(2) || '\2' || chr(1), 'g'), chr(1)) AS p FROM d
  UNION ALL SELECT doc_id, owner, repository, 'access', 2, 20, string_split(regexp_replace(text,
    'AKIA[A-Z0-9]{16,}', chr(1) || '\0' || chr(2) || '\0' || chr(1), 'g'), chr(1)) FROM d
  UNION ALL SELECT doc_id, owner, repository, 'hex', 3, 24, string_split(regexp_replace(text,
    '[0-9a-f]{24,}', chr(1) || '\0' || chr(2) || '\0' || chr(1), 'g'), chr(1)) FROM d
  UNION ALL SELECT doc_id, owner, repository, 'vendor', 4, 20, string_split(regexp_replace(text,
    '(?:gh[pousr]_|glpat-|xox[abprs]-|sk_live_|sk-)[A-Za-z0-9_-]{16,}',
    chr(1) || '\0' || chr(2) || '\0' || chr(1), 'g'), chr(1)) FROM d),
parts AS (SELECT doc_id, owner, repository, kind, rank, least, unnest(p) AS part,
                 generate_subscripts(p, 1) AS i FROM every),
placed AS (SELECT *, split_part(part, chr(2), 1) AS body, split_part(part, chr(2), 2) AS value,
                  sum(length(split_part(part, chr(2), 1))) OVER (PARTITION BY doc_id, rank ORDER BY i) AS "end"
           FROM parts),
found AS (SELECT doc_id, owner, repository, kind, rank, CAST("end" AS BIGINT) AS "end",
                 CAST("end" - length(body) AS BIGINT) AS start, CAST("end" - length(value) AS BIGINT) AS value_start, value
          FROM placed WHERE i % 2 = 0 AND length(value) >= least),
owned AS (SELECT value, count(DISTINCT owner) >= 3 OR count(DISTINCT (owner, repository)) >= 10 AS example,
                 len(list_distinct(string_split(value, ''))) AS different FROM found GROUP BY value),
judged AS (SELECT f.*, example, NOT example AND ((length(f.value) >= 20 AND different >= 8)
                  OR (length(f.value) >= 8 AND different >= 5 AND regexp_matches(f.value, '[0-9]'))) AS live
           FROM found f JOIN owned USING (value)),
spans AS (SELECT doc_id, kind, rank, start, "end", example FROM judged
          UNION ALL SELECT DISTINCT doc_id, 'live', 5, value_start, "end", FALSE FROM judged WHERE live)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) FILTER (rank < 4), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank, "end"), '') AS spans,
       count(*) FILTER (kind = 'live') AS n_live,
       count(*) FILTER (example AND rank < 4) AS n_example
FROM (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id) d LEFT JOIN spans s ON d.doc_id = s.doc_id
GROUP BY d.doc_id
"""

def _codes() -> str:
    """Codebooks round by round; every part of 16 components is one list, sums add up component by component."""
    rounds = [
        """WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024e0 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
             row_number() OVER () AS row FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))),
parts AS (SELECT row, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS x
          FROM kept, (VALUES (0), (1), (2), (3)) AS t(p)),
first AS (SELECT row, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept
          QUALIFY e < 256),
book0 AS (SELECT p, e, x AS c FROM parts JOIN first USING (row))"""]
    near = """near{k} AS (SELECT row, p, x, arg_min(e, d * 256 + e) AS e, min(d) AS d
          FROM (SELECT row, parts.p, x, e, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
                FROM parts JOIN book{k} ON parts.p = book{k}.p) GROUP BY row, p, x)"""
    for k in range(4):
        rounds.append(near.format(k=k))
        rounds.append(f"""means{k} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
          FROM (SELECT p, e, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
                FROM (SELECT p, e, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM near{k}) GROUP BY p, e, i)
          GROUP BY p, e),
book{k + 1} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN means{k} m ON b.p = m.p AND b.e = m.e)""")
    rounds.append(near.format(k=4))
    rounds.append("""coded AS (SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
          FROM near4 GROUP BY row),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM book4)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (row), books""")
    return ",\n".join(rounds[:-1]) + ",\n" + rounds[-1]


CODES = _codes()

# Windows of an item are lists of its words; documents are cut into lists of the same lengths.
LEAKS = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
               FROM documents),
tests AS (SELECT item_id, regexp_extract_all(translate(text,
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM benchmark WHERE text IS NOT NULL),
phrases AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
            FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM tests WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM phrases),
windows AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS g
            FROM (SELECT doc_id, w, size, unnest(range(1, CAST(len(w) - size + 2 AS BIGINT))) AS i FROM words, sizes WHERE len(w) >= size)),
found AS (SELECT doc_id, i, windows.size, item_id FROM windows JOIN phrases USING (g) WHERE windows.size = phrases.size),
hits AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) FROM found) GROUP BY doc_id),
listed AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM found GROUP BY doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, n IS NOT NULL AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

# Backward, turn by turn: for each state the cheapest (cost, audit, lines) of all that is to come,
# the audit deciding between equal costs.  States: 0 start, 1 system, 2 user, 3 assistant.
_OPTIONS = """least({{'c': {d}.c + 2, 'a': 'D' || {d}.a, 't': {d}.t}}, {others})"""
_NOTHING = "{'c': 1000000000000, 'a': '~', 't': ''}"


def _state(number: int) -> str:
    after = {0: "r.q0", 1: "r.q1", 2: "r.q2", 3: "r.q3"}
    follows = (2, 2, 3, 2)[number]
    keeps = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[number]
    line = "role || ':' || text || chr(10) || "
    kept = " ".join(f"WHEN fault IN ('', 'truncated') AND role[1] = '{initial}' THEN "
                    f"{{'c': {after[to]}.c + late, 'a': 'K' || {after[to]}.a, 't': {line}{after[to]}.t}}"
                    for initial, to in keeps.items())
    name = {2: "user", 3: "assistant"}[follows]
    reroled = (f"CASE WHEN fault IN ('', 'truncated') THEN {{'c': {after[follows]}.c + late + 1, 'a': 'R' || {after[follows]}.a, "
               f"'t': '{name}:' || text || chr(10) || {after[follows]}.t}} ELSE {_NOTHING} END")
    return _OPTIONS.format(d=after[number], others=f"CASE {kept} ELSE {_NOTHING} END, {reroled}")


def _insert(state: str, to: str, name: str) -> str:
    return f"least({state}, {{'c': {to}.c + 5, 'a': 'I' || {to}.a, 't': '{name}:' || chr(10) || {to}.t}})"


CONVERSATIONS = rf"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
bits AS (SELECT k, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(k) + 1), lambda i: ascii(k[i])::BIGINT)),
             lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0],
                 lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)) AS crc FROM (SELECT DISTINCT k FROM c)),
d AS (SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN m = 1 THEN '' WHEN m = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN m = 0 THEN 0 WHEN m = 3 THEN 2 ELSE 1 END)) AS copy
      FROM (SELECT c.*, xor(crc, 4294967295) % 20 AS m FROM c JOIN bits USING (k))),
n AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS size, lag(role[1]) OVER w || role[1] AS pair,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
      FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
f AS (SELECT *, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS late FROM (
      SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                     WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM n)),
r AS (SELECT conv_id, max(size) AS left_, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS q0, {{'c': 10::BIGINT, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)}} AS q1,
             {{'c': 5::BIGINT, 'a': 'I', 't': 'assistant:' || chr(10)}} AS q2, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS q3
      FROM f GROUP BY conv_id
      UNION ALL
      SELECT conv_id, left_, {_insert('p0', 'u', 'user')}, {_insert('p1', 'u', 'user')}, u, {_insert('p3', 'p2', 'user')}
      FROM (SELECT *, {_insert('p2', 'p3', 'assistant')} AS u
            FROM (SELECT r.conv_id, r.left_ - 1 AS left_, {_state(0)} AS p0, {_state(1)} AS p1, {_state(2)} AS p2, {_state(3)} AS p3
                  FROM r JOIN f ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.left_ = f.i))),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(q0.c, 0) AS cost,
       coalesce(q0.a, '') AS audit, sha256(coalesce(q0.t[:-2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counted ON a.conv_id IS NOT DISTINCT FROM counted.conv_id
LEFT JOIN (SELECT * FROM r WHERE left_ = 0) e ON a.conv_id IS NOT DISTINCT FROM e.conv_id
"""
