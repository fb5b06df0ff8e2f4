"""DuckDB SQL with the same rows as the queries of this package."""

from __future__ import annotations

_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

OP8_EXACT_DEDUP = f"""
WITH texts AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(norm) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY norm)
"""

# Every round of the mix is played on its own, slot after slot.
OP3_MIXING = """
WITH RECURSIVE weights AS (SELECT unnest(range(6)) AS part, unnest([25, 15, 10, 5, 5, 40]) AS a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY md5('mix:' || doc_id), doc_id) - 1 AS rank
  FROM (SELECT doc_id, source,
               coalesce(list_position(['src0', 'src1', 'src2', 'src3', 'src4'], source), 6) - 1 AS part
        FROM documents)),
blocks AS (
  SELECT part, a, ceil(count(doc_id) / 16)::BIGINT AS n
  FROM weights LEFT JOIN ranked USING (part) GROUP BY part, a),
rounds AS (
  SELECT r, list(greatest(0, least(a, n - a * r)) ORDER BY part) AS q,
         sum(greatest(0, least(a, n - a * r)))::BIGINT AS size, sum(least(n, a * r))::BIGINT AS before
  FROM blocks, (SELECT unnest(range((SELECT max(n // a) + 1 FROM blocks))) AS r) GROUP BY r),
played AS (
  SELECT r, 0::BIGINT AS t, [0, 0, 0, 0, 0, 0]::BIGINT[] AS given,
         {'d': 0::BIGINT, 's': 0::BIGINT, 'i': 0::BIGINT, 'b': 0::BIGINT} AS pick FROM rounds
  UNION ALL
  SELECT r, t + 1, [CASE WHEN s = pick.s THEN given[s] + 1 ELSE given[s] END for s in range(1, 7)], pick
  FROM (
    SELECT r, t, given, list_sort([
      {'d': (((given[s] + 1) * size + q[s] - 1) // greatest(q[s], 1))::BIGINT, 's': s::BIGINT, 'i': given[s],
       'b': (given[s] * size // greatest(q[s], 1))::BIGINT}
      for s in range(1, 7) if given[s] < q[s] AND given[s] * size // greatest(q[s], 1) <= t])[1] AS pick
    FROM (SELECT played.r, t, given, q, size FROM played JOIN rounds USING (r) WHERE t < size)))
SELECT doc_id, source, rank // 16 AS block, before + pick.b AS release, before + pick.d AS deadline,
       before + t - 1 AS slot, (rank % 16)::INTEGER AS place
FROM ranked JOIN weights USING (part)
JOIN (played JOIN rounds USING (r))
  ON pick.s = part + 1 AND r = rank // 16 // a AND pick.i = rank // 16 % a AND t > 0
"""

OP4_URL_FILTER = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%'
      THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(host, '(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)') THEN 'block'
  ELSE 'allow' END AS verdict
FROM ruled
"""

OP7_TOP_K = """
WITH whole AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole AS q JOIN whole AS c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 10
"""

OP10_CHAT = """
WITH RECURSIVE turns AS (
  SELECT *, length(text) AS size, contains(text, chr(10)) AS outline FROM conversations),
calls AS (SELECT * FROM turns WHERE role = 'user'),
results AS (
  SELECT conv_id, turn - 1 AS turn, text AS content FROM turns WHERE role = 'assistant'),
chains AS (
  SELECT conv_id, turn, 0::BIGINT AS depth FROM calls AS c
  WHERE NOT EXISTS (SELECT 1 FROM calls AS p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
  UNION ALL
  SELECT c.conv_id, c.turn, depth + 1
  FROM chains JOIN calls AS c ON c.conv_id = chains.conv_id AND c.turn = chains.turn + 2),
linked AS (
  SELECT c.conv_id, 'call_' || c.turn AS call_id, c.turn,
         CASE WHEN outline THEN 'outline' ELSE 'search' END AS tool,
         depth,
         concat_ws('; ',
           CASE WHEN depth = 0 AND c.turn >= 2 THEN 'unknown predecessor' END,
           CASE WHEN NOT outline THEN NULL
                WHEN size % 7 = 0 THEN 'depth: not integer'
                WHEN size % 6 < 1 THEN 'depth: too small' END,
           CASE WHEN outline THEN NULL
                WHEN size % 50 < 1 THEN 'limit: too small'
                WHEN size % 50 > 40 THEN 'limit: too large' END,
           CASE WHEN NOT outline AND size > 300 THEN 'query: too long' END) AS errors,
         CASE WHEN r.turn IS NULL THEN 0 ELSE 1 END::BIGINT AS results,
         '{"arguments":' || CASE
             WHEN outline AND size % 7 = 0 THEN '{"depth":"' || size % 6 || '","text":' || to_json(text)
             WHEN outline THEN '{"depth":' || size % 6 || ',"text":' || to_json(text)
             ELSE '{"limit":' || size % 50 || ',"query":' || to_json(text) END
           || '},"id":"call_' || c.turn || '"'
           || coalesce(',"result":' || to_json(content), '')
           || ',"tool":"' || CASE WHEN outline THEN 'outline' ELSE 'search' END || '"}' AS line
  FROM calls AS c JOIN chains USING (conv_id, turn)
  LEFT JOIN results AS r ON r.conv_id = c.conv_id AND r.turn = c.turn
  UNION ALL
  SELECT conv_id, 'call_' || turn, turn + 1, NULL, NULL, 'no call', 1,
         '{"id":"call_' || turn || '","result":' || to_json(content) || '}'
  FROM results AS r
  WHERE NOT EXISTS (SELECT 1 FROM calls AS c WHERE c.conv_id = r.conv_id AND c.turn = r.turn)
  UNION ALL
  SELECT conv_id, NULL, turn, NULL, 0,
         CASE WHEN role IS NULL THEN 'no role' WHEN role <> 'system' THEN 'unknown role' ELSE '' END, 0,
         '{' || concat_ws(',', '"content":' || to_json(text), '"role":' || to_json(role)) || '}'
  FROM turns WHERE role IS NULL OR role NOT IN ('user', 'assistant'))
SELECT conv_id,
       row_number() OVER (PARTITION BY conv_id ORDER BY depth NULLS LAST, turn, call_id, line) - 1 AS position,
       call_id, tool, depth, errors = '' AS valid, errors, results, line
FROM linked
"""

# A state is the cheapest way to it: cost, then letters, then the turns so far.
def _way(state: str, cost: str, letter: str, line: str) -> str:
    added = f" || chr(10) || {line}" if line else ""
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {state}.r{added}}}"


_INSERT_USER = [_way(f"s{i}", "5", "I", "'user:'") for i in (0, 1, 3)]
_USER = f"list_min([s2, {', '.join(_INSERT_USER)}])"
_ASSISTANT = "list_min([s3, {'c': i2.c + 5, 'a': i2.a || 'I', 'r': i2.r || chr(10) || 'assistant:'}])"
_LINE = "role || ':' || text"


def _moved(sources: tuple[str, ...], initial: str, role: str) -> str:
    moves = []
    for state in sources:
        moves.append(f"CASE WHEN initial = '{initial}' THEN {_way(state, 'late', 'K', _LINE)} ELSE dead END")
        moves.append(_way(state, "(late + 1)", "R", f"'{role}:' || text"))
    return ", ".join(moves)


OP12_REPAIR = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations),
summed AS (
  SELECT *, xor(4294967295, list_reduce(
    [ascii(name[i])::BIGINT for i in range(1, length(name) + 1)],
    lambda crc, byte: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END,
                                  xor(crc, byte)),
    4294967295::BIGINT)) % 20 AS kind
  FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM summed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
         left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended
  FROM damaged),
faulty AS (
  SELECT *, CASE WHEN ended = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS meeting
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (meeting NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id),
searched AS (
  SELECT conv_id, n, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'r': ''}} AS s0, {{'c': 1000000000::BIGINT, 'a': '', 'r': ''}} AS s1,
         {{'c': 1000000000::BIGINT, 'a': '', 'r': ''}} AS s2, {{'c': 1000000000::BIGINT, 'a': '', 'r': ''}} AS s3
  FROM counts
  UNION ALL
  SELECT conv_id, n, i,
    {_way("s0", "2", "D", "")},
    CASE WHEN gone THEN {_way("s1", "2", "D", "")}
         ELSE list_min([{_way("s1", "2", "D", "")}, CASE WHEN initial = 's' THEN {_way("s0", "late", "K", _LINE)} ELSE dead END]) END,
    CASE WHEN gone THEN {_way("i2", "2", "D", "")}
         ELSE list_min([{_way("i2", "2", "D", "")}, {_moved(("s0", "s1", "i3"), "u", "user")}]) END,
    CASE WHEN gone THEN {_way("i3", "2", "D", "")}
         ELSE list_min([{_way("i3", "2", "D", "")}, {_moved(("i2",), "a", "assistant")}]) END
  FROM (
    SELECT *, {_ASSISTANT} AS i3 FROM (
      SELECT s.conv_id, s.n, s.i + 1 AS i, s0, s1, s2, s3, {_USER} AS i2, f.role, f.text, f.initial,
             f.fault IN ('blank', 'duplicate') AS gone, CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END AS late,
             {{'c': 1000000000::BIGINT, 'a': '', 'r': ''}} AS dead
      FROM searched AS s JOIN faulty AS f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = s.i + 1))),
ended AS (
  SELECT conv_id, list_min([s0, {_ASSISTANT}]) AS best
  FROM (SELECT *, {_USER} AS i2 FROM searched WHERE i = n))
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(substr(coalesce(best.r, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN counts AS c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended AS e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def all_sql() -> dict[str, str]:
    return {
        "op3_mixing": OP3_MIXING,
        "op4_url_filter": OP4_URL_FILTER,
        "op7_top_k": OP7_TOP_K,
        "op8_exact_dedup": OP8_EXACT_DEDUP,
        "op10_chat": OP10_CHAT,
        "op12_repair": OP12_REPAIR,
    }
