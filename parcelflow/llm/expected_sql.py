"""The expected rows of the queries that SQL can express."""

import corpus_pipeline

# The template of the chat formatter: control strings get a backslash after their first character.
_ESCAPE = r"""regexp_replace({0}, '([<\[])(\\*)(/?s>|/?INST\]|ANS\]|TEXT\]|NEXT\])', '\1\\\2\3', 'g')"""


def _crc32(value: str) -> str:
    """CRC-32 of a text's UTF-8 bytes: its bytes folded into the register, eight bit steps a byte."""
    hexed = f"hex(encode({value}))"
    data = f"list_transform(range(length({hexed}) // 2), lambda i: ('0x' || substr({hexed}, 2 * i::BIGINT + 1, 2))::UBIGINT)"
    step = "lambda x, bit: xor(x >> 1, (x & 1) * 3988292384::UBIGINT)"
    fold = f"lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], {step})"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {data}), {fold}), 4294967295::UBIGINT)"


_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = {
    "op2_chat_format": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, coalesce(role <> lag(role) OVER w, true) AS opens
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), sized AS (
  SELECT *,
    length({_ESCAPE.format("text")})
      + CASE WHEN NOT opens THEN length('[NEXT]')
             WHEN role = 'assistant' THEN length('[ANS][TEXT]</s>') + length({_ESCAPE.format("role")})
             ELSE length('[INST][TEXT][/INST]') + length({_ESCAPE.format("role")}) END AS chars
  FROM marked
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (length('<s>') + sum(chars))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
""",
}

ORACLE["op13_importance_resampling"] = f"""
WITH doc_words AS (
  SELECT rowid_, doc_id, {_WORDS.format("text")} AS words
  FROM (SELECT row_number() OVER () AS rowid_, doc_id, text FROM documents)
), sides AS (
  SELECT 0 AS target, rowid_, unnest(words) AS word FROM doc_words
  UNION ALL SELECT 1, 0, unnest({_WORDS.format("text")}) FROM benchmark
), buckets AS (
  SELECT word, ({_crc32("word")} % 10000)::BIGINT AS bucket FROM (SELECT DISTINCT word FROM sides)
), counts AS (
  SELECT bucket, count(*) FILTER (WHERE target = 0) AS s, count(*) FILTER (WHERE target = 1) AS t
  FROM sides JOIN buckets USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                                 / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
  FROM counts
), weights AS (
  SELECT rowid_, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM sides JOIN buckets USING (word) JOIN gains USING (bucket) WHERE target = 0 GROUP BY rowid_
), scored AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight, rowid_,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE
                                               / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM doc_words LEFT JOIN weights USING (rowid_)
), placed AS (
  SELECT *, CASE WHEN n_features >= 20
    THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, rowid_) END AS place
  FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20) THEN place END::BIGINT AS rank
FROM placed
"""

ORACLE["op12_turn_repair"] = f"""
WITH RECURSIVE damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE fault WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
    FROM conversations
  ) WHERE fault <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n,
    dense_rank() OVER (ORDER BY conv_id) AS c, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
  FROM damaged
), judged AS (
  SELECT *, left(role, 1) AS initial,
    CASE WHEN solid = '' THEN 'blank'
         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
         WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), steps AS (  -- state after inserting so often: nothing 0, system 1, user 2, assistant 3
  SELECT * FROM (VALUES (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3),
                        (2, 0, 2), (2, 1, 3), (2, 2, 2), (3, 0, 3), (3, 1, 2), (3, 2, 3)) AS s(p, inserted, at_)
), acts AS (
  SELECT at_, at_ AS q, 'D' AS letter, 3 AS cost, '' AS needs FROM (VALUES (0), (1), (2), (3)) AS a(at_)
  UNION ALL SELECT * FROM (VALUES (0, 2, 'R', 2, 'any'), (1, 2, 'R', 2, 'any'), (2, 3, 'R', 2, 'any'), (3, 2, 'R', 2, 'any'),
    (0, 1, 'K', 0, 's'), (0, 2, 'K', 0, 'u'), (1, 2, 'K', 0, 'u'), (3, 2, 'K', 0, 'u'), (2, 3, 'K', 0, 'a')) AS a(at_, q, letter, cost, needs)
), moves AS (
  SELECT p, q, 2 * inserted + cost AS cost, repeat('I', inserted) || letter AS letters, needs, letter
  FROM steps JOIN acts USING (at_)
), best AS (
  SELECT c, 0::BIGINT AS n, 0 AS q, {{'cost': 0::BIGINT, 'audit': ''}} AS found FROM (SELECT DISTINCT c FROM judged)
  UNION ALL
  SELECT b.c, b.n + 1, m.q,
    min({{'cost': found.cost + m.cost + (fault = 'truncated' AND letter <> 'D')::BIGINT, 'audit': found.audit || letters}}) AS found
  FROM best b JOIN judged j ON j.c = b.c AND j.n = b.n + 1
  JOIN moves m ON m.p = b.q AND (m.needs = '' OR (fault NOT IN ('blank', 'duplicate') AND (m.needs = 'any' OR m.needs = initial)))
  GROUP BY b.c, b.n, m.q
), ended AS (
  SELECT c, min({{'cost': found.cost + tail.cost, 'audit': found.audit || letters}}) AS found
  FROM best JOIN (SELECT c, max(n) AS n FROM judged GROUP BY c) USING (c, n)
  JOIN (VALUES (0, 0, ''), (1, 4, 'II'), (2, 2, 'I'), (3, 0, '')) AS tail(q, cost, letters) USING (q)
  GROUP BY c
), letters AS (
  SELECT c, found.audit AS audit, unnest(range(1, length(found.audit) + 1)) AS i FROM ended
), outputs AS (
  SELECT c, i, substr(audit, i, 1) AS letter,
    1 + length(regexp_replace(substr(audit, 1, i - 1), 'I', '', 'g')) AS n,
    length(regexp_replace(substr(audit, 1, i - 1), 'D', '', 'g')) AS before
  FROM letters
), written AS (
  SELECT o.c, o.i, CASE letter WHEN 'K' THEN j.role
      WHEN 'D' THEN NULL ELSE CASE WHEN (before - first.system) % 2 = 0 THEN 'user' ELSE 'assistant' END END AS role,
    CASE letter WHEN 'I' THEN '' WHEN 'D' THEN NULL ELSE j.text END AS text
  FROM outputs o LEFT JOIN judged j ON j.c = o.c AND j.n = o.n
  JOIN (
    SELECT o.c, coalesce(max((before = 0 AND letter = 'K' AND initial = 's')::INT), 0) AS system
    FROM outputs o LEFT JOIN judged j ON j.c = o.c AND j.n = o.n GROUP BY o.c
  ) first ON first.c = o.c
), texts AS (
  SELECT c, string_agg(role || ':' || text, chr(10) ORDER BY i) AS whole FROM written WHERE role IS NOT NULL GROUP BY c
), figures AS (
  SELECT conv_id, c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before_ IS NOT NULL AND before_ || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(initial) OVER (PARTITION BY c ORDER BY n) AS before_ FROM judged) GROUP BY conv_id, c
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(found.cost, 0)::BIGINT AS cost,
  coalesce(found.audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended USING (c) LEFT JOIN texts USING (c)
"""

if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
