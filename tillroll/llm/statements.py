"""DuckDB statements of the corpus queries added with contamination, negatives and conversations."""

from __future__ import annotations

import string

from tillroll.llm import contamination


def op13_statement() -> str:
    n = contamination.WINDOW
    lower = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    words = rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH items AS (SELECT item_id, {words} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS passage
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i
        FROM (SELECT *, least(len(w), {n}) AS n FROM items WHERE len(w) > 0))
), docs AS (
  SELECT doc_id, row_number() OVER () AS r, {words} AS w FROM documents
), spots AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS passage
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows))
), hits AS (
  SELECT r, i, spots.n, item_id FROM spots JOIN windows USING (passage)
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n_hit FROM hits, range(0, {n}) AS t(k) WHERE k < n GROUP BY r
), found AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""


def op12_statement() -> str:
    return """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, a.label AS own, v.vec_id, v.label, CAST(list_inner_product(a.c, v.c) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.r <> v.r WHERE a.vec_id % 100 = 0
), firsts AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS p FROM scores WHERE label = own QUALIFY p <= 5
), ranked AS (
  SELECT f.anchor_id, f.vec_id AS positive_id, n.vec_id AS negative_id, f.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY f.a, f.p ORDER BY n.score DESC, n.vec_id) AS rank
  FROM firsts AS f JOIN scores AS n ON n.a = f.a AND n.label <> n.own
  WHERE 30 * f.score <= 100 * n.score AND 100 * n.score <= 90 * f.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10"""


def _way(state: str, cost: str, edit: str, line: str | None) -> str:
    """A state after one more edit, which puts a line into the repaired conversation or none."""
    out = f"{state}.o" if line is None else f"{state}.o || CASE WHEN {state}.o = '' THEN '' ELSE chr(10) END || {line}"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'o': {out}}} END"


def op11_statement() -> str:
    """All cheapest repairs of each prefix, row by row: cost, edits and text for each of the four states."""
    bytes_of = "list_transform(string_split(key, ''), lambda x: ascii(x))"
    crc = f"list_reduce(list_concat([4294967295], {bytes_of}), lambda c, b: xor(c >> 8, codes[(xor(c, b) & 255) + 1]))"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    stays = "fault IN ('ok', 'cut')"
    more = "(CASE fault WHEN 'cut' THEN 5 ELSE 0 END)"

    def to(state: int, ways: list[tuple[int, str]]) -> str:
        found = [_way(f"s{state}", "2", "D", None)]
        for start, role in ways:
            first = "system" if state == 1 else role
            found.append(
                f"CASE WHEN {stays} AND initial = '{first[0]}' THEN "
                + _way(f"s{start}", more, "K", "role || ':' || text") + " END"
            )
            if state != 1:
                rerole = _way(f"s{start}", f"1 + {more}", "R", f"'{role}:' || text")
                found.append(f"CASE WHEN {stays} THEN {rerole} END")
        return f"least({', '.join(found)}) AS s{state}"

    moved = ", ".join(
        [
            f"{_way('s0', '2', 'D', None)} AS s0",
            to(1, [(0, "system")]),
            to(2, [(0, "user"), (1, "user"), (3, "user")]),
            to(3, [(2, "assistant")]),
        ]
    )
    users = ", ".join(_way(f"s{i}", "5", "I", "'user:'") for i in (0, 1, 3))

    def closed(table: str) -> str:
        """With the insertions that may follow."""
        two = f"SELECT * REPLACE (least(s2, {users}) AS s2) FROM ({table})"
        return f"SELECT * REPLACE (least(s3, {_way('s2', '5', 'I', chr(39) + 'assistant:' + chr(39))}) AS s3) FROM ({two})"

    none = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR))"
    start = f"SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 'o': ''}} AS s0, {none} AS s1, {none} AS s2, {none} AS s3 FROM convs"
    ended = "rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    return f"""
WITH RECURSIVE table_ AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, k: {step})) AS codes
), marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor({crc}, 4294967295) % 20 AS kind
  FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
        FROM conversations), table_
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM marked
), placed AS (
  SELECT *, left(role, 1) AS initial, {ended} AS ended, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy) AS i
  FROM damaged
), lined AS (
  SELECT *, CASE WHEN ended = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(ended, 1) IN ('.', '!', '?') THEN 'ok' ELSE 'cut' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM placed
), convs AS (SELECT DISTINCT conv_id FROM conversations
), steps AS (
  {closed(start)}
  UNION ALL
  {closed(f"SELECT lined.conv_id, lined.i, {moved} FROM steps JOIN lined ON lined.i = steps.i + 1 AND lined.conv_id IS NOT DISTINCT FROM steps.conv_id")}
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'cut') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM lined GROUP BY conv_id
), ends AS (
  SELECT steps.conv_id, gaps, blank, duplicate, truncated, illegal, least(s0, s3) AS e
  FROM steps LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM steps.conv_id WHERE i = coalesce(n, 0)
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.c AS cost, e.a AS audit, sha256(e.o) AS repaired_sha256
FROM ends"""


def statements() -> dict[str, str]:
    return {
        "op11_conversation_repair": op11_statement(),
        "op12_hard_negatives": op12_statement(),
        "op13_decontamination": op13_statement(),
    }
