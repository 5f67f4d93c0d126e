"""DuckDB SQL for the operators on substrings, conversations and resampling."""

from __future__ import annotations

#: One row with the 256 remainders of CRC-32, for `crc32`.
CRC_TABLE = """crc_table AS (
    SELECT list(c ORDER BY b) AS crcs
    FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) AS bytes(b)
    )
)"""


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, for queries that have ``crc_table`` beside them."""
    hexes = f"hex(encode({text}))"
    octets = f"list_transform(range(len({hexes}) // 2), lambda i: CAST('0x' || substr({hexes}, 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, crcs[xor(c, b) % 256 + 1])), 4294967295)"


SPACES = r"\x20\x09-\x0D"

SUBSTRINGS = rf"""
    WITH texts AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS doc,
               list_filter(regexp_split_to_array(coalesce(text, ''), '[{SPACES}]+'), lambda x: x <> '') AS words
        FROM documents
    ), windows AS (
        SELECT r, {{'doc': doc, 'start': s}} AS place, s, array_to_string(words[s:s + 19], ' ') AS window_text
        FROM (SELECT r, doc, words, unnest(range(1, len(words) - 18)) AS s FROM texts)
    ), later AS (
        SELECT r, s FROM (SELECT r, s, place, min(place) OVER (PARTITION BY window_text) AS first_place FROM windows) WHERE place > first_place
    ), covered AS (
        SELECT DISTINCT r, s + unnest(range(20)) AS i FROM later
    ), kept AS (
        SELECT r, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS kept
        FROM (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM texts) AS each
        ANTI JOIN covered USING (r, i)
        GROUP BY r
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM texts LEFT JOIN kept USING (r)"""


def _state(audit: str, cost: str, line: str, after: str) -> str:
    """The rest of a conversation with one more edit before it: cost, audit, lines."""
    lines = f"list_prepend({line}, {after}.b)" if line else f"{after}.b"
    return f"{{'c': {cost} + {after}.c, 'a': '{audit}' || {after}.a, 'b': {lines}}}"


def _row_edits(state: int, onward: int, role: str, kept: list[tuple[str, int]]) -> str:
    """The cheapest edit of a row at a state that does not begin with an insertion."""
    more = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END + CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 ELSE 0 END"
    edits = [_state("D", "4", "", f"v{state}"), _state("R", f"3 + {more}", f"'{role}:' || text", f"v{onward}")]
    for initial, to in kept:
        edits.append(_state("K", f"CASE WHEN left(role, 1) = '{initial}' THEN 0 ELSE 1000000000 END + {more}", "role || ':' || text", f"v{to}"))
    return f"list_min([{', '.join(edits)}])"


# State, the state behind the only role that may come next, that role, and what may be kept.
_STATES = [(0, 2, "user", [("s", 1), ("u", 2)]), (1, 2, "user", [("u", 2)]), (2, 3, "assistant", [("a", 3)]), (3, 2, "user", [("u", 2)])]
_EDITED = ", ".join(f"{_row_edits(*state)} AS e{state[0]}" for state in _STATES)
_BEST = ", ".join(
    f"list_min([e{state}, {_state('I', '3', repr(role + ':'), f'e{onward}')}]) AS v{state}" for state, onward, role, _ in _STATES
)

CONVERSATIONS = rf"""
    WITH RECURSIVE {CRC_TABLE}, fates AS (
        SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), '') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fate
        FROM conversations, crc_table
    ), damaged AS (
        SELECT conv, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
               CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM fates WHERE fate <> 0
        UNION ALL
        SELECT conv, turn, role, text FROM fates WHERE fate = 3
    ), numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || ':' || text)) AS i
        FROM damaged
    ), faulty AS (
        SELECT conv, turn, role, text, i, lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) AS before,
               CASE WHEN NOT regexp_matches(text, '[^{SPACES}]') THEN 'blank'
                    WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
                    WHEN NOT regexp_matches(text, '[.!?][{SPACES}]*\z') THEN 'truncated'
                    ELSE '' END AS fault
        FROM numbered
    ), counted AS (
        SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (before IS NOT NULL AND (before = '' OR before || left(role, 1) NOT IN ('su', 'ua', 'au'))) AS illegal
        FROM faulty GROUP BY conv
    ), solved AS (
        SELECT conv, n AS i, {{'c': 0, 'a': '', 'b': []::VARCHAR[]}} AS v0, {{'c': 6, 'a': 'II', 'b': ['user:', 'assistant:']}} AS v1,
               {{'c': 3, 'a': 'I', 'b': ['assistant:']}} AS v2, {{'c': 0, 'a': '', 'b': []::VARCHAR[]}} AS v3
        FROM counted
        UNION ALL
        SELECT conv, i - 1, {_BEST}
        FROM (SELECT solved.conv, solved.i, {_EDITED} FROM solved JOIN faulty ON faulty.conv = solved.conv AND faulty.i = solved.i)
    )
    SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(v0.c, 0) AS BIGINT) AS cost, coalesce(v0.a, '') AS audit,
           sha256(coalesce(array_to_string(v0.b, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, conv FROM fates)
    LEFT JOIN counted USING (conv)
    LEFT JOIN (SELECT conv, v0 FROM solved WHERE i = 0) USING (conv)"""

RESAMPLING = rf"""
    WITH {CRC_TABLE}, words AS (
        SELECT 0 AS kind, row_number() OVER () AS r, doc_id,
               list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
        FROM documents
        UNION ALL
        SELECT 1, row_number() OVER (), NULL,
               list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')
        FROM benchmark
    ), features AS (
        SELECT kind, r, unnest(w) AS feature FROM words
        UNION ALL
        SELECT kind, r, w[i] || ' ' || w[i + 1] FROM (SELECT kind, r, w, unnest(range(1, len(w))) AS i FROM words)
    ), bucket_of AS (
        SELECT feature, {crc32("feature")} % 10000 AS bucket FROM (SELECT DISTINCT feature FROM features), crc_table
    ), hashed AS (
        SELECT kind, r, bucket FROM features JOIN bucket_of USING (feature)
    ), totals AS (
        SELECT count(*) FILTER (kind = 0) AS big_s, count(*) FILTER (kind = 1) AS big_t FROM hashed
    ), gains AS (
        SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * (big_s + 10000) / (CAST(s + 1 AS DOUBLE) * (big_t + 10000)))) AS BIGINT) AS gain
        FROM (SELECT bucket, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t FROM hashed GROUP BY bucket), totals
    ), weighed AS (
        SELECT r, count(*) AS n_features, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
        FROM hashed JOIN gains USING (bucket) WHERE kind = 0 GROUP BY r
    ), scored AS (
        SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS long_enough,
               CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
        FROM words LEFT JOIN weighed USING (r) WHERE kind = 0
    ), placed AS (
        SELECT doc_id, n_features, weight, score, long_enough,
               row_number() OVER (PARTITION BY long_enough ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
               count(*) OVER (PARTITION BY long_enough) AS n
        FROM (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scored)
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN long_enough AND place <= 25 * n // 100 THEN place END AS rank
    FROM placed"""
