"""DuckDB SQL for typed tokens: a walk over positions by recursion, without look-around.

A walk starts at each run of characters between blanks and takes one token a step. What a look-behind would see
is one character, kept beside the position; what a look-ahead would see follows the token in the pattern. Only a
date goes on behind a blank, so only a walk with a date can reach runs that have walks of their own; those that
it passed do not count.
"""

from __future__ import annotations

# The shapes of dates and times, written again so that a slip in the engine's shows.
DATE = (
    r"\b(?:January|March|April|May|June|July|August|September|October|November|December|Jan|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
    r"\s(?:[0-9]|[1-2][0-9]|3[0-1]),\s\d{4}\b"
    r"|\b(?:[0-9]|[1-2][0-9]|3[0-1])\s"
    r"(?:January|March|April|May|June|July|August|September|October|November|December|Jan|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s\d{4}\b"
    r"|\b(?:Feb|February)(?:[0-9]|1[0-9]|2[0-8])\s,\s\d{4}\b"
    r"|\b(?:[0-9]|1[0-9]|2[0-8])\s(?:Feb|February)\s\d{4}\b"
)
TIME = (
    r"\b(?:[0-9]|1[0-2])\.[0-5][0-9](?:PM|AM)\b"
    r"|\b(?:[0-9]|1[0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\b"
    r"|\b(?:0[0-9]|1[0-2])[0-5][0-9](?:a|p)\.m\."
)
# A number ends where no digits can follow, so that what must not come next can be asked for as what may.
_NUMBER = r"([+-]?[0-9]+(?:\.\d{3}|,\d{3}|[0-9])*(?:\.\d+)?)(?:$|[^\w%.,]|[.,](?:$|\W))"
_LETTERS = r"\b(?:[a-z]+-[a-z]+)*[a-z]+(?:''[a-z]+)?\b"

# A date is shorter than this.
_AHEAD = 40

# The text with one ASCII character for each that is not: patterns of this engine know words and blanks of ASCII only.
# Digits of other scripts count as letters here.
_MASKED = (
    r"regexp_replace(regexp_replace(regexp_replace(translate(body, 'İıſK', 'iisk'), "
    r"'[\t\x0B\f\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]', ' ', 'g'), "
    r"'[^\x00-\x7F\p{L}\p{M}\p{N}\p{Pc}]', '~', 'g'), '[^\x00-\x7F]', '_', 'g')"
)


def _length(pattern: str, group: int = 0) -> str:
    return f"length(regexp_extract(rest, '(?i)^(?:{pattern})', {group}))"


# A step: where it stands, what is left, and the token that begins there. ``before`` is the character before, '' at the start.
_TAKEN = f"""
    SELECT doc_id, start, place, stop, rest, before,
        CASE WHEN regexp_matches(before, '\\w') THEN 0 ELSE {_length(DATE)} END AS date_len,
        CASE WHEN regexp_matches(before, '\\w') THEN 0 ELSE {_length(TIME)} END AS time_len,
        CASE WHEN regexp_matches(before, '\\s') THEN {_length('([0-9]+%)(?s:.)', 1)} ELSE 0 END AS percent_len,
        CASE WHEN before = '' OR regexp_matches(before, '[\\s(]') THEN {_length(_NUMBER, 1)} ELSE 0 END AS number_len,
        CASE WHEN before IN ('', chr(10)) THEN {_length(_LETTERS)}
             WHEN regexp_matches(before, '\\s') THEN {_length(_LETTERS + "''?")} ELSE 0 END AS word_len
"""
_CLASSED = """
    SELECT doc_id, start, place, stop, rest, before,
        CASE WHEN date_len > 0 THEN date_len WHEN time_len > 0 THEN time_len WHEN percent_len > 0 THEN percent_len
             WHEN number_len > 0 THEN number_len WHEN word_len > 0 THEN word_len ELSE 1 END AS len,
        CASE WHEN date_len > 0 THEN 'DATE' WHEN time_len > 0 THEN 'TIME' WHEN percent_len > 0 THEN 'PERCENT'
             WHEN number_len > 0 THEN 'NUMBER' WHEN word_len > 0 THEN 'WORD' ELSE 'OTHER' END AS cls
"""


def _step(states: str) -> str:
    return f"{_CLASSED} FROM ({_TAKEN} FROM ({states}))"


_MOVED = f"""
    SELECT doc_id, start, place + len AS place,
        CASE WHEN place + len > stop THEN place + len + length(regexp_extract(substr(masked, place + len + 1), '^\\S*')) ELSE stop END AS stop,
        CASE WHEN place + len > stop
             THEN substr(masked, place + len + 1, length(regexp_extract(substr(masked, place + len + 1), '^\\S*')) + {_AHEAD})
             ELSE substr(rest, len + 1) END AS rest,
        substr(rest, len, 1) AS before
    FROM walk JOIN masks USING (doc_id) WHERE place + len <> stop AND place + len < total
        AND (place + len < stop OR NOT regexp_matches(substr(masked, place + len + 1, 1), '\\s'))
"""

_CTES = rf"""
    WITH RECURSIVE masks AS MATERIALIZED (
        SELECT doc_id, body, length(body) AS total, {_MASKED} AS masked FROM (SELECT doc_id, text AS body FROM documents)
    ), pieces AS (
        SELECT doc_id, unnest(found) AS piece, generate_subscripts(found, 1) AS no
        FROM (SELECT doc_id, regexp_extract_all(masked, '\s+|\S+') AS found FROM masks)
    ), runs AS MATERIALIZED (
        SELECT doc_id, piece, length(piece) AS len, (sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY no))::bigint - length(piece) AS start
        FROM pieces
    ), begun AS (
        SELECT doc_id, start AS start, start AS place, (start + len)::bigint AS stop,
            substr(masked, start + 1, len + {_AHEAD}) AS rest, CASE WHEN start = 0 THEN '' ELSE substr(masked, start, 1) END AS before
        FROM runs JOIN masks USING (doc_id) WHERE NOT regexp_matches(piece, '^\s')
    ), walk AS (
        {_step("SELECT * FROM begun")}
        UNION ALL
        {_step(_MOVED)}
    ), jumps AS MATERIALIZED (
        SELECT doc_id, start, max(place + len) AS reach FROM walk GROUP BY ALL HAVING bool_or(cls = 'DATE')
    ), live AS (
        SELECT doc_id, min(start) AS start, arg_min(reach, start) AS reach FROM jumps GROUP BY doc_id
        UNION ALL
        SELECT j.doc_id, min(j.start), arg_min(j.reach, j.start) FROM live l JOIN jumps j ON j.doc_id = l.doc_id AND j.start >= l.reach
        GROUP BY j.doc_id
    ), every AS (
        SELECT doc_id, start, place, len, cls FROM walk
        UNION ALL SELECT doc_id, start, start, len, 'SPACE' FROM runs WHERE regexp_matches(piece, '^\s')
    ), kept AS (
        SELECT * FROM every e WHERE NOT EXISTS (
            SELECT 1 FROM live l WHERE l.doc_id = e.doc_id AND l.start < e.start AND e.start < l.reach)
    )
"""

TYPED_TOKENS = f"""{_CTES} SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1)::integer AS pos,
    substr(body, place + 1, len) AS token, cls FROM kept JOIN masks USING (doc_id)"""

# The classes.
_COUNTS = ", ".join(
    f"CASE WHEN total IS NOT NULL THEN count(cls) FILTER (cls = '{c}') END AS {c}"
    for c in ("DATE", "TIME", "PERCENT", "NUMBER", "WORD", "SPACE", "OTHER")
)
TOKEN_CLASS_COUNTS = f"{_CTES} SELECT doc_id, {_COUNTS} FROM masks LEFT JOIN kept USING (doc_id) GROUP BY doc_id, total"
