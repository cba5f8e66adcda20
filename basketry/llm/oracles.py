"""Expected results in SQL for DuckDB, from the definition of each result."""

from __future__ import annotations


def _edit(path: str, cost: int | str, letter: str) -> str:
    """A path, written as twelve digits of cost and its edits, with one edit more."""
    total = f"lpad(CAST(CAST(left({path}, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0')"
    return f"{total} || substr({path}, 13) || '{letter}'"


def _kept(path: str, initial: str) -> str:
    return f"CASE WHEN letter = '{initial}' AND NOT gone THEN {_edit(path, 'added', 'K')} END"


def _reroled(path: str) -> str:
    return f"CASE WHEN NOT gone THEN {_edit(path, '3 + added', 'R')} END"


#: The least path to each of four states: anything, a user (after system), an assistant, or
#: a user or the end may come next. Paths compare as text, by cost and then by their edits.
REPAIRED_CONVERSATIONS = rf"""WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
    FROM conversations
), kinds AS (
    SELECT *, xor(4294967295, list_reduce(
        [CAST(4294967295 AS BIGINT)] || list_transform(range(1, len(name) + 1),
            lambda i: CAST(ascii(substr(name, i, 1)) AS BIGINT)),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)
    )) % 20 AS kind
    FROM named
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM kinds WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
        NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
        right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1)
            NOT IN ('.', '!', '?') AS unfinished
    FROM damaged
), faults AS (
    SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS duplicate,
        left(role, 1) AS letter,
        left(lag(role) OVER (PARTITION BY conv_id ORDER BY place), 1) || left(role, 1)
            NOT IN ('su', 'ua', 'au') AS illegal
    FROM placed
), marked AS (
    SELECT *, blank OR duplicate AS gone, NOT blank AND NOT duplicate AND unfinished AS truncated,
        CASE WHEN unfinished THEN 3 ELSE 0 END AS added
    FROM faults
), paths AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS place, '000000000000' AS a0, CAST(NULL AS VARCHAR) AS a1,
        '000000000003I' AS a2, '000000000006II' AS a3
    FROM named
    UNION ALL
    SELECT conv_id, place, r0, r1, g2, least(r3, {_edit('g2', 3, 'I')}) FROM (
        SELECT *, least(r2, {_edit('r0', 3, 'I')}, {_edit('r1', 3, 'I')}, {_edit('r3', 3, 'I')}) AS g2
        FROM (
            SELECT paths.conv_id, marked.place, {_edit('a0', 4, 'D')} AS r0,
                least({_edit('a1', 4, 'D')}, {_kept('a0', 's')}) AS r1,
                least({_edit('a2', 4, 'D')}, {_kept('a0', 'u')}, {_kept('a1', 'u')}, {_kept('a3', 'u')},
                    {_reroled('a0')}, {_reroled('a1')}, {_reroled('a3')}) AS r2,
                least({_edit('a3', 4, 'D')}, {_kept('a2', 'a')}, {_reroled('a2')}) AS r3
            FROM paths JOIN marked ON paths.conv_id IS NOT DISTINCT FROM marked.conv_id
                AND marked.place = paths.place + 1
        ) AS stepped
    ) AS inserted
), best AS (
    SELECT conv_id, least(arg_max(a0, place), arg_max(a3, place)) AS path FROM paths GROUP BY conv_id
), solved AS (
    SELECT conv_id, CAST(left(path, 12) AS BIGINT) AS cost, substr(path, 13) AS audit FROM best
), edits AS (
    SELECT conv_id, i AS number, audit[i] AS edit,
        len(replace(left(audit, i), 'I', '')) AS place, len(replace(left(audit, i), 'D', '')) - 1 AS output
    FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS i FROM solved) AS listed
), written AS (
    SELECT edits.*, marked.role, CASE WHEN edit = 'I' THEN '' ELSE marked.text END AS text,
        max(CASE WHEN output = 0 AND edit = 'K' AND letter = 's' THEN 1 ELSE 0 END)
            OVER (PARTITION BY edits.conv_id) AS led
    FROM edits LEFT JOIN marked ON edits.conv_id IS NOT DISTINCT FROM marked.conv_id
        AND edits.place = marked.place
    WHERE edit <> 'D'
), lines AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (output - led) % 2 = 0 THEN 'user'
        ELSE 'assistant' END || ':' || text, chr(10) ORDER BY number) AS text
    FROM written GROUP BY conv_id
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
        count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
    FROM marked GROUP BY conv_id
)
SELECT solved.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(lines.text, '')) AS repaired_sha256
FROM solved LEFT JOIN counts ON solved.conv_id IS NOT DISTINCT FROM counts.conv_id
    LEFT JOIN lines ON solved.conv_id IS NOT DISTINCT FROM lines.conv_id"""


#: Words covered by a window of 13 words that also starts in a smaller document go.
WITHOUT_REPEATS = r"""WITH listed AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS text
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM listed) AS started
), firsts AS (
    SELECT text, min(doc_id) AS least FROM windows GROUP BY text
), removed AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place
    FROM windows JOIN firsts USING (text) WHERE least < doc_id
), placed AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM listed
), counted AS (
    SELECT placed.doc_id, count(*) AS n_words, count(removed.place) AS n_removed,
        string_agg(word, ' ' ORDER BY placed.place) FILTER (removed.place IS NULL) AS kept
    FROM placed LEFT JOIN removed ON placed.doc_id = removed.doc_id AND placed.place = removed.place
    GROUP BY placed.doc_id
)
SELECT listed.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM listed LEFT JOIN counted ON listed.doc_id = counted.doc_id"""


#: The 50 best documents of each item, terms weighed by how few documents hold them.
RANKED_DOCUMENTS = r"""WITH listed AS (
    SELECT doc_id, row_number() OVER () AS document, regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents WHERE text IS NOT NULL
), sums AS (
    SELECT CAST(count(*) AS BIGINT) AS documents, CAST(sum(len(w)) AS BIGINT) AS terms
    FROM listed WHERE len(w) > 0
), postings AS (
    SELECT document, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
    FROM (SELECT document, doc_id, len(w) AS n, unnest(w) AS term FROM listed) AS placed GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * df + 1))) AS BIGINT) AS weight
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term) AS held, sums
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scores AS (
    SELECT item_id, doc_id, document, CAST(sum(weight * ((1000000000 * tf)
        // (1000 * tf + 20 * (50 + (50 * n * documents) // terms)))) AS BIGINT) AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term), sums
    GROUP BY item_id, doc_id, document
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
    FROM scores WHERE score > 0) AS ranked
WHERE rank <= 50"""
