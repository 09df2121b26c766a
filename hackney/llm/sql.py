"""SQL for DuckDB that gives the rows of the registered queries which SQL can express."""

from __future__ import annotations

import re

from hackney.llm import licenses, secrets


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secret_spans() -> str:
    """Every rule's matches, and where they start: after all gaps and matches before them."""
    return " UNION ALL ".join(
        f"""
        SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, {r.least} AS least,
               string_split_regex(t, {_quoted(r.pattern)}) AS gaps,
               regexp_extract_all(t, {_quoted(r.pattern)}, 0) AS whole,
               regexp_extract_all(t, {_quoted(r.pattern)}, {r.group}) AS parts
        FROM texts"""
        for rank, r in enumerate(secrets.RULES)
    )


def _key_body() -> str:
    """How many code points after an opening line, ``gap``, belong to its key."""
    inside = f"trim(x, {_quoted(secrets.BREAKS)})"
    header = f"list_position(list_transform(lines, lambda x: {inside} = '' OR regexp_matches({inside}, {_quoted(secrets.HEADER)})), false)"
    return f"""
        SELECT *, CASE WHEN first > 0 AND regexp_matches(full_lines, '{secrets.A_LINE}')
                       THEN skipped + size + length(regexp_extract(rest[size + 1:], {_quoted(secrets.LAST_LINE)}, 0)) ELSE 0 END AS body
        FROM (SELECT *, length(rtrim(full_lines, {_quoted(secrets.BREAKS)})) AS size
              FROM (SELECT *, string_split_regex(rest, {_quoted(secrets.NOT_BASE64)})[1] AS full_lines
                    FROM (SELECT *, gap[skipped + 1:] AS rest
                          FROM (SELECT *, CASE WHEN first > 1 THEN length(array_to_string(lines[1:first - 1], 'x')) + 1 ELSE 0 END AS skipped
                                FROM (SELECT *, coalesce({header}, 0) AS first
                                      FROM (SELECT *, string_split_regex(gap, {_quoted(secrets.LINE_END)}) AS lines FROM opened))))))
    """


def _pattern(template: str) -> str:
    """A template as a regular expression over words that each end in a space."""
    out = ""
    for part in re.split("(<<.*?>>)", template):
        if part == "<<beginOptional>>":
            out += "(?:"
        elif part == "<<endOptional>>":
            out += ")?"
        elif part.startswith("<<var"):
            out += "(?:[^ ]+ )" + re.search(r"\{\d+,\d+\}", part)[0]
        else:
            out += "".join(f"{w} " for w in re.findall("[0-9a-z]+", part.lower()))
    return f" {out}"


def _phrase_places() -> str:
    return " UNION ALL ".join(
        f"""
        SELECT doc_id, unnest(list_filter(range(len(words)), lambda i:
               {" AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(phrase.split(), 1))})) AS place,
               '{label}' AS label FROM texts"""
        for phrase, label in licenses.PHRASES.items()
    )


def _template_labels() -> str:
    return " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label FROM texts WHERE regexp_matches(line, {_quoted(_pattern(t))})"
        for label, t in licenses.TEMPLATES.items()
    )


def _checksums() -> list[int]:
    """The table of CRC-32, a number per byte."""
    out = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        out.append(byte)
    return out


#: Words as op12 takes them, of a column ``text``.
WORDS = """list_filter(string_split(regexp_replace(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), lambda w: w <> '')"""

SQL: dict[str, str] = {
    "op3_license_templates": f"""
        WITH lines AS (
            SELECT doc_id, trim(regexp_replace(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' ') AS line
            FROM documents
        ),
        texts AS (
            SELECT doc_id, ' ' || line || ' ' AS line, list_filter(string_split(line, ' '), lambda w: w <> '') AS words
            FROM lines
        ),
        base AS ({_phrase_places()}),
        own AS ({_template_labels()}),
        places AS (
            SELECT doc_id, count(*) AS n, min(place) AS first, max(place) AS last,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY doc_id
        ),
        names AS (
            SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, bool_or(whole) AS whole
            FROM (SELECT doc_id, label, false AS whole FROM base UNION ALL SELECT doc_id, label, true FROM own)
            GROUP BY doc_id
        )
        SELECT t.doc_id, len(words) AS n_words, coalesce(n, 0) AS n_base, first AS first_word, last AS last_word,
               coalesce(p.labels, '') AS base_labels, coalesce(x.labels, '') AS labels,
               CAST(CASE WHEN whole THEN 1 WHEN n > 0 THEN 0.5 ELSE 0 END AS DOUBLE) AS score
        FROM texts t LEFT JOIN places p USING (doc_id) LEFT JOIN names x USING (doc_id)
    """,
    "op4_secret_ledger": f"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        matches AS ({_secret_spans()}),
        places AS (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM matches),
        marked AS (
            SELECT *, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                           + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
            FROM places WHERE length(parts[i]) >= least
        ),
        opened AS (
            SELECT doc_id, rank, kind, s, length(whole[i]) AS n, gaps[i + 1] || CASE WHEN i < len(whole) THEN '-' ELSE '' END AS gap,
                   whole[i + 1] AS following
            FROM marked WHERE kind = 'private_key' AND starts_with(whole[i], '{secrets.OPENS}')
        ),
        bodies AS ({_key_body()}),
        spans AS (
            SELECT doc_id, rank, kind, length(whole[i]) AS n, s FROM marked WHERE kind <> 'private_key'
            UNION ALL
            SELECT doc_id, rank, kind, n + CASE WHEN starts_with(following, '{secrets.CLOSES}') THEN length(gap) - 1 + length(following)
                                                ELSE body END, s
            FROM bodies
        ),
        told AS (SELECT *, kind || ':' || s || ':' || (s + n) AS span FROM spans)
        SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
               count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
               sha256(coalesce(string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 3), '')) AS base_sha256,
               coalesce(string_agg(span, ',' ORDER BY s, rank), '') AS spans
        FROM documents d LEFT JOIN told USING (doc_id) GROUP BY d.doc_id
    """,
    "op9_line_dedup": """
        WITH lines AS (
            SELECT doc_id, line, pos, lower_ascii AS key
            FROM (
                SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                       generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
                FROM documents
            ), LATERAL (
                SELECT translate(
                    trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
                ) AS lower_ascii
            )
        ), holders AS (
            SELECT key, min(doc_id) AS least FROM lines WHERE length(key) >= 10 GROUP BY key
        ), marked AS (
            SELECT l.*, coalesce(l.doc_id <> h.least, false) AS gone FROM lines l LEFT JOIN holders h USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op11_spelling_variants": f"""
        WITH RECURSIVE runs AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
            FROM documents
        ),
        counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
        bytes AS (
            SELECT *, list_transform(range(octet_length(encode(doc_id || ':' || run))),
                lambda i: CAST('0x' || hex(encode(doc_id || ':' || run))[2 * i + 1:2 * i + 2] AS BIGINT)) AS bytes
            FROM counted
        ),
        summed AS (
            SELECT doc_id, run, n, xor(4294967295, list_reduce(bytes,
                lambda crc, byte: xor(crc >> 8, CAST({_checksums()} AS BIGINT[])[(xor(crc, byte) & 255) + 1]), 4294967295::BIGINT)) AS h
            FROM bytes
        ),
        changed AS (
            SELECT n, CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word
            FROM summed
        ),
        words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
        ),
        less AS (
            SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
        ),
        near AS (
            SELECT a.word, b.word AS other, b.n FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM words a JOIN less b ON a.word = b.rest
            UNION SELECT b.word, a.word, a.n FROM words a JOIN less b ON a.word = b.rest
        ),
        best AS (
            SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS top FROM near GROUP BY word
        ),
        forms AS (
            SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * w.n THEN other END AS form,
                   CASE WHEN top >= 2 * w.n THEN top END AS form_n
            FROM words w LEFT JOIN best USING (word)
        ),
        chain AS (
            SELECT word, word AS root FROM forms
            UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL
        ),
        ends AS (SELECT c.word, c.root FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NULL)
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
    """,
    "op12_decontamination": f"""
        WITH texts AS (SELECT doc_id, {WORDS} AS words FROM documents),
        items AS (SELECT item_id, {WORDS} AS words FROM benchmark),
        sized AS (SELECT *, least(10, len(words)) AS size FROM items WHERE len(words) > 0),
        windows AS (
            SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS line
            FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM sized)
        ),
        places AS (
            SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS line
            FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM texts, (SELECT DISTINCT size FROM sized))
        ),
        found AS (SELECT doc_id, size, i, item_id FROM places JOIN windows USING (size, line)),
        hits AS (
            SELECT doc_id, count(DISTINCT word) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM (SELECT DISTINCT doc_id, size, i FROM found))
            GROUP BY doc_id
        ),
        names AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN names USING (doc_id)
    """,
}
