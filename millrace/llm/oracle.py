"""SQL of the operators that have one besides the URL filter."""

from __future__ import annotations

from millrace.llm.merkle import FAN, TAMPERED

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: Levels of the SQL's trees, enough for FAN ** 6 rows a source and as many sources.
_LEVELS = 6


def crc32(text: str) -> str:
    """The checksum of a text whose letters lie below U+0800, bit by bit."""
    octets = "CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 | (unicode(c) >> 6), 128 | (unicode(c) & 63)] END"
    octets = f"flatten(list_transform(string_split({text}, ''), lambda c: {octets}))"
    bits = f"flatten(list_transform({octets}, lambda o: list_transform(range(8), lambda k: (o >> k::INT) & 1)))"
    step = "lambda crc, bit: xor(crc >> 1, 3988292384 * (xor(crc, bit) & 1))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}::BIGINT[]), {step}), 4294967295)"


SPELLING = rf"""
WITH RECURSIVE runs AS (
    SELECT doc_id, translate(run, {_LOWER}) AS run, count(*) AS k
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL
), hashed AS (
    SELECT run, k, {crc32("doc_id::VARCHAR || ':' || run")} AS h FROM runs
), words AS MATERIALIZED (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
           sum(k)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(k) >= 3
), places AS (
    SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words
), masked AS (
    SELECT word, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS mask FROM places
), shorter AS (
    SELECT DISTINCT p.word, w.word AS edit
    FROM places p JOIN words w ON w.word = substr(p.word, 1, i - 1) || substr(p.word, i + 1)
), near AS (
    SELECT a.word, b.word AS edit FROM masked a JOIN masked b USING (i, mask) WHERE a.word <> b.word
    UNION ALL SELECT word, edit FROM shorter
    UNION ALL SELECT edit, word FROM shorter
), ranked AS (
    SELECT near.word, near.edit, w.n AS most, count(*) OVER (PARTITION BY near.word) AS n_near,
           row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, near.edit) AS place
    FROM near JOIN words w ON w.word = near.edit
), judged AS MATERIALIZED (
    SELECT w.word, CASE WHEN most >= 2 * n THEN edit END AS form, n, coalesce(n_near, 0) AS n_near,
           CASE WHEN most >= 2 * n THEN most END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1
), chain(word, last) AS (
    SELECT word, word FROM judged
    UNION ALL
    SELECT chain.word, judged.form FROM chain JOIN judged ON judged.word = chain.last WHERE judged.form IS NOT NULL
)
SELECT judged.word, judged.form, root.word AS root, judged.n, judged.n_near, judged.form_n
FROM judged JOIN chain ON chain.word = judged.word JOIN judged root ON root.word = chain.last AND root.form IS NULL
"""


def _value(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::VARCHAR))::VARCHAR || ':' || {column}::VARCHAR, '-')"


def _tree(name: str, start: str) -> list[str]:
    """The levels of a tree for each g and the runs between them: a tree's only node goes up unchanged."""
    parts = [f"{name}0 AS MATERIALIZED ({start})"]
    for k in range(_LEVELS):
        counted = f"SELECT *, count(*) OVER (PARTITION BY g) AS w FROM {name}{k}"
        parts.append(
            f"{name}r{k} AS MATERIALIZED (SELECT g, pos // {FAN} AS run, list(d ORDER BY pos) AS ds, max(w) AS w "
            f"FROM ({counted}) GROUP BY 1, 2)"
        )
        joined = "CASE WHEN w = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END"
        parts.append(f"{name}{k + 1} AS MATERIALIZED (SELECT g, run AS pos, {joined} AS d FROM {name}r{k})")
    return parts


def _climb(name: str, start: str, tree: str) -> list[str]:
    """Each row's way up a tree, level by level."""
    parts, last = [], start
    for k in range(_LEVELS):
        slot = f"(c.place % {FAN})::INT"
        before, after = f"array_to_string(ds[1:{slot}], '')", f"array_to_string(ds[{slot} + 2:], '')"
        parts.append(
            f"{name}{k} AS (SELECT c.* REPLACE (c.place // {FAN} AS place, "
            f"CASE WHEN w = 1 THEN folded ELSE sha256({before} || folded || {after}) END AS folded, "
            f"CASE WHEN w = 1 THEN proof ELSE proof || {before} || {after} END AS proof) "
            f"FROM {last} c JOIN {tree}r{k} r ON r.g = c.g AND r.run = c.place // {FAN})"
        )
        last = f"{name}{k}"
    return parts


def _merkle() -> str:
    head = " || ".join(map(_value, ("doc_id", "source", "lang", "n_chars")))
    lowered = _value(f"translate(text, {_LOWER})")
    top = _LEVELS - 1
    parts = [
        f"raw AS (SELECT doc_id, source, sha256({head} || {_value('text')}) AS leaf, "
        f"CASE WHEN {crc32('doc_id::VARCHAR')} % {TAMPERED} = 0 THEN sha256({head} || {lowered}) END AS other FROM documents)",
        "leaves AS MATERIALIZED (SELECT doc_id, leaf, coalesce(other, leaf) AS tampered, "
        "dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, "
        "row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM raw)",
        *_tree("s", "SELECT g, place AS pos, leaf AS d FROM leaves"),
        *_tree("t", f"SELECT 0 AS g, g AS pos, d FROM s{_LEVELS}"),
        "start AS (SELECT doc_id, leaf, g, place, tampered AS folded, '' AS proof FROM leaves)",
        *_climb("c", "start", "s"),
        f"middle AS (SELECT doc_id, leaf, g AS own, 0 AS g, g AS place, folded, proof FROM c{top})",
        *_climb("u", "middle", "t"),
    ]
    return f"""
WITH {", ".join(parts)}
SELECT doc_id, leaf, s.d AS subroot, t.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.d AS verified
FROM u{top} u JOIN s{_LEVELS} s ON s.g = u.own, t{_LEVELS} t
"""


MERKLE = _merkle()
