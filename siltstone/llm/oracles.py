"""DuckDB SQL for the text queries that SQL can express on small tables."""

from __future__ import annotations

#: Levels that are spelled out: sources of up to 3 ** 12 documents, up to 3 ** 7 sources.
_HEIGHTS, _TOPS = 12, 7

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# CRC-32 as its definition has it: the table of all bytes, then a step per byte.
_CRC_TABLE = """
  SELECT list_transform(range(256), lambda n: list_reduce(
    [n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"""


def _crc(numbers: str) -> str:
    """CRC-32 of a list of bytes, with the table as ``t``."""
    step = "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {numbers}), {step}), 4294967295)"


def _field(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({name}::VARCHAR) || ':' || {name}::VARCHAR END"


def _merkle() -> str:
    fields = " || ".join(f"({_field(f)})" for f in ("doc_id", "source", "lang", "n_chars"))
    whole, cut = (f"sha256({fields} || {_field(t)})" for t in ("text", "cut"))
    digits = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)"
    parts = [
        f"crc AS ({_CRC_TABLE})",
        f"cut AS (SELECT *, replace(text, chr(10), '') AS cut, {_crc(digits)} % 2 = 0 AS hit FROM documents, crc)",
        f"hashed AS (SELECT doc_id, source, {whole} AS leaf, CASE WHEN hit THEN {cut} ELSE {whole} END AS f FROM cut)",
        """leaves AS MATERIALIZED (
          SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                 count(*) OVER (PARTITION BY source) AS n FROM hashed)""",
        "lv0 AS (SELECT source, pos, n, leaf AS d FROM leaves)",
        "f0 AS (SELECT doc_id, source, leaf, pos, n, f, '' AS sib FROM leaves)",
    ]
    parts += _climbs("lv", "f", "doc_id, source, leaf", "source", _HEIGHTS)
    tops = " UNION ALL ".join(f"SELECT source, d FROM lv{h} WHERE n <= {3**h}" for h in range(_HEIGHTS + 1))
    parts += [
        f"subroots AS MATERIALIZED ({tops})",
        """tv0 AS MATERIALIZED (
          SELECT 0 AS source, source AS own, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
                 count(*) OVER () AS n, d FROM subroots)""",
        f"""g0 AS (
          SELECT doc_id, 0 AS source, leaf, tv0.d AS subroot, tv0.pos, tv0.n, f, sib
          FROM f{_HEIGHTS} JOIN tv0 ON f{_HEIGHTS}.source IS NOT DISTINCT FROM tv0.own)""",
    ]
    parts += _climbs("tv", "g", "doc_id, source, leaf, subroot", "source", _TOPS)
    roots = " UNION ALL ".join(f"SELECT d FROM tv{h} WHERE n <= {3**h}" for h in range(_TOPS + 1))
    return f"""
WITH {", ".join(parts)}, root AS ({roots})
SELECT doc_id, leaf, subroot, d AS root, sha256(sib) AS proof_sha256, f AS folded_root, f = d AS verified
FROM g{_TOPS}, root"""


def _climbs(level: str, folded: str, kept: str, group: str, heights: int) -> list[str]:
    parts = []
    for h in range(heights):
        more = f"n > {3**h}"
        left = "coalesce(array_to_string(ds[1:(pos % 3)], ''), '')"
        right = "coalesce(array_to_string(ds[(pos % 3) + 2:], ''), '')"
        parts += [
            f"""{level}r{h} AS MATERIALIZED (
              SELECT {group} AS run_of, pos // 3 AS up, any_value(n) AS n_run, list(d ORDER BY pos) AS ds
              FROM {level}{h} WHERE {more} GROUP BY {group}, pos // 3)""",
            f"""{level}{h + 1} AS MATERIALIZED (
              SELECT run_of AS {group}, up AS pos, n_run AS n, sha256(array_to_string(ds, '')) AS d FROM {level}r{h})""",
            f"""{folded}{h + 1} AS MATERIALIZED (
              SELECT {kept}, pos // 3 AS pos, n, CASE WHEN ds IS NULL THEN f ELSE sha256({left} || f || {right}) END AS f,
                     CASE WHEN ds IS NULL THEN sib ELSE sib || {left} || {right} END AS sib
              FROM {folded}{h} LEFT JOIN {level}r{h}
                ON {group} IS NOT DISTINCT FROM run_of AND pos // 3 = up AND {more})""",
        ]
    return parts


_LINES = f"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key
  FROM split),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT keyed.*, keeper IS NOT NULL AND keeper <> doc_id AS dropped FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

# Letters beyond ASCII, each as one ASCII character that is no letter, for a distance that counts bytes.
_BEYOND = "".join(chr(c) for c in range(0xC0, 0x100))
_PLAIN = "".join(chr(c) for c in range(1, 128) if not chr(c).isalpha() and chr(c) not in "'\\\n\r")[: len(_BEYOND)]

_VARIANTS = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), '{_UPPER}', '{_LOWER}') AS run
  FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, {_crc('''flatten(list_transform(string_split(doc_id || ':' || run, ''),
    lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [195::BIGINT, ord(x)::BIGINT - 64] END))''')} AS h
  FROM counted, crc),
cut AS (
  SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
            ELSE run END AS word FROM hashed),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n, translate(word, '{_BEYOND}', '{_PLAIN}') AS plain
  FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shortened AS (
  SELECT word, n, plain, plain AS key FROM words
  UNION
  SELECT word, n, plain, unnest(list_transform(range(1, length(plain) + 1),
    lambda i: substr(plain, 1, i - 1) || substr(plain, i + 1))) FROM words),
near AS MATERIALIZED (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n
  FROM shortened a JOIN shortened b USING (key) WHERE a.word <> b.word AND levenshtein(a.plain, b.plain) = 1),
best AS (
  SELECT word, count(*) AS n_near, arg_min(struct_pack(w := other, n := other_n), (-other_n, other)) AS top
  FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN top.n >= 10 * words.n THEN top.w END AS form,
         CASE WHEN top.n >= 10 * words.n THEN top.n END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word),
ways AS (
  SELECT word, word AS at_word FROM forms
  UNION ALL
  SELECT ways.word, forms.form FROM ways JOIN forms ON ways.at_word = forms.word WHERE forms.form IS NOT NULL)
SELECT forms.word, forms.form, ways.at_word AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN ways ON forms.word = ways.word JOIN forms last ON ways.at_word = last.word AND last.form IS NULL
"""

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

_REMOVED = f"""
WITH words AS (
  SELECT doc_id, unnest({_WORDS}) AS w, generate_subscripts({_WORDS}, 1) AS i FROM documents),
windows AS (
  SELECT *, CASE WHEN count(*) OVER ahead = 50 THEN md5(string_agg(w, ' ') OVER ahead) END AS key FROM words
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
hits AS (
  SELECT doc_id, i, w, key IS NOT NULL AND min(doc_id) OVER (PARTITION BY key) < doc_id AS hit FROM windows),
judged AS (
  SELECT *, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM hits),
counted AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         string_agg(w, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM judged GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN counted USING (doc_id)
"""

_NEAR = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, translate(unnest({_WORDS}), '{_UPPER}', '{_LOWER}') AS w, generate_subscripts({_WORDS}, 1) AS i
  FROM documents),
runs AS (
  SELECT doc_id, i, string_agg(w, ' ') OVER ahead AS shingle, count(*) OVER ahead AS n,
         count(*) OVER (PARTITION BY doc_id) AS n_words
  FROM words WINDOW ahead AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(shingle) AS shingle FROM runs WHERE n = 5 OR (n_words < 5 AND i = 1)),
sizes AS (SELECT doc_id, count(*) AS n_shingles FROM shingles GROUP BY doc_id),
both_have AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
near AS MATERIALIZED (
  SELECT x, y FROM both_have JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * n >= 85 * (s.n_shingles + t.n_shingles - n)),
links AS MATERIALIZED (SELECT x, y FROM near UNION ALL SELECT y, x FROM near),
reached AS (
  SELECT DISTINCT x AS doc_id, x AS other FROM links
  UNION
  SELECT reached.doc_id, links.y FROM reached JOIN links ON reached.other = links.x),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_shingles, 0) AS n_shingles, coalesce(component_id, documents.doc_id) AS component_id,
       coalesce(component_id, documents.doc_id) = documents.doc_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""

ORACLES = {
    "op9_substring_dedup": _REMOVED,
    "op10_minhash_near_dedup": _NEAR,
    "op11_merkle_manifest": _merkle(),
    "op12_line_dedup": _LINES,
    "op13_spelling_variants": _VARIANTS,
}
