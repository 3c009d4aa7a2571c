"""DuckDB SQL of operators 12 and 13, written from their definitions."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

# crc32 by its table of 256 remainders; 3988292384 is the reversed polynomial
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(0, 256), lambda x: list_reduce([x] || range(0, 8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
)"""


def _lower(text: str) -> str:
    return f"translate({text}, '{ascii_uppercase}', '{ascii_lowercase}')"


def _crc(source: str, value: str) -> str:
    """``source`` with ``crc``, the unsigned crc32 of the column ``value``."""
    return f"""(
  SELECT b.* EXCLUDE (hx), xor(4294967295::BIGINT, list_reduce([4294967295::BIGINT] || list_transform(range(0, (length(hx) // 2)::BIGINT),
    lambda i: ((strpos('0123456789ABCDEF', hx[2*i+1]) - 1) * 16 + strpos('0123456789ABCDEF', hx[2*i+2]) - 1)::BIGINT),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS crc
  FROM (SELECT *, hex(encode({value})) AS hx FROM {source}) b, crc_table
)"""


OP12_SQL = f"""WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, {_lower("run")} AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL
),
keyed AS (SELECT *, id || ':' || run AS k FROM runs),
hashed AS (SELECT * FROM {_crc("keyed", "k")}),
slipped AS (
  SELECT CASE WHEN crc % 31 = 0 THEN left(run, (crc % length(run))::BIGINT) || substr(run, (crc % length(run))::BIGINT + 2) ELSE run END AS word, times FROM hashed
),
words AS (SELECT word, sum(times)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
-- words one edit apart are equal, or one is the other, after one code point of each is taken out
holes AS (
  SELECT word, n, i AS at, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.at = b.at AND a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.rest = w.word
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.rest = w.word
),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS top FROM near GROUP BY word),
first AS (SELECT b.word, b.n_near, b.top, min(near) AS form FROM best b JOIN near x ON x.word = b.word AND x.near_n = b.top GROUP BY ALL),
formed AS (
  SELECT w.word, w.n, coalesce(f.n_near, 0)::BIGINT AS n_near,
    CASE WHEN f.top >= 10 * w.n THEN f.form END AS form, CASE WHEN f.top >= 10 * w.n THEN f.top END AS form_n
  FROM words w LEFT JOIN first f USING (word)
),
chain AS (
  SELECT word, word AS reached, 0 AS steps FROM formed
  UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN formed f ON f.word = c.reached WHERE f.form IS NOT NULL
),
ends AS (SELECT word, arg_max(reached, steps) AS root FROM chain GROUP BY word)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e USING (word)"""


def _tree(name: str, leaves: str, storeys: int) -> list[str]:
    """Storeys of the trees over ``leaves`` (g, i, d): ``<name>_<k>`` has each
    node with ``many`` and the digests on both sides within its run of 8."""
    out, at = [], leaves
    for k in range(storeys):
        out.append(f"""{name}_{k} AS (
  SELECT g, i, d, count(*) OVER (PARTITION BY g) > 1 AS many,
    coalesce(string_agg(d, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(d, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {at}
)""")
        up = f"{name}_up{k}"
        out.append(f"""{up} AS (
  SELECT g, i // 8 AS i, CASE WHEN bool_or(many) THEN sha256(string_agg(d, '' ORDER BY i)) ELSE min(d) END AS d FROM {name}_{k} GROUP BY g, i // 8
)""")
        at = up
    out.append(f"{name}_top AS (SELECT * FROM {at})")
    return out


def _op13(storeys: int = 8, crown: int = 4) -> str:
    """Exact to 8 ** ``storeys`` rows a group and 8 ** ``crown`` groups."""

    def leaf(text: str) -> str:
        part = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')".format
        return "sha256(" + " || ".join([*map(part, ("doc_id", "source", "lang", "n_chars")), part(text)]) + ")"

    parts = [_CRC_TABLE, "ids AS (SELECT *, coalesce(doc_id::VARCHAR, '') AS k FROM documents)", f"hashed AS (SELECT * FROM {_crc('ids', 'k')})"]
    parts.append(f"""leaves AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS g, {leaf("text")} AS d, CASE WHEN crc % 3 = 0 THEN {leaf(_lower("text"))} ELSE {leaf("text")} END AS found FROM hashed
),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS i FROM leaves)""")
    parts += _tree("t", "placed", storeys)
    parts.append("tops AS (SELECT g AS name, '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, d FROM t_top)")
    parts += _tree("c", "tops", crown)
    joins = [f"JOIN t_{k} t{k} ON t{k}.g = p.g AND t{k}.i = p.i // {8**k}" for k in range(storeys)]
    joins.append("JOIN tops s ON s.name = p.g")
    joins += [f"JOIN c_{k} c{k} ON c{k}.i = s.i // {8**k}" for k in range(crown)]
    steps = [f"t{k}" for k in range(storeys)] + [f"c{k}" for k in range(crown)]
    sides = " || ".join(f"CASE WHEN {x}.many THEN {x}.l || {x}.r ELSE '' END" for x in steps)
    columns = ", ".join(f"{x}.many AS {x}m, {x}.l AS {x}l, {x}.r AS {x}r" for x in steps)
    parts.append(f"paths AS (SELECT p.doc_id, p.d AS leaf, s.d AS subroot, (SELECT d FROM c_top) AS root, sha256({sides}) AS proof_sha256, p.found AS f, {columns} FROM placed p {' '.join(joins)})")
    at = "paths"
    for x in steps:
        parts.append(f"fold_{x} AS (SELECT * REPLACE (CASE WHEN {x}m THEN sha256({x}l || f || {x}r) ELSE f END AS f) FROM {at})")
        at = f"fold_{x}"
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM {at}"


OP13_SQL = _op13()
