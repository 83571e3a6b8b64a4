"""DuckDB SQL for the queries whose SQL is long."""

from __future__ import annotations

from emberline.llm import merkle, source_mix

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)"


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text."""
    return (f"xor(list_reduce([CAST(ascii(({text})[i]) AS BIGINT) for i in range(1, 1 + length({text}))], lambda c, b: "
            "list_reduce(range(8), lambda d, _: xor(d >> 1, CASE WHEN d % 2 = 1 THEN 3988292384 ELSE 0 END), xor(c, b)), "
            "CAST(4294967295 AS BIGINT)), 4294967295)")


def mix_sql() -> str:
    """Prefixes of each source in the order of the hash, by running sums."""
    steps, taken = [], []
    for k in range(1 + source_mix.FILLS):
        others = "".join(f" AND row NOT IN (SELECT row FROM taken{i})" for i in range(k))
        steps.append(f"""upto{k} AS (
 SELECT row, id, size, gap, sum(size) OVER (PARTITION BY id ORDER BY h, row) AS upto
 FROM numbered JOIN gaps{k} USING (id) WHERE size BETWEEN 1 AND gap{others}
), taken{k} AS (
 SELECT row, id, size FROM upto{k} WHERE upto <= gap
), gaps{k + 1} AS (
 SELECT id, gap - coalesce((SELECT sum(size) FROM taken{k} t WHERE t.id = g.id), 0) AS gap FROM gaps{k} g
)""")
        taken.append(f"SELECT row FROM taken{k}")
    every = " UNION ALL ".join(taken)
    return rf"""
WITH sized AS (
 SELECT doc_id, source, {_WORDS} AS size,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '-')), 1, 15) AS BIGINT) AS h
 FROM documents
), sources AS (
 SELECT source, sum(size) AS n, row_number() OVER (ORDER BY source NULLS LAST) AS id FROM sized GROUP BY source
), weighed AS (
 SELECT *, CASE id % 3 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 2 END AS w FROM sources
), budget AS (
 SELECT {source_mix.SHARE} * CAST(sum(n) AS DOUBLE) AS words FROM weighed
), by_ratio AS (
 SELECT *, coalesce(sum(2 * n) OVER (ORDER BY 2 * n / w, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
  sum(w) OVER (ORDER BY 2 * n / w, id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
 FROM weighed
), level AS (
 SELECT words - capped AS rest, open FROM by_ratio, budget WHERE (words - capped) * w / open <= 2 * n ORDER BY 2 * n / w, id LIMIT 1
), targets AS (
 SELECT id, source, n, CASE WHEN rest * w / open > 2 * n THEN CAST(2 * n AS DOUBLE) ELSE rest * w / open END AS target FROM weighed, level
), goals AS (
 SELECT *, CASE WHEN n = 0 THEN 0 ELSE least(CAST(floor(target / n) AS BIGINT), 2) END AS copies FROM targets
), numbered AS (
 SELECT sized.*, id, row_number() OVER () AS row FROM sized JOIN sources ON sized.source IS NOT DISTINCT FROM sources.source
), gaps0 AS (
 SELECT id, CASE WHEN copies < 2 THEN CAST(floor(target - copies * n) AS BIGINT) ELSE 0 END AS gap FROM goals
), {", ".join(steps)}, taken AS (
 {every}
), last AS (
 SELECT arg_min(row, (abs(size - gap), size, h, row)) AS row FROM numbered JOIN gaps{1 + source_mix.FILLS} USING (id)
 WHERE size > 0 AND size < 2 * gap AND row NOT IN (FROM taken) GROUP BY id
), mixed AS (
 SELECT doc_id, size, CAST(n AS BIGINT) AS source_size, target,
  CAST(CASE WHEN size = 0 THEN 0 ELSE copies + (row IN (FROM taken) OR row IN (SELECT row FROM last))::INT END AS BIGINT) AS copies
 FROM numbered JOIN goals USING (id)
)
SELECT *, size * copies AS taken FROM mixed"""


def trie_sql() -> str:
    """Every conversation joined with all its prefixes, and every node with those above it."""
    return rf"""
WITH turns AS (
 SELECT conv_id AS c, {_WORDS} AS words, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, turn
 FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
 SELECT c, words, digest, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest) AS pos FROM turns
), ids AS (
 SELECT DISTINCT c, CAST(c AS VARCHAR) AS text FROM turns
), convs AS (
 SELECT c, {_crc32("text")} % 4 AS h, c - c % 20 AS base FROM ids
), lent AS (
 SELECT convs.c, pos AS d, words, digest FROM convs JOIN placed ON placed.c = base AND pos <= h
), loans AS (
 SELECT c, count(*) AS n FROM lent GROUP BY c
), rebuilt AS (
 FROM lent UNION ALL
 SELECT c, pos - h + coalesce(n, 0) AS d, words, digest FROM placed JOIN convs USING (c) LEFT JOIN loans USING (c) WHERE pos > h
), keyed AS (
 SELECT c, d, words, sha256(string_agg(digest, ',') OVER (PARTITION BY c ORDER BY d)) AS key FROM rebuilt
 UNION ALL SELECT c, 0, 0, '' FROM convs
), prefixes AS (
 SELECT *, lag(key) OVER (PARTITION BY c ORDER BY d) AS above, max(d) OVER (PARTITION BY c) AS length FROM keyed
), nodes AS (
 SELECT d, key, any_value(above) AS above, min(c) AS first, count(*) AS n, any_value(words) * (count(*) - 1) AS saved,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (length = d), '')) AS ends
 FROM prefixes GROUP BY d, key
), children AS (
 SELECT d - 1 AS d, above AS key, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), below AS (
 SELECT p.d, p.key, sum(x.saved) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
 FROM nodes x LEFT JOIN children USING (d, key) JOIN prefixes p ON p.c = x.first AND p.d <= x.d GROUP BY p.d, p.key
)
SELECT x.first AS conv_id, CAST(x.d AS BIGINT) AS depth, up.first AS parent_conv_id, x.n AS n_convs, coalesce(n_children, 0) AS n_children,
 n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, x.ends AS ends_sha256
FROM nodes x JOIN below USING (d, key) LEFT JOIN children USING (d, key) LEFT JOIN nodes up ON up.d = x.d - 1 AND up.key = x.above"""


def merkle_sql(levels: int = 7, upper_levels: int = 3) -> str:
    """Level after level, for langs of ``FANOUT ** levels`` rows and as many langs as ``upper_levels`` say."""
    def tree(name: str, n: int) -> list[str]:
        parts = []
        for k in range(n):
            parts.append(f"""{name}_runs{k} AS (
 SELECT tree, pos // {merkle.FANOUT} AS pos, list(h ORDER BY pos) AS hs, any_value(n) AS n FROM {name}{k} GROUP BY tree, pos // {merkle.FANOUT}
), {name}{k + 1} AS (
 SELECT tree, pos, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h, (n + {merkle.FANOUT - 1}) // {merkle.FANOUT} AS n FROM {name}_runs{k}
)""")
        return parts

    def way(name: str, n: int, frm: str, to: str) -> list[str]:
        """Each row's siblings, level by level, and what its leaf folds to."""
        parts, last = [], frm
        for k in range(n):
            now = f"{to}{k}"
            parts.append(f"""{now}_ AS (
 SELECT w.* EXCLUDE (pos), w.pos // {merkle.FANOUT} AS pos, r.n AS n, array_to_string(hs[1:place], '') AS l, array_to_string(hs[place + 2:], '') AS r
 FROM (SELECT *, pos % {merkle.FANOUT} AS place FROM {last}) w JOIN {name}_runs{k} r ON r.tree = w.tree AND r.pos = w.pos // {merkle.FANOUT}
), {now} AS (
 SELECT * EXCLUDE (proof, folded, n, l, r, place), CASE WHEN n > 1 THEN proof || l || r ELSE proof END AS proof,
  CASE WHEN n > 1 THEN sha256(l || folded || r) ELSE folded END AS folded
 FROM {now}_
)""")
            last = now
        return parts

    def text(column: str) -> str:
        return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"

    head = " || ".join(map(text, ("doc_id", "source", "lang", "n_chars")))
    parts = [f"""hashed AS (
 SELECT doc_id, lang, sha256({head} || {text("text")}) AS leaf, sha256({head} || {text("lowered")}) AS forged,
  {_crc32("id")} % 3 = 0 AS tampered
 FROM (SELECT *, CAST(doc_id AS VARCHAR) AS id, translate(text, '{_UPPER}', '{_LOWER}') AS lowered FROM documents)
), langs AS (
 SELECT lang, count(*) AS size, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM hashed GROUP BY lang
), placed AS (
 SELECT hashed.*, tree, size, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
 FROM hashed JOIN langs ON hashed.lang IS NOT DISTINCT FROM langs.lang
), low0 AS (
 SELECT tree, pos, leaf AS h, size AS n FROM placed
)""", *tree("low", levels), f"""top0 AS (
 SELECT 0 AS tree, tree AS pos, h, (SELECT count(*) FROM langs) AS n FROM low{levels}
)""", *tree("top", upper_levels), """start AS (
 SELECT doc_id, leaf, tree, pos, '' AS proof, CASE WHEN tampered THEN forged ELSE leaf END AS folded FROM placed
)""", *way("low", levels, "start", "way"), f"""half AS (
 SELECT w.doc_id, w.leaf, w.proof, w.folded, s.h AS subroot, 0 AS tree, w.tree AS pos FROM way{levels - 1} w JOIN low{levels} s ON s.tree = w.tree
)""", *way("top", upper_levels, "half", "up")]
    return f"""WITH {", ".join(parts)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
FROM up{upper_levels - 1} JOIN (SELECT h FROM top{upper_levels}) ON true"""
