"""DuckDB SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

from growthloom.llm.sharding import LIMIT_BYTES

#: Each document once, with a row number (ids may be null or repeat).
_DOCS = "d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents)"

OP8 = rf"""
WITH {_DOCS},
lists AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
words AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM lists),
windows AS (
  SELECT rid, pos, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p AS g
  FROM words WINDOW p AS (PARTITION BY rid ORDER BY pos)),
twice AS (SELECT rid, pos FROM windows WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (SELECT rid, count(DISTINCT pos + o) AS n FROM twice, (VALUES (0), (1), (2)) AS t(o) GROUP BY rid),
rows_of AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM rows_of WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (
  SELECT d.rid, d.doc_id, d.source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN lists USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN covered USING (rid)),
failed AS (
  SELECT *, 2 * (n_words < 50)::INT AS short, 2 * (100 * n_repeat_words > 50 * n_words)::INT AS repetitive,
    (100 * n_symbols > 30 * n_words)::INT + (100 * n_symbols > 60 * n_words)::INT + (100 * n_symbols > 120 * n_words)::INT AS symbols,
    (word_chars < 3 * n_words OR word_chars > 12 * n_words)::INT + (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT
      + (2 * word_chars < 3 * n_words OR word_chars > 25 * n_words)::INT AS word_length,
    (100 * n_dup_lines > 3 * n_words)::INT + (100 * n_dup_lines > 5 * n_words)::INT + (100 * n_dup_lines > 10 * n_words)::INT AS dup_lines FROM m),
long_form AS (UNPIVOT failed ON short, repetitive, symbols, word_length, dup_lines INTO NAME rule VALUE grade),
host AS (SELECT source, rule, count(*)::DOUBLE AS n, count(*) FILTER (WHERE grade > 0)::DOUBLE AS f FROM long_form GROUP BY ALL),
prior AS (
  SELECT rule, count(*) AS hosts, sum(f) / sum(n) AS mean,
    (sum(f * f / n) - sum(f) * (sum(f) / sum(n)) - (count(*) - 1) * (sum(f) / sum(n)) * (1 - sum(f) / sum(n)))
      / nullif(sum(n) - sum(n * n) / sum(n), 0) AS between_hosts
  FROM host GROUP BY rule),
strength AS (
  SELECT rule, mean, CASE WHEN hosts < 2 OR mean <= 0 OR mean >= 1 THEN 1.0
    WHEN between_hosts <= mean * (1 - mean) / 1e6 THEN 1e6
    ELSE greatest(1.0, mean * (1 - mean) / between_hosts - 1) END AS s FROM prior),
rate AS (SELECT source, rule, mean, (f + s * mean) / (n + s) AS p FROM host JOIN strength USING (rule)),
judged AS (
  SELECT l.rid, bool_or(grade > 0 AND rule IN ('short', 'repetitive')) AS base_failed, max(p) >= 0.9 AS host_bad,
    bool_or(grade >= CASE WHEN p >= 2.0::DOUBLE * mean THEN 1 WHEN p <= 0.5::DOUBLE * mean THEN 3 ELSE 2 END AND rule NOT IN ('short', 'repetitive')) AS own
  FROM long_form AS l JOIN rate AS r USING (rule) WHERE l.source IS NOT DISTINCT FROM r.source GROUP BY l.rid)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT host_bad AND NOT own AS kept
FROM m JOIN judged USING (rid)
"""


def _op3() -> str:
    """Counts of runs of 1 to 5 characters, then one probability table per length from the one before."""
    sql = r"""
WITH parts AS (
  SELECT row_number() OVER () AS rid, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM parts),
said AS (
  SELECT *, CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS verdict,
    ('0x' || substr(md5(host || path), 1, 4))::INT % 5 = 0 AS held FROM ruled),
runs AS (
  SELECT rid, verdict, held, length(host || path) + 1 AS n, unnest(list_transform(range(1, length(host || path) + 2),
    lambda i: substr(repeat(chr(2), 4) || host || path || chr(3), i, 5))) AS run FROM said),
g AS (
  SELECT run, count(*) FILTER (WHERE verdict = 'allow' AND NOT held) AS a, count(*) FILTER (WHERE verdict = 'block' AND NOT held) AS b
  FROM runs GROUP BY run)"""
    for k in range(5):
        before = "(1.0::DOUBLE / 256)" if k == 0 else "below.{0}"
        join = "" if k == 0 else f" JOIN p{k - 1} AS below ON below.g = substr(c.g, 2)"
        sql += f""",
c{k} AS (SELECT right(run, {k + 1}) AS g, sum(a) AS a, sum(b) AS b FROM g GROUP BY 1),
x{k} AS (SELECT left(g, {k}) AS ctx, sum(a) AS na, sum(b) AS nb, count(*) FILTER (WHERE a > 0) AS ta, count(*) FILTER (WHERE b > 0) AS tb FROM c{k} GROUP BY 1),
p{k} AS (
  SELECT c.g, CASE WHEN na > 0 THEN (a + ta * {before.format('pa')}) / (na + ta) ELSE {before.format('pa')} END AS pa,
    CASE WHEN nb > 0 THEN (b + tb * {before.format('pb')}) / (nb + tb) ELSE {before.format('pb')} END AS pb
  FROM c{k} AS c JOIN x{k} AS x ON x.ctx = left(c.g, {k}){join})"""
    return sql + """,
score AS (SELECT rid, any_value(verdict) AS verdict, any_value(held) AS held, sum(ln(pa) - ln(pb)) / any_value(n) AS s FROM runs JOIN p4 ON p4.g = run GROUP BY rid),
m AS (SELECT verdict, avg(s) AS mean, sqrt(greatest(avg(s * s) - avg(s) * avg(s), 0)) + 1e-9 AS spread FROM score WHERE held AND verdict IS NOT NULL GROUP BY verdict),
bound AS (
  SELECT (l.mean * r.spread + r.mean * l.spread) / (l.spread + r.spread) AS v FROM (SELECT * FROM m WHERE verdict = 'allow') AS l, (SELECT * FROM m WHERE verdict = 'block') AS r
  WHERE (SELECT count(DISTINCT verdict) FROM said WHERE NOT held) = 2)
SELECT page_id, host, path, rule, coalesce(said.verdict, CASE WHEN coalesce(s >= (SELECT v FROM bound), true) THEN 'allow' ELSE 'block' END) AS verdict
FROM said JOIN score USING (rid)
"""


def _op4() -> str:
    kinds = [
        ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 20),
        ("hex", r"[0-9a-f]+", 0, 24),
        ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
        ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
        ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
        ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 1),
        ("jwt", r"eyJ[A-Za-z0-9_-]{8,1000}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ]
    parts = [
        f"""SELECT rid, {o} AS o, '{kind}' AS kind, {least} AS least, regexp_extract_all(text, '{pattern}') AS found,
      regexp_extract_all(text, '{pattern}', {group}) AS grouped, string_split_regex(text, '{pattern}') AS pieces FROM d"""
        for o, (kind, pattern, group, least) in enumerate(kinds)
    ]
    return f"""
WITH {_DOCS},
lists AS ({' UNION ALL '.join(parts)}),
flat AS (
  SELECT rid, o, kind, least, generate_subscripts(found, 1) AS n, length(unnest(found)) AS f, length(unnest(grouped)) AS g,
    length(unnest(pieces[:len(found)])) AS p FROM lists WHERE len(found) > 0),
ends AS (SELECT *, sum(p + f) OVER (PARTITION BY rid, o ORDER BY n) AS e FROM flat),
spans AS (SELECT rid, o, kind, (e - f)::BIGINT AS s, kind || ':' || (e - f)::BIGINT || ':' || e::BIGINT AS t FROM ends WHERE g >= least),
per_doc AS (
  SELECT rid, count(*) FILTER (WHERE o = 0) AS n_assign, count(*) FILTER (WHERE o = 1) AS n_access, count(*) FILTER (WHERE o = 2) AS n_hex,
    string_agg(t, ',' ORDER BY s, o) FILTER (WHERE o < 3) AS base, string_agg(t, ',' ORDER BY s, o) AS spans FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per_doc USING (rid)
"""


def op6(limit: int) -> str:
    """Bytes under every prefix of every length at once; a document's bucket is the shortest that fits."""
    return f"""
WITH {_DOCS},
h AS (
  SELECT rid, doc_id, strlen(text) AS bytes, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(text)), 1, 15))::BIGINT AS h FROM d),
sums AS (
  SELECT depth, h >> (60 - depth) AS q, sum(bytes)::BIGINT AS shard_bytes, count(*)::BIGINT AS shard_docs
  FROM h, range(0, 61) AS t(depth) GROUP BY ALL HAVING sum(bytes) <= {limit} OR count(*) = 1),
leaf AS (
  SELECT rid, min(depth) AS depth, arg_min(shard_bytes, depth) AS shard_bytes, arg_min(shard_docs, depth) AS shard_docs
  FROM h JOIN sums ON q = h >> (60 - depth) GROUP BY rid),
alike AS (
  SELECT rid, doc_id, bytes, h, greatest(1, {limit} // bytes) AS room, row_number() OVER (PARTITION BY h ORDER BY rid) - 1 AS n, count(*) OVER (PARTITION BY h) AS every
  FROM h WHERE rid NOT IN (SELECT rid FROM leaf))
SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(h >> (60 - depth)), depth::INT, '0') END AS shard, depth::INT AS depth, shard_bytes, shard_docs
FROM h JOIN leaf USING (rid)
UNION ALL
SELECT doc_id, lpad(bin(h), 60, '0') || '+' || (n // room + 1), 60, least(room, every - (n // room) * room) * bytes, least(room, every - (n // room) * room) FROM alike
"""


OP7 = rf"""
WITH RECURSIVE {_DOCS},
lists AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
sh AS (
  SELECT DISTINCT rid, unnest(list_transform(range(1, greatest(len(ws) - 3, 2)), lambda i: array_to_string(ws[i:i + 4], ' '))) AS g
  FROM lists WHERE len(ws) > 0),
sizes AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
common AS (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM sh AS x JOIN sh AS y ON x.g = y.g AND x.rid < y.rid GROUP BY ALL),
linked AS (
  SELECT a, b FROM common JOIN sizes AS x ON x.rid = a JOIN sizes AS y ON y.rid = b WHERE c >= 0.8::DOUBLE * (x.n + y.n - c)),
edges AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, e.b FROM reach AS r JOIN edges AS e ON r.b = e.a)
SELECT x.doc_id, min(y.doc_id) AS class_id, count(*) AS n_copies
FROM reach JOIN d AS x ON x.rid = a JOIN d AS y ON y.rid = b GROUP BY a, x.doc_id
"""


def _op12(levels: int = 12) -> str:
    """One level of the trees after another, each with the siblings before and after a node."""
    fields = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END" for c in ("doc_id", "source", "lang", "n_chars")]
    text = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}) || ':' || {0} END"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # The remainder of the id's digits, bit by bit.
    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, range(0, 8 * length(name))), lambda c, i:
      xor((CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(name, (i // 8 + 1)::INT, 1))::BIGINT) ELSE c END) >> 1,
        3988292384 * ((CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(name, (i // 8 + 1)::INT, 1))::BIGINT) ELSE c END) & 1))))"""
    sql = f"""
WITH l AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(doc_id::VARCHAR, '') AS name,
    sha256({' || '.join([*fields, text.format('text')])}) AS leaf, sha256({' || '.join([*fields, text.format(low)])}) AS lowered FROM documents),
marked AS (SELECT *, {crc} % 3 = 0 AS tampered FROM l),
n0 AS (
  SELECT coalesce('=' || lang, '') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos, leaf AS h FROM marked),
w0 AS (
  SELECT rid, coalesce('=' || lang, '') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos,
    doc_id, leaf, '' AS proof, CASE WHEN tampered THEN lowered ELSE leaf END AS f FROM marked)"""

    def level(k: int, nodes: str, walk: str) -> str:
        """Nodes and walks one level up, within ``tree``."""
        return f""",
c{k} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS total FROM {nodes}),
s{k} AS (
  SELECT *, coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
    coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM c{k} WINDOW run AS (PARTITION BY tree, pos // 8 ORDER BY pos)),
n{k + 1} AS (
  SELECT tree, pos // 8 AS pos, CASE WHEN any_value(total) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM c{k} GROUP BY 1, pos // 8),
w{k + 1} AS (
  SELECT rid, w.tree, w.pos // 8 AS pos, doc_id, leaf, proof || CASE WHEN total = 1 THEN '' ELSE b || a END AS proof,
    CASE WHEN total = 1 THEN f ELSE sha256(b || f || a) END AS f
  FROM {walk} AS w JOIN s{k} AS s ON w.tree = s.tree AND w.pos = s.pos)"""

    for k in range(levels):
        sql += level(k, f"n{k}", f"w{k}")
    top = levels + 1
    sql += f""",
subroots AS (SELECT tree AS name, row_number() OVER (ORDER BY tree) - 1 AS place, h AS subroot FROM n{levels}),
n{top} AS (SELECT '' AS tree, place AS pos, subroot AS h FROM subroots),
w{top} AS (SELECT rid, '' AS tree, place AS pos, doc_id, leaf, proof, f FROM w{levels} JOIN subroots ON tree = name)"""
    for k in range(top, top + levels):
        sql += level(k, f"n{k}", f"w{k}")
    return sql + f"""
SELECT w.doc_id, w.leaf, subroot, r.h AS root, sha256(w.proof) AS proof_sha256, w.f AS folded_root, w.f = r.h AS verified
FROM w{top + levels} AS w JOIN n{top + levels} AS r ON w.tree = r.tree JOIN w{levels} AS o ON w.rid = o.rid JOIN subroots ON o.tree = name
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_markov": _op3(),
        "op4_secret_ledger": _op4(),
        "op6_extendible_shards": op6(LIMIT_BYTES),
        "op7_prob_minhash": OP7,
        "op8_host_rules": OP8,
        "op12_merkle_witnesses": _op12(),
    }
