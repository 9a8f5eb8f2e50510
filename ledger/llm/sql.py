"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from ledger.llm.common import HASH_BITS
from ledger.llm.mixing import CAP, SHARE, WEIGHTS
from ledger.llm.sharding import MAX_BYTES
from ledger.llm.url_filter import DAMPING, PARENT_WEIGHT, ROUNDS, RULES

_HASH = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"

MIX = f"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS place,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
    {_HASH.format("coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || coalesce(text, '')")} AS h
  FROM documents),
totals AS (SELECT place, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY place),
weighed AS (
  SELECT *, CAST([{", ".join(map(str, WEIGHTS))}][CAST((row_number() OVER (ORDER BY place) - 1) % {len(WEIGHTS)} + 1 AS INT)] AS DOUBLE) AS weight,
    source_size * CAST({CAP} AS DOUBLE) AS ceiling FROM totals),
-- Let L(k) be the level if the sources before k in order of ceiling per weight stop at their ceilings; the first k above L(k) sets it.
levels AS (
  SELECT *, ceiling / weight AS fill,
    (sum(source_size) OVER () * CAST({SHARE} AS DOUBLE)
      - coalesce(sum(ceiling) OVER (ORDER BY ceiling / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY ceiling / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
goals AS (
  SELECT place, source_size,
    coalesce(least(weight * max(CASE WHEN fill > level THEN level END) OVER (), ceiling), ceiling) AS target FROM levels),
rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM goals),
running AS (
  SELECT s.*, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size AS rest,
    sum(size) OVER (PARTITION BY place ORDER BY h) AS through, sum(size) OVER (PARTITION BY place, h) AS alike
  FROM sized s JOIN rests r USING (place))
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN through - alike + alike / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM running
"""

SHARDS = f"""
WITH docs AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
    {_HASH.format("coalesce(CAST(doc_id AS VARCHAR), 't' || text, '')")} AS h
  FROM documents),
nodes AS (
  SELECT depth, h >> ({HASH_BITS} - depth) AS node, sum(n_bytes) AS bytes, count(*) AS docs, min(h) AS low, max(h) AS high
  FROM docs, (SELECT unnest(range(0, {HASH_BITS + 1})) AS depth) GROUP BY ALL),
fitting AS (SELECT * FROM nodes WHERE bytes <= {MAX_BYTES} OR low = high),
placed AS (
  SELECT d.*, f.depth, f.node, f.bytes, f.docs, min(f.depth) OVER (PARTITION BY d.h) AS first_depth
  FROM docs d JOIN fitting f ON f.node = d.h >> ({HASH_BITS} - f.depth))
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(node), CAST(depth AS INT), '0') END AS shard,
  CAST(depth AS INT) AS depth, CAST(bytes AS BIGINT) AS shard_bytes, docs AS shard_docs, bytes > {MAX_BYTES} AS oversize
FROM placed WHERE depth = first_depth
"""


def urls() -> str:
    """The rules and the rounds of both walks, written out one after another."""
    quoted = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [f"((host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '{p}'))" for _, h, p in quoted]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, quoted, strict=True))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, quoted, strict=True))
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    link = r"""(?i)\bhref\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"''\s>]+)"""
    rounds = "".join(f"""
w{i + 1} AS MATERIALIZED (
  SELECT kind, host, sum(score) AS score FROM (
    SELECT s.kind, s.dst AS host, w.score * s.share AS score FROM steps s JOIN w{i} w ON w.kind = s.kind AND w.host = s.src
    UNION ALL SELECT kind, host, score FROM w0) GROUP BY ALL),""" for i in range(ROUNDS))
    return f"""
WITH rests AS (
  SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests),
parsed AS (
  SELECT page_id, html, {lower.format("raw")} AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
judged AS (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS ruled FROM parsed),
links AS (
  SELECT src, dst, count(*) AS weight FROM (
    SELECT host AS src, {lower.format("unnest(regexp_extract_all(html, '" + link + "', 1))")} AS dst FROM judged)
  WHERE src <> '' AND src <> dst GROUP BY ALL),
names AS (SELECT DISTINCT host FROM (SELECT host FROM judged UNION ALL SELECT dst FROM links) WHERE host <> ''),
labels AS (SELECT string_split(host, '.') AS parts FROM names WHERE len(string_split(host, '.')) > 2),
chain AS (
  SELECT DISTINCT array_to_string(parts[i + 1:], '.') AS lower_name, array_to_string(parts[i + 2:], '.') AS upper_name
  FROM (SELECT parts, unnest(range(0, len(parts) - 2)) AS i FROM labels)),
edges AS (
  SELECT src, dst, sum(weight) AS weight FROM (
    SELECT src, dst, CAST(weight AS DOUBLE) AS weight FROM links
    UNION ALL SELECT lower_name, upper_name, CAST({PARENT_WEIGHT} AS DOUBLE) FROM chain
    UNION ALL SELECT upper_name, lower_name, CAST({PARENT_WEIGHT} AS DOUBLE) FROM chain) GROUP BY ALL),
both_ways AS (SELECT 'trust' AS kind, * FROM edges UNION ALL SELECT 'distrust', dst, src, weight FROM edges),
steps AS MATERIALIZED (
  SELECT kind, src, dst, weight / sum(weight) OVER (PARTITION BY kind, src) * {DAMPING} AS share FROM both_ways),
seeds AS (
  SELECT CASE ruled WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n FROM judged WHERE ruled IS NOT NULL GROUP BY ALL),
w0 AS MATERIALIZED (SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) * (1 - CAST({DAMPING} AS DOUBLE)) AS score FROM seeds),{rounds}
blocked AS (
  SELECT host FROM w{ROUNDS} GROUP BY host
  HAVING coalesce(sum(score) FILTER (kind = 'distrust'), 0) > coalesce(sum(score) FILTER (kind = 'trust'), 0))
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM (SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, ruled FROM judged)
"""
