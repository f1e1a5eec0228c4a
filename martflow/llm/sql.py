"""DuckDB SQL of the subpackage's queries, where SQL can express them."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Poisson tables by recursion; a source's mean is far below 64 draws here only
# if sources are not tiny, so several draws are added up as the operator does.
ORACLE["op6_mixing"] = """
WITH RECURSIVE per AS (
    SELECT source, count(*)::DOUBLE AS size, power(count(*)::DOUBLE, 0.5) AS weight FROM documents GROUP BY source
), shares AS (
    SELECT source, size, (weight / (SELECT max(weight) FROM per))::DECIMAL(38,20) AS share FROM per
), rates AS (
    SELECT source, share::DOUBLE / (SELECT sum(share)::DOUBLE FROM shares) * (SELECT sum(size) FROM per) / size AS rate FROM shares
), means AS (
    SELECT source, greatest(1, ceil(rate / 64.0))::INT AS draws, rate / greatest(1, ceil(rate / 64.0)) AS mean FROM rates
), steps AS (
    SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS cdf FROM means
    UNION ALL
    SELECT source, mean, k + 1, p * (mean / (k + 1)), cdf + p * (mean / (k + 1)) FROM steps
    WHERE k < mean + 12 * sqrt(mean) + 30
), wanted AS (
    SELECT d.doc_id, d.source, d.text, m.draws, i.i,
           ('0x' || substr(md5('mix|' || coalesce(d.doc_id::VARCHAR, '') || '|' || i.i), 1, 13))::BIGINT / 4503599627370496.0 AS u
    FROM documents d JOIN means m ON d.source IS NOT DISTINCT FROM m.source,
         generate_series(1, m.draws) AS i(i)
), drawn AS (
    SELECT w.doc_id, w.source, w.text, count(s.k) AS n
    FROM wanted w LEFT JOIN steps s ON s.source IS NOT DISTINCT FROM w.source AND s.cdf <= w.u
    GROUP BY ALL
)
SELECT doc_id, source, text, r.r::INT AS replica, md5('mix/order|' || coalesce(doc_id::VARCHAR, '') || '|' || r.r) AS shuffle_key
FROM drawn, generate_series(1, n) AS r(r)
"""

# Hosts and paths as the contract has them; the pattern rules are written out.
ORACLE["op10_url_filter"] = r"""
WITH cut AS (
    SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
           CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), split AS (
    SELECT page_id, low,
           translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), sites(site, prefix, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), best AS (
    SELECT s.*, (SELECT max_by({'name': t.site || t.prefix, 'verdict': t.verdict}, length(t.site || t.prefix)) FROM sites t
                 WHERE (s.host = t.site OR ends_with(s.host, '.' || t.site)) AND starts_with(s.path, t.prefix)) AS b
    FROM split s
), words(n, name, verdict, pattern) AS (
    VALUES (4, 'spam-farm', 'block', '(^|[^a-z0-9])spam-farm([^a-z0-9]|$)'),
           (5, 'cheap-pills', 'block', '(^|[^a-z0-9])cheap-pills([^a-z0-9]|$)'),
           (6, 'casino', 'block', '(^|[^a-z0-9])casino([^a-z0-9]|$)'),
           (7, 'free*download', 'block', '(^|[^a-z0-9])free([^a-z0-9]|[^a-z0-9].*[^a-z0-9])download([^a-z0-9]|$)'),
           (8, 'adult', 'block', '(^|[^a-z0-9])adult([^a-z0-9]|$)'),
           (9, 'login', 'block', '(^|[^a-z0-9])login([^a-z0-9]|$)'),
           (10, 'cheap-pills*about', 'allow', '(^|[^a-z0-9])cheap-pills([^a-z0-9]|[^a-z0-9].*[^a-z0-9])about([^a-z0-9]|$)')
), judged AS (
    SELECT b.*, (SELECT min_by(name, n) FROM words w WHERE w.verdict = 'allow' AND regexp_matches(b.low, w.pattern, 's')) AS allows,
           (SELECT min_by(name, n) FROM words w WHERE w.verdict = 'block' AND regexp_matches(b.low, w.pattern, 's')) AS blocks
    FROM best b
)
SELECT page_id, host, path, b.name AS rule,
       coalesce(b.verdict, CASE WHEN allows IS NULL AND blocks IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN b IS NULL THEN coalesce(allows, blocks) END AS pattern_rule
FROM judged
"""


def _lloyd(rounds: int) -> str:
    """The rounds written out: assignment a1, codebook c1, assignment a2, ..."""
    assign = """a{n} AS MATERIALIZED (
    SELECT p.uid, p.pos, p.part, min(list_sum(list_transform(list_zip(p.part, c.part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 16 + c.entry) AS best
    FROM parts p JOIN c{m} c USING (pos) GROUP BY ALL
)"""
    update = """, c{n} AS MATERIALIZED (
    SELECT pos, entry, coalesce(m.part, c.part) AS part
    FROM c{m} c LEFT JOIN (
        SELECT pos, entry, list(mean ORDER BY i) AS part FROM (
            SELECT pos, best % 16 AS entry, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS mean
            FROM (SELECT pos, best, unnest(part) AS x, generate_subscripts(part, 1) AS i FROM a{n}) GROUP BY ALL
        ) GROUP BY ALL
    ) m USING (pos, entry)
)"""
    steps = [assign.format(n=n, m=n - 1) + (update.format(n=n, m=n - 1) if n <= rounds else "") for n in range(1, rounds + 2)]
    return ", ".join(steps)


ORACLE["op11_vector_codes"] = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) AS uid, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT uid, pos, v[pos * (len(v) // 8) + 1 : (pos + 1) * (len(v) // 8)] AS part FROM kept, range(8) AS r(pos)
), c0 AS (SELECT pos, uid - 1 AS entry, part FROM parts WHERE uid <= 16), {_lloyd(6)}, coded AS (
    SELECT uid, string_agg(printf('%02x', best % 16), '' ORDER BY pos) AS code, sum(best // 16)::BIGINT AS error FROM a7 GROUP BY uid
), books AS (
    SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM c6
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (uid), books
"""
