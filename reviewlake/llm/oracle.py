"""DuckDB twins of the queries that SQL can express.

Digests of tokens, sketches, SimHash groups, trained scores, random walks, role repair and page trees have
no SQL form; ``tests/llm`` holds those queries against brute force, round trips or held-out rows.
"""

from __future__ import annotations

from reviewlake.llm.queries import URL_RULES

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

ORACLE: dict[str, str] = {
    "op11_collocations": r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
ws AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM ws GROUP BY lang),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM ws, (VALUES (1), (2), (3), (4)) t(k)) GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cuts AS (SELECT lang, phrase, a, w, unnest(range(1, k)) AS i FROM c),
scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, x.f AS l, y.f AS r, i, ((2000000::HUGEINT * cuts.a) // (x.f + y.f))::BIGINT AS score
      FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.w[:i], ' ')
      JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.w[i + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
inner_of AS (SELECT lang, a, array_to_string(w[i:i + n - 1], ' ') AS phrase
      FROM (SELECT lang, a, w, k, n, unnest(range(1, k - n + 2)) AS i FROM c, (VALUES (2), (3)) t(n) WHERE n < k)),
cover AS (SELECT lang, phrase, max(a) AS longer FROM inner_of GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN cover USING (lang, phrase) WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * best.a::HUGEINT),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
    "op3_url_rules": f"""
WITH rules(rh, rp, v) AS (VALUES {_RULES}),
rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
hp AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
              regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fit AS (SELECT page_id, rh || rp AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC, length(rh) DESC, v DESC) AS rn
        FROM hp JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT hp.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM hp LEFT JOIN fit ON hp.page_id = fit.page_id AND rn = 1""",
}
