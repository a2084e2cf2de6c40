"""SQL of what several queries share: vectors, clusters, regions and quantities, for the oracles."""

from __future__ import annotations

from tessera.functions import text as X
from tessera.operators import stories
from tessera.plans import adapters as A

_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(X.STOPWORDS))) + "]"


def tokens(c: str) -> str:
    plain = f"regexp_replace(regexp_replace(lower({c}), '[‘’“”]', '''', 'g'), '[^a-z0-9$%.'' -]', ' ', 'g')"
    words = f"list_transform(string_split_regex({plain}, '[\\s''-]+'), lambda t: regexp_replace(t, '^[.$%]+|[.$%]+$', '', 'g'))"
    return f"list_filter({words}, lambda t: (length(t) >= 3 OR regexp_matches(t, '^[0-9]+$')) AND NOT list_contains({_STOP}, t))"


TITLE = "trim(regexp_replace({c}, '[\\s]+[-–—|·][\\s]+[^-–—|·]{{2,40}}$', ''), ' ' || chr(9) || chr(10) || chr(13))"
BOIL = X.BOILERPLATE.replace("\\z", "$").replace("'", "''")
DIGEST = f"(regexp_matches({TITLE.format(c='title')}, '{X.DIGEST_TITLE}'))"
def vecs(items: str = A.ITEMS_SQL) -> str:
    return f"""{items},
inc AS (SELECT * FROM it WHERE NOT regexp_matches({TITLE.format(c='title')}, '{BOIL}') AND NOT {DIGEST}),
tok AS (SELECT ord, unnest({tokens(TITLE.format(c='title'))}) AS term, 3 AS k FROM inc UNION ALL SELECT ord, unnest({tokens('excerpt')}) AS term, 1 AS k FROM inc),
tf AS (SELECT ord, term, sum(k) AS tf FROM tok GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
raw AS (SELECT ord, term, tf, df, (1 + ln(tf)) * (ln(((SELECT count(*) FROM inc) + 1) / (df + 1)) + 1) AS raw FROM tf JOIN df USING (term)),
vec AS (SELECT ord, term, tf, df, raw / sqrt(sum(raw * raw) OVER (PARTITION BY ord)) AS w FROM raw)"""


def pairs(items: str = A.ITEMS_SQL) -> str:
    """edges (i, j, sim) of the items, whose times are in minutes."""
    return f"""{vecs(items)},
b AS (SELECT vec.ord, term, outlet_id, minute AS t FROM vec JOIN (SELECT ord AS ord_, outlet_id, minute FROM inc) ON ord = ord_ WHERE df BETWEEN 2 AND 120),
p AS (SELECT DISTINCT x.ord AS i, y.ord AS j FROM b x JOIN b y ON x.term = y.term AND x.ord < y.ord AND x.outlet_id IS DISTINCT FROM y.outlet_id AND abs(y.t - x.t) <= 72 * 60),
s AS (SELECT i, j, sum(a.w * c.w) AS sim FROM p JOIN vec a ON a.ord = i JOIN vec c ON c.ord = j AND a.term = c.term GROUP BY i, j),
edges AS (SELECT i, j, sim FROM s WHERE sim >= 0.36)"""


def clusters(items: str = A.ITEMS_SQL) -> str:
    """members (cluster_id, ord, pruned) and clusters: everything within a component meets, and the loosest goes until it holds."""
    return f"""{pairs(items)},
ways AS (SELECT i AS v, j AS w FROM edges UNION ALL SELECT j, i FROM edges),
reach AS (SELECT DISTINCT v, v AS c FROM ways UNION SELECT ways.w AS v, reach.c FROM reach JOIN ways ON ways.v = reach.v),
comp AS (SELECT inc.ord, coalesce(min(c), inc.ord) AS cluster_id FROM inc LEFT JOIN reach ON reach.v = inc.ord GROUP BY inc.ord),
big AS (SELECT cluster_id FROM comp GROUP BY 1 HAVING count(*) > 2),
ps AS (SELECT a.ord AS i, c.ord AS j, sum(x.w * y.w) AS sim FROM comp a JOIN comp c USING (cluster_id) JOIN vec x ON x.ord = a.ord JOIN vec y ON y.ord = c.ord AND x.term = y.term
  WHERE a.ord <> c.ord AND cluster_id IN (SELECT cluster_id FROM big) GROUP BY ALL),
alive AS (
  SELECT cluster_id, ord, 0 AS step FROM comp WHERE cluster_id IN (SELECT cluster_id FROM big)
  UNION ALL
  SELECT cluster_id, ord, step + 1 FROM (
    SELECT cluster_id, ord, step, row_number() OVER (PARTITION BY cluster_id ORDER BY round(score, 9), ord) AS rn, sum(score) OVER (PARTITION BY cluster_id) AS total, count(*) OVER (PARTITION BY cluster_id) AS n
    FROM (SELECT a.cluster_id, a.ord, a.step, coalesce(sum(m.sim), 0) AS score FROM alive a LEFT JOIN (SELECT ps.i, ps.sim FROM alive z JOIN ps ON ps.j = z.ord) m ON m.i = a.ord GROUP BY ALL))
  WHERE n > 2 AND total / (n * (n - 1)) < 0.30 AND rn > 1),
members AS (
  SELECT cluster_id, ord, step AS pruned FROM (SELECT *, max(step) OVER (PARTITION BY cluster_id) AS last FROM alive) WHERE step = last
  UNION ALL SELECT cluster_id, ord, 0 FROM comp WHERE cluster_id NOT IN (SELECT cluster_id FROM big)),
own AS (SELECT members.cluster_id, members.pruned, inc.* FROM members JOIN inc USING (ord)),
inside AS (SELECT x.cluster_id, min(sim) AS lo, max(sim) AS hi, count(*) AS pairs FROM edges JOIN members x ON x.ord = i JOIN members y ON y.ord = j AND y.cluster_id = x.cluster_id GROUP BY 1),
cl AS (
  SELECT o.cluster_id, count(DISTINCT outlet_id)::INT AS outlet_count, count(*)::INT AS n_items, list(ord ORDER BY ord) AS ords, min(ord) AS min_ord, max(pruned)::INT AS pruned,
    string_agg(title || ' ' || excerpt, ' ' ORDER BY ord) AS story, list(title ORDER BY ord) AS titles,
    (SELECT list(country ORDER BY f) FROM (SELECT country, min(ord) AS f FROM own z WHERE z.cluster_id = o.cluster_id GROUP BY country)) AS countries,
    (SELECT list(lean ORDER BY f) FROM (SELECT lean, min(ord) AS f FROM own z WHERE z.cluster_id = o.cluster_id GROUP BY lean)) AS leans
  FROM own o GROUP BY o.cluster_id),
clusters AS (SELECT cl.*, lo, hi, coalesce(pairs, 0)::INT AS pairs FROM cl LEFT JOIN inside USING (cluster_id))"""


def terms(names: list[str], c: str) -> str:
    return " + ".join(f"(regexp_matches({c}, '(^|[^a-z]){t}([^a-z]|$)', 'i'))::INT" for t in names)


def region_score(region: str, text: str, published: str) -> str:
    return f"(3 * ({terms(stories.STRONG[region], text)}) + {terms(stories.WEAK[region], text)} + ({published})::INT)::INT"


def _published(region: str) -> str:
    return " OR ".join(f"list_contains(countries, '{c}')" for c in stories.PUBLISHERS[region])


def stories_of(items: str = A.ITEMS_SQL) -> str:
    """stories: clusters with the regions that they concern."""
    found = ", ".join(f"CASE WHEN {region_score(r, 'story', _published(r))} >= {stories.QUALIFIES} THEN '{r}' END" for r in stories.STRONG)
    return f"""{clusters(items)},
stories AS (SELECT *, list_filter([{found}, 'Global'], lambda x: x IS NOT NULL) AS regions FROM clusters)"""


def quota_steps(quotas: dict[str, int], stories: str = "stories") -> str:
    """ranked, taken<n> after each quota, filled: each quota takes the best of what earlier ones left, then the best of the rest fill up."""
    steps = [f"ranked AS (SELECT *, round(outlet_count * 10 + len(countries) * 2 + coalesce(hi, 0) * 5, 9) AS rank_score FROM {stories})", "taken0 AS (SELECT 0::BIGINT AS cluster_id, 0 AS slot, '' AS quota_region, 0 AS filled WHERE false)"]
    for n, (region, quota) in enumerate(quotas.items()):
        steps.append(f"""taken{n + 1} AS (SELECT cluster_id, slot, quota_region FROM taken{n} UNION ALL
  SELECT cluster_id, (SELECT count(*) FROM taken{n}) + row_number() OVER (ORDER BY rank_score DESC, min_ord) - 1, '{region}' FROM ranked
  WHERE list_contains(regions, '{region}') AND cluster_id NOT IN (SELECT cluster_id FROM taken{n}) QUALIFY row_number() OVER (ORDER BY rank_score DESC, min_ord) <= {quota})""")
    n = len(quotas)
    steps.append(f"""filled AS (SELECT cluster_id, slot, quota_region FROM taken{n} UNION ALL
  SELECT cluster_id, (SELECT count(*) FROM taken{n}) + row_number() OVER (ORDER BY rank_score DESC, min_ord) - 1, NULL FROM ranked WHERE cluster_id NOT IN (SELECT cluster_id FROM taken{n}))""")
    return ",\n".join(steps)


VECS, PAIRS, CLUSTERS, STORIES = vecs(), pairs(), clusters(), stories_of()

_NUMBER = "(?i)([$€£₹]|\\bUS\\$|\\bC\\$)?\\s?(\\d[\\d,]*(?:\\.\\d+)?)\\s*(percent|per cent|%|thousand|million|billion|trillion|bn|tn|k|m|b)?"


def quantities(source: str, keep: str) -> str:
    """quant (..., pos, raw, value, kind, currency, subject, in_range) of ``source`` (keep..., text): a match is the first occurrence of its string after the match before it."""
    none = "CAST([] AS STRUCT(s BIGINT, v VARCHAR)[])"
    at = "(a.at + instr(substr(joined, a.at + 1), x.v) - 1)"
    return f"""joined AS (SELECT {keep}, regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g') AS joined FROM {source}),
found AS (SELECT {keep}, joined, list_reduce(
    list_prepend({{'at': 0, 'found': {none}, 'v': ''}}, list_transform(regexp_extract_all(joined, '{_NUMBER}'), lambda v: {{'at': 0, 'found': {none}, 'v': v}})),
    lambda a, x: {{'at': {at} + length(x.v), 'found': list_append(a.found, {{'s': {at}, 'v': x.v}}), 'v': ''}}).found AS fs FROM joined WHERE length(joined) > 0),
placed AS (SELECT {keep}, joined, unnest(fs) AS f, generate_subscripts(fs, 1) AS pos FROM found),
parts AS (SELECT {keep}, pos, trim(f.v, ' ') AS raw, regexp_extract(f.v, '[$€£₹]|US\\$|C\\$') AS c, replace(regexp_extract(f.v, '\\d[\\d,]*(?:\\.\\d+)?'), ',', '')::DOUBLE AS v,
    lower(regexp_extract(f.v, '(?i)(percent|per cent|%|thousand|million|billion|trillion|bn|tn|k|m|b)$')) AS u,
    substr(joined, greatest(1, f.s - 59), least(f.s, 60)) AS before, substr(joined, f.s + length(f.v) + 1, 60) AS after FROM placed),
quant AS (SELECT {keep}, pos, raw, v * CASE WHEN u IN ('thousand', 'k') THEN 1e3 WHEN u IN ('million', 'm') THEN 1e6 WHEN u IN ('billion', 'bn', 'b') THEN 1e9 WHEN u IN ('trillion', 'tn') THEN 1e12 ELSE 1 END AS value,
    CASE WHEN u IN ('percent', 'per cent', '%') THEN 'percent' WHEN c <> '' THEN 'currency' ELSE 'count' END AS kind, nullif(c, '') AS currency,
    list_filter(list_slice(regexp_extract_all(lower(after || ' ' || before), '[a-z]{{4,}}'), 1, 6), lambda x, i: list_position(list_slice(regexp_extract_all(lower(after || ' ' || before), '[a-z]{{4,}}'), 1, 6), x) = i) AS subject,
    regexp_matches(before, '(?i)(?:between|from)\\s*$|[-–—]\\s*$|\\bto\\s*$') OR regexp_matches(after, '(?i)^\\s*(?:[-–—]|to\\b|and\\b)\\s*[$€£₹]?\\s*\\d') AS in_range
  FROM parts WHERE NOT (c = '' AND u = '' AND v < 1000))"""
