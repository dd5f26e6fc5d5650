"""The same results in SQL, where SQL can say them on whole tables."""

_SOURCE = r"nullif(lower(regexp_replace(regexp_replace(source, '^.*[/\\]', '', 's'), '^[ \t]+|[ \t]+$', '', 'g')), '')"
_OF = _SOURCE.replace("source", "edition_of")

_PAIRS = """
pairs AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY written_at DESC) AS nth FROM synthetic_dataset) WHERE nth = 1
)"""

_GROUPS = f"""
named AS (
  SELECT DISTINCT {_SOURCE} AS s, {_OF} AS o,
    CASE WHEN lower(trim(regexp_replace(author, '\\s+', ' ', 'g'))) NOT IN ('', '-', 'unknown', 'n/a', 'anonymous', 'not given')
      THEN lower(trim(regexp_replace(author, '\\s+', ' ', 'g'))) END AS who
  FROM source_files
),
links AS (
  SELECT a.s AS x, b.s AS y FROM named a JOIN named b ON a.who = b.who
  UNION SELECT a.s, b.s FROM named a JOIN named b ON a.o = b.s
  UNION SELECT b.s, a.s FROM named a JOIN named b ON a.o = b.s
),
reached AS (
  SELECT DISTINCT s AS x, s AS y FROM named WHERE s IS NOT NULL
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
),
groups AS (SELECT x AS source, min(y) AS group_source, count(*) AS members FROM reached GROUP BY x)"""

_WORDS = r"regexp_extract_all(lower(coalesce({}, '')), '[\p{{L}}\p{{N}}]+')"
_WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

_NEAR = f"""WITH {_PAIRS},
sets AS (
  SELECT pair_id, list_distinct({_WORDS.format("coalesce(question, '') || ' ' || coalesce(answer, '')")}) AS w,
    list_sort(list_distinct(list_transform(regexp_extract_all(coalesce(answer, ''), '[0-9]+(?:[.,][0-9]+)*'), lambda x: replace(x, ',', '')))) AS n
  FROM pairs
),
long AS (SELECT pair_id, len(w) AS size, unnest(w) AS word FROM sets),
often AS (SELECT word, count(*) AS df FROM long GROUP BY word),
ranked AS (SELECT pair_id, size, word, row_number() OVER (PARTITION BY pair_id ORDER BY df, word) AS nth FROM long JOIN often USING (word)),
rare AS (SELECT pair_id, word FROM ranked WHERE nth <= size - (4 * size + 4) // 5 + 1),
near AS (SELECT DISTINCT a.pair_id AS a, b.pair_id AS b FROM rare a JOIN rare b USING (word) WHERE a.pair_id < b.pair_id),
pairwise AS (SELECT a, b, x.n AS xn, y.n AS yn, len(x.w) + len(y.w) AS total, len(list_intersect(x.w, y.w)) AS shared FROM near JOIN sets x ON x.pair_id = a JOIN sets y ON y.pair_id = b)"""
_SIMILAR = "5 * shared >= 4 * (total - shared) AND NOT (len(xn) > 0 AND len(yn) > 0 AND xn <> yn)"
_RUNS = f"""WITH fields AS (
  SELECT item_id, 'question' AS field, {_WORDS.format("question")} AS w FROM eval_items
  UNION ALL SELECT item_id, 'answer', {_WORDS.format("answer")} FROM eval_items
  UNION ALL SELECT item_id, 'passage', {_WORDS.format("passage")} FROM eval_items
),
theirs AS (SELECT item_id, field, j, array_to_string(w[j : j + 7], ' ') AS g FROM (SELECT item_id, field, w, unnest(range(1, len(w) - 6)) AS j FROM fields)),
docs AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
ours AS (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM docs)),
hits AS (SELECT doc_id, i, item_id, field, j FROM ours JOIN theirs USING (g))"""

_SPLIT = f"""{_GROUPS},
records AS (SELECT pair_id, min({_SOURCE}) AS source FROM synthetic_dataset GROUP BY pair_id),
linked AS (SELECT pair_id, coalesce(group_source, source) AS group_source FROM records LEFT JOIN groups USING (source)),
summed AS (SELECT split_name, target_pct, sum(target_pct) OVER (ORDER BY split_name) AS upto, sum(target_pct) OVER () AS whole FROM split_targets),
ranges AS (SELECT split_name, target_pct, whole, floor((upto - target_pct) * 10000 / whole) AS low, floor(upto * 10000 / whole) AS high FROM summed),
sizes AS (SELECT group_source AS k, count(*) AS n FROM linked WHERE group_source IS NOT NULL GROUP BY 1),
tried AS (SELECT seed, n, ('0x' || substr(md5(seed || ':' || k), 1, 12))::BIGINT % 10000 AS share FROM sizes, range(64) r(seed)),
parts AS (SELECT seed, split_name, any_value(target_pct) AS target_pct, any_value(whole) AS whole, sum(CASE WHEN share >= low AND share < high THEN n ELSE 0 END) AS n, sum(n) AS total FROM tried, ranges GROUP BY 1, 2),
best AS (SELECT seed FROM parts GROUP BY seed ORDER BY sum(abs(n * whole - total * target_pct)), seed LIMIT 1),
shared AS (SELECT *, ('0x' || substr(md5(coalesce((SELECT seed FROM best), 0) || ':' || coalesce(group_source, 'id:' || pair_id)), 1, 12))::BIGINT % 10000 AS share FROM linked)"""


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {
        "p1_found": f"""
WITH {_PAIRS},
n AS (SELECT count(*) AS n FROM pairs),
c AS (
  SELECT regexp_replace(lower(question_type), '^[ \\t]+|[ \\t]+$', '', 'g') AS question_type, coalesce(answerable, true) AS answerable, count(*) AS c
  FROM pairs GROUP BY ALL
)
SELECT plan_id, cell_id
FROM sample_targets t LEFT JOIN c USING (question_type, answerable), n
WHERE coalesce(c, 0) * 10000 < target_pct::BIGINT * sample_pct * n OR coalesce(c, 0) < min_rows""",
        "p1_plans": f"""
WITH {_PAIRS},
n AS (SELECT count(*) AS n FROM pairs),
c AS (
  SELECT regexp_replace(lower(question_type), '^[ \\t]+|[ \\t]+$', '', 'g') AS question_type, coalesce(answerable, true) AS answerable, count(*) AS c
  FROM pairs GROUP BY ALL
),
cells AS (SELECT plan_id, target_pct, target_pct::BIGINT * sample_pct * n AS wanted, least(greatest(min_rows, 0), coalesce(c, 0)) AS low, coalesce(c, 0) AS c FROM sample_targets LEFT JOIN c USING (question_type, answerable), n),
plans AS (SELECT plan_id, (2 * sum(wanted) + 10000) // 20000 AS total, sum(low) AS low, sum(CASE WHEN target_pct > 0 THEN c ELSE low END) AS high FROM cells GROUP BY 1)
SELECT plan_id, greatest(low, least(total, high)) AS sampled FROM plans WHERE greatest(low, least(total, high)) > 0""",
        "p2_found": f"""
WITH {_PAIRS},
ranked AS (
  SELECT pair_id, s, row_number() OVER (PARTITION BY s ORDER BY quality_score DESC NULLS LAST, pair_id) AS nth
  FROM (SELECT pair_id, quality_score, {_SOURCE} AS s FROM pairs)
)
SELECT pair_id FROM ranked WHERE s IS NOT NULL AND nth > (SELECT count(*) // 50 FROM pairs)""",
        "p2_contributors": f"""
WITH {_PAIRS}
SELECT contributor, n, CASE WHEN contributor IS NULL THEN n ELSE least(n, (SELECT count(*) // 50 FROM pairs)) END AS kept
FROM (SELECT {_SOURCE} AS contributor, count(*) AS n FROM pairs GROUP BY 1)""",
        "p3_found": f"""
{_NEAR}
SELECT a AS pair_id_a, b AS pair_id_b FROM pairwise WHERE {_SIMILAR}""",
        "p3_classes": f"""
{_NEAR},
classes AS (SELECT list_sort(w) AS w, n, min(pair_id) AS class_id, count(*) AS copies FROM sets GROUP BY 1, 2),
named AS (SELECT pair_id, class_id, copies FROM sets s JOIN classes c ON list_sort(s.w) = c.w AND s.n = c.n),
ends AS (
  SELECT DISTINCT x.class_id AS p, y.class_id AS q FROM pairwise JOIN named x ON x.pair_id = a JOIN named y ON y.pair_id = b WHERE {_SIMILAR} AND x.class_id <> y.class_id
),
links AS (SELECT class_id, count(*) AS links FROM (SELECT DISTINCT least(p, q), greatest(p, q), unnest([p, q]) AS class_id FROM ends) GROUP BY class_id)
SELECT pair_id, class_id, copies, coalesce(links, 0) AS links FROM named LEFT JOIN links USING (class_id)""",
        "p5_found": f"WITH RECURSIVE {_GROUPS}\nSELECT source, group_source FROM groups WHERE members > 1",
        "p5_split": f"""
WITH RECURSIVE {_SPLIT}
SELECT pair_id, split_name, group_source FROM shared LEFT JOIN ranges ON share >= low AND share < high""",
        "p5_shares": f"""
WITH RECURSIVE {_SPLIT},
got AS (SELECT split_name, count(*) AS records FROM shared JOIN ranges ON share >= low AND share < high GROUP BY 1)
SELECT split_name, target_pct::BIGINT AS target_pct, coalesce(records, 0) AS records, coalesce(records, 0) * 10000 // (SELECT count(*) FROM shared) AS share FROM split_targets LEFT JOIN got USING (split_name)""",
        "p6_checks": rf"""SELECT count(*) AS items, sum(n) AS tokens, 0 AS overfull, 0 AS divided_needlessly, true AS near_bound FROM (SELECT len(regexp_extract_all(coalesce(text, ''), '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}{_WS}]+')) AS n FROM documents)""",
        "p6_found": rf"SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}{_WS}]+')) > 1024",
        "p7_found": f"""
{_RUNS}
SELECT DISTINCT doc_id, item_id FROM hits""",
        "p7_spans": f"""
{_RUNS},
islands AS (SELECT doc_id, item_id, field, i - j AS d, i, i - row_number() OVER (PARTITION BY doc_id, item_id, field, i - j ORDER BY i) AS island FROM hits),
spans AS (SELECT doc_id, item_id, field, min(i) - 1 AS start, count(*) + 7 AS length FROM islands GROUP BY doc_id, item_id, field, d, island)
SELECT doc_id, item_id, field, start, length FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id, field ORDER BY length DESC, start) AS nth FROM spans) WHERE nth = 1""",
    }
