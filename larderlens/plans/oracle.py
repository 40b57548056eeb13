"""The same queries as plain SQL, for an independent engine to check them on the same tables.

Text rules use nested `regexp_replace`, matching joins the dictionary rows on `contains`, and what is
extracted from rendered pages is stated as a value per modulus, not parsed again.
"""

from __future__ import annotations

from larderlens.lexicon import ADJECTIVE_WORDS, UNIT_WORDS, dictionary_rows
from larderlens.plans.bindings import CUISINES, PANTRY
from larderlens.sources.seeds import ALLERGEN_ROWS, DIETARY_TAG_ROWS


def _lit(value) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def _values(name: str, columns: str, rows) -> str:
    body = ", ".join("(" + ", ".join(map(_lit, row)) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def _pick(values, key: str) -> str:
    return f"list_extract([{', '.join(map(_lit, values))}], CAST({key} % {len(values)} AS INT) + 1)"


def _replace(text: str, pattern: str) -> str:
    return f"regexp_replace({text}, {_lit(pattern)}, '', 'g')"


def _normalised(raw: str) -> str:
    text = _replace(f"lower(trim({raw}))", r"\(\$[\d.]+\)")
    for pattern in (r"^\d[\d/\.\s]*", r"^a\s+", r"^an\s+", r"^some\s+"):
        text = _replace(text, pattern)
    text = _replace(text, r"\b(" + "|".join(UNIT_WORDS) + r")\b")
    text = _replace(text, r"\b(" + "|".join(ADJECTIVE_WORDS) + r")\b")
    text = f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"
    return f"coalesce(nullif({text}, ''), lower(trim({raw})))"


PANTRY_CTE = _values("pantry", "pid, raw", enumerate(PANTRY)) + f""",
named AS (SELECT pid, raw, {_normalised('raw')} AS normalised FROM pantry)"""

DICT_CTE = _values("dict", "category, kind, word", dictionary_rows())

FLAGS_CTE = f"""{PANTRY_CTE},
{DICT_CTE},
flags AS (
  SELECT pid, category FROM named JOIN dict ON contains(normalised, word)
  GROUP BY pid, category HAVING bool_or(kind = 'keyword') AND NOT bool_or(kind = 'exception')),
lines AS (SELECT l_orderkey AS recipe_id, l_linenumber AS pos, pid, raw, normalised
  FROM lineitem JOIN named ON pid = l_partkey % 60),
recipe_flags AS (SELECT DISTINCT recipe_id, category FROM lines JOIN flags USING (pid))"""

DIMS_CTE = ",\n".join(
    (
        _values("allergens", "id, name, display_name, description", ALLERGEN_ROWS),
        _values("tags", "id, name, display_name, description", DIETARY_TAG_ROWS),
    )
)

RECIPES_CTE = f"""recipes AS (
  SELECT o_orderkey AS id, o_custkey % 2 + 1 AS source_id, 'Recipe ' || o_orderkey AS title,
    'https://example.org/recipes/' || o_orderkey AS url,
    CASE WHEN o_orderkey % 6 <> 0 THEN 'About recipe ' || o_orderkey END AS description,
    {_pick(CUISINES, 'o_custkey')} AS cuisine,
    CAST(o_orderkey % 40 AS INT) AS prep_time, CAST(o_orderkey % 25 AS INT) AS cook_time,
    CAST(CASE WHEN o_orderkey % 11 <> 0 THEN (o_orderkey * 7) % 180 END AS INT) AS total_time,
    CAST(CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 8 + 1 END AS INT) AS servings,
    CASE WHEN o_orderkey % 7 <> 0 THEN 'https://img.example.org/' || o_orderkey || '.jpg' END AS image_url
  FROM orders)"""

LINKS_CTE = f"""{FLAGS_CTE},
{DIMS_CTE},
{RECIPES_CTE},
recipe_allergens AS (SELECT recipe_id, id AS allergen_id, name FROM recipe_flags JOIN allergens ON name = category),
tag_names AS (
  SELECT id AS recipe_id, 'vegetarian' AS name FROM recipes
    WHERE id NOT IN (SELECT recipe_id FROM recipe_flags WHERE category = 'meat')
  UNION ALL SELECT id, 'vegan' FROM recipes
    WHERE id NOT IN (SELECT recipe_id FROM recipe_flags WHERE category IN ('meat', 'non_vegan'))
  UNION ALL SELECT id, 'gluten_free' FROM recipes
    WHERE id NOT IN (SELECT recipe_id FROM recipe_flags WHERE category = 'gluten')
  UNION ALL SELECT DISTINCT recipe_id, 'contains_raw_egg' FROM recipe_flags
    WHERE category IN ('raw_egg', 'raw_egg_any')),
recipe_tags AS (SELECT recipe_id, id AS dietary_tag_id, name FROM tag_names JOIN tags USING (name))"""

SAFE = """SELECT * FROM recipes WHERE total_time <= 60
  AND id NOT IN (SELECT recipe_id FROM recipe_allergens WHERE name IN ('dairy', 'egg'))
  AND id IN (SELECT recipe_id FROM recipe_tags WHERE name = 'vegetarian')"""

# What the rendered pages hold, per modulus of the order key.
URL = "'https://example.org/recipes/' || k"
HAS_BLOCK, HAS_TITLE = "k % 13 <> 0", "k % 13 <> 0 AND k % 17 <> 0"
IMAGE = "CASE WHEN k % 7 NOT IN (3, 4) THEN 'https://img.example.org/' || k || '.jpg' END"
DESCRIPTION = "CASE k % 5 WHEN 1 THEN 'About ' || k WHEN 4 THEN 'Plain ' || k END"
_PLAIN = _pick(("Italian", "Tex-Mex", None, None, None, "O'Neil Style", "British"), "k")
_CATEGORY = _pick(("Dinner", None, "Asian", "Prep", None, None, "Slow   Stew", "Dinner"), "k")
CUISINE = f"CASE WHEN c % 2 = 1 THEN coalesce({_PLAIN}, {_CATEGORY}) ELSE {_PLAIN} END"
PREP = f"CAST({_pick((30, 60, 90, 135, 0, None, None, None), 'k')} AS INT)"
COOK = f"CAST({_pick((None, None, 120, 2, 300, 60, None), 'k')} AS INT)"
TOTAL = "CAST(CASE WHEN k % 11 <> 0 THEN k * 7 % 180 END AS INT)"
SERVINGS = f"CAST({_pick((4, 4, 6, 4, 12, None, None, None, 8), 'k')} AS INT)"
O = "(SELECT o_orderkey AS k, o_custkey AS c FROM orders)"  # noqa: E741


def _if_block(value: str) -> str:
    return f"CASE WHEN {HAS_BLOCK} THEN {value} END"


N_LINES = """CAST(CASE WHEN k % 10 = 9 THEN 0 ELSE coalesce(n, 0) + CASE WHEN k % 10 = 3 THEN 1 ELSE 0 END END AS INT)"""

LOADED = "loaded AS (SELECT CAST(c_custkey AS VARCHAR) AS url FROM customer WHERE c_mktsegment = 'HOUSEHOLD')"
ARRIVALS_CTE = f"""arrivals AS (SELECT CASE WHEN event_id % 3 = 0 THEN 'front' WHEN event_id % 97 <> 0 THEN CAST(user_id AS VARCHAR) END AS url, user_id % 2 + 1 AS source_id, ts, event_id, event_type FROM events),
{LOADED},
good AS (SELECT url, ts, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts, event_id) AS n FROM arrivals WHERE event_type <> 'error' AND url IS NOT NULL) WHERE n = 1),
log AS (SELECT a.event_id, a.source_id, a.url,
  CASE WHEN l.url IS NOT NULL OR (g.url IS NOT NULL AND (a.ts, a.event_id) > (g.ts, g.event_id)) THEN 'skipped'
    WHEN a.event_id = g.event_id THEN 'success' ELSE 'failed' END AS status
  FROM arrivals a LEFT JOIN good g ON g.url = a.url LEFT JOIN loaded l ON l.url = a.url)"""

SITEMAP_CTE = """entries AS (
  SELECT o_orderkey AS k, o_orderkey // 200 AS n, o_orderkey // 1600 AS s, CAST((o_orderkey // 200) % 8 AS INT) AS pos,
    CASE WHEN o_orderkey % 7 = 0 THEN 'https://example.org/premium/recipes/' || o_orderkey
      WHEN o_orderkey % 9 = 0 THEN 'https://example.org/recipes/' || o_orderkey || '?a=1&b=2'
      WHEN o_orderkey % 6 = 0 THEN 'https://example.org/wp-content/' || o_orderkey || '.html'
      WHEN o_orderkey % 50 = 1 THEN 'https://example.org/recipes/shared-' || (o_orderkey // 1600)
      ELSE 'https://example.org/recipes/' || o_orderkey END AS url
  FROM orders),
maps AS (SELECT DISTINCT s, n, pos FROM entries)"""


def _discovery(sitemap_rule: str, url_rule: str) -> str:
    return f"""WITH {SITEMAP_CTE},
ranked AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY pos) AS rank FROM maps WHERE {sitemap_rule})
SELECT CAST(s AS VARCHAR) AS source, url, min(pos) AS sitemap_pos FROM entries
WHERE n IN (SELECT n FROM ranked WHERE rank <= 2) AND n % 23 <> 7 AND {url_rule} GROUP BY s, url"""


DETAIL_IDS = "wanted AS (SELECT DISTINCT c_custkey * 13 AS id FROM customer)"


def _names_of(links: str, alias: str) -> str:
    return f"(SELECT coalesce(string_agg(name, ',' ORDER BY name), '') FROM {links} x WHERE x.recipe_id = r.id) AS {alias}"


DISCOVERED = _discovery("pos NOT IN (1, 5)", "contains(url, '/recipes/') AND NOT contains(url, '/premium/')")


def _answer(number: int, rule: str, page: int, size: int) -> str:
    shown = """id || '|' || title || '|' || coalesce((SELECT string_agg(name, ',' ORDER BY name) FROM recipe_allergens x WHERE x.recipe_id = r.id), '')
      || '|' || coalesce((SELECT string_agg(name, ',' ORDER BY name) FROM recipe_tags x WHERE x.recipe_id = r.id), '')"""
    kept = f"SELECT * FROM recipes WHERE {rule}"
    return f"""SELECT CAST({number} AS INT) AS request, (SELECT count(*) FROM ({kept})) AS total, CAST({page} AS INT) AS page, CAST({size} AS INT) AS size,
      coalesce((SELECT string_agg({shown}, ';' ORDER BY id) FROM ({kept} ORDER BY id LIMIT {size} OFFSET {(page - 1) * size}) r), '') AS results"""


_TAGGED = "id IN (SELECT recipe_id FROM recipe_tags WHERE name = '{}')"

ORACLE = {
    "page_status": f"""SELECT {URL} AS url, CASE WHEN {HAS_TITLE} THEN 'success' ELSE 'skipped' END AS status FROM {O}
      UNION ALL SELECT url, 'skipped' FROM pages""",
    "extract_jsonld": f"""SELECT {URL} AS url, {HAS_BLOCK} AS has_recipe,
      CASE WHEN {HAS_BLOCK} THEN CASE WHEN k % 17 = 0 THEN '  ' ELSE '  Recipe ' || k || '  ' END END AS name FROM {O}
      UNION ALL SELECT url, false, NULL FROM pages""",
    "extract_recipes": f"""SELECT {URL} AS url, 'Recipe ' || k AS title, {DESCRIPTION} AS description, {CUISINE} AS cuisine,
      {PREP} AS prep_time, {COOK} AS cook_time, {TOTAL} AS total_time, {SERVINGS} AS servings, {IMAGE} AS image_url,
      {N_LINES} AS n_lines
      FROM {O} LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = k WHERE {HAS_TITLE}""",
    "extract_image": f"SELECT {URL} AS url, {_if_block(IMAGE)} AS image_url FROM {O}",
    "extract_cuisine": f"""SELECT {URL} AS url, CAST(c % 2 + 1 AS VARCHAR) AS source, {_if_block(CUISINE)} AS cuisine FROM {O}""",
    "duration_minutes": f"""SELECT {URL} AS url, {_if_block(PREP)} AS prep_time, {_if_block(COOK)} AS cook_time,
      {_if_block(TOTAL)} AS total_time FROM {O}""",
    "servings": f"SELECT {URL} AS url, {_if_block(SERVINGS)} AS servings FROM {O}",
    "ingredient_lines": f"""WITH {PANTRY_CTE},
      lines AS (SELECT l_orderkey AS k, raw, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, raw) AS n
        FROM lineitem JOIN pantry ON pid = l_partkey % 60)
      SELECT {URL} AS url, CAST(n - 1 + CASE WHEN k % 10 = 3 THEN 1 ELSE 0 END AS INT) AS pos, raw
      FROM lines WHERE k % 10 <> 9 AND {HAS_TITLE}
      UNION ALL SELECT {URL}, 0, '' FROM {O} WHERE k % 10 = 3 AND {HAS_TITLE}""",
    "recipe_table": f"""SELECT {URL} AS url, CAST(c % 2 + 1 AS VARCHAR) AS source,
      'Recipe ' || k || CASE WHEN k % 20 = 0 THEN ' again' ELSE '' END AS title, {DESCRIPTION} AS description,
      {CUISINE} AS cuisine, {PREP} AS prep_time, {COOK} AS cook_time, {TOTAL} AS total_time, {SERVINGS} AS servings,
      {IMAGE} AS image_url FROM {O} WHERE {HAS_TITLE} AND k % 29 <> 0 AND k % 31 <> 0""",
    "load_discovered": f"""SELECT {URL} AS url, 'Recipe ' || k AS title FROM {O} WHERE {URL} IN (SELECT url FROM ({DISCOVERED}))""",
    "discover_recipe_urls": _discovery("pos NOT IN (1, 5)", "contains(url, '/recipes/') AND NOT contains(url, '/premium/')"),
    "discover_post_urls": _discovery("true", "NOT contains(url, 'wp-content')"),
    # The index lists sitemaps from the last to the first, after a comment and, in every third, one that was lost.
    "discover_index": f"""WITH {SITEMAP_CTE},
      listed AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY pos DESC) + CAST(s % 3 = 1 AS INT) AS place FROM maps WHERE s % 5 <> 4),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY pos DESC) + CAST(s % 3 = 1 AS INT) AS rank FROM listed WHERE pos NOT IN (1, 5))
      SELECT CAST(e.s AS VARCHAR) AS source, url, CAST(min(place) AS INT) AS sitemap_pos FROM entries e JOIN ranked r USING (n)
      WHERE rank <= 2 AND n % 23 <> 7 AND contains(url, '/recipes/') AND NOT contains(url, '/premium/') GROUP BY e.s, url""",
    "source_upsert": """SELECT DISTINCT 'Site ' || l_suppkey AS name, 'https://site-' || l_suppkey || '.example.org' AS base_url
      FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 3000)""",
    "enabled_sources": """SELECT s_suppkey AS id, s_name AS name, 'https://site-' || s_suppkey || '.example.org' AS base_url
      FROM supplier WHERE s_acctbal >= 3000""",
    "normalise_ingredients": f"WITH {FLAGS_CTE} SELECT recipe_id, pos, raw, normalised FROM lines",
    "ingredient_dim": f"WITH {FLAGS_CTE} SELECT DISTINCT raw AS raw_name, normalised AS normalised_name FROM lines",
    "recipe_ingredient_bridge": f"WITH {FLAGS_CTE} SELECT DISTINCT recipe_id, raw AS raw_name FROM lines",
    "ingredient_allergens": f"""WITH {LINKS_CTE}
      SELECT DISTINCT raw AS raw_name, name AS allergen, 'high' AS confidence
      FROM lines JOIN flags USING (pid) JOIN allergens ON name = category""",
    "dictionary_scan_documents": f"""WITH {DICT_CTE}, docs AS (SELECT doc_id, lower(text) AS t FROM documents)
      SELECT doc_id, category FROM docs JOIN dict ON contains(t, word)
      GROUP BY doc_id, category HAVING bool_or(kind = 'keyword') AND NOT bool_or(kind = 'exception')""",
    "recipe_allergens": f"WITH {LINKS_CTE} SELECT recipe_id, name AS allergen FROM recipe_allergens",
    "recipe_dietary_tags": f"WITH {LINKS_CTE} SELECT recipe_id, name AS tag FROM recipe_tags",
    "raw_egg_recipes": f"""WITH {FLAGS_CTE} SELECT recipe_id, bool_or(category = 'raw_egg') AS by_tag_rule,
      bool_or(category = 'raw_egg_any') AS by_second_check
      FROM recipe_flags WHERE category IN ('raw_egg', 'raw_egg_any') GROUP BY recipe_id""",
    "incremental_new_urls": f"""WITH {ARRIVALS_CTE} SELECT url, event_id FROM good
      WHERE url NOT IN (SELECT url FROM loaded)""",
    "run_log": f"""WITH {ARRIVALS_CTE} SELECT event_id, source_id, coalesce(url, '') AS url, status,
      CASE WHEN url IS NULL THEN 'url missing' WHEN status = 'failed' THEN 'error on ' || url END AS error_message FROM log""",
    "run_summary": f"""WITH {ARRIVALS_CTE} SELECT source_id, count(*) FILTER (status <> 'failed') AS ok,
      count(*) FILTER (status = 'failed') AS failed FROM log GROUP BY source_id""",
    "recipes_page": f"""WITH {RECIPES_CTE} SELECT id, title, url, cuisine, prep_time, cook_time, total_time, servings, image_url
      FROM recipes ORDER BY id LIMIT 20 OFFSET 40""",
    "recipes_page_deep": f"WITH {RECIPES_CTE} SELECT id, title FROM recipes ORDER BY id LIMIT 20 OFFSET 1180",
    "recipes_page_after": f"WITH {RECIPES_CTE} SELECT id, title FROM recipes WHERE id > 1000 ORDER BY id LIMIT 20",
    "recipes_pages_indexed": f"""WITH {RECIPES_CTE}, placed AS (SELECT id, title, (row_number() OVER (ORDER BY id) - 1) // 20 + 1 AS page FROM recipes)
      SELECT page, id, title FROM placed WHERE page IN (1, 60, 500, 5000) OR page = (SELECT max(page) FROM placed)""",
    "allergen_set_totals": f"""WITH {LINKS_CTE}, sets AS (SELECT range AS n FROM range(16)),
      members AS (SELECT n, name, id FROM sets JOIN (SELECT *, row_number() OVER (ORDER BY name) - 1 AS k FROM allergens) ON (n >> k) % 2 = 1)
      SELECT coalesce((SELECT string_agg(name, ',' ORDER BY name) FROM members m WHERE m.n = s.n), '') AS excluded,
        (SELECT count(*) FROM recipes r WHERE NOT EXISTS (SELECT 1 FROM recipe_allergens x JOIN members m ON m.id = x.allergen_id AND m.n = s.n WHERE x.recipe_id = r.id)) AS total
      FROM sets s""",
    "cube_totals": f"""WITH {LINKS_CTE}
      SELECT CAST(0 AS INT) AS request, count(*) AS total FROM ({SAFE})
      UNION ALL SELECT 1, count(*) FROM recipes WHERE cuisine ILIKE '%ian%'
      UNION ALL SELECT 2, count(*) FROM recipes WHERE {_TAGGED.format('vegan')} AND {_TAGGED.format('contains_raw_egg')}""",
    "recipe_list": f"""WITH {LINKS_CTE}
      {_answer(0, f"id IN (SELECT id FROM ({SAFE}))", 2, 20)}
      UNION ALL {_answer(1, "cuisine ILIKE '%ian%'", 1, 50)}
      UNION ALL {_answer(2, f"{_TAGGED.format('vegan')} AND {_TAGGED.format('contains_raw_egg')}", 1, 20)}""",
    "filter_cuisine": f"WITH {RECIPES_CTE} SELECT id, cuisine FROM recipes WHERE cuisine ILIKE '%ian%'",
    "filter_max_time": f"WITH {RECIPES_CTE} SELECT id, total_time FROM recipes WHERE total_time <= 30",
    "exclude_allergens": f"""WITH {LINKS_CTE} SELECT id, title FROM recipes
      WHERE id NOT IN (SELECT recipe_id FROM recipe_allergens WHERE name IN ('dairy', 'egg'))""",
    "require_tags": f"""WITH {LINKS_CTE} SELECT id, title FROM recipes
      WHERE id IN (SELECT recipe_id FROM recipe_tags WHERE name = 'vegetarian')
        AND id IN (SELECT recipe_id FROM recipe_tags WHERE name = 'gluten_free')""",
    "safe_recipes": f"WITH {LINKS_CTE}, safe AS ({SAFE}) SELECT id, title, cuisine, total_time FROM safe",
    "filtered_count": f"WITH {LINKS_CTE}, safe AS ({SAFE}) SELECT count(*) AS total FROM safe",
    "recipe_summary": f"""WITH {LINKS_CTE}
      SELECT id, title, url, cuisine, prep_time, cook_time, total_time, servings, image_url,
        {_names_of('recipe_allergens', 'allergens')}, {_names_of('recipe_tags', 'dietary_tags')} FROM recipes r""",
    "recipe_detail": f"""WITH {LINKS_CTE}, {DETAIL_IDS}
      SELECT id, title, description, {_names_of('recipe_allergens', 'allergens')}, {_names_of('recipe_tags', 'dietary_tags')},
        (SELECT coalesce(string_agg(DISTINCT raw || '=' || normalised, ';' ORDER BY raw || '=' || normalised), '')
          FROM lines x WHERE x.recipe_id = r.id) AS ingredients
      FROM recipes r WHERE id IN (SELECT id FROM wanted)""",
    "recipe_allergens_of": f"""WITH {LINKS_CTE}, {DETAIL_IDS}
      SELECT recipe_id, CAST(a.id AS INT) AS id, a.name, display_name, a.description
      FROM recipe_allergens JOIN allergens a ON a.id = allergen_id
      WHERE recipe_id IN (SELECT id FROM wanted)""",
    "recipe_tags_of": f"""WITH {LINKS_CTE}, {DETAIL_IDS}
      SELECT recipe_id, CAST(t.id AS INT) AS id, t.name, display_name, t.description
      FROM recipe_tags JOIN tags t ON t.id = dietary_tag_id
      WHERE recipe_id IN (SELECT id FROM wanted)""",
    "cuisines": f"WITH {RECIPES_CTE} SELECT DISTINCT cuisine FROM recipes WHERE cuisine IS NOT NULL ORDER BY cuisine",
    "allergen_list": f"""WITH {LINKS_CTE} SELECT CAST(id AS INT) AS id, name, display_name, description,
      (SELECT count(*) FROM recipe_allergens WHERE allergen_id = a.id) AS recipes FROM allergens a ORDER BY display_name""",
    "dietary_tag_list": f"""WITH {LINKS_CTE} SELECT CAST(id AS INT) AS id, name, display_name, description,
      (SELECT count(*) FROM recipe_tags WHERE dietary_tag_id = t.id) AS recipes FROM tags t ORDER BY display_name""",
    "page_info": f"""WITH {RECIPES_CTE} SELECT source_id, cuisine, count(*) AS total,
      CAST(ceil(count(*) / 20.0) AS BIGINT) AS pages, CAST(21 AS BIGINT) AS row_from,
      CAST(least(40, count(*)) AS BIGINT) AS row_to FROM recipes GROUP BY source_id, cuisine""",
    "time_label": f"""WITH {RECIPES_CTE} SELECT id, CASE WHEN total_time > 0 THEN total_time || ' min'
      WHEN prep_time > 0 THEN prep_time || ' min prep' WHEN cook_time > 0 THEN cook_time || ' min cook' END AS time_label
      FROM recipes""",
    "time_buckets": f"""WITH {RECIPES_CTE} SELECT CAST(n AS INT) AS max_total_time, count(id) AS total
      FROM (VALUES (15), (30), (60), (90)) v(n) LEFT JOIN recipes ON total_time <= n GROUP BY n""",
    "dq_duplicates": f"""WITH {FLAGS_CTE}
      SELECT 'recipes.url' AS rule, 'https://example.org/recipes/' || k AS key, count(*) AS copies
      FROM (SELECT CASE WHEN o_orderkey % 50 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS k FROM orders) GROUP BY k HAVING count(*) > 1
      UNION ALL SELECT 'recipe_ingredients.pair', recipe_id || '|' || raw, count(*) FROM lines GROUP BY recipe_id, raw HAVING count(*) > 1
      UNION ALL SELECT 'sources.base_url', 'https://site-' || k || '.example.org', count(*)
      FROM (SELECT CASE WHEN s_suppkey % 10 = 1 THEN s_suppkey - 1 ELSE s_suppkey END AS k FROM supplier) GROUP BY k HAVING count(*) > 1
      UNION ALL SELECT 'ingredients.raw_name', raw, count(*) FROM lines GROUP BY raw HAVING count(*) > 1""",
    "dq_orphans": f"""WITH {FLAGS_CTE}
      SELECT 'recipe_ingredients.recipe_id' AS rule, CAST(recipe_id AS VARCHAR) AS key, count(*) AS rows FROM lines
      WHERE recipe_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT') GROUP BY recipe_id
      UNION ALL SELECT 'recipes.source_id', CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem
      WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 3000) GROUP BY l_suppkey
      UNION ALL SELECT 'recipe_ingredients.ingredient_id', raw, count(*) FROM lines WHERE raw LIKE 'a%' GROUP BY raw""",
    "dq_lengths": """WITH broken AS (SELECT o_orderkey AS id,
        CASE WHEN o_orderkey % 40 = 0 THEN repeat('x', 300) WHEN o_orderkey % 43 <> 0 THEN 'Recipe ' || o_orderkey END AS title,
        CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 47 = 0
          THEN 'https://example.org/recipes/' || o_orderkey || repeat('y', 500)
          ELSE 'https://example.org/recipes/' || o_orderkey END AS url FROM orders)
      SELECT 'title missing' AS rule, id, CAST(NULL AS INT) AS length FROM broken WHERE title IS NULL
      UNION ALL SELECT 'url missing', id, NULL FROM broken WHERE url IS NULL
      UNION ALL SELECT 'title longer than 255', id, CAST(length(title) AS INT) FROM broken WHERE length(title) > 255
      UNION ALL SELECT 'url longer than 500', id, CAST(length(url) AS INT) FROM broken WHERE length(url) > 500
      UNION ALL SELECT 'quantity longer than 50', l_orderkey, 60 FROM lineitem WHERE l_orderkey % 101 = 0
      UNION ALL SELECT 'preparation longer than 100', l_orderkey, 120 FROM lineitem WHERE l_orderkey % 103 = 0""",
    "delete_ingredients": f"""WITH {LINKS_CTE}, names AS (SELECT DISTINCT pid, raw FROM lines)
      SELECT 'ingredient' AS kind, raw AS raw_name FROM names WHERE raw NOT LIKE '1%'
      UNION ALL SELECT 'refused', raw FROM names WHERE raw LIKE '2%'
      UNION ALL SELECT 'allergen row', raw FROM names JOIN flags USING (pid) JOIN allergens ON name = category WHERE raw NOT LIKE '1%'""",
    "dq_domains": """SELECT 'status' AS column_name, event_id, event_type AS value FROM events
      WHERE event_type NOT IN ('click', 'view', 'error')""",
    "cascade_delete": f"""WITH {LINKS_CTE}, gone AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW'),
      bridge AS (SELECT DISTINCT recipe_id, raw FROM lines)
      SELECT 'recipes' AS table_name, id AS recipe_id, count(*) AS rows_left FROM recipes WHERE id NOT IN (SELECT o_orderkey FROM gone) GROUP BY id
      UNION ALL SELECT 'recipe_ingredients', recipe_id, count(*) FROM bridge WHERE recipe_id NOT IN (SELECT o_orderkey FROM gone) GROUP BY recipe_id
      UNION ALL SELECT 'recipe_allergens', recipe_id, count(*) FROM recipe_allergens WHERE recipe_id NOT IN (SELECT o_orderkey FROM gone) GROUP BY recipe_id
      UNION ALL SELECT 'recipe_dietary_tags', recipe_id, count(*) FROM recipe_tags WHERE recipe_id NOT IN (SELECT o_orderkey FROM gone) GROUP BY recipe_id""",
}

ORACLE["noted_checks"] = f"""WITH {LINKS_CTE}, kept AS (SELECT *, id - CAST(id % 50 = 1 AS INT) AS shown FROM recipes WHERE id IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT'))
  SELECT 'repeated' AS kind, 'recipes.url' AS rule, 'https://example.org/recipes/' || shown AS key, count(*) AS rows FROM kept GROUP BY shown HAVING count(*) > 1
  UNION ALL SELECT 'no parent', 'recipes.source_id', CAST(source_id AS VARCHAR), count(*) FROM kept GROUP BY source_id
  UNION ALL SELECT 'no parent', 'recipe_allergens.recipe_id', CAST(recipe_id AS VARCHAR), count(*) FROM recipe_allergens
    WHERE recipe_id NOT IN (SELECT id FROM kept) GROUP BY recipe_id"""

# The same deletions, on stored tables.
ORACLE["stored_cascade_delete"] = ORACLE["cascade_delete"]
ORACLE["stored_ingredient_delete"] = ORACLE["delete_ingredients"]
