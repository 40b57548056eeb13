"""Recipe-shaped views of general star-schema tables, for the query catalogue and the bench.

Orders play the recipes, line items the ingredient lines, events the page arrivals, suppliers the sources.
Pages and sitemaps are rendered from the orders, with every field variant chosen by a modulus, so that the
extraction and discovery jobs run over as many documents as there are orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larderlens.functions.skew import deal, tasks_for, widen

# The ingredient lines of the golden table, in id order.
PANTRY = (
    "200g dried spaghetti", "2 large free-range eggs", "3 tbsp olive oil", "1/2 tsp fine sea salt",
    "100ml double cream", "4 Roma tomatoes ($1.35)", "2 Tbsp butter, room temperature ($0.36)",
    "100g parmesan, finely grated", "a pinch of salt", "2 cloves garlic", "500g fresh pasta",
    "2 tablespoons whole milk", "400ml coconut milk", "1 cup almond milk", "2 tbsp peanut butter",
    "30g mixed peanuts and almonds", "1 eggplant", "50g water chestnuts", "1 tsp nutmeg", "2 doughnuts",
    "150g buckwheat flour", "2 corn tortillas", "1 tbsp soy sauce", "2 tbsp tamari", "100g kale",
    "200ml champagne", "1 tsp cream of tartar", "1 butternut squash", "2 minced garlic cloves",
    "3 tbsp mayonnaise", "2 egg yolks", "1 tbsp coconut cream mayonnaise", "chicken in coconut milk",
    "100g rice noodles", "1 tbsp honey", "2 anchovies", "1 tbsp worcestershire sauce", "1 tbsp fish sauce",
    "200g chickpeas", "1 onion", "2 tins tuna", "100g feta", "satay sauce", "groundnut oil", "1 can",
    "50g marzipan", "some mozzarella", "100g plain flour ($0.45)", "150g gluten-free bread", "1 lemon",
    "1 tsp cumin", "250g basmati rice", "crème fraîche", "an avocado", "shea butter", "1 tsp graham crackers",
    "2 tsp caesar dressing", "2 biscuits", "soy milk", "80g lentils",
)
CUISINES = ("Italian", "Indian", "British", "Asian", "Mexican", None)

# JSON texts of the page fields; the value at `o_orderkey % length` is rendered. {k} is the order key.
NAMES = '"  Recipe {k}  "'
DESCRIPTIONS = ("null", '"<p>About <b>{k}</b></p>"', '""', '"<br>"', '"Plain {k}"')
IMAGES = (
    '"https://img.example.org/{k}.jpg"', '{{"url":"https://img.example.org/{k}.jpg"}}',
    '["https://img.example.org/{k}.jpg","https://img.example.org/other.jpg"]', "null", "[]",
    '[{{"url":"https://img.example.org/{k}.jpg"}}]', '[[["https://img.example.org/{k}.jpg"],1]]',
)
RECIPE_CUISINES = ('"italian"', '["tex-mex","x"]', "null", '""', "[]", '"  o\'neil style "', '"British"')
RECIPE_CATEGORIES = (
    '"Dinner Recipes"', '"Main Dishes"', '["Asian Inspired Recipes"]', '"Meal Prep"', "null", '"food"',
    '"Slow  cooking Stew"', '"dinner"',
)
PREP_TIMES = ('"PT30M"', '"PT1H"', '"PT1H30M"', '"PT2H15M"', '"PT0M"', "null", '""', '"30 minutes"')
COOK_TIMES = ('"P0D"', '"PT90S"', '"P1DT2H"', '"P2M"', '"PT1.5H"', '"PT1H30"', '"PTHM"')
YIELDS = ('"4"', '"4 servings"', '"Serves 6"', '["4 servings"]', '"Makes 12"', "null", "[]", "0", "8")

PAGE_COMMENT = '<!-- <script type="application/ld+json">{"@type":"Recipe","name":"Commented out"}</script> -->'
LIST_TYPED = '<script type="application/ld+json">{"@type":["Recipe"],"name":"Not this"}</script>'

CATEGORY_SOURCES = ["2"]
URLS_PER_SITEMAP = 200
SITEMAPS_PER_SOURCE = 8

# Pages that one task renders and parses where no lines are joined to them.
PAGES_PER_TASK = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values)).cast("int") + 1)


def recipe_url(key: Column) -> Column:
    return F.concat(F.lit("https://example.org/recipes/"), key.cast("string"))


def recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recipes table, from orders."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("id"),
        (c % 2 + 1).alias("source_id"),
        F.concat(F.lit("Recipe "), k.cast("string")).alias("title"),
        recipe_url(k).alias("url"),
        F.when(k % 6 != 0, F.concat(F.lit("About recipe "), k.cast("string"))).alias("description"),
        _pick(CUISINES, c).alias("cuisine"),
        (k % 40).cast("int").alias("prep_time"),
        (k % 25).cast("int").alias("cook_time"),
        F.when(k % 11 != 0, (k * 7) % 180).cast("int").alias("total_time"),
        F.when(k % 9 != 0, k % 8 + 1).cast("int").alias("servings"),
        F.when(k % 7 != 0, F.concat(F.lit("https://img.example.org/"), k.cast("string"), F.lit(".jpg"))).alias(
            "image_url"
        ),
    )


def line_tasks(spark: SparkSession, sf_dir: str) -> int:
    """To how many tasks the ingredient lines are dealt by recipe."""
    return tasks_for(table(spark, sf_dir, "lineitem"))


def lines(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """The ingredient lines (recipe_id, pos, raw), from line items, dealt by recipe."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return deal(items, "l_orderkey", tasks=tasks).select(
        F.col("l_orderkey").alias("recipe_id"),
        F.col("l_linenumber").alias("pos"),
        _pick(PANTRY, F.col("l_partkey")).alias("raw"),
    )


def _rendered(values: tuple, key: Column) -> Column:
    """The text at `key % length`, with its key filled in."""
    plain = tuple(v.format(k="\x01") for v in values)
    return F.replace(_pick(plain, key), F.lit("\x01"), key.cast("string"))


def _line_lists(spark: SparkSession, sf_dir: str, tasks: int) -> DataFrame:
    """(recipe_id, items): the lines of each order as JSON items; an order has a handful."""
    listed = lines(spark, sf_dir, tasks).groupBy("recipe_id").agg(F.sort_array(F.collect_list(F.struct("pos", "raw"))).alias("l"))
    items = F.regexp_replace(F.to_json("l.raw"), r"^\[|\]$", "")
    return listed.select("recipe_id", items.alias("items"))


def pages(spark: SparkSession, sf_dir: str, with_lines: bool = True, with_copies: bool = False) -> DataFrame:
    """Recipe pages (url, source, arrival, html) rendered from orders.

    One page in 13 has no block and one in 17 a blank title. With copies, one in 10 arrives twice under another
    name; of those, every second has no block the first time; and one in 29 has lost its URL.
    """
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # Orders and their lines are dealt to the same tasks, so that they meet where they are.
    tasks = max(tasks_for(orders, PAGES_PER_TASK), line_tasks(spark, sf_dir) if with_lines else 1)
    base = deal(orders, "o_orderkey", tasks=tasks)
    if with_lines:
        base = base.join(_line_lists(spark, sf_dir, tasks), F.col("recipe_id") == k, "left")
    else:
        base = base.withColumn("items", F.lit(""))
    copies = F.when((k % 10 == 0) & F.lit(with_copies), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    base = base.select("o_orderkey", "o_custkey", "items", F.explode(copies).alias("arrival"))

    again = F.when(F.col("arrival") == 2, F.concat(F.lit('"Recipe '), k.cast("string"), F.lit(' again"')))
    name = F.when(k % 17 == 0, F.lit('"  "')).otherwise(F.coalesce(again, _rendered((NAMES,), k)))
    items = F.coalesce("items", F.lit(""))
    extra = F.when(k % 10 == 3, F.when(items == "", F.lit('"",null,"  "')).otherwise(F.lit('"",null,"  ",')))
    ingredients = F.when(k % 10 == 9, F.lit('"flour"')).otherwise(
        F.concat(F.lit("["), F.coalesce(extra, F.lit("")), items, F.lit("]"))
    )
    total = F.when(k % 11 == 0, F.lit("null")).otherwise(F.concat(F.lit('"PT'), (k * 7 % 180).cast("string"), F.lit('M"')))
    fields = {
        "name": name,
        "description": _rendered(DESCRIPTIONS, k),
        "image": _rendered(IMAGES, k),
        "recipeCuisine": _pick(RECIPE_CUISINES, k),
        "recipeCategory": _pick(RECIPE_CATEGORIES, k),
        "prepTime": _pick(PREP_TIMES, k),
        "cookTime": _pick(COOK_TIMES, k),
        "totalTime": total,
        "recipeYield": _pick(YIELDS, k),
        "recipeIngredient": ingredients,
    }
    members = [part for field, value in fields.items() for part in (F.lit(f',"{field}":'), value)]
    node = F.concat(F.lit('{"@context":"https://schema.org","@type":"Recipe"'), *members, F.lit("}"))
    forms = (
        ('<script type="application/ld+json">', "</script>"),
        ("<script type='application/ld+json' id=\"x\">[{\"@type\":\"Organization\",\"name\":\"Site\"},", "]</script>"),
        ('<SCRIPT async type="application/ld+json" >{"@graph":[{"@type":"WebPage","name":"W"},', "]}</SCRIPT>"),
        ('<script type="application/ld+json">{broken</script>\n<script type=application/ld+json>', "</script>"),
        ('<script type="application/ld&#x2B;json">', "</script>"),
        ('<script type="application/ld+json">[{"@type":"Offer","name":"NaN","price":[NaN,-Infinity]},', "]</script>"),
    )
    block = F.concat(_pick(tuple(f[0] for f in forms), k), F.col("node"), _pick(tuple(f[1] for f in forms), k))
    no_block = (k % 13 == 0) | ((k % 20 == 0) & (F.col("arrival") == 1) & F.lit(with_copies))
    html = F.concat(
        F.lit(f"<html><head>{PAGE_COMMENT}<title>Page</title>"),
        F.when(k % 5 == 0, F.lit(LIST_TYPED)).otherwise(F.lit("")),
        F.when(no_block, F.lit("<script>var x = '<!--';</script>")).otherwise(block),
        F.lit("</head><body><p>Text</p></body></html>"),
    )
    url = F.when(~((k % 29 == 0) & F.lit(with_copies)), recipe_url(k))
    return base.withColumn("node", node).select(
        url.alias("url"), (F.col("o_custkey") % 2 + 1).cast("string").alias("source"), "arrival", html.alias("html")
    )


def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as fetched (url, source, html): the pages table, which has no recipes."""
    return widen(table(spark, sf_dir, "pages").select("url", F.lit("1").alias("source"), "html"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts (doc_id, text)."""
    return widen(table(spark, sf_dir, "documents").select("doc_id", "text"))


def sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemaps (source, sitemap_pos, sitemap_url, xml) of up to 200 orders each, 8 to a source.

    They hold premium, media, escaped, repeated and shared URLs; one sitemap in 23 could not be fetched.
    """
    k = F.col("k")
    number = F.floor(k / URLS_PER_SITEMAP)
    source = F.floor(number / SITEMAPS_PER_SOURCE)
    text = k.cast("string")
    url = (
        F.when(k % 7 == 0, F.concat(F.lit("https://example.org/premium/recipes/"), text))
        .when(k % 45 == 0, F.concat(F.lit("<![CDATA[https://example.org/recipes/"), text, F.lit("?a=1&b=2]]>")))
        .when(k % 18 == 0, F.concat(F.lit("https://example.org/recipes/"), text, F.lit("?a=1&#038;b&#x3d;2")))
        .when(k % 9 == 0, F.concat(F.lit("https://example.org/recipes/"), text, F.lit("?a=1&amp;b=2")))
        .when(k % 6 == 0, F.concat(F.lit("https://example.org/wp-content/"), text, F.lit(".html")))
        .when(k % 50 == 1, F.concat(F.lit("https://example.org/recipes/shared-"), source.cast("string")))
        .otherwise(F.concat(F.lit("https://example.org/recipes/"), text))
    )
    loc = F.concat(F.lit("<url><loc> "), url, F.lit(" </loc>"))
    image = F.concat(F.lit("<image:image><image:loc>https://example.org/wp-content/"), text, F.lit(".jpg</image:loc></image:image></url>"))
    entry = F.concat(loc, image, F.when(k % 10 == 0, F.concat(loc, F.lit("</url>"))).otherwise(F.lit("")))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).select("k", number.alias("n"), entry.alias("entry"))
    docs = rows.groupBy("n").agg(F.sort_array(F.collect_list(F.struct("k", "entry"))).alias("entries"))
    n = F.col("n")
    pos = n % SITEMAPS_PER_SOURCE
    kind = F.when(pos.isin(1, 5), F.lit("-articles.xml")).otherwise(F.lit("-recipe.xml"))
    xml = F.concat(
        F.lit('<?xml version="1.0"?><urlset><!-- <loc>https://example.org/recipes/hidden</loc> -->'),
        F.array_join("entries.entry", "\n"),
        F.lit("</urlset>"),
    )
    return docs.select(
        F.floor(n / SITEMAPS_PER_SOURCE).cast("string").alias("source"),
        pos.cast("int").alias("sitemap_pos"),
        F.concat(F.lit("https://example.org/"), n.cast("string"), kind).alias("sitemap_url"),
        F.when(n % 23 != 7, xml).alias("xml"),
    )


def sitemap_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemap indexes (source, xml), one to a source, that list its sitemaps newest first; one in 5 could not be fetched.

    A comment hides one, and one that was never fetched stands at the top of every third index.
    """
    maps = sitemaps(spark, sf_dir).select("source", "sitemap_pos", F.concat(F.lit("<sitemap><loc>\n "), "sitemap_url", F.lit(" </loc></sitemap>")).alias("entry"))
    listed = maps.groupBy("source").agg(F.sort_array(F.collect_list(F.struct((-F.col("sitemap_pos")).alias("by"), "entry"))).alias("l"))
    number = F.col("source").cast("int")
    lost = F.when(number % 3 == 1, F.lit("<sitemap><loc>https://example.org/lost-recipe.xml</loc></sitemap>")).otherwise(F.lit(""))
    xml = F.concat(
        F.lit('<?xml version="1.0"?><sitemapindex><!-- <loc>https://example.org/hidden-recipe.xml</loc> -->'),
        lost, F.array_join("l.entry", ""), F.lit("</sitemapindex>"),
    )
    return listed.select("source", F.when(number % 5 != 4, xml).alias("xml"))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page arrivals (url, source_id, ts, event_id, event_type), from events. A third is of one URL, and a few have none."""
    user, event = F.col("user_id"), F.col("event_id")
    url = F.when(event % 3 == 0, F.lit("front")).when(event % 97 != 0, user.cast("string"))
    return table(spark, sf_dir, "events").select(
        url.alias("url"), (user % 2 + 1).alias("source_id"), "ts", "event_id", "event_type"
    )


def loaded_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs loaded in earlier runs: the customers of one segment."""
    earlier = table(spark, sf_dir, "customer").where("c_mktsegment = 'HOUSEHOLD'")
    return earlier.select(F.col("c_custkey").cast("string").alias("url"))


def recipe_ids(spark: SparkSession, sf_dir: str, priority: str) -> DataFrame:
    """Ids of the recipes whose order has a priority."""
    return table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == priority).select(F.col("o_orderkey").alias("id"))


def site_url(key: Column) -> Column:
    return F.concat(F.lit("https://site-"), key.cast("string"), F.lit(".example.org"))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources table, from suppliers; those with a low balance are disabled."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("id"), F.col("s_name").alias("name"), site_url(key).alias("base_url"), (F.col("s_acctbal") >= 3000).alias("enabled")
    )


def wanted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipe ids asked for, from customers; some do not exist."""
    return table(spark, sf_dir, "customer").select((F.col("c_custkey") * 13).alias("id"))
