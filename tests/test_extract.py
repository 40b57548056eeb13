import json

import pytest
from pyspark.sql import functions as F

from larderlens import session
from larderlens.functions import labels, text
from larderlens.operators import discover, extract
from larderlens.operators.discover import POST_SITEMAPS, RECIPE_SITEMAPS

LD = '<script type="application/ld+json">{}</script>'


@pytest.fixture(autouse=True)
def configured(spark):
    session.configure(spark)


def parse(spark, htmls, source="plain"):
    """Outcome of each page, in order."""
    pages = spark.createDataFrame([(str(i), source, h) for i, h in enumerate(htmls)], "url string, source string, html string")
    return sorted(extract.parse_pages(pages, ["by_category"]).collect(), key=lambda r: int(r.url))


def field(spark, name, out, values, source="plain"):
    """The value read from a page for each raw JSON value of a field."""
    pages = [LD.format(json.dumps({"@type": "Recipe", "name": "x", **v})) for v in values]
    return [r[out] for r in parse(spark, pages, source)] if name is None else None


def each(spark, name, out, values, source="plain"):
    return field(spark, None, out, [{} if v is KeyError else {name: v} for v in values], source)


def test_block_pick(spark):
    good = '{"@type":"Recipe","name":"%s"}'
    cases = [
        (LD.format(good % "object"), "object"),
        (LD.format('[{"@type":"Organization","name":"o"},' + good % "list" + "]"), "list"),
        (LD.format('{"@graph":[{"@type":"WebPage","name":"w"},' + good % "graph" + "]}"), "graph"),
        (LD.format("{broken") + LD.format(good % "second"), "second"),
        (LD.format("") + LD.format("[]") + LD.format(good % "after empty"), "after empty"),
        (LD.format(good % "one") + LD.format(good % "two"), "one"),
        (LD.format('{"@type":["Recipe"],"name":"no"}'), None),
        (LD.format('[{"@graph":[' + good % "no" + "]}]"), None),
        (LD.format('{"@graph":{"@type":"Recipe","name":"no"}}'), None),
        (LD.format('{"@graph":null,"name":"no"}'), None),
        (LD.format(good % "no" + " trailing"), None),
        (LD.format(good % "no" + "," + good % "no"), None),
        (LD.format('{"@type":"Recipe","name":"no\nbreak"}'), None),
        (LD.format('{"@type":"Recipe","name":"a","name":"last"}'), "last"),
        ("<p>nothing</p>", None),
        ("", None),
        (None, None),
        ("<!-- " + LD.format(good % "no") + " -->", None),
        ("<!-- a --><!-- b -- c -->" + LD.format(good % "after comments"), "after comments"),
        ("<script>var s = '<!--';</script>" + LD.format(good % "after script"), "after script"),
        ("<style>a<!--b</style>" + LD.format(good % "after style"), "after style"),
        ("<script type='application/ld+json'>" + good % "single" + "</script>", "single"),
        ("<script type=application/ld+json>" + good % "bare" + "</script>", "bare"),
        ('<SCRIPT data-x="a>b" async TYPE = "application/ld+json" id=1 x="/">' + good % "attributes" + "</SCRIPT>", "attributes"),
        ('<script data-type="application/ld+json">' + good % "no" + "</script>", None),
        ("<script data-x=\" type='application/ld+json' \">" + good % "no" + "</script>", None),
        ('<script type="application/LD+json">' + good % "no" + "</script>", None),
        ('<script type="application/ld+json" />' + good % "slash" + "</script>", "slash"),
        (LD.format(good % "a < b <!-- c --> d"), "a < b <!-- c --> d"),
        (LD.format(" " * 2_000_000 + '{"x":"' + "<z" * 1_000_000 + '","@type":"Recipe","name":"long"}'), "long"),
        ("<script data-x=it's type='application/ld+json'>" + good % "stray quote" + "</script>", "stray quote"),
        ("<script src=/a/b.js type='application/ld+json'>" + good % "bare path" + "</script>", "bare path"),
        ("<scripty type='application/ld+json'>" + good % "no" + "</scripty>", None),
        ("<script " + "a " * 200_000 + 'type="application/ld+json">' + good % "many" + "</script>", "many"),
    ]
    got = parse(spark, [c[0] for c in cases])
    assert [(i, r.title) for i, r in enumerate(got)] == [(i, c[1]) for i, c in enumerate(cases)]


def test_title_and_outcome(spark):
    pages = [LD.format(json.dumps({"@type": "Recipe", "name": n})) for n in (" A ", "", "  ", None, 3, "x" * 255, "x" * 256)]
    got = parse(spark, pages)
    assert [r.outcome for r in got] == ["success", "skipped", "skipped", "skipped", "skipped", "success", "failed"]
    assert got[0].title == "A" and got[-1].error_message == "title longer than 255"
    faults = each(
        spark, "recipeIngredient", "error_message", [["y" * 256], ["y"]]
    ) + each(spark, "totalTime", "error_message", ["PT99999999H", "PT1H"])
    assert faults == ["raw_name longer than 255", None, "total_time out of range", None]


def test_durations(spark):
    cases = {
        "PT30M": 30, "PT1H": 60, "PT1H30M": 90, "PT2H15M": 135, "PT0M": 0, None: None, "": None, "30 minutes": None,
        "P0D": None, "PT90S": None, "P1DT2H": 120, "P2M": 2, "PT1.5H": 300, "PT1H30": 60, "PTHM": None, "pt30m": None,
        "PT0H5M": 5,
    }
    assert each(spark, "prepTime", "prep_time", list(cases)) == list(cases.values())
    assert each(spark, "cookTime", "cook_time", [30, ["PT1H"], KeyError]) == [None, None, None]


def test_servings(spark):
    values = ["4", "4 servings", "Serves 6", ["4 servings"], "Makes 12", None, [], 0, 8, "0", [0, "4"], ["", "4"], 4.0, 0.0, False, "none", [5]]
    want = [4, 4, 6, 4, 12, None, None, None, 8, 0, None, None, 4, None, None, None, 5]
    assert each(spark, "recipeYield", "servings", values) == want


def test_images(spark):
    values = ["a", {"url": "u"}, ["a", "b"], [{"url": "u"}], [["n"]], None, [], "", [""], {}, 5, {"url": ""}]
    want = ["a", "u", "a", "u", "n", None, None, None, None, None, None, ""]
    assert each(spark, "image", "image_url", values) == want


def test_cuisine_plain(spark):
    values = ["Italian", ["Italian", "Mediterranean"], "italian", None, "", [], " tex-mex ", "o'neil", 5, [5], "crème FRAÎCHE 3x"]
    want = ["Italian", "Italian", "Italian", None, None, None, "Tex-Mex", "O'Neil", None, None, "Crème Fraîche 3X"]
    assert each(spark, "recipeCuisine", "cuisine", values) == want
    assert field(spark, None, "cuisine", [{"recipeCategory": "Dinner"}]) == [None]


def test_cuisine_from_category(spark):
    cases = [
        ({"recipeCategory": "Dinner Recipes"}, "Dinner"),
        ({"recipeCategory": "Asian Inspired Recipes"}, "Asian"),
        ({"recipeCategory": ["Meal Prep", "x"]}, "Prep"),
        ({"recipeCategory": "Main Dishes"}, None),
        ({"recipeCategory": "Slow  cooking FOOD stew"}, "Slow    Stew"),
        ({"recipeCuisine": "Thai", "recipeCategory": "Dinner"}, "Thai"),
        ({"recipeCuisine": "  ", "recipeCategory": "Dinner"}, "Dinner"),
        ({"recipeCuisine": [], "recipeCategory": "Dinner"}, "Dinner"),
        ({"recipeCategory": "Seafood"}, "Seafood"),
        ({"recipeCategory": 5}, None),
        ({}, None),
    ]
    assert field(spark, None, "cuisine", [c[0] for c in cases], "by_category") == [c[1] for c in cases]


def test_description(spark):
    values = ["<p>Hi <b>you</b></p>", "<br>", "", None, " a ", 0, "a < b", "null", "0"]
    assert each(spark, "description", "description", values) == ["Hi you", None, None, None, "a", None, "a < b", "null", "0"]


def test_ingredients(spark):
    values = [[" 1 egg ", "", None, "  ", 0, 2, "0", "null", "[]"], "flour", None, KeyError, []]
    want = [["1 egg", "", "2", "0", "null", "[]"], [], [], [], []]
    assert each(spark, "recipeIngredient", "ingredients", values) == want


def test_hostile_texts_are_read_in_linear_time(spark):
    """Openings that never close, a megabyte each. A pattern that tries each of them to the end takes hours."""
    ld, good = "application/ld+json", LD.format('{"@type":"Recipe","name":"good"}')
    openings = ["<script ", "<!-- ", "<!--", "<style ", "<script a='", '<script a="', "<script type=", "<script>", "<", "-", "<a "]
    htmls = [good + o * (1_000_000 // len(o)) + ld for o in openings]
    assert [r.title for r in parse(spark, htmls)] == ["good"] * len(htmls)
    texts = ["<" * 1_000_000, "<a" * 500_000, "<" * 1_000_000 + ">x", "a <b> c <d"]
    got = each(spark, "description", "description", texts)
    assert got == [texts[0], texts[1], "x", "a  c <d"]
    xml = "<loc>" * 200_000 + "https://s.org/recipes/1</loc>" + "<!--" * 100_000
    maps = spark.createDataFrame([("a", 0, "1-recipe.xml", xml)], "source string, sitemap_pos int, sitemap_url string, xml string")
    assert [r.url for r in discover.discover_urls(maps, RECIPE_SITEMAPS).collect()] == ["https://s.org/recipes/1"]


def test_strip_is_linear_on_long_blank_runs(spark):
    frame = spark.createDataFrame([("a" + " " * 200_000 + "b\t\n",)], "t string")
    assert frame.select(F.length(text.strip(F.col("t")))).first()[0] == 200_002


def test_time_label_and_page_range(spark):
    rows = spark.createDataFrame([(30, 10, 20), (0, 10, 20), (None, 0, 20), (None, None, None), (0, 0, 0)], "t int, p int, c int")
    got = [r[0] for r in rows.select(labels.time_label(F.col("t"), F.col("p"), F.col("c"))).collect()]
    assert got == ["30 min", "10 min prep", "20 min cook", None, None]
    total, page, size = F.col("total"), F.lit(3), F.lit(20)
    pages = spark.createDataFrame([(0,), (41,), (60,), (45,)], "total long").select(
        labels.page_count(total, size), labels.page_from(total, page, size), labels.page_to(total, page, size)
    )
    assert [tuple(r) for r in pages.collect()] == [(0, 0, 0), (3, 41, 41), (3, 41, 60), (3, 41, 45)]


def sitemap(*entries):
    return '<?xml version="1.0"?><urlset xmlns="x">' + "".join(f"<url>{e}</url>" for e in entries) + "</urlset>"


def test_discovery(spark):
    site = "https://s.org"
    rows = [
        ("a", 0, f"{site}/articles.xml", sitemap(f"<loc>{site}/recipes/no</loc>")),
        ("a", 1, f"{site}/1-recipe.xml", sitemap(
            f"<loc> {site}/recipes/1 </loc>", f"<loc>{site}/premium/recipes/2</loc>", f"<loc>{site}/about</loc>",
            f"<loc>{site}/recipes/1</loc>", f"<loc><![CDATA[{site}/recipes/c?a=1&b=2]]></loc>", f"<!-- <loc>{site}/recipes/no</loc> -->",
        )),
        ("a", 2, f"{site}/2-recipe.xml", None),
        ("a", 3, f"{site}/3-recipe.xml", sitemap(f"<loc>{site}/recipes/late</loc>")),
        ("b", 0, f"{site}/post.xml", sitemap(
            f"<loc>{site}/p1?x=1&amp;y=2</loc><image:image><image:loc>{site}/img.jpg</image:loc></image:image>",
            f"<loc>{site}/wp-content/i.jpg</loc>",
        ) + "<broken"),
        ("b", 1, f"{site}/post2.xml", sitemap(f"<loc>{site}/p1?x=1&amp;y=2</loc>", f"<loc>{site}/p2</loc>")),
    ]
    maps = spark.createDataFrame(rows, "source string, sitemap_pos int, sitemap_url string, xml string")
    found = discover.discover_urls(maps.where("source = 'a'"), RECIPE_SITEMAPS).orderBy("sitemap_pos", "pos").collect()
    assert [r.url for r in found] == [f"{site}/recipes/1", f"{site}/recipes/c?a=1&b=2"]
    posts = discover.discover_urls(maps.where("source = 'b'"), POST_SITEMAPS).orderBy("sitemap_pos", "pos").collect()
    assert [(r.sitemap_pos, r.url) for r in posts] == [(0, f"{site}/p1?x=1&y=2"), (1, f"{site}/p2")]
    one = discover.discover_urls(maps.where("source = 'b'"), discover.DiscoveryRule(1, url_excludes="wp-content"))
    assert [r.url for r in one.collect()] == [f"{site}/p1?x=1&y=2"]


def test_accepted_forms(spark):
    forms = {
        "coded": ('<script type="application/ld&#x2B;json">{"@type":"Recipe","name":"A","image":[[["http://i"]]]}</script>', "A", "http://i"),
        "named": ("<script type='application/ld&plus;json'>{\"@type\":\"Recipe\",\"name\":\"B\"}</script>", "B", None),
        "numbers": (
            '<script type="application/ld+json">{"@type":"Recipe","name":"C NaN, -Infinity","x":[NaN,-Infinity,"y\\"NaN"],"image":[[{"url":"u"},2],3]}</script>',
            "C NaN, -Infinity", "u",
        ),
        "empty": ('<script type="application/ld+json">{"@type":"Recipe","name":"D","image":[[],"x"]}</script>', "D", None),
    }
    pages = spark.createDataFrame([(k, "1", v[0], 1) for k, v in forms.items()], "url string, source string, html string, arrival long")
    for r in extract.parse_pages(pages, []).collect():
        assert (r.title, r.image_url) == forms[r.url][1:]


def test_sitemap_references_are_decoded_once(spark):
    locs = {
        "a&#038;b&#x26;c": "a&b&c", "&amp;#38;": "&#38;", "&#38;lt;": "&lt;", "<![CDATA[x?a=1&amp;b]]>": "x?a=1&amp;b",
        "p&#128512;&#0;&bogus;": "p😀&#0;&bogus;",
    }
    xml = "<urlset>" + "".join(f"<loc>{loc}</loc>" for loc in locs) + "</urlset>"
    rows = [("s", n, "u", xml if n == 3 else "") for n in range(4)]
    maps = spark.createDataFrame(rows, "source string, sitemap_pos int, sitemap_url string, xml string")
    found = discover.discover_urls(maps, discover.DiscoveryRule(max_sitemaps=None)).collect()
    assert {r.url for r in found} == set(locs.values())
