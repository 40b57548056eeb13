import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from larderlens import lexicon
from larderlens.functions import text
from larderlens.operators import matching, rollup
from larderlens.sources import seeds

ROOT = Path(__file__).parent.parent

NORMALISED = {
    "200g dried spaghetti": "spaghetti",
    "2 large free-range eggs": "eggs",
    "1/2 tsp fine sea salt": "sea salt",
    "4 Roma tomatoes ($1.35)": "roma tomatoes",
    "2 cups flour ($0.45)": "flour",
    "100ml double cream": "double cream",
    "a pinch of salt": "of salt",
    "A an some egg": "egg",
    "an a egg": "a egg",
    "2 jars honey": "honey",
    "2 tins tuna": "tins tuna",
    "2 tablespoons oil": "tablespoons oil",
    "3 x 400g cans tomatoes": "x 400g cans tomatoes",
    "½ cup cream": "½ cream",
    "2-3 eggs": "-3 eggs",
    "1 can": "1 can",
    "200g": "200g",
    "  Free Range   EGGS\t": "eggs",
    "butter, room temperature": "butter,",
    "ground  beef": "beef",
    "($1.35) 4 tomatoes": "4 tomatoes",
    "fresh": "fresh",
    "": "",
    "   ": "",
    "glass noodles": "glass noodles",
    "flagrant": "flagrant",
    "crème fraîche": "crème fraîche",
}

# name -> allergens
ALLERGENS = {
    "peanut": "peanuts", "groundnut oil": "peanuts tree_nuts", "monkey nuts": "peanuts", "arachis oil": "peanuts",
    "satay sauce": "peanuts", "almonds": "tree_nuts", "ground almonds": "tree_nuts", "pine nuts": "tree_nuts",
    "coconut milk": "tree_nuts", "walnut oil": "tree_nuts", "hazelnut butter": "tree_nuts", "nut butter": "tree_nuts",
    "double cream": "dairy", "crème fraîche": "dairy", "gruyère": "dairy", "ghee": "dairy", "half and half": "dairy",
    "parmesan": "dairy", "butternut squash": "dairy", "eggs": "egg", "mayonnaise": "egg", "hollandaise sauce": "egg",
    "fresh pasta": "egg", "egg noodles": "egg", "meringue": "egg", "chicken": "", "olive oil": "", "eggplant": "",
    "egg fruit": "", "water chestnuts": "", "nutmeg": "", "doughnuts": "", "almond milk": "tree_nuts", "oat milk": "",
    "cocoa butter": "", "shea butter": "", "peanut butter": "peanuts", "peanuts and almonds": "peanuts",
    "cream and eggs": "dairy egg", "Double CREAM": "dairy", "coconut cream": "tree_nuts",
}

# ingredients of a recipe -> tags
TAGS = [
    ([], "vegetarian vegan gluten_free"),
    (["tofu", "rice"], "vegetarian vegan gluten_free"),
    (["chicken", "rice"], "gluten_free"),
    (["anchovies"], "gluten_free"),
    (["gelatine"], "gluten_free"),
    (["eggs", "rice"], "vegetarian gluten_free"),
    (["honey"], "vegetarian gluten_free"),
    (["feta"], "vegetarian vegan gluten_free"),
    (["coconut milk"], "vegetarian vegan gluten_free"),
    (["chicken in coconut milk"], "vegetarian vegan gluten_free"),
    (["plain flour"], "vegetarian vegan"),
    (["rice flour"], "vegetarian vegan gluten_free"),
    (["rice flour", "plain flour"], "vegetarian vegan"),
    (["corn tortillas"], "vegetarian vegan gluten_free"),
    (["soy sauce"], "vegetarian vegan"),
    (["tamari"], "vegetarian vegan gluten_free"),
    (["kale"], "vegetarian vegan"),
    (["mayonnaise"], "vegetarian gluten_free contains_raw_egg"),
    (["caesar dressing"], "vegetarian vegan gluten_free contains_raw_egg"),
    (["coconut cream mayonnaise"], "vegetarian vegan gluten_free contains_raw_egg"),
    (["egg yolks", "bacon", "spaghetti"], "contains_raw_egg"),
]


def golden():
    pattern = r"\| (\d+) \| (.*?) \| (.*?) \| (.*?) \| `(.{5})` \|"
    rows = [m.groups() for line in (ROOT / "FIXTURES.md").read_text().splitlines() if (m := re.match(pattern, line))]
    return [(raw, norm, "" if al == "—" else " ".join(al.split(", ")), flags) for _, raw, norm, al, flags in rows]


def names_of(mask, categories):
    return " ".join(c.name for c in categories if mask & lexicon.bit(c.name))


def test_normalise(spark):
    rows = spark.createDataFrame(list(NORMALISED.items()), "raw string, want string")
    got = rows.select("raw", "want", text.normalise_ingredient(F.col("raw")).alias("got")).collect()
    assert [(r.raw, r.got) for r in got] == [(r.raw, r.want) for r in got]


def test_normalise_equals_one_rule_after_the_other(spark):
    """Random lines of words, amounts and separators against the steps as nested SQL in another engine."""
    import random

    import duckdb

    from larderlens.plans import oracle

    random.seed(11)
    words = lexicon.UNIT_WORDS + lexicon.ADJECTIVE_WORDS + ("a", "an", "some", "room", "free", "range", "egg", "Ham", "2", "1/2", "3.5", "($1.20)")
    marks = (" ", "  ", "-", ", ", "", "\t", "/", ".", " x")
    lines = ["".join(random.choice(words) + random.choice(marks) for _ in range(random.randint(1, 6))) for _ in range(5000)]
    lines = list(dict.fromkeys(line.replace("\t", " ") if random.random() < 0.9 else line.strip() for line in lines))
    frame = spark.createDataFrame([(line,) for line in lines], "raw string")
    got = {r.raw: r.name for r in frame.select("raw", text.normalise_ingredient(F.col("raw")).alias("name")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(raw VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [(line,) for line in lines])
    want = dict(con.execute(f"SELECT raw, {oracle._normalised('raw')} FROM t").fetchall())
    differing = {k: (got[k], want[k]) for k in want if got[k] != want[k]}
    assert not differing, list(differing.items())[:5]


def test_strip_takes_every_blank(spark):
    blanks = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
    frame = spark.createDataFrame([(blanks + "a b" + blanks,), (blanks,), ("\u200b",)], "t string")
    assert [r[0] for r in frame.select(text.strip(F.col("t"))).collect()] == ["a b", "", "\u200b"]


def test_golden_table(spark):
    rows = golden()
    assert len(rows) == 60
    frame = spark.createDataFrame([(r[0],) for r in rows], "raw string")
    got = {r.raw: r for r in matching.flag_names(frame).collect()}
    for raw, norm, allergens, flags in rows:
        assert got[raw].normalised == norm
        assert names_of(got[raw].mask, lexicon.ALLERGENS) == allergens
        shown = "".join(
            letter if got[raw].mask & lexicon.bit(name) else "-"
            for letter, name in zip("MVGRr", ("meat", "non_vegan", "gluten", "raw_egg", "raw_egg_any"))
        )
        assert (raw, shown) == (raw, flags)


@pytest.mark.parametrize("scan", [False, True])
def test_allergens(spark, scan):
    mask = matching.scan_mask if scan else matching.category_mask
    frame = spark.createDataFrame(list(ALLERGENS.items()), "name string, want string")
    got = frame.withColumn("folded", text.fold(F.col("name"))).select("name", "want", mask("folded").alias("mask"))
    for r in got.collect():
        assert (r.name, names_of(r.mask, lexicon.ALLERGENS)) == (r.name, r.want)


def test_scan_equals_expression_on_long_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.lower("text").alias("t"))
    both = docs.select("doc_id", matching.scan_mask("t").alias("a"), matching.category_mask("t").alias("b")).collect()
    assert any(r.a for r in both)
    assert all(r.a == r.b for r in both)


def test_scan_null_and_empty(spark):
    frame = spark.createDataFrame([(None,), ("",), ("milk " * 5000 + "egg",)], "t string")
    masks = [r[0] for r in frame.select(matching.scan_mask("t")).collect()]
    assert masks[:2] == [0, 0]
    assert names_of(masks[2], lexicon.ALLERGENS) == "dairy egg"


def test_mask_equals_plain_rule(spark):
    """Random mixes of words, exceptions and filler against the rule written as plain loops."""
    import random

    random.seed(7)
    pool = [w for c in lexicon.CATEGORIES for w in c.keywords + c.exceptions] + ["red", "x", "of", "-", ","]
    names = list({" ".join(random.choices(pool, k=random.randint(1, 4))) for _ in range(3000)})
    got = spark.createDataFrame([(n,) for n in names], "t string").select("t", matching.category_mask("t")).collect()
    for name, mask in got:
        for c in lexicon.CATEGORIES:
            want = any(w in name for w in c.keywords) and not any(w in name for w in c.exceptions)
            assert bool(mask & lexicon.bit(c.name)) == want, (name, c.name)


def test_tags(spark):
    lines = [(i, name) for i, (names, _) in enumerate(TAGS) for name in names]
    flagged = matching.flag_lines(spark.createDataFrame(lines, "recipe_id long, raw string"))
    recipes = spark.range(len(TAGS)).withColumnRenamed("id", "recipe_id")
    masks = rollup.mask_recipes(recipes, rollup.recipe_masks(flagged))
    links = rollup.dietary_tag_links(masks, seeds.dietary_tags(spark)).collect()
    for i, (names, want) in enumerate(TAGS):
        assert (names, {r.name for r in links if r.recipe_id == i}) == (names, set(want.split()))


def test_unknown_dimension_rows_are_dropped(spark):
    lines = spark.createDataFrame([(1, "milk"), (1, "eggs")], "recipe_id long, raw string")
    masks = rollup.recipe_masks(matching.flag_lines(lines))
    some = seeds.allergens(spark).where("name <> 'egg'")
    assert [r.name for r in rollup.allergen_links(masks, some).collect()] == ["dairy"]


def test_lines_are_flagged_where_they_stand(spark):
    rows = [(i, i, "2 eggs" if i % 3 == 0 else f"{i} g milk no {i % 50}") for i in range(90)]
    flagged = matching.flag_lines(spark.createDataFrame([*rows, (1000, 0, None)], "recipe_id long, pos int, raw string"))
    assert "Exchange" not in flagged._jdf.queryExecution().executedPlan().toString()
    assert flagged.count() == 91 and flagged.where("raw IS NULL AND mask <> 0").isEmpty()


def test_dictionary_minimal_forms():
    assert lexicon.minimal(("egg", "eggs", "egg yolk", "mayo", "mayonnaise", "mayo")) == ("egg", "mayo")
    assert len(lexicon.minimal(lexicon.MEAT_WORDS)) == 60
    assert len(lexicon.minimal(lexicon.DAIRY_WORDS)) == 28
    assert len(lexicon.minimal(lexicon.GLUTEN_WORDS)) == 38
