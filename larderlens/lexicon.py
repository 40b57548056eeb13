"""Keyword dictionaries, as data, and the category rules built from them."""

from __future__ import annotations

from dataclasses import dataclass


def _words(text: str) -> tuple[str, ...]:
    return tuple(w for w in (part.strip() for part in text.replace("\n", ",").split(",")) if w)


# The results depend on these exact words.

PEANUT_WORDS = _words("peanut, groundnut, monkey nut, arachis, satay, peanut butter, peanut oil")

TREE_NUT_WORDS = _words("""
    almond, cashew, walnut, pecan, pistachio, hazelnut, macadamia, brazil nut, pine nut, chestnut, coconut,
    praline, marzipan, frangipane, nougat, nut oil, nut butter
""")

DAIRY_WORDS = _words("""
    milk, cream, butter, cheese, yoghurt, yogurt, creme fraiche, crème fraîche, sour cream, whipping cream,
    double cream, single cream, clotted cream, half and half, ghee, buttermilk, condensed milk, evaporated milk,
    skimmed milk, whole milk, full fat milk, milk powder, whey, casein, lactose, mascarpone, ricotta, mozzarella,
    parmesan, parmigiano, pecorino, brie, camembert, cheddar, gruyere, gruyère, feta, halloumi, quark, fromage frais
""")

EGG_WORDS = _words("""
    egg, eggs, egg yolk, egg white, egg wash, beaten egg, whole egg, free range egg, mayonnaise, mayo, hollandaise,
    aioli, meringue, albumen, egg noodle, egg pasta, fresh pasta
""")

DAIRY_EXCEPTIONS = _words("""
    coconut milk, almond milk, oat milk, soy milk, rice milk, oat cream, coconut cream, coconut butter,
    peanut butter, nut butter, cocoa butter, shea butter
""")

EGG_EXCEPTIONS = _words("eggplant, egg fruit")

TREE_NUT_EXCEPTIONS = _words("water chestnut, nutmeg, doughnut, donut, peanut")

MEAT_WORDS = _words("""
    beef, chicken, pork, lamb, turkey, duck, veal, venison, rabbit, bacon, ham, sausage, salami, chorizo, prosciutto,
    pancetta, lard, mince, minced, steak, brisket, rib, ribs, shank, tenderloin, chicken breast, chicken thigh,
    chicken leg, chicken wing, ground beef, ground pork, ground turkey, ground lamb, pepperoni, mortadella, bresaola,
    coppa, nduja, bone broth, beef stock, chicken stock, meat stock, gelatin, gelatine, suet, anchovies, anchovy,
    worcestershire sauce, fish sauce, oyster sauce, shrimp, prawn, crab, lobster, scallop, clam, mussel, squid,
    octopus, salmon, tuna, cod, haddock, mackerel, sardine, sea bass, sea bream, trout, halibut, monkfish, plaice,
    sole, tilapia
""")

NON_VEGAN_WORDS = _words("""
    milk, cream, butter, cheese, yoghurt, yogurt, egg, eggs, honey, beeswax, whey, casein, lactose, ghee, mayonnaise,
    mayo, hollandaise, aioli, meringue, albumen, gelatin, gelatine, royal icing, lard, suet, anchovy, anchovies,
    worcestershire sauce, fish sauce, oyster sauce
""")

GLUTEN_WORDS = _words("""
    flour, wheat, bread, breadcrumb, breadcrumbs, pasta, spaghetti, linguine, penne, fettuccine, tagliatelle, lasagne,
    lasagna, noodle, barley, rye, spelt, semolina, couscous, bulgur, farro, seitan, soy sauce, teriyaki sauce,
    hoisin sauce, malt, malt vinegar, beer, ale, stout, puff pastry, shortcrust pastry, filo pastry, phyllo pastry,
    pie crust, crouton, croutons, panko, biscuit, cookie, cake, tortilla
""")

GLUTEN_EXCEPTIONS = _words("""
    rice flour, almond flour, coconut flour, chickpea flour, gram flour, buckwheat flour, tapioca flour,
    cassava flour, corn tortilla, rice noodle, glass noodle, vermicelli, tamari, gluten-free soy sauce,
    gluten free soy sauce, rice pasta, gluten-free pasta, gluten free pasta, gluten-free bread, gluten free bread,
    gluten-free flour, gluten free flour
""")

RAW_EGG_WORDS = _words("mayonnaise, mayo, hollandaise, aioli, caesar dressing, raw egg, egg yolk")

VEGAN_EXCEPTIONS = _words("""
    coconut milk, coconut cream, coconut butter, almond milk, oat milk, soy milk, rice milk, oat cream, cocoa butter
""")

UNIT_WORDS = _words("""
    tbsp, tsp, tablespoon, teaspoon, cup, cups, ml, l, litre, liter, g, kg, oz, lb, pound, handful, pinch, sprig,
    bunch, slice, slices, piece, pieces, clove, cloves, rasher, rashers, fillet, fillets, sheet, sheets, can, tin,
    jar, jars
""")

ADJECTIVE_WORDS = _words("""
    large, small, medium, big, fresh, frozen, dried, smoked, fine, coarse, ground, whole, organic, free-range,
    free range, roughly, finely, thinly, thickly, chopped, sliced, diced, grated, peeled, pitted, deseeded, trimmed,
    rinsed, drained, toasted, roasted, softened, melted, cooled, warmed, boneless, skinless, room temperature
""")

CATEGORY_NOISE = r"recipes?|dishes?|mains?|meals?|food|cooking|inspired"

# End of fixed values.


@dataclass(frozen=True)
class Category:
    """A name fires when it holds a keyword, unless it holds an exception."""

    name: str
    keywords: tuple[str, ...]
    exceptions: tuple[str, ...] = ()


ALLERGENS = (
    Category("peanuts", PEANUT_WORDS),
    Category("tree_nuts", TREE_NUT_WORDS, TREE_NUT_EXCEPTIONS),
    Category("dairy", DAIRY_WORDS, DAIRY_EXCEPTIONS),
    Category("egg", EGG_WORDS, EGG_EXCEPTIONS),
)

DIET_FLAGS = (
    Category("meat", MEAT_WORDS, VEGAN_EXCEPTIONS),
    Category("non_vegan", NON_VEGAN_WORDS, VEGAN_EXCEPTIONS),
    Category("gluten", GLUTEN_WORDS, GLUTEN_EXCEPTIONS),
    Category("raw_egg", RAW_EGG_WORDS, VEGAN_EXCEPTIONS),
    Category("raw_egg_any", RAW_EGG_WORDS),
)

CATEGORIES = ALLERGENS + DIET_FLAGS


def bit(name: str, categories: tuple[Category, ...] = CATEGORIES) -> int:
    """The mask value of a category."""
    return 1 << [c.name for c in categories].index(name)


def minimal(words: tuple[str, ...]) -> tuple[str, ...]:
    """Drop words that contain another one: under substring matching they add nothing."""
    distinct = tuple(dict.fromkeys(words))
    return tuple(w for w in distinct if not any(o != w and o in w for o in distinct))


def dictionary_rows(categories: tuple[Category, ...] = CATEGORIES) -> list[tuple[str, str, str]]:
    """The dictionaries as (category, kind, keyword) rows."""
    return [
        (c.name, kind, word)
        for c in categories
        for kind, words in (("keyword", c.keywords), ("exception", c.exceptions))
        for word in minimal(words)
    ]
