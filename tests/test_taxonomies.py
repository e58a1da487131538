"""Taxonomies from documents and from edges."""

import random

import pytest

from stemmata.operators import taxonomies
from stemmata.plans.synthetic import NS
from stemmata.sources import corpus

DEFAULTS = {"prose": "prose-a", "verse": "verse-a"}


def odd(inner):
    return f'<TEI {NS}><taxonomy xml:id="t"><category xml:id="outside"/></taxonomy><taxonomy xml:id="g"><desc>x</desc>{inner}</taxonomy></TEI>'


def cat(name, *inner, desc=""):
    return f'<category xml:id="{name}">{f"<catDesc>{desc}</catDesc>" if desc else ""}{"".join(inner)}</category>'


TREE = cat("prose", cat("prose-mid", cat("prose-a", desc=" one <hi>two</hi>\n three "), cat("prose-b"), desc="inner"), cat("prose-c")) + cat("verse", cat("verse-a")) + cat("other", cat("other-a"))


def rows(df):
    return sorted(tuple(x) for x in df.collect())


def test_categories_of_any_depth(spark):
    docs = spark.createDataFrame([("a", odd(TREE)), ("b", odd(cat("x"))), ("c", "<TEI")], "path string, xml string")
    found = taxonomies.categories(docs, "g")
    assert rows(found.drop("node_id")) == [
        ("a", "other", 1, "other", False, ""), ("a", "other-a", 2, "other", True, ""), ("a", "prose", 1, "prose", False, ""), ("a", "prose-a", 3, "prose", True, "one two three"), ("a", "prose-b", 3, "prose", True, ""),
        ("a", "prose-c", 2, "prose", True, ""), ("a", "prose-mid", 2, "prose", False, "inner"), ("a", "verse", 1, "verse", False, ""), ("a", "verse-a", 2, "verse", True, ""), ("b", "x", 1, "x", True, ""),
    ]
    assert taxonomies.categories(docs, "none").count() == 0


def test_families_and_faults(spark):
    read = lambda x: taxonomies.checked(taxonomies.categories(spark.createDataFrame([("a", odd(x))], "path string, xml string"), "g"), DEFAULTS)
    assert rows(read(TREE).select("target", "kind", "family", "default_subclass")) == [
        ("prose", "family", "prose", "prose-a"), ("prose-a", "subclass", "prose", "prose-a"), ("prose-b", "subclass", "prose", "prose-a"), ("prose-c", "subclass", "prose", "prose-a"),
        ("verse", "family", "verse", "verse-a"), ("verse-a", "subclass", "verse", "verse-a"),
    ]
    with pytest.raises(ValueError, match="verse-a of verse"):
        read(TREE.replace("verse-a", "verse-z"))
    with pytest.raises(ValueError, match="twice: prose-b"):
        read(TREE.replace("prose-c", "prose-b"))
    with pytest.raises(ValueError, match="prose-a of prose"):  # a default must be a leaf
        read(TREE.replace('<category xml:id="prose-a">', '<category xml:id="prose-a"><category xml:id="deeper"/>'))
    with pytest.raises(ValueError, match="no taxonomy"):
        corpus.read_taxonomy(spark, odd(TREE), "none")


def test_edges(spark):
    frame = lambda edges: spark.createDataFrame([(i, p, None) for i, p in edges], "id string, parent string, description string")
    r = random.Random(3)
    parent = {"r0": None, "r1": None} | {f"n{k}": r.choice(["r0", "r1", *[f"n{j}" for j in range(max(0, k - 4), k)]]) for k in range(60)}
    want = []
    for i in parent:
        up, depth = i, 0
        while parent[up] is not None:
            up, depth = parent[up], depth + 1
        want.append((i, up, depth))
    assert rows(taxonomies.closure(frame(parent.items()))) == sorted(want) and max(d for *_, d in want) > 5
    edges = [("prose", None), ("m", "prose"), ("prose-a", "m"), ("prose-b", "m"), ("verse", None), ("verse-a", "verse")]
    got = rows(taxonomies.of_edges(frame(edges), DEFAULTS).select("target", "kind", "family"))
    assert got == [("prose", "family", "prose"), ("prose-a", "subclass", "prose"), ("prose-b", "subclass", "prose"), ("verse", "family", "verse"), ("verse-a", "subclass", "verse")]
    for wrong, said in (([("a", "b"), ("b", "c"), ("c", "a"), ("d", None)], "a cycle above: a, b, c"), ([("a", "a")], "a cycle above: a"), ([("a", None), ("a", None)], "twice: a"), ([("a", "x")], "no id: x")):
        with pytest.raises(ValueError, match=said):
            taxonomies.closure(frame(wrong))
    assert taxonomies.closure(frame([]).limit(0)).count() == 0


def test_categories_come_from_one_pass(spark):
    """Random nestings, against their trees; categories and families are made where documents are parsed, and none of them moves."""
    r = random.Random(5)

    def grown(names, depth=0):
        made = []
        for _ in range(r.randint(0 if depth else 1, 3)):
            name = f"c{r.randint(0, 9)}"
            names.append(name)
            kids = grown(names, depth + 1) if depth < 4 else []
            made.append((name, r.choice(["", "b", "é", "\N{NO-BREAK SPACE}a  z "]), r.random() < 0.2, kids))
        return made

    def written(tree):
        return "".join(f'<category xml:id="{name}"><!-- x -->{f"<catDesc>{said[:1]}<hi>{said[1:]}</hi></catDesc><catDesc>zz</catDesc>" if said else ""}{f"<gloss>{written(kids)}</gloss>" if apart else written(kids)}</category>' for name, said, apart, kids in tree)

    def walked(path, tree, depth=1, family=None):
        for name, said, apart, kids in tree:
            yield path, name, depth, family or name, not kids or apart, " ".join(said.split())
            yield from walked(path, kids, depth + 1, family or name)

    trees = {f"p{k}": grown([]) for k in range(30)}
    docs = spark.createDataFrame([(path, odd(written(tree))) for path, tree in trees.items()] + [("broken", "<TEI"), ("null", None)], "path string, xml string")
    want = [x for path, tree in trees.items() for x in walked(path, tree)]
    found, summed = taxonomies.categories(docs, "g"), taxonomies.families(docs, "g")
    assert rows(found.drop("node_id")) == sorted(want) and found.select("path", "node_id").distinct().count() == len(want)
    each = {}
    for path, _, depth, family, leaf, said in want:
        if depth > 1:
            each.setdefault((path, family), []).append((depth, leaf, said))
    expected = [(path, family, max(d for d, _, _ in x), sum(leaf for _, leaf, _ in x), sum(d for d, _, _ in x), max(said for _, leaf, said in x if leaf)) for (path, family), x in each.items()]
    assert rows(summed) == sorted(expected)
    for df in (found, summed):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
