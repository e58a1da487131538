"""Interval joins, counts along axes and Schematron files against brute force over trees; files in several encodings."""

import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from stemmata import catalogue
from stemmata.operators import axes, intervals, rewrite, schema_files, schematron
from stemmata.operators.shred import parse, shred
from stemmata.operators.tally import nested, tally
from stemmata.plans import commands
from stemmata.sources import corpus

TEI = "http://www.tei-c.org/ns/1.0"
NS = f'xmlns="{TEI}"'


def random_tree(r, n):
    """A document of about n elements named a to d, some numbered."""
    root = ET.Element(f"{{{TEI}}}TEI")
    open_ = [root]
    for _ in range(n):
        up = r.choice(open_[-6:])
        new = ET.SubElement(up, f"{{{TEI}}}{r.choice('abcd')}", {"n": r.choice("12")} if r.random() < 0.5 else {})
        open_.append(new)
    return root


@pytest.fixture(scope="module")
def trees(spark):
    r = random.Random(5)
    found = {f"d{i}": random_tree(r, n) for i, n in enumerate((0, 1, 5, 40, 300))}
    return found, spark.createDataFrame([(k, ET.tostring(t, encoding="unicode")) for k, t in found.items()], "path string, xml string")


def local(e):
    return e.tag.rpartition("}")[2]


def test_segments_cover_each_number_once(spark):
    r = random.Random(2)
    rows = [(a, a + n - 1) for a, n in [(1, 0), (1, 1), (5, 4096), (4096, 4096), (4095, 4098), (1, 70_000), *[(r.randint(1, 9000), r.randint(0, 9000)) for _ in range(60)]]]
    got = spark.createDataFrame(rows, "a long, b long").select("a", "b", intervals.segments(F.col("a"), F.col("b")).alias("s")).collect()
    for x in got:
        numbers = [k for s in x["s"] for k in range(s["number"] * 16 ** s["level"], (s["number"] + 1) * 16 ** s["level"])]
        assert sorted(numbers) == list(range(x["a"], x["b"] + 1))
        assert len(x["s"]) <= 2 * 16 * 3 + (x["b"] - x["a"]) // 4096


def test_containment_of_any_two_sets(spark, trees):
    found, docs = trees
    nodes = shred(docs, ("node_id", "end_id", "kind", "name", "attrs")).where("kind = 'element'")
    outer, inner = nodes.where(F.col("name").isin("a", "b") | F.col("attrs")["n"].isNotNull()), nodes.where(F.col("name") != "c")
    got = intervals.containment(outer.select("path", "node_id", "end_id", "name"), inner.select("path", "node_id", "name"))
    want = []
    for path, root in found.items():
        order = {e: i + 1 for i, e in enumerate(root.iter())}
        for e in root.iter():
            if local(e) in "ab" or e.get("n"):
                want += [(path, order[e], order[x]) for x in e.iter() if x is not e and local(x) != "c"]
    assert sorted((x["path"], x["outer"]["node_id"], x["inner"]["node_id"]) for x in got.collect()) == sorted(want)
    near = {(x["path"], x["node_id"]): x["outer"]["node_id"] for x in intervals.innermost(outer.select("path", "node_id", "end_id"), inner.select("path", "node_id")).collect()}
    assert near == {(p, i): max(o for q, o, j in want if (q, j) == (p, i)) for p, _, i in want}
    assert intervals.containment(outer.select("path", "node_id", "end_id").limit(0), inner.select("path", "node_id")).count() == 0


def test_containment_in_a_large_document(spark):
    """One document of 100,000 nodes among small ones: the result follows the pairs, and no key holds more than a segment."""
    n = 100_000
    nodes = spark.range(1, n + 1).select(F.lit("large").alias("path"), F.col("id").cast("int").alias("node_id"))
    # A root, and groups of ten: each a node and nine below it.
    outer = nodes.where("node_id % 10 = 2 or node_id = 1").withColumn("end_id", F.when(F.col("node_id") == 1, n).otherwise(F.least(F.col("node_id") + 9, F.lit(n))).cast("int"))
    found = intervals.containment(outer, nodes)
    assert found.groupBy(F.col("outer.node_id") == 1).count().collect() and found.count() == n - 1 + sum(min(9, n - i) for i in range(2, n + 1, 10))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    keys = outer.select(F.explode(intervals.segments(F.col("node_id") + 1, F.col("end_id"))).alias("s"))
    assert keys.where("s.level < 3").groupBy("s.level", "s.number").count().agg(F.max("count")).first()[0] <= 2
    assert keys.count() < 3 * 10 * (n // 10)


def test_siblings(spark, trees, monkeypatch):
    monkeypatch.setattr(intervals, "RUN", 3)
    found, docs = trees
    nodes = shred(docs, ("node_id", "parent_id", "kind", "name")).where("kind = 'element'")
    got = {(x["path"], x["node_id"]): (x["a_before"], x["a_after"]) for x in intervals.sibling_counts(nodes, {"a": F.col("name") == "a"}).collect()}
    want = {}
    for path, root in found.items():
        order = {e: i + 1 for i, e in enumerate(root.iter())}
        want[path, 1] = (0, 0)
        for up in root.iter():
            kids = list(up)
            for i, e in enumerate(kids):
                want[path, order[e]] = tuple(sum(local(x) == "a" for x in part) for part in (kids[:i], kids[i + 1 :]))
    assert got == want


def findings(spark, docs, rules, **kw):
    schema = schema_files.read_schema(f'<schema xmlns="{schema_files.SCH}"><ns prefix="t" uri="{TEI}"/>{rules}</schema>', **kw)
    return sorted((x["path"], x["check_id"], x["message"]) for x in schema_files.check_documents(docs, schema).collect())


def test_axes_against_trees(spark, trees):
    found, docs = trees
    rule = lambda check, test, at="t:a": f'<pattern><rule context="{at}"><report id="{check}" test="{test}">x</report></rule></pattern>'
    up = {e: p for root in found.values() for p in root.iter() for e in p}

    def above(e):
        while e in up:
            e = up[e]
            yield e

    named = lambda es, n: [e for e in es if n == "*" or local(e) == n]
    below = lambda e: [x for x in e.iter() if x is not e]
    beside = lambda e: list(up[e]) if e in up else [e]
    tests = {
        "count(t:b) = 1": lambda e, _: len(named(e, "b")) == 1,
        "count(t:b[@n]) &gt;= count(t:c)": lambda e, _: sum(1 for x in named(e, "b") if x.get("n")) >= len(named(e, "c")),
        ".//t:b": lambda e, _: bool(named(below(e), "b")),
        "count(.//t:b[@n='1']) &gt; 1": lambda e, _: sum(x.get("n") == "1" for x in named(below(e), "b")) > 1,
        "count(t:b//t:c) = 1": lambda e, _: len({x for b in named(e, "b") for x in named(below(b), "c")}) == 1,
        "count(.//t:b//t:c) = 2": lambda e, _: len({x for b in named(below(e), "b") for x in named(below(b), "c")}) == 2,
        "t:b/t:c/t:d": lambda e, _: any(named(c, "d") for b in named(e, "b") for c in named(b, "c")),
        "count(t:b/t:*)": None,
        "ancestor::t:b": lambda e, _: bool(named(above(e), "b")),
        "count(ancestor::*) = 3": lambda e, _: len(list(above(e))) == 3,
        "parent::t:b[@n]": lambda e, _: bool([p for p in [up[e]] if local(p) == "b" and p.get("n")]),
        "count(../t:c) = 1": lambda e, _: len(named(up[e], "c")) == 1,
        "count(preceding-sibling::t:a) = 1": lambda e, _: len(named(beside(e)[: beside(e).index(e)], "a")) == 1,
        "following-sibling::*": lambda e, _: beside(e)[-1] is not e,
        "count(//t:d) &gt; 10": lambda _, root: len(named(root.iter(), "d")) > 10,
        "not(descendant::t:c or following-sibling::t:c)": lambda e, _: not named(below(e), "c") and not named(beside(e)[beside(e).index(e) + 1 :], "c"),
        "number(@n) &lt; 2": lambda e, _: e.get("n") == "1",
        "string-length(concat(@n, 'x')) = 2": lambda e, _: bool(e.get("n")),
    }
    tests = {k: v for k, v in tests.items() if v}
    got = findings(spark, docs, "".join(rule(f"c{i}", t) for i, t in enumerate(tests)))
    want = [(path, f"c{i}", "x") for path, root in found.items() for e in root.iter() if local(e) == "a" for i, f in enumerate(tests.values()) if f(e, root)]
    assert got == sorted(want) and {c for _, c, _ in got} == {f"c{i}" for i in range(len(tests))}
    got = findings(spark, docs, rule("p", "count(t:b) &gt;= 0", "t:a[position() = 2 and last() &gt; 2][@n]"))
    here = lambda e: named(beside(e), "a")
    assert got == sorted((p, "p", "x") for p, root in found.items() for e in root.iter() if local(e) == "a" and e.get("n") and len(here(e)) > 2 and here(e)[1] is e)


def test_schema_parts(spark, tmp_path):
    docs = spark.createDataFrame([("d", f"<TEI {NS}><a n='1'><b/><b/></a><c/></TEI>")], "path string, xml string")
    rules = """<phase id="quick"><active pattern="one"/></phase>
<pattern abstract="true" id="some"><rule context="t:$element"><report test="count(t:$child) &gt; 1" id="many" diagnostics="why">many <value-of select="count(t:$child)"/></report></rule></pattern>
<pattern id="one" is-a="some"><param name="element" value="a"/><param name="child" value="b"/></pattern>
<pattern id="two"><rule abstract="true" id="base"><report test="true()" id="seen">seen <name/></report></rule><rule abstract="true" id="more"><extends rule="base"/></rule><rule context="t:c"><extends rule="more"/></rule></pattern>
<diagnostics><diagnostic id="why">n is <value-of select="@n"/></diagnostic></diagnostics>"""
    many, seen = ("d", "many", "many 2 n is 1"), ("d", "seen", "seen c")
    assert findings(spark, docs, rules) == [many, seen]
    assert findings(spark, docs, rules, phase="quick") == [many]
    assert findings(spark, docs, rules, phase="#ALL") == [many, seen]
    for wrong in (rules.replace('is-a="some"', 'is-a="none"'), rules.replace('<extends rule="base"/>', '<extends rule="more"/>')):
        with pytest.raises(ValueError):
            findings(spark, docs, wrong)
    with pytest.raises(ValueError):
        findings(spark, docs, rules, phase="none")
    (tmp_path / "part.sch").write_text(f'<pattern xmlns="{schema_files.SCH}"><rule context="t:c"><report id="in" test="true()">in</report></rule></pattern>')
    (tmp_path / "all.sch").write_text(f'<schema xmlns="{schema_files.SCH}"><ns prefix="t" uri="{TEI}"/><include href="part.sch"/></schema>')
    schema = schema_files.read_schema(str(tmp_path / "all.sch"))
    assert [x["check_id"] for x in schema_files.check_documents(docs, schema).collect()] == ["in"]
    files = corpus.with_places(docs)
    counted = schema_files.read_schema(f'<schema xmlns="{schema_files.SCH}"><ns prefix="t" uri="{TEI}"/><pattern><rule context="t:a"><assert test="count(t:b) = 1">one</assert></rule></pattern></schema>')
    assert [(x["findings"], x["valid"]) for x in commands.validate(files, schema=counted).collect()] == [(1, False)]


def test_encodings_in_one_folder(spark, tmp_path):
    text = f"<TEI {NS}><text><body><p>café – ñ</p></body></text></TEI>"
    latin = text.replace("–", "-")
    files = {
        "utf8.xml": text.encode(), "bom.xml": b"\xef\xbb\xbf" + text.encode(), "utf16.xml": text.encode("utf-16"), "declared.xml": b'<?xml version="1.0" encoding="UTF-8"?>' + text.encode(),
        "latin.xml": b'<?xml version="1.0" encoding="ISO-8859-1"?>' + latin.encode("latin-1"), "cp1252.xml": b"<?xml version='1.0' encoding='windows-1252'?>" + text.encode("cp1252"),
        "koi8.xml": '<?xml version="1.0" encoding="KOI8-R"?><p>мир</p>'.encode("koi8-r"), "sjis.xml": '<?xml version="1.0" encoding="Shift_JIS"?><p>日本</p>'.encode("shift_jis"),
        "broken.xml": text.encode("latin-1", "replace")[:60] + b"\xff\xfe" + b"</p></body></text></TEI>", "wrong.xml": b'<?xml version="1.0" encoding="UTF-8"?>' + latin.encode("latin-1"),
        "unknown.xml": b'<?xml version="1.0" encoding="no-such-code"?><p/>', "codec.xml": b'<?xml version="1.0" encoding="base64"?><p/>', "empty.xml": b"",
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "__cts__.xml").write_bytes(b'<?xml version="1.0" encoding="ISO-8859-1"?><w>\xe9</w>')
    for found in (corpus.read_corpus(spark, str(tmp_path)), corpus.read_files(spark, [str(tmp_path / n) for n in files])):
        got = {}
        for x in shred(found, ("kind", "name", "text")).collect():
            if x["kind"] == "error" or x["name"] in ("p", "w"):
                got[x["path"].rsplit("/", 1)[-1]] = None if x["kind"] == "error" else x["text"]
        want = {n: "café – ñ" for n in ("utf8.xml", "bom.xml", "utf16.xml", "declared.xml", "cp1252.xml")} | {"latin.xml": "café - ñ", "koi8.xml": "мир", "sjis.xml": "日本"}
        want |= dict.fromkeys(["broken.xml", "wrong.xml", "unknown.xml", "codec.xml", "empty.xml"])
        assert got == want | ({"__cts__.xml": "é"} if "__cts__.xml" in got else {})
    whole = commands.survey(corpus.read_corpus(spark, str(tmp_path)))
    assert {x["element"]: x["file_count"] for x in whole["elements"].collect()}["p"] == 8
    # Text that is text already is taken as it is, whatever it declares.
    given = spark.createDataFrame([("a", '<?xml version="1.0" encoding="ISO-8859-1"?><p>café</p>')], "path string, xml string")
    assert shred(given, ("text",)).first()["text"] == "café"
    done = {x["path"].rsplit("/", 1)[-1]: x for x in commands.set_genre(corpus.texts(corpus.read_corpus(spark, str(tmp_path))), "prose", corpus.default_taxonomy(spark)).collect()}
    assert done["broken.xml"]["error"] and done["unknown.xml"]["error"]
    assert rewrite.rewrite(files["latin.xml"], (), None) == f'<?xml version="1.0" encoding="UTF-8"?>\n{latin}'
    assert rewrite.rewrite(given.first()["xml"], (), None).endswith("<p>café</p>")


def test_catalogues_by_folder(spark, tmp_path):
    """The catalogue in a text's own folder counts, at any depth; a text below a work's folder is no part of the work."""
    ti = 'xmlns:ti="http://chs.harvard.edu/xmlns/cts"'
    body = f"<TEI {NS}><text><body><p/></body></text></TEI>"
    cat = lambda g: f"<ti:work {ti}><ti:title>{g}</ti:title><ti:genre>{g}</ti:genre></ti:work>"
    files = {"g/__cts__.xml": f"<ti:textgroup {ti}><ti:groupname>G</ti:groupname></ti:textgroup>", "g/w/__cts__.xml": cat("prose"), "g/w/a.xml": body, "g/w/old/b.xml": body, "x/y/g/w/__cts__.xml": cat("verse"), "x/y/g/w/c.xml": body, "d.xml": body}
    for name, content in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(content)
    found = corpus.read_corpus(spark, str(tmp_path))
    nodes = shred(corpus.texts(found))
    assert {x["stem"]: x["genre"] for x in commands.resolved_genres(found, nodes).collect()} == {"a": "prose", "b": "unknown", "c": "verse", "d": "unknown"}
    assert [(x["path"], x["author"]) for x in commands.genre_map(found, corpus.default_taxonomy(spark)).collect()] == [("g/w/a.xml", "G")]


def test_probes_move_no_rows_through_the_driver(spark, sf_dir):
    """Staged files are far smaller than their rows: no join of nodes may be left to a guess by file size."""
    for name in ("axis_child", "axis_descendant", "axis_ancestor", "axis_position", "taxonomy_categories"):
        assert "BroadcastHashJoin" not in catalogue.QUERIES[name](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString(), name


def test_only_what_is_asked_for(spark):
    docs = spark.createDataFrame([("a", f"<?x y?><TEI {NS}><text><body><div n='1'><l>x</l><l>y</l></div><div n='1'/></body></text></TEI>"), ("b", "<TEI"), ("c", f"<TEI {NS}/>")], "path string, xml string")
    columns = ("node_id", "end_id", "parent_id", "kind", "name", "location", "anc_names")
    every = [tuple(r) for r in shred(docs, columns).collect()]
    got = [tuple(r) for r in shred(docs, columns, only=frozenset(("div", "x"))).collect()]
    assert got == [r for r in every if r[4] in ("error", "pi") and r[5] in ("", "x") or r[5] in ("TEI", "div")]
    once = shred(docs, ("kind", "name", "unit", "anc_units"), only=frozenset(("l", "div")), once=True).groupBy("path").count().collect()
    assert sorted(map(tuple, once)) == [("a", 3), ("b", 1), ("c", 1)]
    schema = lambda rule: schema_files.read_schema(f'<schema xmlns="http://purl.oclc.org/dsdl/schematron"><ns prefix="t" uri="{TEI}"/><pattern>{rule}</pattern></schema>').asked
    assert schema('<rule context="t:a[position() = 2]"><report test="count(../t:b) = 1 and .//t:c">x</report></rule>') == {"a", "b", "c"}
    assert schema('<rule context="t:a"><report test="count(../..) = 1">x</report></rule>') is None and schema('<rule context="processing-instruction()"><report test="true()">x</report></rule>') is None


def test_siblings_by_name_are_counted_where_documents_are_parsed(spark, trees):
    """The same counts with and without the shredder's, and no node moves or is staged for its siblings; tests that ask for more are counted as before."""
    _, docs = trees
    read = lambda rules: schema_files.read_schema(f'<schema xmlns="{schema_files.SCH}"><ns prefix="t" uri="{TEI}"/><pattern>{rules}</pattern></schema>')
    message = """<value-of select="count(preceding-sibling::t:a)"/> <value-of select="count(following-sibling::t:c)"/> <value-of select="count(../t:b)"/>"""
    plain = read(f"""<rule context="t:b[position() &lt; last()][@n]"><report id="here" test="true()">{message}</report></rule><rule context="t:TEI"><report id="root" test="true()">{message}</report></rule>""")
    assert plain.told and plain.beside == ("a", "b", "c") and plain.reads == ("attrs",)
    found = schema_files.check_documents(docs, plain)
    assert not any(x in found._jdf.queryExecution().sparkPlan().toString() for x in ("Exchange", "Window", "Sort", "FileScan", "Aggregate"))
    nodes = shred(docs, (*plain.columns, "node_id", "parent_id"), only=plain.asked)
    want = schematron.run_checks(axes.probed(nodes, plain.probes), plain.checks)
    rows = lambda df: sorted(map(tuple, df.select("path", "check_id", "location", "message").collect()))
    assert rows(found) == rows(want) and {x[1] for x in rows(found)} == {"here", "root"}
    short = schema_files.check_documents(docs, plain, located=False)
    assert "location" not in short.columns and sorted((x["path"], x["message"]) for x in short.collect()) == sorted((x[0], x[3]) for x in rows(found))
    mixed = read(f"""<rule context="t:b"><report id="m" test="following-sibling::t:c[@n='1'] and .//t:d or preceding-sibling::*">{message}</report></rule>""")
    assert not mixed.told and mixed.beside == ("a", "b", "c")
    got, asked = rows(schema_files.check_documents(docs, mixed)), shred(docs, mixed.columns, only=mixed.asked)
    assert got and got == rows(schematron.run_checks(axes.probed(asked, mixed.probes), mixed.checks))


def test_kept_nodes_are_those_of_the_whole_parse(trees):
    """A parse that keeps some names only gives the columns that a parse of all nodes gives, siblings' counts too."""
    found, _ = trees
    columns = frozenset(("node_id", "end_id", "parent_id", "depth", "kind", "ns", "name", "attrs", "text", "has_child_node", "in_text", "anc_textparts", "anc_names", "doc_base"))
    extra = f"""<?x y?><!--c--><TEI {NS}><a xml:base="no"/><text><body xml:base="u:1"><div type="textpart">t<?x z?><!--c--><div xmlns="" type="textpart"><a/>u<b/></div><div type="textpart" xml:id="i"><a>v</a><div/></div></div></body><body xml:base="u:2"/></text><x/></TEI>"""
    texts = [*(ET.tostring(t, encoding="unicode") for t in found.values()), extra, extra.replace('xml:base="u:1"', 'xml:base=""'), extra[:-3], ""]
    for xml in texts:
        for only in (frozenset("a"), frozenset(("a", "div", "x")), frozenset(("b", "TEI", "zz"))):
            names = ("a", "div")
            got = parse(xml, columns, only=only, beside=names)
            want = parse(xml, columns | {"location"}, only=only, beside=names)
            keys = sorted(columns) if got[0]["kind"] == "error" else [*sorted(columns), "before", "among"]
            assert [[n[k] for k in keys] for n in got] == [[n[k] for k in keys] for n in want]
            for some in ([], ["node_id"], ["anc_names"], ["anc_textparts", "doc_base"], ["parent_id"]):
                fewer = ["kind", "ns", "name", "attrs", *some, *keys[len(columns) :]]
                assert [[n[k] for k in fewer] for n in parse(xml, frozenset(fewer), only=only, beside=names)] == [[n[k] for k in fewer] for n in want]


def odd_documents():
    """Namespaces, instructions, comments, attributes by default, entities declared here, elsewhere or nowhere, bytes that are no text, and nothing at all."""
    div = '<div type="textpart" n="1"><a xml:id="i">v</a><div/></div>'
    extra = f"""<?x y?><?div z?><!--c--><TEI {NS} n="r"><a xml:id="i"/><text><?div z?><!--c-->{div}<div xmlns="" type="textpart" n="1"/><div type="textpart"/>{div}{div}</text></TEI>"""
    declared = f"""<!DOCTYPE TEI [<!ENTITY e '<a {NS}/><div {NS} n="2"/>'><!ATTLIST div type CDATA "usual">]><TEI {NS}>&e;<div/>&e;</TEI>"""
    return [extra, declared, f'<!DOCTYPE TEI SYSTEM "no.dtd"><TEI {NS}>&e;<div/><div/><a/></TEI>', f"<TEI {NS}>&e;<div/></TEI>", extra[:-3], "", f"<div {NS} type='textpart'/>", f"<x><y {NS}/></x>", "<div/>", "<!-- -->"]


def test_equal_elements_stand_once_with_their_number(spark, trees):
    """What the tally says is what all nodes say one by one, whatever the document; a large one makes few rows."""
    found, _ = trees
    texts = [*(ET.tostring(t, encoding="unicode") for t in found.values()), *odd_documents()]
    given = [t.encode() for t in texts] + [t.encode("utf-16") for t in texts if t] + ['<?xml version="1.0" encoding="ISO-8859-1"?><div n="é"/>'.encode("latin-1"), b"<a>\xff</a>", None]
    frames = [spark.createDataFrame([(f"d{i}", x) for i, x in enumerate(of)], f"path string, xml {kind}") for of, kind in ((texts, "string"), (given, "binary"))]
    row = lambda x: (x["path"], x["kind"], x["ns"], x["name"], tuple(sorted(x["attrs"].items())), tuple(x["before"]), tuple(x["among"]))
    for docs in frames:
        for only, keys, beside in (("a",), (), ("a",)), (("a", "div"), ("n", "type", "xml:id"), ("b", "div")), (("b", "TEI", "zz"), ("n",), ()), (("div",), ("type", "no"), ("div",)):
            want = {}
            columns = ("kind", "ns", "name", "attrs")
            for x in shred(docs, columns, only=frozenset(only), beside=beside or ("none",), keys=keys).where("kind in ('element', 'error')").collect():
                key = row(x) if beside else (*row(x)[:5], (), ())
                want[key] = want.get(key, 0) + 1
            got = tally(docs, frozenset(only), keys, beside).collect()
            assert {row(x): x["times"] for x in got} == want and len(got) == len(want)
    book = "<div type='b'>" + "<div type='c'><l>x</l></div>" * 7 + "</div>"
    large = spark.createDataFrame([("d", f"<TEI {NS}><text>{book * 2000}</text></TEI>")], "path string, xml string")
    rows = tally(large, frozenset(("div",)), ("type",), ("div",)).collect()
    assert len(rows) == 1 + 2000 + 7 and sum(x["times"] for x in rows) == 1 + 2000 * 8


def test_findings_are_counted_as_they_are_found(spark, trees):
    """Counts are those of the findings one by one: where elements are tallied, and where more is asked of them than attributes and siblings."""
    found, _ = trees
    texts = [*(ET.tostring(t, encoding="unicode") for t in found.values()), *odd_documents()]
    docs = spark.createDataFrame([(f"d{i}", x) for i, x in enumerate(texts)], "path string, xml string")
    read = lambda rules: schema_files.read_schema(f'<schema xmlns="{schema_files.SCH}"><ns prefix="t" uri="{TEI}"/><pattern>{rules}</pattern></schema>')
    beside = """<rule context="t:a[@n] | t:div"><report id="twice" test="count(preceding-sibling::t:a) = 1">x</report><assert id="last" test="following-sibling::t:div or @xml:id = 'i'"><value-of select="@n"/></assert></rule>
<rule context="t:TEI | t:a[position() = last()]"><assert id="n" test="@n">n</assert></rule>"""
    more = ["<rule context='processing-instruction(\"div\")'><report id='pi' test='true()'>x</report></rule>", "<rule context='t:b'><report id='node' test='node() and count(../t:b) &gt; 1'>x</report></rule>", "<rule context='t:c'><report id='deep' test='.//t:a'>x</report></rule>"]
    for rules, tallied in ((beside, True), *((beside + x, False) for x in more)):
        schema = read(rules)
        assert schema.tallied == tallied
        want = {}
        for x in schema_files.check_documents(docs, schema).collect():
            want[x["path"], x["check_id"]] = want.get((x["path"], x["check_id"]), 0) + 1
        assert {(x["path"], x["check_id"]): x["findings"] for x in schema_files.count_findings(docs, schema).collect()} == want and len({c for _, c in want}) == 3 + (not tallied)
        by = schema_files.count_findings(docs, schema, F.length("path").alias("by"))
        assert by.columns == ["by", "check_id", "findings"] and {(x["by"], x["check_id"]): x["findings"] for x in by.collect()} == {(k, c): sum(n for (p, d), n in want.items() if len(p) == k and d == c) for k, c in {(len(p), c) for p, c in want}}


def test_findings_above_are_counted_where_documents_are_parsed(spark, trees):
    """Counts along parents and ancestors, with siblings too, are those of the findings one by one; a large document makes few rows, and a deep one is read."""
    found, _ = trees
    texts = [*(ET.tostring(t, encoding="unicode") for t in found.values()), *odd_documents()]
    docs = spark.createDataFrame([(f"d{i}", x) for i, x in enumerate(texts)], "path string, xml string")
    read = lambda rules: schema_files.read_schema(f'<schema xmlns="{schema_files.SCH}"><ns prefix="t" uri="{TEI}"/><pattern>{rules}</pattern></schema>')
    rules = """<rule context="t:a"><report id="two" test="count(ancestor::t:a) = 1 or count(ancestor::*) = 3">x</report><assert id="n" test="ancestor::t:b[@n]">x</assert><report id="up" test="../..[@n] or ../../parent::t:b[@n='1']">x</report></rule>
<rule context="t:div | t:b[preceding-sibling::t:a]"><report id="part" test="../ancestor::t:div[@type='textpart'] or parent::t:TEI or count(ancestor::t:c) = count(../ancestor::*)">x</report><assert id="last" test="following-sibling::t:b">x</assert></rule>"""
    for given, tallied in ((rules.replace("[@n] or ../../", " or ../../"), True), (rules.replace("../..[@n] or", "ancestor::t:b[not(@n)] or"), False)):
        schema = read(given)
        assert schema.tallied == tallied
        want = {}
        for x in schema_files.check_documents(docs, schema).collect():
            want[x["path"], x["check_id"]] = want.get((x["path"], x["check_id"]), 0) + 1
        assert {(x["path"], x["check_id"]): x["findings"] for x in schema_files.count_findings(docs, schema).collect()} == want and len({c for _, c in want}) == 5
    schema = read("""<rule context="t:l"><report id="in" test="count(ancestor::t:div) = 2">x</report></rule>""")
    large = spark.createDataFrame([("d", f"<TEI {NS}><div>{'<div><l/><l/></div>' * 2000}</div>{'<div>' * 3000}<l/>{'</div>' * 3000}</TEI>")], "path string, xml string")
    rows = tally(large, schema.counted, schema.keys, schema.beside, schema.above).where("name = 'l'").collect()
    assert sorted((list(x["above"]), x["times"]) for x in rows) == [([2], 4000), ([3000], 1)]
    assert [tuple(x) for x in schema_files.count_findings(large, schema).collect()] == [("d", "in", 4000)]


def test_what_stands_in_what_is_counted_where_documents_are_parsed(spark, trees):
    """Counts by labels are those of all pairs; none is made and nothing moves, whatever the number of pairs."""
    found, _ = trees
    texts = [*(ET.tostring(t, encoding="unicode") for t in found.values()), *odd_documents()]
    book = "<div type='b'>" + "<div type='c'><l>x</l></div>" * 20 + "</div>"
    texts += [f"<TEI {NS}>{book * 500}</TEI>", f"<TEI {NS}>{'<div>' * 800}<l/>{'</div>' * 800}</TEI>", None]
    docs = spark.createDataFrame([(f"d{i}", x) for i, x in enumerate(texts)], "path string, xml string")
    outer, inner = ("TEI", "a", "b", "div"), ("a", "c", "div", "l")
    got = nested(docs, frozenset(outer), frozenset(inner), ("n", "type"), lambda name, attrs: name + attrs.get("n", attrs.get("type", "")))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    nodes = shred(docs, ("node_id", "end_id", "kind", "name", "attrs")).where("kind = 'element'")
    label = F.concat("name", F.coalesce(F.col("attrs")["n"], F.col("attrs")["type"], F.lit(""))).alias("label")
    pairs = intervals.containment(nodes.where(F.col("name").isin(*outer)).select("path", "node_id", "end_id", label), nodes.where(F.col("name").isin(*inner)).select("path", "node_id", label))
    want = pairs.groupBy("path", F.col("outer.label").alias("outer_label"), F.col("inner.label").alias("inner_label")).agg(F.count("*").alias("pairs"), F.countDistinct("outer.node_id").alias("outers"))
    rows = lambda df: sorted(tuple(x) for x in df.collect())
    assert rows(got) == rows(want)
    assert ("d15", "TEI", "l", 10_000, 1) in rows(got) and ("d16", "div", "div", 800 * 799 // 2, 799) in rows(got)
