"""The corpus operators on small documents whose answers are known."""

import pytest
from pyspark.sql import functions as F

from stemmata.functions import text
from stemmata.operators import audit, catalogues, genres, rewrite, schema_files, schematron, structure, validation, vocabulary
from stemmata.operators.shred import CHECKS, parse, shred
from stemmata.plans import annotation, commands
from stemmata.sources import corpus
from stemmata.vocabulary import FAMILY_DEFAULT, HIERARCHY, LITERARY

NS = 'xmlns="http://www.tei-c.org/ns/1.0"'


def doc(body, header="", base=""):
    base = f' xml:base="{base}"' if base else ""
    return f"<TEI {NS}><teiHeader><fileDesc><publicationStmt/></fileDesc><encodingDesc/>{header}</teiHeader><text><body{base}>{body}</body></text></TEI>"


def profile(target, **more):
    extra = "".join(f' {k}="{v}"' for k, v in more.items())
    return f'<profileDesc><textClass><catRef scheme="#genre" target="{target}"{extra}/></textClass></profileDesc>'


def div(kind, inner):
    return f'<div type="{kind}" n="1">{inner}</div>'


def part(subtype, inner, **more):
    extra = "".join(f' {k.replace("_", ":")}="{v}"' for k, v in more.items())
    return f'<div type="textpart" subtype="{subtype}"{extra}>{inner}</div>'


STRUCTURES = {
    "epic": (div("book", "<l>x</l>"), "book+l", "verse", "verse-book-line"),
    "stichic": ("<l>x</l>", "l", "verse", "verse-stichic"),
    "standard": (div("book", div("chapter", div("section", "<p/>"))), "book+chapter+section", "prose", "prose-standard"),
    "section": (div("section", "<p/>"), "section", "prose", "prose-section"),
    "chapters": (div("chapter", div("section", "")), "chapter+section", "prose", "prose-chapter-section"),
    "book-section": (div("book", div("section", "")), "book+section", "prose", "prose-book-section"),
    "book-chapter": (div("book", div("chapter", "")), "book+chapter", "prose", "prose-book-chapter"),
    "chapter": (div("chapter", "<p/>"), "chapter", "prose", "prose-chapter"),
    "drama": (div("episode", "<sp><l/></sp>"), "episode+l", "drama", "drama-line"),
    "acts": (div("act", div("scene", "<l/>")), "act+l+scene".replace("act+l+scene", "act+scene+l"), "drama", "drama-act-scene-line"),
    "epidoc-epic": (div("edition", part("Book", "<l/>")), "book+l", "verse", "verse-book-line"),
    "epidoc-prose": (div("edition", part("book", part("chapter", part("section", "")))), "book+chapter+section", "prose", "prose-standard"),
    "empty": ("<p/>", "(none)", "prose", None),
    "tie": (div("book", div("letter", "") + div("section", "")), "book+letter+section", "prose", "prose-book-letter"),
}


@pytest.fixture(scope="module")
def structures(spark):
    return spark.createDataFrame([(k, doc(v[0])) for k, v in STRUCTURES.items()], "path string, xml string")


def test_signatures_and_best_fit(spark, structures):
    signed = structure.signatures(shred(structures))
    got = {r[0]: r[1] for r in signed.select("path", structure.describe()).collect()}
    assert got == {k: v[1] for k, v in STRUCTURES.items()}
    family = spark.createDataFrame([(k, v[2]) for k, v in STRUCTURES.items()], "path string, family string")
    best = {r[0]: r[1] for r in structure.best(structure.fitting(signed.join(family, "path"), by_family=True)).collect()}
    assert best == {k: v[3] for k, v in STRUCTURES.items() if v[3]}


def test_only_the_first_body_counts(spark):
    xml = f'<TEI {NS}><teiHeader><l/></teiHeader><text><body>{div("book", "")}</body><body>{div("act", "<l/>")}</body></text></TEI>'
    row = structure.signatures(shred(spark.createDataFrame([("a", xml)], "path string, xml string"))).first()
    assert row["div_types"] == ["book"] and not row["has_lines"]


def test_intervals_are_well_formed():
    nodes = parse(doc(div("book", "<l>a<!--c-->b</l><?pi x?>") + "<p/>"))
    for n in nodes:
        inside = [m for m in nodes if n["node_id"] < m["node_id"] <= n["end_id"]]
        assert all(m["parent_id"] is not None and n["node_id"] <= m["parent_id"] <= n["end_id"] for m in inside)
    assert {n["kind"] for n in nodes} == {"element", "comment", "pi"}
    assert next(n for n in nodes if n["name"] == "l")["text"] == "a"


@pytest.mark.parametrize("xml", ["", "<a", "no xml", "<a></b>", None])
def test_broken_documents_are_rows(spark, xml):
    row = commands.roots(shred(spark.createDataFrame([("x", xml)], "path string, xml string"))).first()
    assert row["parse_ok"] is False and row["parse_error"]


def test_rules_and_levels(spark):
    body = part("book", part("chapter", "", xml_base="urn:cts:no:1") + part("chapter", "", n="2", xml_base="urn:cts:a:b.1"), n="1") + '<milestone unit="page"/><milestone/>'
    nodes = shred(spark.createDataFrame([("d/x.xml", doc(body, base="urn:cts:a:b"))], "path string, xml string"))
    got = {r["rule_id"]: r["message"] for r in audit.run_rules(nodes, audit.REFERENCE_RULES + audit.STRUCTURE_RULES).collect()}
    assert sorted(got) == ["REF002", "REF003", "STR002", "STR003", "STR004"]
    assert got["STR003"].startswith("1 <div type='textpart'> element(s) lack @n (subtypes: chapter)")
    assert got["STR004"].endswith("Examples:\n  urn:cts:no:1")
    levels = {r["subtype"]: r for r in audit.citation_levels(nodes).collect()}
    assert levels["chapter"]["depth"] == 2 and levels["chapter"]["base_correct"] == 1 and levels["book"]["level_no"] == 1
    assert {r["unit"]: r["count"] for r in audit.milestones(nodes).collect()} == {"page": 1, "": 1}
    report = audit.structure_report(nodes)
    assert report.first()["structural_type"] == "mixed"
    shown = audit.structure_text(report).first()["text"]
    assert "Structural type:  mixed" in shown and "      actual:          urn:cts:no:1" in shown and "  div      chapter          2       2" in shown
    assert '"structural_type" : "mixed"' in audit.as_json(report).first()["json"]
    assert "[WARNING] STR003" in audit.finding_text(audit.run_rules(nodes, audit.STRUCTURE_RULES)).first()["text"]
    assert "Has citeStructure:   False" in audit.reference_text(audit.reference_report(nodes)).first()["text"]


def test_reference_report(spark):
    header = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><encodingDesc><refsDecl xml:id="a"/><refsDecl default="true" n="CTS"><citeStructure/><citeStructure/><cRefPattern n="q"/></refsDecl></encodingDesc></teiHeader><text><body/></text></TEI>'
    nodes = shred(spark.createDataFrame([("x", header)], "path string, xml string"))
    row = audit.reference_report(nodes).first()
    assert (row["refsDecl_count"], row["refsDecl_ids"], row["refsDecl_has_cite_structure"]) == (2, ["a", ""], [False, True])
    assert audit.facts(nodes).first()["default_is_cite_structure"] and audit.structure_report(nodes).first()["cref_patterns"] == ["q"]


def test_custom_rule(spark):
    @audit.audit_rule("OWN1", role="error")
    def own():
        return F.col("textparts") == 0, F.lit("none")

    found = audit.run_rules(shred(spark.createDataFrame([("x", doc("<p/>"))], "path string, xml string")), ("OWN1",))
    assert audit.with_role(found, "error").count() == 1
    del audit.RULES["OWN1"]


def test_checks(spark):
    good = f'<?xml-model href="https://example.org/schemas/x.rng" schematypens="y"?><TEI {NS}><teiHeader><fileDesc><publicationStmt><idno type="CTS">u</idno></publicationStmt></fileDesc><encodingDesc><refsDecl n="CTS"><citeStructure/></refsDecl></encodingDesc>{profile("#prose")}</teiHeader><text><body xml:base="urn:cts:x"/></text></TEI>'
    bad = f'<TEI {NS}><teiHeader><fileDesc><publicationStmt/></fileDesc><encodingDesc><refsDecl n="X"><citeStructure/></refsDecl></encodingDesc><profileDesc/></teiHeader><text><body xml:base="x"><s/><s>t</s><said/><reg/><docAuthor/></body></text></TEI>'
    bare = f"<TEI {NS}><text/></TEI>"
    nodes = shred(spark.createDataFrame([("good", good), ("bad", bad), ("bare", bare)], "path string, xml string"))
    found = schematron.run_checks(nodes, schematron.normalized_checks())
    assert sorted(r["check_id"] for r in found.where("path = 'bad'").collect()) == ["cts-idno", "cts-xml-base-urn", "genre-annotation", "refs-decl", "refs-decl-cite"]
    assert found.where("path in ('good', 'bare')").count() == 0
    more = schematron.run_checks(nodes, schematron.encoding_checks())
    assert sorted((r["path"], r["check_id"]) for r in more.collect()) == [("bad", "empty-s-milestone"), ("bad", "legacy-docAuthor"), ("bad", "legacy-reg"), ("bad", "legacy-said"), ("good", "genre-needs-review")]
    assert schematron.gate(more).count() == 0 and schematron.warnings(more).count() == 5


OWN_SCHEMA = """<schema xmlns="http://purl.oclc.org/dsdl/schematron">
  <ns prefix="t" uri="http://www.tei-c.org/ns/1.0"/><let name="low" value="('low', 'none')"/>
  <pattern id="first"><rule context="t:s[not(node())]"><report id="empty" test="true()" role="warning">no  text</report></rule><rule context="t:s | t:p"><report test="@n" role="info">n is <value-of select="@n"/> of <name/></report></rule></pattern>
  <pattern id="ref"><rule context="t:catRef"><let name="id" value="substring-after(@target, '#')"/>
    <assert test="$id = ('prose', 'verse') and not(@cert = $low)">'<value-of select="$id"/>'</assert><assert test="contains(@target, 'x') or starts-with(@target, '#')" role="error">hash</assert></rule></pattern>
  <pattern id="head"><rule context="t:encodingDesc"><assert test="t:refsDecl[@n='CTS']/t:citeStructure[@unit]">cite</assert></rule></pattern>
  <pattern id="pi"><rule context="processing-instruction('xml-model')"><assert test="contains(., 'schemas')">got <value-of select="normalize-space(.)"/></assert></rule></pattern>
</schema>"""


def test_schema_file(spark):
    schema = schema_files.read_schema(OWN_SCHEMA)
    assert schema.holders == ("encodingDesc",)
    one = f'<?xml-model href=" a  b"?><TEI {NS}><teiHeader><encodingDesc><refsDecl n="CTS"><citeStructure/></refsDecl></encodingDesc>{profile("#prose")}<catRef target="drama" cert="low"/></teiHeader><text><body><s n="1"/><s n="2">t</s><p n="3"/><p/><s xmlns=""/></body></text></TEI>'
    two = f'<?xml-model href="schemas"?><TEI {NS}><teiHeader><encodingDesc><refsDecl n="CTS"><citeStructure unit="l"/></refsDecl></encodingDesc><catRef target="#verse"/></teiHeader></TEI>'
    docs = spark.createDataFrame([("one", one), ("two", two), ("bad", "<a>")], "path string, xml string")
    found = schematron.run_checks(shred(docs, CHECKS, schema.holders), schema.checks)
    assert sorted((r["path"], r["check_id"], r["kind"], r["role"], r["message"]) for r in found.collect()) == [
        ("one", "empty", "successful-report", "warning", "no text"),
        ("one", "first", "successful-report", "info", "n is 2 of s"),
        ("one", "first", "successful-report", "info", "n is 3 of p"),
        ("one", "head", "failed-assert", "", "cite"),
        ("one", "pi", "failed-assert", "", 'got href=" a b"'),
        ("one", "ref", "failed-assert", "", "''"),
        ("one", "ref-2", "failed-assert", "error", "hash"),
    ]
    files = corpus.with_places(docs)
    assert sorted((r["path"], r["findings"], r["valid"]) for r in commands.validate(files, schema=schema).collect()) == [("bad", 0, False), ("one", 4, False), ("two", 0, True)]
    assert schema_files.read_schema('<schema xmlns="http://purl.oclc.org/dsdl/schematron"/>').checks == []
    for wrong in ("sum(t:p) &gt; 1", "t:a/@n", "x:p", "$none", "'a' =", "t:p[t:q]", "position() = 1", "t:a/preceding-sibling::t:p", "following::t:p", "//t:a/t:b", "lower-case(@a) = 'x'"):
        with pytest.raises(ValueError):
            schema_files.read_schema(OWN_SCHEMA.replace('test="@n"', f'test="{wrong}"'))
    with pytest.raises(ValueError):
        schema_files.read_schema(OWN_SCHEMA.replace("<pattern id=\"pi\">", "<include href=\"x\"/><pattern id=\"pi\">"))  # no file, so nothing to go by


def test_svrl(spark):
    ns = 'xmlns:svrl="http://purl.oclc.org/dsdl/svrl"'
    xml = f'<svrl:schematron-output {ns}><svrl:failed-assert location="/a" test="t"><svrl:text> a  b\n</svrl:text></svrl:failed-assert><svrl:successful-report role="error"><svrl:text>e</svrl:text></svrl:successful-report><svrl:successful-report role="info"><svrl:text>i</svrl:text></svrl:successful-report></svrl:schematron-output>'
    found = schematron.read_svrl(spark.createDataFrame([("x", xml)], "path string, xml string"))
    assert found.count() == 3 and schematron.gate(found).count() == 2
    assert found.where("kind = 'failed-assert'").first()["message"] == "a b"


def test_validator_lines(spark):
    lines = {
        '/d/u8.ed.2.xml:3:4: error: element "said" not allowed here; expected the element end-tag': ("u8.ed.2", "said", 'element "said" not allowed here'),
        'x.xml:1:1: error: attribute "a" not allowed here; expected attribute "n"': ("x", "a", 'attribute "a" not allowed here'),
        'x.xml:1:1: error: element "p" incomplete; missing required element "q"': ("x", "p", 'element "p" incomplete; missing required element "q"'),
        "x.xml:2:1: fatal: Premature end.": ("x", "", "Premature end."),
        "": None,
        "banner": None,
    }
    df = spark.createDataFrame([(k, "prose") for k in lines], "line string, family string")
    got = {r["line"]: (r["stem"], r["subject"], r["message"]) for r in validation.parsed(df).collect()}
    assert got == {k: v for k, v in lines.items() if v}
    counts = validation.counted(validation.parsed(df.union(df)))
    assert {(r["element"], r["instance_count"], r["file_count"]) for r in counts.collect()} == {("said", 2, 1), ("a", 2, 1), ("p", 2, 1), ("", 2, 1)}


def test_top_values_cut_and_ties(spark):
    values = "".join(f'<note type="{"v" * 250 if i == 0 else f"v{i:02d}"}"/>' for i in range(35)) + '<note type="v34" other="x" rend="r"/>'
    counts = vocabulary.attribute_values(shred(spark.createDataFrame([("x", doc(values))], "path string, xml string")).withColumn("genre", F.lit("g")))
    top = [r["value"] for r in vocabulary.ordered_attributes(vocabulary.top_values(counts.where("attribute = 'type'"))).collect()]
    assert len(top) == 30 and top[:3] == ["v34", "v" * 200, "v33"]
    assert counts.where("attribute in ('other', 'rend')").count() == 1


def test_taxonomy_and_proposals(spark, tmp_path):
    odd = f'<TEI {NS}><taxonomy xml:id="genres">' + "".join(f'<category xml:id="{f}"><category xml:id="{d}"><catDesc> a\n b </catDesc></category></category>' for f, d in FAMILY_DEFAULT.items()) + "</taxonomy></TEI>"
    tax = corpus.read_taxonomy(spark, odd, "genres")
    assert genres.families_union(tax).count() == 6 and genres.missing_defaults(tax).count() == 0
    assert tax.where("target = 'drama-line'").first()["description"] == "a b"
    with pytest.raises(ValueError):
        corpus.read_taxonomy(spark, odd, "other")
    with pytest.raises(ValueError):
        corpus.read_taxonomy(spark, odd.replace("drama-line", "drama-x"), "genres")
    full = corpus.default_taxonomy(spark)
    rows = spark.createDataFrame([(" prose ",), ("unknown",), ("",), (None,), ("verse-epic",), ("verse-stichic",), ("zzz",)], "genre string")
    got = [(r["proposed_subclass"], r["proposed_family"]) for r in genres.with_proposal(rows, full).collect()]
    assert sorted(got) == sorted([("prose-standard", "prose"), ("", ""), ("", ""), ("", ""), ("verse-book-line", "verse"), ("verse-stichic", "verse"), ("", "")])
    with pytest.raises(Exception, match="unknown genre zzz"):
        genres.with_family(rows.where("genre = 'zzz'"), full, strict=True).collect()
    assert set(LITERARY.values()) <= set(HIERARCHY)


def test_genre_resolution_places(spark):
    anywhere = f'<TEI {NS}><teiHeader><catRef scheme="#genre" target="##verse"/></teiHeader></TEI>'
    df = spark.createDataFrame([("a", doc("", profile("##prose"))), ("b", anywhere)], "path string, xml string")
    assert {r[0]: r[1] for r in genres.document_genre(shred(df)).collect()} == {"a": "prose"}
    assert {r[0]: r[1] for r in genres.document_genre(shred(df), anywhere=True).collect()} == {"a": "prose", "b": "verse"}


def one(xml, steps, **context):
    return rewrite.rewrite(xml, steps, rewrite.Context(**context))


def test_rewrite_steps():
    x = one(doc(div("edition", part("Book", "<l met='u' ana='#met-dact'/><l ana='#met-dact'/>", n="1", xml_base="b")), profile("#verse-book-line")), rewrite.PIPELINES["verse"], cts_base="urn:cts:a", schema="corpus_verse")
    assert 'type="edition"' not in x and '<div type="book" n="1">' in x and 'xml:base="b"' not in x and '<body xml:base="urn:cts:a">' in x
    assert '<idno type="CTS">urn:cts:a</idno>' in x and x.count("<citeStructure") == 3
    assert '<l ana="#met-dact"/>' in x and '<l met="dactylic-hexameter"/>' in x
    assert one(x, rewrite.PIPELINES["verse"], cts_base="urn:cts:a", schema="corpus_verse").count("<refsDecl") == 1


@pytest.mark.parametrize("subclass", sorted(HIERARCHY))
def test_declarations(subclass):
    x = one(doc("", profile(f"#{subclass}")), ("declare_structure",))
    assert x.count("<citeStructure") == len(HIERARCHY[subclass]) + 1 and 'match="/TEI/text/body"' in x
    if subclass in rewrite.MATCHES:
        assert rewrite.MATCHES[subclass].replace("'", "&apos;") in x or rewrite.MATCHES[subclass] in x


def test_rewrite_errors_are_rows(spark):
    rows = [("ok", doc("", profile("#prose")), "prose", "urn:cts:x"), ("no-urn", doc("", profile("#prose")), "prose", ""), ("no-genre", doc(""), "prose", "u"), ("unknown", doc("", profile("#x")), "prose", "u"), ("family", doc(""), "", "u"), ("broken", "<a", "prose", "u"), ("null", None, "prose", "u")]
    done = {r["path"]: r["error"] for r in rewrite.rewritten(spark.createDataFrame(rows, "path string, xml string, family string, cts_base string")).collect()}
    assert done.pop("ok") is None and all(done.values())


def test_set_genre_and_schema():
    x = one(doc("", '<profileDesc><langUsage/><textClass><keywords/></textClass></profileDesc>'), ("set_genre",), target="prose", cert="low")
    assert x.count("textClass") == 2 and x.index("catRef") < x.index("langUsage") and 'cert="low"' in x and 'resp="#normalizer"' in x
    assert "textClass" not in one(x, ("set_genre",))
    y = one('<?xml-model href="a"?><?xml-model href="b"?>' + doc(""), ("set_schema",), schema=" 'x' ")
    assert y.count("xml-model") == 1 and 'href="https://example.org/schemas/x.rng"' in y
    assert "xml-model" not in one(doc(""), ("set_schema",), schema="x")


def test_upgrade():
    old = f'''<TEI {NS}><teiHeader type="t"><refsDecl doctype="d"><state unit="a b" n="1"/></refsDecl><revisionDesc><change><date>d</date><respStmt><name>n</name><resp>r</resp></respStmt><item>i</item></change></revisionDesc>
    <language id="greek"/></teiHeader><text><body><div1 id="q" lang="la"><ref targOrder="u"/><note anchored="no"/><trans><tr>x</tr></trans><entryFree key="k"/></div1>
    <biblStruct><monogr><title/><imprint/></monogr><idno>9</idno><note/></biblStruct></body></text></TEI>'''
    x = one(old, ("upgrade",))
    for want in ('<refState unit="aB" n="1"/>', '<div xml:id="q" xml:lang="lat">', '<language ident="grc"/>', 'anchored="false"', '<seg type="translation">x</seg>', '<entryFree n="k"/>', "<monogr><title/><idno>9</idno><imprint/></monogr><note/>", "<change><date>d</date><name>n</name><p>i</p></change>"):
        assert want in x, want
    for gone in ("doctype", "targOrder", "<trans", 'type="t"'):
        assert gone not in x


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    home = tmp_path_factory.mktemp("canonical-test") / "data"
    ti = 'xmlns:ti="http://chs.harvard.edu/xmlns/cts"'
    files = {
        "g1/__cts__.xml": f"<ti:textgroup {ti}><ti:groupname> Author </ti:groupname></ti:textgroup>",
        "g1/w1/__cts__.xml": f'<ti:work {ti} urn="urn:w1"><ti:title>Title</ti:title><ti:description xml:lang="lat">no</ti:description><ti:description xml:lang="eng"> d </ti:description><ti:genre confidence="high">prose-historiography</ti:genre></ti:work>',
        "g1/w2/__cts__.xml": f'<ti:work {ti} urn="urn:w2"><ti:title>Other</ti:title></ti:work>',
        "g1/w1/g1.w1.e1.xml": doc(div("book", div("chapter", div("section", "<p/>")))),
        "g1/w1/g1.w1.e2.xml": doc(div("book", div("act", ""))),
        "g1/w1/g1.w1.bad.xml": "<TEI",
        "g1/w2/g1.w2.e1.xml": doc("<sp><l/></sp>", profile("#drama-line"), base="urn:cts:own:x"),
    }
    for name, content in files.items():
        (home / name).parent.mkdir(parents=True, exist_ok=True)
        (home / name).write_text(content)
    return home


def test_corpus_scan_and_genre_map(spark, tree):
    files = corpus.read_corpus(spark, str(tree))
    assert (corpus.texts(files).count(), corpus.work_catalogues(files).count(), corpus.group_catalogues(files).count()) == (4, 2, 1)
    rows = {r["path"]: r for r in commands.genre_map(files, corpus.default_taxonomy(spark)).collect()}
    assert len(rows) == 4
    first, second, bad, drama = (rows[f"g1/{p}"] for p in ("w1/g1.w1.e1.xml", "w1/g1.w1.e2.xml", "w1/g1.w1.bad.xml", "w2/g1.w2.e1.xml"))
    assert (first["author"], first["title"], first["proposed_subclass"], first["match"], first["needs_review"]) == ("Author", "Title", "prose-standard", "ready", "false")
    assert (second["structure_signature"], second["proposed_subclass"], second["match"]) == ("act+book", "prose-book", "ready")
    assert (bad["structure_signature"], bad["match"], bad["proposed_subclass"]) == ("(parse-error)", "review", "prose-standard")
    assert (drama["match"], drama["needs_review"], drama["urn"]) == ("", "true", "urn:cts:own:x")
    work = commands.work_table(files).where("work = 'w1'").first()
    assert (work["description"], work["urn"], work["confidence"]) == ("d", "urn:w1", "high")


def test_survey_and_sinks(spark, tree, tmp_path):
    files = corpus.read_corpus(spark, str(tree))
    found = commands.survey(files)
    genre = {(r["element"], r["genre"]): (r["file_count"], r["instance_count"]) for r in found["elements"].collect()}
    assert genre[("div", "prose-historiography")] == (2, 5) and genre[("l", "drama-line")] == (1, 1)
    commands.write_csv(found["elements"], str(tmp_path / "elements"))
    assert corpus.read_csv(spark, str(tmp_path / "elements")).count() == found["elements"].count()
    only = commands.survey(files, genre="drama-line")
    assert {r["genre"] for r in only["structure"].collect()} == {"drama-line"} and only["elements"].where("genre != 'drama-line'").count() == 0


def test_structural_types_are_those_of_the_survey(spark, tree):
    """The short way to genres and structural types, over one node of each kind, says what the survey's structure table says."""
    odd = {
        "two": doc(div("textpart", "<l>x</l>") + '<milestone unit="p"/>', "<profileDesc><textClass>" + "".join(f'<catRef scheme="#genre" target="#{t}"/>' for t in ("prose", "verse", "prose")) + "</textClass></profileDesc>"),
        "other": f'<TEI xmlns="{corpus.TEI}"><text><body><div xmlns="" type="textpart"/><p type="textpart"/></body></text></TEI>',
        "marks": f'<TEI xmlns="{corpus.TEI}"><text><body><milestone/><milestone/></body></text></TEI>', "broken": "<TEI><a>", "part": f'<TEI xmlns="{corpus.TEI}"><text><front><div n="1" type="textpart"/><div n="2" type="textpart"/></front></text></TEI>',
    }
    more = corpus.with_places(spark.createDataFrame([(f"/c/g/w/{k}.xml", v.encode()) for k, v in odd.items()], "path string, xml binary"), "/c")
    files = corpus.read_corpus(spark, str(tree)).unionByName(more)
    rows = lambda df: sorted(map(tuple, df.select("path", "genre", "structural_type").collect()))
    got = commands.structural_types(files)
    assert rows(got) == rows(commands.survey(files)["structure"]) and {r[2] for r in rows(got)} >= {"unknown", "milestone-based", "div-based", "mixed"}
    many = spark.createDataFrame([("m", doc("".join(f'<div type="textpart" n="{k}"><milestone/></div>' for k in range(500))))], "path string, xml string")
    kinds = shred(many, audit.KINDS, only=audit.STRUCTURAL, under=frozenset(), keys=("type",), once=True).collect()
    assert sorted((r["name"], r["node_id"], str(r["attrs"])) for r in kinds) == [("TEI", 1, "{}"), ("div", 8, "{'type': 'textpart'}"), ("milestone", 9, "{}")]


def test_annotate_apply_normalize_validate(spark, tree, tmp_path):
    files, tax = corpus.read_corpus(spark, str(tree)), corpus.default_taxonomy(spark)
    row = annotation.annotate(files, tax).collect()
    assert len(row) == 1 and (row[0]["genre"], row[0]["confidence"]) == ("drama-line", "high") and '<ti:genre confidence="high">drama-line</ti:genre>' in row[0]["xml"]
    assert annotation.annotate(files, tax, classify=lambda rows: ["nonsense." for _ in rows]).first()["genre"] == "unknown"
    rows = commands.genre_map(files, tax)
    done = {r["path"]: r for r in commands.apply_genre_map(rows, files, tax).collect()}
    assert done["g1/w1/g1.w1.e1.xml"]["status"] == "apply" and done["g1/w1/g1.w1.bad.xml"]["status"] == "error" and done["g1/w2/g1.w2.e1.xml"]["status"] == "skipped"
    with pytest.raises(ValueError, match="nothing was changed"):
        commands.apply_genre_map(rows.withColumn("recommended_genre", F.lit("zzz")), files, tax)
    normal = {r["path"].rsplit("/", 1)[-1]: r for r in commands.normalize(files, tax).collect()}
    assert "urn:cts:test" in normal["g1.w2.e1.xml"]["xml"] or normal["g1.w2.e1.xml"]["error"] is None
    assert normal["g1.w1.e1.xml"]["error"]
    out = commands.write_documents(commands.normalize(files, tax), f"file://{tmp_path}/out").collect()
    assert len(out) == 1 and (tmp_path / "out" / "g1.w2.e1.xml").exists()
    assert commands.validate(files).where("valid").count() == 0
    with pytest.raises(ValueError):
        commands.set_genre(files, "zzz", tax)


def test_documents_keep_their_places(spark, tmp_path):
    done = spark.createDataFrame([(f"file:///c/data/g/w{k}/__cts__.xml", f"<w{k}/>") for k in range(3)], "path string, xml string")
    out = {r["path"]: r["target"] for r in commands.write_documents(done, f"file://{tmp_path}/out").collect()}
    assert [(tmp_path / "out" / f"w{k}" / "__cts__.xml").read_text() for k in range(3)] == ["<w0/>", "<w1/>", "<w2/>"] and len(set(out.values())) == 3
    commands.write_documents(done.limit(1), f"{tmp_path}/rooted", root="/c/data").collect()
    assert (tmp_path / "rooted" / "g" / "w0" / "__cts__.xml").exists()
    with pytest.raises(ValueError, match="one place"):
        commands.write_documents(done.union(done.limit(1)), f"{tmp_path}/twice")
    assert not (tmp_path / "twice").exists()
    own = spark.createDataFrame([(f"file://{tmp_path}/rooted/g/w0/__cts__.xml", "<new/>")], "path string, xml string")
    commands.write_documents(own, None).collect()
    assert (tmp_path / "rooted" / "g" / "w0" / "__cts__.xml").read_text() == "<new/>"


def python_passes(df):
    """Python operators over documents in the plan as it was executed."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("MapInArrow")


def test_documents_are_parsed_once(spark, sf_dir):
    from stemmata import catalogue

    assert python_passes(catalogue.QUERIES["schematron_normalized"](spark, sf_dir)) == 1
    assert python_passes(catalogue.QUERIES["element_vocab"](spark, sf_dir)) == 1
    # Staged nodes are read as columns, without another parse.
    for name in ("citation_levels", "structure_report", "reference_report", "genre_map_rows", "survey_structure"):
        assert python_passes(catalogue.QUERIES[name](spark, sf_dir)) == 0, name


def test_shred_makes_only_what_is_asked(spark):
    nodes = shred(spark.createDataFrame([("a", doc(div("book", "<l>x</l>")))], "path string, xml string"), ("kind", "name"))
    assert nodes.columns == ["path", "kind", "name"] and nodes.where("name = 'l'").count() == 1


def test_map_csv(spark, tmp_path):
    (tmp_path / "m.csv").write_text('urn,path,suggested_genre,recommended_genre,notes\nu,a/x.ed.xml,prose,,"a ""q"", b\nc"\nu,b/x.ed.xml,prose,verse,\n')
    rows = corpus.numbered(corpus.read_csv(spark, str(tmp_path / "m.csv")))
    assert rows.orderBy("row_no").first()["notes"] == 'a "q", b\nc'
    assert [tuple(r) for r in corpus.genre_lookup(rows).collect()] == [("x.ed", "verse")]


def test_scalar_functions(spark):
    one_row = spark.range(1)
    got = one_row.select(
        text.stem(F.lit("/a/b.c.xml")), text.camel_case(F.lit(" alphabetic  LETTER x")), text.without_hashes(F.lit("##a#")), text.without_hash(F.lit("##a")), text.after_hash(F.lit("a#b#c")), text.after_hash(F.lit("abc")),
        text.strip(F.lit("  a b\n")), text.truthy(F.lit(" Yes ")), text.truthy(F.lit("no")), text.computed_urn(F.lit("/x/canonical_lat/data/a/b.c.xml")), text.language(F.lit("xx")), text.boolean(F.lit("no")),
    ).first()
    assert tuple(got) == ("b.c", "alphabeticLetterX", "a#", "#a", "b#c", "", "a b", True, False, "urn:cts:lat:b.c", "xx", "false")


def test_signals_and_confidence(spark):
    rows = spark.createDataFrame([(1, 5, 0), (0, 5, 4), (0, 5, 5), (0, 0, 1), (0, 0, 0)], "sp_count long, l_count long, p_count long")
    assert [r[0] for r in rows.select(catalogues.inferred_family()).collect()] == ["drama", "verse", "prose", "prose", None]


def test_udtf(spark):
    from stemmata.operators.shred import shred_udtf

    spark.udtf.register("shred", shred_udtf())
    assert spark.sql("select count(*) from values ('<a><b/></a>') t(x), lateral shred(x)").first()[0] == 2


def test_command_line(spark, tree, tmp_path):
    from stemmata import cli

    assert cli.main(["survey", str(tree), "-o", f"{tmp_path}/survey"]) == 0
    assert corpus.read_csv(spark, f"{tmp_path}/survey/structure").count() == 3
    assert cli.main(["audit-structure", str(tree), "-o", f"{tmp_path}/a"]) == 1 and (tmp_path / "a" / "g1" / "w2" / "g1.w2.e1-structure.txt").exists()
    assert cli.main(["audit-schema", str(tree), "-o", f"{tmp_path}/a", "--json"]) == 1 and '"check_id"' in (tmp_path / "a" / "g1" / "w1" / "g1.w1.e1-schema.json").read_text()
    assert cli.main(["set-genre", str(tree / "g1/w2/g1.w2.e1.xml"), "--genre", "verse", "-o", f"{tmp_path}/s"]) == 0
    assert 'target="#verse"' in (tmp_path / "s" / "g1.w2.e1.xml").read_text()
    (tmp_path / "log.txt").write_text("g1.w2.e1.xml:1:1: error: element \"a\" not allowed here; expected x\nbanner\n")
    assert cli.main(["validation-report", str(tree), "--log", str(tmp_path / "log.txt"), "-o", f"{tmp_path}/r"]) == 0
    assert corpus.read_csv(spark, f"{tmp_path}/r").first()["family"] == "drama"
    for name in ("normalize", "annotate"):
        cli.main([name, str(tree), "-o", f"{tmp_path}/{name}"])
    assert (tmp_path / "normalize" / "g1" / "w2" / "g1.w2.e1.xml").exists()
    assert "drama-line" in (tmp_path / "annotate" / "g1" / "w2" / "__cts__.xml").read_text() or "drama-line" in (tmp_path / "annotate" / "g1" / "w1" / "__cts__.xml").read_text()
    assert cli.main(["set-genre", str(tree / "g1/w2/g1.w2.e1.xml"), "--genre", "verse", "--in-place"]) == 0
    assert 'target="#verse"' in (tree / "g1/w2/g1.w2.e1.xml").read_text()
