"""Nodes of markup, functions of the store, and the text library."""

from wikiloom.functions import library
from wikiloom.operators import expand, nodes
from wikiloom.plans.folders import ensure_checkpoints

TEXT = "== H ==\n{{a|[[B|c]]|k={{d}}}} '''x ''y'' z''' <div class=\"q w\">u<br>v [[E]]</div>\n* one\n** two {{t}}\n{|\n| {{{1}}}\n|}\n__TOC__ http://q.z [http://w.e r] <ref name=k/> <!-- [[no]] --> {{open"


def test_nodes_and_tree_queries(spark):
    rows = nodes.node_rows(spark.createDataFrame([(1, TEXT), (2, None), (3, "")], "page_id long, content string")).cache()
    got = [(r.node_id, r.parent_id, r.kind, r.name) for r in rows.orderBy("node_id").collect()]
    assert got == [
        (1, 0, "LEVEL2", "H"), (2, 0, "TEMPLATE", "a"), (3, 2, "LINK", "B"), (4, 2, "TEMPLATE", "d"), (5, 0, "BOLD", ""), (6, 5, "ITALIC", ""), (7, 0, "HTML", "div"), (8, 7, "HTML", "br"), (9, 7, "LINK", "E"),
        (10, 0, "LIST_ITEM", "*"), (11, 0, "LIST_ITEM", "**"), (12, 11, "TEMPLATE", "t"), (13, 0, "TABLE", ""), (14, 13, "TEMPLATE_ARG", "1"), (15, 0, "MAGIC_WORD", "TOC"), (16, 0, "URL", "http://q.z"), (17, 0, "URL", "http://w.e"), (18, 0, "HTML", "ref"),
    ]
    ids = lambda df: sorted(r.node_id for r in df.collect())
    assert ids(nodes.children(rows, ["TEMPLATE", "LINK"])) == [2]
    assert 2 not in ids(nodes.children(rows, ["TEMPLATE"], invert=True))
    assert ids(nodes.inside(rows, rows.filter("node_id = 7"))) == [8, 9]
    assert ids(nodes.containing(rows, ["LINK"])) == [2, 7]
    assert ids(nodes.html(rows, "div", {"class": "w"})) == [7] and ids(nodes.html(rows, "div", {"class": "zz"})) == []
    assert {r.name: list(r.args) for r in nodes.template_calls(rows).collect()} == {"a": ["[[B|c]]", "k={{d}}"], "d": [], "t": []}
    rows.unpersist()


def test_template_parameters(spark):
    cases = {
        "{{foo|bar||z|1-1/2|}}": [("1", "bar"), ("2", ""), ("3", "z"), ("4", "1-1/2"), ("5", "")],
        "{{\nfoo\n|\nname=testi|bar\n|\nbaz}}": [("name", "testi"), ("1", "bar\n"), ("2", "\nbaz")],
        "{{e|lang= fr |{{b|M}}. ''x=y''|source={{w|G}}, ''{{w|H = I}}'', 1892}}": [("lang", "fr"), ("1", "{{b|M}}. ''x=y''"), ("source", "{{w|G}}, ''{{w|H = I}}'', 1892")],
        "{{lien|1=L1 = L2|empty= |[[A|b=c]]|x=1|x=2}}": [("1", "L1 = L2[[A|b=c]]"), ("x", "12")],
        "{{m|mul|{}}": [("1", "mul"), ("2", "{")],
        "{{m|<nowiki>a|b=c</nowiki>|<!-- d|e -->f|{{{1|g}}}}}": [("1", "<nowiki>a|b=c</nowiki>"), ("2", "f"), ("3", "{{{1|g}}}")],
        "{{m}}": [],
    }
    assert {call: nodes.parameters(call) for call in cases} == cases
    pages = spark.createDataFrame([(1, "{{Template:A|x|k={{d}}}} {{#if:y|z}} {{lc:Q|r}}")], "page_id long, content string")
    rows = nodes.template_parameters(nodes.node_rows(pages)).orderBy("node_id", "parameter").collect()
    assert [(r.name, r.parameter, r.value) for r in rows] == [("A", "1", "x"), ("A", "k", "{{d}}"), ("d", None, None)]


def test_functions_of_the_store(spark):
    ensure_checkpoints(spark)
    bodies = spark.createDataFrame([("P", "x<section begin=s/>in<section end=s/>y"), ("MediaWiki:Hi", "Hello $1"), ("Template:A", "z")], "title string, body string")
    text = "{{#ifexist:P|y|n}}{{#ifexist:Q|y|n}} {{PAGESIZE:P}} {{#lst:P|s}} {{int:Hi|Bob}} {{int:nope}} {{NUMBEROFPAGES}} {{NUMBEROFARTICLES}}"
    made = expand.expand(spark.createDataFrame([(1, text, "T")], "k int, t string, p string"), bodies, "k", "t", "p")
    assert made.first().expanded == "yn 38 in Hello Bob ⧼Nope⧽ 3 1"


def test_expansion_broadcasts_no_texts(spark, monkeypatch):
    """Texts that are much alike make small files, by which Spark would take them for small enough to be collected by the driver."""
    ensure_checkpoints(spark)
    plans, write = [], expand.cut

    def recorded(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(expand, "cut", recorded)
    bodies = spark.createDataFrame([("Template:A", "z{{b}}")], "title string, body string")
    texts = spark.createDataFrame([(i, "{{a}}", "T") for i in range(20)], "k int, t string, p string")
    made = expand.expanded_text(texts, bodies, "k", "t", "p")
    assert {r.expanded for r in made.collect()} == {"z[[:Template:b]]"}
    joins = [line for plan in [*plans, made._jdf.queryExecution().executedPlan().toString()] for line in plan.split("\n") if "Join [k#" in line]
    assert len(joins) > 2 and all("SortMergeJoin" in line for line in joins), joins


def test_library(spark):
    cases = {
        library.trim("'  a '"): "a",
        library.trim("'--a-'", "-"): "a",
        library.split("'a.b'", ".", plain=True): ["a", "b"],
        library.split("'abc'", ""): ["a", "b", "c"],
        library.truncate("'abcdef'", 3): "abc...",
        library.truncate("'abcdef'", -2): "...ef",
        library.truncate("'abc'", 3): "abc",
        library.list_to_text("array('a','b','c')"): "a, b and c",
        library.list_to_text("array('a')"): "a",
        library.nowiki("'[[a]]\\n* b'"): "&#91;&#91;a&#93;&#93;\n&#42; b",
        library.encode("'<a&b>'"): "&lt;a&amp;b&gt;",
        library.decode("'&lt;a&amp;b&gt;'"): "<a&b>",
        library.local_url("'A b'"): "/wiki/A_b",
        library.canonical_url("'A b'"): "https://en.wikipedia.org/wiki/A_b",
        library.query_string("map('b','2 x','a','1')"): "a=1&b=2+x",
        library.plural("2", ["one", "many"]): "many",
        library.plural("1", ["one", "many"]): "one",
        library.is_subpage("'a/b'", "'a'"): True,
        library.anchor("'a b'"): "a_b",
    }
    got = spark.sql("SELECT " + ", ".join(f"{sql} AS c{i}" for i, sql in enumerate(cases))).first()
    assert list(got) == list(cases.values())
    row = spark.sql(f"SELECT {library.url_parts(chr(39) + 'http://h.x/p/q?a=1#f' + chr(39))} AS u, {library.title_parts(chr(39) + 'help:foo/bar_baz' + chr(39))} AS t, {library.duration_intervals('100000')} AS d, {library.parse_query(chr(39) + 'a=1&b&c=x+y' + chr(39))} AS q").first()
    assert tuple(row.u) == ("http", "h.x", "/p/q", "a=1", "f")
    assert tuple(row.t) == (12, "Help", "Foo/bar baz", "Foo", "Foo", "bar baz", True)
    assert row.d.asDict() == {"years": 0, "weeks": 0, "days": 1, "hours": 3, "minutes": 46, "seconds": 40}
    assert [tuple(x) for x in row.q] == [("a", "1"), ("b", None), ("c", "x y")]
