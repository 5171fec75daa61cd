"""Queries over the driver's tables for the operators of this package, each with its SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import library, parserfns
from ..functions.texts import quoted
from ..operators import cleanup, components, expand, hierarchy, links, nodes, sentences, sinks, store, viewer, wikidata
from ..sources.synthetic import wiki_pages, wiki_pages_sql
from ..streaming import incremental
from ..streaming.incremental import last_states
from .folders import checkpoint_folder, ensure_checkpoints

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _decomposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.decomposed(wiki_pages(spark, sf_dir))


# The hierarchy once more in DuckDB SQL. Levels 3 and 4 are all that the synthetic pages have.
_PAGES = f"wiki AS ({wiki_pages_sql()})"
_TRIM = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
_SECTIONS = f"""{_PAGES}, parts AS (
  SELECT revision_id, page_id, page_title, string_split(regexp_replace(content, '(?m)^==([^=](?:.*[^=])?)==\\s*$', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS p
  FROM wiki WHERE model = 'wikitext'
), section AS (
  SELECT revision_id, page_id, page_title, cast(i + 1 AS integer) AS section_no,
    CASE WHEN i = 0 THEN 'Summary' ELSE trim(string_split(p[i + 1], chr(2))[1]) END AS toc,
    CASE WHEN i > 0 THEN '==' || string_split(p[i + 1], chr(2))[1] || '==' END AS heading,
    {_TRIM.format("CASE WHEN i = 0 THEN p[1] ELSE string_split(p[i + 1], chr(2))[2] END")} AS text
  FROM parts, unnest(range(len(p))) u(i)
)"""
_PARAGRAPHS = f"""{_SECTIONS}, piece AS (
  SELECT revision_id, page_id, page_title, section_no, toc AS root,
    flatten(list_transform(string_split_regex(text, '\\n[ \\t]*(?:\\n[ \\t]*)+'), lambda b: string_split(
      regexp_replace(regexp_replace({_TRIM.format("b")}, '(?m)^====[ \\t]*([^=\\r\\n].*?)[ \\t]*====[ \\t]*$', chr(1) || '4' || '\\1' || chr(2), 'g'),
        '(?m)^===[ \\t]*([^=\\r\\n].*?)[ \\t]*===[ \\t]*$', chr(1) || '3' || '\\1' || chr(2), 'g'), chr(1)))) AS q
  FROM section
), chunk AS (
  SELECT revision_id, page_id, page_title, section_no, i,
    CASE WHEN contains(q[i + 1], chr(2)) THEN {_TRIM.format("string_split(q[i + 1], chr(2))[2]")} ELSE {_TRIM.format("q[i + 1]")} END AS text,
    list_reduce(list_transform(list_filter(q[1:i + 1], lambda x: contains(x, chr(2))), lambda x: string_split(x, chr(2))[1]), lambda a, x:
      array_to_string(list_append(string_split(a, ':')[1:cast(x[1] AS integer) - 2], x[2:]), ':'), root) AS toc
  FROM piece, unnest(range(len(q))) u(i)
), paragraph AS (
  SELECT revision_id, page_id, page_title, section_no, cast(row_number() OVER (PARTITION BY revision_id, section_no ORDER BY i) AS integer) AS paragraph_no, toc, text,
    coalesce(max(CASE WHEN lower(trim(string_split(toc, ':')[1])) IN ({", ".join(quoted(r) for r in hierarchy.SKIPPED_ROOTS)}) THEN 1 ELSE 0 END)
      OVER (PARTITION BY revision_id ORDER BY section_no, i ROWS UNBOUNDED PRECEDING), 0) = 1 AS skipped_part
  FROM chunk WHERE text <> ''
)"""


@query("sections", f"WITH {_SECTIONS} SELECT revision_id, page_id, page_title, section_no, toc, text AS raw_text, text FROM section")
def _sections(spark, sf):
    return hierarchy.section_rows(_decomposed(spark, sf))


@query("section_counts", f"WITH {_SECTIONS} SELECT toc, count(*) AS n, max(section_no) AS last_no FROM section GROUP BY toc")
def _section_counts(spark, sf):
    return hierarchy.section_rows(_decomposed(spark, sf)).groupBy("toc").agg(F.count("*").alias("n"), F.max("section_no").alias("last_no"))


@query("paragraphs", f"WITH {_PARAGRAPHS} SELECT * FROM paragraph")
def _paragraphs(spark, sf):
    return hierarchy.paragraph_rows(_decomposed(spark, sf))


@query("toc_path", f"WITH {_PARAGRAPHS} SELECT toc, count(*) AS n FROM paragraph GROUP BY toc")
def toc_path(spark, sf):
    return hierarchy.paragraph_rows(_decomposed(spark, sf)).groupBy("toc").agg(F.count("*").alias("n"))


@query("skip_latch", f"WITH {_PARAGRAPHS} SELECT page_id, count(*) AS n, count(CASE WHEN skipped_part THEN 1 END) AS skipped FROM paragraph GROUP BY page_id")
def _skip_latch(spark, sf):
    return hierarchy.paragraph_rows(_decomposed(spark, sf)).groupBy("page_id").agg(F.count("*").alias("n"), F.count(F.when(F.col("skipped_part"), 1)).alias("skipped"))


@query(
    "text_process",
    f"""WITH {_SECTIONS} SELECT page_id, string_agg(CASE WHEN heading IS NULL THEN text WHEN text = '' THEN heading ELSE heading || chr(10) || chr(10) || text END, chr(10) || chr(10) ORDER BY section_no) AS text_process
    FROM section GROUP BY page_id UNION ALL SELECT page_id, content FROM wiki WHERE model <> 'wikitext'""",
)
def _text_process(spark, sf):
    return _decomposed(spark, sf).select("page_id", "text_process")


@query(
    "namespace_filter",
    f"WITH {_PAGES} SELECT namespace, model, count(*) AS n, sum(length(content)) AS chars FROM wiki WHERE namespace IN (0, 10) AND model = 'wikitext' GROUP BY namespace, model",
)
def _namespace_filter(spark, sf):
    rows = wiki_pages(spark, sf).filter(F.col("namespace").isin(0, 10) & (F.col("model") == "wikitext"))
    return rows.groupBy("namespace", "model").agg(F.count("*").alias("n"), F.sum(F.length("content")).alias("chars"))


@query(
    "wikilink_format",
    f"""WITH {_PAGES} SELECT page_id, regexp_replace(content, '\\[\\[\\s*([^\\[\\]|\\s](?:[^\\[\\]|]*[^\\[\\]|\\s])?)\\s*\\|\\s*([^\\[\\]|\\s](?:[^\\[\\]|]*[^\\[\\]|\\s])?)\\s*\\]\\]', chr(4) || '\\2↓\\1]]', 'g').replace('[[', chr(5)).replace(chr(4), '[[')
      .regexp_replace(chr(5) || '\\s*([^\\[\\]|\\s](?:[^\\[\\]|]*[^\\[\\]|\\s])?)\\s*\\]\\]', '[[\\1↓\\1]]', 'g').replace(chr(5), '[[') AS text FROM wiki""",
)
def _wikilinks(spark, sf):
    return wiki_pages(spark, sf).select("page_id", F.expr(links.format_wikilinks("content")).alias("text"))


@query(
    "component_counts",
    """WITH lines AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE doc_id % 10 <> 8), n AS (SELECT doc_id, len(l) AS n FROM lines),
    marks AS (SELECT doc_id, i FROM n, unnest(range(2, cast(n AS integer) + 1)) u(i))
    SELECT type, count(*) AS n FROM (
      SELECT 'infobox' AS type FROM n UNION ALL SELECT 'ref' FROM n UNION ALL SELECT 'wikilinks' FROM n UNION ALL SELECT 'wikilinks' FROM n
      UNION ALL SELECT 'external_links' FROM marks WHERE i % 5 = 0 UNION ALL SELECT 'file' FROM marks WHERE i % 7 = 0 AND i % 5 <> 0) GROUP BY type""",
)
def _component_counts(spark, sf):
    pages = hierarchy.with_sections(wiki_pages(spark, sf).filter("model = 'wikitext'"))
    return components.component_rows(components.with_components(pages)).groupBy("type").agg(F.count("*").alias("n"))


@query("component_ids", "SELECT doc_id AS page_id, 'infobox-' || doc_id || '-0001' AS component_id, '{{Infobox doc' || chr(10) || '| id = ' || doc_id || chr(10) || '}}' AS component_text FROM documents WHERE doc_id % 10 <> 8")
def _component_ids(spark, sf):
    pages = hierarchy.with_sections(wiki_pages(spark, sf).filter("model = 'wikitext'"))
    return components.component_rows(components.with_components(pages), "infobox").drop("type")


@query("restore_sources", f"""WITH {_SECTIONS} SELECT page_id, section_no, regexp_replace(text, '<!-- hidden -->', '', 'g') AS text FROM section""")
def _restore(spark, sf):
    pages = hierarchy.with_sections(wiki_pages(spark, sf).filter("model = 'wikitext'"))
    done = components.with_components(pages).select("page_id", F.expr(f"transform(sections, s -> struct(s.section_no AS section_no, {components.restored('s.text')} AS text))").alias("s"))
    return done.select("page_id", F.inline_outer("s"))


_MARKS = """marks AS (SELECT doc_id, i FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) u(i))"""


@query(
    "node_table",
    f"""WITH {_MARKS} SELECT kind, cast(depth AS integer) AS depth, count(*) AS n FROM (
      SELECT 'TEMPLATE' AS kind, 1 AS depth FROM documents UNION ALL SELECT 'TEMPLATE', 1 FROM marks WHERE i > 1 AND i % 5 = 0
      UNION ALL SELECT 'LINK', 1 FROM documents UNION ALL SELECT 'LINK', 1 FROM documents UNION ALL SELECT 'LINK', 2 FROM documents
      UNION ALL SELECT 'LINK', 1 FROM marks WHERE i > 1 AND i % 7 = 0 AND i % 5 <> 0 UNION ALL SELECT 'BOLD', 1 FROM marks WHERE i > 1 AND i % 7 = 0 AND i % 5 <> 0
      UNION ALL SELECT 'URL', 1 FROM marks WHERE i > 1 AND i % 5 = 0 UNION ALL SELECT 'HTML', 1 FROM documents
      UNION ALL SELECT 'LEVEL2', 1 FROM documents UNION ALL SELECT 'LEVEL2', 1 FROM documents UNION ALL SELECT 'LEVEL2', 1 FROM marks WHERE i > 1 AND i % 3 = 0
      UNION ALL SELECT 'LEVEL3', 1 FROM marks WHERE i > 1 AND i % 3 = 1 UNION ALL SELECT 'LEVEL4', 1 FROM marks WHERE i > 1 AND i % 6 = 5
      UNION ALL SELECT 'LIST_ITEM', 1 FROM documents, unnest(range(4)) u(k)) GROUP BY kind, depth""",
)
def _nodes(spark, sf):
    return nodes.node_rows(wiki_pages(spark, sf)).groupBy("kind", "depth").agg(F.count("*").alias("n"))


@query("find_nodes", "SELECT doc_id AS page_id, 'LIST_ITEM' AS kind, '*' AS name, '* one [[' || lang || ']]' AS text FROM documents")
def _find(spark, sf):
    return nodes.containing(nodes.node_rows(wiki_pages(spark, sf)).filter("kind IN ('LIST_ITEM', 'LINK')"), ["LINK"]).select("page_id", "kind", "name", "text")


@query(
    "template_parameters",
    f"""WITH {_MARKS} SELECT doc_id AS page_id, 'Infobox doc' AS name, 'id' AS parameter, cast(doc_id AS varchar) AS value FROM documents
      UNION ALL SELECT doc_id, 'note', '1', cast(i AS varchar) FROM marks WHERE i > 1 AND i % 5 = 0""",
)
def _parameters(spark, sf):
    return nodes.template_parameters(nodes.node_rows(wiki_pages(spark, sf))).select("page_id", "name", "parameter", "value")


@query(
    "text_library",
    """SELECT p_partkey, CASE WHEN length(p_name) <= 6 THEN p_name ELSE substr(p_name, 1, 6) || '...' END AS a, replace(replace(p_brand, '#', '%23'), ' ', '_') AS b,
    string_split(p_type, ' ') AS c, array_to_string(string_split(p_type, ' ')[1:len(string_split(p_type, ' ')) - 1], ', ') || CASE WHEN len(string_split(p_type, ' ')) > 1 THEN ' and ' ELSE '' END || string_split(p_type, ' ')[-1] AS d FROM part""",
)
def _library(spark, sf):
    parts = library.split("p_type", " ")
    return table(spark, sf, "part").select(
        "p_partkey", F.expr(library.truncate("p_name", 6)).alias("a"), F.expr(library.partial_url("p_brand")).alias("b"), F.expr(parts).alias("c"), F.expr(library.list_to_text(parts)).alias("d")
    )


@query("sentences")
def _sentences(spark, sf):
    return sentences.sentence_rows(_decomposed(spark, sf))


@query("list_render", "SELECT doc_id AS page_id, 'one [[' || lang || ']]: (two,three); four.' AS phrase FROM documents")
def _list_render(spark, sf):
    lists = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), F.concat(F.lit("* one [["), "lang", F.lit("]]\n** two; \n** three.\n* four")).alias("t"))
    return lists.select("page_id", sentences._folded("t").alias("phrase"))


@query(
    "sentence_numbers",
    """WITH s AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
    c AS (SELECT doc_id, line_no, unnest(string_split(regexp_replace(line, '\\.\\s+', '.' || chr(1), 'g'), chr(1))) AS x, generate_subscripts(string_split(regexp_replace(line, '\\.\\s+', '.' || chr(1), 'g'), chr(1)), 1) AS k FROM s)
    SELECT doc_id, cast(line_no AS integer) AS line_no, cast(row_number() OVER (PARTITION BY doc_id ORDER BY line_no, k) AS integer) AS sentence_no, x AS text FROM c WHERE trim(x) <> ''""",
)
def _sentence_numbers(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("l", "line"))
    cut = rows.select("doc_id", (F.col("l") + 1).alias("line_no"), F.posexplode(F.split(F.regexp_replace("line", r"\.\s+", ".\x01"), "\x01")).alias("k", "text")).filter(F.trim("text") != "")
    from pyspark.sql import Window

    return cut.select("doc_id", "line_no", F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no", "k")).alias("sentence_no"), "text")


@query("ref_placeholder_drop", "SELECT doc_id AS page_id, text || ' .' AS text FROM documents")
def _refs(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), F.concat("text", F.lit(" ♣  ♣  ♣  REF-1-0001♣  ♣  ♣.")).alias("t"))
    return rows.select("page_id", F.expr(links.drop_ref_placeholders("t")).alias("text"))


_HTML = [
    "(?s)<!--.*?-->",
    "(?is)<style\\b[^>]*>.*?</style\\s*>",
    "(?is)<script\\b[^>]*>.*?</script\\s*>",
]


_ENTITIES = {"nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "ndash": "–", "mdash": "—", "hellip": "…", "middot": "·", "copy": "©", "amp": "&"}


def _visible_sql() -> str:
    text = "html"
    for pattern in _HTML:
        text = f"regexp_replace({text}, '{pattern}', '', 'g')"
    text = f"replace(replace({text}, chr(39) || chr(39) || chr(39), ''), chr(39) || chr(39), '')"
    text = f"regexp_replace({text}, '(?i)</?(?:{'|'.join(cleanup.BLOCKS)})(?:\\s[^>]*)?/?>|<br(?:\\s[^>]*)?/?>', chr(10), 'g')"
    text = f"regexp_replace(regexp_replace({text}, '<![^>]*>', '', 'g'), '</?[A-Za-z][^>]*>', '', 'g')"
    for name, char in _ENTITIES.items():
        text = f"replace({text}, '&{name};', chr({ord(char)}))"
    text = f"regexp_replace({text}, '[ \\t\\x{{A0}}]+', ' ', 'g')"
    text = f"regexp_replace({text}, '[ \\t]*\\n[ \\t]*', chr(10), 'g')"
    text = f"regexp_replace({text}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"SELECT page_id, {_TRIM.format(text)} AS text FROM pages"


@query("visible_text", _visible_sql())
def _visible(spark, sf):
    return cleanup.visible_text(table(spark, sf, "pages"), "html", "text").select("page_id", "text")


@query("title_extract", "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def _title(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query("page_url", "SELECT p_partkey, 'https://en.wikipedia.org/wiki/' || replace(p_name, ' ', '_') AS url FROM part")
def _url(spark, sf):
    return table(spark, sf, "part").select("p_partkey", links.page_url(F.col("p_name")).alias("url"))


_STORE = """store AS (SELECT 'T' || doc_id AS title, 10 AS namespace_id, CASE WHEN first <> doc_id THEN 'T' || first END AS redirect_to, text AS body FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first FROM documents))"""


def _store(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    first = docs.groupBy("text").agg(F.min("doc_id").alias("first"))
    return docs.join(first, "text").selectExpr("concat('T', doc_id) AS title", "10 AS namespace_id", "CASE WHEN first <> doc_id THEN concat('T', first) END AS redirect_to", "text AS body")


@query("redirect_resolve", f"WITH {_STORE} SELECT s.title AS title, CASE WHEN s.redirect_to IS NULL THEN s.title ELSE t.title END AS target FROM store s LEFT JOIN store t ON s.redirect_to = t.title AND s.namespace_id = t.namespace_id AND t.redirect_to IS NULL")
def _redirects(spark, sf):
    return store.resolve_redirects(_store(spark, sf)).select("title", "target")


@query("redirect_double_hop_null", "SELECT 'D' || doc_id AS title, CASE WHEN doc_id % 3 = 1 THEN 'D' || (doc_id - 1) WHEN doc_id % 3 = 0 THEN 'D' || doc_id END AS target FROM documents WHERE doc_id >= 0")
def _double_hop(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("concat('D', doc_id) AS title", "0 AS namespace_id", "IF(doc_id % 3 > 0, concat('D', doc_id - 1), NULL) AS redirect_to", "text AS body")
    return store.resolve_redirects(rows).select("title", "target")


@query(
    "store_counts",
    f"WITH {_PAGES} SELECT count(*) AS pages, count(CASE WHEN namespace = 0 AND redirect_to IS NULL THEN 1 END) AS articles FROM wiki",
)
def _store_counts(spark, sf):
    return store.counts(store.store_rows(wiki_pages(spark, sf)))


@query("store_rows", f"WITH {_PAGES} SELECT CASE namespace WHEN 10 THEN 'Template:' WHEN 828 THEN 'Module:' ELSE '' END || page_title AS title, namespace AS namespace_id, CASE WHEN redirect_to IS NULL THEN CASE WHEN namespace = 10 THEN regexp_replace(content, '<!-- hidden -->', '', 'g') ELSE content END END AS body FROM wiki")
def _store_rows(spark, sf):
    return store.store_rows(wiki_pages(spark, sf)).select("title", "namespace_id", "body")


@query("page_lookup", "SELECT doc_id, 'Doc ' || doc_id AS title FROM documents")
def _lookup(spark, sf):
    pages = store.store_rows(wiki_pages(spark, sf)).withColumn("title", F.regexp_replace("title", "^(Template|Module):", ""))
    wanted = table(spark, sf, "documents").selectExpr("doc_id", "concat('doc_', doc_id) AS wanted")
    return store.lookup(wanted, pages).select("doc_id", "page.title")


@query("template_body", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN text || 'inc' ELSE 'a' || text END AS body FROM documents")
def _body(spark, sf):
    made = F.expr("IF(doc_id % 2 = 0, concat(text, '<noinclude>docs</noinclude><includeonly>inc</includeonly><!-- x -->'), concat('out<onlyinclude>a</onlyinclude>side<onlyinclude>', text, '</onlyinclude>'))")
    rows = table(spark, sf, "documents").select("doc_id", made.alias("t"))
    return rows.select("doc_id", F.expr(cleanup.template_body("t")).alias("body"))


@query(
    "template_expand",
    "SELECT doc_id, 'See [' || source || '/' || lang || '/x] and ' || upper(lang) || ' ' || CASE WHEN lang = 'en' THEN 'yes' ELSE 'no' END || ' [[:Template:Missing]] <' || text || '>' AS expanded FROM documents",
)
def _expand(spark, sf):
    ensure_checkpoints(spark)
    bodies = spark.createDataFrame([("Template:Pair", "[{{{1}}}/{{{b}}}/{{{c|x}}}]"), ("Template:Deep", "{{pair|{{{1}}}|b={{{2}}}}} and {{uc:{{{2}}}}}")], "title string, body string")
    call = "concat('See {{Deep|', source, '|', lang, '}} {{#ifeq:', lang, '|en|yes|no}} {{Missing}} <', text, '>')"
    texts = table(spark, sf, "documents").selectExpr("doc_id", f"{call} AS body", "'Page' AS title")
    return expand.expand(texts, bodies, "doc_id", "body", "title")


_CLOSURE = """WITH RECURSIVE edges AS (SELECT doc_id AS includer, doc_id // 2 AS included FROM documents WHERE doc_id > 0),
up AS (SELECT doc_id AS t FROM documents WHERE doc_id IN (5, 12) UNION SELECT e.includer FROM edges e JOIN up ON e.included = up.t) SELECT 'T' || t AS title FROM up"""


@query("preexpand_closure", _CLOSURE)
def _closure(spark, sf):
    ensure_checkpoints(spark)
    docs = table(spark, sf, "documents")
    edges = docs.filter("doc_id > 0").selectExpr("concat('T', doc_id) AS includer", "concat('T', doc_id div 2) AS included")
    return store.closure(edges, docs.filter("doc_id IN (5, 12)").selectExpr("concat('T', doc_id) AS title"))


@query("latest_revision", "SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) WHERE r = 1")
def _latest(spark, sf):
    return sinks.latest_per_key(table(spark, sf, "conversations").select("conv_id", "turn", "role", "text"), ["conv_id"], "turn")


@query("latest_content", "SELECT conv_id AS page_id, turn AS revision_id, text AS content FROM conversations WHERE conv_id = 3 ORDER BY turn DESC LIMIT 1")
def _latest_content(spark, sf):
    return viewer.latest_content(table(spark, sf, "conversations").selectExpr("conv_id AS page_id", "turn AS revision_id", "text AS content"), 3)


@query("upsert_latest", "SELECT conv_id, turn, CASE WHEN turn % 2 = 1 THEN 'new ' || text ELSE text END AS text FROM conversations")
def _upsert(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return sinks.upsert(rows, rows.filter("turn % 2 = 1").withColumn("text", F.concat(F.lit("new "), "text")), ["conv_id", "turn"])


@query("replace_by_key", "SELECT doc_id, source FROM documents WHERE source NOT IN ('src1', 'src2') UNION ALL SELECT doc_id, source FROM documents WHERE source = 'src1' AND doc_id % 2 = 0")
def _replace(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source")
    touched = rows.filter("source IN ('src1', 'src2')").select("source")
    return sinks.replace_by_key(rows, rows.filter("source = 'src1' AND doc_id % 2 = 0"), touched, ["source"])


@query("insert_missing", "SELECT doc_id, lang FROM documents")
def _insert(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang")
    return sinks.insert_missing(rows.filter("doc_id % 3 = 0"), rows, ["doc_id"])


@query("unique_keys", "SELECT text, count(*) AS count FROM documents GROUP BY text HAVING count(*) > 1")
def _unique(spark, sf):
    return sinks.duplicated_keys(table(spark, sf, "documents"), ["text"])


def _checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    marks = table(spark, sf, "labels").selectExpr("doc_id AS revision_id", "doc_id AS page_id", "IF(quality = 0, 'bad', NULL) AS parse_error")
    return sinks.terminal_records(marks, "s")


@query("checkpoint_status", "SELECT 's' AS source_id, doc_id AS revision_id, doc_id AS page_id, CASE WHEN quality = 0 THEN 'completed_with_errors' ELSE 'completed' END AS status FROM labels")
def _status(spark, sf):
    return _checkpoint(spark, sf)


@query("resume_anti", "SELECT doc_id AS revision_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _resume(spark, sf):
    return sinks.resume(table(spark, sf, "documents").select(F.col("doc_id").alias("revision_id")), _checkpoint(spark, sf), "s")


@query("resume_retry_errors", "SELECT doc_id AS revision_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality <> 0)")
def _retry(spark, sf):
    return sinks.resume(table(spark, sf, "documents").select(F.col("doc_id").alias("revision_id")), _checkpoint(spark, sf), "s", retry_errors=True)


_RUN = f"{_PARAGRAPHS}, done AS (SELECT *, CASE WHEN page_id % 7 = 3 AND NOT skipped_part THEN 'expansion x' END AS parse_error FROM paragraph)"


def _run(spark: SparkSession, sf: str) -> DataFrame:
    rows = hierarchy.paragraph_rows(_decomposed(spark, sf))
    return rows.withColumn("parse_error", F.when((F.col("page_id") % 7 == 3) & ~F.col("skipped_part"), "expansion x"))


@query("run_stats", f"WITH {_RUN} SELECT count(*) AS total, count(CASE WHEN parse_error IS NULL THEN 1 END) AS succeeded, count(parse_error) AS failed FROM done WHERE NOT skipped_part")
def _stats(spark, sf):
    return viewer.run_stats(_run(spark, sf))


@query("parse_error_report", f"WITH {_RUN} SELECT revision_id, page_id, page_title, 'paragraph_errors=' || count(parse_error) AS parse_error FROM done GROUP BY revision_id, page_id, page_title HAVING count(parse_error) > 0")
def _report(spark, sf):
    bad = _run(spark, sf).groupBy("revision_id", "page_id", "page_title").agg(F.count("parse_error").alias("n"))
    return viewer.failed_revisions(bad.withColumn("parse_error", F.when(F.col("n") > 0, F.concat(F.lit("paragraph_errors="), F.col("n").cast("string")))))


@query(
    "expansion_join",
    f"WITH {_RUN} SELECT revision_id, page_id, section_no, paragraph_no, toc, text AS expansion_input, concat('x ', text) AS expanded_wikitext, text, parse_error FROM done WHERE NOT skipped_part",
)
def _expansion_join(spark, sf):
    rows = _run(spark, sf)
    middle = rows.filter("NOT skipped_part").selectExpr("revision_id", "page_id", "section_no", "paragraph_no", "toc", "text AS expansion_input", "concat('x ', text) AS expanded_wikitext", "parse_error")
    return viewer.intermediate_with_paragraphs(middle, rows)


@query("paragraph_lookup", f"WITH {_PARAGRAPHS} SELECT * FROM paragraph WHERE page_id = 4 ORDER BY section_no, paragraph_no")
def _paragraph_lookup(spark, sf):
    return viewer.page_paragraphs(hierarchy.paragraph_rows(_decomposed(spark, sf)), 4)


@query("sentence_lookup")
def _sentence_lookup(spark, sf):
    return viewer.page_sentences(sentences.sentence_rows(_decomposed(spark, sf)), 4)


@query("neighbor_page", "SELECT max(CASE WHEN page_id < 20 THEN page_id END) AS previous, min(CASE WHEN page_id > 20 THEN page_id END) AS next FROM pages")
def _neighbours(spark, sf):
    return viewer.neighbours(table(spark, sf, "pages"), 20)


@query("page_bounds", "SELECT min(page_id) AS first, max(page_id) AS last FROM pages")
def _bounds(spark, sf):
    return viewer.bounds(table(spark, sf, "pages"))


@query("random_probe", "SELECT p.point AS point, coalesce((SELECT min(page_id) FROM pages WHERE page_id >= p.point), (SELECT min(page_id) FROM pages)) AS page_id FROM (VALUES (CAST(0 AS BIGINT)), (17), (49), (1000000)) p(point)")
def _probe(spark, sf):
    return viewer.probes(table(spark, sf, "pages"), [0, 17, 49, 1_000_000])


@query(
    "statement_cache",
    """SELECT 'Q' || s_suppkey AS item_id, 'P' || n_regionkey AS property, n_name AS value, s_name AS item_label FROM supplier JOIN nation ON s_nationkey = n_nationkey
    UNION ALL SELECT 'Q' || s_suppkey, r_name, n_name, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'Q' || s_suppkey, 'P99', NULL, NULL FROM supplier""",
)
def _statements(spark, sf):
    supplier, nation, region = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    items = supplier.selectExpr("concat('Q', s_suppkey) AS id", "s_name AS label", "cast(NULL as string) AS description")
    properties = region.selectExpr("concat('P', r_regionkey) AS id", "r_name AS label", "'string' AS datatype")
    values = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).selectExpr("n_name AS value", "concat('Q', s_suppkey) AS item_id", "concat('P', n_regionkey) AS property_id")
    by_id = values.selectExpr("item_id", "property_id AS property")
    by_name = values.join(properties.selectExpr("id AS property_id", "label AS property"), "property_id").select("item_id", "property")
    none = items.selectExpr("id AS item_id", "'P99' AS property")
    return wikidata.statements(by_id.unionByName(by_name).unionByName(none), values, items, properties).drop("item_description")


@query("entity_fields", "SELECT event_id, props->>'$.k' AS v FROM events")
def _entities(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.col("props").alias("entity_data"))
    return wikidata.entity_field(rows, "$.k", "v").select("event_id", "v")


@query("stream_resume", "SELECT user_id, ts, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def _stream(spark, sf):
    return last_states(table(spark, sf, "events"))


def _pfn(name: str, source: str, key: str, calls: dict[str, tuple[str, list[str], str]], title: str = "''") -> None:
    """Registers one query of several function calls: column -> (function, SQL of its arguments, DuckDB SQL of the result)."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        made = [F.expr(parserfns.call(f, args, title)).alias(c) for c, (f, args, _) in calls.items()]
        return table(spark, sf, source).select(key, *made)

    QUERIES[name] = run
    ORACLES[name] = f"SELECT {key}, {', '.join(f'{sql} AS {c}' for c, (_, _, sql) in calls.items())} FROM {source}"


_pfn("pfn_case", "part", "p_partkey", {
    "a": ("lc", ["p_name"], "lower(trim(p_name))"), "b": ("uc", ["p_name"], "upper(trim(p_name))"),
    "c": ("ucfirst", ["p_name"], "upper(p_name[1]) || p_name[2:]"), "d": ("lcfirst", ["p_brand"], "lower(p_brand[1]) || p_brand[2:]"),
})
_pfn("pfn_if", "documents", "doc_id", {
    "a": ("#if", ["IF(doc_id % 2 = 0, ' ', lang)", "'y'", "'n'"], "CASE WHEN doc_id % 2 = 0 THEN 'n' ELSE 'y' END"),
    "b": ("#iferror", ["IF(doc_id % 2 = 0, '<b class=\"error\">x</b>', lang)", "'bad'"], "CASE WHEN doc_id % 2 = 0 THEN 'bad' ELSE lang END"),
})
_pfn("pfn_ifeq", "documents", "doc_id", {"a": ("#ifeq", ["lang", "' en '", "'same'", "source"], "CASE WHEN lang = 'en' THEN 'same' ELSE source END")})
_pfn("pfn_switch", "documents", "doc_id", {
    "a": ("#switch", ["lang", "'en=English'", "'de'", "'fr=Other'", "'#default=None'"], "CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'Other' WHEN 'fr' THEN 'Other' ELSE 'None' END"),
})
_pfn("pfn_len_pos_sub", "part", "p_partkey", {
    "a": ("#len", ["p_name"], "cast(length(trim(p_name)) AS varchar)"),
    "b": ("#pos", ["p_name", "'a'"], "CASE WHEN instr(p_name, 'a') > 0 THEN cast(instr(p_name, 'a') - 1 AS varchar) ELSE '' END"),
    "c": ("#sub", ["p_name", "'2'", "'3'"], "substr(p_name, 3, 3)"),
    "d": ("#sub", ["p_name", "'-3'"], "right(p_name, 3)"),
    "e": ("#rpos", ["p_name", "'a'"], "CASE WHEN instr(p_name, 'a') > 0 THEN cast(length(p_name) - instr(reverse(p_name), 'a') AS varchar) ELSE '-1' END"),
})
_pfn("pfn_replace_explode", "part", "p_partkey", {
    "a": ("#replace", ["p_name", "'a'", "'-'"], "replace(p_name, 'a', '-')"),
    "b": ("#explode", ["p_brand", "'#'", "'1'"], "coalesce(string_split(p_brand, '#')[2], '')"),
    "c": ("#explode", ["p_type", "' '", "'-1'"], "string_split(p_type, ' ')[-1]"),
})
_pfn("pfn_pad", "part", "p_partkey", {
    "a": ("padleft", ["cast(p_partkey as string)", "'8'"], "lpad(cast(p_partkey AS varchar), 8, '0')"),
    "b": ("padright", ["cast(p_size as string)", "'6'", "'.'"], "rpad(cast(p_size AS varchar), 6, '.')"),
    "c": ("#pad", ["cast(p_size as string)", "'7'", "'*'", "'right'"], "rpad(cast(p_size AS varchar), 7, '*')"),
})
_pfn("pfn_titleparts", "documents", "doc_id", {
    "a": ("#titleparts", ["concat(lang, '/', source, '/x')", "'2'"], "lang || '/' || source"),
    "b": ("#titleparts", ["concat(lang, '/', source, '/x')", "'1'", "'-1'"], "'x'"),
    "c": ("#titleparts", ["concat(lang, ':', source)", "'1'", "'1'"], "source"),
})
_pfn("pfn_pagename_family", "documents", "doc_id", {
    "a": ("FULLPAGENAME", [], "'Help:' || source || '/' || lang"), "b": ("PAGENAME", [], "source || '/' || lang"), "c": ("BASEPAGENAME", [], "source"), "d": ("ROOTPAGENAME", [], "source"),
    "e": ("SUBPAGENAME", [], "lang"), "f": ("NAMESPACE", [], "'Help'"), "g": ("TALKPAGENAME", [], "'Help talk:' || source || '/' || lang"), "h": ("TALKSPACE", [], "'Help talk'"),
}, "concat('Help:', source, '/', lang)")
_pfn("pfn_urlencode", "part", "p_partkey", {
    "a": ("urlencode", ["concat(p_brand, ' é/', p_type)"], "replace(replace(replace(p_brand || ' é/' || p_type, '#', '%23'), 'é', '%C3%A9'), '/', '%2F').replace(' ', '+')"),
    "b": ("urlencode", ["concat(p_brand, ' é/', p_type)", "'WIKI'"], "replace(replace(p_brand || ' é/' || p_type, '#', '%23'), 'é', '%C3%A9').regexp_replace('\\s+', '_', 'g')"),
    "c": ("localurl", ["p_name"], "'/wiki/' || regexp_replace(p_name, '\\s+', '_', 'g')"),
    "d": ("anchorencode", ["concat(p_name, ' <x>')"], "regexp_replace(p_name, '\\s+', '_', 'g') || '_.3Cx.3E'"),
})
_pfn("pfn_formatnum", "orders", "o_orderkey", {
    "a": ("formatnum", ["cast(o_orderkey * 7919 as string)"], "format('{:,}', o_orderkey * 7919)"),
    "b": ("formatnum", ["concat(cast(o_custkey as string), '.25')"], "format('{:,}', o_custkey) || '.25'"),
    "c": ("formatnum", ["'1,234'"], "'1,234'"),
})
_pfn("pfn_time", "orders", "o_orderkey", {
    "a": ("#time", ["'Y-m-d'", "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')"], "strftime(o_orderdate, '%Y-%m-%d')"),
    "b": ("#time", ["'j F Y'", "date_format(o_orderdate, 'yyyyMMddHHmmss')"], "strftime(o_orderdate, '%-d %B %Y')"),
    "c": ("#time", ["'W D l'", "date_format(o_orderdate, 'MMMM d, yyyy')"], "strftime(o_orderdate, '%V %a %A')"),
    "d": ("#dateformat", ["date_format(o_orderdate, 'd MMMM yyyy')", "'mdy'"], "strftime(o_orderdate, '%B %-d, %Y')"),
})
_pfn("pfn_names", "documents", "doc_id", {
    "a": ("ns", ["cast(doc_id % 15 as string)"], "['', 'Talk', 'User', 'User talk', 'Wikipedia', 'Wikipedia talk', 'File', 'File talk', 'MediaWiki', 'MediaWiki talk', 'Template', 'Template talk', 'Help', 'Help talk', 'Category'][doc_id % 15 + 1]"),
    "b": ("filepath", ["source"], "'//unimplemented/' || source"), "c": ("#isbn", ["source"], "'ISBN ' || source"), "d": ("fullurl", ["source", "'a=b'"], "'//en.wikipedia.org/wiki/' || source || '?a=b'"),
})


@query("pfn_expr", "SELECT l_orderkey, l_linenumber, cast(cast(l_quantity AS bigint) * 3 + l_linenumber AS varchar) AS a, CASE WHEN l_quantity > 25 THEN '1' ELSE '0' END AS b, cast(cast(l_quantity AS bigint) % 7 AS varchar) AS c FROM lineitem")
def _expr(spark, sf):
    q = F.col("l_quantity").cast("long").cast("string")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", parserfns.expr(F.concat(q, F.lit("*3 + "), F.col("l_linenumber").cast("string"))).alias("a"), parserfns.expr(F.concat(q, F.lit(" > 25"))).alias("b"), parserfns.expr(F.concat(q, F.lit(" mod 7"))).alias("c")
    )


# Rows for what the queries above leave out, through the operators themselves.
@query("entities", "SELECT doc_id, lang || ' ’’é€→< q' AS text FROM documents")
def _entities_text(spark, sf):
    deep = "[[File:x|" + "[[n|" * 6 + "y" + "]]" * 7
    rows = table(spark, sf, "documents").select("doc_id", F.concat("lang", F.lit(f" &#8217;&#x2019;&eacute;&euro;&rarr;&amp;lt; {deep}q<ref name='a'>gone</ref>")).alias("t"))
    return cleanup.visible_text(rows, "t", "text").select("doc_id", "text")


_CUT = "['Plain ' || p_name || '.', 'Next ' || p_type || '!', 'Last one']"


@query(
    "sentence_rows",
    f"""WITH s AS (SELECT p_partkey AS page_id, 1 AS section_no, 'Summary' AS toc, {_CUT} || ['Second ' || p_brand || ' [[a↓b]].'] AS x FROM part
      UNION ALL SELECT p_partkey, 2, 'More', ['End?', 'List: one; two.'] FROM part)
    SELECT page_id, cast(section_no AS integer) AS section_no, toc, cast(i AS integer) AS sentence_no, cast(CASE WHEN section_no = 1 AND i = 4 THEN 2 ELSE 1 END AS integer) AS paragraph_no, x[i] AS text
    FROM s, unnest(range(1, len(x) + 1)) u(i)""",
)
def _sentence_rows(spark, sf):
    body = "concat('Plain ', p_name, '. Next ', p_type, '! Last one\\n\\nSecond ', p_brand, ' [[b|a]].\\n== More ==\\nEnd? List:\\n\\n* one\\n* two\\n== References ==\\nNo. Not this.')"
    # a small file holds many pages: its narrow rows are dealt to all tasks before pages are made of them
    parts = table(spark, sf, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    pages = parts.selectExpr("p_partkey AS revision_id", "p_partkey AS page_id", "p_name AS page_title", "'wikitext' AS model", f"{body} AS content")
    return sentences.sentence_rows(hierarchy.decomposed(pages)).select("page_id", "section_no", "toc", "sentence_no", "paragraph_no", "text")


@query("batch_repeat", f"""WITH {_PARAGRAPHS}, p AS (SELECT page_id, count(*) AS paragraphs FROM paragraph GROUP BY page_id), w AS (SELECT DISTINCT page_id FROM wiki)
SELECT w.page_id, coalesce(p.paragraphs, 0) AS paragraphs, 1 AS checkpoints FROM w LEFT JOIN p ON w.page_id = p.page_id""")
def _batch_repeat(spark, sf):
    """A batch that is written again under its name changes nothing."""
    folder = f"{checkpoint_folder(spark)}/repeat-{uuid.uuid4().hex}"
    for _ in range(2):
        incremental.write_batch(wiki_pages(spark, sf), folder, "dump", "0")
    log = incremental.log(spark, folder)
    rows = log.read("paragraphs").groupBy("page_id").agg(F.count("*").alias("paragraphs"))
    marks = log.every("checkpoint").groupBy("page_id").agg(F.count("*").cast("int").alias("checkpoints"))
    return marks.join(rows, "page_id", "left").select("page_id", F.coalesce("paragraphs", F.lit(0)).cast("long").alias("paragraphs"), "checkpoints")


@query("dump_job", f"""WITH {_PARAGRAPHS}, p AS (SELECT page_id, count(*) AS paragraphs, count(CASE WHEN NOT skipped_part THEN 1 END) AS expanded FROM paragraph GROUP BY page_id),
    s AS (SELECT page_id, count(*) AS sections FROM section GROUP BY page_id), w AS (SELECT page_id, revision_id FROM wiki)
    SELECT w.page_id AS page_id, coalesce(sections, 0) AS sections, coalesce(paragraphs, 0) AS paragraphs, coalesce(expanded, 0) AS expanded, 'completed' AS status
    FROM w LEFT JOIN s ON w.page_id = s.page_id LEFT JOIN p ON w.page_id = p.page_id""")
def _dump_job(spark, sf):
    """Written by two batches, an older revision of some pages coming second, and read from the tables."""
    folder = f"{checkpoint_folder(spark)}/dump-{uuid.uuid4().hex}"
    pages = wiki_pages(spark, sf)
    templates = spark.createDataFrame([("Template:Note", "note {{{1}}}")], "title string, body string")
    incremental.write_batch(pages, folder, "dump", "0", templates)
    older = pages.filter("page_id % 3 = 0").withColumn("revision_id", F.col("revision_id") - 1).withColumn("content", F.lit("older"))
    incremental.write_batch(older, folder, "dump", "1", templates)
    log = incremental.log(spark, folder)
    count = lambda name, to: log.read(name).groupBy("page_id").agg(F.count("*").alias(to))
    found = log.read("checkpoint").select("page_id", "status")
    for name, to in (("sections", "sections"), ("paragraphs", "paragraphs"), ("intermediate", "expanded")):
        found = found.join(count(name, to), "page_id", "left").withColumn(to, F.coalesce(to, F.lit(0)))
    return found


@query(
    "expand_nested_defaults",
    """SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN lang END, source) || '|' || CASE WHEN doc_id % 3 = 0 THEN lang ELSE '[' || source || ']' END || '|' || coalesce(CASE WHEN doc_id % 3 = 0 THEN lang END, 'q') AS expanded FROM documents""",
)
def _expand_nested_defaults(spark, sf):
    """Defaults that hold parameters, calls and bars in links."""
    ensure_checkpoints(spark)
    rows = [("Template:D", "{{{1|{{{2|z}}}}}}|{{{1|{{W|{{{2}}}}}}}}|{{{1|{{#if:y|q}}}}}"), ("Template:W", "[{{{1}}}]")]
    call = "IF(doc_id % 3 = 0, concat('{{D|', lang, '}}'), concat('{{D|2=', source, '}}'))"
    texts = table(spark, sf, "documents").selectExpr("doc_id", f"{call} AS body", "'Page' AS title")
    return expand.expand(texts, spark.createDataFrame(rows, "title string, body string"), "doc_id", "body", "title")


@query("expand_brace_runs", "SELECT doc_id, '<' || source || '>' || ' a{' || lang || '}c' || ' <' || lang || '>' AS expanded FROM documents")
def _expand_brace_runs(spark, sf):
    """Runs of four and five braces, and braces that stand alone in an argument."""
    ensure_checkpoints(spark)
    rows = [("Template:N", "A"), ("Template:A", "<{{{1}}}>"), ("Template:I", "{{{1}}}"), ("Template:P", "{{{{{1}}}|{{{2}}}}}")]
    call = "concat('{{{{N}}|', source, '}} {{I|a{', lang, '}c}} {{P|A|', lang, '}}')"
    texts = table(spark, sf, "documents").selectExpr("doc_id", f"{call} AS body", "'Page' AS title")
    return expand.expand(texts, spark.createDataFrame(rows, "title string, body string"), "doc_id", "body", "title")


@query("expand_nowiki", "SELECT doc_id, '&#123;&#123;uc:x&#125;&#125; ' || upper(lang) || ' &#91;' || source || '&#93; <nowiki />' AS expanded FROM documents")
def _expand_nowiki(spark, sf):
    ensure_checkpoints(spark)
    call = "concat('<nowiki>{{uc:x}}</nowiki> {{uc:', lang, '}}\\n<!-- {{uc:y}} --> <nowiki>[', source, ']</nowiki> <nowiki/>')"
    texts = table(spark, sf, "documents").selectExpr("doc_id", f"{call} AS body", "'Page' AS title")
    return expand.expand(texts, spark.createDataFrame([], "title string, body string"), "doc_id", "body", "title")


@query(
    "expand_functions",
    """SELECT doc_id, CASE WHEN doc_id % 2 = 1 THEN 'odd' ELSE 'even' END || '|<ref name="a">' || lang || '</ref>|Help:Foo/' || source || '|in|Hello ' || lang || '|' || CASE WHEN doc_id % 3 = 0 THEN 'y' ELSE 'n' END
      || '|' || CASE lang WHEN 'en' THEN 'English' ELSE '' END || '|' || CASE WHEN source = 'src1' THEN 'one' ELSE '' END || '|38|3|1|own' AS expanded FROM documents""",
)
def _expand_functions(spark, sf):
    ensure_checkpoints(spark)
    store_ = spark.createDataFrame([("P", "x<section begin=s/>in<section end=s/>y"), ("MediaWiki:Hi", "Hello $1"), ("Template:A", "z")], "title string, body string")
    calls = ["'{{#ifexpr:', doc_id % 2, '= 1|odd|even}}'", "'{{#tag:ref|', lang, '|name=a}}'", "'{{#rel2abs:../', source, '|Help:Foo/bar}}'", "'{{#lst:P|s}}'", "'{{int:Hi|', lang, '}}'", "'{{#ifexist:', IF(doc_id % 3 = 0, 'P', 'Q'), '|y|n}}'",
             "'{{#language:', lang, '}}'", "'{{#property:P1|from=', source, '}}'", "'{{PAGESIZE:P}}'", "'{{NUMBEROFPAGES}}'", "'{{NUMBEROFARTICLES}}'", "'{{#statements:P2}}'"]
    texts = table(spark, sf, "documents").selectExpr("doc_id", f"concat({', {0}|{0}, '.format(chr(39)).join(calls)}) AS body", "'Page' AS title")
    statements = spark.createDataFrame([("src1", "P1", "one"), ("", "P2", "own")], "item string, property string, value string")
    languages = spark.createDataFrame([("en", "English")], "code string, name string")
    return expand.expand(texts, store_, "doc_id", "body", "title", statements=statements, languages=languages)


@query("expand_notes", "SELECT doc_id, '<strong class=\"error\">Template loop detected: [[:Template:pong]]</strong> [[:Template:' || lang || ']] kept{{raw}}' AS expanded, ['loop pong', 'missing ' || lang] AS notes FROM documents")
def _expand_notes(spark, sf):
    ensure_checkpoints(spark)
    bodies = spark.createDataFrame([("Template:Ping", "{{pong}}"), ("Template:Pong", "{{ping}}")], "title string, body string")
    texts = table(spark, sf, "documents").selectExpr("doc_id", "concat('{{ping}} {{', lang, '}} {{own|x}}{{raw}}') AS body", "'Page' AS title")
    done = expand.expand(texts, bodies, "doc_id", "body", "title", never=["raw"], given="IF(name = 'own', 'kept', NULL)", notes=True)
    return done.select("doc_id", "expanded", F.array_sort(F.transform("notes", lambda n: F.concat_ws(" ", n["kind"], n["name"]))).alias("notes"))


@query(
    "expand_lazy",
    """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '[' || lang || ']' WHEN 1 THEN 'plain ' || source ELSE 'none' END || '|' || CASE WHEN doc_id % 2 = 0 THEN '[a ' || source || ']' ELSE 'odd' END AS expanded, [] :: VARCHAR[] AS notes FROM documents""",
)
def _expand_lazy(spark, sf):
    """Branches not taken are never called: the loop and the missing template leave no note."""
    ensure_checkpoints(spark)
    bodies = spark.createDataFrame([("Template:Loop", "{{loop}}"), ("Template:Box", "[{{{1}}}]"), ("Template:Pick", "{{#switch:{{{1}}}|{{lc:A}}{{{none|}}}={{{2}}}|b={{missing}}|{{loop}}}}")], "title string, body string")
    calls = ["'{{#switch:', doc_id % 3, '|0={{box|', lang, '}}|1={{#if:|{{loop}}|plain {{uc:}}', source, '}}|{{#ifeq:a|b|{{missing}}|none}}}}'", "'|{{#ifexpr:', doc_id % 2, '=0|{{pick|a|[a ', source, ']}}|{{#iferror:odd|{{loop}}}}}}'"]
    texts = table(spark, sf, "documents").selectExpr("doc_id", f"concat({', '.join(calls)}) AS body", "'Page' AS title")
    done = expand.expand(texts, bodies, "doc_id", "body", "title", notes=True)
    return done.select("doc_id", "expanded", F.transform("notes", lambda n: F.concat_ws(" ", n["kind"], n["name"])).alias("notes"))


@query("expand_elements", "SELECT doc_id, '[<b a=\"|\">' || lang || '|x</b>] ' || upper(source) || ' yes [<i>' || lang || ']' AS expanded FROM documents")
def _expand_elements(spark, sf):
    """Bars inside of paired elements cut no arguments, those behind a tag without an end do; names of functions in any case."""
    ensure_checkpoints(spark)
    bodies = spark.createDataFrame([("Template:Box", "[{{{1}}}]")], "title string, body string")
    calls = ["'{{box|<b a=\"|\">', lang, '|x</b>}} {{UC:', source, '}} {{#IF:x|yes|no}} {{box|<i>', lang, '|x}}'"]
    texts = table(spark, sf, "documents").selectExpr("doc_id", f"concat({', '.join(calls)}) AS body", "'Page' AS title")
    return expand.expand(texts, bodies, "doc_id", "body", "title")


@query("expand_budget", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN ['budget ' || lang] ELSE [] :: VARCHAR[] END AS notes, CASE WHEN doc_id % 2 = 1 THEN 'x' || source END AS expanded FROM documents")
def _expand_budget(spark, sf):
    """A text that doubles in each round ends with a note when it is longer than 400 characters; others are done in full."""
    ensure_checkpoints(spark)
    bodies = spark.createDataFrame([(f"Template:D{i}", f"{{{{d{i + 1}}}}}{{{{d{i + 1}}}}}") for i in range(40)] + [("Template:E", "x{{{1}}}")], "title string, body string")
    texts = table(spark, sf, "documents").selectExpr("doc_id", "IF(doc_id % 2 = 0, '{{d0}}', concat('{{e|', source, '}}')) AS body", "lang AS title")
    done = expand.expand(texts, bodies, "doc_id", "body", "title", notes=True, max_chars=400)
    return done.select("doc_id", F.transform("notes", lambda n: F.concat_ws(" ", n["kind"], n["name"])).alias("notes"), F.when(F.col("doc_id") % 2 == 1, F.col("expanded")).alias("expanded"))


@query("store_selected", f"WITH {_PAGES} SELECT page_title AS title FROM wiki WHERE namespace = 0 AND redirect_to IS NULL AND model = 'wikitext' AND content LIKE '%note%'")
def _selected(spark, sf):
    return store.selected(store.store_rows(wiki_pages(spark, sf)), [0], redirects=False, model="wikitext", pattern="%note%").select("title")


@query("lookup_aliases", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Template:Box' WHEN 1 THEN 'Template:Box' WHEN 2 THEN 'Main page' END AS title FROM documents")
def _aliases(spark, sf):
    pages = spark.createDataFrame([("Template:Box", 10, "b"), ("Main page", 0, "m")], "title string, namespace_id int, body string")
    wanted = table(spark, sf, "documents").selectExpr("doc_id", "element_at(array('t:box', 'TEMPLATE: Box', 'main_page', 'Nope'), cast(doc_id % 4 as int) + 1) AS wanted")
    return store.lookup(wanted, pages).select("doc_id", "page.title")


@query("page_files", "SELECT CASE WHEN doc_id % 2 = 0 THEN 'Words/' || substr(lang, 1, 2) || '/' || lang || '_' || doc_id || '.txt' ELSE 'Template/' || lang || '_' || doc_id || '.txt' END AS path, 'TITLE: ' || CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'Template:' END || lang || '/' || doc_id || chr(10) || text AS content FROM documents")
def _page_files(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("concat(IF(doc_id % 2 = 0, '', 'Template:'), lang, '/', doc_id) AS title", "IF(doc_id % 2 = 0, 0, 10) AS namespace_id", "cast(NULL as string) AS redirect_to", "text AS body")
    return store.page_files(rows)


@query("entity_ids", "SELECT d.doc_id AS doc_id, n.n_name AS item_id FROM documents d LEFT JOIN nation n ON d.doc_id % 40 = n.n_nationkey")
def _entity_ids(spark, sf):
    names = table(spark, sf, "nation").selectExpr("cast(n_nationkey as string) AS name", "'w' AS site_id", "n_name AS item_id")
    return wikidata.entity_ids(table(spark, sf, "documents").selectExpr("doc_id", "cast(doc_id % 40 as string) AS name", "'w' AS site_id"), names).select("doc_id", "item_id")


@query("node_children", "SELECT doc_id AS page_id, 'b' AS name, '<b class=\"k\">' || lang || '</b>' AS text FROM documents")
def _children(spark, sf):
    pages = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), F.concat(F.lit("{{a|<b class=\"k\">no</b>}} <b class=\"k\">"), "lang", F.lit("</b> <b>x</b>")).alias("content"))
    return nodes.html(nodes.children(nodes.node_rows(pages), ["HTML"]), "b", {"class": "k"}).select("page_id", "name", "text")


@query("level_contents", "SELECT doc_id AS page_id, unnest(['A', 'B', 'C']) AS name, unnest([lang || chr(10) || '=== B ===' || chr(10) || source, source, 'end']) AS body FROM documents")
def _levels(spark, sf):
    pages = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), F.concat(F.lit("top\n== A ==\n"), "lang", F.lit("\n=== B ===\n"), "source", F.lit("\n== C ==\nend")).alias("content"))
    return nodes.content_of_levels(nodes.node_rows(pages), pages).select("page_id", "name", "body")


@query("node_outline", "SELECT doc_id AS page_id, 'TEMPLATE a' || chr(10) || '  LINK ' || lang || chr(10) || 'BOLD' AS tree FROM documents")
def _outline(spark, sf):
    pages = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), F.concat(F.lit("{{a|[["), "lang", F.lit("]]}} '''b'''")).alias("content"))
    return nodes.outline(nodes.node_rows(pages))


@query("named_arguments", "SELECT doc_id, lang AS a, source AS b, 'last' AS c FROM documents")
def _named(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.expr(nodes.named_arguments("array(lang, 'k = x', 'c=first', source, ' c = last ')")).alias("m"))
    return rows.select("doc_id", F.expr("m['1']").alias("a"), F.expr("m['2']").alias("b"), F.expr("m['c']").alias("c"))


@query("highlighted", "SELECT doc_id, '&lt;' || lang || '&gt; <span class=\"arrow-link-marker\">[[a↓b]]</span><br><span class=\"template-marker\">♣  ♣  ♣  ref-' || doc_id || '-0001♣  ♣  ♣</span>' AS html FROM documents")
def _highlighted(spark, sf):
    text = F.concat(F.lit("<"), "lang", F.lit("> [[a↓b]]\n♣  ♣  ♣  ref-"), F.col("doc_id").cast("string"), F.lit("-0001♣  ♣  ♣"))
    return table(spark, sf, "documents").select("doc_id", text.alias("t")).select("doc_id", F.expr(links.highlighted("t")).alias("html"))


@query("article_errors", "SELECT doc_id, CASE WHEN quality = 0 THEN 'paragraph_errors=1; wtp_errors=1' END AS parse_error FROM labels")
def _article_errors(spark, sf):
    bad = (F.col("quality") == 0).cast("int")
    return table(spark, sf, "labels").select("doc_id", viewer.article_error(bad, bad).alias("parse_error"))


@query("joined_issues", "SELECT conv_id, string_agg(DISTINCT role, '; ' ORDER BY role) AS issues FROM conversations WHERE role IS NOT NULL GROUP BY conv_id")
def _issues(spark, sf):
    return sinks.issues(table(spark, sf, "conversations"), ["conv_id"], "role")


@query("stream_states", ORACLES["stream_resume"])
def _stream_states(spark, sf):
    """The same as stream_resume, taken by a stream."""
    return incremental.streamed_states(spark, f"{sf}/events*.parquet", f"{checkpoint_folder(spark)}/states-{uuid.uuid4().hex}")


@query(
    "module_library",
    """SELECT p_partkey, '{"a":"' || p_brand || '"}' AS a, p_size AS b, '<b class="' || p_brand || '">' || p_type || '</b>' AS c, [NULL, 10, 0, 6, 15][p_partkey % 5 + 1] AS d,
      CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE -1 END AS e, CASE p_partkey % 3 WHEN 0 THEN '1 day and 1 hour' WHEN 1 THEN '0 seconds' ELSE '2 minutes, 3 seconds' END AS f, 'x ' || p_brand || ' 2' AS g FROM part""".replace("'2 minutes, 3 seconds'", "'2 minutes and 3 seconds'"),
)
def _module_library(spark, sf):
    names = "element_at(array('nope', 'template', 'main', 'image', 'Category_talk'), cast(p_partkey % 5 as int) + 1)"
    return table(spark, sf, "part").select(
        "p_partkey",
        F.expr(library.json_encode("struct(p_brand AS a)")).alias("a"),
        F.expr(library.json_decode("concat('{\"k\": [', p_size, ']}')", "$.k[0]", "int")).alias("b"),
        F.expr(library.tag("'b'", "map('class', p_brand)", "p_type")).alias("c"),
        F.expr(library.find_namespace(names)).alias("d"),
        F.expr(library.compare_titles("'Help:a'", "IF(p_partkey % 3 = 0, 'help: A', 'Category:x')")).alias("e"),
        F.expr(library.format_duration("element_at(array(90000L, 0L, 123L), cast(p_partkey % 3 as int) + 1)")).alias("f"),
        F.expr(library.filled("'x $1 $2'", "array(p_brand, '2')")).alias("g"),
    )


_pfn("pfn_constants", "documents", "doc_id", {
    "a": ("NAMESPACENUMBER", [], "'0'"), "b": ("SUBJECTSPACE", [], "'Help'"), "c": ("FULLPAGENAMEE", [], "'Help:' || source || '/' || lang"), "d": ("PAGENAMEE", [], "source || '/' || lang"), "e": ("ROOTPAGENAMEE", [], "source"),
    "f": ("SHORTDESC", ["lang"], "''"), "g": ("SERVER", [], "'//en.wikipedia.org'"), "h": ("SERVERNAME", [], "'en.wikipedia.org'"), "i": ("REVISIONID", [], "'-'"), "j": ("REVISIONUSER", [], "'AnonymousUser'"), "k": ("PROTECTIONLEVEL", ["lang"], "''"),
    "l": ("DISPLAYTITLE", ["lang"], "''"), "m": ("DEFAULTSORT", ["lang"], "''"), "n": ("PAGELANGUAGE", [], "'en'"), "o": ("#categorytree", ["lang"], "''"), "p": ("#urldecode", ["concat(lang, '%20', source)"], "lang || ' ' || source"),
    "q": ("plural", ["'1'", "lang", "source"], "source"), "r": ("#coordinates", ["lang"], "''"),
}, "concat('Help:', source, '/', lang)")
_NOW = {"YEAR": "%Y", "MONTH": "%m", "MONTHNAME": "%B", "MONTHABBREV": "%b", "DAY": "%-d", "DAY2": "%d", "DOW": "%w", "DAYNAME": "%A", "HOUR": "%H", "WEEK": "%W"}
_pfn("pfn_now", "region", "r_regionkey", {
    **{f"{p}_{n}": (f"{p}{n}", [], f"strftime(now() AT TIME ZONE 'UTC', '{code}')") for p in ("CURRENT", "LOCAL") for n, code in _NOW.items()},
    "m1": ("CURRENTMONTH1", [], "strftime(now() AT TIME ZONE 'UTC', '%-m')"), "dow": ("CUEEWNTDOW", [], "strftime(now() AT TIME ZONE 'UTC', '%w')"),
})
_pfn("pfn_time_steps", "orders", "o_orderkey", {
    "a": ("#time", ["'Y-m-d'", "date_format(o_orderdate, \"yyyy-MM-dd' +1 day'\")"], "strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d')"),
    "b": ("#time", ["'Y-m-d'", "date_format(o_orderdate, \"d MMMM yyyy' 2 weeks ago'\")"], "strftime(o_orderdate - INTERVAL 14 DAY, '%Y-%m-%d')"),
    "c": ("#timel", ["'Y-m-d'", "date_format(o_orderdate, \"yyyy-MM-dd' +1 month'\")"], "strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d')"),
    "d": ("#time", ["'F Y'", "date_format(o_orderdate, 'MMMM yyyy')"], "strftime(o_orderdate, '%B %Y')"),
    "e": ("#time", ["'Y-m-d H:i'", "concat('@', unix_timestamp(date_trunc('DAY', o_orderdate)) + 3600)"], "strftime(date_trunc('day', o_orderdate) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M')"),
    "f": ("#time", ["'Y'", "concat('bad ', o_orderkey)"], "'<strong class=\"error\">Bad time syntax: bad ' || o_orderkey || '</strong>'"),
})


@query("interwiki_map", "SELECT 'p' || n_nationkey AS prefix, CASE WHEN n_nationkey % 2 = 0 THEN '//' ELSE 'https://' END || n_nationkey || '.wikipedia.org/$1' AS url, n_nationkey % 2 = 0 AS is_protocol_relative, TRUE AS is_local, n_nationkey = 3 AS is_current FROM nation WHERE n_nationkey % 3 = 0")
def _interwiki(spark, sf):
    sites = table(spark, sf, "nation").selectExpr("concat('p', n_nationkey) AS prefix", "concat('https://', n_nationkey, '.wikipedia.org/$1') AS url", "n_nationkey % 2 = 0 AS protorel", "n_nationkey % 3 = 0 AS local")
    return wikidata.interwiki(sites, "3.wikipedia.org", local=True)


@query("safe_html", "SELECT doc_id, '&lt;' || lang || '&gt;<br># ' || source || '<br>&quot;&#x27;&amp;' AS html FROM documents")
def _safe_html(spark, sf):
    text = F.concat(F.lit("<"), "lang", F.lit(">\r\n# "), "source", F.lit("\n\"'&"))
    return table(spark, sf, "documents").select("doc_id", text.alias("t")).select("doc_id", F.expr(links.safe_html("t")).alias("html"))


@query("text_children", "SELECT doc_id AS page_id, 'a ' || lang || ' ' AS text FROM documents UNION ALL SELECT doc_id, ' b' FROM documents")
def _text_children(spark, sf):
    pages = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), F.concat(F.lit("a "), "lang", F.lit(" {{x|[[y]]}} \n[[z]] b")).alias("content"))
    return nodes.texts(pages, nodes.node_rows(pages)).select("page_id", "text")


@query("template_counts", "SELECT doc_id AS page_id, 2 + doc_id % 2 AS templates FROM documents")
def _template_counts(spark, sf):
    pages = table(spark, sf, "documents").selectExpr("doc_id AS page_id", "concat('{{a|{{b}}}} ', IF(doc_id % 2 = 1, '{{c}}', '{{c')) AS content")
    return nodes.template_counts(nodes.node_rows(pages))


@query("language_library", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'he' WHEN 1 THEN 'she' ELSE 'they' END AS a, CASE doc_id % 3 WHEN 0 THEN '←' WHEN 1 THEN '↑' ELSE '→' END AS b FROM documents")
def _language_library(spark, sf):
    pick = lambda *x: f"element_at(array({', '.join(map(quoted, x))}), cast(doc_id % 3 as int) + 1)"
    return table(spark, sf, "documents").select("doc_id", F.expr(library.gender(pick("masculine", "feminine", "neutral"), "'he'", "'she'", "'they'")).alias("a"), F.expr(library.arrow(pick("backwards", "up", "x"))).alias("b"))


@query("stream_unique", "SELECT event_id, user_id, event_type FROM events")
def _stream_unique(spark, sf):
    """Each event comes twice, from two streams, and is kept once: the state knows the ids of all batches."""
    ensure_checkpoints(spark)
    return incremental.streamed_unique(spark, [f"{sf}/events*.parquet"] * 2, f"{checkpoint_folder(spark)}/unique-{uuid.uuid4().hex}", ["event_id"]).select("event_id", "user_id", "event_type")


@query("write_metrics", "SELECT count(*) AS read_rows, count(CASE WHEN lang = 'en' THEN 1 END) AS skipped_rows, count(CASE WHEN lang IS DISTINCT FROM 'en' THEN 1 END) AS written_rows FROM documents")
def _write_metrics(spark, sf):
    ensure_checkpoints(spark)
    path = f"{checkpoint_folder(spark)}/metered-{uuid.uuid4().hex}"
    metrics = sinks.write_metered(table(spark, sf, "documents"), path, skip=F.col("lang") == "en")
    written = spark.read.parquet(path).agg(F.count("*").alias("written_rows"))
    return written.select(*[F.lit(metrics[k]).alias(k) for k in ("read_rows", "skipped_rows")], "written_rows")
