"""The page store: templates, modules and pages by title and namespace, with redirects and template inclusion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parserfns import NAMESPACES
from ..functions.texts import quoted, replace_all
from .cleanup import template_body
from .sinks import insert_missing, upsert

TEMPLATE, MODULE = 10, 828
MODELS = ("wikitext", "Scribunto", "json")
# Templates every store has.
DEFAULT_TEMPLATES = {"!": "|", "=": "=", "((": "{{", "))": "}}"}
MAX_ROUNDS = 100


def store_rows(pages: DataFrame) -> DataFrame:
    """(title, namespace_id, redirect_to, need_pre_expand, body, model) of pages (page_title, namespace, redirect_to, content, model).

    Documentation and test pages stay out. A redirect has no body, whatever its model; other models than MODELS stay
    out. A template's body is the part that is transcluded. Titles carry their namespace's name.
    """
    names = " ".join(f"WHEN {i} THEN {quoted(n + ':')}" for i, n, _ in NAMESPACES if n)
    prefix = f"(CASE namespace {names} ELSE '' END)"
    title = f"IF(startswith(page_title, {prefix}), page_title, concat({prefix}, {replace_all('page_title', '^Main:', '')}))"
    kept = pages.filter("NOT endswith(page_title, '/documentation') AND NOT contains(page_title, '/testcases')")
    kept = kept.filter(F.col("redirect_to").isNotNull() | F.col("model").isin(*MODELS))
    body = f"CASE WHEN redirect_to IS NOT NULL THEN NULL WHEN namespace = {TEMPLATE} THEN {template_body('content')} ELSE content END"
    return kept.selectExpr(f"{title} AS title", "namespace AS namespace_id", "redirect_to", "false AS need_pre_expand", f"{body} AS body", "model")


def with_defaults(store: DataFrame) -> DataFrame:
    rows = [(f"Template:{n}", TEMPLATE, None, False, b, "wikitext") for n, b in DEFAULT_TEMPLATES.items()]
    return insert_missing(store, store.sparkSession.createDataFrame(rows, store.schema), ["title", "namespace_id"])


def overwritten(store: DataFrame, overrides: DataFrame) -> DataFrame:
    """Rows of ``overrides`` take the place of pages of their title and namespace."""
    return upsert(store, overrides.select(*store.columns), ["title", "namespace_id"])


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Overrides from text files: a first line ``TITLE: name``, then the body."""
    files = spark.read.text(path, wholetext=True)
    named = files.selectExpr("regexp_extract(value, '^TITLE:[ \\\\t]*([^\\\\r\\\\n]+)', 1) AS title", "regexp_replace(value, '^TITLE:[^\\\\n]*\\\\n', '') AS body").filter("title <> ''")
    return named.selectExpr("title", f"{_title_namespace('title')} AS namespace_id", "cast(NULL as string) AS redirect_to", "false AS need_pre_expand", "body", "IF(title LIKE 'Module:%', 'Scribunto', 'wikitext') AS model")


def selected(store: DataFrame, namespaces: list[int] | None = None, redirects: bool = True, model: str | None = None, pattern: str | None = None) -> DataFrame:
    """Pages by namespace, without redirects, of a model, with a body like a pattern; all tests reach the scan."""
    if namespaces is not None:
        store = store.filter(F.col("namespace_id").isin(*namespaces))
    if not redirects:
        store = store.filter("redirect_to IS NULL")
    if model is not None:
        store = store.filter(F.col("model") == model)
    return store if pattern is None else store.filter(F.col("body").like(pattern))


def lookup(wanted: DataFrame, store: DataFrame, title_col: str = "wanted") -> DataFrame:
    """``wanted`` with its page: the exact title (underscores as blanks, without Main:, namespaces in any case and by alias), else with an upper first letter.

    Titles are resolved first, each once, and pages joined last: bodies pass through no aggregate.
    """
    plain = f"replace(regexp_replace({title_col}, '^(?i)Main:', ''), '_', ' ')"
    known = " ".join(f"WHEN {quoted(x.lower())} THEN {quoted(n)}" for _, n, al in NAMESPACES for x in (n, *al) if n)
    prefix = f"(CASE lower(trim(substring_index({plain}, ':', 1))) {known} END)"
    name = f"IF(instr({plain}, ':') > 0 AND {prefix} IS NOT NULL, concat({prefix}, ':', ltrim(substr({plain}, instr({plain}, ':') + 1))), {plain})"
    local = f"substr({name}, instr({name}, ':') + 1)"
    upper = f"concat(substr({name}, 1, instr({name}, ':')), upper(substr({local}, 1, 1)), substr({local}, 2))"
    asked = wanted.select(title_col).distinct()
    tries = asked.select(title_col, F.posexplode(F.array(F.expr(name), F.expr(upper))).alias("__rank", "__try"))
    titles = store.select(F.col("title").alias("__try"))
    best = tries.join(titles, "__try", "left_semi").groupBy(title_col).agg(F.min_by("__try", "__rank").alias("__title")).withColumnRenamed(title_col, "__asked")
    pages = store.select(F.col("title").alias("__t"), F.struct(*store.columns).alias("page"))
    named = wanted.join(best, wanted[title_col].eqNullSafe(best["__asked"]), "left").drop("__asked")
    return named.join(pages, named["__title"] == pages["__t"], "left").drop("__t", "__title")


def resolve_redirects(store: DataFrame) -> DataFrame:
    """``store`` and target: the page one hop on, unless that is a redirect again; a page that is none is its own."""
    ends = store.filter("redirect_to IS NULL").select(F.col("title").alias("__t"), F.col("namespace_id").alias("__n"), F.col("body").alias("__b"))
    hop = store.join(ends, (F.col("redirect_to") == F.col("__t")) & (F.col("namespace_id") == F.col("__n")), "left")
    own = F.col("redirect_to").isNull()
    return hop.select(*[store[c] for c in store.columns], F.when(own, F.col("title")).otherwise(F.col("__t")).alias("target"), F.when(own, store["body"]).otherwise(F.col("__b")).alias("target_body"))


def inclusions(store: DataFrame) -> DataFrame:
    """(includer, included): which template pages name which in {{ }}."""
    pattern = quoted(r"\{\{\s*([^{}|<>\[\]#\n]+?)\s*(?=\||\}\})")
    used = store.filter(F.col("body").isNotNull()).select(F.col("title").alias("includer"), F.explode(F.array_distinct(F.expr(f"regexp_extract_all(body, {pattern}, 1)"))).alias("name"))
    full = "IF(instr(name, ':') > 0, name, concat('Template:', upper(substr(name, 1, 1)), substr(name, 2)))"
    return used.selectExpr("includer", f"{full} AS included").distinct()


def needs_pre_expansion(store: DataFrame) -> str:
    """SQL: a body whose table or list parts don't close in themselves, so that it must be expanded before parsing."""
    pairs = [(r"\{\|", r"\|\}"), (r"<table\b", r"</table\b"), (r"<ul\b", r"</ul\b")]
    return " OR ".join(f"size(regexp_extract_all(coalesce(body, ''), {quoted(a)}, 0)) <> size(regexp_extract_all(coalesce(body, ''), {quoted(b)}, 0))" for a, b in pairs)


def closure(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(title): seeds and all that include them, directly or through others. edges: (includer, included).

    Breadth first, a join a round, until a round brings nothing new; each round is written out of the plan.
    """
    reached = seeds.select("title").distinct()
    front = reached
    for _ in range(MAX_ROUNDS):
        new = edges.join(front, edges["included"] == front["title"], "left_semi").select(F.col("includer").alias("title")).distinct()
        new = new.join(reached, "title", "left_anti").checkpoint()
        if new.isEmpty():
            return reached
        reached, front = reached.unionByName(new).checkpoint(), new
    raise RuntimeError(f"inclusion is deeper than {MAX_ROUNDS}")


def analysed(store: DataFrame, seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """``store`` with need_pre_expand set on the closure of ``seeds``, and passed along redirects both ways."""
    need = closure(edges, seeds)
    links = store.filter("redirect_to IS NOT NULL").select("title", F.col("redirect_to").alias("to"))
    to_source = links.join(need.select(F.col("title").alias("to")), "to", "left_semi").select("title")
    to_target = links.join(need, "title", "left_semi").select(F.col("to").alias("title"))
    marked = need.unionByName(to_source).unionByName(to_target).distinct().withColumn("__need", F.lit(True))
    return store.join(marked, "title", "left").withColumn("need_pre_expand", F.coalesce("__need", "need_pre_expand")).select(*store.columns)


def counts(store: DataFrame) -> DataFrame:
    """Pages, and articles: main namespace without redirects."""
    return store.agg(F.count("*").alias("pages"), F.count(F.when((F.col("namespace_id") == 0) & F.col("redirect_to").isNull(), 1)).alias("articles"))


def read_json_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Overrides from JSON files: an object of title -> {namespace_id, redirect_to, need_pre_expand, body, model}; what is left out is told by the title, or null."""
    row = "struct<namespace_id:int,redirect_to:string,need_pre_expand:boolean,body:string,model:string>"
    each = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string,{row}>")).alias("title", "p"))
    return each.selectExpr("title", f"coalesce(p.namespace_id, {_title_namespace('title')}) AS namespace_id", "p.redirect_to", "coalesce(p.need_pre_expand, false) AS need_pre_expand", "p.body", "coalesce(p.model, 'wikitext') AS model")


def _title_namespace(title: str) -> str:
    ids = " ".join(f"WHEN {title} LIKE {quoted(n + ':%')} THEN {i}" for i, n, _ in NAMESPACES if n)
    return f"(CASE {ids} ELSE 0 END)"


def has_templates(overrides: DataFrame) -> bool:
    """What a dry run asks: whether overrides touch templates, so that the analysis must be made anew."""
    return not overrides.filter(F.col("namespace_id") == TEMPLATE).isEmpty()


def build(pages: DataFrame, path: str, overrides: DataFrame | None = None) -> DataFrame:
    """The store of ``pages`` as Parquet at ``path``, made once: pages, default templates, overrides, and what must be expanded before parsing.

    The table is written under a name of its own and takes its place when it is whole; a store that is there is read, unless
    there are overrides, which make a new one of the old pages.
    """
    spark = pages.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    there = files.exists(where)
    if there and overrides is None:
        return spark.read.parquet(path)
    rows = spark.read.parquet(path) if there else with_defaults(store_rows(pages))
    if overrides is not None:
        rows = overwritten(rows, overrides)
    if not there or has_templates(overrides):
        rows = rows.checkpoint()
        seeds = rows.filter((F.col("namespace_id") == TEMPLATE) & F.expr(needs_pre_expansion(rows))).select("title")
        rows = analysed(rows.withColumn("need_pre_expand", F.lit(False)), seeds, inclusions(rows.filter(F.col("namespace_id") == TEMPLATE)))
    fresh, old = (spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{x}") for x in ("new", "old"))
    rows.write.mode("overwrite").parquet(fresh.toString())
    files.delete(old, True)
    if there:
        files.rename(where, old)
    files.rename(fresh, where)
    files.delete(old, True)
    return spark.read.parquet(path)


def needing(wanted: DataFrame, store: DataFrame, title_col: str = "title") -> DataFrame:
    """``wanted`` titles whose template must be expanded before parsing; those of pages that are not there are none."""
    need = store.filter("need_pre_expand").select(F.col("title").alias("__t")).distinct()
    return wanted.join(need, wanted[title_col] == need["__t"], "left_semi")


def is_analysed(store: DataFrame) -> bool:
    """Whether the analysis of inclusions has been made: any page is marked."""
    return not store.filter("need_pre_expand").isEmpty()


def page_files(store: DataFrame, name_max: int = 255) -> DataFrame:
    """(path, content): a text file for each page: main pages under Words and their first two letters, others under their namespace; long names end in a hash."""
    safe = f"translate(title, {quoted('/' + chr(92))}, '__')"
    stem = f"IF(octet_length({safe}) + 4 > {name_max}, concat(left({safe}, 50), '_', sha2({safe}, 256)), {safe})"
    split = f"IF(namespace_id = 0, concat('Words/', left({safe}, 2), '/', {stem}), regexp_replace({stem}, '^([^:]*):', '$1/'))"
    return store.selectExpr(f"concat({split}, '.txt') AS path", "concat('TITLE: ', title, '\\n', coalesce(body, redirect_to, '')) AS content")
