"""A wiki made from the ``documents`` table by one recipe in two dialects, for queries and their SQL oracles.

Page = document; its lines become paragraphs under generated headings, with an infobox, links, a template call, a
reference, an external link, a file link and a nested list. Identical texts make redirects to the smallest id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BODY = """concat('{{{{Infobox doc\\n| id = ', {id}, '\\n}}}}\\n', {lines}, '\\n\\n== References ==\\n<ref>Doc ', {id}, '</ref>\\n\\n== Later ==\\n* one [[', {lang}, ']]\\n** two; \\n** three.\\n* four')"""


def _line(dialect: str) -> str:
    """One line l with its number i (from 1)."""
    n = "cast(i as string)" if dialect == "spark" else "cast(i as varchar)"
    return (
        "concat(CASE WHEN i = 1 THEN '' ELSE '\\n\\n' END, "
        f"CASE WHEN i > 1 AND i % 3 = 0 THEN concat('== Part ', {n}, ' ==\\n') WHEN i > 1 AND i % 3 = 1 THEN concat('=== Sub ', {n}, ' ===\\n') WHEN i > 1 AND i % 6 = 5 THEN concat('==== Deep ', {n}, ' ====\\n') ELSE '' END, l, "
        "CASE WHEN i = 1 THEN concat(' [[', source, '|src]] [[', lang, ']]') WHEN i % 5 = 0 THEN concat(' [http://example.org/', "
        + n
        + ", ' site] and {{note|', "
        + n
        + ", '}}.') WHEN i % 7 = 0 THEN ' ''''''bold'''''' [[File:a.png|thumb]] <!-- hidden -->' ELSE '' END)"
    )


def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(revision_id, page_id, page_title, namespace, model, redirect_to, is_redirect, content)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    # texts are told apart by their digests, so that none is dealt twice
    docs = docs.withColumn("digest", F.unhex(F.sha2("text", 256)))
    same = docs.groupBy("digest").agg(F.min("doc_id").alias("first"))
    line = _line("spark").replace("''''''", "\\'\\'\\'").replace("' \\'", "' \\'")
    lines = f"array_join(transform(split(text, '\\n'), (l, k) -> transform(array(k + 1), i -> {line})[0]), '')"
    body = _BODY.format(id="cast(doc_id as string)", lines=lines, lang="lang").replace("{{{{", "{{").replace("}}}}", "}}")
    # the content is made below the join, so that no plan above repeats its expression
    made = docs.selectExpr("doc_id", "digest", f"{body} AS content")
    return made.join(same, "digest").selectExpr(
        "doc_id * 10 + 1 AS revision_id",
        "doc_id AS page_id",
        "concat('Doc ', cast(doc_id as string)) AS page_title",
        "CASE WHEN doc_id % 10 = 7 THEN 10 WHEN doc_id % 10 = 8 THEN 828 ELSE 0 END AS namespace",
        "CASE WHEN doc_id % 10 = 8 THEN 'Scribunto' ELSE 'wikitext' END AS model",
        "CASE WHEN first <> doc_id THEN concat('Doc ', cast(first as string)) END AS redirect_to",
        "first <> doc_id AS is_redirect",
        "content",
    )


def wiki_pages_sql() -> str:
    """The same rows in DuckDB SQL, as a query to be named in a WITH list."""
    line = _line("duck").replace("\\n", "' || chr(10) || '")
    lines = f"array_to_string(list_transform(string_split(text, chr(10)), lambda l, i: {line}), '')"
    body = _BODY.format(id="cast(doc_id as varchar)", lines="@@", lang="lang").replace("\\n", "' || chr(10) || '").replace("@@", lines)
    return f"""
SELECT doc_id * 10 + 1 AS revision_id, doc_id AS page_id, concat('Doc ', cast(doc_id as varchar)) AS page_title,
  CASE WHEN doc_id % 10 = 7 THEN 10 WHEN doc_id % 10 = 8 THEN 828 ELSE 0 END AS namespace,
  CASE WHEN doc_id % 10 = 8 THEN 'Scribunto' ELSE 'wikitext' END AS model,
  CASE WHEN first <> doc_id THEN concat('Doc ', cast(first as varchar)) END AS redirect_to,
  first <> doc_id AS is_redirect, {body} AS content
FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first FROM documents)"""
