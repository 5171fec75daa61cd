"""Operator 13: how the sources of a language differ in their use of terms, with equal count columns evaluated once.

Terms are counted by language and source. A term's counts by source are a sparse vector; terms of a language with the
same vector are one group, and every pair of sources is evaluated once per distinct vector, times the number of its terms.
The original terms of a source are ranked by how far their share is above that in the language.

All arithmetic is in whole numbers. Null text, language and source are ''. A language without kept terms gives pairs of
value 0. Repeated rows count as often as they stand there; no row, no result. Other columns are not read.

Scale: counts are combined in a task before each shuffle, so a hot source or term is no hot key. Vectors of a language are dealt in parts of
about PART vectors, and its sources in blocks of BLOCK, so no task holds more than a part; sums of pairs are all that leaves it.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, written

#: Runs of letters A-Z, a-z and of what isn't ASCII, in UTF-8.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
LEAST_DOCS, TOP, SMOOTHING, UNIT = 30, 50, 5, 1_000_000_000
#: Counts a task holds before it passes them on; distinct vectors of a part; sources of a block; cells of a matrix.
HELD, PART, BLOCK, CELLS = 400_000, 5_000, 256, 1_000_000


def term_counts(docs: DataFrame, most: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term, summed over what a task has held."""
    fields = [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found, size = defaultdict(Counter), defaultdict(Counter), 0

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in held.items():
                docs_of, terms = found[lang, source], list(counts)
                columns = [[lang] * len(terms), [source] * len(terms), terms, list(counts.values()), [docs_of[t] for t in terms]]
                made = [pa.array(c, pa.binary() if name == "term" else kind) for c, (name, kind) in zip(columns, fields, strict=True)]
                made[2] = made[2].cast(pa.string())
                yield pa.RecordBatch.from_arrays(made, names=[name for name, _ in fields])
            held.clear()
            found.clear()

        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, (lang, source) in enumerate(zip(langs, sources, strict=True)):
                # a match at a time: no list of a long text's terms; bytes.lower changes A-Z only
                counts = Counter(map(itemgetter(0), TERM.finditer(batch.column(2)[at].as_py().lower())))
                before = len(held[lang, source])
                held[lang, source].update(counts)
                found[lang, source].update(counts.keys())
                size += len(held[lang, source]) - before
                if size > most:
                    yield from out()
                    size = 0
        yield from out()

    return docs.select("lang", "source", F.col("text").cast("binary")).mapInArrow(run, ", ".join(f"{n} {'long' if k == pa.int64() else 'string'}" for n, k in fields))


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS, most: int = HELD) -> DataFrame:
    """(lang, term, vector): terms in ``least_docs`` documents of the language, vector: array of struct(source, n) by source."""
    counts = term_counts(docs, most).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    vectors = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("vector"))
    return vectors.filter(F.col("docs") >= least_docs).select("lang", "term", "vector")


def share(count: Column | str, total: str, terms: str) -> Column:
    """1 + floor(UNIT * (count + SMOOTHING) / (total + SMOOTHING * terms)), exact; null without terms."""
    wide = "decimal(19,0)"
    return F.expr(f"IF({terms} = 0, NULL, 1 + (cast({UNIT} as decimal(10,0)) * cast({count} + {SMOOTHING} as {wide})) div cast({total} + {SMOOTHING} * {terms} as {wide}))")


def _shares(counts: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    """As ``share``: a long division in three steps of a thousand, so that nothing leaves 64 bits."""
    rest, whole = counts + SMOOTHING, 0
    for _ in range(3):
        rest = rest * 1000
        whole, rest = whole * 1000 + rest // bottom, rest % bottom
    return 1 + whole


def _pair_sums(vectors: pa.Table, groups: pa.Table, width: int = BLOCK, cells: int = CELLS) -> pa.Table:
    """(lang, a, b, value): sums over a part of the vectors for each pair a < b of sources with a in one block."""
    lang, block = groups.column("lang")[0], groups.column("block")[0].as_py()
    sources, totals = groups.column("sources")[0].as_py(), np.array(groups.column("totals")[0].as_py(), np.int64)
    bottom = totals + SMOOTHING * groups.column("terms")[0].as_py()
    count, begin = len(sources), block * width
    end = min(count, begin + width)
    sums = np.zeros((end - begin, count), np.int64)
    if vectors.num_rows:
        where = pa.array(sources, pa.string())
        lists = vectors.column("vector").combine_chunks()
        times = vectors.column("m").to_numpy()
        sizes = lists.value_lengths().to_numpy()
        entries = lists.flatten()
        at = pc.index_in(entries.field(0), where).to_numpy().astype(np.int64)
        n = entries.field(1).to_numpy()
        row = np.repeat(np.arange(len(sizes)), sizes)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        step = max(1, cells // count)
        for low in range(0, len(sizes), step):
            high = min(len(sizes), low + step)
            inside = slice(starts[low], starts[high])
            dense = np.zeros((high - low, count), np.int64)
            dense[row[inside] - low, at[inside]] = n[inside]
            dense = _shares(dense, bottom)
            for a in range(begin, end):
                sums[a - begin, a + 1 :] += times[low:high] @ np.abs(dense[:, a : a + 1] - dense[:, a + 1 :])
    a, b = np.nonzero(np.arange(count)[None, :] > np.arange(begin, end)[:, None])
    return pa.table({"lang": pa.array([lang.as_py()] * len(a), pa.string()), "a": pa.array(a + begin, pa.int32()), "b": pa.array(b, pa.int32()), "value": sums[a, b]})


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, part: int = PART, block: int = BLOCK, cells: int = CELLS, most: int = HELD) -> DataFrame:
    """(lang, source, part, item, value, rank): part 'pair' has the distance to each other source of the language, part 'term' the ``top`` terms above the language's share.

    part, block, cells, most: vectors of a task, sources of a block, cells of a matrix and counts that a task holds; the rows don't depend on them.
    """
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    terms = written(kept_terms(docs, least_docs, most), "terms")
    vectors = written(terms.groupBy("lang", "vector").agg(F.count("*").alias("m")), "vectors")
    sums = vectors.select("lang", "m", F.inline("vector")).groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("m")).alias("total"))
    sizes = vectors.groupBy("lang").agg(F.sum("m").alias("terms"), F.count("*").alias("distinct_vectors"))
    groups = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(sizes, "lang", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    groups = groups.select("lang", "source", *(zero(F.col(c)).alias(c) for c in ("total", "terms", "distinct_vectors")))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = written(groups.withColumn("no", number).withColumn("lang_total", F.sum("total").over(Window.partitionBy("lang"))), "groups")

    # one row a language with its sources in order; parts of its vectors, and blocks of its sources
    ordered = F.array_sort(F.collect_list(F.struct("no", "source", "total")))
    langs = groups.groupBy("lang", "terms", "distinct_vectors").agg(ordered.alias("g"))
    langs = langs.selectExpr("lang", "terms", "g.source AS sources", "g.total AS totals", f"cast(greatest(1, ceil(distinct_vectors / {part})) as int) AS parts", f"cast(ceil(size(g) / {block}) as int) AS blocks")
    split = vectors.join(langs.select("lang", "parts", "blocks"), "lang")
    split = split.withColumn("part", F.expr("cast(pmod(xxhash64(vector), parts) as int)")).withColumn("block", F.expr("explode(sequence(0, blocks - 1))"))
    dealt = langs.withColumn("part", F.expr("explode(sequence(0, parts - 1))")).withColumn("block", F.expr("explode(sequence(0, blocks - 1))"))
    keys = ["lang", "part", "block"]
    apart = split.select(*keys, "vector", "m").groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(lambda v, g: _pair_sums(v, g, block, cells), "lang string, a int, b int, value long")
    apart = apart.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = apart.select("lang", "value", F.inline(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))))
    names = groups.select("lang", "source", "no")
    pairs = both.join(names.withColumnRenamed("no", "x"), ["lang", "x"]).join(names.select("lang", F.col("no").alias("y"), F.col("source").alias("item")), ["lang", "y"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    # every term again, with its share in the source and in the language
    here = terms.select("lang", "term", F.expr("aggregate(vector, 0L, (s, e) -> s + e.n)").alias("all"), F.inline("vector"))
    here = here.join(groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"])
    here = here.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (share("n", "total", "terms") - share("`all`", "lang_total", "terms")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    best = here.filter("value > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir))


def op13_sql() -> str:
    """DuckDB SQL with the same rows."""
    share = lambda count, total: f"(1 + (1000000000::HUGEINT * ({count} + 5)) // ({total} + 5 * terms))::BIGINT"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n_lang FROM c GROUP BY ALL HAVING sum(docs) >= 30),
kc AS (SELECT c.lang, c.source, c.term, c.n, k.n_lang FROM c JOIN k ON c.lang = k.lang AND c.term = k.term),
v AS (SELECT lang, count(*) AS terms, sum(n_lang) AS lang_total FROM k GROUP BY ALL),
g AS (
  SELECT a.lang, a.source, coalesce(s.total, 0) AS total, coalesce(v.terms, 0) AS terms, coalesce(v.lang_total, 0) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d) a LEFT JOIN (SELECT lang, source, sum(n) AS total FROM kc GROUP BY ALL) s ON a.lang = s.lang AND a.source = s.source LEFT JOIN v ON a.lang = v.lang
), p AS (
  SELECT g.lang, g.source, k.term, {share("coalesce(kc.n, 0)", "g.total")} AS p FROM g JOIN k ON g.lang = k.lang
  LEFT JOIN kc ON kc.lang = g.lang AND kc.source = g.source AND kc.term = k.term
), f AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), t AS (
  SELECT kc.lang, kc.source, 'term' AS part, kc.term AS item, {share("kc.n", "g.total")} - {share("kc.n_lang", "g.lang_total")} AS value
  FROM kc JOIN g ON kc.lang = g.lang AND kc.source = g.source
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM t WHERE value > 0)
) WHERE part = 'pair' OR rank <= 50"""
