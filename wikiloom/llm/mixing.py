"""Mixing sources to target weights by temperature, realised as budgeted block permutations; Spark SQL functions only.

With p_i a source's share of all tokens, its weight at exponent t is w_i = p_i^t / sum_j p_j^t: t = 1 keeps the natural
mix, t = 0 makes all sources equal. The exponent is found by bisection over the table of sources, each pass an
aggregate that tries a whole level-set of midpoints at once; only one row of sums leaves Spark. Two aims exist:

* ``entropy``: the weights' entropy (nats), which falls as t grows;
* ``repetition``: the most passes over any source that the budget may ask for, which also falls as t grows (t <= 1).

A budget of B tokens gives a source w_i * B tokens, that is passes_i = w_i * B / tokens_i. Pass after pass, each with
another permutation, a source's documents are taken in order of a keyed hash. The hash order is cut into blocks of about
BLOCK_DOCS documents, so the place where the budget of the last, partial pass ends is found from block sums first and
then inside one block per source; no task holds a whole source. A whole document is taken while the tokens taken
before it are below the budget of the pass.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import documents, free_name, written

BLOCK_DOCS = 1_024
#: Blocks of a group, whose sums are added up first.
GROUP_BLOCKS = 1024
#: Each pass narrows the exponent by 16; ten passes by 2^40.
FANOUT, PASSES = 16, 10
MAX_EXPONENT = 8.0
#: Sources up to this number are broadcast to the documents (a row of about 100 bytes each); more are joined by shuffle.
BROADCAST_SOURCES = 2_000
SEED = 20240229
#: Production aim of the query and the pipeline: no source more than twice, none dropped ("cover").
MAX_PASSES = 2.0
HASH_SPAN = 1 << 52


def token_count(text: F.Column) -> F.Column:
    """Words of the text as its tokens; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_table(tokens: DataFrame) -> DataFrame:
    """(source, docs, tokens, p): in (source, tokens). A null source is a source of its own; p is null if it has no tokens."""
    sums = tokens.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"))
    sums = written(sums, "sources")
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    return sums.withColumn("p", F.when(F.col("tokens") > 0, F.col("tokens") / F.lit(float(total))))


def _measures(sources: DataFrame, exponents: list[float], budget: float | None) -> list[tuple[float, float]]:
    """(entropy, most passes) of each exponent, from one aggregate over the sources."""
    q = sources.filter("p IS NOT NULL")
    sums = []
    for k, t in enumerate(exponents):
        w = F.exp(F.log("p") * t)
        sums += [F.sum(w).alias(f"z{k}"), F.sum(w * F.log("p")).alias(f"s{k}"), F.max(w / F.col("tokens")).alias(f"m{k}"), F.min(w / F.col("tokens")).alias(f"l{k}")]
    row = q.agg(*sums).first()
    found = []
    for k, t in enumerate(exponents):
        z, s, most, least = (row[f"{c}{k}"] for c in "zsml")
        # without a budget the least one that takes every source once: passes are relative to the source that repeats least
        found.append((math.log(z) - t * s / z, most / least if budget is None else most / z * budget))
    return found


def bisect_exponent(sources: DataFrame, budget: float | None = None, entropy: float | None = None, max_passes: float | None = None) -> float:
    """The exponent whose entropy is ``entropy``, or the least one in [0, 1] that keeps to ``max_passes``.

    Out of reach: an entropy above that of equal weights gives 0, one below that of MAX_EXPONENT gives MAX_EXPONENT;
    passes that even the natural mix exceeds give 1. No source with tokens: 1.
    """
    if (entropy is None) == (max_passes is None):
        raise ValueError("give either entropy or max_passes")
    if sources.filter("p IS NOT NULL").isEmpty():
        return 1.0
    low, high = 0.0, MAX_EXPONENT if entropy is not None else 1.0
    above = lambda m: m[0] > entropy if entropy is not None else m[1] > max_passes * (1 + 1e-12)
    if not above(_measures(sources, [low], budget)[0]):
        return low
    for _ in range(PASSES):
        tried = [low + (high - low) * k / FANOUT for k in range(1, FANOUT)]
        still = [t for t, m in zip(tried, _measures(sources, tried, budget), strict=True) if above(m)]
        low, high = (still[-1] if still else low), tried[len(still)] if len(still) < len(tried) else high
    return high


def plan(sources: DataFrame, exponent: float, budget: float | None = None) -> DataFrame:
    """(source, docs, tokens, weight, budget, passes): ``budget`` None is the least that takes every source once."""
    w = sources.withColumn("w", F.when(F.col("p").isNotNull(), F.exp(F.log("p") * exponent)))
    z, least = w.agg(F.sum("w"), F.min(F.col("w") / F.col("tokens"))).first()
    total = budget if budget is not None else z / least if z else 0.0
    full = w.withColumn("weight", F.coalesce(F.col("w") / F.lit(z), F.lit(0.0))).withColumn("budget", F.col("weight") * F.lit(float(total)))
    # rounding must not turn a pass into one document less or more
    passes = F.when(F.col("tokens") > 0, F.round(F.col("budget") / F.col("tokens"), 9)).otherwise(0.0)
    return full.withColumn("passes", passes).select("source", "docs", "tokens", "weight", "budget", "passes")


def order_key(key: F.Column, epoch: F.Column | int, seed: int) -> F.Column:
    """A pass's permutation: a keyed hash in [0, 2^52)."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(epoch) if isinstance(epoch, int) else epoch, key), F.lit(HASH_SPAN))


def _block(order: str) -> F.Column:
    blocks = F.ceil(F.col("docs") / F.lit(BLOCK_DOCS)).cast("double")
    return F.floor(F.col(order).cast("double") / F.lit(float(HASH_SPAN)) * blocks).cast("long")


def _joined(left: DataFrame, plan_: DataFrame, n_sources: int) -> DataFrame:
    """Null-safe join on source; broadcast only within the bound."""
    right = plan_.withColumnRenamed("source", "__source")
    right = F.broadcast(right) if n_sources <= BROADCAST_SOURCES else right
    return left.join(right, left["source"].eqNullSafe(right["__source"])).drop("__source")


def cut_points(light: DataFrame, plan_: DataFrame, n_sources: int, seed: int) -> DataFrame:
    """(source, full, cut): whole passes, and the hash below which the partial pass takes documents. In: (source, key, tokens)."""
    work = _joined(light, plan_.select("source", "docs", F.col("tokens").alias("all_tokens"), "passes"), n_sources)
    work = work.withColumn("full", F.floor("passes").cast("int")).withColumn("need", (F.col("passes") - F.col("full")) * F.col("all_tokens"))
    work = work.filter("need > 0.5").withColumn("order", order_key(F.col("key"), F.col("full"), seed))
    work = work.withColumn("block", _block("order"))
    sums = work.groupBy("source", "block").agg(F.sum("tokens").alias("here"), F.first("need").alias("need"))
    sums = written(sums.withColumn("group", F.floor(F.col("block") / F.lit(GROUP_BLOCKS)).cast("long")), "blocks")
    # running sums over groups of blocks, and over the blocks of the group that meets the budget: no task has a source's blocks
    upto = lambda what, *by: F.coalesce(F.sum("here").over(Window.partitionBy(*by).orderBy(what).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = sums.groupBy("source", "group").agg(F.sum("here").alias("here"), F.first("need").alias("need")).withColumn("before", upto("group", "source"))
    groups = groups.filter("before < need AND before + here >= need").groupBy("source").agg(F.min(F.struct("group", "before")).alias("g"))
    groups = groups.select(F.col("source").alias("__s"), F.col("g.group").alias("__g"), F.col("g.before").alias("start"))
    inner = sums.join(groups, sums["source"].eqNullSafe(groups["__s"]) & (sums["group"] == groups["__g"])).drop("__s", "__g")
    inner = inner.withColumn("before", F.col("start") + upto("block", "source", "group"))
    edge = inner.filter("before < need AND before + here >= need").groupBy("source").agg(F.min(F.struct("block", "before")).alias("e")).select("source", "e.block", "e.before")
    inside = _joined(work, edge.withColumnRenamed("block", "edge_block"), n_sources).filter("block = edge_block")
    # rows of one order key (repeated rows) stay or go together
    steps = inside.groupBy("source", "order").agg(F.sum("tokens").alias("here"), F.first("before").alias("before"), F.first("need").alias("need"))
    taken = F.col("before") + F.coalesce(F.sum("here").over(Window.partitionBy("source").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = steps.withColumn("taken", taken).filter("taken < need").groupBy("source").agg((F.max("order") + 1).alias("cut"))
    named = plan_.select("source", F.floor("passes").cast("int").alias("full"), "docs", "weight", "budget", "passes")
    cut = cut.withColumnRenamed("source", "__source")
    return named.join(cut, named["source"].eqNullSafe(cut["__source"]), "left").drop("__source").withColumn("cut", F.coalesce("cut", F.lit(0)))


#: Columns that tell the order of what the mix takes, and all names that it uses inside.
ORDER = ("__epoch", "__block", "__order", "__weight")
_OWN = {*ORDER, "__source", "__key", "__tokens", "__s", "__full", "__cut", "__docs", "__copies"}


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    budget: float | None = None,
    entropy: float | None = None,
    max_passes: float | None = None,
    seed: int = SEED,
    copies_only: bool = False,
) -> DataFrame:
    """``docs``, each row as often as its source's budget takes it, and columns that give the order.

    __epoch is the pass (from 0), __block the block of that pass's permutation, __order the place inside it: sorting a
    source by these three gives its stream. __weight is the source's weight. copies_only: instead of the documents
    only (id_col, source_col, __tokens and those). Default aim: max_passes = MAX_PASSES under the least budget that
    takes every source once; then no document of a source with tokens is left out.

    A null source is a source of its own; null text has no tokens. A source without any token has weight 0 and goes.
    Documents of no tokens are taken as the hash order meets them. Repeated rows, and rows without id and of equal text,
    have one order and stay or go together. An empty table gives none.
    """
    if entropy is None and max_passes is None:
        max_passes = MAX_PASSES
    # columns of the input that are named like ours step aside, and ours then get longer names in the result
    aside = {c: free_name(docs, f"{c}_given") for c in docs.columns if c.lower() in _OWN}
    renamed = {c: free_name(docs, c) for c in ORDER}
    given, docs = docs, docs.withColumnsRenamed(aside)
    id_col, source_col, text_col = (aside.get(c, c) for c in (id_col, source_col, text_col))
    key = F.xxhash64(F.col(id_col), F.col(text_col)) if id_col in docs.columns else F.xxhash64(F.col(text_col))
    names = ["__source", "__key", "__tokens"]
    base = docs.withColumn("__key", F.when(F.col(id_col).isNotNull(), F.xxhash64(F.col(id_col))).otherwise(key)).withColumn("__tokens", token_count(F.col(text_col))).withColumn("__source", F.col(source_col))
    light = base.select(F.col("__source").alias("source"), F.col("__key").alias("key"), F.col("__tokens").alias("tokens"))
    light = written(light, "tokens")
    sources = source_table(light)
    n_sources = sources.count()
    exponent = bisect_exponent(sources, budget, entropy, max_passes)
    plan_ = written(plan(sources, exponent, budget), "plan")
    cuts = written(cut_points(light, plan_, n_sources, seed), "cuts")
    right = cuts.select(F.col("source").alias("__s"), F.col("full").alias("__full"), F.col("cut").alias("__cut"), F.col("docs"), F.col("weight").alias("__weight"))
    right = right.withColumnRenamed("docs", "__docs")
    if copies_only:
        base = base.select(id_col, source_col, *names)
    right = F.broadcast(right) if n_sources <= BROADCAST_SOURCES else right
    dealt = base.join(right, base["__source"].eqNullSafe(right["__s"]))
    last = (order_key(F.col("__key"), F.col("__full"), seed) < F.col("__cut")).cast("int")
    dealt = dealt.withColumn("__copies", F.col("__full") + last).filter("__copies > 0")
    dealt = dealt.withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
    dealt = dealt.withColumn("__order", order_key(F.col("__key"), F.col("__epoch"), seed))
    blocks = F.ceil(F.col("__docs") / F.lit(BLOCK_DOCS)).cast("double")
    dealt = dealt.withColumn("__block", F.floor(F.col("__order").cast("double") / F.lit(float(HASH_SPAN)) * blocks).cast("long"))
    kept = [id_col, source_col, "__tokens"] if copies_only else docs.columns
    dealt = dealt.select(*kept, *(F.col(c).alias(renamed[c]) for c in ORDER)).withColumnsRenamed({b: a for a, b in aside.items()})
    return dealt if copies_only else dealt.select(*given.columns, *renamed.values())


def op9_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, epoch, block, place, weight): a row for each time that the mix takes a document."""
    taken = mix(documents(spark, sf_dir), copies_only=True)
    return taken.select(
        "doc_id",
        "source",
        F.col("__tokens").alias("n_tokens"),
        F.col("__epoch").alias("epoch"),
        F.col("__block").alias("block"),
        F.col("__order").alias("place"),
        F.round("__weight", 9).alias("weight"),
    )
