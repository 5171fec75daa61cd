"""SimHash near-duplicates: fingerprints of word shingles, linked at a small Hamming distance.

A link between two fingerprints is found in two exact steps, neither of which pairs up a dense group:

* *Balls*: the anchors are all words (covering radius 0), and a fingerprint is replicated to the 65 within distance 1 of
  it. Two fingerprints share one exactly if they differ in at most 2 bits, and all that share one do, so a star for each
  anchor, of at most 65 members, links them without comparing.
* *Anchors*: the anchors of a half (32 bits) are the words of the [31,26] Hamming code with the last bit left free; they
  cover the half with radius 1. Two fingerprints at distance 3 differ in at most 1 bit in one half. A fingerprint is
  at home at its nearest anchor and is replicated to every anchor within the covering radius plus that threshold (2),
  so one of the pair meets the other at the other's home. As the other half differs in at most 3 bits, one of its
  four bytes is equal: all are dealt by anchor and each of these bytes at once, so the rows are in proportion to the
  fingerprints. Pairs are compared only across the classes that the balls have made already: first each is held against
  the least and the greatest class at home under its key, and of those that meet another class only members outside the
  key's largest class meet the rest.

Both together are exact for thresholds up to 3, and other thresholds are refused. Classes come from connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary_column, discard, documents, free_name, shuffled, slices, spread, words_of, written
from .components import connected_components

SHINGLE_WORDS = 3
SEED = 42
THRESHOLD = 3
#: Shingles hashed before their bits are counted: bounds memory for a very long text.
CHUNK = 65_536


def fingerprint(text: bytes | None) -> int:
    """64-bit SimHash as an unsigned integer; 0 for null and for text without words.

    A-Z are lower-cased; fewer words than a shingle make one shingle of them all; a bit is 1 if it is set in over
    half the shingle hashes.
    """
    words = words_of(text.lower() if text else None)
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    counts, digest, join = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, CHUNK):
        end = min(n, at + CHUNK)
        hashes = [digest(join(words[i : i + SHINGLE_WORDS]), SEED) for i in range(at, end)]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long): each row's fingerprint with its bits as a signed long."""
    return _fingerprinted(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body")))


def _fingerprinted(light: DataFrame) -> DataFrame:
    """(all columns but the last, fp) of rows whose last column is the text."""
    names = light.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = np.array([fingerprint(x) for x in binary_column(part, "body").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found.view(np.int64))], names=[*names, "fp"])

    schema = T.StructType([*light.schema.fields[:-1], T.StructField("fp", T.LongType())])
    return light.mapInArrow(run, schema)


def _flips() -> list[int]:
    """0 and the 64 single bits, as signed longs."""
    return [0, *(1 << i for i in range(63)), -(1 << 63)]


def ball_edges(fps: DataFrame) -> DataFrame:
    """(a, b) edges that connect all distinct fingerprints within distance 2 of each other."""
    masks = F.array(*[F.lit(m).cast("long") for m in _flips()])
    near = spread(fps, "fp").select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    groups = near.groupBy("point").agg(F.collect_list("fp").alias("members")).filter(F.size("members") > 1)
    return (
        groups.select(F.array_min("members").alias("a"), F.explode("members").alias("b")).filter("a <> b").distinct()
    )


def anchor_masks() -> tuple[list[int], list[list[int]]]:
    """What leads from a 31-bit word to anchors, by its syndrome s (0 to 31).

    Position p (1 to 31) has the syndrome p. home[s] turns the word into the nearest code word. near[s] are the masks
    of weight up to 2 that turn it into a code word: all code words within distance 2.
    """
    bit = [0, *(1 << (p - 1) for p in range(1, 32))]
    near: list[list[int]] = [[] for _ in range(32)]
    for s in range(32):
        near[s].append(bit[s])
        near[s] += [bit[p] | bit[q] for p in range(1, 32) for q in range(p + 1, 32) if p ^ q == s]
    return bit, near


def _halves(classes: DataFrame) -> DataFrame:
    """(fp, root, word, top, s, first, parts): a row per half: its 31-bit word, last bit, syndrome and nearest anchor, and what marks it off.

    In: (fp, root). parts: the half's side and each byte of the other half with its place, as whole numbers below 2**11.
    """
    home, _ = anchor_masks()
    syndrome = "0"
    for j in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1)
        syndrome = f"{syndrome} + (bit_count(word & {mask}L) & 1) * {1 << j}"
    low, high = "fp & 4294967295L", "shiftrightunsigned(fp, 32)"
    sides = f"array(struct(0 AS side, {low} AS half, {high} AS other), struct(1 AS side, {high} AS half, {low} AS other))"
    halves = spread(classes, "fp").select("fp", "root", F.explode(F.expr(sides)).alias("x"))
    parts = ", ".join(f"(shiftright(x.other, {8 * i}) & 255L) + {i << 8} + x.side * 1024" for i in range(4))
    halves = halves.select("fp", "root", F.expr("x.half & 2147483647L").alias("word"), F.expr("x.half & 2147483648L").alias("top"), F.expr(f"array({parts})").alias("parts"))
    nearest = ", ".join(f"{m}L" for m in home)
    return halves.withColumn("s", F.expr(f"cast({syndrome} as int)")).withColumn("first", F.expr(f"word ^ array({nearest})[s]"))


def _keyed(rows: DataFrame) -> DataFrame:
    """(key, fp, root): each row once for each of its parts; key: anchor, side, place and byte in one number."""
    rows = rows.select("anchor", "fp", "root", F.explode("parts").alias("part"))
    return rows.select(F.expr("shiftleft(anchor, 11) | part").alias("key"), "fp", "root")


def home_rows(classes: DataFrame) -> DataFrame:
    """(key, fp, root): a fingerprint under the nearest anchor of each half, by each byte of the other: 8 rows each."""
    return _keyed(_halves(classes).withColumn("anchor", F.expr("first | top")))


def near_rows(classes: DataFrame) -> DataFrame:
    """(key, fp, root): a fingerprint under all anchors within radius 2 of each half, by each byte of the other: at most 136 rows each.

    The half's bit 31 is kept in the anchor; a row for its flipped value stands for the anchors that differ there, of
    which those within distance 1 in the other 31 bits are within 2 in all.
    """
    _, near = anchor_masks()
    table = ", ".join("array(" + ", ".join(f"{m}L" for m in masks) + ")" for masks in near)
    anchors = f"concat(transform(array({table})[s], m -> (word ^ m) | top), array(first | (top ^ 2147483648L)))"
    return _keyed(_halves(classes).select("fp", "root", "parts", F.explode(F.expr(anchors)).alias("anchor")))


def anchor_edges(classes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(a, b) of classes (roots) that have fingerprints within ``threshold`` of each other. In: (fp, root).

    Keys have one row for all that are at home there, so telling who meets another class is in proportion to the input, however dense a key is.
    """
    if not 0 <= threshold <= THRESHOLD:
        raise ValueError(f"the anchors reach thresholds of 0 to {THRESHOLD} bits, not {threshold}")
    homes = home_rows(classes)
    lived = written(homes.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")), "anchors")
    visits = written(near_rows(classes).join(shuffled(lived), "key").filter("lo <> root OR hi <> root").drop("lo", "hi"), "visits")
    discard(lived)
    hosts = homes.join(shuffled(visits.select("key").distinct()), "key", "left_semi")
    rows = written(visits.withColumn("home", F.lit(False)).unionByName(hosts.withColumn("home", F.lit(True))), "parts")
    discard(visits)
    largest = rows.groupBy("key", "root").count().groupBy("key").agg(F.max_by("root", F.struct("count", "root")).alias("main"))
    outside = rows.join(shuffled(largest), "key").filter("root <> main").drop("main")
    x = outside.select("key", F.col("fp").alias("x"), F.col("root").alias("xr"), F.col("home").alias("xh"))
    y = rows.select("key", F.col("fp").alias("y"), F.col("root").alias("yr"), F.col("home").alias("yh"))
    pairs = x.join(shuffled(y), "key").filter(f"xr <> yr AND (xh OR yh) AND bit_count(x ^ y) <= {threshold}")
    return pairs.select(F.least("xr", "yr").alias("a"), F.greatest("xr", "yr").alias("b")).distinct()


def fingerprint_classes(fps: DataFrame) -> DataFrame:
    """(fp, class): the class of every distinct fingerprint, equal for all that links of up to 3 bits connect."""
    fps = written(fps.select("fp").distinct(), "fingerprints")
    close = connected_components(ball_edges(fps), "a", "b")
    classes = written(
        fps.join(shuffled(close), fps.fp == close.node, "left").select("fp", F.coalesce("root", "fp").alias("root")), "classes"
    )
    far = connected_components(anchor_edges(classes), "a", "b").select(F.col("node").alias("root"), F.col("root").alias("class"))
    return classes.join(shuffled(far), "root", "left").select("fp", F.coalesce("class", "root").alias("class"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fingerprint, component_id), a row per row of ``docs``.

    component_id is the smallest id reachable over links, the row's own included. Null text and text without words
    have the fingerprint zero and link like any other. A null id gets its group's smallest id, which is null only if
    the group has no other id. Repeated rows stay repeated. Other columns are not read, so their names can't clash.
    """
    rows = written(with_fingerprints(docs, id_col, text_col), "simhash")
    classes = fingerprint_classes(rows)
    least = rows.groupBy("fp").agg(F.min("id").alias("least")).join(shuffled(classes), "fp")
    named = least.groupBy("class").agg(F.min("least").alias("component_id"))
    members = classes.join(shuffled(named), "class").select("fp", "component_id")
    return rows.join(shuffled(members), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest id, where ids are null that of a null id.

    Rows are told apart by id and text, so ids may repeat, with texts of one group or of several: of rows of the smallest
    id in a group that with the least fingerprint, then the least hash of the text stays, once. The columns stay as
    they are. Null text and text without words make one group. An empty table gives none.
    """
    text = F.xxhash64(text_col)
    rows = written(_fingerprinted(docs.select(F.col(id_col).alias("id"), text.alias("h"), F.col(text_col).alias("body"))), "simhash")
    classes = fingerprint_classes(rows)
    least = rows.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp", "h")).alias("first")).join(shuffled(classes), "fp")
    chosen = least.groupBy("class").agg(F.min("first").alias("first")).select(F.col("first.id").alias("__id"), F.col("first.h").alias("__h"))
    name = free_name(docs, "__text")
    marked = docs.withColumn(name, text)
    kept = marked.join(chosen, marked[id_col].eqNullSafe(chosen["__id"]) & (marked[name] == chosen["__h"]), "left_semi")
    return kept.dropDuplicates([id_col, name]).drop(name)


def op7_simhash_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
