"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams of a bounded sample of labelled documents of each language; the model is a matrix of
log-probabilities (buckets x languages), broadcast to the tasks. A batch of texts becomes a sparse matrix (rows of
texts, their buckets in a row), which is multiplied with the model in numpy, a bounded piece of text at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, documents, free_name, slices, written

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
SMOOTHING = 0.5
#: About how many labelled documents of each language training reads, the same for any size of the corpus; which ones is
#: fixed by a hash of id and text. Languages with fewer are read whole.
TRAIN_DOCS = 1_500
#: Languages of one broadcast matrix: BUCKETS * MAX_LANGUAGES * 4 bytes (32 MB). Models with more are scored in several passes.
MAX_LANGUAGES = 256
#: Languages up to this number are counted through a broadcast (a row of under 100 bytes each), more through a shuffle.
BROADCAST_LANGUAGES = 50_000
#: Characters turned into n-grams at a time.
PIECE = 1 << 18
UNDETERMINED = "und"
#: The pipeline rejects a document whose best language has less than this share of the posterior.
REJECT_BELOW = 0.5

_SEEDS = {n: np.uint32(0x9E3779B1 * n & 0xFFFFFFFF) for n in range(1, 9)}
_MULTIPLY = np.uint32(0x85EBCA6B)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (buckets, languages) log-probabilities
    priors: np.ndarray


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def pieces(text: str, size: int = PIECE) -> Iterator[np.ndarray]:
    """The lower-cased text's code points, cut into pieces that overlap by the longest n-gram less one."""
    overlap = max(ORDERS) - 1
    for at in range(0, len(text), size):
        yield np.frombuffer(text[max(0, at - overlap) : at + size].lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def buckets(points: np.ndarray, skip: int) -> list[np.ndarray]:
    """For each order the hashed buckets of the n-grams that end after the first ``skip`` points (seen before)."""
    found, rolling = [], None
    plain = points * _MULTIPLY
    plain ^= plain >> np.uint32(15)
    for n in ORDERS:
        rolling = plain.copy() if n == 1 else rolling[: len(points) - n + 1] * np.uint32(31) + plain[n - 1 :]
        hashes = (rolling ^ _SEEDS[n]) * _MULTIPLY
        found.append((hashes >> np.uint32(32 - 15))[max(0, skip - n + 1) :])
    return found


def gram_counts(text: str) -> np.ndarray:
    counts, seen = np.zeros(BUCKETS, np.int64), 0
    for points in pieces(text):
        for hashed in buckets(points, min(seen, max(ORDERS) - 1)):
            counts += np.bincount(hashed, minlength=BUCKETS)
        seen += len(points)
    return counts


def _blocks(texts: list[str], size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(points, lengths, texts' numbers, points seen before) of the texts' pieces one behind the other, about ``size`` points at a time."""
    held: list[np.ndarray] = []
    owners: list[int] = []
    seen_of: list[int] = []
    room = size

    def block():
        return np.concatenate(held), np.array([len(p) for p in held]), np.array(owners), np.array(seen_of)

    for row, text in enumerate(texts):
        seen = 0
        for points in pieces(text, size):
            held.append(points)
            owners.append(row)
            seen_of.append(min(seen, max(ORDERS) - 1))
            seen += len(points)
            room -= len(points)
            if room <= 0:
                yield block()
                held, owners, seen_of, room = [], [], [], size
    if held:
        yield block()


def scores(texts: list[str], model: Model) -> np.ndarray:
    """(texts, languages) log joint probabilities: the sparse matrix of the texts' buckets times the model."""
    total = np.tile(model.priors, (len(texts), 1)).astype(np.float64)
    # the rows of the model that a block gathers take about 64 MB at most
    size = max(1 << 10, min(PIECE, (1 << 24) // max(1, len(model.languages))))
    for points, lengths, owners, seen in _blocks(texts, size):
        begins = np.cumsum(lengths) - lengths
        piece = np.repeat(np.arange(len(lengths)), lengths)
        # the first n-gram that ends in new points starts here
        for n, hashed in zip(ORDERS, buckets(points, 0), strict=True):
            inside = piece[: len(piece) - n + 1] == piece[n - 1 :] if n > 1 else np.ones(len(piece), bool)
            if seen.any():
                first = begins + np.maximum(0, seen - n + 1)
                inside &= np.arange(len(inside)) >= first[piece[: len(inside)]]
            columns, rows = hashed[inside], piece[: len(inside)][inside]
            if not len(columns):
                continue
            starts = np.flatnonzero(np.diff(rows, prepend=-1))
            np.add.at(total, owners[rows[starts]], np.add.reduceat(model.weights[columns], starts, axis=0, dtype=np.float64))
    return total


def fit(docs: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id", docs_of_each: int = TRAIN_DOCS) -> Model:
    """A model of about ``docs_of_each`` rows of every label, among those with a non-null label and text.

    A row takes part if the hash of its id and text is among that share of all hashes; repeated rows take part once. The
    tasks count n-grams, sums by label and bucket are made by a grouped aggregate, and the driver gets at most BUCKETS
    numbers a label. No labelled row: a model without languages, which leaves every document undetermined.
    """
    labelled = docs.select(F.col(text_col).alias("body"), F.col(label_col).cast("string").alias("label"), F.col(id_col).alias("id")).filter("label IS NOT NULL AND body IS NOT NULL")
    # of the labels alone, so that this pass reads no texts
    sizes = docs.select(F.col(label_col).cast("string").alias("label")).filter("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("all"))
    few = sizes.limit(BROADCAST_LANGUAGES + 1).count() <= BROADCAST_LANGUAGES
    hashed = labelled.withColumn("h", F.xxhash64("id", "body")).join(F.broadcast(sizes) if few else sizes, "label")
    # the hash as a number from 0 to 1
    sample = hashed.filter(F.col("h").cast("double") / F.lit(2.0**64) + 0.5 < F.lit(float(docs_of_each)) / F.col("all"))
    sample = sample.groupBy("label", "h").agg(F.first("body").alias("body")).select("label", "body")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}

        def made() -> pa.RecordBatch:
            found = {x: np.flatnonzero(n) for x, n in sums.items()}
            return pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([rows[x] for x in sums], pa.int64()), pa.array([found[x] for x in sums], pa.list_(pa.int32())), pa.array([sums[x][found[x]] for x in sums], pa.list_(pa.int64()))],
                names=["label", "rows", "bucket", "n"],
            )

        for batch in slices(batches):
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[label] = sums.get(label, 0) + gram_counts(text)
                rows[label] = rows.get(label, 0) + 1
                if len(sums) >= MAX_LANGUAGES:
                    yield made()
                    sums, rows = {}, {}
        if sums:
            yield made()

    parts = written(sample.mapInArrow(count, "label string, rows long, bucket array<int>, n array<long>"), "grams")
    rows = dict(parts.groupBy("label").agg(F.sum("rows")).collect())  # one row a language
    languages = sorted(rows)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    sums = parts.select("label", F.inline(F.arrays_zip("bucket", "n"))).groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    # a language's list has at most BUCKETS entries
    sums = sums.groupBy("label").agg(F.collect_list(F.struct("bucket", "n")).alias("x")).select("label", "x.bucket", "x.n")
    weights = np.empty((BUCKETS, len(languages)), np.float32)
    for r in sums.toLocalIterator():
        counts = np.full(BUCKETS, SMOOTHING)
        counts[r["bucket"]] += r["n"]
        weights[:, languages.index(r["label"])] = np.log(counts / counts.sum())
    discard(parts)
    known = np.array([rows[x] for x in languages], float)
    return Model(languages, weights, np.log(known / known.sum()))


#: What is known of a text after some passes: the best language, its log joint probability, the sum of all relative to that.
Standing = tuple[str, float, float]


def judged(texts: list[str | None], model: Model, before: list[Standing] | None = None) -> list[Standing]:
    """Standings after the languages of ``model``, behind those ``before``. und for null and for text without letters; ties go to the first language by name."""
    found = list(before) if before else [(UNDETERMINED, -math.inf, 0.0)] * len(texts)
    asked = [i for i, x in enumerate(texts) if x and has_letter(x)] if model.languages else []
    if asked:
        total = scores([texts[i] for i in asked], model)
        best = total.argmax(axis=1)
        top = total[np.arange(len(asked)), best]
        rest = np.exp(np.clip(total - top[:, None], -700, 0)).sum(axis=1)
        for i, b, t, r in zip(asked, best.tolist(), top.tolist(), rest.tolist(), strict=True):
            name, old, sum_ = found[i]
            if t > old:
                found[i] = (model.languages[b], t, r + (sum_ * math.exp(max(-700.0, old - t)) if sum_ else 0.0))
            else:
                found[i] = (name, old, sum_ + r * math.exp(max(-700.0, t - old)))
    return found


def predict(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    """(languages, posteriors); und and 0.0 for null and for text without letters. Ties go to the first language by name."""
    found = judged(texts, model)
    return [n for n, _, _ in found], [1 / s if s else 0.0 for _, _, s in found]


def with_language(docs: DataFrame, model: Model, text_col: str = "text", lang_to: str = "lang_pred", score_to: str = "score") -> DataFrame:
    """``docs`` and two more columns. Every row stays, repeated ones alike; existing columns of those two names are replaced.

    Null text and text without letters is und with score 0; so is all text if the model has no languages. An empty table
    gives none. Whole texts are scored, however long.
    """
    context = docs.sparkSession.sparkContext
    base = docs.drop(lang_to, score_to)
    at = base.columns.index(text_col)
    passes = range(0, max(1, len(model.languages)), MAX_LANGUAGES)
    held = ["__name", "__top", "__sum"]
    for first in passes:
        part = slice(first, first + MAX_LANGUAGES)
        shared = context.broadcast(Model(model.languages[part], np.ascontiguousarray(model.weights[:, part]), model.priors[part]))
        last = first == passes[-1]

        def run(batches: Iterator[pa.RecordBatch], shared=shared, first=first, last=last) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                columns = batch.columns[:-3] if first else batch.columns
                before = list(zip(*(c.to_pylist() for c in batch.columns[-3:]), strict=True)) if first else None
                found = judged(batch.column(at).to_pylist(), shared.value, before)
                if last:
                    more = [pa.array([n for n, _, _ in found], pa.string()), pa.array([1 / s if s else 0.0 for _, _, s in found], pa.float64())]
                else:
                    more = [pa.array([f[i] for f in found], k) for i, k in enumerate((pa.string(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([*columns, *more], names=[*batch.schema.names[: len(columns)], *([lang_to, score_to] if last else held)])

        fields = base.schema.fields
        new = [T.StructField(lang_to, T.StringType()), T.StructField(score_to, T.DoubleType())] if last else [T.StructField(n, t) for n, t in zip(held, (T.StringType(), T.DoubleType(), T.DoubleType()), strict=True)]
        docs = (docs if first else base).mapInArrow(run, T.StructType([*fields, *new]))
    return docs


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 0 modulo 5; a null id counts as held out: it never trains."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def reject(docs: DataFrame, model: Model, text_col: str = "text", least: float = REJECT_BELOW) -> DataFrame:
    """``docs`` without the documents that have no determined language or a posterior under ``least``. Columns as they are."""
    columns = docs.columns
    pred, sure = free_name(docs, "__lang_pred"), free_name(docs, "__lang_score")
    judged = with_language(docs, model, text_col, pred, sure)
    return judged.filter((F.col(pred) != UNDETERMINED) & (F.col(sure) >= least)).select(*columns)


def op4_naive_bayes_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").withColumn("held_out", held_out())
    model = fit(docs.filter("NOT held_out"))
    return with_language(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")
