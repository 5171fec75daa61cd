"""Exact removal of repeated word spans with a sparse de Bruijn graph over the whole corpus.

A *window* is ``window`` consecutive words; every word under a window that also starts anywhere else goes.

Nodes are token k-mers, one minimizer for each window (the least k-mer hash in it), so two equal windows always share
their minimizer at the same offset. An edge leads from a selected k-mer to the next one of the document and is known by
the hash of all words from the one's start to the other's end; the ends of a document are edges too. A node is
*unbranching* on a side if all its occurrences have one and the same edge there. Edge statistics are one grouped
aggregate, joined back to the source coordinates. Then, for a window with minimizer m:

* m occurs once: the window occurs once.
* the window lies on the unbranching path round m: each occurrence of m carries the whole path, so the window is
  repeated, and no more needs to be looked at. This compacts long repeats and whole copies to a few rows.
* else the window touches a branching point: its own 128-bit digest goes to an exact count over all such windows.

All occurrences of one window fall in the same case, so the counts are whole. Words themselves are hashed from the
source text at the coordinates, never from k-mer ids. In the second case the k-mer's hash and those of all words on
either side, 64 bits each, agree at every occurrence: as many bits as in the third, so that chance agreement needs no care.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary_column, discard, documents, slices, words_of, written

WINDOW = 35
K = 11

_BASE = np.uint64(0x9E3779B97F4A7C17)  # odd, and BASE - 1 has one factor 2: prefix sums stay invertible
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 4096)
        for at, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[at] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


class Spelling:
    """Hashes of any span of a document's words in constant time each, from prefix sums modulo 2^64."""

    def __init__(self, words: list[bytes]):
        digest, n = xxhash.xxh64_intdigest, len(words)
        up, self.down = _power_tables(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(np.array([digest(w) for w in words], np.uint64) * up[:n], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = (ends - starts).astype(np.uint64)
        return _mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + _mix(length))


def minimizers(spelling: Spelling, n: int, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(selected k-mer starts, their hashes, for each window start the index of its minimizer among them)."""
    starts = np.arange(n - k + 1)
    hashes = spelling.spans(starts, starts + k)
    width = window - k + 1
    least = np.lib.stride_tricks.sliding_window_view(hashes, width).argmin(axis=1) + np.arange(n - window + 1)
    chosen, of = np.unique(least, return_inverse=True)
    return chosen, hashes[chosen], of


def _graph_rows(words: list[bytes], window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(starts, hashes, edges) of a document's selected k-mers, an edge at either side of each; None if it has no window."""
    n = len(words)
    if n < window:
        return None
    spelling = Spelling(words)
    at, kmer, _ = minimizers(spelling, n, window, k)
    inner = spelling.spans(at[:-1], at[1:] + k)
    first = _mix(spelling.spans(np.zeros(1, np.int64), at[:1] + k) + np.uint64(1))
    last = _mix(spelling.spans(at[-1:], np.array([n])) + np.uint64(2))
    return at, kmer, np.concatenate([first, inner, last])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, part, seal, body): part and seal tell rows apart; rows equal in both are equal in id and text.

    Where all ids are different integers the id alone does so, and the seal is 0, which takes no room in a shuffle. Ids of
    other types are known by two hashes of 64 bits.
    """
    key, text = F.col(id_col), F.col(text_col)
    ids = docs.select(key.alias("id"))
    whole = isinstance(ids.schema["id"].dataType, T.IntegralType)
    apart = whole and ids.filter("id IS NULL").isEmpty() and ids.groupBy("id").count().filter("count > 1").isEmpty()
    part = F.coalesce(key.cast("long"), F.lit(0)) if whole else F.xxhash64(key)
    seal = F.lit(0).cast("long") if apart else F.xxhash64(F.lit(1), key, text)
    return docs.select(key.alias("id"), part.alias("part"), seal.alias("seal"), text.alias("body"))


def occurrences(keyed: DataFrame, window: int, k: int) -> DataFrame:
    """(part, seal, at, kmer, edge): a row per document with windows: its selected k-mers, and the edges round them, one more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [_graph_rows(words_of(text), window, k) for text in binary_column(batch, "body").to_pylist()]
            full = pa.array([r is not None for r in rows])
            rows = [r for r in rows if r is not None]
            lists = [
                pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                *(pa.array([r[i].view(np.int64) for r in rows], pa.list_(pa.int64())) for i in (1, 2)),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(full), batch.column(1).filter(full), *lists], names=["part", "seal", "at", "kmer", "edge"])

    return keyed.select("part", "seal", "body").mapInArrow(run, "part long, seal long, at array<int>, kmer array<long>, edge array<long>")


def path_marks(found: DataFrame) -> DataFrame:
    """(part, seal, marks): for a document, its repeated nodes as start * 4 + unbranching left + 2 * unbranching right."""
    sides = F.transform("kmer", lambda m, i: F.struct(m.alias("kmer"), F.get("edge", i).alias("left"), F.get("edge", i + 1).alias("right")))
    nodes = (
        found.select(F.inline(sides))
        .groupBy("kmer")
        .agg(F.count("*").alias("n"), F.min("left").alias("l0"), F.max("left").alias("l1"), F.min("right").alias("r0"), F.max("right").alias("r1"))
        .filter("n > 1")
        .select("kmer", F.expr("cast(l0 = l1 as int) + 2 * cast(r0 = r1 as int)").alias("sides"))
    )
    # written, so that the join gets both sides from shuffles of their own and can split a k-mer with very many rows
    nodes = written(nodes, "nodes")
    marks = found.select("part", "seal", F.inline(F.arrays_zip("at", "kmer"))).join(nodes, "kmer")
    # a set: rows equal in id and text have equal marks, however many they are
    return marks.groupBy("part", "seal").agg(F.collect_set(F.expr("cast(at as long) * 4 + sides")).alias("marks"))


def judge(words: list[bytes], marks: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts of windows known to be repeated, starts of windows that need a count)."""
    n, none = len(words), np.zeros(0, np.int64)
    if n < window or not len(marks):
        return none, none
    at, _, of = minimizers(Spelling(words), n, window, k)
    sides = np.full(len(at), -1)
    marks = np.asarray(marks, np.int64)
    sides[np.searchsorted(at, marks >> 2)] = marks & 3
    left_open, right_open, order = (sides & 1) == 1, (sides & 2) == 2, np.arange(len(at))
    left_open &= sides >= 0
    right_open &= sides >= 0
    # the path reaches to the last node at or before this one that branches on its left, or to the text's start
    stop = np.maximum.accumulate(np.where(left_open, -1, order))
    reach_left = np.where(stop < 0, 0, at[stop])
    stop = np.minimum.accumulate(np.where(right_open, len(at), order)[::-1])[::-1]
    reach_right = np.where(stop == len(at), n, at[np.minimum(stop, len(at) - 1)] + k)
    starts = np.arange(n - window + 1)
    repeated = sides[of] >= 0
    sure = repeated & (reach_left[of] <= starts) & (starts + window <= reach_right[of])
    return starts[sure], starts[repeated & ~sure]


def covered(starts: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of n words lie under a window that begins at one of ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return np.cumsum(steps[:n]) > 0


def _spans(gone: np.ndarray) -> list[int]:
    """[start, end, start, end ...] of the runs that are gone."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    return edges.tolist()


def _outcome(words: list[bytes], gone: np.ndarray | None, digest: bool) -> tuple[int, int, list[int], object]:
    """(words, words removed, spans removed, the kept text or its SHA-256)."""
    kept = words if gone is None else [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    text = b" ".join(kept)
    return len(words), len(words) - len(kept), [] if gone is None else _spans(gone), hashlib.sha256(text).hexdigest() if digest else text.decode()


_RESULT = "id {id}, n_words long, n_removed long, spans array<int>, kept string"


def remove_repeated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, k: int = K, digest: bool = False
) -> DataFrame:
    """(id_col, n_words, n_removed, spans, kept): a row per row of ``docs`` without its repeated windows.

    spans holds word positions [start, end, ...] that went; kept is the remaining words joined by one space, or with
    ``digest`` the SHA-256 of that in hex. Null text has no words and keeps an empty text. Fewer words than a window:
    nothing goes. Repeated rows are repeats of each other, null ids included. Ids may be of any type. An empty table gives
    none. Other columns are not read. Whole texts are looked at, however long.
    """
    keyed = _keyed(docs, id_col, text_col)
    id_type = keyed.schema["id"].dataType.simpleString()
    found = written(occurrences(keyed, window, k), "kmers")
    marked = keyed.join(path_marks(found), ["part", "seal"], "left").select("id", "part", "seal", "body", "marks")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bodies, marks = binary_column(batch, "body").to_pylist(), batch.column(4).to_pylist()
            rows: dict[str, list] = {x: [] for x in ("n_words", "n_removed", "spans", "kept", "body", "sure", "open", "hi", "lo")}
            for text, mark in zip(bodies, marks, strict=True):
                words = words_of(text)
                sure, unsure = judge(words, np.array(mark or [], np.int64), window, k)
                if len(unsure):
                    seen = [xxhash.xxh3_128_intdigest(b" ".join(words[p : p + window])) for p in unsure.tolist()]
                    result = (len(words), None, None, None)
                    more = (text.decode(), sure.tolist(), unsure.tolist(), [(x >> 64) - (1 << 63) for x in seen], [(x & (1 << 64) - 1) - (1 << 63) for x in seen])
                else:
                    result = _outcome(words, covered(sure, len(words), window) if len(sure) else None, digest)
                    more = (None, None, None, None, None)
                for name, value in zip(rows, (*result, *more), strict=True):
                    rows[name].append(value)
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), *(pa.array(v, t) for v, t in zip(rows.values(), kinds, strict=True))],
                names=["id", "part", "seal", *rows],
            )

    schema = f"id {id_type}, part long, seal long, n_words long, n_removed long, spans array<int>, kept string, body string, sure array<int>, open array<int>, hi array<long>, lo array<long>"
    judged = written(marked.mapInArrow(first, schema), "judged")
    discard(found)
    waiting = judged.filter("body IS NOT NULL")
    windows = waiting.select("part", "seal", F.explode(F.arrays_zip("open", "hi", "lo")).alias("w")).select("part", "seal", "w.open", "w.hi", "w.lo")
    twice = written(windows.groupBy("hi", "lo").count().filter("count > 1").select("hi", "lo"), "twice")
    more = windows.join(twice, ["hi", "lo"], "left_semi").groupBy("part", "seal").agg(F.collect_set("open").alias("more"))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text, sure, added in zip(binary_column(batch, "body").to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words, starts = words_of(text), np.unique(np.array([*sure, *(added or [])], np.int64))
                rows.append(_outcome(words, covered(starts, len(words), window) if len(starts) else None, digest))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))], names=["id", "n_words", "n_removed", "spans", "kept"]
            )

    rest = waiting.select("id", "part", "seal", "body", "sure").join(more, ["part", "seal"], "left").select("id", "body", "sure", "more")
    done = judged.filter("body IS NULL").select("id", "n_words", "n_removed", "spans", "kept")
    result = done.unionByName(rest.mapInArrow(second, _RESULT.format(id=id_type)))
    return result.withColumnRenamed("id", id_col)


def op2_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(documents(spark, sf_dir), digest=True).select(
        "doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256")
    )
