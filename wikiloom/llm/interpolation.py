"""Operator 11: scoring of texts by a bigram model with deleted interpolation.

The probability of a token after its predecessor mixes three estimates: the bigram's and the word's maximum likelihood, and 1/(V+1).
The mixture depends on how often the predecessor was seen (buckets of powers of two). Its weights are learned by
expectation-maximisation on a held-out part of the training counts, the documents of one fold, against counts from which that part is deleted;
scores then use the counts of all training documents. Each text is words and one end; the end is also what stands before a text's first word.

Rows: a null text is empty (one token, the end); a null id is held out, like ids whose crc32 leaves 0, and never trains. Repeated rows
each train and each get a row. Without training documents all words are unknown, and every token has probability 1/(V+1) = 1.
A word after a predecessor never seen gets the bigram's weight shared out among the others. Other columns are not read.

Scale: texts are coded once, in chunks of about CHUNK tokens with a word list of their own, and written. A chunk asks once for each of its different words,
and then for each of its different bigrams. Both are dealt to parts and go there as packed blocks, one a chunk and part, so that none is a row of its own in a
shuffle. A part adds up all counts of what it holds, numbers its words, and answers each block. The commonest word or bigram is as many entries as there
are chunks. Each chunk then adds up its own texts. The driver holds only weights, three a bucket, at most 64 buckets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, documents, written

#: crc32 of the id modulo FOLDS: 0 is held out from training; 1 is the part of the training that weights are learned on.
FOLDS, HELD, DELETED = 10, 0, 1
#: Added to counts of the base score.
ADDED = 0.1
#: Tokens of a chunk; most rounds of expectation-maximisation, and the change of a weight at which they end.
CHUNK, ROUNDS, ENOUGH = 1_000_000, 20, 1e-3
#: Training tokens, or words of chunks, a part: it holds at most as many entries on average.
PART = 2_000_000
#: Events spread over a bucket's weights, so that none becomes 0.
PRIOR = 1e-3


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text modulo FOLDS; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS, F.lit(HELD)).cast("int")


class _Codes(dict):
    """Word -> number in the order of their first use; 0 is the end."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers of one length as planes of bytes, compressed."""
    planes = (np.ascontiguousarray(a.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays)
    return pa.compress(b"".join(planes), "zstd", asbytes=True)


def unpacked(block: bytes, length: int, arrays: int = 1) -> list[np.ndarray]:
    """What ``packed`` got: ``arrays`` of ``length`` numbers."""
    raw = pa.decompress(block, length * 8 * arrays, "zstd", asbytes=True)
    return [np.ascontiguousarray(p.T).view(np.int64).ravel() for p in np.frombuffer(raw, np.uint8).reshape(arrays, 8, length)]


CHUNKS = "chunk string, words array<string>, rows array<long>, ids array<long>, folds array<int>, lengths array<int>, codes binary"


def coded(docs: DataFrame, id_col: str, text_col: str, chunk: int = CHUNK) -> DataFrame:
    """Texts as chunks: words by code; for each piece of a text its row, id, fold and number of codes (one before it, then its tokens).

    A text that is longer than the rest of a chunk goes on in the next, beginning with its last code.
    """
    schema = pa.schema([("chunk", pa.string()), ("words", pa.list_(pa.string())), ("rows", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())), ("folds", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int32())), ("codes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row, number = TaskContext.get().partitionId(), 0, 0
        words, pieces, held = _Codes({b"": 0}), [], []

        def out() -> pa.RecordBatch:
            nonlocal words, pieces, held, number
            listed = pa.array(list(words), pa.binary()).cast(pa.string()).to_pylist()
            rows, ids, folds, lengths = (list(c) for c in zip(*pieces, strict=True))
            made = [f"{task}-{number}", listed, rows, ids, folds, lengths, packed(np.concatenate(held))]
            number, words, pieces, held = number + 1, _Codes({b"": 0}), [], []
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(made, schema, strict=True)], schema=schema)

        size = 0
        for batch in batches:
            ids, folds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, (doc_id, of) in enumerate(zip(ids, folds, strict=True)):
                # bytes.lower changes A-Z only, and bytes.split cuts at the six white-space bytes
                tokens, before = (batch.column(2)[at].as_py() or b"").lower().split(), b""
                tokens.append(b"")
                for low in range(0, len(tokens), chunk):
                    part = tokens[low : low + chunk]
                    codes = np.fromiter(map(words.__getitem__, [before, *part]), np.uint32, len(part) + 1)
                    pieces.append(((task << 40) + row, doc_id, of, len(codes)))
                    held.append(codes)
                    before, size = part[-1], size + len(codes)
                    if size >= chunk:
                        yield out()
                        size = 0
                row += 1
        if pieces:
            yield out()

    return docs.select(F.col(id_col).cast("long"), fold(id_col), F.col(text_col).cast("binary")).mapInArrow(run, CHUNKS)


def _tokens(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code before, code, piece) of each token."""
    inside = np.ones(len(codes), bool)
    inside[np.cumsum(lengths) - lengths] = False
    return codes[:-1][inside[1:]], codes[1:][inside[1:]], np.repeat(np.arange(len(lengths)), lengths - 1)


def _dealt(part: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part and which entries it gets, as they come in ``order``."""
    order = order[np.argsort(part[order], kind="stable")]
    parts, first = np.unique(part[order], return_index=True)
    yield from zip(parts.tolist(), np.split(order, first[1:]), strict=True)


def _word_parts(words: pa.Array, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    part = np.fromiter((crc32(w) % parts for w in words.cast(pa.binary()).to_pylist()), np.int64, len(words))
    return _dealt(part, np.arange(len(words)))


COUNTS = ("word_n", "word_d", "prev_n", "prev_d")


def word_counts(chunks: DataFrame, parts: int) -> DataFrame:
    """(chunk, part, size, names, block): words of a chunk, and how often each stands there in training and in the deleted fold, and before another."""
    schema = pa.schema([("chunk", pa.string()), ("part", pa.int64()), ("size", pa.int32()), ("names", pa.list_(pa.string())), ("block", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                chunk, words, folds, lengths, codes = (batch.column(name)[at] for name in ("chunk", "words", "folds", "lengths", "codes"))
                lengths, words = np.array(lengths.as_py()), words.values
                before, code, piece = _tokens(unpacked(codes.as_py(), int(lengths.sum()))[0], lengths)
                of = np.array(folds.as_py())[piece]
                counts = [np.bincount(c[m], minlength=len(words)) for c in (code, before) for m in (of != HELD, of == DELETED)]
                for part, some in _word_parts(words, parts):
                    names = words.take(pa.array(some))
                    row = [chunk.as_py()], [part], [len(some)], pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), names), [packed(*(c[some] for c in counts))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if isinstance(c, list) else c for c, f in zip(row, schema, strict=True)], schema=schema)

    return chunks.select("chunk", "words", "folds", "lengths", "codes").mapInArrow(run, "chunk string, part long, size int, names array<string>, block binary")


def _totals(which: np.ndarray, values: Iterable[np.ndarray], count: int) -> list[np.ndarray]:
    """Sums of whole numbers by entry, exact below 2**53."""
    return [np.bincount(which, v, count).astype(np.int64) for v in values]


def _numbered(part: pa.Table) -> pa.Table:
    """Each block of a part with the numbers and the counts of its words in all chunks, and how many words and tokens the part has."""
    sizes = part.column("size").to_pylist()
    names = pa.concat_arrays([b.values for b in part.column("names")]).dictionary_encode()
    which, count = names.indices.to_numpy(), len(names.dictionary)
    blocks = [unpacked(b.as_py(), size, 4) for b, size in zip(part.column("block"), sizes, strict=True)]
    sums = _totals(which, (np.concatenate(c) for c in zip(*blocks, strict=True)), count)
    number = (part.column("part")[0].as_py() << 32) + which.astype(np.int64)
    cuts = np.cumsum(sizes)[:-1]
    answers = [packed(*of) for of in zip(*(np.split(c, cuts) for c in (number, *(t[which] for t in sums))), strict=True)]
    facts = {"different": np.count_nonzero(sums[0]), "tokens": int(sums[0].sum()), "deleted": int(sums[1].sum())}
    return pa.table({"of": part.column("chunk"), "part": part.column("part"), "answer": pa.array(answers, pa.binary()), **{k: pa.array([v] * len(sizes), pa.int64()) for k, v in facts.items()}})


def seen(chunks: DataFrame, part: int = PART) -> tuple[DataFrame, int]:
    """(of, part, answer, different, tokens, deleted): numbers and counts of the words each chunk has asked a part for; and how many parts there are."""
    entries = chunks.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = max(1, -(-entries // part))
    answers = word_counts(chunks, parts).groupBy("part").applyInArrow(_numbered, "of string, part long, answer binary, different long, tokens long, deleted long")
    return written(answers, "words"), parts


def totals(words_seen: DataFrame) -> tuple[int, int, int]:
    """Training tokens, those of the deleted fold, and different training words."""
    by_part = words_seen.groupBy("part").agg(*(F.first(c).alias(c) for c in ("tokens", "deleted", "different")))
    return tuple(v or 0 for v in by_part.agg(F.sum("tokens"), F.sum("deleted"), F.sum("different")).first())


KNOWN = "chunk string, rows array<long>, ids array<long>, folds array<int>, lengths array<int>, codes binary, word_count int, words binary"


def known(chunks: DataFrame, words_seen: DataFrame, parts: int) -> DataFrame:
    """Chunks with the number and the four counts of each of their words, by code, in place of the words."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        words = left.column("words")[0].values
        found, block = np.zeros((5, len(words)), np.int64), dict(zip(right.column("part").to_pylist(), right.column("answer"), strict=True))
        for part, some in _word_parts(words, parts):
            found[:, some] = unpacked(block[part].as_py(), len(some), 5)
        return left.drop_columns("words").append_column("word_count", pa.array([len(words)], pa.int32())).append_column("words", pa.array([packed(*found)], pa.binary()))

    return chunks.groupBy("chunk").cogroup(words_seen.select("of", "part", "answer").groupBy("of")).applyInArrow(run, KNOWN)


class _Chunk:
    """A chunk's tokens as different bigrams: words by code, which of them each token is, and the part that counts each."""

    def __init__(self, row: dict, parts: int):
        lengths = np.array(row["lengths"])
        before, code, self.piece = _tokens(unpacked(row["codes"], int(lengths.sum()))[0], lengths)
        self.count = row["word_count"]
        self.id, self.word_n, self.word_d, self.prev_n, self.prev_d = unpacked(row["words"], self.count, 5)
        coded = pa.array(before * self.count + code).dictionary_encode()
        self.which, self.different = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        self.prev, self.word = self.different // self.count, self.different % self.count
        of = np.array(row["folds"])[self.piece]
        self.n, self.d = (np.bincount(self.which[m], minlength=len(self.different)) for m in (of != HELD, of == DELETED))
        self.among = parts

    def blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each part and its bigrams, those of one predecessor together."""
        # both numbers, mixed so that neither decides alone
        mixed = self.id[self.prev].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + self.id[self.word].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return _dealt(((mixed >> np.uint64(32)) % np.uint64(self.among)).astype(np.int64), np.argsort(self.different))


def asked(chunks: DataFrame, parts: int) -> DataFrame:
    """(chunk, part, size, block): the different bigrams of a chunk that a part counts: numbers of both words, training occurrences, those of the deleted fold."""
    schema = pa.schema([("chunk", pa.string()), ("part", pa.int64()), ("size", pa.int32()), ("block", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                chunk = _Chunk(row, parts)
                made = [(row["chunk"], part, len(of), packed(np.diff(chunk.id[chunk.prev[of]], prepend=0), chunk.id[chunk.word[of]], chunk.n[of], chunk.d[of])) for part, of in chunk.blocks()]
                for low in range(0, len(made), 512):
                    columns = zip(*made[low : low + 512], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return chunks.select("chunk", "folds", "lengths", "codes", "word_count", "words").mapInArrow(run, "chunk string, part long, size int, block binary")


def _counted(part: pa.Table) -> pa.Table:
    """Each block of a part with the counts of its bigrams in all chunks."""
    sizes = part.column("size").to_pylist()
    blocks = [unpacked(b.as_py(), size, 4) for b, size in zip(part.column("block"), sizes, strict=True)]
    prev, word, n, d = (np.concatenate(c) for c in zip(*((np.cumsum(p), w, n, d) for p, w, n, d in blocks), strict=True))
    # numbers of words may take more than 32 bits each: their places among those of the part don't
    place, before = (pa.array(c).dictionary_encode() for c in (word, prev))
    coded = pa.array(before.indices.to_numpy().astype(np.int64) * len(place.dictionary) + place.indices.to_numpy()).dictionary_encode()
    which = coded.indices.to_numpy()
    sums = [t[which] for t in _totals(which, (n, d), len(coded.dictionary))]
    cuts = np.cumsum(sizes)[:-1]
    answers = [packed(a, b) for a, b in zip(*(np.split(t, cuts) for t in sums), strict=True)]
    return pa.table({"of": part.column("chunk"), "part": part.column("part"), "answer": pa.array(answers, pa.binary())})


ANSWERED = KNOWN + ", size int, counts binary"


def answered(chunks: DataFrame, parts: int) -> DataFrame:
    """Chunks with the counts (all, deleted) of their different bigrams in the whole training."""
    answers = asked(chunks, parts).groupBy("part").applyInArrow(_counted, "of string, part long, answer binary")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {name: left.column(name)[0].as_py() for name in left.schema.names}
        chunk, block = _Chunk(row, parts), dict(zip(right.column("part").to_pylist(), right.column("answer"), strict=True))
        n, d = np.zeros(len(chunk.prev), np.int64), np.zeros(len(chunk.prev), np.int64)
        for part, of in chunk.blocks():
            n[of], d[of] = unpacked(block[part].as_py(), len(of), 2)
        return left.append_column("size", pa.array([len(n)], pa.int32())).append_column("counts", pa.array([packed(n, d)], pa.binary()))

    return chunks.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(run, ANSWERED)


def bucket(seen: np.ndarray) -> np.ndarray:
    """0 for a predecessor never seen, else 1 + the whole logarithm to base 2 of how often it was; exact below 2**53."""
    return np.frexp(np.maximum(seen, 0).astype(float))[1]


def held_out(chunks: DataFrame, parts: int, tokens: int, deleted: int) -> DataFrame:
    """(bucket, f2, f1, d): what the counts without the deleted fold say of its bigrams, a row for each different one of a chunk, d times."""
    schema = pa.schema([("bucket", pa.int32()), ("f2", pa.float64()), ("f1", pa.float64()), ("d", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                chunk = _Chunk(row, parts)
                n, d = unpacked(row["counts"], row["size"], 2)
                here = np.flatnonzero(chunk.d)
                left, top = (chunk.prev_n - chunk.prev_d)[chunk.prev[here]], (chunk.word_n - chunk.word_d)[chunk.word[here]]
                f2 = np.where(left > 0, (n - d)[here] / np.maximum(left, 1), 0.0)
                f1 = top / (tokens - deleted) if tokens > deleted else np.zeros(len(here))
                made = [bucket(left), f2, f1, chunk.d[here]]
                for low in range(0, len(here), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[low : low + 50_000], f.type) for c, f in zip(made, schema, strict=True)], schema=schema)

    return written(chunks.select("chunk", "folds", "lengths", "codes", "word_count", "words", "size", "counts").mapInArrow(run, "bucket int, f2 double, f1 double, d long"), "held-out")


def learned(events: DataFrame, words: int, rounds: int = ROUNDS) -> dict[int, tuple[float, float, float]]:
    """Bucket -> weights (bigram, word, uniform), summing to 1; for buckets without held-out events those of all buckets together.

    events: of ``held_out``; words: different training words.
    """
    uniform = 1 / (words + 1)
    weights = {b: (0.0, 0.5, 0.5) if b == 0 else (1 / 3,) * 3 for b in range(65)}
    for _ in range(rounds):
        array = lambda i: "array(" + ", ".join(f"{weights[b][i]!r}D" for b in sorted(weights)) + ")[bucket]"  # noqa: B023, E731
        parts = [f"{array(0)} * f2", f"{array(1)} * f1", f"{array(2)} * {uniform!r}D"]
        share = events.selectExpr("bucket", "d", *(f"{p} AS p{i}" for i, p in enumerate(parts)))
        sums = share.groupBy("bucket").agg(*(F.sum(F.expr(f"d * p{i} / (p0 + p1 + p2)")).alias(f"s{i}") for i in range(3)))
        found = {r.bucket: [r.s0, r.s1, r.s2] for r in sums.collect()}  # at most 64
        moved = 0.0
        for b, s in found.items():
            s = [0.0 if b == 0 else s[0] + PRIOR, s[1] + PRIOR, s[2] + PRIOR]
            new = tuple(v / sum(s) for v in s)
            moved = max(moved, *(abs(x - y) for x, y in zip(new, weights[b], strict=True)))
            weights[b] = new
            found[b] = s
        if moved < ENOUGH:
            break
    sums = [sum(c) for c in zip(*(s for b, s in found.items() if b), strict=True)] or [1.0, 1.0, 1.0]
    pooled = tuple(v / sum(sums) for v in sums)
    zero = weights[0] if 0 in found else (0.0, pooled[1] / (pooled[1] + pooled[2]), pooled[2] / (pooled[1] + pooled[2]))
    return {b: zero if b == 0 else weights[b] if b in found else pooled for b in range(65)}


def _sums(row: dict, parts: int, weights: np.ndarray, tokens: int, words: int) -> list[np.ndarray]:
    """Per piece of a chunk: its tokens, known tokens and both scores. weights: a row a bucket."""
    chunk = _Chunk(row, parts)
    pair_n, _ = unpacked(row["counts"], row["size"], 2)
    word_n, prev_n = chunk.word_n[chunk.word], chunk.prev_n[chunk.prev]
    w = weights[bucket(prev_n)]
    made = w[:, 0] * pair_n / np.maximum(prev_n, 1) + w[:, 1] * word_n / max(tokens, 1) + w[:, 2] / (words + 1)
    values = ((word_n > 0).astype(float), np.log10((word_n + ADDED) / (tokens + ADDED * (words + 1))), np.log10(made) if tokens else np.zeros(len(made)))
    count = len(row["lengths"])
    n_known, base, scores = (np.bincount(chunk.piece, v[chunk.which], count) for v in values)
    return [row["rows"], row["ids"], row["folds"], np.array(row["lengths"]) - 1, n_known.astype(np.int64), base, scores]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, rounds: int = ROUNDS, part: int = PART) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row; scores are sums of log10."""
    coded_chunks = written(coded(docs, id_col, text_col, chunk), "chunks")
    names, word_parts = seen(coded_chunks, part)
    tokens, deleted, words = totals(names)
    parts = max(1, -(-tokens // part))
    light = written(known(coded_chunks, names, word_parts), "known")
    discard(coded_chunks)
    discard(names)
    chunks = written(answered(light, parts), "answered")
    discard(light)
    events = held_out(chunks, parts, tokens, deleted)
    learnt = learned(events, words, rounds)
    discard(events)
    weights = np.array([learnt[b] for b in sorted(learnt)])
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("fold", pa.int32()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                columns = _sums(row, parts, weights, tokens, words)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    sums = chunks.mapInArrow(run, "row long, doc_id long, fold int, n_tokens long, n_known long, base_score double, score double")
    # pieces of a long text together
    whole = sums.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("fold").alias("fold"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
    return whole.select("doc_id", (F.col("fold") == HELD).alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op11_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
