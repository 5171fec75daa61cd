"""Token ids in blocks of a static range asymmetric numeral system (rANS), with shared frequency tables.

A stored set is three tables in one folder: ``meta`` (type of the documents' ids, scale bits, number of ids), ``table`` (the
scaled frequency of every id that occurs, one for all blocks) and ``blocks`` (part, block, first, tokens, payload):
documents in ascending order, part by part, block by block. The ids before coding lie in ``raw`` until the blocks are written.

A payload is a header, the documents' ids and lengths, checkpoints, and the coded words, all little-endian:

    magic "RNS2", scale bits, lanes, rows between checkpoints, 1 if document ids are text, tokens, documents, rows, checkpoints, words, bytes of the ids
    documents: id (int64; or its length in bytes, and all ids in UTF-8 behind that), has an id (uint8), tokens (int64)
    checkpoints: for every RUN-th row the lanes' states (uint64), where reading goes on (uint32), CRC-32 of the ids that follow up to the next
    coded words (uint32)

Ids are dealt to the lanes in turn; all lanes step together, so coding is array arithmetic. A block stands for itself,
and decoding may begin at any of its checkpoints; each run between two is checked by its CRC.
"""

from __future__ import annotations

import gc
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import Cache, Pretokens, tokenizer_path
from .chunks import distinct_runs, pieces, sized
from .common import binary_column, checkpoint_folder, documents, removed, slices

#: Bits of the frequencies' sum; more where very many ids occur.
SCALE = 18
LANES = 2048
RUN = 256
#: A block is closed at the end of the document that brings it to this many tokens; a document is never split.
BLOCK_TOKENS = 1 << 20
END_ID = 2
#: Pre-tokens in each of two generations of a worker's cache: about 150 MB when full.
WORDS = 400_000
LOW = 1 << 32
_HEAD = struct.Struct("<4sIIIIqqqqqq")
#: Characters of a text that tell rows of one id apart when documents are dealt out.
TIE_CHARS = 64


def id_kind(size: int) -> str:
    """The unsigned type of ids below ``size``."""
    return "<u2" if size <= 1 << 16 else "<u4"


def scale_of(distinct: int) -> int:
    """Scale bits with room for ``distinct`` ids: at least twice as many slots."""
    return max(SCALE, int(distinct).bit_length() + 1)


def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies that sum to 2^scale, at least 1 where the count is not 0; the largest takes what rounding leaves."""
    total, size = int(counts.sum()), 1 << scale
    if not total:
        return np.zeros(len(counts), np.int64)
    if np.count_nonzero(counts) > size // 2:
        raise ValueError(f"{np.count_nonzero(counts)} ids need a scale above {scale}: see scale_of")
    freqs = np.where(counts > 0, np.maximum(1, counts * (size / total)), 0).astype(np.int64)
    while (over := int(freqs.sum()) - size) != 0:
        if over < 0:
            freqs[freqs.argmax()] -= over
        else:  # shave the largest, never under half
            order = np.argsort(-freqs, kind="stable")
            for at in order:
                take = min(over, int(freqs[at]) // 2)
                freqs[at] -= take
                over -= take
                if not over or not take:
                    break
    return freqs


class Table:
    def __init__(self, freqs: np.ndarray, scale: int = SCALE):
        self.scale = scale
        self.freqs = freqs.astype(np.uint64)
        self.starts = np.concatenate([[0], np.cumsum(freqs)[:-1]]).astype(np.uint64)
        self.symbols = np.repeat(np.arange(len(freqs), dtype=np.uint32), freqs)


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, run: int = RUN) -> tuple[list[tuple[np.ndarray, int, int]], np.ndarray]:
    """(checkpoints: states, words already read, CRC-32 of their run; the words). Encoding goes backwards from the last row."""
    n, scale = len(ids), np.uint64(table.scale)
    rows = -(-n // lanes)
    freqs, starts = table.freqs[ids], table.starts[ids]
    shift, limit, half, low32 = scale, np.uint64(64) - scale, np.uint64(32), np.uint64(0xFFFFFFFF)
    states = np.full(lanes, LOW, np.uint64)
    words, written, checkpoints = [], 0, []
    for row in range(rows - 1, -1, -1):
        f, c = freqs[row * lanes : (row + 1) * lanes], starts[row * lanes : (row + 1) * lanes]
        x = states[: len(f)]
        full = x >= f << limit
        if full.any():
            words.append((x[full] & low32).astype("<u4"))
            written += len(words[-1])
            x = np.where(full, x >> half, x)
        quotient = x // f
        states[: len(f)] = (quotient << shift) + (x - quotient * f) + c
        if row % run == 0:
            checkpoints.append((states.copy(), written, zlib.crc32(ids[row * lanes : (row + run) * lanes].astype("<u4").tobytes())))
    checkpoints = [(s, written - w, crc) for s, w, crc in reversed(checkpoints)]
    return checkpoints, np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")


def decode_run(table: Table, states: np.ndarray, words: np.ndarray, at: int, tokens: int) -> np.ndarray:
    """``tokens`` ids from a checkpoint on, whose words begin at ``at``."""
    lanes, scale, half = len(states), np.uint64(table.scale), np.uint64(32)
    mask, low = np.uint64((1 << table.scale) - 1), np.uint64(LOW)
    out, states = np.empty(tokens, np.uint32), states.copy()
    for begin in range(0, tokens, lanes):
        width = min(lanes, tokens - begin)
        x = states[:width]
        slot = x & mask
        ids = table.symbols[slot]
        out[begin : begin + width] = ids
        x = table.freqs[ids] * (x >> scale) + slot - table.starts[ids]
        short = x < low
        count = int(np.count_nonzero(short))
        if count:
            x[short] = (x[short] << half) | words[at : at + count]
            at += count
        states[:width] = x
    return out


def pack(doc_ids: list, lengths: list[int], ids: np.ndarray, table: Table, lanes: int = LANES, run: int = RUN) -> bytes:
    """A block of documents whose ids are all integers or all text, or None."""
    checkpoints, words = encode(ids, table, lanes, run) if len(ids) else ([], np.zeros(0, "<u4"))
    text = any(isinstance(x, str) for x in doc_ids)
    names = [(x or "").encode() for x in doc_ids] if text else []
    head = _HEAD.pack(b"RNS2", table.scale, lanes, run, text, len(ids), len(doc_ids), -(-len(ids) // lanes), len(checkpoints), len(words), sum(map(len, names)))
    parts = [
        head,
        np.array([len(x) for x in names] if text else [x or 0 for x in doc_ids], "<i8").tobytes(),
        *names,
        np.array([x is not None for x in doc_ids], "<u1").tobytes(),
        np.array(lengths, "<i8").tobytes(),
        *(s.astype("<u8").tobytes() + struct.pack("<II", at, crc) for s, at, crc in checkpoints),
        words.astype("<u4").tobytes(),
    ]
    return b"".join(parts)


def unpack(payload: bytes, table: Table) -> tuple[list, np.ndarray, np.ndarray]:
    """(document ids, lengths, all token ids); raises ValueError where a checksum or length is wrong."""
    magic, scale, lanes, run, text, tokens, docs, _, count, size, named = _HEAD.unpack_from(payload)
    if magic != b"RNS2" or scale != table.scale:
        raise ValueError("not a block of this table")
    at = _HEAD.size
    keys = np.frombuffer(payload, "<i8", docs, at).tolist()
    at += 8 * docs
    if text:
        ends = np.cumsum(keys).tolist() if docs else []
        keys = [payload[at + e - n : at + e].decode() for e, n in zip(ends, keys, strict=True)]
    has = np.frombuffer(payload, "<u1", docs, at := at + named)
    lengths = np.frombuffer(payload, "<i8", docs, at := at + docs)
    at += 8 * docs
    step = 8 * lanes + 8
    words = np.frombuffer(payload, "<u4", size, at + step * count).astype(np.uint64)
    runs = []
    for k in range(count):
        states = np.frombuffer(payload, "<u8", lanes, at + step * k).astype(np.uint64)
        begin, crc = struct.unpack_from("<II", payload, at + step * k + 8 * lanes)
        part = decode_run(table, states, words, begin, min(run * lanes, tokens - k * run * lanes))
        if zlib.crc32(part.astype("<u4").tobytes()) != crc:
            raise ValueError(f"checksum of run {k} is wrong")
        runs.append(part)
    ids = np.concatenate(runs) if runs else np.zeros(0, np.uint32)
    if int(lengths.sum()) != len(ids):
        raise ValueError("lengths don't match the block")
    return [k if h else None for k, h in zip(keys, has.tolist(), strict=True)], lengths, ids


class _Tokens:
    """Texts to ids by the tokenizers library's model.

    A batch is cut into runs without ASCII white space, of which each distinct one is looked at once. Pre-tokens are
    remembered in a cache of bounded size, so the model only sees those that are new to the worker, many at a time.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.pretokens = Pretokens(path)
        model = self.pretokens.spec["model"]
        size = max([*model["vocab"].values(), *self.pretokens.specials.values()], default=0) + 1
        self.kind = np.dtype(id_kind(size))
        self.single = Tokenizer(self.pretokens.tokenizer.model)
        self.joined = Tokenizer(self.pretokens.tokenizer.model)
        self.joined.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = model.get("end_of_word_suffix")
        #: ids that end a word; without a suffix words can't be told apart in a joined text
        self.ends = None
        if suffix:
            self.ends = np.zeros(size, bool)
            self.ends[[i for t, i in model["vocab"].items() if t.endswith(suffix)]] = True
        self.pretokens.spec = None
        # Fixed value: the tokenizer's word pattern, for lower-case text of the first 256 characters.
        self.latin_words = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\sa-zªµºß-öø-ÿ0-9²³¹¼½¾]+").findall
        self.spell = {b: s for b, s in self.pretokens.spelling.items() if b != 32}
        self.bytes = {ord(s): b for b, s in self.pretokens.spelling.items()}
        self.words = Cache(WORDS)

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts, how many each text has)."""
        parts: tuple[list, list] = ([], [])
        owners: tuple[list, list] = ([], [])
        for at, text in enumerate(texts):
            for piece in pieces(text or b""):
                latin = self.pretokens.latin(piece)
                # lower case as normalisation makes it; so more runs are equal
                parts[latin].append(piece.decode().lower().encode() if latin else piece)
                owners[latin].append(at)
        done = [self._group(group, bool(latin)) for latin, group in enumerate(parts)]
        counts = np.zeros(len(texts), np.int64)
        for (_, each), own in zip(done, owners, strict=True):
            np.add.at(counts, own, each)
        if not parts[0] or not parts[1]:
            return done[bool(parts[1])][0], counts
        # two groups: each piece goes where its text lies
        order = np.argsort(np.concatenate([np.array(o, np.int64) for o in owners]), kind="stable")
        each = np.concatenate([e for _, e in done])
        ends = np.cumsum(each)
        pool = np.concatenate([i for i, _ in done])
        return np.concatenate([pool[ends[i] - each[i] : ends[i]] for i in order.tolist()]), counts

    def _group(self, parts: list[bytes], latin: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each part) of parts that are all lower-case text of the first 256 characters, or all as they came."""
        names, runs, sizes = distinct_runs(parts)
        # no cycles are made here, and looking for them among all that is cached takes a fifth of the time
        gc.disable()
        try:
            values = self._values(names, latin)
        finally:
            gc.enable()
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // self.kind.itemsize
        starts, pool = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(values), self.kind)
        each = lengths[runs]
        ends = np.cumsum(each)
        ids = pool[np.arange(int(each.sum())) + np.repeat(starts[runs] - ends + each, each)]
        return ids, np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])])

    def _values(self, names: list[bytes], latin: bool) -> list[bytes]:
        """The ids of each run, as bytes."""
        # most runs are a pre-token by themselves
        values = list(map(self.words.new.get, names))
        known: dict[bytes | int, bytes | None] = {}
        cut: list[tuple[int, list]] = []
        for at, value in enumerate(values):
            if value is None:
                name = names[at]
                if latin and (name.isalpha() or name.decode().isalpha()):
                    parts = [name]
                elif latin:
                    parts = [w.encode() for w in self.latin_words(name.decode())]
                else:
                    parts = [w if isinstance(w, int) else w.translate(self.bytes).encode("latin-1") for w in self.pretokens.split(name)]
                cut.append((at, parts))
                for part in parts:
                    if part not in known:
                        known[part] = self.words.get(part) if isinstance(part, bytes) else np.array([part], self.kind).tobytes()
        new = [w for w, v in known.items() if v is None]
        if new:
            self._learn(new, known)
        for at, parts in cut:
            values[at] = known[parts[0]] if len(parts) == 1 else b"".join([known[p] for p in parts])
        return values

    def _learn(self, new: list[bytes], known: dict[bytes | int, bytes | None]) -> None:
        texts = [b" ".join(new[at : at + 1024]).decode("latin-1").translate(self.spell) for at in range(0, len(new), 1024)]
        ids = ends = None
        if self.ends is not None:
            ids = np.concatenate([np.array(e.ids, self.kind) for e in self.joined.encode_batch_fast(texts, add_special_tokens=False)])
            ends = np.flatnonzero(self.ends[ids]) + 1
        if ends is None or len(ends) != len(new):
            each = [np.array(e.ids, self.kind) for t in texts for e in self.single.encode_batch_fast(t.split(" "), add_special_tokens=False)]
            ids, ends = np.concatenate(each), np.cumsum([len(x) for x in each])
        data, at, put = ids.tobytes(), 0, self.words.put
        for word, end in zip(new, (ends * self.kind.itemsize).tolist(), strict=True):
            known[word] = data[at:end]
            put(word, known[word])
            at = end


_workers: dict[str, _Tokens] = {}


def _size(path: str, end_id: int) -> int:
    """One more than the greatest id of a tokenizer file, or ``end_id``."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]), end_id]) + 1


def _tokens(path: str) -> _Tokens:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _workers:
        _workers[path] = _Tokens(path)
    return _workers[path]


RAW = "part int, block int, first long, tokens long, keys array<{id}>, lengths array<long>, ids binary, token array<int>, n array<long>"


def raw_blocks(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Blocks of ids as they are, documents in ascending order; and, in rows without ids, how often the part has each token."""
    whole = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    ordered = docs.select(F.col(id_col).cast("long" if whole else "string").alias("id"), F.col(text_col).alias("body"))
    # rows of one id are dealt by their text's beginning, so that an id with very many rows is spread too
    ordered = ordered.repartitionByRange("id", F.substring("body", 1, TIE_CHARS)).sortWithinPartitions("id", "body")
    name = ordered.schema["id"].dataType.simpleString()
    key = pa.int64() if whole else pa.string()
    schema = RAW.format(id="long" if whole else name)
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(key), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = _tokens(path), TaskContext.get().partitionId()
        keys, lengths, held, size, first, block = [], [], [], 0, 0, 0
        counts = np.zeros(end_id + 1, np.int64)
        row = lambda *values: pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

        def closed() -> pa.RecordBatch:
            nonlocal counts
            ids = np.concatenate(held)
            more = np.bincount(ids, minlength=len(counts))
            more[: len(counts)] += counts
            counts = more
            return row(part, block, first, size, keys, lengths, ids.tobytes(), None, None)

        for batch in sized(batches, 1):
            ids, each = tokens.encode(binary_column(batch, "body").to_pylist())
            ids, each = np.insert(ids, np.cumsum(each), end_id), each + 1
            names_now, ends, doc, at = batch.column(0).to_pylist(), np.cumsum(each), 0, 0
            while doc < len(names_now):
                # up to the document that fills the block, or the last one
                stop = min(len(names_now), int(np.searchsorted(ends, at + BLOCK_TOKENS - size)) + 1)
                end = int(ends[stop - 1])
                keys += names_now[doc:stop]
                lengths += each[doc:stop].tolist()
                held.append(ids[at:end])
                size, doc, at = size + end - at, stop, end
                if size >= BLOCK_TOKENS:
                    yield closed()
                    first, block = first + size, block + 1
                    keys, lengths, held, size = [], [], [], 0
        if keys:
            yield closed()
        seen = np.flatnonzero(counts)
        yield row(part, -1, 0, 0, None, None, None, seen.tolist(), counts[seen].tolist())

    return ordered.mapInArrow(run, schema)


def _shared(spark: SparkSession, folder: str):
    """(scale, frequencies) of a stored set as a broadcast: 4 bytes for each id of the vocabulary, whatever the corpus."""
    meta = spark.read.parquet(f"{folder}/meta").first()
    freqs = np.zeros(meta["size"], np.uint32)
    for r in spark.read.parquet(f"{folder}/table").collect():
        freqs[r["token"]] = r["freq"]
    return spark.sparkContext.broadcast((meta["scale"], freqs)), meta["keys"]


_tables: dict[tuple, Table] = {}


def _table(shared: tuple[int, np.ndarray]) -> Table:
    scale, freqs = shared
    key = (scale, freqs.tobytes())
    if key not in _tables:
        _tables.clear()
        _tables[key] = Table(freqs, scale)
    return _tables[key]


def write_tokens(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> str:
    """Writes the stored set of all documents, in ascending order of id (nulls first, ties by text), into a new ``folder``.

    Each document's ids are followed by ``end_id``; null and blank text have it alone. Documents are dealt to the parts
    by ranges of the id, so parts, blocks and documents follow each other in order. Ids may be of any type; those that
    aren't integers are kept, and ordered, as text. Repeated rows are documents of their own. An empty table gives a set
    without blocks. Other columns are not read.
    """
    spark = docs.sparkSession
    ids = raw_blocks(docs, path, id_col, text_col, end_id)
    ids.write.option("compression", "zstd").parquet(f"{folder}/raw")
    raw = spark.read.schema(ids.schema).parquet(f"{folder}/raw")
    counts = raw.filter("block < 0").select(F.inline(F.arrays_zip("token", "n"))).groupBy("token").agg(F.sum("n").alias("n"))
    seen = {r["token"]: r["n"] for r in counts.collect()}  # at most the ids there are
    dense = np.zeros(max(seen, default=0) + 1, np.int64)
    dense[list(seen)] = list(seen.values())
    scale = scale_of(len(seen))
    freqs = scaled(dense, scale)
    rows = [(int(t), int(freqs[t])) for t in np.flatnonzero(freqs)]
    keys = ids.schema["keys"].dataType.elementType.simpleString()
    spark.createDataFrame([(keys, scale, len(dense))], "keys string, scale int, size int").coalesce(1).write.parquet(f"{folder}/meta")
    spark.createDataFrame(rows, "token int, freq int").coalesce(1).write.parquet(f"{folder}/table")
    shared, _ = _shared(spark, folder)
    kind = id_kind(_size(path, end_id))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(shared.value)
        for batch in slices(batches, 1):
            keys, lengths, ids = (batch.column(i)[0].as_py() for i in (4, 5, 6))
            payload = pack(keys, lengths, np.frombuffer(ids, kind), table)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([payload], pa.binary())], names=["part", "block", "first", "tokens", "payload"])

    blocks = raw.filter("block >= 0").select("part", "block", "first", "tokens", "keys", "lengths", "ids")
    blocks.mapInArrow(run, "part int, block int, first long, tokens long, payload binary").write.parquet(f"{folder}/blocks")
    removed(spark, f"{folder}/raw")
    return folder


def read_tokens(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids): from the files alone; start counts the ids of all documents before. digest: ids_crc32 instead of ids."""
    shared, keys = _shared(spark, folder)
    blocks = spark.read.schema("part int, block int, first long, tokens long, payload binary").parquet(f"{folder}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(shared.value)
        for batch in slices(batches, 1):
            docs, lengths, ids = unpack(batch.column(2)[0].as_py(), table)
            ends = np.cumsum(lengths)
            begins = ends - lengths
            raw = [ids[b:e].astype("<u4") for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
            last = pa.array([zlib.crc32(x) for x in raw], pa.int64()) if digest else pa.array([x.tolist() for x in raw], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(docs), batch.column(0)[0].as_py(), np.int32)),
                    pa.array(docs, pa.int64() if keys == "bigint" else pa.string()),
                    pa.array(begins + batch.column(1)[0].as_py()),
                    pa.array(lengths.astype(np.int64)),
                    last,
                ],
                names=["part", "doc_id", "inside", "n_tokens", "last"],
            )

    kind = "long" if digest else "array<int>"
    found = blocks.select("part", "first", "payload").mapInArrow(run, f"part int, doc_id {keys}, inside long, n_tokens long, last {kind}")
    # one row a part: their running sum is over as many rows as the set has files
    parts = blocks.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("before"))
    return found.join(F.broadcast(parts), "part").select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", F.col("last").alias("ids_crc32" if digest else "ids"))


def op6_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_folder(spark)}/rans-{uuid.uuid4().hex}"
    return read_tokens(spark, write_tokens(documents(spark, sf_dir), tokenizer_path(), folder), digest=True)
