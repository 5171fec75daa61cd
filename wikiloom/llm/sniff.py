"""Media columns: what a stored file really is, found by signature, and media carved out of other bytes.

One Aho-Corasick automaton locates the magic bytes of all formats in one pass. A hit counts only if the format's
validator can walk the structure from there (chunk lengths, checksums, markers, end) inside the bytes at hand; it gives
the exact length. A file's type is that of the valid hit at its start, whatever was declared; valid hits further on are embedded
media; those inside of another medium are nested and name its offset as their parent.
"""

from __future__ import annotations

import binascii
import hashlib
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_column, documents, slices

UNKNOWN = "application/octet-stream"
ALIGN = 64
#: Compressed streams are walked in pieces of this size and never held whole.
INFLATE_PIECE = 1 << 16


def _png(data: bytes, at: int) -> int:
    """Chunks with right CRCs from IHDR to IEND."""
    pos, first = at + 8, True
    while pos + 12 <= len(data):
        (size,) = struct.unpack_from(">I", data, pos)
        kind = data[pos + 4 : pos + 8]
        end = pos + 12 + size
        if end > len(data) or (first and (kind != b"IHDR" or size != 13)):
            return 0
        if binascii.crc32(data[pos + 4 : end - 4]) != struct.unpack_from(">I", data, end - 4)[0]:
            return 0
        if kind == b"IEND":
            return end - at
        pos, first = end, False
    return 0


def _gif(data: bytes, at: int) -> int:
    """Screen descriptor, then extension and image blocks up to the trailer."""
    if at + 13 > len(data):
        return 0
    flags = data[at + 10]
    pos = at + 13 + (3 << ((flags & 7) + 1) if flags & 0x80 else 0)
    images = 0
    while pos < len(data):
        mark = data[pos]
        if mark == 0x3B:
            return pos + 1 - at if images else 0
        if mark == 0x21:
            pos += 2
        elif mark == 0x2C and pos + 11 <= len(data):
            local = data[pos + 9]
            pos += 11 + (3 << ((local & 7) + 1) if local & 0x80 else 0)
            images += 1
        else:
            return 0
        while pos < len(data) and data[pos]:
            pos += data[pos] + 1
        pos += 1
    return 0


def _jpeg(data: bytes, at: int) -> int:
    """Marker segments with a frame and a scan, up to the end marker."""
    pos, frame = at + 2, False
    while pos + 4 <= len(data) and data[pos] == 0xFF:
        mark = data[pos + 1]
        if mark == 0xD9:
            return pos + 2 - at if frame else 0
        (size,) = struct.unpack_from(">H", data, pos + 2)
        if size < 2:
            return 0
        frame |= 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC)
        pos += 2 + size
        if mark == 0xDA:  # coded data runs to a marker that is neither stuffing nor a restart
            while True:
                pos = data.find(b"\xff", pos)
                if pos < 0 or pos + 1 >= len(data):
                    return 0
                if data[pos + 1] == 0xD9:
                    return pos + 2 - at if frame else 0
                if data[pos + 1] and not 0xD0 <= data[pos + 1] <= 0xD7 and data[pos + 1] != 0xFF:
                    break
                pos += 1 if data[pos + 1] == 0xFF else 2
    return 0


def _riff(form: bytes, needed: bytes) -> Callable[[bytes, int], int]:
    def valid(data: bytes, at: int) -> int:
        """A form whose chunks fill its length and hold the needed one."""
        if data[at + 8 : at + 12] != form:
            return 0
        end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
        pos, found = at + 12, False
        while pos + 8 <= end <= len(data):
            kind, size = data[pos : pos + 4], struct.unpack_from("<I", data, pos + 4)[0]
            found |= kind.startswith(needed)
            pos += 8 + size + (size & 1)
        return end - at if found and end <= len(data) and pos in (end, end + 1) else 0

    return valid


def _au(data: bytes, at: int) -> int:
    if at + 24 > len(data):
        return 0
    offset, size, encoding, rate, channels = struct.unpack_from(">5I", data, at + 4)
    end = offset + size
    return end if offset >= 24 and 1 <= encoding <= 27 and 0 < rate < 1 << 20 and 0 < channels < 256 and at + end <= len(data) and size != 0xFFFFFFFF else 0


def _bmp(data: bytes, at: int) -> int:
    if at + 30 > len(data):
        return 0
    size, spare, offset, header = struct.unpack_from("<4I", data, at + 2)
    planes, depth = struct.unpack_from("<2H", data, at + 26)
    good = not spare and header in (40, 52, 56, 64, 108, 124) and planes == 1 and depth in (1, 4, 8, 16, 24, 32) and 14 + header <= offset <= size
    return size if good and at + size <= len(data) else 0


def _gzip(data: bytes, at: int) -> int:
    """Inflates to the end of the member: its checksum and length are the decoder's to check."""
    inflate, pos = zlib.decompressobj(31), at
    try:
        while pos < len(data) and not inflate.eof:
            piece = data[pos : pos + INFLATE_PIECE]
            pos += len(piece)
            left = piece
            while left and not inflate.eof:
                inflate.decompress(left, 1 << 20)
                left = inflate.unconsumed_tail
    except zlib.error:
        return 0
    return pos - len(inflate.unused_data) - at if inflate.eof else 0


_XREF_START = re.compile(rb"startxref\s+([0-9]{1,18})\s+%%EOF")
_XREF = re.compile(rb"(?<![0-9])(?=\s{0,4}(?:xref\s|[0-9]{1,10}\s+[0-9]{1,5}\s+obj))")


class _Marks:
    """The end marks of a text's PDF and ZIP files, found once for all headers in it."""

    def __init__(self, data: bytes):
        self.data = data
        self._pdf = self._zip = None

    def pdf(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each end mark the place it names, its begin and end; and for each byte whether cross-references begin there."""
        if self._pdf is None:
            found = [(int(m[1]), m.start(), m.end()) for m in _XREF_START.finditer(self.data)]
            tables = np.zeros(len(self.data) + 1, bool)
            if found:
                tables[[m.start() for m in _XREF.finditer(self.data)]] = True
            self._pdf = *(np.array([f[i] for f in found], np.int64) for i in range(3)), tables
        return self._pdf

    def zip(self) -> dict[int, list[int]]:
        """For a place the ends of the files whose end record says that they begin there, in order."""
        if self._zip is None:
            self._zip, at = {}, -1
            while (at := self.data.find(b"PK\x05\x06", at + 1)) >= 0 and at + 22 <= len(self.data):
                size, offset, comment = struct.unpack_from("<IIH", self.data, at + 12)
                begin = at - offset - size
                if begin >= 0 and self.data[at - size : at - size + 4] == b"PK\x01\x02" and at + 22 + comment <= len(self.data):
                    self._zip.setdefault(begin, []).append(at + 22 + comment)
        return self._zip


_marks: list[_Marks] = []


def _marks_of(data: bytes) -> _Marks:
    """Those of the text that is looked at now."""
    if not _marks or _marks[0].data is not data:
        _marks[:] = [_Marks(data)]
    return _marks[0]


def _pdf(data: bytes, at: int) -> int:
    """A version, and the last end mark of the update chain.

    An update's cross-references lie behind the end before it; only the first section of a linearised file has 0 as their
    place, and the end of the file then has one further up. What other files inside or behind count from their own start
    doesn't fit. If no place fits, the first end mark behind a cross-reference start counts.
    """
    if not (data[at + 5 : at + 6].isdigit() and data[at + 6 : at + 7] == b"."):
        return 0
    places, begins, ends, tables = _marks_of(data).pdf()
    end = 0
    if len(places):
        place = at + places
        fits = (place > at) & (place < begins)
        for i in np.flatnonzero(fits & tables[np.where(fits, place, 0)]).tolist():
            if place[i] >= end:
                end = int(ends[i])
    if end:
        return end - at
    start = data.find(b"startxref", at)
    end = data.find(b"%%EOF", start) if start >= 0 else -1
    return end + 5 - at if end >= 0 else 0


def _zip(data: bytes, at: int) -> int:
    """The first end record that says that its file begins at this local header."""
    ends = _marks_of(data).zip().get(at)
    return ends[0] - at if ends else 0


#: type, magic bytes, validator. The magic bytes of the formats' specifications.
FORMATS: list[tuple[str, bytes, Callable[[bytes, int], int]]] = [
    ("image/png", b"\x89PNG\r\n\x1a\n", _png),
    ("image/gif", b"GIF87a", _gif),
    ("image/gif", b"GIF89a", _gif),
    ("image/jpeg", b"\xff\xd8\xff", _jpeg),
    ("audio/wav", b"RIFF", _riff(b"WAVE", b"data")),
    ("image/webp", b"RIFF", _riff(b"WEBP", b"VP8")),
    ("audio/basic", b".snd", _au),
    ("image/bmp", b"BM", _bmp),
    ("application/gzip", b"\x1f\x8b\x08", _gzip),
    ("application/pdf", b"%PDF-", _pdf),
    ("application/zip", b"PK\x03\x04", _zip),
]


@cache
def _automaton():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for magic in {m for _, m, _ in FORMATS}:
        automaton.add_word(magic.decode("latin-1"), magic)
    automaton.make_automaton()
    return automaton


def carve_all(data: bytes | None) -> tuple[list[tuple[str, int, int, int | None]], int]:
    """([(type, offset, length, parent)] of valid media, magic bytes seen).

    parent is the offset of the innermost medium that a nested one lies in as a whole, null outside of any.
    """
    found, seen = [], 0
    around: list[tuple[int, int, bytes]] = []  # media that are open: offset, end, and the bytes up to there
    if data:
        for last, magic in _automaton().iter(data.decode("latin-1")):
            seen += 1
            at = last + 1 - len(magic)
            while around and at >= around[-1][1]:
                around.pop()
            held = around[-1][2] if around else data
            for kind, start, valid in FORMATS:
                if start == magic and (size := valid(held, at)):
                    found.append((kind, at, size, around[-1][0] if around else None))
                    around.append((at, at + size, held if at + size == len(held) else held[: at + size]))
                    break
    return found, seen


def carve(data: bytes | None) -> tuple[list[tuple[str, int, int]], int]:
    """([(type, offset, length)] of valid media that don't lie in an earlier one, magic bytes seen)."""
    found, seen = carve_all(data)
    return [m[:3] for m in found if m[3] is None], seen


def judged(data: bytes | None, declared: str | None) -> tuple[str, bool, list[tuple[str, int, int, int | None]], int]:
    """(type, whether a declared one differs, embedded media, magic bytes seen) of one file."""
    found, seen = carve_all(data)
    whole = bool(found) and found[0][1] == 0
    kind = found[0][0] if whole else UNKNOWN
    return kind, kind != declared, found[whole:], seen


def sniff(media: DataFrame, media_col: str = "media", declared_col: str = "declared") -> DataFrame:
    """``media`` and: __type, __corrected, __carved (array of struct(type, offset, length, parent)), __hits.

    __type is that of the valid medium at offset 0, else UNKNOWN; __corrected whether a declared type (null counts as none)
    differs. __carved holds the embedded media, nested ones with the offset of their parent. Null and empty bytes are UNKNOWN without media.
    """
    base = media.drop("__type", "__corrected", "__carved", "__hits")
    at, declared = base.columns.index(media_col), base.columns.index(declared_col)
    item = pa.struct([("type", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("parent", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            rows = [judged(d, t) for d, t in zip(batch.column(at).to_pylist(), batch.column(declared).to_pylist(), strict=True)]
            carved = [[{"type": k, "offset": o, "length": n, "parent": p} for k, o, n, p in r[2]] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.bool_()), pa.array(carved, pa.list_(item)), pa.array([r[3] for r in rows], pa.int64())],
                names=[*batch.schema.names, "__type", "__corrected", "__carved", "__hits"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{fields}, __type string, __corrected boolean, __carved array<struct<type:string,offset:bigint,length:bigint,parent:bigint>>, __hits long")


def to_wav(payload: bytes) -> bytes:
    """Mono PCM, 8 bits a sample, 8 kHz."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, 8000, 8000, 1, 8, b"data", len(payload)) + payload


def to_au(payload: bytes) -> bytes:
    """Mono linear PCM, 8 bits a sample, 8 kHz."""
    return struct.pack(">4s5I", b".snd", 24, len(payload), 2, 8000, 1) + payload


def to_png(payload: bytes, width: int = ALIGN) -> bytes:
    """8-bit greyscale, a pixel a byte, rows of ``width`` without filter."""
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", binascii.crc32(kind + body))
    rows = np.zeros((len(payload) // width, width + 1), np.uint8)
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(-1, width)
    head = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 1)) + chunk(b"IEND", b"")


def samples(data: bytes, kind: str) -> tuple[bytes, str]:
    """(the stored samples, their shape) of a medium of a type that ``to_*`` writes."""
    if kind == "audio/wav":
        pos = 12
        while data[pos : pos + 4] != b"data":
            size = struct.unpack_from("<I", data, pos + 4)[0]
            pos += 8 + size + (size & 1)
        body = data[pos + 8 : pos + 8 + struct.unpack_from("<I", data, pos + 4)[0]]
        return body, f"{len(body)} samples"
    if kind == "audio/basic":
        offset, size = struct.unpack_from(">2I", data, 4)
        return data[offset : offset + size], f"{size} samples"
    if kind == "image/png":
        pos, coded, width, height = 8, [], 0, 0
        while (name := data[pos + 4 : pos + 8]) != b"IEND":
            size = struct.unpack_from(">I", data, pos)[0]
            if name == b"IHDR":
                width, height, depth, colour = struct.unpack_from(">IIBB", data, pos + 8)
                if (depth, colour) != (8, 0):
                    raise ValueError("only 8-bit greyscale is read")
            elif name == b"IDAT":
                coded.append(data[pos + 8 : pos + 8 + size])
            pos += 12 + size
        rows = np.frombuffer(zlib.decompress(b"".join(coded)), np.uint8).reshape(height, width + 1)
        if rows[:, 0].any():
            raise ValueError("only unfiltered rows are read")
        return rows[:, 1:].tobytes(), f"{width}x{height}"
    raise ValueError(f"no samples in {kind}")


_WRITERS = (("audio/wav", to_wav), ("audio/basic", to_au), ("image/png", to_png))


def stored(text: bytes | None) -> tuple[int, bytes, str]:
    """(bytes of the text, its medium, declared type)."""
    text = text or b""
    payload = text + bytes(max(ALIGN, -(-len(text) // ALIGN) * ALIGN) - len(text))
    crc = zlib.crc32(payload)
    return len(text), _WRITERS[crc % 3][1](payload), _WRITERS[(crc >> 8) % 3][0]


def read_back(data: bytes, kind: str, wrong: bool, carved: list[tuple[str, int, int, int | None]]) -> tuple[int, str, int, int, str, str]:
    """The values of FEATURES of one medium of a type that ``to_*`` writes."""
    body, shape = samples(data, kind)
    embedded = ",".join(f"{k}@{o}+{n}" for k, o, n, p in carved if p is None)
    held = ",".join(f"{k}@{o}+{n}{'' if p is None else f' in {p}'}" for k, o, n, p in carve_all(body)[0])
    feature = f"{kind} {shape}{' corrected' if wrong else ''}{' carved ' + embedded if embedded else ''}{' holds ' + held if held else ''}"
    return len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-ALIGN:]), len(data), hashlib.sha256(data).hexdigest(), feature


FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
_FEATURE_KINDS = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
_FEATURE_NAMES = [x.split()[0] for x in FEATURES.split(", ")]


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, media, declared): each whole text as a medium of 8-bit samples.

    The payload is the UTF-8 bytes and zeros up to a positive multiple of ALIGN; null is empty. Its CRC-32 chooses the
    format and a declared type that is often wrong, so equal texts are stored alike. Other columns are not read.
    """
    light = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            sizes, media, declared = [], [], []
            for text in binary_column(batch, "body").to_pylist():
                for column, value in zip((sizes, media, declared), stored(text), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary()), pa.array(declared)], names=["id", "n_bytes", "media", "declared"])

    kind = light.schema["id"].dataType.simpleString()
    return light.mapInArrow(run, f"id {kind}, n_bytes long, media binary, declared string").withColumnRenamed("id", id_col)


def payloads(sniffed: DataFrame, media_col: str = "media") -> DataFrame:
    """``sniffed`` (from ``sniff``) without the media: payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, read back by the type found.

    feature names the media carved outside of the file's own medium, and behind "holds" those carved from its payload, at
    their offset there, with "in" and the parent's offset if they are nested.
    """
    base = sniffed.drop("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
    kept = [c for c in base.columns if c not in (media_col, "__type", "__corrected", "__carved", "__hits", "declared")]
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column = {n: i for i, n in enumerate(names)}
        for batch in slices(batches, 64):
            get = lambda n: batch.column(column[n]).to_pylist()  # noqa: B023, E731
            rows = []
            for data, kind, wrong, carved in zip(get(media_col), get("__type"), get("__corrected"), get("__carved"), strict=True):
                rows.append(read_back(data, kind, wrong, [(c["type"], c["offset"], c["length"], c["parent"]) for c in carved]))
            kinds = _FEATURE_KINDS
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(column[c]) for c in kept), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))],
                names=[*kept, *_FEATURE_NAMES],
            )

    fields = ", ".join(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in kept)
    return base.mapInArrow(run, f"{fields}, {FEATURES}")


def media_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes and FEATURES): ``store``, ``sniff`` and ``payloads`` in one pass, whose media are never rows of a table.

    A row per row of ``docs``, repeated ones alike. Null and empty text is a payload of zeros. An empty table gives none.
    Other columns are not read. Whole texts are taken, however long.
    """
    light = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            sizes, rows = [], []
            for text in binary_column(batch, "body").to_pylist():
                size, medium, declared = stored(text)
                kind, wrong, carved, _ = judged(medium, declared)
                sizes.append(size)
                rows.append(read_back(medium, kind, wrong, carved))
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(_FEATURE_KINDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *columns], names=["id", "n_bytes", *_FEATURE_NAMES])

    kind = light.schema["id"].dataType.simpleString()
    return light.mapInArrow(run, f"id {kind}, n_bytes long, {FEATURES}").withColumnRenamed("id", id_col)


def op3_signature_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(documents(spark, sf_dir))
