"""BPE encoding as a bounded-lookahead streaming transducer, and incremental decoding.

Encoding. For each prefix of a pre-token there is one last token of its BPE encoding: the token t, ending there, that is
compatible with the last token of the prefix before t. Two tokens are compatible if the merges, run in their order,
never join across the seam; that is decided by walking the two derivations along the seam. So one pass over the
symbols, with back-pointers, yields the encoding.

Lookahead. No token is longer than ``lookahead`` symbols, a figure of the merge list, so the encoding of any longer
text passes through one of the last ``lookahead`` positions. Back-pointers from all of these meet; up to the place where
they meet the tokens can't change any more whatever follows, and they are emitted and forgotten. State is the open
window only, however long the text.

Decoding keeps at most the bytes of one unfinished character (byte-level decoder), or whether a token came before (no
decoder: token strings joined by blanks, as the tokenizers library does then).
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_column, documents, slices

#: Entries of each generation of a worker's caches: two generations of chunks, of up to some 300 bytes each, two of half as
#: many pre-tokens, and seams; about 200 MB in all when full.
CACHE = 200_000
#: Symbols between two looks for tokens that can't change any more.
SETTLE = 256
NEVER = 1 << 62


class Transducer:
    """BPE over one pre-token at a time; ``vocab`` maps token strings to ids, ``merges`` is the ordered pair list."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.rank, self.parts = {}, {}
        for order, (left, right) in enumerate(merges):
            joined = left + right
            self.rank[vocab[left], vocab[right]] = order
            self.parts[vocab[joined]] = (vocab[left], vocab[right], order)
        cut = len(suffix)
        self.inner = {t: i for t, i in vocab.items() if not (cut and t.endswith(suffix))}
        self.final = {t[:-cut]: i for t, i in vocab.items() if t.endswith(suffix)} if cut else self.inner
        #: symbols that may still change a boundary: the longest token
        self.lookahead = max(map(len, [*self.inner, *self.final]))
        self.inner_ends = self._ends(self.inner)
        self.final_ends = self._ends(self.final) if cut else self.inner_ends
        self.names = {i: t for t, i in vocab.items()}
        self.spines: tuple[dict[int, list], dict[int, list]] = ({}, {})
        #: for a left token what is known of right ones; tokens nothing is known of share one empty table
        self.nothing: dict[int, bool] = {}
        self.seams, self.seams_known = [self.nothing] * (max(vocab.values(), default=0) + 1), 0

    @staticmethod
    def _ends(table: dict[str, int]) -> tuple:
        """The tokens from their last symbol on, as a tree of [token or -1, {symbol before: node}]."""
        root: list = [-1, {}]
        for text, token in table.items():
            node = root
            for symbol in reversed(text):
                node = node[1].setdefault(symbol, [-1, {}])
            node[0] = token
        leaf: dict = {}
        stack = [root]
        while stack:
            node = stack.pop()
            stack += node[1].values()
            node[1] = node[1] or leaf
        return tuple(root)

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The token's parts at its left (0) or right (1) end, innermost first, each with the order of the merge that takes it up."""
        known = self.spines[side].get(token)
        if known is None:
            known, at = [(token, NEVER)], token
            while at in self.parts:
                order, at = self.parts[at][2], self.parts[at][side]
                known.append((at, order))
            known.reverse()
            self.spines[side][token] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether left and right stay apart when their symbols are merged together."""
        found = self.seams[left].get(right)
        if found is None:
            if self.seams_known >= 2 * CACHE:
                self.seams, self.seams_known = [self.nothing] * len(self.seams), 0
            xs, ys, i, j, found = self._spine(left, 1), self._spine(right, 0), 0, 0, True
            while True:
                (x, taken_x), (y, taken_y) = xs[i], ys[j]
                seam = self.rank.get((x, y), NEVER)
                if seam < taken_x and seam <= taken_y and seam < NEVER:
                    found = False
                    break
                if taken_x == NEVER and taken_y == NEVER:
                    break
                # of equal orders the one further left comes first
                if taken_x <= taken_y:
                    i += 1
                else:
                    j += 1
            if self.seams[left] is self.nothing:
                self.seams[left] = {}
            self.seams[left][right] = found
            self.seams_known += 1
        return found

    def stream(self, symbols: Iterable[str]) -> Iterator[int]:
        """Token ids of one pre-token, given symbol by symbol (strings of any length), each as soon as it is settled."""
        held, text, last, size = None, "", [-1], [0]
        at, settle = 0, SETTLE
        for piece in symbols:
            if not piece:
                continue
            text += (held or "") + piece[:-1]
            held = piece[-1]
            at = self._advance(text, at, last, size, False)
            if len(text) >= settle:
                out, cut = self._settled(last, size)
                if cut:
                    yield from out
                    text, last[:], size[:], at = text[cut:], last[cut:], size[cut:], at - cut
                settle = len(text) + SETTLE
        if held is not None:
            text += held
            self._advance(text, at, last, size, True)
            yield from self._back(last, size, len(text))

    def _advance(self, text: str, at: int, last: list[int], size: list[int], end: bool) -> int:
        """Fills last token and its length for the prefixes up to the whole text; ``end``: the last symbol ends the pre-token."""
        n, compatible = len(text), self.compatible
        for i in range(at + 1, n + 1):
            node = self.final_ends if end and i == n else self.inner_ends
            j, seams = i, self.seams
            while j:
                j -= 1
                node = node[1].get(text[j])
                if node is None:
                    raise ValueError(f"no token for {text[j:i]!r}")
                token = node[0]
                if token >= 0:
                    before = last[j]
                    if before < 0:
                        break
                    ok = seams[before].get(token)
                    if ok or (ok is None and compatible(before, token)):
                        break
            else:
                raise ValueError(f"no token for {text[:i]!r}")
            last.append(token)
            size.append(i - j)
        return n

    def _back(self, last: list[int], size: list[int], n: int) -> list[int]:
        out = []
        while n > 0:
            out.append(last[n])
            n -= size[n]
        return out[::-1]

    def _settled(self, last: list[int], size: list[int]) -> tuple[list[int], int]:
        """(tokens that can't change any more, where they end)."""
        n = len(last) - 1
        meet = set(range(max(0, n - self.lookahead + 1), n + 1))
        while len(meet) > 1:
            far = max(meet)
            meet.remove(far)
            meet.add(far - size[far])
        cut = meet.pop()
        out = self._back(last, size, cut)
        if cut:
            # the kept prefix's tokens stay known at the new start, for the seam with what follows
            last[cut] = last[cut] if out else -1
        return out, cut

    def encode(self, pretoken: str) -> list[int]:
        """A pre-token's ids; a long one is fed in pieces, so that no more than the open window of its symbols is held."""
        if len(pretoken) <= SETTLE:
            return self._short(pretoken)
        return list(self.stream(pretoken[at : at + SETTLE] for at in range(0, len(pretoken), SETTLE)))

    def _short(self, pretoken: str) -> list[int]:
        if not pretoken:
            return []
        last, size = [-1], [0]
        n = self._advance(pretoken, 0, last, size, True)
        return self._back(last, size, n)


class Decoder:
    """Token ids to text, piece by piece. byte_level: tokens spell bytes; else their strings are joined by blanks."""

    def __init__(self, names: dict[int, str], byte_level: bool = False):
        self.names, self.byte_level = names, byte_level
        self.first = True
        self.open = b""
        if byte_level:
            plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
            rest = [b for b in range(256) if b not in plain]
            self.bytes = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

    def feed(self, ids: Iterable[int]) -> str:
        """The text that is certain after these ids; unknown ids give nothing."""
        tokens = [self.names[i] for i in ids if i in self.names]
        if not self.byte_level:
            lead = "" if self.first or not tokens else " "
            self.first &= not tokens
            return lead + " ".join(tokens)
        data = self.open + bytes(self.bytes.get(c, 63) for t in tokens for c in t)
        keep = 0
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                keep = back if need > back else 0
                break
            if byte < 0x80:
                break
        self.open = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.open, self.first = self.open, b"", True
        return rest.decode("utf-8", "replace")


class Cache:
    """A map of bounded size in two generations: what was used lately outlives a turn."""

    def __init__(self, bound: int = CACHE):
        self.new: dict = {}
        self.old: dict = {}
        self.bound = bound

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.bound:
            self.old, self.new = self.new, {}
        self.new[key] = value


#: Bytes of text in the first 256 characters, without separators \x1c to \x1f.
_LATIN = bytes(x for x in range(0xC4) if not 0x1C <= x <= 0x1F)


class Pretokens:
    """Chunks (runs without ASCII white space) to the tokenizer's pre-tokens, in the spelling its vocabulary uses.

    White space only separates here: pre-tokens never hold any, so a text's pre-tokens are its chunks' in order. Special
    tokens are found in the raw text first and come as their id; parts beside them stand alone, as in the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.specials = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.find_specials = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        # Fixed value: the word pattern of the tokenizer file. Where it is the file's, chunks of characters that
        # normalisation only lower-cases, one by one (up to U+012F, without blanks), are cut right here.
        words = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        parts = (self.spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.simple = "Lowercase" in str(self.spec.get("normalizer")) and len(parts) == 2 and parts[0].get("pattern", {}).get("Regex") == words
        self.plain = re.compile("[\x21-\x7e\xa1-\u012f]+").fullmatch
        self.words = regex.compile(words).findall
        #: whether white space only separates, so that a text's pre-tokens are those of its chunks
        self.apart = self.simple
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [x for x in range(256) if x not in plain]
        self.spelling = {x: chr(x) for x in plain} | {x: chr(256 + i) for i, x in enumerate(rest)}

    def latin(self, text: bytes) -> bool:
        """Whether all of the text is of the first 256 characters, without odd separators or special tokens: there
        normalisation only lower-cases, letter by letter."""
        return self.simple and not text.translate(None, _LATIN) and b"<|" not in text and b"\xc2\x85" not in text and b"\xc2\xa0" not in text

    def split(self, chunk: bytes) -> list[str | int]:
        text = chunk.decode()
        if self.find_specials is not None and "<" in text and self.find_specials.search(text):
            found, at = [], 0
            for m in self.find_specials.finditer(text):
                found += [*self._parts(text[at : m.start()]), self.specials[m[0]]]
                at = m.end()
            return found + self._parts(text[at:])
        return self._parts(text)

    def whole(self, text: str) -> Iterator[str | int]:
        """The pre-tokens of a text in which white space counts, and the ids of special tokens."""
        at = 0
        for m in self.find_specials.finditer(text) if self.find_specials is not None else ():
            yield from self._library(text[at : m.start()])
            yield self.specials[m[0]]
            at = m.end()
        yield from self._library(text[at:])

    def _library(self, text: str) -> list[str]:
        made = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
        return [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(made)] if made else []

    def _parts(self, text: str) -> list[str | int]:
        if self.simple and self.plain(text):
            words = self.words(text.lower())
            return words if text.isascii() else [w if w.isascii() else "".join(map(self.spelling.__getitem__, w.encode())) for w in words]
        return self._library(text)


class ChunkEncoder:
    """Encodes texts chunk by chunk, remembering what a chunk gives: ``made(ids)`` of each pre-token's ids, and ``joined`` of several."""

    def __init__(self, path: str, made: Callable[[list[int]], object], joined: Callable[[list], object]):
        self.pretokens = Pretokens(path)
        self.tokenizer, spec = self.pretokens.tokenizer, self.pretokens.spec
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.transducer = Transducer(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.names = self.transducer.names | {i: s for s, i in self.pretokens.specials.items()}
        self.byte_decoder = bool(spec.get("decoder")) and spec["decoder"].get("type") == "ByteLevel"
        self.pretokens.spec = None  # the tables above hold what is needed
        self.made, self.joined = made, joined
        self.chunks, self.words = Cache(), Cache(CACHE // 2)

    def _word(self, word: str | int):
        found = self.words.get(word)
        if found is None:
            found = self.made([word] if isinstance(word, int) else self.transducer.encode(word))
            self.words.put(word, found)
        return found

    def encode(self, text: bytes | None) -> list:
        """What was made of each chunk, in order; null and blank text have none."""
        if text and self.pretokens.latin(text):
            text = text.decode().lower().encode()  # as normalisation does; so more chunks are equal
        chunks = text.split() if text else []
        found = list(map(self.chunks.new.get, chunks))
        if None in found:
            for at, value in enumerate(found):
                if value is None:
                    found[at] = self._missing(chunks[at])
        return found

    def _missing(self, chunk: bytes):
        value = self.chunks.get(chunk)
        if value is None:
            words = self.pretokens.split(chunk)
            value = self._word(words[0]) if len(words) == 1 else self.joined([self._word(w) for w in words])
            self.chunks.put(chunk, value)
        return value


class WholeEncoder:
    """Encodes texts in which white space counts: pre-token by pre-token, and decodes the ids as they come."""

    def __init__(self, encoder: ChunkEncoder):
        self.encoder, self.words = encoder, Cache()
        self.decoder = Decoder(encoder.names, encoder.byte_decoder)

    def run(self, text: bytes | None) -> tuple[int, bytes, bytes]:
        """(number of ids, ids as decimals joined by blanks, decoded text)."""
        ids, shown = [], []
        for word in self.encoder.pretokens.whole(text.decode() if text else ""):
            found = [word] if isinstance(word, int) else self.words.get(word)
            if found is None:
                found = self.encoder.transducer.encode(word)
                self.words.put(word, found)
            ids += found
            shown.append(self.decoder.feed(found))
        shown.append(self.decoder.finish())
        return len(ids), b" ".join([b"%d" % i for i in ids]), "".join(shown).encode()


_encoders: dict[tuple, ChunkEncoder] = {}
_wholes: dict[str, WholeEncoder] = {}


def _worker_encoder(path: str) -> ChunkEncoder:
    """One per Python worker: tables and caches last over its tasks."""
    found = _encoders.get((path, "text"))
    if found is None:

        def made(ids: list[int]) -> tuple[int, bytes, bytes]:
            decoder.finish()
            return len(ids), b" ".join([spelled[i] for i in ids]), decoder.feed(ids).encode()

        def joined(parts: list[tuple[int, bytes, bytes]]) -> tuple[int, bytes, bytes]:
            if not parts:
                return 0, b"", b""
            counts, ids, texts = zip(*parts, strict=True)
            return sum(counts), b" ".join(ids), b" ".join(texts)

        found = _encoders[path, "text"] = ChunkEncoder(path, made, joined)
        decoder = Decoder(found.names, found.byte_decoder)
        spelled = {i: str(i).encode() for i in found.names}
    return found


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids, decoded), a row per row of ``docs``: ids as decimals joined by blanks, and the text they decode to.

    ``path`` is a BPE tokenizer file whose decoder is that of bytes, or none (token strings joined by blanks). digest:
    SHA-256 in hex of both instead. Null and empty text: no ids, empty text. Repeated rows get equal results. An empty
    table gives none. Other columns are not read. Whole texts are encoded, however long.
    """
    light = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(path)
        whole = None
        if encoder.byte_decoder or not encoder.pretokens.apart:
            whole = _wholes.setdefault(path, WholeEncoder(encoder)) if path not in _wholes else _wholes[path]
        for batch in slices(batches, 128):
            counts, ids, texts = [], [], []
            for text in binary_column(batch, "body").to_pylist():
                numbers, spelled, decoded = zip(*((encoder.encode(text) if whole is None else [whole.run(text)]) or [(0, b"", b"")]), strict=True)
                if 0 in numbers:  # chunks without ids leave no blank
                    spelled, decoded = filter(None, spelled), filter(None, decoded)
                counts.append(sum(numbers))
                spelled, decoded = b" ".join(spelled), b" ".join(decoded)
                ids.append(hashlib.sha256(spelled).hexdigest() if digest else spelled.decode())
                texts.append(hashlib.sha256(decoded).hexdigest() if digest else decoded.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=["id", "n_tokens", "ids", "decoded"]
            )

    kind = light.schema["id"].dataType.simpleString()
    return light.mapInArrow(run, f"id {kind}, n_tokens long, ids string, decoded string").withColumnRenamed("id", id_col)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_decode(documents(spark, sf_dir), tokenizer_path(), digest=True)
    return found.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))
