"""Quality rules: base counts of a text, and a linear-chain CRF that marks its lines as content or boilerplate.

The CRF has two labels, emission weights over features of one line and a transition matrix. It is fitted by penalised maximum
likelihood on a bounded sample of labelled documents, whose lines take the label of their document. Viterbi decoding
labels all lines of every text; the share of words in content lines decides what stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_column, documents, slices, words_of

CONTENT, BOILERPLATE = 0, 1
#: Most labelled documents in training (those of the least id hash), the same for any size of the corpus.
TRAIN_DOCS = 1_500
#: Lines of a training sequence: all lines of those documents make such labelled sequences, and training takes at most
#: TRAIN_SPANS of them, those of the least hash, so that long texts count as a whole and the sample stays bounded.
TRAIN_SPAN = 32
TRAIN_SPANS = 8_000
TRAIN_STEPS = 200
PENALTY = 1e-4
#: Lines of a training document share one label, so transitions would come out too stiff to mark a line among others.
MOVE_PENALTY = 5e-2
#: A text stays if at least this share of its words is in content lines.
CONTENT_SHARE = 0.5

MIN_WORDS = 10
REPEAT_WINDOW = 5
MAX_REPEAT_PERCENT = 20

SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_CONTINUATION = bytes(range(0x80, 0xC0))
_SPACE = b" \t\n\v\f\r"
FEATURES = ("bias", "blank", "symbols", "symbol_heavy", "bars", "shouts", "capitals", "digits", "repeated", "short", "menu", "long_words", "uniform")


@dataclass
class Model:
    emit: np.ndarray  # (features, 2)
    move: np.ndarray  # (2, 2): from, to


def code_points(data: bytes) -> int:
    return len(data.translate(None, _CONTINUATION))


def line_features(line: bytes, words: list[bytes], seen: bool) -> list[float]:
    """One line's features; seen: an equal line stands earlier in the text."""
    if not words:
        return [1.0, 1.0, *[0.0] * (len(FEATURES) - 2)]
    n, size = len(words), len(line)
    symbols = size - len(line.translate(None, SYMBOLS))
    capitals = size - len(line.translate(None, _UPPER))
    digits = size - len(line.translate(None, _DIGITS))
    bars, shouts = line.count(b"|"), line.count(b"!")
    return [
        1.0,
        0.0,
        min(1.0, symbols / n),
        float(symbols * 2 > n),
        min(1.0, 2 * bars / n),
        min(1.0, shouts / n),
        min(1.0, 2 * capitals / size),
        min(1.0, 3 * digits / size),
        float(seen),
        float(n < 4),
        float(n < 6 and words[-1][-1:] not in (b".", b"?", b"!", b":", b";")),
        float(size > 12 * n),
        float(n > 3 and len(set(words)) * 2 < n),
    ]


def lines_of(text: bytes | None) -> Iterator[tuple[bytes, list[bytes], bool]]:
    """(line, its words, whether an equal line came before) for the \\n-split lines; no line for null or empty text."""
    before: set[bytes] = set()
    for line in text.split(b"\n") if text else ():
        words = line.split()
        seen = bool(words) and line in before
        if words and not seen:
            before.add(line)
        yield line, words, seen


def repeat_words(words: list[bytes], width: int = REPEAT_WINDOW) -> int:
    """Words under windows of ``width`` words that the text has twice or more, first ones included; exact, by word numbers."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    key, size, base = ids[:n], len(numbers), len(numbers)
    for j in range(1, width):
        if size * base >= 1 << 62:
            _, key = np.unique(key, return_inverse=True)
            size = int(key.max()) + 1
        key, size = key * base + ids[j : n + j], size * base
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(len(words) + 1, np.int64)
    steps[:n] += twice
    steps[width:] -= twice
    return int((np.cumsum(steps[:-1]) > 0).sum())


def viterbi(features: np.ndarray, model: Model) -> list[int]:
    """The best label sequence; of equal ones that with content later on."""
    emit = (features @ model.emit).tolist()
    (cc, cb), (bc, bb) = model.move.tolist()
    c, b = emit[0]
    back = []
    for ec, eb in emit[1:]:
        to_c, to_b = c + cc < b + bc, c + cb < b + bb
        back.append((to_c, to_b))
        c, b = ec + (b + bc if to_c else c + cc), eb + (b + bb if to_b else c + cb)
    label = int(b > c)
    labels = [label]
    for choice in reversed(back):
        label = int(choice[label])
        labels.append(label)
    return labels[::-1]


def train(features: list[np.ndarray], labels: list[int]) -> Model:
    """Maximum likelihood with an L2 penalty, by Adam; features: (lines, features) a document, labels: one a document."""
    width = len(FEATURES)
    spans = [(x[i : i + TRAIN_SPAN], y) for x, y in zip(features, labels, strict=True) for i in range(0, len(x), TRAIN_SPAN)]
    if not spans or len(set(labels)) < 2:
        return Model(np.zeros((width, 2)), np.zeros((2, 2)))  # nothing to tell apart: all lines are content
    x = np.zeros((len(spans), TRAIN_SPAN, width))
    mask = np.zeros((len(spans), TRAIN_SPAN))
    gold = np.array([y for _, y in spans])
    for i, (s, _) in enumerate(spans):
        x[i, : len(s)], mask[i, : len(s)] = s, 1
    weight = np.full(len(spans), 1 / len(spans))
    truth = np.eye(2)[gold]
    theta = np.zeros(2 * width + 4)
    penalty = np.repeat([PENALTY, MOVE_PENALTY], [2 * width, 4])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, TRAIN_STEPS + 1):
        emit, move = theta[: 2 * width].reshape(width, 2), theta[2 * width :].reshape(2, 2)
        score = x @ emit
        alpha, beta = np.zeros_like(score), np.zeros_like(score)
        alpha[:, 0] = score[:, 0]
        for t in range(1, TRAIN_SPAN):
            nxt = score[:, t] + np.logaddexp.reduce(alpha[:, t - 1, :, None] + move, axis=1)
            alpha[:, t] = np.where(mask[:, t, None] > 0, nxt, alpha[:, t - 1])
        for t in range(TRAIN_SPAN - 2, -1, -1):
            nxt = np.logaddexp.reduce(move + (score[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(mask[:, t + 1, None] > 0, nxt, 0)
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)
        unary = np.exp(alpha + beta - total[:, None, None]) * mask[:, :, None]
        pair = np.exp(alpha[:, :-1, :, None] + move + (score + beta)[:, 1:, None, :] - total[:, None, None, None]) * mask[:, 1:, None, None]
        lines, steps = mask.sum(axis=1), mask[:, 1:].sum(axis=1)
        share = weight / lines
        grad_emit = np.einsum("std,stk->dk", x, (truth[:, None, :] * mask[:, :, None] - unary) * share[:, None, None])
        want = np.einsum("s,si,sj->ij", share * steps, truth, truth)
        grad_move = want - np.einsum("stij,s->ij", pair, share)
        grad = np.concatenate([grad_emit.ravel(), grad_move.ravel()]) - penalty * theta
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        theta = theta + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(theta[: 2 * width].reshape(width, 2), theta[2 * width :].reshape(2, 2))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", max_docs: int = TRAIN_DOCS, max_spans: int = TRAIN_SPANS) -> Model:
    """A CRF from at most ``max_spans`` sequences of at most ``max_docs`` labelled documents. quality 1 is content, 0 boilerplate.

    Labels that are null or other, and null ids, are left out; of several labels of an id the least counts; all texts of a
    repeated id take part. Features of whole texts are made in the tasks; only those of the sample come to the driver.
    No labels: a model for which all lines are content.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(quality_col).alias("quality")).filter("id IS NOT NULL AND quality IN (0, 1)")
    picked = marked.groupBy("id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("id"), "id").limit(max_docs).collect()
    known = {r["id"]: int(r["quality"]) for r in picked}
    if not known:
        return train([], [])
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body")).filter(F.col("id").isin(list(known)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            order, quality, features = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), binary_column(batch, "body").to_pylist(), strict=True):
                seed, held = xxhash.xxh64_intdigest(text or b""), []
                for line in lines_of(text):
                    held.append(line_features(*line))
                    if len(held) == TRAIN_SPAN:
                        features.append(np.array(held, "<f4").tobytes())
                        held = []
                if held:
                    features.append(np.array(held, "<f4").tobytes())
                for at in range(len(features) - len(order)):
                    order.append(xxhash.xxh64_intdigest(f"{key} {seed} {at}") - (1 << 63))
                    quality.append(known[key])
            yield pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), pa.array(quality, pa.int32()), pa.array(features, pa.binary())], names=["order", "quality", "features"])

    rows = sample.mapInArrow(run, "order long, quality int, features binary").orderBy("order", "features").limit(max_spans).collect()
    return train([np.frombuffer(r["features"], "<f4").reshape(-1, len(FEATURES)).astype(float) for r in rows], [1 - r["quality"] for r in rows])


RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double, line_labels string"


def judge(text: bytes | None, model: Model, least_share: float = CONTENT_SHARE) -> tuple:
    """The values of RESULT for one text."""
    words = words_of(text)
    rows = list(lines_of(text))
    n, repeated = len(words), repeat_words(words)
    symbols = len(text) - len(text.translate(None, SYMBOLS)) if text else 0
    chars = code_points(text.translate(None, _SPACE)) if text else 0
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
    labels = viterbi(np.array([line_features(*r) for r in rows]), model) if rows else []
    content = sum(len(r[1]) for r, label in zip(rows, labels, strict=True) if label == CONTENT)
    share = content / n if n else 0.0
    return n, chars, symbols, sum(r[2] for r in rows), repeated, failed, not failed and share >= least_share, share, "".join("CB"[x] for x in labels)


def quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", least_share: float = CONTENT_SHARE) -> DataFrame:
    """(id_col and the columns of RESULT), a row per row of ``docs``; line_labels has a C or B for each line.

    Null and empty text: no words, no lines, base_failed, not kept. Repeated rows are judged alike. An empty table
    gives none. Other columns are not read. Whole texts are judged, however long.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    light = docs.select(F.col(id_col), F.col(text_col).alias("__body"))
    kinds = (*(pa.int64(),) * 5, pa.bool_(), pa.bool_(), pa.float64(), pa.string())
    names = [id_col, *(x.split()[0] for x in RESULT.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [judge(x, shared.value, least_share) for x in binary_column(batch, "__body").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))], names=names)

    return light.mapInArrow(run, f"`{id_col}` {light.schema[id_col].dataType.simpleString()}, {RESULT}")


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality(docs, model).drop("line_labels")
