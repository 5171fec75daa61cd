"""Operator 12: fill-in-the-middle by a constant-memory, two-pass streaming matcher.

A text is cut at two ranks of its units. The first pass counts the units; the second advances one lazy match iterator to the
smaller rank and then on to the larger, and only two character positions are kept: no array of units exists, so memory is the text and its output.

A null text is empty; an empty text, or one that holds a sentinel, stays plain. A null id draws like the id ''. Repeated rows stay,
each with the same draw. Columns of the input other than id and text don't come through, so they cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, sha256_hex, slices

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of 100 texts so many are rearranged, and of these so many have the suffix first.
RATE, SPM_RATE, SEED = 90, 20, 1


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 that depend on seed and id alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[at : at + 8], 16) for at in range(0, 32, 8))


def count_units(text: str) -> int:
    """First pass."""
    return sum(1 for _ in UNIT.finditer(text))


def cuts(text: str, first: int, second: int) -> tuple[int, int]:
    """Second pass: the character positions behind ``first`` and ``second`` units (first <= second <= number of units)."""
    found = UNIT.finditer(text)
    ends, at = [], 0
    for more in (first, second - first):
        if more:
            at = next(islice(found, more - 1, None)).end()
        ends.append(at)
    return ends[0], ends[1]


def transformed(text: str, draw: tuple[int, int, int, int], rate: int = RATE, spm_rate: int = SPM_RATE) -> tuple[str, int, str, int | None, int | None]:
    """(output, n, form, characters of the prefix, of the middle)."""
    n = count_units(text)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or draw[2] % 100 >= rate:
        return text, n, PLAIN, None, None
    one, two = draw[0] % (n + 1), draw[1] % (n + 1)
    begin, end = cuts(text, min(one, two), max(one, two))
    prefix, middle, suffix = text[:begin], text[begin:end], text[end:]
    if draw[3] % 100 < spm_rate:
        return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", n, SPM, begin, end - begin
    return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", n, PSM, begin, end - begin


def restore(output: str, form: str) -> str:
    """The text again, from output and form alone: a sentinel can't arise at a seam, as it overlaps with none of its own ends."""
    if form == PLAIN:
        return output
    head, second = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    at = output.index(second, len(head))
    end = output.index(MIDDLE, at)
    one, two, middle = output[len(head) : at], output[at + len(second) : end], output[end + len(MIDDLE) :]
    return one + middle + two if form == PSM else two + middle + one


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """Per row (doc_id, n, form, prefix_chars, middle_chars, output, restored); rate and spm_rate are percentages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # few rows at a time, as texts can be long
        for batch in slices(batches, 64):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                output, n, form, begin, middle = transformed(text or "", draws(doc_id, seed), rate, spm_rate)
                rows.append((doc_id, n, form, begin, middle, output, restore(output, form)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, SCHEMA)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(documents(spark, sf_dir))
    digests = [sha256_hex(F.col(c).cast("binary")).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_sql() -> str:
    """DuckDB SQL with the same rows."""
    number = lambda at: f"('0x' || substr(h, {at}, 8))::BIGINT"
    return f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), ranks AS (
  SELECT doc_id, t, u, len(u) AS n, {number(1)} % (len(u) + 1) AS a, {number(9)} % (len(u) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {number(17)} % 100 >= 90 THEN 'plain'
      WHEN {number(25)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cut
), parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
    array_to_string(u[greatest(a, b) + 1:], '') AS s FROM ranks
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM parts"""
