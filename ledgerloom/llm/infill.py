"""Fill-in-the-middle documents, cut at token boundaries.

The ends of a text's tokens are a boundary set (``boundaries.py``) that returns both cut offsets;
the three parts are put in the order of the document's form, with a sentinel before each.  What
is random (cuts, form) comes from a hash of a salt and the document's id, so reruns agree and
no order of rows matters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import words as W
from ledgerloom.llm.boundaries import BoundarySet

_LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256)])
_KEPT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_DIGEST = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


@dataclass(frozen=True)
class Infill:
    """Sentinels, the salt of the hash, and percentages: texts that stay plain, and those of the rest
    that give the suffix first."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    salt: str = "1:"
    plain_percent: int = 10
    suffix_first_percent: int = 20

    def draws(self, doc_id: int | None) -> list[int]:
        """Four 32-bit integers of a document."""
        digest = hashlib.sha256(f"{self.salt}{'' if doc_id is None else doc_id}".encode()).digest()
        return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]

    def marks(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()

    def form(self, text: bytes, draws: list[int]) -> str:
        if not text or any(m in text for m in self.marks()) or draws[2] % 100 >= 100 - self.plain_percent:
            return "plain"
        return "spm" if draws[3] % 100 < self.suffix_first_percent else "psm"

    def joined(self, form: str, text: bytes, first: int, second: int) -> bytes:
        """The text with its parts, cut at bytes ``first`` and ``second``, in the order of the form."""
        if form == "plain":
            return text
        p, s, m = self.marks()
        head, middle, tail = text[:first], text[first:second], text[second:]
        return p + head + s + tail + m + middle if form == "psm" else s + tail + p + head + m + middle

    def restored(self, form: str, output: bytes) -> bytes:
        """The text that ``joined`` had."""
        if form == "plain":
            return output
        p, s, m = self.marks()
        one, two = (p, s) if form == "psm" else (s, p)
        rest = output[len(one) :]
        a, rest = rest.split(two, 1)
        b, middle = rest.split(m, 1)
        return a + middle + b if form == "psm" else b + middle + a


def token_ends(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ends of all tokens (a run of ASCII letters, or any other character) and n + 1 token offsets of the documents."""
    n = len(raw)
    if not n:
        return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    letter = _LETTER[raw]
    starts = (raw & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    edge = offsets[offsets < n]
    starts[edge] = True
    first = np.flatnonzero(starts)
    return np.append(first[1:], n), np.searchsorted(first, offsets)


def _rows(batches: Iterator[pa.RecordBatch], how: Infill) -> Iterator[tuple]:
    """(doc_id, tokens, form, prefix and middle characters, output as bytes) of every row, piece by piece."""
    for batch in batches:
        ids = batch.column("doc_id")
        raw, offsets = W.text_buffers(batch.column("text"))
        for a, b in W.pieces(offsets):
            at = offsets[a : b + 1] - offsets[a]
            part = raw[offsets[a] : offsets[b]]
            ends, token_at = token_ends(part, at)
            chars = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
            rows = []
            for i in range(b - a):
                doc_id = ids[a + i].as_py()
                draws = how.draws(doc_id)
                text = part[at[i] : at[i + 1]].tobytes()
                n = int(token_at[i + 1] - token_at[i])
                form = how.form(text, draws)
                if form == "plain":
                    rows.append((doc_id, n, form, None, None, text))
                    continue
                one, two = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
                first, second = BoundarySet(ends[token_at[i] : token_at[i + 1]] - at[i]).cuts(one, two)
                count = chars[at[i] + np.array([0, first, second])]
                rows.append((doc_id, n, form, int(count[1] - count[0]), int(count[2] - count[1]), how.joined(form, text, first, second)))
            yield rows


def _outputs(batches: Iterator[pa.RecordBatch], how: Infill) -> Iterator[pa.RecordBatch]:
    for rows in _rows(batches, how):
        ids, n, form, prefix, middle, output = zip(*rows)
        text = pa.array(output, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), text], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _digests(batches: Iterator[pa.RecordBatch], how: Infill) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c) for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars")]
        forms, raw = columns[2].to_pylist(), [x.as_py().encode() for x in batch.column("output")]
        out = [hashlib.sha256(x).hexdigest() for x in raw]
        back = [hashlib.sha256(how.restored(f, x)).hexdigest() for f, x in zip(forms, raw)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.string()), pa.array(back, pa.string())], [*(c.strip().split(" ")[0] for c in _DIGEST.split(","))])


def transform(docs: DataFrame, how: Infill | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n (tokens), form, prefix_chars, middle_chars, output.

    ``form`` is plain (the text as it is), psm or spm; the counts are code points, null where the
    form is plain.  Null and empty texts, and texts that hold a sentinel, are plain; a document
    without an id draws from the salt alone, so all such documents draw the same; rows that repeat
    give the same row again; texts of any length are cut whole.  An empty table gives no rows;
    other columns don't matter.
    """
    how = how or Infill()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: _outputs(batches, how), _KEPT)


def report(docs: DataFrame, how: Infill | None = None) -> DataFrame:
    """Digests of every output, and of the text that is rebuilt from output and form."""
    how = how or Infill()
    return transform(docs, how).mapInArrow(lambda batches: _digests(batches, how), _DIGEST)
