"""Words of Arrow text columns as 64-bit hashes, whole batches at a time.

In UTF-8 every byte of a character above 0x7F is itself above 0x7F, so both word classes of
this subpackage can be read off single bytes.  A word's hash is a polynomial over its bytes
(A-Z lowered), taken from running sums, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def _class(inside) -> np.ndarray:
    return np.array([inside(b) for b in range(256)])


LOWER = _lowered()
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lowering A-Z
ALNUM = _class(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A)
#: ``[^\x20\x09-\x0D]+``
SPACED = _class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))[LOWER]
_P = U(0xD6E8FEB86659FD93)
_P_INV = U(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of about ``most`` bytes; a longer document is a run of its own."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def spans(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and n + 1 word offsets of the documents."""
    m = inside[raw]
    n = len(m)
    first, last = m.copy(), m.copy()
    if n:
        first[1:] &= ~m[:-1]
        last[:-1] &= ~m[1:]
        edge = offsets[(offsets > 0) & (offsets < n)]
        first[edge] = m[edge]
        last[edge - 1] = m[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and n + 1 word offsets of the documents."""
    starts, ends, at = spans(raw, offsets, inside)
    if not len(starts):
        return np.empty(0, np.uint64), at
    n = len(raw)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _powers(_P, n), out=run[1:])
    back = _powers(_P_INV, n)
    return mix((run[ends] - run[starts]) * back[starts] + (ends - starts).astype(np.uint64)), at


def windows(words: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``k`` words inside one document, and their n + 1 offsets; a document
    of fewer words, but not none, gives its whole sequence."""
    n = len(words)
    counts = np.diff(at)
    full = np.zeros(max(n - k + 1, 0), np.uint64)
    power = 1
    for j in range(k):
        full += words[j : j + len(full)] * U(power)
        power = power * 0xA24BAED4963EE407 % (1 << 64)
    full = mix(full)
    per = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    out_at = np.concatenate([[0], np.cumsum(per)])
    out = np.empty(out_at[-1], np.uint64)
    doc = np.repeat(np.arange(len(counts)), per)
    place = np.arange(len(out)) - out_at[doc] + at[doc]
    whole = counts[doc] >= k
    out[whole] = full[place[whole]]
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        out[out_at[i]] = short_hash(words[at[i] : at[i + 1]])
    return out, out_at


def short_hash(words: np.ndarray) -> np.uint64:
    total, power = len(words) * 0x9FB21C651E98DF25, 1
    for w in words.tolist():
        total = (total + w * power) % (1 << 64)
        power = power * 0xA24BAED4963EE407 % (1 << 64)
    return mix(np.array([total], np.uint64))[0]


def word_and_beginning_hashes(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """For each word its hash and those of its first bytes, one for each of ``lengths`` (shorter
    words whole; never the same as a word's own hash), and n + 1 offsets of the documents."""
    starts, ends, at = spans(raw, offsets, inside)
    if not len(starts):
        return np.empty(0, np.uint64), at
    n, each = len(raw), len(lengths) + 1
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _powers(_P, n), out=run[1:])
    back = _powers(_P_INV, n)[starts]
    out = np.empty(each * len(starts), np.uint64)
    out[0::each] = mix((run[ends] - run[starts]) * back + (ends - starts).astype(np.uint64))
    for k, length in enumerate(lengths, 1):
        cut = np.minimum(starts + length, ends)
        out[k::each] = mix((run[cut] - run[starts]) * back ^ U(0x5851F42D4C957F2D * k % (1 << 64)))
    return out, at * each
