"""Boundary sets and fill-in-the-middle, against plain Python versions."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from ledgerloom.llm import infill
from ledgerloom.llm.boundaries import ARRAY, BITMAP, RUNS, SPAN, BoundarySet

from .conftest import ODD


@pytest.mark.parametrize(
    "kind, values",
    [
        (ARRAY, np.arange(0, SPAN, 97)),
        (BITMAP, np.flatnonzero(np.random.default_rng(1).random(SPAN) < 0.5)),
        (RUNS, np.concatenate([np.arange(5, 9000), np.arange(20000, 60000)])),
        (RUNS, np.arange(SPAN)),
    ],
)
def test_each_container_selects_every_value(kind, values):
    held = BoundarySet(values + 3 * SPAN)
    assert [c[0] for c in held.containers] == [kind]
    assert len(held) == len(values)
    assert [held.select(k) for k in range(len(values))] == (values + 3 * SPAN).tolist()
    with pytest.raises(IndexError):
        held.select(len(values))


def test_several_containers_and_none():
    values = np.unique(np.random.default_rng(2).integers(0, 10 * SPAN, 30_000))
    values = np.concatenate([values[values < 4 * SPAN], np.arange(6 * SPAN - 5, 7 * SPAN + 5), [9 * SPAN]])
    held = BoundarySet(values)
    assert len({c[0] for c in held.containers}) > 1
    some = np.random.default_rng(3).integers(0, len(values), 2000)
    assert [held.select(int(k)) for k in some] == values[some].tolist()
    empty = BoundarySet(np.empty(0, np.int64))
    assert len(empty) == 0 and empty.cuts(0, 0) == (0, 0)


def expected(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    hexes = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexes[i : i + 8], 16) for i in (0, 8, 16, 24))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


def test_against_plain_python(documents):
    rng = random.Random(4)
    alphabet = ["word", "Z", " ", "\n", "é", "ß€", "😀", "1", "<", "P", ">", "<P", "[", "\x00"]
    rows = [(i, "".join(rng.choices(alphabet, k=rng.randrange(40))), "a") for i in range(-20, 600)]
    rows += [(1000, "<S>", "a"), (1001, "a<P>b", "a"), (1002, "x" * 200_000 + " é" * 90_000, "a"), (1003, "a " * 150_000, "a"), (1004, "".join(rng.choices("ab .é", k=300_000)), "a")]
    rows += ODD
    got = sorted((tuple(r) for r in infill.report(documents(rows)).collect()), key=repr)
    want = sorted((expected(r[0], r[1]) for r in rows), key=repr)
    assert got == want
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_outputs_and_an_empty_table(documents):
    how = infill.Infill(prefix="<a>", suffix="<b>", middle="<c>", plain_percent=0, suffix_first_percent=100)
    got = infill.transform(documents([(1, "one two, three", "s")]), how).first()
    assert got["form"] == "spm" and re.fullmatch(r"(?s)<b>(.*)<a>(.*)<c>(.*)", got["output"])
    assert infill.report(documents([])).collect() == []
