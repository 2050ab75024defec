"""Reply trees and the chat template, against plain Python versions."""

from __future__ import annotations

import hashlib
import random

import pytest

from ledgerloom.llm import chat

PIECES = ["<|im_end|>", "<|im_end|>\n", "<|im_start|>", "<|im_sep|>", "</s>[INST] ok [/INST]", "\\", "\\\\<\\|im_end|>", "<", "<|im_end|", "<<SYS>>", "<<<SYS>>", "é€😀", "\n", "word ", ""]
SCHEMA = "tree long, node long, parent long, role string, text string, score double, branch string, spans int"


def escape(text):
    text = text.replace("\\", "\\\\")
    for c in chat.CONTROL:
        text = text.replace(c, c[0] + "\\" + c[1:])
    return text


def unescape(text):
    out, i = [], 0
    while i < len(text):
        i += text[i] == "\\"
        out.append(text[i])
        i += 1
    return "".join(out)


def paths(rows, best):
    """{(tree, leaf): (branch, nodes)} of the chosen branches; rows are (tree, node, parent, role, text, score)."""
    trees = {}
    for tree, node, parent, role, text, score, *_ in sorted(rows, key=lambda r: (r[2] is not None, r[2], r[3] is not None, r[3] or "", r[4] is not None, r[4] or "", r[5] or 0.0), reverse=True):
        if node is not None:
            trees.setdefault(tree, {})[node] = (parent, role or "", text or "", score or 0.0)
    out = {}
    for tree, nodes in trees.items():
        parents = {p for p, *_ in nodes.values()}
        found = []
        for leaf in nodes:
            path, at = [], leaf
            while at in nodes and at not in path:
                path.append(at)
                at = nodes[at][0]
            if leaf in parents or at in path:
                continue
            found.append((-sum(nodes[n][3] for n in path) / len(path), -len(path), leaf, path[::-1]))
        for branch, (_, _, leaf, path) in enumerate(sorted(found)[:best], 1):
            out[tree, leaf] = (branch, [nodes[n] for n in path])
    return out


def hold(spark, rows, best):
    template = chat.ChatTemplate()
    got = chat.format_trees(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), template, best).collect()
    want = paths(rows, best)
    assert {(r["tree"], r["leaf"]): r["branch"] for r in got} == {k: b for k, (b, _) in want.items()}
    for r in got:
        turns = want[r["tree"], r["leaf"]][1]
        assert r["text"] == "".join(f"<|im_start|>{escape(role)}<|im_sep|>{escape(text)}<|im_end|>\n" for _, role, text, _ in turns)
        assert [unescape(r["text"][s["start"] : s["end"]]) for s in r["spans"]] == [text for _, _, text, _ in turns]
        assert [s["loss"] for s in r["spans"]] == [role == "assistant" for _, role, _, _ in turns]


@pytest.mark.parametrize("best", [1, 3])
def test_trees_against_plain_python(spark, best):
    rng = random.Random(best)
    rows = []
    for tree in (1, 2, None):
        for node in range(60):
            parent = rng.choice([None, node - 1, rng.randrange(node)]) if node else None
            text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(5)))
            rows.append((tree, node, parent, rng.choice(["user", "assistant", None, "<|im_sep|>\n"]), rng.choice([text, None]), rng.choice([None, 0.5, 1.0, -2.0])))
    hold(spark, rows, best)


def test_odd_trees(spark):
    rows = [
        (1, 1, 99, "user", "its parent is missing", 1.0),
        (2, 1, 2, "user", "a circle", 1.0), (2, 2, 1, "assistant", "of two", 1.0), (2, 3, 2, "user", "and one that hangs on it", 1.0),
        (3, 1, None, "user", "first", 1.0), (3, 1, None, "user", "a node twice", 1.0), (3, 2, 1, "assistant", "below", 1.0),
        (4, None, None, "user", "no node", 1.0),
        (5, 1, 1, "user", "replies to itself", 1.0),
    ]
    hold(spark, rows, 2)
    assert chat.format_trees(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_long_thread_and_many_branches(spark):
    """A third of all rows in one thread, deeper than one block and not a power of two."""
    deep = [(1, n, n - 1 if n else None, "assistant" if n % 2 else "user", f"{n}\\", 1.0) for n in range(1500)]
    wide = [(2, n, 0 if n else None, "user", "é" * (n % 7), float(n % 5)) for n in range(400)]
    hold(spark, deep + wide, 4)
    every = chat.format_trees(spark.createDataFrame([(*r, "x", 1) for r in wide], SCHEMA), best=None)
    assert every.count() == 399


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_report_of_odd_conversations(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(["".join(rng.choices(PIECES, k=4)), None, ""]), 1, "x") for c in (1, 2, 3) for t in rng.sample([None, -5, 0, 1, 2, 300, 70000, 2**40], 6)]
    rows += [(None, t, "assistant", "no id", 1, "x") for t in (2, 1)] + [(8, 1, "user", b, 1, "x") for b in ("b", "a", "a")]
    rows += [(9, 0, "assistant", "long " * 100_000, 1, "x")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node long, tree string")
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    want = {}
    for conv, some in by.items():
        some.sort(key=lambda r: (r[1] is not None, r[1], r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in some]
        under = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"<|im_start|>{escape(role)}<|im_sep|>{escape(text)}<|im_end|>\n" for role, text in turns)
        want[conv] = (len(turns), digest("".join(f"{role}\n{text}\n" for role, text in turns)), len(under), digest(under), len(whole))
    assert {r[0]: tuple(r)[1:] for r in chat.report(given).collect()} == want
    assert chat.report(given.limit(0)).collect() == []


def test_a_span_that_does_not_fit_fails(spark):
    row = [(1, 1, "<|im_start|>user<|im_sep|>text<|im_end|>\n", [(22, 25, True)])]
    wrong = spark.createDataFrame(row, "tree long, leaf long, text string, spans array<struct<start:long,end:long,loss:boolean>>")
    with pytest.raises(Exception, match="a span doesn't fit"):
        chat.read_back(wrong).collect()
