"""Fill-in-middle: the offset set against plain lists, cuts against a plain version, exact round trips."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimforge.llm import fill_middle, roaring


@given(st.sets(st.integers(0, 300_000), max_size=300))
@settings(max_examples=60, deadline=None)
def test_select_equals_the_sorted_list(values):
    ordered = sorted(values)
    held = roaring.OffsetSet(np.array(ordered, dtype=np.int64))
    assert len(held) == len(ordered)
    assert [held.select(k) for k in range(len(ordered))] == ordered
    for k in (-1, len(ordered)):
        with pytest.raises(IndexError):
            held.select(k)


def test_each_container_is_used_and_selects():
    rng = np.random.default_rng(1)
    cases = {
        roaring.ArrayContainer: np.arange(0, 60_000, 97),
        roaring.BitmapContainer: np.flatnonzero(rng.random(65_536) < 0.5),
        roaring.RunContainer: np.concatenate([np.arange(5, 9000), np.arange(20_000, 65_536)]),
    }
    whole = []
    for i, (kind, low) in enumerate(cases.items()):
        made = roaring.container(low)
        assert isinstance(made, kind)
        assert made.n_bytes <= min(2 * len(low), 8192)
        assert [made.select(k) for k in range(0, len(low), 61)] == low[::61].tolist()
        whole.append(low + (7 * i << 16))
    values = np.concatenate(whole)
    held = roaring.OffsetSet(values)
    assert [type(c) for c in held.containers] == list(cases) and held.cumulative[-1] == len(values)
    assert [held.select(k) for k in range(0, len(values), 53)] == values[::53].tolist()


def plain(doc_id, text, rate=100):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 50 else f"<P>{p}<S>{s}<M>{m}"
    return len(units), "spm" if h4 % 100 < 50 else "psm", len(p), len(m), out


def test_documents_equal_the_plain_version(docs_of, edge_docs):
    texts = ["a\nb\nc", "\n\n\n", "no end", "é\n中文\n😀 tail\r\n\x0b", "has <P> inside\nx", "<", "<S", "P>\n<", "x<P\n>y\nS>M>",
             "l\n" * 70_000, "\n".join("é" * (i % 7) for i in range(3000)), "\x00\n\x1f"]
    rows = [(i * 10 + j, t) for i, t in enumerate(texts) for j in range(6)] + [(None, "a\nb"), (1, "a\nb"), (1, "a\nb")]
    for docs in (docs_of(rows), edge_docs):
        made = fill_middle.fill_middle(docs)
        full = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
        got = sorted((tuple(r) for r in full.collect()), key=repr)
        want = sorted(((r.doc_id, *plain(r.doc_id, r.text), r.text or "") for r in docs.collect()), key=repr)
        assert got == want
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_rate_and_sentinels(docs_of):
    docs = docs_of([(i, f"line {i}\nnext\nlast") for i in range(400)])
    shape = fill_middle.Shape(rate=30, spm=0, prefix="[pre]", suffix="[suf]", middle="[mid]")
    rows = fill_middle.fill_middle(docs, shape).withColumn("back", fill_middle.restored(F.col("output"), F.col("form"), shape)).collect()
    assert {r.form for r in rows} == {"plain", "psm"} and 80 < sum(r.form == "psm" for r in rows) < 160
    assert all(r.back == f"line {r.doc_id}\nnext\nlast" for r in rows)
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("aa", "b", "c"), ("ab", "bc", "x"), ("<P>", "<P>x", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.Shape(prefix=bad[0], suffix=bad[1], middle=bad[2])


def test_empty_table_and_clashing_names(empty_docs, docs_of, with_clashes):
    assert fill_middle.digest(empty_docs).count() == 0
    docs = docs_of([(1, "a\nb"), (2, None)])
    names = ("n", "form", "output", "prefix_chars", "middle_chars", "output_sha256")
    assert sorted(map(tuple, fill_middle.digest(with_clashes(docs, *names)).collect())) == sorted(map(tuple, fill_middle.digest(docs).collect()))
