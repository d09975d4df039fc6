"""Lexical search against scores of all documents; what the bounds spare; the index format."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dimforge.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
ITEM = "item_id bigint, text string"


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_ranks(docs, items, k=10):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    held = [(i, c) for i, t in docs if (c := Counter(plain_terms(t)))]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in plain_terms(text) if c[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=200))
@settings(max_examples=60, deadline=None)
def test_numbers_come_back(values):
    raw, sizes = lexical.pack_numbers(np.array(values, dtype=np.int64))
    assert lexical.unpack_numbers(raw).tolist() == values and int(sizes.sum()) == len(raw)


@given(st.text(st.characters(codec="utf-8"), max_size=60))
@settings(max_examples=200, deadline=None)
def test_terms_equal_the_pattern(text):
    assert [t.decode() for t in lexical.terms(text)] == plain_terms(text)


def corpus(n, seed, words=400):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(rng.choices(names, weights, k=int(5 + rng.paretovariate(1.1) * 8) % 400))) for i in range(n)]


@pytest.mark.parametrize("block,postings", [(2, 50), (128, 4_000_000), (7, 3000)])
def test_ranks_equal_scoring_everything(spark, docs_of, block, postings):
    docs = corpus(600, block) + [(5, "w3 w3 w9"), (5, "w3 w3 w9"), (None, "w3 w3 w9"), (None, None), (900, ""), (901, "...")]
    rng = random.Random(9)
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 3, 30])))) for i in range(25)]
    items += [(3, "w1 w1 W1"), (None, "w3, w9"), (77, None), (78, "nothing here"), (79, "")]
    index = lexical.build_index(docs_of(docs).repartition(3), block, postings)
    assert (index.select("shard").distinct().count() > 3) == (postings < 4_000_000)
    found = lexical.search(index, spark.createDataFrame(items, ITEM), 10, block, most_items=11)
    assert got(found) == plain_ranks(docs, items)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "int", "bigint", "bigint"]


def test_ties_rank_by_doc_id_across_shards(spark, docs_of):
    docs = [(i, "same words here") for i in range(300)] + [(1000 + i, f"other text {i}") for i in range(300)]
    random.Random(1).shuffle(docs)
    index = lexical.build_index(docs_of(docs).repartition(4), 4, 40)
    found = lexical.search(index, spark.createDataFrame([(1, "same words")], ITEM), 10, 4)
    assert [r.doc_id for r in sorted(found.collect(), key=lambda r: r.rank)] == list(range(10))


def shard_of(docs, block):
    shard = lexical._Shard()
    for i, text in docs:
        shard.add(i, lexical.terms(text))
    rows = [tuple(b.column(c)[j].as_py() for c in ("term", "df", "heads", "data"))
            for b in shard.rows("0-0", block) for j in range(b.num_rows)]
    return rows, lexical.Lengths(len(docs), sum(len(t.split()) for _, t in docs))


def test_block_maxima_are_exact():
    docs = corpus(3000, 4)
    rows, lengths = shard_of(docs, 16)
    search = lexical.ShardSearch(iter(rows), lengths, 16)
    for term in ("w0", "w1", "w50", "w300"):
        p = search.posting_list(term)
        p.decompress(np.arange(p.n_blocks))
        assert [p.impacts[a:a + 16].max() for a in range(0, p.df, 16)] == p.maxima.tolist()
        assert p.docs.tolist() == [i for i, t in docs if term in t.split()]


def test_blocks_are_rejected_before_they_are_decompressed():
    rng = random.Random(5)
    docs = [(i, " ".join(["common"] + [f"x{rng.randrange(50)}" for _ in range(20)] + ["rare"] * (i % 997 == 3) + ["common"] * (i % 50 == 0)))
            for i in range(20_000)]
    rows, lengths = shard_of(docs, 128)
    search = lexical.ShardSearch(iter(rows), lengths, 128)
    df = {t: n for t, n, *_ in rows}
    weights = {t: lexical.weight(len(docs), df[t]) for t in ("common", "rare", "x7")}
    at, scores = search.top(weights, 10)
    best = sorted(((int(search.ids[d]), int(s)) for d, s in zip(at, scores)), key=lambda x: (-x[1], x[0]))
    assert [(d, s) for _, _, d, s in sorted(plain_ranks(docs, [(0, "common rare x7")]), key=lambda r: r[1])] == best
    common = search.posting_list("common")
    assert common.known.sum() < common.n_blocks / 2


def test_empty_index_and_clashing_names(spark, empty_docs, docs_of, with_clashes):
    items = spark.createDataFrame([(1, "a b")], ITEM)
    assert lexical.ranked(empty_docs, items).count() == 0
    docs = docs_of([(1, "a b c"), (2, "b")])
    assert lexical.ranked(docs, items.limit(0)).count() == 0
    clashing = lexical.ranked(with_clashes(docs, "term", "shard", "score"), with_clashes(items, "key", "rank", "doc_id"))
    assert got(clashing) == got(lexical.ranked(docs, items)) == plain_ranks([(1, "a b c"), (2, "b")], [(1, "a b")])
