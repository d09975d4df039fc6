"""Line frequency and base counts against a plain version; limits, copies and removed lines."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from dimforge.config import Settings
from dimforge.llm import line_quality as lq

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def norm(line):
    return " ".join(WORD.findall(line)).translate(LOWER)


def plain_counts(text):
    words = WORD.findall(text)
    held = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(held) - len(set(held)), len(inside))


def plain(rows, limits=lq.Limits()):
    """(doc_id, counts..., base_failed, kept, words_left) of rows (doc_id, text, source)."""
    texts = defaultdict(set)
    for _, t, s in rows:
        texts[s].add(t or "")
    n_docs = Counter((s, line) for s, held in texts.items() for t in held for line in {norm(x) for x in t.split("\n")} - {""})
    out = []
    for i, t, s in rows:
        t = t or ""
        common = [x for x in t.split("\n") if n_docs[s, norm(x)] > limits.least_docs and n_docs[s, norm(x)] > limits.share * len(texts[s])]
        counts = plain_counts(t)
        left = counts[0] - sum(len(WORD.findall(x)) for x in common)
        base = counts[0] < limits.least_words or 100 * counts[4] > 20 * counts[0]
        out.append((i, *counts, base, not base and left >= limits.least_words and left >= limits.least_left * counts[0], left))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c", b"dd"]), max_size=40), max_size=6))
@settings(max_examples=150, deadline=None)
def test_repeated_words_equal_a_plain_count(texts):
    want = [plain_counts(b" ".join(t).decode())[4] for t in texts]
    assert lq.repeated_words(texts).tolist() == want


def test_equal_hashes_of_other_words_are_told_apart(monkeypatch):
    texts = [[b"%d" % (i % 40) for i in range(400)], [b"x%d" % i for i in range(300)]]
    real, calls = lq._equal_neighbours, []

    def collide(parts, order):
        calls.append(len(parts))
        return np.ones(len(order) - 1, dtype=bool) if len(parts) == 1 else real(parts, order)

    monkeypatch.setattr(lq, "_equal_neighbours", collide)
    assert lq.repeated_words(texts).tolist() == [400, 0]
    assert calls[-1] > 1 and len(calls) == 3


def made_rows(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé中#") for _ in range(rng.randint(2, 7)))
    bars = ["Share this  page  NOW", "terms of use apply to all of this text here", "home | about | contact"]
    rows = []
    for i in range(700):
        lines = [" ".join(word() for _ in range(rng.randint(3, 9))) for _ in range(rng.randint(1, 6))]
        for bar in bars:
            if rng.random() < 0.15:
                lines.insert(rng.randrange(len(lines) + 1), rng.choice([bar, bar.upper(), "\t" + bar.lower() + " \r"]))
        if rng.random() < 0.1:
            lines += lines[:1]
        rows.append((i, "\n".join(lines), rng.choices(["big", "mid", None, "tiny"], [60, 30, 8, 2])[0]))
    rows += [(2000 + i, bars[1], "big") for i in range(30)] + [(3000 + i, f"{bars[1]}\n{bars[0]}\nmore {i}", "big") for i in range(9)]
    rows += [(4000 + i, "one text that stands here in very many exact copies of itself alone", "big") for i in range(300)]
    return rows + [(1, rows[1][1], rows[1][2]), (None, None, None), (None, "", "mid"), (9, "\n\t \n", "mid"), (10, "ab cd ef gh " * 900, "big")]


def test_verdicts_equal_a_plain_version(docs_of):
    rows = made_rows()
    docs = docs_of([(i, t, "en", s) for i, t, s in rows]).repartition(5)
    assert got(lq.verdicts(docs)) == plain(rows)
    strict = lq.Limits(least_docs=2, share=0.0, least_words=3, least_left=0.8)
    result = got(lq.verdicts(docs, strict))
    assert result == plain(rows, strict)
    assert 50 < sum(r[7] for r in result) < len(rows) - 50


def test_exact_copies_are_one_document_and_hosts_count_apart(docs_of):
    text = "a line of words that is held by all of the copies here\nand a second one that they hold as well"
    rows = [(i, text, "en", "h") for i in range(200)]
    rows += [(1000 + i, f"shared line in two hosts\nbut each has ten more words of its own {i} a b c d e f", "en", "xy"[i % 2]) for i in range(10)]
    assert all(r.kept for r in lq.verdicts(docs_of(rows)).collect())
    one_host = [(i, t, lang, "x") for i, t, lang, _ in rows[200:]]
    assert all(r.words_left == r.n_words - 5 for r in lq.verdicts(docs_of(one_host)).collect())


def test_cleaned_texts_lose_the_common_lines_only(docs_of):
    rows = [(i, f"Menu  and LOGIN\nline {i} has more than ten words in it so that it stays here\n\nmenu and login", "en", "h") for i in range(20)]
    rows += [(50, "menu and login\nmenu and login\nmenu and login\nmenu and login", "en", "h"), (51, None, "en", "h")]
    texts = {r.doc_id: r.text for r in lq.cleaned(docs_of(rows)).collect()}
    assert texts == {i: f"line {i} has more than ten words in it so that it stays here\n" for i in range(20)}


def test_joins_beyond_the_broadcast_bound_give_the_same(docs_of, monkeypatch):
    rows = made_rows(8)
    docs = docs_of([(i, t, "en", s) for i, t, s in rows])
    monkeypatch.setattr(lq, "_SMALL", Settings(broadcast_max_rows=0))
    assert got(lq.verdicts(docs)) == plain(rows)


def test_empty_table_and_clashing_names(empty_docs, docs_of, with_clashes):
    assert lq.verdicts(empty_docs).count() == 0 and lq.cleaned(empty_docs).count() == 0
    docs = docs_of([(1, "a b c d e f g h i j k l", "en", None), (2, None, "en", "s")])
    assert got(lq.verdicts(with_clashes(docs, "host", "key", "line", "lines", "words", "kept"))) == got(lq.verdicts(docs))
