"""Token counts, mixing and bottom-k fingerprints against plain versions."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from dimforge.llm import fingerprints, mixing, token_counts


# -------------------------------------------------------------- token counts
def unigram(pieces, fused=True):
    t = Tokenizer(models.Unigram([("<unk>", 0.0)] + pieces, unk_id=0))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_library_on_public_pieces():
    pieces = token_counts.vocabulary()
    count, want = token_counts.Counter(pieces), unigram(pieces)
    rng = random.Random(2)
    letters = "ab theé中😀😁  \n▁.xyz"
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 16)))
        assert count(text) == want(text), repr(text)


def test_ties_and_unknowns_follow_the_library():
    rng = random.Random(3)
    for _ in range(150):
        made = {"".join(rng.choice("ab▁") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 9))}
        pieces = [(p, float(-rng.randint(1, 3))) for p in sorted(made)]
        count, want = token_counts.Counter(pieces), unigram(pieces)
        for _ in range(40):
            text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 12)))
            assert count(text) == want(text), (pieces, text)


def test_token_count_edge_cases(edge_docs, empty_docs, with_clashes):
    want = unigram(token_counts.vocabulary())
    got = token_counts.token_counts(with_clashes(edge_docs, "n_tokens", "n")).collect()
    texts = defaultdict(set)
    for d in edge_docs.collect():
        texts[d.doc_id].add(want(d.text) if d.text else 0)
    assert len(got) == edge_docs.count() and all(r.n_tokens in texts[r.doc_id] for r in got)
    assert token_counts.token_counts(empty_docs).count() == 0


# -------------------------------------------------------------------- mixing
def plain_targets(sizes):
    names = sorted([s for s in sizes if s is not None], key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / sum(weight[f] for f in free) for s in names}
        above = {s for s in free if target[s] > 3 * sizes[s]}
        if not above:
            return target
        capped |= above


def mix_rows(n, seed):
    rng = random.Random(seed)
    sources = ["b", "a", "Z", "é", "\U00010000", "￿", None, "tiny"]
    return [(i, " ".join("w" * rng.randint(1, 5) for _ in range(int(rng.paretovariate(1.2) * 8))), "en",
             rng.choices(sources, [60, 5, 9, 9, 6, 6, 4, 1])[0]) for i in range(n)]


def test_targets_and_copies(spark, docs_of):
    rows = mix_rows(1500, 1)
    size = {i: len(t.split()) for i, t, *_ in rows}
    per_source = defaultdict(int)
    for i, _, _, s in rows:
        per_source[s] += size[i]
    want = plain_targets(per_source)
    assert any(abs(want[s] - 3 * per_source[s]) < 1e-6 for s in want)
    got = mixing.mixture(docs_of(rows).repartition(3)).collect()
    source = {i: s for i, _, _, s in rows}
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == per_source[s]
        assert r.target == pytest.approx(want[s], rel=1e-9)
        rate = want[s] / per_source[s]
        copies = r.taken / r.size if r.size else 0
        assert copies in (int(rate + 1e-12), int(rate + 1e-12) + 1) or abs(copies - rate) < 1e-9
        assert r.taken <= 3 * r.size
        taken[s] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.03 * t, max(size[i] for i in source if source[i] == s))
    again = mixing.mixture(docs_of(rows).repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mix_emits_the_copies(docs_of):
    docs = docs_of(mix_rows(300, 2))
    taken = {r.doc_id: r.taken for r in mixing.mixture(docs).collect()}
    out = mixing.mix(docs)
    words = defaultdict(int)
    for r in out.collect():
        words[r.doc_id] += len((r.text or "").split())
    assert out.columns == docs.columns
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in words.items() if v}


def test_words_are_runs_of_other_characters(spark):
    df = spark.createDataFrame([("a b",), (" \t\x0b\x0ca\r\nb ",), ("a\u00a0b\u3000c\x1cd\x85e",), ("",), (None,)], "text string")
    assert [r[0] for r in df.select(mixing.word_count(F.col("text"))).collect()] == [2, 2, 1, 0, 0]


def test_mixing_edge_cases(spark, edge_docs, empty_docs, with_clashes):
    docs = with_clashes(edge_docs, "size", "target", "rate", "seed", "copies", "place", "weight", "cap", "text_hash", "_mix_copies_")
    got = mixing.mixture(docs).collect()
    assert len(got) == edge_docs.count() and all(r.taken <= 3 * r.size for r in got)
    assert mixing.mixture(empty_docs).count() == mixing.mix(empty_docs).count() == 0
    blank = edge_docs.withColumn("text", F.lit(" "))
    assert {(r.target, r.taken) for r in mixing.mixture(blank).collect()} == {(0.0, 0)}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns


# -------------------------------------------------------------- fingerprints
def shingles(text, k=5):
    out = (text or "").lower()
    for c in "\t\n\x0b\x0c\r":
        out = out.replace(c, " ")
    words = [w for w in out.split(" ") if w]
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def edits(rows):
    out = {}
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        out[i] = t[:len(t) - half] + after[:half]
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("per_range", [2000, 9])
def test_fingerprints_of_edited_texts(spark, docs_of, monkeypatch, per_range):
    rng = random.Random(8)
    vocabulary = ["w%d" % i for i in range(400)] + ["É", "straße", "😀"]
    rows = [(3 * i + 1, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 9, 80, 500])))) for i in range(70)]
    rows[10] = (rows[10][0], rows[9][1])
    inner = fingerprints.with_next
    monkeypatch.setattr(fingerprints, "with_next", lambda *a, **k: inner(*a, **{**k, "per_range": per_range}))
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs_of(rng.sample(rows, len(rows))).repartition(4)).collect()}
    edited, text = edits(rows), dict(rows)
    order = [i for i, _ in rows]
    for at, i in enumerate(order):
        r, after = got[i], text[order[(at + 1) % len(order)]]
        assert r.n_chars == len(text[i])
        assert r.edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest()
        own = shingles(text[i])
        assert len(r.fingerprint) == 16 * min(len(own), fingerprints.K)
        near = 0.2 if len(own) > fingerprints.K else 1e-9
        assert abs(r.near_edited - jaccard(own, shingles(edited[i]))) <= near + (0.2 if len(shingles(edited[i])) > fingerprints.K else 0)
        assert abs(r.near_next - jaccard(own, shingles(after))) <= near + (0.2 if len(shingles(after)) > fingerprints.K else 0)
        assert abs(r.distinct_shingles - len(own)) <= 0.4 * len(own)
    same = defaultdict(set)
    for i, r in got.items():
        same[text[i]].add(r.fingerprint)
    assert all(len(x) == 1 for x in same.values())


def test_sketches_of_parts_merge(spark):
    rng = random.Random(9)
    words = [str(rng.randint(0, 500)) for _ in range(1500)]
    overlap = 4  # parts share the words of shingles that cross the cut
    parts = [(1, " ".join(words[a:a + 500 + overlap])) for a in (0, 500, 1000)]
    df = spark.createDataFrame(parts, "k int, text string").select("k", fingerprints.sketch(F.col("text")).alias("s"))
    whole = spark.createDataFrame([(" ".join(words),)], "text string").select(fingerprints.sketch(F.col("text"))).first()[0]
    assert fingerprints.merge_sketches(df, "k", "s").first()["s"] == whole


def test_containment(spark):
    rng = random.Random(10)
    a = [str(rng.randint(0, 10**6)) for _ in range(300)]
    b = a + [str(rng.randint(0, 10**6)) for _ in range(900)]
    df = spark.createDataFrame([(" ".join(a), " ".join(b))], "a string, b string").select(
        fingerprints.sketch(F.col("a")).alias("a"), fingerprints.sketch(F.col("b")).alias("b"))
    inside, outside = df.select(fingerprints.containment(F.col("a"), F.col("b")), fingerprints.containment(F.col("b"), F.col("a"))).first()
    assert inside > 0.7 and 0.1 < outside < 0.4


def test_fingerprint_edge_cases(edge_docs, empty_docs, docs_of, with_clashes):
    got = fingerprints.fingerprint_documents(with_clashes(edge_docs, "fingerprint", "range", "next_text", "edited", "first")).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprints.fingerprint_documents(empty_docs).count() == 0
    alone = fingerprints.fingerprint_documents(docs_of([(7, "abcd")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and alone.near_next == 1.0


def test_main_path_has_no_python(docs_of):
    plan = fingerprints.fingerprint_documents(docs_of([(1, "a b"), (2, "c")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
