"""Language and toxicity: held-out accuracy, codes, and edge cases."""

import random
import zlib

import numpy as np
import pytest
from conftest import SMALL_SF
from pyspark.sql import functions as F

from dimforge.llm import langid, toxicity

WORDS = {"en": "the house and a green river with many old friends under this tree".split(),
         "de": "das haus und ein gruener fluss mit vielen alten freunden unter diesem baum".split(),
         "fr": "la maison et une riviere verte avec beaucoup de vieux amis sous cet arbre".split()}


def prose(lang, n, rng):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", ","]) for _ in range(n))


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 9, 40):
        code = langid.codewords(n)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= 1 and (n < 4 or min(apart) >= 3)
        assert all(abs(code[:, b].sum()) < n for b in range(code.shape[1]))


def test_one_wrong_bit_is_outvoted():
    code = langid.codewords(5)
    model = langid.Model(tuple("abcde"), code, np.zeros((langid.SLOTS, code.shape[1]), np.float32), np.ones(code.shape[1]))
    for row in range(5):
        for bit in range(code.shape[1]):
            margins = 4 * code[row].copy()
            margins[bit] *= -1
            loss = (np.logaddexp(0.0, -code * margins) * model.trust).sum(axis=1)
            assert loss.argmin() == row


def test_languages_of_held_out_documents(spark, docs_of):
    rng = random.Random(1)
    rows = [(i, prose(lang, rng.randint(1, 60), rng), lang if rng.random() < 0.9 else None, "s")
            for i in range(600) for lang in [rng.choice(list(WORDS))]]
    truth = {}
    for i, (doc_id, text, lang, _) in enumerate(rows):
        truth[doc_id] = next(k for k in WORDS if set(text.replace(",", "").split()) <= set(WORDS[k])) if lang is None else lang
    got = langid.identified(docs_of(rows)).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_predictions_use_the_text_alone(spark, docs_of):
    rng = random.Random(2)
    rows = [(i, prose(lang, 30, rng), lang, "s") for i in range(300) for lang in [rng.choice(list(WORDS))]]
    a = {r.doc_id: (r.lang_pred, r.score) for r in langid.identified(docs_of(rows)).collect()}
    # held-out documents under other labels and sources
    swapped = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, "other") for i, t, lang, _ in rows]
    b = {r.doc_id: (r.lang_pred, r.score) for r in langid.identified(docs_of(swapped)).collect()}
    assert a == b


def test_language_edge_cases(spark, edge_docs, empty_docs, docs_of, with_clashes):
    none = langid.identified(edge_docs).collect()
    assert len(none) == edge_docs.count() and {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    one = langid.identified(with_clashes(edge_docs.withColumn("lang", F.lit("xx")), "score", "slot", "n", "held_out")).collect()
    by_id = {r.doc_id: r for r in one}
    assert by_id[0].lang_pred == by_id[1].lang_pred == by_id[2].lang_pred == "und"
    assert by_id[4].lang_pred == by_id[10].lang_pred == "xx"
    assert not langid.has_letter("12 34 !? ٣") and langid.has_letter("中") and langid.has_letter("1a")
    assert langid.identified(empty_docs).count() == 0
    kept = langid.keep_identified(docs_of([(1, "12 34", "en"), (2, "the house", "en"), (3, None, "en"), (7, "a tree", "en")]))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7] and kept.columns == edge_docs.columns


def test_whole_texts_count_in_chunks():
    text = "abc def " * 40_000
    whole = sum(len(s) for s in langid.gram_slots(text))
    raw = len(text) + 2
    assert whole == sum(raw - order + 1 for order in (2, 3, 4))


# ------------------------------------------------------------------ toxicity
NASTY = ["grumblefitz", "snorklewad", "bloatwick"]


def toxic_set(n, rng):
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice("ta re mo li ku ne so pa".split()) + rng.choice("ren dal mit sor vek".split()) for _ in range(rng.randint(5, 120))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(1 + len(words) // 40):
                words.insert(rng.randrange(len(words) + 1), rng.choice(NASTY) + rng.choice(["", ".", ","]))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


LABELS = "doc_id bigint, quality int, toxic int"


def test_toxicity_of_held_out_documents(spark, docs_of):
    docs, labels = toxic_set(900, random.Random(4))
    got = toxicity.scored(docs_of(docs), spark.createDataFrame(labels, LABELS)).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in docs if zlib.crc32(str(i).encode()) % 3 == 1}
    assert all((r.score >= 0.7) == (r.predicted == 1) and 0 <= r.score <= 1 for r in got)
    toxic = [r for r in held if truth[r.doc_id]]
    clean = [r for r in held if not truth[r.doc_id]]
    assert np.mean([r.predicted for r in toxic]) > 0.9 and np.mean([r.predicted for r in clean]) < 0.02


def test_toxicity_on_the_test_tables(spark):
    read = lambda t: spark.read.parquet(f"{SMALL_SF.replace('0.001', '0.01')}/{t}.parquet")
    labels = {r.doc_id: r.toxic for r in read("labels").collect()}
    held = [r for r in toxicity.scored(read("documents"), read("labels")).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted for r in held if labels[r.doc_id]]) >= 0.5
    assert np.mean([r.predicted for r in held if not labels[r.doc_id]]) <= 0.03


def test_toxicity_edge_cases(spark, edge_docs, empty_docs, docs_of, with_clashes):
    none = spark.createDataFrame([], LABELS)
    got = toxicity.scored(with_clashes(edge_docs, "score", "hits", "toxic", "words", "importance"), none).collect()
    assert len(got) == edge_docs.count() and {(r.score, r.predicted) for r in got} == {(0.0, 0)}
    assert toxicity.scored(empty_docs, none).count() == toxicity.drop_toxic(empty_docs, none).count() == 0
    odd = spark.createDataFrame([(1, 1, None), (None, 1, 1), (2, 0, 1), (2, 0, 0), (999, 1, 1), (5, 1, 0)], LABELS)
    again = toxicity.scored(edge_docs, odd).collect()
    assert len(again) == edge_docs.count() and all(0 <= r.score <= 1 for r in again)
    texts = {}
    for r, d in zip(sorted(again, key=lambda r: str(r.doc_id)), sorted(edge_docs.collect(), key=lambda d: str(d.doc_id))):
        assert r.doc_id == d.doc_id
    kept = toxicity.drop_toxic(edge_docs, none)
    assert kept.count() == edge_docs.count() and kept.columns == edge_docs.columns


def test_windows_are_whole_texts_and_bounded():
    assert toxicity.windows("A b\tC\nd") == [b"a", b"b", b"c", b"d"]
    long = toxicity.windows("q" * 1000)
    assert b"".join(long) == b"q" * 1000 and max(map(len, long)) == 256
    assert toxicity.windows(None) == toxicity.windows(" \n") == []


def test_short_windows_tell_the_dictionaries_apart():
    model = toxicity.Model(b" ordinary words of a plain text " * 20, b" scum  idiot  moron " * 20)
    lengths = toxicity.Lengths(model)
    for word in (b"scum", b"idiot", b"moron"):
        ordinary, toxic = lengths(word)
        assert toxic < ordinary
    ordinary, toxic = lengths(b"ordinary")
    assert ordinary < toxic


@pytest.mark.parametrize("text", ["", "x", "scum " * 50_000])
def test_any_length_scores(text):
    model = toxicity.Model(b" plain ", b" scum ", 2, 0.5, (-3.0, 1.0, 1.0))
    assert 0 <= toxicity.Scorer(model).score(text) <= 1


def recall_and_false_flags(spark, docs_of, docs, labels):
    truth = {i: t for i, _, t in labels}
    held = [r for r in toxicity.scored(docs_of(docs), spark.createDataFrame(labels, LABELS)).collect() if r.held_out]
    return (np.mean([r.predicted for r in held if truth[r.doc_id]]), np.mean([r.predicted for r in held if not truth[r.doc_id]]))


def plain_words(rng, n):
    return [rng.choice("ta re mo li ku ne so pa".split()) + rng.choice("ren dal mit sor vek".split()) for _ in range(n)]


def test_phrases_of_ordinary_words_are_toxic(spark, docs_of):
    rng, docs, labels = random.Random(6), [], []
    for i in range(900):
        words, toxic = plain_words(rng, rng.randint(20, 100)), i % 3 == 0
        at = rng.randrange(len(words) - 6)
        if toxic:
            words[at:at] = rng.choice(["taren momit kusor", "nevek soren lidal"]).split()
        else:  # the same words, apart
            words[at:at] = ["taren", "pamit", "momit", "redal", "kusor"]
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    recall, flags = recall_and_false_flags(spark, docs_of, docs, labels)
    assert recall > 0.9 and flags < 0.03


def test_toxic_words_in_runs_without_spaces(spark, docs_of):
    rng, docs, labels = random.Random(8), [], []
    for i in range(900):
        words, toxic = plain_words(rng, rng.randint(20, 150)), i % 3 == 0
        if toxic:
            words.insert(rng.randrange(len(words) + 1), rng.choice(NASTY))
        docs.append((i, "".join(words)))
        labels.append((i, 1, int(toxic)))
    recall, flags = recall_and_false_flags(spark, docs_of, docs, labels)
    assert recall > 0.9 and flags < 0.03


def test_wide_windows_overlap():
    line = b" " + b" ".join(toxicity.windows(text := " ".join(map(str, range(300))))) + b" "
    wide = toxicity.wide_windows(text)
    half = toxicity.WIDE // 2
    assert all(any(line[i:i + half] in w for w in wide) for i in range(len(line) - half + 1))
    assert toxicity.wide_windows(None) == [] and toxicity.wide_windows("a") == [b" a "]


def test_thinned_classes_keep_their_shares(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(" ".join(plain_words(rng, 20)), int(i % 10 == 0), 2.0 if i % 10 else 1.0) for i in range(2000)]
    sample = spark.createDataFrame(rows, "text string, toxic int, importance double")
    monkeypatch.setattr(toxicity, "learn", lambda docs: docs)
    docs = toxicity.fit(sample, windows_each=6000)  # of the ordinary about a sixth, of the toxic all
    weight = {label: sum(d[3] for d in docs if d[2] == label) for label in (0, 1)}
    assert len([d for d in docs if not d[2]]) < 600 and weight[1] == 200
    assert abs(weight[0] / 3600 - 1) < 0.2


def plain_score(model, text):
    """The score by its definition: every word and phrase compressed where it stands."""
    words = toxicity.windows(text)
    lengths, wide = toxicity.Lengths(model), toxicity.Lengths(model, (model.ordinary, model.ordinary + model.stretches))
    hits = sum(o - t >= model.saved and o - t >= model.share * o for o, t in map(lengths, words))

    def held(word):
        padded = b" " + word + b" "
        return any(padded[i:i + 5] in model.stretches for i in range(max(1, len(padded) - 4)))

    parts = [words[i:i + k] for k in (2, 3, 4) for i in range(len(words) - k + 1)]
    phrase = max([0, *(wide.saved(b" ".join(p)) for p in parts if all(map(held, p)))])
    run = max([0, *(wide.saved(w) for w in toxicity.wide_windows(text) if any(len(x) > 24 for x in w.split()))])
    beyond = [max(0.0, phrase - model.least[0]), max(0.0, run - model.least[1])]
    x = [1.0, np.log1p(hits), np.log1p(1000 * hits / max(len(words), 30)), *np.log1p(beyond)]
    return 1 / (1 + np.exp(-np.clip(np.dot(x, model.weights), -50, 50)))


def test_scores_equal_a_plain_version(monkeypatch):
    ordinary = b" ".join(w.encode() for w in plain_words(random.Random(1), 900))
    model = toxicity.Model(ordinary, b" grumblefitz  snorklewad  bloatwick " * 9, 3, 0.4, (-4.0, 1.5, 0.4, 0.9, 0.7),
                           b" taren momit kusor  nevek soren lidal  grumblefitz ", (2.0, 3.0))
    rng = random.Random(3)
    monkeypatch.setattr(toxicity, "_MEMO", 4000)  # memos start anew many times
    scorer, seen = toxicity.Scorer(model), set()
    for i in range(200):
        words = plain_words(rng, rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            words.insert(rng.randint(0, len(words)), rng.choice([*NASTY, "taren momit", "momit kusor nevek soren", "x" * 300, "é中😀", "a", "q" * 25]))
        text = rng.choice([" ", "\n", "\t "]).join(words) if i % 5 else "".join(words)
        got = scorer.read(text)
        seen.add((got[0] > 0, got[2] > 0, got[3] > 0))
        assert abs(scorer.scored(*got) - plain_score(model, text)) < 1e-12, text
    assert len(seen) >= 6


@pytest.mark.parametrize("size", [5, 8])
def test_ngrams_of_lines_of_any_length(size):
    for n in range(3 * size):
        raw = bytes(range(1, n + 1))
        got = toxicity._numbers(np.frombuffer(raw, dtype=np.uint8), size).tolist()
        assert got == [int.from_bytes(raw[i:i + size], "little") for i in range(n - size + 1)], n


def test_short_texts_are_learned_from(spark, docs_of):
    """Labelled texts whose line is shorter than an n-gram, of both classes, beside longer ones."""
    docs, labels = toxic_set(900, random.Random(4))
    short = ["De.", "Ere.", "a", "ab", "a b", "é", "中", "12345", "123456", "", None]
    docs += [(1000 + i, short[i % len(short)]) for i in range(110)]
    labels += [(1000 + i, 1, i % 2) for i in range(110)]
    docs, labels = docs_of(docs), spark.createDataFrame(labels, LABELS)
    learned = toxicity.labelled_sample(docs, labels)
    assert {len(toxicity.line_of(r.text)) for r in learned.collect()} >= {0, 3, 4, 5, 6, 7, 8}
    scores = {r.doc_id: r.score for r in toxicity.scored(docs, labels).collect()}
    assert len(scores) == 1010
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, labels).collect()}
    assert kept == {i for i, score in scores.items() if score < 0.7}


def test_documents_without_words_are_learned_from():
    empty = [toxicity.Document([], np.zeros(0, dtype=np.int64), label, 1.0, b"") for label in (0, 1) * 5]
    assert toxicity.Scorer(toxicity.learn(empty)).score("some text") == pytest.approx(0.5)


def test_stretches_are_told_by_documents_that_hold_them():
    rng, docs = random.Random(5), []
    for i in range(300):
        words, toxic = plain_words(rng, 40), i % 3 == 0
        words[9:9] = ["taren", "momit", "kusor"] if toxic else ["taren", "pamit", "momit", "redal", "kusor"]
        line = toxicity.line_of(" ".join(words))
        held = sorted(set(toxicity.windows_of(line)))
        docs.append(toxicity.Document(held, np.array([line.split().count(w) for w in held]), int(toxic), 1.0, line))
    whole = toxicity.GramCounts.of(docs)
    assert whole.nt == 100 and whole.no == 200
    at = int(np.flatnonzero(whole.grams == toxicity.line_grams(b"momit kusor")[0])[0])
    assert whole.toxic[at] == sum(b"momit ku" in d.line for d in docs if d.label)
    assert whole.ordinary[at] == sum(b"momit ku" in d.line for d in docs if not d.label)
    stretches = toxicity.distinctive_stretches(docs, whole, 4.5)
    assert b"momit kusor" in stretches or b"taren momit" in stretches
    assert len(stretches) <= toxicity._STRETCHES


def plain_language(rows):
    """{doc_id: (language, score)} by counting every n-gram one after another; rows (doc_id, text, lang)."""
    slots = langid.SLOTS.bit_length() - 1

    def grams(text):
        raw = (" " + text.lower() + " ").encode()
        for order in (2, 3, 4):
            for i in range(len(raw) - order + 1):
                number = int.from_bytes(raw[i:i + order], "big")
                yield ((number ^ (order * 0x51ED27)) * 2654435761 % 2**32) >> (32 - slots)

    counts = {}
    for doc_id, text, lang in rows:
        if lang and text and any(c.isalpha() for c in text) and zlib.crc32(str(doc_id).encode()) % 5:
            own = counts.setdefault(lang, [0.5] * langid.SLOTS)
            for slot in grams(text):
                own[slot] += 1
    languages = sorted(counts)
    code = langid.codewords(len(languages))
    given = np.array([np.array(counts[x]) / sum(counts[x]) for x in languages])
    odds, trust = [], []
    for bit in code.T:
        one, zero = given[bit > 0].mean(axis=0), given[bit < 0].mean(axis=0)
        odds.append(np.log(one) - np.log(zero))
        trust.append(((one - zero) * odds[-1]).sum())
    trust = np.array(trust) / np.mean(trust)
    out = {}
    for doc_id, text, _ in rows:
        if not text or not any(c.isalpha() for c in text):
            out[doc_id] = ("und", 0.0)
            continue
        found = list(grams(text))
        margins = np.array([sum(o[s] for s in found) / len(found) * min(len(found), langid.EVIDENCE) for o in odds])
        loss = [sum(t * np.log1p(np.exp(-c * m)) for t, c, m in zip(trust, word, margins)) for word in code]
        best = int(np.argmin(loss))
        out[doc_id] = (languages[best], 1 / sum(np.exp(min(loss) - x) for x in loss))
    return out


def test_languages_equal_a_plain_version(docs_of):
    rng = random.Random(14)
    rows = [(i, prose(lang, rng.randint(1, 25), rng) + rng.choice(["", " Éà 12", "\n中文"]), lang if i % 11 else None)
            for i in range(150) for lang in [rng.choice(list(WORDS))]]
    rows += [(1000, "12 34 !", "en"), (1001, "", "de"), (1002, None, "fr"), (1003, "zz", None)]
    want = plain_language(rows)
    for r in langid.identified(docs_of(rows)).collect():
        lang, score = want[r.doc_id]
        assert r.lang_pred == lang and abs(r.score - score) < 1e-4, r
