"""Token ids, rANS blocks, token files and packing, by round trip and against the library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from dimforge.llm import packing, rans, token_files
from dimforge.llm.tokens import Encoder, tokenizer_path


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(library):
    encode = Encoder(tokenizer_path(), memo=50)
    rng = random.Random(1)
    letters = " \n\t.,'a1é​\x1c 中s\0"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    texts += [None, "", " ", "it's 12,5. End. ", "<|endoftext|> in text", "a  b   c \n \n d"]
    for at in range(0, len(texts), 100):
        part = texts[at:at + 100]
        assert [np.frombuffer(x, encode.dtype).tolist() for x in encode(part)] == [library(t) for t in part]


@pytest.mark.parametrize("text,ids", [("x <|endoftext|> y", [87, 220, 50256, 331]), ("<|endoftext|>", [50256])])
def test_special_token_strings_are_those_tokens(library, text, ids):
    encode = Encoder(tokenizer_path())
    assert library(text) == ids
    for around in (text, f"{text} and more", f"start {text}", f"glued{text}glued", f"{text}{text} a {text}", f"<|endoftext {text} |>", f"é\n{text}\t"):
        for _ in range(2):  # the second time from the memo
            assert np.frombuffer(encode([around, "plain words"])[0], encode.dtype).tolist() == library(around)


def test_memo_is_bounded_by_bytes_and_keeps_no_long_words(library):
    encode = Encoder(tokenizer_path(), memo=40_000)
    long = ["q" * 65, "中" * 4000, "q" * 64]
    for at in range(0, 3000, 100):
        texts = [f"a w{i} {long[i % 3]} end. {long[i % 3]}" for i in range(at, at + 100)]
        assert [np.frombuffer(x, encode.dtype).tolist() for x in encode(texts)] == [library(t) for t in texts]
        assert encode.held <= 40_000 + 100 * (encode._ENTRY + 80) + 10_000 and max(map(len, encode.memo)) <= 64


def test_rans_round_trip_and_damage():
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.zipf(1.3, 20_000), 5000).astype(np.uint16)
    table = rans.Table(rans.scaled_frequencies(np.bincount(ids, minlength=6000)))
    for n in (0, 1, 2, rans.LANES - 1, rans.LANES, rans.LANES + 1, 20_000):
        block = rans.encode(ids[:n], table)
        assert (rans.decode(block, table) == ids[:n]).all()
    damaged = bytearray(rans.encode(ids, table))
    damaged[-3] ^= 64
    with pytest.raises((ValueError, IndexError)):
        rans.decode(bytes(damaged), table)
    with pytest.raises(ValueError):
        rans.encode(np.array([5999]), table)


def test_frequencies_sum_to_a_power_of_two_and_keep_rare_ids():
    for counts in ([0, 0, 0], [1], [10**12, 1, 0, 1], list(range(300)), [1] * 5000):
        freq = rans.scaled_frequencies(np.array(counts))
        assert int(freq.sum()) & (int(freq.sum()) - 1) == 0
        assert all(f > 0 for f, c in zip(freq, counts) if c)
    size = 4096
    assert rans.scaled_frequencies(np.r_[10**9, np.ones(4000, int)], 12).sum() == size


def expected_digest(rows, library, end):
    out, start = [], 0
    for doc_id, text in rows:
        ids = library(text) + [end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_round_trip(spark, docs_of, library, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 1000)
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["alpha", "beta,", "gamma."]) for _ in range(rng.choice([0, 3, 50, 4000])))) for i in range(60)]
    shuffled = rng.sample(rows, len(rows))
    written = token_files.write_token_files(docs_of(shuffled).repartition(5), 2, file_ids=15_000)
    files = written.manifest.orderBy("part").collect()
    assert len(files) > 1
    got = token_files.read_documents(spark, written).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == expected_digest(rows, library, 2)
    assert all(r.ids == library(t) + [2] for r, (_, t) in zip(got, rows))
    # any range of a file, from its checkpoints alone
    whole = np.concatenate([np.array(r.ids) for r in got])
    first = files[0]
    for start, n in ((0, 10), (995, 30), (first.n_ids - 7, 7), (2500, 2600)):
        part = token_files.read_range(written.folder, first.path, start, n)
        assert (part == whole[:first.n_ids][start:start + n]).all()


def test_token_file_edge_cases(spark, edge_docs, empty_docs, with_clashes, library):
    clash = with_clashes(edge_docs, "ids", "start", "part", "path", "n_tokens")
    got = token_files.token_digest(clash).orderBy("start").collect()
    assert len(got) == edge_docs.count()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:])) and got[0].start == 0
    texts = defaultdict(set)
    for r in edge_docs.collect():
        texts[r.doc_id].add(zlib.crc32(np.array(library(r.text) + [2], dtype="<u4").tobytes()))
    assert all(r.ids_crc32 in texts[r.doc_id] for r in got)
    assert token_files.token_digest(empty_docs).count() == 0


def check_packing(rows, docs, library, capacity=1024, end=0):
    """Every id in exactly one piece, sequences gapless; returns padding and ids."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    texts = defaultdict(list)
    for d in docs:
        texts[d.doc_id].append(np.array(library(d.text) + [end], dtype="<u4"))
    for doc_id, own in texts.items():
        spans = defaultdict(int)
        for p in pieces[doc_id]:
            spans[(p.doc_tokens, p.start, p.length, p.ids_crc32)] += 1
        for ids in own:
            at = 0
            while at < len(ids):
                fit = [s for s in spans if spans[s] and s[0] == len(ids) and s[1] == at
                       and s[3] == zlib.crc32(ids[at:at + s[2]].tobytes())]
                assert fit
                spans[fit[0]] -= 1
                at += fit[0][2]
        assert not any(spans.values())
    padding = total = 0
    for members in sequences.values():
        members.sort(key=lambda p: p.offset)
        at = 0
        for p in members:
            assert p.offset == at
            at += p.length
        assert 0 < at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding, total


def test_classes_fill_their_bins():
    lengths = packing.class_lengths(1024)
    assert 1 in lengths and 1024 in lengths and all(1024 - 1024 // n * n <= 8 for n in lengths)
    for n in list(range(1, 3000)) + [10**6]:
        parts = packing.cuts(n, lengths)
        assert sum(parts) == n and set(parts) <= set(lengths)
        assert len(parts) <= n // 1024 + 9


def test_best_fit_never_overfills():
    rng = random.Random(4)
    lengths = [rng.randint(1, 700) for _ in range(2000)]
    bins, offsets = packing.best_fit(lengths, 1024)
    load = defaultdict(int)
    for b, o, n in sorted(zip(bins, offsets, lengths)):
        assert load[b] == o
        load[b] += n
    assert max(load.values()) <= 1024 and len(load) < 1.02 * sum(lengths) / 1024 + 2


def test_packing_covers_all_ids_with_little_padding(spark, docs_of, library):
    rng = random.Random(6)
    docs = docs_of([(i, " ".join(rng.choice(["one", "two,", "three."]) for _ in range(int(rng.paretovariate(0.8) * 30) % 6000)))
                    for i in range(250)])
    # many small shards each leave one bin open
    for shard, most in ((packing.SHARD, 0.01), (40, 0.1)):
        rows = packing.pack(docs.repartition(3), shard=shard).collect()
        padding, total = check_packing(rows, docs.collect(), library)
        assert padding < most * total + 1024


def test_packing_edge_cases(spark, edge_docs, empty_docs, with_clashes, library):
    clash = with_clashes(edge_docs, "length", "shard", "bin", "key", "ids")
    check_packing(packing.pack(clash).collect(), edge_docs.collect(), library)
    assert packing.pack(empty_docs).count() == 0


def test_larger_capacities_and_class_numbers(spark, docs_of, library):
    rng = random.Random(7)
    docs = docs_of([(i, " ".join(rng.choice(["one", "two,", "three."]) for _ in range(rng.choice([0, 9, 500, 9000])))) for i in range(80)])
    for capacity in (64, 4096):
        rows = packing.pack(docs, capacity=capacity, shard=20).collect()
        check_packing(rows, docs.collect(), library, capacity)
        classes = packing.class_lengths(capacity)
        assert all(r.sequence_id >> 52 == 0 or classes[(r.sequence_id >> 52) - 1] == r.length for r in rows)


def test_sequences_hold_the_pieces_and_their_padding(spark, docs_of, library):
    rng = random.Random(8)
    docs = docs_of([(i, " ".join(rng.choice(["one", "two,", "three.", "<|endoftext|>"]) for _ in range(int(rng.paretovariate(0.8) * 9) % 3000)))
                    for i in range(120)])
    got = {r.sequence_id: (r.n_tokens, np.frombuffer(bytes(r.ids), "<u4")) for r in
           packing.sequences(docs, end_id=5, capacity=256, pad_id=9, shard=30).collect()}
    pieces = packing.pack(docs, end_id=5, capacity=256, shard=30, with_ids=True).collect()
    texts = {d.doc_id: library(d.text) + [5] for d in docs.collect()}
    whole = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        ids = np.frombuffer(bytes(p.ids), "<u4")
        assert ids.tolist() == texts[p.doc_id][p.start:p.start + p.length] and zlib.crc32(bytes(p.ids)) == p.ids_crc32
        whole[p.sequence_id] += ids.tolist()
    assert got.keys() == whole.keys() and sum(n for n, _ in got.values()) == sum(map(len, texts.values()))
    for key, (n, ids) in got.items():
        assert n == len(whole[key]) and ids[:n].tolist() == whole[key]
        assert len(ids) == (n if n & (n - 1) == 0 else 256) and (ids[n:] == 9).all()
    assert packing.sequences(docs.limit(0)).count() == 0
