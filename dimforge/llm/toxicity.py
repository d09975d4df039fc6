"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text.
A text is read in windows; a window that the toxic dictionary describes in
clearly fewer bytes than the ordinary one counts as a hit, and a document's
score is a logistic function of its hits.

- A window is one word in lower case with a space on either side.  It is
  compressed inside a fixed frame that both dictionaries hold, so that even a
  short window is coded by matches and its own bytes are what the lengths
  differ in.  Words recur, so a bounded memo keeps which are hits.
- Toxic documents are mostly ordinary prose.  The toxic dictionary is trained
  on those windows of toxic documents whose character n-grams are
  significantly more frequent there than in ordinary documents.
- A phrase of ordinary words, or a toxic word in a long run without spaces, is
  no such window.  The stretches of toxic documents (of up to ``WIDE`` bytes,
  their words one space apart) whose byte n-grams, and which as a whole, are in
  significantly more toxic documents make a second toxic dictionary.  Two to
  four words in a row of which the stretches hold something, and windows of
  ``WIDE`` bytes that hold a run of more than ``_RUN`` bytes, are compressed
  under the ordinary dictionary with and without the stretches behind it.  The
  most that one phrase, and one run, of a document saves counts beside its
  hits, whatever its share of the window.
- Thresholds (bytes saved, share of the window's own cost saved, bytes the best
  phrase and run have to save), the logistic function and the strictness of that choice of windows are calibrated on the
  sampled documents, by whole text.

The dictionaries are fitted on a bounded sample of labelled rows
(``TOXIC_DOCS`` and ``ORDINARY_DOCS``, drawn by hash of doc_id, and of these
``WINDOWS`` windows a class); every document is scored as a whole.

Defined cases: a null text or one without words has the score of no hits; with
no labelled document of either class every score is 0.0; several labels of a
doc_id count as toxic if any is; a null label is none; rows with a null doc_id
are scored and never learned from; equal rows get equal scores; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.common import materialize, require
from dimforge.llm.tokens import forget_words

TOXIC_DOCS = 3000
ORDINARY_DOCS = 6000
WINDOWS = 400_000
THRESHOLD = 0.7
_GRAM = 5
_LEVEL = 3
#: Bytes of words, with what a memo entry costs beside them, after which a memo starts anew.
_MEMO = 48 << 20
_ENTRY = 120
_LONGEST = 256
WIDE = 64
_WIDE_GRAM = 8
_STRETCHES = 8 << 10
_RUN = 24
_LONG_RUN = re.compile(rb"\S{%d}" % (_RUN + 1))
_PHRASE = 4
#: Stretches are worth their flags if they leave at most this share of the loss.
_WORTH = 0.9
# What is known of a word, in bits: it is a hit, the stretches hold something of it, it is a long run.
_HIT, _HELD, _LONG = 1, 2, 4
_HELD_ROW = re.compile(rb"[\x02\x03\x06\x07]{2,}")
_ANY_LONG = re.compile(rb"[\x04-\x07]")


def windows(text: str | None) -> list[bytes]:
    """The text's words in lower case, UTF-8; words over 256 bytes in parts."""
    return windows_of((text or "").lower().encode("utf-8", "surrogatepass"))


def windows_of(line: bytes) -> list[bytes]:
    words = line.split()
    if max(map(len, words), default=0) > _LONGEST:
        words = [w[i:i + _LONGEST] for w in words for i in range(0, len(w), _LONGEST)]
    return words


def line_of(text: str | None) -> bytes:
    """The text's words in lower case, UTF-8, one space before, between and behind them; empty without a word."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    return b" " + b" ".join(words) + b" " if words else b""


def wide_windows(text: str | None) -> list[bytes]:
    """The distinct windows of ``WIDE`` bytes, overlapping by half, of the
    text's words with one space between; a stretch of up to half a window lies
    whole in one of them."""
    return _wide(line_of(text))


def _wide(line: bytes) -> list[bytes]:
    half = WIDE // 2
    return list(dict.fromkeys([line[i:i + WIDE] for i in range(0, max(1, len(line) - half), half)])) if line else []


def _grams(word: bytes) -> list[bytes]:
    padded = b" " + word + b" "
    return [padded[i:i + _GRAM] for i in range(max(1, len(padded) - _GRAM + 1))]


class Document(NamedTuple):
    """A labelled document: its distinct windows with their counts, their
    number, 1 for toxic, importance, and its line."""

    windows: list[bytes]
    times: np.ndarray
    label: int
    importance: float
    line: bytes

    @property
    def n(self) -> int:
        return int(self.times.sum())


class Sample:
    """The documents in arrays: an entry for each distinct window of each document."""

    def __init__(self, docs: list[Document]):
        self.docs = docs
        self.words = sorted(set().union(*(d.windows for d in docs)))
        number = dict(zip(self.words, range(len(self.words))))
        self.of_doc = np.repeat(np.arange(len(docs)), [len(d.windows) for d in docs])
        self.of_word = np.fromiter((number[w] for d in docs for w in d.windows), np.int64, len(self.of_doc))
        self.times = np.concatenate([d.times for d in docs]).astype(float)
        self.n = np.bincount(self.of_doc, self.times, len(docs))
        self.label, self.importance = (np.array([d[i] for d in docs], dtype=float) for i in (2, 3))
        toxic = self.label[self.of_doc] == 1
        # a window that one document repeats counts once
        self.toxic_docs, self.ordinary_docs = (np.bincount(self.of_word[which], minlength=len(self.words)) for which in (toxic, ~toxic))

    def hits(self, hit: np.ndarray) -> np.ndarray:
        """Hits of each document, of the words that are."""
        return np.bincount(self.of_doc, self.times * hit[self.of_word], len(self.docs))


def apart(a, b, nt: float, no: float, least_ratio: float = 3.0):
    """(z, whether the ratio suffices) of counts a among nt toxic and b among no ordinary ones."""
    expected = (a + b) * nt / (nt + no)
    return (a - expected) / np.sqrt(expected * no / (nt + no) + 1), a / nt > least_ratio * (b + 1) / no


def _numbers(raw: np.ndarray, size: int) -> np.ndarray:
    """The n-grams of bytes as numbers, one for each place; fewer bytes than an n-gram have none."""
    places = max(0, len(raw) - size + 1)
    out = np.zeros(places, dtype=np.uint64)
    for j in range(size):
        out |= raw[j:j + places].astype(np.uint64) << np.uint64(8 * j)
    return out


def distinctive(sample: Sample, least_z: tuple[float, ...]) -> list[list[bytes]]:
    """For each strictness, the windows of the toxic text (as often as they
    occur) with an n-gram that is significantly more frequent in toxic than in
    ordinary text."""
    padded = [b" " + w + b" " for w in sample.words]
    # a window shorter than an n-gram is one by itself, told apart by bytes that no text holds
    padded = [p.ljust(_GRAM, b"\xff") for p in padded]
    sizes = np.array([len(p) for p in padded], dtype=np.int64)
    grams, of = _numbers(np.frombuffer(b"".join(padded), dtype=np.uint8), _GRAM), np.repeat(np.arange(len(padded)), sizes)
    inside = of[:len(grams)] == of[_GRAM - 1:]
    names, gram = np.unique(grams[inside], return_inverse=True)
    pairs = np.unique(gram * len(padded) + of[:len(grams)][inside])
    gram, word = pairs // len(padded), pairs % len(padded)
    a, b = (np.bincount(gram, n[word], len(names)) for n in (sample.toxic_docs, sample.ordinary_docs))
    z, more = apart(a, b, max(1, sample.toxic_docs.sum()), max(1, sample.ordinary_docs.sum()))
    out = []
    for least in least_z:
        marked = np.bincount(word, ((z > least) & more)[gram], len(padded)) > 0
        out.append([sample.words[i] for i in np.flatnonzero(marked & (sample.toxic_docs > 0)) for _ in range(sample.toxic_docs[i])])
    return out


class GramCounts(NamedTuple):
    """Byte n-grams of toxic lines, ascending, with the toxic and the ordinary documents that hold each."""

    grams: np.ndarray
    toxic: np.ndarray
    ordinary: np.ndarray
    nt: int
    no: int

    @classmethod
    def of(cls, docs: list[Document]) -> "GramCounts":
        held = [np.unique(line_grams(d.line)) for d in docs if d.label]
        grams, toxic = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        ordinary = np.zeros(len(grams), dtype=np.int64)
        for d in docs:
            if not d.label and len(grams):
                own = np.unique(line_grams(d.line))
                at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
                ordinary[at[grams[at] == own]] += 1
        return cls(grams, toxic, ordinary, len(held), len(docs) - len(held))

    def marks(self, least: float) -> np.ndarray:
        z, more = apart(self.toxic, self.ordinary, max(1, self.nt), max(1, self.no))
        return self.grams[(z > least) & more]


def line_grams(line: bytes) -> np.ndarray:
    return _numbers(np.frombuffer(line, dtype=np.uint8), _WIDE_GRAM)


def distinctive_stretches(docs: list[Document], counts: GramCounts, least: float) -> bytes:
    """The stretches of the toxic documents that are, by their n-grams and as
    a whole, in significantly more toxic than ordinary documents; as one
    dictionary of at most ``_STRETCHES`` bytes, the most frequent last."""
    marks = counts.marks(least)
    if not len(marks):
        return b""
    found: Counter = Counter()
    for d in docs:
        grams = line_grams(d.line) if d.label else marks[:0]
        at = np.minimum(np.searchsorted(marks, grams), len(marks) - 1)
        marked = np.flatnonzero(marks[at] == grams)
        if len(marked):
            # n-grams that touch or overlap make one stretch
            breaks = np.flatnonzero(np.diff(marked) > _WIDE_GRAM)
            found.update({part for i, j in zip(np.r_[0, breaks + 1], np.r_[breaks, len(marked) - 1])
                          for part in _parts(d.line, int(marked[i]), int(marked[j]) + _WIDE_GRAM)})
    toxic, ordinary = _documents_with(found, docs)
    content, size = [], 0
    for i, (w, _) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0]))):
        z, more = apart(toxic[w], ordinary[w], max(1, counts.nt), max(1, counts.no))
        if z > least and more and size + len(w) <= _STRETCHES and not any(w in c for c in content):
            content.append(w)
            size += len(w)
    return b"".join(reversed(content))


def _parts(line: bytes, start: int, end: int) -> list[bytes]:
    """line[start:end] out to the ends of its words, if they are near; a longer
    one in parts of ``WIDE`` bytes that overlap by half."""
    left, right = line.rfind(b" ", max(0, start - 16), start + 1), line.find(b" ", end - 1, end + 16)
    left, right = start if left < 0 else left, end if right < 0 else right + 1
    return _wide(line[left:right]) if right - left > WIDE else [line[left:right]]


def _documents_with(parts: Iterable[bytes], docs: list[Document]) -> tuple[Counter, Counter]:
    """In how many toxic and ordinary documents each part lies, by one pass over each."""
    matcher = ahocorasick.Automaton()
    for w in parts:
        matcher.add_word(w.decode("latin-1"), w)
    out = Counter(), Counter()
    if len(matcher):
        matcher.make_automaton()
        for d in docs:
            out[0 if d.label else 1].update({w for _, w in matcher.iter(d.line.decode("latin-1"))})
    return out


def trained(words: list[bytes], size: int) -> bytes:
    """A zstandard dictionary; too few samples to train on are used as its content."""
    spaced = [b" " + w + b" " for w in words]
    random.Random(7).shuffle(spaced)
    samples = [b"".join(spaced[i:i + 8]) for i in range(0, len(spaced), 8)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size] or b" "


@dataclass(frozen=True)
class Model:
    """Dictionaries and thresholds; ``weights`` are the logistic function's
    (None before calibration: every score is 0)."""

    ordinary: bytes
    toxic: bytes
    saved: float = 4.0
    share: float = 0.5
    weights: tuple[float, ...] | None = None
    #: stretches of toxic documents, and the bytes that a phrase and a run have to save
    stretches: bytes = b""
    least: tuple[float, float] = (0.0, 0.0)


class Lengths:
    """Window compression lengths under both dictionaries."""

    def __init__(self, model: Model, contents: tuple[bytes, bytes] | None = None):
        # bytes that no UTF-8 text holds; zstandard looks for no match in the
        # last 8 bytes, so the window does not come last
        marks = [0xC0, 0xC1, *range(0xF5, 0x100)]
        self.frame = bytes(random.Random(5).choices(marks, k=64))
        self.tail = self.frame[-16:]
        self.coders = [self._coder(c) for c in contents or (model.ordinary, model.toxic)]
        self.empty = [len(c.compress(self.frame + b" " + self.tail)) for c in self.coders]

    def _coder(self, content: bytes) -> zstandard.ZstdCompressor:
        dictionary = zstandard.ZstdCompressionDict(content + self.frame, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=_LEVEL)
        return zstandard.ZstdCompressor(level=_LEVEL, dict_data=dictionary, write_content_size=False,
                                        write_checksum=False, write_dict_id=False)

    def __call__(self, word: bytes) -> tuple[int, int]:
        """Bytes of the window beyond the frame, ordinary and toxic."""
        framed = self.frame + b" " + word + b" " + self.tail
        return tuple(len(c.compress(framed)) - e for c, e in zip(self.coders, self.empty))

    def saved(self, word: bytes) -> int:
        ordinary, toxic = self(word)
        return ordinary - toxic


class Scorer:
    """Scores texts; a bounded memo keeps what is known of a word, another what
    a phrase saves.  One a task, so its memory is gone when other stages run
    in the same worker."""

    def __init__(self, model: Model):
        self.model, self.lengths = model, Lengths(model)
        self.known, self.known_bytes = {}, 0
        self.saved, self.saved_bytes = {}, 0
        content = model.stretches
        self.content = content
        self.grams = {content[i:i + _GRAM] for i in range(len(content) - _GRAM + 1)}
        # what the phrases and the long runs of a text save by the stretches
        self.wide = Lengths(model, (model.ordinary, model.ordinary + content)) if content else None

    def is_hit(self, word: bytes) -> bool:
        return is_hit(*self.lengths(word), self.model.saved, self.model.share)

    def holds(self, word: bytes) -> bool:
        """Whether the stretches hold any of a word; one they hold nothing of
        makes no phrase cheaper."""
        padded = b" " + word + b" "
        return padded in self.content if len(padded) < _GRAM else any(g in self.grams for g in _grams(word))

    def _learn(self, words: set[bytes]) -> None:
        for w in words:
            self.known[w] = self.is_hit(w) * _HIT + ((self.wide is not None and self.holds(w)) * _HELD) + (len(w) > _RUN) * _LONG
        self.known_bytes += sum(map(len, words)) + _ENTRY * len(words)

    def read(self, text: str | None) -> tuple[int, int, int, int]:
        """(windows that are hits, windows, the most bytes that one phrase saves, and one run)."""
        words = windows(text)
        if self.known_bytes > _MEMO:
            self.known, self.known_bytes = {}, 0
        codes = list(map(self.known.get, words))
        if None in codes:
            self._learn({w for w, c in zip(words, codes) if c is None})
            codes = list(map(self.known.__getitem__, words))
        flags = bytes(codes)
        hits = sum(flags.count(bits) for bits in range(8) if bits & _HIT)
        phrase = run = 0
        if self.wide:
            for row in _HELD_ROW.finditer(flags):
                phrase = max(phrase, self._phrase(words[row.start():row.end()]))
            if _ANY_LONG.search(flags):
                run = max([0, *(self.wide.saved(w) for w in wide_windows(text) if _LONG_RUN.search(w))])
        return hits, len(words), phrase, run

    def _phrase(self, words: list[bytes]) -> int:
        """The most that two to four of these words in a row save."""
        if self.saved_bytes > _MEMO:
            self.saved, self.saved_bytes = {}, 0
        best = 0
        for k in range(2, min(len(words), _PHRASE) + 1):
            for i in range(len(words) - k + 1):
                part = b" ".join(words[i:i + k])
                saved = self.saved.get(part)
                if saved is None:
                    saved = self.saved[part] = self.wide.saved(part)
                    self.saved_bytes += len(part) + _ENTRY
                best = max(best, saved)
        return best

    def score(self, text: str | None) -> float:
        return self.scored(*self.read(text))

    def scored(self, hits: int, n: int, phrase: int, run: int) -> float:
        m = self.model
        return logistic(m.weights, hits, n, beyond((phrase, run), m.least))


def is_hit(ordinary, toxic, saved: float, share: float):
    """Whether a window's toxic description is so much shorter (numbers or arrays)."""
    return (ordinary - toxic >= saved) & (ordinary - toxic >= share * ordinary)


def beyond(best, least) -> np.ndarray:
    """What the best phrase and run save beyond the bytes they have to."""
    return np.maximum(np.asarray(best, dtype=float) - np.asarray(least), 0.0)


def features(hits, n, wide=(0.0, 0.0)) -> np.ndarray:
    """Any hit, how many beyond the share expected in longer texts, the best phrase and the best run."""
    hits, n, wide = (np.asarray(x, dtype=float) for x in (hits, n, wide))
    words = np.stack([np.ones_like(hits), np.log1p(hits), np.log1p(1000 * hits / np.maximum(n, 30))], axis=-1)
    return np.concatenate([words, np.log1p(np.broadcast_to(wide, (*hits.shape, 2)))], axis=-1)


def logistic(weights, hits: int, n: int, wide=(0.0, 0.0)) -> float:
    if weights is None:
        return 0.0
    x = features(hits, n, wide)[..., :len(weights)]
    return float(1 / (1 + np.exp(-np.clip(x @ np.asarray(weights), -50, 50))))


def fit_logistic(x: np.ndarray, y: np.ndarray, importance: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (importance * (y - p)) - 1e-2 * w
        hessian = (x * (importance * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def dictionaries(sample: Sample, least_z: tuple[float, ...]) -> list[Model]:
    """Both dictionaries, for each strictness."""
    ordinary = trained([w for w, n in zip(sample.words, sample.ordinary_docs) for _ in range(n)], 32 << 10)
    return [Model(ordinary, trained(words, 16 << 10)) for words in distinctive(sample, least_z)]


def calibrate(model: Model, sample: Sample) -> tuple[float, Model]:
    """(log loss, model with the thresholds and logistic weights of least loss)."""
    lengths, best = Lengths(model), None
    cost = np.array([lengths(w) for w in sample.words]).reshape(-1, 2)
    for saved in (2, 3, 4, 5):
        for share in (0.34, 0.5, 0.6, 0.7):
            hits = sample.hits(is_hit(cost[:, 0], cost[:, 1], saved, share))
            x = features(hits, sample.n)[:, :3]
            loss, w = _fitted_loss(x, sample.label, sample.importance)
            if best is None or loss < best[0]:
                best = loss, Model(model.ordinary, model.toxic, saved, share, w)
    return best


def _fitted_loss(x: np.ndarray, y: np.ndarray, importance: np.ndarray) -> tuple[float, tuple[float, ...]]:
    """(log loss, logistic weights)."""
    w = fit_logistic(x, y, importance)
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-9, 1 - 1e-9)
    loss = float(-(importance * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / importance.sum())
    return loss, tuple(w.tolist())


def widened(loss: float, model: Model, docs: list[Document], least_z: tuple[float, ...]) -> Model:
    """The model with the stretches, at the strictness and the bytes to save of
    least loss; as it was if they don't lessen it by a tenth.

    Any stretch saves bytes in the documents it was taken from, so each half
    of the documents is calibrated with the stretches of the other half; the
    dictionary in use holds those of both.
    """
    halves = [docs[0::2], docs[1::2]]
    if any(len({d.label for d in half}) < 2 for half in halves):
        return model
    counts = [GramCounts.of(half) for half in halves]
    best = loss, None, model
    for z in least_z:
        learned = [distinctive_stretches(half, c, z) for half, c in zip(halves, counts)]
        if not all(learned):
            continue
        read = []
        for half, other in ((0, 1), (1, 0)):
            scorer = Scorer(replace(model, stretches=learned[other]))
            read += [scorer.read(d.line.decode("utf-8", "surrogatepass")) for d in halves[half]]
        hits, n, *saved = np.array(read, dtype=float).T
        y, importance = (np.array([d[i] for half in halves for d in half], dtype=float) for i in (2, 3))
        for phrase in (0, 1, 2, 3, 4, 6):
            for run in (0, 2, 4, 6):
                least = float(phrase), float(run)
                now, w = _fitted_loss(features(hits, n, beyond(np.stack(saved, axis=1), least)), y, importance)
                if min(w[3:]) >= 0 and now < min(best[0], _WORTH * loss):
                    best = now, z, replace(model, weights=w, least=least)
    if best[1] is None:
        return model
    return replace(best[2], stretches=distinctive_stretches(docs, GramCounts.of(docs), best[1]))


def learn(docs: list[Document], least_z: tuple[float, ...] = (3.0, 4.5, 6.0)) -> Model:
    """The model of least loss over how strictly toxic windows are chosen: few
    documents hold too few repeats for a strict choice, many need one."""
    sample = Sample(docs)
    loss, model = min((calibrate(m, sample) for m in dictionaries(sample, least_z)), key=lambda tried: tried[0])
    return widened(loss, model, docs, least_z)


def fit(sample: DataFrame, windows_each: int = WINDOWS) -> Model | None:
    """A model from rows (text, toxic, importance) of a bounded sample.

    The driver gets the lines of whole documents, in hash order, as long as
    their distinct windows, and their lines in parts of half a wide window, are
    at most ``windows_each`` a class.  Where that thins a class, its other
    documents weigh more.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        for batch in batches:
            made = [line_of(t) for t in batch.column(0).to_pylist()]
            words = [Counter(windows_of(line)) for line in made]
            sizes = [max(len(w), 2 * len(line) // WIDE) for w, line in zip(words, made)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(made, pa.binary()), pa.array(sizes, pa.int64()), batch.column(1), batch.column(2),
                 pa.array([zlib.crc32(repr(sorted(w.items())).encode()) for w in words], pa.int64())],
                ["line", "size", "toxic", "importance", "at"])

    rows = materialize(sample.select("text", "toxic", "importance").mapInArrow(
        lines, "line binary, size long, toxic int, importance double, at long"), "toxicity-sample")
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.sum("size").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    rate = {label: min(1.0, windows_each / n) for label, n in sizes.items()}
    kept = rows.where(F.pmod("at", F.lit(1 << 20)) < F.lit(float(1 << 20)) * F.when(
        F.col("toxic") == 1, rate[1]).otherwise(rate[0]))
    docs, known = [], {}
    for row in kept.drop("size").orderBy("at", "line").toLocalIterator():
        line = bytes(row.line)
        words = Counter(windows_of(line))
        # documents share the bytes of their common words
        docs.append(Document([known.setdefault(w, w) for w in words], np.fromiter(words.values(), np.int64, len(words)),
                             row.toxic, row.importance / rate[row.toxic], line))
    return learn(docs) if len({d.label for d in docs}) == 2 else None


def labelled_sample(docs: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS,
                    ordinary_docs: int = ORDINARY_DOCS) -> DataFrame:
    """text, toxic, importance of about as many documents of each class as
    stated, drawn by hash of doc_id from those with crc32(doc_id) mod 3 other
    than 1.  ``importance`` gives back the classes' shares of all labels."""
    known = (labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
             .where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {0: min(1.0, ordinary_docs / max(1, sizes.get(0, 0))), 1: min(1.0, toxic_docs / max(1, sizes.get(1, 0)))}
    rate = F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])
    drawn = known.where(F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(3)), 11) * F.lit(2.0 ** -53) < rate)
    drawn = drawn.withColumn("importance", 1.0 / rate)  # about toxic_docs + ordinary_docs rows
    return require(docs, ["doc_id", "text"]).join(F.broadcast(drawn), "doc_id").select("text", "toxic", "importance")


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of a labelled sample; one without hits if a class is missing."""
    return fit(labelled_sample(docs, labels)) or Model(b" ", b" ")


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, hits of every row."""
    model = fitted(docs, labels)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        scorer = Scorer(model)
        for batch in batches:
            read = [scorer.read(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([scorer.scored(*r) for r in read], pa.float64()), pa.array([r[0] for r in read], pa.int64())],
                ["doc_id", "score", "hits"])

    out = require(docs, ["doc_id", "text"]).mapInArrow(rows, "doc_id long, score double, hits long")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "hits")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score under the threshold."""
    model, at = fitted(docs, labels), docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        scorer = Scorer(model)
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
