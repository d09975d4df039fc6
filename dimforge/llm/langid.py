"""Language identification by error-correcting output codes.

Each language is a codeword of bits; for each bit a binary n-gram classifier
tells the languages with a 1 from those with a 0.  A text's margins are
decoded to the codeword with the least weighted logistic loss, so single
wrong bits are outvoted.  A text whose two nearest codewords lose about the
same is flagged ambiguous.

Features are hashed byte n-grams (2 to 4 bytes) of the lower-cased text; the
classifiers are naive Bayes log-odds of n-gram counts, with each language of
a side weighing the same.  Counts come from a bounded sample of labelled
documents (``PER_LANGUAGE`` a language, drawn by hash of doc_id, whole texts);
every document is classified by its whole text.

Defined cases: null texts and texts without a letter get `und`, score 0.0;
without any labelled document every text does; with one language every other
text gets it, score 1.0; rows with a null doc_id are classified and never
learned from; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.common import require
from dimforge.llm.tokens import forget_words

UNKNOWN = "und"
PER_LANGUAGE = 1000
SLOTS = 1 << 15
_ORDERS = (2, 3, 4)
_CHUNK = 1 << 16
#: A mean log-odds counts as if it came from so many independent n-grams at most.
EVIDENCE = 60
AMBIGUOUS = 0.6
_ASCII_LETTER = re.compile("[A-Za-z]")


def codewords(n: int, seed: int = 3) -> np.ndarray:
    """n distinct rows of +1 and -1: all distinct splits for up to 5
    languages, else the best separated of random codes."""
    if n <= 1:
        return np.ones((n, 0))
    if n <= 5:
        splits = np.arange(1, 1 << (n - 1))
        bits = (splits[None, :] >> np.arange(n)[:, None]) & 1
        return np.where(bits, 1.0, -1.0)
    rng, width, best = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n))), None
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], size=(n, width))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        apart = ((code.shape[1] - code @ code.T) / 2)[~np.eye(n, dtype=bool)].min()
        if best is None or apart > best[0]:
            best = apart, code
    return best[1]


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def gram_slots(text: str) -> Iterator[np.ndarray]:
    """Hashed n-grams of the whole text, in chunks."""
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    for at in range(0, len(raw), _CHUNK):
        part = raw[at:at + _CHUNK + max(_ORDERS) - 1]
        rolled = part
        for order in range(2, max(_ORDERS) + 1):
            rolled = (rolled[:-1] << np.uint32(8)) | part[order - 1:]
            starts = min(len(rolled), _CHUNK)
            if order in _ORDERS:
                mixed = (rolled[:starts] ^ np.uint32(order * 0x51ED27)) * np.uint32(2654435761)
                yield mixed >> np.uint32(32 - SLOTS.bit_length() + 1)


@dataclass(frozen=True)
class Model:
    """Languages, their codewords, per-slot log-odds of each bit and bit weights."""

    languages: tuple[str, ...]
    code: np.ndarray
    odds: np.ndarray
    trust: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous)"""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        total, n = np.zeros(self.odds.shape[1]), 0
        for slots in gram_slots(text):
            total += self.odds[slots].sum(axis=0, dtype=np.float64)
            n += len(slots)
        margins = total / max(n, 1) * min(n, EVIDENCE)
        loss = (np.logaddexp(0.0, -self.code * margins) * self.trust).sum(axis=1)
        share = np.exp(loss.min() - loss)
        best = int(np.argmin(loss))
        score = float(share[best] / share.sum())
        return self.languages[best], score, score < AMBIGUOUS


def fit(sample: DataFrame) -> Model:
    """A model from rows (text, lang); per language at most ``SLOTS`` counts are collected."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if has_letter(text):
                    counts = seen.setdefault(lang, np.zeros(SLOTS, dtype=np.int64))
                    for slots in gram_slots(text):
                        counts += np.bincount(slots, minlength=SLOTS)
        for lang, counts in seen.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
                ["lang", "slot", "n"])

    table = (sample.select("text", "lang").mapInArrow(counted, "lang string, slot int, n long")
             .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow())
    langs, slots, n = (table.column(c).to_numpy() for c in ("lang", "slot", "n"))
    languages = tuple(sorted(set(langs.tolist())))
    code = codewords(len(languages))
    counts = np.full((len(languages), SLOTS), 0.5)
    at = {lang: i for i, lang in enumerate(languages)}
    np.add.at(counts, (np.array([at[x] for x in langs.tolist()], dtype=int), slots.astype(int)), n)
    given = counts / counts.sum(axis=1, keepdims=True)
    odds, trust = np.zeros((SLOTS, code.shape[1])), np.ones(code.shape[1])
    for bit in range(code.shape[1]):
        one, zero = given[code[:, bit] > 0].mean(axis=0), given[code[:, bit] < 0].mean(axis=0)
        odds[:, bit] = np.log(one) - np.log(zero)
        # a bit whose sides differ more in an average n-gram tells more
        trust[bit] = ((one - zero) * odds[:, bit]).sum()
    return Model(languages, code, odds.astype(np.float32), trust / trust.mean() if len(trust) else trust)


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """text, lang of about ``per_language`` documents of each language, by hash
    of doc_id, from those with crc32(doc_id) mod 5 other than 0 and a language."""
    eligible = (require(docs, ["doc_id", "text", "lang"]).where("lang IS NOT NULL AND doc_id IS NOT NULL")
                .where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    sizes = {r.lang: r.n for r in eligible.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    rate = F.lit(1.0)
    for lang, n in sizes.items():
        if n > per_language:
            rate = F.when(F.col("lang") == lang, per_language / n).otherwise(rate)
    return eligible.where(F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(5)), 11) * F.lit(2.0 ** -53) < rate)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is told and not ambiguous."""
    model = docs.sparkSession.sparkContext.broadcast(fit(training_sample(docs)))
    at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        predict = model.value.predict
        for batch in batches:
            yield batch.filter(pa.array([not predict(t)[2] for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every row."""
    model = docs.sparkSession.sparkContext.broadcast(fit(training_sample(docs)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_words()
        predict = model.value.predict
        for batch in batches:
            found = [predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.bool_())], ["doc_id", "lang_pred", "score", "ambiguous"])

    out = require(docs, ["doc_id", "text"]).mapInArrow(
        rows, "doc_id long, lang_pred string, score double, ambiguous boolean")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")
