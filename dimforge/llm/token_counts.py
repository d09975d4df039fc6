"""Token counts under a unigram vocabulary, without making the tokens.

A text is cut where the tokenizer cuts it (before each space, which counts as
the word's first character).  In a word, an Aho-Corasick automaton finds every
vocabulary piece that ends at each character; dynamic programming carries the
best score of each prefix and the number of pieces on its best path.

Tie and unknown rules are those of the ``tokenizers`` library's Unigram model:
scores are added left to right, a later start replaces an earlier one only if
it is strictly better, a character that no piece of one character covers may
be unknown at the least score less 10, and unknown pieces that follow each
other count as one.

Words recur, so a bounded memo keeps their counts; a word of any length takes
time and memory in proportion to its length.

Defined cases: a null text is the empty text, with no tokens; repeated pieces
of a vocabulary file count by the last; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from dimforge.llm.common import require

PIECES = "piece_bpe_32k.model"
SPACE = "▁"
_UNKNOWN_PENALTY = 10.0
_MEMO = 500_000


def vocabulary(path: str | None = None) -> list[tuple[str, float]]:
    """(piece, score) of a vocabulary file, without control and byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(PIECES))
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.unknown = min((s for _, s in pieces), default=0.0) - _UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.memo: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Pieces on the best path of one word.

        The automaton gives the matches of one end after the other, longest
        first: starts in ascending order, as the lattice is walked.
        """
        n = len(word)
        score, pieces = [0.0] * (n + 1), [0] * (n + 1)
        after_unknown = [False] * (n + 1)  # the best path so far ends in an unknown piece
        at, best, count, single = 0, None, 0, True

        def close(upto: int) -> None:
            """Settles the open end and the ends without a match before ``upto``."""
            nonlocal at, best, count, single
            while True:
                unknown = False
                if not single:
                    value = score[at - 1] + self.unknown
                    if best is None or value > best:
                        best, unknown = value, True
                        count = pieces[at - 1] + (not after_unknown[at - 1])
                if at:
                    score[at], pieces[at], after_unknown[at] = best, count, unknown
                if at + 1 >= upto:
                    break
                at, best, single = at + 1, None, False
            at, best, single = upto, None, False

        for last, (length, s) in self.automaton.iter(word) if len(self.automaton) else ():
            if last >= at:
                close(last + 1)
            start = last + 1 - length
            value = score[start] + s
            if best is None or value > best:
                best, count = value, pieces[start] + 1
            if length == 1:
                single = True
        close(n + 1)
        return pieces[n]

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        memo, total = self.memo, 0
        if len(memo) > _MEMO:
            memo.clear()
        for word in split(text):
            n = memo.get(word)
            if n is None:
                n = memo[word] = self.word(word)
            total += n
        return total


def split(text: str) -> list[str]:
    """Words as the tokenizer cuts them: each space begins one, and so does the text."""
    marked = text.replace(" ", SPACE)
    first, *rest = marked.split(SPACE)
    return ([SPACE + first] if first else []) + [SPACE + w for w in rest]


_counters: dict[str, Counter] = {}


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens of every row."""
    path = path or public_tokenizers.path(PIECES)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counters.setdefault(path, None) or Counter(vocabulary(path))
        _counters[path] = count
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([count(t) for t in batch.column(1).to_pylist()], pa.int64())], ["doc_id", "n_tokens"])

    return require(docs, ["doc_id", "text"]).mapInArrow(rows, "doc_id long, n_tokens long")
