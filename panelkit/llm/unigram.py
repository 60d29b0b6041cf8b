"""Count-only Viterbi for unigram tokenizers.

An Aho-Corasick automaton lists all vocabulary pieces that end at each place of
a word. Dynamic programming over the places carries the best score and how many
pieces reach it, no path: a place keeps one candidate, the one with the larger
score, and among equal scores the one that starts earliest (the longest last
piece). Where no piece is just the one character, that character can be unknown
for the lowest score less a penalty. A run of unknown characters counts as one
piece, or as its UTF-8 bytes if the vocabulary falls back to byte pieces.
These are the tie and unknown rules of the public tokenizers library's Unigram.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

import ahocorasick
from pyspark.sql import DataFrame

from panelkit.llm.common import map_columns, text_or_empty

#: The word mark before each word, and the penalty of an unknown character (fixed values of the model).
MARK = "▁"
UNKNOWN_PENALTY = 10.0

#: Words a worker remembers, and the longest one.
REMEMBER = 300_000
REMEMBER_LENGTH = 64


@dataclass(frozen=True)
class Unigram:
    """Pieces with their log probability; whether unknown characters fall back to byte pieces."""

    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool = True
    name: str = ""

    @property
    def unknown(self) -> float:
        return min(s for _, s in self.pieces) - UNKNOWN_PENALTY if self.pieces else -UNKNOWN_PENALTY


def zipf_vocabulary(path: str) -> Unigram:
    """The pieces of a sentencepiece file, the probability of a piece falling with its rank as 1 / (rank + 1).

    None of the public files holds a unigram model and tokenizers are not trained here, so the scores are
    derived from the order of the pieces. Control, unknown and byte pieces match no text.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    total = log(sum(1 / (r + 1) for r in range(len(pieces))))
    return Unigram(tuple((p, -log(r + 1) - total) for r, p in enumerate(pieces)), True, path)


class Counter:
    """Counts pieces with one vocabulary; remembers the words it has read."""

    def __init__(self, model: Unigram):
        self.model = model
        self.found = ahocorasick.Automaton()
        for piece, score in dict(model.pieces).items():
            self.found.add_word(piece, (len(piece), score))
        if len(self.found):
            self.found.make_automaton()
        self.unknown = model.unknown
        self.words: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """Pieces and score of the best path through one marked word."""
        n, unknown, by_bytes = len(word), self.unknown, self.model.byte_fallback
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        # an unknown last character leaves its place open, so that a run of them can count as one
        open_run = [False] * (n + 1)
        at = 0  # places up to here are settled
        start_of = [-1] * (n + 1)

        def settle(upto: int) -> None:
            nonlocal at
            while at < upto:
                at += 1
                if not single[at]:
                    value = best[at - 1] + unknown
                    # the unknown character starts later than any piece that ends here: it wins only if better
                    if start_of[at] < 0 or value > best[at]:
                        best[at], start_of[at], open_run[at] = value, at - 1, True
                        more = len(word[at - 1].encode("utf-8", "replace")) if by_bytes else \
                            0 if open_run[at - 1] else 1
                        count[at] = count[at - 1] + more

        single = [False] * (n + 1)
        for last, (length, score) in self.found.iter(word) if len(self.found) else ():
            end = last + 1
            if end - 1 > at:
                settle(end - 1)
            start = end - length
            value = best[start] + score
            if length == 1:
                single[end] = True
            if start_of[end] < 0 or value > best[end] or (value == best[end] and start < start_of[end]):
                best[end], start_of[end], count[end] = value, start, count[start] + 1
        settle(n)
        return count[n], best[n]

    def text(self, text: str) -> tuple[int, float]:
        """Pieces and summed score of a text: each word parted by white space, after a word mark."""
        # four control characters part words in Python only
        words = text.split() if not any(c in text for c in "\x1c\x1d\x1e\x1f") else _split(text)
        n, total, get = 0, 0.0, self.words.get
        for w in words:
            found = get(w)
            if found is None:
                found = self.word(MARK + w.replace(" ", MARK))
                if len(self.words) > REMEMBER:
                    self.words.clear()
                if len(w) <= REMEMBER_LENGTH:
                    self.words[w] = found
            n += found[0]
            total += found[1]
        return n, total


def _split(text: str) -> list[str]:
    import regex
    return [w for w in regex.split(r"\p{White_Space}+", text) if w]


#: The counter of a Python worker, kept from task to task with what it remembers.
_KEPT: dict[tuple, Counter] = {}


def counter_of(model: Unigram) -> Counter:
    key = (model.name, len(model.pieces), model.byte_fallback, hash(model.pieces))
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Counter(model)
    return _KEPT[key]


def count_tokens(docs: DataFrame, model: Unigram) -> DataFrame:
    """``doc_id, n_chars, n_tokens, score`` of each whole text of ``docs``.

    ``score`` is the summed log probability of the best path. A null or empty text has no tokens and score 0.
    Repeated rows each give a row, an empty table gives none; other columns are ignored.
    """
    def make():
        counter = counter_of(model)

        def row(text: str) -> tuple:
            n, score = counter.text(text)
            return len(text), n, float(score)

        return row

    rows = docs.select("doc_id", text_or_empty().alias("text_in"))
    return map_columns(rows, make, "n_chars long, n_tokens long, score double", ["doc_id"], ["text_in"])
