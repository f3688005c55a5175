"""Token counts of a unigram vocabulary by a count-only Viterbi.

A text is cut at white space and every word is prefixed with the word mark.
An Aho-Corasick automaton over the vocabulary enumerates all pieces that end
at each character; dynamic programming over the characters carries only the
best score, its number of pieces and whether its last piece is unknown --
no lattice and no back pointers.

Tie rules are those of the ``tokenizers`` unigram model: among equal scores
the piece that starts first wins (the automaton lists longer pieces first,
later ones must be strictly better); a character without a piece of its own
is an unknown piece at the lowest score less ``UNKNOWN_PENALTY``; runs of
unknown pieces count once.

Defined cases: null and empty texts have no tokens and score 0; repeated
rows are separate rows; an empty table gives no rows; a very long word is
read like any other (time and memory linear in its matches).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import text_or_empty

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words whose result a task remembers at a time.
REMEMBERED = 400_000
#: ``str.split`` also cuts at these four, which are not white space in Unicode.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_WORDS = re.compile("[^\t-\r \x85\xa0  -     　]+")


class CountViterbi:
    """Score and piece count of words under ``pieces`` ``(text, score)``."""

    def __init__(self, pieces: Sequence[tuple[str, float]], unknown: int = 0):
        self.automaton = ahocorasick.Automaton()
        for k, (piece, score) in enumerate(pieces):
            if piece:
                self.automaton.add_word(piece, (len(piece), float(score), k == unknown))
        self.automaton.make_automaton()
        self.unknown_score = min((float(s) for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[float, int]] = {}

    def word(self, word: str) -> tuple[float, int]:
        """Best score and number of pieces of one word."""
        n = len(word)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches = self.automaton.iter(word)
        end, value = next(matches, (n, None))
        for e in range(n):
            best = pieces = last = None
            single = False
            while end == e:
                length, gain, is_unknown = value
                s = e + 1 - length
                if best is None or score[s] + gain > best:
                    best, last = score[s] + gain, is_unknown
                    pieces = count[s] + (not (is_unknown and unknown[s]))
                single = single or length == 1
                end, value = next(matches, (n, None))
            if not single and (best is None or score[e] + self.unknown_score > best):
                best, last = score[e] + self.unknown_score, True
                pieces = count[e] + (not unknown[e])
            score[e + 1], count[e + 1], unknown[e + 1] = best, pieces, last
        return score[n], count[n]

    def text(self, text: str) -> tuple[int, float]:
        """Number of tokens and score of a text."""
        words = _WORDS.findall(text) if _NOT_SPACE.search(text) else text.split()
        known, total, tokens = self.known, 0.0, 0
        for w in words:
            found = known.get(w)
            if found is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = known[w] = self.word(MARK + w)
            total += found[0]
            tokens += found[1]
        return tokens, total


@lru_cache(maxsize=2)
def load_pieces(path: str) -> tuple[tuple[tuple[str, float], ...], int]:
    """``(pieces with scores, id of the unknown piece)`` of a model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return tuple((model.id_to_piece(k), model.get_score(k)) for k in range(model.get_piece_size())), model.unk_id()


@lru_cache(maxsize=2)
def load_counter(path: str) -> CountViterbi:
    return CountViterbi(*load_pieces(path))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None) -> DataFrame:
    """``[id_col, n_tokens, score]`` of every text under the unigram
    vocabulary (pieces and scores) in the file ``vocabulary``."""
    path = vocabulary or vocabulary_path()

    @F.pandas_udf("n_tokens long, score double")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = load_counter(path)
        for texts in batches:
            yield pd.DataFrame([counter.text(t) for t in texts], columns=["n_tokens", "score"])

    return docs.select(F.col(id_col), count(text_or_empty(text_col)).alias("c")).select(id_col, "c.*")
