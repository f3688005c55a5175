"""Tokenizers and n-grams as native column expressions.

Every function maps a Column to a Column, so tokenization runs inside the
JVM next to the scan (no Python worker, no per-row serialisation).

Word boundaries are written as explicit ASCII look-arounds instead of
``\\b``: the JDK's ``\\b`` treats accented letters as word characters, while
``\\w`` (and every other regex engine we compare with) is ASCII-only.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusml.functions.opcodes import DEFAULT_OPCODES

# Token patterns of the three corpus kinds.
WORD_START = r"(?<![A-Za-z0-9_])"
WORD_END = r"(?![A-Za-z0-9_])"
BYTE_PATTERN = r"(?<= )[0-9A-F]{2}"        # as written in the tokenizer's definition
BYTE_CAPTURE = r" ([0-9A-F]{2})"           # same tokens (group 1), ~30% faster: no look-behind
# Word runs are possessive (``\w++``): what may follow is no word character, so no shorter run ever matches.
SEGMENT_PATTERN = r"\.?\w++:(?=[0-9A-F]{8}\s)"
BYTE_PAIR_PATTERN = WORD_START + r"[0-9A-F]{2} [0-9A-F]{2}" + WORD_END
WORD_RUN_PATTERN = WORD_START + r"\w++"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prepared(text, lowercase: bool) -> Column:
    text = _col(text)
    return F.lower(text) if lowercase else text


def vocabulary_words(vocabulary: Iterable[str] | None) -> list[str]:
    words = sorted(set(DEFAULT_OPCODES if vocabulary is None else vocabulary))
    bad = [w for w in words if not w or not all(ch.isascii() and (ch.isalnum() or ch == "_") for ch in w)]
    if bad:
        raise ValueError(f"vocabulary entries must be ASCII word characters only: {bad[:5]}")
    return words


def extract_all(text, pattern: str) -> Column:
    """All non-overlapping matches of ``pattern`` (group 0), left to right."""
    return F.regexp_extract_all(_col(text), F.lit(pattern), 0)


def byte_tokens(text, lowercase: bool = False) -> Column:
    """Two-digit upper-case hex bytes preceded by a blank (hex dump columns).

    The address column (line start) and ``??`` placeholders never match.
    ``lowercase=True`` lower-cases the text first, as a default-configured
    regex tokenizer does; only all-decimal pairs then survive.
    """
    # A match of BYTE_PATTERN never starts on a blank and the blank it looks
    # behind at is never part of an earlier match, so capturing the pair
    # after a consumed blank yields exactly the same list.
    return F.regexp_extract_all(prepared(text, lowercase), F.lit(BYTE_CAPTURE), 1)


def _keep_vocabulary(tokens: Column, vocabulary: list[str], keep_other) -> Column:
    # Candidates are whole word runs; a run is kept when it is a vocabulary
    # word.  This equals the alternation ``\b(w1|w2|...)\b`` but costs one
    # hash-set probe (INSET) per word instead of one regex branch per entry.
    return F.filter(tokens, lambda t: keep_other(t) | t.isin(vocabulary))


def asm_tokens(text, vocabulary: Iterable[str] | None = None, lowercase: bool = False) -> Column:
    """Segment titles (``.text:`` before an 8-hex-digit address and a blank)
    or whole words from ``vocabulary`` (default: x86 mnemonics)."""
    words = vocabulary_words(vocabulary)
    cands = extract_all(prepared(text, lowercase), f"(?:{SEGMENT_PATTERN})|(?:{WORD_RUN_PATTERN})")
    return _keep_vocabulary(cands, words, lambda t: t.endswith(":"))


def joint_tokens(text, vocabulary: Iterable[str] | None = None, lowercase: bool = False) -> Column:
    """Non-overlapping ``XX XX`` byte pairs, segment titles or vocabulary words
    (earlier alternatives win at the same position)."""
    words = vocabulary_words(vocabulary)
    pattern = f"(?:{BYTE_PAIR_PATTERN})|(?:{SEGMENT_PATTERN})|(?:{WORD_RUN_PATTERN})"
    cands = extract_all(prepared(text, lowercase), pattern)
    return _keep_vocabulary(cands, words, lambda t: t.contains(" ") | t.endswith(":"))


def vocabulary_pattern(vocabulary: Iterable[str] | None = None) -> str:
    """The literal alternation form ``\\b(w1|w2|...)\\b`` of a vocabulary,
    for engines or callers that want one regular expression."""
    import re

    words = vocabulary_words(vocabulary)
    return WORD_START + "(?:" + "|".join(re.escape(w) for w in words) + ")" + WORD_END


def ngrams(tokens, n: int) -> Column:
    """Space-joined sliding n-grams; fewer than ``n`` tokens give ``[]``."""
    if n < 1:
        raise ValueError("n must be >= 1")
    tokens = _col(tokens)
    grams = F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1),
                        lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def add_ngrams(df, n: int, input_col: str = "features", output_col: str = "features"):
    """``df`` with ``output_col`` = n-grams of ``input_col`` through the
    ``pyspark.ml`` ``NGram`` transformer (compiled; about twice as fast as
    the lambda form of ``ngrams``)."""
    from pyspark.ml.feature import NGram

    if n < 1:
        raise ValueError("n must be >= 1")
    if n == 1 and input_col == output_col:
        return df
    tmp = f"_{output_col}_ngram"
    out = NGram(n=n, inputCol=input_col, outputCol=tmp).transform(df)
    return out.drop(output_col).withColumnRenamed(tmp, output_col) if output_col in df.columns \
        else out.withColumnRenamed(tmp, output_col)


def join_token_lists(first, second) -> Column:
    """Token list of two texts joined by a blank line, from their own lists.

    Equal to tokenizing ``first + "\\n\\n" + second`` as long as ``first``
    was tokenized with a trailing line break (``with_line_break``): no token
    of the three kinds can cross a blank line.
    """
    return F.concat(_col(first), _col(second))


def with_line_break(text) -> Column:
    return F.concat(_col(text), F.lit("\n"))


def parse_int(text) -> Column:
    """String -> bigint; surrounding blanks allowed, anything else fails the
    job (independent of the session's ANSI setting)."""
    text = _col(text)
    parsed = F.regexp_replace(text, r"^\s+|\s+$", "").try_cast("bigint")
    return F.when(text.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("not an integer: '"), text, F.lit("'")))
                  ).otherwise(parsed)


def explode_tokens(df, tokens, alias: str = "term", keep=()):
    """One row per token: ``[*keep, alias]``.

    Uses ``explode_outer`` and drops the null row of an empty list
    afterwards.  Plain ``explode`` lets the optimizer infer a
    ``size(tokens) > 0`` filter and push it below the projection, which
    evaluates the whole tokenizer twice (and, below a repartition, in the
    scan task); tokens are never null, so the result is the same.
    """
    return (df.select(*keep, F.explode_outer(_col(tokens)).alias(alias))
            .where(F.col(alias).isNotNull()))
