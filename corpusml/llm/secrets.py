"""Secret scan: patterns, plus a token-efficiency test for random strings.

Base kinds are the leftmost non-overlapping matches of fixed patterns that
pass a length test.  The method adds kind ``random``: a maximal run of key
characters that a byte-level BPE vocabulary cannot shorten (few characters
per token) and that is no known digest or identifier.  Of a run that it can
shorten, or that touches a base span, the parts between ``= / _ -`` are
judged alike, so a readable path or key name hides nothing behind it.

Defined cases: null text is an empty text; offsets are code points, ends
exclusive; a random span that touches a base span adds nothing; repeated
rows are separate rows; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import text_or_empty
from corpusml.llm.packing import byte_bpe, vocabulary_path

# Fixed patterns and lengths of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the same as maximal runs of 32 or more
KINDS = ("assign", "access", "hex", "random")
ASSIGN_CHARS, ACCESS_CHARS = 8, 16

#: Runs of key characters worth a look, and characters per token below which one is random.
LEAST = 20
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % LEAST)
PART = re.compile(r"[A-Za-z0-9+]+")
CHARS_PER_TOKEN = 2.1
# Known digests (hexadecimal, by length) and identifiers.
_DIGEST = (
    r"[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"
    r"|[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")  # UUID
# Digest bytes by algorithm.
_DIGEST_BYTES = {"md5": 16, "sha1": 20, "sha224": 28, "sha256": 32, "sha384": 48, "sha512": 64}


def _named_digest(name: str, size: int) -> str:
    """A digest of ``size`` bytes behind its name, in hexadecimal or base64."""
    return rf"{name}-([0-9a-fA-F]{{{2 * size}}}|[A-Za-z0-9+/_-]{{{-(-8 * size // 6)}}}={{0,{-size % 3}}})"


KNOWN = re.compile("|".join([
    _DIGEST,
    r"[0-9+/_=-]+",  # numbers, dates, rules
    *(_named_digest(*digest) for digest in _DIGEST_BYTES.items())]))
KNOWN_PART = re.compile(rf"(?<![A-Za-z0-9+])({_DIGEST})(?![A-Za-z0-9+])")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def random_parts(run: str, bpe, chars_per_token: float = CHARS_PER_TOKEN) -> list[tuple[int, int]]:
    """``(start, end)`` of random stretches inside a readable run: parts
    between separators that together stay below the ratio (separators are
    neither characters nor tokens here) and reach ``LEAST`` characters."""
    found = []

    def judge(parts: list[tuple[int, int, float]]) -> None:
        first = 0
        while first < len(parts):
            # From a part below the ratio on as long as the sum is, back to where it was largest.
            total, most, last, k = 0.0, 0.0, first, first
            while k < len(parts):
                total += parts[k][2]
                if total <= 0:
                    break
                if total >= most:
                    most, last = total, k
                k += 1
            if most <= 0:
                first += 1
                continue
            a, b = first, last
            # A short stretch takes in neighbours that leave it below the ratio.
            while parts[b][1] - parts[a][0] < LEAST:
                sides = [(parts[x][2], x) for x in (a - 1, b + 1) if 0 <= x < len(parts)]
                worth, x = max(sides, default=(-most, a))
                if most + worth <= 0:
                    break
                most, a, b = most + worth, min(a, x), max(b, x)
            start, end = parts[a][0], parts[b][1]
            if end - start >= LEAST and not KNOWN.fullmatch(run, start, end):
                found.append((start, end))
            first = max(last, b) + 1

    stretch, known = [], [m.span() for m in KNOWN_PART.finditer(run)]
    for m in PART.finditer(run):
        start, end = m.span()
        while known and known[0][1] <= start:
            known.pop(0)
        if known and known[0][0] < end:
            judge(stretch)
            stretch = []
        else:
            stretch.append((start, end, chars_per_token * len(bpe.encode_ordinary(m[0])) - (end - start)))
    judge(stretch)
    return merged(found)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def random_spans(text: str, bpe, taken: list[Span], chars_per_token: float = CHARS_PER_TOKEN) -> list[Span]:
    """Runs that the vocabulary hardly shortens, and such parts of the other
    runs, outside ``taken``."""
    found = []
    for m in RUN.finditer(text):
        run, (start, end) = m[0], m.span()
        if KNOWN.fullmatch(run):
            continue
        touched = any(s < end and start < e for _, s, e in taken)
        if not touched and len(run) < chars_per_token * len(bpe.encode_ordinary(run)):
            found.append(("random", start, end))
            continue
        found += [("random", start + a, start + b) for a, b in random_parts(run, bpe, chars_per_token)
                  if not any(s < start + b and start + a < e for _, s, e in taken)]
    return found


def listed(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
         chars_per_token: float = CHARS_PER_TOKEN) -> DataFrame:
    """``[id_col, n_assign, n_access, n_hex, n_random, base_spans, spans]``
    with spans as ``kind:start:end`` lists."""
    path = vocabulary or vocabulary_path()

    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_random long, base_spans string, spans string")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(path)
        for texts in batches:
            rows = []
            for text in texts:
                base = base_spans(text)
                added = random_spans(text, bpe, base, chars_per_token)
                kinds = [s[0] for s in base + added]
                rows.append((*map(kinds.count, KINDS), listed(base), listed(base + added)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_random", "base_spans", "spans"])

    return docs.select(F.col(id_col), find(text_or_empty(text_col)).alias("f")).select(id_col, "f.*")
