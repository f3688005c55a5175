"""Text views: a hex dump and an assembly-style listing of any text column.

They turn a text table into the two document kinds the classifier reads
(``.bytes`` hex dumps and ``.asm`` listings), entirely as column
expressions: no per-row Python, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dump / listing layout.
BYTES_PER_LINE = 16
BASE_ADDRESS = 0x00401000
HEADER_SEGMENT = "HEADER:"
CODE_SEGMENT = ".text:"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _address(offset: Column) -> Column:
    return F.lpad(F.hex(F.lit(BASE_ADDRESS) + offset), 8, "0")


def hex_dump(text, bytes_per_line: int = BYTES_PER_LINE) -> Column:
    """UTF-8 bytes of ``text`` as lines ``AAAAAAAA XX XX ...`` (upper case),
    ``bytes_per_line`` bytes per line, addresses from ``BASE_ADDRESS``.

    Linear in the text: one pass cuts the digits into fixed-width lines, then
    each line gets its blanks (one match for a full line) and its address
    (no per-line ``substring``, which would rescan the string from its start).
    """
    digits = 2 * bytes_per_line
    chunks = F.regexp_extract_all(F.hex(F.encode(_col(text), "UTF-8")), F.lit(f".{{1,{digits}}}"), 0)
    full, blanks = "(..)" * bytes_per_line, "".join(f" ${k}" for k in range(1, bytes_per_line + 1))
    lines = F.transform(chunks, lambda line, i: F.concat(
        _address(i * bytes_per_line),
        F.when(F.length(line) == digits, F.regexp_replace(line, full, blanks)).otherwise(
            F.regexp_replace(line, "(..)", " $1"))))
    return F.array_join(lines, "\n")


def asm_listing(text) -> Column:
    """Each line of ``text`` prefixed by a segment title and an address:
    ``HEADER:00401000 <line 0>``, then ``.text:00401010 <line 1>`` ..."""
    lines = F.split(_col(text), "\n")
    return F.array_join(
        F.transform(lines, lambda line, i: F.concat(
            F.when(i == 0, F.lit(HEADER_SEGMENT)).otherwise(F.lit(CODE_SEGMENT)),
            _address(i * BYTES_PER_LINE), F.lit(" "), line)),
        "\n")
