"""Column functions: tokenizers, n-grams, text views, default vocabulary."""

from corpusml.functions.opcodes import DEFAULT_OPCODES
from corpusml.functions.tokens import (
    add_ngrams, asm_tokens, byte_tokens, explode_tokens, joint_tokens, join_token_lists, ngrams, parse_int,
    vocabulary_pattern, with_line_break,
)
from corpusml.functions.views import asm_listing, hex_dump

__all__ = [
    "DEFAULT_OPCODES", "add_ngrams", "asm_listing", "asm_tokens", "byte_tokens", "explode_tokens", "hex_dump", "joint_tokens",
    "join_token_lists", "ngrams", "parse_int", "vocabulary_pattern", "with_line_break",
]
