"""Tokenizers, views and n-grams (golden values: FIXTURES.md section 3)."""

import random
import re

from pyspark.sql import functions as F

from conftest import ASM0, BYTES0, VOCAB0
from corpusml.functions import (
    DEFAULT_OPCODES, asm_listing, asm_tokens, byte_tokens, hex_dump, joint_tokens, ngrams,
    vocabulary_pattern, with_line_break,
)
from corpusml.functions.tokens import SEGMENT_PATTERN, BYTE_PAIR_PATTERN


def one(spark, *cols):
    df = spark.createDataFrame([(BYTES0, ASM0)], "b string, a string")
    return df.select(*cols).collect()[0]


def test_byte_tokens_golden(spark):
    r = one(spark, byte_tokens("b"), byte_tokens("b", True), byte_tokens("a"), byte_tokens("a", True))
    assert r[0] == "56 8D 44 24 08 50 8B F1 2A E8 1C 1B 00 00".split()
    assert r[1] == "56 44 24 08 50 00 00".split()
    assert r[2] == "56 8D 44 24".split()
    assert r[3] == "56 44 24".split()


def test_joint_tokens_golden(spark):
    r = one(spark, joint_tokens("b", VOCAB0), joint_tokens("b", VOCAB0, True),
            joint_tokens("a", VOCAB0), joint_tokens("a", VOCAB0, True))
    assert r[0] == ["56 8D", "44 24", "08 50", "8B F1", "E8 1C", "1B 00"]
    assert r[1] == ["44 24", "08 50", "00 00"]
    assert r[2] == [".text:", "56 8D", "44 24", "lea", ".text:", "mov", ".rsrc:", "push", "call"]
    assert r[3] == [".text:", "44 24", "lea", "mov", ".rsrc:", "push", "call"]


def test_asm_tokens_golden(spark):
    r = one(spark, asm_tokens("a", VOCAB0), asm_tokens("a", VOCAB0, True))
    assert r[0] == [".text:", "lea", ".text:", "mov", ".rsrc:", "push", "call"]
    assert r[1] == [".text:", "lea", "mov", ".rsrc:", "push", "call"]


def _random_listing(rng, vocab):
    words = list(vocab) + ["eax", "ebp", "dword", "ptr", "été", "éjmp", "mov_x", "call9", "A1", "FF"]
    lines = []
    for i in range(40):
        seg = rng.choice([".text:", "HEADER:", "x:", ".data:", ""])
        addr = "%08X" % rng.randrange(0, 1 << 32) if rng.random() < 0.8 else "0040"
        body = " ".join(rng.choice(words + ["%02X" % rng.randrange(256) for _ in range(6)])
                        for _ in range(rng.randrange(0, 9)))
        lines.append(f"{seg}{addr}{rng.choice([' ', chr(9), ''])}{body}")
    return "\n".join(lines)


def test_vocabulary_filter_equals_alternation(spark):
    """Whole-word candidates filtered by the vocabulary == one big regex."""
    rng = random.Random(7)
    vocab = ["mov", "push", "in", "ins", "call", "a", "jz"]
    texts = [(_random_listing(rng, vocab),) for _ in range(30)]
    df = spark.createDataFrame(texts, "t string")
    asm_re = f"(?:{SEGMENT_PATTERN})|{vocabulary_pattern(vocab)}"
    joint_re = f"(?:{BYTE_PAIR_PATTERN})|(?:{SEGMENT_PATTERN})|{vocabulary_pattern(vocab)}"
    rows = df.select(asm_tokens("t", vocab).alias("a1"), F.regexp_extract_all("t", F.lit(asm_re), 0).alias("a2"),
                     joint_tokens("t", vocab).alias("j1"), F.regexp_extract_all("t", F.lit(joint_re), 0).alias("j2"),
                     "t").collect()
    for r in rows:
        assert r.a1 == r.a2
        assert r.j1 == r.j2
        # same as Python's re with ASCII word boundaries
        py = re.findall(joint_re, r.t, flags=re.ASCII)
        assert r.j1 == py


def test_joint_split_equals_concatenation(spark):
    """tokens(b + "\\n") ++ tokens(a) == tokens(b + "\\n\\n" + a)."""
    rng = random.Random(3)
    rows = []
    for _ in range(20):
        b = _random_listing(rng, VOCAB0)
        if rng.random() < 0.5:
            b += "\nseg:0040100A"  # a segment title that needs the separator
        rows.append((b, _random_listing(rng, VOCAB0)))
    df = spark.createDataFrame(rows, "b string, a string")
    out = df.select(F.concat(joint_tokens(with_line_break("b"), VOCAB0), joint_tokens("a", VOCAB0)).alias("x"),
                    joint_tokens(F.concat("b", F.lit("\n\n"), "a"), VOCAB0).alias("y")).collect()
    assert all(r.x == r.y for r in out)


def test_word_boundary_is_ascii(spark):
    df = spark.createDataFrame([("émov mov_ mov éjz jz, in-call",)], "t string")
    # accented letters are not word characters: "émov" holds the word "mov"
    got = df.select(asm_tokens("t", ["mov", "jz", "in", "call"])).first()[0]
    assert got == ["mov", "mov", "jz", "jz", "in", "call"]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],), (["a"],), ([],)], "t array<string>")
    out = [r[0] for r in df.select(ngrams("t", 2)).collect()]
    assert out == [["a b", "b c", "c d"], [], []]
    assert [r[0] for r in df.select(ngrams("t", 1)).collect()] == [["a", "b", "c", "d"], ["a"], []]


def test_ngrams_equal_ml_ngram(spark):
    from pyspark.ml.feature import NGram
    rng = random.Random(1)
    rows = [([rng.choice("abcde") for _ in range(rng.randrange(0, 9))],) for _ in range(50)]
    df = spark.createDataFrame(rows, "t array<string>")
    for n in (1, 2, 3):
        ml = NGram(n=n, inputCol="t", outputCol="g").transform(df)
        assert all(r.g == r.h for r in ml.select("g", ngrams("t", n).alias("h")).collect())


def test_hex_dump_layout(spark):
    text = "héllo wörld, 0123456789abcdef!"
    dump = spark.createDataFrame([(text,), ("",)], "t string").select(hex_dump("t")).collect()
    data = text.encode("utf-8")
    want = "\n".join("%08X" % (0x401000 + i) + "".join(" %02X" % x for x in data[i:i + 16])
                     for i in range(0, len(data), 16))
    assert dump[0][0] == want
    assert dump[1][0] == ""


def test_listing_layout(spark):
    out = spark.createDataFrame([("mov a\n\npush b",)], "t string").select(asm_listing("t")).first()[0]
    assert out == "HEADER:00401000 mov a\n.text:00401010 \n.text:00401020 push b"


def test_default_opcodes():
    assert len(DEFAULT_OPCODES) > 300
    assert {"mov", "lea", "jz", "mul", "not", "push", "call", "cmovnz", "setnle", "stosd"} <= set(DEFAULT_OPCODES)
    assert list(DEFAULT_OPCODES) == sorted(set(DEFAULT_OPCODES))


def test_byte_capture_form_equals_lookbehind(spark):
    from corpusml.functions.tokens import BYTE_PATTERN
    rng = random.Random(11)
    alphabet = ["AB", "0F", "??", " ", "  ", "ABC", "\n", "00401000", "a1", "G7", "9"]
    rows = [("".join(rng.choice(alphabet) + rng.choice([" ", ""]) for _ in range(60)),) for _ in range(200)]
    df = spark.createDataFrame(rows, "t string")
    for low in (False, True):
        out = df.select(byte_tokens("t", low).alias("a"),
                        F.regexp_extract_all(F.lower("t") if low else F.col("t"), F.lit(BYTE_PATTERN), 0).alias("b"))
        assert all(r.a == r.b for r in out.collect())


def test_tokens_only_listed_words(spark):
    """Property: every asm/joint token is a segment title, a byte pair or a listed word."""
    from corpusml.plans import tables as tb
    vocab = set(tb.LISTING_WORDS)
    for kind in ("asm", "joint"):
        c = tb.corpus(spark, "/root/testdata/sf0.001", kind)
        toks = {r.t for r in c.select(F.explode("features").alias("t")).distinct().collect()}
        assert toks
        for t in toks:
            assert t in vocab or t.endswith(":") or re.fullmatch(r"[0-9A-F]{2} [0-9A-F]{2}", t), (kind, t)
