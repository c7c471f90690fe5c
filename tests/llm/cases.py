"""Documents with the awkward cases that every operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, length string, __mix_source string, pattern string, node string"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(words)]
    return " ".join(w + rng.choice(["", "", "", ".", ",", "\n"]) for w in made)


def documents(spark, extra: list[tuple] = ()):
    """Clashing columns hold text; rows hold nulls, empties, copies, repeated rows, ties and a very long text."""
    rows = [(i, prose(i, 60 + 7 * i), "en", f"src{i % 3}") for i in range(24)]
    rows += [(100 + i, prose(3, 81), "en", "src0") for i in range(3)]  # copies
    rows += [rows[5], rows[5]]  # repeated rows
    rows += [(200, "", "en", "src1"), (201, None, None, None), (202, " \n\t ", "fr", None), (None, prose(77, 90), "en", "src2"), (203, "one two", "en", "")]
    rows += [(204, prose(9, 30_000), "en", "src1"), (205, "Übergrößen ναός ΝΑΟΣ 漢字 e\u0301 \u00a0x\u2003y <|endoftext|>z <s> it's 1234 🎉 ", "de", "src1")]
    rows += list(extra)
    return spark.createDataFrame([(d, t, la, s, None if t is None else len(t), "x", "y", "z", "p", "q") for d, t, la, s in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
