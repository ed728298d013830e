"""Rows that every operator must take, and the place of the given tables."""

import os

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")

#: Nulls, empty texts, ties, repeated rows, white space of all kinds, and a long text.
ODD = [
    (None, None), (None, None), (None, "same text here"), (1, ""), (2, None), (3, "Same TEXT here"),
    (3, "same text here"), (3, "same text here"), (4, "\n\n \t"), (5, "É same text here"),
    (6, "one\x0btwo\x1cthree four five"), (7, "word " * 9000), (8, "a" * 140_000),
    (9, "🙂" * 3 + " done."), (10, "line one of it.\nline two of it.\nline three."),
]
