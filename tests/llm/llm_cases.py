"""Shared cases: rows that every operator on texts must take."""

import zlib

DATA = "/root/testdata/sf0.001"

#: Nulls, empty and blank texts, ties, repeats, a long text and odd characters.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (6, "One TWO"), (7, "Ünïcode 中文 \U0001f600 x"),
    (8, "a" * 3000), (9, "word " * 2000), (10, "<|endoftext|> inside <|endoftext|>"), (11, "don't we'll  x y z"),
    (12, None), (13, "tab\tsep\x0bvt\x0cff\rcr"),
]


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())
