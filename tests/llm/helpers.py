"""Small tables and brute-force counterparts."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows, clashing column names."""
    long = "alpha beta gamma delta epsilon " * 20000
    rows = [
        (1, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 70),
        (2, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 70),
        (2, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 70),
        (3, None, "en", "b", None), (4, "", None, None, 0), (None, "lone row without an id but with enough words to count here", "en", None, 3),
        (None, None, None, None, None), (5, long, "en", "b", len(long)), (6, " \t\n\x0b\x0c\r ", "en", "", 7),
        (7, "one", "xx", "c", 3), (8, "nb sp line sep\u0085arates nothing \x1c here été ÀÉ ſK", "fr", "c", 4),
        (9, "<|endoftext|> \U0001f600 \U0001f600 漢字 кириллица " + "\x00 zero", "zh", "c", 4),
    ]
    return spark.createDataFrame([(*r, 1, "x", 0.5, "y") for r in rows], SCHEMA + ", size int, fp string, copies double, `key` string")


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")
