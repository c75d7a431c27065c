"""Small tables with every odd case: nulls in any column, empty and very long texts, ties, repeated rows, clashing names."""

import random

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 977}" for i in range(40_000))
ODD = [
    (1, None, "en", "s1", None),
    (2, "", "en", "s1", 0),
    (3, " \t\n\x0b\x0c\r ", None, None, 7),
    (4, LONG, "en", "s2", len(LONG)),
    (5, "x" * 50_000, "de", "s2", 50_000),
    (6, "same text here for all of us", "en", "s1", 28),
    (6, "same text here for all of us", "en", "s1", 28),
    (7, "same text here for all of us", None, "s1", 28),
    (None, "a row without an id", "fr", None, 19),
    (None, None, None, None, None),
    (8, "ünïcode — 日本語 😀 ▁ \u00a0 \u2003 x\u0000y", "xx", "s3", -5),
]


def odd(spark, rows=None):
    return spark.createDataFrame(ODD if rows is None else rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return (text or "").encode("utf-8", "surrogatepass").split()


def prose(seed, n=120):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("ba", "ko", "mi", "ru", "te", "lo") for b in ("na", "si", "vo", "du", "pe", "ga", "ri")]
    return " ".join(rng.choice(vocab) for _ in range(n))
