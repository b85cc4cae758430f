"""Small inputs with the cases that every operator must stand."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, length long, uid long, _row long, salt string"
WORDS = "the of and to in water house green tree river stone light early morning walk people never again small garden".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ing", ",", "."]) for _ in range(n))


def documents(spark, rows: list[tuple]):
    """(doc_id, text[, lang, source]) with further columns whose names operators use inside."""
    full = [(r[0], r[1], *(r[2:4] or ("en", "a")), None if r[1] is None else len(r[1]), 7, 8, 9, "x") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows() -> list[tuple]:
    """Null id, null and empty and blank texts, repeated rows, one id with two texts, a very long text."""
    long = prose(1, 40_000)
    return [
        (None, "a text without an id"), (None, None), (1, None, None, None), (2, ""), (3, " \n\t "), (4, "same text here"), (4, "same text here"),
        (5, "same text here"), (4, "another text of the same id"), (6, long), (7, long[:-30] + "it ends in another way"), (8, "é ß  Ünï cöde 漢字 <|endoftext|> end"),
        (9, "x"), (10, "WARC/1.1\r\ntrap"),
    ]
