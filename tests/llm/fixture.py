"""A small corpus with the hard cases: nulls, blanks, copies, repeated rows, clashing columns."""

from __future__ import annotations

import random
import zlib

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, label string, n bigint, path string, size int"
VOCABULARY = {
    "en": "the of and with river stone market window garden letter winter bridge summer paper kitchen morning".split(),
    "fr": "le la de une rivière pierre marché fenêtre jardin lettre hiver été papier cuisine matin château".split(),
}


def texts() -> dict[int, str | None]:
    rnd = random.Random(5)
    out: dict[int, str | None] = {}
    for i in range(60):
        words = VOCABULARY["fr" if i % 3 == 0 else "en"]
        lines = [" ".join(rnd.choice(words) + str(rnd.randrange(30)) * (rnd.random() < 0.5) for _ in range(rnd.randrange(3, 40))) for _ in range(rnd.randrange(1, 6))]
        out[i] = ("\n" if i % 2 else " \t ").join(lines)
    passage = " ".join(rnd.choice(VOCABULARY["en"]) + str(rnd.randrange(90)) for _ in range(90))
    for i in range(60, 76):  # one passage in many texts, at different places
        own = " ".join(rnd.choice(VOCABULARY["en"]) + str(rnd.randrange(500)) for _ in range(20 + i % 7))
        out[i] = f"{own} {passage} {own[::-1]}"
    for i in range(76, 84):  # near copies: a word replaced
        words = out[i - 70].split(" ")
        words[len(words) // 2] = "changed"
        out[i] = " ".join(words)
    out |= {84: None, 85: "", 86: " \n\t ", 87: "...", 88: "x", 89: out[3], 90: out[4].upper(), 91: "é" * 1000, 92: "ab " * 700, 93: "ab " * 700, 94: " word\x1cwith odd spaces ", 95: "İIΣ <|endoftext|> don't 3/4"}
    return out


def rows() -> list[tuple]:
    out = []
    for i, t in texts().items():
        lang = None if i % 11 == 0 else "fr" if i < 60 and i % 3 == 0 else "en"
        out.append((i, t, lang, None if i % 9 == 0 else "big" if i % 3 else f"s{i % 4}", len(t or ""), "x", 7, "p", 3))
    return out


def documents(spark, extra: int = 0):
    made = rows()
    return spark.createDataFrame(made + made[:extra], SCHEMA)


def words(t: str | None) -> list[bytes]:
    return (t or "").encode().lower().split()


def crc(i: int, m: int) -> int:
    return zlib.crc32(str(i).encode()) % m
