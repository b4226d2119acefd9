"""Rows that operators have to bear: nulls, empty and very long texts, repeated rows, columns with the operators' own names."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, rep int, n string, bands int, "
          "grp string, block string, salt int, rest string, toxic string, item_id string, digest string, score string")


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    words = [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    return " ".join(w + ("\n" if k % 17 == 16 else "") for k, w in enumerate(words))


def texts() -> list[tuple[int | None, str | None]]:
    base, long = prose(1, 120), prose(2, 30_000, 5000)
    shared = prose(3, 60)
    near = base.split(" ")
    near[50] = "other"
    return [
        (1, base), (2, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "one"),
        (9, long), (10, prose(4, 40) + " " + shared), (11, shared + " " + prose(5, 40)), (12, prose(6, 12)),
        (13, "Émile\x0bà\x0cla  plage\r\n" * 30), (None, base), (None, None), (14, "x" * 70_000), (15, shared.upper()),
        (16, "\x00   \x85 a b"), (17, prose(7, 500)),
    ]


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    filler = ("k", 1, "n", 2, "g", "b", 3, "r", "t", "i", "d", "s")
    return spark.createDataFrame([(d, t, "en", None, len(t) if t is not None else None, *filler) for d, t in rows], SCHEMA)


def words(text):
    return WORD.findall(text or "")
