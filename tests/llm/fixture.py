"""A small table of awkward documents: NULLs in every column, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid string, key string, `row` int, place int, id string, copy int, found int, `a.b` int"


def rows(seed: int = 0) -> list[tuple]:
    r = random.Random(seed)
    vocabulary = {"en": ["the", "and", "thing", "over", "house", "wind", "there", "shall"],
                  "de": ["und", "nicht", "über", "straße", "zwischen", "haus", "wäre"]}

    def prose(lang: str, n: int) -> str:
        return " ".join(r.choice(vocabulary[lang]) + str(r.randrange(400)) * (r.random() < 0.7) for _ in range(n))

    base = prose("en", 120)
    changed = base.split()
    changed[60] = "altered"
    other = base.split()
    other[10] = "elsewhere"
    far = base.split()
    for k in range(0, 120, 9):
        far[k] = f"x{k}"
    line = "a line that comes again and again, long enough to be more than one hundred bytes when it is counted in full.\n"
    texts = [
        (1, base, "en", "b"), (2, " ".join(changed), "en", "b"), (3, base.replace(" ", "  \t"), "en", None),
        (4, " ".join(far), "en", "a"), (5, base, "en", "a"), (5, base, "en", "a"), (6, "", "en", "a"), (7, None, None, "c"),
        (None, " ".join(other), None, "c"), (None, None, "de", None), (8, "one two", "en", "d"), (9, "ONE Two", "en", "d"),
        (10, " \n ", "en", "d"), (11, "12 34 !!", "en", "d"), (12, prose("de", 60), "de", "é"), (13, prose("de", 40000), "de", "b"),
        (14, line * 3 + "end", "en", "Z"), (15, "start " + line + prose("en", 30), "en", "z"), (16, prose("en", 50), "en", "z"),
        (17, "naïve Ünï ΣΑΣ İ <|endoftext|> don't", "en", "z"), (18, prose("de", 80), "de", "z"), (19, prose("en", 80), "en", "z"),
        (20, prose("de", 70), "de", "z"), (21, prose("en", 90), "en", "z"),
    ]
    return [(i, t, g, s, None if t is None else len(t), "clash", None, 3, 4, "x", 5, 6, 7) for i, t, g, s in texts]


def documents(spark, n_partitions: int = 3):
    return spark.createDataFrame(rows(), SCHEMA).repartition(n_partitions)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
