"""Small documents tables for the tests of this folder."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHES = "doc long, tkey string, h int, rep string, gid int, spans string, score string, lang_pred int, n string, row int, sub string, first int"

SYLLABLES = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt"]


def word(r: random.Random) -> str:
    return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 3)))


def prose(r: random.Random, words: int, line: int = 12) -> str:
    out = [word(r) for _ in range(words)]
    return "\n".join(" ".join(out[i : i + line]) for i in range(0, words, line))


def corpus(seed: int = 5, n: int = 40) -> list[tuple]:
    """Documents with exact and near copies, shared passages inside and across lines, and repeats within a document."""
    r = random.Random(seed)
    passage, passage2 = prose(r, 60, 100), prose(r, 25, 100)
    texts = []
    for i in range(n):
        kind = r.randrange(8)
        text = prose(r, r.randint(1, 160))
        if kind == 1 and texts:
            text = r.choice(texts)
        elif kind == 2 and texts:
            words = r.choice(texts).split(" ")
            words[r.randrange(len(words))] = word(r)
            text = " ".join(words)
        elif kind == 3:
            text = text[: len(text) // 2] + passage + text[len(text) // 2 :]
        elif kind == 4:
            text = f"{text}\n{passage2}\n{prose(r, 20)}\n{passage2}"
        elif kind == 5:
            text = "é" + text.upper() + "ß 漢字"
        texts.append(text)
    return [(i, t, r.choice(["en", "fr", None]), f"src{i % 3}", len(t)) for i, t in enumerate(texts)]


def odd_rows() -> list[tuple]:
    """Nulls, empty texts, repeated rows, one id with different texts."""
    r = random.Random(9)
    text = prose(r, 80)
    return [
        (None, None, None, None, None),
        (None, text, None, None, None),
        (100, None, "en", None, None),
        (101, "", "en", "s", 0),
        (102, " \n\t ", "en", "s", 4),
        (103, text, "en", "s", 1),
        (103, text, "en", "s", 1),
        (104, text + " x", "fr", "s", 1),
        (104, "other " + text, "fr", "s", 1),
        (105, "a", "fr", "s", 1),
        (106, "a", None, "s", 1),
        (107, "word " * 3000, None, "s", 1),
        (108, "!!! 123 ...", None, "s", 1),
    ]


def frame(spark, rows, parts: int = 3):
    df = spark.createDataFrame(rows, DOCS)
    return df.repartition(parts) if rows else df


def with_clashes(spark, rows):
    names = CLASHES.split(", ")
    return spark.createDataFrame([(*r, *[None] * len(names)) for r in rows], f"{DOCS}, {CLASHES}")


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def union_find(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
