"""Small document tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

LETTERS = "abcdefghij"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 7))) for _ in range(words))


def awkward_rows() -> list[tuple]:
    """(doc_id, text, text_extra): nulls, blanks, copies, ties, a long text."""
    long = prose(1, 6000)
    base = prose(2, 120)
    near = base.split()
    near[60] = "changed"
    return [
        (1, None, "x"),
        (2, "", "x"),
        (3, " \t\n\x0b\x0c\r ", None),
        (4, "one", "x"),
        (5, "One  two\n\n three\r\n", "x"),
        (6, base, "x"),
        (7, base, "x"),
        (8, " ".join(near), "x"),
        (9, base.upper(), "x"),
        (10, long, "x"),
        (11, "naïve café ΑΣ İzmir 中文 字 x　y \x1c z <|endoftext|> 😀", "x"),
        (12, "one", "x"),
        (None, "null id", "x"),
        (13, "repeated row", "x"),
        (13, "repeated row", "x"),
    ]


def docs(spark, rows=None):
    """With extra columns whose names the operators use themselves."""
    rows = awkward_rows() if rows is None else rows
    return spark.createDataFrame(
        [(i, t, e, 7, "s", [1]) for i, t, e in rows],
        "doc_id long, text string, ids string, score int, rules string, tokens array<int>",
    )
