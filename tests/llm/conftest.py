from __future__ import annotations

import random

import pytest

#: Columns beside those of documents, with names that the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, row string, own int, ids int, spans string, score double, cell int"


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    parts = ["an", "ber", "cor", "du", "el", "fi", "gra", "ho", "in", "ju"]
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def table(spark):
    """Build a documents table from (doc_id, text) pairs, with clashing columns."""

    def build(pairs):
        rows = [(i, t, None, "s", None if t is None else len(t), "k", "r", 1, 2, "x", 0.5, 3) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return build


@pytest.fixture(scope="session")
def odd_pairs():
    """Nulls, empty and very long texts, repeated rows, equal texts, special strings and rare characters."""
    long = prose(99, 30_000)
    passage = prose(5, 60)
    return [
        (0, None),
        (1, ""),
        (2, " \n\t "),
        (3, long),
        (4, long),
        (4, long),
        (None, prose(1, 80)),
        (None, None),
        (5, "x"),
        (6, "end<|endoftext|>of text ½²³ Ⅷ \x1c\x85 　 </s> é́"),
        (7, f"{prose(7, 30)} {passage} {prose(8, 20)}"),
        (8, f"{prose(9, 10)}  {passage}\n{prose(10, 25)}"),
        (8, prose(11, 70)),
        (9, "a" * 20_000),
        (10, "Der " * 3_000),
        (11, "UPPER lower UPPER"),
        (12, "ⓐ▁▁b  c "),
        (13, passage),
        (2**62, "large id"),
        (-3, prose(12, 120)),
    ]
