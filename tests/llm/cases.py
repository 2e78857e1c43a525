"""Small inputs with the awkward rows that every operator must take."""

import random

WORDS = [a + b for a in ("ba", "ke", "li", "mo", "nu", "ra", "te", "vi") for b in ("", "den", "lor", "mis", "pan", "qua", "rot", "sul", "tem")]
CLASHING = "doc_id long, text string, id long, key string, cls long, n long, tokens string, range int, place string, component string, label int, kept boolean"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(words))


def edge_rows() -> list[tuple]:
    """(doc_id, text): nulls, empty and blank texts, repeated rows, equal
    texts, near copies, one very long text, non-Latin text."""
    base = prose(1, 300)
    near = base.replace(" moden ", " MODEN ", 2) + " and one more tail"
    return [
        (1, base),
        (2, base),
        (3, near),
        (4, None),
        (5, ""),
        (6, " \t\n "),
        (7, prose(2, 40)),
        (7, prose(2, 40)),
        (8, prose(3, 30_000)),
        (9, "日本語のテキスト 🎉 " * 20),
        (None, prose(4, 60)),
        (10, prose(5, 200) + " " + base[100:400] + " " + prose(6, 100)),
        (11, "one"),
        (12, "two words"),
        (13, "x" * 200),
    ]


def edge_frame(spark):
    """The rows with further columns named like the operators' own."""
    rows = [(i, t, -1, "k", -2, -3, "t", -4, "p", "c", -5, False) for i, t in edge_rows()]
    return spark.createDataFrame(rows, CLASHING)


def empty_frame(spark):
    return spark.createDataFrame([], "doc_id long, text string")
