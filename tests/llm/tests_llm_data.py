"""Rows that every operator must stand."""


def messy(word="lorem"):
    """Texts that every operator must stand: null, empty, blank, very long,
    repeated, null ids, characters beyond ASCII."""
    long = " ".join(f"{word}{i % 977}" for i in range(30_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, long), (5, "one two three four five six"),
            (5, "one two three four five six"), (6, "one two three four five six"), (None, "no id here at all"),
            (None, None), (7, "é日本 \U0001f642 ΑΣ ß \x00 \x85 x"), (8, "word"), (9, "a" * 50_000, None)]
