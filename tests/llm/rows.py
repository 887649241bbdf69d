"""Rows for the tests."""

import random


def sentence(rng: random.Random, n: int, letters: str = "abcdefgh") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows, near copies."""
    rng = random.Random(4)
    long = "\n".join(sentence(rng, 40) for _ in range(120))
    body = sentence(rng, 90).split()
    near = body[:40] + ["changed"] + body[41:]
    shared = "A line that several documents hold"
    texts = [
        None, "", " \t\n", "word", "two words", "12 34 !!", long, long, " ".join(body), " ".join(near), f"{shared}\nmore {sentence(rng, 30)}",
        f"  {shared.upper()}  \n{sentence(rng, 30)}\n\n", f"{shared}\n{shared}", "x" * 30000, "Ünïcödé " * 30, "a b a b a b a b a b a b " * 6,
    ]
    rows = [(i, t, ("en", "de", None)[i % 3], ("s1", "s2", "s2", None)[i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [rows[8], rows[8], (None, texts[8], None, None, None), (None, None, None, None, None)]
