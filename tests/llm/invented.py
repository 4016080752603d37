"""Invented prose for the fixtures."""

from __future__ import annotations

import random

_SYLLABLES = "an er th ou re in st on ed ti ha es ea ng le".split()


def word(rng: random.Random) -> str:
    return "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4)))


def prose(rng: random.Random, n: int) -> str:
    return " ".join(word(rng) for _ in range(n))
