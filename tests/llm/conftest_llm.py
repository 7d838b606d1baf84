"""Texts for the tests."""

from __future__ import annotations

import random


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(words))
