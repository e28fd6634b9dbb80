"""Made-up texts for the tests of the training-data operators."""

from __future__ import annotations

import random


def prose(seed: int, words: int) -> str:
    source = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ren", "tas", "ou", "pel", "dra", "ui", "so"]
    return " ".join("".join(source.choices(syllables, k=source.randint(1, 3))) for _ in range(words))
