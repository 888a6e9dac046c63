"""Texts that the tests make."""

import random

WORDS = ("the of and a to in is was river stone green early morning walked under seven lanterns while quiet market "
         "opened its doors beside an old canal where children sang about winter ships and bread").split()


def prose(seed: int, words: int) -> str:
    chosen = random.Random(seed)
    return " ".join(chosen.choice(WORDS) + chosen.choice(["", "", "", ",", "."]) for _ in range(words))


def edited(text: str, every: int) -> str:
    words = text.split(" ")
    for at in range(every // 2, len(words), every):
        words[at] = f"edit{at}"
    return " ".join(words)
