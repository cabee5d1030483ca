"""Made-up texts for the tests."""

import random


def prose(seed, words, alphabet="abcdefgh"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 7))) for _ in range(words))
