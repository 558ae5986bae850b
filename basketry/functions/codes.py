"""Compressed member codes (I2): a keyed bijection from dense index to 5 base-36 characters."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, functions as F

# The code alphabet (note 7 before 6) and code width.
CODE_ALPHABET = "0123457689abcdefghijklmnopqrstuvwxyz"
CODE_WIDTH = 5
CODE_SPACE = len(CODE_ALPHABET) ** CODE_WIDTH  # 60,466,176 codes


def affine_key(seed: int) -> tuple[int, int]:
    """Multiplier coprime with the code space, and an offset, derived from ``seed``."""
    rng = random.Random(seed)
    while True:
        a = rng.randrange(1, CODE_SPACE)
        if math.gcd(a, CODE_SPACE) == 1:
            return a, rng.randrange(CODE_SPACE)


def code_of_index(index: str | Column, seed: int) -> Column:
    """The code of a dense index in ``[0, 36**5)``; distinct indices get distinct codes."""
    a, b = affine_key(seed)
    i = (F.col(index) if isinstance(index, str) else index).cast("long")
    n = F.pmod(i * F.lit(a) + F.lit(b), F.lit(CODE_SPACE))
    base = len(CODE_ALPHABET)
    chars = [
        F.substr(F.lit(CODE_ALPHABET), F.pmod(F.floor(n / F.lit(base ** k)), F.lit(base)).cast("int") + 1, F.lit(1))
        for k in range(CODE_WIDTH - 1, -1, -1)
    ]
    return F.concat(*chars)
