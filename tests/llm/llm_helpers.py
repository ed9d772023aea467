"""Helpers of the tests of the training-data operators."""

import numpy as np


def sentence(seed, n, vocabulary=400):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" + "." * (x % 7 == 0) for x in rng.integers(0, vocabulary, n).tolist())
