"""Counts and keys of the language models at sizes no test table reaches."""

import numpy as np
import pytest

from sparkrisk.llm import language_models as lm
from sparkrisk.llm.common import stirred


@pytest.mark.parametrize("counts", [[], [0, 1, 255], [256], [2**32 - 1, 0], [2**32, 1], [7, 5 * 2**32 + 3]])
def test_counts_of_any_size_survive(counts):
    given = np.array(counts, np.int64)
    assert lm._counts(lm._squeeze(given)).tolist() == counts
    assert lm._counts(lm._squeeze(given.astype(float))).tolist() == counts


@pytest.mark.parametrize("numbers", [[], [0], [2**64 - 1], [1, 2, 2**32 + 5, 2**48 + 9, 2**63, 2**64 - 2]])
def test_keys_of_64_bits_survive(numbers):
    assert lm._unpack(lm._pack(np.array(numbers, np.uint64))).tolist() == numbers


def unstirred(y):
    def unshift(x, by):
        out = x
        for _ in range(64 // by + 1):
            out = x ^ (out >> by)
        return out

    mask = 2**64 - 1
    x = unshift(y, 31) * pow(0x94D049BB133111EB, -1, 2**64) & mask
    x = unshift(x, 27) * pow(0xBF58476D1CE4E5B9, -1, 2**64) & mask
    return unshift(x, 30)


def test_words_that_share_47_bits_stay_apart():
    close = [0x123456789ABC0002, 0x123456789ABC0004]
    words = np.array([unstirred(y) for y in close], np.uint64)
    assert stirred(words).tolist() == close
    assert len(set(lm._keys(words)[0].tolist())) == 2
