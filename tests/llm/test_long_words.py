"""Words without spaces of any length: the same counts slice by slice, in memory that doesn't grow with the word."""

import random
import tracemalloc

import public_tokenizers
import pytest

from ledgermill.llm import token_counts

PIECES = [("▁", -2.0), ("▁a", -1.5), ("a", -2.0), ("ab", -2.5), ("abab", -4.0), ("b", -2.0), ("aab", -4.5), ("é", -3.0), ("éa", -5.0), ("漢字漢", -1.0), ("ababababab", -6.0)]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 100_000])
def test_slices_of_any_size(size):
    r, c = random.Random(size), token_counts.Counter(PIECES)
    for n in (1, 2, 9, 50, 400):
        for _ in range(10):
            word = "".join(r.choices("aabbé漢字🙂x", k=n)).encode()
            assert c.pieces_of_slices(word, size) == c.pieces(token_counts.SPACE + word.decode())
    broken = b"ab\xe6\xbc" + b"ab\xff" * 5 + b"\xe6"  # no UTF-8
    assert c.pieces_of_slices(broken, size) == c.pieces(token_counts.SPACE + broken.decode("utf-8", "replace"))


def test_real_vocabulary_and_memory():
    c = token_counts.Counter(token_counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    r = random.Random(1)
    word = "".join(r.choices("etaoinshrdlucmé漢字", k=200_000)).encode()
    assert c[word] == c.pieces(token_counts.SPACE + word.decode()) and word not in dict(c)
    peaks = []
    for times in (1, 8):
        long = word * times
        tracemalloc.start()
        c.pieces_of_slices(long, token_counts.LONG_WORD)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.2 * peaks[0] < 4 << 20
