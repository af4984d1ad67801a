import numpy as np
import pyarrow as pa

from marquee.llm.words import Hashes, shared, shingle_sets, text_bytes


def _each(texts):
    data, offsets = text_bytes(pa.array(texts))
    return Hashes(data).of(offsets[:-1], offsets[1:])


def test_hashes_tell_different_strings_apart():
    twins = ["".join("ab"[i.bit_count() % 2 ^ flip] for i in range(2048)) for flip in (0, 1)]
    rng = np.random.default_rng(5)
    many = ["".join(rng.choice(list("ab"), int(n))) for n in rng.integers(0, 40, 5000)]
    blocks = ["12345678abcdefgh", "abcdefgh12345678", "12345678", "12345678\0", "\0", "", "a" * 16, "a" * 17]
    texts = sorted({*twins, *many, *blocks})
    assert len(np.unique(_each(texts))) == len(texts)


def test_hashes_depend_on_the_bytes_alone():
    texts = ["one", "naïve", "", "x" * 100, "one"]
    hashes = _each(texts)
    assert hashes[0] == hashes[4]
    for i, t in enumerate(texts):
        assert _each(["pad" * i, t, "tail"])[1] == hashes[i]


def test_shared_counts():
    x, y = ["a b c d", "a b", "", None, "p q r s t"], ["b c d e", "a b", "z", None, "p q r s t u"]
    assert shared(shingle_sets(pa.array(x), 2), shingle_sets(pa.array(y), 2)).tolist() == [2, 1, 0, 0, 4]
