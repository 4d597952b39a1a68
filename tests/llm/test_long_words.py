"""Texts without white space are read to their end by the quality features."""

import numpy as np
import pyarrow as pa

from isobar.llm import ordinal


def parts(text):
    at, values, _ = ordinal.features(pa.array([text]), ordinal.WIDTH)
    return dict(zip(at.tolist(), values.tolist()))


def test_every_part_of_a_long_word_counts():
    one = "文字" * 500
    middle = one[:400] + "A9-" * 40 + one[520:]
    assert len(one) == len(middle) and one[:64] == middle[:64] and one[-8:] == middle[-8:]
    assert parts(one) != parts(middle)


def test_offsets_follow_the_pieces():
    texts = ["a b", None, "x" * 130 + " y", ""]
    flat, begin = ordinal.cut_long(*ordinal.words(pa.array(texts)))
    assert flat.to_pylist() == ["a", "b", "x" * 64, "x" * 64, "xx", "y"]
    assert np.array_equal(begin, [0, 2, 2, 6, 6])
