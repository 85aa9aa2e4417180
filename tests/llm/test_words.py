import random
import re

import numpy as np
import pyarrow as pa

from tallystock.llm.repeats import pack, unpack
from tallystock.llm.words import ragged, slices, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def odd_texts(n, seed=1):
    r = random.Random(seed)
    parts = ["a", "b", "é", "国", " ", "  ", "\n", "\t", "A", "\x85", "\xa0", "😀", "\x1c", "."]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(n)] + ["", None, " ", "x"]


def test_words_are_those_of_the_pattern():
    texts = odd_texts(300)
    w = words(pa.array(texts, pa.string()).slice(5))
    assert len(w.first) == len(texts) - 5 + 1
    for k, t in enumerate(texts[5:]):
        assert [w.text(i) for i in range(w.first[k], w.first[k + 1])] == WORD.findall(t or "")
    by_text = {}
    for i, h in enumerate(w.hash):
        assert by_text.setdefault(w.text(i), h) == h
    assert len(set(by_text.values())) == len(by_text)


def test_windows_stay_in_their_row_and_depend_on_words_alone():
    w = words(pa.array(["a b c d", "b c d", "", "x", "a b"]))
    at, hashes = w.windows(3)
    assert at.tolist() == [0, 1, 4]
    assert hashes[1] == hashes[2] != hashes[0]


def test_slices_hold_every_row_once():
    texts = pa.array(["x" * 3_000_000, None, "y", "z" * 400_000, "z" * 400_000])
    found = list(slices(texts))
    assert [at for at, _ in found] == [0, 1, 4]
    assert sum(len(p) for _, p in found) == 5


def test_ragged_and_packed_hashes():
    assert ragged(np.array([5, 0, 9]), np.array([2, 0, 1])).tolist() == [5, 6, 9]
    values = np.sort(np.random.default_rng(1).integers(0, 2**64, 999, dtype=np.uint64))
    assert (unpack(pack(values)) == values).all()
