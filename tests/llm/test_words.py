import tracemalloc

import numpy as np

from gridtally.llm import words
from gridtally.llm.words import Scan

MASK = (1 << 64) - 1


def by_hand(data, start, end):
    """The hash of a byte range as it is defined: its place in the text cancels out."""
    total = sum(int(words._BYTE_VALUE[b]) * pow(int(words._BASE), i, 1 << 64) for i, b in enumerate(data[start:end]))
    return int(words.mix(np.array([total & MASK], dtype=np.uint64))[0])


def test_hashes_do_not_depend_on_the_place():
    near = words._BLOCK - 3
    texts = [b"across " + b"x" * (near - 8) + b" across", b"", b"a across\tb " * 30_000, b"across"]
    scan = Scan(texts)
    data = scan.data.tobytes()
    hashes = scan.word_hashes().tolist()
    places = list(zip(scan.word_start.tolist(), scan.word_end.tolist()))
    assert any(s < words._BLOCK < e for s, e in places[2:]) and places[-1][0] > 5 * words._BLOCK
    want = {w: by_hand(w, 0, len(w)) for w in {data[s:e] for s, e in places if e - s < 100}}
    assert all(h == want[data[s:e]] for h, (s, e) in zip(hashes, places) if e - s < 100)
    assert len(set(hashes)) == len(want) + 1
    assert hashes[1] == by_hand(data, *places[1])
    assert scan.hashes(np.array([0, len(data)]), np.array([0, len(data)])).tolist() == [0, 0]


def test_memory_of_a_scan():
    text = b"some words of a text " * 100_000
    Scan([b"warm"]).word_hashes()
    tracemalloc.start()
    try:
        Scan([text]).word_hashes()
        assert tracemalloc.get_traced_memory()[1] < 40 * len(text)
        # No table for so long a text stays.
        assert tracemalloc.get_traced_memory()[0] < len(text)
    finally:
        tracemalloc.stop()
