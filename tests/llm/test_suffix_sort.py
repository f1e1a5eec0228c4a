import random

import numpy as np

from martflow.llm.suffix_sort import blind_trie, deep_shallow, shallow_sort


def texts(rng, n, alphabet, length):
    out = []
    for _ in range(n):
        t = bytearray(rng.choice(out) if out and rng.random() < 0.7 else bytes(rng.choice(alphabet) for _ in range(length)))
        if rng.random() < 0.5:
            t[rng.randrange(length)] = rng.choice(alphabet)
        out.append(bytes(t))
    return out


def test_blind_trie_orders_and_finds_equal_texts():
    rng = random.Random(1)
    for alphabet in (b"ab", bytes(range(256))):
        for n in (0, 1, 2, 50, 400):
            ts = texts(rng, n, alphabet, 30)
            classes = blind_trie(ts)
            assert [ts[i] for c in classes for i in c] == sorted(ts)
            assert all(len({ts[i] for i in c}) == 1 for c in classes)
            assert len(classes) == len(set(ts))


def test_deep_shallow_is_a_suffix_sort():
    rng = random.Random(2)
    for alphabet, shallow in ((b"a", 8), (b"ab", 8), (b"ab", 24), (b"abcdefgh", 16)):
        data = b"".join(texts(rng, 40, alphabet, 50))
        at = np.arange(len(data) - 40)
        padded = np.frombuffer(data + bytes(16), dtype=np.uint8)
        group = (at % 3).astype(np.int64)
        order, run = deep_shallow(padded, at, group, 40, shallow)
        got = [(group[i], data[at[i]:at[i] + 40]) for i in order]
        assert got == sorted(got)
        runs = np.concatenate(([0], np.cumsum([a != b for a, b in zip(got, got[1:])])))
        assert (run == runs).all()
    order, run = shallow_sort(np.zeros(16, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), 8)
    assert len(order) == len(run) == 0
