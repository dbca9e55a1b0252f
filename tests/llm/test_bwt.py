import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from slabworks.llm import bwt

texts = st.lists(st.text(alphabet="ab", max_size=30).map(str.encode) | st.binary(max_size=12), min_size=1, max_size=9)


def suffixes(strings, depth, first=0):
    rows = []
    for s in strings:
        for i in range(len(s) + 1):
            tail = [x + 1 for x in s[i : i + depth]]
            rows.append(((tail + [0] * depth)[:depth], first + i, s[i - 1] + 1 if i else 0))
        first += len(s) + 1
    return sorted(rows)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(7, 30))
def test_build(strings, depth):
    got = bwt.build(strings, depth)
    want = suffixes(strings, depth)
    assert got.sa.tolist() == [r[1] for r in want] and got.bwt.tolist() == [r[2] for r in want]
    blocks = [next(i for i, r in enumerate(want) if r[0] == w[0]) for w in want]
    assert got.block.tolist() == blocks


@settings(max_examples=300, deadline=None)
@given(texts, texts, st.integers(7, 30))
def test_merge_equals_building_together(x, y, depth):
    a = bwt.build(x, depth)
    b = bwt.build(y, depth, len(a.sa))
    got, want = bwt.merge(a, b, depth), bwt.build(x + y, depth)
    assert got.sa.tolist() == want.sa.tolist() and got.bwt.tolist() == want.bwt.tolist() and got.block.tolist() == want.block.tolist()


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(7, 12), st.integers(1, 60), st.data())
def test_repeated_starts(strings, depth, shard, data):
    weights = np.array([data.draw(st.integers(1, 2)) for _ in strings])
    count = {}
    for s, w in zip(strings, weights):
        for i in range(len(s) - depth + 1):
            count[s[i : i + depth]] = count.get(s[i : i + depth], 0) + w
    got = bwt.repeated_starts(strings, weights, depth, shard)
    assert [g.tolist() for g in got] == [[count[s[i : i + depth]] >= 2 for i in range(len(s) - depth + 1)] for s in strings]
