import hashlib
import random
import zlib

import pytest

from slabworks.llm import prefixtrie, radix
from tests.conftest import SF
from tests.llm.oracle import compare


def brute(convs):
    """Node rows of {conv: [(id, bytes of the text)]}, by a dictionary of prefixes."""
    nodes = {}
    for c, turns in convs:
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(t for t, _ in turns[:d]), []).append((c, turns[d - 1][1] if d else 0, d == len(turns)))
    out = []
    for p, members in nodes.items():
        inside = [(q, m) for q, m in nodes.items() if q[: len(p)] == p]
        leaf = [q for q, _ in inside if not any(len(x) == len(q) + 1 and x[:-1] == q for x in nodes)]
        ends = ",".join(str(c) for c in sorted(c for c, _, e in members if e))
        above = min(c for c, _, _ in nodes[p[:-1]]) if p else None
        children = sum(len(x) == len(p) + 1 and x[:-1] == p for x in nodes)
        out.append((min(c for c, _, _ in members), len(p), above, len(members), children, len(leaf), sum((len(m) - 1) * m[0][1] for _, m in inside), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def rows_of(frame):
    return sorted(str(tuple(r[c] for c in COLUMNS)) for r in frame.collect())


def test_sql_agrees(spark):
    assert compare(prefixtrie.op13_prefix_trie(spark, SF), prefixtrie.OP13_SQL, SF) > 20


@pytest.mark.parametrize("slab", [1, 3, 8192])
def test_slabs_join_without_seams(spark, monkeypatch, slab):
    monkeypatch.setattr(prefixtrie, "SLAB_ROWS", slab)
    rng = random.Random(slab)
    ids = [hashlib.sha256(str(i).encode()).hexdigest()[:32] for i in range(6)]
    ids += [ids[0][:30] + f"{i:02x}" for i in range(1, 60)]  # branches inside an id's last byte
    size = {x: i + 1 for i, x in enumerate(ids)}
    convs = [(c, [ids[min(int(rng.expovariate(0.7)), 64)] for _ in range(rng.randrange(7))]) for c in range(-5, 120)]
    convs += [(1000 + i, ids[:9]) for i in range(60)] + [(2000 + i, [ids[i]]) for i in range(65)] + [(7, []), (7, [ids[0]]), (7, [ids[0]])]
    rng.shuffle(convs)
    df = spark.createDataFrame([(c, t, [size[x] for x in t], "x") for c, t in convs], "conv_id long, ids array<string>, sizes array<long>, node string").repartition(3)
    assert rows_of(prefixtrie.prefix_trie(df)) == brute([(c, [(x, size[x]) for x in t]) for c, t in convs])


def test_odd_rows_and_rebuilding(spark):
    rows = [(c, t, role, text) for c in range(23) for t, (role, text) in enumerate([("user", "hi"), ("assistant", "é" * (c // 5)), ("user", f"{c}")] * (c % 4))]
    rows += [(40, None, "z", "first"), (40, 1, None, None), (40, 1, "a", "tie b"), (40, 1, "a", "tie a"), (40, 1, "a", "tie a"), (None, 1, "user", "lost"), (41, 0, "user", "long " * 50_000), (10, 0, "user", ""), (-3, 0, "u", "negative")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, ids int")
    turns = {}
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns.setdefault(c, []).append(((r or "", x or ""), len((x or "").encode())))
    want = []
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c > 0 else -1)
        want.append((c, turns.get(base, [])[:h] + own[h:]))
    assert rows_of(prefixtrie.prefix_trie(prefixtrie.rebuilt(prefixtrie.turn_keys(df)))) == brute(want)
    assert prefixtrie.prefix_trie(prefixtrie.turn_keys(df.limit(0))).count() == 0


def test_deep_chain(spark):
    ids = [hashlib.sha256(b"%d" % i).hexdigest()[:32] for i in range(3_000)]
    df = spark.createDataFrame([(i, ids[: 3_000 - i % 3], [1] * (3_000 - i % 3)) for i in range(40)], "conv_id long, ids array<string>, sizes array<long>")
    got = {r.depth: r for r in prefixtrie.prefix_trie(df).collect()}
    assert len(got) == 3_001 and got[0].saved_tokens == 39 * 2_998 + 26 + 13 and got[3_000].n_convs == 14 and got[2_998].n_leaves == 1


def test_layouts_grow_and_keys_come_back():
    tree, rng = radix.Tree(), random.Random(1)
    keys = [bytes([i]) for i in range(256)] + [b"", b"ab", b"abc", b"abd" * 40, b"abd" * 40 + b"x"] + [bytes(rng.randrange(4) for _ in range(rng.randrange(12))) for _ in range(400)]
    kinds, root = set(), []
    for i, k in enumerate(keys):
        tree.insert(k, i)
        kinds.add((type(tree.root.layout).__name__, getattr(tree.root.layout, "room", None)))
    assert kinds >= {("Sorted", 4), ("Sorted", 16), ("Indexed", None), ("Direct", None)}
    root = [(tree.root, tree.root.path)]
    found = {}
    for node, key in root:
        for i in node.ends:
            found[i] = key
        root += [(child, key + bytes([b]) + child.path) for b, child in node.items()]
    assert [found[i] for i in range(len(keys))] == keys
    assert [n for n, _, _ in tree.post_order()][-1] is tree.root
