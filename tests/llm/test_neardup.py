import random
import re
from itertools import combinations

import pytest

from slabworks.llm import neardup
from slabworks.llm.components import connected_components
from tests.conftest import SF
from tests.llm.collisions import thue_morse
from tests.llm.oracle import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k=4, percent=80):
    sets = []
    for _, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        x, y = sets[i], sets[j]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            root[find(j)] = find(i)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return out


def key(r):
    return tuple((x is None, str(x)) for x in r)


def check(spark, rows, **kw):
    kw = {"words": 4} | kw
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, sid string")
    got = [tuple(r) for r in neardup.near_duplicates(df, **kw).collect()]
    assert sorted(got, key=key) == sorted(brute(rows, kw["words"]), key=key)


def edited(rng, base, rate):
    return " ".join(rng.choice(["qq", "zz", "yy"]) + str(rng.randint(0, 9999)) if rng.random() < rate else w for w in base)


@pytest.mark.parametrize("short", [24, 2])
def test_groups_near_the_limit(spark, monkeypatch, short):
    monkeypatch.setattr(neardup, "SHORT_LIST", short)
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for _ in range(6):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([3, 9, 40, 120, 300]))]
        rows += [edited(rng, base, rng.choice([0, 0.01, 0.02, 0.03, 0.05])) for _ in range(rng.randint(2, 45))]
    rows += [" ".join([f"u{rng.randint(0, 9999)}" for _ in range(rng.randint(5, 200))] + passage) for _ in range(40)]
    rows += ["", None, " \n", "one", "ONE", "one two", "same text twice over", "Same text\ttwice over"]
    rng.shuffle(rows)
    check(spark, list(enumerate(rows)))


def test_odd_rows(spark):
    text = "a b c d e f g h i j"
    check(spark, [(5, text), (5, text), (None, text), (7, text + " k"), (None, "alone in the world today"), (9, None), (10, ""), (11, "x " * 100000)])
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_five_words_and_one_row_of_each_group(spark):
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(5, text), (5, text), (None, text), (3, text + " end"), (None, "alone in the world today"), (None, "alone in the world today"), (9, None), (9, None), (10, ""), (2, "alone but with an id")]
    check(spark, rows, words=5)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, comp string, _id int")
    got = sorted((str(r.doc_id), str(r.text)[:5]) for r in neardup.without_near_duplicates(df).collect())
    assert got == [("10", ""), ("2", "alone"), ("3", "a b c"), ("9", "None"), ("9", "None"), ("None", "alone")]
    assert neardup.without_near_duplicates(df).columns == df.columns


def test_sql_agrees(spark):
    assert compare(neardup.op8_near_duplicates(spark, SF), neardup.OP8_SQL, SF) == 200


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (200, 200), (None, 3), (50, 39)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 0, 100: 100, 101: 100, 200: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_that_collide_modulo_a_power_of_two(spark):
    x, y = thue_morse()
    p, q = thue_morse("aa", "bb")
    check(spark, [(1, x), (2, y), (3, f"{x} {p} {x} {q} {y}"), (4, f"{y} {q} {y} {p} {x}"), (5, x.upper())])
