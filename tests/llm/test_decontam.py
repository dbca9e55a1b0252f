import random

from pyspark.sql import functions as F

from slabworks.llm import decontam
from tests.conftest import SF
from tests.llm.oracle import compare


def test_sql_agrees(spark):
    for sf in (SF, SF.replace("0.001", "0.01")):
        assert compare(decontam.op6_decontamination(spark, sf), decontam.OP6_SQL, sf) > 2


def test_containment_at_and_below_the_limit(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows, items, want = [], [], set()
    for i in range(60):
        n = rng.randint(5, 70)
        item = rng.sample(vocabulary, n)
        items.append((i, " ".join(item)))
        have = rng.randint(0, n - 4)  # the first so many shingles
        body = rng.sample(vocabulary, 300) + (item[: have + 4] if have else []) + rng.sample(vocabulary, 3000)
        rows.append((i, " ".join(body).upper()))
        if have * 100 >= 80 * (n - 4):
            want.add((i, i))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want and want


def test_odd_rows(spark):
    item = "one two three four five six"
    docs = spark.createDataFrame([(1, f"x {item} y", "a"), (1, f"x {item} y", "a"), (None, item, "b"), (None, None, None), (2, "", "c"), (3, "one two", "c"), (5, "there are too few words here", "c"), (4, item + " pad" * 100000, "c")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, item, 1), (7, item, 2), (8, None, 1), (9, "", 1), (10, "Too, few words", 1), (11, "...", 1), (12, "two", 1), (7, "entirely other words stand in here", 3)], "item_id long, text string, doc_id long")
    leaks = decontam.find_leaks(docs, items)
    assert sorted((r.doc_id or 0, r.item_id) for r in leaks.collect()) == [(0, 7), (0, 12), (1, 7), (1, 12), (3, 12), (4, 7), (4, 12), (5, 10)]
    assert sorted(str(r.doc_id) for r in decontam.without_leaks(docs, leaks).collect()) == ["2", "None"]
    assert decontam.without_leaks(docs, leaks).columns == docs.columns
    assert decontam.find_leaks(docs.limit(0), items).count() == 0
    assert decontam.find_leaks(docs, items.limit(0)).count() == 0


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    whole = decontam.op6_decontamination(spark, SF).agg(F.sum(F.xxhash64("doc_id", "item_id", "n_shared"))).first()
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 3)
    assert decontam.op6_decontamination(spark, SF).agg(F.sum(F.xxhash64("doc_id", "item_id", "n_shared"))).first() == whole


def test_a_document_that_holds_all_items_and_items_that_share_shingles(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(40)]
    texts = [base[i : i + n] for i in range(0, 20, 3) for n in (5, 9, 14)] + [rng.sample(base, 12) for _ in range(20)]
    docs = [base, base[::-1], base[3:17], sum((rng.sample(base, 7) for _ in range(30)), []), sum(texts, [])]
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    want = {(d, i) for d, have in enumerate(docs) for i, item in enumerate(texts) if 100 * len(grams(item) & grams(have)) >= 80 * len(grams(item))}
    frame = lambda rows, key: spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], f"{key} long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(frame(docs, "doc_id"), frame(texts, "item_id")).collect()}
    assert got == want and len(want) > len(texts)
