import hashlib
import random

import numpy as np
import pytest

from slabworks.llm import suffixdup
from slabworks.llm.textkit import utf8
from tests.conftest import SF
from tests.llm.collisions import thue_morse
from tests.llm.oracle import compare

import pyarrow as pa


def brute(texts, length=400):
    raws = [(t or "").encode() for t in texts]
    count = {}
    for r in raws:
        for i in range(len(r) - length + 1):
            k = hash(r[i : i + length])
            count[k] = count.get(k, 0) + 1
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, dtype=np.int32)
        for i in range(len(r) - length + 1):
            if count[hash(r[i : i + length])] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        mask = np.cumsum(gone)[: len(r)] > 0
        kept = np.frombuffer(r, np.uint8)[~mask].tobytes()
        out.append((len(r), int(mask.sum()), int((np.diff(mask.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, key string")
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdup.remove_repeats(df).collect())
    want = sorted(((i is None, i or 0), *b) for (i, _), b in zip(rows, brute([t for _, t in rows])))
    assert got == want


def texts(seed, copies):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeéfghij", k=rng.randint(2, 9)))
    passage = " ".join(word() for _ in range(90))
    out = []
    for _ in range(12):
        out.append(" ".join(word() for _ in range(rng.randint(0, 400))))
    for _ in range(copies):
        body = [word() for _ in range(rng.randint(0, 200))]
        body.insert(rng.randint(0, len(body)), passage if rng.random() < 0.6 else passage[rng.randint(0, 200) :])
        out.append(" ".join(body))
    base = [word() for _ in range(150)]
    for _ in range(copies):
        out.append(" ".join(word() if rng.random() < 0.01 else w for w in base))
    out += [out[3], out[3], out[3] + "x", "ab" * 700, "z" * 3000, "cab" * 130 + "q" + "cab" * 140, passage * 3, "", None, "short", "short", "é" * 199 + "xx", "é" * 199 + "xx", "ü" * 200, "ü" * 200]
    return out


@pytest.mark.parametrize("hot", [200, 3])
def test_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixdup, "HOT", hot)
    check(spark, list(enumerate(texts(hot, 14))))


def test_odd_rows(spark):
    long_ = "".join(random.Random(2).choices("abcdefgh ", k=1000))
    check(spark, [(None, long_), (1, long_), (1, long_), (2, None), (None, None), (3, ""), (4, long_[:500] + "!" + long_[500:])])
    assert suffixdup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("hot", [200, 0])
def test_texts_that_collide_modulo_a_power_of_two(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixdup, "HOT", hot)
    x, y = thue_morse()
    check(spark, list(enumerate([x, y, "q" + x[:700], y[300:] + x[:200], x])))


def test_a_very_long_text(spark):
    rng = random.Random(9)
    block = "".join(rng.choices("abcdefghijklmnop ", k=30_000))
    long_ = "".join("".join(rng.choices("abcdefghijklmnop ", k=rng.randint(1, 90_000))) + block[rng.randint(0, 25_000) :] for _ in range(40))
    check(spark, [(1, long_), (2, block), (3, "short")])


def test_sql_agrees(spark):
    assert compare(suffixdup.op3_suffix_dedup(spark, SF), suffixdup.OP3_SQL, SF) == 200


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdup.op3_suffix_dedup(spark, SF).collect()}
    want = dict(zip((d.doc_id for d in docs), brute([d.text for d in docs])))
    assert got == want and sum(v[1] for v in want.values()) > 0


def test_segments_cover_each_string_once():
    some = texts(5, 3)
    raw, at = utf8(pa.array(some, pa.string()))
    doc, start, n, _, _ = suffixdup.segments(raw, at)
    seen = sorted((d, s + j) for d, s, k in zip(doc.tolist(), start.tolist(), n.tolist()) for j in range(k))
    assert seen == [(d, i) for d, t in enumerate(some) for i in range(len((t or "").encode()) - 399)]
    assert n.max() <= suffixdup.LONGEST


def test_a_text_without_repeats_has_each_anchor_once():
    raw = np.random.default_rng(4).integers(97, 123, 60_000).astype(np.uint8)
    _, _, n, anchor, _ = suffixdup.segments(raw, np.array([0, len(raw)]))
    assert len(set(anchor.tolist())) == len(anchor) and n.sum() == len(raw) - 399


def test_segments_equal_once_cut_go_through_the_transform_once(monkeypatch):
    rng = random.Random(7)
    some = lambda k: bytes(rng.choices(range(97, 123), k=k))
    shared, before, after = some(450), [some(30), some(80)], [some(60), some(20)]
    rows = [(1, bytes([i]), 1 << 10 | len(b) + 200 + 1, 1, b + shared + a) for i, (b, a) in enumerate(zip(before, after))]
    seen = []
    monkeypatch.setattr(suffixdup, "repeated_starts", lambda strings, *rest, f=suffixdup.repeated_starts: f(seen.append(strings) or strings, *rest))
    assert suffixdup.repeats_of(rows) == [(bytes([i]), r[2], len(b), len(b) + 450) for i, (r, b) in enumerate(zip(rows, before))]
    assert seen == [[shared]]
