import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from slabworks.llm import quality, textkit
from slabworks.llm import textkit as K
from slabworks.llm.textkit import utf8
from tests.conftest import SF
from tests.llm.collisions import thue_morse
from tests.llm.oracle import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    tri = Counter(zip(w, w[1:], w[2:]))
    cover = {i + j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b|#\r🙂", max_size=60)), max_size=6))
def test_base_counts(texts):
    got = quality.base_counts(*utf8(pa.array(texts, pa.string())))
    for i, text in enumerate(texts):
        assert [int(got[c][i]) for c in quality.BASE_COLUMNS] == brute(text)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abé ", max_size=12), max_size=5))
def test_ngrams_stay_inside_texts(texts):
    data, at = utf8(pa.array(texts, pa.string()))
    bucket, inside = quality.ngrams(data, at)
    alone = [b for t in texts for b in quality.ngrams(*utf8(pa.array([t], pa.string())))[0]]
    assert bucket[inside].tolist() == alone


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    labels = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 1 and not r.toxic}
    grams = {r.doc_id: quality.ngrams(*utf8(pa.array([r.text])))[0] for r in docs}
    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for i, g in grams.items():
        np.add.at(raw, g, 1)
        if i in labels:
            np.add.at(target, g, 1)
    share = raw / raw.sum()
    smooth = (target + quality.SMOOTHING * quality.BUCKETS * share) / (target.sum() + quality.SMOOTHING * quality.BUCKETS)
    for r in quality.op4_quality(spark, SF).collect():
        text = next(d.text for d in docs if d.doc_id == r.doc_id)
        assert [r[c] for c in quality.BASE_COLUMNS] == brute(text)
        score = np.mean(np.log(smooth[grams[r.doc_id]] / share[grams[r.doc_id]])) if len(grams[r.doc_id]) else 0
        assert abs(score - r.score) < 6e-7  # the query rounds to six places
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and score >= quality.THRESHOLD)


def test_odd_rows(spark):
    rows = [(1, "a b c " * 30, "x"), (1, "a b c " * 30, "x"), (None, None, None), (2, "", "y"), (3, " \n\t", None), (4, "w" * 300000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(1, 1, None), (None, None, None), (2, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.judge(docs, quality.fit(docs, quality.trusted(docs, labels))).collect()
    assert len(got) == 6 and not any(r.kept for r in got)
    assert {r.n_words for r in got if r.doc_id in (None, 2, 3)} == {0}
    none = quality.fit(docs.limit(0), docs.limit(0))
    assert quality.judge(docs.limit(0), none).count() == 0
    assert {r.score for r in quality.judge(docs, none).collect()} == {0.0}


def test_lines_that_collide_modulo_a_power_of_two():
    x, y = thue_morse()
    text = f"{x}\n{y}\n{x} {y} {x}\n{y} {x} {y}"
    got = quality.base_counts(*utf8(pa.array([text, text + "\n" + x])))
    assert [[int(got[c][i]) for c in quality.BASE_COLUMNS] for i in range(2)] == [brute(text), brute(text + "\n" + x)]


def test_counts_are_exact_whatever_the_hash(monkeypatch):
    texts = ["a b c a b c\na b c\nx", "a b c d\ne\ne", "one\ntwo\none two one two one", None]
    monkeypatch.setattr(textkit.Spans, "of", lambda self, starts, ends: np.zeros(len(starts), np.uint64))
    got = quality.base_counts(*utf8(pa.array(texts, pa.string())))
    assert [[int(got[c][i]) for c in quality.BASE_COLUMNS] for i in range(4)] == list(map(brute, texts))


def test_sql_agrees(spark):
    assert compare(quality.op4_quality(spark, SF), quality.OP4_SQL, SF) == 200


def test_a_score_is_the_texts_own():
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("abcdef gh"), size=rng.integers(0, 90))) for _ in range(200)] + ["", "abc", "abcd", "", "x" * 5000]
    ratio = quality.Ratio(rng.normal(size=quality.BUCKETS))
    col = pa.array(texts)
    alone = [ratio.scores(data, at)[0] for _, _, data, at in K.slices(col, 1)]
    for limit in (7, 300, 1 << 19):
        assert np.concatenate([ratio.scores(data, at) for _, _, data, at in K.slices(col, limit)]).tolist() == alone
