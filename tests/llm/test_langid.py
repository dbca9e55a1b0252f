import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from slabworks.llm import langid
from slabworks.llm.textkit import utf8
from tests.conftest import SF


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    got = langid.op1_language_id(spark, SF.replace("0.001", "0.01"))
    both = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'")
    right, n = both.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 100 and right > 0.97
    assert got.where("score < 0 or score > 1").count() == 0


def test_windows_cover_whole_texts(monkeypatch):
    raw, at = utf8(pa.array(["a" * 700, "", None, "b"]))
    monkeypatch.setattr(langid, "BLOCK", 2)  # several blocks
    x, doc, size = map(np.concatenate, zip(*langid.windows(raw, at, langid.WINDOW + 3)))
    assert doc.tolist() == [0, 0, 0, 3] and size.sum() == 701
    assert (x[0] == ord("a")).all() and x[2][700 - 512 :].sum() == 0


def test_gradients_match_differences():
    net = langid.ByteNet(["a", "b", "c"], langid.Shape(filters=3))
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    rng = np.random.default_rng(1)
    x = rng.integers(1, 256, (4, net.reach)).astype(np.uint8)
    y = np.array([0, 1, 2, 0])
    loss = lambda: -np.log(net.probabilities(x)[np.arange(4), y]).mean()
    g = net._gradients(x, y)
    for name, i in (("dense", (2, 1)), ("conv3", (5, 1)), ("bias2", (0,)), ("embed", (int(x[0, 3]), 2))):
        net.w[name][i] += 1e-6
        up = loss()
        net.w[name][i] -= 2e-6
        down = loss()
        net.w[name][i] += 1e-6
        assert abs((up - down) / 2e-6 - g[name][i]) < 1e-5


def test_odd_rows(spark):
    rows = [(1, "the cat sat on the mat", "en", "q"), (2, "der hund und die katze", "de", "q"), (3, "der baum und das haus", "de", "q"), (None, None, None, None), (5, "1234 !!", "en", "q"), (5, "1234 !!", "en", "q"), (6, "", None, "q"), (7, "the " * 50000, None, "q"), (8, "é", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    net = langid.train(docs)
    got = {(r.doc_id, r.lang_pred, r.score > 0) for r in langid.identify(docs, net).collect()}
    assert {(None, "und", False), (5, "und", False), (6, "und", False)} <= got
    assert langid.identify(docs, net).count() == len(rows)
    assert langid.train(docs.limit(0)) is None
    assert langid.identify(docs.limit(0), None).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}


def naive(net, text):
    """Mean probabilities of a text, filter by filter and byte by byte."""
    raw = text.encode()
    total = np.zeros(len(net.languages))
    for start in range(0, len(raw), langid.WINDOW):
        own = [net.w["embed"][b] for b in raw[start : start + net.reach]]
        own += [np.zeros(net.shape.embedding)] * (net.reach - len(own))
        hidden = []
        for k in net.shape.widths:
            for f in range(net.shape.filters):
                w = net.w[f"conv{k}"][:, f].reshape(k, -1)
                answers = [sum(float(own[i + j] @ w[j]) for j in range(k)) for i in range(langid.WINDOW)]
                hidden.append(max(0.0, max(answers) + float(net.w[f"bias{k}"][f])))
        z = np.array(hidden) @ net.w["dense"] + net.w["out"]
        z = np.exp(z - z.max())
        total += z / z.sum() * len(raw[start : start + langid.WINDOW])
    return total / len(raw)


def test_the_query_equals_a_naive_network(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = langid.train(docs)
    texts = {r.doc_id: r.text for r in docs.collect() if r.text and 0 < len(r.text) < 900}
    got = {r.doc_id: r for r in langid.op1_language_id(spark, SF).collect()}
    assert len(got) == docs.count()
    compared = 0
    for i in sorted(texts)[:12]:
        if got[i].lang_pred != "und":
            p = naive(net, texts[i])
            assert net.languages[int(p.argmax())] == got[i].lang_pred and abs(p.max() - got[i].score) < 1e-4
            compared += 1
    assert compared > 5


def test_rare_languages_are_sampled(spark):
    rows = [(i, f"{lang} text {i}", lang) for i, lang in enumerate(["aa"] * 3000 + ["bb"] * 7 + ["cc"] * 400)]
    docs = spark.createDataFrame([*rows, (None, "x", "aa"), (-1, None, "dd"), (-2, "y", None)], "doc_id long, text string, lang string")
    got = [lang for lang, _ in langid.sample(docs, 300)]
    learnable = docs.where(~langid.is_held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull()).groupBy("lang").count().collect()
    n = {r.lang: r["count"] for r in learnable}
    assert {k: got.count(k) for k in set(got)} == {k: min(v, 100) for k, v in n.items()}
