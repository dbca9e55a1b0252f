import hashlib
import sys
from pathlib import Path

from slabworks.llm import bpe, decontam, langid, secrets
from tests.conftest import SF
from tests.llm.test_neardup import brute as near_brute

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    net = langid.train(docs)
    seen = {name: None for name, _ in corpus_pipeline.STAGES}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        before = {r.doc_id: r for r in docs.collect()}
        after = {r.doc_id: r for r in out.collect()}
        assert len(after) == out.count()
        if name != "encode":
            assert out.columns == columns
        if name == "language_id":
            verdict = {r.doc_id: r for r in langid.identify(docs, net).collect()}
            assert set(after) == {i for i, r in verdict.items() if r.lang_pred != "und" and r.score >= langid.LEAST_SCORE}
        if name == "near_dedup":
            rows = sorted((i, r.text) for i, r in before.items())
            assert set(after) == {r[0] for r in near_brute(rows, 5) if r[3] or not r[1]}
        if name == "decontamination":
            leaks = {r.doc_id for r in decontam.find_leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert set(after) == set(before) - leaks
        if name == "secret_scan":
            assert set(after) == set(before)
            found = {r.doc_id: r.found for r in secrets.find_secrets(docs).collect()}
            for i, r in after.items():
                live = [s for s in found[i] if s.live]
                assert (r.text == before[i].text) == (not live) and r.n_chars == len(r.text)
                assert all(before[i].text[s.start : s.end] not in r.text for s in live)
        if name == "encode":
            own = bpe.encoder(*bpe.production())
            for i, r in after.items():
                assert list(r.ids) == own.encode(before[i].text) and r.n_tokens == len(r.ids)
                assert r.decoded_sha256 == hashlib.sha256(before[i].text.encode()).hexdigest()
        docs, seen[name] = out, len(after)
    whole = corpus_pipeline.run(spark, SF)
    assert {r.doc_id: r.ids_sha256 for r in whole.collect()} == {r.doc_id: r.ids_sha256 for r in docs.collect()}


def test_odd_rows(spark, tmp_path):
    text = "the cat sat on the mat and then it went to sleep for a while"
    rows = [(1, text, "en", "s", 9, "x"), (1, text, "en", "s", 9, "x"), (None, text + " again and again", None, None, None, None), (None, None, None, None, None, None), (4, "", "en", "s", 0, "x"), (5, "1 2 3", None, "s", 1, "x"), (6, "token = 0123456789abcdef0123 " + "der hund " * 50000, "de", None, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens string")
    kept, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        assert stage(spark, docs.limit(0), SF).count() == 0
        back = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = sorted(str(r.doc_id) for r in back.collect())
        if name != "encode":
            assert back.columns == docs.columns
        now = back
    net = langid.train(docs)
    told = sorted(str(r.doc_id) for r in langid.identify(docs, net).where(f"lang_pred <> 'und' and score >= {langid.LEAST_SCORE}").collect())
    assert kept["language_id"] == told and "4" not in told  # texts without a letter go
    assert kept["near_dedup"] == kept["decontamination"] == kept["secret_scan"] == kept["encode"] == sorted(str(i) for i in (1, None, 6))  # one row of the repeated ones
    scanned = {r.doc_id: r.text for r in spark.read.parquet(f"{tmp_path}/secret_scan").collect()}
    assert scanned[6].startswith("[SECRET]") and scanned[1] == text
