import hashlib
import random

import pytest
import tiktoken

from slabworks.llm import bpe
from tests.conftest import SF


@pytest.fixture(scope="module")
def pair():
    path, pattern = bpe.production()
    tokens = bpe.read_ranks(path)
    public = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    return bpe.encoder(path, pattern), public


CASES = ["", " ", "a", "don't  stop\n\n\tnow", "é" * 500, "ab" * 3000, " " * 2000, "x" * 999, "<|endoftext|>", "日本語 текст 🙂🙂 ñandú", "\x00\x1c\x85​", "aaaaabaaaab" * 50, "1234567890" * 30]


@pytest.mark.parametrize("text", CASES)
def test_cases_equal_the_public_library(pair, text):
    own, public = pair
    ids = own.encode(text)
    assert ids == public.encode_ordinary(text)
    assert own.decode(ids) == text.encode()
    assert own.encode_to_digits(text) == ",".join(map(str, ids))
    assert own.decode_digits(own.encode_to_digits(text)) == text.encode()


def test_random_texts_equal_the_public_library(pair):
    own, public = pair
    rng = random.Random(5)
    for alphabet in ("ab", "etaoin ", "abcdefghijklmnopqrstuvwxyz", "äöüß enr", "0189.,- ", "🙂é日ñ a"):
        for _ in range(150):
            text = "".join(rng.choices(alphabet, k=rng.randint(1, 80)))
            assert own.encode(text) == public.encode_ordinary(text)


def test_every_token_round_trips(pair):
    own, public = pair
    for i, token in enumerate(own.tokens):
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue
        assert own.encode(text) == public.encode_ordinary(text), i


def test_frames(spark):
    path, pattern = bpe.production()
    rows = [(1, "hello", "x"), (1, "hello", "x"), (None, None, None), (2, "", "y"), (3, "word " * 30000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = bpe.encode_documents(df, path, pattern).collect()
    assert len(out) == 5
    assert [r.n_tokens for r in out if r.doc_id in (None, 2)] == [0, 0]
    assert len({(r.n_tokens, r.ids_sha256) for r in out if r.doc_id == 1}) == 1
    assert bpe.encode_documents(df.limit(0), path, pattern).count() == 0


def test_the_query_equals_the_public_library(spark, pair):
    _, public = pair
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = public.encode_ordinary(r.text or "")
        digest = lambda raw: hashlib.sha256(raw).hexdigest()
        want[r.doc_id] = (len(ids), digest(",".join(map(str, ids)).encode()), digest(public.decode_bytes(ids)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op10_bpe_roundtrip(spark, SF).collect()}
    assert got == want
