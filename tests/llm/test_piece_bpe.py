import hashlib
import random

import pytest
from helpers import empty_docs, odd_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanshade.llm import piece_bpe as pb

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
TABLES = pb.load_tables(PATH)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def check(library, texts):
    ids, per = pb.Memo(TABLES).encode(texts)
    decoded, at = pb.decode_flat(TABLES, ids, per), 0
    for t, n, d in zip(texts, per.tolist(), decoded):
        want = library.encode(t)
        assert ids[at:at + n].tolist() == want, t[:80]
        assert d.decode() == library.decode(want)
        at += n


def test_against_the_library(library):
    rng = random.Random(1)
    alphabet = "abcdefghi   ▁▁\n\tzéß日本の的😀.,-=_0123456789ABC "
    check(library, ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(2000)])
    check(library, ["".join(rng.choice("ethansir") for _ in range(3000)) for _ in range(10)])


def test_runs_and_long_words(library):
    check(library, [c * n for c in " a=-0é日" for n in (1, 2, 3, 15, 16, 17, 31, 33, 100, 1000)] + [
        " " * n + "the" + " " * n + "\n" for n in range(40)] + ["ab" * 5000, "http://" * 100, "日本" * 500, "", "x\0y"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(), max_size=5))
def test_any_text(texts):
    import sentencepiece

    check(sentencepiece.SentencePieceProcessor(model_file=PATH), texts)


def test_memo_is_bounded_and_does_not_change_results(library, monkeypatch):
    monkeypatch.setattr(pb, "MEMO_WORDS", 3)
    memo = pb.Memo(TABLES)
    for k in range(20):
        texts = [f"word{k} and more", "the " + "x" * 100, "and again the word"]
        ids, per = memo.encode(texts)
        assert ids.tolist() == [i for t in texts for i in library.encode(t)]
        assert len(memo.index) < 20


def test_table(spark, library):
    docs = odd_docs(spark).withColumn("ids", F.lit("clash"))
    out = pb.decode(pb.encode(docs, PATH), PATH).withColumn("digest", pb.id_digest())
    assert out.columns == [*[c for c in docs.columns if c != "ids"], "ids", "decoded", "digest"]
    for r in out.collect():
        want = library.encode(r.text or "")
        assert r.ids == want and r.decoded == library.decode(want)
        assert r.digest == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
    once = pb.round_trip(docs, PATH)
    assert once.columns == [*[c for c in docs.columns if c != "ids"], "ids", "decoded"]
    assert once.collect() == out.drop("digest").collect()
    assert pb.encode(empty_docs(spark), PATH).collect() == pb.round_trip(empty_docs(spark), PATH).collect() == []
