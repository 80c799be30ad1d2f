import base64
import hashlib
import random

import numpy as np
import pytest
from helpers import empty_docs, odd_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanshade.llm import byte_bpe as bb
from spanshade.llm.queries import op11_byte_bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = open(PATH, "rb").read()
CODER = bb.Coder(RANKS)


def library(pattern=public_tokenizers.PATTERN):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})


LIB = library()


def test_the_pattern_is_the_public_one():
    assert bb.PATTERN == public_tokenizers.PATTERN


def check(text):
    want = LIB.encode_ordinary(text)
    got = CODER.encode(text)
    assert got.tolist() == want, text[:80]
    assert CODER.decode(got) == text.encode()


@pytest.fixture
def short_pieces(monkeypatch):
    """Texts are cut every few code points, runs of white space from three."""
    monkeypatch.setattr(bb, "LONG", 7)
    monkeypatch.setattr(bb, "LONG_RUN", bb.re.compile(f"[{bb.BLANK}]{{3,}}"))


ALPHABET = "ab'sr\xe91\xb2\u0663 \n\t\u2009\u3000\xa0\u180e\x1c\x85!_-'ll\u65e5\u672c\u3002\u3001\U0001f600\u0301\u0378(0A\xd7\xf7"


def test_cut_texts_have_the_ids_of_whole_ones(short_pieces):
    rng = random.Random(3)
    for _ in range(4000):
        check("".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))))
    for _ in range(400):
        check("".join(rng.choice(("don't", "we'll ", " x's", "   ", "\n\n\n\n", "12", "--", "'re", "日本語。")) for _ in range(40)))


def test_any_text_cut(short_pieces):
    @settings(max_examples=300, deadline=None)
    @given(st.text(max_size=80))
    def run(text):
        check(text)
    run()


def test_long_texts():
    rng = random.Random(5)
    words = "".join(rng.choice(("word ", "don't ", "naïve\n", "  12,5 ", "\t")) for _ in range(120_000))
    check(words)
    assert max(len(p) for _, p in bb.pieces(words)) < bb.LONG + 100
    check("日本語のテキスト。" * 30_000)
    for blank in (" " * 300_000, "\n" * 150_000):
        check(blank), check(blank + "x"), check("x" + blank), check("a" + blank + "'s b" + blank + "c ")


def test_runs_that_the_library_alone_cannot_split():
    text = "x" + " " * 2_000_000 + "y"
    got = CODER.encode(text)
    assert CODER.decode(got) == text.encode()
    assert got.tolist() == [*LIB.encode_ordinary("x"), *CODER.whole.encode_ordinary(" " * 1_999_999), *LIB.encode_ordinary(" y")]


def test_other_patterns_are_not_cut(monkeypatch):
    monkeypatch.setattr(bb, "LONG", 3)
    pattern = r"[^a]+|a+"
    assert bb.Coder(RANKS, pattern).encode("the cat sat on the mat").tolist() == library(pattern).encode_ordinary(
        "the cat sat on the mat")


def test_table(spark):
    docs = odd_docs(spark).withColumn("ids", F.lit("clash"))
    coded = bb.encode(docs, PATH)
    assert coded.columns == [*[c for c in docs.columns if c != "ids"], "ids"]
    assert dict(coded.dtypes)["ids"] == "array<int>"
    out = bb.decode(coded, PATH)
    for r in out.collect():
        assert r.ids == LIB.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    packed = bb.round_trip(docs, PATH, packed=True)
    for r in packed.collect():
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == LIB.encode_ordinary(r.text or "")
    again = bb.decode(packed, PATH)
    assert [bytes(r.decoded) for r in again.collect()] == [bytes(r.decoded) for r in packed.collect()]
    assert bb.decode(spark.createDataFrame([(None,)], "ids array<int>"), PATH).first().decoded == b""
    assert bb.encode(empty_docs(spark), PATH).collect() == bb.round_trip(empty_docs(spark), PATH).collect() == []


def test_invalid_utf8(spark):
    docs = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text")
    assert bytes(bb.round_trip(docs, PATH).first().decoded) == "a�b".encode()


def test_unknown_ids_are_an_error(spark):
    with pytest.raises(Exception):
        bb.decode(spark.createDataFrame([([50_256],)], "ids array<int>"), PATH).collect()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = op11_byte_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIB.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
