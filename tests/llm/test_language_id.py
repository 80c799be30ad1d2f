import random

import pytest
from helpers import empty_docs, odd_docs
from pyspark.sql import functions as F

from spanshade.llm import language_id as lid
from spanshade.llm.language_id import Model, SuffixAutomaton, identify, train


def test_automaton_knows_exactly_the_substrings():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc") for _ in range(30)) for _ in range(4)]
    a = SuffixAutomaton()
    for t in texts:
        a.add(map(ord, t))
    subs = {t[i:j] for t in texts for i in range(30) for j in range(i + 1, 31)}
    for probe in subs | {"".join(rng.choice("abc") for _ in range(rng.randint(1, 8))) for _ in range(500)}:
        s = 0
        for c in probe:
            s = a.next[s].get(ord(c), -1)
            if s < 0:
                break
        assert (s >= 0) == (probe in subs)


def test_phrases_against_greedy_parsing():
    model = Model({"x": ["the cat sat on the mat", "a dog"], "y": ["der hund und die katze"]})
    texts = ["the dog sat", "katze und cat", "zzz qqq", "", "!!!", "The CAT sat.", "on the mat " * 400]
    total, letter = model.phrases(texts)

    def parse(text, samples):
        fold = lambda t: model.codes([t])[0].tolist()
        known = [bytes(fold(s)) for s in samples]
        n, x = 0, fold(text)
        for w in range(0, len(x), 2048):
            part, i = x[w:w + 2048], 0
            while i < len(part):
                j = i + 1
                while j <= len(part) and any(bytes(part[i:j]) in k for k in known):
                    j += 1
                i, n = max(i + 1, j - 1), n + 1
        return n

    for i, t in enumerate(texts):
        assert total[i].tolist() == [parse(t, ["the cat sat on the mat", "a dog"]), parse(t, ["der hund und die katze"])]
        assert letter[i] == any(c.isalpha() for c in t)


def test_every_letter_counts_in_wide_alphabets():
    rng = random.Random(5)
    words = {lang: ["".join(chr(rng.randrange(first, first + 1500)) for _ in range(rng.randint(1, 4))) for _ in range(900)]
             for lang, first in (("am", 0x1200), ("ja", 0x5000), ("ko", 0xAC00), ("zh", 0x5200))}
    words = {lang: [w for w in ws if w.isalpha()] for lang, ws in words.items()} | {"en": "the cat sat on a mat with them".split()}
    write = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    samples = {lang: [write(lang, 300) for _ in range(3)] for lang in words}
    model = Model(samples)
    assert model.classes > 2000 and len({*model.codes(samples["zh"])[0].tolist()}) > 500
    texts = [(lang, write(lang, 40) + " \u0416") for lang in words for _ in range(5)]
    assert model.predict([t for _, t in texts])[0] == [lang for lang, _ in texts]
    total, _ = model.phrases([t for _, t in texts])
    known = {lang: ["".join(map(chr, model.codes([s])[0])) for s in samples[lang]] for lang in words}
    for i, (_, t) in enumerate(texts):
        x = "".join(map(chr, model.codes([t])[0]))
        for k, lang in enumerate(model.langs):
            n = at = 0
            while at < len(x):
                j = at + 1
                while j <= len(x) and any(x[at:j] in s for s in known[lang]):
                    j += 1
                at, n = max(at + 1, j - 1), n + 1
            assert total[i, k] == n


def test_excerpts_come_from_all_over_the_texts(spark):
    header = "Licence and copyright notice of the archive. " * 30
    body = {"de": "der hund und die katze liegen auf der matte ", "fr": "le chien et le chat dorment sur le tapis "}
    rows = [(i, header + body[lang] * 300, lang) for i, lang in enumerate(["de", "fr"] * 40)]
    rows += [(100 + i, "0 " * 5000 + "gatto e cane" + " 1" * 5000, "it") for i in range(3)]  # letters in one place
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train(docs, F.lit(True))
    assert model.langs == ["de", "fr", "it"]
    langs, score = model.predict([*body.values(), "gatto e cane"])
    assert langs == ["de", "fr", "it"] and min(score) > 0.2


def test_odd_rows_and_empty(spark):
    docs = odd_docs(spark)
    model = train(docs, F.lit(True))
    out = identify(docs.withColumn("score", F.lit("clash")), model)
    assert out.columns == [*docs.columns, "lang_pred", "score"]
    for r in out.collect():
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0)
        else:
            assert r.lang_pred in ("en", "de") and 0 <= r.score <= 1
    nothing = train(empty_docs(spark), F.lit(True))
    assert identify(empty_docs(spark), nothing).count() == 0
    assert {r.lang_pred for r in identify(docs, nothing).collect()} == {"und"}


def test_sample_is_bounded(spark, monkeypatch):
    """Null and repeated ids, many equal rows, more labels than can be learned."""
    taken = []

    class Probe(lid.Model):
        def __init__(self, samples):
            taken.append({k: len(v) for k, v in samples.items()})
            super().__init__(samples)

    monkeypatch.setattr(lid, "Model", Probe)
    rows = [(None, f"der hund und die katze {i}", "de") for i in range(3000)] + [(7, f"le chien et le chat {i}", "fr") for i in range(3000)]
    rows += [(8, "il gatto e il cane", "it")] * 3000 + [(i, "1 2 3", "nl") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    train(docs, F.lit(True), docs_per_lang=20, excerpt=64)
    assert taken[-1]["de"] == taken[-1]["fr"] == 20 and 0 < taken[-1].get("it", 1) <= 20 and "nl" not in taken[-1]
    monkeypatch.setattr(lid, "MAX_LETTERS", 64 * 2)
    train(docs, F.lit(True), docs_per_lang=20, excerpt=64)
    assert sum(taken[-1].values()) <= 2 and set(taken[-1]) <= {"de", "fr"}


def test_held_out_accuracy(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.01"
    try:
        docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    except Exception:
        pytest.skip("test tables not present")
    got = E.queries()["op2_language_id"](spark, sf).where("held_out").join(docs, "doc_id").where("lang is not null")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_invalid_utf8(spark):
    docs = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text, 'en' as lang")
    assert identify(docs, train(docs, F.lit(True))).count() == 1
