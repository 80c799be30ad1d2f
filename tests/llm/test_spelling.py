import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from helpers import empty_docs, odd_docs
from pyspark.sql import functions as F

from spanshade.llm import oracle, spelling
from spanshade.llm.queries import op13_spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts, ratio=10):
    form, n_near = {}, {}
    for w, n in counts.items():
        others = [o for o in counts if near(w, o)]
        n_near[w] = len(others)
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, n_near[w], counts.get(form[w])))
    return out


def got(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def some_words(seed, alphabet, size, lengths):
    rng = random.Random(seed)
    return {"".join(rng.choice(alphabet) for _ in range(rng.randint(*lengths))): rng.choice((2, 3, 25, 40, 300, 4000))
            for _ in range(size)}


@pytest.mark.parametrize("bucket_pairs", [0, 32])
def test_against_all_pairs(spark, bucket_pairs):
    counts = some_words(1, "abé", 500, (7, 10))  # dense: most words have near ones
    df = spelling.group_variants(table(spark, counts), bucket_pairs=bucket_pairs)
    assert got(df) == plain(counts) and df.count() == len(counts)


def test_a_crowded_half_is_chunked_again(spark):
    counts = {"interm" + w: n for w, n in some_words(2, "abcdefgh", 600, (4, 7)).items()}
    counts |= {w + "ational": n for w, n in some_words(3, "abcdefgh", 300, (1, 6)).items()}
    words = table(spark, counts)
    rows = spelling.near_pairs(words, bucket_pairs=4)
    assert got(spelling.group_variants(words, bucket_pairs=4)) == plain(counts)
    assert {frozenset((r.word, r.other)) for r in rows.collect()} == {
        frozenset((a, b)) for a in counts for b in counts if near(a, b)}


def test_edits_at_every_place_and_long_words(spark):
    word = "abcdefghijk"
    counts = {word: 1000}
    for i in range(len(word) + 1):
        counts[word[:i] + "ÿ" + word[i:]] = 5
        counts[word[:i] + "þ" + word[i + 1:]] = 7
        counts[word[:i] + word[i + 1:]] = counts.get(word[:i] + word[i + 1:], 9)
    long = "verylong" * 2_000
    counts |= {long: 50, long[:9_000] + "x" + long[9_000:]: 2, "aaaaaaa": 30, "aaaaaaaa": 3, "aaaaaaaaa": 300}
    counts[word] = 1000
    assert got(spelling.group_variants(table(spark, counts), bucket_pairs=0)) == plain(counts)


def test_chains_of_forms(spark):
    # the edits are two apart from one word to the next but one: a chain of five
    counts = {"a" * k + "bbbbbbbb": 10 ** k for k in range(6)}
    rows = got(spelling.group_variants(table(spark, counts)))
    assert rows == plain(counts)
    assert {r[2] for r in rows} == {"aaaaabbbbbbbb"}


def test_ties_take_the_first_in_code_point_order(spark):
    counts = {"wordwor": 2, "wordwora": 30, "wordworé": 30, "zwordwor": 30}
    assert ("wordwor", "wordwora", "wordwora", 2, 3, 30) in got(spelling.group_variants(table(spark, counts)))


def test_nulls_and_no_words(spark):
    words = spark.createDataFrame([(None, 5), ("lonelyword", 3)], "word string, n int")
    assert got(spelling.group_variants(words)) == {("lonelyword", None, "lonelyword", 3, 0, None)}
    assert spelling.group_variants(words.limit(0)).collect() == []
    assert spelling.occurrences(empty_docs(spark)).collect() == []


def plain_counts(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_query_and_sql(spark, tmp_path):
    rng = random.Random(9)
    words = ["Straßenbahn", "Éléphants", "running", "runnings", "RUNNING", "elephant", "×÷cross×", "short",
             "mistakeān", "don't-everything"]
    more = [(100 + i, " ".join(rng.choices(words, k=60)), "en", "s", 0, "clash") for i in range(60)]
    docs = odd_docs(spark).withColumn("word", F.lit("clash"))
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = plain(plain_counts([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
    assert any(r[1] for r in want) and any("é" in r[0] for r in want)
    assert got(op13_spelling_variants(spark, str(tmp_path))) == want
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    rel = con.sql(oracle.SQL["op13_spelling_variants"])
    at = [rel.columns.index(c) for c in ("word", "form", "root", "n", "n_near", "form_n")]
    assert {tuple(r[i] for i in at) for r in rel.fetchall()} == want
