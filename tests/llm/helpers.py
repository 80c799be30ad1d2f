"""Small tables for the operators: odd rows, an empty table, clashing columns."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WHITE = "[\x20\x09-\x0d]+"
WORD = "[^\x20\x09-\x0d]+"


def odd_docs(spark, more=()):
    long = "".join(f"word{i % 97} runs on and on, line {i}.\n" if i % 9 == 0 else f"word{i % 89} " for i in range(20_000))
    line = "This licence line stands in many documents."
    rows = [
        (1, None), (2, ""), (3, "   \t\n "), (4, "one"), (5, "two words"), (6, "One"), (7, long), (8, long + " "),
        (9, f"a b\n{line}\nc"), (10, f"x\n {line.upper()} \n{line}\ny"), (11, f"{line}\n\n{line}"), (12, line),
        (13, "naïve café – 日本語のテキスト 😀   end"), (14, "two  words"), (14, "two words"), (15, "two\twords"),
        (None, "two words"), (None, f"null id\n{line}"), (16, "é" * 20), (17, "é" * 20), (18, "é" * 20), (19, "é" * 19),
        *more,
    ]
    langs = ["en", None, "de"]
    return spark.createDataFrame([(i, t, langs[k % 3], None if k % 5 == 0 else f"s{k % 4}", len(t or ""))
                                  for k, (i, t) in enumerate(rows)], DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(WORD, text or "")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
