"""Small tables with everything that is odd: NULLs, empty and long texts, ties, repeated rows, clashing columns."""

import random
import re

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = (
    "key rank root node slot start block queue size n rows score keep kept row k turn slice version spots a b "
    "shingle votes part before base ids total place least vec_id v bucket text_a host path rule"
).split()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sentence(random_, n, vocabulary=400):
    return " ".join(f"w{random_.randrange(vocabulary)}" for _ in range(n))


def odd_rows(seed=1):
    """(doc_id, text, lang, source, n_chars)"""
    r = random.Random(seed)
    passage = sentence(r, 70, 5000)
    base = sentence(r, 200, 5000).split()
    texts = [None, "", " \n\t ", "one", "two words", "Ümlaut é ñ 日本 x\x0by", "loop " * 300]
    texts += [sentence(r, r.randrange(1, 120)) for _ in range(20)]
    texts += [f"{sentence(r, 20, 5000)} {passage}\n{sentence(r, 15, 5000)}" for _ in range(6)] + [passage]
    texts += [" ".join(base)] * 3
    for _ in range(12):
        edited = list(base)
        for _ in range(r.randrange(1, 6)):
            edited[r.randrange(len(base))] = f"e{r.randrange(20)}"
        texts.append("  ".join(edited).upper() if r.random() < 0.3 else "\t".join(edited))
    texts += [sentence(r, 30000, 50000)]
    rows = [(7 * i + 3, text, "en", f"s{min(i % 9, 3)}" if i % 11 else None, None) for i, text in enumerate(texts)]
    rows += [(None, "a text without an id", "en", "s0", 20), (None, None, None, None, None)]
    return rows + rows[5:8]


def table(spark, rows, clashing=True):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for i, name in enumerate(CLASHING if clashing else ()):
        frame = frame.withColumn(name, F.lit(i))
    return frame


def empty(spark):
    return table(spark, [])
