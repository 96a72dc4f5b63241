import os
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
LONG = "Lorem ipsum dolor sit amet, consetetur sadipscing elitr, sed diam nonumy eirmod tempor invidunt ut labore. "
# (id, text): nulls, blanks, ties, repeated rows, near copies, signs outside ASCII, a very long text.
ODD = [
    (9001, None),
    (9002, ""),
    (9003, " \t\n\x0b\x0c\r "),
    (9004, "one"),
    (9005, "ONE"),
    (9006, "a b c d"),
    (9007, LONG * 2),
    (9007, LONG * 2),
    (9008, LONG * 2 + "more words than before"),
    (9009, "naïve café Ünïcode Straße ☃ 漢字 😀 x\u0301 ẞ " * 3),
    (9010, "naïve café Ünïcode Straße ☃ 漢字 😀 x\u0301 ẞ " * 3),
    (9011, "z" * 5000),
    (9012, "z" * 5001),
    (9013, "the MIT-License mit license MIT  license, apache license general public license"),
    (9014, "x\ny\nx\n\nx \ny"),
    (9015, "a b c a b c a b"),
    (9016, " ".join(f"w{k}" for k in range(60_000))),
    (None, LONG * 2),
    (None, None),
    (9017, "<|endoftext|> <|ENDOFTEXT|> it's, we'll! ... 12,5 A\x00B\x1fC\x85D"),
]


@pytest.fixture
def shuffles_left(spark):
    """The files of shuffles written since the test began that are still there, after some seconds' wait for their end."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        names = {found.apply(k).getName() for k in range(found.size())}
        return {x for x in names if x.startswith("shuffle_") and x.endswith(".data")}

    before = files()

    def left():
        for _ in range(50):
            if not files() - before:
                break
            time.sleep(0.1)
        return files() - before

    return left


@pytest.fixture(scope="session")
def given(spark):
    """The smallest documents and the odd ones, as (id, text)."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return rows + ODD


@pytest.fixture(scope="session")
def docs(spark, given):
    """The same as a table, with further columns whose names may clash."""
    rows = [(i, t, "en", f"src{(i or 0) % 4}" if i != 9004 else None, len(t or ""), k, "x") for k, (i, t) in enumerate(given)]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, _row int, _chunk string"
    return spark.createDataFrame(rows, kinds).repartition(3).cache()


@pytest.fixture(scope="session")
def none(docs):
    """The table without rows."""
    return docs.limit(0)
