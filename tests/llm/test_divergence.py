"""The audit of sources against sums over all terms, and its parts against plain columns."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import common, divergence

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
KINDS = "doc_id long, text string, lang string, source string, shard string, _chunk int"


def plain(given, least=30, top=50):
    """Rows of the audit of (text, lang, source)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs, counts, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for text, lang, source in ((t or "", k or "", s or "") for t, k, s in given):
        found = Counter(_TERM.findall(text.translate(lower)))
        groups[lang].add(source)
        docs.update((lang, w) for w in found)
        counts[lang, source].update(found)
    out = []
    for lang, sources in groups.items():
        kept = [w for (k, w), n in docs.items() if k == lang and n >= least]
        whole = Counter({w: sum(counts[lang, s][w] for s in sources) for w in kept})

        def share(c):
            total = sum(c[w] for w in kept) + 5 * len(kept)
            return {w: 1 + 10**9 * (c[w] + 5) // total for w in kept}

        p, q = {s: share(counts[lang, s]) for s in sources}, share(whole)
        rows = [(s, "pair", t, sum(abs(p[s][w] - p[t][w]) for w in kept)) for s, t in permutations(sources, 2)]
        rows += [(s, "term", w, p[s][w] - q[w]) for s in sources for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
        for key in {r[:2] for r in rows}:
            own = sorted((r for r in rows if r[:2] == key), key=lambda r: (-r[3], r[2].encode()))
            out += [(lang, *r, k) for k, r in enumerate(own, 1) if r[1] == "pair" or k <= top]
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture(scope="module")
def given():
    rng = np.random.default_rng(3)
    words = ["the", "The", "über", "Éa", "x1y", "it's", "漢字", "naïve", "a\x00b", "ÀB"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    rows = []
    for i in range(900):
        lang = [None, "", "en", "en", "en", "de", "fr"][i % 7]
        source = [None, "", "s1", "s1", "s1", "s2", "é", "Z"][rng.integers(8)] if lang != "fr" else "only"
        text = None if i % 41 == 0 else " ".join(rng.choice(words, rng.integers(0, 60)))
        rows.append((text, lang, source))
    rows += [("the " * 70_000 + "wordy", "en", "long"), ("", "xx", "a"), (None, "xx", "b"), ("rare", "xx", None)]
    return rows + rows[:40] * 3


@pytest.fixture(scope="module")
def docs(spark, given):
    rows = [(i if i % 3 else None, *r, "clash", 7) for i, r in enumerate(given)]
    return spark.createDataFrame(rows, KINDS).repartition(3).cache()


def test_all_pairs_and_terms(docs, given):
    out = divergence.audit(docs)
    assert [t for _, t in out.dtypes] == ["string", "string", "string", "string", "bigint", "int"]
    assert found(out) == plain(given)


def test_many_shards_and_chunks(docs, given, monkeypatch):
    monkeypatch.setattr(common, "CHUNK_BYTES", 20_000)
    assert found(divergence.audit(docs, least_docs=5, top=7, shard_terms=9)) == plain(given, 5, 7)


def test_one_source_has_a_third(spark):
    given = [(f"same words of all {chr(97 + i % 26) * 3}", "en", "hot" if i % 3 else f"s{i % 50}") for i in range(3000)]
    docs = spark.createDataFrame([(None, *r) for r in given], "doc_id long, text string, lang string, source string")
    assert found(divergence.audit(docs)) == plain(given)


def test_empty_table(docs):
    assert divergence.audit(docs.limit(0)).count() == 0


def test_runs():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(0, 12))
        a, b = (np.sort(rng.integers(0, 3, n)) * rng.integers(0, 2, n) for _ in range(2))
        pair = []
        for column in (a, b):
            places = np.flatnonzero(column)
            starts, values = divergence.runs(places, column[places], n)
            assert np.array_equal(np.repeat(values, np.diff(np.append(starts, n))), column)
            assert not len(values) or (values[1:] != values[:-1]).all()
            pair.append((starts, values))
        if n:
            assert divergence.difference(*pair, n) == np.abs(a - b).sum()


def test_shares_beyond_64_bits():
    counts = np.array([0, 10**12, 3 * 10**17])
    assert divergence.shares(counts, 10**18 + 7).tolist() == [1 + 10**9 * (c + 5) // (10**18 + 7) for c in counts.tolist()]


def test_equal_counts_lie_together(spark):
    term, group = np.repeat(np.arange(50), 2), np.tile([0, 1], 50)
    n = np.array([[1 + k % 3, 5 - k % 3] for k in range(50)]).ravel()
    place = divergence._order(term, group, n, 50, np.array([10, 20]))
    own = group == 0
    assert len(divergence.runs(np.sort(place[term[own]]), n[own][np.argsort(place[term[own]])], 50)[0]) == 3


def test_sql(spark):
    import duckdb

    from lakeops.llm.queries import ORACLE, QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    names = ["lang", "source", "part", "item", "value", "rank"]
    want = Counter(con.execute(f"SELECT {', '.join(names)} FROM ({ORACLE['op12_divergence']})").fetchall())
    assert found(QUERIES["op12_divergence"](spark, sf).select(*map(F.col, names))) == want
