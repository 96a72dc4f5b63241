"""Collocations against counts of all phrases, and the index against plain search."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import collocations, common
from lakeops.llm.fm_index import Bidirectional, FMIndex, stable_order

KINDS = "doc_id long, text string, lang string, source string, phrase string, _chunk int"
NAMES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain(given, least=10, first=2000):
    """Rows for (text, lang)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = defaultdict(Counter), Counter()
    for text, lang in given:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {w: a for w, a in counts.items() if len(w) > 1 and a >= least}
        rows = []
        for w, a in candidates.items():
            if any(100 * b >= 50 * a for v, b in candidates.items() if len(v) > len(w) and w in (v[:2], v[1:])):
                continue
            cuts = [(10**6 * a * a // (counts[w[:k]] * counts[w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            rows.append((" ".join(w), a, counts[w[:k]], counts[w[k:]], n[lang], score))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, k, *r) for k, r in enumerate(rows[:first], 1)]
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.select(*NAMES).collect())


@pytest.fixture(scope="module")
def given():
    rng = np.random.default_rng(8)
    words = ["the", "The", "of", "É", "naïve", "漢字", "a\x00b", "x y", "it's"] + [f"w{k}" for k in range(25)]
    marks = [" ", "  ", "\t", ", ", ". ", "\n", "\x0b", "\r\n", ";x:", "?!"]
    rows = []
    for i in range(260):
        picks = rng.integers(0, len(words), rng.integers(0, 40)) % rng.integers(1, len(words))
        text = "".join(words[k] + marks[rng.integers(0, len(marks)) if rng.random() < 0.3 else 0] for k in picks)
        rows.append((None if i % 50 == 7 else text, [None, "und", "en", "en", ""][i % 5]))
    rows += [("one two three " * 400, "de"), ("new york city is new york . york new , " * 12, "en"), ("same same same " * 60, "fr")]
    rows += [(" ".join(f"u{k}" for k in range(20_000)), "en"), ("", "xx"), (None, "xx")]
    return rows + rows[:25] * 4


@pytest.fixture(scope="module")
def docs(spark, given):
    rows = [(i if i % 3 else None, t, k, "s", "clash", 7) for i, (t, k) in enumerate(given)]
    return spark.createDataFrame(rows, KINDS).repartition(3).cache()


def test_all_phrases(docs, given):
    out = collocations.mine(docs)
    assert [t for _, t in out.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    want = plain(given)
    assert found(out) == want and len(want) > 100


@pytest.mark.parametrize("least, first", [(2, 5), (10, 40)])
def test_many_shards_and_chunks(docs, given, monkeypatch, least, first):
    monkeypatch.setattr(common, "CHUNK_BYTES", 15_000)
    assert found(collocations.mine(docs, least=least, first=first, shard_bytes=700)) == plain(given, least, first)


def test_copies_of_a_third_of_all_rows(spark, given):
    rows = [(None, "a common phrase of copies, over and over again", "en")] * 900 + [(i, *r) for i, r in enumerate(given)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert found(collocations.mine(docs)) == plain([r[1:] for r in rows])


def test_empty_table(docs):
    assert collocations.mine(docs.limit(0)).count() == 0


def test_scores_beyond_64_bits():
    a, left, right = 3 * 10**12, 4 * 10**12, 5 * 10**12
    assert collocations.scores(np.array([a]), np.array([left]), np.array([right])).tolist() == [10**6 * a * a // (left * right)]


def test_stable_order():
    values = np.random.default_rng(0).integers(0, 300_000, 5000)
    assert np.array_equal(stable_order(values), np.argsort(values, kind="stable"))


def occurrences(text, phrase):
    return sum(text[i : i + len(phrase)] == phrase for i in range(len(text) - len(phrase) + 1))


@pytest.mark.parametrize("seed", range(6))
def test_index_against_search(seed):
    rng = np.random.default_rng(seed)
    text = np.append(np.append(0, rng.integers(0, 5, rng.integers(0, 60))), 0)
    index, plain_text = Bidirectional(text, 3), text.tolist()
    words = index.words()
    pairs = index.left(words)
    triples = index.right(pairs)
    for phrases, length in ((words, 1), (pairs, 2), (triples, 3)):
        places = index.place(phrases)
        seen = [tuple(plain_text[p : p + length]) for p in places]
        want = Counter(w for i in range(len(text) - length + 1) if 0 not in (w := tuple(plain_text[i : i + length])))
        assert Counter(dict(zip(seen, phrases.size.tolist()))) == want and len(set(seen)) == len(seen)
        for phrase, low, size in zip(seen, phrases.low.tolist(), phrases.size.tolist()):
            assert index.forward.find(list(phrase)) == (low, low + size)
    seen = [tuple(plain_text[p : p + 2]) for p in index.place(pairs)]
    ends = [tuple(plain_text[p + 1 : p + 3]) for p in index.place(triples)]
    assert [seen[k] for k in index.suffix_of(triples, pairs)] == ends
    if len(pairs.low):  # of some pairs only
        some = pairs.where(np.arange(len(pairs.low)) % 2 == 0)
        kept = index.right(some)
        assert {tuple(plain_text[p : p + 2]) for p in index.place(kept)} <= {seen[k] for k in range(0, len(seen), 2)}
        assert kept.size.sum() == sum(occurrences(plain_text, list(w)) for w in {tuple(plain_text[p : p + 3]) for p in index.place(kept)})


def test_no_words():
    index = Bidirectional(np.zeros(1, np.int64), 3)
    assert not len(index.left(index.words()).low) and FMIndex(np.zeros(1, np.int64), 2).find([]) == (0, 1)


def test_sql(spark):
    import duckdb

    from lakeops.llm.queries import ORACLE, QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = Counter(con.execute(f"SELECT {', '.join(NAMES)} FROM ({ORACLE['op11_collocations']})").fetchall())
    assert found(QUERIES["op11_collocations"](spark, sf).select(*map(F.col, NAMES))) == want
