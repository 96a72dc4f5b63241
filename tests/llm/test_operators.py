"""Every operator against a plain computation, on small documents and odd ones."""

import hashlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import (
    fingerprints, license_scan, lm_score, mixing, ngram_join, packing, quality, suffix_dedup, url_filter, warc,
)
from lakeops.llm.queries import tokenizer
from lakeops.session import scratch_path

SF = "/root/testdata/sf0.001"


def rows(df, *names):
    return Counter(tuple(r) for r in df.select(*names).collect())


# --- 1: repeated passages ---------------------------------------------------------------------


@pytest.mark.parametrize("split", [suffix_dedup.SPLIT, 2])
def test_repeated_passages(docs, given, split):
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = Counter(r[:5] for r in brute.repeated_bytes(given))
    assert rows(suffix_dedup.dedup(docs, split=split), *names) == want


def test_remove_keeps_columns(docs, given):
    found = suffix_dedup.remove(docs)
    assert found.dtypes == docs.dtypes
    want = Counter((i, None if t is None else kept.decode(errors="ignore")) for (i, t), (*_, kept) in zip(given, brute.repeated_bytes(given)))
    assert rows(found, "doc_id", "text") == want
    assert rows(found, "doc_id", "_row", "_chunk") == rows(docs, "doc_id", "_row", "_chunk")


def test_long_text_in_steps(spark, monkeypatch):
    from lakeops.llm import text as tx

    body = " ".join(str(k * 7919 % 10007) for k in range(3000))
    given = [(1, body), (2, "start " + body[:9000] + " end"), (3, "x" + body[5000:])]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    monkeypatch.setattr(tx, "STEP", 1000)
    found = suffix_dedup.dedup(docs)
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows(found, *names) == Counter(r[:5] for r in brute.repeated_bytes(given))


def test_blocks_take_few_arrays_at_a_time():
    """Bytes that a chunk without split runs, and a block of any size, need at once."""
    import tracemalloc

    import pyarrow as pa

    body = np.random.default_rng(5).integers(97, 123, 2_000_000, np.uint8).tobytes().decode()
    texts = [body[k : k + 2000] for k in range(0, len(body), 2000)]
    size = len(body) * 2
    ids = np.arange(2 * len(texts))
    chunk = pa.table({"doc_id": ids, "text": texts + texts, "_order": ids, "_hash": ids, "_chunk": pa.array(ids * 0, pa.int32())})
    keys, counts = suffix_dedup._keys(chunk)

    def peak(fn, *given):
        tracemalloc.start()
        out = fn(*given)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, most

    pieces, most = peak(suffix_dedup._shared_pieces(0, suffix_dedup.SPLIT), chunk, counts)
    assert most < 42 * size
    spans, most = peak(suffix_dedup._repeated, pieces)
    row, low, high = (suffix_dedup._unpack(spans.column(c)[0].as_py()) for c in ("_at_row", "_from", "_to"))
    covered = Counter()
    for r, a, b in sorted(zip(row.tolist(), low.tolist(), high.tolist())):
        covered[r] = b if a <= covered[r] else -1
    assert covered == {k: 2000 for k in range(len(texts), 2 * len(texts))}
    assert most < 60 * size


# --- 2: archives ------------------------------------------------------------------------------


def pages(spark):
    big, other = "<p>" + "x" * 200, "<p>" + "y" * 99
    return [
        (5, "http://a/", big), (3, "http://b/", big), (3, "http://b/", big), (9, None, big), (4, "u", other), (2, "u", other),
        (1, "v", "small"), (6, "v", "small"), (7, "w\r\nX-Page-ID: 8", None), (8, "", ""), (None, "n", big), (None, "n", "é" * 80),
        (None, "n", "é" * 80), (2**60, "far", other), (-(2**40), "low", "ü" * 50),
    ]


def test_archive_round_trip(spark):
    given = pages(spark)
    df = spark.createDataFrame(given, "page_id long, url string, html string").withColumn("_shard", F.lit("clash"))
    folder = scratch_path(spark, "warc")
    warc.write(df.repartition(4), folder, file_bytes=400)
    found = [tuple(r) for r in warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    want = Counter()
    for i, _, html in given:
        body = (html or "").encode()
        ids = [j for j, _, h in given if (h or "").encode() == body]
        known = [j for j in ids if j is not None]
        first = min(known) if known else None
        done = want[(i, len(body), hashlib.sha256(body).hexdigest(), "response", None)]
        again = len(body) >= 100 and (i != first or done)
        want[(i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None)] += 1
    assert Counter(found) == want


def test_archive_files_repeat(spark):
    import pyarrow.fs as pafs

    df = spark.createDataFrame(pages(spark), "page_id long, url string, html string")
    listed = []
    for n in (1, 7):
        folder = scratch_path(spark, "warc")
        warc.write(df.repartition(n), folder, shards=3, file_bytes=300)
        listed.append(rows(spark.read.json(f"{folder}/{warc.MANIFEST}"), "name", "sha256", "bytes", "records"))
        system, base = warc._file_system(folder)
        files = {f.base_name for f in system.get_file_info(pafs.FileSelector(base)) if f.type == pafs.FileType.File}
        assert files == {r[0] for r in listed[-1]}
        with pytest.raises(FileExistsError):
            warc.write(df, folder)
    assert listed[0] == listed[1] and len(listed[0]) > 3


def test_archive_is_checked():
    member = warc._member(1, 0, "http://a/", b"payload", None)
    plain = next(warc.members(iter([member[:9], member[9:]])))
    assert warc.parse(plain)[:4] == (1, 7, hashlib.sha256(b"payload").hexdigest(), "response")
    with pytest.raises(ValueError, match="digest"):
        warc.parse(plain.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))
    with pytest.raises(EOFError):
        list(warc.members(iter([member[:-3]])))


# --- 3: fingerprints --------------------------------------------------------------------------


def test_fingerprints(docs, given):
    found = [tuple(r) for r in fingerprints.fingerprint(docs).collect()]
    assert len(found) == len(given)
    by_id = {r[0]: r for r in found}
    ids = [i for i, _ in given if i is not None]
    ordered = sorted(((i, t or "") for i, t in dict(given).items() if i is not None), reverse=True)
    once = {i for i in ids if ids.count(i) == 1}
    error, texts = [], {}
    for (i, t), (j, after) in zip(ordered, ordered[1:]):
        if i not in once or j not in once:
            continue
        _, n, sha, own, edited, near, next_ = by_id[i]
        cut = len(t) // 3
        changed = t[: len(t) - cut] + after[:cut]
        assert (n, sha) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert texts.setdefault(t, own) == own and texts.setdefault(changed, edited) == edited
        error += [near - brute.weighted_jaccard(t, changed), next_ - brute.weighted_jaccard(t, after)]
    assert abs(np.mean(error)) < 0.01 and np.std(error) < 0.06 and max(map(abs, error)) < 0.3


def test_fingerprints_of_few(spark):
    one = spark.createDataFrame([(7, "abcdef")], "doc_id long, text string")
    assert fingerprints.fingerprint(one).select("edited_sha256").head()[0] == hashlib.sha256(b"abcdab").hexdigest()
    blank = spark.createDataFrame([(1, ""), (2, None), (3, "ab")], "doc_id long, text string")
    found = {r.doc_id: (r.fingerprint == "", r.near_edited, r.near_next) for r in fingerprints.fingerprint(blank).collect()}
    assert found == {1: (True, 1.0, 0.0), 2: (True, 1.0, 1.0), 3: (False, 1.0, 0.0)}


def test_fingerprints_of_long_texts(spark):
    """Slots agree as often as the generalised Jaccard similarity says, also for 20,000 distinct words."""
    n, slots = 20_000, 256
    weight = np.maximum(1, 2 * n // np.arange(1, n + 1))
    cut, thin = weight.copy(), weight.copy()
    cut[: n // 100] = np.maximum(1, cut[: n // 100] // 10)
    thin[n // 2 :: 2] = 0
    texts = [" ".join(f"w{k} " * int(c) for k, c in enumerate(own) if c) for own in (weight, cut, thin)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = {r.doc_id: r.fingerprint for r in fingerprints.signatures(df.withColumnRenamed("text", "fingerprint"), ["doc_id"], ["fingerprint"], slots).collect()}
    for k in (1, 2):
        near = np.mean([marks[0][i : i + 4] == marks[k][i : i + 4] for i in range(0, 4 * slots, 4)])
        true = brute.weighted_jaccard(texts[0], texts[k])
        assert abs(near - true) < 4 * np.sqrt(true * (1 - true) / slots)


def test_draws_follow_the_law(spark):
    """Moments and tails of Gamma(2, 1), of which 1 - (1 + x) exp(-x) lies below x."""
    terms = spark.range(200_000).select(F.xxhash64("id").alias("w"))
    r, b, ln_c = fingerprints.draws(F.col("w"), F.lit(5))
    found = terms.select(r.alias("r"), F.exp(ln_c).alias("c"), b.alias("b")).toPandas()
    for name in ("r", "c"):
        x = np.sort(found[name])
        below = 1 - (1 + x) * np.exp(-x)
        assert np.abs(below - (np.arange(len(x)) + 0.5) / len(x)).max() < 0.004
        assert abs(x.mean() - 2) < 0.02 and abs(x.var() - 2) < 0.05
        assert len(x) * (1 - below[-1] if name == "r" else below[0]) < 12  # the tail that counts
    assert abs(found["b"].mean() - 0.5) < 0.005 and np.abs(np.corrcoef(found.T.values) - np.eye(3)).max() < 0.01
    # Between the ends of steps, interpolation is as good as said.
    steps, ends = np.arange(fingerprints.TAIL, fingerprints.STEPS - fingerprints.TAIL), fingerprints._ENDS
    middle = fingerprints._gamma_quantiles((steps + 0.5) / fingerprints.STEPS)
    for f in (np.array, np.log):
        assert np.abs((f(ends[steps]) + f(ends[steps + 1])) / 2 - f(middle)).max() < 0.005


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_ranges_part_hot_ids(spark, shards):
    """A third of all rows without an id, and another id that many share: no range is far above the others."""
    given = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, -(1 << 63)).when(F.col("id") % 10 == 1, 55).otherwise(F.col("id") * 7).cast("long").alias("_order"),
        F.shiftrightunsigned(F.xxhash64("id"), 1).alias("_tie"),
    )
    dealt, n = fingerprints._ranges(given, shards)
    rows = sorted((-r._order, -r._tie, r._shard) for r in dealt.collect())
    assert [r[2] for r in rows] == sorted(r[2] for r in rows) and rows[-1][2] < n
    sizes = Counter(r[2] for r in rows)
    assert max(sizes.values()) <= 2.5 * np.median(list(sizes.values())) and len(sizes) >= shards * 0.7


def test_next_document_across_hot_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "SHARD_BYTES", 400)
    given = [(None if k % 3 == 0 else 7 if k % 5 == 1 else k, f"t{k} " + "word " * (k % 4)) for k in range(200)] + [(-(2**63), "least"), (None, "")]
    found = fingerprints.fingerprint(spark.createDataFrame(given, "doc_id long, text string")).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in given)
    texts = {}
    for i, t in given:
        texts.setdefault(i, set()).add(t)
    order = sorted((i for i in texts if i is not None), reverse=True) + [None]
    shas = {}
    for r in found:
        shas.setdefault(r.doc_id, set()).add(r.edited_sha256)
    for i, after in zip(order, order[1:] + order[:1]):
        edit = lambda t, n: hashlib.sha256((t[: len(t) - len(t) // 3] + n[: len(t) // 3]).encode()).hexdigest()
        assert shas[i] <= {edit(t, n) for t in texts[i] for n in texts[i] | texts[after]}
        if len(texts[i]) == 1 and len(texts[after]) == 1:
            assert shas[i] == {edit(*texts[i], *texts[after])}


# --- 4: licenses ------------------------------------------------------------------------------


def test_licenses(docs, given):
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    found = license_scan.scan(docs)
    assert rows(found, *names) == Counter((i, *brute.licenses(t)) for i, t in given)
    assert all(set(r.base_labels.split(",")) <= {*r.labels.split(","), ""} and 0 <= r.score <= 1 for r in found.collect())


def test_license_templates(spark):
    notice = "x y z Redistribution and use in source and binary forms, with or without\nmodification, are permitted now"
    given = [(1, notice), (1, notice), (2, notice.replace("source", "sauce")), (3, "licensed under CC BY-NC 4.0."), (4, "cc by other nc 4 0")]
    given += [(10 + k, "plain words of no use and the source") for k in range(20)]
    found = license_scan.scan(spark.createDataFrame(given, "doc_id long, text string"))
    assert rows(found.where("doc_id < 10"), "doc_id", "labels") == Counter({(1, "bsd"): 2, (2, ""): 1, (3, "cc-by-nc"): 1, (4, ""): 1})


# --- 5: urls ----------------------------------------------------------------------------------


def test_url_rules(spark):
    given = [
        (1, None, "", "", None), (2, "no scheme", "", "", None), (3, "http://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/"),
        (4, "x://example.org", "example.org", "", None), (5, "x://notexample.org/es/1", "notexample.org", "/es/1", "org/"),
        (6, "http://b.com/de/1", "b.com", "/de/1", "com/de/"), (7, "h://b.com/fr/?a", "b.com", "/fr/", "com/fr/"), (7, "h://b.com#/fr/", "b.com", "", None),
        (None, "h://example.org/en/12://x", "example.org", "/en/12://x", "example.org/en/1"), (8, "h://É.net\n/p", "É.net\n", "/p", None), (9, "", "", "", None),
    ]
    df = spark.createDataFrame([r[:2] for r in given], "page_id long, url string").withColumn("template", F.lit("clash"))
    labels = spark.createDataFrame([(1, True), (1, False), (None, True)], "id long, bad boolean")
    found = url_filter.judge(df, labels)
    assert rows(found, "page_id", "host", "path", "rule") == Counter((i, h, p, r) for i, _, h, p, r in given)
    says = dict(url_filter.RULES)
    assert all(r.verdict == says.get(r.rule, r.verdict) for r in found.collect())


def test_url_templates(spark):
    """A branch of bad pages is rejected, and siblings alike are merged."""
    given, bad = [], []
    for k in range(600):
        host, part = ("h.net", ("good", "fine", "spam")[k % 3])
        given.append((k, f"http://{host}/{part}/word{chr(97 + k % 26)}{chr(97 + k // 26)}/{k}.html"))
        bad.append((k, part == "spam" if k % 2 else k % 20 == 0))
    found = url_filter.judge(spark.createDataFrame(given, "page_id long, url string"), spark.createDataFrame(bad, "id long, bad boolean"))
    verdicts = rows(found.withColumn("part", F.split("path", "/")[1]), "part", "verdict", "template")
    kinds = {(p, v) for p, v, _ in verdicts}
    assert kinds == {("good", "allow"), ("fine", "allow"), ("spam", "block")}
    assert len(verdicts) == 3 and all("*" in t for _, _, t in verdicts)


def test_url_templates_at_any_depth(spark):
    """What tells pages apart may be the fifth segment; one path may have very many."""
    given, bad = [], []
    for k in range(600):
        part = ("good", "fine", "spam")[k % 3]
        given.append((k, f"http://h.net/a/b/c/d/{part}/word{chr(97 + k % 26)}{chr(97 + k // 26)}/{k}.html"))
        bad.append((k, part == "spam" if k % 2 else k % 20 == 0))
    given += [(1000, "http://h.net/a/b/c/d/good" + "/x" * 300), (1001, "http://i.net/a/"), (1002, "http://i.net/a")]
    found = url_filter.judge(spark.createDataFrame(given, "page_id long, url string"), spark.createDataFrame(bad, "id long, bad boolean"))
    verdicts = rows(found.where("page_id < 1000").withColumn("part", F.split("path", "/")[5]), "part", "verdict")
    assert verdicts == Counter({("good", "allow"): 200, ("fine", "allow"): 200, ("spam", "block"): 200})
    assert found.count() == len(given)
    assert found.where("page_id > 1000").select("template").distinct().count() == 1


# --- 6: near duplicates -----------------------------------------------------------------------


def test_near_duplicates(docs, given):
    names = ("doc_id", "n_shingles", "component_id")
    assert rows(ngram_join.join(docs), *names) == Counter(brute.near_components(given))


def test_near_duplicates_keep_one(docs, given):
    kept = ngram_join.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    left = Counter()
    for i, n, component in brute.near_components(given):
        if n == 0:
            left[i] += 1
        elif i == component:
            left[i] = max(1, left[i])
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == left


def test_chains_and_blocks(spark):
    """Links between sets that are not linked to the first of their block, and chains of links."""
    words = [f"t{k}" for k in range(400)]
    given = [(100 - k, " ".join(words[4 * k : 4 * k + 120])) for k in range(60)]
    given += [(200 + k, " ".join(words[:100] + [f"u{k}_{j}" for j in range(12)])) for k in range(25)]
    found = ngram_join.join(spark.createDataFrame(given, "doc_id long, text string"))
    assert rows(found, "doc_id", "n_shingles", "component_id") == Counter(brute.near_components(given))


def test_common_lines_make_no_blocks(spark, monkeypatch):
    """A line that all documents have is no key of those that have rarer words."""
    line = " ".join(f"common{k}" for k in range(14))
    given = []
    for k in range(120):
        own = [f"w{k}_{j}" for j in range(40)]
        given += [(2 * k, f"{line}\n{' '.join(own)}"), (2 * k + 1, f"{line}\n{' '.join(own)} end{k}")]
    given += [(1000, line), (1001, f"{line} x"), (1002, "a b"), (1003, "a b")]
    kept = {}
    write = ngram_join.written

    def written(df, label, **how):
        found = write(df, label, **how)
        if label in ("keys", "groups"):
            kept[label] = found.toPandas()  # the last of groups are the rows that carry sets
        return found

    monkeypatch.setattr(ngram_join, "written", written)
    found = ngram_join.join(spark.createDataFrame(given, "doc_id long, text string"))
    assert rows(found, "doc_id", "n_shingles", "component_id") == Counter(brute.near_components(given))
    assert kept["keys"].groupby("key").size().max() == 2
    assert len(kept["groups"]) <= 2 * 122


def test_first_shingles_of_an_order():
    """Keys are among a row's first ones by total, then by hash, as many as may be missing and one more."""
    totals = np.array([5, 1, 9, 2, 2, 7, 3, 8, 8, 4, 6], np.int64)
    row = np.array([0] * 10 + [1])
    assert ngram_join._block_keyed(totals, row, np.array([10] * 10 + [1])).nonzero()[0].tolist() == [3, 4, 10]
    none = np.zeros(0, np.int64)
    assert not len(ngram_join._block_keyed(none, none, none))


def test_near_duplicates_leave_no_shuffles(spark, given, shuffles_left):
    """The files of the operator's shuffles are gone when it ends, and the session's setting is what it was."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name, None)
    ngram_join.join(spark.createDataFrame(given, "doc_id long, text string"))
    assert not shuffles_left() and spark.conf.get(name, None) == setting


def test_count_tree():
    random = np.random.default_rng(3)
    vectors = random.integers(0, 4, (300, ngram_join.GROUPS)).astype(np.uint16)
    vectors[150:] = vectors[:150]
    vectors[150:, :3] += 1
    sizes = vectors.sum(1).astype(np.int64)
    a, b = ngram_join.CountTree(vectors, sizes).pairs()
    found = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}
    bound = lambda x, y: np.minimum(vectors[x].astype(int), vectors[y]).sum()
    can = lambda x, y: 100 * min(sizes[x], sizes[y]) >= 80 * max(sizes[x], sizes[y])
    want = {(x, y) for x in range(300) for y in range(x + 1, 300) if can(x, y) and 180 * bound(x, y) >= 80 * (sizes[x] + sizes[y])}
    assert found == want and len(want) >= 150


def connected(n, links):
    """The least member of each one's component."""
    of = list(range(n))
    for x, y in links:
        a, b = sorted((of[x], of[y]))
        of = [a if p == b else p for p in of]
    return of


@pytest.mark.parametrize("owner", [0, 3000])
def test_large_family_beside_a_stranger(owner):
    """Sets of one component are not paired, whether they link with the owner or with each other."""
    import tracemalloc

    base = np.arange(60, dtype=np.uint64) * np.uint64(977)
    sets = [np.sort(np.append(base, np.uint64(10**6 + k))) for k in range(3000)]
    sets.append(np.sort(np.append(base[:49], np.arange(12, dtype=np.uint64) + np.uint64(10**8))))
    tracemalloc.start()
    links = ngram_join._links_of(sets, np.arange(len(sets)) != owner)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert connected(len(sets), links) == [0] * 3000 + [3000] and len(links) == 2999
    assert peak < 64 << 20  # all 4.5 million pairs take more


def test_very_large_sets():
    """More than 65,535 hashes of one group, in sets that don't link with their owner."""
    many = np.arange(66_000, dtype=np.uint64) * np.uint64(ngram_join.GROUPS)
    sets = [many[:9], many, many[:-600]]
    assert ngram_join._links_of(sets, np.arange(3)) in ([(1, 2)], [(2, 1)])


def test_links_of_group():
    random = np.random.default_rng(8)
    for _ in range(20):
        families = [random.choice(2000, 60, replace=False) for _ in range(3)]
        families.append(np.append(families[0][:54], random.integers(3000, 4000, 6)))
        sets = [np.unique(np.append(random.permutation(families[k % 4])[: random.integers(48, 60)], 5000 + k)).astype(np.uint64) for k in range(150)]
        links = ngram_join._links_of(sets, random.permutation(150))
        plain = [set(s.tolist()) for s in sets]
        near = lambda x, y: 100 * len(plain[x] & plain[y]) >= 80 * len(plain[x] | plain[y])
        assert all(near(x, y) for x, y in links)
        assert connected(150, links) == connected(150, [(x, y) for x in range(150) for y in range(x) if near(x, y)])


# --- 7: language model ------------------------------------------------------------------------


def test_language_model(docs, given):
    found = Counter(tuple(r)[:5] + tuple(round(x, 4) for x in tuple(r)[5:]) for r in lm_score.score(docs).collect())
    want = Counter(r[:5] + tuple(round(x, 4) for x in r[5:]) for r in brute.language_model(given, lm_score.PRIOR))
    assert found == want


def test_language_model_is_a_distribution():
    """After any state the probabilities of all known tokens and of one unknown word sum to one."""
    texts = ["a b a c", "b b a", "c a", "d"]
    tokens = [[*t.split(), "end"] for t in texts]
    counts = Counter(w for own in tokens for w in own)
    pairs = Counter(p for own in tokens for p in zip(["start", *own], own))
    visits, size = counts + Counter(start=len(texts)), sum(counts.values()) + len(counts) + 1
    prior = lm_score.PRIOR
    for v in ("start", "a", "b", "c", "d", "unheard"):
        p = [(pairs[v, w] + prior * (counts[w] + 1) / size) / (visits[v] + prior) for w in [*counts, "unheard"]]
        assert abs(sum(p) - 1) < 1e-12


def test_language_model_prefers_its_bigrams(docs):
    found = lm_score.score(docs).where("held_out = false and n_tokens > 50").collect()
    assert all(r.score > r.base_score for r in found)


# --- 8: packing -------------------------------------------------------------------------------


def check_packing(found, length):
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= length
    return len(by_sequence)


def test_packing(docs, given):
    import zlib

    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(tokenizer())
    found = packing.pack(docs, tokenizer()).collect()
    want = Counter()
    for i, t in given:
        ids = np.array([*tool.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 2048):
            own = ids[k : k + 2048]
            want[(i, k // 2048, k, len(own), zlib.crc32(own.tobytes()))] += 1
    assert Counter(tuple(r)[:5] for r in found) == want
    tokens = sum(r.length for r in found)
    assert check_packing(found, 2048) <= 1.02 * tokens / 2048 + 1


def test_token_ids_of_odd_words():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    import pyarrow as pa
    from tokenizers import Tokenizer

    tool, words = Tokenizer.from_file(tokenizer()), packing.Words(tokenizer())
    signs = "aBzÉéßİΣς漢😀\u0301\u0327'’,.;:!?-%&<|>\x1c\x1f\x85\xa0\u2028☎0123 \t\n"

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.one_of(st.text(alphabet=signs, max_size=25), st.sampled_from(["<|endoftext|>", "it's", "we'll,", "Σ."])), max_size=6))
    def check(texts):
        ids, at = packing._ids(words, pa.array(["", *texts], pa.large_string()))
        for k, t in enumerate(["", *texts]):
            assert ids[at[k] : at[k + 1]].tolist() == [*tool.encode(t, add_special_tokens=False).ids, 0]

    check()


def test_words_are_forgotten(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "KNOWN_WORDS", 3)
    words = packing.Words(tokenizer())
    text = [" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(n)) for n in (30, 90, 5, 200)]
    for t in text * 2:
        ids, _ = packing._ids(words, pa.array([t], pa.large_string()))
        assert ids.tolist() == [*words._tokenizer.encode(t, add_special_tokens=False).ids, 0]


def test_rounds_are_best_fit_decreasing():
    random = np.random.default_rng(5)
    for _ in range(30):
        length = int(random.integers(4, 40))
        counts = {int(n): int(random.integers(1, 30)) for n in random.integers(1, length + 1, 8)}
        runs = packing.rounds(counts, length)
        used = Counter()
        placed = Counter()
        for own, rank, count, first, offset in runs.tolist():
            for k in range(count):
                used[first + k] += own
                placed[(own, rank + k)] += 1
        assert max(used.values()) <= length and set(used) == set(range(len(used)))
        assert placed == Counter({(n, k): 1 for n, c in counts.items() for k in range(c)})
        gaps = []
        for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
            fits = [g for g in gaps if g >= n]
            if fits:
                gaps.remove(min(fits))
                gaps.append(min(fits) - n)
            else:
                gaps.append(length - n)
        assert len(used) == len(gaps)


# --- 9: mixing --------------------------------------------------------------------------------


def test_mix(spark, docs, given):
    found = mixing.plan_mix(docs)
    n = len(given)
    assert rows(found, "doc_id", "size") == Counter((i, len(brute.WORD.findall(t or ""))) for i, t in given)
    assert rows(found) == rows(mixing.plan_mix(docs.repartition(5))) and found.count() == n
    per = {r.source: r for r in found.groupBy("source").agg(F.sum("size").alias("size"), F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("of")).collect()}
    names = sorted((s for s in per if s is not None), key=str.encode) + [None]
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    target, full = {}, set()
    total = sum(r["size"] for r in per.values())
    while True:
        rest = total - sum(3 * per[s]["size"] for s in full)
        target = {s: 3.0 * per[s]["size"] if s in full else rest * weight[s] / sum(w for x, w in weight.items() if x not in full) for s in names}
        above = {s for s in names if target[s] > 3 * per[s]["size"]}
        if not above:
            break
        full |= above
    for s in names:
        assert per[s]["of"] == per[s]["size"] and abs(per[s]["target"] - target[s]) < 1e-6 * max(1, target[s])
    assert all(0 <= r.taken <= 3 * r["size"] for r in found.collect())


def test_mix_meets_targets(spark):
    """With many documents, some very long, every source's words come near its target."""
    random = np.random.default_rng(1)
    given = [(k, "w " * int(min(4000, random.pareto(1.2) * 40)), "hot" if k % 3 == 0 else f"s{k % 7}") for k in range(6000)]
    found = mixing.plan_mix(spark.createDataFrame(given, "doc_id long, text string, source string"))
    for r in found.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r.taken - r.target) < 0.02 * r.target


def test_mix_repeats_rows(docs):
    found = mixing.mix(docs)
    assert found.dtypes == docs.dtypes
    want = Counter()
    for r in mixing.plan_mix(docs).collect():
        want[(r.doc_id, r.source)] += r.copies
    assert rows(found, "doc_id", "source") == +want


# --- 10: quality ------------------------------------------------------------------------------


def test_quality(spark, docs, given):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = quality.judge(docs, labels)
    want = Counter()
    for i, t in given:
        n = brute.rule_counts(t)
        want[(i, *n, n[0] < 50 or 100 * n[4] > 50 * n[0])] += 1
    assert rows(found, "doc_id", *quality.COUNTS, "base_failed") == want
    assert not found.where("base_failed and kept").count()
    assert rows(found, "doc_id", "kept") == rows(quality.judge(docs.repartition(5), labels), "doc_id", "kept")
    kept = quality.keep_good(docs, labels)
    assert kept.dtypes == docs.dtypes
    assert rows(kept, "doc_id") == Counter({k[:1]: v for k, v in rows(found.where("kept"), "doc_id").items()})


def test_forest_sets_apart():
    random = np.random.default_rng(2)
    plain = random.normal(0, 1, (4000, 4))
    odd = random.normal(0, 1, (40, 4)) + np.array([9, 0, -9, 0])
    forest = quality.grow(np.concatenate([plain, odd])[random.permutation(4040)])
    assert forest.score(odd).min() > np.quantile(forest.score(plain), 0.99)
    one = forest.score(plain[:3])
    assert (one == forest.score(plain[[0, 1, 2, 0]])[:3]).all()
    assert (quality.grow(np.ones((50, 3))).score(np.ones((2, 3))) <= 1).all()


def test_forest_finds_labelled_junk(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = quality.judge(docs, labels).where("not base_failed").join(labels, "doc_id")
    bad, good = (found.where(f"quality = {q}").agg(F.avg((~F.col("kept")).cast("int"))).head()[0] for q in (0, 1))
    assert good < 0.02 < 0.1 < bad


# --- all: tables without rows -----------------------------------------------------------------


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    no_pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc")
    warc.write(no_pages, folder)
    made = [
        suffix_dedup.dedup(none), suffix_dedup.remove(none), warc.read(spark, folder), fingerprints.fingerprint(none), license_scan.scan(none),
        url_filter.judge(no_pages, spark.createDataFrame([], "id long, bad boolean")), ngram_join.join(none), ngram_join.keep_one(none),
        lm_score.score(none), packing.pack(none, tokenizer()), mixing.plan_mix(none), mixing.mix(none), quality.judge(none, labels),
        quality.keep_good(none, labels),
    ]
    assert [df.count() for df in made] == [0] * len(made)
