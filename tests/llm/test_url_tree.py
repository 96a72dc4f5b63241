"""The template tree against a plain one, and shards of archives by the ids that there are."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lakeops.llm import url_filter, warc
from lakeops.session import scratch_path


def plain_templates(paths):
    """{(host, segments): template} of {(host, segments): (n, labelled, bad)}, a segment at a time."""
    todo, out = {(h, s): (h, s) for h, s in paths}, {}
    while todo:
        nodes = defaultdict(lambda: defaultdict(list))
        for key, (template, rest) in todo.items():
            nodes[template][rest[0] if rest else ""].append(key)
        following = {}
        for template, children in nodes.items():
            sums = {c: [sum(paths[k][j] for k in keys) for j in range(3)] for c, keys in children.items()}
            labelled, bad = sum(s[1] for s in sums.values()), sum(s[2] for s in sums.values())
            pooled = bad / labelled if labelled else 0.0
            rare = sum(s[0] <= url_filter.SEEN for s in sums.values())
            many = len(sums) > url_filter.BRANCHES and rare * 2 > len(sums)
            done = sum(bool(todo[k][1]) for keys in children.values() for k in keys) <= 1
            for child, keys in children.items():
                n, own, worse = sums[child]
                error = math.sqrt(pooled * (1 - pooled) / max(own, 1))
                apart = abs(worse - pooled * own) > url_filter.Z * error * own or len(sums) == 1
                branch = "*" if many and n <= url_filter.SEEN else child if apart else "~"
                for key in keys:
                    rest = todo[key][1][1:]
                    if done:
                        out[key] = "/".join([template, branch, *(rest if branch == child else [])])
                    else:
                        following[key] = ("/".join([template, branch]), rest)
        todo = following
    return out


def verdicts(spark, paths):
    rows = [(h, "/".join(s), *counts) for (h, s), counts in paths.items()]
    found = url_filter.template_verdicts(spark.createDataFrame(rows, "host string, form string, n long, labelled long, bad long"))
    return {(r.host, tuple(r.form.split("/")) if r.form else ()): (r.template, r.bad_share) for r in found.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tree(spark, seed):
    rng, paths = random.Random(seed), {}
    for host in ("a", "b"):
        for _ in range(150):
            top = rng.choice(["spam", "news", "x", f"r{rng.randrange(60)}"])
            deep = rng.choice([(), ("p",), ("p", "q"), ("p", "q", f"s{rng.randrange(4)}", "t"), (f"u{rng.randrange(30)}",)])
            n = rng.randrange(1, 9)
            labelled = rng.randrange(n + 1)
            bad = labelled if top == "spam" else rng.randrange(labelled + 1) if top == "x" else 0
            paths[host, (top, *deep)] = (n, labelled, bad)
    got, want = verdicts(spark, paths), plain_templates(paths)
    # A common run of segments ends a path at once, where the plain tree goes on to its end.
    strip = lambda t: t.rstrip("/")
    assert {k: strip(t) for k, (t, _) in got.items()} == {k: strip(t) for k, t in want.items()}
    share = sum(c[2] for c in paths.values()) / sum(c[1] for c in paths.values())
    by = defaultdict(list)
    for k, (t, _) in got.items():
        by[t].append(paths[k])
    for t, bad_share in set(got.values()):
        labelled, bad = (sum(c[j] for c in by[t]) for j in (1, 2))
        assert bad_share == pytest.approx((bad + url_filter.PRIOR * share) / (labelled + url_filter.PRIOR))


def test_a_bad_branch_among_rare_ones(spark):
    """Frequent children whose share of bad pages differs are no wildcard."""
    urls = [(f"http://h.net/spam/p{chr(97 + k % 26)}{chr(97 + k // 26)}", True) for k in range(400)]
    urls += [(f"http://h.net/news/p{chr(97 + k % 26)}{chr(97 + k // 26)}", False) for k in range(400)]
    urls += [(f"http://h.net/dir{chr(97 + k % 26)}{chr(97 + k // 26)}/one", False) for k in range(30)]
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(k, bad) for k, (_, bad) in enumerate(urls)], "id long, bad boolean")
    found = Counter((r.path.split("/")[1][:4], r.verdict) for r in url_filter.judge(pages, labels).collect())
    assert {k: v for k, v in found.items() if k[0] in ("spam", "news")} == {("spam", "block"): 400, ("news", "allow"): 400}
    assert sum(n for (top, verdict), n in found.items() if top.startswith("dir") and verdict == "allow") == 30


def test_long_chains_take_few_rounds(spark, monkeypatch):
    chain = "/".join(f"seg{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300))
    urls = [f"http://trap.net/{chain}/{end}" for end in ("a", "b", "b/c")] + [f"http://trap.net/{chain}"]
    written = []
    write = url_filter.written
    monkeypatch.setattr(url_filter, "written", lambda df, label, **k: written.append(label) or write(df, label, **k))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = url_filter.judge(pages, spark.createDataFrame([(0, True)], "id long, bad boolean")).collect()
    assert len(found) == 4 and written.count("children") <= 4


# --- shards of archives --------------------------------------------------------------------------


def test_bounds_follow_the_ids(spark):
    """Ids that lie close with one far away, at both ends of their type, and hashes."""
    sets = {
        "clustered": [*range(1, 20_000), 2**60], "ends": [-(2**63), 2**63 - 1, *range(5000)], "one": [7] * 50,
        "hashes": [(k * 0x9E3779B97F4A7C15) % 2**63 for k in range(4000)],
    }
    for name, ids in sets.items():
        rows = spark.createDataFrame([(i,) for i in ids], "page_id long").withColumn("payload", F.lit("x" * 20))
        for cells in (warc.CELLS, 16):
            bounds = warc._shard_bounds(rows, 8, cells)
            sizes = Counter(sum(i >= b for b in bounds) for i in ids)
            assert bounds == sorted(bounds) and (name == "one" or max(sizes.values()) <= 2.2 * len(ids) / 8)


def test_pages_without_an_id_over_shards(spark):
    given = [(None, f"u{k}", f"body {k % 700} " * 30) for k in range(1500)] + [(k, "v", f"body {k} " * 30) for k in range(800)]
    folder = scratch_path(spark, "warc")
    warc.write(spark.createDataFrame(given, "page_id long, url string, html string"), folder, shards=8)
    found = warc.read(spark, folder).collect()
    assert Counter(r.page_id for r in found) == Counter(i for i, *_ in given)
    unnamed = [r for r in found if r.page_id is None]
    assert len({r.file for r in unnamed}) >= 4 and all(r.record_type == "revisit" and r.refers_to is not None for r in unnamed)
    assert all(r.record_type == "response" for r in found if r.page_id is not None)
