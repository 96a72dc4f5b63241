"""The pipeline's stages, each on what the one before it left, against plain computations."""

from collections import Counter

import brute
import numpy as np
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(name, input rows, output) of every stage."""
    import corpus_pipeline
    from lakeops.session import written

    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        given = docs.collect()
        docs = written(stage(spark, docs, SF), name)
        found[name] = (given, docs)
    return found


def texts(rows):
    return [(r.doc_id, r.text) for r in rows]


def test_all_but_the_last_return_documents(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    assert [name for name, _ in stages.items()] == ["quality", "near_duplicates", "repeated_passages", "mixing", "packing"]
    assert all(stages[name][1].dtypes == columns for name in list(stages)[:-1])


def test_quality(spark, stages):
    from lakeops.llm import quality

    given, out = stages["quality"]
    judged = quality.judge(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in judged.where("kept").collect()}
    counts = {r.doc_id: brute.rule_counts(r.text) for r in given}
    assert all(counts[r.doc_id][0] >= 50 and 2 * counts[r.doc_id][4] <= counts[r.doc_id][0] for r in out.collect())


def test_near_duplicates(stages):
    given, out = stages["near_duplicates"]
    want = {i for i, n, c in brute.near_components(texts(given)) if i == c or n == 0}
    assert sorted(r.doc_id for r in out.collect()) == sorted(want) and len(want) < len(given)


def test_repeated_passages(stages):
    given, out = stages["repeated_passages"]
    want = {r[0]: r[5].decode(errors="ignore") for r in brute.repeated_bytes(texts(given))}
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {i: (t, len(t)) for i, t in want.items()}


def test_mixing(spark, stages):
    from lakeops.llm import mixing

    given, out = stages["mixing"]
    plan = mixing.plan_mix(stages["repeated_passages"][1]).collect()
    assert Counter(r.doc_id for r in out.collect()) == +Counter({r.doc_id: r.copies for r in plan})
    by_id = {r.doc_id: r for r in given}
    assert all(by_id[r.doc_id] == r for r in out.collect())


def test_packing(stages):
    from tokenizers import Tokenizer

    from lakeops.llm.queries import tokenizer

    given, out = stages["packing"]
    tool, want = Tokenizer.from_file(tokenizer()), Counter()
    for i, t in texts(given):
        n = len(tool.encode(t or "", add_special_tokens=False).ids) + 1
        want.update((i, k // 2048, min(2048, n - k)) for k in range(0, n, 2048))
    rows = out.collect()
    assert Counter((r.doc_id, r.piece, r.length) for r in rows) == want
    filled = Counter()
    for r in rows:
        filled[r.sequence_id] += r.length
    ends = {(r.sequence_id, r.offset + r.length) for r in rows} | {(s, 0) for s in filled}
    assert max(filled.values()) <= 2048 and all((r.sequence_id, r.offset) in ends for r in rows)
    assert len(filled) <= np.ceil(sum(filled.values()) / 2048) + 1


def test_run(spark, stages):
    import corpus_pipeline

    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    kept = lambda df: Counter(tuple(r) for r in df.select(*names).collect())
    assert kept(corpus_pipeline.run(spark, SF)) == kept(stages["packing"][1])


def test_run_leaves_no_shuffles(spark, stages, shuffles_left, monkeypatch):
    """What stages have shuffled is gone when the next one begins, also what the one without near copies did at its end."""
    import corpus_pipeline

    last = ("as it is", lambda spark, docs, sf_dir: docs)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [*corpus_pipeline.STAGES[:2], last])
    found = corpus_pipeline.run(spark, SF)
    assert not shuffles_left()
    assert sorted(r.doc_id for r in found.collect()) == sorted(r.doc_id for r in stages["near_duplicates"][1].collect())


def test_stages_of_odd_documents(spark, docs, given):
    """Nulls, ties, repeated rows, very long texts and clashing columns go through every stage."""
    import corpus_pipeline
    from lakeops.session import written

    columns, left, texts_left = docs.dtypes, docs, Counter(t for _, t in given)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = written(stage(spark, left, SF), name)
        assert left.dtypes == columns
        rows = left.collect()
        assert 0 < len(rows) and (name == "mixing" or len(rows) <= len(given))
        if name in ("quality", "near_duplicates"):
            assert not Counter(r.text for r in rows) - texts_left
            texts_left = Counter(r.text for r in rows)
            assert all(len((t or "").split()) >= 50 for t in texts_left)
        if name == "near_duplicates":
            found = sorted((r.doc_id for r in rows if r.doc_id is not None))
            assert found == sorted(set(found))  # rows alike are one
            assert 9016 in found  # the very long one
    pieces = corpus_pipeline.STAGES[-1][1](spark, left, SF).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in left.collect()} and max(r.length for r in pieces) == 2048


def test_stages_of_an_empty_table(spark, none):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, SF)
        assert out.count() == 0 and (name == "packing" or out.dtypes == none.dtypes)
