"""Token counts with a digest cache.

A text's count is stored under (digest of the normalised text, digest of the tokenizer's version).
A batch of documents asks the cache for its distinct digests; only texts that it lacks are encoded,
each once however many documents have it, and their counts are appended for the next batch.

The cache is a folder of Parquet files, ``tokenizer=<digest>/batch=<id>``: every run appends a batch
of its own and commits it with Spark's writer, so runs may overlap and a run that fails leaves the
cache as it was. A digest that two runs have added at once is read once.

The version's digest covers the tokenizer's file, its library and that library's version, as each
can change a count. ``normalise`` must not change counts (a tokenizer that lower-cases may be asked
for lower-cased texts); by default the text is taken as it is.

Texts are shuffled once, and only those not in the cache if these are few enough for a broadcast of
their digests. A digest that many documents have is salted when counts join documents.

Defined cases: a null text is an empty one, with 0 tokens; strings of special tokens in a text are
taken as the library does by default; a very long text is encoded in parts, cut where no token can
lie; null and repeated ids and rows are all kept; an empty table gives an empty result and appends
nothing; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache
from importlib.metadata import version

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import text as tx
from lakeops.operators.skew import attach_facts, write_facts
from lakeops.session import written

LIMIT = 512
#: Bytes of text that go to the tokenizer in one call; a longer text is cut into parts of about as many.
STEP = 1 << 20
STORED = "digest binary, n_tokens long"
Counter = Callable[[list[str]], list[int]]
# Between a letter or digit and one blank with a letter or digit after it, no byte-level token goes on.
_CUT = re.compile(r"(?<=[A-Za-z0-9])(?= [A-Za-z0-9])")


def plain(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def tokenizer_version(path: str) -> str:
    """Digest of all that a count depends on but the text."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        own = hashlib.sha256(file.read()).hexdigest()
    return hashlib.sha256(f"{own} {library} {version(library)} text only".encode()).hexdigest()


def _parts_add_up(path: str) -> bool:
    """Whether tokens never cross the places of _CUT: byte-level, its own split, special tokens without blanks."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    split = told.get("pre_tokenizer") or {}
    level = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    added = told.get("added_tokens") or []
    return bool(level and not told.get("normalizer") and not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in added))


@lru_cache(maxsize=2)
def _counter(path: str) -> tuple[Counter, bool]:
    """Counts tokens of texts; and whether a text may be cut."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        pieces = SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)], False
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], _parts_add_up(path)


def parts(text: str, most: int) -> list[str]:
    """The text in parts of about ``most`` characters, longer where it can't be cut."""
    found, begin = [], 0
    while len(text) - begin > most:
        place = _CUT.search(text, begin + most)
        if place is None:
            break
        found.append(text[begin : place.start()])
        begin = place.start()
    return [*found, text[begin:]]


def _encode(path: str, step: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, cuttable = _counter(path)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            at = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())])
            totals: list[int] = []
            for i, j in tx.steps(at, step):
                given = texts[i:j].to_pylist()
                if cuttable and at[j] - at[i] > step:  # one long text
                    totals.append(sum(count([part])[0] for part in parts(given[0], step)))
                else:
                    totals += count(given)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(totals, pa.int64())], names=["digest", "n_tokens"])

    return work


def stored_counts(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """STORED rows of the cache for this tokenizer, a digest once."""
    folder = f"{cache}/tokenizer={tokenizer_version(tokenizer)}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], STORED)
    found = spark.read.schema(f"{STORED}, batch string").parquet(folder)
    return found.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def _texts_of(rows: DataFrame, misses: DataFrame, few: bool) -> DataFrame:
    """Each missing digest once, with its text. Copies meet in the map tasks first, so a hot one is no hot key."""
    if few:
        rows = rows.join(F.broadcast(misses), "digest", "left_semi")
    texts = rows.groupBy("digest").agg(F.first("text").alias("text"))
    return texts if few else texts.join(misses, "digest", "left_semi")


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    normalise: Callable[[Column], Column] = plain,
    step: int = STEP,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``; runs jobs and appends to ``cache``.

    ``tokenizer`` is the file that all machines have, ``cache`` a folder that all can reach.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), plain(F.col(text_col)).alias("_own"), normalise(F.col(text_col)).alias("text"))
    keyed = texts.select(
        "doc_id", "_own", "text", F.octet_length("_own").cast("long").alias("n_bytes"), F.unhex(F.sha2("text", 256)).alias("digest")
    )
    # A written number per row lets copies with one id be salted too, and stays as it is when a task is repeated.
    rows = written(keyed.select("doc_id", "n_bytes", "digest", F.xxhash64(F.monotonically_increasing_id()).alias("_noise")), "digests")
    wanted = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    asked = written(wanted.join(stored_counts(spark, cache, tokenizer), "digest", "left"), "asked")

    misses = asked.where("n_tokens IS NULL").select("digest")
    missing = misses.count()
    batch = f"{cache}/tokenizer={tokenizer_version(tokenizer)}/batch={uuid.uuid4().hex}"
    if missing:
        few = missing * 64 <= _bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
        found = _texts_of(keyed.select("digest", "text"), misses, few)
        found.mapInArrow(_encode(tokenizer, step), STORED).write.parquet(batch)
        new = spark.read.schema(STORED).parquet(batch).withColumnsRenamed({"digest": "_digest", "n_tokens": "_new"})
        asked = asked.join(new, F.col("digest") == F.col("_digest"), "left").select(
            "digest", "copies", F.coalesce("n_tokens", "_new").alias("n_tokens")
        )
    facts = write_facts(asked, "copies", "counts")
    return attach_facts(rows, facts, ["digest"], spread_by=["_noise"]).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def _bytes(setting: str) -> int:
    """A size as Spark's settings have it: 10485760, 256k, 10MB."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)b?", setting.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit] if int(number) > 0 else 0
