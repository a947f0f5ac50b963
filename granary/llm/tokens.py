"""Token counts through a digest cache.

A document's content (null as empty; byte-level vocabularies need no further normalisation) is digested together with the
tokenizer file's version. Digests are joined to the stored counts; each distinct miss is encoded once, and the new counts
are appended to the cache. Copies meet in a map-side minimum before the shuffle, so a group of copies costs one row a task.

Within a task, a text without adjacent spaces is cut before its single spaces, where a byte-level pre-tokenizer
always cuts, and the pieces' counts are kept in a bounded dictionary. Texts with other spacing or with special strings, and
other kinds of tokenizer, are encoded whole.

Null text: as empty, no tokens. Empty table: no rows. Repeated rows: each returned. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices

CACHE = "digest string, version string, n_tokens long"
_loaded: dict = {}


def version_of(path: str) -> str:
    """Digest of the tokenizer's file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()[:16]


def locate(name: str) -> str:
    """A tokenizer's file by its path, or by its name in the installed collection."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


class Counter:
    """Counts tokens as the file's library does, without added special tokens."""

    def __init__(self, name: str, most: int = 300_000):
        path = locate(name)
        self.known, self.most, self.cut = {}, most, False
        if path.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            self.encode = lambda texts: [len(x) for x in tok.encode_batch_fast(texts, add_special_tokens=False)]
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            pre = spec.get("pre_tokenizer") or {}
            self.cut = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and spec["model"].get("type") == "BPE"
            special = [re.escape(x["content"]) for x in spec.get("added_tokens", [])]
            self.odd = re.compile("|".join([r"\s\s", *special]))
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]

    def __call__(self, texts: list[str]) -> list[int]:
        plain = [self.cut and not self.odd.search(x) for x in texts]
        whole = iter(self.encode([x for x, p in zip(texts, plain) if not p]))
        cut = []
        for x, p in zip(texts, plain):
            if p:
                head, *tail = x.split(" ")
                cut.append(([head] if head else [], tail))
        known = self.known
        if len(known) > self.most:
            known.clear()
        # ("", x) is a text's first piece, which has no space before it; x stands for " x"
        firsts = list({y for head, _ in cut for y in head if ("", y) not in known})
        rest = list({y for _, tail in cut for y in tail if y not in known})
        known.update(zip((("", y) for y in firsts), self.encode(firsts)))
        known.update(zip(rest, self.encode([" " + y for y in rest])))
        done = iter([sum(known["", y] for y in head) + sum(map(known.__getitem__, tail)) for head, tail in cut])
        return [next(done) if p else next(whole) for p in plain]


def _encode(name: str):
    def run(batches):
        import pyarrow as pa

        count = _loaded.get(name) or _loaded.setdefault(name, Counter(name))
        for part in slices(batches, ["text"]):
            yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(count(part.column("text").to_pylist()), pa.int64())], names=["digest", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 512, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and digest for each row. cache: folder of the stored counts; without one,
    a table of this run only. A run that is repeated after a failed append counts again what was not stored."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "tokens")
    version = version_of(locate(tokenizer))
    cache = cache or f"{scratch.root}/cache"
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"), F.sha2(body, 256).alias("digest"))
    try:
        stored = spark.read.schema(CACHE).parquet(cache)
        stored.limit(1).count()
    except Exception as e:  # noqa: BLE001  the first run has no cache yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stored = spark.createDataFrame([], CACHE)
    fit = stored.where(F.col("version") == version)
    miss = x.groupBy("digest").agg(F.min("text").alias("text")).join(fit.select("digest"), "digest", "left_anti")
    new = miss.mapInArrow(_encode(tokenizer), "digest string, n_tokens long")
    new.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache)
    counts = spark.read.schema(CACHE).parquet(cache).where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return x.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")).join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "digest")
