"""Token totals that are kept up to date by signed changes.

A batch of changes shrinks to one signed row per source, language and tokenizer
version and is committed under its own id, so a total is the sum over the
committed batches and no document is counted again. A batch that was committed
before changes nothing; one that was cut short left no commit and is written anew.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordflow.llm.common import written

KEYS = ["source", "lang", "tokenizer"]
TOTALS = T.StructType(
    [T.StructField(k, T.StringType()) for k in KEYS]
    + [T.StructField(c, T.LongType()) for c in ("documents", "tokens", "changes")]
)

@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The byte-level BPE of a rank file, once per process."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(text: Column, path: str, pattern: str) -> Column:
    """Tokens of each text; 0 for null and empty ones."""

    @F.pandas_udf("bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoding(path, pattern)
        for texts in batches:
            yield pd.Series([len(own.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return of(text)


def inserts(counted: DataFrame, tokens: str = "tokens") -> DataFrame:
    """A change per row that adds a document."""
    return counted.select(*KEYS, F.lit(None).cast("bigint").alias("before"), F.col(tokens).alias("after"))


def deletes(counted: DataFrame, tokens: str = "tokens") -> DataFrame:
    """A change per row that takes a document away."""
    return counted.select(*KEYS, F.col(tokens).alias("before"), F.lit(None).cast("bigint").alias("after"))


def revisions(counted: DataFrame, before: str, after: str) -> DataFrame:
    """A change per row that corrects a document's count."""
    return counted.select(*KEYS, F.col(before).alias("before"), F.col(after).alias("after"))


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums per key: ``documents, tokens, changes``.

    ``before`` is null for an insert, ``after`` for a delete; a change with both is
    a revision, with neither it counts as a change only.
    """
    there = F.col("after").isNotNull().cast("bigint") - F.col("before").isNotNull().cast("bigint")
    more = F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0))
    return changes.groupBy(*KEYS).agg(
        F.sum(there).alias("documents"), F.sum(more).alias("tokens"), F.count("*").alias("changes")
    )


class Rollup:
    """Totals by source, language and tokenizer version in a folder that all executors see.

    One writer commits and compacts at a time. A folded table lies under ``base=<n>``
    with the ids of its batches; the newest one with its mark counts, and batches that
    it holds do not, whether they were removed already or not.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _place(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _found(self, kind: str, mark: str) -> list[str]:
        """Names behind ``kind=`` of the folders that have their mark."""
        fs, path = self._place()
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return [n.partition("=")[2] for n in names if n.startswith(f"{kind}=") and self._done(n, mark)]

    def _done(self, name: str, mark: str = "_SUCCESS") -> bool:
        fs, path = self._place(name, mark)
        return fs.exists(path)

    def _base(self) -> int:
        """The number of the newest folded table, 0 without any."""
        return max(map(int, self._found("base", "_FOLDED")), default=0)

    def _folded(self, base: int) -> set[str]:
        if not base:
            return set()
        return {r.batch for r in self.spark.read.parquet(f"{self.folder}/base={base}/ids").collect()}

    def committed(self) -> list[str]:
        """Ids of the committed batches: those whose writer left its mark, folded ones too."""
        return sorted({*self._found("batch", "_SUCCESS"), *self._folded(self._base())})

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch; False, and nothing done, if it was committed before.

        ``batch`` is letters, digits, dots, dashes and underscores.
        """
        if not batch or not all(c.isalnum() or c in "._-" for c in batch):
            raise ValueError(f"not a batch id: {batch!r}")
        if self._done(f"batch={batch}") or batch in self._folded(self._base()):
            return False
        # The mark is written last, by the driver, after the files of all tasks were moved in place.
        deltas(changes).select(*[F.col(f.name).cast(f.dataType) for f in TOTALS]).write.mode(
            "overwrite"
        ).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(
            f"{self.folder}/batch={batch}"
        )
        return True

    def compact(self) -> bool:
        """Folds all committed batches into one table; False if there is nothing new to fold.

        The mark is written last; what was folded is removed behind it. Cut short
        anywhere, every batch still counts once.
        """
        before = self._base()
        folded = self._folded(before)
        fresh = [b for b in self._found("batch", "_SUCCESS") if b not in folded]
        if not fresh:
            return False
        base = f"base={before + 1}"
        self.totals().write.mode("overwrite").parquet(f"{self.folder}/{base}/totals")
        ids = self.spark.createDataFrame([(b,) for b in sorted({*folded, *fresh})], "batch string")
        ids.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{base}/ids")
        fs, mark = self._place(base, "_FOLDED")
        fs.create(mark, True).close()
        for old in [f"batch={b}" for b in {*folded, *fresh}] + [f"base={before}"] * bool(before):
            fs, path = self._place(old)
            fs.delete(path, True)
        return True

    def totals(self) -> DataFrame:
        """One row per key that was ever changed: ``documents, tokens, changes``."""
        base = self._base()
        folded = self._folded(base)
        paths = [f"{self.folder}/batch={b}" for b in self._found("batch", "_SUCCESS") if b not in folded]
        paths += [f"{self.folder}/base={base}/totals"] * bool(base)
        if not paths:
            return self.spark.createDataFrame([], TOTALS)
        found = self.spark.read.schema(TOTALS).parquet(*paths)
        return found.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("documents", "tokens", "changes")])


def count_documents(
    docs: DataFrame,
    version: str,
    path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    lang_column: str = "lang",
) -> DataFrame:
    """``doc_id, source, lang, tokenizer, tokens, guess, digest`` per row, texts counted once and stored.

    ``guess`` is a quarter of the characters, rounded up; ``digest`` tells texts
    apart. Null texts are like empty ones: no tokens. Null sources and languages
    are keys of their own. Rows may repeat; other columns are not looked at.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    return written(
        docs.select(
            F.col(f"`{id_column}`").alias("doc_id"),
            F.col(f"`{source_column}`").cast("string").alias("source"),
            F.col(f"`{lang_column}`").cast("string").alias("lang"),
            F.lit(version).alias("tokenizer"),
            token_counts(text, path, pattern).alias("tokens"),
            F.ceil(F.length(text) / 4).alias("guess"),
            F.sha2(text, 256).alias("digest"),
        ),
        "token-counts",
    )


def copies_marked(counted: DataFrame) -> DataFrame:
    """The rows with ``later``: whether a smaller id has the same text; rows without an id are no one's copies."""
    first = counted.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    # Stored, so that the join is of two plain shuffles and a frequent text can be split.
    held = written(first.filter("first < last").select("digest", "first"), "copies")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return counted.join(held, "digest", "left").select(*counted.columns, later.alias("later"))


def later_copies(counted: DataFrame) -> DataFrame:
    """Rows whose text a smaller id has too."""
    return copies_marked(counted).filter("later").drop("later")
