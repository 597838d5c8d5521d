"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are never recounted.  A batch of signed changes
(an insert adds a document and its tokens, a delete takes both away, a revision adds the difference
between the new count and the old) is summed to a few delta rows and committed under a batch id.
Totals are the sum of all committed deltas, in any order.

Commits are idempotent.  Each run of a batch writes to a folder of its own beside the ledger, which
is then renamed to the batch's id by a rename that fails where the id is there already; so of runs
that race one wins, and a job that was lost and runs again, or a batch that is delivered twice, counts
once.  A run that dies before its rename leaves a hidden folder that nothing reads.  `compact` sums
what is committed to one folder that takes these batches' place for readers.  The ledger is a folder
that executors and driver share.

Edge cases: null texts have 0 tokens and count as documents, very long ones are read whole; null
sources and languages are groups of their own; a delete or a revision of a document that the state
doesn't hold changes nothing; repeated rows are counted as often as they occur; an empty table or
batch commits and changes nothing; only doc_id, text, source and lang are read, so other columns may
have any name.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_groups
from .textvec import steps

KEYS = ("source", "lang", "version")
DELTA_SCHEMA = "source string, lang string, version string, d_docs long, d_tokens long"
#: How byte-level BPE vocabularies cut text before merging (a published pattern).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"

_encodings: dict = {}


def _encoding(content: bytes, pattern: str):
    key = hash((content, pattern))
    if key not in _encodings:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}
        _encodings.clear()
        _encodings[key] = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[key]


def count_tokens(docs: DataFrame, path: str, version: str, *, doc_id: str = "doc_id", text: str = "text", pattern: str = PATTERN) -> DataFrame:
    """Per document: doc_id, source, lang, version, n_tokens, text_hash."""
    with open(path, "rb") as f:
        content = f.read()
    rows = docs.select(F.col(text).alias("text"), F.col(doc_id).alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.xxhash64(F.col(text)).alias("text_hash"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(content, pattern).encode_ordinary
        for batch in batches:
            for a, b in steps(batch.column(0)):
                part = batch.slice(a, b - a)
                n = [len(encode(t)) for t in pc.fill_null(part.column(0), "").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[1:4], pa.array([version] * len(n)), pa.array(n, pa.int64()), part.column(4)], names=["doc_id", "source", "lang", "version", "n_tokens", "text_hash"])

    return rows.mapInArrow(run, f"doc_id {kind}, source string, lang string, version string, n_tokens long, text_hash long")


def _signed(rows: DataFrame, docs: int, tokens) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum(F.lit(docs)).cast("long").alias("d_docs"), F.sum(tokens).cast("long").alias("d_tokens"))


def inserts(counts: DataFrame) -> DataFrame:
    return _signed(counts, 1, F.col("n_tokens"))


def deletes(state: DataFrame, gone: DataFrame) -> DataFrame:
    """state: the counted documents; gone: doc_id of those that go."""
    return _signed(state.join(gone.select("doc_id").distinct(), "doc_id", "left_semi"), -1, -F.col("n_tokens"))


def revisions(state: DataFrame, revised: DataFrame) -> DataFrame:
    """revised: doc_id and new_tokens of documents that are counted anew (the last word is the largest id's only row)."""
    new = revised.groupBy("doc_id").agg(F.max("new_tokens").alias("new_tokens"))
    return _signed(state.join(new, "doc_id"), 0, F.col("new_tokens") - F.col("n_tokens"))


class Ledger:
    """Committed batches of deltas in a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._root)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _names(self, kind: str) -> list[str]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._root)]
        return sorted(n.removeprefix(f"{kind}=") for n in names if n.startswith(f"{kind}="))

    def batches(self) -> list[str]:
        return self._names("batch")

    def _publish(self, rows: DataFrame, name: str) -> bool:
        """Writes rows under a name of their own and renames them; False if the name is taken."""
        pending = f".pending-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{pending}")
        sc = self.spark.sparkContext
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        none = sc._gateway.new_array(rename, 1)
        none[0] = rename.NONE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._root.toUri(), sc._jsc.hadoopConfiguration()).rename(self._at(pending), self._at(name), none)
        except Py4JJavaError as e:
            self._fs.delete(self._at(pending), True)
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            return False
        return True

    def commit(self, batch_id: str, deltas: DataFrame) -> bool:
        """Adds a batch of deltas; False if the batch is there already, whoever committed it."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
            raise ValueError(f"not a batch id: {batch_id!r}")
        if self._fs.exists(self._at(f"batch={batch_id}")):
            return False
        rows = deltas.select(*KEYS, "d_docs", "d_tokens").groupBy(*KEYS).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
        return self._publish(rows, f"batch={batch_id}")

    def _base(self) -> tuple[DataFrame, set[str]]:
        """The deltas of the widest compaction and the batches that it stands for."""
        found: DataFrame = self.spark.createDataFrame([], DELTA_SCHEMA)
        held: set[str] = set()
        for name in self._names("base"):
            rows = self.spark.read.parquet(f"{self.path}/base={name}")
            batches = {r["batch"] for r in rows.filter("batch is not null").select("batch").collect()}  # a row a batch
            if len(batches) > len(held):
                found, held = rows.filter("batch is null").drop("batch"), batches
        return found, held

    def _deltas(self) -> tuple[DataFrame, set[str]]:
        found, held = self._base()
        new = [b for b in self.batches() if b not in held]
        if new:
            found = found.unionByName(self.spark.read.schema(DELTA_SCHEMA).parquet(*[f"{self.path}/batch={b}" for b in new]))
        return found, held | set(new)

    def compact(self) -> int:
        """Sums all committed batches to one folder; the number of batches that it stands for."""
        found, held = self._deltas()
        rows = found.groupBy(*KEYS).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens")).withColumn("batch", F.lit(None).cast("string"))
        named = self.spark.createDataFrame([(None, None, None, 0, 0, b) for b in sorted(held)], DELTA_SCHEMA + ", batch string")
        if held:
            self._publish(rows.unionByName(named), f"base={uuid.uuid4().hex}")
        return len(held)

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens over all committed batches; groups without documents go."""
        found, _ = self._deltas()
        summed = found.groupBy(*KEYS).agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))
        return summed.filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))


def later_copies(counts: DataFrame) -> DataFrame:
    """doc_id of documents whose text (by hash and count) a smaller id has too."""
    first = counts.groupBy(F.col("text_hash").alias("h"), F.col("n_tokens").alias("t")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("c")).filter("c > 1")
    rows = counts.select("doc_id", "text_hash", "n_tokens")
    return join_groups(rows, first, {"text_hash": "h", "n_tokens": "t"}, "c").filter(F.col("doc_id") > F.col("first_id")).select("doc_id")
