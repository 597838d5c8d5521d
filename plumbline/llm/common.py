"""What the operators share: row keys, the learning fold, shared-folder checkpoints, packed exchange."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import shared_folder as checkpoint_folder

from .textvec import U


def remainder5(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; rows whose remainder is 0 are held out of all learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def held_out(doc_id: Column) -> Column:
    """True where the remainder is 0; a null id is never held out, and never learnt from either."""
    return F.coalesce(remainder5(doc_id) == 0, F.lit(False))


def settle() -> None:
    """Gives memory that a finished step no longer needs back to the machine; Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and cut from its lineage."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: A group is hot if it holds more than one in HOT rows; there are fewer than HOT such groups, whatever the data.
HOT = 1_000


def join_groups(rows: DataFrame, groups: DataFrame, on: dict[str, str], size: str) -> DataFrame:
    """rows with the columns of their group, where they have one.

    groups: one row a key, `size` the number of its rows; on: the rows' keys by the groups' (no null).
    Hot groups (fewer than HOT rows) are broadcast, so their rows stay where they are; of the rest,
    which are dealt out by key, none is large.
    """
    groups = checkpointed(groups)
    total = int(groups.agg(F.sum(size).alias("n")).first()["n"] or 0)
    cond = F.lit(True)
    for mine, theirs in on.items():
        cond &= F.col(mine) == F.col(theirs)
    hot = F.col(size) * HOT > total
    few, many = groups.filter(hot), groups.filter(~hot)
    return rows.join(F.broadcast(few), cond).unionByName(rows.join(F.broadcast(few.select(*on.values())), cond, "left_anti").join(many, cond))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, column: str) -> int:
    """Bytes of text in the whole table: one narrow scan, from which plans take their numbers of parts."""
    return int(docs.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0)


def bucket_count(spark: SparkSession, entries: float, per_bucket: int = 1_000_000, least: int = 2) -> int:
    """Buckets of a packed exchange: enough for bounded buckets, and `least` for each shuffle partition."""
    return max(least * shuffle_partitions(spark), math.ceil(entries / per_bucket))


def _murmur3(x: np.ndarray) -> np.ndarray:
    """Spark's hash of 32-bit integers, which deals rows out by such a column."""
    with np.errstate(over="ignore"):
        turn = lambda v, r: (v << np.uint32(r)) | (v >> np.uint32(32 - r))
        k = turn(x.astype(np.uint32) * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h = turn(np.uint32(42) ^ k, 13) * np.uint32(5) + np.uint32(0xE6546B64)
        h ^= np.uint32(4)
        for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            h = (h ^ (h >> np.uint32(shift))) * np.uint32(by)
        return (h ^ (h >> np.uint32(16))).view(np.int32)


def even_labels(spark: SparkSession, buckets: int) -> np.ndarray:
    """A label (0 or more) for each bucket, so that rows dealt out by label put equally many buckets in each shuffle partition.

    Numbers from 0 on would collide: of as many buckets as partitions, a third of the partitions gets none and some get four.
    """
    n = shuffle_partitions(spark)
    each = -(-buckets // n)
    tries = np.arange(4 * buckets + 64 * n, dtype=np.int64)
    while True:
        part = np.mod(_murmur3(tries).astype(np.int64), n)
        order = np.argsort(part, kind="stable")
        first = np.searchsorted(part[order], np.arange(n))
        if (np.diff(np.append(first, len(order))) >= each).all():
            return np.concatenate([tries[order[first + k]] for k in range(each)])[:buckets].astype(np.int32)
        tries = np.arange(2 * len(tries), dtype=np.int64)


# Packed exchange -----------------------------------------------------------------------------------
#
# Fingerprints leave a task as a few rows, one a bucket, each holding the columns of many entries as
# bytes.  Buckets are ranges of the (uniform) 64-bit key, so one sort puts a step's entries in bucket
# order.  An entry costs its own bytes instead of a row's.


def planes(x: np.ndarray) -> bytes:
    """The bytes of an array by significance: high bytes that are zero compress to nothing."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes()


def unplanes(b: memoryview, n: int, dtype: np.dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8, n * size).reshape(size, n).T).view(dtype).reshape(n)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> U(32)) * U(buckets)) >> U(32)


def pack(columns: list[np.ndarray], labels: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(label of the bucket, bytes) of entries whose first column, a uint64 key, is sorted; there is a bucket for each label."""
    if not len(columns[0]):
        return
    b = bucket_of(columns[0], len(labels))
    edges = runs(b)
    for lo, hi in zip(edges, np.append(edges[1:], len(b)), strict=True):
        yield int(labels[int(b[lo])]), np.uint32(hi - lo).tobytes() + b"".join(planes(c[lo:hi]) for c in columns)


def unpack(blobs: Iterable, dtypes: list) -> list[np.ndarray]:
    """The columns of all blobs, one after another."""
    parts: list[list[np.ndarray]] = [[] for _ in dtypes]
    for blob in blobs:
        view = memoryview(blob)
        n = int(np.frombuffer(view, np.uint32, 1)[0])
        at = 4
        for k, dtype in enumerate(dtypes):
            size = n * np.dtype(dtype).itemsize
            parts[k].append(unplanes(view[at : at + size], n, dtype))
            at += size
    return [np.concatenate(p) if p else np.zeros(0, d) for p, d in zip(parts, dtypes, strict=True)]


def packed_batch(rows: Iterable[tuple[int, bytes]]) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "entries"])


def id_array(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids as int64 (null: 0) and where they are there."""
    valid = np.asarray(column.is_valid())
    return np.asarray(column.fill_null(0)).astype(np.int64), valid


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
