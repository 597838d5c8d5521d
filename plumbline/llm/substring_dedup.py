"""Removal of long passages that a document with a smaller id holds too, by difference-cover anchors.

A window is WINDOW consecutive words.  Hashing every window of the corpus would move as many entries
as there are words.  Instead, ANCHOR-word windows are hashed only where their position modulo PERIOD
is in COVER, a difference cover: for any two positions some shift below PERIOD puts both into it.
As ANCHOR + PERIOD - 1 = WINDOW, two equal windows always hold an aligned pair of equal anchors.

1. Anchors meet by hash; those that two documents share are told to their documents.
2. Around shared anchors only, documents extend to the windows that hold them and hash these whole.
3. Windows meet by hash (96 bits of two independent hashes); those that a smaller id has too are told to their documents.
4. Each document drops the words that such windows cover.

Equality of windows is by those 96 bits: of the 10**13 windows that 100 TB hold, all pairs give a chance
of less than one in a thousand that two unequal ones meet.  The hashes are not linear in the text, so
regular texts (Thue-Morse words, say) meet no more often than others.

Entries travel packed, a row a bucket.  Before they leave a task, equal entries are merged: only the
task's smallest id goes on, the others know enough already.  So a passage in a third of all rows
costs one entry a task, not one a row.  Buckets are ranges of a hash and bounded by the input's size.

Edge cases: a null text has no words; documents of under WINDOW words lose nothing and cause no
loss; rows with a null id lose nothing and cause no loss; repeated rows and rows that share an id
don't count as smaller than each other, each is judged for itself; ties don't occur, ids decide.
Columns besides id and text are passed through under their names; the result's own columns carry
a prefix of the caller's choice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bucket_count, even_labels, id_array, pack, packed_batch, planes, runs, settle, text_bytes, unpack
from .textvec import SEEDS, U, Words, flat, steps, windows

WINDOW = 50
PERIOD = 31
#: A perfect difference set: every difference modulo 31 occurs, each once.
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1
STEP_BYTES = 1_500_000
#: Text that meets its own anchors in one step.
PART_BYTES = 3_000_000
ENTRIES = 400_000

_COVERED = np.zeros(PERIOD, dtype=bool)
_COVERED[list(COVER)] = True
_TOLD = [np.int64, np.uint32, np.uint32]  # document, position, check


def _prime(n: int) -> int:
    """The least prime from n on: ids that share a factor still spread."""
    while n < 2 or any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _check(h: np.ndarray) -> np.ndarray:
    return (h & U(0xFFFFFFFF)).astype(np.uint32)


def _tell(doc: np.ndarray, pos: np.ndarray, check: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """Packed rows for the parts that the documents are in."""
    if not len(doc):
        return
    part = np.mod(doc, parts)
    order = np.lexsort((pos, doc, part))
    part, doc, pos, check = part[order], doc[order], pos[order], check[order]
    edges = runs(part)
    for lo, hi in zip(edges, np.append(edges[1:], len(part)), strict=True):
        yield int(part[lo]), np.uint32(hi - lo).tobytes() + planes(doc[lo:hi]) + planes(pos[lo:hi]) + planes(check[lo:hi])


def _owners(keys: list[np.ndarray], doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by key, document and position; then, in that order, the smallest document of the key and whether there are others."""
    order = np.lexsort((pos, doc, *reversed(keys)))
    new = np.zeros(len(order), dtype=bool)
    if len(order):
        new[0] = True
        for k in keys:
            s = k[order]
            new[1:] |= s[1:] != s[:-1]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(order)))
    d = doc[order]
    least = np.repeat(d[first], size)
    many = np.repeat(d[first] != d[first + size - 1], size) if len(first) else np.zeros(0, bool)
    return order, least, many


def _anchors(buckets: np.ndarray, parts: int):
    """Texts to packed anchors (bucket >= 0), and what the task knows by itself (bucket -1 - part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, valid = id_array(batch.column(0))
            for a, b in steps(batch.column(1), STEP_BYTES):
                w = Words(*flat(batch.column(1).slice(a, b - a)))
                g = windows(w.hashes(), ANCHOR)
                pos = (np.arange(len(w)) - np.repeat(w.first[:-1], w.counts))[: len(g)]
                usable = np.repeat((w.counts >= WINDOW) & valid[a:b], w.counts)[: len(g)]
                at = np.flatnonzero(usable & _COVERED[pos % PERIOD] & (w.left[: len(g)] >= ANCHOR))
                key, doc, pos = g[at], ids[a:b][w.text_of[at]], pos[at].astype(np.uint32)
                order, least, many = _owners([key], doc, pos)
                key, doc, pos = key[order], doc[order], pos[order]
                on = doc == least
                yield packed_batch([*pack([key[on], doc[on], pos[on], many[on].astype(np.uint8)], buckets), *((-1 - p, x) for p, x in _tell(doc[many], pos[many], _check(key[many]), parts))])
        settle()

    return run


def _passed(table: pa.Table) -> pa.Table | None:
    """What tasks knew by themselves goes through, put together to one row."""
    bucket = table["bucket"][0].as_py()
    if bucket >= 0:
        return None
    doc, pos, check = unpack(table["entries"].to_pylist(), _TOLD)
    return _told([(-1 - bucket, np.uint32(len(doc)).tobytes() + planes(doc) + planes(pos) + planes(check))])


def _told(rows: Iterator[tuple[int, bytes]]) -> pa.Table:
    rows = list(rows)
    return pa.table({"part": pa.array([r[0] for r in rows], pa.int32()), "entries": pa.array([r[1] for r in rows], pa.binary())})


def _meet_anchors(parts: int):
    def run(table: pa.Table) -> pa.Table:
        if (passed := _passed(table)) is not None:
            return passed
        key, doc, pos, known = unpack(table["entries"].to_pylist(), [np.uint64, np.int64, np.uint32, np.uint8])
        order, _, many = _owners([key], doc, pos)
        news = order[many & (known[order] == 0)]
        # An owner that met others in its task has told them; alone here, it needs nothing more.
        return _told(_tell(doc[news], pos[news], _check(key[news]), parts))

    return run


def _extend(id_at: int, text_at: int, buckets: np.ndarray, parts: int):
    """Texts and their shared anchors to packed windows, merged within the part."""

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        empty = packed_batch([])
        if not len(texts) or not len(told):
            return pa.Table.from_batches([empty])
        doc, pos, check = unpack(told["entries"].to_pylist(), _TOLD)
        order = np.lexsort((pos, doc))
        doc, pos, check = doc[order], pos[order], check[order]
        ids, valid = id_array(texts.column(id_at).combine_chunks())
        mine = np.flatnonzero(valid & np.isin(ids, doc))
        texts, ids = texts.take(pa.array(mine)), ids[mine]
        out: list[list[np.ndarray]] = [[], [], [], []]
        column = texts.column(text_at).combine_chunks()
        for a, b in steps(column, STEP_BYTES):
            w = Words(*flat(column.slice(a, b - a)))
            h = w.hashes()
            anchor, whole, second = windows(h, ANCHOR), windows(h, WINDOW), windows(w.hashes(SEEDS[1]), WINDOW)
            mark = np.zeros(len(w) + 1, dtype=np.int32)
            for k in range(b - a):
                n, first = w.counts[k], w.first[k]
                if n < WINDOW:
                    continue
                lo, hi = np.searchsorted(doc, ids[a + k]), np.searchsorted(doc, ids[a + k], "right")
                p, c = pos[lo:hi].astype(np.int64), check[lo:hi]
                fits = p + ANCHOR <= n
                p, c = p[fits], c[fits]
                p = p[_check(anchor[first + p]) == c]  # of rows that share an id, those that the anchor came from
                np.add.at(mark, first + np.maximum(p - (PERIOD - 1), 0), 1)
                np.add.at(mark, first + np.maximum(np.minimum(p, n - WINDOW), np.maximum(p - (PERIOD - 1), 0) - 1) + 1, -1)
            at = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            at = at[w.left[at] >= WINDOW]
            text = w.text_of[at]
            for x, y in zip(out, (whole[at], _check(second[at]), ids[a + text], (at - w.first[text]).astype(np.uint32)), strict=True):
                x.append(y)
        key, check, doc, pos = (np.concatenate(x) for x in out)
        order, least, _ = _owners([key, check], doc, pos)
        key, check, doc, pos = key[order], check[order], doc[order], pos[order]
        on = doc == least
        del out
        settle()
        return pa.Table.from_batches([packed_batch([*pack([key[on], doc[on], pos[on], check[on]], buckets), *((-1 - p, x) for p, x in _tell(doc[~on], pos[~on], check[~on], parts))])])

    return run


def _meet_windows(parts: int):
    def run(table: pa.Table) -> pa.Table:
        if (passed := _passed(table)) is not None:
            return passed
        key, doc, pos, check = unpack(table["entries"].to_pylist(), [np.uint64, np.int64, np.uint32, np.uint32])
        order, least, _ = _owners([key, check], doc, pos)
        later = order[doc[order] > least]
        return _told(_tell(doc[later], pos[later], check[later], parts))

    return run


def _drop(names: list[str], id_at: int, text_at: int, with_text: bool):
    """Texts and their covered windows to the result's rows."""

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        doc, pos, check = unpack(told["entries"].to_pylist() if len(told) else [], _TOLD)
        order = np.argsort(doc, kind="stable")
        doc, pos, check = doc[order], pos[order], check[order]
        ids, valid = id_array(texts.column(id_at).combine_chunks())
        column = texts.column(text_at).combine_chunks()
        n_words, n_removed, digest, left = [], [], [], []
        for k, text in enumerate(column.to_pylist()):
            raw = (text or "").encode("utf-8")
            words = raw.split()  # at exactly the blanks 09-0D and 20
            lo, hi = (np.searchsorted(doc, ids[k]), np.searchsorted(doc, ids[k], "right")) if valid[k] else (0, 0)
            kept = words
            if hi > lo and len(words) >= WINDOW:
                w = Words(*flat(column.slice(k, 1)))
                second = windows(w.hashes(SEEDS[1]), WINDOW)
                p = pos[lo:hi].astype(np.int64)
                fits = p < len(second)
                p = p[fits][_check(second[p[fits]]) == check[lo:hi][fits]]
                mark = np.zeros(len(words) + 1, dtype=np.int32)
                np.add.at(mark, p, 1)
                np.add.at(mark, p + WINDOW, -1)
                keep = np.cumsum(mark[:-1]) == 0
                if not keep.all():
                    kept = list(compress(words, keep))
                    if with_text:  # what stands between kept words stays as it was
                        edge = np.flatnonzero(np.diff(np.concatenate([[0], keep, [0]])))
                        stops = np.append(w.starts, len(raw))
                        text = b"".join(raw[stops[a] : stops[b]] for a, b in zip(edge[::2], edge[1::2], strict=True)).decode("utf-8").rstrip("\t\n\v\f\r ")
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            left.append(text)
        columns = [*texts.columns[1:], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())]
        if with_text:
            columns.append(pa.array(left, pa.string()))
        return pa.table(dict(zip(names, columns, strict=True)))

    return run


def substring_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", with_text: bool = True, prefix: str = "") -> DataFrame:
    """docs (all columns) with n_words, n_removed, kept_sha256 and, if asked for, kept_text (null stays null)."""
    spark = docs.sparkSession
    size = text_bytes(docs, text)
    buckets = even_labels(spark, bucket_count(spark, size / 6 / PERIOD * len(COVER), ENTRIES, least=1))
    parts = _prime(bucket_count(spark, size, PART_BYTES))
    added = ["n_words", "n_removed", "kept_sha256", *(["kept_text"] if with_text else [])]
    kinds = ["long", "long", "string", "string"]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(prefix + n, T._parse_datatype_string(k)) for n, k in zip(added, kinds, strict=False))])
    id_at, text_at = 1 + docs.columns.index(doc_id), 1 + docs.columns.index(text)

    key = F.col(doc_id).cast("long")
    part = F.coalesce(F.pmod(key, F.lit(parts).cast("long")), F.pmod(F.xxhash64(F.col(text)), F.lit(parts).cast("long"))).cast("int")
    part_name = "part" if "part" not in docs.columns else "_part_" + "_".join(docs.columns)
    texts = docs.select(part.alias(part_name), *[F.col(f"`{c}`") for c in docs.columns])

    packed, told = "bucket int, entries binary", "part int, entries binary"
    anchors = docs.select(key.alias("doc"), F.col(text).alias("text")).mapInArrow(_anchors(buckets, parts), packed)
    shared = anchors.groupBy("bucket").applyInArrow(_meet_anchors(parts), told)
    found = texts.groupBy(part_name).cogroup(shared.groupBy("part")).applyInArrow(_extend(id_at, text_at, buckets, parts), packed)
    covered = found.groupBy("bucket").applyInArrow(_meet_windows(parts), told)
    return texts.groupBy(part_name).cogroup(covered.groupBy("part")).applyInArrow(_drop(schema.fieldNames(), id_at, text_at, with_text), schema)
