"""Quality rules: countable faults and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed byte 4-grams: the trusted target (texts that
labels mark as good) and the raw corpus (every text).  A document's score is the mean over its
4-grams of log p_target - log p_raw, so long and short texts share one scale.  One threshold, a
parameter, decides every document: nothing is drawn at random.

Raw counts cover all documents, target counts all labelled good rows.

The target is smoothed towards the corpus by SLOTS pseudo-counts, so that a small one doesn't reject
clean texts.  No 4-gram's ratio is then below -log(1 + T / SLOTS), T being the target's 4-grams: with
fewer than `least_target` of them (32,233 at THRESHOLD) the ratio alone rejects nothing
and only the base rules decide; `fit` warns of that.

Lines and windows meet by hash and are compared byte by byte; a text in which unequal ones met is counted
anew without hashes.  Log ratios are summed as integers, so a score depends on its text alone and a score
equal to the threshold is kept everywhere.

Edge cases: a null text counts as empty; an empty text has no words, so `base_failed` is true and
`kept` false; a text of under four bytes scores 0.  Without any trusted row the ratio is 0 for
every document and only the base rules decide.  Repeated rows get equal results.  Columns of the
input other than the id and the text are passed through by `judge` untouched, whatever their names.
"""

from __future__ import annotations

import warnings
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textvec import SEEDS, U, Words, flat, mix, runs_of_equal, spans_equal, steps, windows

SLOTS = 1 << 16
#: Mean nats a 4-gram below which a document is rejected.
THRESHOLD = -0.4
#: Most trusted ids that are sent to every worker (8 bytes each); more are joined.
BROADCAST_IDS = 16_000_000
SMOOTHING = 1.0
SYMBOLS = b"#*$%&|<>"
_PIECES = 16
#: Words of a window whose repetition counts.
REPEAT = 5
#: Steps of a log ratio in one nat.
FIXED = 1 << 26

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_MULT = np.array([1, 2533, 246515, 32773589], dtype=np.uint32)
_SPREAD = np.uint32(2654435761)

COLUMNS = (("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"), ("base_failed", "boolean"), ("llr", "double"), ("kept", "boolean"))


def grams(data: np.ndarray) -> np.ndarray:
    """The slot of the 4-gram at each byte but the last three."""
    if len(data) < 4:
        return np.zeros(0, np.uint32)
    x = data.astype(np.uint32)
    g = x[:-3] * _MULT[0]
    for k in (1, 2, 3):
        g += x[k : len(x) - 3 + k] * _MULT[k]
    g *= _SPREAD
    g >>= np.uint32(16)
    return g


def _spans(off: np.ndarray, n_grams: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's range of 4-grams; those that reach into the next text are in no range."""
    lo = np.minimum(off[:-1], n_grams)
    return lo, np.maximum(np.minimum(off[1:] - 3, n_grams), lo)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SLOTS, dtype=np.int64)
    for batch in batches:
        for a, b in steps(batch.column(0)):
            data, off = flat(batch.column(0).slice(a, b - a))
            g = grams(data)
            lo, hi = _spans(off, len(g))
            delta = np.zeros(len(g) + 1, dtype=np.int8)  # texts that end here leave out their last three
            np.add.at(delta, lo, 1)
            np.add.at(delta, hi, -1)
            total += np.bincount(g[np.cumsum(delta[:-1]) > 0], minlength=SLOTS)
    size = SLOTS // _PIECES
    yield pa.RecordBatch.from_arrays([pa.array(range(_PIECES), pa.int32()), pa.array([total[k * size : (k + 1) * size].tobytes() for k in range(_PIECES)], pa.binary())], names=["piece", "counts"])


def _add(pieces: pa.Table) -> pa.Table:
    total = sum((np.frombuffer(x, np.int64) for x in pieces["counts"].to_pylist()), np.zeros(SLOTS // _PIECES, np.int64))
    return pa.table({"piece": pa.array([pieces["piece"][0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def gram_counts(texts: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] = _count) -> np.ndarray:
    """Counts of the hashed 4-grams of every text of the only column (or of those that count chooses); of fixed size whatever the input."""
    out = np.zeros(SLOTS, dtype=np.int64)
    size = SLOTS // _PIECES
    schema = "piece int, counts binary"
    for row in texts.mapInArrow(count, schema).groupBy("piece").applyInArrow(_add, schema).collect():
        out[row["piece"] * size : (row["piece"] + 1) * size] = np.frombuffer(row["counts"], np.int64)
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    if not target.sum():
        return np.zeros(SLOTS)
    slots = smoothing * SLOTS
    p_raw = (raw + smoothing) / (raw.sum() + slots)
    p_target = (target + slots * p_raw) / (target.sum() + slots)  # what the target says little about is taken as in the corpus
    return np.log(p_target) - np.log(p_raw)


def least_target(threshold: float = THRESHOLD, smoothing: float = SMOOTHING) -> int:
    """The fewest 4-grams of a target whose ratio can fall below the threshold."""
    return int(smoothing * SLOTS * np.expm1(-threshold)) + 1


def _among(ids: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of the texts (second column) whose ids (first) are among the sorted ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ids.value

        def mine() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                there = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
                mark = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                at = np.minimum(np.searchsorted(known, mark), len(known) - 1)
                yield pa.RecordBatch.from_arrays([batch.column(1).filter(pa.array(there & (known[at] == mark)))], names=["text"])

        yield from _count(mine())

    return count


def target_counts(docs: DataFrame, good: DataFrame, n: int, *, doc_id: str, text: str, broadcast_ids: int = BROADCAST_IDS) -> np.ndarray:
    """Counts over every document whose id is among the n of good (trusted_id).

    Texts stay where they are: the ids, 8 bytes each, go to the workers.  Only ids that aren't
    integers, or more of them than broadcast_ids, are joined by dealing out texts.
    """
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if n <= broadcast_ids and isinstance(docs.schema[doc_id].dataType, kinds) and isinstance(good.schema["trusted_id"].dataType, kinds):
        ids = np.sort(good.select(F.col("trusted_id").cast("long").alias("trusted_id")).toArrow()["trusted_id"].to_numpy())
        sent = docs.sparkSession.sparkContext.broadcast(ids)
        return gram_counts(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")), _among(sent))
    mine = docs.select(F.col(doc_id).alias("trusted_id"), F.col(text).alias("trusted_text"))
    return gram_counts(mine.join(good, "trusted_id", "left_semi").select("trusted_text"))


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", smoothing: float = SMOOTHING) -> np.ndarray:
    """The log ratio of each slot; trusted are the documents with a label of quality 1, all of them."""
    raw = gram_counts(docs.select(F.col(text)))
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("trusted_id")).distinct()
    n = good.count()
    if n == 0:
        return np.zeros(SLOTS)
    target = target_counts(docs, good, n, doc_id=doc_id, text=text)
    if target.sum() < (least := least_target(smoothing=smoothing)):
        warnings.warn(f"the target has {target.sum()} 4-grams; under {least} the ratio rejects nothing at the threshold {THRESHOLD}", stacklevel=2)
    return log_ratio(target, raw, smoothing)


def fixed_point(ratio: np.ndarray) -> np.ndarray:
    """The ratio in steps of 1 / FIXED; a text of 2**31 4-grams sums up in 64 bits."""
    return np.rint(ratio * FIXED).astype(np.int64)


def repeats_by_hand(raw: bytes) -> tuple[int, int]:
    """n_dup_lines and n_repeat_words of one text without any hash of ours."""
    lines = [x for x in raw.split(b"\n") if x.split()]
    words = raw.split()
    grams = [tuple(words[k : k + REPEAT]) for k in range(len(words) - REPEAT + 1)]
    often = Counter(grams)
    covered = {k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(REPEAT)}
    return len(lines) - len(set(lines)), len(covered)


def measures(column: pa.Array, ratio: np.ndarray) -> dict[str, np.ndarray]:
    """The countable faults and the mean log ratio of each text of a step."""
    data, off = flat(column)
    n = len(off) - 1
    w = Words(data, off)
    per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[off])  # noqa: E731  sums by text
    char = (data & 0xC0) != 0x80
    out = {"n_words": w.counts.astype(np.int64), "word_chars": per_text(char & w.inside), "n_symbols": per_text(_IS_SYMBOL[data])}

    # Lines: the spans between line feeds; equal to an earlier one of the same text, and with a word.
    stop = np.zeros(len(data) + 1, dtype=bool)
    stop[np.flatnonzero(data == 10)] = True
    stop[off[1:]] = True  # a text's end closes its last line
    ends = np.flatnonzero(stop)
    begins = np.empty_like(ends)
    if len(ends):
        begins[0] = 0
        begins[1:] = ends[:-1] + (np.append(data, 0)[ends[:-1]] == 10)
    line_text = np.searchsorted(off, begins, "right") - 1
    words_before = np.concatenate([[0], np.cumsum(w.is_start)])
    real = (ends > begins) & (words_before[ends] > words_before[np.minimum(begins, ends)])
    begins, ends, line_text = begins[real], ends[real], line_text[real]
    in_text = lambda h, text: mix(h ^ mix(text.astype(np.uint64) ^ SEEDS[2]))
    _, again, before = runs_of_equal(in_text(w.span_hashes(begins, ends), line_text))
    size = ends - begins
    unlike = (size[again] != size[before]) | ~spans_equal(data, begins[again], begins[before], np.minimum(size[again], size[before]))
    unlike |= line_text[again] != line_text[before]
    out["n_dup_lines"] = np.bincount(line_text[again], minlength=n).astype(np.int64)
    by_hand = set(line_text[again[unlike]].tolist()) | set(line_text[before[unlike]].tolist())  # texts whose hashes met by chance

    # Words in 5-word windows that the same text holds at least twice.
    covered = np.zeros(len(w) + 1, dtype=np.int32)
    g = windows(w.hashes(), REPEAT)
    if len(g):
        text_of, size = w.text_of, w.ends - w.starts
        first = np.flatnonzero(w.left[: len(g)] >= REPEAT)
        twice, again, before = (first[x] for x in runs_of_equal(in_text(g[first], text_of[first])))
        unlike = text_of[again] != text_of[before]
        compared = np.full(len(w), -1)
        for k in range(REPEAT):
            unlike |= size[again + k] != size[before + k]
        for k in range(REPEAT):
            same = np.flatnonzero(~unlike)
            same = same[compared[again[same] + k] != before[same] + k]  # found equal in another window
            unlike[same] |= ~spans_equal(data, w.starts[again[same] + k], w.starts[before[same] + k], size[again[same] + k])
            compared[again[same] + k] = before[same] + k
        by_hand |= set(text_of[again[unlike]].tolist()) | set(text_of[before[unlike]].tolist())
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + REPEAT, -1)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    out["n_repeat_words"] = np.diff(hit[w.first])
    for k in by_hand:
        out["n_dup_lines"][k], out["n_repeat_words"][k] = repeats_by_hand(data[off[k] : off[k + 1]].tobytes())

    gr = grams(data)
    lo, hi = _spans(off, len(gr))
    total = np.concatenate([[0], np.cumsum(fixed_point(ratio)[gr])])  # integers: a text's sum doesn't depend on its neighbours
    out["llr"] = np.where(hi > lo, (total[hi] - total[lo]) / np.maximum(hi - lo, 1) / FIXED, 0.0)
    return out


def judge(docs: DataFrame, ratio: np.ndarray, *, text: str = "text", threshold: float = THRESHOLD, prefix: str = "") -> DataFrame:
    """docs with the measures and the verdict; `prefix` keeps the new columns clear of the old names."""
    at = docs.columns.index(text)
    added = T.StructType([T.StructField(prefix + n, T._parse_datatype_string(t)) for n, t in COLUMNS])
    schema = T.StructType([*docs.schema.fields, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema.fieldNames()
        for batch in batches:
            for a, b in steps(batch.column(at)):
                part = batch.slice(a, b - a)
                m = measures(part.column(at), ratio)
                m["base_failed"] = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
                m["kept"] = ~m["base_failed"] & (m["llr"] >= threshold)
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(m[n]) for n, _ in COLUMNS)], names=names)

    return docs.mapInArrow(run, schema)


def quality_rules(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per document: id, the measures, the length-normalised log ratio and whether it is kept."""
    ratio = fit(docs, labels, doc_id=doc_id, text=text)
    return judge(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), ratio, threshold=threshold).drop("text")
