"""Duplicate detection in arrival order.

A row is a duplicate of the earliest row before it that matches on any layer: canonical URL, item id
within a source, content hash and title similarity.  For the exact layers only the first row with a
key can be the earliest match, so each layer is a grouped minimum joined back; no pairs are made.
Equal titles meet by running minima; different ones in cells, where counts of characters rule out
nearly all pairs.  Each row gets its earliest match only.
"""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions import text as T
from plumbline.session import ship

LAYERS = (("CANONICAL_URL", ("canonical_url",)), ("SOURCE_ITEM_ID", ("source_id", "source_item_id")), ("CONTENT_HASH", ("content_hash",)))
THRESHOLD = 0.98
MIN_KEY = 30
DAY = 86_400
CELL_ROWS = 2_000
_BUCKETS = 32


def first_seen(rows: DataFrame, keys: list[str], seq: str, name: str) -> DataFrame:
    """rows with the smallest seq that shares the keys (null where a key is null)."""
    there = F.lit(True)
    for k in keys:
        there &= F.col(k).isNotNull()
    firsts = rows.filter(there).groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(seq).alias(name))
    cond = F.lit(True)
    for k in keys:
        cond &= F.col(k) == F.col(f"_{k}")
    return rows.join(firsts, cond, "left").drop(*[f"_{k}" for k in keys])


def exact_layers(rows: DataFrame, *, seq: str = "seq") -> DataFrame:
    """rows with duplicate_of (seq of the earliest match) and reason (the first layer that matches it)."""
    out, found = rows, []
    for k, (reason, keys) in enumerate(LAYERS):
        out = first_seen(out, list(keys), seq, f"_first{k}")
        found.append(F.when(F.col(f"_first{k}") < F.col(seq), F.struct(F.col(f"_first{k}").alias("of"), F.lit(k).alias("layer"), F.lit(reason).alias("reason"))))
    best = F.least(*found)  # nulls are skipped; the earliest row wins, then the first layer
    return out.withColumn("_best", best).select(*rows.columns, F.col("_best.of").alias("duplicate_of"), F.col("_best.reason").alias("reason"))


def _profiles(keys: np.ndarray) -> np.ndarray:
    """Bucketed counts of each key's characters; two keys' counts differ by no more than their unmatched characters."""
    out = np.zeros((len(keys), _BUCKETS), np.int32)
    for k, key in enumerate(keys):
        out[k] = np.bincount(np.frombuffer(key.encode("utf-32-le"), np.uint32) % _BUCKETS, minlength=_BUCKETS)
    return out


_BASE = 0x9E3779B97F4A7C15
_GRAM = 8
#: Characters of both sides up to which difflib itself is fast.
SHORT = 600


def _powers(n: int, base: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])


def _sums(text: str, up: np.ndarray) -> np.ndarray:
    """Running sums of characters times powers, modulo 2 ** 64."""
    chars = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(chars * up[: len(chars)], dtype=np.uint64)])


def _windows(sums: np.ndarray, lo: int, hi: int, size: int, down: np.ndarray) -> np.ndarray:
    """Hashes of all runs of size characters in lo to hi; equal runs have equal ones."""
    at = np.arange(lo, hi - size + 1)
    return (sums[at + size] - sums[at]) * down[at]


def _shares_runs(a: str, b: str, threshold: float) -> bool:
    """False only if the ratio is below the threshold: matching blocks are one more than the unmatched characters at most, so most runs of a lie within one."""
    both = len(a) + len(b)
    least = threshold * both / 2 - (_GRAM - 1) * ((1 - threshold) * both + 1) - 1e-6
    if least <= 0:
        return True
    n = max(len(a), len(b))
    up, down = _powers(n, _BASE), _powers(n, pow(_BASE, -1, 1 << 64))
    x, y = (_windows(_sums(t, up), 0, len(t), _GRAM, down) for t in (a, b))
    return np.isin(x, y).sum() >= least


def ratio(a: str, b: str) -> float:
    """difflib's ratio without junk.  Its search for the longest common run takes the product of the lengths; long texts find the same run, first in a and then in b, by hashes."""
    n = max(len(a), len(b))
    if len(a) + len(b) > SHORT:
        up, down = _powers(n, _BASE), _powers(n, pow(_BASE, -1, 1 << 64))
        x, y = _sums(a, up), _sums(b, up)
    matched, todo = 0, [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        if alo == ahi or blo == bhi:
            continue
        if ahi - alo + bhi - blo <= SHORT:
            matched += sum(m.size for m in difflib.SequenceMatcher(None, a[alo:ahi], b[blo:bhi], autojunk=False).get_matching_blocks())
            continue
        lo, hi, best = 1, min(ahi - alo, bhi - blo), None
        while lo <= hi:
            size = (lo + hi) // 2
            left, right = _windows(x, alo, ahi, size, down), _windows(y, blo, bhi, size, down)
            same = np.isin(left, right)
            if same.any():
                i = int(same.argmax())
                j = int((right == left[i]).argmax())
                best, lo = (alo + i, blo + j, size), size + 1
            else:
                hi = size - 1
        if best is None:
            continue
        i, j, size = best
        if a[i : i + size] != b[j : j + size]:  # unequal runs of one hash
            return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()
        matched += size
        todo += [(alo, i, blo, j), (i + size, ahi, j + size, bhi)]
    return 2.0 * matched / (len(a) + len(b)) if a or b else 1.0


def _earliest_in_cell(cell: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """seq, of, score: the earliest right point before it, of another key, that each left point's key resembles, within a day."""
    right = cell[~cell["is_left"]].sort_values("seq")
    r_codes, r_keys = pd.factorize(right["title_key"])
    r_keys = np.asarray(r_keys, dtype=object)
    size, profile = np.array([len(k) for k in r_keys], dtype=np.int64), _profiles(r_keys)
    coarse = profile.reshape(len(r_keys), 4, _BUCKETS // 4).sum(axis=2)
    by_size = np.argsort(size, kind="stable")
    sizes = size[by_size]
    digits = dict(zip(cell["title_key"], map(tuple, cell["digits"]), strict=True))
    seqs, ats = right["seq"].to_numpy(), right["at"].to_numpy()
    found = []
    for key, rows in cell[cell["is_left"]].groupby("title_key", sort=False):
        # A match leaves (1 - threshold) of both keys' characters unmatched at most.
        lo, hi = np.searchsorted(sizes, [len(key) * threshold / (2 - threshold) - 1e-6, len(key) * (2 - threshold) / threshold + 1e-6])
        near = by_size[lo:hi]
        most = (1 - threshold) * (size[near] + len(key)) + 1e-6
        mine = _profiles(np.array([key], dtype=object))[0]
        for whole, one in ((coarse, mine.reshape(4, -1).sum(axis=1)), (profile, mine)):
            ok = np.abs(whole[near] - one).sum(axis=1) <= most
            near, most = near[ok], most[ok]
        near = [k for k in near if r_keys[k] != key and (not digits[key] or not digits[r_keys[k]] or digits[key] == digits[r_keys[k]])]
        if near:
            at_rows = np.flatnonzero(np.isin(r_codes, near))
            scores = {}  # of those that were asked for; only a match before the point is of use, as later ones lie after the title's own first row
            for seq, at in zip(rows["seq"], rows["at"], strict=True):
                for k in at_rows[(np.abs(ats[at_rows] - at) <= DAY) & (seqs[at_rows] < seq)]:
                    code = r_codes[k]
                    if code not in scores:
                        scores[code] = ratio(key, r_keys[code]) if _shares_runs(key, r_keys[code], threshold) else 0.0
                    if scores[code] >= threshold:
                        found.append((seq, seqs[k], scores[code]))
                        break
    return pd.DataFrame(found, columns=["seq", "of", "score"]).astype({"seq": "int64", "of": "int64", "score": "float64"})


def _first_within_a_day(points: DataFrame, keys: list[str]) -> DataFrame:
    """points (keys, at, seq; one row a time) with first: the least seq of the same keys no more than a day away.

    Days are blocks: a point's neighbourhood is the end of the block before from its own offset on, its
    block, and the beginning of the next one up to its offset, so running minima do, whatever the number of points.
    """
    block, off = F.floor(F.col("at") / DAY).alias("block"), F.pmod("at", F.lit(DAY)).alias("off")
    data = points.select(*keys, block, off, F.lit(0).alias("step"), "seq")
    asks = [data.select(*keys, (F.col("block") + x).alias("block"), "off", F.lit(x).alias("step"), F.lit(None).cast("long").alias("seq")) for x in (-1, 1)]
    every = data.unionByName(asks[0]).unionByName(asks[1])
    part = Window.partitionBy(*keys, "block")
    upto, onward = (part.orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow) for o in (F.asc("off"), F.desc("off")))
    told = every.withColumn("v", F.when(F.col("step") == 0, F.min("seq").over(part)).when(F.col("step") == 1, F.min("seq").over(upto)).otherwise(F.min("seq").over(onward)))
    return told.groupBy(*keys, ((F.col("block") - F.col("step")) * DAY + F.col("off")).alias("at")).agg(F.min("v").alias("first"))


def earliest_title(rows: DataFrame, *, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(seq, of, score) of the earliest match at or above the threshold, for rows that have one.

    rows: seq, market, title_key, at (seconds), below (only matches with a smaller seq are of use).  Rows
    of one title and time are one point; equal titles meet by running minima, whatever their number.
    Points of different titles meet in cells: left points of a length class and right points of it and
    its neighbours (the ratio of two titles is at most 2 min / (a + b)), dealt into pieces of about cell_rows.
    """
    ratio = (2 - threshold) / threshold
    r = rows.filter((F.length("title_key") >= MIN_KEY) & F.col("market").isNotNull() & F.col("at").isNotNull()).select("market", "title_key", *[F.col(c).cast("long").alias(c) for c in ("seq", "at", "below")])
    keys = ["market", "title_key"]
    points = r.groupBy(*keys, "at").agg(F.min("seq").alias("seq"))
    p = points.withColumn("digits", T.numeric_tokens(F.col("title_key"))).withColumn("band", F.floor(F.log(F.length("title_key").cast("double")) / F.log(F.lit(ratio))))
    left, right = p.withColumn("is_left", F.lit(True)), p.withColumn("band", F.explode(F.array(*[F.col("band") + k for k in (-1, 0, 1)]))).withColumn("is_left", F.lit(False))
    pieces = lambda x, name: x.groupBy("market", "band").agg(F.ceil(F.count("*") / F.lit(cell_rows)).alias(name))
    dealt = F.broadcast(pieces(left, "n_left").join(pieces(right, "n_right"), ["market", "band"]))  # a row for each market and length class
    other = lambda x: F.explode(F.sequence(F.lit(0).cast("long"), F.col(x) - 1))
    piece = lambda x: F.pmod(F.xxhash64("title_key"), F.col(x))
    left = left.join(dealt, ["market", "band"]).withColumn("l", piece("n_left")).withColumn("r", other("n_right"))
    right = right.join(dealt, ["market", "band"]).withColumn("r", piece("n_right")).withColumn("l", other("n_left"))
    cells = left.unionByName(right).select("market", "band", "l", "r", "is_left", "title_key", "seq", "at", "digits")
    near = cells.groupBy("market", "band", "l", "r").applyInPandas(lambda cell: _earliest_in_cell(cell, threshold), "seq long, of long, score double").groupBy("seq").agg(F.min(F.struct("of", "score")).alias("near"))
    equal = _first_within_a_day(points, keys)
    best = points.join(near, "seq", "left").join(equal, [*keys, "at"]).select(*keys, "at", F.least("near", F.struct(F.col("first").alias("of"), F.lit(1.0).alias("score"))).alias("m"))
    return r.join(best, [*keys, "at"]).filter(F.col("m.of") < F.col("below")).select("seq", "m.of", "m.score")


def all_layers(rows: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: seq, duplicate_of (the earliest match by any layer), reason (the first layer that matches it) and, for titles, score.

    rows: seq, canonical_url, source_id, source_item_id, content_hash, market, title_key, at (seconds).
    """
    ship(rows.sparkSession)
    exact = exact_layers(rows)
    below = F.coalesce(F.col("duplicate_of"), F.col("seq"))  # an exact match comes first where it is the same row
    titles = earliest_title(exact.select("seq", "market", "title_key", "at", below.alias("below")), threshold=threshold)
    both = exact.select("seq", "duplicate_of", "reason").join(titles, "seq", "left")
    earlier = F.col("of").isNotNull()  # every such match lies before the exact one
    return both.select("seq", F.when(earlier, F.col("of")).otherwise(F.col("duplicate_of")).alias("duplicate_of"), F.when(earlier, "TITLE_SIMILARITY").otherwise(F.col("reason")).alias("reason"), "score")


def sightings(rows: DataFrame, key: Column) -> DataFrame:
    """Per query and key: the first sighting's fields, the earliest time.  rows: query_id, seq, observed_at and more."""
    fields = [c for c in rows.columns if c not in ("query_id", "observed_at")]
    kept = rows.withColumn("_key", key).groupBy("query_id", "_key").agg(F.min_by(F.struct(*fields), "seq").alias("_first"), F.min("observed_at").alias("observed_at"))
    return kept.select("query_id", "observed_at", *[F.col(f"_first.{c}").alias(c) for c in fields])
