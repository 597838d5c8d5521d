"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are lower-cased (A-Z) and cut at ASCII characters other than letters and digits.  Of every
NEAR consecutive K-gram hashes the smallest is kept (all of them on ties), for training texts and for
benchmark items alike.  Two texts that share SPAN = K + NEAR - 1 words share such a stretch of
hashes, so they share a kept hash at the same place of it: joining kept hashes finds every shared
span.  An item of fewer words than SPAN, but not none, is one window; for these the hashes of all
windows of their lengths are joined too.

A hit is then extended: the windows around it are compared with the benchmark's word by word, so the
result is exact whatever the hashes.

Every text is cut into words once; a row for each hash leaves that step without its words, and only
texts with a hit are read again.  The benchmark's fingerprints are broadcast BROADCAST_ROWS (8 bytes
each) at a time, in as many passes as it takes, so texts stay where they are however large the
benchmark.  Its windows are broadcast if they were counted and have BROADCAST_BYTES at most;
otherwise they meet the texts' windows in a join that deals out all but hot ones.

Edge cases: null texts have no words; documents and items without words have no hits; very long texts
are read whole; repeated rows get equal results, and rows with one id but different texts are told
apart by a hash of the text; a null item id names no item but its windows still hit; an empty
benchmark gives no hits, an empty table no rows.  Only the id and text columns are read, so other
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, join_groups

SPAN = 13
K = 5
NEAR = SPAN - K + 1
#: Benchmark fingerprints that are broadcast at a time: 16 MB, some 50 MB as a hash table.
BROADCAST_ROWS = 2_000_000
#: Bytes of benchmark windows, and rows of ids, that may be broadcast.
BROADCAST_BYTES = 64_000_000
BROADCAST_IDS = 1_000_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PRINTS = "array<struct<len:int,p:int,fp:bigint>>"
_CUT = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text in order.  lower() is taken where it can touch nothing but A-Z."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(low, _CUT), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once: merged projections would put it inside the lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _of(array: Column, place: Column, n: int) -> list[Column]:
    """n elements from a place (0-based) on, null beyond the end.  slice() would copy the whole array each time."""
    return [F.get(array, place + k) for k in range(n)]


def _grams(words: Column) -> Column:
    """Hashes of the K-grams of words; none below SPAN words."""

    def of(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - K), lambda i: F.xxhash64(*_of(h, i, K)))

    return F.when(F.size(words) >= SPAN, _let(F.transform(words, lambda x: F.xxhash64(x)), of)).otherwise(F.expr("cast(array() as array<bigint>)"))


def _kept(grams: Column) -> Column:
    """The winnowed hashes as structs of len 0, place p (1-based) and hash fp: those that are the least of some NEAR hashes in a row."""

    def of(least: Column) -> Column:
        # A hash is no less than the least of any run that it is in, so it is kept if the greatest of these equals it.
        places = F.filter(F.sequence(F.lit(0), F.size(grams) - 1), lambda p: F.greatest(*_of(least, p - (NEAR - 1), NEAR)) == F.get(grams, p))
        return F.transform(places, lambda p: F.struct(F.lit(0).alias("len"), (p + 1).alias("p"), F.get(grams, p).alias("fp")))

    least = F.transform(F.sequence(F.lit(0), F.size(grams) - NEAR), lambda i: F.least(*_of(grams, i, NEAR)))
    return F.when(F.size(grams) >= NEAR, _let(least, of)).otherwise(F.expr(f"cast(array() as {_PRINTS})"))


def _whole(words: Column, n: int, i: Column) -> Column:
    """The hash of a short item's words, n of them from i (0-based) on."""
    return F.xxhash64(F.lit(n), *_of(words, i, n))


def _prints(words: Column, lengths: list[int]) -> Column:
    """Structs of len (0 for a winnowed K-gram, else the length of a short item), place p (1-based) and hash fp."""

    def whole(n: int) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.struct(F.lit(n).alias("len"), (i + 1).alias("p"), _whole(words, n, i).alias("fp")))
        return F.when(F.size(words) >= n, each).otherwise(F.expr(f"cast(array() as {_PRINTS})"))

    return F.concat(_let(_grams(words), _kept), *[whole(n) for n in lengths])


def _window(words: Column, s: Column, n: Column) -> Column:
    """The words of a window of n (SPAN at most) that begins at s (1-based), joined by blanks."""
    return F.concat_ws(" ", *[F.when(F.lit(k) < n, w) for k, w in enumerate(_of(words, s - 1, SPAN))])


def _read(df: DataFrame, keep: list[str], text: str, lengths: list[int]) -> DataFrame:
    """A row for each fingerprint, and one with len -1 for the text itself, which tells its number of words."""
    cut = lambda w: F.struct(F.size(w).alias("n"), _prints(w, lengths).alias("prints"))
    none = F.lit(None).cast("bigint")
    read = df.select(*keep, _let(words_of(F.col(text)), cut).alias("x"))
    itself = F.array(F.struct(F.lit(-1).alias("len"), F.col("x.n").alias("p"), none.alias("fp")))
    return read.select(*keep, F.explode(F.concat(itself, F.col("x.prints"))).alias("at")).select(*keep, "at.len", "at.p", "at.fp")


def _starts(n: Column, at: Column) -> Column:
    """Where windows begin (1-based) that hold the hit `at`, as structs of s and len."""
    first, last = F.greatest(F.lit(1), at["p"] - (NEAR - 1)), F.least(at["p"], n - (SPAN - 1))
    around = F.transform(F.sequence(first, last), lambda s: F.struct(s.alias("s"), F.lit(SPAN).alias("len")))
    return F.when(at["len"] == 0, around).otherwise(F.array(F.struct(at["p"].alias("s"), at["len"].alias("len"))))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", broadcast_rows: int = BROADCAST_ROWS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, n_hit, item_ids (sorted as strings)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w")).select("*", F.size("w").alias("n")).filter("n > 0")
    span = F.least(F.col("n"), F.lit(SPAN))
    spans = items.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.col("n") - span + 1), lambda i: _window(F.col("w"), i, span))).alias("win"))
    lengths = sorted(r["n"] for r in items.filter(F.col("n") < SPAN).select("n").distinct().collect())  # SPAN - 1 values at most
    prints = _read(benchmark, [], "text", []).filter("len = 0").select("fp")
    if lengths:
        prints = prints.unionByName(items.filter(F.col("n") < SPAN).select(F.coalesce(*[F.when(F.col("n") == n, _whole(F.col("w"), n, F.lit(0))) for n in lengths]).alias("fp")))
    prints = checkpointed(prints.distinct())
    passes = max(1, -(-prints.count() // max(1, broadcast_rows)))

    key = ["doc", "th"]
    texts = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("t"))
    found = None
    for k in range(passes):
        some = prints.filter(F.pmod(F.xxhash64(F.lit("pass"), "fp"), F.lit(passes)) == k) if passes > 1 else prints
        rows = _read(texts, key, "t", lengths).join(F.broadcast(some.select(F.col("fp").alias("known"))), F.col("fp") == F.col("known"), "left")
        rows = rows.filter("len = -1 or known is not null" if k == 0 else "known is not null").select(*key, "len", "p")
        found = rows if found is None else found.unionByName(rows)
    found = checkpointed(found)

    # Only texts with hits are read again, each once.
    hits = found.filter("len >= 0").groupBy(*key).agg(F.collect_set(F.struct("len", "p")).alias("ats"))
    ids = found.filter("len >= 0").select(*key).distinct()
    again = texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, texts["doc"].eqNullSafe(ids["doc"]) & (texts["th"] == ids["th"]), "left_semi").dropDuplicates(key)
    read = again.join(hits.select(F.col("doc").alias("h_doc"), F.col("th").alias("h_th"), "ats"), F.col("doc").eqNullSafe(F.col("h_doc")) & (F.col("th") == F.col("h_th")))

    def windows(w: Column) -> Column:
        starts = F.array_distinct(F.flatten(F.transform("ats", lambda at: _starts(F.size(w), at))))
        return F.transform(starts, lambda x: F.struct(x["s"].alias("s"), x["len"].alias("len"), _window(w, x["s"], x["len"]).alias("win")))

    candidates = read.select(*key, F.explode(_let(words_of(F.col("t")), windows)).alias("c")).select(*key, "c.s", "c.len", "c.win")
    known = spans.groupBy(F.col("win").alias("k_win")).agg(F.count("*").alias("c"))
    size = known.agg(F.sum(F.octet_length("k_win") + 16).alias("b")).first()["b"] or 0
    if size <= broadcast_bytes:
        spots = candidates.join(F.broadcast(known.select("k_win")), F.col("win") == F.col("k_win")).drop("k_win")
    else:
        candidates = checkpointed(candidates)
        met = candidates.groupBy(F.col("win").alias("c_win")).agg(F.count("*").alias("rows")).join(known, F.col("c_win") == F.col("k_win"), "left_semi")
        spots = join_groups(candidates, met, {"win": "c_win"}, "rows").drop("c_win", "rows")
    spots = checkpointed(spots)

    # Which items the windows are of, and how many words they cover.
    often = spots.select(*key, "win").distinct()
    named = spans.filter("item is not null").distinct().select(F.col("win").alias("i_win"), "item")
    named = named.join(F.broadcast(often.select("win").distinct()) if often.count() <= BROADCAST_IDS else often.select("win").distinct(), F.col("i_win") == F.col("win"), "left_semi")
    of = often.join(named, F.col("win") == F.col("i_win")).select(*key, "item").distinct().groupBy(*key).agg(F.array_sort(F.collect_list("item")).alias("item_ids"))

    def cover(acc: Column, x: Column) -> Column:
        end = x["s"] + x["len"]
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["hit"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], x["s"]))).alias("hit"))

    covered = F.aggregate(F.array_sort(F.collect_set(F.struct("s", "len"))), F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit")), cover)["hit"]
    same = lambda x, y: F.col(f"{x}doc").eqNullSafe(F.col(f"{y}doc")) & (F.col(f"{x}th") == F.col(f"{y}th"))
    hit = spots.groupBy(F.col("doc").alias("s_doc"), F.col("th").alias("s_th")).agg(covered.cast("long").alias("n_hit"))
    of = of.select(F.col("doc").alias("o_doc"), F.col("th").alias("o_th"), "item_ids")
    hit = checkpointed(hit.join(of, same("s_", "o_"), "left").drop("o_doc", "o_th"))
    counted = found.filter("len = -1").select(*key, F.col("p").cast("long").alias("n_words"))
    none = F.expr("cast(array() as array<string>)")
    return counted.join(hit, same("", "s_"), "left").select(F.col("doc").alias("doc_id"), F.col("th").alias("text_hash"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", none).alias("item_ids"))


def contaminated() -> Column:
    """Hit words make up a twentieth of the text or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
