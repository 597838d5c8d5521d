"""N-gram Jaccard join with set-relation skipping.

Sets are the distinct SHINGLE-word shingles of lower-cased texts (64-bit hashes); two documents link
when 100 * |intersection| >= 80 * |union|.  The join is exact; what follows only skips work.

* Equal sets are one class (by 128 bits of two independent hashes), and its smallest id stands for it.
* Sets that share several of their smallest hashes with a smaller set are put in one cluster.  Any
  clustering gives right results: pairs inside a cluster are answered in the cluster, pairs across
  clusters by the index.  Inside, the cluster's lead is answered first, and the answers of the other
  sets are derived from its: |x & y| = |x & lead| + |y & lead| - |lead| + |dx & dy|, where dx holds
  the few tokens in which x differs from the lead.  Sets that link with the lead are one component
  already and need no answer among themselves, and bounds from the first two terms leave few others.
* Clusters of many sets are cut into blocks (BLOCK_SETS, BLOCK_SHINGLES).  Each block gets a copy of
  the lead, so that its answers connect the blocks; only sets that don't link with the lead meet
  other blocks' sets, through the index.
* Across, an index over prefixes (a set's first tokens in one global order; similar sets must share
  enough of them) lists for each token the sets that have it, with size and position.  Lists whose
  entries are answered already are skipped; lists are ordered by size and position and walked in
  blocks, and two blocks are skipped where no position in them can belong to a link.  Pairs must share
  as many prefix tokens as their sizes and positions demand before their texts are compared.
* The global order is by hash, but for frequent tokens, which come last, rarest first: KEEP tokens
  found often in single tasks, and up to KEEP a round whose lists turn out longer than LONG.  Pairs
  that share such a list are left to the next round, in which only sets of long lists take part.  The
  last round walks its lists whatever their length, a bounded number of pairs at a time.

Edge cases: null and empty texts have an empty set, are linked with nothing and are their own
component; texts of under SHINGLE words have one shingle, the whole; rows that share an id are one
document, all of them linked; a row with a null id belongs to the component of its class, or to
none (null) if no such row has an id.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_count, checkpointed, even_labels, id_array, join_groups, pack, packed_batch, planes, runs, settle, text_bytes, unpack
from .components import components
from .textvec import LOWER, SEEDS, U, Words, flat, mix, steps, windows

SHINGLE = 5
SMALLEST = 8
#: Tokens that come last in the global order, at most: 16 bytes each, sent to every task.
KEEP = 65_536
LOCAL_OFTEN = 3
#: Shingles and sets in one block of a cluster, about; larger clusters are cut.
BLOCK_SHINGLES = 1_200_000
BLOCK_SETS = 500
#: Entries of a list that is put off to the next round, and the number of rounds.
LONG = 1_000
ROUNDS = 3
#: Entries of a list that are walked together, and pairs that leave a task together.
WALK = 256
PAIRS = 1_000_000
STEP_BYTES = 1_500_000
ENTRIES = 200_000
SHORT_LIST = 48
#: Rows of ids (8 bytes each) that may be broadcast to choose the texts to compare.
BROADCAST_ROWS = 1_000_000


def _hashed(column: pa.Array, seed: np.uint64) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of lower-cased texts, their hashes and those of their shingles."""
    data, off = flat(column)
    w = Words(LOWER[data], off)
    h = w.hashes(seed)
    return w, h, windows(h, SHINGLE)


def _shingles(w: Words, h: np.ndarray, g: np.ndarray, k: int) -> np.ndarray:
    """The shingles of text k in the order of their places; of a short text the whole."""
    a, n = w.first[k], w.counts[k]
    if n >= SHINGLE:
        return g[a : a + n - SHINGLE + 1]
    return mix(windows(h[a : a + n], int(n)) ^ SEEDS[2]) if n else np.zeros(0, np.uint64)


def _distinct(x: np.ndarray) -> np.ndarray:
    s = np.sort(x)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w, h, g = _hashed(column, SEEDS[0])
    return [_distinct(_shingles(w, h, g, k)) for k in range(len(w.counts))]


def signature(s: np.ndarray) -> int:
    """64 bits of a set, whatever its order."""
    with np.errstate(over="ignore"):
        return int(mix(s).sum().astype(np.int64))


def need(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least intersection of sets of these sizes that link: 9 i >= 4 (a + b)."""
    return (4 * (a + b) + 8) // 9


def prefix_length(n: np.ndarray) -> np.ndarray:
    """Tokens of a set of n that any linking set, however small, must touch."""
    return n - (4 * n + 4) // 5 + 1


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a document (n, signature, smallest hashes) and a row a step (tokens that many of its sets have)."""
    for batch in batches:
        for a, b in steps(batch.column(1), STEP_BYTES):
            part = batch.column(1).slice(a, b - a)
            sets = shingle_sets(part)
            w, h, g = _hashed(part, SEEDS[1])
            sig = [(signature(s), signature(_distinct(_shingles(w, h, g, k)))) for k, s in enumerate(sets)]
            every = np.sort(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
            first = runs(every)
            often = np.diff(np.append(first, len(every)))
            many = often >= LOCAL_OFTEN
            common = np.uint32(many.sum()).tobytes() + planes(every[first][many]) + planes(often[many].astype(np.uint32))
            ids = pa.concat_arrays([batch.column(0).slice(a, b - a), pa.nulls(1, batch.column(0).type)])
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(s) for s in sets] + [-1], pa.int64()),
                    pa.array([x for x, _ in sig] + [0], pa.int64()),
                    pa.array([y for _, y in sig] + [0], pa.int64()),
                    pa.array([s[:SMALLEST].astype(np.int64) for s in sets] + [None], pa.list_(pa.int64())),
                    pa.array([None] * len(sets) + [common], pa.binary()),
                ],
                names=["doc_id", "n", "s1", "s2", "smallest", "common"],
            )
    settle()


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            token, often = unpack([blob], [np.uint64, np.uint32])
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(often.astype(np.int64))], names=["token", "often"])


def _clusters(reps: DataFrame) -> DataFrame:
    """rep, n, cluster: sets with the smaller set that shares most of their smallest hashes, found by two doublings."""
    tokens = reps.select("rep", "n", F.explode("smallest").alias("token"))
    owners = tokens.groupBy(F.col("token").alias("t")).agg(F.min("rep").alias("owner"), F.count("*").alias("c")).filter("c > 1").drop("c")
    shared = tokens.join(owners, F.col("token") == F.col("t")).filter("rep <> owner").groupBy("rep", "n", "owner").agg(F.count("*").alias("c"))
    enough = shared.filter(F.col("c") >= F.least(F.lit(3), F.ceil(0.4 * F.least(F.col("n"), F.lit(SMALLEST)))))
    parent = checkpointed(enough.groupBy(F.col("rep").alias("child")).agg(F.max_by("owner", F.struct("c", -F.col("owner"))).alias("parent")))
    for _ in range(2):
        up = parent.select(F.col("child").alias("c2"), F.col("parent").alias("p2"))
        parent = parent.join(up, F.col("parent") == F.col("c2"), "left").select("child", F.coalesce("p2", "parent").alias("parent"))
    return reps.select("rep", "n", "s1").join(parent, F.col("rep") == F.col("child"), "left").select("rep", "n", "s1", F.coalesce("parent", "rep").alias("cluster"))


def _forest(n: int) -> tuple:
    """Union-find over 0 .. n-1: (find, join); join tells whether something new was joined."""
    up = list(range(n))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(x: int, y: int) -> bool:
        x, y = find(x), find(y)
        if x == y:
            return False
        up[max(x, y)] = min(x, y)
        return True

    return find, join


def links_inside(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what is connected among some sets, the first of which is the lead; each link with the lead is one of them."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    _, join = _forest(m)
    out: list[tuple[int, int]] = []
    lead = sets[0]
    shared = np.array([len(np.intersect1d(s, lead, assume_unique=True)) for s in sets])
    extra = size - shared
    direct = 9 * shared >= 4 * (size + len(lead))
    for k in np.flatnonzero(direct[1:]) + 1:
        if join(0, int(k)):
            out.append((0, int(k)))
    rest = np.flatnonzero(~direct)
    if not len(rest):
        return out
    differ = [np.setxor1d(s, lead, assume_unique=True) for s in sets]
    tokens, at, often = np.unique(np.concatenate(differ), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), [len(d) for d in differ])
    dims = int((often > 1).sum())
    column = np.full(len(tokens), -1)
    column[often > 1] = np.arange(dims)
    where = column[at]
    owner, where = owner[where >= 0], where[where >= 0]
    order = np.argsort(where, kind="stable")
    owner, where = owner[order], where[order]
    for lo in range(0, len(rest), 512):
        rows = rest[lo : lo + 512]
        least = need(size[rows][:, None], size[None, :])
        most = np.minimum(shared[rows][:, None], shared[None, :]) + np.minimum(extra[rows][:, None], extra[None, :])
        open_ = most >= least
        open_ &= (np.arange(m)[None, :] < rows[:, None]) | direct[None, :]  # each pair of the rest once
        if not open_.any():
            continue
        cols = np.flatnonzero(open_.any(axis=0))
        together = np.zeros((len(rows), len(cols)), np.float32)
        for a in range(0, dims, 1024):
            x, y = np.searchsorted(where, [a, a + 1024])
            slab = np.zeros((m, min(1024, dims - a)), np.float32)
            slab[owner[x:y], where[x:y] - a] = 1
            together += slab[rows] @ slab[cols].T
        both = shared[rows][:, None] + shared[cols][None, :] - len(lead) + together
        linked = open_[:, cols] & (both >= least[:, cols])
        for r, c in zip(*np.nonzero(linked), strict=True):
            if join(int(rows[r]), int(cols[c])):
                out.append((int(rows[r]), int(cols[c])))
    return out


def _inside(table: pa.Table) -> pa.Table:
    """The links of one block of a cluster; the lead comes first where it was sent along."""
    table = table.sort_by([("sent", "descending"), ("rep", "ascending"), ("s1", "ascending")])
    rep, s1 = np.asarray(table["rep"]), np.asarray(table["s1"])
    column = table["text"].combine_chunks()
    sets: list[np.ndarray] = []
    for a, b in steps(column, STEP_BYTES):
        sets += shingle_sets(column.slice(a, b - a))
    # Of rows that share an id only those that the class stands for, and of repeated rows one.
    own = [k for k, s in enumerate(sets) if signature(s) == s1[k]]
    known: set[tuple[int, int]] = set()
    own = [k for k in own if (key := (int(rep[k]), int(s1[k]))) not in known and not known.add(key)]
    ids, sets = rep[own], [sets[k] for k in own]
    found = links_inside(sets) if len(sets) > 1 else []
    del sets
    settle()
    return pa.table({"a": pa.array([int(ids[x]) for x, _ in found], pa.int64()), "b": pa.array([int(ids[y]) for _, y in found], pa.int64())})


def _entries(late: np.ndarray, buckets: np.ndarray):
    """Texts of class representatives to packed prefix entries; `late`: the tokens that come last, in order."""
    late_sorted = np.sort(late)
    late_rank = np.argsort(late, kind="stable")
    maybe = np.zeros(1 << 16, dtype=bool)
    maybe[(late >> U(48)).astype(np.int64)] = True

    def ordered(s: np.ndarray) -> np.ndarray:
        near = np.flatnonzero(maybe[(s >> U(48)).astype(np.int64)])
        if len(near):
            at = np.searchsorted(late_sorted, s[near])
            at[at == len(late_sorted)] = 0
            hit = late_sorted[at] == s[near]
            if hit.any():
                is_late = np.zeros(len(s), dtype=bool)
                is_late[near[hit]] = True
                return np.concatenate([s[~is_late], s[near[hit]][np.argsort(late_rank[at[hit]])]])
        return s

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, _ = id_array(batch.column(0))
            clusters, blocks, direct = (np.asarray(batch.column(k)) for k in (2, 4, 5))
            s1 = np.asarray(batch.column(3))
            for a, b in steps(batch.column(1), STEP_BYTES):
                sets = shingle_sets(batch.column(1).slice(a, b - a))
                own = np.array([len(s) > 0 and signature(s) == s1[a + k] for k, s in enumerate(sets)], dtype=bool)
                sets = [s for s, o in zip(sets, own, strict=True) if o]
                rep, toward, block, near = reps[a:b][own], (reps - clusters)[a:b][own], blocks[a:b][own].astype(np.uint32), direct[a:b][own].astype(np.uint8)
                size = np.array([len(s) for s in sets], dtype=np.int64)
                length = prefix_length(size)
                key = np.concatenate([ordered(s)[:n] for s, n in zip(sets, length, strict=True)]) if sets else np.zeros(0, np.uint64)
                pos = np.arange(len(key)) - np.repeat(np.cumsum(length) - length, length)
                order = np.argsort(key)
                of = np.repeat(np.arange(len(sets)), length)[order]
                yield packed_batch(pack([key[order], rep[of], size[of].astype(np.uint32), pos[order].astype(np.uint32), toward[of], block[of], near[of]], buckets))
        settle()

    return run


_ENTRY = [np.uint64, np.int64, np.uint32, np.uint32, np.int64, np.uint32, np.uint8]


def _open_pairs(x, y, rep, size, pos, cluster, block, direct) -> np.ndarray:
    """Which pairs of entries of one token can belong to a link that isn't answered yet."""
    a, b = size[x], size[y]
    ok = (rep[x] != rep[y]) & (5 * np.minimum(a, b) >= 4 * np.maximum(a, b))
    ok &= (cluster[x] != cluster[y]) | ((block[x] != block[y]) & ~(direct[x] & direct[y]))
    pa_, pb = prefix_length(a), prefix_length(b)
    return ok & (pos[x] < np.minimum(pa_, pb + a - b)) & (pos[y] < np.minimum(pb, pa_ + b - a))


def walk(size: np.ndarray, pos: np.ndarray, step: int) -> Iterator[tuple[int, list[int]]]:
    """Blocks of a list that is ordered by size and position, each with the blocks (itself, later ones) whose sizes and positions can belong to a link."""
    starts = np.arange(0, len(size), step)
    low, high = size[starts], np.maximum.reduceat(size, starts)
    least = np.minimum.reduceat(pos, starts)
    p = prefix_length(high)
    for k in range(len(starts)):
        later = np.arange(k, len(starts))
        can = 5 * high[k] >= 4 * low[later]
        can &= least[k] < np.minimum(p[k], p[later] + high[k] - low[later])
        can &= least[later] < np.minimum(p[later], p[k] + high[later] - low[k])
        yield int(starts[k]), starts[later[can]].tolist()


def _pairs(buckets: np.ndarray, longest: int | None):
    """Entries of a range of tokens to packed pairs, with how often they met and how often they must; and the sets of lists that are put off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [x for batch in batches for x in batch.column(batch.schema.get_field_index("entries")).to_pylist()]
        key, rep, size, pos, toward, block, near = unpack(blobs, _ENTRY)
        del blobs
        size, pos, cluster, direct = size.astype(np.int64), pos.astype(np.int64), rep - toward, near.astype(bool)
        order = np.lexsort((pos, size, key))
        key, rep, size, pos, cluster, block, direct = (x[order] for x in (key, rep, size, pos, cluster, block, direct))
        first = runs(key)
        count = np.diff(np.append(first, len(key)))
        if not len(key):
            return
        many = lambda x: np.minimum.reduceat(x, first) != np.maximum.reduceat(x, first)
        useful = (count > 1) & (many(cluster) | (many(block) & ~np.logical_and.reduceat(direct, first)))
        state = (rep, size, pos, cluster, block, direct)
        xs, ys, held = [], [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            x, y = np.concatenate(xs), np.concatenate(ys)
            a, b = size[x], size[y]
            alpha = need(a, b)
            depth = np.minimum(prefix_length(a) - a + alpha, prefix_length(b) - b + alpha)
            one, two = np.minimum(rep[x], rep[y]), np.maximum(rep[x], rep[y])
            for bucket, entries in pack(_met(one, two, np.ones(len(x), np.uint32), depth.astype(np.uint32)), buckets):
                yield _out(bucket, entries, None, 0)

        # Short lists, all at once: each entry with the next one, the one after that, and so on.
        short = useful & (count <= SHORT_LIST)
        left = np.repeat(np.where(short, first + count, 0), count)  # where each entry's list ends
        at = np.flatnonzero(left)
        for d in range(1, SHORT_LIST):
            at = at[at + d < left[at]]
            if not len(at):
                break
            ok = _open_pairs(at, at + d, *state)
            xs.append(at[ok])
            ys.append(at[ok] + d)
            held += int(ok.sum())
            if held > PAIRS:
                yield from packed()
                xs, ys, held = [], [], 0
        for lo, n in zip(first[useful & ~short].tolist(), count[useful & ~short].tolist(), strict=True):
            if longest is not None and n > longest:
                yield _out(-1, np.uint32(n).tobytes() + planes(rep[lo : lo + n]), int(key[lo : lo + 1].view(np.int64)[0]), n)
                continue
            for a, others in walk(size[lo : lo + n], pos[lo : lo + n], WALK):
                for c in others:
                    x, y = np.meshgrid(np.arange(lo + a, lo + min(n, a + WALK)), np.arange(lo + c, lo + min(n, c + WALK)), indexing="ij")
                    ok = (x < y).ravel()
                    x, y = x.ravel()[ok], y.ravel()[ok]
                    ok = _open_pairs(x, y, *state)
                    xs.append(x[ok])
                    ys.append(y[ok])
                    held += int(ok.sum())
                    if held > PAIRS:
                        yield from packed()
                        xs, ys, held = [], [], 0
        if held:
            yield from packed()
        settle()

    return run


def _out(bucket: int, entries: bytes, token: int | None, often: int) -> pa.RecordBatch:
    columns = [pa.array([bucket], pa.int32()), pa.array([entries], pa.binary()), pa.array([token], pa.int64()), pa.array([often], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "entries", "token", "often"])


def _put_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of lists that are put off."""
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(unpack([blob], [np.int64])[0]))], names=["rep"])


def _met(one: np.ndarray, two: np.ndarray, times: np.ndarray, depth: np.ndarray) -> list[np.ndarray]:
    """Pairs put together: key, ids, how often they met, how often they must; in the order of the key."""
    with np.errstate(over="ignore"):
        key = mix(one.view(np.uint64) * SEEDS[0] ^ mix(two.view(np.uint64)))
    order = np.lexsort((two, one, key))
    key, one, two, times, depth = key[order], one[order], two[order], times[order], depth[order]
    if not len(key):
        return [key, one, two, times, depth]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
    return [key[first], one[first], two[first], np.add.reduceat(times, first).astype(np.uint32), np.minimum.reduceat(depth, first)]


def _likely(table: pa.Table) -> pa.Table:
    _, one, two, times, depth = _met(*unpack(table["entries"].to_pylist(), [np.uint64, np.int64, np.int64, np.uint32, np.uint32])[1:])
    enough = times >= depth
    return pa.table({"a": pa.array(one[enough]), "b": pa.array(two[enough])})


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            linked = []
            for s, t in zip(shingle_sets(part.column(2)), shingle_sets(part.column(3)), strict=True):
                both = len(np.intersect1d(s, t, assume_unique=True))
                linked.append(both > 0 and 100 * both >= 80 * (len(s) + len(t) - both))
            chosen = pa.array(linked)
            yield pa.RecordBatch.from_arrays([part.column(0).filter(chosen), part.column(1).filter(chosen)], names=["a", "b"])


def jaccard_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = text_bytes(rows, "text")
    buckets = even_labels(spark, bucket_count(spark, size / 6 / 5, ENTRIES, least=1))

    summary = checkpointed(rows.mapInArrow(_summaries, "doc_id long, n long, s1 long, s2 long, smallest array<long>, common binary"))
    told = summary.filter("n = -1").select("common").mapInArrow(_common, "token long, often long").groupBy("token").agg(F.sum("often").alias("often"))
    late = told.orderBy(F.desc("often"), "token").limit(KEEP).orderBy("often", "token").select("token").collect()  # KEEP rows at most
    late = np.array([r["token"] for r in late], dtype=np.int64).view(np.uint64)

    # Classes of equal sets.
    full = summary.filter("n > 0").select("doc_id", "n", "s1", "s2", "smallest")
    classes = full.groupBy(F.col("s1").alias("k1"), F.col("s2").alias("k2"), F.col("n").alias("kn")).agg(F.min("doc_id").alias("rep"), F.count("*").alias("c"))
    member = checkpointed(join_groups(full, classes, {"s1": "k1", "s2": "k2", "n": "kn"}, "c").select("doc_id", "n", "s1", "s2", "smallest", "rep"))
    reps = member.filter("doc_id = rep").dropDuplicates(["rep", "s1", "s2"]).select("rep", "n", "s1", "smallest")

    # Clusters, cut to blocks of bounded size.
    clusters = _clusters(reps)
    sums = clusters.groupBy(F.col("cluster").alias("k")).agg(F.sum("n").alias("shingles"), F.count("*").alias("members"))
    blocks = F.ceil(F.greatest(F.col("shingles") / BLOCK_SHINGLES, F.col("members") / BLOCK_SETS)).cast("int")
    labels = join_groups(clusters, sums, {"cluster": "k"}, "members").select("rep", "n", "s1", "cluster", "members", blocks.alias("blocks"), F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("block"))
    labels = checkpointed(labels)

    def with_text(which: DataFrame, few: bool = False) -> DataFrame:
        """The texts of some sets; where they are few, other texts stay where they are."""
        mine = rows
        if few and which.count() <= BROADCAST_ROWS:
            ids = which.select(F.col("rep").alias("few")).distinct()
            mine = rows.join(F.broadcast(ids), F.col("doc_id") == F.col("few"), "left_semi")
        return mine.join(which, F.col("doc_id") == F.col("rep")).drop("doc_id")

    inside = lambda texts: texts.select("rep", "text", "cluster", "block", "s1", "sent").groupBy("cluster", "block").applyInArrow(_inside, "a long, b long")

    # Clusters of several blocks come first: their lead goes to each block, and what links with it is answered in all of them.
    sure = []
    cut = labels.filter("blocks > 1")
    if cut.isEmpty():
        labels = labels.withColumn("direct", F.lit(False))
    else:
        lead = cut.groupBy(F.col("cluster").alias("c")).agg(F.max("blocks").alias("blocks")).join(labels.select("rep", "s1"), F.col("c") == F.col("rep"))
        lead = lead.select("rep", "s1", F.col("c").alias("cluster"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("sent"))
        parts = cut.join(F.broadcast(lead.select(F.col("rep").alias("l")).distinct()) if lead.count() <= BROADCAST_ROWS else lead.select(F.col("rep").alias("l")).distinct(), F.col("rep") == F.col("l"), "left_anti")
        sure.append(checkpointed(inside(with_text(checkpointed(parts.select("rep", "s1", "cluster", "block", F.lit(False).alias("sent")).unionByName(lead)), few=True))))
        near = sure[0].select(F.col("a").alias("l"), F.col("b").alias("d"))
        near = near.unionByName(lead.select(F.col("rep").alias("l"), F.col("rep").alias("d"))).distinct()
        labels = checkpointed(labels.join(near, (F.col("cluster") == F.col("l")) & (F.col("rep") == F.col("d")), "left").withColumn("direct", F.col("d").isNotNull()).drop("l", "d"))

    # The index, a round at a time; a round's long lists are put off to the next.
    packed = "bucket int, entries binary"
    todo, likely = labels, []
    for k in range(ROUNDS):
        texts = with_text(todo.select("rep", "s1", "cluster", "block", "direct", "members", "blocks", F.lit(False).alias("sent")), few=k > 0)
        entries = texts.select("rep", "text", "cluster", "s1", "block", "direct").mapInArrow(_entries(late, buckets), packed)
        met = entries.groupBy("bucket").applyInArrow(_pairs(buckets, LONG if k + 1 < ROUNDS else None), packed + ", token long, often long")
        none = F.lit(None).cast("long")
        if k == 0:  # in the same job, so that texts move once
            links = inside(texts.filter("members > 1 and blocks = 1"))
            met = met.select("*", none.alias("a"), none.alias("b")).unionByName(links.select(*[F.lit(None).cast(t).alias(c) for c, t in (("bucket", "int"), ("entries", "binary"), ("token", "long"), ("often", "long"))], "a", "b"))
        met = checkpointed(met)
        if k == 0:
            sure.append(met.filter("a is not null").select("a", "b"))
        likely.append(met.filter("bucket >= 0").select("bucket", "entries").groupBy("bucket").applyInArrow(_likely, "a long, b long"))
        off = met.filter("token is not null")
        often = off.groupBy("token").agg(F.sum("often").alias("often")).orderBy(F.desc("often"), "token").limit(KEEP).orderBy("often", "token").collect()  # KEEP rows at most
        if not often:
            break
        new = np.array([r["token"] for r in often], dtype=np.int64).view(np.uint64)
        late = np.concatenate([late[~np.isin(late, new)], new])
        again = off.select("entries").mapInArrow(_put_off, "rep long").distinct()
        todo = checkpointed(todo.join(again, "rep", "left_semi"))
    likely = checkpointed(reduce(DataFrame.unionByName, likely).distinct())
    sure = reduce(DataFrame.unionByName, sure)

    # Likely pairs are compared on their texts.
    chosen = likely.select(F.col("a").alias("id")).union(likely.select("b")).distinct()
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    some = rows.join(chosen, rows["doc_id"] == chosen["id"], "left_semi").withColumn("h", F.xxhash64("text")).dropDuplicates(["doc_id", "h"])
    left, right = some.select(F.col("doc_id").alias("ia"), F.col("text").alias("ta")), some.select(F.col("doc_id").alias("ib"), F.col("text").alias("tb"))
    across = likely.join(left, F.col("a") == F.col("ia")).join(right, F.col("b") == F.col("ib")).select("a", "b", "ta", "tb").mapInArrow(_compare, "a long, b long")

    # Rows that share an id tie their classes together.
    ids = member.filter("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("top")).filter("b <> top")
    tied = member.join(ids.select(F.col("doc_id").alias("i"), "b"), F.col("doc_id") == F.col("i")).select(F.col("rep").alias("a"), "b")
    roots = components(sure.unionByName(across).unionByName(tied))

    rest = summary.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    mine = member.select("doc_id", F.col("n").alias("n_shingles"), "rep")
    named = mine.filter("rep is not null").groupBy(F.col("rep").alias("r")).agg(F.count("*").alias("c")).join(roots, F.col("r") == F.col("node"), "left").select("r", "c", F.coalesce("root", "r").alias("component_id"))
    placed = join_groups(mine, named, {"rep": "r"}, "c").select("doc_id", "n_shingles", "component_id")
    nameless = mine.filter("rep is null").withColumnRenamed("rep", "component_id")
    return placed.unionByName(nameless).unionByName(rest)
