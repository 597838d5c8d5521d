"""Toxicity by weak supervision.

1. Terms (words, stems of words, pairs of words) are counted over a bounded sample of the learning
   fold: CLASS_ROWS labelled rows of each class and FREE_ROWS other rows, taken by hash of the id.
   Counts are summed in Spark; the driver gets the CANDIDATES terms that tell the classes apart best,
   and then, of each sample row, one bit a candidate.  So what it receives has a fixed bound, however
   many and long the texts are.
2. Voters rest on separate kinds of evidence: a lexicon of whole words, lexicons of stems of three
   lengths, a lexicon of word pairs, a lexicon of words that speak for clean texts, several hits at
   once, a fixed list of insults, shouting, and runs of exclamation marks.  Each votes toxic or clean, or abstains.
3. A generative label model is fitted by expectation maximisation on the votes of all sample rows,
   without looking at labels: it estimates each voter's accuracy, finds from what the classes leave
   unexplained which voters are correlated, and gives such groups one table of their joint votes for
   each class in place of a product.  The prior is the share of toxic rows among all labelled ones,
   and sample rows weigh as many rows as they stand for.
4. A linear (logistic) classifier over terms is trained on the model's posteriors.  It alone scores
   texts: the terms of the whole text are looked up.

Scores don't depend on labels, lang, source or doc_id of the scored document.

Edge cases: null and empty texts get the classifier's score of no terms; without labelled rows of
both classes, or without any term that tells them apart, every score is 0; conflicting or repeated
labels of one document count by their largest; ties between terms fall to the smaller hash; very long
texts are read whole; repeated rows get equal results; an empty table gives no rows; only doc_id and
text (and labels' doc_id, toxic) are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_count, checkpointed, even_labels, held_out, pack, packed_batch, settle, text_bytes, unpack
from .textvec import LOWER, U, Words, flat, mix, steps, windows

CLASS_ROWS = 2_500
FREE_ROWS = 2_500
#: Terms that the driver gets, and those of them that the classifier weighs.
CANDIDATES = 8_192
TERMS = 1_024
#: Terms of one lexicon.
LEXICON = 512
MIN_SUPPORT = 3
#: Terms of one lexicon that make a further voter's vote.
SEVERAL = 3
#: Least likelihood-ratio statistic of a mined term: chance terms among a million stay below it.
LEAST_G = 24.0
#: Least share of toxic rows among all rows with a mined term, and of clean rows with a clean one.
LEAST_PRECISION = 0.85
#: Correlation, given the class, from which voters share a table; voters of one table.
CORRELATED = 0.3
GROUP = 3

_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Kinds of terms: the whole word, its first bytes where the word is longer, and two words in a row.
STEMS = (0, 4, 5, 6)
PAIR = len(STEMS)
_KIND = mix(np.arange(1, len(STEMS) + 2, dtype=np.uint64))
#: A term that a text holds at least so often counts as a further term of that text.
LEVELS = (1, 2, 3)

# Common insults, by language, for one pattern voter.
INSULTS = (
    "idiot moron stupid loser scum trash pathetic disgusting worthless clown dumb fool jerk "
    "dumm dreck abschaum versager widerlich trottel wertlos "
    "crétin imbécile stupide ordure minable débile dégoûtant "
    "idiota estúpido imbécil basura patético inútil asqueroso payaso"
)


def term_hashes(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, kind) of every word, stem and pair; a text's terms may repeat."""
    texts, size = words.text_of, words.ends - words.starts
    h = words.hashes()
    owner, terms, kinds = [texts], [mix(h ^ _KIND[0])], [np.zeros(len(h), np.uint8)]
    for kind, stem in enumerate(STEMS[1:], 1):
        long = np.flatnonzero(size > stem)
        owner.append(texts[long])
        terms.append(mix(words.span_hashes(words.starts[long], words.starts[long] + stem) ^ _KIND[kind]))
        kinds.append(np.full(len(long), kind, np.uint8))
    pairs = np.flatnonzero(words.left[: max(len(h) - 1, 0)] >= 2)
    owner.append(texts[pairs])
    terms.append(mix(windows(h, 2)[pairs] ^ _KIND[PAIR]))
    kinds.append(np.full(len(pairs), PAIR, np.uint8))
    return np.concatenate(owner), np.concatenate(terms), np.concatenate(kinds)


def _words(column: pa.Array) -> Words:
    data, off = flat(column)
    return Words(LOWER[data], off, _ALNUM)


def insult_terms() -> np.ndarray:
    _, terms, kinds = term_hashes(_words(pa.array([INSULTS])))
    return np.unique(terms[kinds == 0])


def leveled(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, kind * levels + level), each once, of the texts; ordered by term."""
    owner, terms, kinds = term_hashes(_words(column))
    order = np.lexsort((owner, terms))
    owner, terms, kinds = owner[order], terms[order], kinds[order]
    if not len(terms):
        return owner, terms, kinds
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (terms[1:] != terms[:-1])]))
    often = np.diff(np.append(first, len(terms)))
    owner, terms, kinds = owner[first], terms[first], kinds[first]
    parts = [(owner[often >= n], terms[often >= n], (kinds[often >= n] * len(LEVELS) + k).astype(np.uint8)) for k, n in enumerate(LEVELS)]
    owner, terms, kinds = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((owner, kinds, terms))
    return owner[order], terms[order], kinds[order]


@dataclass
class Sample:
    """Rows to learn from: toxic (1, 0, or -1 where unlabelled), weights, candidate terms and which rows hold them, pattern measures."""

    toxic: np.ndarray
    weights: np.ndarray  # how many rows of the fold each row stands for, 1 on average
    terms: np.ndarray
    kinds: np.ndarray  # of each candidate: kind * levels + level
    holds: np.ndarray  # rows x candidates, boolean
    insults: np.ndarray
    shouting: np.ndarray
    marks: np.ndarray
    totals: tuple[int, int]  # labelled rows of class 0 and 1 that the sample stands for


def g_statistic(p: np.ndarray, q: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """The likelihood-ratio statistic of terms that p of n_pos toxic and q of n_neg clean rows hold."""
    both = (p + q) / max(n_pos + n_neg, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda k, n: np.where(k > 0, k * np.log(k / (n * both)), 0) + np.where(n - k > 0, (n - k) * np.log((n - k) / (n * np.maximum(1 - both, 1e-12))), 0)
        return np.nan_to_num(2 * (part(p, max(n_pos, 1)) + part(q, max(n_neg, 1))))


def _tally(batches: Iterator[pa.RecordBatch], buckets: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Texts and classes to packed counts: term, kind, and how many rows of each class hold it."""
    for batch in batches:
        for a, b in steps(batch.column(0)):
            owner, terms, kinds = leveled(batch.column(0).slice(a, b - a))
            toxic = np.asarray(batch.column(1).slice(a, b - a))[owner]
            new = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (kinds[1:] != kinds[:-1])])) if len(terms) else np.zeros(0, int)
            counts = [np.add.reduceat((toxic == y).astype(np.uint32), new) if len(new) else np.zeros(0, np.uint32) for y in (1, 0, -1)]
            yield packed_batch(pack([terms[new], kinds[new], *counts], buckets))
    settle()


def _best(n_pos: int, n_neg: int):
    """Packed counts to terms with their totals, those that tell something."""

    def run(table: pa.Table) -> pa.Table:
        terms, kinds, p, q, f = unpack(table["entries"].to_pylist(), [np.uint64, np.uint8, np.uint32, np.uint32, np.uint32])
        order = np.lexsort((kinds, terms))
        terms, kinds = terms[order], kinds[order]
        first = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (kinds[1:] != kinds[:-1])])) if len(terms) else np.zeros(0, int)
        p, q, f = (np.add.reduceat(x[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for x in (p, q, f))
        terms, kinds = terms[first], kinds[first]
        g = g_statistic(p, q, n_pos, n_neg)
        odds = np.abs(np.log((p + 0.5) / (n_pos + 1)) - np.log((q + 0.5) / (n_neg + 1)))
        good = (p + q + f >= MIN_SUPPORT) & (odds > 1)
        return pa.table({"term": pa.array(terms[good].view(np.int64)), "kind": pa.array(kinds[good].astype(np.int32)), "g": pa.array(np.round(g[good], 6))})

    return run


def _bits(terms: np.ndarray, kinds: np.ndarray):
    """Texts to one bit a candidate (sorted by term and kind), and pattern measures."""
    insults = insult_terms()
    maybe = np.zeros(1 << 16, dtype=bool)
    maybe[(terms >> U(48)).astype(np.int64)] = True
    place = {(int(t), int(k)): n for n, (t, k) in enumerate(zip(terms, kinds, strict=True))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in steps(batch.column(0)):
                part = batch.slice(a, b - a)
                owner, found, kind = leveled(part.column(0))
                plain = np.flatnonzero((kind == 0) & np.isin(found, insults))
                near = np.flatnonzero(maybe[(found >> U(48)).astype(np.int64)])
                near = near[np.isin(found[near], terms)]
                holds = np.zeros((b - a, len(terms)), dtype=bool)
                for o, t, k in zip(owner[near].tolist(), found[near].tolist(), kind[near].tolist(), strict=True):
                    if (n := place.get((t, k))) is not None:
                        holds[o, n] = True
                data, off = flat(part.column(0))
                share = lambda flags, of: np.diff(np.concatenate([[0], np.cumsum(flags)])[off]) / np.maximum(of, 1)  # noqa: B023, E731
                columns = [pa.array([row.tobytes() for row in np.packbits(holds, axis=1)], pa.binary()), pa.array(np.bincount(owner[plain], minlength=b - a))]
                columns += [pa.array(share((data >= 65) & (data <= 90), np.diff(off))), pa.array(share(data == 33, _words(part.column(0)).counts))]
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), *columns], names=["toxic", "l_id", "bits", "insults", "caps", "marks"])

    return run


def draw(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", class_rows: int = CLASS_ROWS, free_rows: int = FREE_ROWS) -> Sample | None:
    """The bounded sample, or None without labelled rows of both classes.  The sampled labels are about 2 * class_rows rows, so they are broadcast."""
    part = F.pmod(F.xxhash64(F.lit("toxicity"), "l_id"), F.lit(1 << 30))
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("l_id")).agg(F.max("toxic").cast("int").alias("l_toxic"))
    n = {r["l_toxic"]: r["n"] for r in known.groupBy("l_toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return None
    below = {k: int(min(1.0, class_rows / v) * (1 << 30)) + 1 for k, v in n.items()}
    known = known.filter(F.when(F.col("l_toxic") == 1, part < below[1]).otherwise(part < below[0]))
    mine = docs.select(F.col(doc_id).alias("l_id"), F.col(text).alias("text")).filter(F.col("l_id").isNotNull() & ~held_out(F.col("l_id")))
    share = min(1.0, free_rows / max(docs.count(), 1))
    free = mine.filter(F.pmod(F.xxhash64(F.lit("unlabelled"), "l_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    rows = mine.join(F.broadcast(known), "l_id").select("text", F.col("l_toxic").alias("toxic"), "l_id").unionByName(free.select("text", F.lit(-1).alias("toxic"), "l_id"))
    rows = checkpointed(rows)  # the sampled texts, read twice
    of = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not of.get(0) or not of.get(1):
        return None

    buckets = even_labels(rows.sparkSession, bucket_count(rows.sparkSession, text_bytes(rows, "text") * 1.5, 1_000_000, least=1))
    tallied = rows.select("text", "toxic").mapInArrow(lambda batches: _tally(batches, buckets), "bucket int, entries binary")
    best = tallied.groupBy("bucket").applyInArrow(_best(of[1], of[0]), "term long, kind int, g double").orderBy(F.desc("g"), "term", "kind").limit(CANDIDATES).collect()  # CANDIDATES rows at most
    terms, kinds = np.array([r["term"] for r in best], np.int64).view(np.uint64), np.array([r["kind"] for r in best], int)
    order = np.lexsort((kinds, terms))
    terms, kinds = terms[order], kinds[order]

    kind = rows.schema["l_id"].dataType.simpleString()
    found = rows.mapInArrow(_bits(terms, kinds), f"toxic int, l_id {kind}, bits binary, insults long, caps double, marks double").collect()  # CANDIDATES / 8 bytes a sample row
    found.sort(key=lambda r: (r["toxic"], r["l_id"], bytes(r["bits"]), r["caps"], r["marks"]))
    toxic = np.array([r["toxic"] for r in found], int)
    holds = np.unpackbits(np.stack([np.frombuffer(r["bits"], np.uint8) for r in found]), axis=1, count=len(terms)).astype(bool)
    weights = np.ones(len(toxic))
    labelled = toxic >= 0
    for y in (0, 1):
        weights[toxic == y] = n[y] / of[y]
    weights[labelled] *= labelled.sum() / weights[labelled].sum()
    column = lambda c: np.array([r[c] for r in found])
    return Sample(toxic, weights, terms, kinds, holds, column("insults"), column("caps"), column("marks"), (n[0], n[1]))


def mine_terms(s: Sample, side: int) -> np.ndarray:
    """Candidates that speak for toxic (1) or clean (0) rows, strongest first."""
    n_pos, n_neg = int((s.toxic == 1).sum()), int((s.toxic == 0).sum())
    p, q = s.holds[s.toxic == 1].sum(axis=0), s.holds[s.toxic == 0].sum(axis=0)
    g = g_statistic(p, q, n_pos, n_neg)
    here, there = (p * s.totals[1] / n_pos, q * s.totals[0] / n_neg) if side else (q / n_neg, p / n_pos)  # clean terms: by rate, as most rows are clean
    good = np.flatnonzero((here / np.maximum(here + there, 1e-9) >= LEAST_PRECISION) & (g > LEAST_G))
    return good[np.lexsort((s.kinds[good], s.terms[good], -g[good]))]


def votes(s: Sample) -> np.ndarray:
    """Rows x voters: 1 votes toxic, -1 clean, 0 abstains."""
    mined = mine_terms(s, 1)
    base = s.kinds // len(LEVELS)
    columns = []
    for kind in range(PAIR + 1):
        lexicon = mined[base[mined] == kind][:LEXICON]
        if len(lexicon):
            hits = s.holds[:, lexicon].sum(axis=1)
            columns += [np.where(hits > 0, 1, -1), np.where(hits >= SEVERAL, 1, 0)]
    clean = mine_terms(s, 0)
    clean = clean[base[clean] == 0][:LEXICON]
    if len(clean):
        columns.append(np.where(s.holds[:, clean].sum(axis=1) >= 2, -1, 0))
    columns += [np.where(s.insults > 0, 1, 0), np.where(s.shouting > 0.3, 1, 0), np.where(s.marks > 0.2, 1, 0)]
    return np.stack(columns, axis=1)


class LabelModel:
    """Votes given the class: a table a voter, and one table for each group of correlated voters; from the votes alone."""

    def __init__(self, prior: float, rounds: int = 30):
        self.prior, self.rounds = prior, rounds

    def fit(self, v: np.ndarray, weights: np.ndarray | None = None) -> LabelModel:
        m = v.shape[1]
        self.weights = np.ones(len(v)) if weights is None else weights
        self.groups = [[j] for j in range(m)]
        # Each vote is first taken to be right more often than not.
        toxic, clean = np.array([0.2, 0.4, 0.4]), np.array([0.4, 0.5, 0.1])
        self.tables = [np.stack([toxic, clean])] * m
        self.correlations = np.eye(m)
        for k in range(self.rounds):
            p = self.posterior(v)
            if k in (1, self.rounds // 3):  # early, before voters that repeat each other outvote the rest; and once more
                self._group(v, p)
            self.tables = [self._table(v, p, g) for g in self.groups]
        return self

    @staticmethod
    def _code(v: np.ndarray, group: list[int]) -> np.ndarray:
        """The joint vote of a group as a number."""
        code = np.zeros(len(v), int)
        for j in group:
            code = 3 * code + v[:, j] + 1
        return code

    def _table(self, v: np.ndarray, p: np.ndarray, group: list[int]) -> np.ndarray:
        """2 x joint votes: their chances in each class, smoothed by the product of the voters' own."""
        out = []
        for w in (p * self.weights, (1 - p) * self.weights):
            smooth = np.ones(1)
            for j in group:
                one = np.bincount(v[:, j] + 1, weights=w, minlength=3) + 0.5
                smooth = np.outer(smooth, one / one.sum()).ravel()
            joint = np.bincount(self._code(v, group), weights=w, minlength=3 ** len(group)) + smooth
            out.append(joint / joint.sum())
        return np.stack(out)

    def _group(self, v: np.ndarray, p: np.ndarray) -> None:
        """Correlations of what the class doesn't explain; the strongest pairs are put together first."""
        w = self.weights
        rest = np.empty(v.shape)
        for j in range(v.shape[1]):
            mean = [(v[:, j] * x * w).sum() / max((x * w).sum(), 1e-9) for x in (p, 1 - p)]
            rest[:, j] = v[:, j] - (p * mean[0] + (1 - p) * mean[1])
        c = (rest * w[:, None]).T @ rest / w.sum()
        sd = np.sqrt(np.maximum(np.diag(c), 1e-12))
        self.correlations = np.clip(c / np.outer(sd, sd), -1, 1)
        np.fill_diagonal(self.correlations, 1)
        pairs = [(-abs(self.correlations[i, j]), i, j) for j in range(len(sd)) for i in range(j) if abs(self.correlations[i, j]) >= CORRELATED]
        at = {j: [j] for j in range(len(sd))}
        for _, i, j in sorted(pairs):
            if at[i] is not at[j] and len(at[i]) + len(at[j]) <= GROUP:
                both = sorted(at[i] + at[j])
                for k in both:
                    at[k] = both
        self.groups = sorted({tuple(g) for g in at.values()})
        self.groups = [list(g) for g in self.groups]

    def accuracies(self, v: np.ndarray) -> np.ndarray:
        """The chance that a vote that a voter casts is right, by the model's posteriors."""
        p = self.posterior(v)
        right = [(((v[:, j] == 1) * p + (v[:, j] == -1) * (1 - p)) * self.weights).sum() for j in range(v.shape[1])]
        return np.array(right) / np.maximum(((v != 0) * self.weights[:, None]).sum(axis=0), 1e-9)

    def posterior(self, v: np.ndarray) -> np.ndarray:
        logit = np.full(len(v), np.log(self.prior / (1 - self.prior)))
        for group, table in zip(self.groups, self.tables, strict=True):
            logit += (np.log(table[0]) - np.log(table[1]))[self._code(v, group)]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


@dataclass
class Classifier:
    """A logistic model over hashed terms: sorted terms, their weights, and the weight of no terms."""

    terms: np.ndarray
    weights: np.ndarray  # levels x terms
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        w = _words(column)
        n, m = len(w.counts), len(self.terms)
        logit = np.full(n, self.bias)
        if m and len(w):
            owner, terms, _ = term_hashes(w)
            maybe = np.zeros(1 << 16, dtype=bool)
            maybe[(self.terms >> U(48)).astype(np.int64)] = True
            near = np.flatnonzero(maybe[(terms >> U(48)).astype(np.int64)])
            at = np.searchsorted(self.terms, terms[near])
            at[at == m] = 0
            same = self.terms[at] == terms[near]
            which, often = np.unique(owner[near][same] * m + at[same], return_counts=True)
            for k, least in enumerate(LEVELS):
                hit = which[often >= least]
                logit += np.bincount(hit // m, weights=self.weights[k, hit % m], minlength=n)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def train(s: Sample | None, *, terms: int = TERMS, rounds: int = 300, decay: float = 0.05) -> Classifier | None:
    if s is None or not len(mine_terms(s, 1)):
        return None
    v = votes(s)
    prior = float(np.clip(s.totals[1] / sum(s.totals), 0.005, 0.995))
    posterior = LabelModel(prior).fit(v, s.weights).posterior(v)

    # Terms by how far their weighted frequency differs between the posterior classes.
    one, zero = (posterior * s.weights) @ s.holds, ((1 - posterior) * s.weights) @ s.holds
    n_one, n_zero = (posterior * s.weights).sum(), ((1 - posterior) * s.weights).sum()
    odds = np.log((one + 0.5) / (n_one + 1)) - np.log((zero + 0.5) / (n_zero + 1))
    seen = np.abs(odds) > 1  # not the common words of a language
    rank = np.where(seen, np.abs(odds) * (one / max(n_one, 1) + 0.2 * zero / max(n_zero, 1)), 0)
    chosen = np.sort(np.argsort(-rank, kind="stable")[: min(terms, int(seen.sum()))])
    x = s.holds[:, chosen].astype(np.float32)
    y, weights = posterior.astype(np.float32), (s.weights / s.weights.sum()).astype(np.float32)
    w, b = np.zeros(len(chosen), np.float32), np.float32(0)
    mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for k in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        g = (p - y) * weights
        gw, gb = x.T @ g + np.float32(decay / len(y)) * w, g.sum()
        mw += 0.1 * (gw - mw)
        vw += 0.001 * (gw * gw - vw)
        mb += 0.1 * (gb - mb)
        vb += 0.001 * (gb * gb - vb)
        w -= 0.05 * (mw / (1 - 0.9**k)) / (np.sqrt(vw / (1 - 0.999**k)) + 1e-8)
        b -= 0.05 * (mb / (1 - 0.9**k)) / (np.sqrt(vb / (1 - 0.999**k)) + 1e-8)
    # What tells little is left out, so that long texts don't add it up.
    kept = np.flatnonzero(np.abs(w) >= 0.05)
    every = np.unique(s.terms[chosen[kept]])
    out = np.zeros((len(LEVELS), len(every)))
    out[s.kinds[chosen[kept]] % len(LEVELS), np.searchsorted(every, s.terms[chosen[kept]])] = w[kept]
    return Classifier(every, out, float(b))


def score(docs: DataFrame, model: Classifier | None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, score, predicted."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in steps(batch.column(1)):
                part = batch.slice(a, b - a)
                p = model.score(part.column(1)) if model is not None else np.zeros(b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", class_rows: int = CLASS_ROWS, free_rows: int = FREE_ROWS) -> DataFrame:
    """Learns from the learning fold and scores every document."""
    return score(docs, train(draw(docs, labels, doc_id=doc_id, text=text, class_rows=class_rows, free_rows=free_rows)), doc_id=doc_id, text=text)
