"""Brute force, round trips and the edge cases of every operator of the subpackage."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import bpe, common, components, decontaminate, html_extract, langid, ngram_join, quality, queries, sharding, substring_dedup, token_counts, toxicity
from plumbline.llm.textvec import Words, flat

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, part int, bucket int"
BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return BLANK.findall(t or "")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, very long, repeated rows, rows that share an id, clashing column names."""
    rnd = random.Random(5)
    vocab = [f"w{k}" for k in range(400)] + ["É", "naïve", "日本", "x y"]
    base = [rnd.choice(vocab) for _ in range(300)]
    texts = [" ".join(base), " ".join(base[:120] + ["new"] + base[121:]), "\n".join(base[40:140]) + "\t", " ".join(rnd.choice(vocab) for _ in range(60_000)), "", None, "a b c", "A b  c", " ", "the only word" * 3]
    rows = [(k, t, None if k == 3 else "en", None if k == 4 else f"s{k % 2}", 1, "k", 1, 2) for k, t in enumerate(texts)]
    rows += [rows[0], rows[0], (1, "shares an id with another text " * 4, "en", "s", 1, "k", 1, 2), (None, " ".join(base), "en", "s", 1, "k", 1, 2), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


LABELS = "doc_id long, quality int, toxic int"


def test_words_like_the_pattern(odd):
    texts = [r["text"] for r in odd.collect()]
    w = Words(*flat(pa.array(texts, pa.string())))
    data = b"".join((t or "").encode() for t in texts)
    assert [data[a:b].decode() for a, b in zip(w.starts, w.ends, strict=True)] == [x for t in texts for x in words(t)]


def brute_substring(rows):
    """(doc_id, kept words) of every row."""
    least = {}
    for i, t in rows:
        if i is not None:
            w = words(t)
            for s in range(len(w) - 49):
                k = tuple(w[s : s + 50])
                least[k] = min(i, least.get(k, i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for s in range(len(w) - 49):
            if i is not None and least[tuple(w[s : s + 50])] < i:
                gone |= set(range(s, s + 50))
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_substring_dedup(odd, none, spark):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = substring_dedup.substring_dedup(odd)
    assert sorted([tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()], key=repr) == brute_substring(rows)
    for r in got.select("kept_text", "kept_sha256").collect():
        assert hashlib.sha256(" ".join(words(r["kept_text"])).encode()).hexdigest() == r["kept_sha256"]
    assert substring_dedup.substring_dedup(none).count() == 0
    rnd = random.Random(1)
    base = [str(rnd.randint(0, 10**6)) for _ in range(400)]
    many = [(k, " ".join([str(rnd.random()) for _ in range(rnd.randint(0, 40))] + base[(a := rnd.randint(0, 300)) : a + rnd.randint(40, 130)] + ["z"] * rnd.randint(0, 70))) for k in range(120)]
    got = substring_dedup.substring_dedup(spark.createDataFrame(many, "doc_id long, text string").repartition(5)).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute_substring(many)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = words(lower(t))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    find, join = ngram_join._forest(len(rows))
    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if (i and 100 * i >= 80 * len(sets[a] | sets[b])) or (rows[a][0] is not None and rows[a][0] == rows[b][0] and sets[a] and sets[b]):
                join(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted([(i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)], key=repr)


def test_ngram_join(odd, none, spark, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert sorted([tuple(r) for r in ngram_join.jaccard_components(odd).collect()], key=repr) == brute_components(rows)
    assert ngram_join.jaccard_components(none).count() == 0
    rnd = random.Random(2)
    base = [str(rnd.randint(0, 500)) for _ in range(130)]
    near = []
    for k in range(90):
        w = list(base)
        for _ in range(rnd.randint(0, 8)):
            w[rnd.randrange(len(w))] = str(rnd.randint(0, 10**6))
        near.append((k, " ".join(w[: rnd.choice([130, 110, 60])])))
    got = ngram_join.jaccard_components(spark.createDataFrame(near, "doc_id long, text string").repartition(4))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute_components(near)


@pytest.mark.parametrize("settings", [{"BLOCK_SHINGLES": 200, "SHORT_LIST": 4}, {"BLOCK_SETS": 3, "LONG": 6, "SHORT_LIST": 2, "WALK": 3, "PAIRS": 5, "LOCAL_OFTEN": 1_000}, {"BLOCK_SETS": 1, "LONG": 2, "SHORT_LIST": 1, "WALK": 2, "KEEP": 4}])
def test_ngram_join_by_blocks_and_index(odd, spark, monkeypatch, settings):
    """With tiny blocks the index must find what the lead doesn't answer, in several rounds."""
    for name, value in settings.items():
        monkeypatch.setattr(ngram_join, name, value)
    rnd = random.Random(7)
    bases = [[str(rnd.randint(0, 500)) for _ in range(130)] for _ in range(3)]
    near = []
    for k in range(80):
        w = list(bases[k % 3] if k % 5 else bases[0][:60] + bases[1][60:])
        for _ in range(rnd.randint(0, 12)):
            w[rnd.randrange(len(w))] = str(rnd.randint(0, 10**6))
        near.append((k, " ".join(w[: rnd.choice([130, 110, 104, 60])])))
    near += [(100 + k, f"read all of our daily news {k // 2}") for k in range(40)]
    got = ngram_join.jaccard_components(spark.createDataFrame(near, "doc_id long, text string").repartition(4))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute_components(near)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert sorted([tuple(r) for r in ngram_join.jaccard_components(odd).collect()], key=repr) == brute_components(rows)


def test_answers_derived_from_the_lead():
    rnd = random.Random(8)
    for _ in range(60):
        base = rnd.sample(range(400), rnd.randint(1, 60))
        sets = [np.array(sorted(set(rnd.sample(base, rnd.randint(1, len(base)))) | set(rnd.sample(range(400), rnd.randint(0, 12)))), np.uint64) for _ in range(rnd.randint(2, 25))]
        links = ngram_join.links_inside(sets)
        find, join = ngram_join._forest(len(sets))
        for a, b in links:
            assert len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))
            join(a, b)
        got = [find(k) for k in range(len(sets))]
        find, join = ngram_join._forest(len(sets))
        for a in range(len(sets)):
            for b in range(a):
                if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b])):
                    join(a, b)
                    assert b or (0, a) in links  # all of the lead's own answers are told
        assert got == [find(k) for k in range(len(sets))]


def test_walk_skips_blocks_by_size_and_position():
    rng = np.random.default_rng(1)
    size = np.sort(rng.choice([40, 45, 50], 400))
    pos = np.array([rng.integers(0, ngram_join.prefix_length(n)) for n in size])
    order = np.lexsort((pos, size))
    size, pos = size[order], pos[order]
    x, y = (z.ravel() for z in np.meshgrid(np.arange(400), np.arange(400), indexing="ij"))
    x, y = x[x < y], y[x < y]
    other = np.arange(400)
    ok = ngram_join._open_pairs(x, y, other, size, pos, other, np.zeros(400, int), np.zeros(400, bool))
    blocks = {(a, c) for a, others in ngram_join.walk(size, pos, 8) for c in others}
    assert {(int(a) // 8 * 8, int(b) // 8 * 8) for a, b in zip(x[ok], y[ok], strict=True)} <= blocks
    by_size = {(a, c) for a in range(0, 400, 8) for c in range(a, 400, 8) if 5 * size[a : a + 8].max() >= 4 * size[c]}
    assert blocks < by_size and len(blocks) < 0.8 * len(by_size)


def test_long_lists_stay_bounded(monkeypatch):
    """8,000 equal-sized sets of 8,000 clusters in one list: pairs leave in batches, nothing grows with their number."""
    n, labels = 8_000, np.zeros(1, np.int32)
    entries = next(ngram_join.pack([np.full(n, 77, np.uint64), np.arange(n), np.full(n, 20, np.uint32), np.zeros(n, np.uint32), np.zeros(n, np.int64), np.zeros(n, np.uint32), np.zeros(n, np.uint8)], labels))[1]
    batch = lambda: iter([pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([entries], pa.binary())], names=["bucket", "entries"])])
    off = list(ngram_join._pairs(labels, 1_000)(batch()))
    assert [b.column(3).to_pylist() for b in off] == [[n]] and off[0].nbytes < 10 * n
    biggest = total = 0
    for b in ngram_join._pairs(labels, None)(batch()):
        biggest = max(biggest, b.nbytes)
        total += int(np.frombuffer(b.column(1)[0].as_py()[:4], np.uint32)[0])
    assert total == n * (n - 1) // 2 and biggest < 60_000_000


def test_components(spark):
    rnd = random.Random(3)
    edges = [(k, k + 1) for k in range(0, 60)] + [(rnd.randint(100, 200), rnd.randint(100, 200)) for _ in range(80)]
    find, join = ngram_join._forest(300)
    for a, b in edges:
        join(a, b)
    nodes = {x for e in edges for x in e}
    want = {(x, find(x)) for x in nodes if find(x) != x}
    assert {tuple(r) for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()} == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_quality(odd, none, spark):
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (None, 1, 0), (4, 0, None)], LABELS)
    got = quality.quality_rules(odd, labels).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for i, t in [(r["doc_id"], r["text"]) for r in odd.collect()]:
        w = words(t)
        g = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        rep = {p for k in range(len(w) - 4) if g[tuple(w[k : k + 5])] > 1 for p in range(k, k + 5)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(rep), len(w) < 10 or 100 * len(rep) > 20 * len(w))
        assert want in [tuple(r[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in by[i]]
    assert quality.quality_rules(none, labels).count() == 0
    assert not any(r["kept"] for r in quality.quality_rules(odd, spark.createDataFrame([], LABELS)).collect() if r["base_failed"])
    raw = Counter()
    for r in odd.collect():
        raw.update(quality.grams(np.frombuffer((r["text"] or "").encode(), np.uint8)).tolist())
    assert {k: v for k, v in enumerate(quality.gram_counts(odd.select("text")).tolist()) if v} == dict(raw)


def brute_hits(docs, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {}
    for i, t in items:
        w = cut(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for i, t in docs:
        w = cut(t)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s : s + n])) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[k]
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bound", [(2_000_000, 64_000_000), (40, 0)])
def test_decontamination(odd, none, spark, bound):
    bound = {"broadcast_rows": bound[0], "broadcast_bytes": bound[1]}
    rnd = random.Random(4)
    w = [f"t{rnd.randint(0, 60)}" for _ in range(3000)]
    docs = [(k, " ".join(w[(a := rnd.randint(0, 2900)) : a + rnd.randint(0, 60)]) + ("!É Ab" if k % 3 else "")) for k in range(80)]
    items = [(k, ", ".join(w[(a := rnd.randint(0, 2900)) : a + n]).upper()) for k, n in enumerate([1, 2, 7, 12, 13, 14, 20, 40, 0, 30, 200])] + [(None, " ".join(w[50:90])), (99, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), bench, **bound)
    assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got.collect()], key=repr) == brute_hits(docs, items)
    assert decontaminate.decontaminate(odd, bench, **bound).count() == odd.count()
    assert decontaminate.decontaminate(none, bench, **bound).count() == 0
    assert {r["n_hit"] for r in decontaminate.decontaminate(odd, bench.limit(0), **bound).collect()} == {0}


def test_bpe(odd, none):
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.vocabulary_path("word_bpe_49k.json")
    lib = tokenizers.Tokenizer.from_file(path)
    for r in bpe.encode_decode(odd.join(odd.groupBy("doc_id").count().filter("count = 1").select("doc_id"), "doc_id"), path).join(odd.select("doc_id", "text"), "doc_id").collect():
        e = lib.encode(r["text"] or "", add_special_tokens=False).ids
        assert bytes(r["ids"]) == struct.pack(f"<{len(e)}I", *e) and r["n_tokens"] == len(e)
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(e, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_decode(none, path).count() == 0
    v = bpe.vocabulary(open(path, "rb").read())
    rnd = random.Random(1)
    for t in ["<|endoftext|>a <|startoftext|>", "ΑΣ İ ﬁ é"] + ["".join(rnd.choice("aé'sΣ 日1!\u0085\x1c<|>😀\n") for _ in range(40)) for _ in range(300)]:
        e = lib.encode(t, add_special_tokens=False).ids
        assert v.encode([t])[0] == struct.pack(f"<{len(e)}I", *e), t
    assert v.plain(v.encode(["Hello, wörld 42"])[0]) == "hello , wörld 4 2"


def test_token_counts(odd, spark, tmp_path):
    path = queries.vocabulary_path("byte_bpe_50k.tiktoken")
    counts = token_counts.count_tokens(odd, path, "v1").cache()
    assert counts.filter("text_hash is null").count() == 0 and counts.count() == odd.count()
    ledger = token_counts.Ledger(spark, f"file://{tmp_path}/ledger")
    assert ledger.totals().count() == 0
    assert ledger.commit("a", token_counts.inserts(counts)) and not ledger.commit("a", token_counts.inserts(counts))
    whole = counts.groupBy("source", "lang", "version").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    same = lambda x, y: sorted(map(repr, x.collect())) == sorted(map(repr, y.select(x.columns).collect()))
    assert same(ledger.totals(), whole)
    assert ledger.commit("b", token_counts.revisions(counts, counts.filter("doc_id = 3").select("doc_id", F.lit(7).alias("new_tokens"))))
    assert ledger.commit("c", token_counts.deletes(counts, spark.createDataFrame([(2,), (2,), (777,)], "doc_id long")))
    left = counts.filter("doc_id is null or doc_id <> 2").withColumn("n_tokens", F.when(F.col("doc_id") == 3, 7).otherwise(F.col("n_tokens")))
    assert same(ledger.totals(), left.groupBy("source", "lang", "version").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")))


PAGE = '<html><body><header>Site</header><nav><a href="/">Home</a></nav><div class="cookie-notice">We use</div><div class="wrap"><div class="story-12"><h1>Title &amp; more</h1><p>First   para<br>graph <b>bold</b>er.<p>Second one that is long enough to win the page.</div><div class="sidebar">Side</div><div id="comments"><p>Reader says a very long thing that could win by its mere length, but must not.</p></div></div><form>Mail</form><footer>&copy;</footer><script>x("</p>")</script></body></html>'


def test_html(spark):
    text = "Title & more First para graph bolder. Second one that is long enough to win the page."
    assert html_extract.extract(PAGE, None) == text
    assert [html_extract.extract(x, ">html>body>article") for x in (None, "", "<", "a < b", "<p", "<b>x</b")] == ["", "", "<", "a < b", "", "x"]
    pages = spark.createDataFrame([(1, "http://h.example/1", PAGE, 0), (2, "http://h.example/2", PAGE.replace("story-12", "story-9"), 0), (3, None, "plain words", 0), (4, "x", None, 0), (4, "x", None, 0)], "page_id long, url string, html string, path int")
    for bound in (10, -1):
        assert sorted((r["page_id"], r["text"]) for r in html_extract.extract_main_text(pages, broadcast_hosts=bound).collect()) == [(1, text), (2, text), (3, "plain words"), (4, ""), (4, "")]
    assert [r["path"] for r in html_extract.host_paths(pages).collect()] == [">html>body>div.wrap>div.story-#"]
    assert html_extract.extract_main_text(pages.limit(0)).count() == 0


def test_sharding(odd, none, spark):
    got = [r.asDict() for r in sharding.interleave(odd, shards=4).collect()]
    n = odd.count()
    assert sorted(r["position"] for r in got) == list(range(n))
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(c)) for s, c in sizes.items())
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted((len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in odd.collect())
    assert sharding.interleave(none).count() == 0
    mixed = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"), F.lit("x").alias("text"))
    per = sharding.interleave(mixed, shards=10).filter("source = 'hot'").groupBy("shard").count().collect()
    assert {r["count"] for r in per} <= {99, 100, 101}


def test_language_gradients():
    rng = np.random.default_rng(0)
    net = langid.BiGru(["a", "b", "c"], units=3, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.integers(0, 20, (4, 6)).astype(np.int16)
    x[1, 4:] = langid.PAD
    y, w = np.array([0, 1, 2, 1]), np.ones(4, np.float32)
    _, grad = net.gradients(x, y, w)
    for name, index in (("uf", (2, 1)), ("ub", (7, 2)), ("cf", (1, 0)), ("v", (0, 4)), ("xf", (int(x[0, 2]), 5)), ("xb", (int(x[2, 3]), 1)), ("o", (1, 0))):
        old = net.p[name][index]
        net.p[name][index] = old + 1e-3
        up, _ = net.gradients(x, y, w)
        net.p[name][index] = old - 1e-3
        down, _ = net.gradients(x, y, w)
        net.p[name][index] = old
        assert abs((up - down) / 2e-3 - grad[name][index]) < 2e-3 * max(1, abs(grad[name][index]))


def test_language_id(odd, none, spark):
    docs = spark.createDataFrame([(k, ("the cat and the dog " if k % 2 else "der hund und die katze ") * (1 + k % 5), "en" if k % 2 else "de") for k in range(200)] + [(500, None, "en"), (501, "12 !", "de"), (None, "the dog", "en")], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.language_id(docs).collect()}
    assert got[500]["lang_pred"] == got[501]["lang_pred"] == "und" and got[500]["score"] == 0
    assert np.mean([got[k]["lang_pred"] == ("en" if k % 2 else "de") for k in range(200)]) > 0.97
    assert langid.language_id(none).count() == 0
    assert langid.language_id(odd).count() == odd.count()


def test_toxicity(odd, none, spark, sf):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    assert all(0 <= x <= 1 for x in got.values())
    held = [(got[r["doc_id"]], r["toxic"]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([a > b for a in pos for b in neg]) > 0.7 and np.mean([s >= 0.5 for s in neg]) < 0.05
    assert toxicity.toxicity(none, labels).count() == 0
    assert {r["score"] for r in toxicity.toxicity(odd, spark.createDataFrame([(0, 1, 0), (None, 1, 1)], LABELS)).collect()} == {0.0}


def test_label_model():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.1
    say = lambda right: np.where(rng.random(4000) < right, np.where(y, 1, -1), np.where(y, -1, 1))
    good = [say(0.9) for _ in range(3)]
    echo = np.where(rng.random(4000) < 0.97, good[0], -good[0])  # repeats the first voter, mistakes and all
    v = np.stack([*good, echo, rng.integers(-1, 2, 4000)], axis=1)
    m = toxicity.LabelModel(0.1).fit(v)
    assert [0, 3] in m.groups and m.correlations[0, 3] > 0.8 and abs(m.correlations[0, 1]) < 0.3
    assert np.mean((m.posterior(v) > 0.5) == y) > 0.96 and abs(m.accuracies(v)[1] - 0.9) < 0.04
    alone = np.array([[1, -1, -1, 1, 0]])  # two voices against one and its echo
    assert m.posterior(alone)[0] < 0.2
    # Rows that stand for many weigh as many rows.
    few = np.concatenate([np.flatnonzero(y), np.flatnonzero(~y)[:400]])
    w = np.where(y[few], 1.0, (~y).sum() / 400)
    assert np.mean((toxicity.LabelModel(0.1).fit(v[few], w).posterior(v) > 0.5) == y) > 0.96


def test_hot_and_other_groups_join_alike(spark, none):
    rows = [(k, "hot", 1) for k in range(2_000)] + [(5_000 + k, f"t{k // 2}", 1) for k in range(2_000)] + [(9_000, "alone", 1)]
    counts = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long").withColumn("text_hash", F.xxhash64("text"))
    got = sorted(r["doc_id"] for r in token_counts.later_copies(counts).collect())
    assert got == list(range(1, 2_000)) + list(range(5_001, 7_000, 2))
    assert token_counts.later_copies(counts.limit(0)).count() == 0


@pytest.mark.parametrize("buckets", [1, 4, 9, 400])
def test_buckets_are_dealt_evenly(spark, buckets):
    labels = common.even_labels(spark, buckets)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.createDataFrame([(int(x),) for x in labels], "bucket int")
    dealt = Counter(r["p"] for r in rows.select(F.pmod(F.hash("bucket"), F.lit(n)).alias("p")).collect())
    assert len(set(labels.tolist())) == buckets and labels.min() >= 0 and max(dealt.values()) == -(-buckets // n)
