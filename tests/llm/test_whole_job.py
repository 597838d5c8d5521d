"""Whole tables and whole texts, against brute force: nothing is left out by its rarity, place or layout."""

from __future__ import annotations

import hashlib
import math
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from plumbline.llm import html_extract, langid, quality, sharding, token_counts, toxicity

from .test_llm import LABELS


def test_rare_languages_are_learnt(spark):
    rows = [(k, "the cat and the dog ", "en") for k in range(3_000)] + [(k, "der hund und die katze ", "de") for k in range(3_000, 3_400)]
    rows += [(k, "og hundurinn ", "is") for k in range(5_000, 5_006)] + [(k, "ja koira ", "fi") for k in range(6_000, 6_003)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    _, labels, classes, _ = langid.sample(docs, train_rows=100)
    assert classes == ["de", "en", "fi", "is"] and 70 < len(labels) < 130
    assert langid.sample(docs, train_rows=2)[2] == classes
    assert langid.quotas({"en": 10_000_000, "de": 1_000, "is": 3}, 4_000) == {"is": 3, "de": 1_000, "en": 2_997}


def test_layout_words_keep_the_article():
    text = "The whole story in one long sentence."
    page = lambda x: html_extract.extract(f"<html><body>{x}</body></html>", None)
    assert page(f'<div id="page" class="layout-right-sidebar"><article><p>{text}</p></article></div>') == text
    assert page(f'<article class="social-share"><p>{text}</p></article><div class="sidebar">Side</div>') == text
    assert page(f'<section class="notice-layout"><main><p>{text}</p></main></section><p>Home</p>') == text
    assert page(f'<div class="widget-wrap"><p>{text}</p></div><div class="promo">Buy</div>') == text  # by share
    assert page('<div class="alert">One third.</div><div class="notice">Another.</div><div class="promo">And more.</div>') == "One third. Another. And more."  # nothing else is there
    said = "<article>" + "A reader says much. " * 3 + "</article>"
    assert page(f'<div class="wrap"><p>{text * 4}</p><div id="comments">{said}{said}</div></div>') == text * 4
    assert page(f'<div class="wrap"><article><p>{text}</p></article><div class="sidebar"><article>Teaser</article></div></div>') == text


def slots(text):
    """The slot of each 4-gram, in plain integers."""
    b = text.encode()
    return [(sum(x * m for x, m in zip(b[k : k + 4], (1, 2533, 246515, 32773589), strict=True)) * 2654435761 % 2**32) >> 16 for k in range(len(b) - 3)]


def brute_ratio(texts, trusted):
    raw, target = Counter(), Counter()
    for i, t in texts:
        raw.update(slots(t))
        if i in trusted:
            target.update(slots(t))
    n, m = raw.total(), target.total()
    p = lambda s: (raw[s] + 1) / (n + 65_536)
    return lambda s: math.log((target[s] + 65_536 * p(s)) / (m + 65_536)) - math.log(p(s))


@pytest.mark.parametrize("bound", [quality.BROADCAST_IDS if hasattr(quality, "BROADCAST_IDS") else None, 0])
def test_every_trusted_row_counts(spark, monkeypatch, bound):
    if bound is not None:
        monkeypatch.setitem(quality.target_counts.__kwdefaults__, "broadcast_ids", bound)
    texts = [(k, f"{k * 7919 % 10_007} says {k * k % 9_973}") for k in range(7_000)]
    docs = spark.createDataFrame([*texts, (None, "no id"), (7_001, None)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, 1) for k in range(0, 6_400)] + [(3, 1), (6_500, 0), (None, 1), (9_999, 1)], "doc_id int, quality int")
    want = brute_ratio([*texts, (None, "no id")], set(range(6_400)))
    assert np.allclose(quality.fit(docs, labels), [want(s) for s in range(quality.SLOTS)])
    named = quality.fit(docs.withColumn("doc_id", F.col("doc_id").cast("string")), labels.withColumn("doc_id", F.col("doc_id").cast("string")))
    assert np.allclose(named, [want(s) for s in range(quality.SLOTS)])


def test_ratio_alone_rejects_junk(spark):
    rnd = random.Random(3)
    vocab = ["".join(rnd.choice("aeinrstl") for _ in range(rnd.randint(3, 8))) for _ in range(300)]
    good = [" ".join(rnd.choice(vocab) for _ in range(220)) for _ in range(80)]
    junk = [" ".join("".join(rnd.choice("bcdfghjkmpqvwxyz0123456789") for _ in range(6)) for _ in range(160)) for _ in range(12)]
    texts = list(enumerate(good + junk))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for trusted in (set(range(60)), set(range(4))):
        labels = spark.createDataFrame([(k, 1) for k in trusted], "doc_id long, quality int")
        enough = sum(len(slots(good[k])) for k in trusted) >= quality.least_target()
        assert enough == (len(trusted) == 60)
        ratio = brute_ratio(texts, trusted)
        mean = {k: np.mean([ratio(s) for s in slots(t)]) for k, t in texts}
        if enough:
            got = quality.quality_rules(docs, labels).collect()
        else:
            with pytest.warns(UserWarning, match="rejects nothing"):
                got = quality.quality_rules(docs, labels).collect()
        assert not any(r["base_failed"] for r in got)
        assert np.allclose([r["llr"] for r in got], [mean[r["doc_id"]] for r in got])
        assert {r["doc_id"] for r in got if not r["kept"]} == {k for k, x in mean.items() if x < -0.4} == (set(range(80, 92)) if enough else set())
    assert quality.least_target() == 32_233


def brute_terms(text):
    """(kind, bytes) of each word, stem and pair, with how often the text holds it."""
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = regex.findall(rb"[0-9a-z\x80-\xff]+", low)
    out = Counter((0, w) for w in words)
    for kind, stem in enumerate(toxicity.STEMS[1:], 1):
        out.update((kind, w[:stem]) for w in words if len(w) > stem)
    out.update((toxicity.PAIR, a + b" " + b) for a, b in zip(words, words[1:]))
    return out


def test_toxicity_by_brute_force(spark):
    """Mined terms and scores, counted in plain Python over whole texts."""
    rnd = random.Random(4)
    vocab = [f"w{k:03d}word" for k in range(150)]
    say = lambda n: [rnd.choice(vocab) for _ in range(n)]
    rows, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        w = say(rnd.randint(0, 120))
        for _ in range(toxic * rnd.randint(1, 4)):
            w.insert(rnd.randint(0, len(w)), rnd.choice(["Vileword", "nastyish", "idiot"]))
        rows.append((k, " ".join(w) + ("!" if k % 3 else " Ünï")))
        if k % 3:
            labels.append((k, 1, int(toxic)))
    rows += [(500, None), (501, ""), (502, " ".join(say(30_000))), (503, "idiot " * 9), rows[0], (None, "vileword nastyish")]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(labels + labels[:5] + [(None, 1, 1), (0, 1, None)], LABELS)
    s = toxicity.draw(docs, known)
    fold = [(k, t) for k, t in rows if k is not None and zlib.crc32(str(k).encode()) % 5]
    label = {k: y for k, _, y in labels}
    pos, neg = [t for k, t in fold if label.get(k) == 1], [t for k, t in fold if label.get(k) == 0]
    assert ((s.toxic == 1).sum(), (s.toxic == 0).sum(), (s.toxic == -1).sum()) == (len(pos), len(neg), len(fold))
    hashes = lambda kind, text: int(toxicity.term_hashes(toxicity._words(pa.array([text.decode()])))[1][-1 if kind == toxicity.PAIR else 0])
    p = Counter(t for x in pos for t in brute_terms(x))
    for kind, word in [(0, b"vileword"), (0, b"idiot"), (toxicity.PAIR, b"w001word w002word"), (0, b"w003word")]:
        at = np.flatnonzero((s.terms == np.uint64(hashes(kind, word))) & (s.kinds == kind * len(toxicity.LEVELS)))
        assert (s.holds[s.toxic == 1][:, at].sum() if len(at) else None) in (None, p[kind, word])
        assert len(at) or b"w0" in word
    m = toxicity.train(s)
    weight = {int(t): m.weights[:, k] for k, t in enumerate(m.terms)}
    known_terms: dict = {}

    def name(kind, word):
        if (kind, word) not in known_terms:
            text = word + b"zzzz" if 0 < kind < toxicity.PAIR else word
            _, terms, kinds = toxicity.term_hashes(toxicity._words(pa.array([text], pa.binary())))
            known_terms[kind, word] = int(terms[kinds == kind][0])
        return known_terms[kind, word]

    def score(text):
        x = m.bias + sum(weight[name(*t)][k] for t, n in brute_terms(text).items() if name(*t) in weight for k, least in enumerate(toxicity.LEVELS) if n >= least)
        return 1 / (1 + math.exp(-x))

    got = toxicity.score(docs, m).collect()
    text = {k: t for k, t in rows}
    assert all(abs(r["score"] - score(text[r["doc_id"]])) < 1e-9 and r["predicted"] == (r["score"] >= 0.5) for r in got) and len(got) == len(rows)
    right = [(r["predicted"], int(r["doc_id"] % 4 == 0)) for r in got if r["doc_id"] is not None and r["doc_id"] < 400]
    assert np.mean([a == b for a, b in right]) > 0.97
    assert {r["predicted"] for r in got if r["doc_id"] in (500, 501, 502)} == {0}


def test_language_by_brute_force(spark):
    """Each byte for itself through both networks, in plain loops."""
    rng = np.random.default_rng(5)
    net = langid.BiGru(["de", "en", "fr"], units=4, seed=2)
    texts = ["the cat", "", None, "12 ! ²½Ⅷ①", "Größe", "日本語", "x" * 300 + " der hund " * 40, " ".join(str(x) for x in rng.integers(0, 9, 50)) + "a", "the cat"]
    sign = lambda x: x / (1 + np.abs(x))

    def states(d, data):
        h, out, n = np.zeros(4), [], net.units
        for b in data:
            a, g = net.p["x" + d][b].astype(float), net.p["u" + d].astype(float) @ h
            z, r = (0.5 + 0.5 * sign(a[k * n : k * n + n] + g[k * n : k * n + n]) for k in (0, 1))
            new = sign(a[2 * n :] + r * (g[2 * n :] + net.p["c" + d][:, 0]))
            h = (1 - z) * new + z * h
            out.append(h)
        return out

    def label(text):
        if not text or not any(unicodedata.category(c)[0] == "L" for c in text):
            return "und", 0.0
        data, total = text.encode(), np.zeros(3)
        for k in range(0, len(data), langid.WINDOW):
            part = data[k : k + langid.WINDOW]
            for f, b in zip(states("f", part), states("b", part[::-1])[::-1], strict=True):
                y = np.exp(net.p["v"].astype(float) @ np.concatenate([f, b]) + net.p["o"][:, 0])
                total += y / y.sum()
        total /= len(data)
        return net.classes[int(total.argmax())], total.max()

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: r for r in langid.identify(docs, net).collect()}
    for k, t in enumerate(texts):
        pred, score = label(t)
        assert got[k]["lang_pred"] == pred and abs(got[k]["score"] - score) < 1e-3
    flat = langid.BiGru(["aa", "bb"], units=2)
    flat.p = {k: np.zeros_like(v) for k, v in flat.p.items()}
    assert [(r["lang_pred"], r["score"]) for r in langid.identify(docs.filter("doc_id = 0"), flat).collect()] == [("aa", 0.5)]  # a tie


def test_windows_from_all_over_a_text():
    data = np.arange(langid.WINDOW * 40) // langid.WINDOW
    windows, stands_for = langid.spread(data.astype(np.uint8), 8)
    assert len(windows) == 8 and stands_for == 5 and [w[0] // 5 for w in windows] == list(range(8))
    assert langid.spread(data[: langid.WINDOW * 3].astype(np.uint8), 8)[1] == 1.0


def test_commits_that_race(spark, tmp_path, monkeypatch):
    """Of two runs of a batch that are both past the first look, one wins and the other's rows are gone."""
    one, two = token_counts.Ledger(spark, f"file://{tmp_path}/ledger"), token_counts.Ledger(spark, f"file://{tmp_path}/ledger")
    delta = lambda n: spark.createDataFrame([("s", "en", "v", 1, n)], token_counts.DELTA_SCHEMA)
    late = delta(7)
    real = one._publish
    monkeypatch.setattr(one, "_publish", lambda rows, name: (two.commit("b", delta(5)), real(rows, name))[1])
    assert not one.commit("b", late)
    monkeypatch.undo()
    assert [(r["n_docs"], r["n_tokens"]) for r in two.totals().collect()] == [(1, 5)]
    delta(99).write.parquet(f"{tmp_path}/ledger/.pending-lost")  # a run that died before its rename
    assert one.commit("c", delta(3)) and one.commit("none", delta(1).limit(0)) and not one.commit("c", delta(4))
    before = sorted(map(tuple, one.totals().collect()))
    assert one.compact() == 3 and sorted(map(tuple, two.totals().collect())) == before == [("s", "en", "v", 2, 8)]
    assert two.commit("d", delta(2)) and two.compact() == 4
    assert [(r["n_docs"], r["n_tokens"]) for r in one.totals().collect()] == [(3, 10)]
    other = spark.createDataFrame([("s", "en", "w", 1, 4)], token_counts.DELTA_SCHEMA)
    assert one.commit("e", other) and {r["version"]: r["n_tokens"] for r in one.totals().collect()} == {"v": 10, "w": 4}


@pytest.mark.parametrize("apart", [10_000, 7])
def test_order_of_equal_and_nameless_rows(spark, monkeypatch, apart):
    """The whole order by a plain sort; rows with null or equal ids are told apart by their texts."""
    monkeypatch.setattr(sharding, "APART", apart)
    rows = [(None if k % 3 else k, f"t{k % 50}" if k % 2 else "hot", ("a", "b", None)[k % 3]) for k in range(300)] + [(7, None, "a"), (7, "", "a"), (7, "long " * 50_000, "b")]
    want, n = [], len(rows)
    order = lambda i, t: int(hashlib.sha256(f"{sharding.SEED}:{'-' if i is None else i}:{zlib.crc32((t or '').encode())}:{len((t or '').encode()) + 8}".encode()).hexdigest()[:15], 16)
    nulls = lambda x: (x is not None, x if x is not None else 0)
    for source in {s for _, _, s in rows}:
        mine = sorted((order(i, t), nulls(i), zlib.crc32((t or "").encode()), len((t or "").encode()) + 8, i) for i, t, s in rows if s == source)
        want += [((2 * k + 1) / (2 * len(mine)), (source is not None, source or ""), *r) for k, r in enumerate(mine)]
    want.sort(key=lambda r: r[:-1])
    got = sorted(sharding.interleave(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4), shards=5).collect(), key=lambda r: r["position"])
    assert [(r["doc_id"], r["text_crc32"], r["size"]) for r in got] == [(r[-1], r[4], r[5]) for r in want]
    assert [r["shard"] for r in got] == [k * 5 // n for k in range(n)]


def test_deep_and_long_pages():
    """Depth costs no more than length; ties, empty URLs and doubtful names."""
    deep = "<html><body>" + "<font>x " * 30_000
    assert len(html_extract.extract(deep, ">html>body")) == 59_999 and html_extract.votes_of(deep)[0][0] == ">html>body"
    page = lambda x: html_extract.extract(f"<html><body>{x}</body></html>", None)
    assert page("<article>Let <math><mi>x</mi><annotation>x</annotation></math> be.</article>") == "Let x be."
    for name in ("share-price", "side-by-side", "discussion", "related work"):
        assert page(f'<article><p>One long paragraph here, and more.</p><div class="{name}"><p>Main text.</p></div></article>').endswith("Main text.")
    for name in ("ad", "newsletter-box", "comments", "notice", "sidebar left"):
        assert page(f'<article><p>One long paragraph here, and more.</p><div class="{name}"><p>Not this.</p></div></article>').endswith("and more.")
    assert page('<article><p>One long paragraph.</p><div class="share"><a href="x">Post</a> <a href="y">Mail</a></div></article>') == "One long paragraph."
    four = html_extract.Page('<div class="d c b a1"><p>x</p></div><div class="d c b a"><p>y</p></div>')
    assert four.path(1) == ">div.a#.b.c.d" and four.at(">div.a.b.c.d") == {3}


def test_ties_between_paths_and_empty_urls(spark):
    html = '<html><body><div class="a"><p>Same words here.</p></div><div class="b"><p>Same words here.</p></div></body></html>'
    pages = spark.createDataFrame([(1, "http://h/1", html), (2, "", html), (3, None, html), (4, "http://h/2", html)], "page_id long, url string, html string")
    paths = [r["path"] for r in html_extract.host_paths(pages).collect()]
    assert len(paths) == 1 and paths == [r["path"] for r in html_extract.host_paths(pages.repartition(3)).collect()]
    got = {r["page_id"]: r["text"] for r in html_extract.extract_main_text(pages).collect()}
    assert got[1] == got[4] and got[2] == got[3] and all(got.values())
