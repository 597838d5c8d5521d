"""The pipeline against brute force, stage by stage, on a small corpus."""

from __future__ import annotations

import hashlib
import random
import struct

import tokenizers

import corpus_pipeline
from plumbline.llm import quality, queries

from .test_llm import brute_components, brute_hits, words
from .test_whole_job import brute_ratio, slots


def brute_quality(rows, trusted):
    """ids that the base rules and the log ratio keep, without the operator."""
    ratio = brute_ratio([(i, t or "") for i, t in rows], trusted)
    kept = set()
    for i, t in rows:
        n, repeated = len(words(t)), quality.repeats_by_hand((t or "").encode())[1]
        s = slots(t or "")
        if n >= 10 and 100 * repeated <= 20 * n and (sum(map(ratio, s)) / len(s) if s else 0) >= quality.THRESHOLD:
            kept.add(i)
    return kept


def test_pipeline(spark, tmp_path):
    rnd = random.Random(9)
    vocab = [f"word{k}" for k in range(900)]
    say = lambda n: [rnd.choice(vocab) for _ in range(n)]
    passage, item = say(70), say(30)
    texts = [" ".join(say(rnd.randint(120, 300))) for _ in range(40)]
    texts += [texts[0], texts[1] + " tail", " ".join(say(20) + passage + say(30)), "\n".join(say(40) + passage), " ".join(say(60) + item), " ".join(item), "too short", "", None, "again " * 60, " ".join(say(25_000))]
    texts += [" ".join("".join(rnd.choice("QXZ0123456789#") for _ in range(7)) for _ in range(60)) for _ in range(3)]  # junk that only the ratio tells
    rows = [(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [(7, " ".join(item)), (8, " ".join(say(40)))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept = brute_quality(list(enumerate(texts)), set(range(40)))
    assert not kept & set(range(len(texts) - 3, len(texts))) and len(texts) - 4 in kept
    left = [(k, t) for k, t in enumerate(texts) if k in kept]
    roots = {i: c for i, _, c in brute_components(left)}
    left = [(i, words(t)) for i, t in left if roots[i] == i]
    least = {}
    for i, w in left:
        for s in range(len(w) - 49):
            least.setdefault(tuple(w[s : s + 50]), i)
    cut = []
    for i, w in left:
        gone = {p for s in range(len(w) - 49) if least[tuple(w[s : s + 50])] < i for p in range(s, s + 50)}
        cut.append((i, " ".join(x for p, x in enumerate(w) if p not in gone)))
    dirty = {i for i, n, hit, _ in brute_hits(cut, items) if hit and 20 * hit >= n}
    lib = tokenizers.Tokenizer.from_file(queries.vocabulary_path("word_bpe_49k.json"))
    want = {}
    for i, t in cut:
        if i not in dirty:
            e = lib.encode(t, add_special_tokens=False).ids
            want[i] = (len(e), hashlib.sha256(struct.pack(f"<{len(e)}I", *e)).hexdigest())
    assert dirty, (sorted(kept), [i for i, _ in left], brute_hits(cut, items)[-6:])
    assert len(want) < len(cut) < len(kept) < len(texts)
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == want


def test_odd_tables(spark, tmp_path):
    """Empty tables, repeated ids and rows, extra columns with clashing names; the same result however rows are dealt."""
    rnd = random.Random(11)
    vocab = [f"word{k}" for k in range(500)]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    texts = [say(60) for _ in range(12)]
    rows = [(k, t, "en", "s", len(t), 1, 2, "x") for k, t in enumerate(texts)]
    rows += [rows[3], (4, texts[5] + " tail", "de", "s", 1, 1, 2, "y"), (4, say(70), "fr", "s", 1, 1, 2, "z"), (None, say(50), None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, bucket int, part int, text_hash string"
    found = []
    for name, data, parts in (("a", rows, 1), ("b", rows[::-1], 4), ("none", [], 1)):
        spark.createDataFrame(data, schema).repartition(parts).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(k, 1, 0) for k in range(12)] if data else [], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        found.append(sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()), key=repr))
    assert found[0] == found[1] and found[2] == []
    ids = [i for i, _, _ in found[0]]
    assert ids.count(3) == 1 and ids.count(4) == 1 and 5 not in ids and ids.count(None) == 1 and set(range(4)) < set(ids)
    docs = spark.read.parquet(f"{tmp_path}/a/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, f"{tmp_path}/a").schema.names == docs.columns, name
