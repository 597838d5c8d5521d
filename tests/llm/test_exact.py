"""Equality isn't fooled by texts of a regular make, nor by hashes that meet."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import ngram_join, quality, substring_dedup
from plumbline.llm.textvec import SEEDS, U, Words, spans_equal, windows

from .test_llm import brute_components, brute_substring


def thue_morse(n: int, a: str = "a", b: str = "b") -> str:
    """Two such strings, letters swapped, have equal polynomial hashes modulo 2**64 whatever the odd base."""
    return "".join((a, b)[k.bit_count() & 1] for k in range(n))


@pytest.fixture(scope="module", params=[1024, 2048])
def twins(request):
    return thue_morse(request.param), thue_morse(request.param, "b", "a")


def test_removal_and_links_compare_words(spark, twins):
    one, two = twins
    say = [f"w{k}" for k in range(60)]
    texts = [one, two, " ".join([*say[:25], one, *say[25:]]), " ".join([*say[:25], two, *say[25:]]), " ".join([*say[:25], one, *say[25:]]), thue_morse(512, "x ", "y "), thue_morse(512, "y ", "x ")]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = substring_dedup.substring_dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute_substring(rows)
    assert sorted(map(tuple, ngram_join.jaccard_components(docs).collect()), key=repr) == brute_components(rows)


def test_lines_and_windows_compare_bytes(twins):
    one, two = twins
    texts = [f"{one}\n{two}\n{one}", f"{one} p q r s {two} p q r s t", f"{one} p q r s {one} p q r s t", f"{one} x\n\n{one}  x\n{one} x"]
    m = quality.measures(pa.array(texts), np.zeros(quality.SLOTS))
    assert list(zip(m["n_dup_lines"], m["n_repeat_words"], strict=True)) == [quality.repeats_by_hand(t.encode()) for t in texts] == [(1, 0), (0, 0), (0, 10), (1, 0)]


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_texts_whose_hashes_meet_are_counted_by_hand(monkeypatch, bits):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(["a", "b", "cc", "ddd", " ", " ", "\n"]) for _ in range(rnd.randrange(90))) for _ in range(200)]
    real = Words.span_hashes
    monkeypatch.setattr(Words, "span_hashes", lambda self, a, b, seed=SEEDS[0]: real(self, a, b, seed) & U(bits))
    m = quality.measures(pa.array(texts), np.zeros(quality.SLOTS))
    assert list(zip(m["n_dup_lines"], m["n_repeat_words"], strict=True)) == [quality.repeats_by_hand(t.encode()) for t in texts]


def test_windows_depend_on_their_words_alone():
    h = np.arange(200, dtype=np.uint64) * U(7919)
    for k in (1, 2, 5, 13, 20, 50, 63, 64, 200, 201):
        w = windows(h, k)
        assert len(w) == len(set(w.tolist())) == max(0, 201 - k)
        assert k > 190 or windows(h[10 : 10 + k], k)[0] == w[10]
    data = np.frombuffer(b"abcabdab", np.uint8)
    assert spans_equal(data, np.array([0, 0, 0]), np.array([3, 3, 6]), np.array([2, 3, 2])).tolist() == [True, False, True]


def test_a_score_depends_on_its_text_alone(spark):
    """Sums are integers, so neither neighbours nor partitions change a score; one that equals the threshold is kept."""
    rnd = random.Random(2)
    texts = [(k, " ".join(rnd.choice("lorem ipsum dolor sit amet zq9 x7#".split()) for _ in range(rnd.randint(10, 60)))) for k in range(300)]
    docs = spark.createDataFrame([*texts, *texts], "doc_id long, text string")
    ratio = np.random.default_rng(3).normal(-0.4, 1, quality.SLOTS)
    runs = [sorted((r["doc_id"], r["llr"]) for r in quality.judge(docs.repartition(n), ratio).collect()) for n in (1, 2, 7)]
    assert runs[0] == runs[1] == runs[2] and len(set(runs[0])) == 300
    edge = dict(runs[0])[5]
    assert [r["llr"] >= edge for r in quality.judge(docs.filter("doc_id = 5"), ratio, threshold=edge).collect()] == [True, True]
    assert {r["kept"] for r in quality.judge(docs.filter("doc_id = 5"), ratio, threshold=edge).collect()} == {not quality.repeats_by_hand(texts[5][1].encode())[1] * 5 > len(texts[5][1].split())}
