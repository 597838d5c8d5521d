"""BPE encoding and decoding by prefix-sharing trie traversal.

The encoding of a symbol sequence is fixed by its last token t: what stands before t is the
encoding of the rest.  So a trie node needs one token, its last, and a node's last token is the one
vocabulary entry that ends there and that BPE leaves next to the last token of the node before it.
Distinct words are sorted, which walks their trie depth first without building it: the states of the
prefix shared with the word before stay on the stack, so every shared prefix is worked out once.

Whether BPE leaves two tokens next to each other is found by undoing their merges, the latest
first, and asking at each step whether a merge across the border would have come earlier.

Vocabularies are files of the `tokenizers` library (BPE, optional end-of-word suffix, byte-level
alphabet); the path is a parameter, the content goes to executors with the task, models are kept
by each Python worker.  Normalisation, cutting and special tokens follow the file; a vocabulary
with other steps than those known here is refused rather than encoded differently.

Edge cases: a null text counts as empty, and an empty text has no tokens; special tokens that occur
in a text get their ids; repeated rows get equal results; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle
from .textvec import steps

#: Bounds of what a Python worker keeps between steps; beyond them it starts anew.
KEEP_WORDS = 150_000
KEEP_PAIRS = 300_000
STEP_BYTES = 2_000_000


def _byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    out = [""] * 256
    for b in plain:
        out[b] = chr(b)
    for k, b in enumerate(rest):
        out[b] = chr(256 + k)
    return out


class Vocabulary:
    """A vocabulary file, read."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges") or spec.get("decoder"):
            raise ValueError("this kind of vocabulary is not supported")
        self.suffix = model.get("end_of_word_suffix") or ""
        self._cutting(spec)
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

        # Internal numbers: symbols first, then the merges in order.
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made = {a + b for a, b in merges}
        symbols = [t for t in ids if t not in made]
        self.base = len(symbols)
        number = {t: k for k, t in enumerate(symbols)}
        for k, (a, b) in enumerate(merges):
            if number.setdefault(a + b, self.base + k) != self.base + k:
                raise ValueError("two merges make one token")
        self.n = self.base + len(merges)
        self.left = [*range(self.base), *(number[a] for a, _ in merges)]
        self.right = [*range(self.base), *(number[b] for _, b in merges)]
        self.join = {number[a] * self.n + number[b]: self.base + k for k, (a, b) in enumerate(merges)}
        self.outer = np.zeros(self.n, dtype=np.uint32)
        back = {c: chr(b) for b, c in enumerate(_byte_alphabet())}
        self.inner: dict[str, int] = {}  # tokens inside a word and at its end, as one character a byte
        self.last: dict[str, int] = {}
        self.size = [0] * self.n
        for t, k in number.items():
            self.outer[k] = ids[t]
            ends = bool(self.suffix) and t.endswith(self.suffix)
            plain = "".join(back.get(c, c) for c in (t[: -len(self.suffix)] if ends else t))
            (self.last if ends else self.inner)[plain] = k
            self.size[k] = len(plain)
        if not self.suffix:
            self.last = self.inner
        self.longest = max(self.size)
        self.token = {v: k.encode() for k, v in (ids | self.special).items()}
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.spelt: dict[bytes, bytes] = {}

    def _cutting(self, spec: dict) -> None:
        norm = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
        pre = spec.get("pre_tokenizer") or {}
        kinds = [x["type"] for x in norm.get("normalizers", [norm])]
        cuts = pre.get("pretokenizers", [pre])
        if kinds != ["NFC", "Replace", "Lowercase"] or [c.get("type") for c in cuts] != ["Split", "ByteLevel"] or not cuts[0]["invert"] or cuts[0]["behavior"] != "Removed" or cuts[1]["add_prefix_space"] or cuts[1]["use_regex"]:
            raise ValueError("these steps before the model are not supported")
        pattern = cuts[0]["pattern"]["Regex"]
        # White space never enters a word, so turning runs of it into one blank changes nothing.
        self.cut = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.ascii_cut = re.compile(pattern.replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]").replace(r"\s\p{L}\p{N}", "\\t-\\r a-z0-9"))

    def cut_words(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        if text.isascii():
            return self.ascii_cut.findall(text.lower())
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return self.cut.findall(text.replace("Σ", "σ").lower())  # each character for itself: no final sigma

    def fits(self, x: int, y: int) -> bool:
        """Whether BPE leaves x and y next to each other."""
        key = x * self.n + y
        known = self.pairs.get(key)
        if known is not None:
            return known
        join, base, bound, ok = self.join, self.base, self.n, None
        while ok is None:
            m = join.get(x * self.n + y)
            if m is not None and m < bound:
                ok = False  # this merge would have come before the last one that was undone
            elif x > y:
                if x < base:
                    ok = True
                else:
                    bound, x = x, self.right[x]
            elif y < base:
                ok = True
            else:
                bound, y = y + 1, self.left[y]
        if len(self.pairs) >= KEEP_PAIRS:
            self.pairs.clear()
        self.pairs[key] = ok
        return ok

    def _ending(self, word: str, d: int, state: list[int], table: dict[str, int]) -> int:
        """The last token of the first d symbols of a word."""
        for j in range(max(0, d - self.longest), d):
            t = table.get(word[j:d])
            if t is not None and (j == 0 or self.fits(state[j], t)):
                return t
        raise ValueError(f"no token ends at {d} of {word!r}")

    def encode_words(self, words: set[str]) -> dict[str, bytes]:
        """The ids of each word, as little-endian 32-bit integers, by one walk through their trie."""
        out: dict[str, bytes] = {}
        spelled = sorted((w.encode("utf-8").decode("latin-1"), w) for w in words)
        state: list[int] = [0]  # state[d]: last token of the first d symbols of the path
        before = ""
        for spell, word in spelled:
            limit = min(len(before), len(spell), len(state) - 1)
            d = 0
            while d < limit and before[d] == spell[d]:
                d += 1
            del state[d + 1 :]
            for k in range(d + 1, len(spell)):
                state.append(self._ending(spell, k, state, self.inner))
            t = self._ending(spell, len(spell), state, self.last)
            found, at = [t], len(spell) - self.size[t]
            while at:
                t = state[at]
                found.append(t)
                at -= self.size[t]
            out[word] = self.outer[found[::-1]].tobytes()
            before = spell
        return out

    def cut_text(self, text: str | None) -> list[str | np.uint32]:
        """Words of a text, and the ids of special tokens between them."""
        if not text or self.special_cut is None or "<|" not in text or not self.special_cut.search(text):
            return self.cut_words(text) if text else []
        parts: list = []
        for k, piece in enumerate(self.special_cut.split(text)):
            parts += [np.uint32(self.special[piece])] if k % 2 else self.cut_words(piece)
        return parts

    def encode_parts(self, texts: list[str | None]) -> list[list[bytes]]:
        """The ids of each word of each text, as little-endian 32-bit integers."""
        cut = [self.cut_text(t) for t in texts]
        distinct = set().union(*cut)
        special = {w for w in distinct if w.__class__ is not str}
        new = {w for w in distinct if w not in self.words and w not in special}
        if len(self.words) + len(new) > KEEP_WORDS:
            self.words.clear()
            self.spelt.clear()
            new = distinct - special
        self.words |= self.encode_words(new)
        get = self.words.__getitem__
        if not special:
            return [list(map(get, ws)) for ws in cut]
        return [[get(w) if w.__class__ is str else w.tobytes() for w in ws] for ws in cut]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit integers."""
        return [b"".join(parts) for parts in self.encode_parts(texts)]

    def decode(self, ids: bytes) -> bytes:
        """The tokens' own strings joined by blanks, as files without a decoder are decoded, in UTF-8."""
        token = self.token
        return b" ".join([token[i] for i in np.frombuffer(ids, "<u4").tolist() if i in token])

    def decode_parts(self, parts: list[bytes]) -> bytes:
        """decode() of ids that come in pieces; a piece that was seen before isn't decoded again."""
        spelt = self.spelt
        for ids in parts:
            if ids not in spelt:
                spelt[ids] = self.decode(ids)
        return b" ".join(map(spelt.__getitem__, parts))

    def plain(self, ids: bytes) -> str:
        """Readable text: bytes put together again, a blank where a word ended."""
        back = {c: b for b, c in enumerate(_byte_alphabet())}
        words = "".join(self.token[i].decode() for i in np.frombuffer(ids, "<u4").tolist()).split(self.suffix) if self.suffix else [self.decode(ids).decode()]
        return " ".join(bytes(back[c] for c in w if c in back).decode("utf-8", "replace") for w in words).strip()


_models: dict[str, Vocabulary] = {}


def vocabulary(content: bytes) -> Vocabulary:
    """The vocabulary of a file's content; read once by each Python worker."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _models:
        _models.clear()
        _models[key] = Vocabulary(content)
    return _models[key]


def encode_decode(docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (little-endian uint32) and the digests of ids and decoded text.

    Other columns of docs come first if they are asked for by selecting them before; names that the
    result needs are taken from the operator.
    """
    with open(path, "rb") as f:  # on the driver: the content travels with the task
        content = f.read()
    names = ["doc_id", "n_tokens", *(["ids"] if with_ids else []), "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(content)
        for batch in batches:
            for a, b in steps(batch.column(1), STEP_BYTES):
                part = batch.slice(a, b - a)
                parts = v.encode_parts(part.column(1).to_pylist())
                ids = [b"".join(x) for x in parts]
                columns = [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64())]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary()))
                columns += [pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array([hashlib.sha256(v.decode_parts(x)).hexdigest() for x in parts])]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        v.words.clear()
        v.spelt.clear()
        settle()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, " + ("ids binary, " if with_ids else "") + "ids_sha256 string, decoded_sha256 string")
