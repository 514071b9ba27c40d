"""Operator 9: BPE encoding and decoding by speculation and verification.

A word's tokens are first guessed by greedy longest match.  The guess is the
merge result exactly if every token is the merge result of its own bytes and
no merge would cross any of its adjacent pairs; both checks are vectorised
over all new words of a batch.  Only the words that fail are merged exactly.

Defined results: null text is the empty text; an empty text has no ids and
decodes to the empty text.  A result column replaces an input column of the
same name; other columns pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from martlane.llm.base import appended, chunks, texts_of, without

END = "</w>"
NO_MERGE = np.int64(1) << 40

# Characters whose class, lower case and normal form every Unicode version
# agrees on; texts made of them take the fast splitter, all others the
# tokenizer file's own normaliser and pre-tokeniser.
LETTERS = "a-zªµºß-öø-ÿœ"
NUMBERS = "0-9²³¹¼-¾"
BLANKS = "\\x20\\x09-\\x0D"
PLAIN = re.compile(
    "[\\x00-\\x1b\\x20-\\x84\\x86-\\x9f¡-ÿŒœŸ–—‘-„…€]*")
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{BLANKS}{LETTERS}{NUMBERS}]+")


def byte_chars() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary:
    printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Codec:
    """Vocabulary, merge tables and word cache of one tokenizer file."""

    CACHE_WORDS = 400_000  # the cache is emptied beyond this; results do not depend on it

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        to_byte = {c: b for b, c in enumerate(byte_chars())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab: dict[str, int] = model["vocab"]
        size = max([*vocab.values(), *special.values()]) + 1
        self.names = np.empty(size, dtype=object)
        self.names[:] = b""
        for s, i in [*vocab.items(), *special.items()]:
            self.names[i] = s.encode()
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for s, i in vocab.items():
            end = s.endswith(END) and len(s) > len(END)
            raw = bytes(to_byte[c] for c in (s[: -len(END)] if end else s))
            (self.final if end else self.inner)[raw] = i
        self.longest, self.longest_final = (max(map(len, x)) for x in (self.inner, self.final))
        # merge tables: parts of a merged token, and the rank it is born with
        self.left = np.arange(size, dtype=np.int64)
        self.right = np.arange(size, dtype=np.int64)
        self.born = np.full(size, -1, dtype=np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.merges[x, y] = rank, z
            self.left[z], self.right[z], self.born[z] = x, y, rank
        codes = np.array([x << 20 | y for x, y in self.merges], dtype=np.int64)
        order = np.argsort(codes)
        self.pair_codes = codes[order]
        self.pair_ranks = np.array([r for r, _ in self.merges.values()], dtype=np.int64)[order]
        self.sound = self._sound()
        self.special = special
        self.split_special = re.compile("|".join(f"({re.escape(s)})" for s in special)) if special else None
        self.tokenizer = Tokenizer.from_file(path)
        self.to_byte = to_byte
        self.cache: dict[str, bytes] = {}

    # -- verification ----------------------------------------------------
    def cross_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a << 20 | b
        at = np.minimum(np.searchsorted(self.pair_codes, code), len(self.pair_codes) - 1)
        return np.where(self.pair_codes[at] == code, self.pair_ranks[at], NO_MERGE)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For each pair: do the merges of its bytes leave it as it is?

        The two sides are taken apart again, the latest merge first.  At each
        step the two symbols that meet at the border must not merge before
        one of them is used up (``limit``).  Equal ranks merge from the left:
        a border merge ties after the left side's merge, before the right's.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), NO_MERGE) if limit is None else limit.astype(np.int64)
        ok = np.ones(len(a), dtype=bool)
        todo = np.arange(len(a))
        while len(todo):
            x, y = a[todo], b[todo]
            fine = self.cross_rank(x, y) >= limit[todo]
            ok[todo[~fine]] = False
            going = fine & (np.maximum(self.born[x], self.born[y]) >= 0)
            todo, x, y = todo[going], x[going], y[going]
            undo_left = self.born[x] > self.born[y]
            limit[todo] = np.where(undo_left, self.born[x], self.born[y] + 1)
            a[todo] = np.where(undo_left, self.right[x], x)
            b[todo] = np.where(undo_left, y, self.left[y])
        return ok

    def _sound(self) -> np.ndarray:
        """Is each token the merge result of its own bytes?"""
        made = np.flatnonzero(self.born >= 0)
        made = made[np.argsort(self.born[made])]
        fine = self.compatible(self.left[made], self.right[made], self.born[made])
        sound = np.ones(len(self.born), dtype=bool)
        for t, f in zip(made.tolist(), fine.tolist()):
            sound[t] = f and sound[self.left[t]] and sound[self.right[t]]
        return sound

    # -- words -----------------------------------------------------------
    def guess(self, word: bytes) -> list[int]:
        """Greedy longest match; the last token carries the word end."""
        out, at, n = [], 0, len(word)
        while True:
            end = self.final.get(word[at:]) if n - at <= self.longest_final else None
            if end is not None:
                out.append(end)
                return out
            for k in range(min(self.longest, n - at - 1), 0, -1):
                t = self.inner.get(word[at:at + k])
                if t is not None:
                    out.append(t)
                    at += k
                    break

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the lowest rank first, equal ranks from the left."""
        ids = [self.inner[word[i:i + 1]] for i in range(len(word) - 1)] + [self.final[word[-1:]]]
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (m := self.merges.get((ids[i], ids[j]))):
                heap.append((m[0], i, ids[i], ids[j], m[1])) if not ready else heapq.heappush(
                    heap, (m[0], i, ids[i], ids[j], m[1]))

        ready = False
        for i in range(len(ids) - 1):
            offer(i)
        heapq.heapify(heap)
        ready = True
        while heap:
            _, i, x, y, z = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j < 0 or ids[j] != y:
                continue
            ids[i], ids[j] = z, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            after[j] = -1
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [t for t in ids if t >= 0]

    def learn(self, words: Sequence[str]) -> int:
        """Put the ids of ``words`` (distinct, new) into the cache; returns
        how many of them needed exact merging."""
        guesses = [self.guess(w.encode()) for w in words]
        sizes = np.fromiter(map(len, guesses), dtype=np.int64, count=len(words))
        flat = np.array([t for g in guesses for t in g], dtype=np.int64)
        word_of = np.repeat(np.arange(len(words)), sizes)
        wrong = np.zeros(len(words), dtype=bool)
        wrong[word_of[~self.sound[flat]]] = True
        inside = word_of[:-1] == word_of[1:]
        a, b = flat[:-1][inside], flat[1:][inside]
        pairs, back = np.unique(a << 20 | b, return_inverse=True)
        fine = self.compatible(pairs >> 20, pairs & ((1 << 20) - 1))[back]
        wrong[word_of[:-1][inside][~fine]] = True
        ids = flat.astype("<u4").tobytes()
        ends = np.cumsum(sizes) * 4
        for w, e, n, bad in zip(words, ends.tolist(), sizes.tolist(), wrong.tolist()):
            self.cache[w] = np.array(self.merge(w.encode()), dtype="<u4").tobytes() if bad else ids[e - 4 * n:e]
        return int(wrong.sum())

    # -- texts -----------------------------------------------------------
    def pieces(self, text: str) -> list[str]:
        if text.isascii() and not re.search("[\x1c-\x1f]", text) or PLAIN.fullmatch(text):
            return PIECES.findall(text.lower())
        shown = self.tokenizer.normalizer.normalize_str(text)
        return [bytes(map(self.to_byte.__getitem__, p)).decode()
                for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(shown)]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts: list[list] = []  # of each text: lists of words, or the bytes of a special token
        for t in texts:
            if self.split_special and "<|" in t:
                own, at = [], 0
                for m in self.split_special.finditer(t):
                    own += [self.pieces(t[at:m.start()]), np.uint32(self.special[m[0]]).tobytes()]
                    at = m.end()
                parts.append([*own, self.pieces(t[at:])])
            else:
                parts.append([self.pieces(t)])
        if len(self.cache) > self.CACHE_WORDS:
            self.cache.clear()
        words = {w for own in parts for p in own if isinstance(p, list) for w in p}
        if new := [w for w in words if w not in self.cache]:
            self.learn(new)
        look = self.cache.__getitem__
        return [b"".join(p if isinstance(p, bytes) else b"".join(map(look, p)) for p in own) for own in parts]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text: the file has no decoder, so token names
        are joined by spaces."""
        return b" ".join(self.names[np.frombuffer(ids, dtype="<u4")].tolist())


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


FIELDS = {
    "ids": T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
    "decoded": T.StructField("decoded", T.StringType(), False),
    "n_tokens": T.StructField("n_tokens", T.LongType(), False),
    "ids_sha256": T.StructField("ids_sha256", T.StringType(), False),
    "decoded_sha256": T.StructField("decoded_sha256", T.StringType(), False),
}


def bpe(docs: DataFrame, path: str, outputs: Sequence[str] = ("ids", "decoded", "n_tokens"),
        text: str = "text") -> DataFrame:
    """Encode ``text`` and decode the ids again; adds the columns ``outputs``
    (see ``FIELDS``) to every row."""
    new = [FIELDS[o] for o in outputs]
    schema = appended(docs.schema, new)
    decodes = bool({"decoded", "decoded_sha256"} & set(outputs))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in chunks(batches):
            ids = c.encode(texts_of(b.column(text)))
            out = {"n_tokens": lambda: pa.array([len(x) // 4 for x in ids], pa.int64())}
            if decodes:
                shown = [c.decode(x) for x in ids]
                out["decoded"] = lambda: pa.array([x.decode() for x in shown], pa.string())
                out["decoded_sha256"] = lambda: pa.array([hashlib.sha256(x).hexdigest() for x in shown], pa.string())
            out["ids_sha256"] = lambda: pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())
            out["ids"] = lambda: pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]), pa.int32()),
                pa.array(np.frombuffer(b"".join(ids), dtype="<i4"), pa.int32()))
            arrays, names = without(b, outputs)
            yield pa.RecordBatch.from_arrays([*arrays, *(out[o]() for o in outputs)], names=[*names, *outputs])
        c.cache.clear()  # a reused worker keeps the tables, not the words

    return docs.mapInArrow(run, schema)
