"""Operator 11: cross-tokenizer alignment, an Arrow-native pipeline.

Two tokenizers cut the same bytes (a space and the text) into tokens A and B.
Byte offsets at which tokens of both end cut them into groups; a token A and
a token B of one group are linked.  In a task, texts are cut into segments
(white space and the word after it; no token of either vocabulary crosses
their borders), encoded with a cache of segments, and become two list columns
of ids.  Lists are flattened with their parent indices, token lengths summed
cumulatively and set back at each parent, and (parent, end offset) of both
sides meet in a hash join: the common ends.  They cut both flat lists into
groups, whose links ``group_by`` counts by document and id pair; the ids of a
large group are counted before they are joined.

A pair's count is the number of documents that hold it.  Documents are dealt
into chunks of about ``CHUNK_BYTES``; a chunk writes its documents, with their
pairs as indices into one sorted list of the chunk's pairs, and that list with
the chunk's own document counts.  Spark adds those counts up by pair, marks
the best of each A id, and sends them back to the chunks, so that what is
shuffled by pair is a row for each pair and chunk, never one for each token.

Defined results: null and empty texts, and texts whose joined token bytes are
not the space and the text, have no tokens (zeros, and '' for the hash).  The
strings of special tokens are plain text.  Every row is a document: repeated
rows each count and each get a result; ids may be null.  Texts longer than
``PART_BYTES`` are worked on in parts cut at segment borders, so memory
follows the longest unbroken segment, and a text above ``CHUNK_BYTES`` is a
chunk of its own.  Equal counts are all best.  An empty table gives no rows.
Only id and text are read, so extra columns never clash.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlane.llm.base import Scratch, written

CHUNK_BYTES, PART_BYTES = 8 << 20, 1 << 20
#: White space that A's pattern takes for such; before it, after anything that
#: is none, a token of A begins.
BLANKS = " \n\t\r\x0b\x0c"
#: Segments kept encoded; beyond it those not met since the last time go.
CACHE_SEGMENTS = 150_000
#: Links of a group up to which they are listed one by one.
LARGE = 256
#: The pattern that byte-level pre-tokenizers cut texts with (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Up to here both libraries agree which characters are letters or digits.
LATIN = "\u024f"
SPACE = "▁"


def file_of(name: str) -> str:
    """Path of a tokenizer's file: ``name`` if that is a path, else looked up
    on the machine that reads it."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


def byte_level() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies write it as:
    printable Latin-1 characters stand for themselves, the other bytes, in
    order, for the characters from U+0100 on (fixed by the format)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """Both tokenizers, with the byte length of every token."""

    def __init__(self, a: str, b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.fast = None  # the same vocabulary in a faster library, for Latin text
        self.b = SentencePieceProcessor(model_file=b)
        to_byte = byte_level()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, k in vocab.items():
            self.a_bytes[k] = bytes(map(to_byte.__getitem__, token)) if all(c in to_byte for c in token) else token.encode()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(SPACE, " ").encode()
                        for k, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.fast = ranked(a, self.a_bytes)
        self.a_len, self.b_len = (pa.array([len(x) for x in own], pa.int32()) for own in (self.a_bytes, self.b_bytes))
        self.a_name, self.b_name = (pa.array([str(k) for k in range(len(own))]) for own in (self.a_bytes, self.b_bytes))
        # B has no word borders: a blank may begin a segment if no piece holds
        # it after another character
        names = map(self.b.id_to_piece, range(self.b.get_piece_size()))
        inner = {x for p in names for x, y in zip(p[1:], p) if (x, y) != (SPACE, SPACE)}
        blanks = "".join(c for c in BLANKS if (SPACE if c == " " else c) not in inner)
        self.segments = re.compile(rf"\s*\S+(?:(?![{re.escape(blanks)}])\s+\S*)*|\s+" if blanks else r"(?s).+").findall
        self.lead = self.b.encode("\n")  # a space and the byte, which no piece joins to what follows
        self.clear()

    def clear(self) -> None:
        self.cache: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.old = self.cache
        self.broken: set[str] = set()  # segments whose token bytes are others

    def learn(self, segments: list[str]) -> None:
        """Encode segments.  B puts a space before what it encodes: it stands
        for the first segment's own; others follow a line feed, taken off again."""
        skip = len(self.lead)
        own: list = [None] * len(segments)
        if self.fast:
            own = [self.fast.encode_ordinary(s) if s.isascii() or max(s) <= LATIN else None for s in segments]
        others = [k for k, x in enumerate(own) if x is None]
        for k, e in zip(others, self.a.encode_batch([segments[k] for k in others], add_special_tokens=False)):
            own[k] = e.ids
        told = [s.encode() for s in segments]
        whole, whole_at = b"".join(told), np.cumsum([0, *map(len, told)])
        bad: set[int] = set()
        for cache, ids, names in ((self.cache[0], own, self.a_bytes),
                                  (self.cache[1], self.b.encode(["\n" + s for s in segments], num_threads=1), self.b_bytes)):
            if names is self.b_bytes:
                ids = [y[skip:] for y in ids]
            flat = list(chain.from_iterable(ids))
            at = list(accumulate(map(len, ids), initial=0))
            raw = np.array(flat, "<i4").tobytes()
            cache.update(zip(segments, [raw[4 * x:4 * y] for x, y in pairwise(at)]))
            shown = list(map(names.__getitem__, flat))
            upto = np.cumsum([0, *map(len, shown)])
            if b"".join(shown) != whole or (upto[at] != whole_at).any():
                bad.update(k for k, (t, x, y) in enumerate(zip(told, at, at[1:])) if b"".join(shown[x:y]) != t)
        self.broken.update(segments[k] for k in bad)

    def encode(self, parts: Sequence[list[str]]) -> tuple[pa.ListArray, pa.ListArray, list[bool]]:
        """List columns of ids A and B of each part (a list of segments), and
        which parts keep their bytes; the others are empty."""
        if len(self.cache[0]) > CACHE_SEGMENTS:
            self.old, self.cache = self.cache, ({}, {})
        new = set().union(*parts).difference(self.cache[0])
        for s in new.intersection(self.old[0]):
            self.cache[0][s], self.cache[1][s] = self.old[0][s], self.old[1][s]
        if new := list(new.difference(self.old[0])):
            self.learn(new)
        good = [not self.broken or self.broken.isdisjoint(p) for p in parts]
        lists = []
        for cache in self.cache:
            ids = [b"".join(map(cache.__getitem__, p)) if ok else b"" for p, ok in zip(parts, good)]
            ends = np.cumsum([0, *map(len, ids)]) // 4
            lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4"))))
        return lists[0], lists[1], good


def ranked(path: str, names: list[bytes]) -> object | None:
    """A tiktoken encoding of the vocabulary at ``path``: it merges the pair of
    least id first, so the file's merges must make ever greater ids."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    single = {names[k]: k for k in vocab.values() if len(names[k]) == 1}
    if made != sorted(set(made)) or len(single) != 256 or len(made) + 256 != len(vocab) or made[0] <= max(single.values()):
        return None
    return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={names[k]: k for k in vocab.values()}, special_tokens={})


@lru_cache(maxsize=2)
def pair(a: str, b: str) -> Pair:
    return Pair(file_of(a), file_of(b))


def ends(lists: pa.ListArray, lengths: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Flat ids, their parents, and (parent << 40) + byte offset of their ends."""
    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    total = pc.cumulative_sum(pc.cast(pc.take(lengths, flat), pa.int64()))
    upto = np.concatenate([[0], np.asarray(total)])  # bytes before each token, and in all
    base = pa.array(upto[np.asarray(lists.offsets)[:-1]])
    inside = pc.subtract(total, pc.take(base, parents))
    return flat, parents, pc.add(pc.shift_left(parents, pa.scalar(40, pa.int64())), inside)


def joined_names(names: pa.Array, flat: pa.Array, cuts: np.ndarray) -> pa.Array:
    """The ids of each group as text, joined by commas."""
    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pc.take(names, flat))
    return pc.binary_join(lists, ",")


def align(own: Pair, parts: Sequence[list[str]]) -> dict[str, np.ndarray | list]:
    """Of each part: n_a, n_b, n_groups, n_links, the text of its groups, and
    whether its bytes are kept; and (part, key, n): links of each id pair."""
    a, b, good = own.encode(parts)
    a_flat, a_of, a_key = ends(a, own.a_len)
    b_flat, _, b_key = ends(b, own.b_len)
    n = len(parts)
    left = pa.table({"key": a_key, "i": pa.array(np.arange(len(a_flat)))})
    right = pa.table({"key": b_key, "j": pa.array(np.arange(len(b_flat)))})
    common = left.join(right, "key", join_type="inner", use_threads=False)
    last_a, last_b = (np.zeros(k, bool) for k in (len(a_flat), len(b_flat)))
    last_a[common["i"].to_numpy()] = True
    last_b[common["j"].to_numpy()] = True
    a_cut, b_cut = (np.concatenate([[0], np.flatnonzero(x) + 1]) for x in (last_a, last_b))
    part_of = np.asarray(a_of)[a_cut[1:] - 1]  # of each group
    n_groups = np.bincount(part_of, minlength=n)
    shown = pc.binary_join_element_wise(joined_names(own.a_name, a_flat, a_cut), joined_names(own.b_name, b_flat, b_cut), "|")
    shown = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_groups)]), pa.int32()), shown), ";")

    # links of a group: its ids A, flattened, each with the parent's list of B;
    # a large group's ids are counted first and joined, as they repeat
    a_size, b_size = np.diff(a_cut), np.diff(b_cut)
    large = a_size * b_size > LARGE
    x, y = np.asarray(a_flat), np.asarray(b_flat)
    a_group = np.repeat(np.arange(len(a_size)), a_size)
    times = np.where(large, 0, b_size)[a_group]
    left = np.repeat(np.arange(len(x)), times)
    inside = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
    bits = len(own.b_len).bit_length(), len(own.a_len).bit_length()
    key = ((part_of[a_group[left]] << bits[1]) + x[left] << bits[0]) + y[b_cut[a_group[left]] + inside]
    pairs = pa.table({"key": key}).group_by("key", use_threads=False).aggregate([([], "count_all")])
    key, times = pairs["key"].to_numpy(), pairs["count_all"].to_numpy()
    if large.any():
        b_group = np.repeat(np.arange(len(b_size)), b_size)

        def members(flat: np.ndarray, group: np.ndarray, name: str) -> pa.Table:
            t = pa.table({"g": group, name: flat.astype(np.int64)}).filter(pa.array(large[group]))
            return t.group_by(["g", name], use_threads=False).aggregate([([], "count_all")]).rename_columns(["g", name, f"n_{name}"])

        links = members(x, a_group, "a").join(members(y, b_group, "b"), "g", join_type="inner", use_threads=False)
        more = ((part_of[links["g"].to_numpy()] << bits[1]) + links["a"].to_numpy() << bits[0]) + links["b"].to_numpy()
        pairs = pa.table({"key": np.concatenate([key, more]),
                          "n": np.concatenate([times, links["n_a"].to_numpy() * links["n_b"].to_numpy()])})
        pairs = pairs.group_by("key", use_threads=False).aggregate([("n", "sum")])
        key, times = pairs["key"].to_numpy(), pairs["n_sum"].to_numpy()
    part, key = key >> sum(bits), key & (1 << sum(bits)) - 1
    key = (key >> bits[0] << 32) + (key & (1 << bits[0]) - 1)
    n_links = np.bincount(part, weights=times, minlength=n).astype(np.int64)
    size = lambda x: np.diff(np.asarray(x.offsets)).astype(np.int64)
    return {"n_a": size(a), "n_b": size(b), "n_groups": n_groups, "n_links": n_links, "shown": shown.to_pylist(),
            "good": good, "part": part, "key": key, "n": times}


class Chunk:
    """Documents of a task up to ``CHUNK_BYTES``."""

    def __init__(self, own: Pair, part_bytes: int) -> None:
        self.own, self.part_bytes, self.ids, self.bytes = own, part_bytes, [], 0
        self.parts, self.part_doc, self.waiting = [], [], 0
        self.sums = {c: [] for c in ("n_a", "n_b", "n_groups", "n_links")}
        self.docs, self.keys, self.times, self.sha, self.bad = [], [], [], [], set()

    def add(self, id: object, text: str | None) -> None:
        doc = len(self.ids)
        self.ids.append(id)
        self.sha.append(None)
        for c in self.sums.values():
            c.append(0)
        part, size = [], 0
        if text and len(text) < self.part_bytes:
            self.take(doc, self.own.segments(f" {text}"), len(text))
            return
        for s in self.own.segments(f" {text}") if text else ():
            part.append(s)
            size += len(s)
            if size >= self.part_bytes:
                self.take(doc, part, size)
                part, size = [], 0
        if part:
            self.take(doc, part, size)

    def take(self, doc: int, part: list[str], size: int) -> None:
        self.parts.append(part)
        self.part_doc.append(doc)
        self.waiting += size
        self.bytes += size
        if self.waiting >= self.part_bytes:
            self.work()

    def work(self) -> None:
        if not self.parts:
            return
        got = align(self.own, self.parts)
        for k, doc in enumerate(self.part_doc):
            if not got["good"][k]:
                self.bad.add(doc)
                continue
            for c, sums in self.sums.items():
                sums[doc] += int(got[c][k])
            self.sha[doc], before = self.sha[doc] or hashlib.sha256(), self.sha[doc]
            self.sha[doc].update(((";" if before else "") + got["shown"][k]).encode())
        self.docs.append(np.array(self.part_doc, np.int64)[got["part"]])
        self.keys.append(got["key"])
        self.times.append(got["n"])
        self.parts, self.part_doc, self.waiting = [], [], 0

    def rows(self, number: int, kind: pa.Schema) -> pa.RecordBatch:
        """A row for each document, with gaps between the numbers of its
        pairs, and a last one with the chunk's pairs."""
        self.work()
        none = [np.zeros(0, np.int64)]
        doc, key, times = (np.concatenate(x or none) for x in (self.docs, self.keys, self.times))
        if self.bad:
            ok = ~np.isin(doc, np.array(sorted(self.bad)))
            doc, key, times = doc[ok], key[ok], times[ok]
        pairs = np.unique(key)
        both = doc * max(1, len(pairs)) + np.searchsorted(pairs, key)  # by document, then pair
        order = np.argsort(both)
        both, times = both[order], times[order]
        new = np.ones(len(both), bool)
        new[1:] = both[1:] != both[:-1]
        at = np.flatnonzero(new)
        times = np.add.reduceat(times, at) if len(at) else times
        doc, index = np.divmod(both[at], max(1, len(pairs)))
        first = np.ones(len(doc), bool)
        first[1:] = doc[1:] != doc[:-1]
        gaps = np.where(first, index, np.diff(index, prepend=0))
        cuts = np.searchsorted(doc, np.arange(len(self.ids) + 1))
        n = len(self.ids)
        sums = {c: [0 if d in self.bad else x for d, x in enumerate(v)] for c, v in self.sums.items()}
        sha = ["" if d in self.bad or h is None else h.hexdigest() for d, h in enumerate(self.sha)]
        tail = np.concatenate([cuts, [cuts[-1]]])  # the last row has no gaps
        lists = lambda x: pa.ListArray.from_arrays(pa.array(tail, pa.int32()), pa.array(x))
        held = np.bincount(index, minlength=len(pairs))
        last = lambda x, t: pa.array([None] * n + [x], pa.list_(t))
        cols = [pa.array([number] * (n + 1), pa.int64()), pa.array([False] * n + [True]),
                pa.concat_arrays([pa.array(self.ids, kind.field("id").type), pa.array([None], kind.field("id").type)]),
                *(pa.array([*sums[c], 0], pa.int64()) for c in self.sums), pa.array([*sha, ""]),
                lists(gaps.astype(np.int32)), lists(times), last((pairs >> 32).astype(np.int32), pa.int32()),
                last((pairs & 0xFFFFFFFF).astype(np.int32), pa.int32()), last(held.astype(np.int32), pa.int32())]
        return pa.RecordBatch.from_arrays(cols, names=FIELDS)


FIELDS = ["chunk", "is_list", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "gaps", "times", "a", "b", "held"]
RESULT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def chunked(docs: DataFrame, a: str, b: str, id: str, text: str) -> DataFrame:
    kind = docs.schema[id].dataType.simpleString()
    schema = (f"chunk long, is_list boolean, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "gaps array<int>, times array<long>, a array<int>, b array<int>, held array<int>")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, chunk, number, kinds = pair(a, b), None, TaskContext.get().partitionId() << 32, None
        for batch in batches:
            kinds = batch.schema
            for k in range(batch.num_rows):
                chunk = chunk or Chunk(own, PART_BYTES)
                chunk.add(batch.column(0)[k].as_py(), batch.column(1)[k].as_py())
                if chunk.bytes >= CHUNK_BYTES:
                    yield chunk.rows(number, kinds)
                    chunk, number = None, number + 1
        if chunk:
            yield chunk.rows(number, kinds)
        own.clear()  # a reused worker keeps the tables, not the segments

    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


def alignment(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model",
              id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``id``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    of every row; ``a`` and ``b`` name the tokenizers' files."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    table = written(spark, chunked(docs, a, b, id, text), "align-chunks")
    pairs = table.where("is_list").select("chunk", F.posexplode(F.arrays_zip("a", "b", "held")).alias("pos", "p")).select(
        "chunk", "pos", "p.*")
    counts = pairs.groupBy("a", "b").agg(F.sum("held").alias("count"))
    best = Window.partitionBy("a")  # no more rows than B has pieces
    counts = scratch.written(counts.withColumn("best", F.col("count") == F.max("count").over(best)), "align-counts")
    known = pairs.drop("held").join(counts.hint("merge"), ["a", "b"]).select(F.col("chunk").alias("of"), "pos", "count", "best")
    known = written(spark, known, "align-known")
    scratch.drop()
    rows = table.where("NOT is_list").select("chunk", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "gaps", "times")
    kind = docs.schema[id].dataType.simpleString()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["pos"].to_numpy())
        count = right["count"].to_numpy()[order]
        is_best = right["best"].to_numpy()[order]
        rows = left.combine_chunks()
        n, gaps = rows.num_rows, rows["gaps"].combine_chunks()
        at = np.asarray(gaps.offsets).astype(np.int64)
        gap = np.asarray(gaps.values).astype(np.int64)[at[0]:at[-1]]
        times = rows["times"].combine_chunks()
        times = np.asarray(times.values)[times.offsets[0].as_py():times.offsets[-1].as_py()]
        at = at - at[0]
        upto = np.concatenate([[0], np.cumsum(gap)])
        index = upto[1:] - np.repeat(upto[at[:-1]], np.diff(at))
        of = np.repeat(np.arange(n), np.diff(at))
        n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(n_best, of, times * is_best[index])
        np.add.at(count_sum, of, times * count[index])
        new = {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
        return pa.table([new[c] if c in new else rows[c] for c in ("id", *RESULT)], names=["id", *RESULT])

    longs = ", ".join(f"{c} long" for c in RESULT[:-1])
    out = rows.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(score, f"id {kind}, {longs}, groups_sha256 string")
    return out.select(F.col("id").alias(id), *RESULT)
