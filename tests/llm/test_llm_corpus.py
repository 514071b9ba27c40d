"""Cross-tokenizer alignment, suffix-sorted dedup and the filter audit against
brute force and the tokenizer libraries."""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlane.llm import align, audit, suffixes
from martlane.llm.base import importable, table

SF = "/root/testdata/sf0.001"
CLASH = ("id", "body", "key", "chunk", "part", "state", "hash", "n_bytes", "groups_sha256", "kept", "_id")


def frame(spark, rows, schema="doc_id long, text string"):
    importable(spark)
    return spark.createDataFrame(rows, schema)


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASH})


# -- alignment ----------------------------------------------------------------
@pytest.fixture(scope="module")
def pair():
    return align.pair("byte_bpe_50k.json", "piece_bpe_32k.model")


def whole_ids(pair, text):
    return pair.a.encode(f" {text}", add_special_tokens=False).ids, pair.b.encode(text)


def brute_alignment(pair, rows):
    docs, count = [], Counter()
    for i, text in rows:
        shown = f" {text}".encode()
        a, b = whole_ids(pair, text) if text else ([], [])
        if not text or b"".join(pair.a_bytes[k] for k in a) != shown or b"".join(pair.b_bytes[k] for k in b) != shown:
            docs.append((i, None))
            continue
        a_end, b_end = (np.cumsum([len(own[k]) for k in ids]).tolist() for own, ids in ((pair.a_bytes, a), (pair.b_bytes, b)))
        common = sorted(set(a_end) & set(b_end))
        groups = [([], []) for _ in common]
        for side, ids, ends in ((0, a, a_end), (1, b, b_end)):
            for k, e in zip(ids, ends):
                groups[bisect.bisect_left(common, e)][side].append(k)
        links = Counter((x, y) for xs, ys in groups for x in xs for y in ys)
        count.update(links.keys())
        told = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        docs.append((i, (len(a), len(b), len(common), links, hashlib.sha256(told.encode()).hexdigest())))
    best = Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return Counter((i, *((0,) * 6 + ("",) if v is None else (
        *v[:3], sum(v[3].values()), sum(n for p, n in v[3].items() if count[p] == best[p[0]]),
        sum(n * count[p] for p, n in v[3].items()), v[4]))) for i, v in docs)


ODD = ["", None, " ", "  two  spaces ", "a\n\n b\tc\r\n", "x\x1c!y \x1d\x1e", "!\x1c!", " nb sp !　?", "café naïve 漢字 \U0001f600",
       "<|endoftext|> <s> </s><unk> plain", "low▁line", "▁ x", " a\u0085b", "tab\there", "\x00nul", "don't we'll I'M", "a" * 700, "<0x0A>", "\n", "end\n"]


def test_alignment_matches_brute_force(spark, pair, monkeypatch):
    rng = random.Random(5)
    alphabet = "ab E1,.!'\n\t  　\x1cé漢s"
    rows = list(enumerate(ODD)) + [(50 + k, "".join(rng.choices(alphabet, k=rng.randrange(1, 80)))) for k in range(80)]
    rows += [(7, ODD[4]), (None, "no id"), (None, ODD[4])]
    rows += [(r.doc_id + 1000, r.text) for r in table(spark, SF, "documents").collect()]
    # small chunks and parts: many of both, and long texts in several parts
    monkeypatch.setattr(align, "CHUNK_BYTES", 40_000)
    monkeypatch.setattr(align, "PART_BYTES", 3_000)
    got = align.alignment(clashing(frame(spark, rows)))
    assert got.columns == ["doc_id", *align.RESULT]
    assert Counter(tuple(r) for r in got.collect()) == brute_alignment(pair, rows)


def test_segments_encode_as_whole_texts(pair):
    rng = random.Random(9)
    for _ in range(2000):
        text = "".join(rng.choices(" \n\t\r\x0b\x1c\u0085　  !;{a'1é.-▁", k=rng.randrange(1, 30)))
        whole = whole_ids(pair, text)
        a, b, good = pair.encode([pair.segments(f" {text}")])
        if good[0]:
            assert (a[0].as_py(), b[0].as_py()) == whole, repr(text)
        else:
            assert b"".join(pair.b_bytes[k] for k in whole[1]) != f" {text}".encode(), repr(text)


def test_alignment_of_empty_tables_and_one_long_text(spark, pair):
    assert align.alignment(frame(spark, [])).count() == 0
    assert [tuple(r) for r in align.alignment(frame(spark, [(1, None)])).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]
    rows = [(1, "long word " * 300_000), (2, "b" * 200_000)]
    assert Counter(tuple(r) for r in align.alignment(frame(spark, rows)).collect()) == brute_alignment(pair, rows)


# -- suffix dedup -------------------------------------------------------------
def brute_bytes(rows, length=100):
    """By (id, text); null ids first; rows of one id and text are one."""
    order = sorted({(suffixes.NO_ID if i is None else i, t or "") for i, t in rows})
    first = {}
    for k, (_, t) in enumerate(order):
        raw = t.encode()
        for p in range(len(raw) - length + 1):
            first.setdefault(raw[p:p + length], (k, p))
    out = {}
    for k, (i, t) in enumerate(order):
        raw = t.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if first[raw[p:p + length]] < (k, p):
                gone[p:p + length] = b"\1" * length
        spans = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out[i, t] = (len(raw), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(raw, gone) if not g)).hexdigest())
    return out


DIGEST = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def check_bytes(spark, rows, length=100):
    got = suffixes.dedup_bytes(frame(spark, rows), length=length, outputs=(*DIGEST, "removed", "kept"))
    want = brute_bytes(rows, length)
    found = got.collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    for r in found:
        assert tuple(r[c] for c in DIGEST) == want[suffixes.NO_ID if r.doc_id is None else r.doc_id, r.text or ""], r.doc_id
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
    return found


def patchwork(seed, n=60, first=0):
    """Texts made of pieces of few random strings, with noise between."""
    rng = random.Random(seed)
    base = ["".join(rng.choices("ab", k=300)) for _ in range(3)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(4)):
            s, at = rng.choice(base), rng.randrange(250)
            parts += [s[at:at + rng.randrange(90, 260)], "".join(rng.choices("abcé", k=rng.randrange(40)))]
        rows.append((first + i, "".join(parts)))
    return rows


EDGES = [(100, "a" * 500), (101, "ab" * 300), (102, "a" * 350), (103, ""), (104, None), (105, "x" * 99), (106, "x" * 100),
         (107, "x" * 101), (107, "x" * 101), (None, "x" * 130), (None, None), (-5, "é" * 80)]


@pytest.mark.parametrize("hot", [suffixes.HOT, 2])
def test_suffix_dedup_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)  # 2: nearly all windows by hash
    check_bytes(spark, patchwork(1) + EDGES)


def test_suffix_dedup_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 400)
    monkeypatch.setattr(suffixes, "SORT_ROWS", 50)
    check_bytes(spark, patchwork(2) + EDGES)
    check_bytes(spark, patchwork(3, 20) + EDGES, length=40)


def test_suffix_dedup_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    found = check_bytes(spark, rows)
    assert 0 < sum(r.n_removed for r in found) < sum(r.n_bytes for r in found)


def test_suffix_dedup_of_empty_and_clashing_tables(spark):
    assert suffixes.dedup_bytes(frame(spark, [])).count() == 0
    rows = [(1, "y" * 150), (2, "y" * 150)]
    got = suffixes.dedup_bytes(clashing(frame(spark, rows))).orderBy("doc_id").collect()
    assert [(r.n_removed, r.n_bytes, r.removed, bytes(r.kept), r.key, r.body) for r in got] == [
        (149, 150, "1:150", b"y", "x", "x"), (150, 150, "0:150", b"", "x", "x")]


def test_suffix_sort_orders_like_bytes_and_survives_collisions(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab", k=rng.randrange(0, 40))).encode() for _ in range(300)]
    group = np.sort(np.array([rng.randrange(6) for _ in texts]))
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts])
    start = np.concatenate([[0], np.cumsum(size)[:-1]])

    def checked():
        order, common = suffixes.Suffixes(data, start, size).sort(group)
        shown = [(group[k], texts[k]) for k in order]
        assert shown == sorted(shown)
        for k in range(1, len(order)):
            x, y = texts[order[k - 1]], texts[order[k]]
            n = next((m for m, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            assert common[k] == (n if group[order[k]] == group[order[k - 1]] else -1)

    checked()
    monkeypatch.setattr(suffixes.Prefixes, "of", lambda self, start, size: np.zeros(np.broadcast(start, size).shape, np.uint64))
    checked()  # every hash equal: the verification sorts by bytes


# -- audit --------------------------------------------------------------------
def brute_audit(rows, labels):
    good, bad = ({i for i, *q in labels if q[k] == 1} for k in (0, 1))
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    states = Counter()
    for i, t, lang in rows:
        text = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = "".join(f for f, x in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            re.search(r"[#$%&*|]", text), i is not None and least[text] < i)) if x)
        states[lang or "", fails, i is not None and i in good, i is not None and i in bad] += 1
    out = {(p, "".join(o), s): Counter() for p, *_ in states for o in permutations("ABCDE") for s in range(1, 6)}
    shapley = Counter()
    for (p, fails, q, tox), n in states.items():
        for o in permutations("ABCDE"):
            gone = False
            for s, f in enumerate(o, 1):
                row, here = out[p, "".join(o), s], f in fails
                row["redundant"] += n * (here and gone)
                row["unique_fails"] += n * (here and len(fails) == 1)
                if here and not gone:
                    row["removed"] += n
                    row["good_lost"] += n * q
                    row["toxic_lost"] += n * tox
                    shapley[p, f] += n
                gone = gone or here
                row["kept"] += n * (not gone)
    return {(*k, *(v[c] for c in audit.OUTCOMES), shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


LONG = " ".join(f"w{k}" for k in range(30_000))
AUDITED = [(1, None, None), (2, "", ""), (3, LONG, "en"), (4, LONG, "en"), (4, LONG, "en"), (5, LONG, "de"), (None, LONG, "en"),
           (None, LONG, None), (6, "A" * 10 + "b c #", "fr"), (7, "same " * 250, "fr"), (8, "same " * 250, "fr"), (9, "\x1c ", "x y")]
MARKS = [(3, 1, 0), (4, 1, 1), (4, 0, 1), (8, None, 1), (None, 1, 1), (77, 1, 1), (5, 1, None)]


def test_audit_matches_brute_force(spark):
    docs = clashing(frame(spark, AUDITED, "doc_id long, text string, lang string"))
    labels = frame(spark, MARKS, "doc_id long, quality int, toxic int").withColumn("state", F.lit("x"))
    got = audit.audit(docs, labels).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == brute_audit(AUDITED, MARKS)
    assert audit.audit(docs.limit(0), labels).count() == 0
    assert len(audit.audit(docs, labels.limit(0)).collect()) == len(got)


def test_audit_of_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    assert set(map(tuple, audit.audit(docs, labels).collect())) == brute_audit(rows, [tuple(r) for r in labels.collect()])


@pytest.mark.parametrize("width", [8, 13, 64])
def test_packed_fields_do_not_carry(width):
    most = (1 << width) - 1
    numbers = audit.packed(width)
    for state in (0, 1, 31, 37, 127):
        rows = audit.unpacked(most * numbers[state], width)
        assert rows == [[most * x for x in audit.outcomes(state, audit.ORDERS[o], s)] for o, s in audit.STEPS]
