"""Operators across rows against brute force: chat, line dedup, mixing,
SimHash, context-tree weighting, forest search."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from martlane.llm import ann, chat, ctw, linededup, mixing, simhash
from martlane.llm.base import crc_mod, importable

SCHEMA = "doc_id long, text string, source string, id string, key string, body string, bucket string, n_lines string"


def docs(spark, rows):
    importable(spark)
    return spark.createDataFrame([(i, t, s, "x", "x", "x", "x", "x") for i, t, s in rows], SCHEMA)


# -- SimHash -----------------------------------------------------------------
def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_fingerprint(text):
    w = words(text)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, ids, bits):
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                root[find(b)] = find(a)
    least = defaultdict(list)
    for f, i in zip(fps, ids):
        if i is not None:
            least[find(f)].append(i)
    return [min(least[find(f)], default=None) for f in fps]


@pytest.mark.parametrize("bits", [0, 1, 2, 5])
def test_simhash_matches_brute_force(spark, bits):
    rnd = random.Random(1)
    vocab = [f"W{i}" for i in range(400)]
    rows = [(None, None, "a"), (1, "", "a"), (2, " \n", "b"), (3, "one", "a"), (3, "one", "a"), (4, "One two", "c"), (5, "x " * 30000, "a")]
    for g in range(25):
        base = rnd.choices(vocab, k=rnd.choice([20, 200, 800]))
        for _ in range(rnd.choice([1, 2, 6])):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 2])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((len(rows) * 7 % 1000 + 10, " ".join(w), None))
    got = simhash.near_duplicates(docs(spark, rows), max_bits=bits).collect()
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    comps = brute_components(fps, [i for i, _, _ in rows], bits)
    want = Counter((i, f"{f:016x}", c) for (i, _, _), f, c in zip(rows, fps, comps))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_links_connect_what_brute_force_connects(spark):
    rnd = random.Random(2)
    fps = {0, -1}
    for _ in range(12):
        f = rnd.getrandbits(64)
        for _ in range(20):
            f ^= 1 << rnd.randrange(64)
            fps.add(f - (1 << 64) if f >> 63 else f)
    fps = sorted(fps)
    importable(spark)
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2)
    roots = {r.node: r.root for r in simhash.components(spark, edges).collect()}
    mask = (1 << 64) - 1
    want = brute_components([f & mask for f in fps], list(range(len(fps))), 2)
    groups = defaultdict(set)
    for f, c in zip(fps, want):
        groups[c].add(f)
    for members in groups.values():
        assert {roots.get(f, f) for f in members} == {min(members)}


@pytest.mark.parametrize("bits", range(1, 9))
def test_links_are_all_pairs_within_the_distance(spark, bits, monkeypatch):
    # values shared by many: a cube, chains, ends of the range; few members a key, so keys are refined
    size, bucket = (8, 5) if bits <= 3 else (6, 25)
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rnd = random.Random(bits)
    at = rnd.sample(range(64), size)
    base = rnd.getrandbits(64)
    fps = {0, (1 << 64) - 1, 1 << 63, 1}
    fps |= {base ^ sum((k >> i & 1) << b for i, b in enumerate(at)) for k in range(1 << size)}
    for _ in range(40):
        f = rnd.getrandbits(64)
        for _ in range(6):
            fps.add(f)
            f ^= sum(1 << b for b in rnd.sample(range(64), rnd.choice([1, bits, bits + 1])))
    fps = sorted(simhash.signed(f) for f in fps)
    got = [(r.a, r.b) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), bits).collect()]
    want = {(a, b) for a in fps for b in fps if a > b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= bits}
    assert set(got) == want


def test_links_of_no_distance_and_too_much(spark):
    one = spark.createDataFrame([(1,), (3,)], "fp long")
    assert simhash.links(one, 0).count() == 0
    assert simhash.links(one.where("fp < 0"), 2).count() == 0
    for bits in (-1, 9):
        with pytest.raises(ValueError):
            simhash.links(one, bits)


@pytest.mark.parametrize("bits", range(1, 9))
def test_segments_leave_one_that_differs_little(bits):
    # what the search rests on, checked on every way that differing bits can fall on segments
    count = max(2, (bits + 2) // 2)
    for mask in (0, (1 << 32) - 1, (1 << 61) - 1, (1 << 64) - 2):
        runs = simhash.segments(mask, count)
        assert sorted(b for run in runs for b in run) == [b for b in range(64) if not mask >> b & 1]
        for total in range(bits + 1):
            for left in range(total, bits + 1):
                q, r = divmod(left, len(runs))
                radius = [min(len(run), q - (i > r)) for i, run in enumerate(runs)]
                assert max(radius) <= 1
                for split in itertools.product(*[range(min(total, len(run)) + 1) for run in runs]):
                    assert sum(split) != total or any(d <= x for d, x in zip(split, radius))


def test_one_of_each_group_stays(spark):
    rows = [(5, "a b c", "s"), (2, "A b c", "s"), (2, "A b c", "s"), (9, "other words here now", "s"), (None, "a b c", "s"),
            (None, "only null here", "s"), (7, None, "s"), (8, "", "s")]
    kept = simhash.keep_one(docs(spark, rows))
    assert kept.columns == docs(spark, []).columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect() if r.doc_id != 7) == [
        (0, "only null here"), (2, "A b c"), (9, "other words here now")]
    assert simhash.keep_one(docs(spark, rows[:5])).where("doc_id is null").count() == 0


def test_one_of_each_nameless_group_stays(spark):
    rows = [(2, "A b c", "s"), (None, "only null here", "s"), (None, None, "t")]
    rows += [(None, t, "s") for t in ("a b c", "ONLY null here", "only  null here", "another null text of words") for _ in range(40)]
    kept = simhash.keep_one(docs(spark, rows)).collect()
    assert sorted((r.doc_id or 0, " ".join(words(r.text))) for r in kept) == [
        (0, ""), (0, "another null text of words"), (0, "only null here"), (2, "a b c")]
    assert {r.source for r in kept if r.text is None} == {"t"}


def test_simhash_on_an_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.keep_one(docs(spark, [])).count() == 0


# -- line dedup --------------------------------------------------------------
def brute_dedup(rows, min_words):
    """Removed line numbers: lines in a run of ``min_words`` words that
    occurs at an earlier (document, line)."""
    def order(k):
        i, t, _ = rows[k]
        return (i is not None, i if i is not None else 0)

    lines = []
    for i, t, _ in rows:
        own = [(n, " ".join(words(x)), len(words(x))) for n, x in enumerate((t or "").split("\n")) if words(x)]
        lines.append(own)
    seen = {}
    ranges = []
    for k, own in enumerate(lines):
        for s in range(len(own)):
            for e in range(s, len(own)):
                if sum(w for _, _, w in own[s:e + 1]) >= min_words:
                    key = tuple(x for _, x, _ in own[s:e + 1])
                    at = (order(k), s)
                    seen[key] = min(seen.get(key, at), at)
                    ranges.append((key, at, k, s, e))
    gone = defaultdict(set)
    for key, at, k, s, e in ranges:
        if seen[key] != at:
            gone[k] |= {n for n, _, _ in lines[k][s:e + 1]}
    return gone


def test_line_dedup_matches_brute_force(spark):
    rnd = random.Random(3)
    pool = [" ".join(rnd.choices(["alpha", "beta", "Gamma", "delta", "eta"], k=rnd.choice([1, 2, 4, 9]))) for _ in range(14)]
    rows = [(1000, None, "a"), (1001, "", "a"), (1002, "\n \n", "a")]
    for i in range(60):
        rows.append((i, "\n".join(rnd.choice(pool + [""]) for _ in range(rnd.randint(1, 9))), "s"))
    got = {r.doc_id: r for r in linededup.dedup_lines(docs(spark, rows), min_words=8).collect()}
    gone = brute_dedup(rows, 8)
    assert any(gone.values())
    for k, (i, t, _) in enumerate(rows):
        assert got[i].removed == ",".join(map(str, sorted(gone[k]))), (i, t)
        assert got[i].n_removed == len(gone[k])
        left = [x for n, x in enumerate((t or "").split("\n")) if n not in gone[k]]
        if t is not None and any(words(x) for x in left):
            assert got[i].text == "\n".join(left)
        elif t is not None and gone[k]:
            assert got[i].text == ""
        else:
            assert got[i].text == t


def test_line_dedup_of_copies_and_clashing_ids(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    long = "\n".join(f"line {i} of many" for i in range(30000))
    rows = [(3, f"intro three\n{passage}\nend", "a"), (2, f"intro two\n{passage}", "a"), (2, f"intro two\n{passage}", "a"),
            (2, f"another two\n{passage}\n{passage}", "a"), (None, passage, "a"), (10, long, "b"), (11, long + "\nmore", "b")]
    got = Counter((r.doc_id, r.text) for r in linededup.dedup_lines(docs(spark, rows)).collect())
    assert got == Counter([(3, "intro three\nend"), (2, "intro two"), (2, "intro two"), (2, "another two"), (None, passage),
                           (10, long), (11, "more")])
    assert linededup.dedup_lines(docs(spark, [])).count() == 0


# -- mixing ------------------------------------------------------------------
def mixed_rows():
    rows = [(i, "w " * (1 + i % 7), "big") for i in range(400)] + [(1000 + i, "w w", "mid") for i in range(60)]
    rows += [(2000 + i, "w " * 9, None) for i in range(8)] + [(3000, "", "empty"), (3001, None, "empty"), (1000, "w w", "mid")]
    return rows


def test_mixing_meets_the_repetition_limit(spark):
    rows = mixed_rows()
    uses = mixing.plan(docs(spark, rows), max_repeats=3.0).collect()
    tokens, used = Counter(), Counter()
    for i, t, s in rows:
        tokens[s] += len(words(t))
    per_doc = Counter()
    for r in uses:
        used[r.source] += r.tokens
        per_doc[(r.id, r.source)] += 1
    assert {(i, s) for i, _, s in rows} == set(per_doc)
    assert max(per_doc.values()) == 3
    weight = {r.source: r.weight for r in uses}
    assert math.isclose(sum(weight.values()), 1, rel_tol=1e-9)
    shares = {s: n / sum(tokens.values()) for s, n in tokens.items() if n}
    least = max(shares.values())
    for s in shares:
        alpha = math.log(weight[s] / weight["big"]) / math.log(shares[s] / shares["big"]) if s != "big" else None
        want = weight[s] / weight["big"] * tokens["big"]
        assert abs(used[s] - want) <= max(len(words(t)) * 2 for _, t, x in rows if x == s)
        assert alpha is None or 0 < alpha < 1
    # blocks are permutations: starts count the tokens before, whole blocks hold every document
    for s in ("big", None):
        block = sorted((r for r in uses if r.source == s and r.block == 0), key=lambda r: (r.start, r.tokens != 0))
        assert [r.start for r in block] == [sum(x.tokens for x in block[:k]) for k in range(len(block))]
        assert block == sorted(block, key=lambda r: r.key)
    assert least == shares["big"]


def test_mixing_entropy_target_and_rows(spark):
    d = docs(spark, mixed_rows())
    uses = mixing.plan(d, max_repeats=1000.0, entropy=0.5).collect()
    weight = {r.source: r.weight for r in uses}
    assert abs(-sum(w * math.log(w) for w in weight.values() if w) - 0.5) < 1e-3
    n = Counter((r.id, r.source) for r in mixing.plan(d).collect())
    rows = Counter((r.doc_id, r.source) for r in mixing.mix(d).collect())
    copies = Counter((i, s) for i, _, s in mixed_rows())
    assert rows == Counter({k: n[k] * copies[k] for k in n})
    assert mixing.mix(d).columns == d.columns
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, [(1, None, "a"), (2, "", None)])).count() == 2


def test_mixing_budget_cuts_the_last_block(spark):
    rows = [(i, "w w w w", "a") for i in range(100)]
    uses = mixing.plan(docs(spark, rows), budget=200.0, max_repeats=5).collect()
    assert sum(r.tokens for r in uses) == 200 and {r.block for r in uses} == {0}
    more = mixing.plan(docs(spark, rows), budget=1000.0, max_repeats=5).collect()
    assert Counter(r.block for r in more) == {0: 100, 1: 100, 2: 50}


# -- chat --------------------------------------------------------------------
def conversation(spark, rows):
    importable(spark)
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, place string, origin int")


def test_chat_links_quotes_and_orders_replies(spark):
    rows = [(1, 0, "user", "Hello there!\nHow do I sort a list?\n\nThanks"), (1, 1, "assistant", "> How do I sort a list?\nUse sorted."),
            (1, 2, "user", ">> how do I  sort a list?\n> Use sorted.\nOK and reverse?"),
            (1, 3, "assistant", "> Hello there!\n> How do I sort a list?\nAlso list.sort"), (1, 4, None, None),
            (1, 5, "user", "> never said\nhm"), (2, 0, "user", "x"), (None, 0, "user", "> x"), (2, None, "u", "> x"), (2, 5, "u", ">x"),
            (2, 5, "u", ">x"), (3, 0, "u", "> later\nfirst"), (3, 1, "v", "later")]
    got = {(r.conv_id, r.turn, r.place): r for r in chat.reply_ordered(conversation(spark, rows)).collect()}
    assert len(got) == len(rows)
    one = {t: r for (c, t, _), r in got.items() if c == 1}
    assert [one[t].parent_turn for t in range(6)] == [None, 0, 1, 0, 3, 4]
    assert [one[t].n_linked for t in range(6)] == [0, 1, 2, 3, 0, 0]
    assert [one[t].text for t in range(6)] == [rows[0][3], "Use sorted.", "OK and reverse?", "Also list.sort", "", "hm"]
    assert [one[t].place for t in range(6)] == [0, 1, 3, 2, 4, 5]
    assert {(p, r.parent_turn) for (c, t, p), r in got.items() if c == 2 and t == 5} == {(2, 0), (3, 0)}
    assert got[(None, 0, 0)].parent_turn is None and got[(3, 0, 0)].parent_turn is None
    assert chat.reply_ordered(conversation(spark, [])).count() == 0


def test_chat_survives_lines_of_many_marks(spark):
    rows = [(1, 0, "u", "hello there"), (1, 1, "v", ">" * 100_000 + " hello there"), (1, 2, "u", "> " * 100_000 + "x\nyes"),
            (1, 3, "v", " \t>\t>" + " " * 50_000 + "hello there")]
    got = {r.turn: r for r in chat.reply_ordered(conversation(spark, rows)).collect()}
    assert [got[t].text for t in range(4)] == ["hello there", "", "yes", ""] and [got[t].n_quoted for t in range(4)] == [0, 1, 1, 1]
    assert got[1].parent_turn == 0 and got[3].parent_turn == 0


def test_chat_matches_its_sql(spark):
    import duckdb

    from martlane.llm.queries import ORACLE_SQL, op3_chat

    rnd = random.Random(9)
    lines = ["", "> ", "Hello there", "hello, THERE!", "How are you?", "fine", ">> fine", "> fine", "> How are you?", "  > > Hello there",
             ">hello there", "> nobody said this", "a\tb", "Grüße, Ülker"]
    rows = [(c, t, rnd.choice(["user", "assistant", None]), "\n".join(rnd.choices(lines, k=rnd.randint(0, 7))))
            for c in range(60) for t in range(6) if rnd.random() < 0.9]
    rows += [(None, 1, "u", "> fine"), (3, None, "u", "fine"), (4, 2, "u", None)]
    key = lambda r: tuple((x is None, x) for x in r)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    names = ["conv_id", "turn", "role", "parent_turn", "place", "n_quoted", "n_linked", "text"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({ORACLE_SQL['op3_chat']})").fetchall()
    got = [tuple(r) for r in chat.reply_ordered(conversation(spark, rows)).select(*names).collect()]
    assert sorted(got, key=key) == sorted(want, key=key) and any(r[6] for r in got)
    whole = duckdb.connect()
    whole.execute("CREATE VIEW conversations AS SELECT * FROM read_parquet('/root/testdata/sf0.01/conversations.parquet')")
    want = whole.execute(f"SELECT {', '.join(names)} FROM ({ORACLE_SQL['op3_chat']})").fetchall()
    got = [tuple(r) for r in op3_chat(spark, "/root/testdata/sf0.01").select(*names).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_chat_places_of_a_long_conversation(spark):
    rows = [(7, t, "u", f"message {t}") for t in range(3000)] + [(8, 0, "u", "x")]
    got = chat.reply_ordered(conversation(spark, rows)).where("conv_id = 7").select("turn", "place").collect()
    assert all(r.turn == r.place for r in got)


# -- context-tree weighting ----------------------------------------------------
def kt(bits):
    p, n = 0.0, [0, 0]
    for b in bits:
        p += math.log((n[b] + 0.5) / (sum(n) + 1))
        n[b] += 1
    return p


class BruteTree:
    """Context-tree weighting by its definition, one context set at a time."""

    def __init__(self, texts, depth):
        self.depth, self.seen = depth, defaultdict(list)
        for t in texts:
            padded = b"\0" * depth + t + b"\0"
            for i in range(depth, len(padded)):
                for j in range(8):
                    node = (1 << j) | (padded[i] >> (8 - j))
                    for d in range(depth + 1):
                        self.seen[padded[i - d:i], node].append(padded[i] >> (7 - j) & 1)
        self.children = defaultdict(set)
        for context, node in self.seen:
            if context:
                self.children[context[1:], node].add(context[:1])

    def weighted(self, context, node):
        own = kt(self.seen.get((context, node), []))
        if len(context) == self.depth:
            return own
        below = sum(self.weighted(c + context, node) for c in self.children[context, node])
        return math.log(0.5) + np.logaddexp(own, below)

    def one(self, context, node, d=0):
        bits = self.seen.get((context[len(context) - d:], node), [])
        estimate = (sum(bits) + 0.5) / (len(bits) + 1)
        if d == self.depth:
            return estimate
        stay = math.exp(math.log(0.5) + kt(bits) - self.weighted(context[len(context) - d:], node))
        return stay * estimate + (1 - stay) * self.one(context, node, d + 1)

    def log10(self, text):
        padded, out = b"\0" * self.depth + text + b"\0", 0.0
        for i in range(self.depth, len(padded)):
            for j in range(8):
                p = self.one(padded[i - self.depth:i], (1 << j) | (padded[i] >> (8 - j)))
                out += math.log10(p if padded[i] >> (7 - j) & 1 else 1 - p)
        return out


@pytest.mark.parametrize("piece", [7, ctw.PIECE_BYTES])
def test_ctw_matches_its_definition(spark, monkeypatch, piece):
    monkeypatch.setattr(ctw, "BUCKET_BYTES", 300)
    monkeypatch.setattr(ctw, "PIECE_BYTES", piece)  # 7: texts are cut
    monkeypatch.setattr(ctw, "CONTEXTS_PER_PART", 40)
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choices(["Ab", "abc", "ba", "éa"], k=rnd.randint(1, 12))), "s") for i in range(60)]
    rows += [(100, None, "s"), (101, "", "s"), (102, "zz new", "s"), (3, rows[3][1], "s"), (None, "ab", "s")]
    rows += [(None, "ab ba éa ab", "s")] * 40 + [(7, "ba", "s")] * 30  # copies that would fill a bucket
    got = ctw.scores(docs(spark, rows), crc_mod("doc_id", 10) == 0, depth=3).collect()
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _, _ in rows}
    low = {(i, t): (t or "").encode().lower() for i, t, _ in rows}
    train = [low[i, t] for i, t, _ in rows if not held[i]]
    count = Counter(w for t in train for w in t.split())
    total, distinct = sum(count.values()) + len(train), len(count) + 1
    tree = BruteTree(train, 3)
    want = defaultdict(list)
    for i, t, _ in rows:
        w = low[i, t].split()
        base = sum(math.log10((c + 0.1) / (total + 0.1 * (distinct + 1))) for c in [*(count[x] for x in w), len(train)])
        want[i].append((held[i], len(w) + 1, sum(x in count for x in w) + 1, total, base, tree.log10(low[i, t])))
    assert len(got) == len(rows)
    for r in got:
        near = [x for x in want[r.doc_id] if x[:4] == (r.held_out, r.n_tokens, r.n_known, r.train_tokens)
                and math.isclose(x[4], r.base_score, rel_tol=1e-9) and math.isclose(x[5], r.score, rel_tol=1e-9)]
        assert near, (r, want[r.doc_id])


def test_ctw_blocks_of_a_long_text_are_its_codes(monkeypatch):
    rnd = random.Random(9)
    texts = [bytes(rnd.choices(b"ab \n", k=k)) for k in (0, 5, 300, 1, 64, 65, 128, 2)]
    whole, _ = ctw.grams(texts, 4)
    monkeypatch.setattr(ctw, "PIECE_BYTES", 64)
    assert np.array_equal(np.concatenate([codes for _, _, codes, _ in ctw.blocks(texts, 4)]), whole)
    assert [list(ctw.words_of(t)) for t in texts] == [t.split() for t in texts]


def test_ctw_probabilities_sum_to_one():
    texts = [b"abracadabra", b"a banana", b""]
    codes, _ = ctw.grams(texts, 3)
    known, n = np.unique(codes, return_counts=True)
    context = int(codes[5]) >> 8
    asked = np.unique(np.concatenate([known, (context << 8) + np.arange(256)]))
    counts = np.zeros(len(asked), np.int64)
    counts[np.searchsorted(asked, known)] = n
    logs = ctw.log_probabilities(asked, counts, 3, 0, np.zeros(256), np.ones(256))
    assert math.isclose((10 ** logs[asked >> 8 == context]).sum(), 1, rel_tol=1e-9)


def test_ctw_on_empty_and_unlearned_tables(spark):
    assert ctw.scores(docs(spark, []), F.lit(False)).count() == 0
    (row,) = ctw.scores(docs(spark, [(1, "ab", "s")]), F.lit(True)).collect()
    assert row.train_tokens == 0 and row.n_known == 0 and math.isclose(row.score, -24 * math.log10(2))
    long = ctw.scores(docs(spark, [(1, "lang " * 60000, "s"), (2, "lang", "s")]), F.lit(False)).collect()
    assert all(r.score < 0 and math.isfinite(r.score) for r in long)


# -- forest search ---------------------------------------------------------------
def vectors(spark, rows):
    importable(spark)
    return spark.createDataFrame([(i, v, "x", "x", "x") for i, v in rows],
                                 "vec_id long, embedding array<float>, v string, ids string, score string")


def brute_nearest(rows, k=10):
    fine = {}
    for i, v in rows:
        if i is not None and v and len(v) == 4 and all(x is not None and math.isfinite(x) for x in v) and any(v):
            fine[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q in fine:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((fine[q] - v) ** 2).sum())), i) for i, v in fine.items() if i != q)
            out[q] = near[:k]
    return out


def test_forest_on_ties_copies_and_bad_vectors(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.choice([0.0, 1.0, 0.5]) for _ in range(4)]) for i in range(1, 700)]
    rows += [(i, [1.0, 1.0, 0.0, 0.0]) for i in range(700, 1300)] + [(1300, [1.0, 1.0, 0.0, 0.0])] * 3
    rows += [(2000, None), (2100, []), (2200, [0.0] * 4), (2300, [float("nan"), 1.0, 1.0, 1.0]), (2400, [None, 1.0, 1.0, 1.0]),
             (2500, [float("inf"), 1.0, 1.0, 1.0]), (2600, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    got = defaultdict(list)
    # enough rows that every shard is searched whole: the exact answer
    for r in ann.nearest(vectors(spark, rows), F.col("vec_id") % 100 == 0, gather=ann.TREES).collect():
        got[r.query_id].append((r.rank, r.score, r.vec_id))
    want = brute_nearest(rows)
    assert set(got) == set(want)
    for q, near in want.items():
        found = sorted(got[q])
        assert [n for n, _, _ in found] == list(range(1, 11)) and [i for _, _, i in found] == [i for _, i in near]
        assert [x for _, x, _ in found] == pytest.approx([x for x, _ in near], rel=1e-15)


def test_forest_searches_each_length_by_itself(spark):
    rnd = random.Random(8)
    rows = [(i, [rnd.random() for _ in range(4)]) for i in range(1, 401)]
    plain = {tuple(r) for r in ann.nearest(vectors(spark, rows), F.col("vec_id") % 100 == 0).collect()}
    assert len(plain) == 40
    # longer vectors, one of them unusable, and shorter ones change nothing
    more = [(500, [float("nan")] * 9), (501, [1.0] * 9), (600, [1.0, 2.0]), (601, [1.0, 3.0]), (602, [2.0, 2.0])]
    got = {tuple(r) for r in ann.nearest(vectors(spark, rows + more), F.col("vec_id") % 100 == 0).collect()}
    assert got == plain | {(600, 1, 601, 1.0), (600, 2, 602, 1.0)}


def test_forest_recall_and_few_candidates(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = defaultdict(set)
    for r in ann.nearest(table, F.col("vec_id") % 100 == 0).collect():
        got[r.query_id].add(r.vec_id)
    rows = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    ids, matrix = list(rows), np.array(list(rows.values()))
    hits = total = 0
    for q in [i for i in ids if i % 100 == 0]:
        d = ((matrix - rows[q]) ** 2).sum(axis=1)
        near = [ids[k] for k in np.lexsort((ids, d)) if ids[k] != q][:10]
        hits, total = hits + len(got[q] & set(near)), total + 10
    assert hits / total >= 0.9
    few = ann.nearest(vectors(spark, [(0, [1.0, 2.0]), (1, [1.0, 1.0]), (100, [3.0, 1.0])]), F.col("vec_id") % 100 == 0).collect()
    assert Counter(r.query_id for r in few) == {0: 2, 100: 2}
    assert ann.nearest(vectors(spark, []), F.col("vec_id") % 100 == 0).count() == 0


def test_forest_climbs_to_longer_prefixes_first():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((500, 8))
    forest = ann.Forest(x, trees=6, bits=12)
    small = [set(f.tolist()) for f in forest.search(x[:20], 30)]
    large = [set(f.tolist()) for f in forest.search(x[:20], 600)]
    assert all(i in s and s <= b for i, (s, b) in enumerate(zip(small, large)))
