"""Operators on single texts against brute force: secrets, quality, toxicity,
BPE.  Every fixture has nulls, empty and very long texts, repeated rows and
extra columns whose names clash with results or internals."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlane.llm import bpe, quality, secrets, toxicity
from martlane.llm.base import importable
from martlane.llm.queries import bpe_path

SCHEMA = ("doc_id long, text string, source string, score string, ids string, n_tokens string, spans string, "
          "kept string, w string, h string, t string")


def docs(spark, texts):
    importable(spark)
    rows = [(i if i >= 0 else None, t, None, "x", "x", "x", "x", "x", "x", "x", "x") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


EDGE = [(0, None), (1, ""), (2, " \n\t "), (3, "word"), (3, "word"), (-1, None), (4, "a b c a b c"), (5, "ein " * 30000),
        (6, "  x y \x1c z"), (7, "tie tie\ntie tie\n\ntie tie")]


# -- secrets -----------------------------------------------------------------
def brute_secrets(text):
    found = []
    rules = [(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 8),
             ("AKIA[A-Z0-9]+", 0, 0, 16), ("[0-9a-f]+", 0, 0, 32)]
    for k, (pattern, flags, group, least) in enumerate(rules):
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "", flags) if len(m[group]) >= least]
    return sorted(found)


def test_secrets_match_brute_force(spark):
    rnd = random.Random(1)
    bits = ["token", "SECRET", "api_key", "apikey", "pasſword", "=", ": ", '"', "'", "AKIA", "AKIAAKIA", "abcdef0123456789" * 3,
            "ABCDEFGHIJKL", "deadbeef", " ", "\n", "\U0001f511", "x" * 9, "="]
    texts = EDGE + [(100 + i, "".join(rnd.choices(bits, k=rnd.randint(1, 14)))) for i in range(400)]
    got = secrets.scan_secrets(docs(spark, texts)).select("n_assign", "n_access", "n_hex", "base_sha256", "spans").collect()
    assert len(got) == len(texts)
    names = ("assign", "access", "hex")
    for row, (_, text) in zip(got, texts):
        want = brute_secrets(text)
        joined = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in want)
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == i for _, k, _ in want) for i in range(3))
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in row.spans.split(",") if s and not s.startswith("novel")] == [s for s in joined.split(",") if s]


def test_novel_strings_only_in_sensitive_context(spark):
    key = "Zk8vQ2mXw7Lr4TnB9sYc3JdF6hG1pA5e"
    texts = [(0, f"auth bearer {key} sent"), (1, f"the product {key} sold"),
             (2, "auth header " + "identifier_name_1 " * 40), (3, "auth identifier_name_1identifier_name_1 identifier_name_1")]
    got = {r.doc_id: r.spans for r in secrets.scan_secrets(docs(spark, texts)).collect()}
    assert got[0] == f"novel:12:{12 + len(key)}" and got[1] == ""
    assert got[2] == "" and got[3] == ""


def test_novel_values_after_a_name_and_equals_sign(spark):
    key = "Zk8vQ2mXw7Lr4TnB9sYc3JdF6hG1pA5e"
    forms = [("PRIVATE_KEY=", ""), ("--pwd=", " run"), ("GET /a?access_key=", "&x=1"), ("pwd = ", ""), ("jwt=", "=="),
             ("x=1\nMY_AUTH_" + "LONG_" * 12 + "NAME=", "\n"), ("color=", "")]
    texts = [(i, a + key + b) for i, (a, b) in enumerate(forms)]
    got = {r.doc_id: r.spans for r in secrets.scan_secrets(docs(spark, texts)).collect()}
    for i, (a, b) in enumerate(forms[:-1]):
        assert got[i] == f"novel:{len(a)}:{len(a) + len(key) + 2 * (b == '==')}", (a, got[i])
    assert got[len(forms) - 1] == ""


def test_every_copy_of_a_secret_is_reported(spark):
    key, low = "Zk8vQ2mXw7Lr4TnB9sYc3JdF6hG1pA5e", "0f1e2d3c4b5a69788796a5b4c3d2e1f0"
    texts = [(0, f"auth bearer {key} sent, then pwd {key} again, jwt={key}"), (1, f"row {key} was listed\nauth bearer {key}"),
             (2, f"token={key}\nauth bearer {key}"), (3, f"pwd {key}\n" + "some text " * 200 + f"\nauth bearer {key}"),
             (4, f"GET /{key}/x\nauth bearer {key}"), (5, f"listed {low} auth bearer {low}")]
    got = {r.doc_id: r.spans.split(",") for r in secrets.scan_secrets(docs(spark, texts)).collect()}
    at = {i: [m.start() for m in re.finditer(key, t)] for i, t in texts}
    for i, copies in ((0, at[0]), (1, at[1][1:]), (2, at[2][1:]), (3, at[3]), (4, at[4][1:])):
        assert [s for s in got[i] if s.startswith("novel")] == [f"novel:{s}:{s + len(key)}" for s in copies], i
    assert got[5] == [f"hex:{m.start()}:{m.end()}" for m in re.finditer(low, texts[5][1])]


def test_random_strings_of_any_alphabet_and_length_are_novel(spark):
    rnd = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    kinds = [(letters + letters.upper(), 16), (letters + letters.upper(), 20), ("0123456789ABCDEF", 128), ("0123456789", 24),
             (letters + letters.upper() + "0123456789", 8), (letters + letters.upper() + "0123456789", 12)]
    texts, spans = [], {}
    for i in range(240):
        alphabet, size = kinds[i % len(kinds)]
        key = "".join(rnd.choices(alphabet, k=size))
        around = " ".join("".join(rnd.choices(letters[:9], k=rnd.randint(2, 6))) for _ in range(80))
        texts.append((i, f"{around} pwd {key} {around}"))
        spans[i] = f"novel:{len(around) + 5}:{len(around) + 5 + size}"
    got = {r.doc_id: r.spans for r in secrets.scan_secrets(docs(spark, texts)).collect()}
    for k, kind in enumerate(kinds):
        found = sum(spans[i] in got[i].split(",") for i in spans if i % len(kinds) == k)
        assert found >= (40 if kind[1] >= 16 else 36), (kind, found)
    (row,) = secrets.scan_secrets(docs(spark, [(0, "pwd " + "Ab1" * 40)])).collect()
    assert row.spans == ""


@pytest.mark.parametrize("name, found", [
    ("auth", True), ("authToken", True), ("clientSecret", True), ("SESSION_ID", True), ("my-keys", True), ("DB_PWD", True),
    ("author", False), ("AUTHORITY", False), ("sessional", False), ("keyboard", False), ("monkey", False), ("certain", False)])
def test_sensitive_words_are_whole(name, found):
    text = f"{name} 8Zk2vQx91LmTr5Wp"
    assert bool(secrets.Novelty([]).spans(text, [], 0.75)) == found


def test_common_words_are_no_secrets(spark):
    plain = ["the secret ingredient of delicious strawberries", "author William Shakespeare published Nightingale",
             "private delicious-strawberries and published_ingredient", "token IngredientNightingale"]
    d = docs(spark, [(i, t) for i, t in enumerate([*plain, *plain, "pwd qwzkxvjhplmt", "secret berry7q9xz2Kd"])])
    got = {r.doc_id: r.spans for r in secrets.scan_secrets(d).collect()}
    assert all(got[i] == "" for i in range(8))
    assert got[8] == "novel:4:16" and got[9].startswith("novel:7:")


def test_common_words_by_frequency(spark):
    d = docs(spark, [(i, t) for i, t in enumerate(["alpha beta Gamma beta", "alpha gamma delta", "ALPHA gamma zeta9 abc", None])])
    assert secrets.common_words(d) == ["alpha", "gamma"] == secrets.common_words(d, 2)
    assert secrets.common_words(d, 1) == secrets.common_words(docs(spark, [])) == []


def test_novel_spans_match_a_plain_version():
    import zstandard

    names, common = ["user_name", "get_value", "connection"], ["ingredient", "delicious"]
    primed = zstandard.ZstdCompressionDict("\n".join(["delicious", "ingredient", *names]).encode(),
                                           dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False)
    model = secrets.Novelty(names, common)
    groups = ["0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+/", "_-.~", "="]

    def rate(text, s, e):
        own = text[s:e]
        near = text[e:e + 512] + "\n" + text[max(0, s - 512):s]
        near = re.sub(rf"(?<![A-Za-z0-9_]){re.escape(own)}(?![A-Za-z0-9_])", "", near)
        size = lambda extra: len(packer.compress((near + extra).encode()))
        symbols = "".join(g for g in groups if set(g) & set(own))
        rnd, times = random.Random(own), max(1, 128 // len(own))
        other = sum(size("".join(rnd.choices(symbols, k=len(own)))) - size("") for _ in range(times))
        return (size(own) - size("")) * times / max(1, other)

    rnd, seen = random.Random(21), 0
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    for _ in range(300):
        made = ["".join(rnd.choices(letters, k=rnd.choice([7, 8, 12, 20]))) for _ in range(3)]
        pieces = [*made, "pwd", "auth", "session key", "delicious", "ingredient", "user_name", "connection", "author", "x" * 45]
        text = " ".join(rnd.choices(pieces, k=rnd.randint(2, 14)))
        tokens = [m.span() for m in re.finditer(r"\S+", text) if len(m[0]) >= 8]
        marks = [m.span() for m in re.finditer(r"(?<![A-Za-z])(?i:pwd|auth|key|session)(?![A-Za-z])", text)]
        near = [(s, e) for s, e in tokens if any(s - 40 <= a and b <= s for a, b in marks)]
        novel = {text[s:e] for s, e in near if text[s:e] not in common and rate(text, s, e) >= 0.75}
        want = [(s, e) for s, e in near if text[s:e] in novel]
        assert [(s, e) for s, _, e in model.spans(text, [], 0.75)] == want, text
        seen += len(want)
    assert seen > 100


def test_secrets_on_an_empty_table(spark):
    assert secrets.scan_secrets(docs(spark, [])).count() == 0


# -- quality -----------------------------------------------------------------
def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(wins)
    covered = {k for i, x in enumerate(wins) if n[x] > 1 for k in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def test_quality_counts_match_brute_force(spark):
    rnd = random.Random(2)
    texts = EDGE + [(100 + i, "".join(rnd.choice("ab#é\U0001f600") + rnd.choice([" ", " ", "\n", "\t\x0b", ""])
                                      for _ in range(rnd.choice([3, 40, 300, 2500])))) for i in range(60)]
    got = quality.assess(docs(spark, texts).withColumn("at", F.monotonically_increasing_id()))
    rows = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got.collect())
    assert rows == Counter((i if i >= 0 else None, *brute_counts(t)) for i, t in texts)
    assert got.where("base_failed and kept").count() == 0


def test_quality_both_ways_of_finding_repeats_agree(spark, monkeypatch):
    rnd = random.Random(3)
    texts = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 80)))) for i in range(60)]
    out = []
    for few in (0, 10_000):
        monkeypatch.setattr(quality, "FEW", few)
        out.append({r.doc_id: r.n_repeat_words for r in quality.counts(docs(spark, texts)).collect()})
    assert out[0] == out[1] == {i: brute_counts(t)[4] for i, t in texts}


def test_quality_verdicts_follow_labels(spark):
    """Junk of the labelled table is rejected, good texts stay."""
    found = quality.assess(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = {(r.quality, r.kept): r["count"] for r in found.drop("quality").join(labels, "doc_id").where(
        ~F.col("base_failed")).groupBy("quality", "kept").count().collect()}
    assert seen[(1, True)] > 100 and seen.get((1, False), 0) <= 0.01 * seen[(1, True)]
    assert seen.get((0, True), 0) <= 0.1 * seen.get((0, False), 1)


def test_quality_on_an_empty_table(spark):
    assert quality.assess(docs(spark, [])).count() == 0


# -- toxicity ----------------------------------------------------------------
def labelled(spark, n=600):
    rnd = random.Random(4)
    plain = [rnd.choice("bdfgklmnprst") + rnd.choice("aeiou") + rnd.choice("dlmnrs") + rnd.choice("aeiou") for _ in range(300)]
    texts, labels = [], []
    for i in range(n):
        words = rnd.choices(plain, k=rnd.randint(8, 60))
        toxic = i % 4 == 0
        if toxic:
            for w in rnd.sample(["blarghead", "snotwort", "gitface"], 2):
                words.insert(rnd.randrange(len(words)), w + rnd.choice(["", "s", "!!", "ish"]))
        texts.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return texts, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_learns_folds_and_holds_out(spark):
    texts, labels = labelled(spark)
    hidden = [(9001, "mola dini sn0tw0rt neri blarghеаd tola"), (9002, "mola dini neri tola"), (9003, "SNOTWORT $notwort mola"),
              (9004, None), (9005, ""), (9005, ""), (-1, "gitface gitface"), (9006, "mola " * 40000 + "snotwort")]
    d = docs(spark, texts + hidden)
    lexicon = toxicity.learn(d, labels.withColumn("score", F.lit(1)))
    assert {t[:6] for t in lexicon.terms} == {"blargh", "snotwo", "gitfac"}
    got = toxicity.score(d, lexicon).select("doc_id", "score", "predicted").collect()
    assert len(got) == len(texts) + len(hidden)
    by = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert by[9001].predicted == by[9003].predicted == by[None].predicted == 1
    assert by[9002].score == by[9004].score == by[9005].score < 0.5
    held = [i for i, _ in texts if zlib.crc32(str(i).encode()) % 3 == 1]
    assert held and all(by[i].predicted == int(i % 4 == 0) for i in held)


def test_toxicity_exception_phrases_do_not_count():
    m = toxicity.Lexicon({"trash": 5.0}, (-3.0, 2.0, 1.0)).matcher()
    assert m.features("a trash can stands") == (0.0, 0.0)
    assert m.features("a tr­ash heap")[0] > 0 and m.features("such traѕh")[0] > 0


@pytest.mark.parametrize("text", ["@moron", "!moron", "|moron|", "$moron!", "you!moron", "m0r0n", "mörön", "mo\u0301ron",
                                  "\U0001d426\U0001d428\U0001d42b\U0001d428\U0001d427", "ＭＯＲＯＮ", "mоrоn", "@m0ron"])
def test_toxicity_sees_through_disguise(text):
    m = toxicity.Lexicon({"moron": 5.0}, (-3.0, 2.0, 1.0)).matcher()
    assert m.score(f"what a {text} here") > 0.9 and m.score("what an oxymoron here") < 0.1


def test_toxicity_score_matches_a_plain_one():
    rnd = random.Random(11)
    terms = {"idio": 3.0, "trash": 1.5, "ass": 2.0, "shit": 2.5}
    lexicon = toxicity.Lexicon(terms, (-2.0, 1.1, 0.4), learned=("an idiom", "ass ort"))
    plain = dict(zip("013457@$!|", "oieastasil")) | {"é": "e", "о": "o"}
    pieces = ["idio", "t", "m", "an", "trash", "can", "ass", "ort", "$h!t", "@", "!", "|", "1", " ", " ", " ", ",", "é", "о", "X", "4ss"]

    def fold(text, signs):
        return " " + "".join((" " if c in "@$!|" and not signs else plain.get(c, c if c.isalpha() else " ")) for c in text) + " "

    for _ in range(400):
        text = "".join(rnd.choices(pieces, k=rnd.randint(0, 25))).lower()
        inside, i = list(text), 0
        while i < len(text):
            j = i
            while j < len(text) and text[j] in "@$!|":
                j += 1
            if j > i and (i == 0 or not text[i - 1].isalnum()) and j < len(text) and text[j].isalnum():
                inside[i:j] = " " * (j - i)
            i = max(j, i + 1)
        hits, free = set(), []
        for view in (fold(text, True), fold(text, False), fold("".join(inside), True)):
            for at in range(len(view)):
                hits |= {(at, at + len(t), w) for t, w in terms.items() if view.startswith(" " + t, at)}
                free += [(at, at + len(p)) for p in (*toxicity.EXCEPTIONS, "an idiom ", "ass ort ") if view.startswith(" " + p, at)]
        total = sum(w for s, e, w in hits if not any(a <= s and e <= b for a, b in free))
        want = -2.0 + 1.1 * np.log1p(total) + 0.4 * np.log1p(1000 * total / (len(text) + 2))
        assert lexicon.matcher().score(text) == pytest.approx(1 / (1 + np.exp(-want)), rel=1e-12), text


def test_toxicity_learns_exceptions_from_clean_texts(spark):
    texts, labels = labelled(spark)
    near = [f"{a} {b}" for a in ("mola", "neri", "tola", "suda") for b in ("dini", "rumo", "fela", "gano")]
    more = [(2000 + i, f"{x.split()[0]} snotwort tea {x.split()[1]}") for i, x in enumerate(near)]
    labels = labels.union(spark.createDataFrame([(i, 0) for i, _ in more], "doc_id long, toxic int"))
    lexicon = toxicity.learn(docs(spark, texts + more), labels)
    assert "snotwort tea" in lexicon.learned
    m = lexicon.matcher()
    assert m.features("wir snotwort tea dort") == (0.0, 0.0) < m.features("wir snotwort dort")


def test_toxicity_time_is_linear_in_hits_and_phrases():
    m = toxicity.Lexicon({"trash": 5.0}, (-3.0, 2.0, 1.0)).matcher()
    start = time.process_time()
    assert m.features("trash can trash heap " * 100_000)[0] == pytest.approx(np.log1p(500_000))
    assert time.process_time() - start < 20


def test_copies_of_one_document_teach_nothing(spark):
    texts, labels = labelled(spark, 400)
    copy = "zulo fremd quasi zulo blarghead nimm snotwort"
    texts += [(1000 + i, copy) for i in range(60)]
    labels = labels.union(spark.createDataFrame([(1000 + i, 1) for i in range(60)], "doc_id long, toxic int"))
    terms = toxicity.learn(docs(spark, texts), labels).terms
    assert not any(t.startswith(("frem", "quas", "zulo", "nimm")) for t in terms)


def test_toxicity_without_labels(spark):
    d = docs(spark, EDGE)
    lexicon = toxicity.learn(d, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity.score(d, lexicon).collect()} == {0}
    assert toxicity.score(docs(spark, []), lexicon).count() == 0


# -- BPE ---------------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe_path())


def test_bpe_matches_the_library(spark, library):
    rnd = random.Random(5)
    alphabet = ("aaaaab bc'stdml  \n\t\x0b\x1c\x1f\x85\xa0éÉßİıΣσςµªº²½"
                "٣中日́‍​ﬁ—’“…€ŒŸ\U0001f642!?#$%12" + "etaoinshr" * 3)
    texts = EDGE + [(100 + i, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))) for i in range(3000)]
    texts += [(9000, "a<|endoftext|>b <|startoftext|> C"), (9001, "ab" * 4000), (9002, "he's it'LL I'D don't x<|end")]
    got = bpe.bpe(docs(spark, texts), bpe_path(), ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")).collect()
    want = library.encode_batch([t or "" for _, t in texts], add_special_tokens=False)
    assert len(got) == len(want)
    for row, enc in zip(got, want):
        text = library.decode(enc.ids, skip_special_tokens=False)
        assert row.ids == enc.ids and row.n_tokens == len(enc.ids) and row.decoded == text
        assert row.ids_sha256 == hashlib.sha256(np.array(enc.ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_pair_check_agrees_with_merging():
    c = bpe.Codec(bpe_path())
    rnd = random.Random(6)
    inner = rnd.sample(sorted(c.inner.items()), 600)
    final = rnd.sample(sorted(c.final.items()), 600)
    a, b = np.array([i for _, i in inner]), np.array([i for _, i in final])
    fine = c.compatible(a, b)
    for (x, i), (y, j), ok in zip(inner, final, fine.tolist()):
        if c.sound[i] and c.sound[j]:
            assert (c.merge(x + y) == [i, j]) == ok


def test_bpe_on_an_empty_table(spark):
    assert bpe.bpe(docs(spark, []), bpe_path()).count() == 0
