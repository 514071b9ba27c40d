"""The corpus pipeline against its stages done by brute force, its stages on
awkward tables, and the guard of the driver contract."""

from __future__ import annotations

import hashlib
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_llm_groups import brute_components, brute_dedup, brute_fingerprint

import corpus_pipeline
from martlane.llm import mixing, toxicity
from martlane.llm.base import importable
from martlane.llm.queries import QUERIES, bpe_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_matches_brute_force(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    matcher = toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet")).matcher()
    rows = [r for r in rows if matcher.score(r.text or "") < 0.7]
    gone = brute_dedup([(r.doc_id, r.text, None) for r in rows], 50)
    kept = []
    for k, r in enumerate(rows):
        left = [x for n, x in enumerate(r.text.split("\n")) if n not in gone[k]]
        text = r.text if not gone[k] else "\n".join(left) if any(x.split() for x in left) else ""
        kept.append((r.doc_id, text, r.lang, r.source))
    comps = brute_components([brute_fingerprint(t) for _, t, _, _ in kept], [i for i, *_ in kept], 2)
    kept = [r for r, c in zip(kept, comps) if r[0] == c]
    frame = spark.createDataFrame([(*r, len(r[1])) for r in kept], SCHEMA)
    uses = Counter(r.id for r in mixing.plan(frame).collect())
    tokenizer = Tokenizer.from_file(bpe_path())
    want = Counter()
    for i, text, lang, source in kept:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        decoded = hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        want[i, text, lang, source, len(text), len(ids), tuple(ids), decoded] += uses[i]
    got = Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars, r.n_tokens, tuple(r.ids), r.decoded_sha256)
                  for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want


AWKWARD = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "x", "en", "a", 1), (3, "x", "en", "a", 1), (None, None, None, "b", None),
           (None, "only here", "en", "b", 9), (4, "y " * 30000, "en", "a", 60000), (5, "tie tie", "de", None, 7), (6, "tie tie", "de", None, 7)]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_awkward_and_empty_tables(spark, name, stage):
    importable(spark)
    docs = spark.createDataFrame(AWKWARD, SCHEMA).withColumns({c: F.lit("x") for c in ("score", "ids2", "removed", "copies", "fp")})
    out = stage(spark, docs, SF)
    last = name == corpus_pipeline.STAGES[-1][0]
    assert out.columns == docs.columns + (["n_tokens", "ids", "decoded_sha256"] if last else [])
    found = Counter(r.doc_id for r in out.collect())
    if name in ("toxicity", "line_dedup", "bpe"):
        assert found == Counter(r[0] for r in AWKWARD)
    elif name == "near_duplicates":
        # 1 and 2 have no words, like the first nameless row; 5 and 6 are equal
        assert found == Counter({1: 1, 3: 1, 4: 1, 5: 1, None: 1})
    else:
        assert set(found) == {r[0] for r in AWKWARD}
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_ten_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    keys = entry.queries()
    assert [sum(k.startswith(f"op{n}_") for k in keys) for n in range(1, 11)] == [1] * 10
    assert keys["pipeline"] is corpus_pipeline.run and set(QUERIES) < set(keys)


def test_entry_works_without_the_subpackage():
    code = ("import sys; sys.modules['martlane.llm'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql()\n"
            "assert 'pipeline' not in q and not any(k.startswith('op1_') for k in q) and len(q) > 90 and set(o) == set(q)")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
