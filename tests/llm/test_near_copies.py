"""Near copies against brute force over all pairs."""

import os
import random
from collections import Counter

import pytest
import xxhash

import corpus_pipeline
from tests.llm.test_group_operators import plain_components
from tidemark.llm import near_copies


def plain_set(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_copies_equal_brute_force(spark, empty):
    r = random.Random(12)
    words = [f"{a}{b}" for a in "abcdefgh" for b in range(40)]
    rows = []
    for k in range(12):
        base = [r.choice(words) for _ in range(120)]
        for _ in range(15 if k else 60):
            copy = list(base)
            for _ in range(r.randint(0, 5)):
                copy[r.randrange(len(copy))] = r.choice(words)
            rows.append((len(rows), " ".join(copy)))
    rows += [(900, None), (901, " \n"), (902, "two words"), (903, "Two  words"), (None, rows[3][1]), (904, rows[3][1])]
    table = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id bigint, text string, lang string")
    texts = [(i, plain_set(t)) for i, t in rows if t and t.split()]
    similar = [
        (a, b)
        for a, x in enumerate(texts)
        for b, y in enumerate(texts[:a]) if 5 * len(x[1] & y[1]) >= 4 * len(x[1] | y[1])
    ]
    found = plain_components(similar)
    want = {}
    for k, (i, _) in enumerate(texts):
        want[i] = min(j for n, (j, _) in enumerate(texts) if j is not None and found.get(n, n) == found.get(k, k))
    want |= {900: 900, 901: 900}
    assert {x.doc_id: x.component_id for x in near_copies.near_copies(table).collect()} == want
    kept = corpus_pipeline.near_dedup(spark, table, "")
    assert kept.columns == table.columns
    assert sorted(x.doc_id for x in kept.collect()) == sorted(set(want.values()))
    assert corpus_pipeline.near_dedup(spark, empty, "").count() == 0
    assert near_copies.near_copies(empty).count() == 0


def test_simhash_gives_candidates_of_its_own(spark, monkeypatch):
    """Copies that no band finds are linked by their fingerprints, pairs that differ too much are not."""
    monkeypatch.setattr(near_copies.MinHash, "bands", lambda self, s: [xxhash.xxh64_intdigest(s.tobytes()) >> 1])
    r = random.Random(5)
    words = [f"{a}{b}" for a in "abcdefgh" for b in range(200)]
    base = [r.choice(words) for _ in range(2000)]
    rows = [(k, " ".join([*base[:-1], f"end{k}"])) for k in range(4)] + [(9, " ".join(words[:90]))]
    pairs = []
    found = near_copies._simhash_pairs
    monkeypatch.setattr(near_copies, "_simhash_pairs", lambda nodes: (pairs.append(found(nodes)), pairs[-1])[1])
    got = near_copies.near_copies(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {x.doc_id: x.component_id for x in got.collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 9: 9}
    assert pairs[0].count() >= 3


SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_near_copies_of_the_given_documents(spark):
    """Every pair of the documents that shares a shingle is compared: no link of 0.8 or more is missed."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets = [(r.doc_id, near_copies.shingle_set(r.text)) for r in docs.select("doc_id", "text").collect()]
    holders = {}
    for i, (_, s) in enumerate(sets):
        for x in s.tolist():
            holders.setdefault(x, []).append(i)
    common = Counter((a, b) for own in holders.values() for k, b in enumerate(own) for a in own[:k])
    similar = [(a, b) for (a, b), n in common.items() if 5 * n >= 4 * (len(sets[a][1]) + len(sets[b][1]) - n)]
    wordless = [i for i, (_, s) in enumerate(sets) if not len(s)]
    roots = plain_components(similar + list(zip(wordless, wordless[1:])))
    least = {}
    for i, (doc, _) in enumerate(sets):
        least[roots.get(i, i)] = min(least.get(roots.get(i, i), doc), doc)
    want = {doc: least[roots.get(i, i)] for i, (doc, _) in enumerate(sets)}
    assert len(similar) > 5
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == want
