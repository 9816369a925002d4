"""Operators 11 to 13 against brute force and on odd tables."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, prose
from tidemark.llm import fill_middle, line_dedup, prefix_trie

BLANKS = " \t\n\v\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_lines(rows, min_chars=40, min_docs=5):
    """(id, n_lines, n_dropped, kept text) of each row by the definition."""
    holders = defaultdict(list)
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    for doc, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            holders[k].append(doc)
    out = []
    for doc, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            own = holders[key(line)]
            last = max((d for d in own if d is not None), default=None)
            if not (len(key(line)) >= min_chars and len(own) >= min_docs and doc != last):
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def lined(docs):
    """The odd documents and texts of shared lines: in 4 and 5 documents, twice in one, with blanks and other case, only in
    rows without an id, and one line in most documents."""
    r = random.Random(5)
    shared = [prose(100 + k, 12, ["Été", "naïve", "漢字", "stone", "River", "walks"]) for k in range(12)]
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    for k in range(60):
        lines = [prose(1000 + k, 9), *r.sample(shared[:8], r.randint(0, 4)), "short line", ""]
        lines += [shared[8]] if k < 4 else []
        lines += [f" \t{shared[9].upper()}\r", shared[9]] if k < 5 else []
        lines += [shared[11]] if k % 10 else []
        rows.append((200 + k, "\n".join(lines)))
    rows += [(None, f"{shared[10]}\n{shared[11]}\n{i}") for i in range(6)]
    rows += [(200, rows[-7][1])] * 3
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", "y", 1, 0.5, "z") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("resident", [1 << 26, 0])
def test_repeated_lines_equal_brute_force(spark, lined, monkeypatch, resident):
    monkeypatch.setattr(line_dedup, "KEYS_A_SHARD", 4)
    monkeypatch.setattr(line_dedup, "PROBES_A_TASK", 30)
    got = line_dedup.drop_repeated_lines(table(spark, lined).repartition(5), resident_bytes=resident)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_text"]
    want = plain_lines(lined)
    assert sorted((tuple(x) for x in got.collect()), key=str) == want
    assert sum(x[2] for x in want) > 100
    fewer = line_dedup.drop_repeated_lines(table(spark, lined), min_chars=12, min_docs=2, resident_bytes=resident)
    assert sorted((tuple(x) for x in fewer.collect()), key=str) == plain_lines(lined, 12, 2)


@pytest.mark.parametrize("resident", [1 << 26, 0])
def test_lines_of_empty_and_wordless_tables(spark, empty, resident):
    assert line_dedup.drop_repeated_lines(empty, resident_bytes=resident).count() == 0
    rows = [(1, None), (2, ""), (None, None)]
    got = line_dedup.drop_repeated_lines(table(spark, rows), resident_bytes=resident)
    assert sorted((tuple(x) for x in got.collect()), key=str) == plain_lines(rows)


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(1)
    for n in (1, 2, 63, 64, 65, 20_000):
        pairs = rng.integers(0, 1 << 64, (n, 2), np.uint64)
        pairs[: n // 3, 1] = 7  # equal fingerprints, other keys
        numbers = line_dedup.PerfectHash.over(pairs)(pairs)
        assert sorted(numbers.tolist()) == list(range(n))
        row = line_dedup.Shard.row(0, pairs, np.full(n, 5), np.arange(n))
        shard = line_dedup.Shard(row)
        assert not shard.falls(pairs, np.arange(n), 5).any()
        assert shard.falls(pairs, np.full(n, -1), 5).all() and not shard.falls(pairs, np.full(n, -1), 6).any()
        others = rng.integers(0, 1 << 64, (5000, 2), np.uint64)
        assert not shard.falls(others, np.full(5000, -1), 1).any()
        if n == 20_000:
            assert (len(row["words"]) + len(row["ranks"])) * 8 < 8 * n  # a few bits a key, ranks included


def plain_trie(sequences):
    """The nodes of (id, [(turn, size)]) by the definition: a dictionary of prefixes."""
    members, ends = defaultdict(list), defaultdict(list)
    sizes = {}
    for own, turns in sequences:
        for d in range(len(turns) + 1):
            prefix = tuple(t for t, _ in turns[:d])
            members[prefix].append(own)
            sizes[prefix] = turns[d - 1][1] if d else 0
        ends[tuple(t for t, _ in turns)].append(own)
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    leaves, saved, out = {}, {}, []
    for prefix in sorted(members, key=len, reverse=True):
        below = children[prefix]
        leaves[prefix] = sum(leaves[c] for c in below) or 1
        saved[prefix] = sum(saved[c] for c in below) + (len(members[prefix]) - 1) * sizes[prefix]
        ids = ",".join(map(str, sorted(i for i in ends[prefix] if i is not None)))
        up = least(members[prefix[:-1]]) if prefix else None
        row = (least(members[prefix]), len(prefix), up, len(members[prefix]), len(below), leaves[prefix], saved[prefix])
        out.append((*row, hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def spark_trie(spark, sequences):
    rows = [(own, [(hashlib.md5(t.encode()).digest(), s) for t, s in turns]) for own, turns in sequences]
    schema = "conv_id bigint, turns array<struct<digest: binary, size: int>>"
    nodes, ends = prefix_trie.prefix_trie(spark.createDataFrame(rows, schema))
    joined = nodes.join(prefix_trie.ends_digests(ends), "node", "left").drop("node").fillna(
        hashlib.sha256().hexdigest(), ["ends_sha256"]
    )
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(x) for x in joined.select(names).collect()), key=str)


def random_sequences(seed, n, letters="abc", longest=6):
    r = random.Random(seed)
    size = {c: 3 * i + 1 for i, c in enumerate(letters)}
    return [(i, [(c, size[c]) for c in r.choices(letters, k=r.randint(0, longest))]) for i in range(n)]


@pytest.mark.parametrize("a_task, fan_in", [(10_000, 16), (7, 3), (2, 2)])
def test_trie_equals_brute_force_however_it_is_cut(spark, monkeypatch, a_task, fan_in):
    monkeypatch.setattr(prefix_trie, "SEQUENCES_A_TASK", a_task)
    monkeypatch.setattr(prefix_trie, "FAN_IN", fan_in)
    monkeypatch.setattr(prefix_trie, "IDS_A_PIECE", 3)
    common = [("a", 1), ("b", 4), ("b", 4), ("c", 7), ("a", 1)]
    sequences = random_sequences(1, 60) + [(100 + i, common) for i in range(30)]
    sequences += [(200 + i, common * 8 + [("c", 7)] * i) for i in range(5)] + [(None, common[:2]), (300, [])]
    assert spark_trie(spark, sequences) == plain_trie(sequences)


@pytest.mark.parametrize("sequences", [
    [], [(5, [])], [(5, [("a", 1)])], [(None, [("a", 1), ("b", 2)])], [(4, [("a", 3)] * 300), (3, [("a", 3)] * 299)],
    [(7, [("b", 2)]), (7, [("b", 2)])],
])
def test_small_tries(spark, monkeypatch, sequences):
    monkeypatch.setattr(prefix_trie, "SEQUENCES_A_TASK", 1)
    assert spark_trie(spark, sequences) == plain_trie(sequences)


def test_rebuilt_conversations(spark):
    import zlib

    r = random.Random(2)
    rows = []
    for c in [None, *range(40), 63, 66]:
        for t in r.sample([None, *range(9)], r.randint(1, 10)):
            rows.append((c, t, r.choice(["user", "assistant", None]), r.choice(["x", "yé", "", None, "z" * 2000]), "extra", 1))
    rows += [(3, 1, "user", "x", "extra", 1)] * 2
    conversations = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, turns string, t int")
    digest = lambda a, b: hashlib.sha256(f"{len(a)}:{a}{b}".encode()).digest()[:16]
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        role, text = role or "", text or ""
        own[c].append((t is not None, t or 0, role, digest(role, text), len(text.encode())))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    want = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if c is not None else 0
        want[c] = (own.get(c - c % 5, [])[:h] if c is not None else []) + turns[h:]
    rebuilt = prefix_trie.with_shared_heads(prefix_trie.ordered_turns(conversations))
    assert {x.conv_id: [(bytes(t.digest), t.size) for t in x.turns] for x in rebuilt.collect()} == want


def plain_middle(doc, text):
    text = text or ""
    groups = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(groups[k : k + 8], 16) for k in range(0, 32, 8))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return (doc, n, "plain", None, None, text)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return (doc, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}")


def test_fill_in_middle_equals_brute_force(spark, docs, empty):
    r = random.Random(4)
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    alphabet = ["<", "P", "S", "M", ">", "$", "1", "\\", "\n", "\r", " ", "é", "😀", "é", "\0", "x"]
    rows += [(1000 + k, "".join(r.choices(alphabet, k=r.randint(0, 40)))) for k in range(300)]
    rows += [(2000 + k, "ab😀\n" * n) for k, n in enumerate((249, 250, 251, 500, 30_000))]
    rows += [(3000, "a<P>b"), (3001, "<S"), (3002, "M>" * 9)]
    got = fill_middle.transform(table(spark, rows)).withColumn(
        "back", fill_middle.restore(F.col("output"), F.col("form"))
    ).collect()
    assert sorted((tuple(x)[:6] for x in got), key=str) == sorted((plain_middle(*x) for x in rows), key=str)
    assert {x.form for x in got} == {"plain", "psm", "spm"}
    texts = sorted((str(d), t or "") for d, t in rows)
    assert sorted((str(x.doc_id), x.back) for x in got) == texts
    assert fill_middle.transform(empty).count() == 0


def test_units_of_their_own(spark):
    """Words as units: cuts fall between words."""
    rows = [(k, " ".join(f"w{i}" for i in range(k % 7 + 1)) + " ") for k in range(40)]
    got = fill_middle.transform(spark.createDataFrame(rows, "doc_id bigint, text string"), unit=r"[^ ]+ ").collect()
    assert all(x.n == x.doc_id % 7 + 1 for x in got)
    for x in got:
        if x.form == "psm":
            prefix, rest = x.output[3:].split("<S>")
            assert prefix.count(" ") == x.prefix_units and rest.split("<M>")[1].count(" ") == x.middle_units
