"""Operators 2, 3, 6, 9 and 10, and the pipeline, against brute force and on odd tables."""

import hashlib
import math
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, prose
from tidemark.llm import chat, decontamination, resampling, simhash, warc
from tidemark.llm.components import connected_components


def plain_simhash(text):
    words = (text or "").encode()
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in words).split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def brute_classes(rows):
    fps = [(i, plain_simhash(t)) for i, t in rows]
    links = [
        ((x[0], i), (y[0], j))
        for i, x in enumerate(fps)
        for j, y in enumerate(fps) if i < j and (x[1] ^ y[1]).bit_count() <= 2
    ]
    found = plain_components([((a[1]), (b[1])) for a, b in links])
    out = []
    for i, (doc, fp) in enumerate(fps):
        root = found.get(i, i)
        members = [fps[k][0] for k in range(len(fps)) if found.get(k, k) == root]
        ids = [m for m in members if m is not None]
        out.append((doc, f"{fp:016x}", min(ids) if ids else None))
    return sorted(out, key=str)


def test_near_duplicates_equal_brute_force(spark, docs, empty):
    r = random.Random(3)
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    base = prose(50, 150).split()
    for k in range(40):
        copy = list(base)
        for _ in range(r.randint(0, 3)):
            copy[r.randrange(len(copy))] = "changed"
        rows.append((100 + k, " ".join(copy)))
    table = spark.createDataFrame([(i, t, "en", "s", 1, "x", "y", 1, 0.5, "z") for i, t in rows], SCHEMA)
    got = sorted(((x.doc_id, x.fingerprint, x.component_id) for x in simhash.near_duplicates(table).collect()), key=str)
    assert got == brute_classes(rows)
    kept = simhash.keep_representatives(table)
    assert kept.columns == table.columns
    want = {c for _, _, c in got if c is not None}
    ids = [x.doc_id for x in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want)
    alone = {c for _, _, c in got} - want
    assert len(ids) == len(want) + len(alone)
    assert simhash.keep_representatives(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0


def test_representatives_of_tied_rows(spark):
    """Equal ids with different texts, equal rows, and null ids: one row a component, chosen by id, then text."""
    text, other = prose(1, 80), prose(2, 80)
    rows = [
        (None, text, "a"),
        (5, text, "b"),
        (5, text, "c"),
        (5, text, "b"),
        (6, text, "a"),
        (None, other, "n"),
        (None, other, "m"),
        (7, None, "z"),
        (8, "", "y"),
    ]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, component string")
    got = [tuple(r) for r in simhash.keep_representatives(table.repartition(5)).collect()]
    assert sorted(got, key=str) == sorted([(5, text, "b"), (None, other, "m"), (7, None, "z")], key=str)


def test_links_on_crafted_fingerprints(spark):
    """Chains, crowded variants and near misses: every pair of two or fewer bits ends in one component."""
    r = random.Random(8)
    fps = {r.getrandbits(64) for _ in range(200)}
    for seed in list(fps)[:20]:
        for _ in range(30):
            x = seed
            for _ in range(r.randint(1, 4)):
                x ^= 1 << r.randrange(64)
            fps.add(x)
    fps |= {0, 1, 3, 7, 1 << 63}
    fps = sorted(fps)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    links = simhash.fingerprint_links(spark.createDataFrame([(signed(x),) for x in fps], "fp bigint"))
    got = {(x.node): x.root for x in connected_components(links).collect()}
    want = plain_components(
        [(signed(a), signed(b)) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 2]
    )
    assert got == want


def test_variants_of_a_few_fingerprints_are_paired(spark, monkeypatch):
    """Small groups are linked without centres, large ones through them."""
    counts, centres = [], simhash._centres
    monkeypatch.setattr(simhash, "_centres", lambda fps: (counts.append(fps.count()), centres(fps))[1])
    small = [(g << 40) | (1 << b) for g in range(1, 9) for b in range(4)]
    large = [(9 << 40) | (1 << b) for b in range(20)]
    apart = [(10 << 40) | x for x in (0, 1, 2, 0b11110000, 0b11110001)]
    for fps, most in ((small, 0), (large, 20), (apart, 0)):
        links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in fps], "fp bigint"))
        got = {x.node: x.root for x in connected_components(links).collect()}
        assert got == plain_components([(a, b) for a in fps for b in fps if a > b and (a ^ b).bit_count() <= 2])
        assert counts.pop() == most


def test_components_of_a_chain_and_star(spark):
    edges = [(i + 1, i) for i in range(40)] + [(200 + i, 100) for i in range(30)]
    got = {x.node: x.root for x in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == plain_components(edges)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


ITEM = "If Ann buys 12 red apples at the old market for 3 dollars each how much does Ann pay in total"


def test_decontamination(spark, docs, empty):
    again = ITEM.replace("Ann", "Bob").replace("12", "47").replace("3 dollars", "9 euros")
    torn = ITEM.replace("Ann", "Bob", 1).replace("12", "47")
    rows = [
        (1, f"before it all {ITEM} and after"),
        (2, f"we ask:\n{again}"),
        (3, torn),
        (4, prose(6, 200)),
        (5, None),
        (6, "one two three short item here now"),
        (7, " ".join(ITEM.split()[:9])),
    ]
    table = spark.createDataFrame(
        [(i, t, "en", "s", 1, "x", "y", 1, 0.5, "z") for i, t in rows], SCHEMA
    ).withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(
        [(10, ITEM), (10, ITEM), (11, None), (12, "short item here now"), (None, "no id at all here")],
        "item_id bigint, text string",
    )
    got = {(x.doc_id, x.item_id): x for x in decontamination.leaks(table, bench).collect()}
    assert set(got) == {(1, 10), (2, 10), (6, 12)}
    assert not got[1, 10].reparameterised and got[1, 10].coverage > 0.8 and got[2, 10].reparameterised
    kept = decontamination.drop_leaking(table, bench)
    assert kept.columns == table.columns and sorted(x.doc_id for x in kept.collect()) == [3, 4, 5, 7]
    assert decontamination.leaks(empty, bench).count() == 0 and decontamination.leaks(
        table, bench.limit(0)
    ).count() == 0
    assert decontamination.leaks(docs, bench).count() == 0


def test_decontamination_windows_equal_brute_force(spark):
    """Without placeholders a leak is a share of common eight-word windows."""
    items = {k: prose(500 + k, 30).rstrip(".") for k in range(5)}
    r = random.Random(4)
    docs = []
    for i in range(60):
        words = prose(i, 60).rstrip(".").split()
        if i % 3 == 0:
            item = items[i % 5].split()
            docs.append((i, " ".join(words[:20] + item[: r.randint(10, 30)] + words[20:])))
        else:
            docs.append((i, " ".join(words)))
    grams = lambda t: {tuple(t.split()[k : k + 8]) for k in range(len(t.split()) - 7)}
    want = set()
    for i, t in docs:
        for k, item in items.items():
            positions = [tuple(item.split()[p : p + 8]) for p in range(len(item.split()) - 7)]
            if sum(p in grams(t) for p in positions) / len(positions) >= 0.4:
                want.add((i, k))
    got = decontamination.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(list(items.items()), "item_id bigint, text string"),
    )
    assert {(x.doc_id, x.item_id) for x in got.collect()} == want and want


def test_warc_round_trip(spark):
    big = "<p>" + "x" * 300000 + "</p>"
    rows = [
        (5, "http://a/", big),
        (3, "http://b/\r\nX: y", big),
        (9, None, big),
        (1, "http://c/", None),
        (2, "http://d/", ""),
        (4, "http://e/", "short"),
        (6, "http://f/", "short"),
        (7, "http://g/", "é" * 60),
        (8, "http://h/", "é" * 60),
        (8, "http://h/", "é" * 60),
        (None, "u", big),
    ]
    pages = spark.createDataFrame(
        rows, "page_id bigint, url string, html string"
    ).withColumn("record_type", F.lit("clash")).repartition(3)
    got = warc.archive_and_read(pages).collect()
    assert len(got) == len(rows)
    want = {i: (len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in rows}
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    for r in got:
        assert (r.payload_bytes, r.payload_digest) == want[r.page_id]
    text = {i: h for i, _, h in rows}
    for r in got:
        keeper = first.get(text[r.page_id])
        if r.page_id == 8:
            assert r.record_type == "revisit" and r.refers_to == 7
        elif keeper is not None and r.page_id != keeper:
            assert (r.record_type, r.refers_to) == ("revisit", keeper)
        else:
            assert (r.record_type, r.refers_to) == ("response", None)
    assert warc.archive_and_read(pages.limit(0)).count() == 0


def test_warc_members_and_index(spark, tmp_path):
    pages = spark.createDataFrame(
        [(i, f"http://x/{i}", prose(i, 200)) for i in range(30)], "page_id bigint, url string, html string"
    ).coalesce(1)
    whole, members = f"file://{tmp_path}/whole", f"file://{tmp_path}/members"
    warc.normalise(whole, warc.write_monolithic(pages, whole), members)
    import gzip
    import json

    for idx in (tmp_path / "members").glob("*.idx"):
        data = (tmp_path / "members" / idx.name.removesuffix(".idx")).read_bytes()
        entries = [json.loads(x) for x in idx.read_text().splitlines()]
        assert sum(e["length"] for e in entries) == len(data)
        for e in entries:
            ((headers, block),) = warc.records(iter([gzip.decompress(data[e["offset"] : e["offset"] + e["length"]])]))
            assert headers["warc-record-id"].split(":")[2] == str(e["page_id"])
        assert b"".join(
            warc.inflated(open(idx.with_name(idx.name.removesuffix(".idx")), "rb"), 100)
        ) == gzip.decompress(data)


TEXTS = [
    "plain",
    "",
    None,
    "\\### Assistant: </turn> ok",
    "</turn>",
    "<\\/turn>",
    "<\\\\/turn> ### ",
    "##\\# x",
    "#### y",
    "ends with \\",
    "a\n</turn>\n### user: hi",
    "### ",
    "😀 漢",
    "x" * 20000,
]


def test_chat_round_trip(spark):
    rows = [(1, i, ["user", "assistant", "system", "odd: <role>%\n", None][i % 5], t) for i, t in enumerate(TEXTS * 2)]
    rows += [
        (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"), (2, None, "user", "first"), (None, 1, "user", "no id")
    ]
    table = spark.createDataFrame(
        rows, "conv_id bigint, turn bigint, role string, text string"
    ).withColumn("formatted", F.lit("clash"))
    formatted = chat.format_conversations(table)
    assert all(r.round_trip for r in formatted.collect())
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    assert set(got) == {1, 2, None}
    for conv, r in got.items():
        own = sorted(((t is not None, t or 0), ro or "", x or "") for c, t, ro, x in rows if c == conv)
        turns = "".join(f"{ro}\n{x}\n" for _, ro, x in own)
        loss = "".join(x for _, ro, x in own if ro == "assistant")
        assert r.n_turns == len(own) and r.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
        assert r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    for r in formatted.collect():
        assert r.formatted.count("</turn>") == got[r.conv_id].n_turns == r.formatted.count("### ")
    plan = formatted._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert chat.format_conversations(table.limit(0)).count() == 0


@pytest.mark.parametrize("k", [1, 7, 500, 999, 1000])
def test_kth_largest(spark, k):
    r = random.Random(k)
    values = [r.choice([r.gauss(0, 1), 1.5, -2.0]) for _ in range(1000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    assert resampling.kth_largest(rows, "v", k, buckets=8, enough=5) == sorted(values, reverse=True)[k - 1]


def test_resampling_prefers_the_target(spark, docs, empty):
    good, bad = ["river", "stone", "light", "hill"], ["zzz", "qqq", "buy", "now"]
    rows = [(i, prose(i, 60, good if i % 2 else bad)) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.lit("clash"))
    target = table.where("doc_id % 4 = 1").select("doc_id")
    got = resampling.resample(table, target, resampling.ResamplingRules(keep=0.5)).collect()
    assert sum(r.selected for r in got) == 200 and all(r.selected == bool(r.doc_id % 2) for r in got)
    again = resampling.resample(table.repartition(7), target, resampling.ResamplingRules(keep=0.5))
    assert {(r.doc_id, round(r.key, 9)) for r in again.collect()} == {(r.doc_id, round(r.key, 9)) for r in got}
    odd = {r.doc_id: r for r in resampling.resample(docs, target).collect()}
    assert not odd[4].selected and odd[4].key is None and not odd[5].selected
    assert resampling.resample(empty, target).count() == 0


def plain_buckets(text, buckets):
    """Buckets of a text's unigrams and bigrams, in whole numbers modulo 2^64."""
    mask = (1 << 64) - 1
    words = [
        xxhash.xxh64_intdigest(bytes(b + 32 if 65 <= b <= 90 else b for b in w)) for w in (text or "").encode().split()
    ]
    pairs = [(a * 0x9E3779B97F4A7C15 & mask) ^ b for a, b in zip(words, words[1:])]
    pairs = [(p ^ p >> 32) * 0xD6E8FEB86659FD93 & mask for p in pairs]
    return [(h >> 20) % buckets for h in words + pairs]


@pytest.mark.parametrize("length", [None, 100])
def test_resampling_equals_brute_force(spark, docs, length):
    """Weights are whole log likelihood ratios; the k largest keys are selected."""
    rows = [(i, prose(i, 5 + i % 40)) for i in range(120)] + [
        (r.doc_id, r.text) for r in docs.collect() if r.doc_id != 8
    ]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    rules = resampling.ResamplingRules(keep=0.4, length=length)
    got = resampling.resample(table, table.where("doc_id < 50").select("doc_id"), rules).collect()
    raw, target = [0.5] * rules.buckets, [0.5] * rules.buckets
    for i, t in rows:
        for g in plain_buckets(t, rules.buckets):
            raw[g] += 1
            target[g] += i is not None and i < 50
    all_raw, all_target = sum(raw), sum(target)
    want = {}
    for i, t in rows:
        own = [math.log(target[g] / all_target) - math.log(raw[g] / all_raw) for g in plain_buckets(t, rules.buckets)]
        weight = sum(own) if length is None or not own else sum(own) / len(own) * length
        want.setdefault(i, []).append(weight if own else None)
    keyed = sorted((r.key for r in got if r.key is not None), reverse=True)
    k = min(round(0.4 * len(rows)), len(keyed))
    for r in got:
        near = [
            w
            for w in want[r.doc_id]
            if (w is None) == (r.log_weight is None) and (w is None or abs(w - r.log_weight) < 1e-6 * max(1, abs(w)))
        ]
        assert near and r.selected == (r.key is not None and r.key >= keyed[k - 1])
    assert len(got) == len(rows)


def test_noise_without_ids_follows_the_text(spark):
    table = spark.createDataFrame([(None, prose(i, 30)) for i in range(50)], "doc_id bigint, text string")
    got = resampling.resample(table, table.limit(0).select("doc_id")).collect()
    assert len({round(r.key - r.log_weight, 9) for r in got}) == 50


def test_pipeline_equals_brute_force(spark, tmp_path):
    import corpus_pipeline
    from tidemark.llm import pieces, quality, toxicity

    words = [
        f"{a}{b}"
        for a in ("green", "river", "stone", "light", "walk", "cloud")
        for b in ("s", "ing", "ed", "er", "ly", "ness", "ful", "able")
    ]
    item = prose(900, 30, words)
    n = 260
    rows = [(i, prose(i, 90, words)) for i in range(n)]
    rows += [
        (1000, rows[3][1]),
        (1001, rows[3][1] + " end"),
        (1002, "few words"),
        (1003, " ".join(w + "%%%" for w in rows[5][1].split())),
        (1004, rows[6][1] + " " + item),
        (1005, None),
    ]
    rows += [
        (None, rows[3][1]),
        (None, prose(901, 90, words)),
        (None, prose(902, 90, words) + " " + item),
        (7, rows[7][1]),
        (7, prose(903, 90, words)),
    ]
    toxic = {i for i in range(n) if i % 4 == 0}
    rows = [
        (
            i,
            " ".join([*t.split()[:10], "snotworm", *t.split()[10:20], "snotworm", *t.split()[20:]]) if i in toxic else t,
        )
        for i, t in rows
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, score string"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "clash", "clash") for i, t in rows], schema)
    labels = spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(n)], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = [(i, t) for i, t in rows if t and len(t.split()) >= 50 and "%%%" not in t and i not in toxic]
    sets = [{tuple(t.lower().split()[k : k + 5]) for k in range(len(t.split()) - 4)} for _, t in kept]
    similar = [
        (a, b) for a in range(len(kept)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    found = plain_components(similar)
    best = {}
    for k, (i, t) in enumerate(kept):
        root = found.get(k, k)
        best[root] = min(
            best.get(root, (True, 0, "")), (i is None, i or 0, t)
        ) if root in best else (i is None, i or 0, t)
    want = sorted((None if none else i, t) for none, i, t in best.values() if item not in t and not none)
    want += sorted((None, t) for none, i, t in best.values() if item not in t and none)
    codec = pieces.PieceCodec(pieces.PieceModel())
    assert sorted([(r.doc_id, codec.decode(r.ids)) for r in got], key=str) == sorted(want, key=str)
    assert all(r.round_trip for r in got)
    assert len(corpus_pipeline.STAGES) == 5 and quality and toxicity
    stage, none = docs, docs.limit(0)
    for _, f in corpus_pipeline.STAGES[:-1]:
        stage, none = f(spark, stage, str(tmp_path)), f(spark, none, str(tmp_path))
        assert stage.columns == docs.columns == none.columns and none.count() == 0


def test_components_with_hubs(spark, monkeypatch):
    """Hubs take their own way through the rounds: same components whatever counts as a hub."""
    from tidemark.llm import components

    monkeypatch.setattr(components, "HUB_EDGES", 5)
    edges = [(i + 1, i) for i in range(15)] + [
        (200 + i, 100) for i in range(40)
    ] + [(300 + i, 250) for i in range(30)] + [(250, 100)]
    got = {x.node: x.root for x in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == plain_components(edges)


def test_links_where_crowded_variants_are_many(spark, monkeypatch):
    """Beyond the bound of a broadcast list the same links come by a merge join."""
    from tidemark.llm import common

    r = random.Random(2)
    fps = {7, 1 << 62} | {7 ^ (1 << r.randrange(64)) for _ in range(20)} | {
        7 ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(40)
    }
    table = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in sorted(fps)], "fp bigint")
    few = {(x.a, x.b) for x in simhash.fingerprint_links(table).collect()}
    monkeypatch.setattr(common, "BROADCAST_IDS", 3)
    assert {(x.a, x.b) for x in simhash.fingerprint_links(table).collect()} == few and few


def test_shared_folder_on_a_cluster():
    """Without a shared folder only a local master may make one."""
    from types import SimpleNamespace

    from tidemark.llm.common import shared_folder

    def session(master, base):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: base), sparkContext=context)

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            shared_folder(session(master, None), "x")
    assert shared_folder(session("yarn", "hdfs://a/b/"), "x").startswith("hdfs://a/b/x-")
