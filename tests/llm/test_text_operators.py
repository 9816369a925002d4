"""Operators 1, 4, 5, 7 and 8 on odd texts and against plain restatements."""

import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidemark.llm import language_id, pieces, quality, token_store, toxicity
from tidemark.llm.vocabularies import path


def plain_base(text):
    words = (text or "").encode().split()
    windows = list(zip(words, words[1:], words[2:]))
    twice = {w for w, n in Counter(windows).items() if n > 1}
    hit = {i + j for i, w in enumerate(windows) if w in twice for j in range(3)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


def test_quality_counts_and_verdicts(docs, empty):
    rows = quality.annotate(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    for r in docs.collect():
        q = by_id[r.doc_id]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == plain_base(r.text)
        assert q.base_failed == (q.n_words < 50 or 100 * q.n_repeat_words > 50 * q.n_words)
        assert not (q.base_failed and q.kept)
    assert by_id[1].kept is False or by_id[1].reason is None
    assert quality.annotate(empty).count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns


STEMS = ("green", "river", "stone", "light", "walk", "cloud", "winter", "harbour", "garden", "morning")
WORDS = [f"{a}{b}" for a in STEMS for b in ("s", "ing", "ed", "er", "ly", "ness", "ful", "able", "", "ish")]


def test_quality_bands_reject_by_each_measure(spark):
    """300 plain texts in each of two languages fit the bands; each kind of junk leaves the band of its measure."""
    foreign = [w[::-1] for w in WORDS]
    rows = [(i, "en", prose(i, 120 + i % 80, WORDS)) for i in range(300)]
    rows += [(1000 + i, "xx", prose(i, 120 + i % 80, foreign)) for i in range(300)]
    r = random.Random(1)
    letters = lambda n: "".join(r.choice("qxzjkvw") for _ in range(n))
    junk = {
        2000: ("en", " ".join(letters(7) for _ in range(120)), "chars_per_piece"),
        2001: ("en", " ".join("internationalization" + w for w in prose(1, 100, WORDS).split()), "chars_per_byte_token"),
        2002: (
            "en",
            " ".join(w + " \u16a0\u16b1" if i % 3 == 0 else w for i, w in enumerate(prose(2, 150, WORDS).split())),
            "piece_fallback",
        ),
        2003: ("en", " ".join(w if i % 2 else "|" for i, w in enumerate(prose(3, 300, WORDS).split())), "byte_fallback"),
        2004: (
            "en",
            " ".join(
                f"{a} {b} {c} again" for i, (a, b, c) in enumerate(zip(*[iter(prose(4, 150, WORDS[:4]).split())] * 3))
            ),
            "token_entropy",
        ),
        2005: ("xx", prose(5, 150, WORDS), "chars_per_piece"),
        2006: ("en", prose(6, 150, foreign), "chars_per_piece"),
    }
    table = spark.createDataFrame(
        [*rows, *[(i, lang, t) for i, (lang, t, _) in junk.items()]], "doc_id bigint, lang string, text string"
    )
    rules = quality.FertilityRules(max_repeat_percent=100)
    got = {x.doc_id: x for x in quality.annotate(table, rules=rules).collect()}
    assert sum(got[i].kept for i, _, _ in rows) >= 0.98 * len(rows)
    for i, (_, _, measure) in junk.items():
        assert measure in (got[i].reason or "").split(","), (i, got[i])
    kept = {x.doc_id for x in quality.keep_good(table, rules=rules).collect()}
    assert kept == {i for i, x in got.items() if x.kept}
    again = {x.doc_id: x.reason for x in quality.annotate(table.repartition(11), rules=rules).collect()}
    assert again == {i: x.reason for i, x in got.items()}
    assert again == plain_verdicts([x.asDict() for x in got.values()], rules)

    bands = quality.bands_of(table, rules=rules)
    few = table.where("doc_id % 7 = 0 or doc_id >= 2000")
    alone = {x.doc_id: x.reason for x in quality.annotate(few, rules=rules, bands=bands).collect()}
    assert alone == {i: again[i] for i in alone} and len(alone) < 100
    assert {x.doc_id for x in quality.keep_good(few, rules=rules, bands=bands).collect()} == {i for i, x in alone.items() if not x}


def plain_verdicts(rows, rules):
    """Reasons by the definition, from the measures: quartiles of each group, moved out; the first group with texts enough."""
    groups = {}
    for x in rows:
        if not x["base_failed"]:
            for key in {(x["script"], x["lang"]), (x["script"], None)}:
                groups.setdefault(key, []).append(x)
    bands = {}
    for key, members in groups.items():
        if len(members) >= rules.min_texts:
            bands[key] = own = []
            for m in quality.MEASURES:
                values = [np.floor(x[m] * 1000 + 0.5) / 1000 for x in members if x[m] is not None]
                fence, (low, high) = rules.fences[m], np.percentile(values, [25, 75])
                reach = max(rules.reach * (high - low), fence.least)
                own.append((low - reach if fence.below else -np.inf, high + reach if fence.above else np.inf))
    out = {}
    for x in rows:
        own = bands.get((x["script"], x["lang"])) or bands.get((x["script"], None)) or rules.wide[x["script"]]
        bad = [m for m, (a, z) in zip(quality.MEASURES, own) if x[m] is not None and not a <= x[m] <= z]
        out[x["doc_id"]] = "base" if x["base_failed"] else ",".join(bad) or None
    return out


def test_stretch_entropy():
    assert quality.stretch_entropy(np.arange(99)) is None
    assert quality.stretch_entropy(np.arange(100)) == pytest.approx(np.log2(100))
    assert quality.stretch_entropy(np.zeros(250, int)) == 0
    want = (np.log2(100) + 0 + (1 - 0) * 0) / 1
    assert quality.stretch_entropy(np.concatenate([np.arange(100), np.zeros(100, int)])) == pytest.approx(want / 2)


def test_scripts():
    assert quality.script_of("straße") == "latin"
    assert quality.script_of("привет мир") == "cyrillic"
    assert quality.script_of("漢字とかな") == "cjk"
    assert quality.script_of("123 !") == "none"


def untouched():
    """The library's own reading of the tokenizer file."""
    import tokenizers

    return tokenizers.Tokenizer.from_file(path("byte_bpe_50k.json"))


@pytest.mark.parametrize("special_as_text", [False, True])
def test_encoder_equals_library(special_as_text):
    encoder, library = token_store.Encoder(token_store.Tokenizer(special_as_text=special_as_text)), untouched()
    library.encode_special_tokens = special_as_text
    r = random.Random(5)
    alphabet = [*"ab c\n\t.,'s 12é漢 \x1c\x00<|>", "<|endoftext|>", " <|endoftext|>", "endoftext"]
    texts = ["hi <|endoftext|> yo", "<|endoftext|>", "x<|endoftext|>"]
    for text in [*texts, *("".join(r.choice(alphabet) for _ in range(r.randint(0, 14))) for _ in range(3000))]:
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        assert encoder.encode(text) == np.array(ids, "<u4").tobytes(), text
    assert untouched().encode(texts[0], add_special_tokens=False).ids == [5303, 220, 50256, 27406]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_store(spark, docs, empty, encoding):
    fmt = token_store.TokenFormat(encoding=encoding, page_rows=5)
    got = token_store.store_and_check(docs, fmt=fmt).orderBy("start").collect()
    library, start = untouched(), 0
    assert len(got) == docs.count() and got[0].doc_id is None
    for r, want in zip(got, docs.orderBy("doc_id", "text").collect()):
        ids = library.encode(want.text or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens) == (want.doc_id, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)
    assert token_store.store_and_check(empty).count() == 0


def test_token_store_selective_read(spark, docs, tmp_path):
    token_store.write_tokens(docs, str(tmp_path / "t"))
    counts = token_store.read_tokens(spark, str(tmp_path / "t"), ()).where("doc_id = 8")
    plan = counts._jdf.queryExecution().toString()
    assert "tokens" not in plan.split("ReadSchema: ")[1].split("\n")[0].replace("n_tokens", "")
    assert counts.count() == 1


def unigram_library(codec, file):
    """The sentencepiece library itself with the same pieces, our scores and the unigram model type."""

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def fields(data):
        at = 0

        def number():
            nonlocal at
            value = shift = 0
            while True:
                byte = data[at]
                at += 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return value

        while at < len(data):
            key = number()
            if key & 7 == 0:
                yield key, number()
            else:
                size = {5: 4, 1: 8}.get(key & 7) or number()
                yield key, data[at : at + size]
                at += size

    def put(key, value):
        return varint(key) + (
            varint(value) if key & 7 == 0 else value if key & 7 in (1, 5) else varint(len(value)) + value
        )

    out, n = b"", 0
    for key, value in fields(open(file, "rb").read()):
        if key >> 3 == 1:
            value = b"".join(put(k, struct.pack("<f", codec.scores[n]) if k >> 3 == 2 else v) for k, v in fields(value))
            n += 1
        elif key >> 3 == 2:
            value = b"".join(put(k, 1 if k >> 3 == 3 else v) for k, v in fields(value))
        out += put(key, value)
    return sentencepiece.SentencePieceProcessor(model_proto=out)


def test_viterbi_equals_library_and_brute_force():
    model = pieces.PieceModel()
    codec = pieces.PieceCodec(model)
    library = unigram_library(codec, model.file)
    texts = [prose(7, 200), "a  b\nc\t é ▁ 漢字", " x ", "", "▁▁a", "日本語 text\n\n", "unbelievable internationalization"]
    for text, ids in zip(texts, codec.encode_batch(texts)):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(text)
    score = {n: s for n, s in zip(codec.names, codec.scores)}

    def best(word):
        top = [0.0] + [-1e9] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(end):
                if word[start:end] in score:
                    top[end] = max(top[end], top[start] + score[word[start:end]])
        return top[-1]

    for word in ("▁river", "▁unbelievable", "▁thth"):
        codec.learn({word})
        assert sum(codec.scores[i] for i in np.frombuffer(codec.known[word], "<i4")) == pytest.approx(best(word))


def test_pieces_round_trip(docs, empty):
    rows = pieces.encode_documents(docs).collect()
    assert all(r.round_trip for r in rows) and len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.where("doc_id is not null and text is not null and doc_id <> 9").collect()}
    back = docs.where("doc_id is not null and text is not null and doc_id <> 9").select(
        "doc_id", pieces.decode(pieces.encode(F.col("text"))["ids"]).alias("t")
    ).collect()
    assert {r.doc_id: r.t for r in back} == texts
    assert pieces.encode_documents(empty).count() == 0


def test_language_identification(spark, docs, empty):
    langs = {"aa": ["kolo", "meki", "tuva", "rosi"], "bb": ["schra", "pfein", "zuld", "gech"]}
    rows = [(i, prose(i, 40, langs[lang]), lang) for i, lang in enumerate(["aa", "bb"] * 60)]
    table = spark.createDataFrame(
        [*rows, (900, None, "aa"), (901, "12 34", "bb"), (902, prose(1, 9, langs["aa"]), None)],
        "doc_id bigint, text string, lang string",
    )
    got = {r.doc_id: r for r in language_id.identify(table).collect()}
    assert len(got) == 123
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[902].lang_pred == "aa"
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.values())
    odd = language_id.identify(
        docs.withColumn("lang_pred", F.lit("clash")).withColumn("score", F.lit("clash"))
    ).collect()
    assert len(odd) == docs.count() and {r.lang_pred for r in odd if r.doc_id in (4, 5, 6)} == {"und"}
    assert len({(r.lang_pred, r.score) for r in odd if r.doc_id == 11}) == 1
    assert language_id.identify(empty).count() == 0
    unknown = language_id.identify(table.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}


def test_predictions_equal_brute_force(spark):
    """Prototypes, predictions and scores of every row by the definition, one n-gram after another."""
    r, space = random.Random(21), language_id.ProfileSpace(dimensions=128)
    sounds = {"aa": ["ka", "lo", "mi", "na"], "bb": ["stre", "ich", "ung", "ö"], "cc": ["вод", "ах", "ет"]}
    rows = []
    for k in range(60):
        lang = r.choice(list(sounds))
        text = " ".join("".join(r.choices(sounds[lang], k=r.randint(1, 3))) for _ in range(r.randint(1, 12)))
        rows.append((k, r.choice([text, text.upper(), f"1, {text}!"]), lang if r.random() < 0.8 else None))
    rows += [(60, None, "aa"), (61, "12 34", "bb"), (62, "a", "cc"), (63, "", None), (None, "kalo mina", "aa"), (5, "kalo", "aa")]
    rng = np.random.default_rng(space.seed)
    letters = (rng.integers(0, 2, (language_id.SLOTS + 1, 128), np.int8) * 2 - 1).astype(int)

    def bundle(text):
        slots = [ord(c) % language_id.SLOTS + 1 if c.isalpha() else 0 for c in f" {(text or '').lower()} "]
        slots = [x for i, x in enumerate(slots) if x or i == 0 or slots[i - 1]]
        out = np.zeros(128, int)
        for a, b, c in zip(slots, slots[1:], slots[2:]) if any(slots) else ():
            out += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
        return out, any(slots)

    learnt = {}
    for doc, text, lang in rows:
        v, found = bundle(text)
        if doc is not None and zlib.crc32(str(doc).encode()) % 3 != 1 and lang and text is not None and found and v.any():
            learnt[lang] = learnt.get(lang, 0) + np.rint(v * (1000 / np.linalg.norm(v)))
    want = []
    for doc, text, _ in rows:
        v, found = bundle(text)
        scores = {k: float(v @ p / np.linalg.norm(v) / np.linalg.norm(p)) if v.any() else 0.0 for k, p in learnt.items()}
        best = max(sorted(scores), key=lambda k: scores[k])
        held = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 1
        want.append((doc, held, best if found else "und", max(scores[best], 0.0) if found else 0.0))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    got = [(x.doc_id, x.held_out, x.lang_pred, x.score) for x in language_id.identify(table, space).collect()]
    order = lambda x: (str(x[0]), x[2], round(x[3], 4))
    for a, b in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-5


def test_equal_cosines_take_the_first_language(spark):
    text = prose(1, 40)
    table = spark.createDataFrame(
        [(i, text, lang) for i, lang in enumerate(["zz", "aa", "mm"] * 20)], "doc_id bigint, text string, lang string"
    )
    langs, prototypes = language_id.fit(table)
    prototypes[:] = prototypes[0]
    assert {r.lang_pred for r in language_id.predict(table, (langs, prototypes)).collect()} == {"aa"}


def test_bundle_is_the_definition():
    space = language_id.ProfileSpace(dimensions=64)
    p = language_id.Profiler(space)
    letters = np.random.default_rng(space.seed).integers(0, 2, (language_id.SLOTS + 1, 64), np.int8) * 2 - 1
    slot = lambda c: ord(c) % language_id.SLOTS + 1 if c.isalpha() else 0
    text = " ab ca "
    want = sum(
        np.roll(letters[slot(a)], 2) * np.roll(letters[slot(b)], 1) * letters[slot(c)]
        for a, b, c in zip(text, text[1:], text[2:])
    )
    assert np.array_equal(p.bundles(["Ab, cA!"])[0][0], want.astype(np.float32))


TOXIC = ["grumblefool", "snotworm"]


@pytest.fixture(scope="module")
def toxic_model(spark):
    rows, labels = [], []
    for i in range(600):
        text = prose(i, 40)
        if i % 5 == 0:
            words = text.split()
            words[3], words[20] = TOXIC[i % 2], TOXIC[1 - i % 2]
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxicity_held_out_accuracy(toxic_model):
    docs, labels = toxic_model
    got = toxicity.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 150 and all(r.predicted == r.toxic and r.predicted == int(r.score >= 0.7) for r in got)


def test_deobfuscation(toxic_model):
    docs, labels = toxic_model
    model = toxicity.fit(docs, labels)
    scorer = toxicity.Scorer(model)
    for noisy in NOISY:
        assert scorer.features(f"the river {noisy} walks")[0] > 0, noisy
    for clean in ("2024", "well-known", "mississippi", "e.g.", "a b c d", "sn ow ro", "to be or no"):
        assert scorer.features(clean)[0] == 0, clean


NOISY = (
    "gruMbl3f00l", "snotw0rmmmm", "s-n-o-t-w-o-r-m", "s n o t w o r m", "5n0tw0rm!", "grumblef*ol", "sn ot wo rm",
    "s  n\to\nt w o r m", "a s n o t w o r m", "$n0tw0rm", "gr|umbl3fool", "ssssnotworm1",
)


#: Disguised from the first letters on, so that no beginning of a lexicon word shows.
HIDDEN = (
    "s-n-o-t-w-o-r-m",
    "s n o t w o r m",
    "5n0tw0rm!",
    "sn ot wo rm",
    "$n0tw0rm",
    "6rumb1ef00l",
    "gr|umbl3fool",
    "s.n.o.t.w.0.r.m",
)


def test_restoration_alone_decides(spark, toxic_model):
    """Texts whose only toxic words are disguised: caught with restoration, none without, and no clean text is hit."""
    docs, labels = toxic_model
    rows = []
    for i in range(240):
        words = prose(5000 + i, 40).split()
        if i % 2:
            words[5:5] = [HIDDEN[i // 2 % len(HIDDEN)]]
            words[25:25] = [HIDDEN[i // 2 * 3 % len(HIDDEN)]]
        rows.append((i, " ".join(words)))
    planted = spark.createDataFrame(rows, "doc_id bigint, text string")
    caught = {}
    for restoration in (True, False):
        model = toxicity.fit(docs, labels, toxicity.ToxicityRules(restoration=restoration))
        got = planted.select("doc_id", toxicity.score(F.col("text"), model).alias("s")).collect()
        assert not [r for r in got if r.doc_id % 2 == 0 and r.s >= 0.7]
        caught[restoration] = sum(r.s >= 0.7 for r in got if r.doc_id % 2) / 120
    print("restored", caught)
    assert caught[True] >= 0.95 and caught[False] == 0


def test_more_evidence_never_lowers_the_score(toxic_model):
    docs, labels = toxic_model
    model = toxicity.fit(docs, labels)
    assert all(w >= 0 for w in model.calibration[1:])
    base, scorer = prose(1, 60).split(), toxicity.Scorer(model)
    before = scorer.features(" ".join(base))
    for k in range(1, 6):
        after = scorer.features(" ".join(base + [TOXIC[j % 2] for j in range(k)]))
        assert all(a >= b for a, b in zip(after, before))
        before = after


def test_contradicting_labels_are_toxic(spark, toxic_model):
    docs, labels = toxic_model
    doubled = labels.unionByName(labels.where("toxic = 1").withColumn("toxic", F.lit(0)))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, doubled.repartition(9))
    assert a.lexicon == b.lexicon and a.calibration == pytest.approx(b.calibration)


def test_trigrams_are_the_definition():
    counter = toxicity.TrigramCounter()
    counter.add(["Ab, ab\nx", None or "漢字abc d1e"])
    want = Counter()
    for word in ("ab", "ab", "x", "\u2e80\u2e80abc"):
        padded = f"^^{word}$"
        want.update(padded[i : i + 3] for i in range(len(padded) - 2))
    want.update(["^^d", "^^d"][:0])
    assert counter.grams() == want


def test_viterbi_restores_the_best_path(toxic_model):
    docs, labels = toxic_model
    model = toxicity.fit(docs, labels)
    paths = [("", 0.0)]
    for ways in toxicity.lattice("sn0tw0rm"):
        paths = [(text + letters, cost + c) for text, cost in paths for letters, c in ways]
    def total(text, cost):
        padded = f"^^{text}$"
        return sum(model.trigrams.get(padded[i : i + 3], model.floor) for i in range(len(padded) - 2)) - cost

    best = max(paths, key=lambda p: total(*p))[0]
    assert toxicity.restore("sn0tw0rm", model) == best == "snotworm"


def test_toxicity_edges(spark, docs, empty, toxic_model):
    labels = toxic_model[1]
    got = toxicity.classify(docs.withColumn("predicted", F.lit("clash")), labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert all(r.predicted == 0 for r in toxicity.classify(docs, none).collect())
    assert toxicity.classify(empty, labels).count() == 0
    kept = toxicity.keep_clean(docs, toxicity.fit(toxic_model[0], labels))
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert path("piece_bpe_32k.model").endswith("piece_bpe_32k.model")
