"""Leaks of items that are rich in placeholders, begin sentences with names, or have changed values."""

import random

from tidemark.llm import decontamination


def found(spark, docs, items):
    rows = decontamination.leaks(
        spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string"),
        spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string"),
    )
    return {(x.doc_id, x.item_id) for x in rows.collect()}


def test_items_with_few_literal_words(spark):
    items = ["What is 15 % of 80 ?", "Convert 5 km to m.", "A 5 km run takes 30 minutes at 10 km / h"]
    docs = [
        *[f"Some words before it. {x} And some after it." for x in items],
        "Some words. What is 20 % of 80 ? And Convert 6 km to m. too",
    ]
    docs += ["Some words. What is 20 $ of 80 ? And Convert 6 kg to g. too", "we convert 5 km to 7 m and more"]
    assert found(spark, docs, items) == {(0, 0), (1, 1), (2, 2), (3, 0), (3, 1)}


def test_number_heavy_items(spark):
    items = ["What is 12 km plus 30 km plus 45 km minus 7 km in m", "3 5 8 13 21 34 55 89 144"]
    docs = [
        f"so {items[0]} then",
        f"so {items[1]} then",
        items[0].replace("30", "31").replace("45", "77"),
        "3 5 8 13 22 34 55 90 144",
        items[0].replace("km", "mi"),
    ]
    assert found(spark, docs, items) == {(0, 0), (1, 1), (2, 0)}


def test_items_of_one_or_two_words(spark):
    items = ["Grumblefool", "The river"]
    docs = [
        "before\ngrumblefool!\nafter",
        "a grumblefool in a line",
        "The river",
        "over\n  the  river \nand",
        "the river sings",
        "River the",
    ]
    assert found(spark, docs, items) == {(0, 0), (2, 1), (3, 1)}


def test_repeated_windows_stay_linear(spark):
    """A text of one repeated sentence against an item of the same: one row per window, not per pair of places."""
    line = "please pay 5 dollars to the man at the door now "
    rules = decontamination.TemplateRules()
    templates = decontamination.Templates(rules, [rules.window])
    long = line * 3000
    templates.learn(set(long.split()))
    assert len(templates.windows(long)) <= len(line.split()) * 2
    assert found(spark, [long, line * 2, "nothing of it here at all in this text"], [line * 4]) == {(0, 0), (1, 0)}


def test_texts_are_judged_row_by_row(spark):
    item = "the quiet river walks over green stones before the morning light comes again"
    rows = [
        (None, f"x {item} y"), (None, "clean text"), (7, f"y {item}"), (7, "another clean text"), (8, None), (9, "")
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = decontamination.drop_leaking(docs, spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [
        (0, "clean text"), (7, "another clean text"), (8, ""), (9, "")
    ]


def test_names_that_begin_sentences(spark):
    item = "Maria has 12 apples. Maria eats 3 of them. How many remain?"
    docs = [
        "We ask. Ahmed has 40 apples. Ahmed eats 7 of them. How many remain? That is all.",
        "We ask. Ahmed has 40 pears. Ahmed sells 7 of them. How much remains? That is all.",
    ]
    assert found(spark, docs, [item]) == {(0, 0)}


def test_conflicting_values(spark):
    item = "a farmer sells 12 red apples at the old market and then keeps 12 green pears for the long cold winter while the children count all baskets"
    merged = "a baker moves 3 loaves from the first shelf to the top and 4 rolls from the second shelf to the floor"
    docs = [
        f"so {item.replace('12', '13', 1)} it was",
        f"so {merged.replace('3', '5').replace('4', '5')} it was",
        f"so {item.replace('12', '13', 1).replace('a farmer', 'a man')} it was",
    ]
    assert found(spark, docs, [item, merged]) == {(0, 0), (1, 1), (2, 0)}


def leaked(spark, docs, items):
    """(doc_id, item_id, coverage) of (id, text) rows."""
    rows = decontamination.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    return sorted(((x.doc_id, x.item_id, round(x.coverage, 6)) for x in rows.collect()), key=str)


def test_number_words_and_compound_names(spark):
    """Number words of any size, hyphened ones, names with capitals inside, joined names and initials are slots."""
    items = [
        (1, "There is one bag that holds 12 marbles and seventy-five boxes stand on the long wooden table outside today."),
        (2, "In the morning McDonald gave Anne-Marie some of the old coins that J. O'Brien had left on the shelf."),
    ]
    docs = [
        (1, "There is two bag that holds 40 marbles and nineteen boxes stand on the long wooden table outside today."),
        (2, "In the morning MacArthur gave Jean-Luc some of the old coins that K. Miller had left on the shelf."),
        (3, "In the morning someone gave nobody any of the new coins that he had lost in the long grass there."),
    ]
    assert leaked(spark, docs, items) == [(1, 1, 1.0), (2, 2, 1.0)]
    kind = lambda w: decontamination.Templates.attribute(w)[1:4]
    assert kind("J.") == (0, True, False) and kind("twenty-one,") == (1, False, False)
    assert [kind(w)[1] for w in ("NASA", "McDonald", "Anne-Marie", "O'Brien", "Ünal", "x-ray", "III", "I")] == [
        False, True, True, True, True, False, False, False
    ]


def test_preambles_that_many_items_share(spark, monkeypatch):
    """Windows of more items than ``SHARED`` are looked up for candidates only, and every result stays the same."""
    words = lambda seed, n: [f"w{seed}x{i}" for i in range(n)]
    preamble = words("p", 12)
    items = [(k, " ".join(preamble + words(k, 14))) for k in range(30)] + [(99, " ".join(preamble + ["tail"] * 2))]
    docs = [(k, " ".join(preamble + words(k, 14))) for k in range(5)]
    docs += [(10, " ".join(preamble)), (11, " ".join(words(7, 14) + preamble)), (None, " ".join(["x"] + preamble + words(8, 14)))]
    docs += [(12, " ".join(preamble + ["y"] + words(9, 9))), (13, " ".join(preamble + ["tail", "tail"] + ["z"] * 30))]
    want = leaked(spark, docs, items)
    assert {(d, i) for d, i, _ in want} >= {(11, 7), (10, 99), (None, 8), (0, 0)}
    monkeypatch.setattr(decontamination, "SHARED", 5)
    assert leaked(spark, docs, items) == want


NAMES = ["Maria", "Ahmed", "Wei", "Olga", "Pedro"]
WORDS = "the of a then takes bag red apples river walks and gives stone to old house garden bread".split()
COUNTS, MEASURES = ["3", "12", "40", "seven", "1,200"], ["km", "kg", "hours", "%"]


def plain_tokens(text):
    """(core, kind, name that begins a sentence) of every word, by the rules: 0 literal, 1 number, 2 name, 3 unit."""
    out = []
    for line in text.split("\n"):
        begins = True
        for word in line.split():
            core = word.rstrip(".,")
            counted = 1 if core.lower() in COUNTS else 3 if core.lower() in MEASURES else 0
            named = not counted and len(core) > 1 and core[0].isupper()
            kind = counted or (2 if named and not begins else 0)
            common = core.lower() in decontamination.COMMON
            out.append((core.lower(), kind, named and begins and not common))
            begins = word.endswith(".")
    return out


def plain_windows(text, sizes):
    """(position, key, slots, rich, reading) of a text's windows; of equal key, slots and reading the first."""
    tokens, out = plain_tokens(text), {}
    for size in sizes:
        for p in range(len(tokens) - size + 1):
            part = tokens[p : p + size]
            enough, literal = min(5, size - 1), sum(k == 0 for _, k, _ in part)
            mark = lambda shown: tuple(k if k in shown else c for c, k, _ in part)
            values = lambda shown: tuple((k, c) for c, k, _ in part if k in shown)
            found = []
            if literal >= enough:
                found.append((p, (size, mark({1, 2, 3})), values({1, 2, 3}), True, 0))
            elif size - sum(k == 1 for _, k, _ in part) >= enough:
                found.append((p, (size, "numbers", mark({1})), values({1}), True, 2))
            else:
                found.append((p, (size, "exact", mark(())), (), False, 3))
            initial = sum(i for *_, i in part)
            if initial and literal - initial >= enough:
                part = [(c, 2 if i else k, i) for c, k, i in part]
                found.append((p, (size, mark({1, 2, 3})), values({1, 2, 3}), True, 1))
            for w in found:
                out.setdefault((w[1], w[2], w[4]), w)
    return list(out.values())


def plain_leaks(docs, items):
    """The result by the definition: every alignment of every pair, its values, and the places that are left."""
    sizes = [8] + sorted({n for _, t in items if 3 <= (n := len(t.split())) < 8})
    result = []
    for item, text in items:
        n = len(text.split())
        own = plain_windows(text, [n if n < 8 else 8])
        ours = {}
        for p, key, slots, _, reading in own:
            first, at = ours.get((key, reading), ((p, slots), set()))
            ours[key, reading] = (min(first, (p, slots)), at | {p})
        rich_places = {p for p, _, _, rich, _ in own if rich}
        places = {p for p, *_ in own}
        for doc, body in docs:
            hits = [
                (p - first[0], (reading, theirs), key, slots, first[1], frozenset(at), rich)
                for p, key, slots, rich, reading in plain_windows(body, sizes)
                for (other, theirs), (first, at) in ours.items() if other == key
            ]
            values = {}
            for shift, way, _, slots, mine, _, _ in hits:
                for x, y in zip(mine, slots):
                    values.setdefault((shift, way), {}).setdefault(x, set()).add(y)
            torn = {a: v for a, v in values.items() if sum(len(y) > 1 for y in v.values()) > 0.2 * len(v)}
            edited = {a for a, v in torn.items() if all(x in y for x, y in v.items())}
            once = {}
            for shift, way, key, slots, mine, at, rich in hits:
                if (shift, way) not in torn or (shift, way) in edited and slots == mine:
                    other, known = once.get((key, at), (True, False))
                    once[key, at] = (other and slots != mine, known or rich)
            matched = {p for _, at in once for p in at}
            rich_matched = {p for (_, at), (_, rich) in once.items() if rich for p in at}
            share = max(len(matched) / len(places), len(rich_matched) / len(rich_places) if rich_places else 0)
            if share >= 0.4:
                changed = any(other for other, _ in once.values())
                result.append((doc, item, len(matched), len(places), round(share, 9), changed))
    return sorted(result)


def test_templates_and_slots_equal_a_plain_restatement(spark):
    """Random items full of names, numbers and units, re-parameterised well and badly, edited, cut and mixed into prose."""
    r = random.Random(17)
    draw = lambda: r.choice(r.choices([WORDS, NAMES, COUNTS, MEASURES], [10, 2, 2, 1])[0])

    def sentence(n):
        words = [draw() for _ in range(n)]
        return [words[0][0].upper() + words[0][1:], *words[1:-1], words[-1] + "."]

    items = [(k, " ".join(w for _ in range(r.randint(1, 4)) for w in sentence(r.randint(3, 12)))) for k in range(25)]

    def changed(text):
        kinds = [NAMES, COUNTS, MEASURES]
        moved = {w: r.choice(kind) for kind in kinds for w in kind}
        style, out = r.randrange(4), []
        for word in text.split():
            core = word.rstrip(".")
            new = moved.get(core, core)
            if style == 1 and core in moved and r.random() < 0.3:
                new = r.choice([w for kind in kinds if core in kind for w in kind])
            if style == 2 and r.random() < 0.05:
                new = draw()
            if style == 3:
                new = core if r.random() < 0.9 else r.choice(COUNTS) if core in COUNTS else core
            out.append(new + word[len(core) :])
        return " ".join(out)

    docs = []
    for k in range(120):
        body = changed(r.choice(items)[1]).split()
        if r.random() < 0.3:
            body = body[: r.randint(1, len(body))]
        around = sentence(r.randint(2, 15)) if r.random() < 0.7 else []
        docs.append((k, " ".join(around + body + sentence(r.randint(2, 9))) + r.choice(["", "\nOlga walks to the river."])))
    rows = decontamination.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    ).collect()
    got = sorted(
        (x.doc_id, x.item_id, x.matched_windows, x.item_windows, round(x.coverage, 9), x.reparameterised) for x in rows
    )
    want = plain_leaks(docs, items)
    assert got == want
    assert sum(x[5] for x in want) > 20 and sum(not x[5] for x in want) > 3
