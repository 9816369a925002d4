"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, names (capitalised inside a sentence; at its beginning both readings) and units
turn into typed placeholders, other words lose their case and outer punctuation. Windows of template tokens are hashed
and joined between benchmark items and documents. A re-parameterised question shares the template; it counts as a leak
if the slots agree: along one alignment each value of the item stands for one value in the document, but for a small
share of values (two values may become the same one). Where more values conflict but none has been replaced
throughout, the text is an edited copy, whose equal windows count.

A window with few literal words says little, so its slots are held to more: names and units must be equal and
only numbers may change; where even then few words are left, all of it must be equal.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_udf, without_ids, written

#: Number words and units that become placeholders.
NUMBER_WORDS = frozenset(
    (
        "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
        "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion "
        "twice half dozen"
    ).split()
)
UNITS = frozenset(
    "km m cm mm mi ft kg g mg lb oz l ml s min h hours hour minutes minute seconds days weeks months years dollars euros cents usd eur mph kmh km/h °c °f % $ € £".split()
)
#: Words that begin sentences without being names.
COMMON = frozenset(
    "a an the this that these those it he she they we you i his her their our your my its how what when where which who whose why if in on at by for from with to of and or but so as after before during each every all some many most there then not no is are was were do does did can could would should find give let calculate convert write given".split()
)
NUMBER, NAME, UNIT = "\x01num", "\x01name", "\x01unit"
_digest = xxhash.xxh64_intdigest
NAME_HASH = np.uint64(_digest(NAME.encode()))
NUMBER_HASH, UNIT_HASH = _digest(NUMBER.encode()), _digest(UNIT.encode())
_KINDS = {**dict.fromkeys(UNITS, 3), **dict.fromkeys(NUMBER_WORDS, 1)}
#: Last characters of a word that end a sentence.
ENDS = frozenset(".!?:;\"”»")
_NUMBER = re.compile(r"[-+]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%|[a-zµ]{1,3})?\Z")
#: A capitalised word with small letters; parts may be joined (Anne-Marie, O'Brien) and have capitals inside (McDonald).
_NAMED = re.compile(r"(?=.*[^\W\d_A-ZÀ-ÖØ-Þ])[^\W\d_]+(?:['’-][^\W\d_]+)*\Z")
_EDGES = re.compile(r"\A[^\w$€£%°+-]+|[^\w%°]+\Z")
#: Template tokens kept in a task; beyond it the cache starts anew (results don't change).
CACHE_WORDS = 150_000
FILTER_BITS = 24
#: Readings of a window: names, numbers and units as slots; also names that begin sentences; numbers alone; no slots.
SLOTTED, NAMED, NUMBERS, EXACT = range(4)
#: Items below this many words match whole lines.
MIN_WINDOW = 3
#: A window that more items than this hold is looked up for candidate pairs only.
SHARED = 100
#: Added to the seed of windows read with fewer slots, times the reading.
SEED = 1 << 32


@dataclass(frozen=True)
class TemplateRules:
    """Window size in words, literal words a window needs, the share of an item's windows
    that makes a leak, and the share of an item's values on an alignment that may stand for several values."""

    window: int = 8
    min_literals: int = 5
    min_coverage: float = 0.4
    max_conflicts: float = 0.2


class Templates:
    """Hashed template windows of texts."""

    def __init__(self, rules: TemplateRules, sizes: list[int] | None = None, keep: np.ndarray | None = None):
        self.rules, self.sizes, self.keep = rules, sizes or [rules.window], keep
        self.index: dict[str, int] = {}
        self.arrays: tuple = ()
        self.reserve(CACHE_WORDS)

    def reserve(self, words: int) -> None:
        """Room for the attributes of so many words."""
        self.arrays = tuple(np.zeros(words, kind) for kind in (np.uint64, np.int8, bool, bool, np.uint64, bool))

    @staticmethod
    def attribute(word: str) -> tuple[int, int, bool, bool, int, bool]:
        """(hash of the token, placeholder kind or 0, starts like a name, ends a sentence, hash of the word itself, is
        a common word)."""
        alpha = True
        if word.isalpha():
            core, ends = word, False
        elif word[-1] in ".,;:!?" and word[:-1].isalpha():
            core, ends = word[:-1], word[-1] in ".!?:;"
        else:
            core, ends, alpha = _EDGES.sub("", word), word[-1] in ENDS, False
        low = core.lower()
        own = _digest((low or word).encode())
        kind = _KINDS.get(low, 0)
        if not (kind or alpha):
            counted = "-" in low and all(part in NUMBER_WORDS for part in low.split("-"))
            kind = 1 if counted or _NUMBER.match(low) else 0
        if kind:
            return NUMBER_HASH if kind == 1 else UNIT_HASH, kind, False, ends, own, low in COMMON
        if core == low or not core[0].isupper():
            return own, 0, False, ends, own, low in COMMON
        if len(core) == 1:
            initial = len(word) == 2 and word[1] == "."
            return own, 0, initial, ends and not initial, own, low in COMMON and not initial
        return own, 0, alpha and core[1:].islower() or bool(_NAMED.match(core)), ends, own, low in COMMON

    def learn(self, words: set[str]) -> None:
        new = words.difference(self.index)
        if len(self.index) + len(new) > len(self.arrays[0]):
            self.index.clear()
            new = words
            if len(new) > len(self.arrays[0]):
                self.reserve(len(new))
        if new:
            at = len(self.index)
            self.index.update(zip(new, range(at, at + len(new))))
            for array, found in zip(self.arrays, zip(*map(self.attribute, new))):
                array[at : at + len(new)] = np.array(found, array.dtype)

    def tokens(self, text: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """(words, token hashes, placeholder kinds, hashes of the words themselves, possible names, lines' first words).

        A capitalised word after a sentence's end or a line break is a literal, and a possible name if it isn't a
        common word.
        """
        words, starts = [], []
        for line in text.split("\n"):
            if parts := line.split():
                starts.append(len(words))
                words += parts
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        hashes, kinds, named, ends, exact, common = (a[at] for a in self.arrays)
        first = np.concatenate([[True], ends[:-1]])
        first[starts] = True
        name = named & ~first
        return words, np.where(name, NAME_HASH, hashes), np.where(
            name, 2, kinds
        ), exact, named & first & ~common, starts

    @staticmethod
    def mixed(hashes: np.ndarray, at: np.ndarray | slice, size: int, n: int, seed: int) -> np.ndarray:
        """Hashes of the windows of ``size`` tokens at the positions ``at`` of the first ``n``."""
        h = np.full(n, seed, np.uint64)[at]
        for j in range(size):
            h = (h ^ hashes[j : j + n][at]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def passing(self, h: np.ndarray) -> np.ndarray:
        if self.keep is None:
            return np.ones(len(h), bool)
        low = h & np.uint64((1 << FILTER_BITS) - 1)
        return (self.keep[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def windows(self, text: str) -> list[tuple[int, int, list[str], bool, int]]:
        """(position, hash, slot values, enough literals, reading) of the text's windows, only those that the filter
        lets through.

        A window with possible names that begin sentences is read twice: with these as literals and with these as
        names. One with too few literal words is read with numbers as its only slots if that leaves enough words, else
        with none. Windows of one or two words are whole lines. Of windows with equal hash and slots the first stands
        for all.
        """
        words, hashes, kinds, exact, initial, starts = self.tokens(text)
        out: dict[tuple, tuple] = {}

        def add(at: np.ndarray, h: np.ndarray, size: int, slotted: np.ndarray, rich: bool, reading: int) -> None:
            for k in np.flatnonzero(self.passing(h)).tolist():
                p, value = int(at[k]), int(h[k].view(np.int64))
                slots = self.slots(words, slotted, p, size)
                out.setdefault((value, tuple(slots), reading), (p, value, slots, rich, reading))

        literal = np.concatenate([[0], np.cumsum(kinds == 0)])
        again = initial.any()
        if again:
            opened = np.concatenate([[0], np.cumsum(initial)])
            named_hashes, named_kinds = np.where(initial, NAME_HASH, hashes), np.where(initial, 2, kinds)
        for size in self.sizes:
            n = len(words) - size + 1
            if n < 1:
                continue
            none = np.zeros_like(kinds)
            if size < MIN_WINDOW:
                lines = np.array(starts)[np.diff([*starts, len(words)]) == size]
                add(lines, self.mixed(exact, lines, size, n, size + EXACT * SEED), size, none, False, EXACT)
                continue
            enough = min(self.rules.min_literals, size - 1)
            rich = literal[size:] - literal[:-size] >= enough
            h = self.mixed(hashes, slice(None), size, n, size)
            at = np.flatnonzero(self.passing(h) & rich)
            add(at, h[at], size, kinds, True, SLOTTED)
            if not rich.all():
                numbers = np.where(kinds == 1, kinds, 0)
                left = size - np.diff(
                    np.concatenate([[0], np.cumsum(numbers)])[[np.arange(n), np.arange(size, size + n)]], axis=0
                )[0]
                at = np.flatnonzero(~rich & (left >= enough))
                h = self.mixed(np.where(kinds == 1, hashes, exact), at, size, n, size + NUMBERS * SEED)
                add(at, h, size, numbers, True, NUMBERS)
                at = np.flatnonzero(~rich & (left < enough))
                add(at, self.mixed(exact, at, size, n, size + EXACT * SEED), size, none, False, EXACT)
            if again:
                names = opened[size:] - opened[:-size]
                at = np.flatnonzero((names > 0) & (literal[size:] - literal[:-size] - names >= enough))
                add(at, self.mixed(named_hashes, at, size, n, size), size, named_kinds, True, NAMED)
        return list(out.values())

    @staticmethod
    def slots(words: list[str], kinds: np.ndarray, p: int, size: int) -> list[str]:
        return [f"{kinds[i]}{_EDGES.sub('', words[i]).lower()}" for i in range(p, p + size) if kinds[i]]

    def batch(self, texts: list) -> list:
        texts = [t or "" for t in texts]
        self.learn(set().union(*map(str.split, texts)))
        names = ("pos", "hash", "slots", "rich", "reading")
        return [[dict(zip(names, w)) for w in self.windows(t)] if t.split() else [] for t in texts]


WINDOW = "array<struct<pos: int, hash: bigint, slots: array<string>, rich: boolean, reading: int>>"
_ARROW = pa.list_(
    pa.struct(
        [
            ("pos", pa.int32()),
            ("hash", pa.int64()),
            ("slots", pa.list_(pa.string())),
            ("rich", pa.bool_()),
            ("reading", pa.int32()),
        ]
    )
)


def _windows(
    rows: DataFrame, id_col: str, text_col: str, rules: TemplateRules, sizes: list[int], keep: np.ndarray | None
) -> DataFrame:
    def make():
        templates = Templates(rules, sizes, keep)

        return lambda texts: pa.array(templates.batch(texts), _ARROW)

    found = rows.select(
        F.col(id_col).alias(f"{id_col}_"), F.explode(text_udf(make, WINDOW)(F.col(text_col))).alias("w")
    )
    return found.select(F.col(f"{id_col}_").alias(id_col), "w.pos", "w.hash", "w.slots", "w.rich", "w.reading")


def _hits(found: DataFrame, whole: DataFrame, min_coverage: float) -> DataFrame:
    """(doc_id, item_id, hash, shift, way, slots, item_slots, at, rich): windows of documents beside the items' windows
    that they match, all of them for every pair that can reach ``min_coverage``.

    Windows that more than ``SHARED`` items hold (a preamble of a benchmark) are not multiplied by their items: they
    are looked up only for candidate pairs, those that share another window or one of the item's rarest. A pair of the
    coverage matches one of the item's ``W - ceil(coverage * W) + 1`` rarest places, whichever it matches.
    """
    first = F.min(F.struct("pos", "slots")).alias("first")
    ours = whole.groupBy("item_id", "hash", F.col("reading").alias("item_reading")).agg(
        first, F.collect_set("pos").alias("at")
    )
    shift, way = (F.col("pos") - F.col("first.pos")).alias("shift"), (
        F.col("reading") * 4 + F.col("item_reading")
    ).alias("way")
    shown = [
        "doc_id", "item_id", "hash", shift, way, "slots", F.col("first.slots").alias("item_slots"), "at", "rich"
    ]
    holders = whole.groupBy("hash").agg(F.countDistinct("item_id").alias("items"))
    shared = written(holders.where(F.col("items") > SHARED), "benchmark-shared")
    if shared.isEmpty():
        return found.join(ours, "hash").select(shown)

    found = written(found, "benchmark-found")
    few = found.join(ours.join(shared, "hash", "left_anti"), "hash").select(shown)
    places = whole.join(holders, "hash").groupBy("item_id", "pos").agg(
        F.max("items").alias("items"), F.max("rich").alias("rich")
    )
    rare = None
    for kind in (places, places.where("rich")):
        w = Window.partitionBy("item_id")
        ranked = kind.select(
            "item_id", "pos", F.row_number().over(w.orderBy("items", "pos")).alias("k"), F.count("*").over(w).alias("n")
        ).where(F.col("k") <= F.col("n") - F.ceil(F.col("n") * min_coverage - 1e-9) + 1)
        rare = ranked if rare is None else rare.unionByName(ranked)
    telling = whole.join(rare, ["item_id", "pos"], "left_semi").join(shared, "hash", "left_semi")
    candidates = few.select("doc_id", "item_id").unionByName(
        found.join(telling.select("hash", "item_id").distinct(), "hash").select("doc_id", "item_id")
    ).distinct()
    pairs = candidates.select(F.col("doc_id").alias("c_doc_id"), "item_id")
    common = found.join(shared.select("hash"), "hash", "left_semi")
    many = common.join(pairs, F.col("doc_id").eqNullSafe(F.col("c_doc_id"))).join(ours, ["item_id", "hash"])
    return few.unionByName(many.select(shown))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    rules: TemplateRules | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, matched_windows, item_windows, coverage, reparameterised): the leaked items of every document.

    Documents are read whole and once. Their windows first pass a bit filter of fixed size (2 MB) built
    from the benchmark's windows, so that what is joined by hash is near the true matches; the join itself
    is exact and left to Spark (it may broadcast a benchmark below its own size threshold). A window counts once per
    document and values, and joins once per item however often either repeats it. Items shorter than a
    window are matched as one window of their own length, items of one or two words where a line of the document is
    the item. ``coverage`` is the share of matched windows among all of the item or among those that are not
    matched word for word only, whichever is greater. Null texts and ids of items match nothing; null document ids are
    kept as one group; repeated rows and items count once. Other columns are not read. An empty table of documents
    or items gives an empty table.
    """
    rules = rules or TemplateRules()
    known = benchmark.where(F.col(item_col).isNotNull() & F.col(item_text_col).isNotNull())
    items = known.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    size = F.size(F.array_remove(F.split("text", r"[ \t-\r]+"), ""))
    short = sorted(
        r.n for r in items.select(size.alias("n")).where(F.col("n").between(1, rules.window - 1)).distinct().collect()
    )
    parts = [_windows(items, "item_id", "text", rules, [rules.window], None)]
    parts += [_windows(items.where(size == n), "item_id", "text", rules, [n], None) for n in short]
    whole = written(reduce(DataFrame.unionByName, parts).distinct(), "benchmark-windows")
    keys = whole.select(
        (F.col("hash").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))).alias("k")
    ).distinct().toPandas()["k"].to_numpy(np.int64)
    keep = np.zeros(1 << FILTER_BITS, np.uint8)
    keep[keys] = 1
    keep = np.packbits(keep, bitorder="little")
    texts = docs.where(F.col(text_col).isNotNull())
    found = _windows(texts, id_col, text_col, rules, [rules.window, *short], keep).withColumnRenamed(id_col, "doc_id")
    hits = written(_hits(found, whole, rules.min_coverage), "benchmark-hits")
    key = ["doc_id", "item_id", "shift", "way"]
    zipped = hits.select(*key, F.explode(F.arrays_zip("item_slots", "slots")).alias("z"))
    pairs = zipped.select(*key, F.col("z.item_slots").alias("x"), F.col("z.slots").alias("y")).distinct()
    values = pairs.groupBy(*key, "x").agg(
        (F.count("*") > 1).alias("torn"), F.max(F.col("x") == F.col("y")).alias("kept")
    )
    conflicts = F.count_if("torn") > rules.max_conflicts * F.count("*")
    torn = values.groupBy(*key).agg(conflicts.alias("torn"), F.every("kept").alias("edited")).where("torn")
    torn = torn.select(*[F.col(c).alias(f"t_{c}") for c in key], "edited")
    same = F.col("doc_id").eqNullSafe(F.col("t_doc_id"))
    for c in key[1:]:
        same = same & (F.col(c) == F.col(f"t_{c}"))
    equal = F.col("slots") == F.col("item_slots")
    sound = hits.join(torn, same, "left").where(F.col("edited").isNull() | (F.col("edited") & equal))
    once = sound.groupBy("doc_id", "item_id", "hash", "at").agg(
        F.every(~equal).alias("other"), F.max("rich").alias("rich")
    )
    places = once.select("doc_id", "item_id", "other", "rich", F.explode("at").alias("item_pos"))
    rich_places = F.countDistinct(F.when(F.col("rich"), F.col("item_pos"))).alias("rich_matched")
    matched = places.groupBy("doc_id", "item_id").agg(
        F.countDistinct("item_pos").alias("matched_windows"), rich_places, F.max("other").alias("reparameterised")
    )
    own = whole.groupBy("item_id", "pos").agg(F.max("rich").alias("rich"))
    windows = own.groupBy("item_id").agg(F.count("*").alias("item_windows"), F.count_if("rich").alias("rich_windows"))
    rich_share = F.when(F.col("rich_windows") > 0, F.col("rich_matched") / F.col("rich_windows"))
    share = F.greatest(F.col("matched_windows") / F.col("item_windows"), rich_share)
    out = matched.join(windows, "item_id").withColumn("coverage", share).where(F.col("coverage") >= rules.min_coverage)
    ids = [F.col("doc_id").alias(id_col), F.col("item_id").alias(item_col)]
    return out.select(*ids, "matched_windows", "item_windows", "coverage", "reparameterised")


def drop_leaking(
    docs: DataFrame, benchmark: DataFrame, rules: TemplateRules | None = None, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that hold no leaked item, with all their columns and nothing else.

    Rows are told apart by a digest of their text, so rows without an id and rows that share one are each judged
    by their own text. Rows with a null text stay.
    """
    texts = docs.select(F.md5(text_col).alias("__digest"), F.col(text_col).alias("__text")).where("__text is not null")
    found = leaks(texts, benchmark, rules, "__digest", "__text")
    gone = written(found.select("__digest").distinct(), "benchmark-leaking")
    return without_ids(docs.withColumn("__key", F.md5(text_col)), gone, "__key").drop("__key")
