"""Toxicity by noisy-channel deobfuscation.

A token that mixes letters with digits or signs or repeats a letter three times or more, and a run of
tokens of one or two characters, is read as a noisy form of intended words. Its characters make a
lattice: look-alike digits and signs may stand for letters, signs may be separators, a run of one
letter may stand for one or two, a gap between short tokens may be a word's end or nothing. Viterbi finds the
most likely path under a character trigram model; the words on it are then scored beside the plain ones.

Learnt from all texts: the character model. Learnt from labelled texts: the lexicon (words and word
beginnings that stand in significantly more toxic than clean texts, and their log odds), and a logistic
calibration over the lexicon's hits whose weights are never negative, so more evidence never lowers a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE, id_bucket, sample_rows, text_udf, written
from tidemark.llm.language_id import held_out

#: Letters that a digit or sign may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "¢": "c",
}
VOWELS = "aeiou"
#: Signs that may hide a vowel.
HIDING = "*#_-."
_HIDING = frozenset(HIDING)
#: Costs in nats: a look-alike, a sign standing between letters, a sign hiding a vowel, a shortened run, a
#: look-alike that stands for nothing, and a gap between short tokens that is no word's end.
LOOK_ALIKE_COST, SEPARATOR_COST, HIDDEN_COST, RUN_COST, DROP_COST, GAP_COST = 0.7, 0.4, 2.5, 0.2, 8.0, 0.5
#: Judged tokens kept in a task; beyond it the cache starts anew (results don't change).
CACHE_TOKENS = 150_000
#: Letters from here on (ideographs, syllables) are one letter to the character model: it covers alphabets.
ALPHABETS_END = 0x2E80
#: Characters of texts that trigrams are counted in at a time.
CHARACTERS = 1 << 18
#: A run of this many tokens of one or two characters is read as one lattice.
SHORT_RUN = 3
#: Log odds from which on a single hit weighs more.
STRONG = 5.0
_EDGES = re.compile(r"\A[\W_]+|[\W_]+\Z")
_STOPS = frozenset(".,;:!?")
_RUN = re.compile(r"(.)\1\1")
_GAP = " "


@dataclass(frozen=True)
class ToxicityRules:
    """Bound on labelled rows to learn from, evidence for a lexicon word, threshold, lexicon weight in the character
    model, and whether noisy tokens are restored (False to measure what restoration brings)."""

    fit_rows: int = 30_000
    min_texts: int = 3
    min_odds: float = 2.0
    min_evidence: float = 8.0
    lexicon_weight: float = 0.5
    threshold: float = 0.7
    restoration: bool = True


@dataclass(frozen=True)
class ToxicityModel:
    """Trigram log probabilities (with the lower orders mixed in), lexicon weights, calibration (bias and four
    weights)."""

    trigrams: dict[str, float]
    floor: float
    lexicon: dict[str, float]
    calibration: tuple[float, ...]
    restoration: bool = True


def plain(token: str) -> str:
    """The token in lower case without signs at its ends."""
    if token[-1:] in _STOPS and token[:-1].isalpha():
        return token[:-1].lower()
    return _EDGES.sub("", token).lower()


def forms(word: str) -> list[str]:
    """The word and its beginnings of five and four letters (marked), under which inflected forms meet."""
    return [word, *(word[:n] + "~" for n in (5, 4) if len(word) > n)]


def suspicious(token: str) -> bool:
    """Whether a lower-case token looks like a noisy form of a word."""
    if len(token) < 3 or token.isdigit():
        return False
    mixed = not token.isalpha() and (any(map(str.isalpha, token)) or any(c in LOOK_ALIKES for c in token))
    return mixed or bool(_RUN.search(token))


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of one character, the strings it may stand for and their costs. A blank is a gap between short
    tokens."""
    out, at = [], 0
    while at < len(token):
        c, end = token[at], at
        while end < len(token) and token[end] == c:
            end += 1
        size, at = end - at, end
        if c == _GAP:
            ways = [("$^^", 0.0), ("", GAP_COST)]
        elif c.isalpha():
            ways = [(c * size, 0.0)] if size < 3 else []
            if size >= 2:
                ways += [(c, RUN_COST if size > 2 else 1.0)]
            if size >= 3:
                ways += [(c * 2, RUN_COST)]
        else:
            near = LOOK_ALIKES.get(c, "")
            ways = [
                (x * k, LOOK_ALIKE_COST + (RUN_COST if k != size else 0.0)) for x in near for k in {1, min(size, 2)}
            ]
            ways += [("", SEPARATOR_COST if not near else DROP_COST)]
            if c in HIDING:
                ways += [(v, HIDDEN_COST) for v in VOWELS]
        out.append(ways)
    return out


def restore(token: str, model: ToxicityModel) -> str:
    """The most likely intended words, parted by blanks: Viterbi over the last two letters of the paths through the
    lattice."""
    score, floor = model.trigrams.get, model.floor
    paths: dict[str, tuple[float, str]] = {"^^": (0.0, "")}
    for ways in [*lattice(token), [("$", 0.0)]]:
        ahead: dict[str, tuple[float, str]] = {}
        for state, (value, text) in paths.items():
            for letters, cost in ways:
                total, here = value - cost, state
                for c in letters:
                    if c != "^":
                        total += score(here + known_letter(c), floor)
                    here = here[1] + known_letter(c)
                if here not in ahead or total > ahead[here][0]:
                    ahead[here] = (total, text + letters)
        paths = ahead
    return " ".join(max(paths.values())[1].replace("^", "").rstrip("$").replace("$", _GAP).split())


def known_letter(c: str) -> str:
    """A letter as the character model sees it."""
    return c if ord(c) < ALPHABETS_END else "\u2e80"


class _Letters(dict):
    """A translation of characters to letters, others to nothing. Letters that one sign may stand for are one letter, so
    that the skeletons of all readings agree."""

    def __missing__(self, code: int) -> int | None:
        self[code] = found = code if chr(code).isalpha() else None
        return found


_LETTERS = _Letters({ord("l"): ord("i")})
_READ = _Letters({**_LETTERS, **{ord(sign): ord(near[0]) for sign, near in LOOK_ALIKES.items()}, ord("£"): ord("i")})
_REPEAT = re.compile(r"(.)\1+")
#: Signs at a token's ends that may belong to the word.
_END_SIGNS = frozenset(c for c in LOOK_ALIKES if not c.isdigit())


def skeleton(token: str, letters: _Letters = _READ) -> str:
    """The letters of a token with look-alikes read and repeats taken out."""
    return _REPEAT.sub(r"\1", token.translate(letters))


class Scorer:
    """Lexicon hits of texts under a model."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.seen: set[str] = set()
        self.hot: dict[str, float] = {}
        self.heads = {word[:4] for word in model.lexicon}
        bones = {skeleton(word.rstrip("~")) for word in model.lexicon}
        self.bones, self.short = {b[:4] for b in bones if len(b) >= 4}, {b for b in bones if len(b) < 4}

    def weight(self, token: str) -> float:
        """The lexicon weight of a token, restored if need be; 0 outside the lexicon."""
        whole = token.isalpha()
        word = token.lower() if whole else plain(token)
        found = self.best(word)
        if found or not self.model.restoration:
            return found
        if whole or word.isalpha():
            found = self.restored(word) if _RUN.search(word) else 0.0
            if whole:
                return found
        elif suspicious(word):
            found = self.restored(word)
        if not found and word and len(word) < len(token) and (token[0] in "*#" or not _END_SIGNS.isdisjoint(token)):
            found = self.restored(token.lower()) if suspicious(token.lower()) else 0.0
        return found

    def best(self, word: str) -> float:
        if word[:4] not in self.heads and word[:4] + "~" not in self.heads:
            return 0.0
        return max((self.model.lexicon.get(f, 0.0) for f in forms(word)), default=0.0)

    def may_hold(self, token: str) -> bool:
        """Whether a reading of the token may be a lexicon word: a sign inside may hide a vowel, else the skeleton
        decides."""
        if not _HIDING.isdisjoint(token[:-1]):
            return True
        bones, read = self.bones, skeleton(token)
        if read in self.short or any(read[i : i + 4] in bones for i in range(len(read) - 3)):
            return True
        bare = skeleton(token, _LETTERS)
        return bare != read and (bare in self.short or any(bare[i : i + 4] in bones for i in range(len(bare) - 3)))

    def restored(self, token: str) -> float:
        """The greatest lexicon weight of the words that a noisy token or a run of short tokens is read as."""
        if not self.may_hold(token):
            return 0.0
        return max((self.best(word) for word in restore(token, self.model).split()), default=0.0)

    def runs(self, tokens: list[str]) -> Iterator[str]:
        """The runs of short tokens, in lower case, parted by blanks."""
        short = np.fromiter(map(len, tokens), np.int64, len(tokens)) <= 2
        edges = np.flatnonzero(np.diff(np.concatenate([[False], short, [False]]).astype(np.int8)))
        for a, z in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if z - a >= SHORT_RUN:
                yield _GAP.join(tokens[a:z]).lower()

    def features(self, text: str) -> tuple[float, float, float, float]:
        """The greatest weight of a hit, its part above ``STRONG``, and the logarithms of one plus the sum of the
        other distinct hits and of one plus the hits per hundred words. None falls when evidence is added."""
        tokens = text.split()
        distinct = set(tokens)
        new = distinct - self.seen
        if len(self.seen) + len(new) > CACHE_TOKENS:
            self.seen.clear()
            self.hot.clear()
            new = distinct
        for t in new:
            if found := self.weight(t):
                self.hot[t] = found
        self.seen |= new
        hits = [] if distinct.isdisjoint(self.hot) else [t for t in tokens if t in self.hot]
        weights = {plain(t): self.hot[t] for t in hits}
        if self.model.restoration:
            for run in self.runs(tokens):
                if self.may_hold(run.replace(_GAP, "")) and (found := self.restored(run)):
                    hits.append(run)
                    weights[run] = found
        if not hits:
            return 0.0, 0.0, 0.0, 0.0
        top = max(weights.values())
        others = max(sum(weights.values()) - top, 0.0)
        return top, max(top - STRONG, 0.0), math.log1p(others), math.log1p(100.0 * len(hits) / len(tokens))


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _calibrate(rows: np.ndarray, labels: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps with a small ridge; weights that would be negative are left at zero."""
    x = np.hstack([np.ones((len(rows), 1)), rows])
    used = list(range(x.shape[1]))
    while True:
        w = np.zeros(x.shape[1])
        part = x[:, used]
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hessian = (part * (p * (1 - p))[:, None]).T @ part + 1e-2 * np.eye(len(used))
            step = np.linalg.solve(hessian, part.T @ (labels - p) - 1e-2 * w[used])
            w[used] += step
            if np.abs(step).max() < 1e-8:
                break
        worst = min(used[1:], key=lambda k: w[k], default=0)
        if not worst or w[worst] >= 0:
            return tuple(float(v) for v in w)
        used.remove(worst)


def _word_table(texts: DataFrame) -> DataFrame:
    """(word, toxic, clean): in how many texts of each kind a word or a beginning stands."""

    def words(text: str | None) -> list[str]:
        return sorted({f for w in set(map(plain, (text or "").split())) if w.isalpha() for f in forms(w)})

    def make():
        return lambda rows: pa.array([words(t) for t in rows], pa.list_(pa.string()))

    found = texts.select("toxic", F.explode(text_udf(make, "array<string>")(F.col("text"))).alias("word"))
    return found.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))


def _lexicon(words: DataFrame, toxic: int, clean: int, rules: ToxicityRules) -> dict[str, float]:
    """Words whose share of toxic texts is significantly above that of clean ones, with their log odds.

    The evidence (likelihood ratio) asked for grows with the number of words tested, so that about one word is
    expected to pass by chance. The words that pass stand in ``min_texts`` of at most ``fit_rows`` labelled texts.
    """
    tested = words.where(F.col("toxic") + F.col("clean") >= rules.min_texts)
    n = max(tested.count(), 3)
    bar = max(rules.min_evidence, 2 * math.log(n) - math.log(math.log(n)) - math.log(math.pi))
    p, q = (F.col("toxic") + 0.5) / (toxic + 1), (F.col("clean") + 0.5) / (clean + 1)
    share = (F.col("toxic") + F.col("clean")) / (toxic + clean)

    def part(count: str, of: int):
        return F.col(count) * F.log(F.greatest(F.col(count) / (of * share), F.lit(1e-9)))

    evidence = 2 * (part("toxic", toxic) + part("clean", clean))
    scored = tested.select("word", F.log(p / q).alias("odds"), evidence.alias("evidence"), "toxic")
    enough = (F.col("toxic") >= rules.min_texts) & (F.col("odds") >= rules.min_odds) & (F.col("evidence") >= bar)
    return {r.word: r.odds for r in scored.where(enough).orderBy("word").collect()}


class TrigramCounter:
    """Counts of letter trigrams of texts, whole texts at a time in arrays."""

    def __init__(self) -> None:
        points = np.arange(ALPHABETS_END + 1)
        letter = np.fromiter((chr(i).isalpha() for i in range(ALPHABETS_END)), bool, ALPHABETS_END)
        noise = np.array([chr(i).isdigit() or chr(i) == "_" or chr(i) in LOOK_ALIKES for i in range(ALPHABETS_END)])
        #: 0: a sign or digit that may stand for a letter, 1: other signs and blanks, else a letter.
        kinds = np.append(np.where(letter, points[:-1] + 2, np.where(noise, 0, 1)), ALPHABETS_END + 2).astype(np.uint16)
        wide = np.fromiter((chr(i).isalpha() for i in range(ALPHABETS_END, 0x110000)), bool, 0x110000 - ALPHABETS_END)
        self.kind = np.concatenate([kinds[:-1], np.where(wide, kinds[-1], np.uint16(1))])
        self.total: Counter = Counter()

    def add(self, texts: list[str]) -> None:
        """Count a few texts; a very long one is counted a stretch at a time, each with the last two characters before
        it."""
        joined = "\n".join(["", *texts, ""])
        for at in range(0, max(len(joined) - 2, 0), CHARACTERS):
            part = joined[at : at + CHARACTERS + 2].lower()
            kinds = self.kind[np.frombuffer(part.encode("utf-32-le", "replace"), "<u4")]
            a, b, c = kinds[:-2], kinds[1:-1], kinds[2:]
            use = np.flatnonzero((b > 1) & (a > 0) & (c > 0))
            keys = (a[use].astype(np.int64) << 32) | (b[use].astype(np.int64) << 16) | c[use]
            for key, n in zip(*(x.tolist() for x in np.unique(keys, return_counts=True))):
                self.total[key] += n

    def grams(self) -> Counter:
        """Trigrams with ^ and $ at words' ends; a word's first letter also counts after two ^."""
        out: Counter = Counter()
        sign = lambda k, edge: edge if k == 1 else chr(k - 2)
        for key, n in self.total.items():
            a, b, c = key >> 32, key >> 16 & 0xFFFF, key & 0xFFFF
            out[sign(a, "^") + chr(b - 2) + sign(c, "$")] += n
            if a == 1:
                out["^^" + chr(b - 2)] += n
        return out


def _trigrams(
    texts: DataFrame, lexicon: dict[str, float], rules: ToxicityRules
) -> tuple[dict[str, float], float]:
    """Character trigram log probabilities of all words of ``texts`` (text), lexicon words filled up to their share of
    the weight.

    Only trigrams over the letters of alphabets reach the driver, all other letters being one: their number
    is bounded by the alphabets in use, not by the rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TrigramCounter()
        for batch in batches:
            column = batch.column(0)
            for at in range(0, len(column), SLICE):
                counter.add([t or "" for t in column.slice(at, SLICE).to_pylist()])
        total = counter.grams()
        if total:
            columns = [pa.array(list(total)), pa.array(list(total.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "n"])

    table = texts.select("text").mapInArrow(count, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    grams = Counter({r.gram: float(r.n) for r in table.collect()})
    extra: Counter = Counter()
    for word in lexicon:
        letters = "".join(map(known_letter, word.rstrip("~")))
        padded = f"^^{letters}$" if not word.endswith("~") else f"^^{letters}"
        extra.update(padded[i : i + 3] for i in range(len(padded) - 2))
    scale = rules.lexicon_weight * max(sum(grams.values()), 1.0) / max(sum(extra.values()), 1)
    for gram, n in extra.items():
        grams[gram] += n * scale
    contexts, pairs, letters = Counter(), Counter(), Counter()
    for gram, n in grams.items():
        contexts[gram[:2]] += n
        pairs[gram[1:]] += n
        letters[gram[2]] += n
    middle = Counter()
    for pair, n in pairs.items():
        middle[pair[0]] += n
    total = sum(letters.values()) or 1.0

    def mixed(gram: str, n: float) -> float:
        high, low = n / contexts[gram[:2]], pairs[gram[1:]] / middle[gram[1]]
        return math.log(0.8 * high + 0.15 * low + 0.05 * letters[gram[2]] / total)

    return {g: mixed(g, n) for g, n in grams.items()}, math.log(1e-4)


def fit(docs: DataFrame, labels: DataFrame, rules: ToxicityRules | None = None) -> ToxicityModel:
    """Learn from the labelled rows of ``labels`` (doc_id, toxic), at most about ``rules.fit_rows`` of them.

    The rows are chosen by the hash of their id; their number is the proven bound of what is broadcast to
    the scan of the labelled texts. An id that is labelled twice is toxic if one of its labels says so. The character
    model counts every text of ``docs``, labelled or not. Null labels, ids and texts teach nothing; other
    columns are not read; without any toxic or any clean text there is no lexicon.
    """
    rules = rules or ToxicityRules()
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marks = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = written(sample_rows(marks, "doc_id", rules.fit_rows), "toxicity-labels")
    labelled = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    texts = written(labelled.select("text", "toxic"), "toxicity-fit")
    n = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if not n.toxic or n.toxic == n.n:
        return ToxicityModel(
            {}, math.log(1e-4), {}, (-4.0 if not n.toxic else 4.0, 0.0, 0.0, 0.0, 0.0), rules.restoration
        )
    words = written(_word_table(texts), "toxicity-words")
    lexicon = _lexicon(words, n.toxic, n.n - n.toxic, rules)
    trigrams, floor = _trigrams(docs, lexicon, rules)
    model = ToxicityModel(trigrams, floor, lexicon, (), rules.restoration)

    def make():
        scorer = Scorer(model)
        return lambda rows: pa.array([list(scorer.features(t or "")) for t in rows], pa.list_(pa.float64()))

    pairs = texts.select(text_udf(make, "array<double>")(F.col("text")).alias("f"), "toxic").toPandas()
    weights = _calibrate(np.array(pairs["f"].tolist()), pairs["toxic"].to_numpy(float))
    return ToxicityModel(trigrams, floor, lexicon, weights, rules.restoration)


def score(text, model: ToxicityModel):
    """The probability that a text is toxic. Only the text is used, whole; null and empty texts have no hits."""

    def make():
        scorer = Scorer(model)
        bias, *weights = model.calibration

        def value(text: str | None) -> float:
            return _sigmoid(bias + sum(w * x for w, x in zip(weights, scorer.features(text or ""))))

        return lambda rows: pa.array([value(t) for t in rows], pa.float64())

    return text_udf(make, "double")(text)


def classify(docs: DataFrame, labels: DataFrame, rules: ToxicityRules | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``, learnt from rows that aren't held out.

    Repeated rows and rows with a null id are scored each; labels, lang, source and ids are not inputs of a score, and
    columns other than doc_id and text are not read, whatever their names. Without any labels every score is low;
    an empty table gives an empty table.
    """
    rules = rules or ToxicityRules()
    model = fit(docs, labels.where(id_bucket(F.col("doc_id")) != 1), rules)
    scored = docs.select("doc_id", held_out().alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= rules.threshold).cast("int"))


def keep_clean(docs: DataFrame, model: ToxicityModel, rules: ToxicityRules | None = None) -> DataFrame:
    """The rows of ``docs`` below the threshold, with all their columns and nothing else."""
    rules = rules or ToxicityRules()
    scored = docs.withColumn("__toxicity", score(F.col("text"), model))
    return scored.where(F.col("__toxicity") < rules.threshold).drop("__toxicity")
