"""Quality rules from tokeniser fertility.

Public vocabularies measure every text: characters per token under a piece vocabulary and under a byte-level
one, the share of byte fallback under both (byte pieces; tokens of one character or of a part of one, which is
what a byte-level vocabulary falls back to), and the entropy of the byte-level tokens, as the mean over stretches of
``STRETCH`` tokens, so that it doesn't grow with the text. Each language (or script, where languages are unknown or
rare) has a rejection band per measure, fitted to the quartiles of the table's own texts; a text outside one of
its bands is rejected. Counting rules (too few words, repeated three-word windows) come first.

Measures are taken over words (see ``common``), each encoded on its own with its leading space
mark, so a word costs one tokeniser call per task however often it occurs.
"""

from __future__ import annotations

import base64
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import struct_array, text_udf, written
from tidemark.llm.vocabularies import path, pattern

SYMBOLS = b"#*$%&|<>"
#: Words kept in a task's encoding cache; beyond it the cache starts anew (results don't change).
CACHE_WORDS = 150_000
#: Tokens of a stretch whose entropy is measured.
STRETCH = 100
#: The measures with a band.
MEASURES = ("chars_per_piece", "chars_per_byte_token", "piece_fallback", "byte_fallback", "token_entropy")
#: Up to this many rows of bands are broadcast (100 bytes a row or so); beyond it the join is a shuffle.
BROADCAST_BANDS = 10_000


@dataclass(frozen=True)
class Fence:
    """The band of a measure: quartiles moved out by ``reach`` interquartile ranges, by ``least`` at least, on the
    named sides."""

    least: float
    below: bool = True
    above: bool = True


def _fences() -> dict[str, Fence]:
    return {
        "chars_per_piece": Fence(0.15),
        "chars_per_byte_token": Fence(0.15),
        "piece_fallback": Fence(0.02, below=False),
        "byte_fallback": Fence(0.04, below=False),
        "token_entropy": Fence(0.25),
    }


def _wide_bands() -> dict[str, tuple[tuple[float, float], ...]]:
    """Script -> bands of ``MEASURES`` where the table has too few texts to fit them."""
    return {
        "latin": ((1.5, 12.0), (1.5, 12.0), (0.0, 0.2), (0.0, 0.7), (3.5, 6.65)),
        "cyrillic": ((1.2, 8.0), (0.5, 8.0), (0.0, 0.2), (0.0, 0.7), (3.5, 6.65)),
        "greek": ((0.7, 6.0), (0.4, 6.0), (0.0, 0.5), (0.0, 0.95), (3.0, 6.65)),
        "cjk": ((0.3, 4.0), (0.25, 4.0), (0.0, 0.95), (0.0, 1.0), (2.5, 6.65)),
        "other": ((0.2, 8.0), (0.2, 8.0), (0.0, 1.0), (0.0, 1.0), (2.5, 6.65)),
        "none": ((1.0, 12.0), (1.0, 12.0), (0.0, 0.2), (0.0, 1.0), (2.5, 6.65)),
    }


@dataclass(frozen=True)
class FertilityRules:
    """Parameters of the rules. A language or script of fewer than ``min_texts`` texts has no bands of its own:
    a language takes its script's, a script the wide ones."""

    min_words: int = 50
    max_repeat_percent: int = 50
    piece_vocabulary: str = field(default_factory=lambda: path("piece_bpe_32k.model"))
    byte_vocabulary: str = field(default_factory=lambda: path("byte_bpe_multi_50k.tiktoken"))
    reach: float = 3.0
    min_texts: int = 200
    fences: Mapping[str, Fence] = field(default_factory=_fences)
    wide: Mapping[str, tuple] = field(default_factory=_wide_bands)


def script_of(text: str) -> str:
    """The script of most of the text's letters: latin, cyrillic, greek, cjk or other; none without letters."""
    try:
        text.encode("latin-1")
        return "latin" if any(map(str.isalpha, text)) else "none"
    except UnicodeEncodeError:
        pass
    codes = np.frombuffer("".join(filter(str.isalpha, text)).encode("utf-32-le"), "<u4")
    if not len(codes):
        return "none"
    edges = [0x0250, 0x0370, 0x0400, 0x0530, 0x2E80, 0xA000, 0xAC00, 0xD7B0, 0xF900, 0xFB00, 0x20000, 0x32000]
    names = [
        "latin", "other", "greek", "cyrillic", "other", "cjk", "other", "cjk", "other", "cjk", "other", "cjk", "other"
    ]
    counts: dict[str, int] = {}
    for region, n in zip(*np.unique(np.searchsorted(edges, codes, side="right"), return_counts=True)):
        counts[names[region]] = counts.get(names[region], 0) + int(n)
    return max(sorted(counts), key=lambda k: counts[k])


def repeat_words(words: list[bytes]) -> int:
    """Words inside a three-word window that occurs twice or more in the text, the first included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen, twice = set(), set()
    for w in windows:
        (twice if w in seen else seen).add(w)
    hit = np.zeros(len(words), bool)
    for i, w in enumerate(windows):
        if w in twice:
            hit[i : i + 3] = True
    return int(hit.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.encode().split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


class _Fertility:
    """Piece counts and byte-level token ids of words."""

    def __init__(self, rules: FertilityRules):
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=rules.piece_vocabulary)
        lines = open(rules.byte_vocabulary, "rb").read().splitlines()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes = tiktoken.Encoding("byte-vocabulary", pat_str=pattern(), mergeable_ranks=ranks, special_tokens={})
        size = self.pieces.get_piece_size()
        self.piece_fell = np.array([self.pieces.is_byte(i) or self.pieces.is_unknown(i) for i in range(size)])
        self.byte_fell = np.zeros(max(ranks.values()) + 1, bool)
        self.byte_fell[[n for token, n in ranks.items() if self.bare(token)]] = True
        self.clear()

    @staticmethod
    def bare(token: bytes) -> bool:
        """Whether a byte-level token holds one character at most, or a part of one."""
        try:
            return len(token.decode().strip(" ")) <= 1
        except UnicodeDecodeError:
            return True

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, np.int32)
        self.counts = np.zeros((2, 0), np.int32)

    def learn(self, docs: list[list[bytes]]) -> None:
        if len(self.index) > CACHE_WORDS:
            self.clear()
        new = list(set().union(*docs).difference(self.index)) if docs else []
        if not new:
            return
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        strings = [w.decode() for w in new]
        pieces = self.pieces.encode(strings, num_threads=1)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        fell = np.add.reduceat(
            self.piece_fell[np.fromiter((i for x in pieces for i in x), np.int32)].astype(np.int32),
            np.cumsum(sizes) - sizes,
        )
        self.counts = np.concatenate([self.counts, [sizes, fell]], axis=1)
        encode = self.bytes.encode_ordinary
        tokens = [encode(" " + w) for w in strings]
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in tokens for i in x), np.int32, int(sizes.sum()))])

    def measure(self, words: list[bytes]) -> tuple[int, int, int, int, float | None]:
        """Pieces, fallback pieces, byte-level tokens, bare ones among them, and the mean entropy of stretches in
        bits."""
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        pieces, fell = self.counts[:, at].sum(axis=1).tolist()
        sizes = self.starts[at + 1] - self.starts[at]
        total = int(sizes.sum())
        ends = np.cumsum(sizes)
        ids = self.ids[np.arange(total) + np.repeat(self.starts[at] - ends + sizes, sizes)]
        return pieces, fell, total, int(self.byte_fell[ids].sum()), stretch_entropy(ids)


def stretch_entropy(ids: np.ndarray) -> float | None:
    """The mean entropy of stretches of ``STRETCH`` tokens, the last of which may overlap the one before; None for
    fewer tokens."""
    whole = len(ids) // STRETCH
    if not whole:
        return None
    rows = ids[: whole * STRETCH].reshape(whole, STRETCH)
    if len(ids) % STRETCH:
        rows = np.vstack([rows, ids[-STRETCH:]])
    rows = np.sort(rows, axis=1)
    edges = np.hstack([np.ones((len(rows), 1), bool), rows[:, 1:] != rows[:, :-1]])
    runs = np.diff(np.append(np.flatnonzero(edges.ravel()), rows.size)) / STRETCH
    return float(-(runs * np.log2(runs)).sum() / len(rows)) + 0.0


SCHEMA = (
    "struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, n_repeat_words: bigint, "
    "script: string, n_tokens: bigint, chars_per_piece: double, chars_per_byte_token: double, piece_fallback: double, "
    "byte_fallback: double, token_entropy: double, base_failed: boolean>"
)
NAMES = [x.split(":")[0].strip() for x in SCHEMA[7:-1].split(",")]
KINDS = [pa.int64()] * 5 + [pa.string(), pa.int64()] + [pa.float64()] * 5 + [pa.bool_()]


def measures(text: Column, rules: FertilityRules | None = None) -> Column:
    """A struct of the counts, the fertility measures and ``base_failed``.

    A null or empty text has no words, so it fails the base rules; its ratios are null. A text is
    measured whole, however long, and by itself: ties, repeats and skew don't matter.
    """
    rules = rules or FertilityRules()

    def make():
        fertility = _Fertility(rules)

        def row(text: str, raw: bytes, words: list[bytes]) -> tuple:
            n, chars = len(words), len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
            symbols, repeats = len(raw) - len(raw.translate(None, SYMBOLS)), repeat_words(words)
            counts = (n, chars, symbols, duplicate_lines(text), repeats, script_of(text))
            failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
            if not n:
                return (*counts, 0, None, None, None, None, None, failed)
            pieces, fell, tokens, bare, entropy = fertility.measure(words)
            return (*counts, tokens, chars / pieces, chars / tokens, fell / pieces, bare / tokens, entropy, failed)

        def work(texts: list) -> pa.Array:
            texts = [t or "" for t in texts]
            raw = [t.encode() for t in texts]
            docs = [b.split() for b in raw]
            fertility.learn(docs)
            columns = list(zip(*map(row, texts, raw, docs))) or [[] for _ in NAMES]
            return struct_array({k: (list(v), t) for k, v, t in zip(NAMES, columns, KINDS)})

        return work

    return text_udf(make, SCHEMA)(text)


def fit_bands(measured: DataFrame, language: str | None, rules: FertilityRules | None = None) -> DataFrame:
    """(band_script, band_language, low, high): arrays of bounds in the order of ``MEASURES``.

    ``measured`` has the struct ``__quality`` and maybe a ``language`` column. Texts that pass the base rules
    count, one by one and all of them; a row with null ``band_language`` is the script's. Measures are rounded to
    three digits, so a group's counts of values are few and its quartiles exact, whatever the partitioning.
    """
    rules = rules or FertilityRules()
    lang = F.col(language).cast("string") if language else F.lit(None).cast("string")
    rows = measured.where(~F.col("__quality.base_failed")).select(
        F.col("__quality.script").alias("band_script"),
        lang.alias("band_language"),
        *[F.round(F.col(f"__quality.{m}"), 3).alias(m) for m in MEASURES],
    )
    quartiles = [F.percentile(m, F.array(F.lit(0.25), F.lit(0.75))).alias(m) for m in MEASURES]
    own = rows.where("band_language is not null").groupBy("band_script", "band_language")
    script = rows.groupBy("band_script").agg(F.count("*").alias("n"), *quartiles)
    both = own.agg(F.count("*").alias("n"), *quartiles).unionByName(
        script.withColumn("band_language", F.lit(None).cast("string"))
    )

    def bound(m: str, side: int) -> Column:
        fence = rules.fences[m]
        reach = F.greatest(rules.reach * (F.col(m)[1] - F.col(m)[0]), F.lit(fence.least))
        open_side = F.lit(float("inf") if side else float("-inf"))
        moved = F.col(m)[side] + reach if side else F.col(m)[side] - reach
        return F.coalesce(moved, open_side) if (fence.above if side else fence.below) else open_side

    low = F.array(*[bound(m, 0) for m in MEASURES])
    high = F.array(*[bound(m, 1) for m in MEASURES])
    enough = both.where(F.col("n") >= rules.min_texts)
    return enough.select("band_script", "band_language", low.alias("low"), high.alias("high"))


def _measured(docs: DataFrame, keep: list[str], text_col: str, language: str | None, rules: FertilityRules) -> DataFrame:
    extra = [F.col(language).cast("string").alias("__language")] if language else []
    measured = docs.select(*keep, *extra, measures(F.col(text_col), rules).alias("__quality"))
    return written(measured, "quality-measures")


def bands_of(
    docs: DataFrame, text_col: str = "text", rules: FertilityRules | None = None, language_col: str = "lang"
) -> DataFrame:
    """The bands that the texts of ``docs`` fit, for ``annotate`` and ``keep_good`` to judge other tables by."""
    rules, language = rules or FertilityRules(), language_col if language_col in docs.columns else None
    measured = _measured(docs, [], text_col, language, rules)
    return written(fit_bands(measured, "__language" if language else None, rules), "quality-bands")


def judged(
    docs: DataFrame,
    keep: list[str],
    text_col: str,
    language_col: str,
    rules: FertilityRules,
    bands: DataFrame | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``docs``, the struct ``__quality`` and the string ``__reason`` (null: kept).

    Measures are taken once and written to the shared folder; ``bands``, or those fitted on the measures, are joined back.
    """
    language = language_col if language_col in docs.columns else None
    measured = _measured(docs, keep, text_col, language, rules)
    if bands is None:
        bands = written(fit_bands(measured, "__language" if language else None, rules), "quality-bands")
    small = (lambda df: F.broadcast(df)) if bands.count() <= BROADCAST_BANDS else (lambda df: df)
    script = F.col("__quality.script") == F.col("s_script")
    rows = measured.join(
        small(bands.where("band_language is null").toDF("s_script", "s_language", "s_low", "s_high")), script, "left"
    )
    low, high = F.col("s_low"), F.col("s_high")
    if language:
        own = (F.col("__quality.script") == F.col("l_script")) & (F.col("__language") == F.col("l_language"))
        fitted = small(bands.where("band_language is not null").toDF("l_script", "l_language", "l_low", "l_high"))
        rows = rows.join(fitted, own, "left")
        low, high = F.coalesce("l_low", low), F.coalesce("l_high", high)
    whens = [(k, F.array(*[F.array(F.lit(a), F.lit(z)) for a, z in v])) for k, v in rules.wide.items() if k != "other"]
    other = F.array(*[F.array(F.lit(a), F.lit(z)) for a, z in rules.wide["other"]])
    wide = reduce(lambda rest, kv: F.when(F.col("__quality.script") == kv[0], kv[1]).otherwise(rest), whens, other)
    rows = rows.withColumn("__low", F.coalesce(low, F.transform(wide, lambda b: b[0])))
    rows = rows.withColumn("__high", F.coalesce(high, F.transform(wide, lambda b: b[1])))

    def outside(i: int, m: str) -> Column:
        value = F.col(f"__quality.{m}")
        return F.when((value < F.col("__low")[i]) | (value > F.col("__high")[i]), F.lit(m))

    broken = F.array_join(F.array(*[outside(i, m) for i, m in enumerate(MEASURES)]), ",")
    reason = F.when(F.col("__quality.base_failed"), "base").when(broken != "", broken)
    return rows.select(*keep, "__quality", reason.alias("__reason"))


def annotate(
    docs: DataFrame,
    text_col: str = "text",
    rules: FertilityRules | None = None,
    language_col: str = "lang",
    bands: DataFrame | None = None,
) -> DataFrame:
    """Every row of ``docs`` without its text, with its counts, measures, ``reason`` and ``kept``.

    Texts are judged by ``bands`` (see ``bands_of``), so that a verdict doesn't depend on the other rows; without them by the
    bands that ``docs`` itself fits.

    ``reason`` is null for kept rows, ``base``, or all measures that are out of their band, joined by commas.
    Rows without a language, and all rows if there is no ``language_col``, are judged by their script. Repeated rows and
    null ids are rows like others; columns of ``docs`` with a measure's name are left out in favour of the
    measure. An empty table gives an empty table.
    """
    names = [*NAMES, "reason", "kept"]
    keep = [c for c in docs.columns if c != text_col and c not in names]
    rows = judged(docs, keep, text_col, language_col, rules or FertilityRules(), bands)
    found = [F.col(f"__quality.{n}").alias(n) for n in NAMES]
    return rows.select(*keep, *found, F.col("__reason").alias("reason"), F.col("__reason").isNull().alias("kept"))


def keep_good(
    docs: DataFrame,
    text_col: str = "text",
    rules: FertilityRules | None = None,
    language_col: str = "lang",
    bands: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns and nothing else; bands and odd rows as in ``annotate``."""
    rows = judged(docs, docs.columns, text_col, language_col, rules or FertilityRules(), bands)
    return rows.where(F.col("__reason").isNull()).select(*docs.columns)
