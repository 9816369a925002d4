"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vectors of an n-gram's letters are permuted
(rotated) by their place and bound (multiplied) into the n-gram's vector; a text is the bundle (sum) of
its n-gram vectors, a language the bundle of its texts, each scaled to the same length. A text's
language is the prototype with the highest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_bucket, sample_rows, struct_array, text_udf

UNKNOWN = "und"
#: Slots of letter vectors; code points share a slot only across distant scripts. Slot 0 is "no letter".
SLOTS = 4093


@dataclass(frozen=True)
class ProfileSpace:
    """Dimensions, n-gram size, seed of the letter vectors, and the bound on rows that prototypes learn from."""

    dimensions: int = 512
    ngram: int = 3
    seed: int = 7
    fit_rows: int = 40_000
    max_languages: int = 1_000


class Profiler:
    """Bundles of texts."""

    def __init__(self, space: ProfileSpace):
        self.space = space
        letters = np.random.default_rng(space.seed).integers(0, 2, (SLOTS + 1, space.dimensions), np.int8) * 2 - 1
        self.rolled = [np.roll(letters, space.ngram - 1 - i, axis=1).astype(np.int8) for i in range(space.ngram)]
        codes = np.arange(0x110000)
        alpha = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        self.slot = np.where(alpha, codes % SLOTS + 1, 0).astype(np.int64)

    def symbols(self, text: str) -> np.ndarray:
        """Letter slots of the lower-cased text; other characters make one gap (0), one also at both ends."""
        codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4")
        slots = self.slot[codes]
        return slots[np.concatenate([[True], (slots[1:] != 0) | (slots[:-1] != 0)])]

    def bundles(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(one vector per text, whether it has a letter)."""
        n, out = self.space.ngram, np.zeros((len(texts), self.space.dimensions), np.float32)
        found = np.zeros(len(texts), bool)
        for at in range(0, len(texts), 200):
            grams, sizes = [], []
            for k, text in enumerate(texts[at : at + 200]):
                s = self.symbols(text)
                found[at + k] = bool(s.any())
                g = np.zeros(0, np.int64)
                if found[at + k] and len(s) >= n:
                    g = s[: len(s) - n + 1].copy()
                    for i in range(1, n):
                        g = g * (SLOTS + 1) + s[i : len(s) - n + 1 + i]
                grams.append(g)
                sizes.append(len(g))
            distinct, place = np.unique(np.concatenate(grams), return_inverse=True)
            if not len(distinct):
                continue
            vectors, rest = None, distinct.copy()
            for i in range(n - 1, -1, -1):
                part = self.rolled[i][rest % (SLOTS + 1)]
                vectors = part if vectors is None else vectors * part
                rest //= SLOTS + 1
            vectors = vectors.astype(np.float32)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            for k, (a, z) in enumerate(zip(ends, ends[1:])):
                if z > a:
                    counts = np.bincount(place[a:z], minlength=len(distinct)).astype(np.float32)
                    used = np.flatnonzero(counts)
                    out[at + k] = counts[used] @ vectors[used]
        return out, found


def fit(
    docs: DataFrame,
    space: ProfileSpace | None = None,
    lang_col: str = "lang",
    text_col: str = "text",
    id_col: str = "doc_id",
) -> tuple[list[str], np.ndarray]:
    """Language names in order and their prototypes, from rows with a known language.

    At most about ``space.fit_rows`` rows are read, chosen by the hash of their id. Texts' vectors are scaled to
    length 1000 and rounded, so sums are whole numbers and the same on every run; only one vector
    per language reaches the driver, and more than ``space.max_languages`` languages are an error. Repeated rows count
    each; rows with a null text or language, texts without letters and an empty table teach nothing.
    """
    space = space or ProfileSpace()
    rows = sample_rows(
        docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(id_col, lang_col, text_col),
        id_col,
        space.fit_rows,
    )

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler, sums = Profiler(space), {}
        for batch in batches:
            vectors, found = profiler.bundles(batch.column(1).to_pylist())
            sizes = np.linalg.norm(vectors, axis=1)
            for lang, v, size, ok in zip(batch.column(0).to_pylist(), vectors, sizes, found):
                if ok and size:
                    sums[lang] = sums.get(lang, 0) + np.rint(v * (1000 / size)).astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
                ["lang", "v"],
            )

    parts = rows.select(F.col(lang_col).alias("lang"), F.col(text_col)).mapInArrow(
        bundle, "lang string, v array<bigint>"
    )
    cells = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    table = cells.limit(space.max_languages * space.dimensions + 1).toPandas()
    if len(table) > space.max_languages * space.dimensions:
        raise ValueError(f"more than {space.max_languages} languages")
    if table.empty:
        return [], np.zeros((0, space.dimensions), np.float32)
    wide = table.pivot(index="lang", columns="i", values="x").sort_index()
    prototypes = wide.to_numpy(np.float64)
    return list(wide.index), (
        prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-12)
    ).astype(np.float32)


def predict(
    docs: DataFrame,
    model: tuple[list[str], np.ndarray],
    space: ProfileSpace | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, lang_pred, score): the nearest prototype and its cosine, at least 0.

    ``und`` with score 0 for null texts, texts without letters, and where nothing was learnt. Of equal
    cosines the first language in alphabetical order wins. Only the text is used; whole texts count. Repeated rows and
    ids are judged one by one and alike; other columns are not read; an empty table gives an empty table.
    """
    space, (langs, prototypes) = space or ProfileSpace(), model

    def make():
        profiler = Profiler(space)

        def work(texts: list) -> pa.Array:
            vectors, found = profiler.bundles([t or "" for t in texts])
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if langs:
                cosines = vectors @ prototypes.T / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
                best = cosines.argmax(1)
                for k in np.flatnonzero(found):
                    names[k], scores[k] = langs[best[k]], float(np.clip(cosines[k, best[k]], 0, 1))
            return struct_array({"lang_pred": (names, pa.string()), "score": (scores, pa.float64())})

        return work

    guess = text_udf(make, "struct<lang_pred: string, score: double>")(F.col(text_col))
    return docs.select(F.col(id_col), guess.alias("g")).select(id_col, "g.lang_pred", "g.score")


def held_out(id_col: str = "doc_id"):
    """Whether a row is never learnt from: crc32 of its id as text, modulo 3, is 1 (a null id: false)."""
    return F.coalesce(id_bucket(F.col(id_col)) == 1, F.lit(False))


def identify(docs: DataFrame, space: ProfileSpace | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, learnt from the rows that aren't held out.

    A row with a null id is judged, isn't held out, and teaches nothing. See ``fit`` and ``predict`` for other odd rows."""
    model = fit(docs.where(id_bucket(F.col("doc_id")) != 1), space)
    return predict(docs, model, space).withColumn("held_out", held_out())
