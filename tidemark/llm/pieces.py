"""SentencePiece encoding and decoding by shared-prefix Viterbi.

Texts are normalised as the model asks (blank becomes the mark ``▁``, one mark in front) and cut into
marked words. The distinct words of a batch are sorted, so that they form a trie in depth-first
order; the Viterbi forward scores of a common prefix are computed once and kept on a stack while
the traversal stays below it. Words already encoded by the task are not encoded again.

The segmentation is the library's unigram one: the path with the best sum of piece scores, the
longest last piece on ties, unknown characters as UTF-8 byte pieces. A unigram model's own scores are
used. A BPE model stores merge ranks instead; a piece of rank r then scores ``-log2(r + 2)``, rounded
to 1/64 so that sums are exact (frequencies fall about as one over the rank), and the path is the
library's for a unigram model with these scores.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import struct_array, text_udf
from tidemark.llm.vocabularies import path

MARK = "▁"
#: Encoded words kept in a task; beyond it the cache starts anew (results don't change).
CACHE_WORDS = 300_000
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class PieceModel:
    """A SentencePiece model file."""

    file: str = field(default_factory=lambda: path("piece_bpe_32k.model"))


def rank_scores(scores: np.ndarray) -> np.ndarray:
    """Scores for pieces whose stored score is minus their merge rank."""
    return -np.round(np.log2(2.0 - scores) * 64) / 64


class PieceCodec:
    """Encoding and decoding with one model."""

    def __init__(self, model: PieceModel):
        sp = sentencepiece.SentencePieceProcessor(model_file=model.file)
        size = sp.get_piece_size()
        self.names = [sp.id_to_piece(i) for i in range(size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(size)]
        byte = [sp.is_byte(i) for i in range(size)]
        stored = np.array([sp.get_score(i) for i in range(size)])
        plain = [i for i in range(size) if not (special[i] or byte[i])]
        ranked = bool(np.all(stored[plain] == np.round(stored[plain])))
        self.scores = rank_scores(stored) if ranked else stored
        self.unknown_id = sp.unk_id()
        self.unknown = float(self.scores[plain].min()) - UNKNOWN_PENALTY
        self.byte_id = {int(self.names[i][3:5], 16): i for i in range(size) if byte[i]}
        self.root: dict = {}
        for i in plain:
            node = self.root
            for c in self.names[i]:
                node = node.setdefault(c, {})
            node[""] = (float(self.scores[i]), i)
        joined = {c for i in plain if len(self.names[i]) > 1 for c in self.names[i]}
        if any(MARK in self.names[i].lstrip(MARK) for i in plain) or "\n" in joined:
            raise ValueError("pieces span marked words")
        self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n").findall
        self.plain = [
            bytes([int(n[3:5], 16)]) if byte[i] else b"" if special[i] else n.replace(MARK, " ").encode()
            for i, n in enumerate(self.names)
        ]
        self.known: dict[str, bytes] = {}

    def _ids(self, word: str, back: list) -> bytes:
        out, end = [], len(word)
        while end:
            start, i = back[end]
            if i >= 0:
                out.append(i)
            else:
                out.extend(self.byte_id.get(b, self.unknown_id) for b in reversed(word[start:end].encode()))
            end = start
        return np.array(out[::-1], "<i4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Encode the words that aren't known yet: depth first over their trie, forward scores on a stack."""
        new = sorted(words.difference(self.known))
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = sorted(words)
        root, unknown, last = self.root, self.unknown, ""
        best, back, open_ = [0.0], [(0, -1)], [[]]
        for word in new:
            shared = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], back[shared + 1 :], open_[shared + 1 :]
            for at in range(shared, len(word)):
                c, top, how, active = word[at], -1e300, None, []
                for start, node in open_[at]:
                    child = node.get(c)
                    if child is not None:
                        active.append((start, child))
                        piece = child.get("")
                        if piece is not None and best[start] + piece[0] > top:
                            top, how = best[start] + piece[0], (start, piece[1])
                child = root.get(c)
                single = None
                if child is not None:
                    active.append((at, child))
                    single = child.get("")
                score, i = single or (unknown, -1)
                if best[at] + score > top:
                    top, how = best[at] + score, (at, i)
                best.append(top)
                back.append(how)
                open_.append(active)
            self.known[word] = self._ids(word, back)
            last = word

    def words(self, text: str) -> list[str]:
        return self.cut(MARK + text.replace(" ", MARK)) if text else []

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of every text as little-endian 32-bit integers."""
        docs = [self.words(t) for t in texts]
        self.learn(set(itertools.chain.from_iterable(docs)))
        return [b"".join(map(self.known.__getitem__, d)) for d in docs]

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become replacement characters."""
        text = b"".join(map(self.plain.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


SCHEMA = "struct<ids: array<int>, n_tokens: bigint, round_trip: boolean>"


def encode(text: Column, model: PieceModel | None = None) -> Column:
    """A struct of ids, their number and whether decoding them gives the text back.

    Null and empty texts have no ids and round-trip. The mark itself in a text is read as a blank, as
    the model's normaliser does, so such a text's round trip is compared with blanks in their place.
    Texts are encoded whole, however long; every row by itself, so repeats and ties don't matter.
    """
    model = model or PieceModel()

    def make():
        codec = PieceCodec(model)

        def work(texts: list) -> pa.Array:
            texts = [t or "" for t in texts]
            ids = codec.encode_batch(texts)
            ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)])
            values = np.frombuffer(b"".join(ids), "<i4")
            flat = values.tolist()
            same = [codec.decode(flat[a:z]) == t.replace(MARK, " ") for a, z, t in zip(ends, ends[1:], texts)]
            return struct_array(
                {
                    "ids": (
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32())),
                        pa.list_(pa.int32()),
                    ),
                    "n_tokens": (np.diff(ends), pa.int64()),
                    "round_trip": (same, pa.bool_()),
                }
            )

        return work

    return text_udf(make, SCHEMA)(text)


def decode(ids: Column, model: PieceModel | None = None) -> Column:
    """The text of an array of ids; null for null."""
    model = model or PieceModel()

    def make():
        codec = PieceCodec(model)
        return lambda rows: pa.array([None if r is None else codec.decode(r) for r in rows], pa.string())

    return text_udf(make, "string")(ids)


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: PieceModel | None = None
) -> DataFrame:
    """(id, ids, n_tokens, round_trip) of every row; other columns are not read. Nothing is shuffled. Rows with a null id
    are encoded like others, repeated rows and ids each; an empty table gives an empty table."""
    return docs.select(F.col(id_col), encode(F.col(text_col), model).alias("e")).select(
        id_col, "e.ids", "e.n_tokens", "e.round_trip"
    )
