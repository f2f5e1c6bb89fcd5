"""Toxicity by multiple-instance learning: documents carry the labels, sentences are what is scored.

A sentence's probability is logistic in the weights of its words, and a document's is the noisy-or of its sentences': it is
toxic unless every sentence is not. Sentences without any weighted word are no evidence, however many they are; in their
place stands one small leak per document. Training maximises the likelihood of the document labels through that combination, so
the gradient goes to the sentences that explain a label. Scoring reports the sentences that offend, with their places.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_sample, held_out, small_batches, utf8

# ASCII letters in lower case, sentence ends as line feeds, all else but digits, apostrophes and bytes beyond as spaces.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90
    else 10 if chr(c) in ".!?\n"
    else c if c >= 128 or chr(c).isalnum() or chr(c) == "'"
    else 32
    for c in range(256)
)


def sentences(text: bytes) -> list[bytes]:
    """The sentences of a text, plain; joined by one byte each they have the text's length."""
    return text.translate(_PLAIN).split(b"\n")


def features(word: bytes) -> list[bytes]:
    """What a word is known by: itself, and its first four and five bytes if it is longer."""
    return [word, *[word[:n] + b"~" for n in (4, 5) if len(word) > n]]


def softplus(z: float) -> float:
    return z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))


@dataclass(frozen=True)
class ToxicModel:
    """Weights of words and word beginnings, and the log-odds that they are added to."""

    weights: dict[bytes, float]
    bias: float

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer(dict):
    """A model with the summed weights of the words seen so far; None for those without any."""

    def __init__(self, model: ToxicModel, most: int = 500_000):
        super().__init__()
        self.weights, self.bias, self.most = model.weights, model.bias, most

    def __missing__(self, word: bytes) -> float | None:
        found = [self.weights[f] for f in features(word) if f in self.weights]
        self[word] = total = sum(found) if found else None
        return total

    def score(self, text: bytes, offends: float = 0.5) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's probability, and (start, end, probability) in bytes of sentences of at least `offends`."""
        if len(self) > self.most:
            self.clear()
        get, total, at, found = self.__getitem__, softplus(self.bias), 0, []
        for sentence in sentences(text):
            hits = [w for w in map(get, sentence.split()) if w is not None]
            if hits:
                z = self.bias + sum(hits)
                total += softplus(z)
                if (p := 1 / (1 + math.exp(-max(z, -700)))) >= offends:
                    found.append((at, at + len(sentence), p))
            at += len(sentence) + 1
        return 1 - math.exp(-total), found


def fit(
    texts: list[bytes], toxic: np.ndarray, share: float, min_docs: int = 5, lift: float = 2.0, rounds: int = 300,
    rate: float = 0.3, l1: float = 1e-5,
) -> ToxicModel:
    """Weights by proximal gradient steps on the noisy-or likelihood, as if `share` of the texts were toxic.

    Only features of at least `min_docs` texts that toxic texts have `lift` times as often as others get weights: a
    sentence offends by what it has. The penalty `l1` keeps the weights of features that explain nothing at zero.
    """
    bags = [[s.split() for s in sentences(t) if s.strip()] for t in texts]
    in_docs: tuple[Counter[bytes], Counter[bytes]] = (Counter(), Counter())
    for bag, label in zip(bags, toxic, strict=True):
        in_docs[label].update({f for w in {w for s in bag for w in s} for f in features(w)})
    clean, bad = max(1, int((toxic == 0).sum())), max(1, int((toxic == 1).sum()))
    telling = sorted(
        f for f, n in in_docs[1].items()
        if n + in_docs[0][f] >= min_docs and (n + 0.5) / bad >= lift * (in_docs[0][f] + 0.5) / clean
    )
    number = {f: i for i, f in enumerate(telling)}
    known = {w: [number[f] for f in features(w) if f in number] for w in {w for b in bags for s in b for w in s}}
    sentence_doc = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    pairs = [(i, k) for i, s in enumerate(s for b in bags for s in b) for w in s for k in known[w]]
    rows, words = np.array(pairs, np.int64).reshape(-1, 2).T
    kept, rows = np.unique(rows, return_inverse=True)
    sentence_doc, n_sentences = sentence_doc[kept], len(kept)
    weights, bias = np.zeros(len(number)), -5.0
    moment, square, step_b, square_b = np.zeros(len(number)), np.zeros(len(number)), 0.0, 0.0
    y = toxic.astype(float)
    balance = np.where(y > 0, share / bad, (1 - share) / clean)
    for turn in range(1, rounds + 1):
        z = bias + np.bincount(rows, weights[words], n_sentences)
        total = np.logaddexp(0, bias) + np.bincount(sentence_doc, np.logaddexp(0, z), len(bags))
        miss = np.exp(-total)
        slope = balance * (1 - y / np.maximum(1 - miss, 1e-9))
        dz = slope[sentence_doc] / (1 + np.exp(-np.clip(z, -500, 500)))
        g, gb = np.bincount(words, dz[rows], len(number)), dz.sum() + slope.sum() / (1 + math.exp(-bias))
        moment, square = 0.9 * moment + 0.1 * g, 0.999 * square + 0.001 * g * g
        step_b, square_b = 0.9 * step_b + 0.1 * gb, 0.999 * square_b + 0.001 * gb * gb
        fix, fix2 = 1 - 0.9**turn, 1 - 0.999**turn
        scale = rate / (np.sqrt(square / fix2) + 1e-6)
        weights = weights - scale * moment / fix
        weights = np.sign(weights) * np.maximum(np.abs(weights) - scale * l1, 0)
        bias -= rate * step_b / fix / (math.sqrt(square_b / fix2) + 1e-6)
    return ToxicModel({w: float(weights[i]) for w, i in number.items() if abs(weights[i]) > 1e-3}, float(bias))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2000) -> ToxicModel | None:
    """A model of `labels` (doc_id, toxic), from at most `per_class` documents of each class.

    Rows that `held_out` names are not used. None if one of the classes has no documents.
    """
    known = labels.where(F.col("toxic").isNotNull() & ~held_out()).select("doc_id", F.col("toxic").cast("int"))
    sample = bounded_sample(known.distinct(), "toxic", per_class)
    share = known.agg(F.avg("toxic")).first()[0]
    got = docs.select("doc_id", utf8().alias("text")).join(F.broadcast(sample), "doc_id").toPandas()
    if got["toxic"].nunique() < 2:
        return None
    got = got.sort_values(["doc_id", "text", "toxic"])  # the same sums on every run
    return fit([bytes(t) for t in got["text"]], got["toxic"].to_numpy(), share)


def score(docs: DataFrame, model: ToxicModel | None, threshold: float = 0.3, offends: float = 0.5) -> DataFrame:
    """`docs` without text, with score, predicted, and starts, ends and scores of the sentences that offend (in bytes).

    A null or empty text has no sentences and the score of the leak; without a model all scores are 0. Only the text is looked at.
    Repeated rows get equal scores; columns of `docs` with the new names are replaced; an empty table gives no rows.
    """
    added = T.StructType.fromDDL("score double, predicted int, starts array<int>, ends array<int>, scores array<double>")
    carried = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", *added.names)]
    packed = small_batches(docs).select(utf8().alias("__bytes"), F.struct(*carried).alias("__row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer() if model else None
        for batch in batches:
            rows = [scorer.score(t.as_py(), offends) if scorer is not None else (0.0, []) for t in batch.column("__bytes")]
            columns = [
                pa.array([p for p, _ in rows], pa.float64()),
                pa.array([int(p >= threshold) for p, _ in rows], pa.int32()),
                pa.array([[s[0] for s in x] for _, x in rows], pa.list_(pa.int32())),
                pa.array([[s[1] for s in x] for _, x in rows], pa.list_(pa.int32())),
                pa.array([[s[2] for s in x] for _, x in rows], pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("__row"), *columns], names=["__row", *added.names])

    result = T.StructType([packed.schema["__row"], *added.fields])
    return packed.mapInArrow(run, result).select("__row.*", *added.names)
