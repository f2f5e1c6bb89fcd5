"""Quality rules: counts of words, symbols and repeats, and a linear-chain CRF that marks lines as content or boilerplate.

The CRF is trained on labelled documents: every line of a good document counts as content, of a bad one as boilerplate.
Viterbi decoding then gives each line the state that its looks and its neighbours make likeliest, and a document stays if
enough of its words stand in content lines.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_schema, batch_of, bounded_sample, held_out, per_batch, small_batches, utf8
from tidemark.llm.viterbi import decode

SYMBOLS = b"#*$%&|<>"
_SPACE_AND_TAILS = b" \t\n\x0b\x0c\r" + bytes(range(0x80, 0xC0))
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(0x80, 0x100))
_DIGITS = b"0123456789"
CONTENT, BOILERPLATE = 0, 1


def repeated_words(words: list[bytes]) -> int:
    """Words in a window of three that occurs twice or more in the list, the first included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    repeated = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= repeated
    return int(covered.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text in UTF-8."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, _SPACE_AND_TAILS)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def line_features(line: bytes, words: list[bytes], again: bool) -> tuple[float, ...]:
    """How a line looks; each value is between 0 and 1. `again`: an earlier line of the text is equal."""
    size, count = len(line), len(words)
    bare = len(line.translate(None, SYMBOLS))
    letters = size - len(line.translate(None, _LETTERS))
    upper = size - len(line.translate(None, _UPPER))
    digits = size - len(line.translate(None, _DIGITS))
    marks = line.count(b"!")
    distinct = len(set(words)) / count
    twins = sum(map(bytes.__eq__, words, words[1:])) / count
    pipes = line.count(b"|") / count
    return (
        1.0,
        float(count < 5), float(count < 12),
        min(1.0, (size - bare) / size * 4),
        letters / size,
        upper / max(letters, 1), float(upper > 0.5 * letters),
        digits / size, float(digits > 0.2 * size),
        min(1.0, marks / count),
        1.0 - distinct, float(distinct < 0.4 and count > 8),
        min(1.0, twins * 2),
        min(1.0, pipes * 2), float(pipes > 0.2),
        float(line.rstrip()[-1:] in b".?!"),
        float(again),
    )


N_FEATURES = len(line_features(b"a", [b"a"], False))


def lines_of(text: bytes) -> tuple[list[tuple[float, ...]], list[int]]:
    """Features and numbers of words of the lines that have words."""
    seen: set[bytes] = set()
    features, counts = [], []
    for line in text.split(b"\n"):
        if words := line.split():
            features.append(line_features(line, words, line in seen))
            counts.append(len(words))
            seen.add(line)
    return features, counts


@dataclass(frozen=True)
class LineModel:
    """Weights of a linear-chain CRF with two states: (features, states) and (from, to)."""

    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    def states(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        scores = features @ self.weights
        firsts = np.cumsum(lengths) - lengths
        scores[firsts[lengths > 0]] += self.start
        return decode(scores, lengths[lengths > 0], self.moves)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit_crf(
    features: np.ndarray, lengths: np.ndarray, labels: np.ndarray, rounds: int = 150, rate: float = 0.2, l2: float = 1e-3,
    l2_moves: float = 0.2,
) -> LineModel:
    """A CRF for sequences of lines with one state each, by gradient ascent on the conditional likelihood.

    `features` (lines, features) holds the sequences one after the other. Long sequences are trained in pieces of 32 lines.
    `l2_moves` keeps the moves between states weak: where labels come from whole documents, no state ever changes within
    one, and free moves would let the first line decide for all.
    """
    pieces = [min(32, int(n) - i) for n in lengths for i in range(0, int(n), 32)]
    longest, width = max(pieces), features.shape[1]
    x = np.zeros((len(pieces), longest, width))
    y = np.zeros((len(pieces), longest), np.int64)
    mask = np.arange(longest)[None, :] < np.array(pieces)[:, None]
    x[mask], y[mask] = features, labels
    eye = np.eye(2)
    weights, moves, start = np.zeros((width, 2)), np.zeros((2, 2)), np.zeros(2)
    speed = [np.zeros_like(p) for p in (weights, moves, start)]
    # both classes count alike, whatever their shares
    share = np.array([max(1, (y[mask] == s).sum()) for s in (0, 1)], float)
    importance = (mask * (share.sum() / (2 * share))[y]).max(1)[:, None]
    total = importance.sum()
    real = mask[:, 1:, None, None] & mask[:, :-1, None, None]
    pairs = (eye[y[:, :-1]][:, :, :, None] * eye[y[:, 1:]][:, :, None, :]) * real
    for _ in range(rounds):
        scores = x @ weights
        scores[:, 0] += start
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0]
        for t in range(1, longest):
            step = _log_sum(forward[:, t - 1, :, None] + moves, 1) + scores[:, t]
            forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = _log_sum(moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
        whole = _log_sum(forward[:, -1], 1)
        node = np.exp(forward + backward - whole[:, None, None]) * mask[:, :, None]
        edge = (
            forward[:, :-1, :, None] + moves + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - whole[:, None, None, None]
        )
        edge = np.exp(np.where(real, edge, -50.0)) * real
        off = (eye[y] - node) * mask[:, :, None] * importance[:, :, None]
        gradients = (
            np.einsum("ptf,pts->fs", x, off) / total - l2 * weights,
            ((pairs - edge) * importance[:, :, None, None]).sum((0, 1)) / total - l2_moves * moves,
            off[:, 0].sum(0) / total,
        )
        for p, v, g in zip((weights, moves, start), speed, gradients, strict=True):
            v *= 0.9
            v += rate * g
            p += v
    return LineModel(weights, moves, start)


def train_lines(docs: DataFrame, labels: DataFrame, per_class: int = 1500) -> LineModel | None:
    """The line model of documents labelled by `quality` (1: good), at most `per_class` of each class.

    Rows that `held_out` names are not used. None if a class has no lines.
    """
    known = labels.where(F.col("quality").isNotNull() & ~held_out()).select("doc_id", F.col("quality").cast("int"))
    sample = bounded_sample(known.distinct(), "quality", per_class)
    texts = docs.select("doc_id", utf8().alias("text")).join(F.broadcast(sample), "doc_id")

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            features = [lines_of(t.as_py())[0] for t in batch.column("text")]
            return {
                "lines": [np.array(f, "<f4").tobytes() for f in features],
                "n": [len(f) for f in features],
                "quality": batch.column("quality"),
            }

        return step

    got = per_batch(texts, make, "lines binary,n int,quality int").where("n > 0").toPandas()
    if got["quality"].nunique() < 2:
        return None
    got = got.sort_values(["quality", "n", "lines"])  # the same sum on every run
    features = np.frombuffer(b"".join(got["lines"]), "<f4").reshape(-1, N_FEATURES).astype(float)
    states = np.repeat(np.where(got["quality"] == 1, CONTENT, BOILERPLATE), got["n"])
    return fit_crf(features, got["n"].to_numpy(), states)


def judge(
    docs: DataFrame, model: LineModel | None, min_words: int = 50, most_repeated: int = 50, min_content: float = 0.5
) -> DataFrame:
    """`docs` with the base counts, base_failed, content_share and kept in place of text.

    base_failed: fewer than `min_words` words, or over `most_repeated` percent of the words in repeated windows. kept: not
    base_failed and at least `min_content` of the words in lines that the model calls content; without a model all lines are.

    A null or empty text has no words, so it fails. Lines without words belong to no state. Repeated rows and null ids are
    judged like any other; columns of `docs` with the new names are replaced; an empty table gives no rows.
    """
    added = T.StructType.fromDDL(
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "content_share double, kept boolean"
    )
    carried = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", *added.names)]
    packed = small_batches(docs).select(utf8().alias("__bytes"), F.struct(*carried).alias("__row"))
    out = arrow_schema(
        "n_words long,word_chars long,n_symbols long,n_dup_lines long,n_repeat_words long,base_failed boolean,"
        "content_share double,kept boolean"
    )

    def verdicts(texts: pa.Array) -> pa.RecordBatch:
        base, features, words, lengths = [], [], [], []
        for text in texts:
            text = text.as_py()
            base.append(base_counts(text))
            if model is not None:
                rows, counts = lines_of(text)
                features += rows
                words += counts
                lengths.append(len(counts))
        n, chars, symbols, dups, repeats = np.array(base, np.int64).T
        failed = (n < min_words) | (100 * repeats > most_repeated * n)
        share = np.ones(len(n))
        if features:
            content = model.states(np.array(features), np.array(lengths)) == CONTENT
            of = np.repeat(np.arange(len(n)), lengths)
            share = np.bincount(of, np.array(words) * content, len(n)) / np.maximum(n, 1)
        share = np.where(n > 0, share, 0.0)
        columns = (n, chars, symbols, dups, repeats, failed, share, ~failed & (share >= min_content))
        return batch_of(dict(zip(added.names, columns, strict=True)), out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = verdicts(batch.column("__bytes"))
                yield pa.RecordBatch.from_arrays([batch.column("__row"), *made.columns], names=["__row", *added.names])

    result = T.StructType([packed.schema["__row"], *added.fields])
    return packed.mapInArrow(run, result).select("__row.*", *added.names)
