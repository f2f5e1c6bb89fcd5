"""Language spans: script ranges narrow the candidates of a word, and Viterbi decoding joins the words to spans.

Each word gets a log-likelihood per language from its character trigrams. Languages whose training text hardly has the
word's script are no candidates. The best labelling of a text pays a penalty for every switch of language, so a single odd
word does not make a span, and a passage in another language does.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_schema, batch_of, held_out, small_batches
from tidemark.llm.viterbi import decode_switching

# First code points of script blocks, and their scripts.
_RANGES = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "asian"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "african"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"),
    (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"), (0x30000, "han"),
]
UNKNOWN = "und"
_STARTS = [start for start, _ in _RANGES]
_SCRIPTS = sorted({name for _, name in _RANGES})
_RANGE_SCRIPT = np.array([_SCRIPTS.index(name) for _, name in _RANGES])
# ASCII letters stay, other ASCII splits words, bytes beyond stay.
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_BUCKETS = 1 << 16


def words_of(text: str) -> list[str]:
    """The lower-case words of a text, split at white space and at ASCII characters that are no letters."""
    return text.lower().encode().translate(_LETTERS).decode().split()


def looks(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(grams, starts, scripts): the trigrams of each word between its edges, as bucket numbers, and where each word's begin.

    scripts is the script of most letters of a word, -1 without letters; of equal counts the first by name.
    """
    codes = np.frombuffer("".join([f"\x02{w}\x03" for w in words]).encode("utf-32-le"), "<u4")
    lengths = np.array([len(w) for w in words])
    starts = np.cumsum(lengths) - lengths
    first = np.arange(int(lengths.sum())) + np.repeat(2 * np.arange(len(words)), lengths)
    mixed = codes * np.uint32(0x9E3779B1)
    mixed = mixed[first] ^ (codes[first + 1] * np.uint32(0x85EBCA6B)) ^ (codes[first + 2] * np.uint32(0xC2B2AE35))
    letters = codes[first + 1]
    values, at = np.unique(letters, return_inverse=True)
    is_letter = np.array([unicodedata.category(chr(c))[0] == "L" for c in values.tolist()], bool)[at]
    kind = _RANGE_SCRIPT[np.searchsorted(_STARTS, values, side="right") - 1][at]
    word = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount((word * len(_SCRIPTS) + kind)[is_letter], minlength=len(words) * len(_SCRIPTS))
    counts = counts.reshape(len(words), len(_SCRIPTS))
    return (mixed >> np.uint32(16)).astype(np.int64), starts, np.where(counts.any(1), counts.argmax(1), -1)


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order; log-probabilities by gram bucket and language; for each script its candidates."""

    languages: list[str]
    table: np.ndarray
    scripts: dict[int, np.ndarray]


class WordScores:
    """Rows of scores of the words seen so far."""

    def __init__(self, model: LanguageModel, most: int = 500_000):
        self.model, self.most = model, most
        self.number: dict[str, int] = {}
        self.rows = np.zeros((0, len(model.languages)), np.float32)

    def of(self, texts: list[list[str]]) -> list[list[int]]:
        """The rows of the words of each text; words without letters are left out."""
        if len(self.number) >= self.most:
            self.number, self.rows = {}, self.rows[:0]
        new = sorted(set().union(*texts) - self.number.keys())
        if new:
            grams, starts, kinds = looks(new)
            score = np.add.reduceat(self.model.table[grams], starts, axis=0)
            for kind in set(kinds.tolist()) & self.model.scripts.keys():
                own = kinds == kind
                score[own] -= np.where(self.model.scripts[kind], 0, 1000).astype(np.float32)
            base = len(self.rows)
            self.rows = np.concatenate([self.rows, score - score.max(1, keepdims=True)])
            for i, (word, kind) in enumerate(zip(new, kinds.tolist(), strict=True)):
                self.number[word] = base + i if kind >= 0 else -1
        row = self.number.__getitem__
        return [[r for r in map(row, words) if r >= 0] for words in texts]


def train(docs: DataFrame, per_language: int = 1000, smoothing: float = 0.5, least_share: float = 0.01) -> LanguageModel | None:
    """A model of `docs` (doc_id, text, lang), from at most `per_language` documents of each non-null lang.

    Rows that `held_out` names are not used. A script is a candidate for the languages that have at least `least_share`
    of their letters in it. None without such rows.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    known = known.select(F.col("lang").cast("string").alias("lang"), "doc_id", "text")
    order = Window.partitionBy("lang").orderBy("hash", "doc_id", "size")
    # at most per_language small rows of each language, so they are broadcast and the texts stay where they are;
    # of a common language, only documents whose hash lies in a small share come into question
    asked = known.groupBy("lang").count().select("lang", (3.0 * per_language / F.col("count")).alias("share"))
    hashed = known.select("lang", "doc_id", F.xxhash64("doc_id").alias("hash"), F.octet_length("text").alias("size"))
    picks = (
        hashed.join(asked, "lang").where(F.shiftrightunsigned("hash", 11) / float(1 << 53) < F.col("share"))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language)
        .select("lang", "doc_id", "size").distinct()
    )
    sample = known.withColumn("size", F.octet_length("text")).join(F.broadcast(picks), ["lang", "doc_id", "size"])
    sample = sample.select("lang", "text")
    out = arrow_schema("lang string,kind int,value int,n long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                counts: Counter[str] = Counter()
                for own, text in zip(langs, batch.column("text").to_pylist(), strict=True):
                    if own == lang:
                        counts.update(words_of(text))
                if not counts:
                    continue
                words, times = list(counts), np.array(list(counts.values()))
                grams, starts, kinds = looks(words)
                lengths = np.diff(np.r_[starts, len(grams)])
                by_gram = np.bincount(grams, np.repeat(times * (kinds >= 0), lengths), _BUCKETS)
                by_script = np.bincount(kinds + 1, times * lengths, len(_SCRIPTS) + 1)[1:]
                for which, totals in enumerate((by_script, by_gram)):
                    used = np.flatnonzero(totals)
                    yield batch_of(
                        {
                            "lang": [lang] * len(used), "kind": [which] * len(used), "value": used,
                            "n": totals[used].astype(np.int64),
                        },
                        out,
                    )

    counted = sample.mapInArrow(count, "lang string, kind int, value int, n long")
    got = counted.groupBy("lang", "kind", "value").agg(F.sum("n").alias("n")).toPandas()
    if not len(got):
        return None
    languages = sorted(got["lang"].unique())
    number = {lang: i for i, lang in enumerate(languages)}
    table = np.full((_BUCKETS, len(languages)), smoothing)
    letters: dict[int, np.ndarray] = {}
    for lang, kind, value, n in got.itertuples(index=False):
        if kind:
            table[value, number[lang]] += n
        else:
            letters.setdefault(value, np.zeros(len(languages)))[number[lang]] += n
    whole = np.sum(list(letters.values()), axis=0) if letters else 0
    scripts = {k: v / np.maximum(whole, 1) >= least_share for k, v in letters.items()}
    scripts = {k: v for k, v in scripts.items() if v.any()}
    return LanguageModel(languages, np.log(table / table.sum(0)).astype(np.float32), scripts)


def _groups(texts: list[list[int]], most: int) -> Iterator[tuple[int, list[list[int]]]]:
    first, held, size = 0, [], 0
    for i, rows in enumerate(texts):
        held.append(rows)
        size += len(rows)
        if size >= most:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def label(docs: DataFrame, model: LanguageModel | None, penalty: float = 12.0, group_words: int = 400_000) -> DataFrame:
    """`docs` without text, with lang_pred, score, span_langs and span_starts.

    The spans are runs of words, split at ASCII characters that are no letters, with one language each; span_starts counts
    words with letters. lang_pred is the language of most of them, the first in order of names if several are equal, and
    score is its share. `penalty` is in units of log-likelihood.

    A null text, a text without letters, or a missing model gives `und`, score 0 and no spans. Repeated rows get equal
    results; columns of `docs` with the new names are replaced; an empty table gives no rows.
    """
    added = T.StructType.fromDDL("lang_pred string, score double, span_langs array<string>, span_starts array<int>")
    carried = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", *added.names)]
    packed = small_batches(docs).select(F.coalesce("text", F.lit("")).alias("__text"), F.struct(*carried).alias("__row"))

    def decoded(texts: list[str], known: WordScores) -> Iterator[tuple[str, float, list[str], list[int]]]:
        rows = known.of([words_of(t) for t in texts])
        for _, group in _groups(rows, group_words):
            lengths = np.array([len(r) for r in group])
            flat = np.array([r for part in group for r in part], np.int64)
            path = decode_switching(known.rows[flat], lengths, penalty) if len(flat) else flat
            new = np.r_[True, path[1:] != path[:-1]] if len(flat) else np.zeros(0, bool)
            at = 0
            for n in lengths.tolist():
                own = path[at : at + n]
                if not n:
                    yield UNKNOWN, 0.0, [], []
                else:
                    counts = np.bincount(own, minlength=len(model.languages))
                    starts = np.flatnonzero(new[at : at + n])
                    starts = starts if len(starts) and not starts[0] else np.r_[0, starts]
                    top = int(counts.argmax())
                    yield model.languages[top], counts[top] / n, [model.languages[s] for s in own[starts]], starts.tolist()
                at += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordScores(model) if model else None
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            made = []
            if known is None:
                made = [(UNKNOWN, 0.0, [], [])] * len(texts)
            else:
                for i in range(0, len(texts), 1000):
                    made += decoded(texts[i : i + 1000], known)
            columns = [list(c) for c in zip(*made, strict=True)] if made else [[], [], [], []]
            kinds = (pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("__row"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=["__row", *added.names],
            )

    result = T.StructType([packed.schema["__row"], *added.fields])
    return packed.mapInArrow(run, result).select("__row.*", *added.names)
