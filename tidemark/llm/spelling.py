"""Spelling variants: words that differ by one code point, found by composing acceptors.

The vocabulary is the set of words of the corpus. Its minimised acceptor, a transducer that makes exactly one edit, and the
acceptor again are composed; every accepted path is a pair of near words. The composition is cut by its initial state: all
words that share a beginning and an end reach the same state, and a pair's edit lies between them. Words are dealt so that
each near pair meets in exactly one such state: the middle of the shorter word is halved, and the pair shares either the
half before the edit or the half behind it. States that too many words reach are halved again, down to one code point.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, batch_of, give_back, saved, small_batches, utf8

# `[A-Za-zÀ-ÿ]+` in UTF-8, after A-Z are in lower case
_RUN = re.compile(rb"(?:[a-z]++|\xc3[\x80-\xbf])++")
_KEY = ("m", "a", "b", "bound")


def variant(run: bytes, crc: int, every: int) -> bytes:
    """The run without one code point, if `every` divides its checksum."""
    if crc % every:
        return run
    text = run.decode()
    at = crc % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def _counts(docs: DataFrame, every: int, held: int) -> DataFrame:
    """(word, n): partial counts. A task holds at most about `held` distinct words, or those of one text if more."""
    schema = arrow_schema("word string,n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("id"), batch.column("bytes"), strict=True):
                seed = zlib.crc32(f"{doc_id.as_py()}:".encode())
                runs = Counter(m.group() for m in _RUN.finditer(text.as_py().lower()))
                for word, n in runs.items():
                    total[variant(word, zlib.crc32(word, seed), every)] += n
                if len(total) >= held:
                    yield batch_of({"word": [w.decode() for w in total], "n": list(total.values())}, schema)
                    total.clear()
        yield batch_of({"word": [w.decode() for w in total], "n": list(total.values())}, schema)
        give_back()

    return docs.mapInArrow(run, "word string, n long")


def vocabulary(docs: DataFrame, every: int = 97, shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, n): words of at least `shortest` code points with at least `least` occurrences in all texts together."""
    texts = small_batches(docs).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), utf8().alias("bytes")
    )
    counts = _counts(texts, every, 200_000).where(F.char_length("word") >= shortest)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class Acceptor:
    """The minimal acyclic automaton of some sorted, distinct words.

    `arcs[state]` maps a symbol to a state, `final[state]` tells if a word ends there. States with equal arcs and finality
    are one.
    """

    def __init__(self, words: Sequence[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        open_states: list[tuple[dict[str, int], bool, str]] = [({}, False, "")]  # arcs, final, symbol that led here

        def close(depth: int) -> None:
            while len(open_states) > depth + 1:
                arcs, final, symbol = open_states.pop()
                open_states[-1][0][symbol] = self._state(known, arcs, final)

        before = ""
        for word in words:
            shared = 0
            while shared < min(len(before), len(word)) and before[shared] == word[shared]:
                shared += 1
            close(shared)
            open_states.extend(({}, i == len(word) - 1, word[i]) for i in range(shared, len(word)))
            if not word:
                open_states[0] = (open_states[0][0], True, "")
            before = word
        close(0)
        self.start = self._state(known, open_states[0][0], open_states[0][1])

    def _state(self, known: dict[tuple, int], arcs: dict[str, int], final: bool) -> int:
        signature = (final, *arcs.items())
        if signature not in known:
            known[signature] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return known[signature]


def compose(acceptor: Acceptor, short: int, depth: int) -> Iterator[tuple[str, str]]:
    """Accepted pairs of acceptor, one-edit transducer and acceptor, each once.

    The first word has `short` symbols, the second as many (one replaced, in order of the replaced symbol) or one more (one
    inserted). The edit comes after fewer than `depth` symbols; an inserted symbol that repeats counts as inserted last.
    A state of the composition is (left state, edited or not, right state): before the edit both sides are in one state,
    after it they must agree symbol by symbol, which depends on the two states alone and is computed once for them.
    """
    arcs, final = acceptor.arcs, acceptor.final
    agreed: dict[tuple[int, int, int], tuple[str, ...]] = {}

    def common(left: int, right: int, length: int) -> tuple[str, ...]:
        """Words of `length` symbols that both states accept."""
        if not length:
            return ("",) if final[left] and final[right] else ()
        key = (left, right, length)
        if key not in agreed:
            others = arcs[right]
            agreed[key] = tuple(
                symbol + rest
                for symbol, state in arcs[left].items()
                if symbol in others
                for rest in common(state, others[symbol], length - 1)
            )
        return agreed[key]

    unedited = [(acceptor.start, "")]
    while unedited:
        state, read = unedited.pop()
        if len(read) >= depth or len(read) > short:
            continue
        out = sorted(arcs[state].items())
        left = short - len(read)
        for i, (symbol, target) in enumerate(out):
            for rest in common(state, target, left):
                if not rest.startswith(symbol):
                    yield read + rest, read + symbol + rest
            if left:
                for other, second in out[i + 1 :]:
                    for rest in common(target, second, left - 1):
                        yield read + symbol + rest, read + other + rest
            unedited.append((target, read + symbol))


def _ends(word: Column) -> list[Column]:
    """What the words of one initial state share: the first `a` and the last `b` code points."""
    return [F.substring(word, F.lit(1), F.col("a")).alias("head"), F.right(word, F.col("b")).alias("tail")]


def _halved(dealt: DataFrame) -> DataFrame:
    """Each row twice: the edit of a pair lies behind the first half of the middle of the shorter word, or within it.

    `bound` is how many code points the two words of a pair may share at the beginning, plus one.
    """
    half = F.floor((F.col("m") - F.col("a") - F.col("b")) / 2).cast("int")
    behind = F.struct((F.col("a") + half).alias("a"), F.col("b"), F.col("bound"))
    within = F.struct(F.col("a"), (F.col("m") - F.col("a") - half).alias("b"), (F.col("a") + half).alias("bound"))
    part = dealt.select("word", "n", "m", F.explode(F.array(behind, within)).alias("part"))
    return part.select("word", "n", "m", "part.a", "part.b", "part.bound")


def _found(dealt: DataFrame) -> DataFrame:
    """(word, near, form, form_n): for each initial state and word, its near words there and the most frequent of them."""
    schema = arrow_schema("word string,near long,form string,form_n long")

    def key(row: tuple) -> tuple:
        m, a, b, bound, word, _ = row
        return m, a, b, bound, word[:a], word[len(word) - b :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        found: list[tuple[str, int, str, int]] = []
        for (m, a, b, bound, head, tail), group in groupby(rows, key):
            count = {word: n for *_, word, n in group}
            if len(count) > 1:
                middles = sorted(word[a : len(word) - b] for word in count)
                found += _best(compose(Acceptor(middles), m - a - b, bound - a), count, head, tail)
            if len(found) >= 50_000:
                yield batch_of(dict(zip(schema.names, map(list, zip(*found, strict=True)), strict=True)), schema)
                found = []
        if found:
            yield batch_of(dict(zip(schema.names, map(list, zip(*found, strict=True)), strict=True)), schema)
        give_back()

    ends = _ends(F.col("word"))
    sorted_rows = dealt.repartition(*_KEY, *ends).sortWithinPartitions(*_KEY, *ends, "word")
    return sorted_rows.select(*_KEY, "word", "n").mapInArrow(run, "word string, near long, form string, form_n long")


def _best(pairs: Iterator[tuple[str, str]], count: dict[str, int], head: str, tail: str) -> list[tuple[str, int, str, int]]:
    near: Counter[str] = Counter()
    best: dict[str, tuple[int, str]] = {}
    for pair in pairs:
        one, two = (head + middle + tail for middle in pair)
        for word, other in ((one, two), (two, one)):
            near[word] += 1
            best[word] = min(best.get(word, (1, "")), (-count[other], other))
    return [(word, n, best[word][1], -best[word][0]) for word, n in near.items()]


def near_words(words: DataFrame, most: int = 16_384, longest: int = 64) -> DataFrame:
    """(word, n_near, form, form_n) of every word of (word, n) that has a near word; `form` is the most frequent of them.

    An initial state with over `most` words, or with over `longest` code points between what they share, is halved again.
    With one code point left, at most the alphabet and its pairs can meet, so every state ends up small.
    """
    size = F.char_length("word")
    shorter = F.array(size, size - 1)  # of its own length, or one more than the shorter word of the pair
    dealt = words.select("word", "n", F.explode(shorter).alias("m")).select(
        "word", "n", "m", F.lit(0).alias("a"), F.lit(0).alias("b"), (F.col("m") + 1).alias("bound")
    )
    key = [*_KEY, "head", "tail"]
    parts: list[DataFrame] = []
    while dealt is not None:
        dealt = _halved(dealt)
        states = dealt.select("*", *_ends(F.col("word"))).groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
        middle = F.col("m") - F.col("a") - F.col("b")
        again = (middle > 1) & ((F.col("rows") > most) | (middle > longest))
        large = saved(states.where((F.col("rows") > 1) & again).select(*key), "large_states")
        if large.isEmpty():
            parts.append(_found(dealt))
            dealt = None
        else:
            keyed = dealt.select("*", *_ends(F.col("word")))
            parts.append(_found(keyed.join(large, key, "left_anti").drop("head", "tail")))
            dealt = saved(keyed.join(large, key, "left_semi").drop("head", "tail"), "dealt_again")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    gathered = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    return gathered.select("word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form. Each round follows twice as many forms as the one before.

    A form occurs at least twice as often as its word, so chains are short and never closed.
    """
    links = saved(forms.where("form is not null").select("word", F.col("form").alias("root")), "links")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = saved(links.join(further, "root", "left").select("word", "root", "next"), "steps")
        links = step.select("word", F.coalesce("next", "root").alias("root"))
        if step.where("next is not null").isEmpty():
            return links


def group_variants(docs: DataFrame, every: int = 97, shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of `docs` (doc_id, text).

    Words are the runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case. A run loses one code point if `every`
    divides the CRC32 of "<doc_id>:<run>", the one at that number modulo its length. Words have at least `shortest` code
    points and `least` occurrences. Two are near if one inserted, deleted or replaced code point makes them equal. The form
    is the near word with the largest n (of equals, the first in code-point order) if that is at least twice the word's;
    the root is where forms lead to.

    A null text has no runs, a null doc_id is the empty text; repeated rows count as often as they come. Other columns are
    ignored. A word without near words has n_near 0 and neither form nor form_n; an empty table gives no rows.
    """
    words = saved(vocabulary(docs, every, shortest, least), "vocabulary")
    near = words.join(near_words(words), "word", "left")
    has = F.col("form_n") >= 2 * F.col("n")
    forms = near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n"),
    )
    forms = saved(forms, "forms")
    return forms.join(_roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
