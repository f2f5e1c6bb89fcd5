"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every text becomes k-grams of words. Of each sliding window of w k-grams the least hash is kept, the last one of equals, so
two texts that share k + w - 1 words in a row keep the same gram of that span. Fingerprints of the documents are joined to
those of the benchmark; a hit tells where in the document a benchmark window would start, and is extended: the words there
are compared with the window's own, so a hash collision costs time and no result.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved, utf8


def _lowered(text: Column) -> Column:
    """A-Z in lower case. lower() would change other letters too, but is faster where there are none."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def word_list(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null has none."""
    lowered = _lowered(F.coalesce(text, F.lit("")))
    return F.filter(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _positions(first: int, last: Column, body: Callable[[Column], Column], kind: str) -> Column:
    """`body` of every number from `first` to `last`; an empty array if there is none."""
    return F.when(last >= first, F.transform(F.sequence(F.lit(first), last), body)).otherwise(
        F.array().cast(f"array<{kind}>")
    )


def _grams(words: Column, gram: int) -> Column:
    """The hash of the `gram` words at each place."""
    return _let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: _positions(
            0, F.size(h) - gram, lambda i: F.xxhash64(*[F.get(h, i + n) for n in range(gram)]), "bigint"
        ),
    )


def _kept(grams: Column, window: int) -> Column:
    """For every window of grams, the place of its least hash; of equal ones the last."""

    def place(j: Column) -> Column:
        return _let(
            F.slice(grams, j + 1, window),
            lambda g: j + F.lit(window) - F.array_position(F.reverse(g), F.array_min(g)).cast("int"),
        )

    return _positions(0, F.size(grams) - window, place, "int")


def _shape(length: int, gram: int) -> tuple[int, int]:
    """Words of a gram and grams of a window, so that every span of `length` words keeps a fingerprint."""
    gram = min(gram, length)
    return gram, length - gram + 1


def winnowed(docs: DataFrame, lengths: list[int], gram: int) -> DataFrame:
    """(doc_id, key, n_words, length, hash, at): the fingerprints of each row of `docs` (doc_id, key, text), each place once.

    For every span of `length` words at least one. Besides, each row of `docs` has one row with length 0 and no place.

    Texts become arrays of gram hashes; windows are rows over them, made and dropped within one stage. A window keeps
    another place than the one before it if its last hash is the least, or if the hash that left was.
    """
    kinds = sorted({_shape(n, gram)[0] for n in lengths})
    hashed = docs.select(
        "doc_id", "key",
        _let(
            word_list(F.col("text")),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"), *[_grams(w, k).alias(f"grams{k}") for k in kinds]
            ),
        ).alias("own"),
    )
    starts = F.explode(F.sequence(F.lit(0), F.col("own.n_words").cast("int"))).alias("j")
    rows = hashed.select(
        "doc_id", "key", F.col("own.n_words").alias("n_words"), *[F.col(f"own.grams{k}").alias(f"grams{k}") for k in kinds],
        starts,
    )
    j = F.col("j")
    is_new, prints = [j == 0], [F.when(j == 0, _print(0, F.xxhash64("doc_id"), F.lit(None).cast("int")))]
    for length in sorted(lengths):
        k, window = _shape(length, gram)
        hashes = F.col(f"grams{k}")
        last = F.get(hashes, j + (window - 1))
        new = last.isNotNull()
        if window > 1:
            rest = [F.get(hashes, j + n) for n in range(window - 1)]
            rest = F.least(*rest) if len(rest) > 1 else rest[0]
            new = new & ((j == 0) | (last <= rest) | (F.get(hashes, j - 1) < rest))
        # short expressions: Java compiles no method of more than 8,000 bytes, and all of this becomes one
        within = F.slice(hashes, j + 1, window)
        place = j + F.lit(window) - F.array_position(F.reverse(within), F.array_min(within)).cast("int")
        is_new.append(new)
        prints.append(F.when(new, _print(length, F.array_min(within), place)))
    # a window that keeps nothing new goes before its row is copied, arrays and all
    kept = rows.where(reduce(lambda x, y: x | y, is_new))
    return kept.select("doc_id", "key", "n_words", F.inline(F.array(*prints))).where("length is not null")


def _print(length: int, value: Column, at: Column) -> Column:
    return F.struct(F.lit(length).alias("length"), value.alias("hash"), at.alias("at"))


def _item_windows(items: DataFrame, length: int, gram: int, most: int) -> DataFrame:
    """(item_id, length, words, hash, offset) of every window of `length` words; shorter ones only if they are the item."""
    gram, window = _shape(length, gram)
    chosen = items.where(F.size("words") >= length if length == most else F.size("words") == length)
    places = _let(
        _grams(F.col("words"), gram),
        lambda g: F.transform(
            _kept(g, window), lambda p, j: F.struct(j.alias("start"), (p - j).alias("offset"), F.get(g, p).alias("hash"))
        ),
    )
    one = chosen.select("item_id", "words", F.explode(places).alias("w"))
    return one.select(
        "item_id", F.lit(length).alias("length"),
        F.array_join(F.slice("words", F.col("w.start") + 1, length), " ").alias("words"), "w.hash", "w.offset",
    )


def covered(spans: Column) -> Column:
    """How many words an array of struct<start, end> covers."""
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))
    return F.aggregate(
        F.array_sort(spans),
        state,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], s["reach"]))).cast("long").alias("n"),
            F.greatest(s["reach"], x["end"]).cast("long").alias("reach"),
        ),
        lambda s: s["n"],
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, length: int = 10, gram: int = 5) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated), one row per row of `docs` (doc_id, text).

    A window is `length` consecutive words of an item of `benchmark` (item_id, text); an item of fewer words is one window.
    A word of a document is hit if it lies in an occurrence of a window. `items` are the ids, as text in order and once
    each, of the items that have such a window; a null id is the empty text. Every occurrence is found: a shared span of
    `length` words has a fingerprint in common.

    Null and empty texts have no words, nor hits. Repeated rows stay; what is found is kept by the digest of the text, so
    equal texts are judged alike whatever their ids. Repeated items are one. Other columns are ignored; an empty table of
    documents gives no rows, an empty benchmark no hits. A long text is one row and is never cut.

    Fingerprints of the benchmark are written first, so their size is known: Spark broadcasts them while they are below its
    limit, and joins by hash beyond it. To extend hits, texts are joined to them by digest: the texts are shuffled once, the
    same way at every size.
    """
    items = saved(
        benchmark.select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
            word_list(F.col("text")).alias("words"),
        ).where(F.size("words") > 0),
        "items",
    )
    # at most `length` numbers
    lengths = [r[0] for r in items.select(F.least(F.size("words"), F.lit(length))).distinct().collect()]
    digest = F.unhex(F.sha2(utf8(), 256))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("key"), "text")
    none = {
        "n_hit": F.lit(0).cast("long"), "items": F.array().cast("array<string>"),
    }
    if not lengths:
        found = own.select("doc_id", F.size(word_list(F.col("text"))).cast("long").alias("n_words")).withColumns(none)
    else:
        windows = saved(_all_windows(items, lengths, gram, length), "windows")
        # texts are cut into words once: a row of length 0 for each of them, with its words, and the hits
        met = saved(_met(own, windows, lengths, gram), "met")
        counted = met.where("length = 0").select("doc_id", "key", "n_words")
        hits = saved(_hits(met), "hits")
        known = windows.groupBy("length", "words").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
        # written before it is joined on: a text that very many rows have is then split over tasks
        spans = saved(_spans(own, hits), "spans").join(saved(known, "known"), ["length", "words"])
        extended = spans.select("key", "length", "start", "items").distinct()
        span = F.struct(F.col("start").cast("long").alias("start"), (F.col("start") + F.col("length")).cast("long").alias("end"))
        by_text = extended.groupBy("key").agg(
            covered(F.collect_list(span)).alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        by_text = saved(by_text, "found")
        found = counted.join(by_text, "key", "left").withColumns(
            {name: F.coalesce(name, default) for name, default in none.items()}
        )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _all_windows(items: DataFrame, lengths: list[int], gram: int, most: int) -> DataFrame:
    parts = [_item_windows(items, n, gram, most) for n in sorted(lengths)]
    windows = parts[0]
    for part in parts[1:]:
        windows = windows.unionByName(part)
    return windows.distinct()


def _met(own: DataFrame, windows: DataFrame, lengths: list[int], gram: int) -> DataFrame:
    """The rows of `winnowed` that the benchmark has too, with the offsets of its windows, and those of length 0."""
    wanted = saved(windows.groupBy("length", "hash").agg(F.collect_set("offset").alias("offsets")), "fingerprints")
    met = winnowed(own, lengths, gram).join(wanted, ["length", "hash"], "left")
    return met.where("length = 0 or offsets is not null").select("doc_id", "key", "n_words", "length", "at", "offsets")


def _hits(met: DataFrame) -> DataFrame:
    """(key, starts): where, by their fingerprints, windows of the benchmark may start in a text."""
    starts = met.where("length > 0").select(
        "key", "length", F.explode(F.transform("offsets", lambda o: F.col("at") - o)).alias("start")
    )
    starts = starts.where("start >= 0").distinct()
    return starts.groupBy("key").agg(F.collect_list(F.struct("length", "start")).alias("starts"))


def _spans(own: DataFrame, hits: DataFrame) -> DataFrame:
    """(key, length, start, words): the words of the texts from the starts on."""
    texts = own.select("key", "text").join(hits.hint("merge"), "key")

    def spelled(own: Column) -> Column:
        return F.transform(
            "starts",
            lambda s: F.struct(
                s["length"].alias("length"), s["start"].alias("start"),
                F.array_join(F.slice(own, s["start"] + 1, s["length"]), " ").alias("words"),
            ),
        )

    return texts.select("key", _let(word_list(F.col("text")), spelled).alias("spans")).select("key", F.inline("spans"))
