"""Alignment of two tokenizers over a corpus, window by window.

Every text is tokenised by both, all of it, before anything is aligned. Where a token of each ends at the same byte and the next token of each starts with a
space, the text is cut; such anchors are common, since words start there. A window between two anchors is known by its two
tuples of ids alone, so its alignment is computed once and kept for later windows with the same ids. A window's links are
pairs of ids; the documents of a block number the pairs they hold. Pairs are counted by block before they are shuffled, the
corpus-wide counts go back to the blocks that asked, and documents add them up.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, batch_of, gathered, give_back, saved, small_batches, utf8

# A space between two characters that are no white space under any rule. Neither tokenizer has a token, or looks ahead, across
# the place before it, and both put a space before a text, so the parts of a text have the tokens of the text.
_VISIBLE = "[!-~\xa1-\u167f\u2070-\u2580\u2582-\u2fff\u3001-\ud7ff\ue000-\ufefe]"
_CUT = re.compile(f" (?<={_VISIBLE} )(?={_VISIBLE})")


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a letter: printable ones as themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Tokens:
    """One tokenizer: the bytes of each id, their number, and whether they start with a space."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.spaced = np.array([p.startswith(b" ") for p in pieces])


class ByteLevel(Tokens):
    """A byte-level BPE file; special tokens inside texts are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.model = tokenizers.Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        table = _byte_of_letter()
        pieces = [b""] * self.model.get_vocab_size()
        for piece, number in self.model.get_vocab().items():
            pieces[number] = bytes(table[c] for c in piece) if all(c in table for c in piece) else piece.encode()
        super().__init__(pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = self.model.encode_batch_fast([" " + text for text in texts], add_special_tokens=False)
        return [one.ids for one in found]


class Pieces(Tokens):
    """A sentence-piece file with byte fallback, which puts a space before each text."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.whole_words = not any(re.search("[^▁]▁", p) for p in pieces)
        super().__init__(
            [
                bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ]
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@cache
def _loaded(byte_level: str, pieces: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(byte_level), Pieces(pieces)


class Tokeniser:
    """Both tokenizers over texts, in parts that have the tokens of the text."""

    def __init__(self, one: Tokens, two: Pieces, lot: int = 1 << 18):
        self.one, self.two, self.lot = one, two, lot

    def parts(self, text: str) -> list[str]:
        return _CUT.split(text) if self.two.whole_words and text else [text] if text else []

    def lots(self, parts: list[str]) -> Iterator[tuple[int, int, list[np.ndarray], list[np.ndarray], np.ndarray]]:
        """Tokenises parts in lots of about `lot` characters, which bounds what the libraries hold at a time.

        For each lot: its first and last part, the ids by both one after the other, their number by part, and whether both
        give back a space and the part.
        """
        first = size = 0
        for last, part in enumerate(parts):
            size += len(part)
            if size >= self.lot or last == len(parts) - 1:
                some = parts[first : last + 1]
                texts = [b" " + p.encode() for p in some]
                sizes = np.fromiter(map(len, texts), np.int64, len(texts))
                sides, numbers, same = [], [], np.ones(len(some), bool)
                for tokens in (self.one, self.two):
                    found = tokens.encode(some)
                    n = np.fromiter(map(len, found), np.int64, len(found))
                    ids = np.fromiter(chain.from_iterable(found), np.int64, int(n.sum()))
                    pieces = [tokens.pieces[i] for i in ids.tolist()]
                    ends = np.cumsum(n)
                    lengths = np.diff(np.r_[0, np.cumsum(tokens.sizes[ids])][np.r_[0, ends]])
                    # all at once where nothing differs, as is usual
                    if not (lengths == sizes).all() or b"".join(pieces) != b"".join(texts):
                        bounds = np.r_[0, ends].tolist()
                        own = [b"".join(pieces[p:q]) for p, q in zip(bounds[:-1], bounds[1:], strict=True)]
                        same &= np.array([x == y for x, y in zip(own, texts, strict=True)], bool)
                    sides.append(ids)
                    numbers.append(n)
                yield first, last + 1, sides, numbers, same
                first, size = last + 1, 0

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of each text by both; none if the bytes of either are not a space and the text, or if it is empty."""
        owned = [self.parts(text) for text in texts]
        parts = list(dict.fromkeys(chain.from_iterable(owned)))
        known = {}
        for first, to, sides, numbers, same in self.lots(parts):
            split = [np.split(ids, np.cumsum(n)[:-1]) for ids, n in zip(sides, numbers, strict=True)]
            known.update(zip(parts[first:to], zip(*split, same.tolist(), strict=True), strict=True))
        none = np.zeros(0, np.int64)
        return [
            tuple(np.concatenate([none, *[known[p][side] for p in own]]) for side in (0, 1))
            if all(known[p][2] for p in own)
            else (none, none)
            for own in owned
        ]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each start on, `size` of them, one range after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


@cache
def _names(n_a: int, n_b: int) -> list[str]:
    """Each id of the first side, then of the second, as it is written inside a group and at the end of its side."""
    sides = ((n_a, ",|"), (n_b, ",;"))
    return [f"{number}{mark}" for size, marks in sides for number in range(size) for mark in marks]


class Windows:
    """The windows of a block that are aligned already, by their ids, and the pairs of ids seen, numbered as they appear.

    Every part of a text starts with a space, so an anchor lies between two parts and a part's windows are its own. A part
    that comes again in the block has its windows already; so has a new part whose tuples of ids came in another.
    """

    def __init__(self, one: Tokens, two: Pieces):
        self.one, self.two, self.tokeniser = one, two, Tokeniser(one, two)
        self.names = _names(len(one.pieces), len(two.pieces))
        self.known: defaultdict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.number: defaultdict[int, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.links = np.zeros(0, np.int64)  # pair numbers of all known windows, one after the other
        self.start = self.n_links = self.n_groups = np.zeros(0, np.int64)  # by window
        self.groups: list[str] = []
        self.part: defaultdict[str, int] = defaultdict()
        self.part.default_factory = self.part.__len__
        self.owned = np.zeros(0, np.int64)  # windows of all known parts, one after the other
        self.owned_from, self.n_owned = np.zeros(0, np.int64), np.zeros(0, np.int64)  # by part
        self.n_tokens = [np.zeros(0, np.int64), np.zeros(0, np.int64)]  # by part, of each side
        self.whole = np.zeros(0, bool)  # by part
        self.text: list[str] = []  # groups by part

    def learn(self, parts: list[str]) -> None:
        """The windows of new parts, which come in the order of their numbers."""
        for _, _, (a, b), (n_a, n_b), same in self.tokeniser.lots(parts):
            a, b = a[np.repeat(same, n_a)], b[np.repeat(same, n_b)]
            n_a, n_b = n_a * same, n_b * same
            codes, ends = self.codes(a, b) if len(a) else (np.zeros(0, np.int64),) * 2
            last = np.searchsorted(ends, np.cumsum(n_a), side="right")
            self.n_owned = np.r_[self.n_owned, np.diff(last, prepend=0)]
            self.owned_from = np.r_[self.owned_from, len(self.owned) + np.r_[0, last[:-1]]]
            self.owned = np.r_[self.owned, codes]
            self.n_tokens = [np.r_[old, n] for old, n in zip(self.n_tokens, (n_a, n_b), strict=True)]
            self.whole = np.r_[self.whole, same]
            own, at = [self.groups[c] for c in codes.tolist()], [0, *last.tolist()]
            self.text += [";".join(own[p:q]) for p, q in zip(at[:-1], at[1:], strict=True)]

    def codes(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows of some texts one after the other: their numbers, and the token of the first side that each ends before.

        A window ends where tokens of both end and space-marked tokens of both follow, and with the texts: every text starts
        with a space. Ids of the second side are shifted, so that one string of bytes holds both tuples of ids.
        """
        ends_a, ends_b = np.cumsum(self.one.sizes[a]), np.cumsum(self.two.sizes[b])
        at = np.searchsorted(ends_b, ends_a)
        inner = np.flatnonzero(ends_b[at[:-1]] == ends_a[:-1])
        inner = inner[self.one.spaced[a[inner + 1]] & self.two.spaced[b[at[inner] + 1]]]
        cut_a, cut_b = np.r_[0, inner + 1, len(a)], np.r_[0, at[inner] + 1, len(b)]
        ids_a, ids_b = a.astype("<u4").tobytes(), (b + (1 << 24)).astype("<u4").tobytes()
        to_a, to_b = (4 * cut_a).tolist(), (4 * cut_b).tolist()
        keys = [
            ids_a[p:q] + ids_b[r:t] for p, q, r, t in zip(to_a[:-1], to_a[1:], to_b[:-1], to_b[1:], strict=True)
        ]
        before = len(self.known)
        codes = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        new, where = np.unique(codes, return_index=True)
        where = where[new >= before]
        if len(where):
            size_a, size_b = np.diff(cut_a)[where], np.diff(cut_b)[where]
            self._align(a[_ranges(cut_a[where], size_a)], b[_ranges(cut_b[where], size_b)], size_a, size_b)
        return codes, cut_a[1:]

    def _align(self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> None:
        """Aligns new windows, given one after the other. Between two neighbouring ends, of either side, lies one link."""
        ends_a, ends_b = np.cumsum(self.one.sizes[a]), np.cumsum(self.two.sizes[b])
        ends = np.union1d(ends_a, ends_b)
        pairs, number = np.unique(
            (a[np.searchsorted(ends_a, ends)] << 24) | b[np.searchsorted(ends_b, ends)], return_inverse=True
        )
        numbered = np.fromiter(map(self.number.__getitem__, pairs.tolist()), np.int64, len(pairs))
        last_a, last_b = np.cumsum(size_a), np.cumsum(size_b)
        n_links = np.diff(np.searchsorted(ends, ends_a[last_a - 1]) + 1, prepend=0)
        at = np.searchsorted(ends_b, ends_a)
        shared = np.flatnonzero(ends_b[at] == ends_a)
        n_groups = np.diff(np.searchsorted(shared, last_a - 1) + 1, prepend=0)
        self.start = np.r_[self.start, len(self.links) + np.cumsum(n_links) - n_links]
        self.links = np.r_[self.links, numbered[number]]
        self.n_links, self.n_groups = np.r_[self.n_links, n_links], np.r_[self.n_groups, n_groups]
        # the ids in the order in which they are written, each as a place in the table of names
        to_a, to_b = np.r_[0, shared + 1], np.r_[0, at[shared] + 1]
        size_a, size_b = np.diff(to_a), np.diff(to_b)
        mixed = np.empty(len(a) + len(b), np.int64)
        place_a = np.arange(len(a)) + np.repeat(to_b[:-1], size_a)
        place_b = np.arange(len(b)) + np.repeat(to_a[1:], size_b)
        mixed[place_a], mixed[place_b] = 2 * a, 2 * (b + len(self.one.pieces))
        mixed[place_a[shared]] += 1
        mixed[place_b[at[shared]]] += 1
        names = [self.names[n] for n in mixed.tolist()]
        ends_at = [0, *(last_a + last_b).tolist()]
        self.groups += ["".join(names[p:q])[:-1] for p, q in zip(ends_at[:-1], ends_at[1:], strict=True)]

    def documents(self, texts: list[str]) -> Iterator[tuple]:
        """For each text: n_a, n_b, n_groups, n_links, the digest of its groups, its pairs and how often it has each."""
        before = len(self.part)
        numbers = []
        for text in texts:
            own = self.tokeniser.parts(text)
            numbers.append(np.fromiter(map(self.part.__getitem__, own), np.int64, len(own)))
        self.learn(list(islice(self.part, before, None)))
        for own in numbers:
            if not len(own) or not self.whole[own].all():
                yield 0, 0, 0, 0, "", b"", b""
                continue
            windows = self.owned[_ranges(self.owned_from[own], self.n_owned[own])]
            links = self.links[_ranges(self.start[windows], self.n_links[windows])]
            pairs, times = np.unique(links, return_counts=True)
            digest = hashlib.sha256(";".join([self.text[n] for n in own.tolist()]).encode()).hexdigest()
            yield (
                *(int(n[own].sum()) for n in self.n_tokens), int(self.n_groups[windows].sum()), len(links), digest,
                np.diff(pairs, prepend=0).astype("<u4").tobytes(), times.astype("<u4").tobytes(),
            )


_DOCUMENT = "doc_id long,n_a long,n_b long,n_groups long,n_links long,groups_sha256 string,pairs binary,times binary"
_ALIGNED = f"block long,{_DOCUMENT},a array<int>,b array<int>,n array<long>"


def _chunks(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about `most` bytes of text."""
    first = size = 0
    for row, length in enumerate(pc.binary_length(batch.column("bytes")).to_pylist()):
        size += length
        if size >= most or row == batch.num_rows - 1:
            yield batch.slice(first, row + 1 - first)
            first, size = row + 1, 0


def _aligned(docs: DataFrame, byte_level: str, pieces: str, most: int) -> DataFrame:
    """One row per document, and one per block with its pairs and how often they are linked there (n_a is null)."""
    schema = arrow_schema(_ALIGNED)
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = _loaded(byte_level, pieces)
        number = TaskContext.get().partitionId() << 32
        for batch in gathered(batches, most):
            windows, total = Windows(*loaded), np.zeros(0, np.int64)
            for some in _chunks(batch, 1 << 20):
                rows = []
                texts = [text.as_py().decode() for text in some.column("bytes")]
                for doc_id, found in zip(some.column("doc_id").to_pylist(), windows.documents(texts), strict=True):
                    rows.append([number, doc_id, *found, None, None, None])
                    total = np.pad(total, (0, len(windows.number) - len(total)))
                    total[np.cumsum(np.frombuffer(found[-2], "<u4"))] += np.frombuffer(found[-1], "<u4")
                yield batch_of(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)), schema)
            pairs = np.fromiter(windows.number, np.int64, len(windows.number))
            seen = [number, *[None] * 8, (pairs >> 24).tolist(), (pairs & 0xFFFFFF).tolist(), total.tolist()]
            yield batch_of({name: [value] for name, value in zip(names, seen, strict=True)}, schema)
            number += 1
            del windows
            give_back()

    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("bytes"))
    return texts.mapInArrow(run, _ALIGNED)


def align_corpus(docs: DataFrame, byte_level: str, pieces: str, block_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of `docs` (doc_id, text).

    `byte_level` and `pieces` are the files of the two tokenizers, which every executor has. A token of each is linked if
    their bytes overlap; a group lies between two bytes where tokens of both end. A pair's count is the number of its links
    in all texts; count_sum adds it up over the links, n_best counts links whose pair has the highest count of all pairs
    with that second id, ties included.

    A null or empty text, or one that either tokenizer does not give back byte by byte, has no tokens: all numbers are 0 and
    groups_sha256 is empty. Repeated rows stay and count as often as they come. Other columns are ignored; an empty table
    gives no rows. Texts are tokenised once and the result is written, so a lost executor costs a task.
    """
    aligned = saved(_aligned(docs, byte_level, pieces, block_bytes), "aligned")
    blocks = aligned.where("n_a is null and n is not null")
    seen = blocks.select(F.col("block").alias("asker"), F.posexplode(F.arrays_zip("a", "b", "n")).alias("pair", "p"))
    seen = seen.select("asker", "pair", "p.a", "p.b", "p.n")
    counts = seen.groupBy("a", "b").agg(F.sum("n").alias("count"))
    best = F.col("count") == F.max("count").over(Window.partitionBy("b"))
    counts = saved(counts.withColumn("best", best), "counts")
    asked = seen.join(counts, ["a", "b"]).select("asker", "pair", "count", "best")

    schema = arrow_schema("doc_id long,n_a long,n_b long,n_groups long,n_links long,n_best long,count_sum long,groups_sha256 string")
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def add(documents: pa.Table, pairs: pa.Table) -> pa.Table:
        size = pairs.num_rows
        count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        number = pairs.column("pair").to_numpy()
        count[number] = pairs.column("count").to_numpy()
        best[number] = pairs.column("best").to_numpy()
        sums, bests = [], []
        for own, times in zip(documents.column("pairs"), documents.column("times"), strict=True):
            numbers = np.cumsum(np.frombuffer(own.as_py(), "<u4").astype(np.int64))
            often = np.frombuffer(times.as_py(), "<u4").astype(np.int64)
            sums.append(int(count[numbers] @ often))
            bests.append(int(best[numbers] @ often))
        columns = {name: documents.column(name).combine_chunks() for name in kept}
        return pa.Table.from_batches([batch_of(columns | {"n_best": bests, "count_sum": sums}, schema)])

    documents = aligned.where("n_a is not null").select("block", *kept, "pairs", "times")
    return documents.groupBy("block").cogroup(asked.groupBy("asker")).applyInArrow(
        add, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )
