"""Repeated passages by suffix arrays, built bin by bin with two-stage sorting.

A byte is removed if a string of `length` bytes that covers it also starts in a document with a smaller id. To compare all
strings of the corpus without one suffix array of it all, strings are dealt to bins by content: the minimizer of a string
is the smallest hash among its 16-byte grams, so equal strings have equal minimizers and meet in one bin. Neighbouring
strings mostly share their minimizer, so a document is cut into segments of strings with the same one, and a bin gets
whole segments, packed and compressed by task.

In a bin, minimizers of one document only are left out, equal segments are merged, and a suffix array of the rest is built:
suffixes that are smaller than their successors are sorted directly, by eight bytes at a time and beyond `length`; the
others are induced by scanning the buckets in order. Common prefixes of neighbours then tell which strings are equal, and
each equal group which document comes first. All bins together see every string once; nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_schema, batch_of, gathered, give_back, small_batches, utf8

U64 = np.uint64
GRAM = 16
LAST_ID = (1 << 63) - 1
_TABLE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64)
_STEPS = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(32))) * U64(0xFF51AFD7ED558CCD)
    return h ^ (h >> U64(29))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """The hash of the 16 bytes at each place of `data`."""
    h = _TABLE[data]
    for level, step in enumerate(_STEPS):
        h = h[: -(1 << level)] * step + h[1 << level :]
    return _finish(h)


def row_hashes(grams: np.ndarray) -> np.ndarray:
    """The same hash for rows of 16 bytes."""
    h = _TABLE[grams]
    for step in _STEPS:
        h = h[:, 0::2] * step + h[:, 1::2]
    return _finish(h[:, 0])


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        h = np.minimum(h[:-done], h[done:])
        done *= 2
    return np.minimum(h[: len(h) - (width - done)], h[width - done :]) if done < width else h


def segments(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(start, strings, offset, minimizer) of the segments of concatenated texts that end at `ends`.

    `strings` counts the strings that start in the segment; `offset` is where its first minimizer stands in it.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(U64)
    hashes = gram_hashes(data)
    width = length - GRAM + 1
    low = _sliding_min(hashes, width)
    valid = np.ones(len(low), bool)
    starts = np.r_[0, ends[:-1]]
    breaks = np.zeros(len(low) + 1, bool)
    breaks[0] = True
    for a, b in zip(np.maximum(ends - length + 1, starts), ends, strict=True):
        valid[a : min(b, len(low))] = False
    breaks[1:-1] = (low[1:] != low[:-1]) | (valid[1:] != valid[:-1])
    breaks[starts[starts < len(low)]] = True
    first = np.flatnonzero(breaks[:-1])
    strings = np.diff(np.r_[first, len(low)])
    first, strings = first[valid[first]], strings[valid[first]]
    offset = np.empty(len(first), np.int64)
    for i in range(0, len(first), 8192):
        at = first[i : i + 8192]
        offset[i : i + 8192] = hashes[at[:, None] + np.arange(width)[None, :]].argmin(1)
    return first, strings, offset, low[first]


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start..start+size-1 of each row, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total + (int(starts.max()) if len(starts) else 0) < 1 << 31 else np.int64
    return np.arange(total, dtype=kind) + np.repeat((starts - (ends - sizes)).astype(kind), sizes)


def _zip(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=5).compress(data, asbytes=True)


def _unzip(blob: bytes) -> bytes:
    return pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)


_SEGMENT = ("<i8", "<i8", "<u4", "<u4", "<u1")
_SPAN = ("<i8", "<i8", "<u4", "<u4")


def _pack(columns: Sequence[np.ndarray], kinds: tuple[str, ...]) -> bytes:
    """Integer columns as compressed byte planes."""
    planes = [c.astype(k).view(np.uint8).reshape(len(c), -1).T for c, k in zip(columns, kinds, strict=True)]
    return _zip(b"".join(np.ascontiguousarray(p).tobytes() for p in planes))


def _unpack(blob: bytes, n: int, kinds: tuple[str, ...]) -> list[np.ndarray]:
    data, at, out = np.frombuffer(_unzip(blob), np.uint8), 0, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        plane = data[at : at + n * width].reshape(width, n)
        out.append(np.ascontiguousarray(plane.T).view(kind).reshape(-1))
        at += n * width
    return out


def _pieces(texts: pa.Array, length: int, most: int) -> Iterator[tuple[list[bytes], list[int], list[int]]]:
    """Texts in groups of about `most` bytes, with their rows and offsets; a longer text goes in overlapping pieces."""
    group, rows, offsets, size = [], [], [], 0
    for row, value in enumerate(texts):
        text = value.as_py()
        for offset in range(0, max(len(text) - length + 1, 0), most):
            piece = text[offset : offset + most + length - 1]
            group.append(piece)
            rows.append(row)
            offsets.append(offset)
            size += len(piece)
            if size >= most:
                yield group, rows, offsets
                group, rows, offsets, size = [], [], [], 0
    if group:
        yield group, rows, offsets


def binned_segments(
    docs: DataFrame, bins: int, length: int, piece_bytes: int = 1 << 19, pack_bytes: int = 6 << 20
) -> DataFrame:
    """(bin, n, meta, data): the segments of `docs` (__id, __tag, __bytes), packed by bin for `pack_bytes` of text each."""
    out = arrow_schema("bin int,n int,meta binary,data binary")

    def packed(meta: list[list[tuple]], data: list[list[bytes]]) -> pa.RecordBatch:
        used = [i for i in range(bins) if meta[i]]
        columns = [tuple(map(np.concatenate, zip(*meta[i], strict=True))) for i in used]
        return batch_of(
            {
                "bin": used, "n": [len(c[0]) for c in columns], "meta": [_pack(c, _SEGMENT) for c in columns],
                "data": [_zip(b"".join(data[i])) for i in used],
            },
            out,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, meta, data = 0, [[] for _ in range(bins)], [[] for _ in range(bins)]
        for batch in batches:
            ids, tags = batch.column("__id").to_numpy(), batch.column("__tag").to_numpy()
            for texts, rows, offsets in _pieces(batch.column("__bytes"), length, piece_bytes):
                joined = np.frombuffer(b"".join(texts), np.uint8)
                ends = np.cumsum([len(t) for t in texts])
                first, strings, offset, low = segments(joined, ends, length)
                of = (low % U64(bins)).astype(np.int64)
                order = np.argsort(of, kind="stable")
                first, strings, offset, of = first[order], strings[order], offset[order], of[order]
                piece = np.searchsorted(ends, first, side="right")
                row = np.array(rows)[piece]
                start = (first - np.r_[0, ends[:-1]][piece] + np.array(offsets)[piece]).astype(np.uint32)
                sizes = strings + length - 1
                strings, offset = strings.astype(np.uint32), offset.astype(np.uint8)
                content = joined[_gather(first, sizes)].tobytes()
                bounds = np.r_[0, np.cumsum(sizes)]
                cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1], True]) if len(of) else np.zeros(1, np.int64)
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    meta[of[a]].append((ids[row[a:b]], tags[row[a:b]], start[a:b], strings[a:b], offset[a:b]))
                    data[of[a]].append(content[bounds[a] : bounds[b]])
                held += len(joined)
                if held >= pack_bytes:
                    yield packed(meta, data)
                    held, meta, data = 0, [[] for _ in range(bins)], [[] for _ in range(bins)]
                    give_back()
        yield packed(meta, data)
        give_back()

    return docs.select("__id", "__tag", "__bytes").mapInArrow(run, "bin int, n int, meta binary, data binary")


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a big-endian number; beyond the end are zeros."""
    padded = np.r_[text, np.zeros(8, np.uint8)].astype(U64)
    w = (padded[:-1] << U64(8)) | padded[1:]
    w = (w[:-2] << U64(16)) | w[2:]
    return ((w[:-4] << U64(32)) | w[4:])[: len(text)]


def _sort_direct(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes `at` in order of their first `depth` bytes: by eight bytes, then those that are still equal by the next."""
    n = len(words)
    group = np.zeros(len(at), np.int64)
    open_ = np.arange(len(at))
    out = at.copy()
    for skip in range(0, depth, 8):
        if not len(open_):
            break
        here = out[open_]
        key = np.where(here + skip < n, words[np.minimum(here + skip, n - 1)], U64(0))
        order = np.lexsort((key, group[open_])) if skip else np.argsort(key, kind="stable")
        key, grp = key[order], group[open_][order]
        out[open_] = here[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (grp[1:] != grp[:-1])]
        heads = open_[np.flatnonzero(new)]
        group[open_] = np.repeat(heads, np.diff(np.r_[np.flatnonzero(new), len(open_)]))
        tied = ~new | np.r_[~new[1:], False]
        open_ = open_[tied]
    return out


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of `text` (unsigned bytes) in order of at least their first `depth` bytes, by two-stage sorting.

    A suffix is of type B if it is smaller than its successor and of type A otherwise; the last one is of type A. Type B
    is sorted directly. A bucket holds the suffixes with one first byte, type A before type B. Scanned from the smallest
    on, each suffix puts its predecessor, if of type A, at the next free place of the predecessor's bucket.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # type B where the next different byte is larger
    change = np.flatnonzero(np.r_[text[1:] != text[:-1], True])
    run_end = np.repeat(change, np.diff(np.r_[-1, change]))
    smaller = np.zeros(n, bool)
    inner = run_end < n - 1
    smaller[inner] = text[run_end[inner]] < text[run_end[inner] + 1]
    direct = _sort_direct(np.flatnonzero(smaller), _words(text), depth)
    bounds = np.searchsorted(text[direct], np.arange(257))
    queues: list[list[np.ndarray]] = [[] for _ in range(256)]
    queues[int(text[-1])].append(np.array([n - 1]))
    out = []
    for c in range(256):
        scanned = []
        wave = np.concatenate(queues[c]) if queues[c] else np.zeros(0, np.int64)
        while len(wave):
            scanned.append(wave)
            before = wave[wave > 0] - 1
            wave = before[text[before] == c]
        scanned.append(direct[bounds[c] : bounds[c + 1]])
        bucket = np.concatenate(scanned)
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[text[before] > c]
        if len(before):
            of = text[before]
            order = np.argsort(of, kind="stable")
            before, of = before[order], of[order]
            cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1], True])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                queues[of[a]].append(before[a:b])
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Bytes that each suffix of `order` shares with the one before, counted up to `length`; the first shares none."""
    words, n = _words(text), len(text)
    shared = np.zeros(len(order), np.int64)
    open_ = np.arange(1, len(order))
    for skip in range(0, length, 8):
        a, b = order[open_ - 1] + skip, order[open_] + skip
        inside = np.maximum(a, b) < n
        open_, a, b = open_[inside], a[inside], b[inside]
        x = words[a] ^ words[b]
        equal = np.full(len(x), 8)
        for byte in range(8):
            equal = np.where((equal == 8) & ((x >> U64(56 - 8 * byte)) & U64(255) > 0), byte, equal)
        shared[open_] += equal
        open_ = open_[equal == 8]
    return np.minimum(shared, length)


def repeated_spans_of_bin(
    ids: np.ndarray, tags: np.ndarray, start: np.ndarray, strings: np.ndarray, offset: np.ndarray, data: bytes, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, size, id) of the byte runs of the segments that strings of smaller documents cover."""
    none = np.zeros(0, np.int64)
    sizes = strings.astype(np.int64) + length - 1
    ends = np.cumsum(sizes)
    begins = ends - sizes
    joined = np.frombuffer(data, np.uint8)
    low = row_hashes(joined[(begins + offset)[:, None] + np.arange(GRAM)[None, :]])
    # minimizers that more than one document has
    order = np.lexsort((ids, low))
    new = np.r_[True, low[order][1:] != low[order][:-1]]
    heads = np.flatnonzero(new)
    lasts = np.r_[heads[1:], len(order)] - 1
    shared = ids[order][heads] != ids[order][lasts]
    member = np.empty(len(order), bool)
    member[order] = np.repeat(shared, lasts - heads + 1)
    own = np.flatnonzero(member)
    if not len(own):
        return none, none, none, none
    # equal segments are one
    distinct: dict[bytes, int] = {}
    which = np.empty(len(own), np.int64)
    for i, (a, b) in enumerate(zip(begins[own].tolist(), ends[own].tolist(), strict=True)):
        which[i] = distinct.setdefault(data[a:b], len(distinct))
    least = np.full(len(distinct), LAST_ID)
    np.minimum.at(least, which, ids[own])
    kept_sizes = np.array([len(s) for s in distinct])
    text = np.frombuffer(b"".join(distinct), np.uint8)
    owner = np.repeat(np.arange(len(distinct)), kept_sizes)
    heads = np.cumsum(kept_sizes) - kept_sizes
    whole = np.arange(len(text)) - heads[owner] + length <= kept_sizes[owner]
    order = suffix_order(text, length)
    order = order[whole[order]]
    group = np.cumsum(common_prefixes(text, order, length) < length) - 1
    first_of = np.full(int(group[-1]) + 1, LAST_ID)
    np.minimum.at(first_of, group, least[owner[order]])
    first_id = np.full(len(text), LAST_ID)
    first_id[order] = first_of[group]
    # back to each document's own copy of the segment
    counts = strings[own].astype(np.int64)
    at = _gather(heads[which], counts)
    mine = np.repeat(np.arange(len(own)), counts)
    later = first_id[at] < ids[own][mine]
    edge = np.diff(np.r_[False, later, False].astype(np.int8))
    inner = np.r_[False, mine[1:] != mine[:-1]] & later & np.r_[False, later[:-1]]
    from_ = np.flatnonzero((edge[:-1] == 1) | inner)
    to = np.flatnonzero((edge[1:] == -1) | np.r_[inner[1:], False])
    segment = own[mine[from_]]
    place = np.cumsum(counts) - counts
    begin = start[segment].astype(np.int64) + from_ - place[mine[from_]]
    return segment, begin, to - from_ + length, ids[segment]


def _identified(docs: DataFrame, carried: list[str]) -> DataFrame:
    """(__id, __tag, __bytes, __row): null ids last, and a tag, a hash of the text, only for rows that share an id."""
    marked = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("__id"), F.lit(0).cast("long").alias("__tag"),
        utf8().alias("__bytes"), F.struct(*[F.col(f"`{c}`") for c in carried]).alias("__row"),
    )
    repeated = marked.groupBy("__id").agg(F.count("*").alias("n")).where("n > 1").select("__id")
    if repeated.isEmpty():
        return marked
    known = repeated.withColumn("__again", F.lit(True))
    tag = F.when(F.col("__again"), F.xxhash64("__bytes")).otherwise(F.col("__tag"))
    return marked.join(known, "__id", "left").select("__id", tag.alias("__tag"), "__bytes", "__row")


def _spans(marked: DataFrame, length: int, bins: int, parts: int) -> DataFrame:
    """(part, n, spans): removed runs of documents, not yet merged over segments, packed by bin and part."""
    out = arrow_schema("part long,n int,spans binary")

    def sort_bin(group: pa.Table) -> pa.Table:
        n = group.column("n").to_pylist()
        packs = [_unpack(m.as_py(), k, _SEGMENT) for m, k in zip(group.column("meta"), n, strict=True)]
        ids, tags, start, strings, offset = map(np.concatenate, zip(*packs, strict=True))
        data = b"".join(_unzip(d.as_py()) for d in group.column("data"))
        segment, begin, size, of = repeated_spans_of_bin(ids, tags, start, strings, offset, data, length)
        part = _part(of, tags[segment], parts)
        order = np.lexsort((begin, of, part))
        columns, part = [c[order] for c in (of, tags[segment], begin, size)], part[order]
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, np.int64)
        pieces = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        found = {
            "part": part[cuts[:-1]], "n": [b - a for a, b in pieces],
            "spans": [_pack([c[a:b] for c in columns], _SPAN) for a, b in pieces],
        }
        give_back()
        return pa.Table.from_batches([batch_of(found, out)])

    binned = binned_segments(marked, bins, length)
    return binned.groupBy("bin").applyInArrow(sort_bin, "part long, n int, spans binary")


def _part(ids: np.ndarray, tags: np.ndarray, parts: int) -> np.ndarray:
    """The part of the documents that a row belongs to, by a hash of what identifies it."""
    mixed = _finish(ids.view(U64) * _STEPS[0] + tags.view(U64) * _STEPS[1])
    return (mixed % U64(parts)).astype(np.int64)


def _packed_docs(marked: DataFrame, parts: int, pack_bytes: int = 8 << 20) -> DataFrame:
    """(part, ids, tags, sizes, texts, rows): documents packed by part and batch; together they compress better."""
    schema = T.StructType(
        [
            *T.StructType.fromDDL("part long, ids array<long>, tags array<long>, sizes array<long>, texts binary").fields,
            T.StructField("rows", T.ArrayType(marked.schema["__row"].dataType)),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, pack_bytes):
            ids, tags = batch.column("__id").to_numpy(), batch.column("__tag").to_numpy()
            of = _part(ids, tags, parts)
            order = np.argsort(of, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(of[order]) != 0, True])
            texts = batch.column("__bytes").take(pa.array(order))
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset))
            offsets = pa.array(cuts, pa.int32())
            blobs = [
                _zip(b"".join(texts.slice(a, b - a).to_pylist()))
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
            ]
            lists = [pa.ListArray.from_arrays(offsets, pa.array(c.astype(np.int64))) for c in (ids[order], tags[order], sizes)]
            rows = pa.ListArray.from_arrays(offsets, batch.column("__row").take(pa.array(order)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(of[order][cuts[:-1]], pa.int64()), *lists, pa.array(blobs, pa.binary()), rows], names=schema.names
            )
        give_back()

    return marked.mapInArrow(run, schema)


def cut(text: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[bytes, int, int]:
    """(remaining bytes, removed bytes, maximal removed runs) of a text without the given runs."""
    edges = np.zeros(len(text) + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + sizes, -1)
    gone = np.cumsum(edges[:-1]) > 0
    runs = int(np.count_nonzero(np.diff(np.r_[False, gone].astype(np.int8)) == 1))
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def without_repeats(
    docs: DataFrame, length: int = 50, bin_bytes: int = 2 << 20, part_bytes: int = 4 << 20, as_text: bool = False
) -> DataFrame:
    """`docs` (doc_id, text, any more) with kept, n_bytes, n_removed and n_spans in place of text.

    Removed is each byte of the UTF-8 text covered by a string of `length` bytes that also starts in a document with a
    smaller doc_id. Strings are judged on the input, so overlaps all count, and never cross documents. n_spans counts the
    maximal removed runs. `kept` is the remaining bytes; with `as_text` a string, without characters that lost a byte.
    `bin_bytes` is the text that a bin of suffixes stands for, `part_bytes` that of the documents that are cut together.

    A null text is empty; texts shorter than `length` lose nothing. A null doc_id comes after all others. Rows with the same
    id are no smaller than each other, so none of them loses what only they share. Columns of `docs` with the names of new
    ones are replaced. An empty table gives no rows.
    """
    added = T.StructType.fromDDL(f"kept {'string' if as_text else 'binary'}, n_bytes long, n_removed long, n_spans long")
    carried = [c for c in docs.columns if c != "text" and c not in added.names]
    marked = small_batches(_identified(docs, carried))
    total = marked.agg(F.sum(F.octet_length("__bytes"))).first()[0] or 0
    bins, parts = (max(1, -(-total // size)) for size in (bin_bytes, part_bytes))
    result = T.StructType([marked.schema["__row"], *added.fields])

    def finish(docs: pa.Table, spans: pa.Table) -> pa.Table:
        packs = [_unpack(x.as_py(), n, _SPAN) for x, n in zip(spans.column("spans"), spans.column("n").to_pylist(), strict=True)]
        none = [np.zeros(0, np.int64)] * 4
        own_id, tag, start, size = map(np.concatenate, zip(*packs, strict=True)) if packs else none
        order = np.lexsort((tag, own_id))
        own_id, tag, start, size = (c[order].astype(np.int64) for c in (own_id, tag, start, size))
        new = np.flatnonzero(np.r_[True, (np.diff(own_id) != 0) | (np.diff(tag) != 0)]) if len(order) else none[0]
        at = {key: i for i, key in enumerate(zip(own_id[new].tolist(), tag[new].tolist(), strict=True))}
        bounds = np.r_[new, len(order)]
        made: list[tuple] = []
        for ids, tags, sizes, texts in zip(*(docs.column(c) for c in ("ids", "tags", "sizes", "texts")), strict=True):
            data, begin = _unzip(texts.as_py()), 0
            for *key, n in zip(ids.as_py(), tags.as_py(), sizes.as_py(), strict=True):
                text = data[begin : begin + n]
                begin += n
                if (i := at.get(tuple(key))) is None:
                    made.append((text, n, 0, 0))
                else:
                    own = slice(bounds[i], bounds[i + 1])
                    kept, removed, runs = cut(text, start[own], size[own])
                    made.append((kept, n, removed, runs))
        kept, *counts = map(list, zip(*made, strict=True)) if made else ([], [], [], [])
        if as_text:
            kept = [k.decode("utf-8", "ignore") for k in kept]
        rows = docs.column("rows").combine_chunks().flatten()
        kinds = (pa.string() if as_text else pa.binary(), *[pa.int64()] * 3)
        columns = [pa.array(c, k) for c, k in zip((kept, *counts), kinds, strict=True)]
        return pa.table([rows, *columns], names=result.names)

    spans = _spans(marked, length, bins, parts)
    packed = _packed_docs(marked, parts)
    finished = packed.groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(finish, result)
    return finished.select("__row.*", *added.names)
