"""Byte-level BPE encoding and decoding: each distinct word of the corpus is encoded once.

Documents are split into pre-tokens. A block of documents keeps, per document, the positions of its words as local word
numbers, and sends its distinct words, dealt to buckets by a hash, to one place for each word. There equal words of all
blocks are one, and are merged once. The ids go back to the blocks that asked, are joined to the word numbers, and put in
order of position. Only distinct words of blocks, not single tokens, are shuffled.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import gathered, give_back, small_batches, utf8

# Letters, digits and other number signs, and white space of Latin-1. Texts beyond it take the general pattern.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"
_LATIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)
_GENERAL_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_GENERAL = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _GENERAL_SPACE[1:-1] + r"\p{L}\p{N}]+|"
    + _GENERAL_SPACE + r"+(?![^" + _GENERAL_SPACE[1:-1] + r"])|" + _GENERAL_SPACE + r"+"
)


def pre_tokens(text: str) -> list[str]:
    """The words that a text is merged in; joined, they are the text."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _GENERAL.findall(text)
    return _LATIN.findall(text)


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a token in base64 and its id on each line. It has one fixed size, whatever the corpus."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


_LOADED: dict[str, object] = {}


def _merger(path: str) -> tiktoken.Encoding:
    if path not in _LOADED:
        _LOADED[path] = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=read_ranks(path), special_tokens={})
    return _LOADED[path]


def _zip(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(data, asbytes=True)


def _unzip(blob: bytes) -> bytes:
    return pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers as byte planes, which compress well where most numbers are small."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _blocks(batch: pa.RecordBatch, most: int) -> Iterator[tuple[int, list[np.ndarray], list[bytes]]]:
    """Rows of a batch in blocks of about `most` bytes: the first row, each row's word numbers, and the distinct words.

    Words are numbered as they first appear. Only distinct words and numbers are held.
    """
    first, codes, size = 0, [], 0
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    for row, text in enumerate(batch.column("__bytes")):
        text = text.as_py()
        tokens = pre_tokens(text.decode("utf-8"))
        codes.append(np.fromiter(map(number.__getitem__, tokens), np.uint32, len(tokens)))
        size += len(text)
        if size >= most:
            yield first, codes, [w.encode() for w in number]
            first, codes, size = row + 1, [], 0
            number.clear()
    if codes:
        yield first, codes, [w.encode() for w in number]


def _coded(docs: DataFrame, most: int) -> DataFrame:
    """(block, check, codes, __row): each document as numbers into the distinct words of its block."""
    fields = T.StructType.fromDDL("block long, check long, codes binary").fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in gathered(batches, most):
            for first, codes, words in _blocks(batch, most):
                columns = [
                    pa.array([block] * len(codes), pa.int64()),
                    pa.array([zlib.crc32(b"\xff".join(words))] * len(codes), pa.int64()),
                    pa.array([_zip(_planes(c)) for c in codes], pa.binary()),
                    batch.column("__row").slice(first, len(codes)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*[f.name for f in fields], "__row"])
                block += 1
        give_back()

    return docs.mapInArrow(run, T.StructType([*fields, docs.schema["__row"]]))


def _asked(docs: DataFrame, most: int, buckets: int) -> DataFrame:
    """(bucket, block, check, numbers, lengths, words): the distinct words of each block that fall in each bucket."""
    names = ["bucket", "block", "check", "numbers", "lengths", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in gathered(batches, most):
            for _, _, words in _blocks(batch, most):
                if words:
                    of = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
                    order = np.argsort(of, kind="stable")
                    cuts = np.flatnonzero(np.r_[True, np.diff(of[order]) != 0, True])
                    parts = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    lists = [[words[i] for i in p] for p in parts]
                    columns = [
                        pa.array([int(of[p[0]]) for p in parts], pa.int64()),
                        pa.array([block] * len(parts), pa.int64()),
                        pa.array([zlib.crc32(b"\xff".join(words))] * len(parts), pa.int64()),
                        pa.array([_zip(_planes(np.diff(p, prepend=0))) for p in parts], pa.binary()),
                        pa.array([_zip(_planes(np.array(list(map(len, x))))) for x in lists], pa.binary()),
                        pa.array([_zip(b"".join(x)) for x in lists], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                block += 1
        give_back()

    schema = "bucket long, block long, check long, numbers binary, lengths binary, words binary"
    return docs.mapInArrow(run, schema)


def _answered(asked: DataFrame, path: str) -> DataFrame:
    """(block, check, numbers, counts, ids): the ids of each word, merged once for all blocks of its bucket."""

    def answer(group: pa.Table) -> pa.Table:
        merge = _merger(path)._encode_single_piece
        known: dict[bytes, tuple[int, bytes]] = {}
        counts, ids = [], []
        for lengths, words in zip(group.column("lengths"), group.column("words"), strict=True):
            data, found, at = _unzip(words.as_py()), [], 0
            for size in _numbers(_unzip(lengths.as_py())).tolist():
                word = data[at : at + size]
                at += size
                if (hit := known.get(word)) is None:
                    merged = merge(word)
                    hit = known[word] = (len(merged), np.array(merged, "<u4").tobytes())
                found.append(hit)
            counts.append(_zip(_planes(np.array([n for n, _ in found]))))
            ids.append(_zip(_planes(np.frombuffer(b"".join([i for _, i in found]), "<u4"))))
        return pa.table(
            [group.column("block"), group.column("check"), group.column("numbers"), pa.array(counts, pa.binary()), pa.array(ids, pa.binary())],
            names=["block", "check", "numbers", "counts", "ids"],
        )

    schema = "block long, check long, numbers binary, counts binary, ids binary"
    return asked.groupBy("bucket").applyInArrow(answer, schema)


def encode(
    docs: DataFrame, path: str, text: str = "text", block_bytes: int = 6 << 20, bucket_bytes: int = 8 << 20
) -> DataFrame:
    """`docs` with n_tokens and ids (little-endian unsigned 32-bit integers, as binary) in place of the column `text`.

    `path` is a rank file that every executor has. Each match of the word pattern is merged separately, without special
    tokens. A block is about `block_bytes` of text; the number of buckets follows the total text, so that a bucket stays
    the same size however large the corpus.

    A null or empty text has no tokens. Rows with equal ids and texts stay separate rows. Columns of `docs` with the names
    n_tokens and ids are replaced; an empty table gives no rows.

    The blocks are formed twice by the same plan, once for the words and once for the positions, so `docs` must give the
    same rows in the same order each time, as tables do. A checksum of each block's words tells if it did not; the job then
    fails.
    """
    added = T.StructType.fromDDL("n_tokens long, ids binary")
    carried = [F.col(f"`{c}`") for c in docs.columns if c not in (text, *added.names)]
    packed = small_batches(docs).select(utf8(F.col(f"`{text}`")).alias("__bytes"), F.struct(*carried).alias("__row"))
    total = packed.agg(F.sum(F.octet_length("__bytes"))).first()[0] or 0
    answers = _answered(_asked(packed, block_bytes, max(32, -(-total // bucket_bytes))), path)
    result = T.StructType([packed.schema["__row"], *added.fields])

    def place(coded: pa.Table, words: pa.Table) -> pa.Table:
        checks = {*coded.column("check").to_pylist(), *words.column("check").to_pylist()}
        if len(checks) > 1 and coded.num_rows:
            raise RuntimeError("the documents changed between the two readings of a block")
        parts = []
        for numbers, counts, ids in zip(*(words.column(c) for c in ("numbers", "counts", "ids")), strict=True):
            parts.append([_numbers(_unzip(x.as_py())) for x in (numbers, counts, ids)])
        number = np.concatenate([np.cumsum(p[0]) for p in parts] or [np.zeros(0, np.int64)]).astype(np.int64)
        count = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)]).astype(np.int64)
        flat = np.concatenate([p[2] for p in parts] or [np.zeros(0, "<u4")])
        size, start = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        size[number], start[number] = count, np.cumsum(count) - count
        n_tokens, encoded = [], []
        for codes in coded.column("codes"):
            code = _numbers(_unzip(codes.as_py()))
            sizes = size[code]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            at = np.arange(total) + np.repeat(start[code] - (ends - sizes), sizes)
            n_tokens.append(total)
            encoded.append(flat[at].tobytes())
        return pa.table(
            [coded.column("__row"), pa.array(n_tokens, pa.int64()), pa.array(encoded, pa.binary())],
            names=["__row", *added.names],
        )

    coded = _coded(packed, block_bytes).select("block", "check", "codes", "__row")
    placed = coded.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(place, result)
    return placed.select("__row.*", *added.names)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`encoded` with `out` in place of the ids, the bytes that they stand for.

    Each id is joined to its bytes in the token table of the rank file, which every task reads; it has one fixed size.

    Null or empty ids give no bytes; an id that the table does not have is an error.
    """
    carried = [F.col(f"`{c}`") for c in encoded.columns if c not in (ids, out)]
    packed = small_batches(encoded).select(F.col(f"`{ids}`").alias("__ids"), F.struct(*carried).alias("__row"))
    result = T.StructType([packed.schema["__row"], T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: token for token, rank in read_ranks(path).items()}.__getitem__
        for batch in batches:
            texts = [
                b"".join(map(token, np.frombuffer(x.as_py() or b"", "<u4").tolist())) for x in batch.column("__ids")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__row"), pa.array(texts, pa.binary())], names=["__row", out]
            )

    return packed.mapInArrow(run, result).select("__row.*", out)
