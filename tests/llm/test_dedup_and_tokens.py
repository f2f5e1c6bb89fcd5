"""SimHash groups, repeated passages, source mix and word-wise BPE, against plain versions."""

import hashlib
import itertools
import random

import edges
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import bpe, mixing, simhash, suffix_dedup
from tidemark.llm.queries import ORACLE_SQL, QUERIES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.001"

# --- SimHash ---


def plain_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """{doc: smallest id reachable} of (doc, fingerprint) pairs with distinct docs."""
    parent = {d: d for d, _ in prints}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for (a, x), (b, y) in itertools.combinations(prints, 2):
        if (x ^ y).bit_count() <= radius:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {d: root(d) for d in parent}


def test_simhash_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in docs]
    want = plain_components(prints, 2)
    got = QUERIES["op8_simhash_bit_sliced"](spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(d, f"{x:016x}", want[d]) for d, x in prints}


def test_spark_hashes_shingles_alike(spark):
    texts = ["a b c", "é 漢 字", "x"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h"))
    for r in frame.collect():
        assert simhash.shingle_hashes(r.t.encode(), 3).view(np.int64).tolist() == [r.h]


def test_bit_sliced_distances_against_plain_ones():
    rng = np.random.default_rng(3)
    for width, radius, n in ((8, 2, 300), (8, 0, 70), (32, 42, 200), (128, 168, 150), (8, 7, 130), (8, 64, 40)):
        centers = rng.integers(0, 256, (4, width), np.uint8)
        rows = centers[rng.integers(0, 4, n)]
        flips = rng.random((n, 8 * width)) < rng.choice([0.0, 0.01, 0.1], n)[:, None]
        rows = rows ^ np.packbits(flips, axis=1)
        first, last = np.arange(n) + 1, np.full(n, n)
        bits = np.unpackbits(rows, axis=1).astype(int)
        want = {(i, j) for i in range(n) for j in range(i + 1, n) if np.abs(bits[i] - bits[j]).sum() <= radius}
        pairs = list(simhash.linked_rows(rows, first, last, radius, batch=97))
        got = [(int(a), int(b)) for x, y in pairs for a, b in zip(x, y)]
        assert set(got) == want and len(got) == len(want)


@pytest.mark.parametrize("chunk", [4096, 8])
def test_links_keep_every_connection_when_a_key_is_hot(spark, chunk):
    rng = random.Random(6)
    base = rng.getrandbits(64)
    prints = {base}
    while len(prints) < 60:
        prints.add(rng.choice(sorted(prints)) ^ (1 << rng.randrange(40)) ^ (1 << rng.randrange(40)))
    prints |= {rng.getrandbits(64) for _ in range(60)}
    ids = dict(enumerate(sorted(prints)))
    nodes = spark.createDataFrame([(x.to_bytes(8, "big"),) for x in ids.values()], "fp binary")
    keyed = simhash.block_keys(nodes, 2, 6).union(nodes.select(F.lit(5).cast("long"), "fp"))
    roots = {bytes(r.node): bytes(r.root) for r in simhash.components(simhash.links(keyed, 2, chunk=chunk, held_rows=50)).collect()}
    want = plain_components(list(ids.items()), 2)
    for i, x in ids.items():
        key = x.to_bytes(8, "big")
        assert roots.get(key, key) == ids[want[i]].to_bytes(8, "big")


def test_long_chains_are_one_component(spark):
    rng = random.Random(1)
    names = [i.to_bytes(2, "big") for i in range(300)]
    order = rng.sample(names, len(names))
    edges_ = list(zip(order, order[1:])) + [(b"\xff\xfe", b"\xff\xff"), (b"\xff\xff", b"\xff\xff")]
    got = simhash.components(spark.createDataFrame(edges_, "a binary, b binary")).collect()
    assert {bytes(r.node): bytes(r.root) for r in got} == {n: names[0] for n in names[1:]} | {b"\xff\xff": b"\xff\xfe"}


def test_simhash_of_odd_documents(spark):
    got = simhash.near_duplicates(edges.docs(spark)).collect()
    assert len(got) == len(edges.ROWS)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    # null, empty and blank texts share the zero fingerprint; equal texts are one group
    assert {(bytes(r.fp), r.component_id) for i in (1, 2, 3) for r in by_id[i]} == {(bytes(8), 1)}
    assert by_id[8][0].component_id == by_id[4][0].component_id == 4
    assert by_id[6][0].component_id == 5 and [r.component_id for r in by_id[None]] == [None, None]
    assert simhash.near_duplicates(edges.none(spark)).count() == 0
    kept = simhash.one_of_each(edges.docs(spark), shingle=5, words=16, radius=176, min_keys=8)
    assert kept.columns == edges.docs(spark).columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        (i or 0, t or "")
        for i, t in {(r[0], r[1]) for r in edges.ROWS if r[0] in (1, 4, 7, 9, 10, 5, None)}
    )
    assert simhash.one_of_each(edges.none(spark), shingle=5, words=16, radius=176, min_keys=8).count() == 0


def test_near_copies_of_five_words(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(4000)]
    rows, groups = [], []
    for g in range(40):
        text = [rng.choice(words) for _ in range(300)]
        for c in range(3):
            copy = list(text)
            for _ in range(c * 2):
                copy[rng.randrange(300)] = rng.choice(words)
            rows.append((g * 3 + c, " ".join(copy)))
        groups.append(g * 3)
    rows += [(1000 + i, " ".join(rng.choice(words) for _ in range(200))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.one_of_each(docs, shingle=5, words=16, radius=176, min_keys=8).collect()}
    assert kept == set(groups) | set(range(1000, 1060))


def sets_of(texts):
    return {d: set(zip(*(t.split()[i:] for i in range(5)))) for d, t in texts.items()}


def test_repeated_lines_neither_hide_nor_make_near_copies(spark):
    rng = random.Random(14)
    words = [f"w{i}" for i in range(4000)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = {}
    for g in range(12):
        line, body = some(14), some(300)
        texts |= {10 * g: f"{body} {line}", 10 * g + 1: f"{body} {' '.join([line] * 12)}"}
        texts |= {10 * g + i: f"{some(300)} {' '.join([line] * 12)}" for i in range(2, 8)}
        tail = body.split()
        texts[10 * g + 8] = " ".join(tail[:264] + some(36).split())
        texts[10 * g + 9] = " ".join(tail[:230] + some(70).split())
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    stage = corpus_pipeline.near_duplicates(spark, docs, SF)
    kept, sets = {r.doc_id for r in stage.collect()}, sets_of(texts)
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    for a, b in itertools.combinations(sorted(kept), 2):
        assert not near(a, b)
    for gone in set(texts) - kept:
        assert any(near(gone, d) for d in texts if d != gone)
    assert len(kept) < len(texts)


def test_exact_links_in_chunks_against_all_pairs(spark):
    rng = random.Random(15)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for d in range(60):
        text = list(base)
        for _ in range(rng.randrange(8)):
            text[rng.randrange(120)] = f"v{rng.randrange(10**6)}"
        texts[d] = " ".join(text)
    sets = sets_of(texts)
    parent = {d: d for d in texts}
    for a, b in itertools.combinations(texts, 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and parent[a] != parent[b]:
            old, new = max(parent[a], parent[b]), min(parent[a], parent[b])
            parent = {d: new if p == old else p for d, p in parent.items()}
    docs = spark.createDataFrame(list(texts.items()) * 2, "doc_id long, text string")
    marks = simhash.fingerprints(docs, 5, 16, 8, distinct=True)
    rank = F.struct(F.lit(False).alias("late"), "doc_id", "text_hash")
    members = marks.groupBy("node").agg(F.first("n").alias("n"), F.min(rank).alias("first"), F.lit(1).cast("long").alias("group"))
    ids = {bytes(r.node): r.first.doc_id for r in members.select("node", "first").collect()}
    for chunk in (1 << 20, 700):
        found = simhash.components(simhash.exact_links(docs, members, 5, 0.8, chunk=chunk, held_bytes=1 << 12)).collect()
        got = {}
        for r in found:
            got.setdefault(bytes(r.root), {ids[bytes(r.root)]}).add(ids[bytes(r.node)])
        want = {p: {ids_ for ids_ in set(ids.values()) if parent[ids_] == p} for p in parent.values()}
        assert {frozenset(g) for g in got.values()} == {frozenset(g) for g in want.values() if len(g) > 1}


# --- repeated passages ---


def plain_cut(docs, length=50):
    first = {}
    for d, t in docs:
        for i in range(len(t) - length + 1):
            w = t[i : i + length]
            first[w] = min(first.get(w, 1 << 63), d)
    out = []
    for d, t in docs:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), sum(gone), runs, kept))
    return sorted(out)


def test_suffix_order_against_sorting():
    rng = random.Random(1)
    for turn in range(80):
        n, letters = rng.randrange(1, 400), rng.choice([2, 3, 26])
        text = bytes(rng.randrange(97, 97 + letters) for _ in range(n))
        text = b"a" * n if turn % 5 == 0 else text[:20] * 8 if turn % 7 == 0 else bytes([0, 255]) + text if turn % 11 == 0 else text
        data = np.frombuffer(text, np.uint8)
        order = suffix_dedup.suffix_order(data, 50)
        assert sorted(order.tolist()) == list(range(len(text)))
        starts = [text[i : i + 50] for i in order]
        assert starts == sorted(starts)
        shared = suffix_dedup.common_prefixes(data, order, 50)
        for a, b, n_shared in zip(starts, starts[1:], shared[1:].tolist()):
            assert n_shared == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("bin_bytes,part_bytes", [(2 << 20, 4 << 20), (500, 900)])
def test_repeated_passages_against_plain_version(spark, bin_bytes, part_bytes):
    rng = random.Random(2)
    passages = [bytes(rng.randrange(97, 100) for _ in range(rng.choice([49, 50, 51, 80, 300]))) for _ in range(12)]
    docs = []
    for d in range(150):
        text = b""
        for _ in range(rng.randrange(6)):
            text += rng.choice([
                rng.choice(passages), bytes(rng.randrange(97, 110) for _ in range(rng.randrange(70))),
                b"z" * rng.randrange(120), "é漢".encode() * rng.randrange(5),
            ])
        docs.append((d if d % 13 else 13, text))  # many documents share the id 13
    frame = spark.createDataFrame([(d, t.decode(), "x") for d, t in docs], "doc_id long, text string, n_bytes string")
    got = suffix_dedup.without_repeats(frame.repartition(5), bin_bytes=bin_bytes, part_bytes=part_bytes).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == plain_cut(docs)


def test_long_texts_are_cut_in_overlapping_pieces():
    texts = [b"x" * 10, bytes(range(256)) * 8, b"", b"y" * 60]
    rows = [(r, o, t) for group, rows, offsets in suffix_dedup._pieces(pa_binary(texts), 50, 300) for t, r, o in zip(group, rows, offsets)]
    for row, text in enumerate(texts):
        starts = sorted(o + i for r, o, t in rows if r == row for i in range(len(t) - 49))
        assert starts == list(range(max(len(text) - 49, 0)))


def pa_binary(values):
    import pyarrow

    return pyarrow.array(values, pyarrow.binary())


def test_repeats_of_odd_documents(spark):
    got = suffix_dedup.without_repeats(edges.docs(spark), as_text=True).collect()
    assert len(got) == len(edges.ROWS)
    by_id = {r.doc_id: r for r in got}
    # the long text repeats itself, which counts for nothing, and comes again under a larger id, where it goes
    assert by_id[4].n_removed == 0 and by_id[4].kept == edges.LONG
    assert (by_id[8].n_removed, by_id[8].n_spans, by_id[8].kept) == (len(edges.LONG), 1, "")
    assert by_id[1].n_bytes == 0 and by_id[7].kept == [r[1] for r in edges.ROWS if r[0] == 7][0]
    assert {r.score for r in got} == {9.0}
    assert suffix_dedup.without_repeats(edges.none(spark)).count() == 0


def test_suffix_query_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = plain_cut([(r.doc_id, (r.text or "").encode()) for r in docs])
    got = QUERIES["op2_suffix_repeats"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == [
        (*row[:4], hashlib.sha256(row[4]).hexdigest()) for row in want
    ]


# --- mixing ---


def plain_mix(rows, weights=(5, 2, 1), share=1.5, most=2.0):
    sizes, docs = {}, []
    for doc_id, text, source in rows:
        size = len((text or "").encode().split())
        sizes[source] = sizes.get(source, 0) + size
        docs.append((doc_id, size, source, int(hashlib.md5(str("" if doc_id is None else doc_id).encode()).hexdigest()[:15], 16)))
    ordered = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(ordered)}
    target, free, left = {}, set(ordered), share * sum(sizes.values())
    while free:  # reshare the excess until none is above its cap
        level = left / sum(weight[s] for s in free)
        capped = {s for s in free if level * weight[s] > most * sizes[s]}
        if not capped:
            target |= {s: level * weight[s] for s in free}
            break
        for s in capped:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= capped
    out = []
    for source in ordered:
        copies = int(target[source] // sizes[source]) if sizes[source] else 0
        budget, upto, extra = target[source] - copies * sizes[source], 0, set()
        own = [d for d in docs if d[2] == source]
        for h in sorted({d[3] for d in own}):
            upto += sum(d[1] for d in own if d[3] == h)
            if upto > budget:
                break
            extra.add(h)
        out += [(d[0], d[1], sizes[source], target[source], d[1] * (copies + (d[3] in extra))) for d in own]
    return out


def test_mix_against_plain_version(spark):
    rng = random.Random(3)
    for turn in range(3):
        rows = [
            (rng.choice([None, *range(40)]), " ".join(["w"] * rng.choice([0, 1, 5, 200])), rng.choice([None, "", "b", "a", "é", "A"][: 6 - turn]))
            for _ in range(120)
        ]
        frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
        got = [(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mixing.mix(frame).collect()]
        key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
        want = sorted(plain_mix(rows), key=key)
        for a, b in zip(sorted(got, key=key), want, strict=True):
            assert a == pytest.approx(b)


def test_mix_of_odd_documents(spark):
    got = mixing.mix(edges.docs(spark)).collect()
    assert len(got) == len(edges.ROWS) and all(r.taken <= 2 * r.size for r in got)
    assert mixing.mix(edges.none(spark)).count() == 0 and mixing.repeated_docs(edges.none(spark)).count() == 0
    again = mixing.repeated_docs(edges.docs(spark))
    assert again.columns == edges.docs(spark).columns
    taken = sum(r.taken for r in got)
    assert again.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == taken
    empty = edges.docs(spark).withColumn("text", F.lit(None).cast("string"))
    assert {(r.target, r.taken) for r in mixing.mix(empty).collect()} == {(0.0, 0)}


def test_empty_documents_come_no_oftener_than_others(spark):
    """The small source is capped at twice its size, which leaves no budget; its empty documents come twice at most."""
    rows = [(n, "" if n % 2 else "one two", "a") for n in range(400)] + [(900 + n, "w " * 5000, "b") for n in range(4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = [r.copies for r in mixing.mix(frame).collect()]
    assert max(copies) == 2
    times = mixing.repeated_docs(frame).groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert times == 2


def test_mix_query_against_sql_and_without_python(spark, oracle, physical):
    frame = QUERIES["op6_source_mix"](spark, "/root/testdata/sf0.01")
    assert not any(word in physical(frame) for word in ("Python", "Arrow", "Pandas", "CartesianProduct"))
    got = sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in frame.collect())
    want = oracle.execute(ORACLE_SQL["op6_source_mix"]).fetchall()
    assert got == sorted(want)
    assert sum(r[4] for r in got) == pytest.approx(1.5 * sum(r[1] for r in got), rel=0.03)


# --- BPE ---

CHARS = [
    *"abzAZ019 '' !?.\n\t\r\x0b\x0c\x1c\x1f\x85\xa0\xb2\xbd\xaa\xb5\xd7\xf7\xe9\xdf\xfc\xff", "Ā", "漢", "字",
    "Ⅷ", "​", "　", " ", "́", "\U0001f600", "١", "'s", "'ll", "'re", " ", "  ",
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_words_are_the_ones_of_the_pattern(library):
    rng = random.Random(3)
    for turn in range(8000):
        chars = CHARS if turn % 2 else [c for c in CHARS if ord(c[0]) < 256]
        text = "".join(rng.choice(chars) for _ in range(rng.randrange(14)))
        ids = [i for w in bpe.pre_tokens(text) for i in library._encode_single_piece(w)]
        assert "".join(bpe.pre_tokens(text)) == text and ids == library.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("block_bytes", [6 << 20, 300])
def test_ids_and_round_trip(spark, library, block_bytes):
    rng = random.Random(7)
    rows = [(i % 40 if i % 9 else None, None if i % 17 == 0 else "".join(rng.choice(CHARS) for _ in range(rng.randrange(200)))) for i in range(300)]
    rows += [(7, "a" * 200_000), (8, "")]
    path_rows = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    frame = path_rows.select("doc_id", "text", F.col("text").alias("original"))
    encoded = bpe.encode(frame, RANKS, block_bytes=block_bytes, bucket_bytes=2000).withColumn("again", F.col("ids"))
    got = bpe.decode(encoded, RANKS, ids="again").collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode_ordinary(r.original or "")
        assert r.n_tokens == len(want) and np.frombuffer(r.ids, "<u4").tolist() == want
        assert bytes(r.decoded) == (r.original or "").encode()


def test_bpe_of_odd_documents(spark, library):
    got = bpe.encode(edges.docs(spark), RANKS).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(library.encode_ordinary(r[1] or "")) for r in edges.ROWS)
    assert {r.kept for r in got} == {"mine"}
    assert bpe.decode(bpe.encode(edges.none(spark), RANKS), RANKS).count() == 0


def test_changed_blocks_are_an_error(spark):
    import pyspark.errors

    def odd_rows(batches):
        import uuid

        import pyarrow

        for batch in batches:
            yield pyarrow.RecordBatch.from_arrays(
                [batch.column(0), pyarrow.array([uuid.uuid4().hex for _ in range(batch.num_rows)])], names=["id", "text"]
            )

    made = spark.range(300).mapInArrow(odd_rows, "id long, text string")
    with pytest.raises(pyspark.errors.PythonException, match="changed between"):
        bpe.encode(made, RANKS).collect()


def test_bpe_query_against_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op7_word_bpe"](spark, SF).collect():
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
