"""Spelling variants, benchmark decontamination and tokenizer alignment against plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import edges
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from tidemark.llm import alignment, decontamination, queries, spelling
from tidemark.llm.common import table

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts_of(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


# spelling variants


def plain_variants(docs, every=97, shortest=5, least=3):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= shortest and c >= least}
    by_key = defaultdict(set)
    for w in words:
        by_key[w].add(w)
        for i in range(len(w)):
            by_key[w[:i] + w[i + 1 :]].add(w)
            by_key[w[:i] + "?" + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for key, group in by_key.items():
        for a in group:
            for b in group:
                one_less = len(a) != len(b) and key in (a, b)
                if a != b and (one_less or "?" in key):
                    near[a].add(b)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), c, len(near[w]), words.get(form.get(w))) for w, c in words.items()}


def got_variants(frame):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_variants_of_the_sample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    want = plain_variants(texts_of(docs))
    assert got_variants(queries.op11_spelling_variants(spark, sf_dir)) == want
    assert any(r[1] for r in want) and any(r[1] and r[1] != r[2] for r in plain_variants(texts_of(docs), 3, 2, 1))


@pytest.mark.parametrize("least", [1, 2])
def test_variants_of_odd_tables(spark, least):
    docs = edges.docs(spark)
    want = plain_variants(texts_of(docs), 5, 1, least)
    assert got_variants(spelling.group_variants(docs, 5, 1, least)) == want
    assert spelling.group_variants(edges.none(spark)).count() == 0


def test_runs_by_bytes_are_runs_of_letters(spark):
    text = "aÀ×÷ÿb ¿ ĀaéZ̀É ÀÉ×é 漢ã"
    assert plain_variants([(1, text)], 1000003, 1, 1) == got_variants(
        spelling.group_variants(spark.createDataFrame([(1, text)], "doc_id long, text string"), 1000003, 1, 1)
    )


def near_plain(words):
    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    return Counter(w for a, b in itertools.combinations(words, 2) if near(a, b) for w in (a, b))


@pytest.mark.parametrize("most", [2, 40, 100_000])
def test_large_states_are_halved(spark, most):
    """Nearly all words share their beginnings and ends, some repeat one letter; every pair is found once all the same."""
    words = ["".join(p) + "xyz" for p in itertools.product("abc", repeat=4)]
    words += ["a" * n for n in range(1, 12)] + ["abc" + "".join(p) for p in itertools.product("aé", repeat=5)]
    words += ["q" * 300 + c + "q" * 200 for c in ("", "a", "b", "q", "ab")]
    words = sorted(set(words))
    frame = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = {r.word: r.n_near for r in spelling.near_words(frame, most).collect()}
    assert got == dict(near_plain(words))


def test_acceptor_is_minimal_and_composes():
    acceptor = spelling.Acceptor(["tap", "taps", "top", "tops"])
    assert len(acceptor.arcs) == 5
    assert sorted(spelling.compose(acceptor, 3, 9)) == [("tap", "taps"), ("tap", "top"), ("top", "tops")]
    assert list(spelling.compose(spelling.Acceptor(["aaa", "aaaa"]), 3, 9)) == [("aaa", "aaaa")]


# decontamination


def plain_hits(docs, items, length=10):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))

    windows = defaultdict(set)
    for item, text in items:
        own = words(text)
        size = min(length, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows[tuple(own[i : i + size])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if (span := tuple(own[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[span]
        out.append((doc_id, len(own), len(hit), len(found), sorted(found), bool(hit)))
    return sorted(out, key=repr)


def got_hits(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_hits_of_the_sample(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    item_rows = [(r.item_id, r.text) for r in items.collect()]
    got = got_hits(decontamination.decontaminate(docs, items))
    assert got == plain_hits(texts_of(docs), item_rows)
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def test_query_agrees_with_sql(spark, oracle):
    got = queries.op12_winnowed_benchmark(spark, "/root/testdata/sf0.01")
    want = oracle.execute(queries.ORACLE_SQL["op12_winnowed_benchmark"])
    names = [d[0] for d in want.description]
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, want.fetchall()))


def test_short_items_overlaps_and_copies(spark):
    """Items of any length, equal grams in one window, overlapping hits, one text a third of all rows."""
    words = [f"w{n}" for n in range(30)]
    items = [
        (1, " ".join(words[:10])), (2, " ".join(words[5:18])), (3, "W3"), (4, "w20 w21"), (5, " ".join(words[22:28])),
        (6, "x x x x x x x x x x x x"), (7, None), (8, "..."), (9, " ".join(words[:10])), (None, "w29 z"), (4, "w20 w21"),
        (10, "y y y y y y"), (11, " ".join(words[:9]) + " none"),
    ]
    texts = [
        " ".join(words), " ".join(words[:9]), " ".join(words[1:11]), "x " * 40, "y " * 7, "y " * 5, "w3", "w29, Z!", "",
        None, " ".join(words[4:19] * 50), " ".join(words[6:17]), "w20-w21 w20 w20_w21", *[" ".join(words)] * 12,
    ]
    docs = list(enumerate(texts)) + [(None, "w3 w3")] * 2
    got = decontamination.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert got_hits(got) == plain_hits(docs, items)


def test_odd_tables(spark):
    docs = edges.docs(spark)
    items = edges.docs(spark).withColumnRenamed("doc_id", "item_id")
    want = plain_hits(texts_of(docs), [(r.item_id, r.text) for r in items.collect()])
    assert got_hits(decontamination.decontaminate(docs, items)) == want
    nothing = edges.none(spark).withColumnRenamed("doc_id", "item_id")
    assert {r.contaminated for r in decontamination.decontaminate(docs, nothing).collect()} == {False}
    assert decontamination.decontaminate(edges.none(spark), items).count() == 0


@pytest.mark.parametrize("length", [10, 7, 3])
def test_joins_without_broadcast(spark, length):
    words = [f"v{n % 13}" for n in range(200)]
    docs = spark.createDataFrame([(n, " ".join(words[n : n + 40])) for n in range(60)], "doc_id long, text string")
    items = [(n, " ".join(words[n * 3 : n * 3 + 2 + n])) for n in range(14)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = got_hits(
            decontamination.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"), length)
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == plain_hits(texts_of(docs), items, length)


def test_no_python_in_the_plan(spark, sf_dir, physical):
    plan = physical(queries.op12_winnowed_benchmark(spark, sf_dir))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# alignment


def plain_alignment(docs):
    one = tokenizers.Tokenizer.from_file(queries.BYTE_LEVEL)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    letter = alignment._byte_of_letter()

    def bytes_two(i):
        piece = two.id_to_piece(i)
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def spans(ids, size):
        ends = list(itertools.accumulate(size(i) for i in ids))
        return list(zip([0, *ends[:-1]], ends, strict=True)) if ends else []

    rows, counts = [], Counter()
    for doc_id, text in docs:
        links, groups, a, b = [], [], [], []
        if text:
            a = one.encode(" " + text, add_special_tokens=False).ids
            b = two.encode(text)
            bytes_a = [bytes(letter[c] for c in one.id_to_token(i)) for i in a]
            bytes_b = [bytes_two(i) for i in b]
            if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
                a, b = [], []
        if a:
            at_a = spans(range(len(a)), lambda i: len(bytes_a[i]))
            at_b = spans(range(len(b)), lambda i: len(bytes_b[i]))
            j = 0
            for i, (start, end) in enumerate(at_a):
                while at_b[j][1] <= start:
                    j += 1
                k = j
                while k < len(b) and at_b[k][0] < end:
                    links.append((a[i], b[k]))
                    k += 1
            ends = sorted({e for _, e in at_a} & {e for _, e in at_b})
            low = 0
            for end in ends:
                mine = [str(x) for x, (s, e) in zip(a, at_a, strict=True) if low <= s and e <= end]
                other = [str(x) for x, (s, e) in zip(b, at_b, strict=True) if low <= s and e <= end]
                groups.append(f"{','.join(mine)}|{','.join(other)}")
                low = end
        counts.update(links)
        rows.append((doc_id, len(a), len(b), links, groups))
    highest = {}
    for (_, y), n in counts.items():
        highest[y] = max(highest.get(y, 0), n)
    return sorted(
        (
            (
                doc_id, n_a, n_b, len(groups), len(links), sum(counts[p] == highest[p[1]] for p in links),
                sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )
            for doc_id, n_a, n_b, links, groups in rows
        ),
        key=repr,
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_of_the_sample(spark, sf_dir):
    docs = [(i, t if t is None else t[:3000]) for i, t in texts_of(table(spark, sf_dir, "documents"))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = alignment.align_corpus(frame, queries.BYTE_LEVEL, queries.PIECES, block_bytes=20_000)
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr) == plain_alignment(docs)


def test_alignment_of_odd_texts(spark):
    docs = [
        (1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "▁ not a space"), (6, "<|endoftext|> is text, <s> too"),
        (7, "\r\n\ttabs\n\n and lines "), (8, "漢字かな кириллица 😀 é \x00"), (9, "nospaces" * 300), (10, "I'll we're"),
        (10, "I'll we're"), (None, "ﬁ ½ ａ"), (11, "café  naïve x y"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = alignment.align_corpus(frame, queries.BYTE_LEVEL, queries.PIECES)
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr) == plain_alignment(docs)


def test_alignment_of_edges(spark):
    got = alignment.align_corpus(edges.docs(spark), queries.BYTE_LEVEL, queries.PIECES)
    assert got.count() == len(edges.ROWS) and got.columns == COLUMNS
    assert alignment.align_corpus(edges.none(spark), queries.BYTE_LEVEL, queries.PIECES).count() == 0


def test_parts_of_a_text_have_its_tokens(sf_dir, spark):
    one, two = alignment._loaded(queries.BYTE_LEVEL, queries.PIECES)
    texts = [t for _, t in texts_of(table(spark, sf_dir, "documents")) if t][:80]
    texts += ["a  b   c\n d \t e 1 2 3  4 ' s 's" * 40, "9 8 7 it 's 5 " * 50, "\x1c \x85 \xa0 x \u3000 \ufeff y z\u200b w"]
    rng = random.Random(6)
    pool = list("ab 19  '.,\n\té漢ñ\xa0\u2003") + [" ", " x", "'ll", " 's", "\u0301", "😀", "ﬁ"]
    texts += ["".join(rng.choice(pool) for _ in range(60)) for _ in range(400)]
    two_alone = two.encode(texts)
    for (a, b), x, y in zip(alignment.Tokeniser(one, two, 500).encode(texts), one.encode(texts), two_alone, strict=True):
        assert (a.tolist(), b.tolist()) in ((x, y), ([], []))
    assert sum(len(a) > 0 for a, _ in alignment.Tokeniser(one, two).encode(texts)) > 400
