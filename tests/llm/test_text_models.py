"""Toxicity, language spans, licenses and line quality."""

import itertools
import math
import random
import time

import edges
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id, license_scan, quality, toxicity
from tidemark.llm.common import held_out
from tidemark.llm.queries import QUERIES
from tidemark.llm.viterbi import decode, decode_switching

RNG = random.Random(5)
WORDS = "the of and in to was for on with as by at from that this mill stone river cloud".split()


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


# --- toxicity ---


def toxic_model():
    texts, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        body = [prose(8) for _ in range(6)]
        if bad:
            body[RNG.randrange(6)] += " " + RNG.choice(["nastyfoo", "nastybar", "vile"])
        texts.append((". ".join(body) + ".").encode())
        labels.append(int(bad))
    return toxicity.fit(texts, np.array(labels), 0.25)


MODEL = toxic_model()


def test_noisy_or_of_sentences_and_their_places():
    text = b"The mill. This VILE river! Of stone?\nAnd nastybaz."
    score, found = MODEL.scorer().score(text)
    clear = 1 - 1 / (1 + math.exp(-MODEL.bias))
    for sentence in text.decode().lower().replace("!", ".").replace("?", ".").replace("\n", ".").split("."):
        hits = [MODEL.weights[f] for w in sentence.split() for f in toxicity.features(w.encode()) if f in MODEL.weights]
        clear *= 1 - 1 / (1 + math.exp(-MODEL.bias - sum(hits))) if hits else 1
    assert score == pytest.approx(1 - clear, abs=1e-9) and score > 0.9
    # an unseen word is known by its beginning
    assert [text[a:b] for a, b, _ in found] == [b" This VILE river", b"And nastybaz"]
    assert MODEL.scorer().score(b"the mill. of stone.")[0] < 0.1


def test_toxicity_of_odd_documents(spark):
    for model in (MODEL, None):
        got = toxicity.score(edges.docs(spark), model).collect()
        assert len(got) == len(edges.ROWS) and all(r.score < 0.3 and r.predicted == 0 and r.kept == "mine" for r in got)
        assert all(r.score < 0.05 for r in got if r.doc_id in (1, 2, 3))
    assert toxicity.score(edges.none(spark), MODEL).count() == 0
    labels = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    assert toxicity.train(edges.docs(spark), labels) is None


def test_toxicity_holds_out_and_generalises(spark):
    docs = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{docs}/labels.parquet").where("toxic is not null")
    got = QUERIES["op1_toxic_instances"](spark, docs).join(labels, "doc_id").where("held_out")
    right = got.groupBy("toxic").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("share"), F.count("*"))
    shares = {r.toxic: r.share for r in right.collect()}
    assert shares[0] > 0.97 and shares[1] > 0.8


# --- Viterbi ---


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 0, 1, 5, 2])
    scores, moves = rng.normal(size=(lengths.sum(), 3)), rng.normal(size=(3, 3))
    switching = np.where(np.eye(3, dtype=bool), 0.0, -0.7)

    def best(part, costs):
        return max(
            itertools.product(range(3), repeat=len(part)),
            key=lambda p: sum(part[i, s] for i, s in enumerate(p)) + sum(costs[a, b] for a, b in zip(p, p[1:])),
        )

    ends = np.cumsum(lengths)
    for costs, path in ((moves, decode(scores, lengths, moves)), (switching, decode_switching(scores, lengths, 0.7))):
        want = [s for n, e in zip(lengths, ends) for s in best(scores[e - n : e], costs)]
        assert path.tolist() == want


# --- language ---

TEXTS = {
    "en": "the quick brown fox jumps over the lazy dog and then the other things with them",
    "de": "der schnelle braune fuchs springt ueber den faulen hund und dann die anderen dinge mit ihnen",
    "ru": "быстрая коричневая лиса прыгает через ленивую собаку и потом другие вещи с ними",
}


def language_rows(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.sample(TEXTS[lang].split(), 10)), lang) for i, lang in enumerate(list(TEXTS) * 40)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_spans_of_mixed_text(spark):
    model = language_id.train(language_rows(spark))
    assert model.languages == ["de", "en", "ru"]
    cyrillic = model.scripts[language_id._SCRIPTS.index("cyrillic")]
    assert cyrillic.tolist() == [False, False, True]
    text = "the lazy dog and the other things, und dann die anderen dinge mit dem hund. быстрая лиса!"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = language_id.label(frame, model, penalty=4.0).first()
    assert got.span_langs == ["en", "de", "ru"] and got.span_starts == [0, 7, 15]
    assert got.lang_pred == "de" and got.score == pytest.approx(8 / 17)


def test_language_of_odd_documents(spark):
    for model in (language_id.train(language_rows(spark)), None):
        got = language_id.label(edges.docs(spark), model).collect()
        assert len(got) == len(edges.ROWS) and all(r.n_words == "w" for r in got)
        for r in got:
            if r.doc_id in (1, 2, 3) or model is None:
                assert (r.lang_pred, r.score, r.span_langs) == ("und", 0.0, [])
            else:
                assert r.lang_pred in model.languages and 0 < r.score <= 1
    assert language_id.label(edges.none(spark), model).count() == 0
    assert language_id.train(edges.none(spark)) is None
    digits = spark.createDataFrame([(1, "12 .. 34 ٣٤ …")], "doc_id long, text string")
    assert language_id.label(digits, language_id.train(language_rows(spark))).first().lang_pred == "und"


def test_language_is_learned_from_rows_not_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs.withColumn("lang", F.when(held_out(), F.lit("wrong")).otherwise(F.col("lang"))))
    assert "wrong" not in model.languages
    got = QUERIES["op5_language_spans"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


# --- licenses ---


def test_license_windows_against_all_starts():
    rng = random.Random(10)
    templates = license_scan.TEMPLATES
    counts = {}
    for text in templates.values():
        for w in license_scan.words_of(text.encode()):
            counts[w] = counts.get(w, 0) + rng.randrange(50)
    ready = license_scan.prepared(templates, counts, 0.8)
    prefix = {}
    for number, t in enumerate(ready):
        for place, word in enumerate(t.order[: len(t.order) - t.needed + 1]):
            prefix.setdefault(word, []).append((number, place))
    pool = [w for t in ready for w in t.order] + [w.encode() for w in WORDS]
    for _ in range(200):
        words = [rng.choice(pool) for _ in range(rng.randrange(30))]
        for t in rng.sample(ready, 2):
            for w in license_scan.words_of(templates[t.name].encode()):
                words += [w] * (rng.random() < 0.95) + [rng.choice(pool)] * (rng.random() < 0.3)
            words += [rng.choice(pool) for _ in range(rng.randrange(90))]
        want = {}
        for t in ready:
            for start in range(len(words)):
                share = len(set(words[start : start + t.window]) & set(t.order)) / len(t.order)
                if share * len(t.order) > t.needed - 0.5 and share > want.get(t.name, (0,))[0]:
                    want[t.name] = (share, start, min(t.window, len(words) - start))
        assert license_scan.best_windows(words, ready, prefix) == want


def test_license_notice_with_words_inserted_is_found_at_any_offset(spark):
    notice = "Released under the terms of the MIT License"
    rows = [(i, f"{prose(i)} {notice} {prose(20)}") for i in range(20)]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all("mit-line" in r.labels.split(",") for r in got)


def test_license_phrases(spark):
    text = "x MIT-License. mit license\nApache\tLicense cc by by cc by-nc GNU general public licenses"
    frame = spark.createDataFrame([(1, text), (2, "permit license"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(frame).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (5, 1, 10, "apache,cc-by,mit")
    assert (got[2].n_base, got[2].first_word, got[2].base_labels, got[2].score) == (0, None, "", 0.0)
    assert (got[3].n_words, got[3].labels, got[3].score) == (0, "", 0.0)


def test_license_templates_are_found_anywhere(spark):
    rows = [(i, prose(37 * i) + " " + text + " " + prose(11)) for i, text in enumerate(license_scan.TEMPLATES.values())]
    rows.append((99, prose(3000)))
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, name in enumerate(license_scan.TEMPLATES):
        assert name in got[i].labels.split(",") and got[i].score == 1.0
    assert got[99].labels == ""


def test_many_phrases_in_one_text_take_linear_time():
    words = license_scan.words_of(b"mit license " * 1_700_000)  # 20 MB
    began = time.process_time()
    places = license_scan.phrase_places(words, license_scan.PHRASES)
    assert time.process_time() - began < 10
    assert len(places) == 1_700_000 and places[0] == (0, "mit") and places[-1] == (3_399_998, "mit")


def test_license_scan_of_odd_documents(spark):
    got = license_scan.scan(edges.docs(spark)).collect()
    assert len(got) == len(edges.ROWS) and all(r.labels == "" and r.kept == "mine" for r in got)
    assert license_scan.scan(edges.none(spark)).count() == 0


def test_license_query_against_plain_sql(spark, oracle):
    got = QUERIES["op4_license_blocks"](spark, "/root/testdata/sf0.01")
    want = oracle.execute(
        r"select doc_id, len(regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')), "
        r"regexp_matches(lower(text), 'mit license'), regexp_matches(lower(text), 'cc by') from documents"
    ).fetchall()
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == len(want)
    for doc_id, n, mit, cc in want:
        assert rows[doc_id].n_words == n
        assert ("mit" in rows[doc_id].base_labels.split(","), "cc-by" in rows[doc_id].base_labels.split(",")) == (mit, cc)


# --- quality ---


def plain_counts(text):
    words = text.encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            again += line in seen
            seen.add(line)
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(text.count(c) for c in "#*$%&|<>"), again, len(covered)


def test_base_counts_against_plain_version():
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice(["a ", "b ", "é漢 ", "c#", "\n", "\n", "\t|", " \x0b", " ", "\x85"]) for _ in range(rng.randrange(40)))
        assert quality.base_counts(text.encode()) == plain_counts(text), repr(text)


def quality_model():
    rng = random.Random(8)
    good = [[prose(12, rng) + "." for _ in range(6)] for _ in range(80)]
    bad = [[" ".join(w.upper() + "!!" for w in prose(12, rng).split()) for _ in range(6)] for _ in range(80)]
    pages = [[quality.lines_of("\n".join(p).encode())[0], state] for group, state in ((good, 0), (bad, 1)) for p in group]
    features = np.array([f for rows, _ in pages for f in rows])
    return quality.fit_crf(features, np.array([6] * 160), np.repeat([s for _, s in pages], 6))


def test_lines_decide_retention(spark):
    model = quality_model()
    good, bad = [prose(15) + "." for _ in range(6)], [" ".join(w.upper() + "!!" for w in prose(15).split()) for _ in range(6)]
    rows = [(1, "\n".join(good)), (2, "\n".join(bad)), (3, "\n".join(good[:5] + bad[:1])), (4, "\n".join(bad[:5] + good[:1]))]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [got[i].kept for i in (1, 2, 3, 4)] == [True, False, True, False]
    assert got[1].content_share == 1.0 and 0.7 < got[3].content_share < 1


def test_quality_of_odd_documents(spark):
    for model in (quality_model(), None):
        got = quality.judge(edges.docs(spark), model).collect()
        assert len(got) == len(edges.ROWS) and all(r.base_failed and r.kept is False for r in got)
        assert all(r.labels == "z" for r in got)
    assert quality.judge(edges.none(spark), quality_model()).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.train_lines(edges.docs(spark), labels) is None


def test_quality_verdict_on_held_out_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = QUERIES["op9_line_quality"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").where(held_out())
    got = got.where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    shares = {r.quality: r.kept for r in got}
    assert shares[1] > 0.97 and shares[0] < 0.1
