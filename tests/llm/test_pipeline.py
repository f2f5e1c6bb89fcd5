"""The corpus pipeline: its stages, and what they are told by odd tables."""

import pathlib
import random
import subprocess
import sys

import edges
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tidemark.llm import bpe, mixing, queries

SF = "/root/testdata/sf0.001"
ROOT = pathlib.Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_stages_follow_each_other(spark, stages):
    docs, good, single, cut, mixed, encoded = stages
    for frame in stages[:-1]:
        assert frame.columns == docs.columns
    verdicts = {r.doc_id for r in queries.op9_line_quality(spark, SF).where("kept").collect()}
    assert ids(good) == sorted(verdicts)
    assert set(ids(single)) < set(ids(good)) and len(set(ids(single))) == single.count()
    assert ids(cut) == ids(single)
    taken = {r.doc_id: r.copies for r in mixing.mix(cut).collect()}
    assert ids(mixed) == sorted(d for d, n in taken.items() for _ in range(n))
    assert ids(encoded) == ids(mixed) and {"n_tokens", "ids"} <= set(encoded.columns)


def test_near_duplicate_stage_against_exact_similarity(stages):
    _, good, single, *_ = stages
    texts = {r.doc_id: set(map(tuple, grams(r.text))) for r in good.collect()}
    kept = set(ids(single))
    for a in kept:
        for b in kept:
            if a < b:
                assert len(texts[a] & texts[b]) / len(texts[a] | texts[b]) < 0.9
    for gone in set(texts) - kept:
        assert max(len(texts[gone] & t) / len(texts[gone] | t) for d, t in texts.items() if d != gone) > 0.6


def grams(text):
    words = text.lower().split()
    return [words[i : i + 5] for i in range(max(len(words) - 4, 1))]


def test_no_passage_is_left_twice(stages):
    cut = stages[3].collect()
    seen = {}
    for r in cut:
        assert r.n_chars == len(r.text)
    before = {r.doc_id: r.text for r in stages[2].collect()}
    for doc_id, text in sorted(before.items()):
        data = text.encode()
        for i in range(len(data) - 49):
            seen.setdefault(data[i : i + 50], doc_id)
    for r in cut:
        data, gone = before[r.doc_id].encode(), set()
        for i in range(len(data) - 49):
            if seen[data[i : i + 50]] < r.doc_id:
                gone |= set(range(i, i + 50))
        assert r.text == bytes(c for i, c in enumerate(data) if i not in gone).decode("utf-8", "ignore")


def test_ids_decode_to_the_text(stages):
    mixed, encoded = stages[4:]
    table = {i: t for t, i in bpe.read_ranks(corpus_pipeline.RANKS).items()}
    texts = {r.doc_id: r.text for r in mixed.collect()}
    for r in encoded.collect():
        tokens = np.frombuffer(r.ids, "<u4").tolist()
        assert r.text == texts[r.doc_id] == b"".join(table[i] for i in tokens).decode() and len(tokens) == r.n_tokens


def test_run_is_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    key = lambda r: (r.doc_id, r.n_tokens, bytes(r.ids))
    assert sorted(map(key, got.collect())) == sorted(map(key, stages[-1].collect()))


def test_stages_take_odd_and_empty_tables(spark):
    for docs, n in ((edges.docs(spark), len(edges.ROWS)), (edges.none(spark), 0)):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, SF)
            rows = got.count()
            if name != "token_ids":
                assert got.columns == docs.columns
            if name in ("repeated_passages", "token_ids"):
                assert rows == n


def test_clean_different_documents_are_kept(spark):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "bcdfghklmnprst" for b in ("a", "en", "or", "ist", "ul", "ave")]
    rows = [(i, "\n".join(" ".join(rng.choice(words) for _ in range(14)).capitalize() + "." for _ in range(9)), "en", "s", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, "/root/testdata/sf0.01").cache()
        assert docs.count() == 200
    assert docs.where(F.length("text") < 500).count() == 0


def test_the_rest_works_without_this_package(tmp_path):
    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    for name in ("tidemark", "__spark_entry__.py"):
        source = ROOT / name
        for path in source.rglob("*.py") if source.is_dir() else [source]:
            if "llm" not in path.parts:
                target = tmp_path / path.relative_to(ROOT)
                target.parent.mkdir(parents=True, exist_ok=True)
                target.write_text(path.read_text())
    code = "import __spark_entry__ as e; print(any(n.startswith('op1_') or n == 'pipeline' for n in e.queries()), set(e.oracle_sql()) == set(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert done.stdout.split() == ["False", "True"], done.stderr
