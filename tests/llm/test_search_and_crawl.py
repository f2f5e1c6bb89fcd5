"""Nearest neighbours and revisits, against plain versions."""

import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import ann_forest, warc_revisit
from tidemark.llm.queries import ORACLE_SQL, QUERIES, crawl_records

VECTORS = "vec_id long, vector array<float>, score string, rank int"


def plain_neighbours(rows, asked, k=10):
    """{query: [(distance, id)]} over distinct (id, vector) rows."""
    rows = sorted({(i, tuple(np.array(v, np.float32).astype(float))) for i, v in rows})
    out = {}
    for q, x in rows:
        if q in asked:
            near = sorted((float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum())), i) for i, v in rows if (i, v) != (q, x))
            out[q] = near[:k]
    return out


def test_ties_copies_and_odd_vectors(spark):
    rng = random.Random(2)
    pool = [[float(rng.randrange(3)) for _ in range(4)] for _ in range(12)]
    good = [(i, rng.choice([v for v in pool if any(v)])) for i in range(80)]
    good += [(300 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(40)] + [(0, good[0][1]), (5, good[5][1])]
    odd = [
        (400, None), (500, []), (600, [0.0] * 4), (700, [1.0, None, 0.0, 0.0]), (800, [float("nan"), 1.0, 1.0, 1.0]),
        (900, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0, 1.0]), (1000, [1.0, 2.0]), (1100, [-0.0, 0.0, 0.0, -0.0]),
    ]
    rows = [(i, v, "x", 3) for i, v in good + odd]
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    asked = {0, 5, 17, 310, 400, 700}
    got = ann_forest.nearest(frame, frame.where(F.col("vec_id").isin(list(asked)))).collect()
    want = plain_neighbours(good, asked)
    assert {r.query_id for r in got} == {0, 5, 17, 310}
    for q, near in want.items():
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == near
    assert ann_forest.nearest(frame.limit(0), frame).count() == 0
    few = spark.createDataFrame([(1, [1.0, 2.0], "", 0), (2, [1.0, 2.5], "", 0), (3, [4.0, 2.0], "", 0)], VECTORS)
    assert [(r.query_id, r["rank"], r.vec_id) for r in ann_forest.nearest(few, few).orderBy("query_id", "rank").collect()] == [
        (1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 1), (3, 2, 2),
    ]


def test_priority_queue_opens_the_best_leaves_first():
    rng = np.random.default_rng(4)
    sample = rng.normal(size=(600, 8))
    forest = ann_forest.grow(sample, 3, 5)
    for vector in rng.normal(size=(20, 8)):
        worst = {}
        for t in range(3):
            margins = forest.normals[t] @ vector - forest.thresholds[t]
            for leaf in range(32):
                node, cost = leaf + 31, 0.0
                while node:
                    up = (node - 1) // 2
                    on_side = (node == 2 * up + 2) == (margins[up] > 0)
                    cost = max(cost, 0.0 if on_side else abs(margins[up]))
                    node = up
                worst[leaf + 32 * t] = cost
        found = forest.nearest_cells(vector, 20)
        assert len(set(found)) == 20 and {int(c) for c in forest.cells(vector[None, :])[0]} <= set(found)
        costs = [worst[c] for c in found]
        assert costs == sorted(costs) and max(costs) <= min(c for leaf, c in worst.items() if leaf not in found)


def test_hot_leaves_are_split_without_loss(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    how = {"trees": 4, "leaf_rows": 100, "search_share": 1.0, "bucket_rows": 16}
    got = ann_forest.nearest(frame, frame.where("vec_id % 100 = 0"), k=5, **how).collect()
    for q in range(0, 900, 100):
        dist = np.sqrt(((np.array([v for _, v in rows]) - np.array(rows[q][1])) ** 2).sum(1))
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == np.argsort(dist)[1:6].tolist()


def test_each_width_is_searched_and_an_id_is_one_vector(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 6)] + [(i, [float(i), 1.0, 2.0]) for i in range(11, 17)]
    rows += [(1, [9.0, 9.0]), (1, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = ann_forest.nearest(frame, frame.where("vec_id in (2, 12)"), k=3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [
        (2, 1, 1, 1.0), (2, 2, 3, 1.0), (2, 3, 4, 2.0), (12, 1, 11, 1.0), (12, 2, 13, 1.0), (12, 3, 14, 2.0),
    ]


def test_many_queries_are_dealt_without_loss(spark, monkeypatch):
    rng = np.random.default_rng(10)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    groups, plain = [], ann_forest.dealt

    def spied(index, sought, deals):
        out = plain(index, sought, deals)
        groups.extend(r["count"] for r in out[1].groupBy("bucket", "deal").count().collect())
        return out

    monkeypatch.setattr(ann_forest, "dealt", spied)
    how = {"trees": 4, "leaf_rows": 100, "search_share": 1.0, "bucket_rows": 400, "query_rows": 50}
    got = ann_forest.nearest(frame, frame, k=5, **how).collect()
    assert groups and max(groups) < 100
    values = np.array([v for _, v in rows])
    by_query = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by_query.setdefault(r.query_id, []).append(r.vec_id)
    for q in range(400):
        assert by_query[q] == np.argsort(((values - values[q]) ** 2).sum(1), kind="stable")[1:6].tolist()


def test_recall_of_the_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas().sort_values("vec_id")
    ids, vectors = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    got = QUERIES["op3_forest_neighbours"](spark, sf).toPandas()
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        dist = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(1))
        dist[ids == q] = np.inf
        own = got[got["query_id"] == q]
        assert np.allclose(dist[np.searchsorted(ids, own["vec_id"])], own["score"], rtol=1e-12)
        hits += len(set(ids[np.lexsort((ids, dist))[:10]]) & set(own["vec_id"]))
        total += 10
    assert hits / total >= 0.9


# --- revisits ---

RECORDS = (
    "record_id long, url string, captured timestamp, status int, etag string, last_modified string, digest string, "
    "headers map<string,string>, outcome string, range int"
)


def plain_key(url):
    rest = url.strip().split("#")[0].split("://", 1)[1]
    rest, _, query = rest.partition("?")
    host, slash, path = rest.partition("/")
    host = host.lower()
    for port in (":80", ":443"):
        host = host.removesuffix(port)
    asked = sorted(p for p in query.split("&") if p and not p.split("=")[0].startswith("utm_") and p.split("=")[0] != "ref")
    return host.removeprefix("www.") + (slash + path).rstrip("/") + ("?" + "&".join(asked) if asked else "")


def plain_resolve(records):
    out = []
    for r in records:
        if r[3] != 304:
            continue
        earlier = [x for x in records if x[3] == 200 and x[6] and r[1] and x[1] and plain_key(x[1]) == plain_key(r[1])
                   and (x[2], x[0]) < (r[2], r[0])]
        if not earlier:
            out.append((r[0], "missing", None, None, None))
            continue
        old = max(earlier, key=lambda x: (x[2], x[0]))
        if r[4] and old[4]:
            outcome = "resolved" if r[4].removeprefix("W/") == old[4].removeprefix("W/") else "changed"
        elif r[5] and old[5]:
            outcome = "resolved" if r[5] == old[5] else "changed"
        else:
            outcome = "unchecked"
        if outcome == "changed":
            out.append((r[0], outcome, None, None, None))
            continue
        merged = {k.lower(): v for k, v in (old[7] or {}).items()}
        merged |= {k.lower(): v for k, v in (r[7] or {}).items() if k.lower() not in warc_revisit.FIXED_HEADERS}
        out.append((r[0], outcome, old[0], old[6], tuple(sorted(merged.items()))))
    return sorted(out, key=repr)


def test_revisits_against_plain_version(spark):
    import datetime as dt

    rng = random.Random(11)
    urls = [
        "http://a.org/x", "https://www.A.org:443/x/", "http://a.org:80/x#top", "http://a.org/x?utm_source=m", "https://b.org/?z=1&a=2",
        "http://b.org?a=2&z=1&ref=q", "http://b.org/?z=1", None,
    ]
    records = []
    for i in range(400):
        full = rng.random() < 0.2
        records.append((
            i, rng.choice(urls), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(60)),
            200 if full else rng.choice([304, 304, 404]), rng.choice([None, '"1"', 'W/"1"', '"2"']), rng.choice([None, "mon", "tue"]),
            rng.choice(["d1", "d2", None]) if full else None,
            rng.choice([None, {"Date": str(i), "Content-Length": "0", "X-Tag": "t"}, {"date": str(i), "ETag": "e"}]), "o", 1,
        ))
    frame = spark.createDataFrame(records, RECORDS).repartition(3)
    for partitions in (1, 7, None):
        got = warc_revisit.resolve(frame, partitions).collect()
        rows = [(r.record_id, r.outcome, r.refers_to, r.digest, None if r.headers is None else tuple(sorted(r.headers.items()))) for r in got]
        assert sorted(rows, key=repr) == plain_resolve(records)
    doubled = warc_revisit.resolve(frame.union(frame)).groupBy("record_id").count().collect()
    assert {r["count"] for r in doubled} == {2}
    assert warc_revisit.resolve(frame.limit(0)).count() == 0


def test_urls_without_scheme_do_not_share_a_key(spark):
    urls = ["a.org/b", "a.org/c", "dns:a.org", "<http://A.org/d>", " <e.org/f> "]
    rows = [(i, u, i, 200, f"d{i}") for i, u in enumerate(urls)]
    rows += [(10 + i, u, 10 + i, 304, None) for i, u in enumerate(["a.org/b", "a.org/c", "dns:a.org", "https://a.org/d", "e.org/f"])]
    rows.append((20, "a.org/never", 20, 304, None))
    frame = spark.createDataFrame(rows, "record_id long, url string, at long, status int, digest string").select(
        "record_id", "url", F.timestamp_seconds("at").alias("captured"), "status", F.lit(None).cast("string").alias("etag"),
        F.lit(None).cast("string").alias("last_modified"), "digest", F.create_map().cast("map<string,string>").alias("headers"),
    )
    got = {r.record_id: r for r in warc_revisit.resolve(frame).collect()}
    assert [got[10 + i].digest for i in range(5)] == [f"d{i}" for i in range(5)]
    assert got[20].outcome == "missing"


def test_revisit_query_against_sql(spark, oracle):
    frame = QUERIES["op10_warc_revisits"](spark, "/root/testdata/sf0.01")
    cursor = oracle.execute(ORACLE_SQL["op10_warc_revisits"])
    names = [d[0] for d in cursor.description]
    want = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(r[n] for n in names)) for r in frame.collect()) == want
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    assert frame.count() == crawl_records(pages).where("status = 304").count()
    assert {r.outcome for r in frame.select("outcome").distinct().collect()} == {"resolved", "unchecked", "changed", "missing"}


def test_header_names_that_differ_in_case(spark):
    rows = [
        (1, "http://a/", 10, 200, "x", None, "d", {"Date": "old", "date": "new", "ETag": "1", "etag": "2", "Age": "7"}),
        (2, "http://a/", 20, 304, "x", None, None, {"DATE": "a", "Date": "b", "Expires": "c"}),
        (3, "http://a/", 30, 304, "x", None, None, None),
    ]
    schema = "record_id long, url string, at long, status int, etag string, last_modified string, digest string, headers map<string,string>"
    frame = spark.createDataFrame(rows, schema).withColumn("captured", F.timestamp_seconds("at")).drop("at")
    got = {r.record_id: r for r in warc_revisit.resolve(frame).collect()}
    assert set(got[3].headers) == {"date", "etag", "age"} and got[3].headers["age"] == "7"
    assert set(got[2].headers) == {"date", "etag", "age", "expires"} and got[2].headers["date"] in ("a", "b")
