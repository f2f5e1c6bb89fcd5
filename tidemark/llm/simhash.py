"""Near duplicates by SimHash, compared bit-sliced.

A fingerprint has one bit per column of the hashes of a document's word shingles: 1 where over half of them have it set.
Documents with equal fingerprints are one node. Nodes that may link meet under a candidate key:

* small radius: the fingerprint is cut into `blocks` blocks. Two that differ in at most `radius` bits agree on
  `blocks - radius` whole blocks, so every such choice of blocks is a key, and no link is lost.
* large radius: no choice of whole blocks is left, so the smallest shingle hashes under several mixings are the keys. Two
  documents with shingle similarity s miss each other under all `min_keys` of them with probability (1 - s) ** min_keys.

Under a key, bit planes are stored vertically: one 64-bit word holds one bit of 64 fingerprints. A fingerprint is compared
with 64 others at once; their distances are counted in carry-save slices whose start value makes them overflow just beyond
the radius, and a block is abandoned once all its lanes have overflowed. A task reports a spanning forest of its links
only, which keeps every connection and never lists all pairs of a group. A key with more than `chunk` nodes is split in
chunks; each pair of chunks is a task of its own, so a hot key is shared out and nothing is capped.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, batch_of, give_back, per_batch, saved, small_batches, utf8

U64 = np.uint64
ALL = U64(0xFFFFFFFFFFFFFFFF)
SEED = 42


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of the word shingles of a text, repeats included; ASCII letters are lower-cased."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, U64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    count = max(len(words) - shingle + 1, 1)
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, itertools.repeat(SEED)), U64, count)


def mixed(hashes: np.ndarray, turn: int) -> np.ndarray:
    """Another hash of the same shingles; turn 0 is the hash itself."""
    if not turn:
        return hashes
    x = hashes + U64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, bit 0 first. Bytes are added 255 rows at a time, which cannot overflow."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255
    total = bits[whole:].sum(0, dtype=np.int64)
    if whole:
        total += bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return total


def fingerprint(hashes: np.ndarray, words: int = 1) -> bytes:
    """The fingerprint of `words` times 64 bits, as big-endian words; zero without hashes."""
    if not len(hashes):
        return bytes(8 * words)
    return b"".join(
        np.packbits(2 * bit_counts(mixed(hashes, k)) > len(hashes), bitorder="little")[::-1].tobytes()
        for k in range(words)
    )


def fingerprints(docs: DataFrame, shingle: int, words: int = 1, min_keys: int = 0, distinct: bool = False) -> DataFrame:
    """(doc_id, text_hash, fp, keys): the fingerprint of each text and, if asked for, its smallest mixed shingle hashes.

    Texts without words have the zero fingerprint and the keys -1, -2 and so on. With `distinct` a repeated shingle counts
    once, and there are two columns more: node, a hash of the set of shingles, and n, its size.
    """

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            prints, keys, node, n = [], [], [], []
            for text in batch.column("text"):
                hashes = shingle_hashes(text.as_py(), shingle)
                if distinct:
                    hashes = np.unique(hashes)
                    node.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                    n.append(len(hashes))
                prints.append(fingerprint(hashes, words))
                if min_keys and len(hashes):
                    smallest = [int(mixed(hashes, 101 + k).min()) for k in range(min_keys)]
                    keys.append([(x ^ k << 60) - (1 << 63) for k, x in enumerate(smallest)])
                else:
                    keys.append([-1 - k for k in range(min_keys)])
            return {c: batch.column(c) for c in ("doc_id", "text_hash")} | {
                "fp": prints, "keys": keys, "node": node, "n": n,
            }

        return step

    return per_batch(
        docs.select(F.col("doc_id").cast("long"), F.xxhash64(utf8()).alias("text_hash"), utf8().alias("text")),
        make,
        "doc_id long,text_hash long,fp binary,keys array<long>" + ",node binary,n long" * distinct,
    )


def block_keys(nodes: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(key, fp): a key for every choice of `blocks - radius` blocks of a 64-bit fingerprint."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    choices = list(itertools.combinations(range(blocks), blocks - radius))
    masks = np.array([sum((1 << edges[b + 1]) - (1 << edges[b]) for b in c) for c in choices], U64)

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            fps = batch.column("fp")
            values = np.frombuffer(b"".join(fps.to_pylist()), ">u8").astype(U64)
            keys = (values[:, None] & masks[None, :]) ^ (np.arange(len(masks), dtype=U64) * U64(0x9E3779B97F4A7C15))
            rows = np.repeat(np.arange(len(values)), len(masks))
            return {"key": keys.reshape(-1).view(np.int64), "fp": fps.take(pa.array(rows))}

        return step

    return per_batch(nodes.select("fp"), make, "key long,fp binary")


def _planes(bits: np.ndarray) -> np.ndarray:
    """Bit planes of rows of bits: [block of 64 rows, bit] -> a word whose bit i is that bit of row i."""
    n, width = bits.shape
    padded = np.zeros((-(-n // 64) * 64, width), np.uint8)
    padded[:n] = bits
    packed = np.packbits(padded.reshape(-1, 64, width).transpose(0, 2, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8").reshape(-1, width)


def _below(n: np.ndarray) -> np.ndarray:
    """Words with the lowest n bits set, n from 0 to 64."""
    return np.where(n >= 64, ALL, (U64(1) << (n.astype(U64) & U64(63))) - U64(1))


def linked_rows(fps: np.ndarray, first: np.ndarray, last: np.ndarray, radius: int, batch: int = 32768):
    """Yields (row, other) index arrays: all pairs within `radius` bits where row r meets the rows first[r]..last[r]-1.

    `fps` is rows of bytes.
    """
    width = 8 * fps.shape[1]
    bits = np.unpackbits(fps, axis=1)
    planes = _planes(bits)
    own = np.ascontiguousarray(bits.T).astype(bool)
    slices = radius.bit_length() + (radius & (radius + 1) == 0)
    start = (1 << slices) - 1 - radius
    rows = np.flatnonzero(last > first)
    spans = (last[rows] - 1) // 64 - first[rows] // 64 + 1
    ends = np.cumsum(spans)
    for begin in range(0, int(ends[-1]) if len(ends) else 0, batch):
        item = np.arange(begin, min(begin + batch, int(ends[-1])))
        of = np.searchsorted(ends, item, side="right")
        row = rows[of]
        block = first[row] // 64 + item - (ends[of] - spans[of])
        live = _below(np.minimum(last[row] - block * 64, 64)) & ~_below(np.maximum(first[row] - block * 64, 0))
        counter = [np.full(len(item), ALL if start >> s & 1 else U64(0)) for s in range(slices)]
        for bit in range(width):
            carry = planes[block, bit] ^ np.where(own[bit][row], ALL, U64(0))
            for s in range(slices):
                counter[s], carry = counter[s] ^ carry, counter[s] & carry
            live &= ~carry
            if bit % 16 == 15:
                left = np.flatnonzero(live)
                if len(left) < 0.7 * len(live):
                    row, block, live = row[left], block[left], live[left]
                    counter = [c[left] for c in counter]
                    if not len(left):
                        break
        left = np.flatnonzero(live)
        if len(left):
            lanes = np.unpackbits(live[left].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, lane = np.nonzero(lanes)
            yield row[left[at]], block[left[at]] * 64 + lane


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merges the sets of a and b; afterwards each row's parent is the first row of its set."""
    while len(a):
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up


def _spans(task: np.ndarray, side: np.ndarray, crossed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows each row is compared with: the later ones of its task; those of the other side if the task crosses sides."""
    n = len(task)
    new_task = np.flatnonzero(np.r_[True, np.any(task[1:] != task[:-1], axis=1)])
    end = np.repeat(np.r_[new_task[1:], n], np.diff(np.r_[new_task, n]))
    new_side = np.flatnonzero(np.r_[True, np.any(task[1:] != task[:-1], axis=1) | (side[1:] != side[:-1])])
    next_side = np.repeat(np.r_[new_side[1:], n], np.diff(np.r_[new_side, n]))
    return np.minimum(np.where(crossed, next_side, np.arange(n) + 1), end), end


def links(keyed: DataFrame, radius: int, chunk: int = 4096, held_rows: int = 20_000) -> DataFrame:
    """(a, b): a spanning forest, for each key, of the fingerprints within `radius` bits. `keyed` is (key, fp)."""
    hot = keyed.groupBy("key").count().where(F.col("count") > chunk)
    hot = hot.select("key", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    dealt = keyed.join(hot, "key", "left").select(
        "key", "fp", F.coalesce("chunks", F.lit(1)).alias("chunks"),
        F.pmod(F.xxhash64("fp"), F.coalesce("chunks", F.lit(1))).cast("int").alias("side"),
    )
    tasks = dealt.select("key", "fp", "side", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")).select(
        "key", "fp", "side", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high")
    )
    sorted_tasks = tasks.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "side")
    out = arrow_schema("a binary,b binary")

    def compare(batch: pa.Table) -> pa.RecordBatch | None:
        task = np.stack([batch.column(c).to_numpy() for c in ("key", "low", "high")], axis=1)
        alike = np.all(task[1:] == task[:-1], axis=1)
        company = np.flatnonzero(np.r_[False, alike] | np.r_[alike, False])
        if not len(company):
            return None
        batch, task = batch.take(company), task[company]
        side, crossed = batch.column("side").to_numpy(), task[:, 1] != task[:, 2]
        first, last = _spans(task, side, crossed)
        within = np.where(crossed, (last > first) & (side == task[:, 1]), last > first)
        fps = batch.column("fp").to_pylist()
        rows = np.frombuffer(b"".join(fps), np.uint8).reshape(len(fps), -1)
        parent = np.arange(len(fps))
        for a, b in linked_rows(rows, np.where(within, first, 0), np.where(within, last, 0), radius):
            _join(parent, a, b)
        child = np.flatnonzero(parent != np.arange(len(fps)))
        if not len(child):
            return None
        return batch_of({"a": [fps[i] for i in parent[child]], "b": [fps[i] for i in child]}, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            if held.num_rows < held_rows:
                continue
            task = np.stack([held.column(c).to_numpy() for c in ("key", "low", "high")], axis=1)
            cut = np.flatnonzero(np.any(task[1:] != task[:-1], axis=1))
            if len(cut):
                if (found := compare(held.slice(0, int(cut[-1]) + 1))) is not None:
                    yield found
                held = held.slice(int(cut[-1]) + 1).combine_chunks()
        if held is not None and (found := compare(held)) is not None:
            yield found
        give_back()

    return sorted_tasks.mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b) edges: the smallest node it is connected with, by alternating stars.

    Each round is two joins and aggregations; the rounds stop when the edges do. A node with very many edges is never
    gathered: the smallest neighbour is a partial aggregate, and the joins can be split.
    """

    def state(frame: DataFrame):
        return frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    def large_star(frame: DataFrame) -> DataFrame:
        both = frame.unionByName(frame.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))

    def small_star(frame: DataFrame) -> DataFrame:
        least = frame.groupBy("u").agg(F.min("v").alias("m"))
        moved = frame.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()

    stars = saved(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges"
    )
    before = state(stars)
    while before[0]:
        stars = saved(small_star(large_star(stars).distinct()), "stars")
        after = state(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))


def similar_sets(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): a spanning forest of the pairs of sets whose exact similarity, shared by all members, is `similarity` or more.

    Each set is looked up once, in lists of the sets that hold a member and are not reached yet.
    """
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    holders = np.repeat(np.arange(n), sizes)[np.argsort(code, kind="stable")]
    bounds = np.r_[0, np.cumsum(np.bincount(code))]
    fresh, built, left = np.ones(n, bool), n, n
    a, b = [], []
    for seed in range(n):
        queue = [seed] if fresh[seed] else []
        left -= len(queue)
        fresh[seed] = False
        while queue:
            at = queue.pop()
            if left < built / 2:
                kept = fresh[holders]
                bounds, holders, built = np.r_[0, np.cumsum(kept)][bounds], holders[kept], left
            own = code[ends[at] - sizes[at] : ends[at]]
            counts = bounds[own + 1] - bounds[own]
            places = np.arange(counts.sum()) + np.repeat(bounds[own] - (np.cumsum(counts) - counts), counts)
            shared = np.bincount(holders[places], minlength=n)
            found = np.flatnonzero(fresh & (shared > 0) & (shared >= similarity * (sizes[at] + sizes - shared) - 1e-9))
            fresh[found] = False
            left -= len(found)
            queue += found.tolist()
            a += [at] * len(found)
            b += found.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def exact_links(
    docs: DataFrame, members: DataFrame, shingle: int, similarity: float, chunk: int = 1 << 20, held_bytes: int = 16 << 20
) -> DataFrame:
    """(a, b): links of at least `similarity` that connect, in each group, all nodes that such links connect.

    `members` is (node, n, first, group): sets of `n` shingles and the row of `docs` that has them. A group of more than
    `chunk` shingles is split in chunks, and each pair of chunks is a task.
    """
    groups = members.groupBy("group").agg(F.count("*").alias("nodes"), F.sum("n").alias("n")).where("nodes > 1")
    groups = groups.select("group", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    # null ids never meet in a join
    wanted = members.join(groups, "group").select(
        "node", "group", F.greatest("chunks", F.lit(1)).alias("chunks"), F.col("first.late").alias("late"),
        F.coalesce("first.doc_id", F.lit(-1)).alias("id"), F.col("first.text_hash").alias("text_hash"),
    )
    one_id = F.col("doc_id").cast("long")
    texts = docs.select(
        one_id.isNull().alias("late"), F.coalesce(one_id, F.lit(-1)).alias("id"), F.xxhash64(utf8()).alias("text_hash"),
        utf8().alias("text"),
    )
    # one row of each node, if a row of `docs` is repeated
    texts = texts.join(wanted, ["late", "id", "text_hash"]).groupBy("node", "group", "chunks").agg(F.first("text").alias("text"))

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            sets = [np.unique(shingle_hashes(t.as_py(), shingle)).view(np.int64) for t in batch.column("text")]
            return {c: batch.column(c) for c in ("node", "group", "chunks")} | {"shingles": sets}

        return step

    sets = per_batch(texts, make, "node binary,group long,chunks int,shingles array<long>")
    tasks = sets.withColumn("side", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    tasks = tasks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    tasks = tasks.where("chunks = 1 or other != side").select(
        "node", "group", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "shingles"
    )
    sorted_tasks = small_batches(tasks.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high"))
    out = arrow_schema("a binary,b binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def compare(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            rows = pa.Table.from_batches(held).combine_chunks()
            task = np.stack([rows.column(c).to_numpy() for c in ("group", "low", "high")], axis=1)
            cuts = np.flatnonzero(np.r_[True, np.any(task[1:] != task[:-1], axis=1), last]).tolist()
            for begin, end in zip(cuts[:-1], cuts[1:]):
                if end - begin > 1:
                    part = rows.slice(begin, end - begin)
                    nodes = part.column("node").to_pylist()
                    a, b = similar_sets([s.values.to_numpy() for s in part.column("shingles")], similarity)
                    if len(a):
                        yield batch_of({"a": [nodes[i] for i in a], "b": [nodes[i] for i in b]}, out)
            held = [] if last else rows.slice(cuts[-1]).to_batches()

        most = held_bytes
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.nbytes for b in held) >= most:
                yield from compare(False)
                most = max(held_bytes, 2 * sum(b.nbytes for b in held))
        if held:
            yield from compare(True)
        give_back()

    return sorted_tasks.mapInArrow(run, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 2,
    blocks: int = 6,
    words: int = 1,
    min_keys: int = 0,
    similarity: float = 0.0,
) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, leads) for every row of `docs` (doc_id, text).

    component_id is the smallest doc_id of the documents reachable over links of at most `radius` differing bits.
    With `min_keys`, links are searched under that many smallest shingle hashes instead of under block keys, which allows
    a large radius and fingerprints of `words` times 64 bits. With a `similarity` above 0, fingerprints are of distinct
    shingles, and a link counts only if the two sets of shingles share that much of all they hold. text_hash is the XXH64 of the text; leads is true for the
    rows of the component with the smallest doc_id and, under it, the smallest text_hash.

    A null text counts as empty; empty texts have the zero fingerprint and link like others. A null doc_id keeps its row
    and is never a component's smallest id, unless all are null: then the component is null. Repeated rows stay repeated.
    Other columns of `docs` are ignored. An empty table gives no rows.
    """
    marks = saved(fingerprints(docs, shingle, words, min_keys, similarity > 0), "fingerprints")
    # a null id comes after all others
    rank = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash")
    firsts = marks.groupBy("fp").agg(F.min(rank).alias("first"))
    node = "node" if similarity > 0 else "fp"
    if min_keys:
        keyed = marks.select(F.explode("keys").alias("key"), "fp").distinct()
    else:
        keyed = block_keys(firsts, radius, blocks)
    roots = components(links(keyed, radius)).select(F.col("node").alias("fp"), "root")
    if similarity > 0:
        firsts = marks.groupBy("node").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.min(rank).alias("first"))
        group = F.xxhash64(F.coalesce("root", "fp")).alias("group")
        members = saved(firsts.join(roots, "fp", "left").select("node", "n", "first", group), "members")
        firsts, roots = members.select("node", "first"), components(exact_links(docs, members, shingle, similarity))
    nodes = saved(firsts.join(roots, node, "left").select(node, "first", F.coalesce("root", node).alias("root")), "nodes")
    least = nodes.groupBy("root").agg(F.min("first").alias("leader"))
    named = nodes.join(least, "root").select(node, "leader")
    leads = F.col("leader.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("leader.text_hash") == F.col("text_hash"))
    return marks.join(named, node).select(
        "doc_id", "text_hash", "fp", F.col("leader.doc_id").alias("component_id"), leads.alias("leads")
    )


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The rows of `docs` that lead their group of near duplicates, one for each group; see `near_duplicates` for `how`."""
    leaders = near_duplicates(docs, **how).where("leads").select("doc_id", "text_hash")
    leaders = leaders.groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows"))
    one_id, one_hash = F.col("doc_id").cast("long"), F.xxhash64(utf8())
    kept = docs.withColumn("__id", one_id).withColumn("__hash", one_hash)
    same = [
        F.coalesce(kept["__id"], F.lit(-1)) == F.coalesce(leaders["doc_id"], F.lit(-1)),
        kept["__id"].isNull() == leaders["doc_id"].isNull(),
        kept["__hash"] == leaders["text_hash"],
    ]
    repeated = leaders.where("rows > 1")
    if repeated.isEmpty():
        return kept.join(leaders, same, "left_semi").select(*[kept[f"`{c}`"] for c in docs.columns])
    return kept.join(leaders, same, "left_semi").dropDuplicates(["__id", "__hash"]).drop("__id", "__hash")
