"""N-gram Jaccard join, sharding and nearest neighbours against brute force."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaweave.llm import hnsw, ngram_join, shards
from tests.llm.cases import none, odd, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_components(rows, width, percent):
    sets = []
    for doc_id, text in rows:
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append((doc_id, {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()))
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((find(d), find(e)))
                root[high] = low
    return {(d, len(s), find(d)) for d, s in sets}


def near_copies(seed):
    draw, rows = random.Random(seed), [(0, None), (1, ""), (2, " \n"), (3, "a b"), (4, "A  b"), (5, "a b c d")]
    for _ in range(25):
        base = [f"w{draw.randint(0, 300)}" for _ in range(draw.choice([5, 6, 7, 9, 12, 20, 50, 150, 400]))]
        for _ in range(draw.choice([1, 2, 4, 12])):
            rate = draw.choice([0, 0.005, 0.01, 0.02, 0.03, 0.04])
            rows.append((len(rows), " ".join(w if draw.random() > rate else f"z{draw.randint(0, 99)}" for w in base)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_components(spark, width, percent):
    rows = near_copies(width)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, keys int")
    assert set(map(tuple, ngram_join.components(docs, width, percent).collect())) == brute_components(rows, width, percent)


def test_keys_find_every_link():
    """Two sets that link share a key, for all sizes up to 60 and the largest allowed difference."""
    draw = np.random.default_rng(1)
    for percent in (80, 85):
        for size in range(1, 61):
            for gone in range(0, size):
                if 100 * (size - gone) < percent * size:
                    break
                whole = np.sort(draw.integers(0, 2**63, size, dtype=np.uint64))
                part = np.delete(whole, draw.choice(size, gone, replace=False))
                keys = [set(ngram_join.band_keys(np.zeros(len(s), np.int64), s, np.array([len(s)]), percent)[1].tolist()) for s in (whole, part)]
                assert keys[0] & keys[1]


def test_keys_are_few_and_short():
    draw = np.random.default_rng(3)
    sizes = draw.integers(30, 800, 300)
    hashes = np.concatenate([np.sort(draw.integers(0, 2**63, n, dtype=np.uint64)) for n in sizes])
    for percent, most in ((80, 0.6), (85, 0.4)):
        keys = ngram_join.band_keys(np.repeat(np.arange(len(sizes)), sizes), hashes, sizes, percent)[1]
        assert len(keys) <= most * len(hashes) and int(keys.max()) < 2**48


def test_bitmaps_bound_the_overlap():
    draw = np.random.default_rng(2)
    for size in (10, 100, 700):
        a = draw.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2)
        b = np.concatenate([a[: size * 9 // 10], draw.integers(0, 2**63, size // 10, dtype=np.uint64)])
        maps = [ngram_join.bitmap(np.sort(x)) for x in (a, b)]
        for words in {min(map(len, maps)), ngram_join.LEAST_BITS // 64}:
            x, y = (ngram_join.folded(m, words) for m in maps)
            assert int(np.bitwise_count(x ^ y).sum()) <= len(set(a.tolist()) ^ set(b.tolist()))


def test_join_odd_rows(spark):
    rows = ngram_join.components(odd(spark)).collect()
    assert len(rows) == len(odd_rows())
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[6].component_id == by_id[7].component_id == 6 and by_id[9].component_id == 9
    assert all(by_id[k].n_shingles == 0 and by_id[k].component_id == k for k in (0, 1, 2))
    assert ngram_join.components(none(spark)).count() == 0


def test_shards(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "repeat('é', cast(id % 5 as int)) as text", "1 as shard", "2 as slot")
    rows = shards.place(docs).collect()
    assert {r.law for r in rows} == {"key"}
    for k in range(8):
        own = [r for r in rows if r.shard == k]
        assert sorted(r.slot for r in own) == list(range(len(own))) and 600 < len(own) < 900
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    assert 500 < sum(r.grown_shard == 8 for r in rows) < 850
    assert all(r.size == 1 + 2 * (r.doc_id % 5) and r.text_crc32 == zlib.crc32(("é" * (r.doc_id % 5)).encode()) for r in rows)
    again = {r.doc_id: (r.shard, r.slot) for r in shards.place(docs.repartition(7)).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in rows}
    assert shards.place(odd(spark)).count() == len(odd_rows())
    assert shards.place(none(spark)).count() == 0


def test_weights_move_only_what_they_must(spark):
    before = shards.tree(8)
    after = [s if s.number != 3 else shards.Shard(3, s.region, s.rack, 2.0) for s in before]
    rows = spark.range(4000).select(
        shards.shard_of(F.col("id"), before).alias("a"), shards.shard_of(F.col("id"), after).alias("b")
    ).collect()
    region = {s.number: s.region for s in before}
    moved = [r for r in rows if r.a != r.b]
    assert moved and all(region[r.b] == region[3] for r in moved)  # only into the subtree whose weight grew
    assert all(region[r.a] != region[3] or r.b in (2, 3) for r in moved)


def brute_nearest(ids, vectors, every, k):
    out = set()
    for i, q in enumerate(ids):
        if q % every == 0:
            score = vectors @ vectors[i]
            order = [j for j in np.lexsort((ids, -np.round(score, 12))) if j != i][:k]
            out |= {(int(q), rank + 1, int(ids[j])) for rank, j in enumerate(order)}
    return out


def test_nearest(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(30, 16))
    vectors = centres[draw.integers(0, 30, 1500)] + 0.3 * draw.normal(size=(1500, 16))
    vectors[100:400] = vectors[100]  # a large group of equal vectors
    vectors = vectors.astype(np.float32)
    ids = np.arange(1500) * 3
    rows = [(int(i), v.tolist(), 1) for i, v in zip(ids, vectors, strict=True)]
    rows += [(1, None, 1), (4, [], 1), (7, [0.0] * 16, 1), (10, [float("nan")] * 16, 1), (13, [None] * 16, 1), (16, [1.0] * 3, 1), rows[5]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, point int")
    found = hnsw.nearest(table, 10, 20).collect()
    got, want = {(r.query_id, r.rank, r.vec_id) for r in found}, brute_nearest(ids, vectors.astype(float), 20, 10)
    assert len(got) == len(want)
    pairs = lambda rows: {(a, c) for a, _, c in rows}
    assert len(pairs(got) & pairs(want)) >= 0.97 * len(want)
    assert hnsw.nearest(table.where("vec_id < 0"), 10, 20).count() == 0
    few = hnsw.nearest(table.where("vec_id in (0, 3, 60)"), 10, 20).collect()
    assert {(r.query_id, r.vec_id) for r in few} == {(0, 3), (0, 60), (60, 0), (60, 3)}
