"""What the n-gram join shuffles and holds: arrays of sets once, keys of the same nodes once, bitmaps a few at a time."""

import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from taxaweave.llm import ngram_join, scan


def _documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_keys_with_the_same_nodes_are_one_key(spark):
    rows = [(n, k) for k in (10, 11, 12) for n in (1, 2)] + [(n, 20) for n in (1, 2, 3)] + [(9, 30), (9, 30)] + [(1, 10)]
    shared = ngram_join._shared_keys(spark.createDataFrame(rows, "node long, key long").repartition(3))
    assert sorted(map(tuple, shared.collect())) == [(1, 10, 3), (1, 20, 1), (2, 10, 3), (2, 20, 1), (3, 20, 1)]


def test_arrays_come_from_the_scan_once_a_node(spark, tmp_path):
    texts = ["a b c d e f", "g h i j k l", "m n o p q r"]
    # Repeated rows, copies under other ids and rows without id, spread over tasks.
    rows = [(k, texts[k % 3]) for k in range(12)] + [(0, texts[0])] * 6 + [(None, texts[1])] * 3
    ids = _documents(spark, rows).repartition(7)
    nodes = ngram_join.written(ids.mapInArrow(ngram_join._node_scan(4), "doc_id long, n_shingles long, node long"))
    known = ngram_join.written(nodes.select("node").distinct())
    sets, _ = ngram_join._known_sets(ids, nodes, known, 4)
    assert sorted(r.node for r in sets.collect()) == sorted(r.node for r in known.collect())
    assert "Exchange hashpartitioning" not in sets._jdf.queryExecution().toString()


def test_pairs_of_a_hub_are_all_decided(spark):
    hashes = np.sort(scan.mix(np.arange(1, 101, dtype=np.uint64)))
    sets, pairs, expected = [(0, 100, hashes.tobytes())], [], set()
    for node in range(1, 3 * ngram_join.SLICE):
        own = hashes[node % 40 :]
        sets.append((node, len(own), own.tobytes()))
        pairs.append((0, node))
        expected.add((0, node, 100 * len(own) >= 80 * 100))
    pairs.append((1, 41))
    expected.add((1, 41, True))
    sets = spark.createDataFrame(sets, "node long, size long, hashes binary")
    found = ngram_join._verified(spark.createDataFrame(pairs, "a long, b long"), sets, 80)
    assert found.count() == len(expected)
    assert set(map(tuple, found.select("a", "b", "links").collect())) == expected


def test_bitmaps_of_many_pairs_stay_small_in_memory():
    words = np.arange(64 * 512, dtype=np.uint64)
    maps = words, np.arange(64) * 512, np.where(np.arange(64) % 2, 512, 256)
    left, right = (x.ravel() for x in np.meshgrid(np.arange(64), np.arange(64)))
    left, right = np.tile(left, 4), np.tile(right, 4)
    tracemalloc.start()
    ngram_join.differing_bits(maps, left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20


def test_scans_hold_a_quarter_of_a_million_characters():
    import pyarrow as pa

    sizes = [len(c.code) for c in scan.chunks(pa.array(["word " * 2000] * 60))]
    assert sum(sizes) == 600_000 and max(sizes) <= 1 << 18
