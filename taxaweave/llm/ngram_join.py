"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact sorted-array intersection.

Documents are sets of word shingles. Two sets link when ``percent`` of their union is
shared. The work goes in four steps, all exact:

1. *Keys.* A link of sizes up to ``hi`` differs in at most D = 2 hi (1-t)/(1+t) shingles.
   Per band of sizes, the hash space is cut into some more than D parts, so that a
   part with shingles stays equal; its content, hashed to 48 bits, is the key. A set with too many empty
   parts (rare, as an eighth more than D are cut) adds the keys of its prefix (the smallest hashes, of which a link shares one).
   Equal sets are one node from the start, so copies add no keys.
   Keys go straight into the shuffle that finds the shared ones; only these are written, those with the same
   nodes as one key with their number as its weight.
2. *Hubs.* Each node is compared with one node of its keys, in rounds, always one of
   another component; groups of near copies collapse here, without pairs among their members.
3. *Tiles.* Keys that still hold several components are laid out as tiles (large ones
   in blocks). In a tile, the bits in which two hashed bitmaps differ bound the
   overlap from above; of each node's pairs under the bound the closest go on. A pair that shares several of the
   first keys of both is left to the first of them, and is given by the node whose component is the smaller one there.
4. *Intersection* of the sorted arrays of a pair decides. Where more pairs of a node pass
   the bound, its tiles run again for more, until every pair is tried or within one component.

Nulls and odd rows: a null or wordless text has an empty set and links with nothing;
fewer words than ``width`` make one shingle; repeated rows, also of one ``doc_id``, link as equal
sets; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaweave.llm.scan import Chunk, chunks, counts_by_row, mix, span_hashes, windows
from taxaweave.llm.steps import discard, written
from taxaweave.operators.components import connected_components

#: Wide bands and spare parts: fewer keys than narrow bands, whose sets often have too many empty parts.
GROWTH = 1.5
LARGEST = 1 << 40
#: Bits of a key that are kept. Keys that only meet by chance cost a comparison, no link.
KEY_BITS = 48
#: Bits of the sieve of candidate ids: at least, at most (16 MB), and for each of them.
SIEVE, MOST_SIEVE, SIEVE_BITS = 1 << 22, 1 << 27, 16
#: Pairs of a node that take its array from one row.
SLICE = 64
TILE = 1024
LEAST_BITS, MOST_BITS, BITS_PER_SHINGLE = 256, 1 << 15, 8
#: Closest pairs of a node with other components that are tried at first, and how many times more in each further round.
FIRST, MORE = 2, 64
#: Keys of a node, in the order of their sizes, that are asked whether a pair belongs to another tile.
FIRST_KEYS = 4
#: Rows of ids that are sent to all tasks at most (8 MB); larger tables are joined by a shuffle.
SENT = 1_000_000
#: Hub rounds go on while this share of their pairs link.
WORTH = 0.05


def _edges() -> np.ndarray:
    """Smallest size of every band."""
    edges = [1]
    while edges[-1] < LARGEST:
        edges.append(max(edges[-1] + 1, int(edges[-1] * GROWTH)))
    return np.array(edges, np.int64)


EDGES = _edges()


def _lower(code: np.ndarray) -> np.ndarray:
    return np.where((code >= 0x41) & (code <= 0x5A), code + 0x20, code)


def shingle_sets(chunk: Chunk, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles, sorted, and the set size of each row."""
    starts, ends = chunk.words()
    rows = chunk.row_of(starts)
    hashes = span_hashes(chunk.prefix(_lower(chunk.code)), starts, ends)
    full, first = windows(hashes, rows, width)
    n_words = counts_by_row(rows, chunk.rows)
    few = (n_words < width)[rows]
    place = np.arange(len(rows)) - np.searchsorted(starts, chunk.bounds)[rows]
    short = np.zeros(chunk.rows, np.uint64)
    np.add.at(short, rows[few], mix(hashes[few] + mix(place[few].astype(np.uint64) + np.uint64(99))))
    short_rows = np.flatnonzero((n_words > 0) & (n_words < width))
    all_rows = np.concatenate([rows[first], short_rows])
    all_hashes = np.concatenate([full, mix(short[short_rows])])
    order = np.lexsort((all_hashes, all_rows))
    all_rows, all_hashes = all_rows[order], all_hashes[order]
    new = np.ones(len(all_rows), bool)
    new[1:] = (all_rows[1:] != all_rows[:-1]) | (all_hashes[1:] != all_hashes[:-1])
    return all_rows[new], all_hashes[new], counts_by_row(all_rows[new], chunk.rows)


def _set_ids(rows: np.ndarray, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One number for each set; equal sets have equal ones."""
    total = np.zeros(len(sizes), np.uint64)
    np.add.at(total, rows, mix(hashes ^ np.uint64(0x5851F42D4C957F2D)))
    return mix(total + mix(sizes.astype(np.uint64)))


def band_keys(rows: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): nodes that link share a key."""
    spread, part_of = mix(hashes ^ np.uint64(0x2545F4914F6CDD1D)), mix(hashes + np.uint64(0x1234567)) >> np.uint64(32)
    ends = np.cumsum(sizes)
    band = np.searchsorted(EDGES, np.maximum(sizes, 1), "right") - 1
    out_rows, out_keys = [], []
    step = 0
    while True:
        scheme = band + step
        # The scheme is that of the larger set's band: all that a set of this size can link with.
        use = (sizes > 0) & (EDGES[scheme] * percent <= sizes * 100)
        if not use.any():
            break
        highest = EDGES[scheme + 1] - 1
        differ = (2 * highest * (100 - percent)) // (100 + percent)
        parts = np.where(use, differ + 1 + np.where(differ > 0, 2 + differ // 8, 0), 0)
        offset = np.cumsum(parts) - parts
        at = np.flatnonzero(use[rows])
        row = rows[at]
        part = ((part_of[at] * parts[row].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        slot = offset[row] + part
        total = np.zeros(int(parts.sum()), np.uint64)
        np.add.at(total, slot, spread[at])
        filled = np.bincount(slot, minlength=len(total))
        owner = np.repeat(np.arange(len(sizes)), parts)
        place = np.arange(len(total)) - offset[owner]
        name = mix((scheme[owner].astype(np.uint64) << np.uint64(40)) + place.astype(np.uint64))
        some = np.flatnonzero(filled)
        out_rows.append(owner[some])
        out_keys.append(mix(total[some] + name[some]))
        weak = use & (np.bincount(owner[some], minlength=len(sizes)) <= differ)
        for r in np.flatnonzero(weak):
            n = int(sizes[r])
            prefix = hashes[ends[r] - n : ends[r] - n + n - (n * percent + 99) // 100 + 1]
            out_rows.append(np.full(len(prefix), r))
            out_keys.append(mix(prefix ^ mix(np.uint64([int(scheme[r]) + (1 << 50)]))))
        step += 1
    if not out_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    row, key = np.concatenate(out_rows), np.concatenate(out_keys) >> np.uint64(64 - KEY_BITS)
    order = np.argsort(row, kind="stable")
    return row[order], key[order]


def _node_scan(width: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                rows, hashes, sizes = shingle_sets(chunk, width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(chunk.first, chunk.rows), pa.array(sizes), pa.array(_set_ids(rows, hashes, sizes).view(np.int64))],
                    names=["doc_id", "n_shingles", "node"],
                )

    return scan


def _unseen(node: np.ndarray, seen: set[int]) -> np.ndarray:
    """Places of the nodes that a task meets for the first time."""
    fresh = []
    for k, value in enumerate(node.tolist()):
        if value not in seen:
            seen.add(value)
            fresh.append(k)
    return np.array(fresh, np.int64)


def _key_scan(width: int, percent: int):
    """Keys of every node, once a task."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                rows, hashes, sizes = shingle_sets(chunk, width)
                node = _set_ids(rows, hashes, sizes)
                fresh = np.zeros(chunk.rows, bool)
                fresh[_unseen(node, seen)] = True
                own = fresh[rows]
                key_rows, keys = band_keys(rows[own], hashes[own], np.where(fresh, sizes, 0), percent)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[key_rows].view(np.int64)), pa.array(keys.view(np.int64))], names=["node", "key"]
                )

    return scan


def _sieved_sets(width: int, sieve):
    """Sorted arrays of the documents whose id passes the sieve, each node once a task."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sieve.value, np.uint64)
        seen: set[int] = set()
        for batch in batches:
            place = batch.column("place").to_numpy()
            passed = (bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0
            batch = batch.filter(pa.array(passed))
            for chunk in chunks(batch.column("text")):
                rows, hashes, sizes = shingle_sets(chunk, width)
                node, ends = _set_ids(rows, hashes, sizes), np.concatenate([[0], np.cumsum(sizes)])
                fresh = _unseen(node, seen)
                raw = [hashes[ends[k] : ends[k + 1]].tobytes() for k in fresh]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[fresh].view(np.int64)), pa.array(sizes[fresh]), pa.array(raw, pa.binary()),
                     pa.array([bitmap(np.frombuffer(r, np.uint64)).tobytes() for r in raw], pa.binary())],
                    names=["node", "size", "hashes", "bits"],
                )

    return scan


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Hashed bitmap whose width follows the size; the half of it is the bitmap of half the width."""
    width = LEAST_BITS
    while width < min(BITS_PER_SHINGLE * len(hashes), MOST_BITS):
        width *= 2
    bits = np.zeros(width, np.uint8)
    bits[(hashes >> np.uint64(64 - width.bit_length() + 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The same sets' bitmaps (one or a table of them) with fewer words: neighbouring bits are joined."""
    while bits.shape[-1] > words:
        one = np.unpackbits(np.ascontiguousarray(bits).view(np.uint8), axis=-1, bitorder="little")
        bits = np.packbits(one[..., 0::2] | one[..., 1::2], axis=-1, bitorder="little").view(np.uint64)
    return bits


def _maps(bits: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bitmaps of a column one after another, with the start and the number of words of each."""
    column = bits.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    words = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].copy().view(np.uint64)
    return words, (offsets[:-1] - offsets[0]) // 8, np.diff(offsets) // 8


def differing_bits(maps: tuple[np.ndarray, np.ndarray, np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bits in which the bitmaps of each pair differ, at the width of the narrower one."""
    words, start, width = maps
    out = np.zeros(len(left), np.int64)
    shapes = width[left] * 4096 + width[right]
    for shape in np.unique(shapes):
        own = np.flatnonzero(shapes == shape)
        w, v = divmod(int(shape), 4096)
        step = max(1, 1 << 18 >> max(w, v).bit_length())  # some 2 MB at a time, 16 where they are folded
        for k in range(0, len(own), step):
            part = own[k : k + step]
            x = words[start[left[part]][:, None] + np.arange(w)]
            y = words[start[right[part]][:, None] + np.arange(v)]
            x, y = folded(x, min(w, v)), folded(y, min(w, v))
            out[part] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return out


def _owned(key: np.ndarray, firsts: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether no key that both sides name among their first ones comes before the pair's own key."""
    own = np.ones(len(left), bool)
    before = np.ones(len(left), bool)
    for k in range(firsts.shape[1]):
        mine = firsts[left, k]
        before &= mine != key[left]
        for j in range(firsts.shape[1]):
            own &= ~(before & (mine == firsts[right, j]) & (mine != 0))
    return own


def tile_survivors(tile, key, node, size, component, block, firsts, maps, percent: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of one tile and different components that pass the bound, each from one tile.

    For each giving node the ``most`` closest are given; the third array tells
    whether there are more. The node of the component that has fewer rows in the tile gives. Rows stand by tile and node.
    """
    n = len(tile)
    order = np.lexsort((component, tile))
    cut = np.ones(n, bool)
    cut[1:] = (tile[order][1:] != tile[order][:-1]) | (component[order][1:] != component[order][:-1])
    at = np.flatnonzero(cut)
    rows_of = np.diff(np.append(at, n))
    share = np.empty(n, np.int64)
    share[order] = np.repeat(rows_of, rows_of)
    ends = np.searchsorted(tile, tile, "right")
    later = ends - np.arange(n) - 1
    crossing = np.zeros(n, bool)  # a tile of two blocks: only pairs between them
    cuts = np.flatnonzero(np.diff(tile, prepend=tile[0] - 1))
    crossing = np.repeat(np.minimum.reduceat(block, cuts) != np.maximum.reduceat(block, cuts), np.diff(np.append(cuts, n)))
    found: list[tuple[np.ndarray, ...]] = []
    sums = np.cumsum(later)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(sums, (sums[first - 1] if first else 0) + (1 << 18), "right")))
        count = later[first:last]
        left = np.repeat(np.arange(first, last), count)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        first = last
        ok = (component[left] != component[right]) & (~crossing[left] | (block[left] != block[right])) & (node[left] != node[right])
        ok &= np.minimum(size[left], size[right]) * 100 >= percent * np.maximum(size[left], size[right])
        left, right = left[ok], right[ok]
        ok = _owned(key, firsts, left, right)
        left, right = left[ok], right[ok]
        swap = share[right] < share[left]
        left, right = np.where(swap, right, left), np.where(swap, left, right)
        # The same pair may stand in many tiles.
        order = np.lexsort((node[right], node[left]))
        left, right = left[order], right[order]
        new = np.ones(len(left), bool)
        new[1:] = (node[left][1:] != node[left][:-1]) | (node[right][1:] != node[right][:-1])
        left, right = left[new], right[new]
        differ, total = differing_bits(maps, left, right), size[left] + size[right]
        good = (100 + percent) * ((total - differ) // 2) >= percent * total
        found.append((node[left[good]], node[right[good]], (differ / np.maximum(total, 1))[good]))
    a, b, share = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((b, share, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b = a[new], b[new]
    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(a)))
    rank = np.arange(len(a)) - np.repeat(starts, sizes)
    keep = rank < most
    return a[keep], b[keep], np.repeat(sizes > most, sizes)[keep]


def _tile_pairs(percent: int, most: int):
    """Rows come sorted by tile; a tile may go on in the next batch."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def flush(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            names = ("tile", "key", "node", "size", "component", "block")
            bits = table.column("bits").combine_chunks() if table.column("bits").num_chunks != 1 else table.column("bits").chunk(0)
            firsts = np.column_stack([table.column(f"first{k}").to_numpy() for k in range(FIRST_KEYS)])
            columns = tile_survivors(*(table.column(k).to_numpy() for k in names), firsts, _maps(bits), percent, most)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["a", "b", "more"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, table]) if rest is not None else table
            tiles = rest.column("tile").to_numpy()
            last = int(np.searchsorted(tiles, tiles[-1])) if len(tiles) else 0
            if last:
                yield flush(rest.slice(0, last))
                rest = rest.slice(last)
        if rest is not None and rest.num_rows:
            yield flush(rest)

    return scan


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, links) of every pair by intersection of the sorted arrays, as a written table."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok, pa.bool_())], names=["a", "b", "links"])

    # A node with many pairs sends its array once for each slice of them; the other side's goes there with the pair.
    table = written(pairs)
    ends = table.select(F.col("a").alias("node")).unionAll(table.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    turned = written(
        table.join(degree.select(F.col("node").alias("a"), F.col("n").alias("of_a")), "a")
        .join(degree.select(F.col("node").alias("b"), F.col("n").alias("of_b")), "b")
        .select(
            F.when(F.col("of_a") > F.col("of_b"), F.col("a")).otherwise(F.col("b")).alias("hub"),
            F.when(F.col("of_a") > F.col("of_b"), F.col("b")).otherwise(F.col("a")).alias("other"),
            F.ceil(F.greatest("of_a", "of_b") / SLICE).alias("slices"),
        ).select("hub", "other", F.pmod(F.xxhash64("other"), "slices").alias("slice"))
    )
    discard(table)
    hubs = written(turned.select("hub", "slice").distinct())
    left = sets.select(F.col("node").alias("other"), F.col("hashes").alias("x")).join(_sent(turned), "other")
    right = sets.select(F.col("node").alias("hub"), F.col("hashes").alias("y")).join(_sent(hubs), "hub")
    met = left.join(right, ["hub", "slice"]).select(F.least("hub", "other").alias("a"), F.greatest("hub", "other").alias("b"), "x", "y")
    found = written(met.mapInArrow(check, "a long, b long, links boolean"))
    discard(turned), discard(hubs)
    return found


def _sent(ids: DataFrame) -> DataFrame:
    """A written table of ids, sent to all tasks if its counted rows are at most ``SENT``."""
    return F.broadcast(ids) if ids.count() <= SENT else ids


def _sieve(ids: DataFrame, n: int):
    """A bitmap that every one of the ``n`` candidate ids passes, and few others; at most MOST_SIEVE / 64 numbers reach the driver."""
    size = min(max(SIEVE, 1 << (SIEVE_BITS * n).bit_length()), MOST_SIEVE)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(size))
    found = (
        ids.select(place.alias("place")).select(
            F.shiftright("place", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit")
        ).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    ).toPandas()
    bits = np.zeros(size // 64, np.int64)
    bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return ids.sparkSession.sparkContext.broadcast(bits.tobytes()), place


def linked(docs: DataFrame, width: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """((doc_id, n_shingles, node) of every document, (node, component) of every node that shares a key)."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(ids.mapInArrow(_node_scan(width), "doc_id long, n_shingles long, node long"))
    nodes = rows.where("n_shingles > 0")
    shared = written(_shared_keys(ids.select("text").mapInArrow(_key_scan(width, percent), "node long, key long")))
    known = written(shared.select("node").distinct())
    sets, behind = _known_sets(ids, nodes, known, width)
    parts, tested = written(known.withColumn("component", F.col("node"))), None
    while True:
        labelled = written(shared.join(parts, "node"))
        now = _verified(_untried(_hub_pairs(labelled), tested), sets, percent)
        discard(labelled)
        parts = _merged(parts, now)
        found = now.agg(F.count(F.lit(1)).alias("n"), F.count_if("links").alias("links")).first()
        tested = _grown(tested, now)
        if found["links"] <= WORTH * found["n"]:
            break
    most, pending = FIRST, None
    while True:
        labelled = every = written(shared.join(parts, "node"))
        if pending is not None:
            labelled = labelled.join(labelled.join(pending, "node").select("key").distinct(), "key", "left_semi")
        found = written(_tiles(labelled, sets, percent, most))
        discard(every)
        pairs = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        now = _verified(_untried(pairs, tested), sets, percent)
        parts = _merged(parts, now)
        tested = _grown(tested, now)
        pending = written(found.where("more").select(F.col("a").alias("node")).distinct())
        discard(found)
        if pending.isEmpty():
            break
        most *= MORE
    for table in [shared, known, tested, *behind]:
        discard(table)
    return rows, parts


def _shared_keys(keys: DataFrame) -> DataFrame:
    """(node, key, weight) of the keys that several nodes have; ``weight`` keys with the same nodes are one, the smallest.

    A key that only one node has, however many copies of it there are, finds nothing.
    """
    by_key = Window.partitionBy("key")
    shared = (
        keys.withColumn("low", F.min("node").over(by_key)).withColumn("high", F.max("node").over(by_key))
        .where("low <> high").select("node", "key").distinct()
        .withColumn("members", F.count(F.lit(1)).over(by_key)).withColumn("who", F.bit_xor(F.xxhash64("node")).over(by_key))
        .withColumn("who_else", F.bit_xor(F.xxhash64("node", F.lit(1))).over(by_key))
    )
    return (
        shared.groupBy("node", "members", "who", "who_else").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("weight"))
        .select("node", "key", "weight")
    )


def _known_sets(ids: DataFrame, nodes: DataFrame, known: DataFrame, width: int) -> tuple[DataFrame, list[DataFrame]]:
    """(node, size, hashes, bits) of every known node, and the written tables behind it.

    The arrays are written by the scan of one document of each node; they are not shuffled. Sets of other nodes that pass
    the sieve by chance meet no pair. A node that came twice is left out where it is read.
    """
    one = nodes.join(known, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    sieve, place = _sieve(one, known.count())
    found = written(
        ids.withColumn("place", place).select("text", "place")
        .mapInArrow(_sieved_sets(width, sieve), "node long, size long, hashes binary, bits binary")
        .withColumn("at", F.monotonically_increasing_id())
    )
    first = F.min("at").over(Window.partitionBy("node"))
    spare = written(found.select("node", "at").withColumn("first", first).where("at <> first").select("at"))
    n = spare.count()
    if n > SENT:
        single = written(found.dropDuplicates(["node"]))
        discard(found), discard(spare)
        return single.drop("at"), [single]
    return (found.join(F.broadcast(spare), "at", "left_anti") if n else found).drop("at"), [found, spare]


def _merged(parts: DataFrame, now: DataFrame) -> DataFrame:
    """``parts`` after the links among ``now``: only components that a new link joins change."""
    ends = now.where("links").join(parts.select(F.col("node").alias("a"), F.col("component").alias("u")), "a").join(
        parts.select(F.col("node").alias("b"), F.col("component").alias("v")), "b")
    joined = connected_components(ends.where("u <> v").select("u", "v"), "u", "v").select(
        F.col("node").alias("old"), F.col("component").alias("new"))
    after = written(parts.join(joined, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component")))
    discard(parts)
    return after


def _grown(tested: DataFrame | None, now: DataFrame) -> DataFrame:
    """``tested`` and ``now`` as one table; what they were is deleted."""
    if tested is None:
        return now
    both = written(tested.unionByName(now))
    discard(tested), discard(now)
    return both


def _untried(pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
    return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")


def _hub_pairs(labelled: DataFrame) -> DataFrame:
    """(a, b): every node with the hub of another component that it shares most keys with.

    The hub of a key is its smallest node of its smallest component.
    """
    hubs = labelled.groupBy("key").agg(F.min(F.struct("component", "node")).alias("hub"))
    return (
        labelled.join(hubs, "key").where("component <> hub.component")
        .groupBy("node", F.col("hub.node").alias("hub")).agg(F.sum("weight").alias("n"))
        .groupBy("node").agg(F.max_by("hub", F.struct("n", "hub")).alias("hub"))
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    )


def _tiles(labelled: DataFrame, sets: DataFrame, percent: int, most: int) -> DataFrame:
    """Pairs to intersect next, from keys that hold more than one component."""
    open_keys = (
        labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members"))
        .where("low <> high").select("key", "members", F.ceil(F.col("members") / TILE).cast("int").alias("blocks"))
    )
    own = F.pmod(F.hash("node"), "blocks")
    open_rows = labelled.join(open_keys, "key")
    first = F.slice(F.array_sort(F.collect_list(F.struct("members", "key"))), 1, FIRST_KEYS)["key"]
    firsts = open_rows.groupBy("node").agg(first.alias("firsts")).select(
        "node", *[F.coalesce(F.try_element_at("firsts", F.lit(k + 1)), F.lit(0)).alias(f"first{k}") for k in range(FIRST_KEYS)]
    )
    laid = (
        open_rows.withColumn("block", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("tile", F.xxhash64("key", F.least("block", "with"), F.greatest("block", "with")))
        .select("tile", "key", "node", "component", "block")
    )
    known = sets.select("node", "size", "bits").join(firsts, "node")
    names = [f"first{k}" for k in range(FIRST_KEYS)]
    return (
        laid.join(known, "node").select("tile", "key", "node", "size", "component", "block", *names, "bits")
        .repartition("tile").sortWithinPartitions("tile", "node")
        .mapInArrow(_tile_pairs(percent, most), "a long, b long, more boolean")
    )


def components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document: the smallest doc_id that links reach."""
    rows, parts = linked(docs, width, percent)
    labelled = rows.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    some = labelled.where("n_shingles > 0")
    least = some.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("members")).where("members > 1")
    return labelled.join(least.withColumnRenamed("component", "c"), (F.col("component") == F.col("c")) & (F.col("n_shingles") > 0), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
