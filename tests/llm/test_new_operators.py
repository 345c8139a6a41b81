"""Dimension-sharded Lloyd, stripes and FTRL against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from taxaweave.llm import block_lloyd, ftrl, stripes
from taxaweave.llm.scan import chunks
from tests.llm.cases import column, none, odd, odd_rows, prose

VECTORS = "vec_id long, embedding array<float>, cluster int, rows long"


def plain_lloyd(rows, clusters, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    centroids = [list(v) for _, v in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for k in range(len(centroids)):
            rows_ = [v for (_, v), (_, c) in zip(kept, own, strict=True) if c == k]
            if rows_:
                centroids[k] = [sum(x) // len(rows_) for x in zip(*rows_, strict=True)]
    own = assign()
    inertia = Counter()
    for d, k in own:
        inertia[k] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, k, d, inertia[k], sum(inertia.values()), sha[k]) for (i, _), (d, k) in zip(kept, own, strict=True))


def test_lloyd(spark):
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(300, 20)).astype(np.float32)
    vectors[50:90] = vectors[50]
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(900, None), (901, []), (902, [float("nan")] * 20), (903, [None] * 20), (904, [1.0] * 3), (905, [float("inf")] * 20), rows[3], (None, rows[4][1]), (7, rows[8][1])]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], VECTORS)
    found = block_lloyd.cluster(table.repartition(5), 9, 4, 20).collect()
    got = Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in found)
    assert got == plain_lloyd(rows, 9, 4, 20)
    few = table.where("vec_id in (1, 2)")
    assert {(r.vec_id, r.distance) for r in block_lloyd.cluster(few, 9, 2, 20).collect()} == {(1, 0), (2, 0)}
    assert block_lloyd.cluster(table.where("vec_id >= 900"), 9, 2, 20).count() == 0
    assert block_lloyd.cluster(table.limit(0), 9, 2, 20).count() == 0
    with pytest.raises(Exception, match="larger than"):
        block_lloyd.cluster(spark.createDataFrame([(1, [1e30] * 20, 1, 1)], VECTORS), 9, 2, 20).collect()


def plain_collocations(rows, least, longest, shown):
    counts, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = set()
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in good.items():
            inside = lambda q, p=p: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= 100 * a and inside(q) for q, b in good.items()):
                continue
            score, _, left, right = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), " ".join(p), left, right))
        for rank, (score, a, _, text, left, right) in enumerate(sorted(rows_)[:shown]):
            out.add((lang, rank + 1, text, -a, left, right, total[lang], -score))
    return out


def shown(df):
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


@pytest.mark.parametrize("small", [False, True])
def test_collocations(spark, monkeypatch, small):
    if small:  # many flushes, and every prefix in slices
        monkeypatch.setattr(stripes, "HELD", 50)
        monkeypatch.setattr(stripes, "HEAVY", 10**9)
        monkeypatch.setattr(stripes, "FEWEST_BITS", 64)
    draw = random.Random(1)
    words = ["a", "b", "Cc", "dé", "the", "of", "x y", "🙂"]
    texts = [draw.choice([" ", "  ", "\t"]).join(
        draw.choice(words) + draw.choice(["", "", "", "", ",", ". ", "\n", "\r\n", "\x0b", ":", "!?"]) for _ in range(draw.randint(0, 40))) for _ in range(120)]
    texts += ["a a a a a a", "the of the of the of Cc", None, "", " ,;\n", texts[0], texts[0]]
    rows = [(k, t, draw.choice(["en", "de", None]), 1, 2) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n int, rank int")
    for least, top in ((2, 2000), (5, 7)):
        found = stripes.collocations(docs.repartition(3), least, 5, top)
        assert shown(found) == plain_collocations([(r[1], r[2]) for r in rows], least, 5, top)


def test_collocation_rows(spark):
    rows = [(r[1], r[2]) for r in odd_rows()]
    assert shown(stripes.collocations(odd(spark), 2, 3, 50)) == plain_collocations(rows, 2, 3, 50)
    assert stripes.collocations(none(spark), 2).count() == 0
    assert stripes.collocations(odd(spark).where("doc_id < 2"), 1).count() == 0
    huge = spark.createDataFrame([("a b", "x")] * 3, "text string, lang string")
    assert shown(stripes.collocations(huge, 3)) == {("x", 1, "a b", 3, 3, 3, 6, 2000)}


def made_labels(seed, n):
    draw, rows = random.Random(seed), []
    for k in range(n):
        toxic = int(draw.random() < 0.2)
        text = prose(k, draw.randint(5, 60)) + (" " + draw.choice(["You UGLYWORD!", "such meanword", "uglyword"]) if toxic else "")
        rows.append((k, text, toxic, "x", 1.0))
    return rows


def test_ftrl_learns(spark):
    docs = spark.createDataFrame(made_labels(1, 600), "doc_id long, text string, toxic int, held string, score double")
    model = ftrl.learn(docs, docs.where("doc_id < 400").select("doc_id", "toxic"), "toxic")
    assert 0 < len(model.hashes) < 60
    found = {r.doc_id: r.score for r in ftrl.score(docs, model).collect()}
    rest = docs.where("doc_id >= 400").collect()
    assert all(found[r.doc_id] >= 0.3 for r in rest if r.toxic)
    # A word that four of some eighty toxic texts hold by chance may mark a clean one.
    assert sum(found[r.doc_id] >= 0.3 for r in rest if not r.toxic) <= 3
    again = ftrl.learn(docs.repartition(7), docs.where("doc_id < 400").select("doc_id", "toxic").repartition(3), "toxic")
    assert np.array_equal(model.hashes, again.hashes) and np.array_equal(model.points, again.points)
    rest = ftrl.score(odd(spark), model).collect()
    assert len(rest) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rest)
    assert ftrl.score(none(spark), model).count() == 0
    one = ftrl.learn(docs, docs.where("toxic = 0").select("doc_id", "toxic"), "toxic")
    assert ftrl.score(docs, one).agg({"score": "max"}).first()[0] < 1e-3
    nothing = ftrl.learn(none(spark), docs.select("doc_id", "toxic"), "toxic")
    assert all(abs(r.score - 0.5) < 1e-6 for r in ftrl.score(odd(spark), nothing).collect())


def test_ftrl_rounds_equal_plain_ones(spark):
    """The same batches one after another, feature by feature, in plain Python."""
    docs = spark.createDataFrame(made_labels(2, 300), "doc_id long, text string, toxic int, held string, score double")
    model = ftrl.learn(docs, docs.select("doc_id", "toxic"), "toxic")
    rows = [(r.text, r.label, r.batch) for r in ftrl._taught(docs, docs.select("doc_id", "toxic"), "toxic", 1000).collect()]
    share = sum(label for _, label, _ in rows) / len(rows)
    held, toxic, own = Counter(), Counter(), []
    for text, label, batch in rows:
        chunk = next(chunks(column([text])))
        features = set(ftrl.text_features(chunk)[1].tolist())
        own.append((features, label, batch))
        held.update(features)
        toxic.update(features if label else ())
    live = {f for f, n in held.items() if toxic[f] >= ftrl.LEAST and abs(toxic[f] - n * share) / math.sqrt(n) > ftrl.SCREEN * ftrl.L1}
    z, n = dict.fromkeys(live, 0.0), dict.fromkeys(live, 0.0)
    start = math.log((share + 1e-6) / (1 - share + 1e-6))

    def weight(f):
        if abs(z[f]) <= ftrl.L1:
            return 0.0
        return -(z[f] - math.copysign(ftrl.L1, z[f])) / ((ftrl.BETA + math.sqrt(n[f])) / ftrl.ALPHA + ftrl.L2)

    for _ in range(ftrl.PASSES):
        for batch in range(ftrl.BATCHES):
            w = {f: weight(f) for f in live}
            g, s = Counter(), Counter()
            for features, label, at in own:
                if at == batch:
                    margin = start + sum(w[f] / math.sqrt(held[f]) for f in features & live)
                    error = 1 / (1 + math.exp(-margin)) - label
                    for f in features & live:
                        g[f] += error / math.sqrt(held[f])
                        s[f] += error * error / held[f]
            for f in live:
                z[f] += g[f] - (math.sqrt(n[f] + s[f]) - math.sqrt(n[f])) / ftrl.ALPHA * w[f]
                n[f] += s[f]
    want = {f: weight(f) / math.sqrt(held[f]) for f in live if weight(f)}
    got = dict(zip(model.hashes.tolist(), model.points.tolist(), strict=True))
    assert set(got) == set(want) and all(abs(got[f] - want[f]) < 1e-5 for f in got)


def test_features():
    chunk = next(chunks(column(["You ARE: bad", "bad", None, "Ünî x"])))
    rows, hashes = ftrl.text_features(chunk)
    assert Counter(rows.tolist()) == {0: 3 + 2 + 1, 1: 1, 3: 2 + 1}
    assert len(set(hashes.tolist())) == 9  # the word that two rows share is one feature


def test_words_are_decoded_together():
    import pyarrow as pa

    from taxaweave.llm import scan

    (chunk,) = scan.chunks(pa.array(["Über den Fluß", None, "OLD bolt \U0001f600x", ""]))
    starts, ends, _, _ = stripes.phrase_words(chunk)
    assert stripes._texts(chunk, starts, ends) == ["Über", "den", "fluß", "old", "bolt", "\U0001f600x"]
    assert stripes._texts(chunk, starts[:0], ends[:0]) == []
