"""Rule ensemble, language identification, sharding and mixing against plain versions in Python."""

import math
import random
import unicodedata

import numpy as np
import xxhash
import zstandard
from pyspark.sql import functions as F

from taxaweave.llm import hnsw, languages, mixing, queries, rule_ensemble, shards, text_statistics
from tests.llm.cases import odd, odd_rows, prose


def test_rules_are_evaluated_as_written(spark):
    draw = random.Random(3)
    rows = [(k, prose(k, 60) if k % 3 else " ".join(w + draw.choice(["$$", "!", "|"]) for w in prose(k, 40).split()), int(k % 3 > 0)) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    table = text_statistics.statistics(docs.unionByName(odd(spark).select("doc_id", "text", F.lit(1).alias("quality"))).drop("quality"))
    model = rule_ensemble.fit(table.join(docs.select("doc_id", "quality"), "doc_id"), "quality")
    assert model.weights
    for r in table.withColumn("score", model.score()).collect():
        total = model.intercept
        for rule, weight in model.weights.items():
            total += weight * all(r[name] > t if above else r[name] <= t for name, above, t in rule)
        assert abs(r["score"] - 1 / (1 + math.exp(-total))) < 1e-9


def test_statistics_of_words(spark):
    texts = ["The the cat. 3x 4 ||| A| b$", "", "one", "Up UP up! up?\nup", prose(5, 200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in text_statistics.statistics(docs).collect():
        words = texts[r.doc_id].split()
        n = max(len(words), 1)
        assert r.log_words == math.log1p(len(words))
        assert abs(r.word_length - sum(map(len, words)) / n) < 1e-9
        assert abs(r.digit_words - sum(any(c.isdigit() for c in w) for w in words) / n) < 1e-9
        assert abs(r.bar_words - sum("|" in w for w in words) / n) < 1e-9
        assert abs(r.short_words - sum(len(w) <= 3 for w in words) / n) < 1e-9


def test_languages_by_plain_compression(spark):
    rows = [(k, prose(k, 50), "en") for k in range(60)] + [(100 + k, " ".join(random.Random(k).choices("che una per non con del zione".split(), k=50)), "it") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    dictionaries = languages.learn(docs)
    for r in languages.identify(docs, dictionaries).collect():
        text = next(t for k, t, _ in rows if k == r.doc_id)
        data = b" ".join("".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower()).encode().split())
        sizes = {}
        for lang, content in dictionaries.items():
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=languages.LEVEL)
            coder = zstandard.ZstdCompressor(level=languages.LEVEL, dict_data=own, write_content_size=False, write_dict_id=False)
            sizes[lang] = sum(len(coder.compress(data[k : k + languages.PIECE])) for k in range(0, len(data), languages.PIECE))
        assert r.lang_pred == min(sizes, key=lambda x: (sizes[x], x))
        low, high = sorted(sizes.values())
        assert abs(r.score - 1 / (1 + math.exp(-(high - low) / (1 + 0.01 * low)))) < 1e-9


def test_letters_are_those_of_unicode(spark):
    texts = ["½ ② ² Ⅷ", "1234 _ -", "ʰ", "ª", "中", "é", "٣", "𝔸", "ⓐ"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.lang_pred for r in languages.identify(docs, {"en": b"the of and to in", "it": b"che una per non"}).collect()}
    for k, text in enumerate(texts):
        letter = any(unicodedata.category(c).startswith("L") for c in text)
        assert (found[k] == "und") == (not letter), text
    learned = spark.createDataFrame([(k, t, "x") for k, t in enumerate(["½ ②", "Ⅷ"])], "doc_id long, text string, lang string")
    assert languages.learn(learned) == {}


def test_missing_ids_are_not_held_out(spark):
    rows = spark.createDataFrame([(None,), (5,)], "doc_id long").select(queries.held_out(5, 0).alias("a"), queries.held_out(4, 2).alias("b")).collect()
    assert all(x is not None for r in rows for x in r) and not rows[0].a and not rows[0].b


def plain_draw(key: str, name: str, weight: float) -> float:
    one = xxhash.xxh64_intdigest(key.encode(), seed=42)
    both = xxhash.xxh64_intdigest(name.encode(), seed=one)
    return -math.log(((both >> 12) + 1) / 2**52) / weight


def test_shards_by_plain_descent(spark):
    leaves = shards.tree(9)
    tree = {}
    for s in leaves:
        tree.setdefault(s.region, {}).setdefault(f"{s.region}/{s.rack}", {})[f"{s.region}/{s.rack}/{s.number}"] = s
    weight = lambda x: sum(map(weight, x.values())) if isinstance(x, dict) else x.weight

    def descend(key, node):
        while isinstance(node, dict):
            node = node[min(node, key=lambda name: plain_draw(key, name, weight(node[name])))]  # noqa: B023
        return node.number

    found = spark.range(500).select("id", shards.shard_of(F.col("id"), leaves).alias("shard")).collect()
    assert all(r.shard == descend(str(r.id), tree) for r in found)


def test_rates_by_plain_projected_gradient(spark):
    draw = np.random.default_rng(4)
    p, tokens = draw.dirichlet([0.4, 0.4, 0.2], 300), draw.integers(0, 400, 300).astype(float)
    members = spark.createDataFrame([(k, int(t), x.tolist()) for k, (t, x) in enumerate(zip(tokens, p, strict=True))], "doc_id long, tokens long, posterior array<double>")
    targets, rate = np.array([0.6, 0.3, 0.1]), np.ones(300)
    for _ in range(mixing.ROUNDS):
        misfit = (tokens * rate) @ p / tokens.sum() - targets
        if np.abs(misfit).max() < mixing.ENOUGH:
            break
        live = tokens * (rate > 0)
        gram = (p * live[:, None]).T @ p / tokens.sum()
        rate = np.maximum(rate - p @ (mixing.STEP * np.linalg.pinv(gram + 1e-9 * np.eye(3), rcond=1e-6) @ misfit), 0)
    got = np.array([r.rate for r in mixing.rates(members, targets)[0].orderBy("doc_id").collect()])
    assert np.abs(got - rate).max() < 1e-6


def test_unnamed_domain_keeps_its_column(spark):
    rows = [(k, prose(k, 60) if k % 3 else prose(k, 60).upper(), int(k % 3 > 0), 0) for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    got = mixing.mix(docs.select("doc_id", "text"), docs.select("doc_id", "quality", "toxic"), queries.domain(), {"clean": 0.9, "toxic": 0.05, "junk": 0.05})
    assert [c for c in got.columns if c.startswith("p_")] == ["p_clean", "p_toxic", "p_junk"]
    rows = got.collect()
    total = sum(r.tokens for r in rows)
    assert all(r.p_toxic == 0 for r in rows)
    assert abs(sum(r.tokens * r.rate * r.p_clean for r in rows) / total - 0.9) < 1e-3
    assert abs(sum(r.tokens * r.rate for r in rows) / total - 0.95) < 1e-3


def test_smallest_vector_of_an_id_counts(spark):
    rows = [(0, [2.0, 1.0]), (0, [1.0, 5.0]), (20, [1.0, 0.0]), (21, [0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for table in (vectors, vectors.orderBy(F.desc("vec_id")).repartition(3)):
        found = {(r.query_id, r.vec_id): r.score for r in hnsw.nearest(table, 5, 20).collect()}
        assert found[0, 20] == 1.0 and found[0, 21] == 5.0 and found[20, 0] == 1.0


def test_stages_with_repeated_ids(spark, tmp_path):
    from taxaweave.llm import stages

    a, b = prose(1, 120), prose(2, 120)
    rows = [(1, a, "s"), (1, b, "s"), (2, a, "s"), (None, a, "s"), (1, a, "s"), (3, "short", "s"), (3, prose(4, 120), "s"), (None, prose(5, 120), "s")]
    docs = spark.createDataFrame([(k, t, "en", s, 1) for k, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path)
    kept = stages.quality_rules(spark, docs, folder)
    assert kept.count() == 7 and kept.where("text = 'short'").count() == 0
    single = stages.near_duplicates(spark, kept, folder)
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in single.collect()) == sorted(
        (k is None, k, t) for k, t in [(1, a), (1, b), (3, prose(4, 120)), (None, prose(5, 120))])
    docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).where("doc_id is not null").distinct().write.parquet(f"{folder}/labels.parquet")
    assert stages.mixing(spark, single, folder).columns == docs.columns
    for name in ("quality_rules", "near_duplicates", "secret_scan", "packing"):
        assert getattr(stages, name)(spark, odd(spark).select(*docs.columns), folder).count() <= len(odd_rows()) + 70
        assert getattr(stages, name)(spark, docs.limit(0), folder).count() == 0
