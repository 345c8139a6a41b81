"""Packing, language identification, rule ensemble, mixing and the pipeline."""

import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from taxaweave.llm import languages, mixing, packing, queries, rule_ensemble, stages, text_statistics
from tests.llm.cases import WORDS, none, odd, odd_rows, prose

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SAMPLE = "/root/testdata/sf0.001"


def check_packing(rows, texts, width):
    """Pieces tile every document, sequences have no gaps, checksums are those of the library's identifiers."""
    library = Tokenizer.from_file(VOCABULARY)
    own, sequences = {}, {}
    for r in rows:
        own.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces, place = sorted(own[doc_id], key=lambda r: r.piece), 0
        for k, r in enumerate(pieces):
            assert (r.piece, r.start) == (k, place)
            assert r.ids_crc32 == zlib.crc32(ids[place : place + r.length].tobytes())
            place += r.length
        assert place == len(ids)
        assert len(pieces) == -(-len(ids) // width)
    for content in sequences.values():
        place = 0
        for offset, length in sorted(content):
            assert offset == place
            place += length
        assert place <= width
    return len(sequences)


def test_packing(spark):
    texts = {k: prose(k, random.Random(k).choice([0, 3, 20, 90, 300])) for k in range(300)} | {300: None, 301: "<|endoftext|> x"}
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in texts.items()], "doc_id long, text string, number int, part int")
    rows = packing.pack(docs.repartition(5), VOCABULARY, 256).collect()
    room = []  # of best-fit decreasing, which is no better
    for length in sorted((r.length for r in rows), reverse=True):
        fits = [k for k, left in enumerate(room) if left >= length]
        if fits:
            room[min(fits, key=room.__getitem__)] -= length
        else:
            room.append(256 - length)
    assert check_packing(rows, texts, 256) <= len(room)
    found = packing.pack(odd(spark), VOCABULARY).collect()
    assert sum(r.piece == 0 for r in found) == len(odd_rows())
    assert packing.pack(none(spark), VOCABULARY).count() == 0


def test_plan_is_whole_and_fullest():
    draw = random.Random(1)
    for _ in range(30):
        counts, width = {draw.randint(1, 40): draw.randint(1, 9) for _ in range(draw.randint(1, 8))}, 40
        left, lengths = dict(counts), sorted(counts, reverse=True)
        # The fullest bin that holds the longest piece, by trying all sums.
        reach = {lengths[0]}
        for n in lengths:
            for _ in range(left[n] - (n == lengths[0])):
                reach |= {x + n for x in reach if x + n <= width}
        assert sum(n * k for n, k in packing.fullest(left, lengths, width)) == max(reach)
        used = {}
        for times, content in packing.plan(counts, width):
            assert sum(n * k for n, k in content) <= width
            for n, k in content:
                used[n] = used.get(n, 0) + times * k
        assert used == counts


def test_languages(spark):
    other = "che una per non con del zione mente are ere il lo la di".split()
    draw = random.Random(2)
    speak = lambda words: " ".join("".join(draw.choices(words, k=draw.randint(1, 3))) for _ in range(60))
    rows = [(k, speak(WORDS if k % 2 else other), "en" if k % 2 else "it", "m", 1.0) for k in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, margin string, score double")
    dictionaries = languages.learn(docs.where("doc_id < 160"))
    assert sorted(dictionaries) == ["en", "it"]
    found = {r.doc_id: r for r in languages.identify(docs, dictionaries).collect()}
    assert np.mean([found[k].lang_pred == lang for k, _, lang, *_ in rows if k >= 160]) > 0.95
    assert all(0 <= r.score <= 1 for r in found.values())
    rest = {r.doc_id: r for r in languages.identify(odd(spark), dictionaries).collect()}
    assert all(rest[k].lang_pred == "und" and rest[k].score == 0 and not rest[k].reliable for k in (0, 1, 2, 4))
    assert rest[3].lang_pred in ("en", "it") and rest[5].lang_pred in ("en", "it")
    assert languages.learn(none(spark)) == {}
    assert {r.lang_pred for r in languages.identify(odd(spark), {}).collect()} == {"und"}
    assert languages.identify(none(spark), dictionaries).count() == 0


def test_rule_ensemble(spark):
    rows = [(k, prose(k, 80) if k % 3 else " ".join(w + "$$$" for w in prose(k, 80).split()), int(k % 3 > 0)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    table = text_statistics.statistics(docs).join(docs.select("doc_id", "quality"), "doc_id")
    model = rule_ensemble.fit(table.where("doc_id < 200"), "quality")
    assert model.weights
    for r in table.where("doc_id >= 200").select("quality", model.score().alias("score")).collect():
        assert (r.score >= 0.5) == (r.quality == 1)
    odd_scores = text_statistics.statistics(odd(spark)).select(model.score().alias("score")).collect()
    assert len(odd_scores) == len(odd_rows()) and all(0 <= r.score <= 1 for r in odd_scores)
    assert rule_ensemble.fit(table.where("quality = 1"), "quality").weights == {}
    assert abs(text_statistics.statistics(docs.limit(1)).select(rule_ensemble.fit(table.limit(0), "quality").score().alias("s")).first().s - 0.5) < 1e-3
    assert text_statistics.statistics(none(spark)).count() == 0


def test_mixing_reaches_targets(spark):
    draw = np.random.default_rng(1)
    p = draw.dirichlet([0.3, 0.3, 0.3], 800)
    tokens = draw.integers(0, 500, 800)
    members = spark.createDataFrame(
        [(k, int(t), x.tolist()) for k, (t, x) in enumerate(zip(tokens, p, strict=True))], "doc_id long, tokens long, posterior array<double>"
    )
    targets = np.array([0.7, 0.25, 0.05])
    rated, history = mixing.rates(members, targets)
    r = np.array([x.rate for x in rated.orderBy("doc_id").collect()])
    assert (r >= 0).all()
    assert np.abs((r * tokens) @ p / tokens.sum() - targets).max() < 1e-5
    assert np.abs(history[-1] - targets).max() <= np.abs(history[0] - targets).max()
    assert mixing.rates(members.limit(0), targets)[0].count() == 0


def test_mixing_rows(spark):
    rows = [(k, prose(k, 60) if k % 3 else prose(k, 60).upper(), int(k % 3 > 0), 0, "x") for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int, domain string")
    labels = docs.select("doc_id", "quality", "toxic")
    got = mixing.mix(docs.drop("quality", "toxic"), labels, queries.domain(), {"clean": 0.9, "junk": 0.1}).collect()
    total = sum(r.tokens for r in got)
    assert abs(sum(r.tokens * r.rate * r.p_clean for r in got) / total - 0.9) < 1e-3
    assert all(abs(r.copies - r.rate) <= 1 for r in got)
    found = mixing.mix(odd(spark), labels, queries.domain(), {"clean": 0.9, "junk": 0.1}).collect()
    assert len(found) == len(odd_rows())
    assert mixing.mix(odd(spark), labels.limit(0), queries.domain(), {"clean": 1.0}).count() == len(odd_rows())
    assert mixing.mix(none(spark), labels, queries.domain(), {"clean": 0.9, "junk": 0.1}).count() == 0


def test_pipeline_stages(spark, tmp_path):
    clean = [(k, prose(k, 120), "en", f"s{k % 3}", 1) for k in range(60)]
    copies = [(100 + k, clean[5][1], "en", "s1", 1) for k in range(5)]
    copies.append(copies[0])
    short, secret = (200, "too few words", "en", "s1", 1), (201, prose(999, 120) + " token = abcdefgh12345", "en", "s1", 1)
    docs = spark.createDataFrame([*clean, *copies, short, secret], "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    labels.write.parquet(f"{folder}/labels.parquet")
    kept = stages.quality_rules(spark, docs, folder)
    assert {r.doc_id for r in kept.collect()} == {k for k, *_ in clean + copies} | {201}
    single = stages.near_duplicates(spark, kept, folder)
    assert sorted(r.doc_id for r in single.collect()) == [*range(60), 201]
    masked = stages.secret_scan(spark, single, folder)
    hidden = masked.where("doc_id = 201").first()
    assert hidden.text.endswith(" [SECRET]") and hidden.n_chars == len(hidden.text)
    mixed = stages.mixing(spark, masked, folder)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} == {*range(60), 201}
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} == {*range(60), 201}
    twice = stages.near_duplicates(spark, docs.unionByName(docs.where("doc_id = 7")), folder)
    assert sorted(r.doc_id for r in twice.where("doc_id < 10").collect()) == list(range(10))
    assert stages.mixing(spark, docs.limit(0), folder).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard", "secret_scan", "mixing", "packing"]


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SAMPLE}/labels.parquet").select("doc_id", "quality")
    rows = queries.op2_quality_rules(spark, SAMPLE).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "lang")
    rows = queries.op5_languages(spark, SAMPLE).where("held_out").join(docs, "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.9
