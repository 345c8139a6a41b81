"""Every operator and stage on tables of only null and empty texts, each task in a new worker."""

import os
import subprocess
import sys

import numpy as np

from taxaweave.llm import ftrl, line_rules, ngram_join, scan, stripes, text_statistics
from taxaweave.llm.scan import chunks
from tests.llm.cases import column

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import corpus_pipeline
from taxaweave.session import build_session
from taxaweave.llm import queries
folder = {folder!r}
spark = build_session(master="local[2]", **{{
    "spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.python.worker.reuse": "false", "spark.checkpoint.dir": folder + "/steps"}})
spark.sparkContext.setLogLevel("ERROR")
docs = spark.createDataFrame([(1, None, "en", "a", 0), (2, "", None, None, 0), (3, None, "en", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long")
docs.write.parquet(folder + "/documents.parquet")
spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(folder + "/labels.parquet")
for name in {names!r}:
    rows = queries.QUERIES[name](spark, folder).collect()
    print("ROWS", name, len(rows))
for name, stage in corpus_pipeline.STAGES:
    print("ROWS", name, len(stage(spark, docs, folder).collect()))
"""

NAMES = [
    "op1_packing", "op2_quality_rules", "op3_secrets", "op5_languages", "op6_hash_tree", "op7_ngram_jaccard", "op8_line_rules",
    "op9_token_counts", "op10_mixing", "op12_stripes", "op13_toxicity",
]


def test_only_null_texts(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT, folder=str(tmp_path), names=NAMES)], capture_output=True, text=True, timeout=900, check=False)
    rows = dict(line.split()[1:] for line in done.stdout.splitlines() if line.startswith("ROWS"))
    want = dict.fromkeys(NAMES, "3") | {"op12_stripes": "0", "quality_rules": "0", "ngram_jaccard": "3", "secret_scan": "3", "packing": "3"}
    assert done.returncode == 0, done.stderr[-3000:]
    assert {k: v for k, v in rows.items() if k != "mixing"} == want and "mixing" in rows


def test_first_chunk_without_text():
    """Also after one text so long that its tables are not kept."""
    functions = [
        line_rules.scan_chunk, lambda c: ngram_join.shingle_sets(c, 5), text_statistics.chunk_statistics, ftrl.text_features, stripes.phrase_words]
    for function in functions:
        for texts in ([None, ""], ["a" * (scan.CHUNK + 5000), None]):
            sys.modules.pop("taxaweave_worker_cache", None)
            for chunk in chunks(column(texts)):
                function(chunk)
    assert isinstance(scan._powers(0)[0], np.ndarray)
