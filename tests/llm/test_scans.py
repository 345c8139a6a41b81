"""Vectorised scans, token counts, line rules and secrets against plain versions."""

import hashlib
import random
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from taxaweave.llm import line_rules, packing, secret_spans, token_counts
from taxaweave.llm.scan import chunks
from tests.llm.cases import column, none, odd, odd_rows, prose

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def made_texts(letters: str, n: int, length: int, seed: int = 3) -> list:
    draw = random.Random(seed)
    return [None, "", *("".join(draw.choices(letters, k=draw.randint(0, length))) for _ in range(n))]


def plain_counts(text):
    text = text or ""
    words, seen, repeated = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for own in places.values() if len(own) > 1 for i in own for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in line_rules.SYMBOLS for c in text), repeated, len(covered)


@pytest.mark.parametrize("limit", [7, 300, 1 << 20])
def test_base_counts(limit):
    texts = made_texts("ab \n\té#🙂", 1500, 70) + [prose(k, 80) for k in range(30)]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for chunk in chunks(column(texts), limit):
        found = line_rules.scan_chunk(chunk)
        for k in range(chunk.rows):
            assert tuple(int(found[x][k]) for x in names) == plain_counts(texts[chunk.first + k])


def test_tokens_match_the_library():
    texts = made_texts("abst've'redl'll'm'd'S  \n\t İé1²Ⅷ_-<|>中文🙂", 3000, 60)
    texts += ["a<|endoftext|>b", "<|endoftext|><|endoftext|>", "x's", "'", "it'll", "'re", *(prose(k, 200) for k in range(20))]
    library = Tokenizer.from_file(VOCABULARY)
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    merges = token_counts.Merges(VOCABULARY)
    assert token_counts.text_counts(column(texts), merges, token_counts.Known()).tolist() == [len(x) for x in want]
    # A small memory is forgotten again and again.
    assert token_counts.text_counts(column(texts), merges, token_counts.Known(50)).tolist() == [len(x) for x in want]
    coder = packing.Encoder(VOCABULARY)
    for chunk in chunks(column(texts), 5000):
        ids, bounds = coder.chunk(chunk)
        for k in range(chunk.rows):
            if "<|endoftext|>" not in (texts[chunk.first + k] or ""):
                assert ids[bounds[k] : bounds[k + 1]].tolist() == want[chunk.first + k]


def plain_secrets(text):
    expression = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
    )
    found = [(m.start(), m.end(), "assign") for m in expression.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda s: (s[0], secret_spans.KINDS.index(s[2])))


def test_secrets():
    draw, keywords = random.Random(4), secret_spans.automaton()
    parts = ["password", "PassWd", "token", "secret", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abc", "12345678", "AKIA",
             "ABCDEFGH1234", "deadbeef00", "0123456789abcdef", "é", "ſecret", "İ", "-", "passwordtoken", "🙂"]
    for _ in range(8000):
        text = "".join(draw.choices(parts, k=draw.randint(0, 14)))
        assert [s for s in secret_spans.find(text, keywords) if s[2] != "signed"] == plain_secrets(text)
    body = "".join(draw.choices(secret_spans.ALPHABET, k=30))
    good, bad = f"ghp_{body}{secret_spans.checksum(body)}", f"ghp_{body}000000"
    assert secret_spans.find(f"é {good} {bad}", keywords) == [(2, 42, "signed")]
    assert secret_spans.masked(f"é {good}!", [(2, 42, "signed")], "[S]") == "é [S]!"


def test_secret_rows(spark):
    rows = secret_spans.secret_spans(odd(spark)).collect()
    assert len(rows) == len(odd_rows())
    assert {r.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert secret_spans.secret_spans(none(spark)).count() == 0
    dirty = spark.createDataFrame([(1, "token = abcdefgh1 x", 1), (2, None, 2)], "doc_id long, text string, spans int")
    clean = secret_spans.mask_secrets(dirty)
    assert clean.schema == dirty.schema
    assert sorted(map(tuple, clean.collect())) == [(1, "[SECRET] x", 1), (2, None, 2)]


def test_token_rows(spark):
    rows = token_counts.token_counts(odd(spark), VOCABULARY).collect()
    library = Tokenizer.from_file(VOCABULARY)
    want = sorted((len(library.encode(r[1] or "", add_special_tokens=False).ids), len((r[1] or "").encode())) for r in odd_rows())
    assert sorted((r.n_tokens, r.n_bytes) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)
    assert token_counts.token_counts(none(spark), VOCABULARY).count() == 0


def test_line_rules(spark):
    # Host h: a shared line in 40 different documents, of which one has nothing else; copies count once.
    shared = prose(5, 60)
    rows = [(k, shared + "\n" + prose(100 + k, 80), "h") for k in range(40)]
    rows += [(50, shared + "\nok " + prose(51, 5), "h")]
    rows += [(60 + k, prose(7, 90), "h") for k in range(60)] + [(200, prose(8, 20), "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in line_rules.quality(docs).collect()}
    assert all(found[k].kept and found[k].lost_lines == 1 and found[k].lost_words == 60 for k in range(40))
    assert not found[50].kept and not found[50].base_failed
    assert all(found[60 + k].kept for k in range(60))  # sixty copies of one document are one document
    assert found[200].base_failed and not found[200].kept
    again = line_rules.quality(odd(spark)).collect()
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in again) == sorted(
        plain_counts(r[1]) for r in odd_rows())
    assert line_rules.quality(none(spark)).count() == 0


def test_documents_that_are_mostly_a_shared_line(spark):
    # 500 different documents, 200 of them 90% the same line: each counts, or that line would stay.
    shared = prose(5, 100)
    rows = [(k, shared + "\nown " + prose(1000 + k, 9), "h") for k in range(200)]
    rows += [(k, prose(1000 + k, 110), "h") for k in range(200, 500)]
    rows += [(500 + k, prose(9, 60) + "\n" + prose(10, 60), "h") for k in range(300)]  # copies of one
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    common = line_rules.common_lines(line_rules.scan(docs)).collect()
    assert [r.n for r in common] == [200]
    found = {r.doc_id: r for r in line_rules.quality(docs).collect()}
    assert not any(found[k].kept or found[k].base_failed for k in range(200))
    assert all(found[k].kept for k in range(200, 800))


def test_line_limit_is_the_same_at_every_host_size(spark):
    # A line in eleven documents goes from a host of twelve and from one of 600; a line in ten stays in both.
    rows = []
    for host, size in (("small", 12), ("large", 600)):
        for k in range(size):
            seed, lines = len(rows), [prose(5000 + len(rows), 80)]
            lines += [prose(5, 9)] * (k < 11) + [prose(6, 9)] * (k < 10)
            rows.append((seed, "\n".join(lines), host))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = line_rules.quality(docs).groupBy("host", "lost_lines").count().collect()
    assert sorted(map(tuple, found)) == [("large", 0, 589), ("large", 1, 11), ("small", 0, 1), ("small", 1, 11)]
    assert line_rules.quality(docs).where("not kept").count() == 0
