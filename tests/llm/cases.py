"""Small tables with the odd rows that every operator must take."""

import random

import pyarrow as pa

WORDS = "the of and to in that is was er tion ing ed on es re at en he th or".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(WORDS, k=draw.randint(1, 3))) + draw.choice(["", "", ",", "."]) for _ in range(n))


def odd_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, row, key, node, shard, n): nulls, empties, repeats, a long text, clashing names."""
    texts = [None, "", " \n\t ", "a", "!!!", "héé ñ 中文 🙂", prose(1, 400), prose(1, 400), prose(2, 12) + "\n" + prose(2, 12), prose(3, 60_000)]
    rows = [(k, t, "en" if k % 3 else None, None if k % 4 == 0 else f"s{k % 2}", len(t or ""), "x", k, "n", 1.5, None) for k, t in enumerate(texts)]
    return [*rows, rows[6], rows[0], (None, "no id here", None, None, None, None, None, None, None, None)]


ODD = "doc_id long, text string, lang string, source string, n_chars long, row string, key int, node string, shard double, n long"


def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD)


def none(spark):
    return spark.createDataFrame([], ODD)


def column(texts) -> pa.Array:
    return pa.array(texts, pa.string())
