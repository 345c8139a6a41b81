"""Profile files in HMMER3 text form.

A profile database holds a few dozen short profiles. It is read whole, after
a check of its size, because every task needs all of it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

MAX_BYTES = 64 * 1024 * 1024
# Log-probability that stands for "impossible" in a profile.
NEVER = -50.0


@dataclass
class Profile:
    name: str
    match: np.ndarray  # states x 4, log-odds against equal base frequencies
    moves: np.ndarray  # states x 7: m->m m->i m->d i->m i->i d->m d->d
    mu: float
    rate: float


def parse_profiles(text: str) -> list[Profile]:
    return [_profile(part.splitlines()) for part in text.split("\n//") if "NAME" in part]


def _numbers(words: list[str]) -> list[float]:
    return [NEVER if w == "*" else max(NEVER, -float(w)) for w in words]


def _profile(lines: list[str]) -> Profile:
    fields, mu, rate = {}, 0.0, math.log(2)
    at = 0
    while not lines[at].startswith("HMM "):
        words = lines[at].split()
        if words[:3] == ["STATS", "LOCAL", "VITERBI"]:
            mu, rate = float(words[3]), float(words[4])
        elif words:
            fields[words[0]] = words[1] if len(words) > 1 else ""
        at += 1
    body = [line.split() for line in lines[at + 2:] if line.strip()]
    if body[0][0] == "COMPO":
        body = body[1:]
    states = [body[i:i + 3] for i in range(2, len(body), 3)]
    match = np.array([_numbers(s[0][1:5]) for s in states]) + math.log(4)
    moves = np.array([_numbers(s[2][:7]) for s in states])
    if len(match) != int(fields["LENG"]):
        raise ValueError(f"profile {fields['NAME']}: {len(match)} states instead of {fields['LENG']}")
    return Profile(fields["NAME"], match, moves, mu, rate)


def read_profiles(spark: SparkSession, path: str) -> list[Profile]:
    found = spark.read.format("binaryFile").load(path).select("length", "content")
    size = found.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    if size > MAX_BYTES:
        raise ValueError(f"profile file of {size} bytes exceeds {MAX_BYTES}")
    return [p for row in found.select("content").collect() for p in parse_profiles(row["content"].decode())]
