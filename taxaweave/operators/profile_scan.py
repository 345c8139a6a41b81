"""Search records for profile matches, both strands, inside Spark tasks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaweave.functions import reverse_complement
from taxaweave.model import HITS
from taxaweave.sources.profiles import NEVER, Profile

FAR = 1e7
# Codes of other letters, and of places past a sequence's end.
OTHER, PAST = 4, 5
# Sequences that go through the profiles together.
TOGETHER = 64


def _base_codes() -> np.ndarray:
    codes = np.full(256, OTHER, np.int64)
    for code, letter in enumerate(b"ACGT"):
        codes[letter] = code
    return codes


CODES = _base_codes()


class _Packed:
    """All profiles side by side, so one vector step advances every state."""

    def __init__(self, profiles: list[Profile]):
        self.profiles = profiles
        sizes = [len(p.match) for p in profiles]
        self.begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int)
        self.index = np.repeat(np.arange(len(sizes)), sizes)
        self.state = np.concatenate([np.arange(1, n + 1) for n in sizes])
        emit = np.concatenate([p.match for p in profiles])
        self.emit = np.vstack([emit.T, np.zeros(len(emit))])
        self.moves = np.concatenate([p.moves for p in profiles]).T.copy()
        silent = np.clip(self.moves[6], NEVER, 0)
        ahead = np.concatenate([[0.0], np.cumsum(silent)[:-1]])
        self.ahead = ahead - ahead[self.begin][self.index]
        self.offset = self.index * FAR


def _shift(values: np.ndarray, begin: np.ndarray, fill: float) -> np.ndarray:
    moved = np.empty_like(values)
    moved[:, 1:] = values[:, :-1]
    moved[:, begin] = fill
    return moved


def _codes(sequences: list[str]) -> np.ndarray:
    """Base codes of the sequences as rows of one table; what is past an end has a code of its own."""
    table = np.full((len(sequences), max(map(len, sequences), default=0)), PAST, np.int64)
    for row, sequence in zip(table, sequences, strict=True):
        letters = np.frombuffer(sequence.upper().encode("ascii", "replace"), dtype=np.uint8)
        row[: len(letters)] = CODES[letters]
    return table


def best_matches(sequences: list[str], packed: _Packed) -> list[list[tuple[int, float, int, int, int]]]:
    """(profile, score, state from, base from, base to) of each profile's best local match, for every sequence.

    All sequences go on by one base at a time; they should be of like length.
    """
    codes = _codes(sequences)
    mm, mi, md, im, ii, dm, _ = packed.moves
    shape = len(sequences), packed.emit.shape[1]
    emit = np.vstack([packed.emit, np.full(shape[1], -FAR)])  # nothing matches past an end
    match = np.full(shape, -FAR)
    insert, delete = match.copy(), match.copy()
    # Where each state's best path began: base number times FAR plus state.
    began = np.zeros(shape)
    began_insert, began_delete = began.copy(), began.copy()
    top, top_end, top_began = match.copy(), np.zeros(shape, dtype=np.int64), began.copy()
    states = np.arange(shape[1])
    for at in range(1, codes.shape[1] + 1):
        came, came_began = match + mm, began
        for way, origin in ((insert + im, began_insert), (delete + dm, began_delete)):
            more = way > came
            came, came_began = np.where(more, way, came), np.where(more, origin, came_began)
        came = _shift(came, packed.begin, -FAR)
        came_began = _shift(came_began, packed.begin, 0.0)
        fresh = came < 0
        stay = match + mi > insert + ii
        insert = np.where(stay, match + mi, insert + ii)
        began_insert = np.where(stay, began, began_insert)
        match = emit[codes[:, at - 1]] + np.where(fresh, 0.0, came)
        began = np.where(fresh, at * FAR + packed.state, came_began)

        source = match + md - packed.ahead + packed.offset
        ordered = np.maximum.accumulate(source, axis=1)
        holder = np.maximum.accumulate(np.where(source == ordered, states, 0), axis=1)
        delete = _shift(ordered - packed.offset, packed.begin, -FAR)
        ahead = np.empty(shape[1])
        ahead[1:] = packed.ahead[:-1]
        ahead[packed.begin] = 0.0
        delete = np.maximum(delete + ahead, -FAR)
        began_delete = _shift(np.take_along_axis(began, holder, axis=1), packed.begin, 0.0)

        better = match > top
        top = np.where(better, match, top)
        top_end = np.where(better, at, top_end)
        top_began = np.where(better, began, top_began)
    results = []
    for row in range(shape[0]):
        found = []
        for number, start in enumerate(packed.begin):
            stop = start + len(packed.profiles[number].match)
            best = start + int(np.argmax(top[row, start:stop]))
            base, state = divmod(top_began[row, best], FAR)
            found.append((number, float(top[row, best]), int(state), int(base), int(top_end[row, best])))
        results.append(found)
    return results


def expectation(score: float, matched: int, length: int, profile: Profile, models: int) -> float:
    """Expected number of equally good chance matches among ``models`` profiles."""
    states = len(profile.match)
    loop, move = math.log(length / (length + 2.0)), math.log(2.0 / (length + 2.0))
    total = score + math.log(2.0 / (states * (states + 1.0))) + 2 * move + (length - matched) * loop
    chance = length * math.log(length / (length + 1.0)) - math.log(length + 1.0)
    bits = (total - chance) / math.log(2)
    log_tail = -profile.rate * (bits - profile.mu)
    tail = math.exp(log_tail) if log_tail < -30 else -math.expm1(-math.exp(min(log_tail, 700)))
    return tail * models


def scan(records: DataFrame, profiles: list[Profile], e_value: float = 1e-7) -> DataFrame:
    """Best hit of every profile on every record, extended to the profile's start.

    The reverse strand is searched only where the forward strand has no hit.
    Records are spread over tasks; only the small profile set is shared.
    """
    plain = [(p.name, p.match, p.moves, p.mu, p.rate) for p in profiles]
    shared = records.sparkSession.sparkContext.broadcast(plain)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packed = _Packed([Profile(*values) for values in shared.value])

        def hits(names, sequences, reverse):
            """Hits of each record. Sequences of like length go together."""
            found = [[] for _ in names]
            order = sorted(range(len(names)), key=lambda k: len(sequences[k]))
            for k in range(0, len(order), TOGETHER):
                part = order[k : k + TOGETHER]
                for row, matches in zip(part, best_matches([sequences[r] for r in part], packed), strict=True):
                    for number, score, state, first, last in matches:
                        if score <= 0:
                            continue
                        profile = packed.profiles[number]
                        e = expectation(score, last - first + 1, len(sequences[row]), profile, len(packed.profiles))
                        if e <= e_value:
                            found[row].append((names[row], profile.name, max(1, first - state + 1), last, e, reverse))
            return found

        for batch in batches:
            names, forward, backward = (batch[c].tolist() for c in ("accno", "sequence", "backward"))
            rows = hits(names, forward, False)
            rest = [k for k, found in enumerate(rows) if not found]
            turned = hits([names[k] for k in rest], [backward[k] for k in rest], True)
            yield pd.DataFrame([x for found in [*rows, *turned] for x in found], columns=[f.name for f in HITS.fields])

    strands = records.where(F.length("sequence") > 0).select(
        F.col("accno").cast("string").alias("accno"), "sequence", reverse_complement(F.col("sequence")).alias("backward")
    )
    return strands.mapInPandas(search, HITS)


def turn_records(records: DataFrame, hits: DataFrame) -> DataFrame:
    """Records with the sequence reversed where the hits lie on the other strand."""
    turned = hits.where("reverse").select("accno").distinct().withColumn("_turn", F.lit(True))
    joined = records.join(turned, "accno", "left")
    return joined.withColumn(
        "sequence", F.when(F.col("_turn"), reverse_complement(F.col("sequence"))).otherwise(F.col("sequence"))
    ).drop("_turn")
