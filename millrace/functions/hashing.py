"""Stable hashes as columns."""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import let

#: The prime of the permutations.
PRIME = 2**31 - 1


def hex_number(text: Column, start: int, digits: int) -> Column:
    """Hexadecimal digits of the SHA-256 of a text as a number."""
    return F.conv(F.substring(F.sha2(text, 256), start, digits), 16, 10)


def score32(key: Column, seed: int = 42) -> Column:
    """Uniform score from the first 32 bits; 1.0 can occur."""
    return hex_number(F.concat(F.lit(f"{seed}:"), key), 1, 8).cast("double") / F.lit(4294967295.0)


def score64(key: Column, seed: int = 42) -> Column:
    """Uniform score from the first 64 bits."""
    return hex_number(F.concat(F.lit(f"{seed}:"), key), 1, 16).cast("decimal(20,0)").cast("double") / F.lit(18446744073709551616.0)


def token_ids(words: Column, size: int = 100_000) -> Column:
    """Identifiers of words from the first 32 bits of their hash."""
    return F.transform(words, lambda w: hex_number(w, 1, 8).cast("bigint") % size)


def shingles(words: Column, k: int = 5, most: int | None = None) -> Column:
    """Distinct runs of k words; one run for a shorter text. If `most` is given, as in the reference, texts with more
    runs are sampled: only every n-th is taken, with n = (words - k + 1) // most. A word put in front shifts the sample."""

    def runs(w: Column) -> Column:
        n = F.size(w)
        stride = F.lit(1) if most is None else F.when(n > most + k, F.greatest(F.lit(1), F.floor((n - (k - 1)) / most).cast("int"))).otherwise(1)
        each = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), n - k), stride), lambda i: F.array_join(F.slice(w, i + 1, k), " "))
        return F.when(n == 0, F.array().cast("array<string>")).when(n < k, F.array(F.array_join(w, " "))).otherwise(F.array_distinct(each))

    return let(words, runs)


def base_hashes(items: Column) -> Column:
    """31-bit hashes of strings."""
    return F.transform(items, lambda s: hex_number(s, 9, 8).cast("bigint").bitwiseAND(F.lit(2**31 - 1)))


def coefficients(permutations: int = 128, seed: int = 42) -> tuple[list[int], list[int]]:
    """Multipliers and offsets of the permutations, drawn by the seeded generator."""
    draw = random.Random(seed)
    return [draw.randint(1, PRIME - 1) for _ in range(permutations)], [draw.randint(0, PRIME - 1) for _ in range(permutations)]


def minhash(rows: DataFrame, permutations: int = 128, seed: int = 42, keep: Sequence[str] = ()) -> DataFrame:
    """(id, signature) of rows(id, hashes): the least permuted hash for every permutation; zeros for no hash. `keep` names
    string columns that are passed on."""
    a, b = (np.array(x, dtype=np.int64)[:, None] for x in coefficients(permutations, seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("hashes")
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).cumsum()
            out = np.zeros((batch.num_rows, permutations), dtype=np.int32)
            for i, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
                if hi > lo:
                    out[i] = ((a * flat[None, lo:hi] + b) % PRIME).min(axis=1)
            signature = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, permutations), pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("id", *keep)), signature], ["id", *keep, "signature"])

    return rows.select("id", *keep, "hashes").mapInArrow(run, ", ".join(f"{c} string" for c in ("id", *keep)) + ", signature array<int>")
