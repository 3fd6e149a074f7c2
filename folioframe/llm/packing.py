"""Documents put whole into containers of a fixed number of tokens.

1. ``token_counts`` counts tokens of a public byte-level tokenizer, in Arrow batches.
2. ``pack`` spreads the documents over shards by a hash of their id, so that every shard holds about ``SHARD`` documents whatever
   their source, and packs each shard by variable-capacity best fit: longest first, each into the open container with the least room
   that still fits; where none fits, a container is opened in the permitted length that the opening rule calls cheapest. All opening
   rules are tried on the shard, every container is then shrunk to the least permitted length that holds its contents, and the rule
   with the least total cost is kept. Shards are independent; what sharding can waste is part of one container per shard.

A document longer than the longest container is cut into full containers and a rest, which is packed like any other document.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.session import stored

#: Vocabulary file of the default tokenizer, and (a fixed value) the pattern that cuts text before its merges.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Permitted container lengths in tokens, and the cost of a container besides its length.
LENGTHS = (512, 1024, 2048)
OPENING = 16
#: Documents per shard.
SHARD = 50_000
#: Word counts remembered by a worker.
REMEMBERED = 500_000

_GAP = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=2)
def _encoder(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def counter(vocabulary: str = VOCABULARY) -> Callable[[str], int]:
    """A function from text to its number of tokens.

    The pattern always starts a new piece at a single space between two other characters, and merges stay inside pieces; so a text has
    as many tokens as its words with their leading space, and words are counted once and remembered.
    """
    encode = _encoder(vocabulary).encode_ordinary
    known: dict[str, int] = {}

    def count(text: str) -> int:
        first, *rest = _GAP.split(text)
        total = len(encode(first))
        try:
            return total + sum(map(known.__getitem__, rest))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for word in set(rest).difference(known):
                known[word] = len(encode(" " + word))
            return total + sum(map(known.__getitem__, rest))

    return count


def token_counts(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, n_tokens). A null or empty text has no tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            sizes = [count(t) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["id", "n_tokens"])

    return documents.select(F.col(key).cast("bigint").alias("id"), text).mapInArrow(run, "id bigint, n_tokens bigint")


def _fit(sizes: list[int], opening: Callable[[int], int]) -> tuple[list[int], list[int]]:
    """(container of each item, room taken per container) by best fit; ``sizes`` falls."""
    room: dict[int, list[int]] = {}
    free = 0
    taken: list[int] = []
    where: list[int] = []
    for size in sizes:
        fits = free >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            stack = room[left]
            bin_ = stack.pop()
            if not stack:
                free &= ~(1 << left)
        else:
            left, bin_ = opening(size), len(taken)
            taken.append(0)
        taken[bin_] += size
        where.append(bin_)
        rest = left - size
        if rest:
            room.setdefault(rest, []).append(bin_)
            free |= 1 << rest
    return where, taken


def _rules(lengths: tuple[int, ...], cost: Callable[[int], float]) -> list[Callable[[int], int]]:
    """Ways to choose the length of a new container: the cheapest that fits, the cheapest per token, each length where it fits."""
    cheapest = lambda size: min((x for x in lengths if x >= size), key=cost)
    per_token = lambda size: min((x for x in lengths if x >= size), key=lambda x: cost(x) / x)
    fixed = [lambda size, x=x: x if x >= size else cheapest(size) for x in lengths]
    return [cheapest, per_token, *fixed]


def best_packing(sizes: np.ndarray, lengths: tuple[int, ...], opening: float = OPENING) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(container of each item, place in it, capacity of each container) of the cheapest packing found."""
    lengths = tuple(sorted(lengths))
    ladder = np.array(lengths)
    order = np.argsort(-sizes, kind="stable")
    falling = sizes[order].tolist()
    best = None
    for rule in _rules(lengths, lambda x: x + opening):
        where, taken = _fit(falling, rule)
        capacity = ladder[np.searchsorted(ladder, np.array(taken, dtype=np.int64))]
        total = float(capacity.sum() + opening * len(capacity))
        if best is None or total < best[0]:
            best = (total, where, capacity)
    container = np.empty(len(sizes), np.int64)
    container[order] = best[1]
    by = np.argsort(container, kind="stable")
    starts = np.flatnonzero(np.append(True, container[by][1:] != container[by][:-1])) if len(by) else by
    place = np.empty(len(sizes), np.int64)
    place[by] = np.arange(len(by)) - np.repeat(starts, np.diff(np.append(starts, len(by))))
    return container, place, best[2]


def pack(counts: DataFrame, lengths: tuple[int, ...] = LENGTHS, opening: float = OPENING, shard: int = SHARD) -> DataFrame:
    """(doc_id, piece, start_token, n_tokens, container, place, capacity, unused) for counts (id, n_tokens).

    One row per document; one per piece for documents longer than the longest container. ``unused`` is the free space of the whole
    container. Documents without tokens have one row with no container. Repeated ids are packed as separate items.
    """
    longest = max(lengths)
    counts = stored(counts, "token_counts")
    shards = max(1, -(-counts.count() // shard))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["n_tokens"].to_numpy()
        ids = pdf["id"].to_numpy()
        pieces = np.maximum(-(-sizes // longest), 1)
        owner = np.repeat(np.arange(len(ids)), pieces)
        piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = piece * longest
        size = np.minimum(sizes[owner] - start, longest)
        container, place, capacity = best_packing(size, lengths, opening)
        used = np.bincount(container, weights=size, minlength=len(capacity)).astype(np.int64)
        return pd.DataFrame(
            {
                "doc_id": ids[owner],
                "piece": piece,
                "start_token": start,
                "n_tokens": size,
                "container": (int(pdf["shard"].iloc[0]) << 32) + container,
                "place": place,
                "capacity": capacity[container],
                "unused": (capacity - used)[container],
            }
        )

    schema = "doc_id bigint, piece int, start_token bigint, n_tokens bigint, container bigint, place int, capacity int, unused int"
    full = counts.where("n_tokens > 0").withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    packed = full.groupBy("shard").applyInPandas(run, schema)
    none = F.lit(None)
    empty = counts.where("n_tokens = 0").select(
        F.col("id").alias("doc_id"),
        F.lit(0).alias("piece"),
        F.lit(0).cast("bigint").alias("start_token"),
        "n_tokens",
        none.cast("bigint").alias("container"),
        none.cast("int").alias("place"),
        none.cast("int").alias("capacity"),
        none.cast("int").alias("unused"),
    )
    return packed.unionByName(empty)


def fill(packed: DataFrame) -> DataFrame:
    """Containers, tokens and free share per capacity."""
    each = packed.where("container is not null").groupBy("container", "capacity").agg(F.sum("n_tokens").alias("used"))
    return (
        each.groupBy("capacity")
        .agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"))
        .withColumn("unused_share", F.round(1 - F.col("tokens") / (F.col("containers") * F.col("capacity")), 6))
    )
