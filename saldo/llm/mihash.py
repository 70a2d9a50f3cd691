"""Exact nearest binary codes by incremental multi-index hashing.

A code is cut into segments, and each segment is indexed. If a code differs from the query in at
most m (r + 1) - 1 places, one of its m segments differs in at most r. So the search looks up all
segment values at distance 0, 1, 2 ... and verifies the whole codes found, until the k-th verified
distance is covered by the radius reached.

Codes lie in blocks by their hash, queries in blocks too. A task gets one block of each, builds the
index of its codes and answers its queries exactly; the best k of a query over all its blocks
are its answer.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEGMENTS, SEGMENT_BITS = 4, 16
CODE_BITS = SEGMENTS * SEGMENT_BITS
CODE_BLOCK, QUERY_BLOCK = 16_384, 1_024


def with_code(frame: DataFrame, vector: str, code: str = "code") -> DataFrame:
    """code: bit i is set if element i of the vector is positive; of CODE_BITS elements at most.

    A null vector has a null code; a null or missing element gives no bit. A longer vector is an error: a code
    of its first elements would not be its code.
    """
    bits = [
        F.when(F.get(F.col(f"`{vector}`"), F.lit(i)) > 0, F.shiftleft(F.lit(1).cast("long"), i)).otherwise(0)
        for i in range(CODE_BITS)
    ]
    wide = F.raise_error(F.concat(F.lit(f"a vector of more than {CODE_BITS} elements: "), F.size(f"`{vector}`")))
    made = F.when(F.size(f"`{vector}`") > CODE_BITS, wide.cast("long")).otherwise(sum(bits[1:], bits[0]))
    return frame.withColumn(code, F.when(F.col(f"`{vector}`").isNotNull(), made))


class MultiIndex:
    """Index of an array of 64-bit codes."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.order, self.start = codes, [], []
        for segment in range(SEGMENTS):
            values = self.part(codes, segment)
            self.order.append(np.argsort(values, kind="stable"))
            self.start.append(np.searchsorted(values[self.order[-1]], np.arange((1 << SEGMENT_BITS) + 1)))

    @staticmethod
    def part(codes, segment: int):
        shift = np.uint64(SEGMENT_BITS * segment)
        return ((codes >> shift) & np.uint64((1 << SEGMENT_BITS) - 1)).astype(np.int64)

    def at_radius(self, query: np.uint64, segment: int, radius: int) -> np.ndarray:
        """Places of the codes whose segment differs from the query's in exactly radius bits."""
        values = self.part(query, segment) ^ masks(radius)
        low, high = self.start[segment][values], self.start[segment][values + 1]
        sizes = high - low
        places = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return self.order[segment][places]

    def nearest(self, query: np.uint64, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of the k nearest codes, ties by id; fewer if there are fewer."""
        seen = np.zeros(len(self.codes), bool)
        places = np.empty(0, np.int64)
        distances = np.empty(0, np.int64)
        for radius in range(SEGMENT_BITS + 1):
            for segment in range(SEGMENTS):
                new = self.at_radius(query, segment, radius)
                new = new[~seen[new]]
                seen[new] = True
                places = np.concatenate([places, new])
                distances = np.concatenate([distances, np.bitwise_count(self.codes[new] ^ query)])
                # Segments up to this one are searched to the radius, the others to one less.
                covered = SEGMENTS * radius + segment
                if len(places) >= k and np.partition(distances, k - 1)[k - 1] <= covered:
                    best = np.lexsort((ids[places], distances))[:k]
                    return places[best], distances[best]
        best = np.lexsort((ids[places], distances))[:k]
        return places[best], distances[best]


_MASKS: dict[int, np.ndarray] = {}


def masks(radius: int) -> np.ndarray:
    """All segment values with so many bits set."""
    if radius not in _MASKS:
        chosen = combinations(range(SEGMENT_BITS), radius)
        _MASKS[radius] = np.array([sum(1 << b for b in bits) for bits in chosen], np.int64)
    return _MASKS[radius]


def top_k(
    base: DataFrame, queries: DataFrame, k: int = 10,
    code_block: int = CODE_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """For each row of queries (id, code) its k nearest rows of base (id, code), by Hamming distance.

    Returns query_id, rank from 1, neighbour_id, distance. Ties in distance go to the smaller id.
    Rows without id or code are no neighbours and no queries. A query that is a row of base finds
    itself. Repeated queries are answered once. Rows of base with equal id and code are each a
    neighbour. If base has fewer than k rows, all are returned.

    Of the rows with one code only the k smallest ids can be in an answer, however many share it;
    Spark drops the others before the shuffle.
    """
    sound = "id IS NOT NULL AND code IS NOT NULL"
    base, queries = base.select("id", "code").where(sound), queries.select("id", "code").where(sound).distinct()
    same = Window.partitionBy("code").orderBy("id")
    base = base.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k).drop("nth")
    n_codes = max(1, -(-base.count() // code_block))
    n_queries = max(1, -(-queries.count() // query_block))
    hashed = F.xxhash64("code")
    codes = base.withColumn("code_block", F.pmod(hashed, F.lit(n_codes))).withColumn(
        "query_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_queries - 1).cast("long")))
    )
    asked = queries.withColumn("query_block", F.pmod(F.xxhash64("id"), F.lit(n_queries))).withColumn(
        "code_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_codes - 1).cast("long")))
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "neighbour_id": [], "distance": []}, dtype="int64")]
        if len(left) and len(right):
            ids = left["id"].to_numpy(np.int64)
            index = MultiIndex(left["code"].to_numpy(np.int64).view(np.uint64))
            asked_codes = right["code"].to_numpy(np.int64).view(np.uint64)
            for query_id, query in zip(right["id"], asked_codes):
                places, distances = index.nearest(query, ids, k)
                out.append(pd.DataFrame({
                    "query_id": np.full(len(places), query_id, np.int64),
                    "neighbour_id": ids[places], "distance": distances.astype(np.int64),
                }))
        return pd.concat(out, ignore_index=True)

    found = (
        codes.groupBy("code_block", "query_block")
        .cogroup(asked.groupBy("code_block", "query_block"))
        .applyInPandas(search, "query_id bigint, neighbour_id bigint, distance bigint")
    )
    best = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("long").alias("rank"), "neighbour_id", "distance")
    )
