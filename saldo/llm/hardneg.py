"""Hard negatives by shared candidate lists of anchor clusters (MAXIMUS-style exact search).

Anchors are clustered by direction. For a cluster with centre c, an item's inner product with any
member is at most |member| |item| cos(max(0, angle(item, c) - widest member angle)). So a cluster
sorts its candidates by that bound once, and every member walks the list until the bound cannot
beat what it has: the answer is certified, not approximate. A walk may ask for scores within a window,
which also ends where the bound falls below the window.

Items lie in blocks by hash, anchors in blocks by cluster. A task gets one block of each, sorts
the items once per cluster and answers its anchors; the best of an anchor over all item blocks are
its answer. Both blocks have the same size, where a task moves the fewest rows for the products it
forms. Sets of any size are searched whole; clusters only decide how early a walk may end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saldo.llm.common import stored

#: Rows of an item block and of an anchor block; items looked at in one step of a walk.
BLOCK, STEP = 16_384, 1_024
#: Clusters at most, and anchors that their centres are fitted on.
CLUSTERS, SAMPLE = 32, 4_096
#: Doubles are exact for whole numbers up to here.
EXACT = 2**53
ANCHOR = "id long, label long, vector array<long>, anchor long"
FOUND = "anchor long, place int, found_id long, score long"


# --- clusters ------------------------------------------------------------------------------------


def _directions(vectors: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0)


def centres(vectors: np.ndarray, wanted: int) -> np.ndarray:
    """Centres of directions by spherical k-means, begun with directions far from each other."""
    points = _directions(vectors)
    chosen = [0]
    nearest = points @ points[0]
    for _ in range(min(wanted, len(points)) - 1):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, points @ points[chosen[-1]])
    middle = points[chosen]
    for _ in range(10):
        nearest = np.argmax(points @ middle.T, axis=1)
        sums = np.zeros_like(middle)
        np.add.at(sums, nearest, points)
        moved = _directions(sums)
        middle = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, moved, middle)
    return middle


def _assign(middle: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = _matrix(batch.column("vector").to_pylist(), middle.shape[1])
        nearest = np.argmax(_directions(vectors) @ middle.T, axis=1) if len(vectors) else []
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(nearest, pa.int32())], names=[*batch.schema.names, "cluster"]
        )


def blocks_of(counts: dict[int, int], size: int) -> dict[int, tuple[int, int]]:
    """Per cluster its first anchor block and its number of blocks. Small clusters share a block, large
    ones are cut."""
    found, block, filled = {}, 0, 0
    for cluster in sorted(counts):
        pieces = -(-counts[cluster] // size)
        if filled and filled + counts[cluster] > size:
            block, filled = block + 1, 0
        found[cluster] = block, pieces
        block, filled = (block + pieces, 0) if pieces > 1 else (block, filled + counts[cluster])
    return found


# --- walks ---------------------------------------------------------------------------------------


def _matrix(vectors, width: int) -> np.ndarray:
    return np.array([v for v in vectors], float).reshape(len(vectors), width)


class Candidates:
    """Items in the order of their bound for one cluster of members."""

    def __init__(self, items: np.ndarray, ids: np.ndarray, labels: np.ndarray, members: np.ndarray):
        centre = _directions(_directions(members).sum(axis=0, keepdims=True))[0]
        lengths = np.linalg.norm(items, axis=1)
        widest = np.arccos(np.clip(_directions(members) @ centre, -1, 1)).max()
        away = np.arccos(np.clip(_directions(items) @ centre, -1, 1))
        bound = lengths * np.cos(np.maximum(0.0, away - widest))
        if not centre.any():  # members cancel out: only lengths bound the product
            bound = lengths
        # Rounding must not lower a bound.
        bound += 1e-6 * lengths
        order = np.argsort(-bound, kind="stable")
        self.items, self.ids, self.labels, self.bound = items[order], ids[order], labels[order], bound[order]

    def walk(
        self, own: np.ndarray, own_ids: np.ndarray, own_labels: np.ndarray,
        low: np.ndarray, high: np.ndarray, same: bool, wanted: int,
    ) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
        """Best items per member and window (columns of low and high); ends are part of a window.

        With ``same`` items need the member's label and are not the member itself, else another
        label. Yields per window the members, the window, and places and scores of their items.
        """
        n, windows = low.shape
        lengths = np.linalg.norm(own, axis=1)
        last = np.full((n, windows), -np.inf)  # score of the last wanted item so far
        best: list[np.ndarray] = [np.empty((0, 3)) for _ in range(windows)]  # member, place, score
        active = np.arange(n)
        for begin in range(0, len(self.items), STEP):
            # Later items reach this score at most; equal scores still count, as a smaller id wins.
            reach = self.bound[begin] * lengths[active]
            active = active[reach >= np.maximum(low, last)[active].min(axis=1)]
            if not len(active):
                break
            here = slice(begin, begin + STEP)
            scores = np.rint(own[active] @ self.items[here].T)
            fits = (self.labels[here][None, :] == own_labels[active][:, None]) == same
            if same:
                twin = self.ids[here][None, :] == own_ids[active][:, None]
                for row, column in zip(*np.nonzero(twin & fits)):
                    fits[row, column] = (self.items[begin + column] != own[active[row]]).any()
            for window in range(windows):
                floor = np.maximum(low, last)[active, window][:, None]
                hit = fits & (scores >= floor) & (scores <= high[active, window][:, None])
                rows, columns = np.nonzero(hit)
                if len(rows):
                    new = np.column_stack([active[rows], begin + columns, scores[rows, columns]])
                    best[window] = self._best(np.vstack([best[window], new]), wanted)
                    members, place, score = best[window].T
                    full = np.flatnonzero(np.bincount(members.astype(int), minlength=n) >= wanted)
                    lowest = np.full(n, np.inf)
                    np.minimum.at(lowest, members.astype(int), score)
                    last[full, window] = lowest[full]
        for window in range(windows):
            members, places, scores = best[window].T
            yield members.astype(int), window, places.astype(int), scores.astype(np.int64)

    def _best(self, rows: np.ndarray, wanted: int) -> np.ndarray:
        """The wanted rows of each member with the greatest scores, ties by id."""
        rows = rows[np.lexsort((self.ids[rows[:, 1].astype(int)], -rows[:, 2], rows[:, 0]))]
        starts = np.r_[True, rows[1:, 0] != rows[:-1, 0]]
        nth = np.arange(len(rows)) - np.flatnonzero(starts)[np.cumsum(starts) - 1]
        return rows[nth < wanted]


def _search(same: bool, wanted: int, width: int, items: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """Answers of the anchors of one block among the items of one block."""
    out = [pd.DataFrame({"anchor": [], "place": [], "found_id": [], "score": []}, dtype="int64")]
    if len(items) and len(asked):
        vectors, own = _matrix(items["vector"], width), _matrix(asked["vector"], width)
        if width and width * np.abs(vectors).max() * np.abs(own).max() >= EXACT:
            raise ValueError("scores beyond 2^53 are not exact in double precision")
        ids, labels = items["id"].to_numpy(np.int64), items["label"].to_numpy(np.int64)
        low, high = (np.array([list(w) for w in asked[c]], float).reshape(len(asked), -1) for c in ("low", "high"))
        anchors, own_ids = asked["anchor"].to_numpy(np.int64), asked["id"].to_numpy(np.int64)
        own_labels = asked["label"].to_numpy(np.int64)
        for _, rows in asked.groupby("cluster").indices.items():
            shared = Candidates(vectors, ids, labels, own[rows])
            answers = shared.walk(
                own[rows], own_ids[rows], own_labels[rows], low[rows], high[rows], same, wanted
            )
            for members, window, places, scores in answers:
                out.append(pd.DataFrame({
                    "anchor": anchors[rows][members], "place": np.full(len(members), window),
                    "found_id": shared.ids[places], "score": scores,
                }))
    return pd.concat(out, ignore_index=True).astype({"place": "int32"})


def _answers(items: DataFrame, asked: DataFrame, n_blocks: int, n_asked: int, same: bool, wanted: int, width: int):
    """Each anchor and window with its best items over all item blocks, ranked from 1."""
    to_all = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = items.withColumn("asked_block", to_all(n_asked))
    right = asked.withColumn("item_block", to_all(n_blocks))
    by = ["item_block", "asked_block"]
    search = partial(_search, same, wanted, width)
    found = (
        left.groupBy(*by).cogroup(right.groupBy(*by))
        .applyInPandas(lambda a, b: search(a, b), FOUND)
    )
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


# --- mining --------------------------------------------------------------------------------------


def hard_negatives(
    rows: DataFrame, is_anchor: str, positives: int = 5, negatives: int = 5,
    least: int = 80, most: int = 100, block: int = BLOCK,
) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (id long, label, vector of whole numbers).

    ``is_anchor`` is a condition on id and label. An anchor's positives are its best other rows of
    the same label by inner product; a positive's negatives are the best rows of other labels whose
    score is ``least`` to ``most`` hundredths of the positive's (none if that is negative). Ties go to the
    smaller id. Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score and
    negative_score; pairs without a negative have no row.

    Rows with a null id, label, vector or entry take no part. Rows equal in all three columns are one row;
    rows that share an id otherwise are rows of their own, and each anchor among them is answered. Columns
    besides the three are not looked at. Vectors of several lengths are an error, and so are scores beyond
    2^53. Empty tables and tables without anchors give an empty result.

    Of the rows with one label and vector only those with the smallest ids can be in an answer, since
    all have the same scores; Spark drops the others before the shuffle.
    """
    sound = rows.selectExpr("cast(id AS long) AS id", "cast(label AS long) AS label", "vector").where(
        "id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL)"
    ).selectExpr("id", "label", "cast(vector AS array<long>) AS vector")
    # Repeats of a whole row are one row.
    sound = stored(sound.distinct(), "negatives-rows")
    shape = sound.agg(F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most")).first()
    width = shape.most or 0
    if shape.least is not None and shape.least != shape.most:
        raise ValueError(f"vectors of {shape.least} to {shape.most} entries have no inner product")

    anchors = stored(
        sound.where(is_anchor).withColumn("anchor", F.monotonically_increasing_id()), "negatives-anchors"
    )
    picked = anchors.orderBy(F.xxhash64("id", "vector"), "id", "anchor").limit(SAMPLE).collect()  # bounded
    if not picked:
        none = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return rows.sparkSession.createDataFrame([], none)
    wanted = max(1, min(CLUSTERS, round(len(picked) ** 0.5 / 2)))
    middle = centres(_matrix([r.vector for r in picked], width), wanted)
    clustered = stored(
        anchors.mapInArrow(partial(_assign, middle), f"{ANCHOR}, cluster int"), "negatives-clusters"
    )
    counts = {r.cluster: r["count"] for r in clustered.groupBy("cluster").count().collect()}  # CLUSTERS at most
    places = blocks_of(counts, block)
    n_asked = 1 + max(first + pieces - 1 for first, pieces in places.values())
    pairs = ", ".join(f"{c}, {first}" for c, (first, _) in places.items())
    cuts = ", ".join(f"{c}, {pieces}" for c, (_, pieces) in places.items())
    asked = clustered.withColumn("asked_block", F.expr(
        f"int(map({pairs})[cluster] + pmod(xxhash64(anchor), map({cuts})[cluster]))"
    ))

    # An anchor that is among its own copies leaves one place less for positives.
    same = Window.partitionBy("label", "vector").orderBy("id")
    enough = max(positives + 1, negatives)
    items = sound.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= enough).drop("nth")
    n_blocks = max(1, -(-sound.count() // block))
    items = stored(
        items.withColumn("item_block", F.expr(f"int(pmod(xxhash64(id, label, vector), {n_blocks}))")), "negatives-items"
    )

    unlimited = asked.selectExpr(
        "*", "array(double('-infinity')) AS low", "array(double('infinity')) AS high"
    )
    best = stored(
        _answers(items, unlimited, n_blocks, n_asked, True, positives, width).selectExpr(
            "anchor", "rank - 1 AS place", "found_id AS positive_id", "score AS positive_score"
        ), "negatives-positives",
    )
    # As many windows as positives. A negative score has none; for others both ends are whole numbers.
    by_anchor = best.where("positive_score >= 0").selectExpr(
        "anchor", "place",
        f"double(({least}L * positive_score + 99) div 100) AS low", f"double({most}L * positive_score div 100) AS high",
    ).groupBy("anchor").agg(
        F.map_from_entries(F.collect_list(F.struct("place", F.struct("low", "high")))).alias("windows")
    )
    every = f"sequence(0, {positives - 1})"
    windowed = asked.join(by_anchor, "anchor").selectExpr(
        *asked.columns,
        f"transform({every}, i -> coalesce(windows[i].low, double('infinity'))) AS low",
        f"transform({every}, i -> coalesce(windows[i].high, double('-infinity'))) AS high",
    )
    worst = _answers(items, windowed, n_blocks, n_asked, False, negatives, width)
    named = best.join(anchors.selectExpr("anchor", "id AS anchor_id"), "anchor")
    return worst.join(named, ["anchor", "place"]).selectExpr(
        "anchor_id", "positive_id", "rank", "found_id AS negative_id", "positive_score", "score AS negative_score"
    )
