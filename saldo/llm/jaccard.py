"""Join of texts by the Jaccard similarity of their word 5-grams: MinHash LSH forest, verified exactly.

Equal sets of n-grams are one node, however many documents have them. A node's signature is cut into
trees; a tree is the prefix trie of its values, and two nodes meet in the subtree of a common prefix. A
subtree is a group of equal prefixes, its branches are the next values. Prefixes are taken at full
depth first, and pairs that meet are verified on their whole sets of n-grams. Then the recall of each node's
links is estimated from those found: a pair of similarity s shares a prefix of this length in some tree
with a known chance p, so a link found stands for 1 / p links. Nodes that miss the target are open: their prefixes are shortened by one value, and what they meet now for the first time is verified. So a
node with many close copies is done soon, and its group is not compared again; one with few or none goes
on, at most to the floor, at which even a pair at the threshold meets with the target's chance. Nodes that
meet no other one at the floor are left out from the beginning. Signatures tell which nodes of a subtree meet
for the first time; only these are sent to it with their texts.

A subtree with many nodes is cut into blocks, and every two blocks are verified by one task, which
returns sums per node and a spanning star instead of pairs. Linked nodes are joined to classes by
contracting edges, all in Spark.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saldo.llm.common import WORD, held, set_aside, small_batches, stored

GRAM = 5
SIMILARITY = 0.8
RECALL = 0.9999
#: Trees, and the values of a whole prefix.
TREES, DEPTH = 16, 5
#: Nodes of a subtree that are verified against each other at once, and rows handled at once; and the bytes of their texts.
BLOCK, PORTION = 512, 1_024
BLOCK_BYTES, PORTION_BYTES = 8 << 20, 16 << 20
#: Portions of one task, and pairs whose signatures are compared at once.
OF_A_TASK, AT_ONCE = 4, 8_192
#: Words whose hash is remembered per Python worker before the memory is emptied.
REMEMBERED = 250_000

_WORD = re.compile(WORD)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        made = self[word] = xxhash.xxh3_64_intdigest(word)
        return made


def shingles(text: str | None, gram: int = GRAM) -> np.ndarray:
    """The sorted hashes of a text's word n-grams, in lower case; of all words if there are fewer."""
    words = _WORD.findall(text.lower()) if text else []
    if not words:
        return np.zeros(0, np.uint64)
    known = held("word hashes", _Words)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(gram, len(words))
    count = len(words) - size + 1
    value = np.full(count, size, np.uint64)
    for i in range(size):
        value = value * _BASE + hashes[i : i + count]
        value ^= value >> np.uint64(31)
    return np.unique(value)


def chance(similarity, level: int, trees: int = TREES):
    """How likely a pair of this similarity shares a prefix of so many values in some tree."""
    return 1 - (1 - similarity**level) ** trees


def floor_level(trees: int = TREES, depth: int = DEPTH, similarity: float = SIMILARITY, recall: float = RECALL) -> int:
    """The longest prefix at which pairs at the threshold meet often enough; 1 at least."""
    for level in range(depth, 1, -1):
        if chance(similarity, level, trees) >= recall:
            return level
    return 1


def covered(pairs, missed, level: int, similarity: float = SIMILARITY, recall: float = RECALL):
    """Whether prefixes of this length are enough for a node, given its pairs found and how many more they stand for.

    The chance that it lacks a pair like those must be 1 - recall at most, and so must be the part that it lacks
    if one further pair at the threshold is supposed: few pairs or none are no proof.
    """
    unseen = 1 / chance(similarity, level) - 1
    return (missed <= 1 - recall) & (missed + unseen <= (1 - recall) * (pairs + 1))


def _seeds(level: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    dealt = np.random.default_rng(20_240_501)
    odd = dealt.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
    plus = dealt.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)
    return tuple(x.reshape(TREES, DEPTH)[:, :level].ravel() for x in (odd, plus))


def signature(grams: np.ndarray, seeds: tuple[np.ndarray, np.ndarray]) -> bytes:
    """TREES times as many minima of 32 bits as seeds are given for a tree."""
    times, plus = seeds
    least = np.full(len(times), np.iinfo(np.uint32).max, np.uint32)
    for begin in range(0, len(grams), 4_096):
        part = grams[begin : begin + 4_096]
        mixed = (part * _MIX)[None, :] * times[:, None] + plus[:, None]
        np.minimum(least, (mixed >> np.uint64(32)).astype(np.uint32).min(axis=1), out=least)
    return least.astype(">u4").tobytes()


def _signed(docs: DataFrame, gram: int) -> DataFrame:
    """docs (doc_id, text) -> doc_id, text_hash, n_bytes, digest, signature; the last two null without words."""
    seeds = _seeds()

    def run(batches):
        for batch in small_batches(batches):
            digests, signatures = [], []
            for text in batch.column(2).to_pylist():
                grams = shingles(text, gram)
                digests.append(xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                signatures.append(signature(grams, seeds) if len(grams) else None)
            n_bytes = pc.binary_length(batch.column(2)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], n_bytes, pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                names=["doc_id", "text_hash", "n_bytes", "digest", "signature"],
            )

    rows = docs.select("doc_id", "text_hash", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash bigint, n_bytes bigint, digest binary, signature binary")


def _first_meetings(values: np.ndarray, left: np.ndarray, right: np.ndarray, tree: int, level: int) -> np.ndarray:
    """Which of the pairs share this tree's prefix, none of an earlier tree, and no longer one of any tree."""
    out = np.zeros(len(left), bool)
    for begin in range(0, len(left), AT_ONCE):
        part = slice(begin, begin + AT_ONCE)
        equal = values[left[part]] == values[right[part]]
        shared = equal[:, :, :level].all(axis=2)
        first = shared[:, tree] & ~shared[:, :tree].any(axis=1)
        if level < DEPTH:
            first &= ~(shared & equal[:, :, level]).any(axis=1)
        out[part] = first
    return out


def verify(rows: list[tuple[int, int, bytes, np.ndarray]], tree: int, level: int, similarity: float, sides=None):
    """rows (nid, n_docs, signature, grams) of one subtree -> root, links, pairs and missed per row.

    Only pairs that meet here for the first time are linked. sides: the block of each row if there are to be
    two; pairs inside a block are left to others then. links counts documents, pairs nodes; missed tells how many
    more pairs these stand for at prefix lengths from 1 to DEPTH.
    """
    sizes = np.array([len(r[3]) for r in rows])
    every, place = np.unique(np.concatenate([r[3] for r in rows]), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), sizes)
    shared = np.flatnonzero(np.bincount(place, minlength=len(every)) > 1)
    column = np.full(len(every), -1)
    column[shared] = np.arange(len(shared))
    place = column[place]
    owner, place = owner[place >= 0], place[place >= 0]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    common = np.zeros((len(rows), len(rows)), np.float32)
    for begin in range(0, len(shared), 2_048):
        low, high = np.searchsorted(place, [begin, begin + 2_048])
        part = np.zeros((len(rows), 2_048), np.float32)
        part[owner[low:high], place[low:high] - begin] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    near = common >= similarity * union - 1e-6
    np.fill_diagonal(near, False)
    if sides is not None:
        near &= sides[:, None] != sides[None, :]
    left, right = np.nonzero(np.triu(near))
    if len(left):
        values = np.frombuffer(b"".join(r[2] for r in rows), ">u4").reshape(len(rows), TREES, DEPTH)
        new = _first_meetings(values, left, right, tree, level)
        left, right = left[new], right[new]
    weights = np.array([r[1] for r in rows], np.int64)
    links = np.zeros(len(rows), np.int64)
    np.add.at(links, left, weights[right])
    np.add.at(links, right, weights[left])
    pairs = np.zeros(len(rows), np.int64)
    missed = np.zeros((len(rows), DEPTH))
    alike = (common[left, right] / union[left, right]).astype(float)
    more = np.stack([1 / chance(alike, k) - 1 for k in range(1, DEPTH + 1)], axis=1)
    for end in (left, right):
        np.add.at(pairs, end, 1)
        np.add.at(missed, end, more)
    root = np.array([r[0] for r in rows], np.int64)
    while True:  # the smallest id reached over links
        before = root.copy()
        np.minimum.at(root, left, root[right])
        np.minimum.at(root, right, root[left])
        if (root == before).all():
            return root, links, pairs, missed


PAIRED = "tree int, prefix bigint, nid bigint, n_bytes bigint, open boolean, block int, low int, high int"


def _meeting(paired: DataFrame, level: int) -> DataFrame:
    """PAIRED with portion and signature -> PAIRED: rows that meet another one of their group for the first time.

    Signatures tell that, so only such rows need their texts. Of two nodes one must be open.
    """
    names = [f.split()[0] for f in PAIRED.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(n, "ascending") for n in ("tree", "prefix", "low", "high")])
        tree, prefix, low, high, block, is_open = (
            table.column(n).to_numpy() for n in ("tree", "prefix", "low", "high", "block", "open")
        )
        values = np.frombuffer(b"".join(table.column("signature").to_pylist()), ">u4").reshape(-1, TREES, DEPTH)
        changes = [x[1:] != x[:-1] for x in (tree, prefix, low, high)]
        borders = np.flatnonzero(np.logical_or.reduce(changes)) + 1
        kept = np.zeros(len(tree), bool)
        for begin, end in zip([0, *borders], [*borders, len(tree)]):
            left, right = (x + begin for x in np.triu_indices(end - begin, 1))
            wanted = is_open[left] | is_open[right]
            if low[begin] != high[begin]:
                wanted &= block[left] != block[right]
            left, right = left[wanted], right[wanted]
            new = _first_meetings(values, left, right, tree[begin], level)
            kept[left[new]] = kept[right[new]] = True
        return table.select(names).filter(pa.array(kept))

    return paired.groupBy("portion").applyInArrow(run, PAIRED)


FOUND = "nid bigint, root bigint, links bigint, pairs bigint, missed array<double>"


def _links(members: DataFrame, level: int, similarity: float, gram: int) -> DataFrame:
    """members (portion, tree, prefix, low, high, block, nid, n_docs, signature, text) -> FOUND."""

    def run(table: pa.Table) -> pa.Table:
        frame = table.drop_columns(["portion"]).to_pylist()
        grams: dict[int, np.ndarray] = {}
        groups: dict[tuple, list] = {}
        for row in frame:
            if row["nid"] not in grams:
                grams[row["nid"]] = shingles(row["text"], gram)
            groups.setdefault((row["tree"], row["prefix"], row["low"], row["high"]), []).append(row)
        out: list[tuple] = []
        for (tree, _, low, high), found in groups.items():
            rows = [(r["nid"], r["n_docs"], r["signature"], grams[r["nid"]]) for r in found]
            sides = np.array([r["block"] for r in found]) if low != high else None
            each = zip(rows, *verify(rows, tree, level, similarity, sides))
            out += [(r[0], int(of), int(n), int(k), more.tolist()) for r, of, n, k, more in each if n]
        kinds = [pa.int64()] * 4 + [pa.list_(pa.float64())]
        columns = list(zip(*out)) if out else [()] * len(kinds)
        names = [f.split()[0] for f in FOUND.split(", ")]
        return pa.table({n: pa.array(c, kind) for n, c, kind in zip(names, columns, kinds)})

    return members.groupBy("portion").applyInArrow(run, FOUND)


def _in_trees(nodes: DataFrame, level: int) -> DataFrame:
    """nodes -> their columns, tree, prefix and branch for each tree, without the signature.

    prefix is a hash of the tree's first values; verification looks at the values themselves. branch is a hash of
    the next value, the same for all at full depth.
    """
    each = nodes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))))
    begin = F.col("tree") * (4 * DEPTH) + 1
    prefix = F.xxhash64("tree", F.col("signature").substr(begin, F.lit(4 * level)))
    branch = F.xxhash64(F.col("signature").substr(begin + 4 * level, F.lit(4)) if level < DEPTH else F.lit(0))
    return each.withColumn("prefix", prefix).withColumn("branch", branch).drop("signature")


def _blocks(n: str, n_bytes: str):
    """Blocks for so many nodes; none for none."""
    return F.ceil(F.greatest(F.col(n) / BLOCK, F.least(F.col(n), F.col(n_bytes) / BLOCK_BYTES))).cast("int")


def _met_at(candidates: DataFrame, texts: DataFrame, level: int, similarity: float, gram: int) -> DataFrame:
    """FOUND for the pairs that meet at prefixes of this length, at no longer ones, and have an open node.

    candidates (nid, n_bytes, signature, open). Pairs without an open node may be found as well.
    """
    in_trees = _in_trees(candidates, level)
    is_open, open_bytes = F.col("open").cast("long"), F.when(F.col("open"), F.col("n_bytes")).otherwise(0)
    sizes = in_trees.groupBy("tree", "prefix").agg(
        F.count("*").alias("n"), F.sum("n_bytes").alias("all_bytes"), F.sum(is_open).alias("n_open"),
        F.sum(open_bytes).alias("open_bytes"), F.min("branch").alias("a"), F.max("branch").alias("b"),
    )
    sizes = sizes.withColumn("n_done", F.col("n") - F.col("n_open"))
    sizes = sizes.withColumn("done_bytes", F.col("all_bytes") - F.col("open_bytes"))
    # With one branch only, all its pairs have met at a longer prefix.
    several = F.col("n") > 1 if level == DEPTH else F.col("a") != F.col("b")
    # Open nodes have the first blocks; a subtree of one block has all nodes in it.
    small = _blocks("n", "all_bytes") <= 1
    subtrees = sizes.where(several & (F.col("n_open") > 0)).select(
        "tree", "prefix", small.alias("small"),
        F.when(small, 1).otherwise(_blocks("n_open", "open_bytes")).alias("opens"),
        F.when(small, 0).otherwise(_blocks("n_done", "done_bytes")).alias("dones"),
    )
    subtrees = stored(subtrees, "subtrees")
    # Every open block meets every block: one group each.
    early = F.col("small") | F.col("open")
    hashed = F.xxhash64("nid")
    block = F.when(early, F.pmod(hashed, "opens")).otherwise(F.col("opens") + F.pmod(hashed, F.greatest("dones", F.lit(1))))
    others = F.when(early, F.col("opens") + F.col("dones")).otherwise(F.col("opens"))
    paired = stored(
        in_trees.join(subtrees, ["tree", "prefix"]).withColumn("block", block.cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), others - 1))).select(
            "tree", "prefix", "nid", "n_bytes", "open", "block",
            F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        ),
        "paired",
    )
    group = F.xxhash64("tree", "prefix", "low", "high")
    portions = max(1, -(-paired.count() // (8 * PORTION)))
    signed = paired.join(candidates.select("nid", "signature"), "nid").withColumn("portion", F.pmod(group, F.lit(portions)))
    paired = stored(_meeting(signed.repartition(portions, "portion"), level), "meeting")
    weight = paired.agg(F.count("*").alias("n"), F.sum("n_bytes").alias("n_bytes")).first()
    portions = max(1, -(-weight["n"] // PORTION), -(-(weight["n_bytes"] or 0) // PORTION_BYTES))
    members = paired.drop("n_bytes", "open").withColumn("portion", F.pmod(group, F.lit(portions))).join(texts, "nid")
    members = members.repartition(-(-portions // OF_A_TASK), "portion")
    return stored(_links(members, level, similarity, gram), "links")


def components(edges: DataFrame) -> DataFrame:
    """edges (u, v) -> node, root: for every node of an edge the same node for all that are connected.

    Every round a node goes over to the smallest neighbour's smallest neighbour and edges are drawn
    anew between what is left, so a path halves in length; each round reads stored tables.
    """
    both = edges.union(edges.select("v", "u"))
    labels = stored(both.select(F.col("u").alias("node")).distinct().withColumn("root", F.col("node")), "labels")
    edges = stored(edges.where("u != v").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.union(edges.select("v", "u"))
        least = stored(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p")), "least")
        again = least.select(F.col("u").alias("p"), F.col("p").alias("q"))
        moved = stored(least.join(again, "p").select("u", "q"), "moved")
        labels = stored(
            labels.join(moved, labels["root"] == moved["u"], "left").select("node", F.coalesce("q", "root").alias("root")),
            "labels",
        )
        first = edges.join(moved, "u").select(F.col("q").alias("a"), "v")
        second = first.join(moved.withColumnRenamed("u", "v"), "v").select(F.col("a").alias("u"), F.col("q").alias("v"))
        edges = stored(second.where("u != v").distinct(), "edges")
    return labels


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    gram: int = GRAM, similarity: float = SIMILARITY, recall: float = RECALL,
) -> DataFrame:
    """One row per row of docs: doc_id, text_hash, class_id, n_links, stays.

    Two documents are linked if the Jaccard similarity of their n-gram sets is similarity or more.
    class_id is the smallest id among all that are connected by links, n_links the number of other
    rows linked to this one, copies included; stays is true for one row's (doc_id, text_hash) per
    class, the smallest. Texts without a word, null ones too, are alone in their class, whose id is
    their own. Equal rows get equal results. Null ids are the largest. Texts with fewer words than
    an n-gram are one n-gram. Other columns of docs are not read.
    """
    floor = floor_level(similarity=similarity, recall=recall)
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    rows = stored(_signed(docs, gram), "signed")
    sound = rows.where("digest IS NOT NULL").withColumn("teller", F.xxhash64("doc_id", "text_hash"))
    sets = sound.groupBy("digest").agg(
        F.count("*").alias("n_docs"), F.min("doc_id").alias("least_id"), F.min("teller").alias("teller")
    )
    nodes = stored(
        sound.select("digest", "teller", "doc_id", "text_hash", "n_bytes", "signature").join(sets, ["digest", "teller"]).distinct(),
        "sets",
    )
    nodes = stored(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    # What meets another node at the floor, and the texts of that.
    lowest = _in_trees(nodes.select("nid", "signature"), floor).drop("branch")
    subtrees = stored(
        lowest.groupBy("tree", "prefix").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "floor"
    )
    candidates = lowest.join(subtrees, ["tree", "prefix"]).select("nid").distinct()
    needed = stored(candidates.join(nodes.drop("digest", "teller", "least_id"), "nid"), "candidates")
    candidates = needed.select("nid", "n_bytes", "signature", F.lit(True).alias("open"))
    needed = needed.withColumnRenamed("doc_id", "of").drop("n_bytes")
    texts = stored(
        docs.join(
            needed.hint("shuffle_hash"),
            (docs["text_hash"] == needed["text_hash"]) & docs["doc_id"].eqNullSafe(needed["of"]),
        ).select("nid", "n_docs", "signature", "text"),
        "texts",
    ).dropDuplicates(["nid"])
    found = None
    for level in range(DEPTH, floor - 1, -1):
        new = _met_at(candidates, texts, level, similarity, gram)
        found = new if found is None else found.union(new)
        if level == floor:
            break
        sums = found.groupBy("nid").agg(F.sum("pairs").alias("pairs"), F.sum(F.col("missed")[level - 1]).alias("missed"))
        known = F.coalesce("pairs", F.lit(0)), F.coalesce("missed", F.lit(0.0))
        done = covered(*known, level, similarity, recall)
        candidates = candidates.drop("open").join(sums, "nid", "left").withColumn("open", ~done)
        candidates = stored(candidates.drop("pairs", "missed"), "open")
        if candidates.where("open").isEmpty():
            break
    roots = components(found.select(F.col("nid").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("nid").agg(F.sum("links").alias("links"))
    joined = (
        nodes.join(roots.withColumnRenamed("node", "nid"), "nid", "left").join(links, "nid", "left")
        .withColumn("root", F.coalesce("root", "nid"))
    )
    joined = stored(joined.select("digest", "n_docs", "least_id", "root", F.coalesce("links", F.lit(0)).alias("links")), "joined")
    classes = joined.groupBy("root").agg(F.min("least_id").alias("class_id"))
    by_set = stored(
        joined.join(classes, "root").select(
            "digest", "root", "class_id", (F.col("links") + F.col("n_docs") - 1).alias("n_links")
        ),
        "by-set",
    )
    worded = rows.where("digest IS NOT NULL").select("doc_id", "text_hash", "digest").join(by_set, "digest")
    worded = stored(worded.drop("digest"), "worded")
    # The row that stays: the one with the class id, of several the smallest text hash.
    own = F.col("doc_id").eqNullSafe(F.col("class_id"))
    first = stored(worded.where(own).groupBy("root").agg(F.min("text_hash").alias("stay")), "first")
    worded = worded.join(first, "root").withColumn("stays", own & (F.col("text_hash") == F.col("stay")))
    columns = ["doc_id", "text_hash", "class_id", "n_links", "stays"]
    silent = rows.where("digest IS NULL").select(
        "doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(True).alias("stays"),
    )
    return worded.select(columns).union(silent)


def without_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs with one row of each class; of repeated rows one stays. Texts without a word all stay."""
    names = ["stay_id", "stay_hash", "stay_nth"]
    return set_aside(docs, names, lambda rows: _staying(rows, doc_id, text, options))


def _staying(docs: DataFrame, doc_id: str, text: str, options: dict) -> DataFrame:
    found = near_duplicates(docs, doc_id, text, **options).where("stays").select("doc_id", "text_hash").distinct()
    found = stored(found, "staying").select(F.col("doc_id").alias("stay_id"), F.col("text_hash").alias("stay_hash"))
    hashed = F.xxhash64(F.col(f"`{text}`"))
    work = docs.join(
        found.hint("shuffle_hash"), (F.col(f"`{doc_id}`").eqNullSafe(F.col("stay_id"))) & (hashed == F.col("stay_hash"))
    )
    worded = F.coalesce(F.regexp_like(F.col(f"`{text}`"), F.lit(WORD)), F.lit(False))
    same = Window.partitionBy("stay_id", "stay_hash").orderBy(F.lit(0))
    return work.withColumn("stay_nth", F.row_number().over(same)).where((F.col("stay_nth") == 1) | ~worded)
