"""Cross-entropy difference: how much better a target model predicts a document than a background one.

Both models are character trigram models of the same form over the same vocabulary, the characters
of the background. The background counts all documents, the target those that are given as such. The
loss of a character is -log P(c | a, b), with

    P(c | a, b) = (n(abc) + m P(c | b)) / (n(ab) + m),  P(c | b) = (n(bc) + m P(c)) / (n(b) + m),
    P(c) = (n(c) + 1) / (n + |V|)

and a document's score is the mean over its characters of target loss minus background loss; low
is near the target. All trigrams of the scored documents occur in the background, so the table of
their two losses is complete.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import map_columns, stored

#: m: the weight of the shorter history.
SMOOTHING = 8.0
#: Up to so many trigrams (24 bytes each) the losses are sent to every task; beyond, they are joined.
SENT_ROWS = 4_000_000
#: Characters handled at once, which bounds a task's memory.
AT_ONCE = 1 << 20
_BITS, _PAIR = 21, 1 << 42
FOREIGN = "a document is not part of the background"


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each character and its two predecessors (0 before a text), and the texts' lengths."""
    points = [np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32) for t in texts]
    sizes = np.array([len(p) for p in points], np.int64)
    if not sizes.sum():
        return np.zeros(0, np.int64), sizes
    last = np.concatenate(points).astype(np.int64) + 1
    begins = (np.cumsum(sizes) - sizes)[sizes > 0]
    one, two = np.roll(last, 1), np.roll(last, 2)
    one[begins] = 0
    two[begins] = 0
    second = (begins + 1)[sizes[sizes > 0] > 1]
    two[second] = 0
    return two << 2 * _BITS | one << _BITS | last, sizes


def in_portions(column: pa.Array):
    """The texts, null as empty, in runs of bounded length."""
    texts, size = [], 0
    for value in column.to_pylist():
        texts.append(value or "")
        size += len(texts[-1])
        if size >= AT_ONCE:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def counts(docs: DataFrame, name: str) -> DataFrame:
    """docs (text) -> gram, and how often it occurs, in a column of that name."""

    def run(batches):
        for batch in batches:
            for texts in in_portions(batch.column(0)):
                grams, n = np.unique(trigrams(texts)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n.astype(np.int64))], names=["gram", "n"])

    each = docs.select("text").mapInArrow(run, "gram bigint, n bigint")
    return each.groupBy("gram").agg(F.sum("n").alias(name))


def losses(background: DataFrame, target: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """gram, target_loss, background_loss for every trigram of the background.

    Both take rows with a column text; target must be part of background. Without target rows the
    target model is uniform over the vocabulary.
    """
    both = stored(
        counts(background, "b").join(counts(target, "t"), "gram", "left")
        .select("gram", "b", F.coalesce("t", F.lit(0)).alias("t"))
        .withColumn("first", F.shiftright("gram", _BITS)).withColumn("last", F.pmod("gram", F.lit(_PAIR))),
        "trigrams",
    )
    pairs = both.groupBy("last").agg(F.sum("b").alias("b"), F.sum("t").alias("t")).select(
        "last", "b", "t", F.shiftright("last", _BITS).alias("one"), F.pmod("last", F.lit(1 << _BITS)).alias("letter")
    )
    letters = pairs.groupBy("letter").agg(F.sum("b").alias("b1"), F.sum("t").alias("t1"))
    total = letters.agg(F.sum("b1").alias("bn"), F.sum("t1").alias("tn"), F.count("*").alias("v")).first()
    known = {"bn": total["bn"] or 0, "tn": total["tn"] or 0, "v": max(1, total["v"])}
    history = pairs.groupBy("one").agg(F.sum("b").alias("b_one"), F.sum("t").alias("t_one"))
    before = both.groupBy("first").agg(F.sum("b").alias("b_first"), F.sum("t").alias("t_first"))

    def chance(n: str, of: str, shorter):
        return (F.col(n) + smoothing * shorter) / (F.col(of) + smoothing)

    pairs = pairs.join(letters, "letter").join(history, "one")
    for side in "bt":
        single = (F.col(side + "1") + 1) / (known[side + "n"] + known["v"])
        pairs = pairs.withColumn(side + "p", chance(side, side + "_one", single))
    table = both.join(pairs.select("last", "bp", "tp"), "last").join(before, "first")
    return table.select(
        "gram",
        (-F.log(chance("t", "t_first", F.col("tp")))).alias("target_loss"),
        (-F.log(chance("b", "b_first", F.col("bp")))).alias("background_loss"),
    )


def score(docs: DataFrame, model: DataFrame, text: str = "text", sent_rows: int = SENT_ROWS) -> DataFrame:
    """docs with n_tokens (characters), target_loss, background_loss and score, means per character.

    Null and empty texts have 0 tokens and null losses and score. All rows and columns stay; columns
    named like a result are replaced by it. The size of the model decides whether it is sent or joined, the
    result is the same: a trigram that the model lacks is an error in both ways, as the document is no
    part of the background then.
    """
    model = stored(model, "losses")
    if model.count() <= sent_rows:
        return _score_sent(docs, model, text)
    return _score_joined(docs, model, text)


FIELDS = "n_tokens bigint, target_loss double, background_loss double, score double"


def _columns(sizes: np.ndarray, target: np.ndarray, background: np.ndarray) -> dict[str, pa.Array]:
    none = sizes == 0
    t, b = (x / np.maximum(sizes, 1) for x in (target, background))
    return {
        "n_tokens": pa.array(sizes), "target_loss": pa.array(t, mask=none),
        "background_loss": pa.array(b, mask=none), "score": pa.array(t - b, mask=none),
    }


def _score_sent(docs: DataFrame, model: DataFrame, text: str) -> DataFrame:
    rows = model.orderBy("gram").toPandas()
    sent = docs.sparkSession.sparkContext.broadcast(
        (rows["gram"].to_numpy(), rows[["target_loss", "background_loss"]].to_numpy())
    )

    def make(column: pa.Array) -> dict[str, pa.Array]:
        known, loss = sent.value
        parts = []
        for texts in in_portions(column):
            grams, sizes = trigrams(texts)
            sums = np.zeros((len(texts), 2))
            if len(grams):
                own, place = np.unique(grams, return_inverse=True)
                at = np.searchsorted(known, own)
                if at.max() >= len(known) or not (known[at] == own).all():
                    raise ValueError(FOREIGN)
                full = sizes > 0
                starts = (np.cumsum(sizes) - sizes)[full]
                sums[full] = np.add.reduceat(loss[at][place], starts, axis=0)
            parts.append((sizes, sums))
        sizes = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        sums = np.concatenate([p[1] for p in parts]) if parts else np.zeros((0, 2))
        return _columns(sizes, sums[:, 0], sums[:, 1])

    return map_columns(docs, [text], make, FIELDS)


def _score_joined(docs: DataFrame, model: DataFrame, text: str) -> DataFrame:
    """For a table that is too large to be sent: each document's trigrams with their counts are joined."""
    names = [f.split()[0] for f in FIELDS.split(", ")]
    rows = stored(
        docs.drop(*[c for c in docs.columns if c.lower() in names])
        .withColumn("lm_row", F.monotonically_increasing_id()),
        "scored-rows",
    )

    def run(batches):
        for batch in batches:
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams, n = np.unique(trigrams([value or ""])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(grams), row)), pa.array(grams), pa.array(n.astype(np.int64))],
                    names=["lm_row", "gram", "n"],
                )

    each = rows.select("lm_row", F.col(f"`{text}`").alias("text")).mapInArrow(run, "lm_row bigint, gram bigint, n bigint")
    known = each.join(model, "gram", "left").withColumn(
        "target_loss", F.coalesce("target_loss", F.raise_error(F.lit(FOREIGN)).cast("double"))
    )
    sums = known.groupBy("lm_row").agg(
        F.sum("n").alias("n_tokens"), F.sum(F.col("n") * F.col("target_loss")).alias("target_loss"),
        F.sum(F.col("n") * F.col("background_loss")).alias("background_loss"),
    )
    mean = {c: F.col(c) / F.col("n_tokens") for c in ("target_loss", "background_loss")}
    return (
        rows.join(sums, "lm_row", "left").drop("lm_row").withColumns(mean)
        .withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0).cast("long")))
        .withColumn("score", F.col("target_loss") - F.col("background_loss"))
    )
