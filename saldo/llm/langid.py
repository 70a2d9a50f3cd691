"""Language mixture of a document by expectation-maximisation.

The model holds, for every language seen in training, how often each letter stands between its two
neighbours (a letter trigram; the border of a word is a neighbour too). A word's likelihood under a
language is the product over its letters. A document is a mixture: each word comes from one of the
languages. Expectation-maximisation estimates the proportions, for growing sets of languages, and
the set with the best penalised likelihood is taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import map_columns

#: Trigrams share this many slots by hash, so the model has 4 MB for 16 languages, whatever the
#: corpus. All documents are counted.
SLOTS = 1 << 16
#: Rounds of the estimate over all languages, then over each set.
ROUNDS, SET_ROUNDS = 12, 4
#: Letters handled at once, which bounds a task's memory.
AT_ONCE = 1 << 20
UNKNOWN = "und"

_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _LETTER


def slots(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The slot of each letter's trigram, and for each word where its letters begin."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    letter = _letters()[points]
    framed = np.zeros(len(points) + 2, np.uint64)
    framed[1:-1] = np.where(letter, points, 0)
    at = np.flatnonzero(letter)
    hashed = (framed[at] * np.uint64(0x9E3779B1) ^ framed[at + 1] * np.uint64(0x85EBCA77)) * np.uint64(0xC2B2AE3D)
    hashed = (hashed ^ framed[at + 2] * np.uint64(0x27D4EB2F165667C5)) * np.uint64(0x9E3779B97F4A7C15)
    return (hashed >> np.uint64(48)).astype(np.int64), np.flatnonzero(framed[at] == 0)


def counts(docs: DataFrame) -> DataFrame:
    """docs (lang, text), both non-null -> lang, slot, n: one row per slot in use."""

    def run(batches):
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                one = sums.setdefault(lang, np.zeros(SLOTS, np.int64))
                found = slots(text)[0]
                if len(found) > SLOTS:
                    one += np.bincount(found, minlength=SLOTS)
                else:
                    np.add.at(one, found, 1)
            for lang, one in sums.items():
                used = np.flatnonzero(one)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(one[used])],
                    names=["lang", "slot", "n"],
                )

    each = docs.select("lang", "text").mapInArrow(run, "lang string, slot bigint, n bigint")
    return each.groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages in order, and the log-likelihoods, one row per slot and column per language.

    Collects one number per language and slot in use.
    """
    rows = counts(docs.where("lang IS NOT NULL AND text IS NOT NULL")).toPandas()
    langs = sorted(rows["lang"].unique())
    table = np.full((SLOTS, len(langs)), 0.5)
    place = rows["lang"].map({lang: i for i, lang in enumerate(langs)}).to_numpy(int)
    table[rows["slot"].to_numpy(), place] += rows["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32)


def _estimate(likely: np.ndarray, starts: np.ndarray, sizes: np.ndarray, share: np.ndarray, rounds: int):
    """Proportions after so many rounds, and the log-likelihood of each document before the last."""
    level = np.zeros(len(sizes))
    for _ in range(rounds):
        joint = likely * np.repeat(share, sizes, axis=0)
        total = np.maximum(joint.sum(axis=1), 1e-30)
        level = np.add.reduceat(np.log(total), starts)
        joint /= total[:, None]
        share = np.add.reduceat(joint, starts, axis=0) / sizes[:, None]
    return share, level


def mixture(model: np.ndarray, texts: list[str], penalty: float = 1.0) -> np.ndarray:
    """Proportions of the languages in each text; zeros where there is no letter."""
    result = np.zeros((len(texts), model.shape[1]))
    if not model.shape[1]:
        return result
    cut = [slots(t) for t in texts]
    full = [i for i, (s, _) in enumerate(cut) if len(s)]
    if not full:
        return result
    sizes = np.array([len(cut[i][1]) for i in full])
    letters = np.concatenate([cut[i][0] for i in full])
    shift = np.cumsum([0] + [len(cut[i][0]) for i in full])[:-1]
    words = np.concatenate([cut[i][1] + s for i, s in zip(full, shift)])
    by_word = np.add.reduceat(model[letters], words, axis=0)
    likely = np.exp(np.maximum(by_word - by_word.max(axis=1, keepdims=True), -60)).astype(np.float32)
    starts = np.cumsum(sizes) - sizes
    n = model.shape[1]
    share, level = _estimate(likely, starts, sizes, np.full((len(full), n), 1 / n, np.float32), ROUNDS)
    order = np.argsort(-share, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    best, best_value = share, np.full(len(full), np.inf)
    for k in range(1, n + 1):
        inside = np.where(rank < k, np.maximum(share, 1e-9), 0).astype(np.float32)
        inside /= inside.sum(axis=1, keepdims=True)
        tried, level = _estimate(likely, starts, sizes, inside, SET_ROUNDS if k > 1 else 1)
        value = -2 * level + penalty * k * np.log(sizes + 1)
        better = value < best_value
        best = np.where(better[:, None], tried, best)
        best_value = np.where(better, value, best_value)
    result[full] = best
    return result


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """docs with lang_pred, score and proportions; only the text is looked at.

    lang_pred is the language with the largest proportion, the first by name in a tie; score is its
    proportion. Null texts, texts without a letter and any text under a model without languages
    are `und` with score 0 and no proportions. All rows and columns stay; a column named like a
    result is replaced by it.
    """
    langs, table = model
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def make(column: pa.Array) -> dict[str, pa.Array]:
        texts = [t or "" for t in column.to_pylist()]
        parts, begin, letters = [], 0, 0
        for i, t in enumerate(texts):
            letters += len(t)
            if letters >= AT_ONCE or i + 1 == len(texts):
                parts.append(mixture(sent.value, texts[begin : i + 1]))
                begin, letters = i + 1, 0
        share = np.concatenate(parts) if parts else np.zeros((0, len(langs)))
        top = share.argmax(axis=1) if langs else np.zeros(len(texts), int)
        score = share.max(axis=1) if langs else np.zeros(len(texts))
        known = score > 0
        return {
            "lang_pred": pa.array([langs[i] if k else UNKNOWN for i, k in zip(top, known)], pa.string()),
            "score": pa.array(np.minimum(score, 1.0), pa.float64()),
            "proportions": pa.array(
                [[(langs[i], float(p)) for i, p in enumerate(row) if p > 0.0005] for row in share],
                pa.map_(pa.string(), pa.float64()),
            ),
        }

    return map_columns(docs, [text], make, "lang_pred string, score double, proportions map<string,double>")
