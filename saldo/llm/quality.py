"""Quality rules by compression bands.

A text that zstandard shrinks far more than prose of its length repeats itself; one that it hardly
shrinks is noise. Both the whole text and its fixed chunks are compressed. Short texts compress
worse, and so do alphabets of shorter characters, so each length and kind of script has its own band.

The bands are learnt from the corpus itself: ``learn`` counts the ratios of all its texts and puts the
limits a fixed number of deviations around the median of each length and script. The deviation comes
from the quartiles, so what a corpus holds of junk, up to a fourth on either side, does not move it.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import WORD, map_columns

_WORD = re.compile(WORD)
_NO_SYMBOL = str.maketrans("", "", "#*$%&|<>")


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio compressed / raw bytes.

    whole: (up to so many bytes, least ratio, largest ratio), the first that fits; the base rules
    leave no text under 99 bytes.
    chunk_bytes, chunk: the band of fixed chunks, all of that size.
    max_bad_chunks: the share of chunks outside their band above which the text is rejected.

    The limits lie around the 3,243 documents of sf0.1 that pass the base rules and are labelled
    quality 1, per length: some 0.01 below their least ratio, 0.02 above their largest. Their chunks
    have 0.467..0.529; base64 has 0.78, prose with a third of it scattered 0.59. Above 50,000 bytes
    there were too few, so the last band is wider; up to 200 bytes there were none, so heads of the
    same documents were measured, of which some 2% lie outside. The limits hold for prose in Latin
    letters.
    """

    whole: tuple[tuple[float, float, float], ...] = (
        (115, 0.75, 0.955),
        (130, 0.72, 0.91),
        (145, 0.70, 0.875),
        (160, 0.685, 0.85),
        (175, 0.67, 0.83),
        (190, 0.655, 0.815),
        (200, 0.645, 0.80),
        (300, 0.60, 0.78),
        (400, 0.57, 0.75),
        (500, 0.535, 0.73),
        (600, 0.53, 0.70),
        (800, 0.515, 0.695),
        (1_000, 0.50, 0.645),
        (1_300, 0.485, 0.605),
        (1_600, 0.475, 0.585),
        (2_000, 0.46, 0.565),
        (2_500, 0.46, 0.54),
        (3_000, 0.455, 0.53),
        (4_000, 0.445, 0.515),
        (5_000, 0.43, 0.495),
        (7_000, 0.425, 0.49),
        (10_000, 0.415, 0.475),
        (14_000, 0.41, 0.465),
        (20_000, 0.40, 0.46),
        (50_000, 0.395, 0.45),
        (float("inf"), 0.38, 0.55),
    )
    #: Limits (whole, chunk) by script; the ones above and below where a script is not named.
    scripts: tuple[tuple[int, tuple[tuple[float, float, float], ...], tuple[float, float]], ...] = ()
    chunk_bytes: int = 2_048
    chunk: tuple[float, float] = (0.455, 0.56)
    max_bad_chunks: float = 0.2
    level: int = 3

    def limits(self, script: int) -> tuple[tuple[tuple[float, float, float], ...], tuple[float, float]]:
        """Bands of whole texts by length, and of chunks."""
        return next(((whole, chunk) for s, whole, chunk in self.scripts if s == script), (self.whole, self.chunk))


def script_of(text: str, raw: bytes) -> int:
    """1, 2 or 3: how many bytes most characters take, as in Latin, Cyrillic, or Han texts."""
    return min(3, max(1, round(len(raw) / len(text)))) if text else 1


def chunks_of(raw: bytes, size: int) -> list[bytes]:
    """Fixed chunks; the last one is the last so many bytes, as one of another size would need another
    band. A text of a single chunk has none: it is the whole text."""
    if len(raw) <= size:
        return []
    return [raw[i : i + size] for i in range(0, len(raw) - size, size)] + [raw[-size:]]


def word_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines, words in repeated 3-word windows."""
    if not text:
        return 0, 0, 0, 0, 0
    words = _WORD.findall(text)
    seen: set[str] = set()
    repeated_lines = 0
    for line in text.split("\n"):
        if line in seen:
            repeated_lines += 1
        elif _WORD.search(line):
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    covered = 0
    if len(set(windows)) < len(windows):
        times, end = Counter(windows), 0
        for start, window in enumerate(windows):
            if times[window] > 1:
                covered += start + 3 - max(start, end)
                end = start + 3
    symbols = len(text) - len(text.translate(_NO_SYMBOL))
    return len(words), sum(map(len, words)), symbols, repeated_lines, covered


class Compression:
    """Ratios of one text; the compressor is reused."""

    def __init__(self, bands: Bands):
        self.bands = bands
        self.zstd = zstandard.ZstdCompressor(level=bands.level)

    def ratio(self, raw: bytes) -> float:
        return len(self.zstd.compress(raw)) / len(raw) if raw else 0.0

    def judge(self, text: str | None) -> tuple[float, float, bool]:
        """Ratio of the whole text, share of chunks outside the band, verdict."""
        raw = (text or "").encode("utf-8", "replace")
        whole = self.ratio(raw)
        bands, (low, high) = self.bands.limits(script_of(text or "", raw))
        chunks = chunks_of(raw, self.bands.chunk_bytes)
        bad = sum(not low <= self.ratio(c) <= high for c in chunks) / len(chunks) if chunks else 0.0
        _, least, most = next(b for b in bands if len(raw) <= b[0])
        return whole, bad, least <= whole <= most and bad <= self.bands.max_bad_chunks


#: Ratios are counted in steps of this size. Texts of a length and script that are enough for a band; with
#: fewer, those of the next lengths count too, and with fewer of a script in all, those of all scripts.
STEP, ENOUGH = 0.0025, 50
#: Limits lie so many deviations from the median, and at least so far for whole texts and for chunks.
DEVIATIONS, LEAST_WHOLE, LEAST_CHUNK = 4.0, 0.04, 0.05
#: Texts under this size cannot pass the base rules and are not counted.
SHORTEST = 99
_CHUNK = -1


def _histogram(docs: DataFrame, text: str, bands: Bands) -> DataFrame:
    """How many texts (by length) and chunks (length _CHUNK) of each script have each ratio."""
    edges = [edge for edge, _, _ in bands.whole]

    def run(batches):
        compression, found = Compression(bands), Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                raw = (value or "").encode("utf-8", "replace")
                if len(raw) < SHORTEST:
                    continue
                script = script_of(value, raw)
                length = next(i for i, edge in enumerate(edges) if len(raw) <= edge)
                found[script, length, int(compression.ratio(raw) / STEP)] += 1
                for chunk in chunks_of(raw, bands.chunk_bytes):
                    found[script, _CHUNK, int(compression.ratio(chunk) / STEP)] += 1
        keys = list(zip(*found)) if found else [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(k, pa.int32()) for k in keys], pa.array(list(found.values()), pa.int64())],
            names=["script", "length", "step", "n"],
        )

    each = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "script int, length int, step int, n bigint")
    return each.groupBy("script", "length", "step").agg(F.sum("n").alias("n"))


def _limits(counts: np.ndarray, least: float) -> tuple[float, float]:
    """Limits around the median of counted ratios."""
    share = np.cumsum(counts) / counts.sum()
    first, middle, third = (STEP * (np.searchsorted(share, q) + 0.5) for q in (0.25, 0.5, 0.75))
    below, above = (max(least, DEVIATIONS * gap / 0.6745) for gap in (middle - first, third - middle))
    return float(max(0.0, middle - below)), float(middle + above)


def learn(docs: DataFrame, text: str = "text", bands: Bands = Bands()) -> Bands:
    """Bands for this corpus, from the ratios of all its texts of 99 bytes or more.

    Collected are counts per script, length and step of the ratio, some thousands however large the
    corpus is. Null texts are not counted; repeated rows count each time. A script of which the corpus has
    hardly any text, such as the mixture that noise makes of another one, has the limits of all texts
    together. A corpus with fewer than ENOUGH texts has no limits, so that all of them are kept.
    """
    n_steps = int(4 / STEP)
    counts = np.zeros((4, len(bands.whole) + 1, n_steps), np.int64)  # the last length: chunks
    for r in _histogram(docs, text, bands).collect():
        counts[r.script, r.length, min(r.step, n_steps - 1)] += r.n
    scripts = []
    for script in (1, 2, 3):
        own = counts[script] if counts[script, :-1].sum() >= ENOUGH else counts.sum(axis=0)
        by_length, of_chunks = own[:-1], own[_CHUNK]
        whole = []
        for i, (edge, _, _) in enumerate(bands.whole):
            reach = 0
            while reach < len(bands.whole) and by_length[max(0, i - reach) : i + reach + 1].sum() < ENOUGH:
                reach += 1
            near = by_length[max(0, i - reach) : i + reach + 1].sum(axis=0)
            whole.append((edge, *(_limits(near, LEAST_WHOLE) if near.sum() >= ENOUGH else (0.0, 9.0))))
        chunk = _limits(of_chunks, LEAST_CHUNK) if of_chunks.sum() >= ENOUGH else (0.0, 9.0)
        scripts.append((script, tuple(whole), chunk))
    return Bands(
        whole=bands.whole, scripts=tuple(scripts), chunk_bytes=bands.chunk_bytes, chunk=bands.chunk,
        max_bad_chunks=bands.max_bad_chunks, level=bands.level,
    )


def quality(docs: DataFrame, text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """All rows and columns of docs, with the counts, the ratios and the verdict of each text.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words: see word_counts. base_failed: under
    50 words, or over half of the words in repeated windows. zstd_ratio, bad_chunks: see
    Compression. kept: not base_failed and inside the bands. Null and empty texts have zeros, fail
    the base rules and are not kept. Rows are judged one by one, so order, ties and repeated rows do
    not matter; columns of docs named like a result are replaced by it. ``bands`` should be learnt from
    the corpus; the default ones are those of one corpus of Latin prose.
    """

    def make(texts: pa.Array) -> dict[str, pa.Array]:
        compression = Compression(bands)
        rows = []
        for value in texts.to_pylist():
            counts = word_counts(value)
            whole, bad, inside = compression.judge(value)
            failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
            rows.append((*counts, whole, bad, failed, inside and not failed))
        columns = list(zip(*rows)) if rows else [()] * 9
        kinds = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2
        return {n: pa.array(c, k) for n, c, k in zip(NAMES, columns, kinds)}

    return map_columns(docs, [text], make, FIELDS)


FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, zstd_ratio double, bad_chunks double, base_failed boolean, kept boolean"
)
NAMES = [f.split()[0] for f in FIELDS.split(", ")]
