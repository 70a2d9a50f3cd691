"""Exact removal of repeated byte strings, over a prefix-free parse of the corpus.

Removed is every byte of a string of LENGTH bytes that also starts earlier in the corpus. A rolling
hash over GRAM bytes sets triggers: the smallest hash among the GRAM-byte strings of a window of
LENGTH bytes is that window's trigger. Neighbouring windows with one trigger form a phrase, so the
phrases overlap, every window lies whole in exactly one of them, and where two windows are
equal, so are their triggers and their places relative to them.

1. Dictionary. Phrases are brought together by the hash of their trigger. Of equal phrases the
   first in the corpus goes to the dictionary; all windows of the others are repeats. A phrase
   whose trigger no other phrase of the dictionary has is done.
2. Suffixes. Of the remaining phrases all suffixes of LENGTH bytes or more are sorted; what follows
   the first LENGTH bytes does not matter, so they are sorted by the 128-bit hash of these. Of
   equal suffixes all but the first in the corpus are repeats.
3. Corpus order. The removed windows are put together per document.

The parse needs no suffix array of its own: since phrases overlap by LENGTH - 1 bytes, no repeat
of LENGTH bytes depends on which phrase follows, only on where a phrase stands.

A trigger that very many different phrases share (a line common to many documents) would be one large
group. Where a batch meets over HOT of them, its phrases are brought together by trigger and
content instead, and their suffixes by their own hash; two of them stand for the others under the
trigger, so that its remaining phrases learn of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saldo.llm.common import stored

LENGTH, GRAM = 100, 20
#: Bytes of text handled at once; a longer text is cut into pieces that overlap by one byte less than a repeat.
PIECE = 1 << 19
#: Bytes of text whose phrases are compared in memory before they are sent on.
CHUNK = 32 << 20
#: Different phrases of one trigger, per batch, from which it counts as hot; and per partition.
HOT, HOT_TOTAL = 48, 20_000
#: Rows a partition holds in memory at once: phrases, and then suffixes.
PHRASES, SUFFIXES = 400_000, 1_000_000

_BASES = (np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xC2B2AE3D27D4EB4F))
_LAST = np.iinfo(np.int64).max
PHRASE, HOT_PHRASE, STAND_IN, SPAN = 0, 1, 2, 3


def _inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


class _Powers:
    """Powers of a base and of its inverse modulo 2^64, as many as asked for."""

    def __init__(self, base: np.uint64):
        self.base, self.size = base, 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, 2 * self.size)
            self.up, self.down = (
                np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.size - 1, b, np.uint64)]), dtype=np.uint64)
                for b in (self.base, _inverse(self.base))
            )
        return self.up[:n], self.down[:n]


_POWERS = [_Powers(b) for b in _BASES]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sums(data: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which the hash of any substring follows."""
    up, down = _POWERS[which].upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums, down


def _hash(sums: tuple[np.ndarray, np.ndarray], begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    total, down = sums
    return _mixed((total[end] - total[begin]) * down[begin])


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every window of so many values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def phrases(data: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """Phrases of the pieces data[bounds[i]:bounds[i + 1]].

    Returns piece, first window (relative to the piece), number of windows, trigger hash, content hash.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    triggers = _sums(data, 0)
    at = np.arange(len(data) - gram + 1)
    grams = _hash(triggers, at, at + gram)
    keys = (grams >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    chosen = (_sliding_minimum(keys, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    piece = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    starts = np.flatnonzero(piece[: len(chosen)] == piece[length - 1 :])
    if not len(starts):
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    chosen, piece = chosen[starts], piece[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    begin, trigger = starts[first], chosen[first]
    content = _hash(_sums(data, 1), begin, begin + count + length - 1)
    content = _mixed(content ^ (trigger - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ count.astype(np.uint64))
    return piece[first], begin - bounds[piece[first]], count, grams[trigger], content


def _groups(*keys: np.ndarray) -> np.ndarray:
    """For sorted keys, the number of the group of each row."""
    new = np.zeros(len(keys[0]), bool)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.cumsum(new)


def _first_and_later(group: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by group, document and place: the first of each group, and those elsewhere.

    A row at the very place of the first is the same row of a document given twice, and neither.
    """
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    head = np.flatnonzero(first)[np.cumsum(first) - 1] if len(group) else np.zeros(0, np.int64)
    return first, (doc != doc[head]) | (place != place[head])


def _runs(doc: np.ndarray, place: np.ndarray, count: np.ndarray):
    """Runs of windows that follow one another in a document, put together."""
    order = np.lexsort((place, doc))
    doc, place, count = doc[order], place[order], count[order]
    if not len(doc):
        return doc, place, count
    end = place + count
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] > end[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], place[first], end[last] - place[first]


def _table(**columns: np.ndarray) -> pa.RecordBatch:
    arrays = {k: pa.array(v.view(np.int64) if isinstance(v, np.ndarray) and v.dtype == np.uint64 else v) for k, v in columns.items()}
    return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))


def _portions(batches, limit: int, length: int):
    """(doc, text) batches as lists of (doc, offset, bytes) of some limited size, each window of length whole in one."""
    part, size = [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = (text or "").encode()
            for begin in range(0, max(1, len(raw) - length + 1), limit):
                part.append((doc, begin, raw[begin : begin + limit + length - 1]))
                size += len(part[-1][2])
                if size >= limit:
                    yield part
                    part, size = [], 0
        if part:
            yield part
            part, size = [], 0


def _parse(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """docs (doc, text) -> route, content, doc, place: phrases on their way to the dictionary.

    place holds the first window, the kind and the number of windows. Of the phrases that a batch
    meets more than once, only the first goes on; the others are spans right away.
    """

    def run(batches):
        found, size = [], 0
        for part in _portions(batches, PIECE, length):
            data = np.frombuffer(b"".join(p[2] for p in part), np.uint8)
            bounds = np.cumsum([0] + [len(p[2]) for p in part])
            piece, begin, count, trigger, content = phrases(data, bounds, length, gram)
            doc, offset = (np.array([p[i] for p in part], np.int64)[piece] for i in (0, 1))
            found.append((trigger, content, doc, begin + offset, count))
            size += len(data)
            if size >= CHUNK:
                yield from sent(found)
                found, size = [], 0
        if found:
            yield from sent(found)

    def sent(found):
        trigger, content, doc, place, count = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((place, doc, content, trigger))
        trigger, content, doc, place, count = (c[order] for c in (trigger, content, doc, place, count))
        first, later = _first_and_later(_groups(trigger, content), doc, place)
        gone = _runs(doc[later], place[later], count[later])
        trigger, content, doc, place, count = (c[first] for c in (trigger, content, doc, place, count))
        under = _groups(trigger)
        hot = np.bincount(under, minlength=1)[under] > HOT if len(under) else np.zeros(0, bool)
        packed = place << 10 | count
        yield _table(route=trigger[~hot], content=content[~hot], doc=doc[~hot], place=packed[~hot])
        yield _table(
            route=_mixed(trigger[hot] ^ content[hot]), content=content[hot], doc=doc[hot],
            place=packed[hot] | HOT_PHRASE << 8,
        )
        stand = hot & (np.arange(len(under)) - np.searchsorted(under, under) < 2)
        yield _table(route=trigger[stand], content=content[stand], doc=doc[stand], place=packed[stand] | STAND_IN << 8)
        yield _table(route=_mixed(gone[0].view(np.uint64)), content=gone[2], doc=gone[0], place=gone[1] << 10 | SPAN << 8)

    return docs.mapInArrow(run, "route bigint, content bigint, doc bigint, place bigint")


def _dictionary(parsed: DataFrame, partitions: int) -> DataFrame:
    """-> doc, place, n, kind, route: SPAN for repeats, PHRASE and HOT_PHRASE for what is left to sort."""

    def run(batches):
        table = _whole(batches, _PARSED)
        route, content, doc, packed = (table.column(i).to_numpy() for i in range(4))
        kind, place, count = packed >> 8 & 3, packed >> 10, packed & 255
        spans = kind == SPAN
        out = [(doc[spans], place[spans], content[spans], SPAN, route[spans])]
        route, content, doc, place, count, kind = (c[~spans] for c in (route, content, doc, place, count, kind))
        order = np.lexsort((place, doc, content, route))
        route, content, doc, place, count, kind = (c[order] for c in (route, content, doc, place, count, kind))
        group, under = _groups(route, content), _groups(route)
        first, later = _first_and_later(group, doc, place)
        real = kind != STAND_IN
        gone = later & real
        out.append((*_runs(doc[gone], place[gone], count[gone]), SPAN, None))
        if len(under):
            different = np.bincount(under, first)[under]
            hot = (np.bincount(under, kind == STAND_IN)[under] > 0) | (different > HOT_TOTAL) | (kind == HOT_PHRASE)
            left = first & real & ((different > 1) | (kind == HOT_PHRASE))
            for which, chosen in ((PHRASE, left & ~hot), (HOT_PHRASE, left & hot)):
                out.append((doc[chosen], place[chosen], count[chosen], which, route[chosen]))
        for d, p, n, k, r in out:
            yield _table(doc=d, place=p, n=n, kind=np.full(len(d), k), route=np.zeros(len(d), np.int64) if r is None else r)

    return parsed.repartition(partitions, "route").mapInArrow(
        run, "doc bigint, place bigint, n bigint, kind bigint, route bigint"
    )


_PARSED = pa.schema([(c, pa.int64()) for c in ("route", "content", "doc", "place")])
_SUFFIXES = pa.schema([("route", pa.int64()), ("other", pa.int64()), ("doc", pa.int64()), ("place", pa.int64()), ("piece", pa.binary())])


def _whole(batches, schema: pa.Schema) -> pa.Table:
    """A partition in one table; its size is bounded by the number of partitions."""
    batches = list(batches)
    return pa.Table.from_batches(batches) if batches else schema.empty_table()


def _windows(pieces: list[bytes], doc: np.ndarray, place: np.ndarray, length: int):
    """The suffixes of phrases, cut after length bytes: two hashes, document and place of each."""
    out = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    begin = 0
    while begin < len(pieces):
        end, size = begin, 0
        while end < len(pieces) and size < PIECE:
            size += len(pieces[end])
            end += 1
        sizes = np.array([len(p) for p in pieces[begin:end]])
        windows = sizes - length + 1
        within = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        at = np.repeat(np.cumsum(sizes) - sizes, windows) + within
        data = np.frombuffer(b"".join(pieces[begin:end]), np.uint8)
        one, two = (_hash(_sums(data, w), at, at + length) for w in (0, 1))
        out.append((one, two >> np.uint64(1), np.repeat(doc[begin:end], windows), np.repeat(place[begin:end], windows) + within))
        begin = end
    return tuple(np.concatenate(c) for c in zip(*out))


def _suffixes(texts: DataFrame, length: int) -> DataFrame:
    """texts (doc, packed, open) -> phrases with their bytes, by trigger; suffixes of hot ones by hash.

    open: array of (place, n, kind, route). A suffix that a batch meets again goes on as a span,
    which has no piece and a negative other: the number of windows.
    """

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            found: dict[int, list] = {PHRASE: [], HOT_PHRASE: []}
            for doc, packed, rows in zip(*(batch.column(i).to_pylist() for i in range(3))):
                raw = unpack.decompress(packed)
                for row in rows:
                    piece = raw[row["place"] : row["place"] + row["n"] + length - 1]
                    found[row["kind"]].append((row["route"], 0, doc, row["place"], piece))
            cold = list(zip(*found[PHRASE])) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cold, _SUFFIXES)], schema=_SUFFIXES)
            if found[HOT_PHRASE]:
                _, _, doc, place, pieces = zip(*found[HOT_PHRASE])
                one, two, doc, place = _windows(list(pieces), np.array(doc), np.array(place), length)
                first, gone = _first_of_equal(one, two, doc, place)
                kept = one[first], two[first], doc[first], place[first]
                spans = _mixed(gone[0].view(np.uint64)), -gone[2], gone[0], gone[1]
                for columns in (kept, spans):
                    arrays = [pa.array(c.view(np.int64)) for c in columns]
                    yield pa.RecordBatch.from_arrays([*arrays, pa.nulls(len(columns[0]), pa.binary())], schema=_SUFFIXES)

    return texts.mapInArrow(run, "route bigint, other bigint, doc bigint, place bigint, piece binary")


def _first_of_equal(one, two, doc, place):
    """Places in the arrays of the first of equal suffixes; runs of the others."""
    order = np.lexsort((place, doc, two, one))
    first, later = _first_and_later(_groups(one[order], two[order]), doc[order], place[order])
    gone = order[later]
    return order[first], _runs(doc[gone], place[gone], np.ones(len(gone), np.int64))


def _sorted_suffixes(suffixes: DataFrame, partitions: int, length: int) -> DataFrame:
    """-> doc, place, n: the repeats among the suffixes of the dictionary."""

    def run(batches):
        table = _whole(batches, _SUFFIXES)
        route, other, doc, place = (table.column(i).to_numpy() for i in range(4))
        whole = table.column(4).is_valid().to_numpy()
        spans = ~whole & (other < 0)
        yield _table(doc=doc[spans], place=place[spans], n=-other[spans])
        single = ~whole & (other >= 0)
        alone = route[single].view(np.uint64), other[single].view(np.uint64), doc[single], place[single]
        pieces = table.column(4).filter(pa.array(whole)).to_pylist()
        cut = _windows(pieces, doc[whole], place[whole], length)
        _, gone = _first_of_equal(*(np.concatenate(c) for c in zip(alone, cut)))
        yield _table(doc=gone[0], place=gone[1], n=gone[2])

    return suffixes.repartition(partitions, "route").mapInArrow(run, "doc bigint, place bigint, n bigint")


def _packed(docs: DataFrame) -> DataFrame:
    """docs (doc, text, ...) with packed, the compressed bytes of the text, for the shuffle."""
    names = [c for c in docs.columns if c != "text"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            raw = batch.column(batch.schema.get_field_index("text")).to_pylist()
            arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
            made = pa.array([pack.compress((t or "").encode()) for t in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([*arrays, made], names=[*names, "packed"])

    return docs.mapInArrow(run, f"{fields}, packed binary")


def _in_order(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with doc, a number by which the documents are in order.

    That is the id itself where ids are unique and none is null, or else the place among the distinct
    pairs of id and text, null ids last: pairs are dealt to ranges, and ranges are counted first.
    """
    ids = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    doubtful = ids.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if doubtful.isEmpty():
        return docs.withColumn("doc", F.col("doc_id").cast("long"))
    pairs = ids.distinct()
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_hash").asc()]
    dealt = stored(pairs.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("range").count().select("range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    places = dealt.withColumn("nth", nth).join(before, "range").select(
        F.col("doc_id").alias("of"), "text_hash", (F.col("before") + F.col("nth")).alias("doc")
    )
    same = docs["doc_id"].eqNullSafe(F.col("of")) & (F.xxhash64(docs["text"]) == F.col("text_hash"))
    return stored(docs.join(stored(places, "places"), same).select("doc", "doc_id", "text"), "in-order")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, kept (the bytes that stay), spans (begin, end of each removed run).

    Texts are UTF-8 bytes, null ones empty. Earlier means a smaller id, or the same document and an
    earlier start. Rows with equal id and different texts are in the order of a hash of the text;
    equal rows are one document given twice and get equal results; null ids are last. Texts
    shorter than length stay whole. kept may cut a character, as bytes are what is removed. Other
    columns of docs are not read.
    """
    if not (8 <= gram < length and length - gram < 250):
        raise ValueError("a phrase must have 1 to 250 windows, a trigger 8 bytes or more")
    docs = _in_order(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    per_phrase = (length - gram + 2) / 2
    partitions = max(1, -(-int(total / per_phrase) // PHRASES))
    found = stored(_dictionary(_parse(docs.select("doc", "text"), length, gram), partitions), "dictionary")
    left = found.where(F.col("kind") != SPAN)
    n_left = left.agg(F.sum("n")).first()[0] or 0
    spans = found.where(F.col("kind") == SPAN).select("doc", "place", "n")
    if n_left:
        entry = F.struct("place", "n", "kind", "route")
        to_sort = stored(left.groupBy("doc").agg(F.collect_list(entry).alias("open")), "open")
        texts = _packed(docs.select("doc", "text")).join(to_sort.hint("shuffle_hash"), "doc").select("doc", "packed", "open")
        partitions = max(1, -(-n_left // SUFFIXES))
        repeats = _sorted_suffixes(_suffixes(texts, length), partitions, length)
        spans = spans.union(stored(repeats, "repeats"))
    by_doc = stored(
        spans.groupBy("doc").agg(F.collect_list(F.struct("place", "n")).alias("gone")), "gone"
    )

    def finish(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            kept, cut, sizes = [], [], []
            packed, gone = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("packed", "gone"))
            for raw, rows in zip(packed, gone):
                raw = unpack.decompress(raw)
                sizes.append(len(raw))
                stay, runs = remove(raw, [(r["place"], r["n"] + length - 1) for r in rows or []])
                kept.append(stay)
                cut.append([{"begin": a, "end": b} for a, b in runs])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()),
                    pa.array(cut, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                ],
                names=["doc_id", "n_bytes", "kept", "spans"],
            )

    whole = _packed(docs.select("doc", "doc_id", "text")).join(by_doc.hint("shuffle_hash"), "doc", "left")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return whole.select("doc_id", "packed", "gone").mapInArrow(
        finish, f"doc_id {kind}, n_bytes bigint, kept binary, spans array<struct<begin:bigint,end:bigint>>"
    )


def remove(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """raw without its spans (begin, length), and the spans put together."""
    runs: list[tuple[int, int]] = []
    for begin, size in sorted(spans):
        if runs and begin <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], begin + size))
        else:
            runs.append((begin, begin + size))
    kept, at = [], 0
    for begin, end in runs:
        kept.append(raw[at:begin])
        at = end
    return b"".join([*kept, raw[at:]]), runs
