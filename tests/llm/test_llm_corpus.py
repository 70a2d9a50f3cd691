"""Operators over the whole corpus, against brute force."""

import random
import re
from collections import Counter, defaultdict
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F

from saldo.llm import jaccard, langid, lmscore
from saldo.llm.jaccard import floor_level, near_duplicates, without_near_duplicates
from saldo.llm.mihash import top_k, with_code
from saldo.llm.mixing import mix, mixed
from saldo.llm.repeats import without_repeats

DOC = "doc_id long, text string"


def sentence(pick, n):
    return " ".join("".join(pick.choice("etaoinshrdlu") for _ in range(pick.randint(2, 8))) for _ in range(n))


# --- Hamming search ----------------------------------------------------------------------------


def test_nearest_codes(spark):
    pick = random.Random(1)
    centres = [pick.getrandbits(64) for _ in range(8)]
    codes = [pick.choice(centres) ^ (1 << pick.randrange(64)) * pick.randint(0, 1) for _ in range(120)]
    codes += [pick.getrandbits(64) for _ in range(150)] + [centres[0]] * 40
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    rows = list(enumerate(signed))
    base = spark.createDataFrame([*rows, (None, 5), (7000, None)], "id long, code long")
    found = defaultdict(list)
    # Small blocks, so that answers are put together from several tasks.
    for r in top_k(base, base.where("id % 10 = 0"), k=7, code_block=60, query_block=9).collect():
        found[r.query_id].append((r.rank, r.distance, r.neighbour_id))
    assert set(found) == {i for i in range(len(codes)) if i % 10 == 0}
    for q, answers in found.items():
        best = sorted(((codes[q] ^ c).bit_count(), i) for i, c in enumerate(codes))[:7]
        assert [(d, i) for _, d, i in sorted(answers)] == best
    few = base.where("id < 3")
    assert top_k(few, few, k=5).count() == 9
    assert top_k(base.limit(0), base, k=5).count() == 0


def test_sign_codes(spark):
    rows = [(1, [0.5, -1.0, 0.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [-1.0] * 63 + [1.0])]
    frame = with_code(spark.createDataFrame(rows, "id long, v array<float>"), "v")
    assert [r.code for r in frame.orderBy("id").collect()] == [9, None, 2, -(1 << 63)]
    wide = spark.createDataFrame([(1, [1.0] * 65)], "id long, v array<float>")
    with pytest.raises(Exception, match="more than 64 elements: 65"):
        with_code(wide, "v").collect()


# --- n-gram Jaccard ----------------------------------------------------------------------------


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute_classes(rows):
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 5 * common >= 4 * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(least.get(find(i)), links[i]) for i in range(len(rows))]


def near_texts():
    pick = random.Random(5)
    rows = []
    for _ in range(40):
        words = sentence(pick, pick.randint(30, 200)).split()
        for _ in range(pick.choice([1, 1, 2, 5])):
            copy = list(words)
            for _ in range(pick.randint(0, 3)):
                copy[pick.randrange(len(copy))] = "changed"
            rows.append(" ".join(copy))
    hot = sentence(pick, 150).split()
    for i in range(600):  # more than one block
        copy = list(hot)
        copy[pick.randrange(150)] = f"w{i}"
        rows.append(" ".join(copy))
    rows += [rows[0]] * 30 + ["two words", "Two\twords", "two  words more", "one"]
    pick.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


def test_near_duplicates(spark):
    rows = near_texts()
    odd = [(9000, None), (9001, ""), (9002, " \n"), (rows[0][0], rows[0][1])]
    frame = spark.createDataFrame(rows + odd, DOC).withColumn("class_id", F.lit("x")).withColumn("nid", F.lit(1))
    wanted = Counter((doc, *c) for (doc, _), c in zip(rows + odd, brute_classes(rows + odd)))
    wanted = Counter({(d, d if c is None else c, n): k for (d, c, n), k in wanted.items()})
    found = near_duplicates(frame).collect()
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in found)
    assert sum((got - wanted).values()) + sum((wanted - got).values()) == 0
    left = without_near_duplicates(frame).collect()
    ids = sorted(r.doc_id for r in left)
    assert ids == sorted({c for _, c, _ in wanted})  # one of each class
    assert set(left[0].asDict()) == {"doc_id", "text", "class_id", "nid"}
    assert near_duplicates(frame.limit(0)).count() == 0


def test_null_ids_are_kept_apart(spark):
    frame = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (None, "z y x w v u")], DOC)
    found = {(r.doc_id, r.class_id, r.n_links, r.stays) for r in near_duplicates(frame).collect()}
    assert found == {(None, 4, 1, False), (4, 4, 1, True), (None, None, 0, True)}


def test_level_follows_from_the_recall():
    levels = [floor_level(recall=r) for r in (0.5, 0.9, 0.99, 0.9999, 0.9999999999)]
    assert levels == sorted(levels, reverse=True) and levels[0] > levels[-1]
    assert 1 - (1 - 0.8 ** levels[3]) ** 16 >= 0.9999


def test_prefixes_are_shortened_until_the_recall_is_covered():
    near = 1 / jaccard.chance(0.98, jaccard.DEPTH) - 1
    floor = floor_level()
    assert floor < jaccard.DEPTH
    # Many close copies suffice at full depth; none, few or distant ones do not.
    assert jaccard.covered(100, 100 * near, jaccard.DEPTH)
    assert not jaccard.covered(0, 0.0, jaccard.DEPTH) and not jaccard.covered(2, 2 * near, jaccard.DEPTH)
    distant = 1 / jaccard.chance(0.82, jaccard.DEPTH) - 1
    assert not jaccard.covered(100, 100 * distant, jaccard.DEPTH)
    assert jaccard.covered(0, 0.0, floor)


def test_small_blocks_lose_no_link_and_count_none_twice(spark, monkeypatch):
    """Open and done nodes of one subtree in many blocks, some of them empty."""
    pick = random.Random(21)
    rows = []
    for words, copies, changes in ((400, 40, 1), (120, 12, 3), (60, 6, 1), (80, 3, 2)):
        base = sentence(pick, words).split()
        for i in range(copies):
            copy = list(base)
            for j in range(changes):
                copy[pick.randrange(words)] = f"v{i}x{j}"
            rows.append(" ".join(copy))
    rows = list(enumerate(rows + [sentence(pick, 50) for _ in range(20)]))
    wanted = {(d, *c) for (d, _), c in zip(rows, brute_classes(rows))}
    levels = []
    met_at = jaccard._met_at

    def counted(candidates, texts, level, *rest):
        levels.append((level, candidates.where("open").count(), candidates.count()))
        return met_at(candidates, texts, level, *rest)

    monkeypatch.setattr(jaccard, "_met_at", counted)
    monkeypatch.setattr(jaccard, "BLOCK", 9)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 6_000)
    monkeypatch.setattr(jaccard, "PORTION", 50)
    found = near_duplicates(spark.createDataFrame(rows, DOC))
    assert {(r.doc_id, r.class_id, r.n_links) for r in found.collect()} == wanted
    assert [x[0] for x in levels] == list(range(jaccard.DEPTH, floor_level() - 1, -1))
    assert levels[0][1] == levels[0][2] and 0 < levels[1][1] < levels[1][2]  # the largest group is done at full depth


def test_short_signatures_are_prefixes_of_whole_ones():
    grams = jaccard.shingles(sentence(random.Random(1), 80))
    whole = np.frombuffer(jaccard.signature(grams, jaccard._seeds(jaccard.DEPTH)), ">u4").reshape(jaccard.TREES, -1)
    level = floor_level()
    part = np.frombuffer(jaccard.signature(grams, jaccard._seeds(level)), ">u4").reshape(jaccard.TREES, -1)
    assert part.shape[1] == level and (part == whole[:, :level]).all()


# --- repeats -----------------------------------------------------------------------------------


def brute_repeats(rows, length=100):
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    seen, out = set(), {}
    for i in order:
        raw = (rows[i][1] or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            window = raw[s : s + length]
            if window in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(window)
        kept = bytes(x for x, y in zip(raw, gone) if not y)
        out[rows[i][0]] = (len(raw), kept, [m.span() for m in re.finditer(b"\1+", bytes(gone))])
    return out


def repeat_texts():
    pick = random.Random(3)
    passage, line = sentence(pick, 60), sentence(pick, 12)[:60]
    texts = [sentence(pick, pick.randint(5, 120)) for _ in range(60)]
    texts += [t + " " + passage[: pick.randint(90, 300)] for t in texts[:20]]
    # A trigger that many different phrases share, and near copies of one text.
    texts += [f"{sentence(pick, 9)} {line} {sentence(pick, 9)}" for _ in range(130)]
    texts += [f"{sentence(pick, 3)} {line} {passage[:80]} {sentence(pick, 3)}" for _ in range(80)]
    words = passage.split()
    texts += [" ".join(w if pick.random() > 0.05 else "other" for w in words) for _ in range(30)]
    texts += texts[:15] + ["a" * 400, "a" * 250 + "b" * 300, "ab" * 300, "é" * 150, "x" * 100, "x" * 99, "y" * 100, "y" * 101]
    pick.shuffle(texts)
    return [(i * 2 - 50, t) for i, t in enumerate(texts)] + [(5001, None), (5003, "")]


def test_repeats(spark):
    rows = repeat_texts()
    wanted = brute_repeats(rows)
    frame = spark.createDataFrame(rows, DOC).withColumn("doc", F.lit("x")).withColumn("spans", F.lit(0))
    found = without_repeats(frame.repartition(3)).collect()
    assert len(found) == len(rows)
    for r in found:
        got = (r.n_bytes, bytes(r.kept), [(s.begin, s.end) for s in r.spans])
        assert got == wanted[r.doc_id], r.doc_id
    assert sum(len(w[2]) for w in wanted.values()) > 60
    assert without_repeats(frame.limit(0)).count() == 0


def test_repeats_with_equal_and_null_ids(spark):
    text = sentence(random.Random(8), 40)
    rows = [(1, text), (1, text), (2, text + " end"), (None, text), (3, text[:120]), (3, text[:110])]
    found = defaultdict(list)
    for r in without_repeats(spark.createDataFrame(rows, DOC)).collect():
        found[r.doc_id].append(bytes(r.kept))
    assert found[1] == [text.encode()] * 2  # one document, given twice
    assert found[2] == [b" end"] or found[2][0].endswith(b" end")
    assert found[None] == [b""] and found[3] == [b"", b""]


def test_repeats_of_another_length_at_the_border_of_a_piece(spark):
    from saldo.llm.repeats import PIECE

    pick = random.Random(13)
    noise = "".join(pick.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(PIECE + 5_000))
    # The only window of 200 bytes that occurs again begins 50 bytes before the border.
    again = noise[PIECE - 50 : PIECE + 150]
    rows = [(1, "#" + again + "#"), (2, noise)]
    wanted = brute_repeats(rows, 200)
    assert wanted[2][2] == [(PIECE - 50, PIECE + 150)]
    for r in without_repeats(spark.createDataFrame(rows, DOC), length=200).collect():
        assert (r.n_bytes, bytes(r.kept), [(s.begin, s.end) for s in r.spans]) == wanted[r.doc_id]


# --- mixing ------------------------------------------------------------------------------------


def test_mix_cuts_at_the_budget(spark):
    pick = random.Random(2)
    rows = []
    for source, n in [("a", 300), ("b", 30), ("c", 2000), (None, 40), ("e", 1), ("é", 5)]:
        rows += [(len(rows) + k, source, sentence(pick, pick.randint(0, 30))) for k in range(n)]
    rows += [(9999, "empty", None), (9998, "empty", ""), (rows[0][0], "a", rows[0][2]), (None, "a", "one two")]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("x"))
    plan = mix(frame).collect()
    assert len(plan) == len(rows)
    sizes, by_source = Counter(), defaultdict(list)
    for r in plan:
        assert r.size == len((r.text or "").split()) and all(0 <= p <= r.size for p in r.parts)
        sizes[r.source] += r.size
        by_source[r.source].append(r)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, full = {}, set()
    while True:  # share by weight, fix what is above twice its source, share the rest again
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        target = {s: 2 * sizes[s] if s in full else left * weight[s] / open_weight for s in order}
        above = {s for s in order if target[s] > 2 * sizes[s] + 1e-9}
        if not above:
            break
        full |= above
    for s in order:
        assert by_source[s][0].target == pytest.approx(target[s])
        assert abs(sum(sum(r.parts) for r in by_source[s]) - target[s]) <= 0.5
    again = mix(frame.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r.source or "", r.text or "", r.parts)
    assert sorted(map(key, plan)) == sorted(map(key, again))
    out = mixed(frame.drop("size").withColumn("n_chars", F.length("text").cast("long"))).collect()
    words = Counter()
    for r in out:
        words[r.source] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert words == +Counter({s: sum(sum(r.parts) for r in by_source[s]) for s in order})
    assert mix(frame.limit(0)).count() == 0 and mixed(frame.limit(0)).count() == 0


# --- cross-entropy difference ------------------------------------------------------------------


def test_losses_and_both_ways_of_scoring(spark):
    pick = random.Random(4)
    rows = [(i, sentence(pick, pick.randint(1, 30))) for i in range(40)] + [(90, None), (91, ""), (92, "é"), (92, "é")]
    frame = spark.createDataFrame(rows, DOC).withColumn("score", F.lit("x"))
    target = frame.where("doc_id < 10")
    model = lmscore.losses(frame, target)

    def counts(texts):
        three = Counter()
        for t in texts:
            padded = "\0\0" + (t or "")
            three.update(padded[i - 2 : i + 1] for i in range(2, len(padded)))
        return three

    both = {s: counts(t for i, t in rows if s == "b" or i < 10) for s in "bt"}
    v = len({g[2] for g in both["b"]})

    def loss(side, g):
        n = both[side]
        one, two, first = Counter(), Counter(), Counter()
        history = Counter()
        for k, c in n.items():
            one[k[2]] += c
            two[k[1:]] += c
            first[k[:2]] += c
            history[k[1]] += c
        p = (one[g[2]] + 1) / (sum(n.values()) + v)
        p = (two[g[1:]] + 8 * p) / (history[g[1]] + 8)
        return -log((n[g] + 8 * p) / (first[g[:2]] + 8))

    known = {s: {g: loss(s, g) for g in both["b"]} for s in "bt"}
    ways = [lmscore.score(frame, model, sent_rows=n).collect() for n in (10**6, 0)]
    for found in ways:
        assert len(found) == len(rows)
        texts = dict(rows)
        for r in found:
            padded = "\0\0" + (texts[r.doc_id] or "")
            own = [padded[i - 2 : i + 1] for i in range(2, len(padded))]
            assert r.n_tokens == len(own)
            if own:
                t, b = (np.mean([known[s][g] for g in own]) for s in "tb")
                assert (r.target_loss, r.background_loss, r.score) == pytest.approx((t, b, t - b))
            else:
                assert r.score is None and r.target_loss is None
    # The target is nearer to its own model.
    mean = lambda rs: np.mean([r.score for r in rs if r.score is not None])
    assert mean([r for r in ways[0] if r.doc_id < 10]) < mean([r for r in ways[0] if 10 <= r.doc_id < 90])
    empty = lmscore.losses(frame, frame.limit(0))
    assert lmscore.score(frame.limit(0), empty).count() == 0
    # A document from elsewhere is an error however large the model is.
    foreign = spark.createDataFrame([(1, "wholly новое")], DOC)
    for n in (10**6, 0):
        with pytest.raises(Exception, match=lmscore.FOREIGN):
            lmscore.score(foreign, model, sent_rows=n).collect()


# --- languages ---------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.fit(docs.where(~held).select("lang", "text"))
    found = langid.predict(docs.where(held).withColumn("Score", F.lit("x")), model).collect()
    right = sum(r.lang == r.lang_pred for r in found)
    assert right >= 0.95 * len(found) and all(0 <= r.score <= 1 for r in found)
    # A document of two languages has both, in their proportions.
    en, de = (docs.where(f"lang = '{x}' AND n_chars > 1500").first().text for x in ("en", "de"))
    odd = [(1, en[:1000] + " " + de[:500]), (2, None), (3, ""), (4, "123 !?"), (5, en)]
    rows = {r.doc_id: r for r in langid.predict(spark.createDataFrame(odd, DOC), model).collect()}
    assert rows[1].lang_pred == "en" and 0.5 < rows[1].score < 0.85 and rows[1].proportions["de"] > 0.15
    assert [(rows[i].lang_pred, rows[i].score) for i in (2, 3, 4)] == [("und", 0.0)] * 3
    assert set(rows[5].proportions) == {"en"}
    nothing = langid.fit(docs.limit(0).select("lang", "text"))
    assert {r.lang_pred for r in langid.predict(docs.limit(3), nothing).collect()} == {"und"}
