"""Feistel pseudonyms and language mixtures against plain versions of their own."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from saldo.llm import langid
from saldo.llm.pii import Pseudonyms

# --- Feistel network ---------------------------------------------------------------------------

KEY = "a key's \\ text"


def feistel(number, a, b, kind, rounds=8):
    """A keyed permutation of 0 .. a * b - 1, by plain arithmetic."""
    left, right = divmod(number, b)
    for i in range(1, rounds + 1):
        other = right if i % 2 else left
        said = "|".join(map(str, [KEY, kind, a, b, i, other]))
        step = int(hashlib.sha256(said.encode()).hexdigest()[:14], 16)
        if i % 2:
            left = (left + step) % a
        else:
            right = (right + step) % b
    return left * b + right


def inverse(number, a, b, kind, rounds=8):
    left, right = divmod(number, b)
    for i in range(rounds, 0, -1):
        other = right if i % 2 else left
        said = "|".join(map(str, [KEY, kind, a, b, i, other]))
        step = int(hashlib.sha256(said.encode()).hexdigest()[:14], 16)
        if i % 2:
            left = (left - step) % a
        else:
            right = (right - step) % b
    return left * b + right


def test_network_equals_plain_arithmetic(spark):
    pick = random.Random(3)
    for a, b in ((1, 1), (7, 5), (189, 773), (65536, 65536), (10**9, 10**9)):
        numbers = sorted({0, a * b - 1, *(pick.randrange(a * b) for _ in range(40))})
        frame = spark.createDataFrame([(n,) for n in numbers], "n long")
        made = Pseudonyms(KEY).feistel("n", f"{a}L", f"{b}L", "kind")
        found = {r.n: r.m for r in frame.selectExpr("n", f"{made} AS m").collect()}
        assert found == {n: feistel(n, a, b, "kind") for n in numbers}
        assert all(inverse(m, a, b, "kind") == n for n, m in found.items())
    assert sorted(feistel(n, 7, 5, "kind") for n in range(35)) == list(range(35))


def test_digits_equal_plain_arithmetic(spark):
    pick = random.Random(4)
    texts = ["".join(pick.choices("0123456789", k=n)) for n in range(1, 19) for _ in range(3)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in frame.selectExpr("t", f"{Pseudonyms(KEY).digits('t', 'card')} AS m").collect():
        a = 10 ** (len(r.t) // 2)
        b = 10 ** (len(r.t) - len(r.t) // 2)
        assert r.m == str(feistel(int(r.t), a, b, "card")).zfill(len(r.t))


# --- language mixture --------------------------------------------------------------------------

ALPHABETS = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "абвгде"}


def words(pick, lang, n):
    signs = ALPHABETS[lang]
    # Each language has its own habits: some letters follow others more often.
    out = []
    for _ in range(n):
        word = pick.choice(signs)
        while len(word) < pick.randint(2, 9):
            word += signs[(signs.index(word[-1]) + pick.choice([1, 1, 1, 2, 3])) % len(signs)]
        out.append(word)
    return out


def letter_trigrams(text):
    """Per word the letters with both neighbours; anything else is a border."""
    found, word = [], ""
    for sign in text.lower() + " ":
        if sign.isalpha():
            word += sign
        elif word:
            framed = " " + word + " "
            found.append([framed[i - 1 : i + 2] for i in range(1, len(framed) - 1)])
            word = ""
    return found


def plain_mixture(counts, langs, text, penalty=1.0):
    """Proportions by expectation-maximisation over growing sets, word by word."""
    slots = langid.SLOTS
    totals = {lang: sum(counts[lang].values()) + 0.5 * slots for lang in langs}
    likely = []
    for word in letter_trigrams(text):
        logs = [sum(math.log((counts[lang][g] + 0.5) / totals[lang]) for g in word) for lang in langs]
        likely.append([math.exp(max(x - max(logs), -60)) for x in logs])
    if not likely:
        return None

    def rounds(share, n):
        level = 0.0
        for _ in range(n):
            sums, level = [0.0] * len(langs), 0.0
            for row in likely:
                joint = [p * s for p, s in zip(row, share)]
                total = max(sum(joint), 1e-30)
                level += math.log(total)
                sums = [s + j / total for s, j in zip(sums, joint)]
            share = [s / len(likely) for s in sums]
        return share, level

    share, _ = rounds([1 / len(langs)] * len(langs), langid.ROUNDS)
    order = sorted(range(len(langs)), key=lambda i: (-share[i], i))
    best, least = share, math.inf
    for k in range(1, len(langs) + 1):
        inside = [max(share[i], 1e-9) if i in order[:k] else 0.0 for i in range(len(langs))]
        tried, level = rounds([x / sum(inside) for x in inside], langid.SET_ROUNDS if k > 1 else 1)
        value = -2 * level + penalty * k * math.log(len(likely) + 1)
        if value < least:
            best, least = tried, value
    return best


def test_mixture_equals_plain_estimation(spark):
    pick = random.Random(8)
    training = [(lang, " ".join(words(pick, lang, 300))) for lang in ALPHABETS for _ in range(3)]
    training += [training[0], (None, "abc abc"), ("aa", None), ("bb", ""), ("bb", "123 !")]
    frame = spark.createDataFrame(training, "lang string, text string")
    model = langid.fit(frame)
    counts = defaultdict(Counter)
    for lang, text in training:
        if lang and text:
            counts[lang].update(g for word in letter_trigrams(text) for g in word)
    texts = []
    for _ in range(60):
        parts = pick.sample(list(ALPHABETS), pick.randint(1, 3))
        texts.append(" ".join(w for p in parts for w in words(pick, p, pick.randint(1, 60))))
    texts += [None, "", "12 34", "a", "e", texts[0], texts[0], "EFGH; efgh", "\n", "zz"]
    asked = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("score", F.lit("clash"))
    rows = langid.predict(asked, model).collect()
    assert len(rows) == len(texts)
    langs = sorted(ALPHABETS)
    for r in rows:
        share = plain_mixture(counts, langs, r.text or "")
        if share is None:
            assert (r.lang_pred, r.score, r.proportions) == ("und", 0.0, {})
            continue
        found = np.array([r.proportions.get(lang, 0.0) for lang in langs])
        assert np.allclose(found, share, atol=2e-3), (r.text, share, r.proportions)
        ranked = sorted(share, reverse=True)
        if ranked[0] - ranked[1] > 1e-3:  # else single precision may decide
            assert r.lang_pred == langs[int(np.argmax(share))]
        assert abs(r.score - max(share)) < 2e-3
    # Repeated rows have equal results, and a model without languages knows none.
    assert len({(r.lang_pred, r.score) for r in rows if r.text == texts[0]}) == 1
    none = langid.fit(frame.where("lang = 'zz'"))
    assert {r.lang_pred for r in langid.predict(asked, none).collect()} == {"und"}
