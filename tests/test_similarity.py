"""Matching shares of texts and rules found by their rarest part, against plain Python."""

import random
import time
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from atelier.functions import text as X
from atelier.operators import moderation as D

WORDS = ["Show", "show", "of", "the", "Évora", "light", "Light", "aab", "abab", "ba", "  ", "日本", "x", "😀", "opening", "night", "!", "2024"]


def pairs(n, seed=1):
    rng = random.Random(seed)
    out = [("", ""), ("", None), (None, None), ("a", ""), ("  A ", "a"), ("abcd", "bcde"), ("qabxcd", "abycdf"), ("private Thread currentThread;", "private volatile Thread currentThread;")]
    for _ in range(n):
        a = " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 7)))
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 2)] = rng.choice([[], [rng.choice("abx é")], list(rng.choice(WORDS))])
        out.append((a, "".join(b) if rng.random() < 0.8 else " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 7)))))
    return out


def share(a, b):
    return SequenceMatcher(None, (a or "").strip().lower(), (b or "").strip().lower()).ratio()


def test_share_of_short_texts(spark):
    rows = pairs(10_000)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string").repartition(8)
    got = df.select("i", X.matching_share(F.col("a"), F.col("b")).alias("s"), X.similar(F.col("a"), F.col("b"), 0.88).alias("y"))
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
    for r in got.collect():
        assert r.s == pytest.approx(share(*rows[r.i]), abs=1e-12), rows[r.i]
        assert r.y == (share(*rows[r.i]) >= 0.88), rows[r.i]


def test_share_of_long_texts(spark):
    """From 200 characters on, frequent ones start no block."""
    rng = random.Random(2)
    rows = []
    for n in (150, 199, 200, 201, 260, 420):
        for letters in ("ab", "abcdefgh ", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789éèêàùôïç" * 4 + " e"):
            b = "".join(rng.choice(letters) for _ in range(n))
            a = "".join(c if rng.random() < 0.9 else rng.choice(letters) for c in b)
            rows += [(a, b), (a[20:] + a[:20], b), (b, a[: n // 2])]
    rows.append(("x" + "e" * 30 + "y", ("e" * 60 + "qwertzuiopasdfghjklcvbnm" * 10)))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string").repartition(8)
    for r in df.select("i", X.matching_share(F.col("a"), F.col("b")).alias("s")).collect():
        assert r.s == pytest.approx(share(*rows[r.i]), abs=1e-12), rows[r.i]


def test_letters_bound_the_share(spark):
    rows = [(a or "", b or "") for a, b in pairs(500, 3)]
    df = spark.createDataFrame([(a.strip().lower(), b.strip().lower()) for a, b in rows], "a string, b string")
    for r in df.select("a", "b", X.shared_letters(F.col("a"), F.col("b")).alias("s")).collect():
        assert r.s == pytest.approx(SequenceMatcher(None, r.a, r.b).quick_ratio(), abs=1e-12)
