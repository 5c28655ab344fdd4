"""The training-data operators against brute force, round trips and held-out accuracy, with nulls, ties, empty tables and odd columns."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from atelier.llm import bpe, compression, decontaminate, fmindex, htmltext, licences, neardup, packing, perplexity, privacy, substrings, warc
from atelier.llm import words as W

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PLAIN = r"[^\x20\x09-\x0D]+"


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows, and columns whose names clash with inner ones."""
    long = " ".join(f"w{i % 997} x{i}" for i in range(60_000))
    shared = " ".join(f"s{i}" for i in range(70))
    texts = ["", None, "one", "a b c d e f", "a b c d e f", long, long + " tail", shared + " end", "start " + shared, " ".join(["ho"] * 400), "x@y.com +1 (555) 555-1234", "Licensed under the Apache License, Version 2.0."]
    rows = [(i, t, [None, "en", "xx"][i % 3], None, None) for i, t in enumerate(texts)] + [(3, "a b c d e f", "en", "s", 1), (3, "a b c d e f", "en", "s", 1), (None, shared, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit("clash") for c in ("content", "hash", "anchor", "node", "label", "length", "_text", "n", "score", "language", "_salt", "part", "digest", "votes", "_base")}), rows


def words(text):
    return re.findall(PLAIN, text or "")


# ---- words and bits


def test_words_and_grams():
    texts = ["Hello wörld  x\n", "", None, " a b c d e f", "nospace", "end "]
    for c in W.chunks(pa.array(texts), W.PLAIN, limit=20):
        for r in range(c.hi - c.lo):
            assert [c.data[a:b].tobytes().decode() for a, b in zip(c.starts[c.first[r] : c.first[r + 1]], c.ends[c.first[r] : c.first[r + 1]], strict=True)] == words(texts[c.lo + r])
    h = W.mix(np.arange(100, dtype=np.uint64))
    for n in (1, 2, 3, 5, 12, 50, 100):
        g = W.grams(h, n)
        assert len(g) == 101 - n and (g[7:] == W.grams(h[7:], n)).all()
    assert (W.sliding_min(h, 39) == [h[i : i + 39].min() for i in range(62)]).all()


def parts_of(rng, n, most):
    parts = [rng.integers(1, 5, rng.integers(1, 60)) for _ in range(n)]
    parts += [np.append(parts[i], parts[i + 1]) for i in range(n // 2)] + [np.full(most, 2)]
    text = np.concatenate([np.append(p, 0) for p in parts])
    end = np.cumsum([len(p) + 1 for p in parts]) - 1
    return text, end - [len(p) for p in parts], end


def test_fm_index_finds_every_window():
    """Queries of another text, with symbols that the index does not know; each match comes with all its places."""
    rng = np.random.default_rng(5)
    for depth in (3, 5, 12, 50):
        text, _, _ = parts_of(rng, 30, 90)
        query, begin, end = parts_of(rng, 30, 70)
        query[rng.integers(0, len(query), 20)] = 0
        first = np.flatnonzero(text == 0)[0]
        query[begin[3] : begin[3] + 1] = 0
        query = np.concatenate([query, text[: first + 1], text[2 : first + 1]])
        begin, end = np.append(begin, [end[-1] + 1, end[-1] + first + 2]), np.append(end, [end[-1] + 1 + first, end[-1] + 2 * first])
        index = fmindex.FMIndex(text, depth)
        where, lo, hi = index.matching(query, begin, end)
        places = defaultdict(set)
        for p in range(len(text) - depth + 1):
            places[tuple(text[p : p + depth])].add(p)
        windows = {p: tuple(query[p : p + depth]) for b, e in zip(begin.tolist(), end.tolist(), strict=True) for p in range(b, e - depth + 1)}
        want = {p: places[w] for p, w in windows.items() if 0 not in w and w in places}
        assert {w: set(index.locate(np.arange(low, h)).tolist()) for w, low, h in zip(where.tolist(), lo.tolist(), hi.tolist(), strict=True)} == want
        assert depth == 50 or want


def test_bpe_equals_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    odd = ["it's don't 'tis ''s x'''s we'll  they've\n\n 'RE 're", "  lead", "trail  ", "\n", "a\n\nb\t c  \n d", " x　y 12½ 3.5 ---'s", "日本語 текст 😀😀 é'll", "'", "x's", "", None, "5's 'm'm"]
    rng = random.Random(3)
    odd += ["".join(rng.choice("ab'sltre vm. \n\té1") for _ in range(40)) for _ in range(300)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = [ids[o[i] : o[i + 1]].tolist() for lo, hi, ids, o in bpe.token_ids(pa.array(odd), packing.vocabulary()) for i in range(hi - lo)]
    assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in odd]


def test_added_tokens():
    import public_tokenizers
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [f"one{end}two", end, f"{end}{end}", f"a  {end}  b it's{end}'s", "<|endof", "text|>", f"é {end}\n", "<|end of text|> <|", f"<|{end}|>", "", None, f"{end} x"]
    rng = random.Random(5)
    texts += ["".join(rng.choice([end, " ", "a", "'s", "<|", "|>", "endoftext", "\n", "é"]) for _ in range(12)) for _ in range(300)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = [ids[o[i] : o[i + 1]].tolist() for lo, hi, ids, o in bpe.token_ids(pa.array(texts), packing.vocabulary()) for i in range(hi - lo)]
    assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


# ---- operators


def removed(rows, window):
    seen = defaultdict(lambda: float("inf"))
    for i, t in rows:
        w = words(t)
        for s in range(len(w) - window + 1):
            seen[tuple(w[s : s + window])] = min(seen[tuple(w[s : s + window])], i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = {p for s in range(len(w) - window + 1) if seen[tuple(w[s : s + window])] < i for p in range(s, s + window)}
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for p, x in enumerate(w) if p not in gone).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("most", [4096, 2])
def test_substring_dedup(spark, odd, most):
    df, rows = odd
    got = [tuple(r) for r in substrings.deduplicated(df, most=most, with_text=False).collect()]
    known = [(r[0], r[1]) for r in rows if r[0] is not None]
    assert sorted(r for r in got if r[0] is not None) == sorted(removed(known, 50))
    assert [r[2] for r in got if r[0] is None] == [0]
    assert substrings.deduplicated(df.limit(0)).count() == 0


def test_substring_dedup_of_a_hot_passage(spark, monkeypatch):
    """What meets in one index stays within the bound, however many contexts a passage has."""
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(k, " ".join([*(f"a{k}x{i}" for i in range(20)), passage, *(f"b{k}x{i}" for i in range(20))])) for k in range(40)]
    search, most = substrings.searched, []

    def counted(slices, **options):
        most.append(max((r["count"] for r in slices.groupBy("anchor").count().collect()), default=0))
        return search(slices, **options)

    monkeypatch.setattr(substrings, "searched", counted)
    got = substrings.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), most=3, with_text=False)
    assert sorted(tuple(r) for r in got.collect()) == sorted(removed(rows, 50))
    assert max(most) <= 3


def test_quality_classifier(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    model = compression.fit(docs, labels)
    got = {r.doc_id: r for r in compression.quality(docs, model).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for i, r in got.items())
    held = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(p == q for p, q in held) / len(held) > 0.98
    # by brute force: the sizes under each dictionary, and the logistic function
    pairs = [[compression._compressor(x) for x in pair] for pair in zip(model.bad, model.good, strict=True)]
    assert len(pairs) == 3
    for r in docs.limit(300).collect():
        t = (r.text or "").encode()
        n = max(1, len(t))
        sizes = [[len(c.compress(t)) for c in pair] for pair in pairs]
        d, share = [(b - g) / n for b, g in sizes], min(sum(sizes[1]) / (2 * n), 2.0)
        x = [1.0, *d, *(v * np.log1p(n) for v in d), share, share * share, np.log1p(n)]
        assert abs(got[r.doc_id].score - 1 / (1 + np.exp(-np.dot(model.weights, x)))) < 1e-9
    assert compression.quality(odd[0], model).count() == len(odd[1])
    assert {r.score for r in compression.quality(odd[0], compression.fit(odd[0], labels.limit(0))).collect()} == {0.5}


def base_counts(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen = Counter(zip(w, w[1:], w[2:], strict=False))
    again = {k for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if seen[g] > 1 for k in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again), len(w) < 50 or 100 * len(again) > 50 * len(w))


def plain(t):
    """Passes the base rules, with few symbols and capitals: what the model is counted on."""
    _, chars, symbols, _, _, failed = base_counts(t)
    return not failed and 10 * symbols <= chars and 10 * len(re.findall("[A-Z]", t)) <= 3 * chars


def folded(t):
    return ["\x02"] * 4 + [" " if ord(c) <= 32 or c == "\x7f" else "0" if "0" <= c <= "9" else c for c in t or ""]


class KneserNey:
    """Interpolated, of five symbols, with dictionaries."""

    def __init__(self, texts):
        counts = Counter(tuple(f[i - 4 : i + 1]) for f in map(folded, texts) for i in range(4, len(f)))
        self.levels = {}
        for k in (5, 4, 3, 2, 1):
            n = Counter(counts.values())
            whole = n[1] * n[2] * n[3] * n[4]
            y = n[1] / (n[1] + 2 * n[2]) if whole else 0
            d = [0, *(min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i) if whole else (0.5, 1.0, 1.5)[i - 1] for i in (1, 2, 3))]
            total, left = Counter(), Counter()
            for g, c in counts.items():
                total[g[:-1]] += c
                left[g[:-1]] += d[min(c, 3)]
            self.levels[k] = (counts, d, total, left)
            self.kinds = len({g[-1] for g in counts})
            counts = Counter(g[1:] for g in counts)

    def p(self, g):
        if not g:
            return 1 / (self.kinds + 1)
        counts, d, total, left = self.levels[len(g)]
        n, t = counts[g], total[g[:-1]]
        return self.p(g[1:]) if not t else (n - d[min(n, 3)]) / t + left[g[:-1]] / t * self.p(g[1:])

    def log_perplexity(self, t):
        f = folded(t)
        return -sum(np.log(self.p(tuple(f[i - 4 : i + 1]))) for i in range(4, len(f))) / (len(f) - 4)


def middle(values):
    return sorted(values)[-(-len(values) // 2) - 1]


def verdicts(rows):
    """{doc_id: (log perplexity, kept)} of (doc_id, lang, text) by brute force."""
    models = {lang: KneserNey([t for _, x, t in rows if x == lang and plain(t)]) for lang in {x for _, x, t in rows if plain(t)}}
    logs = {i: models[lang].log_perplexity(t) if t and lang in models else None for i, lang, t in rows}
    bins = defaultdict(list)
    for i, lang, t in rows:
        if plain(t):
            bins[lang].append(int(np.floor(logs[i] / perplexity.BIN)))
    center = {x: middle(v) for x, v in bins.items()}
    away = {x: [abs(b - center[x]) for b in v] for x, v in bins.items()}
    pool = middle([d for v in away.values() for d in v]) if away else 0
    out = {}
    for i, lang, t in rows:
        kept = not base_counts(t)[-1]
        if lang in bins and logs[i] is not None:
            n, s = len(bins[lang]), perplexity.SHRINK
            reach = max((n * middle(away[lang]) + s * pool) / (n + s), 1) * perplexity.BIN
            at = (center[lang] + 0.5) * perplexity.BIN
            kept &= at - perplexity.LOWER * reach <= logs[i] <= at + perplexity.UPPER * reach
        out[i] = (logs[i], kept)
    return out


def test_quality_rules(spark, odd):
    docs = table(spark, "documents")
    every, name = perplexity.rules(docs)
    got = {r.doc_id: r[name] for r in every.collect()}
    rows = [(r.doc_id, r.lang, r.text) for r in docs.collect()]
    want = verdicts(rows)
    for i, _, t in rows:
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == base_counts(t)
        assert abs(g.log_perplexity - want[i][0]) < 1e-4 and g.kept == want[i][1]
    assert {w for _, w in want.values()} == {True, False}
    assert sorted(r.doc_id for r in perplexity.filtered(docs).collect()) == sorted(i for i, r in got.items() if r.kept)
    joined, name = perplexity.rules(docs, broadcast=0)  # the way of a model that is too large to broadcast
    for r in joined.collect():
        assert abs(r[name].log_perplexity - got[r.doc_id].log_perplexity) < 1e-4 and r[name].kept == got[r.doc_id].kept


def test_quality_rules_of_odd_tables(spark, odd):
    for broadcast in (perplexity.BROADCAST, 0):
        every, name = perplexity.rules(odd[0], broadcast=broadcast)
        assert every.count() == len(odd[1]) and every.columns[:-1] == odd[0].columns
        assert [r[name].kept for r in every.where("doc_id < 3").collect()] == [False] * 3
        assert perplexity.rules(odd[0].limit(0), broadcast=broadcast)[0].count() == 0
    assert perplexity.filtered(odd[0]).columns == odd[0].columns
    assert perplexity.filtered(odd[0].drop("lang")).columns == odd[0].drop("lang").columns


def test_both_bands_reject(spark):
    """Languages are those of the table; text above and text below the band of its language goes, and in another language the same text may stay."""
    rng = random.Random(2)
    sentence = lambda words_, n: " ".join(rng.choice(words_) for _ in range(n))
    some = {x: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(300)] for x, letters in {"xx": "abcdefghij", "yy": "klmnopqrst", None: "uvwxyzabcd"}.items()}
    rows = [(lang, sentence(w, rng.randint(100, 160))) for lang, w in some.items() for _ in range(60)]
    dull = sentence(sorted(some["xx"], key=len)[-40:], 120)  # long words alone: most of their letters follow from the ones before
    noise = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(900))
    cases = [("xx", noise), ("xx", dull), ("yy", rows[0][1]), ("zz", rows[0][1])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows + cases)], "doc_id long, lang string, text string")
    every, name = perplexity.rules(df, lower=4.0, upper=4.0)
    got = {r.doc_id: r[name] for r in every.collect()}
    n = len(rows)
    assert sum(got[i].kept for i in range(n)) >= 0.98 * n
    assert got[n].log_perplexity > got[n].high and not got[n].kept
    assert got[n + 1].log_perplexity < got[n + 1].low and not got[n + 1].kept and not got[n + 1].base_failed
    assert not got[n + 2].kept and got[n + 3].kept


def contaminated(docs, items):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    fold = lambda t: re.findall(pattern, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = defaultdict(set)
    for i, t in items:
        w = fold(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[s : s + 10])].add(i)
    sizes = {len(x) for x in windows}
    out = []
    for d, t in docs:
        w, hit, ids = fold(t), set(), set()
        for k in sizes:
            for s in range(len(w) - k + 1):
                if (found := windows.get(tuple(w[s : s + k]))) is not None:
                    hit.update(range(s, s + k))
                    ids |= found
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_decontamination(spark, odd, broadcast):
    items = [(1, "A b"), (2, None), (3, ""), (10, " ".join(f"s{i}" for i in range(20, 45))), (2, "a b c d e f"), (4, "Élan ÉLAN"), (None, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in decontaminate.digest(decontaminate.contamination(odd[0], bench, broadcast=broadcast)).collect()), key=repr)
    want = contaminated([(r[0], r[1]) for r in odd[1]], [x for x in items if x[0] is not None])
    assert got == want
    assert Counter(r.doc_id for r in decontaminate.clean(odd[0], bench, broadcast=broadcast).collect()) == Counter(r[0] for r in want if not r[5])
    assert not any(r.contaminated for r in decontaminate.digest(decontaminate.contamination(odd[0], bench.limit(0))).collect())


def test_packing(spark, odd):
    for df, n in ((odd[0], len(odd[1])), (table(spark, "documents"), None)):
        rows = packing.packed_documents(df).collect()
        by, docs = defaultdict(list), Counter()
        for r in rows:
            by[r.sequence_id].append((r.offset, r.length))
            docs[r.doc_id] += r.piece == 0
        for parts in by.values():
            parts.sort()
            assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in pairwise(parts)) and sum(parts[-1]) <= 1024
        assert n is None or sum(docs.values()) == n
        total = sum(r.length for r in rows)
        assert len(by) <= 1.02 * -(-total // 1024) + 1
    assert packing.packed_documents(odd[0].limit(0)).count() == 0


def test_packing_plan_uses_every_piece():
    rng = random.Random(2)
    for _ in range(20):
        counts = {rng.randint(1, 64): rng.randint(1, 500) for _ in range(rng.randint(1, 40))}
        used = Counter()
        for content, times in packing.plan(counts, 64):
            assert sum(content) <= 64
            for x in content:
                used[x] += times
        assert used == Counter(counts)


def test_sequences_hold_the_ids(spark):
    docs = table(spark, "documents").limit(40).cache()
    packed = packing.packed_documents(docs).cache()
    made = {r.sequence_id: r.ids for r in packing.sequences(packed, packing.pieces(docs, with_ids=True)).collect()}
    for r in packed.collect():
        part = made[r.sequence_id][r.offset : r.offset + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32


def aligned(a, b):
    """Longest common subsequence of two lists of labelled runs: that of the places of b's in a."""
    place = {x: i for i, x in enumerate(a)}
    ends = []
    for x in (place[y] for y in b if y in place):
        at = bisect.bisect_left(ends, x)
        ends[at : at + 1] = [x]
    return len(ends)


def near_classes(docs):
    runs = {}
    for i, t in docs:
        w, seen = words(t), Counter()
        plain = list(zip(*[w[k:] for k in range(5)], strict=False)) if len(w) >= 5 else [tuple(w)] * bool(w)
        runs[i] = [(x, seen.update([x]) or seen[x]) for x in plain]
    parent = {i: i for i in runs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    text = {i: t or "" for i, t in docs}
    ids = sorted(runs)
    sets = {i: frozenset(r) for i, r in runs.items()}
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both, total = len(sets[a] & sets[b]), len(sets[a]) + len(sets[b])
            if text[a] != text[b] and (not both or both < 0.8 * (total - both)):
                continue  # no alignment is longer than what they share
            both = aligned(runs[a], runs[b])
            if text[a] == text[b] or both >= 0.8 * (total - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_duplicates(spark, odd):
    rng = random.Random(4)
    texts = []
    for g in range(12):
        base = [f"g{g}w{rng.randint(0, 400)}" for _ in range(rng.choice([8, 40, 200, 600]))]
        for _ in range(rng.choice([2, 5, 30])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                copy[rng.randrange(len(copy))] = f"new{rng.randint(0, 10**6)}"
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = dict(neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == near_classes(rows)
    found = neardup.classes(odd[0]).collect()
    assert len(found) == len(odd[1]) and {r.class_id for r in found if r.doc_id in (3, 4)} == {3}
    assert neardup.classes(odd[0].limit(0)).count() == 0
    assert neardup.deduplicated(odd[0]).columns == odd[0].columns


def test_near_duplicates_of_whole_documents(spark):
    docs = table(spark, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(1000 + i, " ".join(w[len(w) // 2 :] + w[: len(w) // 2])) for i, w in ((i, words(t)) for i, t in rows[:40]) if len(w) > 60]  # turned round: as sets alike, not in order
    want = near_classes(rows)
    assert dict(neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == want
    assert len(set(want.values())) < len(want)
    assert all(want[i] == i for i in want if i >= 1000 and sum(v == want[i] for v in want.values()) == 1)


def planted(n, seed=11):
    """Pairs (a document and its edited copy, five-word runs alike by 0.8 or a little more) among n others that share passages."""
    rng = random.Random(seed)
    passage = [[f"p{j}w{rng.randint(0, 90)}" for _ in range(40)] for j in range(5)]
    rows, pairs = [], []
    for i in range(n):
        own = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(80, 200))] + rng.choice(passage)
        rows.append((2 * i, " ".join(own)))
        if i % 2 == 0:
            copy = list(own)
            for at in rng.sample(range(10, len(own) - 10), max(1, len(own) // 50)):
                copy[at] = f"new{rng.randint(0, 10**6)}"
            rows.append((2 * i + 1, " ".join(copy)))
            runs = [set(zip(*[x[k:] for k in range(5)], strict=False)) for x in (own, copy)]
            if len(runs[0] & runs[1]) >= 0.8 * len(runs[0] | runs[1]):
                pairs.append((2 * i, 2 * i + 1))
    return rows, pairs


@pytest.mark.parametrize("n", [60, 600, 2000])
def test_near_duplicates_recall(spark, n):
    rows, pairs = planted(n)
    got = dict(neardup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect())
    assert sum(got[a] == got[b] for a, b in pairs) >= 0.99 * len(pairs) > 0


def test_open_buckets_of_every_length_are_joined(spark):
    """Texts made of common passages alone, of many lengths and classes: the exact join over tokens and bands of lengths finds the links that brute force does."""
    rng = random.Random(11)
    passages = [" ".join(f"p{k}w{i}" for i in range(rng.randint(4, 14))) for k in range(14)]
    rows = [(i, " ".join(rng.choices(passages, k=rng.randint(1, 9)))) for i in range(260)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    nodes = texts.select(F.col("doc_id").alias("node"), F.lit(0).alias("bin"), F.lit(0).cast("long").alias("hash"))
    labels = spark.createDataFrame([(i, i - i % 3) for i, _ in rows], "node long, label long")
    found = {(r.a, r.b) for r in neardup._rest(nodes, labels, neardup.candidates(texts, nodes), size=5, least=0.8).collect()}
    runs = {}
    for c in W.chunks(pa.array([t for _, t in rows]), W.PLAIN):
        h, row = neardup.runs(c)
        own = neardup.labelled(h, row)
        runs |= {c.lo + r: own[row == r] for r in range(c.hi - c.lo)}
    want = {(a, b) for a in runs for b in runs if a < b and a - a % 3 != b - b % 3 and neardup.similarity(runs[a], runs[b], 0.8) >= 0.8}
    assert want and want <= found and len(found) < 20 * len(want)


def test_near_duplicates_that_no_head_touches(spark):
    """Pairs just alike enough in buckets that hold many other classes."""
    common = [f"c{i}" for i in range(104)]
    rows = [(2 * k + v, " ".join([*common, f"f{k}", *(f"t{k}x{v}x{i}" for i in range(12))])) for k in range(40) for v in (0, 1)]
    want = near_classes(rows)
    assert len(set(want.values())) == 40
    assert dict(neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == want


@pytest.mark.parametrize("few", [10**9, -1])
def test_heads_take_no_further_turn_where_the_exact_join_is_small(spark, monkeypatch, few):
    """The classes are those of brute force with and without further turns of heads."""
    common = [f"c{i}" for i in range(104)]
    rows = [(2 * k + v, " ".join([*common, f"f{k}", *(f"t{k}x{v}x{i}" for i in range(12))])) for k in range(40) for v in (0, 1)]
    made, keep = [], neardup.written
    monkeypatch.setattr(neardup, "FEW", few)
    monkeypatch.setattr(neardup, "written", lambda df, what: made.append(what) or keep(df, what))
    assert dict(neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == near_classes(rows)
    assert made.count("prefixes") == 1 and (made.count("pairs") == 2) == (few > 0)


def test_heads_leave_pairs_of_few_common_buckets_to_the_exact_join(spark):
    """Of 32 buckets, one in common is too few; of a short text's eight, one is enough."""
    rows = [(0, 1, 32), (1, 1, 32), (10, 11, 8), (11, 11, 8), *((n, h, 32) for n in (20, 21) for h in range(20, 24))]
    members = spark.createDataFrame([(n, 0, h, b, 1) for n, h, b in rows], "node long, bin int, hash long, bins int, popular long")
    assert sorted(map(tuple, neardup._pairs(members, None, 0).collect())) == [(10, 11), (20, 21)]


def test_warc_round_trip(spark, tmp_path):
    rows = [(i, f"u{i}", ["dup", "x" * 5000, None, ""][i % 4] if i % 3 else f"page {i} é") for i in range(300)] + [(7, "u", "dup"), (7, "u", "dup"), (None, None, "solo"), (10**15, "far", "far")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    a, b = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    warc.write(df, a, range_bytes=3000, roll_bytes=2000)
    warc.write(df.repartition(5, "html"), b, range_bytes=3000, roll_bytes=2000)
    files = lambda d: {p.name: p.read_bytes() for p in (tmp_path / d / "data").iterdir()}
    assert files("a") == files("b") and len(files("a")) > 10
    got = warc.read(spark, a).collect()
    first = {}
    for i, _, h in rows:
        first[h or ""] = min(first.get(h or "", float("inf")), float("inf") if i is None else i)
    assert Counter((r.page_id, r.payload_bytes) for r in got) == Counter((i, len((h or "").encode())) for i, _, h in rows)
    for r in got:
        assert r.record_type == "response" or r.html is None
    assert all(r.record_type == ("response" if r.page_id == first["dup"] else "revisit") for r in got if r.payload_bytes == 3 and r.page_id != 10**15)
    assert Counter(r.html for r in got if r.record_type == "response") == Counter(dict.fromkeys(first, 1))
    warc.write(df.limit(0), f"file://{tmp_path}/c")
    assert warc.read(spark, f"file://{tmp_path}/c").count() == 0


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def test_personal_data(spark, odd):
    rng = random.Random(3)
    texts = ["".join(rng.choice("a@.1 2-+()b9_é😀\n5%") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a@b.c_d@e.com z", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.004", "4111 1111 1111 1111", "a4111111111111111b", "+1 (555) 555-1234 1.2.3.4", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    model = privacy.train(df)
    for r in privacy.digest(privacy.spans(df, model)).collect():
        want = base_spans(texts[r.doc_id] or "")
        listed = [f"{privacy.KINDS[k]}:{s}:{e}" for s, k, e in want]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in want) for kind in range(4)]
        assert set(listed) <= set(r.spans.split(",")) | {""}
    plan = privacy.digest(privacy.spans(df, model))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert privacy.train(df.limit(0)) is None and privacy.spans(odd[0], model).count() == len(odd[1])
    clean = {r.doc_id: r.text for r in privacy.redacted(odd[0], model).collect()}
    assert clean[10] == "<EMAIL> <PHONE>" and clean[1] is None and clean[2] == "one"


def redacted(t, spans):
    """Left to right; what overlaps an earlier span only lengthens it."""
    out, at = "", 0
    for start, kind, end in spans:
        if start >= at:
            out += t[at:start] + f"<{privacy.KINDS[kind].upper()}>"
        at = max(at, end)
    return out + t[at:]


def test_personal_data_of_whole_documents(spark):
    docs = table(spark, "documents")
    model = privacy.train(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    clean = {r.doc_id: r.text for r in privacy.redacted(docs, model).collect()}
    seen = Counter()
    for r in privacy.digest(privacy.spans(docs, model)).collect():
        t = texts[r.doc_id] or ""
        want = base_spans(t)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in want) for kind in range(4)]
        every = [(int(s), privacy.KINDS.index(k), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        added = [x for x in every if x not in want]
        assert sorted([*want, *added]) == every
        assert all(not (s < e2 and s2 < e) for s, _, e in added for s2, _, e2 in want)
        assert clean[r.doc_id] == (redacted(t, every) if every else texts[r.doc_id])
        seen.update(k for _, k, _ in every)
    assert all(seen[k] for k in range(4))


def test_added_personal_data(spark):
    cases = [
        ("write to jane.doe (at) example (dot) com today", "email:9:40"),
        ("my ssn is 123-45-6789, keep it", "id:10:21"),
        ("iban DE89 3704 0044 0532 0130 00 please", "account:5:32"),
        ("he was born 1999-12-31 in room 101", ""),
        ("api key sk-9aB3xY7pQ2zL5mN8rT1w and", "secret:8:31"),
        ("released-under-the-public-domain is a long word", ""),
        ("call 415-555-2671 now", "phone:5:17"),
    ]
    docs = table(spark, "documents")
    model = privacy.train(docs)
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in privacy.digest(privacy.spans(df, model)).collect()}
    assert got == {i: w for i, (_, w) in enumerate(cases)}


def test_personal_data_of_very_long_texts(spark):
    """Work grows in proportion: an address of many labels, many matches, and long runs that never become one."""
    many = " ".join(f"u{i}@h{i}.org 10.0.{i % 256}.{i // 256}" for i in range(8_000))
    texts = ["a@b" + ".c" * 100_000, many, "+1" + "(" * 200_000, "1 " * 200_000, "a@" * 100_000, "x." * 100_000 + "@", "k9" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    model = privacy.train(table(spark, "documents"))
    got = {r.doc_id: r for r in privacy.digest(privacy.spans(df, model)).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t) if i != 5 else []
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{privacy.KINDS[k]}:{s}:{e}" for s, k, e in want).encode()).hexdigest()
    assert got[1].n_email == got[1].n_ip == 8_000
    clean = {r.doc_id: r.text for r in privacy.redacted(df, model).collect()}
    assert clean[0] == "<EMAIL>" and clean[1] == " ".join(["<EMAIL> <IP>"] * 8_000)


def test_main_text(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li><a>Menu</a></li></ul></nav><div class="ad">Buy</div>
    <article><h1>Head &amp; line</h1><p><b>First   part.<br><p>Second.</p><aside>No</aside><div class="comments"><p>Nice!</p></div></article><form>Sign up</form><footer>&copy; F</footer></body></html>"""
    assert htmltext.main_text(page)[0] == "Head & line First part. Second."
    plain = "<body><div>Home</div><p>" + "long text " * 40 + "</p><p>" + "more text " * 40 + "</p><ul>" + "<li><a>x</a></li>" * 9 + "</ul></body>"
    assert htmltext.main_text(plain)[0].startswith("long text") and "x" not in htmltext.main_text(plain)[0].split()[-3:]
    rows = spark.createDataFrame([(1, None, None), (None, "u", ""), (3, "u", page), (4, "u", "<p>unclosed <b"), (4, "u", "<p>unclosed <b")], "page_id long, url string, html string")
    got = htmltext.extract(rows).collect()
    assert [r.n_chars for r in got[:2]] == [0, 0] and len(got) == 5


LONG = ["The council met on Monday and talked for hours about the new bridge over the river.", "Nobody had thought that it would cost so much, the mayor said to those who had come.", "Work is to begin in spring, if the money is found by then and the weather allows it."]
MENU = "".join(f"<li><a href='/{i}'>Section {i}</a></li>" for i in range(12))


@pytest.mark.parametrize(
    ("page", "want"),
    [  # no article: the clusters alone; with one: link lists before and after its clusters go, those between them, captions, names and links in a sentence stay
        (f"<body><ul>{MENU}</ul><div>{''.join(f'<p>{x}</p>' for x in LONG)}</div><div><a href='/a'>About</a></div><ul>{MENU}</ul></body>", " ".join(LONG)),
        (f"<body><ul>{MENU}</ul><article><ul>{MENU}</ul><h1>Bridge</h1><p>{LONG[0]}</p><ul>{MENU}</ul><p>{LONG[1]}</p><p>A caption</p><p>{LONG[2]}</p><p>By J. Doe</p><ul>{MENU}</ul></article></body>", f"Bridge {LONG[0]} {' '.join(f'Section {i}' for i in range(12))} {LONG[1]} A caption {LONG[2]} By J. Doe"),
        (f"<body><div><ul>{MENU}</ul></div><h1>Bridge</h1><div><div><p>{LONG[0]}</p><p>{LONG[1]}</p><p>Short</p></div></div><div><p>Imprint</p></div></body>", f"Bridge {LONG[0]} {LONG[1]} Short"),
        (f"<body><div><p>{LONG[0]}</p><p>A</p></div><div>{MENU}</div><div><p>{LONG[1]}</p><p>B</p></div><div><p>{LONG[2]}</p><p>C</p></div><div>Tail</div></body>", f"{LONG[0]} A {LONG[1]} B {LONG[2]} C"),
        (f"<body><article><p>{LONG[0]} See <a href='/x'>the plan</a>.</p><p><a href='/y'>A link of its own</a></p><p>{LONG[1]}</p></article></body>", f"{LONG[0]} See the plan. A link of its own {LONG[1]}"),
        (f"<body><article><a href='/1'>Next story</a><br><a href='/2'>Last story</a></article><article><p>{LONG[0]}</p><p>{LONG[1]}</p></article></body>", f"{LONG[0]} {LONG[1]}"),
        (f"<body><main><div class='sidebar'><p>{LONG[2]}</p></div><p>{LONG[0]} a &lt; b &amp; c&nbsp;&#233;</p><form><p>{LONG[1]}</p></form></main></body>", f"{LONG[0]} a < b & c é"),
    ],
)
def test_clusters_choose(page, want):
    assert htmltext.main_text(page)[0] == want


@pytest.mark.parametrize(("tags", "bare"), [("article|main", False), ("article|main", True), ("article|main|nav|header|footer|aside|form", True)])
def test_clusters_find_the_article_without_its_marks(tags, bare):
    """The given pages with <article> (then classes, then all tags that say what they hold) turned into <div>: what was the article is still found."""
    import html

    import duckdb

    shares = []
    for (page,) in duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall():
        want = Counter(html.unescape(re.sub(r"<[^>]*>", " ", re.search(r"<article>(.*?)</article>", page, re.S)[1])).split())
        page = re.sub(rf"<(/?)({tags})\b", r"<\1div", page)
        got = Counter(htmltext.main_text(re.sub(r'\s(class|id|role)="[^"]*"', "", page) if bare else page)[0].split())
        same = (got & want).total()
        shares.append((same / max(1, got.total()), same / want.total()))
    precision, recall = (sum(x) / len(shares) for x in zip(*shares, strict=True))
    assert precision >= 0.95 and recall >= 0.95


def test_main_text_of_very_long_pages():
    """Time grows with the page, also where nothing is closed."""
    import time

    took = []
    for n in (20_000, 80_000):
        began = time.process_time()
        for tags in ("<div><b><i>x ", "<p><span>y ", "</div>z ", "<a href='q'>w "):
            htmltext.main_text("<article>" + tags * n)
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0]


def test_main_text_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, "u", f"<article><p>{LONG[0]}</p></article>", "t", 3)] * 2 + [(None, None, None, None, None)], "page_id long, url string, html string, text string, n_chars long")
    assert sorted((r.page_id or 0, r.text) for r in htmltext.extract(df).collect()) == [(0, ""), (1, LONG[0]), (1, LONG[0])]


def test_main_text_of_pages(spark):
    import html

    for r, p in zip(htmltext.extract(table(spark, "pages")).orderBy("page_id").collect(), table(spark, "pages").orderBy("page_id").collect(), strict=True):
        inner = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split()) and r.n_chars == len(r.text)


BSD = """Copyright (c) 2011, A. Person

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# You should have received a copy of the GNU General Public License
# along with this program.
"""
NOTICES = [  # text, families that are confirmed; the last ones are licences that the model does not know, and other uses of the words
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
    ("x\nReleased under the MIT License.\ny", "mit"),
    ("foo This work is licensed under the GNU General Public License, version 3.", "gpl"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("Licensed under CC BY-SA 4.0.", "cc-by-sa"),
    (BSD, "bsd"),
    (GPL, "gpl"),
    ("MIT License", "mit"),
    ("The MIT License (MIT)\n\nCopyright (c) 2015 A B", "mit"),
    ("modify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation", "lgpl"),
    ("Some prose that goes on.\nSPDX-License-Identifier: MPL-2.0\nmore", "mpl-2.0"),
    ("He got a license to drive", ""),
    ("This Agreement is governed by the Eclipse Public License version 1.0 of the Foundation.", ""),
    ("This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable.", ""),
    ("Boost Software License - Version 1.0 - August 17th, 2003", ""),
    ("The Artistic License 2.0 applies to this package.", ""),
    (None, ""),
    ("", ""),
    ("the license of " + "x " * 3000, ""),
    ("#" * 100_000 + "\nlicense", ""),
    ("." * 100_000 + " permission", ""),
]


def test_licences(spark, odd):
    model = licences.train(licences.corpus_lines(table(spark, "documents")))
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NOTICES)], "doc_id long, text string")
    got = licences.scan(df, model)
    found = {r.doc_id: ",".join(sorted({x.family for x in r.licences if x.confirmed})) for r in got.collect()}
    assert found == {i: f for i, (_, f) in enumerate(NOTICES)}
    assert not re.search("Python|Arrow|Pandas", got._jdf.queryExecution().executedPlan().toString())
    assert licences.scan(odd[0], model).count() == len(odd[1]) and licences.scan(odd[0].limit(0), model).count() == 0
    assert licences.train([]).families[0] == "unknown"


def test_licences_of_whole_documents(spark):
    """By brute force: a paragraph is confirmed for a family if the model, with dictionaries, says so and a template is in it."""
    docs = table(spark, "documents")
    model = licences.train(licences.corpus_lines(docs))
    end = re.compile("\n[^\\w\n]*\n|(?<=[\\w)\"'][.!?;:])[ \t\r\"')]*\n")
    for r in licences.scan(docs, model).collect():
        want = []
        for i, p in enumerate(end.split(r.text or "")):
            w = re.findall("[a-z0-9]+", p.lower())
            pairs = {f"{a} {b}" for a, b in pairwise(w)}
            if not any(c in p.lower() or c.replace("-", " ") in p.lower() for c in licences.CUES):
                continue
            z = np.array(model.bias)
            for g in set(w) | pairs:
                z = z + np.array(model.weights.get(g, 0.0))
            if k := int(z.argmax()):
                family = model.families[k]
                near = [(len(t & pairs), len(t)) for t in ({g for g in licences.grams(x) if " " in g} for x in licences.TEMPLATES[family])]
                similar = max(max(n / size, n / len(pairs) if len(pairs) >= licences.PART else 0) for n, size in near)
                if np.exp(z - z.max()).sum() <= 2 and similar >= licences.SIMILAR:
                    want.append((i, family))
        assert [(x.paragraph, x.family) for x in r.licences if x.confirmed] == want
        for phrase, family in (("Licensed under the Apache License, Version 2.0.", "apache-2.0"), ("Released under the MIT License.", "mit"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc")):
            assert (phrase in (r.text or "")) <= (family in {f for _, f in want})


def test_quality_sample_is_bounded_in_bytes(spark, monkeypatch):
    rows = [(i, ("good words of text " if i % 2 else "bad noise here ") * (20 + i % 7)) for i in range(400)]
    docs = spark.createDataFrame(rows + rows[:50], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(compression, "dictionary", lambda texts, size: seen.append(texts) or b"\n".join(texts)[-size:])
    monkeypatch.setattr(compression, "SAMPLE_BYTES", 5000)
    compression.fit(docs, labels)
    assert all(0 < sum(map(len, texts)) <= 5000 for texts in seen)
    seen.clear()
    monkeypatch.setattr(compression, "SAMPLE_BYTES", 1 << 26)
    monkeypatch.setattr(compression, "SAMPLE_ROWS", 30)
    compression.fit(docs, labels)
    assert all(20 < len(texts) <= 30 for texts in seen)


def test_licences_without_a_cue_word(spark):
    text = "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    df = spark.createDataFrame([(1, f"Some prose.\n\n{text}\n\nMore prose."), (2, ""), (3, None), (4, "\n\n...")], "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan(df, licences.train([])).collect()}
    assert [(x.paragraph, x.family, x.confirmed) for x in got[1].licences if x.confirmed] == [(1, "unlicense", True)] and got[1].n_cues == 0
    assert [len(got[i].licences) for i in (2, 3, 4)] == [0, 0, 0]


def test_licence_words_are_cut_once(spark):
    """Lambdas share no subexpressions, so the plan names the words of a paragraph once; pairs are known only where both words are."""
    model = licences.Model(["unknown", "mit"], {"a": [0.0, 1.0], "b": [0.0, 1.0], "c": [0.0, 1.0], "a b": [0.0, 8.0]}, [3.5, 0.0])
    df = spark.createDataFrame([(1, "a b"), (2, "a x b"), (3, "b a c"), (4, "x a b\n\na"), (5, "b a b a")], "doc_id long, text string")
    got = licences.scan(df, model)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert {r.doc_id: [x.paragraph for x in r.licences] for r in got.collect()} == {1: [0], 2: [], 3: [], 4: [0], 5: [0]}
