"""Source divergence, hard negatives and repeated passages against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fundcast.llm import cover_tree, hard_negatives, repeated_passages, run_index, source_divergence
from fundcast.session import share_code

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
DDL = "doc_id long, text string, lang string, source string, n_chars long, count long, term string, block int"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- source divergence


@given(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 6)), max_size=60), st.integers(1, 4))
@settings(max_examples=60, deadline=None)
def test_skyband_is_what_fewer_than_k_rows_dominate(rows, k):
    c, t = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
    term = np.random.default_rng(len(rows)).permutation(len(rows))
    n = len(rows)
    beaten = [sum(c[j] >= c[i] and t[j] <= t[i] and term[j] < term[i] for j in range(n)) for i in range(n)]
    assert sorted(source_divergence.skyband(c, t, term, k).tolist()) == [i for i in range(n) if beaten[i] < k]


def divergence(rows, min_docs, top):
    rows = [(lang or "", source or "", TERM.findall(lower(text))) for _, text, lang, source, *_ in rows]
    held, total = defaultdict(Counter), defaultdict(Counter)
    group = defaultdict(Counter)
    for lang, source, terms in rows:
        held[lang].update(set(terms))
        total[lang].update(terms)
        group[lang, source].update(terms)
    out = []
    for (lang, source), c in group.items():
        kept = [t for t, n in held[lang].items() if n >= min_docs]

        def p(counts, t, kept=kept):
            return 1 + 10**9 * (counts[t] + 2) // (sum(counts[x] for x in kept) + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        others = [(sum(f(p(c, t), p(d, t)) for t in kept), s) for (x, s), d in group.items() if x == lang and s != source]
        for rank, (v, s) in enumerate(sorted(others, key=lambda x: (-x[0], x[1].encode())), 1):
            out.append((lang, source, "pair", s, v, rank))
        own = [(f(p(c, t), p(total[lang], t)), t) for t in kept if c[t] > 0 and p(c, t) > p(total[lang], t)]
        for rank, (v, t) in enumerate(sorted(own, key=lambda x: (-x[0], x[1].encode()))[:top], 1):
            out.append((lang, source, "term", t, v, rank))
    return sorted(out)


def audit_rows():
    rnd = random.Random(3)
    words = "ab Abc été ÉTÉ x y zz 𝒳 ｆ ÿ don't nbsp in k2k end. alpha beta gamma delta".split(" ")
    weights = [rnd.randint(1, 9) for _ in words]
    made = []
    for i in range(160):
        source = rnd.choice(["a", "a", "a", "b", "c", "ｄ", None, ""])
        text = " ".join(rnd.choices(words, weights, k=rnd.randint(0, 30)))
        made.append((i, text, rnd.choice(["en", "en", "fr", None]), source, 1, 5, "t", 0))
    made += [made[0], made[0], (None, None, None, None, None, None, None, None), (7, "", "de", "only", 0, 0, None, 1)]
    made += [(8, "1 2 3", "de", "digits", 0, 0, None, 1), (9, "alpha " * 5000, "en", "a", 0, 0, None, 1)]
    return made


def test_source_divergence_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(source_divergence, "PART_TERMS", 3)
    monkeypatch.setattr(source_divergence, "BLOCK_SOURCES", 2)
    rows = audit_rows()
    docs = share_code(spark).createDataFrame(rows, DDL).repartition(3)
    got = sorted(tuple(r) for r in source_divergence.audit(docs, 5, 3).collect())
    assert got == divergence(rows, 5, 3)
    none = sorted(tuple(r) for r in source_divergence.audit(docs, 10_000, 3).collect())
    assert none == divergence(rows, 10_000, 3) and {r[4] for r in none} == {0}


def test_divergence_of_no_documents(spark):
    assert source_divergence.audit(share_code(spark).createDataFrame([], DDL)).count() == 0


# --- hard negatives


def clustered(n, d, seed, copies=0):
    g = np.random.default_rng(seed)
    centers = g.integers(-300, 300, (6, d))
    x = centers[g.integers(0, 6, n)] + g.integers(-20, 20, (n, d))
    return np.concatenate([x, np.repeat(x[:1], copies, axis=0)])


@pytest.mark.parametrize("n,copies", [(0, 0), (1, 0), (50, 0), (900, 0), (200, 400)])
def test_cover_tree_covers_its_points_and_finds_the_best(n, copies):
    x = clustered(n, 8, n, copies)
    tree = cover_tree.build(x, leaf=8, fan=4)
    assert sorted(tree.order.tolist()) == list(range(len(x)))
    v = x[tree.order]
    unit = np.concatenate([v / tree.norm, np.sqrt(np.maximum(1 - (v / tree.norm) ** 2 @ np.ones(8), 0))[:, None]], axis=1)

    def below(node):
        if tree.children[node, 1]:
            return [p for c in range(*tree.children[node]) for p in below(c)]
        return list(range(*tree.points[node]))

    for node in range(len(tree.centers) if n else 0):
        c = tree.centers[node]
        u = np.append(c / tree.norm, math.sqrt(max(1 - (c / tree.norm) @ (c / tree.norm), 0)))
        for p in below(node):
            assert math.acos(np.clip(u @ unit[p], -1, 1)) <= tree.radius[node] + 1e-9
    ids = np.random.default_rng(1).permutation(len(x))
    queries = np.concatenate([clustered(20, 8, n + 1), np.zeros((1, 8), np.int64)])
    best = cover_tree.Best(len(queries), 5)
    least, most = np.full(len(queries), -200_000), np.full(len(queries), 150_000)
    every = lambda rows, leaf: np.ones((len(rows), leaf.stop - leaf.start), bool)
    verified = cover_tree.search(tree, v, ids, queries, least, most, every, best, np.arange(len(queries)))
    scores = queries @ v.T
    for i, s in enumerate(scores):
        want = sorted((-a, b) for a, b in zip(s.tolist(), ids.tolist()) if -200_000 <= a <= 150_000)[:5]
        got = [(-a, b) for a, b in zip(best.score[i].tolist(), best.id[i].tolist()) if a > cover_tree.LOW]
        assert got == want
    if n == 900:
        assert verified < 0.7 * scores.size  # radii leave nodes out


def test_products_are_exact_beyond_floating_point():
    a = np.array([[2**30, 2**30 - 1, 3]])
    assert cover_tree.products(a, a).tolist() == [[sum(int(x) ** 2 for x in a[0])]]


VECTORS = "vec_id long, embedding array<float>, label int, score long, query int"


def vector_rows():
    g = np.random.default_rng(8)
    x = (clustered(230, 6, 4) / 256).astype(np.float32)
    made = [(i, v.tolist(), int(g.integers(0, 3)) if i % 3 else 0, 1, 2) for i, v in enumerate(x)]
    for i in range(230, 260):  # ties
        made.append((i, made[i % 5][1], i % 3, 1, 2))
    made += [made[0], made[0], made[20], (0, made[3][1], 0, 1, 2), (20, made[5][1], 1, 1, 2)]
    made += [(300, None, 1, 1, 1), (301, [1.0, None], 1, 1, 1), (320, [float("nan")] * 6, 1, 1, 1), (340, [float("inf")], 1, 1, 1)]
    made += [(None, made[4][1], 1, 1, 1), (360, made[4][1], None, 1, 1), (380, [], 1, 1, 1), (400, [0.5, 0.25], 2, 1, 1)]
    return made + [(420, [3e30] * 6, 1, 1, 1), (440, [0.0] * 6, 2, 1, 1)]


def brute_negatives(rows, every, positives, negatives, window):
    seen = set()
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(c is None or not math.isfinite(c) for c in v) or max(v, default=0) > 1e20:
            continue
        x = [math.floor(256 * float(np.float32(c))) for c in v]
        seen.add((i, label, tuple(x + [0] * (6 - len(x)))))
    out = []
    for a in seen:
        if a[0] % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(a[2], b[2])), b[0], b[1] == a[1]) for b in seen if b != a)
        for p, i, _ in [s for s in scored if s[2]][:positives]:
            fits = [s for s in scored if not s[2] and window[0] * -p <= 100 * -s[0] <= window[1] * -p][:negatives]
            out += [(a[0], i, r, s[1], -p, -s[0]) for r, s in enumerate(fits, 1)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TREE_COMPONENTS", 6 * 60)
    monkeypatch.setattr(hard_negatives, "ANCHOR_COMPONENTS", 6 * 5)
    rows = vector_rows()
    table = share_code(spark).createDataFrame(rows, VECTORS).repartition(3)
    got = hard_negatives.mine(hard_negatives.prepared(table), F.col("id") % 20 == 0, 4, 6, (30, 95))
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows, 20, 4, 6, (30, 95))


def test_hard_negatives_of_no_rows(spark):
    empty = share_code(spark).createDataFrame([], VECTORS)
    assert hard_negatives.mine(hard_negatives.prepared(empty), F.col("id") % 2 == 0).count() == 0


# --- repeated passages


@given(st.integers(0, 10_000), st.integers(1, 40), st.integers(1, 3))
@settings(max_examples=40, deadline=None)
def test_run_index_marks_windows_of_smaller_documents(seed, n, letters):
    g = np.random.default_rng(seed)
    width, length = 12, 5
    strings = g.integers(0, letters + 1, (n, width)).astype(np.uint8)
    strings = np.concatenate([strings, strings[: n // 2]])
    n = len(strings)
    docs = g.integers(0, 6, n)
    begin = g.integers(0, 4, n)
    end = width - g.integers(0, 4, n)
    first = {}
    for i in range(n):
        for w in range(begin[i], end[i] - length + 1):
            k = (w, strings[i, w : w + length].tobytes())
            first[k] = min(first.get(k, 99), docs[i])
    want = [
        sum((first[w, strings[i, w : w + length].tobytes()] < docs[i]) << w for w in range(begin[i], end[i] - length + 1))
        for i in range(n)
    ]
    got = run_index.earlier(strings, docs, (begin, end), strings, docs, (begin, end), length)
    assert got.tolist() == want
    order = np.arange(n)
    for j, column in enumerate(run_index.columns(strings)):  # sorted by prefixes read backwards
        order = np.array(sorted(order.tolist(), key=lambda i: strings[i, j]))
        assert column.after.tolist() == order.tolist()
        keys = [strings[i, j::-1].tobytes() for i in order]
        assert keys == sorted(keys)


def test_matching_statistics_of_patterns_outside_the_index():
    g = np.random.default_rng(2)
    strings, patterns = g.integers(0, 3, (30, 10)).astype(np.uint8), g.integers(0, 4, (50, 10)).astype(np.uint8)
    row, length = np.zeros(50, np.int64), np.zeros(50, np.int64)
    for j, column in enumerate(run_index.columns(strings)):
        run_index.stream(column, j, strings, patterns, row, length)
        for p, m in zip(patterns, length):
            agree = [next((k for k in range(j + 1) if p[j - k] != s[j - k]), j + 1) for s in strings]
            assert m == max(agree)


def passage_rows():
    rnd = random.Random(11)
    letters = "abcdefg é\n"
    text = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    shared = [text(n) for n in (49, 50, 51, 80, 400, 26)]
    made = []
    for i in range(60):
        parts = [text(rnd.randint(0, 90))]
        for _ in range(rnd.randint(0, 3)):
            parts += [rnd.choice(shared), text(rnd.randint(0, 70))]
        made.append([rnd.randint(0, 40), "".join(parts)])
    made += [[99, "a" * 300], [98, "a" * 120], [97, "ab" * 100], [5, None], [6, ""], [None, shared[4]], [None, None]]
    made += [[200, shared[4] * 30 + text(3000)], [201, shared[4] * 3], [13, made[3][1]], [77, made[3][1]], [77, made[3][1]]]
    made += [[300 + i, shared[3] + text(30)] for i in range(40)]
    return [(i, t, "en", "s", 1, 1, "t", 1) for i, t in made]


def brute_passages(rows):
    n = repeated_passages.LENGTH
    first = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        if i is not None:
            for k in range(len(b) - n + 1):
                first[b[k : k + n]] = min(first.get(b[k : k + n], i), i)
    out = []
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if i is not None and first[b[k : k + n]] < i:
                gone[k : k + n] = b"\1" * n
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((-1 if i is None else i, len(b), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("block,strings", [(700, 16), (1 << 22, 1 << 17)])
def test_repeated_passages_equal_brute_force(spark, monkeypatch, block, strings):
    monkeypatch.setattr(repeated_passages, "BLOCK", block)
    monkeypatch.setattr(repeated_passages, "BUCKET_HASHES", 64)
    monkeypatch.setattr(repeated_passages, "BUCKET_STRINGS", strings)
    rows = passage_rows()
    docs = share_code(spark).createDataFrame(rows, DDL).repartition(3)
    got = [
        (-1 if r.doc_id is None else r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], hashlib.sha256(r.kept).hexdigest())
        for r in repeated_passages.without_repeats(docs).collect()
    ]
    assert sorted(got) == brute_passages(rows)


def test_repeated_passages_of_no_documents(spark):
    assert repeated_passages.without_repeats(share_code(spark).createDataFrame([], DDL)).count() == 0


def test_anchors_depend_on_the_string_alone():
    rnd = np.random.default_rng(4)
    passage = rnd.integers(97, 100, 300).astype(np.uint8)
    texts = [np.concatenate([rnd.integers(97, 123, n).astype(np.uint8), passage]) for n in (0, 7, 33)]
    inner = []
    for t in texts:
        place, key = repeated_passages.anchors(t, np.array([0, len(t)]), np.array([True]))
        at = place - (len(t) - 300)
        inside = at >= repeated_passages.LENGTH - repeated_passages.GRAM
        inner.append(list(zip(at[inside].tolist(), key[inside].tolist())))
    assert inner[0] == inner[1] == inner[2] and len(inner[0]) > 10
