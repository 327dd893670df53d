"""Operators of the language-model data package against brute force and edge cases."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fundcast.llm import (
    decontaminate, elias_fano, hashing, mixing, packed, quality, signature_join, suffix_tree, surrogates, token_files,
    toxicity, url_rules, warc,
)
from fundcast.session import scratch_path, share_code

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DDL = "doc_id long, text string, lang string, source string, n_chars long, fp long, label int, key string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows():
    """Copies, near copies, nulls, empties, ties, repeated rows, a long text."""
    rnd = random.Random(5)
    vocabulary = [a + b for a in "ba ke li mo nu".split() for b in "ra se ti vo za".split()]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    base = [text(rnd.randint(8, 60)) for _ in range(30)]
    out = list(base)
    for t in base[:12]:
        w = t.split(" ")
        w[len(w) // 2] = "CHANGED"
        out += [" ".join(w), t, t.upper()]
    out += [None, "", " \n\t ", "one two", "One  two", text(20000), "idiot you are a moron " + text(20)]
    made = [(i, t, "en", ["a", "b", None][i % 3], len(t or ""), 7, 1, "k") for i, t in enumerate(out)]
    return made + [made[0], made[0], (None, base[3], "en", "a", 1, 7, 1, "k"), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return share_code(spark).createDataFrame(rows(), DDL).repartition(3).cache()


@pytest.fixture()
def empty(spark):
    return share_code(spark).createDataFrame([], DDL)


def test_word_hashes_tell_words_apart():
    texts = ["Ab  c\tab", None, "", "x", "y z\n", "é É ab", " q"]
    h, bounds = hashing.words(pa.array(texts))
    flat = [w for t in texts for w in WORD.findall(lower(t))]
    assert len(flat) == len(h) and len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))
    assert np.diff(bounds).tolist() == [len(WORD.findall(t or "")) for t in texts]


def test_signature_join_equals_all_pairs(docs):
    def shingles(t):
        w = WORD.findall(lower(t))
        return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])

    data = [(r.doc_id, shingles(r.text)) for r in docs.collect()]
    group = list(range(len(data)))
    for i, (_, s) in enumerate(data):
        for j in range(i):
            t = data[j][1]
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    want = []
    for i, (d, s) in enumerate(data):
        ids = [data[j][0] for j in range(len(data)) if group[j] == group[i] and data[j][0] is not None]
        want.append((d, len(s), min(ids) if s and ids else d))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in signature_join.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_pipeline_keeps_one_document_of_every_component(spark, docs):
    a, b, c = ("".join(f"{x}{i} " for i in range(20)) for x in "abc")
    more = [(None, a), (None, b), (5000, a + "end"), (5001, c), (5001, "other " * 9), (5001, c), (None, c), (None, " "), (None, "x y"), (None, "z y")]
    data = [r[:5] for r in rows()] + [(i, t, "en", "a", len(t)) for i, t in more]
    every = share_code(spark).createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, every, "").collect()
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    sets = [shingles(WORD.findall(lower(r[1]))) for r in data]
    group = list(range(len(data)))
    for i, s in enumerate(sets):
        for j in range(i):
            if s and 100 * len(s & sets[j]) >= 75 * len(s | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    assert sum(not WORD.search(r.text or "") for r in got) == sum(not s for s in sets)
    least = {}
    for i, (d, *_) in enumerate(data):
        if sets[i]:
            least[group[i]] = min(least.get(group[i], (True, 0)), (d is None, d or 0))
    place = {r[:2]: g for r, g in zip(data, group, strict=True)}
    kept = sorted((place[r.doc_id, r.text], (r.doc_id is None, r.doc_id or 0)) for r in got if WORD.search(r.text or ""))
    assert kept == sorted(least.items())


def test_tree_bounds_lose_no_pair():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 1 << 63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rnd.random(60) < 0.9], rnd.integers(0, 1 << 63, rnd.integers(0, 12)).astype(np.uint64)])) for _ in range(60)]
    bits = np.stack([signature_join._fold(np.frombuffer(signature_join._bitmap(s), np.uint64)[None], 4)[0] for s in sets])
    tree = signature_join.Tree(np.array([len(s) for s in sets]), np.arange(60), bits)
    found = set(signature_join.dual_traversal(tree, tree, True))
    for j in range(60):
        for i in range(j):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                assert (i, j) in found


def test_suffix_tree_base_and_normalisation(docs, monkeypatch):
    monkeypatch.setattr(suffix_tree, "MIN_CONTEXT", 3)
    monkeypatch.setattr(suffix_tree, "MIN_PAIR", 2)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(r.doc_id, WORD.findall(lower(r.text)) + [None]) for r in docs.collect()]
    c = Counter(w for i, t in tokens if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted(
        ((i, len(t), sum(c[w] > 0 for w in t), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for i, t in tokens), key=repr
    )
    got = suffix_tree.fit_and_score(docs, lambda d: toxicity.fold(d, 7) != 2).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got), key=repr) == want
    assert {r.train_tokens for r in got} == {n}
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_scores_prefer_seen_continuations(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "MIN_CONTEXT", 3)
    monkeypatch.setattr(suffix_tree, "MIN_PAIR", 2)
    train = share_code(spark).createDataFrame([("a b c",)] * 9 + [("a b d",)] * 3 + [("d c",)] * 4, "text string")
    model = suffix_tree.fit(train)
    texts = spark.createDataFrame([(0, "a b"), (1, "a a"), (2, "a unseen")], "doc_id long, text string")
    s = {r.text: r.score for r in suffix_tree.score(texts, model).join(texts, "doc_id").collect()}
    assert all(x <= 0 for x in s.values()) and s["a b"] > s["a a"] and s["a b"] > s["a unseen"]


def tree_scores(train, texts):
    """Scores of ``texts`` by the suffix tree of ``train``, both lists of words, from dictionaries."""
    seen = [["", *t, None] for t in train]
    words = Counter(w for t in seen for w in t[1:])
    total = sum(words.values()) + len(words) + 1
    tree = {}  # kept context -> (gamma, {next word: probability})

    def p(context, w):
        if not context:
            return (words[w] + 1) / total
        gamma, listed = tree.get(context, (1, {}))
        return listed[w] if w in listed else gamma * p(context[1:], w)

    for depth in range(1, suffix_tree.DEPTH + 1):
        runs, level = {}, {}
        for t in seen:
            for i in range(len(t) - depth):
                runs.setdefault(tuple(t[i : i + depth]), Counter())[t[i + depth]] += 1
        for context, after in runs.items():
            n, rows = sum(after.values()), []
            for w, c in after.items():
                a, up = (c - suffix_tree.DISCOUNT) / n, p(context[1:], w)
                if c >= suffix_tree.MIN_PAIR and n >= suffix_tree.MIN_CONTEXT and a > suffix_tree.MIN_RATIO * up:
                    rows.append((w, a, up))
            if rows and sum(a * math.log(a / up) for _, a, up in rows) >= suffix_tree.MIN_DIVERGENCE:
                gamma = 1 - sum(a for _, a, _ in rows)
                level[context] = gamma, {w: a + gamma * up for w, a, up in rows}
        tree.update(level)
    return [
        sum(math.log10(p(tuple(t[max(0, i - suffix_tree.DEPTH) : i]), t[i])) for i in range(1, len(t)))
        for t in (["", *x, None] for x in texts)
    ]


@pytest.mark.parametrize("share", [2.0**-20, 2.0**-5])
def test_suffix_tree_equals_dictionaries(spark, monkeypatch, share):
    monkeypatch.setattr(suffix_tree, "SHARE", share)
    rnd = random.Random(11)
    text = lambda: [rnd.choice("abcdefghij") + rnd.choice("xyz" * 5 + "klmnopqrstuvw") for _ in range(rnd.randint(0, 12))]
    texts = [text() for _ in range(300)]
    for i in range(300):  # a frequent context whose next words are rare; three words whose last one depends on the first
        texts.append(["the", f"r{i % 50}"] + (["m", "u"] if i % 3 else ["n", "u", "v"]) + text())
    data = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = share_code(spark).createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: r.score for r in suffix_tree.fit_and_score(docs, lambda d: d % 4 != 0).collect()}
    want = tree_scores([t for i, t in enumerate(texts) if i % 4], texts)
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, abs=1e-6)


def test_contexts_seen_eight_times_are_kept(spark):
    train = [("p q",)] * 3 + [("p r",)] * 5 + [(f"w{i}",) for i in range(60)]
    values, *_ = suffix_tree.fit(share_code(spark).createDataFrame(train, "text string"))
    symbols, _ = suffix_tree.sequences(pa.array(["p q"]))
    pair = int(hashing.runs(symbols[1:3], 2)[:1].view(np.int64)[0])
    assert [r.c for r in values.where((F.col("key") == pair) & (F.col("length") == 2)).collect()] == [3]


def test_mix_meets_targets(docs):
    got = mixing.mix(docs).collect()
    by = {}
    for r in got:
        assert r.size == len(WORD.findall(next(t for i, t, *_ in rows() if i == r.doc_id) or "")) or r.doc_id is None
        assert 0 <= r.taken <= 2 * r.size
        s = by.setdefault(r.source, [0, r.target, r.source_size])
        s[0] += r.taken
    assert len(got) == docs.count()
    for taken, target, size in by.values():
        assert abs(taken - target) <= 1 and target <= 2 * size + 1e-6
    assert sum(t for _, t, _ in by.values()) == pytest.approx(1.5 * sum(z for _, _, z in by.values()))
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs.repartition(5)).collect()))


def test_quality_measures_equal_python(docs):
    def measure(text):
        text = text or ""
        w = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
        return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))

    got = quality.judge(quality.measures(docs.withColumn("text", F.concat("text", F.lit("\na#b\na#b")))))
    texts = [(None if t is None else t + "\na#b\na#b") for _, t, *_ in rows()]
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got.collect()) == sorted(map(measure, texts))
    assert got.where("base_failed and kept").count() == 0


def test_myers_equals_dynamic_programming():
    rnd = random.Random(3)
    for _ in range(500):
        p = [rnd.randint(0, 4) for _ in range(rnd.randint(1, 9))]
        t = [rnd.randint(0, 4) for _ in range(rnd.randint(0, 15))]
        k, row, best = rnd.randint(0, 4), list(range(len(p) + 1)), None
        best = (k + 1, -1)
        for j, w in enumerate(t):
            new = [0]
            for i in range(1, len(p) + 1):
                new.append(min(row[i - 1] + (p[i - 1] != w), row[i] + 1, new[i - 1] + 1))
            row = new
            if row[-1] < best[0]:
                best = (row[-1], j)
        assert decontaminate.myers(p, t, k) == best


def test_decontamination_finds_edited_items(spark, docs, empty):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    edited = item.replace("gamma", "GAMMA,").replace("kappa ", "").replace("pi", "po")
    found = [(1, "x " + item + " y"), (2, "x " + edited + " y"), (3, "x " + " ".join(item.split()[:9])), (4, None)]
    texts = share_code(spark).createDataFrame(found, "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, None), (9, "!")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.distance) for r in decontaminate.matches(texts, items).collect()) == [(1, 7, 0), (2, 7, 2)]
    assert decontaminate.remove(docs, items).count() == docs.count()
    assert decontaminate.matches(empty, items).count() == 0


def test_decontamination_judges_rows_with_null_and_repeated_ids(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    data = [(None, "x " + item), (None, "clean"), (None, None), (5, item + " y"), (5, "clean too"), (6, "z")]
    texts = share_code(spark).createDataFrame(data, "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = [tuple(r) for r in decontaminate.remove(texts, items).collect()]
    assert sorted(got, key=repr) == sorted([r for r in data if item not in (r[1] or "")], key=repr)


def test_elias_fano_round_trip():
    rnd = random.Random(2)
    for n in (0, 1, 2, 300, 1000):
        v = np.sort(np.array([rnd.randint(-5, 10**6) for _ in range(n)], np.int64))
        s = elias_fano.Sequence(elias_fano.encode(v))
        assert s.range(0, n).tolist() == v.tolist()
        assert n == 0 or s.select(n // 2) == v[n // 2]


def test_token_files_round_trip(spark, docs, empty):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    e = token_files.Encoder(path)
    for text in ("", " a  b ", "it's 12 é中 <|endoftext|> x", "\n a b", "word, word!"):
        assert np.frombuffer(e(text), e.kind).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids
    got = token_files.read(spark, token_files.write(docs, scratch_path(spark, "t"), path)).orderBy("start").collect()
    start = 0
    for r in got:
        assert r.start == start and len(r.ids) == 4 * r.n_tokens
        start += r.n_tokens
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x)) and len(ids) == docs.count()
    assert token_files.read(spark, token_files.write(empty, scratch_path(spark, "t"), path)).count() == 0


def test_warc_round_trip(spark):
    page = [(i, f"http://h/{i}", "x" * 120 + str(i % 3) if i % 2 else "ab") for i in range(12)] + [(None, None, None)]
    pages = share_code(spark).createDataFrame(page, "page_id long, url string, html string")
    path = warc.write(pages, scratch_path(spark, "w"))
    got = {r.page_id: r for r in warc.read(spark, path).collect()}
    first = {}
    for i, _, html in page:
        if html and len(html) >= 100:
            first.setdefault(html, i)
        r = got[i]
        refers = first.get(html, i)
        assert r.record_type == ("response" if refers == i else "revisit")
        assert r.refers_to == (None if refers == i else refers)
        assert r.payload_bytes == len(html or "") and (r.payload is None or bytes(r.payload) == (html or "").encode())
    assert warc.read(spark, path, payload=False).where("record_type = 'revisit'").count() == 3
    assert warc.read(spark, warc.write(pages.limit(0), scratch_path(spark, "w"))).count() == 0


def test_url_rules_and_mined_rules(spark):
    rules = [("allow", "org", "/"), ("block", "example.org", "/en/1")]
    urls = [(i, f"http://{'spam' if i % 4 == 0 else 'ok'}.test/x/{i}") for i in range(200)]
    urls += [(900, None), (901, "no scheme"), (902, "http://A.Example.ORG/en/12?q"), (903, "http://b.org?x"), (904, "http://b.org/")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labelled = pages.where("page_id < 150").select("url", (F.col("page_id") % 4 == 0).alias("bad"))
    got = {r.page_id: r for r in url_rules.judge(pages, labelled, rules).collect()}
    assert len(got) == len(urls)
    assert all((got[i].verdict == "block") == (i % 4 == 0) for i in range(200))
    assert (got[900].host, got[900].path, got[900].verdict) == ("", "", "allow")
    assert (got[902].host, got[902].rule, got[902].verdict) == ("a.example.org", "example.org/en/1", "block")
    assert got[903].rule is None and got[904].rule == "org/"
    assert url_rules.judge(pages, labelled.limit(0), rules).count() == len(urls)


def test_surrogates_keep_type_and_coreference(spark, empty):
    key = b"test"
    assert len({surrogates.permute(key, "t", v, 10, 100) for v in range(1000)}) == 1000
    text = "Mrs Helena Bell, a.b@mail7.example.com, 97.51.17.173, 4111 1111 1111 1111, +1 (017) 555-7713; Mr Bell A.B@mail7.example.com"
    data = [(1, text), (2, "clean 12 text."), (3, None), (4, ""), (5, "97.51.17.173")]
    got = {r.doc_id: r for r in surrogates.pseudonymise(share_code(spark).createDataFrame(data, "doc_id long, text string"), key).collect()}
    assert got[2].text == data[1][1] and got[3].text is None and got[4].text == ""
    new = got[1].text
    for old in ("Bell", "a.b@mail7", "97.51", "4111", "7713"):
        assert old not in new
    kinds = {r.kind: r.surrogate for r in got[1].replaced}
    assert surrogates.luhn(surrogates._digits(kinds["card"])) and got[5].text == kinds["ip"]
    families = [r.surrogate for r in got[1].replaced if r.kind == "family"]
    assert families[0] == families[1] and kinds["given"] in surrogates.GIVEN["latin", "f"]
    assert surrogates.pseudonymise(empty, key).count() == 0


def test_surrogates_of_given_names_differ(spark):
    first = [x + y for x in "Ba De Fi Go Lu Mo".split() for y in "bba cca dda ffa gga lla mma nna".split()] + surrogates.GIVEN["latin", "f"]
    data = [(i, f"Mrs {n} Smith") for i, n in enumerate(first)] + [(900, "Mr Babba Smith"), (901, "Dr Babba Smith"), (902, "Helena Smith")]
    data += [(903, "the key sk-abcdefghijklmnopqrstuv is out")]
    texts = share_code(spark).createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: r for r in surrogates.pseudonymise(texts, b"test").collect()}
    new = {i: [x.surrogate for x in r.replaced if x.kind == "given"] for i, r in got.items()}
    names = [new[i][0] for i in (*range(len(first)), 900, 901)]
    assert len(set(names)) == len(names) and not set(names) & set(first)
    assert new[902] == new[first.index("Helena")] and "sk-abcdefgh" not in got[903].text


def test_toxicity_with_and_without_labels(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, none))
    got = {r.doc_id: r for r in scored.collect()}
    assert scored.count() == docs.count() and all(0 <= r.score <= 1 for r in got.values())
    insult = next(i for i, t, *_ in rows() if t and t.startswith("idiot"))
    assert got[insult].predicted == 1 and got[1].predicted == 0
    data = [(i, f"you {'idiot scum' if i % 3 == 0 else 'friend here'} word{i % 7} again") for i in range(240)]
    texts = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)], "doc_id long, toxic int")
    out = toxicity.score(texts, toxicity.fit(texts, labels)).collect()
    assert sum(r.predicted == int(r.doc_id % 3 == 0) for r in out) >= 230
    assert toxicity.score(empty, toxicity.Model(toxicity.plain_lexicon())).count() == 0


def test_empty_tables(spark, empty):
    assert signature_join.near_duplicates(empty).count() == 0
    assert suffix_tree.fit_and_score(empty, lambda d: F.lit(True)).count() == 0
    assert mixing.mix(empty).count() == 0
    assert quality.judge(quality.measures(empty)).count() == 0


def test_a_cells_leader_is_compared_once(spark, monkeypatch):
    asked = []
    kept = signature_join._possible
    monkeypatch.setattr(signature_join, "_possible", lambda pairs, known: asked.append(pairs.collect()) or kept(pairs, known))
    opened = []
    marks = signature_join._tree_pairs
    monkeypatch.setattr(signature_join, "_tree_pairs", lambda marked, known: opened.append(marked.count()) or marks(marked, known))
    shared = "s1 s2 s3 s4 s5"
    # texts that share one rare shingle and do not link: cells of two and of three members
    texts = [" ".join([*(f"{c}{i}" for i in range(12)), shared.replace("s", t), *(f"{c}{i}" for i in range(12, 24))]) for t, cs in (("s", "ab"), ("t", "cde")) for c in cs]
    docs = share_code(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    monkeypatch.setattr(signature_join, "prefix_length", lambda n: n)  # all shingles are filed
    monkeypatch.setattr(signature_join, "LOCAL_HOT", 100)
    fps = signature_join.fingerprints(signature_join.shingle_sets(pa.array(texts))).tolist()
    monkeypatch.setattr(signature_join, "_with_company", lambda *_: spark.createDataFrame([(fp,) for fp in fps], "fp long"))
    _, found = signature_join.links(docs)
    assert found.count() == 0
    pairs = [(r.a, r.b) for rows in asked for r in rows]
    assert len(pairs) == len(set(pairs)) == 1 + 3 and opened == [0]


def test_tree_pairs_move_narrow_bitmaps(spark, docs):
    _, bits = signature_join._bitmaps([np.arange(100, dtype=np.uint64), np.zeros(0, np.uint64)])
    assert len(bits[0]) * signature_join.NARROW == len(signature_join._bitmap(np.arange(100, dtype=np.uint64))) and bits[1] is None


@pytest.mark.parametrize("bits", [3, 6])
def test_buckets_answer_parts_not_texts(spark, monkeypatch, bits):
    """What the look-up gives is as many rows as parts ask, however many texts these have."""
    monkeypatch.setattr(suffix_tree, "bucket_bits", lambda *_: bits)
    rnd = random.Random(3)
    data = [(i % 290, " ".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20)) + (" z" if i < 290 else "")) for i in range(300)]
    data += data[:10]  # equal rows in another part
    docs = share_code(spark).createDataFrame(data, "doc_id long, text string").repartition(2)
    monkeypatch.setattr(suffix_tree, "SHARE", 1.0)
    model = suffix_tree.fit(docs.select("text"))
    made = []
    plain = suffix_tree.cut_lineage
    monkeypatch.setattr(suffix_tree, "cut_lineage", lambda df, name: _noted(made, plain, df, name))
    got = suffix_tree.score(docs, model).collect()
    assert len(got) == len(data)
    assert sorted(r.n_tokens for r in got) == sorted(len(t.split()) + 1 for _, t in data)
    plan = next(p for n, p in made if n == "score-sums")
    assert "FlatMapGroupsInArrow" in plan and "FlatMapCoGroupsInArrow" in plan


def _noted(made, plain, df, name):
    made.append((name, df._jdf.queryExecution().executedPlan().toString()))
    return plain(df, name)


def test_linked_sets_share_a_quarter_of_their_long_prefixes():
    rnd = np.random.default_rng(5)
    linked = 0
    for _ in range(3000):
        base = np.unique(rnd.integers(0, 1 << 62, rnd.integers(1, 90)).astype(np.uint64))
        x, y = (np.unique(np.concatenate([base[rnd.random(len(base)) < 0.9], rnd.integers(0, 1 << 62, rnd.integers(0, 8)).astype(np.uint64)])) for _ in "xy")
        both = len(np.intersect1d(x, y))
        if both and 4 * both >= 3 * (len(x) + len(y) - both):
            linked += 1
            shared = len(np.intersect1d(*(s[: signature_join.long_prefix(len(s))] for s in (x, y))))
            assert shared >= max(signature_join.least_shared(len(s)) for s in (x, y))
    assert linked > 300


def test_classes_that_share_too_little_are_not_filed(spark, monkeypatch):
    made = {}
    plain = signature_join.cut_lineage
    monkeypatch.setattr(signature_join, "cut_lineage", lambda df, name: _kept(made, name, plain(df, name)))
    words = lambda c, n: [f"{c}{i}" for i in range(n)]
    texts = [words("a", 80), words("a", 78) + ["x"], *([*words(c, 70), *words("s", 6)] for c in "bcdefgh")]
    docs = share_code(spark).createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    _, found = signature_join.links(docs)
    assert found.count() == 1 and made["company"].count() == 2


def _kept(made, name, table):
    made.setdefault(name, table)
    return table


def test_blocks_return_links_that_connect_not_all_pairs(spark, monkeypatch):
    """Of a group of which every two link, a task that joins blocks returns as many links as connect it."""
    rnd = np.random.default_rng(7)
    sets = [np.sort(rnd.integers(0, 1 << 63, 200).astype(np.uint64)) for _ in range(2)]
    sets = [s[np.sort(rnd.permutation(200)[:190])] for s in sets for _ in range(20)]  # two groups of 20
    bits = signature_join._bitmaps(sets)[1]
    rows = {"fp": np.arange(40), "n": np.full(40, 190), "label": np.arange(40), "narrow": bits, "shingles": [s.tobytes() for s in sets]}
    for side in (np.zeros(40, np.int64), np.arange(40) % 2):  # a block with itself, and two blocks
        out = signature_join._join_blocks(pa.table({**rows, "side": side}))
        assert out.num_rows == 2 * 19
        group = {i: i for i in range(40)}
        for a, b in zip(*(out.column(c).to_pylist() for c in "ab"), strict=True):
            group = {k: group[a] if g == group[b] else g for k, g in group.items()}
        assert len({group[i] for i in range(20)}) == len({group[i] for i in range(20, 40)}) == 1 and group[0] != group[20]
    # members that are connected already give no link
    assert not signature_join._join_blocks(pa.table({**rows, "side": np.zeros(40, np.int64), "label": np.arange(40) // 20})).num_rows
    # a block holds fewer members where these are large
    monkeypatch.setattr(signature_join, "BLOCK_BITS", 1 << 12)
    marked = spark.range(40).select(F.lit(1).alias("cell"), F.col("id").alias("fp"), F.col("id").alias("label"), F.lit(190).alias("n"))
    known = spark.range(40).select(F.col("id").alias("fp"), F.when(F.col("id") < 20, 64).otherwise(256).alias("width"))
    cut = signature_join._blocks(marked, known, "fp").groupBy("width", "block").count()
    assert {(r.width, r["count"]) for r in cut.collect()} == {(64, 20), (256, 16), (256, 4)}


def test_pairs_are_ordered_exactly_by_halves():
    rnd = np.random.default_rng(2)
    a = rnd.integers(0, 50, 3000).astype(np.uint64)
    for b in (rnd.integers(0, 1 << 63, 40).astype(np.uint64)[rnd.integers(0, 40, 3000)], rnd.integers(0, 9, 3000).astype(np.uint64)):  # the latter agree in their leading half
        order = packed.pair_order(a, b)
        pairs = list(zip(a[order].tolist(), b[order].tolist(), strict=True))
        runs = 1 + sum(x != y for x, y in zip(pairs, pairs[1:], strict=False))
        assert sorted(order.tolist()) == list(range(3000)) and runs == len(set(pairs)) and sorted(a[order].tolist()) == a[order].tolist()


def test_suffix_tree_joins_counted_runs_once(spark, docs, monkeypatch):
    """Transitions and contexts are made from one joined table, and the table of values
    is packed by bucket in few rows, however small the batches are."""
    monkeypatch.setattr(suffix_tree, "MIN_CONTEXT", 3)
    monkeypatch.setattr(suffix_tree, "MIN_PAIR", 2)
    made = []
    plain = suffix_tree.cut_lineage
    monkeypatch.setattr(suffix_tree, "cut_lineage", lambda df, name: _noted(made, plain, df, name))
    suffix_tree.fit(docs.select("text"))
    assert [n for n, p in made if re.search(r"Join.*next#", p)] == ["likelier-1", "likelier-2"]
    batches = [pa.RecordBatch.from_arrays([pa.array([i, i + 1])], names=["x"]) for i in range(0, 14, 2)]
    assert [b.column("x").to_pylist() for b in packed.gathered(iter(batches), 5)] == [[0, 1, 2, 3, 4, 5], [6, 7, 8, 9, 10, 11], [12, 13]]
