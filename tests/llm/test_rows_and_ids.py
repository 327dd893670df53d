"""Rows that share or lack an id, foreign archives, and every id of the token files."""

import gzip
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundcast.llm import files, mixing, quality, token_files, url_rules, warc
from fundcast.llm.queries import token_digest
from fundcast.session import scratch_path, share_code


def record(i, kind, payload):
    head = (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{i}>\r\nWARC-Target-URI: http://h/{i}\r\n"
        f"WARC-Date: 2020-01-01T00:00:00Z\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    )
    return head.encode() + payload + b"\r\n\r\n"


@pytest.mark.parametrize("layout", ["one member", "member each", "cut anywhere"])
def test_archives_from_elsewhere_keep_all_their_records(spark, layout):
    rnd = random.Random(1)
    payloads = [rnd.randbytes(rnd.choice([0, 10, 300, 70_000])) for _ in range(9)]
    records = [record(i, "response", p) for i, p in enumerate(payloads)]
    whole = b"".join(records)
    if layout == "one member":
        data = gzip.compress(whole)
    elif layout == "member each":
        data = b"".join(map(gzip.compress, records))
    else:
        data = b"".join(gzip.compress(whole[i : i + 1000]) for i in range(0, len(whole), 1000))
    folder = scratch_path(spark, "foreign")
    files.make_dir(folder)
    where, name = files.locate(files.child(folder, "a.warc.gz"))
    with where.open_output_stream(name, compression=None) as out:
        out.write(data)
    got = warc.read(share_code(spark), folder).collect()
    assert sorted(bytes(r.payload) for r in got) == sorted(payloads)
    assert warc.read(spark, folder, payload=False).count() == len(payloads)


def test_a_url_is_judged_by_itself(spark):
    urls = [(i, f"http://{'spam' if i % 4 == 0 else 'ok'}.test/x/{i}") for i in range(200)]
    labelled = spark.createDataFrame(urls[:150], "page_id long, url string").select(
        "url", (F.col("page_id") % 4 == 0).alias("bad"))
    rows = [(None, "http://spam.test/x/1"), (None, "http://ok.test/x/1"), (None, None), (7, "http://spam.test/y"), (7, "http://ok.test/y"), (7, "http://ok.test/y")]
    pages = share_code(spark).createDataFrame(rows, "page_id long, url string")
    got = Counter((r.page_id, r.host, r.verdict) for r in url_rules.judge(pages, labelled).collect())
    assert got == Counter([
        (None, "spam.test", "block"), (None, "ok.test", "allow"), (None, "", "allow"),
        (7, "spam.test", "block"), (7, "ok.test", "allow"), (7, "ok.test", "allow"),
    ])


def test_mined_rules_equal_enumerated_ones(spark):
    rnd = random.Random(2)
    words = ["a1", "b2", "c3", "d4", "e5"]
    urls = [f"http://h.test/{'/'.join(rnd.sample(words, rnd.randint(1, 3)))}" for _ in range(300)]
    bad = [("a1" in u and "b2" in u) or (rnd.random() < 0.05) for u in urls]
    labelled = share_code(spark).createDataFrame(list(zip(urls, bad)), "url string, bad boolean")
    mined = url_rules.mine(labelled).collect()
    tokens = {u: set(r.own) for u, r in zip(urls, labelled.select(url_rules.url_tokens(F.col("url")).alias("own")).collect())}
    assert any(set(r.tokens) >= {t for t in r.tokens} and r.confidence > 0.8 for r in mined)
    for r in mined:  # support and confidence are those of the labelled urls
        hold = [b for u, b in zip(urls, bad) if tokens[u] >= set(r.tokens)]
        assert sum(hold) >= r.support and abs(sum(hold) / len(hold) - r.confidence) < 1e-9


DDL = "doc_id long, text string, lang string, source string, n_chars long"


def texts():
    rnd = random.Random(9)
    letters = ["word", "Wörter", "it's", "12", "中文", "\n", "\t ", "a,b", "<|endoftext|>", "x" * 60, "é", ".", "  "]
    made = [(i, " ".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))), "en", "ab"[i % 2], 1) for i in range(60)]
    return made + [(70, None, "en", None, 1), (70, "twice", None, "a", 1), (None, "no id", "en", "a", 1), (71, "long " * 30_000, "en", "a", 1)]


def test_every_id_of_the_token_files_is_the_tokenizers(spark, monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "MEMO", 5)
    whole = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    want = Counter()
    for i, text, *_ in texts():
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    docs = share_code(spark).createDataFrame(texts(), DDL).repartition(3)
    got = token_digest(spark, docs).orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]


def test_targets_of_each_source_equal_filling_by_weight(spark):
    rnd = random.Random(4)
    sizes = {"b": 9000, "a": 100, "c": 700, None: 50, "é": 2000, "z": 0}
    rows, i = [], 0
    for source, words in sizes.items():
        while words > 0:
            n = min(words, rnd.randint(1, 90))
            rows.append((i, "w " * n, "en", source, 1))
            i, words = i + 1, words - n
    rows.append((i, "", "en", "z", 1))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: [5, 2, 1][k % 3] for k, s in enumerate(order)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(sizes)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not full:
            target.update({s: level * weight[s] for s in free})
            break
        target.update({s: 2.0 * sizes[s] for s in full})
        left -= sum(2 * sizes[s] for s in full)
        free -= full
    docs = share_code(spark).createDataFrame(rows, DDL)
    got = {r.source: (r.target, r.taken) for r in mixing.mix(docs).groupBy("source").agg(
        F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()}
    for s, t in target.items():
        assert got[s][0] == pytest.approx(t) and abs(got[s][1] - t) <= 1


def test_host_verdicts_equal_the_shrunk_rates(spark):
    rnd = random.Random(6)
    rows = []
    for host, n, share in (("good", 300, 0.02), ("bad", 80, 0.9), ("tiny", 2, 1.0), (None, 40, 0.3)):
        rows += [(i, "x" if rnd.random() < share else " ".join(f"w{rnd.random()}" for _ in range(60)), "en", host, 1) for i in range(n)]
    docs = share_code(spark).createDataFrame(rows, DDL).repartition(3)
    got = quality.judge(quality.measures(docs)).collect()
    n, k = Counter(), Counter()
    for _, text, _, host, _ in rows:
        n[host] += 1
        k[host] += text == "x"
    m = sum(k.values()) / len(rows)
    spread = sum(n[h] * (k[h] / n[h]) ** 2 for h in n) / len(rows) - m * m
    s = min(max(m * (1 - m) / max(spread - m * (1 - m) * len(n) / len(rows), 1e-12) - 1, 2.0), 1000.0)
    for r in got:
        rate = (k[r.source] + m * s) / (n[r.source] + s)
        assert r.host_rate == pytest.approx(rate) and r.kept == (not r.base_failed and rate <= quality.MAX_HOST_RATE)


def test_a_person_stays_one_through_titles_and_bare_mentions(spark):
    from fundcast.llm import surrogates

    def new(text):
        return surrogates.replace(text, b"k", {})[0]

    said = new("Dr Sarah Connor spoke. Mrs Sarah Connor left. Sarah Connor, or Connor, wrote. Connors did not.")
    words = said.replace(",", "").replace(".", "").split()
    given, family = words[1:3]
    assert {given, family}.isdisjoint({"Sarah", "Connor"})
    assert words[5:7] == words[8:10] == [given, family] and words[11] == family and words[13] == "Connors"
    said = new("Before Smith. Mr John Smith met us. John Smith said hi. Smith left.")
    assert said.startswith("Before Smith.") and said.count("Smith") == 1 and "John" not in said
    docs = share_code(spark).createDataFrame([(1, "Mr John Smith met us. John Smith said hi. Smith left.")], "doc_id long, text string")
    row = surrogates.pseudonymise(docs, b"k").first()
    assert "Smith" not in row.text and len(row.replaced) == 5


def test_names_have_room_for_more_than_one_attempt_can_hold(monkeypatch):
    from fundcast.llm import surrogates

    monkeypatch.setattr(surrogates, "SHORTEST", 1)  # some forty names of one syllable
    letters = "abcdefghijklmnopqrstuvwxyz"
    pending, given, attempt = [f"Q{a}{b}xw" for a in letters for b in letters], set(), 0
    while pending:  # as the rounds do, one name of those that draw alike
        drawn = {}
        for n in pending:
            drawn.setdefault(surrogates._family(b"k", n, attempt), n)
        assert all(len(x) == 2 * (1 + attempt) for x in drawn)
        given |= set(drawn)
        pending = [n for n in pending if n not in drawn.values()]
        attempt += 1
        assert attempt < surrogates.MAX_ATTEMPTS
    assert len(given) == len(letters) ** 2 and attempt > 1


def test_decontamination_equals_the_edit_matrix_of_every_pair(spark):
    from fundcast.llm import decontaminate

    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [[rnd.choice(vocabulary) for _ in range(n)] for n in (1, 5, 7, 14, 20, 27, 40)]
    docs = []
    for _ in range(60):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 30))]
        part = list(rnd.choice(items))
        for _ in range(rnd.randint(0, 6)):  # edits
            at = rnd.randrange(len(part) + 1)
            part[at : at + rnd.randint(0, 1)] = [rnd.choice(vocabulary)] * rnd.randint(0, 1)
        docs.append(words + part + [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 20))])

    def distance(pattern, text):  # of the best place in the text
        row = [0] * (len(text) + 1)
        for i, p in enumerate(pattern, 1):
            new = [i]
            for j, t in enumerate(text, 1):
                new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != t)))
            row = new
        return min(row)

    want = {}
    for d, text in enumerate(docs):
        for k, item in enumerate(items):
            n = distance(item, text)
            if n <= decontaminate.budget_of(len(item)):
                want[d, k] = n
    share_code(spark)
    frame = spark.createDataFrame([(d, " ".join(t).title()) for d, t in enumerate(docs)], "doc_id long, text string").repartition(3)
    tests = spark.createDataFrame([(k, ", ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.matches(frame, tests).collect()}
    assert got == want and any(n for n in want.values())


def test_token_files_start_no_python_processes_beside_the_driver(spark):
    public = pytest.importorskip("public_tokenizers")
    psutil = pytest.importorskip("psutil")
    docs = share_code(spark).createDataFrame(texts(), DDL).repartition(3)
    planning = lambda: {
        p.pid for p in psutil.Process().children(recursive=True) if "pyspark.sql.worker." in " ".join(p.cmdline())
    }
    before = planning()
    path = token_files.write(docs, scratch_path(spark, "t"), public.path("byte_bpe_50k.json"))
    assert token_files.read(spark, path).count() == docs.count()
    assert planning() <= before
