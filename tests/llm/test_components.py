"""Connected components against a plain union of links, and what they cost."""

import random

import pytest

from fundcast.llm import components as C
from fundcast.session import share_code


def plain(links):
    above = {x: x for p in links for x in p}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        above[y] = x
    return {x: root(x) for x in above}


def shapes():
    rnd = random.Random(3)
    chain = list(range(-400, 400))
    rnd.shuffle(chain)
    out = [(a, b) for a, b in zip(chain, chain[1:])]
    out += [(5_000, 5_000 + i) for i in range(1, 300)] + [(9_999_999, 9_999_000 + i) for i in range(300)]
    out += [(rnd.randrange(20_000, 20_600), rnd.randrange(20_000, 20_600)) for _ in range(500)]
    return out + out[:50] + [(b, a) for a, b in out[:50]]


@pytest.mark.parametrize("held", [1 << 18, 40])
def test_components_equal_a_plain_union(spark, monkeypatch, held):
    monkeypatch.setattr(C, "BUCKET_LINKS", held)
    links = [p for p in shapes() if p[0] != p[1]]
    frame = share_code(spark).createDataFrame(links + [(7_777, 7_777)], "a long, b long").repartition(4)
    got = [(r.node, r.component) for r in C.components(frame).collect()]
    assert len(got) == len(dict(got)) and dict(got) == plain(links)
    assert C.components(frame.where("a = 7777")).count() == 0


def test_few_links_settle_in_few_jobs(spark, monkeypatch):
    made = []
    monkeypatch.setattr(C, "cut_lineage", lambda df, name, f=C.cut_lineage: made.append(name) or f(df, name))
    C.components(share_code(spark).createDataFrame(shapes(), "a long, b long").repartition(4)).count()
    assert len(made) <= 4
