"""The template tree against a plain one, at any depth."""

import random

import pyarrow.parquet as pq
import pytest

from headway.llm.queries import QUERIES, RULES
from headway.llm.url_templates import judge_urls
from tests.conftest import SMALL
from tests.llm import brute


def judged(spark, urls, rules, **settings):
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = judge_urls(frame, rules, **settings).collect()
    return [(r["url_template"], r["url_verdict"]) for r in sorted(rows, key=lambda r: r["page_id"])]


@pytest.mark.parametrize("which", ["small", "odd"])
def test_query_equals_plain_tree(spark, odd, which):
    folder = SMALL if which == "small" else odd
    pages = pq.read_table(f"{folder}/pages.parquet", columns=["page_id", "url"]).to_pylist()
    want = brute.url_verdicts([p["url"] for p in pages], RULES)
    expected = sorted(
        (str(p["page_id"]), *brute.url_parts(p["url"]), *w) for p, w in zip(pages, want, strict=True)
    )
    rows = QUERIES["op6_url_templates"](spark, folder).collect()
    assert expected == sorted(
        (str(r["page_id"]), r["host"], r["path"], r["template"], r["verdict"]) for r in rows
    )


def test_branches_below_the_third_segment_are_told_apart(spark):
    rules = [("block", "h.org/a/b/c/bad/x"), ("allow", "h.org/a/b/c/good/")]
    urls = [f"http://h.org/a/b/c/bad/x{i}" for i in range(12)]
    urls += [f"http://h.org/a/b/c/good/y{i}/z" for i in range(12)]
    urls += ["http://h.org/a/b/c/bad/unlabelled", "http://h.org/a/b/c/good/also?x", "http://h.org/else"]
    found = judged(spark, urls, rules)
    assert found == brute.url_verdicts(urls, rules)
    assert found[-3][1] == "block" and found[-2][1] == "allow"
    assert found[0] != found[12]


def test_method_blocks_what_no_rule_names(spark):
    rules = [("block", f"s.net/shop/{w}") for w in ("aa", "bb", "cc", "dd", "ee", "ff")]
    rules += [("allow", f"s.net/news/{w}") for w in ("aa", "bb", "cc", "dd", "ee", "ff")]
    urls = [f"http://s.net/{kind}/{w}/{k}" for kind in ("shop", "news")
            for w in ("aa", "bb", "cc", "dd", "ee", "ff", "gg") for k in ("p", "q", "r")]
    found = judged(spark, urls, rules)
    assert found == brute.url_verdicts(urls, rules)
    by_url = dict(zip(urls, found, strict=True))
    assert by_url["http://s.net/shop/gg/p"][1] == "block"
    assert by_url["http://s.net/news/gg/p"][1] == "allow"


@pytest.mark.parametrize("seed", range(4))
def test_random_trees(spark, seed):
    draw = random.Random(seed)
    names = ["a", "b", "c", "item7", "x%20y", "", "d"]
    urls = []
    for _ in range(300):
        depth = draw.randrange(7)
        path = "/".join(draw.choice(names) for _ in range(depth))
        urls.append(f"http://{draw.choice('gh')}.org/{path}" + draw.choice(["", "/", "?q#f"]))
    rules = [("block", "g.org/a/b"), ("allow", "g.org/a"), ("block", "h.org/b/c/d"),
             ("allow", "h.org/b/c"), ("allow", "org/d/")]
    settings = {"most_children": 4, "alike_at": 1.0, "reject_at": 0.6}
    assert judged(spark, urls, rules, **settings) == brute.url_verdicts(urls, rules, **settings)
