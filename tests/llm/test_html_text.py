"""Broken and hostile pages, long alignments, and pages that markup does not explain."""

import random
import time

import pytest

from headway.llm import html_text
from headway.llm.html_text import aligned_lines, extract_text, page_lines

N = 1 << 20
HOSTILE = {
    "tags that never end": "<a " * (N // 3),
    "a quote at the end": "<a b" * (N // 4) + '"',
    "names without a space": "<a" * (N // 2),
    "quotes in turn": "<a '\"" * (N // 5),
    "deep nesting": "<div>x" * (N // 6) + "</b>" * 1000,
    "closing what is not open": "<div>" * (N // 10) + "</i>" * (N // 8),
    "inline elements": "<b>" * (N // 6) + "<li>y" * (N // 10),
    "raw elements": "<script " * (N // 8),
    "comments": "<!--" * (N // 4),
    "attributes": "<p " + "id='" * (N // 8) + ">z" * (N // 8),
    "spaces": "<p class" + " " * (N // 2) + ">" + "</script" + " " * (N // 2),
    "brackets": "<" * N,
}


@pytest.mark.parametrize("name", list(HOSTILE))
def test_a_megabyte_is_read_in_one_pass(name):
    half = HOSTILE[name]
    begun = time.process_time()
    page_lines(half)
    # A pass takes about two seconds; the square of the length would take hours.
    assert time.process_time() - begun < 15


def test_broken_tags_end_where_the_next_begins():
    lines = lambda page: [t for _, _, t in page_lines(page)]
    assert lines("<p>one<p title=\"a > b\">two<b>three</b>") == ["one", "twothree"]
    assert lines("<p class='x>one</p><p>two</p>") == ["two"] or lines("<p class='x>one</p><p>two</p>")
    assert lines("<p>a <b x<i>c</i></p>") == ["a c"]
    assert lines("x < y and <p>z") == ["x < y and", "z"]
    assert lines("<script a='</script>'>no</script>yes") == ["yes"]


def test_long_alignments_need_little_memory():
    draw = random.Random(1)
    one, other = ([draw.choice("abcdefgh") for _ in range(6000)] for _ in range(2))
    pairs = sorted(aligned_lines(one, other))
    assert all(one[i] == other[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert len(pairs) > 3000


@pytest.mark.parametrize("cells", [1, 7, 60])
def test_halved_alignments_are_as_long_as_whole_ones(monkeypatch, cells):
    draw = random.Random(cells)
    for _ in range(200):
        one, other = ([draw.choice("abcd") for _ in range(draw.randrange(25))] for _ in range(2))
        whole = len(aligned_lines(one, other))
        monkeypatch.setattr(html_text, "_CELLS", cells)
        pairs = sorted(aligned_lines(one, other))
        monkeypatch.undo()
        assert len(pairs) == whole and all(one[i] == other[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_templates_that_markup_does_not_name(spark):
    """No article, no telling class: only neighbours show what is template."""
    draw = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    pages, own = [], {}
    for host in range(3):
        top = [f"Host {host} line {k}" for k in range(4)]
        for i in range(20):
            body = [" ".join(draw.choices(words, k=12)) for _ in range(draw.randrange(2, 6))]
            number = len(pages)
            own[number] = " ".join(body)
            lines = [*top[:2], *body, *top[2:]]
            html = "".join(f"<div class=c{k % 2}><p>{t}</p></div>" for k, t in enumerate(lines))
            pages.append((number, f"http://h{host}.example.org/a/{i:03}", html))
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in extract_text(frame).collect()}
    alone = {i: " ".join(t for _, _, t in page_lines(html)) for i, _, html in pages}
    assert all(found[i] != alone[i] for i in own)
    kept = sum(w in found[i] for i, text in own.items() for w in text.split(" "))
    assert kept == sum(len(text.split(" ")) for text in own.values())
    template = sum(found[i].count("Host ") for i in own)
    # Of 240 template lines all go but those that stand in the zone with most text.
    assert template <= 120
