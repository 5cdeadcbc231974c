"""Pages whose tags are broken: no text is lost and time grows with the length."""

from __future__ import annotations

import time

import pytest

from siltgate.llm import html_text

LONG = "One, two, three and four, with some more words to count, and then again some more of them."


@pytest.mark.parametrize(
    "odd, text",
    [
        ("<p title=Bob's>Second, it's here</p>", "Second, it's here"),
        ('<p title=12">Second, it is here</p>', "Second, it is here"),
        ("<p>if a <b and c, then d</p>", "if a <b and c, then d"),
        ('<p title="the hidden gem">Second</p>', "Second"),
        ("<!--><p>Second</p><!-- x -->", "Second"),
        ('<p title="a > b">Second</p>', "Second"),
        ("<p title='it \"is\"' class = plain>Second</p>", "Second"),
        ("<p><a href=/x/>Second</a> half</p>", "Second half"),
        ("<div <p>Second</p></div>", "Second"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ],
)
def test_broken_tags_lose_no_text(odd, text):
    page = f"<article><p>{LONG}</p>{odd}<p>{LONG}</p></article>"
    assert html_text.main_text(page) == f"{LONG}\n{text}\n{LONG}"


def test_hidden_elements_go():
    for odd in ("<p hidden>x</p>", "<p class=a hidden=''>x</p>", "<p style='display : none'>x</p>", '<p aria-hidden="true">x</p>'):
        assert html_text.main_text(f"<article><p>{LONG}</p>{odd}</article>") == LONG


def test_a_tag_cut_off_by_the_end_is_text():
    assert html_text.main_text(f"<p>{LONG} <b and") == f"{LONG} <b and"


@pytest.mark.parametrize("unit", ["<a ", "<a '", "<a b='", '<a b="', "<div>", "<b><i>", "<title>", "<p></b>", "<!-", "<svg><p>", "<li>x"])
def test_time_grows_with_the_length(unit):
    def seconds(size: int) -> float:
        page = unit * (size // len(unit))
        best = []
        for _ in range(2):
            start = time.process_time()
            html_text.main_text(page)
            best.append(time.process_time() - start)
        return min(best)

    # Eight times the length takes far less than the 64-fold time of a quadratic scan.
    assert seconds(400_000) < 24 * seconds(50_000) + 0.3
