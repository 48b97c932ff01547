"""Malformed and very long pages: defined texts in time linear in the page."""

from __future__ import annotations

import time

import pytest

from urbanweave.llm import html_text

STORY = "".join(f"<p>Sentence number {k}, which is plain text, ends here.</p>" for k in range(6))
LINES = "\n".join(f"Sentence number {k}, which is plain text, ends here." for k in range(6))


@pytest.mark.parametrize("piece", ["<svg <a ", "<a \"x>\" ", "<a title='", "<div>", "<form><p>x", "<div></section>", "<div class=a><b></section>t ", "< ", "<!--", "<p><b>"])
def test_a_megabyte_of_broken_markup_is_read_once(piece):
    page = piece * ((1 << 18) // len(piece)) + "'"
    start = time.process_time()
    html_text.main_text(page)
    first = time.process_time() - start
    start = time.process_time()
    html_text.main_text(page * 4)
    assert time.process_time() - start < 12 * first + 1  # a quadratic reader takes 16 times as long


def test_text_after_open_quotes_and_broken_tags():
    assert html_text.main_text(f"<article>{STORY}<p title='open>") == LINES
    assert html_text.main_text(f"<article><p title='open>{STORY}") == LINES
    assert html_text.main_text(f"<article>{STORY}<svg <a ") == LINES
    late = "<i title='a>b'>" * 3 + "<i title='open>" * (html_text.OPEN_QUOTES + 4)
    assert html_text.main_text(f"<article>{STORY}{late}</article>").startswith(LINES)


def test_depth_beyond_the_limit_keeps_text_and_furniture():
    deep = "<div>" * (2 * html_text.DEPTH)
    assert html_text.main_text(f"<article>{deep}{STORY}<nav>Menu</nav></article>") == LINES
    assert html_text.main_text(f"{'<i>' * 3000}{STORY}") == LINES


def test_pages_with_columns_of_the_operators_own_names(spark):
    rows = [(1, "u", f"<article>{STORY}</article>", "x", 5), (None, None, None, None, None), (1, "u", f"<article>{STORY}</article>", "y", 6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in html_text.extract(df).collect()), key=str)
    assert got == sorted([(1, "u", LINES, len(LINES))] * 2 + [(None, None, "", 0)], key=str)
