"""Main text of pages whose names mislead, and of long, deep and broken ones."""

import time

import pytest

from lorefield.llm import extraction

PROSE = "\n".join(f"<p>{'This is a long sentence about the matter at hand, with many words in it. ' * 3}It is number {i}.</p>" for i in range(5))
TEXT = "\n\n".join(("This is a long sentence about the matter at hand, with many words in it. " * 3) + f"It is number {i}." for i in range(5))
OTHER = "<p>" + "Other people have said many other things about all of this, and they went on and on about it. " * 3 + "</p>"
MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>"
FOOT = "<footer><p>Copyright 2020 by all of us. All rights are reserved in every country of the world, and in others too, as far as we know today.</p></footer>"


@pytest.mark.parametrize("page", [
    f"<article>{PROSE}</article>",
    f"<form id='aspnetForm'>{MENU}<article>{PROSE}</article>{FOOT}</form>",
    f"<div class='no-sidebar'>{MENU}<article>{PROSE}</article></div>",
    f"<div class='with-sidebar layout'><article>{PROSE}</article><aside>{OTHER}</aside></div>",
    f"<div class='sidebar-layout'>{MENU}<div>{PROSE}</div></div>",
    f"<body class='has-footer nav-open'>{MENU}<main>{PROSE}</main>{FOOT}</body>",
    f"<div id='header-wrap' class='page-header'><div class='post'>{PROSE}</div></div>{FOOT}",
    f"<article>{PROSE}</article><section id='comments'><div class='comment'>{OTHER}</div><div class='c2'>{OTHER * 9}</div></section>",
    f"<article>{PROSE}<div class='comments'>{OTHER * 4}</div></article>",
    f"<article>{PROSE}</article><ul class='comment-list'><li>{OTHER}</li><li>{OTHER}</li></ul>",
    f"<article>{PROSE}</article><div class='site-footer'>{OTHER}</div><div class='cookie-notice'>{OTHER}</div>",
    f"{MENU}<article>{PROSE}<span class='share'>Share it</span></article><aside><article class='teaser'>{OTHER[:60]}</article></aside>",
])
def test_article_is_found(page):
    got = extraction.main_text(page).replace("\n\nShare it", "")
    assert got == TEXT


def test_sections_named_like_boilerplate_inside_a_post_stay():
    page = f"{MENU}<div class='post'>{PROSE}<section class='related-work'><h2>Related work</h2>{OTHER}</section></div>{FOOT}"
    got = extraction.main_text(page)
    assert got.startswith(TEXT + "\n\nRelated work\n\nOther people") and "Copyright" not in got and "Home" not in got


def test_edges_of_the_cut_move_single_blocks():
    short = "<p>Yes.</p>"
    assert "Yes." in extraction.main_text(f"<div>{PROSE}{short}{OTHER}</div>") and extraction.main_text(f"{MENU}<div><p>Yes</p></div>") == ""


@pytest.mark.parametrize("page", [
    "<b>" * 20_000 + "</i>" * 20_000, "<div>" * 4000 + "<p>hello there</p>" * 4000, "<p><div>" + "<b>" * 20_000 + "<h1>x</h1>" * 5000,
    "<div class='nav'>" * 5000 + "<p>x y z</p>" * 4000, "<td>" * 20_000, "</p>" * 30_000, "<a href='" * 20_000, "<" * 100_000])
def test_broken_pages_cost_little(page):
    start = time.process_time()
    extraction.main_text(page)
    assert time.process_time() - start < 1.5


def test_a_long_page_is_kept_whole():
    many = "".join(f"<p>Paragraph {i} has these few words and some more of them, too.</p>" for i in range(20_000))
    got = extraction.main_text(f"{MENU}<article>{many}</article>{FOOT}").split("\n\n")
    assert got == [f"Paragraph {i} has these few words and some more of them, too." for i in range(20_000)]
