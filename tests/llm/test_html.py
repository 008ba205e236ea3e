"""Page parsing: what stays and what goes, linear time, and an independent recount of the templates."""

import math
import time
from collections import defaultdict

import pytest

from headway.llm import html
from headway.llm.html import Page

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("page,want", [
    ('<div class="content-sidebar-wrap"><main><p>Text one.</p></main></div>', ["Text one."]),
    ('<article class="post comments-open"><p>Text one.</p></article>', ["Text one."]),
    ('<article><p>a</p><p class="social-history">b</p></article>', ["a", "b"]),
    ('<main><div><article><h2>Teaser</h2></article></div><p>Main body text.</p></main>', ["Teaser", "Main body text."]),
    ('<main><p>Home</p><article><p>The whole long article.</p></article></main>', ["The whole long article."]),
    ('<div class="header">Site head</div><p>Own text.</p>', ["Own text."]),
    ('<div id="page-header">Site head</div><p>Own text.</p>', ["Own text."]),
    ('<article><div class="header">Kept</div><p>Own text.</p></article>', ["Kept", "Own text."]),
    ('<div class="sidebar"><main><p>The text.</p></main></div>', ["The text."]),
    ('<div class="comments">only this</div>', ["only this"]),
    ('<article><p>a</p><div class="comment-list">c</div><div class="ad-slot">d</div><div class="share-buttons">e</div></article>', ["a"]),
    ('<div id="cookie-banner">x</div><div class="site-footer">y</div><p>z</p>', ["z"]),
    ('a < b <b>c</b> <', ["a < b c <"]),
    ('<p>x<!-- y', ["x"]),
    ('<a href="x>y">k</a>', ["k"]),
    ('<a href="x>y>k</a>', ["y>k"]),
    ('<p>one<script>if (a < b) "</p>"</script> two</p><style>p {}</style>', ["one two"]),
    ('<form><p>search</p></form><article><p>a</p><form>b</form></article>', ["a"]),
    ('<p hidden>x</p><p style="display: none">y</p><p role="navigation">n</p><p>z', ["z"]),
])
def test_main_text(page, want):
    assert Page(page).main()[0] == want


@pytest.mark.parametrize("piece", ["<a ", '<a b="', "<a '>'", "<!x ", "<b>a", "<p><b>", "<li><a \"'>", "<script>", "<!--", "<div>a", "</div>", "<p>a</div>", "<"])
def test_malformed_pages_take_linear_time(piece):
    """A megabyte of what is never closed is read within seconds, a doubled page in about twice the time."""
    times = []
    for size in (1 << 19, 1 << 20):
        text = piece * (size // len(piece))
        start = time.perf_counter()
        Page(text).main()
        times.append(time.perf_counter() - start)
    assert times[1] < 3.5 * times[0] + 2


def test_templates_by_plain_recount(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r.page_id, r.url.split("/")[2].split("@")[-1].split(":")[0].lower(), *Page(r.html or "").main()) for r in pages.collect()]
    where, versions = defaultdict(set), defaultdict(set)
    for _, host, texts, hashes in rows:
        versions[host].add("\n".join(texts))
        for chain in hashes:
            for h in chain:
                where[host, h].add("\n".join(texts))
    templates = {k for k, v in where.items() if len(v) >= max(html.LEAST, html.PER_ROOT * math.sqrt(len(versions[k[0]])))}
    want = {}
    for page, host, texts, hashes in rows:
        left = [t for t, chain in zip(texts, hashes) if not any((host, h) in templates for h in chain)]
        want[page] = ("\n\n".join(left or texts), len(texts) - len(left) if left else 0)
    got = {r.page_id: (r.text, r.n_template_blocks) for r in html.extract(pages).collect()}
    assert got == want and len(got) == pages.count()
