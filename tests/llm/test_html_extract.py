"""Main text: the block reader on small pages, the field against brute force, held-out pages."""

import itertools
import re
from collections import Counter

import numpy as np
import pytest

from vaultloom.llm import crf, html_extract, labelled_pages
from vaultloom.llm.html_blocks import features, leaf_blocks

PAGES = "page_id long, url string, html string, text string, n_chars string"


def texts(page):
    return [b.text for b in leaf_blocks(page)]


@pytest.mark.parametrize(("page", "want"), [
    ("", []), ("  \n ", []), ("a\t b\n\nc", ["a b c"]), ("<p>one<p>two <b>bold</b>er<br>three</p>four", ["one", "two bolder three", "four"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", ["a", "b", "c", "d", "e"]),
    ("<table><tr><td>a<td>b<tr><th>c</table>d", ["a", "b", "c", "d"]),
    ("x &amp; y&nbsp;&#233;&lt;p&gt; &copy &bogus;", ["x & y é<p> © &bogus;"]),
    ("a<script>if (1 < 2) '</p>'</script>b<style>p{}</style><!-- <p>no</p> -->c<!DOCTYPE x>d", ["abcd"]),
    ("<title>no</title><p>a<textarea>no</textarea><noscript>no</noscript>b", ["ab"]),
    ("<p title='a > b' data-x=\"<p>\">in", ["in"]), ("1 < 2 and 3 > 2", ["1 < 2 and 3 > 2"]),
    ("a<script>never closed <p>b", ["a"]), ("a<!-- never closed <p>b", ["a"]), ("a<p class='never closed", ["a"]),
    ("a<noscript>b", ["ab"]), ("<P>A</P><DIV>B</DIV>", ["A", "B"]), ("</p></div>a", ["a"]), ("<my-box>a</my-box>b", ["ab"]),
])
def test_leaf_blocks(page, want):
    assert texts(page) == want


def test_links_and_paths():
    [menu, text] = leaf_blocks("<nav class='siteMenu'><a href=x>one two</a> three</nav><div role=main hidden><p>four</p></div>")
    assert (menu.words, menu.linked) == (3, 2) and {"nav", ".menu"} <= menu.inside
    assert (text.tag, text.parent) == ("p", "div") and {"main", "hidden"} <= text.inside
    assert leaf_blocks("<div>" * 50_000 + "deep")[0].text == "deep"


def brute(model_parts, scores):
    step, first, last = model_parts
    for y in itertools.product(range(2), repeat=len(scores)):
        yield first[y[0]] + last[y[-1]] + sum(scores[t][a] for t, a in enumerate(y)) + sum(
            step[a][b] for a, b in itertools.pairwise(y)), y


def test_field_equals_brute_force():
    rng = np.random.default_rng(3)
    lengths = np.array([1, 2, 5, 4])
    scores, labels = rng.normal(size=(4, 5, 2)), rng.integers(0, 2, (4, 5))
    parts = rng.normal(size=(2, 2)), rng.normal(size=2), rng.normal(size=2)

    def value(scores, *parts):
        total = 0.0
        for i, n in enumerate(lengths):
            every = dict((y, s) for s, y in brute(parts, scores[i, :n]))
            total += every[tuple(labels[i, :n])] - np.log(np.sum(np.exp(list(every.values()))))
        return total

    got, gradients = crf.log_likelihood(scores, labels, lengths, *parts)
    assert got == pytest.approx(value(scores, *parts))
    for k, gradient in enumerate(gradients):
        for place in np.ndindex(gradient.shape):
            both = []
            for change in (1e-5, -1e-5):
                moved = [x.copy() for x in (scores, *parts)]
                moved[k][place] += change
                both.append(value(*moved))
            assert gradient[place] == pytest.approx((both[0] - both[1]) / 2e-5, abs=1e-6)
    for i, n in enumerate(lengths):
        weights = {f"{t}": tuple(scores[i, t]) for t in range(n)}
        best = max(brute(parts, scores[i, :n]))[1]
        assert tuple(crf.decoded(crf.Model(weights, *parts), [[f"{t}", "unknown"] for t in range(n)])) == best
    assert crf.decoded(crf.Model({}, *parts), []) == []


def test_training_climbs():
    sequences = labelled_pages.labelled_sequences(60, 7_000)
    few, many = (crf.trained(sequences, rounds) for rounds in (3, 60))
    wrong = [sum(crf.decoded(m, x) != y for x, y in sequences) for m in (few, many)]
    assert wrong[1] < wrong[0] and wrong[1] <= 6


def test_held_out_pages():
    held = labelled_pages.labelled_sequences(400, 1_000_000)
    model = html_extract.model()
    right = [crf.decoded(model, x) == y for x, y in held]
    blocks = [a == b for x, y in held for a, b in zip(crf.decoded(model, x), y, strict=True)]
    assert np.mean(right) >= 0.9 and np.mean(blocks) >= 0.99


PARTS = {
    "menu": "<nav><a href=/>Home</a> <a href=/a>About</a></nav>", "head": "<header><div class=logo>Daily</div></header>",
    "foot": "<footer>&copy; 2024 Daily</footer>", "side": "<aside class=sidebar><h3>More</h3><p>Ten tips that everyone should know.</p></aside>",
    "notice": "<div class='cookie-notice'>We use cookies to improve the site. Accept them.</div>",
    "ad": "<div class=advert>Buy our umbrellas now! The best in town.</div>",
    "form": "<form><label>Mail</label><input><button>Go</button></form>",
    "comments": "<section class=comments><h2>Comments</h2><div class=comment><b>Bob</b><p>Thanks for this, it was of much help to me.</p></div></section>"}
MAIN = "<h1>Storm &amp; coast</h1><p>A storm hit the coast on Monday.<p>Short.</p>{}<ul><li>Rain is expected.</li></ul>"
GOLD = "Storm & coast\nA storm hit the coast on Monday.\nShort.\nRain is expected."


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "<div id=story>{}</div>"])
@pytest.mark.parametrize("part", PARTS)
def test_each_part_is_left_out(around, part):
    p = PARTS[part]
    for page in (p + around.format(MAIN.format("")), around.format(MAIN.format("")) + p, around.format(MAIN.format(p)),
                 PARTS["menu"] + around.format(MAIN.format("")) + p + PARTS["foot"]):
        assert html_extract.main_text(f"<html><body>{page}</body></html>", html_extract.model()) == GOLD, page


def test_pages_of_the_table(spark):
    """In the given pages the article element is the article."""
    got = {r.page_id: r for r in html_extract.op13_html_text(spark, "/root/testdata/sf0.001").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        want = "\n".join(texts(re.search("<article>(.*)</article>", p.html, re.S)[1]))
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (want, len(want), p.url)


def test_odd_rows(spark):
    page = "<article>" + MAIN.format("") + "</article>"
    long = "<article><h1>T</h1>" + "<p>A sentence of some words 𝄞.</p>" * 30_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", page), (3, "u", page), (None, "u", page), (4, "u", "<nav><a>x</a></nav>"), (5, "u", long)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)
    text = "T" + "\nA sentence of some words 𝄞." * 30_000
    want = [(1, "u", ""), (2, None, ""), (3, "u", GOLD), (3, "u", GOLD), (None, "u", GOLD), (4, "u", ""), (5, "u", text)]
    assert Counter(tuple(r) for r in html_extract.extracted(df).collect()) == Counter((*w, len(w[2])) for w in want)
    assert html_extract.extracted(df.limit(0)).count() == 0
    assert features([]) == []
