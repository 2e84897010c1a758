import itertools

import pytest

from pulsegrid.llm import html_text
from pulsegrid.llm.html_blocks import leaf_blocks


@pytest.fixture(scope="module")
def chain():
    return html_text.fit()


def test_blocks_follow_the_page():
    page = (
        "<!DOCTYPE html><head><title>no</title><style>p{}</style></head><body><!-- <p>no</p> --><h1> A &amp;\n B</h1>"
        "<p>one<br>two <b>three<p>four<ul><li>five<li>six</ul><script>var t='</p>';</script><div>seven<p>eight</div>"
        "<table><tr><td>nine<td>ten</table><a href='x>y'>eleven</a> &lt;p&gt; &#233;&nbsp;x"
    )
    assert [b.text for b in leaf_blocks(page)] == [
        "A & B", "one two three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven <p> é x",
    ]
    assert leaf_blocks(page)[3].tags == ("body", "ul", "li")


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<p class='", "</p></div>", "<!--", "<script>x", "&", "a<b", "<" * 500])
def test_broken_pages_do_not_crash(page, chain):
    assert isinstance(html_text.main_text(page, chain), str)


def measured(chain, pages):
    """Precision and recall of the blocks labelled main."""
    hits = said = true = 0
    for page in pages:
        blocks = leaf_blocks(page)
        for found, block in zip(chain.decode(blocks), blocks, strict=True):
            hits, said, true = hits + (found and block.label == "1"), said + found, true + (block.label == "1")
    return hits / said, hits / true


def test_pages_of_the_layouts_that_were_not_trained_on(chain, monkeypatch):
    precision, recall = measured(chain, html_text.labelled_pages(6, seed=99))
    assert precision > 0.97 and recall > 0.97
    monkeypatch.setattr(html_text, "UNKNOWN", 0)  # all names as in the layouts
    precision, recall = measured(chain, html_text.labelled_pages(6, seed=99))
    assert precision > 0.985 and recall > 0.985


#: None of these names and layouts is trained on.
STRANGE = "promo disclaimer signup-form adsbygoogle replies toolbar skip-link gdpr ad-slot user-comments subscribeBox partner-offers".split()
HELD_OUT = (
    "<body data-label=0><article data-label=1><h1>{s}</h1><p>{l}</p><div class=NAME data-label=0><p>{l}</p></div><p>{l}</p></article></body>",
    "<body data-label=0><article data-label=1><h1>{s}</h1><p>{l}</p><p>{m}</p></article><div class=NAME><p>{l}</p></div></body>",
    "<body data-label=0><section class=NAME><p>{l}</p></section><main data-label=1><h1>{s}</h1><p>{m}</p><ol><li>{m}</li></ol><p>{l}</p></main></body>",
    "<body data-label=0><div id=NAME>{m}</div><div class=chronicle data-label=1><h1>{s}</h1><p>{l}</p><p>{l}</p><h2>{s}</h2><p>{l}</p></div></body>",
    "<body data-label=0><div><ul><li><a href=/>{s}</a></li></ul></div><main><article data-label=1><h2>{s}</h2><p>{l}</p><p>{m}</p>"
    "<ul class=NAME data-label=0><li>{m}</li></ul></article><div class=NAME><p>{l}</p></div></main></body>",
)


def held_out_pages():
    return [page for layout in HELD_OUT for name in STRANGE for page in html_text.labelled_pages(4, 5, (layout.replace("NAME", name),))]


def test_layouts_and_names_that_the_field_has_never_seen(chain, monkeypatch):
    monkeypatch.setattr(html_text, "UNKNOWN", 0)
    precision, recall = measured(chain, held_out_pages())
    assert precision > 0.95 and recall > 0.97


@pytest.mark.parametrize("name", STRANGE)
def test_noise_of_an_unknown_name_beside_and_inside_an_article(chain, name):
    noise = f"<div class='{name}'><p>A long paragraph of words that goes on and on for quite a while, and is nothing of the article.</p></div>"
    body = f"<h1>Head line</h1><p>{LONG}</p>{{}}<p>{LONG}</p>"
    for page in (f"<article>{body.format(noise)}</article>", f"<article>{body.format('')}</article>{noise}", f"{noise}<main>{body.format('')}</main>"):
        assert html_text.main_text(f"<body>{page}</body>", chain) == f"Head line\n{LONG}\n{LONG}"


@pytest.mark.parametrize("page", ["<div>{}</div>", "<body><div>{}</div>", "<div><p>{}</p></div>", "{}", "<html><body><div id=x>{}</div></body></html>"])
def test_a_page_of_one_block_is_its_text(chain, page):
    for text in (LONG, "Hi", "Some words, no more"):
        assert html_text.main_text(page.format(text), chain) == text


def test_very_long_pages_are_read_whole(chain):
    parts = [f"<p>Paragraph {k} has these words and some more of them.</p><div class=ad>Buy {k}</div>" for k in range(20_000)]
    text = html_text.main_text(f"<body><nav><a href=/>Go</a></nav><article>{''.join(parts)}</article></body>", chain)
    assert text.split("\n") == [f"Paragraph {k} has these words and some more of them." for k in range(20_000)]
    long = "word " * 400_000
    assert html_text.main_text(f"<article><p>{long}</p></article>", chain) == long.strip()


FRAME = "<body><header><p>Top</p></header><nav><ul><li><a href=x>Go</a></li></ul></nav>{}<article><h1>Head line</h1><p>Short.</p>{}<p>{}</p>{}</article>{}<footer>Foot</footer></body>"
LONG = "Another paragraph with a fair number of words in it, to be kept."
NOISE = [
    "<div class='ad'>Buy now, the best of offers is here.</div>",
    "<aside><p>A side note of some length that goes on for a while here.</p></aside>",
    "<section class='comments'><h2>Comments</h2><p>I liked this very much, thank you for writing it.</p></section>",
    "<form><label>Your name</label><p>Please subscribe to our letter.</p></form>",
    "<div class='notice'>We use cookies to make this page better for you.</div>",
    "<div class='sidebar'><h3>More</h3><p>Long text that goes on and on without any link at all.</p></div>",
    "<script>x</script><style>p{}</style>",
]


@pytest.mark.parametrize("place", range(4))
@pytest.mark.parametrize("noise", NOISE)
def test_noise_is_left_out_wherever_it_stands(chain, noise, place):
    parts = [noise if k == place else "" for k in range(4)]
    page = FRAME.format(parts[0], parts[1], LONG, parts[2], parts[3])
    assert html_text.main_text(page, chain) == f"Head line\nShort.\n{LONG}"


def test_viterbi_finds_the_best_labelling(chain):
    blocks = leaf_blocks(html_text.labelled_pages(1)[0])
    described = html_text.features(blocks, chain.known)

    def score(labels):
        total = chain.first[labels[0]]
        for k, y in enumerate(labels):
            total += sum(chain.emission[f][y] for f in described[k] if f in chain.emission)
            total += chain.pair[labels[k - 1]][y] if k else 0
        return total

    best = max(itertools.product((0, 1), repeat=len(blocks)), key=score)
    assert score(chain.decode(blocks)) == pytest.approx(score(best))


def test_marginals_agree_with_counting(chain):
    import numpy as np

    rng = np.random.default_rng(1)
    emission, pair, first = rng.normal(size=(5, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    weights = {}
    for y in itertools.product((0, 1), repeat=5):
        weights[y] = np.exp(first[y[0]] + sum(emission[k][v] for k, v in enumerate(y)) + sum(pair[a][b] for a, b in itertools.pairwise(y)))
    total = sum(weights.values())
    single, both = html_text._marginals(emission, pair, first)
    assert single[2][1] == pytest.approx(sum(v for y, v in weights.items() if y[2] == 1) / total)
    wanted = sum(v * sum((a, b) == (0, 1) for a, b in itertools.pairwise(y)) for y, v in weights.items()) / total
    assert both[0][1] == pytest.approx(wanted)


def test_rows_of_all_kinds(spark, chain):
    rows = [(1, "u", "<article><p>é x</p></article>"), (1, "u", "<article><p>é x</p></article>"), (2, None, None), (None, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    found = html_text.extract(pages, chain).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in found) == [(0, "v", "", 0), (1, "u", "é x", 3), (1, "u", "é x", 3), (2, "", "", 0)]
    assert html_text.extract(pages.limit(0), chain).collect() == []
