"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is its leaf blocks in order (``html_blocks``). A block is described by

- its ancestors' tags, the words of their classes and ids, and how these words begin;
- its place: inside the page's article (or main element) or outside it, there under an element with
  a class or id (or an aside, a form, ...) or not, and whether the article has paragraphs of its own beside that element;
- whether its ancestors bear names, and one of them only such that the field does not know, joined
  with the place;
- how much of the page's plain text its container holds, joined with the place;
- its text: length, end, share of links.

The field has a weight for each feature and label and for each pair of neighbouring labels; it is
fitted in numpy on the labelled pages below, by gradient ascent on their log likelihood with the
forward-backward recursion, and pages are decoded by Viterbi. The main text is the blocks
labelled main, joined by newlines.

The labelled pages are layouts with filler text. Every layout is filled several times with texts
of different lengths, so that the structure decides and the wording cannot. Some of the classes and
ids are replaced by words of chance, so that the place decides where no name is known.

A null or empty page has an empty text, an empty table an empty result. Pages are read whole;
repeated rows are extracted each; of equally likely labels a block takes OTHER; other columns are
left out.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulsegrid.llm.frames import only
from pulsegrid.llm.html_blocks import Block, leaf_blocks

TEXTS = "page_id long, url string, text string, n_chars long"
MAIN, OTHER = 1, 0

#: The labelled pages: layouts whose elements carry their label. {s}, {m} and {l} stand for a few
#: words, a sentence or two, and a paragraph, {n}, {c} and {i} for a name of something that is not
#: main text, of what holds it, and of a part of it.
LAYOUTS = (
    "<body data-label=0><nav><ul><li><a href=/>{s}</a></li><li><a href=/>{s}</a></li></ul></nav><div class=ad>{m}</div>"
    "<article data-label=1><h1>{s}</h1><p>{l}<p>{s}<p>{l}</article><footer>&copy; {s} &middot; {m}</footer></body>",
    "<body data-label=0><header><div class=logo>{s}</div><form><label>{s}</label><input name=q></form></header>"
    "<main data-label=1><h1>{m}</h1><p>{m}</p><p>{s}</p><ul><li>{m}</li><li>{s}</li></ul></main>"
    "<aside><h3>{s}</h3><p>{m}</p><p>{l}</p></aside><footer><p>{l}</p></footer></body>",
    "<body data-label=0><div id=header><a href=/>{s}</a></div><div id=menu><a href=/>{s}</a> <a href=/>{s}</a></div>"
    "<div id=content data-label=1><h2>{s}</h2><p>{l}</p><blockquote>{m}</blockquote><p>{m}</p></div>"
    "<div id=sidebar><h4>{s}</h4><p>{l}</p><ul><li><a href=/>{m}</a></li></ul></div><div id=footer>{m}</div></body>",
    "<body data-label=0><div class='cookie-notice'><p>{m}</p><button>{s}</button></div><nav><a href=/>{s}</a></nav>"
    "<article data-label=1><p>{l}</p><p>{l}</p><div class='advert' data-label=0><p>{m}</p></div><p>{l}</p><p>{s}</p></article>"
    "<section class=comments><h3>{s}</h3><div class=comment><p>{l}</p></div><div class=comment><p>{s}</p></div></section></body>",
    "<body data-label=0><div class=banner>{m}</div><div class=breadcrumb><a href=/>{s}</a> / {s}</div>"
    "<div class='post entry' data-label=1><h1>{s}</h1><p>{l}</p><pre>{m}</pre><p>{l}</p>"
    "<div class='share social' data-label=0><a href=/>{s}</a></div></div>"
    "<div class=related><h3>{s}</h3><ul><li><a href=/>{m}</a></li><li><a href=/>{m}</a></li></ul></div>"
    "<ol class='comment-list' id=comments><li><p>{m}</p></li><li><p>{l}</p></li></ol><footer>{s}</footer></body>",
    "<body data-label=0><header><h2>{s}</h2><nav><ul><li><a href=/>{s}</a></li></ul></nav></header>"
    "<article data-label=1><header><h1>{m}</h1></header><p>{l}</p><h2>{s}</h2><p>{m}</p><table><tr><td>{s}</td><td>{s}</td></tr></table>"
    "<p>{l}</p><aside data-label=0><p>{m}</p></aside><p>{m}</p></article>"
    "<form class=newsletter><p>{m}</p><input><button>{s}</button></form><footer><p>{s}</p><p>{m}</p></footer></body>",
    "<body data-label=0><div class=notice>{m}</div><div class=wrapper><div class='main-content' data-label=1><h1>{s}</h1>"
    "<p>{m}</p><p>{m}</p><p>{l}</p></div><div class='side widget'><p>{l}</p><p>{m}</p></div></div>"
    "<div class='legal copyright'>{l}</div></body>",
    "<body data-label=0><div role=navigation><a href=/>{s}</a></div><div role=main data-label=1><p>{s}</p><p>{l}</p><p>{l}</p></div>"
    "<div role=complementary><p>{l}</p></div><div class='popup subscribe'><p>{m}</p></div>"
    "<section id=reviews class='reader-comments'><p>{l}</p><p>{m}</p></section><div role=contentinfo><p>{m}</p></div></body>",
    "<body data-label=0><p data-label=1>{l}</p><p data-label=1>{s}</p><p data-label=1>{l}</p><footer>{m}</footer></body>",
    "<body data-label=0><nav><p>{m}</p><p>{l}</p></nav><article data-label=1><h1>{s}</h1><p>{s}</p></article>"
    "<div class=ads><p>{l}</p></div><div class=sponsor>{m}</div><footer>{l}</footer></body>",
    "<body data-label=0><div class='alert warning'><p>{m}</p></div><section class=article data-label=1><h1>{m}</h1><h2>{s}</h2><p>{l}</p>"
    "<ol><li>{m}</li><li>{l}</li></ol><figure><figcaption>{m}</figcaption></figure><p>{s}</p>"
    "<div class='comments discussion' data-label=0><p>{l}</p><form><p>{s}</p></form></div></section><div class=pagination>{s}</div></body>",
    "<body data-label=0><div class='site header'>{s}</div><article data-label=1><h1>{s}</h1><nav data-label=0><a href=/>{s}</a></nav><p>{l}</p>"
    "<div class=ad data-label=0>{m}</div><p>{m}</p><section class=comments data-label=0><h3>{s}</h3><p>{m}</p><p>{l}</p></section></article>"
    "<aside class=sidebar><p>{l}</p></aside><form><p>{m}</p></form><div class=notice><p>{m}</p></div><footer><p>{l}</p></footer></body>",
    "<body data-label=0><main data-label=1><article><header><h1>{s}</h1></header><div class=notice data-label=0>{l}</div><p>{l}</p><p>{m}</p>"
    "<form data-label=0><label>{m}</label></form><p>{l}</p><footer data-label=0><p>{m}</p></footer><div class=comment data-label=0><p>{m}</p></div>"
    "<ul class='comment list' data-label=0><li>{l}</li></ul></article><aside data-label=0>{l}</aside></main></body>",
    "<body data-label=0><article data-label=1><p>{s}</p><p>{l}</p><div class='advertisement ads' data-label=0><p>{l}</p></div><p>{l}</p>"
    "<div class='share tools' data-label=0>{s}</div><div class=sidebar data-label=0><p>{l}</p></div><h2>{s}</h2><p>{s}</p>"
    "<div id=comments data-label=0><div class=reply><p>{l}</p></div></div><div class=newsletter data-label=0>{m}</div>"
    "<div class='cookie banner' data-label=0><p>{s}</p></div></article>"
    "<div class='menu navigation'>{s}</div><div class='cookie banner consent'><p>{s}</p></div></body>",
    "<body data-label=1><div>{l}</div></body>",
    "<body data-label=1><div>{m}</div></body>",
    "<body data-label=1>{l}</body>",
    "<body data-label=1><div><p>{m}</p><p>{l}</p></div></body>",
    "<body data-label=1><h1>{s}</h1><div>{l}</div><div>{l}</div></body>",
    "<body data-label=0><nav><a href=/>{s}</a></nav><div data-label=1>{l}</div><footer>{s}</footer></body>",
    "<body data-label=0><div class={n}><p>{l}</p></div><article data-label=1><h1>{s}</h1><p>{m}</p><div class={n} data-label=0><p>{l}</p></div>"
    "<p>{l}</p><div id={n} data-label=0>{m}</div></article><div class={n}><p>{l}</p></div></body>",
    "<body data-label=0><article data-label=1><div class={n} data-label=0><p>{m}</p><p>{l}</p></div><h1>{s}</h1><p>{m}</p><p>{s}</p>"
    "<ul><li>{m}</li></ul><section class={n} data-label=0><h3>{s}</h3><p>{l}</p></section></article><div id={n}><p>{m}</p></div></body>",
    "<body data-label=0><div class={n}>{s}</div><article data-label=1><h1>{s}</h1><div class={c}><p>{l}</p><p>{m}</p><h2>{s}</h2><p>{l}</p></div>"
    "<div class={n} data-label=0><p>{m}</p></div></article><div class={n}><h3>{s}</h3><p>{l}</p><p>{m}</p></div></body>",
    "<body data-label=0><main data-label=1><h1>{s}</h1><p>{l}</p><div class={n} data-label=0><p>{l}</p></div><p>{m}</p></main>"
    "<section class={n}><p>{l}</p></section><div class={n}><a href=/>{s}</a></div></body>",
    "<body data-label=0><main><h1 data-label=1>{s}</h1><div class={c} data-label=1><p>{l}</p><p>{l}</p><p>{m}</p></div><div class={n}><p>{m}</p></div></main></body>",
    "<body data-label=0><article data-label=1><h1>{s}</h1><p>{l}</p><div class={i}><pre>{m}</pre></div><p>{m}</p>"
    "<div class={i}><table><tr><td>{s}</td><td>{s}</td></tr></table></div><p>{l}</p><div class={n} data-label=0><p>{m}</p></div></article></body>",
    "<body data-label=0><article data-label=1><p class={i}>{m}</p><p>{l}</p><blockquote class={i}><p>{m}</p></blockquote><p>{l}</p>"
    "<aside class={n} data-label=0><p>{l}</p></aside><p class={n} data-label=0>{m}</p></article></body>",
    "<body data-label=0><div class={n}><p>{m}</p></div><div class={c} data-label=1><h1>{s}</h1><p>{l}</p><p>{l}</p><p>{s}</p><p>{l}</p></div>"
    "<div class={n}><p>{m}</p></div><div class={n}>{s}</div></body>",
    "<body data-label=0><div class={n}><a href=/>{s}</a></div><div id={c}><h1 data-label=1>{s}</h1><div class={c} data-label=1><p>{l}</p><p>{m}</p><p>{l}</p></div>"
    "<div class={n}><p>{m}</p></div></div><div class={n}><p>{m}</p><form><p>{s}</p></form></div></body>",
    "<body data-label=0><main><h1 data-label=1>{s}</h1><article data-label=1><p>{m}</p><ul class={n} data-label=0><li>{m}</li><li>{s}</li></ul><p>{l}</p></article>"
    "<div class={n}><p>{l}</p></div><section id={n}><h3>{s}</h3><p>{m}</p></section></main><div class={n}><p>{m}</p></div></body>",
    "<body data-label=0><article data-label=1><h1>{s}</h1><p>{m}</p><div class={n} data-label=0><p>{l}</p><p>{l}</p></div><p>{m}</p></article></body>",
    "<body data-label=0><article data-label=1><h1>{s}</h1><p>{m}</p><p>{m}</p><div class={n} data-label=0>{l}</div></article><div class={n}><p>{l}</p></div></body>",
    "<body data-label=0><h1 data-label=1>{s}</h1><p data-label=1>{l}</p><p data-label=1>{m}</p><div class={n}><p>{m}</p></div>"
    "<p data-label=1>{l}</p><div id={n}><p>{l}</p></div></body>",
    "<body data-label=0><div class={n}>{m}</div><h1 data-label=1>{s}</h1><p data-label=1>{l}</p><p data-label=1>{m}</p><div class={n}><p>{l}</p></div></body>",
    "<body data-label=0><div class={c} data-label=1><h1>{s}</h1><p>{m}</p><p>{l}</p></div><div class={n}><p>{m}</p></div><div class={n}><p>{l}</p></div></body>",
)
#: Usual words in classes and ids of pages.
NAMES = {
    "n": "ad ads advert advertisement alert author banner breadcrumbs bottom bar buttons byline caution comment comments consent contact cookie "
    "copyright cta discussion donate feedback follow foot footer form fundraiser head header legal links login masthead menu message meta modal "
    "more nav newsletter notice notification overlay pager paywall policy popup privacy rating recommended register related reply respond review "
    "search share side sidebar social sponsor sponsored subscribe survey tags teaser terms tools top trending utility warning widget",
    "c": "article body content entry main page post story text",
    "i": "caption code example figure gallery highlight image intro lead listing math media pullquote quote subtitle summary table verse",
}
COPIES = 8
#: Names on fewer labelled pages are unknown.
KNOWN_FROM = 3
#: Share of names on the labelled pages that words of chance replace.
UNKNOWN = 0.3
STEPS = 150
RATE = 0.5
DECAY = 1e-3
SEED = 11


def _filler(rng: random.Random, kind: str) -> str:
    low, high = {"s": (1, 6), "m": (5, 25), "l": (20, 120)}[kind]
    words = ["".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(1, 11))) for _ in range(rng.randint(low, high))]
    end = rng.choice((".", ".", ".", "", ",", "!")) if kind != "s" else rng.choice(("", "", "."))
    return " ".join(words).capitalize() + end


def _word(rng: random.Random) -> str:
    return "".join(rng.choices("abcdefghijklmnoprstuvwxyz", k=rng.randint(3, 10)))


def _name(rng: random.Random, kind: str) -> str:
    words = [rng.choice(NAMES[kind].split()), rng.choice([_word(rng), *NAMES[kind].split()])]
    return _word(rng) if rng.random() < UNKNOWN else "-".join(words[: rng.randint(1, 2)])


def _page(rng: random.Random, layout: str) -> str:
    page = re.sub(r"(class|id)=('[^']*'|\w[^ >]*)", lambda m: f"{m[1]}={_word(rng)}" if rng.random() < UNKNOWN else m[0], layout)
    page = re.sub(r"\{([nci])\}", lambda m: _name(rng, m[1]), page)
    return re.sub(r"\{([sml])\}", lambda m: _filler(rng, m[1]), page)


def labelled_pages(copies: int = COPIES, seed: int = SEED, layouts: tuple[str, ...] = LAYOUTS) -> list[str]:
    rng = random.Random(seed)
    return [_page(rng, layout) for layout in layouts for _ in range(copies)]


_CONTAINERS = frozenset("body div article main section td aside header footer nav form".split())
_APART = frozenset("aside form nav footer".split())  # set apart without a name


def _places(blocks: list[Block]) -> list[str]:
    """none: the page has no article and no main element. outside: the block is in neither.

    Inside one, plain: not under an element that is set apart; aside: under one, where the home (the
    outermost article, else the main element) has paragraphs of its own; within: under one, where it has
    none. beside and astray are plain and set apart, in a main element but outside its articles.
    """
    articles = any("article" in block.tags for block in blocks)
    homes, apart = [], []
    for block in blocks:
        at = next((block.tags.index(tag) for tag in ("article", "main") if tag in block.tags), None)
        homes.append(None if at is None else block.path[at])
        apart.append(at is not None and (any(block.named[at + 1 :]) or not _APART.isdisjoint(block.tags[at + 1 :])))
    plain = {h for block, h, a in zip(blocks, homes, apart, strict=True) if h and not a and block.text.count(" ") >= 4}
    out = []
    for block, home, away in zip(blocks, homes, apart, strict=True):
        if not home:
            out.append("outside" if any(homes) else "none")
        elif articles and "article" not in block.tags:
            out.append("astray" if away else "beside")
        else:
            out.append("plain" if not away else "aside" if home in plain else "within")
    return out


def _weights(blocks: list[Block]) -> list[str]:
    holders = []
    held: dict[int, int] = {}
    for block in blocks:
        holder = next((n for tag, n in zip(reversed(block.tags), reversed(block.path), strict=True) if tag in _CONTAINERS), 0)
        holders.append(holder)
        held[holder] = held.get(holder, 0) + max(0, len(block.text) - block.linked)
    total = max(1, sum(held.values()))
    return ["most" if 2 * held[h] >= total else "some" if 5 * held[h] >= total else "little" for h in holders]


def features(blocks: list[Block], known: frozenset[str]) -> list[list[str]]:
    """Each block's features; known are the names that the field has learned."""
    out = []
    for block, place, weight in zip(blocks, _places(blocks), _weights(blocks), strict=True):
        n = len(block.text.split(" ", 121))
        share = block.linked / len(block.text)
        names = {name for words in block.named for name in words}
        strange = any(words and not known.intersection(words) for words in block.named)
        named = "strange" if strange else "known" if names else "no"
        row = {f"tag {t}" for t in block.tags if t not in ("html", "body", "div", "span")}
        row |= {f"name {name}" for name in names & known}
        row |= {f"start {name[:4]}" for name in names if len(name) > 4}
        row |= {
            "bias",
            f"own {block.tags[-1] if block.tags else ''}",
            f"place {place}",
            f"names {named} {place}",
            f"weight {weight}",
            f"weight {weight} {place}",
            f"words {sum(n > most for most in (1, 3, 8, 20, 60, 120))}",
            f"links {'none' if share == 0 else 'few' if share < 0.5 else 'most'}",
            f"end {block.text[-1] if block.text[-1] in '.!?,:;' else ''}",
        }
        out.append(sorted(row))
    return out


@dataclass
class Field:
    """Weights of a chain with two labels."""

    emission: dict[str, tuple[float, float]]
    pair: tuple[tuple[float, float], tuple[float, float]]
    first: tuple[float, float]
    known: frozenset[str]

    def decode(self, blocks: list[Block]) -> list[int]:
        """The likeliest labels, by Viterbi. Of equal ones, the label OTHER."""
        if not blocks:
            return []
        back: list[tuple[int, int]] = []
        best: tuple[float, float] | None = None
        for row in features(blocks, self.known):
            scores = [self.emission[f] for f in row if f in self.emission]
            own = sum(s[0] for s in scores), sum(s[1] for s in scores)
            if best is None:
                best = self.first[0] + own[0], self.first[1] + own[1]
                continue
            ways = [(best[0] + self.pair[0][y], best[1] + self.pair[1][y]) for y in (0, 1)]
            back.append((int(ways[0][1] > ways[0][0]), int(ways[1][1] > ways[1][0])))
            best = max(ways[0]) + own[0], max(ways[1]) + own[1]
        labels = [int(best[1] > best[0])]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def _marginals(emission: np.ndarray, pair: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chances of each block's label and of each two neighbours' labels, summed over the chain."""
    n = len(emission)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    forward[0] = first + emission[0]
    for k in range(1, n):
        forward[k] = emission[k] + np.logaddexp.reduce(forward[k - 1][:, None] + pair, axis=0)
    for k in range(n - 2, -1, -1):
        backward[k] = np.logaddexp.reduce(pair + (emission[k + 1] + backward[k + 1])[None, :], axis=1)
    total = np.logaddexp.reduce(forward[-1])
    both = np.zeros((2, 2))
    for k in range(1, n):
        both += np.exp(forward[k - 1][:, None] + pair + (emission[k] + backward[k])[None, :] - total)
    return np.exp(forward + backward - total), both


def fit(pages: list[str] | None = None) -> Field:
    """Gradient ascent on the mean log likelihood of labelled pages, with weight decay."""
    read = [blocks for page in pages or labelled_pages() if (blocks := leaf_blocks(page))]
    seen = Counter(name for blocks in read for name in {n for b in blocks for words in b.named for n in words})
    known = frozenset(name for name, n in seen.items() if n >= KNOWN_FROM)
    chains = [(features(blocks, known), np.array([int(b.label or 0) for b in blocks])) for blocks in read]
    number: dict[str, int] = {}
    for rows, _ in chains:
        for row in rows:
            for f in row:
                number.setdefault(f, len(number))
    coded = []
    for rows, labels in chains:
        matrix = np.zeros((len(rows), len(number)))
        for k, row in enumerate(rows):
            matrix[k, [number[f] for f in row]] = 1
        coded.append((matrix, labels))
    weights, pair, first = np.zeros((len(number), 2)), np.zeros((2, 2)), np.zeros(2)
    moments = [np.full(w.shape, 1e-6) for w in (weights, pair, first)]
    for _ in range(STEPS):
        steps = [-DECAY * weights, -DECAY * pair, -DECAY * first]
        for matrix, labels in coded:
            chance, both = _marginals(matrix @ weights, pair, first)
            truth = np.eye(2)[labels]
            steps[0] = steps[0] + matrix.T @ (truth - chance) / len(coded)
            steps[1] = steps[1] + (truth[:-1].T @ truth[1:] - both) / len(coded)
            steps[2] = steps[2] + (truth[0] - chance[0]) / len(coded)
        for w, g, m in zip((weights, pair, first), steps, moments, strict=True):
            m += g**2
            w += RATE * g / np.sqrt(m)
    return Field(
        {f: (float(weights[k, 0]), float(weights[k, 1])) for f, k in number.items()},
        tuple(tuple(map(float, row)) for row in pair),
        tuple(map(float, first)),
        known,
    )


def main_text(page: str | None, chain: Field) -> str:
    blocks = leaf_blocks(page)
    return "\n".join(b.text for b, label in zip(blocks, chain.decode(blocks), strict=True) if label == MAIN)


def extract(pages: DataFrame, chain: Field | None = None) -> DataFrame:
    """``TEXTS`` of every page."""
    chain = chain or fit()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(page, chain) for page in part.column("html").to_pylist()]
                columns = [part.column("page_id").cast(pa.int64()), part.column("url").cast(pa.string())]
                columns += [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return only(pages, ("page_id", "url", "html"), "pages").mapInArrow(run, TEXTS)
