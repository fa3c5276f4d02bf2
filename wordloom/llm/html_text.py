"""Main text of web pages: a conditional random field over the leaf blocks of a page, decoded by Viterbi.

Features of a block are its ancestors' tags and the words of their class, id and role, and the length, punctuation and
share of links of its text, also of its neighbours; none of them is a list of tags or words. The model is trained on labelled
pages, made from a bounded sample of the input: pages that mark their article give texts of the article and texts of
everything else, and both are set into layouts of many kinds, where it is known which block is which. Class words of
a layout are changed into others or left out at random, and articles get misleading ones, so that no single word decides. The
pages themselves, labelled by their own markup, are part of the training too. Every page is then decoded by the model alone, whole.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined by an
empty line in page order. A null, empty or blank page has the empty text, and so has one without any block of main
text. Without a page that marks an article the sample gives no texts, and built-in ones take their place. Rows are
judged one by one; repeated rows and null ids change nothing. Columns of any name may come with the page.
"""

from __future__ import annotations

import random
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import crf
from wordloom.llm.html_blocks import Block, blocks

# The model is fitted on at most so many pages of at most so many characters, those with the smallest hashes, and on so many
# layouts made from them, with texts of at most so many characters. These bounds are for fitting only.
SAMPLE_PAGES = 200
SAMPLED_CHARS = 200_000
LAYOUTS = 800
LAYOUT_CHARS = 3000
SEED = 5

# What the markup of a page says about its blocks, for labels of training pages only.
MAIN_TAGS = frozenset(("article", "main"))
OTHER_TAGS = frozenset(("nav", "footer", "aside", "form", "header", "button", "label", "select", "menu"))
OTHER_WORDS = frozenset(
    "ad ads advert advertisement advertising banner sponsored promo comment comments reply replies respond discussion sidebar widget"
    " related menu nav navigation navbar breadcrumb breadcrumbs footer header masthead cookie cookies consent notice alert newsletter"
    " subscribe share social login search copyright legal popup modal".split()
)

_MARK = "\ue000"  # stands before a text of the article in a layout; private use, so no page has it
_path_features: dict[tuple, list[int]] = {}
_named: dict[str, int] = {}


def _feature(name: str) -> int:
    known = _named.get(name)
    if known is None:
        known = crf.hashed(name)
        if len(_named) < 100_000:
            _named[name] = known
    return known


def _of_path(path: tuple) -> list[int]:
    known = _path_features.get(path)
    if known is None:
        tags = [tag for tag, _ in path]
        words = [w for _, own in path for w in own]
        names = {f"in {t}" for t in tags} | {f"name {w}" for w in words} | {"leaf " + (tags[-1] if tags else "")}
        names |= {f"own {w}" for w in (path[-1][1] if path else ())}
        names |= {f"{t} over {'/'.join(tags[i + 1 : i + 3])}" for i, t in enumerate(tags)}
        names.add("top " + "/".join([t for t in tags if t not in ("html", "body")][:2]))
        names.add(f"depth {min(len(tags), 8)}")
        known = [_feature(n) for n in sorted(names)]
        if len(_path_features) < 100_000:
            _path_features[path] = known
    return known


def _text_names(block: Block) -> list[str]:
    text = block.text
    n = len(text)
    end = text[-1]
    return [
        f"size {min(n, 4000).bit_length()}",
        f"words {min(text.count(' ') + 1, 500).bit_length()}",
        f"links {int(block.linked * 3.99)}",
        f"end {end if end in '.!?:,;' else 'other'}",
        f"comma {', ' in text}",
        f"mark {'©' in text or '|' in text or '»' in text}",
        f"upper {text[:1].isupper()}",
    ]


def features(page: Sequence[Block]) -> list[list[int]]:
    own = [_text_names(b) for b in page]
    leaf = [b.path[-1][0] if b.path else "" for b in page]
    out = []
    for i, block in enumerate(page):
        names = ["bias", *own[i], f"{leaf[i]} {own[i][0]}", f"{leaf[i]} {own[i][2]}"]
        names.append(f"place {4 * i // len(page)}")
        for step, j in (("before", i - 1), ("after", i + 1)):
            if 0 <= j < len(page):
                names += [f"{step} {leaf[j]}", f"{step} {own[j][0]}", f"{step} {own[j][2]}", f"{step} same {page[j].path == block.path}"]
            else:
                names.append(f"{step} none")
        out.append(_of_path(block.path) + [_feature(n) for n in names])
    return out


def marked_up(block: Block) -> int:
    """Label of a block by the markup of its page."""
    tags = {tag for tag, _ in block.path}
    words = {w for _, own in block.path for w in own}
    return int(bool(tags & MAIN_TAGS) and not tags & OTHER_TAGS and not words & OTHER_WORDS)


# The layouts. {} is the content of an element, {t} a short text.
_ARTICLE = ("<article>{}</article>", "<main>{}</main>", "<main><article class='post'>{}</article></main>", "<div class='post-content'>{}</div>",
            "<div class='entry-content'>{}</div>", "<div class='article-body'>{}</div>", "<div id='content'>{}</div>", "<section class='story'>{}</section>",
            "<div id='main' role='main'><div class='text'>{}</div></div>", "<div class='content'>{}</div>", "<td class='body'>{}</td>", "<div>{}</div>", "<article class='{w}-{w}'>{}</article>", "<article class='{w}-system-{w}' id='post'>{}</article>",
            "<article class='{o}-{w} post'>{}</article>", "<main><article class='{w}-{o}-review'>{}</article></main>")
_TOP = ("<nav><ul>{li}</ul></nav>", "<header><div class='logo'>{t}</div><ul class='menu'>{li}</ul></header>", "<div class='navbar'>{li}</div>",
        "<div id='menu'><ul>{li}</ul></div>", "<div class='breadcrumbs'><a href='/'>{t}</a> » <a href='/x'>{t}</a></div>", "<header><h1>{t}</h1><p>{t}</p></header>",
        "<header class='site-header'><p>{l}</p></header>")
_ANY = ("<div class='ad'>{l}</div>", "<div class='advert'><p>{l}</p></div>", "<div class='sponsored'>{t}</div>", "<div class='cookie-notice'><p>{l}</p><button>{t}</button></div>",
        "<div class='notice'>{l}</div>", "<div class='alert' role='alert'>{l}</div>", "<form><label>{t}</label><input name='q'><button>{t}</button></form>", "<aside><h3>{t}</h3><p>{l}</p></aside>",
        "<form class='newsletter'><p>{l}</p><input><button>{t}</button></form>", "<div class='share'>{li}</div>", "<div class='promo banner'><p>{l}</p></div>")
_BOTTOM = ("<aside class='sidebar'><h3>{t}</h3><ul>{li}</ul><p>{l}</p></aside>", "<div class='sidebar'><div class='widget'><p>{l}</p></div></div>",
           "<section class='comments'><h3>{t}</h3><div class='comment'><p>{l}</p></div><div class='comment'><p>{l}</p><p>{l}</p></div></section>",
           "<div id='comments'><ol class='comment-list'><li><p>{l}</p></li><li><p>{l}</p></li></ol></div>", "<ul class='replies'><li>{l}</li><li>{l}</li></ul>",
           "<section class='responses'><h3>{t}</h3><p>{l}</p><p>{l}</p></section>", "<section class='discussion'><p>{l}</p><div><p>{l}</p></div></section>",
           "<div class='related'><h4>{t}</h4><ul>{li}</ul></div>")
_END = ("<footer>&copy; {t} &middot; {t}</footer>", "<div class='footer'><p>{l}</p></div>", "<div id='footer'>{li}<p>&copy; {t}</p></div>", "<footer><nav>{li}</nav><p>{l}</p></footer>")
_PARTS = ("<p>{}</p>",) * 8 + ("<p>{}", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>", "<p><b>{}<br>", "<div>{}</div>", "<pre>{}</pre>")
_FALLBACK = ("The first sentence of a text that is long enough to be read, with a comma.", "Short line", "Another paragraph follows here. It ends as it should.")


def layout(rng: random.Random, article: Sequence[str], other: Sequence[str]) -> str:
    """A page of a random layout; texts of the article are marked."""

    def renamed(part: str) -> str:
        """Some elements without their class or with another one, where the tag or the place still tells what they are."""
        return re.sub(r" (?:class|id|role)='[^']*'", lambda m: rng.choice(("", f" class='{word()}'")) if rng.random() < 0.12 else m[0], part)

    def word() -> str:
        return rng.choice(words) if words else "x"

    def fill(part: str) -> str:
        part = renamed(part) if part.startswith(("<section", "<aside", "<footer", "<nav", "<header", "<form", "<ul")) else part
        while "{l}" in part:
            part = part.replace("{l}", rng.choice(article if rng.random() < 0.5 else other), 1)
        while "{li}" in part:
            items = "".join(f"<li><a href='/{i}'>{rng.choice(other)[:20]}</a></li>" for i in range(rng.randint(2, 6)))
            part = part.replace("{li}", items, 1)
        while "{t}" in part:
            part = part.replace("{t}", rng.choice(other)[: rng.choice((8, 20, 60))], 1)
        return part

    def some(parts: Sequence[str], most: int) -> list[str]:
        return [fill(rng.choice(parts)) for _ in range(rng.randint(0, most))]

    words = [w for w in map(str.lower, rng.choice(article).split()) if w.isascii() and w.isalpha()]
    inner = []
    if rng.random() < 0.8:
        title = f"<h1>{_MARK}{rng.choice(article)[:60]}</h1>"
        inner.append(f"<header>{title}</header>" if rng.random() < 0.25 else title)
    for _ in range(rng.randint(1, 14)):
        inner.append(rng.choice(_PARTS).format(_MARK + rng.choice(article)))
        if rng.random() < 0.08:
            inner.append(fill(rng.choice(_ANY)))
    if rng.random() < 0.25:
        inner.append(fill(rng.choice(_BOTTOM)))
    around = rng.choice(_ARTICLE).replace("{o}", rng.choice(sorted(OTHER_WORDS)))
    while "{w}" in around:
        around = around.replace("{w}", word(), 1)
    body = some(_TOP, 2) + some(_ANY, 1) + [around.replace("{}", "".join(inner))] + some(_ANY, 1) + some(_BOTTOM, 2) + some(_END, 1)
    if rng.random() < 0.2:
        body.insert(1, fill(rng.choice(_BOTTOM)))
    return f"<html><body>{''.join(body)}</body></html>"


def trained(sample: Sequence[str], layouts: int = LAYOUTS, seed: int = SEED) -> crf.Model:
    """A model from pages of the sample."""
    rng = random.Random(seed)
    pages = [b for b in map(blocks, sample) if b]
    labelled = [(features(p), [marked_up(b) for b in p]) for p in pages if any(map(marked_up, p))]
    escape = lambda t: t[:LAYOUT_CHARS].replace("&", "&amp;").replace("<", "&lt;")
    marked = [p for p in pages if any(map(marked_up, p))]  # of other pages it is not known which text is which
    article = [escape(b.text) for p in marked for b in p if marked_up(b)] or list(_FALLBACK)
    other = [escape(b.text) for p in marked for b in p if not marked_up(b)] or list(_FALLBACK)
    for _ in range(layouts):
        page = blocks(layout(rng, article, other))
        labels = [int(_MARK in b.text) for b in page]
        for b in page:
            b.text = b.text.replace(_MARK, "") or "."
        labelled.append((features(page), labels))
    return crf.fit(labelled)


def sample_of(pages: DataFrame, html: str = "html", most: int = SAMPLE_PAGES) -> list[str]:
    """Distinct pages with small hashes, at most `most`; the bound on the hashes lets about twice as many through.

    So no more than that leave their tasks, whatever the number of pages and tasks, and copies leave once. The bound
    follows the number of different pages, so copies don't make the sample smaller.
    """
    own = pages.select(F.col(html).alias("html")).where(f"html <> '' and length(html) <= {SAMPLED_CHARS}").withColumn("h", F.xxhash64("html"))
    different = own.agg(F.approx_count_distinct("h").alias("n")).first()["n"]
    share = min(1.0, 2 * most / max(1, different))
    chosen = own.where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30))).distinct().orderBy("h", "html").limit(most)
    return [r["html"] for r in chosen.collect()]


def main_text(html: Column, model: crf.Model) -> Column:
    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        out = []
        for page in pages:
            found = blocks(page.as_py() or "")
            labels = model.decode(features(found))
            out.append("\n\n".join(b.text for b, label in zip(found, labels) if label))
        return pa.array(out, pa.string())

    return extract.asNondeterministic()(html)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: (page_id, url, text, n_chars) for every row of `pages`."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    read = pages.withColumn("text", main_text(F.col("html"), trained(sample_of(pages))))
    return read.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
