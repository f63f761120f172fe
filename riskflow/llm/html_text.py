"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is read as a sequence of words and tags. Words score above zero, tags below, and the contiguous
run with the largest sum is the content region. The scores are log odds learned from labelled pages,
those whose markup names the article (one ``article`` or ``main`` element): how often each kind of
token stands inside and outside, menus and footers included. Words of blocks with more than ``SHORT`` words are a kind of their own, and so are
those of links; marks inside running text say little about a place and score next to nothing.
Defaults stand in as prior counts, so pages can be read without labels.
Elements that are never text (scripts, menus, forms, comments ...) and name themselves so are passed over in the
scan and in the output; pages that do not name them are left to the scan.

Null and empty pages give the empty text. Rows are read one by one, so repeated rows and ids give equal
rows, and null ids stay null. An empty table gives an empty result. Columns other than ``page_id``,
``url`` and ``html`` are not read. An element that is never closed hides nothing beyond the next block.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.tables import text_of

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<raw>script|style|textarea|noscript|template|title|iframe|svg|math)\b(?:[^\"'<>]++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attributes>(?:[^\"'<>]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|(?P<text>[^<]+|<)", re.I | re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
NAME_PARTS = re.compile(r"[a-z]+", re.I)

# Fixed values of HTML: elements that start a block, that hold no running text, and that never close.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary
table tbody td tfoot th thead tr ul""".split())
NEVER_TEXT = frozenset("nav footer aside form button select option label input dialog menu search head object embed canvas audio video map".split())
UNSEEN = frozenset("script style textarea noscript template title iframe svg math head meta link base".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in class, id or role that mark an element as no part of the article.
BOILERPLATE = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent
notice gdpr newsletter subscribe subscription signup popup modal overlay sidebar menu nav navbar navigation breadcrumb
breadcrumbs footer comment comments disqus respond replies share sharing social related recommended recommendations widget login search
searchbox pagination pager toolbar masthead contentinfo complementary alertdialog skip""".split())

# Marks inside running text.
INLINE = frozenset("a abbr b bdi bdo br cite code data del dfn em font i img ins kbd mark q s samp small span strong sub sup time u var wbr".split())
#: Prior scores and how many labelled tokens they weigh; least score of a word, of a tag, the most of either; words of a short block.
PRIOR_WORD, PRIOR_TAG, PRIOR_COUNT = 1.0, -1.0, 50
LEAST_WORD, LEAST, MOST, SHORT = 0.3, 0.05, 3.0, 25
WORDS = ("word", "long word", "linked word")


def parse(page: str) -> list[tuple[str, str, bool]]:
    """``(kind, value, hidden)`` tokens in page order: kind ``tag`` with its name (closing ones start with /) or ``text``."""
    tokens, drops, opened = [], [], {}
    for m in TOKEN.finditer(page):
        if m["text"] is not None:
            tokens.append(["text", m["text"], False])
        elif m["raw"]:
            tokens += [["tag", m["raw"].lower(), True], ["tag", "/" + m["raw"].lower(), True]]
        elif m["name"]:
            name = m["name"].lower()
            at = len(tokens)
            tokens.append(["tag", m["end"] + name, False])
            if name in VOID:
                continue
            if not m["end"]:
                opened.setdefault(name, []).append((at, _dropped(name, m["attributes"])))
            elif opened.get(name):
                start, drop = opened[name].pop()
                if drop:
                    drops.append((start, at))
    articles = _articles(tokens)
    for left in opened.values():                  # never closed: up to the next block
        for start, drop in left:
            if drop:
                end = next((i for i in range(start + 1, len(tokens)) if tokens[i][0] == "tag" and tokens[i][1].lstrip("/") in BLOCKS), len(tokens))
                drops.append((start, end))
    for start, end in drops:
        if tokens[start][1] == "header" and any(a < start and end < b for a, b in articles):
            continue                              # the head of the article itself
        if any(start < a and b < end for a, b in articles) and tokens[start][1] not in NEVER_TEXT:
            continue                              # a wrapper of the article, whatever its class says
        for i in range(start, end + 1):
            if i < len(tokens):
                tokens[i][2] = True
    return [tuple(t) for t in tokens]


def _dropped(name: str, attributes: str) -> bool:
    if name in NEVER_TEXT or name == "header":
        return True
    if name in ("body", "html", "article", "main") or not attributes.strip():
        return False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key in ("class", "id", "role") and not BOILERPLATE.isdisjoint(NAME_PARTS.findall(value)):
            return True
    return False


def _articles(tokens: list) -> list[tuple[int, int]]:
    """Outermost article or main elements as token ranges."""
    for name in ("article", "main"):
        depth, start, found = 0, 0, []
        for i, (kind, value, _) in enumerate(tokens):
            if kind == "tag" and value == name:
                start = i if depth == 0 else start
                depth += 1
            elif kind == "tag" and value == "/" + name and depth:
                depth -= 1
                if depth == 0:
                    found.append((start, i))
        if found:
            return found
    return []


def scored_units(tokens: list[tuple[str, str, bool]], hidden_too: bool = False) -> Iterator[tuple[int, str, int]]:
    """Token index, kind and number of what is scored: words and tags, of passed-over elements only for counting."""
    linked, sizes = 0, _block_sizes(tokens)
    for i, (kind, value, hidden) in enumerate(tokens):
        if kind == "tag" and value in ("a", "/a"):
            linked = value == "a"
        if hidden and not (hidden_too and value.lstrip("/") not in UNSEEN):
            continue
        if kind == "text":
            words = len(value.split())
            if words:
                yield i, "linked word" if linked else "long word" if sizes[i] > SHORT else "word", words
        else:
            yield i, value, 1


def _block_sizes(tokens: list[tuple[str, str, bool]]) -> list[int]:
    """For each token the number of words in its block."""
    out, start, words = [0] * len(tokens), 0, 0
    for i, (kind, value, _) in enumerate([*tokens, ("tag", "p", False)]):
        if kind == "text":
            words += len(value.split())
        elif value.lstrip("/") in BLOCKS:
            out[start:i] = [words] * (i - start)
            start, words = i, 0
    return out


def label_counts(page: str) -> Counter:
    """``(kind, inside)`` counts of a page whose markup names one article; none of other pages."""
    tokens = parse(page)
    articles, found = _articles(tokens), Counter()
    if len(articles) == 1:
        (a, b), = articles
        for i, kind, n in scored_units(tokens, hidden_too=True):
            found[kind, a < i < b] += n
    return found


def learn_weights(pages: DataFrame) -> dict[str, float]:
    """Score of each kind of token, from all labelled pages; kinds other than HTML's own names count as one."""
    known = {*BLOCKS, *NEVER_TEXT, *VOID, *INLINE, *WORDS}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = Counter()
        for frame in frames:
            for page in frame["html"]:
                for (kind, inside), n in label_counts(page).items():
                    total[kind if kind.lstrip("/") in known else "other", inside] += n
        yield pd.DataFrame([(k, i, n) for (k, i), n in total.items()], columns=["kind", "inside", "n"])

    rows = (pages.select(text_of("html").alias("html")).mapInPandas(run, "kind string, inside boolean, n long")
            .groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect())     # twice the number of known kinds at most
    counts = Counter({(r.kind, r.inside): r.n for r in rows})
    inside, outside = (sum(n for (_, i), n in counts.items() if i == side) for side in (True, False))
    weights = {}
    for kind in {k for k, _ in counts}:
        a, b = counts[kind, True], counts[kind, False]
        odds = math.log((a + 1) / (inside + 2)) - math.log((b + 1) / (outside + 2))
        prior = PRIOR_WORD if kind in WORDS else PRIOR_TAG
        value = (odds * (a + b) + prior * PRIOR_COUNT) / (a + b + PRIOR_COUNT)
        if kind in WORDS:
            weights[kind] = min(max(value, LEAST_WORD), MOST)
        else:
            weights[kind] = -LEAST if kind.lstrip("/") in INLINE else max(min(value, -LEAST), -MOST)
    return weights


def score_of(kind: str, weights: dict[str, float]) -> float:
    if kind in WORDS:
        return weights.get(kind, weights.get("word", PRIOR_WORD))
    return weights.get(kind, -LEAST if kind.lstrip("/") in INLINE else weights.get("other", PRIOR_TAG))


def content_region(tokens: list[tuple[str, str, bool]], weights: dict[str, float]) -> tuple[int, int]:
    """First and last token of the run with the largest sum, found in one scan; (0, -1) without words."""
    best, span, total, start = 0.0, (0, -1), 0.0, 0
    for i, kind, n in scored_units(tokens):
        if total <= 0:
            total, start = 0.0, i
        total += n * score_of(kind, weights)
        if total > best:
            best, span = total, (start, i)
    return span


def main_text(page: str, weights: dict[str, float]) -> str:
    tokens = parse(page)
    first, last = content_region(tokens, weights)
    parts, blocks = [], []
    for kind, value, hidden in tokens[first:last + 1]:
        if kind == "tag":
            if value.lstrip("/") in BLOCKS:
                blocks.append("".join(parts))
                parts = []
            elif value == "br":
                parts.append(" ")
        elif not hidden:
            parts.append(entities.unescape(value))
    blocks.append("".join(parts))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; ``weights`` are learned from ``pages`` where not given."""
    weights = learn_weights(pages) if weights is None else weights

    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return column.map(lambda page: main_text(page, weights))

    found = pages.select("page_id", "url", text(text_of("html")).alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
