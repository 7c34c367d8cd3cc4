"""The main text of web pages: blocks are labelled content or boilerplate by a minimum cut.

A classifier says what each block's label costs, by its text, its links and the elements around it. Blocks that follow each
other, and blocks of one parent, are joined by edges that cost where their labels differ, the less so the further apart they
lie in the page's tree. The cheapest labelling of the whole page is a minimum cut.
"""

from __future__ import annotations

import re
from math import log2

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loomstar.llm.html_blocks import Block, Page, read_page
from loomstar.llm.mincut import least_cost
from loomstar.llm.tables import prepare

#: Words in class names, ids and roles, by what they say of an element.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent contentinfo cookie cookies complementary copyright disclaimer disqus dropdown "
    "footer form gdpr hidden login masthead menu modal nav navbar navigation navi newsletter notice notification pager pagination paywall popup promo promoted promotion register related replies reply "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tagcloud toolbar topbar widget widgets alert warning".split()
)
WEAK_BOILERPLATE = frozenset("header head bottom links tags tag recommended recommendations popular trending more teaser legal rail aside secondary".split())
CONTENT = frozenset("article articlebody main content post entry story maintext body text page hentry".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form fieldset legend menu dialog search option optgroup".split())
#: Phrases of notices, in lower case.
PHRASES = re.compile(
    r"©|\ball rights reserved\b|\bcookies?\b|\bprivacy policy\b|\bterms of (?:use|service)\b|\bsubscribe\b|\bnewsletter\b|\bsign (?:in|up)\b|\blog ?in\b|\badvertisement\b|\bsponsored\b|"
    r"\bread more\b|\bshare (?:this|on)\b|\bleave a (?:comment|reply)\b|\balle rechte vorbehalten\b|\bdatenschutz\b|\bimpressum\b|\banzeige\b|\btous droits réservés\b|\bmentions légales\b|"
    r"\bs'abonner\b|\btodos los derechos reservados\b|\bpublicidad\b|\bsuscr[ií]bete\b"
)
#: Costs in thousandths: inside boilerplate or content elements, links, phrases, and edges between neighbours.
STRONG, WEAK, INSIDE, NAMED, LINKS, PHRASE, BESIDE, SIBLING, FARTHEST = 6000, 3000, 4500, 2500, 5000, 2500, 2000, 800, 12
_WORDS = re.compile("[a-z]+")
_SENTENCE_END = tuple(".!?…。！？:\"”»")

RESULT = "text string, n_blocks long, n_kept long"


def _names(told: dict[str, str]) -> list[str]:
    """Words of an element's class, id and role; of a compound written together only the parts that signs part."""
    return [w for key in ("class", "id", "role", "itemprop") if key in told for w in _WORDS.findall(told[key])]


def _evidence(page: Page) -> list[int]:
    """For each element the cost of calling what lies in it boilerplate (above 0) or content (below 0): the strongest boilerplate around it, else the strongest content.

    An element that holds the page's headline is no boilerplate by its name, except a page's header.
    """
    elements = page.elements
    in_article = [False] * len(elements)
    for k, e in enumerate(elements):
        if e.parent >= 0:
            in_article[k] = in_article[e.parent] or e.tag in ("article", "main") or e.told.get("role") == "main" or e.told.get("itemprop") == "articlebody"
    headlines = [h for h in page.headlines if in_article[h]] or page.headlines
    holds = [False] * len(elements)
    for h in headlines:
        while h >= 0 and not holds[h]:
            holds[h] = True
            h = elements[h].parent
    bad, good = [0] * len(elements), [0] * len(elements)
    for k, e in enumerate(elements):
        if e.parent < 0:
            continue
        bad[k], good[k] = bad[e.parent], good[e.parent]
        names = _names(e.told) if e.told else ()
        own = 0
        if e.tag in ("body", "html"):
            names = ()
        elif e.tag in BOILERPLATE_TAGS or any(w in BOILERPLATE for w in names) or "hidden" in e.told or e.told.get("aria-hidden") == "true" or "display:none" in e.told.get("style", "").replace(" ", ""):
            own = STRONG
        elif e.tag == "header":
            own = 0 if in_article[k] else STRONG
        elif any(w in WEAK_BOILERPLATE for w in names):
            own = WEAK
        if own and holds[k] and (in_article[k] or not (e.tag in ("header", "nav", "footer") or names == ["header"])):
            own = 0
        bad[k] = max(bad[k], own)
        if e.tag in ("article", "main") or e.told.get("role") == "main" or e.told.get("itemprop") == "articlebody":
            good[k] = INSIDE
        elif any(w in CONTENT for w in names):
            good[k] = max(good[k], NAMED)
    return [-b if b else g for b, g in zip(bad, good)]


def _lean(block: Block, page: Page, evidence: int) -> int:
    """How much more the label boilerplate costs than content, in thousandths."""
    text, tag = block.text, page.elements[block.element].tag
    words = text.count(" ") + 1
    lean = evidence + int(1000 * min(3.0, log2(1 + words) / 1.5 - 1.5)) - LINKS * block.linked // len(text)
    if text.endswith(_SENTENCE_END):
        lean += 600
    if tag in ("h1", "h2", "h3"):
        lean += 700
    elif tag == "li":
        lean -= 500
    elif tag in ("p", "blockquote", "pre"):
        lean += 500
    if words < 60 and PHRASES.search(text.lower()):
        lean -= PHRASE
    return lean


def _apart(page: Page, a: int, b: int) -> int:
    """Steps between two elements of the tree, up to ``FARTHEST``."""
    elements, steps = page.elements, 0
    while a != b and steps < FARTHEST:
        if elements[a].depth >= elements[b].depth:
            a = elements[a].parent
        else:
            b = elements[b].parent
        steps += 1
    return steps


def label(page: Page) -> list[bool]:
    """For each block whether it is content."""
    blocks, evidence = page.blocks, _evidence(page)
    unary = [_lean(b, page, evidence[b.element]) for b in blocks]
    edges, last_of = [], {}
    for k, block in enumerate(blocks):
        parent = page.elements[block.element].parent
        before = last_of.get(parent)
        if k:
            edges.append((k - 1, k, BESIDE // (1 + _apart(page, blocks[k - 1].element, block.element))))
        if before is not None and before < k - 1:
            edges.append((before, k, SIBLING))
        last_of[parent] = k
    return least_cost(unary, edges)


def main_text(html) -> tuple[str, int, int]:
    """(text, blocks, blocks kept) of a page; null is empty."""
    page = read_page(html) if isinstance(html, str) else Page()
    kept = [b.text for b, content in zip(page.blocks, label(page)) if content]
    return "\n".join(kept), len(page.blocks), len(kept)


def extract(pages: DataFrame, html: Column) -> Column:
    """A struct for each row of ``pages``: text (content blocks in page order, joined by line ends), n_blocks, n_kept.

    A block is the text between elements that begin or end one; its white space runs (line breaks and no-break spaces among
    them) are one space and character references are decoded. Scripts, styles, comments of the markup, form controls and
    tags are no text. A null or empty page, or one without content, has an empty text. Pages of any length and of broken markup
    are read whole, in one pass: what is never closed ends with the page. Repeated rows get equal results, an empty table gives
    no rows, and no other column is read. Of labellings that cost the same the one with fewer content blocks is taken.
    """
    prepare(pages.sparkSession)

    @F.pandas_udf(RESULT)
    def read(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([main_text(t) for t in texts], columns=["text", "n_blocks", "n_kept"])

    return read(html)
