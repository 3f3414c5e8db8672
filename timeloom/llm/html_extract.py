"""Main text of web pages by two passes of block rules.

The first pass decides blocks by their place in the page, link density,
length and stop-word density. Short blocks that it leaves open then take the
label of the nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.runtime import map_arrow

# Element names and attribute words that mark a part of a page.
DROPPED = frozenset("nav footer aside form head title button select option label dialog menu noscript".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
NESTING = frozenset("address article aside blockquote body button details dialog div dl fieldset figcaption figure footer form head header html label main menu nav noscript ol option section select table td title ul".split())
MARKED = re.compile(r"(?:^|[_-])(ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|breadcrumbs?|comment\w*|replies|reply|discussion|respond|disqus|share|sharing|social|newsletter|subscribe|signup|login|popup|modal|pagination|pager)(?:$|[_-])", re.IGNORECASE)
DOUBTFUL = re.compile(r"(?:^|[_-])(related|recommended)(?:$|[_-])", re.IGNORECASE)  # lists of links, or sections of an article
LAYOUT = re.compile(r"(?:(?:site|global)[_-])?(?:notices?|banner|alert|sidebar|side|menu|nav|navbar|navigation|footer|masthead|header|overlay|widget|toolbar|skip)", re.IGNORECASE)  # whole names
STATE = re.compile(r"(?:has|with|no|without|is|show|hide)[_-]", re.IGNORECASE)  # what a page has, not what an element is
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
STOP_WORDS = frozenset(
    "the of and to in a is that it for was on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than been its who now people my made over did down only way find use may "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei "
    "le de un à être et en avoir que pour dans ce il qui ne sur se pas plus par je avec tout faire son mettre autre on mais nous comme ou si leur y dire elle avant deux même la les des est du une au sont aux "
    "el que y los se del las por con no una su para es al lo más o pero sus ha me sin sobre este ya entre cuando todo esta ser son dos también fue había era muy hasta desde está mi porque".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|template|svg|iframe|textarea)\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)

# Scripts that set no blanks between words, and letters that are frequent in running text of them.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff]")
FREQUENT = re.compile("[\u3041-\u3096\u0e30-\u0e39\u102b-\u103e\u17b6-\u17d3的是不了在人有我他这個个们來来到時时大地為为子中你說说生國国年着就那和要她出也得里後后自以會会家可下而過过天去能對对小多然於于心學学麼么之都好看起發发當当没成只如事把還还用第樣样道想作種种開开]")

LINKED, LONG, DENSE, SPARSE = 0.4, 25, 0.2, 0.1
PER_WORD = 2  # letters of an unspaced script that count as a word


@dataclass
class Block:
    text: str
    linked: int  # code points inside links
    region: str  # "drop", "wrap" (dropped but for an article or main in it), "doubt" (marked as related), "article" or ""
    heading: bool
    good: bool | None = None


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, white space folded, character references decoded."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked: list[str] = []
    region, in_link, heading = "", 0, False

    def close() -> None:
        nonlocal heading
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, len("".join(html.unescape("".join(linked)).split())), region, heading))
        parts.clear()
        linked.clear()
        heading = False

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
            if in_link:
                linked.append(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in BLOCKS:
            close()
            in_link = 0
        elif name in ("br", "wbr", "img", "input"):
            parts.append(" ")
        if name == "a":
            in_link = 0 if m["end"] else 1
        if name in HEADINGS:
            heading = not m["end"]
        if name not in NESTING:
            continue
        if m["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if name not in BLOCKS:
                        close()
                    del stack[i:]
                    region = stack[-1][1] if stack else ""
                    break
        else:
            if name not in BLOCKS:
                close()
            stack.append((name, region))
            if region != "drop":
                region = place(name, m["attributes"] or "", region)
            stack[-1] = (name, region)
    if at < len(page):
        parts.append(page[at:])
    close()
    return out


def place(name: str, attributes: str, outer: str) -> str:
    """The region that an element opens."""
    if name in DROPPED or (name == "header" and outer != "article"):
        return "drop"
    if name in ("article", "main"):
        return "article"
    if attributes and name not in ("html", "body"):
        names = [w for m in NAMED.finditer(attributes) for w in (m[1] or m[2] or m[3] or "").split() if not STATE.match(w)]
        if any(MARKED.search(w) for w in names):
            return "drop"
        if any(LAYOUT.fullmatch(w) for w in names):
            return "wrap"
        if any(DOUBTFUL.search(w) for w in names):
            return "doubt" if outer == "article" else "wrap"
    return outer


def measure(text: str) -> tuple[int, float]:
    """Length in words, and the share of stop words; letters of unspaced scripts count ``PER_WORD`` to a word."""
    words = text.split()
    letters = len(UNSPACED.findall(text))
    if letters > len(text) // 2:
        return letters // PER_WORD, len(FREQUENT.findall(text)) / letters
    return len(words), sum(w.lower().strip(".,;:!?\"'()") in STOP_WORDS for w in words) / max(1, len(words))


def decide(found: list[Block]) -> None:
    """Labels every block; see the module's description."""
    framed = any(b.region == "article" for b in found)
    for b in found:
        density = b.linked / max(1, len(b.text) - b.text.count(" "))
        if b.region in ("drop", "wrap") or density > LINKED:
            b.good = False
        elif b.region == "article":
            b.good = True
        else:
            length, stops = measure(b.text)
            if length >= LONG:
                b.good = True if stops >= DENSE else False if stops < SPARSE and density > 0 else stops >= SPARSE or length >= 2 * LONG
            elif framed and b.region != "doubt":
                b.good = False
    inherit(found)


def inherit(found: list[Block]) -> None:
    """Gives open blocks the label of the nearest decided ones; a heading that of what follows; of unlike equals none."""
    n = len(found)
    before, after = [-1] * n, [n] * n
    for i in range(n):
        before[i] = i if found[i].good is not None else before[i - 1] if i else -1
    for i in range(n - 1, -1, -1):
        after[i] = i if found[i].good is not None else after[i + 1] if i + 1 < n else n
    labels = [b.good for b in found]
    for i, b in enumerate(found):
        if b.good is None:
            p, q = before[i], after[i]
            if p < 0 or q == n:
                b.good = bool(labels[q if p < 0 else p]) if p >= 0 or q < n else False
            elif labels[p] == labels[q] or b.heading:
                b.good = labels[q]
            else:
                b.good = labels[p] if i - p < q - i else labels[q] if q - i < i - p else False


def main_text(page: str) -> str:
    """Good blocks in page order, joined by one blank; empty if there is none."""
    found = blocks(page)
    decide(found)
    return " ".join(b.text for b in found if b.good)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page from its whole html; null html gives an empty text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return map_arrow(pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")), work, "page_id bigint, url string, text string, n_chars bigint", 500)
