"""The main text of web pages, by labelling their blocks with a minimum cut.

1. A page is read once, from left to right, into blocks: the text between two borders of block elements, with its place in the tree
   and what its ancestors say of it (landmarks, roles, words of class and id, hidden).
2. A logistic classifier, trained here on the labelled sketches below, gives each block the probability of being content. Its two
   costs, -log p and -log(1 - p), become the capacities of the block's edges to the two terminals.
3. Smoothness edges join neighbouring blocks, and neighbours under one parent; the nearer two blocks are in the tree, the more it costs
   to label them differently. Each pair of blocks has one such edge at most, so a page has fewer than two a block.
4. The maximum flow from one terminal to the other saturates the cheapest set of edges; blocks still in reach of the content terminal
   are the main text.

Every page is a row by itself: pages stream through Arrow batches, nothing is shuffled, and a lost task is run again. The model is a few
dozen numbers.

Defined cases: null html counts as empty and has no text; a page of text without markup is one block; unclosed and stray tags, comments,
quotes and character references are read as browsers read them, as far as blocks go; `<br>` is white space; scripts, styles, templates,
drawings, controls and the head are no blocks; rows with null or repeated ids or urls are extracted alike; pages of any length are read
whole; other columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches_of, modest

#: Of smoothness edges between neighbours: the cost of a label change where both have one parent, and the part of it that each further step in the tree leaves.
SMOOTH, FADE = 0.7, 0.6
#: Capacities are whole numbers, so many a unit of cost; no cost is above COST.
UNIT, COST = 1000, 9.0
#: Ancestors that matter: further apart, a change of label costs less than one unit.
NEAR = 16
#: Weight decay of the classifier, and how many of its training steps at most.
DECAY, STEPS = 0.03, 40

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
SKIPPED = frozenset("head script style noscript template svg math iframe object canvas audio video select textarea button datalist noembed noframes xmp title".split())
#: Their content is text up to the end tag, whatever it looks like.
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript".split())
VOID = frozenset("hr".split())
#: A start tag ends those open elements, up to the element in which they may stand.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}), "tbody": ({"thead", "tbody"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"})}

NAV, FOOTER, HEADER, ASIDE, FORM, AD, COMMENT, NOTICE, EXTRA, HIDDEN, ARTICLE, MAIN, BODY, MARK = (1 << i for i in range(14))
LANDMARKS = {"nav": NAV, "menu": NAV, "footer": FOOTER, "header": HEADER, "aside": ASIDE, "form": FORM, "fieldset": FORM, "dialog": NOTICE, "article": ARTICLE, "main": MAIN}
ROLES = {"navigation": NAV, "menu": NAV, "menubar": NAV, "contentinfo": FOOTER, "banner": HEADER, "complementary": ASIDE, "search": FORM, "form": FORM, "alert": NOTICE, "dialog": NOTICE, "alertdialog": NOTICE, "status": NOTICE, "main": MAIN, "article": ARTICLE}
#: Words of class and id.
HINTS = {w: bit for bit, words in (
    (NAV, "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager topnav skip"), (FOOTER, "footer foot colophon copyright copy legal"), (HEADER, "masthead topbar header siteheader"),
    (ASIDE, "sidebar side aside rail widget widgets related recommended recommendations more teaser teasers trending popular"), (FORM, "form search login signin newsletter subscribe subscription signup poll"),
    (AD, "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner outbrain taboola adsense commercial"), (COMMENT, "comment comments commentlist reply replies respond disqus discussion feedback"),
    (NOTICE, "cookie cookies consent gdpr notice notices alert warning message modal popup toast overlay paywall disclaimer"), (EXTRA, "share sharing social meta tags tag tools toolbar buttons rating author byline dateline"),
    (BODY, "article post entry content story body text main page hentry prose")) for w in words.split()}
NAMES = ("nav", "footer", "header", "aside", "form", "ad", "comment", "notice", "extra", "hidden", "article", "main", "body", "outside", "paragraph", "heading", "item", "cell", "links", "length", "sentence", "short", "rights", "bias")

_TOKEN = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_REST = re.compile(r"""(?>[^>"']+|"[^"]*"|'[^']*')*+>""")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Phrases of notices and imprints; their share of a text counts, but not in an article, which may speak of such things.
RIGHTS = ("©", "copyright", "all rights reserved", "cookie", "privacy policy", "terms of", "subscribe", "sign in", "log in")


class Block(NamedTuple):
    text: str
    tag: str
    #: Numbers of the block's element and of NEAR ancestors at most, the outermost first; the root is 0.
    path: tuple[int, ...]
    flags: int
    linked: int


def _said(tag: str, attributes: str) -> int:
    """What an element says of the text in it."""
    flags = LANDMARKS.get(tag, 0)
    if not attributes.strip(" /"):
        return flags
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape("".join(values))
        if name == "role":
            flags |= ROLES.get(value.strip().lower(), 0)
        elif name in ("class", "id") and tag not in ("html", "body"):
            for one in value.split():
                words = [w.lower() for w in _WORD.findall(one)]
                # the words of a main element's compound names speak of its look
                if tag not in ("article", "main") or len(words) == 1:
                    for w in words:
                        flags |= HINTS.get(w, 0)
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            flags |= HIDDEN
        elif name == "data-main":
            flags |= MARK
    return flags


def _within(flags: int, own: int) -> int:
    """Flags of an element in one of ``flags``. An article or main element starts anew: what wraps a whole page says nothing of it."""
    return (flags & ~(FORM | HEADER | FOOTER) if own & (ARTICLE | MAIN) else flags) | own


def blocks_of(page: str) -> list[Block]:
    out: list[Block] = []
    # open block elements: tag, path, flags
    stack: list[tuple[str, tuple[int, ...], int]] = [("", (0,), 0)]
    still: Counter[str] = Counter()
    ends_at: dict[str, int] = {}
    made, parts, linked = 0, [], 0
    link = 0  # how many elements were open where the link that is open started, or 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            linked += len(text) if link else 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split()) if parts else ""
        if text:
            tag, path, flags = stack[-1]
            out.append(Block(text, tag, path, flags, min(linked, len(text))))
        parts.clear()
        linked = 0

    def close(n: int) -> None:
        nonlocal link
        flush()
        still.subtract(x[0] for x in stack[n:])
        del stack[n:]
        link = link if link <= len(stack) else 0

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        if m[2] is None:
            end = ("-->", 4 if not page.startswith(("<!-->", "<!--->"), m.start()) else 2) if m[0] == "<!--" else (">", 2)
            found = page.find(end[0], m.start() + end[1])
            at = found + len(end[0]) if found >= 0 else size
            continue
        rest = _REST.match(page, m.end())
        at = rest.end() if rest else page.find(">", m.end()) + 1
        if not at:
            break  # a tag that never ends
        tag, attributes = m[2].lower(), page[m.end() : at - 1]
        if m[1]:
            if tag in BLOCKS:
                n = still[tag] > 0 and next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag)
                close(n or len(stack))
            elif tag == "a":
                link = 0
        elif tag in SKIPPED:
            if tag not in ends_at:
                ends_at[tag] = page.rfind(f"</{tag}")
                if ends_at[tag] < at:
                    ends_at[tag] = max((m.start() for m in re.finditer(f"</{tag}", page, re.I)), default=-1)
            if tag in RAW or at <= ends_at[tag] and not attributes.endswith("/"):
                at = _after(page, at, tag)
        elif tag in BLOCKS:
            ends, stop = ENDS.get(tag, ((), ()))
            n = len(stack)
            if stack[-1][0] == "p":
                n -= 1  # a paragraph holds no block
            for i in range(n - 1, 0, -1) if any(still[t] for t in ends) else ():
                if stack[i][0] in stop:
                    break
                if stack[i][0] in ends:
                    n = i
                    break
            close(n)
            _, path, flags = stack[-1]
            made += 1
            if tag not in VOID:
                stack.append((tag, (*path[-NEAR:], made), _within(flags, _said(tag, attributes))))
                still[tag] += 1
        elif tag == "a":
            link = len(stack)
        elif tag == "br":
            parts.append(" ")
    flush()
    return out


def _after(page: str, at: int, tag: str) -> int:
    """The place behind an element whose content is not read; elements of its own name nest unless the content is raw."""
    depth = 1
    for m in re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*+>", re.I).finditer(page, at):
        depth += -1 if m[1] else tag not in RAW
        if not depth:
            return m.end()
    return len(page) if tag in RAW else at


def features(blocks: list[Block]) -> np.ndarray:
    """(blocks, features): flags of the ancestors, the element, links, length and looks of the text."""
    out = np.zeros((len(blocks), len(NAMES)))
    central = any(b.flags & (ARTICLE | MAIN) for b in blocks)
    for row, b in zip(out, blocks, strict=True):
        n, low = len(b.text), b.text.lower()
        row[:13] = [b.flags >> i & 1 for i in range(13)]
        row[11] *= not b.flags & ARTICLE
        row[13:] = (
            central and not b.flags & (ARTICLE | MAIN), b.tag in ("p", "blockquote", "pre"), b.tag in ("h1", "h2", "h3", "h4", "h5", "h6"), b.tag in ("li", "dt", "dd"), b.tag in ("td", "th"),
            b.linked / n, min(math.log1p(n) / 5, 1.4), b.text[-1] in ".!?…。！？:\"”»", n < 25, 0 if b.flags & ARTICLE else min(1.0, 5 * sum(len(w) for w in RIGHTS if w in low) / n), 1,
        )
    return out


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic classifier with weight decay, by Newton's steps."""
    w = np.zeros(x.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + DECAY * np.eye(len(w)), x.T @ (y - p) - DECAY * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(pages: list[str] | None = None) -> np.ndarray:
    """The classifier's weights, from pages whose main elements carry the attribute data-main; the built-in sketches, if none are given."""
    found = [blocks_of(p) for p in (SKETCHES if pages is None else pages)]
    return fit(np.concatenate([features(b) for b in found]), np.array([b.flags & MARK > 0 for page in found for b in page], float))


def smoothness(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """(i, j, capacity): edges between neighbours, and between neighbours among the blocks of one parent."""
    last: dict[int, int] = {}
    out = []
    for j, b in enumerate(blocks):
        parent = b.path[-2] if len(b.path) > 1 else 0
        for i in sorted({i for i in (j - 1, last.get(parent, -1)) if i >= 0}):
            a = blocks[i].path
            shared = max(set(a) & set(b.path), default=None)  # numbers grow on the way down
            if shared is not None:
                steps = max(len(a) - a.index(shared), len(b.path) - b.path.index(shared)) - 2
                out.append((i, j, round(UNIT * SMOOTH * FADE ** max(0, steps))))
        last[parent] = j
    return out


def minimum_cut(costs: list[tuple[int, int]], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes are on the content side of a minimum cut; costs: of being boilerplate and of being content, for each node.

    Dinic's algorithm. What flows straight from one terminal through a node to the other is taken off first, so a node has an edge to one terminal only.
    """
    n = len(costs)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: int, back: int) -> None:
        for x, y, c in ((a, b, forth), (b, a, back)):
            out[x].append(len(to))
            to.append(y)
            room.append(c)

    for i, (boiler, content) in enumerate(costs):
        if boiler > content:
            join(source, i, boiler - content, 0)
        elif content > boiler:
            join(i, sink, content - boiler, 0)
    for a, b, c in edges:
        if c:
            join(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            x = queue.popleft()
            for e in out[x]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[x] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        x = source
        while True:
            if x == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(k for k, e in enumerate(path) if not room[e])
                x = to[path[first] ^ 1]
                del path[first:]
            while at[x] < len(out[x]):
                e = out[x][at[x]]
                if room[e] and level[to[e]] == level[x] + 1:
                    break
                at[x] += 1
            else:
                if not path:
                    break
                x = to[path.pop() ^ 1]
                at[x] += 1
                continue
            path.append(e)
            x = to[e]


def terminal(logit: float) -> tuple[int, int]:
    """The costs of a block's two labels, boilerplate and content: -log(1 - p) and -log p."""
    soft = lambda z: min(COST, max(z, 0.0) + math.log1p(math.exp(-abs(z))))
    return round(UNIT * soft(logit)), round(UNIT * soft(-logit))


def label(blocks: list[Block], weights: np.ndarray) -> list[bool]:
    if not blocks:
        return []
    return minimum_cut([terminal(z) for z in (features(blocks) @ weights).tolist()], smoothness(blocks))


def main_text(page: str, weights: np.ndarray) -> str:
    blocks = blocks_of(page)
    return "\n".join(b.text for b, kept in zip(blocks, label(blocks, weights), strict=True) if kept)


def extract(pages: DataFrame, weights: np.ndarray) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``."""
    modest(pages.sparkSession)
    given = np.array(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 200):
            text = pa.array([main_text(h.as_py() or "", given) for h in b.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), text], ["page_id", "url", "text"])

    found = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return found.mapInArrow(run, "page_id bigint, url string, text string").withColumn("n_chars", F.length("text").cast("bigint"))


def labelled_blocks(pages: DataFrame, weights: np.ndarray) -> DataFrame:
    """(page_id, position, tag, text, probability, kept): all blocks of every page and what they were taken for."""
    modest(pages.sparkSession)
    given = np.array(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 50):
            rows = []
            for page_id, page in zip(b.column("page_id").to_pylist(), b.column("html"), strict=True):
                blocks = blocks_of(page.as_py() or "")
                p = 1 / (1 + np.exp(-features(blocks) @ given))
                rows += [(page_id, i, x.tag, x.text, float(p[i]), kept) for i, (x, kept) in enumerate(zip(blocks, label(blocks, given), strict=True))]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["page_id", "position", "tag", "text", "probability", "kept"])

    found = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("html").cast("string").alias("html"))
    return found.mapInArrow(run, "page_id bigint, position int, tag string, text string, probability double, kept boolean")


_P = "Ropa lindo veral maste kindor, wen tolam pirest an dolver. Sika remond ulta beshar no trivel, kam oster wid lanu."
_Q = "Vask entolir mande hos plurin; ake wistem foral dende, ruk sambel teno vir? Askol brind te lommar."
_S = "Kelm darro vist."
#: Sketches of pages in invented words; data-main marks the elements whose text is content.
SKETCHES = [
    f"""<body><header><a href=/>Ropal Times</a><p>Dolver an kindor</p></header><nav><ul><li><a href=/a>Lindo</a><li><a href=/b>Veral</a><li><a href=/c>Maste</a></ul></nav><main><article data-main><h1>Ropa lindo veral</h1>
    <p>{_P}<p>{_Q}<p>Tolam.<h2>Wen pirest</h2><p>{_P}<p>{_S}<ul><li>Sika remond ulta<li>Beshar no trivel</ul><blockquote>{_Q}</blockquote></article></main><aside><h3>Oster wid</h3><p>{_S}<ul><li><a href=/d>Kam oster</a><li><a href=/e>Lanu entolir</a></ul></aside>
    <footer><p>&copy; Ropal Times 2020<p><a href=/f>Mande hos</a></footer>""",
    f"""<body><div id=header><h1><a href=/>Vaskol</a></h1><div class=tagline>Plurin ake wistem</div></div><div id=menu><a href=1>Foral</a> <a href=2>Dende</a> <a href=3>Ruk</a></div><div id=content><div class=post data-main><h2>Sambel teno vir</h2>
    <p>{_Q}</p><p>{_P}</p><p>{_S}</p><pre>askol 12 = brind</pre><p>{_P}</p></div><div class=comments><h3>3 lommar</h3><div class=comment><b>Kelm</b><p>{_P}</p></div><div class=comment><b>Darro</b><p>{_S}</p></div><div class=comment><p>{_Q}</p></div></div></div>
    <div id=sidebar><h3>Vist</h3><ul><li><a href=4>Ropa lindo veral maste</a></li><li><a href=5>Wen tolam</a></li></ul><p>{_S}</p></div><div id=footer>Plurin ake. All rights reserved.</div>""",
    f"""<body><div class="cookie-banner"><p>{_S} We use cookies.</p><button>OK</button></div><div class=top><form action=/s><label>Pirest</label><input></form></div><div role=navigation><a href=1>An</a><a href=2>Dolver</a></div><div class=ad>{_Q}</div>
    <div class="story-body"><h1 data-main>Remond ulta beshar</h1><div class=byline>Kam oster, 3 trivel</div><p data-main>{_P}</p><div class="ad-slot">{_S}</div><p data-main>{_Q}</p><p data-main>{_P}</p><h3 data-main>No trivel</h3><p data-main>{_Q}</p></div>
    <div class=related><h4>Lanu entolir</h4><p><a href=3>{_S}</a></p><p><a href=4>Mande hos plurin</a></p></div><div class=newsletter><p>{_S} Subscribe.</p><form><input></form></div>""",
    f"""<body><form id=page><header role=banner><h2>Wistem</h2></header><main class="page has-sidebar"><h1 data-main>Foral dende ruk</h1><section data-main><p>{_P}<p>{_P}<p>{_S}</section><section data-main><h2>Sambel</h2><p>{_Q}<dl><dt>Teno<dd>Vir askol brind te lommar.</dl></section></main>
    <aside class=sidebar><p>{_P}</p></aside><div class=notice role=alert>{_S}</div><footer><p>{_Q}</p></footer></form>""",
    f"""<body><table><tr><td><a href=1>Kelm</a><td><a href=2>Darro</a><td><a href=3>Vist</a></table><div data-main><h1>Tolam pirest</h1><p>{_Q}</p><p>{_P}</p><table><tr><th>Dolver<th>Sika<tr><td>Ulta 12<td>Beshar 7</table><p>{_P}</p></div><p><a href=4>Kam</a> | <a href=5>Oster</a> | <a href=6>Wid</a><p>Copyright Lanu""",
    f"""<nav><a href=1>Ropa</a></nav><div class=ad>{_P}</div><article data-main><h1>Maste kindor wen</h1><p>{_S}<p>Wen.<p>{_P}<p>Dolver an.</article><footer>&copy; maste.example &middot; {_P}</footer>""",
    f"""<nav><ul><li><a href=1>Ropa</a><li><a href=2>Lindo</a></ul></nav><article data-main><h1>Veral</h1><p>Ropa lindo<p>Kindor.<p>{_P}<p>Sika remond<p>{_Q}</article><section id=comments><h2>Foral dende</h2><article class=comment><p>{_Q}</article><article><p>{_P}<p>{_S}</article>
    <form><p>Ruk sambel teno vir askol.</p></form></section><div class=ad>{_S}</div><footer>{_S}</footer>""",
    f"""<div class=wrapper><div class=masthead><p>{_S}</p></div><div class=breadcrumbs><a href=1>An</a> / <a href=2>Wid</a> / Lanu</div><div class=entry data-main><h2>Lommar askol te</h2><p>{_P}</p><p>{_Q} <a href=3>brind te</a></p><ol><li>{_S}</li><li>{_P}</li></ol><p>Kelm.</p></div>
    <div class="share-buttons"><a href=4>Darro</a> <a href=5>Vist</a></div><div class=promo><p>{_P}</p></div><div class="widget"><h3>Ake</h3><p>{_Q}</p></div><div class=copyright>2019 Hos</div></div>""",
    f"""<h1 data-main>Plurin ake wistem</h1><p data-main>{_P}<p data-main>{_Q}<p data-main>{_S}<p data-main>{_P}<hr><address><a href=1>Foral</a></address>""",
    f"""<header><div class=logo>Dende</div><nav><a href=1>Ruk</a></nav></header><main><div class=alert>{_P}</div><article data-main><header><h1>Teno vir askol</h1></header><figure><figcaption>Brind te lommar.</figcaption></figure><p>{_Q}</p><p>{_P}</p><p>{_S}</p></article>
    <aside><p>{_Q}</p></aside><section class="comment-list"><div><p>{_P}</p></div><div><p>{_Q}</p></div></section><section class=trending><h2>Sambel</h2><p><a href=2>{_S}</a></p></section></main><div role=dialog><p>{_P}</p></div><footer><ul><li><a href=3>Kam</a><li><a href=4>Oster</a></ul><p>{_S}</p></footer>""",
    f"""<body><nav><div>{_S}</div><p>Lindo veral</p></nav><div class="main-menu"><p>Maste</p><p>Kindor wen</p></div><div class="page-header"><p>{_S}</p></div><div class="article-body" data-main><h1>Tolam pirest an</h1><p>{_Q}</p><div>{_P}</div><div>Kelm.</div><p>{_P}</p></div>
    <div hidden><p>{_P}</p></div><div style="display:none"><p>{_Q}</p></div><ul class="menu"><li>An<li>Dolver sika</ul><div class="main-footer"><p>{_P}</p></div>""",
    f"""<main><article class="story"><h1 data-main>Sambel teno</h1><p data-main>{_P}<form><p>{_Q}</p><label>Ulta</label></form><p data-main>{_Q}<div class="ad"><p>{_P}</p></div><p data-main>{_S}<aside><p>{_Q}</p></aside><p data-main>{_P}<nav><p>{_S}</p></nav><p data-main>{_Q}<div class="notice">{_P}</div><p data-main>Kelm.
    <p data-main>{_P}</p><div hidden>{_S}</div><div class="comments"><p>{_P}</p></div><footer><p>{_P}</p></footer></article></main>""",
    f"""<div id="nav">{_S}</div><div class="site-notice"><p>{_Q}</p></div><div class="text" data-main><h1>Vir askol brind</h1>{_P}<br><br>{_Q}<h2>Te lommar</h2>{_P}<table><tr><th>Mande<th>Hos<tr><td>{_S}<td>7</table></div><div class="comments"><div>{_P}</div><div>{_S}</div></div><div class="sponsor">{_P}</div><div class="footer">{_Q}</div>""",
    f"""<main><article class="post"><header><h1 data-main>Ulta beshar</h1></header><div class="entry-content"><p data-main>{_Q}</p><div class="advertisement"><p>{_Q}</p></div><p data-main>{_P}</p><div class="related-posts"><p>{_S}</p></div><p data-main>{_S}</p><div class="newsletter-signup"><p>{_P}</p></div>
    <blockquote data-main>{_P}</blockquote><div class="site-notice"><p>{_Q}</p></div><p data-main>{_Q}</p><form><p>{_P}</p></form></div><div class="reader-comments"><p>{_P}</p><p>{_S}</p></div><aside><p>{_S}</p></aside><nav><p>{_Q}</p></nav><footer><p>{_S}</p></footer></article></main>""",
    f"""<table><tr><td><a href=1>Wistem</a></td><td><a href=2>Foral</a></td><td><a href=3>Dende ruk</a></td></tr></table><div data-main><h2>Brind te lommar</h2><p>{_P}</p><p>Ake.</p><p>{_Q}</p></div><p><a href=4>Vist</a> - <a href=5>Darro</a></p><p>&copy; Hos 2011. All rights reserved.</p>""",
]
