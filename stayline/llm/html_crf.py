"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: stretches of text between block-level tags, with the open elements around them. Each block has
features of its ancestors (tags; words of their class, id and role, what kind of surroundings such words name, whether one is hidden), of its text (length, link density,
punctuation, place on the page, a few telling words), of the element that groups it with others (words, links and sentences in all of them), and of its neighbours. A two-state chain says which blocks are main text: block scores and transition scores are
learned together from labelled pages by maximising the likelihood of their label sequences, and decoded by Viterbi.

Labelled pages are pairs of html and main text, a line per main block. ``labelled_pages`` writes a seeded set of them in
many layouts (semantic tags, class names only, names that tell nothing, tables, bare markup; articles with sidebars, notices, adverts, forms, comments and hidden text).

Character references are decoded, white space inside a block becomes one space (``br`` counts as white space), blocks are
trimmed, empty ones go, the rest stand in page order, one to a line. Scripts, styles, comments and the head never become blocks.
A head ends, with or without its end tag, where text or an element begins that cannot stand in one.
Malformed pages are read on a best-effort basis: an unfinished tag at the end is dropped, unclosed elements are closed by what follows.

Nulls: a null or empty html has the empty text; a null url is kept. Repeated rows come back repeated; an empty table gives no
rows. All columns of the pages are kept.
"""

from __future__ import annotations

import html as entities
import random
import re

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the elements of HTML that begin a new block, have no content, or hold no page text
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg math object audio video canvas".split())
# an element that ends when another of these opens (its own list items, cells and rows close one another)
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option", "optgroup"}}
# what may stand in a head; anything else that opens there, and text, ends it
HEAD = frozenset("head html base basefont bgsound link meta noframes noscript script style template title".split())
LISTS = frozenset(("ul", "ol", "dl", "table", "select", "menu"))
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|"
    r"<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<loose>[a-zA-Z][^\s/>]*)(?P<rest>[^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_SENTENCE = re.compile(r"[.!?…:;\"'”’)\]]$")
TELLING = frozenset(
    "cookie cookies subscribe newsletter share comment comments reply login privacy sponsored advertisement copyright menu search terms register password "
    "follow related policy rights reserved contact home about leave tags archives popular recent sponsor faq sitemap sign advertise says wrote weather posted".split()
)
# how a list of remarks or a single one begins
_REMARKS = re.compile(r"^(?:\d+ )?(?:reader )?(?:comments?|replies|responses)(?: ?\(\d+\))?:?$|^(?:leave|post|add|write) (?:a|your) (?:comment|reply)", re.I)
_BYLINE = re.compile(r"\b(?:says|wrote|said):?$|\bposted (?:by|on)\b|\b(?:minutes?|hours?|days?|weeks?|months?) ago\b", re.I)
_LEGAL = re.compile(r"©|\bcopyright\b|all rights reserved", re.I)
# elements that group blocks: all but those that hold one paragraph, heading, item or row
GROUPS = BLOCKS - frozenset("address blockquote caption center dd dt figcaption h1 h2 h3 h4 h5 h6 hr legend li option p pre summary tbody tfoot thead tr".split())


# What surrounds an article: tags that may hold it, words for its class or id, and the kind of text in it.
SURROUNDINGS = {
    "menu": (("nav", "div", "ul"), "nav navbar navigation menu topnav breadcrumb breadcrumbs toolbar tabs pagination pager sitemap submenu dropdown", "links"),
    "header": (("header", "div"), "header masthead site-header branding logo topbar banner page-header tagline", "short"),
    "footer": (("footer", "div"), "footer site-footer colophon copyright legal bottom imprint footer-links", "legal"),
    "sidebar": (("aside", "div"), "sidebar aside widget related recommended rail popular trending tags recent-posts more-stories side", "mixed"),
    "advert": (("div", "aside", "ins"), "ad ads advert advertisement sponsored promo adsbox sponsor banner-ad promotion adslot commercial", "prose"),
    "notice": (("div", "section", "dialog"), "cookie consent gdpr notice alert popup modal overlay newsletter subscribe paywall cookie-banner message warning", "prose"),
    "comments": (("div", "section", "ol"), "comments comment commentlist replies respond disqus discussion reader-comments comment-body responses feedback", "remarks"),
    "form": (("form", "div"), "form search login signup search-form contact-form register subscription-form", "form"),
    "share": (("div", "ul"), "share social sharing follow social-links share-buttons", "links"),
}
ARTICLES = "article post entry content story main article-body entry-content post-content story-body text page-content body-text"
# the words of those names by kind, but for words that articles use as well
_COMMON = frozenset(p.lower() for p in _PART.findall(ARTICLES)) | frozenset("site page bottom side more message body".split())
KINDS = {kind: frozenset(p.lower() for p in _PART.findall(names)) - _COMMON for kind, (_, names, _) in SURROUNDINGS.items()}


class Block:
    """Text pieces of one leaf block and what stands around it."""

    __slots__ = ("path", "pieces", "linked")

    def __init__(self, path: tuple):
        self.path, self.pieces, self.linked = path, [], 0


def _names(attrs: str) -> frozenset[str]:
    """Words of class, id and role; hidden elements get a word of their own."""
    found = set()
    for name, value in _NAMED.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            found.update(p.lower() for p in _PART.findall(value))
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            found.add("(hidden)")
    return frozenset(found)


def leaf_blocks(page: str) -> list[tuple[str, tuple, float]]:
    """Blocks of a page in order: text, path (tag and words of each open element), share of its characters inside links."""
    stack: list[tuple[str, frozenset]] = []
    links, blocks, current, at, end = 0, [], None, 0, len(page)
    none = frozenset()

    in_head = False

    def end_head() -> None:
        nonlocal links, in_head
        in_head = False
        tags = [tag for tag, _ in stack]
        if "head" in tags:
            del stack[tags.index("head") :]
            links = sum(s[0] == "a" for s in stack)

    def text(piece: str) -> None:
        nonlocal current
        if current is None:
            if not piece.strip():
                return
            if in_head:
                end_head()
            current = Block(tuple(stack))
            blocks.append(current)
        current.pieces.append(piece)
        if links:
            current.linked += len(piece)

    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        opened = m["start"] or m["loose"]
        if opened:
            tag = opened.lower()
            if in_head and tag not in HEAD:
                end_head()
            in_head = in_head or tag == "head"
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                attrs = m["attrs"] if m["start"] else m["rest"]
                at = at if attrs.endswith("/") and tag in ("svg", "math") else close.end() if close else end
                continue
            if tag == "br":
                if current is not None:
                    current.pieces.append(" ")
                continue
            if tag in BLOCKS:
                current = None
                for i in range(len(stack) - 1, -1, -1):
                    name = stack[i][0]
                    if name == "p" or tag in CLOSED_BY.get(name, ()):
                        del stack[i:]
                        break
                    if name in LISTS or name == "button":
                        break
                links = sum(s[0] == "a" for s in stack)
            if tag in VOID:
                continue
            attrs = m["attrs"] if m["start"] else m["rest"]
            stack.append((tag, _names(attrs) if attrs and not attrs.isspace() else none))
            links += tag == "a"
        elif m["end"]:
            tag = m["end"].lower()
            if tag in BLOCKS:
                current = None
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    links = sum(s[0] == "a" for s in stack)
                    break
    out = []
    for b in blocks:
        raw = "".join(b.pieces)
        whole = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
        if whole:
            out.append((whole, b.path, min(1.0, b.linked / max(1, len(raw)))))
    return out


def path_features(path: tuple) -> list[str]:
    found = {f"in:{tag}" for tag, _ in path}
    found.update(f"is:{w}" for _, names in path for w in names)
    named = [names for _, names in path if names]
    near, all_ = named[-1] if named else frozenset(), frozenset().union(*named)
    found.update(f"near:{w}" for w in near)
    # a list of known words lets a rare one count as much as its kind does
    found.update(f"kind:{kind}" for kind, known in KINDS.items() if all_ & known)
    found.update(f"near-kind:{kind}" for kind, known in KINDS.items() if near & known)
    own = [tag for tag, _ in path if tag in BLOCKS]
    found.add(f"tag:{own[-1] if own else ''}")
    found.add("site-header" if "in:header" in found and not found & {"in:article", "in:main"} else "no-site-header")
    return sorted(found)


def text_features(text: str, linked: float, place: int, total: int) -> list[str]:
    words = text.split()
    n = len(words)
    found = [
        f"words:{next((k for k in (1, 3, 6, 12, 25, 60) if n <= k), 99)}",
        f"linked:{0 if linked == 0 else 1 if linked < 0.4 else 2 if linked < 0.8 else 3}",
        f"ends:{bool(_SENTENCE.search(text))}",
        f"place:{5 * place // total}",
    ]
    if place == 0:
        found.append("first")
    if place == total - 1:
        found.append("last")
    if "©" in text:
        found.append("mark")
    if n <= 40:
        found += [f"says:{w}" for w in {w.strip(".,:;!?()").lower() for w in words} & TELLING]
    return found


def _step(value: float, *steps: float) -> int:
    return sum(value > s for s in steps)


def surrounding_features(blocks: list[tuple[str, tuple, float]]) -> list[list[str]]:
    """For each block of a page: features of the element that groups it with others, and of the blocks next to it."""
    # each element's entry in the paths is an object of its own
    groups = [next((id(e) for e in reversed(path) if e[0] in GROUPS), 0) for _, path, _ in blocks]
    sizes = [text.count(" ") + 1 for text, _, _ in blocks]
    total: dict[int, list[float]] = {}
    for g, n, (text, _, linked) in zip(groups, sizes, blocks):
        t = total.setdefault(g, [0, 0, 0, 0])
        t[0] += n
        t[1] += n * linked
        t[2] += n if n > 4 and _SENTENCE.search(text) else 0
        t[3] += 1
    largest = max((t[2] for t in total.values()), default=0)
    best = max(total, key=lambda g: total[g][2], default=0) if largest else None
    inside = [i for i, g in enumerate(groups) if g == best]
    first, last = (inside[0], inside[-1]) if inside else (0, len(blocks))
    look = [f"{_step(n, 2, 6, 20)}{_step(k, 0, 0.6)}" for n, (_, _, k) in zip(sizes, blocks)]
    out, below = [], False
    for i, (g, (text, _, _)) in enumerate(zip(groups, blocks)):
        words, linked, sentences, n = total[g]
        found = [
            f"group-links:{_step(linked / words, 0, 0.2, 0.6)}", f"group-prose:{_step(sentences / words, 0, 0.4, 0.8)}:{_step(words, 6, 25, 100)}", f"group-blocks:{_step(n, 1, 3, 9)}",
            f"largest:{'in' if g == best else 'before' if i < first else 'after' if i > last else 'between'}:{_step(sentences, 0, 25)}",
            f"group-share:{_step(sentences / largest if largest else 0, 0, 0.3, 0.99)}",
            f"before:{look[i - 1] if i else ''}", f"after:{look[i + 1] if i + 1 < len(look) else ''}",
        ]
        if sizes[i] <= 14 and _LEGAL.search(text):
            found += ["legal", f"legal-left:{_step(len(blocks) - i, 1, 3)}"]
        if sizes[i] <= 8 and _REMARKS.search(text):
            below = True
        if below:
            found.append("below-remarks")
        if sizes[i] <= 12 and _BYLINE.search(text):
            found.append("byline")
        if i and sizes[i - 1] <= 12 and _BYLINE.search(blocks[i - 1][0]):
            found.append("after-byline")
        out.append(found)
    return out


def _pages_of(labelled: list[tuple[str, str]]) -> list[tuple[list[list[str]], list[int]]]:
    pages = []
    for page, main in labelled:
        lines, blocks = set(main.split("\n")), leaf_blocks(page)
        if blocks:
            pages.append((
                [path_features(p) + text_features(t, k, i, len(blocks)) + near for i, ((t, p, k), near) in enumerate(zip(blocks, surrounding_features(blocks)))],
                # an unclosed paragraph may run on into what follows it
                [int(t in lines or any(len(x) > 20 and t.startswith(x) for x in lines)) for t, _, _ in blocks],
            ))
    return pages


def fit(labelled: list[tuple[str, str]], rounds: int = 250, penalty: float = 3e-5, rate: float = 0.5) -> dict:
    """Weights of a two-state chain: ``features`` (score of main text over the rest), ``moves`` and ``ends`` (first and last state)."""
    pages = _pages_of(labelled)
    number: dict[str, int] = {}
    block_of, feature_of, shape = [], [], (len(pages), max(len(y) for _, y in pages))
    truth, mask = np.zeros(shape, np.int64), np.zeros(shape, bool)
    for i, (blocks, y) in enumerate(pages):
        truth[i, : len(y)], mask[i, : len(y)] = y, True
        for j, names in enumerate(blocks):
            for name in names:
                block_of.append(i * shape[1] + j)
                feature_of.append(number.setdefault(name, len(number)))
    block_of, feature_of = np.array(block_of), np.array(feature_of)
    lengths = mask.sum(axis=1)
    last = lengths - 1
    every = np.arange(shape[0])
    # observed counts
    seen_moves = np.zeros((2, 2))
    for t in range(1, shape[1]):
        np.add.at(seen_moves, (truth[mask[:, t], t - 1], truth[mask[:, t], t]), 1)
    seen_ends = np.stack([np.bincount(truth[:, 0], minlength=2), np.bincount(truth[every, last], minlength=2)]).astype(float)
    w, moves, ends = np.zeros(len(number)), np.zeros((2, 2)), np.zeros((2, 2))
    sums = [np.zeros_like(w), np.zeros_like(moves), np.zeros_like(ends)]
    for _ in range(rounds):
        node = np.zeros((*shape, 2))
        node[..., 1] = np.bincount(block_of, w[feature_of], minlength=shape[0] * shape[1]).reshape(shape)
        node[:, 0] += ends[0]
        node[every, last] += ends[1]
        forward, backward = node.copy(), np.zeros_like(node)
        for t in range(1, shape[1]):
            forward[:, t] += np.logaddexp(forward[:, t - 1, 0, None] + moves[0], forward[:, t - 1, 1, None] + moves[1])
        for t in range(shape[1] - 2, -1, -1):
            after = node[:, t + 1] + backward[:, t + 1]
            step = np.logaddexp(moves[None, :, 0] + after[:, 0, None], moves[None, :, 1] + after[:, 1, None])
            backward[:, t] = np.where(mask[:, t + 1, None], step, 0)
        whole = np.logaddexp(forward[every, last, 0], forward[every, last, 1])
        state = np.exp(forward + backward - whole[:, None, None]) * mask[..., None]
        expected = np.zeros((2, 2))
        for t in range(1, shape[1]):
            pair = forward[:, t - 1, :, None] + moves + (node[:, t] + backward[:, t])[:, None, :] - whole[:, None, None]
            expected += np.exp(pair[mask[:, t]]).sum(axis=0)
        slope = [
            np.bincount(feature_of, (truth - state[..., 1]).reshape(-1)[block_of], minlength=len(w)) - penalty * len(pages) * w,
            seen_moves - expected, seen_ends - np.stack([state[:, 0].sum(axis=0), state[every, last].sum(axis=0)]),
        ]
        for value, g, s in zip((w, moves, ends), slope, sums):
            s += g * g
            value += rate * g / np.sqrt(s + 1e-8)
    return {"features": dict(zip(number, w.tolist())), "moves": moves.tolist(), "ends": ends.tolist()}


def decode(scores: list[float], moves: list[list[float]], ends: list[list[float]]) -> list[int]:
    """The best state sequence (Viterbi)."""
    if not scores:
        return []
    stay, go = ends[0][0], ends[0][1] + scores[0]
    back = []
    for s in scores[1:]:
        a, b = stay + moves[0][0], go + moves[1][0]
        c, d = stay + moves[0][1], go + moves[1][1]
        back.append((int(b > a), int(d >= c)))
        stay, go = max(a, b), max(c, d) + s
    state = int(go + ends[1][1] >= stay + ends[1][0])
    path = [state]
    for choice in reversed(back):
        state = choice[state]
        path.append(state)
    return path[::-1]


def main_text(page: str | None, model: dict, known: dict | None = None) -> str:
    """The main text of a page; ``known`` keeps scores of paths from page to page."""
    if not page:
        return ""
    weights, known = model["features"], {} if known is None else known
    blocks, scores = leaf_blocks(page), []
    for i, ((text, path, linked), near) in enumerate(zip(blocks, surrounding_features(blocks))):
        base = known.get(path)
        if base is None:
            if len(known) > 20_000:
                known.clear()
            base = known[path] = sum(weights.get(f, 0.0) for f in path_features(path))
        scores.append(base + sum(weights.get(f, 0.0) for f in text_features(text, linked, i, len(blocks)) + near))
    return "\n".join(b[0] for b, keep in zip(blocks, decode(scores, model["moves"], model["ends"])) if keep)


def _extractor(model: Broadcast):
    def extract_(pages: pa.Array) -> pa.Array:
        known: dict = {}
        return pa.array([main_text(p, model.value, known) for p in pages.to_pylist()], pa.string())

    return F.arrow_udf(extract_, "string").asNondeterministic()


def extract(pages: DataFrame, model: dict | None = None) -> DataFrame:
    """All columns of ``pages`` and the main ``text`` of their ``html``."""
    model = model or fit(labelled_pages())
    return pages.withColumn("text", _extractor(pages.sparkSession.sparkContext.broadcast(model))(F.col("html").cast("string")))


def labelled_pages(n: int = 1400, seed: int = 1) -> list[tuple[str, str]]:
    """Seeded pages in many layouts, each with its main text."""
    draw = random.Random(seed)
    syllables = [a + b for a in "b d f g k l m n p r s t v".split() for b in "a e i o u an er is on".split()]

    def word() -> str:
        return "".join(draw.choice(syllables) for _ in range(draw.choice((1, 1, 2, 2, 3))))

    def sentence(most: int = 14) -> str:
        s = " ".join(word() for _ in range(draw.randint(1, most)))
        return s.capitalize() + draw.choice(("...", ".", ".", ".", "?", "!"))

    def prose(most: int = 6) -> str:
        return " ".join(sentence() for _ in range(draw.randint(1, most)))

    def phrase(most: int = 3) -> str:
        return " ".join(word() for _ in range(draw.randint(1, most))).capitalize()

    def inside(kind: str) -> str:
        if kind == "links":
            return "<ul>" + "".join(f'<li><a href="/{word()}">{phrase()}</a></li>' for _ in range(draw.randint(2, 7))) + "</ul>" if draw.random() < 0.7 else " ".join(f'<a href="/{word()}">{phrase()}</a>' for _ in range(draw.randint(2, 7)))
        if kind == "short":
            return draw.choice((f"<h1>{phrase()}</h1><p>{phrase(6)}</p>", f"<a href='/'>{phrase()}</a>", f"<h2>{phrase()}</h2>", f"<p>{prose(1)}</p>"))
        if kind == "legal":
            return draw.choice((f"&copy; {phrase()} &middot; {phrase()}", f"<p>Copyright {draw.randint(1999, 2024)} {phrase()}. All rights reserved.</p>", f"<p>{prose(2)}</p>", inside("links"), f"<p>{phrase()}</p>{inside('links')}"))
        if kind == "mixed":
            return draw.choice((f"<h3>{phrase()}</h3>{inside('links')}", f"<h4>{phrase()}</h4><p>{prose(2)}</p>", f"<p>{prose(3)}</p>", inside("links")))
        if kind == "remarks":
            return draw.choice(("", f"<h3>{phrase()}</h3>")) + "".join(f'<{t} class="{draw.choice(("comment", "reply", "item", "body"))}"><p>{prose(3)}</p></{t}>' for t in draw.choices(("div", "li", "article"), k=draw.randint(1, 4)))
        if kind == "form":
            return f"<label>{phrase()}</label><input name='q'><button>{phrase(1)}</button>" + draw.choice(("", f"<p>{prose(1)}</p>", f"<select><option>{word()}</option><option>{word()}</option></select>"))
        return draw.choice((prose(2), f"<p>{prose(3)}</p>", f"<p>{phrase(5)}</p>", f"<p>{prose(2)}</p><a href='/x'>{phrase()}</a>"))

    def around(name: str, plain: bool) -> str:
        tags, names, kind = SURROUNDINGS[name]
        tag = draw.choice(tags)
        if plain:
            return f"<{tags[0]}>{inside(kind)}</{tags[0]}>"
        own = draw.sample(names.split(), draw.choice((1, 1, 2)))
        return f'<{tag} {draw.choice(("class", "class", "id"))}="{" ".join(own)}">{inside(kind)}</{tag}>'

    def wording(name: str) -> str:
        """What surrounds an article, in words only."""
        site = phrase(2)
        link = lambda t: f'<a href="/{word()}">{t}</a>'
        if name == "menu":
            items = draw.sample(("Home", "About", "Contact", "Archives", "FAQ", "Sign in", "Search", "News", phrase(2), phrase(1), phrase(2)), draw.randint(2, 6))
            return draw.choice((" | ".join(map(link, items)), " | ".join(items), "<br>".join(map(link, items)), "<ul>" + "".join(f"<li>{link(i)}</li>" for i in items) + "</ul>", " &raquo; ".join(map(link, items))))
        if name == "header":
            return draw.choice((site, f"<b>{site}</b>", link(site), f"<font size=5>{site}</font><br><i>{phrase(4)}</i>", f"<h3>{site}</h3>"))
        if name == "footer":
            return draw.choice((f"&copy; {draw.randint(1996, 2024)} {site}", f"Copyright {draw.randint(1996, 2024)} {site}. All rights reserved.", " | ".join(map(link, ("Privacy policy", "Terms", "Contact"))), f"{link('Sitemap')} {link('Advertise')}"))
        if name == "sidebar":
            head = draw.choice(("Related stories", "Recent posts", "Popular", "Weather", "Tags", "Archives", phrase(2)))
            return f"<{(t := draw.choice(('h3', 'h4', 'b', 'p', 'div')))}>{head}</{t}>" + draw.choice(("<ul>" + "".join(f"<li>{link(phrase(5))}</li>" for _ in range(draw.randint(2, 5))) + "</ul>", f"<p>{phrase(6)}</p>", f"<p>{prose(1)}</p>", "".join(f"<div>{link(phrase(4))}</div>" for _ in range(draw.randint(2, 5)))))
        if name == "notice":
            return draw.choice(("<p>We use cookies to {}.</p>", "<h4>Newsletter</h4><p>Subscribe to {}.</p>", "<p>Sign up for our newsletter: {}</p>", "<p>Subscribe today and {}!</p>")).format(phrase(5).lower())
        if name == "advert":
            return draw.choice((f"<p>Advertisement</p><p>{prose(1)}</p>", f"Sponsored: {link(phrase(5))}", f"<p>Sponsored</p><p>{link(sentence(8))}</p>"))
        if name == "share":
            return draw.choice((f"Share this: {link(word())} {link(word())}", f"<p>{link('Share')} {link('Follow')}</p>"))
        if name == "form":
            return f"<form><label>{draw.choice(('Search', 'Login', 'Password', phrase(2)))}</label><input name=q><button>{phrase(1)}</button></form>"
        head = draw.choice(("Comments", f"{draw.randint(1, 40)} comments", "Leave a comment", "Responses", "Comments", f"{draw.randint(2, 9)} replies"))
        tag = draw.choice(("div", "p", "li"))
        who = lambda: draw.choice((f"<b>{phrase(1)}</b> says:", f"{phrase(2)} wrote:", f"Posted by {phrase(1)}", f"{phrase(1)}, {draw.randint(2, 20)} days ago", ""))
        each = "".join(f"<{tag}>{by}</{tag}>" * bool(by) + f"<{tag}>{text}</{tag}>" for by, text in ((who(), draw.choice((prose(2), phrase(4), sentence(6)))) for _ in range(draw.randint(1, 5))))
        return f"<{(t := draw.choice(('h3', 'div', 'p', 'b')))}>{head}</{t}>{each}"

    def unmarked(body: str) -> str:
        """A page whose markup names nothing: tables, bare elements, or classes that say nothing."""
        before = draw.sample(("header", "menu", "notice", "advert", "form"), draw.randint(0, 3))
        after = draw.sample(("sidebar", "comments", "footer", "share", "advert", "notice", "menu"), draw.randint(0, 4))
        if "footer" in after:
            after.append(after.pop(after.index("footer")))
        form = draw.random()
        if form < 0.3:
            columns = [f"<td>{wording(b)}</td>" for b in draw.sample(("menu", "sidebar", "advert"), draw.randint(0, 2))]
            columns.insert(draw.randint(0, len(columns)), f"<td>{body}{''.join(map(wording, [a for a in after if a in ('comments', 'share')]))}</td>")
            rows = [f"<tr><td>{wording(b)}</td></tr>" for b in before] + [f"<tr>{''.join(columns)}</tr>"] + [f"<tr><td>{wording(a)}</td></tr>" for a in after if a == "footer"]
            return f'<table width="100%">{"".join(rows)}</table>'
        tag = draw.choice(("div", "div", "section", "p") if form < 0.65 else ("div",))
        own = (lambda: "") if form < 0.65 else lambda: f' class="{word()}{draw.choice(("", "-" + word(), str(draw.randint(1, 9))))}"'
        wrap = lambda b: f"<{tag}{own()}>{b}</{tag}>"
        return "".join(wrap(wording(b)) for b in before) + draw.choice((f"<div{own()}>{body}</div>", f"<div{own()}>{body}</div>", body)) + "".join(wrap(wording(a)) for a in after)

    def hidden() -> str:
        return f"<{(t := draw.choice(('p', 'div', 'section')))} {draw.choice(('hidden', 'style=\"display: none\"', 'style=\"display:none\"', 'aria-hidden=true'))}>{draw.choice((prose(3), f'<p>{prose(2)}</p>', phrase(4)))}</{t}>"

    def article() -> tuple[str, list[str]]:
        lines, out = [], []

        def add(markup: str, *texts: str) -> None:
            out.append(markup)
            lines.extend(texts)

        if draw.random() < 0.85:
            title = draw.choice((phrase(6), sentence()))
            add(draw.choice((f"<h1>{title}</h1>", f"<h1>{title}</h1>", f"<h2>{title}</h2>", f"<header><h1>{title}</h1></header>")), title)
        for _ in range(draw.choice((1, 1, 2, 3, 4, 6, 9, 14))):
            k = draw.random()
            if draw.random() < 0.08:
                # telling words occur in articles as well
                p = " ".join(draw.choice((word(), draw.choice(sorted(TELLING)))) for _ in range(draw.randint(2, 9))).capitalize() + "."
                p = draw.choice((p, p, "All rights reserved.", f"Copyright {draw.randint(1990, 2024)} {phrase()}."))
                add(f"<p>{p}</p>", p)
            elif k < 0.72:
                p = draw.choice((prose, lambda: prose(14), lambda: sentence(3), lambda: " ".join(word() for _ in range(draw.randint(8, 150)))))()
                add(draw.choice((f"<p>{p}</p>", f"<p>{p}</p>", f"<p>{p}", f"<p><b>{p}<br>", f"<div><p>{p}</p></div>")), p)
            elif k < 0.8:
                h = phrase(5)
                add(f"<h2>{h}</h2>", h)
            elif k < 0.88:
                items = [draw.choice((phrase(5), sentence())) for _ in range(draw.randint(1, 4))]
                add("<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>", *items)
            elif k < 0.92:
                q = prose(2)
                add(f"<blockquote><p>{q}</p></blockquote>", q)
            elif k < 0.95:
                a, b = sentence(6), phrase(2)
                add(f"<p>{a} <a href='/y'>{b}</a></p>", f"{a} {b}")
            elif k < 0.97:
                cells = [phrase(2) for _ in range(4)]
                add("<table><tr><td>{}</td><td>{}</td></tr><tr><td>{}</td><td>{}</td></tr></table>".format(*cells), *cells)
            else:
                c = f"{word()} = {word()}({draw.randint(0, 9)})"
                add(f"<pre>{c}</pre>", c)
            if draw.random() < 0.12:
                name = draw.choice(("advert", "share", "notice", "form", "sidebar", "comments"))
                out.append(around(name, name in ("form", "sidebar") and draw.random() < 0.5))
            if draw.random() < 0.04:
                out.append(hidden())
            if draw.random() < 0.03:
                out.append(f"<aside>{wording(draw.choice(('notice', 'sidebar', 'advert')))}</aside>")
        if draw.random() < 0.2:
            out.append(around(draw.choice(("comments", "comments", "sidebar", "share", "form", "footer")), False))
        return "".join(out), lines

    pages = []
    for _ in range(n):
        body, lines = article()
        if draw.random() < 0.35:
            pages.append((f"<html><head><title>{phrase()}</title></head><body>{unmarked(body)}</body></html>", "\n".join(lines)))
            continue
        style = draw.random()
        if style < 0.45:
            wrapped = draw.choice(("<article>{}</article>", "<main><article>{}</article></main>", "<main>{}</main>")).format(body)
        elif style < 0.85:
            wrapped = f'<div class="{" ".join(draw.sample(ARTICLES.split(), draw.choice((1, 2))))}">{body}</div>'
        else:
            wrapped = draw.choice(("{}", "<div>{}</div>", "<section>{}</section>")).format(body)
        bare = draw.random()
        before = [] if bare < 0.1 else draw.sample(("menu", "header", "notice", "advert", "form", "share"), draw.randint(0, 4))
        after = [] if bare < 0.1 else draw.sample(("footer", "sidebar", "comments", "advert", "notice", "form", "share", "menu"), draw.randint(0, 5))
        if "comments" not in after and bare >= 0.1 and draw.random() < 0.3:
            after.insert(0, "comments")
        plain = draw.random() < 0.15
        of = lambda name: around(name, plain and name in ("menu", "header", "footer", "sidebar", "form"))
        page = "".join(map(of, before)) + wrapped + "".join(map(of, after))
        if draw.random() < 0.3:
            page = f'<div class="{draw.choice(("wrapper", "container", "page", "site", "row"))}">{page}</div>'
        if draw.random() < 0.03:
            # no markup, or hardly any
            plain_text = draw.choice((prose(), phrase(4)))
            pages.append((draw.choice(("{}", "<p>{}", "<body>{}</body>", "<div>{}</div>")).format(plain_text), plain_text))
            continue
        pages.append((f"<html><head><title>{phrase()}</title></head><body>{page}</body></html>", "\n".join(lines)))
    return pages
