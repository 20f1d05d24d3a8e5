"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element that is not plainly inline is a node with two states, content and boilerplate. A node's potential is the likelihood of
what is seen there (tag, hints in its names, length, links, sentences), and a potential on each edge ties a child's state to its parent's. Sum-product
messages pass from the leaves to the root and back, which gives the marginal of each node exactly. The potentials are the
smoothed frequencies in labelled pages; labelled_pages() makes such pages, and other labelled pages can be given.
"""

from __future__ import annotations

import html
import math
import random
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import with_texts

# Kinds of elements in the language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An element that begins ends an open one of these kinds, unless one of the second kinds lies between.
ENDS = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
    "th": ("td th", "tr table"), "option": ("option", "select"), "thead": ("tr td th", "table"), "tbody": ("thead tbody tr td th", "table"), "tfoot": ("tbody tr td th", "table"),
}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
NEVER = frozenset("script style noscript template svg math select option button textarea head title iframe object canvas video audio map datalist".split())
BARRIERS = frozenset("table td th caption button template html body".split())
# Words in names of classes, ids and roles, by what they speak for.
HINTS = {
    "advert": "ad ads adv advert advertisement advertising adsense banner promo promoted sponsor sponsored sponsors dfp doubleclick outbrain taboola",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar toolbar tabs pager pagination sitemap skip",
    "frame": "header masthead footer foot bottom colophon copyright legal banner contentinfo",
    "side": "sidebar side aside widget widgets related recommended recommendations trending popular complementary more teaser teasers",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay paywall newsletter subscribe subscription signup disclaimer toast",
    "form": "form search login signin register contact",
    "comment": "comment comments commentary disqus reply replies respond discussion reaction reactions",
    "share": "share sharing social tags tag meta byline toolbox print hidden",
    "main": "article content main post entry story body text maincontent articlebody blogpost prose",
}
HINTS = {word: kind for kind, words in reversed(HINTS.items()) for word in words.split()}
# Names that the made-up pages give their elements, in the manner of templates in several languages; the words in them are learnt from.
NAMES = {
    "menu": "site-nav main-menu top_links burger-drawer crumbs utility-links navi hauptmenue menu-principal barra-navegacion jump-links primaryTabs",
    "frame": "site-head topline brandbar page-header kopfzeile entete cabecera site-footer bottom-bar fusszeile pied-page imprint legal-lines pie-pagina",
    "side": "sidebar col-right rail related-posts seitenleiste weitere-artikel lire-aussi barra-lateral relacionados most-read popular-now teaserList",
    "advert": "ad-slot ad banner-top promo-box sponsored-links werbung anzeige publicite annonce publicidad patrocinado partner-offers",
    "notice": "cookie-bar consent-layer newsletter-box hinweis-leiste gdpr-note abo-hinweis avis-cookies inscription-lettre aviso-legal paywall-note modal-window alertBox",
    "form": "search-form login-box suchfeld kontaktformular recherche formulaire buscador registro contact-panel feedback-form",
    "comment": "comment-list comments reader-replies kommentare leserbriefe commentaires comentarios opiniones discussion-thread post-comments respond",
    "share": "share-buttons social-links tags-line teilen partager compartir byline-meta print-tools follow-us hidden-note",
    "main": "article-body entry-content post-text story-main artikel-inhalt beitrag corps-article contenu-principal cuerpo-noticia contenido main-column textblock",
}
NAMES = {kind: tuple(names.split()) for kind, names in NAMES.items()}
LEAST_LOG = -200.0  # of a likelihood against that of the other state
LEAST_SEEN = 5  # a word of names is learnt from so many nodes on

OPEN_QUOTES = 20  # tags of a page whose quotes are looked for to the end of the page in vain; from then on a tag ends at the next >
_OPENS = re.compile(r"""<(/?)([a-zA-Z][^\s/>"'<]*)""")
_STOPS = re.compile("[\"'>]")
_COMMENT_ENDS = re.compile("--!?>")
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SENTENCE = re.compile(r"[.!?;:,。！？؟…][\s\"'»”)]|[.!?。！？؟…]$")


@dataclass
class Node:
    tag: str
    parent: int
    hint: str
    inline: bool
    words: tuple = ()  # of its names
    parts: list = field(default_factory=list)  # its texts, and the numbers of its children, in page order
    children: list = field(default_factory=list)
    linked: int = 0


def hint_of(attributes: str) -> str:
    """What the names of an element speak for; the last word of a name that says anything decides, as in post-comments."""
    if _HIDDEN.search(attributes):
        return "share"
    found = "none"
    for value in _NAMES.findall(attributes):
        for name in value.strip("\"'").split():
            for word in _WORDS.findall(name):
                kind = HINTS.get(word.lower())
                if kind and (found in ("none", "main") or kind != "main"):
                    found = kind
    return found


def words_of(attributes: str) -> tuple:
    """The words in an element's names, each once, in lower case."""
    return tuple(sorted({w.lower() for value in _NAMES.findall(attributes) for w in _WORDS.findall(value)}))


class Tags:
    """The tags and comments of a page, one after the other; each place of the page is looked at a bounded number of times."""

    def __init__(self, page: str) -> None:
        self.page, self.last, self.vain = page, page.rfind(">"), 0

    def end_of(self, at: int) -> int:
        """Where a tag ends whose name ends there: behind the first > outside quotes, or if quotes stay open behind the first one."""
        page, i = self.page, at
        while self.vain < OPEN_QUOTES:
            stop = _STOPS.search(page, i)
            if stop and stop[0] == ">":
                return stop.end()
            i = page.find(stop[0], stop.end()) + 1 if stop else 0
            if not i:
                self.vain += 1
                break
        return page.find(">", at) + 1

    def after(self, at: int) -> tuple[int, int, str, str, bool] | None:
        """(start, end, name, attributes, closing) of the next tag; the name of what is none (comments, declarations) is empty."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if start > self.last:  # nothing but an open comment can follow
                start = page.find("<!--", start)
                return (start, len(page), "", "", False) if start >= 0 else None
            if page.startswith("<!--", start):
                end = _COMMENT_ENDS.search(page, start + 4)
                return start, end.end() if end else len(page), "", "", False
            if m := _OPENS.match(page, start):
                end = self.end_of(m.end())
                return start, end, m[2].lower(), page[m.end() : end - 1], bool(m[1])
            if page[start + 1 : start + 2] in ("!", "?", "/"):
                return start, page.find(">", start) + 1, "", "", False
            at = start + 1
        return None


class Open:
    """The open elements, with the places of those that end tags and new elements look for, so that a deep page costs no more for each tag."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = [("#root", 0)]  # names and nodes; inline elements share the node of what holds them
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = [0]  # not inline
        self.barriers: list[int] = []
        self.headings: list[int] = []
        self.links = 0

    @property
    def node(self) -> int:
        return self.stack[-1][1]

    def kinds(self, tag: str) -> list[list[int]]:
        more = [self.blocks] if tag not in INLINE else []
        more += [self.barriers] if tag in BARRIERS else []
        return [self.places.setdefault(tag, []), *more, *([self.headings] if tag in HEADINGS else [])]

    def push(self, tag: str, node: int) -> None:
        for places in self.kinds(tag):
            places.append(len(self.stack))
        self.stack.append((tag, node))
        self.links += tag == "a"

    def pop(self, to: int) -> None:
        while len(self.stack) > to:
            tag, _ = self.stack.pop()
            for places in self.kinds(tag):
                places.pop()
            self.links -= tag == "a"

    def close(self, tag: str) -> None:
        """Ends the last open element of the name (of headings, any), unless a block for an inline one, or a barrier for another, lies above it."""
        places = self.headings if tag in HEADINGS else self.places.get(tag)
        if not places:
            return
        at = places[-1]
        hidden = tag in INLINE and self.blocks[-1] > at or tag not in BARRIERS and tag not in ("tr", "tbody", "thead", "tfoot") and self.barriers and self.barriers[-1] > at
        if not hidden:
            self.pop(at)

    def before(self, tag: str) -> None:
        """Ends what an element of the name ends when it begins."""
        if tag in CLOSES_P and self.stack[self.blocks[-1]][0] == "p":
            self.pop(self.blocks[-1])
        if tag in ENDS:
            ends, barriers = ENDS[tag]
            low = max((p[-1] for b in barriers if (p := self.places.get(b))), default=0)
            found = [p[i] for e in ends if (p := self.places.get(e)) and (i := bisect_right(p, low)) < len(p)]
            if found:
                self.pop(min(found))


def parse(page: str) -> list[Node]:
    """The nodes, each after its parent; the first is the root. Broken markup is mended as browsers do in the common cases."""
    nodes = [Node("#root", -1, "none", False)]
    tags, opened = Tags(page), Open()
    at = 0

    def text(raw: str) -> None:
        if raw:
            node = nodes[opened.node]
            value = html.unescape(raw) if "&" in raw else raw
            node.parts.append(value)
            if opened.links:
                node.linked += len(value.strip())

    while found := tags.after(at):  # from the end of the last tag or raw text, so that nothing inside a script opens a tag
        start, end, tag, attributes, closing = found
        text(page[at:start])
        at = end
        if not tag:
            continue
        if closing:
            if tag == "br":
                nodes[opened.node].parts.append(" ")
            opened.close(tag)
            continue
        opened.before(tag)
        if tag in ("html", "body") and opened.places.get(tag):
            continue
        holder = opened.node
        if tag in VOID:
            nodes[holder].parts.append(" " if tag in INLINE else None)
            continue
        hint = hint_of(attributes) if attributes else "none"
        inline = tag in INLINE
        if inline and hint in ("none", "main", "menu", "frame"):
            number = holder
        else:
            number = len(nodes)
            nodes.append(Node(tag, holder, hint, inline, words_of(attributes) if attributes else ()))
            nodes[holder].parts.append(number)
            nodes[holder].children.append(number)
        if tag in RAW:
            ended = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = ended.start() if ended else len(page)
            if not ended:
                break
        opened.push(tag, number)
    if at < len(page):
        text(page[at:])
    return nodes


def bucket(value: float, cuts: tuple) -> int:
    return sum(value >= c for c in cuts)


def features(nodes: list[Node]) -> list[tuple]:
    """What is seen at each node."""
    out = []
    linked, total = [0] * len(nodes), [0] * len(nodes)
    own = []
    for node in nodes:
        words = " ".join(p for p in node.parts if isinstance(p, str)).split()
        own.append(" ".join(words))
    for k in range(len(nodes) - 1, -1, -1):
        total[k] += len(own[k])
        linked[k] += min(nodes[k].linked, len(own[k]))
        if k:
            total[nodes[k].parent] += total[k]
            linked[nodes[k].parent] += linked[k]
    for k, node in enumerate(nodes):
        share = linked[k] / total[k] if total[k] else -1
        out.append((
            ("tag", node.tag), ("hint", node.hint), ("own", bucket(len(own[k]), (1, 25, 80, 200))),
            ("links", node.tag, bucket(share, (0, 0.2, 0.6))), ("sentence", 2 if not own[k] else int(bool(_SENTENCE.search(own[k])))),
            *[("name", w) for w in node.words],
        ))
    return out


@dataclass
class Model:
    """Likelihoods of what is seen under (boilerplate, content), and of a child's state under its parent's."""

    seen: dict
    unseen: dict
    edge: tuple
    root: tuple

    def potential(self, seen: tuple) -> tuple[float, float]:
        """The likelihoods of what is seen, over the larger one: an element may have any number of names."""
        a = b = 0.0
        for x in seen:
            p, q = self.seen.get(x) or self.unseen[x[0]]
            a, b = a + math.log(p), b + math.log(q)
        top = max(a, b)
        return math.exp(max(a - top, LEAST_LOG)), math.exp(max(b - top, LEAST_LOG))

    def marginals(self, nodes: list[Node], seen: list[tuple]) -> list[float]:
        """The probability that each node is content."""
        n = len(nodes)
        (t00, t01), (t10, t11) = self.edge
        up = [self.potential(s) for s in seen]
        sent: list = [None] * n
        for k in range(n - 1, 0, -1):  # children come after their parents
            a, b = up[k]
            m0, m1 = t00 * a + t01 * b, t10 * a + t11 * b
            s = m0 + m1
            m0, m1 = m0 / s, m1 / s
            sent[k] = (m0, m1)
            j = nodes[k].parent
            p, q = up[j]
            p, q = p * m0, q * m1
            s = p + q
            up[j] = (p / s, q / s)
        down = [self.root] * n
        out = [0.0] * n
        for k in range(n):
            if k:
                j = nodes[k].parent
                # what the parent knows without this child
                p, q = up[j][0] * down[j][0] / sent[k][0], up[j][1] * down[j][1] / sent[k][1]
                d0, d1 = p * t00 + q * t10, p * t01 + q * t11
                s = d0 + d1
                down[k] = (d0 / s, d1 / s)
            a, b = up[k][0] * down[k][0], up[k][1] * down[k][1]
            out[k] = b / (a + b)
        return out


def train(pages: Iterable[tuple[str, set[str]]], smoothing: float = 0.5) -> Model:
    """From (page, its content's block texts): a node is content if it or a node below it holds such a block."""
    counts, totals, edges = Counter(), Counter(), Counter()
    values: dict[str, set] = {}
    for page, wanted in pages:
        nodes = parse(page)
        state = [any(" ".join("".join(run).split()) in wanted for run in runs(n.parts)) for n in nodes]
        for k in range(len(nodes) - 1, 0, -1):
            state[nodes[k].parent] |= state[k]
        for k, seen in enumerate(features(nodes)):
            totals[state[k]] += 1
            for x in seen:
                counts[x, state[k]] += 1
                values.setdefault(x[0], set()).add(x)
            if k:
                edges[state[nodes[k].parent], state[k]] += 1
    if "name" in values:
        values["name"] = {x for x in values["name"] if counts[x, False] + counts[x, True] >= LEAST_SEEN}
    of = lambda x, s, kinds: (counts[x, s] + smoothing) / (totals[s] + smoothing * (kinds + 1))
    seen = {x: (of(x, False, len(v)), of(x, True, len(v))) for v in values.values() for x in v}
    unseen = {name: (1.0, 1.0) for name in (*values, "name")}
    row = lambda s: tuple((edges[s, t] + smoothing) / (edges[s, False] + edges[s, True] + 2 * smoothing) for t in (False, True))
    return Model(seen, unseen, (row(False), row(True)), (0.5, 0.5))


def runs(parts: list) -> list[list[str]]:
    """The texts of a node between its children."""
    out: list[list[str]] = [[]]
    for p in parts:
        if isinstance(p, str):
            out[-1].append(p)
        else:
            out.append([])
    return [r for r in out if r]


def labelled_pages(count: int = 400, seed: int = 5, names: dict[str, tuple[str, ...]] = NAMES) -> list[tuple[str, set[str]]]:
    """Made-up pages with known content: templates of many kinds whose elements have these names, with words that say nothing."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzéüñ"
    word = lambda: "".join(rng.choices(letters, k=rng.randint(1, 9)))

    def sentence(low: int = 3, high: int = 25) -> str:
        # junk, links and lists of numbers occur in articles as well, and headings end without a sign
        joint = rng.choice([" "] * 8 + [" | ", " ### ", ", "])
        return joint.join(word() for _ in range(rng.randint(low, high))).capitalize() + rng.choice(["."] * 6 + ["?", "!", "", "", ""])

    def prose(low: int = 1, high: int = 8) -> str:
        return " ".join(sentence() for _ in range(rng.randint(low, high)))

    def name(kind: str, bare: float = 0.25) -> str:
        own = rng.choice(names[kind])
        own = rng.choice([own, own, f"{word()}-{own}", f"{own}_{word()}", own.capitalize()])
        return "" if rng.random() < bare else rng.choice([f' class="{own}"', f' id="{own}"', f' class="{word()} {own}"'])

    def link() -> str:
        return f'<a href="/{word()}">{" ".join(word() for _ in range(rng.randint(1, 4)))}</a>'

    def items() -> str:
        return "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 9))) + "</ul>"

    def boilerplate(kind: str) -> str:
        if kind == "menu":
            return rng.choice([f"<nav{name('menu')}>{items()}</nav>", f"<div{name('menu', 0)}>{items()}</div>", f"<nav>{' '.join(link() for _ in range(5))}</nav>"])
        if kind == "header":
            return f"<header{name('frame')}>{rng.choice([f'<h1>{sentence(1, 4)}</h1>', f'<p>{sentence()}</p>', link(), f'<div>{word()}</div>'])}{items() if rng.random() < 0.5 else ''}</header>"
        if kind == "footer":
            inner = rng.choice([f"&copy; {word()} {sentence()}", f"<p>{prose()}</p>", f"<p>{sentence()}</p>{items()}", f"<div>{prose(1, 3)}</div>"])
            return rng.choice([f"<footer{name('frame')}>{inner}</footer>", f"<div{name('frame', 0)}>{inner}</div>"])
        if kind == "side":
            return rng.choice([f"<aside{name('side')}>{rng.choice([items(), f'<p>{prose(1, 4)}</p>', f'<h3>{sentence(1, 4)}</h3>{items()}'])}</aside>", f'<div{name("side", 0)}><h3>{sentence(1, 3)}</h3>{rng.choice([items(), f"<p>{prose(1, 4)}</p>"])}</div>'])
        if kind == "comments":
            tag, holder, own = rng.choice(["div", "li", "article"]), rng.choice(["section", "div", "ol"]), name("comment")
            each = "".join(f"<{tag}{own}><p>{prose(1, 6)}</p></{tag}>" for _ in range(rng.randint(1, 4)))
            return f"<{holder}{name('comment', 0)}><h3>{sentence(1, 3)}</h3>{each}</{holder}>"
        if kind == "form":
            return f"<form{name('form')}><label>{sentence(1, 4)}</label><input name=q><p>{sentence()}</p><select><option>{word()}<option>{word()}</select><button>{word()}</button></form>"
        tag = rng.choice(["div", "div", "section", "p", "aside"])
        inner = rng.choice([prose(1, 3), sentence(), link(), items() if tag != "p" else sentence(), f"<p>{prose(1, 3)}</p>" if tag != "p" else sentence()])
        return f"<{tag}{name(kind, 0)}>{inner}</{tag}>"

    out = []
    every = ["menu", "header", "footer", "side", "comments", "form", "advert", "notice", "share"]
    for _ in range(count):
        wanted: set[str] = set()

        def block(tag: str, low: int = 1, high: int = 8, wanted=wanted) -> str:
            text = sentence(1, 12) if tag in HEADINGS else rng.choice([prose(low, high), prose(low, high), sentence(1, 3)])
            wanted.add(" ".join(text.split()))
            return f"<{tag}>{text}</{tag}>"

        parts = [block("h1")] if rng.random() < 0.8 else []
        for _ in range(rng.randint(1, 10)):
            x = rng.random()
            if x < 0.62:
                parts.append(block("p", 1, rng.choice([1, 2, 8])))
            elif x < 0.7:
                parts.append(block(rng.choice(["h2", "h3"])))
            elif x < 0.84:
                parts.append("<ul>" + "".join(block("li", 1, 2) for _ in range(rng.randint(1, 4))) + "</ul>")
            elif x < 0.9:
                parts.append(f"<blockquote>{block('p')}</blockquote>")
            elif x < 0.93:
                parts.append("<table><tr>" + "".join(block("td", 1, 1) for _ in range(3)) + "</tr></table>")
            else:
                parts.append(boilerplate(rng.choice(["advert", "share", "side", "form"])))
        body = "".join(parts)
        if rng.random() < 0.3:
            body += boilerplate("comments")
        own = name("main", 0)
        holder = rng.choice(["<article>{}</article>"] * 4 + ["<main>{}</main>", f"<main><article{own}>{{}}</article></main>", f"<div{own}>{{}}</div>", f"<div{own}><div{name('main')}>{{}}</div></div>", f"<section{own}>{{}}</section>", "<div>{}</div>"])
        before = [boilerplate(k) for k in rng.sample(every, rng.randint(0, 4))]
        after = [boilerplate(k) for k in rng.sample(every, rng.randint(0, 4))]
        head = f"<html><head><title>{sentence()}</title><style>p{{}}</style><script>var a='</p>';</script></head>"
        out.append((f"<!DOCTYPE html>{head}<body>{''.join(before)}{holder.format(body)}{''.join(after)}</body></html>", wanted))
    return out


def main_text(page: str, model: Model, threshold: float = 0.5) -> str:
    """The content blocks, one a line."""
    nodes = parse(page)
    belief = model.marginals(nodes, features(nodes))
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if run:
            if block := " ".join("".join(run).split()):
                blocks.append(block)
            run.clear()

    work: list = [(0, 0)]
    while work:
        k, i = work.pop()
        node = nodes[k]
        if i == 0 and not node.inline:
            flush()
        kept = belief[k] > threshold
        while i < len(node.parts):
            part = node.parts[i]
            i += 1
            if isinstance(part, str):
                if kept:
                    run.append(part)
            elif part is None:
                flush()
            elif nodes[part].tag not in NEVER:
                work.append((k, i))
                work.append((part, 0))
                break
        else:
            if not node.inline:
                flush()
    flush()
    return "\n".join(blocks)


_MODEL: list[Model] = []


def default_model() -> Model:
    if not _MODEL:
        _MODEL.append(train(labelled_pages()))
    return _MODEL[0]


def main_texts(df: DataFrame, page: str = "html", model: Model | None = None) -> DataFrame:
    """df's columns but the page, with text and n_chars, its code points.

    The whole page is read, in time that grows with its length alone, however its tags are nested or broken; a null, empty or blank page, or one without content, has an empty text. Character references are decoded, white space in a block is one
    space, blocks are joined by one newline. Repeated rows stay; a column of df with the name of a result is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model or default_model())

    def start():
        model = shared.value
        return lambda pages: [[main_text(p, model) if p else "" for p in pages]]

    kept = df.drop("n_chars") if page != "n_chars" else df
    return with_texts(kept, page, "text string", start).withColumn("n_chars", F.char_length("text").cast("long"))
