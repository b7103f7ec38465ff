"""Main-text extraction: a linear-chain conditional random field over the leaf
blocks of a page.

A page is read once into its leaf blocks, the runs of text between block-level
tags, each with its ancestors. A block's features are the tags and class / id
words of its ancestors, its own tag, and its text (length, links, sentences,
digits, marks). The chain labels blocks as main text or not; its weights are
learned by maximal likelihood (forward-backward) from labelled pages, and a
page is labelled by Viterbi. The features of an ancestor add to the score of
everything below it; each open element is held once, with the sum down to it,
so a block costs its own text only and a page memory in proportion to its length.

``training_pages`` makes labelled pages of many layouts; a list of other
labelled pages can be given to ``train`` instead. The model is fitted on the
driver and broadcast (some thousand weights).

Output per page: the main blocks, character references decoded, white space
turned into single spaces, joined by an empty line; the empty text if there
are none. Null html counts as empty; unclosed and stray tags, truncated pages
and text without markup are read as they stand; repeated rows are extracted
each; null ids and urls are passed through; other columns are ignored.
"""

from __future__ import annotations

import html as html_module
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import importable

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong "
                   "sub sup time tt u var wbr math svg object canvas audio video".split())
#: Elements of formulas and drawings, which stand inside a line.
INLINE |= frozenset("annotation maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub "
                    "msubsup msup mtable mtd mtext mtr munder munderover semantics circle ellipse g line path polygon polyline rect text tspan".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page.
RAW = frozenset("script style title noscript template textarea iframe annotation head".split())
#: A start tag that ends an open element of these names.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "body": {"head"}}
MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)""", re.S)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RAW_END = {t: re.compile(rf"</{t}\b", re.I) for t in RAW}
BODY = re.compile("<body", re.I)


@dataclass(slots=True, eq=False)
class Element:
    """An open element, tied to the one around it."""

    features: tuple[str, ...]
    around: Element | None
    score: tuple[object, float] | None = None   # whose weights, and their sum from the outermost element down to here


@dataclass
class Block:
    text: str
    tag: str
    above: Element | None    # the innermost ancestor
    linked: int              # characters inside links


_tag_features: dict[tuple[str, str], tuple[str, ...]] = {}


def tag_features(tag: str, attributes: str) -> tuple[str, ...]:
    key = tag, attributes if "=" in attributes else ""
    known = _tag_features.get(key)
    if known is None:
        if len(_tag_features) > 50_000:
            _tag_features.clear()
        words = {w.lower() for m in NAMES.finditer(key[1]) for w in WORD.findall(m[2] or m[3] or m[4] or "")}
        known = _tag_features[key] = (f"in:{tag}", *(f"name:{w}" for w in sorted(words)))
    return known


def leaf_blocks(page: str) -> Iterator[Block]:
    """The leaf blocks of a page, in order."""
    stack: list[tuple[str, Element, int]] = []  # open elements, each with the place of the innermost block in it
    parts: list[str] = []
    n_open: dict[str, int] = {}
    linked = at = 0

    def close() -> Iterator[Block]:
        nonlocal linked
        if parts:
            text = " ".join(html_module.unescape("".join(parts)).split())
            if text:
                inner = stack[-1][2] if stack else -1
                yield Block(text, stack[inner][0] if inner >= 0 else "", stack[-1][1] if stack else None, linked)
            parts.clear()
        linked = 0

    def leave(k: int) -> None:
        for tag, _, _ in stack[k:]:
            n_open[tag] -= 1
        del stack[k:]

    def add(s: str) -> None:
        nonlocal linked
        if s:
            parts.append(s)
            if n_open.get("a"):
                linked += len(s)

    n = len(page)
    while at < n:
        m = MARKUP.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in RAW and n_open.get("svg"):   # the title or style of a drawing
            if not m[1] and not m[3].endswith("/"):
                at = end.start() if (end := RAW_END[tag].search(page, at)) else n
            continue
        if not m[1]:
            if tag in RAW:
                if tag not in INLINE:
                    yield from close()
                if not m[3].endswith("/"):
                    end = RAW_END[tag].search(page, at)
                    if tag == "head" and (body := BODY.search(page, at)) and (end is None or body.start() < end.start()):
                        at = body.start()
                        continue
                    at = end.start() if end else n
                continue
            if tag == "br":
                add(" ")
            if tag not in INLINE:
                yield from close()
                inner = stack[-1][2] if stack else -1
                if inner >= 0 and (stack[inner][0] == "p" or stack[inner][0] in ENDS.get(tag, ())):
                    leave(inner)
            if tag not in VOID and not m[3].endswith("/"):
                inner = len(stack) if tag not in INLINE else stack[-1][2] if stack else -1
                stack.append((tag, Element(tag_features(tag, m[3]), stack[-1][1] if stack else None), inner))
                n_open[tag] = n_open.get(tag, 0) + 1
        else:
            if tag not in INLINE:
                yield from close()
            if n_open.get(tag):
                # an inline element ends inside its block only
                for k in range(len(stack) - 1, stack[-1][2] if tag in INLINE else -1, -1):
                    if stack[k][0] == tag:
                        leave(k)
                        break
    yield from close()


def ancestors(b: Block) -> list[str]:
    """Features of all ancestors of a block, outermost first, with repeats."""
    out, e = [], b.above
    while e is not None:
        out.append(e.features)
        e = e.around
    return [f for features in reversed(out) for f in features]


def text_features(b: Block) -> list[str]:
    """Features of a block's own tag and text."""
    t, n = b.text, len(b.text)
    words = t.count(" ") + 1
    f = [f"tag:{b.tag}", f"words:{min(words.bit_length(), 8)}", f"linked:{min(4, 4 * b.linked // n)}"]
    if t[-1] in ".!?…":
        f.append("stop")
    elif words < 6:
        f.append("short, no stop")
    marks = sum(map(t.count, ",.;"))
    f.append(f"marks:{min(3, 20 * marks // n)}")
    if "©" in t or "·" in t or "|" in t and words < 25:
        f.append("line marks")
    if t[0].islower():
        f.append("lower start")
    if sum(map(str.isdigit, t)) * 5 > n:
        f.append("digits")
    return f


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)   # of main text over other, by feature
    start: float = 0.0                                        # of main text first
    move: tuple[float, float, float, float] = (0, 0, 0, 0)    # other-other, other-main, main-other, main-main

    def above(self, e: Element | None) -> float:
        """Sum of the weights of an element and all around it, kept at each."""
        todo = []
        while e is not None and (e.score is None or e.score[0] is not self.weights):
            todo.append(e)
            e = e.around
        s = e.score[1] if e is not None else 0.0
        for e in reversed(todo):
            s += sum([self.weights.get(f, 0.0) for f in e.features])
            e.score = self.weights, s
        return s

    def scores(self, blocks: list[Block]) -> list[float]:
        return [self.above(b.above) + sum([self.weights.get(f, 0.0) for f in text_features(b)]) for b in blocks]

    def viterbi(self, scores: list[float]) -> list[int]:
        """The best labels of a chain: 1 main text, 0 other."""
        if not scores:
            return []
        oo, om, mo, mm = self.move
        other, main = 0.0, self.start + scores[0]
        back = []
        for s in scores[1:]:
            from_other, from_main = other + om > main + mm, other + oo > main + mo
            back.append((0 if from_main else 1, 0 if from_other else 1))
            other, main = max(other + oo, main + mo), max(other + om, main + mm) + s
        labels = [int(main > other)]
        for to_other, to_main in reversed(back):
            labels.append(to_main if labels[-1] else to_other)
        return labels[::-1]

    def extract(self, page: str) -> str:
        blocks = list(leaf_blocks(page))
        return "\n\n".join([b.text for b, y in zip(blocks, self.viterbi(self.scores(blocks))) if y])


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = 150, rate: float = 0.3, decay: float = 3e-4) -> Model:
    """Maximal likelihood with adaptive gradients over all chains at once."""
    names: dict[str, int] = {}
    at, of, starts, y = [], [], [], []
    n = 0
    for blocks, labels in pages:
        if not blocks:
            continue
        starts.append(n)
        for b, label in zip(blocks, labels):
            for f in (*ancestors(b), *text_features(b)):
                at.append(n)
                of.append(names.setdefault(f, len(names)))
            y.append(label)
            n += 1
    at, of, y = np.array(at, int), np.array(of, int), np.array(y, float)
    first = np.zeros(n, bool)
    first[starts] = True
    lengths = np.diff([*starts, n])
    theta, total = np.zeros(len(names) + 5), np.full(len(names) + 5, 1e-6)
    chains = len(starts)
    # chains side by side, one step of all of them at a time
    longest = int(lengths.max())
    place = np.full((longest, chains), -1)
    for c, (s, k) in enumerate(zip(starts, lengths)):
        place[:k, c] = np.arange(s, s + k)
    inside = place >= 0
    gold = np.where(inside, y[place], 0).astype(int)
    for _ in range(rounds):
        w, start, move = theta[:-5], theta[-5], theta[-4:].reshape(2, 2)
        e = np.bincount(at, w[of], n)
        emit = np.zeros((longest, chains, 2))
        emit[:, :, 1] = np.where(inside, e[place], 0)
        emit[0, :, 1] += start
        fw, bw = np.zeros_like(emit), np.zeros_like(emit)
        fw[0] = emit[0]
        for k in range(1, longest):
            step = np.logaddexp.reduce(fw[k - 1][:, :, None] + move[None], axis=1) + emit[k]
            fw[k] = np.where(inside[k][:, None], step, fw[k - 1])
        for k in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(move[None] + (emit[k + 1] + bw[k + 1])[:, None, :], axis=2)
            bw[k] = np.where(inside[k + 1][:, None], step, bw[k + 1])
        z = np.logaddexp.reduce(fw[-1], axis=1)
        p = np.exp(fw[:, :, 1] + bw[:, :, 1] - z) * inside
        miss = np.zeros(n)
        miss[place[inside]] = (p - gold)[inside]
        grad = np.concatenate([np.bincount(of, miss[at], len(names)), [(p[0] - gold[0]).sum()], np.zeros(4)])
        for k in range(1, longest):
            both = np.exp(fw[k - 1][:, :, None] + move[None] + (emit[k] + bw[k])[:, None, :] - z[:, None, None]) * inside[k][:, None, None]
            seen = np.zeros((2, 2))
            np.add.at(seen, (gold[k - 1][inside[k]], gold[k][inside[k]]), 1)
            grad[-4:] += (both.sum(0) - seen).ravel()
        grad = grad / chains + decay * theta
        total += grad * grad
        theta -= rate * grad / np.sqrt(total)
    return Model({f: float(theta[i]) for f, i in names.items()}, float(theta[-5]), tuple(theta[-4:].tolist()))


# Labelled training pages: layouts drawn at random, marked by their maker.

_SYLLABLES = "an be der ion ment la que ing ed th er ca do mi ra to es un go si ne ka lo ve".split()
#: Names that page makers give to each part.
_PARTS = {
    "nav": (["nav"], "menu nav navigation navbar topnav breadcrumb breadcrumbs links tabs"),
    "header": (["header"], "header masthead banner top logo site-header branding"),
    "footer": (["footer"], "footer site-footer bottom copyright colophon legal"),
    "aside": (["aside"], "sidebar side aside widget related rail recommended popular trending more-stories tags"),
    "notice": ([], "cookie notice consent gdpr alert warning banner privacy popup modal newsletter-notice message"),
    "ad": ([], "ad ads advert advertisement sponsored promo banner-ad sponsor promoted adbox"),
    "form": (["form"], "form search subscribe signup newsletter login contact-form"),
    "comments": ([], "comments comment reader-comments discussion responses replies respond disqus comment-list"),
    "share": ([], "share social sharing follow byline meta author-box"),
}
_MAIN = "content article post entry main story body text article-body entry-content post-content page"


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choices(_SYLLABLES, k=self.r.choice([1, 1, 2, 2, 3])))

    def phrase(self, k: int) -> str:
        return " ".join(self.word() for _ in range(k)).capitalize()

    def prose(self, low: int = 8, high: int = 120) -> str:
        out, n = [], self.r.randint(low, high)
        while n > 0:
            k = min(n, self.r.randint(1, 14))
            out.append(self.phrase(k) + self.r.choice([".", ".", ".", "?", "!", ","]))
            n -= k
        return " ".join(out)

    def odd_prose(self) -> str:
        kind = self.r.random()
        words = [self.word() + self.r.choice(["", "", "."]) for _ in range(self.r.choice([2, 4, 8, 20, 60, 120]))]
        if kind < 0.3:
            return " | ".join(words)
        if kind < 0.5:
            return " ".join(words).upper() + "!!"
        return " ".join(words)

    def name(self, names: str) -> str:
        n = self.r.choice(names.split())
        n = self.r.choice([n, n, n, f"{n}-{self.word()}", f"{self.word()} {n}", f"js-{n}"])
        return self.r.choice([f' class="{n}"', f' class="{n}"', f' id="{n}"', f" class='{n} {self.word()}'"])

    def part(self, kind: str) -> list[tuple[str, int]]:
        """Pieces of markup and the label of each one's text (0 or none)."""
        tags, names = _PARTS[kind]
        plain = not tags or self.r.random() < 0.5
        tag = self.r.choice(["div", "div", "section", "ul" if kind == "nav" else "div"]) if plain else tags[0]
        bare = not plain and self.r.random() < 0.7
        inner: list[str] = []
        if kind in ("nav", "share") or kind == "aside" and self.r.random() < 0.5:
            items = "".join(f'<li><a href="/{self.word()}">{self.phrase(self.r.randint(1, 3))}</a></li>' for _ in range(self.r.randint(2, 9)))
            inner = [f"<ul>{items}</ul>"] if self.r.random() < 0.7 else [items.replace("<li>", "").replace("</li>", " ")]
        elif kind == "form":
            inner = [f"<label>{self.phrase(2)}</label><input name=q><button>{self.phrase(1)}</button>", f"<p>{self.prose(3, 20)}</p>" if self.r.random() < 0.4 else ""]
        elif kind == "comments":
            inner = [f"<h3>{self.phrase(2)}</h3>"] + [
                f'<div{self.name("comment reply comment-body")}><b>{self.phrase(1)}</b><p>{self.prose(4, 60)}</p></div>' for _ in range(self.r.randint(1, 4))]
        elif kind == "footer":
            inner = [self.r.choice(["&copy; ", "© 2024 ", ""]) + f"www.{self.word()}.example.org &middot; " + self.prose(4, 20)]
            if self.r.random() < 0.4:
                inner.append(f'<p><a href="/">{self.phrase(2)}</a> <a href="/x">{self.phrase(1)}</a></p>')
        elif kind == "header":
            inner = [f'<a href="/">{self.phrase(2)}</a>', self.r.choice(["", f"<p>{self.phrase(5)}</p>", f"<h2>{self.phrase(3)}</h2>"])]
        else:
            inner = [self.r.choice([f"<p>{self.prose(3, 40)}</p>", self.prose(3, 40), f"<h4>{self.phrase(2)}</h4><p>{self.prose(4, 40)}</p>"])]
        return [(f"<{tag}{'' if bare else self.name(names)}>" + "".join(inner) + f"</{tag}>", 0)]

    def main(self) -> list[tuple[str, int]]:
        out: list[tuple[str, int]] = [(f"<h1>{self.phrase(self.r.randint(2, 10))}</h1>", 1)] if self.r.random() < 0.8 else []
        prose = self.odd_prose if self.r.random() < 0.25 else self.prose
        for _ in range(self.r.randint(1, 9)):
            k = self.r.random()
            if k < 0.55:
                text = prose()
                if self.r.random() < 0.15:
                    text = text.replace(" ", f' <a href="/{self.word()}">{self.word()}</a> ', 1)
                if self.r.random() < 0.15:
                    text = f"<b>{text}<br>"
                out.append((f"<p>{text}" + ("</p>" if self.r.random() < 0.8 else ""), 1))
            elif k < 0.62:
                h = self.r.randint(2, 4)
                out.append((f"<h{h}>{self.phrase(self.r.randint(1, 6))}</h{h}>", 1))
            elif k < 0.70:
                out.append(("<ul>" + "".join(f"<li>{self.prose(2, 20)}</li>" for _ in range(self.r.randint(2, 5))) + "</ul>", 1))
            elif k < 0.74:
                out.append((f"<blockquote><p>{self.prose(5, 40)}</p></blockquote>", 1))
            elif k < 0.77:
                out.append((f"<pre>{self.odd_prose()}</pre>", 1))
            elif k < 0.80:
                out.append(("<table>" + "".join(f"<tr><td>{self.phrase(2)}</td><td>{self.prose(1, 6)}</td></tr>" for _ in range(3)) + "</table>", 1))
            else:
                out += self.part(self.r.choice(["ad", "ad", "ad", "share", "form", "aside", "notice", "nav", "comments"]))
        return out

    def page(self) -> list[tuple[str, int]]:
        r = self.r
        before = [k for k in ("notice", "header", "nav", "ad", "form", "aside") if r.random() < (0.7 if k in ("header", "nav") else 0.35)]
        after = [k for k in ("share", "ad", "aside", "form", "comments", "notice", "footer") if r.random() < (0.8 if k == "footer" else 0.35)]
        if r.random() < 0.3:
            r.shuffle(before)
        tag = r.choice(["article", "article", "main", "div", "div", "section"])
        named = "" if tag in ("article", "main") and r.random() < 0.6 else self.name(_MAIN) if r.random() < 0.9 else ""
        wrap = r.choice([("", ""), ("", ""), ("<div class=wrapper>", "</div>"), ('<div id="page"><div class="container">', "</div></div>")])
        inside = [k for k in after if k in ("share", "comments") and r.random() < 0.4]
        after = [k for k in after if k not in inside]
        main = [(f"<{tag}{named}>", 0), *self.main(), *(x for k in inside for x in self.part(k)), (f"</{tag}>", 0)]
        if tag != "main" and r.random() < 0.3:
            main = [(f"<{r.choice(['main', 'main', 'div', 'section'])}{self.name(_MAIN) if r.random() < 0.5 else ''}>", 0), *main]
        if r.random() < 0.04:
            main = []
        return [("<!DOCTYPE html><html><head><title>t</title><script>var a='<p>';</script></head><body>" + wrap[0], 0),
                *(x for k in before for x in self.part(k)), *main, *(x for k in after for x in self.part(k)), (wrap[1] + "</body></html>", 0)]


def training_pages(n: int = 1500, seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages: text of main pieces is marked before it is parsed, and
    the mark is removed from the block that has it."""
    maker, out = _Maker(seed), []
    mark = "\u0001"
    for _ in range(n):
        page = "".join(re.sub(r">([^<]*\S[^<]*)", lambda m: f">{mark}{m[1]}", s) if y else s for s, y in maker.page())
        blocks, labels = [], []
        for b in leaf_blocks(page):
            labels.append(int(mark in b.text))
            b.text = " ".join(b.text.replace(mark, "").split())
            blocks.append(b)
        if all(b.text for b in blocks):
            out.append((blocks, labels))
    return out


_model: Model | None = None


def default_model() -> Model:
    global _model
    if _model is None:
        _model = train(training_pages())
    return _model


def extract(df: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) per page."""
    m = model or default_model()
    sent = df.sparkSession.sparkContext.broadcast((m.weights, m.start, m.move))
    kind = df.schema[id_col].dataType.simpleString()
    importable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for b in batches:
            texts = [own.extract(page) for page in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])

    return (df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
            .mapInArrow(run, f"id {kind}, url string, text string").withColumnsRenamed({"id": id_col, "url": url_col}))
