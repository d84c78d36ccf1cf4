"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of a page.

Each block has features of the elements around it (tags; words of class, id and role; the nearest of both) and of its
text. The field has two states, text and boilerplate, and is trained by its exact conditional likelihood on labelled
pages: pairs of a page and its main text, one block a line. Viterbi's method decodes a page; the blocks in the text
state, in page order, are its main text.

The labelled pages come from `examples`, which builds pages of many layouts around invented prose, with the main text
known; other pairs can be given to `fit`. No page of the table that is extracted takes part.

Defined results: a null or empty page, or one without blocks in the text state, has the empty text; rows with equal
ids, and columns other than these, don't matter; an empty table gives no rows.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwheel.llm.htmlblocks import Around, Leaf, leaves

#: Pages that `examples` builds.
EXAMPLES = 700
_STATES = 2
# Words that pages use in class, id and role for each kind of part.
PARTS = {
    "menu": "nav navigation menu navbar topnav mainnav breadcrumb breadcrumbs pagination pager tabs toc links skip dropdown sitemap menubar subnav",
    "header": "header masthead banner top topbar logo branding site tagline search toolbar hero brand",
    "footer": "footer foot bottom copyright legal colophon credits imprint contentinfo footnav disclaimer",
    "sidebar": "sidebar side aside rail right left widget widgets column complementary related recommended popular trending more readmore recent tags archive latest teaser sidenav",
    "notice": "cookie cookies consent notice alert gdpr privacy popup modal overlay warning message banner paywall dialog toast announcement infobar",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion adsbygoogle dfp banner commercial partner outbrain taboola advertorial adbox adslot",
    "form": "form search subscribe newsletter signup login register contact email input field survey poll signin optin",
    "comments": "comments comment discussion replies reply respond disqus thread reader readers commentlist feedback responses reactions",
    "share": "share sharing social follow buttons tools print byline meta author date timestamp",
}
TEXT_PARTS = "article content post entry main story body text articlebody entrycontent postcontent page copy single prose document maincontent storybody hentry blog news item detail"
_TAGS = {"menu": "nav nav ul div", "header": "header header div", "footer": "footer footer div", "sidebar": "aside aside div section", "notice": "div div section aside dialog", "advert": "div div ins aside section", "form": "form form form div", "comments": "section div div ol aside", "share": "div ul p"}


class _Writer:
    """Builds one page and notes its main text."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.kept: list[str] = []
        self.syllables = ["".join(self.r.choice(x) for x in ("bcdfghlmnprstvwz", "aeiouéäö", "nrstlm ")).strip() for _ in range(60)]

    def words(self, n: int) -> str:
        style = self.r.random()
        out = ["".join(self.r.choices(self.syllables, k=self.r.randint(1, 4))) for _ in range(n)]
        if style < 0.05:
            out = [w + self.r.choice(["***", "###", "$$$", "&&", " |"]) for w in out]
        elif style < 0.09:
            out = [w.upper() + "!!" for w in out]
        text = " ".join(out)
        return text[0].upper() + text[1:]

    def prose(self, longest: int = 90) -> str:
        n = max(1, int(longest ** self.r.random()))
        text = self.words(n)
        return text + (self.r.choice([".", ".", ".", "!", "?", ":", ""]) if self.r.random() < 0.95 else "")

    def block(self, tag: str, text: str, keep: bool, attrs: str = "", plain: bool = False) -> str:
        if keep:
            self.kept.append(" ".join(text.split()))
        inner = html.escape(text, quote=self.r.random() < 0.5)
        words = inner.split(" ")
        if not plain and len(words) > 4 and self.r.random() < 0.2:
            k = self.r.randrange(len(words) - 2)
            name = self.r.choice(["b", "em", "strong", "span", "i", 'a href="/x"'])
            words[k] = f"<{name}>{words[k]}</{name.split()[0]}>"
            inner = " ".join(words)
        if self.r.random() < 0.06:
            return f"<{tag}{attrs}><b>{inner}<br>" if tag == "p" else f"<{tag}{attrs}>{inner}</{tag}>"
        return f"<{tag}{attrs}>{inner}" + ("" if tag in ("p", "li") and self.r.random() < 0.05 else f"</{tag}>")

    def attrs(self, vocabulary: str, chance: float) -> str:
        if self.r.random() > chance:
            return ""
        names = self.r.sample(vocabulary.split(), self.r.choice([1, 1, 1, 2]))
        value = self.r.choice(["-", "_", " "]).join(names)
        if self.r.random() < 0.3:
            value = self.r.choice(["main", "site", "page", "block", "box", "wrapper", "js", "c", "inner", "container", "section", "list"]) + self.r.choice("-_ ") + value
        return f' {self.r.choice(["class", "class", "id"])}="{value}"'

    def part(self, kind: str, depth: int = 0) -> str:
        r = self.r
        tag = r.choice(_TAGS[kind].split())
        own = {"nav", "footer", "aside", "form", "ins", "header"}
        opened = f"<{tag}{self.attrs(PARTS[kind], 0.45 if tag in own else 1)}" + (f' role="{r.choice(["navigation", "banner", "contentinfo", "complementary", "alert", "dialog", "search"])}"' if r.random() < 0.1 else "") + ">"
        inner = []
        if kind in ("menu", "share") or (kind in ("footer", "sidebar", "header") and r.random() < 0.5):
            items = [f'<li><a href="/{k}">{html.escape(self.words(r.randint(1, 3)))}</a></li>' for k in range(r.randint(2, 8))]
            inner.append("".join(items) if tag in ("ul", "ol") else f"<ul>{''.join(items)}</ul>" if r.random() < 0.7 else "".join(x[4:-5] + " " for x in items))
        if kind == "header":
            inner.append(self.block(r.choice(["div", "p", "h1", "h2"]), self.words(r.randint(1, 5)), False))
        if kind == "form":
            inner += [f"<label>{html.escape(self.words(r.randint(1, 3)))}</label><input type=text name=q>", self.block("p", self.prose(), False) if r.random() < 0.5 else "", f"<button>{html.escape(self.words(1))}</button>", "<select><option>" + self.words(1) + "<option>" + self.words(1) + "</select>" if r.random() < 0.3 else ""]
        if kind in ("footer", "notice", "advert", "sidebar", "share"):
            loose = r.random() < 0.5
            inner += [html.escape(self.prose(40)) if loose and k == 0 else self.block(r.choice(["p", "p", "div", "h3", "span"]), self.prose(60), False) for k in range(r.randint(1, 4))]
            if kind == "footer":
                inner.insert(0, "&copy; " + html.escape(self.words(2)))
        if kind == "comments":
            inner.append(self.block(r.choice(["h2", "h3"]), self.words(r.randint(1, 3)), False))
            for _ in range(r.randint(1, 6)):
                item = r.choice(["div", "li", "article", "section"])
                inner.append(f"<{item}{self.attrs('comment reply thread reader response', 0.7)}>" + self.block(r.choice(["p", "span", "cite", "h4"]), self.words(r.randint(1, 2)), False) + "".join(self.block("p", self.prose(), False) for _ in range(r.randint(1, 3))) + f"</{item}>")
        return opened + "".join(inner) + f"</{tag}>"

    def main(self) -> str:
        r = self.r
        out = []
        if r.random() < 0.85:
            out.append(self.block(r.choice(["h1", "h1", "h2"]), self.words(r.randint(2, 12)), True))
        for _ in range(max(1, int(30 ** r.random()))):
            way = r.random()
            if way < 0.72:
                out.append(self.block("p", self.prose(), True, self.attrs("text lead para intro dropcap c", 0.05)))
            elif way < 0.8:
                out.append(self.block(r.choice(["h2", "h3", "h4"]), self.words(r.randint(1, 7)), True))
            elif way < 0.86:
                tag = r.choice(["ul", "ol"])
                out.append(f"<{tag}>" + "".join(self.block("li", self.prose(20), True) for _ in range(r.randint(1, 6))) + f"</{tag}>")
            elif way < 0.9:
                out.append(r.choice(["<blockquote>{}</blockquote>", "<figure><img src=a.png>{}</figure>", "<div>{}</div>", "<section>{}</section>"]).format(self.block(r.choice(["p", "div", "figcaption"]), self.prose(), True)))
            elif way < 0.93:
                out.append("<table>" + "".join("<tr>" + "".join(self.block("td", self.words(r.randint(1, 3)), True) for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 3))) + "</table>")
            elif way < 0.95:
                out.append(self.block("pre", self.prose(30), True, plain=True))
            else:
                out.append(self.part(r.choice(["advert", "notice", "sidebar", "form", "share", "comments", "menu"])))
        if r.random() < 0.15:
            out.append(self.part(r.choice(["comments", "share", "sidebar", "form", "footer"])))
        inner = "".join(out)
        way = r.random()
        if way < 0.45:
            return f"<article{self.attrs(TEXT_PARTS, 0.3)}>{inner}</article>"
        if way < 0.6:
            return f"<main{self.attrs(TEXT_PARTS, 0.3)}>{inner}</main>"
        if way < 0.9:
            return f"<div{self.attrs(TEXT_PARTS, 1)}>{inner}</div>"
        return inner

    def page(self) -> tuple[str, str]:
        r = self.r
        some = lambda kinds, chance: [self.part(k) for k in kinds if r.random() < chance]
        before = some(["notice", "header", "menu", "menu", "advert", "sidebar", "form"], 0.4)
        after = some(["share", "sidebar", "advert", "sidebar", "comments", "comments", "form", "notice", "menu"], 0.3)
        if r.random() < 0.5:
            r.shuffle(before)
            r.shuffle(after)
        if r.random() < 0.85:
            after.append(self.part("footer"))
        body = "".join(before) + self.main() + "".join(after)
        for _ in range(r.randint(0, 2)):
            body = f"<div{self.attrs('page wrapper container site app root layout main content row outer', 0.8)}>{body}</div>"
        return f"<!DOCTYPE html><html><head><title>{self.words(3)}</title><script>var t='</p>';</script></head><body>{body}" + ("</body></html>" if r.random() < 0.9 else ""), "\n".join(self.kept)


def examples(n: int = EXAMPLES, seed: int = 11) -> list[tuple[str, str]]:
    """n labelled pages: (html, main text)."""
    return [_Writer(seed * 1_000_003 + k).page() for k in range(n)]


_KNOWN = {w: kind for kind, words in (*PARTS.items(), ("text", TEXT_PARTS)) for w in words.split()}


@cache
def _stem(mark: str) -> str:
    """A mark as a feature: itself if known, else the known word that it begins or ends with, else none."""
    if mark in _KNOWN:
        return mark
    found = [w for w in _KNOWN if len(w) > 3 and (mark.startswith(w) or mark.endswith(w))]
    return max(found, key=len) if found else ""


#: Elements that say by their tag what kind of part they are.
_KINDS = frozenset("nav header footer aside form article main ins dialog".split())


class Context:
    """The features of the elements around a block: those that all of them give, and the last kinds of part."""

    __slots__ = ("depth", "features", "kinds", "tag")

    def __init__(self, features: frozenset[str], kinds: tuple[str, ...], tag: str, depth: int):
        self.features, self.kinds, self.tag, self.depth = features, kinds, tag, depth

    def key(self) -> tuple:
        return self.features, self.kinds, self.tag, self.depth

    def names(self) -> list[str]:
        """All features, in order."""
        near = self.kinds[-1] if self.kinds else "none"
        out = self.features | {f"own:{self.tag or 'body'}", f"near:{near}", f"depth:{self.depth}"}
        return sorted(out | {f"near2:{self.kinds[-2]}>{near}"} if len(self.kinds) > 1 else out)


def contexts(known: frozenset[str] | None = None):
    """A function from the elements around a block to their context. Each element is looked at once.

    known: features that count; others are left out, so that sets stay as small as the field's own.
    """
    seen: dict[Around, Context] = {}

    def of(around: Around) -> Context:
        todo = []
        while around is not None and around not in seen:
            todo.append(around)
            around = around.outer
        context = seen[around] if around is not None else Context(frozenset(), (), "", 0)
        for each in reversed(todo):
            if each.tag not in ("", "html", "body"):
                own, kinds = {f"in:{each.tag}"}, []
                for m in each.said:
                    if m == "hidden":
                        own.add("hidden")
                    elif stem := _stem(m):
                        own |= {f"mark:{stem}", f"kind:{_KNOWN[stem]}"}
                        kinds.append(_KNOWN[stem])
                if each.tag in _KINDS:
                    kinds.append(each.tag)
                if known is not None:
                    own &= known
                features = context.features if own <= context.features else context.features | own
                context = Context(features, (*context.kinds, *kinds)[-2:], each.tag, min(each.depth, 6))
            seen[each] = context
        return context

    return of


def within(leaf: Leaf) -> list[str]:
    """Features of a block's text."""
    text, n = leaf.text, leaf.text.count(" ") + 1
    share = 4 * leaf.linked // max(1, len(text))
    return [f"words:{min(n.bit_length(), 7)}", f"links:{share}", "ends" if text[-1] in ".!?:" else "open", *(["copy"] if "©" in text else [])]


class Field:
    """Weights (features x states), transitions between states, and those of the first and last block."""

    def __init__(self, weights: dict[str, np.ndarray], moves: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.weights, self.moves, self.first, self.last = weights, moves, first, last
        self._known = frozenset(weights)
        self._gains: dict[tuple, float] = {}

    def gains(self, blocks: list[Leaf]) -> list[float]:
        """How much the features of each block of a page speak for text rather than boilerplate."""
        of, out = contexts(self._known), []
        for leaf in blocks:
            context = of(leaf.around)
            known = self._gains.get(context.key())
            if known is None:
                if len(self._gains) > 50_000:
                    self._gains.clear()
                known = self._gains[context.key()] = sum(self.weights.get(f, 0.0) for f in context.names())
            out.append(known + sum(self.weights.get(f, 0.0) for f in within(leaf)))
        return out

    def decode(self, blocks: list[Leaf]) -> list[bool]:
        """Viterbi's best states."""
        if not blocks:
            return []
        (m00, m01), (m10, m11) = self.moves.tolist()
        gains = self.gains(blocks)
        a, b = float(self.first[0]), float(self.first[1]) + gains[0]
        back: list[tuple[bool, bool]] = []
        for g in gains[1:]:
            to_a, to_b = b + m10 > a + m00, b + m11 > a + m01
            back.append((to_a, to_b))
            a, b = (b + m10 if to_a else a + m00), (b + m11 if to_b else a + m01) + g
        state = b + float(self.last[1]) > a + float(self.last[0])
        out = [state]
        for to_a, to_b in reversed(back):
            state = to_b if state else to_a
            out.append(state)
        return out[::-1]


def labels(blocks: list[Leaf], text: str) -> list[bool]:
    """Which blocks are the lines of the main text, in order."""
    lines, at, out = text.split("\n"), 0, []
    for leaf in blocks:
        hit = at < len(lines) and leaf.text == lines[at]
        out.append(hit)
        at += hit
    return out


def fit(pairs: list[tuple[str, str]], steps: int = 250, penalty: float = 0.02) -> Field:
    """Maximises the conditional likelihood of the labels, less a quadratic penalty, by Adam's method over all pages."""
    pages = [(found, labels(found, text)) for page, text in pairs if (found := leaves(page))]
    rows = []
    for found, _ in pages:
        of = contexts()
        rows.append([of(leaf.around).names() + within(leaf) for leaf in found])
    names = {f: k for k, f in enumerate(sorted({f for page in rows for block in page for f in block}))}
    longest = max(len(page) for page in rows)
    n = len(pages)
    flat_at = np.array([p * longest + t for p, page in enumerate(rows) for t, block in enumerate(page) for _ in block])
    flat_f = np.array([names[f] for page in rows for block in page for f in block])
    y, there = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for p, (_, truth) in enumerate(pages):
        y[p, : len(truth)], there[p, : len(truth)] = truth, True
    ends = there.sum(1) - 1
    theta = np.zeros(len(names) + 8)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    pair_truth = np.zeros((_STATES, _STATES))
    both = there[:, 1:]
    np.add.at(pair_truth, (y[:, :-1][both], y[:, 1:][both]), 1)
    for step in range(1, steps + 1):
        w, moves, first, last = theta[: len(names)], theta[-8:-4].reshape(2, 2), theta[-4:-2], theta[-2:]
        gain = np.bincount(flat_at, w[flat_f], n * longest).reshape(n, longest)
        score = np.stack([np.zeros_like(gain), gain], -1)
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = first + score[:, 0]
        for t in range(1, longest):
            step_on = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, axis=1) + score[:, t]
            forward[:, t] = np.where(there[:, t, None], step_on, forward[:, t - 1])
        total = np.logaddexp.reduce(forward[:, -1] + last, axis=1)
        backward[:, -1] = last
        for t in range(longest - 2, -1, -1):
            step_back = np.logaddexp.reduce(moves + (score[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(there[:, t + 1, None], step_back, last)
        chance = np.exp(forward + backward - total[:, None, None]) * there[..., None]
        pairs_chance = np.exp(forward[:, :-1, :, None] + moves + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None])[both].sum(0)
        wrong = (chance[..., 1] - y * there).reshape(-1)
        grad = np.concatenate([
            np.bincount(flat_f, wrong[flat_at], len(names)),
            (pairs_chance - pair_truth).reshape(-1),
            chance[:, 0].sum(0) - np.bincount(y[:, 0], minlength=2),
            chance[np.arange(n), ends].sum(0) - np.bincount(y[np.arange(n), ends], minlength=2),
        ]) / n + penalty * theta / n
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        theta = theta - 0.15 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = {f: float(theta[k]) for f, k in names.items()}
    return Field(weights, theta[-8:-4].reshape(2, 2), theta[-4:-2], theta[-2:])


@cache
def trained() -> Field:
    """The field fitted to `examples`, once a process."""
    return fit(examples())


def text_of(page: str | None, field: Field) -> str:
    blocks = leaves(page or "")
    return "\n".join(leaf.text for leaf, keep in zip(blocks, field.decode(blocks), strict=True) if keep)


def extracted(pages: DataFrame, field: Field | None = None, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns `keep`, text and n_chars of each page."""
    shared = pages.sparkSession.sparkContext.broadcast(field or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, 500) for whole in batches for k in range(0, whole.num_rows, 500)):
            texts = [text_of(page, shared.value) for page in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    schema = T.StructType([*(T.StructField(k, pages.schema[k].dataType) for k in keep), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select(F.col(html_col), *keep).mapInArrow(run, schema)


def op5_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
