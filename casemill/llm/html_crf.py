"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the document tree."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import packed, unpacked

#: Fixed values of HTML: elements that start a block, that never hold one, and whose text is never shown.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section select summary table "
    "tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template head title".split())
#: An element that ends the open element of the key's set when it starts (paragraphs, items, rows, cells).
CLOSES = {
    "p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
SCOPES = frozenset("article aside section div nav footer header main form table ul ol body html".split())
#: Words in tag names, classes, ids and roles that speak against or for main text.
AGAINST = frozenset(
    "ad ads adv advert advertisement advertising aside banner breadcrumb breadcrumbs button byline comment comments complementary consent "
    "contentinfo cookie cookies copyright disclaimer discussion disqus dialog footer foot form gdpr header login masthead menu meta modal nav "
    "navbar navigation newsletter notice notification pager pagination popup promo promoted promotion related replies respond reply search "
    "select share sharing sidebar signup skip social sponsor sponsored subscribe toolbar warning widget alert input textarea label fieldset".split()
)
FOR = frozenset("article main content post entry story body text articlebody".split())
#: Elements that say nothing about what they hold.
PLAIN = frozenset("html body div section span center b i em strong u small font table tbody tr td".split())
_SPACE = re.compile(r"\s+")
_NAMES = re.compile(r"[a-z0-9]+")

#: Different tags, and different names, that a block knows of its ancestors: the outermost so many. Real pages have far fewer.
KINDS = 256
#: The training pages: about this many, chosen by hash of the page's id.
SAMPLE = 600
TURNS, RATE, PENALTY = 200, 0.4, 1e-4
#: Features that come from ancestors and not from the block's own text.
NAMED = ("for", "against", "tag=", "name=")


class Element(NamedTuple):
    """An open element, with what it and its ancestors are called; sets are shared with the parent where nothing is new."""

    tag: str
    tags: frozenset[str]  # without those in PLAIN
    names: frozenset[str]  # of class, id and role
    block: str  # the nearest block element


ROOT = Element("", frozenset(), frozenset(), "none")


def _with(known: frozenset[str], more: Iterable[str]) -> frozenset[str]:
    fresh = [m for m in dict.fromkeys(more) if m not in known][: KINDS - len(known)]
    return known.union(fresh) if fresh else known


class _Blocks(HTMLParser):
    """Leaf blocks of a page: (text, innermost element, characters inside links). Takes any input, in linear time."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[Element] = []
        self.places: defaultdict[str, list[int]] = defaultdict(list)  # where on the stack a tag is open
        self.scopes: list[int] = []
        self.out: list[tuple[str, Element, int]] = []
        self.text: list[str] = []
        self.linked = self.hidden = self.links = 0

    def parse_html_declaration(self, i: int) -> int:
        """A marked section is a comment up to the next ``>`` in HTML; the parser would raise on unknown ones."""
        if not self.rawdata.startswith("<![", i):
            return super().parse_html_declaration(i)
        return self.rawdata.find(">", i) + 1 or len(self.rawdata)

    def flush(self) -> None:
        whole = _SPACE.sub(" ", "".join(self.text)).strip()
        if whole:
            self.out.append((whole, self.stack[-1] if self.stack else ROOT, self.linked))
        self.text, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.text.append(" ")
        if tag in BLOCKS:
            self.flush()
        if tag in VOID:
            return
        if tag in CLOSES:
            at = max((self.places[t][-1] for t in CLOSES[tag] if self.places[t]), default=-1)
            if at > (self.scopes[-1] if self.scopes else -1):
                self._close(at)
        over = self.stack[-1] if self.stack else ROOT
        names = [n for k, v in attrs if k in ("class", "id", "role") and v for n in _NAMES.findall(v.lower())]
        tags = over.tags if tag in PLAIN else _with(over.tags, [tag])
        if tag in SCOPES:
            self.scopes.append(len(self.stack))
        self.places[tag].append(len(self.stack))
        self.stack.append(Element(tag, tags, _with(over.names, names), tag if tag in BLOCKS else over.block))
        self.hidden += tag in HIDDEN
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if self.places[tag]:
            self._close(self.places[tag][-1])

    def _close(self, at: int) -> None:
        if any(e.tag in BLOCKS for e in self.stack[at:]):
            self.flush()
        for element in self.stack[at:]:
            self.places[element.tag].pop()
            self.hidden -= element.tag in HIDDEN
            self.links -= element.tag == "a"
        del self.stack[at:]
        while self.scopes and self.scopes[-1] >= at:
            self.scopes.pop()

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.text.append(data)
            self.linked += len(data.strip()) if self.links else 0


def leaf_blocks(html: str | None) -> list[tuple[str, Element, int]]:
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.out


def _features(blocks: list[tuple[str, Element, int]]) -> list[list[str]]:
    out = []
    for text, element, linked in blocks:
        names, every, block = element.names, element.names | element.tags, element.block
        words = text.count(" ") + 1
        here = ["bias", "words=" + str(min(9, words.bit_length())), "links=" + str(int(4 * min(1.0, linked / len(text))))]
        here.append("block=" + ("plain" if block in PLAIN else block))
        here += ["tag=" + t for t in element.tags] + ["name=" + n for n in names]
        if every & AGAINST:
            here.append("against")
        if every & FOR - {"body"}:
            here.append("for")
        here.append("end=" + ("stop" if text[-1] in ".!?…\"'»”" else "open"))
        if "©" in text:
            here.append("sign")
        out.append(here)
    return out


def _weak_label(block: tuple[str, Element, int]) -> int:
    """The label of a block on a training page whose markup tells: inside an article and nothing that speaks against."""
    element = block[1]
    return int(not element.tags.isdisjoint({"article", "main"}) and (element.names | element.tags).isdisjoint(AGAINST))


class Model:
    """Weights of the field: one per (feature, label), a transition matrix and the weights of the first label."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.index, self.weights, self.moves = index, weights, moves

    def scores(self, features: list[list[str]]) -> np.ndarray:
        index, weights = self.index, self.weights
        return np.array([weights[[index[f] for f in fs if f in index]].sum(axis=0) for fs in features]).reshape(-1, 2)

    def decode(self, features: list[list[str]]) -> list[int]:
        """The most probable labels, by Viterbi."""
        scores, moves = self.scores(features).tolist(), self.moves.tolist()
        if not scores:
            return []
        (a, b), back = scores[0], []
        for x, y in scores[1:]:
            to_a, to_b = (a + moves[0][0], b + moves[1][0]), (a + moves[0][1], b + moves[1][1])
            back.append((to_a[1] > to_a[0], to_b[1] > to_b[0]))
            a, b = max(to_a) + x, max(to_b) + y
        labels = [int(b > a)]
        for step in reversed(back):
            labels.append(int(step[labels[-1]]))
        return labels[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]]) -> Model:
    """Maximum likelihood with a ridge penalty by gradient steps of adaptive size.

    Forward and backward sums run over all pages at once, padded to the longest.
    """
    pages = [p for p in pages if p[1]]
    index = {f: i for i, f in enumerate(sorted({f for fs, _ in pages for b in fs for f in b}))}
    weights, moves = np.zeros((len(index) + 1, 2)), np.zeros((2, 2))
    if not pages:
        return Model(index, weights, moves)
    longest, count = max(len(y) for _, y in pages), len(pages)
    flat = [(p, t, index[f]) for p, (fs, _) in enumerate(pages) for t, b in enumerate(fs) for f in b]
    page, time, feature = (np.array(x) for x in zip(*flat))
    live = np.zeros((count, longest), dtype=bool)
    gold = np.zeros((count, longest), dtype=np.int64)
    for p, (_, y) in enumerate(pages):
        live[p, : len(y)], gold[p, : len(y)] = True, y
    truth = np.eye(2)[gold] * live[..., None]
    pair = live[:, 1:] & live[:, :-1]
    moved = np.array([[(pair & (gold[:, :-1] == a) & (gold[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)], dtype=float)
    total = live.sum()
    square_w, square_m = np.zeros_like(weights), np.zeros_like(moves)
    for _ in range(TURNS):
        unary = np.zeros((count, longest, 2))
        np.add.at(unary, (page, time), weights[feature])
        ahead, behind = np.zeros_like(unary), np.zeros_like(unary)
        ahead[:, 0] = unary[:, 0]
        for t in range(1, longest):
            step = np.logaddexp(ahead[:, t - 1, 0, None] + moves[0], ahead[:, t - 1, 1, None] + moves[1]) + unary[:, t]
            ahead[:, t] = np.where(live[:, t, None], step, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            after = unary[:, t + 1] + behind[:, t + 1]
            step = np.logaddexp(after[:, 0, None] + moves[:, 0], after[:, 1, None] + moves[:, 1])
            behind[:, t] = np.where(live[:, t + 1, None], step, 0.0)
        whole = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        marginal = np.exp(ahead + behind - whole[:, None, None]) * live[..., None]
        both = ahead[:, :-1, :, None] + moves + (unary + behind)[:, 1:, None, :] - whole[:, None, None, None]
        expected = (np.exp(np.minimum(both, 0.0)) * pair[..., None, None]).sum(axis=(0, 1))
        slope = np.zeros_like(weights)
        np.add.at(slope, feature, (truth - marginal)[page, time])
        slope = slope / total - PENALTY * weights
        turn = (moved - expected) / total - PENALTY * moves
        square_w, square_m = square_w + slope**2, square_m + turn**2
        weights += RATE * slope / (np.sqrt(square_w) + 1e-8)
        moves += RATE * turn / (np.sqrt(square_m) + 1e-8)
    return Model(index, weights, moves)


def fit(pages: DataFrame, id_col: str, html_col: str, sample: int = SAMPLE) -> Model:
    """A model from about ``sample`` of the pages whose markup has an article, labelled by that markup.

    Every page is seen three times: as it is; without what its ancestors are named, so that the text's own features get
    weights that carry over to pages without such names; and with every main block
    followed by the same block under an ancestor that speaks against it, so that this outweighs good prose anywhere.
    """
    telling = pages.where(F.col(html_col).rlike(r"(?i)<(article|main)[\s/>]"))
    share = min(2**30, 2**30 * sample // max(1, telling.count()))
    chosen = telling.where(F.pmod(F.xxhash64(id_col), F.lit(2**30)) < share).select(F.col(html_col).alias("html"))

    def learn(_: tuple, chunk: pd.DataFrame) -> pd.DataFrame:
        examples = []
        for html in sorted(chunk["html"].dropna()):
            blocks = leaf_blocks(html)
            labels = [_weak_label(b) for b in blocks]
            if any(labels):
                features = _features(blocks)
                bare = [[f for f in fs if f != "for" and not f.startswith(("tag=", "name="))] for fs in features]
                main = [fs for fs, y in zip(features, labels) if y]
                prose = [fs for m in main for fs in (m, ["against", "for", "tag=article", "tag=p", *(f for f in m if not f.startswith(NAMED))])]
                examples += [(features, labels), (bare, labels), (prose, [1, 0] * len(main))]
        model = train(examples)
        names = list(model.index)
        return pd.DataFrame({"names": [names], "weights": [model.weights.ravel().tolist()], "moves": [model.moves.ravel().tolist()]})

    rows = chosen.groupBy(F.lit(1).alias("one")).applyInPandas(learn, "names array<string>, weights array<double>, moves array<double>").collect()
    if not rows:
        return Model({}, np.zeros((1, 2)), np.zeros((2, 2)))
    row = rows[0]
    return Model({n: i for i, n in enumerate(row["names"])}, np.array(row["weights"]).reshape(-1, 2), np.array(row["moves"]).reshape(2, 2))


def main_text(html: str | None, model: Model) -> str:
    blocks = leaf_blocks(html)
    return " ".join(text for (text, _, _), label in zip(blocks, model.decode(_features(blocks))) if label)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", model: Model | None = None) -> DataFrame:
    """``pages`` with its html replaced by text, the main text of each page (empty if none).

    A leaf block is the text between two starts or ends of block elements; character references are decoded, white
    space inside becomes one space, and main blocks are joined in page order by one space. Whole pages are read,
    however long. Null and empty pages have no text; repeated rows are extracted alike; an empty table gives an empty
    result; a column named text, in any case, is replaced, others pass through. No markup is too broken: the parser takes any input,
    in time linear to its length.

    The model is trained once, in one task, on a bounded sample; extraction is one pass without a shuffle.
    """
    model = model or fit(pages, id_col, html_col)

    @F.pandas_udf("string")
    def of(batch: pd.Series) -> pd.Series:
        return batch.map(lambda html: main_text(html, model), na_action=None)

    rows = packed(pages, whole=F.col(html_col)).select("row", of("whole").alias("text"))
    own = [c for c in unpacked(rows, ("text",)).columns if c.lower() != html_col.lower()]
    return unpacked(rows, ("text",)).select(*own)
