"""Main text of web pages by a linear-chain conditional random field over their text blocks.

A block is a run of text between block-level tags. Its features are the tags,
classes and ids it stands in and the shape of its text; the field labels each
block of a page as main text or not, and Viterbi decoding takes the best
labels of the whole page together.

The field is fitted on a bounded sample of pages that label themselves: what
stands in the article element, or in main where there is none, is main text
unless a nested aside, form, navigation, header or footer holds it. Each such page is
learnt from as it is, and once more with the telling element renamed and with
notices, forms, adverts, sidebars and reader comments of its own words put
around and into it, so that the other features are learnt too.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

SAMPLE = 400  # pages the field is fitted on, at most
BITS = 14
EPOCHS = 6

# Elements (fixed values).
SILENT = frozenset("script style template svg head title iframe select textarea canvas annotation annotation-xml".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i img ins kbd label mark q s samp small span strong sub "
                   "sup time tt u var wbr br acronym big "
               "math maction menclose mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup "
               "mtable mtd mtext mtr munder munderover semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROOTS = ("article", "main")
OUTSIDE = frozenset("aside form nav header footer".split())
# What the names of classes and ids tell, by their beginnings.
HINTS = ("nav", "menu", "head", "foot", "side", "ad", "advert", "banner", "comment", "reply", "cookie", "notice", "consent",
         "popup", "share", "social", "related", "promo", "sponsor", "form", "login", "newsletter", "subscribe", "breadcrumb",
         "tag", "widget", "legal", "copyright", "pager", "article", "content", "main", "post", "entry", "story", "body", "text")

# A tag ends at its >, at the next < outside quotes, or with the page, so that every character is looked at a few times only.
_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'<]+|[\"'])*+)(?:>|(?=<)|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'=/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_TELLING = frozenset("class id role itemprop hidden".split())
_EMPTY = re.compile(r"(?:^|[\s\"'])/\s*\Z")  # a stroke that ends the tag and no attribute's value
_NAMES = re.compile(r"[a-z]+")


class Element:
    """An open element and what the elements around it tell; sets are shared with its parent where nothing is new."""

    __slots__ = ("name", "tags", "hints", "label", "clean")

    def __init__(self, name: str, hints: list[str], label: int | None, parent: Element | None):
        tags, old, clean = (parent.tags, parent.hints, parent.clean) if parent else (frozenset(), frozenset(), frozenset())
        self.name = name
        # Roots that stand around a text without an element between that is never main text.
        self.clean = (frozenset() if name in OUTSIDE else clean) | ({name} if name in ROOTS and name not in tags else set())
        self.tags = tags if name in tags else tags | {name}
        self.hints = old if old.issuperset(hints) else old | set(hints)
        self.label = label if label is not None or not parent else parent.label


class Block:
    """A text with the elements it stands in and the characters of it that stand in links."""

    __slots__ = ("text", "linked", "own", "tags", "hints", "label", "clean")

    def __init__(self, text: str, top: Element | None, linked: int):
        self.text, self.linked = text, linked
        self.own = top.name if top else ""
        self.tags, self.hints, self.clean = (top.tags, top.hints, top.clean) if top else (frozenset(),) * 3
        self.label = top.label if top else None


class Varied(str):
    """A page whose labels stand in the attribute ``mark``, a name that the page it was made from does not hold."""

    mark: str


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order; white space inside is one space, references are decoded.

    Labels are read from a ``Varied`` page only.
    """
    mark_name = getattr(page, "mark", None)
    found: list[Block] = []
    stack: list[Element] = []
    still_open: Counter[str] = Counter()
    never_closed: set[str] = set()
    pieces: list[tuple[str, bool]] = []
    links, at, size = 0, 0, len(page)

    def flush() -> None:
        if pieces:
            text = " ".join("".join(p for p, _ in pieces).split())
            if text:
                found.append(Block(text, stack[-1] if stack else None, sum(len(p.strip()) for p, linked in pieces if linked)))
            pieces.clear()

    while at < size:
        mark = _MARK.search(page, at)
        end = mark.start() if mark else size
        if end > at:
            pieces.append((html.unescape(page[at:end]), links > 0))
        if not mark:
            break
        at = mark.end()
        name = (mark.group(2) or "").lower()
        if not name:
            continue
        closing = bool(mark.group(1))
        if name in INLINE:
            if name == "a":
                links = max(0, links - 1) if closing else 1
            elif name == "br":
                pieces.append((" ", False))
            continue
        flush()
        links = 0
        if closing:
            while still_open[name]:
                gone = stack.pop().name
                still_open[gone] -= 1
                if gone == name:
                    break
            continue
        if name in SILENT and _EMPTY.search(mark.group(3)):
            continue
        if name in SILENT:
            close = None if name in never_closed else re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if not close:
                never_closed.add(name)
            at = close.end() if close else (size if name in ("script", "style") else at)
            continue
        if name in VOID or mark.group(3).rstrip().endswith("/"):
            continue
        # A paragraph or list item that is still open ends where its like or a new block begins.
        while stack and stack[-1].name in ("p", "li", "dt", "dd", "option") and stack[-1].name in ("p", name):
            still_open[stack.pop().name] -= 1
        hints, label = [], None
        for key, value in _ATTRIBUTE.findall(mark.group(3)):
            key, value = key.lower(), value.strip("\"'").lower()
            if key == mark_name:
                label = int(value)
            elif key in _TELLING:
                words = _NAMES.findall(value)
                hints += [h for w in words for h in HINTS if w == h or (len(h) > 3 and w.startswith(h))]
        stack.append(Element(name, hints, label, stack[-1] if stack else None))
        still_open[name] += 1
    flush()
    return found


def features(page: list[Block]) -> list[list[int]]:
    """Hashed features of each block."""
    out, n = [], len(page)
    for i, b in enumerate(page):
        words = b.text.split()
        size = len(b.text)
        last = b.text[-1]
        names = ["bias", f"own:{b.own}", f"words:{min(len(words), 3) if len(words) < 4 else 3 + len(words).bit_length()}",
                 f"links:{round(4 * min(b.linked, size) / size)}", f"end:{last if not last.isalnum() else 'a'}",
                 f"caps:{b.text.isupper()}", f"mark:{'©' in b.text or '|' in b.text}", f"first:{i == 0}", f"last:{i == n - 1}",
                 f"digits:{sum(c.isdigit() for c in b.text) * 5 // size}"]
        names += [f"in:{t}" for t in b.tags]
        names += [f"is:{h}" for h in b.hints]
        out.append([zlib.crc32(x.encode()) & ((1 << BITS) - 1) for x in names])
    return out


def _labels(page: list[Block]) -> np.ndarray | None:
    if any(b.label is not None for b in page):
        return np.array([b.label or 0 for b in page])
    for root in ROOTS:
        if any(root in b.tags for b in page):
            return np.array([int(root in b.clean) for b in page])
    return None


def varied(page: str, rng: np.random.Generator) -> Varied | None:
    """The page with its telling element renamed and boilerplate of its own words put around and into it."""
    begin, end = page.find("<article"), page.rfind("</article>")
    if begin < 0 or end < begin:
        return None
    start = page.find(">", begin) + 1
    mark = "data-y"
    while mark in page.lower():
        mark += "y"
    words = re.sub(r"<[^>]*>", " ", page[start:end]).split()[:400] or ["x"]

    def some(n: int) -> str:
        return " ".join(words[int(i)] for i in rng.integers(0, len(words), n))

    def extra() -> str:
        kind = rng.integers(0, 9)
        t = [some(int(rng.integers(2, 25))) for _ in range(3)]
        return [
            f'<aside {mark}="0"><h3>{t[0][:30]}</h3><p>{t[1]}</p></aside>',
            f'<div class="sidebar" {mark}="0"><h3>{t[0][:30]}</h3><p>{t[1]}</p></div>',
            f'<div class="cookie-notice" {mark}="0"><p>{t[0]}</p></div>',
            f'<form {mark}="0"><p>{t[0]}</p><label>{t[1][:20]}</label></form>',
            f'<section id="comments" {mark}="0"><h3>{t[2][:20]}</h3><div class="comment"><p>{t[0]}</p></div><div class="comment"><p>{t[1]}</p></div></section>',
            f'<div class="advert" {mark}="0">{t[0]}</div>',
            f'<div class="related" {mark}="0"><ul><li><a href="#">{t[0]}</a></li><li><a href="#">{t[1]}</a></li></ul></div>',
            f'<header {mark}="0"><p>{t[0]}</p></header>',
            f'<div class="share" {mark}="0"><a href="#">{t[0][:12]}</a> <a href="#">{t[1][:12]}</a></div>',
        ][kind]

    name = ["article", "main", 'div class="content"', 'div class="post"', 'div id="main"', "section", "div", 'div class="entry"'][rng.integers(0, 8)]
    inner, tag = page[start:end], name.split()[0]
    for _ in range(rng.integers(0, 3)):
        cuts = [m.start() for m in re.finditer("<p>", inner)][1:] or [len(inner)]
        cut = cuts[rng.integers(0, len(cuts))]
        # An open paragraph ends before the insertion, as the next one would end it.
        inner = inner[:cut] + extra() + inner[cut:]
    before = "".join(extra() for _ in range(rng.integers(0, 3)))
    after = "".join(extra() for _ in range(rng.integers(0, 4)))
    out = Varied(f'{page[:begin]}{before}<{name} {mark}="1">{inner}</{tag}>{after}{page[end + len("</article>"):]}')
    out.mark = mark
    return out


class Field:
    """Weights of the features for main text, and of the steps between labels."""

    def __init__(self, emission: np.ndarray, step: np.ndarray):
        self.emission, self.step = emission, step

    def scores(self, page: list[list[int]]) -> np.ndarray:
        return np.array([self.emission[f].sum() for f in page])

    def decode(self, page: list[list[int]]) -> list[int]:
        """Best labels by Viterbi."""
        s = self.step.tolist()
        best, back = [0.0, 0.0], []
        for i, score in enumerate(self.scores(page).tolist()):
            if i == 0:
                best = [0.0, score]
                continue
            stay, fall = best[0] + s[0][0], best[1] + s[1][0]
            rise, hold = best[0] + s[0][1], best[1] + s[1][1]
            back.append((int(fall > stay), int(hold > rise)))
            best = [max(stay, fall), max(rise, hold) + score]
        label = int(best[1] > best[0])
        out = [label]
        for b in reversed(back):
            label = b[label]
            out.append(label)
        return out[::-1]

    def gradient(self, page: list[list[int]], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(of each block's score, of the steps) of the log-likelihood, by the forward-backward sums."""
        score, n = self.scores(page), len(page)
        alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
        alpha[0] = (0.0, score[0])
        for i in range(1, n):
            alpha[i] = np.logaddexp(alpha[i - 1, 0] + self.step[0], alpha[i - 1, 1] + self.step[1])
            alpha[i, 1] += score[i]
        emit = np.stack([np.zeros(n), score], axis=1)
        for i in range(n - 2, -1, -1):
            onward = self.step + emit[i + 1] + beta[i + 1]
            beta[i] = np.logaddexp(onward[:, 0], onward[:, 1])
        total = np.logaddexp(*alpha[-1])
        main = np.exp(alpha[:, 1] + beta[:, 1] - total)
        steps = np.zeros((2, 2))
        for i in range(n - 1):
            steps[labels[i], labels[i + 1]] += 1
            steps -= np.exp(alpha[i][:, None] + self.step + emit[i + 1] + beta[i + 1] - total)
        return labels - main, steps


def fit(pages: list[str], epochs: int = EPOCHS, rate: float = 0.3, seed: int = 7) -> Field:
    rng = np.random.default_rng(seed)
    examples = []
    for page in pages:
        for version in (page, varied(page, rng), varied(page, rng)):
            found = blocks(version) if version else []
            labels = _labels(found) if found else None
            if labels is not None:
                examples.append((features(found), labels))
    field = Field(np.zeros(1 << BITS), np.zeros((2, 2)))
    squares, step_squares = np.full(1 << BITS, 1e-2), np.full((2, 2), 1e-2)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            page, labels = examples[i]
            blame, steps = field.gradient(page, labels)
            at = np.concatenate([np.asarray(f) for f in page])
            slots, place = np.unique(at, return_inverse=True)
            grad = np.bincount(place, np.repeat(blame, [len(f) for f in page]), len(slots)) - 1e-3 * field.emission[slots]
            squares[slots] += grad * grad
            field.emission[slots] += rate * grad / np.sqrt(squares[slots])
            step_squares += steps * steps
            field.step += rate * steps / np.sqrt(step_squares)
    return field


def _fit(key, rows: pa.Table) -> pa.Table:
    field = fit(rows.sort_by([("order", "ascending"), ("html", "ascending")]).column("html").to_pylist())
    return pa.table({"emission": pa.array([field.emission.tobytes()], pa.binary()), "step": pa.array([field.step.tobytes()], pa.binary())})


def train(pages: DataFrame, markup: str = "html", sample: int = SAMPLE) -> DataFrame:
    """One row (emission, step), fitted on ``sample`` pages at most that label themselves, chosen by a hash of the page."""
    own = pages.select(F.col(f"`{markup}`").cast("string").alias("html")).filter(
        F.col("html").contains("<article") | F.col("html").contains("<main"))
    order = F.pmod(F.xxhash64("html"), F.lit(1_000_000_000))
    share = min(1.0, sample / max(1, own.count()))
    chosen = own.withColumn("order", order).filter(F.col("order") < int(share * 1_000_000_000)).withColumn("group", F.lit(0))
    return staged(chosen.groupBy("group").applyInArrow(
        lambda key, rows: _fit(key, rows), "emission binary, step binary"), "html-field")


def main_text(page: str, field: Field | None) -> str:
    """Main blocks joined by a line feed. Without a field, as no page labelled itself, every block is main text."""
    found = blocks(page)
    labels = field.decode(features(found)) if field and found else [1] * len(found)
    return "\n".join(b.text for b, y in zip(found, labels) if y)


def _extract(batches: Iterable[pa.RecordBatch], field: Field | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page or "", field) for page in batch.column("html").to_pylist()]
        yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                               pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", markup: str = "html", sample: int = SAMPLE) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    A null or empty page, and one without main text, has an empty text. Rows
    and their number are unchanged, repeated ones included; other columns are
    not read; an empty table gives an empty result.
    """
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                        F.col(f"`{markup}`").cast("string").alias("html"))
    found = train(rows, "html", sample).first()
    field = Field(np.frombuffer(found.emission), np.frombuffer(found.step).reshape(2, 2)) if found else None
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(lambda b: _extract(b, field), f"page_id {kind}, url string, text string, n_chars long")
