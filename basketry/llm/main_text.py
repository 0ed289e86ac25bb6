"""Main text of web pages by tag-path ratios.

A page becomes blocks of text, each with its root-to-leaf path of block elements (tag and first class). Blocks inside
elements that are boilerplate by tag, role or class are set aside. Over all other blocks of the page, text length
without links and punctuation are summed per path and divided by the path's blocks; both ratios are smoothed over
neighbouring blocks in page order, multiplied, and compared with a threshold drawn from their spread. A path is content
if its blocks reach the threshold on average; all its blocks are kept, short ones too. Of the other blocks those are kept
that stand beside content: in the parent element of a content path with nothing between but lists, tables, quotes,
headings and the like (``BESIDE``), unless their path is mostly links. ``article`` and ``main`` have no special part.

Defined results: null or empty html, and pages without content, give the empty text. Tags cut off at the end are
dropped, elements left open end with the page. Repeated rows are kept; extra columns are left out.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import input_columns, per_batch, table

#: share of the standard deviation of the fused ratios that makes a path content
SPREAD = 0.5
SMOOTHING = (0.25, 0.5, 0.25)

# Elements of HTML, by what they mean here.
BLOCKS = frozenset(
    "html head body title p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table thead tbody tfoot tr td th caption section "
    "article main header footer nav aside blockquote pre form fieldset figure figcaption address details summary "
    "dialog center hr menu search template noscript select button option iframe object svg canvas audio video".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE_TAGS = frozenset(
    "head title header footer nav aside form menu dialog search template noscript select button option iframe object "
    "svg canvas audio video fieldset".split()
)
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side menu nav "
    "navbar navigation breadcrumb breadcrumbs header masthead footer foot notice notices cookie cookies consent gdpr "
    "alert popup modal overlay comment comments discussion disqus reply replies respond share sharing social related "
    "recommended newsletter subscribe subscription signup login search widget toolbar pagination pager legal "
    "disclaimer copyright form skip hidden".split()
)
BESIDE = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption".split()
)
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
BARRIERS = frozenset("ul ol dl table body article section div main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|xmp|noembed|noframes)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?=[\s=/]|$)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME_PART = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")


class Element:
    __slots__ = ("tag", "label", "boilerplate")

    def __init__(self, tag: str, label: str, boilerplate: bool):
        self.tag, self.label, self.boilerplate = tag, label, boilerplate


def open_element(tag: str, attributes: str) -> Element:
    label, boilerplate = tag, tag in BOILERPLATE_TAGS
    if attributes:
        for match in _ATTRIBUTE.finditer(attributes):
            name, value = match[1].lower(), (match[2] or match[3] or match[4] or "").lower()
            if name in ("class", "id"):
                if name == "class" and value.split():
                    label = f"{tag}.{value.split()[0]}"
                # body and article often carry classes of the site's theme
                if tag not in ("html", "body", "article", "main"):
                    boilerplate |= not BOILERPLATE_WORDS.isdisjoint(_NAME_PART.findall(value))
            elif name == "role":
                boilerplate |= value in BOILERPLATE_ROLES
            elif name == "hidden":
                boilerplate = True
            elif name == "aria-hidden":
                boilerplate |= value == "true"
            else:
                boilerplate |= "display:none" in value.replace(" ", "")
    return Element(tag, label, boilerplate)


class Block:
    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple[str, ...], text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


def blocks_of(page: str) -> Iterator[Block]:
    """The blocks outside boilerplate, in page order."""
    stack: list[Element] = []
    pieces: list[str] = []
    linked = in_link = 0
    at = 0

    def finish() -> Iterator[Block]:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text and not any(element.boilerplate for element in stack):
                yield Block(tuple(element.label for element in stack), text, min(linked, len(text)))
            pieces.clear()
        linked = 0

    def take(text: str) -> None:
        nonlocal linked
        if text:
            if "&" in text:
                text = html.unescape(text)
            pieces.append(text)
            if in_link:
                linked += len(text)

    for match in _TOKEN.finditer(page):
        if match.start() > at:
            take(page[at : match.start()])
        at = match.end()
        tag = (match[3] or match[6] or "").lower()
        if not tag:
            continue
        closing, attributes = match[2] or match[5], match[4] or match[7] or ""
        if tag == "a":
            in_link = 0 if closing else 1
        elif tag in ("br", "wbr", "img"):
            if tag == "br":
                pieces.append(" ")
        elif tag in BLOCKS:
            yield from finish()
            if closing:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth].tag == tag:
                        del stack[depth:]
                        break
            elif tag not in VOID:
                if stack and stack[-1].tag == "p":
                    stack.pop()
                if tag in CLOSES:
                    for depth in range(len(stack) - 1, -1, -1):
                        if stack[depth].tag in CLOSES[tag]:
                            del stack[depth:]
                            break
                        if stack[depth].tag in BARRIERS:
                            break
                if not attributes.rstrip().endswith("/") or tag in BLOCKS:
                    stack.append(open_element(tag, attributes))
            in_link = 0
    if at < len(page):
        take(page[at:])
    yield from finish()


def content_paths(blocks: list[Block]) -> set[tuple[str, ...]]:
    """Paths whose smoothed and fused ratios reach the threshold."""
    sums: dict[tuple[str, ...], list[int]] = {}
    for block in blocks:
        entry = sums.setdefault(block.path, [0, 0, 0])
        entry[0] += len(block.text) - block.linked
        entry[1] += len(_PUNCTUATION.findall(block.text))
        entry[2] += 1
    paths = list(sums)
    if len(paths) == 1:
        return set(paths)
    number_of = {path: number for number, path in enumerate(paths)}
    at = np.array([number_of[block.path] for block in blocks])
    numbers = np.array([sums[path] for path in paths], float)
    left, middle, right = SMOOTHING

    def smooth(values: np.ndarray) -> np.ndarray:
        around = np.concatenate((values[:1], values, values[-1:]))
        return left * around[:-2] + middle * around[1:-1] + right * around[2:]

    fused = smooth((numbers[:, 0] / numbers[:, 2])[at]) * smooth(((1 + numbers[:, 1]) / numbers[:, 2])[at]) * np.log1p(numbers[:, 0])[at]
    means = np.bincount(at, fused) / numbers[:, 2]
    threshold = min(SPREAD * float(fused.std()), float(means.max()))
    return {path for path, value in zip(paths, means, strict=True) if value >= threshold}


def beside(blocks: list[Block], content: set[tuple[str, ...]]) -> set[tuple[str, ...]]:
    """Other paths that stand beside content and are not mostly links."""
    parents = {path[:-1] for path in content}
    sums: dict[tuple[str, ...], list[int]] = {}
    for block in blocks:
        if block.path not in content:
            entry = sums.setdefault(block.path, [0, 0])
            entry[0] += block.linked
            entry[1] += len(block.text)
    found = set()
    for path, (linked, size) in sums.items():
        if 2 * linked < size:
            depth = len(path)
            while depth and path[depth - 1].partition(".")[0] in BESIDE:
                depth -= 1
                if path[:depth] in parents:
                    found.add(path)
                    break
    return found


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = list(blocks_of(page))
    if not blocks:
        return ""
    content = content_paths(blocks)
    kept = content | beside(blocks, content)
    return "\n".join(block.text for block in blocks if block.path in kept)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """A row per page: page_id, url, text, n_chars."""
    rows = input_columns(pages, page_id=page_id, url=url, body=body).withColumn("body", F.col("body").cast("string"))
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page) for page in batch.column("body").to_pylist()]
        return pa.RecordBatch.from_pydict(
            {
                "page_id": batch.column("page_id"),
                "url": batch.column("url"),
                "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(text) for text in texts], pa.int64()),
            }
        )

    return per_batch(rows, run, f"page_id {kind}, url string, text string, n_chars long")


def op7(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
