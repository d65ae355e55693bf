"""Product cards out of shop pages.

Each page is parsed by itself inside ``mapInArrow`` (no shuffle);
prices stay text there and become numbers in Catalyst expressions afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.prices import FIRST_NUMBER, discount_pct, price_first, price_kes, price_swap

VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
SNIPPET_LENGTH = 500


class _Node:
    __slots__ = ("tag", "attrs", "children", "start", "end", "classes", "_all", "_at", "_stop")

    def __init__(self, tag: str, attrs: dict[str, str], start: int, nodes: list[_Node]):
        self.tag, self.attrs, self.start, self.end = tag, attrs, start, start
        self.children: list = []
        self.classes = attrs["class"].split() if "class" in attrs else ()
        # All nodes of the page in document order; those below this one stand behind it.
        self._all, self._at, self._stop = nodes, len(nodes), len(nodes) + 1
        nodes.append(self)

    def closed(self, end: int) -> None:
        self.end, self._stop = end, len(self._all)

    def walk(self) -> list[_Node]:
        return self._all[self._at + 1 : self._stop]

    def strings(self):
        """Texts in order, without those of scripts and styles; without recursion (pages may nest deeply)."""
        todo = [(self, iter(self.children))]
        while todo:
            node, items = todo[-1]
            for item in items:
                if isinstance(item, _Node):
                    todo.append((item, iter(item.children)))
                    break
                if node.tag not in ("script", "style"):
                    yield item
            else:
                todo.pop()


class _Tree(HTMLParser):
    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self._lines = [0] + [m.end() for m in re.finditer("\n", html)]
        self._nodes: list[_Node] = []
        self.root = _Node("", {}, 0, self._nodes)
        self._open = [self.root]
        self.feed(html)
        self.close()
        for node in self._open:
            node.closed(len(html))

    def _offset(self) -> int:
        line, column = self.getpos()
        return self._lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        start = self._offset()
        node = _Node(tag, {k: v or "" for k, v in reversed(attrs)}, start, self._nodes)
        node.end = start + len(self.get_starttag_text() or "")
        self._open[-1].children.append(node)
        if tag not in VOID_TAGS:
            self._open.append(node)

    def handle_endtag(self, tag):
        for depth in range(len(self._open) - 1, 0, -1):
            if self._open[depth].tag == tag:
                end = self._offset()
                for node in self._open[depth:]:
                    node.closed(end)
                self._open[depth].end = end + len(tag) + 3
                del self._open[depth:]
                return

    def handle_data(self, data):
        self._open[-1].children.append(data)


_COMPOUND = re.compile(r'\[([\w-]+)="([^"]*)"\]|\.([\w-]+)|([\w-]+)')


@lru_cache(maxsize=None)
def _steps(selector: str) -> tuple:
    """'a.b [c="d"] e' as (tag, classes, attributes) per step."""
    steps = []
    for compound in re.findall(r'(?:\[[^\]]*\]|[^\s\[])+', selector):
        parts = _COMPOUND.findall(compound)
        steps.append(
            (
                next((tag for *_, tag in parts if tag), None),
                tuple(cls for _, _, cls, _ in parts if cls),
                tuple((attr, value) for attr, value, _, _ in parts if attr),
            )
        )
    return tuple(steps)


def _fits(node: _Node, step: tuple) -> bool:
    tag, classes, attrs = step
    if tag is not None and node.tag != tag:
        return False
    if attrs and any(node.attrs.get(a) != v for a, v in attrs):
        return False
    return not classes or all(c in node.classes for c in classes)


def _matches(node: _Node, steps: tuple):
    """Descendants that fit the steps, in document order."""
    if len(steps) == 1:
        return (inner for inner in node.walk() if _fits(inner, steps[0]))
    seen: dict[int, _Node] = {}
    for base in node.walk():
        if _fits(base, steps[0]):
            for inner in _matches(base, steps[1:]):
                seen.setdefault(id(inner), inner)
    return iter(seen.values())


def _first(node: _Node, steps: tuple, at: int = 0) -> _Node | None:
    """The first of ``_matches``, without looking for the others."""
    tag, classes, attrs = step = steps[at]
    for inner in node.walk():
        if (tag is None or inner.tag == tag) and (not (classes or attrs) or _fits(inner, step)):
            found = inner if at + 1 == len(steps) else _first(inner, steps, at + 1)
            if found is not None:
                return found
    return None


def _one(node: _Node, selector: str | None) -> _Node | None:
    return _first(node, _steps(selector)) if selector else None


def _stripped(node: _Node | None) -> str | None:
    return None if node is None else "".join(s.strip() for s in node.strings())


@dataclass(frozen=True)
class SiteSpec:
    """Where the fields of a shop's cards are.

    Prices are lists of (selector, attribute or None for the text), first one
    present wins; with ``price_box`` they are looked for in the card's first such
    element only, and an empty selector is that element itself. With ``on_sale`` present in the card, the sale lists apply.
    ``required`` attributes make a card that has the element without the attribute
    a bad card, which is skipped.
    """

    card: str
    name: str
    url: tuple[str | None, bool] = (None, False)
    images: tuple[str, ...] = ("img",)
    image_required: bool = False
    current: tuple[tuple[str, str | None], ...] = ()
    original: tuple[tuple[str, str | None], ...] = ()
    price_box: str | None = None
    on_sale: str | None = None
    sale_current: tuple[tuple[str, str | None], ...] = ()
    sale_original: tuple[tuple[str, str | None], ...] = ()
    badge: str | None = None
    ids: dict[str, tuple[str | None, str, bool]] = field(default_factory=dict)
    currency_first: bool = False
    swap: bool = False


# The card layouts of the four supported shops.
SITES = {
    "shop_list": SiteSpec(
        card="li.product",
        name="h2.woocommerce-loop-product__title",
        url=("a", True),
        image_required=True,
        price_box=".price",
        current=(("", None),),
        on_sale="ins",
        sale_current=(("ins", None),),
        sale_original=(("del", None),),
    ),
    "shop_cart": SiteSpec(
        card="ul.products li.product",
        name=".woocommerce-loop-product__title",
        url=("a", True),
        images=("img.attachment-woocommerce_thumbnail", "img"),
        price_box=".price",
        current=((".woocommerce-Price-amount bdi", None), ("", None)),
        on_sale="ins .woocommerce-Price-amount bdi",
        sale_current=(("ins .woocommerce-Price-amount bdi", None),),
        sale_original=(("del .woocommerce-Price-amount bdi", None),),
        badge=".onsale",
        ids={
            "product_id": ("a.add_to_cart_button", "data-product_id", False),
            "product_sku": ("a.add_to_cart_button", "data-product_sku", False),
        },
    ),
    "grid_item": SiteSpec(
        card='li[data-hook="product-list-grid-item"]',
        name='[data-hook="product-item-name"]',
        url=('[data-hook="product-item-container"]', True),
        images=("wow-image img",),
        current=(
            ('[data-hook="product-item-price-to-pay"]', "data-wix-price"),
            ('[data-hook="product-item-price-to-pay"]', None),
        ),
        original=(
            ('[data-hook="product-item-price-before-discount"]', "data-wix-original-price"),
            ('[data-hook="product-item-price-before-discount"]', None),
        ),
        badge='[data-hook="RibbonDataHook.RibbonOnImage"]',
        swap=True,
    ),
    "card_link": SiteSpec(
        card='a[class="card product-card"]',
        name="h5.product-title",
        url=(None, False),
        images=("img.product-img",),
        image_required=True,
        current=(("p.product-price", None),),
        original=(("p.product-price-old", None),),
        badge="span.sale-badge",
        ids={
            "product_id": (None, "data-product-id", False),
            "item_no": ("button.btn-cart", "data-itemno", True),
        },
        currency_first=True,
    ),
}

TEXT_FIELDS = [
    "product_name", "url", "image_url", "current_text", "original_text", "discount_badge",
    "product_id", "product_sku", "item_no", "full_html_snippet",
]


class _BadCard(Exception):
    pass


def _attr(node: _Node | None, name: str, required: bool) -> str | None:
    if node is None:
        return None
    if required and name not in node.attrs:
        raise _BadCard(name)
    return node.attrs.get(name)


def _price(box: _Node, places) -> str | None:
    for selector, attribute in places:
        node = _one(box, selector) if selector else box
        if node is None:
            continue
        text = node.attrs.get(attribute) if attribute else "".join(node.strings())
        if text or not attribute:
            return text
    return None


def _read_card(card: _Node, spec: SiteSpec, html: str, snippet: int) -> dict[str, str | None]:
    out = dict.fromkeys(TEXT_FIELDS)
    out["product_name"] = _stripped(_one(card, spec.name))
    selector, required = spec.url
    out["url"] = _attr(_one(card, selector) if selector else card, "href", required)
    image = next((n for n in (_one(card, s) for s in spec.images) if n is not None), None)
    out["image_url"] = _attr(image, "src", spec.image_required)
    box = _one(card, spec.price_box) if spec.price_box else card
    if box is not None:
        sale = spec.on_sale is not None and _one(box, spec.on_sale) is not None
        out["current_text"] = _price(box, spec.sale_current if sale else spec.current)
        out["original_text"] = _price(box, spec.sale_original if sale else spec.original)
    out["discount_badge"] = _stripped(_one(card, spec.badge))
    for name, (where, attribute, must) in spec.ids.items():
        out[name] = _attr(_one(card, where) if where else card, attribute, must)
    out["full_html_snippet"] = html[card.start : card.end][:snippet]
    return out


def page_cards(html: str, spec: SiteSpec, snippet: int = SNIPPET_LENGTH) -> list[dict[str, str | None]]:
    """The cards of one page in page order; bad cards are left out."""
    rows = []
    for position, card in enumerate(_matches(_Tree(html).root, _steps(spec.card))):
        try:
            rows.append({"position": position, **_read_card(card, spec, html, snippet)})
        except _BadCard:
            continue
    return rows


def extract_cards(pages: DataFrame, spec: SiteSpec, html: str = "html", keep: list[str] | None = None, snippet: int = SNIPPET_LENGTH) -> DataFrame:
    """One row per product card that has a name and a price.

    ``full_html_snippet`` is the first ``snippet`` characters of the card's source.
    """
    keep = keep or []
    schema = ", ".join(
        [f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keep]
        + ["position int"] + [f"{c} string" for c in TEXT_FIELDS]
    )
    columns = keep + ["position"] + TEXT_FIELDS

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(row, card) for row, page in enumerate(batch.column(len(keep)).to_pylist()) if page for card in page_cards(page, spec, snippet)]
            rows = pa.array([row for row, _ in found], pa.int64())
            cells = [pa.array([card["position"] for _, card in found], pa.int32())]
            cells += [pa.array([card[c] for _, card in found], pa.string()) for c in TEXT_FIELDS]
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(rows) for i in range(len(keep))), *cells], names=columns)

    texts = pages.select(*keep, html).mapInArrow(parse, schema)
    read = price_kes if spec.currency_first else price_first
    current, original = read("current_text"), read("original_text")
    # A text with a number that cannot be read makes a bad card.
    unreadable = (F.regexp_extract("original_text", FIRST_NUMBER, 0) != "") & original.isNull()
    priced = texts.filter(~F.coalesce(unreadable, F.lit(False))).select(
        *columns, current.alias("_current"), original.alias("_original")
    )
    if spec.swap:
        now, before = price_swap("_current", "_original")
    else:
        now, before = F.col("_current"), F.col("_original")
    return (
        priced.withColumn("current_price", now)
        .withColumn("original_price", before)
        .withColumn("discount_percentage", discount_pct("current_price", "original_price"))
        .filter((F.col("product_name") != "") & (F.col("current_price") != 0))
        .drop("_current", "_original", "current_text", "original_text")
    )
