"""Anonymiser, product cards, parse results, extraction."""

import hashlib
import hmac
import json
import re

import pytest
from pyspark.sql import functions as F

from carelake.operators.anonymize import anonymize, hmac_sha256
from carelake.operators.cards import SITES, extract_cards, page_cards
from carelake.operators.documents import (
    extract_documents, first_failures, markdown_pick, page_links, parse_by_json_schema, run_summary,
    struct_from_json_schema, text_from_parse_json,
)
from carelake.plans.products import product_snapshot
from carelake.schemas import note_schema
from conftest import rows

SALT = "pepper"


def expected_token(value, prefix):
    digest = hmac.new(SALT.encode(), value.strip().encode(), hashlib.sha256).hexdigest().upper()
    return f"{prefix}-{digest[:10]}"


def expected_text(text):
    """The rule in Python's regular expressions: the yardstick."""
    text = re.sub(r"(?i)\bIP\s*NO\s*:\s*([^\n\r]+)", lambda m: "IP NO: " + expected_token(m[1], "IP"), text)
    return re.sub(r"(?i)\bNAME\s*:\s*([^\n\r]+)", lambda m: "NAME: " + expected_token(m[1], "NM"), text)


TEXTS = [
    "NAME: Jane Doe\nIP NO: 123",
    "name :\n\n  Jane  \nrest",
    "SURNAME: keep\nUser name: x",
    "IP NO: 5 NAME: same line",
    "ip no :\x1c7\r\nnext",
    "ÉNAME: no word start, _NAME: no, 9NAME: no, -NAME: yes",
    "NAME:",
    "NAME:  \n",
    "NAME:\n",
    "IPNO:1\nIP  NO :2\n\nNAME: é ü 漢字",
    "NAME: a\u0085b c",
    "no label at all",
    "",
    "x\nNAME: tail\n\n",
    "NAME: $1 \\1 {}",
    "naMe:\x1f\x1f z \x1f",
]


def test_anonymize_equals_python(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    got = dict(df.select("i", anonymize("text", SALT)).collect())
    for i, text in enumerate(TEXTS):
        assert got[i] == expected_text(text), repr(text)


def test_anonymize_whole_documents(spark, inputs):
    headed = F.concat(F.lit("NAME: "), "source", F.lit("\nIP NO: "), F.col("doc_id") % 97, F.lit("\n"), "text", F.lit("\nname: "), "lang")
    df = inputs("documents").select(headed.alias("text"))
    for text, out in df.select("text", anonymize("text", SALT)).collect():
        assert out == expected_text(text)


@pytest.mark.parametrize("salt", ["", "k" * 64, "k" * 65, "ключ"])
def test_hmac(spark, salt):
    df = spark.createDataFrame([("a",), ("é",), ("",)], "v string")
    for value, digest in df.select("v", hmac_sha256(F.col("v"), salt)).collect():
        assert digest == hmac.new(salt.encode(), value.encode(), hashlib.sha256).hexdigest()


def test_equal_values_link(spark):
    df = spark.createDataFrame([("NAME: Jo",), ("name :  Jo ",)], "t string")
    assert df.select(anonymize("t", SALT).alias("a")).distinct().count() == 1


# ---- cards

LIST = """<ul><li class="product a"><a href="/p1"><img src="1.png"/><h2 class="woocommerce-loop-product__title"> Soap <b>X</b> </h2></a>
<span class="price"><del>KSh 1,000</del> <ins>KSh 750.50</ins></span></li>
<li class="product"><a><img src="2.png"><h2 class="woocommerce-loop-product__title">No link</h2></a><span class="price">5</span></li>
<li class="product"><a href="/p3"><img src="3.png"><h2 class="woocommerce-loop-product__title">Free</h2></a><span class="price">0</span></li>
<li class="products"><a href="/p4"><h2 class="woocommerce-loop-product__title">Other</h2></a><span class="price">7</span></li></ul>"""
CART = """<ul class="products"><li class="product"><a href="/c1"><img src="x.png"><img class="attachment-woocommerce_thumbnail" src="t.png">
<h2 class="woocommerce-loop-product__title">Cream</h2></a><span class="onsale">-20%</span>
<span class="price"><del><span class="woocommerce-Price-amount"><bdi>KSh&nbsp;500</bdi></span></del>
<ins><span class="woocommerce-Price-amount"><bdi>KSh&nbsp;400</bdi></span></ins></span>
<a class="button add_to_cart_button" data-product_id="11" data-product_sku="S11">Add</a></li></ul>
<ul class="other"><li class="product"><h2 class="woocommerce-loop-product__title">Outside</h2><span class="price">1</span></li></ul>"""
GRID = """<li data-hook="product-list-grid-item"><a data-hook="product-item-container" href="/g1"><wow-image><img src="g.png"></wow-image>
<p data-hook="product-item-name">Oil</p><span data-hook="product-item-price-before-discount" data-wix-original-price="KSh 900">900</span>
<span data-hook="RibbonDataHook.RibbonOnImage">10% OFF</span></a></li>"""
LINK = """<a class="card product-card" href="/l1" data-product-id="9"><img class="product-img" src="l.png"><h5 class="product-title">Pill</h5>
<p class="product-price">2 x KES 1,234.00</p><p class="product-price-old">,</p><button class="btn-cart" data-itemno="N1"></button></a>
<a class="card product-card" href="/l2"><img class="product-img" src="l.png"><h5 class="product-title">Tab</h5><p class="product-price">KES 10</p>
<p class="product-price-old">KES 20</p><button class="btn-cart">no number</button></a>
<a class="card product-card" href="/l3" data-product-id="8"><img class="product-img" src="l.png"><h5 class="product-title">Gel</h5>
<p class="product-price">KES 10</p><p class="product-price-old">KES 20</p><span class="sale-badge"> Sale </span></a>
<a class="product-card card" href="/l4"><h5 class="product-title">Reordered classes</h5><p class="product-price">1</p></a>"""


def cards(spark, site, html):
    return extract_cards(spark.createDataFrame([(1, html)], "page_id int, html string"), SITES[site], keep=["page_id"]).collect()


def test_list_cards(spark):
    (card,) = cards(spark, "shop_list", LIST)
    assert (card.product_name, card.url, card.image_url) == ("SoapX", "/p1", "1.png")
    assert (card.current_price, card.original_price, card.discount_percentage) == (750.5, 1000.0, 24.95)
    assert card.full_html_snippet.startswith('<li class="product a">') and card.full_html_snippet.endswith("</li>")


def test_cart_cards(spark):
    (card,) = cards(spark, "shop_cart", CART)
    assert (card.image_url, card.product_id, card.product_sku, card.discount_badge) == ("t.png", "11", "S11", "-20%")
    assert (card.current_price, card.original_price, card.discount_percentage) == (400.0, 500.0, 20.0)


def test_grid_cards_swap_prices(spark):
    (card,) = cards(spark, "grid_item", GRID)
    assert (card.current_price, card.original_price, card.discount_badge) == (900.0, None, "10% OFF")


def test_link_cards(spark):
    # The first has an unreadable old price, the second a cart button without number.
    (card,) = cards(spark, "card_link", LINK)
    assert (card.product_name, card.product_id, card.item_no) == ("Gel", "8", None)
    assert (card.current_price, card.original_price, card.discount_badge) == (10.0, 20.0, "Sale")


def test_deep_and_broken_pages(spark):
    page = "<p>" * 5000 + LIST + "</div></span>" + '<li class="product">' * 3
    assert [c["product_name"] for c in page_cards(page, SITES["shop_list"])][0] == "SoapX"
    assert cards(spark, "shop_list", "") == []
    long = page_cards(LIST.replace("Soap", "S" * 2000), SITES["shop_list"])[0]
    assert len(long["full_html_snippet"]) == 500 and len(long["product_name"]) == 2001


def test_snapshot_keeps_first_in_page_order(spark):
    second = LIST.replace("/p1", "/later")
    pages = spark.createDataFrame([(2, second), (1, LIST)], "page_id int, html string")
    (row,) = product_snapshot(pages, SITES["shop_list"], "2024-01-01 00:00:00").collect()
    assert row.url == "/p1"


# ---- parse results, schema, extraction

@pytest.mark.parametrize(
    "body, text",
    [
        ({"text": "a", "content": "b"}, "a"),
        ({"text": " ", "document_text": 5, "content": "b"}, "b"),
        ({"pages": [{"text": "a"}, {"content": "b"}, {"blocks": [{"text": "c"}, {"text": 1}, 7]}, {"lines": [{"text": "d"}]}, "x"]}, "a\n\nb\n\nc\n\nd"),
        ({"pages": [{"blocks": "no", "lines": [{"text": "d"}]}]}, "d"),
        ({"pages": [], "x": {"text": "deep", "y": [{"text": "er"}]}}, "deep\ner"),
        ({"pages": [{"text": " "}], "t": {"text": {"text": "in"}}}, "in"),
        ({"é": 1}, '{\n  "é": 1\n}'),
    ],
)
def test_text_from_parse(spark, body, text):
    df = spark.createDataFrame([(json.dumps(body),)], "j string")
    assert df.select(text_from_parse_json("j").alias("t")).head()["t"] == text


def test_markdown(spark):
    df = spark.createDataFrame([('{"data":{"markdown":" # a"}}', None), ('{"data":null}', '{"markdown":"","data":{"markdown":"b"}}'), ("{}", "{}")], "j string, l string")
    assert [r[0] for r in df.select(markdown_pick("j", "l")).collect()] == [" # a", "b", None]


SCHEMA = {"type": "object", "additionalProperties": False, "required": ["a", "b"],
          "properties": {"a": {"type": ["string", "null"]}, "b": {"type": "array", "items": {"type": "string"}}, "n": {"type": "number"}}}


def test_schema_parse(spark):
    assert struct_from_json_schema(SCHEMA).simpleString() == "struct<a:string,b:array<string>,n:double>"
    df = spark.createDataFrame([('{"a":null,"b":["x"]}',), ('{"a":"1","c":2}',), ("broken",)], "extracted_json string")
    good, extra, broken = parse_by_json_schema(df, json.dumps(SCHEMA)).collect()
    assert good.valid and good.record.b == ["x"]
    assert (extra.valid, extra.missing_required, extra.extra_properties) == (False, ["b"], ["c"])
    assert not broken.valid and broken.missing_required == ["a", "b"]


def test_note_schema(spark):
    note = struct_from_json_schema(note_schema())
    assert len(note) == 20 and sum(f.dataType.simpleString() == "array<string>" for f in note) == 3
    whole = {f.name: ["x"] if f.dataType.simpleString() != "string" else None for f in note}
    df = spark.createDataFrame([(json.dumps(whole),)], "extracted_json string")
    assert parse_by_json_schema(df, note_schema()).head().valid


def test_extract_documents(spark):
    def extractor(name, content):
        if b"bad" in content:
            raise ValueError("cannot read")
        return {"name": name, "size": len(content)}

    files = spark.createDataFrame(
        [("file:/x/a.pdf", bytearray(b"1234")), ("file:/x/b.pdf", bytearray(b"bad")), ("file:/x/c.doc", bytearray(b""))], "path string, content binary"
    )
    results = extract_documents(files, extractor)
    assert rows(results, "ok", "filename", "error") == [
        (False, "b.pdf", "cannot read"), (False, "c.doc", "unsupported file type: c.doc"), (True, "a.pdf", None)]
    assert json.loads(results.filter("ok").head()["extracted_json"]) == {"name": "a.pdf", "size": 4}
    assert tuple(run_summary(results).head()) == (3, 1, 2)
    assert [r.filename for r in first_failures(results, 1).collect()] == ["b.pdf"]


def test_page_links(spark):
    page = """<A class=x HREF = "/1" >One <b>x</b></A><a name="n">no</a><a
    href="/2"> two </a>"""
    df = page_links(spark.createDataFrame([(page,)], "html string"))
    assert rows(df) == [(0, "/1", "One x"), (1, "", "no"), (2, "/2", "two")]


def test_first_price_box_decides(spark):
    plain_then_sale = '<ul class="products"><li class="product"><a href="u"><img src="i"><h2 class="woocommerce-loop-product__title">N</h2></a><span class="price">KES 100</span><span class="price"><ins><span class="woocommerce-Price-amount"><bdi>KES 7</bdi></span></ins></span></li></ul>'
    pages = spark.createDataFrame([(plain_then_sale,)], "html string")
    for shop in ("shop_list", "shop_cart"):
        (card,) = extract_cards(pages, SITES[shop]).collect()
        assert (card.current_price, card.original_price) == (100.0, None)
    styled = plain_then_sale.replace("KES 100", "<style>p{width:5}</style>KES 100<script>9</script>")
    (card,) = extract_cards(spark.createDataFrame([(styled,)], "html string"), SITES["shop_list"], snippet=10).collect()
    assert card.current_price == 100.0 and len(card.full_html_snippet) == 10


def test_links_in_any_quotes(spark):
    html = """<a href='x?a=1&amp;b=2'>caf&eacute;</a><a href=y class=c>t<b>w</b>o</a><A HREF = "z">3</A><abbr href="n">no</abbr><a id=top>none</a><a title="a>b" href="q">4</a>"""
    links = page_links(spark.createDataFrame([(1, html)], "id int, html string"), keep=["id"])
    assert rows(links, "position", "url", "name") == [(0, "x?a=1&b=2", "café"), (1, "y", "two"), (2, "z", "3"), (3, "", "none"), (4, "q", "4")]


def test_types_of_properties_are_checked(spark):
    schema = {"type": "object", "properties": {"d": {"type": "array", "items": {"type": "string"}}, "n": {"type": ["number", "null"]}, "i": {"type": "integer"}}, "required": []}
    cases = {'{"d":"not a list"}': ["d"], '{"d":["a",1]}': ["d"], '{"d":[],"n":null}': [], '{"n":"1"}': ["n"], '{"i":1.5}': ["i"], '{"i":3,"n":1.5,"d":["x"]}': [], '{"i":true}': ["i"]}
    df = spark.createDataFrame([(c,) for c in cases], "extracted_json string")
    for r in parse_by_json_schema(df, schema).collect():
        assert (sorted(r.wrong_types), r.valid) == (cases[r.extracted_json], not cases[r.extracted_json])


def test_deep_documents_do_not_fail(spark):
    deep = '{"a":' * 900 + '{"text":"low"}' + "}" * 900
    order = '{"x":[{"text":"1"},{"y":{"text":"2","z":[{"text":"3"}]}}],"text":{"text":"4"}}'
    df = spark.createDataFrame([(1, deep), (2, order), (3, '{"a":[1,{"b":"c"}]}')], "id int, raw string")
    got = {r[0]: r[1] for r in df.select("id", text_from_parse_json("raw")).collect()}
    assert got[1] in ("low", deep) and got[2] == "1\n2\n3\n4" and json.loads(got[3]) == {"a": [1, {"b": "c"}]}


def test_token_length_is_a_choice(spark):
    df = spark.createDataFrame([("NAME: Ann",)], "t string")
    short, long = (df.select(anonymize("t", "s", n)).head()[0] for n in (10, 64))
    assert long.startswith(short) and len(long) == len("NAME: NM-") + 64


def test_cards_are_found_by_one_walk(spark):
    from carelake.operators import cards

    inner = "<span class='a'><bdi>1</bdi></span><div class='b a'><p><bdi>2</bdi></p><script>1</script></div>"
    root = cards._Tree(f"<ul>{inner}<br><li>3</ul><bdi>4").root
    assert [n.tag for n in root.walk()] == ["ul", "span", "bdi", "div", "p", "bdi", "script", "br", "li", "bdi"]
    assert [n.tag for n in root.walk()[0].walk()] == ["span", "bdi", "div", "p", "bdi", "script", "br", "li"]
    assert root.walk() == root.walk() and isinstance(root.walk(), list)
    assert list(root.strings()) == ["1", "2", "3", "4"]
    for selector in ("bdi", ".a bdi", "div.b p bdi", "li bdi", ".b.a"):
        assert cards._one(root, selector) is next(cards._matches(root, cards._steps(selector)), None)
    pages = spark.createDataFrame([(1, None, "x"), (2, "", "y")], "page_id int, html string, note string")
    assert cards.extract_cards(pages, cards.SITES["shop_list"], keep=["note", "page_id"]).count() == 0
