"""Semi-structured records, documents and pages."""

from pyspark.sql import functions as F

from ..operators.anonymize import anonymize
from ..operators.cards import SITES, extract_cards
from ..operators.documents import markdown_pick, page_links, parse_by_json_schema, text_from_parse_json
from ..operators.variant import flatten_values
from ..schemas import NOTE_FIELDS, NOTE_LISTS, note_schema
from ..session import spread
from . import query

SALT = "test-salt"


@query("""
SELECT event_id, 0 AS pos, CAST(NULL AS VARCHAR) AS key, event_type AS value FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_id, 1, NULL, CAST(user_id AS VARCHAR) FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_id, 0, 'id', CAST(event_id AS VARCHAR) FROM events WHERE event_id % 2 = 1
UNION ALL SELECT event_id, 1, 'type', event_type FROM events WHERE event_id % 2 = 1
""")
def doc_flatten(t):
    array = F.to_json(F.array("event_type", F.col("user_id").cast("string")))
    record = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("type")))
    body = F.when(F.col("event_id") % 2 == 0, array).otherwise(record)
    rows = flatten_values(t("events").select("event_id", F.parse_json(body).alias("payload")))
    return rows.select("event_id", "pos", "key", F.col("value").cast("string").alias("value"))


@query("""
SELECT event_id, event_type AS document_type, CASE WHEN event_id % 3 <> 0 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS document_date,
       CASE WHEN event_id % 5 <> 0 THEN event_type || ',' || user_id END AS diagnoses, CASE WHEN event_id % 3 = 0 THEN 'document_date' ELSE '' END AS missing,
       CASE WHEN event_id % 4 = 0 THEN 'extra' ELSE '' END AS extra, CASE WHEN event_id % 5 = 0 THEN 'diagnoses' ELSE '' END AS wrong,
       event_id % 3 <> 0 AND event_id % 4 <> 0 AND event_id % 5 <> 0 AS valid FROM events
""")
def doc_schema_parse(t):
    e = F.col("event_id")
    plain = [F.lit(f"some {f}").alias(f) for f in NOTE_FIELDS if f not in (*NOTE_LISTS, "document_type", "document_date")]

    def note(diagnoses):
        return F.to_json(F.struct(
            F.col("event_type").alias("document_type"), F.when(e % 3 != 0, F.col("ts").cast("date").cast("string")).alias("document_date"), *plain,
            diagnoses.alias("diagnoses"), F.array(F.lit("blood")).alias("investigations"), F.array().cast("array<string>").alias("treatments"),
            F.when(e % 4 == 0, "x").alias("extra"),
        ))

    # Every fifth note has one text where a list is asked for.
    body = F.when(e % 5 == 0, note(F.lit("not a list"))).otherwise(note(F.array("event_type", F.col("user_id").cast("string"))))
    parsed = parse_by_json_schema(t("events").select("event_id", body.alias("extracted_json")), note_schema())
    return parsed.select(
        "event_id", "record.document_type", "record.document_date",
        F.array_join("record.diagnoses", ",").alias("diagnoses"),
        F.array_join("missing_required", ",").alias("missing"),
        F.array_join("extra_properties", ",").alias("extra"), F.array_join("wrong_types", ",").alias("wrong"), "valid",
    )


@query("""
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN text WHEN 1 THEN text WHEN 2 THEN text || chr(10) || chr(10) || source || chr(10) || chr(10) || lang
  WHEN 3 THEN lang || chr(10) || chr(10) || source ELSE lang || chr(10) || text END AS text FROM documents
""")
def doc_text_from_parse(t):
    def node(name):
        return F.struct(F.col(name).alias("text"))

    shape = F.col("doc_id") % 5
    body = (
        F.when(shape == 0, F.to_json(F.struct("text", "lang")))
        .when(shape == 1, F.to_json(F.struct(F.lit(" ").alias("document_text"), F.col("text").alias("content"))))
        .when(shape == 2, F.concat(
            F.lit('{"pages":['), F.to_json(F.struct(F.col("text").alias("content"))), F.lit(","),
            F.to_json(F.struct(F.array(node("source"), node("lang")).alias("blocks"))), F.lit("]}")))
        .when(shape == 3, F.concat(
            F.lit('{"pages":[{"blocks":7,"lines":'), F.to_json(F.array(node("lang"))), F.lit("},"),
            F.to_json(node("source")), F.lit("]}")))
        .otherwise(F.to_json(F.struct(F.struct(node("lang").alias("b")).alias("a"), F.array(node("text")).alias("c"))))
    )
    return t("documents").select("doc_id", text_from_parse_json(body).alias("text"))


@query("""
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN lang WHEN 2 THEN source END AS markdown FROM documents
""")
def doc_markdown_pick(t):
    shape = F.col("doc_id") % 4
    job = F.when(shape == 0, F.to_json(F.struct(F.struct(F.col("text").alias("markdown")).alias("data")))).otherwise(
        F.lit('{"data":{"markdown":" "},"output_url":"u"}')
    )
    large = (
        F.when(shape == 1, F.to_json(F.struct(F.col("lang").alias("markdown"))))
        .when(shape == 2, F.to_json(F.struct(F.struct(F.col("source").alias("markdown")).alias("data"))))
    )
    return t("documents").select("doc_id", markdown_pick(job, large).alias("markdown"))


def _hmac_sql(value: str) -> str:
    key = SALT.encode().ljust(64, b"\0")
    inner, outer = (bytes(b ^ x for b in key).hex() for x in (0x36, 0x5C))
    first = f"sha256(unhex('{inner}') || encode({value}))"
    return f"upper(substr(sha256(unhex('{outer}') || unhex({first})), 1, 10))"


@query(f"""
SELECT doc_id, 'NAME: NM-' || {_hmac_sql('source')} || chr(10) || 'IP NO: IP-' || {_hmac_sql('CAST(doc_id % 97 AS VARCHAR)')} || chr(10) || text AS text FROM documents
""")
def doc_anonymize(t):
    headed = F.concat(
        F.lit("name :  "), "source", F.lit(" \nIp  no: "), (F.col("doc_id") % 97).cast("string"), F.lit("\n"), "text"
    )
    return spread(t("documents").select("doc_id", "source", "text")).select("doc_id", anonymize(headed, SALT).alias("text"))


def shop_page(shop: str):
    """A page around one product, in the layout of a shop."""
    name, url, price, old = F.col("product_name"), F.col("url"), F.col("price_text"), F.col("original_text")
    lit = F.lit
    if shop == "shop_cart":
        now = F.concat(lit('<span class="woocommerce-Price-amount"><bdi>'), price, lit("</bdi></span>"))
        sale = F.concat(
            lit('<del><span class="woocommerce-Price-amount"><bdi>'), old, lit("</bdi></span></del><ins>"), now, lit("</ins>")
        )
        return F.concat(
            lit('<html><body><p>unclosed<ul class="products columns-4"><li class="x product y"><a href="'), url,
            lit('"><img src="i.png"><h2 class="woocommerce-loop-product__title"> '), name, lit(' </h2></a><span class="price">'),
            F.coalesce(sale, now), lit('</span><a class="add_to_cart_button" data-product_id="7" data-product_sku="s7">+</a></li>'
                                       '<li class="product"><a href="b">no name</a></li></ul></body></html>'),
        )
    if shop == "grid_item":
        sale = F.concat(lit('<span data-hook="product-item-price-before-discount">'), old, lit("</span>"))
        return F.concat(
            lit('<ul><li data-hook="product-list-grid-item"><a data-hook="product-item-container" href="'), url,
            lit('"><wow-image><img src="i.png"/></wow-image><p data-hook="product-item-name">'), name,
            lit('</p><span data-hook="product-item-price-to-pay" data-wix-price="'), price, lit('">x</span>'),
            F.coalesce(sale, lit("")), lit("</a></li></ul>"),
        )
    if shop == "shop_list":
        # The first box has the plain price; a later one, of another offer, is not the product's.
        box = F.coalesce(F.concat(lit("<del>"), old, lit("</del><ins>"), price, lit("</ins>")), price)
        return F.concat(
            lit('<ul><li class="product"><a href="'), url, lit('"><img src="i.png"><h2 class="woocommerce-loop-product__title">'), name,
            lit('</h2></a><span class="price"><style>.x{width:3}</style>'), box, lit('</span><span class="price"><ins>KES 7</ins></span></li></ul>'),
        )
    sale = F.concat(lit('<p class="product-price-old">'), old, lit("</p>"))
    return F.concat(
        lit('<a class="card product-card" href="'), url, lit('" data-product-id="7"><img class="product-img" src="i.png">'
            '<h5 class="product-title">'), name, lit('</h5><p class="product-price">2 for '), price, lit("</p>"),
        F.coalesce(sale, lit("")), lit('<button class="btn btn-cart" data-itemno="n7">+</button></a>'),
    )


# The shops by number, each over the scrape whose products it shows.
SHOPS = {1: ("shop_cart", 1), 2: ("grid_item", 2), 3: ("card_link", 3), 4: ("shop_list", 1)}


@query("""
SELECT scrape_no, product_name, url, current_price, original_price,
       round((original_price - current_price) / original_price * 100, 2) AS discount_percentage, 'i.png' AS image_url,
       CASE WHEN scrape_no IN (1, 3) THEN '7' END AS product_id
FROM (SELECT * FROM ox_price UNION ALL SELECT * REPLACE (4 AS scrape_no) FROM ox_price WHERE scrape_no = 1)
""")
def doc_product_cards(t):
    products = t("fx_products")
    out = None
    for number, (shop, scrape) in SHOPS.items():
        pages = products.filter(F.col("scrape_no") == scrape).select(F.lit(number).alias("scrape_no"), shop_page(shop).alias("html"))
        cards = extract_cards(spread(pages), SITES[shop], keep=["scrape_no"]).select(
            "scrape_no", "product_name", "url", "current_price", "original_price", "discount_percentage", "image_url", "product_id"
        )
        out = cards if out is None else out.unionByName(cards)
    return out


@query("""
SELECT page_id, 0 AS position, 'https://x.example/?a=1&id=' || page_id AS url, 'Café & ' || page_id AS name FROM pages
UNION ALL SELECT page_id, 1, url, 'single "quoted"' FROM pages
UNION ALL SELECT page_id, 2, '/plain/' || page_id, 'bare' FROM pages
UNION ALL SELECT page_id, 3, '', 'no link' FROM pages
""")
def doc_page_links(t):
    # Anchors as pages have them: any quoting, references, nested markup, other attributes, none at all.
    number, lit = F.col("page_id").cast("string"), F.lit
    anchors = F.concat(
        lit('<p><A class="a>b" HREF="https://x.example/?a=1&amp;id='), number, lit('"><b>Caf&eacute;</b> &amp; '), number, lit("</a><abbr>no anchor</abbr>\n<a href = '"),
        F.col("url"), lit("'\n>single &quot;quoted&quot;</a> <a data-href=no href=/plain/"), number, lit(">bare</a><a name=top>no link</a></p>"),
    )
    return page_links(t("pages").select("page_id", anchors.alias("html")), keep=["page_id"])
