"""Document fingerprints from spot signatures: chains of content words behind common words.

Only column functions: a text becomes words, anchors are glued to the content word they stand
before, and the content words from there on make a chain. The set of hashed chains is the
fingerprint; boilerplate with few common words leaves few traces in it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import Placed
from ..session import written

#: White space, sentence signs, quotes, brackets and the glue end a word.
BREAKS = r"[\x20\x09-\x0D.,;:!?\"'()\[\]|\x01]+"
GLUE = "\x01"
#: Very common words of English, German, French and Spanish.
ANCHORS = tuple(sorted(set(
    "the of and to a in is that it for was on with be by as this are at from or an not have has had but they you he she we his her their its which were will would can "
    "der die und den von zu das mit sich auf des für ist nicht im dem ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über "
    "de la le et les en un du une que pour est qui dans par sur pas au avec ce il sont plus se ne ou son cette aux "
    "el y los del las por no con su para al lo como más pero sus este".split()
)))
#: Content words of a chain, and how many words on each of them stands.
CHAIN, DISTANCE = 3, 1


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    """The words of a text in lower case; a null text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BREAKS), "")


def hashed(value: Column) -> Column:
    """60 bits of a text's MD5."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def signatures(text: Column, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN, distance: int = DISTANCE) -> Column:
    """The sorted set of a text's spot signatures, as longs of 60 bits.

    A spot is a content word behind an anchor; the nearest anchor and ``chain`` content words
    from the spot on, ``distance`` apart, are its signature. Chains that the text's end cuts are
    none. A text with words but without any signature has one made of all its words; a text
    without words has none. Work and memory grow with the text's length.
    """

    def of_words(all_words: Column) -> Column:
        # "sat on the mat" becomes "sat on<glue>the<glue>mat": a token is a content word with the anchors before it.
        glued = F.array_join(F.transform(all_words, lambda w: F.concat(w, F.when(w.isin(*anchors), GLUE).otherwise(" "))), "")

        def of_tokens(tokens: Column) -> Column:
            def content(at: Column) -> Column:
                return F.substring_index(F.get(tokens, at), GLUE, -1)

            def spot(token: Column, i: Column) -> Column:
                links = [content(i + distance * k) for k in range(1, chain)]
                last = links[-1] if links else F.substring_index(token, GLUE, -1)
                return F.when((F.instr(token, GLUE) > 0) & (last != ""), hashed(F.concat_ws(" ", F.substring_index(token, GLUE, -2), *links)))

            return F.sort_array(F.array_distinct(F.array_compact(F.transform(tokens, spot))))

        return _bound(
            _bound(F.split(glued, " "), of_tokens),
            lambda s: F.when((F.size(s) == 0) & (F.size(all_words) > 0), F.array(hashed(F.array_join(all_words, " ")))).otherwise(s),
        )

    return _bound(words(text), of_words)


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets where it is ``least`` or more, else 0; two empty sets are alike.

    Sets whose lengths lie so far apart that no overlap could reach ``least`` stand in length
    partitions that do not meet, and are not compared.
    """
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    value = F.when(large == 0, 1.0).when((small == 0) | (small < large * F.lit(least)), 0.0).otherwise(shared / (small + large - shared))
    return F.when(value >= least, value).otherwise(0.0)


def fingerprint(signature_set: Column) -> Column:
    """The set as one string."""
    return F.array_join(F.transform(signature_set, lambda s: s.cast("string")), " ")


def _succession(docs: DataFrame) -> DataFrame:
    """Each different row of doc_id and text with its number of rows and the one it comes behind.

    The order is descending doc_id, null last, then the row's key; the first comes behind the
    last. Columns: ``at_key``, ``copies``, and of the one before ``to_key`` and ``to_chars``.
    """
    keys = docs.groupBy("sp_key").agg(F.first("sp_id").alias("id"), F.count("*").alias("copies"), F.first(F.length("sp_text")).alias("chars"))
    order = Placed(keys, [F.col("id").desc_nulls_last(), F.col("sp_key").asc()])
    before = order.rows.select(((F.col("_pos") + 1) % F.lit(max(order.total, 1))).alias("at"), F.col("sp_key").alias("to_key"), F.col("chars").alias("to_chars"))
    return order.rows.join(before, F.col("_pos") == F.col("at")).select(F.col("sp_key").alias("at_key"), "copies", "to_key", "to_chars")


def edited_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, a row per document.

    A text's last third (rounded down, in code points) is replaced by as much of the start of
    the next document, in descending doc_id, the first one after the last. Columns: doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A null text is an empty one. Null ids come last, rows equal in id in order of the MD5 of
    id and text; of repeated rows each comes before the next of its kind, so only the last meets
    another text. Equal texts have equal fingerprints, also the empty one. Only doc_id and text
    are read; an empty table gives no rows. Two small tables are written while this is called.
    Each text is shuffled once, each start and signature set once more.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    key = F.md5(F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("-")), F.lit(":"), text))
    keyed = docs.select(docs["doc_id"].alias("sp_id"), key.alias("sp_key"), text.alias("sp_text"))
    order = written(_succession(keyed), "spot-order")
    # Repeated rows meet before the shuffle. Both uses below need the same columns, a struct, and so read the same exchange.
    texts = keyed.groupBy("sp_key").agg(F.first(F.struct("sp_id", "sp_text")).alias("row"))
    placed = texts.join(order, F.col("sp_key") == F.col("at_key")).withColumns(
        {"doc_id": F.col("row.sp_id"), "text": F.col("row.sp_text"), "set": signatures(F.col("row.sp_text"))}
    )
    third = lambda chars: F.floor(chars / 3).cast("int")
    following = placed.select("to_key", F.substring("text", F.lit(1), third(F.col("to_chars"))).alias("start"), F.col("set").alias("next_set"))
    met = placed.drop("to_key", "to_chars").join(following, F.col("sp_key") == F.col("to_key"))
    # The last of equal rows meets the next text, the others meet their like.
    next_text = F.struct("start", F.col("next_set").alias("set"), F.lit(1).cast("long").alias("times"))
    own = F.struct(F.substring("text", F.lit(1), third(F.length("text"))).alias("start"), F.col("set"), (F.col("copies") - 1).alias("times"))
    each = met.select("doc_id", "text", "set", F.explode(F.when(F.col("copies") > 1, F.array(next_text, own)).otherwise(F.array(next_text))).alias("next"))
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - third(F.length("text"))), F.col("next.start"))
    compared = each.withColumn("edited", edited).withColumn("edited_set", signatures(F.col("edited")))
    return compared.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("next.times")))).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("set")).alias("fingerprint"), fingerprint(F.col("edited_set")).alias("edited_fingerprint"),
        likeness(F.col("set"), F.col("edited_set")).alias("near_edited"), likeness(F.col("set"), F.col("next.set")).alias("near_next"),
    )
