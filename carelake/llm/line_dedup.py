"""Near-duplicate lines across documents by a deletion-neighbourhood join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch, written

OTHER_SPACES = "\t\n\x0b\f\r"
#: Word hashes are added modulo this prime below 2^61, so sums cannot overflow.
PRIME = 2305843009213693951
#: What op3_line_dedup and the pipeline take: exact repeats go at any length, also inside a document.
MIN_WORDS, NEAR_WORDS = 1, 5


def _lines(docs: DataFrame) -> DataFrame:
    """ld_doc, ld_text_hash, ld_no and ld_words of each line; rows equal in both parts of the key share lines."""
    key = docs.select(docs["doc_id"].cast("long").alias("ld_doc"), docs["text"].alias("ld_text"))
    words = F.transform(F.split("ld_text", "\n", -1), _words)
    return key.select("ld_doc", F.xxhash64("ld_text").alias("ld_text_hash"), F.posexplode(words).alias("ld_no", "ld_words"))


def _words(line: Column) -> Column:
    """Lower-case words of a line; none for a line of white space."""
    return F.filter(F.split(F.translate(F.lower(line), OTHER_SPACES, " " * len(OTHER_SPACES)), " "), lambda w: w != "")


def _hash(kind: int, n: Column, words: Column) -> Column:
    """64 bits that stand for ``n`` and a list of words; ``kind`` gives independent functions."""
    return F.xxhash64(F.lit(kind), n, F.array_join(words, " "))


def _measured(docs: DataFrame, min_words: int) -> DataFrame:
    """Lines of at least ``min_words`` words with their 128-bit identity, place and number of words."""
    lines = _lines(docs).withColumn("ld_n", F.size("ld_words")).where(F.col("ld_n") >= min_words)
    joined = F.array_join("ld_words", " ")
    place = F.struct(F.col("ld_doc").isNull().alias("none"), F.col("ld_doc").alias("doc"), F.col("ld_text_hash").alias("text"), F.col("ld_no").alias("no"))
    return lines.select("ld_words", "ld_n", F.xxhash64(F.lit(1), joined).alias("ld_a"), F.xxhash64(F.lit(2), joined).alias("ld_b"), place.alias("ld_place"))


def _half_keys(n: Column, words: Column, near_words: int) -> Column:
    """Keys that two lines share if one word edit parts them.

    With m words in the longer line, the edit leaves its first m/2 words or the rest whole. A
    line gives both for m = its own length and for m = one more, where it is the shorter one.
    """
    def both(m: Column) -> list[Column]:
        front = F.floor(m / 2).cast("int")
        rest = (m - front).cast("int")
        return [
            F.xxhash64(F.lit(3), m, F.array_join(F.slice(words, F.lit(1), front), " ")),
            F.xxhash64(F.lit(4), m, F.array_join(F.slice(words, n - F.least(rest, n) + 1, F.least(rest, n)), " ")),
        ]

    keys = F.when(n >= near_words, F.array(*both(n), *both(n + 1))).otherwise(F.array(*both(n + 1)))
    return F.when(n + 1 >= near_words, keys)


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """The keys that two different lines have."""
    return rows.groupBy(key).agg(F.min("ld_a").alias("least"), F.max("ld_a").alias("most")).where("least != most").select(key)


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two lists of words are at most one insertion, deletion or replacement apart."""
    na, nb = F.size(a), F.size(b)
    differ = F.filter(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), lambda d: d)
    longer, shorter = F.when(na > nb, a).otherwise(b), F.when(na > nb, b).otherwise(a)
    n = F.least(na, nb)
    same = F.coalesce(F.array_position(F.zip_with(shorter, F.slice(longer, F.lit(1), n), lambda x, y: x == y), False), F.lit(0)).cast("int")
    front = F.when(same == 0, n).otherwise(same - 1)
    tail = n - front
    inserted = F.slice(shorter, front + 1, tail) == F.slice(longer, front + 2, tail)
    return F.when(na == nb, F.size(differ) <= 1).when(F.abs(na - nb) == 1, inserted).otherwise(False)


def near_firsts(docs: DataFrame, keyed: DataFrame, near_words: int) -> DataFrame:
    """The lines (ld_a, ld_b) of which an occurrence must go, and the place that all later ones lose to.

    One row for each different line that occurs twice or has an earlier neighbour. ``keyed``
    are the measured lines of ``docs`` with their half keys.
    """
    firsts = written(
        keyed.groupBy("ld_a", "ld_b").agg(F.min("ld_place").alias("ld_first"), F.count(F.lit(1)).alias("ld_times"), F.first("ld_n").alias("ld_n")), "line-firsts"
    )
    # Only lines that share a half with another one can have a neighbour; the others emit no variants.
    halves = keyed.select("ld_a", F.explode("ld_halves").alias("ld_half"))
    candidates = halves.join(_shared(halves, "ld_half"), "ld_half", "left_semi").select("ld_a").distinct()
    at = firsts.join(candidates, "ld_a", "left_semi").select("ld_a", "ld_b", "ld_first", "ld_n")
    in_docs = at.groupBy(F.col("ld_first.doc").alias("at_doc"), F.col("ld_first.text").alias("at_text")).agg(
        F.collect_list(F.struct(F.col("ld_first.no").alias("no"), "ld_a", "ld_b", "ld_first", "ld_n")).alias("ld_at")
    )
    texts = docs.select(docs["doc_id"].cast("long").alias("ld_doc"), docs["text"].alias("ld_text"), F.xxhash64(docs["text"]).alias("ld_text_hash"))
    picked = texts.join(in_docs, F.col("ld_doc").eqNullSafe(F.col("at_doc")) & (F.col("ld_text_hash") == F.col("at_text")))
    lines = written(
        picked.select(F.split("ld_text", "\n", -1).alias("ld_lines"), F.explode("ld_at").alias("at"))
        .select(F.col("at.ld_a").alias("ld_a"), F.col("at.ld_b").alias("ld_b"), F.col("at.ld_first").alias("ld_first"), F.col("at.ld_n").alias("ld_n"),
                _words(F.element_at("ld_lines", F.col("at.no") + 1)).alias("ld_words"))
        .dropDuplicates(["ld_a", "ld_b"]), "line-candidates",
    )
    links = written(_links(lines, near_words), "line-links")
    near = links.groupBy("ld_a", "ld_b").agg(F.min("ld_partner").alias("ld_near"))
    firsts = firsts.select("ld_a", "ld_b", "ld_first", "ld_times")
    return firsts.join(near, ["ld_a", "ld_b"], "left").where("ld_times > 1 or ld_near is not null").select(
        "ld_a", "ld_b", F.least("ld_first", F.coalesce("ld_near", "ld_first")).alias("ld_keep")
    )


def _links(lines: DataFrame, near_words: int) -> DataFrame:
    """(ld_a, ld_b, ld_partner): a line and the first place of an earlier line within one word edit.

    Variants are a line itself and the line less each word. They are joined in two steps:
    first by a hash that ignores the order of words, which costs the same for each variant of
    a line of any length, then, for those that meet, by the hash of the variant itself. Two
    lines that lack the word at the same place, or of which one is the other's variant, are
    one edit apart, so the earliest of a group is linked with all others of it and no pairs
    within a group are made. The edit distance of each link is verified on the words. A line
    under ``near_words`` words is never the longer one of a link: it is its only variant.
    """
    hashes = F.transform("ld_words", lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME)))
    summed = lines.withColumn("ld_hashes", hashes).withColumn(
        "ld_sum", F.aggregate("ld_hashes", F.lit(0).cast("long"), lambda s, h: (s + h) % PRIME)
    )
    loose = lambda n, total: F.xxhash64(n, total)
    shorter = F.transform("ld_hashes", lambda h: loose(F.col("ld_n") - 1, F.pmod(F.col("ld_sum") - h, F.lit(PRIME))))
    deletions = F.when(F.col("ld_n") >= near_words, shorter).otherwise(F.array().cast("array<bigint>"))
    keyed = summed.withColumn("ld_loose", deletions).withColumn("ld_full", loose(F.col("ld_n"), F.col("ld_sum")))
    variants = keyed.select("ld_a", "ld_b", F.explode(F.array_distinct(F.concat("ld_loose", F.array("ld_full")))).alias("ld_key"))
    meeting = variants.join(_shared(variants, "ld_key"), "ld_key", "left_semi").groupBy("ld_a", "ld_b").agg(F.collect_set("ld_key").alias("ld_keys"))
    met = keyed.join(meeting, ["ld_a", "ld_b"])

    # Deleting any word of a run of equal ones gives the same variant: one hash for each run.
    last = F.size("ld_words") - 1
    starts = F.filter(
        F.sequence(F.lit(0), last), lambda i: (i == 0) | (F.get("ld_words", i) != F.get("ld_words", F.greatest(i - 1, F.lit(0))))
    )
    runs = F.transform("ld_starts", lambda s, k: F.struct(s.alias("start"), (F.coalesce(F.get("ld_starts", k + 1), last + 1) - 1).alias("end")))
    runs = F.filter(runs, lambda r: F.array_contains(F.col("ld_keys"), F.get("ld_loose", r["start"])))
    whole = F.filter(F.array(F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("end"))), lambda r: F.array_contains(F.col("ld_keys"), F.col("ld_full")))
    emitted = met.withColumn("ld_starts", starts).select("ld_a", "ld_b", "ld_first", "ld_n", "ld_words", F.explode(F.concat(runs, whole)).alias("run"))
    start, words = F.col("run.start"), F.col("ld_words")
    variant = F.when(start < 0, words).otherwise(F.concat(F.slice(words, F.lit(1), F.greatest(start, F.lit(0))), F.slice(words, F.greatest(start, F.lit(0)) + 2, F.size(words))))
    own = F.struct("ld_first", "ld_a", "ld_b")
    exact = emitted.select(
        own.alias("own"), F.xxhash64(F.lit(5), F.array_join(variant, " ")).alias("v1"), F.xxhash64(F.lit(6), F.array_join(variant, " ")).alias("v2"),
        F.explode(F.sequence("run.start", "run.end")).alias("gap"),
    )
    exact = written(exact, "line-variants")
    by_variant = exact.groupBy("v1", "v2").agg(
        F.min(F.when(F.col("gap") < 0, F.col("own"))).alias("whole"), F.min(F.when(F.col("gap") >= 0, F.col("own"))).alias("deleted")
    )
    by_gap = exact.where("gap >= 0").groupBy("v1", "v2", "gap").agg(F.min("own").alias("same_gap"))
    joined = exact.join(by_variant, ["v1", "v2"]).join(by_gap, ["v1", "v2", "gap"], "left")
    partners = F.when(F.col("gap") < 0, F.array("deleted")).otherwise(F.array("whole", "same_gap"))
    pairs = joined.select("own", F.explode(partners).alias("other")).where("other < own").distinct()
    left = pairs.select("own", "other", F.col("own.ld_a").alias("ld_a"), F.col("own.ld_b").alias("ld_b")).join(lines.select("ld_a", "ld_b", "ld_words"), ["ld_a", "ld_b"])
    right = lines.select(F.col("ld_a").alias("o_a"), F.col("ld_b").alias("o_b"), F.col("ld_words").alias("o_words"))
    both = left.join(right, (F.col("other.ld_a") == F.col("o_a")) & (F.col("other.ld_b") == F.col("o_b")))
    return both.where(_one_edit(F.col("ld_words"), F.col("o_words"))).select("ld_a", "ld_b", F.col("other.ld_first").alias("ld_partner"))


def _dropped(docs: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """For each key of a document that loses lines: their numbers."""
    with scratch(docs.sparkSession):
        halves = _half_keys(F.col("ld_n"), F.col("ld_words"), near_words).alias("ld_halves")
        keyed = written(_measured(docs, min_words).select("ld_a", "ld_b", "ld_n", "ld_place", halves), "lines")
        lose = near_firsts(docs, keyed, near_words)
        gone = keyed.select("ld_a", "ld_b", "ld_place").join(lose, ["ld_a", "ld_b"]).where("ld_place > ld_keep")
        by_doc = gone.groupBy(F.col("ld_place.doc").alias("gone_doc"), F.col("ld_place.text").alias("gone_text")).agg(F.collect_set("ld_place.no").alias("ld_gone"))
        return written(by_doc, "lines-gone", outer=True)


def _cleaned(docs: DataFrame, keep: Column, min_words: int, near_words: int) -> DataFrame:
    """Each row's ``keep`` with the lines that go, the text that stays, and whether no word is left of it."""
    gone = _dropped(docs, min_words, near_words)
    rows = docs.select(keep.alias("ld_row"), docs["doc_id"].cast("long").alias("ld_doc"), docs["text"].alias("ld_text"), F.xxhash64(docs["text"]).alias("ld_text_hash"))
    joined = rows.join(gone, F.col("ld_doc").eqNullSafe(F.col("gone_doc")) & (F.col("ld_text_hash") == F.col("gone_text")), "left")
    lines = F.split("ld_text", "\n", -1)
    stay = F.filter(lines, lambda line, i: ~F.array_contains("ld_gone", i))
    return joined.select(
        "ld_row", "ld_doc", "ld_gone", F.size(lines).alias("ld_lines"),
        F.when(F.col("ld_gone").isNull(), F.col("ld_text")).otherwise(F.array_join(stay, "\n")).alias("ld_left"),
        (F.col("ld_gone").isNotNull() & ~F.exists(stay, lambda line: F.size(_words(line)) > 0)).alias("ld_empty"),
    )


def dedup_lines(docs: DataFrame, min_words: int = 5, near_words: int = 10) -> DataFrame:
    """A row per document: doc_id, n_lines, dropped (line numbers from 0) and the text that stays.

    A line goes if an earlier line (by doc_id, nulls last, then the text's hash, then place)
    has the same lower-case words, or is one word insertion, deletion or replacement away and
    the longer of both has at least ``near_words`` words. Lines under ``min_words`` words
    always stay. Rows equal in doc_id and text are one document and lose the same lines; a
    null or empty text has no lines to lose; an empty table gives no rows; other columns are
    not read. Jobs run while this is called: candidates and links are written.
    """
    return _cleaned(docs, F.lit(None).cast("int"), min_words, near_words).select(
        F.col("ld_doc").alias("doc_id"), F.coalesce("ld_lines", F.lit(0)).alias("n_lines"),
        F.coalesce(F.array_sort("ld_gone"), F.array().cast("array<int>")).alias("dropped"), F.col("ld_left").alias("text"),
    )


def deduped_documents(docs: DataFrame, min_words: int = 5, near_words: int = 10) -> DataFrame:
    """The documents with the lines that ``dedup_lines`` leaves, in all their columns.

    A document that lost lines and has no line with a word left goes; ``n_chars``, if there,
    is counted anew where the text changed.
    """
    kept = _cleaned(docs, F.struct(*[docs[c] for c in docs.columns]), min_words, near_words).where(~F.col("ld_empty"))
    changed = {"text": F.col("ld_left")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("ld_gone").isNull(), F.col("ld_row.n_chars")).otherwise(F.length("ld_left").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[changed.get(c, F.col("ld_row").getField(c)).alias(c) for c in docs.columns])
