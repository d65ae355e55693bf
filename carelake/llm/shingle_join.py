"""Documents joined by the Jaccard similarity of their word shingles, and their groups."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch, written
from .batches import map_rows
from .components import components

#: Parity sketches, in longs: the short one of every set, and the most of one that grows with the set.
SKETCH_LONGS = 16
MOST_LONGS = 4096
#: Cells of the bounded filter for texts whose sets are needed.
SIEVE = 1 << 23
#: Shingles told to be common, at most; they only go last in the order of tokens.
MOST_COMMON = 65_536
#: Times a shingle is seen before it is told to be common.
HINT_FROM = 128
_PRIMES = np.array([0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles, A-Z in lower case.

    With fewer words the whole sequence is one shingle; without words there is none.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, dtype=np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    take = min(width, len(found))
    last = len(found) - take + 1
    mixed = np.full(last, take, dtype=np.uint64)
    for k in range(take):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _PRIMES[0] + h[k : k + last] * _PRIMES[1]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _PRIMES[2]
    return np.unique((mixed ^ (mixed >> np.uint64(32))).view(np.int64))


def _signature(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _sketch(tokens: np.ndarray, longs: int) -> list[int]:
    """Parity of the tokens in each of 64 * ``longs`` cells; sets that differ by d tokens differ in d cells at most."""
    cells = np.bincount((tokens & (64 * longs - 1)).astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.int64).tolist()


def _wide_longs(n: int) -> int:
    """Longs of a sketch with two cells or more for each of ``n`` tokens, a power of two."""
    return min(MOST_LONGS, max(SKETCH_LONGS, 1 << (n // 32).bit_length()))


def measure_sets(docs: DataFrame, width: int, batch_count: int = 4) -> DataFrame:
    """Per document doc_id, text_hash, n and sig (of its set); and rows without sig: a shingle that some
    batch of documents has ``batch_count`` times or more, as doc_id, and how often, as n."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()), T.StructField("n", T.LongType()), T.StructField("sig", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        make = lambda *columns: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
        for batch in batches:
            sets = [shingles(x.as_py(), width) for x in batch.column(2)]
            yield make(batch.column(0).to_pylist(), batch.column(1).to_pylist(), [len(s) for s in sets], [_signature(s) for s in sets])
            tokens, times = np.unique(np.concatenate([*sets, np.empty(0, dtype=np.int64)]), return_counts=True)
            often = times >= batch_count
            none = [None] * int(often.sum())
            yield make(tokens[often], none, times[often], none)

    return docs.select(docs["doc_id"].cast("long"), F.xxhash64(docs["text"]), docs["text"]).mapInArrow(run, schema)


def _overlap(n: int, percent: int) -> int:
    """Tokens that prefixes of sets of ``n`` share at least; it grows with n and is no more than the tokens common to linked sets."""
    return max(1, -(-(100 - percent) * n // 200))


def _prefixes(docs: DataFrame, width: int, percent: int, common: np.ndarray) -> DataFrame:
    """Per document with a set: keys, n, sig, sketches, the first tokens in the order (common or not, hash), and spare.

    A set of n leaves at most n - ceil(percent * n / 100) tokens out of another of which 100 *
    intersection >= percent * union, so the prefixes of both share k tokens, k the lesser ``_overlap`` of
    the two. The other set has ceil(percent * n / 100) tokens or more: ``spare`` is less than k.
    """
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()), T.StructField("n", T.LongType()), T.StructField("sig", T.BinaryType()),
        T.StructField("sketch", T.ArrayType(T.LongType())), T.StructField("wide", T.ArrayType(T.LongType())), T.StructField("prefix", T.ArrayType(T.LongType())),
        T.StructField("spare", T.IntegerType()),
    ])

    def rows(part: list[tuple]) -> list[tuple]:
        out = []
        for doc_id, text_hash, text in part:
            if not (n := len(tokens := shingles(text, width))):
                continue
            least = -(-percent * n // 100)
            late = common[np.minimum(np.searchsorted(common, tokens), len(common) - 1)] == tokens if len(common) else np.zeros(n, dtype=bool)
            prefix = np.concatenate([tokens[~late], tokens[late]])[: n - least + _overlap(n, percent)]
            out.append((doc_id, text_hash, n, _signature(tokens), _sketch(tokens, SKETCH_LONGS), _sketch(tokens, _wide_longs(n)), prefix.tolist(), _overlap(least, percent) - 1))
        return out

    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("text_hash"), docs["text"].alias("text"))
    return map_rows(source, ["doc_id", "text_hash", "text"], rows, schema)


def _members() -> list[Column]:
    """What tells sets of ``rid`` apart: count, least, most and two hash sums."""
    return [
        F.count(F.lit(1)).alias("times"), F.min("rid").alias("least"), F.max("rid").alias("most"),
        F.bit_xor(F.xxhash64("rid")).alias("mixed"), F.sum(F.pmod(F.xxhash64(F.lit(1), "rid"), F.lit(1 << 40))).alias("total"),
    ]


def _keys(nodes: DataFrame, percent: int, common_from: int) -> DataFrame:
    """(key, rid): of each set the rarest tokens of its prefix, one of them common to any two linked sets.

    Linked sets share more than ``spare`` tokens of their prefixes. The rarest of these is not among
    the ``spare`` commonest of either set, so those are left out. A set that shares no more than
    them with all others together, by chance or by a passage, has no key. Of tokens with the
    same members one is enough. A key of more than ``common_from`` sets is divided by
    their sizes, each set in two neighbouring parts: those of linked sets are at most one apart.
    """
    entries = nodes.select("rid", F.explode("prefix").alias("token"))
    times = entries.groupBy("token").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    shared = entries.join(times, "token").groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("times", "token"))).alias("tokens"))
    rest = F.size("tokens") - F.col("spare")
    rare = shared.join(nodes.select("rid", "n", "spare"), "rid").where(rest > 0).select("rid", "n", F.explode(F.slice("tokens", F.lit(1), rest)).alias("rare"))
    rare = written(rare.select("rid", "n", F.col("rare.token").alias("key")), "rare-tokens")
    one = rare.groupBy("key").agg(*_members()).where("times > 1").groupBy("times", "least", "most", "mixed", "total").agg(F.min("key").alias("key"))
    # A little wider than the greatest ratio of linked sizes, against rounding.
    part = F.floor(F.log("n") / (math.log(100 / percent) + 1e-3))
    parts = F.when(F.col("times") > common_from, F.array(F.xxhash64("key", part), F.xxhash64("key", part + 1))).otherwise(F.array("key"))
    return rare.join(one.select("key", "times"), "key").select(F.explode(parts).alias("key"), "rid")


def _may_link(percent: int, a: str, b: str) -> Column:
    """Whether sizes and sketches allow the similarity: both bounds hold for every pair that has it."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    cells = sum((F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(SKETCH_LONGS)), F.lit(0))
    sizes = (100 * F.least(na, nb) >= percent * F.greatest(na, nb))
    # With d tokens apart, the intersection is (na + nb - d) / 2 and the union (na + nb + d) / 2.
    return sizes & ((100 + percent) * cells <= (100 - percent) * (na + nb))


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that the wide sketches allow; a wider one is folded to the width of the other."""
    one = pairs.join(nodes.select(F.col("rid").alias("u"), F.col("n").alias("nu"), F.col("wide").alias("wu")), "u")
    two = one.join(nodes.select(F.col("rid").alias("v"), F.col("n").alias("nv"), F.col("wide").alias("wv")), "v")
    # Sizes that allow the similarity are within a factor of two, so one fold is enough.
    width = F.least(F.size("wu"), F.size("wv"))
    xor = lambda x, y: x.bitwiseXOR(y)
    folded = lambda c: F.when(F.size(c) > width, F.zip_with(F.slice(c, F.lit(1), width), F.slice(c, width + 1, width), xor)).otherwise(F.col(c))
    cells = F.aggregate(F.zip_with(folded("wu"), folded("wv"), xor), F.lit(0), lambda total, x: total + F.bit_count(x))
    return two.where((100 + percent) * cells <= (100 - percent) * (F.col("nu") + F.col("nv"))).select("u", "v")


def _sieve(hashes: DataFrame) -> np.ndarray:
    """SIEVE cells, set where some value of the column ``h`` falls: of a fixed size, whatever the rows."""
    cell = F.pmod("h", F.lit(SIEVE))
    packed = hashes.select(F.floor(cell / 48).alias("at"), (cell % 48).cast("int").alias("bit")).groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    out = np.zeros(SIEVE + 48, dtype=bool)
    for r in packed.collect():
        out[48 * r["at"] : 48 * r["at"] + 48] = [(r.bits >> k) & 1 for k in range(48)]
    return np.packbits(out)


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(rid, tokens) for ``wanted`` (rid, at_doc, at_text), from a pass over the texts.

    A bounded filter of text hashes leaves out most other documents before anything is
    shuffled; where many are wanted it lets all pass, and the join decides.
    """
    cells = _sieve(wanted.select(F.col("at_text").alias("h")))
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()), T.StructField("tokens", T.ArrayType(T.LongType())),
    ])

    def rows(part: list[tuple]) -> list[tuple]:
        out = []
        for doc_id, text_hash, text in part:
            cell = text_hash % SIEVE
            if cells[cell >> 3] >> (7 - (cell & 7)) & 1:
                out.append((doc_id, text_hash, shingles(text, width).tolist()))
        return out

    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("text_hash"), docs["text"].alias("text"))
    sets = map_rows(source, ["doc_id", "text_hash", "text"], rows, schema)
    picked = sets.join(wanted, F.col("doc_id").eqNullSafe(F.col("at_doc")) & (F.col("text_hash") == F.col("at_text")))
    return picked.select("rid", "tokens").dropDuplicates(["rid"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that have the similarity, by their sets."""
    one = pairs.join(sets.select(F.col("rid").alias("u"), F.col("tokens").alias("tokens_u")), "u")
    two = one.join(sets.select(F.col("rid").alias("v"), F.col("tokens").alias("tokens_v")), "v")
    both = F.size(F.array_intersect("tokens_u", "tokens_v"))
    return two.where(100 * both >= percent * (F.size("tokens_u") + F.size("tokens_v") - both)).select("u", "v")


def _grouped(docs: DataFrame, width: int, percent: int, common_from: int, hubs: int) -> DataFrame:
    """doc_id, text_hash, n, and ``first`` (none, doc, text) of the component: its least doc_id, nulls last, and text hash."""
    with scratch(docs.sparkSession):
        if percent <= 50:
            raise ValueError("percent must be over 50")
        measured = written(measure_sets(docs, width), "sets")
        hints = measured.where("sig is null").groupBy("doc_id").agg(F.sum("n").alias("times")).where(F.col("times") > HINT_FROM)
        # A bounded hint: it shapes the order of tokens, which any order makes right.
        common = np.sort(np.array([r.doc_id for r in hints.orderBy(F.desc("times"), "doc_id").limit(MOST_COMMON).collect()], dtype=np.int64))
        members = measured.where("sig is not null")

        prefixes = _prefixes(docs, width, percent, common).dropDuplicates(["sig"])
        nodes = written(prefixes.withColumn("rid", F.monotonically_increasing_id()), "prefixes")
        keys = written(_keys(nodes, percent, common_from), "keys")
        sketched = nodes.select("rid", "n", "sketch")
        places = nodes.select("rid", F.col("doc_id").alias("at_doc"), F.col("text_hash").alias("at_text"))

        # Links to hubs of the keys: most members of a large group meet through a few of them. The
        # first hub of a key is its member with the most keys: the text that near copies are made
        # from has more in common with them than they have with each other. The others are by hash.
        ranked = keys.join(keys.groupBy("rid").agg((-F.count(F.lit(1))).alias("few")), "rid")
        tries = None
        for seed in range(hubs):
            order = F.xxhash64(F.lit(seed), "rid")
            rank = F.col("few") if seed == 0 else order
            hub = ranked.groupBy("key").agg(F.min(F.struct(rank.alias("rank"), order.alias("o"), "rid")).alias("hub")).select("key", F.col("hub.rid").alias("hub"), F.col("hub.rank").alias("rank"))
            to_hub = keys.join(hub, "key").where("rid != hub").select("rid", "hub", "rank", F.lit(seed).alias("seed"))
            tries = to_hub if tries is None else tries.union(to_hub)
        near = tries.distinct().join(sketched.select("rid", F.struct("n", "sketch").alias("a")), "rid").join(
            sketched.select(F.col("rid").alias("hub"), F.struct("n", "sketch").alias("b")), "hub"
        )
        # One hub a set and order, the first that sizes and sketches allow: a long set has many keys.
        first = near.where(_may_link(percent, "a", "b")).groupBy("rid", "seed").agg(F.min(F.struct("rank", F.xxhash64("seed", "hub").alias("o"), "hub")).alias("first"))
        hubs_of = first.select(F.greatest("rid", "first.hub").alias("u"), F.least("rid", "first.hub").alias("v")).distinct()
        pairs = written(_likely(hubs_of, nodes, percent), "hub-pairs")
        used = pairs.select(F.col("u").alias("rid")).union(pairs.select(F.col("v").alias("rid"))).distinct()
        sets = written(_sets(docs, places.join(used, "rid"), width), "hub-sets")
        found = components(_verified(pairs, sets, percent))

        # Every other candidate whose sets are not yet in one component.
        here = keys.join(found.select(F.col("u").alias("rid"), F.col("v").alias("group")), "rid", "left").withColumn("group", F.coalesce("group", "rid"))
        mixed = here.groupBy("key").agg(F.min("group").alias("least"), F.max("group").alias("most")).where("least != most").select("key")
        here = written(here.join(mixed, "key", "left_semi").join(sketched, "rid"), "open-keys")
        matched = here.alias("a").join(
            here.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.rid") > F.col("b.rid")) & (F.col("a.group") != F.col("b.group")) & _may_link(percent, "a", "b")
        )
        candidates = written(matched.select(F.col("a.rid").alias("u"), F.col("b.rid").alias("v")).distinct(), "open-candidates")
        pairs = written(_likely(candidates, nodes, percent), "open-pairs")
        used = pairs.select(F.col("u").alias("rid")).union(pairs.select(F.col("v").alias("rid"))).distinct()
        more = used.join(sets.select("rid"), "rid", "left_anti")
        sets = sets.union(written(_sets(docs, places.join(more, "rid"), width), "open-sets"))
        found = components(found.union(_verified(pairs, sets, percent)))

        grouped = nodes.select("rid", "sig").join(found.select(F.col("u").alias("rid"), "v"), "rid", "left").select("sig", F.coalesce("v", "rid").alias("group"))
        place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), F.col("text_hash").alias("text"))
        least = members.where("n > 0").groupBy("sig").agg(F.min(place).alias("least")).join(grouped, "sig")
        first = least.groupBy("group").agg(F.min("least").alias("first"))
        by_class = least.join(first, "group").select("sig", "first")
        joined = members.join(by_class, "sig", "left")
        result = joined.select("doc_id", "text_hash", "n", F.when(F.col("n") == 0, place).otherwise(F.col("first")).alias("first"))
        return written(result, "groups", outer=True)


def join_groups(docs: DataFrame, width: int = 4, percent: int = 85, common_from: int = 128, hubs: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links) of every document.

    Two documents link when 100 * |intersection| >= percent * |union| of their shingle sets.
    Equal sets are one class from the start. Candidates share one of the rarest tokens of their
    extended prefixes (and are of like size, if it is in more than ``common_from``); sizes and
    parity sketches rule most of them out without loss, and the sets decide. In a large group of
    near copies most pairs are not needed: links to ``hubs`` hubs a set come first, and only
    candidates that are not yet in one component are compared after them, all of them.
    ``percent`` is over 50.

    A null or empty text, or one without words, has 0 shingles and is linked with nothing; its
    component is itself. Equal rows get equal rows. Rows without doc_id take part; a
    component without any doc_id has none. Other columns of ``docs`` are not read. Jobs run
    while this is called; what they share is written to the shared folder.
    """
    return _grouped(docs, width, percent, common_from, hubs).select("doc_id", F.col("n").alias("n_shingles"), F.col("first.doc").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 4, percent: int = 85, common_from: int = 128, hubs: int = 2) -> DataFrame:
    """The first document (by doc_id, nulls last, then text hash) of each component, with all its columns.

    Documents without shingles are linked with nothing and stay. Rows equal in doc_id and
    text are one document, of which one row stays.
    """
    first = _grouped(docs, width, percent, common_from, hubs).select("first").distinct()
    kept = first.select(F.col("first.doc").alias("first_doc"), F.col("first.text").alias("first_text"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("whole_row"), docs["doc_id"].cast("long").alias("row_doc"), F.xxhash64(docs["text"]).alias("row_text"))
    joined = rows.join(kept, F.col("row_doc").eqNullSafe(F.col("first_doc")) & (F.col("row_text") == F.col("first_text")), "left_semi")
    return joined.dropDuplicates(["row_doc", "row_text"]).select(*[F.col("whole_row").getField(c).alias(c) for c in docs.columns])
