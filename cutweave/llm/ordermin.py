"""Document fingerprints by order MinHash over words, DataFrame functions only.

The k-mers of a text are its runs of K words. Equal k-mers are told apart by their occurrence number. Their hashes are spread
over SLOTS equal slots of the hash space; from each slot the TUPLE smallest are selected, put back into text order, and the
hash of that tuple is the slot's signature. All slots come from one sort of one array of longs, so a text costs n log n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import range_edges, range_of, table

K, TUPLE, SLOTS = 3, 2, 64
#: A packed long holds a 33-bit hash above a 30-bit position: a string of at most 2^31 bytes has fewer than 2^30 words.
POS_BITS, HASH_BITS = 30, 33
SLOT_SHIFT = POS_BITS + HASH_BITS - (SLOTS.bit_length() - 1)


def _packed(h: Column, pos: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(h, 64 - HASH_BITS), POS_BITS).bitwiseOR(pos.cast("long"))


def _pos(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << POS_BITS) - 1)).cast("int")


def _at(a: Column, i: Column) -> Column:
    return F.get(a, i)


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def kmer_hashes(words: Column, k: int = K) -> Column:
    """Hashes of the runs of k words; of the whole sequence where there are fewer; none for no word."""
    count = F.greatest(F.size(words) - F.lit(k - 1), F.least(F.size(words), F.lit(1)))
    one = lambda i: F.xxhash64(*[F.coalesce(_at(words, i + j), F.lit("")) for j in range(k)])
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), one)).otherwise(F.array().cast("array<bigint>"))


def numbered(hashes: Column) -> Column:
    """Sorted packed longs of (hash with occurrence number, position). The occurrence number is the distance to the start of
    the run of equal hashes in the sorted array, found by doubling steps, so many repeats cost a logarithm each."""

    def number(a: Column) -> Column:
        same = lambda i, j: F.shiftright(_at(a, i), POS_BITS) == F.shiftright(_at(a, j), POS_BITS)
        steps = F.array(*[F.lit(1 << b) for b in range(29, -1, -1)])
        back = lambda j: F.aggregate(steps, F.lit(0), lambda t, s: F.when((t + s <= j) & same(j - F.least(t + s, j), j), t + s).otherwise(t))
        return F.transform(a, lambda x, j: F.when((j > 0) & same(F.greatest(j - 1, F.lit(0)), j), _packed(F.xxhash64(F.shiftright(x, POS_BITS), back(j)), _pos(x))).otherwise(x))

    first = F.sort_array(F.transform(hashes, lambda h, i: _packed(F.xxhash64(h), i)))
    return F.sort_array(_let(first, number))


def signature(text: Column) -> Column:
    """array<struct<slot int, sig bigint>>, slots that no k-mer falls into left out; empty for a text without words."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def tuples(a: Column, ws: Column) -> Column:
        slot = lambda x: F.shiftright(x, SLOT_SHIFT).cast("int")
        starts = F.filter(F.transform(a, lambda x, j: F.when((j == 0) | (slot(x) != slot(_at(a, F.greatest(j - 1, F.lit(0))))), j)), lambda j: j.isNotNull())
        gram = lambda p: F.xxhash64(*[F.coalesce(_at(ws, p + j), F.lit("")) for j in range(K)])

        def hashed(j: Column) -> Column:
            mine = F.filter(F.slice(a, j + 1, TUPLE), lambda x: slot(x) == slot(_at(a, j)))
            in_order = F.array_sort(F.transform(mine, _pos))
            return F.struct(slot(_at(a, j)).alias("slot"), F.aggregate(in_order, F.lit(0).cast("long"), lambda acc, p: F.xxhash64(acc, gram(p))).alias("sig"))

        return F.transform(starts, hashed)

    return _let(words, lambda ws: _let(numbered(kmer_hashes(ws)), lambda a: tuples(a, ws)))


def fingerprint(sig: Column) -> Column:
    """The signature as text: 16 hex digits for each slot, dots for an empty one."""
    by_slot = F.map_from_entries(F.transform(sig, lambda s: F.struct(s["slot"], F.lower(F.lpad(F.hex(s["sig"]), 16, "0")))))
    return _let(by_slot, lambda m: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.coalesce(F.try_element_at(m, i), F.lit("." * 16))), ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal slots among those that either text fills; 1 if neither has a word."""
    slots = lambda s: F.transform(s, lambda x: x["slot"])
    both = F.size(F.array_union(slots(a), slots(b)))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


#: Blocks of rows without an id, which stand before all others, are cut by the hash of the text: 2^NULL_BITS of them.
NULL_BITS = 10


def with_next(docs: DataFrame, blocks: int, **made: Column) -> DataFrame:
    """docs(doc_id, text) with the columns made of them, and next, a struct of text and these of the next document in ascending
    doc_id, of the first after the last.

    Rows are dealt to blocks of consecutive ids by approximate quantiles and each block is sorted alone: a row moves once. The
    first row of each block also goes, as a guest, to the end of the block before it; that it is the first, ids and hashes decide.
    """
    spans = F.shiftright(F.xxhash64("text"), 64 - NULL_BITS) - (1 << (NULL_BITS - 1))  # below 0, in the order of the hash
    block = F.when(F.col("doc_id").isNull(), spans).otherwise(range_of(F.col("doc_id"), range_edges(docs, "doc_id", blocks))).cast("int")
    at = docs.withColumn("block", block).withColumn("th", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("th")]
    heads = at.groupBy("block").agg(F.min_by(F.struct("doc_id", "th"), F.struct(F.col("doc_id").isNotNull(), "doc_id", "th")).alias("head"))
    turn = Window.orderBy("block")  # a row for each block, an id and a hash
    before = F.coalesce(F.lag("block").over(turn), F.max("block").over(turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    hosts = heads.select(before.alias("host"), F.col("block").alias("of"), F.col("head.doc_id").alias("head_id"), F.col("head.th").alias("head_th"))
    # a row for each block, so at most blocks + 2^NULL_BITS of them
    first = at.join(F.broadcast(hosts), (at["block"] == hosts["of"]) & at["doc_id"].eqNullSafe(hosts["head_id"]) & (at["th"] == hosts["head_th"])).dropDuplicates(["of"])
    guests = first.select(*docs.columns, F.col("host").alias("block"), "th", F.lit(1).alias("guest"))
    rows = at.withColumn("guest", F.lit(0)).unionByName(guests).withColumns(made)
    rest = F.struct("text", *made)
    shown = rows.repartition(F.col("block")).withColumn("next", F.lead(rest).over(Window.partitionBy("block").orderBy("guest", *order)))
    return shown.filter("guest = 0").drop("block", "th", "guest")


def fingerprint_pairs(docs: DataFrame, blocks: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each document: its fingerprint, that of its edited text, and likeness to the edited text and to the next document.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or all) of the next document.
    NULL texts are empty; texts without a word have likeness 1 to each other and 0 to all others; repeated ids stand in the
    order of their texts' hashes; a single document is its own next; NULL ids come first; an empty table gives no rows.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    blocks = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = with_next(base, blocks, sig=signature(F.col("text")))
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half)))
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sig", signature(F.col("edited")).alias("esig"), F.col("next.sig").alias("nsig"))
    return rows.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sig")).alias("fingerprint"), fingerprint(F.col("esig")).alias("edited_fingerprint"), likeness(F.col("sig"), F.col("esig")).alias("near_edited"), likeness(F.col("sig"), F.col("nsig")).alias("near_next"))


def op7_ordermin(spark, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(table(spark, sf_dir, "documents"))
