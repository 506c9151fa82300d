"""SpotSigs document fingerprints (operator 8), in DataFrame functions only.

A spot signature is an anchor (a common word) with the chain of the next
content words behind it; common words in between are passed over.  Navigation,
tables and lists have few common words, so the signatures stand for the prose
of a document.  The fingerprint is the set of its signatures' hashes.

:func:`near_duplicates` compares fingerprints by Jaccard similarity.  Sets are
partitioned by length so that partners lie in the same or the next partition.
Inside a partition a set is indexed by its rarest hashes only (the prefix that
any partner must share) and probes its own and the next partition.  Lengths and
the places of the shared hash bound the similarity, which prunes pairs before
they are compared exactly.  A hash in many prefixes is met in blocks.

Edge cases: null text counts as empty.  A text without any spot has the hash
of all its words as its only signature; an empty text has none.
Two empty sets are alike (1), an empty and another one are not (0).  Null ids
sort first.  Rows of equal id are ordered by a hash of their text.  The next
document of the last is the first; of a single one, itself.  An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabstack.llm.common import blocks_for, materialise, range_of

CHAIN = 2       # content words behind an anchor
HASH_BITS = 40
ROWS_PER_RANGE = 4_000
MAX_RANGES = 1 << 16    # beyond it ranges get more rows; their sort spills
BLOCK = 1_000           # sets of one partition and hash that a block holds

#: Anchors, the common words of four languages.
ANCHORS = ("a an the is are was were be been that this it of and to in on for with by as at or he from there "
           "der die das den dem ein eine ist sind war und zu von mit auf für nicht im "
           "le la les un une des du de est sont et que en dans pour qui "
           "el los las una es son y por para con del se no").split()

_GAP = r"[^\p{L}\p{M}\p{N}]+"


def with_signatures(df: DataFrame, text_col: str, out_col: str, anchors=ANCHORS, chain: int = CHAIN) -> DataFrame:
    """``df`` with the sorted distinct signature hashes of ``text_col`` (array of bigint).

    In steps, since each reads the step before many times: the words, the
    places of the content words, and for each content word the anchors right
    before it, hashed with it and its successors.
    """
    kept, mask = df.columns, (1 << HASH_BITS) - 1
    text = F.col(text_col)
    df = df.withColumn("_words", F.filter(F.split(F.lower(text), _GAP), lambda w: w != ""))
    places = F.transform("_words", lambda w, i: F.when(w.isin(*anchors), F.lit(-1)).otherwise(i))
    df = df.withColumn("_content", F.filter(places, lambda i: i >= 0))

    def spots(k: Column) -> Column:
        here = F.get("_content", k)
        before = F.when(k > 0, F.get("_content", k - 1)).otherwise(F.lit(-1))
        follow = [F.get("_words", F.get("_content", k + j)) for j in range(chain)]
        return F.transform(F.slice("_words", before + 2, here - before - 1), lambda a: F.xxhash64(a, *follow).bitwiseAND(F.lit(mask)))

    last = F.size("_content") - chain
    none = F.array().cast("array<bigint>")
    df = df.withColumn("_spots", F.when(last < 0, none).otherwise(F.flatten(F.transform(F.sequence(F.lit(0), last), spots))))
    whole = F.when(F.length(text) == 0, none).otherwise(F.array(F.xxhash64(F.array_join("_words", " ")).bitwiseAND(F.lit(mask))))
    sigs = F.when(F.size("_spots") == 0, whole).otherwise(F.sort_array(F.array_distinct("_spots")))
    return df.select(*kept, sigs.alias(out_col))


def fingerprint(sigs: Column) -> Column:
    """The set as text: hashes in hexadecimal, joined by commas."""
    return F.array_join(F.transform(sigs, lambda h: F.lower(F.hex(h))), ",")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard similarity; 0 without comparing where the lengths alone rule out ``at_least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    exact = both / (F.size(a) + F.size(b) - both)
    return F.when(large == 0, F.lit(1.0)).when(small < large * at_least, F.lit(0.0)).otherwise(exact).cast("double")


def with_next(docs: DataFrame, id_col: str, text_col: str, carry: list[str], prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
              rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``docs`` (``id_col``, ``text_col``) with ``next_<c>`` of the next row by id, the first after the last.

    Rows are dealt to id ranges of about equal size.  Each range's first row is
    also put at the end of the range before, so that a window inside a range
    sees every neighbour and the text moves once.  ``prepare`` adds columns to
    the rows so dealt, which ``carry`` may name; it runs once for each row.
    """
    n = docs.count()
    parts = min(blocks_for(n, rows_per_range), MAX_RANGES)
    at = [k / parts for k in range(1, parts)]
    bounds = sorted(set(docs.agg(F.percentile_approx(id_col, F.array(*map(F.lit, at)), F.lit(10 * parts))).first()[0] or [])) if at and n else []
    order = [F.col("_last"), F.col(id_col).asc_nulls_first(), F.xxhash64(text_col)]
    placed = docs.withColumn("_range", range_of(F.col(id_col), bounds))
    # first row of each range: its id from the narrow columns, then its text; as many rows as ranges
    firsts = placed.groupBy("_range").agg(F.min(F.coalesce(F.col(id_col).cast("string").isNotNull(), F.lit(False))).alias("_known"),
                                          F.min(id_col).alias("_first"))
    before = F.lag("_range").over(Window.orderBy("_range"))
    last = F.max("_range").over(Window.partitionBy())
    heads = firsts.withColumn("_to", F.coalesce(before, last))
    same = F.when(F.col("_known"), F.col(id_col) == F.col("_first")).otherwise(F.col(id_col).isNull())
    chosen = F.row_number().over(Window.partitionBy("_to").orderBy(F.xxhash64(text_col)))
    copies = (placed.join(F.broadcast(heads), "_range")   # at most MAX_RANGES rows
              .filter(same).withColumn("_n", chosen).filter("_n = 1")
              .drop("_range").withColumnRenamed("_to", "_range").select(*placed.columns))
    both = prepare(placed.withColumn("_last", F.lit(False)).unionByName(copies.withColumn("_last", F.lit(True))))
    window = Window.partitionBy("_range").orderBy(*order)
    nexts = [F.lead(c).over(window).alias(f"next_{c}") for c in carry]
    return both.select("*", *nexts).filter(~F.col("_last")).drop("_last", "_range")


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness to the text's own and the next document's."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(src, "doc_id", "text", ["text", "sigs"], lambda df: with_signatures(df, "text", "sigs"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", "sigs", "next_sigs", n.cast("long").alias("n_chars"), edited.alias("edited"))
    rows = with_signatures(rows, "edited", "edited_sigs")
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       fingerprint(F.col("sigs")).alias("fingerprint"), fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
                       likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
                       likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(membership, pairs): the class of equal fingerprints of each document, and the similar pairs of classes.

    membership: ``id, class_id`` (smallest id of the class); pairs: ``a, b,
    likeness`` of class ids with a < b and likeness of at least ``threshold``.
    Documents without signatures are in classes of their own text's emptiness
    and take part in no pair.
    """
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sets = materialise(with_signatures(src, "text", "sigs").select("id", "sigs").withColumn("_key", F.sha2(F.array_join("sigs", ",").cast("binary"), 256)), "spots")
    classes = sets.groupBy("_key").agg(F.min("id").alias("class_id"), F.first("sigs").alias("sigs"))
    member = sets.select("id", "_key").join(classes.select("_key", "class_id"), "_key").select("id", "class_id")
    held = materialise(classes.filter(F.size("sigs") > 0).select(F.col("class_id").alias("c"), "sigs", F.size("sigs").alias("n")), "spot-sets")
    terms = held.select("c", "n", F.explode("sigs").alias("h"))
    ranked = terms.join(terms.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "h", "left")
    place = F.row_number().over(Window.partitionBy("c").orderBy(F.coalesce("df", F.lit(1)), "h"))
    # a partner of similarity t shares one of the n - ceil(t n) + 1 rarest hashes
    prefix = ranked.withColumn("k", place).filter(F.col("k") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).filter("df is not null")
    # lengths of partners differ by a factor of at most 1 / t, so by at most one partition (a little wider, for rounding)
    part = F.floor(F.log("n") / F.lit(math.log(1 / threshold) + 1e-9))
    prefix = materialise(prefix.select("c", "n", "k", "h", part.alias("p")), "spot-prefix")
    sizes = prefix.groupBy("p", "h").agg(F.count(F.lit(1)).alias("size")).select("p", "h", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    here = sizes.withColumnRenamed("blocks", "across")

    def own(blocks: str) -> Column:
        return F.pmod(F.xxhash64("c"), F.col(blocks)).cast("int")

    # (partition, hash) is a grid of blocks: an indexed set takes its row in every column, a probing set its column in every row
    probes = prefix.withColumn("q", F.explode(F.array(F.col("p"), F.col("p") + 1)))
    probes = probes.join(here, ["p", "h"]).join(sizes.withColumnRenamed("p", "q"), ["q", "h"])
    probes = probes.select("q", "h", (F.col("q") - F.col("p")).alias("step"), own("across").alias("y"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("x"),
                           F.col("c").alias("c2"), F.col("n").alias("n2"), F.col("k").alias("k2"))
    lower = here.select((F.col("p") + 1).alias("p"), "h", "across")
    steps = here.withColumn("step", F.lit(0).cast("long")).unionByName(lower.withColumn("step", F.lit(1).cast("long")))
    index = prefix.join(sizes, ["p", "h"]).join(steps, ["p", "h"]).select(
        F.col("p").alias("q"), "h", "step", own("blocks").alias("x"), F.explode(F.sequence(F.lit(0), F.col("across") - 1)).alias("y"),
        F.col("c").alias("c1"), F.col("n").alias("n1"), F.col("k").alias("k1"))
    # the rarest shared hash of a pair leaves room for enough others behind it
    room = 1 + F.least(F.col("n1") - F.col("k1"), F.col("n2") - F.col("k2")) >= (F.col("n1") + F.col("n2")) * (threshold / (1 + threshold)) - 1e-6
    once = (F.col("step") == 1) | (F.col("c1") < F.col("c2"))
    close = F.least("n1", "n2") >= F.greatest("n1", "n2") * threshold - 1e-9
    some = (probes.join(index, ["q", "h", "step", "x", "y"]).filter(once & close & room)
            .select(F.least("c1", "c2").alias("a"), F.greatest("c1", "c2").alias("b")).distinct())
    full = (some.join(held.select(F.col("c").alias("a"), F.col("sigs").alias("sa")), "a")
            .join(held.select(F.col("c").alias("b"), F.col("sigs").alias("sb")), "b"))
    pairs = full.select("a", "b", likeness(F.col("sa"), F.col("sb"), threshold).alias("likeness")).filter(F.col("likeness") >= threshold)
    return member, pairs
