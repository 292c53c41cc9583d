"""Document fingerprints: native SimHash and a search within a Hamming radius.

The terms of a text are its distinct words, split at white space and lower-cased,
each weighted by its length (short words are common words).  Every term's 64-bit hash
votes for its one bits and against its zero bits; a fingerprint bit is one if its ones
outweigh its zeros.  Every bit has a sum of its own: votes grow with the copies of a
text, and only a whole bigint holds them at any number of copies.

Votes are grouped by the text's SHA-256: equal texts share one group, whose copies
scale all votes alike and leave the fingerprint as it is.

Search: the bits are cut into ``radius + 3`` blocks.  Fingerprints within the radius
agree in three blocks at least, so for every choice of three blocks a table holds the
fingerprints with those blocks permuted to the front as the key.  Equality joins on the
tables find all pairs; a pair counts only at its first agreeing choice, and is verified
by the bit count of the XOR.

Defined results: null and empty texts, and texts of white space, have no term and the
fingerprint zero; repeated rows each get a row back; further columns may have any name;
an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.common import join_spread, stored
from flowframe.session import shuffle_partitions

BITS = 64
#: Blocks that must agree; with ``radius + AGREE`` blocks, that many always do.
AGREE = 3


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def simhash(texts: DataFrame, by: list[str], out: str = "fp") -> DataFrame:
    """Fingerprints ``out`` of ``texts``, grouped by the columns ``by``, with ``copies``,
    the number of rows that shared them.  Rows that agree in ``by`` have one text.
    """
    # the empty word is in every list once: it weighs nothing and counts the rows
    words = F.array_union(F.array(F.lit("")), F.split(F.lower(F.trim("text")), r"\s+"))
    terms = texts.select(*by, F.explode(words).alias("word"))
    hashed = terms.select(*by, F.xxhash64("word").alias("h"), F.char_length("word").cast("bigint").alias("w"))
    one = F.lit(1).cast("bigint")
    votes = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(one) * F.col("w")).alias(f"vote{i}") for i in range(BITS)]
    sums = hashed.groupBy(*by).agg(F.sum("w").alias("all"), F.sum((F.col("w") == 0).cast("bigint")).alias("copies"), *votes)

    def bit(counter: Column, place: int) -> Column:
        one = 1 << place if place < BITS - 1 else -(1 << (BITS - 1))
        return F.when(counter > F.col("all") - counter, F.lit(one).cast("bigint")).otherwise(F.lit(0).cast("bigint"))

    fp = F.lit(0).cast("bigint")
    for i in range(BITS):
        fp = fp.bitwiseOR(bit(F.col(f"vote{i}"), i))
    return sums.select(*by, "copies", fp.alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / float(BITS)


def within_radius(prints: DataFrame, radius: int = 3) -> DataFrame:
    """All pairs a < b of the distinct ``fp`` that differ in at most ``radius`` bits."""
    n = radius + AGREE
    cuts = [BITS * i // n for i in range(n + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    choices = [sum(1 << i for i in c) for c in combinations(range(n), AGREE)]

    def kept(choice: int) -> int:
        mask = sum(m for i, m in enumerate(masks) if choice >> i & 1)
        return mask - (1 << BITS) if mask >> (BITS - 1) else mask

    tables = F.array(*[F.struct(F.lit(c).alias("choice"), F.col("fp").bitwiseAND(F.lit(kept(c)).cast("bigint")).alias("head"))
                       for c in choices])
    one = prints.select("fp").distinct().select("fp", F.explode(tables).alias("t")).select("fp", "t.*")
    left, right = one.withColumnRenamed("fp", "a"), one.withColumnRenamed("fp", "b")
    x = F.col("a").bitwiseXOR(F.col("b"))
    agree = F.lit(0)
    for i, m in enumerate(signed):
        agree = agree + F.when(x.bitwiseAND(F.lit(m).cast("bigint")) == 0, F.lit(1 << i)).otherwise(F.lit(0))
    # the first agreeing choice: no agreeing block below its highest one but its own
    upto = F.col("choice")
    for step in (1, 2, 4, 8, 16):
        upto = upto.bitwiseOR(F.shiftright(upto, step))
    first = agree.bitwiseAND(upto) == F.col("choice")
    met = left.join(right, ["choice", "head"]).where((F.col("a") < F.col("b")) & (F.bit_count(x) <= radius) & first)
    return met.select("a", "b")


def ring(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) over the distinct non-null ``doc_id``: the next in descending
    order, and for the last the first.

    Ids are range-partitioned and stored, so a window covers one range at a time; only
    the ends of the ranges - one row a partition - meet in a single window.
    """
    spark = ids.sparkSession
    distinct = ids.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    ranged = stored(distinct.repartitionByRange(shuffle_partitions(spark), "doc_id").select(
        "doc_id", F.spark_partition_id().alias("part")))
    ends = ranged.groupBy("part").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    by_part = Window.orderBy("part")  # one row a partition
    edges = ends.select("part", F.lag("high").over(by_part).alias("below"), F.max("high").over(
        by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("top"))
    inside = F.lag("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    return ranged.withColumn("lower", inside).join(F.broadcast(edges), "part").select(
        "doc_id", F.coalesce("lower", "below", "top").alias("next_id"))


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 3) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text ends with the beginning of the next document instead of its own last
    third.  Of a repeated id the row with the smallest SHA-256 stands for the document;
    a null id is nobody's next document, and its own next is the first one.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, near_docs (other rows within ``radius`` bits).
    """
    # renamed first: an alias of its own name would make the two uses of the text's exchange differ
    named = docs.select(f"`{doc_id}`", f"`{text}`").toDF("doc_id", "text") if (doc_id, text) != ("doc_id", "text") else docs
    rows = named.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    third = F.floor(F.char_length("text") / 3).cast("int")
    cuts = stored(rows.groupBy("doc_id").agg(F.max(third).alias("cut")))
    follow = ring(cuts)
    nobody = cuts.where("doc_id is null").join(F.broadcast(follow.agg(F.max("doc_id").alias("next_id"))))  # at most one row
    follow = stored(follow.unionByName(nobody.select("doc_id", "next_id"))).select("doc_id", "next_id")
    needed = (follow.join(cuts, follow["doc_id"].eqNullSafe(cuts["doc_id"])).groupBy(F.col("next_id").alias("doc_id"))
              .agg(F.max("cut").alias("need")))
    heads = (rows.join(needed, "doc_id").select("doc_id", F.struct(
        text_key(F.col("text")).alias("key"), F.expr("substring(text, 1, need)").alias("head")).alias("own"))
        .groupBy("doc_id").agg(F.min("own").alias("own"))
        .select(F.col("doc_id").alias("next_id"), F.col("own.key").alias("next_key"), F.col("own.head").alias("head")))
    added = follow.join(heads, "next_id").select(F.col("doc_id").alias("id"), "next_key", "head")
    # rows without id take no part in the keyed join: their one head is broadcast (one row)
    with_id = rows.where("doc_id is not null").join(added, F.col("doc_id") == F.col("id"), "left").drop("id")
    no_id = rows.where("doc_id is null").join(F.broadcast(added.where("id is null").drop("id")), F.lit(True), "left")
    joined = with_id.unionByName(no_id)
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - floor(char_length(text) / 3))"),
                      F.coalesce(F.expr("substring(head, 1, cast(floor(char_length(text) / 3) as int))"), F.lit("")))
    joined = joined.withColumn("edited", edited)
    facts = ["doc_id", "n_chars", "key", "edited_key", "next_key"]
    changed = joined.select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"), text_key(F.col("text")).alias("key"),
                            text_key(F.col("edited")).alias("edited_key"), F.coalesce("next_key", text_key(F.col("text"))).alias("next_key"),
                            F.col("edited").alias("text"))
    edits = stored(simhash(changed, facts, "edited_fp"))  # the one pass over joined texts
    own = stored(simhash(rows.select(text_key(F.col("text")).alias("key"), "text"), ["key"]))
    return _compare(edits, own, radius)


def _compare(edits: DataFrame, own: DataFrame, radius: int) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    total = own.agg(F.coalesce(F.sum("copies"), zero)).first()[0]
    texts = own.withColumnRenamed("copies", "n")
    out = join_spread(edits, texts, "key", "n", total)
    out = join_spread(out, texts.select(F.col("key").alias("next_key"), "n", F.col("fp").alias("next_fp")), "next_key", "n", total)
    out = stored(out.drop("key", "next_key"))
    counts = stored(out.groupBy("fp").agg(F.sum("copies").alias("n")))
    pairs = within_radius(counts.select("fp"), radius)
    ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("fp"), F.col("b").alias("other")),
                                          F.struct(F.col("b").alias("fp"), F.col("a").alias("other")))).alias("e")).select("e.*")
    others = ends.join(counts.withColumnRenamed("fp", "other"), "other").groupBy("fp").agg(F.sum("n").alias("others"))
    near = counts.join(others, "fp", "left").select("fp", "n", (F.col("n") - 1 + F.coalesce("others", zero)).alias("near_docs"))
    final = join_spread(out, near, "fp", "n", total).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    shown = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return final.select("doc_id", "n_chars", F.lower(F.hex("edited_key")).alias("edited_sha256"), shown("fp").alias("fingerprint"),
                        shown("edited_fp").alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), "near_docs")
