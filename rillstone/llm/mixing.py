"""Mixing sources to target weights by hash thresholds, without a sort of the documents.

Every document has a fixed hash. Words are summed by source and the hash's
leading digit; a source's budget ends inside one digit's bucket, and only that
bucket is summed again by the next digit, until it holds a single document. The
digits found are the source's threshold: a document is taken once more when its
hash lies below. Larger budgets have larger thresholds, so what a smaller budget
takes, a larger one takes too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.operators.numbering import number_rows
from rillstone.session import stage

WORD = r"[^\x20\x09-\x0D]+"
BITS, DIGITS = 12, 5  # a hash of 60 bits is read in five digits; the row's own number in five more, for rows that are alike


def hashed(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of id and text; other engines can compute the same."""
    both = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(" "), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(both), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``id, source, size, high, low``: words of each text, its hash, and the row's own number. Stored: the texts are read once."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(source).alias("source"))
    return stage(rows.select(
        "id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        hashed(F.col("id"), F.col("text")).alias("high"), F.monotonically_increasing_id().alias("low")))


def targets(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``source, source_size, target``: each source's share of all words, no more than ``most`` times its own.

    Sources in the order of their names, NULL last, weigh ``weights``, repeating.
    A round caps the sources that are above and shares the excess among the
    others; the driver sees three sums a round.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sums = sums.withColumn("unnamed", F.col("source").isNull())
    sums = number_rows(sums, ["unnamed", "source"], "number", start=0)
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod("number", F.lit(len(weights))).cast("int"))
    sums = stage(sums.select("source", "source_size", weight.cast("long").alias("weight"),
                             (F.col("source_size") * most).alias("cap")))
    total = sums.agg(F.sum("source_size")).first()[0]
    rate, free = 0.0, None
    while True:
        above = F.col("weight") * F.lit(rate) > F.col("cap")
        capped, left, count = sums.agg(
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)), F.count_if(~above)).first()
        if count == free or not count:
            break
        rate, free = (total - capped) / left, count
    share = F.when(above, F.col("cap").cast("double")).otherwise(F.col("weight") * F.lit(rate))
    return stage(sums.select("source", "source_size", share.alias("target")))


def _digit(k: int) -> Column:
    """The digit that is read at step ``k``."""
    word, place = ("high", k) if k < DIGITS else ("low", k - DIGITS)
    return F.shiftright(F.col(word), BITS * (DIGITS - 1 - place)).bitwiseAND(F.lit((1 << BITS) - 1))


def _prefix(word: str, digits: int) -> Column:
    return F.shiftright(F.col(word), BITS * (DIGITS - digits))


def thresholds(rows: DataFrame, aims: DataFrame) -> DataFrame:
    """``source, source_size, target, copies, last_high, last_low``: whole copies of all documents, and the last pair of hashes taken once more.

    Only the bucket in which a source's budget ends is read by a further digit.
    A document on the edge is taken when that brings the words nearer.
    """
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    aims = aims.withColumn("copies", copies)
    budget = F.col("target") - F.col("copies") * F.col("source_size")
    zero = F.lit(0).cast("long")
    open_ = stage(aims.withColumn("budget", budget).filter("budget > 0").select(
        "source", "budget", zero.alias("below"), zero.alias("at_high"), zero.alias("at_low")))
    closed = []
    for k in range(2 * DIGITS):
        inside = rows.filter("size > 0").withColumnRenamed("source", "of")
        here = [_prefix("high", min(k, DIGITS)) == F.col("at_high")]
        if k > DIGITS:
            here.append(_prefix("low", k - DIGITS) == F.col("at_low"))
        met = inside.join(open_, F.col("of").eqNullSafe(F.col("source"))).filter(here[0] if len(here) == 1 else here[0] & here[1])
        sums = met.groupBy("source", "budget", "below", "at_high", "at_low", _digit(k).alias("digit")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("digit"))  # at most 4096 rows a source
        sums = sums.withColumn("before", F.col("below") + upto - F.col("words"))
        edge = sums.filter((F.col("before") < F.col("budget")) & (F.col("before") + F.col("words") >= F.col("budget")))
        word = "at_high" if k < DIGITS else "at_low"
        edge = stage(edge.withColumn(word, F.shiftleft(F.col(word), BITS) + F.col("digit")).select(
            "source", "budget", "words", "n", F.col("before").alias("below"), "at_high", "at_low"))
        last = k == 2 * DIGITS - 1
        # a bucket of one document ends the search: the threshold lies before or behind it
        single = edge if last else edge.filter("n = 1")
        nearer = F.col("below") + F.col("words") - F.col("budget") < F.col("budget") - F.col("below")
        rest_high = BITS * (DIGITS - 1 - k) if k < DIGITS else 0
        rest_low = BITS * (2 * DIGITS - 1 - k) if k >= DIGITS else BITS * DIGITS
        step = F.when(nearer, 1).otherwise(0).cast("long")
        if k < DIGITS:  # everything under this prefix of the hash
            upper = F.shiftleft(F.col("at_high") + step, rest_high)
            closed.append(single.select("source", upper.alias("end_high"), zero.alias("end_low")))
        else:
            upper = F.shiftleft(F.col("at_low") + step, rest_low)
            closed.append(single.select("source", F.col("at_high").alias("end_high"), upper.alias("end_low")))
        open_ = edge.filter("n > 1").select("source", "budget", "below", "at_high", "at_low")
        if last or open_.isEmpty():
            break
    ends = closed[0]
    for more in closed[1:]:
        ends = ends.unionByName(more)
    ends = ends.withColumnRenamed("source", "of")
    found = aims.join(ends, F.col("source").eqNullSafe(F.col("of")), "left")
    return stage(found.select("source", "source_size", "target", "copies",
                              F.coalesce("end_high", zero).alias("end_high"), F.coalesce("end_low", zero).alias("end_low")))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3), most: int = 3,
) -> DataFrame:
    """How many words of each document a mix takes that has as many words as the documents, shared by source weights.

    Returns ``id, size, source_size, target, taken``, one row per document.
    ``taken`` is ``size`` times 0 to ``most``: a document is taken whole. A NULL
    text has no word; a NULL source is a source, the last; rows without an id and
    rows that repeat one are documents of their own, and of rows that are alike as
    many are taken as fit. A source without a word has target 0, a single document
    larger than its budget is taken or left, whichever is nearer; an empty table
    gives none. Other columns are not looked at.
    """
    rows = sized(docs, doc_id, text, source)
    found = thresholds(rows, targets(rows, weights, most)).withColumnRenamed("source", "of")
    joined = rows.join(found, F.col("source").eqNullSafe(F.col("of")))
    once_more = (F.col("high") < F.col("end_high")) | (
        (F.col("high") == F.col("end_high")) & (F.col("low") < F.col("end_low")))
    taken = F.col("size") * (F.col("copies") + once_more.cast("long"))
    return joined.select("id", "size", "source_size", "target", taken.alias("taken"))
