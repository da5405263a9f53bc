"""I-Match fingerprints over randomised lexicons, in column expressions only.

The lexicon holds all terms whose document frequency lies in a band, that is whose
inverse document frequency does. Several random parts of it are drawn by hash;
a text's terms in a part, distinct and sorted, are hashed to one value, so two
texts agree on a part when they share all its terms. Long texts use sparser
parts than short ones: parts are halved until a text keeps about ``wanted``
terms, and two neighbouring sizes are taken, so that texts of like length can
be compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.common import parts_for
from rillstone.session import stage

WORD = r"[\p{L}\p{N}]+"
PARTS = 16  # random parts of each size
SPARSE = 12  # a part holds a term in so many
LEVELS = 2


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-case words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def in_blocks(docs: DataFrame, doc_id: str, text: str, each: int) -> DataFrame:
    """``block, id, text`` with blocks of about ``each`` bytes that follow each other by falling id.

    The ids' range is cut into 4096 even cells, whose counts are all that the
    driver sees; a cell with many rows is cut further, cells with few share a
    block. Rows without an id come last. An id (or NULL) with more rows than a
    block is cut out of it and parted by the hash of the text, by which its rows
    are ordered; only rows alike in id and text always stay together.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    low, high, size, count, missing = rows.agg(
        F.min("id"), F.max("id"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)),
        F.count(F.lit(1)), F.count_if(F.col("id").isNull())).first()
    cells, (low, high) = 4096, (low or 0, high or 0)
    at = (F.col("id").cast("double") - float(low)) * (cells / (float(high) - float(low) + 1))
    cell = F.least(F.floor(at), F.lit(cells - 1)).cast("int")
    per = max(1, count // parts_for(docs, size, each))  # rows of a block
    counts = dict(rows.filter("id is not null").groupBy(cell.alias("cell")).count().collect())  # 4096 rows at most
    first, cut, held, block = [], [], 0, 0
    for k in range(cells):
        n = counts.get(k, 0)
        if n > per:
            block += held > 0
            first.append(block)
            cut.append(-(-n // per))
            block, held = block + cut[-1], 0
            continue
        if held and held + n > per:
            block, held = block + 1, 0
        held += n
        first.append(block)
        cut.append(1)
    array = lambda v: F.from_json(F.lit(str(v)), "array<bigint>")
    inside = F.least(F.floor((at - cell) * F.get(array(cut), cell)), F.get(array(cut), cell) - 1)
    number = F.get(array(first), cell) + inside.cast("long")
    number = F.when(F.col("id").isNull(), F.lit(1).cast("long")).otherwise(-number)  # least() skips NULLs
    rows = rows.select(number.alias("number"), "id", "text")
    # ids with more rows than a block: there are fewer of them than blocks
    large = stage(rows.groupBy("number", "id").count().filter(F.col("count") > per))
    part, split = F.lit(0), F.lit(0).cast("long")
    if not large.isEmpty():
        one = F.struct("id", F.ceil(F.col("count") / per).alias("splits"))
        large = stage(large.groupBy("number").agg(F.collect_list(one).alias("large")))
        rows = rows.join(large.withColumnRenamed("number", "of"), F.col("number") == F.col("of"), "left").drop("of")
        larger = F.coalesce(F.size(F.filter("large", lambda x: x["id"] > F.col("id"))), F.lit(0))
        mine = F.try_element_at(F.filter("large", lambda x: x["id"].eqNullSafe(F.col("id"))), F.lit(1))["splits"]
        # falling: what is larger than a large id, the id itself in the order of its hashes, what is smaller
        part = 2 * larger + mine.isNotNull().cast("int")
        share = F.xxhash64("text").cast("double") / float(1 << 64) + 0.5
        split = F.coalesce(F.least(F.floor(share * mine), mine - 1), F.lit(0).cast("long"))
    return rows.select(F.struct("number", part.alias("part"), split.alias("split")).alias("block"), "id", "text")


def with_next(docs: DataFrame, doc_id: str, text: str, each: int = 8 << 20) -> DataFrame:
    """``id, text, next``: each text with the one that follows by falling id; the first follows the last.

    Blocks are ordered apart; the one row that a block lacks, the first of the
    following block, is put into it as an edge row. Rows that repeat an id
    follow each other in the order of their texts' hashes. The blocks' own order is
    one task's, which gets a row for every ``each`` bytes.
    """
    rows = in_blocks(docs, doc_id, text, each)
    order = F.struct(F.col("id").isNull(), -F.col("id").cast("decimal(20,0)"), F.xxhash64("text"), F.col("text"))
    # of each block the row that comes first
    heads = stage(rows.groupBy("block").agg(F.min_by("text", order).alias("text")))
    around = Window.orderBy("block")
    ring = heads.select("block", F.lag("block").over(around).alias("before"))
    last = heads.agg(F.max("block").alias("last"))
    ring = ring.join(last, F.lit(True), "left").select(F.col("block").alias("of"), F.coalesce("before", "last").alias("block"))
    edge = heads.withColumnRenamed("block", "of").join(stage(ring), "of").select(
        "block", F.lit(None).cast("long").alias("id"), "text", F.lit(1).alias("edge"))
    both = rows.withColumn("edge", F.lit(0)).unionByName(edge)
    falling = [F.col("id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    order = Window.partitionBy("block").orderBy(F.col("edge"), *falling)
    following = both.withColumn("next", F.lead("text").over(order))
    return following.filter("edge = 0").select("id", "text", "next")


def edited(text: Column, other: Column) -> Column:
    """The text with its last third of characters replaced by as many first ones of another (or all it has)."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(other, F.lit(1), cut))


def lexicon(docs: DataFrame, text: str, low: float, high: float) -> DataFrame:
    """All terms (hashes) that a share of documents from ``low`` to ``high`` holds.

    Document frequencies count all terms of all documents; a term of one
    document alone tells nothing about likeness and is left out. A stored table:
    it has at most 1 / ``low`` times as many terms as a document has on average.
    """
    counted = docs.select(F.explode(terms(F.col(text))).alias("term")).groupBy("term").count()
    rows = docs.count()
    band = counted.filter(F.col("count").between(max(2.0, low * rows), max(2.0, high * rows)))
    return stage(band.select("term"))


def with_kept(rows: DataFrame, known: DataFrame, own: tuple[str, ...], which: tuple[str, ...]) -> DataFrame:
    """``own``, and for each text of ``which`` its terms in the lexicon and the beginning of its hash, ``c_whole``.

    Terms are joined with the lexicon one by one and gathered by id and a hash of
    the texts. What else a row needs travels with one element of its own; rows
    alike in id and texts are gathered together and parted again by their number.
    """
    key = F.unhex(F.substring(F.sha2(F.concat_ws(".", *[f"{c}_hash" for c in which]), 256), 1, 32))
    rest = [*own, *[f"{c}_whole" for c in which]]
    rows = rows.select("*", *[F.sha2(c, 256).alias(f"{c}_hash") for c in which])
    rows = rows.select("id", key.alias("key"), *[F.col(c) for c in own if c != "id"], *[
        F.substring(f"{c}_hash", 1, 16).alias(f"{c}_whole") for c in which], *[terms(F.col(c)).alias(c) for c in which])
    row = F.struct(*rest)
    none = F.when(F.lit(False), row)

    def element(k: int, term: Column, row: Column) -> Column:
        return F.struct(F.lit(k).alias("of"), term.alias("term"), row.alias("row"))

    def elements(k: int, c: str) -> Column:
        return F.transform(c, lambda t: element(k, t, none))

    # the row's element has a term too, so that no join sends all of them to one task
    parts = [F.array(element(-1, F.xxhash64("key"), row)), *[elements(k, c) for k, c in enumerate(which)]]
    each = rows.select("id", "key", F.explode(F.concat(*parts)).alias("e")).select("id", "key", "e.*")
    found = each.join(known.withColumn("known", F.lit(True)), "term", "left").filter("known or of = -1")
    found = found.groupBy("id", "key").agg(
        F.count_if(F.col("of") == -1).alias("n"), F.max(F.when(F.col("of") == -1, F.col("row"))).alias("row"), *[
            F.collect_set(F.when(F.col("of") == k, F.col("term"))).alias(c) for k, c in enumerate(which)])
    found = found.withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    return found.select(*[f"row.{c}" for c in rest], *which)


def with_kept_at_hand(rows: DataFrame, terms_held: list[int], own: tuple[str, ...], which: tuple[str, ...]) -> DataFrame:
    """The same for a lexicon that is small enough to be part of the plan: no term leaves its row."""
    rows = rows.select(*own, *[F.substring(F.sha2(c, 256), 1, 16).alias(f"{c}_whole") for c in which], *[terms(F.col(c)).alias(c) for c in which])
    held = F.expr(f"filter(all_terms, t -> t in ({', '.join(f'{t}L' for t in terms_held)}))") if terms_held else F.lit(None)
    rows = rows.select("*", F.array_distinct(F.concat(*which)).alias("all_terms"))
    rows = rows.select("*", F.coalesce(held, F.array().cast("array<bigint>")).alias("held"))
    return rows.select(*own, *[f"{c}_whole" for c in which], *[F.array_intersect(c, "held").alias(c) for c in which])


def level(found: Column, wanted: int) -> Column:
    """How often parts are halved for a text with so many terms."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.size(found), F.lit(1)) / F.lit(wanted)))).cast("int")


def thinned(found: Column, halved: Column) -> Column:
    """The terms left when the lexicon is halved so often."""
    return F.filter(found, lambda h: F.pmod(F.xxhash64(h), F.pow(F.lit(2.0), halved).cast("long")) == 0)


def fingerprint(sizes: list[Column], halved: Column, whole: Column) -> Column:
    """Labelled hashes ``level.part.hash``, one for each part that holds terms of the text.

    A text without a lexicon term has the hash of itself, so equal texts always
    have equal fingerprints and others hardly ever do.
    """
    def labelled(found: Column, step: int, part: int) -> Column:
        mine = F.filter(found, lambda h: F.pmod(F.xxhash64(h, F.lit(part)), F.lit(SPARSE)) == 0)
        # a part without terms has no hash
        return F.transform(F.filter(F.array(mine), lambda m: F.size(m) > 0), lambda m: F.concat(
            F.lower(F.hex(halved + F.lit(step))), F.lit(f".{part:x}."),
            F.substring(F.lpad(F.lower(F.hex(F.xxhash64(F.array_sort(m)))), 16, "0"), 1, 8)))

    parts = F.concat(*[labelled(found, step, p) for step, found in enumerate(sizes) for p in range(PARTS)])
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(F.concat(F.lit("text.."), whole)))


def likeness(a: Column, b: Column) -> Column:
    """The share of the parts that either fingerprint has on which both agree."""
    label = lambda x: F.substring_index(x, ".", 2)
    either = F.array_union(F.transform(a, label), F.transform(b, label))
    return F.size(F.array_intersect(a, b)) / F.size(either)


def compare(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", low: float = 0.002, high: float = 0.15,
    wanted: int = 24, inline: int = 100_000,
) -> DataFrame:
    """Fingerprint each text, its edited form and the text that follows by falling id.

    Returns ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. A NULL text is empty. Rows without an id come
    last; a single document follows itself; an empty table gives an empty one;
    other columns are not looked at. A lexicon of up to ``inline`` terms is looked
    up in the row itself, a larger one by a join with all terms.
    """
    known = lexicon(docs, text, low, high)
    rows = with_next(docs, doc_id, text).withColumn("edited", edited(F.col("text"), F.col("next")))
    which = ("text", "edited", "next")
    own = ("id", "n_chars", "edited_sha256")
    rows = rows.withColumns({"n_chars": F.length("text").cast("long"), "edited_sha256": F.sha2("edited", 256)})
    # a lexicon has at most 1 / low times as many terms as a document has on average, however many documents there are
    small = known.limit(inline + 1).collect()
    if len(small) <= inline:
        rows = with_kept_at_hand(rows, sorted(r[0] for r in small), own, which)
    else:
        rows = with_kept(rows, known, own, which)
    # a step at a time: an expression used twice in one step would be computed twice
    rows = rows.select("*", *[level(F.col(c), wanted).alias(f"{c}_level") for c in which])
    rows = rows.select(*own, *[f"{c}_{x}" for c in which for x in ("whole", "level")], *[
        thinned(F.col(c), F.col(f"{c}_level") + F.lit(k)).alias(f"{c}_{k}") for c in which for k in range(LEVELS)])
    rows = rows.select(*own, *[fingerprint(
        [F.col(f"{c}_{k}") for k in range(LEVELS)], F.col(f"{c}_level"), F.col(f"{c}_whole")).alias(c) for c in which])
    return rows.select(
        *own, F.array_join("text", "-").alias("fingerprint"), F.array_join("edited", "-").alias("edited_fingerprint"),
        likeness(F.col("text"), F.col("edited")).alias("near_edited"),
        likeness(F.col("text"), F.col("next")).alias("near_next"))
