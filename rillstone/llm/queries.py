"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm import (
    backoff, imatch, language, licences, mixing, neargraph, packing, repeats, simhash, tokens, treap, turntrie, urls,
)
from rillstone.session import stage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = tokens.encode(docs, ranks, public_tokenizers.PATTERN).drop("text")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(tokens.decode("ids", ranks), 256).alias("decoded_sha256"))


@query
def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    out = language.held_out("doc_id", 3, 1)
    model = language.fit(docs.filter(~out & F.col("doc_id").isNotNull()))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query
def op3_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return neargraph.near_duplicates(table(spark, folder, "embeddings"), settings=neargraph.Settings(threshold=0.93))


@query
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), width=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_backoff(spark: SparkSession, folder: str) -> DataFrame:
    out = language.held_out("doc_id", 7, 2)
    found = backoff.score(table(spark, folder, "documents"), ~out & F.col("doc_id").isNotNull(), out)
    return found.withColumnRenamed("id", "doc_id")


@query
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return packing.packed_documents(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end=1)


RULES = [urls.Rule("allow", "com"), urls.Rule("block", "example.com", "/en/"),
         urls.Rule("allow", "www.example.com", "/en/"), urls.Rule("block", "net", "/es/"),
         urls.Rule("block", "net", "/fr/")]


@query
def op7_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    found = urls.fit(pages, RULES).judge(pages)
    return found.select("page_id", "host", "path", "rule", "verdict", "block_score")


@query
def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, folder, "documents").select("doc_id", "text"), length=100)
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                        F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_imatch(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.compare(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query
def op10_licences(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licences.fit(docs).scan(docs).withColumnRenamed("id", "doc_id")


@query
def op13_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), weights=(1, 2, 3), most=3).withColumnRenamed("id", "doc_id")


# The sources that reach three times their size are the first by size over weight, as far as the rate of the rest
# lies above; documents are taken in the order of their hash up to the one on the budget's edge.
ORACLES["op13_mixing"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ' ' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM sums
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS k FROM weighed
), rates AS (
  SELECT k, 3 * source_size / weight AS stop, (sum(source_size) OVER ()
      - coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM ranked
), rate AS (
  SELECT coalesce((SELECT rate FROM rates WHERE rate <= stop ORDER BY k LIMIT 1), 0) AS rate
), aims AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * rate) AS target FROM weighed, rate
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM aims
), ordered AS (
  SELECT d.*, p.source_size, p.target, p.copies, p.target - p.copies * p.source_size AS budget,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.row) AS upto
  FROM docs d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (copies + CASE WHEN upto - size < budget AND upto - budget < budget - (upto - size)
    THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""


def rebuilt(seqs: DataFrame) -> DataFrame:
    """Each conversation with its first turns, up to three by a hash of its id, taken from the one its twenty begin with."""
    mod = F.col("conv_id") % 20
    seqs = stage(seqs.withColumn("base", F.col("conv_id") - mod).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")))
    heads = seqs.filter("conv_id = base").select(
        "base", F.slice("digests", 1, 3).alias("digests0"), F.slice("words", 1, 3).alias("words0"))
    both = seqs.join(heads, "base", "left")

    def of(c: str) -> Column:
        own = F.slice(c, F.col("h") + 1, F.greatest(F.size(c), F.lit(1)))
        first = F.slice(F.col(f"{c}0"), F.lit(1), F.col("h"))
        return F.when(F.col(f"{c}0").isNull(), own).otherwise(F.concat(first, own))

    return both.select("conv_id", of("digests").alias("digests"), of("words").alias("words"))


@query
def op12_turntrie(spark: SparkSession, folder: str) -> DataFrame:
    return turntrie.trie(rebuilt(turntrie.sequences(table(spark, folder, "conversations"))))


ORACLES["op12_turntrie"] = r"""
WITH turns AS (
  SELECT conv_id, turn, substr(sha256(length(coalesce(role, '')) || ' ' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS t,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, list({'t': t, 'words': words} ORDER BY turn NULLS FIRST, t) AS seq, CAST(conv_id AS VARCHAR) AS s
  FROM turns GROUP BY conv_id
), hashed AS (
  SELECT conv_id, seq, conv_id - conv_id % 20 AS base, CAST(xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ord(substr(s, i, 1))::BIGINT)),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) % 4 AS BIGINT) AS h
  FROM convs
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.seq, [])[1:a.h], a.seq[a.h + 1:]) AS seq
  FROM hashed a LEFT JOIN convs b ON a.base = b.conv_id
), prefixes AS (
  SELECT conv_id, d, seq[1:d] AS path, len(seq) = d AS ends FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM prefixes GROUP BY path, d
), kids AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), own AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children, p.conv_id AS parent_conv_id,
    CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * n.path[n.depth].words END AS saved
  FROM nodes n LEFT JOIN kids k ON n.path = k.path
  LEFT JOIN nodes p ON n.depth > 0 AND n.path[1:n.depth - 1] = p.path AND p.depth = n.depth - 1
), spread AS (
  SELECT path[1:k] AS path, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM own) GROUP BY ALL
)
SELECT o.conv_id, o.depth, o.parent_conv_id, o.n_convs, o.n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, o.ends_sha256
FROM own o JOIN spread s ON o.path = s.path
"""


@query
def op11_treap(spark: SparkSession, folder: str) -> DataFrame:
    return treap.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


ORACLES["op11_treap"] = r"""
WITH words AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)
), cells AS (
  SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), lengths AS (
  SELECT row, count(*) AS n FROM words GROUP BY row
), total AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths
), held AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM cells, total GROUP BY term, docs
), asked AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, a.text, c.row, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words)))) AS BIGINT) AS score
  FROM asked a JOIN held USING (term) JOIN cells c USING (term) JOIN lengths l ON c.row = l.row, total
  GROUP BY item_id, a.text, c.row, doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
