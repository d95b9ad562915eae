"""Proportional stratified interleaving of rows into shards, with DataFrame functions only.

The rows of each source are put in a seeded-shuffled order (by an MD5 of seed, id and
text). A row's fractional rank is (rank - 1 + u) / n in its source of n rows, where
u, a seeded hash of the source's name in (0, 1), gives each source its own start.
All rows are sorted by fractional rank and the order is cut into shards whose
counts differ by one at most (law ``rows``). A stretch of fractional ranks holds
the same share of every source, so every shard holds each source in the table's
proportion, to within a row or two and what sources of a few rows cannot divide.

No task holds a source or a shard: both ranks are found from counts of rows by
the first hexadecimal ``DIGITS`` of the shuffle key, or by ``CUTS`` ranges of the
fractional rank, with running sums over these counts; only one range of one source
(or of all) is sorted together. Rows equal in id, source, text and every other
column are one row with a number of copies until the first rank is known, so
repeated rows of any number do not meet in one task. The work moves rows of
about a hundred bytes; texts are read once and shuffled only by ``write_shards``.

Defined results: groups of equal texts are not kept together, since the counts decide
(law ``rows``); a null text has size 1 and the CRC of no bytes; a null source is a
source of its own; a null id takes part as any other; repeated rows each get a place;
fewer rows than shards leave shards empty; an empty table gives no rows; columns
of ``docs`` named like a result are no part of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesfacts.llm.common import stored

SHARDS = 16
SEED = 20
DIGITS = 3  # leading digits of the shuffle key that name a range: 16 ** DIGITS ranges a source
CUTS = 4096  # ranges of the fractional rank
COPIES = 4096  # copies of a row that one task numbers


def _named(value: Column, tag: str) -> Column:
    """A value as a string, other than that of null."""
    return F.coalesce(F.concat(F.lit(tag), value.cast("string")), F.lit(""))


def _start(source: Column, seed: int) -> Column:
    """The source's share of a row at which its fractional ranks start: in (0, 1), a multiple of 2 ** -32."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), source).cast("binary")), 1, 8)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 32))


def row_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: str = "source", seed: int = SEED) -> DataFrame:
    """``docs`` plus _size, _crc, _source, _key (its place in the shuffle) and _row (equal for rows equal in all columns)."""
    text = F.col(text_col).cast("string")
    rest = [c for c in docs.columns if c.lower() not in {x.lower() for x in (id_col, text_col, by)}]
    digest = F.md5(text.cast("binary"))
    return docs.withColumns({
        "_size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1,
        "_crc": F.crc32(F.coalesce(text, F.lit("")).cast("binary")),
        "_source": _named(F.col(by), "s"),
        "_key": F.md5(F.concat(F.lit(f"{seed}:"), _named(F.col(id_col), "d"), F.lit(":"), _named(digest, "t")).cast("binary")),
        "_row": F.md5(F.to_json(F.struct(*[F.col(c) for c in rest])).cast("binary")) if rest else F.lit("")})


def _ranges_before(rows: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """(keys, bucket, _before, _total): rows of the keys in earlier buckets, and in all; from counts, never from rows."""
    counts = rows.groupBy(*keys, bucket).agg(F.sum("_n").alias("_m"))
    along = Window.partitionBy(*keys).orderBy(bucket)
    return counts.select(*keys, bucket,
                         (F.sum("_m").over(along) - F.col("_m")).alias("_before"),
                         F.sum("_m").over(Window.partitionBy(*keys)).alias("_total"))


def _copies(ranked: DataFrame) -> DataFrame:
    """A row for each copy, ``_c`` from 0; rows with many copies are spread over tasks first."""
    few = ranked.where(F.col("_n") <= COPIES).withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    many = ranked.where(F.col("_n") > COPIES).withColumn("_c0", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPIES).cast("long"))))
    many = many.repartition("_source", "_key", "_row", "_c0").withColumn(
        "_c", F.explode(F.sequence(F.col("_c0"), F.least(F.col("_c0") + (COPIES - 1), F.col("_n") - 1)))).drop("_c0")
    return few.unionByName(many)


def assign_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", by: str = "source",
                  seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: id, source name, _key, _row, size, text_crc32, shard and slot (its place in the shard, from 0)."""
    narrow = row_keys(docs, id_col, text_col, by, seed).select(F.col(id_col).alias("_id"), "_source", "_key", "_row", "_size", "_crc")
    rows = stored(narrow.groupBy(*narrow.columns).agg(F.count("*").alias("_n")))
    # Rank in the source: rows of earlier ranges of the shuffle key, then those before it in its own range.
    rows = rows.withColumn("_range", F.substring("_key", 1, DIGITS))
    placed = rows.join(_ranges_before(rows, ["_source"], "_range"), ["_source", "_range"])
    within = Window.partitionBy("_source", "_range").orderBy("_key", "_row")
    ranked = _copies(placed.withColumn("_first", F.col("_before") + F.sum("_n").over(within) - F.col("_n")))
    part = (F.col("_first") + F.col("_c") + _start(F.col("_source"), seed)) / F.col("_total").cast("double")
    ranked = ranked.select("_id", "_source", "_key", "_row", "_size", "_crc", "_c", part.alias("_part"))
    ranked = stored(ranked.withColumns({"_cut": F.least(F.floor(F.col("_part") * CUTS), F.lit(CUTS - 1)).cast("int"), "_n": F.lit(1).cast("long")}))
    # Place in the order of fractional ranks: the same, over ranges of these.
    cuts = F.broadcast(_ranges_before(ranked.withColumn("_all", F.lit(0)), ["_all"], "_cut").drop("_all"))  # CUTS rows at most
    order = Window.partitionBy("_cut").orderBy("_part", "_source", "_key", "_row", "_c")
    ranked = ranked.join(cuts, "_cut").withColumn("_at", F.col("_before") + F.row_number().over(order) - 1)
    # Shard s takes the places from floor(s * n / shards) on.
    shard = F.expr(f"((_at + 1) * {shards} - 1) div _total")
    return ranked.withColumn("_shard", shard).select(
        F.col("_id").alias(id_col), "_source", "_key", "_row", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.col("_shard").cast("int").alias("shard"), (F.col("_at") - F.expr(f"(_shard * _total) div {shards}")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", by: str = "source",
                 seed: int = SEED) -> DataFrame:
    """Write whole rows as Parquet, a folder a shard, sorted by slot; returns what was written.

    Rows equal in all columns are exchangeable, so each distinct row is joined with the places of its copies.
    Columns of ``docs`` named shard or slot give way.
    """
    docs = docs.drop("shard", "slot")
    places = assign_shards(docs, shards, id_col, text_col, by, seed).select(
        F.col(id_col).alias("_id"), F.col("_source").alias("_s"), F.col("_key").alias("_k"), F.col("_row").alias("_r"), "shard", "slot")
    whole = row_keys(docs, id_col, text_col, by, seed).drop("_size", "_crc").dropDuplicates(["_source", "_key", "_row"])
    found = whole.join(places, (F.col("_key") == F.col("_k")) & (F.col("_row") == F.col("_r")) & (F.col("_source") == F.col("_s")))
    out = found.select(*docs.columns, "shard", "slot").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    out.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)


def shards_sql(table: str = "documents", shards: int = SHARDS, seed: int = SEED) -> str:
    """The query's rows in DuckDB SQL; CRC-32 by its byte table, over the bytes of the text."""
    bits = "lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    return f"""WITH crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], {bits})) AS t),
keyed AS (SELECT doc_id, COALESCE('s' || source, '') AS s, COALESCE(text, '') AS text,
    md5('{seed}:' || COALESCE('d' || CAST(doc_id AS VARCHAR), '') || ':' || COALESCE('t' || md5(text), '')) AS k
  FROM {table}),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY s ORDER BY k) - 1
      + (CAST('0x' || substr(md5('{seed}:' || s), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)
      / CAST(count(*) OVER (PARTITION BY s) AS DOUBLE) AS part FROM keyed),
placed AS (SELECT *, row_number() OVER (ORDER BY part, s, k) - 1 AS place, count(*) OVER () AS n FROM ranked),
sharded AS (SELECT *, ((place + 1) * {shards} - 1) // n AS shard FROM placed)
SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS size,
  CAST(xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(text)), '..'),
    lambda h: CAST('0x' || h AS BIGINT))), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) AS BIGINT) AS text_crc32,
  'rows' AS law, CAST(shard AS INTEGER) AS shard, CAST(place - (shard * n) // {shards} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM sharded, crc_table"""
