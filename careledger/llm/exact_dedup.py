"""Operator 3, exact dedup (DataFrame functions only).

Texts are equal when they are identical after deleting all white space.  The
work is a skew-safe combine in three steps, each of which groups by the whole
normalised content beside its digest:

1. every task combines its own equal texts (map-side partial aggregate),
2. the task winners of a digest merge in ``salts`` parts, so a text that a
   third of all rows repeat is spread over that many tasks,
3. the part winners (at most ``salts`` rows a text) combine globally.

The decision then goes back to the rows by digest; only where one digest
stands for several contents the whole contents are compared once more.

Defined results: a null text is the empty text.  Of equal texts the row with
the most code points in its original text stays, then the smallest id (a null
id sorts first).  Rows that repeat id, length and normalised text of the
winner are interchangeable: exactly one of them is kept.  An empty table gives
an empty result.  Other columns of the input, whatever their names, are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careledger.llm.common import SPACES, columns_of, id_key, spare_names, stored


def _contents(docs: DataFrame, id_col: str, text_col: str, digest_bits: int) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.char_length(text).alias("n_chars"),
                       F.regexp_replace(text, SPACES, "").alias("content")) \
        .withColumn("digest", F.sha2("content", digest_bits))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32,
                digest_bits: int = 256) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, digest, n_chars."""
    rows = _contents(docs, id_col, text_col, digest_bits)
    slim = stored(rows.select("id", "n_chars", "digest", F.monotonically_increasing_id().alias("row")), "exact-rows")
    best = F.min(F.struct((-F.col("n_chars")).alias("short"), F.col("id").alias("id")))
    parts = (rows.withColumn("salt", F.pmod(F.xxhash64("id", "n_chars"), F.lit(salts)))
             .groupBy("digest", "salt", "content").agg(best.alias("best"), F.count(F.lit(1)).alias("size")))
    texts = (parts.repartition("digest").groupBy("digest", "content")
             .agg(F.min("best").alias("best"), F.sum("size").alias("size")))
    # One entry per content of a digest; the content itself is kept only where it is needed to tell them apart.
    digests = stored(
        texts.groupBy("digest").agg(F.collect_list(F.struct("content", "best", "size")).alias("c"))
        .withColumn("c", F.when(F.size("c") == 1, F.transform(
            "c", lambda x: F.struct(F.lit(None).cast("string").alias("content"), x.best.alias("best"),
                                    x.size.alias("size")))).otherwise(F.col("c"))), "exact-texts")
    one = digests.where(F.size("c") == 1).select("digest", F.col("c")[0].alias("c"))
    parts_of = slim.withColumn("_part", F.pmod(F.xxhash64("row"), F.lit(salts)))
    heads = parts_of.select("digest", "_part").distinct().join(one, "digest")
    decided = parts_of.join(heads, ["digest", "_part"]).drop("_part")
    wins = F.col("id").eqNullSafe(F.col("c.best.id")) & (F.col("n_chars") == -F.col("c.best.short"))
    # Of winners that are alike the first row stays; a minimum by digest is combined before it is shuffled.
    first = decided.where(wins).groupBy("digest").agg(F.min("row").alias("row")).withColumn("copy", F.lit(1))
    decided = decided.join(first, ["digest", "row"], "left").drop("row")
    several = digests.where(F.size("c") > 1).select("digest", F.explode("c").alias("c"))
    if not several.isEmpty():
        again = Window.partitionBy("digest", "c.content", id_key("id"), "n_chars").orderBy("n_chars")
        hit = rows.join(several, (rows.digest == several.digest) & (rows.content == several.c.content)) \
            .select(rows.digest, "id", "n_chars", "c").withColumn("copy", F.row_number().over(again))
        decided = decided.unionByName(hit)
    return decided.select("id", F.col("c.best.id").alias("keep_id"), F.col("c.size").alias("group_size"),
                          (wins & F.coalesce(F.col("copy") == 1, F.lit(False))).alias("kept"), "digest", "n_chars")


def keep_one_of_equal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    keys = spare_names(docs, "key", "digest", "chars")
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(
        *[c.alias(k) for c, k in zip((id_key("id"), F.col("digest"), F.col("n_chars")), keys, strict=True)])
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = (id_key(id_col), F.sha2(F.regexp_replace(text, SPACES, ""), 256), F.char_length(text))
    keyed = docs.withColumns(dict(zip(keys, own, strict=True)))
    return keyed.join(kept, keys, "left_semi").dropDuplicates(keys).select(*columns_of(docs))
