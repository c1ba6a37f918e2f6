"""Chat formatting: conversations logged again and again as they grow are collapsed to the longest, then rendered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Turn numbers of one part: of a very long conversation, each part is hashed and rendered apart.
PART = 64


def _turns(turns: DataFrame) -> DataFrame:
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.where("conv_id is not null").distinct()


def maximal(turns: DataFrame, part: int = PART) -> DataFrame:
    """conv_id of the conversations that are no beginning of a longer one; of equal ones, the smallest.

    A turn hashes with its number, role and text to 128 bits, and the hash of a beginning is the exclusive or of its turns',
    so it is added up by part and over the parts before: a conversation with a third of all turns is split. Beginnings
    are made distinct before the anti-join, so a first turn shared by most conversations is one row there."""
    rows = _turns(turns).withColumn("part", F.floor(F.col("turn") / part))
    rows = rows.select("conv_id", "part", "turn", "role", "text", F.xxhash64("turn", "role", "text").alias("x"), F.xxhash64(F.lit(1), "text", "role", "turn").alias("y"))
    parts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    whole = parts.groupBy("conv_id").agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.bit_xor("x").over(before), F.lit(0)).alias("x0"), F.coalesce(F.bit_xor("y").over(before), F.lit(0)).alias("y0"))
    # Lead also tells the last turn, which is no beginning of something longer.
    within = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text", "x", "y")
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = rows.select("conv_id", "part", F.row_number().over(within).cast("long").alias("n1"), F.bit_xor("x").over(so_far).alias("x1"), F.bit_xor("y").over(so_far).alias("y1"))
    begun = rolled.join(shift, ["conv_id", "part"]).select("conv_id", (F.col("n0") + F.col("n1")).alias("n"), F.col("x0").bitwiseXOR(F.col("x1")).alias("x"), F.col("y0").bitwiseXOR(F.col("y1")).alias("y"))
    ends = whole.select(F.col("conv_id"), F.col("n").alias("all"))
    proper = begun.join(ends, "conv_id").where("n < all").select("n", "x", "y").distinct()
    return whole.groupBy("n", "x", "y").agg(F.min("conv_id").alias("conv_id")).join(proper, ["n", "x", "y"], "left_anti").select("conv_id")


def chat_texts(turns: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, part, n_turns and text of the maximal conversations, their turns in order between role markers.

    A conversation is one row per `part` turn numbers, so usually one row; part counts from 0. Rows without a conv_id belong
    to no conversation and are left out; a null turn number comes first, as -1; null roles and texts are empty; repeated
    rows count once; turns of one number are ordered by role and text; other columns are left out."""
    rows = _turns(turns).withColumn("part", F.floor(F.col("turn") / part))
    kept = rows.join(maximal(turns, part).withColumnRenamed("conv_id", "keep"), F.col("conv_id") == F.col("keep"), "left_semi")
    listed = kept.repartition("conv_id", "part").groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    shown = F.transform("turns", lambda t: F.concat(F.lit("<|im_start|>"), t["role"], F.lit("\n"), t["text"], F.lit("<|im_end|>\n")))
    return listed.select("conv_id", F.col("part").cast("long").alias("part"), F.size("turns").cast("long").alias("n_turns"), F.array_join(shown, "").alias("text"))


CHAT_SQL = f"""
with t as (
  select distinct conv_id, coalesce(turn, -1) as turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null
), c as (
  select conv_id, list(struct_pack(t := turn, r := role, x := text) order by turn, role, text) as l from t group by conv_id
), k as (
  select a.conv_id from c a
  where not exists (select 1 from c b where len(b.l) > len(a.l) and b.l[1:len(a.l)] = a.l)
    and not exists (select 1 from c b where b.l = a.l and b.conv_id < a.conv_id)
)
select conv_id, cast(floor(turn / {PART}.0) as bigint) as part, count(*) as n_turns,
  string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' order by turn, role, text) as text
from t where conv_id in (select conv_id from k) group by 1, 2
"""
