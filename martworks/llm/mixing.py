"""Mixing sources to target weights by systematic sampling.

A source's expected copies per document are its target over its size. They are
summed up along the source; a document is emitted once per integer between the
sums before and with it, shifted by one random offset of the source. Documents
stand in order of their size, so the words taken differ from the target by
less than about the longest document of the source, however sizes are spread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.llm.common import staged, text_or_empty
from martworks.llm.scan import running
from martworks.operators.ranking import dense_ids

WORD = r"[^\x20\x09-\x0D]+"
# expected copies are whole multiples of 10^-18: sums are exact, so reruns agree whatever the partitions
UNIT = 10**18


def word_count(name: str = "text"):
    return F.regexp_count(text_or_empty(name), F.lit(WORD)).cast("long")


def _big(value: int):
    return F.lit(str(value)).cast("decimal(38,0)")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """(mark, source, source_size, target, expected): per source its target in words and the expected copies of its
    documents in units of 10^-18.

    Sources by code point, null last, have the weights in turn; they share
    share[0] / share[1] of all sizes, no target passes `most` times its source.
    The level of the targets is found by rounds of one aggregate over the
    sources: those above their limit keep it, the rest share what is left by
    weight, until none is above. Only two sums a round reach the driver.
    """
    ranked = dense_ids(
        sized.groupBy("mark", "source").agg(F.sum(F.col("size").cast("decimal(38,0)")).alias("source_size")),
        [F.col("source").asc_nulls_last()], "rank", 0)
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    # everything in words * share[1], to stay with integers
    table = staged(ranked.withColumn("weight", cycle.cast("decimal(10,0)")).withColumn(
        "limit", F.col("source_size") * (most * share[1])))
    whole = table.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    left, weight = int(whole.n or 0) * share[0], int(whole.w or 0)
    total, full = left, F.lit(False)
    while weight:
        full = F.col("limit") * _big(weight) <= _big(left) * F.col("weight")
        now = table.agg(F.sum(F.when(full, F.col("limit"))).alias("n"), F.sum(F.when(~full, F.col("weight"))).alias("w")).first()
        if int(now.w or 0) == weight:
            break
        left, weight = total - int(now.n or 0), int(now.w or 0)
    part = _big(left) * F.col("weight")
    limited = F.lit(True) if not weight else full
    target = F.when(limited, (F.col("source_size") * most).cast("double")).otherwise(
        part.cast("double") / F.lit(float(max(1, weight * share[1]))))
    per = F.expr(f"(cast({left} as decimal(38,0)) * weight * {UNIT}) div (cast({max(1, weight * share[1])} as decimal(38,0)) * source_size)")
    expected = F.when(F.col("source_size") == 0, 0).when(limited, most * UNIT).otherwise(per)
    return table.select("mark", "source", F.col("source_size").cast("long").alias("source_size"), target.alias("target"),
                        expected.cast("decimal(38,0)").alias("expected"))


def mix(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), seed: int = 0, **rules) -> DataFrame:
    """One row per document: the keys, source, size, source_size, target, copies, taken (size times copies).

    No document is emitted more than `most` times. The same documents, seed and
    rules give the same copies, whatever the partitions: ties of size go by
    the keys, rows equal in those are interchangeable. Null texts have size
    0, a null source is one of its own, null keys stand first; repeated rows are
    drawn row by row; an empty table gives no rows; other columns are
    ignored and texts counted whole. Only (keys, source, size) is moved.
    """
    marked = docs.select(*keys, "source", word_count().alias("size")).withColumn(
        "mark", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    sized = staged(marked)
    targets = staged(source_targets(sized, **rules))
    known = sized.drop("source").join(targets, "mark")
    summed = running(known, "mark", [F.col("size"), *[F.col(k).asc_nulls_first() for k in keys]], {"upto": F.col("expected")})
    # 60 random bits of the source and the seed, as a part of one unit
    offset = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("mark")).cast("binary")), 1, 15), 16, 10).cast("long") % UNIT)
    drawn = summed.withColumn("_from", (F.col("upto") - F.col("expected") + offset).cast("decimal(38,0)")).withColumn(
        "_to", (F.col("upto") + offset).cast("decimal(38,0)"))
    copies = F.expr(f"_to div {UNIT} - _from div {UNIT}")
    return drawn.withColumn("copies", copies).select(
        *keys, "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, seed: int = 0, **rules) -> DataFrame:
    """The mix itself: every document as often as it was drawn, with all its columns and `copy_no` from 1.

    Rows are numbered in a written copy, so repeated rows and ids are drawn one by one.
    """
    numbered = staged(docs.withColumn("_row_no", F.monotonically_increasing_id()))
    drawn = mix(numbered, ("_row_no",), seed, **rules).where("copies > 0").select("_row_no", "copies")
    return numbered.join(drawn, "_row_no").select(
        *docs.columns, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy_no"))


# the same in SQL; the level of the targets lies between two limits in order of limit by weight
SQL = r"""
with sized as (
  select doc_id, source, coalesce('s' || source, 'n') as mark,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::hugeint as size from documents),
by_source as (
  select mark, source, sum(size)::hugeint as source_size,
         ([3, 1, 2])[1 + ((row_number() over (order by source nulls last) - 1) % 3)::int]::hugeint as weight
  from sized group by mark, source),
levels as (
  select *, (select sum(source_size) from by_source)::hugeint * 3
           - coalesce(sum(4 * source_size) over before, 0)::hugeint as rest,
         (sum(weight) over upward)::hugeint as weights from by_source
  window before as (order by source_size / weight, mark rows between unbounded preceding and 1 preceding),
         upward as (order by source_size / weight, mark rows between current row and unbounded following)),
reached as (
  select rest, weights from levels where 4 * source_size * weights > rest * weight
  order by source_size / weight, mark limit 1),
goals as (
  select mark, source_size,
         case when limited then (2 * source_size)::double else (r.rest * b.weight)::double / (2 * r.weights)::double end as target,
         case when source_size = 0 then 0::hugeint when limited then 2000000000000000000::hugeint
              else (r.rest * b.weight * 1000000000000000000::hugeint) // (2 * r.weights * source_size) end as expected
  from (select b.*, r.rest is null or 4 * b.source_size * r.weights <= r.rest * b.weight as limited
        from by_source b left join reached r on true) b left join reached r on true),
summed as (
  select s.doc_id, s.size, g.source_size, g.target, g.expected,
         (sum(g.expected) over (partition by s.mark order by s.size, s.doc_id nulls first rows unbounded preceding))::hugeint
         + (('0x' || substr(md5('0:' || s.mark), 1, 15))::bigint % 1000000000000000000)::hugeint as upto
  from sized s join goals g using (mark))
select doc_id, size::bigint as size, source_size::bigint as source_size, target,
       (size * (upto // 1000000000000000000 - (upto - expected) // 1000000000000000000))::bigint as taken from summed
"""
