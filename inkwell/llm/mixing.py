"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in hash order, are cut into blocks, and a block takes
one slot of the mixed stream.  A source of weight w out of W owes block j (from
0) a slot no earlier than its release floor(j W / w) and before its deadline
ceil((j + 1) W / w); the earliest deadline among released blocks goes first.
At any slot every source then has had its share of the slots to within less
than one block.

The pattern of W slots repeats, so it is computed once per phase: a phase is a
run of whole periods in which no source runs out.  When one is about to, what
is left of it takes part in one shorter period, and the next phase goes on
with the other sources; no document is dropped or repeated.  The patterns
depend on weights and block counts alone, and a document finds its slot by
arithmetic.

Every source found is a stream of its own; one that has no weight in the given
table takes the default weight.  What reaches the driver is one block count per
source.  Everything is DataFrame expressions.

Defined results: a null source is the stream ``other``, as is a source of that
name; a weight whose source has no rows is not used; null doc_ids are ordered
as the empty text; repeated rows each get a place; an empty table gives no
rows.  Only the named columns are read, so extra columns never clash;
``mixed`` returns all columns as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.text import bind

#: Documents of a block.
BLOCK_DOCS = 16
#: Documents of a run of the stream, inside which others may reorder them.
RUN_DOCS = 4096
#: The stream of rows without a source.
OTHER = "other"
#: Hash buckets in which a stream's documents are numbered, as a power of two;
#: hashes have 60 bits.
BUCKET_BITS, HASH_BITS = 12, 60


def phases(blocks: list[int], weights: list[int]) -> list[tuple[list[int], int]]:
    """(shares, periods) of each phase: a run of whole periods at the weights of
    the streams that are left, or one period with what is left of a stream that
    has less than its weight."""
    left, out = list(blocks), []
    while any(left):
        periods = min(n // w for n, w in zip(left, weights) if n)
        shares = [(w if periods else min(n, w)) if n else 0 for n, w in zip(left, weights)]
        periods = max(periods, 1)
        out.append((shares, periods))
        left = [n - periods * s for n, s in zip(left, shares)]
    return out


def pattern(shares: Column) -> Column:
    """The stream of each slot of one period, earliest deadline first."""
    period = F.aggregate(shares, F.lit(0), lambda total, s: total + s)

    def slots(w: Column) -> Column:
        def step(state: Column, t: Column) -> Column:
            due = F.transform(shares, lambda s, i: bind(F.get(state["done"], i), lambda d: F.when(
                (d < s) & (F.floor(d * w / s) <= t), F.struct(F.ceil((d + 1) * w / s).alias("deadline"), i.alias("stream")))))
            return bind(F.array_min(F.array_compact(due))["stream"], lambda pick: F.struct(
                F.transform(state["done"], lambda d, i: F.when(i == pick, d + 1).otherwise(d)).alias("done"),
                F.concat(state["order"], F.array(pick)).alias("order")))

        start = F.struct(F.transform(shares, lambda s: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("order"))
        return F.aggregate(F.sequence(F.lit(0), w - 1), start, step)["order"]

    return bind(period, slots)


def schedule(blocks: DataFrame, weights: dict[str, int], other_weight: int) -> DataFrame:
    """One row per stream with the phases it takes part in, by first block:
    (stream, phases array<struct<first, share, period, start, slots>>), where
    ``slots`` are the stream's slots in one period.  ``blocks`` holds (stream,
    blocks), one row per stream; equal deadlines go in the order of names."""
    spark = blocks.sparkSession
    found = sorted(tuple(r) for r in blocks.collect())
    names = [name for name, _ in found]
    rows, start, done = [], 0, [0] * len(names)
    for shares, periods in phases([n for _, n in found], [weights.get(name, other_weight) for name in names]):
        rows.append((names, shares, start, list(done)))
        start += periods * sum(shares)
        done = [d + periods * s for d, s in zip(done, shares)]
    plan = spark.createDataFrame(rows, "names array<string>, shares array<int>, start bigint, done array<bigint>")
    each = plan.withColumn("order", pattern(F.col("shares"))).select("*", F.posexplode("shares").alias("at", "share"))
    own = F.array_compact(F.transform("order", lambda o, t: F.when(o == F.col("at"), t)))
    return (each.filter("share > 0")
            .select(F.get("names", F.col("at")).alias("stream"),
                    F.struct(F.get("done", F.col("at")).alias("first"), "share", F.size("order").alias("period"),
                             "start", own.alias("slots")).alias("phase"))
            .groupBy("stream").agg(F.array_sort(F.collect_list("phase")).alias("phases")))


def mix(docs: DataFrame, weights: dict[str, int], other_weight: int, block_docs: int = BLOCK_DOCS,
        id_col: str = "doc_id", source_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with its place in the mixed stream: doc_id, source,
    stream, block, slot, release, deadline (slots), place (within the block),
    and the columns of ``keep``.

    Documents are numbered within (stream, hash bucket) after one shuffle of
    the rows; bucket offsets are a table of at most 2^BUCKET_BITS rows per
    stream, which Spark broadcasts or merges by its size, so a source with a
    third of all rows is spread over thousands of groups.  The plan of slots,
    which is broadcast, has one row per source."""
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       F.coalesce(F.col(source_col), F.lit(OTHER)).alias("stream"),
                       F.conv(F.substr(digest, F.lit(1), F.lit(HASH_BITS // 4)), 16, 10).cast("bigint").alias("hash"),
                       *(keep or [])).withColumn("bucket", F.shiftright("hash", HASH_BITS - BUCKET_BITS))
    counts = rows.groupBy("stream", "bucket").agg(F.count("*").alias("n"))
    blocks = counts.groupBy("stream").agg(F.ceil(F.sum("n") / block_docs).alias("blocks"))
    lower = Window.partitionBy("stream").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("stream", "bucket", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("before"))
    plan = schedule(blocks, weights, other_weight)
    within = Window.partitionBy("stream", "bucket").orderBy("hash", "doc_id")
    numbered = (rows.withColumn("n", F.row_number().over(within) - 1).join(offsets, ["stream", "bucket"])
                .withColumn("position", F.col("before") + F.col("n"))
                .withColumns({"block": F.floor(F.col("position") / block_docs),
                              "place": (F.col("position") % block_docs).cast("int")}))
    timed = numbered.join(F.broadcast(plan), "stream").withColumn(
        "phase", F.element_at(F.filter("phases", lambda p: p["first"] <= F.col("block")), -1)).drop("phases")
    turn = F.col("block") - F.col("phase.first")
    share, period = F.col("phase.share"), F.col("phase.period")
    timed = timed.withColumns({"begin": F.col("phase.start") + F.floor(turn / share) * period, "turn": turn % share})
    return timed.select(
        "doc_id", "source", "stream", "block",
        (F.col("begin") + F.get("phase.slots", F.col("turn").cast("int"))).alias("slot"),
        (F.col("begin") + F.floor(F.col("turn") * period / share)).alias("release"),
        (F.col("begin") + F.ceil((F.col("turn") + 1) * period / share)).alias("deadline"), "place", *(keep or []))


def mixed(docs: DataFrame, weights: dict[str, int], other_weight: int, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """All rows of ``docs`` in the order of the mixed stream: range-partitioned
    and sorted by slot and place, so files written from it hold consecutive
    slots."""
    rows = docs.select(F.struct("*").alias("row"))
    placed = mix(rows.select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source")),
                 weights, other_weight, block_docs, keep=["row"])
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(n, "slot", "place").sortWithinPartitions("slot", "place")
    return ordered.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def runs(docs: DataFrame, columns: list[str], run_docs: int = RUN_DOCS) -> DataFrame:
    """``columns`` of ``docs``, a table written from ``mixed``, and ``run``:
    the number of the run of ``run_docs`` documents of the stream that holds
    the row.  Files and their rows are in the order of the stream; one number
    per file reaches the driver."""
    name = F.col("_metadata.file_name")
    rows = docs.select(*columns, name.alias("file"), F.col("_metadata.row_index").alias("index"))
    part = F.regexp_extract("file", "^part-([0-9]+)", 1).cast("bigint")
    before, offsets = 0, []
    for _, file, n in sorted(tuple(r) for r in docs.select(name.alias("file")).groupBy("file").agg(F.count("*").alias("n")).select(part, "file", "n").collect()):
        offsets.append((file, before))
        before += n
    first = docs.sparkSession.createDataFrame(offsets, "file string, before bigint")
    return rows.join(F.broadcast(first), "file").select(*columns, F.floor((F.col("before") + F.col("index")) / run_docs).alias("run"))


def oracle(weights: dict[str, int], other_weight: int, block_docs: int = BLOCK_DOCS) -> str:
    """The rows of ``mix`` as DuckDB SQL over ``documents``."""
    given = ", ".join(f"('{name}', {w})" for name, w in sorted(weights.items()))
    return f"""
with recursive given(name, weight) as (values {given}),
hashed as (select doc_id, source, coalesce(source, '{OTHER}') as name,
                  ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint h from documents),
target as (select row_number() over (order by name) - 1 as stream, name, coalesce(g.weight, {other_weight}) as weight
           from (select distinct name from hashed) left join given g using (name)),
placed as (select doc_id, source, stream, row_number() over (partition by stream order by h, doc_id) - 1 as position
           from hashed join target using (name)),
total as (select t.stream, t.weight, count(*) n from target t join placed p using (stream) group by all),
step(p, owed, first_block, shares, periods, start) as (
  select 0, list(((n + {block_docs - 1}) // {block_docs})::bigint order by stream), list(0::bigint order by stream),
         list(0::bigint order by stream), 0::bigint, 0::bigint from total having count(*) > 0
  union all
  select p + 1, list_transform(range(len(owed)), lambda i: owed[i + 1] - greatest(m, 1) * now[i + 1]),
         list_transform(range(len(owed)), lambda i: first_block[i + 1] + periods * shares[i + 1]), now, greatest(m, 1),
         start + periods * coalesce(list_sum(shares), 0)::bigint
  from (select *, list_transform(range(len(owed)), lambda i: case when owed[i + 1] = 0 then 0 when m > 0 then w[i + 1]
                                                            else least(owed[i + 1], w[i + 1]) end)::bigint[] now
        from (select s.*, t.w, list_min(list_transform(list_filter(range(len(owed)), lambda i: owed[i + 1] > 0),
                                                       lambda i: owed[i + 1] // t.w[i + 1])) m
              from step s, (select list(weight::bigint order by stream) w from total) t
              where list_sum(owed) > 0))),
phase as (select p, shares, first_block, start, list_sum(shares)::bigint w from step where p > 0),
slots(p, t, done, pick) as (
  select p, -1::bigint, list_transform(shares, lambda s: 0::bigint), null::bigint from phase
  union all
  select p, t + 1, list_transform(range(len(done)), lambda i: done[i + 1] + (case when i = best then 1 else 0 end)), best
  from (select s.p, s.t, s.done,
               list_min(list_transform(list_filter(range(len(s.done)), lambda i: s.done[i + 1] < f.shares[i + 1]
                                                     and s.done[i + 1] * f.w // greatest(f.shares[i + 1], 1) <= s.t + 1),
                 lambda i: ((s.done[i + 1] + 1) * f.w + f.shares[i + 1] - 1) // greatest(f.shares[i + 1], 1) * 1000 + i)) % 1000 best
        from slots s join phase f on f.p = s.p where s.t + 1 < f.w)),
own as (select p, pick stream, list(t order by t) own_slots from slots where pick is not null group by all),
timed as (select d.*, position // {block_docs} as block, position % {block_docs} as place, f.*, o.own_slots
          from placed d join phase f on f.shares[d.stream + 1] > 0 and f.first_block[d.stream + 1] <= d.position // {block_docs}
          join own o on o.p = f.p and o.stream = d.stream
          qualify row_number() over (partition by d.stream, d.position order by f.p desc) = 1),
turn as (select *, shares[stream + 1] s, (block - first_block[stream + 1]) // shares[stream + 1] * w + start as begin_slot,
                (block - first_block[stream + 1]) % shares[stream + 1] as j from timed)
select doc_id, source, t.name as stream, block::bigint as block, (begin_slot + own_slots[j + 1])::bigint as slot,
       (begin_slot + j * w // s)::bigint as release, (begin_slot + ((j + 1) * w + s - 1) // s)::bigint as deadline, place::int as place
from turn join target t using (stream)
"""
