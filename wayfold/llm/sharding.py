"""Balanced label propagation: documents to shards of equal row counts, linked documents together. DataFrame operations only.

Documents of one group (by default: of equal text) are linked. Linked documents start spread evenly. In each round every group counts its
members by shard (map-side first), its members want to go where most of it is, and moves are let through under quotas: swaps between two shards
always, further moves as far as the target has room, whole groups before parts of others. Sizes thus never pass a shard's share. Every move brings a member
to where most of its group is, so that each round lowers the number of cut links (`cut_links`), and rounds go on until no move passes. Unlinked documents then fill
every shard to its share exactly: counts are at most one apart.

Ranks and slots come from counts by hash bucket and row numbers inside buckets of about a thousand rows, so no window sees a whole shard, however hot
a group is. A group larger than a shard's share is split over shards. The driver sees a flow matrix of shards x shards counts.

Defined cases: null text has size 1 and CRC 0, and equals the empty text in its group; rows with a null or repeated doc_id are placed each (those with a null
doc_id are spread by their place in the table); extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfold.llm.common import Scratch, power_of_two

FAN = 1024


def ranked(df: DataFrame, by: list[str], bucket: str, order: list[Column | str], name: str) -> DataFrame:
    """Adds `name`: ranks from 0 without gaps inside each value of `by`, in the order of (bucket, order)."""
    sizes = df.groupBy(*by, bucket).agg(F.count("*").alias("n_")).withColumn("hi_", F.floor(F.col(bucket) / FAN))
    totals = sizes.groupBy(*by, "hi_").agg(F.sum("n_").alias("n_"))
    before = Window.partitionBy(*by).orderBy("hi_").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("base_", F.coalesce(F.sum("n_").over(before), F.lit(0))).drop("n_")
    inner = Window.partitionBy(*by, "hi_").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("inner_", F.coalesce(F.sum("n_").over(inner), F.lit(0))).join(totals, [*by, "hi_"])
    offsets = offsets.select(*by, bucket, (F.col("base_") + F.col("inner_")).alias("offset_"))
    place = F.row_number().over(Window.partitionBy(*by, bucket).orderBy(*order)) - 1
    return df.withColumn("place_", place).join(offsets, [*by, bucket]).withColumn(name, (F.col("offset_") + F.col("place_")).cast("long")).drop("place_", "offset_")


def quotas(flow: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many moves from s to t pass: swaps, then what t has room for."""
    out, left = {}, list(room)
    for (s, t), n in sorted(flow.items()):
        out[s, t] = min(n, flow.get((t, s), 0))
    for (s, t), n in sorted(flow.items()):
        more = min(n - out[s, t], left[t])
        out[s, t] += more
        left[t] -= more
    return out


def _pick(values: dict[int, int], key: Column, default: int = 0) -> Column:
    out = F.lit(default)
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, and the group's key: two hashes of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("g1"), F.xxhash64(F.lit("second"), text).alias("g2"),
    )


def cut_links(placed: DataFrame, by: list[str]) -> DataFrame:
    """links and cut_links, one row: pairs of rows that share a group (columns `by`), and those of them that lie in two shards. Counted, never written out."""
    inside = placed.groupBy(*by, "shard").agg(F.count("*").cast("decimal(38,0)").alias("n"))
    pairs = lambda n: n * (n - 1) / 2
    groups = inside.groupBy(*by).agg(F.sum("n").alias("all"), F.sum(pairs(F.col("n"))).alias("within"))
    total = groups.agg(F.sum(pairs(F.col("all"))).alias("links"), F.sum("within").alias("within"))
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("decimal(38,0)")
    return total.select(whole(F.col("links")).alias("links"), whole(F.col("links") - F.col("within")).alias("cut_links"))


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law ('rows'), shard, slot (gapless from 0 in each shard), grown_shard (null under this law)."""
    with Scratch(docs.sparkSession, "shards") as scratch:
        rows = scratch.put("measured", measured(docs).withColumn("row", F.monotonically_increasing_id()))
        n = rows.count()
        share = [n // shards + (s < n % shards) for s in range(shards)]
        buckets = power_of_two(n / 1000, 16)
        order = ["h", "doc_id", "text_crc32", "size"]
        rows = rows.withColumn("h", F.xxhash64(F.coalesce("doc_id", F.col("row")), "text_crc32")).drop("row").withColumn("bucket", F.pmod("h", F.lit(buckets)))
        groups = scratch.put("groups", rows.groupBy("g1", "g2").agg(F.count("*").alias("members")).where("members > 1"))
        linked = rows.join(groups, ["g1", "g2"])
        linked = scratch.put("linked", ranked(linked, [], "bucket", order, "at").withColumn("shard", (F.col("at") % shards).cast("int")).drop("at"))
        while True:
            votes = linked.groupBy("g1", "g2", "shard").agg(F.count("*").alias("n"))
            tie = F.pmod(F.xxhash64("g1", "shard"), F.lit(1 << 20))
            wants = scratch.put("wants", votes.groupBy("g1", "g2").agg(F.max_by("shard", F.struct("n", tie)).alias("want")))
            state = scratch.put("state", linked.join(wants, ["g1", "g2"]))
            flow, load = {}, [0] * shards
            for r in state.groupBy("shard", "want").count().collect():  # at most shards x shards rows
                load[r.shard] += r["count"]
                if r.shard != r.want:
                    flow[r.shard, r.want] = r["count"]
            passed = quotas(flow, [c - x for c, x in zip(share, load, strict=True)])
            if not sum(passed.values()):
                break
            state = state.withColumn("move", F.col("shard") * shards + F.col("want"))
            movers = state.where("shard <> want").withColumn("together", F.pmod("g1", F.lit(64)) * buckets + F.col("bucket"))
            movers = ranked(movers, ["move"], "together", order, "at")
            allowed = _pick({s * shards + t: q for (s, t), q in passed.items()}, F.col("move"))
            moved = movers.withColumn("shard", F.when(F.col("at") < allowed, F.col("want")).otherwise(F.col("shard"))).select(linked.columns)
            linked = scratch.put("linked", state.where("shard = want").select(linked.columns).unionByName(moved))
        single = rows.join(groups.select("g1", "g2"), ["g1", "g2"], "left_anti")
        single = ranked(single, [], "bucket", order, "at")
        to, end = F.lit(shards - 1), sum(share) - sum(load)
        for s in range(shards - 1, -1, -1):
            to = F.when(F.col("at") < end, F.lit(s)).otherwise(to)
            end -= share[s] - load[s]
        keep = ["doc_id", "size", "text_crc32", "h", "bucket", "shard"]
        placed = scratch.put("placed", single.withColumn("shard", to.cast("int")).select(keep).unionByName(linked.select(keep)))
        scratch.keep("placed")
    out = ranked(placed, ["shard"], "bucket", order, "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
