"""Balanced label propagation: linked documents gather in shards of equal row counts.

Documents are linked through hubs (here: equal texts), each through one at most.
In rounds, hubs ask for the shard most of their documents are in, and whole hubs
move there as far as its quota allows; those refused ask again for what is still
open. Documents without links then fill the shards up to counts at most one apart.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tableferry.sources.scratch import discard, stored

BUCKETS = 4096
# What a row's place rests on, in the order in which rows move on to even the counts out.
ALONE, SPLIT, WHOLE = 0, 1, 2
# Requests are granted in cells of hubs of about one size: so many sizes and so many shares per doubling.
SIZES, SHARES = 8, 64
PLACED = "hub string, targets array<struct<end: long, shard: int>>, level int"


def _quota(total: int, shards: int) -> list[int]:
    """Rows of each shard, at most one apart."""
    return [total // shards + (s < total % shards) for s in range(shards)]


def _spread(large: list[tuple[str, int, dict]], room: list[int]) -> list[tuple]:
    """Several shards for each hub larger than a shard: whole empty ones, then the rest in one more.

    What they take leaves ``room``. There are fewer such hubs than shards.
    """
    empty, out = list(room), []
    for hub, n, votes in sorted(large, key=lambda h: (-h[1], h[0])):
        order = sorted(range(len(room)), key=lambda s: (-votes.get(s, 0), s))
        rest, targets = n, []
        for s in order:
            if 0 < room[s] == empty[s] <= rest:
                rest, room[s] = rest - room[s], 0
                targets.append((n - rest, s))
        if rest:
            # a shard already begun if the rest fits there, else the one with most room
            begun = [s for s in order if rest <= room[s] < empty[s]]
            s = begun[0] if begun else max(order, key=lambda s: room[s])
            room[s] -= min(room[s], rest)
            targets.append((n, s))
        out.append((hub, targets, SPLIT))
    return out


def _asked(room: list[int], turn: int) -> Column:
    """The shard a hub of ``n`` documents asks for: most votes of those with room for it; null if there is none."""
    shards = F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(r).cast("long").alias("room")) for s, r in enumerate(room)])
    fits = F.filter(shards, lambda o: o["room"] >= F.col("n"))
    ranked = F.transform(
        fits,
        lambda o: F.struct(
            F.coalesce(F.try_element_at("votes", o["shard"]), F.lit(0).cast("long")).alias("votes"),
            F.xxhash64(F.lit(turn), "hub", o["shard"]).alias("tie"),
            o["shard"].alias("shard"),
        ),
    )
    return F.array_max(ranked)["shard"]


def _granted(left: DataFrame, room: list[int], turn: int) -> DataFrame:
    """``left`` with the shard each hub asks for and whether that takes it, large hubs first.

    Requests for a shard are summed in cells, and cells are granted in order while
    they fit. Within a size a cell holds a share of the hubs, each share a little
    larger than the one before, so the cell that no longer fits is a small part of
    what was granted, at any number of hubs.
    """
    share = (F.shiftrightunsigned(F.xxhash64(F.lit(-1 - turn), "hub"), 11) + 1) / F.lit(float(1 << 53))
    asking = left.withColumn("ask", _asked(room, turn)).withColumns({
        "rank": F.floor(F.log2(F.col("n").cast("double")) * SIZES).cast("int"),
        "cell": F.floor(-F.log2(share) * SHARES).cast("int"),
    })
    cells = asking.where(F.col("ask").isNotNull()).groupBy("ask", "rank", "cell").agg(F.sum("n").alias("rows"))
    # a bounded number of cells a shard, whatever the input
    order = Window.partitionBy("ask").orderBy(F.desc("rank"), F.desc("cell"))
    open_ = F.get(F.array(*[F.lit(r).cast("long") for r in room]), F.col("ask"))
    taken = cells.withColumn("upto", F.sum("rows").over(order)).where(F.col("upto") <= open_)
    taken = taken.select("ask", "rank", "cell", F.lit(True).alias("granted"))
    out = asking.join(taken, ["ask", "rank", "cell"], "left")
    return out.select("hub", "n", "votes", "ask", F.coalesce("granted", F.lit(False)).alias("granted"))


def propagate(links: DataFrame, quota: list[int]) -> tuple[DataFrame, list[int]]:
    """``hub, targets, level`` for ``links`` of ``hub, label``, a row per document; and the links cut, round by round.

    A document has one hub at most, so a hub's counts per label are the votes of
    its documents' neighbours. In each round every hub that is not whole yet asks
    for the shard with most of its votes, of those that have room for all of it;
    a hash settles equal votes. Each shard grants requests up to its room, those
    of large hubs first. Only whole hubs take up room: documents of hubs that
    still ask count as leaving, so that full shards exchange documents. Hubs
    refused ask again in the next round; the rounds end when no shard has room
    for a hub that is left. Each round takes up more than half of the room of a
    shard that refuses some, so the rounds grow with the logarithm of the rows.

    Of a hub's documents those whose drawn place is below an ``end`` of
    ``targets`` go to its shard. The level is WHOLE where all go to one; no shard
    gets more than its quota of these. It is SPLIT for hubs larger than a shard,
    and for those the rounds left, which keep the label with most votes. The
    latter are fewer than the shards, as no shard has room for the smallest.

    A link is cut where a document is not with most of its hub's; their number is
    given before the first round and after each, hubs larger than a shard apart.
    The driver sees the room of each shard and the hubs larger than one.
    """
    spark = links.sparkSession
    votes = links.groupBy("hub", "label").agg(F.count("*").alias("n"))
    # of a hub at most one entry a shard
    entries = F.collect_list(F.struct("label", "n"))
    hubs = votes.groupBy("hub").agg(F.sum("n").alias("n"), F.map_from_entries(entries).alias("votes"))
    hubs, path = stored(hubs.where(F.col("n") > 1), "hubs")
    paths, room, largest = [path], list(quota), max(quota, default=0)
    large = [(r["hub"], r["n"], r["votes"]) for r in hubs.where(F.col("n") > largest).collect()]
    placed = spark.createDataFrame(_spread(large, room), PLACED)
    left, cuts, asks = hubs.where(F.col("n") <= largest), [], True
    apart = F.col("n") - F.array_max(F.map_values("votes"))
    while asks:
        turned, path = stored(_granted(left, room, len(paths)), "round")
        paths.append(path)
        told = turned.groupBy("ask", "granted").agg(F.sum("n").alias("n"), F.sum(apart).alias("cut")).collect()
        for r in told:
            if r["granted"]:
                room[r["ask"]] -= r["n"]
        if not cuts:
            cuts.append(sum(r["cut"] for r in told))
        cuts.append(sum(r["cut"] for r in told if not r["granted"]))
        asks = any(r["ask"] is not None and not r["granted"] for r in told)
        whole = F.array(F.struct(F.col("n").alias("end"), F.col("ask").alias("shard")))
        placed = placed.union(turned.where("granted").select("hub", whole, F.lit(WHOLE)))
        left = turned.where("not granted").select("hub", "n", "votes")
    most = F.array_max(F.transform(F.map_entries("votes"), lambda e: F.struct(e["value"], -e["key"])))["col2"]
    kept = F.array(F.struct(F.col("n").alias("end"), (-most).alias("shard")))
    # stored, so that a join with it has two fresh exchanges and a large hub can be split
    placed, _ = stored(placed.union(left.select("hub", kept, F.lit(SPLIT))), "placed")
    for path in paths:
        discard(spark, path)
    return placed, cuts


def _plan(cells: list[tuple[int, int, int, int]], quota: list[int]) -> tuple[list[tuple], list[tuple[int, int, int, int]]]:
    """What each cell gives up and where that goes, so that each shard holds its quota.

    ``cells`` are (label, level, bucket, rows). Returns per cell (label, level,
    bucket, given up, their first place among all given up, first slot of those
    that stay), and per receiving shard (first place, end, shard, first slot).
    """
    shards = len(quota)
    held = [0] * shards
    for label, _, _, n in cells:
        held[label] += n
    surplus = [max(0, h - q) for h, q in zip(held, quota)]
    place, slot, out = 0, [0] * shards, []
    # rows that are alone go first, those of whole hubs last
    for label, level, bucket, n in sorted(cells):
        give = min(n, surplus[label])
        surplus[label] -= give
        out.append((label, level, bucket, give, place, slot[label]))
        place += give
        slot[label] += n - give
    wanted = [max(0, q - h) for h, q in zip(held, quota)]
    ends = list(accumulate(wanted))
    return out, [(e - w, e, s, slot[s]) for s, (w, e) in enumerate(zip(wanted, ends)) if w]


def even_out(rows: DataFrame, quota: list[int], buckets: int = BUCKETS) -> DataFrame:
    """Add ``shard`` and ``slot`` to rows of ``uid, label, level``: each shard holds its quota, slots gapless.

    Rows are counted per shard, level and hash bucket; from these counts, at most
    ``3 * shards * buckets`` numbers, the driver works out how many rows of each
    bucket move on, so a row needs its place within its bucket only.
    """
    spark: SparkSession = rows.sparkSession
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("uid"), F.lit(buckets)).cast("int"))
    counted = rows.groupBy("label", "level", "bucket").count().collect()
    cells, receivers = _plan([tuple(r) for r in counted], quota)
    plan = spark.createDataFrame(
        cells or [(0, 0, 0, 0, 0, 0)],
        "label int, level int, bucket int, give long, place long, first long",
    )
    near = Window.partitionBy("label", "level", "bucket").orderBy("uid")
    # the plan has a bounded number of rows, whatever the input
    out = rows.withColumn("nth", F.row_number().over(near) - 1).join(F.broadcast(plan), ["label", "level", "bucket"])
    place = F.col("place") + F.col("nth")
    shard, slot = F.lit(None).cast("int"), F.lit(None).cast("long")
    for start, end, number, first in receivers:
        here = (place >= start) & (place < end)
        shard = F.when(here, F.lit(number)).otherwise(shard)
        slot = F.when(here, place - start + first).otherwise(slot)
    stays = F.col("nth") >= F.col("give")
    return out.select(
        *[c for c in rows.columns if c not in ("label", "level", "bucket")],
        F.when(stays, F.col("label")).otherwise(shard).cast("int").alias("shard"),
        F.when(stays, F.col("first") + F.col("nth") - F.col("give")).otherwise(slot).cast("long").alias("slot"),
    )


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, group, shard, slot`` of every row; row counts of shards are at most one apart.

    ``size`` is the text's bytes plus 1, ``group`` stands for equal texts, and
    groups stay together but for fewer of them than there are shards (see
    :func:`propagate`) and those larger than a shard, which spread over several. Null texts have size 1, a
    null checksum and no group. Repeated rows and ids are separate rows; a null
    id is kept as it is. Other columns are ignored. An empty table gives no rows.
    """
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text_col).alias("text_crc32"),
        F.sha2(text_col, 256).alias("group"),
        F.monotonically_increasing_id().alias("uid"),
    )
    # written once, so that a row keeps its number however often it is read
    base, _ = stored(base, "shard-rows")
    quota = _quota(base.count(), shards)
    start = F.pmod(F.xxhash64(F.lit("start"), "uid"), F.lit(shards)).cast("int")
    links = base.where(F.col("group").isNotNull()).select(F.col("group").alias("hub"), start.alias("label"))
    hubs, _ = propagate(links, quota)
    drawn = F.pmod(F.xxhash64(F.lit("pick"), "uid"), F.try_element_at("targets", F.lit(-1))["end"])
    label = F.coalesce(F.get(F.filter("targets", lambda t: t["end"] > drawn), F.lit(0))["shard"], start)
    rows = base.join(hubs, F.col("group") == F.col("hub"), "left").select(
        *base.columns, label.alias("label"), F.coalesce("level", F.lit(ALONE)).alias("level")
    )
    return even_out(rows, quota).drop("uid")
