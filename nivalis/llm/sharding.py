"""Sharding by balanced label propagation.

Documents with one link value (in the query: equal texts) are linked with each other. They
start in shards dealt round-robin, and in each round move towards the shard that holds
most of their neighbours, under quotas that keep the number of rows even: as few links
as possible are cut, and in the end no shard has more than one row more than another.

Documents with the same link and the same shard have the same neighbours, so they move as a
count: the state is one row per link and shard, at most as many rows per link as there are shards, however many
copies there are. A round is

1. votes: per link, the shard with most of its documents (ties by hash); whoever sits in a shard
   with fewer asks to move there. Every second round only shards with room are voted for;
2. quotas: of the table of asked moves between pairs of shards (a few hundred numbers) the driver
   grants as many as come back the other way, and beyond those what the target has room for. Documents
   without links have no vote and take what room is left at the end, so they make way;
3. grants: per pair, the moves that gain most, by running totals over the link rows, so that the
   quota is met exactly and at most one link of a pair is split.

Where nearly all documents have links, shards may be fuller by a quarter while links gather, as swaps alone
would leave most of them cut; at the end each shard gives away what is above its share, its smallest
parts of links first, whole but for one per pair of shards.

Each granted move raises the sum of squares of a link's counts, so rounds come to an end, when nothing
is granted any more, or after `ROUNDS`; sizes are even after any number of rounds.
Documents then take the places of their link in order, those without links fill up all shards, and rows are
numbered within their shard in hashed order. Links with more than a thousandth of all rows (fewer
than 1,000, by count) meet their documents by broadcast, others by a join; numbers come
from sorts over ranges. No step brings a link or a shard into one task.

Defined results. A null text counts as an empty one, with size 1; documents without doc_id and repeated rows
are documents of their own (two equal rows are linked). An empty table gives an empty
result. Further columns are carried by shard() and ignored by plan_shards().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nivalis.llm.common import new_folder, running, stash

SHARDS = 16
ROUNDS = 40
SLACK = 1.25
HOT = 1000


def text_link(text: str = "text") -> Column:
    """128 bits of the text's SHA-256, as the link between equal texts."""
    return F.unhex(F.substring(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256), 1, 32))


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def granted_moves(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many of the asked moves between two shards may go: as many as go the other way, and what the target has room for."""
    out = {pair: min(n, asked.get(pair[::-1], 0)) for pair, n in asked.items()}
    left = list(room)
    for i, j in sorted(asked, key=lambda p: (p[1], (p[0] - p[1]) % len(room))):
        more = min(asked[i, j] - out[i, j], left[j])
        out[i, j] += more
        left[j] -= more
    return {pair: n for pair, n in out.items() if n}


def _asked(state: DataFrame, open_: list[int]) -> DataFrame:
    """link, from, to, m (documents that ask to move) and gain."""
    vote = F.struct("n", F.xxhash64("link", "shard").alias("tie"), "shard")
    best = F.max(F.when(F.col("shard").isin(open_), vote)).alias("best")
    votes = state.groupBy("link").agg(F.collect_list(vote).alias("votes"), best).where("best IS NOT NULL")
    moves = votes.select("link", "best", F.explode("votes").alias("own")).where("own < best")
    return moves.select("link", F.col("own.shard").alias("from"), F.col("best.shard").alias("to"), F.col("own.n").alias("m"), (F.col("best.n") - F.col("own.n")).alias("gain"))


def propagate(links: DataFrame, shards: int, capacity: list[int]) -> DataFrame:
    """link, shard and n: how many of a link's documents go to each shard, from links (link, members)."""
    placed = running(links.withColumn("all", F.lit(0)), "all", [F.xxhash64("link"), F.col("link")], "shard-links", "members")
    # Of the positions before ... before + members - 1, those that are s modulo the number of shards.
    up_to = lambda at: F.floor((at - 1 - F.col("shard") + shards) / shards).cast("long")
    dealt = placed.select("link", "before", "members", F.explode(F.array(*map(F.lit, range(shards)))).alias("shard"))
    state = stash(dealt.withColumn("n", up_to(F.col("before") + F.col("members")) - up_to(F.col("before"))).where("n > 0").select("link", "shard", "n"), "shard-state")
    linked, idle = links.agg(F.sum("members")).first()[0] or 0, 0
    soft = [max(c, -int(-SLACK * linked // shards)) for c in capacity]
    for turn in range(ROUNDS):
        held = dict(state.groupBy("shard").agg(F.sum("n")).collect())
        room = [soft[j] - held.get(j, 0) for j in range(shards)]
        open_ = [j for j in range(shards) if turn % 2 == 0 or room[j] > 0]
        moves = stash(_asked(state, open_).withColumn("pair", F.col("from") * shards + F.col("to")), "shard-moves") if open_ else None
        asked = {} if moves is None else {divmod(r["pair"], shards): r["m"] for r in moves.groupBy("pair").agg(F.sum("m").alias("m")).collect()}
        allowed = granted_moves(asked, room)
        if not allowed:
            idle += 1
            if idle == 2 or (not asked and turn % 2 == 0):  # nothing to gain, or no way to gain it
                break
            continue
        idle = 0
        if allowed == asked:
            granted = moves.withColumn("g", F.col("m"))
        else:
            limits = F.create_map(*[F.lit(x) for (i, j), n in allowed.items() for x in (i * shards + j, n)])
            ranked = running(moves, "pair", [F.col("gain").desc(), F.xxhash64("link"), F.col("link")], "shard-ranked", "m")
            limit = F.coalesce(F.try_element_at(limits, F.col("pair")), F.lit(0))
            granted = ranked.withColumn("g", F.greatest(F.lit(0), F.least("m", limit - F.col("before"))))
        left = granted.select("link", F.col("from").alias("shard"), (-F.col("g")).alias("n"))
        came = granted.select("link", F.col("to").alias("shard"), F.col("g").alias("n"))
        state = _moved(state, left, came)
    return _evened(state, shards, capacity)


def _moved(state: DataFrame, left: DataFrame, came: DataFrame) -> DataFrame:
    return stash(state.unionByName(left).unionByName(came).groupBy("link", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "shard-state")


def _evened(state: DataFrame, shards: int, capacity: list[int]) -> DataFrame:
    """state with what a shard has above its capacity, its smallest parts of links first, laid end to end over the room of the others."""
    held = dict(state.groupBy("shard").agg(F.sum("n")).collect())
    room = [capacity[j] - held.get(j, 0) for j in range(shards)]
    if min(room) >= 0:
        return state
    starts, gaps, given, taken = [], [], 0, 0
    for j, r in enumerate(room):
        starts.append(given)
        given += max(0, -r)
        if r > 0:
            gaps.append((j, taken, taken + r))
            taken += r
    of = lambda values: F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col("shard") + 1)
    ranked = running(state.where(F.col("shard").isin([j for j, r in enumerate(room) if r < 0])), "shard", [F.col("n"), F.xxhash64("link"), F.col("link")], "shard-excess", "n")
    gone = ranked.withColumn("m", F.least("n", of([-min(0, r) for r in room]) - F.col("before"))).where("m > 0").withColumn("at", of(starts) + F.col("before"))
    gap = F.explode(F.array(*[F.struct(F.lit(j).alias("to"), F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for j, a, b in gaps])).alias("gap")
    parts = gone.select("link", "at", "m", gap).withColumn("n", F.least(F.col("at") + F.col("m"), F.col("gap.b")) - F.greatest("at", F.col("gap.a"))).where("n > 0")
    return _moved(state, gone.select("link", "shard", (-F.col("m")).alias("n")), parts.select("link", F.col("gap.to").alias("shard"), "n"))


def place(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """rows (row, a unique number; link, or null; order, a column to sort by; whatever else) with shard and slot."""
    total = rows.count()
    capacity = quotas(total, shards)
    links = stash(rows.where("link IS NOT NULL").groupBy("link").agg(F.count("*").alias("members")).where("members > 1"), "shard-groups")
    state = propagate(links, shards, capacity)
    held = dict(state.groupBy("shard").agg(F.sum("n")).collect())
    # A link's places: up to which of its documents each shard takes.
    ends = F.expr("transform(p, (x, i) -> struct(x.shard AS shard, aggregate(slice(p, 1, i + 1), 0L, (t, y) -> t + y.n) AS upto))")
    places = state.groupBy("link").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("p"), F.sum("n").alias("members")).select("link", "members", ends.alias("places"))
    places = stash(places, "shard-places")
    hot = places.where(F.col("members") > total / HOT).select("link", F.col("places").alias("hot"))
    tagged = rows.join(F.broadcast(hot), "link", "left")
    easy = tagged.where("hot IS NOT NULL").withColumnRenamed("hot", "places")
    met = stash(easy.unionByName(tagged.where("hot IS NULL").drop("hot").join(places.select("link", "places"), "link", "left")), "shard-linked")
    order = [F.xxhash64("order"), F.col("order"), F.col("row")]
    linked = running(met.where("places IS NOT NULL"), "link", order, "shard-order")
    first = F.expr("filter(places, p -> before < p.upto)[0].shard")
    free, upto = F.lit(None).cast("int"), total - sum(held.values())
    for j in reversed(range(shards)):
        free = F.when(F.col("before") < upto, j).otherwise(free)
        upto -= capacity[j] - held.get(j, 0)
    alone = running(met.where("places IS NULL").withColumn("all", F.lit(0)), "all", order, "shard-alone").drop("all")
    both = linked.withColumn("shard", first).unionByName(alone.withColumn("shard", free)).drop("before", "places")
    return running(both, "shard", order, "shard-slots").withColumnRenamed("before", "slot")


def _keyed(docs: DataFrame, link: Column, *more: Column) -> DataFrame:
    return docs.select(link.alias("link"), F.col("doc_id").alias("order"), F.monotonically_increasing_id().alias("row"), *more)


def plan_shards(docs: DataFrame, shards: int = SHARDS, text: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, shard and slot (from 0 in each shard) of every row."""
    own = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = stash(_keyed(docs, text_link(text), (F.octet_length(own) + 1).cast("long").alias("size"), F.crc32(own).alias("text_crc32")), "shard-rows")
    return place(rows, shards).select(F.col("order").alias("doc_id"), "size", "text_crc32", "shard", "slot")


def shard(docs: DataFrame, shards: int = SHARDS, link: Column | None = None) -> DataFrame:
    """The rows of docs with `shard` and `slot` (columns of these names are replaced); documents of one link value stay together where room allows."""
    rows = stash(_keyed(docs, text_link() if link is None else link, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")), "shard-documents")
    found = place(rows.drop("doc"), shards).select("row", "shard", "slot")
    kept = [F.col(f"doc.`{c}`") for c in docs.columns if c not in ("shard", "slot")]
    return rows.join(found, "row").select(*kept, "shard", "slot")


def write_shards(docs: DataFrame, path: str | None = None, shards: int = SHARDS, link: Column | None = None) -> str:
    """Writes shard=0/ ... below path, each file in slot order; a shard has as many files as tasks hold a range of it."""
    path = path or new_folder(docs.sparkSession, "shards")
    parts = max(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shard(docs, shards, link).repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path
