"""URL filters: rules first, then a ratio of two character language models.

Rules name a host (and all its subdomains) and the beginning of a path; of the
rules that fit, the longest decides. All urls that a rule decides train two
variable-order Markov models, one for accepted and one for rejected urls: counts
of all character strings of up to `ORDER` + 1 characters are gathered by Spark
over the whole table, and probabilities back off smoothly from the longest known
context (Witten-Bell). A url that no rule decides is blocked if its
length-normalised log-likelihood difference (rejected less accepted) is above a
threshold; that is calibrated on a fifth of the rule-decided urls, which the
counts leave out, as the cut that best separates the two kinds.

Models of at most `MAX_STRINGS` strings each are broadcast. Larger ones stay in Spark,
whole, and urls are scored by joins, with the same results. The threshold is looked for in
steps of 1 / `BINS`; differences beyond 5 either way count as 5.

Defined results. A null url, or one without ://, has empty host and path, fits no
rule and is judged as the empty string. Without urls of both kinds everything
undecided is allowed. Ties between rules of equal length go to the first by
name. Repeated rows are judged alike; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nivalis.llm.common import stash

ORDER = 4
MAX_STRINGS = 300_000
HOT_STRINGS = 10_000
BINS = 100
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
START = "\x02"
END = "\x03"


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return tuple(F.coalesce(c, F.lit("")) for c in (_lower(F.regexp_extract(url, parts, 1)), F.regexp_extract(url, parts, 2)))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # a later, longer one wins
        at, slash, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def decided(pages: DataFrame, rules=RULES) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    own = pages.select("page_id", F.col("url").cast("string").alias("url"), host.alias("host"), path.alias("path"))
    own = own.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdicts = F.create_map(*[F.lit(x) for verdict, rule in rules for x in (rule, verdict)])
    return own.withColumn("by_rule", F.element_at(verdicts, F.col("rule")))


def strings_of(url: str, order: int = ORDER):
    """Every character with each of its contexts of 0 to `order` characters."""
    s = START + url + END
    for end in range(2, len(s) + 1):
        for size in range(1, min(order + 1, end) + 1):
            yield s[end - size : end]


class Markov:
    """A smoothed variable-order model from counts of strings."""

    def __init__(self, counts: dict[str, int], order: int = ORDER):
        self.counts, self.order = counts, order
        self.total: Counter = Counter()
        self.kinds: Counter = Counter()
        for s, n in counts.items():
            self.total[s[:-1]] += n
            self.kinds[s[:-1]] += 1

    def log_likelihood(self, url: str) -> float:
        s = START + url + END
        out = 0.0
        for end in range(2, len(s) + 1):
            p = 1 / 256
            for size in range(1, min(self.order + 1, end) + 1):
                part = s[end - size : end]
                total = self.total.get(part[:-1])
                if not total:
                    break
                kinds = self.kinds[part[:-1]]
                p = (self.counts.get(part, 0) + kinds * p) / (total + kinds)
            out += math.log(p)
        return out


def difference(url: str | None, accepted: Markov, rejected: Markov) -> float:
    """Per character (the end counts as one); above 0 the url is likelier a rejected one."""
    u = url or ""
    return (rejected.log_likelihood(u) - accepted.log_likelihood(u)) / (len(u) + 1)


def _exploded(urls: DataFrame, keys: list[str], of) -> DataFrame:
    """Counts n of the strings s that of() gives, per keys; added up within each batch only."""
    kinds = {f.name: f.dataType.simpleString() for f in urls.schema.fields}

    def run(batches):
        for batch in batches:
            seen: Counter = Counter()
            for *own, url in zip(*(batch.column(k).to_pylist() for k in [*keys, "url"])):
                seen.update((*own, s) for s in of(url or ""))
            found = list(zip(*seen)) or [()] * (len(keys) + 1)
            arrays = [pa.array(c, batch.schema.field(k).type) for k, c in zip(keys, found)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(found[-1], pa.string()), pa.array(list(seen.values()), pa.int64())], [*keys, "s", "n"])

    return urls.select(*keys, "url").mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", s string, n long")


def _counts(urls: DataFrame) -> DataFrame:
    """kind, s and n: all strings of both kinds."""
    found = _exploded(urls, ["by_rule"], strings_of).groupBy(F.col("by_rule").alias("kind"), "s").agg(F.sum("n").alias("n"))
    return stash(found, "url-counts")


def windows_of(url: str, order: int = ORDER):
    """Every character with its longest context: what its probability depends on."""
    s = START + url + END
    for end in range(2, len(s) + 1):
        yield s[max(0, end - order - 1) : end]


def _scored_by_joins(urls: DataFrame, counts: DataFrame, order: int = ORDER) -> DataFrame:
    """urls with their difference, as of Markov models of any size: nothing but bounded parts of them is broadcast.

    A character's probability depends on its longest string only, so each distinct one is worked out once,
    from the shorter ones up; a string meets at most an alphabet of others under a key. Strings that are in
    many urls are joined to them by broadcast; there are at most as many as HOT_STRINGS.
    """
    kinds = ("allow", "block")
    of = lambda kind, what: F.coalesce(F.sum(F.when(F.col("kind") == kind, what)), F.lit(0))
    own = counts.groupBy("s").agg(*[of(k, F.col("n")).alias(f"n_{k}") for k in kinds])
    context = F.expr("substring(s, 1, char_length(s) - 1)").alias("context")
    contexts = counts.groupBy(context).agg(*[x for k in kinds for x in (of(k, F.col("n")).alias(f"total_{k}"), of(k, F.lit(1)).alias(f"kinds_{k}"))])
    contexts = stash(contexts, "url-contexts")
    empty = contexts.where("context = ''").first()
    rows = stash(urls.withColumn("_row", F.monotonically_increasing_id()), "url-rows")
    parts = stash(_exploded(rows, ["_row"], windows_of), "url-windows")
    windows = stash(parts.groupBy("s").agg(F.count("*").alias("uses")), "url-distinct")
    ends = windows.select(F.explode(F.expr(f"transform(sequence(1, least({order + 1}, char_length(s))), i -> right(s, i))")).alias("s")).distinct()
    wanted = ends.join(own, "s", "left").na.fill(0, [f"n_{k}" for k in kinds])
    wanted = stash(wanted.select("*", context, F.expr("substring(s, 2)").alias("shorter"), F.char_length("s").alias("size")), "url-wanted")
    found, levels = None, []
    for size in range(1, order + 2):
        level = wanted.where(F.col("size") == size)
        if size == 1:
            level = level.withColumns({f"{c}_{k}": F.lit(empty[f"{c}_{k}"]) for k in kinds for c in ("total", "kinds")} | {f"q_{k}": F.lit(1 / 256) for k in kinds})
        else:
            level = level.join(contexts.where(F.char_length("context") == size - 1), "context", "left")
            level = level.join(found.select(F.col("s").alias("shorter"), *[F.col(f"p_{k}").alias(f"q_{k}") for k in kinds]), "shorter")
        p = lambda k: (F.col(f"n_{k}") + F.col(f"kinds_{k}") * F.col(f"q_{k}")) / (F.col(f"total_{k}") + F.col(f"kinds_{k}"))
        found = stash(level.select("s", *[F.when(F.col(f"total_{k}") > 0, p(k)).otherwise(F.col(f"q_{k}")).alias(f"p_{k}") for k in kinds]), "url-level")
        levels.append(found)
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    log = windows.join(every, "s").select("s", "uses", (F.log("p_block") - F.log("p_allow")).alias("d"))
    log = stash(log, "url-logs")
    many = max(1, math.ceil((windows.agg(F.sum("uses")).first()[0] or 0) / HOT_STRINGS))  # no more than HOT_STRINGS have this many
    hot, rest = log.where(F.col("uses") >= many).select("s", "d"), log.where(F.col("uses") < many).select("s", "d")
    common = F.broadcast(hot.withColumn("hot", F.lit(True)))
    tagged = parts.join(common, "s", "left")
    sums = tagged.where("hot").select("_row", "n", "d").unionByName(tagged.where("hot IS NULL").drop("d", "hot").join(rest, "s").select("_row", "n", "d"))
    sums = sums.groupBy("_row").agg(F.sum(F.col("n") * F.col("d")).alias("d"))
    length = F.coalesce(F.char_length("url"), F.lit(0)) + 1
    return rows.join(sums, "_row").withColumn("difference", F.col("d") / length).select(*urls.columns, "difference")


def _scored(urls: DataFrame, counts) -> DataFrame:
    """urls with their difference, from a broadcast pair of plain dicts (accepted, rejected): what is broadcast is unpickled without this package."""

    def run(batches):
        pair = tuple(Markov(c) for c in counts.value)
        for batch in batches:
            d = [difference(u, *pair) for u in batch.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d, pa.float64())], [*batch.schema.names, "difference"])

    return urls.mapInArrow(run, T.StructType([*urls.schema.fields, T.StructField("difference", T.DoubleType())]))


def _threshold(scored: DataFrame) -> float:
    """The cut that leaves most of either kind on its own side, from a histogram."""
    bin_of = F.round(F.greatest(F.lit(-5.0), F.least(F.lit(5.0), F.col("difference"))) * BINS).cast("int")
    rows = scored.groupBy(bin_of.alias("bin")).pivot("by_rule", ["allow", "block"]).count().na.fill(0).orderBy("bin").collect()
    allow, block = sum(r.allow for r in rows), sum(r.block for r in rows)
    if not allow or not block:
        return 0.0
    best, at, below_a, below_b = -1.0, 0, 0, 0
    for i, r in enumerate(rows):
        below_a, below_b = below_a + r.allow, below_b + r.block
        gain = below_a / allow - below_b / block
        if gain > best:
            best, at = gain, i
    # Between the best bin and the next one that holds anything.
    after = rows[at + 1].bin if at + 1 < len(rows) else rows[at].bin + 1
    return (rows[at].bin + after) / 2 / BINS


def judge(pages: DataFrame, rules=RULES, max_strings: int = MAX_STRINGS) -> DataFrame:
    """page_id, host, path, rule, verdict and difference (null where a rule decides) of every row."""
    own = decided(pages, rules)
    ruled = own.where("rule IS NOT NULL")
    calibrates = F.crc32(F.col("url").cast("binary")) % 5 == 0
    counts = _counts(ruled.where(~calibrates))
    sizes = {r.kind: r["count"] for r in counts.groupBy("kind").count().collect()}
    open_ones = own.where("rule IS NULL")
    if len(sizes) == 2:
        if max(sizes.values()) <= max_strings:
            of = lambda kind: {r.s: r.n for r in counts.where(F.col("kind") == kind).select("s", "n").collect()}
            pair = pages.sparkSession.sparkContext.broadcast((of("allow"), of("block")))
            score = lambda urls: _scored(urls, pair)
        else:
            score = lambda urls: _scored_by_joins(urls, counts)
        cut = _threshold(score(ruled.where(calibrates).select("url", "by_rule")))
        scored = score(open_ones)
        verdict = F.when(F.col("difference") > cut, "block").otherwise("allow")
    else:
        scored, verdict = open_ones.withColumn("difference", F.lit(None).cast("double")), F.lit("allow")
    columns = ["page_id", "host", "path", "rule"]
    return ruled.select(*columns, F.col("by_rule").alias("verdict"), F.lit(None).cast("double").alias("difference")).unionByName(
        scored.select(*columns, verdict.alias("verdict"), "difference")
    )
