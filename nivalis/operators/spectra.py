"""Groups of close spectra: a net of representatives, further than a tolerance apart, each near enough to all of its members."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nivalis.sources.folders import dropped_shuffles, stash

#: Steps of the keys by which pairs are sought, in tolerances; an interval of two tolerances meets at most two of them.
WIDE = 4
#: Values that make up a key at most, the spectra by which they are chosen, and how many spectra of a key are wanted (fewer
#: in small tables, so all tasks have work); of a key with more than MOST_ROWS, each so many are a group of their own.
MOST_KEYS, CHOOSE_BY, WANTED, MOST_ROWS = 10, 20_000, 100_000, 400_000
#: Spectra that a task sorts, and pairs that are compared at once. These set the pace of the search, not its result.
ROWS_A_TASK, PAIRS = 500_000, 1 << 19


def _values(px: DataFrame, columns: list[str]) -> list[Column]:
    """The columns with null instead of what is no finite number, and one zero instead of two."""
    kinds = {f.name: f.dataType.simpleString() for f in px.schema.fields}
    whole = lambda c: kinds[c] not in ("float", "double")
    return [F.col(f"`{c}`") if whole(c) else F.when(F.abs(F.col(f"`{c}`")) < float("inf"), F.col(f"`{c}`") + F.lit(0).cast(kinds[c])) for c in columns]


def spectrum_id(px: DataFrame, columns: list[str]) -> Column:
    """128 bits that stand for the values of a spectrum (MD5 of their decimal text); null if one of them is null or not finite."""
    text = [F.lit(",") if i % 2 else _values(px, [columns[i // 2]])[0].cast("string") for i in range(2 * len(columns) - 1)]
    return F.unhex(F.md5(F.concat(*text)))


def _step(c: str, width: float) -> Column:
    return F.floor(F.col(c) / F.lit(float(width)))


def _keys(spectra: DataFrame, names: list[str], tolerance: float) -> list[str]:
    """Values for the keys, each the one that parts spectra best for what it adds to look up, until as few share a key as are wanted.

    The spectra of smallest id tell; values go along with each other, so how many share a key is counted for whole keys.
    """
    some = spectra.orderBy("spectrum_id").select(*[F.col(n).cast("double") for n in names]).limit(CHOOSE_BY).toPandas().to_numpy()
    total, (count, width) = spectra.count(), (len(some), WIDE * tolerance)
    wanted = min(WANTED, max(1000, total // (4 * int(spectra.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    steps = np.floor(some / width)
    looked = 1 + (np.floor((some + tolerance) / width) - np.floor((some - tolerance) / width)).mean(0) if count else []
    chosen, group, shared = [], np.zeros(count, int), float(total)
    while count > 1 and shared > wanted and len(chosen) < min(MOST_KEYS, len(names)):
        work = []
        for i in set(range(len(names))) - set(chosen):
            step = np.unique(steps[:, i], return_inverse=True)[1]
            finer = np.unique(group * (step.max() + 1) + step, return_inverse=True)[1]
            sizes = np.bincount(finer).astype(float)
            work.append((1 + total * (sizes * (sizes - 1)).sum() / count / (count - 1), i, finer))
        least, i, finer = min(work, key=lambda w: (looked[w[1]] ** 3 * w[0], w[1]))  # keys of equal worth part by the cube of what they add
        if least >= shared:
            break
        chosen, group, shared = [*chosen, i], finer, least
    return [names[i] for i in chosen] or names[:1]


def _key(keys: list[str], tolerance: float) -> Column:
    """A hash of the wide steps that the keys' values lie in; each holds whole steps of the tolerance. Keys that clash cost comparisons only."""
    return F.xxhash64(*[F.floor(_step(c, tolerance) / WIDE) for c in keys])


def _cell(names: list[str], tolerance: float) -> Column:
    """A hash of the cell of a grid with steps of the tolerance."""
    return F.xxhash64(*[_step(n, tolerance) for n in names])


def _look_up(df: DataFrame, keys: list[str], width: float, tolerance: float) -> DataFrame:
    """A row for each key that a spectrum within the tolerance may have."""
    reach, kept = tolerance * (1 + 1e-9) + 1e-9, df.columns
    for c in keys:
        df = df.withColumn(f"_k_{c}", F.explode(F.sequence(F.floor((F.col(c) - reach) / width), F.floor((F.col(c) + reach) / width))))
    return df.select(*kept, F.xxhash64(*[f"_k_{c}" for c in keys]).alias("_key"))


def _tasks(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_A_TASK))


def _schema(df: DataFrame, columns: list[str], more: str = "") -> str:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"{c} {kinds[c]}" for c in columns) + more


def _halves(ids: pa.ChunkedArray) -> np.ndarray:
    """Ids (16 bytes each) as two numbers."""
    return np.frombuffer(b"".join(ids.to_pylist()), ">u8").reshape(-1, 2).astype(np.uint64)


def _order(ids: pa.ChunkedArray) -> np.ndarray:
    """The places of ids in their order."""
    halves = _halves(ids)
    return np.lexsort((halves[:, 1], halves[:, 0]))


def _array(table: pa.Table, names: list[str]) -> np.ndarray:
    return np.column_stack([table.column(n).to_numpy().astype(float) for n in names])


def _stands(table: pa.Table) -> pa.Table:
    """The spectrum of smallest id of each cell, in order of ids."""
    cell, order = table.column("_cell").to_numpy(), _order(table.column("spectrum_id"))
    return table.take(order[np.sort(np.unique(cell[order], return_index=True)[1])])


def first_near(a: np.ndarray, b: np.ndarray, tolerance: float) -> np.ndarray:
    """Of each row of a the first row of b from which no value differs by more than the tolerance, len(b) if there is none.

    Rows of a are halved by the value in which they differ most, with the rows of b in reach of either half, until few
    enough pairs are left to compare them all.
    """
    first, slack = np.full(len(a), len(b)), 0.0
    if not len(a) or not len(b):
        return first
    most = max(np.abs(a).max(), np.abs(b).max())
    if most < 16_000 and tolerance < 16_000 and (a == np.floor(a)).all() and (b == np.floor(b)).all():
        a, b, tolerance = a.astype(np.int16), b.astype(np.int16), np.int16(np.floor(tolerance))
    else:
        slack = 1e-9 * tolerance + 4 * np.spacing(most)
    todo = [(np.arange(len(a)), np.arange(len(b)))]
    while todo:
        i, j = todo.pop()
        x, y = a[i], b[j]
        reached = ((y >= x.min(0) - tolerance - slack) & (y <= x.max(0) + tolerance + slack)).all(1)
        j, y = j[reached], y[reached]
        spread = x[:: 1 + len(x) // 512].std(0, dtype=float)
        d = int(spread.argmax())
        if len(i) * len(j) > PAIRS and x[:, d].max() - x[:, d].min() > tolerance:
            middle = np.median(x[:: 1 + len(x) // 512, d])
            half = x[:, d] <= middle if (x[:, d] > middle).any() else x[:, d] < middle
            todo += [(i[half], j), (i[~half], j)]
            continue
        p, q = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
        order = np.argsort(-spread, kind="stable")
        size = max(1, PAIRS // max(1, len(j)))
        for at in range(0, len(i) if len(j) else 0, size):
            near = np.ones((len(i[at : at + size]), len(j)), bool)
            for k in order[:3]:
                near &= np.abs(p[k, at : at + size, None] - q[k]) <= tolerance
            r, c = np.nonzero(near)
            for k in order[3:]:
                kept = np.abs(p[k, at + r] - q[k, c]) <= tolerance
                r, c = r[kept], c[kept]
            row, begin = np.unique(r, return_index=True)  # pairs are in order of both
            own = i[at + row]
            first[own] = np.minimum(first[own], j[c[begin]])
    return first


def _crowds(spectra: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """Keys of more than MOST_ROWS rows, and in how many parts they are taken."""
    found = spectra.groupBy(_key(keys, tolerance).alias("_key")).count().where(F.col("count") > MOST_ROWS)
    return found.select("_key", F.ceil(F.col("count") / MOST_ROWS).alias("_parts"))


def _own(df: DataFrame, by: Column, crowds: DataFrame, names: list[str], keys: list[str], tolerance: float, tasks: int):
    """Each row under its own key, parts of a crowded key by the hash `by`, with _cell. Ids are made again after the shuffle, so it is spared them."""
    parted = df.drop("spectrum_id").withColumn("_key", _key(keys, tolerance)).join(F.broadcast(crowds), "_key", "left")
    dealt = parted.withColumn("_part", F.pmod(by, F.coalesce("_parts", F.lit(1)))).drop("_parts").repartition(tasks, "_key", "_part")
    return dealt.withColumns({"spectrum_id": spectrum_id(df, names), "_cell": _cell(names, tolerance)}).groupBy("_key", "_part")


def _copies(df: DataFrame, crowds: DataFrame, names: list[str], keys: list[str], tolerance: float, tasks: int):
    """Each row under all keys in reach, in all of their parts. For few rows: with each key there come half as many more."""
    spread = _look_up(df.select(*names), keys, WIDE * tolerance, tolerance).join(F.broadcast(crowds), "_key", "left")
    spread = spread.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return spread.repartition(tasks, "_key", "_part").withColumn("spectrum_id", spectrum_id(df, names)).groupBy("_key", "_part")


def _unbeaten(still: DataFrame, crowds: DataFrame, names: list[str], keys: list[str], tolerance: float) -> DataFrame:
    """Who stands for a cell and has no smaller one near under its own key: a few more than will be elected."""

    def run(table: pa.Table) -> pa.Table:
        stands = _stands(table).select(["spectrum_id", *names])
        x = _array(stands, names)
        return stands.filter(pa.array(first_near(x, x, tolerance) == np.arange(len(x))))

    own = _own(still.select("spectrum_id", *names), _cell(names, tolerance), crowds, names, keys, tolerance, _tasks(still))
    return own.applyInArrow(run, _schema(still, ["spectrum_id", *names]))


def _beaten(some: DataFrame, still: DataFrame, crowds: DataFrame, names: list[str], keys: list[str], tolerance: float) -> DataFrame:
    """The ids of `some` that have a smaller one near, under any key, of those that stand for a cell."""
    tasks = _tasks(still)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return left.select(["spectrum_id"]).slice(0, 0)
        stands = _stands(right)
        found = first_near(_array(left, names), _array(stands, names), tolerance)
        own, other = _halves(left.column("spectrum_id")), _halves(stands.column("spectrum_id"))[np.minimum(found, len(stands) - 1)]
        smaller = (other[:, 0] < own[:, 0]) | (other[:, 0] == own[:, 0]) & (other[:, 1] < own[:, 1])
        return left.select(["spectrum_id"]).filter(pa.array(smaller & (found < len(stands))))

    own = _own(still.select("spectrum_id", *names), _cell(names, tolerance), crowds, names, keys, tolerance, tasks)
    return _copies(some, crowds, names, keys, tolerance, tasks).cogroup(own).applyInArrow(run, "spectrum_id binary")


def _joined(still: DataFrame, elected: DataFrame, crowds: DataFrame, names: list[str], keys: list[str], tolerance: float) -> DataFrame:
    """still with representative, the elected one of smallest id that is near, if any is."""
    kept, tasks = still.columns, _tasks(still)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.take(_order(right.column("spectrum_id")))
        found = first_near(_array(left, names), _array(right, names), tolerance)
        return left.select(kept).append_column("representative", right.column("spectrum_id").take(pa.array(found, mask=found == len(right))))

    own = _own(still, F.xxhash64(*names), crowds, names, keys, tolerance, tasks)
    return own.cogroup(_copies(elected, crowds, names, keys, tolerance, tasks)).applyInArrow(run, _schema(still, kept, ", representative binary"))


def distinct_spectra(px: DataFrame, columns: list[str], tolerance: float = 7) -> DataFrame:
    """One row per distinct spectrum: spectrum_id (see there), v0, v1, ... (its values), members (rows of px) and representative (a spectrum_id).

    Of a spectrum and its representative all values differ by the tolerance at most; of two representatives one value
    differs by more. Rows with a null or a value that is not finite belong to no group; a tolerance of 0 leaves all apart.
    The result does not depend on partitions or the order of rows.

    Rounds: of each cell of a grid with steps of the tolerance, in which all are near each other, the open spectrum of
    smallest id stands for election, so of the many alike one row per cell meets others. Elected is who has no smaller
    candidate near; open spectra near an elected one join the smallest, the others stay open. Ids are hashes, so the
    rounds are few; each ends with a stored table. Spectra meet in groups by keys of wide steps of few values, and near ones
    are told within. All open spectra are shuffled to their own key only: there most candidates are beaten already, and
    just the others, and those elected, go to all keys in reach.
    """
    names = [f"v{i}" for i in range(len(columns))]
    own = px.select(*[v.alias(n) for v, n in zip(_values(px, columns), names)]).dropna()
    spectra = own.groupBy(*names).agg(F.count("*").alias("members"))
    spectra = spectra.select(spectrum_id(own, names).alias("spectrum_id"), *names, "members")
    if tolerance <= 0:
        return spectra.withColumn("representative", F.col("spectrum_id"))
    with dropped_shuffles(px.sparkSession):
        spectra = stash(spectra, "spectra")
        done, still, turn = [], spectra, 0
        while not still.isEmpty():
            keys = _keys(still, names, tolerance)  # fewer and fewer are open, and groups cost time
            by = (stash(_crowds(still, keys, tolerance), f"spectra-{turn}-crowds"), names, keys, tolerance)
            some = stash(_unbeaten(still, *by), f"spectra-{turn}-unbeaten")
            elected = stash(some.join(_beaten(some, still, *by).hint("merge"), "spectrum_id", "left_anti"), f"spectra-{turn}-elected")
            told = stash(_joined(still, elected, *by), f"spectra-{turn}-told")
            done.append(told.where(F.col("representative").isNotNull()))
            still, turn = told.where(F.col("representative").isNull()).drop("representative"), turn + 1
    out = spectra.withColumn("representative", F.col("spectrum_id")).limit(0)
    for part in done:
        out = out.unionByName(part)
    return out
