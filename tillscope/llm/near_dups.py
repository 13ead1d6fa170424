"""Near-duplicates: a Jaccard join of word n-gram sets by chosen paths.

Sets are split recursively on sampled shared tokens. In run r at level l every set
follows its token of smallest hash under the pair's hash function, so two sets of
similarity J go the same way with probability J. Buckets of at most ``small`` sets are
compared by brute force; larger ones are split on the next token.

The first ``depth`` levels follow one token each. A bucket that is still large follows
``fan`` tokens, each into buckets of its own, and so on, so a pair lives on with a
probability that no number of further levels brings below ``survival``. Splitting ends
where it would not save comparisons, that is where the sets of a bucket are near each
other, or where no token is left. Runs are repeated until a pair at the threshold is met
with the target recall even if all its buckets go down without end:
1 - (1 - threshold ** depth * survival) ** runs.

Buckets that cannot be split with gain are compared whole, cut into blocks, one task
group per pair of blocks, so nothing is capped. A pair is looked at in the least path
alone in which it meets. The agreement of the sampled tokens screens pairs;
the sets of those left are fetched and compared exactly. What leaves a block is one row
per set, its number of links and the smallest set it is connected with, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import need, numbered, slices
from tillscope.sources.lake import stage

_STEP = np.uint64(0x9E3779B97F4A7C15)
_CHARS = 2_000_000
_BLOCK = 256
_GAIN = 0.9  # a bucket is split when its parts together need at most this share of its comparisons


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of the lower-cased words; a shorter text is one n-gram."""
    split = (text or "").lower().encode().split()
    if not split:
        return np.zeros(0, np.uint64)
    flat = np.empty(len(split), dtype=object)
    flat[:] = split
    h = pd.util.hash_array(flat, categorize=False)
    k = min(words, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        out = out * _STEP + h[j : j + len(out)]
    return np.unique(_mixed(out))


def fan_for(threshold: float) -> int:
    """Tokens followed per level beyond the first ones: enough that a pair at ``threshold`` does not die out."""
    return math.ceil(1.5 / threshold)


def survival(threshold: float) -> float:
    """Least probability that a pair lives on however many levels follow ``fan_for`` tokens."""
    alive, fan = 1.0, fan_for(threshold)
    for _ in range(1_000):
        alive = 1 - (1 - threshold * alive) ** fan
    return alive


def runs_for(threshold: float, depth: int, recall: float) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth * survival(threshold)))


def _sketcher(words: int, hashes: int):
    seeds = _mixed(np.arange(1, hashes + 1).astype(np.uint64) * _STEP)

    def run(batches):
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in slices((len(t or "") for t in texts), _CHARS):
                sets = [shingles(t, words) for t in texts[a:b]]
                full = [s for s in sets if len(s)]
                sizes = np.array([len(s) for s in sets], np.int32)
                mins = np.zeros((len(full), hashes), np.int32)
                if full:
                    flat = np.concatenate(full)
                    first = np.cumsum([0] + [len(s) for s in full[:-1]])
                    for k, seed in enumerate(seeds):
                        x = (flat ^ seed) * np.uint64(0xD6E8FEB86659FD93)
                        x ^= x >> np.uint64(32)
                        x *= _STEP
                        mins[:, k] = (np.minimum.reduceat(x, first) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    # Sums over the set tell sets apart, whatever the order.
                    one = np.add.reduceat(_mixed(flat + np.uint64(1)), first).view(np.int64)
                    two = np.add.reduceat(_mixed(flat ^ _STEP), first).view(np.int64)
                else:
                    one = two = np.zeros(0, np.int64)
                has = sizes > 0
                ends = np.append(0, np.cumsum(has * hashes)).astype(np.int32)
                both = np.zeros((2, len(sets)), np.int64)
                both[0, has], both[1, has] = one, two
                yield pa.RecordBatch.from_arrays(
                    [batch["rid"].slice(a, b - a), batch["id"].slice(a, b - a), batch["tkey"].slice(a, b - a),
                     pa.array(sizes), pa.array(both[0]), pa.array(both[1]),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(mins.ravel()))],
                    ["rid", "id", "tkey", "size", "one", "two", "mins"],
                )

    return run


def _cells(fn, hashes: int):
    """Apply ``fn`` to each run of rows of one cell (path, low, high); the rows come sorted by cell."""

    def emit(table: pa.Table, out: list):
        keys = [table.column(c).to_numpy() for c in ("path", "low", "high")]
        change = np.zeros(len(keys[0]), bool)
        change[0] = True
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        cuts = np.append(np.flatnonzero(change), len(change))
        flat = table.combine_chunks()
        cols = {"mins": pa.compute.list_flatten(flat["mins"]).to_numpy().reshape(-1, hashes)}
        leaf = pa.compute.list_flatten(flat["leaves"]).to_numpy()
        ends = np.append(0, np.cumsum(pa.compute.list_value_length(flat["leaves"]).to_numpy()))
        cols |= {c: flat[c].to_numpy() for c in flat.column_names if c not in ("mins", "leaves", "set")}
        sets = flat["set"].combine_chunks() if "set" in flat.column_names else None
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a > 1:
                cell = {k: c[a:b] for k, c in cols.items()}
                cell["leaf"] = leaf[ends[a] : ends[b]]
                cell["owner"] = np.repeat(np.arange(b - a), np.diff(ends[a : b + 1]))
                out.extend(fn(cell, None if sets is None else sets[a:b]))

    def run(batches):
        import pyarrow.compute  # noqa: F401

        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            keys = [table.column(c).to_numpy() for c in ("path", "low", "high")]
            last = np.ones(len(keys[0]), bool)
            for k in keys:
                last &= k == k[-1]
            others = np.flatnonzero(~last)
            cut = int(others[-1]) + 1 if len(others) else 0
            head = table.slice(0, cut)
            if cut:
                out: list = []
                emit(pa.concat_tables([*held, head]), out)
                held = [table.slice(cut)]
                yield from fn.rows(out)
            else:
                # The batch is one cell: either it goes on, or it ends what is held.
                if held and any(held[-1].column(c)[-1] != table.column(c)[0] for c in ("path", "low", "high")):
                    out = []
                    emit(pa.concat_tables(held), out)
                    held = []
                    yield from fn.rows(out)
                held.append(table)
        if held:
            out = []
            emit(pa.concat_tables(held), out)
            yield from fn.rows(out)

    return run


def _met_before(c: dict, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether a set of ``left`` and one of ``right`` share a bucket of lesser path than the cell's."""
    less = c["leaf"] < c["path"][0]
    _, column, times = np.unique(c["leaf"][less], return_inverse=True, return_counts=True)
    shared = times[column] > 1
    names, column = np.unique(column[shared], return_inverse=True)
    table = np.zeros((len(c["path"]), len(names)), np.float32)
    table[c["owner"][less][shared], column] = 1
    return table[left] @ table[right].T > 0


def _pairs(c: dict, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a cell that pass the screen and meet in no lesser path."""
    low, high = c["low"][0], c["high"][0]
    left = np.flatnonzero(c["block"] == low)
    right = left if low == high else np.flatnonzero(c["block"] == high)
    if not len(left) or not len(right):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = c["mins"].shape[1]
    agree = np.zeros((len(left), len(right)), np.int16)
    for k in range(n):
        agree += c["mins"][left, k][:, None] == c["mins"][right, k][None, :]
    # Far below the expected share, so that the screen loses no more than the paths do.
    ok = agree >= math.ceil(n * (threshold - 0.3))
    size = c["size"]
    small, large = np.minimum.outer(size[left], size[right]), np.maximum.outer(size[left], size[right])
    ok &= small >= threshold * large
    if low == high:
        ok &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
    ok &= c["rep"][left][:, None] != c["rep"][right][None, :]
    if ok.any():
        ok &= ~_met_before(c, left, right)
    x, y = np.nonzero(ok)
    return left[x], right[y]


class _Needed:
    """The sets of a cell that are in a pair to be compared."""

    schema = "path long, low int, high int, rep long"

    def __init__(self, threshold):
        self.threshold = threshold

    def __call__(self, c, _):
        x, y = _pairs(c, self.threshold)
        at = np.unique(np.concatenate([x, y]))
        return [(int(c["path"][0]), int(c["low"][0]), int(c["high"][0]), int(r)) for r in np.unique(c["rep"][at])]

    def rows(self, out):
        if out:
            a = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[0], pa.int64()), pa.array(a[1], pa.int32()), pa.array(a[2], pa.int32()), pa.array(a[3], pa.int64())],
                ["path", "low", "high", "rep"],
            )


class _Links:
    """By set of a cell: documents it is linked with, and the smallest set it is connected with."""

    schema = "rep long, links long, low long"

    def __init__(self, threshold):
        self.threshold = threshold

    def __call__(self, c, sets):
        x, y = _pairs(c, self.threshold)
        if not len(x):
            return []
        held = [np.frombuffer(s.as_buffer(), np.uint64) for s in sets]
        at = np.unique(np.concatenate([x, y]))
        flat = np.concatenate([held[k] for k in at])
        owner = np.repeat(np.arange(len(at)), [len(held[k]) for k in at])
        _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
        shared = times[column] > 1
        names, column = np.unique(column[shared], return_inverse=True)
        where = np.full(int(at.max()) + 1, -1)
        where[at] = np.arange(len(at))
        if len(names) * len(at) <= 20_000_000:
            table = np.zeros((len(at), len(names)), np.float32)
            table[owner[shared], column] = 1
            both = (table @ table.T)[where[x], where[y]].astype(np.int64)
        else:
            both = np.array([len(np.intersect1d(held[a], held[b], assume_unique=True)) for a, b in zip(x, y)])
        size = c["size"].astype(np.int64)
        ok = both >= self.threshold * (size[x] + size[y] - both) - 1e-9
        x, y = x[ok], y[ok]
        links, rep, members = np.zeros(len(size), np.int64), c["rep"], c["members"]
        np.add.at(links, x, members[y])
        np.add.at(links, y, members[x])
        low, before = rep.copy(), None
        while before is None or (low != before).any():
            before = low.copy()
            np.minimum.at(low, x, before[y])
            np.minimum.at(low, y, before[x])
        return [(int(rep[k]), int(links[k]), int(low[k])) for k in np.flatnonzero(links)]

    def rows(self, out):
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["rep", "links", "low"])


def _leaves(reps: DataFrame, runs: int, depth: int, small: int, fan: int) -> DataFrame:
    """(path, rep, n) of all buckets with more than one set, split as far as needed."""
    run = F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")
    rows = reps.select("rep", "mins", run)
    out = []
    for level in range(depth):
        token = F.element_at("mins", F.col("run") * depth + level + 1)
        path = F.xxhash64("path", token) if level else F.xxhash64("run", token)
        rows = rows.withColumn("path", path)
        sizes = rows.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")
        rows = stage(rows.drop("n").join(sizes, "path").select("rep", "mins", "run", "path", "n"), f"level-{level}")
        out.append(rows.filter(F.col("n") <= small).select("path", "rep", "n"))
        rows = rows.filter(F.col("n") > small)
    used = F.sequence(F.col("run") * depth + 1, (F.col("run") + 1) * depth)
    rows = rows.select("rep", "mins", "path", "n", used.alias("used"))
    every = F.array(*(F.lit(k + 1) for k in range(runs * depth)))
    while not rows.isEmpty():
        whole, parts = _split(rows, every, fan)
        out.append(whole)
        out.append(parts.filter(F.col("n").between(2, small)).select("path", "rep", "n"))
        rows = parts.filter(F.col("n") > small)
    leaves = out[0]
    for more in out[1:]:
        leaves = leaves.unionByName(more)
    return stage(leaves, "leaves")


def _split(rows: DataFrame, every: Column, fan: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the buckets that splitting would not lighten (path, rep, n), and the parts of the others.

    Which tokens a bucket follows depends on its path, so the buckets a pair shares live on
    independently of each other; none is followed twice on a path.
    """
    free, picks = F.array_except(every, "used"), []
    enough = F.size(free) >= fan
    for k in range(fan):
        at = F.pmod(F.xxhash64("path", F.lit(k)), F.greatest(F.size(free), F.lit(1))).cast("int") + 1
        picks.append(F.try_element_at(free, at))
        free = F.array_remove(free, picks[-1])
    parts = (
        rows.filter(enough)
        .select("rep", "mins", "used", F.col("path").alias("parent"), F.col("n").alias("of"), F.array(*picks).alias("picks"))
        .withColumn("pick", F.explode("picks"))
        .withColumn("path", F.xxhash64("parent", "pick", F.element_at("mins", F.col("pick"))))
        .select("rep", "mins", "parent", "of", "path", F.array_append("used", F.col("pick")).alias("used"))
    )
    parts = stage(parts, "parts")
    sizes = stage(
        parts.groupBy("path").agg(F.min("parent").alias("parent"), F.min("of").alias("of"), F.count("*").alias("n")), "sizes"
    )
    work, was = F.sum(F.col("n").cast("double") * F.col("n")), F.min("of").cast("double")
    lighter = stage(
        sizes.groupBy("parent").agg(work.alias("work"), (was * was).alias("was")).filter(F.col("work") <= _GAIN * F.col("was"))
        .select("parent"),
        "lighter",
    )
    whole = rows.join(lighter.withColumnRenamed("parent", "path"), "path", "left_anti").select("path", "rep", "n")
    went = sizes.filter("n > 1").join(lighter, "parent").select("path", "n")
    return whole, stage(parts.join(went, "path").select("rep", "mins", "path", "n", "used"), "deeper")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): the smallest node it is connected with.

    Large-star and small-star rounds until nothing changes; each is written, none is
    collected.
    """
    e = stage(
        edges.filter("u != v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct(), "edges"
    )
    before = None
    while True:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == before:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
                e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            )
        before = mark
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        lows = large.groupBy("hi").agg(F.min("lo").alias("m"))
        down = large.join(lows, "hi").filter("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = stage(down.unionByName(lows.withColumnRenamed("m", "lo")).distinct(), "edges")


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _classes(rows: DataFrame, words: int, threshold: float, depth: int, recall: float, small: int) -> DataFrame:
    """``rows`` (rid, id, text): rid, id, class (a struct with id and rid), class_size, n_links, n_shingles."""
    runs = runs_for(threshold, depth, recall)
    hashes = runs * depth
    kind = rows.schema["id"].dataType.simpleString()
    keyed = rows.withColumn("tkey", _text_key(F.col("text")))
    made = f"rid long, id {kind}, tkey long, size int, one long, two long, mins array<int>"
    docs = keyed.mapInArrow(_sketcher(words, hashes), made)
    if "rid" not in rows.columns:
        raise ValueError("rows need a number")
    docs = stage(docs.withColumn("rid", F.coalesce("rid", F.monotonically_increasing_id())), "sketches")
    # Equal sets are one representative with its number of members.
    best = F.min(F.struct("rid", "id", "tkey", "size", "mins")).alias("b")
    reps = stage(
        docs.filter("size > 0").groupBy("one", "two").agg(best, F.count("*").alias("members"))
        .select("one", "two", F.col("b.rid").alias("rep"), "b.id", "b.tkey", "b.size", "b.mins", "members"),
        "reps",
    )
    leaves = _leaves(reps, runs, depth, small, fan_for(threshold))
    known = leaves.groupBy("rep").agg(F.collect_list("path").alias("leaves"))
    facts = reps.select("rep", "size", "mins", "members").join(known, "rep")
    blocks = F.ceil(F.col("n") / _BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    cells = (
        leaves.select("path", "rep", own.alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
        .select("path", "rep", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
        .join(facts, "rep")
    )
    cell = ["path", "low", "high"]
    needed = stage(
        cells.repartition(*cell).sortWithinPartitions(*cell)
        .mapInArrow(_cells(_Needed(threshold), hashes), _Needed.schema),
        "needed",
    )
    texts = keyed.select(F.col("id"), F.col("tkey"), "text")
    wanted = reps.join(needed.select("rep").distinct(), "rep").select("rep", F.col("id").alias("rid_"), F.col("tkey").alias("key"))

    def to_sets(batches):
        for batch in batches:
            sets = [shingles(t.as_py(), words).tobytes() for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["rep"], pa.array(sets, pa.binary())], ["rep", "set"])

    found = texts.join(wanted, texts["tkey"].eqNullSafe(wanted["key"]) & texts["id"].eqNullSafe(wanted["rid_"]))
    # Rows repeated under one identifier bring the same set several times.
    sets = found.select("rep", "text").mapInArrow(to_sets, "rep long, set binary").dropDuplicates(["rep"])
    links = stage(
        needed.join(cells, ["rep", *cell]).join(sets, "rep")
        .select(*cell, "rep", "block", "size", "mins", "members", "leaves", "set")
        .repartition(*cell).sortWithinPartitions(*cell)
        .mapInArrow(_cells(_Links(threshold), hashes), _Links.schema),
        "links",
    )
    roots = components(links.select(F.col("rep").alias("u"), F.col("low").alias("v")))
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    info = (
        reps.select("one", "two", "rep", "members")
        .join(counts, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select("one", "two", F.coalesce("root", "rep").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"))
    )
    # Texts without words are alone.
    full = stage(
        docs.select("rid", "id", "one", "two", "size").join(info, ["one", "two"], "left")
        .select("rid", "id", "size", F.when(F.col("size") > 0, F.col("root")).otherwise(F.col("rid")).alias("root"),
                F.when(F.col("size") > 0, F.col("n_links")).otherwise(0).alias("n_links"),
                (F.col("size") > 0).alias("some")),
        "classed",
    )
    rank = F.min(F.struct(F.col("id").isNull().alias("empty"), "id", "rid")).alias("class")
    # Written, so that the join below can split the rows of a class that holds much of the table.
    heads = stage(full.groupBy("root", "some").agg(rank, F.count("*").alias("class_size")), "heads")
    return full.join(heads, ["root", "some"]).select("rid", "id", "class", "class_size", "n_links", F.col("size").alias("n_shingles"))


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    threshold: float = 0.8,
    depth: int = 3,
    recall: float = 0.999,
    small: int = 128,
) -> DataFrame:
    """Per row of ``docs``: identifier, class_id, class_size, n_links, n_shingles, kept.

    Texts are linked when the Jaccard similarity of their sets of ``words`` consecutive
    lower-cased words reaches ``threshold``; a shorter text is one n-gram. A class is
    what links connect; its id is its smallest identifier (NULL only if it has no
    other). ``n_links`` counts the rows a row is linked with, copies included. ``kept``
    marks one row per class. Texts without words, NULL included, are linked with
    nothing. An empty table gives an empty result; other columns are not read.
    """
    need(docs, id_col, text_col)
    rows = docs.select(
        F.lit(None).cast("long").alias("rid"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")
    )
    return _classes(rows, words, threshold, depth, recall, small).select(
        F.col("id").alias(id_col), F.col("class.id").alias("class_id"), "class_size", "n_links", "n_shingles",
        (F.col("class.rid") == F.col("rid")).alias("kept"),
    )


def drop_near(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    threshold: float = 0.8,
    depth: int = 3,
    recall: float = 0.999,
    small: int = 128,
) -> DataFrame:
    """One row of ``docs`` per class of ``near_classes``, with all its columns.

    NULLs, ties and repeated rows go as there: of a class the row with the smallest identifier stays
    (of equal ones any, NULL last); texts without words all stay. An empty table stays empty.
    """
    need(docs, id_col, text_col)
    whole = numbered(docs, "numbered", F.struct("*").alias("_row"))
    rows = whole.select(
        F.col("_rid").alias("rid"), F.col("_row")[id_col].alias("id"), F.col("_row")[text_col].cast("string").alias("text")
    )
    classes = _classes(rows, words, threshold, depth, recall, small)
    kept = classes.filter(F.col("class.rid") == F.col("rid")).select(F.col("rid").alias("_rid"))
    return whole.join(kept, "_rid", "left_semi").select("_row.*")
