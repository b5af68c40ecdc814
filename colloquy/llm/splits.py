"""Train, validation and test splits that keep related records together (problem 3).

Items that share a feed or a recording, directly or through others, form a component; it goes into one split as a whole.

*Components.* Feeds are the nodes (an item without one is a feed of its own recording, or of itself), numbered by their
smallest item id. Only recordings in two feeds or more make edges. Rounds of large star and small star turn each
component into a star around its smallest node; each round's edges are cut off from their lineage.

*Allocation.* Components of the same size and label profile (the parts of its labels, in eighths) are one bundle, which is
all the driver sees. Sizes are settled from the largest to the smallest. Those of one size are a min-cost flow in units of
that size, from bundles over (label, split) to splits, whose costs are the squares of the deviations from the quotas of
all items settled so far, per split and per split and label. It starts from the proportional flow rounded down; the units
that are left go along shortest paths of the residual network, and cycles of negative cost are cancelled until there is
none, so it is optimal and integral. Bundles of several labels flow first, each by itself. As quotas hold at each size, the
splits also resemble each other in sizes, and what a size leaves over is settled by the smaller ones; where
these don't suffice, exchange() goes over all sizes at the end.

*Members.* The components of a bundle are ordered by a seeded hash and dealt out in that order.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.keys import URL_IDENTITY_SQL, url_identity
from colloquy.operators.prefix import hot_from, join_hot, running_before
from colloquy.session import cut, read_table

SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}


def star_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``edges``: u, v (BIGINT, u != v). Result: node, root, where root is the smallest node of the component; the roots
    themselves are left out. Empty in, empty out."""

    def least(pairs: DataFrame) -> DataFrame:
        """Adds the smallest neighbour of u, or u itself."""
        nearest = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c")).withColumn("m", F.least("m", "u"))
        return join_hot(pairs, nearest, "u", "c", hot)

    # the nodes' number bounds that of any star's rays, and each edge has two ends
    now = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(most_rounds):
        seen = now.agg(F.count("*"), F.sum(F.col("u").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == state or not seen[0]:
            break
        state, hot = seen, hot_from(2 * seen[0])
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = least(cut(large))
        now = cut(near.select(F.inline(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m")))).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    else:
        raise RuntimeError(f"components not found in {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def linked_groups(items: DataFrame, item_id: str, links: tuple[Column, Column], label: Column) -> tuple[DataFrame, DataFrame]:
    """Items (``item_id``, ``feed``) and their feeds (``feed``, ``group_id``, ``label``, ``n``, one row per feed and label).

    ``links``: two expressions; items with an equal, non-null value in either belong together, directly or through
    others, and ``group_id`` is the smallest id of all. Rows without an id are left out. Rows with the same id are taken
    for repeats; if they differ in a link, each is linked. A null label is 'unknown'.
    """
    a, b = links
    alone = F.concat(F.lit("\x01i"), F.col("item_id").cast("string"))
    rows = items.select(F.col(item_id).cast("bigint").alias("item_id"), a.alias("a"), b.alias("b"), F.coalesce(label, F.lit("unknown")).alias("label")).where("item_id is not null")
    rows = rows.select("item_id", F.coalesce(F.concat(F.lit("\x01f"), "a"), F.concat(F.lit("\x01r"), "b"), alone).alias("feed"), "b", "label").distinct()
    rows = cut(rows)
    feeds = rows.groupBy("feed", "label").agg(F.countDistinct("item_id").alias("n"), F.min("item_id").alias("first"))
    nodes = feeds.groupBy("feed").agg(F.min("first").alias("node"))
    pairs = rows.where("b is not null").select("feed", "b").distinct()
    shared = pairs.groupBy("b").agg(F.min("feed").alias("u"), F.max("feed").alias("z"), F.count("*").alias("c")).where("u <> z").drop("z")
    edges = join_hot(pairs, shared, "b", "c", hot_from(rows.count())).where("feed <> u").select("u", F.col("feed").alias("v")).distinct()
    edges = edges.join(nodes.select(F.col("feed").alias("u"), F.col("node").alias("from")), "u").join(nodes.select(F.col("feed").alias("v"), F.col("node").alias("to")), "v")
    roots = star_components(edges.select(F.col("from").alias("u"), F.col("to").alias("v")))
    nodes = nodes.join(roots, "node", "left").select("feed", F.coalesce("root", "node").alias("group_id"))
    return rows.select("item_id", "feed").distinct(), feeds.join(nodes, "feed").select("feed", "group_id", "label", "n")


#: Parts of a profile; the part of a cost below which a difference is taken for rounding.
EIGHTHS, NOISE = 8, 1e-11


class Flow:
    """Components of one size on their way from labels to splits. ``by_label`` (label, split) and ``by_split``: items above
    the quota, before them and but for what is placed here."""

    def __init__(self, counts: np.ndarray, size: int, by_label: np.ndarray, by_split: np.ndarray):
        self.counts, self.size = counts, size
        self.by_label, self.by_split = by_label.astype(float), by_split.astype(float)
        self.placed = np.zeros(by_label.shape, dtype=np.int64)

    def place(self, label: int, split: int, n: int = 1) -> None:
        self.placed[label, split] += n
        self.by_label[label, split] += n * self.size
        self.by_split[split] += n * self.size

    def network(self) -> tuple[np.ndarray, np.ndarray]:
        """Residual costs [from, to] of one unit, infinite where there is no arc. Nodes: 0 the sink, then the splits, then
        (label, split) for each label. A unit runs from (label, split) over the split to the sink, and back if there is
        one; from (label, i) to (label, j) where a component of the label is in i and so can be moved to j."""
        labels, splits = self.placed.shape
        n = 1 + splits + labels * splits
        cost = np.full((n, n), np.inf)
        more = lambda over: 2 * self.size * over + self.size**2
        less = lambda over: -2 * self.size * over + self.size**2
        total = self.placed.sum(axis=0)
        for k in range(splits):
            cost[1 + k, 0] = more(self.by_split[k])
            if total[k]:
                cost[0, 1 + k] = less(self.by_split[k])
            for x in range(labels):
                node = 1 + splits + x * splits + k
                cost[node, 1 + k] = more(self.by_label[x, k])
                if self.placed[x, k]:
                    cost[1 + k, node] = less(self.by_label[x, k])
                    # taking a unit of the label out of k and putting it elsewhere: into k's node it comes from k
                    for j in range(splits):
                        if j != k:
                            cost[node, 1 + splits + x * splits + j] = 0.0
        return cost, np.arange(n)

    def shortest(self, start: int | None) -> list[int] | None:
        """Bellman-Ford: the nodes of the shortest path from ``start`` to the sink, or, without a start, those of a cycle
        of negative cost (None: there is none)."""
        cost, nodes = self.network()
        least = NOISE * (1 + np.abs(cost[np.isfinite(cost)]).max())  # what is less is rounding
        far = np.zeros(len(nodes)) if start is None else np.where(nodes == start, 0.0, np.inf)
        back = np.full(len(nodes), -1)
        for _ in range(len(nodes)):
            through = far[:, None] + cost
            best = through.argmin(axis=0)
            better = through[best, nodes] < far - least
            if not better.any():
                break
            far, back = np.where(better, through[best, nodes], far), np.where(better, best, back)
        else:
            at = int(np.flatnonzero(better)[0])
            for _ in nodes:
                at = int(back[at])
            cycle = [at]
            while (prev := int(back[cycle[-1]])) != at:
                cycle.append(prev)
            return [at, *cycle[::-1]] if start is None else None
        if start is None:
            return None
        path = [0]
        while path[-1] != start:
            path.append(int(back[path[-1]]))
        return path[::-1]

    def push(self, path: list[int]) -> None:
        """Sends a unit along arcs of the residual network."""
        labels, splits = self.placed.shape
        for a, b in zip(path, path[1:], strict=False):
            low, high = min(a, b), max(a, b)
            if high > splits and low > splits:
                continue  # a move between two nodes of a label: what it changes is at their arcs to the splits
            if low == 0:
                self.by_split[high - 1] += self.size if a > b else -self.size
            else:
                x, k = divmod(high - 1 - splits, splits)
                sign = 1 if a > b else -1
                self.placed[x, k] += sign
                self.by_label[x, k] += sign * self.size

    def solve(self, shares: np.ndarray) -> np.ndarray:
        floors = np.floor(self.counts[:, None] * shares[None, :] + 1e-9).astype(np.int64)
        for x, k in zip(*np.nonzero(floors), strict=True):
            self.place(int(x), int(k), int(floors[x, k]))
        self.cancel()
        for x in np.flatnonzero(self.counts > floors.sum(axis=1)).tolist():
            for _ in range(int(self.counts[x] - floors[x].sum())):
                # a unit of the label may enter at any split's node
                self.push(self.cheapest(x))
        self.cancel()
        return self.placed

    def cheapest(self, label: int) -> list[int]:
        splits = self.placed.shape[1]
        paths = [self.shortest(1 + splits + label * splits + k) for k in range(splits)]
        cost, _ = self.network()
        return min(filter(None, paths), key=lambda p: sum(cost[a, b] for a, b in zip(p, p[1:], strict=False)))

    def total(self) -> float:
        return float((self.by_label**2).sum() + (self.by_split**2).sum())

    def cancel(self) -> None:
        while cycle := self.shortest(None):
            before = self.total()
            self.push(cycle)
            if self.total() >= before:  # rounding: none is left
                self.push(cycle[::-1])
                return


def allocate(sizes: np.ndarray, profiles: np.ndarray, counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """How many components of each bundle go into each split: integers, with the bundles' counts as row sums.

    ``sizes``: items of one component; ``profiles`` (bundle, label): the parts of the labels in them, whose sum is 1;
    bundles of the same size have different profiles. Costs are the squared deviations of the items from the quotas, per
    split and per split and label.
    """
    out = np.zeros((len(sizes), len(shares)), dtype=np.int64)
    by_label, by_split = np.zeros((profiles.shape[1], len(shares))), np.zeros(len(shares))
    for size in np.unique(sizes)[::-1]:
        own = np.flatnonzero(sizes == size)
        several = own[profiles[own].max(axis=1) < 1]
        for b in several:
            # one bundle: each unit goes where it costs least, which is the shortest path as long as units are alike
            parts, n = profiles[b], int(counts[b])
            by_label -= np.outer(parts * size * n, shares)
            by_split -= shares * size * n
            out[b] = np.floor(n * shares + 1e-9).astype(np.int64)
            by_label += np.outer(parts * size, out[b])
            by_split += out[b] * size
            step = lambda sign: 2 * sign * (parts @ by_label + by_split) + size * (parts @ parts + 1)  # noqa: B023, E731
            while out[b].sum() < n:
                k = int(np.argmin(step(1)))
                out[b, k] += 1
                by_label[:, k] += parts * size
                by_split[k] += size
            while True:  # moves between splits
                gain = step(1)[None, :] + np.where(out[b] > 0, step(-1), np.inf)[:, None]
                np.fill_diagonal(gain, np.inf)
                i, j = np.unravel_index(int(np.argmin(gain)), gain.shape)
                if gain[i, j] > -NOISE * (1 + size * size + size * np.abs(by_split).max()):
                    break
                out[b, [i, j]] += (-1, 1)
                by_label[:, [i, j]] += np.outer(parts * size, (-1, 1))
                by_split[[i, j]] += np.array((-1, 1)) * size
        one = np.setdiff1d(own, several)
        if len(one):
            label = profiles[one].argmax(axis=1)
            by_label[label] -= np.outer(size * counts[one], shares)
            by_split -= shares * size * counts[one].sum()
            flow = Flow(counts[one], int(size), by_label[label], by_split)
            out[one] = flow.solve(shares)
            by_label[label], by_split = flow.by_label, flow.by_split
    exchange(out, sizes, profiles, by_label, by_split)
    return out


def exchange(out: np.ndarray, sizes: np.ndarray, profiles: np.ndarray, by_label: np.ndarray, by_split: np.ndarray, block: int = 512) -> None:
    """While a split is off its quota by more than the smallest component, as can be where large ones had to be placed first
    and few small ones followed: the move of one component or exchange of two, of any sizes, that lowers the costs most."""
    while len(sizes) and np.abs(by_split).max() > sizes.min():
        best, change = -NOISE * (1 + float(sizes.max()) ** 2 + float(sizes.max()) * float(np.abs(by_split).max())), []
        for i, j in ((i, j) for i in range(out.shape[1]) for j in range(out.shape[1]) if i != j):
            here, there = np.flatnonzero(out[:, i]), np.flatnonzero(out[:, j])
            gain = lambda b, i, j: 2 * sizes[b] * (profiles[b] @ (by_label[:, j] - by_label[:, i]) + by_split[j] - by_split[i] + sizes[b] * ((profiles[b] ** 2).sum(axis=1) + 1))
            go = gain(here, i, j)
            if len(go) and go.min() < best:
                best, change = float(go.min()), [(int(here[go.argmin()]), i, j)]
            if i > j or not len(there):
                continue
            come = gain(there, j, i)
            for at in range(0, len(here), block):
                own = here[at : at + block]
                both = go[at : at + block, None] + come[None, :] - 4 * np.outer(sizes[own], sizes[there]) * (profiles[own] @ profiles[there].T + 1)
                a, b = np.unravel_index(int(both.argmin()), both.shape)
                if both[a, b] < best:
                    best, change = float(both[a, b]), [(int(own[a]), i, j), (int(there[b]), j, i)]
        if not change:
            return
        for b, i, j in change:
            out[b, [i, j]] += (-1, 1)
            by_label[:, [i, j]] += np.outer(profiles[b] * sizes[b], (-1, 1))
            by_split[[i, j]] += np.array((-1, 1)) * sizes[b]


def in_eighths(parts: Column) -> Column:
    """Parts of labels, (label, n) by label, as (label, eighths), those of 0 left out: rounded to the nearest, and the one
    with most, the first of them, takes what is left."""
    whole = F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    rounded = F.transform(parts, lambda x: F.struct(x["label"].alias("label"), F.round(x["n"] * EIGHTHS / whole).cast("int").alias("n")))
    most = F.array_max(F.transform(parts, lambda x: x["n"]))
    first = F.array_position(F.transform(parts, lambda x: x["n"]), most)
    rest = EIGHTHS - F.aggregate(rounded, F.lit(0), lambda a, x: a + x["n"])
    full = F.transform(rounded, lambda x, i: F.struct(x["label"].alias("label"), (x["n"] + F.when(i + 1 == first, rest).otherwise(0)).alias("n")))
    return F.filter(full, lambda x: x["n"] > 0)


def split_groups(feeds: DataFrame, shares: dict[str, float] | None = None, seed: int = 7) -> DataFrame:
    """``group_id``, ``split``, ``n`` for the groups of linked_groups()."""
    shares = shares or SHARES
    spark = feeds.sparkSession
    by_label = feeds.groupBy("group_id", "label").agg(F.sum("n").alias("n"))
    # a group has one row for each label, and labels are few
    groups = by_label.groupBy("group_id").agg(F.sum("n").alias("size"), F.array_sort(F.collect_list(F.struct("label", "n"))).alias("parts"))
    profile = F.array_join(F.transform(in_eighths(F.col("parts")), lambda x: F.concat(x["n"].cast("string"), F.lit("\x02"), x["label"])), "\x01")
    groups = cut(groups.select("group_id", "size", profile.alias("profile")))
    bundles = groups.groupBy("size", "profile").agg(F.count("*").alias("groups")).orderBy("size", "profile").collect()
    if not bundles:
        return groups.select("group_id", F.lit("train").alias("split"), F.col("size").alias("n"))
    parts = [[(label, int(n)) for n, label in (p.split("\x02", 1) for p in r["profile"].split("\x01"))] for r in bundles]
    names = sorted({label for p in parts for label, _ in p})
    profiles = np.zeros((len(bundles), len(names)))
    for row, own in zip(profiles, parts, strict=True):
        for label, n in own:
            row[names.index(label)] = n / EIGHTHS
    dealt = allocate(np.array([r["size"] for r in bundles]), profiles, np.array([r["groups"] for r in bundles]), np.array(list(shares.values())) / sum(shares.values()))
    ends = dealt.cumsum(axis=1)
    table = spark.createDataFrame([(r["size"], r["profile"], [int(x) for x in e]) for r, e in zip(bundles, ends, strict=True)], "size bigint, profile string, ends array<bigint>")
    hashed = groups.withColumn("__h", F.xxhash64("group_id", F.lit(seed))).withColumn("__cell", F.shiftrightunsigned("__h", 54))
    ranked = running_before(hashed, ["size", "profile"], "__cell", [F.col("__h"), F.col("group_id")], F.lit(1), "rank")
    # as many rows as bundles, which the driver has just seen
    ranked = ranked.join(F.broadcast(table), ["size", "profile"])
    split = F.element_at(F.array(*map(F.lit, shares)), (F.size(F.filter("ends", lambda e: e <= F.col("rank"))) + 1).cast("int"))
    return ranked.select("group_id", split.alias("split"), F.col("size").alias("n"))


def split_items(items: DataFrame, item_id: str, links: tuple[Column, Column], label: Column, shares: dict[str, float] | None = None) -> DataFrame:
    """``item_id``, ``group_id``, ``split``: every item once, with its group, by linked_groups(), and its split, by
    split_groups(). What holds for those of nulls, repeats and empty tables holds here."""
    rows, feeds = linked_groups(items, item_id, links, label)
    feeds = cut(feeds)
    per_feed = feeds.groupBy("feed").agg(F.min("group_id").alias("group_id"), F.sum("n").alias("n"))
    per_feed = per_feed.join(split_groups(feeds, shares).select("group_id", "split"), "group_id")
    joined = join_hot(rows, per_feed, "feed", "n", hot_from(rows.count()))
    return joined.select("item_id", "group_id", "split").distinct()


def p3_splits(spark: SparkSession, d: str) -> DataFrame:
    """Every item with its group and split."""
    language = F.substring(F.lower(F.trim("lang")), 1, 2)
    return split_items(read_table(spark, d, "audio_items"), "item_id", (url_identity(F.col("rss_url")), url_identity(F.col("audio_url"))), F.nullif(language, F.lit("")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The sets that the splits keep together."""
    return p3_splits(spark, d).where("item_id <> group_id").select("group_id", "item_id")


def p3_quotas(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the splits: items, items more than once, groups in two splits, and whether each split's items are
    within one of its quota, or within 1 % of all items."""
    items = cut(p3_splits(spark, d))
    by = items.groupBy("split").agg(F.count("*").alias("n"))
    total = items.agg(F.count("*").alias("items"), (F.count("*") - F.count_distinct("item_id")).alias("repeats"))
    torn = items.groupBy("group_id").agg((F.count_distinct("split") > 1).alias("torn")).agg(F.count_if("torn").alias("torn_groups"))
    quota = F.element_at(F.create_map(*[F.lit(x) for kv in SHARES.items() for x in kv]), F.col("split")) * F.col("items")
    off = by.crossJoin(F.broadcast(total.select("items"))).agg(F.max(F.abs(F.col("n") - quota)).alias("off"))  # one row each
    return total.crossJoin(F.broadcast(torn)).crossJoin(F.broadcast(off)).select("items", "repeats", "torn_groups", (F.col("off") <= F.greatest(F.lit(1.0), F.col("items") / 100)).alias("near_quota"))


_LINK = f"""
WITH RECURSIVE k AS MATERIALIZED (SELECT DISTINCT item_id, {URL_IDENTITY_SQL.format(c="rss_url")} AS r, {URL_IDENTITY_SQL.format(c="audio_url")} AS a FROM audio_items),
f AS (SELECT DISTINCT coalesce('f' || r, 'a' || a, 'i' || item_id) AS feed, a FROM k),
e AS MATERIALIZED (SELECT DISTINCT x.feed AS u, y.feed AS v FROM f x JOIN f y ON x.a = y.a AND x.feed <> y.feed),
reach AS (SELECT feed AS u, feed AS v FROM f UNION SELECT reach.u, e.v FROM reach JOIN e ON reach.v = e.u),
n AS (SELECT coalesce('f' || r, 'a' || a, 'i' || item_id) AS feed, min(item_id) AS first FROM k GROUP BY 1),
g AS (SELECT u, min(first) AS group_id FROM reach JOIN n ON n.feed = reach.v GROUP BY u)
"""
SQL = {"p3_found": _LINK + "SELECT DISTINCT group_id, item_id FROM k JOIN g ON g.u = coalesce('f' || r, 'a' || a, 'i' || item_id) WHERE item_id <> group_id"}
SQL["p3_quotas"] = "SELECT count(DISTINCT item_id) AS items, CAST(0 AS BIGINT) AS repeats, CAST(0 AS BIGINT) AS torn_groups, true AS near_quota FROM audio_items"
QUERIES = {"p3_found": p3_found, "p3_splits": p3_splits, "p3_quotas": p3_quotas}
