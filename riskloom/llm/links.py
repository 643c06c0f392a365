"""From shared signatures to components, without ever listing all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import fits, small_side
from riskloom.sources.storage import materialize, scratch

ROUNDS = 50
SMALL_BUCKET = 16
FEW_TASKS, FEW_ROWS = 8, 400_000


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which comes from some ``rows`` rows, in a few tasks if these are few: starting a task costs more than they do."""
    return df.coalesce(FEW_TASKS) if rows <= FEW_ROWS else df


# ------------------------------------------------------------- connected components
def components(edges: DataFrame) -> DataFrame:
    """(id, component), stored, of every id in ``edges`` (a, b); the component is its least id.

    Alternates the large-star and the small-star step until only stars are left.
    Each round is written to shared storage.  Minima are taken with partial
    aggregation, and a node with very many neighbours only makes its join
    partition large, which adaptive execution splits.
    """
    spark = edges.sparkSession
    with scratch(spark) as keep:
        links = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                            .where("u <> v").distinct())
        rows = links.count()
        for _ in range(ROUNDS):
            if _are_stars(links, rows):
                return keep(links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                    few(links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct(), rows)))
            links = materialize(_small_star(_large_star(links, rows), rows))
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")


def extended(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` (id, component), stored, after further ``links`` (a, b); only classes are put together."""
    with scratch(classes.sparkSession) as keep:
        for end in ("a", "b"):
            named = classes.select(F.col("id").alias(end), "component")
            links = links.join(named, end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
        moved = components(links)
        least = moved.select(F.col("id").alias("component"), F.col("component").alias("least"))
        known = classes.join(least, "component", "left").select("id", F.coalesce("least", "component").alias("component"))
        return keep(known.unionByName(moved.join(classes, "id", "left_anti")))


def _are_stars(links: DataFrame, rows: int) -> bool:
    """Whether every upper end has one link only and is no lower end; a lower end is then the least of its component."""
    ends = links.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = few(ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")), rows)
    return ends.where("up > 0 and up + down > 1").agg(F.count(F.lit(1))).first()[0] == 0


def _large_star(links: DataFrame, rows: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = few(both.groupBy("u").agg(F.min("v").alias("m")), rows).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame, rows: int) -> DataFrame:
    least = few(links.groupBy("u").agg(F.min("v").alias("m")), rows)
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return few(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), rows)


# ------------------------------------------------------------- buckets of signatures
def shared_only(rows: DataFrame) -> DataFrame:
    """The distinct (sig, id, size) whose signature at least two ids have; ``size`` counts the rows with it."""
    bucket = Window.partitionBy("sig")
    return (rows.withColumns({"low": F.min("id").over(bucket), "high": F.max("id").over(bucket),
                              "size": F.count(F.lit(1)).over(bucket)})
            .where("low <> high").select("sig", "id", "size").distinct())


Items = Callable[[DataFrame], DataFrame]


def at_least(threshold: int, both: Column, a: Column, b: Column) -> Column:
    """Whether ``both`` items shared by sets of ``a`` and ``b`` reach the threshold in percent."""
    return 100 * both >= threshold * (a + b - both)


def compared(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with how many items both have, ``both``, and set sizes ``na``, ``nb``.

    What is shuffled is the items of ``a`` once per pair and those of each ``b`` once.
    """
    pairs = materialize(pairs)
    wanted = pairs.select(F.col("b").alias("id"))
    if fits(pairs):
        pairs, wanted = F.broadcast(pairs), F.broadcast(wanted)
    else:
        wanted = small_side(wanted.distinct())
    left = items.select(F.col("id").alias("a"), F.col("items").alias("x")).join(pairs, "a")
    right = items.join(wanted, "id", "left_semi").select(F.col("id").alias("b"), F.col("items").alias("y"))
    return left.join(right, "b").select(
        *pairs.columns, F.size(F.array_intersect("x", "y")).alias("both"),
        F.size("x").alias("na"), F.size("y").alias("nb"))


def similar(pairs: DataFrame, threshold: int) -> DataFrame:
    """The compared pairs whose Jaccard similarity reaches the threshold, exactly."""
    return pairs.where(at_least(threshold, F.col("both"), F.col("na"), F.col("nb"))).select("a", "b")


def linked_components(shared: DataFrame, items_of: Items, threshold: int, rounds: int = 1,
                      need: DataFrame | None = None) -> DataFrame:
    """(id, component), stored, of all ids that link with another one.

    ``shared`` (sig, id, size) is stored and holds every pair that can link in
    some bucket; ``items_of(ids)`` gives the item arrays of ids.  ``need`` (id,
    need) says how many signatures an id shares with any id it links with, one
    if not given; an id with fewer links with nothing.

    Pairs of small buckets are counted: what they share there, and what they may
    share in large ones, has to be enough.  Two ids that meet in no small bucket
    share all they need in large ones, so each can do without the largest of
    its buckets, one less than it needs (``_listed``): what the rarest shared
    signature is, is not among them.  So what very many ids have in common is
    not gone through.

    Each bucket left is compared with one leader only, the id whose signatures
    are in the largest buckets, which is linear in the rows and joins a group of
    near copies around its centre.  Then ``rounds`` times each group of several
    components is compared with one more of its members, the most central one
    and then others outside its largest component.  For what is left ``_between``
    lists the pairs that the counts known by then let link.  So no link is lost,
    and a group of copies does not cost its square.
    """
    with scratch(shared.sparkSession) as keep:
        return keep(_linked(shared, items_of, threshold, rounds, need))


def _linked(shared: DataFrame, items_of: Items, threshold: int, rounds: int, need: DataFrame | None) -> DataFrame:
    listed = materialize(_listed(shared, need))
    items = materialize(items_of(listed.select("id")).select("id", "items", F.size("items").alias("n")))
    rows = listed.withColumn("bucket", F.explode("buckets")).select(
        "bucket.sig", "bucket.size", "id", "weight", "large", "need")
    leader = F.max(F.struct("weight", "id", "need")).over(Window.partitionBy("sig"))
    met = (rows.withColumn("leader", leader).where("id <> leader.id")
           .groupBy(F.col("id").alias("a"), F.col("leader.id").alias("b"), "large", "need",
                    F.col("leader.need").alias("other"))
           .agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("met")))
    bounding = (F.col("size") > SMALL_BUCKET) & (F.col("large") >= F.col("need"))
    first = (met.withColumn("bounding", bounding).where("bounding or met >= greatest(need, other)")
             .select("a", "b", "bounding"))
    first = materialize(compared(first, items))
    classes = components(similar(first, threshold))
    group = Group(first.where("bounding"), classes, items, threshold)
    for number in range(rounds):
        more = similar(compared(group.next_leaders(classes, number), items), threshold)
        more = materialize(few(more, group.rows))
        if more.isEmpty():
            break
        classes = extended(classes, more)
    placed = items.select("id", "n").join(classes, "id", "left")
    rest = group.between(classes).unionByName(_in_small_buckets(listed, placed, threshold)).distinct()
    rest = rest.join(first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    more = materialize(similar(compared(rest, items), threshold))
    return classes if more.isEmpty() else extended(classes, more)


def _listed(shared: DataFrame, need: DataFrame | None) -> DataFrame:
    """(id, weight, large, need, buckets) of ids with enough signatures.

    ``large`` counts their large buckets; ``buckets`` leaves out the largest of these, one less than needed.
    """
    listed = shared.groupBy("id").agg(
        F.sum(F.floor(8 * F.log2("size"))).alias("weight"), F.sum((F.col("size") > SMALL_BUCKET).cast("int")).alias("large"),
        F.sort_array(F.collect_list(F.struct("size", "sig"))).alias("buckets"))
    listed = listed.withColumn("need", F.lit(1)) if need is None else listed.join(need, "id")
    left = F.size("buckets") - F.least(F.col("need") - 1, "large")
    return listed.where(F.size("buckets") >= F.col("need")).select(
        "id", "weight", "large", "need", F.slice("buckets", F.lit(1), left.cast("int")).alias("buckets"))


def _in_small_buckets(listed: DataFrame, placed: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of small buckets in different components that share enough signatures and are of like sizes.

    What the two may share in large buckets counts as shared.  ``placed`` (id,
    n, component) has the sizes of sets; the smaller one may lie in the other.
    """
    placed = listed.join(placed, "id").withColumn(
        "bucket", F.explode(F.filter("buckets", lambda x: x["size"] <= SMALL_BUCKET)))
    one = F.struct("id", F.coalesce("component", "id").alias("component"), "large", "need", "n")
    beside = F.filter("met", lambda x: (x["id"] > F.col("one.id")) & (x["component"] != F.col("one.component"))
                      & at_least(threshold, F.least(x["n"], F.col("one.n")), x["n"], F.col("one.n")))
    pairs = (placed.groupBy("bucket.sig").agg(F.collect_list(one).alias("met")).where(F.size("met") > 1)
             .select("met", F.explode("met").alias("one")).select("one", F.explode(beside).alias("two")))
    met = pairs.groupBy(F.col("one.id").alias("a"), F.col("two.id").alias("b")).agg(
        F.count(F.lit(1)).alias("met"), F.max(F.least("one.large", "two.large")).alias("large"),
        F.max(F.greatest("one.need", "two.need")).alias("need"))
    return met.where("met + large >= need").select("a", "b")


class Group:
    """Members of leaders under which several components meet, and what they hold outside the group's centre.

    Two sets of sizes n and m link only if they share t / (100 + t) * (n + m)
    items.  The centre is what the leader has and what more than half of the
    members have; of it two sets share at most the lesser of what each has.
    Where that is not enough, the two must share items outside the centre.
    They are few and rare in a group of near copies.
    """

    def __init__(self, bound: DataFrame, classes: DataFrame, items: DataFrame, threshold: int):
        self.threshold = threshold
        members = materialize(_mixed(bound.select(
            F.col("a").alias("id"), F.col("b").alias("leader"), "both", F.col("na").alias("n"),
            F.col("nb").alias("centre")), classes).drop("component"))
        leaders = small_side(members.select(F.col("leader").alias("id")).distinct())
        inside = items.join(leaders, "id", "left_semi").select(F.col("id").alias("leader"), F.col("items").alias("inside"))
        rows = items.select("id", "items").join(small_side(members), "id").join(inside, "leader").select(
            "leader", "id", "n", "both", F.explode(F.array_except("items", "inside")).alias("item"))
        # what a set shares with the leader or with anyone else under it has to reach the threshold
        able = 100 * (F.col("both") + F.col("extra")) >= threshold * F.col("n")
        rows = self._shared(rows).withColumn("extra", F.count(F.lit(1)).over(Window.partitionBy("leader", "id"))).where(able)
        held = self._shared(rows).groupBy("leader", "id").agg(
            F.sort_array(F.collect_list(F.struct("holders", "item"))).alias("held"))
        held = members.join(held, ["leader", "id"], "left").withColumn("extra", F.coalesce(F.size("held"), F.lit(0)))
        held = materialize(held.withColumn("extra", F.greatest("extra", F.lit(0))).where(able))
        size = held.groupBy("leader").agg(F.count(F.lit(1)).alias("members"), F.min("n").alias("low"))
        common = lambda x: (2 * x["holders"] > F.col("members")) & (x["holders"] > SMALL_BUCKET)
        none = F.array().cast("array<struct<holders:bigint,item:bigint>>")
        held = (held.join(size, "leader").withColumn("held", F.coalesce("held", none))
                .withColumn("more", F.size(F.filter("held", common)))
                .withColumn("held", F.filter("held", lambda x: ~common(x))))
        self.rows = members.count()
        self.members = materialize(held.select(
            "leader", "id", "n", (F.col("both") + F.col("more")).alias("both"), "held", F.size("held").alias("extra"),
            F.aggregate("held", F.lit(0).cast("bigint"), lambda total, x: total + x["holders"]).alias("popular"),
            (F.col("centre") + F.max("more").over(Window.partitionBy("leader"))).alias("centre"),
            F.greatest("low", F.ceil(threshold * F.col("n") / 100)).alias("low")))

    @staticmethod
    def _shared(rows: DataFrame) -> DataFrame:
        """``rows`` (leader, id, item, ...) whose item several members of the leader have."""
        return rows.withColumn("holders", F.count(F.lit(1)).over(Window.partitionBy("leader", "item"))).where("holders > 1")

    def next_leaders(self, classes: DataFrame, number: int) -> DataFrame:
        """Pairs of one more leader of each group with its members in other components.

        The first is the most like the centre; others are outside the main component, from the largest there.
        """
        members = materialize(few(_with_main(_mixed(self.members.drop("held"), classes)), self.rows))
        likeness = F.col("both") / (F.col("n") + F.col("centre") - F.col("both"))
        order = [likeness] if number == 0 else ["there", "popular", likeness]
        chosen = members if number == 0 else members.where("component <> main")
        chosen = few(chosen.groupBy("leader").agg(F.max(F.struct(*order, "id", "component")).alias("next")), self.rows)
        pairs = (members.join(chosen, "leader").where("component <> next.component")
                 .select(F.least("id", "next.id").alias("a"), F.greatest("id", "next.id").alias("b")).distinct())
        return few(pairs, self.rows)

    def _asked(self, one: Column, two: Column, both: Column) -> Column:
        """How many items outside the centre sets of two sizes have to share that share ``both`` inside."""
        return F.ceil(self.threshold * (one + two) / (100 + self.threshold)) - both

    def between(self, classes: DataFrame) -> DataFrame:
        """Pairs (a, b) under one leader, in different components, that could still link.

        Where two have to share q items, the rarest that they share has q - 1
        others after it among those of either, in order of rarity.  So only
        places from which enough are left are joined on, and what very many
        members hold is joined on only where little else is held.
        """
        members = _with_main(_mixed(self.members.drop("held"), classes)).withColumn(
            "asked", self._asked(F.col("n"), F.col("low"), F.col("both")))
        members = materialize(few(members, self.rows))

        def side(rows: DataFrame, k: str, *names: str) -> DataFrame:
            return rows.select("leader", *names, *[F.col(c).alias(f"{c}{k}") for c in kept])

        # one of two is outside the main component; if both are, one order is enough
        differ = (F.col("component1") != F.col("component2")) & (
            (F.col("component2") == F.col("main")) | (F.col("id1") < F.col("id2")))
        asked = self._asked(F.col("n1"), F.col("n2"), F.least("both1", "both2"))
        pair = [F.least("id1", "id2").alias("a"), F.greatest("id1", "id2").alias("b")]
        kept = ["id", "component", "n", "both"]
        free = members.where("asked <= 0")
        without = (side(free.where("component <> main"), "1", "main").join(side(free, "2"), "leader")
                   .where(differ & (asked <= 0)).select(*pair))

        kept = [*kept, "left"]
        first = F.slice("held", F.lit(1), F.greatest(F.lit(0), F.col("extra") - F.greatest("asked", F.lit(1)) + 1).cast("int"))
        held = members.where("asked <= extra").join(self.members.select("leader", "id", "held"), ["leader", "id"])
        held = materialize(held.select("leader", "main", "id", "component", "n", "both", "extra", F.posexplode(first))
                           .select("leader", "main", *kept[:-1], "col.item", (F.col("extra") - F.col("pos")).alias("left")))
        sharing = (side(held.where("component <> main"), "1", "item", "main").join(side(held, "2", "item"), ["leader", "item"])
                   .where(differ & (asked <= F.least("left1", "left2"))).select(*pair))
        return without.unionByName(sharing).distinct()


def _mixed(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``members`` (leader, id, ...) with their component, of leaders under which several components meet."""
    group = Window.partitionBy("leader")
    return (members.join(classes, "id", "left").withColumn("component", F.coalesce("component", "id"))
            .withColumns({"_low": F.min("component").over(group), "_high": F.max("component").over(group)})
            .where("_low <> _high").drop("_low", "_high"))


def _with_main(members: DataFrame) -> DataFrame:
    """``members`` with how many of a leader's are in their component, ``there``, and the ``main`` one with most."""
    there = F.count(F.lit(1)).over(Window.partitionBy("leader", "component"))
    main = F.max(F.struct("there", "component")).over(Window.partitionBy("leader"))["component"]
    return members.withColumn("there", there).withColumn("main", main)
