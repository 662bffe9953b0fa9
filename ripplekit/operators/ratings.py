"""M1-M4: jobs on a parsed rating matrix (``title, cells, ratings``; see
``sources.text.parse_matrix``).  Users are numbered from 1 by position.

M1 and M2 are row-local expressions (no shuffle for M1, one global partial
aggregate for M2).  M3 explodes cells and aggregates per user with a partial
aggregate, so a very wide or very tall matrix never gathers a user in one
place.  M4 gives the pairs of titles with their number of equal ratings: all
of them, or those with a minimum (see :func:`similarity`).
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, comb, sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplekit.plans.lineage import materialize

MAX_KEYS = 64     # of a title in the similarity join
BLOCK = 1000      # items of a list, about
CELLS = 1 << 22   # of a list of titles and their ratings, about
TILES = 16        # pairs of lists of a task, about, where all titles are compared


def top_users(parsed: DataFrame) -> DataFrame:
    """M1: per title, the users holding the row maximum, in user order.

    The running maximum of the reference starts at 1, so ratings below 1
    never win and a row without a rating of at least 1 gives an empty list.
    Output ``title string, top_users array<int>, mx int``; ``mx`` (the
    winning rating, at least 1) is kept for the legacy text rendering."""
    mx = F.greatest(F.lit(1), F.array_max("ratings"))
    winners = F.filter(
        F.transform("ratings", lambda x, i: F.when(x == F.col("mx"), i + 1)),
        lambda u: u.isNotNull())
    return parsed.select("title", "ratings", mx.alias("mx")) \
        .select("title", winners.cast("array<int>").alias("top_users"), "mx")


def render_top_users(top: DataFrame, legacy_comma: bool = False) -> DataFrame:
    """Text form ``title,u1,u2``.  With ``legacy_comma`` a row whose
    maximum is exactly 1 gets the stray comma of the reference
    (``title,,u1,u2``)."""
    users = F.array_join(F.col("top_users").cast("array<string>"), ",")
    stray = F.when((F.col("mx") == 1) & (F.size("top_users") > 0), F.lit(",")).otherwise(F.lit(""))
    if not legacy_comma:
        stray = F.lit("")
    return top.select(F.concat(F.col("title"), F.lit(","), stray, users).alias("value"))


def total_ratings(parsed: DataFrame) -> DataFrame:
    """M2: number of present (non-blank) cells; no row at all for an empty
    input, like a reduce with no group."""
    present = F.size(F.filter("cells", lambda c: c != ""))
    return (parsed.agg(F.sum(present).cast("long").alias("n"), F.count(F.lit(1)).alias("_rows"))
            .where(F.col("_rows") > 0).select("n"))


def ratings_per_user(parsed: DataFrame) -> DataFrame:
    """M3: per user position, the number of present cells; users whose
    cells are all blank are kept with 0."""
    return (parsed.select(F.posexplode("cells").alias("p", "cell"))
            .groupBy((F.col("p") + 1).cast("int").alias("usr"))
            .agg(F.sum(F.when(F.col("cell") != "", 1).otherwise(0)).cast("long").alias("n")))


class DuplicateTitles(ValueError):
    pass


def similarity(parsed: DataFrame, min_score: int | None = 1, on_ragged: str = "pad") -> DataFrame:
    """M4: for every unordered pair of titles the number of positions where
    both ratings are equal and nonzero: ``m1 < m2, n long``.  With
    ``min_score=None`` these are all pairs, as in the reference, also those
    with 0; with a minimum, pairs below are no result, so the output is as
    large as the number of similar pairs, not the square of the titles.

    Plan for all pairs: see :func:`_every_pair`.  Plan with a minimum:
    titles with equal ratings form one class, whose ratings are
    compared once.  The positions are cut into groups so that ``min_score``
    equal ones put at least ``r`` into one group (see
    :func:`_position_keys`); ratings meet on ``r`` equal positions of a group,
    without blanks or zeros, and a pair that meets on several counts at its
    first.  The more selective ``min_score``, the fewer the meetings.  What
    shares a key, and the titles of a class, lie in lists of about ``BLOCK``,
    and pairs of lists are dealt over the tasks, so neither a frequent key nor
    a large class is one task's work.

    Titles must be unique; otherwise an error names up to 20 of the repeated
    ones and says how many there are.  Rows of different width are compared
    position by position, a missing cell counting as blank
    (``on_ragged='pad'``) or raising (``'error'``).
    """
    if min_score is not None and min_score < 1:
        raise ValueError("min_score must be at least 1, or None for all pairs")
    vec = materialize(parsed.select(
        "title", F.transform("ratings", lambda x: F.coalesce(x, F.lit(0))).alias("v")), "title-vectors")
    stats = vec.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("title").alias("nd"),
                    F.min(F.size("v")).alias("lo"), F.max(F.size("v")).alias("hi")).first()
    if stats["n"] != stats["nd"]:
        again = vec.groupBy("title").count().where("count > 1")
        some = [r["title"] for r in again.orderBy("title").limit(20).collect()]
        raise DuplicateTitles(f"titles must be unique; {again.count()} repeated, such as {some}")
    if on_ragged == "error" and stats["lo"] != stats["hi"]:
        raise ValueError(f"rows differ in width ({stats['lo']}..{stats['hi']})")
    width = int(stats["hi"] or 0)
    if min_score is not None and width < min_score:
        return vec.select(F.col("title").alias("m1"), F.col("title").alias("m2"),
                          F.lit(0).cast("long").alias("n")).where(F.lit(False))
    vec = vec.select("title", F.concat("v", F.array_repeat(F.lit(0), F.lit(width) - F.size("v"))).alias("v"))
    if min_score is None:
        return _every_pair(vec, int(stats["n"]), width)
    classes = vec.select("v").distinct()
    groups, keys = _position_keys(width, min_score)
    keyed = classes.select("v", F.explode(F.array(*[
        F.struct(F.lit(g).alias("g"), F.array(*[F.get("v", p) for p in key]).alias("k"))
        for g, key in enumerate(keys)])).alias("x")).select("v", "x.g", "x.k").where(~F.array_contains("k", 0))
    lists = materialize(_blocks(materialize(keyed, "title-keys"), ["g", "k"], "v"), "title-lists")
    met = _pairs_of_blocks(lists.join(_second(lists), ["g", "k"]).where("i <= j"),
                           ["g", "k", "i", "j"], F.col("i") == F.col("j"), ["g"])
    n = _n_equal("x", "y", width)
    first = F.coalesce(*[F.when(F.size(h) >= r, F.slice(h, 1, r)) for h, r in (
        (_equal_positions("x", "y", lo, hi), r) for lo, hi, r in groups)])
    at_first = first == F.array(*[F.array(*map(F.lit, key)) for key in keys])[F.col("g")]
    near = met.where(n >= min_score).where(at_first).select("x", "y", n.alias("n"))
    own = classes.select(F.col("v").alias("x"), F.col("v").alias("y"), _n_equal("v", "v", width).alias("n"))
    alike = materialize(near.unionByName(own.where(F.col("n") >= min_score)), "similar-ratings")

    members = materialize(_blocks(vec, ["v"], "title"), "class-lists")
    both = alike.join(members.withColumnsRenamed({"v": "x"}), "x") \
        .join(_second(members).withColumnsRenamed({"v": "y"}), "y").where("x != y OR i <= j")
    titles = _pairs_of_blocks(both, ["x", "y", "i", "j"], (F.col("x") == F.col("y")) & (F.col("i") == F.col("j")),
                              ["n"], ("t1", "t2"))
    return titles.select(F.least("t1", "t2").alias("m1"), F.greatest("t1", "t2").alias("m2"),
                         F.col("n").cast("long").alias("n"))


def _every_pair(vec: DataFrame, n: int, width: int) -> DataFrame:
    """All pairs of the ``n`` titles and their scores.  The titles lie in lists
    of about ``BLOCK`` (or ``CELLS`` cells), and each pair of lists ``i <= j``
    is formed once: the titles of list ``i``, row by row, meet list ``j``.  So
    a title is moved once per list, not once per title, a task holds one list
    at a time and has about ``TILES`` pairs of lists however many titles there
    are."""
    tasks = _tasks(vec.sparkSession)
    in_list = max(1, min(BLOCK, CELLS // max(1, width)))
    n_lists = max(1, ceil(n / in_list), min(n, ceil(sqrt(2 * tasks))))
    tasks = max(tasks, n_lists * (n_lists + 1) // 2 // TILES)
    dealt = vec.select(F.pmod(F.xxhash64("title"), F.lit(n_lists)).cast("int").alias("i"), "title", "v")
    rows = dealt.select("i", F.explode(F.sequence("i", F.lit(n_lists - 1))).alias("j"),
                        F.col("title").alias("x"), F.col("v").alias("vx")).repartition(tasks, "i", "j")
    lists = dealt.repartition(n_lists, "i").groupBy(F.col("i").alias("j")) \
        .agg(F.collect_list(F.struct("title", "v")).alias("ys")) \
        .select(F.explode(F.sequence(F.lit(0), "j")).alias("i"), "j", "ys").repartition(tasks, "i", "j")
    # Not to be broadcast: the planner does not see how often a list is sent.
    met = rows.join(lists.hint("merge"), ["i", "j"]).select("i", "j", "x", "vx", F.inline("ys").alias("y", "vy"))
    return met.where("i != j OR x < y").select(
        F.least("x", "y").alias("m1"), F.greatest("x", "y").alias("m2"),
        _n_equal("vx", "vy", width).cast("long").alias("n"))


def _position_keys(width: int, least: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, ...]]]:
    """Groups ``(from, to, r)`` of positions so that ``least`` of ``width``
    positions put at least ``r`` into one group, and the sets of ``r``
    positions of a group, the keys.  ``p`` groups have ``r = ceil(least / p)``;
    the fewest groups, hence the longest keys, are taken that give up to
    ``MAX_KEYS`` keys, else ``width - least + 1`` groups of which one is
    whole."""
    def cut(p):
        cuts = [g * width // p for g in range(p + 1)]
        return list(zip(cuts, cuts[1:]))

    for p in range(1, least + 1):
        r = -(-least // p)
        if sum(comb(hi - lo, r) for lo, hi in cut(p)) <= MAX_KEYS:
            groups = [(lo, hi, r) for lo, hi in cut(p)]
            break
    else:
        groups = [(lo, hi, hi - lo) for lo, hi in cut(width - least + 1)]
    return groups, [key for lo, hi, r in groups for key in combinations(range(lo, hi), r)]


def _equal_positions(x: str, y: str, lo: int, hi: int) -> Column:
    return F.filter(F.array(*[F.lit(p) for p in range(lo, hi)]),
                    lambda p: (F.get(x, p) == F.get(y, p)) & (F.get(x, p) != 0))


def _n_equal(x: str, y: str, width: int) -> Column:
    """Positions where both ratings are equal and nonzero; of a narrow matrix
    as one sum, which Spark compiles."""
    if width > 16:
        return F.size(_equal_positions(x, y, 0, width))
    return sum((F.when((F.get(x, F.lit(p)) == F.get(y, F.lit(p))) & (F.get(x, F.lit(p)) != 0), 1).otherwise(0)
                for p in range(width)), F.lit(0))


def _blocks(rows: DataFrame, keys: list[str], item: str) -> DataFrame:
    """The items of every key in lists of about ``BLOCK``, numbered ``i``:
    ``keys, i, xs``."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("n_blocks"))
    return rows.join(sizes, keys).groupBy(*keys, F.pmod(F.xxhash64(item), F.col("n_blocks")).alias("i")) \
        .agg(F.collect_list(item).alias("xs"))


def _second(lists: DataFrame) -> DataFrame:
    return lists.withColumnsRenamed({"i": "j", "xs": "ys"})


def _tasks(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _pairs_of_blocks(lists: DataFrame, by: list[str], same: Column, keep: list[str],
                     names: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Pairs of an item of ``xs`` and one of ``ys``, each pair once where both
    are the ``same`` list."""
    tasks = _tasks(lists.sparkSession)
    x, y = names
    return (lists.withColumn("_same", same).where((F.size("xs") > 1) | ~F.col("_same"))
            .repartition(tasks, *by)   # a fixed number: the pairs are many where the lists are small
            .select(*keep, "_same", "ys", F.posexplode("xs").alias("_a", x))
            .select(*keep, "_same", "_a", x, F.posexplode("ys").alias("_b", y))
            .where(~F.col("_same") | (F.col("_a") < F.col("_b"))).select(*keep, x, y))
