"""What several operators of this subpackage share: working tables and grouped labels."""

from __future__ import annotations

import contextlib
import os
from collections.abc import Callable, Iterator
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statpanel.sources.scratch import scratch_path


#: Spark's setting to remove the files of a query's shuffles when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Paths of the tables written since the innermost `working` of this thread began.
_PATHS: ContextVar[list[str] | None] = ContextVar("paths", default=None)


def _remove(spark: SparkSession, path: str) -> None:
    """Through Spark's file systems, as the folder may be in a store that only Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def _path(df: DataFrame) -> str | None:
    return vars(df).get("_written")


def written(df: DataFrame, name: str, *spent: DataFrame) -> DataFrame:
    """`df` as a parquet table in the shared working folder, read again.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before the table. Each call writes
    to a new folder below `spark.checkpoint.dir`. The shuffles of this write are of no use
    after it, so Spark is asked to remove their files then, instead of when the driver collects garbage. The written tables among `spent`,
    which nothing reads any more once `df` is written, are removed then; `working` removes others. What is left the owner of the folder clears.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    if _PATHS.get() is not None:
        _PATHS.get().append(path)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    for table_ in spent:
        if _path(table_):
            _remove(spark, _path(table_))
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


@contextlib.contextmanager
def working(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables written inside are removed at the end, but those passed to the function that this yields, which the result reads."""
    paths: list[str] = []
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(_path(df))
        return df

    token = _PATHS.set(paths)
    try:
        yield keep
    finally:
        _PATHS.reset(token)
        outer = _PATHS.get()
        if outer is not None:
            outer.extend(kept)
        for path in paths:
            if path not in kept:
                _remove(spark, path)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """The column of just this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def one_thread() -> None:
    """Keep native libraries inside a task on the task's own core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"


def text_key(text: Column) -> Column:
    """128 bits of a text; equal texts, and null and empty, have equal keys."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _tangled(links: DataFrame) -> bool:
    """Whether edges (a, b) are no star forest: some node points at two others, or points and is pointed at."""
    sides = links.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    sides = sides.union(links.select("b", F.lit(0), F.lit(1)))
    sides = sides.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return not sides.filter("out > 1 or out > 0 and into > 0").isEmpty()


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (id, component), component the smallest id.

    Distributed union-find by alternating large-star and small-star steps: every node hooks its larger, then its smaller,
    neighbours to the smallest one it sees. Each step is one aggregation and one join over edges, written to the shared
    folder, until every node points straight at the smallest of its component; a component of any size gets there in a number of rounds
    that grows with the logarithm of its length, and only a yes or no reaches the driver. Loops, repeated and reversed edges are
    allowed, rows with a null end are ignored; an empty input gives an empty table. Nodes with no edge do not appear.
    """
    links = edges.filter("a is not null and b is not null and a <> b")
    links = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while _tangled(links):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = written(large.filter("a <> b").distinct(), name, links)
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        hooked = down.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        links = written(hooked.filter("a <> b").distinct(), name, down)
    nodes = links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    out = nodes.union(links.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
    out._written = _path(links)
    return out


def fits(spark, size: int) -> bool:
    """Whether a table of so many bytes is below Spark's own threshold for broadcasts."""
    return size <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def perhaps_among(rows: DataFrame, key: str, members: DataFrame, bits: int = 25) -> DataFrame:
    """The rows whose long `key` may be among the `members` (one long column): none that is gets lost.

    A filter to put before a join, so that rows without a partner are not shuffled. Members, a written table, that are together below Spark's
    threshold are broadcast themselves. More become a bitmap of 2**bits places by hash, 4 MB whatever their number, which is
    broadcast; of other rows the share of places taken gets through.
    """
    if fits(rows.sparkSession, 16 * members.count()):
        own = members.select(F.col(members.columns[0]).alias(key)).distinct()
        return rows.join(F.broadcast(own), key, "left_semi").select(*rows.columns)
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits)) + 1
    spot = members.select(place(F.col(members.columns[0])).alias("_place"))
    maps = spot.groupBy(F.bitmap_bucket_number("_place").alias("_bucket"))
    maps = maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bitmap"))
    at = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    marked = rows.withColumn("_place", place(F.col(key))).withColumn("_bucket", F.bitmap_bucket_number("_place"))
    marked = marked.join(F.broadcast(maps), "_bucket").filter(F.getbit(byte, (at % 8).cast("int")) == 1)
    return marked.select(*rows.columns)


#: Nodes that a node is compared with in a sparing turn.
SOME = 10


def _hubs(open_: DataFrame, turn: int, sparing: bool) -> DataFrame:
    """(bucket, y, yc): of each bucket the node that its other nodes are compared with, and its class.

    In the first turn the smallest. Later the one that meets most others, such as the text that others are copies of; with `sparing`
    any of the bucket's largest class, another one each turn, but in the second that with the least `share` where open_ has that column.
    """
    if not turn:
        first = F.min(F.struct("n", "c"))
    elif turn == 1 and "share" in open_.columns:
        first = F.min(F.struct("share", "n", "c"))
    elif not sparing:
        met = open_.groupBy("n").agg(F.sum("size").alias("met"))
        open_, first = open_.join(met, "n"), F.min(F.struct(-F.col("met"), "n", "c"))
    else:
        any_ = F.min(F.struct(F.xxhash64("n", F.lit(turn)), "n"))
        open_ = open_.groupBy("bucket", "c").agg(F.count("*").alias("k"), any_.alias("any"))
        open_, first = open_.withColumn("n", F.col("any.n")), F.max(F.struct("k", "n", "c"))
    return open_.groupBy("bucket").agg(first.alias("f")).select("bucket", F.col("f.n").alias("y"), F.col("f.c").alias("yc"))


def linked(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    name: str,
    apart: Callable[[DataFrame], DataFrame],
    sparing: bool = False,
    measured: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Classes (id, component) of nodes `n` that share a `bucket` and that `verify` confirms, without all pairs of a bucket.

    `verify` takes and returns distinct pairs (a, b), a < b. First each node is compared with the smallest node of each of its
    buckets, then, where a bucket still holds several classes, with the node that meets most others, such as the text that others are
    copies of. What is still apart after that is compared pair by pair, but only across classes: `apart`, from rows
    (bucket, n, c, size) with c the class so far and the size of the bucket, gives all pairs (x, y) that can be similar. So a bucket of copies costs a few
    comparisons per node, and no link between classes is lost.

    With `sparing`, for buckets that seldom hold nodes by chance, a turn compares a node with SOME others of its buckets: first with their
    smallest ones, then, turn after turn, with some of the largest class of a bucket, as long as that leaves a quarter less to do. After the
    first turn `measured` adds to rows (bucket, n, size) a column `share`, less for nodes that more are likely to be similar to, and others
    for `apart`, and leaves out nodes that nothing can be similar to; the second turn compares nodes with those of the least share.
    """
    # Buckets are added up before the shuffle and joined back: a bucket of any size is split over tasks.
    several = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1").hint("shuffle_hash")
    members = written(members.join(several, "bucket").select("bucket", "n", "size"), name)
    open_ = members.withColumn("c", F.col("n"))
    links = tried = labels = None
    left, turn, last = None, 0, False

    def still_open() -> DataFrame:
        """The rows of buckets that hold several classes."""
        labelled = members.join(labels, F.col("n") == F.col("id"), "left")
        labelled = labelled.select(*members.columns, F.coalesce("component", "n").alias("c"))
        if not sparing:  # the one pair of a bucket of two has been compared
            labelled = labelled.filter("size > 2")
        split = labelled.groupBy("bucket").agg(F.min("c").alias("least"), F.max("c").alias("most")).filter("least < most")
        return labelled.join(split.select("bucket").hint("shuffle_hash"), "bucket")

    while True:
        if last:
            pairs = spent = apart(open_)
        else:
            pairs = spent = open_.join(_hubs(open_, turn, sparing).hint("shuffle_hash"), "bucket").filter("yc <> c")
            if sparing:  # a node has so many buckets and no more
                some = F.slice(F.sort_array(F.collect_set(F.struct(F.xxhash64("y", "n"), "y"))), 1, SOME)
                pairs = pairs.groupBy("n").agg(some.alias("some")).select("n", F.explode("some.y").alias("y"))
            pairs = pairs.select(F.col("n").alias("x"), "y")
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, name, spent)
        tried = pairs if tried is None else tried.union(pairs)
        found = written(verify(pairs), name) if not turn or not pairs.isEmpty() else pairs.limit(0)
        stale = open_
        if not turn or not found.isEmpty():
            links = found if links is None else links.union(found)
            old, labels = labels, components(links, name)
        else:
            old = None
        if last:
            return labels
        open_ = written(still_open(), name, *(t for t in (stale, old) if t is not None))
        before, left, turn = left, open_.count(), turn + 1
        if not left:
            return labels
        last = before is not None and 4 * left > 3 * before if sparing else turn == 2
        if turn == 1 and measured is not None:
            members = written(measured(open_.drop("c")), name, members)
            open_ = written(still_open(), name, open_)
            left = open_.count()
            if not left:
                return labels
