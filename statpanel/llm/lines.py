"""Fuzzy line deduplication: MinHash bands, exact comparison, distributed union-find.

Lines are compared by character shingles: WIDTH characters from every character on, or the whole of a shorter line. MinHash signatures of the
shingles are cut into bands; lines that share a band, and whose signatures agree in enough places, are of one bucket, and the lines of a bucket
are compared exactly, by 64-bit hashes of the shingles; classes are the connected components of similar lines, and one line of each class stays.

Signatures, their bands and exact comparisons are made in numpy inside tasks: cutting and hashing shingles, and dealing out bands, with DataFrame
functions took several times the CPU. All else is DataFrame functions.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statpanel.llm import line_signatures
from statpanel.llm.common import components, fits, perhaps_among, working, written
from statpanel.llm.line_signatures import BANDS, RECORD, WIDTH

SIMILARITY = 0.8
#: Lines of a band that are compared pair by pair at once.
MANY = 32
#: Bytes of the records of a part, which one task takes at a time.
PART = 1 << 20
#: Characters of a bucket's lines that one task compares with each other, if lines times characters are at most 4 * MANY**6.
TOGETHER = 1 << 21
#: The shingle stands in a group ahead of the one character that is consumed.
SHINGLE = rf"(?s)(?=(.{{{WIDTH}}}|\A.{{1,{WIDTH - 1}}}(?!.)))."
WHITE = " \t\r\x0b\x0c"


def shingles(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(SHINGLE), F.lit(1))


def _split(text: Column) -> Column:
    return F.split(text, "\n")


def _trimmed(line: Column) -> Column:
    """Without white space at the ends. Looking at the ends first spares most lines the trim, which reads them whole."""
    ends = [test(w) for w in WHITE for test in (line.startswith, line.endswith)]
    return F.when(reduce(or_, ends), F.trim(line, F.lit(WHITE))).otherwise(line)


def _keyed(docs: DataFrame) -> DataFrame:
    """(late, _row, text, _doc): the order of a row, a hash of it, and its other columns. Rows that agree in all columns are interchangeable."""
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    late = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return docs.select(late.alias("late"), F.xxhash64(*hashed).alias("_row"), "text", rest.alias("_doc"))


def _lines(docs: DataFrame, *kept: str) -> DataFrame:
    """Every line that is not blank, without white space at its ends, and two hashes of it."""
    exploded = docs.select(*kept, F.posexplode(_split(F.col("text"))).alias("pos", "raw"))
    lines = exploded.select(*kept, "pos", _trimmed(F.col("raw")).alias("line")).filter("line <> ''")
    return lines.withColumns({"n": F.xxhash64("line"), "n2": F.xxhash64(F.lit(7), "line")})


def _signed(docs: DataFrame, lines: int | None = None) -> DataFrame:
    """(part, records): the bands of the signature of every distinct line, packed. `lines` is the number of lines, if known."""
    lines = _lines(docs).count() if lines is None else lines
    return line_signatures.signed(docs, WHITE, 1 + lines * BANDS * RECORD.itemsize // PART)


def _buckets(signed: DataFrame) -> DataFrame:
    """(bucket, n): the lines that share a band, and whose signatures agree in enough places."""
    return line_signatures.buckets(signed, MANY)


def similar_lines(docs: DataFrame, similar: float = SIMILARITY, lines: int | None = None) -> DataFrame:
    """(n, n2, component): the classes of distinct lines that are similar to another distinct line, by the lines' hashes.

    Lines of a bucket are compared where their texts lie together, so no pair of a bucket is a row. Of buckets too large for one task each line
    is compared with the first, and with its neighbours in a block; then lines of different classes are paired by their rarest shingles.
    """
    members = written(_buckets(_signed(docs, lines)), "lines-members")
    wanted = written(members.select("n").distinct(), "lines-involved")
    texts = perhaps_among(_lines(docs), "n", wanted).select("n", "n2", "line").dropDuplicates(["n", "n2"])
    texts = written(texts, "lines-texts", wanted)

    lengths = texts.select("n", F.length("line").cast("long").alias("chars"))
    size = members.join(lengths, "n").groupBy("bucket").agg(F.count("*").alias("lines"), F.sum("chars").alias("chars"))
    size = size.filter((F.col("lines") * F.col("chars") > 4 * MANY**6) | (F.col("chars") > TOGETHER))
    large = written(size.select("bucket"), "lines-large")
    several = not large.isEmpty()
    rows, wide = members, None
    if several:
        wide = written(members.join(large, "bucket").join(lengths, "n"), "lines-wide")
        rows = members.join(large, "bucket", "left_anti").union(_blocks(wide))
    links = written(line_signatures.similar_in_buckets(rows.join(texts.select("n", "line"), "n"), similar), "lines-links", members)
    labels = components(links, "lines-links")
    if several:
        classes = wide.select("bucket", "n").join(labels, F.col("n") == F.col("id"), "left")
        classes = classes.select("bucket", "n", F.coalesce("component", "n").alias("c"))
        split = classes.groupBy("bucket").agg(F.min("c").alias("least"), F.max("c").alias("most")).filter("least < most")
        apart = written(classes.join(split, "bucket", "left_semi").select("n", "c").distinct(), "lines-apart", wide)
        if not apart.isEmpty():
            side = lambda s: texts.select(F.col("n").alias(s), F.col("line").alias(f"line_{s}"))
            pairs = _rare_pairs(apart, texts, similar)
            more = line_signatures.similar_pairs(pairs.join(side("b"), "b").join(side("a"), "a"), similar)
            links = written(links.union(more), "lines-links", links, apart)
            labels = components(links, "lines-links")
    return labels.join(texts, labels.id == texts.n).select("n", "n2", "component")


def _blocks(wide: DataFrame) -> DataFrame:
    """(bucket, n) of blocks of rows (bucket, n, chars) of large buckets, each with the bucket's first line, by which a bucket goes."""
    before = Window.partitionBy("bucket").orderBy("n")
    chars = F.sum("chars").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    block = F.floor((F.row_number().over(before) - 1) / (2 * MANY**2)) + F.floor(chars / TOGETHER)
    blocks = wide.select("bucket", "n", block.alias("block")).select(F.xxhash64("bucket", "block").alias("key"), "bucket", "n")
    return blocks.select(F.col("key").alias("bucket"), F.explode(F.array("n", "bucket")).alias("n")).distinct()


def _rare_pairs(classes: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """Pairs (a, b) of lines (n, c) of different classes that share one of their rarest shingles.

    A line of m shingles has at most m - similar * m that a similar line lacks, so of any order of the shingles the first
    m - ceil(similar * m) + 1 hold a common one. With the rarest first, what many lines share makes no pair. If the first common
    one stands at place i of m and j of k, no more than min(m - i, k - j) can be common, and similar lines need similar / (1 + similar) of m + k.
    """
    wide = written(texts.dropDuplicates(["n"]).join(classes, "n").select("n", "c", "line"), "lines-wide")
    often = texts.sparkSession.sparkContext.broadcast(line_signatures.shingle_counts(wide))
    rare = written(line_signatures.first_shingles(wide, often, similar), "lines-rare", wide)
    one, two = rare.alias("one"), rare.alias("two")
    same = (F.col("one.s") == F.col("two.s")) & (F.col("one.c") < F.col("two.c"))
    need = (F.col("one.m") + F.col("two.m")) * F.lit(similar / (1 + similar)) - 1e-9
    near = F.least("one.left", "two.left") >= need
    pairs = one.join(two, same & near).select(F.least("one.n", "two.n").alias("a"), F.greatest("one.n", "two.n").alias("b"))
    return written(pairs.distinct(), "lines-rare-pairs", rare)


def deduplicated_lines(docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """docs with one line of each class of similar lines: the first by doc_id (null last), row hash and place. Adds removed_lines.

    Lines end at \\n; white space at their ends does not count. Equal lines, and lines whose shingle sets have a Jaccard similarity of
    `similar` or more, are of one class, through others too. Blank lines are never removed, but a text that loses all its other
    lines becomes empty. Kept lines stand as they were. Null and empty texts stay. Of rows that repeat in all columns one counts as
    the first, the others lose all their lines. All columns are kept; a column removed_lines is replaced. An
    empty table gives an empty table.

    Equal lines meet as counts added up before any shuffle, so a line that stands in a third of all documents costs no more than
    another. Texts are shuffled at most once, to their own removals; not at all where these are few enough to be broadcast.
    """
    keyed = _keyed(docs.drop("removed_lines"))
    with working(docs.sparkSession) as kept:
        marks = kept(_gone(keyed.drop("_doc"), similar))
    rows, places = marks.agg(F.count("*"), F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()
    marks = marks.hint("broadcast" if fits(docs.sparkSession, 48 * rows + 4 * places) else "shuffle_hash")
    out = keyed.join(marks, ["late", "_row"], "left")

    names = [c for c in docs.columns if c != "removed_lines"]

    def finished(rows: DataFrame, gone: Column) -> DataFrame:
        """Texts without the lines at the places `gone`; texts that lose none, where it is null, are not touched."""
        rows = rows.withColumn("places", gone).withColumn("parts", F.when(F.col("places").isNotNull(), _split(F.col("text"))))
        rows = rows.withColumn("stay", F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("places")))
        rows = rows.withColumn("kept", F.transform("stay", lambda i: F.get(F.col("parts"), i)))
        some = F.exists("kept", lambda x: _trimmed(x) != "")
        text = F.when(F.col("places").isNull(), F.col("text")).otherwise(F.when(some, F.array_join("kept", "\n")).otherwise(F.lit("")))
        columns = [text.alias(c) if c == "text" else F.col("_doc").getField(c).alias(c) for c in names]
        return rows.select(*columns, F.coalesce(F.size("places"), F.lit(0)).alias("removed_lines"))

    single = finished(out.filter("not coalesce(repeated, false)"), F.col("gone"))
    number = F.row_number().over(Window.partitionBy("late", "_row").orderBy(F.lit(0)))
    many = out.filter("repeated").withColumn("number", number)
    full = F.filter(F.transform(_split(F.col("text")), lambda x, i: F.when(_trimmed(x) != "", i)), lambda i: i.isNotNull())
    return single.unionByName(finished(many, F.when(F.col("number") == 1, F.col("gone")).otherwise(full)))


def _gone(lines: DataFrame, similar: float) -> DataFrame:
    """(late, _row, gone, repeated) of the rows that lose lines, at the places `gone`, or that repeat in all columns."""
    occurs = written(_lines(lines, "late", "_row").select("late", "_row", "pos", "n", "n2"), "lines-places")
    with working(lines.sparkSession) as kept:
        labels = kept(written(similar_lines(lines, similar, occurs.count()), "lines-classes"))
    spot = F.struct("late", "_row", "pos")
    keys = occurs.groupBy("n", "n2").agg(F.min(spot).alias("first"), F.count("*").alias("copies"))
    keys = keys.join(labels, ["n", "n2"], "left").filter("copies > 1 or component is not null")
    keys = shared_ = written(keys, "lines-shared", labels)
    firsts = keys.filter("component is not null").groupBy("component").agg(F.min("first").alias("class_first"))
    keys = keys.join(firsts, "component", "left")
    keys = written(keys.select("n", "n2", F.coalesce("class_first", "first").alias("first")), "lines-firsts", shared_)
    # Small sides are hashed, so that places and texts need no sort. All lines of rows that repeat are shared ones.
    shared = occurs.join(keys.hint("shuffle_hash"), ["n", "n2"])
    gone = F.collect_set(F.when(spot != F.col("first"), F.col("pos"))).alias("gone")
    marks = shared.groupBy("late", "_row").agg(gone, (F.count("*") > F.size(F.collect_set("pos"))).alias("repeated"))
    marks = marks.select("late", "_row", F.when(F.size("gone") > 0, F.col("gone")).alias("gone"), "repeated")
    return written(marks.filter("gone is not null or repeated"), "lines-gone")
