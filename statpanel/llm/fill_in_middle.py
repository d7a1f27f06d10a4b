"""Fill-in-middle transformation with DataFrame functions only.

`regexp_count` tells how many units a text has. From that and a hash of the row's id two cuts are drawn, and a pattern made for the row,
with possessive groups of unit{a} and unit{b-a}, captures prefix, middle and suffix in one match. A possessive count of a group is a
loop in the matcher and not a recursion, so a text of a million lines needs no deeper stack than one of two.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statpanel.llm.common import column

#: A line with its end, or the rest of the text after the last end of a line.
LINE = r"[^\n]*+\n|[^\n]++"
PREFIX, MIDDLE, SUFFIX = "<P>", "<M>", "<S>"
MARK = "<[PMS]>"
ADDED = ("n", "form", "output", "prefix_chars", "middle_chars")


def _draws(key: Column, seed: int) -> list[Column]:
    """The first four groups of 8 hex digits of the SHA-256 of `seed:key`, as numbers; a null key counts as no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _times(unit: str, count: Column) -> Column:
    return F.concat(F.lit(f"((?:{unit}){{"), count.cast("string"), F.lit("}+)"))


def fill_in_middle(docs: DataFrame, key: str = "doc_id", seed: int = 7, rate: int = 100, spm: int = 50, unit: str = LINE) -> DataFrame:
    """docs with n, form, output, prefix_chars and middle_chars; columns of these names are replaced, all others stay.

    The text is cut into n units. With h1 to h4 drawn from the row's id and `seed`, the prefix ends after the smaller of h1 % (n + 1) and
    h2 % (n + 1) units, the middle after the larger. `rate` of 100 rows are changed (by h3 % 100), of these `spm` of 100 (by h4 % 100) into
    <S>suffix<P>prefix<M>middle (form spm), the others into <P>prefix<S>suffix<M>middle (form psm). Other texts, empty ones and
    those that hold a mark stand as they are (form plain), with null for the numbers of characters, which are code points.

    Null text counts as empty; a null id draws as an id without digits; rows that repeat get equal results, and so do other texts with
    one id if they have as many units. Texts of any length are cut whole. An empty table gives an empty table. Each row is worked on by
    itself, so no key or copy can become hot. `unit` is a Java pattern that never matches empty and covers every text from its start.
    """
    names = [c for c in docs.columns if c not in ADDED]
    text = F.coalesce(F.col("text"), F.lit(""))
    draws = [h.alias(f"_h{i}") for i, h in enumerate(_draws(column(key), seed), 1)]
    rows = docs.select(F.struct(*[column(c) for c in names]).alias("_row"), text.alias("_text"), *draws)
    rows = rows.withColumn("_n", F.regexp_count("_text", F.lit(unit)).cast("long"))
    marked = reduce(or_, [F.contains("_text", F.lit(m)) for m in (PREFIX, MIDDLE, SUFFIX)])
    plain = (F.col("_text") == "") | marked | (F.col("_h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("_h4") % 100 < spm, "spm").otherwise("psm")
    one, two = F.col("_h1") % (F.col("_n") + 1), F.col("_h2") % (F.col("_n") + 1)
    rows = rows.withColumns({"_form": form, "_a": F.least(one, two), "_b": F.greatest(one, two)})
    pattern = F.concat(F.lit(r"(?s)\A"), _times(unit, F.col("_a")), _times(unit, F.col("_b") - F.col("_a")), F.lit(r"(.*+)\z"))
    order = F.when(F.col("_form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    output = F.when(F.col("_form") == "plain", F.col("_text")).otherwise(F.regexp_replace("_text", pattern, order))
    rows = rows.withColumn("_output", output).withColumn("_parts", _parts(F.col("_output"), F.col("_form")))
    return rows.select(
        *[F.col("_row").getField(c).alias(c) for c in names],
        F.col("_n").alias("n"),
        F.col("_form").alias("form"),
        F.col("_output").alias("output"),
        F.length(F.col("_parts.prefix")).cast("long").alias("prefix_chars"),
        F.length(F.col("_parts.middle")).cast("long").alias("middle_chars"),
    )


def _parts(output: Column, form: Column) -> Column:
    """prefix, middle and suffix of an output, null for a plain one. A text that holds a mark is never cut, so marks are where they were put."""
    cut = F.split(output, MARK)
    psm = F.struct(F.get(cut, F.lit(1)).alias("prefix"), F.get(cut, F.lit(3)).alias("middle"), F.get(cut, F.lit(2)).alias("suffix"))
    spm = F.struct(F.get(cut, F.lit(2)).alias("prefix"), F.get(cut, F.lit(3)).alias("middle"), F.get(cut, F.lit(1)).alias("suffix"))
    return F.when(form == "psm", psm).when(form == "spm", spm)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    parts = _parts(output, form)
    whole = F.concat(parts.getField("prefix"), parts.getField("middle"), parts.getField("suffix"))
    return F.when(form == "plain", output).otherwise(whole)
