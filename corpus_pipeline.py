"""The corpus pipeline: stages that each apply one operator to all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statpanel.llm import lines, near_duplicates, packing, toxicity
from statpanel.llm.common import column, table, written
from statpanel.llm.queries import VOCABULARY


def _carried(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the other columns under names that no operator uses or adds."""
    rest = [column(c).alias(f"carried_{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", *rest)


def _unpacked(rows: DataFrame, docs: DataFrame, n_chars: Column | None = None) -> DataFrame:
    """The columns of docs again, with the rows' texts, and `n_chars` if given."""
    out = []
    for i, (name, kind) in enumerate((f.name, f.dataType) for f in docs.schema):
        value = F.col(name) if name in ("doc_id", "text") else F.col(f"carried_{i}")
        if name == "n_chars" and n_chars is not None:
            value = F.coalesce(n_chars, value)
        out.append(value.cast(kind).alias(name))
    return rows.select(*out)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go. Labels are learned from the rows that are not held out.

    Null and empty texts are scored as texts without terms; very long texts are scored whole. Rows that repeat are scored alike and each
    stays or goes, also with null or equal ids. All columns stay as they are, whatever their names. An empty table gives an empty table.
    """
    rows = _carried(docs)
    machine = toxicity.learn(rows, table(spark, sf_dir, "labels"))
    return _unpacked(toxicity.scored(rows, machine).filter("predicted = 0"), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each class of similar lines stays. Documents that lose all their text go; n_chars is that of the new text.

    Null and empty texts stay. Of equal or similar lines the first by doc_id stays, null ids last; of rows that repeat in all columns the
    first one keeps its lines. Lines of any length are compared whole. All other columns stay as they are, whatever their names. An
    empty table gives an empty table.
    """
    kept = lines.deduplicated_lines(_carried(docs)).filter("removed_lines = 0 or text <> ''")
    return _unpacked(kept, docs, n_chars=F.when(F.col("removed_lines") > 0, F.length("text")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: that with the smallest doc_id, null ids last.

    Null and empty texts are equal, and so one class; texts without words are only near equal ones. Of rows with equal id and text one
    stays. Texts are compared whole. All columns stay as they are, whatever their names. An empty table gives an empty table.
    """
    return _unpacked(near_duplicates.deduplicated(_carried(docs)), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens.

    Null and empty texts are one end-of-text id; longer documents than a sequence are cut. Rows that repeat, and null ids, are each packed.
    Other columns are ignored; an empty table gives an empty table.
    """
    return packing.pack(packing.token_pieces(docs, VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack_sequences),
]
#: No stage but a part of the second can be said in SQL; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`; each stage reads the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
