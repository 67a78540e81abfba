"""A training corpus from `documents`: five stages, each written and read by the next.

The quality classifier rejects documents; near-duplicate lines are removed from texts; of each
group of near-duplicate documents one stays; documents with benchmark passages go; the rest is
encoded and decoded. A stage returns the columns of its input, whatever they are; the last returns
the ids and the text that they give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epochfold.llm import bpe, decontaminate, lines, near_dup, quality
from epochfold.llm.queries import TOKENIZER
from epochfold.llm.shared import stored, table

#: Percent of shingles that near-duplicate documents share.
SIMILAR = 80


class Columns:
    """A frame's columns under numbers, so that no name of a stage clashes with them."""

    def __init__(self, docs: DataFrame):
        self.names = docs.columns
        self.numbers = [f"c{i}" for i in range(len(self.names))]
        self.frame = docs.toDF(*self.numbers)
        self.doc_id, self.text = (self.numbers[self.names.index(n)] for n in ("doc_id", "text"))

    def keyed(self, nulls_first: bool) -> DataFrame:
        """The frame with a key of each (id, text) as `row`, in the order of ids.

        Ids may be null or repeated. Rows of equal id and text are one.
        """
        of_text = [F.xxhash64(self.text), F.xxhash64(F.lit(7), self.text)]
        doc_id = [F.col(self.doc_id)] if nulls_first else [F.col(self.doc_id).isNull(), F.col(self.doc_id)]
        parts = [part.alias(f"k{i}") for i, part in enumerate([*doc_id, *of_text])]
        return self.frame.withColumn("row", F.struct(*parts))

    def named(self, frame: DataFrame) -> DataFrame:
        return frame.select(*self.numbers).toDF(*self.names)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects.

    Each row is judged by its text, so equal texts share their fate under any id. A null or empty
    text is judged as one without words; an empty table gives none.
    """
    cols = Columns(docs)
    scored = quality.score(
        cols.frame, table(spark, sf_dir, "labels"), 0.3, cols.doc_id, cols.text, tuple(cols.numbers)
    )
    return cols.named(scored.where("predicted = 1"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text without the lines that occur before, alike, in this or another document.

    Documents stay, if only with blank lines; where `n_chars` is a column it follows the text. Texts
    without an id, or under the same one, are documents of their own, unless they are equal.
    """
    cols = Columns(docs)
    rows = cols.keyed(nulls_first=True)
    found = lines.groups(rows, id_col="row", text_col=cols.text)
    gone = found.where("not kept").groupBy(F.col("doc_id").alias("of"))
    gone = gone.agg(F.collect_list("line_no").alias("dropped"))
    joined = rows.join(gone, F.col("row") == F.col("of"), "left")
    joined = joined.withColumn("lines", F.split(cols.text, "\n", -1))
    out = joined.withColumn(cols.text, lines.remaining("lines", "dropped"))
    if "n_chars" in cols.names:
        n_chars = cols.numbers[cols.names.index("n_chars")]
        kind = cols.frame.schema[n_chars].dataType
        out = out.withColumn(n_chars, F.char_length(cols.text).cast(kind))
    return cols.named(out)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Rows that repeat an id with the same text are such a group too; other texts under that id are
    documents of their own. A document without an id comes after those with one.
    """
    cols = Columns(docs)
    rows = cols.keyed(nulls_first=False)
    found = near_dup.components(rows, SIMILAR, "row", cols.text)
    gone = found.where("not kept").select(F.col("doc_id").alias("of")).distinct()
    left = rows.join(gone, F.col("row") == F.col("of"), "left_anti")
    return cols.named(left.dropDuplicates(["row"]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of a benchmark item.

    Each row is judged by its text, under any id. A null or empty text holds none and stays; so does
    every row if there are no items.
    """
    cols = Columns(docs)
    found = decontaminate.find(
        cols.frame,
        table(spark, sf_dir, "benchmark"),
        id_col=cols.doc_id,
        text_col=cols.text,
        keep=tuple(cols.numbers),
    )
    return cols.named(found.where("size(hits) = 0"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): the ids of every text that is left, and the text decoded from them.

    One row for each row, repeated ones and null ids included; a null or empty text has no ids and
    decodes to an empty text; an empty table gives no rows.
    """
    done = bpe.round_trip(docs, TOKENIZER)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES = [
    ("quality", keep_good),
    ("lines", drop_lines),
    ("near duplicates", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier has no SQL form; tests cover every stage.
ORACLE_SQL = None
