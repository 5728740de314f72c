"""From raw documents to shards of a training corpus, in five stages of the text operators.

Each stage takes ``(spark, docs, sf_dir)``, works on all of ``docs`` and returns a frame that is
written and read again as the docs of the next. All but the last return the columns of documents.
Any column may be null; rows may repeat; an empty table passes through. Rows are matched by a digest
of all their columns, so missing or repeated ids do no harm. Further columns may have any name; the
last stage replaces columns named shard and slot.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fraudlake.llm.common import row_key, stash, table
from fraudlake.llm.decontaminate import contaminated, contamination
from fraudlake.llm.language import LEAST_SCORE, UNKNOWN, learn, with_language
from fraudlake.llm.mixing import mix
from fraudlake.llm.sharding import SHARDS, shard_documents
from fraudlake.llm.simhash import near_duplicate_classes

DIGEST = "_row_digest"
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def apart(stage: Stage) -> Stage:
    """The stage with further columns under names that nothing inside it uses."""

    @wraps(stage)
    def renamed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inside = [c if c in DOCUMENT else f"_further{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*inside), sf_dir).toDF(*docs.columns)

    return renamed


def digested(docs: DataFrame) -> DataFrame:
    return docs.withColumn(DIGEST, row_key(*docs.columns))


def first_of_equal_rows(rows: DataFrame) -> DataFrame:
    """One of each set of rows with one digest."""
    place = F.row_number().over(Window.partitionBy(DIGEST).orderBy(DIGEST))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


@apart
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from all of them that name theirs.

    Texts that are null or have no letter go, and texts of whose n-grams less than a fifth is in any
    learned language. If no document names its language, none is learned, and all texts with a letter stay.
    """
    model = learn(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = with_language(docs, model, docs.columns)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


@apart
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: the one with the smallest id, of equal ids any one.

    Ids that are null come last.
    """
    rows = digested(docs)
    classes = near_duplicate_classes(rows, keep=(DIGEST,))
    rank = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col(DIGEST).alias("c"))
    kept = classes.groupBy("class").agg(F.min(rank).alias("best")).select(F.col("best.c").alias(DIGEST))
    return first_of_equal_rows(rows.join(kept, DIGEST, "left_semi")).select(*docs.columns)


@apart
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth lies in passages of benchmark items."""
    rows = digested(docs)
    found = contamination(rows, table(spark, sf_dir, "benchmark"), [DIGEST])
    bad = found.where(contaminated()).select(DIGEST).distinct()
    return rows.join(bad, DIGEST, "left_anti").select(*docs.columns)


@apart
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: its taken words over its words, rounded.

    Only the few documents that a source's last block cuts are taken in part, so sources stay within
    a document or two of their targets. Documents without words are not in the mix.
    """
    rows = digested(docs)
    _, taken = mix(rows, [DIGEST])
    copies = (
        taken.where("size > 0")
        .withColumn("copies", F.round(F.col("taken") / F.col("size")).cast("int"))
        .groupBy(DIGEST)
        .agg(F.sum("copies").alias("_copies"))
        .where("_copies > 0")
    )
    once = first_of_equal_rows(rows.join(copies, DIGEST))
    return once.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*docs.columns)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``shard`` and ``slot``; copies of a text stay in one shard."""
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    inside = [c if c in DOCUMENT else f"_further{i}" for i, c in enumerate(names)]
    placed = shard_documents(docs.select(*names).toDF(*inside), inside, shards=SHARDS)
    return placed.select(*inside, "shard", "slot").toDF(*names, "shard", "slot")


STAGES = [
    ("language_id", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", cut_shards),
]

#: Languages learned from text, SimHash links and their components are beyond SQL; tests/llm has a
#: brute-force version of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
