"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  All but the
last return the columns of ``documents``; the last adds the token ids.  Only ``doc_id`` and
``text`` are needed; all other columns travel in one struct, so their names can be any.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import leaks, lines, pieces, quality, setjoin
from tidemark.session import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _packed(docs: DataFrame) -> DataFrame:
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", (F.struct(*rest) if rest else F.struct(F.lit(0).alias("none"))).alias("rest"))


def _unpacked(packed: DataFrame, like: DataFrame, **changed) -> DataFrame:
    """The columns of ``like`` in its order; ``changed`` ones by their expression."""
    return packed.select(*[
        (changed[c] if c in changed else F.col(c) if c in ("doc_id", "text") else F.col("rest").getField(c)).alias(c)
        for c in like.columns], *[e.alias(c) for c, e in changed.items() if c not in like.columns])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; labels come from the ``labels`` table.

    Null and empty texts are scored like others; repeated rows go or stay together.
    """
    forest = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return _unpacked(quality.score(_packed(docs), forest).where("predicted = 1"), docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks that stand in an earlier document are cut out; a document of which nothing is left goes.

    ``n_chars``, where there is such a column, follows the text where it was cut.
    """
    cut = F.size("removed_blocks") > 0
    done = lines.dedup_lines(_packed(docs)).where(~cut | (F.trim("text") != ""))
    if "n_chars" not in docs.columns:
        return _unpacked(done, docs)
    own = F.col("rest").getField("n_chars")
    return _unpacked(done, docs, n_chars=F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(own))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id.

    Rows alike are one document; texts that share an id are told apart; rows without id or words stay.
    """
    return _unpacked(setjoin.keep_one(_packed(docs)), docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the ``benchmark`` table.

    Null and empty texts hold none; repeated rows go or stay together.
    """
    return _unpacked(leaks.without_leaks(_packed(docs), _table(spark, sf_dir, "benchmark")), docs)


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with sampled ``piece_ids``, and ``lossless``: whether decoding them gives the text back.

    Columns of those two names are replaced.  Null text: null; empty text: no piece; repeated rows get equal ids.
    """
    done = pieces.encode_pieces(_packed(docs), check=True)
    return _unpacked(done, docs, piece_ids=F.col("piece_ids"), lossless=F.col("lossless"))


STAGES = [
    ("quality_classifier", good_quality),
    ("line_dedup", without_repeated_lines),
    ("ngram_jaccard_join", one_of_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("sentencepiece", as_pieces),
]

ORACLE_SQL = None       # trees, alignments and sampling are beyond SQL: the tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
