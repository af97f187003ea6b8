"""From raw documents to clean, distinct texts that a tokenizer's ids give back.

Five stages, each over all that the one before kept: texts predicted toxic go;
of each group of near duplicates the text of smallest id stays; passages that
occur earlier in the corpus are cut out; texts that hold a benchmark item go;
each text is encoded and decoded. ``run`` writes every stage to the shared
folder and reads it again.
"""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweft.llm import decontaminate, forced_bpe, jaccard, substrings, toxicity
from loanweft.llm.common import materialize, over_batches, pick, raw, table

COLUMNS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in COLUMNS.items())
WORDS, PERCENT = 5, 80  # near duplicates: shingles of five words, similarity of 0.8
TOGETHER = 0.5  # MB of text worked on at once: its arrays are many times that, in each of an executor's workers


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are not predicted toxic, by a model fitted on the labelled rows among them."""
    docs = pick(docs, **COLUMNS)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    tables = model.tables()

    def keep(piece: pa.RecordBatch) -> pa.RecordBatch:
        return piece.filter(pa.array(model.score(*raw(piece.column(1)), tables) < 0.5))

    return over_batches(docs, keep, SCHEMA, TOGETHER)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates one row, that of smallest id; rows without id go before those with one.

    Every row is judged by its own text, also where ids repeat or are missing.
    """
    rows = substrings.numbered(docs, **{name: kind for name, kind in COLUMNS.items() if name not in ("doc_id", "text")})
    found = jaccard.row_components(rows, WORDS, PERCENT)
    several = found.groupBy("component").agg(F.count("*").alias("n"), F.min_by("doc", F.struct(F.col("doc_id").isNull(), "doc")).alias("kept")).filter("n > 1")
    gone = found.join(several.select("component", "kept"), "component").filter("doc <> kept").select(F.col("doc").alias("row"))
    renamed = rows.withColumnsRenamed({"doc_id": "id", "doc": "doc_id"})
    return jaccard.with_ids(renamed, gone.withColumnRenamed("row", "doc_id"), "left_anti").drop("doc_id").withColumnRenamed("id", "doc_id").select(*COLUMNS)


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the stretches of 100 bytes that start earlier; n_chars is counted anew.

    A character that a cut would divide goes as a whole. Documents of which
    nothing is left go; those that were empty stay.
    """
    numbered = substrings.numbered(docs, **{name: kind for name, kind in COLUMNS.items() if name not in ("doc_id", "text")})
    cut = substrings.spans(numbered)
    joined = substrings.join_by_key(numbered, cut, "left").select(*COLUMNS, "runs")

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts, sizes, stays = [], [], []
        for text, runs, size in zip(piece.column(1).to_pylist(), piece.column(5).to_pylist(), piece.column(4).to_pylist()):
            if runs:
                content, edges = text.encode(), [0, *runs]
                text = "".join(content[a:b].decode("utf-8", "ignore") for a, b in zip(edges[::2], [*edges[1::2], len(content)]))
                size = len(text)
            texts.append(text)
            sizes.append(size)
            stays.append(not runs or bool(text))
        made = pa.RecordBatch.from_arrays([piece.column(0), pa.array(texts, pa.string()), piece.column(2), piece.column(3), pa.array(sizes, pa.int64())],
                                          names=list(COLUMNS))
        return made.filter(pa.array(stays, pa.bool_()))

    return over_batches(joined, run, SCHEMA, TOGETHER)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in whose text no benchmark item occurs, edits of up to a fifth of the item included; other rows of the same id, or without one, stay."""
    return decontaminate.without_items(pick(docs, **COLUMNS), table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the text, their number, and the text that they give."""
    encoded = forced_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return encoded.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), F.col("decoded").alias("text"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("suffix-array dedup", repeated_passage_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding and decoding", encoding_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{number}")
    return docs
