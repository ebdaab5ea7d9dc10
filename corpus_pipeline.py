"""A corpus pipeline of five stages over ``documents``.

Each stage takes what its predecessor kept, as a table written and read again. All but
the last return the columns of documents; the last returns the ids' digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbair.llm import jaccard, langid, mixture, pieces, queries, secrets
from curbair.llm.common import fresh
from curbair.session import pin_session
from curbair.sources.staging import staged

#: How far above an even guess a mean probability must lie for its language to count as
#: recognised: with four languages 0.3, with two 0.53, with a hundred 0.08.
LEAST_EVIDENCE = 1 / 15


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the network recognises; ``und`` and guesses go.

    A text that is NULL, empty or without a letter is ``und`` and goes. Very long texts are
    read whole, repeated rows are judged alike, an empty table stays empty; extra columns
    stay, whatever their names.
    """
    lang, score = fresh(docs, "__lang_pred"), fresh(docs, "__score")
    net = langid.fit(docs.filter(~langid.held_out()))
    found = langid.predict(docs, net, lang_out=lang, score_out=score)
    least = langid.least_score(len(net.langs) if net else 1, LEAST_EVIDENCE)
    kept = (F.col(lang) != langid.UNDETERMINED) & (F.col(score) >= least)
    return found.filter(kept).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Documents without words (NULL, empty, blanks) all stay, as they are alike with nothing.
    Of repeated rows one stays; rows that share an id but not a text are judged by their
    texts, and a NULL id leads a group only if no member has one.
    """
    return jaccard.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in them replaced; ``n_chars`` follows the text.

    A NULL text stays NULL with its ``n_chars``, an empty one empty; repeated rows change
    alike.
    """
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(docs.columns)


def target_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn towards tempered shares of source, language and topic.

    A NULL source or language is a value of its own. Texts that are NULL or without words
    weigh nothing and stay; rows with equal ids are drawn alike.
    """
    return mixture.mix(docs, queries.margins(), queries.TEMPER).filter("kept").select(docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of what is left: per document n_tokens, ids_crc32 and round_trip.

    A NULL or empty text has no ids; repeated rows give repeated results.
    """
    return pieces.piece_digests(docs, queries.tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("target_mixture", target_mixture),
    ("sentencepiece", sentencepiece),
]

#: A trained network, the test battery and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pin_session(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = staged(docs, name)
    return docs
