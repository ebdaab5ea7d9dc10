"""Registered queries against their SQL, and the pipeline's stages against their operators."""

import glob
import os

import duckdb
import pytest

import corpus_pipeline
from curbair.llm import jaccard, langid, mixture, pieces, queries, secrets

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="given tables absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    got = sorted((tuple(r) for r in df.select(columns).collect()), key=key)
    names = ", ".join(f'"{c}"' for c in columns)
    assert got == sorted(duck.execute(f"select {names} from ({queries.ORACLE[name]}) oracle").fetchall(), key=key)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (10**6 + 2, "!!! 12", "en", "s", 6)], docs.schema)
    docs = docs.unionByName(odd)
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "secret_scan", "target_mixture", "sentencepiece"]

    kept = corpus_pipeline.language(spark, docs, DATA)
    assert round(langid.least_score(4, corpus_pipeline.LEAST_EVIDENCE), 9) == 0.3
    known = langid.identify(docs, docs.filter(~langid.held_out())).filter("lang_pred != 'und' and score >= 0.3")
    assert kept.columns == docs.columns and ids(kept) == ids(known) and len(ids(kept)) >= 0.99 * (docs.count() - 3)

    single = corpus_pipeline.near_duplicates(spark, kept, DATA)
    near = jaccard.near_duplicates(kept)
    assert single.columns == docs.columns
    assert ids(single) == sorted(r.component_id for r in near.select("component_id").distinct().collect())

    clean = corpus_pipeline.secret_scan(spark, single, DATA)
    assert clean.columns == docs.columns and ids(clean) == ids(single)
    found = secrets.scan_secrets(single).filter("spans != ''")
    texts = {r.doc_id: r.text for r in single.collect()}
    after = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    touched = set(ids(found))
    assert touched and all((after[i][0] != t) == (i in touched) for i, t in texts.items())
    assert all(n == len(t) for t, n in after.values())

    mixed = corpus_pipeline.target_mixture(spark, clean, DATA)
    drawn = mixture.mix(clean, queries.margins(), queries.TEMPER).filter("kept")
    assert mixed.columns == docs.columns and ids(mixed) == ids(drawn)

    out = corpus_pipeline.sentencepiece(spark, mixed, DATA)
    again = pieces.piece_digests(mixed, queries.tokenizer_path("piece_bpe_32k.model"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect())) and all(r.round_trip for r in out.collect())


def test_run_on_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{DATA}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_even_guesses_are_rejected_by_score(spark):
    """Letters that every learned language has alike are no language; clean texts stay."""
    clean = [(i, f"{a} {i}", g, "s", 0) for i in range(80) for a, g in (
        ("the cat and the dog of it " * 12, "en"), ("der hund und die katze " * 12, "de"))]
    schema = spark.read.parquet(f"{DATA}/documents.parquet").schema
    docs = spark.createDataFrame([(10 * i + (g == "de"), t, g, s, n) for i, t, g, s, n in clean], schema)
    net = langid.fit(docs.filter(~langid.held_out()))
    mixed = [(9001, net_mix, None, "s", 0) for net_mix in _undecided(spark, net)]
    found = langid.predict(spark.createDataFrame(mixed, schema), net).first()
    least = langid.least_score(2, corpus_pipeline.LEAST_EVIDENCE)
    assert 0.5 < least < 0.54 and found.score < least
    ids = {r.doc_id for r in corpus_pipeline.language(spark, docs.unionByName(spark.createDataFrame(mixed, schema)), DATA).collect()}
    assert ids == {r.doc_id for r in docs.collect()}


def _undecided(spark, net):
    """The one of many mixtures of the two languages that the network is least sure of."""
    a, b = "the cat and the dog of it " * 60, "der hund und die katze " * 70
    texts = [a[:256 * k] + b[: 256 * (6 - k)] + a[:extra] for k in range(1, 6) for extra in range(0, 256, 8)]
    scored = langid.predict(spark.createDataFrame([(t,) for t in texts], "text string"), net)
    return [scored.orderBy("score").first().text]
