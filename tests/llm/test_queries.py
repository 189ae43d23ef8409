"""The registered queries: against DuckDB, or against brute force on the small tables."""

import pyarrow.parquet as pq
import pytest

import brute
from oracle import compare, duck_connection

from cardwatch.llm import lm, queries

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()
    return list(zip(t["doc_id"], t["text"]))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, name):
    ok, message = compare(spark, name, SF_SMALL, queries.QUERIES, queries.ORACLE, duck_connection(SF_SMALL))
    assert ok, message


def test_every_operator_has_a_query():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


def test_near_duplicates(spark, documents):
    got = sorted(tuple(r) for r in queries.op3_neardup(spark, SF_SMALL).collect())
    assert got == sorted(brute.near_duplicates(documents))


def test_language_model(spark, documents):
    got = {r[0]: tuple(r) for r in queries.op7_lm(spark, SF_SMALL).collect()}
    for row in brute.language_model(documents, lm.MU):
        assert got[row[0]][:5] == row[:5]
        assert got[row[0]][5:] == pytest.approx(row[5:], rel=1e-9)
    assert len(got) == len(documents)


def test_fingerprints(spark, documents):
    got = queries.op5_fingerprints(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(brute.edited(documents))
    prints = {}
    texts = dict(documents)
    for r in got:
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    long_ = [r for r in got if len(brute.words(texts[r.doc_id])) > 60]
    assert sum(r.near_edited > r.near_next for r in long_) >= 0.95 * len(long_)


def test_toxicity(spark):
    got = queries.op4_toxicity(spark, SF_SMALL.replace("0.001", "0.01")).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    labels = pq.read_table(f"{SF_SMALL.replace('0.001', '0.01')}/labels.parquet").to_pydict()
    toxic = dict(zip(labels["doc_id"], labels["toxic"]))
    known = [(r.score, toxic[r.doc_id]) for r in got if r.doc_id in toxic]
    pairs = [(a > b) + 0.5 * (a == b) for a, x in known if x for b, y in known if not y]
    assert sum(pairs) / len(pairs) > 0.85  # 36 toxic texts in all, a fifth of them held out


def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near-duplicates", "decontamination", "personal data", "mixing"]
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _, _, k in brute.near_duplicates(rows) if k)
    items = pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pydict()
    clean = corpus_pipeline.drop_contaminated(spark, docs, SF_SMALL)
    want = brute.decontaminate(rows, list(zip(items["item_id"], items["text"])))
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == sorted(x[0] for x in want if not x[5])
    private = corpus_pipeline.replace_personal_data(spark, docs, SF_SMALL)
    assert private.columns == docs.columns and private.count() == len(rows)
    out = queries.pipeline(spark, SF_SMALL).collect()
    assert 0 < len(out) < len(rows) and all(0 < r.taken <= 3 * r.size for r in out)
    for r in out:  # the text that the mix takes is in the result
        assert r.copies * r.size + len(brute.words(r.part)) == r.taken and len(brute.words(r.text)) == r.size


ODD_TABLES = {
    "odd": [(1, None, "en", "a", 0), (2, "", None, "b", 0), (3, " \n", "en", None, 2), (None, "some words here", "en", "a", 15), (None, None, None, None, None),
            (4, "same words in rows that repeat", "en", "a", 30), (4, "same words in rows that repeat", "en", "a", 30), (5, "mail jane@site.org now", "en", "a", 22), (6, "w " * 30_000, "en", "b", 60_000)],
    "empty": []}


@pytest.mark.parametrize("kind", sorted(ODD_TABLES))
def test_pipeline_on_odd_tables(spark, kind, tmp_path):
    """Nulls, empty and long texts, repeated rows and an extra column of an inner name; and no rows at all."""
    import corpus_pipeline
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(*r, "x") for r in ODD_TABLES[kind]], schema + ", taken string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{SF_SMALL}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns[:6] == docs.columns and set(out.columns) >= {"size", "copies", "part"}
    rows = {r.doc_id: r for r in out.collect()}
    if kind == "empty":
        assert not rows
    else:
        assert 4 in rows and not {1, 2, 3} & set(rows) and (5 not in rows or "jane@site.org" not in rows[5].text)
        assert all(r.copies * r.size + len(brute.words(r.part)) == r.taken for r in rows.values())
