"""The registered queries over whole tables, against SQL or the plain versions."""

import base64
import hashlib

import brute
import duckdb
import pytest
from compare import oracle_rows, spark_rows
from conftest import SF_DIR

import corpus_pipeline
from rulespark.llm.oracles import ORACLES
from rulespark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents(database):
    return database.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


def test_names():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, database, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == oracle_rows(database, ORACLES[name])


def test_near_duplicates(spark, documents):
    found = {row.doc_id: (row.class_id, row.n_links) for row in QUERIES["op3_ngram_join"](spark, SF_DIR).collect()}
    expected = brute.near([row[:2] for row in documents])
    assert found == {row[0]: of for row, of in zip(documents, expected)}


def test_warc(spark, database):
    rows = QUERIES["op4_warc"](spark, SF_DIR).collect()
    pages, first = database.execute("SELECT page_id, coalesce(html, '') FROM pages ORDER BY page_id").fetchall(), {}
    expected = {}
    for page_id, html in pages:
        payload = html.encode()
        of = first.setdefault(payload, page_id)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        expected[page_id] = (len(payload), digest, "response" if of == page_id else "revisit", None if of == page_id else of)
    assert {row.page_id: tuple(row)[1:5] for row in rows} == expected
    assert len(rows) == len(pages) and all(row.intact for row in rows)


def test_surrogates(spark, documents):
    from rulespark.llm import pii

    texts, values, drawn = {doc_id: text for doc_id, text, _ in documents}, {}, {}
    rows = QUERIES["op6_pii"](spark, SF_DIR).collect()
    assert sorted(row.doc_id for row in rows) == sorted(texts)
    for row in rows:
        found = pii.entities(texts[row.doc_id] or "")
        assert row.n_entities == len(found) == len(row.entities)
        for entity, of in zip(found, row.entities):
            new = row.text[of.start : of.end]
            value = entity.kind, pii.normal(entity.kind, entity.value)
            assert of.kind == entity.kind and new != entity.value
            assert values.setdefault(value, pii.normal(entity.kind, new)) == pii.normal(entity.kind, new)
    for value, new in values.items():
        assert drawn.setdefault((value[0], new), value) == value and (value[0], new) not in values
    assert len(values) > 5


def test_token_counts(spark, documents):
    from rulespark.llm import queries, token_counts

    with open(queries.VOCABULARY, "rb") as file:
        encoding = token_counts._encoding(file.read(), token_counts.PATTERN)
    lengths = {}
    for _, text, source in documents:
        lengths.setdefault(source, []).append(len(encoding.encode_ordinary(text or "")))
    rows = QUERIES["op9_token_counts"](spark, SF_DIR).collect()
    assert len(rows) == sum(len(set(of)) for of in lengths.values())
    for row in rows:
        of = lengths[row.source]
        assert row.n_docs == of.count(row.n_tokens)
        assert row.docs_at_least == sum(length >= row.n_tokens for length in of)
        assert row.tokens_at_least == sum(length for length in of if length >= row.n_tokens)
        assert row.tokens_truncated == sum(min(length, row.n_tokens) for length in of)
        assert (row.docs_total, row.tokens_total) == (len(of), sum(of))
        assert row.share_fitting == sum(length <= row.n_tokens for length in of) / len(of)


def test_repeats(spark, documents):
    rows = {row.doc_id: tuple(row)[1:] for row in QUERIES["op10_suffix_dedup"](spark, SF_DIR).collect()}
    expected = brute.repeats([(text or "").encode() for _, text, _ in documents])
    assert rows == {doc[0]: (size, gone, spans, brute.sha(kept)) for doc, (size, gone, spans, kept) in zip(documents, expected)}


def test_pipeline(spark, database, documents):
    """Each stage by its plain version, over what the stages before have kept."""
    docs = []
    for doc_id, text, source in documents:
        words, chars, symbols, lines, dup_lines, repeated = brute.quality(text)
        if not (words < 10 or 100 * repeated > 20 * words or 100 * symbols > 10 * words or 100 * dup_lines > 50 * lines
                or chars > 25 * words or chars < 2 * words):
            docs.append((doc_id, text, source))
    docs = [(doc[0], kept, doc[2]) for doc, (_, _, kept) in zip(docs, brute.lines([doc[1] for doc in docs]))]
    docs = [doc for doc, (class_id, _) in zip(docs, brute.near([doc[:2] for doc in docs])) if class_id == doc[0]]
    items = database.execute("SELECT item_id, text FROM benchmark").fetchall()
    docs = [doc for doc in docs if not brute.contamination(doc[1], items)[1]]

    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns[:5] == spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    rows = sorted(rows.collect())
    assert [(row.doc_id, row.text, row.source) for row in rows] == docs
    assert all(row.n_chars == len(row.text) and row.mix_size == len(brute.WORD.findall(row.text)) for row in rows)
    taken = {}
    for row in rows:
        assert 0 <= row.mix_taken <= 3 * row.mix_size
        total = taken.setdefault(row.source, [0, row.mix_target])
        total[0] += row.mix_taken
    assert all(abs(total - target) <= 1 for total, target in taken.values())


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_duplicates", "decontamination", "mix"]
