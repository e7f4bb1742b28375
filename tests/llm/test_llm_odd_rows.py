"""Every operator over nulls, empty and long texts, repeated rows, empty tables and clashing names."""

import brute
import pytest
from compare import sorted_rows, spark_rows
from odd import no_documents, odd_documents, odd_rows  # noqa: F401

import corpus_pipeline
from rulespark.llm import (
    decontaminate, line_dedup, mixing, ngram_join, pii, quality, suffix_dedup, token_counts, url_filter, warc,
)
from rulespark.llm.queries import URL_RULES, VOCABULARY


def same_rows(df, columns, rows):
    assert spark_rows(df) == sorted_rows(columns, rows)


def test_quality(odd_documents, odd_rows, no_documents):
    columns = ["doc_id", *quality.MEASURES]
    same_rows(quality.ledger(odd_documents).drop("failed"), columns, [(row[0], *brute.quality(row[1]), brute.unspaced(row[1])) for row in odd_rows])
    kept = quality.kept_documents(odd_documents, quality.BASE)
    assert kept.columns == odd_documents.columns
    expected = []
    for doc_id, text, _ in odd_rows:
        n_words, _, _, _, _, repeated = brute.quality(text)
        expected += [(doc_id, text)] * (n_words >= 10 and 100 * repeated <= 20 * n_words)
    same_rows(kept.select("doc_id", "text"), ["doc_id", "text"], expected)
    assert quality.kept_documents(no_documents).count() == quality.ledger(no_documents).count() == 0


def test_scripts_without_spaces(spark):
    """Clean prose of such a script passes; long words of others don't, nor does a little of such a script save them."""
    japanese = "".join(f"吾輩は猫である、名前はまだ無い、どこで生れたか頓と見当がつかぬのである第{at}話。\n" for at in range(15))
    thai = "".join(f"ภาษาไทยเขียนติดกันโดยไม่เว้นวรรคระหว่างคำในประโยคเดียวกันทั้งหมด{at}\n" for at in range(12))
    planes = "".join("𠀋𡈽𡌛𡑮𡢽𠮟𡚴𡸴𣇄𣗄𣜿𣝣𣳾𤟱𥒎𥔎𥝱𥧄𥶡𦫿𦹀𧃴𧚄𨉷𨏍𪆐" + chr(0x4E00 + at) + "\n" for at in range(12))
    glued = "".join(f"averyveryverylongwordthatnobodywouldeverwrite{at}\n" for at in range(15))
    mixed = "".join(f"averyveryverylongwordthatnobodywouldeverwrite漢字{at}\n" for at in range(15))
    spaced = " ".join(f"plain{at}" for at in range(30)) + " 漢字"
    texts = [japanese, thai, planes, glued, mixed, spaced, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(row.doc_id for row in quality.kept_documents(docs).collect()) == [0, 1, 2, 5]
    found = {row.doc_id: row.n_unspaced for row in quality.measured(docs).collect()}
    assert found == {at: brute.unspaced(text) for at, text in enumerate(texts)}


def test_ablations(odd_documents):
    entries = quality.ledger(odd_documents)
    failed = [row.failed for row in entries.collect()]
    for row in quality.ablations(entries).collect():
        policy = {policy.version: policy for policy in (quality.BASE, quality.CURRENT)}[row.policy]
        mask = quality.mask(policy)
        bit = 1 << [rule.name for rule in quality.RULES].index(row.rule)
        assert row.docs == len(failed)
        assert row.passed == sum(bits & mask == 0 for bits in failed)
        assert row.failed_it == sum(bits & bit != 0 for bits in failed)
        assert row.failed_it_alone == sum(bits & mask == bit for bits in failed)
        assert row.passed_without_it == sum(bits & mask & ~bit == 0 for bits in failed)


def test_lines(spark, odd_documents, odd_rows, no_documents):
    index = line_dedup.built(odd_documents, min_docs=3)
    rows = line_dedup.without_frequent(odd_documents, index)
    expected = brute.lines([row[1] for row in odd_rows], 3)
    same_rows(rows, ["doc_id", "n_lines", "n_dropped", "kept"], [
        (row[0], lines, dropped, kept) for row, (lines, dropped, kept) in zip(odd_rows, expected)])
    assert line_dedup.deduplicated(odd_documents, index).columns == odd_documents.columns
    assert line_dedup.without_frequent(no_documents, line_dedup.built(no_documents)).count() == 0


def test_near_duplicates(odd_documents, odd_rows, no_documents):
    rows = ngram_join.memberships(ngram_join.joined(odd_documents))
    same_rows(rows, ["id", "class_id", "n_links"], [
        (row[0], class_id, links) for row, (class_id, links) in zip(odd_rows, brute.near([row[:2] for row in odd_rows]))])
    kept = ngram_join.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(row.doc_id or 0 for row in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 8, 9, 12, 14]
    assert ngram_join.memberships(ngram_join.joined(no_documents)).count() == ngram_join.one_of_each(no_documents).count() == 0


@pytest.mark.parametrize("pieces", [{}, {"FEW": 0, "MANY": 1}, {"BLOCK_BYTES": 64, "INDEX_BYTES": 256, "FEW": 1, "MANY": 2}])
def test_repeats(odd_documents, odd_rows, no_documents, monkeypatch, pieces):
    for name, value in pieces.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = suffix_dedup.without_repeats(odd_documents, carry=("doc_id",)).collect()
    texts = sorted(((row[0] is not None, row[0] or 0, (row[1] or "").encode()) for row in odd_rows))
    expected = brute.repeats([text for _, _, text in texts])
    found = sorted((row.doc_id is not None, row.doc_id or 0, row.n_bytes, row.n_removed, len(row.spans), bytes(row.kept)) for row in rows)
    assert found == sorted((*of[:2], *result) for of, result in zip(texts, expected))
    assert suffix_dedup.without_repeats(no_documents).count() == 0


def test_decontamination(spark, odd_documents, odd_rows, no_documents):
    items = [(1, "a passage of more than a hundred bytes that some of the texts"), (None, "null id"), (3, None), (4, ""),
             (5, "one two"), (6, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 not there"), (5, "one two")]
    benchmark = spark.createDataFrame([(*item, "x", "y") for item in items], "item_id long, text string, item string, body string")
    expected = [(row[0], *brute.contamination(row[1], items)) for row in odd_rows]
    for block_bytes in (1 << 20, 40):
        found = decontaminate.hits(decontaminate.scanned(odd_documents, benchmark, block_bytes=block_bytes))
        same_rows(found.select("doc_id", "n_words", "n_hit", "items"), ["doc_id", "n_words", "n_hit", "items"], expected)
    clean = decontaminate.clean_documents(odd_documents, benchmark)
    assert clean.columns == odd_documents.columns
    same_rows(clean.select("doc_id", "text"), ["doc_id", "text"], [row[:2] for row, of in zip(odd_rows, expected) if not of[2]])
    places = {row.doc_id: [row.body[of.start : of.end] for of in row.places] for row in decontaminate.located(
        decontaminate.scanned(odd_documents, benchmark)).collect() if row.doc_id}
    assert places[13] == ["One  TWO"] and places[9][0] == items[0][1]
    nothing = benchmark.limit(0)
    assert decontaminate.clean_documents(odd_documents, nothing).count() == len(odd_rows)
    assert decontaminate.clean_documents(no_documents, benchmark).count() == 0


def test_mixing(odd_documents, odd_rows, no_documents):
    rows = mixing.mixed(odd_documents)
    found = [tuple(row) for row in rows.select("row.doc_id", "source", "size", "source_size", "target", "taken").collect()]
    again = [tuple(row) for row in mixing.mixed(odd_documents.repartition(5)).select(
        "row.doc_id", "source", "size", "source_size", "target", "taken").collect()]
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert sorted(str((row[0], row[2])) for row in found) == sorted(str((row[0], len(brute.WORD.findall(row[1] or "")))) for row in odd_rows)
    total, taken = sum(row[2] for row in found), {}
    for _, source, size, source_size, target, took in found:
        assert 0 <= took <= 3 * size and target <= 3 * source_size
        taken.setdefault(source, [0, target])[0] += took
    assert all(abs(took - target) <= 1 for took, target in taken.values())
    assert sum(target for _, target in taken.values()) == pytest.approx(total)
    assert mixing.mixed(no_documents).count() == 0


def test_targets(spark):
    """What is above three times a source goes to the others by weight."""
    sizes = spark.createDataFrame([("a", 600), ("b", 10), ("c", 40), (None, 350)], "source string, source_size long")
    found = {row.source: row.target for row in mixing.targets(sizes).collect()}
    assert found == {"a": 425.0, "b": 30.0, "c": 120.0, None: 425.0}
    nothing = spark.createDataFrame([("a", 0), (None, 0)], "source string, source_size long")
    assert {row.target for row in mixing.targets(nothing).collect()} == {0.0}


def test_token_counts(spark, odd_documents, odd_rows, no_documents):
    length = token_counts.length_of(spark, VOCABULARY)
    counts = token_counts.histogram(odd_documents, length)
    sums = token_counts.answers(counts).cache()
    assert sum(row.n_docs for row in counts.collect()) == len(odd_rows)
    by_source = {}
    for row in counts.collect():
        by_source.setdefault(row.source, []).extend([row.n_tokens] * row.n_docs)
    for row in token_counts.truncated_totals(sums, [0, 1, 20, 10**9]).collect():
        of = by_source[row.source]
        assert (row.tokens_truncated, row.docs_cut) == (sum(min(n, row.limit) for n in of), sum(n > row.limit for n in of))
    for row in token_counts.quantiles(sums, [0.5, 1.0]).collect():
        of = sorted(by_source[row.source])
        assert row.n_tokens == next(n for n in of if sum(m <= n for m in of) >= row.share * len(of))
    assert token_counts.answers(token_counts.histogram(no_documents, length)).count() == 0


def test_surrogates(odd_documents, odd_rows, no_documents):
    rows = pii.replaced(odd_documents, b"k", carry=("doc_id", "kept_0"))
    same_rows(rows.select("doc_id", "text"), ["doc_id", "text"], [row[:2] for row in odd_rows])
    assert pii.replaced(no_documents, b"k").count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://NET/a", "http://net", "http://a.Example.NET/en/x?q#f", "http://example.net/en",
            "http://notexample.net/en/", "http://example.com/de/", "http://x.y.example.com/de/1#a?b", "http://example.com/fr/",
            "http://org/fr/1", "http://a.org?fr/", "ftp://b.org/fr/", "see http://c.net/://d", "http://" + "a." * 3000 + "net/" + "p" * 50_000,
            "http://a.net/1", "http://a.net/1", "http://ÄB.net/\n/x"]
    pages = spark.createDataFrame([(place % 15, url, "h", "p") for place, url in enumerate(urls)], "page_id long, url string, host string, path string")
    rules = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}

    def judged(url):
        rest = (url or "").partition("://")[2]
        host = rest
        for mark in "/?#":
            host = host.partition(mark)[0]
        path = rest[len(host) :].partition("?")[0].partition("#")[0]
        host = host.translate(brute.LOWER)
        fitting = [(len(h + p), h + p, action) for (h, p), action in rules.items()
                   if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, action = max(fitting, default=(0, None, "allow"))
        return host, path, rule, action

    found = url_filter.judge(pages, spark.sql(URL_RULES))
    same_rows(found, ["page_id", "host", "path", "rule", "verdict"], [(place % 15, *judged(url)) for place, url in enumerate(urls)])
    assert url_filter.judge(pages.limit(0), spark.sql(URL_RULES)).count() == 0
    assert {row.verdict for row in url_filter.judge(pages, spark.sql(URL_RULES).limit(0)).collect()} == {"allow"}


def test_nested_rules(spark):
    """The innermost open rule holds, also after a rule within it has closed."""
    rules = spark.createDataFrame(
        [("a.b", "/", "block"), ("a.b", "/x", "allow"), ("a.b", "/x/1", "block"), ("b", "/x/10/y", "allow"), ("a.b", "/x", "block")],
        url_filter.RULE_TYPES)
    urls = spark.createDataFrame([("http://c.a.b" + path,) for path in ("/", "/w", "/x", "/x/1", "/x/10/y", "/x/2", "/y", "/x/10/z")], "url string")
    found = {row.path: (row.rule, row.verdict) for row in url_filter.judge(urls, rules, carry=()).collect()}
    assert found == {"/": ("a.b/", "block"), "/w": ("a.b/", "block"), "/x": ("a.b/x", "block"), "/x/1": ("a.b/x/1", "block"),
                     "/x/10/y": ("b/x/10/y", "allow"), "/x/2": ("a.b/x", "block"), "/y": ("a.b/", "block"), "/x/10/z": ("a.b/x/1", "block")}


def test_warc(spark):
    html = [b"same".decode(), "same", None, "", "é" * 70_000, "same", "same", "short"]
    ids = [5, 3, 1, 2, 9, None, 3, None]
    pages = spark.createDataFrame([(i, f"http://x/{i}\r\n", h, "d") for i, h in zip(ids, html)], "page_id long, url string, html string, digest string")
    archives = warc.write(pages, archive_bytes=500)
    index = warc.index_of(spark, archives)
    records = warc.read(archives, index)
    found = sorted(tuple("-" if value is None else value for value in (row.page_id, row.payload_bytes, row.record_type, row.refers_to))
                   for row in warc.resolved(records).collect() if row.intact and row.page_id is not None)
    assert found == [(1, 0, "response", "-"), (2, 0, "revisit", 1), (3, 4, "response", "-"), (3, 4, "response", "-"),
                     (5, 4, "revisit", 3), (9, 140_000, "response", "-")]
    nulls = {(row.payload_bytes, row.record_type, row.refers_to) for row in warc.resolved(records).where("page_id IS NULL").collect()}
    assert nulls == {(4, "revisit", 3), (5, "response", None)}
    one = warc.read(archives, index.where("page_id = 9"), gap=0, most=1).first()
    assert bytes(one.payload).decode() == "é" * 70_000 and one.url == "http://x/9%0D%0A"
    small = warc.write(pages, min_bytes=5)
    assert {row.record_type for row in warc.index_of(spark, small).collect()} == {"response"}
    none = warc.write(pages.limit(0))
    assert warc.resolved(warc.read(none, warc.index_of(spark, none))).count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages(spark, odd_documents, no_documents, empty, tmp_path):
    benchmark = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = no_documents if empty else odd_documents
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, str(tmp_path))
        assert docs.columns[: len(before.columns)] == before.columns
    assert (docs.count() == 0) == empty
