"""Pieces of the operators that their results don't show."""

import gzip
import random

import numpy as np
import pytest

from rulespark.llm import decontaminate, line_dedup, ngram_join, passages, pii, shingles, warc
from rulespark.llm.cuckoo import CuckooFilter
from rulespark.llm.run_index import RunIndex
from rulespark.llm.components import components


def test_cuckoo_filter():
    numbers = np.random.default_rng(1)
    high, low = (numbers.integers(0, 1 << 63, 5000).astype("u8") for _ in range(2))
    held = CuckooFilter()
    held.insert(high[:10], low[:10])
    held.insert(high[10:4000], low[10:4000])  # beyond its first table
    held = CuckooFilter.loads(held.dumps())
    assert held.contains(high[:4000], low[:4000]).all() and held.contains(high[4000:], low[4000:]).mean() < 0.02
    held.remove(high[:2000], low[:2000])
    assert held.contains(high[2000:4000], low[2000:4000]).all() and held.contains(high[:2000], low[:2000]).mean() < 0.02
    assert not CuckooFilter.loads(b"").contains(high[:3], low[:3]).any()


def counts_of(spark, index):
    return {(row.high, row.low): row.docs for row in spark.read.parquet(index.counts).where("docs > 0").collect()}


def let_through(spark, index):
    keys = [(row.high, row.low) for row in spark.read.parquet(index.counts).collect()]
    out = set()
    for row in spark.read.parquet(index.filters).collect():
        held = CuckooFilter.loads(bytes(row.filter))
        own = [key for key in keys if key[1] % index.shards == row.shard]
        high, low = (np.array([key[place] for key in own], "i8").astype("u8") for place in (0, 1))
        out |= {key for key, yes in zip(own, held.contains(high, low)) if yes}
    return out


def test_lines_are_reversible(spark):
    """Adding and removing documents leads to the index of those that are left."""
    def docs(*texts):
        return spark.createDataFrame([(at, text) for at, text in enumerate(texts)], "doc_id long, text string")

    first, more = docs("a\nb", "a\nc", "b"), docs("a\nb\nd", "c", "B ")
    index = line_dedup.built(first, min_docs=2)
    before = counts_of(spark, index), let_through(spark, index)
    both = line_dedup.changed(index, more)
    whole = line_dedup.built(first.union(more), min_docs=2)
    assert counts_of(spark, both) == counts_of(spark, whole) and let_through(spark, both) == let_through(spark, whole)
    assert len(let_through(spark, both)) == 3 and len(before[1]) == 2
    back = line_dedup.changed(both, more, -1)
    assert (counts_of(spark, back), let_through(spark, back)) == before


def test_shingles_do_not_depend_on_the_batch():
    texts = [b"a b c d e f", b"", b"a b c d", b"A  b\nc D e\tf", b"x\0 y", b"x y", ("é " * 50).encode()] * 3
    whole, one_by_one = shingles.shingle_sets(texts), [shingles.shingle_sets([text])[0] for text in texts]
    assert [list(of) for of in whole] == [list(of) for of in one_by_one]
    assert [len(of) for of in whole[:7]] == [2, 0, 1, 2, 1, 1, 1]
    assert list(whole[0]) == list(whole[3]) and list(whole[4]) != list(whole[5])


def test_forest_recall():
    """Pairs at the threshold agree on a prefix as often as expected, distant ones hardly ever."""
    numbers, found = np.random.default_rng(3), {0.8: 0, 0.3: 0}
    depth = ngram_join.prefix_depth()
    assert ngram_join.expected_recall(depth) >= ngram_join.TARGET_RECALL > ngram_join.expected_recall(depth + 1)
    for _ in range(200):
        for share in found:
            pool = shingles.mixed(numbers.integers(0, 1 << 62, 1000).astype("u8"))
            common = round(1000 * share)
            sets = pool[:common + (1000 - common) // 2], np.concatenate((pool[:common], pool[common + (1000 - common) // 2:]))
            labels = [shingles.prefix_hashes(shingles.min_hashes(of, ngram_join.TREES * depth), ngram_join.TREES, depth) for of in sets]
            found[share] += (labels[0] == labels[1]).any()
    assert found[0.8] >= 195 and found[0.3] <= 5


def test_near_copies_in_blocks(spark, monkeypatch):
    """A group compared in several blocks has the links of one compared at once."""
    import brute

    draw = random.Random(5)
    words = [f"w{at}" for at in range(100)]
    rows = []
    for doc_id in range(60):
        own = list(words)
        for _ in range(draw.randint(0, 3)):
            own[draw.randrange(100)] = f"x{draw.randrange(1000)}"
        rows.append((doc_id, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    found = {row.id: (row.class_id, row.n_links) for row in ngram_join.memberships(ngram_join.joined(docs)).collect()}
    assert found == dict(zip(range(60), brute.near(rows)))


def test_components(spark):
    draw = random.Random(2)
    chain = [(at, at + 1) for at in range(100, 140)]
    edges = chain + [(draw.randrange(60), draw.randrange(60)) for _ in range(40)] + [(7, 7), (100, 101)]
    parent = {node: node for edge in edges for node in edge}

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    found = {row.node: row.label for row in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert found == {node: root(node) for node in parent if root(node) != node}


@pytest.mark.parametrize("length", [40, 100])
def test_run_index(length):
    draw = random.Random(4)
    base = bytes(draw.choice(b"ab") for _ in range(400))
    texts = [base[at : at + draw.randint(0, 160)] for at in (draw.randrange(300) for _ in range(40))] + [b"a" * 150, b"", b"a" * 120]
    index = RunIndex(np.frombuffer(b"".join(texts), np.uint8), [len(text) for text in texts], length)
    seen, expected = set(), []
    for text in texts:
        for at in range(len(text) - length + 1):
            expected.append(text[at : at + length] in seen)
            seen.add(text[at : at + length])
    assert index.matches().tolist() == expected
    assert len(index.heads) < sum(map(len, texts)) / 3  # runs, of texts that repeat each other
    # each sample is the place of its run's last row: the byte before it is the run's
    joined = b"".join(text + b"\0" for text in texts)
    assert all((joined[place - 1] + 1 if joined[place - 1] else 0) == head for place, head in zip(index.samples, index.heads))


def test_runs_cover_each_window_once():
    draw = random.Random(6)
    texts = [bytes(draw.choice(b"abcdefgh ") for _ in range(size)) for size in (0, 99, 100, 101, 70_000, 5, 400)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(text) for text in texts])
    runs = passages.runs_of(data, passages.window_starts(sizes, 100), 100)
    starts = np.concatenate([np.arange(first, first + count) for first, count in zip(runs.first, runs.count)])
    ends = np.cumsum(sizes)
    assert starts.tolist() == [at for begin, end in zip(ends - sizes, ends) for at in range(begin, end - 99)]
    twice = np.concatenate((data, data))
    again = passages.runs_of(twice, passages.window_starts(np.concatenate((sizes, sizes)), 100), 100)
    assert set(runs.anchor.tolist()) == set(again.anchor.tolist())


def test_surrogate_formats():
    text = ("Mr. John Smith and Mrs. Smith wrote to J.Smith@mail.example.com, called +1 (643) 555-5742 from 10.1.2.3, "
            "paid with 4111 1111 1111 1111; token = \"0123456789abcdef0123\"; Госпожа Иванова; version 1.2.3.4.5, 300.1.1.1")
    found = pii.entities(text)
    assert [(of.kind, of.value) for of in found] == [
        ("first_m", "John"), ("family", "Smith"), ("family", "Smith"), ("mail", "J.Smith@mail.example.com"), ("phone", "+1 (643) 555-5742"),
        ("ip", "10.1.2.3"), ("card", "4111 1111 1111 1111"), ("secret", "0123456789abcdef0123"), ("family", "Иванова")]
    new = [pii.fitted(of.kind, pii.surrogate(b"key", of.kind, pii.normal(of.kind, of.value)), of.value) for of in found]
    assert new[1] == new[2] != "Smith" and new[0].istitle() and new[3].endswith(".example.com") and new[3][1] == "."
    assert new[4][:4] == "+1 (" and len(new[4]) == 17 and new[5].startswith("10.") and new[8][0] > "Ѐ"
    assert pii._luhn(new[6].replace(" ", "")) and new[6][4] == " " and len(new[7]) == 20
    assert new != [pii.fitted(of.kind, pii.surrogate(b"other", of.kind, pii.normal(of.kind, of.value)), of.value) for of in found]


def test_surrogates_stay_distinct(spark):
    """More values of a short format than one draw keeps apart, one of them another's surrogate."""
    values = [f"{chr(97 + at)}@{chr(97 + at % 5)}.example.org" for at in range(26)]
    values.append(pii.surrogate(b"k", "mail", values[0]))
    rows = [(at % 7, f"to {value} and {values[0]}, too") for at, value in enumerate(values)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    drawn = {row.value: row.draw for row in pii.draws(docs, b"k").collect()}
    assert sorted(drawn) == sorted(values) and max(drawn.values()) > 0
    new = {value: pii.surrogate(b"k", "mail", value, draw) for value, draw in drawn.items()}
    assert len(set(new.values())) == len(values) and not set(new.values()) & set(values)
    texts = sorted(row.text for row in pii.replaced(docs, b"k").collect())
    assert texts == sorted(f"to {new[value]} and {new[values[0]]}, too" for value in values)


def test_warc_record():
    data = warc.record(7, "http://x/", b"<p>\r\n\r\n</p>", None)
    headers, payload = warc.parsed(data)
    assert payload == b"<p>\r\n\r\n</p>" and headers["WARC-Type"] == "response" and data.endswith(b"\r\n\r\n")
    headers, payload = warc.parsed(gzip.decompress(gzip.compress(warc.record(8, None, b"<p>\r\n\r\n</p>", 7))))
    assert payload == b"" and headers["WARC-Refers-To"] == warc.record_id(7, warc.payload_digest(b"<p>\r\n\r\n</p>"))
    assert warc.near_ranges([(0, 10), (10, 5), (40, 5), (200, 1)], 30, 60) == [[0, 45, [0, 1, 2]], [200, 201, [3]]]
    assert warc.near_ranges([(0, 10), (10, 5)], 30, 12) == [[0, 10, [0]], [10, 15, [1]]]


def test_merged_and_original_spans():
    assert decontaminate.merged([(5, 6), (0, 2), (3, 3), (8, 9)]) == [[0, 3], [5, 6], [8, 9]]
    assert decontaminate.original_spans("é, Àb cd", [(0, 1), (2, 2)]) == [(0, 5), (6, 8)]
