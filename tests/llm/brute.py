"""Plain versions of the operators, over Python lists."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    places = defaultdict(list)
    for at in range(len(words) - 4):
        places[tuple(words[at : at + 5])].append(at)
    covered = {word for found in places.values() if len(found) > 1 for at in found for word in range(at, at + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(char in "#*$%&|<>" for char in text), len(lines),
            len(lines) - len(set(lines)), len(covered))


UNSPACED = [(0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3000, 0x30FF), (0x3400, 0x4DBF),
            (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF00, 0xFFEF), (0x20000, 0x3FFFF)]


def unspaced(text):
    """Characters of scripts without spaces, where words are long."""
    words, chars, *_ = quality(text)
    found = sum(any(first <= ord(char) <= last for first, last in UNSPACED) for char in text or "")
    return found if chars > 25 * words else 0


def lines(texts, min_docs=10, min_chars=1):
    """Per text: lines, dropped lines, what is left."""
    def key(line):
        return line.strip(" \t\n\x0b\f\r").translate(LOWER)

    held = Counter(of for text in texts for of in {key(line) for line in (text or "").split("\n")})
    out = []
    for text in texts:
        all_lines = (text or "").split("\n")
        kept = [line for line in all_lines if len(key(line)) < min_chars or held[key(line)] < min_docs]
        out.append((len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return out


def shingles(text, size=5):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[at : at + size]) for at in range(len(words) - size + 1))


def near(rows, threshold=0.8):
    """Per (id, text), in order: the least id of its class, and its number of links."""
    sets = [shingles(text) for _, text in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(at):
        while parent[at] != at:
            at = parent[at]
        return at

    holders = defaultdict(set)
    for at, own in enumerate(sets):
        for shingle in own:
            holders[shingle].add(at)
    for pair in {pair for held in holders.values() for pair in combinations(sorted(held), 2)}:
        one, other = (sets[at] for at in pair)
        if len(one & other) >= threshold * len(one | other):
            for at in pair:
                links[at] += 1
            parent[max(map(root, pair))] = min(map(root, pair))
    least = {}
    for at, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(at)] = min(least.get(root(at), doc_id), doc_id)
    return [(least.get(root(at)), links[at]) for at in range(len(rows))]


def repeats(texts, length=100):
    """Per bytes, in order: bytes, removed bytes, spans, what is left."""
    seen, out = set(), []
    for text in texts:
        gone = bytearray(len(text))
        for at in range(len(text) - length + 1):
            window = text[at : at + length]
            if window in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(window)
        spans = sum(now and not before for now, before in zip(gone, b"\0" + gone))
        out.append((len(text), sum(gone), spans, bytes(byte for byte, cut in zip(text, gone) if not cut)))
    return out


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items, size=10):
    """Words, hit words and the items that occur."""
    words, hit, found = bench_words(text), set(), set()
    for item, item_text in items:
        of = bench_words(item_text)
        windows = {tuple(of[at : at + size]) for at in range(max(1, len(of) - size + 1))} if of else set()
        for window in windows:
            for at in range(len(words) - len(window) + 1):
                if tuple(words[at : at + len(window)]) == window:
                    hit.update(range(at, at + len(window)))
                    found.add("null" if item is None else str(item))
    return len(words), len(hit), sorted(found)


def search(docs, items, top=50):
    """Per item id its (rank, doc id, score), of (doc id, text) and (item id, text)."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    bags = [(doc_id, Counter(term.findall((text or "").translate(LOWER)))) for doc_id, text in docs]
    sizes = [sum(bag.values()) for _, bag in bags]
    n_docs, n_terms, asked = sum(size > 0 for size in sizes), sum(sizes), {}
    for item, text in items:
        asked.setdefault(item, set()).update(term.findall((text or "").translate(LOWER)))
    out = []
    for item, terms in asked.items():
        found = []
        for (doc_id, bag), size in zip(bags, sizes):
            norm = 50 + (50 * size * n_docs) // n_terms if n_terms else 50
            score = 0
            for one in terms & set(bag):
                holding = sum(one in other for _, other in bags)
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))
                score += weight * ((1000000000 * bag[one]) // (1000 * bag[one] + 20 * norm))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(found)[:top], 1):
            out.append((item, rank, None if null else doc_id, -score))
    return out


def alignment(texts, encode_a, encode_b, bytes_a, bytes_b):
    """Per text: tokens of either, groups, links, best links, sum of counts, groups as text."""
    found, counts = [], Counter()
    for text in texts:
        a, b = (encode_a(" " + text), encode_b(text)) if text else ([], [])
        body = b" " + (text or "").encode()
        if not text or b"".join(bytes_a[one] for one in a) != body or b"".join(bytes_b[one] for one in b) != body:
            found.append(([], [], [], []))
            continue
        spans = []
        for ids, of in ((a, bytes_a), (b, bytes_b)):
            at, own = 0, []
            for one in ids:
                own.append((at, at + len(of[one]), one))
                at += len(of[one])
            spans.append(own)
        links, begin = [], 0
        for first, last, one in spans[0]:
            while spans[1][begin][1] <= first:
                begin += 1
            place = begin
            while place < len(spans[1]) and spans[1][place][0] < last:
                links.append((one, spans[1][place][2]))
                place += 1
        cuts = sorted({last for _, last, _ in spans[0]} & {last for _, last, _ in spans[1]})
        groups, places = [], [0, 0]
        for cut in cuts:
            sides = []
            for side, own in enumerate(spans):
                begin = places[side]
                while places[side] < len(own) and own[places[side]][1] <= cut:
                    places[side] += 1
                sides.append(",".join(str(one) for _, _, one in own[begin : places[side]]))
            groups.append("|".join(sides))
        found.append((a, b, groups, links))
        counts.update(links)
    most = {}
    for (_, other), n in counts.items():
        most[other] = max(most.get(other, 0), n)
    return [(len(a), len(b), len(groups), len(links), sum(counts[link] == most[link[1]] for link in links),
             sum(counts[link] for link in links), sha(";".join(groups)) if a else "") for a, b, groups, links in found]
