"""Alignment of two tokenizers, with a fast path for tokens that both have.

Texts are encoded by both. Where a token of A and a token of B end at the same byte, the
text is cut: the tokens between two cuts are a group. Both end with each word, so a text's
groups and links are those of its words, and tasks remember these by word.

Most links, pairs of tokens whose bytes overlap, are between ids with the same bytes; which
id of B that is for an id of A, is an array that is worked out once from the two
vocabularies. Tasks count such links in a vector as long as A's vocabulary. Only the others
go through the shuffle as pairs, each once per task with its count.

What follows from the counts is looked up the same way. For links of the fast path: two
arrays of the length of A's vocabulary. For other pairs: the most frequent ``HOT`` of them
are an array that every task gets, the rest are joined, and none of those is so frequent
that it weighs in a join. So documents are read twice, encoded once, and most of their links
never shuffled.

Null and empty texts have no tokens, nor have those that an encoder can't give back byte by
byte, such as a text with characters outside its vocabulary: all numbers are zero. Rows are
told apart by their place, not by their id: null and repeated ids are rows of their own.
"""

import hashlib
import re
from array import array
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from ..session import written
from . import frequent

#: Pairs that every task holds, of 24 bytes each.
HOT = 1 << 17
#: Distinct pairs, or entries, that a task holds before it hands them on.
HELD = 1 << 20

#: Texts of letters up to here are encoded piece by piece; those with others as a whole.
LAST_LETTER = 0x36F
_OTHER_LETTERS = re.compile(f"[^\\x00-{chr(LAST_LETTER)}]")
#: Words whose groups and links a task remembers, and the longest of them.
_REMEMBERED, _SHORT = 1 << 18, 64


def _class_of(kind):
    """The letters up to the last one that Unicode puts in a class, for a pattern's brackets."""
    return "".join(re.escape(chr(code)) for code in range(LAST_LETTER + 1) if regex.match(kind, chr(code)))


_LETTER, _NUMBER, _SPACE = (_class_of(kind) for kind in (r"\p{L}", r"\p{N}", r"\s"))
_SIGN = f"^{_SPACE}{_LETTER}"

#: How the byte-level vocabulary splits texts into pieces, for letters up to the last one.
#: The contractions, and the order of runs of letters, of numbers, of others, of
#: white space. Letters come first here; no other kind of piece begins as they do.
_PIECES = re.compile(f" ?[{_LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_NUMBER}]+| ?[{_SIGN}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: A text in words: all white space before a run of letters or of signs, and the run. Signs with
#: a ' or before a carriage return keep what follows up to a space after other than white space:
#: one encoder makes contractions, the other has pieces of signs and carriage returns.
_WORDS = re.compile(
    f"[{_SPACE}]*(?:[{_LETTER}]+|[{_SIGN}']++(?!['\\r])|[{_SIGN}]+[^ ]*(?:(?<=[{_SPACE}]) +[^ ]*)*)|[{_SPACE}]+")
#: What a piece has that goes on from one word into the next, other than white space at its start.
_WORD_END = re.compile(f"▁|[{_LETTER}][^{_LETTER}]|[{_SIGN}](?!\\r)[{_SPACE}{_LETTER}]")


@dataclass(frozen=True)
class Coder:
    """An encoder and the bytes of each of its ids. ``prefix`` goes before a text that it gets.

    ``make`` runs in tasks, once per process, on ``state``; it returns an ``_Encoder``.
    """

    name: str
    state: bytes
    make: Callable
    pieces: Sequence
    prefix: str = ""


class _Encoder:
    """Ids of whole texts, and of lists of words where these have the same ids in every text."""

    def __init__(self, whole, of_words=None):
        self.whole, self.of_words = whole, of_words


def _byte_level(state):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(state.decode())
    tokenizer.encode_special_tokens = True
    letters = str.maketrans({byte: letter for letter, byte in _byte_of_letters().items()})
    model = tokenizer.model

    def whole(text):
        return tokenizer.encode(text, add_special_tokens=False).ids

    def of_word(word):  # merges stay within pieces, and pieces within words
        pieces = (piece.encode().decode("latin-1").translate(letters) for piece in _PIECES.findall(word))
        return [token.id for piece in pieces for token in model.tokenize(piece)]

    def of_words(words):
        return list(map(of_word, words))

    return _Encoder(whole, of_words)


def _byte_of_letters():
    """The letters by which byte-level vocabularies write bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + place): byte for place, byte in enumerate(others)}


def byte_level_coder(path, prefix=" ") -> Coder:
    """From a ``tokenizers`` file of a byte-level vocabulary, read by the driver."""
    from tokenizers import Tokenizer

    with open(path, "rb") as file:
        state = file.read()
    tokenizer, letters = Tokenizer.from_str(state.decode()), _byte_of_letters()
    special = tokenizer.get_added_tokens_decoder()
    pieces = []
    for number in range(tokenizer.get_vocab_size()):
        token = tokenizer.id_to_token(number) or ""
        pieces.append(token.encode() if number in special else bytes(letters[letter] for letter in token))
    return Coder(path, state, _byte_level, pieces, prefix)


def _pieced(state):
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_proto=state)
    space, line_end = processor.piece_to_id("▁"), processor.encode("\n")

    def whole(text):
        return processor.encode(text, num_threads=1)

    def of_words(words):  # the encoder puts a space before each; a line's end parts it from words that have none
        found = processor.encode([word[1:] if word[0] == " " else f"\n{word}" for word in words], num_threads=1)
        return [(ids or [space]) if word[0] == " " else ids[2:] for word, ids in zip(words, found)]

    letters = "".join(map(chr, range(0x21, LAST_LETTER + 1)))
    as_they_are = processor.normalize(f"{letters}  a") == f"▁{letters}▁▁a"
    # no piece goes on after a word, letters stay as they are, and so does a line's end
    alone = as_they_are and not any(map(_over_words, _text_pieces(processor)))
    alone = alone and space != processor.unk_id() and len(line_end) == 2 and line_end[0] == space
    return _Encoder(whole, of_words if alone else None)


def _text_pieces(processor):
    """The pieces that stand for their own characters."""
    apart = (processor.is_control, processor.is_unknown, processor.is_byte)
    return [processor.id_to_piece(number) for number in range(processor.get_piece_size()) if not any(kind(number) for kind in apart)]


def _over_words(piece):
    """Whether a piece may go on from one word into the next, or joins a line's end to others."""
    run = piece.lstrip("▁")
    if "▁" not in run and _OTHER_LETTERS.search(run):  # not in a text that is encoded by words
        return False
    return bool(_WORD_END.search(run)) or ("\n" in piece and len(piece) > 1)


def piece_coder(path) -> Coder:
    """From a ``sentencepiece`` model, read by the driver. It puts the space before a text itself."""
    from sentencepiece import SentencePieceProcessor

    with open(path, "rb") as file:
        state = file.read()
    processor = SentencePieceProcessor(model_proto=state)
    pieces = []
    for number in range(processor.get_piece_size()):
        piece = processor.id_to_piece(number)
        if processor.is_byte(number):
            pieces.append(bytes([int(piece[3:5], 16)]))
        elif processor.is_control(number) or processor.is_unknown(number):
            pieces.append(b"")
        else:
            pieces.append(piece.replace("▁", " ").encode())
    return Coder(path, state, _pieced, pieces)


def identity(a: Coder, b: Coder):
    """For each id of A the id of B with the same bytes, or -1; the highest where there are several.

    A byte and a piece of one character may share their bytes. Ids of pieces come later, and
    encoders take a piece where they have one.
    """
    held = {piece: number for number, piece in enumerate(b.pieces) if piece}
    return np.array([held.get(piece, -1) for piece in a.pieces], np.int64)


_MADE = {}


def _made(coder):
    """The encoder of a process; tasks that follow use it again."""
    key = hashlib.sha256(coder.state).digest()
    if key not in _MADE:
        _MADE[key] = coder.make(coder.state)
    return _MADE[key]


class _Aligner:
    def __init__(self, a, b):
        self.a, self.b = a, b
        self.encoder_a, self.encoder_b = _made(a), _made(b)
        self.by_words = self.encoder_a.of_words and self.encoder_b.of_words and a.prefix + b.prefix == " "
        self.same = identity(a, b)
        self.same_of = self.same.tolist()
        self.remembered = _MADE.setdefault((id(self.encoder_a), id(self.encoder_b)), {})

    def _part(self, a, b, body):
        """Tokens of either, groups as text, and links of a text or word, or None if either does not give it back."""
        body = body.encode()
        pieces_a, pieces_b = list(map(self.a.pieces.__getitem__, a)), list(map(self.b.pieces.__getitem__, b))
        if not b"".join(pieces_a) == body == b"".join(pieces_b):
            return None
        size_b = len(self.b.pieces)
        if pieces_a == pieces_b:
            return len(a), len(b), ";".join(map("%d|%d".__mod__, zip(a, b))), array("q", [one * size_b + other for one, other in zip(a, b)]).tobytes()
        groups, links = _walked(a, list(map(len, pieces_a)), b, list(map(len, pieces_b)), size_b)
        return len(a), len(b), ";".join(groups), array("q", links).tobytes()

    def _parts(self, text):
        """What ``_part`` gives, for each word or for the text as a whole; None if it does for any."""
        body = f" {text}"
        if not self.by_words or _OTHER_LETTERS.search(body):
            whole = self._part(self.encoder_a.whole(self.a.prefix + text), self.encoder_b.whole(self.b.prefix + text), body)
            return whole and [whole]
        words = _WORDS.findall(body)
        parts = list(map(self.remembered.get, words))
        new = list(dict.fromkeys(word for word, part in zip(words, parts) if part is None))
        if not new:
            return parts
        found = {}
        for word, a, b in zip(new, self.encoder_a.of_words(new), self.encoder_b.of_words(new)):
            part = found[word] = self._part(a, b, word)
            if part is None:
                return None
            if len(word) <= _SHORT and len(self.remembered) < _REMEMBERED:
                self.remembered[word] = part
        return [part or found[word] for word, part in zip(words, parts)]

    def aligned(self, text):
        """Counts, groups as text, and the numbers of all linked pairs, A's id times B's vocabulary plus B's id."""
        parts = self._parts(text) if text else None
        if parts is None:
            return 0, 0, 0, 0, "", np.zeros(0, np.int64)
        n_a, n_b, groups, links = (map(itemgetter(at), parts) for at in range(4))
        groups, links = ";".join(groups), np.frombuffer(b"".join(links), np.int64)
        return sum(n_a), sum(n_b), groups.count(";") + 1, len(links), groups, links

    def tokens(self, text):
        """The ids of both as the groups have them, or None if either does not give the text back."""
        groups = self.aligned(text)[4]
        sides = zip(*(group.split("|") for group in groups.split(";"))) if groups else ()
        return tuple(np.array(",".join(side).split(","), np.int64) for side in sides) or None

    def counted(self, links):
        """Links of the fast path by A's id, and the others by pair, both as cells."""
        held, counts = np.unique(links, return_counts=True)
        of_a, of_b = np.divmod(held, len(self.b.pieces))
        quick = self.same[of_a] == of_b
        return _cells(of_a[quick], counts[quick]), _cells(held[~quick], counts[~quick])


def _walked(a, sizes_a, b, sizes_b, size_b):
    """The groups of two lists of ids that have the same bytes, and their links: pairs meet where either begins."""
    groups, links, from_a, from_b = [], [], 0, 0
    at_a = at_b = 0
    end_a, end_b = sizes_a[0], sizes_b[0]
    while True:
        links.append(a[at_a] * size_b + b[at_b])
        if end_a < end_b:
            at_a += 1
            end_a += sizes_a[at_a]
        elif end_b < end_a:
            at_b += 1
            end_b += sizes_b[at_b]
        else:
            at_a += 1
            at_b += 1
            groups.append(f"{','.join(map(str, a[from_a:at_a]))}|{','.join(map(str, b[from_b:at_b]))}")
            if at_a == len(a):
                return groups, links
            from_a, from_b = at_a, at_b
            end_a += sizes_a[at_a]
            end_b += sizes_b[at_b]


def _cells(held, counts):
    return np.concatenate((held, counts)).astype(np.int64).tobytes()


def _entries(cells):
    """The numbers and counts of a list of cells, and how many each has."""
    if not cells:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = [np.frombuffer(cell, np.int64) for cell in cells]
    half = [len(part) // 2 for part in flat]
    held = np.concatenate([part[:size] for part, size in zip(flat, half)])
    return held, np.concatenate([part[size:] for part, size in zip(flat, half)]), np.array(half)


def aligned(docs: DataFrame, a: Coder, b: Coder, text="text", carry=("doc_id",)) -> DataFrame:
    """Documents with their counts, digest of groups, and what of their links is to be counted.

    ``quick`` are ids of A of the fast path, ``pairs`` the numbers of other pairs, A's id times
    B's vocabulary plus B's id; both distinct, with their counts. The table is written, so a row
    keeps its ``place``. Carried columns are ``kept_0`` and so on.
    """
    spark = docs.sparkSession
    coders = spark.sparkContext.broadcast((a, b))
    kept = [F.col(name).alias(f"kept_{at}") for at, name in enumerate(carry)]
    rows = docs.select(*kept, F.col(text).alias("body"))
    fields = [field for field in rows.schema.fields if field.name != "body"]
    names = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "quick", "pairs")
    kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * 2
    types = [LongType()] * 4 + [StringType()] + [BinaryType()] * 2
    schema = StructType([*fields, StructField("place", LongType()), *map(StructField, names, types)])

    def align(batches):
        aligner, place = _Aligner(*coders.value), TaskContext.get().partitionId() << 33
        for batch in (batch for batch in batches if batch.num_rows):
            found = []
            for body in batch.column("body"):
                *numbers, groups, links = aligner.aligned(body.as_py())
                digest = hashlib.sha256(groups.encode()).hexdigest() if numbers[0] else ""
                found.append((*numbers, digest, *aligner.counted(links)))
            columns = {name: batch.column(name) for name in batch.schema.names if name != "body"}
            columns["place"] = pa.array(range(place, place + len(found)), pa.int64())
            place += len(found)
            for column, name, kind in zip(zip(*found), names, kinds):
                columns[name] = pa.array(column, kind)
            yield pa.RecordBatch.from_pydict(columns)

    return written(rows.mapInArrow(align, schema), "aligned")


def quick_counts(rows: DataFrame, size_a) -> DataFrame:
    """Links of the fast path by A's id, from one vector per task."""

    def count(batches):
        total = np.zeros(size_a, np.int64)
        for batch in batches:
            held, counts, _ = _entries(batch.column("quick").to_pylist())
            np.add.at(total, held, counts)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"a": pa.array(ids, pa.int64()), "n": pa.array(total[ids], pa.int64())})

    return rows.select("quick").mapInArrow(count, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))


def _added(parts):
    held, counts = (np.concatenate([part[at] for part in parts]) for at in (0, 1))
    distinct, places = np.unique(held, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, places, counts)
    return distinct, total


def pair_counts(rows: DataFrame) -> DataFrame:
    """Links of all other groups by ``pair``, put together in each task before the shuffle."""

    def handed(parts):
        distinct, total = _added(parts)
        return pa.RecordBatch.from_pydict({"pair": pa.array(distinct, pa.int64()), "n": pa.array(total, pa.int64())})

    def count(batches):
        parts, waiting, distinct = [], 0, 0
        for batch in batches:
            held, counts, _ = _entries(batch.column("pairs").to_pylist())
            parts.append((held, counts))
            waiting += len(held)
            if waiting > HELD:
                parts = [_added(parts)]
                waiting, distinct = 0, len(parts[0][0])
            if distinct > HELD:
                yield handed(parts)
                parts, distinct = [], 0
        if parts:
            yield handed(parts)

    return rows.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def link_counts(rows: DataFrame, a: Coder, b: Coder) -> DataFrame:
    """Every linked ``pair`` of the corpus with its count and whether it is ``best`` for B's id."""
    size_b, same = len(b.pieces), identity(a, b)
    quick = {row.a: row.n for row in quick_counts(rows, len(a.pieces)).collect()}  # at most A's vocabulary
    quick = pa.table({"pair": pa.array([one * size_b + int(same[one]) for one in quick], pa.int64()), "n": pa.array(list(quick.values()), pa.int64())})
    counts = rows.sparkSession.createDataFrame(quick).unionByName(pair_counts(rows))
    counts = written(counts.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    of_b = F.pmod("pair", F.lit(size_b))
    most = counts.groupBy(of_b.alias("b")).agg(F.max("n").alias("most"))  # at most B's vocabulary
    counts = counts.join(F.broadcast(most), of_b == F.col("b"))
    return counts.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _sums(cells, find):
    """Per cell its sums of best links and counts, and the entries that ``find`` doesn't know."""
    held, counts, sizes = _entries(cells)
    known, best, total = find(held)
    rows = np.repeat(np.arange(len(cells)), sizes)
    sums = np.zeros((2, len(cells)), np.int64)
    np.add.at(sums[0], rows, counts * best)
    np.add.at(sums[1], rows, counts * total)
    return sums, rows[~known], held[~known], counts[~known]


def _lookup(keys, best, total):
    def find(held):
        if not len(keys):
            return np.zeros(len(held), bool), np.zeros(len(held), np.int64), np.zeros(len(held), np.int64)
        at = np.minimum(np.searchsorted(keys, held), len(keys) - 1)
        known = keys[at] == held
        return known, best[at] * known, total[at] * known

    return find


def _table(rows, key):
    """Rows of ``key``, best and n as three arrays in order of the key."""
    found = rows.select(key, F.col("best").cast("long"), "n").toPandas().sort_values(key)
    return tuple(found[name].to_numpy("i8") for name in found.columns)


def scored(rows: DataFrame, counts: DataFrame, a: Coder, b: Coder, hot=HOT) -> DataFrame:
    """Rows of ``aligned`` with ``n_best``, links whose pair is best, and ``count_sum``."""
    spark, size_b, same = rows.sparkSession, len(b.pieces), identity(a, b)
    counts = written(counts, "link-counts")
    quick = np.flatnonzero(same >= 0)
    of_quick = spark.createDataFrame(pa.table({"pair": quick * size_b + same[quick], "a": quick}))
    by_a = _table(counts.join(F.broadcast(of_quick), "pair"), "a")  # at most A's vocabulary
    held, is_hot = frequent.split(counts, hot)
    tables = spark.sparkContext.broadcast((by_a, _table(held, "pair")))
    rest_type = ArrayType(StructType([StructField("pair", LongType()), StructField("times", LongType())]))
    own = [field for field in rows.schema.fields if field.name not in ("quick", "pairs")]
    schema = StructType([*own, StructField("n_best", LongType()), StructField("count_sum", LongType()), StructField("rest", rest_type)])

    def look_up(batches):
        find_quick, find_pair = (_lookup(*table) for table in tables.value)
        for batch in batches:
            sums, *_ = _sums(batch.column("quick").to_pylist(), find_quick)
            more, places, pairs, times = _sums(batch.column("pairs").to_pylist(), find_pair)
            ends = np.searchsorted(places, np.arange(batch.num_rows + 1))
            rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(pairs), pa.array(times)], ["pair", "times"]))
            columns = {field.name: batch.column(field.name) for field in own}
            columns |= {"n_best": pa.array(sums[0] + more[0]), "count_sum": pa.array(sums[1] + more[1]), "rest": rest}
            yield pa.RecordBatch.from_pydict(columns)

    found = written(rows.mapInArrow(look_up, schema), "looked-up")
    rest = found.select("place", F.explode("rest").alias("link")).select("place", "link.pair", "link.times")
    rest = rest.join(counts.where(~is_hot), "pair").groupBy("place").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    found = found.drop("rest").join(rest, "place", "left")
    return found.withColumns({
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}).drop("more_best", "more_sum", "place")


def compared(docs: DataFrame, a: Coder, b: Coder, text="text", carry=("doc_id",), hot=HOT) -> DataFrame:
    """The carried columns with each document's alignment, and how it agrees with the corpus."""
    rows = aligned(docs, a, b, text, carry)
    found = scored(rows, link_counts(rows, a, b), a, b, hot)
    names = [F.col(f"kept_{at}").alias(name) for at, name in enumerate(carry)]
    return found.select(*names, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
