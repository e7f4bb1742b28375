"""Personal data and secrets, replaced by surrogates of the same kind.

Detected: mail addresses, telephone numbers, IPv4 addresses, long card-like numbers,
secrets given as ``token = ...`` and the like or known by their first letters, names
after a title, and later mentions of these names in the same document. A surrogate is
drawn with a secret key from the value alone, so that a value has the same surrogate in
every document: digits for digits, letters for letters of the same case, octets for
octets; a card number stays valid if it was, a mail address keeps the ending of its
domain, and a name gets a name of its script, and if it is a first name of its gender.

Surrogates are checked over the whole corpus. Distinct values are few against the text,
and only they are shuffled: where two values of a kind draw the same surrogate, or one
draws a value that occurs, all but the smallest value draw again, until none is left.
Later draws are joined to the documents that hold such a value; all others draw their
surrogates as they are rewritten, so texts are not shuffled unless those are many.

Not detected: names that never follow one of ``TITLES`` in their document, mentions before
the title or in another case or inflection, third and later names, names in scripts whose
vowels are combining marks; telephone numbers without separators that have no plus, and
local ones without area code; IPv6; postal addresses, dates of birth and identity numbers;
secrets without a key word or known start. A name alone after a title is a family name
unless its document has it as a first name, and a first name of unknown gender is a kind
of its own: such a name may have another surrogate in another document.

Null and empty texts have no entities and stay as they are. Later draws are kept by
value, so rows with repeated or null ids each get those of their own values.
"""

import hashlib
import hmac
import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..session import written
from .text import same


class Entity(NamedTuple):
    start: int
    end: int
    kind: str
    value: str


_DOMAIN = re.compile(r"@([A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,})")
#: With a plus or 00; in groups of 3, 3 and 4 digits; with a trunk 0 and nine digits at least.
_PHONE = re.compile(
    r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d.])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\w.+/-])00[1-9]\d{0,2}[ .-](?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
    r"|(?<![\w.+/-])(?:1[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w]|[.-]\d)"
    r"|(?<![\w.+/-])(?=\(?0(?:[ /()-]{0,2}\d){8,13}(?!\d))(?:\(0[1-9]\d{0,3}\) ?|0[1-9]\d{0,3}[ /-])\d{2,8}(?:[ -]\d{2,5}){0,4}(?![\w]|[.-]\d)")
_IPV4 = re.compile(r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d)")
_CARD = re.compile(r"(?<![\d+.])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{13,19})(?!\d)")
_SECRET_NAME = r"(?i:token|secret|passw(?:or)?d|passwd|passphrase|pwd|(?:api|access|private|secret)[_ -]?key|credentials?)(?:\"|')?\s*(?:=>|[=:])\s*"
_SECRET = re.compile(_SECRET_NAME + r"(?:[\"']?([A-Za-z0-9_+/=-]{12,})|[\"']?(?=[^\s\"'<>,;]*\d)([^\s\"'<>,;]{7,}[^\s\"'<>,;.!?)]))")
#: Secrets that say by their first letters what they are.
_KNOWN = re.compile(
    r"(?<![A-Za-z0-9_-])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk[_-][A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|(?<=Bearer )[A-Za-z0-9._~+/=-]{12,})(?![A-Za-z0-9_-])")
#: Titles by gender, none for those of both; those that are words of their own need their dot.
TITLES = {"Mr.": "m", "Mrs.": "f", "Ms.": "f", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f",
          "Señor": "m", "Señora": "f", "Sr.": "m", "Sra.": "f", "Господин": "m", "Госпожа": "f",
          "Mr": "m", "Mrs": "f", "Miss": "f", "Sir": "m", "Mlle": "f", "Herrn": "m", "Don": "m", "Doña": "f", "Dra.": "f",
          "Κύριος": "m", "Κύριε": "m", "Κυρία": "f", "Mx.": "", "Dr.": "", "Dr": "", "Prof.": "", "Prof": "", "Professor": "", "Доктор": ""}
_TITLE = "(?:" + "|".join(map(re.escape, sorted(TITLES, key=len, reverse=True))) + ")"
_TITLED = re.compile(
    rf"(?<!\w)({_TITLE}(?: {_TITLE})*) ([^\W\d_]+(?:[-'’][^\W\d_]+)*)(?: ([^\W\d_]+(?:[-'’][^\W\d_]+)*))?")


def _luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


_DIGIT = re.compile(r"\d")
_SECRET_WORDS = ("token", "secret", "passw", "passphrase", "pwd", "key", "credential")
_KNOWN_STARTS = ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "sk_", "xox", "eyJ", "Bearer ")
_TITLE_STARTS = tuple(f"{title} " for title in TITLES)


def _local(text, end):
    """Where the local part that ends there starts; the end itself if there is none."""
    start = end
    while start and (text[start - 1] in "._%+-" or text[start - 1] < "\u0590" and text[start - 1].isalnum()):
        start -= 1
    while start < end and text[start] in ".%+-":
        start += 1
    return start if text[end - 1 : end] not in (".", "%", "+", "-") else end


def _is_name(word):
    return not word[0].islower()


def _names(text):
    """Names after titles, and where these names stand alone later on."""
    found, firsts = [], {}
    for match in _TITLED.finditer(text):
        if _is_name(match[2]):
            gender = next(filter(None, map(TITLES.get, match[1].split(" "))), "")
            both = match[3] and _is_name(match[3]) and (match[3][0].isupper() or not match[2][0].isupper())
            kind = "family" if not both else f"first_{gender}" if gender else "first"
            found.append(Entity(*match.span(2), kind, match[2]))
            if both:
                value = normal(kind, match[2])
                firsts[value] = max(kind, firsts.get(value, kind))
                found.append(Entity(*match.span(3), "second", match[3]))
    # a name alone is a first name if it is one elsewhere; without a gender, it has the one known
    for at, (start, end, kind, value) in enumerate(found):
        if kind in ("family", "first"):
            found[at] = Entity(start, end, firsts.get(normal("family", value), kind), value)
        elif kind == "second":
            found[at] = Entity(start, end, "family", value)
    kinds = {}
    for entity in found:
        kinds.setdefault(entity.value, entity)
    if kinds:
        for match in _WORD.finditer(text, found[0].end):
            first = kinds.get(match[0])
            if first and match.start() >= first.end and len(match[0]) > 1:
                found.append(Entity(*match.span(), first.kind, match[0]))
    return {entity.start: entity for entity in reversed(found)}.values()


_WORD = re.compile(r"(?<!\w)[^\W\d_]+(?:[-'’][^\W\d_]+)*(?!\w)")


def _found(text):
    """All matches. Most texts lack what a kind can't be without, which is quick to see."""
    if "@" in text:
        for match in _DOMAIN.finditer(text):
            start = _local(text, match.start())
            if start < match.start():
                yield Entity(start, match.end(), "mail", text[start : match.end()])
    if "=" in text or ":" in text:
        folded = text.casefold()
        if any(word in folded for word in _SECRET_WORDS):
            for match in _SECRET.finditer(text):
                yield Entity(*match.span(match.lastindex), "secret", match[match.lastindex])
    if any(start in text for start in _KNOWN_STARTS):
        for match in _KNOWN.finditer(text):
            yield Entity(*match.span(), "secret", match[0])
    if _DIGIT.search(text):
        for kind, pattern in (("phone", _PHONE), ("ip", _IPV4), ("card", _CARD)):
            for match in pattern.finditer(text):
                if kind != "ip" or all(int(part) < 256 for part in match[0].split(".")):
                    yield Entity(*match.span(), kind, match[0])
    if any(title in text for title in _TITLE_STARTS):
        yield from _names(text)


def entities(text):
    """The entities of a text in order, none within another; the earlier and longer hold."""
    out = []
    for entity in sorted(_found(text), key=lambda entity: (entity.start, -entity.end)):
        if not out or entity.start >= out[-1].end:
            out.append(entity)
    return out


def normal(kind, value):
    """What stays the same between spellings of one value."""
    if kind in ("phone", "card"):
        return "".join(char for char in value if char.isdigit())
    return value.casefold() if kind == "mail" or kind == "family" or kind.startswith("first") else value


class _Draws:
    """Numbers drawn with the key from a value and the number of the draw."""

    def __init__(self, key, kind, value, draw):
        self.key, self.seed, self.turn, self.left = key, f"{kind}\0{value}\0{draw}".encode(), 0, b""

    def below(self, bound):
        if len(self.left) < 8:
            self.left = hmac.new(self.key, self.seed + self.turn.to_bytes(4, "big"), hashlib.sha256).digest()
            self.turn += 1
        number, self.left = int.from_bytes(self.left[:8], "big"), self.left[8:]
        return number % bound


def _characters(draws, value):
    out = []
    for char in value:
        if "0" <= char <= "9":
            out.append(chr(48 + draws.below(10)))
        elif "a" <= char <= "z":
            out.append(chr(97 + draws.below(26)))
        elif "A" <= char <= "Z":
            out.append(chr(65 + draws.below(26)))
        elif char > "\x7f" and char.isalpha():
            out.append(chr(97 + draws.below(26)))
        else:
            out.append(char)
    return "".join(out)


#: Syllables that names are made of, by script, and their endings by gender.
_SYLLABLES = {
    "latin": (["b", "d", "f", "g", "k", "l", "m", "n", "p", "r", "s", "t", "v"], ["a", "e", "i", "o", "u"],
              {"first_m": ["n", "r", "s", "k"], "first_f": ["na", "la", "ra", "sa"], "first": ["i", "e"], "family": ["ner", "son", "man", "ler"]}),
    "cyrillic": (["б", "в", "г", "д", "к", "л", "м", "н", "п", "р", "с", "т"], ["а", "е", "и", "о", "у"],
                 {"first_m": ["н", "р", "с", "к"], "first_f": ["на", "ла", "ра", "са"], "first": ["и", "е"], "family": ["нов", "ров", "лин", "кин"]}),
    "greek": (["β", "γ", "δ", "κ", "λ", "μ", "ν", "π", "ρ", "σ", "τ"], ["α", "ε", "ι", "ο"],
              {"first_m": ["νος", "ρος", "σης"], "first_f": ["να", "λα", "ρα"], "first": ["νι", "ρι"], "family": ["δης", "πουλος", "κης"]}),
}
#: Scripts without capitals: a range of characters, and letters that names are drawn from.
_LETTERS = [
    ("\u0590", "\u05ff", "אבגדהוזחטילמנסעפצקרשת"), ("\u0600", "\u06ff", "ابتجحدرزسشصطعفقكلمنهوي"),
    ("\u3040", "\u309f", "あいうえおかきくけこさしすせそたちつてとなにのはひふほまみむもやゆよらりるれろわ"),
    ("\u30a0", "\u30ff", "アイウエオカキクケコサシスセソタチツテトナニノハヒフホマミムモヤユヨラリルレロワ"),
    ("\u3400", "\u9fff", "安白成德东方光国海和华家建江杰金立林龙明宁平青荣山石水松天文武西祥新星永玉云志中"),
    ("\uac00", "\ud7a3", "가강경고나남다대도라리마미민박배보서성수시아영오우유윤이인재정조주지진창태하한현호"),
]


def _name(draws, kind, value, draw):
    for low, high, letters in _LETTERS:
        if low <= value[0] <= high:
            return "".join(letters[draws.below(len(letters))] for _ in range(max(2, len(value)) + draw // 4))
    script = "cyrillic" if any("Ѐ" <= char <= "ӿ" for char in value) else "greek" if any("Ͱ" <= char <= "Ͽ" for char in value) else "latin"
    first, then, endings = _SYLLABLES[script]
    syllables = max(2, min(6, len(value) // 2)) + draw // 4
    name = "".join(first[draws.below(len(first))] + then[draws.below(len(then))] for _ in range(syllables))
    return name + endings[kind][draws.below(len(endings[kind]))]


def _octets(draws, value):
    parts = list(map(int, value.split(".")))
    kept = 1 if parts[0] in (10, 127) else 2 if (parts[0], parts[1]) == (192, 168) else 0
    drawn = parts[:kept] + [draws.below(256) for _ in range(4 - kept)]
    if not kept:
        drawn[0] = 11 + draws.below(110)
    return ".".join(map(str, drawn))


def surrogate(key, kind, value, draw=0):
    """The surrogate of a normal value: of its kind and format, the same for the same key.

    From the 16th draw on, when a short format is used up, characters are added, and
    private addresses may become others.
    """
    draws = _Draws(key, kind, value, draw)
    more = draw // 16
    if kind == "mail":
        local, _, domain = value.rpartition("@")
        labels = domain.split(".")
        kept = 2 if labels[-2] == "example" else 1
        return f"{_characters(draws, local + 'x' * more)}@{'.'.join([_characters(draws, label) for label in labels[:-kept]] + labels[-kept:])}"
    if kind == "ip":
        return _octets(draws, value if not more else "0.0.0.0")
    if kind == "card":
        digits = value[0] + _characters(draws, value[1:] + "0" * more)
        if _luhn(value):
            digits = next(digits[:-1] + str(last) for last in range(10) if _luhn(digits[:-1] + str(last)))
        return digits
    if kind == "phone":
        return value[:1] + _characters(draws, value[1:] + "0" * more)
    if kind == "secret":
        if re.fullmatch("[0-9a-f]+|[0-9A-F]+", value):
            alphabet = "0123456789abcdef" if value == value.lower() else "0123456789ABCDEF"
            return "".join(alphabet[draws.below(16)] for _ in value + "x" * more)
        return _characters(draws, value + "x" * more)
    return _name(draws, kind, value, draw)


def fitted(kind, drawn, value):
    """A drawn surrogate in the spelling of the value that it replaces."""
    if kind in ("phone", "card"):
        digits = iter(drawn)
        return "".join([next(digits) if char.isdigit() else char for char in value] + list(digits))
    if kind == "mail":
        return "".join(new.upper() if old.isupper() else new for new, old in zip(drawn, value)) if len(drawn) == len(value) else drawn
    if kind == "family" or kind.startswith("first"):
        return drawn.upper() if value.isupper() and len(value) > 1 else drawn.title()
    return drawn


_KEYED = "kind string, value string"


def _values(with_id):
    def values(batches):
        import pyarrow as pa

        for batch in batches:
            places, kinds, found = [], [], []
            for place, text in enumerate(batch.column("body")):
                own = {(entity.kind, normal(entity.kind, entity.value)) for entity in entities(text.as_py() or "")}
                for kind, value in sorted(own):
                    places.append(place)
                    kinds.append(kind)
                    found.append(value)
            columns = {"id": batch.column("id").take(pa.array(places, pa.int64()))} if with_id else {}
            yield pa.RecordBatch.from_pydict(columns | {"kind": pa.array(kinds, pa.string()), "value": pa.array(found, pa.string())})

    return values


def _drawn(key):
    def drawn(batches):
        import pyarrow as pa

        for batch in batches:
            rows = zip(*(batch.column(name).to_pylist() for name in ("kind", "value", "draw")))
            made = [surrogate(key, *row) for row in rows]
            yield pa.RecordBatch.from_pydict(
                {name: batch.column(name) for name in ("kind", "value", "draw")} | {"surrogate": pa.array(made, pa.string())})

    return drawn


def draws(docs: DataFrame, key: bytes, text="text") -> DataFrame:
    """Every distinct value with the number of the draw that gives it a surrogate alone."""
    spark = docs.sparkSession
    values = docs.select(F.col(text).alias("body")).mapInArrow(_values(False), _KEYED).distinct()
    values = written(values.withColumn("draw", F.lit(0)), "values")
    while True:
        made = values.mapInArrow(_drawn(key), f"{_KEYED}, draw int, surrogate string")
        made = written(made, "surrogates")
        holders = made.groupBy("kind", "surrogate").agg(F.min(F.struct("draw", "value")).alias("holder"), F.count(F.lit(1)).alias("holders"))
        taken = values.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("occurs"))
        clashing = holders.join(taken, ["kind", "surrogate"], "left").where("holders > 1 OR occurs")
        again = made.join(clashing.select("kind", "surrogate", "holder", "occurs"), ["kind", "surrogate"]).where(
            F.col("occurs") | (F.col("value") != F.col("holder.value")))
        again = written(again.select("kind", "value", F.lit(True).alias("again")), "clashes")
        if again.isEmpty():
            return values
        values = written(values.join(again, ["kind", "value"], "left").select(
            "kind", "value", (F.col("draw") + F.coalesce("again", F.lit(False)).cast("int")).alias("draw")), "values")


def _replaced(key):
    def replaced(batches):
        import pyarrow as pa

        kind_of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, found = [], []
            for text, later in zip(batch.column("body"), batch.column("later")):
                text = text.as_py()
                later = {(row["kind"], row["value"]): row["draw"] for row in later.as_py() or ()}
                parts, spans, at, length = [], [], 0, 0
                for entity in entities(text or ""):
                    value = normal(entity.kind, entity.value)
                    new = fitted(entity.kind, surrogate(key, entity.kind, value, later.get((entity.kind, value), 0)), entity.value)
                    parts += [text[at : entity.start], new]
                    length += entity.start - at
                    spans.append({"kind": entity.kind, "start": length, "end": length + len(new)})
                    length, at = length + len(new), entity.end
                texts.append(text if not parts else "".join([*parts, text[at:]]))
                found.append(spans)
            columns = {name: batch.column(name) for name in batch.schema.names if name not in ("body", "later")}
            yield pa.RecordBatch.from_pydict(columns | {"body": pa.array(texts, pa.string()), "entities": pa.array(found, kind_of)})

    return replaced


def replaced(docs: DataFrame, key: bytes, carry=("doc_id",), doc_id="doc_id", text="text") -> DataFrame:
    """The carried columns, the new ``text`` and its ``entities``: kind and offsets in it."""
    later = draws(docs, key, text).where("draw > 0")
    id_type = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    held = rows.mapInArrow(_values(True), StructType([
        StructField("id", id_type), StructField("kind", StringType()), StructField("value", StringType())]))
    held = held.join(later, ["kind", "value"]).groupBy("id").agg(F.collect_set(F.struct("kind", "value", "draw")).alias("later"))
    held = written(held, "later-draws")
    kept = [F.col(name).alias(f"kept_{place}") for place, name in enumerate(carry)]
    rows = docs.select(*kept, F.col(doc_id).alias("own_id"), F.col(text).alias("body"))
    rows = rows.join(held, same(F.col("own_id"), F.col("id")), "left").drop("own_id", "id")
    span = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])
    fields = [field for field in rows.schema.fields if field.name not in ("body", "later")]
    rows = rows.mapInArrow(_replaced(key), StructType([
        *fields, StructField("body", StringType()), StructField("entities", ArrayType(span))]))
    names = [F.col(f"kept_{place}").alias(name) for place, name in enumerate(carry)]
    return rows.select(*names, F.col("body").alias("text"), "entities")
