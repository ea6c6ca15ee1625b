"""Personal data: detection, and keyed surrogates of the same type, format, script and gender.

Detected: e-mail addresses, telephone numbers, IPv4 and IPv6 addresses, account numbers (13 to 19 digits), IBANs with a sound
check, national numbers (three, two and four digits), access keys, secrets given to a name such as token or password, and
personal names after a title in any case, after words that introduce one ("my name is", "signed by"), led by a known given
name, or, if it is one, after a greeting; initials between two names stay. An entity is its type with a canonical form (digits of a number, lower case of an address, ...), so
different spellings of one entity get one surrogate, a telephone number with +1 or without among them. Numbers that stand beside each other are entities of their own:
``numbers`` says where one ends. Every pattern takes time in proportion to the text; addresses are read from their "@" outwards.

A surrogate is drawn from a keyed hash of type, canonical form and attempt: digits become digits, letters become letters of
the same case and script (any script: other letters come from the same stretch of Unicode), separators stay; an IPv4 address
stays one; the account number's check digit stays sound if it was; a listed given name becomes another of the same gender and
script, by a shift of its list that gives no name itself and no two alike; an unlisted one, like a surname, gets letters of
its own; titles stay. So persons that differ stay different, and a surname alone still points to its bearer. The key must be
given: without it nothing can be traced back.

Texts are searched once; the spans found are stored beside them. Collisions are checked over all entities of the corpus: two
that would get one surrogate, or one that would get another's real form, are drawn again with the next attempt, all but the
first in order, until none is left; ``MAX_ATTEMPTS`` without success is an error. Only those few entities whose attempt is not
0 are carried back to their texts, by a join.

Defined results: null text stays null without entities; empty texts, repeated rows, null doc_ids and empty tables need no
exception; overlapping matches: the earlier, then the longer one, holds; input columns named n_entities or kinds are replaced,
all others are carried as they are.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cluster import checkpointed, maybe_broadcast, stored

MAX_ATTEMPTS = 50

#: Given names by script and gender.
GIVEN = {
    ("latin", "f"): ["Anna", "Maria", "Julia", "Laura", "Sophie", "Emma", "Clara", "Elena", "Lucia", "Camille", "Claire", "Ingrid", "Heike", "Carmen", "Isabel", "Mary", "Linda", "Susan", "Karen", "Nancy", "Alice", "Helen", "Ruth", "Diana", "Marie", "Petra", "Monika", "Pilar", "Rosa", "Jane"],
    ("latin", "m"): ["Peter", "Paul", "Thomas", "Martin", "Lukas", "Jonas", "Pierre", "Michel", "Antoine", "Hugo", "Carlos", "Javier", "Miguel", "Pablo", "Diego", "John", "James", "Robert", "David", "Richard", "George", "Edward", "Frank", "Henry", "Walter", "Klaus", "Stefan", "Andreas", "Luis", "Jorge"],
    ("cyrillic", "f"): ["Анна", "Мария", "Елена", "Ольга", "Наталья", "Ирина", "Татьяна", "Светлана", "Юлия", "Дарья"],
    ("cyrillic", "m"): ["Иван", "Пётр", "Сергей", "Дмитрий", "Алексей", "Николай", "Михаил", "Андрей", "Павел", "Виктор"],
    ("greek", "f"): ["Μαρία", "Ελένη", "Κατερίνα", "Σοφία", "Άννα", "Βασιλική"],
    ("greek", "m"): ["Γιώργος", "Νίκος", "Δημήτρης", "Κώστας", "Παύλος", "Ανδρέας"],
}
#: Titles and the gender that they tell.
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Señor": "m", "Señora": "f", "Dr": "", "Prof": "", "господин": "m", "госпожа": "f", "Κύριος": "m", "Κυρία": "f"}
#: Letters that surrogates draw from, by script.
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

_GENDER = {name: (script, gender) for (script, gender), names in GIVEN.items() for name in names}
_NAME = r"[^\W\d_a-zа-яα-ω](?:[^\W\d_]+|['’][^\W\d_]{2,})(?:-[^\W\d_]+)?"
_INITIALS = r"(?: [^\W\d_a-zа-яα-ω]\.)*"
_TITLE_OF = TITLES | {t.upper(): g for t, g in TITLES.items()}
#: Words that greet; a listed given name may follow.
GREETINGS = ("Dear", "Hi", "Hello", "Hallo", "Liebe", "Lieber", "Cher", "Chère", "Querida", "Querido")
_BEFORE_AT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}")
_NUMBER = re.compile(r"(?<![\w.])(?:\+?\d|\(\d)[\d ().\-/]{5,}\d(?![\w])")
_IPV4 = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)")
_LOCAL = r"0\d{2,4}[ \-/]\d{3,4}[ \-]?\d{3,4}"
_PLAIN = r"\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4}"
_CARD = r"\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{4}"
#: An international number ends before another number if enough of it is left, else where its digits and separators end.
_ABROAD = r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d"
_PHONE = re.compile(rf"{_ABROAD}(?:(?! (?:{_PLAIN}|{_LOCAL}|{_CARD}|\d{{13,19}})(?!\d))[\d .\-]){{4,14}}\d(?!\d)|{_ABROAD}[\d .\-]{{4,14}}\d|{_PLAIN}|{_LOCAL}")
_CLEAR = re.compile(rf"(?<!\d)(?:\+\d|{_PLAIN})")
_LOOSE = re.compile(rf"(?<!\d){_LOCAL}(?!\d)")
_ACCOUNT = re.compile(r"\d(?:[ \-]?\d){12,18}")
_WHOLE = re.compile(r"\d(?:[ \-]?\d){12,18}(?!\d)")
_CHAIN = re.compile(r"\d(?:[ \-]?\d)*")
_GROUP = re.compile(r"(?<![\d+])\d{13,19}(?!\d)")
_CARDS = re.compile(rf"(?<![\d+])(?=({_CARD}|\d{{4}}[ \-]\d{{6}}[ \-]\d{{5}})(?!\d))")
_PARTING = re.compile(rf"({_CARD})[ \-]\d{{3}}")
_BEGINNING = re.compile(r"(?<!\d)(?:\+?\d|\(\d)")
_DIGITS = re.compile(r"\d+")
_SECRET = re.compile(r"""(?i:\b(?:api[_-]?key|access[_-]?key|auth[_-]?token|token|secret|password|passwd)\b)["']?\s*[:=]\s*["']?([A-Za-z0-9+/_\-]{8,}={0,2})""")
#: Words without which the pattern behind need not be tried.
_SECRET_WORDS, _INTRODUCING = ("key", "token", "secret", "passw"), ("name", "by ", "author:", "signed:", "contact:")
_TITLED = re.compile(rf"\b({'|'.join(_TITLE_OF)})\.? ({_NAME})(?:{_INITIALS} ({_NAME}))?")
_INTRODUCED = re.compile(rf"(?:\b(?i:my name is|name is|signed by|written by)|\b(?i:name|author|signed|contact):) ({_NAME}){_INITIALS} ({_NAME})\b")
_LED = re.compile(rf"\b({'|'.join(sorted(_GENDER))}){_INITIALS} ({_NAME})\b")
_GREETED = re.compile(rf"\b(?:{'|'.join(GREETINGS)}) ({'|'.join(sorted(_GENDER))})\b")
_IPV6 = re.compile(r"(?<![\w:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:])")
_NATIONAL = re.compile(r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])")
_KEY = re.compile(r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16,}")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")


class Entity(NamedTuple):
    start: int
    end: int
    kind: str
    canonical: str


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the e-mail addresses: from each "@" to the left as far as it goes, and a domain to the right."""
    done, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > done and text[lo - 1] in _BEFORE_AT:
            lo -= 1
        domain = _DOMAIN.match(text, at + 1) if lo < at else None
        done = domain.end() if domain else at + 1
        if domain:
            yield lo, done
        at = text.find("@", done)


def script_of(word: str) -> str:
    for c in word:
        if "\u0370" <= c <= "\u03ff" or "\u1f00" <= c <= "\u1fff":
            return "greek"
        if "\u0400" <= c <= "\u04ff":
            return "cyrillic"
    return "latin"


def _account(piece: str, at: int, end: int) -> int:
    """End of the account number that begins at a place, or 0."""
    end = min(end, at + 64)  # more than 26 digits with separators and the number behind them
    clear = _CLEAR.search(piece, at + 1, end)
    end = clear.start() if clear else end
    loose = _LOOSE.search(piece, at + 1, end)
    if loose and _WHOLE.match(piece, at, loose.start()):
        end = loose.start()
    chain = _CHAIN.match(piece, at, end)
    if not chain:
        return 0
    digits = re.sub(r"\D", "", chain[0])
    parting = _PARTING.fullmatch(chain[0])
    if parting and not _sound(digits):
        return at + len(parting[1])
    hit = _WHOLE.match(piece, at, end) if not 19 < len(digits) < 26 else None  # too few for two: as much as one can have
    hit = hit or _ACCOUNT.match(piece, at, end)
    return hit.end() if hit else 0


def numbers(piece: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the telephone and account numbers in a run of digits and separators, in order.

    First come groups of 13 to 19 digits and cards with a sound check digit. In what they leave, a number begins with a group
    of digits: a telephone number if one can be read there, else an account, which ends before a telephone number, between
    groups where two can stand, and before a card's three further digits. Last come numbers inside groups.
    """
    found = [(m.start(), m.end(), "account") for m in _GROUP.finditer(piece)]
    last = 0
    for m in _CARDS.finditer(piece):
        if m.start() >= last and _sound(re.sub(r"\D", "", m[1])):
            last = m.end(1)
            found.append((m.start(), last, "account"))

    def gaps() -> list[tuple[int, int]]:
        found.sort()
        return list(zip([0, *(b for _, b, _ in found)], [*(a for a, _, _ in found), len(piece)], strict=True))

    for at, end in gaps():
        while m := _BEGINNING.search(piece, at, end):
            at = m.start()
            phone = _PHONE.match(piece, at, end)
            stop = phone.end() if phone else _account(piece, at, end) if piece[at].isdigit() else 0
            if stop:
                found.append((at, stop, "phone" if phone else "account"))
                at = stop
            else:
                at = _DIGITS.match(piece, at).end() if piece[at].isdigit() else at + 1
    for at, end in gaps():
        while hit := (account := _ACCOUNT.search(piece, at, end)) or _PHONE.search(piece, at, end):
            found.append((hit.start(), hit.end(), "account" if account else "phone"))
            at = hit.end()
    return sorted(found)


def _given(m: re.Match, group: int, gender: str = "") -> Entity:
    """A given name: listed ones with their gender, the title's first; any other is a forename."""
    name = m[group]
    listed = _GENDER.get(name)
    if not listed:
        return Entity(m.start(group), m.end(group), "forename", name.lower())
    if (listed[0], gender) not in GIVEN or name not in GIVEN[listed[0], gender]:
        gender = listed[1]
    return Entity(m.start(group), m.end(group), "given", f"{gender}:{name.lower()}")


def _ipv6(found: str) -> str | None:
    """The address with all its digits; none for what only looks like one, such as a::b."""
    if len(found) < 6 or not _DIGITS.search(found):
        return None
    try:
        return ipaddress.IPv6Address(found).exploded
    except ValueError:
        return None


def _iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def detect(text: str | None) -> list[Entity]:
    """Entities of a whole text in order of place, without overlaps."""
    if not text:
        return []
    found: list[Entity] = []
    if "@" in text:
        found += [Entity(a, b, "email", text[a:b].lower()) for a, b in addresses(text)]
    if _DIGITS.search(text):
        for m in _IPV4.finditer(text):
            found.append(Entity(m.start(), m.end(), "ipv4", m[0]))
        if text.count(":") > 1:
            found += [Entity(m.start(), m.end(), "ipv6", whole) for m in _IPV6.finditer(text) if (whole := _ipv6(m[0]))]
        if "-" in text:
            found += [Entity(m.start(), m.end(), "national", m[0].replace("-", "")) for m in _NATIONAL.finditer(text)]
        if "AKIA" in text:
            found += [Entity(m.start(), m.end(), "secret", m[0]) for m in _KEY.finditer(text)]
        found += [Entity(m.start(), m.end(), "iban", iban) for m in _IBAN.finditer(text) if len(iban := m[0].replace(" ", "")) >= 15 and _iban_rest(iban) == 1]
        other = _IPV4.sub(lambda m: m[0] if text[max(0, m.start() - 1) : m.start()] == "+" else "\n" * len(m[0]), text) if found else text
        for m in _NUMBER.finditer(other):
            at = m.start()
            for a, b, kind in numbers(m[0]):
                digits = re.sub(r"\D", "", m[0][a:b])
                found.append(Entity(at + a, at + b, kind, digits[1:] if kind == "phone" and len(digits) == 11 and m[0][a : a + 2] == "+1" else digits))
    low = text.lower()
    if any(w in low for w in _SECRET_WORDS):
        found += [Entity(m.start(1), m.end(1), "secret", m[1]) for m in _SECRET.finditer(text)]
    for m in _TITLED.finditer(text):
        if m[3]:
            found.append(_given(m, 2, _TITLE_OF[m[1]]))
        elif m[2] in _GENDER:
            found.append(_given(m, 2, _TITLE_OF[m[1]]))
            continue
        last = 3 if m[3] else 2
        found.append(Entity(m.start(last), m.end(last), "surname", m[last].lower()))
    for pattern in (_LED, _INTRODUCED) if any(w in low for w in _INTRODUCING) else (_LED,):
        for m in pattern.finditer(text):
            found.append(_given(m, 1))
            found.append(Entity(m.start(2), m.end(2), "surname", m[2].lower()))
    if any(w in text for w in GREETINGS):
        found += [_given(m, 1) for m in _GREETED.finditer(text)]
    found.sort(key=lambda e: (e.start, -e.end))
    out: list[Entity] = []
    for e in found:
        if not out or e.start >= out[-1].end:
            out.append(e)
    return out


class Stream:
    """Numbers below a bound from a keyed hash."""

    def __init__(self, key: bytes, *parts: object):
        self.seed = hmac.new(key, "\x1f".join(map(str, parts)).encode(), hashlib.sha256).digest()
        self.value, self.block = int.from_bytes(self.seed, "big"), 0

    def below(self, n: int) -> int:
        if self.value < 1 << 64:
            self.block += 1
            self.value = int.from_bytes(hashlib.sha256(self.seed + self.block.to_bytes(4, "big")).digest(), "big")
        self.value, r = divmod(self.value, n)
        return r


def _sound(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


@lru_cache(maxsize=4096)
def _letters(c: str) -> str:
    """Letters to draw from for a lower-case or caseless letter: of its script, or of its kind in its stretch of 128 code points."""
    first = unicodedata.name(c, "?").split(" ")[0]
    if first in ("LATIN", "CYRILLIC", "GREEK"):
        return LETTERS[first.lower()]
    start, kind = ord(c) & ~127, unicodedata.category(c)
    return "".join(x for x in map(chr, range(start, start + 128)) if unicodedata.category(x) == kind and unicodedata.name(x, "?").split(" ")[0] == first)


def surrogate(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """The canonical form of the surrogate."""
    s = Stream(key, kind, canonical, attempt)
    if kind == "ipv4":
        return ".".join(str(1 + s.below(254)) for _ in range(4))
    if kind == "ipv6":
        group = lambda g: "0000" if g == "0000" else f"{s.below(16 ** len(g.lstrip('0')) - 16 ** (len(g.lstrip('0')) - 1)) + 16 ** (len(g.lstrip('0')) - 1):04x}"
        return ":".join(map(group, canonical.split(":")))
    if kind == "national":
        return str(1 + s.below(8)) + "".join(str(s.below(10)) for _ in canonical[1:])
    if kind == "iban":
        rest = "".join(str(s.below(10)) if c.isdigit() else LETTERS["latin"][s.below(26)].upper() for c in canonical[4:])
        return f"{canonical[:2]}{98 - _iban_rest(f'{canonical[:2]}00{rest}'):02d}{rest}"
    if kind in ("phone", "account"):
        lead = canonical[: max(0, len(canonical) - 10)] if kind == "phone" else ""
        digits = lead + "".join(str(s.below(10)) for _ in canonical[len(lead) :])
        if kind == "account":
            digits = str(1 + s.below(9)) + digits[1:]
            if _sound(canonical):
                digits = next(digits[:-1] + str(d) for d in range(10) if _sound(digits[:-1] + str(d)))
        return digits
    if kind == "given":
        gender, name = canonical.split(":", 1)
        listed = (script_of(name), gender)
        names = [x.lower() for x in GIVEN[listed]]
        # one shift for all names of a list: never the name itself, and never two alike
        at = names.index(name) + 1 + Stream(key, "given names", *listed).below(len(names) - 1)
        return f"{gender}:{names[at % len(names)]}"
    keep_from = canonical.rfind(".") if kind == "email" else len(canonical)
    out = []
    for i, c in enumerate(canonical):
        if i >= keep_from or not c.isalnum() or (kind == "secret" and i < 4 and canonical.startswith("AKIA")):
            out.append(c)
        elif c.isdigit():
            out.append(str(s.below(10)))
        elif kind == "secret" and re.fullmatch(r"[0-9a-fA-F]+", canonical):
            out.append("abcdef"[s.below(6)].upper() if c.isupper() else "abcdef"[s.below(6)])
        else:
            letters = _letters(c)
            x = letters[s.below(len(letters))]
            out.append(x.upper() if c.isupper() else x)
    return "".join(out)


def rendered(kind: str, found: str, new: str) -> str:
    """A surrogate's canonical form in the format of the text that it replaces."""
    if kind in ("phone", "account", "national"):
        digits = iter("".join(c for c in found if c.isdigit())[: -len(new)] + new)  # a country's number stays
        return "".join(next(digits) if c.isdigit() else c for c in found)
    if kind == "iban":
        letters = iter(new)
        return "".join(c if c == " " else next(letters) for c in found)
    if kind == "ipv6":
        new = new if len(found) == len(new) else ipaddress.IPv6Address(new).compressed
        return new.upper() if any(c in "ABCDEF" for c in found) else new
    if kind == "given":
        new = new.split(":", 1)[1]
    if kind in ("given", "forename", "surname", "email"):
        if found.isupper():
            return new.upper()
        if kind != "email" and not ("'" in found or "’" in found):
            return "-".join(p[:1].upper() + p[1:] for p in new.split("-"))
        if len(found) == len(new):
            return "".join(b.upper() if a.isupper() else b for a, b in zip(found, new, strict=True))
    return new


def with_surrogates(text: str, entities: list[Entity], key: bytes, attempts: dict[tuple[str, str], int]) -> str:
    out, at = [], 0
    for start, end, kind, canonical in entities:
        out += [text[at:start], rendered(kind, text[start:end], surrogate(key, kind, canonical, attempts.get((kind, canonical), 0)))]
        at = end
    return "".join([*out, text[at:]])


def replaced(text: str, key: bytes) -> tuple[str, list[Entity]]:
    """One text by itself: with surrogates of first attempts, and its entities."""
    entities = detect(text)
    return with_surrogates(text, entities, key, {}), entities


_SPANS = "array<struct<start: int, end: int, kind: string, canonical: string>>"
_SPANS_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("canonical", pa.string())]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [[e._asdict() for e in detect(text)] for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, _SPANS_TYPE)], [*batch.schema.names, "spans"])


def _draw(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, canonical, attempt = (batch.column(c).to_pylist() for c in ("kind", "canonical", "attempt"))
            new = [surrogate(key, *x) for x in zip(kind, canonical, attempt, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("canonical"), batch.column("attempt"), pa.array(new, pa.string())], ["kind", "canonical", "attempt", "new"])

    return run


def assigned(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, attempt, new) for distinct (kind, canonical): no two surrogates of a kind are equal, and none is a real form.

    Given names of the lists need no check: they are permuted.
    """
    shape = "kind string, canonical string, attempt int, new string"
    all_of = checkpointed(entities.withColumn("attempt", F.lit(0)).mapInArrow(_draw(key), shape))
    for n in range(MAX_ATTEMPTS + 1):
        unique = all_of.where("kind <> 'given'")
        first = unique.groupBy("kind", "new").agg(F.min("canonical").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("kind", F.col("new"), "first")
        real = unique.select("kind", F.col("canonical").alias("new"), F.lit(True).alias("real"))
        marked = unique.join(first, ["kind", "new"], "left").join(real, ["kind", "new"], "left")
        again = marked.where("real or canonical <> first").select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))
        again = checkpointed(again)
        if not again.limit(1).count():
            return all_of
        if n == MAX_ATTEMPTS:
            raise RuntimeError(f"surrogates still collide after {MAX_ATTEMPTS} attempts")
        kept = all_of.join(again.select("kind", "canonical"), ["kind", "canonical"], "left_anti").select("kind", "canonical", "attempt", "new")
        all_of = checkpointed(kept.unionByName(again.mapInArrow(_draw(key), shape)))


def replace_entities(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """docs with surrogates in ``text``, n_entities, and kinds (distinct, sorted)."""
    docs = docs.drop("n_entities", "kinds")
    rest = [c for c in docs.columns if c != text]
    carried = T.StructType([docs.schema[c] for c in rest])
    keyed = docs.select((F.struct(*rest) if rest else F.struct(F.lit(None).cast("string").alias("none"))).alias("row"), F.col(text).alias("text"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))
    found = stored(keyed.mapInArrow(_find, T.StructType([*keyed.schema.fields, T.StructField("spans", T._parse_datatype_string(_SPANS))])), "spans")
    entities = found.select("t1", "t2", F.explode(F.transform("spans", lambda e: F.struct(e["kind"].alias("kind"), e["canonical"].alias("canonical")))).alias("e")).select("t1", "t2", "e.*").distinct()
    special = stored(assigned(entities.select("kind", "canonical").distinct(), key).where("attempt > 0").select("kind", "canonical", "attempt"), "attempts")
    size = special.agg(F.sum(F.octet_length("canonical") + 64)).first()[0] or 0
    lists = entities.join(maybe_broadcast(special, 1, int(size)), ["kind", "canonical"]).groupBy("t1", "t2").agg(F.collect_list(F.struct("kind", "canonical", "attempt")).alias("attempts"))
    lists = stored(lists, "lists")
    size = lists.agg(F.sum(F.aggregate("attempts", F.lit(32).cast("long"), lambda a, x: a + 64 + F.octet_length(x["canonical"])))).first()[0] or 0
    joined = found.join(maybe_broadcast(lists, 1, int(size)), ["t1", "t2"], "left").select("row", "text", "spans", "attempts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, kinds = [], [], []
            for t, spans, special in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "attempts")), strict=True):
                entities = [Entity(**e) for e in spans]
                texts.append(with_surrogates(t, entities, key, {(x["kind"], x["canonical"]): x["attempt"] for x in special or ()}) if entities else t)
                counts.append(len(entities))
                kinds.append(sorted({e.kind for e in entities}))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(kinds, pa.list_(pa.string()))], ["row", "new_text", "n_entities", "kinds"])

    fields = [T.StructField("n_entities", T.LongType()), T.StructField("kinds", T.ArrayType(T.StringType()))]
    done = joined.mapInArrow(run, T.StructType([keyed.schema["row"] if not rest else T.StructField("row", carried), T.StructField("new_text", T.StringType()), *fields]))
    return done.select(*[F.col("new_text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns], "n_entities", "kinds")
