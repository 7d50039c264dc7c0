"""Personal data as format-preserving pseudonyms.

Values are found by pattern and validated (check digits, ranges, the calendar). A valid
value is numbered within the set of all values of its format, the number goes through a
keyed Feistel permutation of that set, and the value with the new number takes its place.
So the text keeps its form and length, a card number still passes its check, a date is
still a date, equal values get equal pseudonyms in every document and run with the same
key, and different values different ones. Without the key nothing leads back.

A permutation may map a value to itself, with a chance of one in the size of the set
(tens of thousands of dates, billions of addresses).

Dates are yyyy-mm-dd, yyyy/mm/dd, dd/mm/yyyy, mm/dd/yyyy and dd.mm.yyyy, days and months
with one digit or two, of the years 1900 to 2099; a time may follow after a T and stays.
Dates of other years stay as they are.

Values of any length are permuted. Beyond 64 letters and digits they are taken in blocks of
64, each under a key that depends on all blocks before it, and then once more from the end,
so every character of the pseudonym depends on every one of the value, in linear time. Patterns
pass over a text without going back, so very long texts, words and runs take linear time too.

Nulls stay null and empty texts empty; an empty table gives an empty one. Text outside the
values found is left as it is. Repeated rows stay, and so do other columns, whatever their
names. Letters keep their case; values that differ only in case stay linked.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import date
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from seedloom.llm.frames import with_new

ROUNDS = 10
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()

#: Alphabets of characters that change places among themselves, all in lower case.
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ACCENTED = "".join(chr(c) for c in range(0xE0, 0x100) if c not in (0xF7, 0xFF))
HEX = "0123456789abcdef"


class Permutation:
    """Keyed permutations of whole numbers below any size: Feistel rounds, walked until inside."""

    def __init__(self, key: bytes):
        if not key:
            raise ValueError("a key is needed")
        self.key = len(key).to_bytes(4, "big") + key

    def __call__(self, kind: str, number: int, size: int) -> int:
        if size < 2:
            return number
        width = ((size - 1).bit_length() + 1) // 2
        while True:
            number = self._rounds(kind, number, width, size)
            if number < size:
                return number

    def _rounds(self, kind: str, number: int, width: int, size: int) -> int:
        mask, n_bytes = (1 << width) - 1, (width + 7) // 8
        left, right = number >> width, number & mask
        tweak = self.key + f"{kind}|".encode() + size.to_bytes((size.bit_length() + 7) // 8, "big") + b"|"
        for turn in range(ROUNDS):
            mixed = hashlib.shake_256(tweak + bytes([turn]) + right.to_bytes(n_bytes, "big")).digest(n_bytes)
            left, right = right, left ^ (int.from_bytes(mixed, "big") & mask)
        return left << width | right


def alphabet_of(char: str, alphabets: tuple[str, ...]) -> str | None:
    return next((a for a in alphabets if char in a), None)


#: Characters that are permuted as one number; longer values are taken block by block.
PLACES = 64


def permute_block(permute: Permutation, kind: str, indexes: list[int], bases: list[int]) -> list[int]:
    """The indexes, each below its base, permuted together as one number."""
    number, size = 0, 1
    for index, base in zip(indexes, bases):
        number = number * base + index
        size *= base
    number, out = permute(kind, number, size), []
    for base in reversed(bases):
        number, index = divmod(number, base)
        out.append(index)
    return out[::-1]


def permute_indexes(permute: Permutation, kind: str, indexes: list[int], bases: list[int]) -> list[int]:
    """The indexes permuted together; many of them block by block, forwards and then backwards."""
    if len(indexes) <= PLACES:
        return permute_block(permute, kind, indexes, bases)
    starts = range(0, len(indexes), PLACES)
    for turn, order in enumerate((starts, reversed(starts))):
        before = hashlib.sha256(f"{kind}|{turn}|{len(indexes)}|".encode())
        for at in order:
            block = slice(at, at + PLACES)
            indexes[block] = permute_block(permute, f"{kind}|{before.hexdigest()}", indexes[block], bases[block])
            before.update(bytes(indexes[block]))
    return indexes


def permute_text(permute: Permutation, kind: str, value: str, alphabets: tuple[str, ...]) -> str:
    """Each character replaced within its alphabet, all of them together; others stay."""
    lower = [char.lower() if len(char.lower()) == 1 else char for char in value]
    places = [(at, alphabet_of(char, alphabets)) for at, char in enumerate(lower)]
    places = [(at, alphabet) for at, alphabet in places if alphabet]
    taken = {at for at, _ in places}
    form = "".join("?" if at in taken else char for at, char in enumerate(lower))
    shape = "".join(str(alphabets.index(alphabet)) for _, alphabet in places)
    if len(value) > PLACES:  # the form is part of every block's key
        form, shape = hashlib.sha256(form.encode()).hexdigest(), hashlib.sha256(shape.encode()).hexdigest()
    indexes = [alphabet.index(lower[at]) for at, alphabet in places]
    indexes = permute_indexes(permute, f"{kind}|{form}|{shape}", indexes, [len(alphabet) for _, alphabet in places])
    out, all_upper = list(value), value.isupper()
    for (at, alphabet), index in zip(places, indexes):
        new = alphabet[index]
        out[at] = new.upper() if (all_upper or value[at].isupper()) and len(new.upper()) == 1 else new
    return "".join(out)


def fill_digits(form: str, digits: str) -> str:
    """The digits put, in order, where the form has digits."""
    left = iter(digits)
    return "".join(next(left) if char in DIGITS else char for char in form)


def only_digits(value: str) -> str:
    return "".join(char for char in value if char in DIGITS)


# --- cards -------------------------------------------------------------------


def luhn_digit(body: str) -> str:
    """The check digit that follows the digits of a card number."""
    total = 0
    for at, char in enumerate(reversed(body)):
        doubled = int(char) * (2 if at % 2 == 0 else 1)
        total += doubled // 10 + doubled % 10
    return str(-total % 10)


def has_issuer(digits: str) -> bool:
    """Numbers of payment cards begin with 3 to 6, or with 2221 to 2720."""
    return digits[0] in "3456" or "2221" <= digits[:4] <= "2720"


def card_like(digits: str) -> bool:
    return has_issuer(digits) and len(set(digits)) > 1


def valid_card(match: re.Match) -> bool:
    digits = only_digits(match.group())
    return 13 <= len(digits) <= 19 and card_like(digits) and luhn_digit(digits[:-1]) == digits[-1]


def new_card(permute: Permutation, value: str) -> str:
    """Another number that a card can have, walked to as numbers below a size are; others stay others."""
    body = only_digits(value)[:-1]
    like = card_like(body + luhn_digit(body))
    while True:
        body = permute_text(permute, "card", body, (DIGITS,))
        if card_like(body + luhn_digit(body)) == like:
            return fill_digits(value, body + luhn_digit(body))


# --- bank accounts -----------------------------------------------------------


#: Lengths of account numbers by country, check digits and country code included.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def iban_rest(country: str, check: str, account: str) -> int:
    return int("".join(str(int(char, 36)) for char in account + country + check)) % 97


def iban_parts(value: str) -> tuple[str, str, str]:
    plain = value.replace(" ", "").upper()
    return plain[:2], plain[2:4], plain[4:]


def valid_iban(match: re.Match) -> bool:
    country, check, account = iban_parts(match.group())
    return 11 <= len(account) <= 30 and iban_rest(country, check, account) == 1


def own_length(match: re.Match) -> int:
    """Where the number ends by its country's length; words after it may look like a part of it."""
    value, length = match.group(), IBAN_LENGTHS.get(match.group()[:2], 0)
    breaks = [at for at, char in enumerate(value) if char == " "] + [len(value)]
    return match.start() + next((at for at in breaks if at - value.count(" ", 0, at) == length), 0)


def find_ibans(pattern: re.Pattern, text: str) -> list[re.Match]:
    """Valid numbers of their country's length, and between these whatever else passes the check as a whole."""
    found: list[re.Match] = []
    for end_of in (own_length, re.Match.end):
        spans = [(m.start(), m.end(), "\0" * (m.end() - m.start())) for m in found]
        left, at = splice(text, spans), 0
        while match := pattern.search(left, at):
            part = pattern.fullmatch(left, match.start(), end_of(match))
            valid = part and valid_iban(part)
            if valid:
                found.append(part)
            at = part.end() if valid else match.start() + 1  # an invalid match may cover a valid one
    return sorted(found, key=re.Match.start)


def new_iban(permute: Permutation, value: str) -> str:
    country, _, account = iban_parts(value)
    account = permute_text(permute, f"iban|{country}", account, (DIGITS, LETTERS))
    check = f"{98 - iban_rest(country, '00', account):02d}"
    left = iter(country + check + account)
    return "".join(char if char == " " else next(left) for char in value)


# --- other numbers -----------------------------------------------------------


def valid_address(match: re.Match) -> bool:
    return all(int(part) < 256 and str(int(part)) == part for part in match.group().split("."))


def new_address(permute: Permutation, value: str) -> str:
    number = int.from_bytes(bytes(map(int, value.split("."))), "big")
    return ".".join(map(str, permute("address", number, 1 << 32).to_bytes(4, "big")))


def valid_social(match: re.Match) -> bool:
    area, group, serial = match.group().split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def new_social(permute: Permutation, value: str) -> str:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = map(int, value.split("-"))
    number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    number, serial = divmod(permute("social", number, 898 * 99 * 9999), 9999)
    area, group = divmod(number, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


def valid_phone(match: re.Match) -> bool:
    return 8 <= len(only_digits(match.group())) <= 15


def new_phone(permute: Permutation, value: str) -> str:
    """The country code after a plus stays."""
    code = re.match(r"\+\d{1,3}(?=[ .()-])", value)
    code = code.group() if code else ""
    digits = permute_text(permute, f"phone|{code}", only_digits(value[len(code):]), (DIGITS,))
    return code + fill_digits(value[len(code):], digits)


# --- dates -------------------------------------------------------------------

ORDERS = {"-": ("ymd",), "/": ("dmy", "mdy"), ".": ("dmy",)}


def day_of(parts: list[str], order: str) -> date | None:
    named = dict(zip(order, map(int, parts)))
    try:
        found = date(named["y"], named["m"], named["d"])
    except ValueError:
        return None
    return found if FIRST_DAY <= found.toordinal() <= LAST_DAY else None


def read_date(value: str) -> tuple[str, str, date] | None:
    """Separator, order of parts and day; day before month where both would do."""
    sign = next(char for char in value if char not in DIGITS)
    parts = value.split(sign)
    for order in ("ymd",) if len(parts[0]) == 4 else ORDERS[sign]:
        day = day_of(parts, order)
        if day:
            return sign, order, day
    return None


def write_date(sign: str, order: str, day: date, widths: list[int]) -> str:
    named = {"y": day.year, "m": day.month, "d": day.day}
    return sign.join(f"{named[part]:0{width}d}" for part, width in zip(order, widths))


def valid_date(match: re.Match) -> bool:
    return read_date(match.group()) is not None


def new_date(permute: Permutation, value: str) -> str:
    """Another day of 1900 to 2099 that reads in the same order of parts, each as wide as before."""
    sign, order, day = read_date(value)
    widths = [len(part) for part in value.split(sign)]
    number = day.toordinal() - FIRST_DAY
    while True:
        number = permute("date", number, LAST_DAY - FIRST_DAY + 1)
        new = write_date(sign, order, date.fromordinal(FIRST_DAY + number), widths)
        if len(new) == len(value) and read_date(new)[1] == order:
            return new


# --- names of places to write to, and secrets --------------------------------


def valid_always(match: re.Match) -> bool:
    return True


def new_email(permute: Permutation, value: str) -> str:
    """The name and each part of the domain for itself, so equal domains stay linked; the last part stays."""
    name, _, domain = value.rpartition("@")
    *parts, last = domain.split(".")
    alphabets = (DIGITS, LETTERS, ACCENTED)
    parts = [permute_text(permute, "domain", part, alphabets) for part in parts]
    return permute_text(permute, f"name|{domain.lower()}", name, alphabets) + "@" + ".".join([*parts, last])


def new_secret(permute: Permutation, value: str) -> str:
    if all(char in HEX for char in value.lower()):
        return permute_text(permute, "hex", value, (HEX,))
    return permute_text(permute, "secret", value, (DIGITS, LETTERS))


@dataclass(frozen=True)
class Kind:
    """A kind of value: what it looks like, a sign any text with one has, a check, and its pseudonym."""

    name: str
    pattern: re.Pattern
    hint: re.Pattern
    valid: Callable[[re.Match], bool]
    new: Callable[[Permutation, str], str]
    #: Finds the valid matches where one pass over the pattern's matches is not enough.
    find: Callable[[re.Pattern, str], list[re.Match]] | None = None

    def values(self, text: str) -> Iterable[re.Match]:
        return self.find(self.pattern, text) if self.find else filter(self.valid, self.pattern.finditer(text))


_DIGIT, _AT = re.compile("[0-9]"), re.compile("@")
#: Every secret follows one of these signs, begins with a known mark, or is a run of 40 hexadecimal digits.
_SECRET = re.compile(r"[:=]|AKIA|gh[pousr]_|sk-|[0-9a-f]{40}|[0-9A-F]{40}")
#: In order of precedence: what an earlier kind has taken is out of reach of a later one.
KINDS = (
    Kind(
        "secret",
        re.compile(
            r"""(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b["']?\s*[:=]\s*["']?)"""
            r"(?P<value>[A-Za-z0-9_+/-]{16,})|\b(?P<hex>(?:[0-9a-f]{40}|[0-9A-F]{40}|[0-9a-f]{64}|[0-9A-F]{64}))\b"
            r"|\b(?P<known>(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}))\b"
        ),
        _SECRET, valid_always, new_secret,
    ),
    Kind(
        "email", re.compile(r"(?<![\w.+%-])[\w.+%-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}"), _AT, valid_always, new_email
    ),
    Kind(
        "iban", re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"), _DIGIT, valid_iban,
        new_iban, find_ibans,
    ),
    Kind(
        "address", re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9])"), _DIGIT, valid_address,
        new_address,
    ),
    Kind("social", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"), _DIGIT, valid_social, new_social),
    Kind(
        "date",
        re.compile(
            r"(?<![\w./-])(?:[0-9]{4}([-/])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([/.])[0-9]{1,2}\2[0-9]{4})"
            r"(?:(?=T[0-9]{2})|(?![\w/-]|\.[0-9]))"
        ),
        _DIGIT, valid_date, new_date,
    ),
    Kind(
        "phone",
        re.compile(
            r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?\([0-9]{1,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}"
            r"|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}"
            r"|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?!\w)"
        ),
        _DIGIT, valid_phone, new_phone,
    ),
    Kind(
        "card",
        re.compile(
            r"(?<!\w)(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?!\w)"
        ),
        _DIGIT, valid_card, new_card,
    ),
)


class Pseudonyms:
    """Replaces the values of a text; keeps the last pseudonyms it made."""

    def __init__(self, key: bytes, kinds: tuple[Kind, ...] = KINDS):
        self.permute, self.kinds = Permutation(key), kinds
        self.new = lru_cache(maxsize=50_000)(lambda at, value: kinds[at].new(self.permute, value))

    def replace(self, text: str) -> tuple[str, list[int]]:
        """The text with pseudonyms, and how many values of each kind it had."""
        found: list[tuple[int, int, str]] = []
        counts, masked = [0] * len(self.kinds), text
        for at, kind in enumerate(self.kinds):
            if not kind.hint.search(text):
                continue
            spans = []
            for match in kind.values(masked):
                group = next((name for name, value in match.groupdict().items() if value), 0)
                spans.append(match.span(group))
            found += [(begin, end, self.new(at, text[begin:end])) for begin, end in spans]
            if spans:
                masked = splice(masked, [(begin, end, "\0" * (end - begin)) for begin, end in spans])
            counts[at] = len(spans)
        return (splice(text, sorted(found)) if found else text), counts


def splice(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with spans, in order and apart from each other, replaced."""
    parts, at = [], 0
    for begin, end, new in spans:
        parts += [text[at:begin], new]
        at = end
    return "".join([*parts, text[at:]])


def _pseudonymized(key: bytes) -> Callable[[Column], Column]:
    names = [kind.name for kind in KINDS]
    schema = StructType([StructField("text", StringType()), *[StructField(f"n_{name}", LongType()) for name in names]])

    @F.arrow_udf(schema)
    def replaced(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Pseudonyms(key)
        for texts in batches:
            done = [(None, [0] * len(names)) if text is None else own.replace(text) for text in texts.to_pylist()]
            columns = [pa.array([text for text, _ in done], pa.string())]
            columns += [pa.array([counts[i] for _, counts in done], pa.int64()) for i in range(len(names))]
            yield pa.StructArray.from_arrays(columns, names=["text", *[f"n_{name}" for name in names]])

    return replaced


def pseudonymize(df: DataFrame, key: bytes, text: str = "text", found: str | None = "found") -> DataFrame:
    """The rows with pseudonyms in their text and, if ``found`` is given, a struct of counts by kind."""
    done, name = with_new(df, "replaced", _pseudonymized(key)(F.col(text).cast("string")))
    if found:
        done = done.withColumn(found, F.struct(*[F.col(f"{name}.n_{k.name}").alias(k.name) for k in KINDS]))
    return done.withColumn(text, F.col(f"{name}.text")).drop(name)
