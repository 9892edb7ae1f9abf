"""Format-preserving pseudonyms for personal data, by a keyed Feistel permutation.

A value is found by its format and validated (check digits, ranges, calendar). Its
variable characters form a number of a finite domain; the value is replaced by another one
of the domain, in the same format and length, with check digits made anew. The permutation
depends on the key and the kind alone, so equal values get equal pseudonyms in every
document, different ones stay different, and no value maps to itself: with P the Feistel
permutation, x becomes P(P^-1(x) + 1). Where the format allows fewer values than the
domain, the step is repeated until the format holds.

Kinds: e-mail addresses (the local part), payment cards (Luhn), IBAN (mod 97), US social
security numbers, NANP telephone numbers, IPv4 addresses, dates (1900 to 2099), access keys,
and the values after `token` and `password`.

Defined results: null text stays null, text without a value stays as it is. Rows are
treated each for itself, so repeated rows get equal results; an empty table gives an empty
result. `pseudonymised` keeps all other columns as they are.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.arrays import chunks
from plantpulse.llm.tables import for_python

#: Only for tests and the given tables; a real corpus gets its own secret.
DEFAULT_KEY = b"replace this key"
ROUNDS = 8
DIGITS, HEX = "0123456789", "0123456789abcdef"
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

EMAIL = re.compile(r"(?<![\w.+%-])([A-Za-z0-9][A-Za-z0-9._%+-]*)@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
# These begin with a set of characters, so that the scan skips to those.
FORMATS = [
    r"(?:\+1[ .-]?\(?|1[ .-]\(?)?(?P<area>\d{3})(?:\)[ .-]?|[ .-])(?P<exchange>\d{3})[ .-](?P<line>\d{4})(?!\w)",
    r"(?P<iso>\d{4}-\d{2}-\d{2})(?![\w-])",
    r"(?P<dated>\d{1,2}(?P<sep>[./-])\d{1,2}(?P=sep)\d{4})(?![\w-])",
    r"(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])",
    r"(?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?!\w|\.\d)",
    r"(?P<card>\d(?:[ -]?\d){12,18})(?![\w-])"]
NUMBER = re.compile("|".join(FORMATS))
# For a number that is not valid as `NUMBER` reads it: each format, and cards of each length before another group.
OTHERS = [re.compile(f) for f in FORMATS] + [
    re.compile(rf"(?P<card>\d(?:[ -]?\d){{{k}}})(?!\w|-(?!\d))") for k in range(17, 11, -1)]
# Cards are written in groups of three digits or more, but for the last.
CARD_GROUPS = re.compile(r"(?:\d{3,}[ -])*\d+")
NUMBER_START = re.compile(r"[+0-9]")
IBAN = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
ACCESS = re.compile(r"(?<!\w)(?:AKIA|ASIA)([A-Z0-9]{16})(?!\w)")
SECRET = re.compile(r"(?i:(?<![A-Za-z])(?P<name>password|passwd|secret|api[_-]?key|token)(?P<mark>\s*[=:]\s*[\"']?))(?P<value>[A-Za-z0-9_+/.-]{5,}[A-Za-z0-9_+/])")


class Permutation:
    """A keyed permutation of 0 .. size-1 without fixed points, by a Feistel network on two mixed digits."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.key = hashlib.blake2b(f"{kind}:{size}".encode(), key=key[:64], digest_size=32).digest()
        self.size = size
        self.high = max(1, math.isqrt(max(0, size - 1)) + 1)
        self.low = -(-size // self.high)

    def _round(self, number: int, value: int) -> int:
        raw = value.to_bytes((value.bit_length() + 7) // 8 or 1, "little")
        width = (self.high.bit_length() + 7) // 8 + 16
        return int.from_bytes(hashlib.shake_128(self.key + bytes([number]) + raw).digest(width), "little")

    def _forward(self, x: int) -> int:
        a, b = divmod(x, self.low)
        for k in range(ROUNDS):
            if k % 2:
                b = (b + self._round(k, a)) % self.low
            else:
                a = (a + self._round(k, b)) % self.high
        return a * self.low + b

    def _backward(self, x: int) -> int:
        a, b = divmod(x, self.low)
        for k in reversed(range(ROUNDS)):
            if k % 2:
                b = (b - self._round(k, a)) % self.low
            else:
                a = (a - self._round(k, b)) % self.high
        return a * self.low + b

    def _walk(self, step: Callable[[int], int], x: int) -> int:
        x = step(x)
        while x >= self.size:  # the two digits span a little more than the domain
            x = step(x)
        return x

    def __call__(self, x: int) -> int:
        return self._walk(self._forward, (self._walk(self._backward, x) + 1) % self.size)


def spell(text: str, alphabets: list[str], key: bytes, kind: str,
          valid: Callable[[str], bool] = lambda _: True) -> str:
    """Replace characters that belong to the alphabet at their place; the others stay."""
    places = [k for k, a in enumerate(alphabets) if a]
    size = math.prod(len(alphabets[k]) for k in places)
    if size < 2:
        return text
    permute = Permutation(key, kind, size)
    x = 0
    for k in places:
        x = x * len(alphabets[k]) + alphabets[k].index(text[k])
    while True:
        x = permute(x)
        out, rest = list(text), x
        for k in reversed(places):
            rest, digit = divmod(rest, len(alphabets[k]))
            out[k] = alphabets[k][digit]
        if valid("".join(out)):
            return "".join(out)


def is_hex(text: str) -> bool:
    return len(text) >= 16 and all(c in HEX for c in text)


def spell_by_class(text: str, key: bytes, kind: str) -> str:
    """Hexadecimal stays so; otherwise digits, small and capital letters keep their places."""
    if is_hex(text):
        return spell(text, [HEX] * len(text), key, kind + "-hex")
    alphabets = [next((a for a in (DIGITS, LOWER, UPPER) if c in a), "") for c in text]
    return spell(text, alphabets, key, kind, lambda out: not is_hex(out))


def luhn(digits: str) -> int:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10


def refill(shape: str, digits: str) -> str:
    """`shape` with its digits replaced in order."""
    source = iter(digits)
    return "".join(next(source) if c.isdigit() else c for c in shape)


def card(value: str, key: bytes) -> str | None:
    """The first digit names the network and stays; the last is the check digit."""
    digits = "".join(c for c in value if c.isdigit())
    if luhn(digits) or len(set(digits)) == 1:
        return None
    body = spell(digits[:-1], ["", *[DIGITS] * (len(digits) - 2)], key, "card")
    check = (10 - luhn(body + "0")) % 10
    return refill(value, body + str(check))


def iban_sum(value: str) -> int:
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


def iban(value: str, key: bytes) -> str | None:
    plain = value.replace(" ", "")
    if not 15 <= len(plain) <= 34 or iban_sum(plain) != 1:
        return None
    body = spell(plain[4:], [DIGITS if c.isdigit() else UPPER for c in plain[4:]], key, "iban" + plain[:2])
    check = 98 - iban_sum(plain[:2] + "00" + body)
    fresh = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(fresh) for c in value)


def ssn_valid(value: str) -> bool:
    return value[:3] not in ("000", "666") and value[0] != "9" and value[4:6] != "00" and value[7:] != "0000"


def octets_valid(value: str) -> bool:
    return all(int(o) <= 255 and (len(o) == 1 or o[0] != "0") for o in value.split("."))


_DAY_ONE = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _DAY_ONE


def date(value: str, parts: tuple[int, int, int], render: Callable[[datetime.date], str], key: bytes) -> str | None:
    try:
        day = datetime.date(*parts).toordinal() - _DAY_ONE
    except ValueError:
        return None
    if not 0 <= day < _DAYS or render(datetime.date.fromordinal(day + _DAY_ONE)) != value:
        return None
    permute = Permutation(key, "date", _DAYS)
    while True:
        day = permute(day)
        out = render(datetime.date.fromordinal(day + _DAY_ONE))
        if len(out) == len(value):
            return out


def number(m: re.Match, key: bytes) -> tuple[str, str] | None:
    """Kind and pseudonym of a match of `NUMBER`; none if it is not valid."""
    value = m.group()
    if m.start() and (m.string[m.start() - 1].isalnum() or m.string[m.start() - 1] in "_.-" or
                      (m.string[m.start() - 1] == "+" and not m.groupdict().get("area"))):
        return None
    kind, out, shape = None, None, m.groupdict().get
    if shape("area"):
        digits = m["area"] + m["exchange"] + m["line"]
        fits = lambda d: d[0] > "1" and d[3] > "1"
        # After "+1 (" the shape alone tells a telephone number; those outside the plan stay outside.
        if fits(digits) or re.match(r"\+1[ .-]?\(", value):
            of = ("phone", fits) if fits(digits) else ("phone-shape", lambda d: not fits(d))
            kind, out = "phone", spell(digits, [DIGITS] * 10, key, *of)
            # A leading country code is no part of the number.
            head = m.start("area") - m.start()
            out = value[:head] + refill(value[head:], out)
    elif shape("iso"):
        y, mo, d = map(int, value.split("-"))
        kind, out = "date", date(value, (y, mo, d), datetime.date.isoformat, key)
    elif shape("dated"):
        sep = m["sep"]
        a, b, y = value.split(sep)
        pad_a, pad_b = len(a) == 2, len(b) == 2
        day_first = int(b) <= 12
        parts = (int(y), int(b), int(a)) if day_first else (int(y), int(a), int(b))

        def render(x: datetime.date) -> str:
            one, two = (x.day, x.month) if day_first else (x.month, x.day)
            return f"{one:0{1 + pad_a}d}{sep}{two:0{1 + pad_b}d}{sep}{x.year:04d}"

        kind, out = "date", date(value, parts, render, key)
    elif shape("ssn"):
        if ssn_valid(value):
            kind, out = "ssn", spell(value, [DIGITS if c != "-" else "" for c in value], key, "ssn", ssn_valid)
    elif shape("ip"):
        if octets_valid(value):
            kind, out = "ip", spell(value, [DIGITS if c != "." else "" for c in value], key, "ip", octets_valid)
    else:
        kind, out = "card", card(value, key)
    return (kind, out) if out else None


def number_at(text: str, begin: int, failed: int, key: bytes) -> tuple[tuple[str, str] | None, int]:
    """Kind and pseudonym of the number that begins here, if one is valid, and its end; else the end of the longest.

    Digits up to `failed` belong to a longer number that was not valid. What is found in
    such a number, or is a part of one, is a card only if its groups are those of cards.
    """
    m = NUMBER.match(text, begin)
    if not m:
        return None, begin
    first = m
    if begin >= failed or not m.groupdict()["card"] or CARD_GROUPS.fullmatch(m.group()):
        if got := number(m, key):
            return got, m.end()
    for other in OTHERS:
        m = other.match(text, begin)
        if m and m.span() != first.span() and ("card" not in m.groupdict() or CARD_GROUPS.fullmatch(m.group())):
            if got := number(m, key):
                return got, m.end()
    return None, first.end()


def replaced(text: str, key: bytes = DEFAULT_KEY) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and kind, begin and end of each (characters; lengths stay)."""
    found: list[tuple[int, int, str, str]] = []

    def note(kind: str, begin: int, end: int, fresh: str) -> None:
        found.append((begin, end, kind, fresh))

    if "@" in text:
        for m in EMAIL.finditer(text):
            note("email", m.start(1), m.end(1), spell_by_class(m[1], key, "email"))
    if "AKIA" in text or "ASIA" in text:
        for m in ACCESS.finditer(text):
            note("access_key", m.start(1), m.end(1), spell(m[1], [DIGITS + UPPER] * 16, key, "access"))
    for m in SECRET.finditer(text) if "=" in text or ":" in text else ():
        # After a colon ordinary words may follow; a secret there has a digit.
        if "=" in m["mark"] or any(c.isdigit() for c in m["value"]):
            note("secret", *m.span("value"), spell_by_class(m["value"], key, "secret"))
    for m in IBAN.finditer(text):
        inside = m.start() and (text[m.start() - 1].isalnum() or text[m.start() - 1] == "_")
        if not inside and (fresh := iban(m.group(), key)):
            note("iban", *m.span(), fresh)
    at = failed = 0
    while begin := NUMBER_START.search(text, at):
        got, end = number_at(text, begin.start(), failed, key)
        if got:
            note(got[0], begin.start(), end, got[1])
        else:
            failed = max(failed, end)
        # Past the value, or past this run of digits: a value may begin within a number that is not valid.
        at = end if got else begin.end()
        while not got and at < len(text) and text[at - 1] in DIGITS and text[at] in DIGITS:
            at += 1
    if not found:
        return text, []
    found.sort(key=lambda f: (f[0], -f[1]))
    out, spans, done = [], [], 0
    for begin, end, kind, fresh in found:
        if begin >= done:
            out += [text[done:begin], fresh]
            spans.append((kind, begin, end))
            done = end
    return "".join(out) + text[done:], spans


FOUND = "array<struct<kind:string,begin:int,end:int>>"


def pseudonyms(docs: DataFrame, key: bytes = DEFAULT_KEY) -> DataFrame:
    """doc_id, text, n_values and found (kind, begin, end) of every row."""
    spans = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = [], []
            for t in batch.column("text").to_pylist():
                out, where = (None, []) if t is None else replaced(t, key)
                texts.append(out)
                found.append([{"kind": k, "begin": a, "end": b} for k, a, b in where])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array([len(f) for f in found], pa.int64()),
                 pa.array(found, spans)], ["doc_id", "text", "n_values", "found"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return for_python(rows).mapInArrow(run, f"doc_id long, text string, n_values long, found {FOUND}")


def pseudonymised(docs: DataFrame, key: bytes = DEFAULT_KEY) -> DataFrame:
    """`docs` with pseudonyms in the column `text`; all other columns as they were."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = [None if t is None else replaced(t, key)[0] for t in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return for_python(docs).mapInArrow(run, docs.schema)
