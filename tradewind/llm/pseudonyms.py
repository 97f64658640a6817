"""Format-preserving pseudonyms of personal data by a keyed Feistel permutation.

Payment cards (Luhn), telephone numbers, social security numbers, IPv4 addresses, IBANs (mod 97), calendar dates and e-mail names
are found, validated, and permuted inside the set of values of their own kind: a valid card becomes a valid card of the same length and layout,
a date a date. The permutation depends on the key, the kind and the value only, so equal values get equal pseudonyms in
every document, however they are written, and the owner of the key can undo it.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import string
from bisect import bisect_left
from collections.abc import Callable
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
_FIRST_DAY, _LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

# Layouts of the kinds. Where several fit at one place, the first does.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "date": r"(?<![\w.+/-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![\w/-]|\.[0-9])",
    "ssn": r"(?<![\w.+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+1[ .-]?|1[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])|(?<![\w+])\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,5}\)?){2,5}(?!\w)",
    "ip": r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9])",
    "iban": r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w.+-])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![\w-])",
}
KINDS = sorted(PATTERNS)
_EMAIL = re.compile(PATTERNS["email"])
_IBAN = re.compile(PATTERNS["iban"])
_NUMBER = re.compile("|".join(f"(?P<{kind}>{PATTERNS[kind].replace('([ -])', '(?P<gap>[ -])').replace(chr(92) + '1', '(?P=gap)')})" for kind in ("date", "ssn", "phone", "ip", "card")))


def permute(value: int, size: int, key: bytes, tweak: str, inverse: bool = False) -> int:
    """A keyed permutation of range(size): Feistel rounds on two digits of base ceil(sqrt(size)), repeated until inside the range."""
    if size < 2:
        return value
    base = isqrt(size - 1) + 1
    while True:
        left, right = divmod(value, base)
        for i in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            if inverse:
                left, right = (right - _round(key, tweak, i, left)) % base, left
            else:
                left, right = right, (left + _round(key, tweak, i, right)) % base
        value = left * base + right
        if value < size:
            return value


def _round(key: bytes, tweak: str, i: int, half: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{tweak}|{i}|{half}".encode(), key=key, digest_size=16).digest(), "big")


def luhn(digits: str) -> int:
    """Luhn sum modulo 10; 0 for a valid number."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10


def _into(layout: str, digits: str) -> str:
    """Digits in the places that hold digits in ``layout``."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in layout)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _card(text: str, move: Callable) -> str | None:
    digits = _digits(text)
    if luhn(digits) or len(set(digits)) == 1:
        return None
    size = 10 ** (len(digits) - 2)
    body = digits[0] + f"{move(int(digits[1:-1]), size, 'card' + digits[0] + str(len(digits))):0{len(digits) - 2}d}"
    return _into(text, body + str((10 - luhn(body + "0")) % 10))


def _national(n: int) -> str:
    """The n-th North American number: area and exchange start with 2 to 9."""
    area, rest = divmod(n, 800 * 10_000)
    return f"{area + 200}{rest // 10_000 + 200}{rest % 10_000:04d}"


def _in_plan(digits: str) -> bool:
    return digits[0] not in "01" and digits[3] not in "01"


def _phone(text: str, move: Callable) -> str | None:
    digits = _digits(text)
    if len(digits) == 10 or len(digits) == 11 and digits[0] == "1":
        own = digits[-10:]
        if not _in_plan(own):
            # Outside the numbering plan, only the layout tells a telephone number; it moves among others like it.
            if text[0] not in "+(" and len(digits) == 10:
                return None
            while True:
                own = f"{move(int(own), 10**10, 'phone-other'):010d}"
                if not _in_plan(own):
                    return _into(text, digits[:-10] + own)
        n = ((int(own[:3]) - 200) * 800 + int(own[3:6]) - 200) * 10_000 + int(own[6:])
        return _into(text, digits[:-10] + _national(move(n, 800 * 800 * 10_000, "phone")))
    if not text.startswith("+") or not 8 <= len(digits) <= 15 or digits[0] == "1":
        return None
    return _into(text, digits[:2] + f"{move(int(digits[2:]), 10 ** (len(digits) - 2), 'phone' + digits[:2] + str(len(digits))):0{len(digits) - 2}d}")


def _ssn(text: str, move: Callable) -> str | None:
    areas = [*range(1, 666), *range(667, 900)]
    area, group, serial = map(int, text.split("-"))
    if area not in areas or not group or not serial:
        return None
    n = move((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, len(areas) * 99 * 9999, "ssn")
    return f"{areas[n // (99 * 9999)]:03d}-{n // 9999 % 99 + 1:02d}-{n % 9999 + 1:04d}"


def _ip(text: str, move: Callable) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    n = move(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ip")
    return ".".join(map(str, n.to_bytes(4, "big")))


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


#: Lengths of IBANs by country, from the registry.
IBAN_LENGTHS = {
    country: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "GI IL IQ OM SO TL", 24: "AD AE CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def _iban_starts(text: str) -> list[str]:
    """What may be an IBAN in a match of the pattern, which takes in short words and numbers that follow.

    The match up to each of its spaces: first that of the country's length, so that a word behind can not pass for a part of it;
    then the others, longest first.
    """
    ends = [i for i, c in enumerate(text) if c == " "] + [len(text)]
    starts = [text[:end] for end in reversed(ends)]
    return sorted(starts, key=lambda s: len(s) - s.count(" ") != IBAN_LENGTHS.get(text[:2]))


def _iban(text: str, move: Callable) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain) != 1:
        return None
    body = _string(plain[4:], "iban" + plain[:2], move)
    check = f"{98 - _mod97(plain[:2] + '00' + body):02d}"
    rest = iter(plain[:2] + check + body)
    return "".join(c if c == " " else next(rest) for c in text)


def _string(text: str, tweak: str, move: Callable) -> str:
    """Letters and digits permuted together within their classes and places."""
    sets = [next((s for s in (string.digits, string.ascii_lowercase, string.ascii_uppercase) if c in s), c) for c in text]
    n, size = 0, 1
    for c, s in zip(text, sets):
        n, size = n * len(s) + s.index(c), size * len(s)
    n = move(n, size, tweak + "|" + "".join(s[0] for s in sets))
    out = []
    for s in reversed(sets):
        n, at = divmod(n, len(s))
        out.append(s[at])
    return "".join(reversed(out))


@lru_cache
def _days(short_month: bool, short_day: bool, rule: str) -> list[int]:
    """Days of the span that can be written with a one-digit month or day; rule: any, early (day up to 12) or late."""
    days = map(datetime.date.fromordinal, range(_FIRST_DAY, _LAST_DAY + 1))
    fits = {"any": lambda d: True, "early": lambda d: d <= 12, "late": lambda d: d > 12}[rule]
    return [d.toordinal() for d in days if fits(d.day) and not (short_month and d.month > 9) and not (short_day and d.day > 9)]


def _date(text: str, move: Callable) -> str | None:
    """Year first with hyphens, day first with dots; with slashes month first, or day first where only that is a date.

    A date moves among those that are read the same way in its layout, so the result can be read back.
    """
    sep = next(c for c in text if not c.isdigit())
    parts = text.split(sep)
    month_at, day_at = {"-": (1, 2), ".": (1, 0), "/": (0, 1)}[sep]
    rule = "any"
    if sep == "/":
        if int(parts[0]) > 12:
            month_at, day_at = 1, 0
        rule = "late" if int(parts[day_at]) > 12 else "early"
    year = int(parts[0 if sep == "-" else 2])
    try:
        n = datetime.date(year, int(parts[month_at]), int(parts[day_at])).toordinal()
    except ValueError:
        return None
    short = len(parts[month_at]) == 1, len(parts[day_at]) == 1
    days = _days(*short, rule)
    at = bisect_left(days, n)
    if at == len(days) or days[at] != n:
        return None
    new = datetime.date.fromordinal(days[move(at, len(days), f"date{short}{rule}")])
    parts[0 if sep == "-" else 2] = f"{new.year:04d}"
    parts[month_at] = str(new.month).zfill(len(parts[month_at]))
    parts[day_at] = str(new.day).zfill(len(parts[day_at]))
    return sep.join(parts)


def _email(text: str, move: Callable) -> str | None:
    """One pseudonym per mailbox however it is written; capitals stay where they are."""
    name, at, host = text.rpartition("@")
    new = _string(name.lower(), "email" + host.lower(), move)
    return "".join(c.upper() if old.isupper() else c for c, old in zip(new, name)) + at + host


_KINDS = {"email": _email, "date": _date, "ssn": _ssn, "phone": _phone, "ip": _ip, "iban": _iban, "card": _card}


class Pseudonyms:
    """Replaces the values of a text; the same key with ``inverse`` restores it."""

    def __init__(self, key: bytes, inverse: bool = False):
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.inverse = inverse
        self.of = lru_cache(maxsize=100_000)(self._of)

    def _of(self, kind: str, text: str) -> str | None:
        return _KINDS[kind](text, lambda n, size, tweak: permute(n, size, self.key, tweak, self.inverse))

    def replace(self, text: str) -> tuple[str, list[str]]:
        """The text with pseudonyms, and the kind of each value that was replaced, in no particular order."""
        kinds: list[str] = []

        def found(kind: str, m: re.Match) -> str:
            new = self.of(kind, m.group())
            if new is None:
                return m.group()
            kinds.append(kind)
            return new

        # Mailboxes and IBANs keep their length; nothing is searched for inside the pseudonym of another kind.
        spans: list[tuple[int, int]] = []

        def email(m: re.Match) -> str:
            spans.append(m.span())
            return found("email", m)

        if "@" in text:
            text = _EMAIL.sub(email, text)
        if any(c in text for c in string.digits):
            text, ibans = self._ibans(text, kinds, spans)
            out, at = [], 0
            for first, last in [*sorted(spans + ibans), (len(text), len(text))]:
                for m in _NUMBER.finditer(text, at, first):
                    out += [text[at : m.start()], found(m.lastgroup if m.lastgroup != "gap" else "card", m)]
                    at = m.end()
                out.append(text[at:last])
                at = last
            text = "".join(out)
        return text, kinds

    def _ibans(self, text: str, kinds: list[str], taken: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
        """The text with pseudonyms for its IBANs outside the places ``taken``, and their places."""
        out, spans, done, at = [], [], 0, 0
        for first, last in [*taken, (len(text), len(text))]:
            while m := _IBAN.search(text, at, first):
                for own in _iban_starts(m.group()):
                    new = self.of("iban", own)
                    if new is not None:
                        at = m.start() + len(own)
                        out += [text[done : m.start()], new]
                        spans.append((m.start(), at))
                        kinds.append("iban")
                        done = at
                        break
                else:
                    # None of it is valid, but an IBAN may begin at a later word of the match.
                    at = m.start() + len(m.group().split(" ")[0])
            at = last
        return "".join([*out, text[done:]]), spans


def pseudonyms(text: Column, key: str, inverse: bool = False) -> Column:
    """Struct (text, n_replaced, kinds) of a text column; a null text stays null, with 0 and no kinds."""
    holder: list[Pseudonyms] = []

    @F.arrow_udf("struct<text: string, n_replaced: long, kinds: array<string>>")
    def run(column: pa.Array) -> pa.Array:
        if not holder:
            holder.append(Pseudonyms(key.encode(), inverse))
        rows = []
        for value in column.to_pylist():
            new, kinds = (None, []) if value is None else holder[0].replace(value)
            rows.append({"text": new, "n_replaced": len(kinds), "kinds": sorted(set(kinds))})
        return pa.array(rows, pa.struct([("text", pa.string()), ("n_replaced", pa.int64()), ("kinds", pa.list_(pa.string()))]))

    return run.asNondeterministic()(text)


def pseudonymised(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with personal data in its text column replaced; all other columns, rows and their order stay.

    A null text stays null, an empty one empty; repeated rows give repeated results; columns of any other name are untouched.
    Where documents hold lengths of the text in n_chars, that column is brought up to date.
    """
    done = docs.withColumn(text, F.expr(f"`{text}`").cast("string"))
    done = done.withColumn(text, pseudonyms(F.col(f"`{text}`"), key)["text"])
    return done.select(*[F.char_length(F.col(f"`{text}`")).cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])
