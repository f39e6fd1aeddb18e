"""Personal data: format-preserving Feistel pseudonyms.

A value that passes its kind's validation (checksum, calendar, ranges) is ranked
among all valid values of its format, the rank is permuted by a keyed Feistel
network, and the permuted rank is written out in the same format. So a pseudonym
is valid wherever the value was, equal values get equal pseudonyms in every
document without any shared table, and who has the key can invert it.

The work is narrow: one pass over the text, nothing is shuffled or collected.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm.frames import read, with_columns

# Stands for the secret of a deployment, which passes its own.
KEY = "replace-this-key"
ROUNDS = 10
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2099, 12, 31)
DIGITS, HEX = "0123456789", "0123456789abcdef"
LETTERS = "abcdefghijklmnopqrstuvwxyz"

RESULT = "text string, pseudonyms array<struct<kind:string,pseudonym:string>>"


class Permutation:
    """A keyed permutation of 0..size-1: Feistel network with cycle walking."""

    def __init__(self, key: str, tweak: str, size: int):
        self.size = size
        self.half = max(1, math.ceil(max(size - 1, 1).bit_length() / 2))
        self.mask = (1 << self.half) - 1
        self.key = hashlib.blake2b(f"{key}\0{tweak}\0{size}".encode()).digest()

    def _round(self, i: int, value: int) -> int:
        data = i.to_bytes(1, "big") + value.to_bytes((self.half + 7) // 8, "big")
        out = hashlib.blake2b(data, key=self.key, digest_size=(self.half + 7) // 8 + 4)
        return int.from_bytes(out.digest(), "big") & self.mask

    def _once(self, x: int, rounds: range) -> int:
        left, right = x >> self.half, x & self.mask
        if rounds.step > 0:
            for i in rounds:
                left, right = right, left ^ self._round(i, right)
        else:
            for i in rounds:
                left, right = right ^ self._round(i, left), left
        return (left << self.half) | right

    def __call__(self, x: int) -> int:
        x = self._once(x, range(ROUNDS))
        while x >= self.size:
            x = self._once(x, range(ROUNDS))
        return x

    def inverse(self, x: int) -> int:
        x = self._once(x, range(ROUNDS - 1, -1, -1))
        while x >= self.size:
            x = self._once(x, range(ROUNDS - 1, -1, -1))
        return x


Permute = Callable[[str, int, int], int]


def luhn_digit(body: str) -> str:
    """The check digit that makes ``body`` plus it pass the Luhn test."""
    total = 0
    for i, c in enumerate(reversed(body)):
        n = int(c) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def filled(shape: str, symbols: str) -> str:
    """``shape`` with its letters and digits replaced in order."""
    rest = iter(symbols)
    return "".join(next(rest) if c.isalnum() else c for c in shape)


def card(value: str, permute: Permute) -> str | None:
    digits = re.sub(r"\D", "", value)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    if len(set(digits)) == 1:
        return None
    n = len(digits) - 1
    body = str(permute(f"card{n}", int(digits[:-1]), 10**n)).zfill(n)
    return filled(value, body + luhn_digit(body))


def phone(value: str, permute: Permute) -> str | None:
    """North American numbers: area and exchange do not start with 0 or 1."""
    digits = re.sub(r"\D", "", value)
    country, digits = digits[:-10], digits[-10:]
    if len(digits) != 10 or country not in ("", "1") or digits[0] < "2" or digits[3] < "2":
        return None
    rank = ((int(digits[:3]) - 200) * 800 + int(digits[3:6]) - 200) * 10_000 + int(digits[6:])
    rank = permute("phone", rank, 800 * 800 * 10_000)
    rest, line = divmod(rank, 10_000)
    area, exchange = divmod(rest, 800)
    return filled(value, f"{country}{area + 200}{exchange + 200}{line:04d}")


def ssn(value: str, permute: Permute) -> str | None:
    """Area 001-899 without 666, group and serial not zero."""
    area, group, serial = (int(x) for x in value.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    row = area - 1 - (area > 666)
    rank = permute("ssn", (row * 99 + group - 1) * 9_999 + serial - 1, 898 * 99 * 9_999)
    rest, serial = divmod(rank, 9_999)
    row, group = divmod(rest, 99)
    return f"{row + 1 + (row >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def ip(value: str, permute: Permute) -> str | None:
    parts = value.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    out = permute("ip", int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32)
    return ".".join(map(str, out.to_bytes(4, "big")))


def symbols(kind: str, text: str, permute: Permute) -> str:
    """Permute all letters and digits, each within its own alphabet and case."""
    chars = [c for c in text if c.isascii() and c.isalnum()]
    radix = [10 if c.isdigit() else 26 for c in chars]
    shape = "".join("9" if c.isdigit() else "a" for c in chars)
    rank = 0
    for c, r in zip(chars, radix, strict=True):
        rank = rank * r + (int(c) if r == 10 else LETTERS.index(c.lower()))
    rank = permute(f"{kind}:{shape}", rank, math.prod(radix))
    out = []
    for c, r in zip(reversed(chars), reversed(radix), strict=True):
        rank, k = divmod(rank, r)
        new = DIGITS[k] if r == 10 else LETTERS[k]
        out.append(new.upper() if c.isupper() else new)
    rest = iter(reversed(out))
    return "".join(next(rest) if c.isascii() and c.isalnum() else c for c in text)


def mod97(country: str, body: str) -> int:
    return int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def iban(value: str, permute: Permute) -> str | None:
    packed = value.replace(" ", "")
    country, check, body = packed[:2], packed[2:4], packed[4:]
    if not 11 <= len(body) <= 30 or 98 - mod97(country, body) != int(check):
        return None
    body = symbols("iban", body, permute)
    return filled(value, f"{country}{98 - mod97(country, body):02d}{body}")


# (pattern, order of year, month, day in the groups): fixed formats.
DATES = (
    (re.compile(r"(\d{4})([-/.])(\d{2})\2(\d{2})\Z"), (0, 2, 3)),
    (re.compile(r"(\d{2})([-/.])(\d{2})\2(\d{4})\Z"), (3, 2, 0)),
)


def date(value: str, permute: Permute) -> str | None:
    """Calendar days from 1900 to 2099; day before month unless only the reverse fits.

    Month-first dates stay such: the permutation is walked on to a day above 12.
    """
    for pattern, (y, m, d) in DATES:
        if not (found := pattern.match(value)):
            continue
        parts = list(found.groups())
        for month, day in ((m, d), (d, m)) if y == 3 else ((m, d),):
            try:
                day_of = dt.date(int(parts[y]), int(parts[month]), int(parts[day]))
            except ValueError:
                continue
            if not FIRST_DAY <= day_of <= LAST_DAY:
                return None
            reversed_order = month == d
            size = (LAST_DAY - FIRST_DAY).days + 1
            new = day_of
            while new is day_of or (reversed_order and new.day <= 12):
                rank = permute("date", (new - FIRST_DAY).days, size)
                new = FIRST_DAY + dt.timedelta(rank)
            parts[y], parts[month], parts[day] = f"{new.year}", f"{new.month:02d}", f"{new.day:02d}"
            return f"{parts[0]}{parts[1]}{parts[2]}{parts[1]}{parts[3]}"
    return None


def email(value: str, permute: Permute) -> str | None:
    """The local part is permuted in its letters and digits; the domain stays."""
    local, _, domain = value.rpartition("@")
    return f"{symbols('email', local, permute)}@{domain}" if local else None


def secret(value: str, permute: Permute) -> str | None:
    """A hexadecimal or alphanumeric key keeps its length and its alphabet."""
    if re.fullmatch(r"[0-9a-f]+", value):
        return f"{permute(f'hex{len(value)}', int(value, 16), 16 ** len(value)):0{len(value)}x}"
    return symbols("secret", value, permute)


# Tried in this order at each place; fixed formats.
NUMBERS = re.compile(
    r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<awskey>\bAKIA[0-9A-Z]{16}\b)"
    r"|(?P<phone>(?:\+1[ .-]?)?\(\d{3}\) ?\d{3}[ .-]\d{4}\b"
    r"|\+1[ .-]?\d{3}[ .-]\d{3}[ .-]\d{4}\b|(?<![\w.-])\d{3}([.-])\d{3}\4\d{4}(?![\w-]))"
    r"|(?P<ssn>(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<date>(?<![\w.-])(?:\d{4}([-/.])\d{2}\7\d{2}|\d{2}([-/.])\d{2}\8\d{4})(?![\w-]|\.\d))"
    r"|(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d))"
    r"|(?P<card>(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]))"
)
EMAILS = re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9])")
SECRETS = re.compile(
    r"(?i)\b(?:password|passwd|pwd|token|secret|api[_-]?key)\s*[=:]\s*[\"']?([A-Za-z0-9]{8,})"
)
# Every value of a fixed format has a digit, or is a key that begins so.
NUMBERED = re.compile(r"\d|AKIA")
# All extents a value of a kind can have from a given start, longest first: what fails
# its validation may hold a valid value, or begin with one.
EXTENTS = {
    "iban": [
        re.compile(
            rf"\b[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{{n}}}" + (rf" ?[A-Z0-9]{{{rest}}}" if rest else "") + r"\b"
        )
        for n in range(7, 1, -1) for rest in range(3, -1, -1)
    ],
    "awskey": [re.compile(r"\bAKIA[0-9A-Z]{16}\b")],
    "phone": [
        re.compile(r"(?:\+1[ .-]?)?\(\d{3}\) ?\d{3}[ .-]\d{4}\b"),
        re.compile(r"\+1[ .-]?\d{3}[ .-]\d{3}[ .-]\d{4}\b"),
        re.compile(r"(?<![\w.-])\d{3}([.-])\d{3}\1\d{4}(?![\w-])"),
    ],
    "ssn": [re.compile(r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])")],
    "date": [
        re.compile(r"(?<![\w.-])\d{4}([-/.])\d{2}\1\d{2}(?![\w-]|\.\d)"),
        re.compile(r"(?<![\w.-])\d{2}([-/.])\d{2}\1\d{4}(?![\w-]|\.\d)"),
    ],
    "ip": [re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)")],
    "card": [
        re.compile(rf"(?<![\w.-])\d(?:[ -]?\d){{{n}}}(?![\w-])") for n in range(18, 11, -1)
    ],
}
KINDS = {
    "iban": iban, "awskey": secret, "phone": phone, "ssn": ssn, "date": date, "ip": ip, "card": card,
}


class Pseudonymizer:
    """Replaces the values of one text after another under one key."""

    def __init__(self, key: str = KEY):
        self.key = key
        self.made: dict[tuple[str, int], Permutation] = {}

    def permute(self, tweak: str, rank: int, size: int) -> int:
        if (tweak, size) not in self.made:
            if len(self.made) >= 10_000:  # shapes of free text are many
                self.made.clear()
            self.made[tweak, size] = Permutation(self.key, tweak, size)
        return self.made[tweak, size](rank)

    def numbers(self, text: str) -> Iterator[tuple[int, int, str, str]]:
        """Values of fixed formats that pass their validation, from left to right.

        At each start all kinds are tried in order with all their extents; without a
        valid one the search goes on at the next character.
        """
        at = 0
        while m := NUMBERS.search(text, at):
            at = m.start() + 1
            for end, kind, new in self.valid_at(text, m):
                yield m.start(), end, kind, new
                at = end

    def valid_at(self, text: str, m: re.Match) -> list[tuple[int, str, str]]:
        """The first valid value that begins where ``m`` does, if any."""
        if new := KINDS[m.lastgroup](m[0], self.permute):
            return [(m.end(), m.lastgroup, new)]
        for kind, patterns in EXTENTS.items():
            for pattern in patterns:
                other = pattern.match(text, m.start())
                if other and (new := KINDS[kind](other[0], self.permute)):
                    return [(other.end(), kind, new)]
        return []

    def __call__(self, text: str) -> tuple[str, list[dict]]:
        found: list[tuple[int, int, str, str]] = []
        if "@" in text:
            for m in EMAILS.finditer(text):
                if new := email(m[0], self.permute):
                    found.append((m.start(), m.end(), "email", new))
        if "=" in text or ":" in text:
            for m in SECRETS.finditer(text):
                found.append((m.start(1), m.end(1), "secret", secret(m[1], self.permute)))
        if NUMBERED.search(text):
            found += self.numbers(text)
        out, at, listed = [], 0, []
        for start, end, kind, new in sorted(found):
            if start < at:  # inside a value that is replaced already
                continue
            out += [text[at:start], new]
            listed.append({"kind": kind, "pseudonym": new})
            at = end
        return "".join([*out, text[at:]]), listed


def pseudonymized(docs: DataFrame, key: str = KEY, column: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``column``, and ``pseudonyms`` listing them in order.

    A column ``pseudonyms`` of the input gives way. A null text stays null and an
    empty one empty, both without pseudonyms; texts are processed whole.
    """

    @F.pandas_udf(RESULT)
    def replaced(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        replace = Pseudonymizer(key)
        for batch in texts:
            rows = [(None, []) if t is None else replace(t) for t in batch]
            yield pd.DataFrame(rows, columns=["text", "pseudonyms"])

    done = docs.withColumn("_done", replaced(F.col(f"`{column}`")))
    return with_columns(
        done, **{column: F.col("_done.text"), "pseudonyms": F.col("_done.pseudonyms")}
    ).drop("_done")


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms, and what kinds were replaced."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymized(docs).select(
        "doc_id", "text", F.size("pseudonyms").alias("n_values"),
        F.array_join(F.transform("pseudonyms", lambda p: p["kind"]), ",").alias("kinds"),
        F.array_join(F.transform("pseudonyms", lambda p: p["pseudonym"]), "\n").alias("pseudonyms"),
    )


QUERIES = {"op2_feistel_pseudonyms": op2_feistel_pseudonyms}
# Keyed permutations are not expressible in SQL; tests invert every pseudonym.
SQL: dict[str, str] = {}
