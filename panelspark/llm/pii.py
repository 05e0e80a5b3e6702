"""Format-preserving pseudonyms for personal numbers, dates, addresses and keys.

A value is recognised by its shape, validated (check digits, ranges, calendar), read as a number of
its format's domain, moved by a keyed Feistel permutation of that domain (cycle walking keeps it
inside), and written back in the same format. Equal values get equal pseudonyms in every document,
different values different ones, and no value is its own pseudonym. Whoever holds the key can invert
the permutation: values are found once, on the given text, first addresses, then keys in the pieces between
them, then numbers in the pieces that are left. A pseudonym has the length and the kinds of characters of its
value, so the same values are found again in the text with pseudonyms. Digits are ASCII digits.

Scale: one pass per text inside Arrow-fed tasks; no shuffle, no state between rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import warnings
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import tokens

ROUNDS = 8
KEY_SETTING = "spark.panelspark.pii.secret"
DEMONSTRATION_KEY = "demonstration: not secret"
_DIGIT, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HEX, _HEX_UPPER = "0123456789abcdef", "0123456789ABCDEF"


def _feistel(x: int, bits: int, key: bytes, tweak: bytes, back: bool) -> int:
    mask = (1 << bits) - 1
    left, right = x >> bits, x & mask
    size = (bits + 7) // 8
    for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
        half = left if back else right
        h = hashlib.blake2b(bytes([i]) + half.to_bytes(size, "big") + tweak, key=key, digest_size=min(64, size))
        f = int.from_bytes(h.digest(), "big")
        for block in range(1, -(-size // 64)):
            h.update(bytes([block & 255]))
            f = f << 512 | int.from_bytes(h.digest(), "big")
        left, right = (right ^ (f & mask), left) if back else (right, left ^ (f & mask))
    return left << bits | right


def permute(x: int, domain: int, key: bytes, tweak: str, back: bool = False) -> int:
    """Keyed permutation of ``range(domain)``; ``back`` inverts it."""
    bits = max(1, -(-(domain - 1).bit_length() // 2))
    while True:
        x = _feistel(x, bits, key, tweak.encode(), back)
        if x < domain:
            return x


def pseudonym(x: int, domain: int, key: bytes, tweak: str, back: bool = False) -> int:
    """One step along a keyed cycle through the whole domain: a permutation without fixed points."""
    if domain < 2:
        return x
    return permute((permute(x, domain, key, tweak) + (-1 if back else 1)) % domain, domain, key, tweak, back=True)


def _characters(text: str, alphabets: list[str | None], key: bytes, tweak: str, back: bool) -> str:
    """Permute all characters that have an alphabet, as one mixed-radix number."""
    x = domain = 0
    for c, a in zip(text, alphabets, strict=True):
        if a:
            x, domain = x * len(a) + a.index(c), (domain or 1) * len(a)
    x, out = pseudonym(x, domain, key, tweak, back) if domain else x, []
    for c, a in zip(reversed(text), reversed(alphabets), strict=True):
        if a:
            x, r = divmod(x, len(a))
            c = a[r]
        out.append(c)
    return "".join(reversed(out))


def _alphabet(c: str) -> str | None:
    return _DIGIT if c in _DIGIT else _LOWER if c in _LOWER else _UPPER if c in _UPPER else None


def _digits(text: str, key: bytes, tweak: str, back: bool) -> str:
    alphabets = [_DIGIT if c in _DIGIT else None for c in text]
    return _characters(text, alphabets, key, f"{tweak}{sum(map(bool, alphabets))}", back)


def _luhn(digits: str) -> int:
    """Sum of the check digit rule; 0 modulo 10 when valid."""
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))


def _number(text: str, key: bytes, back: bool) -> tuple[str, str] | None:
    """Card numbers keep a valid check digit; other long numbers count as account numbers."""
    digits = "".join(c for c in text if c in _DIGIT)
    if not 13 <= len(digits) <= 19:
        return None
    if _luhn(digits) % 10:
        body = permute_invalid(digits, key, back)
        kind = "account"
    else:
        body = _digits(digits[:-1], key, "card", back)
        body += str(-_luhn(body + "0") % 10)
        kind = "card"
    new = iter(body)
    return kind, "".join(next(new) if c in _DIGIT else c for c in text)


def permute_invalid(digits: str, key: bytes, back: bool) -> str:
    """Within the numbers of this length whose check digit is wrong: body, and how far it is off."""
    off = (int(digits[-1]) - -_luhn(digits[:-1] + "0")) % 10 - 1
    x = int(digits[:-1]) * 9 + off
    x, off = divmod(pseudonym(x, 9 * 10 ** (len(digits) - 1), key, f"account{len(digits)}", back), 9)
    body = str(x).zfill(len(digits) - 1)
    return body + str((-_luhn(body + "0") + off + 1) % 10)


def _address(text: str, key: bytes, back: bool) -> tuple[str, str] | None:
    """IPv4: every octet keeps its number of digits."""
    parts = text.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    low, size = {1: 0, 2: 10, 3: 100}, {1: 10, 2: 90, 3: 156}
    x = domain = 0
    for p in parts:
        x, domain = x * size[len(p)] + int(p) - low[len(p)], (domain or 1) * size[len(p)]
    x, out = pseudonym(x, domain, key, "ip" + "".join(str(len(p)) for p in parts), back), []
    for p in reversed(parts):
        x, r = divmod(x, size[len(p)])
        out.append(str(r + low[len(p)]))
    return "ip", ".".join(reversed(out))


def _social(text: str, key: bytes, back: bool) -> tuple[str, str] | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    places = [a for a in range(1, 900) if a != 666]
    x = (places.index(area) * 99 + group - 1) * 9999 + serial - 1
    x, serial = divmod(pseudonym(x, len(places) * 99 * 9999, key, "ssn", back), 9999)
    area, group = divmod(x, 99)
    return "ssn", f"{places[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


_FIRST, _LAST = dt.date(1900, 1, 1), dt.date(2099, 12, 31)


def _date(text: str, key: bytes, back: bool) -> tuple[str, str] | None:
    """A day between 1900 and 2099; the same day moves alike in all notations.

    With slashes a date reads month first if it can; those that cannot stay among themselves. So do days
    and months written with one digit.
    """
    sign = re.search(r"[-./]", text)[0]
    parts = text.split(sign)
    order = (0, 1, 2) if len(parts[0]) == 4 else (2, 1, 0) if sign == "." else (2, 0, 1)
    try:
        day = dt.date(*(int(parts[i]) for i in order))
    except ValueError:
        if sign != "/":
            return None
        order = (2, 1, 0)  # day first
        try:
            day = dt.date(*(int(parts[i]) for i in order))
        except ValueError:
            return None
    if not _FIRST <= day <= _LAST:
        return None
    day_first = sign == "/" and order == (2, 1, 0)
    short_month, short_day = len(parts[order[1]]) == 1, len(parts[order[2]]) == 1
    while True:
        day = _FIRST + dt.timedelta(pseudonym((day - _FIRST).days, (_LAST - _FIRST).days + 1, key, "date", back))
        if (not day_first or day.day > 12) and (not short_month or day.month < 10) and (not short_day or day.day < 10):
            break  # else it would read month first, or be longer
    new = [""] * 3
    for i, value in zip(order, (day.year, day.month, day.day), strict=True):
        new[i] = f"{value:04d}" if i == order[0] else f"{value:02d}" if len(parts[i]) == 2 else str(value)
    return "date", sign.join(new)


def _phone(text: str, key: bytes, back: bool) -> tuple[str, str] | None:
    head = re.match(r"\+[0-9]{1,3}[ .-]?", text)
    at = head.end() if head else 0
    return "phone", text[:at] + _digits(text[at:], key, "phone", back)


def _email(text: str, key: bytes, back: bool) -> tuple[str, str]:
    """The local part moves; with few possible values the first label of the domain moves along."""
    at = text.index("@")
    alphabets = [_alphabet(c) for c in text[:at]]
    domain = 1
    for a in alphabets:
        domain *= len(a) if a else 1
    if domain < 10 ** 9:
        label = text.index(".", at)
        alphabets += [None, *(_alphabet(c) for c in text[at + 1:label])]
        at = label
    shape = "".join("-" if a is None else a[0] for a in alphabets)
    return "email", _characters(text[:at], alphabets, key, "email" + shape, back) + text[at:]


def _letters(text: str) -> str | None:
    """The set that a key is written in, or None where it lacks digits or letters."""
    if not re.search(r"[0-9]", text) or not re.search(r"[A-Za-z]", text):
        return None
    return next((name for name, letters in (("hex", _HEX), ("HEX", _HEX_UPPER)) if all(c in letters for c in text)), "key")


def _secret(text: str, key: bytes, back: bool) -> tuple[str, str] | None:
    """A key stays in its set: hexadecimal, or letter for letter and digit for digit."""
    name = _letters(text)
    if name is None:
        return None
    if name == "key":
        alphabets = [_alphabet(c) for c in text]
        shape = name + "".join("-" if a is None else a[0] for a in alphabets)
    else:
        alphabets, shape = [_HEX if name == "hex" else _HEX_UPPER] * len(text), f"{name}{len(text)}"
    while True:
        text = _characters(text, alphabets, key, shape, back)
        if _letters(text) == name:
            return "secret", text


# Every alternative begins with a digit, a plus sign or a bracket, so that the search skips prose quickly.
_NUMBERS = re.compile(r"""(?=[0-9+(])(?:
    (?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))
  | (?P<date>(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![./-]?\d))
  | (?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?!-?\d))
  | (?P<phone>(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d))
  | (?P<number>(?<!\d)\d(?:[ -]?\d){12,18}(?!\d))
)""", re.VERBOSE | re.ASCII)
_EMAILS = re.compile(r"[^\W_][\w.%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+")
_SECRETS = re.compile(r"(?<=[=:])\s*[\"']?([0-9A-Za-z_-]{20,})")
_KINDS: dict[str, Callable] = {"ip": _address, "date": _date, "ssn": _social, "phone": _phone, "number": _number,
                               "email": _email, "secret": _secret}


@lru_cache(maxsize=10_000)
def _replaced(kind: str, text: str, key: bytes, back: bool) -> tuple[str, str] | None:
    return _KINDS[kind](text, key, back)


def _spans(text: str, key: bytes, back: bool) -> list[tuple[int, int, str, str]]:
    """Values of a text with their pseudonyms: begin, end, kind, new text; in order, none overlaps another.

    Each pattern sees a piece between the values found before as a text of its own.
    """
    spans: list[tuple[int, int, str, str]] = []
    pieces = [(0, text)]
    for pattern, named, signs in ((_EMAILS, "email", "@"), (_SECRETS, "secret", "=:"), (_NUMBERS, None, "")):
        if signs and not any(c in text for c in signs):
            continue
        left = []
        for start, piece in pieces:
            at = 0
            for m in pattern.finditer(piece):
                group = 1 if named == "secret" else 0
                new = _replaced(named or m.lastgroup, m[group], key, back)
                if new is not None:
                    spans.append((start + m.start(group), start + m.end(group), *new))
                    left.append((start + at, piece[at:m.start(group)]))
                    at = m.end(group)
            left.append((start + at, piece[at:]))
        pieces = left
    return sorted(spans)


def pseudonymise(text: str, key: bytes, back: bool = False) -> tuple[str, list[str]]:
    """The text with pseudonyms, and the kind of each value that was replaced, in order; ``back`` undoes it."""
    out, at, spans = [], 0, _spans(text, key, back)
    for start, end, _, new in spans:
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]]), [kind for _, _, kind, _ in spans]


def session_key(spark: SparkSession) -> str:
    """The key that the session holds in ``spark.panelspark.pii.secret`` (Spark hides settings of such names in its logs).

    Without that setting it is a public key, with a warning: fit for tests, since anyone can undo its pseudonyms.
    """
    key = spark.conf.get(KEY_SETTING, "")
    if not key:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms use a public key and can be undone by anyone", stacklevel=2)
    return key or DEMONSTRATION_KEY


def mask(docs: DataFrame, key: str, text: str = "text", kinds: str = "pii_kinds") -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and the kinds of the replaced values in a new column ``kinds``.

    Handled: e-mail addresses, keys after ``=`` or ``:``, IPv4 addresses, dates, social security, phone,
    card and account numbers. Texts without them come back unchanged; null stays null (no kinds). All
    other columns and all rows stay as they are; ``kinds`` replaces a column of that name.
    ``key`` is secret and must stay the same for values to stay linked; an empty one is an error. An empty
    table gives an empty one.
    """
    if not key:
        raise ValueError("an empty key protects nothing")
    secret = hashlib.blake2b(key.encode()).digest()[:32]
    names = [c for c in docs.columns if c not in (text, kinds)]
    schema = ", ".join([f"`{text}` string", f"`{kinds}` array<string>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = tokens.Texts(batch[text]), []
            for i, known in enumerate(batch[text].is_valid().to_pylist()):
                data = texts[i]
                if not known:
                    found.append((None, []))
                elif _MAYBE.search(data):
                    found.append(pseudonymise(data.decode("utf-8", "surrogatepass"), secret))
                else:
                    found.append((data, []))
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in names] + [pa.array([t for t, _ in found], pa.string()),
                                             pa.array([k for _, k in found], pa.list_(pa.string()))],
                names=[*names, text, kinds])

    kept = docs.select(*names, F.col(text).cast("string").alias(text))
    done = kept.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != text]
                                          + [schema]))
    return done.select(*[c for c in docs.columns if c != kinds], kinds)


_MAYBE = re.compile(rb"[0-9@]")
