"""Format-preserving pseudonyms by keyed Feistel permutations.

A value is validated first (Luhn for cards, mod 97 for IBANs, ranges for addresses, calendar for dates), mapped to a
number in the domain of its format, permuted by a keyed Feistel network with cycle walking, and written back into the
very format it had: separators, letter case, lengths and check digits fit. The permutation depends on the key and the
format only, so equal values get equal pseudonyms in every document and on every executor, and different values never
collide. Numbers that fail validation are not personal and stay.

Scale: one scan, row by row, no shuffle and no table of values.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("email", "phone", "ip", "card", "iban", "ssn", "date")


@lru_cache(maxsize=65536)
def permute(value: int, size: int, key: bytes, kind: str, back: bool = False) -> int:
    """A permutation of range(size): Feistel over the least even number of bits that holds it, walked until inside."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1

    def f(i: int, x: int) -> int:
        data = b"%d:%d:%d:%d" % (i, half, size, x)
        return int.from_bytes(hashlib.blake2b(data, digest_size=(half + 7) // 8, key=key, person=kind.encode()[:16]).digest(), "big") & mask

    while True:
        left, right = value >> half, value & mask
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            left, right = (right ^ f(i, left), left) if back else (right, left ^ f(i, right))
        value = left << half | right
        if value < size:
            return value


_LATIN = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_LATIN_UP = "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", _LATIN, _LATIN_UP)
_OF = {c: (a, i) for a in _ALPHABETS for i, c in enumerate(a)}


def shuffled(text: str, key: bytes, kind: str, back: bool = False) -> str:
    """Permute the letters and digits of ``text`` as one number, each within its own alphabet; the rest stays."""
    value, size, plan = 0, 1, []
    for c in text:
        if c in _OF:
            a, i = _OF[c]
            value, size = value * len(a) + i, size * len(a)
            plan.append(a)
        else:
            plan.append(c)
    # the layout of alphabets is part of the domain
    layout = kind + "/" + hashlib.blake2b("".join(str(_ALPHABETS.index(p)) if p in _ALPHABETS else p for p in plan).encode(), digest_size=5).hexdigest()
    value = permute(value, size, key, layout, back)
    out = []
    for p in reversed(plan):
        if p in _ALPHABETS and len(p) > 1:
            value, i = divmod(value, len(p))
            out.append(p[i])
        else:
            out.append(p)
    return "".join(reversed(out))


def luhn(digits: str) -> int:
    """Luhn sum modulo ten; 0 for a valid number."""
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10


def _into(pattern: str, digits: str) -> str:
    """``digits`` in place of the digits of ``pattern``."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in pattern)


def card(text: str, key: bytes, back: bool = False) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or luhn(digits):
        return None
    size = 10 ** (len(digits) - 1)
    body = str(permute(int(digits[:-1]), size, key, "card", back)).zfill(len(digits) - 1)
    return _into(text, body + str((10 - luhn(body + "0")) % 10))


# Country calling codes of two digits (ITU-T E.164). Codes that begin with 1 or 7 have one digit, all others
# three.
_TWO = (
    "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58",
    "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
)


def country(digits: str) -> str:
    """The country code that an international number begins with."""
    return digits[: 1 if digits[0] in "17" else 2 if digits[:2] in _TWO else 3]


def phone(text: str, key: bytes, back: bool = False) -> str | None:
    """The country code stays and the national digits are permuted, however they are grouped.

    Ten digits without ``+`` are a number of country code 1, so both ways to write one get the same pseudonym.
    """
    digits = re.sub(r"\D", "", text)
    if not 8 <= len(digits) <= 15:
        return None
    code = country(digits) if text[0] == "+" else "1"
    rest = digits[len(code) :] if text[0] == "+" else digits
    new = str(permute(int(rest), 10 ** len(rest), key, f"phone{code}-{len(rest)}", back)).zfill(len(rest))
    return _into(text, code + new if text[0] == "+" else new)


def ip(text: str, key: bytes, back: bool = False) -> str | None:
    octets = text.split(".")
    if any(int(o) > 255 or str(int(o)) != o for o in octets):
        return None
    value = permute(int.from_bytes(bytes(map(int, octets)), "big"), 2**32, key, "ip", back)
    return ".".join(map(str, value.to_bytes(4, "big")))


def _ssn_index(area: int, group: int, serial: int) -> int:
    """Place among valid numbers: areas 001-899 without 666, groups 01-99, serials 0001-9999."""
    return ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1


def ssn(text: str, key: bytes, back: bool = False) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    value, serial = divmod(permute(_ssn_index(area, group, serial), 898 * 99 * 9999, key, "ssn", back), 9999)
    area, group = divmod(value, 99)
    area += 1
    return f"{area + (area >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


def iban(text: str, key: bytes, back: bool = False) -> str | None:
    """Groups stay; a printed number gets the pseudonym of the same number without its separators."""
    as_number = lambda s: int("".join(str(int(c, 36)) for c in s))
    solid = re.sub("[ -]", "", text)
    if not 15 <= len(solid) <= 34 or as_number(solid[4:] + solid[:4]) % 97 != 1:
        return None
    body = shuffled(solid[4:], key, "iban", back)
    it = iter(f"{solid[:2]}{98 - as_number(body + solid[:2] + '00') % 97:02d}{body}")
    return "".join(c if c in " -" else next(it) for c in text)


_FIRST, _LAST = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def _width(d: dt.date) -> tuple[int, bool]:
    """Days of one class have the same number of digits in every layout, and read the same where the month comes first."""
    return (d.day > 9) + (d.day > 12), d.month > 9


def date(text: str, key: bytes, back: bool = False) -> str | None:
    """Year-month-day, or day and month before the year; days of 1900 to 2099 permute among themselves.

    One permutation serves all layouts, so a date has one pseudonym however it is written. To fit every layout it stays
    within the days of a class: day to 9, to 12 or over it, month to 9 or over it.
    """
    a, b, c = re.split(r"[-/.]", text)
    year_first = len(a) == 4
    year, month, day = (a, b, c) if year_first else (c, b, a)
    swapped = not year_first and int(month) > 12 >= int(day)  # month/day/year can only be that
    if swapped:
        month, day = day, month
    try:
        was = dt.date(int(year), int(month), int(day))
    except ValueError:
        return None
    n = was.toordinal()
    if not _FIRST <= n <= _LAST:
        return None
    while True:
        n = _FIRST + permute(n - _FIRST, _LAST - _FIRST + 1, key, "date", back)
        d = dt.date.fromordinal(n)
        if _width(d) == _width(was):
            break
    y, m, t = str(d.year), str(d.month).zfill(len(month)), str(d.day).zfill(len(day))
    first, second = (m, t) if year_first or swapped else (t, m)
    sep = re.findall(r"[-/.]", text)
    return f"{y}{sep[0]}{first}{sep[1]}{second}" if year_first else f"{first}{sep[0]}{second}{sep[1]}{y}"


def email(text: str, key: bytes, back: bool = False) -> str | None:
    """Local part and host labels are permuted in their alphabets; the top-level label stays."""
    local, host = text.split("@")
    labels = host.split(".")
    if len(labels) < 2 or not all(labels) or local[0] == "." or ".." in local or not re.fullmatch(r"[A-Za-z]{2,}", labels[-1]):
        return None
    return f"{shuffled(local, key, 'local', back)}@{shuffled('.'.join(labels[:-1]), key, 'host', back)}.{labels[-1]}"


#: A stretch that can hold numbers, and the formats within it, tried in this order.
_STRETCH = re.compile(r"[+(\d][\d .()/+-]*\d")
_FORMATS = re.compile(
    r"(?<![\w.])(?:(?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?!\.?\d)"
    r"|(?P<date>\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{4}\.\d{2}\.\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![-/]?\d)"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})(?!-?\d)"
    r"|(?P<card>\d{4}(?:[ -]\d{4}){2,3}[ -]\d{1,4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d)"
    r"|(?P<phone>\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}|\+\d{1,3}[ -]?\(?\d{2,4}\)?(?:[ .-]?(?!\d{1,3}\.\d{1,3}\.\d)\d{2,4}){2,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?!\d))(?!\w)",
    re.ASCII,
)
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?:[ -][A-Z0-9]{4}){2,7}(?:[ -][A-Z0-9]{1,4})?)(?![A-Za-z0-9])", re.ASCII)
_CARD_RUNS = re.compile(r"\d+(?:[ -]\d+){0,4}(?!\d)", re.ASCII)
_RUN = re.compile(r"\d+", re.ASCII)
_LOCAL = re.compile(r"[\w.%+-]+\Z")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-])")
_MAKERS = {"ip": ip, "date": date, "ssn": ssn, "card": card, "phone": phone}
#: The local part of a mail address has at most this many characters (RFC 5321); a longer run is none and stays whole.
_LOCAL_MOST = 64


def _card_ends(text: str, at: int, end: int) -> list[int]:
    """Ends of all card layouts that start at ``at`` and end with a group, longest first."""
    m = _CARD_RUNS.match(text, at, end)
    widths, ends = [], []
    for run in _RUN.finditer(m[0]) if m else ():
        widths.append(len(run[0]))
        solid = len(widths) == 1 and 13 <= widths[0] <= 19
        fours = len(widths) >= 4 and set(widths[:-1]) == {4} and widths[-1] <= 4
        after = text[at + run.end() : at + run.end() + 1]
        if (solid or fours or widths == [4, 6, 5]) and not (after.isalnum() or after == "_"):
            ends.append(at + run.end())
    return ends[::-1]


def _phone_end(text: str) -> int:
    """Where a phone with a country code ends among groups after it that are another number.

    A space ends it when its national part is whole: nine digits whose last group has four, or that the next group
    would lift over eleven; eight before a wider group that would; seven before the space after a group of six.
    """
    runs = list(_RUN.finditer(text))
    if text[0] != "+":
        return len(text)
    national = -min(len(runs[0][0]), 3) if len(runs[0][0]) <= 3 else -2
    for run, after in zip(runs, runs[1:], strict=False):
        have, more = len(run[0]), len(after[0])
        national += have
        whole = national >= 9 and (have >= 4 or national + more > 11) or national >= 8 and more > have and national + more > 11 or national >= 7 and have >= 6
        if whole and text[run.end() : after.start()].isspace():
            return run.end()
    return len(text)


def _numbers(text: str, at: int, end: int, key: bytes) -> Iterator[tuple[int, int, str, str]]:
    """Validated numbers of a stretch. Where a candidate fails, its shorter groupings are tried, then the next group."""
    while x := _FORMATS.search(text, at, end):
        kind, lo = x.lastgroup, x.start()
        if kind == "card":
            ends = _card_ends(text, lo, end)
        else:
            ends = [lo + _phone_end(x[0]) if kind == "phone" else x.end()]
        for hi in ends:
            if new := _MAKERS[kind](text[lo:hi], key):
                yield lo, hi, kind, new
                at = hi
                break
        else:
            at = _RUN.search(text, lo).end()


def _ibans(text: str, key: bytes) -> Iterator[tuple[int, int, str, str]]:
    """IBANs, solid or in groups; groups after the number are left off from the right until it validates."""
    at = 0
    while m := _IBAN.search(text, at):
        lo, at = m.start(), m.start() + 4
        hi = m.end()
        while hi - lo >= 15:
            if new := iban(text[lo:hi], key):
                yield lo, hi, "iban", new
                at = hi
                break
            hi = max(text.rfind(" ", lo, hi), text.rfind("-", lo, hi))


def found(text: str, key: bytes) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of all validated values, without overlaps, in order."""
    out = []
    at = text.find("@")
    while at >= 0:
        left = _LOCAL.search(text[max(0, at - _LOCAL_MOST - 1) : at])
        right = _HOST.match(text, at + 1)
        if left and right and len(left[0]) <= _LOCAL_MOST:
            a, b = at - len(left[0]), right.end()
            if new := email(text[a:b], key):
                out.append((a, b, "email", new))
        at = text.find("@", at + 1)
    for m in _STRETCH.finditer(text):
        if m.end() - m.start() < 7:
            continue
        out += _numbers(text, m.start(), min(len(text), m.end() + 1), key)
    out += _ibans(text, key)
    out.sort(key=lambda s: (s[0], -s[1]))
    kept, end = [], 0
    for s in out:
        if s[0] >= end:
            kept.append(s)
            end = s[1]
    return kept


def rewritten(text: str, key: bytes) -> tuple[str, dict[str, int]]:
    parts, at, counts = [], 0, dict.fromkeys(KINDS, 0)
    for a, b, kind, new in found(text, key):
        parts += [text[at:a], new]
        at = b
        counts[kind] += 1
    return "".join([*parts, text[at:]]), counts


def _rewrite(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for text in batch.column(1):
                new, n = rewritten(s, key) if (s := text.as_py()) is not None else (None, dict.fromkeys(KINDS, 0))
                texts.append(new)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), *(pa.array([c[k] for c in counts], pa.int64()) for k in KINDS)], ["id", "text", *(f"n_{k}" for k in KINDS)])

    return run


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: id, text with every validated value replaced, and the number of each kind.

    Null stays null and empty stays empty, both with zero counts; repeated rows give equal rows; rows without an id
    are rewritten like any other; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.mapInArrow(_rewrite(key), f"id {docs.schema['id'].dataType.simpleString()}, text string, {counts}").withColumnRenamed("id", id_col)


#: For the query and tests; in production the key comes from a secret store.
DEMO_KEY = b"tidemark demonstration key"


def op5_feistel_pseudonyms(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` with its validated values replaced, and how many of each kind."""
    return pseudonymise(spark.read.parquet(f"{sf_dir}/documents.parquet"), DEMO_KEY)
