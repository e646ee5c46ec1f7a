import datetime as dt
import random
import re

import pytest

from tidemark.llm import pseudonyms as p

KEY = b"test key"


@pytest.mark.parametrize("size", [2, 3, 10, 100, 1000, 12345])
def test_permutation_and_inverse(size):
    got = [p.permute(i, size, KEY, "x") for i in range(size)]
    assert sorted(got) == list(range(size))
    assert [p.permute(v, size, KEY, "x", back=True) for v in got] == list(range(size))
    assert size < 100 or got != [p.permute(i, size, b"other key", "x") for i in range(size)]


def test_formats_stay_and_come_back():
    r = random.Random(1)
    body = "".join(r.choice("0123456789") for _ in range(15))
    number = body + str((10 - p.luhn(body + "0")) % 10)
    cases = [
        (p.card, number), (p.card, f"{number[:4]} {number[4:8]}-{number[8:12]} {number[12:]}"), (p.phone, "+1 (017) 555-7713"), (p.phone, "+49 30 1234567"), (p.ip, "97.51.17.173"),
        (p.ssn, "123-45-6789"), (p.iban, "GB82WEST12345698765432"), (p.date, "2021-02-28"), (p.date, "3/4/1999"), (p.date, "12/31/1999"), (p.date, "01.02.2003"), (p.email, "Éva.34@mail7.example.com"),
    ]
    for make, text in cases:
        new = make(text, KEY)
        assert new and new != text and make(text, KEY) == new
        assert make(new, KEY) is not None
        if make is not p.ip:
            shape = lambda s: re.sub(r"[A-Za-zß-ÿÀ-Þ]", "a", re.sub(r"\d", "9", s))
            assert shape(new) == shape(text)
        assert make(new, KEY, True) == text
    assert p.luhn(re.sub(r"\D", "", p.card(number, KEY))) == 0


def test_dates_permute_among_valid_days():
    days = [(dt.date(1990, 1, 1) + dt.timedelta(i)).isoformat() for i in range(2000)]
    new = [p.date(d, KEY) for d in days]
    assert len(set(new)) == len(days) and all(dt.date.fromisoformat(x) for x in new)


def test_invalid_values_stay():
    for text in ("9807915762804490", "999.1.1.1", "1.2.3.4.5", "000-12-3456", "2021-02-30", "GB82WEST12345698765433", "x@y", "v1.2.3", "0012 3", "@", "a@b.c1", "12345"):
        assert p.rewritten(text, KEY)[0] == text, text


def test_neighbours_and_overlaps():
    text = "call +1 (826) 555-4081 190.137.223.204, a.b@x.example.com. 4845168114407329 9807915762804490"
    new, n = p.rewritten(text, KEY)
    assert {k: v for k, v in n.items() if v} == {"email": 1, "phone": 1, "ip": 1, "card": 1}
    assert new.endswith(" 9807915762804490") and p.phone("+1 (826) 555-4081", KEY) in new and p.ip("190.137.223.204", KEY) in new


def test_equal_values_stay_linked(spark):
    rows = [(1, "card 4845168114407329!"), (2, "4845168114407329"), (2, "4845168114407329"), (3, None), (4, ""), (None, "mail a.b@x.example.com"), (5, "é" * 100_000 + " 4845168114407329")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS n_card")
    got = p.pseudonymise(frame, KEY).collect()
    new = p.card("4845168114407329", KEY)
    assert [r["text"] for r in got if r["doc_id"] == 2] == [new, new] and [r["text"] for r in got if r["doc_id"] == 1] == [f"card {new}!"]
    assert [r["text"] for r in got if r["doc_id"] in (3, 4)] == [None, ""] and sum(r["n_card"] for r in got) == 4
    assert p.pseudonymise(frame.limit(0), KEY).count() == 0


CARD = "4111 1111 1111 1111"


@pytest.mark.parametrize("text, value, kind", [
    ("4111 1111 1111 1111 12/25", CARD, "card"), ("4111 1111 1111 1111 123", CARD, "card"), ("4111-1111-1111-1111 2 items", "4111-1111-1111-1111", "card"), ("2021 4111 1111 1111 1111", CARD, "card"),
    ("+49 30 123 4567 2021", "+49 30 123 4567", "phone"), ("+49 30 1234567 20211", "+49 30 1234567", "phone"), ("+47 22 12 34 56 2021", "+47 22 12 34 56", "phone"), ("+49 176 123 456 78", "+49 176 123 456 78", "phone"),
    ("+62 8123 4567 8901", "+62 8123 4567 8901", "phone"), ("+7 495 123 45 67 2021", "+7 495 123 45 67", "phone"), ("+4930123456789 2021", "+4930123456789", "phone"),
    ("DE89 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 00", "iban"), ("pay GB82 WEST 1234 5698 7654 32 NOW", "GB82 WEST 1234 5698 7654 32", "iban"), ("BE68 5390 0754 7034 PAID", "BE68 5390 0754 7034", "iban"),
    ("AB12 DE89 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 00", "iban"), ("NO93-8601-1117-947.", "NO93-8601-1117-947", "iban"),
])
def test_values_beside_other_numbers(text, value, kind):
    new, n = p.rewritten(text, KEY)
    assert new == text.replace(value, p._MAKERS.get(kind, p.iban)(value, KEY)) != text
    assert n[kind] == sum(n.values()) == 1


def test_cards_after_phones_and_cards():
    new, n = p.rewritten(f"+49 30 123 4567 {CARD} {CARD} 99", KEY)
    assert new == f"{p.phone('+49 30 123 4567', KEY)} {p.card(CARD, KEY)} {p.card(CARD, KEY)} 99" and n["card"] == 2


def test_printed_and_solid_ibans_are_linked():
    printed = p.iban("DE89 3704 0044 0532 0130 00", KEY)
    assert printed.replace(" ", "") == p.iban("DE89370400440532013000", KEY) and p.iban(printed, KEY, True) == "DE89 3704 0044 0532 0130 00"


def test_phones_are_linked_however_grouped():
    digits = lambda t: re.sub(r"\D", "", t)
    same = lambda *texts: len({digits(p.phone(t, KEY))[-10:] for t in texts}) == 1
    assert same("+49 30 1234567", "+49301234567", "+49-30-123-4567") and same("(826) 555-4081", "+1 826-555-4081", "826-555-4081", "+1 (826) 555-4081")
    assert [p.country(x) for x in ("18265554081", "74951234567", "49301234567", "35312345678", "85212345678")] == ["1", "7", "49", "353", "852"]
    assert p.phone("+353 1 234 5678", KEY).startswith("+353 ") and p.phone(p.phone("+353 1 234 5678", KEY), KEY, True) == "+353 1 234 5678"


def test_dates_are_linked_in_all_layouts():
    def read(t):
        a, b, c = map(int, re.split(r"[-/.]", t))
        return (a, b, c) if a > 99 else (c, a, b) if b > 12 else (c, b, a)

    for y, m, d in ((1999, 12, 31), (2021, 2, 28), (2003, 4, 3), (1970, 11, 5), (2020, 1, 12)):
        layouts = [f"{y}-{m:02}-{d:02}", f"{y}/{m:02}/{d:02}", f"{y}.{m:02}.{d:02}", f"{d:02}-{m:02}-{y}", f"{d}/{m}/{y}", f"{d:02}.{m:02}.{y}"] + ([f"{m}/{d}/{y}"] if d > 12 else [])
        new = [p.rewritten(f"on {t}, then", KEY) for t in layouts]
        assert len({read(t[3:-6]) for t, _ in new}) == 1 and all(n["date"] == 1 for _, n in new)
        assert all(p.date(t[3:-6], KEY, True) == was for (t, _), was in zip(new, layouts, strict=True))


def planted(r):
    """A text of values between words, and what must come of it."""
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def card():
        body = r.choice("3456") + digits(14)
        number = body + str((10 - p.luhn(body + "0")) % 10)
        return r.choice((number, " ".join(number[i : i + 4] for i in range(0, 16, 4)), "-".join(number[i : i + 4] for i in range(0, 16, 4))))

    def iban():
        body = digits(18)
        check = 98 - int(body + "131400") % 97
        solid = f"DE{check:02}{body}"
        return r.choice((solid, " ".join(solid[i : i + 4] for i in range(0, 22, 4))))

    day = dt.date(1950, 1, 1) + dt.timedelta(r.randrange(30_000))
    makers = {
        "card": (p.card, card()), "iban": (p.iban, iban()), "ip": (p.ip, ".".join(str(r.randrange(256)) for _ in range(4))), "ssn": (p.ssn, f"{r.randint(1, 665):03}-{r.randint(1, 99):02}-{r.randint(1, 9999):04}"),
        "date": (p.date, r.choice((day.isoformat(), f"{day:%d-%m-%Y}", f"{day:%Y/%m/%d}", f"{day.day}.{day.month}.{day.year}"))), "email": (p.email, f"{r.choice('abc')}{digits(3)}.x@mail{digits(1)}.example.org"),
        "phone": (p.phone, r.choice((f"+49 30 {digits(7)}", f"({digits(3)}) {digits(3)}-{digits(4)}", f"+1 {digits(3)}-{digits(3)}-{digits(4)}"))),
    }
    text, want, counts = "", "", dict.fromkeys(p.KINDS, 0)
    for _ in range(r.randint(0, 9)):
        word = r.choice(("see é", "of 12 items", "version 3.1", "id 12345,", "the @ sign", "999.1.1.1 or", "\n", "and so"))
        kind = r.choice(list(makers))
        make, value = makers[kind]
        close = r.choice((", ", "; ", " (", " "))
        text += f"{word} {value}{close}the "
        want += f"{word} {make(value, KEY)}{close}the "
        counts[kind] += 1
    return text, want, counts


def test_scan_against_planted_values(spark):
    r = random.Random(12)
    cases = [planted(r) for _ in range(300)]
    got = p.pseudonymise(spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "doc_id long, text string"), KEY).collect()
    for row in got:
        text, want, counts = cases[row["doc_id"]]
        assert row["text"] == want, text
        assert {k: row[f"n_{k}"] for k in p.KINDS} == counts


def test_mail_names_are_permuted_whole_or_not_at_all():
    for n in (1, 63, 64):
        ((a, b, kind, new),) = p.found("x" * 3 + " " + "a" * n + "@example.org", b"k")
        assert (a, kind) == (4, "email") and b == 4 + n + 12 and len(new) == n + 12
    assert p.found("a" * 65 + "@example.org", b"k") == [] and p.found("a" * 700 + "@example.org", b"k") == []
