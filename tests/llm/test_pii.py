"""Format-preserving pseudonyms: validity, linking, bijections, and texts left alone."""

import random
import re
import time
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seedloom.llm import pii

KEY = b"test"
OWN = pii.Pseudonyms(KEY)


def new(text):
    return OWN.replace(text)[0]


def kinds(text):
    return {kind.name: n for kind, n in zip(pii.KINDS, OWN.replace(text)[1]) if n}


@pytest.mark.parametrize("size", [1, 2, 3, 7, 10, 64, 100, 1000, 1025])
def test_permutation_of_every_size(size):
    permute = pii.Permutation(KEY)
    assert sorted(permute("a", i, size) for i in range(size)) == list(range(size))


def test_keys_and_kinds_give_other_permutations():
    rows = {tuple(pii.Permutation(key)(kind, i, 1000) for i in range(20)) for key in (b"a", b"b") for kind in ("x", "y")}
    assert len(rows) == 4
    with pytest.raises(ValueError):
        pii.Permutation(b"")


@pytest.mark.parametrize(
    ("text", "kind", "form"),
    [
        ("el.01@mail8.example.com", "email", r"[a-z]{2}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com"),
        ("éàü.12@mail.example.com", "email", r"[à-þ]{3}\.\d\d@[a-z]{4}\.[a-z]{7}\.com"),
        ("4768280566741189", "card", r"\d{16}"),
        ("4111 1111 1111 1111", "card", r"\d{4} \d{4} \d{4} \d{4}"),
        ("+1 (115) 555-9688", "phone", r"\+1 \(\d{3}\) \d{3}-\d{4}"),
        ("(372) 555-7739", "phone", r"\(\d{3}\) \d{3}-\d{4}"),
        ("+44 20 7946 0958", "phone", r"\+44 \d\d \d{4} \d{4}"),
        ("97.51.17.173", "address", r"\d{1,3}(\.\d{1,3}){3}"),
        ("123-45-6789", "social", r"\d{3}-\d\d-\d{4}"),
        ("2020-02-29", "date", r"\d{4}-\d\d-\d\d"),
        ("31/12/1999", "date", r"\d\d/\d\d/\d{4}"),
        ("12/31/1999", "date", r"\d\d/\d\d/\d{4}"),
        ("DE89 3704 0044 0532 0130 00", "iban", r"DE\d\d( \d{4}){4} \d\d"),
        ("GB82WEST12345698765432", "iban", r"GB\d\d[A-Z0-9]{18}"),
        ("9c8b45435718dcc700c184a7e303cdc64c6a8f7f", "secret", r"[0-9a-f]{40}"),
    ],
)
def test_values_change_within_their_format(text, kind, form):
    around = f"of the {text}, and\n({text})$$$"
    changed = new(around)
    found = re.fullmatch(rf"of the ({form}), and\n\(({form})\)\$\$\$", changed)
    assert found and found.group(1) != text and kinds(around) == {kind: 2}
    assert kinds(changed) == {kind: 2}, "a pseudonym is a valid value of its kind"
    assert pii.Pseudonyms(b"other").replace(around)[0] != changed
    assert pii.Pseudonyms(KEY).replace(around)[0] == changed


@pytest.mark.parametrize(
    "text",
    [
        "", "plain words", "4768280566741188", "0000000000000000", "1.2.3.400", "01.2.3.4", "1.2.3.4.5", "000-12-3456",
        "666-12-3456", "2021-02-30", "30.02.2001", "12345", "a@b", "version 1.2.3", "DE88 3704 0044 0532 0130 00",
        "price 1999-00", "x4768280566741189", "e" * 500,
    ],
)
def test_what_is_no_valid_value_stays(text):
    assert new(text) == text and not kinds(text)


def test_neighbours_do_not_hide_each_other():
    text = "4768280566741189 5425233430109903 +1 (115) 555-9688 97.51.17.173 el.01@mail8.example.com"
    assert kinds(text) == {"card": 2, "phone": 1, "address": 1, "email": 1}


def test_case_is_kept_and_linked():
    assert new("EL.01@MAIL8.EXAMPLE.COM") == new("el.01@mail8.example.com").upper()
    token = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f"
    assert new(f'TOKEN = "{token.upper()}"') == new(f'token = "{token}"').upper()


def test_equal_domains_stay_linked():
    first, second = new("one@mail.example.com"), new("other@mail.example.com")
    assert first.split("@")[1] == second.split("@")[1] and first.split("@")[0] != second.split("@")[0][:3]


@given(st.dates(date(1900, 1, 1), date(2099, 12, 31)), st.sampled_from(["%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d.%m.%Y"]))
@settings(max_examples=200, deadline=None)
def test_dates_stay_in_their_order(day, form):
    text = day.strftime(form)
    sign, order, _ = pii.read_date(text)
    assert pii.read_date(new(text))[:2] == (sign, order)


@given(st.lists(st.integers(0, 10**15 - 1), min_size=2, max_size=30, unique=True))
@settings(max_examples=50, deadline=None)
def test_cards_stay_apart(bodies):
    cards = [f"{b:015d}" + pii.luhn_digit(f"{b:015d}") for b in bodies]
    changed = [pii.new_card(OWN.permute, card) for card in cards]
    assert len(set(changed)) == len(cards) and all(pii.luhn_digit(c[:-1]) == c[-1] for c in changed)


@given(st.integers(1, 898), st.integers(1, 99), st.integers(1, 9999))
@settings(max_examples=100, deadline=None)
def test_social_numbers_stay_valid(area, group, serial):
    area += area >= 666
    assert kinds(f"{area:03d}-{group:02d}-{serial:04d}") == {"social": 1}
    assert kinds(new(f"{area:03d}-{group:02d}-{serial:04d}")) == {"social": 1}


@pytest.mark.parametrize(
    "before, value, after",
    [
        ('token="', "aB3" * 33_334, '" x'), ("", "q" * 100_000, "@example.com"), ("", "A1" * 50_000, "@ex-ample.org"),
        ("password: ", "correcthorse" * 9_000, ""), ("secret=", "0f" * 50_000, " z"),
    ],
)
def test_long_values_in_linear_time(before, value, after):
    start = time.process_time()
    new, found = OWN.replace(before + value + after)
    assert time.process_time() - start < 2 and sum(found) == 1
    assert len(new) == len(before + value + after) and new.startswith(before) and value not in new


@pytest.mark.parametrize(
    "text",
    [
        "a" * 200_000 + " x@y", "a." * 100_000 + " b@c", "x@" + "a." * 100_000 + "1", "@" * 200_000, "token" + " " * 200_000 + "x",
        "token " * 40_000, "DE89 " * 20_000, "1-" * 100_000, "+1 " * 60_000, "abcdef0123" * 20_000, "=" * 200_000,
    ],
)
def test_long_runs_without_values_in_linear_time(text):
    start = time.process_time()
    assert OWN.replace(text)[0] == text
    assert time.process_time() - start < 2


def test_every_character_of_a_long_value_counts():
    base = "ab01" * 50
    own = {pii.new_secret(OWN.permute, base)}
    for at in (0, 70, 199):
        other = base[:at] + "z" + base[at + 1 :]
        new = pii.new_secret(OWN.permute, other)
        own.add(new)
        assert sum(a == b for a, b in zip(new, pii.new_secret(OWN.permute, base))) < 40
    assert len(own) == 4
    draw = random.Random(3)
    many = {"".join(draw.choice("xy01") for _ in range(130)) for _ in range(500)}
    assert len({pii.permute_text(OWN.permute, "x", value, (pii.DIGITS, pii.LETTERS)) for value in many}) == len(many)


def test_secrets_do_not_depend_on_digits_elsewhere():
    plain = OWN.replace("password: correcthorsebatterystaple")[0]
    assert "correcthorse" not in plain
    assert OWN.replace("password: correcthorsebatterystaple 7")[0] == plain + " 7"


def test_numbers_of_no_issuer_stay():
    for body in ("753678412781305", "987654321012345", "184516811440732"):
        number = body + pii.luhn_digit(body)
        assert OWN.replace(f"x {number} y")[0] == f"x {number} y"
    body = "222100000000000"
    new = OWN.replace(body + pii.luhn_digit(body))[0]
    assert pii.has_issuer(new) and pii.luhn_digit(new[:-1]) == new[-1]


def test_frames(spark, odd_documents, no_documents):
    done = pii.pseudonymize(odd_documents, KEY)
    assert set(done.columns) == set(odd_documents.columns) | {"found"}
    clean = [r["text"] for r in odd_documents.select("text").collect()]
    assert sorted(r["text"] or "" for r in done.select("text").collect()) == sorted(t or "" for t in clean)
    assert pii.pseudonymize(no_documents, KEY).count() == 0
    rows = [(i, f"call {'word ' * (i % 3)}+1 (115) 555-9688 now") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {re.search(r"\+1.*\d", r["text"]).group() for r in pii.pseudonymize(df, KEY).collect()}
    assert len(found) == 1, "equal values are linked across documents"


def test_very_long_text():
    text = ("word " * 100_000) + "el.01@mail8.example.com " + "9" * 100_000 + "@" * 1000
    assert kinds(text) == {"email": 1}


IBANS = [
    "BE68 5390 0754 7034", "ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "ES9121000418450200051332",
    "SE45 5000 0000 0583 9825 7466", "PL61109010140000071219812874", "NO93 8601 1117 947", "DE89 3704 0044 0532 0130 00",
]


@pytest.mark.parametrize("value", IBANS)
@pytest.mark.parametrize("after", ["", " BIC GKCCBEBB", " EUR 50", " 2024", " NEXT WORD 1234", f" {IBANS[1]}", " AB12 CODE THEN"])
def test_accounts_before_upper_case_words_and_digits(value, after):
    changed = new(f"AB12 CODE {value}{after}")
    same = changed.removeprefix("AB12 CODE ")[: len(value)]
    assert kinds(f"AB12 CODE {value}{after}") == {"iban": 1 + after.count(IBANS[1])}
    assert same != value and same == new(value) and kinds(same) == {"iban": 1}
    assert changed.endswith(new(after))


def test_accounts_of_other_countries_and_lengths_stay_found():
    for country, account in (("ZZ", "12345678901234"), ("DE", "12345678901234567890")):
        value = f"{country}{98 - pii.iban_rest(country, '00', account):02d}{account}"
        assert kinds(f"to {value}, and") == {"iban": 1}


@pytest.mark.parametrize(
    ("text", "form"),
    [
        ("1984-03-12T00:00:00", r"\d{4}-\d\d-\d\dT00:00:00"), ("1984/03/12", r"\d{4}/\d\d/\d\d"),
        ("3/4/1984", r"\d/\d/\d{4}"), ("12/31/1984", r"\d\d/\d\d/\d{4}"), ("12.3.1984", r"\d\d\.\d\.\d{4}"),
        ("3.12.1984", r"\d\.\d\d\.\d{4}"), ("1984-3-2", r"\d{4}-\d-\d"),
    ],
)
def test_other_forms_of_dates(text, form):
    changed = new(f"on {text}.")
    assert kinds(f"on {text}.") == kinds(changed) == {"date": 1}
    assert re.fullmatch(rf"on {form}\.", changed) and changed != f"on {text}."


def test_dates_linked_across_forms_and_apart():
    assert new("1984-03-12T10:00") == new("1984-03-12") + "T10:00" and new("1984/03/12") == new("1984-03-12").replace("-", "/")
    days = [f"{d}/{m}/{y}" for d in range(1, 10) for m in range(1, 10) for y in range(1980, 1990)]
    assert len({new(day) for day in days}) == len(days)
    assert [new(t) for t in ("31/2/1984", "3/4/84", "1984-03/12", "/1984/03/12")] == ["31/2/1984", "3/4/84", "1984-03/12", "/1984/03/12"]
