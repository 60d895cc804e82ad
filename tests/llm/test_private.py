import datetime as dt
import re

import pytest

from crawlsight.llm import private, queries  # noqa: F401
from tests.llm import cases

KEY = b"k"


def one(text):
    return private.pseudonymised(text, KEY, dict.fromkeys(private.KINDS, 0))


@pytest.mark.parametrize("size", [1, 2, 7, 10, 97, 1000])
def test_permutation(size):
    assert sorted(private.permuted(i, size, KEY, "x") for i in range(size)) == list(range(size))


def test_key_and_kind_matter():
    assert len({private.permuted(5, 10**9, key, kind) for key in (b"a", b"b") for kind in "xy"}) == 4


@pytest.mark.parametrize(
    "text",
    [
        "card 4111 1111 1111 1111 here", "4111111111111111!!", "3782-822463-10005", "+1 (555) 123-4567", "Call 555-123-4567.",
        "und.34@mail7.example.com", "(a.b-c@x.org)", "97.51.17.173", "day 1999-12-31, ", "31.12.1999", "12/31/1999", "id 123-45-6789",
    ],
)
def test_values_change_and_keep_their_format(text):
    new = one(text)
    shape = lambda t: re.sub("[0-9]", "9", re.sub("[a-z]", "a", t))
    assert new != text and len(new) == len(text)
    if "@" not in text:
        assert shape(new) == shape(text)
    assert one(text) == new


@pytest.mark.parametrize(
    "text", ["4111111111111112", "999.1.1.1", "2.0.", "1999-02-30", "000-12-3456", "words only", "", "a@b", "123456789012", "1.2.3.4.5", "@"]
)
def test_what_is_not_valid_stays(text):
    assert one(text) == text


def test_validity_is_kept_and_values_stay_linked():
    cards = [p + private.check_digit(p) for p in (f"4{i:014d}" for i in range(300))]
    new = [one(c) for c in cards]
    assert len(set(new)) == 300 and all(private.check_digit(c[:-1]) == c[-1] for c in new)
    assert one(f"x {cards[7]} y") == f"x {new[7]} y"
    assert one("4111 1111 1111 1111").replace(" ", "") == one("4111111111111111")
    days = [one((dt.date(2001, 1, 1) + dt.timedelta(i)).isoformat()) for i in range(400)]
    assert len(set(days)) == 400 and all(dt.date.fromisoformat(d) for d in days)
    assert all(int(o) < 256 for i in range(200) for o in one(f"10.200.{i}.7").split("."))


@pytest.mark.parametrize("before", ["", "line\n", "Tel:", "Tel: ", "(", "x,"])
@pytest.mark.parametrize(
    "number", ["555-123-4567", "555.123.4567", "(555) 123-4567", "+1 555 123 4567", "+15551234567", "+44 20 7946 0958", "+44 (0)20 7946 0958", "+442079460958", "+49 30 123456", "+372 512 3456"]
)
def test_phone_numbers_are_found_wherever_they_stand(before, number):
    new = one(f"{before}{number})\nend")
    assert new.startswith(before) and new.endswith(")\nend")
    new = new[len(before) : -5]
    code = re.match(r"([+](1|44|49|372))?", number)[0]
    assert new != number and new.startswith(code) and re.sub("[0-9]", "9", new) == re.sub("[0-9]", "9", number)


def test_a_phone_number_has_one_pseudonym_in_all_its_forms():
    forms = ["555-123-4567", "+1 (555) 123-4567", "+1.555.123.4567", "+15551234567"]
    assert len({re.sub("[^0-9]", "", one(f))[-10:] for f in forms}) == 1
    assert one("+44 20 7946 0958").replace(" ", "") == one("+442079460958")


@pytest.mark.parametrize("text", ["1555-123-4567", "555-123-45678", "+123456", "a+15551234567", "+1234567890123456", "2+5551234567"])
def test_what_is_no_phone_number_stays(text):
    assert one(text) == text


def test_no_two_dates_share_a_pseudonym():
    """All days of the range in both readings, 117,000 texts."""
    days = [dt.date.fromordinal(private.FIRST_DAY + i) for i in range(private.DAYS)]
    dates = {d.strftime("%d/%m/%Y") for d in days} | {d.strftime("%m/%d/%Y") for d in days}
    fresh = {text: private._date(text, KEY) for text in dates}
    assert set(fresh.values()) == dates
    assert private._date("04/10/1900", KEY) != private._date("11/13/1900", KEY)
    assert int(private._date("11/13/1900", KEY)[3:5]) > 12


def test_tables(spark):
    rows = cases.odd_rows() + [(900, "mail und.34@mail7.example.com and 97.51.17.173", "en", "s0", 1)] * 2
    docs = cases.table(spark, rows)
    whole = private.pseudonyms(docs, KEY)
    assert whole.schema == docs.schema
    key = lambda r: (r[0] or -1, r[1] or "")
    assert sorted([(r.doc_id, r.text) for r in whole.collect()], key=key) == sorted(
        [(d, None if t is None else one(t)) for d, t, *_ in rows], key=key
    )
    told = private.pseudonyms(docs, KEY, keep=("doc_id", "text"), counts=True).where("doc_id = 900").collect()
    assert [(r.n_email, r.n_ip, r.n_card) for r in told] == [(1, 1, 0)] * 2
    assert private.pseudonyms(cases.empty(spark), KEY).collect() == []
    with pytest.raises(ValueError):
        private.pseudonyms(docs, b"")
