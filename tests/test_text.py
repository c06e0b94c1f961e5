import math

import pytest

from kindred.functions import text as X
from kindred.functions.similarity import jaro_winkler_value, matching_share, token_set_share, token_sort_share


@pytest.mark.parametrize("value", [None, math.nan, "", "  ", "N/A", "--", "Null", "nil"])
def test_missing(value):
    assert X.missing(value)


@pytest.mark.parametrize(
    ("raw", "want"),
    [("  The  ＡＣＭＥ ", "the acme"), ("L.L.C. firm", "llc firm"), ("price 1.5 a.", "price 1.5 a"), ("see www.shop.co.in now", "see www.shop.co.in now"), ("O’Neil—Sons", "o'neil-sons"), (None, "")],
)
def test_basic(raw, want):
    assert X.basic(raw) == want


def test_accents_go_from_latin_only():
    assert X.without_accents("cónsumer ø ł") == "consumer o l"
    assert X.without_accents("महाराष्ट्र") == "महाराष्ट्र"


@pytest.mark.parametrize(("raw", "want"), [("abc", "latin"), ("दिल्ली", "indic"), ("abc दिल्ली", "mixed"), ("12 !", "unknown"), ("город", "other")])
def test_script_family(raw, want):
    assert X.script_family(raw) == want


@pytest.mark.parametrize(("raw", "want"), [("प्राइवेट", "praivet"), ("लिमिटेड", "limited"), ("दिल्ली", "dilli"), ("plain", "plain")])
def test_transliterated(raw, want):
    assert X.transliterated(raw) == want


def test_sound_keys_meet_across_scripts():
    assert X.sound_key("private") == X.sound_key("प्राइवेट") == "prpt"
    assert X.sound_key("united") == X.sound_key("yunaited")
    assert X.sound_key("") == ""


def test_names():
    a, b = X.name_parts("Acme Trading Pvt. Ltd."), X.name_parts("Private Limited Acme Trading")
    assert a["core_latin"] == b["core_latin"] == "acme trading"
    assert a["legal"] == ["private limited"]
    assert X.name_parts("Foo LLC d/b/a Bar Traders")["aliases"] == ["foo", "bar traders"]
    assert X.name_parts("www.best-shop.co.in")["website_label"] == "bestshop"
    assert X.name_parts("C0mputer World Inc")["core_latin"] == "computer world"
    assert X.name_parts("Ltd")["core_latin"] == "ltd"
    assert X.name_parts(None)["core"] == ""


def test_addresses():
    a = X.address_parts("H No 0012-A, MG Road, Pune City, Maharashtra, 411001", "india")
    assert (a["state"], a["house"], a["street"], a["city"]) == ("mh", "12-a", "mg rd", "pune")
    assert X.address_parts("Pune, महाराष्ट्र", "in")["state"] == "mh"
    assert X.address_parts("PO Box 055, Springfield, IL", "us")["po_box"] == "55"
    assert X.address_parts("12 rue x, texas", "france")["state"] == "tx"
    assert X.address_parts("12 rue x, or", "france")["state"] == ""
    assert X.address_parts("null", "us")["components"] == []


def test_grams_and_numbers():
    assert X.char_grams("abcd x") == ["#ab", "abc", "bcd", "cd#", "#x#"]
    assert X.number_runs("a007 b0 12") == ["7", "0", "12"]


def test_similarities():
    assert jaro_winkler_value("abcdef", "abzzzz") == pytest.approx(0.5556, abs=1e-4)
    assert jaro_winkler_value("", "") == 0 and jaro_winkler_value(None, "a") is None and jaro_winkler_value("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert matching_share("abcd", "abce") == 75 and token_sort_share("b a", "a b") == 100 and token_set_share("a b", "a b c") == 100


def test_records(spark):
    rows = [(1, "Acme Trading Pvt Ltd", "12 Main Street, Austin, TX", "US"), (2, None, None, None), (3, "प्राइवेट शॉप", "N/A", "India")]
    found = {r.id: r for r in X.records(spark.createDataFrame(rows, "id long, business_name string, business_address string, country string")).collect()}
    assert found[1]["keys"] == ["acmetrading"] and found[1].hn == "12" and found[1].state == "tx" and found[1].addr_missing is False
    assert found[2].name_key == "" and found[2]["keys"] == [] and found[2].addr_missing
    assert found[3].name_indic and found[3].addr_missing


def test_ratios_of_many_pairs(monkeypatch):
    """pairs were compared letter by letter in Python."""
    import random
    import time

    import pandas as pd

    from kindred.functions import similarity as S

    rng = random.Random(3)
    text = lambda: " ".join("".join(rng.choice("abcé\U0001f600") for _ in range(rng.choice((1, 2, 5, 40)))) for _ in range(rng.choice((0, 1, 2, 3, 6))))
    rows = [(text(), text()) for _ in range(600)] + [("", ""), (None, "a"), ("a", None), ("x" * 64, "x" * 64), ("a b", "b a c"), (" ", "a"), ("a" * 65, "b" + "a" * 64)] * 2
    one = lambda x, y: (matching_share(x, y), token_sort_share(x, y), token_set_share(x, y))
    want = [one(x or "", y or "") for x, y in rows]
    for table in (S.TABLE, 500):
        monkeypatch.setattr(S, "TABLE", table)
        got = S.fuzzy_values(pd.Series([x for x, _ in rows]), pd.Series([y for _, y in rows]))
        assert list(map(tuple, got[["ratio", "token_sort", "token_set"]].itertuples(index=False))) == want
    assert S.fuzzy_values(pd.Series([], dtype=object), pd.Series([], dtype=object)).empty
    monkeypatch.undo()
    many = [(f"small blue bolt {k} brand#{k % 25} standard", f"large ring {k % 977} brand#7 economy") for k in range(4000)]
    began = time.process_time()
    S.fuzzy_values(*(pd.Series(x) for x in zip(*many)))
    new, began = time.process_time() - began, time.process_time()
    [one(x, y) for x, y in many[:400]]
    assert new < 3 * (time.process_time() - began)  # ten times the pairs
