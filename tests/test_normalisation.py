"""Literal cases of text normalisation."""

import math

import pytest

from kindred.functions import text as X
from kindred.functions.scripts import char_grams, number_runs


def tr(s):
    return X.transliterated(X.basic(s))


def key(s):
    return X.sound_key(X.basic(s))


def core(s):
    return X.name_parts(s)["core_latin"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [("  NORTH   Pvt. Ltd. ", "north pvt ltd"), ("OFFICE OF  PUBLIC\tWORKS", "office of public works"), ("Tall Oak Advisors L.L.P.", "tall oak advisors llp"), ("Anna B. Field, MD, P.C.", "anna b field, md, pc"), ("Release 3.5", "release 3.5"), ("OAKTERM.COM", "oakterm.com"), ("Norah’s​ Iron", "norah's iron"), ("इंडियन इंटरनेशनल प्राइवेट लिमिटेड", "इंडियन इंटरनेशनल प्राइवेट लिमिटेड"), (math.nan, ""), ("   ", "")],
)
def test_basic_form(raw, want):
    assert X.basic(raw) == want


def test_accents():
    assert X.without_accents("Divísion óf Térm Índia") == "Division of Term India"
    for s in ("लिमिटेड", "ಕರ್ನಾಟಕ", "ગુજરાત", "தமிழ்நாடு"):
        assert X.without_accents(s) == s
    assert X.without_accents("Résort ગુજરાત") == "Resort ગુજરાત"


@pytest.mark.parametrize(("text", "script"), [("बिहार", "devanagari"), ("পশ্চিমবঙ্গ", "bengali"), ("ਪੰਜਾਬ", "gurmukhi"), ("ગુજરાત", "gujarati"), ("ଓଡ଼ିଶା", "oriya"), ("தமிழ்நாடு", "tamil"), ("తెలంగాణ", "telugu"), ("ಕರ್ನಾಟಕ", "kannada"), ("കേരളം", "malayalam")])
def test_scripts(text, script):
    assert set(X.scripts(text)) == {script} and X.script_family(text) == "indic"


def test_families():
    assert [X.script_family(s) for s in ("Peak Works LLC", "Cónsumer", "North ఇంటర్నేషనల్", "Москва", "123 - #", "")] == ["latin", "latin", "mixed", "other", "unknown", "unknown"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        *((w, "limited") for w in ("लिमिटेड", "লিমিটেড", "લિમિટેડ", "ଲିମିଟେଡ୍", "లిమిటెడ్", "ಲಿಮಿಟೆಡ್")),
        *((w, "elelpi") for w in ("एलएलपी", "ఎల్‌ఎల్‌పీ", "എൽഎൽപി", "ಎಲ್ಎಲ್‌ಪಿ", "ਐਲਐਲਪੀ")),
        ("प्राइवेट", "praivet"), ("इंडियन", "indiyan"), ("ग्लोबल", "global"), ("टेक", "tek"), ("ஃபுட்ஸ்", "futs"), ("ഇന്റർനാഷണൽ", "intarnashanal"), ("സിറ്റി", "sitti"),
        ("Cónsumer Affairs", "consumer affairs"), ("North ఇంటర్నేషనల్", "north intarneshanal"), (None, ""), ("१२३ ౪౫", "123 45"),
    ],
)
def test_transliteration(raw, want):
    assert tr(raw) == want


def test_sound_keys():
    for a, b in (("private", "प्राइवेट"), ("global", "ग्लोबल"), ("trading", "டிரேடிங்"), ("investment", "ଇନଭେଷ୍ଟମେଣ୍ଟ୍"), ("eastern", "इस्टर्न")):
        assert key(a) == key(b), a
    assert key("") == "" and key("yunaited") == key("united")


def test_sound_key_is_the_same_in_built_in_functions(spark, small):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{small}/documents.parquet").select(F.regexp_replace(F.lower("text"), "[^a-z0-9 ]", " ").alias("t"))
    docs = docs.select(F.trim(F.regexp_replace("t", " +", " ")).alias("t")).limit(300)
    rows = docs.select("t", X.ascii_sound_key(F.col("t")).alias("k")).collect() + spark.createDataFrame([("yuuccckh chhq ckhx yu a ee oo",)], "t string").select("t", X.ascii_sound_key(F.col("t")).alias("k")).collect()
    assert len(rows) > 100 and all(r.k == X.sound_key(r.t) for r in rows)


def test_name_forms():
    n = X.name_parts("*** Norah'S Iron Works")
    assert (n["raw"], n["basic"], n["punct"], n["core_latin"], n["compact"]) == ("*** Norah'S Iron Works", "*** norah's iron works", "norahs iron works", "norahs iron works", "norahsironworks")
    for v in ("Bright Energy Private Limited", "Bright Energy Pvt. Ltd.", "Bright Energy-Private-Limited", "Private Bright Energy Ltd", "Bright Energy Pvt Limited", "Bright Energy (P) Ltd"):
        assert core(v) == "bright energy", v
    n = X.name_parts("Bright Energy Pvt. Ltd.")
    assert n["legal"] == ["private limited"] and n["canonical"] == "bright energy private limited"


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Ridge Entry (PLLC)", "ridge entry"), ("Tall Oak Advisors L.L.P.", "tall oak advisors"), ("Inc Family Mdwest Partners", "family mdwest partners"), ("Land & Field Incorporated", "land and field"), ("J.P. Harris & Co", "jp harris"), ("Co Op Bank", "co op bank"), ("Company", "company"), ("Limited Om Private Center", "om private center"), ("Consolidated Learning Systems Inc", "consolidated learning systems"), ("Foo Co And", "foo co"), ("The Fresh Deli Care", "fresh deli care"), ("M/s. Sharma Traders", "sharma traders"), ("#OAK TÉRM", "oak term"), (">> CRYSTAL CLOTH", "crystal cloth"), ("3rd Street Deli", "3rd street deli"), ("... 5ervices Nagar Welfare Private Limited", "services nagar welfare"), ("wi1son, rosa, dds", "wilson rosa dds")],
)
def test_core(raw, want):
    assert core(raw) == want


def test_legal_forms():
    assert X.name_parts("Ridge Entry Pllc")["legal"] == ["pllc"] and X.name_parts("Co Op Bank")["legal"] == []
    n = X.name_parts("इंडियन इंटरनेशनल प्राइवेट लिमिटेड")
    assert (n["legal"], n["core"], n["core_latin"]) == (["private limited"], "इंडियन इंटरनेशनल", "indiyan intarneshnal")
    assert X.name_parts("ईस्ट सॉल्यूशंस प्रा. लि.")["legal"] == ["private limited"] and X.name_parts("રામ ઓલ કન્સલ્ટિંગ એલએલપી")["legal"] == ["llp"]
    n = X.name_parts("North ఇంటర్నేషనల్ ప్రైవేట్ లిమిటెడ్")
    assert (n["script"], n["core_latin"], n["legal"]) == ("mixed", "north intarneshanal", ["private limited"])


def test_aliases():
    n = X.name_parts("Quellora a/k/a Harbour Trading Private Limited")
    assert (n["alias_marker"], n["aliases"]) == ("a/k/a", ["quellora", "harbour trading"]) and "harbour trading" in n["variants"]
    assert X.name_parts("Nexolan formerly known as Kestrel Works Private Limited")["aliases"] == ["nexolan", "kestrel works"]
    assert X.name_parts("Belquora DBA: #Orin Term")["aliases"] == ["belquora", "orin term"] and X.name_parts("Belquora DBA : Orin")["aliases"] == ["belquora", "orin"]
    assert X.name_parts("Umbra t/a Anna Field")["alias_marker"] == "t/a" and X.name_parts("Tavolin aka GT Rapid LLC")["aliases"] == ["tavolin", "gt rapid"]
    for s in ("Dba Brothers Pvt Ltd", "Aka Holdings", "T/A Post Inc."):
        assert X.name_parts(s)["alias_marker"] == "", s


def test_websites():
    n = X.name_parts("oakterm.com")
    assert (n["website"], n["website_label"], n["core_latin"]) == ("oakterm.com", "oakterm", "oakterm")
    for s, label in (("... PEAKBNY.COM", "peakbny"), ("www.acme-tools.co.in", "acmetools"), ("5ERVICESNAGARWELFARE.COM", "servicesnagarwelfare"), ("ílluminateinvest.com", "illuminateinvest"), ("premiersons.com", X.name_parts("Premier & Sons Private Limited")["compact"])):
        assert X.name_parts(s)["website_label"] == label, s
    for s in ("St. Louis Bakery", "J.P. Harris", "Vinayaka.Plaza Traders", "No.1 Tailors"):
        assert X.name_parts(s)["website"] == "", s


def test_name_descriptors():
    f = X.name_descriptors("Belquora DBA: #Orin Térm")
    assert len(f) == 17 and f["name_has_alias"] and f["name_has_latin_accent"] and not f["name_is_website"]
    f = X.name_descriptors("एपेक्स मीडिया लिमिटेड")
    assert f["name_is_indic"] and f["name_scripts"] == "devanagari" and f["name_legal_forms"] == "limited"
    assert X.name_descriptors(None)["name_is_missing"] and X.name_descriptors("...ACME 0ne.COM x")["name_has_junk_prefix"]


@pytest.mark.parametrize(("value", "country", "want"), [("West Virginia", "us", "wv"), ("WV", "us", "wv"), ("IN", "us", "in"), ("Springfield", "us", ""), ("Maharashtra", "india", "mh"), ("महाराष्ट्र", "india", "mh"), ("Orissa", "india", "od"), ("ଓଡ଼ିଶା", "india", "od"), ("TS", "india", "tg"), ("Keralam", "india", "kl"), ("GA", "us", "ga"), ("Goa", "india", "ga"), ("AR", "", ""), ("Texas", "", "tx")])
def test_states(value, country, want):
    assert X.state_code(value, country) == want


def at(raw, country="us"):
    return X.address_parts(raw, country)


def test_addresses_with_other_spellings():
    a, b = at("00318 MILLER RD, COALTON, WV"), at("318 Miller Road, Coalton, West Virginia")
    assert a["normalized"] == b["normalized"] and (a["house_core"], a["street"], a["city"], a["state"]) == ("318", "miller rd", "coalton", "wv") and a["raw"] == "00318 MILLER RD, COALTON, WV"
    a, b = at("Fair Point, 627 Heron Lane, WV"), at("00627 Heron Ln, Fair Point, West Virginia")
    assert a["component_set"] == b["component_set"] and a["components"] != b["components"] and all(a[k] == b[k] for k in ("house_core", "street", "city", "state"))


def test_house_numbers():
    assert at("Croton On Hudson, New York, 264B Farm Avenue")["house_core"] == at("264 Farm Avenue, Croton-on-hudson, NY")["house_core"] == "264"
    a = at("4100-4106 F M RD 2210, BURLTON, TX")
    assert (a["house"], a["house_core"]) == ("4100-4106", "4100")
    assert [at(s, "india")["house"] for s in ("H.NO. 58, FARIDABAD, Haryana", "D-63, DELHI, दिल्ली", "C-##45, AJMER ROAD, Rajasthan")] == ["58", "d-63", "c-45"]


def test_noise():
    a = at("5120 31st Avenue, NULL, Seattle, Washington")
    assert (a["normalized"], a["noise_removed"]) == ("5120 31st ave, seattle, wa", 1)
    b = at("B-902, null, Andheri West, Mumbai, MH", "india")
    assert b["state"] == "mh" and "null" not in b["tokens"]
    c = at("HOUSE NO4-2718, PATIALA, <NULL>, Punjab", "india")
    assert (c["state"], c["city"]) == ("pb", "patiala") and at("##27035 HAVEN PLACE, AVON, OH")["house"] == "27035"
    assert at("Landers Road, N/A, Lincolnton, North Carolina")["components"] == ["landers rd", "lincolnton", "nc"]
    for v in (None, "", "   ", "N/A", "null", "<NULL>", math.nan):
        assert at(v)["is_missing"] and at(v)["components"] == []


def test_streets_units_boxes_places():
    assert at("2317 NINTH ST, FORT WAYNE, IN")["normalized"] == at("2317 9th Street, Fort Wayne, Indiana")["normalized"]
    assert at("East Windsor, CT")["city"] == at("CT, LEDGE RD, E WINDSOR")["city"] == "e windsor"
    a = at("5120 31ST AVE, PMB 4417, SEATTLE, WA")
    assert (a["unit"], a["city"]) == ("pmb 4417", "seattle")
    b = at("6312 HENRY ST, PO BOX 2741, NORFOLK, VA")
    assert (b["po_box"], b["house_core"]) == ("2741", "6312") and at("1900 Cedar Drive, Unit APARTMENT K, Dundalk, MD")["unit"] == "unit apt k"
    d = at("P O Box No: 2208 7/3051, Lake Road, Aluva, Ernakulam, Kerala", "india")
    assert (d["po_box"], d["state"], d["house"]) == ("2208", "kl", "")
    a = at("Room-4, B-17C 2nd Floor, Garden Colony (East), Delhi, South Delhi, Delhi", "india")
    assert (a["state"], a["city"], a["places"]) == ("dl", "s delhi", ["garden colony e", "delhi", "s delhi"]) and at("Radiology, 1408 Elm, MESA CITY, Arizona")["city"] == "mesa"
    a, b = at("OFFICE NO 407, PLOT NO 23, LOTUS PLAZA, AIROLI, THANE, महाराष्ट्र", "india"), at("Thane, Plot No 23, Lotus Plaza, Airoli, MH, Office No 407", "india")
    assert a["state"] == b["state"] == "mh" and a["state_raw"] == "महाराष्ट्र" and set(a["numbers"]) == set(b["numbers"]) == {"407", "23"}


def test_address_descriptors():
    f = X.address_descriptors("00318 MILLER RD, COALTON, WV", "us")
    assert len(f) == 18 and f["addr_has_zero_padded_number"] and f["addr_is_all_upper"] and f["addr_state"] == "wv" and X.address_descriptors(None)["addr_is_missing"]


def test_tokens():
    assert X.words_of(X.basic("Tall All-Consulting (L.L.P.)")) == ["tall", "all", "consulting", "llp"] and X.words_of("प्राइवेट लिमिटेड") == ["प्राइवेट", "लिमिटेड"]
    assert number_runs("00123 Rd, 4310b, C-067") == ["123", "4310", "67"] and char_grams("tek") == ["#te", "tek", "ek#"] and char_grams("ab") == ["#ab", "ab#"]


def test_columns(spark):
    rows = [("S2-17", 1, "Acme & Sons Pvt Ltd t/a oakterm.com", "Plot No 0012, MG Road, Pune City, Maharashtra", " India "), ("bad", 2, None, None, None)]
    source = spark.createDataFrame(rows, "entity_id string, id long, business_name string, business_address string, country string")
    flat = {r.id: r for r in X.flat_records(source).collect()}
    assert len(flat[1]) == 21 and (flat[1].name_aliases, flat[1].addr_house_number_core, flat[1].addr_city) == ("acme and sons|oakterm com", "12", "pune") and flat[2].addr_is_missing
    wide = {r.entity_id if "entity_id" in r else r.rid: r for r in X.wide_records(source).collect()}
    assert len(wide[20000000017]) == 21 and wide[20000000017].country == "India" and wide[20000000017].name_grams[:2] == ["#ac", "acm"] and wide[None].name_core is None and wide[None].name_aliases == []
    facts = source.select(X.name_facts("business_name").alias("n"), X.address_facts("business_address", "country").alias("a"), X.script_counts("business_name").alias("s")).collect()
    assert facts[0].n.name_alias_marker == "t/a" and facts[0].a.addr_state == "mh" and facts[0].s["latin"] > 9 and facts[1].s == {}
