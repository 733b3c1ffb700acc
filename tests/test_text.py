import pytest
from pyspark.sql import functions as F

from intentmill.functions.text import WHITE_SPACE, clean_query, normalize_type, strip
from intentmill.options import CLASSES


# text, cleaned, cleaned without lower-casing, cleaned with punctuation kept
CLEANED = [
    ("Ça va?  c'est 3²—x_y", "ça va c est 3² x_y", "Ça va c est 3² x_y", "ça va? c'est 3²—x_y"),
    ("?!…—", "", "", "?!…—"),
    ("", "", "", ""),
    (" \t a b\x1cc\u00a0 ", "a b c", "a b c", "a b c"),
    ("Été Ñ", "été ñ", "Été Ñ", "été ñ"),
    ("snake_case __x", "snake_case __x", "snake_case __x", "snake_case __x"),
    ("日本語、テスト", "日本語 テスト", "日本語 テスト", "日本語、テスト"),
    ("a\nB\r\nc", "a b c", "a B c", "a b c"),
    ("ÀÉÎ ẞ Ω", "àéî ß ω", "ÀÉÎ ẞ Ω", "àéî ß ω"),
    ("1½ ٣ ४", "1½ ٣ ४", "1½ ٣ ४", "1½ ٣ ४"),
    ("x" * 40_000 + "!", "x" * 40_000, "x" * 40_000, "x" * 40_000 + "!"),
]


@pytest.mark.parametrize("which,lowercase,strip_punct", [(1, True, True), (2, False, True), (3, True, False)])
def test_clean_query(rows, which, lowercase, strip_punct):
    df = rows([(c[0],) for c in CLEANED], "q string")
    got = df.select("q", clean_query(F.col("q"), lowercase, strip_punct).alias("c")).collect()
    assert {r.q: r.c for r in got} == {c[0]: c[which] for c in CLEANED}


def test_cleaning_keeps_null(rows):
    assert rows([(None,)], "q string").select(clean_query(F.col("q"))).first()[0] is None


def test_strip_covers_all_white_space(rows):
    every = "".join(c for c in map(chr, range(0x110000)) if c.isspace())
    assert set(WHITE_SPACE) == set(every)
    assert rows([(every + "a b" + every,)], "t string").select(strip(F.col("t"))).first()[0] == "a b"


def test_normalize_type(rows):
    cases = {
        " INFO\t": "factual", "informational": "factual", "Informative": "factual",
        "nav": "navigational", "navigation": "navigational", "transact": "transactional",
        "purchase": "transactional", "howto": "instrumental", "How-To": "instrumental",
        "procedural": "instrumental", "shopping": "abstain", "": "abstain", None: "abstain",
        **{c.upper(): c for c in CLASSES},
    }
    df = rows([(k,) for k in cases], "t string")
    got = df.select("t", normalize_type(F.col("t"), CLASSES).alias("n")).collect()
    assert {r.t: r.n for r in got} == cases


def test_synonyms_are_mapped_before_the_list_is_asked(rows):
    df = rows([("info",), ("nav",), ("factual",)], "t string")
    got = df.select("t", normalize_type(F.col("t"), ("info", "factual")).alias("n")).collect()
    assert {r.t: r.n for r in got} == {"info": "factual", "nav": "abstain", "factual": "factual"}
