"""Text functions against plain Python, and at their edges."""

import re

import pytest
from pyspark.sql import functions as F

from folioflow.functions import text as T
from folioflow.functions import unicode as U
from folioflow.functions.wordlists import COMMON_WORDS, STOPWORDS

TEXTS = ["", "The Act shall apply to any person.", "12. Short title.—(1) This Act may be called X", "O1d sCan n0ise ~~ rHYthm brrr tsk", "line one\nline two\n", "Élan Göldar ﬁne", "a b c d e f", "x" * 50]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(99, None)], "id int, text string").cache()


def column(df, c):
    return {r[0]: r[1] for r in df.select("id", c.alias("x")).collect()}


def test_tokens_and_content_words(df):
    got, words = column(df, T.tokens(F.col("text"))), column(df, T.content_words(F.col("text")))
    for i, t in enumerate(TEXTS):
        assert got[i] == [w.lower() for w in re.findall("[A-Za-z0-9]+", t)]
        assert words[i] == [w for w in got[i] if len(w) > 1 and w not in STOPWORDS]
    assert got[99] == words[99] == []


def test_signals(df):
    rows = {r["id"]: r for r in df.select("id", *[c.alias(n) for n, c in T.text_signals(F.coalesce("text", F.lit(""))).items()]).collect()}
    for i, t in enumerate(TEXTS):
        words = re.findall("[A-Za-z]+", t)
        assert rows[i]["word_count"] == len(words)
        assert rows[i]["mean_word_length"] == pytest.approx(round(sum(map(len, words)) / len(words), 3) if words else 0)
        assert rows[i]["common_word_rate"] == pytest.approx(sum(w.lower() in COMMON_WORDS for w in words) / len(words) if words else 0, abs=1e-4)
        odd = sum(len(w) >= 4 and not (w.isupper() or w.islower() or w.istitle()) for w in words)
        assert rows[i]["mixed_case_rate"] == pytest.approx(odd / len(words) if words else 0, abs=1e-4)
    assert rows[99]["characters"] == 0


@pytest.mark.parametrize(("line", "yes"), [("12", True), ("Page 3 of 40", True), ("xiv", True), ("page 7.", True), ("12345", False), ("Section 4", False), ("", False), ("  9 - ", True)])
def test_page_number_lines(spark, line, yes):
    assert spark.createDataFrame([(line,)], "t string").select(T.is_page_number(F.col("t"))).first()[0] is yes


def test_clean_words_scripts_and_rates(spark):
    r = spark.createDataFrame([("SUO motu White-browed sCan x Ünder देव तमिழ்",)], "t string").select(T.clean_words(F.col("t")), T.script_counts(F.col("t"))["devanagari"], T.script_counts(F.col("t"))["tamil"], T.glued_token_rate(F.lit("extraordinarily long abc"))).first()
    assert r[0] == ["suo", "motu", "white", "browed", "nder"] and r[1] == 4 and r[2] == 1 and r[3] == pytest.approx(0.3333)


def test_containment_and_leakage(spark):
    r = spark.range(1).select(T.containment(F.array(F.lit("a"), F.lit("b"), F.lit("a")), F.array(F.lit("a"))), T.containment(F.array().cast("array<string>"), F.array(F.lit("a"))), T.leakage(F.lit("what fee applies"), F.lit("A fee of ten rupees"))).first()
    assert r[0] == 0.5 and r[1] == 0.0 and r[2] == pytest.approx(1 / 3)


@pytest.mark.parametrize(("value", "year"), [("2 May 1904", 1904), ("0099 1399 1450", None), ("act 42", None), (None, None), ("20191 x", 2019)])
def test_years(spark, value, year):
    assert spark.createDataFrame([(value,)], "v string").select(T.year_of(F.col("v"))).first()[0] == year


def test_bands(spark):
    rows = spark.createDataFrame([(1899, 102399), (1900, 102400), (2011, 8 * 1024**2), (None, None)], "y int, b bigint").select(T.era_band(F.col("y")), T.size_band(F.col("b"))).collect()
    assert [tuple(r) for r in rows] == [("pre_1900", "tiny"), ("1900_1949", "small"), ("2011_plus", "huge"), ("year_unknown", None)]


@pytest.mark.parametrize(("name", "want"), [("a/b:c.pdf", "a_b_c.pdf"), ("con", "_con"), ("COM1.txt", "_COM1.txt"), (" . ", "document"), (None, "document"), ("fine..", "fine")])
def test_file_names(spark, name, want):
    assert spark.createDataFrame([(name,)], "n string").select(T.safe_filename(F.col("n"))).first()[0] == want


def test_urls_and_hosts(spark):
    df = spark.createDataFrame([("https://laws.example/handle/77881/20",), ("http://x.laws.example/bitstream/a/b.pdf?x=1",), ("https://evil-laws.example/x",)], "u string")
    rows = df.select(*[c.alias(n) for n, c in T.url_parts(F.col("u")).items()], T.host_allowed(F.col("u"), ["laws.example"]).alias("ok")).collect()
    assert [(r["kind"], r["handle"], r["ok"]) for r in rows] == [("handle", "77881/20", True), ("bitstream", "", True), ("other", "", False)] and rows[1]["file_name"] == "b.pdf"


def test_places_quotes_and_quantities(spark):
    places = {"north": ("north land", "n l"), "south": ("south",)}
    r = spark.range(1).select(T.places_in(F.lit("The North Land and South Act"), places), T.quotes(F.lit('said "a long quotation" and “another long one” or "short"')), F.size(T.quantities(F.lit("12% of five years, section 5, ten thousand rupees")))).first()
    assert r[0] == ["north", "south"] and r[1] == ["a long quotation", "another long one"] and r[2] == 3


def test_humanised_and_guarded(spark):
    r = spark.range(1).select(T.human_bytes(F.lit(1536)), T.human_bytes(F.lit(12)), T.human_seconds(F.lit(3725)), T.guarded_cell(F.lit("=1+1")), T.guarded_cell(F.lit("ok"))).first()
    assert tuple(r) == ("1.5 KB", "12 B", "1h 02m", "'=1+1", "ok")


def test_unicode_functions(spark):
    df = spark.createDataFrame([("ﬁne  Print", "the FINE\nprint runs"), (None, "x"), ("ct", "act")], "a string, b string")
    assert [tuple(r) for r in df.select(U.normalise("a"), U.appears_in("a", "b")).collect()] == [("fine print", True), ("", False), ("ct", False)]
    t = spark.createDataFrame([("Protection of Humen Rights", "The Protection of Human Rights Act"), (None, None), ("Rent", "Rent")], "a string, b string")
    assert [r[0] for r in t.select(U.title_similarity("a", "b")).collect()] == pytest.approx([0.75, 0.0, 1.0])
    assert spark.range(1).select(U.slug(F.lit("The Élan & Göldar Act, 1950"))).first()[0] == "the-elan-goldar-act-1950"
    assert spark.range(1).select(U.repaired_location(F.lit("/v?filename=a&b.pdf&x=1"))).first()[0] == "/v?filename=a%26b.pdf&x=1"
    b = spark.createDataFrame([(b"caf\xe9", None), ("é".encode(), "utf-8"), (b"x", "no-such")], "b binary, c string")
    assert [r[0] for r in b.select(U.decoded("b", "c")).collect()] == ["café", "é", "x"]
