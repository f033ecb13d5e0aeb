"""The operators of the nine problems on small inputs: against brute force, by round trip, or with given
results; and with nulls, empty tables, repeated rows and clashing columns."""

import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioflow.llm import containers, languages, leaks, likeness, pieces, quality, scans, splits, visual
from folioflow.llm.furniture import BODY, FOOTNOTE, FURNITURE, Roles, fold, is_page_number

LINES = "document_id string, stream_index int, page_number int, page_line_index int, text string, collection_handle string"
QUESTIONS = "question_id string, gold_evidence array<struct<group_id:string,locations:array<struct<document_id:string>>>>, extra string, size bigint, bucket int"


def lines_of(spark, docs):
    rows, n = [], 0
    for did, pages in docs.items():
        n = 0
        for p, page in enumerate(pages, 1):
            for i, t in enumerate(page):
                rows.append((did, n, p, i, t, "h"))
                n += 1
    return spark.createDataFrame(rows, LINES)


def questions_of(spark, cites):
    return spark.createDataFrame([(q, None if d is None else [("g1", [(x,) for x in d])], "x", 1, 2) for q, d in cites], QUESTIONS)


# Problem 1


def test_linked_questions_share_a_split_and_the_least_leads(spark):
    cites = [("q1", ["a"]), ("q2", [" A.pdf", "b"]), ("q3", ["B\t"]), ("q4", ["c"]), ("q5", None), ("q6", []), ("q7", [None]), ("q1", ["a"]), (None, ["a"])]
    q = questions_of(spark, cites)
    assert {tuple(r) for r in splits.found(q).collect()} == {("q1", "q2"), ("q1", "q3")}
    got = {r["question_id"]: (r["first_question_id"], r["split"]) for r in splits.assign_splits(q).collect()}
    assert set(got) == {f"q{i}" for i in range(1, 8)} and len({got[x] for x in ("q1", "q2", "q3")}) == 1 and got["q5"][0] == "q5"


def test_no_questions_no_rows(spark):
    q = questions_of(spark, []).limit(0)
    assert splits.found(q).count() == 0 and splits.assign_splits(q).count() == 0


def test_a_hub_document_and_long_chains(spark):
    cites = [(f"q{i:04d}", ["hub"] if i < 300 else [f"d{i}", f"d{i + 1}"]) for i in range(600)]
    groups = {r["first_question_id"] for r in splits.question_groups(questions_of(spark, cites).repartition(7)).collect()}
    assert groups == {"q0000", "q0300"}


def one_by_one(sizes, shares):
    short, out = [sum(sizes) * s for s in shares], []
    for s in sorted(sizes, reverse=True):
        k = max(range(len(short)), key=lambda i: (short[i], -i))
        short[k] -= s
        out.append((s, k))
    return short


@pytest.mark.parametrize("seed", range(5))
def test_dealing_in_bulk_ends_where_dealing_one_by_one_does(seed):
    r = random.Random(seed)
    sizes = [r.choice([1, 1, 1, 2, 3, 7, 40]) for _ in range(500)]
    hist = {s: sizes.count(s) for s in set(sizes)}
    plan = splits.deal(list(hist.items()), splits.SHARES)
    assert all(sum(plan[s]) == n for s, n in hist.items())
    left = [sum(sizes) * w - sum(s * g[k] for s, g in plan.items()) for k, w in enumerate(splits.SHARES.values())]
    assert max(abs(a - b) for a, b in zip(sorted(left), sorted(one_by_one(sizes, splits.SHARES.values())))) <= max(1, min(sizes))


# Problem 2


@pytest.mark.parametrize("text", ["", "short", "word " * 1000, "x" * 5000, ("A sentence of some words here. " * 7 + "\n") * 60, "\n" * 3000, "é" * 2001])
def test_pieces_tile_the_text_within_the_limit(text):
    spans = pieces.cut_points(text)
    assert "".join(text[s:e] for _, s, e in spans) == text
    for k, (o, s, e) in enumerate(spans):
        assert e - o <= pieces.LIMIT and s - o <= pieces.OVERLAP and (k == 0 or o < s)
        if k and not text[s - 1].isspace() and not text[s : s + 1].isspace():
            assert " " not in text[max(0, s - 1700) : s]


def test_pieces_end_at_sentences_where_there_are_any():
    text = ("This is a sentence of nine words in all. " * 4 + "\n") * 30
    assert all(text[:e].rstrip().endswith(".") for _, _, e in pieces.cut_points(text))


def test_long_pages_are_found_and_redeliveries_count_once(spark):
    half = ["w" * 99] * 10
    df = lines_of(spark, {"a": [half * 2 + ["z"]], "b": [half * 2], "c": [["x" * 2001], [None, ""]]})
    df = df.unionByName(df).unionByName(df.limit(1).withColumn("document_id", F.lit(None).cast("string")))
    assert {tuple(r) for r in pieces.found(df).collect()} == {("a", 1), ("c", 1)}
    out = pieces.page_pieces(df).collect()
    assert all(len(r["text"]) <= 2000 for r in out) and {r["document_id"] for r in out} == {"a", "b", "c"}


def test_a_page_of_many_blocks_keeps_its_overlap(spark):
    n = 9000
    df = lines_of(spark, {"big": [[f"line {i} end." for i in range(n)]]})
    out = sorted(pieces.page_pieces(df).collect(), key=lambda r: (r["block"], r["piece"]))
    whole = "\n".join(f"line {i} end." for i in range(n))
    assert len({r["block"] for r in out}) == 3 and all(len(r["text"]) <= 2000 for r in out)
    assert all(r["text"] in whole or r["text"].rstrip() in whole for r in out) and all(r["overlap"] > 150 for r in out[1:])
    assert pieces.found(df).count() == 1


def test_no_lines_no_pieces(spark):
    assert pieces.page_pieces(lines_of(spark, {"a": [["x"]]}).limit(0)).count() == 0


# Problem 3


PROSE = ["Every owner of the estate shall deposit the fund with the board and", "the council may transfer such parcel as the tribunal of the district", "has valued. The officer or its agent may suspend any market of the", "owner until the fee is paid by the holder of the licence."]


def documents_for_quality():
    r = random.Random(3)
    rows = ["\t".join([r.choice(["Estate", "Market", "Parcel"]), *(str(r.randint(10, 9999)) for _ in range(4))]) for _ in range(24)]
    items = [f"({c}) {r.choice(['Estate', 'Market', 'Parcel', 'Fund'])} of the {r.choice(['board', 'council', 'officer'])}" for c in "abcdefghijklmnopqrst"]
    junk = ["".join(r.choice("bcdfghjklmnpqrstvwxz10") for _ in range(r.randint(2, 8))) + " " + "".join(r.choice("bcdfgXZQ") for _ in range(5)) for _ in range(20)]
    blanks = ["Name ____________ " + "_" * 20 for _ in range(12)]
    return {"prose": [PROSE * 8], "table": [rows], "list": [items], "junk": [junk], "form": [blanks]}


def test_classes(spark):
    docs = documents_for_quality() | {f"p{i}": [PROSE * 10] for i in range(4)}
    got = {r["document_id"]: r["text_class"] for r in quality.found(lines_of(spark, docs)).collect()}
    assert got == {"table": "table", "list": "list", "junk": "junk", "form": "junk"}


def test_signals_of_empty_and_blank_documents(spark):
    rows = {r["document_id"]: r for r in quality.assess(lines_of(spark, {"a": [["", None]], "b": [PROSE]})).collect()}
    assert rows["a"]["text_class"] is None and rows["a"]["classification"] == "bad" and rows["a"]["signals"]["mean_word_length"] is None
    words = [w for t in PROSE for w in scans.words_of(t)]
    assert rows["b"]["signals"]["word_count"] == len(words) and rows["b"]["signals"]["mean_word_length"] == round(sum(map(len, words)) / len(words), 3)
    assert quality.assess(lines_of(spark, {"a": [["x"]]}).limit(0)).count() == 0


def test_common_words_do_not_depend_on_the_order_of_rows(spark, monkeypatch):
    docs = {f"d{i:03}": [[f"every owner of estate {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}word", "shall deposit the fund", f"only{i} here", f"only{i} there"]] for i in range(100)}
    docs["d000"][0] += ["strange gloss"] * 40  # one document's own words, in many pieces
    docs |= {f"t{i}": [["நிலம் உரிமை சட்டம்"]] for i in range(2)}
    df = lines_of(spark, docs)
    texts = {d: " ".join(t for page in pages for t in page) for d, pages in docs.items()}
    held = [set(scans.words_of(t)) for t in texts.values()]
    want = {w for w in set().union(*held) if sum(w in h for h in held) >= 2 and len(w) > 1}
    shuffled = df.withColumn("r", F.xxhash64("document_id", "stream_index")).repartition(7, "r").sortWithinPartitions("r").drop("r")
    assert quality.common_words(df.coalesce(1)) == want
    monkeypatch.setattr(quality, "MANY", 5)
    assert quality.common_words(shuffled) == want and "gloss" not in want


def test_a_rare_script_is_judged_by_its_own_documents(spark, monkeypatch):
    monkeypatch.setattr(quality, "COMMON_SHARE", 0.1)
    docs = {f"d{i:03}": [["every owner shall deposit the fund"]] for i in range(100)} | {f"t{i}": [["நிலம் உரிமை சட்டம்"]] for i in range(3)} | {f"o{i}": [["seldom"]] for i in range(3)}
    assert quality.common_words(lines_of(spark, docs)) == set("every owner shall deposit the fund நிலம் உரிமை சட்டம்".split())


# Problem 4


def decoder():
    words = "the of owner shall deposit council fund every and any such estate register harbour manifest market certificate insured co".split()
    counts = {w: 4000 if len(w) < 4 else 900 for w in words}
    counts["co"] = 5
    return scans.Decoder(counts, 60_000)


@pytest.mark.parametrize(("read", "true"), [("tbe", "the"), ("0wner", "owner"), ("5hall", "shall"), ("rnarket", "market"), ("councll", "council"), ("regisfer", "register"), ("clepo5it", "deposit"), ("fiind", "fund")])
def test_misread_words_are_decoded(read, true):
    dec = decoder()
    words, bad, _ = dec.decode((read,), ())
    assert words == [true] and bad == [True] and not dec.is_fine(read)


@pytest.mark.parametrize("word", ["the", "estate", "zanzibar", "42", "a"])
def test_sound_and_unknown_words_stay(word):
    dec = decoder()
    assert dec.is_fine(word) or dec.decode((word,), ())[0] == [word]


def test_splits_and_merges():
    dec = decoder()
    assert dec.decode(("cert", "ificate"), (" ",))[0] == ["certificate"]
    assert dec.decode(("ofthe",), ())[0] == ["of", "the"]
    assert dec.decode(("har", "bour"), ("-",))[0] == ["harbour"]


def test_one_lattice_of_breaks_and_confusions():
    dec = decoder()
    assert dec.decode(("cer", "fificate"), ("-",)) == (["certificate"], [False, True], [True])
    assert dec.decode(("rn", "arket"), (" ",))[0] == ["market"]
    assert dec.decode(("certificateof0wner",), ()) == (["certificate", "of", "owner"], [True], [])
    long = "x" * 40
    assert dec.decode(("tbe", long, "fund"), (" ", " "))[0] == ["the", long, "fund"]
    p = page(["every owner shall regis-", "fer the fund", "of the cer-", "tificateandany estate"])
    assert p.hyphen[:3:2] == [True, True] and p.misread == [False, True, False, False]


def page(texts, pages=None, did="x__1"):
    return scans.Page(did, pages or [1] * len(texts), list(range(len(texts))), texts, [False] * len(texts), Roles(), decoder())


def test_broken_words_and_compounds():
    p = page(["every owner shall depo-", "sit the fund and co-", "insured estate of the coun¬", "cil shall register", "any mar-"])
    assert p.hyphen == [True, False, True, False, True]


def test_heavily_misread_lines_are_decoded_and_junk_is_not():
    p = page(["rnarket regisfer and clepo5it of every cerfificate fund", "tekram retsiger tbe tisoped dnuf reppu", "xqzt rnarket wvkp jjgh tbe", "every 0wner shall register"])
    assert p.misread == [True, False, False, True]


def test_furniture_and_its_neighbours():
    body = ["every owner shall deposit the fund", "of the council and any estate", "such register of the market"]
    texts, pages = [], []
    for n in range(1, 5):
        head = ["THE HARBOUR MANIFEST ACT, 1950"] if n > 1 else ["The Harbour Manifest Act, 1950"]
        one = head + [f"{x} {'abcd'[n - 1]}" for x in body] + (["har-"] if n == 2 else []) + [f"- {n} -"]
        texts += one
        pages += [n] * len(one)
    p = page(texts, pages, "the-harbour-manifest-act-1950__1")
    got = [texts[i] for i, r in enumerate(p.role) if r == FURNITURE]
    assert sorted(got) == sorted(["THE HARBOUR MANIFEST ACT, 1950"] * 3 + [f"- {n} -" for n in range(1, 5)])


def test_notes_at_the_foot():
    texts = ["every owner shall deposit the fund", "1. Subs. by Act 4 of 1950, s. 2, for the fund", "2. See now the estate", "3"]
    assert Roles().of("d__1", [1] * 4, texts) == [BODY, FOOTNOTE, FOOTNOTE, FURNITURE]


@pytest.mark.parametrize(("text", "is_number"), [("12", True), ("- 4 -", True), ("Page 2 of ll", True), ("[l7O]", True), ("xxxvii", True), ("( 3O )", True), ("137.", True), ("owner", False), ("mi", True), ("did", False), ("", False), ("12 apples", False)])
def test_page_numbers(text, is_number):
    assert is_page_number(text) is is_number


def test_folding_is_blind_to_misreading():
    assert fold("GOVERNMENT SERIES   3") == fold("G0VERNMENT SER|ES 14") and fold("Printed at the Press") == fold("Prmted at the Prcss")


def test_paragraphs_are_whole_and_repaired():
    p = page(["1. every owner shall depo-", "sit tbe fund of the council.", "2. any estate of the", "market shall register.", "7"])
    assert [x[3] for x in p.paragraphs(decoder())] == ["1. every owner shall deposit the fund of the council.", "2. any estate of the market shall register."]


ORDERS = [("estate", "fund", "certificate"), ("council", "market", "register"), ("fund", "estate", "manifest"), ("market", "certificate", "council"), ("register", "council", "estate"), ("manifest", "register", "fund")]


def test_noise_over_tables(spark):
    docs = {f"d{i}__1": [[f"every owner of the {x} shall deposit the {y}", f"with the {y} and any market of the {x} har-", f"bour shall register the {z}", f"{z} of every harbour with the {x}"] for x, y, z in ORDERS] for i in range(12)}
    docs["m__1"] = [["the owner shall depo5it the fund", "12"], []]
    docs["n__1"] = [[None, ""]]
    df = lines_of(spark, docs)
    got = {tuple(r) for r in scans.noisy_lines(df.unionByName(df)).collect()}
    assert {("m__1", 0, "misread"), ("m__1", 1, "furniture"), ("d0__1", 1, "hyphen")} <= got and not any(k == "misread" and d != "m__1" for d, _, k in got)
    assert scans.noisy_lines(df.limit(0)).count() == 0
    assert scans.paragraphs(df).where("document_id = 'd1__1'").count() > 0


def test_a_paragraph_of_any_length_is_one():
    texts = ["Every owner shall deposit the fund of the estate"] + ["and any market of the council or such register"] * 200 + ["1. Any estate."]
    assert scans.paragraph_spans(texts, [False] * len(texts)) == [(0, 201), (201, 202)]


def test_a_word_broken_over_a_chunk_end(spark):
    fill = [[f"every owner of the {x} shall deposit the {y}", f"with the {y} and any market of the {z}"] for x, y, z in ORDERS]
    pages = [fill[i % 6] for i in range(62)] + [["the owner shall register the certi-"], ["f1cate of every estate"], fill[0]]
    docs = {f"d{i}__1": [["the certificate of the council and any certificate of the fund"] * 3] for i in range(12)} | {"long__1": pages}
    df = lines_of(spark, docs)
    at = 124
    got = {(r["stream_index"], r["noise"]) for r in scans.noisy_lines(df).where("document_id = 'long__1'").collect()}
    assert {(at, "hyphen"), (at + 1, "misread")} <= got
    rows = scans.paragraphs(df).where("document_id = 'long__1'").collect()
    whole = " ".join(r["text"] for r in sorted(rows, key=lambda r: r["first_index"]))
    assert "register the certificate of every estate" in whole and "f1cate" not in whole and sum(r["last_index"] - r["first_index"] + 1 for r in rows) <= at + 4


# Problem 5


def shingles(texts):
    w = scans.words_of("\n".join(texts))
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def test_groups_against_brute_force(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    docs = {}
    for i in range(60):
        docs[f"b{i:02d}"] = [[" ".join(r.choices(words, k=9)) for _ in range(30)]]
    for i in range(40):
        base = [x for x in docs[f"b{r.randrange(8):02d}"][0]]
        for _ in range(r.randrange(0, 16)):
            base[r.randrange(30)] = " ".join(r.choices(words, k=9))
        docs[f"c{i:02d}"] = [base]
    for i in range(10):
        docs[f"e{i}"] = [docs["b03"][0]]
    docs |= {"tiny": [["one two"]], "none": [["", None]]}
    sets = {d: shingles([x or "" for p in pages for x in p]) for d, pages in docs.items()}
    parent = {d: d for d in docs}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in docs:
        for b in docs:
            if a < b and sets[a] and sets[b] and 2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    want = {(a, b) for a in docs for b in docs if a < b and top(a) == top(b)}
    df = lines_of(spark, docs)
    assert {tuple(x) for x in likeness.found(df.unionByName(df.limit(50))).collect()} == want


@pytest.mark.parametrize("depth", [0, 1])
def test_a_hot_bucket_is_split(spark, monkeypatch, depth):
    monkeypatch.setattr(likeness, "BLOCK", 8)
    monkeypatch.setattr(likeness, "DEPTH", depth)
    monkeypatch.setattr(likeness, "SURE", 4)
    r = random.Random(1)
    base = [" ".join(f"w{r.randrange(300)}" for _ in range(9)) for _ in range(40)]
    docs = {}
    for i in range(60):
        own = list(base)
        own[i % 40] = f"own {i} words here now"
        docs[f"d{i:02d}"] = [own]
    assert likeness.like_groups(lines_of(spark, docs)).select("group_id").distinct().count() == 1
    assert likeness.like_groups(lines_of(spark, docs)).count() == 60


def test_titles_of_groups(spark):
    r = random.Random(4)
    base = [" ".join(f"w{r.randrange(300)}" for _ in range(9)) for _ in range(20)]
    df = lines_of(spark, {"a": [base], "b": [base[:19]], "c": [base[1:]], "z": [["one two three four"]]})
    corpus = spark.createDataFrame([("a", "The Harbour Act"), ("b", "Harbor Act"), ("c", None), ("a", None)], "document_id string, title string").withColumn("group_id", F.lit(1))
    assert {tuple(x) for x in likeness.titled_groups(df, corpus).collect()} == {("a", "a", "The Harbour Act", 1.0), ("b", "a", "Harbor Act", 1.0), ("c", "a", None, 0.0)}


def test_long_documents_are_verified_by_shingle(spark):
    r = random.Random(2)
    pages = [[" ".join(f"w{r.randrange(500)}" for _ in range(8))] for _ in range(150)]
    other = [p if i % 10 else [" ".join(f"w{r.randrange(500)}" for _ in range(8))] for i, p in enumerate(pages)]
    df = lines_of(spark, {"a": pages, "b": other, "c": pages[:20]})
    assert {tuple(x) for x in likeness.found(df).collect()} == {("a", "b")}
    assert likeness.found(df.limit(0)).count() == 0


def test_planes_count_bits():
    r = np.random.default_rng(0)
    x = r.integers(0, 256, (517, 24), dtype=np.uint8)
    x[:200] &= r.integers(0, 256, (200, 24), dtype=np.uint8)
    x[:80] &= r.integers(0, 256, (80, 24), dtype=np.uint8)
    n = np.unpackbits(x, axis=1).sum(axis=1)
    for radius in (0, 7, 20, 47, 48, 75, 96, 190):
        assert (likeness.planes_within(x, radius) == (n <= radius)).all()


# Problem 6


EN = "the owner of the estate shall deposit every fund with the council before the market is closed and the harbour is measured".split()
FR = "le registre de la mairie doit être déposé avant la clôture du marché et la propriété reste payée sous le greffier".split()
HI = "नगर के निरीक्षक द्वारा अधिनियम का शुल्क निरस्त करेगा और परिषद को आदेश के अधीन भेजेगा जब वन में भवन देगा".split()
MR = "नगरपालिकेने शुल्कासाठी आदेश रद्द करील तसेच परिषदेला इमारतीचा अर्ज पाठवील आणि जिल्ह्यात बंदर होईल जुना रस्ता ठेवील".split()
BN = "পৌরসভা এর নিয়ম জন্য আদেশ দেবে এবং বন্দর অধীনে কমিটি থেকে আবেদন পেশ করবে যখন সড়ক উপর জমি হবে".split()
TA = "நகராட்சி உடன் விதி பற்றி ஆணை கருதப்படும் மேலும் சந்தை முன் குழு வரை அனுப்பும் போது துறைமுகம் பின் இருக்கும்".split()
POOLS = {"en": EN, "fr": FR, "hi": HI, "mr": MR, "bn": BN, "ta": TA}


@pytest.fixture(scope="module")
def crf():
    r = random.Random(0)
    rows = [(" ".join(r.choices(w, k=60)), k) for k, w in POOLS.items() for _ in range(25)]
    rows += [(" ".join(r.choices(EN, k=60)), k) for k in ("hi", "fr", "ta")]
    return languages.Crf().fit(rows)


def test_chains_that_switch_language(crf):
    r = random.Random(9)
    for a in POOLS:
        for b in POOLS:
            if a != b:
                p = crf.word_marginals([r.choices(POOLS[a], k=40) + r.choices(POOLS[b], k=40)])
                got = [languages.LANGUAGES[k] for k in p.argmax(axis=1)]
                assert sum(x == y for x, y in zip(got, [a] * 40 + [b] * 40)) >= 74
                assert np.allclose(p.sum(axis=1), 1)


def test_forward_backward_against_enumeration():
    from itertools import product

    r = np.random.default_rng(1)
    emit, trans = r.normal(size=(1, 4, 3)), r.normal(size=(3, 3))
    want = np.zeros((4, 3))
    total = 0.0
    for path in product(range(3), repeat=4):
        w = np.exp(sum(emit[0, i, k] for i, k in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
        total += w
        for i, k in enumerate(path):
            want[i, k] += w
    got = languages.marginals(np.repeat(emit, 2, 0), trans, np.ones((2, 4), bool))
    assert np.allclose(got[0], want / total) and np.allclose(got[1], want / total)


def test_labels_that_fail_to_name(spark, crf):
    r = random.Random(4)
    say = lambda k, n: [" ".join(r.choices(POOLS[k], k=9)) for _ in range(n)]
    docs = {"a": [say("en", 8) + say("hi", 6)], "b": [say("fr", 9)], "c": [say("ta", 4) + say("bn", 7)], "d": [say("mr", 8)], "e": [["qx zt"] * 9]}
    df = lines_of(spark, docs | {f"z{i}{n}": [say(k, 40)] for i, k in enumerate(POOLS) for n in (1, 2)})
    corpus = spark.createDataFrame([("a", "en+hi"), ("b", "English"), ("c", "bn-IN"), ("d", None), ("e", None), *((f"z{i}{n}", k) for i, k in enumerate(POOLS) for n in (1, 2))], "document_id string, language string").withColumn("downloaded_at", F.lit("2024-01-01").cast("timestamp"))
    listed = spark.createDataFrame([("a", "en", "2024-01-01"), ("a", "hi; en", "2024-02-01"), ("b", "fr", "2024-01-01"), ("c", "বাংলা", None), ("d", "Marathi", "2024-01-01")], "document_id string, language string, at string").select("document_id", "language", F.col("at").cast("timestamp").alias("discovered_at"))
    got = {tuple(x) for x in languages.unnamed(df, corpus, listed, crf).collect()}
    assert got == {("b", "fr"), ("d", "mr")}


def test_segments(spark, crf):
    r = random.Random(5)
    say = lambda k, n: [" ".join(r.choices(POOLS[k], k=9)) for _ in range(n)]
    docs = {"a": [say("en", 8) + say("hi", 6), say("hi", 2) + ["12"] + say("en", 4)], "b": [say("fr", 9)]}
    got = [tuple(x)[:5] for x in languages.segments(lines_of(spark, docs | {f"z{i}{n}": [say(k, 40)] for i, k in enumerate(POOLS) for n in (1, 2)}), crf).where("document_id < 'z'").orderBy("document_id", "first_index").select("document_id", "first_index", "last_index", "language", "lines").collect()]
    assert got == [("a", 0, 7, "en", 8), ("a", 8, 15, "hi", 8), ("a", 17, 20, "en", 4), ("b", 0, 8, "fr", 9)]
    assert languages.segments(lines_of(spark, docs).limit(0), crf).count() == 0


def test_a_rare_language_among_many_documents(spark, crf, monkeypatch):
    monkeypatch.setattr(quality, "COMMON_SHARE", 0.2)  # as two documents are in a thousand
    r = random.Random(6)
    rare = [a + b for a in ("zor", "mek", "plia", "hund", "vost", "quel") for b in ("tan", "ire", "oble", "usk", "emma", "ahn")]
    docs = {f"e{i}": [[" ".join(r.choices(EN, k=9)) for _ in range(12)]] for i in range(20)} | {"t": [[" ".join(r.choices(TA, k=9)) for _ in range(12)]], "r": [[" ".join(r.choices(rare, k=9)) for _ in range(30)]]}
    docs["j"] = [["".join(r.choice("bcdfghjklmnp") for _ in range(r.randint(4, 8))) + " " + "".join(r.choice("bcdfgx") for _ in range(5)) for _ in range(30)]]
    df = lines_of(spark, docs)
    assert {"t"} == {x[0] for x in languages.document_languages(df, crf).where("language = 'ta'").select("document_id").collect()}
    assert {tuple(x) for x in quality.found(df).collect()} == {("j", "junk")}


def test_long_chains_run_whole(crf, monkeypatch):
    r = random.Random(7)
    chains = [r.choices(EN + HI, k=n) for n in (1, 5, 700, 3, 2000)]
    whole = crf.word_marginals(chains)
    monkeypatch.setattr(languages, "SIDE_BY_SIDE", 1)
    assert np.allclose(whole, np.concatenate([crf.word_marginals([c]) for c in chains]))


def test_label_forms(spark):
    df = spark.createDataFrame([("EN",), ("en-IN",), ("hi/mr",), ("हिन्दी",), ("und",), ("",), (None,), ("ta; French",), ("english ",)], "l string")
    assert [r[0] for r in df.select(languages.label_languages(F.col("l"))).collect()] == [["en"], ["en"], ["hi", "mr"], ["hi"], [], [], [], ["ta", "fr"], ["en"]]


# Problem 7


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_and_its_bound(seed):
    r = np.random.default_rng(seed)
    sizes = r.integers(1, 2049, 400)
    c = containers.best_fit_decreasing(sizes)
    fill = np.bincount(c, weights=sizes)
    assert fill.max() <= 2048 and len(fill) >= containers.lower_bound(sizes) >= -(-sizes.sum() // 2048) and len(fill) <= 1.1 * containers.lower_bound(sizes) + 1


def test_the_bound_sees_items_that_cannot_share():
    assert containers.lower_bound(np.full(10, 1100)) == 10 and containers.lower_bound(np.full(9, 700)) == 5 and containers.lower_bound(np.zeros(0, int)) == 0


def test_every_text_is_placed_once(spark, monkeypatch):
    monkeypatch.setattr(containers, "ITEMS", 60)
    r = random.Random(1)
    sizes = [r.choice([0, 5, 300, 900, 1500, 2048, 2049, 7000, 4096]) + r.randrange(3) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id bigint, tokens bigint")
    rows = containers.pack(df).collect()
    total = {}
    fill = {}
    for x in rows:
        total[x["doc_id"]] = total.get(x["doc_id"], 0) + x["tokens"]
        if x["container"] is not None:
            fill[x["container"]] = fill.get(x["container"], 0) + x["tokens"]
    assert total == dict(enumerate(sizes)) and max(fill.values()) <= 2048
    whole = {x["doc_id"] for x in rows if x["tokens"] < sizes[x["doc_id"]]}
    assert all(sizes[d] > 2048 for d in whole) and len(fill) <= 1.05 * sum(sizes) / 2048 + 2
    assert containers.pack(df.limit(0)).count() == 0


def test_certificates(spark, monkeypatch):
    monkeypatch.setattr(containers, "ITEMS", 60)
    r = random.Random(4)
    sizes = [r.choice([0, 900, 1100, 1500, 2048, 5000, 300]) for _ in range(300)]
    rows = {(x["round"], x["partition"]): x for x in containers.certificates(spark.createDataFrame(list(enumerate(sizes)), "doc_id bigint, tokens bigint")).collect()}
    whole = rows["all", ""]
    assert whole["tokens"] == sum(sizes) and whole["texts"] == sum(s > 0 for s in sizes) and whole["containers"] == sum(x["containers"] for k, x in rows.items() if k[0] != "all")
    assert whole["containers"] >= whole["bound"] >= -(-sum(sizes) // 2048) and len(rows) > 3
    assert containers.certificates(spark.createDataFrame([], "doc_id bigint, tokens bigint")).count() == 0


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "The owner shall deposit."), (2, ""), (3, None), (4, "नगर " * 50)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["tokens"] for r in containers.token_counts(df).collect()}
    assert got[2] == got[3] == 0 and 4 <= got[1] <= 8 and got[4] > 50


# Problem 8


def test_leaks_whole_altered_and_missed(spark):
    r = random.Random(8)
    words = [a + b for a in ("bar", "cor", "dal", "fen", "gil", "hom", "jur", "kel") for b in ("ta", "mo", "lix", "ren", "sup", "vo", "dek")]
    items = {i: r.sample(words, 45) for i in range(6)}
    fill = lambda n: r.choices(words, k=n)
    lost = items[1][:35]
    for k in (3, 11, 19, 26):
        lost[k] = "zzz"
    few = [w if i % 3 else "yyy" for i, w in enumerate(items[2])]
    broken = " ".join(items[3]).replace(" ", "\n", 9)
    broken = broken[:47] + "-\n" + broken[47:]
    docs = {
        1: " ".join(fill(50) + items[0] + fill(50)), 2: " ".join(fill(40) + lost + fill(40)).upper(), 3: " ".join(fill(30) + few + fill(30)), 4: broken,
        5: " ".join(sorted(items[4])), 6: "​".join("".join(chr(ord(c) + 0xFEE0) for c in w) + " " for w in items[5]), 7: None, 8: "", 9: " ".join(items[0][:24] + ["zzz"] * 40),
        10: " , ".join(items[0][5:37]) + " " + " ".join(items[4]),
    }
    d = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").withColumn("item_id", F.lit(0))
    i = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()] + [(99, None)], "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    got = {tuple(x) for x in leaks.leaks(d.unionByName(d), i).collect()}
    assert got == {(1, 0), (2, 1), (4, 3), (6, 5), (10, 0), (10, 4)}
    assert leaks.leaks(d.limit(0), i).count() == 0 and leaks.leaks(d, i.limit(0)).count() == 0


def test_hashes_of_stretches():
    r = random.Random(1)
    text = "".join(r.choices("abcdeé字", k=400))
    total = leaks.sums(np.array([ord(c) for c in text], np.uint32))
    for n in (1, 5, 17):
        assert hashlist(leaks.hashes(total, n)) == [leaks.hash_of(text[i : i + n]) for i in range(len(text) - n + 1)]
    known = np.array([leaks.hash_of(text[i : i + 5]) for i in range(0, 390, 7)], np.int64).view(np.uint64)
    h = leaks.hashes(total, 5)
    assert set(np.flatnonzero(np.isin(h, known))) <= set(leaks.Bitmap(known).hits(h).tolist())


def hashlist(h):
    return h.view(np.int64).tolist()


def test_stray_words_and_short_items(spark, monkeypatch):
    r = random.Random(3)
    words = [a + b + c for a in "bcdfg" for b in ("ar", "en", "ol", "um") for c in ("ta", "mo", "lix", "ren")]
    item = r.sample(words, 40)
    many = list(item[5:35])
    for k in sorted(r.sample(range(1, 29), leaks.STRAY), reverse=True):
        many.insert(k, "qqq")
    for k in (0, 12, 33):
        many[k] = "zz"
    docs = [(1, " ".join(r.choices(words, k=60) + many + r.choices(words, k=60))), (2, "well then harbourmaster it is"), (3, "the harbour master"), (4, "one two " * 50), (5, "x" * 5000)]
    items = [(1, " ".join(item)), (2, "Harbourmaster!"), (3, "alpha beta gamma"), (4, ""), (5, "two one")]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = {(1, 1), (2, 2), (3, 2), (4, 5)}
    assert {tuple(x) for x in leaks.leaks(d, i).collect()} == want
    monkeypatch.setattr(leaks, "MOST_PLACES", 10)
    assert {tuple(x) for x in leaks.leaks(d, i).collect()} == want


# Problem 9


def reference_form(t):
    return unicodedata.normalize("NFC", "".join(visual._form_of(c) for c in t))


def test_forms_against_character_by_character():
    r = random.Random(6)
    alphabet = "abcXYZ 019.,\n\té́̂̈ﬁﬃＡｂ０　   ​‌﻿­аеосрхАВЕΑΒ각ᄀ각کक़क़ड़ড়ோோ😀"
    texts = ["".join(r.choices(alphabet, k=r.randrange(0, 60))) for _ in range(600)]
    got = visual.visual_form(pa.array([*texts, None, ""])).to_pylist()
    assert got[-2:] == [None, ""]
    for t, g in zip(texts, got):
        assert unicodedata.normalize("NFD", g) == unicodedata.normalize("NFD", reference_form(t))
    assert visual.visual_form(pa.array(got[:-2])).to_pylist() == got[:-2]


def test_a_slice_of_an_array():
    a = pa.array(["zz", "ﬁn", None, "é"])[1:]
    assert visual.visual_form(a).to_pylist() == ["fin", None, "é"] and visual.visual_form(pa.array([], pa.string())).to_pylist() == []


def test_pairs_that_look_alike(spark):
    rows = [(1, "Act 5"), (2, "Асt 5"), (3, "Act ５"), (4, "act 5"), (5, "Act 5"), (6, "Áct 5"), (7, "Á​ct 5"), (8, None), (9, ""), (10, "​"), (11, "Act\n5"), (12, "Act 6")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("form", F.lit("x")).withColumn("stored", F.lit(1))
    got = {tuple(x) for x in visual.look_alike_pairs(df).collect()}
    assert got == {(1, 2), (1, 3), (2, 3), (2, 5), (3, 5), (6, 7), (9, 10)}
    assert visual.look_alike_pairs(df.limit(0)).count() == 0
