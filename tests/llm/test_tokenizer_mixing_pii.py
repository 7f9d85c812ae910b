import base64
import random

import numpy as np
import pandas as pd
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fluvion.llm import pii
from fluvion.llm.mixing import mix, rake, topics
from fluvion.llm.tokenizer import PATTERN, Automaton, count_tokens, decode_corpus, encode_corpus, load_ranks

public = pytest.importorskip("public_tokenizers")
RANKS = load_ranks()
AUTOMATON = Automaton(RANKS)
TIK = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80))
def test_ids_equal_those_of_the_public_library(text):
    assert AUTOMATON.encode(text) == TIK.encode_ordinary(text)
    assert AUTOMATON.decode(AUTOMATON.encode(text)) == text


def test_long_words_and_dense_merges():
    rng = random.Random(2)
    for alphabet in ("ab", "etaoins ", "0123456789", " \n\t", "éüñß", "的是不了人"):
        for _ in range(60):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 400)))
            assert AUTOMATON.encode(t) == TIK.encode_ordinary(t)


def test_another_vocabulary():
    ranks = load_ranks("byte_bpe_multi_50k")
    a = Automaton(ranks)
    b = tiktoken.Encoding("m", pat_str=public.PATTERN, mergeable_ranks={base64.b64decode(x): int(i) for x, i in map(bytes.split, ranks.splitlines())}, special_tokens={})
    for t in ("Die Tagesreihe von Kelvar endet am 11.9.1995.", "流域面积 174.8 km2，站号 99462760。", "L'eau était très chargée après la crue", "<|endoftext|>"):
        assert a.encode(t) == b.encode_ordinary(t)


def test_corpus_with_null_empty_and_long_texts(spark):
    long = "word " * 40_000
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "  \n", 9), (4, "<|endoftext|> x", 9), (5, long, 9)], "doc_id int, text string, ids int")
    got = {r["doc_id"]: r["ids"] for r in encode_corpus(df).collect()}
    assert got == {1: [], 2: [], 3: TIK.encode_ordinary("  \n"), 4: TIK.encode_ordinary("<|endoftext|> x"), 5: TIK.encode_ordinary(long)}
    assert {r["doc_id"]: r["n_tokens"] for r in count_tokens(df).collect()} == {k: len(v) for k, v in got.items()}
    back = {r["doc_id"]: r["text"] for r in decode_corpus(encode_corpus(df)).collect()}
    assert back == {1: "", 2: "", 3: "  \n", 4: "<|endoftext|> x", 5: long}
    assert encode_corpus(df.limit(0)).count() == 0


def docs(spark, n, sources, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, str(rng.choice(sources)), str(rng.choice(["en", "de", None])), str(rng.choice(["a", "b", "c"])), int(rng.integers(1, 400))) for i in range(n)]
    return spark.createDataFrame([(i, s, None if l == "None" else l, t, k) for i, s, l, t, k in rows], "doc_id int, source string, lang string, topic string, n int")


def run_mix(spark, d, targets):
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    a, b = mix(d, t, "doc_id", F.lower(F.trim("source")), "n", F.col("lang"), F.col("topic"))
    return a.toPandas(), {r["value"]: r for r in b.filter("margin = 'source'").collect()}


def test_mix_meets_shares_and_caps(spark):
    d = docs(spark, 4000, ["big", "big", "big", "mid", "tiny ", "other"])
    m, r = run_mix(spark, d, [(" BIG", 0.5, 1), ("mid", 0.3, 3), ("tiny", 0.2, 4), ("absent", 0.0, 2)])
    total = d.filter("trim(source) <> 'other'").agg(F.sum("n")).first()[0]
    for s, share in (("big", 0.5), ("mid", 0.3), ("tiny", 0.2)):
        assert abs(r[s]["tokens_mixed"] - share * total) < 400 and r[s]["filled"]
    assert r["absent"]["tokens_mixed"] == 0
    assert (m.groupby("source").copies.max() <= pd.Series({"big": 1, "mid": 3, "tiny": 4})).all() and m.doc_id.is_unique and "other" not in set(m.source)


def test_a_source_that_cannot_fill_gives_all_it_may(spark):
    d = docs(spark, 1000, ["big"] * 9 + ["tiny"])
    m, r = run_mix(spark, d, [("big", 0.3, 1), ("tiny", 0.7, 2)])
    assert not r["tiny"]["filled"] and set(m[m.source == "tiny"].copies) == {2} and r["tiny"]["tokens_mixed"] == 2 * r["tiny"]["tokens_available"]
    assert r["big"]["filled"]


def test_mix_of_nothing(spark):
    d = docs(spark, 10, ["big"])
    m, r = run_mix(spark, d.limit(0), [("big", 1.0, 1)])
    assert len(m) == 0 and r["big"]["actual_share"] == 0.0
    m, r = run_mix(spark, d.withColumn("n", F.lit(None).cast("int")), [("big", 1.0, 1)])
    assert len(m) == 0


def test_topics_and_margins(spark):
    a, b = "the flood gauge rose over the weir and the discharge grew", "suspended sediment sample bottle filter paper weighed in the laboratory"
    df = spark.createDataFrame([(i, (a, b, "", None)[i % 4], "x") for i in range(200)], "doc_id int, text string, topic string")
    t = topics(df.drop("topic"), "doc_id", "text", k=2)
    got = {(r["doc_id"] % 4, r["topic"]) for r in t.collect()}
    assert len(got) == 4 and (2, "?") in got and (3, "?") in got and len({x for k, x in got if k < 2}) == 2
    assert topics(df.limit(0).drop("topic"), "doc_id", "text").count() == 0


def test_raking_keeps_the_other_margins():
    c = pd.DataFrame([(s, l, "t", float(n)) for s, l, n in (("x", "en", 600), ("x", "de", 400), ("y", "en", 100), ("y", "de", 900))], columns=["source", "language", "topic", "tokens"])
    t = pd.DataFrame([("x", 0.5, 3), ("y", 0.5, 3)], columns=["source", "target_share", "max_repeats"])
    r = rake(c, t, 2000.0, ("language", "topic"))
    r["m"] = r.w * r.tokens
    assert r.groupby("source").m.sum().round(3).to_dict() == {"x": 1000.0, "y": 1000.0}
    assert abs(r[r.language == "en"].m.sum() / 2000 - 700 / 2000) < 0.02


CASES = [
    ("Observer: Søren J. Selüller-Renz.", [("name", "Søren J. Selüller-Renz")]),
    ("Dear ARNHURSTAM, Lena,\nyour table has reached us.", [("name", "ARNHURSTAM, Lena")]),
    ("Mme Hasmarsk garde la clé, joignable au (415) 555 0167.", [("name", "Hasmarsk"), ("phone", "(415) 555 0167")]),
    ("Le lecteur, M. Bruno Corhurstam, habite 39 quai des Sables, à Zelzelpi.", [("name", "Bruno Corhurstam"), ("address", "39 quai des Sables")]),
    ("The chart was read by T. Orvishtan until the pen jammed.", [("name", "T. Orvishtan")]),
    ("According to Clara M. de la Grav, the flood mark was higher.", [("name", "Clara M. de la Grav")]),
    ("Old card: name Daniel O'Kestermannt; street Flat 3, 221 Old Weir Road; phone 07700 900 190; passport 00.208.187-Q", [("name", "Daniel O'Kestermannt"), ("address", "Flat 3, 221 Old Weir Road"), ("phone", "07700 900 190"), ("id_number", "00.208.187-Q")]),
    ("Questions go to wexssonby+gauges [at] basin-east [dot] example [dot] com or by phone to +1 (202) 555-0105.", [("email", "wexssonby+gauges [at] basin-east [dot] example [dot] com"), ("phone", "+1 (202) 555-0105")]),
    ("mailto:desk.lena@rivolta.example for corrections of SED001212.", [("email", "desk.lena@rivolta.example")]),
    ("El lector, don Rafael Lind, vive en Calle Molino 30, 2º B, Pandrunsu.", [("name", "Rafael Lind"), ("address", "Calle Molino 30, 2º B")]),
    ("Der Ableser Teresa Kestácz wohnt in der Tulvastraße 205, Stelruna.", [("name", "Teresa Kestácz"), ("address", "Tulvastraße 205")]),
    ("补贴发给 Osei Mortellier（身份证 00.914.877-Z）。样品请寄至 54 Alder Drive，Hodripa。", [("name", "Osei Mortellier"), ("id_number", "00.914.877-Z"), ("address", "54 Alder Drive")]),
    ("The key is kept at 132A Cooper St.. The weir", [("address", "132A Cooper St.")]),
]
NONE = ["Depth-integrated SSC@0.6 is 3.37 mg/L; the handle @siltwatch posts the live value.", "The weir at Harbour Road was painted; 1510 bolts were replaced.", "Storm Zoë raised the Berrasova by 9.70 m overnight.", "Survey boat Ingrid was out of order.", "Signed: Lowmark Water Board", "Observer: unknown.", "Inventory no. 8173-690-90 is missing; gauge no. 01469144; library call number 916-28-0053.", "Position -13.83521, -140.40116", "échelle à 10.08 m. L'eau était très chargée", "THE UNIT IN THE FILE HEADER SAYS T/DAY. BOTTLE 9141-311 BROKE ON THE WAY.", "visited on 23/09/1976 at 17:52", "", "   "]


@pytest.mark.parametrize("text,want", CASES)
def test_personal_data_is_found_whole(text, want):
    assert [(k, text[s:e]) for k, s, e in pii.find(text)] == want


@pytest.mark.parametrize("text", NONE)
def test_things_and_places_are_none(text):
    assert pii.find(text) == []


def test_check_digits():
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB83 WEST 1234 5698 7654 32")
    assert pii.mod11("52998224725") and not pii.mod11("52998224724")


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_any_text_is_handled(text):
    spans = pii.find(text)
    assert all(0 <= s < e <= len(text) for _, s, e in spans) and all(a[2] <= b[1] for a, b in zip(spans, spans[1:]))


def test_tables(spark):
    long = "The weir. " * 20_000 + "Observer: Marta Kest."
    df = spark.createDataFrame([(1, "😀 Observer: Marta Kest.", "c"), (2, None, "c"), (3, "", "c"), (4, long, "c"), (1, "😀 Observer: Marta Kest.", "c")], "doc_id int, text string, entity_type string")
    got = sorted((r["doc_id"], r["start_offset"], r["end_offset"]) for r in pii.find_pii(df).collect())
    assert got == [(1, 12, 22), (1, 12, 22), (4, len(long) - 11, len(long) - 1)]
    masked = {r["doc_id"]: r["text"] for r in pii.mask_pii(df).collect()}
    assert masked[1] == "😀 Observer: [NAME]." and masked[2] is None and masked[3] == "" and masked[4].endswith("Observer: [NAME].")
    assert pii.find_pii(df.limit(0)).count() == 0


@pytest.mark.parametrize("address", ["Mühlweg 3", "Hauptstr. 7", "Rosenhof 12", "Lindenallee 4", "中山路12号", "长安街5号", "人民大道8号", "柳巷3号", "烟袋胡同9号", "12 Mill Street", "5 rue de la Paix", "Calle Mayor 8", "Am Markt 2"])
def test_an_address_is_found_alone_in_a_text(address):
    assert pii.find(address) == [("address", 0, len(address))]


def test_an_iban_is_found_alone_in_a_text():
    assert pii.find("IBAN DE89 3704 0044 0532 0130 00") == [("id_number", 5, 32)]


@pytest.mark.parametrize("text,want", [("The sample was taken by Priyanka Raghunathan", "Priyanka Raghunathan"), ("Priyanka Raghunathan waded in", "Priyanka Raghunathan"), ("GB82WEST12345698765432 was used", "GB82WEST12345698765432"), ("IBAN: DE89 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 00"), ("pagamento 529.982.247-25", "529.982.247-25"), ("Calle " + "Larga" * 40 + " 1234, Madrid", "Calle " + "Larga" * 40 + " 1234"), ("Maria River rose. Anna Creek fell.", None), ("GB83WEST12345698765432 was used", None), ("pagamento 529.982.247-24", None)])
def test_context_and_check_digits_confirm_alone(text, want):
    assert [text[s:e] for _, s, e in pii.find(text)] == ([want] if want else [])


def test_a_given_name_that_no_list_holds_is_learned_from_its_contexts(spark):
    rows = [(k, f"Observer: Xanthira Vel{k * 'o'}mar. The gauge was read.") for k in range(1, 6)] + [(9, "We met Xanthira Pelmar at the weir. We met Grand Total at noon.")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    assert pii.given_names(df) == frozenset({"xanthira"})
    got = {(r["doc_id"], rows[-1][1][r["start_offset"] : r["end_offset"]]) for r in pii.find_pii(df).filter("doc_id = 9").collect()}
    assert got == {(9, "Xanthira Pelmar")}
    assert pii.find(rows[-1][1]) == []


def test_many_spans_in_one_long_text_are_quick():
    import time

    text = "Write to a.b@c.example or call +44 7700 900190. " * 20_000
    t = time.time()
    assert len(pii.find(text)) == 40_000 and time.time() - t < 60
