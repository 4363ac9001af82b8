import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presswerk.llm import blocks, language, repeated_lines

ARTICLES = "id string, source string, content string, key string, src long, doc int"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 65535), max_size=40), min_size=1, max_size=4))
def test_containers_round_trip_and_unite(sets):
    packed = [repeated_lines.pack(np.array(sorted(s), dtype=np.int64)) for s in sets]
    assert [set(repeated_lines.unpack(p).tolist()) for p in packed] == sets
    assert set(repeated_lines.unpack(repeated_lines.unite(packed)).tolist()) == set().union(*sets)


def test_dense_container_is_a_bitmap():
    many = np.arange(0, 65536, 3)
    packed = repeated_lines.pack(many)
    assert packed[:1] == b"B" and len(packed) == 8193 and (repeated_lines.unpack(packed) == many).all()


def brute_repeated(rows, min_docs=8, share=0.04):
    docs, ids = {}, {}
    for key, source, content in {(r[0], r[1], r[2]) for r in rows}:
        if key is None or source is None:
            continue
        ids.setdefault(source, set()).add(key)
        if content is None or content.strip().lower() in ("", "none", "nan"):
            continue
        for i, line in enumerate(content.split("\n")):
            if line.strip():
                k = re.sub(r"[\s\d]+", "", line.upper().lower())
                docs.setdefault((source, k), {}).setdefault(key, set()).add(i)
    return {(d, i) for (s, _), x in docs.items() if len(x) >= min_docs and len(x) >= share * len(ids[s]) for d, places in x.items() for i in places}


def test_repeated_lines_match_brute_force(spark):
    rng = random.Random(5)
    common = ["All rights reserved", "ALL  RIGHTS reserved 7", "Share this 12 times", "By the desk", "rare notice"]
    rows = []
    for i in range(400):
        source = "hot" if i % 3 else rng.choice(["b", "c", None])
        lines = [f"Story {i} {rng.random()}", "", rng.choice(common), "  ", rng.choice(common), f"End of {i}x{'y' * (i % 5)}"]
        content = rng.choice([None, "", "None", "nan"]) if i % 50 == 0 else "\n".join(lines)
        rows.append((f"id{i}", source, content, "k", 1, 2))
    rows += rows[:40] + [(None, "hot", "All rights reserved", None, None, None), ("long", "hot", "x" * 200_000 + "\nBy the desk", "k", 1, 2)]
    found = {(r.id, r.line_no) for r in repeated_lines.find_repeated_lines(spark.createDataFrame(rows, ARTICLES)).collect()}
    assert found == brute_repeated([(r[0], r[1], r[2]) for r in rows]) and found
    parted = repeated_lines.find_repeated_lines(spark.createDataFrame(rows, ARTICLES), look_up_lines=50)
    assert {(r.id, r.line_no) for r in parted.collect()} == found
    assert repeated_lines.find_repeated_lines(spark.createDataFrame([], ARTICLES)).count() == 0


def test_threshold_tie_and_removal(spark):
    rows = [(f"i{i}", "s", ("Same line\nstory " + str(i) * 3) if i < 8 else f"only {chr(97 + i % 26) * (i % 13 + 3)} {chr(97 + i // 26)}", "k", 1, 2) for i in range(200)]
    df = spark.createDataFrame(rows, ARTICLES)
    places = repeated_lines.find_repeated_lines(df)
    got = {(r.id, r.line_no) for r in places.collect()}
    assert got == brute_repeated([(r[0], r[1], r[2]) for r in rows]) and {(f"i{i}", 0) for i in range(8)} <= got
    cleaned = {r.id: r.content for r in repeated_lines.remove_lines(df, places).collect()}
    assert len(cleaned) == 200 and all("Same line" not in (c or "") for c in cleaned.values())


SOURCES = [("a.example", "Mondhavn Herald", "en"), ("b.example", "Skorv Courier", "pt")]
PAGE = """Home | World | Sport | Culture
Your privacy matters to us, so we ask before we track. Manage preferences
By the Mondhavn Herald newsroom
The harbour authority signed the sale of the old bridge on Monday. The city council was not asked.
A costly delay: Tozas
• About 300 people in Tozas heard that the airline withdrew the plan.
Tozas – Hek 3:1
Advertisement
“The airline dropped a ban on night flights,” a spokesman told reporters in Hek.
SEE MORE >> The airline signed the new budget in Hek
Related stories
The airline approved the new budget after a debate
Hek: the city council dropped the satellite launch
Like what you read? Pass it on!
MONDHAVN  HERALD IS NOT RESPONSIBLE FOR THE CONTENT OF EXTERNAL SITES. CASE FILE 7.
Terms of use | Privacy | Contact"""
STORY_LINES = {3, 4, 5, 6, 8}


def test_block_rules(spark):
    names = blocks.PublisherNames([s[1] for s in SOURCES])
    lines = PAGE.split("\n")
    assert {i for i, k in enumerate(blocks.label_lines(lines, names)) if k == blocks.STORY} == STORY_LINES
    cut = "The council met on Monday in Hek. It was late.\nThe airline then approved the new bud"
    assert blocks.label_lines(cut.split("\n"), names) == [blocks.STORY, blocks.STORY]
    sources = spark.createDataFrame(SOURCES, "source string, display_name string, home_lang string")
    rows = [("p", PAGE, "x"), ("p", PAGE, "x"), ("n", None, "x"), ("e", "", "x"), ("none", "None", "x"), (None, PAGE, "x"), ("long", "The airline was not asked. " * 20_000, "x")]
    df = spark.createDataFrame(rows, "id string, content string, line_nos string")
    got = [(r.id, r.line_no) for r in blocks.find_page_lines(df, sources).collect()]
    assert sorted(got) == sorted(("p", i) for i in range(len(lines)) if i not in STORY_LINES)
    main = {r.id: r.content for r in blocks.main_content(df.where("id = 'p'"), sources).collect()}
    assert main["p"].split("\n") == [lines[i] for i in sorted(STORY_LINES)]
    assert blocks.find_page_lines(df.limit(0), sources).count() == 0


def test_one_cue_decides_no_sentence():
    names = blocks.PublisherNames(["Mondhavn Herald"])
    story = [
        "The editor told the Mondhavn Herald that the council of the town would build the bridge in May.",
        "The company sells a newsletter to its readers and the court ruled on it on Monday.",
        "“We use cookies to protect your privacy,” a spokesman of the airline told the council in May.",
        "All content on the shelves was damaged by the water, a speaker of the museum said.",
        "Share prices fell after the company said it would send its staff home.",
        "The staff of the museum lost their licence for the reproduction of old maps.",
        "Our readers sent letters about the plan of the council to the minister on Monday.",
        "The agencies said that an alert was sent to the inbox of every reader of the letter.",
    ]
    page = ["All  content on MONDHAVN HERALD is protected and may not be copied without written consent.", "We and our partners use cookies, as described in the notice.", "Mondhavn Herald staff and agencies", "Read also: the council met in May and was told of the plan"]
    assert [blocks.decide(x, names) for x in story] == [blocks.STORY] * 8
    assert [blocks.decide(x, names) for x in page] == [blocks.PAGE] * 4


@pytest.fixture(scope="module")
def labelled(spark, small):
    folder = small.replace("sf0.001", "sf0.01")
    return spark.read.parquet(f"{folder}/articles.parquet"), spark.read.parquet(f"{folder}/sources.parquet")


def test_language_held_out(labelled):
    articles, sources = labelled
    names = blocks.publisher_names(sources)
    model = language.fit_on_labels(articles, sources, names, max_rows=120)
    sentences = {
        "en": "The national museum withdrew the plan for the old bridge after weeks of talks with the council.",
        "fr": "Le musée national a retiré le projet du vieux pont après des semaines de discussions avec le conseil.",
        "de": "Das Nationalmuseum verwarf den Plan für die alte Brücke nach wochenlangen Gesprächen mit dem Stadtrat.",
        "es": "El museo nacional retiró el plan del viejo puente después de semanas de conversaciones con el ayuntamiento.",
        "it": "Il museo nazionale ha ritirato il piano per il vecchio ponte dopo settimane di colloqui con il consiglio.",
        "pt": "O museu nacional retirou o plano da velha ponte após semanas de conversações com a câmara municipal.",
    }
    p = model.probabilities(list(sentences.values()))
    assert [language.LANGUAGES[i] for i in p.argmax(axis=1)] == list(sentences)
    assert (p.max(axis=1) > 0.9).all()


def test_language_rows(spark, labelled):
    articles, sources = labelled
    en = "The council met on Monday and was told that the airline would not pay for the bridge."
    fr = "Le conseil municipal a refusé le projet du nouveau pont pour des raisons de sécurité."
    home = sources.select("source", "home_lang").where("home_lang = 'en'").first()[0]
    extra = [("right", f"{en}\n{en}", "EN-gb", home), ("missing", en, "??", home), ("wrong", f"{fr}\n{fr}", "en", None), ("mixed", f"{en}\n{fr}\n{en}", "eng", home), ("empty", "", "en", home), ("null", None, None, None), (None, en, "fr", home)]
    df = articles.select("id", "content", "lang", "source").unionByName(spark.createDataFrame(extra + extra[:2], "id string, content string, lang string, source string"))
    ids = [x[0] for x in extra if x[0]]
    out = language.language_labels(df, sources, max_rows=120).where(f"id in {tuple(ids)}").collect()
    got = {(r.id, r.line_no, r.lang) for r in out}
    assert got == {("right", -1, "en"), ("missing", -1, "en"), ("wrong", -1, "fr"), ("mixed", -1, "en"), ("mixed", 1, "fr")} and len(out) == 5
    assert all(0 < r.confidence <= 1 and not r.rejected for r in out)
    unknown = spark.createDataFrame([("zz", "Xq zv.\nKj wq.", "en", home)], "id string, content string, lang string, source string")
    assert [r.rejected for r in language.language_labels(df.unionByName(unknown), sources, max_rows=120).where("id = 'zz' and line_no = -1").collect()] == [True]
    assert language.language_labels(df.limit(0), sources).count() == 0
