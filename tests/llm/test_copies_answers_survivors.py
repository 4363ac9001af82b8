import random
import re

import numpy as np

from presswerk.llm import answers, near_copies, survivors
from presswerk.llm.blocks import PublisherNames
from presswerk.llm.words import WordHashes

WORDS = [f"w{i}" for i in range(400)]


def brute_pairs(rows):
    sets = {}
    for key, title, content in rows:
        if key is None or content is None or content.strip().lower() in ("", "none", "nan"):
            continue
        w = re.findall(r"\w+", f"{title or ''}\n{content}".lower())
        s = {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
        if s:
            sets[key] = s
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b]):
                root[find(b)] = find(a)
    return {(a, b) for a in ids for b in ids if a < b and find(a) == find(b)}


def test_near_copies_match_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for g in range(30):
        words = [rng.choice(WORDS) for _ in range(120)]
        for k in range(rng.choice([1, 2, 3])):
            w = list(words)
            for _ in range(rng.choice([0, 4, 8, 12])):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            rows.append((f"g{g}k{k}", None if k else "Title", " ".join(w)))
    # A chain: neighbours are similar, its ends are not; a hot text that stands in a third of the rows.
    chain = [f"c{i}" for i in range(100)]
    for k in range(4):
        rows.append((f"chain{k}", "", " ".join(chain)))
        chain = [f"x{k}_{i}" for i in range(18)] + chain[18:]
        rng.shuffle(rows)
    rows += [(f"hot{i}", "Same", " ".join(WORDS[:80])) for i in range(40)]
    rows += [("n", None, None), ("e", "t", ""), ("none", "t", "None"), ("short", None, "one two"), (None, "t", "a b c d"), ("big", "t", " ".join(WORDS * 200))] + rows[:10]
    df = spark.createDataFrame(rows, "id string, title string, content string").selectExpr("*", "1 as rep", "2 as band", "3 as label")
    classes = {r.id: (r.class_id, r.links) for r in near_copies.near_copy_classes(df).collect()}
    got = {(a, b) for a in classes for b in classes if a < b and classes[a][0] == classes[b][0]}
    assert got == brute_pairs(rows)
    assert len(classes) == len({r[0] for r in rows if r[0] not in (None, "n", "e", "none", "short")})
    assert classes["hot1"] == classes["hot2"] and classes["hot1"][1] == 0
    assert near_copies.near_copy_classes(df.limit(0)).count() == 0


def test_large_bands_lose_no_link(spark):
    """With groups of two, every band goes through leaders and blocks; classes stay those of the brute force."""
    rng = random.Random(3)
    base, rows = [rng.choice(WORDS) for _ in range(60)], []
    for g in range(12):
        words = base[:45] + [f"g{g}x{k}" for k in range(rng.choice([15, 30, 60]))]
        for k in range(6):
            w = list(words)
            for _ in range(k):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            rows.append((f"g{g}k{k}", None, " ".join(w)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id string, title string, content string").repartition(3)
    classes = {r.id: r.class_id for r in near_copies.near_copy_classes(df, group=2, local_group=2).collect()}
    assert {(a, b) for a in classes for b in classes if a < b and classes[a] == classes[b]} == brute_pairs(rows)


def test_pairs_of_bands_in_any_batches():
    rng = np.random.default_rng(1)
    key = np.sort(np.concatenate([rng.integers(0, 50, 200), np.full(700, 51), np.full(100, 60)]))
    rep = np.arange(len(key))
    import pyarrow as pa

    for size in (1, 7, 100, 5000):
        batches = [pa.RecordBatch.from_arrays([pa.array(key[i : i + size]), pa.array(rep[i : i + size]), pa.array(np.full(len(key[i : i + size]), -1)), pa.array(np.zeros(len(key[i : i + size]), np.int64))], names=["key", "rep", "leader", "band"]) for i in range(0, len(key), size)]
        got = [(a, b, c) for x in near_copies._pair_batches(near_copies.GROUP)(iter(batches)) for a, b, c in zip(*(y.to_pylist() for y in x.columns))]
        want = {(a, b) for a in rep for b in rep if a < b and key[a] == key[b] and key[a] != 51}
        assert {(a, b) for a, b, c in got if c is None} == want and len([1 for x in got if x[2] is None]) == len(want)
        star = {(a, b) for a, b, c in got if c == 51 and a < b}
        assert len(star) == 699 and len({a for a, _ in star}) == 1


def test_sketch_fills_and_estimates():
    cache = WordHashes()
    a = near_copies.shingles("", " ".join(WORDS[:300]), cache)
    b = near_copies.shingles("", " ".join(WORDS[60:300] + [f"v{i}" for i in range(60)]), cache)
    tiny = near_copies.shingles("", "one two three four", cache)
    x = near_copies.sketches([a, b, tiny, a[::-1]])
    assert (x != np.iinfo(np.uint64).max).all() and (x[0] == x[3]).all()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((x[0] == x[1]).mean() - true) < 0.1


NAMES = PublisherNames(["Mondhavn Herald"])
STORY = "The council met on Monday and heard the plan for the bridge.\nBy the Mondhavn Herald newsroom\nThe airline would not say why it had withdrawn the offer to the drivers in Hek.\nA third line of the story was about the school meal programme and its cost."
TITLE = "Council hears the plan for the old bridge"
GOOD = "The council of the town discussed a new bridge, and the airline “kept silent”. Veixath Labs cannot comment on the request and declined to answer."
CASES = [
    (GOOD, None), ("It rained (see the earlier report).", None), ("Is there a plan for the bridge of the town?", None), ("The airline would not say why. Others said that the bill is high.", None),
    ('{"summary": "The bridge was discussed by the council and will be built."}', None),
    (None, "empty"), ("", "empty"), (" \n", "empty"), ("N/A", "empty"), ("{}", "empty"), ("Summary:", "empty"), ("(empty)", "empty"), ("…", "empty"),
    ("I'm sorry, but I can’t comply with that.", "refusal"), ("UNFORTUNATELY, I MUST DECLINE TO SUMMARISE THE TEXT.", "refusal"), ("No summary can be offered here: my rules do not let me discuss this subject.", "refusal"),
    ("The material cannot be summarised by me.", "refusal"), ("Summary: That is something I'd prefer to leave unanswered.", "refusal"), ("As I do not take part in political matters, the summary is omitted.", "refusal"),
    (TITLE, "copy"), (f'"{TITLE.upper()}."', "copy"), ("Summary: " + STORY.split("\n")[2], "copy"), ("The airline would\nnot say why it had withdrawn the offer to the drivers in Hek. A third line of the story was about the school meal programme and its cost.", "copy"),
    ("Le conseil municipal a discuté du nouveau pont et de la compagnie.", "language"), ("Der Stadtrat sprach am Montag über die neue Brücke.", "language"), ("市议会周一讨论了新桥的计划。", "language"),
    (GOOD[:60], "truncated"), (GOOD + " Behind closed doors,", "truncated"), (GOOD + " The airline…", "truncated"), ('{"summary": "The bridge was discussed by the', "truncated"), ("The council spoke of a bridge (and then it", "truncated"), (GOOD + ' “The airline dropped the plan,”', "truncated"),
]


def test_defects():
    for text, want in CASES:
        assert answers.defect_of(text, TITLE, STORY, NAMES) == want, text


def test_pushdown_parser():
    e = answers.parse_ending
    assert not e("Done. “Yes.”").truncated and not e("```\ncode\n```\nDone.").truncated and e("```\ncode").truncated
    assert e("<p>Some text").truncated and not e("<p>Some <b>text</b>.</p>").truncated and not e("- one thing\n- two things").truncated
    assert e("1. The council met on Monday.\n2. The bridge will be bui").truncated and e("- The council met on Monday\n- The bridge of the").truncated
    assert not e("Points:\n- one thing.\n- two things.").truncated and not e("* one\n* two\n\nThat was all.").truncated and e("* one\n* two\n\nThat was").truncated
    assert e("- only one item").truncated and e("- an item (with\n- another").truncated
    assert e("A list [of (things.").truncated and not e("(a [b] {c}).").truncated


def test_languages_no_list_knows():
    assert answers.language_of("De raad van de stad besprak een nieuwe brug over de rivier in het centrum.") != "en"
    assert answers.language_of("Rada miasta omawiała nowy most nad rzeką w centrum miasta w poniedziałek.") != "en"
    assert answers.language_of(GOOD) == "en" and answers.language_of("Council hears plan") in ("", "en")


def test_first_kind_in_precedence_counts(spark):
    s = spark.createDataFrame([(1, "art", "The airline would not say why it had withdrawn the offer to the drivers in")], "id long, article_id string, summary_fr string")
    a = spark.createDataFrame([("art", "t", STORY), ("art", "t", "Another text of the article that came later on.")], "id string, title string, content string")
    out = answers.find_defects(s, a, spark.createDataFrame([("s", "Mondhavn Herald")], "source string, display_name string")).collect()
    assert [(r.id, r.defect) for r in out] == [(1, "copy")]


def test_tiles_longest_first():
    a, b = "a b c d e x f g h i".split(), "f g h i q a b c d e".split()
    assert sorted(answers.tiles(a, b)) == [(0, 5, 5), (6, 0, 4)]
    assert answers.tiles("a b c".split(), b) == []


def test_defect_rows(spark):
    rows = [(i, "art" if i % 2 else "gone", text, "x") for i, (text, want) in enumerate(CASES) if want not in ("copy",)] + [(900, None, None, "x"), (None, "art", "", "x")]
    s = spark.createDataFrame(rows + rows[:4], "id long, article_id string, summary_fr string, title string")
    a = spark.createDataFrame([("art", TITLE, STORY), ("art", TITLE, STORY), (None, None, None)], "id string, title string, content string")
    src = spark.createDataFrame([("s", "Mondhavn Herald")], "source string, display_name string")
    out = answers.find_defects(s, a, src).collect()
    assert {(r.id, r.defect) for r in out} == {(i, w) for i, (_, w) in enumerate(CASES) if w not in (None, "copy")} | {(900, "empty")} and len(out) == len({r.id for r in out})
    assert answers.find_defects(s.limit(0), a, src).count() == 0


SOURCES = [("s1", "Europe/Paris", True, 10), ("s2", "UTC", True, 20), ("s3", "UTC", True, 5)]


def test_survivors(spark):
    rows = [
        ("a1", "F1", "short", "2025-01-02T00:00:00Z", "s1"), ("a2", "f1", "much longer text", "2025-01-01T00:00:00Z", "s2"), ("a2", "f1", "much longer text", "2025-01-01T00:00:00Z", "s2"),
        ("b1", "f2", None, "2 hours ago", None), ("b2", "F2", "None", None, None),
        ("c1", "f3", "x", None, "s1"), ("d1", None, "x", None, "s1"), (None, "f1", "x", None, "s1"), ("e1", " ", "x", None, "s1"),
        ("t1", "f4", "same", "2025-01-01T00:00:00Z", "s1"), ("t2", "f4", "four", "2025-01-01T00:00:00Z", "s1"),
    ]
    # In twelve groups s3 comes before s2, so a row of s2 without a date is later than a dated one of s3.
    for g in range(12):
        rows += [(f"g{g}x", f"gr{g}", "aa", "2025-01-01T00:00:00Z", "s3"), (f"g{g}y", f"gr{g}", "a", "2025-01-05T00:00:00Z", "s2")]
    rows += [("u1", "f5", "aa", "2025-03-01T00:00:00Z", "s3"), ("u2", "f5", "a", "yesterday", "s2")]
    df = spark.createDataFrame(rows, "id string, fingerprint string, content string, published_date string, source string").selectExpr("*", "1 as level", "2 as value")
    src = spark.createDataFrame(SOURCES, "source string, home_zone string, day_first boolean, trust int")
    got = {r.fingerprint: (r.content_id, r.date_id, r.source_id, r.current_id) for r in survivors.best_representatives(df, src).collect()}
    assert got["f1"] == ("a2", "a1", "a2", "a1")
    assert got["f2"][:3] == (None, None, None) and got["f2"][3] in ("b1", "b2")
    assert got["f4"] == ("t2", "t2", "t2", "t2")
    assert got["f5"] == ("u1", "u1", "u2", "u2")
    assert set(got) == {"f1", "f2", "f4", "f5"} | {f"gr{g}" for g in range(12)}
    assert survivors.best_representatives(df.limit(0), src).count() == 0


def test_currency_orders_by_reachability(spark):
    """Three values in a chain, one apart: only values that lead to one another order the members."""
    day = lambda d: f"2025-01-{d:02d}T00:00:00Z"
    rows = []
    for g in range(6):
        rows += [(f"h{g}a", f"h{g}", "x", day(1), "A"), (f"h{g}b", f"h{g}", "x", day(2), "B")]
        rows += [(f"k{g}b", f"k{g}", "x", day(1), "B"), (f"k{g}c", f"k{g}", "x", day(2), "C")]
    # Equal texts, no timestamps: A leads to C by way of B, which the group does not hold.
    rows += [("p2", "p", "x", None, "A"), ("p1", "p", "x", None, "C")]
    # D is not ordered with C or A, though C has two values below it: C overtakes A, and of C and D the larger id is taken.
    rows += [("q1", "q", "x", None, "C"), ("q2", "q", "x", None, "D"), ("q3", "q", "x", None, "A")]
    # An undated member is later than the latest dated one only if its value follows that one's.
    rows += [("r1", "r", "x", day(9), "B"), ("r2", "r", "x", "yesterday", "C"), ("s1", "s", "x", day(9), "B"), ("s2", "s", "x", None, "D"), ("t1", "t", "x", day(9), "C"), ("t2", "t", "x", None, "A")]
    # Equal instants: the later value.
    rows += [("u2", "u", "x", day(9), "A"), ("u1", "u", "x", day(9), "B"), ("u0", "u", "x", day(1), "C")]
    df = spark.createDataFrame(rows, "id string, fingerprint string, content string, published_date string, source string")
    src = spark.createDataFrame([(x, "UTC", True, 1) for x in "ABCD"], "source string, home_zone string, day_first boolean, trust int")
    got = {r.fingerprint: r for r in survivors.best_representatives(df, src).collect()}
    assert got["p"].content_id == got["p"].current_id == got["p"].source_id == "p1" and got["p"].date_id is None
    assert got["q"].content_id == got["q"].current_id == "q2"
    assert (got["r"].current_id, got["s"].current_id, got["t"].current_id) == ("r2", "s1", "t1")
    assert got["u"].date_id == got["u"].current_id == "u1" and got["u"].content_id == "u0"
    none = spark.createDataFrame([], "attribute string, group_key string, id string, value string, epoch_us long")
    assert survivors.learn_precedence(none).count() == 0
