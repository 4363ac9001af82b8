import os
import random

import numpy as np
import pytest

from presswerk.llm import leaks, mixing, spam

WORDS = [f"w{i}" for i in range(3000)]


def damaged(words, rng, every=9):
    """One word in `every` changed, dropped or followed by a new one."""
    out = []
    for i, w in enumerate(words):
        if i % every == every - 1:
            kind = rng.randrange(3)
            out += [["changed"], [], [w, "added"]][kind]
        else:
            out.append(w)
    return out


def test_leaks(spark):
    rng = random.Random(4)
    items = [(i, " ".join(rng.choices(WORDS, k=150)), "x") for i in range(20)]
    docs, want = [], set()
    for k in range(200):
        body = rng.choices(WORDS, k=200)
        if k % 3 == 0:
            i = rng.randrange(20)
            n = rng.choice([20, 25, 45, 60, 150])
            start = rng.randrange(0, 151 - n)
            piece = items[i][1].split()[start : start + n]
            piece = damaged(piece, rng) if k % 2 else piece
            at = rng.randrange(len(body))
            body = body[:at] + [w.upper() + "," for w in piece] + body[at:]
            if n >= 45:
                want.add((k, i))
        docs.append((k, "  ".join(body), "y"))
    docs += docs[:5] + [(500, None, "y"), (501, "", "y"), (502, "few words", "y"), (None, items[0][1], "y"), (503, "w1 " * 100_000, "y")]
    d = spark.createDataFrame(docs, "doc_id long, text string, seed string")
    i = spark.createDataFrame(items + items[:2] + [(900, None, "x"), (None, "a b", "x")], "item_id long, content string, text string")
    got = {(r.doc_id, r.item_id): r.words for r in leaks.find_leaks(d, i).collect()}
    assert set(got) == want and min(got.values()) >= 36
    # A test table of many blocks gives the same result.
    assert {(r.doc_id, r.item_id): r.words for r in leaks.find_leaks(d, i, block_words=700).collect()} == got
    assert leaks.find_leaks(d.limit(0), i).count() == 0 and leaks.find_leaks(d, i.limit(0)).count() == 0


def test_stretch_limits():
    item = np.arange(100, dtype=np.uint64)
    assert leaks.longest_stretch(item, item[10:46], [-10]) == 36
    assert leaks.longest_stretch(item, item[10:45], [-10]) == 0
    doc = item[10:58].copy()
    doc[[8, 16, 24, 32, 40]] = 1000
    assert leaks.longest_stretch(item, doc, [-10]) == 48
    doc[[12, 20, 28, 36]] = 1000
    assert leaks.longest_stretch(item, doc, [-10]) == 0


def test_single_words_between_edits():
    item = np.arange(36, dtype=np.uint64)
    doc = item.copy()
    doc[[10, 12, 20, 28]] = 1000
    assert leaks.longest_stretch(item, doc, [0]) == 36
    doc = item.copy()
    doc[[1, 3, 20, 34]] = 1000
    assert leaks.longest_stretch(item, doc, [0]) == 36
    doc[25] = 1000
    assert leaks.longest_stretch(item, doc, [0]) == 0
    # 31 words, four dropped ones and one more word: the end is reached before the furthest reach of as many edits.
    assert leaks.longest_stretch(item, np.append(item[:31], item[35]), [0]) == 36


def has_stretch(item, doc):
    """The whole table of edit distances from every pair of equal words."""
    for i in range(len(item)):
        for j in np.flatnonzero(doc == item[i]):
            cost = np.arange(len(doc) - j)
            for k in range(i + 1, len(item)):
                words, new = k + 1 - i, np.append(cost[0] + 1, np.minimum(cost[1:] + 1, cost[:-1] + (doc[j + 1 :] != item[k])))
                if words >= 36 and (8 * cost[:-1][doc[j + 1 :] == item[k]] <= words).any():
                    return True
                cost = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return False


def test_stretches_match_brute_force():
    rng = np.random.default_rng(7)
    found = []
    for k in range(40):
        item = rng.integers(0, 60, 60).astype(np.uint64)
        n = 36 + k % 14
        piece, edits = item[5 : 5 + n].tolist(), n // 8 + k % 2
        for at in sorted(rng.choice(n - 2, edits, replace=False) + 1, reverse=True):
            piece[at : at + 1] = [[1000], [], [piece[at], 1000]][rng.integers(0, 3)]
        doc = np.array([*rng.integers(0, 60, 15), *piece, *rng.integers(0, 60, 15)], dtype=np.uint64)
        found.append(leaks.longest_stretch(item, doc, [10]) >= 36)
        assert found[-1] == has_stretch(item, doc)
    assert 5 < sum(found) < 40


def test_evenly_edited_passages_have_seeds_enough(spark):
    item = [f"i{k}" for k in range(120)]
    docs = []
    for n, changed in ((40, (6, 13, 20, 27, 34)), (40, (5, 12, 19, 26, 33)), (48, (6, 13, 20, 27, 34, 41)), (80, tuple(range(4, 80, 8))), (40, (5, 6, 13, 20, 27, 34))):
        piece = [f"c{k}" if k in changed else w for k, w in enumerate(item[30 : 30 + n])]
        docs.append((len(docs), " ".join([f"a{k}" for k in range(50)] + piece + [f"b{k}" for k in range(50)])))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame([(7, " ".join(item))], "item_id long, content string")
    assert sorted((r.doc_id, r.words) for r in leaks.find_leaks(d, i).collect()) == [(0, 40), (1, 40), (2, 48), (3, 80)]


@pytest.mark.parametrize("min_words", [24, 36, 50])
def test_any_stretch_is_a_candidate(min_words):
    """Random stretches at the limit, of any length and with any kinds of edits, have the seeds the limits ask for."""
    rng = np.random.default_rng(min_words)
    limits = leaks.Limits(min_words)
    for k in range(150):
        n = int(rng.integers(min_words, 3 * min_words))
        item = np.arange(1, 2 * n + 20, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        piece = item[7 : 7 + n].tolist()
        for at in sorted(rng.choice(n - 2, n // 8, replace=False) + 1, reverse=True):
            kind = [0, 1, 2, int(rng.integers(0, 3))][k % 4]
            piece[at : at + 1] = [[at], [], [piece[at], at]][kind]
        doc = np.array([*range(1000, 1090), *piece, *range(2000, 2090)], dtype=np.uint64)
        table = leaks.TestTable([1], [item])
        found = leaks.candidates(doc, np.array([len(doc)]), table, table.filter(), limits)
        assert found and leaks.longest_stretch(item, doc, [x for f in found for x in f[2:]], min_words) >= min_words, (n, k)
    with pytest.raises(ValueError):
        leaks.Limits(17)


def test_long_texts_are_cut_with_overlap():
    words = np.arange(3 * leaks.PIECE_WORDS, dtype=np.uint64)
    pieces = list(leaks._pieces(words))
    assert pieces[0][0] == 0 and pieces[-1][-1] == words[-1] and max(map(len, pieces)) <= leaks.PIECE_WORDS
    assert all(a[-1] - b[0] >= leaks.PIECE_OVERLAP - 1 for a, b in zip(pieces, pieces[1:]))
    assert len(list(leaks._pieces(words[:5]))) == 1 and len(list(leaks._pieces(words[:0]))) == 1


needs_tokenizer = pytest.mark.skipif(not os.path.exists(mixing.TOKENIZER_FILE), reason="no tokenizer here")


@needs_tokenizer
def test_mix_reaches_shares(spark):
    rng = random.Random(1)
    docs = [(k, "word " * rng.randrange(1, 200), rng.choice(["a", "a", "a", "b", "c", "other", None]), "x") for k in range(3000)]
    docs += [(9000 + k, "the same text " * 30, "a", "x") for k in range(1500)] + docs[:50] + [(8000, None, "a", "x"), (8001, "", "b", "x"), (None, "text", "a", "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, tokens string")
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 4)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(d, t).toPandas()
    assert mixed["doc_id"].is_unique and set(mixed["source"]) == {"a", "b", "c"}
    for source, cap in (("a", 1), ("b", 2), ("c", 4)):
        assert mixed[mixed["source"] == source]["copies"].max() <= cap
    shares = mixing.reached_shares(spark.createDataFrame(mixed), t).toPandas()
    assert (abs(shares["share"] - shares["target_share"]) < 0.005).all()
    # The total is as large as the caps allow: some source is used in full.
    counts = mixing.token_counts(d, None).dropDuplicates(["doc_id"]).toPandas().groupby("source")["tokens"].sum()
    full = [abs(r.tokens - counts[r.source] * cap) < 400 for r, cap in zip(shares.itertuples(), shares["source"].map({"a": 1, "b": 2, "c": 4}), strict=True)]
    assert any(full)
    assert mixing.mix(d.limit(0), t).count() == 0
    missing = spark.createDataFrame([("a", 0.5, 1), ("nowhere", 0.5, 2)], "source string, target_share double, max_repeats int")
    rest = mixing.mix(d, missing)
    assert {r.source for r in rest.select("source").distinct().collect()} == {"a"}
    reached = {r.source: (r.target_share, r.share, r.tokens) for r in mixing.reached_shares(rest, missing).collect()}
    assert reached["nowhere"] == (0.5, 0.0, 0) and reached["a"][:2] == (0.5, 1.0)
    # Copies of one text are rounded in parts.
    mixed = mixing.mix(d, t, part_docs=100).toPandas()
    assert mixed["doc_id"].is_unique and (abs(mixing.reached_shares(spark.createDataFrame(mixed), t).toPandas().eval("share - target_share")) < 0.005).all()


NEWS = "The council met on Monday and heard the plan for the old bridge. The airline would not say why it had withdrawn its offer. Residents of the town were told that the work begins in spring, and that the price is not yet known.\n"


def test_spam(spark):
    rng = random.Random(6)
    subjects = ["The council", "The airline", "A museum", "The finance minister", "The border police", "A local start-up", "The press council", "The film festival"]
    verbs = ["signed", "rejected", "delayed", "praised", "revised", "questioned", "unveiled", "halted"]
    ends = ["on Monday", "after a long debate", "with immediate effect", "because of the rain", "at a crowded meeting", "without further comment"]
    w = lambda: rng.choice(WORDS)
    forms = [lambda: f"{rng.choice(subjects)} {rng.choice(verbs)} the plan of {w()} for {w()} {rng.choice(ends)}.", lambda: f"In {w()}, about {w()} people heard that {w()} was not there.", lambda: f"It has reached {w()} and {w()}, said {w()} from {w()}.", lambda: f"{w()} thanked {w()} but had not been to the {w()} of {w()}."]
    story = lambda: " ".join(rng.choice(forms)() for _ in range(12))
    names = [f"Town{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    keys = ["cheap flights", "payday loan", "wedding rings", "used laptops"]
    docs = [(k, "A title without end\n" + story() + "\n" + story()) for k in range(60)]
    docs += [(100, " | ".join(rng.choice(keys) for _ in range(60))), (101, " ".join("#" + rng.choice(keys).replace(" ", "") for _ in range(60))), (102, "\n".join(f"https://www.{rng.choice(names).lower()}.example/{rng.choice(keys).replace(' ', '-')}" for _ in range(30)))]
    docs += [(103, " ".join(f"Why {k}? {k} saves money, {k} saves time. Ask {rng.choice(names)} about {k} and {k} prices for {k}." for k in ["cheap flights"] * 12)), (104, "\n".join(rng.choice(keys) for _ in range(80)) + "\n" + story()[:80] + ".")]
    docs += [(200, "Results of the day\n" + "\n".join(f"{names[2 * i]} – {names[2 * i + 1]} {rng.randrange(5)}:{rng.randrange(5)}" for i in range(30))), (201, story() + "\nhttps://www.a.example/x\n#tag"), (202, ""), (203, None), (204, "two words"), (105, "#cheap #flights #today"), (205, "Cheap flights")]
    df = spark.createDataFrame(docs + docs[:3] + [(None, "x")], "doc_id long, text string").selectExpr("*", "1 as words", "2 as block")
    assert sorted(r.doc_id for r in spam.find_spam(df).collect()) == [100, 101, 102, 103, 104, 105]
    shares = {r.doc_id: r.spam_share for r in spam.spam_shares(df).collect()}
    assert 203 not in shares and shares[202] == 0.0 and len(shares) == len({x[0] for x in docs}) - 1
    assert spam.find_spam(df.limit(0)).count() == 0


def test_word_salad(spark):
    """Random words are spam whether their pairs are unknown (a small corpus) or not; told stories are not."""
    rng = random.Random(8)
    rare = [f"w{i}" for i in range(600)]
    runs = [rng.sample(rare, 12) for _ in range(60)]
    docs = [(k, ". ".join(" ".join(["Said", *rng.choice(runs)]) for _ in range(8)) + ".") for k in range(150)]
    docs += [(1000 + k, ". ".join(" ".join(["Said", *rng.choices(rare, k=12)]) for _ in range(8)) + ".") for k in range(10)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r.doc_id for r in spam.find_spam(df).collect()) == list(range(1000, 1010))


def test_word_salad_with_function_words(spark, monkeypatch):
    """Coherence decides on every sentence, of many function words and of few words too, whatever counts are joined."""
    rng = random.Random(9)
    small = ["the", "of", "in", "to", "and", "for", "at", "by", "with", "from", "on", "as"]
    rare = [f"w{i}" for i in range(400)]
    runs = [[x for pair in zip(rng.choices(small, k=5), rng.sample(rare, 5), strict=True) for x in pair] for _ in range(40)]
    drawn = lambda k: [x for pair in zip(rng.choices(small, k=k), rng.choices([w for r in runs for w in r[1::2]], k=k), strict=True) for x in pair]
    docs = [(k, ". ".join(" ".join(rng.choice(runs)).capitalize() for _ in range(8)) + ".") for k in range(150)]
    docs += [(1000 + k, ". ".join(" ".join(drawn(5)).capitalize() for _ in range(20)) + ".") for k in range(10)]
    docs += [(1100 + k, ". ".join(" ".join(drawn(2)).capitalize() for _ in range(40)) + ".") for k in range(10)]
    docs += [(2000 + k, ". ".join(" ".join(runs[k + j][i : i + 5]).capitalize() for j in range(8) for i in (0, 5)) + ".") for k in range(10)]
    salad = [*range(1000, 1010), *range(1100, 1110)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r.doc_id for r in spam.find_spam(df).collect()) == salad
    shares = sorted(map(tuple, spam.spam_shares(df).collect()))
    for known in (0, 60):
        monkeypatch.setattr(spam, "MAX_KNOWN", known)
        assert sorted(r.doc_id for r in spam.find_spam(df).collect()) == salad
        assert sorted(map(tuple, spam.spam_shares(df).collect())) == shares


def test_coherence_needs_a_corpus(spark):
    """Told sentences whose words no other page holds are not called incoherent."""
    other = "A farmer near the lake sold his last horse in autumn, because it was too old for the work. He said that he would walk to the market from now on.\n"
    df = spark.createDataFrame([(1, NEWS), (2, other)], "doc_id long, text string")
    assert spam.find_spam(df).count() == 0 and spam.find_spam(df.where("doc_id = 1")).count() == 0


def test_runs_of_short_sentences():
    runs = spam.PageJudge()._runs
    assert runs([(0, 3), (1, 3), (2, 3), (3, 3)]) == [(0, 4)]
    assert runs([(0, 3), (1, 9), (3, 3), (5, 9), (6, 3)]) == [(0, 2), (5, 7)]
    assert runs([(4, 9), (5, 9)]) == [(4, 5), (5, 6)] and runs([]) == []
