"""Exact and near-duplicate removal within an interest's hits: first kept wins.

A candidate is compared with kept hits only, so the result depends on the order and is no connected component. A
run's hits of one interest are bounded by its top-k, so one group is small.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from presswerk.functions.similarity import indel_ratio
from presswerk.functions.text import ascii_tokens, norm_text, normal_url, url_domain

BODY_TOKENS = 180


def prepare(hits: DataFrame) -> DataFrame:
    """Normal forms of hits (interest, rank, score, id, url, fingerprint, title, body, domain)."""
    body = norm_text(F.substring(F.coalesce("body", F.lit("")), 1, 4000))
    return hits.select(
        "interest", "rank", "score", "id", normal_url(F.col("url")).alias("url"), F.lower(F.coalesce("fingerprint", F.lit(""))).alias("fingerprint"), norm_text(F.col("title")).alias("title"), body.alias("body"),
        F.coalesce(F.nullif(F.lower("domain"), F.lit("")), url_domain(F.col("url"))).alias("domain"),
    ).withColumns({"title_tokens": ascii_tokens(F.col("title")), "body_tokens": F.slice(ascii_tokens(F.col("body")), 1, BODY_TOKENS)})


def exact_reason(a: dict, b: dict) -> str | None:
    """Why `b` repeats the kept `a`, the first reason that holds."""
    if a["id"] and a["id"] == b["id"]:
        return "same_id"
    if a["url"] and a["url"] == b["url"]:
        return "same_url"
    if a["fingerprint"] and a["fingerprint"] == b["fingerprint"]:
        return "same_fingerprint"
    if a["title"] and a["title"] == b["title"]:
        x, y = a["body"][:1200], b["body"][:1200]
        if x and (x == y or indel_ratio(x, y) >= 0.98):
            return "same_title_body"
    return None


def cheap_precheck(a: dict, b: dict) -> bool:
    """Lengths not too far apart, and a title word in common where both have some."""
    if abs(len(a["title"]) - len(b["title"])) > max(20, int(0.65 * max(len(a["title"]), len(b["title"])))):
        return False
    if abs(len(a["body"]) - len(b["body"])) > max(240, int(0.80 * max(len(a["body"]), len(b["body"])))):
        return False
    x, y = set(a["title_tokens"]), set(b["title_tokens"])
    return not x or not y or bool(x & y)


def _set_jaccard(a, b) -> float:
    x, y = set(a), set(b)
    return len(x & y) / len(x | y) if x and y else 0.0


def near_reason(a: dict, b: dict) -> str | None:
    title = indel_ratio(a["title"], b["title"])
    if title >= 0.96:
        return "near_title"
    if indel_ratio(a["body"][:1600], b["body"][:1600]) >= 0.97:
        return "near_body"
    words = _set_jaccard(a["body_tokens"], b["body_tokens"])
    if title >= 0.90 and words >= 0.62:
        return "near_title_body_tokens"
    if _set_jaccard(a["title_tokens"], b["title_tokens"]) >= 0.85 and words >= 0.55:
        return "near_title_tokens_body_tokens"
    return None


def same_story_reason(a: dict, b: dict) -> str | None:
    """The lighter predicate of the optional semantic stage."""
    title, body = indel_ratio(a["title"], b["title"]), indel_ratio(a["body"][:1400], b["body"][:1400])
    if title >= 0.88 and body >= 0.45:
        return "story_title_body"
    shared, words = _set_jaccard(a["title_tokens"], b["title_tokens"]), _set_jaccard(a["body_tokens"], b["body_tokens"])
    if shared >= 0.70 and words >= 0.45 and title >= 0.72:
        return "story_tokens"
    return "story_title_tokens" if shared >= 0.80 and body >= 0.40 else None


def block_keys(hit: dict) -> list[str]:
    """Blocking keys: first six title words, alone and with the domain, four 3-grams of the title; else the domain."""
    words = list(dict.fromkeys(hit["title_tokens"]))[:6]
    squeezed = "".join(hit["title"].split())
    grams = list(dict.fromkeys(squeezed[i : i + 3] for i in range(max(0, len(squeezed) - 2))))[:4]
    keys = [f"t:{w}" for w in words] + [f"d:{hit['domain']}|{w}" for w in words if hit["domain"]] + [f"g:{g}" for g in grams]
    return keys or ([f"donly:{hit['domain']}"] if hit["domain"] else [])


def shortlist(candidate: dict, kept: list[dict], postings: dict[str, list[int]], most: int, window: int = 256) -> list[int]:
    """Kept positions by shared keys, most votes first, newest first; without votes the newest of the same domain."""
    votes: dict[int, int] = {}
    for key in block_keys(candidate):
        for position in postings.get(key, [])[-window:]:
            votes[position] = votes.get(position, 0) + 1
    if not votes:
        return [i for i in range(len(kept) - 1, -1, -1) if kept[i]["domain"] and kept[i]["domain"] == candidate["domain"]][:most]
    return sorted(votes, key=lambda i: (-votes[i], -i))[:most]


def dedup_group(rows: list[dict], most: int = 120, same_story: bool = False, counts: list | None = None) -> list[tuple[dict, str | None]]:
    """Each row with the reason of its removal, or None if it is kept; stages one (exact) and two (near).

    `counts` takes the size of each row's shortlist and how many of it were checked.
    """
    rows = sorted(rows, key=lambda r: (r["rank"] if r["rank"] is not None else 10**9, -(r["score"] or 0.0), str(r["id"])))
    out, first = [], []
    for row in rows:
        reason = next((x for k in first if (x := exact_reason(k, row))), None)
        out.append([row, reason])
        if reason is None:
            first.append(row)
    kept: list[dict] = []
    postings: dict[str, list[int]] = {}
    for entry in out:
        row = entry[0]
        if entry[1] is not None:
            continue
        short, checked = shortlist(row, kept, postings, most), 0
        for position in short:
            other = kept[position]
            checked += 1
            if cheap_precheck(other, row) and (reason := near_reason(other, row) or (same_story_reason(other, row) if same_story else None)):
                entry[1] = reason
                break
        else:
            for key in block_keys(row):
                postings.setdefault(key, []).append(len(kept))
            kept.append(row)
        if counts is not None:
            counts.append((len(short), checked))
    return [tuple(x) for x in out]


def dedup_hits(prepared: DataFrame, most: int = 120, same_story: bool = False) -> DataFrame:
    """(interest, id, source_rank, rank, reason): kept hits have dense ranks, removed ones a reason and rank 0."""

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        # A null rank makes the column one of floats.
        rows = [r | {"rank": None if pd.isna(r["rank"]) else int(r["rank"]), "score": None if pd.isna(r["score"]) else r["score"]} for r in pdf.to_dict("records")]
        out, rank = [], 0
        for row, reason in dedup_group(rows, most, same_story):
            rank += reason is None
            out.append((row["interest"], row["id"], row["rank"], rank if reason is None else 0, reason or ""))
        return pd.DataFrame(out, columns=["interest", "id", "source_rank", "rank", "reason"])

    kind = dict(prepared.dtypes)
    return prepared.groupBy("interest").applyInPandas(group, f"interest {kind['interest']}, id {kind['id']}, source_rank int, rank int, reason string")


def neighbour_pairs(hits: DataFrame, k: int = 40, days: int = 3) -> DataFrame:
    """(interest, a, b, score): for each hit its k most similar hits of the interest, of its language and near its date.

    hits (interest, id, lang, date, vec); a null language or date is no restriction for its own hit. A run's hits of
    one interest are bounded by its top-k, so pairs are made within that bound only.
    """
    from presswerk.functions.similarity import cosine

    left = hits.select("interest", F.col("id").alias("a"), F.col("lang").alias("lang_a"), F.col("date").alias("date_a"), F.col("vec").alias("vec_a"))
    right = hits.select("interest", F.col("id").alias("b"), F.col("lang").alias("lang_b"), F.col("date").alias("date_b"), F.col("vec").alias("vec_b"))
    same_lang = F.col("lang_a").isNull() | (F.col("lang_a") == "") | (F.col("lang_a") == F.col("lang_b"))
    apart = F.abs(F.unix_micros("date_a") - F.unix_micros("date_b"))
    pairs = left.join(right, "interest").where((F.col("a") != F.col("b")) & same_lang & (F.col("date_a").isNull() | (apart <= days * 86_400_000_000)))
    scored = pairs.select("interest", "a", "b", F.round(cosine(F.col("vec_a"), F.col("vec_b")), 8).alias("score"))
    order = Window.partitionBy("interest", "a").orderBy(F.desc("score"), "b")
    return scored.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")


def neighbours_among(neighbours: DataFrame, kept: DataFrame) -> DataFrame:
    """Neighbour pairs whose second hit is kept: (interest, a, b, score) with kept (interest, id)."""
    return neighbours.join(kept.select("interest", F.col("id").alias("b")), ["interest", "b"], "left_semi").select("interest", "a", "b", "score")


def shortlist_averages(prepared: DataFrame, most: int = 120) -> DataFrame:
    """(interest, candidates, shortlisted, checked): hits that reach stage two, and their mean shortlist and checks."""

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        counts: list[tuple[int, int]] = []
        dedup_group(pdf.to_dict("records"), most, counts=counts)
        mean = lambda i: sum(c[i] for c in counts) / len(counts) if counts else 0.0
        return pd.DataFrame([(pdf["interest"].iloc[0], len(counts), mean(0), mean(1))], columns=["interest", "candidates", "shortlisted", "checked"])

    kind = dict(prepared.dtypes)
    return prepared.groupBy("interest").applyInPandas(group, f"interest {kind['interest']}, candidates int, shortlisted double, checked double")


def block_key_column(title: Column, tokens: Column, domain: Column) -> Column:
    """The blocking keys as a native expression."""
    words = F.slice(F.array_distinct(tokens), 1, 6)
    squeezed = F.regexp_replace(title, r"(?U)\s+", "")
    grams = F.slice(F.array_distinct(F.when(F.length(squeezed) >= 3, F.transform(F.sequence(F.lit(1), F.length(squeezed) - 2), lambda i: F.substring(squeezed, i, F.lit(3)))).otherwise(F.array().cast("array<string>"))), 1, 4)
    keys = F.concat(F.transform(words, lambda w: F.concat(F.lit("t:"), w)), F.when(domain != "", F.transform(words, lambda w: F.concat(F.lit("d:"), domain, F.lit("|"), w))).otherwise(F.array().cast("array<string>")), F.transform(grams, lambda g: F.concat(F.lit("g:"), g)))
    return F.when(F.size(keys) > 0, keys).when(domain != "", F.array(F.concat(F.lit("donly:"), domain))).otherwise(F.array().cast("array<string>"))
