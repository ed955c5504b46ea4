"""Fingerprints of op4: short texts and shifted lines."""

import hashlib
import re

import numpy as np
import pytest

from maillage.llm import queries, sketches
from tests.llm.conftest import AWKWARD


def test_short_texts_are_like_their_edits(docs):
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9)))
    texts = ["abcd", "word by word", "漢字かな交じり文の長い行です", *(" ".join(word() for _ in range(n)) for n in (*range(1, 60), 200, 2000))]
    rows = list(enumerate(t for t in texts if len(t) >= 4))
    got = sketches.fingerprinted(docs(rows), cut=sketches.content_digests).collect()
    assert len(got) == len(rows) and all(r.recovered for r in got)
    assert all(r.near_edited > 0 and r.near_edited > r.near_next for r in got)


@pytest.mark.parametrize("at", [0, 3])
def test_a_word_put_in_moves_its_surroundings_only(docs, at):
    words = [f"w{i * 7919 % 1000}" for i in range(600)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:at], "new", *words[at:]]))]
    got = {r.doc_id: r for r in sketches.fingerprinted(docs(rows), cut=sketches.content_digests).collect()}
    assert got[1].near_next > 0.9 and got[2].near_next > 0.9


def test_query_cuts_by_content(spark, docs, tmp_path):
    docs([*enumerate(AWKWARD), (50, "one short line"), (51, "another thing")]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op4_fingerprints(spark, str(tmp_path)).collect()}
    assert 0 < got[50].near_edited < 1 and all(r.recovered for r in got.values())
    assert got[0].fingerprint == got[1].fingerprint == got[2].fingerprint != got[3].fingerprint  # null, empty, blank


def plain_digests(text):
    """What content_digests tells apart, by plain loops."""
    if len(text) < sketches.SHORT:
        words = re.split(r"[ \t\n\x0b\f\r]+", text)
        found = set(words)
        if len(words) < sketches.FEW_WORDS:
            line = re.sub(r"[ \t\n\x0b\f\r]+", " ", text).strip(" ")
            found |= {("gram", line[i : i + sketches.GRAM]) for i in range(len(line) - sketches.GRAM + 1)}
        return found - {""}
    parts, part = [], ""
    for i, c in enumerate(text):
        if c in "\n\t\r\x0b\f" + sketches.STOPS or (c == " " and i and text[i - 1] in sketches.MARKS):
            parts.append(part)
            part = ""
        else:
            part += c
    parts.append(part)
    if any(len(p) > sketches.MOST for p in parts):
        parts = [p[i : i + sketches.MOST] for p in parts for i in range(0, len(p), sketches.MOST)]
    return {p.strip(" ") for p in parts} - {""}


def test_query_like_brute_force(spark, docs, tmp_path):
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz7"), rng.integers(1, 9)))
    line = lambda n: " ".join(word() for _ in range(n))
    made = ["\n".join(line(int(rng.integers(0, 90))) for _ in range(int(rng.integers(1, 14)))) for _ in range(60)]
    made += [line(int(n)) for n in rng.integers(1, 60, 20)] + ["字" * 700, "漢字。" * 200, "x" * 5000, made[3], made[3], made[5] + " more", "\t".join(made[:3])]
    rows = list(enumerate([*AWKWARD, *made]))
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op4_fingerprints(spark, str(tmp_path)).collect()}
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for k, (key, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        r = got[key]
        assert (r.n_chars, r.edited_sha256, r.recovered) == (len(text), hashlib.sha256(edited.encode()).hexdigest(), True)
        assert r.near_edited == pytest.approx(like(plain_digests(text), plain_digests(edited))), (text[:900], edited[:900])
        assert r.near_next == pytest.approx(like(plain_digests(text), plain_digests(after)))
        assert (r.fingerprint == r.edited_fingerprint) == (plain_digests(text) == plain_digests(edited))
    twins = [k for k, t in rows if t == made[3]]
    assert len({got[k].fingerprint for k in twins}) == 1


def test_a_group_that_no_size_recovers_is_counted(spark):
    from pyspark.sql import functions as F

    a, b = list(range(0, 90)), list(range(30, 100))
    mixed = lambda xs: F.transform(F.array(*map(F.lit, xs)), lambda x: F.xxhash64(x))
    items = F.concat(sketches.signed(mixed(a), 1), sketches.signed(mixed(b), -1))
    row = spark.range(1).select(sketches.recovered(items, 8, 8).alias("r"), sketches.counted(items).alias("c")).first()
    assert not row.r.ok and tuple(row.c) == (False, 30, 10)


def test_settings_stay(spark, docs):
    before = dict(spark.conf.getAll)
    sketches.fingerprinted(docs([(1, "a b"), (2, "c")]), cut=sketches.content_digests).collect()
    assert dict(spark.conf.getAll) == before


def test_one_shuffle_of_texts(spark, docs):
    plan = sketches.fingerprinted(docs([(i, "a b") for i in range(9)]), cut=sketches.content_digests)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("Union")[0] and plan.split("Union")[0].count("Exchange") == 1
