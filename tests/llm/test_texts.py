"""Operators 3, 6, 7, 9 and the pipeline."""

import gzip
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from maillage.llm import chat, licenses, toxicity, warc
from tests.llm.conftest import AWKWARD, awkward_rows

SMALL = toxicity.Setting(buckets=1 << 12, positives=150, negatives=250)


def labelled(n=400, seed=1):
    rng = np.random.default_rng(seed)
    plain = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("an", "or", "il", "ut")]
    bad = [f"grum{x}" for x in "abcdefghij"]
    rows = []
    for i in range(n):
        words = [str(w) for w in rng.choice(plain, rng.integers(5, 60))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            words.insert(int(rng.integers(0, len(words))), str(rng.choice(bad[:7] if i % 2 else bad)))
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = labelled()
    y = np.array([t for _, _, t in rows])
    return toxicity.fit(pa.array([t for _, t, _ in rows]), y, np.ones(len(y)), ["en"] * len(y), SMALL)


def test_classifier_learns_stems(model):
    rows = labelled(300, 2)
    score = toxicity.score_texts(model, pa.array([t for _, t, _ in rows]))
    truth = np.array([t for _, _, t in rows])
    assert ((score >= 0.3) == truth).mean() > 0.95
    assert model.thresholds.keys() <= {"en"}
    one_by_one = np.concatenate([toxicity.score_texts(model, pa.array([t])) for _, t, _ in rows[:40]])
    assert np.allclose(one_by_one, score[:40], atol=1e-5)


def test_scores_of_awkward_rows(docs, model):
    found = toxicity.scored(docs([*awkward_rows(), (7, "grumz " + "plain " * 5000)]), model)
    got = found.select("doc_id", "text", "key", "score", toxicity.flagged(found, model).alias("bad")).collect()
    assert len(got) == len(awkward_rows()) + 1 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.text in (None, "", " \n\t")}) == 1
    assert all(r.bad == (r.score >= model.thresholds.get("en", 0.3)) for r in got)
    assert toxicity.scored(docs([]), model).count() == 0


def test_training_leaves_the_held_out_rows_alone(docs, frame):
    rows = labelled(200)
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    lies = frame("doc_id long, quality int, toxic int", *((i, 0, 1 - t if out(i) else t) for i, _, t in rows), (None, 0, 1), (3, 0, None), (9999, 0, 1))
    truth = frame("doc_id long, quality int, toxic int", *((i, 0, t) for i, _, t in rows))
    table = docs([(i, t) for i, t, _ in rows])
    a, b = toxicity.train(table, lies, SMALL), toxicity.train(table, truth, SMALL)
    assert np.array_equal(a.out, b.out)
    assert [r[0] for r in table.select(toxicity.held_out()).collect()] == [out(i) for i, _, _ in rows]
    assert toxicity.train(docs([]), truth.limit(0), SMALL).shift == -40


QUOTES = [
    (1, 0, "user", "Shall we ship it?\nTests are  GREEN."),
    (1, 1, "user", "No.\nWait for review."),
    (1, 2, "assistant", "On Monday, Ann wrote:\n> tests are green.\nThen yes."),
    (1, 3, "user", "> On Monday, Ann wrote:\n> > Tests are green.\n> Then yes.\nFine."),
    (1, 4, "user", "> No. Wait for review.\nWhy?"),
    (1, 5, "user", "> never said\nHm"),
    (2, 0, "user", "Tests are green."),
    (2, 1, "user", "> Tests are green.\n"),
    (2, 1, "user", "twin turn"),
    (3, 0, "user", None),
    (None, 0, "user", "> Tests are green."),
    (4, None, None, "> x"),
]


def test_quotations(frame):
    table = frame("conv_id long, turn long, role string, text string, depth int, lines string", *((*r, 9, "clash") for r in QUOTES))
    got = {(r.conv_id, r.turn, r.text): r for r in chat.conversations(table).collect()}
    assert len(got) == len(QUOTES)
    at = lambda c, t, x: tuple(got[c, t, x][k] for k in ("parent_turn", "thread_turn", "depth"))
    assert at(1, 0, "Shall we ship it?\nTests are  GREEN.") == (None, 0, 0)
    assert at(1, 1, "No.\nWait for review.") == (None, 1, 0)
    assert at(1, 2, "Then yes.") == (0, 0, 1)
    assert at(1, 3, "Fine.") == (2, 0, 2) and got[1, 3, "Fine."].n_quoted == 3
    assert at(1, 4, "Why?") == (1, 1, 1)
    assert at(1, 5, "Hm") == (None, 5, 0) and got[1, 5, "Hm"].n_linked == 0
    assert at(2, 1, "") == (0, 0, 1) == at(2, 1, "twin turn")
    assert at(3, 0, "") == (None, 0, 0) and at(None, 0, "") == (None, 0, 0) and at(4, None, "") == (None, None, 0)
    assert chat.conversations(table.limit(0)).count() == 0


@pytest.mark.parametrize("block", [3, 1000])
def test_quotes_go_to_the_latest_earlier_message(frame, block):
    rng = np.random.default_rng(5)
    rows, want, last = [], {}, {}
    for turn in range(60):
        said = f"line {rng.integers(0, 4)}"
        if turn and rng.random() < 0.5:
            asked = f"line {rng.integers(0, 4)}"
            want[turn] = last.get(asked)
            rows.append((1, turn, "u", f"> {asked}\n{said}"))
        else:
            rows.append((1, turn, "u", said))
        last[said] = turn
    links = chat.linked(frame("conv_id long, turn long, role string, text string", *rows), block_turns=block).where("not whole")
    assert {r.turn: r.source for r in links.collect()} == want


LINES = {
    "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "// Licensed under the Apache License, Version 2.0": "Apache-2.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA",
    "the licence of a driver and the version of a story": None,
    "under the public bridge with general license to walk": None,
    "plain prose about nothing": None,
}


def test_licences(docs):
    rows = [(100 + i, f"first line\n\n{x}\nlast words") for i, x in enumerate(LINES)]
    plain = [(1000 + i, f"some words here {i}\nand the others under that {i}") for i in range(40)]
    table = docs([*rows, *plain, *awkward_rows()])
    got = licenses.scanned(table, licenses.train(table)).collect()
    assert len(got) == len(rows) + len(plain) + len(awkward_rows())
    by_id = {r.doc_id: r for r in got}
    for (key, _), family in zip(rows, LINES.values(), strict=True):
        assert [(f.paragraph, f.family) for f in by_id[key].found] == ([(2, family)] if family else [])
        assert by_id[key].n_paragraphs == 3
    assert all(not r.found for r in got if r.doc_id is None or r.doc_id < 100 or r.doc_id >= 1000)
    assert by_id[0].n_paragraphs == 0
    assert licenses.scanned(docs([]), licenses.fit([])).count() == 0


PAGES = [
    (3, "http://www.Example.com/a#x", "x" * 200), (1, "https://example.com/b?q=1", "x" * 200), (2, None, "x" * 200), (4, "http://example.com:8080/c\nd", "short"), (5, "http://b.example.org", "short"),
    (6, "not a url", None), (7, "http://[broken", "é" * 50), (8, "http://x.net/" + "p" * 3000, "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (8, "http://x.net/twin", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (None, "http://null.net", "y" * 99999), (9, "http://null.net", "y" * 99999),
]


def test_archives(frame, tmp_path):
    table = frame("page_id long, url string, html string, digest string, length int", *((*p, "clash", 1) for p in PAGES))
    captures = warc.written(table, root=f"file://{tmp_path}/w", archive_bytes=1000)
    blocks, directory = warc.indexed(captures, block_lines=3)
    opened = warc.opened(blocks)
    got = {(r.page_id, r.target): r for r in warc.records(opened).collect()}
    assert len(got) == len(PAGES) and blocks.count() == directory.count() >= 4
    for page_id, url, html in PAGES:
        payload = (html or "").encode()
        r = got[page_id, (url or "").replace("\n", "%0A")]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        first = {"x" * 200: 1, "y" * 99999: None}.get(html, page_id)
        assert (r.record_type, r.refers_to) == (("response", None) if first == page_id else ("revisit", first))
        assert r.payload == (payload if first == page_id else None)
    for file in (tmp_path / "w").glob("*.warc.gz"):
        assert gzip.decompress(file.read_bytes()).startswith(b"WARC/1.1\r\n")
    keys = [r.host_key for r in blocks.orderBy("first_key").select(F.col("first_key").alias("host_key")).collect()]
    assert keys == sorted(keys)
    found = warc.looked_up(blocks, directory, frame("url string", ("http://example.com/a",), ("http://null.net/",), ("http://nowhere.org/",), ("https://www.example.com/b?q=1",)))
    assert sorted((r.host_key, r.page_id) for r in found.where("page_id is not null").collect()) == [("com,example)/a", 3), ("com,example)/b?q=1", 1), ("net,null)/", 9)]
    none = warc.written(table.limit(0), root=f"file://{tmp_path}/none")
    assert warc.records(warc.opened(warc.indexed(none)[0])).count() == 0


def test_host_keys_sort_by_reversed_host():
    assert warc.host_key("HTTPS://WWW.News.Example.ORG:443/x?y#z") == "org,example,news)/x?y"
    assert warc.host_key("http://www.com/") == "com,www)/" and warc.host_key(None) == ")/" and warc.host_key("http://a.b:81") == "b,a:81)/"


def test_pipeline_stages(spark, docs, frame, tmp_path):
    import corpus_pipeline as p
    from maillage.llm import simhash, substrings

    rows = [(i, f"{t}\nmore {i} of {i * 7} and {i * 13} in {i * 17}") for i, t, _ in labelled(600)]
    passage = " ".join(f"q{i}" for i in range(60))
    extra = [(1000, "head words " + passage), (1001, passage + " tail of another kind"), (1002, rows[0][1]), (1003, rows[0][1]), *((2000 + i, t) for i, t in enumerate(AWKWARD)), (None, "no id at all"), (None, "no id at all")]
    documents = docs([*rows, *extra]).select("doc_id", "text", "lang", "source", "n_chars")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    frame("doc_id long, quality int, toxic int", *((i, 0, t) for i, _, t in labelled(600))).write.parquet(f"{tmp_path}/labels.parquet")
    at = str(tmp_path)
    stages = dict(p.STAGES)
    assert list(stages) == ["toxicity", "simhash near-dedup", "substring dedup", "best-fit packing"]
    clean = stages["toxicity"](spark, documents, at)
    truth = {i: t for i, _, t in labelled(600)}
    kept = {r.doc_id for r in clean.collect()}
    assert np.mean([(i in kept) == (t == 0) for i, t in truth.items()]) > 0.95
    assert clean.columns == documents.columns
    once = stages["simhash near-dedup"](spark, documents, at)
    got = sorted((r.doc_id for r in once.collect()), key=repr)
    groups = simhash.grouped(simhash.fingerprints(documents.where("doc_id is not null"))).where("doc_id = component_id")
    assert got == sorted([*(r.doc_id for r in groups.collect()), None], key=repr)
    thin = {r.doc_id: r for r in stages["substring dedup"](spark, documents, at).collect()}
    want = {r.doc_id: r for r in substrings.thinned(documents).collect()}
    assert thin[1001].text == "tail of another kind" and thin[1000].text == "head words " + passage
    assert all(thin[k].text == v.kept for k, v in want.items() if v.n_removed)
    # 1001 is a near copy of 1000; what its stage takes out doesn't come back.
    left = {r.doc_id for r in stages["simhash near-dedup"](spark, clean, at).collect()}
    assert {r.doc_id for r in p.run(spark, at).select("doc_id").distinct().collect()} == left and {1000, 1001} & left == {1000}
