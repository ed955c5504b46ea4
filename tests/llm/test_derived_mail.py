"""op6 over messages that quote each other, op9 through its directory, op10 in many blocks."""

from maillage.llm import chat, queries, topk, warc

SF = "/root/testdata/sf0.01"


def test_every_reply_finds_its_message(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    said = {(r.conv_id, r.turn): r.text or "" for r in rows}
    got = queries.op6_quotations(spark, SF).collect()
    assert len(got) == len(rows) and sum(r.n_quoted > 0 for r in got) > 300
    for r in got:
        before = said.get((r.conv_id, r.turn - 1))
        assert r.parent_turn == (r.turn - 1 if before is not None and before.strip() else None), r
        assert r.text.removesuffix("Thanks in advance.").strip() == said[r.conv_id, r.turn].strip()
        assert r.parent_turn is None or (r.thread_turn <= r.parent_turn and r.depth >= 1)


def test_long_passages(frame):
    lines = "\n".join(f"{'>' * (1 + i % 2)} line {i}" for i in range(3000)) + "\n" + "\n".join(f"> tail {i}" for i in range(3000))
    rows = [(1, 0, "u", "\n".join(f"tail {i}" for i in range(3000))), (1, 1, "u", lines)]
    got = {r.turn: r for r in chat.conversations(frame("conv_id long, turn long, role string, text string", *rows)).collect()}
    assert got[1].parent_turn == 0 and got[1].n_quoted == 6000 and got[1].n_linked == 3000


def test_only_blocks_of_the_directory_are_opened(spark, frame, tmp_path, monkeypatch):
    asked = []
    real = warc.looked_up
    monkeypatch.setattr(warc, "looked_up", lambda *a: asked.append(a) or real(*a))
    pages = [(i, f"http://h{i % 7}.org/{i % 40}", f"<p>{i % 30}</p>" * 30) for i in range(200)] + [(500, None, None), (501, "http://h1.org/1", "x")]
    frame("page_id long, url string, html string", *pages).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r for r in queries.op9_warc(spark, str(tmp_path)).collect()}
    assert len(asked) == 1 and sorted(got) == sorted(p[0] for p in pages)
    for page_id, _, html in pages:
        first = min(p[0] for p in pages if p[2] == html)
        again = len((html or "").encode()) >= 100 and page_id != first
        assert (got[page_id].record_type, got[page_id].refers_to) == (("revisit", first) if again else ("response", None))


def test_blocks_are_bounded_by_the_first(spark, frame, monkeypatch):
    import numpy as np

    monkeypatch.setattr(topk, "BLOCK_CODES", 20)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=64)]) for i in range(300)]
    found = topk.codes(frame("vec_id long, embedding array<double>", *rows))
    got = topk.nearest(found, found.where("vec_id % 20 = 0"), 5).collect()
    bits = np.array([[x > 0 for x in v] for _, v in rows])
    for q in range(0, 300, 20):
        near = sorted((int((bits[q] != bits[i]).sum()), i) for i in range(300) if i != q)[:5]
        assert sorted((r["rank"], r.distance, r.vec_id) for r in got if r.query_id == q) == [(k + 1, d, i) for k, (d, i) in enumerate(near)]


def test_a_bound_only_leaves_out_what_is_farther():
    import numpy as np

    rng = np.random.default_rng(4)
    codes = np.unique(rng.integers(-(2**63), 2**63 - 1, 500))
    query = rng.integers(-(2**63), 2**63 - 1, 20)
    block, ones = topk.Block(codes), np.ones(len(codes), dtype=np.int64)
    free = block.search(query, 3, ones)
    bounded = block.search(query, 3, ones, np.full(20, 22))
    want = {(q, c, d) for q, c, d in zip(*map(np.ndarray.tolist, free), strict=True) if d <= 22}
    assert want <= set(zip(*map(np.ndarray.tolist, bounded), strict=True)) and all(d <= 22 for d in bounded[2])
