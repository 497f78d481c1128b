"""Sharding, packing, archives, HTML blocks and transcripts: round trips and brute force."""

import collections
import hashlib
import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vaultspark.llm import chat_hmm, html_blocks, packing, sharding, warc
from vaultspark.llm.common import table
from vaultspark.llm.queries import raw_transcripts

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SMALL, "documents").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


# -- sharding ----------------------------------------------------------------

@pytest.mark.parametrize("shards", [1, 5, 16])
def test_shards_hold_groups_and_balance(spark, docs, rows, shards):
    got = sharding.shard_documents(spark, docs, shards=shards).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    of, load, slots = {}, collections.Counter(), collections.defaultdict(list)
    for r in got:
        raw = rows[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        assert of.setdefault(raw, r.shard) == r.shard
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = collections.Counter()
    for t in rows.values():
        groups[t] += len(t.encode()) + 1
    mean = sum(groups.values()) / shards
    # the rule's bound: an even share plus the largest group
    assert max(load.values()) <= mean + max(groups.values())


def test_write_shards_round_trip(spark, docs, tmp_path):
    path = str(tmp_path / "out")
    sharding.write_shards(spark, docs, path, shards=4)
    back = spark.read.parquet(path).select(*docs.columns)
    assert back.exceptAll(docs).count() == 0 and docs.exceptAll(back).count() == 0


# -- packing -----------------------------------------------------------------

@pytest.mark.parametrize("window", [64, 1024])
def test_packing_round_trip(spark, docs, rows, window):
    coder = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    got = packing.pack(spark, docs, window=window).collect()
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        ids = packing.unpack_ids(bytes(r.ids))
        assert len(ids) == r.length and zlib.crc32(ids.astype("<u4").tobytes()) == r.ids_crc32
        by_doc[r.doc_id].append((r.start, r.doc_tokens, ids.tolist()))
        by_seq[r.sequence_id].append((r.offset, r.length))
    for i, text in rows.items():
        want = [*coder.encode(text, add_special_tokens=False).ids, 0]
        parts = sorted(by_doc[i])
        assert list(itertools.chain.from_iterable(p[2] for p in parts)) == want
        assert {p[1] for p in parts} == {len(want)}
        assert [p[0] for p in parts] == [0, *np.cumsum([len(p[2]) for p in parts])[:-1].tolist()]
    total = sum(r.length for r in got)
    assert len(by_seq) == -(-total // window)  # all sequences but the last are full
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window


def test_combinations_never_overuse_a_length():
    rng = np.random.default_rng(3)
    for _ in range(20):
        h = rng.integers(0, 50, 64)
        h[0] = 0
        combos, repeats = packing.solve(h, 64)
        used = np.bincount(combos.ravel(), weights=np.repeat(repeats, 3), minlength=64)
        used[0] = 0
        assert (combos.sum(axis=1) == 64).all() and (used <= h).all()


# -- archives ----------------------------------------------------------------

def test_archives_round_trip(spark, tmp_path):
    big, other = "<p>" + "é" * 600 + "</p>", "x" * 1000
    pages = [(1, "http://a/1", big), (2, "http://a/2", big), (5, None, big), (3, "http://a/3", "short"), (4, "http://a/4", "short"),
             (6, "http://a/ 6", None), (7, "http://a/7", ""), (8, "http://a/8", other), (8, "http://a/8", other), (None, "http://a/9", other)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = warc.archive(spark, df, root=str(tmp_path / "w")).collect()
    assert len(got) == len(pages)
    size = collections.Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got)
    assert size == collections.Counter((i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h in pages)
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in got}
    assert kinds == {(1, "revisit", 5), (2, "revisit", 5), (5, "response", None), (3, "response", None), (4, "response", None),
                     (6, "response", None), (7, "response", None), (8, "response", None), (None, "revisit", 8)}


def test_archived_payloads_are_whole(spark, tmp_path):
    pages = table(spark, SMALL, "pages")
    written = warc.write_archives(spark, pages, str(tmp_path / "w"))
    back = {r.page_id: bytes(r.payload) for r in warc.read_archives(spark, written, payload=True).collect() if r.record_type == "response"}
    text = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    assert back and all(text[i] == p for i, p in back.items())


# -- HTML blocks -------------------------------------------------------------

PAGE = """<html><head><title>t</title><style>p {{}}</style><script>var a = "<p>no</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a></li><li><a href="/x">About us</a></li></ul></nav>
<div class="content"><article><h1>The heading of page {n}</h1>
<p>First &amp; long paragraph of the article number {n}, with   enough words &#233; to be prose that a reader reads.</p>
<p>Second paragraph of the article number {n}, which has some more words in it, and a comma, and an end.</p></article></div>
<aside class="sidebar"><a href="/1">Related story one</a> <a href="/2">Related story two</a></aside>
<footer>Copyright 2020 All rights reserved <a href="/p">Privacy</a></footer></body></html>"""


def test_main_text_of_plain_pages(spark):
    made = [(n, f"http://h/{n}", PAGE.format(n=n)) for n in range(30)] + [(100, "u", None), (101, "u", ""), (None, None, "<p>")]
    df = spark.createDataFrame(made, "page_id long, url string, html string")
    got = {r.page_id: r for r in html_blocks.extract(spark, df).collect()}
    assert len(got) == len(made)
    for n in range(30):
        text = got[n].text
        assert f"First & long paragraph of the article number {n}, with enough words é to be prose" in text
        assert f"Second paragraph of the article number {n}" in text
        assert not any(w in text for w in ("About us", "Related story", "Copyright", "var a", "p {}"))
        assert got[n].n_chars == len(text)
    assert got[100].text == got[101].text == "" and got[101].n_chars == 0


@pytest.mark.parametrize("page", [
    PAGE.replace("</article>", "".join(f"<p>Paragraph {k} of a very long article, whose page is larger than most others are.</p>" for k in range(600)) + "</article>"),
    "<html><body><ul><li><a href='/a'>About us</a></li><li><a href='/b'>Our shops</a></li></ul><table><tr><td>"
    + "First & long paragraph of the article number {n}, with enough words é to be prose.</td></tr></table></body></html>",
])
def test_labeller_learns_from_long_pages_and_from_pages_without_labels(spark, page):
    made = [(n, f"http://h/{n}", page.replace("{n}", str(n))) for n in range(12)]
    df = spark.createDataFrame(made, "page_id long, url string, html string")
    pages = html_blocks.sample(spark, df)
    assert sorted(pages) == sorted(h for _, _, h in made)
    assert html_blocks.train(pages, epochs=1, made=40) is not None
    short = html_blocks.sample(spark, df, most=2 * len(made[0][2]) + 10, longest=1 << 20)
    assert len(short) == 2 and set(short) <= set(pages)
    if "<article" in page:
        got = html_blocks.extract(spark, df).collect()
        assert len(got) == 12
        for r in got:
            assert "Paragraph 599 of a very long article" in r.text and not any(w in r.text for w in ("About us", "Related story", "Copyright"))


# -- transcripts -------------------------------------------------------------

def test_transcripts_do_not_depend_on_the_chunk(spark):
    src = raw_transcripts(spark, SMALL).cache()
    cols = ["conv_id", "turn", "role", "text", "n_lines", "rendered"]
    whole = sorted(chat_hmm.parse_transcripts(spark, src).select(*cols).collect(), key=str)
    assert whole and sorted(chat_hmm.parse_transcripts(spark, src, chunk=2).select(*cols).collect(), key=str) == whole


@pytest.mark.parametrize("seq, conv", [(None, 1), (3, 1), (5, None)])
def test_chunks_are_bounded_whatever_the_orders(spark, monkeypatch, seq, conv):
    """Null or tied orders, and rows without a conversation: no task gets more rows of a chunk than its size."""
    rows = [(conv, seq, f"User: question {k:04d}\nAI: answer {k}") for k in range(700)] + [(conv, seq, "User: same\nAI: yes")] * 300 + [(2, 0, "User: a")]
    df = spark.createDataFrame(rows, "conv_id long, seq long, text string")
    cols = ["conv_id", "turn", "role", "text", "n_lines", "rendered"]
    whole = sorted(chat_hmm.parse_transcripts(spark, df, chunk=1 << 20).select(*cols).collect(), key=str)
    seen, real = [], chat_hmm.stored

    def spy(session, frame, name):
        out = real(session, frame, name)
        if name == "numbered-rows":
            seen.extend(r["count"] for r in out.groupBy("conv_id", "chunk").count().collect())
        return out

    monkeypatch.setattr(chat_hmm, "stored", spy)
    assert sorted(chat_hmm.parse_transcripts(spark, df, chunk=64).select(*cols).collect(), key=str) == whole
    assert len(whole) == 2001 and sum(seen) == 1000 and max(seen) <= 64


def test_roles_of_marked_turns(spark):
    convs = table(spark, SMALL, "conversations")
    want = collections.defaultdict(list)
    for r in convs.orderBy("conv_id", "turn").collect():
        want[r.conv_id].append(r.role)
    got = collections.defaultdict(list)
    for r in chat_hmm.parse_transcripts(spark, raw_transcripts(spark, SMALL)).orderBy("conv_id", "turn").collect():
        got[r.conv_id].append(r.role)
        assert [r.turn] == [len(got[r.conv_id]) - 1]
    right = sum(want[i] == got[i] for i in want)
    assert right >= 0.8 * len(want)  # one turn in ten has lost its marker


def test_viterbi_equals_enumeration():
    lines = ["User: hi there", "", "more text", "AI: yes", "```", "Q: what", "and so on"]
    e, _ = chat_hmm.emissions(lines, False)
    e = e[:5]
    path = chat_hmm.viterbi(e, chat_hmm.START)

    def total(s):
        return chat_hmm.START[s[0]] + sum(chat_hmm.MOVE[a, b] for a, b in zip(s, s[1:])) + sum(e[k, x] for k, x in enumerate(s))

    best = max(itertools.product(range(chat_hmm.N_STATES), repeat=len(e)), key=total)
    assert total(path.tolist()) == pytest.approx(total(best))
    assert chat_hmm.transfer(e)[-1].max() == pytest.approx(total(best))  # the last row starts a conversation
