"""Agenda encoder of merge-type vocabularies: the library's ids, a plain scan for the best pair, awkward rows."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from vaultspark.llm import piece_agenda
from vaultspark.llm.common import table
from vaultspark.llm.queries import op13_piece_agenda

SMALL = "/root/testdata/sf0.001"
ALPHABET = "abcdefghtin xyz \n\t▁é漢字🙂\x00<>0x."


@pytest.fixture(scope="module")
def agenda():
    return piece_agenda.Agenda(piece_agenda.model_path())


def plain(agenda, text):
    """The rule written down without any agenda: look for the best pair again after every join."""
    if not text:
        return [agenda.end]
    symbols = list(agenda.prefix + text.replace(" ", piece_agenda.SPACE_MARK))
    while True:
        best = [(agenda.place[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in agenda.place]
        if not best:
            break
        i = min(best)[1]
        symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
    out = []
    for s in symbols:
        out += [agenda.ids[s]] if s in agenda.ids else [agenda.bytes[b] for b in s.encode()]
    return [*out, agenda.end]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=60) | st.text(max_size=30))
def test_agenda_equals_the_plain_scan_and_the_library(text):
    a = piece_agenda.opened(piece_agenda.model_path())
    text = text.encode("utf-8", "replace").decode()
    got = a.encode(text)
    assert got == plain(a, text) == a.library.encode(text, add_eos=True)


def test_long_runs_and_repeats(agenda):
    rng = random.Random(3)
    texts = ["x" * 70_001, " " * 5001, "\n" * 3000, "the" * 4000, "漢字" * 3000, "a b" * 9000,
             "".join(rng.choice(ALPHABET.replace(" ", "")) for _ in range(50_000))]
    assert [agenda.encode(t) for t in texts] == agenda.library.encode(texts, add_eos=True)


def test_rows_of_agendas_equal_the_heap(agenda):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghtinrs▁.é漢\n") for _ in range(rng.randint(1, 32))) for _ in range(20_000)]
    for w, ids in zip(words, agenda.join_rows(words)):
        if ids is not None:
            assert ids == agenda.long_word(w)
    assert agenda.join_rows(["the", "🙂x"])[1] is None or "🙂" in agenda.ids


def test_keys_between_spaces_stand_for_the_words_of_the_text(agenda):
    rng = random.Random(5)
    signs = [*"ab the  \n\n\t\r\x0b▁é中🙂.,xyz", " ", "e", "th"]
    whole = ["", " ", "  a", "a \nb", "\na", "a\n", "a▁ b", "▁", "x" * 200 + " y\n" + "z" * 70]
    whole += ["".join(rng.choice(signs) for _ in range(rng.randrange(90))) for _ in range(3000)]
    assert [i.tolist() for i in agenda.encode_all(whole)] == agenda.library.encode(whole, add_eos=True)
    for t in whole:
        assert [w for k in agenda.cut(t) for w in agenda.words_of(k)] == (agenda.words.findall("▁" + t.replace(" ", "▁")) if t else [])
    assert agenda.cut("one two\nthree") == ["one", "two", "\nthree"]  # found without a search for words


def test_words_between_single_spaces_are_learned_without_a_search():
    class NoSearch:
        def findall(self, text):
            raise AssertionError(text)

    a = piece_agenda.Agenda(piece_agenda.model_path())
    a.words = NoSearch()
    for text in ("one two\nthree", "a\n\nb\tcd", "x" * 70 + " y", "na\u00efve \U0001f642 \u4e2d\u6587"):
        assert a.encode(text) == a.library.encode(text, add_eos=True)


def test_pairs_of_crowded_slots_are_found(agenda):
    n = agenda.unknown + 1
    assert agenda.crowded.any()
    keys = np.concatenate((agenda.join_keys, agenda.join_keys + 1, np.random.default_rng(3).integers(0, n * n, 200_000)))
    place, joined = agenda.seats(keys // n, (keys % n).astype(np.int32))
    pairs = dict(zip(agenda.join_keys.tolist(), zip(agenda.join_places.tolist(), agenda.join_symbols.tolist())))
    want = [pairs.get(k, (piece_agenda.NONE, None)) for k in keys.tolist()]
    assert place.tolist() == [p for p, _ in want]
    assert all(j == w for j, (_, w) in zip(joined.tolist(), want) if w is not None)


def test_tables_of_words_stay_bounded(monkeypatch):
    monkeypatch.setattr(piece_agenda, "WORDS", 50)
    a = piece_agenda.Agenda(piece_agenda.model_path())
    text = " ".join(f"w{i}ord" for i in range(500)) * 2
    assert a.encode(text) == a.library.encode(text, add_eos=True)
    assert a.encode("only few") == a.library.encode("only few", add_eos=True)
    assert len(a.known) <= 50


def test_vocabulary_with_joins_over_spaces_is_not_cut_there(agenda):
    a = piece_agenda.Agenda(piece_agenda.model_path())
    a.ids["b▁"], a.place["b▁"] = 7, -1
    a.pairs, a.words = a.pairs | {"b▁"}, None
    a._number_symbols()
    assert a.encode("ab cd") == plain(a, "ab cd") != agenda.encode("ab cd")


def test_query_against_the_library(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=piece_agenda.model_path())
    got = {r.doc_id: r for r in op13_piece_agenda(spark, SMALL).collect()}
    docs = {r.doc_id: r.text or "" for r in table(spark, SMALL, "documents").collect()}
    assert set(got) == set(docs) and all(r.agrees for r in got.values())
    for i, text in docs.items():
        ids = lib.encode(text, add_eos=True)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_awkward_rows_and_decode(spark):
    rows = [(1, "a  b", "x"), (1, "a  b", "y"), (2, None, None), (3, "", ""), (None, "\x00 <s> </s>", "z"), (4, "long " * 50_000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = piece_agenda.encode(docs)
    assert sorted((str(r.doc_id), r.decoded) for r in got.collect()) == sorted((str(i), t or "") for i, t, _ in rows)
    assert {r.text for r in piece_agenda.decode(got).collect()} == {t or "" for _, t, _ in rows}
    assert piece_agenda.encode(docs.limit(0)).collect() == []
    none = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.text for r in piece_agenda.decode(none).collect()] == [None, ""]
    assert [r.agrees for r in piece_agenda.encode(docs, check=False).collect()] == [None] * len(rows)


def test_other_kinds_of_vocabularies_are_refused(tmp_path):
    with open(piece_agenda.model_path(), "rb") as f:
        raw = f.read()
    merges = b"\x18\x02\x20\x80\xfa\x01"  # kind 2 (merges), then the size 32000
    assert raw.count(merges) == 1
    path = tmp_path / "other.model"
    path.write_bytes(raw.replace(merges, b"\x18\x01" + merges[2:]))
    with pytest.raises(ValueError):
        piece_agenda.Agenda(str(path))
