"""SentencePiece encoding of merge-type vocabularies by a score-ordered agenda.

A text is a row of symbols, at first its characters.  The agenda holds the
adjacent symbol pairs whose join is a piece, the highest score first and the
leftmost first among equal scores.  The best pair is joined, the pairs it forms
with its neighbours enter the agenda, and outdated entries leave it.  A symbol
left over that is no piece becomes byte pieces.

Texts are cut where no join can ever happen, which changes no result: between two
characters that follow each other in no piece of the vocabulary.  For the usual
vocabularies that holds before every space after a word, so a text falls into
words, whose answers are remembered (a bounded table per worker, looked up by what lies
between two spaces).  The new short words of an Arrow batch share a table of agendas, one row for each, and a round pops
the best entry of every row; longer runs have a heap of their own.

Every Arrow batch is encoded a second time by the sentencepiece library; the
column ``agrees`` says whether both give the same ids.  The ids returned are the
agenda's in any case.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vaultspark.llm.common import distinct_names, small_batches, texts

MODEL = "piece_bpe_32k.model"
SPACE_MARK = "▁"
#: Entries of a worker's table of words, and the longest word kept in it and in a table of agendas.
WORDS, WORD_CHARS = 500_000, 64
NONE = np.iinfo(np.int32).max
#: Slots (as a power of two) of the hashed table of pairs that join.
SLOT_BITS = 20
BATCH_BYTES = 4 << 20
MERGES, NORMAL, CONTROL = 2, 1, 3


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _fields(blob: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value) of a protobuf message; fixed-width values as bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = blob[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(blob):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 2: -1, 5: 4}[kind]
            if size < 0:
                size = number()
            yield tag >> 3, blob[at:at + size]
            at += size


class Agenda:
    """Encoder of one model file.  Only what it can follow exactly is accepted: merge-type
    vocabularies without user-defined or unused pieces, the identity normaliser, byte fallback."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        with open(model_file, "rb") as f:
            message = list(_fields(f.read()))
        trainer = dict(_fields(next(v for k, v in message if k == 2)))
        rules = dict(_fields(next(v for k, v in message if k == 3)))
        if trainer.get(3, 1) != MERGES:
            raise ValueError(f"{model_file}: not a merge-type vocabulary")
        if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1) or trainer.get(24, 0):
            raise ValueError(f"{model_file}: only the identity normaliser with marked spaces in front is supported")
        if not trainer.get(35, 0):
            raise ValueError(f"{model_file}: no byte pieces")
        self.prefix = SPACE_MARK if rules.get(3, 1) else ""
        lib = self.library
        self.ids, scores = {}, {}
        self.bytes = [0] * 256
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
            elif lib.is_unused(i):
                raise ValueError(f"{model_file}: unused pieces")
            elif not (lib.is_control(i) or lib.is_unknown(i)):
                self.ids[piece] = i
                scores[piece] = lib.get_score(i)
        if len(self.ids) != sum(dict(_fields(v)).get(3, NORMAL) == NORMAL for k, v in message if k == 1):
            raise ValueError(f"{model_file}: user-defined pieces")
        # the place of a piece in the order of scores; equal scores share a place
        place = {s: n for n, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.place = {p: place[s] for p, s in scores.items() if len(p) > 1}
        self.pairs = {p[k:k + 2] for p in self.place for k in range(len(p) - 1)}
        open_spaces = any(a != SPACE_MARK and b == SPACE_MARK for a, b in self.pairs)
        # white space that no piece joins to anything is a word of its own
        lone = self.lone = "".join(c for c in "\t\n\x0b\x0c\r" if not any(c in p for p in self.pairs))
        self.words = None if open_spaces else re.compile(
            f"{SPACE_MARK}*[^{SPACE_MARK}{lone}]+|{SPACE_MARK}+" + (f"|[{lone}]" if lone else ""))
        self.end = lib.eos_id()
        self.known: dict[str, bytes] = {}
        self._number_symbols()

    def _number_symbols(self) -> None:
        """Symbols of the tables of agendas: pieces and their characters; what two neighbours join to."""
        symbols = {s: n for n, s in enumerate(dict.fromkeys([*self.ids, *chain.from_iterable(self.place)]))}
        self.unknown = len(symbols)
        self.symbol_ids = np.array([*[self.ids.get(s, -1) for s in symbols], -1], dtype=np.int32)
        self.of_char = np.full(0x110000, self.unknown, dtype=np.int32)
        for s, n in symbols.items():
            if len(s) == 1:
                self.of_char[ord(s)] = n
        joins = sorted((symbols[p[:k]] * (self.unknown + 1) + symbols[p[k:]], place, symbols[p]) for p, place in self.place.items()
                       for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols)
        self.join_keys, self.join_places, self.join_symbols = (np.array(c, dtype=t) for c, t in zip(zip(*joins), (np.int64, np.int32, np.int32)))
        # the first pair of every slot; pairs of crowded slots are searched for among all
        slot = self.slots(self.join_keys)
        self.slot_pair = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
        self.slot_pair[slot[::-1]] = np.arange(len(slot) - 1, -1, -1, dtype=np.int32)
        self.crowded = np.bincount(slot, minlength=1 << SLOT_BITS) > 1

    @staticmethod
    def slots(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def seats(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, joined symbol) of pairs of neighbours; place ``NONE`` where they do not join."""
        key = left.astype(np.int64) * (self.unknown + 1) + right
        slot = self.slots(key)
        at = self.slot_pair[slot]
        many = np.nonzero(self.crowded[slot] & (self.join_keys[at] != key))
        at[many] = np.minimum(np.searchsorted(self.join_keys, key[many]), len(self.join_keys) - 1)
        return np.where(self.join_keys[at] == key, self.join_places[at], NONE), self.join_symbols[at]

    def join_rows(self, words: list[str]) -> list[bytes | None]:
        """The agendas of many short words at once: ids of each as 4-byte numbers, None where a character is no piece."""
        n, sizes = len(words), np.array(list(map(len, words)))
        width = int(sizes.max())
        symbol = np.full((n, width), self.unknown, dtype=np.int32)
        inside = np.arange(width) < sizes[:, None]
        symbol[inside] = self.of_char[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
        after = np.tile(np.arange(1, width + 1, dtype=np.int32), (n, 1))
        before = np.tile(np.arange(-1, width - 1, dtype=np.int32), (n, 1))
        place, joined = np.full((n, width), NONE, dtype=np.int32), np.zeros((n, width), dtype=np.int32)
        if width > 1:
            place[:, :-1], joined[:, :-1] = self.seats(symbol[:, :-1], symbol[:, 1:])
        rows = np.arange(n)
        while len(rows):
            left = place[rows].argmin(axis=1)  # the best entry of every agenda, the leftmost of equals
            open_ = place[rows, left] != NONE
            rows, left = rows[open_], left[open_]
            right, new = after[rows, left], joined[rows, left]
            end = after[rows, right]
            symbol[rows, left], after[rows, left] = new, end
            symbol[rows, right], place[rows, right] = -1, NONE
            place[rows, left] = NONE
            some = end < sizes[rows]
            r, e, l_ = rows[some], end[some], left[some]
            before[r, e] = l_
            place[r, l_], joined[r, l_] = self.seats(new[some], symbol[r, e])
            first = before[rows, left]
            some = first >= 0
            r, f = rows[some], first[some]
            place[r, f], joined[r, f] = self.seats(symbol[r, f], new[some])
        alive = inside & (symbol >= 0)
        ids = self.symbol_ids[symbol[alive]]
        known = np.logical_and.reduceat(ids >= 0, np.cumsum(alive.sum(axis=1)) - alive.sum(axis=1))
        raw, ends = ids.astype("<i4").tobytes(), (4 * np.cumsum(alive.sum(axis=1))).tolist()
        return [raw[a:b] if k else None for a, b, k in zip([0, *ends], ends, known.tolist())]

    def answers(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words, short ones in tables of agendas."""
        ordered = sorted(words, key=len)
        sizes = np.fromiter(map(len, ordered), dtype=np.int64, count=len(ordered))
        short = int(np.searchsorted(sizes, WORD_CHARS, side="right"))
        out = {w: self.long_word(w) for w in ordered[short:]}
        ends = np.searchsorted(sizes[:short], np.arange(8, WORD_CHARS + 8, 8), side="right").tolist()
        for start, end in zip([0, *ends], ends):  # words of about one length share a table
            for lo in range(start, end, 20_000):
                part = ordered[lo:min(lo + 20_000, end)]
                ids = self.join_rows(part)
                if None in ids:
                    ids = [self.long_word(w) if i is None else i for w, i in zip(part, ids)]
                out.update(zip(part, ids))
        return out

    def learn(self, keys: set[str]) -> dict[str, bytes]:
        """Ids of keys (see :meth:`cut`)."""
        apart = self.lone + " "
        single = [k for k in keys if k[0] not in apart]
        words = dict(zip(single, map(self.prefix.__add__, single)))  # a key without white space is one word
        several = {k: self.words_of(k) for k in keys if k[0] in apart}
        ids = self.answers({*words.values(), *chain.from_iterable(several.values())})
        new = {k: b"".join(map(ids.__getitem__, w)) for k, w in several.items()}
        new.update(zip(words, map(ids.__getitem__, words.values())))
        return new

    def cut(self, text: str) -> list[str]:
        """Keys of a text, in order.  Where its spaces are single and stand inside, they are what lies between
        them, cut again before lone white space; a text with other spaces, or with the mark of spaces, is cut into
        words, each behind a space."""
        if not text:
            return []
        if self.words is not None and self.prefix and SPACE_MARK not in text:
            spaced = text
            for c in self.lone:
                if c in text:
                    spaced = spaced.replace(c, " " + c)
            if "  " not in spaced and spaced[0] != " " and spaced[-1] != " ":
                return spaced.split(" ")
        marked = self.prefix + text.replace(" ", SPACE_MARK)
        return [f" {w}" for w in (self.words.findall(marked) if self.words else [marked])]

    def words_of(self, key: str) -> list[str]:
        """The words that a key of :meth:`cut` stands for."""
        if key[0] == " ":
            return [key[1:]]
        if key[0] in self.lone:
            return [key[0], key[1:]] if len(key) > 1 else [key]
        return [self.prefix + key]

    def long_word(self, word: str) -> bytes:
        return np.array([i for run in self.runs(word) for i in self.join(run)], dtype="<i4").tobytes()

    def join(self, run: str) -> list[int]:
        """The agenda over one run of characters."""
        n = len(run)
        place, ids = self.place, self.ids
        if n == 1 or run in ids and n == 2:
            one = ids.get(run)
            return [self.bytes[b] for b in run.encode()] if one is None else [one]
        seat = place.get
        # an entry: place of the joined piece, its first character, the character after it
        bits = 20 if n < 1 << 20 else 32
        low, two = (1 << bits) - 1, 2 * bits
        agenda = [p << two | i << bits | i + 2 for i in range(n - 1) if (p := seat(run[i:i + 2])) is not None]
        # symbol at i: run[i:end[i]], end 0 once joined to its left; start of the symbol before
        end, before = array("l", range(1, n + 2)), array("l", range(-1, n))
        if n < 1000:
            end, before = end.tolist(), before.tolist()
        heapq.heapify(agenda)
        pop, push = heapq.heappop, heapq.heappush
        while agenda:
            entry = pop(agenda)
            left, stop = entry >> bits & low, entry & low
            right = end[left]
            # outdated: the left symbol is gone, or it or its neighbour has grown since
            if right == 0 or right >= stop or end[right] != stop:
                continue
            end[left] = stop
            end[right] = 0
            if stop < n:
                before[stop] = left
                p = seat(run[left:end[stop]])
                if p is not None:
                    push(agenda, p << two | left << bits | end[stop])
            if left:
                first = before[left]
                p = seat(run[first:stop])
                if p is not None:
                    push(agenda, p << two | first << bits | stop)
        out, at = [], 0
        while at < n:
            stop = end[at]
            one = ids.get(run[at:stop])
            if one is None:
                out.extend([self.bytes[b] for b in run[at:stop].encode()])
            else:
                out.append(one)
            at = stop
        return out

    def runs(self, word: str) -> list[str]:
        """``word`` cut between characters that no piece holds side by side."""
        pairs = self.pairs
        cuts = [0, *[i for i in range(1, len(word)) if word[i - 1:i + 1] not in pairs], len(word)]
        return [word[i:j] for i, j in zip(cuts, cuts[1:])]

    def encode_all(self, whole: list[str]) -> list[np.ndarray]:
        """Ids of each text, the end id last.  An empty text is the end id alone."""
        split = [self.cut(t) for t in whole]
        flat = list(chain.from_iterable(split))
        found = list(map(self.known.get, flat))
        missed = [n for n, ids in enumerate(found) if ids is None]
        if missed:
            new = self.learn({flat[n] for n in missed})
            for n in missed:
                found[n] = new[flat[n]]
            kept = {k: ids for k, ids in new.items() if len(k) <= WORD_CHARS}
            if 3 * len(missed) > 2 * len(flat) and len(self.known) + len(kept) > WORDS:
                self.known = {}  # other texts than those it was filled with: the table begins again
            self.known.update(islice(kept.items(), max(0, WORDS - len(self.known))))  # a full one stays: it holds the frequent words
        end, at, out = np.array([self.end], dtype="<i4").tobytes(), 0, []
        for keys in split:
            out.append(np.frombuffer(b"".join([*found[at:at + len(keys)], end]), "<i4"))
            at += len(keys)
        return out

    def encode(self, text: str) -> list[int]:
        """:meth:`encode_all` of one text."""
        return self.encode_all([text])[0].tolist()


@lru_cache(maxsize=2)
def opened(model_file: str) -> Agenda:
    """One encoder per Python worker, its tables kept from task to task."""
    return Agenda(model_file)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL,
           check: bool = True) -> DataFrame:
    """(doc_id, ids array<int>, decoded, agrees): the ids of every whole text, the end id last, and the
    text that the library's decode gives for them.  ``agrees``: the library encodes to the same ids
    (null if not ``check``).  A null text counts as empty (the end id alone, decoded to ''); null
    ids and repeated rows are documents of their own; an empty table gives an empty result; no
    other column is read.  A run of characters without any possible cut is held by one task:
    about 60 bytes of work space for each of its characters."""
    src = distinct_names(docs, id_col, text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        agenda = opened(model_path(model))
        for b in small_batches(it, "text", BATCH_BYTES):
            whole = [t.decode("utf-8", "replace") for t in texts(b.column("text"))]
            ids = agenda.encode_all(whole)
            lists = [i.tolist() for i in ids]
            agrees = [None] * len(ids)
            if check:
                agrees = [a == o for a, o in zip(lists, agenda.library.encode(whole, add_eos=True, num_threads=1))]
            offsets = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int32())),
                 pa.array(agenda.library.decode(lists), pa.string()), pa.array(agrees, pa.bool_())],
                ["doc_id", "ids", "decoded", "agrees"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string, agrees boolean")


def decode(encoded: DataFrame, ids_col: str = "ids", out: str = "text", model: str = MODEL) -> DataFrame:
    """``encoded`` with a column ``out``: the text of the ids (null ids: null)."""
    schema = encoded.select("*").schema.add(out, "string")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model_path(model))
        for b in it:
            ids = b.column(b.schema.get_field_index(ids_col)).to_pylist()
            text = [None if i is None else library.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], [*b.schema.names, out])

    return encoded.mapInArrow(run, schema)
