"""Token counts by a finite-state transducer compiled from a BPE piece model.

A prefix of a text has one encoding, and the encoding of a longer prefix ends in the
one piece that may stand behind the encoding of what is left of it: two pieces may
be neighbours exactly if the pair, encoded alone, gives the two back. So the last
piece and the count at a place follow from those at the places where some piece may
have begun. Those are finitely many, relative to the place itself, and they are the
states of a deterministic transducer over characters, whose transitions carry the
change of the count. States and transitions are made when a text first needs them
and kept in flat tables under a bound of memory.

No piece holds a word mark behind another character, so a mark that starts a run
resets the transducer. A chunk of a text maps any state to a fixed state and count
from its first reset on; only the head before it depends on the state that comes in.
Chunks of all texts run side by side, one table step for all per character. A head is
mapped from each state that may come in: where the chunk before has a reset, the one
state it gives out; else a state guessed from a few characters before, and whatever
the maps of the chunk before turn out to give. The maps then compose along each text
by a prefix scan of doubling steps.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from .common import arrow_schema, slices

MARK = "▁"
CHUNK = 1024
#: Characters before a head that its incoming state is guessed from, and rounds in which
#: what guesses lead to is mapped as well; later ones map what really comes in alone.
WARM, TURNS = 48, 64
#: Bytes of transition tables per Python worker; beyond it they are made anew.
TABLE_BYTES = 96 << 20
SLICE_BYTES = 2 << 20
#: A character of no piece; it stands alone as four byte pieces and separates what is around it.
WALL = "\U0010fffd"
DEAD = ""
#: Characters that are worked on at once.
AT_ONCE = 1 << 21
_RESET = re.compile(f"[^ {MARK}](?=[ {MARK}])")
#: Beginnings of more pieces than this keep the piece before them as it is.
SMALL = 64


class Transducer:
    def __init__(self, path: str, table_bytes: int = TABLE_BYTES):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {m.id_to_piece(i): i for i in range(m.vocab_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))}
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece has a word mark behind another character")
        if m.normalize(" ﬁ①  Ａ\n ") not in (f"{MARK}{MARK}ﬁ①{MARK}{MARK}Ａ\n{MARK}", " ﬁ①  Ａ\n ") or m.encode("a a", out_type=str)[0][0] != MARK or len(m.encode(WALL)) != 5:
            raise ValueError("only models without normalisation, with a first word mark and byte pieces are compiled")
        self.pieces = pieces
        self.prefixes = {p[:k] for p in pieces for k in range(len(p))}
        self.known = {c for p in pieces for c in p}
        self.table_bytes = table_bytes
        self.longer: dict[str, list[str]] = {}
        for p in pieces:
            for k in range(1, len(p)):
                self.longer.setdefault(p[:k], []).append(p)
        self._same: dict[tuple[str, tuple], str | None] = {}
        self._place: dict[tuple[str, str | None], str | None] = {}
        self.classes = np.zeros(0x110000, np.uint16)
        self.chars = [""] + ["\x00", "͸", "￿", WALL]  # class 0: not met yet; then the unknown by UTF-8 length
        for k, c in enumerate(["\x7f", "͸", "￿", WALL], 1):
            self.chars[k] = c
        self._clear()

    # Compilation

    def _ids(self, text: str) -> list[int]:
        return self.model.encode(WALL + text)[5:]

    def _may_follow(self, last: str | None, piece: str) -> bool:
        own = [self.pieces[piece]]
        return self._ids(piece) == own if last is None else self._ids(last + piece) == self._ids(last) + own

    def _merged(self, begun: str, before: str | None) -> str | None:
        """A stand-in for the piece before a place where a piece may have begun with ``begun``:
        the same one for all pieces that the same longer pieces may follow, DEAD if none may."""
        longer = self.longer[begun]
        if len(longer) > SMALL:
            return before
        key = (begun, before)
        out = self._place.get(key, self)
        if out is self:
            if len(self._place) > 1 << 19:
                self._place.clear()
                self._same.clear()
            may = tuple(p for p in longer if self._may_follow(before, p))
            out = self._place[key] = self._same.setdefault((begun, may), before) if may else DEAD
        return out

    def _step(self, key: tuple, c: str) -> tuple[tuple, int]:
        """A state is (tail, ((depth, last piece, count) at each place in the tail where a piece
        may have begun, counts relative to here))."""
        tail, places = key
        if c == MARK and not tail.endswith(MARK):
            tail, places = "", ((0, None, 0),)
        n = len(tail)
        last, delta = c, len(c.encode("utf-8", "surrogatepass"))
        for d, before, count in places:
            piece = tail[n - d :] + c
            if piece in self.pieces and self._may_follow(before, piece):
                last, delta = piece, count + 1
                break
        joined = tail + c
        where = [(0, last, 0)]
        for d, before, count in places:
            begun = joined[n - d :]
            if begun in self.prefixes and (stand_in := self._merged(begun, before)) != DEAD:
                where.append((d + 1, stand_in, count - delta))
        return (joined[len(joined) - where[-1][0] :], tuple(where)), delta

    # Tables

    def _clear(self) -> None:
        self.keys: list[tuple] = []
        self.at: dict[tuple, int] = {}
        self.width = max(64, -(-len(self.chars) // 16) * 16)
        self.next = np.full((1024, self.width), -1, np.int32)
        self.delta = np.zeros((1024, self.width), np.int16)
        self.start = self._state(("", ((0, None, 0),)))

    def _state(self, key: tuple) -> int:
        k = self.at.get(key)
        if k is None:
            k = self.at[key] = len(self.keys)
            self.keys.append(key)
            if k >= len(self.next):
                self.next = np.concatenate([self.next, np.full_like(self.next, -1)])
                self.delta = np.concatenate([self.delta, np.zeros_like(self.delta)])
        return k

    def _room(self, live: np.ndarray) -> np.ndarray:
        """Starts the tables anew if they are full; the live states stay, under new numbers."""
        if len(self.chars) <= self.width and (len(self.keys) + 4096) * self.width * 6 <= self.table_bytes:
            return live
        held, back = np.unique(live, return_inverse=True)
        keys = [self.keys[k] for k in held]
        self._clear()
        return np.array([self._state(k) for k in keys], np.int64)[back]

    def classify(self, points: np.ndarray) -> np.ndarray:
        out = self.classes[points]
        if len(points) and not out.all():
            for p in np.unique(points[out == 0]).tolist():
                c = chr(p)
                if c in self.known:
                    self.classes[p] = len(self.chars)
                    self.chars.append(c)
                else:
                    self.classes[p] = len(c.encode("utf-8", "surrogatepass"))
            out = self.classes[points]
        return out

    def run(self, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exit states and counts of chunks that are read side by side."""
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        now, count = self._room(states[order].astype(np.int64)), np.zeros(len(order), np.int64)
        width, nxt, dlt = self.width, self.next.ravel(), self.delta.ravel()
        active = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), "right")
        for j, m in enumerate(active.tolist()):
            cell = now[:m] * width + classes[starts[:m] + j]
            to = nxt[cell]
            if to.min() < 0:
                if (len(self.keys) + len(to)) * width * 6 > self.table_bytes + (len(to) * width * 6):
                    now = self._room(now)
                    width, nxt, dlt = self.width, self.next.ravel(), self.delta.ravel()
                    cell = now[:m] * width + classes[starts[:m] + j]
                    to = nxt[cell]
                for x in np.unique(cell[to < 0]).tolist():
                    s, c = divmod(x, width)
                    key, delta = self._step(self.keys[s], self.chars[c])
                    t = self._state(key)
                    self.next[s, c], self.delta[s, c] = t, delta
                nxt, dlt = self.next.ravel(), self.delta.ravel()
                to = nxt[cell]
            count[:m] += dlt[cell]
            now[:m] = to
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return now[back], count[back]

    # Texts

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text, as the model's own encoder gives them; null counts as empty."""
        out = np.zeros(len(texts), np.int64)
        held: list[str] = []
        owner: list[int] = []
        size = 0
        for i, t in enumerate(texts):
            for part in self._parts(MARK + t) if t else ():
                held.append(part)
                owner.append(i)
                size += len(part)
                if size >= AT_ONCE:
                    np.add.at(out, owner, self._counts(held))
                    held, owner, size = [], [], 0
        np.add.at(out, np.array(owner, np.int64), self._counts(held))
        return out

    @staticmethod
    def _parts(text: str) -> Iterator[str]:
        """A text in parts that begin at resets, each about as long as is worked on at once."""
        at = 0
        while len(text) - at > AT_ONCE and (m := _RESET.search(text, at + AT_ONCE)):
            yield text[at : m.end()]
            at = m.end()
        yield text[at:]

    def _counts(self, texts: list[str]) -> np.ndarray:
        raw = [t.encode("utf-32-le", "surrogatepass") for t in texts]
        ends = np.cumsum([len(r) // 4 for r in raw], dtype=np.int64)
        points = np.frombuffer(b"".join(raw), "<u4").copy()
        points[points == 0x20] = ord(MARK)
        classes = self.classify(points).astype(np.int64)
        if len(self.chars) > self.width:
            self._clear()
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        reset = points == ord(MARK)
        reset[1:] &= points[:-1] != ord(MARK)
        reset[begins[ends > begins]] = True
        # Chunks: text, first character, length, and where its first reset is.
        per = -(-(ends - begins) // CHUNK)
        text = np.repeat(np.arange(len(texts)), per)
        first = begins[text] + CHUNK * (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per))
        size = np.minimum(CHUNK, ends[text] - first)
        places = np.flatnonzero(reset)
        k = np.searchsorted(places, first)
        head = np.minimum(np.append(places, len(points))[k] - first, size)
        # From the reset on, all chunks run from the start state.
        exits, count = self.run(classes, first + head, size - head, np.full(len(text), self.start, np.int64))
        keys = [self.keys[s] for s in exits.tolist()]
        whole = head < size  # maps to one state, whatever comes in
        last = np.append(text[1:] != text[:-1], True) if len(text) else whole
        at, more = self._heads(classes, first, head, whole, last, keys)
        np.add.at(count, at, more)
        return np.bincount(text, weights=count, minlength=len(texts)).astype(np.int64)

    def _heads(self, classes: np.ndarray, first: np.ndarray, head: np.ndarray, whole: np.ndarray, last: np.ndarray, keys: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks, and the tokens of their heads and of the heads that follow in one go.
        ``keys``: the states that chunks with a reset give out."""
        todo = np.flatnonzero(head > 0)
        sure = whole[todo - 1]
        origins = want = [(i, keys[i - 1]) for i in todo[sure].tolist()]
        behind = todo[~sure]  # the chunk before is all head, so it has CHUNK characters
        if len(behind):
            come, _ = self.run(classes, first[behind] - WARM, np.full(len(behind), WARM), np.full(len(behind), self._state(("", ((0, None, 0),))), np.int64))
            want = origins + [(i, self.keys[s]) for i, s in zip(behind.tolist(), come.tolist(), strict=True)]
        node: dict[tuple[int, tuple], int] = {}
        out: list[tuple | None] = []  # the chunk and state that follow
        tokens: list[int] = []
        turn = 0
        while want:
            chunk = np.array([i for i, _ in want])
            exits, more = self.run(classes, first[chunk], head[chunk], np.array([self._state(k) for _, k in want], np.int64))
            goes_on = ~whole[chunk] & ~last[chunk]
            for key, s, n, on in zip(want, exits.tolist(), more.tolist(), goes_on.tolist(), strict=True):
                node[key] = len(out)
                out.append((key[0] + 1, self.keys[s]) if on else None)
                tokens.append(n)
            turn += 1
            if turn <= TURNS:
                want = list({k for k in out if k is not None and k not in node})
            else:
                want = list({k for k in map(out.__getitem__, self._scan(node, out, tokens, origins)[0].tolist()) if k is not None})
        return np.array([i for i, _ in origins], np.int64), self._scan(node, out, tokens, origins)[1]

    @staticmethod
    def _scan(node: dict, out: list, tokens: list[int], origins: list) -> tuple[np.ndarray, np.ndarray]:
        """From each origin, the last map that is there on its way, and the tokens up to it: maps
        compose with the ones they lead to, then pairs of them, and so on."""
        to = np.array([node.get(k, j) if k is not None else j for j, k in enumerate(out)], np.int64)
        total = np.where(to == np.arange(len(to)), 0, np.array(tokens, np.int64))
        own = np.array(tokens, np.int64)
        while len(to) and (to[to] != to).any():
            total += total[to]
            to = to[to]
        total += total[to]
        start = np.array([node[k] for k in origins], np.int64)
        return to[start], total[start] + own[to[start]] if len(start) else start


@lru_cache(2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit``).

    Null and empty texts have no bytes and no tokens; repeated rows, null ids and ties
    need no rule, for each row stands alone; other columns are ignored; an empty table gives
    no rows. A very long text is counted whole, in parts that end at resets; one without any
    (no blanks) is held by a task with about 30 bytes for each character.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    schema = _parse_datatype_string(f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    names = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for batch in batches:
            body = batch.column(1)
            sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in body], np.int64)
            for a, b in slices(np.concatenate([[0], np.cumsum(sizes)]), SLICE_BYTES):
                counts = t.counts(body.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).cast(names[0].type), pa.array(sizes[a:b]), pa.array(counts)], schema=names)

    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
