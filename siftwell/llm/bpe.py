"""Byte-level BPE as a lazily determinised finite-state transducer.

A token sequence is what the merges give for a byte string exactly when every two neighbours stay
apart when only their own bytes are merged, and every token merges back to itself.  So the merges are
compiled into a trie of tokens, which an automaton reads in a loop, and a relation of which token may
follow which.  The automaton may be at several nodes of the trie at once, one for each place where
the current token may have begun; subset construction makes it deterministic, lazily, a transition
when it is first taken.  A state writes which tokens may end at the byte read.  A string has one
encoding, so exactly one of them may follow the token that ends where it begins; it goes to a
register.  What all places where the current token may have begun have in common is final and is
written: output lags input by a few tokens on the texts that the tests try, periodic ones included.

Decoding runs each token's bytes through an incremental UTF-8 state machine that holds back at most
three bytes, so text can be streamed although tokens cut characters.

A batch's new pieces of text are read side by side, one byte of each at a time, with the transitions
and the relation in arrays; single and very long ones are read as a stream.

Memory: the trie and the vocabulary (some 50 MB) plus tables and caches of bounded size in each
Python worker, and a batch's distinct words.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame

from siftwell.llm.common import held, small_batches

ROOT = 0
#: Words and pieces that a worker keeps (twice that while old ones are met again), states, pairs of
#: tokens of which it is known whether they may follow; full tables start anew.
WORDS_KEPT, PIECES_KEPT, STATES_KEPT, PAIRS_KEPT = 100_000, 100_000, 30_000, 1 << 19
#: Bytes read before what is final is written.
BLOCK = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class MergeTransducer:
    """bytes -> token ids, one byte at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.bytes_of = [b""] * size
        for b, i in ranks.items():
            self.bytes_of[i] = b
        self.size_of = [len(b) for b in self.bytes_of]
        self.children: dict[int, int] = {}  # node * 256 + byte -> node
        self.token_at, self.depth = array("i", [-1]), array("i", [0])
        for token, i in ranks.items():
            node = ROOT
            for byte in token:
                nxt = self.children.get(node << 8 | byte)
                if nxt is None:
                    nxt = self.children[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = nxt
            self.token_at[node] = i
        self.sizes = np.array([*self.size_of, 0], np.int64)
        self.start = size  # what the first token follows
        self.edges: dict[int, tuple[tuple, tuple] | None] = {}
        self._reset()
        self._forget_pairs()

    def _reset(self) -> None:
        self.number: dict[int, int] = {}  # the deepest node -> state; the others are its suffixes
        self.state: list[tuple[int, ...]] = []
        self.step = np.full((1024, 256), -1, np.int32)  # state and byte -> state
        self.ending: list[tuple[tuple[int, int], ...]] = []  # (size, token) of what may end in a state
        self.endings = np.zeros((1024, 1, 2), np.int64)  # the same, filled up with zeros
        self._add((ROOT,))

    def _add(self, nodes: tuple[int, ...]) -> int:
        n = self.number[nodes[0]] = len(self.state)
        self.state.append(nodes)
        ends = tuple([(self.depth[x], self.token_at[x]) for x in nodes if self.token_at[x] >= 0])
        self.ending.append(ends)
        if n == len(self.step):
            self.step = np.concatenate([self.step, np.full_like(self.step, -1)])
            self.endings = np.concatenate([self.endings, np.zeros_like(self.endings)])
        if len(ends) > self.endings.shape[1]:
            self.endings = np.pad(self.endings, ((0, 0), (0, len(ends) - self.endings.shape[1]), (0, 0)))
        self.endings[n, : len(ends)] = np.array(ends, np.int64).reshape(-1, 2)
        return n

    def advance(self, s: int, byte: int) -> int:
        """Determinise one transition."""
        to = [child for x in self.state[s] if (child := self.children.get(x << 8 | byte)) is not None]
        to.append(ROOT)
        found = self.number.get(to[0])
        if found is None:
            found = self._add(tuple(to))
        self.step[s, byte] = found
        return found

    def merge(self, data: bytes, until: int = 1) -> list[bytes]:
        """The merges as they are defined: the lowest rank first, the leftmost of equals.  Used on
        single tokens only, while the transducer is compiled."""
        parts, rank = [data[i : i + 1] for i in range(len(data))], self.ranks.get
        while len(parts) > until:
            ranks = [rank(x + y, 1 << 60) for x, y in zip(parts, parts[1:])]
            low = min(ranks)
            if low == 1 << 60:
                break
            at = ranks.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def spine(self, token: int) -> tuple[tuple, tuple] | None:
        """The parts at the left and the right edge of a token while it is merged, each with the
        rank of the merge that ends it; None if its bytes don't merge to it."""
        if token in self.edges:
            return self.edges[token]
        whole, found = self.bytes_of[token], None
        if len(whole) == 1:
            found = (((whole, 1 << 59),),) * 2
        else:
            two = self.merge(whole, 2)
            if any(len(x) > 1 and self.ranks[x] >= token for x in two):
                raise ValueError("a merge ranks below one of its parts")
            below = [self.spine(self.ranks[x]) for x in two]
            if len(two) == 2 and None not in below:
                found = tuple(((whole, 1 << 59), (two[side], token), *below[side][side][1:]) for side in (0, 1))
        self.edges[token] = found
        return found

    def follows(self, a: int, b: int) -> bool:
        """May token ``b`` stand after token ``a`` (``start``: at the start)?

        Merging the bytes of both goes on inside each as it would alone, unless a merge across the
        border comes first: of a part at the right edge of ``a`` and one at the left edge of ``b``,
        at a rank before what ends the first, and not after what ends the second (of equal ranks
        the left one is merged first).
        """
        left, ok = self.spine(b), True
        if left is None:
            ok = False
        elif a != self.start:
            rank = self.ranks.get
            for x, ends_x in self.spine(a)[1]:
                for y, ends_y in left[0]:
                    r = rank(x + y)
                    if r is not None and r < ends_x and r <= ends_y:
                        ok = False
                        break
                if not ok:
                    break
        return ok

    def _forget_pairs(self) -> None:
        self.known, self.says, self.n_known = np.full(2 * PAIRS_KEPT, -1, np.int64), np.zeros(2 * PAIRS_KEPT, bool), 0

    def follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``follows`` of many pairs; what is asked for the first time is kept in a hash table."""
        key = a << 24 | b
        ok, left, mask = np.zeros(len(key), bool), np.arange(len(key)), len(self.known) - 1
        at = (key * 0x9E3779B97F4A7C1 >> 20) & mask
        new = []
        while len(left):
            there = self.known[at]
            found = there == key[left]
            ok[left[found]] = self.says[at[found]]
            new.append(left[there < 0])
            more = ~found & (there >= 0)
            left, at = left[more], at[more] + 1 & mask
        new = np.concatenate(new) if new else left
        if len(new):
            keys, back = np.unique(key[new], return_inverse=True)
            if self.n_known + len(keys) > PAIRS_KEPT:
                self._forget_pairs()
            says = np.array([self.follows(k >> 24, k & 0xFFFFFF) for k in keys.tolist()])
            ok[new] = says[back]
            for k, at, x in zip(keys.tolist(), ((keys * 0x9E3779B97F4A7C1 >> 20) & mask).tolist(), says.tolist()):
                while self.known[at] >= 0:
                    at = at + 1 & mask
                self.known[at], self.says[at] = k, x
            self.n_known += len(keys)
        return ok

    def encode_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of piece k are ids[offsets[k]:offsets[k + 1]]."""
        size = np.array([len(p) for p in pieces], np.int64)
        order = np.argsort(-size, kind="stable")
        size, most = size[order], int(size.max(initial=0))
        data = np.frombuffer(b"".join([pieces[k].ljust(most, b"\0") for k in order.tolist()]), np.uint8).reshape(len(pieces), most)
        ends = np.full((len(pieces), most + 1), self.start, np.int64)
        if len(self.state) >= STATES_KEPT:
            self._reset()
        s = np.zeros(len(pieces), np.int64)
        for k in range(most):
            n = np.searchsorted(-size, -k)  # so many are longer
            s, byte = s[:n], data[:n, k]
            to = self.step[s, byte]
            for x in np.unique((s << 8 | byte)[to < 0]).tolist():
                self.advance(x >> 8, x & 255)
            s = self.step[s, byte].astype(np.int64) if (to < 0).any() else to.astype(np.int64)
            left, j = np.arange(n), 0
            while len(left):  # exactly one of the tokens that may end here follows the one before it
                length, token = self.endings[s[left], j].T
                ok = self.follow(ends[left, k + 1 - length], token)
                if not length.all():
                    raise ValueError("no token ends at some byte")
                ends[left[ok], k + 1] = token[ok]
                left, j = left[~ok], j + 1
        # back from the ends, all side by side
        found, at, rows = [], size.copy(), np.flatnonzero(size)
        count = np.zeros(len(pieces), np.int64)
        while len(rows):
            token = ends[rows, at[rows]]
            found.append((rows, token))
            count[rows] += 1
            at[rows] -= self.sizes[token]
            rows = rows[at[rows] > 0]
        offsets = np.zeros(len(pieces) + 1, np.int64)
        offsets[order + 1] = count
        offsets = np.cumsum(offsets)
        ids = np.zeros(offsets[-1], np.int32)
        for j, (rows, token) in enumerate(found):
            ids[offsets[order[rows] + 1] - 1 - j] = token
        return ids, offsets

    def run(self, s: int, data: bytes, ends: list[int]) -> int:
        """Read ``data`` from state ``s``; notes in ``ends`` the token that ends at each byte."""
        k = len(ends)
        for byte in data:
            to = int(self.step[s, byte])
            s = to if to >= 0 else self.advance(s, byte)
            for size, token in self.ending[s]:
                if self.follows(ends[k - size], token):
                    ends.append(token)
                    break
            else:
                raise ValueError(f"no token ends at byte {byte:#x}")
            k += 1
        return s

    def encode(self, data: bytes) -> list[int]:
        if len(data) > BLOCK:
            stream = TokenStream(self)
            return stream.feed(data) + stream.end()
        ends = [self.start]
        self.run(0, data, ends)
        return self.back(ends, len(data), 0)

    def back(self, ends: list[int], at: int, until: int) -> list[int]:
        """The tokens between two places; ends[k] is the token that ends at place k."""
        out, size = [], self.size_of
        while at > until:
            token = ends[at]
            out.append(token)
            at -= size[token]
        out.reverse()
        return out


class TokenStream:
    """The transducer fed part by part: ids are given as soon as they are final."""

    def __init__(self, fst: MergeTransducer):
        self.fst, self.state, self.ends = fst, 0, [fst.start]

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        for at in range(0, len(data), BLOCK):
            self.state = self.fst.run(self.state, data[at : at + BLOCK], self.ends)
            settled = self.settled()
            out += self.fst.back(self.ends, settled, 0)
            del self.ends[:settled]
        return out

    def settled(self) -> int:
        """Up to where the tokens are the same wherever the current one began."""
        size, n = self.fst.size_of, len(self.ends) - 1
        begins = {n - self.fst.depth[x] for x in self.fst.state[self.state] if self.fst.depth[x] <= n}
        while len(begins) > 1:
            furthest = max(begins)
            begins.remove(furthest)
            begins.add(furthest - size[self.ends[furthest]])
        return begins.pop()

    def end(self) -> list[int]:
        out = self.fst.back(self.ends, len(self.ends) - 1, 0)
        self.__init__(self.fst)
        return out


def _utf8_moves() -> list[list[int]]:
    """next state by state and byte: 0 a character is complete, 1 to 3 so many bytes follow, 4 to 7 the
    same where the second byte is restricted (after E0, ED, F0, F4), -1 wrong."""
    moves = [[-1] * 256 for _ in range(8)]
    first = [(0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2), (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7)]
    after = [(1, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 1), (3, 0x80, 0xBF, 2), (4, 0xA0, 0xBF, 1), (5, 0x80, 0x9F, 1), (6, 0x90, 0xBF, 2), (7, 0x80, 0x8F, 2)]
    for state, low, high, to in [(0, *x) for x in first] + after:
        moves[state][low : high + 1] = [to] * (high + 1 - low)
    return moves


class Utf8Machine:
    """Incremental UTF-8: feed bytes, get the text that is complete.  Wrong bytes become U+FFFD,
    one for each maximal wrong part, as the Unicode standard recommends."""

    MOVES = _utf8_moves()

    def __init__(self) -> None:
        self.state = self.value = 0

    def feed(self, data: bytes, final: bool = False) -> str:
        if not self.state and data.isascii():  # the machine would stay where it is
            return data.decode("ascii")
        out, state, value = [], self.state, self.value
        for byte in data:
            to = self.MOVES[state][byte]
            if to < 0 and state:  # the character breaks off, and this byte begins another
                out.append("\ufffd")
                state = 0
                to = self.MOVES[0][byte]
            if to < 0:
                out.append("\ufffd")
                state = 0
                continue
            value = value << 6 | byte & 0x3F if state else byte if byte < 0x80 else byte & (0x1F if byte < 0xE0 else 0x0F if byte < 0xF0 else 0x07)
            state = to
            if not state:
                out.append(chr(value))
        if final and state:
            out.append("\ufffd")
            state = 0
        self.state, self.value = state, value
        return "".join(out)


class Recent:
    """What was asked for lately: up to ``kept`` entries, and as many older ones until they are asked
    for again.  Keys of over 64 characters are not kept."""

    def __init__(self, kept: int):
        self.kept, self.now, self.older = kept, {}, {}

    def get(self, keys: Iterable, make: Callable[[list], list]) -> dict:
        """{key: value}; ``make`` gives the values of those that aren't there."""
        found = {k: v for k in keys if (v := self.now.get(k) or self.older.get(k)) is not None}
        missing = [k for k in keys if k not in found]
        found.update(zip(missing, make(missing)))
        if len(self.now) + len(found) > self.kept:
            self.older, self.now = self.now, {}
        self.now.update(found if len(found) <= self.kept else {})
        for k in [k for k in missing if len(k) > 64]:
            self.now.pop(k, None)
        return found


class ByteBpe:
    """Whole texts to ids and back; ``path`` names a file of ranks."""

    def __init__(self, path: str, pattern: str = PATTERN):
        self.ranks = read_ranks(path)
        self.fst = MergeTransducer(self.ranks)
        self.bytes_of = self.fst.bytes_of
        self.pieces_of = regex.compile(pattern).findall
        self.after_space = regex.compile(r" \s").search if pattern == PATTERN else None
        self.ids = self.form(lambda ids, cut: [ids[a:b].tobytes() for a, b in cut], b"")

    def encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of pieces."""
        data = [p.encode("utf-8", "replace") for p in pieces]
        long = [k for k, d in enumerate(data) if len(d) > BLOCK]
        ids, offsets = self.fst.encode_many([d if len(d) <= BLOCK else b"" for d in data])
        if long:
            parts = np.split(ids, offsets[1:-1])
            for k in long:
                whole = self.ranks.get(data[k])
                parts[k] = np.array([whole] if whole is not None else self.fst.encode(data[k]), np.int32)
            ids, offsets = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        return ids, offsets

    def form(self, of: Callable, joint: bytes) -> Callable[[list[str]], list[list[bytes]]]:
        """A function that gives, for each of some texts, the forms of its parts in order.  ``of`` makes
        the forms of several lists of ids, given as one array and where to cut it; ``joint`` is what
        stands between the forms of two lists in the form of both.

        No match of the pattern goes on from a character that isn't white space into a space, and
        none looks further than that; so where no space has white space after it, a text may be
        cut before each space and the parts matched one by one, which lets them be cached.
        """
        pieces, words = Recent(PIECES_KEPT), Recent(WORDS_KEPT)

        def new_pieces(some: list[str]) -> list[bytes]:
            ids, offsets = self.encoded(some)
            offsets = offsets.tolist()
            return of(ids, zip(offsets, offsets[1:]))

        def new_words(some: list[str]) -> list[bytes]:
            cut = [self.pieces_of(" " + word) for word in some]
            forms = pieces.get(dict.fromkeys(chain.from_iterable(cut)), new_pieces)
            return [joint.join(map(forms.__getitem__, x)) for x in cut]

        def parts(texts: list[str]) -> list[list[bytes]]:
            first, rest = [], []
            for text in texts:
                if self.after_space is None or self.after_space(text):
                    first.append(self.pieces_of(text))
                    rest.append([])
                else:
                    start, *more = text.split(" ")
                    first.append(self.pieces_of(start))
                    rest.append(more)
            forms = words.get(set().union(*rest), new_words)
            starts = pieces.get(dict.fromkeys(chain.from_iterable(first)), new_pieces)
            return [[*map(starts.__getitem__, x), *map(forms.__getitem__, y)] for x, y in zip(first, rest)]

        return parts

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.ids([text])[0]), np.int32).tolist()

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        return "".join(self.decode_stream(ids))

    def decode_stream(self, ids: Iterable[int]) -> Iterator[str]:
        machine = Utf8Machine()
        for i in ids:
            if text := machine.feed(self.bytes_of[i]):
                yield text
        if text := machine.feed(b"", final=True):
            yield text


class Decimal:
    """Texts as decimal ids, joined by commas, and such lists back to text."""

    def __init__(self, bpe: ByteBpe):
        self.bpe = bpe
        names = [str(i) for i in range(len(bpe.bytes_of))]
        self.parts = bpe.form(lambda ids, cut: [",".join([names[i] for i in some]).encode() for all_ids in [ids.tolist()] for a, b in cut for some in [all_ids[a:b]]], b",")
        self.texts = Recent(WORDS_KEPT)

    def _texts(self, parts: list[bytes]) -> list[str]:
        """The text of each part, if the UTF-8 machine is at a character's end after it; else empty."""
        out, machine = [], Utf8Machine()
        for part in parts:
            text = machine.feed(self.bpe.decode_bytes(map(int, part.split(b","))))
            out.append("" if machine.state else text)
            machine.state = 0
        return out

    def decode(self, lists: list[list[bytes]]) -> list[str]:
        texts = self.texts.get(set(chain.from_iterable(lists)), self._texts)
        if "" not in texts.values():
            return ["".join(map(texts.__getitem__, parts)) for parts in lists]
        # somewhere a character goes on from one part to the next
        return [self.bpe.decode(int(i) for part in parts for i in part.split(b",")) for parts in lists]


def loaded(path: str) -> ByteBpe:
    """One encoder for each worker process."""
    return held(("bpe", path), lambda: ByteBpe(path))


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row: the operator itself.  A null text counts as empty and
    gives an empty array; rows that repeat are encoded again each time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(ranks_path)
        for batch in small_batches(batches):
            ids = [np.frombuffer(b"".join(x), np.int32) for x in bpe.ids([t or "" for t in batch.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(tokens: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from (id, ids); null ids give an empty text.  Ids that make no valid UTF-8 give
    U+FFFD in place of the wrong bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(ranks_path)
        for batch in small_batches(batches):
            texts = [bpe.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    kind = dict(tokens.dtypes)[id_col]
    return tokens.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, text string")


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, decode the ids again, and return digests of both: (id, n_tokens,
    ids_sha256, decoded_sha256).  One narrow pass without a shuffle; the ids of one document at a
    time are held.  A null or empty text has 0 tokens and the digest of no bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = held(("decimal", ranks_path), lambda: Decimal(loaded(ranks_path)))
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in small_batches(batches):
            parts = decimal.parts([t or "" for t in batch.column(1).to_pylist()])
            ids = [b",".join(x) for x in parts]
            counts = [x.count(b",") + 1 if x else 0 for x in ids]
            sums, back = [*map(sha, ids)], [sha(t.encode()) for t in decimal.decode(parts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(back, pa.string())], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {DIGEST}")
