"""Operator 1: byte-level BPE as a lazily determinised finite-state transducer.

A token sequence is the BPE encoding of its bytes exactly when every token encodes to itself
and every two neighbours encode to themselves as a pair. A nondeterministic machine can
therefore guess token ends: its state is (last token, bytes read since), a guess lives on
while the bytes are a prefix of some token. ``Transducer`` determinises that machine on
demand: one state holds all living guesses, each with the tokens it has not yet emitted;
tokens that all guesses agree on are emitted at once, so output lags behind the input only
by the bounded lookahead in which guesses still differ. States, transitions and pair tests
are memoised and thrown away together when there are too many, so memory is bounded.

Decoding runs ids through ``StreamDecoder``: a UTF-8 state machine whose state is the
unfinished bytes of a code point, with transitions over whole tokens, memoised per state.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import BoundedCache, map_batches

#: White space as in Unicode's White_Space property, which the split pattern's ``\s`` means.
SPACE = r"\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Transducer:
    """Lazily determinised BPE transducer over bytes for ranks {token bytes: id}."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 300_000):
        self.ranks, self.max_states = ranks, max_states
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        # In rank order each longer token is the one pair of earlier tokens that stands
        # unmerged before it; a token without such a pair never results from merging.
        self.kids: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for piece, t in sorted(ranks.items(), key=lambda x: x[1]):
            for k in range(1, len(piece)):
                pair = (ranks.get(piece[:k], t), ranks.get(piece[k:], t))
                if max(pair) < t and pair[0] in self.halves and pair[1] in self.halves and self.apart(*pair):
                    self.halves[t] = pair
                    self.joined[pair] = t
                    break
            else:
                if len(piece) > 1:
                    continue
                self.halves[t] = (t, t)
            node = 0
            for byte in piece:
                if byte not in self.kids[node]:
                    self.kids[node][byte] = len(self.kids)
                    self.kids.append({})
                    self.token_at.append(-1)
                node = self.kids[node][byte]
            self.token_at[node] = t
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = []
        self.index: dict[tuple, int] = {}
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.start = self.state(((-1, 0, ()),))

    def apart(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` stay two tokens when their bytes are merged together.

        Undo merges, the latest first, on the sides that face each other: the border survives
        unless two facing parts would have merged before the later of them was used up.
        """
        halves, joined, bound = self.halves, self.joined, 1 << 60
        while True:
            if joined.get((a, b), bound) < bound:
                return False
            right, left = halves[a][1], halves[b][0]
            if right == a and left == b:
                return True
            if left == b or (right != a and a > b):
                a, bound = right, a
            else:
                b, bound = left, b + 1

    def state(self, guesses: tuple) -> int:
        s = self.index.get(guesses)
        if s is None:
            s = self.index[guesses] = len(self.states)
            self.states.append(guesses)
        return s

    def move(self, s: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Successor state and the tokens that every living guess agrees on. Guesses are in
        the order of their last token's end, so equal sets are equal tuples."""
        kids, token_at, pairs = self.kids, self.token_at, self.pairs
        live, fresh = [], None
        for last, node, out in self.states[s]:
            node = kids[node].get(byte)
            if node is None:
                continue
            if kids[node]:
                live.append((last, node, out))
            t = token_at[node]
            if t >= 0 and fresh is None:
                ok = last < 0
                if not ok:
                    ok = pairs.get((last, t))
                    if ok is None:
                        ok = pairs[last, t] = self.apart(last, t)
                if ok:
                    fresh = (t, 0, (*out, t))
        if fresh is not None:
            live.append(fresh)
        if len(live) == 1:
            last, node, out = live[0]
            return self.state(((last, node, ()),)), out
        first = live[0][2]
        sure = len(first)
        for _, _, out in live:
            k, sure = 0, min(sure, len(out))
            while k < sure and out[k] == first[k]:
                k += 1
            sure = k
            if not sure:
                return self.state(tuple(live)), ()
        return self.state(tuple((a, n, o[sure:]) for a, n, o in live)), first[:sure]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > self.max_states or len(self.pairs) > 4 * self.max_states:
            self.reset()
        s, out, steps = self.start, [], self.steps
        for byte in piece:
            hit = steps.get(s * 256 + byte)
            if hit is None:
                hit = steps[s * 256 + byte] = self.move(s, byte)
            s, sure = hit
            if sure:
                out.extend(sure)
        for _, node, rest in self.states[s]:
            if not node:
                out.extend(rest)
        return out


class Encoder:
    """Text to ids: the pattern cuts the text, the transducer encodes each match.

    A match never runs from a visible character into white space, so a text may be cut
    before every run of white space. Texts whose white space is single blanks and line ends
    (``plain``) are cut with string methods; either way the cut pieces repeat and are memoised.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.fst = Transducer(ranks)
        self.match = regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{SPACE}\p{{L}}\p{{N}}]")
                                   .replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))
        self.cut = re.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
        self.odd = re.compile(rf"[{SPACE}][{SPACE}]|[\t\v-\r\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\0]")
        self.words = BoundedCache(self._match, 1_200_000)
        self.memo = BoundedCache(self._piece, 300_000)

    def _match(self, match: str) -> bytes:
        return np.array(self.fst.encode(match.encode("utf-8", "surrogatepass")), "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        return b"".join(self.words[m] if len(m) <= 64 else self._match(m) for m in self.match.findall(piece))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.odd.search(text) is None:
            pieces = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        else:
            pieces = self.cut.findall(text)
        if max(map(len, pieces)) <= 64:
            return b"".join(map(self.memo.__getitem__, pieces))
        return b"".join(self.memo[p] if len(p) <= 64 else self._piece(p) for p in pieces)


def _need(lead: int) -> int:
    """Length of the UTF-8 sequence that a lead byte opens; 1 for all others."""
    return 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 1


def _whole(piece: bytes) -> bool:
    try:
        piece.decode()
    except UnicodeDecodeError:
        return False
    return True


class StreamDecoder:
    """Ids to text, incrementally: the state is the bytes of an unfinished code point."""

    def __init__(self, vocab: list[bytes]):
        self.vocab = vocab
        self.tables: dict[bytes, _Table] = {}
        self.torn = np.array([not _whole(v) for v in vocab])

    def _table(self, pending: bytes) -> _Table:
        if pending not in self.tables:
            self.tables[pending] = _Table(self, pending)
        return self.tables[pending]

    def transition(self, pending: bytes, token: int) -> tuple[bytes, _Table]:
        """Finished bytes and the next state after ``token``."""
        data = pending + self.vocab[token]
        keep = 0
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 != 0x80:
                keep = back if _need(lead) > back else 0
                break
        done = data[:len(data) - keep]
        return done, self._table(data[len(data) - keep:])

    def decode(self, ids: np.ndarray) -> tuple[list[bytes], bytes]:
        """Finished pieces, each of whole code points (or bytes no code point can hold), and
        the unfinished rest. Runs of tokens that begin and end between code points leave the
        machine in its first state and are joined at once."""
        table, out, at = self._table(b""), [], 0
        vocab = self.vocab
        for stop in [*np.flatnonzero(self.torn[ids]).tolist(), len(ids)]:
            while at < stop and table.pending:
                piece, table = table[int(ids[at])]
                out.append(piece)
                at += 1
            if at < stop:
                out.append(b"".join(map(vocab.__getitem__, ids[at:stop].tolist())))
                at = stop
            if stop < len(ids):
                piece, table = table[int(ids[stop])]
                out.append(piece)
                at = stop + 1
        return out, table.pending


class _Table(dict):
    def __init__(self, owner: StreamDecoder, pending: bytes):
        super().__init__()
        self.owner, self.pending = owner, pending

    def __missing__(self, token: int):
        v = self[token] = self.owner.transition(self.pending, token)
        return v


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(load_ranks(path), pattern)


@lru_cache(maxsize=2)
def decoder(path: str) -> StreamDecoder:
    by_id = {v: k for k, v in load_ranks(path).items()}
    return StreamDecoder([by_id.get(i, b"") for i in range(max(by_id) + 1)])


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids binary, n_tokens): ids as little-endian unsigned 32-bit integers.

    Null and empty texts give no ids. A null id stays null. Columns other than the two named
    are not read; ties and repeated rows are encoded row by row.
    """
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(path, pattern)
        ids = [enc.encode(t) for t in b.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()),
                                           pa.array([len(x) // 4 for x in ids], pa.int64())],
                                          [id_col, "ids", "n_tokens"])
    d = docs.select(id_col, text_col)
    return map_batches(d, batch, f"{id_col} {d.schema[id_col].dataType.simpleString()}, ids binary, n_tokens long")


def count_documents(docs: DataFrame, path: str, pattern: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and n_tokens, the encoded length of the whole text (null: 0)."""
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(path, pattern)
        n = [len(enc.encode(t)) // 4 for t in b.column(b.num_columns - 1).to_pylist()]
        return pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], [*keep, "n_tokens"])
    d = docs.select(*keep, docs[text_col].alias("__text"))
    kinds = ", ".join(f"`{c}` {d.schema[c].dataType.simpleString()}" for c in keep)
    return map_batches(d, batch, ", ".join(x for x in (kinds, "n_tokens long") if x))


def decode_ids(ids: bytes, path: str) -> bytes:
    done, rest = decoder(path).decode(np.frombuffer(ids, "<u4"))
    return b"".join(done) + rest


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode whole texts, decode the ids and
    digest both. Encoding and decoding share one pass, so the ids never leave the task."""
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        enc, dec = encoder(path, pattern), decoder(path)
        n, digest, back = [], [], []
        for t in b.column(1).to_pylist():
            ids = enc.encode(t)
            n.append(len(ids) // 4)
            digest.append(hashlib.sha256(ids).hexdigest())
            h = hashlib.sha256()
            done, rest = dec.decode(np.frombuffer(ids, "<u4"))
            h.update(b"".join(done) + rest)
            back.append(h.hexdigest())
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(back, pa.string())],
                                          ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return map_batches(d, batch, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
