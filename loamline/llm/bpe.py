"""Byte-level BPE as a lazily determinised finite-state transducer.

A token sequence is the BPE encoding of its bytes exactly if every token and
every pair of neighbours encodes to itself. So the nondeterministic
transducer guesses token boundaries: a hypothesis is (last token, trie node
of the bytes since), and a boundary is allowed where the pair is its own
encoding. Determinising it makes a state a set of hypotheses; states and
transitions are built when a byte first asks for them and kept in a bounded
table. Each move says which hypothesis continues which and what token it
adds. Once all that are alive descend from one, the ids of that one are final
and are emitted (at most every LOOKAHEAD bytes), so the lookahead is bounded.
Exactly one hypothesis stands at a boundary at any time; its ids are emitted
when the piece ends.

Decoding joins the tokens' bytes; ``Utf8Stream`` holds back an unfinished
character at the end of a chunk and passes on the rest.

Nulls and empty texts encode to no ids; repeated rows stay; extra columns are
dropped. Every text is encoded whole, in pieces of the vocabulary's pattern.
"""

from __future__ import annotations

import base64
import gc
from contextlib import contextmanager
from functools import partial
from hashlib import sha256
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .tables import bounded_batches, texts
from .vocab import CACHE_CHARS, CACHE_PARTS, PartCache

MAX_STATES = 200_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
START = -1  # no token before the piece
NEVER = 1 << 60
LOOKAHEAD = 64
# a pattern that begins so matches a blank and letters as one piece
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+|"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f.read().splitlines()) }


class Transducer:
    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.child: dict[int, int] = {}  # node << 8 | byte -> node
        self.token: list[int] = [-1]  # node -> token that ends there
        self.leaf: list[bool] = [True]
        for t, r in ranks.items():
            node = 0
            for b in t:
                step = node << 8 | b
                if step not in self.child:
                    self.child[step] = len(self.token)
                    self.token.append(-1)
                    self.leaf[node] = False
                    self.leaf.append(True)
                node = self.child[step]
            self.token[node] = r
        self.stable: dict[int, bool] = {}  # last << 20 | token
        self.edges: dict[int, tuple | None] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all states but the first (they are built again on demand)."""
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.ends: list[int] = []  # by state: the hypothesis that stands at a boundary
        self.add(((START, 0),))
        self.moves: dict[int, tuple] = {}  # state << 8 | byte -> (state, sources, tokens, final)

    def spines(self, token: int) -> tuple | None:
        """(left, right) edges of the token's merge tree, from the byte up:
        pairs (bytes, rank of the merge that absorbs them). None if merging
        its bytes does not end in the token."""
        known = self.edges.get(token, False)
        if known is not False:
            return known
        data = self.bytes_of[token]
        parts = [data[i:i + 1] for i in range(len(data))]
        left, right = [parts[0]], [parts[-1]]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            if parts[0] != left[-1]:
                left.append(parts[0])
            if parts[-1] != right[-1]:
                right.append(parts[-1])
        whole = None
        if len(parts) == 1:
            whole = tuple([(x, self.ranks[y]) for x, y in zip(edge, edge[1:])] + [(edge[-1], NEVER)]
                          for edge in (left, right))
        self.edges[token] = whole
        return whole

    def fits(self, last: int, token: int) -> bool:
        """Is ``token`` its own encoding, also after ``last``? Follow the two
        parts that touch at the boundary while each grows: the pair is stable
        unless they would merge before either is absorbed by its own side
        (the left merge goes first where ranks are equal)."""
        right = self.spines(token)
        if right is None or last == START:
            return right is not None
        key = last << 20 | token
        known = self.stable.get(key)
        if known is None:
            if len(self.stable) > 4 * self.max_states:
                self.stable.clear()
            known, i, j = True, 0, 0
            a, b = self.spines(last)[1], right[0]
            while True:
                (x, up_x), (y, up_y) = a[i], b[j]
                rank = self.ranks.get(x + y, NEVER)
                if rank < up_x and rank <= up_y and rank != NEVER:
                    known = False
                    break
                if up_x == NEVER and up_y == NEVER:
                    break
                if up_x <= up_y:
                    i += 1
                else:
                    j += 1
            self.stable[key] = known
        return known

    def build(self, state: int, byte: int) -> tuple:
        """The transition of ``state`` on ``byte``: next state; for each of its
        hypotheses the one it continues and the token it adds (-1: none); and
        the one all descend from (-1: several)."""
        hypotheses, sources, tokens = [], [], []
        for k, (last, node) in enumerate(self.states[state]):
            node = self.child.get(node << 8 | byte, -1)
            if node < 0:
                continue
            if not self.leaf[node]:
                hypotheses.append((last, node))
                sources.append(k)
                tokens.append(-1)
            token = self.token[node]
            if token >= 0 and self.fits(last, token):
                hypotheses.append((token, 0))
                sources.append(k)
                tokens.append(token)
        move = (self.add(tuple(hypotheses)), sources, tokens, sources[0] if len(set(sources)) == 1 else -1)
        self.moves[state << 8 | byte] = move
        return move

    def add(self, hypotheses: tuple) -> int:
        number = self.number.setdefault(hypotheses, len(self.states))
        if number == len(self.states):
            self.states.append(hypotheses)
            self.ends.append(next((k for k, (_, node) in enumerate(hypotheses) if node == 0), -1))
        return number

    @staticmethod
    def emit(trail: list, k: int) -> list[int]:
        """Tokens of hypothesis ``k`` after the moves in ``trail``."""
        out = []
        for _, sources, tokens, _ in reversed(trail):
            if tokens[k] >= 0:
                out.append(tokens[k])
            k = sources[k]
        out.reverse()
        return out

    def encode(self, piece: bytes) -> list[int]:
        if len(self.states) > self.max_states:
            self.reset()
        state, trail, out, known = 0, [], [], self.moves.get
        if len(piece) <= LOOKAHEAD:  # nothing to emit before the end
            for byte in piece:
                move = known(state << 8 | byte) or self.build(state, byte)
                state = move[0]
                trail.append(move)
            return self.emit(trail, self.ends[state]) if piece else out
        for byte in piece:
            move = known(state << 8 | byte)
            if move is None:
                if len(self.states) > 2 * self.max_states:  # within one very long piece
                    now = self.states[state]
                    self.reset()
                    known, state = self.moves.get, self.add(now)
                move = self.build(state, byte)
            if move[3] >= 0 and len(trail) >= LOOKAHEAD:
                out += self.emit(trail, move[3])
                trail = []
                # the hypothesis all descend from is the only one left: number it 0
                move = (move[0], [0] * len(move[1]), move[2], 0)
            state = move[0]
            trail.append(move)
        return out + self.emit(trail, self.ends[state]) if piece else out


class Utf8Stream:
    """Incremental UTF-8 decoder: a state machine over (bytes still missing,
    bytes held back); invalid input raises, as a strict decoder does."""

    def __init__(self):
        self.held = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """Length of a character begun at the end of ``data`` and not complete."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:  # a continuation: its first byte is further back
                continue
            need = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2 if byte >= 0xC0 else 1
            return back if need > back else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self.unfinished(data)
        self.held = data[cut:]
        return data[:cut].decode()

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode()


class Codec:
    """Encoding and decoding of whole texts; the ids of parts between blanks
    are kept in a bounded cache, new parts are cut by the pattern and sent
    through the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.fst = Transducer(ranks)
        self.find = regex.compile(pattern).findall
        self.words = pattern.startswith(WORDS)
        self.parts = PartCache(self.part, tuple)
        self.known: dict[str, list[int]] = {}  # ids of short pieces, bounded as the parts are
        top = max(ranks.values()) + 1
        self.table = [self.fst.bytes_of.get(i, b"") for i in range(top)]
        self.digits = [str(i) for i in range(top)]

    def part(self, text: str) -> list[int]:
        """Ids of a part. Where the pattern begins with WORDS, a blank and ASCII
        letters are one piece and need not be cut."""
        if self.words and text[:1] == " " and text.isascii() and text[1:].isalpha():
            return self.known.get(text) or self.piece(text)
        return self.pieces(text)

    def piece(self, piece: str) -> list[int]:
        ids = self.fst.encode(piece.encode())
        if len(piece) <= CACHE_CHARS:
            if len(self.known) >= CACHE_PARTS:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def pieces(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self.find(text):
            out += self.known.get(piece) or self.piece(piece)
        return out

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.parts.parts(text)))

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))

    def decode(self, ids, chunk: int = 4096):
        """Text of ``ids``, yielded chunk by chunk."""
        stream = Utf8Stream()
        for i in range(0, len(ids), chunk):
            yield stream.feed(self.decode_bytes(ids[i:i + chunk]))
        yield stream.close()


_loaded: dict = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Codec(load_ranks(path), pattern)
    return _loaded[path, pattern]


@contextmanager
def no_collections():
    """No garbage collections inside, and later ones leave out what is held by
    then: coding makes no cycles, and each collection would walk through the caches
    and states, a million of small objects."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.freeze()
            gc.enable()


def _digests(coder: Codec, texts: list[str]):
    """Per text: number of ids, digest of the ids, digest of the text decoded from them."""
    n, hashes, back = [], [], []
    for text in texts:
        ids = coder.encode(text)
        n.append(len(ids))
        hashes.append(sha256(" ".join(map(coder.digits.__getitem__, ids)).encode()).hexdigest())
        decoded = sha256()
        for part in coder.decode(ids):
            decoded.update(part.encode())
        back.append(decoded.hexdigest())
    return n, hashes, back


def _round_trip(batches, path: str, pattern: str):
    coder = codec(path, pattern)
    for batch in batches:
        with no_collections():
            n, hashes, back = _digests(coder, batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(hashes, pa.string()), pa.array(back, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _encode(batches, path: str, pattern: str):
    coder = codec(path, pattern)
    for batch in batches:
        with no_collections():
            ids = [coder.encode(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int64()))],
                                         names=["doc_id", "ids"])


def _decode(batches, path: str, pattern: str):
    coder = codec(path, pattern)
    for batch in batches:
        text = [None if ids is None else "".join(coder.decode(ids)) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the ids of its whole text."""
    bounded_batches(docs.sparkSession)
    return texts(docs).mapInArrow(partial(_encode, path=path, pattern=pattern), "doc_id long, ids array<long>")


def decode(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the text of its ids (null ids: null text)."""
    bounded_batches(ids.sparkSession)
    return ids.select("doc_id", "ids").mapInArrow(partial(_decode, path=path, pattern=pattern),
                                                  "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode each text, decode the ids again, and return digests of both."""
    bounded_batches(docs.sparkSession)
    return texts(docs).mapInArrow(partial(_round_trip, path=path, pattern=pattern), SCHEMA)
